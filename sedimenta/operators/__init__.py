"""DataFrame operators: routing, merging, history, star loading, windows and quality."""
