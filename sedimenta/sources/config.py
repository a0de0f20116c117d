"""Control rows and contracts from files. JSON always works; YAML where PyYAML is installed."""

from __future__ import annotations

import json
from pathlib import Path

try:
    import yaml
except ImportError:  # optional
    yaml = None


def read_config(path: str | Path) -> dict:
    text = Path(path).read_text(encoding="utf-8")
    if str(path).endswith((".yaml", ".yml")):
        if yaml is None:
            raise RuntimeError("install PyYAML to read YAML, or use JSON")
        return yaml.safe_load(text)
    return json.loads(text)
