"""op1's recall on clustered vectors, against all inner products."""

import numpy as np

from sedimenta.llm.collision_search import search_block


def test_recall_on_clustered_vectors():
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((200, 64))
    x = centres[rng.integers(0, 200, 8000)] + 0.5 * rng.standard_normal((8000, 64))
    ids, asked = np.arange(len(x)), np.arange(0, 8000, 80)
    found = search_block(ids, x, asked, x[asked], 20)
    hits = 0
    for q in asked.tolist():
        score = x @ x[q]
        score[q] = -np.inf
        hits += len({i for a, i, _ in found if a == q} & set(np.argsort(-score)[:20].tolist()))
    assert hits >= 0.98 * 20 * len(asked), hits / 20 / len(asked)
