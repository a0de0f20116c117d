import hashlib
import random
import zlib

import numpy as np
import pytest

from sedimenta.llm import prefix_trie


def code(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def slow_rebuilt(rows):
    said = {}
    for c, t, r, x in rows:
        if c is not None:
            said.setdefault(c, []).append(((t is not None, t or 0), r or "", x or ""))
    turns = {c: [v[1:] for v in sorted(all_, key=lambda v: (v[0], v[1], code(*v[1:])))] for c, all_ in said.items()}
    out = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        of = abs(c) // 5 * 5 * (1 if c >= 0 else -1)
        out[c] = tuple(turns.get(of, [])[:h] + turns[c][h:])
    return out


def slow_trie(convs):
    members, children, summed, out = {}, {}, {}, []
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    for p in sorted(members, key=len, reverse=True):
        below = children.get(p, [])
        own = (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
        summed[p] = (sum(summed[k][0] for k in below) or 1, own + sum(summed[k][1] for k in below))
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(convs[c]) == len(p))))
        parent = min(members[p[:-1]]) if p else None
        out.append((min(m), len(p), parent, len(m), len(children.get(p, [])), *summed[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations(seed):
    rng = random.Random(seed)
    rows = []
    for c in range(200):
        if c % 17 == 3:
            continue
        for t in range(rng.choice([1, 2, 3, 9, 14])):
            role = rng.choice(["u", "a", None]) if rng.random() < 0.2 else "u"
            text = rng.choice(["x", "é", "", None]) if rng.random() < 0.3 else "same"
            rows.append((c if rng.random() < 0.99 else None, t if rng.random() < 0.9 else None, role, text))
    return [*rows, (-3, 0, "u", "x"), (-5, 1, "a", "y" * 1_000_000), *rows[:40]]


@pytest.mark.parametrize(("block", "tasks"), [(50_000, 8), (1, 5), (2, 1), (7, 8)])
def test_trie_of_blocks_of_any_size(spark, rows, monkeypatch, block, tasks):
    monkeypatch.setattr(prefix_trie, "BLOCK_ROWS", block)
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 2 if block < 10 else 50_000)
    had = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", tasks)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = conversations(block)
        frame = spark.createDataFrame([(*r, 1) for r in table], "conv_id bigint, turn bigint, role string, text string, depth int")
        assert rows(prefix_trie.rebuilt_trie(frame)) == slow_trie(slow_rebuilt(table))
        assert prefix_trie.rebuilt_trie(frame.limit(0)).collect() == []
    finally:
        for k, v in had.items():
            spark.conf.set(k, v)


def test_copies_in_many_blocks_are_one_leaf(spark, rows, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK_ROWS", 3)
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 2)
    table = [(c, t, "u", f"t{t}") for c in range(0, 100, 5) for t in range(12)]  # c - c % 5 = c: nothing is replaced
    frame = spark.createDataFrame(table, "conv_id bigint, turn bigint, role string, text string")
    found = prefix_trie.trie(prefix_trie.sequences(frame))
    turns = tuple(("u", f"t{t}") for t in range(12))
    assert rows(found) == slow_trie({c: turns for c in range(0, 100, 5)})


def test_shared_turns():
    rng = np.random.default_rng(1)
    sequences = sorted(tuple(rng.integers(0, 2, rng.integers(0, 6)).tolist()) for _ in range(200))
    lengths = np.array([len(s) for s in sequences])
    flat = np.array([[x, x] for s in sequences for x in s], dtype=np.uint64)
    got = prefix_trie.shared_turns(flat, np.cumsum(lengths) - lengths, lengths)
    want = [next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) for a, b in zip(sequences, sequences[1:])]
    assert got.tolist() == want
