"""Marks beside the bands of lines: chance meetings are refused where they meet, and no link is lost."""

import random

import numpy as np
import pyarrow as pa

from sedimenta.llm import line_dedup, links
from sedimenta.llm.cells import are_linked


def lines(n: int) -> list[tuple[int, str]]:
    """Documents of one line, from few words so that bands meet by chance; every tenth is an edit of the one before."""
    rng, out = random.Random(5), []
    vocabulary = ["".join(rng.choices("abcdefghij", k=7)) for _ in range(100)]
    for i in range(n):
        line = " ".join(rng.choices(vocabulary, k=rng.randint(9, 14)))
        if i % 10 == 9:
            line = out[-1][1][:-1] + "#"
        out.append((i, line))
    return out


def test_chance_meetings_are_not_written(spark, monkeypatch):
    rows, kept = lines(3000), []
    plain = line_dedup.link_components

    def spied(members, *rest):
        kept.extend(members.collect())
        return plain(members, *rest)

    monkeypatch.setattr(line_dedup, "link_components", spied)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    gone = {r.id for r in line_dedup.repeated_lines(frame, shingle=5).collect()}
    texts = [t for _, t in rows]
    keys = line_dedup.band_keys(line_dedup.minima(*line_dedup._shingles(texts, 5)))
    pairs = {(a, b) for band in range(keys.shape[1]) for a, b in meetings(keys[:, band])}
    i, j = (np.array(x) for x in zip(*sorted(pairs), strict=True))
    linked = are_linked(i, j, line_dedup.line_sets(texts, 5), 80)
    assert gone == set(j[linked].tolist()) and len(gone) > 250
    meeting, written = len(set(i.tolist()) | set(j.tolist())), len({r.id for r in kept})
    assert written < 2.2 * len(gone) < meeting / 2


def meetings(keys: np.ndarray) -> list[tuple[int, int]]:
    held: dict[int, list[int]] = {}
    for i, key in enumerate(keys.tolist()):
        held.setdefault(key, []).append(i)
    return [(a, b) for ids in held.values() for k, b in enumerate(ids) for a in ids[:k]]


def test_members_are_those_with_a_mark_alike():
    rng = np.random.default_rng(3)
    alike = line_dedup.marks_alike(80)
    for crowd in (4, 30):  # ids that hold a key; 30 are a crowd in their slice
        ids = rng.permutation(60 * crowd).astype(np.int64)
        keys = np.repeat(rng.integers(0, 2**63, 60, dtype=np.uint64), crowd)
        marks = rng.integers(1, 2**32, (len(ids), 3), dtype=np.uint32)
        marks[1::crowd] = marks[::crowd]  # the first two of a key are alike
        parts: dict[int, list[bytes]] = {}
        for part in np.array_split(rng.permutation(len(ids)), 3 if crowd < links.CROWD else 1):
            for key, blob in links.marked_blobs(ids[part], keys[part], marks[part], 5, 1):
                parts.setdefault(key, []).append(blob)
        got = set()
        for part, blobs in parts.items():
            table = pa.table({"part": pa.array([part] * len(blobs), pa.int32()), "blob": pa.array(blobs, pa.binary()), "parts": pa.array([5] * len(blobs), pa.int32())})
            found = links._meet_marked(table, 3, alike) if part >= 0 else links._meet(table)
            got |= set(found.column("id").to_pylist())
        want = np.arange(len(ids)) % crowd < 2 if crowd < links.CROWD else np.ones(len(ids), dtype=bool)
        assert got == set(ids[want].tolist())


def test_texts_that_lose_no_line_are_left_as_they_are(spark):
    line = "a line that is long enough to take part in what is compared here, said "
    rows = [(i, f"{line}{i % 7 if i < 20 else i * i * 7919}\nx") for i in range(40)] + [(None, f"{line}0"), (3, f"{line}3\nx"), (50, None), (51, "")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    plain, full = (sorted(line_dedup.dedup_lines(frame, shingle=5, filter_bits=bits).collect(), key=str) for bits in (1 << 24, 64))
    assert plain == full and len(plain) == len(rows)
    assert {r.n_removed for r in plain if r.doc_id is None or r.doc_id >= 50 or r.doc_id == 0} == {0}
    assert [r.text for r in plain if r.doc_id == 8] == ["x"] and [r.text for r in plain if r.doc_id is None] == [f"{line}0"]
