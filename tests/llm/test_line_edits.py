"""op7 on planted edits of lines of normal length, against all pairs."""

import random
import string

from sedimenta.llm import queries
from sedimenta.session import scratch_path


def planted() -> list[tuple[int, str]]:
    """Lines of 40 to 120 characters: each as it is, with one character changed, and with one word of six letters changed."""
    rng, out = random.Random(12), []
    for n in range(40, 121, 4):
        words = ["".join(rng.choices(string.ascii_lowercase, k=6)) for _ in range(n // 7 + 1)]
        line, at = " ".join(words)[:n].strip(), n // 2
        words[len(words) // 2] = "".join(rng.choices(string.ascii_lowercase, k=6))
        out += [line, line[:at] + "#" + line[at + 1:], " ".join(words)[:n].strip()]
    return list(enumerate(out))


def left(rows: list[tuple[int, str]], size: int) -> set[int]:
    """The least of each component of lines with a Jaccard similarity of 0.8 of their shingles of ``size`` characters."""
    sets = {i: {s[j:j + size] for j in range(len(s) - size + 1)} for i, s in rows}
    root = dict.fromkeys(sets)
    for i in sets:
        near = [root[j] for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
        root = {j: min(near) if r in near else r for j, r in root.items()} | {i: min(near, default=i)}
    return {i for i, r in root.items() if r == i}


def test_edited_lines_of_normal_length(spark):
    rows = planted()
    path = scratch_path(spark, "edits")
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{path}/documents.parquet")
    got = {r.doc_id for r in queries.op7_line_dedup(spark, path).where("n_removed = 0").collect()}
    assert got == left(rows, 5)
    # One changed character is found from 49 characters on; with shingles of 12 from 119.
    assert not got & {i + 1 for i, t in rows if i % 3 == 0 and len(t) >= 49}
    assert len(left(rows, 12)) > len(got)
