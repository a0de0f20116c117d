import hashlib
import random
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from sedimenta.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes, arity=3):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i:i + arity])) for i in range(0, len(below), arity)])
    return levels


def path(levels, at, arity=3):
    out = []
    for level in levels[:-1]:
        first = at // arity * arity
        run = level[first:first + arity]
        out.append(("".join(run[:at - first]), "".join(run[at - first + 1:])))
        at //= arity
    return out


def slow_manifest(rows):
    groups = {}
    for r in rows:
        later = r[4]
        if later is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
            later = later.replace("\n", "")
        leaf, seen = (sha("".join(map(field, (*r[:4], text)))) for text in (r[4], later))
        groups.setdefault(r[1], []).append(((r[0] is not None, r[0] or 0), leaf, seen, r[0]))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    ordered = {g: sorted(groups[g], key=lambda x: x[:2]) for g in names}
    trees = {g: tree([x[1] for x in ordered[g]]) for g in names}
    top = tree([trees[g][-1][0] for g in names])
    out = []
    for j, g in enumerate(names):
        for i, (_, leaf, seen, doc_id) in enumerate(ordered[g]):
            witness, root = path(trees[g], i) + path(top, j), top[-1][0]
            folded = seen
            for left, right in witness:
                folded = sha(left + folded + right)
            out.append((doc_id, leaf, trees[g][-1][0], root, sha("".join(a + b for a, b in witness)), folded, folded == root))
    return sorted(out, key=repr)


@given(st.integers(1, 60), st.integers(2, 4))
@settings(max_examples=60, deadline=None)
def test_witnesses_grow_to_the_paths_of_the_tree(n, arity):
    leaves = [sha(str(i)) for i in range(n)]
    grown = merkle.WitnessTree(arity)
    for leaf in leaves:
        grown.append(leaf)
    root, height = grown.seal()
    levels = tree(leaves, arity)
    assert (root, height) == (levels[-1][0], len(levels) - 1)
    assert grown.witness == [path(levels, i, arity) for i in range(n)]


def test_a_witness_is_partial_until_its_siblings_are_complete():
    grown = merkle.WitnessTree(3)
    for i in range(4):
        grown.append(sha(str(i)))
    assert [len(w) for w in grown.witness] == [1, 1, 1, 0]
    for i in range(4, 9):
        grown.append(sha(str(i)))
    assert [len(w) for w in grown.witness] == [2] * 9


def test_manifest(spark, rows):
    rng = random.Random(1)
    sources = ["a"] * 6 + ["b", "c", None, "é", ""]
    table = [(rng.choice([i, i, i, None, i // 2]), rng.choice(sources), rng.choice(["en", None]), rng.choice([1, None]),
              rng.choice([None, "", "x\ny", "zé\n"])) for i in range(400)] + [(1000, "lone", "en", 3, "a\nb" * 400_000)]
    frame = spark.createDataFrame([(*r, 1, 2) for r in table],
                                  "doc_id bigint, source string, lang string, n_chars bigint, text string, g int, witness int")
    want = slow_manifest(table)
    assert {r[-1] for r in want} == {True, False}
    for levels in (1, 2, 8):  # many blocks and several trees of block roots, or one block
        assert rows(merkle.document_manifest(frame, levels=levels)) == want
    assert merkle.document_manifest(frame.limit(0)).collect() == []
    one = frame.where("doc_id = 1000")
    assert rows(merkle.document_manifest(one)) == slow_manifest(table[-1:])
