"""The training-data operators against slow models, and on nulls, empty and repeated rows and empty tables."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sedimenta.llm import collision_search, jaccard_join, language_id, line_dedup, packing, pii, quality_classifier, range_join, sentencepiece_bpe, substring_dedup
from sedimenta.llm.graph import components

WORDS = [f"w{i}" for i in range(400)]


def texts(n: int, seed: int = 1) -> list[tuple[int, str]]:
    """Texts of which some are copies or near copies of others and some share passages of 60 words."""
    rng = random.Random(seed)
    passage, out = rng.choices(WORDS, k=60), []
    for i in range(n):
        words = rng.choices(WORDS, k=rng.choice([3, 20, 90, 150]))
        if out and i % 4 == 1:
            words = rng.choice(out)[1].split()
            for _ in range(rng.choice([0, 1, 2, 6])):
                words[rng.randrange(len(words))] = "x"
        if i % 5 == 2:
            words[10:10] = passage
        out.append((i, " ".join(words)))
    return out


ODD = [(None, "a b c"), (1000, None), (1001, ""), (1002, " \n "), (1003, "one"), (1003, "one")]
SCHEMA = "doc_id bigint, text string, part string, n int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "p", 1) for i, t in rows], SCHEMA)


def roots(ids, pairs):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)]
    want = roots({x for p in pairs for x in p}, pairs)
    got = {r.id: r.component for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == {i: r for i, r in want.items() if any(i in p and p[0] != p[1] for p in pairs)}


def test_jaccard_classes(spark):
    rows = texts(60)
    sets = {i: {tuple(w[j:j + 5]) for j in range(len(w) - 4)} or {tuple(w)} for i, t in rows if (w := t.split())}
    pairs = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = roots(sets, pairs)
    found = jaccard_join.jaccard_classes(frame(spark, rows + ODD)).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in found}
    assert len(found) == len(rows + ODD) and pairs
    assert all(got[i] == (len(sets[i]), want[i]) for i in sets)
    assert got[1000] == (0, 1000) and got[1002] == (0, 1002) and got[1003] == (1, 1003) and got[None][1] is None


def test_repeated_windows(spark):
    rows, length = texts(60, 3), 50
    first = {}
    for i, t in rows:
        w = t.split()
        for j in range(len(w) - length + 1):
            first.setdefault(tuple(w[j:j + length]), i)
    got = {r.doc_id: r for r in substring_dedup.remove_repeats(frame(spark, rows + ODD)).collect()}
    total = 0
    for i, t in rows:
        w = t.split()
        gone = {k for j in range(len(w) - length + 1) if first[tuple(w[j:j + length])] < i for k in range(j, j + length)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        total += len(gone)
        assert (got[i].n_words, got[i].n_removed, got[i].kept_text) == (len(w), len(gone), kept)
        assert got[i].kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()
    assert total and got[1000].n_words == 0 and got[None].n_removed == 0


def test_long_prefixes_give_the_same(spark, monkeypatch):
    rows = frame(spark, texts(60, 3))
    plain = {r.doc_id: r.kept_text for r in substring_dedup.remove_repeats(rows).collect()}
    monkeypatch.setattr(substring_dedup, "LONG_PREFIX", 2)
    assert {r.doc_id: r.kept_text for r in substring_dedup.remove_repeats(rows).collect()} == plain


def test_line_dedup(spark):
    line = "the quick brown fox jumps over the lazy dog and then goes home again to sleep until the morning comes at last"
    rows = [(1, f"{line}\nshort"), (2, f"other text that stands alone here\n{line}"), (3, line.replace("last", "lasts")), (4, "short")]
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(frame(spark, rows + ODD)).collect()}
    assert got[1] == (rows[0][1], 2, 0) and got[2] == ("other text that stands alone here", 2, 1)
    assert got[3] == ("", 1, 1) and got[4] == ("short", 1, 0)
    assert got[1000] == (None, 0, 0) and got[1001] == ("", 1, 0)


def test_packing(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([0, 5, 40, 260, None]), rng.choice(["a", "a", "b", None]), rng.choice(["x", None])) for i in range(300)]
    items = spark.createDataFrame(rows, "doc_id bigint, n_words int, source string, cluster string")
    placed = packing.pack(items, capacity=100).collect()
    of = {r[0]: r for r in rows}
    bins = {}
    for r in placed:
        bins.setdefault((r.pool, r.bin), []).append(r)
    for held in bins.values():
        assert sum(r.size for r in held) <= 100
        for k in (2, 3):
            used = [of[r.doc_id][k] for r in held if of[r.doc_id][k]]
            assert len(used) == len(set(used))
    for i, n, *_ in rows:
        mine = sorted((r.first, r.size) for r in placed if r.doc_id == i)
        assert sum(s for _, s in mine) == (n or 0) and [f for f, _ in mine] == list(range(0, max(n or 0, 1), 100))


def test_best_fit_is_the_tightest():
    assert packing.best_fit([60, 50, 30, 10], [0, 1, 1, 0], [-1] * 4, 100) == ([0, 1, 0, 1], [0, 0, 60, 50])


def test_vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((40, 8))
    rows = [(i, [float(v) for v in base[i % 40] + rng.standard_normal(8) * 0.15 * (i % 3)]) for i in range(200)]
    odd = [(900, None), (901, [0.0] * 8), (902, [float("nan")] * 8), (903, [1.0, None]), (904, [1.0, 2.0])]
    table = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<float>").withColumn("body", F.lit(1))
    x = np.array([np.float32(v) for _, v in rows], dtype=np.float64)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.9) & ~np.eye(200, dtype=bool)
    want = roots(range(200), zip(*(a.tolist() for a in np.nonzero(near)), strict=True))
    got = {r.vec_id: r for r in range_join.near_vectors(table).collect()}
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (near[i].sum(), want[i], want[i] == i) for i in range(200))
    assert all((got[i].n_links, got[i].kept) == (0, True) for i, _ in odd)
    found = collision_search.nearest(table, F.col("id") % 20 == 0, k=5).collect()
    hits = 0
    for q in range(0, 200, 20):
        score = x @ x[q]
        score[q] = -np.inf
        mine = sorted((r for r in found if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in mine] == [1, 2, 3, 4, 5]
        hits += len({r.vec_id for r in mine} & set(np.argsort(-score, kind="stable")[:5].tolist()))
    assert hits >= 45 and not {r.query_id for r in found} & {900, 904}


def test_language_spans(spark):
    rows = [(i, t, lang) for i in range(30) for t, lang in (("the house and the garden with water", "en"), ("das Haus und der Garten mit Wasser", "de"))]
    docs = spark.createDataFrame([*rows, (90, None, "en"), (91, "12 34", None), (92, " ".join(["the garden"] * 20 + ["der Garten"] * 9), None)], "doc_id bigint, text string, lang string")
    got = {r.doc_id: r for r in language_id.identify(docs, language_id.learn(docs, F.lit(True))).collect()}
    assert got[90].lang_pred == got[91].lang_pred == "und" and got[90].lang_score == 0
    assert got[92].lang_pred == "en" and got[92].spans == "en:0:40,de:40:58" and 0.5 < got[92].lang_score < 1
    none = language_id.identify(docs, language_id.learn(docs, F.lit(False))).collect()
    assert {r.lang_pred for r in none} == {"und"}


def test_viterbi_against_dynamic_programming():
    rng = np.random.default_rng(1)
    for _ in range(200):
        lengths = rng.integers(0, 9, 3)
        scores, offsets = rng.standard_normal((lengths.sum(), 3)) * 3, np.concatenate([[0], np.cumsum(lengths)])
        labels = language_id.viterbi(scores, offsets, 2.0)
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            if a == b:
                continue
            best = scores[a]
            for row in scores[a + 1:b]:
                best = np.maximum(best, best.max() - 2.0) + row
            path = labels[a:b]
            got = scores[np.arange(a, b), path].sum() - 2.0 * (np.diff(path) != 0).sum()
            assert got == pytest.approx(best.max())


def test_sentencepiece_equals_the_library(spark):
    tokenizers = pytest.importorskip("public_tokenizers")
    path = tokenizers.path("piece_bpe_32k.model")
    odd = ["  a  b ", "a\n\nb", "▁x y", " ", "日本 語 é 😀", "\x00a\tb", "a ▁▁ b", "\n", "x\n y  \n  z"]
    rng = random.Random(5)
    rows = [*enumerate(odd), *((100 + i, "".join(rng.choices("ab \n▁é日e", k=30))) for i in range(200)), *((i + 500, t) for i, t in texts(10)), *ODD]
    library = sentencepiece_bpe.vocabulary(path).library
    for r in sentencepiece_bpe.encode_texts(frame(spark, [x for x in rows if x[0] is not None]), path).collect():
        ids = library.encode(next(t for i, t in rows if i == r.doc_id) or "")
        assert r.ids == ids and r.n_tokens == len(ids) and r.decoded == library.decode(ids)


def test_both_agendas_merge_alike():
    tokenizers = pytest.importorskip("public_tokenizers")
    words, rng = sentencepiece_bpe.vocabulary(tokenizers.path("piece_bpe_32k.model")), random.Random(8)
    for _ in range(2000):
        text = "▁" + "".join(rng.choices("abcdeinorstué日-.1", k=rng.randrange(40)))
        assert words._merge_short(text) == words._merge_long(text)


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([ -]?[0-9])+", "phone": r"\+[0-9][ ().0-9-]+[0-9]"}


def base_spans(text):
    def valid(kind, s):
        digits = [int(c) for c in s if c in "0123456789"]
        if kind == "ip":
            return all(int(p) < 256 for p in s.split("."))
        if kind == "card":
            doubled = [d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(reversed(digits))]
            return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    return {k: [m.span() for m in re.finditer(p, text) if valid(k, m.group())] for k, p in BASE.items()}


def test_personal_data_against_patterns():
    rng = random.Random(6)
    pieces = [*"014569 -.()+@ab%_é\n", "4532015112830366", "255", "256", "+1", "a@", "b.c", "00"]
    for _ in range(20_000):
        text = "".join(rng.choices(pieces, k=rng.randrange(30)))
        found = pii.find(text)
        assert {k: found[k] for k in pii.BASE} == base_spans(text)


def test_personal_data(spark):
    rows = [(1, "mail é a.b@c.example, see https://x.example/p?q=1. token = \"04dbebab91ab85687d33\""), (2, "4532015112830366 4532015112830367")]
    got = {r.doc_id: r for r in pii.personal_data(frame(spark, rows + ODD)).collect()}
    assert got[1].redacted == "mail é <email>, see <url>. token = \"<account>\"" and got[1].n_email == 1
    assert got[2].n_card == 0 and got[1000].redacted is None and got[1000].spans == ""


def test_quality(spark):
    rows = [(i, "good clean words here" if i % 2 else "bad&& junk%% ***") for i in range(60)] + [(98, None), (99, "")]
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, quality int")
    model = quality_classifier.learn(docs, labels, F.col("doc_id") < 40)
    got = {r.doc_id: r.score for r in quality_classifier.score(docs, model).collect()}
    assert all((got[i] > 0.7) == bool(i % 2) for i in range(60)) and got[98] == got[99]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    vectors = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    made = [
        jaccard_join.jaccard_classes(docs), substring_dedup.remove_repeats(docs), line_dedup.dedup_lines(docs), packing.pack_documents(docs),
        range_join.near_vectors(vectors), collision_search.nearest(vectors, F.col("id") % 20 == 0), pii.personal_data(docs),
        language_id.identify(docs, language_id.learn(docs, F.lit(True))), quality_classifier.score(docs, quality_classifier.learn(docs, labels, F.lit(True)))]
    assert [df.count() for df in made] == [0] * len(made)
