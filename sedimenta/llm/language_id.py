"""Language identification of whole, possibly mixed texts.

A word's script (Unicode ranges) narrows the candidate languages to those that use it; each candidate scores the
word by its letter n-grams. Viterbi with a penalty for every switch then labels all words, so a text falls into spans
of one language. The prediction is the language of most letters, the score its share of all letters of the text.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sedimenta.llm.hashing import mix, rolling, slices
from sedimenta.llm.memory import giving_back
from sedimenta.llm.tokens import TokenTable

#: Text bytes whose words are scored together; their scores are several times as large.
_SLICE_BYTES = 2_000_000
#: First code points of script ranges and the scripts (Unicode blocks; "" is any other).
SCRIPTS = [
    (0x0000, "latin"), (0x0250, ""), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0780, ""), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, ""), (0x0B80, "tamil"),
    (0x0C00, ""), (0x0E00, "thai"), (0x0E80, ""), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, ""),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, ""), (0x3040, "kana"), (0x3100, ""), (0x3400, "han"),
    (0xA000, ""), (0xAC00, "hangul"), (0xD7B0, ""), (0xF900, "han"), (0xFB00, ""), (0x20000, "han"), (0x30000, ""),
]
_FIRSTS = [first for first, _ in SCRIPTS]
_LETTERS = re.compile(r"[^\W\d_]+")
_GRAMS = (1, 2, 3, 4)
UNKNOWN = "und"


@dataclass(frozen=True)
class Model:
    languages: list[str]
    log_p: np.ndarray  # buckets x languages
    scripts: dict[str, np.ndarray]  # script -> which languages use it
    switch_penalty: float


def script(letter: str) -> str:
    return SCRIPTS[bisect_right(_FIRSTS, ord(letter)) - 1][1]


def grams(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all letter n-grams of the words, with their ends marked, and each one's word."""
    size = np.array([len(w) + 2 for w in words], dtype=np.int64)
    chars = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    begin, values, at, owner = np.cumsum(size) - size, mix(chars.astype(np.uint64)), [], []
    for n in _GRAMS:
        count = np.maximum(size - n + 1, 0)
        word = np.repeat(np.arange(len(words)), count)
        inner = np.arange(len(word)) - np.repeat(np.cumsum(count) - count, count)
        at.append((rolling(values, n)[begin[word] + inner] % np.uint64(buckets)).astype(np.int64))
        owner.append(word)
    return np.concatenate(at), np.concatenate(owner)


def learn(docs: DataFrame, train: Column, *, text_col: str = "text", lang_col: str = "lang", sample_rows: int = 3000,
          buckets: int = 1 << 15, switch_penalty: float = 8.0) -> Model:
    """A model of the rows where ``train`` holds and text and language aren't null.

    At most about ``sample_rows`` rows of each language are read, chosen by a hash of the text; all others are only
    scored. What comes to the driver is a count per bucket and language.
    """
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), train.alias("train"))
    rows = rows.where("train and text is not null and lang is not null")
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.empty((buckets, 0)), {}, switch_penalty)
    bound = F.create_map([F.lit(x) for lang in languages for x in (lang, int(min(1.0, sample_rows / sizes[lang]) * 1_000_000))])
    chosen = rows.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < bound[F.col("lang")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words: dict[str, Counter] = {}
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                words.setdefault(lang, Counter()).update(_LETTERS.findall(text.lower()))
            for lang, seen in ((k, v) for k, v in words.items() if v):
                used, times = Counter(), np.array(list(seen.values()))
                place, word = grams(list(seen), buckets)
                table = np.bincount(place, weights=times[word], minlength=buckets).astype(np.int64)
                for w, n in seen.items():
                    used[script(w[0])] += n
                at = np.flatnonzero(table)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * (len(at) + len(used))), pa.array([*at.tolist(), *[-1] * len(used)], pa.int64()),
                     pa.array([""] * len(at) + list(used)), pa.array([*table[at].tolist(), *used.values()], pa.int64())],
                    names=["lang", "bucket", "script", "n"])

    counted = chosen.select("text", "lang").mapInArrow(giving_back(count), "lang string, bucket bigint, script string, n bigint")
    counts, used = np.full((buckets, len(languages)), 0.5), {}
    for r in counted.groupBy("lang", "bucket", "script").agg(F.sum("n").alias("n")).collect():
        if r.bucket >= 0:
            counts[r.bucket, languages.index(r.lang)] += r.n
        else:
            used.setdefault(r.script, np.zeros(len(languages)))[languages.index(r.lang)] += r.n
    total = np.maximum(sum(used.values(), np.zeros(len(languages))), 1)
    return Model(languages, np.log(counts / counts.sum(axis=0)), {s: n >= 0.001 * total for s, n in used.items()}, switch_penalty)


def word_scores(tokens: list[str], model: Model) -> np.ndarray:
    """Letters of each token, those of them in a script some language uses, then its score for each language.

    A language without the token's script gets the least; a token in a script no language uses says nothing of any.
    """
    found = [_LETTERS.findall(token) for token in tokens]
    parts, owner = [w for f in found for w in f], np.repeat(np.arange(len(tokens)), [len(f) for f in found])
    out = np.zeros((len(tokens), 2 + len(model.languages)))
    if not parts:
        return out
    out[:, 0] = np.bincount(owner, weights=[len(w) for w in parts], minlength=len(tokens))
    place, word = grams(parts, len(model.log_p))
    for k in range(len(model.languages)):
        out[:, 2 + k] = np.bincount(owner[word], weights=model.log_p[place, k], minlength=len(tokens)) / len(_GRAMS)
    nothing = np.zeros(len(model.languages), dtype=bool)
    fits = np.array([model.scripts.get(script(f[0][0]), nothing) if f else nothing for f in found]).reshape(len(tokens), -1)
    known = fits.any(axis=1) if fits.shape[1] else np.zeros(len(tokens), dtype=bool)
    used = {s for s, languages in model.scripts.items() if languages.any()}
    own = [len(w) if w.isascii() and "latin" in used else sum(script(c) in used for c in w) for w in parts]
    out[:, 1] = np.where(known, np.bincount(owner, weights=own, minlength=len(tokens)), 0.0)
    scores = out[:, 2:]
    out[:, 2:] = np.where(known[:, None], np.where(fits, scores, scores.min(axis=1, initial=0.0)[:, None] - 5.0), 0.0)
    return out


def viterbi(scores: np.ndarray, offsets: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of every word: the sum of scores less ``penalty`` for each change within a text."""
    n_langs, lengths = scores.shape[1], np.diff(offsets)
    labels = np.zeros(len(scores), dtype=np.int64)
    if not len(scores) or n_langs == 1:
        return labels
    full = np.flatnonzero(lengths)
    text = np.repeat(np.arange(len(lengths)), lengths)
    total = np.zeros((len(lengths), n_langs))
    total[full] = np.add.reduceat(scores, offsets[:-1][full])
    best = total.argmax(axis=1)
    labels[:] = best[text]
    # One label stands where no stretch gains half a penalty by another one: k stretches then
    # gain under k / 2 penalties and cost k - 1 at least.
    gain = np.cumsum(scores - scores[np.arange(len(scores)), labels][:, None], axis=0)
    before = np.zeros((len(lengths), n_langs))
    before[1:] = np.concatenate([np.zeros((1, n_langs)), gain])[offsets[1:-1]]
    gain -= before[text]
    drop = (gain.max() - gain.min() + 1) * text[:, None]
    low = np.minimum(np.minimum.accumulate(gain - drop, axis=0) + drop, 0)
    rise = np.zeros(len(lengths))
    rise[full] = np.maximum.reduceat((gain - low).max(axis=1), offsets[:-1][full])
    mixed = np.flatnonzero(rise > penalty / 2)
    mixed = mixed[np.argsort(-lengths[mixed], kind="stable")]
    if not len(mixed):
        return labels
    # The others step together, word by word; the longest come first, so those still going are a prefix.
    size, start = lengths[mixed], offsets[:-1][mixed]
    state, came = scores[start].copy(), np.zeros((len(scores), n_langs), dtype=np.min_scalar_type(-n_langs))
    for t in range(1, int(size[0])):
        going = int(np.searchsorted(-size, -t, "left"))
        now = state[:going]
        top = now.argmax(axis=1)
        jump = now[np.arange(going), top] - penalty
        stay = now >= jump[:, None]
        came[start[:going] + t] = np.where(stay, np.arange(n_langs), top[:, None])
        state[:going] = np.where(stay, now, jump[:, None]) + scores[start[:going] + t]
    at = state.argmax(axis=1)
    for t in range(int(size[0]) - 1, -1, -1):
        going = int(np.searchsorted(-size, -t, "left"))
        labels[start[:going] + t] = at[:going]
        at[:going] = came[start[:going] + t, at[:going]] if t else at[:going]
    return labels


def identify(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, lang_score, n_letters and spans ("lang:first:last" by word, comma-joined).

    A null text, one without a letter, or any text under a model without languages is ``und`` with score 0.
    Letters in a script that no language uses count in the whole and in no share: a text of them alone has score 0.
    Ties go to the language that sorts first. Existing columns of these names are replaced.
    """
    given = [f.name for f in docs.schema if f.name.lower() not in ("lang_pred", "lang_score", "n_letters", "spans")]
    rows = docs.select(*[F.col(f"`{c}`") for c in given])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, langs = TokenTable(lambda tokens: word_scores(tokens, model), 2 + len(model.languages)), model.languages
        for batch in slices(batches, text_col, _SLICE_BYTES):
            tokens = [(t or "").lower().split() for t in batch.column(text_col).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64)
            table.fresh()
            places = table.rows([w for t in tokens for w in t])
            values = table.values[places]
            letters, own = values[:, 0], values[:, 1]
            labels = viterbi(values[:, 2:], offsets, model.switch_penalty) if langs else np.zeros(len(values), dtype=np.int64)
            names, scores, counts, spans = [], [], [], []
            for a, b in zip(offsets[:-1], offsets[1:], strict=True):
                share = np.bincount(labels[a:b], weights=own[a:b], minlength=max(1, len(langs)))
                total = float(letters[a:b].sum())
                known = total > 0 and langs
                names.append(langs[int(share.argmax())] if known else UNKNOWN)
                scores.append(float(share.max()) / total if known else 0.0)
                counts.append(int(total))
                cut = np.flatnonzero(np.diff(labels[a:b])) + 1
                ends = zip([0, *cut.tolist()], [*cut.tolist(), int(b - a)], strict=True)
                spans.append(",".join(f"{langs[labels[a + x]]}:{x}:{y}" for x, y in ends) if known else "")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(counts, pa.int64()), pa.array(spans, pa.string())],
                names=[*batch.schema.names, "lang_pred", "lang_score", "n_letters", "spans"])

    schema = StructType(list(rows.schema)).add("lang_pred", "string").add("lang_score", "double").add("n_letters", "long").add("spans", "string")
    return rows.mapInArrow(giving_back(predict), schema)
