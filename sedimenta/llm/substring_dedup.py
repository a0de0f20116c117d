"""Repeated passages by prefix-partitioned suffix trees.

A window is `length` consecutive words of a document; a word goes when some window over it also starts in a
document with a smaller id. Windows are suffixes cut at that length, and a deep internal node (depth `length`) of the
suffix tree is a set of equal windows.

1. Prefixes. Within every window the least of its short grams (8 words) is its prefix for partitioning; equal
   windows have equal prefixes, and neighbouring windows mostly share one, so about one word in 20 starts a
   prefix. Only prefixes that two documents hold are followed.
2. Groups. The windows of a prefix in a document are one snippet. Prefixes are hashed into groups of bounded
   size. In a group, suffixes are sorted by prefix doubling (1, 2, 4 … words, then the exact
   length): equal ranks at full depth are the leaves of one deep node, whose smallest document stays.
3. A prefix held by too many documents is made longer, up to the whole window: then each window is a
   group of its own. A batch of snippets gives one row per distinct window, with its places; a minimum
   finds each window's smallest document, and the covered places are put together batch by batch.

Words are compared by 64-bit hashes, windows of long prefixes by 128 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.hashing import buffer_of, mix, rolling, slices, words
from sedimenta.llm.links import (
    GROUP_KEYS, KEY_BLOB, bit_hits, bit_place, bit_table, blob_batch, key_blobs, shared_keys)
from sedimenta.session import materialise

_GRAM = 8
#: Words of snippets that one group of suffixes holds on average, and documents at which a prefix is made longer.
GROUP_WORDS = 1_500_000
LONG_PREFIX = 500
#: Equal snippets that meet in one place.
BATCH_ROWS = 4000
_PLACE_BITS = 22


def _anchors(hashes: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All window starts, the start of each one's least gram, and the grams' hashes."""
    n = len(hashes)
    starts = np.concatenate([np.arange(a, b - length + 1) for a, b in zip(offsets[:-1], offsets[1:], strict=True)] or [np.empty(0, np.int64)])
    if not len(starts):
        return starts.astype(np.int64), starts.astype(np.int64), np.empty(0, dtype=np.uint64)
    grams = rolling(hashes, _GRAM)
    bits = max(_PLACE_BITS, int(n).bit_length())
    low = np.uint64((1 << bits) - 1)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    width, span = length - _GRAM + 1, 1
    while 2 * span <= width:  # minima over 1, 2, 4 … grams, then over exactly `width`
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[:len(least) - (width - span)], least[width - span:])
    return starts, (least[starts] & low).astype(np.int64), grams


def _runs(hashes: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor in one text: text, first and last window, prefix hash."""
    starts, anchor, grams = _anchors(hashes, offsets, length)
    if not len(starts):
        return starts, starts, starts, grams
    text = np.searchsorted(offsets, starts, "right") - 1
    cut = np.flatnonzero((anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])) + 1
    a, b = np.append(0, cut), np.append(cut, len(starts))
    return text[a], starts[a], starts[b - 1], grams[anchor[a]]


def _spans(doc: np.ndarray, start: np.ndarray, length: int) -> pa.RecordBatch:
    """(id, first, last): covered word ranges of equal or touching windows, in document order."""
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    if not len(doc):
        a = b = np.empty(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(a), pa.array(b)], names=["id", "first", "last"])
    cut = np.flatnonzero((doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + length)) + 1
    a, b = np.append(0, cut), np.append(cut, len(doc))
    return pa.RecordBatch.from_arrays([pa.array(doc[a]), pa.array(start[a]), pa.array(start[b - 1] + length)], names=["id", "first", "last"])


def equal_windows(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Ranks of the suffixes at ``starts`` at depth ``length``: equal ranks are leaves of one node.

    Ranks of 2w words come from pairs of ranks of w words; a suffix that ends earlier is never asked for.
    """
    _, rank = np.unique(text, return_inverse=True)
    rank, depth = rank.astype(np.uint64), 1
    while depth < length:
        step = min(depth, length - depth)  # the last step overlaps, so the depth is exact
        pair = (rank[:len(rank) - step] << np.uint64(32)) | rank[step:]
        rank, depth = np.unique(pair, return_inverse=True)[1].astype(np.uint64), depth + step
    return rank[starts]


def _subtree(length: int):
    def build(table: pa.Table) -> pa.Table:
        doc = np.asarray(table.column("id")).astype(np.int64)
        first = np.asarray(table.column("first")).astype(np.int64)
        snippets = [np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in table.column("body")]
        size = np.array([len(s) for s in snippets])
        begin = np.cumsum(size) - size
        windows = size - length + 1
        inner = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        node = equal_windows(np.concatenate(snippets), np.repeat(begin, windows) + inner, length)
        docs, starts = np.repeat(doc, windows), np.repeat(first, windows) + inner
        least = np.full(int(node.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, node, docs)
        covered = docs > least[node]
        return pa.Table.from_batches([_spans(docs[covered], starts[covered], length)])

    return build


def _leaves(batch: pa.RecordBatch, length: int) -> pa.RecordBatch:
    """The distinct windows of a batch of snippets: 128 bits of hash, least and largest id, and all places (ids, then starts)."""
    found = []
    for i, first, body in zip(batch.column("id").to_pylist(), batch.column("first").to_pylist(), batch.column("body"), strict=True):
        body = np.frombuffer(body.as_buffer(), dtype=np.uint64)
        x, y = rolling(body, length), rolling(mix(body ^ np.uint64(0x2545F4914F6CDD1D)), length)
        found.append((x.view(np.int64), y.view(np.int64), np.full(len(x), i), np.arange(first, first + len(x))))
    x, y, ids, starts = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.lexsort((starts, ids, y, x))
    x, y, ids, starts = x[order], y[order], ids[order], starts[order]
    a = np.append(0, np.flatnonzero((x[1:] != x[:-1]) | (y[1:] != y[:-1])) + 1)
    b = np.append(a[1:], len(x))
    name = mix(mix(ids[:1].view(np.uint64)) ^ np.uint64(starts[0]) ^ x[:1].view(np.uint64)).view(np.int64)
    places = [ids[i:j].tobytes() + starts[i:j].tobytes() for i, j in zip(a.tolist(), b.tolist(), strict=True)]
    return pa.RecordBatch.from_arrays(
        [pa.array(x[a]), pa.array(y[a]), pa.array(ids[a]), pa.array(ids[b - 1]), pa.array(np.repeat(name, len(a))), pa.array(places, pa.binary())],
        names=["x", "y", "least", "most", "batch", "places"])


def _after_witness(length: int):
    """The spans of a batch's windows in documents after the first that holds them; a batch is bounded, however hot its windows are."""

    def build(table: pa.Table) -> pa.Table:
        places = [np.frombuffer(p.as_buffer(), dtype=np.int64) for p in table.column("places")]
        docs = np.concatenate([p[:len(p) // 2] for p in places])
        starts = np.concatenate([p[len(p) // 2:] for p in places])
        later = docs > np.repeat(np.asarray(table.column("witness")), [len(p) // 2 for p in places])
        return pa.Table.from_batches([_spans(docs[later], starts[later], length)])

    return build


def covered_words(docs: DataFrame, *, length: int = 50, id_col: str = "doc_id", text_col: str = "text",
                  filter_bits: int = 1 << 24) -> DataFrame:
    """(id, spans): per document the word ranges [first, last) to remove, for documents that have any."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("binary").alias("text")).where("id is not null")
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = 1 + int(size / 100) // GROUP_KEYS

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for turn, batch in enumerate(slices(batches)):
            ids = np.asarray(batch.column("id")).astype(np.int64)
            text, _, _, key = _runs(*words(*buffer_of(batch.column("text"))), length)
            if len(key):
                yield blob_batch(list(key_blobs(ids[text], mix(key), parts, turn + int(ids[0]))))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = bit_place(np.asarray(batch.column("key")).astype(np.int64).view(np.uint64), filter_bits)
            yield pa.RecordBatch.from_arrays([pa.array(at)], names=["at"])

    # A shared key names its group and the low half of its hash: the same form is made of any prefix.
    shared = materialise(shared_keys(rows.mapInArrow(prefixes, KEY_BLOB), parts), "prefixes")
    per_key = shared.groupBy("key").agg(F.count("*").alias("n"))
    live = bit_table(spark, shared.select("key").mapInArrow(places, "at bigint").distinct(), filter_bits)
    common = bit_table(spark, per_key.where(F.col("n") > LONG_PREFIX).select("key").mapInArrow(places, "at bigint"), filter_bits)
    n_words = shared.count() * (2 * length)
    groups = 1 + n_words // GROUP_WORDS

    def form(key: np.ndarray) -> np.ndarray:
        key = mix(key)
        part = (key >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
        return (part << np.uint64(32)) | (key & np.uint64(0xFFFFFFFF))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = np.asarray(batch.column("id")).astype(np.int64)
            hashes, offsets = words(*buffer_of(batch.column("text")))
            text, first, last, key = _runs(hashes, offsets, length)
            keep = bit_hits(live, form(key)) if len(key) else np.empty(0, dtype=bool)
            text, first, last, key = text[keep], first[keep], last[keep], key[keep]
            group = np.where(bit_hits(common, form(key)), -1, (mix(key) % np.uint64(groups)).astype(np.int64)) if len(key) else key.astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(group, pa.int64()), pa.array(ids[text], pa.int64()), pa.array(first - offsets[text], pa.int64()),
                 pa.array([hashes[a:b + length].tobytes() for a, b in zip(first, last, strict=True)], pa.binary())],
                names=["part", "id", "first", "body"])

    snippets = materialise(rows.mapInArrow(cut, "part bigint, id bigint, first bigint, body binary"), "snippets")
    span = "id bigint, first bigint, last bigint"
    trees = snippets.where("part >= 0").groupBy("part").applyInArrow(_subtree(length), span)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _leaves(batch, length)

    leaf = "x bigint, y bigint, least bigint, most bigint, batch bigint, places binary"
    frequent = snippets.where("part < 0").select("id", "first", "body")
    # Equal snippets meet, in as many places as the rows fill batches, so one that a third of them equal fills no task.
    body, turns = F.xxhash64("body"), 1 + frequent.count() // BATCH_ROWS
    frequent = frequent.repartition(body, F.pmod(F.xxhash64("id"), F.lit(turns))).sortWithinPartitions(body)
    leaves = materialise(frequent.mapInArrow(whole, leaf), "leaves")
    nodes = leaves.groupBy("x", "y").agg(F.min("least").alias("witness"), F.max("most").alias("last")).where("witness < last").drop("last")
    met = leaves.join(nodes, ["x", "y"]).where("most > witness").select("batch", "witness", "places")
    long = met.groupBy("batch").applyInArrow(_after_witness(length), span)
    return trees.union(long).groupBy("id").agg(F.collect_set(F.struct("first", "last")).alias("spans"))


def remove_repeats(docs: DataFrame, *, length: int = 50, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept_sha256 and, with ``keep_text``, kept_text.

    Words are runs of anything but ASCII white space, unchanged; kept words are joined by one space.
    Windows are judged on the input. A null or empty text has no words. A row with a null id keeps all its
    words and is no witness; rows that repeat an id keep the words that only their own id repeats.
    Other columns are left out; an empty table gives an empty result.
    """
    spans = covered_words(docs, length=length, id_col=id_col, text_col=text_col)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("binary").alias("text"))
    joined = rows.join(spans, "id", "left").select("id", "text", F.col("spans.first").alias("first"), F.col("spans.last").alias("last"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for text, first, last in zip(*(batch.column(c).to_pylist() for c in ("text", "first", "last")), strict=True):
                parts = (text or b"").split()
                total = len(parts)
                if first:
                    gone = np.zeros(total + 1, dtype=np.int64)
                    np.add.at(gone, np.array(first), 1)
                    np.add.at(gone, np.minimum(np.array(last), total), -1)
                    parts = [w for w, g in zip(parts, np.cumsum(gone).tolist(), strict=False) if not g]
                kept = b" ".join(parts)
                out.append((total, total - len(parts), hashlib.sha256(kept).hexdigest(), kept if keep_text else None))
            n, gone, mark, kept = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(mark), pa.array(kept, pa.binary())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    done = joined.mapInArrow(apply, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept binary")
    return done.withColumn("kept_text", F.col("kept").cast("string")).drop("kept") if keep_text else done.drop("kept")
