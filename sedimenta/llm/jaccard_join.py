"""N-gram Jaccard join by parity sketches.

The set of a document (its distinct word shingles) is hashed into a sketch of k 64-bit words: every
shingle is XORed into one word. A shingle that only one of two documents has changes at most one word, so
the Hamming distance of two sketches, in words, is no larger than their symmetric difference. At a similarity of
t a document of n shingles differs from a partner by at most d = (n + n / t) * (1 - t) / (1 + t)
shingles; so of any d + 1 words, taken in one global order, a linked pair shares one (pigeonhole).
k grows with the size band, a power of two; a document near the next band's sizes also joins that band.

Order: words that hold a rare shingle come first, words made of frequent shingles only come last, empty words
after them. Frequency is estimated from a sample of documents; it moves work, never results. Candidates
pass a bit sketch of the same kind and are then verified on their whole sets. Exact copies of a set are one class from the start.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.cells import Sets, link_components, parity_sketch
from sedimenta.llm.hashing import buffer_of, mix, shingle_sets, slices, words
from sedimenta.llm.links import GROUP_KEYS, KEY_BLOB, bit_hits, bit_place, bit_table, blob_batch, ids_table, key_blobs, shared_keys
from sedimenta.llm.memory import giving_back
from sedimenta.session import discard, materialise

#: Shingles per sketch word at the upper end of a band. The fewer, the more words there are to choose rare ones from.
_LOAD = 1.25
#: Bits of a shingle's hash that the exact check does without: it compares 48.
_SPARE = np.uint64(16)
#: Documents per sampled document for the estimate of frequent shingles, and the count that marks one.
_SAMPLE, _FREQUENT = 64, 3


def _sets(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, list[np.ndarray]]:
    hashes, offsets = words(*buffer_of(batch.column("text")), lower=True)
    return np.asarray(batch.column("id")).astype(np.int64), shingle_sets(hashes, offsets, k)


def _most_apart(n: int, percent: int) -> int:
    """The largest symmetric difference of a set of n items and a linked partner."""
    return (n + 100 * n // percent) * (100 - percent) // (100 + percent)


def sketch_keys(items: np.ndarray, percent: int, hot: np.ndarray) -> np.ndarray:
    """The sketch words, as 64-bit keys, that a set joins on; ``items`` are its sorted distinct hashes."""
    n = len(items)
    if not n:
        return np.empty(0, dtype=np.uint64)
    need, out = _most_apart(n, percent) + 1, []
    frequent, toggles = bit_hits(hot, items), mix(items ^ np.uint64(0x5851F42D4C957F2D))
    band = n.bit_length()  # sizes below 2 ** band
    for scheme in [band] + [band + 1] * (100 * n // percent >= 1 << band):
        top = 1 << scheme
        k = max(_most_apart(top - 1, percent) + 1, int(top / _LOAD))
        place = (items >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)
        starts = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        where = place[starts]
        label = mix(where | np.uint64(scheme << 40))
        keys = mix(np.bitwise_xor.reduceat(toggles, starts) ^ label)
        if len(keys) > need:
            late = np.logical_and.reduceat(frequent, starts).astype(np.uint64)
            keys = keys[np.argpartition((keys >> np.uint64(1)) | (late << np.uint64(63)), need - 1)[:need]]
        elif len(keys) < need:
            empty = np.setdiff1d(np.arange(k, dtype=np.uint64), where, assume_unique=True)[:need - len(keys)]
            keys = np.append(keys, mix(mix(empty | np.uint64(scheme << 40))))
        out.append(keys)
    return np.concatenate(out)


def jaccard_classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 5,
                    percent: int = 75, hot_bits: int = 1 << 22, filter_bits: int = 1 << 24) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs``: the components of Jaccard links.

    Words are runs of anything but ASCII white space, with A-Z in lower case. Two documents link when
    100 * intersection >= ``percent`` * union of their distinct shingles; a text with fewer words is one
    shingle, a null or empty text has none and links with nothing. component_id is the smallest
    doc_id reachable. A null id gets a null component and takes no part; repeated rows link like any copies;
    other columns are left out; an empty table gives an empty result.
    """
    spark, k = docs.sparkSession, words_per_shingle
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("binary").alias("text"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hashes, offsets = words(*buffer_of(batch.column("text")), lower=True)
            sets = shingle_sets(hashes, offsets, k)
            sketches = [parity_sketch(s >> _SPARE) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([hashlib.md5(s.tobytes()).digest() for s in sets], pa.binary()), pa.array(sketches, pa.binary())],
                names=["id", "n", "mark", "sketch"])

    profile = materialise(rows.mapInArrow(giving_back(describe), "id bigint, n bigint, mark binary, sketch binary"), "profile")
    whole = profile.where("id is not null and n > 0")
    classes = materialise(whole.groupBy("mark").agg(F.min("id").alias("rep"), F.max("n").alias("n")), "classes")
    entries = classes.agg(F.sum("n")).first()[0] or 0
    parts = 1 + int(entries * 0.5) // GROUP_KEYS
    named = rows.where("id is not null")

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            _, sets = _sets(batch, k)
            at, n = np.unique(bit_place(np.concatenate(sets), hot_bits), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n)], names=["at", "n"])

    sampled = named.where(F.pmod(F.xxhash64("id"), F.lit(_SAMPLE)) == 0).mapInArrow(sample, "at bigint, n bigint")
    hot = bit_table(spark, sampled.groupBy("at").agg(F.sum("n").alias("n")).where(F.col("n") >= _FREQUENT).select("at"), hot_bits)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for turn, batch in enumerate(slices(batches)):
            ids, sets = _sets(batch, k)
            once = {s.tobytes(): (i, s) for i, s in reversed(list(zip(ids.tolist(), sets, strict=True)))}
            keys = [sketch_keys(s, percent, hot) for _, s in once.values()]
            owners = np.repeat(np.array([i for i, _ in once.values()], dtype=np.int64), [len(x) for x in keys])
            if len(owners):
                yield blob_batch(list(key_blobs(owners, np.concatenate(keys), parts, turn + int(ids[0]))))

    # A copy that stood first in its slice stands for its class from here on.
    reps = whole.select("id", "mark").join(classes.select("mark", "rep"), "mark").select("id", "rep")
    members = shared_keys(named.mapInArrow(giving_back(emit), KEY_BLOB), parts)
    members = members.join(materialise(reps, "reps"), "id").select("key", F.col("rep").alias("id")).distinct()
    members = materialise(members, "members")
    two = members.groupBy("key").agg(F.min("id").alias("x"), F.max("id").alias("y")).where("x <> y").select("key")

    def pick(table: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = np.asarray(batch.column("id")).astype(np.int64)
                batch = batch.filter(pa.array(bit_hits(table, ids.view(np.uint64))))
                for piece in slices([batch]):
                    ids, sets = _sets(piece, k)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids), pa.array([(s >> _SPARE).tobytes() for s in sets], pa.binary())], names=["id", "payload"])

        return giving_back(run)

    def picked(ids: DataFrame) -> DataFrame:
        found = named.mapInArrow(pick(ids_table(ids, filter_bits)), "id bigint, payload binary")
        return found.join(ids, "id").dropDuplicates(["id"])

    def build(payloads: pa.Array) -> Sets:
        data, offsets = buffer_of(payloads)
        return data.view(np.uint64), offsets // 8

    every, members = members, materialise(members.join(materialise(two, "keys"), "key"), "members")
    discard(every)
    sketches = whole.select("id", "n", "sketch").join(members.select("id").distinct(), "id").dropDuplicates(["id"])
    labels = link_components(members, materialise(sketches, "sketches"), picked, build, percent)
    found = classes.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select("mark", F.coalesce("component", "rep").alias("component"))
    linked = whole.join(materialise(found, "classes"), "mark").select("id", "n", "component")
    alone = profile.where("id is null or n = 0").select("id", "n", F.col("id").alias("component"))
    return linked.union(alone).select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
