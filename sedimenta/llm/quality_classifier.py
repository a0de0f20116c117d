"""Quality scores from supervised subword embeddings.

A document is the average of the learned vectors of its words and their character n-grams, all hashed to
buckets; a softmax layer on top gives the class. Vectors and layer are trained together by stochastic gradient
descent in numpy. Since the layer is linear, a token adds one number to a document's margin.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.hashing import slices
from sedimenta.llm.tokens import TokenTable

_GRAMS = (3, 4)


@dataclass(frozen=True)
class Model:
    margin: np.ndarray  # per bucket, of class 1 over class 0
    bias: float


def features(token: str, buckets: int) -> list[int]:
    """Buckets of a token: itself, then its character n-grams."""
    marked = f"<{token}>"
    grams = [marked[i:i + n] for n in _GRAMS for i in range(len(marked) - n + 1)]
    return [crc32(f"w {token}".encode()) % buckets, *(crc32(g.encode()) % buckets for g in grams)]


def learn(docs: DataFrame, labels: DataFrame, train: Column, *, label_col: str = "quality", sample_rows: int = 3000,
          buckets: int = 1 << 15, dim: int = 8, epochs: int = 12, rate: float = 2.0) -> Model:
    """A model of the labelled rows where ``train`` (over doc_id) holds.

    At most about ``sample_rows`` rows, chosen by a hash of the id, come to the driver as bucket counts;
    all documents are scored later.
    """
    marked = labels.select("doc_id", F.col(label_col).alias("y")).where(F.col("y").isin(0, 1) & train).groupBy("doc_id").agg(F.max("y").alias("y"))
    total = marked.count()
    keep = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(min(1.0, sample_rows / max(total, 1)) * 1_000_000)
    rows = docs.select("doc_id", "text").where(keep & F.col("text").isNotNull()).join(marked.where(keep), "doc_id")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            at, n = [], []
            for text in batch.column("text").to_pylist():
                table = np.zeros(buckets, dtype=np.int32)
                for token, times in Counter(text.split()).items():
                    np.add.at(table, features(token, buckets), times)
                at.append(np.flatnonzero(table).astype(np.int32).tobytes())
                n.append(table[table > 0].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(at, pa.binary()), pa.array(n, pa.binary())], names=["doc_id", "y", "at", "n"])

    counted = rows.select(F.col("doc_id").cast("bigint"), F.col("y").cast("int"), "text").mapInArrow(count, "doc_id bigint, y int, at binary, n binary")
    examples = sorted(((r.doc_id, r.y, np.frombuffer(r.at, np.int32), np.frombuffer(r.n, np.int32)) for r in counted.collect()), key=lambda e: e[:2])
    return train_vectors([e[1:] for e in examples], buckets, dim, epochs, rate)


def train_vectors(examples: list[tuple[int, np.ndarray, np.ndarray]], buckets: int, dim: int, epochs: int, rate: float) -> Model:
    """Softmax over averaged vectors by SGD, one document a step, with a falling rate."""
    random = np.random.default_rng(7)
    vectors = random.uniform(-1 / dim, 1 / dim, (buckets, dim))
    layer, bias = random.normal(0, 0.1, (2, dim)), np.zeros(2)
    examples = [(y, at, n / n.sum()) for y, at, n in examples if len(at)]
    steps = max(1, epochs * len(examples))
    for step, k in enumerate(k for _ in range(epochs) for k in random.permutation(len(examples))):
        y, at, share = examples[k]
        speed = rate * (1 - step / steps)
        mean = share @ vectors[at]
        z = layer @ mean + bias
        p = np.exp(z - z.max())
        error = p / p.sum()
        error[y] -= 1
        vectors[at] -= speed * np.outer(share, error @ layer) * min(len(at), 50)
        layer -= speed * 0.1 * np.outer(error, mean)
        bias -= speed * 0.1 * error
    return Model(vectors @ (layer[1] - layer[0]), float(bias[1] - bias[0]))


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) per row: the probability of label 1. A null or empty text gets the bias alone.

    Every row gives a row, repeated ones and null ids too; other columns are left out.
    """
    buckets = len(model.margin)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def of(tokens: list[str]) -> np.ndarray:
        places = [features(token, buckets) for token in tokens]
        return np.array([(model.margin[at].sum(), len(at)) for at in places])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = TokenTable(of, 2)
        for batch in slices(batches):
            table.fresh()
            sums = []
            for text in batch.column("text").to_pylist():
                places = table.rows((text or "").split())
                margin, n = table.values[places].sum(axis=0) if len(places) else (0.0, 1.0)
                sums.append(margin / n + model.bias)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-np.array(sums))))], names=["doc_id", "score"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")
