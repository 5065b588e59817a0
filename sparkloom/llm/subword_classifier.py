"""Quality classifier on learned subword embeddings.

Every word, every character 3- and 4-gram inside the marked word and every pair of neighbouring words is hashed to a row
of one embedding matrix.  A document is the mean of its rows; a linear layer and softmax give the class.  Matrix and layer
are trained together by stochastic gradient descent in numpy on a bounded sample of labelled documents; features are made
on the executors, and only the sample's sparse counts reach the driver.

A score is linear in the mean up to the softmax, so scoring needs one number per row of the matrix: the difference of the
two class logits.  Scores of whole texts of any length are sums over pieces of a text.

Defined results: null is the empty text; a text without words has the constant feature alone and gets its score; without
any label all scores are 0.5; labels that are null play no part, several labels of one document are averaged and a mean of
0.5 counts as 1; rows of `documents` that share an id are scored one by one and teach once; a very long text is scored whole, piece
by piece; equal scores stay equal; an empty table gives no rows; other columns, of whatever name, play no part.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.llm import common

BUCKETS = 1 << 17
DIM = 12
EPOCHS = 8
SAMPLE = 3000
_RNG = np.random.default_rng(7)
_ODD = _RNG.integers(1, 1 << 63, 8, dtype=np.uint64) | np.uint64(1)
_SPACE = np.uint64(1)  # stands for the ends of words
_CONSTANT = 0


def _bucket(h: np.ndarray, kind: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h + np.uint64(kind)) * _ODD[kind]
        h ^= h >> np.uint64(32)
        h *= _ODD[7]
        return (h >> np.uint64(40)).astype(np.int64) % (BUCKETS - 1) + 1


def features(text: str, last: list):
    """Buckets of the features of a piece of text that starts and ends at a word border, in arrays.

    `last` holds the hash of the last word of the pieces before, if any, and gets that of this one.
    """
    points = np.frombuffer((" " + text + " ").encode("utf-32-le"), np.uint32)
    gap = (points == 32) | ((points >= 9) & (points <= 13))
    c = points.astype(np.uint64)
    c[gap] = _SPACE
    inner = ~gap
    with np.errstate(over="ignore"):
        two = c[:-1] * _ODD[5] + c[1:]
        three = two[:-1] * _ODD[6] + c[2:]
        yield _bucket(three[inner[1:-1]], 1)
        if len(c) > 3:
            four = three[:-1] * _ODD[6] + c[3:]
            ok = inner[1:-2] & inner[2:-1]
            yield _bucket(four[ok], 2)
        words = common.run_hashes(c, inner)[0]
        yield _bucket(words, 3)
        words = np.concatenate([np.array(last, np.uint64), words])
        last[:] = words[-1:].tolist()
        if len(words) > 1:
            pair = words[:-1] * _ODD[5] + words[1:]
            pair[words[:-1] == words[1:]] = np.uint64(0)  # a repeated word, whichever it is
            yield _bucket(pair, 4)


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets and their shares of all features."""
    total = np.zeros(BUCKETS, np.int64)
    total[_CONSTANT] = 1
    last: list = []
    for piece in common.pieces(text):
        for f in features(piece, last):
            total += np.bincount(f, minlength=BUCKETS)
    seen = np.flatnonzero(total)
    return seen.astype(np.int32), (total[seen] / total.sum()).astype(np.float32)


def _sums(texts: list[str], values: np.ndarray) -> np.ndarray:
    """Mean of `values` over the features of each text."""
    out = np.empty(len(texts))
    for i, text in enumerate(texts):
        total, n, last = float(values[_CONSTANT]), 1, []
        for piece in common.pieces(text):
            for f in features(piece, last):
                total += float(values[f].sum())
                n += len(f)
        out[i] = total / n
    return out


@dataclass(frozen=True)
class Model:
    """values[b]: how much a feature in bucket b moves the logit of class 1 against class 0."""

    values: np.ndarray


def train(samples: list[tuple[np.ndarray, np.ndarray, int]], dim: int = DIM, epochs: int = EPOCHS, rate: float = 4.0,
          seed: int = 0) -> Model:
    """Stochastic gradient descent over (buckets, shares, label); classes weigh alike."""
    if not samples:
        return Model(np.zeros(BUCKETS))
    rng = np.random.default_rng(seed)
    matrix = rng.uniform(-1 / dim, 1 / dim, (BUCKETS, dim)).astype(np.float32)
    layer = np.zeros((2, dim), np.float32)
    n = np.bincount([y for _, _, y in samples], minlength=2)
    weight = len(samples) / (2.0 * np.maximum(n, 1))
    steps, done = epochs * len(samples), 0
    for _ in range(epochs):
        for k in rng.permutation(len(samples)):
            buckets, shares, y = samples[k]
            speed = rate * (1 - done / steps) * min(weight[y], 4.0)
            rows = matrix[buckets]
            mean = shares @ rows
            logits = layer @ mean
            p = np.exp(logits - logits.max())
            p /= p.sum()
            slope = -p
            slope[y] += 1
            back = slope @ layer
            layer += (speed * 0.1) * slope[:, None] * mean[None, :]
            # rows share the slope by their weight in the mean; the scale keeps steps alike for short and long texts
            matrix[buckets] = rows + (speed * shares / np.sqrt((shares * shares).sum()))[:, None] * back[None, :]
            done += 1
    return Model((matrix @ (layer[1] - layer[0])).astype(np.float64))


# ---------------------------------------------------------------------------
# operator
# ---------------------------------------------------------------------------


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """crc32 of the id as text leaves 1 modulo 3; such rows never teach."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample_of(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> list:
    """At most `sample` labelled documents, those with the smallest hashes of their ids, as (buckets, shares, label)."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("y"))
    known = known.where("doc_id IS NOT NULL AND y IS NOT NULL").where(~held_out()).groupBy("doc_id").agg(F.avg("y").alias("y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def run(batches):
        for batch in batches:
            found = [counts(t or "") for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch["doc_id"], "y": batch["y"],
                "buckets": pa.array([b.tobytes() for b, _ in found], pa.binary()),
                "shares": pa.array([s.tobytes() for _, s in found], pa.binary())})

    # the sample's size is a parameter, so the broadcasts are bounded; rows that share an id teach once, by the smallest hash
    source = common.with_ids(docs).withColumn("h", F.xxhash64(F.coalesce("text", F.lit("")))).join(F.broadcast(chosen), "doc_id")
    one = source.groupBy("doc_id").agg(F.min("h").alias("h"))
    rows = source.join(F.broadcast(one), ["doc_id", "h"]).dropDuplicates(["doc_id"]).select("doc_id", "text", "y").mapInArrow(
        run, "doc_id long, y double, buckets binary, shares binary").collect()
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["buckets"])))
    return [(np.frombuffer(r["buckets"], np.int32), np.frombuffer(r["shares"], np.float32), int(r["y"] >= 0.5)) for r in rows]


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Model:
    return train(sample_of(docs, labels, label, sample))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every document: the softmax share of class 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model.values)  # BUCKETS numbers, whatever the input

    def run(batches):
        values = shared.value
        for batch in batches:
            z = _sums([t or "" for t in batch["text"].to_pylist()], values)
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "score": pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))), pa.float64())})
    return common.with_ids(docs).mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The documents with a score of `threshold` or more, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model.values)

    def run(batches):
        for batch in batches:
            z = _sums([t or "" for t in batch["text"].to_pylist()], shared.value)
            yield batch.filter(pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))) >= threshold, pa.bool_()))
    return docs.mapInArrow(common.released(run), docs.schema)


def quality(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    scored = score(docs, fit(docs, labels, label, sample))
    return scored.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
