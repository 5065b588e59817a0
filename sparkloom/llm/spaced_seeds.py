"""Benchmark decontamination by spaced seeds.

Texts are sequences of hashed words (runs of letters and digits, small letters).  Fixed masks pick nine of 9 or 10
neighbouring words and ignore the other, so a hash survives a substitution at the ignored place.  The seeds of the test
items are joined with those of the training texts; around every hit the item is laid over the text and the stretch with the
most agreement is verified: it counts if at least `min_words` words agree (all words of a shorter item) and at least four in
five of those it spans.

No stretch that counts is without a seed.  A word that differs costs four that agree, and no stretch starts with a loss: so it
starts with five or more words that agree, and with the run after the first word that differs these are nine or more.
The masks are nine words in a row and nine with a gap after the 5th, 6th, 7th or 8th.

The items are taken in blocks of bounded size; a block is broadcast and all documents are read once per block.  Each
document is judged alone, so a passage in a third of all documents is no hot key.

Defined results: null texts and items have no words; items of nine words or less are looked up as a whole, those under
`SHORTEST` words not at all; rows that share an id are reported row by row; extra columns play no part.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm import common

SHORTEST = 5
MIN_WORDS = 10
BLOCK_WORDS = 200_000
PENALTY = 4  # a stretch gains 1 for a word that agrees and loses this for another: four in five
WEIGHT = 2 * PENALTY + 1  # words that agree before the second one that differs
_FILTER = 1 << 22
_ODD = np.random.default_rng(11).integers(1, 1 << 63, 16, dtype=np.uint64) | np.uint64(1)
_ALNUM: list[np.ndarray] = []


def words(text: str) -> np.ndarray:
    """Hashes of the words of a text."""
    if not _ALNUM:
        _ALNUM.append(np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000))
    out = []
    for piece in common.pieces(text.lower()):
        points = np.frombuffer((" " + piece + " ").encode("utf-32-le"), np.uint32)
        out.append(common.run_hashes(points.astype(np.uint64), _ALNUM[0][points])[0])
    return np.concatenate(out)


def _masks_for(n: int, min_words: int = MIN_WORDS) -> list[tuple[int, ...]]:
    """Kept places of the masks for an item of n words."""
    if n < SHORTEST:
        return []
    weight = min(WEIGHT, min_words, n)
    gaps = range(PENALTY + 1, weight) if weight < n else ()
    return [tuple(range(weight))] + [tuple(i + (i >= gap) for i in range(weight)) for gap in gaps]


def _seed(w: np.ndarray, mask: tuple[int, ...], span: int) -> np.ndarray:
    n = len(w) - span + 1
    with np.errstate(over="ignore"):
        h = np.full(n, np.uint64(sum(1 << i for i in mask) | span << 20))
        for i in mask:
            h = (h ^ w[i:i + n]) * _ODD[i]
            h ^= h >> np.uint64(31)
        return h


@dataclass(frozen=True)
class Index:
    """Seeds of a block of items."""

    items: list
    texts: list[np.ndarray]
    shapes: list[tuple[tuple[int, ...], int]]
    keys: np.ndarray
    owner: np.ndarray
    place: np.ndarray
    filter: np.ndarray


def build_index(items: list[tuple[object, str]], min_words: int = MIN_WORDS) -> Index:
    texts = [words(t or "") for _, t in items]
    shapes: set = set()
    keys, owner, place = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k, w in enumerate(texts):
        for mask in _masks_for(len(w), min_words):
            span = mask[-1] + 1
            shapes.add((mask, span))
            h = _seed(w, mask, span)
            keys.append(h)
            owner.append(np.full(len(h), k))
            place.append(np.arange(len(h)))
    flat = np.concatenate(keys)
    order = np.argsort(flat, kind="stable")
    bits = np.zeros(_FILTER, bool)
    bits[(flat & np.uint64(_FILTER - 1)).astype(np.int64)] = True
    return Index([i for i, _ in items], texts, sorted(shapes), flat[order], np.concatenate(owner)[order], np.concatenate(place)[order], bits)


def best_stretch(same: np.ndarray) -> tuple[int, int, int]:
    """Start, end and agreeing words of the stretch with the largest gain; of several, that with the most agreeing words."""
    gain = np.concatenate([[0], np.cumsum(np.where(same, 1, -PENALTY))])
    low = np.minimum.accumulate(gain)
    best = []
    for end in np.flatnonzero(gain - low == (gain - low).max()).tolist():
        start = int(np.flatnonzero(gain[:end + 1] == low[end])[-1])
        best.append((int(same[start:end].sum()), -start, end))
    agree, start, end = max(best)
    return -start, end, agree


def overlaps(text: str, index: Index, min_words: int = MIN_WORDS):
    """(item number, words of the item, agreeing words, stretch, first word in the text) for items found in a text."""
    w = words(text)
    pairs = []
    for mask, span in index.shapes:
        if len(w) < span:
            continue
        h = _seed(w, mask, span)
        at = np.flatnonzero(index.filter[(h & np.uint64(_FILTER - 1)).astype(np.int64)])
        left, right = np.searchsorted(index.keys, h[at]), np.searchsorted(index.keys, h[at], side="right")
        n = right - left
        if not n.any():
            continue
        rows = np.repeat(left, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        pairs.append(np.stack([index.owner[rows], np.repeat(at, n) - index.place[rows]], axis=1))
    found: dict[int, tuple] = {}
    for k, shift in np.unique(np.concatenate(pairs), axis=0).tolist() if pairs else ():
        item = index.texts[k]
        a, b = max(0, -shift), min(len(item), len(w) - shift)
        start, end, agree = best_stretch(item[a:b] == w[a + shift:b + shift])
        if agree >= min(min_words, len(item)) and agree > found.get(k, (0, 0, 0))[1]:
            found[k] = (len(item), agree, end - start, a + shift + start)
    return [(k, *v) for k, v in found.items()]


# ---------------------------------------------------------------------------
# operator
# ---------------------------------------------------------------------------


def find_leaks(docs: DataFrame, benchmark: DataFrame, min_words: int = MIN_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, item_words, agreeing_words, stretch_words, first_word): items found in documents, one row each."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    items = items.withColumn("size", F.length("text") / 2 + 1)  # at most so many words
    blocks = max(1, int(-(-(items.agg(F.sum("size")).first()[0] or 0) // block_words)))
    items = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    if blocks > 1:
        items = common.staged(items, "benchmark")
    source = common.with_ids(docs)
    out = None
    for k in range(blocks):
        block = [(r["item_id"], r["text"]) for r in items.where(F.col("block") == k).collect()]
        found = source.mapInArrow(common.released(_search(spark.sparkContext.broadcast(build_index(block, min_words)), min_words)), _SCHEMA)
        out = found if out is None else out.union(found)
    return out


_SCHEMA = "doc_id long, item_id long, item_words long, agreeing_words long, stretch_words long, first_word long"


def _search(shared, min_words: int):
    def run(batches):
        index = shared.value
        for batch in batches:
            rows = [(doc_id, index.items[k], *rest)
                    for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True)
                    for k, *rest in overlaps(text or "", index, min_words)]
            names = [x.split()[0] for x in _SCHEMA.split(", ")]
            yield pa.RecordBatch.from_pydict({n: pa.array([r[i] for r in rows], pa.int64()) for i, n in enumerate(names)})
    return run


def clean(docs: DataFrame, benchmark: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents in which no item is found, with all their columns."""
    leaked = find_leaks(docs, benchmark, min_words).select(F.col("doc_id").alias("_leaked")).distinct()
    return docs.join(leaked, docs["doc_id"].eqNullSafe(leaked["_leaked"]), "left_anti")
