"""Spelling variants by PartEnum signatures.

A word is seen as its letter multiset, a binary vector over (letter, occurrence).  One inserted, deleted or replaced code point
moves it by at most two in Hamming distance.  The letters are dealt to five partitions; two differences touch at most two of
them, so near words agree on three whole partitions.  Each word emits one exact signature for every three of the five, words with
an equal signature meet in one bucket, and what meets is verified letter by letter.

Anagrams share all signatures, so a bucket is not paired off.  Inside it, words line up by what is left of them without one
place: replaced places meet at (place, rest), a deleted place meets the shorter word.  A pair counts only in the first signature
that it shares, so nothing is counted twice and no pairs are sent: a bucket sends per word the number of near words and the best.
A bucket of more than `hot` words is dealt by halves: near words with m code points in the shorter agree on their first m // 2 or
on the rest, which the place of the difference decides.

Defined results: null and empty texts have no words; a very long text or run costs its length once; rows that share a doc_id are
read as they stand, each with its occurrences; a null doc_id writes nothing before the colon; ties of the best go to the smaller
word by code points; an empty table gives no rows; other columns, of whatever name, play no part.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm import common

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
RUN = "[A-Za-zÀ-ÿ]{%d,}"
SLIP = 199  # one (document, run) in so many loses a code point
MIN_CHARS, MIN_COUNT, TIMES = 6, 5, 5
HELD_WORDS = 400_000  # words that a task sums up before it sends them
HOT = 50_000
PART_ROWS = 200_000  # (signature, word) rows that a task is planned for

PARTS, DIFFER = 5, 2
SIGNATURES = list(combinations(range(PARTS), PARTS - DIFFER))
#: The first signature that leaves out the partitions of a bit mask; masks of more than two partitions have none.
FIRST = np.array([next((i for i, s in enumerate(SIGNATURES) if not any(m >> g & 1 for g in s)), -1) for m in range(1 << PARTS)])
#: Frequent letters go to different partitions; all others by their number.
_LETTERS = "etaoinshrdlcumwfgypbvkjxqz"
_PART = np.arange(0x110000, dtype=np.int64) % PARTS
_PART[[ord(c) for c in _LETTERS]] = np.arange(len(_LETTERS)) % PARTS


# ---------------------------------------------------------------------------
# words
# ---------------------------------------------------------------------------


def slipped(doc_id: int | None, run: str, start: int) -> str:
    """The run, or what is left of it where the hash of (document, run) asks for a slip; `start` is the crc of the id and colon."""
    h = zlib.crc32(run.encode(), start)
    if h % SLIP:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _counted(min_chars: int):
    pattern = re.compile(RUN % min_chars)

    def send(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"word": pa.array(list(held), pa.string()), "n": pa.array(list(held.values()), pa.int64())})

    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                if not text:
                    continue
                start = zlib.crc32(b"%d:" % doc_id if doc_id is not None else b":")
                for found, n in Counter(pattern.findall(text.encode().translate(LOWER).decode())).items():
                    word = slipped(doc_id, found, start)
                    if len(word) >= min_chars:
                        held[word] += n
                if len(held) > HELD_WORDS:
                    yield send(held)
                    held.clear()
        yield send(held)
    return run


def vocabulary(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    counted = common.with_ids(docs).mapInArrow(_counted(min_chars), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ---------------------------------------------------------------------------
# signatures
# ---------------------------------------------------------------------------

_M = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points in a row, and the length of each word."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint64), np.array([len(w) for w in words], np.int64)


def signatures(words: list[str]) -> np.ndarray:
    """(len(words), len(SIGNATURES)) hashes of the letter multisets on every three partitions."""
    points, lengths = _points(words)
    own = np.repeat(np.arange(len(words)), lengths)
    parts = np.zeros((len(words), PARTS), np.uint64)
    with np.errstate(over="ignore"):
        np.add.at(parts, (own, _PART[points.astype(np.int64)]), _mix(points + _M))
        parts = _mix(parts + np.arange(1, PARTS + 1, dtype=np.uint64) * _M)
        return np.stack([_mix(parts[:, list(s)].sum(axis=1, dtype=np.uint64) + np.uint64(i) * _M) for i, s in enumerate(SIGNATURES)], axis=1)


def _signed(batches):
    for batch in batches:
        words = batch["word"].to_pylist()
        k = len(SIGNATURES)
        for a in range(0, len(words), 20_000):
            part = batch.slice(a, 20_000)
            keys = signatures(words[a:a + 20_000]).view(np.int64).ravel()
            at = pa.array(np.repeat(np.arange(part.num_rows), k))
            yield pa.RecordBatch.from_pydict({
                "sig": pa.array(np.tile(np.arange(k, dtype=np.int32), part.num_rows)), "key": pa.array(keys),
                "word": part["word"].take(at), "n": part["n"].take(at)})


def _dealt(rows: DataFrame, hot: int) -> DataFrame:
    """Rows with the bucket they go to: their signature or, where that is hot, the four halves the word can share there."""
    crowded = common.staged(rows.groupBy("key").count().where(F.col("count") > hot).select("key", F.lit(True).alias("hot")), "hot")
    whole = F.array(F.struct(F.lit(0).alias("m"), F.lit(0).alias("side"), F.col("key").alias("bucket")))

    def half(m, side):
        head = F.floor(m / 2).cast("int")
        text = F.substring("word", F.lit(1), head) if side == 0 else F.substring("word", F.length("word") - m + head + 1, m)
        return F.struct(m.alias("m"), F.lit(side).alias("side"), F.xxhash64("key", m, F.lit(side), text).alias("bucket"))

    halves = F.array(*(half(F.length("word") - less, side) for less in (0, 1) for side in (0, 1)))
    return (rows.join(crowded, "key", "left").withColumn("at", F.explode(F.when(F.col("hot"), halves).otherwise(whole)))
            .select("sig", "word", "n", "at.m", "at.side", "at.bucket"))


# ---------------------------------------------------------------------------
# buckets
# ---------------------------------------------------------------------------

_BASE = 0x9E3779B97F4A7C15
_NEAR = "word string, n_near long, best_n long, best string"


def _rests(words: list[str]):
    """Per code point: its word, its place, the point, and a hash of the word without it; per word: length and hash."""
    points, lengths = _points(words)
    starts = np.cumsum(lengths) - lengths
    own = np.repeat(np.arange(len(words)), lengths)
    place = np.arange(len(points)) - starts[own]
    longest = int(lengths.max(initial=0))
    with np.errstate(over="ignore"):
        up = np.cumprod(np.r_[np.uint64(1), np.full(longest, np.uint64(_BASE))])
        term = _mix(points + _M) * up[place]
        before = np.r_[np.uint64(0), np.cumsum(term, dtype=np.uint64)]
        total = before[starts + lengths] - before[starts]
        left = before[:-1] - before[starts[own]]
        rest = left + (total[own] - left - term) * np.uint64(pow(_BASE, -1, 1 << 64))
    return own, place, points, rest, lengths, total


def _key(bucket: np.ndarray, rest: np.ndarray, kind: np.ndarray | int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mix(_mix(bucket + _M * (np.asarray(kind, dtype=np.uint64) + np.uint64(1))) + rest)


def _replaced(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of equal keys; a key is held by at most one word for each code point at its place."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    a, b, step = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 1
    while step < len(key) and (same := key[step:] == key[:-step]).any():
        a.append(order[:-step][same])
        b.append(order[step:][same])
        step += 1
    return np.concatenate(a), np.concatenate(b)


def near_pairs(words: list[str], sig: np.ndarray, m: np.ndarray, side: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows in one bucket whose words differ by one code point and share no signature before this one."""
    own, place, points, rest, lengths, total = _rests(words)
    part = np.int64(1) << _PART[points.astype(np.int64)]
    half, whole = (m // 2)[own], m[own] == 0
    here = whole | np.where(side[own] == 0, place >= half, place < half)

    at = np.flatnonzero(here & (whole | (m[own] == lengths[own])))
    i, j = _replaced(_key(bucket[own[at]], rest[at], place[at] + 2))
    i, j = at[i], at[j]
    a, b, mask = [own[i]], [own[j]], [part[i] | part[j]]

    last = np.r_[(points[1:] != points[:-1]) | (own[1:] != own[:-1]), True] if len(points) else np.zeros(0, bool)
    at = np.flatnonzero(here & last & (whole | (m[own] == lengths[own] - 1)))  # of equal neighbours the last one goes
    shorter = np.flatnonzero((m == 0) | (m == lengths))
    key = _key(bucket[shorter], total[shorter], 1)
    order = np.argsort(key, kind="stable")
    key, shorter = key[order], shorter[order]
    if len(key) and len(at):
        asked = _key(bucket[own[at]], rest[at], 1)
        spot = np.minimum(np.searchsorted(key, asked), len(key) - 1)
        hit = key[spot] == asked
        a.append(own[at[hit]])
        b.append(shorter[spot[hit]])
        mask.append(part[at[hit]])
    a, b, mask = np.concatenate(a), np.concatenate(b), np.concatenate(mask)
    first = FIRST[mask] == sig[a]
    a, b = a[first], b[first]
    sure = np.array([one_apart(words[x], words[y]) for x, y in zip(a.tolist(), b.tolist(), strict=True)], bool)
    return a[sure], b[sure]


def one_apart(x: str, y: str) -> bool:
    """Whether one inserted, deleted or replaced code point makes one word the other."""
    if len(x) < len(y):
        x, y = y, x
    if x == y or len(x) - len(y) > 1:
        return False
    i = next((i for i, (c, d) in enumerate(zip(x, y, strict=False)) if c != d), len(y))
    return x[i + 1:] == (y[i + 1:] if len(x) == len(y) else y[i:])


def _near(table: pa.Table) -> pa.Table:
    words, n = table["word"].to_pylist(), table["n"].to_numpy()
    sig, m, side = (table[c].to_numpy().astype(np.int64) for c in ("sig", "m", "side"))
    a, b = near_pairs(words, sig, m, side, table["bucket"].to_numpy().view(np.uint64))
    src, dst = np.concatenate([a, b]), np.concatenate([b, a])
    order = sorted(set(dst.tolist()), key=words.__getitem__)
    rank = np.zeros(len(words), np.int64)
    rank[order] = np.arange(len(order))
    by = np.lexsort((rank[dst], -n[dst], src))
    src, dst = src[by], dst[by]
    first = np.flatnonzero(np.r_[True, src[1:] != src[:-1]]) if len(src) else np.zeros(0, np.int64)
    return pa.table({"word": pa.array([words[i] for i in src[first]], pa.string()),
                     "n_near": pa.array(np.diff(np.r_[first, len(src)]), pa.int64()),
                     "best_n": pa.array(n[dst[first]], pa.int64()), "best": pa.array([words[i] for i in dst[first]], pa.string())})


def near_words(words: DataFrame, hot: int = HOT) -> DataFrame:
    """(word, n_near, best_n, best) of the words that have near ones; best is the most frequent of them."""
    n_parts = max(common.default_parallelism(words.sparkSession), -(-words.count() * len(SIGNATURES) // PART_ROWS))
    dealt = _dealt(words.mapInArrow(_signed, "sig int, key long, word string, n long"), hot)
    found = dealt.withColumn("part", F.pmod("bucket", F.lit(n_parts))).groupBy("part").applyInArrow(_near, _NEAR)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("b.less")).alias("best_n"), "b.best")


# ---------------------------------------------------------------------------
# operator
# ---------------------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the chain word -> form; every round doubles the steps taken."""
    now = common.staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        moved = common.staged(now.join(ahead, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        now = moved.select("word", "root")


def variants(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, times: int = TIMES, hot: int = HOT) -> DataFrame:
    """(word, form, root, n, n_near, form_n): a word's form is its most frequent near word if that is `times` as frequent."""
    words = common.staged(vocabulary(docs, min_chars, min_count), "words")
    near = words.join(near_words(words, hot), "word", "left").withColumn("is_form", F.col("best_n") >= F.lit(times) * F.col("n"))
    near = common.staged(near.select("word", F.when(F.col("is_form"), F.col("best")).alias("form"), "n",
                                     F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("is_form"), F.col("best_n")).alias("form_n")), "near")
    ends = roots(near.where("form IS NOT NULL"))
    return near.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
