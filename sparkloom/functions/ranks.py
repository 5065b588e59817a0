"""Exact order statistics and positions without a global sort.

``percentile`` keeps every distinct value in one aggregation buffer and an
un-partitioned window sends every row to one task.  Both stop working long
before a table is large, so ranks are found here by counting: a histogram
narrows the interval that holds the wanted rank until few rows are left in it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.session import cut

BUCKETS = 1024
FEW_ROWS = 5000


@dataclass
class _Target:
    column: str
    rank: int          # 0-based among the non-null values
    low: object
    high: object
    before: int = 0    # rows below `low`
    value: object = None


def _is_integral(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.IntegralType)


def _bucket(v: np.ndarray, low, high, buckets: int) -> np.ndarray:
    """Bucket of every value of [low, high]; it never falls from a value to a larger one."""
    if v.dtype.kind == "i":
        # differences of 64-bit numbers may not fit into 63 bits
        return ((v.astype(np.uint64) - np.uint64(low % (1 << 64))) // np.uint64((high - low) // buckets + 1)).astype(np.int64)
    with np.errstate(all="ignore"):  # halves first: the distance of two large doubles may be infinite
        scaled = np.floor((v / 2.0 - low / 2.0) / (high / 2.0 - low / 2.0) * buckets)
    return np.minimum(np.nan_to_num(scaled, nan=0.0, posinf=buckets), buckets - 1).astype(np.int64)


def _inside(batch: pa.RecordBatch, column: str, low, high) -> np.ndarray:
    """The column's values between the bounds; NaN is above all others."""
    v = batch[column].drop_null().to_numpy(zero_copy_only=False)
    if v.dtype.kind == "i":
        return v[(v >= low) & (v <= high)]
    above = np.isnan(v) if np.isnan(low) else ~(v < low)
    return v[above if np.isnan(high) else above & (v <= high)]


def _histogram(spans: list[tuple], buckets: int):
    """Rows, smallest and largest value per span (column, low, high) and bucket, folded over a task's batches."""
    def run(batches):
        rows = np.zeros((len(spans), buckets), np.int64)
        low: dict[int, np.ndarray] = {}
        high: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, (c, lo, hi) in enumerate(spans):
                v = np.sort(_inside(batch, c, lo, hi))
                if not len(v):
                    continue
                if i not in low:
                    low[i], high[i] = np.zeros(buckets, v.dtype), np.zeros(buckets, v.dtype)
                at = _bucket(v, lo, hi, buckets)
                first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
                last, b = np.r_[first[1:], len(v)] - 1, at[first]
                new = rows[i, b] == 0
                # NaN is above all others
                low[i][b] = np.where(new, v[first], np.fmin(low[i][b], v[first]))
                high[i][b] = np.where(new, v[last], np.maximum(high[i][b], v[last]))
                rows[i, b] += last - first + 1
        for i in low:
            b = np.flatnonzero(rows[i])
            none, whole = pa.nulls(len(b)), low[i].dtype.kind == "i"
            ends = [pa.array(x[i][b]) for x in (low, high)]
            yield pa.RecordBatch.from_pydict({
                "span": pa.array(np.full(len(b), i, np.int32)), "bucket": pa.array(b.astype(np.int32)), "rows": pa.array(rows[i, b]),
                **{n: none.cast(pa.float64()) if whole else e for n, e in zip(("dlo", "dhi"), ends, strict=True)},
                **{n: e if whole else none.cast(pa.int64()) for n, e in zip(("nlo", "nhi"), ends, strict=True)}})
    return run


def _values(spans: list[tuple]):
    """All values between the bounds of the spans."""
    def run(batches):
        for batch in batches:
            for i, (c, lo, hi) in enumerate(spans):
                v = _inside(batch, c, lo, hi)
                if len(v):
                    none, whole = pa.nulls(len(v)), v.dtype.kind == "i"
                    yield pa.RecordBatch.from_pydict({
                        "span": pa.array(np.full(len(v), i, np.int32)),
                        "d": none.cast(pa.float64()) if whole else pa.array(v), "n": pa.array(v) if whole else none.cast(pa.int64())})
    return run


def order_statistics(df: DataFrame, wanted: dict[str, list[int]],
                     bounds: dict[str, tuple] | None = None) -> dict[str, dict[int, object]]:
    """Exact values at 0-based ranks of each column (nulls left out).

    Each pass is one scan, whose tasks fold their Arrow batches into at most
    BUCKETS rows per open interval, and shrinks the intervals BUCKETS-fold.
    """
    columns = [c for c, ranks in wanted.items() if ranks]
    if not columns:
        return {c: {} for c in wanted}
    integral = {c: _is_integral(df, c) for c in columns}
    typed = df.select(*[F.col(c).cast("bigint" if integral[c] else "double").alias(c) for c in columns])
    if bounds is None:
        row = typed.agg(*[f(c).alias(f"{n}_{i}") for i, c in enumerate(columns)
                          for n, f in (("lo", F.min), ("hi", F.max))]).first()
        bounds = {c: (row[f"lo_{i}"], row[f"hi_{i}"]) for i, c in enumerate(columns)}
    targets = [_Target(c, r, *bounds[c]) for c in columns for r in sorted(set(wanted[c]))]
    for t in targets:
        if t.low == t.high:
            t.value = t.low
    while True:
        open_targets = [t for t in targets if t.value is None]
        if not open_targets:
            break
        spans = sorted({(t.column, t.low, t.high) for t in open_targets})
        index = {s: i for i, s in enumerate(spans)}
        counted = (typed.mapInArrow(_histogram(spans, BUCKETS), "span int, bucket int, rows bigint, dlo double, dhi double, nlo bigint, nhi bigint")
                   .groupBy("span", "bucket")
                   .agg(F.sum("rows").alias("rows"), F.min("dlo").alias("dlo"), F.max("dhi").alias("dhi"),
                        F.min("nlo").alias("nlo"), F.max("nhi").alias("nhi"))
                   .collect())
        by_span: dict[int, list] = {}
        for r in counted:
            by_span.setdefault(r["span"], []).append(r)
        small: dict[tuple, list[_Target]] = {}
        for t in open_targets:
            seen = t.before
            for r in sorted(by_span[index[(t.column, t.low, t.high)]], key=lambda r: r["bucket"]):
                if t.rank < seen + r["rows"]:
                    lo, hi = (r["nlo"], r["nhi"]) if integral[t.column] else (r["dlo"], r["dhi"])
                    if (lo, hi) == (t.low, t.high) and r["rows"] > FEW_ROWS:
                        raise ArithmeticError(f"the values of {t.column!r} between {lo} and {hi} cannot be told apart")
                    t.low, t.high, t.before = lo, hi, seen
                    if lo == hi:
                        t.value = lo
                    elif r["rows"] <= FEW_ROWS:
                        small.setdefault((t.column, lo, hi), []).append(t)
                    break
                seen += r["rows"]
        if small:
            keys = sorted(small)
            got: dict[int, list] = {}
            for r in typed.mapInArrow(_values(keys), "span int, d double, n bigint").collect():
                got.setdefault(r["span"], []).append(r["n"] if r["n"] is not None else r["d"])
            for i, key in enumerate(keys):
                values = sorted(got[i])
                for t in small[key]:
                    t.value = values[t.rank - t.before]
    out: dict[str, dict[int, object]] = {c: {} for c in wanted}
    for t in targets:
        out[t.column][t.rank] = t.value
    return out


def _interpolate(below: float, above: float, t: float) -> float:
    """Linear interpolation, anchored at the nearer end."""
    step = above - below
    return below + step * t if t < 0.5 else above - step * (1.0 - t)


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float]) -> dict[str, list[float] | None]:
    """Exact, linearly interpolated quantiles per column; None for an all-null column."""
    row = df.agg(*[f(F.col(c)).alias(f"{n}_{i}") for i, c in enumerate(columns)
                   for n, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]).first()
    counts = {c: row[f"n_{i}"] for i, c in enumerate(columns)}
    bounds = {c: (row[f"lo_{i}"], row[f"hi_{i}"]) for i, c in enumerate(columns)}
    for c, (lo, hi) in bounds.items():
        if lo is not None and not _is_integral(df, c):
            bounds[c] = (float(lo), float(hi))
    wanted = {c: [] for c in columns}
    for c in columns:
        n = counts[c]
        for p in probs if n else []:
            pos = p * (n - 1)
            wanted[c] += [math.floor(pos), min(n - 1, math.floor(pos) + 1)]
    stats = order_statistics(df, wanted, bounds)
    out: dict[str, list[float] | None] = {}
    for c in columns:
        n = counts[c]
        if not n:
            out[c] = None
            continue
        vals = []
        for p in probs:
            pos = p * (n - 1)
            k = math.floor(pos)
            vals.append(_interpolate(float(stats[c][k]), float(stats[c][min(n - 1, k + 1)]), pos - k))
        out[c] = vals
    return out


def smallest_digest_bound(df: DataFrame, digest: Column, count: int) -> str | None:
    """The `count`-th smallest hex digest of the rows (1-based); None when count is 0.

    Counts by hex prefix and descends into the one prefix that holds the rank.
    """
    if count <= 0:
        return None
    step, prefix, left = 3, "", count
    hashed = df.select(digest.alias("h"))
    while True:
        inside = hashed.where(F.col("h").startswith(prefix)) if prefix else hashed
        rows = (inside.groupBy(F.substring("h", 1, len(prefix) + step).alias("p"))
                .agg(F.count(F.lit(1)).alias("n")).collect())
        for r in sorted(rows, key=lambda r: r["p"]):
            if left <= r["n"]:
                prefix, size = r["p"], r["n"]
                break
            left -= r["n"]
        else:
            raise ValueError("count exceeds the number of rows")
        if size <= FEW_ROWS or len(prefix) >= 32:
            values = sorted(r["h"] for r in hashed.where(F.col("h").startswith(prefix)).limit(FEW_ROWS + 1).collect()) \
                if size <= FEW_ROWS else [prefix] * left
            return values[left - 1]


def with_position(df: DataFrame, order: list, name: str = "position") -> DataFrame:
    """0-based global position in the given order, spread over range partitions.

    One range shuffle, then cut; only one count per partition reaches the
    driver.  The order should end in a unique key, so that a value shared by
    many rows is spread over several ranges.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(o) if isinstance(o, str) else o for o in order]
    # The generated id holds the partition in the high bits and the running
    # number inside the sorted partition in the low 33 bits.
    ranged = cut(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                 .withColumn("_mid", F.monotonically_increasing_id()))
    part = F.shiftright("_mid", 33)
    counts = {r["part"]: r["n"] for r in
              ranged.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    offsets, total = {}, 0
    for p in sorted(counts):
        offsets[p] = total
        total += counts[p]
    if not offsets:
        return df.withColumn(name, F.lit(None).cast("bigint"))
    start = F.element_at(F.create_map(*[F.lit(v).cast("bigint") for kv in offsets.items() for v in kv]), part)
    local = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    return ranged.withColumn(name, (start + local).cast("bigint")).drop("_mid")


def rank_within(df: DataFrame, group: list[str], order: list[str], name: str = "rank") -> DataFrame:
    """1-based row number inside each group, whatever the group's size.

    A window would sort a whole group in one task.  Here the global position is
    taken over (group, order) and the group's first position subtracted.
    """
    placed = cut(with_position(df, [*group, *order], "_pos"))
    first = placed.groupBy(*group).agg(F.min("_pos").alias("_first"))
    return (placed.join(first, group).withColumn(name, (F.col("_pos") - F.col("_first") + 1).cast("bigint"))
            .select(*df.columns, name))
