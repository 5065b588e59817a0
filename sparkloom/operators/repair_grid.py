"""Repairs of one column for many shares of holes at once.

Every row carries one hole flag per share, so that a question is asked for the whole grid in one pass: means, modes and
errors are conditional aggregates, medians are counted side by side, and all regressions are solved from one table of
moments.  A moment is kept per combination of folds (a number with one digit per share: 0 for a hole, else the fold
plus 1).  It is taken over features that no share has filled in yet: the value, an indicator of a missing value, one
indicator per class.  Filling in a mean or a class is then a small matrix on both sides of the moments, so neither
another share, nor another method, nor another alpha reads the table again.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.hashing import normal
from sparkloom.functions.ranks import exact_quantiles, order_statistics
from sparkloom.operators import ridge
from sparkloom.operators.checks import is_missing, require_numeric
from sparkloom.operators.encode import LITERAL_CLASSES, UNKNOWN
from sparkloom.operators.missing import hole_flags
from sparkloom.session import cut

METHODS = ("drop", "mean", "mode", "regression", "stochastic_regression")
ROW = ("share double, method string, mean_before double, median_before double, mean double, median double, "
       "first_mode double, mode_count bigint, error_pct double")


class RepairGrid:
    """One column with the holes of all shares, written once: id, y, gone (missing from the start), hole, features."""

    def __init__(self, df: DataFrame, column: str, shares, seed: int = 42, row_id: str = "row_id", injection: str = "block",
                 numeric: list[str] | None = None, onehot: list[str] | None = None, freq: list[str] | None = None,
                 timestamp: str | None = None):
        require_numeric(df, column)
        self.shares, self.spark = tuple(shares), df.sparkSession
        self.index = range(len(self.shares))
        flags = hole_flags(df, self.shares, seed, row_id, injection)
        self.numeric, self.onehot, self.freq = ridge.roles_of(df, column, row_id, numeric, onehot, freq, timestamp)
        wide, gone = ridge.with_dates(df, timestamp), is_missing(column, df)
        self.rows = cut(wide.select(
            F.col(row_id).alias("id"), F.col(column).cast("double").alias("y"), gone.alias("gone"),
            F.array(*[gone | f for f in flags]).alias("hole"),
            *[F.when(~is_missing(c, wide), F.col(c).cast("double")).alias(f"n{i}") for i, c in enumerate(self.numeric)],
            *[F.col(c).cast("string").alias(f"h{i}") for i, c in enumerate(self.onehot)],
            *[F.col(c).cast("string").alias(f"q{i}") for i, c in enumerate(self.freq)]), "grid")
        kept = self.kept
        row = self.rows.agg(
            *[F.count_if(kept(s)).alias(f"rows{s}") for s in self.index],
            *[F.count_if(~kept(s)).alias(f"holes{s}") for s in self.index],
            *[F.avg(F.when(kept(s), F.col("y"))).alias(f"mean{s}") for s in self.index],
            F.avg(F.when(~F.col("gone"), F.col("y"))).alias("mean"),
            *[F.avg(F.when(kept(s), F.col(f"n{i}"))).alias(f"n{i}_{s}") for i in range(len(self.numeric)) for s in self.index],
            *[F.avg(f"n{i}").alias(f"n{i}") for i in range(len(self.numeric))],
            *[F.count_if(F.col(f"n{i}").isNull()).alias(f"empty{i}") for i in range(len(self.numeric))]).first()
        self.facts = row.asDict()

    def hole(self, s: int) -> Column:
        return F.col("hole")[s]

    def kept(self, s: int) -> Column:
        return ~F.col("hole")[s]

    def _counted(self, key: str) -> DataFrame:
        """(key, c0, c1, ...): rows of each share's training part by value."""
        return self.rows.groupBy(key).agg(*[F.count_if(self.kept(s)).alias(f"c{s}") for s in self.index])

    def modes(self) -> list[float | None]:
        """Most frequent value left by each share, ties to the smallest."""
        counts = self._counted("y").where(F.col("y").isNotNull() & ~F.isnan("y"))
        best = counts.agg(*[self._best(s, "y") for s in self.index]).first()
        return [b and b["v"] for b in best]

    @staticmethod
    def _best(s: int, key: str) -> Column:
        c = F.col(f"c{s}")
        return F.min(F.when(c > 0, F.struct((-c).alias("n"), F.col(key).alias("v")))).alias(f"b{s}")

    # -- regression

    def _classes(self, i: int) -> list[dict]:
        """Per share: fill and sorted classes of a one-hot feature; at most `LITERAL_CLASSES` over all shares."""
        rows = self._counted(f"h{i}").limit(LITERAL_CLASSES + 2).collect()
        if sum(r[f"h{i}"] is not None for r in rows) > LITERAL_CLASSES:
            raise ValueError(f"column {self.onehot[i]!r} has too many classes for one-hot; give it as a frequency column")
        out = []
        for s in self.index:
            count = {r[f"h{i}"]: r[f"c{s}"] for r in rows if r[f"c{s}"]}
            empty = count.pop(None, 0)
            fill = min(count, key=lambda v: (-count[v], v)) if count else UNKNOWN
            out.append({"fill": fill, "classes": sorted(count) or ([fill] if empty else [])})
        return out

    def _with_frequency(self, rows: DataFrame, i: int) -> DataFrame:
        """Adds f<i>: the frequency of the value in each share's training part, nulls counted as its mode."""
        key, n = f"q{i}", [float(self.facts[f"rows{s}"]) for s in self.index]
        counts = self._counted(key)
        best = counts.where(F.col(key).isNotNull()).agg(*[self._best(s, key) for s in self.index]).first()
        null = counts.where(F.col(key).isNull()).first()
        empty = [null[f"c{s}"] if null else 0 for s in self.index]
        fill = [b["v"] if b else None for b in best]
        top = [-b["n"] if b else 0 for b in best]
        share = F.array(*[(F.col(f"c{s}") + F.when(F.col(key) == F.lit(fill[s]), F.lit(empty[s])).otherwise(0)) / F.lit(n[s])
                          if n[s] else F.lit(0.0) for s in self.index])
        known = counts.where(F.col(key).isNotNull()).select(F.col(key).alias("_v"), share.alias(f"f{i}"))
        nulls = F.array(*[F.lit((top[s] + empty[s]) / n[s] if n[s] else 0.0) for s in self.index])
        return (rows.join(known, F.col(key) == F.col("_v"), "left").drop("_v")
                .withColumn(f"f{i}", F.when(F.col(key).isNull(), nulls).otherwise(F.col(f"f{i}"))))

    def regressions(self, alphas=ridge.ALPHAS, folds: int = 5) -> dict[int, tuple[ridge.AlphaSearch, Column]]:
        """Search and prediction of every share that has holes, from one pass of moments."""
        if not self.numeric + self.onehot + self.freq:
            raise ValueError("no features")
        asked = [s for s in self.index if self.facts[f"holes{s}"]]
        if not asked:
            return {}
        if (folds + 1) ** len(self.shares) >= 1 << 63:
            raise ValueError(f"{len(self.shares)} shares of {folds} folds do not fit into one number; split the shares")
        for i in range(len(self.freq)):
            self.rows = self._with_frequency(self.rows, i)
        if self.freq:
            self.rows = cut(self.rows, "grid")
        classes = [self._classes(i) for i in range(len(self.onehot))]
        starts = {s: ridge.fold_starts(self.facts[f"rows{s}"], folds) for s in asked}
        ids = order_statistics(self.rows.select(*[F.when(self.kept(s), F.col("id")).alias(f"i{s}") for s in asked]),
                               {f"i{s}": starts[s] for s in asked})
        base, code = folds + 1, F.lit(0).cast("bigint")
        for s in asked:
            fold = ridge.fold_of("id", [ids[f"i{s}"][p] for p in starts[s]])
            code = code + F.when(self.kept(s), (fold + 1).cast("bigint") * F.lit(base ** s)).otherwise(F.lit(0).cast("bigint"))

        # features before any filling in, and for each share the matrix that makes its own features of them
        raw, shift, makes = [], [], {s: [] for s in asked}
        designs = {s: ridge.Design() for s in asked}
        for i in range(len(self.numeric)):
            centre, empty = float(self.facts[f"n{i}"] or 0.0), self.facts[f"empty{i}"] > 0
            for s in asked:
                mean = float(self.facts[f"n{i}_{s}"] or 0.0)
                designs[s].numeric[f"n{i}"] = mean
                makes[s].append({len(raw): 1.0, **({len(raw) + 1: mean - centre} if empty else {})})
            raw += [F.coalesce(f"n{i}", F.lit(centre)), *([F.col(f"n{i}").isNull().cast("double")] if empty else [])]
            shift += [centre, *([0.0] if empty else [])]
        for i, found in enumerate(classes):
            union = sorted({v for x in found for v in x["classes"]})
            place = {v: len(raw) + k for k, v in enumerate(union)}
            null = len(raw) + len(union)
            for s in asked:
                fill, held = found[s]["fill"], found[s]["classes"]
                designs[s].onehot[f"h{i}"] = (fill, held)
                makes[s] += [{place[v]: 1.0, **({null: 1.0} if v == fill else {})} for v in held[1:]]
            raw += [F.coalesce(F.col(f"h{i}") == F.lit(v), F.lit(False)).cast("double") for v in union]
            raw.append(F.col(f"h{i}").isNull().cast("double"))
            shift += [0.0] * (len(union) + 1)
        for i in range(len(self.freq)):
            for s in asked:
                designs[s].freq[f"q{i}"] = (UNKNOWN, None)
                makes[s].append({len(raw): 1.0})
                raw.append(F.coalesce(F.col(f"f{i}")[s], F.lit(0.0)))
                shift.append(0.0)
        if len(raw) > ridge.MAX_FEATURES:
            raise ValueError(f"{len(raw)} features; at most {ridge.MAX_FEATURES} can be solved")
        centre = float(self.facts["mean"] or 0.0)
        moments = ridge.moment_sums(self.rows.where(~F.col("gone")), raw, F.col("y"), code, [*shift, centre])
        out = {}
        for s in asked:
            p = len(makes[s])
            make = np.zeros((len(raw) + 2, p + 2))
            make[0, 0] = make[-1, -1] = 1.0
            for j, parts in enumerate(makes[s], 1):
                for k, x in parts.items():
                    make[k + 1, j] = x
            sums: dict[int, np.ndarray] = {}
            for c, m in moments.items():
                digit = c // base ** s % base
                if digit:
                    sums[digit] = sums.get(digit, 0.0) + make.T @ m @ make
            search = ridge.search_alpha(dict(sorted(sums.items())), alphas)
            moved = [shift[min(parts)] for parts in makes[s]]
            search.intercept += centre - float(search.weights @ np.array(moved))
            out[s] = search, designs[s].linear(search.weights, search.intercept,
                                               [F.col(f"f{i}")[s] for i in range(len(self.freq))])
        return out

    # -- measures

    def measure(self, methods, alphas=ridge.ALPHAS, folds: int = 5, noise_seed: int = 42) -> DataFrame:
        """One row per share and method: statistics of the repaired column and its error in percent."""
        if unknown := set(methods) - set(METHODS):
            raise ValueError(f"unknown method {min(unknown)!r}")
        models = self.regressions(alphas, folds) if any("regression" in m for m in methods) else {}
        modes = self.modes() if "mode" in methods else []
        none, y = F.lit(None).cast("double"), F.col("y")

        def guess(s: int, method: str) -> Column:
            if method == "mean":
                return F.lit(self.facts[f"mean{s}"]).cast("double")
            if method == "mode":
                return F.lit(modes[s]).cast("double")
            if method == "drop" or s not in models:
                return none
            search, value = models[s]
            return value if method == "regression" else value + F.lit(search.residual_std) * normal(noise_seed, "id")

        cells = [(s, m) for s in self.index for m in methods]
        wide = self.rows.select("y", "gone", "hole", *[
            F.when(self.hole(s), guess(s, m)).alias(f"g{i}") for i, (s, m) in enumerate(cells)])
        value = [F.coalesce(f"g{i}", F.when(self.kept(s), y)).alias(f"v{i}") for i, (s, _) in enumerate(cells)]
        usable = ~F.col("gone") & (y != 0)
        row = wide.select("*", *value).agg(
            F.avg("y").alias("before"), *[F.avg(f"v{i}").alias(f"mean{i}") for i in range(len(cells))],
            *[(F.avg(F.when(usable & self.hole(s), F.abs(F.try_divide(y - F.col(f"g{i}"), y)))) * 100).alias(f"error{i}")
              for i, (s, _) in enumerate(cells)]).first()
        half = exact_quantiles(wide.select("y", *value), ["y", *[f"v{i}" for i in range(len(cells))]], [0.5])
        top = {r["cell"]: r["top"] for r in self._top_values(wide, cells).collect()}  # one row per cell of the grid

        def middle(c: str) -> float | None:
            return half[c][0] if half[c] else None
        return self.spark.createDataFrame([
            (float(self.shares[s]), m, row["before"], middle("y"), row[f"mean{i}"], middle(f"v{i}"),
             top[i]["v"] if i in top else None, top[i]["ties"] if i in top else 0,
             None if m == "drop" else row[f"error{i}"]) for i, (s, m) in enumerate(cells)], ROW)

    def _top_values(self, wide: DataFrame, cells: list[tuple[int, str]]) -> DataFrame:
        """(cell, top): smallest most frequent value and number of ties, rows counted once for all cells that keep them."""
        filled = [F.when(F.col(f"g{i}").isNotNull(), F.struct(F.lit(i).alias("cell"), F.col(f"g{i}").alias("v")))
                  for i in range(len(cells))]
        stay = wide.where(~F.col("gone")).select(F.col("y").alias("v"), F.lit(None).cast("int").alias("cell"), "hole")
        new = wide.where(F.exists("hole", lambda h: h)).select(F.inline(F.filter(F.array(*filled), lambda x: x.isNotNull())))
        both = stay.unionByName(new.withColumn("hole", F.lit(None).cast("array<boolean>")))
        counted = both.groupBy("v").agg(*[
            F.count_if((F.col("cell") == i) | (F.col("cell").isNull() & ~F.col("hole")[s])).alias(f"n{i}")
            for i, (s, _) in enumerate(cells)])
        long = counted.select("v", F.inline(F.array(*[
            F.struct(F.lit(i).alias("cell"), F.col(f"n{i}").alias("n")) for i in range(len(cells))]))).where("n > 0")
        return (long.groupBy("cell", "n").agg(F.min("v").alias("v"), F.count(F.lit(1)).alias("ties"))
                .groupBy("cell").agg(F.max(F.struct("n", "v", "ties")).alias("top")))
