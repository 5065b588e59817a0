"""Cluster statistics, silhouette, agreement and diagnosis of partitions."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.distance import block_distances, choose_two, require_metric
from sparkloom.functions.summed import FEW_DIMS, summed_distances
from sparkloom.operators.distances import (BLOCK_ROWS, MOST_ROWS, VECTOR, block_count, block_pairs, covers_inside, matrix, pair_distances,
                                           spread, with_features)
from sparkloom.session import cut

CHAIN_RATIO = 10
SUMS = 4_000_000


# --- silhouette -------------------------------------------------------------------

def silhouette_samples(points: DataFrame, ks: list[int], metric: str = "euclidean", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(k, row_id, label, silhouette) of rows (row_id, features, labels); `labels` holds one label per K of `ks`.

    Each pair of blocks computes its distances once for all K and sends, per row
    and K, one distance sum per cluster met; the pairs themselves are never
    emitted.  Singletons score 0.
    """
    require_metric(metric)
    points = cut(points)  # counted, measured and paired
    n = points.count()
    each = points.select(F.posexplode("labels").alias("at", "other"))
    found = cut(each.groupBy("at", "other").agg(F.count(F.lit(1)).alias("size")))
    # a task holds one sum per row and cluster; rows of few dimensions are short and their pairs are not formed
    few = n > 0 and points.select(F.size(VECTOR)).first()[0] <= FEW_DIMS
    blocks = block_count(points, n, block_rows, min(4 * MOST_ROWS if few else MOST_ROWS, SUMS // max(1, found.count())))

    def onehot(labels):
        """(cluster codes of all K as 0/1 columns, [(K, its clusters, its columns)])."""
        columns, spans = [], []
        for at, k in enumerate(ks):
            met, code = np.unique(labels[:, at], return_inverse=True)
            columns.append(code == np.arange(len(met))[:, None])
            spans.append((k, at, met))
        return np.concatenate(columns).T.astype(np.float32), spans

    def frames(ids, labels, spans, sums):
        at_column = 0
        for k, at, met in spans:
            s = sums[:, at_column:at_column + len(met)]
            at_column += len(met)
            yield pd.DataFrame({"k": k, "row_id": np.repeat(ids, len(met)), "label": np.repeat(labels[:, at], len(met)),
                                "other": np.tile(met, len(ids)), "s": s.ravel()})

    def sums(left, right, both):
        """Frames of the rows of `left` (ids, x, labels) over the clusters of `right`, and the other way round."""
        (ids, x, labels), (others, y, theirs) = left, right
        (mine, my_spans), (picked, spans) = onehot(labels), onehot(theirs)
        out, back = summed_distances(x, y, picked, mine if both else None, metric)
        return [*frames(ids, labels, spans, out), *(frames(others, theirs, my_spans, back) if both else ())]

    def kernel(key, pdf):
        a, b = int(key[0]), int(key[1])
        side = pdf["in_b"].to_numpy()
        ids, x = pdf["row_id"].to_numpy(), matrix(pdf)
        labels = np.array(pdf["labels"].tolist(), dtype=np.int64).reshape(len(pdf), -1)
        parts = []
        if a != b and side.any() and (~side).any():
            parts += sums((ids[~side], x[~side], labels[~side]), (ids[side], x[side], labels[side]), True)
        for block, mask in ((a, ~side), (b, side)):
            if mask.any() and covers_inside(a, b, block, blocks):
                own = ids[mask], x[mask], labels[mask]
                parts += sums(own, own, False)
        return pd.concat(parts) if parts else pd.DataFrame({c: [] for c in ("k", "row_id", "label", "other", "s")})

    schema = "k int, row_id bigint, label int, other int, s double"
    total = (block_pairs(points, blocks, keep=["labels"]).groupBy("a", "b").applyInPandas(kernel, schema)
             .groupBy("k", "row_id", "label", "other").agg(F.sum("s").alias("s")))
    sizes = found.select(
        F.element_at(F.array(*[F.lit(k) for k in ks]), F.col("at") + 1).alias("k"), "other", "size")
    own = F.col("label") == F.col("other")
    per_row = (total.join(sizes, ["k", "other"]).groupBy("k", "row_id", "label").agg(
        F.max(F.when(own, F.col("size"))).alias("size"),
        F.max(F.when(own, F.try_divide(F.col("s"), F.col("size") - 1))).alias("a"),
        F.min(F.when(~own, F.col("s") / F.col("size"))).alias("b")))
    s = F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    return per_row.select("k", "row_id", "label", F.when(F.col("size") == 1, 0.0).when(F.col("b").isNotNull(), s).alias("silhouette"))


def silhouette_sampled(df: DataFrame, columns: list[str], labels: DataFrame, metric: str = "euclidean", row_id: str = "row_id",
                       every: int = 50, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(queries, silhouette, standard_error): rows whose id is divisible by `every`, each against all rows.

    A task meets one block of queries and one block of rows and sends a distance sum per query and cluster.  The exact mean over
    all rows is `silhouettes`; this one costs an `every`-th of it and says how far off it may be.
    """
    require_metric(metric)
    metric = "euclidean" if metric == "euclidean_squared" else metric
    points = cut(with_features(df, columns, row_id).join(labels.select("row_id", F.col("label").cast("int").alias("label")), "row_id"))
    queries = points.where(F.col("row_id") % every == 0)
    n, m = points.count(), queries.count()
    blocks, asking = max(1, math.ceil(n / block_rows)), max(1, math.ceil(m / block_rows))

    def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
        side = pdf["asks"].to_numpy()
        if not side.any() or side.all():
            return pd.DataFrame({c: [] for c in ("row_id", "label", "other", "s")})
        x, label, ids = matrix(pdf), pdf["label"].to_numpy(), pdf["row_id"].to_numpy()
        met, code = np.unique(label[~side], return_inverse=True)
        picked = np.zeros((len(code), len(met)))
        picked[np.arange(len(code)), code] = 1.0
        sums = block_distances(x[side], x[~side], metric) @ picked
        return pd.DataFrame({"row_id": np.repeat(ids[side], len(met)), "label": np.repeat(label[side], len(met)),
                             "other": np.tile(met, int(side.sum())), "s": sums.ravel()})

    def dealt(rows: DataFrame, own: str, parts: int, other: str, others: int, asks: bool) -> DataFrame:
        return rows.select(F.pmod(F.xxhash64("row_id"), F.lit(parts)).alias(own), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(others - 1).cast("bigint"))).alias(other),
                           F.lit(asks).alias("asks"), "row_id", "label", VECTOR)

    met = dealt(points, "b", blocks, "a", asking, False).unionByName(dealt(queries, "a", asking, "b", blocks, True))
    total = (spread(met, ["a", "b"], blocks * asking).groupBy("a", "b").applyInPandas(kernel, "row_id bigint, label int, other int, s double")
             .groupBy("row_id", "label", "other").agg(F.sum("s").alias("s")))
    sizes = points.groupBy(F.col("label").alias("other")).agg(F.count(F.lit(1)).alias("size"))
    own = F.col("label") == F.col("other")
    per_row = total.join(sizes, "other").groupBy("row_id").agg(
        F.max(F.when(own, F.col("size"))).alias("size"), F.max(F.when(own, F.try_divide(F.col("s"), F.col("size") - 1))).alias("a"),
        F.min(F.when(~own, F.col("s") / F.col("size"))).alias("b"))
    s = F.when(F.col("size") == 1, 0.0).when(F.col("b").isNotNull(), F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    return per_row.agg(F.count(s).alias("queries"), F.avg(s).alias("silhouette"), (F.stddev_samp(s) / F.sqrt(F.count(s))).alias("standard_error"))


def silhouettes(df: DataFrame, columns: list[str], labels: DataFrame, metric: str = "euclidean", row_id: str = "row_id",
                block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(k, silhouette): the mean per K over rows with a label for every K; null with fewer than two clusters.

    A squared metric is scored on plain distances.
    """
    metric = "euclidean" if metric == "euclidean_squared" else metric
    ks = sorted(r["k"] for r in labels.select("k").distinct().collect())  # one row per K
    if not ks:
        return df.sparkSession.createDataFrame([], "k int, silhouette double")
    wide = (labels.groupBy("row_id").agg(F.sort_array(F.collect_list(F.struct("k", F.col("label").cast("int").alias("label")))).alias("l"))
            .where(F.size("l") == len(ks)).select("row_id", F.col("l.label").alias("labels")))
    points = with_features(df, columns, row_id).join(wide, "row_id")
    return silhouette_samples(points, ks, metric, block_rows).groupBy("k").agg(F.avg("silhouette").alias("silhouette"))


def silhouette(df: DataFrame, columns: list[str], labels: DataFrame, metric: str = "euclidean", row_id: str = "row_id",
               block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row: mean silhouette; null with fewer than two clusters."""
    one = labels.select(F.lit(0).alias("k"), "row_id", "label")
    return silhouettes(df, columns, one, metric, row_id, block_rows).agg(F.max("silhouette").alias("silhouette"))


# --- statistics per K -------------------------------------------------------------

def cluster_sizes(labels: DataFrame) -> DataFrame:
    """(k, label, size)."""
    return labels.groupBy("k", "label").agg(F.count(F.lit(1)).alias("size"))


def size_summary(labels: DataFrame) -> DataFrame:
    """(k, clusters, min_size, max_size, mean_size)."""
    return cluster_sizes(labels).groupBy("k").agg(
        F.count(F.lit(1)).alias("clusters"), F.min("size").alias("min_size"), F.max("size").alias("max_size"),
        F.avg("size").alias("mean_size"))


def centroids(df: DataFrame, columns: list[str], labels: DataFrame, row_id: str = "row_id") -> DataFrame:
    """(k, label, size, centroid, within_ss): sums only, so any cluster size combines before the shuffle."""
    points = with_features(df, columns, row_id)
    width = points.select(F.size(VECTOR).alias("w")).first()["w"]
    row = points.agg(*[F.avg(F.col(VECTOR)[i]).alias(f"g{i}") for i in range(width)]).first()
    # sums around the global mean keep the digits of the squares
    g = [row[f"g{i}"] for i in range(width)]
    x = lambda i: F.col(VECTOR)[i] - F.lit(g[i])
    joined = points.join(labels, "row_id")
    sums = joined.groupBy("k", "label").agg(
        F.count(F.lit(1)).alias("size"), *[F.sum(x(i)).alias(f"s{i}") for i in range(width)],
        F.sum(sum((x(i) * x(i) for i in range(1, width)), x(0) * x(0))).alias("q"))
    n = F.col("size")
    square = sum((F.col(f"s{i}") * F.col(f"s{i}") for i in range(1, width)), F.col("s0") * F.col("s0"))
    return sums.select("k", "label", "size",
                       F.array(*[F.lit(g[i]) + F.col(f"s{i}") / n for i in range(width)]).alias("centroid"),
                       F.greatest(F.col("q") - square / n, F.lit(0.0)).alias("within_ss"),
                       (square / n).alias("between_ss"))


def cluster_statistics(df: DataFrame, columns: list[str], labels: DataFrame, row_id: str = "row_id") -> DataFrame:
    """(k, clusters, min_size, max_size, mean_size, within_ss, between_ss)."""
    return centroids(df, columns, labels, row_id).groupBy("k").agg(
        F.count(F.lit(1)).alias("clusters"), F.min("size").alias("min_size"), F.max("size").alias("max_size"),
        F.avg("size").alias("mean_size"), F.sum("within_ss").alias("within_ss"), F.sum("between_ss").alias("between_ss"))


def full_statistics(df: DataFrame, columns: list[str], labels: DataFrame, row_id: str = "row_id",
                    block_rows: int = BLOCK_ROWS) -> DataFrame:
    """`cluster_statistics` with the silhouette of each K; distances are computed once for all K."""
    scores = silhouettes(df, columns, labels, row_id=row_id, block_rows=block_rows)
    return cluster_statistics(df, columns, labels, row_id).join(scores, "k")


def separation_ratio(df: DataFrame, columns: list[str], labels: DataFrame, row_id: str = "row_id") -> float:
    """min(1, mean centroid distance / mean distance to the own centroid / 10).

    Singletons do not count among the distances to centroids.
    """
    labels = labels.select(F.lit(0).alias("k"), "row_id", "label")
    table = cut(centroids(df, columns, labels, row_id))
    if len(table.limit(2).collect()) < 2:
        return 0.0
    inter = pair_distances(table, ["centroid"], row_id="label").agg(F.avg("d")).first()[0]
    near = table.where("size > 1").select("label", "centroid")
    points = with_features(df, columns, row_id).join(labels, "row_id").join(near, "label")
    sq = F.aggregate(F.zip_with(VECTOR, "centroid", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)
    intra = points.agg(F.avg(F.sqrt(sq))).first()[0]
    if intra is None:
        return 0.0
    return min(1.0, inter / intra / 10.0) if intra > 0 else 1.0


# --- agreement ----------------------------------------------------------------------

def fowlkes_mallows(pairs: DataFrame, left: str = "left_label", right: str = "right_label") -> DataFrame:
    """One row of the index over rows labelled twice: (rows, pairs_both, pairs_left, pairs_right, fm); pairs are decimals.

    Everything is counted from the contingency table; the margins come from it,
    so the rows are aggregated once.
    """
    cells = pairs.groupBy(left, right).agg(F.count(F.lit(1)).alias("n"))
    both = cells.agg(F.sum("n").alias("rows"), F.sum(choose_two("n")).alias("both"), F.count(F.lit(1)).alias("cells"))
    nothing = F.lit(0).cast("decimal(38,0)")

    def margin(c: str, name: str) -> DataFrame:
        return cells.groupBy(c).agg(F.sum("n").alias("n")).agg(F.sum(choose_two("n")).alias(name))

    def pad(d: DataFrame) -> DataFrame:
        return d.select(*[(F.col(c).cast("decimal(38,0)") if c in d.columns else nothing).alias(c)
                          for c in ("rows", "both", "cells", "lefts", "rights")])

    one = (pad(both).unionByName(pad(margin(left, "lefts"))).unionByName(pad(margin(right, "rights")))
           .agg(*[F.coalesce(F.sum(c), nothing).alias(c) for c in ("rows", "both", "cells", "lefts", "rights")]))
    b, p, q = F.col("both"), F.col("lefts"), F.col("rights")
    index = F.sqrt(F.try_divide(b.cast("double"), p.cast("double")) * F.try_divide(b.cast("double"), q.cast("double")))
    fm = (F.when(F.col("rows") < 2, 1.0)
          .when(F.col("rows") == 2, F.when((p > 0) == (q > 0), 1.0).otherwise(0.0))
          .when((p == 0) & (q == 0), 1.0).when((p == 0) | (q == 0), 0.0).otherwise(index))
    return one.select(F.col("rows").cast("bigint").alias("rows"), b.alias("pairs_both"), p.alias("pairs_left"), q.alias("pairs_right"), fm.alias("fm"))


def agreement(first: DataFrame, second: DataFrame) -> DataFrame:
    """Index of two label tables on the rows they share."""
    return fowlkes_mallows(first.select("row_id", F.col("label").alias("left_label"))
                           .join(second.select("row_id", F.col("label").alias("right_label")), "row_id"))


# --- diagnosis and reports ------------------------------------------------------------

def balance(sizes: DataFrame, by: list[str]) -> DataFrame:
    """(by..., max_size, min_size, ratio, chain_effect) from per-cluster sizes."""
    return (sizes.groupBy(*by).agg(F.max("size").alias("max_size"), F.min("size").alias("min_size"))
            .withColumn("ratio", F.col("max_size") / F.col("min_size"))
            .withColumn("chain_effect", F.col("ratio") > CHAIN_RATIO))


def k_report(df: DataFrame, columns: list[str], labels: DataFrame, k: int, row_id: str = "row_id") -> DataFrame:
    """Per cluster of one K: size, share, size extremes, centroid of the first two features."""
    chosen = labels.where(F.col("k") == k)
    x, y = columns[:2]
    per = (df.withColumnRenamed(row_id, "row_id").join(chosen.select("row_id", "label"), "row_id")
           .groupBy("label").agg(F.count(F.lit(1)).alias("size"), F.avg(x).alias("center_x"), F.avg(y).alias("center_y")))
    head = per.agg(F.sum("size").alias("n"), F.min("size").alias("lo"), F.max("size").alias("hi"), F.avg("size").alias("av")).first()
    return per.select("label", "size", (F.lit(100.0) * F.col("size") / F.lit(head["n"])).alias("share_pct"),
                      F.lit(head["lo"]).cast("bigint").alias("min_size"), F.lit(head["hi"]).cast("bigint").alias("max_size"),
                      F.lit(head["av"]).alias("mean_size"), "center_x", "center_y")
