"""K-means, clustering by method name, and the diagnosis of methods."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.distance import block_distances
from sparkloom.functions.hashing import digest
from sparkloom.operators.distances import VECTOR, matrix, with_features
from sparkloom.operators.encode import standard_scale
from sparkloom.operators.linkage import partition, single_linkage, spanning_tree
from sparkloom.operators.quality import balance
from sparkloom.operators.missing import fill_mean
from sparkloom.session import cut

PARALLEL_STARTS = 4


def kmeans(df: DataFrame, columns: list[str], k: int, row_id: str = "row_id", seed: int = 42, starts: int = 10,
           max_iter: int = 300) -> tuple[DataFrame, DataFrame]:
    """Best of several seeded runs: (labels (row_id, label), clusters (label, center, size, inertia)).

    Only the Euclidean distance is used.
    """
    points = with_features(df, columns, row_id)
    vectors = points.select("row_id", array_to_vector(VECTOR).alias("v")).persist()

    def first(s: int) -> np.ndarray:
        return np.array(KMeans(k=k, featuresCol="v", predictionCol="label", maxIter=0, seed=seed + s).fit(vectors).clusterCenters())

    # the first centres of the runs are independent jobs over one cached table and share the cluster
    with ThreadPoolExecutor(min(starts, PARALLEL_STARTS)) as pool:
        firsts = list(pool.map(inheritable_thread_target(df.sparkSession)(first), range(starts)))
    vectors.unpersist()
    best, inertia = _settled(points, firsts, max_iter, tol=1e-4)

    def label(batches):
        for batch in batches:
            x = np.asarray(batch[VECTOR].flatten(), dtype=np.float64).reshape(-1, best.shape[1])
            near = _products(x, best, best.mean(axis=0))[1].argmin(axis=1)
            yield pa.RecordBatch.from_pydict({"row_id": batch["row_id"], "label": pa.array(near, pa.int32())})

    labels = cut(points.mapInArrow(label, "row_id bigint, label int"))
    centers = df.sparkSession.createDataFrame(
        [(i, [float(v) for v in c], inertia) for i, c in enumerate(best)],
        "label int, center array<double>, inertia double")
    sizes = labels.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    # one row per cluster on both sides
    return labels, centers.join(F.broadcast(sizes), "label", "left").withColumn("size", F.coalesce("size", F.lit(0).cast("bigint")))


def _products(x: np.ndarray, centers: np.ndarray, middle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows around `middle`, squared distances to the centres less the row's own square)."""
    x, c = x - middle, centers - middle
    out = x @ c.T
    out *= -2
    out += np.einsum("ij,ij->i", c, c)
    return x, out


def _settled(points: DataFrame, firsts: list[np.ndarray], max_iter: int, tol: float) -> tuple[np.ndarray, float]:
    """Centres of the cheapest run and its inertia, as its last round met it.

    All runs take their rounds together, so that a round reads the rows once; a run whose centres all moved by `tol` at most
    is over.  Rows are packed into matrices and dealt to all cores once.  The driver holds the runs' centres only.
    """
    spark, width = points.sparkSession, firsts[0].shape[1]

    def pack(batches):
        for batch in batches:
            x = np.asarray(batch[VECTOR].flatten(), dtype=np.float64)
            yield pa.RecordBatch.from_pydict({"x": pa.array([x.tobytes()], pa.binary())})

    dealt = points.select(VECTOR).repartition(spark.sparkContext.defaultParallelism)
    packed = cut(dealt.mapInArrow(pack, "x binary")).rdd.map(lambda r: bytes(r["x"])).persist()
    runs, costs, live = [c.copy() for c in firsts], [0.0] * len(firsts), list(range(len(firsts)))
    for _ in range(max_iter):
        if not live:
            break
        every = np.concatenate([runs[s] for s in live])
        middle, ends = every.mean(axis=0), np.cumsum([0] + [len(runs[s]) for s in live])

        def fold(parts, every=every, middle=middle, ends=ends):
            n, sums, squares = np.zeros(len(every), np.int64), np.zeros(every.shape), 0.0
            for raw in parts:
                x, d = _products(np.frombuffer(raw).reshape(-1, width), every, middle)
                squares += float(np.einsum("ij,ij->", x, x))
                own = np.zeros(d.shape)
                for a, b in zip(ends[:-1], ends[1:]):
                    own[np.arange(len(x)), a + d[:, a:b].argmin(axis=1)] = 1.0
                n += own.sum(axis=0).astype(np.int64)
                sums += own.T @ x
            yield n, sums, squares

        # a task sends one row per centre
        n, sums, squares = packed.mapPartitions(fold).reduce(lambda u, v: tuple(p + q for p, q in zip(u, v, strict=True)))
        c, hit = every - middle, n > 0
        gain = n * np.einsum("ij,ij->i", c, c) - 2 * np.einsum("ij,ij->i", c, sums)
        moved = every.copy()  # a centre without rows stays
        moved[hit] = sums[hit] / n[hit, None] + middle
        far = ((moved - every) ** 2).sum(axis=1) > tol * tol
        still = []
        for s, a, b in zip(live, ends[:-1], ends[1:], strict=True):
            runs[s], costs[s] = moved[a:b], max(squares + float(gain[a:b].sum()), 0.0)
            if far[a:b].any():
                still.append(s)
        live = still
    packed.unpersist()
    best = min(range(len(runs)), key=lambda s: costs[s])
    return runs[best], costs[best]


def lloyd(df: DataFrame, columns: list[str], k: int, row_id: str = "row_id", seed: int = 42, rounds: int = 10) -> DataFrame:
    """(label, center, size) after `rounds` rounds from the k rows with the smallest digests.

    The driver holds k centres; rows are summed per cluster in the tasks before a shuffle.  A cluster without rows keeps its centre.
    """
    points = with_features(df, columns, row_id)
    first = points.orderBy(digest(seed, "row_id"), "row_id").limit(k).collect()
    if len(first) < k:
        raise ValueError(f"fewer than {k} rows")
    centers, sizes = np.array([r[VECTOR] for r in first], dtype=float), [0] * k
    width = centers.shape[1]
    for _ in range(rounds):
        def fold(batches, centers=centers):
            for pdf in batches:
                if len(pdf):
                    x = matrix(pdf)
                    near = block_distances(x, centers, "euclidean_squared").argmin(axis=1)
                    for label in np.unique(near):
                        own = x[near == label]
                        yield pd.DataFrame({"label": [int(label)], "n": [len(own)], "s": [own.sum(axis=0).tolist()]})
        sums = points.mapInPandas(fold, "label int, n bigint, s array<double>").groupBy("label").agg(
            F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[i]) for i in range(width)]).alias("s"))
        centers, sizes = centers.copy(), [0] * k
        for r in sums.collect():  # k rows at most
            centers[r["label"]], sizes[r["label"]] = np.array(r["s"]) / r["n"], r["n"]
    return df.sparkSession.createDataFrame([(i, [float(v) for v in c], int(n)) for i, (c, n) in enumerate(zip(centers, sizes, strict=True))],
                                           "label int, center array<double>, size bigint")


def cluster(df: DataFrame, columns: list[str], k: int, method: str = "single_linkage", metric: str = "euclidean",
            row_id: str = "row_id", seed: int = 42, chosen: list[str] | None = None) -> DataFrame:
    """(row_id, label) by method name; the chosen features if any, else all."""
    features = chosen or columns
    if method not in ("kmeans", "single_linkage"):
        raise ValueError(f"unknown method {method!r}")
    if k < 2:
        raise ValueError("at least two clusters are needed")
    if len(df.select(row_id).limit(k).collect()) < k:
        raise ValueError(f"fewer than {k} rows")
    if method == "kmeans":
        return kmeans(df, features, k, row_id, seed)[0]
    return single_linkage(df, features, k, metric, row_id)


def diagnose(df: DataFrame, columns: list[str], ks=(3, 4, 5), row_id: str = "row_id", seed: int = 42) -> DataFrame:
    """(method, k, max_size, min_size, ratio, chain_effect) for linkage on raw and scaled data and K-means.

    One spanning tree serves every K.
    """
    filled = reduce(fill_mean, columns, df.select(row_id, *columns))
    scaled = standard_scale(filled, columns)
    sizes = []
    for name, table in (("linkage_raw", filled), ("linkage_scaled", scaled)):
        tree, ids, n = spanning_tree(table, columns, row_id=row_id)
        for k in ks:
            sizes.append(partition(tree, ids, n, k).select(F.lit(name).alias("method"), F.lit(k).alias("k"), "label"))
    for k in ks:
        sizes.append(kmeans(scaled, columns, k, row_id, seed, starts=1)[0]
                     .select(F.lit("kmeans").alias("method"), F.lit(k).alias("k"), "label"))
    every = reduce(DataFrame.unionByName, sizes)
    return balance(every.groupBy("method", "k", "label").agg(F.count(F.lit(1)).alias("size")), ["method", "k"])


def scaling_verdict(df: DataFrame, columns: list[str], k: int = 4, row_id: str = "row_id") -> DataFrame:
    """One row: size ratios of linkage on two features, raw and scaled, and advice codes."""
    two = columns[:2]
    filled = reduce(fill_mean, two, df.select(row_id, *two))

    def size_ratio(table: DataFrame) -> float:
        sizes = single_linkage(table, two, k, row_id=row_id).groupBy("label").agg(F.count(F.lit(1)).alias("size"))
        return sizes.agg(F.max("size") / F.min("size")).first()[0]

    # the rounds of a tree are many short jobs that follow one another; both trees share the cluster
    with ThreadPoolExecutor(2) as pool:
        found = pool.map(inheritable_thread_target(df.sparkSession)(size_ratio), (filled, standard_scale(filled, two)))
        ratio = dict(zip(("raw", "scaled"), found, strict=True))
    helps = ratio["scaled"] < 0.8 * ratio["raw"]
    codes = ["scaling_helps" if helps else "scaling_does_not_help"]
    codes += ["use_kmeans", "more_clusters", "remove_outliers", "try_chebyshev"] if ratio["scaled"] > 5 else ["linkage_acceptable"]
    return df.sparkSession.createDataFrame(
        [(float(ratio["raw"]), float(ratio["scaled"]), helps, codes)],
        "raw_ratio double, scaled_ratio double, scaling_helps boolean, codes array<string>")
