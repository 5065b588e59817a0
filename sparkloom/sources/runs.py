"""Clustering runs: results, their reader, the newest run and run metadata."""

from __future__ import annotations

import os
import re
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.sources.csv import read_csv, write_csv

LABEL_COLUMN = re.compile(r"cluster_k(\d+)$")
META_SCHEMA = ("run_id string, start_time string, end_time string, duration_seconds double, min_clusters int, "
               "max_clusters int, metric string, row_count bigint, feature_count int, features array<string>, "
               "k_values array<int>, expected_k_count int, actual_k_count int, merges bigint")


def run_stamp(at: datetime | None = None) -> str:
    return (at or datetime.now(timezone.utc)).strftime("%Y%m%d_%H%M%S")


def label_name(k: int) -> str:
    return f"cluster_k{k:03d}"


def wide_results(features: DataFrame, labels: DataFrame, ks: list[int], row_id: str = "row_id") -> DataFrame:
    """Features plus one label column per K, K descending; the K list is given, so no extra job finds it."""
    ks = sorted(ks, reverse=True)
    pivot = (labels.groupBy("row_id").pivot("k", ks).agg(F.first("label"))
             .select(F.col("row_id").alias("_r"), *[F.col(f"`{k}`").alias(label_name(k)) for k in ks]))
    return features.join(pivot, features[row_id] == pivot["_r"], "left").drop("_r")


def write_results(features: DataFrame, labels: DataFrame, ks: list[int], folder: str, run_id: str | None = None,
                  row_id: str = "row_id", keep_row_id: bool = True) -> str:
    """Checks the label counts and writes `clustering_results_<stamp>.csv`."""
    n = features.count()
    counts = {r["k"]: r["n"] for r in labels.groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per K
    if not counts:
        raise ValueError("no partitions to store")
    for k in ks:
        if counts.get(k) != n:
            raise ValueError(f"K={k}: {counts.get(k, 0)} labels for {n} rows")
    wide = wide_results(features, labels, ks, row_id)
    if not keep_row_id:
        wide = wide.drop(row_id)
    return write_csv(wide, os.path.join(folder, f"clustering_results_{run_id or run_stamp()}.csv"))


def read_results(spark: SparkSession, path: str, row_id: str = "row_id") -> tuple[DataFrame, list[str], list[int]]:
    """(table, feature columns, K's descending); needs two features and one K."""
    names = spark.read.option("header", True).csv(path).columns
    has_id = row_id in names
    df = read_csv(spark, path, row_id=None if has_id else row_id)
    features = [c for c in df.columns if not c.startswith("cluster_") and c != row_id]
    ks = sorted((int(m.group(1)) for c in df.columns if (m := LABEL_COLUMN.match(c))), reverse=True)
    if len(features) < 2:
        raise ValueError("a result needs at least two features")
    if not ks:
        raise ValueError("a result needs at least one label column")
    return df, features, ks


def long_labels(df: DataFrame, ks: list[int], row_id: str = "row_id") -> DataFrame:
    """(row_id, k, label) from the wide table."""
    return (df.unpivot(row_id, [label_name(k) for k in ks], "name", "label")
            .select(F.col(row_id).alias("row_id"), F.regexp_extract("name", r"cluster_k(\d+)", 1).cast("int").alias("k"),
                    F.col("label").cast("int").alias("label")))


def _children(spark: SparkSession, folder: str, pattern: str) -> list[tuple[int, str]]:
    """(modification time, path) of the entries of a folder on any Hadoop file system."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(os.path.join(folder, pattern))
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted((s.getModificationTime(), s.getPath().toString()) for s in (found or []))


def latest_results(spark: SparkSession, folder: str) -> str | None:
    """Newest result of a folder by modification time."""
    found = _children(spark, folder, "clustering_results_*.csv")
    return found[-1][1] if found else None


def default_k(labels: DataFrame) -> DataFrame:
    """One row: the middle of the descending K list."""
    ks = F.sort_array(F.collect_set("k"), False)  # one entry per K
    return labels.agg(F.element_at(ks, (F.size(ks) / 2).cast("int") + 1).alias("k"))


def export_k(df: DataFrame, features: list[str], k: int, path: str | None = None, row_id: str = "row_id") -> DataFrame:
    """Features and the labels of one K as `cluster`; written as CSV when a path is given."""
    keep = [row_id] if row_id in df.columns else []
    out = df.select(*keep, *features, F.col(label_name(k)).alias("cluster"))
    if path:
        write_csv(out, path)
    return out


def write_metadata(spark: SparkSession, folder: str, meta: dict) -> str:
    """One JSON row per run next to its results."""
    names = [f.split()[0] for f in META_SCHEMA.split(", ")]
    path = os.path.join(folder, f"clustering_metadata_{meta['run_id']}.json")
    spark.createDataFrame([tuple(meta.get(n) for n in names)], META_SCHEMA).coalesce(1).write.mode("overwrite").json(path)
    return path


def read_metadata(spark: SparkSession, results_path: str) -> DataFrame:
    """Metadata matched to a result by the run stamp in its name."""
    stamp = re.search(r"clustering_results_(.+)\.csv", results_path).group(1)
    return spark.read.schema(META_SCHEMA).json(os.path.join(os.path.dirname(results_path), f"clustering_metadata_{stamp}.json"))
