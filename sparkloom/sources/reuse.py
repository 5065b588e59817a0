"""Reusable processed tables keyed by the source's content and the specification."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.session import cut
from sparkloom.sources.spec import TableSpec


FILES_A_PASS = 1000


def _sums(df: DataFrame) -> list[Column]:
    """n, a, b: the row count and two sums of hashes, which add up over parts of the rows.

    Two independent 64-bit hashes are summed as decimals, which cannot overflow.
    The hash skips nulls, so each column goes in with its null flag.
    """
    cols = [x for c in sorted(df.columns) for x in (F.isnull(f"`{c}`"), F.col(f"`{c}`"))]
    return [F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*cols).cast("decimal(20,0)")).alias("a"),
            F.sum(F.xxhash64(F.lit("second"), *cols).cast("decimal(20,0)")).alias("b")]


def _schema_of(df: DataFrame) -> str:
    return df.select(*[f"`{c}`" for c in sorted(df.columns)]).schema.simpleString()


def _digest(schema: str, row) -> str:
    return hashlib.md5(f"{schema}|{row['n']}|{row['a']}|{row['b']}".encode()).hexdigest()


def content_fingerprint(df: DataFrame) -> str:
    """Order-free content hash and row count, one pass without a shuffle of rows."""
    return _digest(_schema_of(df), df.agg(*_sums(df)).first())


@dataclass
class FileFingerprint:
    """Fingerprint of a table of files, and how many of them had to be read for it."""
    fingerprint: str
    rows: int
    files: int
    hashed_files: int


def file_fingerprint(source: DataFrame, root: str, ledger: str) -> FileFingerprint:
    """The `content_fingerprint` of a table read from the files below `root`, reading only files not seen before.

    `ledger` is a Parquet table with the sums of every file by path, size, time of change and schema.  The listing reads
    no content, new files are hashed `FILES_A_PASS` at a time (a filter on their paths keeps the scan from the others),
    and the sums of the files that are there now are added up.  A file that is overwritten has another time or size and is
    read again; sums of files that are gone stay in the ledger and are not used.
    """
    spark = source.sparkSession
    schema = _schema_of(source)
    key = ["path", "size", "changed"]
    about = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"),
             F.col("_metadata.file_modification_time").cast("double").alias("changed")]
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
              .select(*about).where(~F.element_at(F.split("path", "/"), -1).rlike("^[._]")))
    columns = "path string, size bigint, changed double, schema string, n bigint, a decimal(38,0), b decimal(38,0)"
    fs, p = _file_system(spark, ledger)

    def known() -> DataFrame:
        rows = spark.read.schema(columns).parquet(ledger) if fs.exists(p) else spark.createDataFrame([], columns)
        return rows.where(F.col("schema") == F.lit(schema)).dropDuplicates(key)

    new = sorted(r["path"] for r in listed.join(known(), key, "left_anti").collect())  # paths, as in the scan's own file index
    for at in range(0, len(new), FILES_A_PASS):
        part = source.where(F.col("_metadata.file_path").isin(new[at:at + FILES_A_PASS]))
        read = cut(part.groupBy(*about).agg(*_sums(source)).select(
            *key, F.lit(schema).alias("schema"), "n", F.col("a").cast("decimal(38,0)").alias("a"),
            F.col("b").cast("decimal(38,0)").alias("b")), "ledger")
        # a file without rows gets sums too, or it would be read every time
        empty = (listed.where(F.col("path").isin(new[at:at + FILES_A_PASS])).join(read.select(*key), key, "left_anti")
                 .select(*key, F.lit(schema).alias("schema"), F.lit(0).cast("bigint").alias("n"),
                         *[F.lit(0).cast("decimal(38,0)").alias(c) for c in ("a", "b")]))
        read.unionByName(empty).write.mode("append").parquet(ledger)
    row = listed.join(known(), key).agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.sum(F.when(F.col("n") > 0, F.col("a"))).alias("a"), F.sum(F.when(F.col("n") > 0, F.col("b"))).alias("b")).first()
    return FileFingerprint(_digest(schema, row), row["n"], row["files"], len(new))


def spec_fingerprint(spec: TableSpec) -> str:
    return hashlib.md5(spec.to_json().encode()).hexdigest()


def _path(folder: str, source: DataFrame, spec: TableSpec, fingerprint: str | None = None) -> str:
    return os.path.join(folder, f"{fingerprint or content_fingerprint(source)}-{spec_fingerprint(spec)}")


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _complete(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, os.path.join(path, "_SUCCESS"))
    return fs.exists(p)


def is_fresh(source: DataFrame, spec: TableSpec, folder: str) -> bool:
    """Whether a finished table exists for this content and specification."""
    return _complete(source.sparkSession, _path(folder, source, spec))


def materialise_if_stale(source: DataFrame, spec: TableSpec, folder: str,
                         build: Callable[[DataFrame, TableSpec], DataFrame], fingerprint: str | None = None) -> DataFrame:
    """The stored table if it is fresh, else `build` it and store it as parquet.

    `fingerprint` is that of the source where it is known (`file_fingerprint`); else the whole source is hashed.
    """
    spark = source.sparkSession
    path = _path(folder, source, spec, fingerprint)
    if not (spec.reuse and _complete(spark, path)):
        build(source, spec).write.mode("overwrite").parquet(path)
        spec.save(spark, path + ".spec")
    return spark.read.parquet(path)


def stored(spark: SparkSession, folder: str) -> DataFrame:
    """(path, source, spec, modified) of the stored tables."""
    fs, p = _file_system(spark, os.path.join(folder, "*-*"))
    rows = []
    for s in fs.globStatus(p) or []:
        name = s.getPath().getName()
        if not name.endswith(".spec") and _complete(spark, s.getPath().toString()):
            content, spec = name.split("-", 1)
            rows.append((s.getPath().toString(), content, spec, s.getModificationTime()))
    return spark.createDataFrame(rows, "path string, source string, spec string, modified bigint")


def clear(spark: SparkSession, folder: str) -> int:
    """Deletes the stored tables of a folder; the number removed."""
    rows = stored(spark, folder).collect()
    for r in rows:
        for path in (r["path"], r["path"] + ".spec"):
            fs, p = _file_system(spark, path)
            fs.delete(p, True)
    return len(rows)
