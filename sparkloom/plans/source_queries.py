"""Registered queries: CSV, stored runs, specifications and reusable tables.

Each one writes its table below the shared folder and reads it back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.operators import encode, profile
from sparkloom.plans.registry import query, r, rounded, rs, table
from sparkloom.plans.tables import FIT_SPEC
from sparkloom.session import drop_at_exit, scratch_path
from sparkloom.sources import csv, reuse, runs
from sparkloom.sources.spec import TableSpec

CUSTOMER_SCHEMA = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@query(f"""SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_name END AS c_name, c_nationkey, {rs('c_acctbal')} AS c_acctbal,
CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE c_mktsegment END AS c_mktsegment, c_custkey AS row_id FROM customer""")
def csv_scan(spark, sf):
    c = table(spark, sf, "customer").withColumn("c_name", F.when(F.col("c_custkey") % 7 == 0, "None").otherwise(F.col("c_name")))
    path = csv.write_csv(c, scratch_path(spark, "csv"))
    out = csv.read_csv(spark, path, CUSTOMER_SCHEMA, (*csv.NULL_TOKENS, "HOUSEHOLD"), row_id="row_id", key="c_custkey")
    return rounded(out, ["c_acctbal"])


@query("SELECT doc_id, text, source FROM documents")
def csv_documents(spark, sf):
    """Quotes and line breaks inside fields survive."""
    d = table(spark, sf, "documents").select("doc_id", "text", "source")
    return csv.read_csv(spark, csv.write_csv(d, scratch_path(spark, "csv")), "doc_id bigint, text string, source string", strict=True)


@query("""SELECT 'p_partkey' AS "column", 0::BIGINT AS bad UNION ALL SELECT 'p_type', count(*) FILTER (TRY_CAST(p_type AS DOUBLE) IS NULL) FROM part
UNION ALL SELECT 'p_retailprice', count(*) FILTER (p_retailprice <> floor(p_retailprice)) FROM part""")
def csv_bad_values(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_type", "p_retailprice")
    path = csv.write_csv(p.withColumn("p_retailprice", F.when(F.col("p_retailprice") == F.floor("p_retailprice"), "1").otherwise("x")),
                         scratch_path(spark, "csv"))
    return csv.bad_values(spark, path, "p_partkey bigint, p_type double, p_retailprice bigint")


@query(" UNION ALL ".join(f"""SELECT '{c}' AS "column", CASE WHEN bool_and(regexp_full_match({c}::VARCHAR, '-?[0-9]+')) THEN 'bigint'
WHEN bool_and(TRY_CAST({c} AS DOUBLE) IS NOT NULL) THEN 'double' ELSE 'string' END AS dtype, count(*) AS "rows" FROM customer"""
                          for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")))
def csv_inferred(spark, sf):
    path = csv.write_csv(table(spark, sf, "customer"), scratch_path(spark, "csv"))
    df = csv.read_csv(spark, path)
    types = F.array(*[F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype")) for f in df.schema.fields])
    return df.agg(F.count(F.lit(1)).alias("rows")).select("rows", F.inline(types))


# partitions of parts by key, standing for a clustering history
KS = [2, 3, 4, 10]


def part_history(spark, sf):
    part = table(spark, sf, "part").withColumnRenamed("p_partkey", "row_id").select("row_id", "p_size", "p_retailprice")
    labels = part.select("row_id", F.explode(F.array(*[F.lit(k) for k in KS])).alias("k")).withColumn("label", (F.col("row_id") % F.col("k")).cast("int"))
    return part, labels


def stored_run(spark, sf):
    part, labels = part_history(spark, sf)
    folder = scratch_path(spark, "runs")
    return folder, runs.write_results(part, labels, KS, folder, "20240101_000000")


@query(f"SELECT p_partkey AS row_id, k::INTEGER AS k, (p_partkey % k)::INTEGER AS label FROM part, (VALUES {', '.join(f'({k})' for k in KS)}) v(k)")
def stored_results(spark, sf):
    wide, _, ks = runs.read_results(spark, stored_run(spark, sf)[1])
    return runs.long_labels(wide, ks)


@query(f"SELECT p_partkey AS row_id, p_size, {rs('p_retailprice')} AS p_retailprice, {', '.join(f'(p_partkey % {k})::INTEGER AS cluster_k{k:03d}' for k in KS)} FROM part")
def wide_results(spark, sf):
    part, labels = part_history(spark, sf)
    return rounded(runs.wide_results(part, labels, KS), ["p_retailprice"])


@query("SELECT '20240202_000000' AS run_id, count(*) AS \"rows\" FROM part")
def latest_results(spark, sf):
    part, labels = part_history(spark, sf)
    folder, _ = stored_run(spark, sf)
    runs.write_results(part, labels, [2, 3], folder, "20240202_000000")
    newest = runs.latest_results(spark, folder)
    wide, _, _ = runs.read_results(spark, newest)
    stamp = newest.rsplit("clustering_results_", 1)[1].removesuffix(".csv")
    return wide.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(stamp).alias("run_id"), "rows")


@query(f"SELECT p_partkey AS row_id, p_size::BIGINT AS p_size, {rs('p_retailprice')} AS p_retailprice, p_partkey % 3 AS cluster FROM part")
def export_k(spark, sf):
    wide, features, _ = runs.read_results(spark, stored_run(spark, sf)[1])
    path = scratch_path(spark, "export")
    runs.export_k(wide, features, 3, path)
    return rounded(csv.read_csv(spark, path), ["p_retailprice"])


@query("""SELECT '20240101_000000' AS run_id, 2 AS min_clusters, 10 AS max_clusters, 'chebyshev' AS metric, count(*) AS row_count,
'p_size|p_retailprice' AS features, '10|4|3|2' AS k_values FROM part""")
def run_metadata(spark, sf):
    folder, path = stored_run(spark, sf)
    wide, features, ks = runs.read_results(spark, path)
    runs.write_metadata(spark, folder, {"run_id": "20240101_000000", "min_clusters": min(ks), "max_clusters": max(ks), "metric": "chebyshev",
                                        "row_count": wide.count(), "features": features, "k_values": ks})
    return runs.read_metadata(spark, path).select(
        "run_id", "min_clusters", "max_clusters", "metric", "row_count", F.array_join("features", "|").alias("features"),
        F.array_join(F.transform("k_values", lambda k: k.cast("string")), "|").alias("k_values"))


@query("""SELECT o_orderstatus AS value, count(*) AS "count", 'onehot' AS encoding FROM orders GROUP BY 1""")
def spec_roundtrip(spark, sf):
    orders = table(spark, sf, "orders")
    path = scratch_path(spark, "spec")
    profile.default_spec(profile.column_profile(orders, ["o_orderstatus", "o_totalprice"], medians=False)).save(spark, path)
    spec = TableSpec.load(spark, path)
    counts = profile.value_counts(orders, [c.name for c in spec.columns.values() if c.encoding == "onehot"])
    return counts.select("value", "count", F.lit(spec.columns["o_orderstatus"].encoding).alias("encoding"))


@query(f"""SELECT p_partkey AS row_id, {rs('(p_size - min(p_size) OVER ()) / (max(p_size) OVER () - min(p_size) OVER ())::DOUBLE')} AS p_size,
{rs('(p_retailprice - avg(p_retailprice) OVER ()) / stddev_pop(p_retailprice) OVER ()')} AS p_retailprice, 1::BIGINT AS tables, 2::BIGINT AS null_tables FROM part""")
def reusable_table(spark, sf):
    part = table(spark, sf, "part").withColumn("row_id", F.col("p_partkey"))
    folder = scratch_path(spark, "tables")
    build = lambda source, spec: encode.fit_transform(source, spec)[0]
    reuse.materialise_if_stale(part, FIT_SPEC, folder, build)
    again = reuse.materialise_if_stale(part.repartition(3), FIT_SPEC, folder, build)  # same content, other order
    kept = reuse.stored(spark, folder).count()
    # the same values with the null in another column are another table
    nulls, none = scratch_path(spark, "tables"), F.lit(None).cast("string")
    for other in ({"p_brand": none}, {"p_name": none, "p_brand": F.col("p_name")}):
        reuse.materialise_if_stale(part.withColumns(other), FIT_SPEC, nulls, lambda source, spec: source)
    return rounded(again, ["p_size", "p_retailprice"]).select(
        "row_id", "p_size", "p_retailprice", F.lit(kept).cast("bigint").alias("tables"),
        F.lit(reuse.stored(spark, nulls).count()).cast("bigint").alias("null_tables"))


@query("""SELECT * FROM (VALUES (1, 3::BIGINT, 3::BIGINT, (SELECT count(*) FROM part), true), (2, 3::BIGINT, 0::BIGINT, (SELECT count(*) FROM part), true),
(3, 4::BIGINT, 1::BIGINT, (SELECT count(*) + count(*) FILTER (p_size > 25) FROM part), true)) t(step, files, hashed_files, n_rows, same)""")
def file_ledger(spark, sf):
    """Fingerprints of a growing table of files: all new, nothing new, one file more."""
    part = table(spark, sf, "part")
    root, ledger = scratch_path(spark, "files"), scratch_path(spark, "ledger")
    drop_at_exit(spark, root)
    drop_at_exit(spark, ledger)
    steps = []
    for more in (part.repartition(3, "p_partkey"), None, part.where("p_size > 25").coalesce(1)):
        if more is not None:
            more.write.mode("append").parquet(root)
        files = spark.read.parquet(root)
        got = reuse.file_fingerprint(files, root, ledger)
        steps.append((len(steps) + 1, got.files, got.hashed_files, got.rows, got.fingerprint == reuse.content_fingerprint(files)))
    return spark.createDataFrame(steps, "step int, files bigint, hashed_files bigint, n_rows bigint, same boolean")
