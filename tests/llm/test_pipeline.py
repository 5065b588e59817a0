"""The pipeline's stages, one after the other, each judged on its own input."""

from pyspark.sql import functions as F

import corpus_pipeline
from sparkloom.llm import common, line_mph, shingle_links, simhash_ball, spaced_seeds


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = common.staged(stage(spark, before, sf), name)
        assert sorted(after.columns) == sorted(columns)
        ids, left = ({r.doc_id for r in x.select("doc_id").collect()} for x in (before, after))
        assert left <= ids and len(left) == after.count()
        if name == "quality":
            bad = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 0").collect()}
            assert len(bad & left) <= 0.1 * len(bad)
        if name == "lines":
            assert left == ids and line_mph.dedup_lines(after).agg({"n_dropped": "sum"}).first()[0] == 0
        if name == "near_duplicates":
            assert left == {r.component_id for r in shingle_links.near_duplicates(before).collect()}
        if name == "benchmark":
            assert spaced_seeds.find_leaks(after, spark.read.parquet(f"{sf}/benchmark.parquet")).count() == 0
        before = after
    out = corpus_pipeline.STAGES[-1][1](spark, before, sf).collect()
    assert {r.doc_id for r in out} == left and all(r.round_trip for r in out)


#: Every name that an operator returns or uses inside.
CLASHING = ("n_lines long, n_dropped long, kept_sha256 string, carried int, fp long, root string, node long, component_id long, key long, size int, "
            "gid long, els binary, _gone long, at long, least long, salt int, part int, score double, predicted int, held_out boolean, quality int, "
            "item_id long, start long, found int, pack_id long, body binary, replies int, ids binary, pieces string, round_trip boolean, n_tokens long")


def test_stages_take_empty_tables_nulls_and_other_columns(spark, sf, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + CLASHING
    none = (None,) * len(CLASHING.split(","))
    rows = [(1, None, None, None, None, *none), (2, "", "en", "s", 0, *none), (None, "no id here", "en", None, 10, *none),
            (3, "some words of a text that stay", "en", "s", 30, *none), (3, "some words of a text that stay", "en", "s", 30, *none),
            (4, "w " * 100_000, "en", "s", 200_000, *none)]
    for given in (rows, []):
        docs = spark.createDataFrame(given, schema)
        for name, stage in corpus_pipeline.STAGES[1:-1]:
            after = common.staged(stage(spark, docs, sf), name)
            assert after.columns == docs.columns and after.count() <= len(given)
            docs = after
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == docs.count()
    labelled = spark.read.parquet(f"{sf}/documents.parquet")
    wide = labelled.select("*", *(F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in CLASHING.split(", ")))
    assert corpus_pipeline.STAGES[0][1](spark, wide, sf).columns == wide.columns
    assert corpus_pipeline.STAGES[0][1](spark, spark.createDataFrame([], schema), sf).count() == 0
    assert simhash_ball.near_duplicates(spark.createDataFrame([], schema)).count() == 0
