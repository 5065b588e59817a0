"""The corpus pipeline: five stages over `documents`, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm import line_mph, shingle_links, simhash_ball, sp_wfst, spaced_seeds, subword_classifier
from sparkloom.llm.common import staged
from sparkloom.plans.registry import table
from sparkloom.session import ship_package

#: The trained stages have no SQL.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the classifier, taught by the labelled documents of its input, takes for label 0."""
    model = subword_classifier.fit(docs, table(spark, sf_dir, "labels"))
    return subword_classifier.keep_good(docs, model)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes lines out that a smaller doc_id holds; n_chars counts what is left.

    All other columns travel in one struct, so that none can clash with what the operator returns.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    packed = docs.select("doc_id", "text", *([F.struct(*others).alias("carried")] if others else []))
    kept = line_mph.dedup_lines(packed, carry=packed.columns[2:])
    own = {"doc_id": F.col("doc_id"), "text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return kept.select(*(own.get(c, F.col("carried").getField(c)).alias(c) for c in docs.columns))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves the smallest doc_id of each group whose five-word shingles agree by four fifths or more.

    SimHash balls over five-word shingles propose groups, in which all members are verified on the shingles; the bands find what
    balls miss.
    """
    balls = simhash_ball.near_duplicates(docs, shingle_links.SHINGLE)
    return shingle_links.drop_near_duplicates(docs, balls)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold an item of the benchmark."""
    return spaced_seeds.clean(docs, table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of what is left, and whether they decode to the text."""
    import public_tokenizers
    return sp_wfst.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("benchmark", benchmark_stage),
    ("tokens", token_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
