"""CSV tables with an explicit schema, null tokens and a row id."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sparkloom.functions.ranks import with_position
from sparkloom.session import cut

# Texts a table reader commonly treats as missing.
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
               "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


OPTIONS = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
_MARK = "\ufeff"


def _reader(spark: SparkSession):
    """Quotes are doubled inside quoted fields; a record is a line."""
    return spark.read.options(**OPTIONS).option("header", True).option("encoding", "UTF-8")


def _marked(batches):
    """Lines of one task in file order: their place, their quotes, and the last line at or before them that starts a record if the
    quotes before their block are even, or odd."""
    now, at, quotes, own = None, 0, 0, [None, None]
    for pdf in batches:
        count = pdf["value"].str.count('"').to_numpy()
        line, even, odd = [], [], []
        for f, b, q in zip(pdf["_f"], pdf["_b"], count, strict=True):
            if (f, b) != now:
                now, at, quotes, own = (f, b), 0, 0, [None, None]
            place = 2 * b + at  # a block has no more lines than bytes, and one
            own[quotes % 2] = place
            line.append(place)
            even.append(own[0])
            odd.append(own[1])
            at += 1
            quotes += int(q)
        yield pdf.assign(_line=line, q=count, even=pd.array(even, "Int64"), odd=pd.array(odd, "Int64"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """(_f, _line, record) of UTF-8 files whose quoted fields may hold line breaks, the header of each file included.

    Files are read in ranges by many tasks, line by line.  A line starts a record if the quotes before it in its file are even.  A
    task counts them inside its ranges for both parities; the parity of a range comes from the counts of those before it, one
    small row each.  The lines of a record are then joined, the only shuffle of the lines.  An unbalanced quote makes the rest of its
    file one record, as in any reader.
    """
    lines = (spark.read.option("lineSep", "\n").text(path)
             .select("value", F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b")))
    marked = cut(lines.mapInPandas(_marked, "value string, _f string, _b bigint, _line bigint, q bigint, even bigint, odd bigint"))
    in_order = Window.partitionBy("_f").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    blocks = (marked.groupBy("_f", "_b").agg(F.sum("q").alias("q"), F.max("even").alias("even"), F.max("odd").alias("odd"))
              .withColumn("is_even", F.coalesce(F.sum("q").over(in_order), F.lit(0)) % 2 == 0)
              .withColumn("open", F.last(F.when(F.col("is_even"), F.col("even")).otherwise(F.col("odd")), True).over(in_order)))
    of = marked.join(cut(blocks.select("_f", "_b", "is_even", "open")), ["_f", "_b"]).withColumn(
        "_record", F.coalesce(F.when(F.col("is_even"), F.col("even")).otherwise(F.col("odd")), F.col("open")))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_line", "value"))), lambda x: x["value"]), "\n")
    joined = of.groupBy("_f", F.col("_record").alias("_line")).agg(text.alias("record"))
    return joined.withColumn("record", F.regexp_replace("record", "\r$", "")).where("record <> ''")


def _texts(spark: SparkSession, path: str, multi_line: bool, names: list[str] | None = None) -> DataFrame:
    """All fields as text, with `_f`, `_b` and `_m`, which order the rows; checks `names` against the header."""
    if not multi_line:
        reader = _reader(spark)
        if names is not None:
            reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in names])).option("enforceSchema", False)
        return reader.csv(path).select("*", F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"),
                                       F.monotonically_increasing_id().alias("_m"))
    found = cut(records(spark, path))
    heads = found.groupBy("_f").agg(F.min("_line").alias("_line"))
    headers = [r["record"].removeprefix(_MARK) for r in found.join(heads, ["_f", "_line"]).select("record").distinct().limit(2).collect()]
    if len(headers) != 1:
        raise ValueError("the files have no header" if not headers else "the files have different headers")
    many = headers[0].count(",") + 1
    split = spark.range(1).select(F.from_csv(F.lit(headers[0]), ", ".join(f"c{i} string" for i in range(many)), OPTIONS).alias("h")).first()["h"]
    columns = [c for c in split if c is not None]
    if names is not None and list(names) != columns:
        raise ValueError(f"the header is {columns}, not {list(names)}")
    ddl = ", ".join(f"`{c.replace('`', '``')}` string" for c in columns)
    rows = found.join(heads.select("_f", F.col("_line").alias("_head")), "_f").where(F.col("_line") != F.col("_head"))
    parsed = rows.select(F.from_csv("record", ddl, OPTIONS).alias("r"), "_f", "_line")
    return parsed.select("r.*", "_f", F.lit(0).cast("bigint").alias("_b"), F.col("_line").alias("_m"))


def infer_schema(spark: SparkSession, path: str, null_tokens=NULL_TOKENS, multi_line: bool = True) -> T.StructType:
    """Narrowest of bigint, double, boolean and string per column, tokens left out.

    One pass of the file read as text columns.
    """
    raw = cut(_texts(spark, path, multi_line)).drop("_f", "_b", "_m")
    checks = []
    for i, c in enumerate(raw.columns):
        v = F.when(~F.col(f"`{c}`").isin(*null_tokens), F.trim(f"`{c}`"))
        checks += [F.count(v).alias(f"n{i}"), F.count(v.try_cast("bigint")).alias(f"b{i}"),
                   F.count(v.try_cast("double")).alias(f"d{i}"),
                   F.count(F.when(F.lower(v).isin("true", "false"), 1)).alias(f"t{i}")]
    row = raw.agg(*checks).first()
    fields = []
    for i, c in enumerate(raw.columns):
        n = row[f"n{i}"]
        kind = (T.StringType() if not n else T.LongType() if row[f"b{i}"] == n else T.DoubleType() if row[f"d{i}"] == n
                else T.BooleanType() if row[f"t{i}"] == n else T.StringType())
        fields.append(T.StructField(c, kind))
    return T.StructType(fields)


def _typed(f: T.StructField, null_tokens):
    """The text of a field without null tokens, and its value."""
    v = F.when(~F.col(f"`{f.name}`").isin(*null_tokens), F.col(f"`{f.name}`"))
    return v, v if isinstance(f.dataType, T.StringType) else F.trim(v).try_cast(f.dataType)


def bad_values(spark: SparkSession, path: str, schema: T.StructType | str, null_tokens=NULL_TOKENS, multi_line: bool = True) -> DataFrame:
    """(column, bad): present values of each column that do not parse as its type."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    raw = _texts(spark, path, multi_line, schema.names)
    tests = [_typed(f, null_tokens) for f in schema.fields]
    one = raw.agg(*[F.count_if(v.isNotNull() & t.isNull()).alias(f"b{i}") for i, (v, t) in enumerate(tests)])
    return one.select(F.inline(F.array(*[F.struct(F.lit(f.name).alias("column"), F.col(f"b{i}").alias("bad"))
                                         for i, f in enumerate(schema.fields)])))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, null_tokens=NULL_TOKENS,
             row_id: str | None = None, key: str | None = None, multi_line: bool = True, strict: bool = False) -> DataFrame:
    """UTF-8 CSV with a header; every null token becomes null before typing.

    `multi_line` lets quoted fields hold line breaks; files are read by many
    tasks all the same (see `records`), with one shuffle of the lines.  A value that does not parse becomes null, or fails the job
    with `strict`; `bad_values` counts them.

    `row_id` adds an id: the value of `key` where the table has one, else the
    line's place in the file order.
    """
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    schema = schema or infer_schema(spark, path, null_tokens, multi_line)
    raw = _texts(spark, path, multi_line, schema.names)
    cols = []
    for f in schema.fields:
        v, typed = _typed(f, null_tokens)
        if strict and not isinstance(f.dataType, T.StringType):
            typed = F.when(v.isNotNull() & typed.isNull(), F.raise_error(F.concat(F.lit(f"column {f.name}: "), v))).otherwise(typed)
        cols.append(typed.alias(f.name))
    if row_id is None:
        return raw.select(*cols)
    if key is not None:
        return raw.select(*cols).withColumn(row_id, F.col(key).cast("bigint"))
    return with_position(raw.select(*cols, "_f", "_b", "_m"), ["_f", "_b", "_m"], row_id).drop("_f", "_b", "_m")


def write_csv(df: DataFrame, path: str) -> str:
    (df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path
