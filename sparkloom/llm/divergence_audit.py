"""Source divergence audit: which sources of a language use other terms than the rest, and which terms they are.

The tokenizer is one translate table: `bytes.translate` makes A-Z small and blanks every other ASCII byte in one pass, `bytes.split`
yields the terms and a Counter per document their frequencies.  A task adds its documents up per (lang, source) and sends sparse
(lang, source, term, occurrences, documents) rows; all later work is on those sums.

The divergence of two sources is a sum over all kept terms of their language, of which most are missing in either source.  It is
split so that no missing term is visited: per source, the histogram of its shares against the share of a missing term of every
other source; plus, for terms that two sources have in common, what that takes too much.  Pairs of sources are the result itself
and come from sums; they are never listed per term outside a task.

Defined results: null text, lang and source are the empty string; a group without terms, or a language without kept terms, has
its rows with value 0; a very long text costs its length once; repeated rows count each time, whether their doc_id is null, equal
or not; ties rank by the bytes of the item; an empty table gives no rows; other columns, of whatever name, play no part.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.llm import common

TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
SCALE = 1_000_000_000  # shares are whole billionths
MIN_DOCS = 10
TOP_TERMS = 10
HELD_TERMS = 400_000  # entries that a task sums up before it sends them
CELLS = 1 << 20  # pairs of shares that a task lays out at once


def terms(text: str) -> Counter:
    """Frequencies of the terms of one text, as bytes."""
    return Counter(text.encode("utf-8", "surrogatepass").translate(TABLE).split())


# ---------------------------------------------------------------------------
# sparse counts
# ---------------------------------------------------------------------------

_COUNTS = "lang string, source string, term string, n long, docs long"


def _sums(held: dict) -> pa.RecordBatch:
    cols: dict[str, list] = {"lang": [], "source": [], "term": [], "n": [], "docs": []}
    for (lang, source), (docs, extra) in held.items():
        cols["lang"] += [lang] * len(docs)
        cols["source"] += [source] * len(docs)
        cols["term"] += docs.keys()
        cols["docs"] += docs.values()
        cols["n"] += [v + extra.get(t, 0) for t, v in docs.items()]
    types = {"lang": pa.string(), "source": pa.string(), "n": pa.int64(), "docs": pa.int64()}
    return pa.RecordBatch.from_pydict({k: pa.array(v, pa.binary()).cast(pa.string()) if k == "term" else pa.array(v, types[k])
                                       for k, v in cols.items()})


def _counted(batches):
    held: dict = defaultdict(lambda: (Counter(), Counter()))
    size = 0
    for batch in batches:
        for lang, source, text in zip(*(batch[c].to_pylist() for c in ("lang", "source", "text")), strict=True):
            found = terms(text)
            docs, extra = held[lang, source]
            size -= len(docs)
            docs.update(found.keys())
            size += len(docs)
            for t, v in found.items():
                if v > 1:
                    extra[t] += v - 1
            if size > HELD_TERMS:
                yield _sums(held)
                held.clear()
                size = 0
    yield _sums(held)


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in each source."""
    return _plain(docs).mapInArrow(_counted, _COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


# ---------------------------------------------------------------------------
# shares and their divergence, in whole numbers
# ---------------------------------------------------------------------------


def share(count: str, total: str, kept: str) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * kept)); the product needs more than 64 bits."""
    return F.expr(f"1 + ((CAST({count} + 2 AS DECIMAL(28,0)) * {SCALE}) div CAST({total} + 2 * {kept} AS DECIMAL(28,0)))")


def far(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def _far(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


_PAIR = "lang string, a int, b int, value long"


def _pairs(lang: list, a: list, b: list, value: list) -> pa.Table:
    return pa.table({"lang": pa.array(lang, pa.string()), "a": pa.array(a, pa.int32()), "b": pa.array(b, pa.int32()), "value": pa.array(value, pa.int64())})


def _against_missing(shares: pa.Table, group: pa.Table) -> pa.Table:
    """One source's terms against their absence in every other source of the language.

    The same amount belongs to both orders of a pair.  Terms that both lack are counted here too: all kept terms once per order,
    less the source's own.
    """
    row = group.to_pylist()[0]
    others = [x for x in row["others"] if x["g"] != row["g"]]
    b, absent = (np.array([x[c] for x in others], np.int64) for c in ("g", "p0"))
    own = np.zeros(len(others), np.int64)
    if row["kept"]:
        p, n = shares["p"].to_numpy(), shares["terms"].to_numpy()
        step = max(1, CELLS // max(1, len(p)))
        for at in range(0, len(others), step):
            own[at:at + step] = (_far(p[None, :], absent[at:at + step, None]) * n[None, :]).sum(axis=1)
        neither = _far(absent, np.int64(row["p0"]))
        own -= neither * int(n.sum())
        total = own + neither * row["kept"]
    else:
        total = own
    g = [row["g"]] * len(others)
    return _pairs([row["lang"]] * (2 * len(others)), g + b.tolist(), b.tolist() + g, total.tolist() + own.tolist())


def _merged(codes: list, values: list) -> tuple[np.ndarray, np.ndarray]:
    code, at = np.unique(np.concatenate(codes), return_inverse=True)
    total = np.zeros(len(code), np.int64)
    np.add.at(total, at, np.concatenate(values))
    return code, total


def _together(batches):
    """What terms found in two sources add to, or take from, the amounts of `_against_missing`."""
    held: dict = defaultdict(lambda: ([], []))
    size = 0

    def send():
        for lang, (codes, values) in held.items():
            code, total = _merged(codes, values)
            yield from _pairs([lang] * len(code), (code >> 32).tolist(), (code & 0xFFFFFFFF).tolist(), total.tolist()).to_batches()
        held.clear()

    for batch in batches:
        flat = batch["found"].flatten()
        g, p, p0 = (flat.field(i).to_numpy().astype(np.int64) for i in range(3))
        ends = np.cumsum(pa.compute.list_value_length(batch["found"]).to_numpy())
        k, langs = np.diff(np.r_[0, ends]), np.array(batch["lang"].to_pylist(), object)
        for width in np.unique(k[k > 1]).tolist():
            for lang in dict.fromkeys(langs[k == width]):
                starts = (ends - k)[(k == width) & (langs == lang)]
                rows, tile = max(1, CELLS // width ** 2), max(1, CELLS // width)
                for i in range(0, len(starts), rows):
                    at = starts[i:i + rows, None] + np.arange(width)[None, :]
                    for t in range(0, width, tile):
                        x, y = at[:, t:t + tile, None], at[:, None, :]
                        value = _far(p[x], p[y]) - _far(p[x], p0[y]) - _far(p0[x], p[y]) + _far(p0[x], p0[y])
                        off = g[x] != g[y]
                        codes, values = held[lang]
                        code, total = _merged([(g[x] << 32 | g[y])[off]], [value[off]])
                        codes.append(code)
                        values.append(total)
                        size += len(code)
                        if size > CELLS:
                            yield from send()
                            size = 0
    yield from send()


# ---------------------------------------------------------------------------
# operator
# ---------------------------------------------------------------------------


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): `pair` rows name every other source of the language with the divergence from it,
    `term` rows the `top_terms` terms that the source has more of than its language."""
    kept = common.staged(
        term_counts(docs).groupBy("lang", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("found"))
        .where(F.col("docs") >= min_docs), "terms")
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("n").alias("lang_total"))
    single = kept.select("lang", "term", F.col("n").alias("lang_n"), F.explode("found").alias("f")).select("lang", "term", "lang_n", "f.source", "f.n")
    totals = single.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = common.staged(
        _plain(docs).select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
        .na.fill(0, ["total", "kept", "lang_total"])
        .withColumn("g", F.row_number().over(Window.partitionBy("lang").orderBy("source")))
        .withColumn("p0", F.when(F.col("kept") > 0, share("0L", "total", "kept")).otherwise(1)), "groups")
    sparse = common.staged(single.join(groups, ["lang", "source"]).withColumn("p", share("n", "total", "kept")), "shares")

    mine = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    term = (sparse.withColumn("q", share("lang_n", "lang_total", "kept")).where("p > q")
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), far("p", "q").alias("value"))
            .withColumn("rank", F.row_number().over(mine)).where(F.col("rank") <= top_terms))

    shares = sparse.groupBy("lang", "g", "p").agg(F.count("*").alias("terms"))
    others = groups.groupBy("lang").agg(F.collect_list(F.struct("g", "p0")).alias("others"))
    alone = (shares.groupBy("lang", "g")
             .cogroup(groups.select("lang", "g", "p0", "kept").join(others, "lang").groupBy("lang", "g")).applyInArrow(_against_missing, _PAIR))
    common_terms = (sparse.groupBy("lang", "term").agg(F.collect_list(F.struct("g", "p", "p0")).alias("found"))
                    .where(F.size("found") > 1).select("lang", "found").mapInArrow(_together, _PAIR))
    summed = alone.union(common_terms).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    pair = (summed.join(groups.select("lang", F.col("g").alias("a"), "source"), ["lang", "a"])
            .join(groups.select("lang", F.col("g").alias("b"), F.col("source").alias("item")), ["lang", "b"])
            .select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(mine)))
    return pair.union(term)
