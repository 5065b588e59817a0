"""Registered queries: distances, linkage, partitions, agreement, feature search."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.functions.hashing import digest_sql
from sparkloom.operators import clustering, distances, encode, linkage, privacy, quality, selection
from sparkloom.plans import clustering_run
from sparkloom.plans.privacy_queries import binned_sql
from sparkloom.plans.registry import query, r, rounded, rs, table, whole
from sparkloom.session import cut, scratch_path
from sparkloom.sources import runs
from sparkloom.sources.spec import ColumnSpec, TableSpec

DIMS = [f"e{i}" for i in range(1, 65)]


def emb_sql(scale=lambda d: "") -> str:
    """All dimensions as columns, each followed by `scale` of its name."""
    return "(SELECT vec_id AS id, " + ", ".join(f"embedding[{i}]::DOUBLE{scale(d)} AS {d}" for i, d in enumerate(DIMS, 1)) + ", label FROM embeddings)"


EMB = emb_sql()


def emb(spark, sf):
    return table(spark, sf, "embeddings").selectExpr(
        "vec_id AS row_id", *[f"cast(embedding[{i}] AS double) AS {d}" for i, d in enumerate(DIMS)], "label")


# ten times the embedding, so that the total variance passes the guard of the feature search
EMB10 = emb_sql(lambda d: " * 10")


def emb10(spark, sf):
    return emb(spark, sf).withColumns({d: F.col(d) * 10 for d in DIMS})


def dist_sql(a: str, b: str, dims: list[str], metric: str = "euclidean") -> str:
    if metric == "chebyshev":
        return "greatest(" + ", ".join(f"abs({a}.{d} - {b}.{d})" for d in dims) + ")"
    total = " + ".join(f"({a}.{d} - {b}.{d}) * ({a}.{d} - {b}.{d})" for d in dims)
    return f"sqrt({total})" if metric == "euclidean" else f"({total})"


def tree_sql(source: str, dims: list[str], metric: str = "euclidean", prefix: str = "") -> str:
    """Recursive CTEs: `mst` (ranked edges of the spanning tree) and `merges` (list of cluster keys after s merges).

    A cluster's key is its last merge step, or a negative number by row order
    for a row that never merged.
    """
    p = prefix
    cols = ", ".join(dims)
    nd = dist_sql("k", "r", dims, metric)
    new = f"{{'d': {nd}, 'lo': least(k.id, r.id), 'hi': greatest(k.id, r.id)}}"
    first = f"{{'d': {dist_sql('k', 'r', dims, metric)}, 'lo': least(k.id, r.id), 'hi': greatest(k.id, r.id)}}"
    pack = ", ".join(f"'{d}': {d}" for d in dims)
    return f"""{p}pts AS MATERIALIZED (SELECT id, row_number() OVER (ORDER BY id) AS ix, {cols} FROM {source}),
{p}prim AS (SELECT 0 AS step, r.id, {', '.join('r.' + d for d in dims)}, {first} AS b
 FROM {p}pts r, (SELECT * FROM {p}pts WHERE ix = 1) k WHERE r.ix > 1
 UNION ALL SELECT r.step + 1, r.id, {', '.join('r.' + d for d in dims)}, CASE WHEN {new} < r.b THEN {new} ELSE r.b END
 FROM {p}prim r, (SELECT g.* FROM (SELECT arg_min({{'id': id, {pack}}}, b) AS g FROM {p}prim)) k WHERE r.id <> k.id),
{p}mst AS MATERIALIZED (SELECT row_number() OVER (ORDER BY b) - 1 AS s, b.d AS d, i.ix AS i, j.ix AS j, b.lo AS lo, b.hi AS hi FROM (SELECT min(b) AS b FROM {p}prim GROUP BY step)
 JOIN {p}pts i ON i.id = b.lo JOIN {p}pts j ON j.id = b.hi),
{p}merges AS (SELECT 0::BIGINT AS s, (SELECT list(ix - (SELECT count(*) FROM {p}pts) - 1 ORDER BY ix) FROM {p}pts) AS l
 UNION ALL SELECT m.s + 1, list_transform(m.l, lambda v: CASE WHEN v = m.l[e.i] OR v = m.l[e.j] THEN e.s ELSE v END)
 FROM {p}merges m JOIN {p}mst e ON e.s = m.s)"""


def labels_sql(k: str, prefix: str = "", name: str = "labels") -> str:
    """CTE (k, id, label) for the K's of an SQL list."""
    p = prefix
    return f"""{name} AS MATERIALIZED (SELECT kk AS k, pt.id, dense_rank() OVER (PARTITION BY kk ORDER BY v) - 1 AS label FROM
 (SELECT (len(l) - s)::INTEGER AS kk, unnest(l) AS v, unnest(range(1, len(l) + 1)) AS ix FROM {p}merges WHERE len(l) - s IN ({k})) u JOIN {p}pts pt ON pt.ix = u.ix)"""


# --- distances -----------------------------------------------------------------------

@query(f"""SELECT a.vec_id AS i, b.vec_id AS j, {rs('list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[])')} AS d
FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id""")
def pair_distances(spark, sf):
    out = distances.pair_distances(table(spark, sf, "embeddings"), ["embedding"], "euclidean", "vec_id", 250)
    return rounded(out, ["d"])


@query(f"SELECT a.id AS i, b.id AS j, {rs(dist_sql('a', 'b', DIMS, 'chebyshev'), 9)} AS d FROM {EMB} a JOIN {EMB} b ON a.id < b.id")
def pair_distances_chebyshev(spark, sf):
    return rounded(distances.pair_distances(emb(spark, sf), DIMS, "chebyshev"), ["d"], 9)


@query(f"SELECT a.id AS i, b.id AS j, {rs(dist_sql('a', 'b', DIMS, 'euclidean_squared'), 9)} AS d FROM {EMB} a JOIN {EMB} b ON a.id < b.id")
def pair_distances_squared(spark, sf):
    return rounded(distances.pair_distances(emb(spark, sf), DIMS, "euclidean_squared"), ["d"], 9)


# --- linkage ----------------------------------------------------------------------------

@query(f"WITH RECURSIVE {tree_sql(EMB, DIMS)} SELECT lo AS i, hi AS j, {rs('d', 9)} AS d FROM mst")
def spanning_tree(spark, sf):
    return rounded(linkage.spanning_tree(emb(spark, sf), DIMS)[0], ["d"], 9)


@query(f"WITH RECURSIVE {tree_sql(EMB, DIMS)}, {labels_sql('5')} SELECT id AS row_id, label::INTEGER AS label FROM labels")
def single_linkage(spark, sf):
    return linkage.single_linkage(emb(spark, sf), DIMS, 5)


@query(f"WITH RECURSIVE {tree_sql(EMB, DIMS, 'chebyshev')}, {labels_sql('4')} SELECT id AS row_id, label::INTEGER AS label FROM labels")
def single_linkage_chebyshev(spark, sf):
    return clustering.cluster(emb(spark, sf), DIMS, 4, metric="chebyshev")


@query(f"WITH RECURSIVE {tree_sql(EMB, DIMS)}, {labels_sql(', '.join(map(str, range(2, 13))))} SELECT k, id AS row_id, label::INTEGER AS label FROM labels")
def linkage_history(spark, sf):
    return linkage.linkage_history(emb(spark, sf), DIMS, 2, 12)


@query(f"""WITH RECURSIVE {tree_sql(EMB, DIMS)}, {labels_sql(', '.join(map(str, range(2, 13))))},
c AS (SELECT k, label, count(*) AS n FROM labels GROUP BY 1, 2)
SELECT k, sum(n)::BIGINT AS "rows", count(*) AS clusters, min(label)::INTEGER AS lowest, max(label)::INTEGER AS highest,
 sum(n) = (SELECT count(*) FROM embeddings) AND count(*) = k AND min(label) = 0 AND max(label) = k - 1 AS valid FROM c GROUP BY k""")
def history_check(spark, sf):
    points = emb(spark, sf)
    tree, ids, n = linkage.spanning_tree(points, DIMS)
    return linkage.history_report(linkage.history(tree, ids, n, 2, 12), n)


@query(f"""WITH RECURSIVE {tree_sql(EMB, DIMS)}, every AS (SELECT list(id ORDER BY ix) AS ids FROM pts),
x AS (SELECT m.s, m.l, e.d, least(m.l[e.i], m.l[e.j]) AS a, greatest(m.l[e.i], m.l[e.j]) AS b FROM merges m JOIN mst e ON e.s = m.s),
y AS (SELECT *, len(list_filter(list_distinct(l), lambda v: v < a)) AS la, len(list_filter(list_distinct(l), lambda v: v < b)) AS lb,
 list_transform(list_filter(list_zip(l, ids), lambda z: z[1] = a), lambda z: z[2]) AS pa,
 list_transform(list_filter(list_zip(l, ids), lambda z: z[1] = b), lambda z: z[2]) AS pb FROM x, every)
SELECT s + 1 AS iteration, list_min(pa) AS "left", list_min(pb) AS "right", len(pa) AS left_size, len(pb) AS right_size, len(pa) + len(pb) AS new_size,
{rs('d', 9)} AS distance, len(l) - s - 1 AS clusters_after, la AS left_place, lb AS right_place FROM y""")
def merge_log(spark, sf):
    tree, ids, n = linkage.spanning_tree(emb(spark, sf), DIMS)
    return rounded(linkage.merge_log(tree, ids, n, places=True), ["distance"], 9)


@query(f"""WITH RECURSIVE {tree_sql(EMB, DIMS)}, {labels_sql('3, 4, 5')}, c AS (SELECT k, label, count(*) AS n FROM labels GROUP BY 1, 2)
SELECT k, max(n) AS max_size, min(n) AS min_size, {rs('max(n) / min(n)')} AS ratio, max(n) / min(n) > 10 AS chain_effect FROM c GROUP BY k""")
def chain_effect(spark, sf):
    labels = linkage.linkage_history(emb(spark, sf), DIMS, 3, 5)
    return rounded(quality.balance(quality.cluster_sizes(labels), ["k"]), ["ratio"])


RAW = emb_sql(lambda d: " * 50" if d == "e2" else "")
SCALED = f"(SELECT id, {', '.join(f'({d} - avg({d}) OVER ()) / stddev_pop({d}) OVER () AS {d}' for d in DIMS[:2])} FROM {RAW})"


@query(f"""WITH RECURSIVE {tree_sql(RAW, DIMS[:2], prefix='r')}, {labels_sql('4', 'r', 'rl')}, {tree_sql(SCALED, DIMS[:2], prefix='s')}, {labels_sql('4', 's', 'sl')},
a AS (SELECT max(n) / min(n) AS x FROM (SELECT count(*) AS n FROM rl GROUP BY label)), b AS (SELECT max(n) / min(n) AS y FROM (SELECT count(*) AS n FROM sl GROUP BY label))
SELECT {rs('x')} AS raw_ratio, {rs('y')} AS scaled_ratio, y < 0.8 * x AS scaling_helps,
CASE WHEN y < 0.8 * x THEN 'scaling_helps' ELSE 'scaling_does_not_help' END || '|' ||
CASE WHEN y > 5 THEN 'use_kmeans|more_clusters|remove_outliers|try_chebyshev' ELSE 'linkage_acceptable' END AS codes FROM a, b""")
def scaling_verdict(spark, sf):
    e = emb(spark, sf).withColumn("e2", F.col("e2") * 50)
    out = clustering.scaling_verdict(e, DIMS)  # on the first two, by rule
    return rounded(out, ["raw_ratio", "scaled_ratio"]).withColumn("codes", F.array_join("codes", "|"))


# --- quality -------------------------------------------------------------------------------

def silhouette_sql(points: str, labels: str, dist: str, only: str = "true") -> str:
    """CTEs ending in `sil` (id, label, s) for points(id, ...) and labels(id, label), for the rows a of `only`."""
    return f"""lp AS MATERIALIZED (SELECT p.*, l.label AS lab FROM {points} p JOIN {labels} l USING (id)),
ls AS MATERIALIZED (SELECT lab, count(*) AS n FROM lp GROUP BY 1),
ds AS (SELECT a.id, a.lab AS own, b.lab AS other, sum({dist}) AS s FROM lp a JOIN lp b ON a.id <> b.id WHERE {only} GROUP BY 1, 2, 3),
ab AS (SELECT id, own, max(CASE WHEN own = other THEN s / (n - 1) END) AS a, min(CASE WHEN own <> other THEN s / n END) AS b,
 (SELECT n FROM ls q WHERE q.lab = own) AS n FROM ds JOIN ls ON ls.lab = ds.other GROUP BY id, own),
sil AS (SELECT id, own AS label, CASE WHEN n = 1 THEN 0.0::DOUBLE ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0) END AS s FROM ab)"""


@query(f"""WITH pt AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings), lb AS (SELECT vec_id AS id, label FROM embeddings),
{silhouette_sql('pt', 'lb', 'list_distance(a.v, b.v)')} SELECT {rs('avg(s)')} AS silhouette FROM sil""")
def silhouette(spark, sf):
    e = table(spark, sf, "embeddings")
    labels = e.select(F.col("vec_id").alias("row_id"), "label")
    return rounded(quality.silhouette(e, ["embedding"], labels, row_id="vec_id", block_rows=250), ["silhouette"])


@query(f"""WITH pt AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings), lb AS (SELECT vec_id AS id, label FROM embeddings),
{silhouette_sql('pt', 'lb', 'list_distance(a.v, b.v)', 'a.id % 50 = 0')}
SELECT count(*) AS queries, {rs('avg(s)')} AS silhouette, {rs('stddev_samp(s) / sqrt(count(*))')} AS standard_error FROM sil""")
def silhouette_sampled(spark, sf):
    e = table(spark, sf, "embeddings")
    labels = e.select(F.col("vec_id").alias("row_id"), "label")
    return rounded(quality.silhouette_sampled(e, ["embedding"], labels, row_id="vec_id", block_rows=250), ["silhouette", "standard_error"])


LONG_LABELS = "(SELECT 10 AS k, vec_id AS id, label FROM embeddings UNION ALL SELECT 4, vec_id, label % 4 FROM embeddings)"


def long_labels(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("row_id"), "label")
    return e.select(F.lit(10).alias("k"), "row_id", "label").unionByName(
        e.select(F.lit(4).alias("k"), "row_id", (F.col("label") % 4).alias("label")))


@query(f"""WITH v AS (SELECT k, l.label, id, unnest(e.embedding::DOUBLE[]) AS x, unnest(range(64)) AS d FROM {LONG_LABELS} l JOIN embeddings e ON e.vec_id = l.id),
g AS (SELECT unnest(embedding::DOUBLE[]) AS x, unnest(range(64)) AS d FROM embeddings), gm AS (SELECT d, avg(x) AS m FROM g GROUP BY d),
c AS (SELECT k, label, d, count(*) AS n, avg(x) AS m, var_pop(x) * count(*) AS ss FROM v GROUP BY 1, 2, 3),
t AS (SELECT k, label, any_value(n) AS n, sum(ss) AS w, sum(n * (c.m - gm.m) ** 2) AS b FROM c JOIN gm USING (d) GROUP BY 1, 2)
SELECT k, count(*) AS clusters, min(n) AS min_size, max(n) AS max_size, {rs('avg(n)')} AS mean_size, {rs('sum(w)')} AS within_ss, {rs('sum(b)')} AS between_ss FROM t GROUP BY k""")
def cluster_stats(spark, sf):
    out = quality.cluster_statistics(table(spark, sf, "embeddings"), ["embedding"], long_labels(spark, sf), "vec_id")
    return rounded(out, ["mean_size", "within_ss", "between_ss"])


def k_silhouette_sql(k: int) -> str:
    labels = f"(SELECT id, label FROM {LONG_LABELS} WHERE k = {k})"
    return (f"(WITH pt AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings), {silhouette_sql('pt', labels, 'list_distance(a.v, b.v)')} "
            f"SELECT {k} AS k, {rs('avg(s)')} AS silhouette FROM sil)")


@query(f"""WITH v AS (SELECT k, l.label, id, unnest(e.embedding::DOUBLE[]) AS x, unnest(range(64)) AS d FROM {LONG_LABELS} l JOIN embeddings e ON e.vec_id = l.id),
c AS (SELECT k, label, d, count(*) AS n, var_pop(x) * count(*) AS ss FROM v GROUP BY 1, 2, 3),
t AS (SELECT k, label, any_value(n) AS n, sum(ss) AS w FROM c GROUP BY 1, 2), s AS (FROM {k_silhouette_sql(10)} UNION ALL FROM {k_silhouette_sql(4)})
SELECT k, count(*) AS clusters, {rs('sum(w)')} AS within_ss, any_value(silhouette) AS silhouette FROM t JOIN s USING (k) GROUP BY k""")
def cluster_stats_full(spark, sf):
    out = quality.full_statistics(table(spark, sf, "embeddings"), ["embedding"], long_labels(spark, sf), "vec_id", block_rows=250)
    return rounded(out, ["within_ss", "silhouette"]).select("k", "clusters", "within_ss", "silhouette")


@query(f"""WITH c AS (SELECT label, {", ".join(f"avg({d}) AS {d}" for d in DIMS)}, count(*) AS n FROM {EMB} GROUP BY 1),
i AS (SELECT avg({dist_sql('a', 'b', DIMS)}) AS x FROM c a JOIN c b ON a.label < b.label),
w AS (SELECT avg({dist_sql('p', 'c', DIMS)}) AS y FROM {EMB} p JOIN c USING (label) WHERE n > 1)
SELECT {rs('least(1, x / y / 10)')} AS ratio FROM i, w""")
def separation_ratio(spark, sf):
    e = emb(spark, sf)
    return spark.createDataFrame([(quality.separation_ratio(e, DIMS, e.select("row_id", "label")),)], "ratio double").select(r("ratio").alias("ratio"))


PAIRS = ["pairs_both", "pairs_left", "pairs_right"]


def fm_sql(pairs: str) -> str:
    """One row of the index for pairs(a, b)."""
    return f"""(WITH cells AS (SELECT a, b, count(*) AS n FROM {pairs} GROUP BY 1, 2),
l AS (SELECT sum(n * (n - 1) // 2)::BIGINT AS p FROM (SELECT sum(n)::BIGINT AS n FROM cells GROUP BY a)),
q AS (SELECT sum(n * (n - 1) // 2)::BIGINT AS p FROM (SELECT sum(n)::BIGINT AS n FROM cells GROUP BY b)),
t AS (SELECT sum(n)::BIGINT AS n, sum(n * (n - 1) // 2)::BIGINT AS p FROM cells)
SELECT t.n AS "rows", t.p AS pairs_both, l.p AS pairs_left, q.p AS pairs_right,
{rs('CASE WHEN l.p = 0 AND q.p = 0 THEN 1 WHEN l.p = 0 OR q.p = 0 THEN 0 ELSE sqrt(t.p / l.p::DOUBLE * (t.p / q.p::DOUBLE)) END')} AS fm FROM t, l, q)"""


@query("SELECT * FROM " + fm_sql("(SELECT event_type AS a, hour(ts) // 6 AS b FROM events)"))
def fm_index(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_type").alias("left_label"), F.floor(F.hour("ts") / 6).alias("right_label"))
    return rounded(whole(quality.fowlkes_mallows(e), PAIRS), ["fm"])


@query(f"""WITH RECURSIVE {tree_sql(EMB, DIMS)}, {labels_sql('8')}
SELECT * FROM {fm_sql('(SELECT l.label AS a, e.label AS b FROM labels l JOIN embeddings e ON e.vec_id = l.id)')}""")
def fm_linkage_vs_labels(spark, sf):
    e = emb(spark, sf)
    return rounded(whole(quality.agreement(linkage.single_linkage(e, DIMS, 8), e.select("row_id", "label")), PAIRS), ["fm"])


@query(f"""WITH c AS (SELECT label, count(*) AS size, avg(e1) AS x, avg(e2) AS y FROM {EMB} GROUP BY 1)
SELECT label, size, {rs('100.0 * size / sum(size) OVER ()')} AS share_pct, min(size) OVER () AS min_size, max(size) OVER () AS max_size,
{rs('avg(size) OVER ()')} AS mean_size, {rs('x')} AS center_x, {rs('y')} AS center_y FROM c""")
def cluster_report(spark, sf):
    out = quality.k_report(emb(spark, sf).drop("label"), DIMS, long_labels(spark, sf), 10)
    return rounded(out, ["share_pct", "mean_size", "center_x", "center_y"])


@query(f"""WITH RECURSIVE {tree_sql(EMB10, DIMS)}, {labels_sql('3')}, {silhouette_sql('pts', 'labels', dist_sql('a', 'b', DIMS))}
SELECT {rs('greatest(0, avg(s))')} AS quality FROM sil""")
def subset_quality(spark, sf):
    q = selection.subset_quality(emb10(spark, sf), DIMS, 3)
    return spark.createDataFrame([(q,)], "quality double").select(r("quality").alias("quality"))


# --- K-means, feature search and whole runs ----------------------------------------------------

@query()
def kmeans(spark, sf):
    _, clusters = clustering.kmeans(table(spark, sf, "embeddings"), ["embedding"], 5, "vec_id")
    return clusters.select("label", "size", r("inertia").alias("inertia"))


@query()
def diagnose(spark, sf):
    return clustering.diagnose(emb(spark, sf), DIMS)


@query()
def spa(spark, sf):
    """The search over all 64 dimensions; SQL has no search, tests compare it with all subsets of a small table."""
    found = selection.select_features(emb10(spark, sf), DIMS, 2, k=3, max_iterations=3)
    return spark.createDataFrame([("|".join(sorted(found.features)), found.quality)], "features string, quality double") \
        .select("features", r("quality").alias("quality"))


LLOYD_K, LLOYD_ROUNDS = 5, 6


@query(f"""WITH RECURSIVE pt AS MATERIALIZED (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings),
it AS (SELECT 0 AS r, row_number() OVER (ORDER BY h, id) - 1 AS label, v AS c, 0::BIGINT AS n FROM
 (SELECT id, v, {digest_sql(42, 'id')} AS h FROM pt ORDER BY h, id LIMIT {LLOYD_K})
 UNION ALL SELECT r + 1, near['l'], [{', '.join(f'avg(v[{i}])' for i in range(1, 65))}], count(*) FROM
 (SELECT it.r, pt.id, any_value(pt.v) AS v, min({{'d': list_distance(pt.v, it.c), 'l': it.label}}) AS near FROM it, pt GROUP BY 1, 2)
 WHERE r < {LLOYD_ROUNDS} GROUP BY r, near['l'])
SELECT label::INTEGER AS label, n AS size, {rs('c[1]')} AS first, {rs('c[64]')} AS last FROM it WHERE r = {LLOYD_ROUNDS}""")
def kmeans_rounds(spark, sf):
    out = clustering.lloyd(table(spark, sf, "embeddings"), ["embedding"], LLOYD_K, "vec_id", rounds=LLOYD_ROUNDS)
    return out.select("label", "size", r(F.col("center")[0]).alias("first"), r(F.element_at("center", -1)).alias("last"))


@query(f"""WITH RECURSIVE {tree_sql(EMB, DIMS)}, {labels_sql(', '.join(map(str, range(2, 13))))}
SELECT l[len(l) // 2 + 1] AS k FROM (SELECT list_reverse_sort(list_distinct(list(k))) AS l FROM labels)""")
def default_k(spark, sf):
    return runs.default_k(linkage.linkage_history(emb(spark, sf), DIMS, 2, 12))


CUSTOMER_SPEC = TableSpec({c.name: c for c in (
    ColumnSpec("c_nationkey", "numerical_discrete", scaling="standard"), ColumnSpec("c_acctbal", "numerical_continuous", scaling="standard"),
    ColumnSpec("c_mktsegment", "categorical_nominal", encoding="label"))})
CUSTOMER_QIS = ["c_acctbal", "c_nationkey", "c_mktsegment"]
ENCODED = """(SELECT c_custkey AS id, (c_nationkey - avg(c_nationkey) OVER ()) / stddev_pop(c_nationkey) OVER () AS c_nationkey,
 (c_acctbal - avg(c_acctbal) OVER ()) / stddev_pop(c_acctbal) OVER () AS c_acctbal, (dense_rank() OVER (ORDER BY c_mktsegment) - 1)::DOUBLE AS c_mktsegment FROM customer)"""


def mid(c: str) -> str:
    # a label with a minus sign has more than two parts and decodes to 0
    return (f"CASE WHEN len(string_split({c}, '-')) = 2 THEN coalesce((try_cast(split_part({c}, '-', 1) AS DOUBLE) + "
            f"try_cast(split_part({c}, '-', 2) AS DOUBLE)) / 2, 0) ELSE 0 END::DOUBLE")


ANONYMOUS = f"""(SELECT c_custkey AS id, {mid('c_nationkey')} AS c_nationkey, {mid('c_acctbal')} AS c_acctbal,
 (dense_rank() OVER (ORDER BY c_mktsegment) - 1)::DOUBLE AS c_mktsegment FROM
 {binned_sql(binned_sql('(SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer)', 'c_acctbal', 4), 'c_nationkey', 4)})"""
CUSTOMER_DIMS = ["c_nationkey", "c_acctbal", "c_mktsegment"]


def customers(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("row_id"), *CUSTOMER_DIMS)


@query(f"WITH RECURSIVE {tree_sql(ANONYMOUS, CUSTOMER_DIMS)}, {labels_sql('4')} SELECT id AS row_id, label::INTEGER AS label FROM labels")
def anonymise_and_cluster(spark, sf):
    return clustering_run.anonymise_and_cluster(customers(spark, sf), CUSTOMER_QIS, 4)


# --- features chosen by the search, from all pairs of three ------------------------------------

CHOICES = [(0, 1), (0, 2), (1, 2)]


def pair_ctes(source: str, dims: list[str], ks: str, metric: str, p: str) -> str:
    """Trees and labels (CTE {p}{n}l) of every pair of features."""
    return ", ".join(f"{tree_sql(source, [dims[i], dims[j]], metric, prefix=f'{p}{n}')}, {labels_sql(ks, f'{p}{n}', f'{p}{n}l')}" for n, (i, j) in enumerate(CHOICES))


def chosen_sql(source: str, dims: list[str], k: int, metric: str, p: str) -> str:
    """CTE {p}chosen (n): the best pair, or the first one proposed where none has a quality above 0."""
    def score(n: int, a: str, b: str) -> str:
        sil = silhouette_sql(f"{p}{n}pts", f"(SELECT id, label FROM {p}{n}l WHERE k = {k})", dist_sql("a", "b", [a, b], metric))
        fit = f"(SELECT least(count(DISTINCT {a}), count(DISTINCT {b})) >= 10 AND least(stddev_pop({a}), stddev_pop({b})) >= 1e-6 AND var_pop({a}) + var_pop({b}) >= 0.1 FROM {source})"
        return f"SELECT {n} AS n, CASE WHEN {fit} THEN (WITH {sil} SELECT greatest(0, avg(s)) FROM sil) ELSE 0 END AS q"
    hashed = lambda key: f"((('0x' || substr(md5({key}), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496)"
    pairs = ", ".join(f"({n}, [{i}, {j}])" for n, (i, j) in enumerate(CHOICES))
    first = f"""(SELECT n FROM (VALUES {pairs}) v(n, l) WHERE l = (SELECT list(i ORDER BY i) FROM (SELECT i FROM
 (SELECT i, {hashed("'42:1:' || i")} AS u, -ln({hashed("'42:1:' || i || ':more'")}) AS w FROM range(3) r(i)) ORDER BY u >= 1 / 3::DOUBLE, CASE WHEN u < 1 / 3::DOUBLE THEN i ELSE w END, i LIMIT 2)))"""
    scores = " UNION ALL ".join(score(n, dims[i], dims[j]) for n, (i, j) in enumerate(CHOICES))
    return f"{p}chosen AS MATERIALIZED (SELECT CASE WHEN max(q) > 0 THEN arg_max(n, q) ELSE {first} END AS n FROM ({scores}))"


def chosen_labels(p: str, name: str) -> str:
    return f"{name} AS (" + " UNION ALL ".join(f"SELECT k, id, label FROM {p}{n}l WHERE (SELECT n FROM {p}chosen) = {n}" for n in range(len(CHOICES))) + ")"


@query(f"""WITH RECURSIVE {tree_sql(ENCODED, CUSTOMER_DIMS, prefix='e')}, {labels_sql('4', 'e', 'el')},
{pair_ctes(ENCODED, CUSTOMER_DIMS, '4', 'euclidean', 'f')}, {chosen_sql(ENCODED, CUSTOMER_DIMS, 4, 'euclidean', 'f')}, {chosen_labels('f', 'fl')},
{pair_ctes(ANONYMOUS, CUSTOMER_DIMS, '4', 'euclidean', 'a')}, {chosen_sql(ANONYMOUS, CUSTOMER_DIMS, 4, 'euclidean', 'a')}, {chosen_labels('a', 'al')},
x AS (SELECT * FROM {fm_sql('(SELECT el.label AS a, fl.label AS b FROM el JOIN fl USING (id))')}),
y AS (SELECT * FROM {fm_sql('(SELECT el.label AS a, al.label AS b FROM el JOIN al USING (id))')}),
z AS (SELECT * FROM {fm_sql('(SELECT fl.label AS a, al.label AS b FROM fl JOIN al USING (id))')})
SELECT 'preprocessing_vs_features' AS comparison, "rows", fm FROM x UNION ALL
SELECT 'preprocessing_vs_anonymised', "rows", fm FROM y UNION ALL SELECT 'features_vs_anonymised', "rows", fm FROM z""")
def compare_clusterings(spark, sf):
    """Two of three features, searched on the encoded and on the anonymised table."""
    out = clustering_run.compare_clusterings(customers(spark, sf), CUSTOMER_QIS, 4, n_features=2, spec=CUSTOMER_SPEC)
    return rounded(out, ["fm"])


@query(f"""WITH RECURSIVE {pair_ctes(ENCODED, CUSTOMER_DIMS, '2, 3, 4, 5, 6', 'chebyshev', 'f')},
{chosen_sql(ENCODED, CUSTOMER_DIMS, 3, 'chebyshev', 'f')}, {chosen_labels('f', 'fl')}, c AS (SELECT k, label, count(*) AS n FROM fl GROUP BY 1, 2)
SELECT k, label::INTEGER AS label, n AS size FROM c""")
def full_run(spark, sf):
    """Chooses its two features, clusters, stores, and reads back what was stored."""
    run = clustering_run.full_run(customers(spark, sf), scratch_path(spark, "run"), 2, 6, spec=CUSTOMER_SPEC)
    wide, _, ks = runs.read_results(spark, run.results_path)
    return quality.cluster_sizes(runs.long_labels(wide, ks))
