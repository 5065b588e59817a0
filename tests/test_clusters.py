"""Distances, linkage against brute force, agreement, search and whole runs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.functions import summed
from sparkloom.functions.distance import block_distances, choose_two, quick_distances
from sparkloom.operators import clustering, distances, linkage, quality, selection
from sparkloom.operators.checks import QualityError
from sparkloom.plans import clustering_run
from sparkloom.sources import csv, reuse, runs
from sparkloom.sources.spec import ColumnSpec, TableSpec

DIMS = ["x", "y", "z"]


def points(spark, x, step=3):
    return spark.createDataFrame([(i * step, *map(float, p)) for i, p in enumerate(x)], "row_id bigint, x double, y double, z double")


def labels(spark, pairs):
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "row_id bigint, left_label int, right_label int")


def brute(x, metric="euclidean"):
    """Partitions for every K and the merge log, straight from the definition."""
    d = block_distances(x, x, metric)
    parts, log = [[i] for i in range(len(x))], []
    found = {}
    while True:
        lab = np.zeros(len(x), int)
        for c, members in enumerate(parts):
            lab[members] = c
        found[len(parts)] = lab.tolist()
        if len(parts) == 1:
            return found, log
        height, a, b = min((d[np.ix_(p, q)].min(), i, j) for i, p in enumerate(parts) for j, q in enumerate(parts) if i < j)
        log.append((len(log) + 1, 3 * min(parts[a]), 3 * min(parts[b]), len(parts[a]), len(parts[b]), len(parts[a]) + len(parts[b]), height, len(parts) - 1))
        parts = [p for i, p in enumerate(parts) if i not in (a, b)] + [parts[a] + parts[b]]


@pytest.mark.parametrize("leaf_rows,few,part", [(1024, 100_000, 100_000), (9, 12, 7)])
def test_linkage_labels_and_log_equal_brute_force(spark, leaf_rows, few, part):
    x = np.random.default_rng(8).normal(size=(36, 3))
    found, log = brute(x)
    tree, ids, n = linkage.spanning_tree(points(spark, x), DIMS, leaf_rows=leaf_rows, few=few)
    top = 6 if few == 12 else 36
    got = linkage.history(tree, ids, n, 2, top, part).toPandas()
    for k in range(2, top + 1):
        assert got[got.k == k].sort_values("row_id").label.tolist() == found[k]
    one = linkage.partition(tree, ids, n, 9, few).toPandas().sort_values("row_id").label.tolist()
    assert one == found[9]
    rows = sorted(map(tuple, linkage.merge_log(tree, ids, n, 1, part).collect()))
    assert [r[:6] + r[7:] for r in rows] == [r[:6] + r[7:] for r in log]
    assert [r[6] for r in rows] == pytest.approx([r[6] for r in log])


def test_far_cells_are_never_paired(spark):
    """Most pairs of leaves are read in the first round, and all together stay far below all pairs."""
    from sparkloom.operators import cells
    r = np.random.default_rng(3)
    x = np.concatenate([r.normal(c, 0.2, size=(45, 3)) for c in r.uniform(-60, 60, size=(12, 3))])
    df = points(spark, x, 1)
    feats, n = distances.checked_features(df, DIMS)
    leaves = cells.with_cells(feats, n, 15).select("cell").distinct().count()
    for metric in ("chebyshev",):
        reads = []
        tree = linkage.boruvka(feats, n, metric, 15, reads=reads).collect()
        assert leaves >= 40 and sum(reads) < 0.2 * leaves * (leaves - 1) / 2 and max(reads[1:]) < reads[0], reads
        assert sorted(linkage.spanning_tree(df, DIMS, metric)[0].collect()) == sorted(tree)


def test_cells_deeper_than_one_round_of_learning(spark, monkeypatch):
    from sparkloom.operators import cells
    monkeypatch.setattr(cells, "LEVELS", 2)
    x = np.random.default_rng(5).normal(size=(140, 3)) ** 3  # skewed, so that leaves differ in depth
    feats, n = distances.checked_features(points(spark, x, 1), DIMS)
    placed = cells.with_cells(feats, n, 8)
    sizes = {c["cell"]: c["count"] for c in placed.groupBy("cell").count().collect()}
    assert sum(sizes.values()) == 140 and max(sizes.values()) <= 8
    assert not any(a >> s in sizes for a in sizes for s in range(1, a.bit_length()))  # no leaf above another
    up = {r["cell"]: (r["ups"], r["up"]) for r in placed.select("cell", cells.ancestors("cell").alias("ups"), cells.parent("cell").alias("up")).distinct().collect()}
    for cell, (ups, parent) in up.items():
        depth = cell.bit_length() - 1
        assert ups == [cell >> (depth - d) for d in range(0, depth, 3)] + [cell] and parent == ups[-2]
    assert sorted(linkage.boruvka(feats, n, "euclidean", 8).collect()) == sorted(linkage.boruvka(feats, n, "euclidean").collect())


def test_linkage_with_copies_and_limits(spark):
    x = np.random.default_rng(2).normal(size=(30, 3))
    x[5:20] = x[5]  # half of the rows are one point
    whole = linkage.spanning_tree(points(spark, x), DIMS)[0].collect()
    parts = linkage.spanning_tree(points(spark, x).repartition(5), DIMS, leaf_rows=4, few=3)[0].collect()
    assert sorted(whole) == sorted(parts) and len(whole) == 29
    small = points(spark, [[0, 0, 0], [1, 0, 0], [3, 0, 0], [7, 0, 0]], 1)
    got = [r["label"] for r in linkage.single_linkage(small, ["x"], 2).orderBy("row_id").collect()]
    assert got == [1, 1, 1, 0]
    assert [r["label"] for r in linkage.single_linkage(small, ["x"], 4).orderBy("row_id").collect()] == [0, 1, 2, 3]
    assert {r["label"] for r in linkage.single_linkage(small, ["x"], 1).collect()} == {0}
    for k in (0, 5):
        with pytest.raises(ValueError):
            linkage.single_linkage(small, ["x"], k)
    with pytest.raises(ValueError):
        linkage.single_linkage(small.limit(1), ["x"], 1)
    with pytest.raises(ValueError):
        distances.pair_distances(small, ["x"], "manhattan")
    tree, ids, n = linkage.spanning_tree(small, ["x"])
    hist = linkage.history(tree, ids, n, 2, 99)  # lowered to n
    linkage.require_history(hist, 4, 3)
    with pytest.raises(ValueError):
        linkage.require_history(hist.limit(0), 4)
    with pytest.raises(ValueError):
        linkage.require_history(hist.where("label = 0"), 4)


def test_pair_distances_and_silhouette_across_blocks(spark):
    x = np.random.default_rng(4).normal(size=(25, 3))
    lab = np.array([i % 3 for i in range(24)] + [7])
    df = points(spark, x, 1)
    d = block_distances(x, x, "chebyshev")
    rows = distances.pair_distances(df, DIMS, "chebyshev", block_rows=6).collect()
    assert len({(r["i"], r["j"]) for r in rows}) == len(rows) == 300
    assert all(r["d"] == d[r["i"], r["j"]] for r in rows)
    e = block_distances(x, x, "euclidean")
    want = []
    for i in range(25):
        own = lab == lab[i]
        if own.sum() == 1:
            want.append(0.0)
            continue
        a, b = e[i, own].sum() / (own.sum() - 1), min(e[i, lab == k].mean() for k in set(lab) - {lab[i]})
        want.append((b - a) / max(a, b))
    table = spark.createDataFrame([(i, int(v)) for i, v in enumerate(lab)], "row_id bigint, label int")
    for block in (6, 100):
        got = quality.silhouette(df, DIMS, table, block_rows=block).first()["silhouette"]
        assert got == pytest.approx(np.mean(want))
    assert quality.silhouette(df, DIMS, table.withColumn("label", F.lit(1))).first()["silhouette"] is None
    full = quality.full_statistics(df, DIMS, table.withColumn("k", F.lit(4))).first()
    centers = {k: x[lab == k].mean(0) for k in set(lab)}
    assert full["within_ss"] == pytest.approx(sum(((x[lab == k] - c) ** 2).sum() for k, c in centers.items()))
    assert full["between_ss"] == pytest.approx(sum((lab == k).sum() * ((c - x.mean(0)) ** 2).sum() for k, c in centers.items()))


def test_fowlkes_mallows_cases(spark):
    fm = lambda pairs: quality.fowlkes_mallows(labels(spark, pairs)).first()["fm"]
    assert fm([(0, 0), (0, 0), (1, 0), (1, 1)]) == pytest.approx(0.408248, abs=1e-6)
    assert fm([(0, 0)]) == 1 and fm([(0, 0), (1, 1), (2, 2)]) == 1 and fm([(0, 0), (1, 0), (2, 1)]) == 0
    assert fm([(0, 0), (0, 1)]) == 0 and fm([(0, 3), (0, 3)]) == 1 and fm([(0, 0), (1, 1)]) == 1
    assert fm([(0, 5), (0, 5), (1, 9), (1, 9), (2, 9)]) < 1


def test_pair_counts_of_large_cells(spark):
    got = spark.createDataFrame([(0,), (1,), (2,), (200_000_003,), (4_000_000_000,), (9_000_000_000_000_000_000,)], "n bigint").select(choose_two("n").alias("c"))
    assert [int(r["c"]) for r in got.collect()] == [n * (n - 1) // 2 for n in (0, 1, 2, 200_000_003, 4_000_000_000, 9_000_000_000_000_000_000)]


def test_adaptive_search(spark):
    scores = {(0, 2): 0.9}
    found, best, history = selection.adaptive_search(4, 2, lambda s: scores.get(s, 0.1 + 0.01 * sum(s)), seed=1)
    assert found == [0, 2] and best == 0.9 and abs(sum(history[-1][5]) - 1) < 1e-9
    assert history == selection.adaptive_search(4, 2, lambda s: scores.get(s, 0.1 + 0.01 * sum(s)), seed=1)[2]
    assert selection.adaptive_search(2, 3, lambda s: 0.0) == ([0, 1], 1.0, [])
    # constant scores stop after ten rounds
    assert len(selection.adaptive_search(5, 2, lambda s: 0.0)[2]) == 10
    df = points(spark, [[i, i * i, 1] for i in range(12)], 1)

    def unfit(frame, names):
        raise QualityError("no")

    def broken(frame, names):
        raise RuntimeError("executor lost")
    with pytest.raises(RuntimeError):
        selection.select_features(df, DIMS, 2, quality=broken)
    with pytest.warns(UserWarning):
        fallback = selection.select_features(df, DIMS, 2, quality=unfit)
    assert fallback.features == ["y", "x"] and fallback.method == "variance"
    assert selection.subset_quality(df, ["x"]) == 0.0 and selection.subset_quality(df, ["x", "z"]) == 0.0
    assert selection.subset_quality(df, ["x", "y"]) > 0


def test_kmeans_and_dispatch(spark):
    x = np.concatenate([np.random.default_rng(1).normal(c, 0.1, size=(15, 3)) for c in (0, 5, 9)])
    df = points(spark, x, 1)
    lab, clusters = clustering.kmeans(df, DIMS, 3, starts=3)
    assert sorted(r["size"] for r in clusters.collect()) == [15, 15, 15]
    single = clustering.cluster(df, DIMS, 3)
    assert quality.agreement(lab, single).first()["fm"] == 1.0
    for bad in (dict(k=1), dict(k=99), dict(k=3, method="other")):
        with pytest.raises(ValueError):
            clustering.cluster(df, DIMS, **bad)


def test_kmeans_runs_take_their_rounds_together_and_end_like_sparks(spark):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    x = np.random.default_rng(3).uniform(size=(300, 3))
    df = points(spark, x, 1)
    vectors = df.select(array_to_vector(F.array(*DIMS)).alias("v")).cache()
    own = [KMeans(k=6, featuresCol="v", maxIter=300, seed=42 + s, tol=1e-4).fit(vectors).summary for s in range(6)]
    sc = spark.sparkContext
    sc.setJobGroup("kmeans", "rounds")
    try:
        _, clusters = clustering.kmeans(df, DIMS, 6, starts=6)
        rows = clusters.collect()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    best = min(own, key=lambda m: m.trainingCost)
    assert rows[0]["inertia"] == pytest.approx(best.trainingCost)
    assert sorted(r["size"] for r in rows) == sorted(best.clusterSizes)
    # one job a round for all runs: the first centres take at most 13 jobs a run, reading and writing a few
    assert len(sc.statusTracker().getJobIdsForGroup("kmeans")) <= 6 * 13 + max(m.numIter for m in own) + 10


def test_kmeans_of_fewer_different_rows_than_clusters(spark):
    lab, clusters = clustering.kmeans(points(spark, np.array([[0, 0, 0], [4, 0, 0]] * 5), 1), DIMS, 3, starts=2)
    assert [r["size"] for r in clusters.orderBy("label").collect()] == [5, 5] and clusters.first()["inertia"] == pytest.approx(0)
    assert lab.groupBy("label").count().count() == 2


def test_scaling_verdict_grows_both_trees_at_once(spark, monkeypatch):
    import threading

    both, one = threading.Barrier(2, timeout=60), clustering.single_linkage

    def linked(*a, **b):
        both.wait()
        return one(*a, **b)
    monkeypatch.setattr(clustering, "single_linkage", linked)
    x = np.random.default_rng(4).normal(size=(40, 3)) * [1, 50, 1]
    row = clustering.scaling_verdict(points(spark, x), DIMS).first()
    assert row["raw_ratio"] >= 1 and row["scaled_ratio"] >= 1


def test_runs_are_stored_and_read_back(spark, tmp_path):
    x = np.random.default_rng(6).normal(size=(40, 2))
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "row_id bigint, a double, b double")
    spec = TableSpec({c: ColumnSpec(c, "numerical_continuous", scaling="standard") for c in ("a", "b")})
    run = clustering_run.full_run(df, str(tmp_path), 2, 4, spec=spec)
    assert run.features == ["a", "b"]
    assert runs.latest_results(spark, str(tmp_path)).endswith(run.results_path.rsplit("/", 1)[1])
    wide, features, ks = runs.read_results(spark, run.results_path)
    assert features == ["a", "b"] and ks == [4, 3, 2] and wide.columns[-3:] == ["cluster_k004", "cluster_k003", "cluster_k002"]
    assert sorted(map(tuple, runs.long_labels(wide, ks).select("k", "row_id", "label").collect())) == \
        sorted(map(tuple, run.labels.select("k", "row_id", "label").collect()))
    assert runs.default_k(run.labels).first()["k"] == 3
    assert runs.read_metadata(spark, run.results_path).first()["k_values"] == [4, 3, 2]
    with pytest.raises(ValueError):
        runs.write_results(df, run.labels.where("row_id > 3"), ks, str(tmp_path))
    assert runs.latest_results(spark, str(tmp_path / "none")) is None


def test_csv_null_tokens_and_order(spark, tmp_path):
    (tmp_path / "t.csv").write_text("edu,n,f\nNone,1,1.5\nPhD,NA,x\n Master ,3,\n", encoding="utf-8")
    df = csv.read_csv(spark, str(tmp_path / "t.csv"), "edu string, n bigint, f double", row_id="row_id").orderBy("row_id").collect()
    assert [tuple(r) for r in df] == [(None, 1, 1.5, 0), ("PhD", None, None, 1), (" Master ", 3, None, 2)]
    assert [f.dataType.simpleString() for f in csv.infer_schema(spark, str(tmp_path / "t.csv")).fields] == ["string", "bigint", "string"]
    with pytest.raises(Exception):
        csv.read_csv(spark, str(tmp_path / "absent.csv"))


def test_one_csv_file_with_line_breaks_is_read_by_many_tasks(spark, tmp_path):
    rows = [(i, f"a {i}\n\"b\", {'x' * (i % 7)}\r\n\n" if i % 3 else f"plain {i}", None if i % 5 == 0 else f"c,{i}") for i in range(3000)]
    path = csv.write_csv(spark.createDataFrame(rows, "k bigint, t string, u string").coalesce(1), str(tmp_path / "t.csv"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        lines = spark.read.option("lineSep", "\n").text(path)
        assert lines.rdd.getNumPartitions() > 4
        got = csv.read_csv(spark, path, "k bigint, t string, u string", row_id="row_id", strict=True)
        assert [tuple(x) for x in got.orderBy("row_id").select("k", "t", "u").collect()] == rows
        with pytest.raises(ValueError):
            csv.read_csv(spark, path, "k bigint, other string, u string")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv_quotes_breaks_and_bad_values(spark, tmp_path):
    (tmp_path / "q.csv").write_text('n,t,m\n1,"say ""hi"", ok",5\n2,"two\nlines",x\n', encoding="utf-8")
    schema = "n bigint, t string, m bigint"
    path = str(tmp_path / "q.csv")
    assert sorted(map(tuple, csv.read_csv(spark, path, schema).collect())) == [(1, 'say "hi", ok', 5), (2, "two\nlines", None)]
    assert {r["column"]: r["bad"] for r in csv.bad_values(spark, path, schema).collect()} == {"n": 0, "t": 0, "m": 1}
    with pytest.raises(Exception, match="column m: x"):
        csv.read_csv(spark, path, schema, strict=True).collect()
    odd = spark.createDataFrame([(1, ' a "b", \\ c\r\nd '), (2, ",")], "n bigint, t string")
    back = csv.read_csv(spark, csv.write_csv(odd, str(tmp_path / "odd")), "n bigint, t string")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, odd.collect()))


def test_a_moved_null_changes_the_fingerprint(spark):
    a, b = (spark.createDataFrame([r], "k int, s string, t string") for r in ((1, "x", None), (1, None, "x")))
    assert reuse.content_fingerprint(a) != reuse.content_fingerprint(b)


def test_work_folder_must_be_shared(monkeypatch):
    from types import SimpleNamespace

    from sparkloom import session
    held = {}
    def fake(master):
        conf = SimpleNamespace(get=lambda k, d=None: held.get(k, d), set=held.__setitem__)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="share"):
            session.work_dir(fake(master))
    for master in ("local", "local[8]", "local[*]"):
        held.clear()
        assert session.work_dir(fake(master)) == held[session.CHECKPOINT_CONF]


def test_reusable_tables(spark, tmp_path):
    df = spark.createDataFrame([(i, i % 4) for i in range(20)], "row_id bigint, v int")
    calls = []

    def build(source, spec):
        calls.append(1)
        return source
    a, b = TableSpec(seed=1), TableSpec(seed=2)
    folder = str(tmp_path)
    assert not reuse.is_fresh(df, a, folder)
    for source in (df, df.repartition(5)):
        reuse.materialise_if_stale(source, a, folder, build)
    assert len(calls) == 1 and reuse.is_fresh(df, a, folder)
    reuse.materialise_if_stale(df, b, folder, build)
    reuse.materialise_if_stale(df.where("v > 0"), a, folder, build)
    assert len(calls) == 3 and reuse.stored(spark, folder).count() == 3
    assert reuse.clear(spark, folder) == 3 and reuse.stored(spark, folder).count() == 0


def test_file_fingerprint_reads_new_files_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(reuse, "FILES_A_PASS", 2)
    root, ledger = str(tmp_path / "in [put] %20 é"), str(tmp_path / "ledger")

    def write(value: int, rows: int, folder: str):
        spark.range(rows).selectExpr(f"id + {value} AS path", "if(id % 3 = 0, NULL, 'x') AS n").coalesce(1).write.mode("overwrite").parquet(f"{root}/{folder}")

    def look():
        df = spark.read.option("recursiveFileLookup", "true").schema("path bigint, n string").parquet(root.replace("[", "\\[").replace("]", "\\]"))
        got = reuse.file_fingerprint(df, root.replace("[", "\\[").replace("]", "\\]"), ledger)
        assert got.fingerprint == reuse.content_fingerprint(df) and got.rows == df.count()
        return got.files, got.hashed_files

    for k, folder in enumerate(["a", "b b", "c"]):
        write(k, 10 * k, folder)
    assert look() == (3, 3) and look() == (3, 0)
    write(7, 5, "d")
    write(9, 11, "c")  # overwritten: another file
    assert look() == (4, 2)


@pytest.mark.parametrize("block_rows,few", [(2048, 100_000), (5, 7)])
def test_merge_log_places_are_those_of_the_list(spark, monkeypatch, block_rows, few):
    """Ties and copies included; small blocks count through the grid."""
    x = np.random.default_rng(3).integers(0, 3, size=(40, 3)).astype(float)
    tree, ids, n = linkage.spanning_tree(points(spark, x), DIMS)
    parts, want = [[i] for i in range(0, 3 * n, 3)], []
    for d, i, j in sorted((r["d"], r["i"], r["j"]) for r in tree.collect()):
        a, b = sorted(next(at for at, p in enumerate(parts) if row in p) for row in (i, j))
        want.append((a, b))
        parts = [p for at, p in enumerate(parts) if at not in (a, b)] + [parts[a] + parts[b]]
    monkeypatch.setattr(linkage.list_places, "__defaults__", (block_rows,))
    got = linkage.merge_log(tree, ids, n, 1, few, places=True).orderBy("iteration").collect()
    assert [(r["left_place"], r["right_place"]) for r in got] == want


def test_rows_are_copied_into_no_more_blocks_when_there_are_more_rows(spark):
    """Ten times the rows make ten times the copies, until a block is full."""
    few, many = (distances.block_count(spark.range(1), n, 250) for n in (20_000, 200_000))
    assert few == many < 20 and distances.block_count(spark.range(1), 400, 250) == 2
    assert distances.block_count(spark.range(1), 10_000_000, 250) == -(-10_000_000 // distances.MOST_ROWS)


def test_pairs_are_made_tile_by_tile(spark, monkeypatch):
    x = np.random.default_rng(6).normal(size=(50, 3))
    d = block_distances(x, x, "euclidean")
    df = points(spark, x, 1)
    rows = distances.pair_distances(df, DIMS, block_rows=1000).collect()
    assert {(r["i"], r["j"], r["d"]) for r in rows} == {(i, j, d[i, j]) for i in range(50) for j in range(i + 1, 50)}
    monkeypatch.setattr(distances, "TILE", 7)
    cells = np.zeros((50, 50), int)
    for p, q in distances.tiles(50, 50, True):
        cells[p, q] += 1
    assert (cells[np.triu_indices(50)] == 1).all()


@pytest.mark.parametrize("scale,off", [(1.0, 0.0), (1e-6, 0.0), (1e6, 1e9), (1.0, 1e12), (1.0, np.nan)])
def test_quick_distances(scale, off):
    x = np.random.default_rng(7).normal(size=(60, 9)) * scale + (off if off == off else 0)
    x[40:50] = x[3]
    if off != off:
        x[5, 2] = np.nan
    for metric in ("euclidean", "euclidean_squared", "chebyshev"):
        exact, quick = block_distances(x[:45], x[30:], metric), quick_distances(x[:45], x[30:], metric)
        assert np.allclose(quick, exact, rtol=1e-9, atol=0, equal_nan=True)
        assert (quick[exact == 0] == 0).all()


@pytest.mark.parametrize("metric", ["euclidean", "euclidean_squared", "chebyshev"])
def test_block_trees_are_exact(metric):
    """Ties, copies and columns far from 0: the edges of Kruskal over all exact distances in the order (d, i, j)."""
    r = np.random.default_rng(2)
    for x in (r.normal(size=(60, 5)), r.integers(0, 3, size=(60, 3)) * 1e6 + 1e9, r.normal(size=(40, 2)) * 1e-9 + 1):
        ids = r.permutation(len(x)) * 2
        d, forest, want = block_distances(x, x, metric), linkage.Forest(), set()
        for e in sorted((d[a, b], *sorted((int(ids[a]), int(ids[b])))) for a in range(len(x)) for b in range(a)):
            if forest.join(*e[1:]):
                want.add(e)
        got = linkage.block_tree(ids, x, metric)
        assert set(zip(got["d"], got["i"], got["j"], strict=True)) == want


@pytest.mark.parametrize("metric", ["euclidean", "euclidean_squared", "chebyshev"])
@pytest.mark.parametrize("width", [2, 20])
def test_forests_are_exact(metric, width, monkeypatch):
    monkeypatch.setattr(linkage, "CELL_ROWS", 8)
    r = np.random.default_rng(width)
    x = np.unique(np.round(r.normal(size=(120, width)) + 1e6 * (width > 2), 1), axis=0)  # with ties
    ids = r.permutation(len(x)) * 3
    assert sorted(map(tuple, linkage.forest(ids, x, metric).values)) == sorted(map(tuple, linkage.block_tree(ids, x, metric).values))
    side = r.random(len(x)) < 0.3
    d = block_distances(x, x, metric)
    edges = sorted((d[p, q], *sorted((ids[p], ids[q]))) for p in np.flatnonzero(side) for q in np.flatnonzero(~side))
    home, want = {i: i for i in ids}, []
    for w, i, j in edges:
        if home[i] != home[j]:
            old, new = home[i], home[j]
            home = {v: new if h == old else h for v, h in home.items()}
            want.append((i, j, w))
    assert sorted(map(tuple, linkage.forest(ids, x, metric, side).values)) == sorted(want)


@pytest.mark.parametrize("metric,width", [("euclidean", 1), ("euclidean", 2), ("euclidean", 3), ("chebyshev", 1), ("chebyshev", 2)])
def test_sums_of_distances_form_few_pairs(metric, width, monkeypatch):
    """Sums per cluster equal those over all pairs, of which only near ones are formed."""
    formed = []
    monkeypatch.setattr(summed, "CELL", 300)
    monkeypatch.setattr(summed, "block_distances", lambda x, y, m: formed.append(len(x) * len(y)) or block_distances(x, y, m))
    r = np.random.default_rng(width)
    shapes = [lambda n: r.normal(size=(n, width)), lambda n: r.lognormal(0, 1.5, size=(n, width)),
              lambda n: np.c_[r.integers(0, 5, n) / 2.0, r.uniform(-1.7, 1.7, (n, width - 1))], lambda n: np.ones((n, width)) + r.integers(0, 2, (n, 1)) * 1e-9]
    for shape in shapes:
        x, y = shape(4000), shape(5000)
        ours, theirs = np.eye(3)[r.choice(3, 4000, p=[0.98, 0.019, 0.001])], np.eye(4)[r.integers(0, 4, 5000)]
        formed.clear()
        out, back = summed.summed_distances(x, y, theirs, ours, metric)
        met = sum(formed)
        d = block_distances(x, y, metric)
        np.testing.assert_allclose(out, d @ theirs, rtol=1e-10, atol=0)
        np.testing.assert_allclose(back, d.T @ ours, rtol=1e-10, atol=0)
        assert met < {1: 0.6, 2: 0.9, 3: 1.1}[width] * 4000 * 5000, met  # near cells only, which few rows of three dimensions all are


@pytest.mark.parametrize("metric", ["euclidean", "euclidean_squared", "chebyshev"])
def test_many_dimensions_skip_the_cell_tree(spark, metric, monkeypatch):
    """Boxes separate nothing there, so leaves would be read in nearly all pairs; a first tree rules out pairs instead."""
    for name in ("boruvka", "with_cells"):
        monkeypatch.setattr(linkage, name, None)
    monkeypatch.setattr(linkage, "FEW_PARTS", 6)
    monkeypatch.setattr(linkage, "PART_ROWS", 20)
    r = np.random.default_rng(12)
    x = np.round(r.normal(size=(180, 10)), 1)  # with ties
    x[:60, 0] += 300
    x[170:] *= r.uniform(20, 900, (10, 1))
    x[90:95] = x[80:85]
    df = spark.createDataFrame([(i * 7 % 181, [float(v) for v in p]) for i, p in enumerate(x)], "row_id bigint, v array<double>")
    got = linkage.spanning_tree(df, ["v"], metric, leaf_rows=8)[0].collect()
    want = linkage.block_tree(np.array([i * 7 % 181 for i in range(180)]), x, metric)
    assert sorted(map(tuple, got)) == sorted(map(tuple, want.values))


@pytest.mark.parametrize("metric", ["euclidean", "chebyshev"])
@pytest.mark.parametrize("dense", [0.0, 0.02])
def test_pairs_ruled_out_by_a_first_tree(metric, dense, monkeypatch):
    """The forest under a bound per pair of parts is the forest of all pairs without longer edges; where it rules out little, all pairs are met."""
    monkeypatch.setattr(linkage, "HELD_EDGES", 0 if dense == 0.0 else 500)
    monkeypatch.setattr(linkage, "DENSE", dense)
    monkeypatch.setattr(linkage, "TILE_ROWS", 100)
    monkeypatch.setattr(linkage, "PART_ROWS", 50)
    r = np.random.default_rng(4)
    n = 400
    x, ids, side = r.normal(size=(n, 12)), r.permutation(n) * 3, r.random(n) < 0.4
    part = np.minimum(r.integers(0, 9, n), 5)
    most = r.uniform(0.6, 1.1, (6, 6)) * np.median(block_distances(x, x, metric))
    most = np.maximum(most, most.T)
    for s in (side, None):
        whole = linkage.forest(ids, x, metric, s)
        at = {int(i): k for k, i in enumerate(ids)}
        within = {(int(i), int(j), d) for i, j, d in whole.values if d <= most[part[at[int(i)]], part[at[int(j)]]]}
        got = set(zip(*(c.tolist() for c in linkage._pair_forest(ids, x, part, most, metric, s)), strict=True))
        assert within <= got and len(within) > n / 2


def test_few_points_take_few_jobs(spark):
    """Blocks compared all with all give the tree of the rounds over cells, and a history of few K adds few jobs."""
    x = np.random.default_rng(6).normal(size=(90, 3))
    df = points(spark, x)
    sc = spark.sparkContext
    sc.setJobGroup("few jobs", "few jobs")
    tree, ids, n = linkage.spanning_tree(df, DIMS, leaf_rows=8)
    got = linkage.history(tree, ids, n, 2, 7).toPandas()
    jobs = len(sc.statusTracker().getJobIdsForGroup("few jobs"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 40, jobs
    assert sorted(linkage.spanning_tree(df, DIMS, leaf_rows=8, all_rows=0)[0].collect()) == sorted(tree.collect())
    found, _ = brute(x)
    for k in range(2, 8):
        assert got[got.k == k].sort_values("row_id").label.tolist() == found[k]
    rows, names = linkage.intervals(tree, ids, n, 1, 7)
    assert got.shape[0] == 6 * 90 and names.where("k = 7").count() == 7
    one = linkage.history(tree, ids, n, 1, 1).collect()
    assert len(one) == 90 and {r["label"] for r in one} == {0}


def test_contraction_at_once_equals_rounds(spark):
    r = np.random.default_rng(1)
    edges = [(int(i), int(j), float(d)) for i, j, d in zip(r.integers(0, 40, 150), r.integers(40, 80, 150), r.integers(0, 5, 150), strict=True)]
    df = spark.createDataFrame(edges, "i bigint, j bigint, d double").dropDuplicates(["i", "j"])
    (tree, members), (slow, theirs) = linkage.contract(df), linkage.contract(df, 3)
    assert sorted(tree.collect()) == sorted(slow.collect()) and sorted(members.collect()) == sorted(theirs.collect())


@pytest.mark.parametrize("metric", ["euclidean", "euclidean_squared", "chebyshev"])
def test_block_distances_keep_two_matrices(metric):
    """No new matrix per dimension; sums go dimension by dimension."""
    import tracemalloc
    r = np.random.default_rng(9)
    a, b = r.normal(size=(200, 9)), r.normal(size=(300, 9))
    tracemalloc.start()
    got = block_distances(a, b, metric)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2.5 * got.nbytes
    diff = np.abs(a[:, None] - b[None])
    want = diff.max(axis=2) if metric == "chebyshev" else np.cumsum(diff * diff, axis=2)[:, :, -1]
    assert (got == (np.sqrt(want) if metric == "euclidean" else want)).all()


def test_csv_lines_are_shuffled_once(spark, tmp_path, monkeypatch):
    """Records across many ranges of two files, without an order over all lines."""
    import csv as plain
    monkeypatch.setattr(csv, "with_position", lambda *a: pytest.fail("lines were put in order by a shuffle"))
    r = np.random.default_rng(3)
    want = []
    for f in range(2):
        rows = [[str(100 * f + i), "".join(r.choice(list('ab",\n'), size=int(r.integers(1, 60))))] for i in range(60)]
        want += rows
        with open(tmp_path / f"{f}.csv", "w", newline="", encoding="utf-8") as out:
            plain.writer(out, lineterminator="\n").writerows([["k", "t"], *rows])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    try:
        got = csv.read_csv(spark, str(tmp_path), "k bigint, t string", null_tokens=()).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((str(x["k"]), x["t"]) for x in got) == sorted(map(tuple, want))
