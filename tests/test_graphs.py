"""Edge tables, tours, walks, colonies and annealing; both greedy strategies must agree."""

import pytest
from pyspark.sql import functions as F

from sparkloom.operators import annealing, graph, tours
from sparkloom.session import cut

EDGE = "graph_id int, src bigint, dst bigint, weight double, ord bigint"


@pytest.fixture(scope="module")
def small(spark):
    rows = [(0, 0, 1, 1.0, 0), (0, 0, 2, 1.0, 1), (0, 1, 2, 2.0, 2), (0, 1, 3, 1.0, 3), (0, 2, 3, 1.0, 4), (0, 3, 0, 5.0, 5),
            (1, 7, 8, 3.0, 0), (1, 7, 8, 2.0, 1), (1, 8, 7, 4.0, 2)]
    e = spark.createDataFrame(rows, EDGE).persist()
    return e, graph.nodes_of(e).persist()


@pytest.fixture(scope="module")
def dense(spark):
    nodes, edges = graph.random_graph(spark.range(8).withColumnRenamed("id", "node"), 48)
    return cut(edges), cut(nodes)


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_random_graph(spark):
    nodes, edges = graph.random_graph(spark.range(20).withColumnRenamed("id", "node"), 186)
    e = edges.collect()
    assert len(e) == len({(r["src"], r["dst"]) for r in e}) == 186 and nodes.count() == 20
    assert all(r["src"] != r["dst"] and 1 <= r["weight"] <= 50 for r in e)
    with pytest.raises(ValueError):
        graph.random_graph(spark.range(3).withColumnRenamed("id", "node"), 7)


def test_edge_guards(spark):
    loop = spark.createDataFrame([(0, 1, 1, 0.0, 0)], EDGE)
    assert graph.build_edges(loop).count() == 1
    with pytest.raises(Exception, match="self-loop"):
        graph.build_edges(loop, self_loops=False).count()
    with pytest.raises(Exception, match="zero weight"):
        graph.build_edges(loop, zero_weights=False).count()
    both = graph.build_edges(spark.createDataFrame([(0, 1, 2, None, 0)], EDGE), directed=False)
    assert rows(both) == [(0, 1, 2, 1.0, 0), (0, 2, 1, 1.0, 1)]


@pytest.mark.parametrize("strategy", ["joins", "batches"])
def test_greedy(spark, small, strategy):
    edges, nodes = small
    starts = spark.createDataFrame([(0, 0), (0, 1), (0, 2), (0, 99), (1, 7)], "graph_id int, start bigint")
    got = {r["start"]: (r["path"], r["length"], r["status"]) for r in tours.greedy_tours(nodes, edges, starts, strategy).collect()}
    assert got == {0: ([0, 1, 3], 2.0, graph.DEAD_END), 1: ([1, 3, 0, 2], 7.0, graph.NO_CLOSING), 2: ([2, 3, 0, 1, 2], 9.0, graph.OK),
                   99: ([], 0.0, graph.UNKNOWN_START), 7: ([7, 8, 7], 6.0, graph.OK)}
    assert tours.greedy_tours(nodes.limit(0), edges.limit(0), None, strategy).count() == 0


def test_scores_best_and_reports(small):
    edges, nodes = small
    t = cut(tours.greedy_tours(nodes, edges))
    scored = graph.score_tours(t.select("graph_id", "start", "path"), edges, nodes, ["graph_id", "start"]).collect()
    # the first of parallel edges counts in a score, the lightest in the greedy tour
    assert {r["start"]: r["length"] for r in scored} == {0: None, 1: None, 2: 9.0, 3: 9.0, 7: 7.0, 8: 7.0}
    best = {r["graph_id"]: (r["length"], r["start"]) for r in graph.best_tours(t).collect()}
    assert best == {0: (9.0, 2), 1: (6.0, 7)}
    answer = graph.tour_edges(graph.best_tours(t), edges, ["graph_id"])
    assert answer.where("graph_id = 0").first()["path_text"] == "2-3-0-1-2"
    report = graph.edge_report(edges, answer).where("graph_id = 0").collect()
    assert [r["used"] for r in report] == [True, False, True, False, True, True]
    ranked = {(r["src"], r["dst"]): r["rank"] for r in graph.sorted_adjacency(edges).where("graph_id = 0").collect()}
    assert ranked[(0, 1)] == 1 and ranked[(0, 2)] == 2 and ranked[(1, 3)] == 1
    assert {(r["src"], r["dst"]) for r in graph.lightest_successor(edges).where("graph_id = 0 and src in (1, 2, 3)").collect()} == \
        {(1, 3), (2, 3), (3, 0)}


def test_greedy_strategies_agree(dense):
    edges, nodes = dense
    assert rows(tours.greedy_tours(nodes, edges, strategy="batches")) == rows(tours.greedy_tours(nodes, edges, shelf=2))


def test_reinforcement(spark):
    e = spark.createDataFrame([(0, 0, 1, 1.0, 0, 0.1), (0, 0, 1, 1.0, 1, 0.1)], EDGE + ", pheromone double")
    t = spark.createDataFrame([(0, [0, 1], 50.0)], "graph_id int, path array<bigint>, length double")
    assert [r["pheromone"] for r in tours.reinforce(e, t).orderBy("ord").collect()] == pytest.approx([2.09, 0.09])


def test_many_parallel_edges(spark):
    e = spark.range(2000).selectExpr("0 AS graph_id", "id % 2 AS src", "1 - id % 2 AS dst", "cast(1 + pmod(id * 7919, 1000) AS double) AS weight", "id AS ord")
    for strategy in ("joins", "batches"):
        got = tours.greedy_tours(graph.nodes_of(e), e, strategy=strategy).collect()
        low = [e.where(f"src = {s}").agg({"weight": "min"}).first()[0] for s in (0, 1)]
        assert {r["start"]: (r["path"], r["length"]) for r in got} == {0: ([0, 1, 0], sum(low)), 1: ([1, 0, 1], sum(low))}


@pytest.mark.parametrize("template", [False, True])
def test_colony(dense, template):
    edges, nodes = dense
    best, marked = tours.colony(nodes, edges, num_ants=4, rounds=2, use_template=template)
    for r in best.collect():
        assert len(set(r["path"])) == 8 and r["path"][0] == r["path"][-1]
    assert marked.where("pheromone > 0.1").count() >= 8


def test_zero_weight_fails(spark):
    e = spark.createDataFrame([(0, 0, 1, 0.0, 0)], EDGE).withColumn("pheromone", F.lit(0.1))
    w = spark.createDataFrame([(0, 0, 0, [0])], "graph_id int, walker int, node bigint, path array<bigint>")
    with pytest.raises(Exception):
        tours.transition_weights(w, e).collect()


def test_two_opt(spark):
    df = spark.createDataFrame([([0, 1, 2, 3, 4, 5, 0],)], "path array<bigint>")
    assert df.select(annealing.two_opt("path", 2, 4).alias("p")).first()["p"] == [0, 1, 4, 3, 2, 5, 0]
    moved = annealing.two_opt_moves(df.withColumn("tour_id", F.lit(0)), 40, keys=["tour_id"]).collect()
    assert all(1 <= r["i"] < r["k"] <= 5 and sorted(r["path"]) == [0, 0, 1, 2, 3, 4, 5] for r in moved)
    assert len({(r["i"], r["k"]) for r in moved}) > 5


def test_all_moves(spark):
    df = spark.createDataFrame([(0, [0, 1, 2, 3, 4, 0]), (1, [7, 8, 7])], "tour_id int, path array<bigint>")
    got = annealing.all_moves(df, keys=["tour_id"]).collect()
    assert sorted((r["i"], r["k"]) for r in got) == [(1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4)]
    assert {r["tour_id"] for r in got} == {0}


def test_annealing_cools_or_raises(dense):
    edges, nodes = dense
    best = cut(graph.best_tours(tours.greedy_tours(nodes, edges)).select("graph_id", "path", "length"))
    out = annealing.anneal(annealing.chains(best, [0.2], (False,), initial_temp=5.0), edges, nodes, initial_temp=5.0).collect()
    start = best.first()["length"]
    assert all(r["temp"] < 1 and r["best_length"] <= start for r in out)
    with pytest.raises(RuntimeError, match="still warm"):
        annealing.anneal(annealing.chains(best, [0.99]), edges, nodes, 3)


def test_walkers_stand_on_every_place_of_every_greedy_path(spark, small):
    """Paths of four nodes and fewer count too, and no walker shares its name with another."""
    from sparkloom.plans.graph_queries import standing
    e, n = small
    t = cut(tours.greedy_tours(n, e))
    found = standing(t, n).collect()
    want = {(r["graph_id"], r["start"], i + 1, r["path"][i], tuple(r["path"][:i + 1]))
            for r in t.collect() for i in range(len(set(r["path"])))}
    assert {(r["graph_id"], r["start"], r["place"], r["node"], tuple(r["path"])) for r in found} == want
    assert len(found) == len(want) == len({(r["graph_id"], r["walker"]) for r in found})
    assert {len(r["path"]) for r in found} == {1, 2, 3, 4}


def test_permuted_numbers_are_all_different_and_the_walk_ends(spark):
    """Also where numbers beyond the size only lead to each other."""
    for size, seed in ((0, "a"), (1, "a"), (2, "b"), (3, "c"), (5, "0/edge"), (90, "0/edge")):
        got = [r["image"] for r in graph.permuted(spark.range(size), size, seed).collect()]
        assert sorted(got) == list(range(size))


def test_random_edges_are_looked_up_by_broadcast(spark):
    """m rows are neither hashed for their place nor shuffled."""
    nodes = spark.range(300).withColumnRenamed("id", "node")
    plan = graph.random_graph(nodes, 1000)[1]._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan and plan.count("md5") == 1


def test_random_edges_are_not_shuffled(spark):
    """All tables that the edges meet have the square root of their number of rows at most, so they come to the edges."""
    nodes = spark.range(40).select(F.col("id").alias("node"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        edges = graph.random_graph(nodes, 500)[1]
        assert edges.select("src", "dst").distinct().count() == 500 and edges.where("src = dst").count() == 0
        plan = edges._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
