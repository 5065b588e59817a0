"""Edge tables, adjacency, tour scoring and edge reports.

nodes(graph_id, node [, x, y]); edges(graph_id, src, dst, weight, ord), where
`ord` keeps the order of insertion because ties depend on it.  Many graphs live
in one table; every key starts with graph_id.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.hashing import digest, uniform_int
from sparkloom.functions.ranks import rank_within, smallest_digest_bound, with_position
from sparkloom.session import cut

OK = "ok"
DEAD_END = "no reachable node"
NO_CLOSING = "no closing edge"
UNKNOWN_START = "unknown start"
NOT_A_TOUR = "not a closed tour"


# --- building -----------------------------------------------------------------

def build_edges(edges: DataFrame, directed: bool = True, self_loops: bool = True, zero_weights: bool = True) -> DataFrame:
    """Edge table; an undirected graph gets the mirrored copy right after each edge.

    A missing weight is 1.  Self-loops and zero weights can be refused.
    """
    weight = F.coalesce(F.col("weight").cast("double"), F.lit(1.0)) if "weight" in edges.columns else F.lit(1.0)
    base = edges.select("graph_id", "src", "dst", weight.alias("weight"), F.col("ord").cast("bigint").alias("ord"))
    guard = F.lit(True)
    if not self_loops:
        guard = guard & F.assert_true(F.col("src") != F.col("dst"), F.lit("self-loop")).isNull()
    if not zero_weights:
        guard = guard & F.assert_true(F.col("weight") != 0, F.lit("zero weight")).isNull()
    base = base.where(guard)
    if directed:
        return base
    forward = base.withColumn("ord", F.col("ord") * 2)
    back = base.select("graph_id", F.col("dst").alias("src"), F.col("src").alias("dst"), "weight",
                       (F.col("ord") * 2 + 1).alias("ord"))
    return forward.unionByName(back)


FEISTEL_ROUNDS, MAX_WALK = 4, 64


def permuted(numbers: DataFrame, size: int, seed) -> DataFrame:
    """(id, image): the image of 0 <= id < size under a permutation hashed from the seed.

    The number is written as two digits to the base `side`; in each round one
    digit is moved by a hash of the other one.  That permutes side * side
    numbers; an image beyond `size` is permuted again until one falls inside.
    Moves are looked up by digit and the few numbers beyond `size` are led inside
    once, so a row costs joins with small tables and no hash.  These tables have
    `side` rows each, the square root of `size`, and are broadcast whatever Spark's
    threshold: else every one of up to `size` rows would be shuffled for each.
    """
    if size < 1:
        return numbers.select("id", F.col("id").alias("image"))
    spark = numbers.sparkSession
    side = math.isqrt(max(size - 1, 0)) + 1
    moves = [cut(spark.range(side).select(F.col("id").alias("_by"), (F.conv(F.substring(digest(f"{seed}/{k}", "id"), 1, 13), 16, 10)
                                                                   .cast("bigint") % side).alias("_move"))) for k in range(1, FEISTEL_ROUNDS + 1)]

    def once(rows: DataFrame) -> DataFrame:
        rows = rows.withColumns({"_l": F.floor(F.col("image") / side).cast("bigint"), "_r": F.col("image") % side})
        for k, table in enumerate(moves, 1):
            moved, by = ("_l", "_r") if k % 2 else ("_r", "_l")
            rows = rows.join(F.broadcast(table), F.col(by) == F.col("_by")).withColumn(moved, (F.col(moved) + F.col("_move")) % side).drop("_by", "_move")
        return rows.withColumn("image", F.col("_l") * side + F.col("_r")).drop("_l", "_r")

    beyond = spark.range(size, side * side).select(F.col("id").alias("_from"), F.col("id").alias("image"))
    led = None
    for _ in range(MAX_WALK):
        beyond = cut(once(beyond))
        inside = beyond.where(F.col("image") < size)
        led = inside if led is None else led.unionByName(inside)
        # nothing inside leads to a round trip beyond
        beyond = beyond.where((F.col("image") >= size) & (F.col("image") != F.col("_from")))
        if beyond.isEmpty():
            break
    led = cut(led.withColumnRenamed("image", "_to"))
    out = once(numbers.select("id", F.col("id").alias("image")))
    image = F.coalesce("_to", "image")
    return out.join(F.broadcast(led), F.col("image") == F.col("_from"), "left").select(
        "id", F.when(image < size, image).otherwise(F.raise_error(F.lit("no image inside")).cast("bigint")).alias("image"))


def random_graph(nodes: DataFrame, m: int, width: float = 800.0, height: float = 600.0, seed: int = 0,
                 node: str = "node") -> tuple[DataFrame, DataFrame]:
    """(nodes with a jittered grid layout, m edges): exactly m of the n(n-1) ordered pairs, weights 1..50.

    Pairs are numbered, and edge t is the pair that a permutation of the numbers
    puts in place t: none is formed twice, and nothing but the m edges is scanned.
    """
    placed = cut(with_position(nodes.select(F.col(node).cast("bigint").alias("node")), ["node"], "place"))
    n = placed.count()
    pairs = n * (n - 1)
    if not 0 <= m <= pairs:
        raise ValueError(f"{m} edges among {n} nodes")
    cols = max(1, int(n ** 0.5))
    rows = (n + cols - 1) // cols
    pad = 30
    xs = (width - 2 * pad) / (cols - 1) if cols > 1 else 0.0
    ys = (height - 2 * pad) / (rows - 1) if rows > 1 else 0.0
    layout = placed.select(
        F.lit(0).alias("graph_id"), "node",
        (F.lit(pad) + F.col("place") % cols * F.lit(xs) + uniform_int(f"{seed}/x", -10, 10, "node")).cast("double").alias("x"),
        (F.lit(pad) + F.floor(F.col("place") / cols) * F.lit(ys) + uniform_int(f"{seed}/y", -10, 10, "node")).cast("double").alias("y"))
    chosen = permuted(nodes.sparkSession.range(m), pairs, f"{seed}/edge").select(F.col("image").alias("pair"))
    a, r = F.floor(F.col("pair") / max(n - 1, 1)).cast("bigint"), F.col("pair") % max(n - 1, 1)
    chosen = chosen.select("pair", a.alias("a"), (r + F.when(r >= a, 1).otherwise(0)).alias("b"))
    ends = placed.select("place", "node")  # up to the square of their number of edges, which are not to be shuffled
    edges = (chosen.join(F.broadcast(ends.select(F.col("place").alias("a"), F.col("node").alias("src"))), "a")
             .join(F.broadcast(ends.select(F.col("place").alias("b"), F.col("node").alias("dst"))), "b")
             .select(F.lit(0).alias("graph_id"), "src", "dst",
                     uniform_int(f"{seed}/weight", 1, 50, "pair").cast("double").alias("weight"), F.col("pair").alias("ord")))
    return layout, edges


def nodes_of(edges: DataFrame) -> DataFrame:
    """(graph_id, node) of all endpoints."""
    return (edges.select("graph_id", F.explode(F.array("src", "dst")).alias("node")).distinct())


def node_counts(nodes: DataFrame) -> DataFrame:
    """(graph_id, n)."""
    return nodes.groupBy("graph_id").agg(F.count(F.lit(1)).alias("n"))


# --- neighbours -----------------------------------------------------------------

def sorted_adjacency(edges: DataFrame) -> DataFrame:
    """Edges with `rank` among the edges leaving their source, by weight, then insertion."""
    return rank_within(edges, ["graph_id", "src"], ["weight", "ord"])


def lightest_successor(edges: DataFrame, seed: int = 42) -> DataFrame:
    """(graph_id, src, dst, weight): lightest edge per node, a seeded hash decides ties."""
    tie = digest(seed, "graph_id", "src", "dst", "ord")
    best = F.min(F.struct(F.col("weight"), tie.alias("h"), F.col("dst"))).alias("best")
    return edges.groupBy("graph_id", "src").agg(best).select("graph_id", "src", F.col("best.dst").alias("dst"),
                                                             F.col("best.weight").alias("weight"))


def first_edges(edges: DataFrame) -> DataFrame:
    """One edge per (graph_id, src, dst): the first of parallel edges."""
    return (edges.groupBy("graph_id", "src", "dst")
            .agg(F.min(F.struct("ord", "weight")).alias("e"))
            .select("graph_id", "src", "dst", F.col("e.weight").alias("weight"), F.col("e.ord").alias("ord")))


# --- tours ------------------------------------------------------------------------

def path_text(path: Column | str) -> Column:
    p = F.col(path) if isinstance(path, str) else path
    return F.array_join(F.transform(p, lambda v: v.cast("string")), "-")


def tour_steps(tours: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., pos, src, dst) of consecutive nodes."""
    steps = F.arrays_zip(F.slice("path", 1, F.size("path") - 1).alias("src"), F.slice("path", 2, F.size("path") - 1).alias("dst"))
    # a path of one node has no step
    steps = F.when(F.size("path") > 1, steps)
    return (tours.select(*keys, F.posexplode(steps).alias("pos", "s"))
            .select(*keys, "pos", F.col("s.src").alias("src"), F.col("s.dst").alias("dst")))


def score_tours(tours: DataFrame, edges: DataFrame, nodes: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """tours + (length, status): a closed tour of n + 1 nodes over existing edges, else null and a reason."""
    keys = keys or ["graph_id", "tour_id"]
    weights = first_edges(edges).select("graph_id", "src", "dst", "weight")
    found = (tour_steps(tours, keys).join(weights, ["graph_id", "src", "dst"])
             .groupBy(*keys).agg(F.sum("weight").alias("_sum"), F.count(F.lit(1)).alias("_found")))
    shaped = (F.size("path") == F.col("n") + 1) & (F.element_at("path", 1) == F.element_at("path", -1))
    valid = shaped & (F.coalesce("_found", F.lit(0)) == F.col("n"))
    return (tours.join(node_counts(nodes), "graph_id").join(found, keys, "left")
            .withColumns({"length": F.when(valid, F.col("_sum")),
                          "status": F.when(valid, OK).otherwise(NOT_A_TOUR)})
            .drop("n", "_sum", "_found"))


def best_tours(tours: DataFrame, by: str = "start") -> DataFrame:
    """Shortest successful tour per graph; the smallest `by` wins ties."""
    best = F.min(F.struct(F.col("length"), F.col(by), F.col("path"))).alias("b")
    return (tours.where(F.col("status") == OK).groupBy("graph_id").agg(best)
            .select("graph_id", F.col("b.length").alias("length"), F.col(f"b.{by}").alias(by), F.col("b.path").alias("path")))


def tour_edges(tours: DataFrame, edges: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The answer as edge rows: (keys..., pos, src, dst, weight, path_text)."""
    keys = keys or ["graph_id", "tour_id"]
    text = tours.select(*keys, path_text("path").alias("path_text"))
    return (tour_steps(tours, keys).join(first_edges(edges).drop("ord"), ["graph_id", "src", "dst"])
            .join(text, keys).select(*keys, "pos", "src", "dst", "weight", "path_text"))


def edge_report(edges: DataFrame, answer: DataFrame) -> DataFrame:
    """All edges with `used`: their (src, dst, weight) occurs in the answer; sort by (graph_id, src, dst)."""
    hit = answer.select("graph_id", "src", "dst", "weight").distinct().withColumn("_u", F.lit(True))
    return (edges.join(hit, ["graph_id", "src", "dst", "weight"], "left")
            .withColumn("used", F.col("_u").isNotNull()).drop("_u").orderBy("graph_id", "src", "dst"))
