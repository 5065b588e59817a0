"""Greedy tours, weighted walks and colonies over many graphs at once.

State is one row per tour or walker.  Greedy tours meet the sorted successors of
their node a shelf at a time; walks join the edges that leave it, dealt over
salts, so that a hub is met in parts whose minima or sums are combined.  Parallel
edges are reduced first.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkloom.functions.hashing import digest, uniform
from sparkloom.functions.ranks import rank_within
from sparkloom.operators.distances import spread
from sparkloom.operators.graph import (DEAD_END, NO_CLOSING, OK, UNKNOWN_START, first_edges, lightest_successor,
                                       node_counts, score_tours, tour_steps)
from sparkloom.session import cut

BATCH_TOURS = 256
TOUR_SCHEMA = "graph_id int, start bigint, path array<bigint>, length double, status string"
ROUNDS_PER_CUT = 8
SALTS = 4


def salted(edges: DataFrame, salts: int) -> DataFrame:
    """edges + `_salt`: which part of its source's edges an edge belongs to."""
    return edges.withColumn("_salt", F.pmod(F.xxhash64("dst"), F.lit(salts)).cast("int"))


def per_salt(tours: DataFrame, salts: int) -> DataFrame:
    """Every tour once per salt."""
    return tours.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def with_graphs(tours: DataFrame, edges: DataFrame, batch_key: Column, kernel, schema: str, per_batch: int = BATCH_TOURS) -> DataFrame:
    """Applies `kernel(key, tours, edges)` to batches of tours of one graph with that graph's edges.

    The edges of a graph are repeated once per batch of its tours, and a task
    holds one matrix of node pairs: the caller's choice, never made by size.
    """
    counts = tours.groupBy("graph_id").agg(F.ceil(F.count(F.lit(1)) / per_batch).cast("int").alias("_batches"))
    batched = (tours.join(counts, "graph_id")
               .withColumn("_batch", F.pmod(F.xxhash64(batch_key), F.col("_batches")).cast("int")).drop("_batches"))
    copies = (edges.join(counts, "graph_id")
              .withColumn("_batch", F.explode(F.sequence(F.lit(0), F.col("_batches") - 1))).drop("_batches"))
    keys = ["graph_id", "_batch"]
    return (spread(batched, keys).groupBy(*keys).cogroup(spread(copies, keys).groupBy(*keys))
            .applyInPandas(kernel, schema))


def dense_index(edges: pd.DataFrame, *extra) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node ids, source index, target index)."""
    ids = np.unique(np.concatenate([edges["src"].to_numpy(), edges["dst"].to_numpy(), *extra]))
    return ids, np.searchsorted(ids, edges["src"].to_numpy()), np.searchsorted(ids, edges["dst"].to_numpy())


# --- greedy tours ----------------------------------------------------------------

def random_starts(nodes: DataFrame, seed: int = 42) -> DataFrame:
    """(graph_id, start): one hashed node per graph, for calls without a start."""
    pick = F.min_by("node", F.struct(digest(seed, "graph_id", "node").alias("h"), F.col("node")))
    return nodes.groupBy("graph_id").agg(pick.alias("start"))


SHELF = 64


def adjacency(lightest: DataFrame, shelf: int = SHELF) -> DataFrame:
    """(_g, src, shelf, last, next): a node's successors (weight, ord, dst) in that order, `shelf` of them in a row.

    Places come from ranks over range partitions, so a hub's edges are never sorted in one task.
    """
    ranked = rank_within(lightest, ["_g", "src"], ["weight", "ord", "dst"], "place").withColumn("shelf", F.floor((F.col("place") - 1) / shelf).cast("bigint"))
    rows = ranked.groupBy("_g", "src", "shelf").agg(F.array_sort(F.collect_list(F.struct("weight", "ord", "dst"))).alias("next"))
    top = rows.groupBy("_g", "src").agg(F.max("shelf").alias("top"))
    return rows.join(top, ["_g", "src"]).select("_g", "src", "shelf", (F.col("shelf") == F.col("top")).alias("last"), "next")


def greedy_tours(nodes: DataFrame, edges: DataFrame, starts: DataFrame | None = None, strategy: str = "joins",
                 shelf: int = SHELF) -> DataFrame:
    """(graph_id, start, path, length, status): lightest edge to an unvisited node from every start.

    `starts` defaults to all nodes.  A dead end keeps the partial path and its
    length; so does a tour without a closing edge.  Equal weights go to the
    smaller `ord`.  `strategy` "joins" takes graphs of any size: a tour meets one
    row with its node's next `SHELF` successors and asks for more only where all
    of them are visited, so a hub sends one row.  "batches" hands
    batches of starts with all lightest edges of their graph to a task, which is
    faster where a matrix of node pairs fits into a worker.
    """
    if strategy not in ("joins", "batches"):
        raise ValueError(f"unknown strategy {strategy!r}")
    known = nodes.select("graph_id", F.col("node").alias("start"), F.lit(True).alias("known"))
    state = known if starts is None else (starts.select("graph_id", "start").distinct()
                                          .join(known, ["graph_id", "start"], "left"))
    state = (state.join(node_counts(nodes), "graph_id", "left")
             .select(F.col("graph_id").cast("int").alias("graph_id"), F.col("start").cast("bigint").alias("start"),
                     F.coalesce("known", F.lit(False)).alias("known"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))
    # the lightest of parallel edges is the only one a tour can take
    lightest = (edges.select(F.col("graph_id").cast("int").alias("_g"), F.col("src").cast("bigint").alias("src"),
                             F.col("dst").cast("bigint").alias("dst"), F.col("weight").cast("double").alias("weight"), "ord")
                .groupBy("_g", "src", "dst").agg(F.min(F.struct("weight", "ord")).alias("e"))
                .select("_g", "src", "dst", "e.weight", "e.ord"))
    if strategy == "batches":
        return with_graphs(state, lightest.withColumnRenamed("_g", "graph_id"), F.col("start"), _greedy_kernel, TOUR_SCHEMA)
    e = cut(lightest)
    shelves = cut(adjacency(e, shelf)).select("_g", "src", F.col("shelf").alias("_shelf"), "last", "next")
    open_ = F.col("status").isNull()
    state = state.select(
        "graph_id", "start", "n", F.col("start").alias("node"), F.when(F.col("known"), F.array("start"))
        .otherwise(F.array().cast("array<bigint>")).alias("path"), F.lit(0.0).alias("length"),
        F.when(~F.col("known"), UNKNOWN_START).alias("status"), F.lit(0).cast("bigint").alias("shelf"))
    state = cut(state)
    while True:
        for _ in range(ROUNDS_PER_CUT):
            at = ((F.col("graph_id") == F.col("_g")) & (F.col("node") == F.col("src")) & (F.col("shelf") == F.col("_shelf"))
                  & open_ & (F.size("path") < F.col("n")))
            free = F.filter("next", lambda x: ~F.array_contains("path", x["dst"]))
            step = state.join(shelves, at, "left").withColumn("b", F.get(free, F.lit(0)))
            moved, more = F.col("b").isNotNull(), F.col("last") == False  # noqa: E712
            state = step.select(
                "graph_id", "start", "n", F.coalesce("b.dst", "node").alias("node"),
                F.when(moved, F.array_append("path", F.col("b.dst"))).otherwise(F.col("path")).alias("path"),
                (F.col("length") + F.coalesce("b.weight", F.lit(0.0))).alias("length"),
                F.when(open_ & ~moved & ~F.coalesce(more, F.lit(False)) & (F.size("path") < F.col("n")), DEAD_END).otherwise(F.col("status")).alias("status"),
                F.when(moved, F.lit(0).cast("bigint")).when(more, F.col("shelf") + 1).otherwise(F.col("shelf")).alias("shelf"))
        state = cut(state)
        if state.where(open_ & (F.size("path") < F.col("n"))).isEmpty():
            break
    ends = (F.col("graph_id") == F.col("_g")) & (F.col("node") == F.col("src")) & (F.col("start") == F.col("dst"))
    done = state.join(e.select("_g", "src", "dst", F.col("weight").alias("close")), ends, "left")
    closed = open_ & F.col("close").isNotNull()
    return done.select(
        "graph_id", "start", F.when(closed, F.array_append("path", F.col("start"))).otherwise(F.col("path")).alias("path"),
        (F.col("length") + F.when(closed, F.col("close")).otherwise(0.0)).alias("length"),
        F.when(closed, OK).when(open_, NO_CLOSING).otherwise(F.col("status")).alias("status"))


def _greedy_kernel(key, tours: pd.DataFrame, edges: pd.DataFrame) -> pd.DataFrame:
    if not len(tours):
        return pd.DataFrame({"graph_id": [], "start": [], "path": [], "length": [], "status": []})
    starts = tours["start"].to_numpy()
    ids, s, t = dense_index(edges, starts)
    n, w = len(ids), edges["weight"].to_numpy()
    # rank of (weight, insertion) replaces the weight, so ties go to the earlier edge
    order = np.lexsort((edges["ord"].to_numpy(), w))
    best = np.full((n, n), len(order), dtype=np.int64)
    best[s[order[::-1]], t[order[::-1]]] = np.arange(len(order))[::-1]
    weight = np.append(w[order], np.nan)
    m, goal = len(starts), tours["n"].to_numpy()
    at = np.searchsorted(ids, starts)
    origin = at.copy()
    seen = np.zeros((m, n), dtype=bool)
    seen[np.arange(m), at] = True
    paths, length = [[int(v)] for v in starts], np.zeros(m)
    live = np.flatnonzero(tours["known"].to_numpy() & (goal > 1))
    dead = np.zeros(m, dtype=bool)
    while len(live):
        options = np.where(seen[live], len(order), best[at[live]])
        pick = options.argmin(axis=1)
        rank = options[np.arange(len(live)), pick]
        stuck = rank == len(order)
        dead[live[stuck]] = True
        live, pick, rank = live[~stuck], pick[~stuck], rank[~stuck]
        seen[live, pick] = True
        at[live] = pick
        length[live] += weight[rank]
        for row, node in zip(live, pick):
            paths[row].append(int(ids[node]))
        live = live[np.array([len(paths[r]) for r in live], dtype=np.int64) < goal[live]]
    status = []
    for r in range(m):
        close = best[at[r], origin[r]]
        if not tours["known"].iloc[r]:
            paths[r], length[r] = [], 0.0
            status.append(UNKNOWN_START)
        elif dead[r]:
            status.append(DEAD_END)
        elif close == len(order):
            status.append(NO_CLOSING)
        else:
            length[r] += weight[close]
            paths[r].append(int(starts[r]))
            status.append(OK)
    return pd.DataFrame({"graph_id": tours["graph_id"], "start": starts, "path": paths, "length": length, "status": status})


# --- weighted walks ------------------------------------------------------------------

def attraction(alpha: float, beta: float) -> Column:
    """pheromone^alpha * (1/weight)^beta; a zero weight fails the job."""
    return F.pow("pheromone", F.lit(alpha)) * F.pow(F.lit(1.0) / F.col("weight"), F.lit(beta))


def _offered(walkers: DataFrame, edges: DataFrame, alpha: float, beta: float, salts: int) -> DataFrame:
    """(graph_id, walker, dst, attraction) of the unvisited successors of each walker's node; parallel edges add up."""
    if "pheromone" not in edges.columns:
        edges = edges.withColumn("pheromone", F.lit(0.1))
    e = salted(edges.groupBy(F.col("graph_id").alias("_g"), "src", "dst").agg(F.sum(attraction(alpha, beta)).alias("attraction")), salts)
    reach = ((F.col("graph_id") == F.col("_g")) & (F.col("node") == F.col("src")) & (F.col("_salt") == F.col("_part"))
             & ~F.array_contains("path", F.col("dst")))
    return (per_salt(walkers, salts).join(e.withColumnRenamed("_salt", "_part"), reach)
            .select("graph_id", "walker", "dst", "attraction"))


def transition_weights(walkers: DataFrame, edges: DataFrame, alpha: float = 1.0, beta: float = 2.0, salts: int = SALTS) -> DataFrame:
    """(graph_id, walker, dst, attraction, share) of the unvisited successors of each walker's node.

    Parallel edges to one node add up.  A walker has at most n - 1 candidates.
    """
    total = F.sum("attraction").over(Window.partitionBy("graph_id", "walker"))
    return _offered(walkers, edges, alpha, beta, salts).withColumn("share", F.col("attraction") / total)


def walk_step(walkers: DataFrame, edges: DataFrame, draw: Column, alpha: float = 1.0, beta: float = 2.0,
              template: DataFrame | None = None, salts: int = SALTS) -> DataFrame:
    """walkers + `next`: the template's successor if unvisited, else one drawn by attraction; null at a dead end.

    The draw is a race: every candidate waits an exponential time with its
    attraction as rate, and the first one wins.  So a walker needs one minimum,
    taken in parts, and its candidates are never sorted or gathered.
    """
    waits = -F.log(F.lit(1.0) - draw) / F.col("attraction")
    hit = (_offered(walkers, edges, alpha, beta, salts).groupBy("graph_id", "walker")
           .agg(F.min(F.struct(waits.alias("wait"), "dst")).alias("_first")))
    out = walkers.join(hit, ["graph_id", "walker"], "left").withColumn("next", F.col("_first.dst")).drop("_first")
    if template is None:
        return out
    t = template.select(F.col("graph_id").alias("_g"), F.col("src").alias("_s"), F.col("dst").alias("_t"))
    free = (F.col("graph_id") == F.col("_g")) & (F.col("node") == F.col("_s")) & ~F.array_contains("path", F.col("_t"))
    return out.join(t, free, "left").withColumn("next", F.coalesce("_t", "next")).drop("_g", "_s", "_t")


def draw(seed, round_: int | Column, step: int | Column, *more: Column) -> Column:
    """The uniform of one walker in one step."""
    r = F.lit(round_) if isinstance(round_, int) else round_
    s = F.lit(step) if isinstance(step, int) else step
    return uniform(seed, F.col("graph_id"), F.col("walker"), *more, r, s)


def race_draw(seed, round_: int | Column, step: int | Column) -> Column:
    """The uniform of one candidate `dst` of a walker in one step."""
    return draw(seed, round_, step, F.col("dst"))


def reinforce(edges: DataFrame, tours: DataFrame, rho: float = 0.1, q: float = 100.0) -> DataFrame:
    """pheromone * (1 - rho) plus q / length for every tour over the edge (first of parallel edges).

    `tours` holds valid closed tours (graph_id, path, length).
    """
    added = (tour_steps(tours.where(F.col("length") > 0), ["graph_id", "length"])
             .groupBy("graph_id", "src", "dst").agg(F.sum(F.lit(q) / F.col("length")).alias("_add")))
    marked = edges if "is_first" in edges.columns else mark_first(edges)
    joined = marked.join(added, ["graph_id", "src", "dst"], "left")
    plus = F.when(F.col("is_first"), F.coalesce("_add", F.lit(0.0))).otherwise(0.0)
    return (joined.withColumn("pheromone", F.col("pheromone") * F.lit(1.0 - rho) + plus)
            .select(*edges.columns))


def mark_first(edges: DataFrame) -> DataFrame:
    """edges + `is_first`: the edge is the first of its parallel ones."""
    first = first_edges(edges).select("graph_id", "src", "dst", F.col("ord").alias("_first"))
    return (edges.join(first, ["graph_id", "src", "dst"]).withColumn("is_first", F.col("ord") == F.col("_first"))
            .select(*edges.columns, "is_first"))


# --- colonies ----------------------------------------------------------------------------

def ants(nodes: DataFrame, num_ants: int, seed, round_: int) -> DataFrame:
    """(graph_id, walker, node, path): ants on hashed start nodes.

    The node at a hashed position is found by counting nodes per graph.
    """
    from sparkloom.functions.ranks import rank_within
    return _ants(rank_within(nodes.select("graph_id", "node"), ["graph_id"], ["node"], "place"), num_ants, seed, round_)


def _ants(ranked: DataFrame, num_ants: int, seed, round_: int) -> DataFrame:
    counts = ranked.groupBy("graph_id").agg(F.count(F.lit(1)).alias("n"))
    rows = counts.withColumn("walker", F.explode(F.sequence(F.lit(0), F.lit(num_ants - 1))))
    place = F.floor(draw(f"{seed}/start", round_, 0) * F.col("n")) + 1
    return (rows.withColumn("place", place).join(ranked, ["graph_id", "place"])
            .select(F.col("graph_id").cast("int").alias("graph_id"), "walker", F.col("node").cast("bigint").alias("node"),
                    F.array(F.col("node").cast("bigint")).alias("path"), F.col("n").cast("bigint").alias("n")))


def walk_round(walkers: DataFrame, edges: DataFrame, nodes: DataFrame, seed, round_: int, alpha: float = 1.0, beta: float = 2.0,
               template: DataFrame | None = None) -> DataFrame:
    """Closed valid tours (graph_id, walker, path, length) of one round of walks."""
    steps = node_counts(nodes).agg(F.max("n")).first()[0] or 1
    state = walkers.repartition("graph_id", "walker")
    for step in range(1, steps):
        moved = walk_step(state, edges, race_draw(seed, round_, step), alpha, beta, template)
        grown = F.col("next").isNotNull()
        state = moved.select("graph_id", "walker", F.coalesce("next", "node").alias("node"),
                             F.when(grown, F.array_append("path", F.col("next"))).otherwise(F.col("path")).alias("path"), "n")
        if step % 2 == 0:
            state = cut(state)
    closed = state.where(F.size("path") == F.col("n")).select(
        "graph_id", "walker", F.array_append("path", F.element_at("path", 1)).alias("path"))
    return (score_tours(closed, edges, nodes, ["graph_id", "walker"]).where(F.col("status") == OK)
            .select("graph_id", "walker", "path", "length"))


# The defaults below are the published settings.
def colony(nodes: DataFrame, edges: DataFrame, num_ants: int = 10, rounds: int = 100, alpha: float = 1.0, beta: float = 2.0,
           rho: float = 0.1, q: float = 100.0, initial: float = 0.1, use_template: bool = False, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(best tour per graph (graph_id, length, round, walker, path), edges with their final pheromone).

    Each round is one job for all ants of all graphs; its edge table is cut so
    that neither the plan nor the recovery work grows with the rounds.
    """
    from sparkloom.functions.ranks import rank_within
    nodes = nodes.select("graph_id", "node").persist()
    template = cut(lightest_successor(edges, seed)) if use_template else None
    ranked = rank_within(nodes, ["graph_id"], ["node"], "place").persist()
    state = mark_first(edges.withColumn("pheromone", F.lit(float(initial))))
    state = cut(state)
    best = None
    for r in range(rounds):
        tours = cut(walk_round(_ants(ranked, num_ants, seed, r), state, nodes, seed, r, alpha, beta, template))
        top = F.min(F.struct("length", F.lit(r).alias("round"), "walker", "path")).alias("b")
        mine = tours.groupBy("graph_id").agg(top)
        best = mine if best is None else best.unionByName(mine).groupBy("graph_id").agg(F.min("b").alias("b"))
        if (r + 1) % ROUNDS_PER_CUT == 0:
            best = cut(best)
        state = cut(reinforce(state, tours, rho, q))
    if best is None:
        raise ValueError("at least one round is needed")
    return best.select("graph_id", "b.*"), state.select(*edges.columns, "pheromone")
