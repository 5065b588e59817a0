"""Registered queries: edge tables, tours, walks, colonies and annealing."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.functions.hashing import digest_sql, uniform_sql
from sparkloom.operators import annealing, graph, tours
from sparkloom.plans.registry import query, rounded, rs, table
from sparkloom.session import cut

# Trade between nations, one graph per order year: weight is the quantity sold.
EDGES = """e AS (SELECT year(o_orderdate)::INTEGER AS graph_id, c_nationkey::BIGINT AS src, s_nationkey::BIGINT AS dst,
 sum(l_quantity)::DOUBLE AS weight, (c_nationkey * 1000 + s_nationkey)::BIGINT AS ord
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
 WHERE c_nationkey <> s_nationkey GROUP BY ALL)"""
NODES = "nodes AS (SELECT DISTINCT graph_id, unnest([src, dst]) AS node FROM e), sizes AS (SELECT graph_id, count(*) AS n FROM nodes GROUP BY 1)"
GREEDY = f"""{EDGES}, {NODES},
rec AS (SELECT graph_id, node AS start, node, [node] AS path, 0.0::DOUBLE AS length, 1 AS k FROM nodes
 UNION ALL SELECT graph_id, start, b.dst, list_append(path, b.dst), length + b.weight, k + 1 FROM
 (SELECT r.graph_id, r.start, r.path, r.length, r.k, arg_min({{'dst': e.dst, 'weight': e.weight}}, {{'w': e.weight, 'o': e.ord}}) AS b
  FROM rec r JOIN e ON e.graph_id = r.graph_id AND e.src = r.node WHERE NOT list_contains(r.path, e.dst)
  GROUP BY r.graph_id, r.start, r.path, r.length, r.k)),
last AS (SELECT * FROM rec QUALIFY row_number() OVER (PARTITION BY graph_id, start ORDER BY k DESC) = 1),
tours AS (SELECT l.graph_id, l.start, CASE WHEN k = n AND c.weight IS NOT NULL THEN list_append(path, l.start) ELSE path END AS path,
 l.length + CASE WHEN k = n THEN coalesce(c.weight, 0) ELSE 0 END AS length,
 CASE WHEN k < n THEN 'no reachable node' WHEN c.weight IS NULL THEN 'no closing edge' ELSE 'ok' END AS status
 FROM last l JOIN sizes USING (graph_id) LEFT JOIN e c ON c.graph_id = l.graph_id AND c.src = l.node AND c.dst = l.start)"""
BEST = f"{GREEDY}, best AS (SELECT graph_id, b.length AS length, b.start AS start, b.path AS path FROM (SELECT graph_id, min({{'length': length, 'start': start, 'path': path}}) AS b FROM tours WHERE status = 'ok' GROUP BY 1))"


def trade(spark, sf):
    """(edges, nodes) of the trade graphs."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("graph_id"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").cast("bigint").alias("src"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").cast("bigint").alias("dst"))
    sold = (li.join(o, li["l_orderkey"] == o["o_orderkey"]).join(c, "o_custkey").join(s, "l_suppkey").where("src <> dst")
            .groupBy("graph_id", "src", "dst").agg(F.sum("l_quantity").alias("weight"))
            .withColumn("ord", F.col("src") * 1000 + F.col("dst")))
    # nations bound the result, and every later job starts from it
    edges = cut(graph.build_edges(sold, self_loops=False, zero_weights=False))
    return edges, graph.nodes_of(edges)


def greedy(spark, sf):
    edges, nodes = trade(spark, sf)
    return cut(tours.greedy_tours(nodes, edges)), edges, nodes


# --- edges -------------------------------------------------------------------------

@query(f"WITH {EDGES} SELECT graph_id, src, dst, {rs('weight')} AS weight, ord FROM e")
def nation_edges(spark, sf):
    return rounded(trade(spark, sf)[0], ["weight"])


@query(f"""WITH {EDGES} SELECT graph_id, src, dst, {rs('weight')} AS weight, ord * 2 AS ord FROM e
UNION ALL SELECT graph_id, dst, src, {rs('weight')}, ord * 2 + 1 FROM e""")
def undirected_edges(spark, sf):
    return rounded(graph.build_edges(trade(spark, sf)[0], directed=False), ["weight"])


@query(f"""WITH {EDGES} SELECT graph_id, src, dst, {rs('weight')} AS weight, ord,
row_number() OVER (PARTITION BY graph_id, src ORDER BY e.weight, ord) AS "rank" FROM e""")
def sorted_adjacency(spark, sf):
    return rounded(graph.sorted_adjacency(trade(spark, sf)[0]), ["weight"])


@query(f"""WITH {EDGES}, b AS (SELECT graph_id, src, min({{'w': weight, 'h': {digest_sql(42, 'graph_id', 'src', 'dst', 'ord')}, 'd': dst}}) AS b FROM e GROUP BY 1, 2)
SELECT graph_id, src, b.d AS dst, {rs('b.w')} AS weight FROM b""")
def successor(spark, sf):
    return rounded(graph.lightest_successor(trade(spark, sf)[0]), ["weight"])


# suppliers as nodes, a third of all ordered pairs as edges
RANDOM_SHARE = 3


def round_sql(x: str, key: str, k: int) -> str:
    return f"({x} + (('0x' || substr({digest_sql(f'0/edge/{k}', key)}, 1, 13))::BIGINT % side)) % side"


@query(f"""WITH RECURSIVE p AS (SELECT s_suppkey AS node, row_number() OVER (ORDER BY s_suppkey) - 1 AS place, count(*) OVER () AS n FROM supplier),
size AS (SELECT count(*) * (count(*) - 1) AS pairs, ceil(sqrt(count(*) * (count(*) - 1)))::BIGINT AS side FROM supplier),
walk AS (SELECT t, t AS x, pairs, side, false AS met FROM (SELECT pairs, side, unnest(range(pairs // {RANDOM_SHARE})) AS t FROM size)
 UNION ALL SELECT t, l2 * side + r2, pairs, side, l2 * side + r2 < pairs FROM (
  SELECT *, {round_sql('r1', 'l2', 4)} AS r2 FROM (SELECT *, {round_sql('l1', 'r1', 3)} AS l2 FROM (
  SELECT *, {round_sql('r0', 'l1', 2)} AS r1 FROM (SELECT *, {round_sql('l0', 'r0', 1)} AS l1 FROM (
  SELECT *, x // side AS l0, x % side AS r0 FROM walk WHERE NOT met)))))),
picked AS (SELECT t, x AS pair FROM walk WHERE met),
ends AS (SELECT t, pair, pair // (n - 1) AS a, pair % (n - 1) + CASE WHEN pair % (n - 1) >= pair // (n - 1) THEN 1 ELSE 0 END AS b FROM picked, (SELECT any_value(n) AS n FROM p))
SELECT 0 AS graph_id, s.node AS src, d.node AS dst, (1 + floor({uniform_sql('0/weight', 'pair')} * 50))::DOUBLE AS weight, pair AS ord
FROM ends JOIN p s ON s.place = a JOIN p d ON d.place = b""")
def random_edges(spark, sf):
    s = table(spark, sf, "supplier")
    n = s.count()
    return graph.random_graph(s, n * (n - 1) // RANDOM_SHARE, node="s_suppkey")[1]


@query(f"""WITH p AS (SELECT s_suppkey AS node, row_number() OVER (ORDER BY s_suppkey) - 1 AS place, count(*) OVER () AS n FROM supplier),
g AS (SELECT *, floor(sqrt(n))::BIGINT AS cols FROM p), h AS (SELECT *, (n + cols - 1) // cols AS rows_ FROM g)
SELECT 0 AS graph_id, node, {rs("30 + (place % cols) * (740.0::DOUBLE / (cols - 1)) - 10 + floor(" + uniform_sql('0/x', 'node') + " * 21)")} AS x,
{rs("30 + (place // cols) * (540.0::DOUBLE / (rows_ - 1)) - 10 + floor(" + uniform_sql('0/y', 'node') + " * 21)")} AS y FROM h""")
def random_layout(spark, sf):
    s = table(spark, sf, "supplier")
    return rounded(graph.random_graph(s, s.count(), node="s_suppkey")[0], ["x", "y"])


# --- tours -----------------------------------------------------------------------------

@query(f"WITH RECURSIVE {GREEDY} SELECT graph_id, start, array_to_string(path, '-') AS path_text, {rs('length')} AS length, status FROM tours")
def greedy_tours(spark, sf):
    t, _, _ = greedy(spark, sf)
    return rounded(t.select("graph_id", "start", graph.path_text("path").alias("path_text"), "length", "status"), ["length"])


@query(f"""WITH {EDGES}, {NODES} SELECT graph_id, arg_min(node, {{'h': {digest_sql(42, 'graph_id', 'node')}, 'n': node}}) AS start FROM nodes GROUP BY 1""")
def random_starts(spark, sf):
    return tours.random_starts(trade(spark, sf)[1])


@query(f"WITH RECURSIVE {BEST} SELECT graph_id, {rs('length')} AS length, start, array_to_string(path, '-') AS path_text FROM best")
def best_tour(spark, sf):
    t, _, _ = greedy(spark, sf)
    best = graph.best_tours(t)
    return rounded(best.select("graph_id", "length", "start", graph.path_text("path").alias("path_text")), ["length"])


# every greedy path scored as it stands: partial paths are no tours
SCORED = """steps AS (SELECT graph_id, start, path, unnest(range(1, len(path))) AS i FROM tours),
found AS (SELECT s.graph_id, s.start, sum(e.weight) AS w, count(*) AS c FROM steps s JOIN e ON e.graph_id = s.graph_id AND e.src = s.path[s.i] AND e.dst = s.path[s.i + 1] GROUP BY 1, 2)"""


@query(f"""WITH RECURSIVE {GREEDY}, {SCORED}
SELECT t.graph_id, t.start, CASE WHEN len(path) = n + 1 AND path[1] = path[-1] AND c = n THEN {rs('w')} END AS length,
CASE WHEN len(path) = n + 1 AND path[1] = path[-1] AND c = n THEN 'ok' ELSE 'not a closed tour' END AS status
FROM tours t JOIN sizes USING (graph_id) LEFT JOIN found f ON f.graph_id = t.graph_id AND f.start = t.start""")
def tour_length(spark, sf):
    t, edges, nodes = greedy(spark, sf)
    out = graph.score_tours(t.select("graph_id", "start", "path"), edges, nodes, ["graph_id", "start"])
    return rounded(out.select("graph_id", "start", "length", "status"), ["length"])


@query(f"""WITH RECURSIVE {BEST}, steps AS (SELECT graph_id, path, unnest(range(1, len(path))) AS i FROM best)
SELECT s.graph_id, (i - 1)::INTEGER AS pos, e.src, e.dst, {rs('e.weight')} AS weight, array_to_string(path, '-') AS path_text
FROM steps s JOIN e ON e.graph_id = s.graph_id AND e.src = path[i] AND e.dst = path[i + 1]""")
def tour_edges(spark, sf):
    t, edges, _ = greedy(spark, sf)
    return rounded(graph.tour_edges(graph.best_tours(t), edges, ["graph_id"]), ["weight"])


@query(f"""WITH RECURSIVE {BEST}, steps AS (SELECT graph_id, path, unnest(range(1, len(path))) AS i FROM best),
used AS (SELECT DISTINCT graph_id, path[i] AS src, path[i + 1] AS dst FROM steps)
SELECT e.graph_id, e.src, e.dst, {rs('e.weight')} AS weight, e.ord, u.src IS NOT NULL AS used FROM e LEFT JOIN used u
 ON u.graph_id = e.graph_id AND u.src = e.src AND u.dst = e.dst""")
def edge_report(spark, sf):
    t, edges, _ = greedy(spark, sf)
    return rounded(graph.edge_report(edges, graph.tour_edges(graph.best_tours(t), edges, ["graph_id"])), ["weight"])


# --- walks -------------------------------------------------------------------------------

# a walker on every place of every greedy path, the closing node left out; its name tells start and place apart
STANDING = """standing AS (SELECT t.graph_id, t.start, t.path, n, unnest(range(1, least(len(t.path), n) + 1)) AS place FROM tours t JOIN sizes USING (graph_id)),
walkers AS (SELECT graph_id, start * (n + 1) + place AS walker, start, place, path[place] AS node, path[1:place] AS path FROM standing)"""
PULL = "(SELECT w.graph_id, w.walker, e.dst, sum(0.1::DOUBLE * (1.0::DOUBLE / e.weight) ** 2) AS a FROM walkers w JOIN e ON e.graph_id = w.graph_id AND e.src = w.node WHERE NOT list_contains(w.path, e.dst) GROUP BY 1, 2, 3)"


def walkers(nodes):
    return nodes.select("graph_id", F.col("node").alias("walker"), "node", F.array("node").alias("path"))


def standing(t, nodes):
    """(graph_id, walker, start, place, node, path): a walker on every place of every greedy path `t`."""
    sizes = graph.node_counts(nodes)
    places = F.sequence(F.lit(1).cast("bigint"), F.least(F.size("path").cast("bigint"), F.col("n")))
    # a path that is empty has no place
    placed = t.join(sizes, "graph_id").where(F.size("path") > 0).withColumn("place", F.explode(places))
    at = F.col("place").cast("int")
    return cut(placed.select("graph_id", (F.col("start") * (F.col("n") + 1) + F.col("place")).alias("walker"), "start", "place",
                             F.element_at("path", at).alias("node"), F.slice("path", 1, at).alias("path")))


@query(f"""WITH RECURSIVE {GREEDY}, {STANDING}, p AS {PULL}
SELECT graph_id, walker, dst, {rs('a * 1e6')} AS attraction, {rs('a / sum(a) OVER (PARTITION BY graph_id, walker)')} AS share, start, place
FROM p JOIN walkers USING (graph_id, walker)""")
def transition_weights(spark, sf):
    t, edges, nodes = greedy(spark, sf)
    w = standing(t, nodes)
    out = tours.transition_weights(w, edges.withColumn("pheromone", F.lit(0.1)))
    out = out.join(w.select("graph_id", "walker", "start", "place"), ["graph_id", "walker"])
    return rounded(out.withColumn("attraction", F.col("attraction") * 1e6), ["attraction", "share"])


def race_sql(step: str) -> str:
    """Waiting time of a candidate `dst` with attraction `a`."""
    return f"-ln(1 - {uniform_sql('42', 'graph_id', 'walker', 'dst', '0', step)}) / a"


STEP = f"""p AS {PULL},
hit AS (SELECT graph_id, walker, arg_min(dst, {{'w': {race_sql('1')}, 'd': dst}}) AS next FROM p GROUP BY 1, 2)"""


@query(f"""WITH RECURSIVE {GREEDY}, {STANDING}, {STEP}
SELECT w.graph_id, w.walker, w.start, w.place, w.node, h.next FROM walkers w LEFT JOIN hit h ON h.graph_id = w.graph_id AND h.walker = w.walker""")
def walk_step(spark, sf):
    t, edges, nodes = greedy(spark, sf)
    out = tours.walk_step(standing(t, nodes), edges.withColumn("pheromone", F.lit(0.1)), tours.race_draw(42, 0, 1))
    return out.select("graph_id", "walker", "start", "place", "node", "next")


@query(f"""WITH RECURSIVE {GREEDY}, {STANDING}, {STEP},
t AS (SELECT graph_id, src, b.d AS dst FROM (SELECT graph_id, src, min({{'w': weight, 'h': {digest_sql(42, 'graph_id', 'src', 'dst', 'ord')}, 'd': dst}}) AS b FROM e GROUP BY 1, 2))
SELECT w.graph_id, w.walker, w.start, w.place, w.node, CASE WHEN t.dst IS NOT NULL AND NOT list_contains(w.path, t.dst) THEN t.dst ELSE h.next END AS next
FROM walkers w LEFT JOIN hit h ON h.graph_id = w.graph_id AND h.walker = w.walker LEFT JOIN t ON t.graph_id = w.graph_id AND t.src = w.node""")
def walk_step_template(spark, sf):
    t, edges, nodes = greedy(spark, sf)
    out = tours.walk_step(standing(t, nodes), edges.withColumn("pheromone", F.lit(0.1)), tours.race_draw(42, 0, 1),
                          template=graph.lightest_successor(edges))
    return out.select("graph_id", "walker", "start", "place", "node", "next")


@query(f"""WITH RECURSIVE {EDGES}, {NODES},
walk AS (SELECT graph_id, node AS walker, node, [node] AS path, 0 AS step FROM nodes
 UNION ALL SELECT graph_id, walker, next, list_append(path, next), step + 1 FROM
 (SELECT graph_id, walker, path, step, arg_min(dst, {{'w': {race_sql('step + 1')}, 'd': dst}}) AS next FROM
  (SELECT w.graph_id, w.walker, w.path, w.step, e.dst, sum(0.1::DOUBLE * (1.0::DOUBLE / e.weight) ** 2) AS a
   FROM walk w JOIN e ON e.graph_id = w.graph_id AND e.src = w.node WHERE NOT list_contains(w.path, e.dst) GROUP BY ALL) GROUP BY 1, 2, 3, 4)),
ended AS (SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY graph_id, walker ORDER BY step DESC) = 1)
SELECT graph_id, walker, array_to_string(path, '-') AS path_text, len(path) = n AS complete FROM ended JOIN sizes USING (graph_id)""")
def whole_walks(spark, sf):
    """Every walker from its first node to the end of its walk."""
    edges, nodes = trade(spark, sf)
    state = cut(walkers(nodes))
    e = cut(edges.withColumn("pheromone", F.lit(0.1)))
    sizes = graph.node_counts(nodes)
    for step in range(1, sizes.agg(F.max("n")).first()[0]):
        moved = tours.walk_step(state, e, tours.race_draw(42, 0, step))
        state = moved.select("graph_id", "walker", F.coalesce("next", "node").alias("node"),
                             F.when(F.col("next").isNotNull(), F.array_append("path", F.col("next"))).otherwise(F.col("path")).alias("path"))
        state = cut(state)  # read twice by the next step
    return state.join(sizes, "graph_id").select("graph_id", "walker", graph.path_text("path").alias("path_text"), (F.size("path") == F.col("n")).alias("complete"))


@query(f"""WITH RECURSIVE {GREEDY}, steps AS (SELECT graph_id, path, length, unnest(range(1, len(path))) AS i FROM tours WHERE status = 'ok'),
gain AS (SELECT graph_id, path[i] AS src, path[i + 1] AS dst, sum(100.0::DOUBLE / length) AS g FROM steps GROUP BY 1, 2, 3)
SELECT e.graph_id, e.src, e.dst, {rs('0.1::DOUBLE * 0.9 + coalesce(g, 0)', 9)} AS pheromone FROM e LEFT JOIN gain USING (graph_id, src, dst)""")
def pheromone_round(spark, sf):
    t, edges, _ = greedy(spark, sf)
    out = tours.reinforce(edges.withColumn("pheromone", F.lit(0.1)), t.where("status = 'ok'"))
    return rounded(out.select("graph_id", "src", "dst", "pheromone"), ["pheromone"], 9)


# --- 2-opt and annealing -----------------------------------------------------------------

def move_sql(seed: str, *keys: str) -> str:
    """CTE columns i, k of the hashed move over a list `path`."""
    u = uniform_sql(f"{seed}/move", *keys)
    m = "(len(path) - 2)"
    num = f"floor({u} * ({m} * ({m} - 1)))::BIGINT"
    a, rest = f"({num} // ({m} - 1))", f"({num} % ({m} - 1))"
    b = f"({rest} + CASE WHEN {rest} >= {a} THEN 1 ELSE 0 END)"
    return f"least({a}, {b})::INTEGER + 1 AS i, greatest({a}, {b})::INTEGER + 1 AS k"


SWAPPED = "list_concat(list_concat(path[1:i], list_reverse(path[i + 1:k + 1])), path[k + 2:])"


@query(f"""WITH RECURSIVE {BEST}, f AS (SELECT graph_id, path, unnest(range(1, len(path) - 2))::INTEGER AS i FROM best),
m AS (SELECT graph_id, path, i, unnest(range(i + 1, len(path) - 1))::INTEGER AS k FROM f), q AS (SELECT graph_id, i, k, {SWAPPED} AS path FROM m),
steps AS (SELECT graph_id, i, k, path, unnest(range(1, len(path))) AS s FROM q),
sc AS (SELECT s.graph_id, i, k, sum(e.weight) AS length, count(*) AS c, any_value(len(path)) AS l FROM steps s JOIN e
 ON e.graph_id = s.graph_id AND e.src = path[s] AND e.dst = path[s + 1] GROUP BY 1, 2, 3),
b AS (SELECT graph_id, min({{'l': length, 'i': i, 'k': k}}) AS b FROM sc WHERE c = l - 1 GROUP BY 1)
SELECT graph_id, b.i AS i, b.k AS k, {rs('b.l')} AS length FROM b""")
def two_opt_best(spark, sf):
    t, edges, nodes = greedy(spark, sf)
    best = cut(graph.best_tours(t))
    return rounded(annealing.best_moves(best, edges, nodes, keys=["graph_id"]), ["length"])


RATES = (0.35, 0.95)


@query(f"""WITH RECURSIVE {BEST}, st AS (SELECT graph_id, r AS rate, f AS fast, path, length FROM best, (VALUES {", ".join(f"({v}::DOUBLE)" for v in RATES)}) a(r), (VALUES (false), (true)) b(f)),
mv AS (SELECT *, {move_sql('42', 'graph_id', '0', 'round(rate * 10000)::BIGINT', 'fast::INTEGER', '1')} FROM st),
q AS (SELECT graph_id, rate, fast, length, {SWAPPED} AS path FROM mv),
steps AS (SELECT *, unnest(range(1, len(path))) AS s FROM q),
sc AS (SELECT s.graph_id, rate, fast, any_value(length) AS old, sum(e.weight) AS new, count(*) AS c, any_value(len(path)) AS l FROM steps s JOIN e
 ON e.graph_id = s.graph_id AND e.src = path[s] AND e.dst = path[s + 1] GROUP BY 1, 2, 3),
ac AS (SELECT *, c = l - 1 AND (new < old OR {uniform_sql('42/accept', 'graph_id', '0', 'round(rate * 10000)::BIGINT', 'fast::INTEGER', '1')}
 < exp(least(0, -(new - old) / (100 * 1.1::DOUBLE)))) AS take FROM sc)
SELECT graph_id, rate, fast, {rs('CASE WHEN take THEN new ELSE old END')} AS length, {rs('CASE WHEN take AND new < old THEN new ELSE old END')} AS best_length,
{rs('CASE WHEN c = l - 1 THEN CASE WHEN fast THEN 50 ELSE 100 * rate END ELSE 100 END')} AS temp, 1 AS rounds FROM ac""")
def anneal_round(spark, sf):
    t, edges, nodes = greedy(spark, sf)
    state = annealing.chains(cut(graph.best_tours(t)), list(RATES), (False, True))
    out = annealing.anneal_round(state, edges, nodes)
    return rounded(out.select("graph_id", "rate", "fast", "length", "best_length", "temp", "rounds"), ["length", "best_length", "temp"])
