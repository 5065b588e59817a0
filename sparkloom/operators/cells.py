"""A tree of cells over points: learned from bounded samples, exact in what it says of its cells.

Cells are numbered like a heap: the root is 1, the halves of v are 2v and 2v + 1.  Every round learns up to nine levels of
splits for each cell that is still too large, from a sample of that cell, and sorts its points into the new cells.  A poor
sample costs time and never exactness, because boxes are measured on all points of a cell.

The walk down the tree jumps `JUMP` levels at a time; `nodes` holds the cells at these levels and the leaves.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.operators.distances import BLOCK_ROWS, VECTOR, matrix, spread
from sparkloom.session import cut

LEVELS = 9  # of splits learned at once
SAMPLE_PER_CELL = 64
MAX_CELLS = 1 << 22  # splits go to all tasks, 12 bytes each; more points make larger cells
JUMP = 3
MAX_ROUNDS = 30


def learn(x: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """Splits of a complete tree in heap order: dimension (-1 where nothing can be split) and value; rows below it go left."""
    dims, values = np.full((1 << levels) - 1, -1, np.int32), np.zeros((1 << levels) - 1)
    held = {0: np.arange(len(x))}
    for at in range(len(dims)):
        rows = held.pop(at, None)
        if rows is None or len(rows) < 2:
            continue
        part = x[rows]
        width = part.max(axis=0) - part.min(axis=0)
        dim = int(width.argmax())
        if width[dim] <= 0:
            continue
        own = np.sort(part[:, dim])
        value = own[len(own) // 2]
        if value == own[0]:
            value = own[np.searchsorted(own, value, side="right")]
        dims[at], values[at] = dim, value
        left = part[:, dim] < value
        held[2 * at + 1], held[2 * at + 2] = rows[left], rows[~left]
    return dims, values


def descend(x: np.ndarray, cell: np.ndarray, splits: dict[int, tuple[np.ndarray, np.ndarray]], levels: int) -> np.ndarray:
    """The new cell of every point whose cell has splits."""
    out = cell.copy()
    for c in np.unique(cell):
        if int(c) not in splits:
            continue
        dims, values = splits[int(c)]
        rows = np.flatnonzero(cell == c)
        at = np.zeros(len(rows), np.int64)
        for _ in range(levels):
            dim = dims[at]
            at = 2 * at + 1 + ((dim >= 0) & (x[rows, np.maximum(dim, 0)] >= values[at]))
        out[rows] = (c << levels) + at - ((1 << levels) - 1)
    return out


def _study(levels: int):
    def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
        dims, values = learn(matrix(pdf), levels)
        return pd.DataFrame({"cell": [pdf["cell"].iloc[0]], "dims": [dims], "values": [values]})
    return kernel


def _assign(shared, levels: int):
    def run(batches):
        for pdf in batches:
            yield pdf.assign(cell=descend(matrix(pdf), pdf["cell"].to_numpy(), shared.value, levels)) if len(pdf) else pdf
    return run


def with_cells(points: DataFrame, n: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """points (row_id, features) with `cell`; leaves hold about `block_rows` points at most."""
    block_rows = max(block_rows, n // MAX_CELLS)
    spark = points.sparkSession
    placed = points.select("row_id", VECTOR, F.lit(1).cast("bigint").alias("cell"))
    schema = f"row_id bigint, {VECTOR} array<double>, cell bigint"
    largest = n
    for _ in range(MAX_ROUNDS):
        if largest <= block_rows:
            return placed
        levels = min(LEVELS, max(1, math.ceil(math.log2(largest / block_rows))))

        large = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block_rows).select("cell")
        first = Window.partitionBy("cell").orderBy(F.xxhash64("row_id"), "row_id")
        sample = placed.join(large, "cell").withColumn("_k", F.row_number().over(first)).where(F.col("_k") <= SAMPLE_PER_CELL << levels).drop("_k")
        found = sample.groupBy("cell").applyInPandas(_study(levels), "cell bigint, dims array<int>, values array<double>").collect()  # MAX_CELLS splits at most
        shared = spark.sparkContext.broadcast({r["cell"]: (np.array(r["dims"]), np.array(r["values"])) for r in found})
        placed = cut(placed.mapInPandas(_assign(shared, levels), schema))
        most = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
        if most >= largest:
            return placed
        largest = most
    return placed


# --- cells above the leaves --------------------------------------------------------------

def _depth(cell: Column) -> Column:
    return F.length(F.bin(cell)) - 1


def ancestors(cell: str | Column) -> Column:
    """The nodes of the walk that hold a leaf: those at every `JUMP`-th level, the root first, and the leaf itself."""
    c = F.col(cell) if isinstance(cell, str) else cell
    depth = _depth(c)
    above = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((depth - 1) / JUMP).cast("int")))
    return F.when(depth == 0, F.array(c)).otherwise(F.concat(
        F.transform(above, lambda m: F.floor(c / F.pow(F.lit(2.0), (depth - JUMP * m).cast("double"))).cast("bigint")), F.array(c)))


def parent(cell: str | Column) -> Column:
    """The node of the walk above a node; null for the root."""
    c = F.col(cell) if isinstance(cell, str) else cell
    depth = _depth(c)
    up = JUMP * F.floor((depth - 1) / JUMP)
    return F.when(depth > 0, F.floor(c / F.pow(F.lit(2.0), (depth - up).cast("double"))).cast("bigint"))


def fold_nodes(leaves: DataFrame, link) -> tuple[DataFrame, DataFrame]:
    """Nodes above leaves (cell, lo, hi, rep, features of rep), level by level, and the edges that `link` makes between children.

    `link(row ids, matrix)` gets the representatives of at most 2 ** JUMP children and returns a frame (i, j, d).
    """
    schema = f"cell bigint, lo array<double>, hi array<double>, rep bigint, {VECTOR} array<double>, i bigint, j bigint, d double"

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("cell")
        lo, hi = (np.array(pdf[c].tolist()) for c in ("lo", "hi"))
        edges = link(pdf["rep"].to_numpy(), matrix(pdf))
        node = pd.DataFrame({"cell": [pdf["up"].iloc[0]], "lo": [lo.min(axis=0)], "hi": [hi.max(axis=0)], "rep": [pdf["rep"].iloc[0]],
                             VECTOR: [pdf[VECTOR].iloc[0]], "i": pd.array([None], "Int64"), "j": pd.array([None], "Int64"), "d": [None]})
        made = pd.DataFrame({"cell": pd.array([None] * len(edges), "Int64"), "lo": None, "hi": None, "rep": pd.array([None] * len(edges), "Int64"),
                             VECTOR: None, "i": edges["i"], "j": edges["j"], "d": edges["d"]})
        return pd.concat([node, made], ignore_index=True).astype({"cell": "Int64", "rep": "Int64", "i": "Int64", "j": "Int64", "d": "float64"})

    leaves = leaves.select("cell", "lo", "hi", "rep", VECTOR, F.lit(True).alias("leaf"))
    nodes, edges = leaves, None
    deepest = leaves.agg(F.max(_depth(F.col("cell")))).first()[0] or 0
    for level in range((deepest - 1) // JUMP * JUMP if deepest else -1, -1, -JUMP):
        below = nodes.withColumn("up", parent("cell")).where(_depth(F.col("up")) == level)
        done = cut(spread(below.select("up", "cell", "lo", "hi", "rep", VECTOR), ["up"]).groupBy("up").applyInPandas(merge, schema))
        nodes = nodes.unionByName(done.where("cell IS NOT NULL").select("cell", "lo", "hi", "rep", VECTOR, F.lit(False).alias("leaf")))
        made = done.where("i IS NOT NULL").select("i", "j", "d")
        edges = made if edges is None else edges.unionByName(made)
    return nodes.select("cell", "lo", "hi", "leaf", parent("cell").alias("up")), edges


def gap(a_lo: Column, a_hi: Column, b_lo: Column, b_hi: Column, metric: str) -> Column:
    """Smallest distance between two boxes."""
    apart = F.zip_with(F.zip_with(a_lo, b_hi, lambda x, y: x - y), F.zip_with(b_lo, a_hi, lambda x, y: x - y),
                       lambda x, y: F.greatest(x, y, F.lit(0.0)))
    if metric == "chebyshev":
        return F.array_max(apart)
    total = F.aggregate(apart, F.lit(0.0), lambda acc, v: acc + v * v)
    return F.sqrt(total) if metric == "euclidean" else total


def near_leaves(nodes: DataFrame, state: DataFrame, metric: str) -> DataFrame:
    """Pairs of leaves (a, b, gap, ox, oy), a < b, that a walk from the root reaches; ox and oy are whom the leaves' points belong to.

    `state` has per node (cell, bound, low, high): the largest bound and the smallest and largest component of its points.  A pair
    of nodes is opened unless all their points are of one component or their boxes are farther apart than both bounds.
    """
    now = nodes.join(state, "cell").select(F.struct("cell", "lo", "hi", "leaf", "bound", "low", "high").alias("n"), "up")
    levels = (nodes.agg(F.max(_depth(F.col("cell")))).first()[0] + JUMP - 1) // JUMP
    kids = cut(now.groupBy("up").agg(F.collect_list("n").alias("kids")))  # 2 ** JUMP at most, one row for the root's own parent
    root = kids.where("up IS NULL").select(F.col("kids")[0].alias("a"), F.col("kids")[0].alias("b"))

    def opened(side: str) -> Column:
        return F.when(F.col(f"{side}.leaf"), F.array(side)).otherwise(F.col(f"{side}_kids"))

    pairs = root
    for _ in range(levels):
        below = pairs.join(kids.select(F.col("up").alias("ua"), F.col("kids").alias("a_kids")), F.col("a.cell") == F.col("ua"), "left") \
            .join(kids.select(F.col("up").alias("ub"), F.col("kids").alias("b_kids")), F.col("b.cell") == F.col("ub"), "left")
        pairs = (below.select("a", "b", F.explode(opened("a")).alias("x"), opened("b").alias("ys")).select("a", "b", "x", F.explode("ys").alias("y"))
                 .where((F.col("a.cell") != F.col("b.cell")) | (F.col("x.cell") <= F.col("y.cell")))
                 .where((F.least("x.low", "y.low") != F.greatest("x.high", "y.high")))
                 .where(gap(F.col("x.lo"), F.col("x.hi"), F.col("y.lo"), F.col("y.hi"), metric) * (1 - 1e-9) <= F.greatest("x.bound", "y.bound"))
                 .select(F.col("x").alias("a"), F.col("y").alias("b")))
    def owner(side: str) -> Column:  # the component of a leaf that has one, else the leaf
        return F.when(F.col(f"{side}.low") == F.col(f"{side}.high"), F.struct(F.lit(0).alias("kind"), F.col(f"{side}.low").alias("id"))) \
            .otherwise(F.struct(F.lit(1).alias("kind"), F.col(f"{side}.cell").alias("id")))

    apart = gap(F.col("a.lo"), F.col("a.hi"), F.col("b.lo"), F.col("b.hi"), metric)
    out = pairs.where("a.cell <> b.cell").select(F.col("a.cell").alias("x"), F.col("b.cell").alias("y"), apart.alias("gap"), owner("a").alias("ox"), owner("b").alias("oy"))
    return out.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "gap", "ox", "oy").dropDuplicates(["a", "b"])


def nearest(pairs: DataFrame) -> DataFrame:
    """Of the pairs of `near_leaves`, the one of the smallest gap for each component and each leaf with several."""
    ends = pairs.select("a", "b", "gap", F.explode(F.array("ox", "oy")).alias("o"))
    return ends.groupBy("o").agg(F.min(F.struct("gap", "a", "b")).alias("p")).select("p.a", "p.b").distinct()
