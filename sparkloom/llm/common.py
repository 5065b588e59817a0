"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.session import cut

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PACK_BYTES = 4 << 20


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes `df` to the shared folder and reads it back: lineage ends there and lost executors cost nothing."""
    return cut(df, name)


def with_ids(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """`doc_id`, `text` and the columns in `carry`; columns of other names, clashing ones included, play no part."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *carry)


def default_parallelism(spark: SparkSession) -> int:
    return max(2, spark.sparkContext.defaultParallelism)


#: What workers keep between the tasks of one operator, by operator.
KEPT: dict[str, dict] = {}


def hand_back(owner: str) -> None:
    """Drops what others than `owner` keep and gives unused memory of Arrow and of the C library back to the system."""
    for name, kept in KEPT.items():
        if name != owner:
            kept.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim is not None:
        trim(0)


def released(run, owner: str = ""):
    """A function over batches that hands unused memory back before and after, because workers live on for later stages.

    What other operators than `owner` keep between their tasks goes, too.
    """
    def wrapped(batches):
        hand_back(owner)
        yield from run(batches)
        hand_back(owner)
    return wrapped


# ---------------------------------------------------------------------------
# words as numbers
# ---------------------------------------------------------------------------

PIECE = 1 << 19
_SPACE = re.compile(r"[\x20\x09-\x0D]")
_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def pieces(text: str):
    """The text in pieces of about `PIECE` characters that end behind white space; no word is ever cut."""
    a = 0
    while len(text) - a > PIECE:
        space = _SPACE.search(text, a + PIECE - 1)
        if space is None:
            break
        yield text[a:space.end()]
        a = space.end()
    yield text[a:]


def run_hashes(points: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes, starts and ends of the maximal runs where `inside` holds; its first and last values are false."""
    n = len(points)
    with np.errstate(over="ignore"):
        if not _POWERS or len(_POWERS[0]) < n:
            _POWERS[:] = [np.cumprod(np.full(n, x, np.uint64)) for x in (_BASE, pow(_BASE, -1, 1 << 64))]
        up, down = _POWERS
        total = np.concatenate([[np.uint64(0)], np.cumsum(np.where(inside, points, np.uint64(0)) * up[:n], dtype=np.uint64)])
        begin = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
        end = np.flatnonzero(~inside[1:] & inside[:-1]) + 1
        return (total[end] - total[begin]) * down[begin], begin, end


# ---------------------------------------------------------------------------
# packs: rows that hold a few megabytes of documents
# ---------------------------------------------------------------------------

_PACK_SCHEMA = "pack_id long, n_bytes long, body binary"


def packs(docs: DataFrame, pack_bytes: int = PACK_BYTES, carry: Sequence[str] = ()) -> DataFrame:
    """Documents gathered into compressed rows of about `pack_bytes` of text, written once to the shared folder.

    Operators that ask hash shards about their content name a pack as the sender, so that a common key is asked once
    a pack instead of once a document.  A text longer than `pack_bytes` is a pack of its own.
    """
    def build(batches):
        base, seq = TaskContext.get().partitionId() << 32, 0
        held, size = [], 0
        for batch in batches:
            table = pa.table({"doc_id": batch.column("doc_id").cast(pa.int64()), "text": batch.column("text").cast(pa.large_string()),
                              **{c: batch.column(c) for c in carry}})
            lengths = np.asarray(pa.compute.binary_length(table["text"]).fill_null(0).combine_chunks(), dtype=np.int64)
            start = 0
            for i, length in enumerate(lengths.tolist()):
                size += length + 16
                if size >= pack_bytes:
                    held.append(table.slice(start, i + 1 - start))
                    yield _pack(base + seq, held)
                    held, size, start, seq = [], 0, i + 1, seq + 1
            if start < len(lengths):
                held.append(table.slice(start).take(pa.array(range(len(lengths) - start), pa.int64())))
        if held:
            yield _pack(base + seq, held)

    return staged(with_ids(docs, carry).mapInArrow(released(build), _PACK_SCHEMA), "packs")


def _pack(pack_id: int, tables: list[pa.Table]) -> pa.RecordBatch:
    table = pa.concat_tables(tables).combine_chunks()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    body = sink.getvalue().to_pybytes()
    n_bytes = int(pa.compute.sum(pa.compute.binary_length(table["text"])).as_py() or 0)
    return pa.RecordBatch.from_pydict({"pack_id": [pack_id], "n_bytes": [n_bytes], "body": pa.array([body], pa.binary())},
                                      schema=pa.schema([("pack_id", pa.int64()), ("n_bytes", pa.int64()), ("body", pa.binary())]))


def unpack(body) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(body)).read_all().combine_chunks()


def pack_bytes_of(table: pa.Table) -> tuple[list, np.ndarray, np.ndarray]:
    """doc_ids, all UTF-8 bytes in a row and the len + 1 bounds of the documents (null texts are empty)."""
    text = table["text"].fill_null("").combine_chunks()
    if isinstance(text, pa.ChunkedArray):
        text = text.chunk(0) if text.num_chunks else pa.array([], pa.large_string())
    n = len(text)
    bounds = np.frombuffer(text.buffers()[1], dtype=np.int64, count=n + 1 + text.offset)[text.offset:] if n else np.zeros(1, np.int64)
    raw = text.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return table["doc_id"].to_pylist(), data[bounds[0]:bounds[-1]], bounds - bounds[0]


def with_replies(packs_df: DataFrame, replies: DataFrame, name: str = "replies") -> DataFrame:
    """Every pack with the list of (bucket, reply...) structs that the shards sent back to it."""
    cols = [c for c in replies.columns if c != "pack_id"]
    gathered = replies.groupBy("pack_id").agg(F.collect_list(F.struct(*cols)).alias(name))
    return packs_df.join(gathered, "pack_id", "left")


# ---------------------------------------------------------------------------
# connected components
# ---------------------------------------------------------------------------


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node in `edges` (a long, b long); root is the smallest node that can be reached.

    Alternates large and small stars (Kiveris et al. 2014).  Neighbourhoods are never gathered: minima are partial
    aggregates and stars are made by joins, so a hub is spread over tasks.  Raises if `max_rounds` do not suffice.
    """
    e = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    before = _digest(e)
    for _ in range(max_rounds):
        sym = e.union(e.select("b", "a"))
        low = sym.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = sym.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a")
        small = moved.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        e = staged(small.where("a <> b").distinct(), "edges")
        after = _digest(e)
        if after == before:
            roots = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.union(e.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        before = after
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


SALTS = 16


def least_reached(classes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component_id) of the nodes in `links`: the smallest `least` of the classes (node, least) in their component.

    A component may hold most nodes, so each smallest value is sent `SALTS` times and the nodes are dealt over these.
    """
    linked = staged(components(links).join(classes, "node").select("node", "root", "least"), "linked")
    low = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    low = low.select("root", "component_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = linked.select("node", "root", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int").alias("salt"))
    return salted.join(low, ["root", "salt"]).select("node", "component_id")


def _digest(e: DataFrame) -> tuple:
    row = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)
