"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two 64-bit fingerprints that differ in at most three bits meet like this.  The bits form four blocks of 16.  One block is
set aside; on the other 48 bits every fingerprint emits its ball of half the remaining radius, itself and its 48 one-bit
variants.  If the block set aside differs in no or one bit, the rest differs in two at most, so both balls share a
variant; such a block always exists unless all three bits lie in one block, and then the other 48 bits are equal.
196 variants a fingerprint are shuffled instead of the 2081 of a whole ball of radius two.

Fingerprints are counted once, whatever the number of documents with them.  Members of a shared variant whose 16 set-aside
bits are equal all lie within two bits of each other, so they are chained; chains whose 16 bits differ in one bit are
within three, so one link joins them.  Links grow with the members, not with their pairs, and each is verified.

Defined results: null is the empty text; texts without words have fingerprint zero, which links like any other; rows that
share a doc_id are documents of their own with the same id; rows without a doc_id link, and a component of only such rows
has the null id; a very long text is
read whole, once; ties at half of the hashes leave a bit 0; an empty table gives no rows; other columns, of whatever name, play no
part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm import common

SEED = 42
SHINGLE = 3
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
RADIUS = 3
PART_VARIANTS = 250_000
_BLOCK = np.uint64(0xFFFF)
_EMITTED = 49


# ---------------------------------------------------------------------------
# fingerprints
# ---------------------------------------------------------------------------


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    words = [w.encode() for w in common.WORD.findall(text.translate(LOWER))]
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    k = min(shingle, len(words))
    starts = np.r_[0, ends[:-1] + 1][:len(words) - k + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[k - 1:].tolist(), strict=True)], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 4096):
        ones += np.unpackbits(hashes[i:i + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""
    def run(batches):
        for batch in batches:
            fp = np.array([fingerprint(t or "", shingle) for t in batch["text"].to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "fp": pa.array(fp.view(np.int64), pa.int64())})
    return common.with_ids(docs).mapInArrow(common.released(run), "doc_id long, fp long")


# ---------------------------------------------------------------------------
# balls
# ---------------------------------------------------------------------------


def _rotate(x: np.ndarray, by: int) -> np.ndarray:
    by %= 64
    return x if by == 0 else (x >> np.uint64(by)) | (x << np.uint64(64 - by))


def _variants(fp: np.ndarray, block: int) -> np.ndarray:
    """(n, 49) variants with the block set aside in the low 16 bits: the fingerprint itself and its 48 neighbours."""
    turned = _rotate(fp, 16 * block)[:, None]
    flips = np.r_[np.uint64(0), np.uint64(1) << np.arange(16, 64, dtype=np.uint64)]
    return turned ^ flips[None, :]


def _scatter(n_parts: int):
    def run(batches):
        for batch in batches:
            fps = batch["fp"].to_numpy().view(np.uint64)
            for a in range(0, len(fps), 4096):
                fp = fps[a:a + 4096]
                for block in range(4):
                    variant = _variants(fp, block).ravel()
                    with np.errstate(over="ignore"):
                        mixed = ((variant >> np.uint64(16)) + np.uint64(block)) * np.uint64(0x9E3779B97F4A7C15)
                    part = ((mixed >> np.uint64(33)) % np.uint64(n_parts)).astype(np.int64)
                    order = np.argsort(part, kind="stable")
                    cuts = np.r_[0, np.flatnonzero(np.diff(part[order])) + 1, len(order)]
                    owner = (order // _EMITTED).astype("<u4")
                    place = (order % _EMITTED).astype(np.uint8)
                    spans = list(zip(cuts[:-1], cuts[1:], strict=True))
                    yield pa.RecordBatch.from_pydict({
                        "part": pa.array([int(part[order[x]]) for x, _ in spans], pa.int32()),
                        "block": pa.array([block] * len(spans), pa.int32()),
                        "fps": pa.array([fp[owner[x:y]].tobytes() for x, y in spans], pa.binary()),
                        "flips": pa.array([place[x:y].tobytes() for x, y in spans], pa.binary())})
    return run


def _links_of(fp: np.ndarray, flip: np.ndarray, block: int) -> list[np.ndarray]:
    """Pairs of fingerprints linked through the variants of one block, as (n, 2) arrays."""
    flips = np.r_[np.uint64(0), np.uint64(1) << np.arange(16, 64, dtype=np.uint64)]
    key = _rotate(fp, 16 * block) ^ flips[flip]
    head = key >> np.uint64(16)
    order = np.argsort(key)
    key, fp, head, own = key[order], fp[order], head[order], flip[order] == 0
    several = np.zeros(len(key), bool)  # heads with more than one member
    same = head[1:] == head[:-1]
    several[1:] |= same
    several[:-1] |= same
    key, fp, own = key[several], fp[several], own[several]
    if not len(key):
        return []
    chain = key[1:] == key[:-1]
    out = [np.stack([fp[:-1][chain], fp[1:][chain]], axis=1)]
    first = np.flatnonzero(np.r_[True, ~chain])
    cells = key[first]
    out += _lookups(cells, fp[first], [1 << i for i in range(16)])
    # all three bits in the block set aside: the rest is equal, so only fingerprints that are their own variant count
    mine, named = key[own], fp[own]
    alone = np.zeros(len(mine), bool)
    same = (mine[1:] >> np.uint64(16)) == (mine[:-1] >> np.uint64(16))
    alone[1:] |= same
    alone[:-1] |= same
    out += _lookups(mine[alone], named[alone], [1 << i | 1 << j | 1 << k for i in range(16) for j in range(i) for k in range(j)])
    return out


def _lookups(cells: np.ndarray, named: np.ndarray, masks: list[int]) -> list[np.ndarray]:
    """Links between sorted distinct cells that differ by one of the masks."""
    if len(cells) < 2:
        return []
    out = []
    for m in masks:
        wanted = cells ^ np.uint64(m)
        at = np.minimum(np.searchsorted(cells, wanted), len(cells) - 1)
        hit = (cells[at] == wanted) & (wanted > cells)
        if hit.any():
            out.append(np.stack([named[hit], named[at[hit]]], axis=1))
    return out


def _meet(table: pa.Table) -> pa.Table:
    block = np.array(table["block"].to_pylist())
    found = []
    fps, flips = table["fps"].to_pylist(), table["flips"].to_pylist()
    for b in range(4):
        rows = np.flatnonzero(block == b)
        if len(rows):
            found += _links_of(np.concatenate([np.frombuffer(fps[i], "<u8") for i in rows]),
                               np.concatenate([np.frombuffer(flips[i], np.uint8) for i in rows]), b)
    pairs = np.concatenate(found) if found else np.zeros((0, 2), np.uint64)
    near = np.bitwise_count(pairs[:, 0] ^ pairs[:, 1]) <= RADIUS
    pairs = np.sort(pairs[near].view(np.int64), axis=1)
    pairs = np.unique(pairs, axis=0) if len(pairs) else pairs
    return pa.table({"a": pa.array(pairs[:, 0], pa.int64()), "b": pa.array(pairs[:, 1], pa.int64())})


def links(distinct: DataFrame, part_variants: int = PART_VARIANTS) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp) that join everything within three bits; not all pairs."""
    n = distinct.count()
    n_parts = max(1, -(-n * 4 * _EMITTED // part_variants))
    spread = distinct.select("fp").repartition(max(common.default_parallelism(distinct.sparkSession), n // 100_000), "fp")
    sent = spread.mapInArrow(_scatter(n_parts), "part int, block int, fps binary, flips binary")
    return sent.groupBy("part").applyInArrow(_meet, "a long, b long").distinct()


# ---------------------------------------------------------------------------
# operator
# ---------------------------------------------------------------------------


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, part_variants: int = PART_VARIANTS) -> DataFrame:
    """(doc_id, fingerprint, component_id, class_size): class_size counts the documents with the same fingerprint."""
    printed = common.staged(fingerprints(docs, shingle), "fingerprints")
    distinct = common.staged(printed.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("class_size")), "distinct")
    reached = common.least_reached(distinct.select(F.col("fp").alias("node"), "least"), links(distinct, part_variants))
    classes = (distinct.join(reached, F.col("fp") == F.col("node"), "left")
               .select("fp", "class_size", F.coalesce("component_id", "least").alias("component_id")))
    return printed.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "class_size")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One document of each component, that with the smallest doc_id, with all columns; rows without a doc_id stay."""
    found = near_duplicates(docs, shingle)
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
