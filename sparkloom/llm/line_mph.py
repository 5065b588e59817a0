"""Line dedup by sharded minimal perfect hash functions.

The keys of all lines are hashed to 128 bits and dealt to shards.  A shard builds a minimal perfect hash over its distinct
line hashes and two arrays that it indexes: fingerprint, and number of documents with the smallest document id.  Documents
then probe the arrays: each pack of documents sends every distinct hash once and gets the slots of repeated lines back.
Lines themselves are never joined or shuffled.

Defined results: a null or empty text is one empty line; lines whose key has fewer than `min_chars` code points always
stay; equal lines inside one document alone stay; rows that share a doc_id are one document; rows without a doc_id keep
all lines and are no copy of others; a very long text or line is
read whole; of equal lines the smallest doc_id keeps its own; an empty table gives no rows; columns to carry along must not be
named like results, and all others, of whatever name, play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sparkloom.llm import common

STRIP = b" \t\n\x0b\x0c\r"
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))  # A-Z alone; UTF-8 stays valid
MIN_CHARS = 10
SHARD_KEYS = 250_000  # (pack, line) entries that a shard is planned for
GAMMA = 2.0


# ---------------------------------------------------------------------------
# minimal perfect hash: levels of bit arrays, slots numbered by rank
# ---------------------------------------------------------------------------

_M = np.uint64(0x9E3779B97F4A7C15)


def _mix(keys: np.ndarray, level: int) -> np.ndarray:
    """A 64-bit hash of both halves of the keys, another one on each level."""
    with np.errstate(over="ignore"):
        x = keys[:, 0] + keys[:, 1] * np.uint64(((level + 1) * 0xD1B54A32D192ED03 | 1) & 0xFFFFFFFFFFFFFFFF)
        x *= _M
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def build_mph(keys: np.ndarray) -> list[np.ndarray]:
    """Bit arrays (as bytes) of levels that together place every distinct 128-bit key, a row of two halves, alone."""
    levels = []
    while len(keys):
        size = max(64, int(len(keys) * GAMMA) // 8 * 8 + 8)
        at = (_mix(keys, len(levels)) % np.uint64(size)).astype(np.int64)
        hits = np.bincount(at, minlength=size)
        levels.append(np.packbits(hits == 1))
        keys = keys[hits[at] != 1]
    return levels


def mph_slots(levels: list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    """The slot 0..n-1 of each key; -1 for some keys that were not in the set."""
    slots = np.full(len(keys), -1, np.int64)
    left, before = np.arange(len(keys)), 0
    for i, packed in enumerate(levels):
        bits = np.unpackbits(packed)
        rank = np.cumsum(bits, dtype=np.int64)
        at = (_mix(keys[left], i) % np.uint64(len(bits))).astype(np.int64)
        found = bits[at] == 1
        slots[left[found]] = before + rank[at[found]] - 1
        left, before = left[~found], before + int(rank[-1])
    return slots


# ---------------------------------------------------------------------------
# documents' side
# ---------------------------------------------------------------------------


def _line_keys(raw: bytes, min_chars: int) -> list[bytes | None]:
    """Hash of each line's key; None for keys that are too short."""
    keys: list[bytes | None] = []
    for line in raw.translate(LOWER).split(b"\n"):
        key = line.strip(STRIP)
        n = len(key)  # a code point takes one to four bytes
        long = n >= 4 * min_chars or n >= min_chars and len(key.decode()) >= min_chars
        keys.append(xxhash.xxh3_128_digest(key) if long else None)
    return keys


def _documents(table: pa.Table, min_chars: int) -> list[tuple[int | None, bytes, list[bytes | None]]]:
    ids, data, bounds = common.pack_bytes_of(table)
    raw = data.tobytes()
    texts = [raw[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
    return [(i, t, _line_keys(t, min_chars)) for i, t in zip(ids, texts, strict=True)]


def _asked(docs: list, n_shards: int):
    """Distinct hashes of a pack in (shard, hash) order: hash halves, smallest and largest doc_id, shard."""
    span: dict[bytes, list[int]] = {}
    for doc_id, _, keys in docs:
        if doc_id is None:
            continue
        for key in keys:
            if key is None:
                continue
            seen = span.get(key)
            if seen is None:
                span[key] = [doc_id, doc_id]
            elif doc_id < seen[0]:
                seen[0] = doc_id
            elif doc_id > seen[1]:
                seen[1] = doc_id
    raw = np.frombuffer(b"".join(span), dtype="<u8").reshape(-1, 2)
    ids = np.array(list(span.values()), dtype=np.int64).reshape(-1, 2)
    shard = (raw[:, 0] >> np.uint64(20)) % np.uint64(n_shards)
    order = np.lexsort((raw[:, 1], raw[:, 0], shard))
    return raw[order], ids[order], shard[order].astype(np.int64)


_ASK = "shard int, pack_id long, hashes binary, ids binary"


def _ask(n_shards: int, min_chars: int):
    def run(batches):
        for batch in batches:
            for pack_id, body in zip(batch["pack_id"].to_pylist(), batch["body"], strict=True):
                hashes, ids, shard = _asked(_documents(common.unpack(body.as_buffer()), min_chars), n_shards)
                cuts = np.flatnonzero(np.diff(shard)) + 1
                groups = list(zip(np.r_[0, cuts], np.r_[cuts, len(shard)], strict=True)) if len(shard) else []
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([int(shard[a]) for a, _ in groups], pa.int32()),
                    "pack_id": pa.array([pack_id] * len(groups), pa.int64()),
                    "hashes": pa.array([hashes[a:b].tobytes() for a, b in groups], pa.binary()),
                    "ids": pa.array([ids[a:b].tobytes() for a, b in groups], pa.binary())})
    return run


# ---------------------------------------------------------------------------
# shards' side
# ---------------------------------------------------------------------------

_INDEX = "shard int, n_keys long, levels array<binary>, fingerprints binary, smallest binary, counts binary"


def _build(table: pa.Table) -> pa.Table:
    hashes = np.frombuffer(b"".join(table["hashes"].to_pylist()), dtype="<u8").reshape(-1, 2)
    ids = np.frombuffer(b"".join(table["ids"].to_pylist()), dtype="<i8").reshape(-1, 2)
    order = np.lexsort((hashes[:, 1], hashes[:, 0]))
    hashes, ids = hashes[order], ids[order]
    first = np.flatnonzero(np.r_[True, (hashes[1:] != hashes[:-1]).any(axis=1)])
    low, high = np.minimum.reduceat(ids[:, 0], first), np.maximum.reduceat(ids[:, 1], first)
    keys = hashes[first]
    levels = build_mph(keys)
    slots, n = mph_slots(levels, keys), len(keys)
    fingerprints, smallest, several = np.zeros(n, "<u8"), np.zeros(n, "<i8"), np.zeros(n, np.uint8)
    fingerprints[slots], smallest[slots] = keys[:, 1], low
    several[slots] = 1 + (high > low)
    return pa.table({"shard": pa.array([table["shard"][0].as_py()], pa.int32()), "n_keys": pa.array([n], pa.int64()),
                     "levels": pa.array([[x.tobytes() for x in levels]], pa.list_(pa.binary())),
                     "fingerprints": pa.array([fingerprints.tobytes()], pa.binary()),
                     "smallest": pa.array([smallest.tobytes()], pa.binary()),
                     "counts": pa.array([several.tobytes()], pa.binary())})


_REPLY = "pack_id long, shard int, places binary, owners binary"


def _probe(asked: pa.Table, index: pa.Table) -> pa.Table:
    row = index.slice(0, 1).to_pylist()[0]
    levels = [np.frombuffer(x, np.uint8) for x in row["levels"]]
    fingerprints, smallest = np.frombuffer(row["fingerprints"], "<u8"), np.frombuffer(row["smallest"], "<i8")
    counts = np.frombuffer(row["counts"], np.uint8)
    out: dict[str, list] = {"pack_id": [], "shard": [], "places": [], "owners": []}
    parts = [np.frombuffer(x, "<u8").reshape(-1, 2) for x in asked["hashes"].to_pylist()]
    hashes, ends = np.concatenate(parts), np.cumsum([len(x) for x in parts])
    slots = mph_slots(levels, hashes)
    held = (slots >= 0) & (fingerprints[slots] == hashes[:, 1]) & (counts[slots] >= 2)
    for pack_id, end, part in zip(asked["pack_id"].to_pylist(), ends, parts, strict=True):
        own = slice(end - len(part), end)
        places = np.flatnonzero(held[own])
        if len(places):
            out["pack_id"].append(pack_id)
            out["shard"].append(row["shard"])
            out["places"].append(places.astype("<u4").tobytes())
            out["owners"].append(smallest[slots[own][places]].astype("<i8").tobytes())
    return pa.table({"pack_id": pa.array(out["pack_id"], pa.int64()), "shard": pa.array(out["shard"], pa.int32()),
                     "places": pa.array(out["places"], pa.binary()), "owners": pa.array(out["owners"], pa.binary())})


# ---------------------------------------------------------------------------
# operator
# ---------------------------------------------------------------------------


def line_index(asked: DataFrame) -> DataFrame:
    """One row per shard: bit arrays of the minimal perfect hash and the arrays it indexes."""
    return asked.groupBy("shard").applyInArrow(_build, _INDEX)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, with_text: bool = True, carry: Sequence[str] = ()) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256, text, carry...): every document without the lines that a smaller doc_id owns."""
    spark = docs.sparkSession
    held = common.packs(docs, carry=carry)
    # lines are at least min_chars long, so text bytes bound the number of entries
    total = held.agg(F.sum("n_bytes")).first()[0] or 0
    n_shards = max(1, -(-total // (64 * SHARD_KEYS)), common.default_parallelism(spark) * 2)
    asked = common.staged(held.mapInArrow(common.released(_ask(n_shards, min_chars)), _ASK), "line-hashes")
    index = common.staged(line_index(asked), "line-index")
    replies = asked.select("shard", "pack_id", "hashes").groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(_probe, _REPLY)

    def finish(batches):
        for batch in batches:
            for body, replies in zip(batch["body"], batch["replies"].to_pylist(), strict=True):
                table = common.unpack(body.as_buffer())
                found = _documents(table, min_chars)
                out = _kept(found, _owners(found, replies or [], n_shards), with_text)
                yield from pa.Table.from_arrays([*out.columns, *(table[c] for c in carry)], [*out.schema.names, *carry]).to_batches()

    schema = StructType.fromDDL("doc_id long, n_lines long, n_dropped long, kept_sha256 string" + (", text string" if with_text else ""))
    for c in carry:
        schema.add(docs.schema[c])
    return common.with_replies(held, replies).mapInArrow(common.released(finish), schema)


def _owners(docs: list, replies: list, n_shards: int) -> dict[bytes, int]:
    """Smallest doc_id of each repeated line of a pack."""
    owner: dict[bytes, int] = {}
    if replies:
        hashes, _, shard = _asked(docs, n_shards)
    for r in replies:
        start = int(np.searchsorted(shard, r["shard"]))
        for place, doc_id in zip(np.frombuffer(r["places"], "<u4").tolist(), np.frombuffer(r["owners"], "<i8").tolist(), strict=True):
            owner[hashes[start + place].tobytes()] = doc_id
    return owner


def _kept(docs: list, owner: dict[bytes, int], with_text: bool) -> pa.RecordBatch:
    cols: dict[str, list] = {"doc_id": [], "n_lines": [], "n_dropped": [], "kept_sha256": [], "text": []}
    for doc_id, raw, keys in docs:
        kept, dropped = raw, 0
        if owner and doc_id is not None:
            stay = [k is None or owner.get(k, doc_id) == doc_id for k in keys]
            dropped = len(stay) - sum(stay)
            if dropped:
                kept = b"\n".join(line for line, ok in zip(raw.split(b"\n"), stay, strict=True) if ok)
        for name, v in zip(cols, (doc_id, len(keys), dropped, hashlib.sha256(kept).hexdigest(), kept), strict=True):
            cols[name].append(v)
    if not with_text:
        del cols["text"]
    types = {"doc_id": pa.int64(), "n_lines": pa.int64(), "n_dropped": pa.int64(), "kept_sha256": pa.string(), "text": pa.string()}
    return pa.RecordBatch.from_pydict({k: pa.array(v, pa.binary()).cast(types[k]) if k == "text" else pa.array(v, types[k])
                                       for k, v in cols.items()})
