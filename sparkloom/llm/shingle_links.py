"""Near duplicates by the Jaccard similarity of their word shingles, for the pipeline.

A text is the set of its five-word shingles (small ASCII letters; a shorter text is one shingle, a text without words the
empty set).  Texts with equal sets are one class.  Two classes link if their sets share four fifths of their union; links
are decided on the sets themselves, never on a sketch.

Candidates come from min-wise hashes: 20 bands of 4.  Two sets with Jaccard 0.8 share a band with probability 0.99997.  Balls
of three bits around a 64-bit SimHash reach one such pair in a hundred, so some 500 prints of 196 variants would be needed.

Pairs of a band's bucket are not expanded.  A first round verifies each member against the bucket's first and the member
before it, by set size, and forms components.  Buckets that then hold several components are settled whole, each in one task,
where the distances of all members come from one product of their 0/1 rows; what leaves the task is a spanning forest.

A bucket of more than `GROUP` members is divided first.  Its core is the shingles that more than half of the members have; a
member is then the set D of its differences from the core, and two members differ by as much as their D do.  Two texts link if
they differ in at most a ninth of their sizes' sum, so with excess = |D| - size / 9 two members whose excesses add up to no more
than 0 link whatever they share: all those link to the member of the smallest excess, and no pair is formed.  Any other linked
pair shares so many differences that both have one of them among their rarest ones (a prefix filter).  So members meet again in
one group per such difference, which at most half of the members have, until groups are small.  No link is lost, nothing is
capped.

Defined results: null is the empty text; rows that share a doc_id are documents of their own with the same id; rows without
a doc_id link and stay; a very long text is one set, held whole by the tasks that compare it; ties of set sizes go by hash; an
empty table gives no rows; other columns, of whatever name, play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm import common
from sparkloom.llm.simhash_ball import LOWER

SHINGLE = 5
SIMILAR = (4, 5)  # shared shingles of those in either set
BANDS, ROWS = 20, 4
GROUP, GROUP_ENTRIES = 1_000, 1_000_000  # members and shingles that a task settles at once
PART_ENTRIES = 100_000
_NO_ID = -(1 << 63)
_ODD = np.random.default_rng(23).integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_XOR = np.random.default_rng(24).integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text."""
    parts = []
    for piece in common.pieces(text):
        points = np.frombuffer((" " + piece.translate(LOWER) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
        parts.append(common.run_hashes(points.astype(np.uint64), (points != 32) & ((points < 9) | (points > 13)))[0])
    w = np.concatenate(parts)
    if not len(w):
        return w
    k = min(size, len(w))
    with np.errstate(over="ignore"):
        w = _mix(w)
        h = np.full(len(w) - k + 1, np.uint64(k))
        for i in range(k):
            h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + w[i:i + len(h)])
    return np.unique(h)


def bands(s: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of a set that is not empty."""
    least = np.full(len(_ODD), np.uint64(0xFFFFFFFFFFFFFFFF))
    with np.errstate(over="ignore"):
        for a in range(0, len(s), 1024):
            least = np.minimum(least, ((s[a:a + 1024, None] ^ _XOR) * _ODD).min(axis=0))
        least = _mix(least).reshape(BANDS, ROWS)
        key = np.arange(BANDS, dtype=np.uint64)
        for i in range(ROWS):
            key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + least[:, i])
    return key.view(np.int64)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets reach the similarity."""
    both = len(a) + len(b) - len(np.union1d(a, b))
    return both * SIMILAR[1] >= (len(a) + len(b) - both) * SIMILAR[0]


def _node(s: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).view(np.int64))


def _slices(batches, rows: int = 500):
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows)


def _printed(batches):
    for batch in _slices(batches):
        sets = [shingles(t or "") for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch["doc_id"], "node": pa.array([_node(s) for s in sets], pa.int64()),
            "size": pa.array([len(s) for s in sets], pa.int32()),
            "keys": pa.array([bands(s).tobytes() if len(s) else b"" for s in sets], pa.binary())})


def _banded(batches):
    for batch in batches:
        keys = np.frombuffer(b"".join(batch["keys"].to_pylist()), np.int64)
        yield pa.RecordBatch.from_pydict({
            "key": pa.array(keys, pa.int64()),
            "node": pa.array(np.repeat(batch["node"].to_numpy(), BANDS), pa.int64()),
            "size": pa.array(np.repeat(batch["size"].to_numpy(), BANDS), pa.int32())})


def _sets(batches):
    for batch in _slices(batches):
        sets = [shingles(t or "") for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_pydict({"node": pa.array([_node(s) for s in sets], pa.int64()),
                                          "shingles": pa.array([s.tobytes() for s in sets], pa.binary())})


def _table(a: list, b: list) -> pa.Table:
    pairs = np.stack([np.concatenate([np.zeros(0, np.int64), *a]), np.concatenate([np.zeros(0, np.int64), *b])], axis=1)
    pairs = np.unique(np.sort(pairs, axis=1), axis=0)
    return pa.table({"a": pa.array(pairs[:, 0], pa.int64()), "b": pa.array(pairs[:, 1], pa.int64())})


def _near_size(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.minimum(x, y).astype(np.int64) * SIMILAR[1] >= np.maximum(x, y).astype(np.int64) * SIMILAR[0]


def _stars(table: pa.Table) -> pa.Table:
    """Each member with the first of its bucket and with the member before it, in the order of set sizes."""
    key, size, node = (table[c].to_numpy() for c in ("key", "size", "node"))
    order = np.lexsort((node, size, key))
    key, size, node = key[order], size[order], node[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    lead = np.repeat(first, np.diff(np.r_[first, len(key)]))
    at = np.arange(len(key))
    a, b = [], []
    for other in (lead, np.maximum(at - 1, lead)):
        hit = (other < at) & _near_size(size, size[other])
        a.append(node[hit])
        b.append(node[other[hit]])
    return _table(a, b)


def _verified(batches):
    for batch in _slices(batches):
        left, right = ([np.frombuffer(s, np.uint64) for s in batch[c].to_pylist()] for c in ("left", "right"))
        yield batch.select(["a", "b"]).filter(pa.array([similar(x, y) for x, y in zip(left, right, strict=True)], pa.bool_()))


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(common.released(_verified), "a long, b long")


# ---------------------------------------------------------------------------
# groups of several components
# ---------------------------------------------------------------------------

#: `els` are the shingles of a member or its differences from a core, 64-bit numbers in a row; `size` counts its shingles.
_GROUPS = "gid long, node long, root long, size int, els binary"


def forest(sets: list[np.ndarray], size: np.ndarray, root: np.ndarray) -> list[tuple[int, int]]:
    """Links of members of different components that connect all that similar members connect."""
    el, at, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    own = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    k = len(sets)
    alone = np.bincount(own[n[at] == 1], minlength=k)  # shingles of one member count for it, those of all members for nobody
    places = np.full(len(el), -1)
    shared = np.flatnonzero((n > 1) & (n < k))
    places[shared] = np.arange(len(shared))
    place = places[at]
    both = np.zeros((k, k), np.float32)  # exact below 2 ** 24
    for a in range(0, len(shared), 1024):
        here = (place >= a) & (place < a + 1024)
        rows = np.zeros((k, min(1024, len(shared) - a)), np.float32)
        rows[own[here], place[here] - a] = 1
        both += rows @ rows.T
    total = np.bincount(own[place >= 0], minlength=k) + alone
    label, links = np.unique(root, return_inverse=True)[1], []
    for i in range(k):
        near = 9 * (total[i] + total - 2 * both[i].astype(np.int64)) <= size[i] + size
        near[i] = False
        while len(other := np.flatnonzero(near & (label != label[i]))):
            links.append((i, int(other[0])))
            label[label == label[other[0]]] = label[i]
    return links


def _forests(table: pa.Table) -> pa.Table:
    table = table.sort_by([("gid", "ascending"), ("node", "ascending")])
    gid, node, root, size = (table[c].to_numpy().astype(np.int64) for c in ("gid", "node", "root", "size"))
    els = table["els"].combine_chunks()
    cuts = np.flatnonzero(np.r_[True, gid[1:] != gid[:-1], True])
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for x, y in zip(cuts[:-1], cuts[1:], strict=True):
        sets = [np.frombuffer(els[i].as_buffer(), np.uint64) for i in range(x, y)]
        links = np.array(forest(sets, size[x:y], root[x:y]), np.int64).reshape(-1, 2)
        a.append(node[x:y][links[:, 0]])
        b.append(node[x:y][links[:, 1]])
    return _table(a, b)


def _elements(batches):
    """(gid, el, n): members that have an element, summed per batch."""
    for batch in batches:
        gid = batch["gid"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in batch["els"].to_pylist()]
        for g in np.unique(gid):
            el, n = np.unique(np.concatenate([sets[i] for i in np.flatnonzero(gid == g)]), return_counts=True)
            yield pa.RecordBatch.from_pydict({"gid": pa.array([g] * len(el), pa.int64()), "el": pa.array(el.view(np.int64)), "n": pa.array(n, pa.int64())})


def _differences(batches):
    for batch in batches:
        cores: dict[int, np.ndarray] = {}
        sets = []
        for i, (gid, x) in enumerate(zip(batch["gid"].to_pylist(), batch["els"].to_pylist(), strict=True)):
            if gid not in cores:
                cores[gid] = np.sort(np.array(batch["core"][i].as_py() or (), np.int64).view(np.uint64))
            sets.append(np.setxor1d(np.frombuffer(x, np.uint64), cores[gid], assume_unique=True))
        excess = [9 * len(s) - n for s, n in zip(sets, batch["size"].to_pylist(), strict=True)]
        yield pa.RecordBatch.from_pydict({**{c: batch[c] for c in ("gid", "node", "root", "size")},
                                          "els": pa.array([s.tobytes() for s in sets], pa.binary()), "excess": pa.array(excess, pa.int64())})


def _spread(batches):
    """(gid, node, keep, el): all differences of a member; among the `keep` rarest is one that any linked member shares."""
    for batch in batches:
        for gid, node, els, excess, low in zip(*(batch[c].to_pylist() for c in ("gid", "node", "els", "excess", "low")), strict=True):
            el = np.frombuffer(els, np.int64)
            keep = len(el) - max(1, -(-(excess + low) // 18)) + 1
            if keep > 0:
                yield pa.RecordBatch.from_pydict({"gid": pa.array([gid] * len(el), pa.int64()), "node": pa.array([node] * len(el), pa.int64()),
                                                  "keep": pa.array([keep] * len(el), pa.int32()), "el": pa.array(el)})


def divide(groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) of large groups that need no shared difference, and the smaller groups (gid, node, size, els) for all others."""
    members = groups.groupBy("gid").agg(F.count("*").alias("k"))
    counts = groups.mapInArrow(_elements, "gid long, el long, n long").groupBy("gid", "el").agg(F.sum("n").alias("n"))
    counts = common.staged(counts.join(members, "gid").select("gid", "el", (2 * F.col("n") > F.col("k")).alias("core"),
                                                              F.least("n", F.col("k") - F.col("n")).alias("f")), "elements")
    cores = counts.where("core").groupBy("gid").agg(F.collect_list("el").alias("core"))
    diffs = common.staged(groups.join(cores, "gid", "left").mapInArrow(_differences, _GROUPS + ", excess long"), "differences")
    least = diffs.groupBy("gid").agg(F.min(F.struct("excess", "node")).alias("least"))
    placed = diffs.join(least, "gid").withColumn("low", F.col("least.excess"))
    links = placed.where("excess + low <= 0 AND node <> least.node").select(F.least("node", "least.node").alias("a"), F.greatest("node", "least.node").alias("b"))
    spread = placed.select("gid", "node", "els", "excess", "low").mapInArrow(_spread, "gid long, node long, keep int, el long")
    rarest = (spread.join(counts.select("gid", "el", "f"), ["gid", "el"]).groupBy("gid", "node", "keep")
              .agg(F.array_sort(F.collect_list(F.struct("f", "el"))).alias("found"))
              .select("gid", "node", F.explode(F.slice("found", F.lit(1), F.col("keep"))).alias("x")).where("x.f > 1"))
    meet = rarest.join(diffs.select("gid", "node", "size", "els"), ["gid", "node"])
    return links.distinct(), meet.select(F.xxhash64("gid", "x.el").alias("gid"), "node", "size", "els")


def _open(groups: DataFrame, links: DataFrame) -> DataFrame:
    """Groups whose members lie in several components of `links`, each membership once."""
    roots = common.components(links)
    rooted = groups.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    print_ = F.struct(F.count("*"), F.sum(F.xxhash64("node").cast("decimal(38,0)")), F.bit_xor(F.xxhash64(F.lit(1), "node"))).alias("members")
    several = rooted.groupBy("gid").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), print_).where("lo <> hi")
    once = several.groupBy("members").agg(F.min("gid").alias("gid")).select("gid")
    return rooted.join(once, "gid")


def settle(groups: DataFrame, links: DataFrame, members: int = GROUP, entries: int = GROUP_ENTRIES) -> DataFrame:
    """All links (a, b) that components need: `links`, and what groups (gid, node, root, size, els) of several components add."""
    spark = groups.sparkSession
    while True:
        sizes = common.staged(groups.groupBy("gid").agg(F.count("*").alias("k"), F.sum(F.length("els") / 8).cast("long").alias("total"))
                              .withColumn("large", (F.col("k") > members) | (F.col("total") > entries) & (F.col("k") > 16)), "sizes")
        small = sizes.where("NOT large").agg(F.sum("total")).first()[0] or 0
        n_parts = max(common.default_parallelism(spark), -(-int(small) // entries))
        sized = groups.join(sizes, "gid")
        links = links.union(common.staged(sized.where("NOT large").withColumn("part", F.pmod("gid", F.lit(n_parts)))
                                          .groupBy("part").applyInArrow(_forests, "a long, b long"), "links"))
        large = sized.where("large").select("gid", "node", "root", "size", "els")
        if sizes.where("large").isEmpty():
            return links
        found, smaller = divide(common.staged(large, "large"))
        links = links.union(common.staged(found, "links"))
        groups = common.staged(_open(common.staged(smaller, "groups"), links).select("gid", "node", "root", "size", "els"), "groups")


# ---------------------------------------------------------------------------
# operator
# ---------------------------------------------------------------------------


def _proposed(found: DataFrame, printed: DataFrame) -> DataFrame:
    """Different sets (a, b) of the documents that `found` (doc_id, component_id) puts together, one of each doc_id."""
    own = printed.where("size > 0").groupBy("doc_id").agg(F.min("node").alias("node"))
    pairs = found.where("doc_id <> component_id").select("doc_id", "component_id").join(own, "doc_id").select("component_id", F.col("node").alias("x"))
    met = pairs.join(own.select(F.col("doc_id").alias("component_id"), F.col("node").alias("y")), "component_id").where("x <> y")
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _grouped(found: DataFrame, printed: DataFrame) -> DataFrame:
    """(key, node, size): the different sets of each group of `found`, as members of a bucket like those of the bands."""
    own = printed.where("size > 0").select("doc_id", "node", "size").distinct()
    met = found.select("doc_id", F.xxhash64(F.lit("group"), "component_id").alias("key")).distinct().join(own, "doc_id")
    return met.select("key", "node", "size").distinct()


def near_duplicates(docs: DataFrame, part_entries: int = PART_ENTRIES, members: int = GROUP, proposed: DataFrame | None = None) -> DataFrame:
    """(doc_id, component_id): the smallest doc_id that verified links reach.

    `proposed` (doc_id, component_id) are groups of another search, such as SimHash balls: each member is verified against the
    first of its group, and a group whose members then lie in several components is settled whole like a bucket of the bands, so
    that no two similar members stay apart.  The bands find what no group holds, and rows without a doc_id.
    """
    spark, source = docs.sparkSession, common.with_ids(docs)
    printed = common.staged(source.mapInArrow(common.released(_printed), "doc_id long, node long, size int, keys binary"), "printed")
    classes = printed.groupBy("node").agg(F.min("doc_id").alias("least"))
    n_parts = max(common.default_parallelism(spark), -(-printed.count() * BANDS // part_entries))
    entries = printed.where("size > 0").dropDuplicates(["node"]).mapInArrow(_banded, "key long, node long, size int")
    if proposed is not None:
        entries = entries.union(common.staged(_grouped(proposed, printed), "grouped"))
    shared = entries.groupBy("key").count().where("count > 1").select("key")
    entries = common.staged(entries.join(shared, "key").withColumn("part", F.pmod("key", F.lit(n_parts))), "buckets")
    # only texts of shared buckets are cut into shingles again, one text for each set
    held = entries.select("node")
    first = entries.groupBy("part").applyInArrow(_stars, "a long, b long")
    if proposed is not None:
        told = common.staged(_proposed(proposed, printed), "proposed")
        held = held.union(told.select("a")).union(told.select("b"))
        first = first.union(told)
    held = held.distinct().join(classes, "node").select(F.coalesce("least", F.lit(_NO_ID)).alias("at")).distinct()
    texts = source.withColumn("at", F.coalesce("doc_id", F.lit(_NO_ID))).join(held, "at", "left_semi")
    sets = common.staged(texts.select("text").mapInArrow(common.released(_sets), "node long, shingles binary").dropDuplicates(["node"]), "sets")
    first = common.staged(_verify(first.distinct(), sets), "links")
    several = common.staged(_open(entries.select(F.col("key").alias("gid"), "node", "size"), first), "several")
    groups = common.staged(several.join(sets, "node").select("gid", "node", "root", "size", F.col("shingles").alias("els")), "groups")
    reached = common.least_reached(classes, settle(groups, first, members))
    named = classes.join(reached, "node", "left").select("node", F.coalesce("component_id", "least").alias("component_id"))
    return printed.select("doc_id", "node").join(named, "node").select("doc_id", "component_id")


def drop_near_duplicates(docs: DataFrame, proposed: DataFrame | None = None) -> DataFrame:
    """One document of each component, that with the smallest doc_id, with all columns; rows without a doc_id stay."""
    gone = near_duplicates(docs, proposed=proposed).where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
