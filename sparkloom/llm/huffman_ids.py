"""Token ids in files of canonical, length-limited Huffman codes.

Ids are counted over the whole corpus, code lengths come from package-merge with a limit of 16 bits (more for more than 65,536
different ids), and codes are canonical, so a file needs the lengths only.  Documents are written in ascending doc_id order into blocks.  A block is
readable alone: header, document ids and lengths, the bit offset of every 256th id, and the bits.  Decoding looks 16 bits
up in one table, and longer codes among the ordered ones; the checkpoints let all stretches of a block be decoded side by side.

Files: Parquet with one row per block (`part`, `block`, `first_id` inside the part, `n_ids`, `data`) under `blocks`, and
the code lengths under `codebook`.  Any store that Spark writes will do.

Defined results: null is the empty text, which has the end id alone; rows that share a doc_id are kept apart, side by
side; rows without a doc_id come first; a very long text is one entry of a block of its own size; ids that are equally frequent get
codes in their order; an empty table has no blocks; other columns, of whatever name, play no part.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm import common

MAX_BITS = 16
CHECKPOINT = 256
BLOCK_IDS = 1 << 18
CACHE_PIECES = 400_000
_HEAD = struct.Struct("<4sHHIQI")
_MAGIC = b"SLHC"
_NO_ID = np.iinfo(np.int64).min


# ---------------------------------------------------------------------------
# tokens
# ---------------------------------------------------------------------------


class WordEncoder:
    """Encodes texts with a byte-level tokenizer that drops white space, remembering recent pieces.

    Texts in the plain alphabet (printable ASCII, line breaks, tabs, Latin-1 letters) are put into small letters and split
    like the tokenizer splits them; the tokenizer's model encodes each piece it has not seen lately.  Any other text, and
    one that may hold a special token, goes through the tokenizer whole.  Both give the same ids.  Two generations of
    remembered pieces bound the memory.
    """

    _HELD: dict[str, WordEncoder] = {}
    #: The pre-tokenizer's pattern over small letters of the plain alphabet.
    _PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\s a-zß-öø-ÿ0-9]+")
    _PLAIN = re.compile(r"[ -~\n\t\rÀ-ÖØ-öø-ÿ]*")

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.wide = self.tokenizer.get_vocab_size(with_added_tokens=True) > 1 << 16
        self.type = "<u4" if self.wide else "<u2"
        split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # the visible character that stands for each byte of the plain alphabet
        self.visible = {}
        for c in map(chr, range(32, 256)):
            for byte, shown in zip(c.encode(), split.pre_tokenize_str(c)[0][0], strict=True):
                self.visible[byte] = shown
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        """One per worker process, so later tasks find the pieces of earlier ones."""
        if path not in cls._HELD:
            cls._HELD[path] = cls(path)
        return cls._HELD[path]

    def _learn(self, pieces: set[str]) -> None:
        tokenize, visible = self.tokenizer.model.tokenize, self.visible
        letter = "I" if self.wide else "H"
        for p in pieces:
            held = self.old.get(p)
            if held is None:
                ids = [t.id for t in tokenize(p.encode().decode("latin-1").translate(visible))]
                held = struct.pack(f"<{len(ids)}{letter}", *ids)
            self.new[p] = held

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian integers of `type`."""
        plain = [self._PLAIN.fullmatch(t) is not None and "<|" not in t for t in texts]
        split = [self._PIECE.findall(t.lower()) if ok else [] for t, ok in zip(texts, plain, strict=True)]
        unknown = set().union(*split).difference(self.new)
        if len(self.new) + len(unknown) > CACHE_PIECES:
            self.old, self.new = self.new, {}
            unknown = set().union(*split).difference(self.new)
        self._learn(unknown)
        look = self.new.__getitem__
        return [b"".join(map(look, pieces)) if ok else self._whole(t) for t, pieces, ok in zip(texts, split, plain, strict=True)]

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.type).tobytes()


def token_ids(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """(doc_id, width, ids): ids of each whole text and the end id, little-endian integers of `width` bytes."""
    def run(batches):
        encoder = WordEncoder.of(tokenizer_path)
        end, width = np.array([end_id], encoder.type).tobytes(), 4 if encoder.wide else 2
        for batch in batches:
            lengths = pa.compute.fill_null(pa.compute.binary_length(batch["text"]), 0).to_pylist()
            a = 0
            while a < len(lengths):
                b, size = a, 0
                while b < len(lengths) and (b == a or size < 1_000_000):
                    size += lengths[b]
                    b += 1
                texts = [t or "" for t in batch["text"].slice(a, b - a).to_pylist()]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch["doc_id"].slice(a, b - a), "width": pa.array([width] * (b - a), pa.int8()),
                    "ids": pa.array([x + end for x in encoder.encode(texts)], pa.binary())})
                a = b
    return common.with_ids(docs).mapInArrow(run, "doc_id long, width byte, ids binary")


def _ids(raw, width: int) -> np.ndarray:
    return np.frombuffer(raw, "<u4" if width == 4 else "<u2")


def _added(total: np.ndarray, rows: list[bytes], width: int) -> np.ndarray:
    more = np.bincount(_ids(b"".join(rows), width), minlength=len(total))
    more[:len(total)] += total
    return more


def id_counts(tokens: DataFrame) -> DataFrame:
    """(id, n) over the whole corpus; a row per id and task is shuffled."""
    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            held: dict[int, list[bytes]] = {}
            for width, raw in zip(batch["width"].to_pylist(), batch["ids"], strict=True):
                rows = held.setdefault(width, [])
                rows.append(raw.as_py())
                if len(rows) == 500:
                    total = _added(total, rows, width)
                    rows.clear()
            for width, rows in held.items():
                total = _added(total, rows, width)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": pa.array(seen, pa.int64()), "n": pa.array(total[seen], pa.int64())})
    return tokens.select("width", "ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


# ---------------------------------------------------------------------------
# codes
# ---------------------------------------------------------------------------


def bit_limit(n_used: int) -> int:
    """Longest code for so many ids: `MAX_BITS`, or four bits more than plain numbers of a larger vocabulary take."""
    plain = max(1, n_used - 1).bit_length()
    return MAX_BITS if plain <= MAX_BITS else min(32, plain + 4)


def code_lengths(counts: np.ndarray, limit: int | None = None) -> np.ndarray:
    """Lengths of an optimal prefix code with at most `limit` bits (package-merge); zero where the count is zero."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    limit = bit_limit(len(used)) if limit is None else limit
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids do not fit into codes of {limit} bits")
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    marks, row = [], leaves
    for level in range(limit):
        if level:
            even = len(row) // 2 * 2
            packages = row[0:even:2] + row[1:even:2]
            both = np.concatenate([leaves, packages])
            sort = np.argsort(both, kind="stable")
            row, marks = both[sort], [*marks, sort < len(leaves)]
        else:
            marks.append(np.ones(len(leaves), bool))
    take = 2 * len(leaves) - 2
    depth = np.zeros(len(leaves), np.int64)
    for mark in reversed(marks):
        n_leaves = int(mark[:take].sum())
        depth[:n_leaves] += 1
        take = 2 * (take - n_leaves)
    lengths[order] = depth
    return lengths


def _in_order(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Ids in the order of (length, id), their codes at the upper end of a number of as many bits as the longest has, and these bits."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    top = max(MAX_BITS, int(lengths.max(initial=0)))
    step = np.int64(1) << (top - lengths[order].astype(np.int64))
    return order, np.cumsum(step) - step, top


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in the order of (length, id)."""
    order, begin, top = _in_order(lengths)
    codes = np.zeros(len(lengths), np.int64)
    codes[order] = begin >> (top - lengths[order].astype(np.int64))
    return codes


@dataclass(frozen=True)
class Table:
    """Id and code length for each value of the next 16 bits; where the length is 0 the code is longer, and the ordered long codes are searched."""

    ids: np.ndarray
    bits: np.ndarray
    long_begin: np.ndarray
    long_ids: np.ndarray
    long_bits: np.ndarray
    top: int


def decode_table(lengths: np.ndarray) -> Table:
    order, begin, top = _in_order(lengths)
    own = lengths[order].astype(np.int64)
    short = own <= MAX_BITS  # in front, because codes are ordered by length
    n = 1 << (MAX_BITS - own[short])
    ids, bits = np.zeros(1 << MAX_BITS, np.int64), np.full(1 << MAX_BITS, 0 if len(order) > short.sum() else 1, np.int64)
    filled = int(n.sum())
    ids[:filled], bits[:filled] = np.repeat(order[short], n), np.repeat(own[short], n)
    return Table(ids, bits, begin[~short], order[~short], own[~short], top)


# ---------------------------------------------------------------------------
# blocks
# ---------------------------------------------------------------------------


def pack_block(doc_ids: np.ndarray, sizes: np.ndarray, ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> bytes:
    bits = lengths[ids].astype(np.int64)
    ends = np.cumsum(bits)
    at = ends - bits
    total = int(ends[-1]) if len(ends) else 0
    word, shift = at >> 5, at & 31
    value = codes[ids] << (64 - bits - shift).astype(np.int64)
    value = value.view(np.uint64)
    n_words = (total + 31) // 32 + 1
    # bits of different codes never overlap, so sums are unions; a double holds 32 bits exactly
    out = np.bincount(word, (value >> np.uint64(32)).astype(np.float64), n_words)
    out += np.bincount(word + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), n_words + 1)[:n_words]
    checkpoints = at[::CHECKPOINT].astype("<u8")
    head = _HEAD.pack(_MAGIC, 1, CHECKPOINT, len(doc_ids), len(ids), len(checkpoints))
    return b"".join([head, doc_ids.astype("<i8").tobytes(), sizes.astype("<u4").tobytes(), checkpoints.tobytes(),
                     out.astype(">u4").tobytes()])


def unpack_block(data, table: Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, lengths and all ids of a block."""
    magic, version, every, n_docs, n_ids, n_points = _HEAD.unpack_from(data, 0)
    if magic != _MAGIC or version != 1:
        raise ValueError("not a block of token ids")
    at = _HEAD.size
    doc_ids = np.frombuffer(data, "<i8", n_docs, at)
    sizes = np.frombuffer(data, "<u4", n_docs, at + 8 * n_docs)
    points = np.frombuffer(data, "<u8", n_points, at + 12 * n_docs).astype(np.int64)
    raw = np.frombuffer(data, np.uint8, -1, at + 12 * n_docs + 8 * n_points).astype(np.int64)
    raw = np.concatenate([raw, np.zeros(6, np.int64)])
    three = raw[:-4] << 16 | raw[1:-3] << 8 | raw[2:-2]
    five = three << 16 | raw[3:-1] << 8 | raw[4:] if len(table.long_ids) else None
    out = np.zeros((every, n_points), np.int64)
    pos = points.copy()
    last = len(three) - 1
    for step in range(min(every, n_ids)):  # all stretches side by side
        at = np.minimum(pos >> 3, last)
        peek = three[at] >> (8 - (pos & 7)) & 0xFFFF
        symbol, length = table.ids[peek], table.bits[peek]
        if five is not None and len(rest := np.flatnonzero(length == 0)):
            wide = five[at[rest]] >> (40 - table.top - (pos[rest] & 7)) & ((1 << table.top) - 1)
            k = np.maximum(np.searchsorted(table.long_begin, wide, side="right") - 1, 0)
            symbol[rest], length[rest] = table.long_ids[k], table.long_bits[k]
        out[step] = symbol
        pos += length
    return doc_ids, sizes, out.T.reshape(-1)[:n_ids]


# ---------------------------------------------------------------------------
# files
# ---------------------------------------------------------------------------


def write_ids(tokens: DataFrame, path: str, block_ids: int = BLOCK_IDS) -> None:
    """Writes (doc_id, width, ids) in ascending doc_id order.  The counts that reach the driver are bounded by the vocabulary."""
    spark = tokens.sparkSession
    rows = id_counts(tokens).collect()
    counts = np.zeros(max((r["id"] for r in rows), default=-1) + 1, np.int64)
    for r in rows:
        counts[r["id"]] = r["n"]
    lengths = code_lengths(counts)
    codes = canonical_codes(lengths)
    spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary").coalesce(1).write.parquet(os.path.join(path, "codebook"))

    def run(batches):
        part, block, first = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[int, np.ndarray]] = []
        size = 0
        for batch in batches:
            for doc_id, width, raw in zip(batch["doc_id"].to_pylist(), batch["width"].to_pylist(), batch["ids"].to_pylist(), strict=True):
                held.append((_NO_ID if doc_id is None else doc_id, _ids(raw, width)))
                size += len(held[-1][1])
                if size >= block_ids:
                    yield _block(part, block, first, size, held, codes, lengths)
                    held, block, first, size = [], block + 1, first + size, 0
        if held:
            yield _block(part, block, first, size, held, codes, lengths)

    ordered = tokens.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.length("ids"), F.crc32("ids"))
    ordered.mapInArrow(run, "part int, block int, first_id long, n_ids long, data binary").write.parquet(os.path.join(path, "blocks"))


def _block(part, block, first, size, held, codes, lengths) -> pa.RecordBatch:
    doc_ids = np.array([x[0] for x in held], np.int64)
    sizes = np.array([len(x[1]) for x in held], np.int64)
    data = pack_block(doc_ids, sizes, np.concatenate([x[1] for x in held]), codes, lengths)
    return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "block": pa.array([block], pa.int32()),
                                       "first_id": pa.array([first], pa.int64()), "n_ids": pa.array([size], pa.int64()),
                                       "data": pa.array([data], pa.binary())})


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every document in the files."""
    lengths = np.frombuffer(bytes(spark.read.parquet(os.path.join(path, "codebook")).first()["lengths"]), np.uint8)
    blocks = spark.read.parquet(os.path.join(path, "blocks"))
    before, rows = 0, []
    for r in sorted(blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()):  # one row per written file
        rows.append((r["part"], before))
        before += r["n"]
    bases = spark.createDataFrame(rows, "part int, base long")
    table: list = []

    def run(batches):
        if not table:
            table.append(decode_table(lengths))
        for batch in batches:
            for first, data in zip(batch["first"].to_pylist(), batch["data"], strict=True):
                doc_ids, sizes, ids = unpack_block(data.as_buffer(), table[0])
                ids = ids.astype("<u4")
                ends = np.cumsum(sizes, dtype=np.int64)
                cuts = [ids[a:b].tobytes() for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
                out = {"doc_id": pa.array(doc_ids, pa.int64(), mask=doc_ids == _NO_ID),
                       "start": pa.array(first + ends - sizes, pa.int64()), "n_tokens": pa.array(sizes, pa.int64()),
                       "ids_crc32": pa.array([zlib.crc32(x) for x in cuts], pa.int64())}
                if with_ids:
                    out["ids"] = pa.array(cuts, pa.binary())
                yield pa.RecordBatch.from_pydict(out)

    placed = blocks.join(F.broadcast(bases), "part").select((F.col("base") + F.col("first_id")).alias("first"), "data")
    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else ""))


def encode_corpus(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2) -> None:
    write_ids(common.staged(token_ids(docs, tokenizer_path, end_id), "token-ids"), path)
