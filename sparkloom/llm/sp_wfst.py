"""SentencePiece encoding and decoding as a shortest path through weighted finite-state transducers.

Pieces (one path per piece) and byte fallback (a character without a piece becomes its UTF-8 bytes) are read from a model
file and composed with each text as a lattice; the tropical-semiring shortest path gives the pieces.  The normaliser (space
escape, dummy prefix) has one state and is applied as a mapping of characters; other normalisers are refused.

A unigram model puts minus the score of a piece on its arc.  A BPE model has no additive weights; there an arc from piece
`a` to piece `b` weighs 0 if merging the characters of `ab` by the model's priorities ends in exactly `a`, `b`, and
infinity otherwise.  An encoding by merges is the only path of weight 0: a merge across a border would already happen for
the two pieces alone, and every part of an encoding is the encoding of its part.

Where no piece holds the two characters around a place, no path spans it.  So texts are composed part by part: a part ends
before spaces and after a run of letters, which no sign follows inside a piece, and recent parts are remembered.  A model with
a space after another character inside a piece, or with a character map, is refused.

Defined results: null is the empty text, which has no pieces; the escape character itself reads as a space, as in the
original format; rows that share a doc_id are encoded one by one; a very long text is cut only where no piece can span;
of equal paths the one with the longer last piece stays; an empty table gives no rows; other columns, of whatever name, play no
part.
"""

from __future__ import annotations

import hashlib
import math
import re
import string
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm import common

ESCAPE = "▁"
CACHE_PARTS = 400_000
CACHE_PAIRS = 2_000_000
_NORMAL, _USER, _BYTE = 1, 4, 6
_BPE = 2


class Machines:
    """The compiled transducers of one model file."""

    _HELD: dict[str, Machines] = {}

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        rules = model.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("only models whose normaliser escapes spaces and maps no characters can be compiled")
        self.prefix = bool(rules.add_dummy_prefix)
        self.merges = model.trainer_spec.model_type == _BPE
        self.piece: dict[str, int] = {}
        self.score: list[float] = []
        self.bytes_of: list[bytes] = []
        self.byte_id = [-1] * 256
        for i, p in enumerate(model.pieces):
            self.score.append(p.score)
            if p.type == _BYTE:
                self.byte_id[int(p.piece[1:-1], 16)] = i
                self.bytes_of.append(bytes([int(p.piece[1:-1], 16)]))
            else:
                self.bytes_of.append(p.piece.replace(ESCAPE, " ").encode() if p.type in (_NORMAL, _USER) else b"")
            if p.type in (_NORMAL, _USER):
                self.piece[p.piece] = i
                if ESCAPE in p.piece.lstrip(ESCAPE):
                    raise ValueError(f"piece {p.piece!r} spans a word border")
        if -1 in self.byte_id:
            raise ValueError("the model has no byte fallback")
        self.is_byte = np.zeros(len(self.score), bool)
        self.is_byte[self.byte_id] = True
        self.longest = max(map(len, self.piece))
        self.fallback = -min(self.score[i] for i in self.piece.values()) + 10.0
        ends: dict[str, set[int]] = {}
        for p in self.piece:
            if len(p) > 2:
                ends.setdefault(p[-3:], set()).add(len(p))
        # lengths of the pieces with these last three characters, longest first
        self.lengths = {end: (*sorted(n, reverse=True), 2, 1) for end, n in ends.items()}
        self.rank = {p: self.score[i] for p, i in self.piece.items()}
        self.name = {i: p for p, i in self.piece.items()}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.whole: dict[int, bool] = {}
        self.joined = joined = {two for p in self.piece for two in zip(p, p[1:], strict=False)}
        letters = set(string.ascii_letters)
        while more := {b for a, b in joined if a in letters and b != ESCAPE} - letters:
            letters |= more  # whatever can follow a letter inside a piece
        run, breaks = "".join(map(re.escape, sorted(letters))), "" if any("\n" in p for p in self.piece) else "\n"
        self.part = re.compile(f"{ESCAPE}*[^{ESCAPE}{breaks}{run}]*[{run}]+|{ESCAPE}*[^{ESCAPE}{breaks}{run}]+|{ESCAPE}+|\n")
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> Machines:
        """One per worker process."""
        if path not in cls._HELD:
            cls._HELD[path] = cls(path)
        return cls._HELD[path]

    # -- weights of a BPE model

    def merged(self, text: str, border: int = 0) -> list[str] | None:
        """Merges of the best-scored neighbours, leftmost first, on a few characters; None once one spans `border`."""
        parts, rank = list(text), self.rank.get
        gain = [rank(x + y, -math.inf) for x, y in zip(parts, parts[1:], strict=False)]
        while gain:
            best = max(gain)
            if best == -math.inf:
                break
            i = gain.index(best)
            if i < border:  # `border` counts the parts left of it
                border -= 1
                if i == border:
                    return None
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del gain[i]
            if i:
                gain[i - 1] = rank(parts[i - 1] + parts[i], -math.inf)
            if i < len(gain):
                gain[i] = rank(parts[i] + parts[i + 1], -math.inf)
        return parts

    def follows(self, a: int, b: int) -> bool:
        """Whether the arc from piece a to piece b has weight 0."""
        key = (a, b)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > CACHE_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self.merged(self.name[a] + self.name[b], len(self.name[a])) == [self.name[a], self.name[b]]
        return known

    def stands(self, a: int) -> bool:
        """Whether merging the characters of a piece gives the piece."""
        known = self.whole.get(a)
        if known is None:
            known = self.whole[a] = self.merged(self.name[a]) == [self.name[a]]
        return known

    # -- composition and shortest path

    def shortest(self, unit: str) -> list[int]:
        """Ids on the lightest path of the pieces and bytes composed with a normalised part."""
        back = self._merge_path(unit) if self.merges else self._score_path(unit)
        out: list[int] = []
        j = len(unit)
        while j:
            i, k = back[j]
            out += [k] if k >= 0 else [self.byte_id[x] for x in reversed(unit[i:j].encode())]
            j = i
        return out[::-1]

    def _merge_path(self, unit: str) -> list[tuple[int, int]]:
        """Start and piece (-1: bytes) of the arc into each place of a BPE model.

        Every prefix has exactly one path of weight 0, so the first arc found to extend one ends the search at its place.
        """
        get, pairs, whole = self.piece.get, self.pairs, self.whole
        back = [(-1, -1)]
        lengths = self.lengths.get
        for j in range(1, len(unit) + 1):
            for n in lengths(unit[j - 3:j], (2, 1)) if j > 2 else (2, 1):
                if n > j:
                    continue
                i = j - n
                k = get(unit[i:j])
                if k is None:
                    continue
                before = back[i][1]
                if before >= 0:
                    ok = pairs.get((before, k))
                    if ok if ok is not None else self.follows(before, k):
                        break
                else:  # the start, or after bytes, which never merge
                    ok = whole.get(k)
                    if ok if ok is not None else self.stands(k):
                        break
            else:
                i, k = j - 1, -1
            back.append((i, k))
        return back

    def _score_path(self, unit: str) -> list[tuple[int, int]]:
        n = len(unit)
        cost = [0.0] + [math.inf] * n
        back = [(-1, -1)] * (n + 1)
        for j in range(1, n + 1):
            for i in range(max(0, j - self.longest), j):
                k = self.piece.get(unit[i:j])
                if k is not None and cost[i] - self.score[k] < cost[j]:
                    cost[j], back[j] = cost[i] - self.score[k], (i, k)
            # a character with a piece of its own never falls back
            if unit[j - 1] not in self.piece and cost[j - 1] + self.fallback < cost[j]:
                cost[j], back[j] = cost[j - 1] + self.fallback, (j - 1, -1)
        return back

    def parts(self, text: str) -> list[str]:
        """The normalised text in parts."""
        return self.part.findall((ESCAPE if self.prefix and text else "") + text.replace(" ", ESCAPE))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        split = [self.parts(t) for t in texts]
        unknown = set().union(*split).difference(self.new)
        if len(self.new) + len(unknown) > CACHE_PARTS:
            self.old, self.new = self.new, {}
            unknown = set().union(*split).difference(self.new)
        joined, new = self.joined, self.new
        for part in unknown:
            cuts = [b for b, two in enumerate(zip(part, part[1:], strict=False), 1) if two not in joined]
            if cuts:
                new[part] = b"".join([self._one(part[a:b]) for a, b in zip([0, *cuts], [*cuts, len(part)], strict=True)])
            else:
                self._one(part)
        look = new.__getitem__
        return [b"".join(map(look, parts)) for parts in split]

    def _one(self, part: str) -> bytes:
        held = self.new.get(part)
        if held is None:
            held = self.old.get(part)
            if held is None:
                ids = self.shortest(part)
                held = struct.pack(f"<{len(ids)}i", *ids)
            self.new[part] = held
        return held

    def decode(self, ids: np.ndarray) -> str:
        """The inverse composition: pieces and bytes to text, without the dummy prefix."""
        raw = b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        if self.prefix and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", errors="replace")


common.KEPT["sp_wfst"] = Machines._HELD


# ---------------------------------------------------------------------------
# operator
# ---------------------------------------------------------------------------


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_ids, n_byte_ids, ids_crc32, ids, decoded_sha256, round_trip) of every whole text.

    `round_trip` says whether decoding the ids gives the text back; `decoded_sha256` is the digest of what they give.
    """
    def run(batches):
        m = Machines.of(model_path)
        for batch in batches:
            lengths = pa.compute.fill_null(pa.compute.binary_length(batch["text"]), 0).to_pylist()
            a = 0
            while a < len(lengths):
                b, size = a, 0
                while b < len(lengths) and (b == a or size < 1_000_000):
                    size += lengths[b]
                    b += 1
                part = batch.slice(a, b - a)
                yield _rows(m, part["doc_id"], [t or "" for t in part["text"].to_pylist()])
                a = b

    return common.with_ids(docs).mapInArrow(
        common.released(run, "sp_wfst"), "doc_id long, n_ids long, n_byte_ids long, ids_crc32 long, ids array<int>, decoded_sha256 string, round_trip boolean")


def _rows(m: Machines, doc_id: pa.Array, texts: list[str]) -> pa.RecordBatch:
    raw = m.encode(texts)
    ids = [np.frombuffer(x, "<i4") for x in raw]
    back = [m.decode(x) for x in ids]
    ends = np.cumsum([0] + [len(x) for x in ids]).astype(np.int32)
    flat = np.frombuffer(b"".join(raw), "<i4")
    return pa.RecordBatch.from_pydict({
        "doc_id": doc_id, "n_ids": pa.array(np.diff(ends), pa.int64()),
        "n_byte_ids": pa.array([int(m.is_byte[x].sum()) for x in ids], pa.int64()),
        "ids_crc32": pa.array([zlib.crc32(x) for x in raw], pa.int64()),
        "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())),
        "decoded_sha256": pa.array([hashlib.sha256(x.encode()).hexdigest() for x in back], pa.string()),
        "round_trip": pa.array([x == t for x, t in zip(back, texts, strict=True)], pa.bool_())})


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids)."""
    def run(batches):
        m = Machines.of(model_path)
        for batch in batches:
            lists = batch["ids"].to_pylist()
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "text": pa.array(
                [None if x is None else m.decode(np.array(x, np.int64)) for x in lists], pa.string())})
    return encoded.select("doc_id", F.col("ids").cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, text string")
