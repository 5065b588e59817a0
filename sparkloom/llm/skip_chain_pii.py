"""Personal data by a skip-chain conditional random field.

Patterns find e-mail addresses, IP addresses, card and phone numbers; these base spans always stay.  The field labels every
word with a digit or an at sign.  Neighbouring words share transition potentials; equal words and words with the same
digits, however far apart in the document, share an agreement potential through a hub per group, so a group costs as many
messages as it has members.  A number in blocks ("4111 1111 1111 1111") is a group too: every word of two to five neighbouring
words of digits is tied to the hub of the digits they make together.  Base spans are observed; loopy message passing carries their labels to mentions that the
patterns miss (a card number run into another number, a phone number without its prefix), and words the field is sure of
become further spans.

Weights are learned by pseudo-likelihood in numpy from base spans on a bounded sample of documents; what a word looks like
is left out half of the time, so that context and agreement are learned too.

Defined results: null is the empty text and has no spans; documents are judged alone, also when they share an id; a very long
text or word is read whole, in time linear in it; spans that start together go by kind; an empty table gives no rows; without a
document to learn from the field adds nothing; other columns, of whatever name, play no part.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm import common

KINDS = ("email", "ip", "card", "phone")
LABELS = ("other", *KINDS)
SAMPLE, SAMPLE_CHARS = 2000, 200_000
EPOCHS = 4
ROUNDS = 8
SURE = 0.9
WEIGHTS = 1 << 15
_CLAMP = 30.0
# The patterns of the task, so written that no run of characters is tried again from its middle: a run of local characters is
# taken whole, with or without an address behind it, and digits are entered at the start of their run only.
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]++(@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)?")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ACTIVE = re.compile(r"[0-9@]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_RUN = re.compile(r"[A-Z]+|[a-z]+|[0-9]+|[^A-Za-z0-9]")
_DIGIT_WORD = re.compile(r"[+(]*[0-9][0-9().-]*[.,;:)]*")
KINDS_OF_GROUPS = 3  # equal words, equal last digits, equal digits over neighbouring words


# ---------------------------------------------------------------------------
# base spans
# ---------------------------------------------------------------------------


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _is_ip(match: str) -> bool:
    return all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in match.split(".")))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the spans of the patterns, sorted."""
    out = []
    if "@" in text:
        out += [(m.start(), 0, m.end()) for m in _EMAIL.finditer(text) if m[1]]
    if _ACTIVE.search(text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if _is_ip(m[0])]
        for m in _CARD.finditer(text):
            digits = _NOT_DIGIT.sub("", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return sorted(out)


# ---------------------------------------------------------------------------
# graph of a document
# ---------------------------------------------------------------------------


@dataclass
class Graph:
    """Words with a digit or at sign of some documents, their features, neighbours and groups."""

    spans: np.ndarray  # (n, 2) places in the text
    label: np.ndarray  # observed label, 0 where none
    surface: list[list[int]]  # feature numbers that tell what the word looks like
    context: list[list[int]]
    chain: np.ndarray  # (e, 2) neighbouring words
    member: np.ndarray  # (m, 3) word, group, kind of group


def _feature(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "replace")) % WEIGHTS


def _look(word: str) -> str:
    return "".join(("A" if r[0] < "a" and r[0].isalpha() else "a" if r[0].isalpha() else f"9{{{len(r)}}}") if r[0].isalnum() and r[0] < "\x7f" else r[0]
                   for r in _RUN.findall(word))


def _windows(words: list[str], digits: list[str], joined: set[int]):
    """(key, members) of every two to five neighbouring words of digits that together make a number of a card's or phone's length."""
    plain = [bool(_DIGIT_WORD.fullmatch(w)) for w in words]
    for i in range(len(words)):
        whole = digits[i] if plain[i] else ""
        for j in range(i + 1, min(i + 5, len(words))):
            if not whole or j not in joined or not plain[j]:
                break
            whole += digits[j]
            if len(whole) > 19:
                break
            if len(whole) >= 7:
                yield whole, range(i, j + 1)


def graph_of(text: str, base: list[tuple[int, int, int]]) -> Graph:
    spans: list[tuple[int, int]] = []
    around: list[tuple[str, str]] = []
    last, open_ = "", False
    for m in common.WORD.finditer(text):
        w = m[0]
        if open_:
            around[-1] = (around[-1][0], w)
        if open_ := _ACTIVE.search(w) is not None:
            spans.append(m.span())
            around.append((last, ""))
        last = w
    label = np.zeros(len(spans), np.int64)
    k = 0
    starts = [s for s, _ in spans]
    for s, kind, e in base:
        k = int(np.searchsorted(starts, s, side="right")) - 1
        while 0 <= k < len(spans) and spans[k][0] < e:
            if not label[k]:
                label[k] = kind + 1
            k += 1
    words = [text[a:b] for a, b in spans]
    digits = [_NOT_DIGIT.sub("", w) for w in words]
    chain = [(i, i + 1) for i in range(len(spans) - 1) if spans[i + 1][0] - spans[i][1] == 1]
    surface, context = [], []
    joined = {b for _, b in chain}
    for i, w in enumerate(words):
        surface.append([_feature("look " + _look(w)), _feature(f"digits {len(digits[i])}"), _feature(f"at {'@' in w} dots {min(w.count('.'), 4)}"),
                        _feature(f"luhn {12 <= len(digits[i]) <= 19 and luhn(digits[i])} plus {w[0] == '+'}")])
        before, after = around[i]
        context.append([_feature("bias"), _feature("before " + _look(before) if i in joined else "before " + before.lower().strip(".,:;")),
                        _feature("after " + _look(after))])
    groups: dict[tuple, list[int]] = {}
    for i, w in enumerate(words):
        if len(w) >= 5:
            groups.setdefault((0, w.lower().strip(".,;:()")), []).append(i)
        if len(digits[i]) >= 7:
            groups.setdefault((1, digits[i][-7:]), []).append(i)
    blocks: dict[str, list[range]] = {}
    for number, held in _windows(words, digits, joined):
        blocks.setdefault(number, []).append(held)
    for number, found in blocks.items():
        if len(found) > 1:
            groups[2, number] = sorted({i for held in found for i in held})
    member = [(i, g, kind[0]) for g, (kind, held) in enumerate((k, v) for k, v in groups.items() if len(v) > 1) for i in held]
    return Graph(np.array(spans, np.int64).reshape(-1, 2), label, surface, context, np.array(chain, np.int64).reshape(-1, 2),
                 np.array(member, np.int64).reshape(-1, 3))


# ---------------------------------------------------------------------------
# learning
# ---------------------------------------------------------------------------


@dataclass
class Model:
    weight: np.ndarray  # feature, label
    move: np.ndarray  # label, next label
    agree: np.ndarray  # kind of group


def empty_model() -> Model:
    k = len(LABELS)
    return Model(np.zeros((WEIGHTS, k)), np.zeros((k, k)), np.zeros(KINDS_OF_GROUPS))


def train(graphs: list[Graph], epochs: int = EPOCHS, rate: float = 0.2, seed: int = 0) -> Model:
    """Stochastic gradient ascent on the pseudo-likelihood of each word's label given its neighbours' and its groups'."""
    model, rng, k = empty_model(), np.random.default_rng(seed), len(LABELS)
    for epoch in range(epochs):
        speed = rate / (1 + epoch)
        for g in (graphs[i] for i in rng.permutation(len(graphs))):
            left, right = dict(g.chain[:, ::-1].tolist()), dict(g.chain.tolist())
            named = {group for i, group, _ in g.member.tolist() if g.label[i]}
            # a word outside the base spans that looks like one inside is no example of either
            unseen = {i for i, group, _ in g.member.tolist() if group in named and not g.label[i]}
            totals: dict[int, np.ndarray] = {}
            for i, group, _ in g.member.tolist():
                held = totals.setdefault(group, np.zeros(k))
                if i not in unseen:
                    held[g.label[i]] += 1
            own: dict[int, list[tuple[int, int]]] = {}
            for i, group, kind in g.member.tolist():
                own.setdefault(i, []).append((group, kind))
            for i, y in enumerate(g.label.tolist()):
                if i in unseen:
                    continue
                used = g.context[i] + (g.surface[i] if rng.random() < 0.5 else [])
                z = model.weight[used].sum(axis=0)
                if i in left:
                    z = z + model.move[g.label[left[i]]]
                if i in right:
                    z = z + model.move[:, g.label[right[i]]]
                shares = []
                for group, kind in own.get(i, ()):
                    others = totals[group].copy()
                    others[y] -= 1
                    share = others / max(others.sum(), 1)
                    z = z + model.agree[kind] * share
                    shares.append((kind, share))
                p = np.exp(z - z.max())
                p /= p.sum()
                slope = -p
                slope[y] += 1
                slope *= speed
                model.weight[used] += slope
                if i in left:
                    model.move[g.label[left[i]]] += slope
                if i in right:
                    model.move[:, g.label[right[i]]] += slope
                for kind, share in shares:
                    model.agree[kind] = min(max(model.agree[kind] + float(slope @ share), 0.0), 8.0)
    return model


# ---------------------------------------------------------------------------
# message passing
# ---------------------------------------------------------------------------


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _even(x: np.ndarray) -> np.ndarray:
    return x - _log_sum(x, 1)[:, None]


def marginals(g: Graph, model: Model, rounds: int = ROUNDS, damp: float = 0.3) -> np.ndarray:
    """Label probabilities of every word after `rounds` of messages to all neighbours and hubs at once."""
    n, k = len(g.spans), len(LABELS)
    used = [a + b for a, b in zip(g.surface, g.context, strict=True)]
    unary = np.stack([model.weight[u].sum(axis=0) for u in used]) if n else np.zeros((0, k))
    seen = np.flatnonzero(g.label)
    unary[seen, g.label[seen]] += _CLAMP
    a, b = g.chain[:, 0], g.chain[:, 1]
    word, hub, kind = g.member[:, 0], g.member[:, 1], g.member[:, 2]
    n_hubs = int(hub.max()) + 1 if len(hub) else 0
    to_right, to_left, from_hub = np.zeros((len(a), k)), np.zeros((len(a), k)), np.zeros((len(word), k))
    same = model.agree[kind][:, None, None] * np.eye(k)[None]

    def belief():
        total = unary.copy()
        np.add.at(total, b, to_right)
        np.add.at(total, a, to_left)
        np.add.at(total, word, from_hub)
        return total

    for _ in range(rounds):
        total = belief()
        right = _even(_log_sum((total[a] - to_left)[:, :, None] + model.move[None], 1))
        left = _even(_log_sum((total[b] - to_right)[:, None, :] + model.move[None], 2))
        up = _even(_log_sum((total[word] - from_hub)[:, :, None] + same, 1))
        held = np.zeros((n_hubs, k))
        np.add.at(held, hub, up)
        down = _even(_log_sum((held[hub] - up)[:, :, None] + same, 1))
        to_right, to_left = damp * to_right + (1 - damp) * right, damp * to_left + (1 - damp) * left
        from_hub = damp * from_hub + (1 - damp) * down
    return np.exp(_even(belief()))


def _plausible(kind: int, piece: str) -> bool:
    digits = len(_NOT_DIGIT.sub("", piece))
    return (("@" in piece.strip("@")), piece.count(".") >= 3 and digits >= 4, 12 <= digits <= 19, 7 <= digits <= 15)[kind]


def added_spans(text: str, g: Graph, p: np.ndarray, base: list[tuple[int, int, int]], sure: float = SURE) -> list[tuple[int, int, int]]:
    """Spans of neighbouring words with one sure label, off the base spans."""
    pick = np.where((g.label == 0) & (p.max(axis=1) >= sure), p.argmax(axis=1), 0)
    linked = {b for _, b in g.chain.tolist()}
    out, i = [], 0
    while i < len(pick):
        j = i + 1
        while j < len(pick) and j in linked and pick[j] == pick[i]:
            j += 1
        if pick[i]:
            a, b = int(g.spans[i, 0]), int(g.spans[j - 1, 1])
            while a < b and not (text[a].isalnum() or text[a] in "+("):
                a += 1
            while a < b and not text[b - 1].isalnum():
                b -= 1
            if _plausible(int(pick[i]) - 1, text[a:b]) and not any(s < b and a < e for s, _, e in base):
                out.append((a, int(pick[i]) - 1, b))
        i = j
    return out


# ---------------------------------------------------------------------------
# operator
# ---------------------------------------------------------------------------


def sample_of(docs: DataFrame, sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS) -> list[Graph]:
    """Graphs of at most `sample` documents with a digit or at sign, those with the smallest hashes of their ids.

    For learning only: one row for each id, the one of the smallest hash, and of it at most `sample_chars` characters.
    """
    active = common.with_ids(docs).where("doc_id IS NOT NULL").where(F.col("text").rlike("[0-9@]")).withColumn("h", F.xxhash64("text"))
    chosen = active.groupBy("doc_id").agg(F.min("h").alias("h")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def run(batches):
        for batch in batches:
            keep = [(d, t) for d, t in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True) if t]
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array([d for d, _ in keep], pa.int64()),
                                              "graph": pa.array([_packed(graph_of(t, base_spans(t))) for _, t in keep], pa.binary())})

    # bounded by `sample`, so the broadcast and the rows are
    one = active.join(F.broadcast(chosen), ["doc_id", "h"]).dropDuplicates(["doc_id"]).select("doc_id", F.substring("text", 1, sample_chars).alias("text"))
    rows = one.mapInArrow(run, "doc_id long, graph binary").collect()
    return [_unpacked(bytes(r["graph"])) for r in sorted(rows, key=lambda r: (r["doc_id"], bytes(r["graph"])))]


def _packed(g: Graph) -> bytes:
    parts = [g.spans, g.label, np.array(g.surface, np.int64).reshape(-1, 4), np.array(g.context, np.int64).reshape(-1, 3),
             g.chain, g.member]
    head = np.array([x for p in parts for x in (p.shape if p.ndim == 2 else (p.shape[0], 0))], "<i8").tobytes()
    return head + b"".join(p.astype("<i8").tobytes() for p in parts)


def _unpacked(raw: bytes) -> Graph:
    shapes, at, parts = np.frombuffer(raw, "<i8", 12).reshape(6, 2).tolist(), 96, []
    for n, m in shapes:
        size = n * max(m, 1)
        part = np.frombuffer(raw, "<i8", size, at)
        parts.append(part.reshape(n, m) if m else part)
        at += 8 * size
    return Graph(parts[0].reshape(-1, 2), parts[1], parts[2].tolist(), parts[3].tolist(), parts[4].reshape(-1, 2), parts[5].reshape(-1, 3))


def find_personal(docs: DataFrame, sample: int = SAMPLE, sure: float = SURE) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) of every whole text."""
    model = train(sample_of(docs, sample))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches):
        for batch in batches:
            rows = [_found(t or "", shared.value, sure) for t in batch["text"].to_pylist()]
            cols = list(zip(*rows, strict=True)) or [()] * len(_TYPES)
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], **{k: pa.array(v, t) for (k, t), v in zip(_TYPES.items(), cols, strict=True)}})

    return common.with_ids(docs).mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


_TYPES = {"n_email": pa.int64(), "n_ip": pa.int64(), "n_card": pa.int64(), "n_phone": pa.int64(), "base_sha256": pa.string(),
          "spans": pa.string(), "n_added": pa.int64()}


def _named(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def _found(text: str, model: Model, sure: float) -> tuple:
    base = base_spans(text)
    more: list[tuple[int, int, int]] = []
    if _ACTIVE.search(text):
        g = graph_of(text, base)
        more = added_spans(text, g, marginals(g, model), base, sure)
    kinds = np.bincount([k for _, k, _ in base], minlength=4).tolist() if base else [0] * 4
    return (*kinds, hashlib.sha256(_named(base).encode()).hexdigest(), _named(base + more), len(more))
