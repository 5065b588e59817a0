"""Quality rules as a ledger of failure bits.

One pass over the texts takes all measurements.  Every rule is evaluated once on them and sets its bit in `failures`.
Policies are versioned sets of rules with a number of failures they allow; applying one, comparing versions and asking
what a policy would keep without one of its rules (ablation) are bitwise questions to the ledger, answered on its
histogram of bit patterns.

Defined results: null is the empty text, which has no words and fails the rules on too few words; rules on shares of
nothing do not fail; equal doc_ids are judged row by row; a very long text is measured whole;
values at a limit pass; an empty table gives no rows; other columns, of whatever name, play no part.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.llm import common

SYMBOLS = "#*$%&|<>"
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    name: str
    fails: Column


def rules() -> list[Rule]:
    """The rules in the order of their bits; new rules are added at the end."""
    c = F.col
    return [
        Rule("few_words", c("n_words") < 20),
        Rule("repeated_words", 100 * c("n_repeat_words") > 30 * c("n_words")),
        Rule("short_words", c("word_chars") < 2 * c("n_words")),
        Rule("long_words", c("word_chars") > 20 * c("n_words")),
        Rule("symbols", 10 * c("n_symbols") > c("n_words")),
        Rule("repeated_lines", 10 * c("n_dup_lines") > 3 * c("n_lines")),
        Rule("capitals", 2 * c("n_upper") > c("n_letters")),
        Rule("few_letters", 2 * c("n_letters") < c("word_chars")),
    ]


RULE_NAMES = ("few_words", "repeated_words", "short_words", "long_words", "symbols", "repeated_lines", "capitals", "few_letters")


@dataclass(frozen=True)
class Policy:
    """Keeps a document that fails at most `allowed` of the named rules."""

    name: str
    version: int
    members: tuple[str, ...]
    allowed: int = 0

    @property
    def mask(self) -> int:
        return sum(1 << RULE_NAMES.index(m) for m in self.members)


BASE = Policy("base", 1, ("few_words", "repeated_words"))
STRICT_V1 = Policy("strict", 1, RULE_NAMES[:6])
STRICT_V2 = Policy("strict", 2, RULE_NAMES)

_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper")
_LETTER_RUN = re.compile(r"[^\W\d_]+")


def repeat_words(words: list[str], window: int = WINDOW) -> int:
    """Words inside windows of `window` (a power of two) words that occur twice or more in the text."""
    n = len(words)
    if n <= window:
        return 0
    number: dict[str, int] = {}
    name = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    if len(number) == n:
        return 0
    k = 1
    while k < window:  # names of windows twice as long: exact, as pairs of names
        pair = name[:-k] * (int(name.max()) + 1) + name[k:]
        name = np.unique(pair, return_inverse=True)[1]
        k *= 2
    twice = np.bincount(name)[name] >= 2
    if not twice.any():
        return 0
    step = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + window, -1)
    return int((np.cumsum(step[:-1]) > 0).sum())


def _capitals(letters: str) -> int:
    small = letters.lower()
    if len(small) != len(letters):  # a few letters have a longer small form
        return sum(c != c.lower() for c in letters)
    a, b = (np.frombuffer(x.encode("utf-32-le"), np.uint32) for x in (letters, small))
    return int((a != b).sum())


def _measure(text: str) -> tuple[int, ...]:
    words = common.WORD.findall(text)
    lines = text.split("\n")
    seen: set[str] = set()
    dup = 0
    for line in lines:
        if line in seen:
            dup += 1
        elif common.WORD.search(line):
            seen.add(line)
    letters = "".join(_LETTER_RUN.findall(text))
    return (len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), dup, repeat_words(words),
            len(lines), len(letters), _capitals(letters))


def _run(batches):
    for batch in batches:
        rows = [_measure(t or "") for t in batch["text"].to_pylist()]
        values = list(zip(*rows, strict=True)) or [()] * len(_MEASURES)
        yield pa.RecordBatch.from_pydict(
            {"doc_id": batch["doc_id"], **{m: pa.array(v, pa.int64()) for m, v in zip(_MEASURES, values, strict=True)}})


def ledger(docs: DataFrame) -> DataFrame:
    """(doc_id, measurements..., failures): one bit per rule, in the order of `rules`."""
    schema = "doc_id long, " + ", ".join(f"{m} long" for m in _MEASURES)
    measured = common.with_ids(docs).mapInArrow(_run, schema)
    found = rules()
    assert tuple(r.name for r in found) == RULE_NAMES
    bits = [F.when(r.fails, F.lit(1 << i)).otherwise(F.lit(0)) for i, r in enumerate(found)]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return measured.withColumn("failures", total.cast("long"))


def keeps(policy: Policy, failures: Column | str = "failures") -> Column:
    c = F.col(failures) if isinstance(failures, str) else failures
    return F.bit_count(c.bitwiseAND(F.lit(policy.mask).cast("long"))) <= policy.allowed


def ablations(ledger_df: DataFrame, policies: list[Policy]) -> DataFrame:
    """(policy, version, rule, kept, kept_without, only_this): per policy and member rule, documents kept by the policy,
    kept if the rule were dropped, and failing this rule alone among its members.  One count per bit pattern is shuffled."""
    patterns = ledger_df.groupBy("failures").agg(F.count("*").alias("n"))
    plan = F.array(*[
        F.struct(F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), F.lit(m).alias("rule"),
                 F.lit(p.mask).cast("long").alias("mask"), F.lit(1 << RULE_NAMES.index(m)).cast("long").alias("bit"),
                 F.lit(p.allowed).alias("allowed"))
        for p in policies for m in p.members])
    each = patterns.select("failures", "n", F.inline(plan))

    def count(cond):
        return F.sum(F.when(cond, F.col("n")).otherwise(0))

    inside = F.expr("failures & mask")
    kept = F.bit_count(inside) <= F.col("allowed")
    without = F.bit_count(F.expr("failures & mask & ~bit")) <= F.col("allowed")
    return each.groupBy("policy", "version", "rule").agg(
        count(kept).alias("kept"), count(without).alias("kept_without"), count(inside == F.col("bit")).alias("only_this"))


def judged(docs: DataFrame, policy: Policy = STRICT_V2) -> DataFrame:
    """The ledger with `base_failed` and the verdict `kept` of a policy."""
    failed = ~keeps(BASE)
    return ledger(docs).select("doc_id", *_MEASURES[:5], failed.alias("base_failed"), (~failed & keeps(policy)).alias("kept"),
                               *_MEASURES[5:], "failures", F.lit(f"{policy.name}/{policy.version}").alias("policy"))
