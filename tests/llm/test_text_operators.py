"""Ledger, SimHash, classifier, sharding and line dedup: brute force and the rows nobody expects."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sparkloom.llm import common, line_mph, rendezvous, rule_ledger, simhash_ball, subword_classifier

DOCS = "doc_id long, text string, n_words long, shard int, fp string"


def table(spark, rows):
    return spark.createDataFrame([(d, t, 1, 2, "x") for d, t in rows], DOCS).repartition(3)


ODD = [(900, None), (901, ""), (902, " \n\t"), (903, "one"), (904, "x" * 200_000), (905, "rep " * 50_000), (None, "no id"), (None, None),
       (906, "twice twice"), (906, "twice twice")]


# -- ledger


def brute_repeat(words):
    grams = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    hit = set()
    for i in range(len(words) - 7):
        if grams[tuple(words[i:i + 8])] > 1:
            hit |= set(range(i, i + 8))
    return len(hit)


def test_repeat_words():
    r = random.Random(1)
    for n in [0, 1, 7, 8, 9, 16, 60, 300]:
        for k in (1, 2, 3, 40):
            words = [r.choice("abcdefghijklmnopqrstuvwxyz"[:min(26, k)]) for _ in range(n)]
            assert rule_ledger.repeat_words(words) == brute_repeat(words)


def test_ledger_policies_and_ablations(spark):
    clean = " ".join(f"word{i}x" for i in range(40))
    rows = [(1, clean), (2, "few words"), (3, "be " * 60), (4, clean.replace(" ", "### ")), (5, clean.upper())] + ODD
    df = table(spark, rows)
    got = {r.doc_id: r for r in rule_ledger.judged(df).collect()}
    assert [got[i].kept for i in (1, 2, 3, 4, 5)] == [True, False, False, False, False]
    assert [got[i].base_failed for i in (1, 2, 3, 4, 5)] == [False, True, True, False, False]
    assert got[900].n_words == 0 and got[905].n_repeat_words == 50_000 and got[904].word_chars == 200_000
    book = common.staged(rule_ledger.ledger(df), "ledger")
    report = rule_ledger.ablations(book, [rule_ledger.BASE, rule_ledger.STRICT_V2]).collect()
    bits = [r.failures for r in book.collect()]
    for r in report:
        policy = {"base": rule_ledger.BASE, "strict": rule_ledger.STRICT_V2}[r.policy]
        bit = 1 << rule_ledger.RULE_NAMES.index(r.rule)
        assert r.kept == sum(not b & policy.mask for b in bits)
        assert r.kept_without == sum(not b & policy.mask & ~bit for b in bits)
        assert r.only_this == sum(b & policy.mask == bit for b in bits)
    assert rule_ledger.judged(df.limit(0)).count() == 0


# -- SimHash


def brute_print(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = common.WORD.findall(lower)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    votes = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(shingles))


def brute_components(prints):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    return {p: find(p) for p in prints}


def test_simhash_equals_brute_force(spark):
    r = random.Random(3)
    base = [[r.choice(["Ab", "cd", "é", "fgh", "I", "jk,"]) + str(r.randrange(30)) for _ in range(r.choice([2, 5, 80, 150]))] for _ in range(12)]
    rows = []
    for d in range(150):
        w = list(r.choice(base))
        for _ in range(r.randrange(3)):
            w[r.randrange(len(w))] = "changed"
        rows.append((d, " ".join(w)))
    rows += [x for x in ODD if x[0] != 905] + [(907, "REP " * 9)]
    got = simhash_ball.near_duplicates(table(spark, rows), part_variants=3000).collect()
    prints = [(d, brute_print(t)) for d, t in rows]
    roots = brute_components(sorted({p for _, p in prints}))
    least = {}
    for d, p in prints:
        if d is not None:
            least[roots[p]] = min(d, least.get(roots[p], d))
    want = Counter((d, f"{p:016x}", least.get(roots[p])) for d, p in prints)
    assert Counter((x.doc_id, x.fingerprint, x.component_id) for x in got) == want
    kept = simhash_ball.drop_near_duplicates(table(spark, rows))
    assert {x.doc_id for x in kept.collect() if x.doc_id is not None} == {x.component_id for x in got if x.component_id is not None}


def test_balls_find_every_distance(spark):
    """Chains in the ball graph against all pairs, with distances of one to four in one block or several."""
    r = random.Random(4)
    prints = {0, 2**64 - 1}
    for _ in range(60):
        x = r.getrandbits(64)
        prints.add(x)
        for _ in range(3):
            block = r.choice([None, 0, 1, 2, 3])
            places = range(64) if block is None else range(16 * block, 16 * block + 16)
            for b in r.sample(list(places), r.choice([1, 2, 3, 3, 4])):
                x ^= 1 << b
            prints.add(x)
    df = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in prints], "fp long")
    roots = brute_components(sorted(prints))
    got = {x.node % 2**64: x.root % 2**64 for x in common.components(simhash_ball.links(df, 5000)).collect()}
    groups = {}
    for p in prints:
        groups.setdefault(got.get(p, p), set()).add(p)
    want = {}
    for p in prints:
        want.setdefault(roots[p], set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_components_of_chains_hubs_and_nothing(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1200)] + [(7, 7), (-5, -9)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1200)}, -5: -9, -9: -9}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- classifier


def test_classifier_learns_and_holds_out(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = {r.doc_id: r for r in subword_classifier.quality(docs, labels).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in got.items())
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in got.values())
    out = [d for d in truth if got[d].held_out]
    assert sum(got[d].predicted == truth[d] for d in out) >= 0.9 * len(out)


def test_classifier_ignores_held_out_labels_and_odd_rows(spark):
    rows = [(d, "good plain text here" if d % 2 else "bad!!! BAD### stuff***") for d in range(60)] + ODD
    labels = [(d, d % 2, d) for d in range(60)] + [(1, None, 0), (None, 1, 0), (5, 1, 0), (777, 0, 0)]
    flipped = [(d, 1 - q if d is not None and q is not None and zlib.crc32(str(d).encode()) % 3 == 1 else q, x) for d, q, x in labels]
    df = table(spark, rows)
    out = []
    for lab in (labels, flipped):
        got = subword_classifier.quality(df, spark.createDataFrame(lab, "doc_id long, quality int, text long"))
        out.append(sorted((str(r.doc_id), r.score) for r in got.collect()))
    assert out[0] == out[1] and len(out[0]) == len(rows)
    assert all((s >= 0.5) == bool(int(d) % 2) for d, s in out[0] if d.isdigit() and int(d) < 60)
    nothing = subword_classifier.quality(df, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in nothing.collect()} == {0.5}
    assert subword_classifier.quality(df.limit(0), spark.createDataFrame(labels, "doc_id long, quality int, text long")).count() == 0


def test_features_of_pieces_add_up(monkeypatch):
    text = " ".join(random.Random(2).choice(["ab", "cde", "é"]) for _ in range(400))
    whole = [np.sort(f) for f in subword_classifier.features(text, [])]
    monkeypatch.setattr(common, "PIECE", 100)
    last = []
    parts = [list(subword_classifier.features(p, last)) for p in common.pieces(text)]
    assert "".join(common.pieces(text)) == text and len(parts) > 5
    for kind in range(4):
        assert (np.sort(np.concatenate([p[kind] for p in parts])) == whole[kind]).all()


# -- sharding


def test_sharding(spark):
    rows = [(d, f"text {d}") for d in range(10_000, 13_000)] + [x for x in ODD if x[0] != 906]
    weights = [1.0, 1.0, 2.0, 4.0]
    got = rendezvous.shard_records(table(spark, rows), weights).collect()
    assert len(got) == len(rows)
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.grown_shard in (r.shard, 4)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    n = Counter(r.shard for r in got)
    assert all(abs(n[s] / len(rows) - w / 8) < 0.05 for s, w in enumerate(weights))
    assert abs(sum(r.grown_shard == 4 for r in got) / len(rows) - 1 / 9) < 0.04
    texts = {d: t for d, t in rows if d is not None}
    for r in got:
        if r.doc_id is not None:
            raw = (texts[r.doc_id] or "").encode()
            assert (r.size, r.text_crc32, r.law) == (len(raw) + 16, zlib.crc32(raw), "key")
    plain = rendezvous.shard_records(table(spark, rows).limit(0), weights, None)
    assert plain.count() == 0 and dict(plain.dtypes)["grown_shard"] == "int"
    assert "Python" not in plain._jdf.queryExecution().toString() and "Arrow" not in plain._jdf.queryExecution().toString()


# -- lines


def test_lines_equal_brute_force(spark):
    r = random.Random(5)
    pool = ["a common line here", "A Common Line Here ", "\tshort", "ninechars", "ten chars!", "ééééééééé", "éééééééééé", "", "  "] + [f"line number {i}" for i in range(40)]
    rows = [(d * 3 % 101, "\n".join(r.choice(pool) for _ in range(r.randrange(12)))) for d in range(100)]
    rows += [(500, None), (501, ""), (None, "a common line here"), (502, "x" * 100_000), (502, "x" * 100_000), (503, "y\r\na common line here\r")]

    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    owners = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            if d is not None and len(key(line)) >= 10:
                owners.setdefault(key(line), set()).add(d)
    want = Counter()
    for d, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if d is None or len(key(x)) < 10 or len(owners[key(x)]) < 2 or min(owners[key(x)]) == d]
        want[d, len(lines), len(lines) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()] += 1
    got = line_mph.dedup_lines(table(spark, rows), carry=["fp"])
    assert Counter((x.doc_id, x.n_lines, x.n_dropped, x.kept_sha256) for x in got.collect()) == want
    assert all(hashlib.sha256(x.text.encode()).hexdigest() == x.kept_sha256 and x.fp == "x" for x in got.collect())
    assert line_mph.dedup_lines(table(spark, []).where(F.lit(False))).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 20_000])
def test_perfect_hash_is_minimal(n):
    keys = np.random.default_rng(n).integers(0, 1 << 63, (n, 2), dtype=np.uint64)
    if n > 2:
        keys[1, 0] = keys[0, 0]  # halves may be equal
    levels = line_mph.build_mph(keys)
    assert sorted(line_mph.mph_slots(levels, keys).tolist()) == list(range(n))


def test_long_texts_are_cut_behind_white_space_only(monkeypatch):
    r = random.Random(6)
    text = "".join(r.choice(["\t", "\n", " ", "ab", "c" * 30]) for _ in range(2000))
    whole = subword_classifier.counts(text)
    monkeypatch.setattr(common, "PIECE", 16)
    parts = list(common.pieces(text))
    assert "".join(parts) == text and len(parts) > 100 and all(x[-1] in " \t\n" for x in parts[:-1])
    got = subword_classifier.counts(text)
    assert all((a == b).all() for a, b in zip(got, whole, strict=True))  # no pair of words is lost between pieces
    assert list(common.pieces("x" * 5_000_000)) == ["x" * 5_000_000]


def test_scores_equal_the_softmax_of_averaged_vectors():
    """The collapsed score against vectors that are averaged and sent through layer and softmax."""
    r = np.random.default_rng(1)
    matrix, layer = r.normal(size=(subword_classifier.BUCKETS, 5)), r.normal(size=(2, 5))
    texts = ["", "one", "two words", "a b a b a b", "long " * 2000, "\u00e9t\u00e9 caf\u00e9"]
    values = matrix @ (layer[1] - layer[0])
    for t, z in zip(texts, subword_classifier._sums(texts, values), strict=True):
        buckets, shares = subword_classifier.counts(t)
        logits = layer @ (shares.astype(float) @ matrix[buckets])
        want = np.exp(logits - logits.max())
        assert 1 / (1 + np.exp(-z)) == pytest.approx(want[1] / want.sum(), abs=1e-6)


def test_rows_that_share_an_id_teach_once(spark):
    docs = spark.createDataFrame([(d, f"text {i % 5}") for d in range(8) for i in range(10)], "doc_id long, text string")
    labels = spark.createDataFrame([(d, d % 2) for d in range(8)], "doc_id long, quality int")
    known = {r.doc_id for r in docs.where(~subword_classifier.held_out()).select("doc_id").distinct().collect()}
    assert len(subword_classifier.sample_of(docs, labels)) == len(known) > 0
