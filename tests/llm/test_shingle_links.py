"""Links of five-word shingles against all pairs, near copies with changed words, a large group of near copies."""

import random

import numpy as np
import pytest

import corpus_pipeline
from sparkloom.llm import shingle_links as s


def brute(rows):
    """(doc_id, smallest doc_id) of texts whose five-word shingles agree by four fifths, over any number of links."""
    sets = []
    for _, text in rows:
        w = (text or "").lower().split()
        k = min(5, len(w))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set())
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a == sets[j] or 5 * both >= 4 * (len(a) + len(sets[j]) - both) > 0:
                group[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[top(i)] = min(doc_id, least.get(top(i), doc_id))
    return {(doc_id, least[top(i)]) for i, (doc_id, _) in enumerate(rows)}


def test_links_equal_all_pairs(spark):
    r = random.Random(5)
    words = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(3000)]
    rows = [(d, t) for d, t in ((900, None), (901, ""), (902, " \n"), (903, "One two"), (904, "one  TWO"), (905, "one two three"))]
    for d in range(60):  # near copies with 1 to 12 changed words in 300, at and around the limit
        w = [r.choice(words) for _ in range(300)]
        rows.append((2 * d, " ".join(w)))
        for i in r.sample(range(300), 1 + d % 12):
            w[i] = r.choice(words)
        rows.append((2 * d + 1, " ".join(w)))
    for first, n, changes in ((1000, 150, 1), (2000, 60, 3)):  # more than a bucket holds; most pairs below the limit
        base = [r.choice(words) for _ in range(200)]
        for d in range(n):
            w = list(base)
            for i in r.sample(range(200), changes):
                w[i] = r.choice(words)
            rows.append((first + d, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert {tuple(x) for x in s.near_duplicates(docs, part_entries=500).collect()} == want
    left = corpus_pipeline.near_duplicate_stage(spark, docs, "")
    assert {x.doc_id for x in left.collect()} == {c for _, c in want}


def test_links_of_the_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(x) for x in docs.select("doc_id", "text").collect()]
    assert {tuple(x) for x in s.near_duplicates(docs).collect()} == brute(rows)


def group(n, changes, length, seed):
    """Near copies of one text, each with changed words; most pairs lie just below the limit."""
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(5000)]
    base = [r.choice(words) for _ in range(length)]
    rows = []
    for d in range(n):
        w = list(base)
        for i in r.sample(range(length), changes):
            w[i] = r.choice(words) + str(d)
        rows.append((d, " ".join(w)))
    return rows


def parts(rows):
    """Components of all pairs, by counting shared shingles over an inverted index."""
    sets = [s.shingles(t) for _, t in rows]
    size = np.array([len(x) for x in sets])
    el, at = np.unique(np.concatenate(sets), return_inverse=True)
    own = np.repeat(np.arange(len(sets)), size)
    rows_of = np.zeros((len(sets), len(el)), np.float32)
    rows_of[own, at] = 1
    both = rows_of @ rows_of.T
    near = 5 * both >= 4 * (size[:, None] + size[None, :] - both)
    label = np.arange(len(sets))
    while True:
        low = np.where(near, label[None, :], len(sets)).min(axis=1)
        if (low == label).all():
            return label, int(near.sum() - len(sets)) // 2
        label = low


@pytest.mark.parametrize("n, changes, length", [(600, 3, 200), (1200, 4, 250), (2400, 6, 400)])
def test_large_groups_lose_no_link(spark, n, changes, length):
    rows = group(n, changes, length, n)
    label, links = parts(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    for members in (s.GROUP, 150) if n == 600 else (1000,):
        got = dict(tuple(x) for x in s.near_duplicates(docs, members=members).collect())
        assert [got[i] for i in range(n)] == label.tolist()
    assert links > n and 1 < len(set(label.tolist())) < n


def test_links_that_leave_a_task_grow_with_the_members():
    made = {}
    for n in (300, 600):
        sets = [s.shingles(t) for _, t in group(n, 1, 200, 1)]
        found = s.forest(sets, np.array([len(x) for x in sets]), np.arange(n))
        made[n] = len(found)
    assert made == {300: 299, 600: 599}


def test_divided_groups_share_no_task(spark):
    rows = group(500, 4, 250, 9)
    sets = [s.shingles(t) for _, t in rows]
    groups = spark.createDataFrame([(7, i, i, len(x), bytearray(x.tobytes())) for i, x in enumerate(sets)], s._GROUPS)
    links, smaller = s.divide(groups)
    size = {r.gid: r["count"] for r in smaller.groupBy("gid").count().collect()}
    assert max(size.values()) <= 250 and sum(size.values()) < 500 * 40
    assert all(s.similar(sets[x.a], sets[x.b]) for x in links.collect())


def test_odd_rows(spark):
    schema = "doc_id long, text string, node long, root long, gid long, els binary, key long, component_id long, size int, part int, at long, least long, salt int"
    rows = [(None, "a b c d e f"), (None, None), (1, "a b c d e f"), (1, "other words here"), (2, "A\tb  c\nd e f"), (3, ""), (4, None), (5, "x" * 5_000_000),
            (6, "\t".join(["y" * 50] * 2 + [f"w{i}" for i in range(400_000)])), (7, "p " + "\t".join(["y" * 50] * 2 + [f"w{i}" for i in range(400_000)]))]
    docs = spark.createDataFrame([(d, t, *([1] * 3), bytearray(b"x"), *([1] * 7)) for d, t in rows], schema).repartition(3)
    got = {(x.doc_id, x.component_id) for x in s.near_duplicates(docs).collect()}
    assert got == {(None, 1), (None, 3), (1, 1), (2, 1), (3, 3), (4, 3), (5, 5), (6, 6), (7, 6)}
    assert s.near_duplicates(docs.limit(0)).collect() == []
    assert s.drop_near_duplicates(docs).columns == docs.columns


def test_the_stage_asks_the_balls_and_verifies_what_they_propose(spark, monkeypatch):
    """A proposed pair links only if its sets are similar; the bands find what is not proposed."""
    r = random.Random(9)
    words = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(200)]
    near = words[:99] + ["changed"] + words[100:]
    rows = [(1, " ".join(words)), (2, " ".join(near)), (3, "some other text of a few words"), (3, "a third text with the same id"), (None, " ".join(words))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    proposed = spark.createDataFrame([(2, 1), (3, 1), (1, 1), (None, 1), (7, 1)], "doc_id long, component_id long")
    told = s._proposed(proposed, s.common.staged(docs.mapInArrow(s._printed, "doc_id long, node long, size int, keys binary"), "printed")).collect()
    assert len(told) == 2 and all(x["a"] < x["b"] for x in told)
    assert sorted(map(str, s.near_duplicates(docs, proposed=proposed).collect())) == sorted(map(str, s.near_duplicates(docs).collect()))
    asked, real = [], corpus_pipeline.simhash_ball.near_duplicates
    monkeypatch.setattr(corpus_pipeline.simhash_ball, "near_duplicates", lambda *a: asked.append(a[1:]) or real(*a))
    left = corpus_pipeline.near_duplicate_stage(spark, docs, "").select("doc_id").collect()
    assert asked == [(5,)] and sorted(x[0] or 0 for x in left) == [0, 1, 3, 3]


def test_members_of_a_proposed_group_link_without_its_first(spark, monkeypatch):
    """Members that are like each other but not like the first of their group link by the proposal alone."""
    r = random.Random(10)
    words = [["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(200)] for _ in range(2)]
    texts = [words[0], words[1], words[1][:99] + ["changed"] + words[1][100:], words[1][:150] + ["other"] + words[1][151:], words[0][:50]]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts, 1)], "doc_id long, text string")
    proposed = spark.createDataFrame([(i, 1) for i in range(1, 6)], "doc_id long, component_id long")
    monkeypatch.setattr(s, "_banded", lambda batches: iter(()))  # nothing comes from the bands
    got = {x["doc_id"]: x["component_id"] for x in s.near_duplicates(docs, proposed=proposed).collect()}
    assert got == {1: 1, 2: 2, 3: 2, 4: 2, 5: 5}
    assert {x["component_id"] for x in s.near_duplicates(docs).collect()} == {1, 2, 3, 4, 5}
