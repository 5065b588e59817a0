"""Leaks against an alignment of every item at every place, planted copies with substitutions, clean texts left alone."""

import random
import re

from sparkloom.llm import spaced_seeds as s


def brute(text, item, min_words=10):
    a, b = re.findall(r"[^\W_]+", item.lower()), re.findall(r"[^\W_]+", text.lower())
    best = 0
    for shift in range(-len(a) + 1, len(b)):
        same = [b[i + shift] == a[i] if 0 <= i + shift < len(b) else None for i in range(len(a))]
        gain = agree = 0
        top = (0, 0)
        for x in same:
            gain, agree = (0, 0) if x is None else (gain + (1 if x else -4), agree + bool(x))
            if gain <= 0:
                gain = agree = 0
            top = max(top, (gain, agree))
        best = max(best, top[1])
    return best >= min(min_words, len(a))


def made(r, n):
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 7))) for _ in range(n))


def test_planted_items_are_found_and_clean_texts_are_not(spark):
    r = random.Random(2)
    items = [made(r, r.randrange(15, 60)) for _ in range(30)] + ["one two three four five six", "too short"]
    rows, planted = [], set()
    for d in range(200):
        text = made(r, r.randrange(0, 300))
        if d % 4 == 0:
            k = r.randrange(len(items) - 1)
            w = items[k].split()
            if len(w) > 12:
                for _ in range(len(w) // 12):
                    w[r.randrange(len(w))] = "Changed!"
            text = text[:50] + ". " + " ".join(w).upper() + ", " + text[50:]
            planted.add((d, k))
        rows.append((d, text, "x"))
    rows += [(1000, None, "x"), (1001, "", "x"), (None, items[0], "x"), (1002, "too short", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([*enumerate(items), (99, None), (98, "")], "item_id long, text string")
    for block in (200_000, 300):
        got = s.find_leaks(docs, bench, block_words=block).collect()
        pairs = {(x.doc_id, x.item_id) for x in got}
        assert planted | {(None, 0)} == pairs
    want = {(d, k) for d, t, _ in rows[:60] for k, item in enumerate(items[:-1]) if brute(t, item)}
    assert want == {p for p in pairs if p[0] is not None and p[0] < 60}
    left = s.clean(docs, bench)
    assert left.columns == docs.columns
    assert {x.doc_id for x in left.collect()} == {d for d, *_ in rows if d is not None} - {d for d, _ in planted}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string")
    assert s.find_leaks(none, bench).count() == s.find_leaks(some, bench).count() == 0
    assert s.clean(some, bench).count() == 1


def test_every_overlap_that_verification_accepts_holds_a_seed():
    r = random.Random(8)
    cases = []
    for _ in range(150):
        w = made(r, r.randrange(10, 40)).split()
        other = made(r, 30).split()
        cut = r.randrange(8, 13)
        # either end of an item in the middle, at the start and at the end of a text, and alone
        for part in (w[:cut], w[-cut:]):
            cases += [(" ".join(before + part + after), w) for before in ([], other) for after in ([], other)]
    for n in (5, 6, 7, 8, 9, 10, 11, 12, 13, 15, 20, 30):  # substitutions anywhere
        for _ in range(80):
            w = made(r, n).split()
            text = list(w)
            for i in r.sample(range(n), r.randrange(0, 1 + n // 5)):
                text[i] = "changed"
            before, after = made(r, r.choice((0, 5))), made(r, r.choice((0, 5)))
            cases.append((" ".join([before, *text, after]), w))
    found = 0
    for text, w in cases:
        for min_words in (10, 7):
            want = brute(text, " ".join(w), min_words)
            got = s.overlaps(text, s.build_index([(1, " ".join(w))], min_words), min_words)
            assert bool(got) == want, (text, w, min_words)
            found += want
    assert found > 1000


def test_first_and_last_words_and_short_texts(spark):
    item = " ".join(f"w{i}" for i in range(30))
    eleven = " ".join(f"v{i}" for i in range(11))
    texts = [" ".join(f"w{i}" for i in range(20, 30)), "x " * 40 + " ".join(f"w{i}" for i in range(19, 30)) + " y" * 40,
             "x " * 40 + " ".join(f"w{i}" for i in range(10)), eleven.replace("v0 ", "z "), eleven.replace("v5", "z"), "w1 w2 w3 w4 w5 w6"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(0, item), (1, eleven)], "item_id long, text string")
    got = {(x.doc_id, x.item_id, x.agreeing_words) for x in s.find_leaks(docs, bench).collect()}
    assert got == {(0, 0, 10), (1, 0, 11), (2, 0, 10), (3, 1, 10), (4, 1, 10)}
