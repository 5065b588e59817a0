"""Spelling variants against all pairs, with and without divided buckets."""

import random
import re
import zlib
from collections import Counter

import pytest

from sparkloom.llm import spelling_partenum as sp

SCHEMA = "doc_id long, text string, word string, n string, form int, root long, n_near int, form_n int, m int, side int, key long, hot int, best int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark, rows):
    return spark.createDataFrame([(d, t, "w", "n", 1, 2, 3, 4, 5, 6, 7, 8, 9) for d, t in rows], SCHEMA).repartition(4)


def apart(x, y):
    """Edit distance by the whole matrix."""
    row = list(range(len(y) + 1))
    for i, c in enumerate(x, 1):
        row, before = [i], row
        for j, d in enumerate(y, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (c != d)))
    return row[-1]


def brute(rows, min_chars, min_count, times):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= min_chars and c >= min_count}
    near = {w: [x for x in n if abs(len(x) - len(w)) < 2 and apart(w, x) == 1] for w in n}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= times * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return out


def made(seed, docs):
    r = random.Random(seed)
    letters = "abcdeéßÀ"
    base = ["".join(r.choices(letters, k=r.randint(5, 9))) for _ in range(40)] + ["aaaaaa", "aaaaaaa", "abababab", "babababa", "aabbaabb"]
    words = []
    for w in base:
        words += [w] * 30
        for _ in range(12):
            v = list(w)
            for _ in range(r.randint(1, 2)):
                at = r.randrange(len(v))
                v[at:at + r.randint(0, 1)] = r.choice(["", "a", "b", "e", "ß"])
            words += ["".join(v)] * r.randint(1, 7)
    r.shuffle(words)
    step = len(words) // docs + 1
    return [(i, r.choice([" ", "-", "1", "×Ā "]).join(words[i * step:(i + 1) * step]).replace("e", r.choice("eE"))) for i in range(docs)]


@pytest.mark.parametrize("hot", [50_000, 3])
def test_equals_all_pairs(spark, hot):
    rows = made(5, 30) + [(500, None), (501, ""), (None, "abcdef abcdef abcdef abcdef abcdef"), (7, "abcdeg " * 40), (7, "abcdeg " * 40),
                             (600, "chainaa " * 100 + "chainab " * 20 + "chaibab " * 4)]
    got = [tuple(x) for x in sp.variants(table(spark, rows), 5, 3, 4, hot).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    want = brute(rows, 5, 3, 4)
    assert len(got) == len(set(got)) and set(got) == want
    assert sum(x[4] > 3 for x in want) > 20 and any(x[1] and x[2] != x[1] for x in want)


def test_every_near_pair_counts_once():
    r = random.Random(2)
    words = sorted({"".join(r.choices("abe", k=r.randint(1, 6))) for _ in range(500)})
    keys = sp.signatures(words)
    found = Counter()
    by = {}
    for i, _ in enumerate(words):
        for s in range(len(sp.SIGNATURES)):
            by.setdefault((s, int(keys[i, s])), []).append(i)
    import numpy as np
    for (s, key), rows in by.items():
        zero = np.zeros(len(rows), np.int64)
        a, b = sp.near_pairs([words[i] for i in rows], zero + s, zero, zero, np.full(len(rows), key, np.uint64))
        found.update(tuple(sorted((rows[x], rows[y]))) for x, y in zip(a, b, strict=True))
    want = {(i, j) for i, w in enumerate(words) for j in range(i + 1, len(words)) if apart(w, words[j]) == 1}
    assert found == Counter(want)


def test_slips_and_one_apart():
    runs = [f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(676)]
    slips = 0
    for i, w in enumerate(runs):
        h = zlib.crc32(f"{i}:{w}".encode())
        got = sp.slipped(i, w, zlib.crc32(f"{i}:".encode()))
        slips += got != w
        assert len(got) == len(w) - (h % 199 == 0)
    assert slips
    for x, y in [("ab", "ab"), ("ab", "abc"), ("abb", "ab"), ("abc", "adc"), ("abc", "acb"), ("", "a"), ("a", ""), ("ab", "abcd")]:
        assert sp.one_apart(x, y) == (apart(x, y) == 1)


def test_empty_and_very_long(spark):
    assert sp.variants(table(spark, []).limit(0)).collect() == []
    rows = [(1, "a" * 5_000_000), (2, "abcdefg " * 600_000), (3, "abcdef " * 6)]
    got = {x.word: (x.n, x.n_near, x.form) for x in sp.variants(table(spark, rows)).collect()}
    assert got == {"abcdefg": (600_000, 1, None), "abcdef": (6, 1, "abcdefg")}
