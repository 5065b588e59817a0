"""Divergences of sources against a dense computation in whole numbers."""

import random
import re
from collections import Counter, defaultdict

from sparkloom.llm import divergence_audit

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n long, term string, rank int, value string, p long, g int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, a, b, 5, "x", 1, "y", 2, 3) for i, t, a, b in rows], SCHEMA).repartition(5)


def brute(rows, min_docs, top):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = [t.translate(LOWER) for t in TERM.findall(text or "")]
        counts[lang, source].update(found)
        docs[lang].update(set(found))
        groups[lang].add(source)
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        v = len(kept)

        def shares(names, kept=kept, v=v, lang=lang):
            held = {t: sum(counts[lang, s][t] for s in names) for t in kept}
            total = sum(held.values())
            return {t: 1 + 10 ** 9 * (held[t] + 2) // (total + 2 * v) for t in kept}

        q, p = shares(sources), {s: shares([s]) for s in sources}
        for s in sources:
            pair = [(sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept), o) for o in sources - {s}]
            term = [((p[s][t] - q[t]) ** 2 // (p[s][t] + q[t]), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pair, None), ("term", term, top)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out |= {(lang, s, part, item, value, i) for i, (value, item) in enumerate(ranked, 1)}
    return out


def rows_of(df):
    found = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(found) == len(set(found))
    return set(found)


def test_equals_dense_computation(spark):
    r = random.Random(4)
    words = [f"{a}{b}" for a in ("Ab", "cé", "ß", "日本", "x") for b in ("", "q", "ÉZ", "tt", "uvw")]
    rows = [(i, r.choice([" ", "-", "\x7f", "3"]).join(r.choices(words, k=r.randint(0, 30))), r.choice(["en", "de", None]),
             r.choice(["a", "b", "c", "ä", "B", None])) for i in range(160)]
    rows += [(1000, "zz only here", "en", "lone"), (1001, None, "fr", "empty"), (1002, "one two", "fr", "few"), (None, "Ab cé", "de", "a")]
    rows += rows[:10]
    for min_docs, top in ((3, 4), (10, 10), (10 ** 6, 3)):
        assert rows_of(divergence_audit.audit(table(spark, rows), min_docs, top)) == brute(rows, min_docs, top)


def test_tiles_and_early_sums_change_nothing(spark, monkeypatch):
    rows = [(i, f"w{'abcdefgh'[i % 8]} wa " * (i % 5), "en", f"s{i % 13}") for i in range(120)]
    df = table(spark, rows)
    want = rows_of(divergence_audit.audit(df, 2))
    assert want == brute(rows, 2, 10)
    kept = divergence_audit.terms("A b\tB")
    assert kept == Counter({b"a": 1, b"b": 2})
    small = [{"lang": "x", "found": [{"g": g, "p": 10 + g * i, "p0": 3 + g} for g in range(1, 6)]} for i in range(1, 4)]
    import pyarrow as pa
    kinds = pa.struct([("g", pa.int32()), ("p", pa.int64()), ("p0", pa.int64())])
    batch = pa.RecordBatch.from_pydict({"lang": pa.array([x["lang"] for x in small]), "found": pa.array([x["found"] for x in small], pa.list_(kinds))})

    def total():
        sums = Counter()
        for part in divergence_audit._together([batch]):
            for x in part.to_pylist():
                sums[x["a"], x["b"]] += x["value"]
        return sums

    whole = total()
    monkeypatch.setattr(divergence_audit, "CELLS", 8)
    assert total() == whole and len(whole) == 20


def test_empty_and_very_long(spark):
    assert rows_of(divergence_audit.audit(table(spark, []).limit(0))) == set()
    rows = [(1, "A" * 5_000_000, "en", "a"), (2, "a b " * 1_000_000, "en", "b"), (3, "", "en", "c")]
    assert rows_of(divergence_audit.audit(table(spark, rows), 1)) == brute(rows, 1, 10)
