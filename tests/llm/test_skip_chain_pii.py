"""Base spans against the patterns, agreement of distant mentions, and edge cases."""

import hashlib
import random

import numpy as np

from sparkloom.llm import skip_chain_pii as p

CARD = "4111111111111111"


def text_of(r, n):
    return " ".join("".join(r.choice("abcdefg") for _ in range(5)) for _ in range(n))


def corpus(n=300):
    r = random.Random(1)
    rows = []
    for d in range(n):
        t = text_of(r, 30)
        card = CARD[:-6] + str(r.randrange(10**5)).zfill(5)
        card += next(str(x) for x in range(10) if p.luhn(card + str(x)))
        kind = d % 6
        t += " " + [f"a{d}@mail.example.com", f"10.0.{d % 250}.7", card, f"+1 (555) 555-{1000 + d}", f"in {1900 + d % 100} of {d} x", "none"][kind] + " "
        t += text_of(r, 10)
        if kind == 2 and d % 12 == 2:  # a second mention that runs into another number
            t += f" pay {card} 2024 now"
        rows.append((d, t, card))
    return rows


def test_base_spans():
    t = "x a.b@c.de, 1.2.3.4 300.1.1.1 a 4111-1111 1111-1111 x 4111111111111112 +1 (555) 555-0100 +12 3"
    got = p._named(p.base_spans(t))
    assert got == "email:2:10,ip:12:19,card:32:51,phone:71:88"
    assert p.base_spans("") == [] and p.base_spans("9" * 5000 + ".1.1.1") == []
    assert [k for _, k, _ in p.base_spans("01.002.3.4 1.2.3.4.5")] == [1, 1]


def test_distant_mentions_agree(spark):
    rows = corpus()
    df = spark.createDataFrame([(d, t, "x") for d, t, _ in rows] + [(1000, None, "x"), (1001, "", "x"), (None, "a@b.co", "x"), (1003, "x", "y"), (1003, "x", "y")],
                               "doc_id long, text string, spans string")
    got = {(r.doc_id, r.n_added): r for r in p.find_personal(df).collect()}
    by = {r.doc_id: r for r in got.values() if r.base_sha256}
    for d, t, card in rows:
        base = p.base_spans(t)
        hit = [r for (i, _), r in got.items() if i == d and r.base_sha256 == hashlib.sha256(p._named(base).encode()).hexdigest()]
        assert hit and all(x in hit[0].spans for x in p._named(base).split(","))
        if d % 12 == 2:
            at = t.rindex(card)
            assert f"card:{at}:{at + 16}" in hit[0].spans
        else:
            assert hit[0].n_added == 0, (t, hit[0].spans)
    assert by[1000].spans == by[1001].spans == "" and by[None].n_email == 1


def test_no_documents_and_no_signs(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert p.find_personal(none).count() == 0
    plain = spark.createDataFrame([(1, "just words")], "doc_id long, text string")
    assert [(r.n_email, r.spans) for r in p.find_personal(plain).collect()] == [(0, "")]


def test_marginals_of_a_chain_are_exact():
    r = np.random.default_rng(0)
    k, n = len(p.LABELS), 4
    g = p.Graph(np.zeros((n, 2), np.int64), np.zeros(n, np.int64), [[i] for i in range(n)], [[9]] * n,
                np.array([(i, i + 1) for i in range(n - 1)]), np.zeros((0, 3), np.int64))
    m = p.Model(r.normal(size=(p.WEIGHTS, k)), r.normal(size=(k, k)), np.zeros(2))
    want = np.zeros((n, k))
    for y in np.ndindex(*[k] * n):
        w = np.exp(sum(m.weight[[i, 9], y[i]].sum() for i in range(n)) + sum(m.move[y[i], y[i + 1]] for i in range(n - 1)))
        for i in range(n):
            want[i, y[i]] += w
    want /= want.sum(axis=1, keepdims=True)
    assert np.allclose(p.marginals(g, m, rounds=60), want, atol=1e-6)


def plain_spans(text):
    """The patterns as the task words them."""
    import re
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and p.luhn(digits):
            out.append((m.start(), 2, m.end()))
    return sorted(out + [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15])


def test_base_spans_equal_the_plain_patterns():
    r = random.Random(8)
    for alphabet in ("a@.", "a@.%-", "12.", "1.9@ ", "+1 (0)-", "4 1-", "a1@.+ -%("):
        for _ in range(3000):
            t = "".join(r.choices(alphabet, k=r.randint(0, 24)))
            assert p.base_spans(t) == plain_spans(t), t


def test_very_long_runs_take_linear_time():
    import time
    for unit in ("9", "a", "1.", "a@", "+1", "1 ", "+1 ((", "4-", "a.b@", "\t", "x1\t"):
        t = unit * (2_000_000 // len(unit)) + " @"
        start = time.time()
        p.base_spans(t)
        assert time.time() - start < 8, unit
    g = p.graph_of("9" * 5_000_000 + " a@b.cd", p.base_spans("9" * 5_000_000 + " a@b.cd"))
    assert len(g.spans) == 2 and g.label.tolist() == [0, 1]


def test_numbers_in_blocks_meet_at_hubs():
    t = "4111 1111 1111 1111 and later 9 4111 1111 1111 1111 2024 end 55 66"
    g = p.graph_of(t, p.base_spans(t))
    hubs = {}
    for word, hub, kind in g.member.tolist():
        if kind == 2:
            hubs.setdefault(hub, set()).add(word)
    assert {0, 1, 2, 3, 5, 6, 7, 8} in hubs.values()
    alone = p.graph_of("4111 2222 3333 4444 x", [])
    assert not any(k == 2 for _, _, k in alone.member.tolist())


def brute_marginals(g, m):
    """Sums over all labels of all words and hubs."""
    k, n = len(p.LABELS), len(g.spans)
    hubs = sorted({h for _, h, _ in g.member.tolist()})
    want = np.zeros((n, k))
    for y in np.ndindex(*[k] * (n + len(hubs))):
        e = sum(m.weight[a + b, y[i]].sum() for i, (a, b) in enumerate(zip(g.surface, g.context, strict=True)))
        e += sum(m.move[y[a], y[b]] for a, b in g.chain.tolist())
        e += sum(m.agree[kind] * (y[w] == y[n + hubs.index(h)]) for w, h, kind in g.member.tolist())
        for i in range(n):
            want[i, y[i]] += np.exp(e)
    return want / want.sum(axis=1, keepdims=True)


def test_marginals_with_hubs_equal_sums_over_all_labels():
    r = np.random.default_rng(3)
    k = len(p.LABELS)

    def graph(n, chain, member):
        return p.Graph(np.zeros((n, 2), np.int64), np.zeros(n, np.int64), [[i] for i in range(n)], [[9]] * n,
                       np.array(chain, np.int64).reshape(-1, 2), np.array(member, np.int64).reshape(-1, 3))

    for _ in range(3):
        m = p.Model(r.normal(size=(p.WEIGHTS, k)), r.normal(size=(k, k)) * 0.5, r.uniform(0, 2, 3))
        for g in (graph(4, [], [(0, 0, 0), (2, 0, 0), (3, 0, 0)]), graph(4, [(0, 1)], [(1, 0, 2), (3, 0, 2), (3, 1, 1), (2, 1, 1)])):
            assert np.allclose(p.marginals(g, m, rounds=60), brute_marginals(g, m), atol=1e-6)  # no loop: exact
        loop = graph(4, [(0, 1), (1, 2), (2, 3)], [(0, 0, 0), (3, 0, 0)])
        got, want = p.marginals(loop, m, rounds=80), brute_marginals(loop, m)
        assert np.abs(got - want).max() < 0.08 and (got.argmax(axis=1) == want.argmax(axis=1)).mean() >= 0.75


def test_the_sample_is_bounded_in_rows(spark):
    rows = [(1, f"a{i}@b.example") for i in range(50)] + [(2, "x1 " * 1000)]
    got = p.sample_of(spark.createDataFrame(rows, "doc_id long, text string"), sample_chars=30)
    assert len(got) == 2 and max(len(g.spans) for g in got) == 10
