"""Site style trees against a recursion over whole trees, and extraction from pages written by hand."""

import math
import random
from collections import Counter, defaultdict

import pytest

from sparkloom.llm import site_style_tree as sst

SCHEMA = "page_id long, url string, html string, site long, text string, n_chars int, gone string, host string, key int, role int"


def table(spark, rows):
    return spark.createDataFrame([(i, u, h, 1, "t", 2, "g", "h", 3, 4) for i, u, h in rows], SCHEMA).repartition(4)


def texts(spark, rows):
    got = sst.main_text(table(spark, rows)).collect()
    assert len(got) == len(rows) and all(x.n_chars == len(x.text) for x in got)
    return {x.page_id: x.text for x in got}


PAGES = [
    ("<nav><ul><li>Home<li>About</ul></nav><article><h1>T &amp; U</h1><p>one\n two<p><b>three<br>four</article><footer>&copy; x</footer>",
     "T & U\none two\nthree four"),
    ("<html><head><title>no</title><style>p{}</style><script>var a='</p>'</script></head><body><!-- c --><main><header><h2>Head</h2></header>"
     "<p>a&nbsp;b &lt;i&gt; <a href=x>link</a>ed</p><aside>side</aside><section id=comments><p>first!</section></main>", "Head\na b <i> linked"),
    ("<header>site</header><div class='Cookie-Notice'>we use</div><div class=content><p>kept</p><div class=\"adBox\">buy</div></div>"
     "<form>name <input> <button>go</button></form>", "kept"),
    ("<article><p>x <span class=ad>buy <span>now</span></span> y</p><ul><li>i</li><li>ii</ul><table><tr><td>c1<td>c2</table><pre>a\n  b</pre></article>",
     "x y\ni\nii\nc1\nc2\na b"),
    ("<p>a <b>bold <p>next</b> on</p> tail", "a bold\nnext on\ntail"),
    ("<article><p hidden>h</p><p style='display: none'>n</p><div aria-hidden=TRUE>z</div><p role=article class=nav>k</p></article>", "k"),
    ("a < b && c <3 <!-- never closed <p>x", "a < b && c <3"),
    ("<p>shown</p><script>x", "shown"), ("<article><p>q</p><a title=\"never closed>r</a><p>s</p></article>", "q\nr\ns"),
    ("", ""), (None, ""), ("<div></div>", ""), ("  \n ", ""), ("plain", "plain"), ("<article><p>1</p>\n<p> </p><hr>2</article>", "1\n2"),
]


def test_pages_by_hand(spark):
    rows = [(i, f"http://h{i}.example/x", h) for i, (h, _) in enumerate(PAGES)] + [(100, None, "<p>no url"), (101, "nohost", "<p>b"), (102, "", None)]
    got = texts(spark, rows)
    assert [got[i] for i in range(len(PAGES))] == [t for _, t in PAGES]
    assert (got[100], got[101], got[102]) == ("no url", "b", "")


def site(n, r):
    """Pages whose layout has no telling names: the same menu, one of three slogans, and a text of its own."""
    out = []
    for i in range(n):
        words = [" ".join(r.choices("alpha beta gamma delta epsilon zeta eta theta".split(), k=6)) + f" {i}{'abc'[j]}" for j in range(r.randint(1, 3))]
        html = ("<body><div class=top><ul><li>Start<li>Shop<li>Help</ul></div>" + "<div class=text>" + "".join(f"<p>{w}</p>" for w in words) + "</div>"
                + f"<div class=low>{r.choice(['Join us', 'Call now', 'Be happy'])}</div></body>")
        out.append((html, "\n".join(words).replace(str(i), str(i))))
    return out


def test_layout_without_names_goes(spark):
    r = random.Random(3)
    made = site(120, r)
    made = [(h.replace(f" {i}a", f" a{chr(97 + i % 26)}{i // 26 * 'x'}"), t.replace(f" {i}a", f" a{chr(97 + i % 26)}{i // 26 * 'x'}")) for i, (h, t) in enumerate(made)]
    rows = [(i, f"https://user@Site.example:80/{i}?q=//other", h) for i, (h, _) in enumerate(made)] + [(999, "https://lone.example", made[0][0])]
    got = texts(spark, rows)
    assert [got[i] for i in range(120)] == [t for _, t in made]
    assert got[999].startswith("Start\nShop\nHelp\n") and got[999].count("\n") == made[0][1].count("\n") + 4  # one page proves nothing


def brute(pages):
    """{key: (own, whole, most)} of one site by entropies over lists and a recursion over every page's tree."""
    own, styles, found, role, uses = {}, defaultdict(list), defaultdict(list), {}, Counter()
    held = defaultdict(set)
    for n, p in enumerate(pages):
        kids = defaultdict(list)
        for i, up in enumerate(p.parent[1:], 1):
            kids[up].append(i)
        p.kids = kids
        for i, key in enumerate(p.key):
            role[key] = p.role[i]
            uses[key] += 1
            held[key].add(n)
            labels = [p.label[c] for c in kids[i]]
            styles[key].append(tuple(x for k, x in enumerate(labels) if not k or labels[k - 1] != x))
        for pieces in p.blocks:
            for node, t in pieces:
                if t.split():
                    found[p.key[node]].append((" ".join("".join("0" if c.isdigit() else c for c in t).split()).replace("00", "0"), n))
    for key in uses:
        if found[key]:
            m, value = len(held[key]), 1.0
            if m > 1:
                spread = 0.0
                for text in {t for t, _ in found[key]}:
                    on = Counter(n for t, n in found[key] if t == text)
                    total = sum(on.values())
                    spread += total * -sum(f / total * math.log(f / total, m) for f in on.values())
                value = 1 - spread / len(found[key])
        else:
            m, value = uses[key], 1.0
            if m > 1:
                value = -sum(c / m * math.log(c / m, m) for c in Counter(styles[key]).values())
        e = 1 - (m - 1) / (m - 1 + sst.DOUBT) * (1 - value)
        own[key] = {sst.NEUTRAL: e, sst.ARTICLE: .75 + .25 * e, sst.BOX: .4 + .6 * e, sst.NOISE: .25 * e}[role[key]]
    whole, below = defaultdict(list), defaultdict(set)
    for p in pages:
        def walk(i, p=p):
            key, inner = p.key[i], [walk(c) for c in p.kids[i]]
            value = own[key] if not inner else (1 - sst.DAMPING) * own[key] + sst.DAMPING * sum(v for v, _ in inner) / len(inner)
            keys = {key}.union(*(k for _, k in inner))
            whole[key].append(value)
            below[key] |= keys
            return value, keys
        walk(0)
    whole = {k: sum(v) / len(v) for k, v in whole.items()}
    return {k: (own[k], whole[k], max(max(whole[x], own[x] if found[x] else 0) for x in below[k])) for k in own}


@pytest.mark.parametrize("seed", [1, 2])
def test_importance_equals_recursion(spark, seed):
    r = random.Random(seed)

    def part(deep):
        if deep > 4 or r.random() < .3:
            return r.choice(["same ", "other 9 ", f"own {r.choice('abcdefgh')}{r.choice('abcdefgh')} ", ""])
        tag = r.choice(["div", "div class=x", "p", "ul", "article", "nav", "section id=y", "li", "div class=ad", "b"])
        return f"<{tag}>" + "".join(part(deep + 1) for _ in range(r.randint(0, 3))) + f"</{tag.split()[0]}>"

    rows = [(i, f"http://s{i % 2}.example/", "".join(part(0) for _ in range(4))) for i in range(60)]
    got = {(x.site, x.key): (x.own, x.whole, x.most) for x in sst.importance(sst.style_trees(table(spark, rows))).collect()}
    sites = {x.url: x.site for x in sst._with_sites(table(spark, rows)).collect()}
    want = {}
    for url, number in sites.items():
        want |= {(number, k): v for k, v in brute([sst.Page(h, number) for _, u, h in rows if u == url]).items()}
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=1e-6)


def test_whole_table(spark, sf):
    import html
    import re

    import __spark_entry__ as entry
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = {x.page_id: x.text for x in entry.queries()["op11_site_style_tree"](spark, sf).collect()}
    for x in pages.collect():
        article = re.search(r"<article>(.*)</article>", x.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("</?b>", "", b)).split()) for b in re.split("</?(?:h1|p)>|<br>", article))
        assert got[x.page_id] == "\n".join(b for b in blocks if b)


def test_empty_and_very_long(spark):
    assert sst.main_text(table(spark, []).limit(0)).collect() == []
    rows = [(1, "http://a.b/", "<p>" + "x" * 5_000_000), (2, "http://a.b/", "<div>" * 200_000 + "deep"), (3, "http://a.b/", "<a \"" * 500_000),
            (4, "http://a.b/", "<b>" * 300_000 + "bold"), (4, "http://a.b/", "<li>x " * 50_000), (5, "http://a.b/", "<" * 2_000_000)]
    got = {(x.page_id, x.n_chars) for x in sst.main_text(table(spark, rows)).collect()}
    assert got == {(1, 5_000_000), (2, 4), (3, 0), (4, 4), (4, 99_999), (5, 2_000_000)}
