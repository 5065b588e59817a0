"""Main text of web pages by site style trees.

All pages of a host are merged into one tree.  An element of the tree is a path of labels (tag, words of class and id); per
element the tree counts the styles it takes, that is the sequences of labels of its children, and the texts it holds.  Two
entropies tell how much an element matters, both relative to the logarithm of its number of uses:

- presentation: an element that always looks alike is part of the layout; the entropy of its styles is its importance;
- content: a text found on many pages is part of the layout; one less the mean entropy of its texts over pages is its importance.

Elements with text take the content value, others the presentation value; where markup names the role of an element (nav, footer,
class "cookie", article, main) the role is a prior.  The importance of an element with what is below it is its own value and the
mean of its children's, each level down counting for less, averaged over the pages.  A branch goes where no element in it
reaches the threshold, neither with what is below it nor by a text of its own.  Few uses prove little: the distance from 1 grows with them, so a host with one page loses named noise only.

Trees are never gathered.  Tasks read pages and send counts per element, style, text and (element, element below); importance is
a sum over the latter, so no recursion over a tree is needed and a host may hold any share of the pages.  Only branches that go
for their entropies are sent back, as one list per host.

Defined results: null or empty html is an empty text; a null url or one without a host belongs to the host ''; equal pages count
each; unclosed, crossing and unterminated markup is read as browsers do, in time linear in the page, an unterminated comment or
script reaching to its end; text deeper than `DEEPEST` elements belongs to its ancestor there; rows that share a page_id are pages
of their own; an empty table gives no rows; other columns, of whatever name, play no part.
"""

from __future__ import annotations

import html as references
import math
import re
from bisect import bisect_right
from collections import defaultdict
from itertools import groupby

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm import common

DEEPEST = 24
THRESHOLD = 0.5  # less important branches go
DAMPING = 0.9  # weight of what is below an element
DOUBT = 10  # uses at which an entropy counts half
#: Weight of the prior: of an element that its own or an outer name makes noise or article; of unnamed boxes in an article.
NAMED, BOXED = 0.75, 0.4
HELD_FACTS = 300_000

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre search section "
    "select summary table tbody td template tfoot th thead title tr ul script style textarea iframe".split())
IN_HEAD = frozenset("base link meta noscript script style template title".split())
NOISE_TAGS = frozenset("aside button canvas dialog footer form head iframe menu nav noembed noframes noscript object script search "
                       "select style svg template textarea title".split())
ARTICLE_TAGS = frozenset("article main".split())
BOXES = frozenset("div section span center table tbody tr td ul ol".split())
#: Words of class, id and role that name noise, and roles that name the article.
NOISE_WORDS = frozenset(
    "ad ads advert advertisement advertising adverts alert banner breadcrumb breadcrumbs combobox comment comments complementary "
    "consent contentinfo cookie cookies dialog disqus footer form gdpr header login masthead menu menus modal nav navbar "
    "navigation newsletter notice notices pager pagination popup promo promotion related replies respond search searchbox share sharing "
    "sidebar sidebars signup social sponsor sponsored subscribe subscription toolbar widget widgets".split())
ARTICLE_ROLES = frozenset("article main".split())
#: What a start tag closes, and the elements beyond which it does not look.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select",)), "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr",)), "th": (("td", "th"), ("tr",)),
    "tbody": (("thead", "tbody", "tfoot"), ("table",)), "thead": (("thead", "tbody", "tfoot"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot"), ("table",)),
}

NEUTRAL, ARTICLE, BOX, NOISE = 0, 1, 2, 3

_START = re.compile(r"<!--|<(/?)([a-zA-Z][^\s/>]*)|<[!?/]")
_REST = re.compile(r"""(?:[^>"']+|"[^"]*"|'[^']*')*+>""")
_SPEAKS = re.compile(r"class|id|role|hidden|style", re.IGNORECASE)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_CLOSING = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in RAW}
_NAMES: dict[tuple[str, str], tuple[str, frozenset[str]]] = {}


def hashed(*parts) -> int:
    return xxhash.xxh3_64_intdigest("\x00".join(map(str, parts)).encode("utf-8", "surrogatepass")) - (1 << 63)


def _named(tag: str, rest: str) -> tuple[str, frozenset[str]]:
    """The label of an element, and what its attributes say: words of class, id and role, "hidden", "article"."""
    if not rest or not _SPEAKS.search(rest):
        return tag, frozenset()
    known = _NAMES.get((tag, rest))
    if known is None:
        words, says = set(), set()
        for name, *values in _ATTRIBUTE.findall(rest):
            name, value = name.lower(), "".join(values)
            if name in ("class", "id", "role"):
                found = {w.lower() for token in value.split() if not any(c.isdigit() for c in token) for w in _WORDS.findall(token)}
                words |= found
                if name == "role" and found & ARTICLE_ROLES:
                    says.add("article")
            elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or \
                    name == "style" and re.search(r"display\s*:\s*none", value, re.IGNORECASE):
                says.add("hidden")
        known = ".".join([tag, *sorted(words)]), frozenset(says | words & NOISE_WORDS)
        if len(_NAMES) > 50_000:
            _NAMES.clear()
        _NAMES[tag, rest] = known
    return known


def _role(tag: str, says: frozenset[str], outer: int) -> int:
    if outer == NOISE or "hidden" in says or tag in NOISE_TAGS:
        return NOISE
    if tag in ARTICLE_TAGS or "article" in says:
        return ARTICLE
    inside = outer in (ARTICLE, BOX)
    words = says - {"header"} if inside else says  # an article has a header of its own
    if tag not in ("html", "body") and words or tag == "header" and not inside:
        return NOISE
    if inside:
        return BOX if tag in BOXES and (outer == BOX or tag in ("div", "section")) else ARTICLE if outer == ARTICLE else BOX
    return NEUTRAL


class Page:
    """One page as a tree of elements, and its blocks as lists of (element, text)."""

    def __init__(self, html: str, site: int):
        self.parent, self.key, self.role, self.label, self.depth = [-1], [hashed(site)], [NEUTRAL], [""], [0]
        self.blocks: list[list[tuple[int, str]]] = []
        self._open: list[tuple[str, int]] = []  # (tag, element)
        self._at: dict[str, list[int]] = defaultdict(list)  # tag -> its places in _open
        self._blocks_open: list[int] = []  # places of blocks in _open
        self._block: list[tuple[int, str]] = []
        self._read(html)
        self._flush()

    # -- reading

    def _read(self, html: str) -> None:
        at, blind = 0, False
        while found := _START.search(html, at):
            self._text(html[at:found.start()])
            at = found.end()
            tag = found[2]
            if tag is None:
                end = html.find("-->", at - 2) + 2 if found[0] == "<!--" else html.find(">", at)
                if end < 2 and found[0] == "<!--" or end < 0:
                    return
                at = end + 1
                continue
            rest = None if blind else _REST.match(html, at)
            if rest is None:  # a quote that never ends: from here on the next > ends a tag
                blind = True
                end = html.find(">", at)
                if end < 0:
                    return
                inner, at = html[at:end], end + 1
            else:
                inner, at = rest[0][:-1], rest.end()
            tag = tag.lower()
            if found[1]:
                self._end(tag)
                continue
            self._start(tag, inner)
            if tag in RAW:
                close = _CLOSING[tag].search(html, at)
                self._end(tag)
                if close is None:
                    return
                at = html.find(">", close.end()) + 1
                if not at:
                    return
        self._text(html[at:])

    def _text(self, text: str) -> None:
        if not text:
            return
        if self._at["head"] and not text.isspace():
            self._pop(self._at["head"][-1])
        self._block.append((self._open[-1][1] if self._open else 0, text))

    def _flush(self) -> None:
        """Ends the block: neighbouring texts of an element become one, references are decoded."""
        if self._block:
            pieces = [(node, references.unescape("".join(t for _, t in texts))) for node, texts in groupby(self._block, lambda p: p[0])]
            if any(not t.isspace() for _, t in pieces):
                self.blocks.append(pieces)
            self._block = []

    # -- elements

    def _pop(self, to: int) -> None:
        while len(self._open) > to:
            tag, _ = self._open.pop()
            self._at[tag].pop()
            if tag in BLOCK:
                self._blocks_open.pop()
                self._flush()

    def _start(self, tag: str, rest: str) -> None:
        if tag == "br":
            self._block.append((self._open[-1][1] if self._open else 0, "\n"))
            return
        if tag in ("html", "body") and self._at[tag]:
            return
        if self._at["head"] and tag not in IN_HEAD:
            self._pop(self._at["head"][-1])
        block = tag in BLOCK
        if block:
            if self._at["p"]:
                self._pop(self._at["p"][0])
            self._flush()
        if tag in CLOSES:
            names, beyond = CLOSES[tag]
            wall = max((self._at[b][-1] for b in beyond if self._at[b]), default=-1)
            places = [p for name in names if (own := self._at[name]) and (i := bisect_right(own, wall)) < len(own) for p in (own[i],)]
            if places:
                self._pop(min(places))
        if tag in VOID:
            return
        outer = self._open[-1][1] if self._open else 0
        label, says = _named(tag, rest)
        role = _role(tag, says, self.role[outer])
        named = role == NOISE and self.role[outer] != NOISE or role == ARTICLE and self.role[outer] == NEUTRAL
        node = outer
        if named or block and self.depth[outer] < DEEPEST:
            node = len(self.parent)
            self.parent.append(outer)
            self.key.append(hashed(self.key[outer], label))
            self.role.append(role)
            self.label.append(label)
            self.depth.append(self.depth[outer] + 1)
        self._at[tag].append(len(self._open))
        if block:
            self._blocks_open.append(len(self._open))
        self._open.append((tag, node))

    def _end(self, tag: str) -> None:
        if tag == "br":
            self._start("br", "")
        elif self._at[tag]:
            place = self._at[tag][-1]
            if tag in BLOCK or not self._blocks_open or self._blocks_open[-1] < place:
                self._pop(place)

    # -- results

    def text(self, gone: frozenset[int] | set[int]) -> str:
        """The blocks without named noise and without the elements whose keys are gone."""
        stays = [r != NOISE and k not in gone for r, k in zip(self.role, self.key, strict=True)]
        lines = (" ".join("".join(t for node, t in pieces if stays[node]).split()) for pieces in self.blocks)
        return "\n".join(line for line in lines if line)


# ---------------------------------------------------------------------------
# the tree as sums
# ---------------------------------------------------------------------------

ELEMENT, STYLE, TEXT, BELOW = 0, 1, 2, 3
_FACTS = "site long, kind int, a long, b long, x double, y double"
_DIGITS = re.compile(r"\d+")


def page_facts(page: Page) -> dict[tuple[int, int, int], list[float]]:
    """What one page adds to the tree of its site.

    (ELEMENT, key, role): uses, pages.  (STYLE, key, style): uses.  (TEXT, key, text): uses f, f ln f.
    (BELOW, key, key of it or of an element below): weight of the latter in the former.
    """
    facts: dict[tuple[int, int, int], list[float]] = defaultdict(lambda: [0.0, 0.0])
    children: list[list[str]] = [[] for _ in page.parent]
    for node, parent in enumerate(page.parent):
        if parent >= 0:
            children[parent].append(page.label[node])
    for node, key in enumerate(page.key):
        element = facts[ELEMENT, key, page.role[node]]
        element[0] += 1
        element[1] = 1
        facts[STYLE, key, hashed(*(label for label, _ in groupby(children[node])))][0] += 1
        weight, at = (1 - DAMPING if children[node] else 1.0), node
        while at >= 0:
            facts[BELOW, page.key[at], key][0] += weight
            at = page.parent[at]
            if at >= 0:
                weight *= DAMPING / len(children[at])
    uses: dict[tuple[int, int], int] = defaultdict(int)
    for pieces in page.blocks:
        for node, t in pieces:
            words = t.split()
            if words:
                uses[page.key[node], hashed(_DIGITS.sub("0", " ".join(words)))] += 1
    for (key, text), f in uses.items():
        facts[TEXT, key, text] = [f, f * math.log(f)]
    return facts


def _facts(batches):
    held: dict = defaultdict(lambda: [0.0, 0.0])

    def send() -> pa.RecordBatch:
        cols = list(zip(*((*k, *v) for k, v in held.items()), strict=True)) or [()] * 6
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["site", "kind", "a", "b", "x", "y"])

    for batch in batches:
        for site, html in zip(batch["site"].to_pylist(), batch["html"].to_pylist(), strict=True):
            for key, (x, y) in page_facts(Page(html or "", site)).items():
                sums = held[site, *key]
                sums[0] += x
                sums[1] += y
            if len(held) > HELD_FACTS:
                yield send()
                held.clear()
    yield send()


def _with_sites(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^[^/?#]*//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), F.xxhash64(host).alias("site"))


def style_trees(pages: DataFrame) -> DataFrame:
    """(site, kind, a, b, x, y): the summed counts of all pages."""
    return _with_sites(pages).select("site", "html").mapInArrow(_facts, _FACTS).groupBy("site", "kind", "a", "b").agg(F.sum("x").alias("x"), F.sum("y").alias("y"))


def importance(trees: DataFrame) -> DataFrame:
    """(site, key, role, own, whole, most): importance of an element, with what is below it, and the most in its branch."""
    x, y, kind = F.col("x"), F.col("y"), F.col("kind")
    sums = trees.where(kind < BELOW).groupBy("site", F.col("a").alias("key")).agg(
        F.min(F.when(kind == ELEMENT, F.col("b"))).cast("int").alias("role"),
        F.sum(F.when(kind == ELEMENT, x)).alias("uses"), F.sum(F.when(kind == ELEMENT, y)).alias("pages"),
        F.sum(F.when(kind == STYLE, x * F.log(x)).otherwise(0.0)).alias("styles"),
        F.sum(F.when(kind == TEXT, x * F.log(x) - y).otherwise(0.0)).alias("spread"),
        F.sum(F.when(kind == TEXT, x).otherwise(0.0)).alias("texts"))
    shown = (F.log("uses") - F.col("styles") / F.col("uses")) / F.log("uses")
    told = 1 - F.col("spread") / F.col("texts") / F.log("pages")
    value = F.when(F.col("texts") > 0, F.when(F.col("pages") > 1, told).otherwise(1.0)).otherwise(F.when(F.col("uses") > 1, shown).otherwise(1.0))
    seen = F.when(F.col("texts") > 0, F.col("pages")).otherwise(F.col("uses")) - 1
    entropy = 1 - seen / (seen + DOUBT) * (1 - value)
    prior = F.when(F.col("role") == ARTICLE, NAMED + (1 - NAMED) * entropy).when(F.col("role") == BOX, BOXED + (1 - BOXED) * entropy)
    prior = prior.when(F.col("role") == NOISE, (1 - NAMED) * entropy).otherwise(entropy)
    own = sums.select("site", "key", "role", "uses", prior.alias("own"), (F.col("texts") > 0).alias("speaks"))
    below = trees.where(kind == BELOW).select("site", F.col("a").alias("over"), F.col("b").alias("key"), F.col("x").alias("weight"))
    whole = (below.join(own, ["site", "key"]).groupBy("site", F.col("over").alias("key")).agg(F.sum(F.col("weight") * F.col("own")).alias("total"))
             .join(own, ["site", "key"]).select("site", "key", "role", "own", F.round(F.col("total") / F.col("uses"), 9).alias("whole"), "speaks"))
    peak = whole.select("site", "key", F.greatest("whole", F.when(F.col("speaks"), F.col("own"))).alias("peak"))
    most = (below.select("site", "over", "key").join(peak, ["site", "key"])
            .groupBy("site", F.col("over").alias("key")).agg(F.max("peak").alias("most")))
    return whole.drop("speaks").join(most, ["site", "key"])


# ---------------------------------------------------------------------------
# operator
# ---------------------------------------------------------------------------

_TEXT = "page_id long, url string, text string, n_chars long"


def _extracted(batches):
    for batch in batches:
        texts = [Page(html or "", site).text(set(gone or ())) for site, html, gone in
                 zip(*(batch[c].to_pylist() for c in ("site", "html", "gone")), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch["page_id"].cast(pa.int64()), batch["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"])


def main_text(pages: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(page_id, url, text, n_chars): each page without the branches that matter little on its site."""
    trees = common.staged(style_trees(pages), "trees")
    dull = importance(trees).where((F.col("most") < threshold) & (F.col("role") != NOISE))
    gone = common.staged(dull.groupBy("site").agg(F.collect_list("key").alias("gone")), "gone")
    return _with_sites(pages).join(gone, "site", "left").select("page_id", "url", "html", "site", "gone").mapInArrow(_extracted, _TEXT)
