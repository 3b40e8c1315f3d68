"""Main text of web pages by site style trees.

The DOMs of a host's pages are merged by element path (tag and class or id of
every block element from the root).  Every path has, over the host's pages,
variants of presentation (its sequence of children) and of content (its text
and links).  The importance of a path is the mix of both entropies, scaled to
0..1 by the logarithm of the number of pages: a menu or advert that repeats
over the host is near 0, an article near 1.  Equal pages of a host count once,
and inside an article or main element equal articles count once, whatever
surrounds them, so that copies say nothing about their own text.  Branches of low importance are
removed from each page; elements that HTML or their class name marks as
menus, forms, adverts, comments and the like are removed on any host, also
where too few pages tell anything.

The merged tree is never in one place: pages emit one row per path with two
hashes, the counts are aggregations that combine map-side, and low paths come
back as (host, path) rows to the pages that hold them: a page gets its own low
paths, at most as many as it has elements, however many its host has, and only
those that the extraction of that page can ask for (``asked``).  The share of a
host's pages that a path is on plays no part.

Article elements, main elements, what encloses them, and unlabelled paragraphs
are never removed for repeating; a page of which nothing would be left falls
back on the element rules.

Defined results: null or empty html gives an empty text; pages without a host
use the element rules alone; repeated rows get the same text each; an empty
table gives an empty table; only page_id, url and html are read.
"""

from __future__ import annotations

import hashlib
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced, written

MIN_PAGES = 4
SALTS = 16                 # parts that a (host, path) is dealt over when low paths come back
LOW = 0.35                 # importance below which a branch is removed
CONTENT_WEIGHT = 0.9
BATCH_CHARS = 4_000_000    # characters of the pages parsed at once, or one longer page
REMEMBER = 100_000         # kinds of elements, and steps of paths, a worker remembers
PRIME, BASE = 2**61 - 1, 1_000_003_919

# Elements of HTML by role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
             "strike strong sub sup time tt u var wbr".split())
NOISE_TAGS = set("head script style noscript template nav footer aside form button select option textarea input iframe object embed svg canvas "
                 "audio video menu dialog fieldset map math".split())
KEEP_TAGS = set("html body article main p h1 h2 h3 h4 h5 h6 blockquote pre ul ol li dl dt dd table tbody thead tfoot tr td th figure figcaption hr".split())
CLOSES_P = KEEP_TAGS | NOISE_TAGS | set("div section header address details summary center".split())
NOISE_WORDS = set("nav navbar navigation menu menus header masthead topbar footer sidebar sidebars ad ads adv advert adverts advertisement "
                  "advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
                  "subscribe subscription signup login share sharing social related recommended recommendations breadcrumb breadcrumbs comment comments "
                  "reply replies disqus respond search widget widgets pagination pager toolbar skip copyright".split())
SPARED = set("html body main h1 h2 h3 h4 h5 h6".split())      # whatever their class says
NOISE_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


class _Steps(dict):
    """(number of a path, name of an element) -> number of the longer path: a chained
    64-bit hash, the same in every task."""

    def __missing__(self, step: tuple[int, str]) -> int:
        if len(self) > REMEMBER:
            self.clear()
        text = f"{step[0]} {step[1]}".encode("utf-8", "replace")
        got = self[step] = int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little") >> 1
        return got


_steps = _Steps()


class Node:
    """A block element: ``name`` is its tag and label, ``path`` the number of its
    path, ``holds`` says that an article or main is below it (not inside an element
    that is noise by its tag)."""

    __slots__ = ("tag", "label", "noise", "parent", "parts", "name", "path", "holds")

    def __init__(self, tag: str, attrs: list, parent: "Node | None"):
        self.tag, self.parent, self.parts, self.holds = tag, parent, [], False
        self.name, self.label, self.noise = _kinds[tag, tuple(attrs)]
        self.path = _steps[parent.path, self.name] if parent else 0


class _Kinds(dict):
    """(tag, attributes) -> name, label and whether the element is noise by itself."""

    def __missing__(self, key: tuple) -> tuple[str, str, bool]:
        if len(self) > REMEMBER:
            self.clear()
        tag, a = key[0], dict(key[1])
        label = (a.get("class") or "").strip().lower() or (a.get("id") or "").strip().lower()
        named = set(re.split(r"[^a-z]+", f"{a.get('class') or ''} {a.get('id') or ''}".lower())) if tag not in INLINE else ()
        hidden = "hidden" in a or (a.get("aria-hidden") or "") == "true" or "display:none" in (a.get("style") or "").replace(" ", "")
        role = (a.get("role") or "").lower()
        noise = tag in NOISE_TAGS or hidden or role in NOISE_ROLES or (tag not in SPARED and bool(NOISE_WORDS & set(named)))
        got = self[key] = (f"{tag}.{label}" if label else tag, label, noise)
        return got


_kinds = _Kinds()


class Tree(HTMLParser):
    """A lenient DOM of block elements: inline tags dissolve into text."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", [], None)
        self.open: dict[str, int] = {}          # open elements by tag
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        if tag in INLINE:
            if tag == "br":
                self.at.parts.append(" ")
            if tag == "a" and (href := dict(attrs).get("href")):
                self.at.parts.append(("href", href))
            return
        if tag in VOID:
            self.at.parts.append(("break",))
            return
        if tag in CLOSES_P:
            self._close("p", ("article", "main", "div", "section", "td", "th", "li", "blockquote", "body", "form", "aside", "header", "footer", "nav"))
        if tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
            same = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}.get(tag, (tag,))
            for t in same:
                self._close(t, ("ul", "ol", "dl", "table", "tbody", "thead", "tfoot", "select") + (("tr",) if tag in ("td", "th") else ()))
        node = Node(tag, attrs, self.at)
        self.at.parts.append(node)
        if tag in ("article", "main") and not node.noise:
            up = self.at
            while not up.holds:
                up.holds = True
                if up.tag in NOISE_TAGS or up.parent is None:
                    break
                up = up.parent
        self.at = node
        self.open[tag] = self.open.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in INLINE and tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag not in INLINE and tag not in VOID:
            self._close(tag, ())

    def parse_marked_section(self, i, report=1):
        """``<![...`` of any kind is a comment up to the next ``>``, or the page's end."""
        end = self.rawdata.find(">", i + 3)
        return end + 1 if end >= 0 else len(self.rawdata)

    def _close(self, tag, barriers):
        if not self.open.get(tag):
            return
        n = self.at
        while n is not None and n.tag != tag:
            if n.tag in barriers:
                return
            n = n.parent
        if n is not None and n.parent is not None:
            while self.at is not n.parent:
                self.open[self.at.tag] -= 1
                self.at = self.at.parent

    def handle_data(self, data):
        self.at.parts.append(data)


def tree(html: str) -> Node:
    return Tree(html).root


def children(n: Node):
    return (p for p in n.parts if isinstance(p, Node))


def paths(root: Node) -> dict[int, tuple[int, int, int]]:
    """path -> hash of its children's names, hash of its text and links, over the page, and
    what counts once: the hash of the outermost article or main around it, or of the page.

    The text's hash is a polynomial in its pieces between tags, so a parent's follows from its
    children's.  The walk keeps its own stack: pages can be nested without bound."""
    out: dict[int, tuple[int, int]] = {}
    around: dict[int, int] = {}
    # node, its parts that are left, outermost article above, children's names, value and power of the text
    stack = [[root, iter(root.parts), 0, [], 0, 1]]
    while stack:
        top = stack[-1]
        for p in top[1]:
            if isinstance(p, Node):
                top[3].append(p.name)
                stack.append([p, iter(p.parts), top[2] or (p.path if p.tag in ("article", "main") else 0), [], 0, 1])
                break
            words = p.split() if isinstance(p, str) else p[1:]
            if words:
                top[4], top[5] = (top[4] * BASE + _h(words)) % PRIME, top[5] * BASE % PRIME
        else:
            node, _, article, names, value, power = stack.pop()
            if stack:
                above = stack[-1]
                above[4], above[5] = (above[4] * power + value) % PRIME, above[5] * power % PRIME
                old = out.get(node.path, (0, 0))
                out[node.path] = ((old[0] * 31 + _h(names)) % 2**63, (old[1] * 31 + value) % 2**63)
                around[node.path] = article
    page = _h([f"{p} {s} {c}" for p, (s, c) in sorted(out.items())])
    return {p: (s, c, out[around[p]][1] if around[p] else page) for p, (s, c) in out.items()}


def _h(words: list[str]) -> int:
    return int.from_bytes(hashlib.blake2b(" ".join(words).encode("utf-8", "replace"), digest_size=8).digest(), "little") >> 1


MODES = ("article", "main", None)


class _Asked:
    """Stands for a set of low paths: all or none are in it; keeps what was looked up."""

    def __init__(self, answer: bool):
        self.answer, self.paths = answer, set()

    def __contains__(self, path: str) -> bool:
        self.paths.add(path)
        return self.answer


def _lines(root: Node, tag: str | None, low) -> list[str]:
    """The blocks of the page's ``tag`` elements (None: of the page) without noise and low branches."""
    def noise(n: Node, in_article: bool, holds: bool) -> bool:
        if n.tag == "header":
            return not in_article
        return n.noise and not (holds and n.tag not in NOISE_TAGS)

    def kept(n: Node) -> bool:
        return n.tag in KEEP_TAGS and (not n.label or n.tag in ("article", "main"))

    def blocks(top: Node, in_article: bool, out: list[list[str]]) -> None:
        out.append([])
        stack = [iter(top.parts)]
        while stack:
            for p in stack[-1]:
                if isinstance(p, str):
                    out[-1].append(p)
                elif isinstance(p, Node):
                    out.append([])
                    if not noise(p, in_article, False) and (p.tag == "header" or kept(p) or p.path not in low):
                        stack.append(iter(p.parts))
                        break
                elif p[0] == "break":
                    out.append([])
            else:
                stack.pop()
                out.append([])

    def find(top: Node) -> list[Node]:
        found, stack = [], [children(top)]
        while stack:
            c = next(stack[-1], None)
            if c is None:
                stack.pop()
            elif c.tag == tag and not c.noise:
                found.append(c)
            elif not noise(c, False, c.holds):
                stack.append(children(c))
        return found

    out: list[list[str]] = []
    for n in find(root) if tag else [root]:
        blocks(n, tag is not None, out)
    return [t for t in (" ".join("".join(b).split()) for b in out) if t]


def main_text(root: Node, low: frozenset[int] = frozenset()) -> str:
    """The page's article as blocks, one per line, without noise and low branches."""
    for tag in MODES:
        if lines := _lines(root, tag, low):
            return "\n".join(lines)
    return main_text(root) if low else ""


def asked(root: Node) -> set[int]:
    """The paths of the page whose being low can change its text."""
    out: set[int] = set()
    for tag in MODES:
        none = _Asked(False)
        lines = _lines(root, tag, none)
        out |= none.paths
        if lines and _lines(root, tag, _Asked(True)):      # no low path can empty this mode
            break
    return out


PATHS = "host string, page binary, path long, style long, content long, once long, asked boolean"


def _emit_paths(batches):
    for b in batches:
        for part in sliced(b, "html", BATCH_CHARS, 200):
            rows = []
            for h, page, html in zip(*(part.column(c).to_pylist() for c in ("host", "page", "html"))):
                root = tree(html)
                ask = asked(root)
                rows += [(h, page, p, *x, p in ask) for p, x in paths(root).items()]
            cols = list(zip(*rows)) or [()] * 7
            types = [pa.string(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
            names = ["host", "page", "path", "style", "content", "once", "asked"]
            yield pa.record_batch({name: pa.array(col, t) for name, col, t in zip(names, cols, types)})


def _entropy(rows: DataFrame, of: str) -> DataFrame:
    """host, path, pages and the entropy of the variants in ``of``, to the base of the pages."""
    n = F.col("n").cast("double")
    per = rows.groupBy("host", "path", of).agg(F.count("*").alias("n")).groupBy("host", "path").agg(
        F.sum(n).alias("pages"), F.sum(n * F.ln(n)).alias("nln"))
    h = (F.ln("pages") - F.col("nln") / F.col("pages")) / F.ln("pages")
    return per.select("host", "path", "pages", F.when(F.col("pages") > 1, h).otherwise(F.lit(1.0)).alias(f"h_{of}"))


def low_paths(pages: DataFrame) -> DataFrame:
    """host, page and ``low``: the paths of low importance of each page that has some (columns host, page, html)."""
    rows = written(pages.filter("host <> ''").mapInArrow(_emit_paths, PATHS), "paths")
    once = rows.select("host", "path", "style", "content", "once").distinct()
    both = _entropy(once, "style").join(_entropy(once, "content").drop("pages"), ["host", "path"])
    importance = CONTENT_WEIGHT * F.col("h_content") + (1 - CONTENT_WEIGHT) * F.col("h_style")
    low = written(both.filter((importance < LOW) & (F.col("pages") >= MIN_PAGES)).select("host", "path"), "low-paths")
    salt = F.pmod(F.xxhash64("page"), F.lit(SALTS)).cast("int")
    salted = low.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    mine = rows.filter("asked").select("host", "page", "path", salt.alias("salt")).join(salted, ["host", "path", "salt"])
    return written(mine.groupBy("host", "page").agg(F.sort_array(F.collect_set("path")).alias("low")), "low-paths-of-pages")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    rows = pages.select("page_id", "url", F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), HOST, 1)).alias("host"),
                        F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("page", F.substring(F.unhex(F.sha2("html", 256)), 1, 16))
    low = low_paths(rows.select("host", "page", "html"))

    def run(batches):
        for b in batches:
            for part in sliced(b, "html", BATCH_CHARS, 200):
                texts = [main_text(tree(html), frozenset(low or ())) for html, low in zip(part.column("html").to_pylist(), part.column("low").to_pylist())]
                yield pa.record_batch({"page_id": part.column("page_id"), "url": part.column("url"), "text": pa.array(texts, pa.string()),
                                       "n_chars": pa.array(list(map(len, texts)), pa.int64())})

    return rows.join(low, ["host", "page"], "left").select("page_id", "url", "html", "low").mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
