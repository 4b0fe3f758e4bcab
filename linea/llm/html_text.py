"""Main text of web pages, with site template removal.

A page is parsed into a tree. Pass one hashes its container subtrees (tags,
attributes and text, from the leaves up) and counts, per host, on how many
different pages each occurs. A subtree is a template if it occurs on at least
``min_pages`` pages of its host, however many the host has. Pass two
parses again, deletes the templates together with what its tags and names tell
to be navigation, adverts, notices, forms or reader comments, and joins the
blocks of the rest. A page's ``article`` (else ``main``, else ``body``) is the
place to look at. Inside an article or main only subtrees that hold less than half of
its text can be templates; on a page without either there is no such limit. Paragraphs and headings never are templates: equal
passages of different articles are content, not template.

Edge cases: null or empty html, or a page without main text, gives the empty
string. A null url, or one without host, belongs to the host "". Unclosed,
misnested and cut-off tags are closed as browsers do for the usual cases
(paragraphs, list items, table cells). Equal pages count once. Very long pages
are read whole. Empty tables give empty results; other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linea.llm.common import materialise

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*+)>|<[!?/][^>]*+>""", re.S)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noscript noembed noframes xmp template svg".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rb rp rt s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
#: Tags that close an open tag of the second set, up to one of the third.
BLOCKS = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
                   "h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
CLOSES = {**dict.fromkeys(BLOCKS, frozenset("p")), "li": frozenset("li"), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
          "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"])}
FENCE = frozenset("article aside body div footer form header main nav ol section table td th ul dl blockquote html".split())
#: Never part of the main text.
DROP = RAW | frozenset("head nav footer aside form button select dialog menu object canvas audio video map datalist".split())
CONTENT = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote".split()) | INLINE
NAMES = frozenset("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr "
                  "notice alert popup modal overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer masthead "
                  "comment comments disqus replies reply share sharing social related recommended newsletter subscribe signup login widget toolbar".split())
#: Words that say nothing of their own beside one of NAMES: a class of both is a name, one with any other word is not.
BESIDE = frozenset("site page main global top bottom left right upper lower inner outer primary secondary box bar block area list item items "
                   "container wrapper wrap holder panel section region row col column content body header head title heading link links "
                   "button buttons icon icons post posts article articles story stories reader user form field js slot unit text message "
                   "policy banner desktop mobile fixed sticky id".split())
COMMENTS = frozenset("comment comments disqus replies reply".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[a-z]+", re.I)


class Node:
    __slots__ = ("attributes", "children", "digest", "parent", "size", "tag")

    def __init__(self, tag: str, attributes: str, parent: Node | None):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children: list[Node | str] = []
        self.digest, self.size = 0, 0


def parse(page: str) -> Node:
    """Tree of a page; text stays as it is written."""
    root = Node("html", "", None)
    at, place = 0, root
    text = lambda s: place.children.append(s) if s else None
    while m := TAG.search(page, at):
        text(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            up = place
            while up is not None and up.tag != tag:
                up = up.parent
            if up is not None and up.parent is not None:
                place = up.parent
            continue
        if tag in ("html", "body") and place is root:
            root.attributes += m[3]
            continue
        shut = CLOSES.get(tag)
        if shut:
            up = place
            while up.parent is not None and up.tag not in FENCE:
                if up.tag in shut:
                    place = up.parent
                    if tag in BLOCKS:
                        break
                up = up.parent
        node = Node(tag, m[3], place)
        place.children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID and not m[3].endswith("/"):
            place = node
    rest = page[at:]
    cut = re.search(r"<[a-zA-Z/!][^>]*\Z", rest)
    text(rest[:cut.start()] if cut else rest)
    return root


def names_out(value: str, names: frozenset[str]) -> bool:
    """Whether a class or id has a token made of ``names`` alone, or of these and words that say nothing beside them."""
    for token in value.split():
        words = _WORD.findall(token)
        if words and not names.isdisjoint(words) and all(w in names or w in NAMES or w in BESIDE for w in words):
            return True
    return False


def named_out(node: Node) -> bool:
    """Whether a tag, class, id or role tells that a subtree is no main text.

    The page's root is never judged, an article or main only as a comment.
    """
    if node.tag in DROP:
        return True
    if not node.attributes or node.parent is None or node.tag in ("html", "body"):
        return False
    whole = node.tag in ("article", "main")
    for key, a, b, c in _ATTRIBUTE.findall(node.attributes):
        key, value = key.lower(), (a or b or c).lower()
        if key in ("class", "id") and names_out(value, COMMENTS if whole else NAMES):
            return True
        if whole:
            continue
        if key == "role" and value in ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


def digests(root: Node) -> list[Node]:
    """All elements, leaves first, with hash and length of text of each subtree."""
    order: list[Node] = [root]
    for node in order:
        order.extend(c for c in node.children if isinstance(c, Node))
    order.reverse()
    for node in order:
        h = xxhash.xxh64(f"{node.tag} {' '.join(node.attributes.split())}".encode("utf-8", "surrogatepass"))
        size = 0
        for c in node.children:
            if isinstance(c, Node):
                h.update(c.digest.to_bytes(8, "little"))
                size += c.size
            elif s := " ".join(c.split()):
                h.update(b"\0" + s.encode("utf-8", "surrogatepass"))
                size += len(s)
        node.digest, node.size = h.intdigest(), size
    return order


def places(root: Node) -> list[Node]:
    """Outermost articles, else mains, else the whole page.

    Those outside of subtrees that are named out come first; where there is
    none, those below a named class or id count too: a page's wrapper may bear
    any name.
    """
    for judged in (named_out, lambda n: n.tag in DROP or n.tag in ("article", "main") and named_out(n)):
        for wanted in ("article", "main"):
            found, stack = [], [root]
            while stack:
                node = stack.pop()
                if judged(node):
                    continue
                if node.tag == wanted:
                    found.append(node)
                else:
                    stack.extend(c for c in reversed(node.children) if isinstance(c, Node))
            if any(n.size for n in found):
                return found
    return [root]


def most(top: Node) -> float:
    """Half the length of text that a template inside ``top`` stays below: no limit for the whole page."""
    return top.size / 2 if top.parent is not None else float("inf")


def containers(root: Node) -> list[int]:
    """Signed hashes of the subtrees that may be templates."""
    order = digests(root)
    inside: dict[int, float] = {}
    for top in places(root):
        limit, stack = most(top), [top]
        while stack:
            node = stack.pop()
            inside[id(node)] = limit
            stack.extend(c for c in node.children if isinstance(c, Node))
    out = set()
    for node in order:
        if node.size and node.parent is not None and node.tag not in CONTENT and node.tag not in RAW and node.size < inside.get(id(node), float("inf")):
            out.add(node.digest - (1 << 64) if node.digest >> 63 else node.digest)
    return sorted(out)


def extract(page: str | None, templates: frozenset[int] = frozenset()) -> str:
    """Main text of a page without the subtrees whose hashes are ``templates``."""
    if not page:
        return ""
    root = parse(page)
    digests(root)
    blocks: list[str] = []
    run: list[str] = []

    def close():
        if joined := " ".join(unescape("".join(run)).split()):
            blocks.append(joined)
        run.clear()

    for top in places(root):
        deleted = lambda n, limit=most(top): (n.tag not in CONTENT and n.size < limit
                                              and (n.digest - (1 << 64) if n.digest >> 63 else n.digest) in templates)
        stack: list[Node | str | None] = [top]
        while stack:
            node = stack.pop()
            if node is None:
                close()
            elif isinstance(node, str):
                run.append(node)
            elif node is top or not (named_out(node) or deleted(node) or node.tag == "header" and top.tag not in ("article", "main")):
                block = node.tag not in INLINE
                if block:
                    close()
                    stack.append(None)
                stack.extend(reversed(node.children))
        close()
    return " ".join(blocks)


def templates(pages: DataFrame, host: Column, html: str, min_pages: int) -> DataFrame:
    """(key, templates): template hashes of every different page (key: hash of host and html) that has any."""

    @F.pandas_udf("array<bigint>")
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([containers(parse(p)) if p else [] for p in s])

    rows = pages.select(host.alias("host"), F.col(html).alias("html")).withColumn("key", F.xxhash64("host", "html"))
    found = materialise(rows.select("host", "key", hashed.asNondeterministic()("html").alias("hashes")))
    once = found.groupBy("host", "key").agg(F.first("hashes").alias("hashes"))
    each = once.select("host", "key", F.explode("hashes").alias("h"))
    common = each.groupBy("host", "h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages).select("host", "h")
    return each.join(common, ["host", "h"]).groupBy("key").agg(F.collect_set("h").alias("templates"))


def main_text(pages: DataFrame, host: Column, html: str = "html", min_pages: int = 10) -> DataFrame:
    """``pages`` with ``text``, its main text (replaces a column of that name)."""
    found = materialise(templates(pages, host, html, min_pages))

    @F.pandas_udf("string")
    def text(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for htmls, known in batches:
            yield pd.Series([extract(p, frozenset(t if t is not None else ())) for p, t in zip(htmls, known, strict=True)], dtype=object)

    rows = pages.withColumn("__key", F.xxhash64(host, F.col(html)))
    rows = rows.join(found.withColumnsRenamed({"key": "__key", "templates": "__templates"}), "__key", "left")
    return rows.withColumn("text", text.asNondeterministic()(F.col(html), F.col("__templates"))).drop("__key", "__templates")
