"""Main text of web pages by template deduction over the pages of a host.

Tokens of a page are its elements, told apart by their role (the path of element names and classes), and its text strings
with the role they stand in. Tokens with the same occurrence vector over the pages of a host (how often on which page)
form an equivalence class; a vector is kept as the XOR of page hashes, so that it adds up in any order and never has to be
held. A class makes part of the host's template if

* it is on at least half of the host's different pages (copies of a page count as one page),
* it has ``LEAST_TOKENS`` tokens or more, and elements among them: a text string alone, however frequent, is no template,
* it is ordered: two of its elements that stand in one parent stand there in the same order on every page,
* it nests: what is around a token is itself on half of the pages. (An element always stands in its path, so the elements of
  a class nest in each other by construction.)

What is left between template tokens are the slots. Slots in elements made for something else (menus, adverts, forms,
comments, ...) are no main text. Where pages have an article or main element, its name decides and all its blocks are the
text, with or without a template. Elsewhere the slot with most text that is no template is extracted, without the
template's texts. A page whose own structure has no such slot (or whose host has too few pages for a template) is read as one slot.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import defaultdict
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.arrays import one_array, pieces
from caseloom.session import cut_lineage

LEAST_PAGES = 3
LEAST_TOKENS = 3
SUPPORT = 0.5
BROADCAST_ROWS = 10_000
#: elements in one parent whose order is compared, pair by pair; the order of more is not known, so they are no template
MOST_SIBLINGS = 64
#: fixed values: element names of HTML by what they do to text
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
                   "h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody tfoot thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg math".split())
SKIP = frozenset("head script style noscript template iframe object svg math canvas nav aside form footer button select textarea input dialog menu".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "p": ("p",)}
P = ("p",)
CELLS = ("td", "th")
SCOPE = frozenset("ul ol dl table article section div main body html nav aside header footer form blockquote td th li".split())
#: words of class, id and role names that mark something else than the article
OTHER = re.compile(r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed)?|promos?|promotion|banner|nav|navbar|navigation|navbox|menu|menubar|"
                   r"breadcrumbs?|sidebar|side-bar|rail|footer|masthead|toolbar|cookies?|consent|notices?|alert|gdpr|popup|modal|overlay|newsletter|subscribe|"
                   r"signup|login|share|sharing|social|related|recommended|comments?|commentlist|comment-list|replies|reply|respond|disqus|widget|pagination|"
                   r"pager|skip|search|contentinfo|complementary|disclaimer|copyright|site-header|page-header)(?:$|[\s_-])", re.I)
OTHER_ARTICLE = re.compile(r"(?:^|[\s_-])(?:comments?|repl(?:y|ies)|ads?|adverts?|sponsor(?:ed)?|promos?|related|recommended|teasers?)(?:$|[\s_-])", re.I)
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)|[^<]+|<", re.S)
#: the end of an element whose body is no markup: only its own closing tag counts
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for name in RAW}
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def string_hash(*parts) -> int:
    """Signed 64-bit hash that is the same in every process."""
    text = "\x00".join(map(str, parts)).encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)


class Node:
    """An element: its role (hash of the path), how surely it is the article (``own``), its mark and state as something else
    (0 no, 1 by a class name or as a form, which may also name a layout around the article, 2 for certain); ``main`` is ``own``
    outside of other matter."""

    __slots__ = ("name", "role", "up", "own", "mark", "state", "main", "inside")

    def __init__(self, name: str, role: int, up: Node | None, own: int, mark: int):
        self.name, self.role, self.up, self.own, self.mark = name, role, up, own, mark
        self.settle()
        self.inside = up is not None and up.inside or own > 0 and self.state < 2

    def settle(self) -> None:
        self.state = max(self.up.state, self.mark) if self.up else self.mark
        self.main = self.own if self.state == 0 else 0

    @property
    def parent(self) -> int:
        return self.up.role if self.up else 0

    @property
    def other(self) -> bool:
        return self.state > 0


_roles: dict[tuple[int, str], int] = {}


def _role(parent: int, label: str) -> int:
    key = (parent, label)
    if key not in _roles:
        if len(_roles) > 100_000:
            _roles.clear()
        _roles[key] = string_hash(parent, label)
    return _roles[key]


def _opened(name: str, raw_attributes: str, up: Node) -> Node:
    attributes: dict[str, str] = {}
    if raw_attributes and not raw_attributes.isspace():
        for a in ATTRIBUTE.finditer(raw_attributes):
            attributes.setdefault(a.group(1).lower(), a.group(2) or a.group(3) or a.group(4) or "")
    main = 2 if name == "article" or "articlebody" in attributes.get("itemprop", "").lower() else 1 if name == "main" or attributes.get("role", "").lower() == "main" else 0
    mark = 1 if name == "form" else 2 if name in SKIP or (name == "header" and not up.inside) else 0
    if mark < 2 and attributes:
        marks = html.unescape(" ".join(attributes.get(k, "") for k in ("class", "id", "role")))
        pattern = OTHER_ARTICLE if main else OTHER
        if "hidden" in attributes or "display:none" in attributes.get("style", "").replace(" ", "").lower():
            mark = 2
        elif name not in ("html", "body") and pattern.search(marks) is not None:
            mark = 1
    return Node(name, _role(up.role, f"{name}.{attributes.get('class', '')}"), up, 0 if mark else main, mark)


def _settled(elements: list[Node], found: list[tuple[str, list[Node]]]) -> list[tuple[str, list[Node]]]:
    """The blocks outside of other matter. A class name or form around the article is its layout: such a mark is taken back.

    Without an article outside of marks, the one with the fewest marks around it (then the most text) is meant; an article
    with most of the text of a main element is never marked by what stands between them. A page without any article takes
    back the marks around most of its text.
    """
    def release(node: Node) -> None:
        while node is not None:
            node.mark = 0
            node = node.up
        for n in elements:
            n.settle()

    if any(around[-1].state for _, around in found):
        size: dict[Node, int] = defaultdict(int)
        for text, around in found:
            for n in around:
                size[n] += len(text)
        articles = [n for n in elements if n.own and n.state < 2 and size.get(n)]
        if articles:
            caught = [n for n in articles if n.state]
            if caught and not any(around[-1].state == 0 and any(n.main for n in around) for _, around in found):
                release(min(caught, key=lambda n: (_marks(n), -size[n])))
            for n in caught:
                up = n.up
                while n.state and up is not None and not up.main:
                    up = up.up
                if n.state and up is not None and n.own > up.main and 2 * size[n] > size[up]:
                    release(n)
        else:
            total = sum(len(text) for text, _ in found)
            while 4 * sum(len(text) for text, around in found if not around[-1].state) < total:
                outer = max((n for n in elements if n.mark == 1 and not n.up.state and size.get(n)), key=size.__getitem__, default=None)
                if outer is None or 2 * size[outer] <= total:
                    break
                release(outer)
    return [x for x in found if not x[1][-1].state]


def _marks(node: Node) -> int:
    n = 0
    while node is not None:
        n += node.mark
        node = node.up
    return n


def structure(page: str) -> tuple[list[Node], list[tuple[str, list[Node]]]]:
    """(elements in page order, blocks): a block is its text and the elements around its first words. White space of a
    block is one blank, character references are decoded; text in elements made for something else is left out."""
    stack = [Node("", 0, None, 0, 0)]
    elements: list[Node] = []
    found: list[tuple[str, list[Node]]] = []
    held: list[str] = []
    around: list[Node] = []
    at = 0

    def end_block():
        nonlocal held
        if held:
            block = " ".join(html.unescape("".join(held)).split())
            if block:
                found.append((block, around))
            held = []

    while m := TOKEN.match(page, at):
        at = m.end()
        close, name, attributes = m.groups()
        if name is None:
            token = m.group(0)
            if (token[0] != "<" or token == "<") and stack[-1].state < 2:
                if not held and not token.isspace():
                    around = stack[:]
                    held = [token]
                elif held:
                    held.append(token)
            continue
        name = name.lower()
        if close:
            if name in BLOCKS:
                end_block()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == name:
                    del stack[i:]
                    break
            continue
        block = name in BLOCKS
        if block:
            end_block()
        closes = CLOSES.get(name) or (P if block else ())
        if closes:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name in closes:
                    del stack[i:]
                    break
                if stack[i].name in SCOPE:
                    break
        if name in VOID:
            if held:
                held.append(" " if name == "br" else "")
            continue
        node = _opened(name, attributes, stack[-1])
        elements.append(node)
        if name in RAW:
            if not attributes.rstrip().endswith("/") or name not in ("svg", "math"):
                end = RAW_END[name].search(page, at)
                # without an end the rest of the page is its body, but drawings and formulas are markup
                at = end.end() if end else at if name in ("svg", "math") else len(page)
        else:
            stack.append(node)
            if name in CELLS and held:
                held.append(" ")
    end_block()
    return elements, _settled(elements, found)


_KINDS = ELEMENT, TEXT, ORDER = 0, 1, 2
_TOKENS = "host string, token bigint, role bigint, parent bigint, kind int, main int, others double, vector bigint, pages double, chars double"


def _mix(h: int) -> int:
    h ^= h >> 33
    h = h * 0xFF51AFD7ED558CCD & (1 << 64) - 1
    return (h ^ h >> 29) - (1 << 63)


def _sibling_pairs(elements: list[Node]):
    """(earlier, later, parent) of the roles in one parent, by their first places; (role, role, parent) where these are too many."""
    children: dict[Node, dict[int, None]] = defaultdict(dict)
    for node in elements:
        children[node.up][node.role] = None
    for up, roles in children.items():
        if len(roles) > MOST_SIBLINGS:
            yield from ((r, r, up.role) for r in roles)
        elif len(roles) > 1:
            yield from ((a, b, up.role) for a, b in combinations(roles, 2))


def _occurrences(batches):
    """Per host and token: the fingerprint of the occurrence vector over a piece's pages, the pages and the text inside. Copies
    of a page share its weight. Pairs of elements by their order: token before role."""
    schema = pa.schema([("host", pa.string()), *((c, pa.int64()) for c in ("token", "role", "parent")), ("kind", pa.int32()), ("main", pa.int32()),
                        ("others", pa.float64()), ("vector", pa.int64()), ("pages", pa.float64()), ("chars", pa.float64())])
    for batch in batches:
        for piece in pieces(batch, "html", 8 << 20):
            sums: dict = {}
            for host, page_key, page, copies in zip(*(piece[c].to_pylist() for c in ("host", "page_key", "html", "copies"))):
                elements, texts = structure(page or "")
                weight = 1.0 / copies
                seen: dict = defaultdict(int)
                chars: dict = defaultdict(int)
                main: dict = defaultdict(int)
                other: dict = {}
                for node in elements:
                    seen[(host, node.role, node.role, node.parent, ELEMENT)] += 1
                    main[node.role] = max(main[node.role], node.main)
                    other[node.role] = other.get(node.role, True) and node.other
                for text, around in texts:
                    role = around[-1].role
                    seen[(host, string_hash(role, text), role, role, TEXT)] += 1
                    for node in around:
                        chars[node.role] += len(text)
                    key = (host, string_hash(role, text), role, role, TEXT)
                    chars[key] += len(text)
                for key, n in seen.items():
                    v = _mix((page_key ^ n * 0x9E3779B97F4A7C15) & (1 << 64) - 1)
                    element = key[4] == ELEMENT
                    new = (main[key[2]] if element else 0, weight if element and other[key[2]] else 0.0, v, weight, weight * chars[key[2] if element else key])
                    s = sums.get(key)
                    sums[key] = (max(s[0], new[0]), s[1] + new[1], s[2] ^ v, s[3] + weight, s[4] + new[4]) if s else new
                for a, b, up in set(_sibling_pairs(elements)):
                    key = (host, a, b, up, ORDER)
                    if key not in sums:
                        sums[key] = (0, 0.0, 0, 0.0, 0.0)
            columns = [list(c) for c in zip(*(k + v for k, v in sums.items()))] or [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def frequent_tokens(pages: DataFrame, support: float = SUPPORT, least_pages: int = LEAST_PAGES, least_tokens: int = LEAST_TOKENS) -> DataFrame:
    """(host, token, role, parent, is_text, main, is_other, vector, pages, chars, class_key, valid): tokens on enough of a host's
    pages, with their class, and whether they are the template's.

    ``pages``: host, page_key, html. A class is named by the smallest of its tokens. Pages with equal html are one page.
    """
    contents = pages.select("host", F.xxhash64("html").alias("content"))
    copied = cut_lineage(contents.groupBy("host", "content").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1"))
    weighed = pages.withColumn("content", F.xxhash64("html"))
    weighed = weighed.join(F.broadcast(copied) if copied.count() <= BROADCAST_ROWS else copied, ["host", "content"], "left")
    weighed = weighed.select("host", "page_key", "html", F.coalesce("copies", F.lit(1)).alias("copies"))
    rows = weighed.mapInArrow(_occurrences, _TOKENS)
    tokens = rows.groupBy("host", "token", "role", "parent", "kind").agg(
        F.max("main").alias("main"), F.sum("others").alias("others"), F.bit_xor("vector").alias("vector"), F.sum("pages").alias("pages"), F.sum("chars").alias("chars"))
    hosts = contents.groupBy("host").agg(F.countDistinct("content").alias("host_pages")).where(F.col("host_pages") >= least_pages)
    # written once: every step behind reads the few tokens that are left, not the pages
    frequent = (F.col("kind") == ORDER) | (F.round("pages", 6) >= support * F.col("host_pages"))
    large = cut_lineage(tokens.join(hosts, "host").where(frequent).withColumns({
        "pages": F.round("pages", 6), "is_text": F.col("kind") == TEXT, "is_other": F.col("others") * 2 > F.col("pages")}).drop("others", "host_pages"))
    found = large.where(F.col("kind") != ORDER).drop("kind")
    classes = found.groupBy("host", "vector", "pages").agg(F.min("token").alias("class_key"))
    members = cut_lineage(found.join(classes, ["host", "vector", "pages"]))
    # order: elements of one class that stand now before, now behind each other are in no class, nor are the texts in them
    orders = large.where(F.col("kind") == ORDER).select("host", "parent", F.col("token").alias("a"), F.col("role").alias("b"))
    twice = orders.groupBy("host", "parent", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR a = b")
    named = members.where("NOT is_text").select("host", "role", "class_key")
    crossed = twice.join(named.withColumnsRenamed({"role": "a", "class_key": "class_a"}), ["host", "a"]).join(
        named.withColumnsRenamed({"role": "b", "class_key": "class_b"}), ["host", "b"]).where("class_a = class_b")
    broken = crossed.select("host", F.explode(F.array("a", "b")).alias("role")).distinct().withColumn("broken", F.lit(True))
    # nesting: the element around a token must be on half of the pages too (or be the page itself)
    outer = found.where("NOT is_text").select("host", F.col("role").alias("parent")).distinct().withColumn("nested", F.lit(True))
    fits = F.coalesce("nested", F.col("parent") == 0) & F.col("broken").isNull()
    members = members.join(broken, ["host", "role"], "left").join(outer, ["host", "parent"], "left").withColumn("fits", fits).drop("broken", "nested")
    sizes = members.where("fits").groupBy("host", "class_key").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("is_text")).alias("n_elements"))
    sizes = sizes.where((F.col("n") >= least_tokens) & (F.col("n_elements") > 0)).select("host", "class_key", F.lit(True).alias("enough"))
    return members.join(sizes, ["host", "class_key"], "left").withColumn("valid", F.col("fits") & F.col("enough").isNotNull()).drop("fits", "enough")


def templates(pages: DataFrame, support: float = SUPPORT, least_pages: int = LEAST_PAGES, least_tokens: int = LEAST_TOKENS) -> DataFrame:
    """The members of the equivalence classes that make a host's template."""
    return frequent_tokens(pages, support, least_pages, least_tokens).where("valid").drop("valid")


def _slot(table: pa.Table) -> pa.Table:
    """One host's frequent tokens (elements and texts of a few pages) -> its slot."""
    tokens = table.to_pylist()
    fixed = sorted({t["token"] for t in tokens if t["valid"] and t["is_text"]})
    elements = {t["role"]: t for t in tokens if not t["is_text"]}
    own = {r: t["chars"] for r, t in elements.items()}  # text inside that is no template
    for t in tokens:
        role = t["role"] if t["valid"] and t["is_text"] else None
        while role in elements:
            own[role] -= t["chars"]
            role = elements[role]["parent"]
    most: dict = defaultdict(float)
    for r, t in elements.items():
        most[t["parent"]] = max(most[t["parent"]], own[r])
    # of elements around the same text the innermost
    able = [(t["main"], most[r] < own[r] - 1e-6, round(own[r], 6), r) for r, t in elements.items() if t["valid"] and not t["is_other"]]
    main, _, _, role = max(able, default=(0, False, 0, None))
    return pa.table({"host": table["host"][:1], "slot": pa.array([role], pa.int64()), "is_article": [main > 0], "fixed": pa.array([fixed], pa.list_(pa.int64()))})


def slots(tokens: DataFrame) -> DataFrame:
    """Per host: the role of the main slot's element, whether it is an article, and the template's texts. From ``frequent_tokens``.

    Candidates are template elements that hold no other matter. The article wins; else the element with most text that is no
    template, and of elements around the same text the innermost.
    """
    used = tokens.select("host", "token", "role", "parent", "is_text", "main", "is_other", "chars", "valid")
    return used.groupBy("host").applyInArrow(_slot, "host string, slot bigint, is_article boolean, fixed array<bigint>")


def text_of(page: str, slot: int | None, is_article: bool | None, fixed: frozenset) -> str:
    """The blocks of the slot, joined by line ends. An article keeps all its blocks, also those that other pages repeat; of
    another slot the template's texts go. A page without the slot is read by its own article, else as one slot."""
    found = structure(page)[1]
    inside = [x for x in found if any(n.role == slot for n in x[1])] if slot is not None else []
    if not (inside and is_article):
        inside = [x for x in found if any(n.main for n in x[1])] or [x for x in inside or found if string_hash(x[1][-1].role, x[0]) not in fixed]
    return "\n".join([x[0] for x in inside])


def _extract(batches):
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])
    for batch in batches:
        for piece in pieces(batch, "html", 8 << 20):
            known: dict = {}
            texts = []
            for host, page, slot, is_article, fixed in zip(*(piece[c].to_pylist() for c in ("host", "html", "slot", "is_article", "fixed"))):
                if host not in known:
                    known[host] = frozenset(fixed or ())
                texts.append(text_of(page or "", slot, is_article, known[host]))
            yield pa.RecordBatch.from_arrays([one_array(piece["page_id"]), one_array(piece["url"]), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], schema=schema)


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html", support: float = SUPPORT, least_pages: int = LEAST_PAGES) -> DataFrame:
    """Per row: page_id, url, text (the article's blocks, joined by a line end) and n_chars.

    Null and empty pages have an empty text. A missing url is a host of its own. Repeated rows each give a row; other
    columns are ignored; no rows, no result rows.
    """
    host = F.lower(F.coalesce(F.regexp_extract(F.col(url), HOST, 1), F.lit("")))
    rows = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).alias("url"), host.alias("host"), F.col(page).alias("html"))
    keyed = rows.select("host", F.xxhash64("page_id", "url", "html").alias("page_key"), "html")
    found = slots(frequent_tokens(keyed, support, least_pages))
    return rows.join(found, "host", "left").select("page_id", "url", "host", "html", "slot", "is_article", "fixed").mapInArrow(
        _extract, "page_id bigint, url string, text string, n_chars bigint")
