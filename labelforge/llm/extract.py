"""Main text of web pages by equivalence-class template deduction.

A page is a sequence of tokens: its tags, each with the path of open elements,
and its text blocks, each with its path and content.  Over the pages of a host
every token has an occurrence vector (how often it occurs in each page).
Tokens of a host with equal vectors form an equivalence class; a class is valid
when it has at least ``MIN_TOKENS`` tokens, a tag among them, and at least
``MIN_PAGES`` pages and half of the host's pages support it.  Valid classes nest:
the outermost tag of a class must stand at the top of the page or directly
inside a tag of another class that is itself nested, its parent (``nest``).  The
tree of nested classes is the host's template; classes that hang nowhere are not
part of it.  Text that is no token of the template is what fills its slots.

A page's text is what fills the slots inside its article: the ``article`` or
``main`` element if it has one, else all slots of the body that hold more than
links.  Inside an article an element is part of the template when its tag lies
in the class of one of its texts (wherever it stands it holds that text) and all
its text is template text; a passage that articles of a host share stays, as its
element holds other text elsewhere.  A template never takes all text of an
article.  Elements that are no article text by tag, role or name are left out as
well; a name tells by its last word that is not one of ``CONTAINERS``.

Defined cases: null or empty html gives empty text; a null url or one without a
host counts as one host of its own; pages of hosts with fewer than
``MIN_PAGES`` pages have no template and all text outside named boilerplate is
a slot; repeated rows give equal texts; unclosed or crossing tags close
implicitly; extra columns are ignored.  A page is read in linear time and
memory however deep its elements nest or many tags stay open: long paths
are replaced by their hash, and nothing walks the stack.

Scale: two map passes.  Vectors are never built: a token carries sums of page
hashes times its count, equal exactly when the vectors are (up to 62-bit
collisions), so they aggregate partially and a host may hold a third of all
pages.  Tokens on half of a host's pages number at most twice the mean tokens of
a page, so a host's template is one bounded row; with less support it would grow
with the host.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, map_arrow, pieces, stage

MIN_TOKENS = 3
MIN_PAGES = 3
PATH_CHARS = 256    # a longer path of open elements is replaced by its hash

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_SPACE = re.compile(r"\s+")
_WORDS = re.compile(r"[a-z]+")
_WORD_CHAR = re.compile(r"\w")
_RAW = ("script", "style", "noscript", "template", "iframe", "textarea", "title", "svg", "object", "select")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for t in _RAW}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split())
# elements that are no article text, by name, role, or the telling word of a class or id
SKIP = frozenset("head nav aside footer form button dialog menu input option select".split())
SKIP_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split())
SKIP_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox banner promo promotion sponsor sponsored sponsors cookie "
    "cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login sidebar "
    "sidebars aside menu menus nav navbar navigation breadcrumb breadcrumbs footer comment comments reply replies disqus "
    "share sharing social related recommended recommendations pagination pager search widget widgets toolbar masthead "
    "disclaimer copyright".split())
# words of a class or id that say what holds something, not what it holds
CONTAINERS = frozenset(
    "area bar block box bottom col column container div group holder inner item items left link links list module outer pane "
    "panel region right row section sections slot top unit wrap wrapper".split())
# start tags that close an open paragraph or an element of their own kind
_CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol "
    "p pre section table ul".split())
_OWN = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}}
_STOPS = frozenset("ul ol dl table tbody thead tfoot body html".split())


class _Open:
    """An element.  ``skip``: it or one around it is left out by tag or role;
    ``named``: the innermost element, itself included, that a word of its class or
    id leaves out unless it turns out to hold the page's text."""
    __slots__ = ("name", "above", "skip", "named", "article", "path", "text", "articles", "held", "blocks", "fixed")

    def __init__(self, name: str, above: _Open | None, skip: bool, named: bool, article: bool, path: str):
        self.name, self.above, self.article, self.path = name, above, article, path
        self.skip = skip or above is not None and above.skip
        self.named = self if named else above.named if above is not None else None
        self.text = self.articles = 0           # of a named element: characters, articles in it
        self.held = True                        # of a named element: it and the named ones around it hold the text
        self.blocks = self.fixed = 0            # blocks in it, and those of the template


def _telling(name: str) -> str:
    """The last word of a class or id that is not a container's; "" if none."""
    return next((w for w in reversed(_WORDS.findall(name)) if w not in CONTAINERS), "")


def _skipped(name: str, attrs: str, inside_article: bool) -> tuple[bool, bool]:
    """Whether an element is no article text by its tag or role, and by its names."""
    if name in SKIP or name == "header" and not inside_article:
        return True, False
    if "=" not in attrs:
        return False, False
    named = False
    for key, a, b, c in _ATTR.findall(attrs):
        value = (a or b or c).lower()
        if key.lower() == "role" and value.strip() in SKIP_ROLES:
            return True, False
        if key.lower() in ("class", "id"):
            named = named or any(_telling(own) in SKIP_WORDS for own in value.split())
    # an article inside an article may be a comment, the others hold the page's text
    return False, named and name not in ("html", "body", "main") and (name != "article" or inside_article)


class Block:
    """A stretch of text without a block border: path, text, whether all of it is in
    links, whether it is inside an article and inside left out elements, and the
    innermost open element."""
    __slots__ = ("path", "text", "linked", "article", "skip", "within")

    def __init__(self, text: str, linked: bool, within: _Open):
        self.path, self.article, self.skip = within.path, within.article, within.skip
        self.text, self.linked, self.within = text, linked, within


def _below(path: str, label: str) -> str:
    """Path of an element with this label inside one with that path."""
    if len(path) > PATH_CHARS:
        path = f"#{_depth(path)}:{xxhash.xxh64_hexdigest(path.encode('utf-8', 'surrogatepass'))}"
    return f"{path}/{label}"


def _depth(path: str) -> int:
    """Open elements on a path."""
    if path.startswith("#"):
        above, _, rest = path[1:].partition(":")
        return int(above) + rest.count("/")
    return path.count("/")


def parse(page: str) -> tuple[list[str], list[Block]]:
    """Tag tokens (paths) and text blocks of a page, in order."""
    return _parse(page)[:2]


def _parse(page: str) -> tuple[list[str], list[Block], list[_Open]]:
    """Tag tokens, text blocks and elements of a page, each in order."""
    stack = [_Open("", None, False, False, False, "")]
    elements = [stack[0]]
    where: dict[str, list[int]] = {}            # places of the open elements, by name
    borders = [0]                               # places of the open elements that are not inline
    articles = 0
    tags: list[str] = []
    blocks: list[Block] = []
    text: list[str] = []
    plain = False                               # the text holds words outside links

    def flush():
        nonlocal plain
        if text:
            joined = _SPACE.sub(" ", html.unescape("".join(text))).strip()
            text.clear()
            if joined:
                blocks.append(Block(joined, not plain, stack[-1]))
        plain = False

    def pop_to(k: int):
        if borders[-1] >= k:
            flush()
            while borders[-1] >= k:
                borders.pop()
        for e in stack[k:]:
            where[e.name].pop()
        del stack[k:]

    def last(names: Iterable[str]) -> int:
        """Place of the innermost open element of these names, 0 if none."""
        return max((where[n][-1] for n in names if where.get(n)), default=0)

    def close_open(names: Iterable[str], stops: frozenset[str]):
        k = last(names)
        if k and k >= last(stops):
            pop_to(k)

    at = 0
    while at < len(page):
        m = _TOKEN.search(page, at)
        end = m.start() if m else len(page)
        if end > at:
            text.append(page[at:end])
            plain = plain or not where.get("a") and bool(_WORD_CHAR.search(html.unescape(page[at:end])))
        if not m:
            break
        at = m.end()
        name = (m.group(2) or "").lower()
        if not name:
            continue
        if m.group(1):
            k = last((name,))
            if name not in INLINE and not k:
                flush()
            elif k and (name not in INLINE or k > borders[-1]):
                pop_to(k)
            continue
        attrs = m.group(3)
        if name in _RAW and not attrs.endswith("/"):
            stop = _RAW_END[name].search(page, at)
            at = stop.end() if stop else len(page)
            if name not in ("title",):
                text.append(" ")
            continue
        if name in _CLOSES_P:
            close_open({"p"}, frozenset(("div", "article", "section", "main", "td", "body", "li", "blockquote")))
        if name in _OWN:
            close_open(_OWN[name], _STOPS)
        if name == "br":
            text.append(" ")
        if name not in INLINE:
            flush()
        if name in VOID or attrs.endswith("/") and name not in INLINE:
            continue
        top = stack[-1]
        label = name
        if name not in INLINE and "=" in attrs:
            classes = [a or b or c for key, a, b, c in _ATTR.findall(attrs) if key.lower() == "class"]
            label = f"{name}.{'.'.join(sorted(classes[0].split()))}".replace("/", "|") if classes else name
        path = top.path if name in INLINE else _below(top.path, label)
        inside = top.article or name in ("article", "main") and not top.skip
        if inside and not top.article:
            articles += 1
            if top.named is not None:
                top.named.articles += 1
        where.setdefault(name, []).append(len(stack))
        if name not in INLINE:
            borders.append(len(stack))
            tags.append(path)
        stack.append(_Open(name, top, *_skipped(name, attrs, top.article), inside, path))
        elements.append(stack[-1])
    pop_to(1)
    flush()
    _judge(blocks, elements, articles)
    return tags, blocks, elements


def _judge(blocks: list[Block], elements: list[_Open], articles: int):
    """Mark the blocks inside elements with a telling name, except elements that
    hold over half of the text (of the articles if inside one, else of the page),
    or all articles of the page and no less than stands outside named elements."""
    page = inside = plain = 0
    for b in blocks:
        if not b.skip:
            page += len(b.text)
            inside += len(b.text) * b.article
            if b.within.named is None:
                plain += len(b.text)
            else:
                b.within.named.text += len(b.text)
    named = [e for e in elements if e.named is e]
    for e in reversed(named):                   # an element comes after those around it
        if (above := e.above.named) is not None:
            above.text += e.text
            above.articles += e.articles
    for e in named:
        e.held = (e.text * 2 > (inside if e.article else page) or 0 < articles == e.articles and e.text >= plain) and \
            (e.above.named is None or e.above.named.held)
    for b in blocks:
        b.skip = b.skip or b.within.named is not None and not b.within.named.held
    for e in named:
        e.named = None                          # no cycle, so a page is freed at once


def _hash(kind: str, path: str, text: str = "") -> int:
    return xxhash.xxh64_intdigest(f"{kind}\x00{path}\x00{text}".encode("utf-8", "surrogatepass")) >> 1


def host(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per page and distinct token: host, token, a tag's path, its share of the two vector sums."""
    for whole in batches:
        for batch in pieces(whole, "html", 2 << 20):
            rows = []
            for url, raw in zip(batch.column("url").to_pylist(), as_bytes(batch.column("html"))):
                tags, blocks = parse(raw.decode("utf-8", "replace"))
                own = xxhash.xxh64_intdigest(raw, 17) ^ xxhash.xxh64_intdigest((url or "").encode(), 5)
                counts = Counter((_hash("t", p), p) for p in tags)
                counts.update((_hash("x", b.path, b.text), None) for b in blocks)
                counts[(0, None)] = 1                                  # the page itself
                where = host(url)
                for (token, path), n in counts.items():
                    h = xxhash.xxh64_intdigest(b"%d,%d" % (own, n))
                    rows.append((where, token, path, h >> 33, h & 0x7FFFFFFF))
            cols = zip(*rows)
            types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             ["host", "token", "path", "va", "vb"])


def equivalence_classes(pages: DataFrame) -> DataFrame:
    """(host, va, vb, pages, tokens, paths, texts): the valid classes of each host;
    ``va`` and ``vb`` stand for the occurrence vector, ``paths`` are the class's tag
    tokens and ``texts`` its text tokens."""
    counted = map_arrow(pages.select("url", "html"), _tokens, "host string, token long, path string, va long, vb long")
    vectors = counted.groupBy("host", "token").agg(
        F.count(F.lit(1)).alias("pages"), F.sum("va").alias("va"), F.sum("vb").alias("vb"), F.max("path").alias("path")
    ).filter(F.col("pages") >= MIN_PAGES)
    vectors = stage(vectors, "token-vectors")
    total = vectors.filter("token = 0").select(F.col("host").alias("h"), F.col("pages").alias("of"))
    held = vectors.filter("token <> 0").join(total, F.col("host") == F.col("h")).filter(F.col("pages") * 2 >= F.col("of"))
    return held.groupBy("host", "va", "vb", "pages").agg(
        F.count(F.lit(1)).alias("tokens"), F.sort_array(F.collect_list("path")).alias("paths"),
        F.collect_list(F.when(F.col("path").isNull(), F.col("token"))).alias("texts")
    ).filter((F.col("tokens") >= MIN_TOKENS) & (F.size("paths") > 0))


def _root(paths: list[str]) -> str:
    """The outermost tag of a class."""
    return min(paths, key=lambda p: (_depth(p), p))


def nest(paths: list[list[str]]) -> list[int | None]:
    """Parent of each class, given the tag paths of the classes: -1 at the top of
    the page, None for a class that hangs nowhere."""
    owner = {p: k for k, own in enumerate(paths) for p in own}
    owner.update({_below(p, "").rpartition("/")[0]: k for p, k in owner.items() if len(p) > PATH_CHARS})
    root = [_root(own) for own in paths]
    parent: list[int | None] = [None] * len(paths)
    for k in sorted(range(len(paths)), key=lambda k: _depth(root[k])):          # outermost first
        above = root[k].rpartition("/")[0]
        if not above:
            parent[k] = -1
        elif (holder := owner.get(above)) is not None and holder != k and parent[holder] is not None:
            parent[k] = holder
    return parent


def templates(pages: DataFrame) -> DataFrame:
    """(host, tokens, classes, tree): a host's template, one bounded row -- the
    tokens of its nested classes with their class, and per nested class (class,
    parent, root, tokens)."""
    def run(batches):
        for batch in batches:
            rows = []
            for where, classes in zip(batch.column("host").to_pylist(), batch.column("classes").to_pylist()):
                parent = nest([c["paths"] for c in classes])
                kept = [k for k, p in enumerate(parent) if p is not None]
                tokens = [(t, k) for k in kept for t in [*classes[k]["texts"], *(_hash("t", p) for p in classes[k]["paths"])]]
                rows.append((where, [t for t, _ in tokens], [k for _, k in tokens],
                             [{"class": k, "parent": parent[k], "root": _root(classes[k]["paths"]),
                               "tokens": classes[k]["tokens"]} for k in kept]))
            types = [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.struct(
                [("class", pa.int32()), ("parent", pa.int32()), ("root", pa.string()), ("tokens", pa.int64())]))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                             ["host", "tokens", "classes", "tree"])
    classes = equivalence_classes(pages).groupBy("host").agg(
        F.sort_array(F.collect_list(F.struct("va", "vb", "tokens", "paths", "texts"))).alias("classes"))
    return map_arrow(classes, run, "host string, tokens array<bigint>, classes array<int>, "
                                   "tree array<struct<class:int,parent:int,root:string,tokens:bigint>>")


def _slots(article: list[Block], elements: list[_Open], template: Mapping[int, int]) -> list[Block]:
    """The blocks of the article outside its elements that belong to the template."""
    classes = [template.get(_hash("x", b.path, b.text)) for b in article]
    for b, k in zip(article, classes):
        b.within.blocks += 1
        b.within.fixed += k is not None
    for e in reversed(elements[1:]):
        e.above.blocks += e.blocks
        e.above.fixed += e.fixed
    # an element whose text is template text through and through, and those around it up to the article
    whole = {id(e) for e in elements if e.above is not None and e.above.article and 0 < e.blocks == e.fixed}
    fixed: set[int] = set()                     # such elements whose tag shares its class with a text inside
    seen: set[tuple[int, int]] = set()
    for b, k in zip(article, classes):
        e = b.within
        while k is not None and id(e) in whole and (id(e), k) not in seen:
            seen.add((id(e), k))
            if e.name not in INLINE and template.get(_hash("t", e.path)) == k:
                fixed.add(id(e))
            e = e.above
    inside = set(fixed)
    for e in elements:                          # what lies inside a fixed element
        if e.above is not None and id(e.above) in inside:
            inside.add(id(e))
    return [b for b in article if id(b.within) not in inside]


def main_text(page: str, template: Mapping[int, int]) -> str:
    """Blocks of the page's article, joined by line feeds; ``template`` gives the
    class of each token of the host's template and may be empty."""
    _, blocks, elements = _parse(page)
    found = [b for b in blocks if b.article and not b.skip]
    if found:
        found = _slots(found, elements, template) or found if template else found
    else:
        body = [b for b in blocks if not b.skip and not b.linked]
        found = [b for b in body if _hash("x", b.path, b.text) not in template] or body
    return "\n".join(b.text for b in found)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per page of (page_id, url, html)."""
    pages = pages.select("page_id", "url", "html")
    found = stage(templates(pages), "templates").select(F.col("host").alias("__h"), "tokens", "classes")

    def with_host(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([host(u) for u in batch.column("url").to_pylist()], pa.string())],
                [*batch.schema.names, "host"])

    def run(batches):
        key, known = None, {}
        for whole in batches:
            for batch in pieces(whole, "html", 2 << 20):
                out = []
                for k, raw in enumerate(as_bytes(batch.column("html"))):
                    if batch.column("host")[k].as_py() != key:
                        key = batch.column("host")[k].as_py()
                        known = dict(zip(batch.column("tokens")[k].as_py() or (), batch.column("classes")[k].as_py() or ()))
                    out.append(main_text(raw.decode("utf-8", "replace"), known))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()),
                     pa.array([len(t) for t in out], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = dict(pages.dtypes)["page_id"]
    hosted = map_arrow(pages, with_host, f"page_id {kind}, url string, html string, host string")
    joined = hosted.join(found, F.col("host") == F.col("__h"), "left").drop("__h")
    return map_arrow(joined, run, f"page_id {kind}, url string, text string, n_chars long")
