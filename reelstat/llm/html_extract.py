"""Main text of web pages by equivalence classes of template tokens.

A token is an element's path (names with class or id words) or such a path with a block's own text. Over all different
pages of a host each token has a vector of occurrences per page; tokens with equal vectors form an equivalence class.
Vectors are never gathered: a commutative fingerprint of (page, count), the number of pages and the number of
occurrences stand for them, so a host of any size is summed up by partial aggregates. A class has to stand on at least
half of the host's pages. Its tokens are taken apart by the valid class that encloses them; of ``LEAST_TOKENS`` and more
together they are valid, and the valid classes, nested so, are the host's template. Equal pages count as one.

The slots of the template are what lies in its elements. Slots of menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are dropped; where the template has an
article (or main) slot, the text is what that slot holds. On pages without one, all
other slots are taken but for blocks whose own text is a token of a valid class: these belong to the template.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.llm.common import written
from reelstat.llm.linking import BROADCAST_BYTES, small

LEAST_SHARE = 0.5  # of a host's pages that must hold a template token
LEAST_PAGES = 2
HOSTS = 1_000  # a host with more than this fraction of the pages is dealt out in parts
LEAST_TOKENS = 2  # of a valid class in one enclosing class: a token that recurs all alone is no template

# Element names by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
CLOSES_PARAGRAPH = BLOCK - frozenset("html head body".split())
DROPPED = frozenset(
    "aside button canvas dialog footer form head iframe input menu nav noscript object script select style svg "
    "template textarea title".split()
)
DROPPED_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
DROPPED_WORDS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted related "
    "replies respond share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
OUTSIDE_ARTICLE = frozenset(("header", "masthead"))
MAIN = frozenset(("article", "main"))

# A quote opens a value only after "="; one that is never closed is a character like others. What is not closed ends with the page,
# so that a search never fails after a long way and no place is read twice.
_markup = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[\"']?))*+)(?:>|\Z)", re.DOTALL
)
_attribute = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_name_words = re.compile(r"[a-z]+").findall
# what may stand beside a dropped word in one class token; any other word makes it another thing (ad-free, has-sidebar)
QUALIFIERS = frozenset(
    "area bar block bottom box container content desktop first global inner item items last left links list main mobile outer "
    "page post primary right secondary section site slot sub top widget widgets wrap wrapper".split()
)
# kinds of content: articles in them are no page's main text, whatever else is there
OWN_CONTENT = frozenset("comment comments disqus promo promoted related replies respond sponsored".split())


def _role_main(attributes: str) -> bool:
    found = _attribute.findall(attributes) if attributes and "=" in attributes else ()
    return any(kind.lower() == "role" and next((v for v in values if v), "").lower().strip() in MAIN for kind, *values in found)


def _says(token: str, words: frozenset[str]) -> bool:
    """Whether a whole class token or id names one of ``words``."""
    parts = _name_words(token)
    return not words.isdisjoint(parts) and all(w in words or w in DROPPED_WORDS or w in QUALIFIERS for w in parts)


class Block:
    """A run of text in one block element: its path, whether it is dropped, whether it lies in an article."""

    __slots__ = ("path", "dropped", "article", "parts")

    def __init__(self, path: str, dropped: bool, article: str | None):
        self.path, self.dropped, self.article, self.parts = path, dropped, article, []

    @property
    def text(self) -> str:
        return " ".join("".join(self.parts).split())


class Element:
    """An open element. ``wrappers``: its number and those of the elements around it that are dropped but may be spared, None if one may not."""

    __slots__ = ("name", "path", "dropped", "article", "wrappers", "mixed")

    def __init__(self, name: str, path: str, dropped: bool, article: str | None, wrappers: tuple[int, ...] | None = (), mixed: bool = False):
        self.name, self.path, self.dropped, self.article, self.wrappers, self.mixed = name, path, dropped, article, wrappers, mixed


def _child(parent: Element, name: str, attributes: str, number: int = -1, spared: frozenset[int] = frozenset()) -> Element:
    words, role, names = [], "", []
    if attributes and "=" in attributes:
        for kind, *values in _attribute.findall(attributes):
            value = next((v for v in values if v), "").lower()
            if kind.lower() == "role":
                role = value.strip()
            else:
                words += _name_words(value)
                names += value.split()
    token = name + "".join(f".{w}" for w in words)
    path = f"{parent.path}/{token}"
    named = [n for n in names if _says(n, DROPPED_WORDS) or parent.article is None and _says(n, OUTSIDE_ARTICLE)]
    by_name = name in DROPPED or parent.article is None and name in OUTSIDE_ARTICLE
    drop = (by_name or role in DROPPED_ROLES or bool(named)) and name not in ("html", "body") and number not in spared
    wrappers, mixed = parent.wrappers, False
    if drop:
        fixed = by_name and name != "form" or any(_says(n, OWN_CONTENT) for n in named)
        wrappers = None if fixed or wrappers is None else (*wrappers, number)
        mixed = name == "form" or len(named) < len(names)
    dropped = parent.dropped or drop
    article = parent.article or (path if (name in MAIN or role in MAIN) and not dropped else None)
    return Element(name, path, dropped, article, wrappers, mixed)


def parse(page: str) -> tuple[Counter, list[Block]]:
    """Counts of the page's element tokens, and its text blocks in order. Character references are decoded.

    Elements that would be dropped by class, id or role, and forms, are spared where they wrap the page: where its only articles
    (or main) lie in them, or else where no text is left and they are forms or have other class names, too.
    """
    tokens, blocks, around_main, mixed = _parse(page, frozenset())
    if all(b.dropped or b.article is None for b in blocks) and around_main:
        tokens, blocks, _, _ = _parse(page, around_main)
    elif mixed and all(b.dropped for b in blocks):
        tokens, blocks, _, _ = _parse(page, mixed)
    return tokens, blocks


def _parse(page: str, spared: frozenset[int]) -> tuple[Counter, list[Block], frozenset[int], frozenset[int]]:
    """Tokens and blocks, the numbers of dropped elements around articles and of those that may be wrappers by their names."""
    around_main: set[int] = set()
    mixed: set[int] = set()
    number = 0
    tokens: Counter = Counter()
    stack = [Element("", "", False, None)]
    blocks: list[Block] = []
    block: Block | None = None
    at, size = 0, len(page)
    while at < size:
        found = _markup.search(page, at)
        start = found.start() if found else size
        if start > at:
            if block is None:
                top = stack[-1]
                block = Block(top.path, top.dropped, top.article)
                blocks.append(block)
            block.parts.append(html.unescape(page[at:start]))
        if not found:
            break
        at = found.end()
        closing, name, attributes = found.groups()
        if name is None:
            continue
        name = name.lower()
        if closing:
            if any(e.name == name for e in stack):
                while stack[-1].name != name:
                    stack.pop()
                stack.pop()
                if name in BLOCK:
                    block = None
                elif stack[-1].dropped != (block is not None and block.dropped):
                    block = None
            continue
        if name in CLOSES_PARAGRAPH:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == "p":
                    del stack[k:]
                    break
                if stack[k].name in BLOCK:
                    if stack[k].name == name == "li":
                        del stack[k:]
                    break
        element = _child(stack[-1], name, attributes, number, spared)
        number += 1
        if element.wrappers:
            if name in MAIN or _role_main(attributes):
                around_main.update(element.wrappers)
            if element.mixed and element.wrappers[-1] == number - 1:
                mixed.add(number - 1)
        tokens[element.path] += 1
        if name in BLOCK or name in RAW or element.dropped != stack[-1].dropped or element.article != stack[-1].article:
            block = None
        if name == "br":
            if block is not None:
                block.parts.append(" ")
            continue
        if name in VOID:
            continue
        if name in RAW:  # its content is no markup
            end = re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(page, at)
            at = end.end() if end else size
            continue
        if not attributes.rstrip().endswith("/") or name in BLOCK:
            stack.append(element)
    return tokens, [b for b in blocks if b.text], frozenset(around_main), frozenset(mixed)


def _text_key(path: str, text: str) -> str:
    return f"{path}#{xxhash.xxh64_hexdigest(text)}"


def page_tokens(page: str) -> Counter:
    """The tokens that are compared across pages: elements, and block texts outside article and dropped elements."""
    tokens, blocks = parse(page)
    tokens.update(_text_key(b.path, b.text) for b in blocks if not b.dropped and b.article is None)
    return tokens


def main_text(page: str, template: frozenset[str]) -> str:
    """The page's remaining slots, given the host's template tokens."""
    _, blocks = parse(page)
    left = [b for b in blocks if not b.dropped]
    articles = [b for b in left if b.article is not None]
    if any(b.article in template for b in articles):
        left = [b for b in articles if b.article in template]
    elif articles:  # an article of its own on a page whose host has none
        left = articles
    else:
        left = [b for b in left if _text_key(b.path, b.text) not in template]
    return "\n".join(b.text for b in left)


def _host(url):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#]*)", 1), F.lit("")))


def _shape(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    return pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
        _host(F.col(url_col)).alias("host"),
    )


def different_pages(shaped: DataFrame) -> DataFrame:
    """(host, digest, html) of the different pages of each host; copies of a page say nothing of a template."""
    digested = shaped.select("host", "html", F.md5("html").alias("digest"))
    copies = written(digested.groupBy("host", "digest").count().where("count > 1").select("host", "digest"), "page-copies")
    marked = digested.join(small(copies.withColumn("copied", F.lit(True))), ["host", "digest"], "left")
    copied = marked.where("copied").dropDuplicates(["host", "digest"])
    return marked.where("copied is null").unionByName(copied).drop("copied")


def token_vectors(different: DataFrame) -> DataFrame:
    """(host, token): pages, occurrences and the fingerprint of the token's occurrence vector."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, pages, tokens, counts = [], [], [], []
            for digest, page, host in zip(batch.column(0), batch.column(1), batch.column(2)):
                for token, n in page_tokens(page.as_py()).items():
                    hosts.append(host.as_py())
                    pages.append(digest.as_py())
                    tokens.append(token)
                    counts.append(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(pages, pa.string()), pa.array(tokens, pa.string()), pa.array(counts, pa.int64())],
                names=["host", "digest", "token", "n"],
            )

    counted = different.select("digest", "html", "host").mapInArrow(count, "host string, digest string, token string, n long")
    return counted.groupBy("host", "token").agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum("n").alias("occurrences"),
        F.bit_xor(F.xxhash64("digest", "n")).alias("vector"),
    )


def templates(shaped: DataFrame) -> DataFrame:
    """(host, classes): the tokens of each of the host's frequent equivalence classes."""
    different = different_pages(shaped)
    vectors = token_vectors(different)
    sizes = different.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    frequent = vectors.join(sizes, "host").where(
        (F.col("pages") >= LEAST_PAGES) & (F.col("pages") >= LEAST_SHARE * F.col("host_pages"))
    )
    classes = frequent.groupBy("host", "pages", "occurrences", "vector").agg(F.array_sort(F.collect_set("token")).alias("members"))
    # tokens on half of the pages: no more of them than two average pages have, whatever the host's size
    return classes.groupBy("host").agg(F.array_sort(F.collect_list("members")).alias("classes"))


def _enclosing(token: str):
    """The paths of the elements around a token, innermost first."""
    path, text, _ = token.partition("#")
    if not text:
        path = path.rpartition("/")[0]
    while path:
        yield path
        path = path.rpartition("/")[0]


def template_of(classes: list[list[str]]) -> frozenset[str]:
    """The tokens of the valid classes.

    A class lies in the slots of the classes that enclose it. Tokens of one class that lie in different valid classes are
    taken apart, and fewer than ``LEAST_TOKENS`` in one are no class; this is repeated until nothing changes.
    """
    frequent = nested([token for members in classes for token in members])
    valid = {token: number for number, members in enumerate(classes) for token in members if token in frequent}
    before = -1
    while len(valid) != before:
        before = len(valid)
        parts = defaultdict(list)
        for token, number in valid.items():
            around = (valid[p] for p in _enclosing(token) if valid.get(p, number) != number)
            parts[number, next(around, -1)].append(token)
        valid = {token: number for (number, _), part in parts.items() if len(part) >= LEAST_TOKENS for token in part}
    return frozenset(valid)


def nested(candidates: list[str]) -> frozenset[str]:
    """Of the frequent classes' tokens those whose enclosing elements are all frequent, too."""
    every, valid = set(candidates), set()
    for token in sorted(every, key=len):
        element = token.split("#")[0]
        parent = element.rpartition("/")[0] if "#" not in token else element
        if not parent or parent in valid:
            valid.add(token)
    return frozenset(valid)


SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def with_templates(shaped: DataFrame) -> DataFrame:
    """The pages with their host's ``classes`` (null: none).

    Templates of few bytes in all are broadcast. Else both sides are dealt out by host, a host with more than a ``HOSTS``-th of
    all pages (fewer than ``HOSTS`` hosts can have that) in parts, each of which meets a copy of the template.
    """
    found = written(templates(shaped), "templates")
    size = found.agg(F.sum(F.length(F.to_json("classes")) + F.length("host"))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        return shaped.join(F.broadcast(found), "host", "left")
    sizes = shaped.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    total = shaped.count()
    hot = sizes.where(F.col("n") * HOSTS > total).select("host", F.ceil(F.col("n") * HOSTS / total).cast("int").alias("parts"))
    hot = F.broadcast(written(hot, "hot-hosts"))  # fewer than HOSTS rows
    part = F.pmod(F.xxhash64("page_id", "url"), F.coalesce("parts", F.lit(1))).cast("int").alias("part")
    dealt = shaped.join(hot, "host", "left").select(*shaped.columns, part)
    copies = found.join(hot, "host", "left").select(
        "host", "classes", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part")
    )
    return dealt.join(copies, ["host", "part"], "left").drop("part")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages``.

    A null html counts as empty: empty text, 0 characters. A null or odd url puts the page
    with the host of the empty name. Repeated rows each give a row; other columns are not looked at; an empty table gives no rows.
    """
    shaped = _shape(pages, id_col, url_col, html_col)
    met = with_templates(shaped).select("page_id", "url", "html", "host", "classes")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, frozenset[str]] = {}  # a host has one template
        for batch in batches:
            texts = []
            for page, host, classes in zip(batch.column(2), batch.column(3).to_pylist(), batch.column(4)):
                if host not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[host] = template_of(classes.as_py() or [])
                texts.append(main_text(page.as_py(), known[host]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                schema=SCHEMA,
            )

    return met.mapInArrow(cut, "page_id long, url string, text string, n_chars long")
