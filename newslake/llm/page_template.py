"""Main text of pages by the template that a host's pages share.

Tokens are the start and end tags of each element, told apart by the elements around
them, and the texts between tags. A token's occurrence vector lists how often each
page of the host has it. Tokens with equal vectors form a class; vectors are compared by
the exclusive or over pages of a hash of (page, count), so a host of any size needs one
number per token, combined in the map tasks.

An element is valid if both its tags are in one class: it is then opened and closed alike on
every page and belongs to the template. The page itself is such an element. Valid elements nest
by their paths. A text in the class of any valid element around it is template text: it comes
with the element every time. Copies of one page are no evidence: a token needs enough pages
that differ. What is left are the slots. Slots of the article make the main text; pages without
one use all slots but those of menus, forms and the like.

Names come after the template: elements such as nav or aside, and classes or ids headed by words
such as ad or comments, are left out. A name in which the word only qualifies something else
(has-sidebar, category-social) decides nothing. An article in or with a name that is left out
counts where the page has no other article.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake import scratch

#: A host needs this many pages for texts to count as template.
MIN_PAGES = 4
#: Template texts that are sent to all tasks; with more, each page gets its own by a join.
MAX_SENT_TOKENS = 50_000

_TAG = re.compile(r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>?|<[!?][^>]*>?", re.DOTALL)
_NAMED = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_RAW = {"script", "style", "noscript", "template", "svg", "iframe", "textarea", "title", "object", "math"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s",
    "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "br", "wbr", "img",
}
#: What a start tag closes if it is open, up to the nearest container.
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "p": {"p"},
}
_CONTAINERS = {"article", "aside", "blockquote", "body", "div", "dl", "footer", "form", "header", "main", "nav", "ol", "section", "table", "ul"}
_OUT = {"nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "head", "header", *_RAW} - {"title"}
_OUT_WORDS = re.compile(
    r"(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|sidebar|side|menu|nav\w*|breadcrumbs?|footer|header|comments?|respond|replies|"
    r"notice\w*|cookie\w*|consent|newsletter|subscribe|subscription|signup|login|popup|modal|share|sharing|social|related|recommended|"
    r"widget|toolbar|pagination|pager|copyright|disclaimer|alert)", re.IGNORECASE,
)
#: With one of these in a name, the out word says what the element belongs to or has.
_QUALIFIES = {"has", "with", "without", "no", "is", "category", "cat", "tag", "topic", "type", "format", "layout", "page"}
_MAIN_ROLES = {"main", "articlebody"}
#: How names judge an element: nothing against it, an article in or with a name of _OUT_WORDS, such a name, an element of _OUT.
CLEAR, DOUBTFUL, NAMED, OUT = range(4)
START, END, TEXT = range(3)


def _key(*parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\x00".join(parts)) - (1 << 63)


def _named_out(names: str) -> bool:
    """Whether a class or id is headed by an out word: its first word, or its last if nothing says that it qualifies."""
    for name in names.split():
        words = [w for w in re.split("[_-]+", name.lower()) if w]
        if words and (_OUT_WORDS.fullmatch(words[0]) or _OUT_WORDS.fullmatch(words[-1]) and _QUALIFIES.isdisjoint(words)):
            return True
    return False


class Page:
    """Blocks of a page in order, and the tokens with their counts.

    A block is (text, key of the text token, 2 inside an article or 1 inside main, how names judge it).
    ``about`` tells of each token its kind, the start key of the element around it (of an end tag: its
    own) and, for start tags, the start keys of all elements around it and its own.
    """

    def __init__(self, source: str):
        self.blocks: list[tuple[str, int, int, int]] = []
        self.tokens: dict[int, int] = {}
        self.about: dict[int, tuple[int, int | None, tuple[int, ...] | None]] = {}
        root = _key("start", "")
        # Open elements: name, path, judged, main, start keys down to it.
        self.stack: list[tuple[str, str, int, int, tuple[int, ...]]] = [("", "", CLEAR, 0, (root,))]
        self.text: list[str] = []
        self._count(root, START, None, (root,))
        self._read(source)
        self._count(_key("end", ""), END, root)

    def _count(self, key: int, kind: int, around: int | None, keys: tuple[int, ...] | None = None) -> None:
        if key in self.tokens:
            self.tokens[key] += 1
        else:
            self.tokens[key], self.about[key] = 1, (kind, around, keys)

    def _end_block(self) -> None:
        if self.text:
            text = " ".join(html.unescape("".join(self.text)).split())
            self.text.clear()
            if text:
                _, path, judged, main, keys = self.stack[-1]
                key = _key("text", path, text)
                self._count(key, TEXT, keys[-1])
                self.blocks.append((text, key, main, judged))

    def _close(self, depth: int) -> None:
        self._end_block()
        del self.stack[depth:]

    def _read(self, source: str) -> None:
        at, find, n = 0, _TAG.search, len(source)
        while at < n:
            lt = source.find("<", at)
            if lt < 0:
                self.text.append(source[at:])
                break
            if lt > at:
                self.text.append(source[at:lt])
            tag = _TAG.match(source, lt)
            if not tag:
                self.text.append("<")
                at = lt + 1
                continue
            at = tag.end()
            name = tag[2]
            if name is None:
                continue
            name = name.lower()
            if tag[1]:
                self._end_tag(name)
                continue
            if name in _RAW:
                # Their content is no markup: up to the end tag, or to the end.
                stop = re.compile(f"</{re.escape(name)}\\b[^>]*>?", re.IGNORECASE).search(source, at)
                if not tag[3].rstrip().endswith("/"):
                    at = stop.end() if stop else n
                continue
            self._start_tag(name, tag[3])
        self._close(1)

    def _start_tag(self, name: str, attributes: str) -> None:
        if name in _INLINE:
            if name == "br":
                self.text.append(" ")
            return
        self._end_block()
        if name in _VOID:
            return
        closes = _CLOSES.get(name) or ({"p"} if name not in ("html", "head", "body") else set())
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] in closes:
                self._close(i)
                break
            if self.stack[i][0] in _CONTAINERS:
                break
        marks = {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in _NAMED.finditer(attributes)} if "=" in attributes else {}
        _, path, judged, main, keys = self.stack[-1]
        label = f"{name}.{marks['class']}" if marks.get("class") else name
        path = f"{path}/{label}"
        role, item = marks.get("role", "").lower(), marks.get("itemprop", "").lower()
        is_article = name == "article" or item == "articlebody"
        is_main = is_article or name == "main" or role in _MAIN_ROLES or item in _MAIN_ROLES
        words = f"{marks.get('class', '')} {marks.get('id', '')} {marks.get('role', '')}"
        # Of an article's own header only the frame around it is page furniture; a form may frame the whole page.
        if name in _OUT and not (name == "header" and main):
            judged = max(judged, NAMED if name == "form" else OUT)
        elif words.strip() and name not in ("html", "body") and _named_out(words):
            judged = max(judged, NAMED)
        if is_main and judged == NAMED and main < 2:
            judged = DOUBTFUL
        if is_main:
            main = 2 if is_article else max(main, 1)
        key = _key("start", path)
        keys = (*keys, key)
        self.stack.append((name, path, judged, main, keys))
        self._count(key, START, None, keys)

    def _end_tag(self, name: str) -> None:
        if name in _INLINE or name in _VOID:
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] == name:
                self._count(_key("end", self.stack[i][1]), END, self.stack[i][4][-1])
                self._close(i)
                return
        self._end_block()


_BLOCK = pa.struct([("text", pa.string()), ("token", pa.int64()), ("main", pa.int8()), ("judged", pa.int8())])
_ROWS = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("page", pa.int64()), ("blocks", pa.list_(_BLOCK)),
    ("token", pa.int64()), ("pages", pa.int64()), ("vector", pa.int64()), ("total", pa.int64()),
    ("kind", pa.int8()), ("around", pa.int64()), ("keys", pa.list_(pa.int64())), ("contents", pa.list_(pa.int64())),
])


def _parsed(min_pages: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Page rows with their blocks, and per split the sums of each (host, token).

    ``contents`` holds up to ``min_pages`` different pages of a token by their hash: no more are
    needed to tell whether all splits together have as many.
    """
    sums: dict[tuple[str, int], list] = {}

    def flush() -> pa.RecordBatch:
        n = len(sums)
        columns = [pa.nulls(n, f.type) for f in _ROWS]
        columns[2] = pa.array([k[0] for k in sums], pa.string())
        columns[5] = pa.array([k[1] for k in sums], pa.int64())
        for i in range(3):
            columns[6 + i] = pa.array(np.array([v[i] for v in sums.values()], np.uint64).view(np.int64))
        for i in range(3):
            columns[9 + i] = pa.array([v[3][i] for v in sums.values()], _ROWS.field(9 + i).type)
        columns[12] = pa.array([v[4] for v in sums.values()], _ROWS.field(12).type)
        sums.clear()
        return pa.RecordBatch.from_arrays(columns, schema=_ROWS)

    for batch in batches:
        for i in range(0, batch.num_rows, 500):
            part = batch.slice(i, 500)
            blocks = []
            for page, host, source in zip(part.column(3).to_pylist(), part.column(2).to_pylist(), part.column(4).to_pylist()):
                read, content = Page(source or ""), _key(source or "")
                # A page without template at hand keeps what names alone tell.
                blocks.append([dict(zip(("text", "token", "main", "judged"), b)) for b in read.blocks])
                for token, count in read.tokens.items():
                    own = sums.get((host, token))
                    if own is None:
                        own = sums[host, token] = [0, 0, 0, read.about[token], []]
                    own[0] += 1
                    own[1] ^= xxhash.xxh3_64_intdigest(f"{page}:{count}")
                    own[2] += count
                    if len(own[4]) < min_pages and content not in own[4]:
                        own[4].append(content)
            columns = [part.column(0), part.column(1), part.column(2), part.column(3), pa.array(blocks, pa.list_(_BLOCK))]
            yield pa.RecordBatch.from_arrays(columns + [pa.nulls(part.num_rows, f.type) for f in list(_ROWS)[5:]], schema=_ROWS)
            if len(sums) > 200_000:
                yield flush()
    yield flush()


def template_texts(tokens: DataFrame, work: str, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, token) of the texts that belong to a host's template.

    A class is named by its vector's hash, its pages and its occurrences.
    """
    whole = tokens.groupBy("host", "token").agg(
        F.sum("pages").alias("pages"), F.bit_xor("vector").alias("vector"), F.sum("total").alias("total"),
        F.max("kind").alias("kind"), F.max("around").alias("around"),
    ).filter(F.col("pages") >= min_pages)
    whole = scratch.stored(whole.select("host", "token", F.struct("pages", "vector", "total").alias("class"), "kind", "around"), f"{work}/often")
    often = tokens.join(whole.select("host", "token"), ["host", "token"], "left_semi")
    differ = often.select("host", "token", F.explode("contents").alias("content")).distinct().groupBy("host", "token").count()
    known = scratch.stored(whole.join(differ.filter(F.col("count") >= min_pages), ["host", "token"]).drop("count"), f"{work}/classes")

    starts = known.filter(F.col("kind") == START).select("host", F.col("token").alias("element"), "class")
    ends = known.filter(F.col("kind") == END).select("host", F.col("around").alias("element"), "class")
    valid = starts.join(ends, ["host", "element", "class"])
    above = often.filter(F.col("kind") == START).select("host", F.col("token").alias("around"), F.explode("keys").alias("element")).distinct()
    classes = above.join(valid, ["host", "element"]).select("host", "around", "class").distinct()
    texts = known.filter(F.col("kind") == TEXT).select("host", "token", "around", "class")
    return texts.join(classes, ["host", "around", "class"]).select("host", "token").distinct()


def main_texts(pages: DataFrame, work: str, min_pages: int = MIN_PAGES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars, blocks) of every row.

    Null and empty pages give an empty text. Null urls form one host of their own; hosts with
    fewer than ``min_pages`` pages have no template and are read by element names alone. Repeated
    rows are pages each. Text inside a block has its references decoded and its white space
    made one space; blocks are joined by one line feed. ``blocks`` lists the kept slots.
    """
    url = F.col(url_col).cast("string")
    host = F.coalesce(F.lower(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), url.alias("url"), host.alias("host"),
        F.monotonically_increasing_id().alias("page"), F.col(html_col).cast("string").alias("html"),
    )
    schema = (
        "page_id long, url string, host string, page long, blocks array<struct<text: string, token: long, main: byte, judged: byte>>, "
        "token long, pages long, vector long, total long, kind byte, around long, keys array<long>, contents array<long>"
    )
    read = scratch.stored(rows.mapInArrow(lambda b: _parsed(min_pages, b), schema), f"{work}/parsed")
    parsed = read.filter("token IS NULL").select("page_id", "url", "host", "page", "blocks")
    tokens = read.filter("token IS NOT NULL").drop("page_id", "url", "page", "blocks")
    fixed = scratch.stored(template_texts(tokens, work, min_pages), f"{work}/fixed")
    if fixed.count() <= MAX_SENT_TOKENS:
        # Few template texts go to the pages, by host; the pages stay where they are.
        by_host = fixed.groupBy("host").agg(F.collect_set("token").alias("template"))
        told = parsed.join(F.broadcast(by_host), "host", "left")
    else:
        hit = (
            parsed.select("page", "host", F.explode(F.transform("blocks", lambda b: b["token"])).alias("token")).distinct()
            .join(fixed, ["host", "token"]).groupBy("page").agg(F.collect_set("token").alias("template"))
        )
        told = parsed.join(hit, "page", "left")
    template = F.coalesce("template", F.array().cast("array<long>"))
    # The first choice that has any block: its slots are the text.
    choices = [
        lambda b: (b["main"] == 2) & (b["judged"] == CLEAR), lambda b: (b["main"] > 0) & (b["judged"] <= DOUBTFUL),
        lambda b: b["judged"] <= DOUBTFUL, lambda b: b["judged"] <= NAMED,
    ]
    taken = [lambda b: (b["main"] > 0) & (b["judged"] == CLEAR), *choices[1:]]
    slots = F.filter("blocks", lambda b: F.lit(False))
    for choice, take in list(zip(choices, taken))[::-1]:
        own = F.filter(F.filter("blocks", take), lambda b: ~F.array_contains(template, b["token"]))
        slots = F.when(F.exists("blocks", choice), own).otherwise(slots)
    kept = F.transform(slots, lambda b: b["text"])
    told = told.select("page_id", "url", kept.alias("blocks"))
    text = F.array_join("blocks", "\n")
    return told.select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"), "blocks")
