"""Reading elements, attributes and text out of HTML with Column expressions.

This is pattern extraction, not a parser. A page is cut once into its tags and the texts
between them; the tags become an index (place, name, classes) on which selectors are
filters. Comments, scripts, styles and declarations are removed first (``readable``). An
element ends at the closing tag that balances it, or at the end of the page when none
does. A paragraph ends at the first ``</p>`` or with its container, so an unclosed
paragraph does not repeat the text of those after it.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from newslake.functions.text import fold_space

_NOISE = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b.*?(?:</\1\s*>|\z)|<[!?][^>]*+>"
# The inside of a tag: a quote opens a value only behind an equals sign, and such a value may
# hold '>'. Loops are possessive, so a tag of any length is safe; the bound on its attributes
# keeps the matcher's stack small.
_INSIDE = r"""[^>"'=]*+(?:(?:=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])[^>"'=]*+){0,500}+"""
_TAG = rf"</?[a-zA-Z]{_INSIDE}>"
_REFERENCE = r"^(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*)"

# Named references, from the standard library's table. The old ones also stand without ';'
# and are then read by their longest beginning.
_NAMED = json.dumps({name[:-1]: text for name, text in html5.items() if name.endswith(";")})
_LEGACY = "^(?:" + "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))) + ")"
# Numbers of the C1 range stand for the characters of Windows-1252.
_C1 = json.dumps({i: bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(0x80, 0xA0)})


def _lookup(items: str, key: Column) -> Column:
    return F.try_element_at(F.from_json(F.lit(items), "map<string,string>"), key)


def _decode_references(text: Column, in_attribute: bool = False) -> Column:
    """Character references replaced by their text, once.

    Old names are also read without ';', by their longest known beginning; in an attribute only
    as a whole and not before an equals sign, where they may be part of an address. Each step
    below binds what the next one reads more than once.
    """

    def split_off(p: Column, i: Column) -> Column:
        name = F.when(i > 0, F.regexp_extract(p, _REFERENCE, 0)).otherwise("")
        return F.struct(p.alias("p"), name.alias("name"), (i > 0).alias("ref"))

    def examined(x: Column) -> Column:
        name = x["name"]
        # Leading zeros say nothing; what is still too long is no character.
        digits = F.regexp_replace(name, "^#[xX]?0*(?=.)", "")
        code = F.when(F.length(digits) > 8, F.lit(99999999).cast("long"))
        code = code.when(name.rlike("^#[xX]"), F.conv(digits, 16, 10).try_cast("long")).otherwise(digits.try_cast("long"))
        closed = F.substring(x["p"], F.length(name) + 1, F.lit(1))
        return F.struct(
            x["p"].alias("p"), name.alias("name"), x["ref"].alias("ref"), F.length(name).alias("size"), closed.alias("end"),
            F.when(name.startswith("#"), code).alias("code"), F.regexp_extract(name, _LEGACY, 0).alias("old"),
        )

    def read(x: Column) -> Column:
        code, closed = x["code"], x["end"] == ";"
        valid = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        char = F.when(code.between(0x80, 0x9F), _lookup(_C1, code.cast("string"))).when(valid, char).otherwise("\ufffd")
        old = F.when((x["old"] == x["name"]) & (x["end"] != "="), x["old"]) if in_attribute else x["old"]
        found = F.when(x["name"].startswith("#"), char).when(closed, _lookup(_NAMED, x["name"]))
        return F.struct(x["p"].alias("p"), x["ref"].alias("ref"), x["size"].alias("size"), closed.alias("closed"), found.alias("found"), old.alias("old"))

    def written(x: Column) -> Column:
        used = F.when(x["found"].isNotNull(), x["size"] + F.when(x["closed"], 1).otherwise(0)).otherwise(F.length(x["old"]))
        char = F.coalesce(x["found"], F.when(F.length(x["old"]) > 0, _lookup(_NAMED, x["old"])))
        known = F.when(x["size"] > 0, F.concat(char, F.substring(x["p"], used + 1, F.length(x["p"]))))
        return F.coalesce(known, F.when(x["ref"], F.concat(F.lit("&"), x["p"])).otherwise(x["p"]))

    steps = F.transform(F.split(text, "&"), split_off)
    for step in (examined, read, written):
        steps = F.transform(steps, step)
    return F.when(F.contains(text, F.lit("&")), F.array_join(steps, "")).otherwise(text)


def readable(html: Column) -> Column:
    """The page without comments, scripts, styles and declarations."""
    return F.regexp_replace(html, _NOISE, " ")


def text_of(fragment: Column) -> Column:
    """Visible text of a part of a ``readable`` page: no tags, references decoded, white space collapsed."""
    return as_text(F.regexp_replace(fragment, _TAG, " "))


def _written(tag: Column, name: str) -> Column:
    """Value of an attribute as it stands in an opening tag, quotes included; empty where absent."""
    other = rf"""(?:\s++(?!{name}[\s=>])[^\s=>"']++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>]++))?+)*+"""
    value = rf"""(?is)^<[\w-]++{other}\s+{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
    return F.when(F.contains(F.lower(tag), F.lit(name)), F.regexp_extract(tag, value, 1)).otherwise("")


def raw_attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of one opening tag with its references as written; null where absent."""
    written = _written(tag, name)
    return F.when(written != "", F.regexp_replace(written, """^["']|["']$""", ""))


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of one opening tag; null where absent."""
    return _decode_references(raw_attribute(tag, name), in_attribute=True)


def opening_tags(html: Column, name: str) -> Column:
    """All opening tags of an element name, in page order."""
    return F.regexp_extract_all(html, F.lit(rf"(?is)<{name}(?=[\s/>]){_INSIDE}>"), F.lit(0))


# -- the tag index ------------------------------------------------------------------
Test = Callable[[Column], Column]


def texts_between(html: Column) -> Column:
    """The texts between the tags of a ``readable`` page: one more than there are tags."""
    return F.split(html, _TAG)


def tag_index(html: Column) -> Column:
    """All tags in page order: ``i``, lower-case ``name``, ``ends`` (a closing tag), ``classes``, ``tag``.

    ``classes`` are set off by blanks on both sides; null without any.
    """

    def entry(tag: Column, i: Column) -> Column:
        classes = F.translate(_written(tag, "class"), "\"'\t\n\r\f", "      ")
        ends = tag.startswith("</")
        return F.struct(
            i.alias("i"),
            F.lower(F.regexp_extract(tag, r"^</?([^\s/>]++)", 1)).alias("name"),
            ends.alias("ends"),
            F.when(~ends, F.concat(F.lit(" "), classes, F.lit(" "))).alias("classes"),
            tag.alias("tag"),
        )

    return F.transform(F.regexp_extract_all(html, F.lit(_TAG), F.lit(0)), entry)


def named(name: str) -> Test:
    return lambda e: ~e["ends"] & (e["name"] == name)


def with_class(cls: str, name: str | None = None) -> Test:
    """Elements of a class; case matters."""
    has = lambda e: F.coalesce(F.contains(e["classes"], F.lit(f" {cls} ")), F.lit(False))
    return has if name is None else lambda e: (e["name"] == name) & has(e)


def with_value(attr: str, value: str, name: str | None = None) -> Test:
    """Elements with an attribute of exactly this value."""
    has = lambda e: ~e["ends"] & F.coalesce(raw_attribute(e["tag"], attr) == value, F.lit(False))
    return has if name is None else lambda e: (e["name"] == name) & has(e)


def extent(index: Column, size: Column, e: Column) -> Column:
    """``start`` and ``end``, the places of an element's own tags; ``size``, the number of tags, where none closes it.

    ``e`` must be a plain variable or column, as it is read for every tag.
    """
    own = F.filter(index, lambda t: (t["i"] > e["i"]) & (t["name"] == e["name"]))
    start = F.struct(F.lit(1).alias("depth"), F.lit(-1).alias("end"))

    def step(acc: Column, t: Column) -> Column:
        depth = acc["depth"] + F.when(t["ends"], F.lit(-1)).otherwise(F.lit(1))
        end = F.when(depth == 0, t["i"]).otherwise(F.lit(-1))
        return F.when(acc["end"] >= 0, acc).otherwise(F.struct(depth.alias("depth"), end.alias("end")))

    end = F.aggregate(own, start, step, lambda acc: acc["end"])
    return F.struct(e["i"].alias("start"), F.when(end >= 0, end).otherwise(size).alias("end"))


def _pieces(texts: Column, first: Column, last: Column) -> Column:
    """The texts from behind tag ``first`` to before tag ``last``."""
    return F.slice(texts, first + 2, F.greatest(last - first, F.lit(0)))


def element_source(texts: Column, x: Column) -> Column:
    """Text inside an ``extent`` as written, for ``as_text``; null where that is null."""
    return F.when(x.isNotNull(), F.array_join(_pieces(texts, x["start"], x["end"]), " "))


def paragraphs_source(texts: Column, marks: Column, x: Column) -> Column:
    """Text of the paragraphs inside an ``extent``, joined by blanks; ``marks`` are the page's ``p`` tags."""
    own = F.filter(marks, lambda p: (p["i"] > x["start"]) & (p["i"] < x["end"]))
    ends = F.concat(F.slice(F.transform(own, lambda p: p["i"]), F.lit(2), F.greatest(F.size(own), F.lit(1))), F.array(x["end"]))
    spans = F.zip_with(own, ends, lambda p, end: F.when(~p["ends"], _pieces(texts, p["i"], end)))
    return F.when(x.isNotNull(), F.array_join(F.flatten(F.array_compact(spans)), " "))


def as_text(source: Column) -> Column:
    """Source text without tags as it reads: references decoded, white space collapsed."""
    return fold_space(_decode_references(source))


def meta_tags(index: Column) -> Column:
    """``property, name, content`` of every meta tag as written, in page order."""
    return F.transform(
        F.filter(index, named("meta")),
        lambda m: F.struct(*[raw_attribute(m["tag"], a).alias(a) for a in ("property", "name", "content")]),
    )


def meta_content(metas: Column, key: str, value: str) -> Column:
    """``content`` of the first tag of ``meta_tags`` with ``key="value"``, as written."""
    return F.get(F.filter(metas, lambda m: m[key] == value), F.lit(0))["content"]


def first_filled(*candidates: Column) -> Column:
    """The first candidate that is neither null nor empty; null where none is."""
    return F.get(F.filter(F.array(*candidates), lambda c: F.length(c) > 0), F.lit(0))
