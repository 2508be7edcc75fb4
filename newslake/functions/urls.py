"""Resolving links against a base address, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BASE = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?"
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"
_SPLIT = r"^([A-Za-z][A-Za-z0-9+.-]*:)//([^/?#]*)([^?#]*)(.*)$"


def without_dot_segments(path: Column) -> Column:
    """``/a/./b/../c`` to ``/a/c``."""
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)

    def step(kept: Column, part: Column) -> Column:
        up = F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(1)))
        return F.when(part == "..", up).when(part == ".", kept).otherwise(F.array_append(kept, part))

    empty = F.array().cast("array<string>")
    folded = F.array_join(F.aggregate(parts, empty, step), "/")
    as_folder = last.isin(".", "..") & ~folded.endswith("/")
    clean = F.when(as_folder, F.concat(folded, F.lit("/"))).otherwise(folded)
    return F.when(path.rlike(r"/\.\.?(/|$)"), clean).otherwise(path)


def _tidy(url: Column) -> Column:
    """Resolve dot segments in an absolute address."""

    def part(i: int) -> Column:
        return F.regexp_extract(url, _SPLIT, i)

    tidied = F.concat(part(1), F.lit("//"), part(2), without_dot_segments(part(3)), part(4))
    return F.when(url.rlike(r"^[^?#]*/\.") & url.rlike(_SPLIT), tidied).otherwise(url)


def base_parts(base: Column) -> Column:
    """``url, scheme, host, path, query`` of an absolute address."""
    names = ("scheme", "host", "path", "query")
    parts = [F.regexp_extract(base, _BASE, i).alias(n) for i, n in enumerate(names, 1)]
    return F.struct(base.alias("url"), *parts)


def tidy_href(href: Column) -> Column:
    return F.regexp_replace(F.trim(href), r"[\t\r\n]", "")


def resolve(base: Column, h: Column) -> Column:
    """The absolute address of a tidy reference on the page with ``base_parts`` ``base``."""
    origin = F.concat(base["scheme"], F.lit("://"), base["host"])
    folder = F.regexp_extract(base["path"], r"^(.*?)[^/]*$", 1)
    folder = F.when(folder == "", "/").otherwise(folder)
    relative = (
        F.when(h.startswith("//"), F.concat(base["scheme"], F.lit(":"), h))
        .when(h.startswith("/"), F.concat(origin, h))
        .when(h.startswith("?"), F.concat(origin, base["path"], h))
        .when(h.startswith("#"), F.concat(origin, base["path"], base["query"], h))
        .when(h == "", base["url"])
        .otherwise(F.concat(origin, folder, h))
    )
    return F.when(h.rlike(_SCHEME), h).otherwise(_tidy(relative))


def host_of(url: Column) -> Column:
    """Host with port and user part, as written; empty where there is none."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def is_http_url(url: Column) -> Column:
    """Scheme http or https and a host."""
    return F.coalesce(url.rlike(r"^(?i:https?)://[^/?#]"), F.lit(False))
