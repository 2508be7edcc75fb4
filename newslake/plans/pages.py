"""HTML pages to links and article records.

``pages`` has ``url``, ``html`` and a ``site`` that selects the rules; a site
without rules gets the common ones.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.functions import html as H
from newslake.functions.text import trim_space
from newslake.functions.urls import base_parts, host_of, is_http_url, resolve, tidy_href
from newslake.plans.silver import failed_rules


@dataclass(frozen=True)
class Selector:
    """An element by class, or by name and attribute; ``inside`` a container of a class."""

    cls: str = ""
    name: str = ""
    attr: str = ""
    value: str = ""
    inside: str = ""
    inside_name: str = ""

    @property
    def test(self) -> H.Test:
        if self.attr:
            return H.with_value(self.attr, self.value, self.name or None)
        return H.with_class(self.cls, self.name or None) if self.cls else H.named(self.name)


@dataclass(frozen=True)
class SiteRule:
    """Which links of a site are articles, and where its pages keep author and body."""

    site: str
    base_url: str
    keep: tuple[str, ...]  # any of these ...
    keep_all: tuple[str, ...] = ()  # ... and every one of these
    drop: tuple[str, ...] = ()
    same_host: bool = True
    author: tuple[Selector, ...] = ()
    body: tuple[Selector, ...] = ()
    category: tuple[Selector, ...] = ()


# -- fixed values: site addresses, link patterns and selectors -------------------
_DAY_PATH = r"/\d{4}/\d{2}/\d{2}/"
_HTML_FILE = r"(?i)\.(?:html|htm)(?:\?|#|$)"
_NUMBERED = r"/\d{4,}(?:\.html)?/?$"
_LISTINGS = r"(?i)/(?:tag|tags|author|authors|category|categorie|video|videos|page)/"
_POST_CATEGORIES = Selector(name="a", inside="post-categories")
_BREADCRUMBS = Selector(name="a", inside="breadcrumbs")
_BYLINE = Selector(cls="byline", inside="entry-meta")

SITE_RULES = (
    SiteRule("hespress", "https://www.hespress.com/", keep=(_NUMBERED,), same_host=False, category=(_POST_CATEGORIES,)),
    SiteRule(
        "akhbarona", "https://www.akhbarona.com/",
        keep=(r"/\d{4}/\d{2}/", _HTML_FILE), drop=(_LISTINGS,), category=(_POST_CATEGORIES,),
        author=(_BYLINE,), body=(Selector(cls="content"),),
    ),
    SiteRule(
        "goud", "https://goud.ma/",
        keep=(_DAY_PATH, _HTML_FILE), drop=(_LISTINGS,), category=(_POST_CATEGORIES,),
        author=(Selector(cls="td-post-author-name"), Selector(cls="entry-author")),
        body=(Selector(cls="td-post-content"),),
    ),
    SiteRule(
        "barlamane", "https://www.barlamane.com/",
        keep=(_DAY_PATH, _HTML_FILE), drop=(_LISTINGS,), category=(_POST_CATEGORIES,),
        author=(_BYLINE,), body=(Selector(cls="content"),),
    ),
    SiteRule(
        "aljazeera", "https://www.aljazeera.net/",
        keep=(
            r"(?i)/(?:news|economy|sports|politics|culture|technology|society)/",
            r"/\d{4}/\d{1,2}/\d{1,2}/",
        ),
        drop=(r"(?i)/(?:programs|live|blogs|tag|tags|author|authors|topic|topics|video|videos|page)/",),
        category=(_BREADCRUMBS,),
        author=(Selector(cls="article-author"), Selector(cls="article__author")),
        body=(Selector(cls="wysiwyg"),),
    ),
    SiteRule(
        "bbc_arabic", "https://www.bbc.com/arabic",
        keep=(r"-\d+$", _DAY_PATH),
        drop=(r"(?i)/(?:live|programmes|topics|tag|tags|author|authors)/",),
        category=(_BREADCRUMBS,),
        author=(Selector(attr="data-testid", value="byline-name"),), body=(Selector(name="main"),),
    ),
    SiteRule(
        "reuters", "https://www.reuters.com/",
        keep=(r"/(?:article|world|business|markets|technology|sports|lifestyle|legal)/[^/]+/?$",),
        keep_all=(
            r"(?i)/(?:article|world|business|markets|technology|sports|lifestyle|legal|graphics)/",
        ),
        drop=(r"(?i)/(?:video|videos|authors|author|topic|topics|tag|tags)/",),
        category=(_BREADCRUMBS,),
        author=(Selector(attr="data-testid", value="Byline"),), body=(Selector(name="main"),),
    ),
)
# Sites without a rule: numbered links on any host, resolved against the page's own address.
DEFAULT_RULE = SiteRule("", "", keep=(_NUMBERED,), same_host=False)
MIN_BODY_CHARS = 50
# -----------------------------------------------------------------------------

# Every link of the same host: for pages of sites without rules of their own.
ANY_LINK = SiteRule("any", "", keep=("",))


# -- links ---------------------------------------------------------------------
def _any_of(patterns: tuple[str, ...]) -> str:
    """One pattern that matches where any of these does, none where there are none; each keeps its own flags."""
    return "|".join(f"(?:{p})" for p in patterns) or "(?!)"


def _link_rule(site: Column, rules: tuple[SiteRule, ...], default: SiteRule | None) -> Column:
    """The row of the rule table for a site, else the default row; null without one."""

    def row(r: SiteRule) -> Column:
        return F.struct(
            F.lit(r.base_url or None).cast("string").alias("base_url"),
            F.lit(_any_of(r.keep)).alias("keep"),
            F.lit("".join(f"(?=.*?(?:{p}))" for p in r.keep_all)).alias("keep_all"),
            F.lit(_any_of(r.drop)).alias("drop"),
            F.lit(r.same_host).alias("same_host"),
        )

    table = F.create_map(*[c for r in rules for c in (F.lit(r.site), row(r))])
    found = F.try_element_at(table, F.coalesce(site, F.lit("")))
    return F.coalesce(found, row(default)) if default else found


def extract_links(
    pages: DataFrame, rules: tuple[SiteRule, ...] = SITE_RULES, n: int | None = None, default: SiteRule | None = DEFAULT_RULE
) -> DataFrame:
    """Article links of listing pages, distinct and in page order; the first ``n`` where given.

    Everything happens inside the page's row, so there is no shuffle; the rules are a small map, looked
    up by site, with a row for sites it does not name. Input columns beyond ``html`` are kept; ``pos`` counts from 0.
    """
    listing = pages.withColumn("rule", _link_rule(F.col("site"), rules, default))
    hrefs = F.transform(H.opening_tags(H.readable(F.col("html")), "a"), lambda tag: H.attribute(tag, "href"))
    hrefs = F.transform(F.filter(hrefs, lambda h: F.length(h) > 0), tidy_href)
    base = F.col("base_url") if "base_url" in pages.columns else F.coalesce("rule.base_url", "url")
    listing = listing.withColumns({"hrefs": hrefs, "base": base_parts(base)})
    listing = listing.withColumn("links", F.transform("hrefs", lambda h: resolve(F.col("base"), h)))

    def kept(link: Column) -> Column:
        rule = F.col("rule")
        own = ~rule["same_host"] | (host_of(link) == F.col("base.host"))
        wanted = F.rlike(link, rule["keep"]) & F.rlike(link, rule["keep_all"]) & ~F.rlike(link, rule["drop"])
        return is_http_url(link) & F.coalesce(own & wanted, F.lit(False))

    listing = listing.withColumn("links", F.array_distinct(F.filter("links", kept)))
    first = F.col("links") if n is None else F.slice("links", 1, n)
    rest = [c for c in pages.columns if c != "html"]
    return listing.select(*rest, F.posexplode(first).alias("pos", "link"))


# -- records -------------------------------------------------------------------
_TITLE = {"h1": Selector(name="h1"), "title": Selector(name="title")}
_CATEGORY = {
    "breadcrumb": Selector(name="a", inside="breadcrumb"),
    "nav_breadcrumb": Selector(name="a", inside="breadcrumb", inside_name="nav"),
    "rel_category": Selector(name="a", attr="rel", value="category tag"),
}
_AUTHOR = {
    "author_tag": Selector(name="author"),
    "author": Selector(cls="author"),
    "post_author": Selector(cls="post-author"),
    "rel_author": Selector(name="a", attr="rel", value="author"),
}
_TIME = {"time": Selector(name="time")}
_BODY = (Selector(name="article"), Selector(cls="post-content"), Selector(cls="entry-content"), Selector(cls="article-content"))


def _site_selectors(rules: tuple[SiteRule, ...], field: str) -> dict[Selector, list[str]]:
    """Distinct selectors of a field with the sites that use them."""
    sites: dict[Selector, list[str]] = {}
    for rule in rules:
        for selector in getattr(rule, field):
            sites.setdefault(selector, []).append(rule.site)
    return sites


def _with_extents(page: DataFrame, into: str, selectors: list[tuple[Selector, list[str] | None]]) -> DataFrame:
    """Add an array: for each selector the extent of its first element in the page, else null.

    Selectors with sites are tried on the pages of these alone. Three projections, so that nothing
    is worked out twice: containers, first elements, extents.
    """
    containers = list(dict.fromkeys((s.inside, s.inside_name) for s, _ in selectors if s.inside))
    page = page.withColumn("_marked", _marked([s for s, _ in selectors]))
    found = [F.filter("_marked", H.with_class(c, n or None)) for c, n in containers]
    page = page.withColumn("_containers", F.array(*found) if found else F.array())
    if containers:
        spans = F.transform("_containers", lambda es: F.transform(es, lambda e: H.extent(F.col("_index"), F.col("_size"), e)))
        page = page.withColumn("_containers", spans)

    def first(s: Selector, sites: list[str] | None) -> Column:
        test = s.test
        if s.inside:
            spans = F.get("_containers", F.lit(containers.index((s.inside, s.inside_name))))
            plain = test
            test = lambda e: plain(e) & F.exists(spans, lambda x: (e["i"] > x["start"]) & (e["i"] < x["end"]))
            element = F.when(F.size(spans) > 0, F.get(F.filter("_index", test), F.lit(0)))
        else:
            element = F.get(F.filter("_marked", test), F.lit(0))
        return F.when(F.col("site").isin(*sites), element) if sites else element

    page = page.withColumn("_firsts", F.array(*[first(*s) for s in selectors]))
    extents = F.transform("_firsts", lambda e: F.when(e.isNotNull(), H.extent(F.col("_index"), F.col("_size"), e)))
    return page.withColumn(into, extents).drop("_containers", "_firsts", "_marked")


def _marked(selectors: list[Selector]) -> Column:
    """The few tags that a selector without a container can mean: of a class, a wanted name or attribute."""
    names = sorted({s.name for s in selectors if s.name and not (s.inside or s.attr)})
    attrs = sorted({s.attr for s in selectors if s.attr})

    def wanted(e: Column) -> Column:
        may = (F.length(e["classes"]) > 2) | e["name"].isin(*names)
        for attr in attrs:
            may = may | F.contains(F.lower(e["tag"]), F.lit(f" {attr}"))
        return ~e["ends"] & may

    return F.filter("_index", wanted)


def _stamped() -> Column:
    """``datetime`` of the first time element that has one, as written."""
    with_stamp = lambda e: H.named("time")(e) & H.raw_attribute(e["tag"], "datetime").isNotNull()
    return H.raw_attribute(F.get(F.filter("_index", with_stamp), F.lit(0))["tag"], "datetime")


_METAS = {
    "og_title": ("property", "og:title"),
    "section": ("property", "article:section"),
    "meta_author": ("name", "author"),
    "article_author": ("property", "article:author"),
    "published": ("property", "article:published_time"),
}


def extract_articles(pages: DataFrame, rules: tuple[SiteRule, ...] = SITE_RULES) -> DataFrame:
    """One article record per page; columns beyond ``html`` are kept.

    ``source`` is the page's ``site``. The body is the paragraphs of the first
    container that holds enough text, else those of the whole page. All texts that may be
    used are cut out as written and made readable together.
    """
    own = {field: _site_selectors(rules, field) for field in ("category", "author", "body")}
    common = {**_TITLE, **_CATEGORY, **_AUTHOR, **_TIME}
    named = {**{n: (s, None) for n, s in common.items()}, **{s: (s, sites) for f in ("category", "author") for s, sites in own[f].items()}}
    bodies = [*((s, None) for s in _BODY), *own["body"].items()]
    names = [*named, *_METAS, "stamp"]

    page = pages.withColumn("_page", H.readable(F.col("html"))).drop("html")
    page = page.withColumns({"_index": H.tag_index(F.col("_page")), "_pieces": H.texts_between(F.col("_page"))}).drop("_page")
    page = page.withColumns({"_size": F.size("_index"), "_metas": H.meta_tags(F.col("_index")), "_marks": F.filter("_index", lambda e: e["name"] == "p")})
    page = _with_extents(page, "_found", [*named.values(), *bodies])
    sources = F.concat(
        F.transform(F.slice("_found", 1, len(named)), lambda x: H.element_source(F.col("_pieces"), x)),
        F.array(*[H.meta_content(F.col("_metas"), *m) for m in _METAS.values()], _stamped()),
        F.transform(F.slice("_found", len(named) + 1, len(bodies)), lambda x: H.paragraphs_source(F.col("_pieces"), F.col("_marks"), x)),
    )
    page = page.withColumn("_texts", F.transform(sources, H.as_text))
    # All paragraphs of the page are read only where no container has enough of them.
    long_enough = lambda t, i: (i >= len(names)) & (F.length(t) >= MIN_BODY_CHARS)
    page = page.withColumn("_body", F.get(F.filter("_texts", long_enough), F.lit(0)))
    whole = F.struct(F.lit(-1).alias("start"), F.col("_size").alias("end"))
    every = H.as_text(H.paragraphs_source(F.col("_pieces"), F.col("_marks"), whole))

    def text(name: str | Selector) -> Column:
        return F.get("_texts", F.lit(names.index(name)))

    categories = list(own["category"])
    categorie = [
        "breadcrumb", "nav_breadcrumb", *[s for s in categories if s == _BREADCRUMBS],
        "rel_category", *[s for s in categories if s != _BREADCRUMBS], "section",
    ]
    auteur = ["author_tag", "meta_author", "article_author", "author", "post_author", "rel_author", *own["author"]]
    record = F.struct(
        F.coalesce(H.first_filled(*map(text, ("h1", "og_title", "title"))), F.lit("")).alias("titre"),
        H.first_filled(*map(text, ("stamp", "published", "time"))).alias("date_publication"),
        H.first_filled(*map(text, categorie)).alias("categorie"),
        H.first_filled(*map(text, auteur)).alias("auteur"),
        F.when(F.col("_body").isNull(), every).otherwise(F.col("_body")).alias("contenu"),
        F.col("site").alias("source"),
    )
    rest = [c for c in pages.columns if c not in ("html", "site")]
    # A one-row generator: filters on the record stay above it instead of being
    # pushed down as second copies of all these patterns.
    return page.select(*rest, F.inline(F.array(record)))


def with_page_errors(extracted: DataFrame) -> DataFrame:
    """``errors``: broken rules of each extracted article; the url needs a scheme and a host."""
    errors = failed_rules(
        trim_space(F.col("titre")), F.col("date_publication"), trim_space(F.col("contenu")),
        is_http_url(F.col("url")),
    )
    return extracted.withColumn("errors", errors)


def page_report(checked: DataFrame) -> DataFrame:
    """Found, valid and invalid pages per source."""
    bad = F.size("errors") > 0
    return checked.groupBy("source").agg(
        F.count(F.lit(1)).alias("found"),
        F.count_if(~bad).alias("valid"),
        F.count_if(bad).alias("invalid"),
    )


def invalid_details(checked: DataFrame) -> DataFrame:
    """The reasons of every invalid page, one row each rather than one list per source."""
    return checked.where(F.size("errors") > 0).select("source", "url", "errors")
