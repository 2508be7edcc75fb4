import html
import datetime as dt

from pyspark.sql import functions as F

from newslake.functions import html as H
from newslake.functions import text as X
from newslake.functions.dates import day_from_path, publication_day
from newslake.functions.urls import base_parts, is_http_url, resolve, tidy_href


def values(spark, inputs, column, type_="string"):
    """Evaluate a Column over one column ``c`` and give the results in input order."""
    rows = [(i, v) for i, v in enumerate(inputs)]
    df = spark.createDataFrame(rows, f"i int, c {type_}")
    return [r[0] for r in df.orderBy("i").select(column.alias("v")).collect()]


def test_clean_text(spark):
    inputs = [
        "<p>a</p>\xa0 \t b", "a &amp; b", None, " \x1c x  y　", "a < b", "​z", "a\n\n<br/>\r\nb",
    ]
    want = ["a b", "a &amp; b", "", "x y", "a < b", "​z", "a b"]
    assert values(spark, inputs, X.clean_text(F.col("c"))) == want


def test_or_default(spark):
    assert values(spark, [" \xa0", None, " x "], X.or_default(F.col("c"), "d")) == ["d", "d", "x"]


def test_batch_tokens(spark):
    kept = F.filter(X.batch_tokens(F.col("c")), X.is_batch_candidate)
    inputs = ["L'économie VERTE, 2026!", "٢٠٢٦ الاقتصاد abc", "", "a_b-cdef\xa0ghij", "vérifier"]
    want = [["conomie", "verte"], ["الاقتصاد"], [], ["cdef", "ghij"], ["rifier"]]
    assert values(spark, inputs, kept) == want


def test_speed_tokens(spark):
    kept = F.filter(X.speed_tokens(F.col("c")), X.is_speed_candidate)
    inputs = ["L'Économie a_b 2026 ٢٠٢٦ x² ²²² ①②③ ab", "aujourd'hui, été!"]
    want = [["l'économie", "a_b"], ["aujourd'hui", "été"]]
    assert values(spark, inputs, kept) == want


def test_stopwords_by_language(spark):
    rows = [("with", "fr"), ("with", "en"), ("avec", "fr-CA"), ("avec", "de"), ("with", None), ("هناك", "ar"), ("هناك", "en")]
    df = spark.createDataFrame(rows, "t string, l string")
    got = df.select(X.is_stopword(F.col("t"), X.language_group(F.col("l"))).alias("s"), "t", "l").collect()
    assert {(r.t, r.l): r.s for r in got} == {
        ("with", "fr"): False, ("with", "en"): True, ("avec", "fr-CA"): True, ("avec", "de"): True,
        ("with", None): True, ("هناك", "ar"): True, ("هناك", "en"): False,
    }


def test_publication_day(spark):
    cases = [
        ("2026-05-09T23:30:00-05:00", "2026-05-09"), ("09/05/2026", "2026-09-05"),
        ("13/04/2026", "2026-04-13"), ("May 9, 2026", "2026-05-09"),
        ("Sat, 09 May 2026 18:00:00 GMT", "2026-05-09"), ("20260509", "2026-05-09"),
        ("2026-05-04T14:50:12.610053+00:00", "2026-05-04"), ("  2026/5/9 ", "2026-05-09"),
        ("9th May 2026 at 5:30 pm", "2026-05-09"), ("2026-02-31", None), ("10:00", None),
        ("9 mai 2026", None), (" ", None), (None, None), ("hier", None), ("May 2026", None),
    ]
    want = [dt.date.fromisoformat(day) if day else None for _, day in cases]
    assert values(spark, [written for written, _ in cases], publication_day(F.col("c"))) == want


def test_publication_day_with_its_parts_in_any_order(spark):
    same = [
        "9th of May 2026", "2026 May 9", "May 9 2026 6pm", "6pm May 9 2026", "9-May-2026", "9/may/26", "May 9 26", "26 9 May", "2026, 9 MAY",
        "Saturday, the 9th of May, 2026", "18:00:00 GMT Sat 9 May 2026", "9 May 2026 18:00 +0200 (CEST)", "May 9th 2026 at 5:30 p.m.",
        "Sept 9, 2026".replace("Sept", "May"), "May 9, 2026T10:00Z", "9.May.2026", "2026-May-09 23:59:59", "Sat. 9 May 2026", "on May the 9th 2026",
    ]
    none = [
        "2026-05-09T99:99", "2026-05-09 25:00", "May 9 2026 7:77", "May 2026", "9 May", "May 9 9 2026", "9 May June 2026", "May 9 2026 soon", "may", "31 Feb 2026",
        "20260509T2561", "May 99 2026", "May 9th 8th",
    ]
    got = values(spark, same + none, publication_day(F.col("c")))
    assert {t: str(g) for t, g in zip(same, got) if str(g) != "2026-05-09"} == {}
    assert {t: g for t, g in zip(none, got[len(same):]) if g is not None} == {}


def test_day_from_path(spark):
    inputs = ["bronze/source=a/dt=2026-05-09/x.json", "bronze/source=a/dt=2026/x.json", None]
    assert values(spark, inputs, day_from_path(F.col("c"))) == ["2026-05-09", None, None]


def test_resolve(spark):
    hrefs = ["/c", "?q=1", "a/../b/./c", "//o.h/x", "#t", "mailto:x@y", "http://Z.h/p", " e\n", ".", "../../x"]
    base = base_parts(F.lit("https://h.org/d/e?z=1"))
    want = [
        "https://h.org/c", "https://h.org/d/e?q=1", "https://h.org/d/b/c", "https://o.h/x",
        "https://h.org/d/e?z=1#t", "mailto:x@y", "http://Z.h/p", "https://h.org/d/e", "https://h.org/d/",
        "https://h.org/x",
    ]
    assert values(spark, hrefs, resolve(base, tidy_href(F.col("c")))) == want


def test_is_http_url(spark):
    inputs = ["http://a", "HTTPS://a.b/c", "ftp://a", "http://", "http:///x", "//a", "", None]
    assert values(spark, inputs, is_http_url(F.col("c"))) == [True, True] + [False] * 6


def test_character_references(spark):
    inputs = ["&eacute;&#233;&#xE9;", "&amp;lt; &lt;b&gt; &#60;", "a & b &unknown; &;", "&#x1F600;&nbsp;x", "&AMP;"]
    want = ["ééé", "&lt; <b> <", "a & b &unknown; &;", "\U0001f600 x", "&"]
    assert values(spark, inputs, H.text_of(H.readable(F.col("c")))) == want


def test_references_are_read_as_the_standard_library_reads_them(spark):
    inputs = [
        "A &copy B &amp C", "&notit; &notin; &frac12x", "&#169 &#xe9z &#150; &#0; &#xD800;", "&#x110000;&#99999999999;", "&ampamp; &ltb&gt",
        "&;&#;&#x; & &&copy", "caf&eacute &Eacute &THORN", "x&y=1&copy=2", "&" * 5, "", "&copy",
    ]
    assert values(spark, inputs, H.as_text(F.col("c"))) == [" ".join(html.unescape(x).split()) for x in inputs]


def test_attributes(spark):
    inputs = [
        "<a class='x' href=\"/a?b=1&amp;c=2\">", "<a data-href='no' HREF = /x >", "<a name=href>",
        "<a title=' href=\"no\"' href=yes>", "<a hidden href=''>",
    ]
    assert values(spark, inputs, H.attribute(F.col("c"), "href")) == ["/a?b=1&c=2", "/x", None, "yes", ""]


def test_addresses_keep_what_only_looks_like_a_reference(spark):
    tags = ['<a href="/a?x=1&copy=2&reg;&amp;y">', '<a href="/a?&notit&lt">']
    assert values(spark, tags, H.attribute(F.col("c"), "href")) == ["/a?x=1&copy=2®&y", "/a?&notit<"]


def test_tag_index(spark):
    page = """<P title="5" tall">a<b class='x  y'\tid=q>c</b ><img alt="1 > 0"><i data-x=it's>d</i></p>"""
    names = F.transform(H.tag_index(F.col("c")), lambda e: F.concat_ws(":", e["name"], e["ends"], F.trim(e["classes"])))
    assert values(spark, [page], names) == [["p:false:", "b:false:x  y", "b:true", "img:false:", "i:false:", "i:true", "p:true"]]
    assert values(spark, [page], H.texts_between(F.col("c"))) == [["", "a", "c", "", "", "d", "", ""]]


def test_long_malformed_tags_are_safe(spark):
    pages = ["<div " + "x " * 50_000 + "<h1>T</h1>", "<div " + "a='1' " * 20_000 + ">", "<div " + "= " * 20_000 + "<p>T</p>", "<a " + '"' * 9_999]
    assert all(n >= 0 for n in values(spark, pages, F.size(H.tag_index(H.readable(F.col("c"))))))
