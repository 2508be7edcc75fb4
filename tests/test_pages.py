from pyspark.sql import functions as F

from newslake.plans import pages as P

BODY = "Assez de texte pour un article, bien plus de cinquante signes en tout."


def many(spark, pages):
    """Records of (html, site) pairs, in order."""
    rows = [(i, "https://a.b/c", html, site) for i, (html, site) in enumerate(pages)]
    df = spark.createDataFrame(rows, "i int, url string, html string, site string").coalesce(1)
    return P.extract_articles(df).orderBy("i").collect()


def one(spark, html, site="hespress", url="https://www.hespress.com/a-123456.html"):
    df = spark.createDataFrame([(url, html, site)], "url string, html string, site string")
    return P.with_page_errors(P.extract_articles(df)).first()


def test_title_chain(spark):
    meta = "<meta content='Og' property='og:title'>"
    pages = [
        f"{meta}<title>Doc</title><h1> A <b>B</b>&amp;C </h1>", f"{meta}<title>Doc</title><h1> </h1>",
        "<title>Doc &eacute;</title>", "<p>x</p>",
    ]
    assert [r.titre for r in many(spark, [(p, "goud") for p in pages])] == ["A B &C", "Og", "Doc é", ""]


def test_hidden_markup_is_ignored(spark):
    html = '<!-- <h1>no</h1> --><script>var a = "<h1>no</h1>";</script><style>h1{}</style><h1>yes</h1>'
    assert one(spark, html).titre == "yes"


def test_category_chain(spark):
    cases = [
        ("hespress", '<ul class="x breadcrumb"><li><a href="/"> Home <i>x</i></a></li></ul>', "Home x"),
        ("hespress", '<a rel="category tag" href="/t">Tag</a>', "Tag"),
        ("hespress", '<div class="post-categories"><a>Post</a></div>', "Post"),
        ("aljazeera", '<div class="post-categories"><a>Post</a></div>', None),
        ("aljazeera", '<div class="breadcrumbs"><a>Crumb</a></div>', "Crumb"),
        ("goud", '<div class="breadcrumbs"><a>Crumb</a></div>', None),
        ("goud", '<meta property="article:section" content=" Sec  tion ">', "Sec tion"),
        ("goud", '<div class="Breadcrumb"><a>case matters</a></div>', None),
        # Any container counts: the first link inside one, wherever it is.
        ("goud", '<ul class="breadcrumb"><li>none</li></ul><ul class="breadcrumb"><li><a>Second</a></li></ul>', "Second"),
        ("goud", '<p class="breadcrumb"><a> </a></p><nav class="breadcrumb"><a>Nav</a></nav>', "Nav"),
        ("goud", '<p class="breadcrumb"><a> </a></p><p class="breadcrumb"><a>Later</a></p>', None),
        ("hespress", '<div class="post-categories">x</div><div class="post-categories"><a>Post</a></div>', "Post"),
    ]
    assert [r.categorie for r in many(spark, [(html, site) for site, html, _ in cases])] == [c[-1] for c in cases]


def test_author_chain(spark):
    cases = [
        ("hespress", "<author>A</author><meta name='author' content='B'>", "A"),
        ("hespress", "<author> </author><meta name='author' content='B'>", "B"),
        ("hespress", "<meta property='article:author' content='C'>", "C"),
        ("hespress", "<div class='author'>by <div>D</div> x</div>", "by D x"),
        ("hespress", "<span class=post-author>E</span>", "E"),
        ("hespress", "<a rel='author'>F</a>", "F"),
        ("hespress", "<div class='entry-meta'><i class='byline'>G</i></div>", None),
        ("akhbarona", "<div class='entry-meta'><i class='byline'>G</i></div>", "G"),
        ("barlamane", "<i class='byline'>G</i>", None),
        ("goud", "<i class='td-post-author-name'>H</i>", "H"),
        ("goud", "<i class='entry-author'>I</i>", "I"),
        ("aljazeera", "<i class='article__author'>J</i>", "J"),
        ("bbc_arabic", "<i data-testid='byline-name'>K</i>", "K"),
        ("reuters", "<i data-testid='Byline'>L</i>", "L"),
        ("reuters", "<i data-testid='byline'>L</i>", None),
    ]
    assert [r.auteur for r in many(spark, [(html, site) for site, html, _ in cases])] == [c[-1] for c in cases]


def test_date_chain(spark):
    cases = [
        ("<time>x</time><time class=a datetime='2026-05-09 '>y</time>", "2026-05-09"),
        ("<meta property='article:published_time' content='2026-05-08'><time>x</time>", "2026-05-08"),
        ("<time> 9 <b>May</b> </time>", "9 May"),
        ("<time> </time>", None),
    ]
    assert [r.date_publication for r in many(spark, [(html, "hespress") for html, _ in cases])] == [c[-1] for c in cases]


def test_body_takes_the_first_container_with_enough_text(spark):
    html = f"<article><p>court</p></article><div class='post-content'><div><p>{BODY}</p></div><p>fin</p></div><p>hors</p>"
    assert one(spark, html).contenu == f"{BODY} fin"


def test_body_falls_back_to_all_paragraphs(spark):
    assert one(spark, "<article><p>a</p></article><p>b</p><pre>no</pre>").contenu == "a b"


def test_body_of_site_container(spark):
    html = f"<main><p>{BODY}</p></main><p>hors</p>"
    assert one(spark, html, "reuters").contenu == BODY
    assert one(spark, html, "goud").contenu == f"{BODY} hors"


def test_unclosed_paragraphs_are_not_repeated(spark):
    html = f"<article><p><b>{BODY}<br><p>deux</p><p>trois</article>"
    assert one(spark, html).contenu == f"{BODY} deux trois"


def test_page_errors_and_report(spark):
    rows = [
        ("https://a.b/1", f"<h1>T</h1><time datetime='2026-05-09'></time><p>{BODY} {BODY}</p>", "goud"),
        ("ftp://a.b/2", "<p>x</p>", "goud"),
    ]
    df = spark.createDataFrame(rows, "url string, html string, site string")
    checked = P.with_page_errors(P.extract_articles(df)).cache()
    assert [tuple(r) for r in P.page_report(checked).collect()] == [("goud", 2, 1, 1)]
    detail = P.invalid_details(checked).first()
    assert detail.errors == ["titre vide", "date manquante", "contenu trop court", "url invalide"]


def test_links_are_distinct_in_order_and_limited(spark):
    html = "".join(f"<a href='/2024/01/0{d}/x-{d}'>l</a>" for d in (3, 1, 3, 2))
    df = spark.createDataFrame([("u", html, "goud")], "url string, html string, site string")
    got = [(r.pos, r.link) for r in P.extract_links(df, n=2).orderBy("pos").collect()]
    assert got == [(0, "https://goud.ma/2024/01/03/x-3"), (1, "https://goud.ma/2024/01/01/x-1")]


def test_sites_without_a_rule_get_the_default_row(spark):
    html = "<a href='/x/12345.html'>1</a><a href='https://o.h/6789/'>2</a><a href='/about'>3</a>"
    rows = [("https://a.b/list", html, "lematin"), ("https://c.d/", html, None)]
    df = spark.createDataFrame(rows, "url string, html string, site string")
    got = sorted((r.site or "", r.pos, r.link) for r in P.extract_links(df).collect())
    assert got == [
        ("", 0, "https://c.d/x/12345.html"), ("", 1, "https://o.h/6789/"),
        ("lematin", 0, "https://a.b/x/12345.html"), ("lematin", 1, "https://o.h/6789/"),
    ]
    assert P.extract_links(df, (P.ANY_LINK,), default=None).count() == 0


def test_listing_without_links_gives_no_rows(spark):
    df = spark.createDataFrame([("u", "<a name=x>l</a>", "goud")], "url string, html string, site string")
    assert P.extract_links(df).count() == 0


def test_other_columns_are_kept(spark):
    df = spark.createDataFrame([(7, "u", "<h1>T</h1>", "x")], "page_id int, url string, html string, site string")
    assert P.extract_articles(df).select(F.col("page_id"), "titre").first() == (7, "T")
