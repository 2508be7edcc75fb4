"""Quality measures, secrets, benchmark passages and page texts against plain readings of their rules."""

import hashlib
import random
import re

from newslake.llm import decontaminate, page_template, quality_rules, secret_owners

BLANK = r"[^\x20\x09-\x0D]+"
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def measures(text):
    text = text or ""
    words = re.findall(BLANK, text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    twice = {w for w in windows if windows.count(w) > 1} if len(windows) < 500 else set()
    covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(BLANK, x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_measures(spark, documents, work):
    texts = ["a b c d e f g h i " * 2, "x\ny\nx\n\n \nx", "# * $ é|<>", "w " * 40, " ".join(map(str, range(60))) + " " + " ".join(map(str, range(10)))]
    extra = spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = documents.unionByName(extra, allowMissingColumns=True)
    source = sorted([(r.doc_id, *measures(r.text)) for r in rows.collect()], key=str)
    got = quality_rules.judge(rows, work).collect()
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted([tuple(r[c] for c in columns) for r in got], key=str) == source
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept) and 0 <= r.posterior <= 1


def test_quality_rules_of_an_empty_table(documents, work):
    assert quality_rules.judge(documents.limit(0), work).count() == 0


def base_spans(text):
    text, found = text or "", []
    for kind, pattern, least, group in (("assign", ASSIGN, 8, 1), ("access", "AKIA[A-Z0-9]+", 16, 0), ("hex", "[0-9a-f]+", 32, 0)):
        found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m[group]) >= least]
    order = ["assign", "access", "hex"]
    return ",".join(f"{k}:{a}:{b}" for a, k, b in sorted(found, key=lambda x: (x[0], order.index(x[1]))))


def test_secrets(spark, documents, work):
    digest = hashlib.sha256(b"x").hexdigest()
    texts = [f"é password = 'hunter2hunter2' {digest}", "API_KEY: short", "token=secret=abcdefgh12", f"AKIA{'A1' * 8} AKIA12", f"Passwd:  \"{digest}\"",
             f"{digest}{digest}", "apikey=\npassword=longenough1", "secret  =x token:yyyyyyyyyy" * 3]
    extra = spark.createDataFrame([(100 + i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    rows = documents.unionByName(extra, allowMissingColumns=True)
    got = secret_owners.find_secrets(rows, work).collect()
    assert sorted([(r.doc_id, r.base) for r in got], key=str) == sorted([(r.doc_id, base_spans(r.text)) for r in rows.collect()], key=str)
    for r in got:
        kinds = [s.split(":")[0] for s in r.base.split(",") if s]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(kinds.count(k) for k in ("assign", "access", "hex"))
        assert set(filter(None, r.base.split(","))) <= set(r.spans.split(","))


def test_widely_held_keys_are_not_live(spark, work):
    common, own = "Zx9Qm2Lw8Rt5Vb1Nc7Kd", "Qp4Wn8Xe2Ty6Ru1Io9Mz"
    rows = [(i, f"value {common} here", f"s{i}") for i in range(8)] + [(50, f"only {own} here", "s1")]
    got = secret_owners.find_secrets(spark.createDataFrame(rows, "doc_id long, text string, source string"), work).collect()
    assert {r.doc_id for r in got if r.spans} == {50}


def test_keys_of_one_owner_are_live_wherever_they_stand(spark, work):
    own = "Qp4Wn8Xe2Ty6Ru1Io9Mz"
    rows = [(i, f"copy {i} of {own} here", "s1") for i in range(9)]
    got = secret_owners.find_secrets(spark.createDataFrame(rows, "doc_id long, text string, source string"), work).collect()
    assert len(got) == 9 and all(r.spans.startswith("key:") and r.found[0].repositories == 9 for r in got)


def test_long_dump_of_secrets(spark, work):
    """Spans of a text with thousands of candidates, in time that grows with its length."""
    parts = [f"é {hashlib.sha256(str(i).encode()).hexdigest()} Qp4Wn8Xe2Ty6Ru1Io{i:05d}z" for i in range(20_000)]
    text = " ".join(parts)
    got = secret_owners.find_secrets(spark.createDataFrame([(1, text, "s")], "doc_id long, text string, source string"), work).first()
    assert got.n_hex == 20_000 and len(got.spans.split(",")) == 40_000
    assert got.base == base_spans(text)


def test_no_documents_no_secrets(documents, work):
    assert secret_owners.find_secrets(documents.limit(0), work).count() == 0


def test_planted_passages(spark, documents):
    rng = random.Random(3)
    item = [f"i{rng.randrange(10**6)}" for _ in range(40)]
    near = list(item)
    near[20] = "changed"
    far = [w if i % 3 else f"z{i}" for i, w in enumerate(item)]
    fill = lambda n: [f"f{rng.randrange(10**6)}" for _ in range(n)]
    rows = [(101, fill(300) + item + fill(500)), (102, item), (103, fill(900)), (104, fill(77) + near + fill(3)), (105, fill(10) + far + fill(10)), (106, item[:12])]
    docs = documents.unionByName(spark.createDataFrame([(i, " ".join(w).upper()) for i, w in rows], "doc_id long, text string"), allowMissingColumns=True)
    bench = spark.createDataFrame([(1, " ".join(item)), (2, ""), (3, None), (None, "q w e r t y"), (4, " ".join(item))], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.find_passages(docs, bench).collect()}
    assert set(got) == {(d, i) for d in (101, 102, 104) for i in (1, 4)}
    assert got[101, 1].similarity == 1 and got[101, 1].first_word == 300
    assert decontaminate.find_passages(docs, bench.limit(0)).count() == 0
    assert decontaminate.find_passages(docs.limit(0), bench).count() == 0


def test_page_texts(spark, work):
    page = (
        "<html><head><title>T</title><style>p{{}}</style></head><body><nav><ul><li><a href='/'>Home</a></li></ul></nav>"
        "<article><h1>Title {0}</h1><p>First &amp; best\n  text {0}.</p><script>var a = '<p>';</script><p>Caf&eacute; {0} &#x41;</p></article>"
        "<div class='comments'><p>comment {0}</p></div><footer><p>All rights reserved</p></footer></body></html>"
    )
    rows = [(i, f"http://h.example/{i}", page.format(i)) for i in range(6)] + [(7, None, None), (8, "http://x.example/", ""), (None, "bad url", "plain text")]
    pages = spark.createDataFrame([(*r, "extra", 5) for r in rows], "page_id long, url string, html string, host string, token int")
    got = {r.page_id: r for r in page_template.main_texts(pages, work).collect()}
    assert len(got) == len(rows)
    for i in range(6):
        assert got[i].text == f"Title {i}\nFirst & best text {i}.\nCafé {i} A"
    assert got[7].text == got[8].text == "" and all(r.n_chars == len(r.text) for r in got.values())
    assert page_template.main_texts(pages.limit(0), work + "-none").count() == 0


def test_template_texts_inside_the_article(spark, work):
    page = (
        "<html><body><article><h1>Title {0}</h1><p>Body {0}.</p><div><p>Read our terms.</p></div>{1}<p>End {0}.</p></article></body></html>"
    )
    rows = [(i, f"http://h.example/{i}", page.format(i, "<p>More</p>" if i < 3 else "")) for i in range(6)]
    rows += [(10 + i, "http://copies.example/", page.format("x", "")) for i in range(6)]
    got = {r.page_id: r.text for r in page_template.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string"), work).collect()}
    for i in range(6):
        assert got[i] == f"Title {i}\nBody {i}.\n" + ("More\n" if i < 3 else "") + f"End {i}."
        # Copies of one page say nothing about a template.
        assert got[10 + i] == "Title x\nBody x.\nRead our terms.\nEnd x."


def test_unclosed_elements_are_no_template():
    read = page_template.Page("<div class=a><p>one</div><div class=b>two")
    kinds = [k for k, *_ in read.about.values()]
    assert kinds.count(page_template.START) == 4 and kinds.count(page_template.END) == 2


def test_names_do_not_lose_the_article(spark, work):
    body = "<h1>Title {0}</h1><p>Body {0}</p>"
    frames = [
        "<article class='post type-post category-social'>{}</article>", "<div class='content-sidebar-wrap'><article>{}</article></div>",
        "<div class='has-sidebar'><main>{}</main></div>", "<div id='page-with-menu'><div>{}</div></div>", "<div class='sidebar-layout'><article>{}</article></div>",
        "<main><article class='social-news'>{}</article></main>", "<form><main>{}</main></form>",
        "<article>{}<div class='comments'><article class='comment'><p>said {{0}}</p></article></div><div class='ad'>buy {{0}}</div></article>",
        "<article>{}</article><aside><article>other {{0}}</article></aside><div class='post-comments'><article>said {{0}}</article></div>",
    ]
    rows = [(i, f"http://h{i}.example/", "<html><body>" + f.format(body).format(i) + "</body></html>") for i, f in enumerate(frames)]
    got = {r.page_id: r.text for r in page_template.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string"), work).collect()}
    assert got == {i: f"Title {i}\nBody {i}" for i in range(len(frames))}


def test_documents_shorter_than_the_item(spark):
    item = [f"i{i * 7919}" for i in range(38)]
    rows = [(1, item[:37]), (2, item[2:]), (3, item[:30]), (4, item[:29]), (5, item[:28]), (6, item[:4]), (7, [])]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(item[:5]))], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.find_passages(docs, bench).collect()}
    # 30 words have 26 of 34 shingles, 29 words have 25: below 0.75.
    assert {d for d, i in got if i == 1} == {1, 2, 3} and {d for d, i in got if i == 2} == {1, 3, 4, 5}
    assert got[1, 1].similarity == 33 / 34 and (got[1, 1].first_word, got[1, 1].n_words) == (0, 37)
