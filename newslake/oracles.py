"""The SQL that DuckDB runs to check the registered queries.

Written apart from the jobs; only the input views and the fixed word lists are
shared. The two parts joined by ``_then`` form one WITH clause.
"""

from __future__ import annotations

from newslake.functions.text import STOPWORDS
from newslake.views import ARTICLES, DATED, LISTINGS, PAGES_META, RAW


def _input(view: str, name: str) -> str:
    """The view as a named CTE."""
    sql = view.replace("{documents}", "documents").replace("{pages}", "pages")
    return f"WITH {name} AS ({sql})"


_A = _input(ARTICLES, "articles")
_R = _input(RAW, "raw")


def _words(words) -> str:
    return "(" + ", ".join("'" + w + "'" for w in words) + ")"


_FR, _EN, _AR = (_words(STOPWORDS[g]) for g in ("fr", "en", "ar"))


def _keep(tok: str, lang: str) -> str:
    return f"""(length({tok}) >= 4 AND NOT regexp_full_match({tok}, '[0-9]+')
      AND NOT CASE WHEN {lang} LIKE 'fr%' THEN {tok} IN {_FR}
                   WHEN {lang} LIKE 'en%' THEN {tok} IN {_EN}
                   WHEN {lang} LIKE 'ar%' THEN {tok} IN {_AR}
                   ELSE {tok} IN {_FR} OR {tok} IN {_EN} OR {tok} IN {_AR} END)"""


def _split(text: str) -> str:
    return rf"string_split_regex(lower({text}), '[^0-9a-zıſ\x{{0600}}-\x{{06FF}}]+')"


_TOKENS = _A + f""", t AS (
  SELECT bronze_key, pos, coalesce(langue, '') AS lang, {_split("titre || ' ' || contenu")} AS toks FROM articles),
w AS (SELECT bronze_key, pos, lang, unnest(toks) AS tok, unnest(range(len(toks))) AS tok_pos FROM t),
kept AS (SELECT * FROM w WHERE {_keep("tok", "lang")})
"""
_KEYWORDS = "SELECT tok AS mot_cle, count(*) AS count FROM kept GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {n}"

_PAIRS = _A + f""", t AS (
  SELECT bronze_key, pos, list_filter({_split("titre")}, lambda x: {_keep("x", "coalesce(langue, '')")}) AS ws
  FROM articles),
p AS (SELECT bronze_key, pos, unnest(range(1, len(ws))) AS i, ws FROM t WHERE len(ws) >= 2),
pairs AS (SELECT bronze_key, pos, i, ws[i] || ' ' || ws[i + 1] AS sujet FROM p)
"""
_TOPICS = "SELECT sujet, count(*) AS count FROM pairs GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {n}"


def _first_seen(table: str, term: str, name: str, place: str) -> str:
    return f"""
, placed AS (SELECT {term} AS term, row_number() OVER (ORDER BY bronze_key, pos, {place}) AS rn FROM {table})
SELECT term AS {name}, count(*) AS count FROM placed GROUP BY 1 ORDER BY 2 DESC, min(rn) LIMIT 50"""


_COUNTRY = """CASE WHEN source IN ('hespress', 'akhbarona', 'barlamane', 'goud') THEN 'Maroc'
  WHEN source = 'aljazeera' THEN 'Qatar' WHEN source = 'bbc_arabic' THEN 'UK'
  WHEN source = 'reuters' THEN 'USA' ELSE 'unknown' END"""
_THEME = "coalesce(nullif(trim(categorie), ''), 'unknown')"
_DAY = "coalesce(try_cast(date_publication[1:10] AS DATE), CAST(dt AS DATE))"


def _per(key: str, name: str, out: str = "nb_articles", table: str = "articles") -> str:
    return f"SELECT {key} AS {name}, count(*) AS {out} FROM {table} GROUP BY 1"


# -- Silver --------------------------------------------------------------------
def _clean(c: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(coalesce({c}, ''), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'))"


def _judge(source: str) -> str:
    """CTEs from raw rows (bronze_key, pos, dt, article) to verdicts."""
    return rf""", n AS (
  SELECT bronze_key, pos, dt, trim(coalesce(url, '')) AS url, {_clean("titre")} AS titre,
         date_publication, CASE WHEN categorie IS NOT NULL THEN {_clean("categorie")} END AS categorie,
         nullif({_clean("auteur")}, '') AS auteur, {_clean("contenu")} AS contenu,
         coalesce(nullif({_clean("source")}, ''), '{{default}}') AS source,
         row_number() OVER (ORDER BY bronze_key, pos) AS ord
  FROM {source}),
v AS (
  SELECT *, list_filter([
      CASE WHEN titre = '' THEN 'titre vide' END,
      CASE WHEN trim(coalesce(date_publication, '')) = '' THEN 'date manquante' END,
      CASE WHEN length(contenu) <= 100 THEN 'contenu trop court' END,
      CASE WHEN NOT regexp_matches(url, '(?i)^https?://[^\s/$.?#].[^\s]*$') THEN 'url invalide' END
    ], lambda e: e IS NOT NULL) AS own
  FROM n),
f AS (SELECT *, min(CASE WHEN len(own) = 0 THEN ord END) OVER (PARTITION BY url) AS first_ok FROM v),
judged AS (
  SELECT *, CASE WHEN url = '' THEN ['url manquante']
                 WHEN ord > first_ok THEN ['doublon url'] ELSE own END AS errors
  FROM f)
"""


_JUDGED = _R + _judge("raw").replace("{default}", "inconnu")

# -- pages ---------------------------------------------------------------------
_NO_NOISE = r"regexp_replace(html, '(?s)<!--.*?-->|<script.*?</script>|<style.*?</style>', ' ', 'g')"


def _text(c: str) -> str:
    untagged = f"regexp_replace({c}, '<[^>]*>', ' ', 'g')"
    for ref, char in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        untagged = f"replace({untagged}, '{ref}', '{char}')"
    return rf"trim(regexp_replace({untagged}, '\s+', ' ', 'g'))"


_TITLE = _text(r"regexp_extract(clean, '(?s)<h1>(.*?)</h1>', 1)")
_IN_ARTICLE = _text(r"array_to_string(regexp_extract_all(regexp_extract(clean, '(?s)<article>(.*?)(?:</article>|\z)', 1), '(?s)<p>(.*?)(?:</p>|\z)', 1), ' ')")
_IN_PAGE = _text(r"array_to_string(regexp_extract_all(clean, '(?s)<p>(.*?)(?:</p>|\z)', 1), ' ')")
_BODY = f"CASE WHEN length({_IN_ARTICLE}) >= 50 THEN {_IN_ARTICLE} ELSE {_IN_PAGE} END"
_CLEAN_PAGES = f"WITH c AS (SELECT page_id, url, {_NO_NOISE} AS clean FROM pages)"
_META = (
    _input(PAGES_META, "m")
    + f""", c AS (SELECT page_id, url, {_NO_NOISE} AS clean FROM m),
x AS (
  SELECT page_id, url, {_TITLE} AS titre, {_BODY} AS contenu,
    CASE page_id % 4 WHEN 0 THEN 'Cat ' || page_id WHEN 1 THEN 'Tagged' WHEN 2 THEN 'Sec & ' || page_id END AS categorie,
    CASE page_id % 5 WHEN 0 THEN 'By A' WHEN 1 THEN 'Meta ' || page_id WHEN 2 THEN 'Class A' WHEN 3 THEN 'Rel A' END AS auteur,
    CASE page_id % 3 WHEN 0 THEN '2024-01-0' || (page_id % 9 + 1) WHEN 1 THEN '2024-02-03T04:05:06Z'
      ELSE CASE page_id % 2 WHEN 0 THEN '3 May 2024' END END AS date_publication
  FROM c),
e AS (
  SELECT *, list_filter([
      CASE WHEN titre = '' THEN 'titre vide' END,
      CASE WHEN date_publication IS NULL THEN 'date manquante' END,
      CASE WHEN length(contenu) <= 100 THEN 'contenu trop court' END,
      CASE WHEN NOT regexp_matches(url, '^https?://[^/?#]') THEN 'url invalide' END
    ], lambda z: z IS NOT NULL) AS errors
  FROM x)
"""
)

_SITE_LINKS = (
    _input(LISTINGS, "l")
    + r""", b AS (
  SELECT *, CASE site WHEN 'hespress' THEN 'https://www.hespress.com' WHEN 'akhbarona' THEN 'https://www.akhbarona.com'
      WHEN 'goud' THEN 'https://goud.ma' WHEN 'barlamane' THEN 'https://www.barlamane.com'
      WHEN 'aljazeera' THEN 'https://www.aljazeera.net' WHEN 'bbc_arabic' THEN 'https://www.bbc.com'
      WHEN 'reuters' THEN 'https://www.reuters.com' ELSE regexp_extract(url, '^https?://[^/?#]+') END AS o FROM l),
k AS (
  SELECT page_id, site, o, unnest([1, 2, 3, 4, 5, 6, 7, 8, 9]) AS ord, unnest([
      o || '/2024/01/05/item-' || page_id, o || '/news/' || (100000 + page_id) || '.html',
      o || '/world/story-' || page_id || '/', o || '/tag/2024/01/05/x.html',
      'https://other.example/2024/01/05/' || (10000 + page_id), o || '/2024/01/05/item-' || page_id,
      CASE WHEN coalesce(site, 'lematin') = 'lematin' THEN regexp_extract(url, '^(.*/)[^/]*$', 1) || 'sports/x-' ELSE o || '/sports/x-' END || page_id, o || CASE site WHEN 'bbc_arabic' THEN '/arabic#top' ELSE '/#top' END,
      o || '/WORLD/story.htm?x=1&y=2']) AS link FROM b),
s AS (
  SELECT *, starts_with(link, o || '/') AS own,
    regexp_matches(link, '(?i)/(tag|tags|author|authors|category|categorie|video|videos|page)/') AS listing,
    regexp_matches(link, '(?i)\.(html|htm)(\?|#|$)') AS file,
    regexp_matches(link, '/\d{4}/\d{2}/\d{2}/') AS day
  FROM k),
g AS (
  SELECT page_id, site, link, min(ord) AS ord FROM s
  WHERE CASE site
    WHEN 'hespress' THEN regexp_matches(link, '/\d{4,}(\.html)?/?$')
    WHEN 'reuters' THEN own
      AND regexp_matches(link, '(?i)/(article|world|business|markets|technology|sports|lifestyle|legal|graphics)/')
      AND NOT regexp_matches(link, '(?i)/(video|videos|authors|author|topic|topics|tag|tags)/')
      AND regexp_matches(link, '/(article|world|business|markets|technology|sports|lifestyle|legal)/[^/]+/?$')
    WHEN 'akhbarona' THEN own AND NOT listing AND (regexp_matches(link, '/\d{4}/\d{2}/') OR file)
    WHEN 'goud' THEN own AND NOT listing AND (day OR file)
    WHEN 'barlamane' THEN own AND NOT listing AND (day OR file)
    WHEN 'aljazeera' THEN own
      AND NOT regexp_matches(link, '(?i)/(programs|live|blogs|tag|tags|author|authors|topic|topics|video|videos|page)/')
      AND (regexp_matches(link, '(?i)/(news|economy|sports|politics|culture|technology|society)/')
           OR regexp_matches(link, '/\d{4}/\d{1,2}/\d{1,2}/'))
    WHEN 'bbc_arabic' THEN own
      AND NOT regexp_matches(link, '(?i)/(live|programmes|topics|tag|tags|author|authors)/')
      AND (regexp_matches(link, '-\d+$') OR day)
    ELSE regexp_matches(link, '/\d{4,}(\.html)?/?$') END
  GROUP BY 1, 2, 3)
SELECT page_id, site, CAST(row_number() OVER (PARTITION BY page_id ORDER BY ord) - 1 AS INTEGER) AS pos, link FROM g
"""
)

# -- language ------------------------------------------------------------------
def _trigrams(name: str, table: str, keep: str, text: str) -> str:
    """CTE ``name``: the columns ``keep`` and a bucket for each trigram of the cleaned text."""
    mixed = "xor(xor((c[i] * 2654435761) & 4294967295, (c[i + 1] * 2246822507) & 4294967295), (c[i + 2] * 3266489909) & 4294967295)"
    return rf"""{name}_s AS (
  SELECT {keep}, list_transform(string_split(' ' || regexp_replace(regexp_replace(lower({text}), '[^\p{{L}}]+', ' ', 'g'), '^ ', '') || ' ', ''), lambda x: ord(x)) AS c
  FROM {table}),
{name} AS (
  SELECT {keep}, unnest(list_transform(range(1, len(c) - 1), lambda i: ((({mixed}) * 668265263) & 4294967295) >> 17)) AS bucket
  FROM {name}_s WHERE len(c) > 2)
"""


def _profiles(where: str) -> str:
    """CTEs down to ``profiles`` (lang, bucket, n) of the documents that ``where`` names, and ``weights``."""
    learnt = f"(SELECT lang, {_clean('text')} AS text FROM documents WHERE lang IS NOT NULL AND {where})"
    return f"""{_trigrams("learnt", learnt, "lang", "text")},
profiles AS (SELECT lang, CAST(bucket AS BIGINT) AS bucket, count(*) AS n FROM learnt GROUP BY 1, 2),
totals AS (SELECT lang, sum(n) + 32768 AS total FROM profiles GROUP BY 1),
weights AS (SELECT p.lang, p.bucket, CAST(round(1000 * ln((n + 1) / total)) AS BIGINT) AS w FROM profiles p JOIN totals USING (lang)),
bare AS (SELECT lang, CAST(round(1000 * ln(1 / total)) AS BIGINT) AS w FROM totals)
"""


def _tagged(table: str, key: str, text: str) -> str:
    """CTE ``tags`` (key, langue) for rows of ``table`` with a sample of 20 characters that holds letters."""
    return f"""{_trigrams("seen", f"(SELECT * FROM {table} WHERE length({text}) >= 20)", key, text)},
counted AS (SELECT {key}, CAST(bucket AS BIGINT) AS bucket, count(*) AS n FROM seen GROUP BY {key}, 2),
lengths AS (SELECT {key}, sum(n) AS total FROM counted GROUP BY {key}),
gains AS (SELECT {key}, lang, sum(n * (weights.w - bare.w)) AS gain
          FROM counted JOIN weights USING (bucket) JOIN bare USING (lang) GROUP BY {key}, lang),
scores AS (SELECT {key}, lang, total * w + coalesce(gain, 0) AS score FROM lengths CROSS JOIN bare LEFT JOIN gains USING ({key}, lang)),
tags AS (SELECT {key}, arg_min(lang, (-score, lang)) AS langue FROM scores GROUP BY {key})
"""


# -- stream --------------------------------------------------------------------
_WORDS = r"""regexp_extract_all(lower(titre || ' ' || contenu), '([\p{L}\p{N}_\x{0600}-\x{06FF}'']+)', 1)"""
_WORD_OK = r"length(mot) >= 3 AND NOT regexp_full_match(mot, '[\p{Nd}²³¹]+')"
_TIMED = _A + ", timed AS (SELECT *, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id * 20) AS ts FROM articles)"
# Minutes by which a window starts before the minute of an event.
_STARTS = "date_trunc('minute', ts) - to_minutes(unnest(range(5)))"

_GOOD_EVENTS = _TIMED + """, good AS (
  SELECT *, coalesce(nullif(trim(source), ''), 'unknown') AS src FROM timed WHERE doc_id % 100 NOT IN (11, 61))
"""


def _top_words(table: str, titre: str, contenu: str, closed: str) -> str:
    words = _WORDS.replace("titre", titre).replace("contenu", contenu)
    return f""", w AS (SELECT ts, unnest({words}) AS mot FROM {table}),
k AS (SELECT date_trunc('minute', ts) AS m, mot, count(*) AS n FROM w WHERE {_WORD_OK} GROUP BY 1, 2),
s AS (SELECT m - to_minutes(unnest(range(5))) AS window_start, mot, n FROM k),
c AS (SELECT window_start, mot AS key, CAST(sum(n) AS BIGINT) AS n FROM s GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY n DESC, key) AS rank FROM c)
SELECT window_start, key, n, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10 {closed}"""


# -- a whole run -----------------------------------------------------------------
_RUN = (
    _R
    + """, stored AS (
  SELECT *, row_number() OVER (PARTITION BY coalesce(nullif(trim(source), ''), 'autres'), dt, trim(url)
                               ORDER BY doc_id DESC) AS rn
  FROM raw WHERE trim(url) <> ''),
b AS (
  SELECT 'bronze/source=' || coalesce(nullif(trim(source), ''), 'autres') || '/dt=' || dt || '/articles/'
           || sha1(trim(url)) || '.json' AS bronze_key,
         0 AS pos, dt, titre, url, date_publication, categorie, auteur, contenu, source
  FROM stored WHERE rn = 1)
"""
    + _judge("b").replace("{default}", "hespress")
    + f""", ok AS (SELECT *, titre || '. ' || contenu AS sample FROM judged WHERE len(errors) = 0),
{_profiles("doc_id % 2 = 0")},
{_tagged("ok", "url", "sample")},
t AS (SELECT unnest({_split("titre || ' ' || contenu")}) AS tok FROM ok),
kw AS (SELECT DISTINCT tok FROM t WHERE {_keep("tok", "''")}),
tt AS (SELECT list_filter({_split("titre")}, lambda x: {_keep("x", "''")}) AS ws FROM ok),
p AS (SELECT ws, unnest(range(1, len(ws))) AS i FROM tt WHERE len(ws) >= 2),
pr AS (SELECT DISTINCT ws[i] || ' ' || ws[i + 1] AS sujet FROM p)
SELECT 'written' AS table_name, count(*) AS n FROM ok
UNION ALL SELECT 'rejected', count(*) FROM judged WHERE len(errors) > 0
UNION ALL SELECT 'processed', count(*) FROM ok
UNION ALL SELECT 'articles_par_jour', count(DISTINCT {_DAY}) FROM ok
UNION ALL SELECT 'articles_par_source', count(DISTINCT source) FROM ok
UNION ALL SELECT 'articles_par_theme', count(DISTINCT {_THEME}) FROM ok
UNION ALL SELECT 'articles_par_pays', count(DISTINCT {_COUNTRY}) FROM ok
UNION ALL SELECT 'mots_cles', least(50, count(*)) FROM kw
UNION ALL SELECT 'top_sujets', least(50, count(*)) FROM pr
UNION ALL SELECT 'langue=' || coalesce(langue, ''), count(*) FROM ok LEFT JOIN tags USING (url) GROUP BY 1
"""
)

ORACLES: dict[str, str] = {
    "top_keywords": _TOKENS + _KEYWORDS.format(n=50),
    "top_keywords_first_seen": _TOKENS + _first_seen("kept", "tok", "mot_cle", "tok_pos"),
    "top_keywords_stopword_table": _TOKENS + _KEYWORDS.format(n=50),
    "top_topics": _PAIRS + _TOPICS.format(n=50),
    "top_topics_first_seen": _PAIRS + _first_seen("pairs", "sujet", "sujet", "i"),
    "articles_per_day": _A + _per(_DAY, "date"),
    "publication_days": _input(DATED, "dated")
    + """
SELECT doc_id, CASE WHEN doc_id % 16 = 2 AND CAST(dt[9:10] AS INT) <= 12
                    THEN make_date(2024, CAST(dt[9:10] AS INT), 1) ELSE CAST(dt AS DATE) END AS date FROM dated""",
    "articles_per_source": _A + _per("coalesce(nullif(trim(source), ''), 'unknown')", "source"),
    "articles_per_theme": _A + _per(_THEME, "theme"),
    "articles_per_country": _A + _per(_COUNTRY, "pays"),
    "silver_accepted": _JUDGED
    + "SELECT bronze_key, url, titre, categorie, auteur, contenu, source, sha1(url) AS url_sha1 FROM judged WHERE len(errors) = 0",
    "silver_rejects": _JUDGED
    + "SELECT bronze_key, pos, url, array_to_string(errors, ';') AS errors FROM judged WHERE len(errors) > 0",
    "silver_judged_hot": _JUDGED
    + "SELECT bronze_key, pos, url, array_to_string(errors, ';') AS errors FROM judged",
    "reject_reasons": _JUDGED
    + ", e AS (SELECT unnest(errors) AS error FROM judged) SELECT error, count(*) AS n FROM e GROUP BY 1",
    "run_counters": _JUDGED
    + """SELECT count(*) AS processed, count(*) FILTER (len(errors) > 0) AS rejected,
       count(*) FILTER (len(errors) = 0) AS written FROM judged""",
    "bronze_latest": _A
    + "SELECT source, dt, sha1(url) AS url_sha1, max(doc_id) AS doc_id FROM articles GROUP BY 1, 2, 3",
    "scraper_files": _A
    + """SELECT source, count(DISTINCT (dt, doc_id // 500)) AS files, count(*) AS n, CAST(sum(length(contenu)) AS BIGINT) AS n_chars
FROM articles GROUP BY 1""",
    "silver_envelopes": _A
    + """SELECT source, count(*) AS n, CAST(sum(length(contenu)) AS BIGINT) AS n_chars FROM articles WHERE doc_id % 50 NOT IN (3, 4) GROUP BY 1
UNION ALL SELECT 'rejected', count(*), 0 FROM articles WHERE doc_id % 50 IN (3, 4)""",
    "bronze_round_trip": _A
    + """, s AS (SELECT *, row_number() OVER (PARTITION BY source, dt, url ORDER BY doc_id DESC) AS rn
         FROM articles WHERE langue = 'en' AND url <> ''),
u AS (SELECT source, dt, contenu FROM s WHERE rn = 1
      UNION ALL SELECT source, dt, contenu FROM articles WHERE langue <> 'en')
SELECT source, dt, count(*) AS n, CAST(sum(length(contenu)) AS BIGINT) AS n_chars FROM u GROUP BY 1, 2""",
    "limit_objects": _A
    + """, s AS (SELECT *, row_number() OVER (PARTITION BY bronze_key ORDER BY doc_id DESC) AS rn
         FROM articles WHERE url <> ''),
k AS (SELECT 'bronze/source=' || source || '/dt=' || dt || '/articles/' || sha1(url) || '.json' AS bronze_key, titre,
             row_number() OVER (PARTITION BY source, dt, url ORDER BY doc_id DESC) AS rn FROM articles WHERE url <> '')
SELECT bronze_key, titre FROM k WHERE rn = 1 ORDER BY bronze_key LIMIT 25""",
    "silver_rewrite": _A
    + """, s AS (SELECT *, row_number() OVER (PARTITION BY source, dt, url ORDER BY doc_id DESC) AS rn
         FROM articles)
SELECT source, dt, CASE WHEN langue = 'fr' THEN 'second' ELSE 'first' END AS run, count(*) AS n
FROM s WHERE rn = 1 GROUP BY 1, 2, 3""",
    "page_titles": _CLEAN_PAGES
    + f"""SELECT page_id, trim(CASE page_id % 5 WHEN 0 THEN 'A © B & C ' WHEN 1 THEN '¬it; ½x &unknown; '
        WHEN 2 THEN '© éz – ' WHEN 3 THEN 'été & &amp; ' ELSE 'a &b; & &; &#; ' END || {_TITLE}) AS titre FROM c""",
    "page_bodies": _CLEAN_PAGES + f"SELECT page_id, {_BODY} AS contenu FROM c",
    "page_meta": _META + "SELECT page_id, date_publication, categorie, auteur FROM e",
    "page_report": _META
    + """SELECT 'any' AS source, count(*) AS found, count(*) FILTER (len(errors) = 0) AS valid,
       count(*) FILTER (len(errors) > 0) AS invalid FROM e""",
    "page_invalid_details": _META
    + "SELECT 'any' AS source, url, array_to_string(errors, ';') AS errors FROM e WHERE len(errors) > 0",
    "page_links": rf"""{_CLEAN_PAGES}, h AS (
  SELECT page_id, regexp_extract(url, '^https?://[^/?#]+') AS o, regexp_extract_all(clean, '<a href="([^"]*)"', 1) AS hs FROM c),
u AS (SELECT page_id, o || replace(unnest(hs), '&amp;', '&') AS link, unnest(range(len(hs))) AS i FROM h),
f AS (SELECT page_id, link, min(i) AS i FROM u GROUP BY 1, 2),
r AS (SELECT page_id, link, row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS pos FROM f)
SELECT page_id, CAST(pos AS INTEGER) AS pos, link FROM r WHERE pos < 20""",
    "site_links": _SITE_LINKS,
    "language_profiles": f"WITH {_profiles('doc_id % 2 = 0')} SELECT * FROM profiles",
    "language_tags": f"""WITH {_profiles("doc_id % 2 = 0")},
odd AS (SELECT doc_id, {_clean("text")} AS text FROM documents WHERE doc_id % 2 = 1),
{_tagged("odd", "doc_id", "text")}
SELECT doc_id, langue FROM odd LEFT JOIN tags USING (doc_id)""",
    "language_accuracy": f"""WITH {_profiles("true")},
every AS (SELECT doc_id, {_clean("text")} AS text FROM documents),
{_tagged("every", "doc_id", "text")}
SELECT lang, count(*) AS n, count(*) FILTER (langue = lang) AS correct FROM documents LEFT JOIN tags USING (doc_id) GROUP BY 1""",
    "speed_words": _A
    + f", w AS (SELECT unnest({_WORDS}) AS mot FROM articles) SELECT mot, count(*) AS count FROM w WHERE {_WORD_OK} GROUP BY 1",
    "rolling_source_counts": f"""WITH s AS (SELECT event_type AS key, {_STARTS} AS window_start FROM events)
SELECT window_start, key, count(*) AS n FROM s GROUP BY 1, 2""",
    "rolling_top_words": _TIMED + _top_words("timed", "titre", "contenu", ""),
    "event_envelopes": _A
    + "SELECT url AS key, 'article.scraped' AS event_type, 'articles.json' AS source_file, titre FROM articles WHERE url <> ''",
    "stream_speed_zone": _GOOD_EVENTS
    + f""", o AS (SELECT sha1(CASE WHEN url = '' THEN concat('articles/0/', doc_id) ELSE url END) AS object_id, url, src,
             {_clean("titre")} AS titre, doc_id FROM good),
l AS (SELECT *, row_number() OVER (PARTITION BY object_id ORDER BY doc_id DESC) AS rn FROM o)
SELECT object_id, url, src AS source, titre, doc_id AS "offset" FROM l WHERE rn = 1""",
    "batch_dedup": _A
    + f""", v AS (SELECT url, coalesce(nullif(trim(source), ''), 'inconnu') AS source FROM articles
       WHERE url LIKE 'http%' AND coalesce(date_publication, '') <> '' AND {_clean("titre")} <> '' AND length({_clean("contenu")}) > 100),
w AS (SELECT url, min(source) AS source FROM v GROUP BY 1)
SELECT source, count(*) AS n, count(*) AS urls FROM w GROUP BY 1""",
    "stream_dead_letters": _A
    + """, b AS (SELECT CASE doc_id % 100 WHEN 11 THEN 'value is not JSON' ELSE 'missing/invalid article' END AS error
      FROM articles WHERE doc_id % 100 IN (11, 61))
SELECT 'deserialize_or_validate' AS stage, error, count(*) AS n FROM b GROUP BY 2""",
    "stream_source_counts": _GOOD_EVENTS
    + f", s AS (SELECT src AS key, {_STARTS} AS window_start FROM good) SELECT window_start, key, count(*) AS n FROM s GROUP BY 1, 2",
    "stream_top_words": _GOOD_EVENTS
    + f", cleaned AS (SELECT ts, {_clean('titre')} AS tt, {_clean('contenu')} AS cc FROM good)"
    + _top_words(
        "cleaned", "tt", "cc",
        "AND window_start + INTERVAL 5 MINUTE <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM cleaned)",
    ),
    "warehouse_upsert": _A
    + f""", x AS (SELECT {_THEME} AS theme, doc_id FROM articles),
cur AS (SELECT theme, count(*) AS n FROM x WHERE doc_id % 2 = 0 GROUP BY 1),
inc AS (SELECT CASE WHEN theme = 'Sport' THEN 'Sports' ELSE theme END AS theme, count(*) AS n FROM x WHERE doc_id % 2 = 1 GROUP BY 1)
SELECT coalesce(inc.theme, cur.theme) AS theme, coalesce(inc.n, cur.n) AS nb_articles
FROM cur FULL JOIN inc ON cur.theme = inc.theme""",
    "chart_daily": _A + _per(_DAY, "date", "total"),
    "chart_source": _A + _per("source", "source", "total"),
    "chart_theme": _A + _per(_THEME, "theme", "total"),
    "chart_country": _A + _per(_COUNTRY, "pays", "total"),
    "chart_keywords": _TOKENS + _KEYWORDS.format(n=20),
    "chart_topics": _PAIRS + _TOPICS.format(n=20),
    "chart_top_sources": _A + _per("source", "source") + " ORDER BY 2 DESC, 1 LIMIT 5",
    "table_checks": _TOKENS
    + f""", t2 AS (SELECT list_filter({_split("titre")}, lambda x: {_keep("x", "coalesce(langue, '')")}) AS ws FROM articles),
p AS (SELECT ws, unnest(range(1, len(ws))) AS i FROM t2 WHERE len(ws) >= 2),
pr AS (SELECT DISTINCT ws[i] || ' ' || ws[i + 1] AS sujet FROM p)
SELECT 'articles_par_jour' AS table_name, count(DISTINCT {_DAY}) AS n FROM articles
UNION ALL SELECT 'articles_par_source', count(DISTINCT source) FROM articles
UNION ALL SELECT 'articles_par_theme', count(DISTINCT {_THEME}) FROM articles
UNION ALL SELECT 'articles_par_pays', count(DISTINCT {_COUNTRY}) FROM articles
UNION ALL SELECT 'mots_cles', least(50, count(DISTINCT tok)) FROM kept
UNION ALL SELECT 'top_sujets', least(50, count(*)) FROM pr""",
    "medallion_run": _RUN,
}
ORACLES["link_limit"] = f"SELECT * FROM ({_SITE_LINKS}) WHERE pos < 3"
ORACLES["stream_resume"] = ORACLES["stream_speed_zone"]
