"""Input views over the test tables, in SQL that Spark and DuckDB both run.

``{documents}`` and ``{pages}`` stand for the tables. The tables have no titles,
dates, categories or site markup, so the views derive them from their rows.
"""

_D = """
WITH d AS (
  SELECT doc_id, text, lang,
         CASE substr(source, 4)::int % 8
           WHEN 0 THEN 'hespress'  WHEN 1 THEN 'akhbarona'  WHEN 2 THEN 'goud'
           WHEN 3 THEN 'barlamane' WHEN 4 THEN 'aljazeera'  WHEN 5 THEN 'bbc_arabic'
           WHEN 6 THEN 'reuters'   ELSE source END AS source,
         concat('https://news.example.org/', sha1(text)) AS url,
         concat('2024-01-', lpad((doc_id % 28 + 1)::string, 2, '0')) AS dt
  FROM {documents}),
a AS (
  SELECT doc_id,
         concat('bronze/source=', source, '/dt=', dt, '/articles/', sha1(url), '.json') AS bronze_key,
         doc_id AS pos, dt,
         split_part(text, chr(10), 1) AS titre,
         CASE WHEN doc_id % 40 = 7 THEN '' WHEN doc_id % 40 = 9 THEN 'ftp://x' ELSE url END AS url,
         CASE WHEN doc_id % 25 = 3 THEN NULL ELSE concat(dt, 'T10:00:00Z') END AS date_publication,
         CASE doc_id % 6 WHEN 0 THEN 'Politique' WHEN 1 THEN 'Sport' WHEN 2 THEN 'Economie'
                         WHEN 3 THEN '' WHEN 4 THEN NULL ELSE 'Culture' END AS categorie,
         CASE doc_id % 4 WHEN 0 THEN ' ' WHEN 1 THEN NULL ELSE concat(' A  B ', lang) END AS auteur,
         text AS contenu, source, lang AS langue
  FROM d)
"""

# Articles; copies of a text share their url.
ARTICLES = _D + "SELECT * FROM a"

# Articles as they come from outside: tags, stray blanks, blank titles, dates and sources.
RAW = _D + """
SELECT doc_id, bronze_key, pos, dt,
       CASE doc_id % 20 WHEN 4 THEN ' ' ELSE concat('  <b>', titre, '</b>', chr(9)) END AS titre,
       CASE doc_id % 3 WHEN 0 THEN concat(' ', url, '  ') ELSE url END AS url,
       CASE doc_id % 30 WHEN 5 THEN ' ' ELSE date_publication END AS date_publication,
       categorie, auteur,
       concat('<p>', replace(contenu, chr(10), concat('</p>', chr(10), '<p>')), '</p>') AS contenu,
       CASE doc_id % 10 WHEN 2 THEN ' ' ELSE source END AS source
FROM a
"""

# The publication day in several notations.
DATED = _D + """
SELECT doc_id, dt,
       CASE doc_id % 16
         WHEN 8 THEN concat(substr(dt, 9, 2), 'th of January 2024')
         WHEN 9 THEN concat('2024 Jan ', substr(dt, 9, 2))
         WHEN 10 THEN concat('January ', substr(dt, 9, 2), ' 2024 6pm')
         WHEN 11 THEN '2023-05-09T99:99'
         WHEN 12 THEN concat('6:30 p.m. CET, Tuesday the ', substr(dt, 9, 2), 'th of Jan., 2024')
         WHEN 13 THEN concat(substr(dt, 9, 2), '-Jan-24')
         WHEN 14 THEN 'January 2024'
         WHEN 15 THEN concat('on Jan ', substr(dt, 9, 2), ' and more 2024')
         WHEN 0 THEN concat(dt, 'T23:30:00-05:00')
         WHEN 1 THEN NULL
         WHEN 2 THEN concat(substr(dt, 9, 2), '/01/2024')
         WHEN 3 THEN concat('Jan ', substr(dt, 9, 2), ', 2024')
         WHEN 4 THEN concat('Fri, ', substr(dt, 9, 2), ' Jan 2024 18:00:00 GMT')
         WHEN 5 THEN concat('202401', substr(dt, 9, 2))
         WHEN 6 THEN '10:00'
         ELSE concat('  ', substr(dt, 9, 2), ' january 2024 ') END AS date_publication
FROM a
"""

# Pages whose titles hold references of all kinds: old names without ';', unknown names, numbers.
PAGES_REFERENCES = """
SELECT page_id, url, 'any' AS site,
       replace(html, '<h1>', concat('<h1>', CASE page_id % 5
         WHEN 0 THEN 'A &copy B &amp C ' WHEN 1 THEN '&notit; &frac12x &unknown; ' WHEN 2 THEN '&#169 &#xe9z &#150; '
         WHEN 3 THEN '&eacute;t&eacute &AMP &ampamp; ' ELSE 'a &b; & &; &#; ' END)) AS html
FROM {pages}
"""

# Pages with category, author and date markup of every kind.
PAGES_META = """
SELECT page_id, url, 'any' AS site,
       replace(replace(html, '<head>', concat('<head>',
         CASE page_id % 4 WHEN 2 THEN concat('<meta content="Sec &amp; ', page_id, '" property="article:section">')
                          ELSE '' END,
         CASE page_id % 5 WHEN 1 THEN concat('<meta name=''author'' content='' Meta  ', page_id, ' ''>')
                          ELSE '' END,
         CASE page_id % 3 WHEN 1 THEN '<meta property="article:published_time" content="2024-02-03T04:05:06Z">'
                          ELSE '' END)),
         '<article>', concat(
         CASE page_id % 4 WHEN 0 THEN concat(
                            CASE page_id % 8 WHEN 0 THEN '<ul class="breadcrumb"><li>no link</li></ul>'
                                             ELSE '<p class="breadcrumb"><a href="/e"> </a></p>' END,
                            CASE page_id % 8 WHEN 0 THEN '<div' ELSE '<nav' END,
                            ' class="top breadcrumb"><div><a href="/c"><i>Cat</i>', page_id, '</a></div>',
                            CASE page_id % 8 WHEN 0 THEN '</div>' ELSE '</nav>' END)
                          WHEN 1 THEN '<a rel="category tag" href="/t">Tagged</a>' ELSE '' END,
         '<article>',
         CASE page_id % 5 WHEN 0 THEN '<author>By <b>A</b></author>'
                          WHEN 2 THEN '<span class="post author x"> Class  A </span>'
                          WHEN 3 THEN '<a rel="author" href="/u">Rel A</a>' ELSE '' END,
         CASE page_id % 3 WHEN 0 THEN concat('<time class="d" datetime=" 2024-01-0', page_id % 9 + 1, ' ">x</time>')
                          WHEN 2 THEN CASE page_id % 2 WHEN 0 THEN '<time>3 <b>May</b> 2024</time>' ELSE '' END
                          ELSE '' END)) AS html
FROM {pages}
"""

# Listing pages of every site, of one without a rule and of none, with links of all shapes.
LISTINGS = """
SELECT page_id, url,
       CASE page_id % 9 WHEN 0 THEN 'hespress' WHEN 1 THEN 'akhbarona' WHEN 2 THEN 'goud'
                        WHEN 3 THEN 'barlamane' WHEN 4 THEN 'aljazeera' WHEN 5 THEN 'bbc_arabic'
                        WHEN 6 THEN 'reuters' WHEN 7 THEN 'lematin' END AS site,
       concat(
         '<a class="x" href="/2024/01/05/item-', page_id, '">1</a>',
         '<A HREF=''/news/', 100000 + page_id, '.html''>2</A>',
         '<a href="/world/story-', page_id, '/">3</a>',
         '<a href="/tag/2024/01/05/x.html">4</a>',
         '<a href="https://other.example/2024/01/05/', 10000 + page_id, '">5</a>',
         '<a href="/2024/01/05/item-', page_id, '">6</a>',
         '<a href="economy/../sports/x-', page_id, '">7</a>',
         '<a href="mailto:a@b.example">8</a><a href="#top">9</a><a name="n">10</a>',
         '<a href="/WORLD/story.htm?x=1&amp;y=2">11</a>',
         '<!-- <a href="/2024/01/05/hidden.html">12</a> -->') AS html
FROM {pages}
"""
