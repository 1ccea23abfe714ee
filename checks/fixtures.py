"""Inputs of the check queries, derived from a given table by SQL both engines read.

The given pages name no WordPress or Disqus site, so the crawl inputs are expressions
over them: one index row, up to two record lines and a few captured responses per page.
`src` is any relation (page_id, url): PAGES, or BULK_PAGES for more rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PAGES = "(SELECT page_id, url FROM pages)"
BULK_PAGES = (
    "(SELECT o_orderkey AS page_id, 'https://www.c' || CAST(o_custkey AS STRING) || '.example.' || "
    "CASE o_custkey % 3 WHEN 0 THEN 'com' WHEN 1 THEN 'net' ELSE 'org' END || '/' || "
    "CAST(o_orderkey AS STRING) AS url FROM orders)"
)

OTHER_PAGES = "(SELECT page_id, replace(url, '.example.', '.sample.') AS url FROM pages)"

TABLES = ("pages", "orders")

EVERY_FOURTH = "page_id % 4"
RUNS_OF_64 = "CAST(FLOOR(page_id / 64) AS BIGINT)"


def spark_sql(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run fixture SQL on Spark over the given tables."""
    for table in TABLES:
        spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)
    return spark.sql(sql.replace("POST_NUMBERS", "explode(sequence(1, 12))"))


def duck_sql(sql: str) -> str:
    """The same fixture SQL for the oracle engine."""
    return sql.replace("POST_NUMBERS", "unnest(range(1, 13))")


def index(src: str = PAGES) -> str:
    """URL index rows with `partition_idx`."""
    return f"""
    SELECT page_id,
      CASE WHEN page_id % 23 = 0 THEN NULL
           ELSE regexp_extract(url_host_name, '([^.]+[.](co[.]uk|[a-z]+))$', 1) END AS url_host_registered_domain,
      url_host_name,
      'https://' || url_host_name || url_path AS url,
      url_path,
      CAST(CASE WHEN page_id % 10 = 9 THEN 404 ELSE 200 END AS INT) AS fetch_status,
      CASE WHEN page_id % 14 = 13 THEN 'application/xhtml+xml' ELSE 'text/html' END AS content_mime_detected,
      CAST(page_id % 4 AS INT) AS partition_idx
    FROM (
      SELECT page_id,
        CASE WHEN page_id % 17 = 0 THEN 'site' || CAST(page_id % 3 AS STRING) || '.wordpress.com'
             WHEN length(h) % 5 = 0 THEN regexp_replace(h, '[.]example[.][a-z]+$', '-site.co.uk')
             ELSE replace(h, '.example.', '-site.') END AS url_host_name,
        CASE page_id % 6 WHEN 0 THEN '/wp-content/x.png' WHEN 1 THEN '/blog/wp-json/v2'
             WHEN 2 THEN '/wp-includes/a.js' WHEN 3 THEN '/wp-json'
             ELSE '/plain/' || CAST(page_id AS STRING) END AS url_path
      FROM (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1) AS h FROM {src} p) hosts
    ) named"""


def wat_lines(src: str = PAGES, file_idx: str = EVERY_FOURTH) -> str:
    """Crawl-record lines (file_idx, line_no, value); some pages have no header of their own."""
    return f"""
    SELECT CAST({file_idx} AS INT) AS file_idx, 2 * page_id AS line_no,
      CASE WHEN page_id % 12 = 5 THEN 'X-Page: ' ELSE 'WARC-Target-URI: ' END || url AS value
    FROM ({index(src)}) a
    UNION ALL
    SELECT CAST({file_idx} AS INT), 2 * page_id + 1,
      CASE WHEN k = 5 THEN '{{broken disqus.com' ELSE
        '{{"Envelope":{{"Payload-Metadata":{{"HTTP-Response-Metadata":{{"HTML-Metadata":{{"Scripts":['
        || CASE WHEN k IN (0, 2) THEN '{{"url":"//My' || sn || '.disqus.com/embed.js"}}'
                WHEN k = 4 THEN '{{"url":"//www.disqus.com/embed.js"}}' ELSE '' END
        || '],"Links":['
        || CASE WHEN k IN (1, 2) THEN '{{"url":"https://' || sn || '.disqus.com/?url=x"}}'
                WHEN k = 3 THEN '{{"url":"https://www.disqus.com/home"}}'
                WHEN k = 7 THEN '{{"url":"//UP-' || sn || '.disqus.com/"}}' ELSE '' END
        || ']}}}}}}}}}}' END
    FROM (SELECT page_id, page_id % 8 AS k, 's' || CAST(page_id % 40 AS STRING) AS sn FROM {src} p) b"""


def domains(src: str = PAGES) -> str:
    """Domains to verify, one per page, with the number `k` of their case."""
    return f"""
    SELECT page_id, page_id % 20 AS k, 'p' || CAST(page_id AS STRING) || '.' || url_host_name AS domain
    FROM ({index(src)}) i"""


def _sample_body() -> str:
    item = lambda i, post: f"'{{\"id\":{i},\"post\":' || CAST({post} AS STRING) || '}}'"
    some = " || ',' || ".join(item(i, f"(page_id * {i} + {i * i}) % 7") for i in range(1, 10))
    many = " || ',' || ".join([*(item(i, i) for i in range(1, 13)), item(13, "1 + page_id % 12")])
    return (
        f"CASE WHEN k = 13 THEN '[]' WHEN k = 15 THEN '[' || {many} || ']' "
        f"WHEN k = 16 THEN '[{{\"id\":1,\"post\":3}},{{\"id\":2,\"post\":\"x\"}}]' ELSE '[' || {some} || ']' END"
    )


def captures(src: str = PAGES) -> str:
    """Captured responses of `domains`."""
    marker = """'; rel="https://api.w.org"'"""
    root = "'<https://' || domain || '/wp-json/>'"
    none = "CAST(NULL AS STRING)"
    return f"""
    SELECT domain, 'home_head' AS kind, CAST(NULL AS BIGINT) AS post_id,
      CAST(CASE WHEN k IN (3, 4, 5, 6) THEN NULL ELSE 200 END AS INT) AS status,
      CASE WHEN k IN (2, 3, 4, 5, 6) THEN {none}
           WHEN k = 1 THEN '<https://' || domain || '/feed>; rel="alternate"'
           WHEN k = 0 THEN '<https://' || domain || '/feed>; rel="alternate", ' || {root} || {marker}
           WHEN k = 19 THEN 'api.w.org' ELSE {root} || {marker} END AS link_header,
      {none} AS x_wp_total, {none} AS body,
      CASE WHEN k = 3 THEN 'dial tcp: connection refused' WHEN k IN (4, 5) THEN 'tls: handshake failure'
           WHEN k = 6 THEN 'x509: certificate signed by unknown authority' END AS error
    FROM ({domains(src)}) d
    UNION ALL
    SELECT domain, 'home_get', CAST(NULL AS BIGINT), CAST(200 AS INT),
      CASE WHEN k = 1 THEN {root} || {marker} END, {none}, '<html></html>', {none}
    FROM ({domains(src)}) d WHERE k IN (1, 2)
    UNION ALL
    SELECT domain, 'home_http_get', CAST(NULL AS BIGINT), CAST(CASE WHEN k = 6 THEN NULL ELSE 200 END AS INT),
      CASE WHEN k = 4 THEN {root} || {marker} END, {none}, {none}, CASE WHEN k = 6 THEN 'x' END
    FROM ({domains(src)}) d WHERE k IN (4, 5, 6)
    UNION ALL
    SELECT domain, 'comments_probe', CAST(NULL AS BIGINT),
      CAST(CASE WHEN k = 7 THEN 401 WHEN k = 8 THEN 403 WHEN k = 9 THEN 500 WHEN k = 18 THEN NULL ELSE 200 END AS INT),
      {none},
      CASE WHEN k IN (10, 11) THEN '7' WHEN k = 12 THEN '0' WHEN k = 13 THEN '9' WHEN k = 14 THEN ' 42 '
           WHEN k = 18 THEN NULL WHEN k = 17 THEN '99999999999999999999' ELSE CAST(page_id % 60 AS STRING) END,
      CASE WHEN k = 10 THEN '{{' WHEN k = 11 THEN '{{"a":1}}' WHEN k IN (12, 13) THEN '[]'
           WHEN k = 18 THEN NULL ELSE ' [{{"id":1,"post":10}}]' END,
      CASE WHEN k = 18 THEN 'context deadline exceeded' END
    FROM ({domains(src)}) d WHERE k NOT IN (2, 3, 5, 6)
    UNION ALL
    SELECT domain, 'comments_sample', CAST(NULL AS BIGINT), CAST(CASE WHEN page_id % 29 = 0 THEN 503 ELSE 200 END AS INT),
      {none}, {none}, {_sample_body()}, {none}
    FROM ({domains(src)}) d WHERE k NOT IN (2, 3, 5, 6)
    UNION ALL
    SELECT domain, 'post', CAST(post_id AS BIGINT),
      CAST(CASE WHEN (page_id + post_id) % 13 = 0 THEN NULL WHEN (page_id + post_id) % 11 = 0 THEN 404 ELSE 200 END AS INT),
      {none}, {none},
      CASE (page_id + post_id) % 7
        WHEN 0 THEN '{{"link":"https://' || domain || '/p","title":{{"rendered":"Hello"}}}}'
        WHEN 1 THEN '{{"link":"https://' || domain || '/q","title":"My Title"}}'
        WHEN 2 THEN '{{"link":"https://' || domain || '/r","title":{{"rendered":""}}}}'
        WHEN 3 THEN '{{"link":"https://' || domain || '/s","title":null}}'
        WHEN 4 THEN '{{"link":"https://' || domain || '/t"}}'
        WHEN 5 THEN '{{"link":5}}'
        ELSE '{{"link":"https://' || domain || '/u","title":{{"rendered":"'
             || repeat('Größe ', CAST(5 + page_id % 6 AS INT)) || CAST(post_id AS STRING) || '"}}}}' END,
      CASE WHEN (page_id + post_id) % 13 = 0 THEN 'context deadline exceeded' END
    FROM (SELECT domain, page_id, POST_NUMBERS AS post_id FROM ({domains(src)}) d WHERE k NOT IN (2, 3, 5, 6)) n"""


def manifest(src: str = PAGES) -> str:
    """Manifest lines (path): several kinds, unsorted, some blank or padded."""
    number = "lpad(CAST((page_id * 7919) % 100003 AS STRING), 6, '0')"
    return f"""
    SELECT CASE WHEN page_id % 19 = 7 THEN '  '
      WHEN page_id % 4 = 0 THEN ' cc-index/table/cc-main/warc/crawl=A/subset=warc/part-' || {number} || '.parquet'
      WHEN page_id % 4 = 1 THEN 'cc-index/table/cc-main/warc/crawl=A/subset=robotstxt/part-' || {number} || '.parquet'
      WHEN page_id % 20 = 2 THEN 'cc-index/table/cc-main/warc/crawl=A/subset=warc/it''s-' || {number} || '.parquet'
      WHEN page_id % 4 = 2 THEN 'crawl-data/A/segments/' || CAST(page_id % 9 AS STRING) || '/warc/' || {number} || '.warc.gz'
      ELSE 'crawl-data/A/segments/' || CAST(page_id % 9 AS STRING) || '/wat/' || {number} || '.warc.wat.gz  '
      END AS path
    FROM {src} p"""


def wp_log(src: str = PAGES) -> str:
    """Insert history of WordPress candidates."""
    return f"""
    SELECT page_id % 5 AS batch_id, page_id AS ordinal, url_host_registered_domain AS domain,
      url_host_name AS hostname, url AS sample_url
    FROM ({index(src)}) i WHERE url_host_registered_domain IS NOT NULL"""


def disqus_log(src: str = PAGES) -> str:
    """Insert history of Disqus candidates."""
    return f"""
    SELECT (page_id + 2) % 5 AS batch_id, page_id AS ordinal, url_host_registered_domain AS domain,
      url_host_name AS hostname, url AS sample_url, 's' || CAST(page_id % 40 AS STRING) AS disqus_shortname
    FROM ({index(src)}) i WHERE url_host_registered_domain IS NOT NULL"""


def results_log(src: str = PAGES) -> str:
    """Upsert history of verification results; domains in .com are still to be verified."""
    return f"""
    SELECT page_id % 5 AS batch_id, page_id AS ordinal, url_host_registered_domain AS domain,
      CAST(CASE WHEN page_id % 7 = 0 THEN 0 ELSE 1 END AS BIGINT) AS wp_confirmed,
      CAST(CASE WHEN page_id % 7 < 2 THEN 0 ELSE 1 END AS BIGINT) AS comments_endpoint,
      CAST(page_id % 4 * (page_id % 13) AS BIGINT) AS comment_count_hint,
      CASE WHEN page_id % 7 = 0 THEN '' ELSE 'https://' || url_host_name || '/wp-json/' END AS api_root,
      CASE WHEN page_id % 7 = 0 THEN 'no WordPress API header' WHEN page_id % 7 = 1 THEN 'no comments' ELSE '' END AS error
    FROM ({index(src)}) i WHERE url_host_registered_domain NOT LIKE '%.com'"""


def pages_log(src: str = PAGES) -> str:
    """Upsert history of pages."""
    return f"""
    SELECT page_id % 5 AS batch_id, page_id AS ordinal, url_host_registered_domain AS domain,
      CAST(page_id % 6 AS BIGINT) AS post_id, url,
      'Title ' || repeat('ö', CAST(page_id % 40 AS INT)) || CAST(page_id AS STRING) AS title,
      CAST(page_id % 11 AS BIGINT) AS comment_count_in_sample
    FROM ({index(src)}) i WHERE url_host_registered_domain IS NOT NULL"""


def progress_log(src: str = PAGES) -> str:
    """Upsert history of scan progress: two crawls, gaps, partitions with nothing found."""
    return f"""
    SELECT page_id % 5 AS batch_id, page_id AS ordinal,
      CASE WHEN page_id % 3 = 0 THEN 'A' ELSE 'B' END AS crawl,
      CAST(FLOOR(page_id / 2) * 3 AS BIGINT) AS partition_idx,
      'part-' || CAST(page_id AS STRING) AS partition_url,
      CAST(page_id % 4 AS BIGINT) AS candidates_found
    FROM {src} p"""


def crawl_files(src: str = PAGES) -> str:
    """Numbered files of a crawl, two per page."""
    return f"""
    SELECT 2 * page_id AS partition_idx, 'file-a' || CAST(page_id AS STRING) AS partition_url FROM {src} p
    UNION ALL
    SELECT 2 * page_id + 1, 'file-b' || CAST(page_id AS STRING) FROM {src} p"""


def commits(src: str = PAGES) -> str:
    """Committed batches: of the five that were written, number 2 never was."""
    return f"SELECT DISTINCT batch_id FROM (SELECT page_id % 5 AS batch_id FROM {src} p) b WHERE batch_id <> 2"


def url_variants(src: str = PAGES) -> str:
    """Well-formed and odd URLs of every page."""
    return f"""
    SELECT page_id, CASE page_id % 9
        WHEN 0 THEN 'http://user:pw@' || upper(h) || ':8080/x?y=1'
        WHEN 1 THEN '//' || h || '/x'
        WHEN 2 THEN 'mailto:someone@' || h
        WHEN 3 THEN 'http://' || h || ':port/'
        WHEN 4 THEN 'http://[2001:db8::' || CAST(page_id AS STRING) || ']:80/'
        WHEN 5 THEN 'http://' || h || '/%zz'
        WHEN 6 THEN 'https://www.shop.' || replace(h, '.', '-') || '.co.uk./?q=%zz'
        ELSE url END AS url
    FROM (SELECT page_id, url, regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1) AS h FROM {src} p) v"""


def forum_links(src: str = PAGES) -> str:
    """Script and link URLs of every page."""
    return f"""
    SELECT page_id, CASE page_id % 10
        WHEN 0 THEN '//My-Blog' || n || '.disqus.com/embed.js'
        WHEN 1 THEN 'https://site' || n || '.disqus.com/?url=' || url
        WHEN 2 THEN '//WWW.disqus.com/embed.js'
        WHEN 3 THEN 'http://help.disqus.com/' || n
        WHEN 4 THEN 'https://disqus.com/home/'
        WHEN 5 THEN 'plain' || n || '.disqus.com/x'
        WHEN 6 THEN '//www.disqus.com/?u=//real.disqus.com'
        WHEN 7 THEN '//a.b' || n || '.disqus.com/x'
        WHEN 8 THEN '//under_score' || n || '.disqus.com/embed.js?v=2'
        ELSE url END AS link
    FROM (SELECT page_id, url, CAST(page_id AS STRING) AS n FROM {src} p) v"""


def error_texts(src: str = PAGES) -> str:
    """Request errors and total headers of every page."""
    return f"""
    SELECT page_id,
      CASE page_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'remote error: tls: handshake failure'
        WHEN 2 THEN 'x509: certificate signed by unknown authority ' || CAST(page_id AS STRING)
        WHEN 3 THEN 'dial tcp: connection refused' ELSE 'context deadline exceeded' END AS error,
      CASE page_id % 8 WHEN 0 THEN CAST(page_id AS STRING) WHEN 1 THEN '+' || CAST(page_id AS STRING)
        WHEN 2 THEN ' 42 ' WHEN 3 THEN '' WHEN 4 THEN '9999999999999999999' || CAST(page_id AS STRING)
        WHEN 5 THEN '-9999999999999999999' WHEN 6 THEN '4_2' ELSE '-' || CAST(page_id AS STRING) END AS x_wp_total
    FROM {src} p"""


def home_html(src: str = "pages") -> str:
    """Page HTML, with a forum marker put in front on some pages."""
    return f"""
    SELECT page_id, CASE page_id % 5
        WHEN 0 THEN '<script src="//forum' || n || '.disqus.com/embed.js"></script>' || html
        WHEN 1 THEN '<script>var disqus_shortname = ''cool-' || n || ''';</script>' || html
        WHEN 2 THEN '<script>var disqus_shortname="other' || n || '";</script>' || html
        WHEN 3 THEN '<script>var disqus_shortname = ''v'';</script><script src="//e' || n || '.disqus.com/embed.js"></script>' || html
        ELSE '<p>see disqus.com</p>' || html END AS html
    FROM (SELECT page_id, html, CAST(page_id AS STRING) AS n FROM {src}) h"""


def discovered_captures(src: str = PAGES) -> str:
    """Captures of all domains of the index: home page, probe, sample and two of three sampled posts."""
    kinds = {
        "home_head": ("0", "CAST(NULL AS STRING)", "'<https://x/wp-json/>; api.w.org'"),
        "comments_probe": ("0", "'[{\"post\":1}]'", "''"),
        "comments_sample": ("0", "'[{\"post\":2},{\"post\":1},{\"post\":2},{\"post\":3}]'", "''"),
        "post": ("n", "'{\"link\":\"https://' || domain || '/p' || CAST(n AS STRING) || '\",\"title\":{\"rendered\":\"Title\"}}'", "''"),
    }
    parts = [
        f"SELECT domain, '{kind}' AS kind, CAST({post} AS BIGINT) AS post_id, "
        f"CAST(CASE WHEN odd THEN NULL WHEN n = 3 THEN 404 ELSE 200 END AS INT) AS status, "
        f"CASE WHEN odd THEN NULL ELSE {link} END AS link_header, '5' AS x_wp_total, {body} AS body, "
        f"CASE WHEN odd THEN 'timeout' END AS error FROM (SELECT *, POST_NUMBERS AS n FROM domains) "
        f"WHERE n <= {3 if kind == 'post' else 1}"
        for kind, (post, body, link) in kinds.items()
    ]
    return (
        "WITH domains AS (SELECT DISTINCT url_host_registered_domain AS domain, "
        f"length(url_host_registered_domain) % 2 = 1 AS odd FROM ({index(src)}) i) " + " UNION ALL ".join(parts)
    )


def json_variants(src: str = PAGES) -> str:
    """Envelope lines whose keys are in odd case or repeated, and the forum name to be found."""
    scripts = """'{"Envelope":{"Payload-Metadata":{"HTTP-Response-Metadata":{"HTML-Metadata":{"""
    end = """}}}}}'"""
    quote = """chr(92) || '"'"""
    url = lambda name: f"//{name}' || page_id || '.disqus.com/embed.js"
    return f"""
    SELECT page_id, CASE page_id % 8
        WHEN 0 THEN '{{"envelope":{{"PAYLOAD-metadata":{{"http-Response-Metadata":{{"html-METADATA":{{"SCRIPTS" : [{{"URL":"{url('a')}"}}]}}}}}}}}}}'
        WHEN 1 THEN {scripts}"Scripts":[{{"url":"//no.disqus.com/embed.js","URL":"{url('b')}"}}]{end}
        WHEN 2 THEN {scripts}"scripts":[{{"URL":"//no.disqus.com/embed.js","Url":"x","url":"{url('c')}"}}]{end}
        WHEN 3 THEN {scripts}"Scripts":[{{"url":"x","note":"' || {quote} || 'URL' || {quote} || ': //no.disqus.com/embed.js"}}]{end}
        WHEN 4 THEN {scripts}"Links":[{{"url":"//no.disqus.com"}}],"LINKS":[{{"url":"//d' || page_id || '.disqus.com"}}]{end}
        WHEN 5 THEN {scripts}"Scripts":[{{"urls":"//no.disqus.com/embed.js","URL_":"//no.disqus.com/embed.js"}}]{end}
        WHEN 6 THEN {scripts}"Scripts":[{{"url":"{url('e')}","URL":5}}]{end}
        ELSE {scripts}"Scripts":[{{"url":"{url('f')}"}}]{end} END AS value,
      CASE page_id % 8 WHEN 0 THEN 'a' || page_id WHEN 1 THEN 'b' || page_id WHEN 2 THEN 'c' || page_id
        WHEN 4 THEN 'd' || page_id WHEN 7 THEN 'f' || page_id ELSE '' END AS expected
    FROM {src} p"""


def repeated_keys(src: str = PAGES) -> str:
    """Post bodies, probes and samples whose keys are repeated or in odd case, and what is to be read from them."""
    none = "CAST(NULL AS STRING)"
    return f"""
    SELECT page_id, CASE page_id % 8
        WHEN 0 THEN '{{"link":"no","link":"l' || page_id || '","title":"no","title":"t' || page_id || '"}}'
        WHEN 1 THEN '{{"Title":{{"rendered":"no","RENDERED":"r' || page_id || '"}},"LINK":"u' || page_id || '"}}'
        WHEN 2 THEN '{{"link":{{"a":1,"a":2}},"title":"t"}}'
        WHEN 3 THEN '{{"title":{{"rendered":{{"x":1,"x":2}}}},"z":1,"z":2}}'
        WHEN 4 THEN 'null'
        WHEN 5 THEN '[{{"a":1,"a":2}}]'
        WHEN 6 THEN '{{"link":"l' || page_id || '","title":5,"z":{{"k":1,"k":2}}}} and more'
        ELSE '{{"link":"l","link":"l"' END AS post_body,
      CASE page_id % 8 WHEN 0 THEN 'l' || page_id WHEN 1 THEN 'u' || page_id WHEN 3 THEN '' WHEN 4 THEN '' WHEN 6 THEN 'l' || page_id ELSE {none} END AS link,
      CASE page_id % 8 WHEN 0 THEN 't' || page_id WHEN 1 THEN 'r' || page_id WHEN 3 THEN '' WHEN 4 THEN '' WHEN 6 THEN '' ELSE {none} END AS title,
      CASE page_id % 4 WHEN 0 THEN '[{{"id":1,"id":2}}]' WHEN 1 THEN '{{"id":1,"id":2}}' WHEN 2 THEN '[{{"id":1,"id":2}}' ELSE '[{{"a":{{"b":1,"b":2}}}}] more' END AS probe_body,
      CASE page_id % 4 WHEN 1 THEN 'invalid comments response' WHEN 2 THEN 'invalid JSON' ELSE '' END AS fault,
      CASE page_id % 3 WHEN 0 THEN '[{{"post":"no","post":' || (page_id % 5 + 1) || ',"z":1,"z":2}},{{"POST":9}}]' WHEN 1 THEN '[{{"post":1,"Post":"no"}}]' ELSE '[{{"post":9}},{{"post":9}}]' END AS sample_body
    FROM {src} p"""


def header_lines(src: str = PAGES) -> str:
    """Header lines of one response per page: repeated `Link` lines, in odd case, empty, without a marker."""
    api = lambda host: f"""'<https://{host}' || page_id || '.org/wp-json/>; rel="https://api.w.org/"'"""
    feed = """'<https://x/feed>; rel="alternate"'"""
    return f"""
    SELECT page_id, line_no, name, value FROM (
        SELECT page_id, 1 AS line_no, CASE page_id % 6 WHEN 1 THEN 'LINK' WHEN 2 THEN 'Date' ELSE 'Link' END AS name,
          CASE page_id % 6 WHEN 0 THEN {feed} WHEN 1 THEN {api('a')} WHEN 2 THEN 'today' WHEN 3 THEN {feed} || ', ' || {api('c')}
            WHEN 4 THEN 'api.w.org' ELSE '' END AS value FROM {src} p
        UNION ALL
        SELECT page_id, 2, CASE page_id % 6 WHEN 2 THEN 'x-wp-total' WHEN 3 THEN 'X-Link' ELSE 'link' END,
          CASE page_id % 6 WHEN 0 THEN {api('r')} WHEN 1 THEN {api('b')} WHEN 2 THEN '7' WHEN 3 THEN {api('x')}
            WHEN 4 THEN {api('d')} ELSE {api('e')} END FROM {src} p
        UNION ALL
        SELECT page_id, 3, 'X-WP-Total', '9' FROM {src} p) l"""
