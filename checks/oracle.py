"""Oracle SQL of the check queries, for DuckDB over the same tables.

Written from the meaning of each operator, not from its Spark plan: JSON through
DuckDB's JSON functions or the known fixture cases, first and last rows through
row_number, carry-forward through last_value.
"""

from __future__ import annotations

from checks import fixtures as fx
from checks.queries import LOGS

ORACLES: dict[str, str] = {}

# Public suffixes of two parts, and names that are no forum.
_SUFFIXES = (
    "'co.uk','co.jp','co.kr','co.nz','co.za','co.in','co.id','co.il','com.au','com.br','com.cn','com.mx',"
    "'com.tw','com.sg','com.hk','com.ar','com.tr','org.uk','org.au','net.au','ac.uk','gov.uk'"
)
_RESERVED = "'www', 'disqus', 'help', 'blog', 'docs', 'https', 'http'"
BASE = "https://data.commoncrawl.org/"


def _registered(host: str) -> str:
    name = f"lower(CASE WHEN {host} LIKE '%.' THEN left({host}, length({host}) - 1) ELSE {host} END)"
    parts = f"string_split({name}, '.')"
    return (
        f"CASE WHEN len({parts}) < 2 THEN {name} "
        f"WHEN len({parts}) >= 3 AND array_to_string({parts}[-2:], '.') IN ({_SUFFIXES}) "
        f"THEN array_to_string({parts}[-3:], '.') ELSE array_to_string({parts}[-2:], '.') END"
    )


# --- functions -------------------------------------------------------------

_HOST = """
    SELECT page_id, CASE page_id % 9
        WHEN 0 THEN upper(h) WHEN 1 THEN h WHEN 2 THEN '' WHEN 3 THEN ''
        WHEN 4 THEN '2001:db8::' || CAST(page_id AS VARCHAR) WHEN 5 THEN ''
        WHEN 6 THEN 'www.shop.' || replace(h, '.', '-') || '.co.uk.' ELSE h END AS host
    FROM (SELECT page_id, string_split(string_split(url, '://')[2], '/')[1] AS h FROM pages)"""
ORACLES["url_host"] = _HOST
ORACLES["registered_domain"] = f"SELECT page_id, {_registered('host')} AS domain FROM ({_HOST})"
ORACLES["disqus_shortname"] = f"""
    SELECT page_id, regexp_extract(link, '//([0-9A-Za-z_][0-9A-Za-z_-]*)[.]disqus[.]com/embed[.]js', 1) AS from_script,
      CASE WHEN n IN ({_RESERVED}) THEN '' ELSE n END AS from_link
    FROM (SELECT *, lower(regexp_extract(link, '(^|//)([0-9A-Za-z_][0-9A-Za-z_-]*)[.]disqus[.]com', 2)) AS n
          FROM ({fx.duck_sql(fx.forum_links())}))"""


def _shortname_case(page_id: str) -> str:
    """Forum name a record line of the fixture must give."""
    sn = f"'s' || CAST({page_id} % 40 AS VARCHAR)"
    return (
        f"CASE {page_id} % 8 WHEN 0 THEN 'My' || {sn} WHEN 1 THEN {sn} WHEN 2 THEN 'My' || {sn} "
        f"WHEN 4 THEN 'www' WHEN 7 THEN 'up-' || {sn} ELSE '' END"
    )


ORACLES["disqus_json_extract"] = (
    f"SELECT 2 * page_id + 1 AS line_no, {_shortname_case('page_id')} AS disqus_shortname FROM pages "
    "UNION ALL SELECT 2 * page_id, '' FROM pages"
)
ORACLES["comment_total"] = f"""
    SELECT page_id, CASE WHEN regexp_full_match(x_wp_total, '[+-]?[0-9]+')
        THEN CAST(greatest(least(CAST(x_wp_total AS HUGEINT), 9223372036854775807), -9223372036854775808) AS BIGINT)
        ELSE 0 END AS total
    FROM ({fx.error_texts()})"""
ORACLES["tls_errors"] = """
    SELECT page_id, CAST(CASE WHEN page_id % 5 IN (1, 2) THEN 1 ELSE 0 END AS BIGINT) AS tls FROM pages"""


def _root(link: str, domain: str) -> str:
    parts = f"list_transform(string_split({link}, ','), lambda p: trim(p))"
    urls = (
        f"list_transform(list_filter({parts}, lambda p: contains(p, 'api.w.org') AND regexp_matches(p, '^<[^>]+>')), "
        f"lambda p: string_split(substr(p, 2), '>')[1])"
    )
    return f"coalesce({urls}[1], 'https://' || {domain} || '/wp-json/')"


def _captures(src: str = fx.PAGES) -> str:
    return fx.duck_sql(fx.captures(src))


ORACLES["api_roots"] = f"""
    SELECT domain, kind, api_root, rtrim(api_root, '/') || '/wp/v2/comments?per_page=100' AS comments_url
    FROM (SELECT domain, kind, {_root('link_header', 'domain')} AS api_root FROM ({_captures()})
          WHERE kind IN ('home_head', 'home_get') AND contains(link_header, 'api.w.org'))"""

_POST = """
    SELECT domain, post_id, status, error,
      CASE WHEN json_valid(body) AND json_type(body) = 'OBJECT' AND coalesce(json_type(body, '$.link'), 'NULL') IN ('VARCHAR', 'NULL')
           THEN true ELSE false END AS readable,
      coalesce(json_extract_string(body, '$.link'), '') AS link,
      coalesce(CASE json_type(body, '$.title') WHEN 'OBJECT' THEN json_extract_string(body, '$.title.rendered')
                    WHEN 'VARCHAR' THEN json_extract_string(body, '$.title') END, '') AS title
    FROM ({captures}) WHERE kind = 'post'"""
ORACLES["post_titles"] = f"""
    SELECT domain, post_id, CASE WHEN readable THEN link END AS link, CASE WHEN readable THEN title END AS title
    FROM ({_POST.format(captures=_captures())})"""
ORACLES["homepage_disqus"] = """
    SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'forum' || n WHEN 1 THEN 'cool-' || n WHEN 2 THEN 'other' || n
        WHEN 3 THEN 'e' || n ELSE '' END AS disqus_shortname
    FROM (SELECT page_id, CAST(page_id AS VARCHAR) AS n FROM pages)"""

# --- WordPress discovery ---------------------------------------------------


def _wp_rows(src: str = fx.PAGES, part: str = "partition_idx") -> str:
    return f"""
    SELECT {part} AS partition_idx, url_host_registered_domain AS domain, url_host_name AS hostname, url AS sample_url
    FROM ({fx.index(src)}) WHERE fetch_status = 200 AND content_mime_detected = 'text/html'
      AND (url_path LIKE '%/wp-json/%' OR url_path LIKE '%/wp-content/%' OR url_path LIKE '%/wp-includes/%'
           OR url_host_registered_domain = 'wordpress.com')"""


def _wp_first(src: str = fx.PAGES, part: str = "partition_idx", where: str = "true") -> str:
    return f"""
    SELECT DISTINCT * FROM ({_wp_rows(src, part)}) WHERE domain <> '' AND {where}
    QUALIFY row_number() OVER (PARTITION BY domain ORDER BY partition_idx, hostname, sample_url) = 1"""


ORACLES["wp_filter"] = _wp_rows()
ORACLES["wp_distinct"] = f"SELECT DISTINCT * FROM ({_wp_rows()})"
for _name, _src in (("wp_discover", fx.PAGES), ("wp_discover_bulk", fx.BULK_PAGES)):
    ORACLES[_name] = f"SELECT domain, hostname, sample_url FROM ({_wp_first(_src)}) ORDER BY domain"
ORACLES["wp_found_per_partition"] = f"""
    SELECT p.partition_idx, count(w.domain) AS candidates_found
    FROM (SELECT DISTINCT CAST(page_id % 4 AS INT) AS partition_idx FROM pages) p
    LEFT JOIN ({_wp_first()}) w USING (partition_idx) GROUP BY 1"""

# --- Disqus discovery ------------------------------------------------------


def _carried(src: str = fx.PAGES, file_idx: str = fx.EVERY_FOURTH) -> str:
    return f"""
    SELECT * FROM (
      SELECT file_idx, line_no, value, coalesce(last_value(
          CASE WHEN starts_with(value, 'WARC-Target-URI:') THEN trim(substr(value, 17)) END IGNORE NULLS)
          OVER (PARTITION BY file_idx ORDER BY line_no), '') AS target_uri
      FROM ({fx.wat_lines(src, file_idx)}))
    WHERE contains(value, 'disqus.com') AND NOT starts_with(value, 'WARC-Target-URI:')"""


def _hits(src: str = fx.PAGES, file_idx: str = fx.EVERY_FOURTH) -> str:
    host = "regexp_extract(target_uri, '^https://([^/?#:]+)', 1)"
    return f"""
    SELECT file_idx, line_no, {_registered('hostname')} AS domain, hostname, sample_url, disqus_shortname
    FROM (SELECT file_idx, line_no, {host} AS hostname, target_uri AS sample_url,
            {_shortname_case('((line_no - 1) // 2)')} AS disqus_shortname
          FROM ({_carried(src, file_idx)}))
    WHERE hostname <> '' AND disqus_shortname <> ''"""


def _first_hits(key: str, order: str, src: str = fx.PAGES, file_idx: str = fx.EVERY_FOURTH, where: str = "true") -> str:
    return f"""
    SELECT * FROM ({_hits(src, file_idx)}) WHERE {where}
    QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1"""


_CANDIDATE = "domain, hostname, sample_url, disqus_shortname"
ORACLES["wat_carry_forward"] = f"SELECT file_idx, line_no, target_uri FROM ({_carried()})"
ORACLES["disqus_per_file"] = f"SELECT file_idx, {_CANDIDATE} FROM ({_first_hits('file_idx, domain', 'line_no')})"
for _name, _src in (("disqus_discover", fx.PAGES), ("disqus_discover_bulk", fx.BULK_PAGES)):
    ORACLES[_name] = f"SELECT {_CANDIDATE} FROM ({_first_hits('domain', 'file_idx, line_no', _src)}) ORDER BY domain"

# --- manifests -------------------------------------------------------------


def _manifest(wanted: str, suspicious: bool = True) -> str:
    return f"""
    SELECT row_number() OVER (ORDER BY path) - 1 AS partition_idx, '{BASE}' || path AS partition_url,
      CAST(CASE WHEN contains(path, '''') THEN 1 ELSE 0 END AS BIGINT) AS suspicious
    FROM (SELECT trim(path) AS path FROM ({fx.manifest()})) WHERE path <> '' AND {wanted}"""


ORACLES["manifest_index"] = _manifest("contains(path, 'subset=warc/')")
ORACLES["manifest_wat"] = _manifest("path LIKE '%.warc.wat.gz'")
ORACLES["manifest_window"] = (
    f"SELECT * FROM ({_manifest(chr(112) + 'ath LIKE ' + chr(39) + '%.warc.wat.gz' + chr(39))}) WHERE partition_idx BETWEEN 3 AND 1002"
)

# --- tables ----------------------------------------------------------------

_KEYS = {
    "wp_candidates": "domain",
    "disqus_candidates": "domain",
    "results": "domain",
    "pages": "domain, post_id",
    "wp_scan_progress": "crawl, partition_idx",
}


def _visible(table: str) -> str:
    return f"SELECT * FROM ({LOGS[table]()}) WHERE batch_id IN (0, 1, 3, 4)"


def _table(table: str) -> str:
    way = "" if table.endswith("candidates") else "DESC"
    return f"""
    SELECT * EXCLUDE (batch_id, ordinal) FROM ({_visible(table)})
    QUALIFY row_number() OVER (PARTITION BY {_KEYS[table]} ORDER BY batch_id {way}, ordinal {way}) = 1"""


_WP, _DISQUS, _RESULTS = _table("wp_candidates"), _table("disqus_candidates"), _table("results")
_PAGES, _PROGRESS = _table("pages"), _table("wp_scan_progress")

ORACLES["visible_batches"] = _visible("wp_candidates")
ORACLES["insert_ignore"] = _WP
ORACLES["insert_ignore_disqus"] = _DISQUS
ORACLES["upsert_results"] = _RESULTS
ORACLES["upsert_pages"] = _PAGES
ORACLES["progress_upsert"] = _PROGRESS
ORACLES["progress_max"] = f"SELECT coalesce(max(partition_idx), -1) AS max_idx FROM ({_PROGRESS}) WHERE crawl = 'A'"
ORACLES["progress_max_new_crawl"] = (
    f"SELECT CAST(coalesce(max(partition_idx), -1) AS BIGINT) AS max_idx FROM ({_PROGRESS}) WHERE crawl = 'C'"
)
ORACLES["progress_count"] = f"SELECT count(*) AS cnt FROM ({_PROGRESS}) WHERE crawl = 'B'"
ORACLES["list_candidates"] = f"{_WP} ORDER BY domain"
ORACLES["list_disqus"] = f"{_DISQUS} ORDER BY domain"
ORACLES["list_results"] = f"{_RESULTS} ORDER BY comment_count_hint DESC, domain"
ORACLES["confirmed_results"] = (
    f"SELECT * FROM ({_RESULTS}) WHERE comments_endpoint = 1 ORDER BY comment_count_hint DESC, domain"
)
ORACLES["list_pages"] = f"SELECT * FROM ({_PAGES}) ORDER BY domain, comment_count_in_sample DESC, post_id"
ORACLES["report_sites"] = f"""
    SELECT domain, comment_count_hint, api_root FROM ({_RESULTS}) WHERE comments_endpoint = 1
    ORDER BY comment_count_hint DESC, domain LIMIT 30"""
ORACLES["report_pages"] = f"""
    SELECT domain, url, comment_count_in_sample, CASE WHEN strlen(title) > 60
        THEN left(title, list_max(list_filter(range(0, 58), lambda n: strlen(left(title, n)) <= 57))) || '...'
        ELSE title END AS title
    FROM (SELECT * FROM ({_PAGES}) ORDER BY domain, comment_count_in_sample DESC, post_id LIMIT 30)"""

_FILES = fx.crawl_files()
ORACLES["resume_slice"] = f"""
    WITH n AS (SELECT coalesce(max(partition_idx), -1) + 1 AS first FROM ({_PROGRESS}) WHERE crawl = 'B')
    SELECT partition_idx, partition_url FROM ({_FILES}), n WHERE partition_idx >= first AND partition_idx < first + 100"""
ORACLES["missing_partitions"] = (
    f"SELECT * FROM ({_FILES}) WHERE partition_idx NOT IN (SELECT partition_idx FROM ({_PROGRESS}) WHERE crawl = 'A')"
)
for _name, _found in (("unverified_wp", _WP), ("unverified_disqus", _DISQUS)):
    ORACLES[_name] = f"SELECT domain FROM ({_found}) EXCEPT SELECT domain FROM ({_RESULTS}) ORDER BY domain"


def _export(forums: str, wordpress: str, results: str) -> str:
    return f"""
    WITH forum_sites AS (FROM ({forums}) SELECT hostname, disqus_shortname, NULL::BIGINT AS comment_count_hint),
    open_sites AS (
        FROM ({results}) SELECT domain, comment_count_hint AS hint
        WHERE (wp_confirmed, comments_endpoint) = (1, 1) AND NOT comment_count_hint <= 1),
    blog_sites AS (
        FROM ({wordpress}) w SELECT hostname, NULL::VARCHAR AS disqus_shortname,
            (SELECT hint FROM open_sites o WHERE o.domain = w.domain) AS comment_count_hint
        WHERE domain IN (SELECT domain FROM open_sites))
    FROM forum_sites UNION ALL FROM blog_sites"""


ORACLES["export_rows"] = _export(_DISQUS, _WP, _RESULTS)
ORACLES["run_totals"] = f"""
    SELECT count(*) AS partitions, CAST(coalesce(sum(candidates_found), 0) AS BIGINT) AS candidates_saved,
      (SELECT count(*) FROM ({_WP})) AS unique_candidates FROM ({_PROGRESS})"""

# --- verification ----------------------------------------------------------


def _results(src: str = fx.PAGES) -> str:
    of = lambda column, kind: f"max({column}) FILTER (WHERE kind = '{kind}')"
    api = lambda column: f"coalesce(contains({column}, 'api.w.org'), false)"
    tls = "(contains(home_error, 'tls:') OR contains(home_error, 'certificate'))"
    return f"""
    WITH side AS (
      SELECT domain, {of('link_header', 'home_head')} AS head_link, {of('error', 'home_head')} AS head_error,
        {of('link_header', 'home_get')} AS get_link, {of('error', 'home_get')} AS get_error,
        {of('link_header', 'home_http_get')} AS http_link, {of('error', 'home_http_get')} AS http_error,
        {of('status', 'comments_probe')} AS probe_status, {of('x_wp_total', 'comments_probe')} AS probe_total,
        {of('body', 'comments_probe')} AS probe_body, {of('error', 'comments_probe')} AS probe_error
      FROM ({_captures(src)}) GROUP BY domain),
    home AS (
      SELECT *, coalesce(head_error, CASE WHEN NOT {api('head_link')} THEN get_error END) AS home_error,
        CASE WHEN {api('head_link')} THEN head_link ELSE get_link END AS link FROM side),
    root AS (
      SELECT *, CASE WHEN home_error IS NULL THEN CASE WHEN {api('link')} THEN {_root('link', 'domain')} ELSE '' END
          WHEN {tls} AND http_error IS NULL AND {api('http_link')} THEN 'http://' || domain || '/wp-json/' ELSE '' END AS api_root,
        CASE WHEN home_error IS NULL THEN 'no WordPress API header'
          WHEN NOT {tls} THEN home_error
          WHEN http_error IS NOT NULL THEN 'SSL error + fallback failed: ' || http_error
          ELSE 'SSL error, no WordPress API header' END AS root_error FROM home),
    probe AS (
      SELECT *, CASE WHEN probe_status = 200 AND regexp_full_match(probe_total, '[+-]?[0-9]+')
          THEN CAST(least(CAST(probe_total AS HUGEINT), 9223372036854775807) AS BIGINT) ELSE 0 END AS total FROM root),
    judged AS (
      SELECT *, CASE WHEN api_root = '' THEN root_error
        WHEN probe_error IS NOT NULL THEN probe_error
        WHEN probe_status = 401 THEN 'comments endpoint requires auth'
        WHEN probe_status = 403 THEN 'comments endpoint forbidden'
        WHEN probe_status <> 200 THEN 'HTTP ' || CAST(probe_status AS VARCHAR)
        WHEN NOT json_valid(probe_body) THEN 'invalid JSON'
        WHEN json_type(probe_body) <> 'ARRAY' THEN 'invalid comments response'
        WHEN json_array_length(probe_body) = 0 AND total = 0 THEN 'no comments'
        ELSE '' END AS fault FROM probe)
    SELECT d.domain, CAST(api_root <> '' AS BIGINT) AS wp_confirmed, CAST(api_root <> '' AND fault = '' AS BIGINT) AS comments_endpoint,
      CASE WHEN api_root <> '' THEN total ELSE 0 END AS comment_count_hint, api_root, fault AS error
    FROM ({fx.domains(src)}) d JOIN judged USING (domain)"""


def _per_post(src: str = fx.PAGES) -> str:
    return f"""
    SELECT domain, CAST(post AS BIGINT) AS post_id, count(*) AS comment_count_in_sample
    FROM (SELECT domain, unnest(posts) AS post FROM (
        SELECT domain, json_extract(body, '$[*].post') AS posts FROM ({_captures(src)})
        WHERE kind = 'comments_sample' AND status = 200 AND error IS NULL)
      WHERE len(list_filter(posts, lambda p: json_type(p) NOT IN ('UBIGINT', 'BIGINT'))) = 0)
    WHERE CAST(post AS BIGINT) > 0 GROUP BY 1, 2"""


def _top(n: int, src: str = fx.PAGES) -> str:
    return f"""
    SELECT * FROM ({_per_post(src)})
    QUALIFY row_number() OVER (PARTITION BY domain ORDER BY comment_count_in_sample DESC, post_id) <= {n}"""


def _pages(src: str = fx.PAGES) -> str:
    return f"""
    SELECT t.domain, t.post_id, p.link AS url, p.title, t.comment_count_in_sample
    FROM ({_top(10, src)}) t JOIN ({_POST.format(captures=_captures(src))}) p ON p.domain = t.domain AND p.post_id = t.post_id
    WHERE p.readable AND p.status = 200 AND p.error IS NULL
      AND t.domain IN (SELECT domain FROM ({_results(src)}) WHERE comments_endpoint = 1)"""


ORACLES["verify_results"] = _results()
ORACLES["verify_results_bulk"] = _results(fx.BULK_PAGES)
ORACLES["comments_per_post"] = _per_post()
ORACLES["top_posts"] = _top(3)
ORACLES["verify_pages"] = _pages()
ORACLES["verify_pages_bulk"] = _pages(fx.BULK_PAGES)
ORACLES["verify_totals"] = f"""
    SELECT count(*) AS domains, count(*) FILTER (WHERE comments_endpoint = 1) AS with_comments,
      (SELECT count(*) FROM ({_pages()})) AS pages_found FROM ({_results()})"""

# --- whole runs ------------------------------------------------------------

_FIRST_RUN, _SECOND_RUN = "partition_idx < 2", "partition_idx >= 2"
_RUN_FILES = f"SELECT DISTINCT {fx.RUNS_OF_64} AS partition_idx FROM pages"
ORACLES["discover_wp_run"] = f"SELECT domain, hostname, sample_url FROM ({_wp_first(part=fx.RUNS_OF_64)})"
ORACLES["discover_wp_progress"] = f"""
    SELECT 'A' AS crawl, f.partition_idx, count(w.domain) AS candidates_found FROM ({_RUN_FILES}) f
    LEFT JOIN (({_wp_first(part=fx.RUNS_OF_64, where=_FIRST_RUN)}) UNION ALL ({_wp_first(part=fx.RUNS_OF_64, where=_SECOND_RUN)})) w
      USING (partition_idx) GROUP BY 1, 2"""
ORACLES["discover_disqus_run"] = (
    f"SELECT {_CANDIDATE} FROM ({_first_hits('domain', 'file_idx, line_no', file_idx=fx.RUNS_OF_64)})"
)
ORACLES["incremental_disqus"] = ORACLES["discover_disqus_run"]
ORACLES["incremental_disqus_batches"] = ORACLES["discover_disqus_run"]
ORACLES["snapshot_results"] = ORACLES["concurrent_commits"] = ORACLES["upsert_results"]
ORACLES["snapshot_candidates"] = ORACLES["insert_ignore"]
ORACLES["two_crawls_stream"] = f"""
    SELECT {_CANDIDATE} FROM (
        SELECT 0 AS crawl, * FROM ({_hits(file_idx=fx.RUNS_OF_64)}) UNION ALL
        SELECT 1, * FROM ({_hits(fx.OTHER_PAGES, fx.RUNS_OF_64)}))
    QUALIFY row_number() OVER (PARTITION BY domain ORDER BY crawl, file_idx, line_no) = 1"""
ORACLES["scan_outcomes"] = f"""
    WITH counted AS (
        SELECT f.partition_idx, count(w.domain) AS n FROM ({_RUN_FILES}) f
        LEFT JOIN ({_wp_first(part=fx.RUNS_OF_64)}) w USING (partition_idx) GROUP BY 1)
    SELECT partition_idx, n AS candidates_found, CASE WHEN n = 0 THEN 'empty' ELSE 'ok' END AS status FROM counted UNION ALL
    SELECT (SELECT max(partition_idx) FROM counted) + i, 0, CASE WHEN i = 3 THEN 'suspicious' ELSE 'failed' END
    FROM (SELECT unnest([1, 2, 3]) AS i)"""
ORACLES["discover_disqus_progress"] = f"""
    SELECT 'A' AS crawl, f.partition_idx, count(w.domain) AS candidates_found FROM ({_RUN_FILES}) f
    LEFT JOIN ({_first_hits('file_idx, domain', 'line_no', file_idx=fx.RUNS_OF_64)}) w ON w.file_idx = f.partition_idx GROUP BY 1, 2"""
ORACLES["verify_run"] = ORACLES["verify_results"]
ORACLES["verify_run_pages"] = ORACLES["late_captures_run"] = ORACLES["verify_pages"]
_SEEDED = f"SELECT domain, domain AS hostname FROM ({fx.domains()})"
ORACLES["export_run"] = _export(ORACLES["disqus_discover"], _SEEDED, _results())
_VERIFIED = f"SELECT domain, length(domain) % 2 = 0 AS even FROM ({_wp_first(part=fx.RUNS_OF_64)})"
ORACLES["discover_and_verify_run"] = f"""
    SELECT domain, even::BIGINT AS wp_confirmed, even::BIGINT AS comments_endpoint, 5 * even::BIGINT AS comment_count_hint,
      CASE WHEN even THEN 'https://x/wp-json/' ELSE '' END AS api_root, CASE WHEN even THEN '' ELSE 'timeout' END AS error
    FROM ({_VERIFIED})"""
ORACLES["discover_and_verify_pages"] = f"""
    SELECT domain, post_id::BIGINT AS post_id, 'https://' || domain || '/p' || post_id AS url, 'Title' AS title, post_id::BIGINT AS comment_count_in_sample
    FROM ({_VERIFIED}), (SELECT unnest([1, 2]) AS post_id) WHERE even"""
ORACLES["stream_outcomes"] = f"""
    WITH counted AS (
        SELECT f.partition_idx, count(w.domain) AS n FROM ({_RUN_FILES}) f
        LEFT JOIN ({_first_hits('file_idx, domain', 'line_no', file_idx=fx.RUNS_OF_64)}) w ON w.file_idx = f.partition_idx GROUP BY 1)
    SELECT partition_idx, n AS candidates_found, CASE WHEN n = 0 THEN 'empty' ELSE 'ok' END AS status FROM counted UNION ALL
    SELECT (SELECT max(partition_idx) FROM counted) + i, 0, CASE i WHEN 1 THEN 'failed' WHEN 2 THEN 'empty' ELSE 'missing' END
    FROM (SELECT unnest([1, 2, 3]) AS i)"""
ORACLES["disqus_json_any_case"] = f"SELECT page_id, expected AS disqus_shortname FROM ({fx.json_variants()})"
ORACLES["post_fields_repeated_keys"] = f"SELECT page_id, link, title FROM ({fx.repeated_keys()})"
ORACLES["probe_repeated_keys"] = f"SELECT page_id::VARCHAR AS domain, fault FROM ({fx.repeated_keys()})"
ORACLES["sample_repeated_keys"] = """
    SELECT page_id::VARCHAR AS domain, (page_id % 5 + 1)::BIGINT AS post_id, 1::BIGINT AS comment_count_in_sample FROM pages WHERE page_id % 3 = 0 UNION ALL
    SELECT page_id::VARCHAR, 9, page_id % 3 // 2 + 1 FROM pages WHERE page_id % 3 <> 1"""
ORACLES["stored_captures_run"] = ORACLES["verify_pages"]
ORACLES["link_lines"] = """
    SELECT page_id, CASE WHEN page_id % 6 = 2 THEN '7' ELSE '9' END AS x_wp_total,
      CASE page_id % 6 WHEN 1 THEN 'https://a' || page_id || '.org/wp-json/' WHEN 3 THEN 'https://c' || page_id || '.org/wp-json/'
        WHEN 4 THEN 'https://p' || page_id || '/wp-json/' END AS first_root,
      CASE page_id % 6 WHEN 0 THEN 'https://r' || page_id || '.org/wp-json/' WHEN 1 THEN 'https://a' || page_id || '.org/wp-json/'
        WHEN 3 THEN 'https://c' || page_id || '.org/wp-json/' WHEN 4 THEN 'https://d' || page_id || '.org/wp-json/'
        WHEN 5 THEN 'https://e' || page_id || '.org/wp-json/' END AS any_root
    FROM pages"""
