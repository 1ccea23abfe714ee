"""Check queries: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.workspace import new_folder, write_index_files, write_wat_files
from talkscout.functions import documents, responses, urls
from talkscout.operators import disqus, report, tables, verify, wordpress
from talkscout.plans.discovery import discover_disqus, discover_wordpress
from talkscout.plans.store import KEYS, TABLES, Store
from talkscout.plans.verification import discover_and_verify, export, verify_domains, verify_wordpress
from talkscout.sources.captures import Captures, captures_of_responses
from talkscout.sources.manifest import index_files, read_manifest, wat_files, window_of
from talkscout.streaming.arrivals import stream_disqus

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

PROGRESS = ["crawl", "partition_idx", "partition_url", "candidates_found"]
COLUMNS = {
    **{t: [f.split()[0] for f in ddl.split(", ")] for t, ddl in TABLES.items()},
    "wp_scan_progress": PROGRESS,
}
LOGS = {
    "wp_candidates": fx.wp_log,
    "disqus_candidates": fx.disqus_log,
    "results": fx.results_log,
    "pages": fx.pages_log,
    "wp_scan_progress": fx.progress_log,
}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def on(sql: str, fn: Callable[[DataFrame], DataFrame]) -> Query:
    """A query that applies an operator to one fixture."""
    return lambda spark, sf_dir: fn(fx.spark_sql(spark, sf_dir, sql))


# --- functions -------------------------------------------------------------


@query
def registered_domain(spark, sf_dir):
    df = fx.spark_sql(spark, sf_dir, fx.url_variants())
    host = urls.url_host(F.col("url"))
    return df.select("page_id", urls.registered_domain(host).alias("domain"))


@query
def url_host(spark, sf_dir):
    df = fx.spark_sql(spark, sf_dir, fx.url_variants())
    return df.select("page_id", urls.url_host(F.col("url")).alias("host"))


@query
def disqus_shortname(spark, sf_dir):
    df = fx.spark_sql(spark, sf_dir, fx.forum_links())
    link = F.col("link")
    return df.select(
        "page_id", urls.forum_from_script(link).alias("from_script"), urls.forum_from_link(link).alias("from_link")
    )


@query
def disqus_json_extract(spark, sf_dir):
    df = fx.spark_sql(spark, sf_dir, fx.wat_lines())
    return documents.with_forum(df, "value", "disqus_shortname").select("line_no", "disqus_shortname")


@query
def disqus_json_any_case(spark, sf_dir):
    """Keys in odd case, and repeated ones."""
    df = fx.spark_sql(spark, sf_dir, fx.json_variants())
    return documents.with_forum(df, "value", "disqus_shortname").select("page_id", "disqus_shortname")


@query
def post_fields_repeated_keys(spark, sf_dir):
    df = fx.spark_sql(spark, sf_dir, fx.repeated_keys())
    post = documents.post_fields(F.col("post_body"))
    return df.select("page_id", post["link"].alias("link"), post["title"].alias("title"))


def _captured(df: DataFrame, kind: str, body: str) -> DataFrame:
    text = F.lit(None).cast("string")
    return df.select(
        F.col("page_id").cast("string").alias("domain"), F.lit(kind).alias("kind"), F.lit(None).cast("bigint").alias("post_id"), F.lit(200).alias("status"),
        text.alias("link_header"), F.lit("3").alias("x_wp_total"), F.col(body).alias("body"), text.alias("error"),
    )


@query
def probe_repeated_keys(spark, sf_dir):
    df = fx.spark_sql(spark, sf_dir, fx.repeated_keys())
    return verify.capture_facts(_captured(df, "comments_probe", "probe_body")).select("domain", "fault")


@query
def sample_repeated_keys(spark, sf_dir):
    df = fx.spark_sql(spark, sf_dir, fx.repeated_keys())
    return verify.comments_per_post(_captured(df, "comments_sample", "sample_body"))


@query
def link_lines(spark, sf_dir):
    """API roots of responses with several Link lines: by the first line, and by all lines."""
    lines = fx.spark_sql(spark, sf_dir, fx.header_lines())
    headers = F.sort_array(F.collect_list(F.struct("line_no", "name", "value"))).alias("headers")
    text = F.lit(None).cast("string")
    responses_of = lines.groupBy("page_id").agg(headers).select(
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("domain"), F.lit("home_head").alias("kind"),
        F.col("page_id").alias("post_id"), F.lit(200).alias("status"), "headers", text.alias("body"), text.alias("error"),
    )

    def roots(all_lines: bool, name: str) -> DataFrame:
        link = F.coalesce("link_header", F.lit(""))
        root = responses.api_root(link, F.concat(F.lit("https://"), F.col("domain")))
        found = F.when(responses.names_api(link), root).alias(name)
        return captures_of_responses(responses_of, all_lines).select(F.col("post_id").alias("page_id"), "x_wp_total", found)

    return roots(False, "first_root").join(roots(True, "any_root").drop("x_wp_total"), "page_id")


@query
def comment_total(spark, sf_dir):
    df = fx.spark_sql(spark, sf_dir, fx.error_texts())
    return df.select("page_id", responses.comment_total(F.col("x_wp_total")).alias("total"))


@query
def tls_errors(spark, sf_dir):
    df = fx.spark_sql(spark, sf_dir, fx.error_texts())
    return df.select("page_id", responses.flag(responses.is_tls_error(F.col("error"))).alias("tls"))


@query
def api_roots(spark, sf_dir):
    df = fx.spark_sql(spark, sf_dir, fx.captures()).where("kind IN ('home_head', 'home_get')")
    root = responses.api_root(F.col("link_header"), F.concat(F.lit("https://"), F.col("domain")))
    return df.where("link_header LIKE '%api.w.org%'").select(
        "domain", "kind", root.alias("api_root"), responses.comments_url(root, 100).alias("comments_url")
    )


@query
def post_titles(spark, sf_dir):
    df = fx.spark_sql(spark, sf_dir, fx.captures()).where("kind = 'post'")
    post = documents.post_fields(F.col("body"))
    return df.select("domain", "post_id", post["link"].alias("link"), post["title"].alias("title"))


@query
def homepage_disqus(spark, sf_dir):
    df = fx.spark_sql(spark, sf_dir, fx.home_html())
    return df.select("page_id", urls.forum_from_html(F.col("html")).alias("disqus_shortname"))


# --- WordPress discovery ---------------------------------------------------

QUERIES["wp_filter"] = on(fx.index(), wordpress.wordpress_rows)
QUERIES["wp_distinct"] = on(fx.index(), lambda df: wordpress.distinct_rows(wordpress.wordpress_rows(df)))
QUERIES["wp_discover"] = on(fx.index(), wordpress.discover)
QUERIES["wp_discover_bulk"] = on(fx.index(fx.BULK_PAGES), wordpress.discover)


@query
def wp_found_per_partition(spark, sf_dir):
    index = fx.spark_sql(spark, sf_dir, fx.index())
    winners = wordpress.first_per_domain(wordpress.candidate_rows(index))
    return wordpress.found_per_partition(winners, index.select("partition_idx").distinct())


# --- Disqus discovery ------------------------------------------------------

QUERIES["wat_carry_forward"] = on(
    fx.wat_lines(), lambda df: disqus.carry_forward(df).select("file_idx", "line_no", "target_uri")
)
QUERIES["disqus_per_file"] = on(
    fx.wat_lines(),
    lambda df: disqus.first_per_file(disqus.line_hits(disqus.forum_lines(df))).select("file_idx", *disqus.CANDIDATE),
)
QUERIES["disqus_discover"] = on(fx.wat_lines(), disqus.discover)
QUERIES["disqus_discover_bulk"] = on(fx.wat_lines(fx.BULK_PAGES), disqus.discover)


# --- manifests -------------------------------------------------------------


def _files(df: DataFrame) -> DataFrame:
    return df.select("partition_idx", "partition_url", responses.flag(F.col("suspicious")).alias("suspicious"))


QUERIES["manifest_index"] = on(fx.manifest(), lambda df: _files(index_files(df)))
QUERIES["manifest_wat"] = on(fx.manifest(), lambda df: _files(wat_files(df)))
QUERIES["manifest_window"] = on(fx.manifest(), lambda df: _files(window_of(wat_files(df), 3, 1000)))


# --- tables ----------------------------------------------------------------


def _log(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Visible history of a table."""
    log = fx.spark_sql(spark, sf_dir, LOGS[table]())
    return tables.visible(log, fx.spark_sql(spark, sf_dir, fx.commits()))


def _table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    view = tables.first_wins if table.endswith("candidates") else tables.last_wins
    return view(_log(spark, sf_dir, table), KEYS[table], COLUMNS[table])


def table_query(table: str, fn: Callable[[DataFrame], DataFrame] = lambda df: df) -> Query:
    return lambda spark, sf_dir: fn(_table(spark, sf_dir, table))


QUERIES["visible_batches"] = lambda spark, sf_dir: _log(spark, sf_dir, "wp_candidates")
QUERIES["insert_ignore"] = table_query("wp_candidates")
QUERIES["insert_ignore_disqus"] = table_query("disqus_candidates")
QUERIES["upsert_results"] = table_query("results")
QUERIES["upsert_pages"] = table_query("pages")
QUERIES["progress_upsert"] = table_query("wp_scan_progress")
QUERIES["progress_max"] = table_query("wp_scan_progress", lambda p: tables.max_partition(p, "A"))
QUERIES["progress_max_new_crawl"] = table_query("wp_scan_progress", lambda p: tables.max_partition(p, "C"))
QUERIES["progress_count"] = table_query("wp_scan_progress", lambda p: tables.partition_count(p, "B"))
QUERIES["list_candidates"] = table_query("wp_candidates", tables.list_candidates)
QUERIES["list_disqus"] = table_query("disqus_candidates", tables.list_candidates)
QUERIES["list_results"] = table_query("results", tables.list_results)
QUERIES["confirmed_results"] = table_query("results", tables.confirmed_results)
QUERIES["list_pages"] = table_query("pages", tables.list_pages)
QUERIES["report_sites"] = table_query("results", report.report_sites)
QUERIES["report_pages"] = table_query("pages", report.report_pages)


def _crawl_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files per page, more than were scanned so far."""
    return fx.spark_sql(spark, sf_dir, fx.crawl_files())


@query
def resume_slice(spark, sf_dir):
    files, progress = _crawl_files(spark, sf_dir), _table(spark, sf_dir, "wp_scan_progress")
    return window_of(files, tables.resume_offset(progress, "B"), 100)


@query
def missing_partitions(spark, sf_dir):
    files, progress = _crawl_files(spark, sf_dir), _table(spark, sf_dir, "wp_scan_progress")
    return tables.missing_partitions(files, progress, "A")


@query
def unverified_wp(spark, sf_dir):
    return tables.unverified(_table(spark, sf_dir, "wp_candidates"), _table(spark, sf_dir, "results"))


@query
def unverified_disqus(spark, sf_dir):
    return tables.unverified(_table(spark, sf_dir, "disqus_candidates"), _table(spark, sf_dir, "results"))


@query
def export_rows(spark, sf_dir):
    return report.export_rows(*(_table(spark, sf_dir, t) for t in ("disqus_candidates", "wp_candidates", "results")))


@query
def run_totals(spark, sf_dir):
    return report.run_totals(_table(spark, sf_dir, "wp_scan_progress"), _table(spark, sf_dir, "wp_candidates"))


# --- verification ----------------------------------------------------------


def _verification(spark, sf_dir, src=fx.PAGES) -> tuple[DataFrame, DataFrame]:
    return fx.spark_sql(spark, sf_dir, fx.domains(src)), fx.spark_sql(spark, sf_dir, fx.captures(src))


@query
def verify_results(spark, sf_dir):
    return verify.verify_results(*_verification(spark, sf_dir))


@query
def verify_results_bulk(spark, sf_dir):
    return verify.verify_results(*_verification(spark, sf_dir, fx.BULK_PAGES))


@query
def comments_per_post(spark, sf_dir):
    return verify.comments_per_post(_verification(spark, sf_dir)[1])


@query
def top_posts(spark, sf_dir):
    return verify.top_posts(verify.comments_per_post(_verification(spark, sf_dir)[1]), 3)


@query
def verify_pages(spark, sf_dir):
    return verify.verify_all(*_verification(spark, sf_dir))[1]


@query
def verify_pages_bulk(spark, sf_dir):
    return verify.verify_all(*_verification(spark, sf_dir, fx.BULK_PAGES))[1]


@query
def verify_totals(spark, sf_dir):
    return verify.verify_totals(*verify.verify_all(*_verification(spark, sf_dir)))


# --- whole runs over files and a store -------------------------------------


def _index_run(spark: SparkSession, sf_dir: str) -> tuple[Store, DataFrame]:
    """A store and the index files of a crawl with 64 pages per file."""
    folder = new_folder(spark)
    rows = fx.spark_sql(spark, sf_dir, fx.index()).withColumn("part", F.expr(fx.RUNS_OF_64))
    manifest = write_index_files(rows.drop("page_id", "partition_idx"), folder)
    files = index_files(read_manifest(spark, manifest), f"{folder}/index/")
    return Store(spark, f"{folder}/store"), files


def _wat_files(spark: SparkSession, sf_dir: str, src: str = fx.PAGES) -> tuple[str, DataFrame]:
    """Folder and files of a crawl with 64 pages per file."""
    folder = new_folder(spark)
    lines = fx.spark_sql(spark, sf_dir, fx.wat_lines(src, fx.RUNS_OF_64))
    manifest = write_wat_files(lines, folder)
    return folder, wat_files(read_manifest(spark, manifest), f"{folder}/wat/", ".txt.gz")


def _wat_run(spark: SparkSession, sf_dir: str) -> tuple[Store, str, DataFrame]:
    folder, files = _wat_files(spark, sf_dir)
    return Store(spark, f"{folder}/store"), folder, files


@query
def discover_wp_run(spark, sf_dir):
    """Two files, then the rest on resume."""
    store, files = _index_run(spark, sf_dir)
    discover_wordpress(store, files, "A", partitions=2)
    discover_wordpress(store, files, "A", partitions=None, resume=True)
    return store.table("wp_candidates")


@query
def discover_wp_progress(spark, sf_dir):
    store, files = _index_run(spark, sf_dir)
    discover_wordpress(store, files, "A", partitions=2)
    discover_wordpress(store, files, "A", partitions=None, resume=True)
    return store.table("wp_scan_progress").select("crawl", "partition_idx", "candidates_found")


@query
def discover_disqus_run(spark, sf_dir):
    store, _, files = _wat_run(spark, sf_dir)
    discover_disqus(store, files, "A", partitions=1)
    discover_disqus(store, files, "A", partitions=None, resume=True)
    return store.table("disqus_candidates")


@query
def discover_disqus_progress(spark, sf_dir):
    store, _, files = _wat_run(spark, sf_dir)
    discover_disqus(store, files, "A", partitions=None)
    return store.table("disqus_scan_progress").select("crawl", "partition_idx", "candidates_found")


@query
def scan_outcomes(spark, sf_dir):
    """Progress of a crawl that also lists a missing file, one that is no Parquet file, and a suspicious name."""
    folder = new_folder(spark)
    rows = fx.spark_sql(spark, sf_dir, fx.index()).withColumn("part", F.expr(fx.RUNS_OF_64))
    manifest = read_manifest(spark, write_index_files(rows.drop("page_id", "partition_idx"), folder))
    broken = f"{folder}/index/subset=warc/zz2"
    spark.range(3).select(F.col("id").cast("string").alias("value")).coalesce(1).write.text(broken)
    name = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(broken).select(F.element_at(F.split("path", "/"), -1))
    others = name.select(F.concat(F.lit("subset=warc/zz2/"), name[0]).alias("path"))
    for path in ("subset=warc/zz1-missing", "subset=warc/zz3-it's"):
        others = others.union(spark.range(1).select(F.lit(path)))
    store = Store(spark, f"{folder}/store")
    discover_wordpress(store, index_files(manifest.union(others), f"{folder}/index/"), "A")
    return store.table("wp_scan_progress").select("partition_idx", "candidates_found", "status")


def _stream(store: Store, folder: str, files: DataFrame, crawl: str, files_per_batch: int = 1_000_000) -> None:
    stream = stream_disqus(store, f"{folder}/wat", files, f"{folder}/progress", crawl, files_per_batch=files_per_batch, suffix=".txt.gz")
    stream.awaitTermination()


@query
def incremental_disqus(spark, sf_dir):
    """Arriving files as a stream."""
    store, folder, files = _wat_run(spark, sf_dir)
    _stream(store, folder, files, "A")
    return store.table("disqus_candidates")


@query
def incremental_disqus_batches(spark, sf_dir):
    """Arriving files, three to a micro-batch, in the order of their dates: the lowest partition wins all the same."""
    store, folder, files = _wat_run(spark, sf_dir)
    _stream(store, folder, files, "A", files_per_batch=3)
    return store.table("disqus_candidates")


@query
def stream_outcomes(spark, sf_dir):
    """Statuses of a stream, three files to a micro-batch, over a crawl with a broken file, an empty one and one that never comes."""
    folder = new_folder(spark)
    manifest = read_manifest(spark, write_wat_files(fx.spark_sql(spark, sf_dir, fx.wat_lines(fx.PAGES, fx.RUNS_OF_64)), folder))
    store = Store(spark, f"{folder}/store")
    for name, text in (("part=zz1/0.txt.gz", "no gzip at all, " * 10), ("part=zz2/0.txt.gz", ""), ("part=zz3/0.txt.gz", None)):
        manifest = manifest.union(spark.range(1).select(F.lit(name)))
        if text is not None:
            store.files.create(f"{folder}/wat/{name}", text)
    files = wat_files(manifest, f"{folder}/wat/", ".txt.gz")
    _stream(store, folder, files, "A", files_per_batch=3)
    done = store.table("disqus_scan_progress").select("partition_idx", "candidates_found", "status")
    missing = tables.missing_partitions(files, store.table("disqus_scan_progress"), "A")
    return done.unionByName(missing.select("partition_idx", F.lit(0).cast("bigint").alias("candidates_found"), F.lit("missing").alias("status")))


def _committed(spark: SparkSession, sf_dir: str, table: str) -> list[DataFrame]:
    """The fixture's batches in the order of their commits; number 2 never was committed."""
    log = fx.spark_sql(spark, sf_dir, LOGS[table]())
    return [log.where(F.col("batch_id") == number).drop("batch_id") for number in (0, 1, 3, 4)]


def snapshot_query(table: str) -> Query:
    """A table compacted between its commits, and what was superseded deleted."""

    def run(spark, sf_dir):
        store = Store(spark, f"{new_folder(spark)}/store", buckets=8)
        for i, rows in enumerate(_committed(spark, sf_dir, table)):
            (batch,) = store.new_batches()
            store.append(table, rows, batch)
            store.commit([batch])
            if i < 3:
                store.compact(table)
        store.vacuum(grace_seconds=0)
        return store.table(table)

    return run


QUERIES["snapshot_results"] = snapshot_query("results")
QUERIES["snapshot_candidates"] = snapshot_query("wp_candidates")


@query
def concurrent_commits(spark, sf_dir):
    """Two drivers that commit to one store at once, each for its own half of the domains."""
    root, failed = f"{new_folder(spark)}/store", []

    def write(half: int) -> None:
        try:
            store = Store(spark, root)
            for rows in _committed(spark, sf_dir, "results"):
                (batch,) = store.new_batches()
                store.append("results", rows.where(F.pmod(F.length("domain"), F.lit(2)) == half), batch)
                store.commit([batch])
        except Exception as error:  # raised in the caller's thread below
            failed.append(error)

    writers = [threading.Thread(target=write, args=(half,)) for half in (0, 1)]
    for writer in writers:
        writer.start()
    for writer in writers:
        writer.join()
    if failed:
        raise failed[0]
    return Store(spark, root).table("results")


@query
def two_crawls_stream(spark, sf_dir):
    """Two streams into one store; the first one's rows are kept."""
    store, folder, files = _wat_run(spark, sf_dir)
    _stream(store, folder, files, "A")
    _stream(store, *_wat_files(spark, sf_dir, fx.OTHER_PAGES), "B")
    store.compact("disqus_candidates")
    return store.table("disqus_candidates")


@query
def verify_run(spark, sf_dir):
    store, captures = _seeded_store(spark, sf_dir)
    verify_wordpress(store, captures)
    return store.table("results")


@query
def verify_run_pages(spark, sf_dir):
    store, captures = _seeded_store(spark, sf_dir)
    verify_wordpress(store, captures)
    return store.table("pages")


@query
def stored_captures_run(spark, sf_dir):
    """Captures in buckets of domains, of which each run reads those of its work list: half of the domains, then the others."""
    store, captures = _seeded_store(spark, sf_dir)
    stored = Captures(spark, f"{store.root}/captures", buckets=4)
    stored.append(captures)
    half = store.table("wp_candidates").where(F.pmod(F.length("domain"), F.lit(2)) == 0)
    verify_domains(store, half, stored)
    verify_wordpress(store, stored)
    return store.table("pages")


@query
def late_captures_run(spark, sf_dir):
    """Home pages first; probes, samples and posts are captured later, and a second run completes the domains."""
    store, captures = _seeded_store(spark, sf_dir)
    verify_wordpress(store, captures.where("kind LIKE 'home%'"))
    verify_wordpress(store, captures.where("kind NOT IN ('comments_sample', 'post')"))
    verify_wordpress(store, captures)
    return store.table("pages")


def _seeded_store(spark: SparkSession, sf_dir: str) -> tuple[Store, DataFrame]:
    """A store whose WordPress candidates are the fixture's domains, and the captures."""
    store = Store(spark, f"{new_folder(spark)}/store")
    domains, captures = _verification(spark, sf_dir)
    (batch,) = store.new_batches()
    rows = domains.select(
        F.col("page_id").alias("ordinal"), "domain", F.col("domain").alias("hostname"), F.lit("").alias("sample_url")
    )
    store.append("wp_candidates", rows, batch)
    store.commit([batch])
    return store, captures


@query
def export_run(spark, sf_dir):
    """Disqus and WordPress sites of one store."""
    store, captures = _seeded_store(spark, sf_dir)
    verify_wordpress(store, captures)
    (batch,) = store.new_batches()
    found = QUERIES["disqus_discover"](spark, sf_dir)
    store.append("disqus_candidates", found.withColumn("ordinal", F.lit(0).cast("bigint")), batch)
    store.commit([batch])
    export(store, f"{store.root}/export")
    return spark.read.parquet(f"{store.root}/export")


def _discovered_and_verified(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Discovery, then verification of every candidate; domains of odd length time out."""
    store, files = _index_run(spark, sf_dir)
    return discover_and_verify(store, files, fx.spark_sql(spark, sf_dir, fx.discovered_captures()), "A")


@query
def discover_and_verify_run(spark, sf_dir):
    return _discovered_and_verified(spark, sf_dir)[0]


@query
def discover_and_verify_pages(spark, sf_dir):
    return _discovered_and_verified(spark, sf_dir)[1]
