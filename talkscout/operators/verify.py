"""Verification of domains from captured HTTP responses.

`http_captures` has one row per request made for a domain:

    domain, kind, post_id, status, link_header, x_wp_total, body, error

with kind one of home_head, home_get, home_http_get (the two home-page requests and
the plain-HTTP one), comments_probe (one comment per page), comments_sample (100 per
page) and post. `error` is NULL for a request that completed; link_header holds the
first Link line only.

Bodies are parsed where they are scanned and are never shuffled: only a few short
fields per capture go on to the aggregation by domain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkscout.functions.documents import is_json, post_fields, sampled_posts
from talkscout.functions.responses import (
    API_ENDPOINT,
    api_root,
    comment_total,
    flag,
    is_tls_error,
    names_api,
)
from talkscout.functions.urls import trim_space

CAPTURES_SCHEMA = (
    "domain STRING, kind STRING, post_id BIGINT, status INT, link_header STRING, "
    "x_wp_total STRING, body STRING, error STRING"
)
RESULT = ["domain", "wp_confirmed", "comments_endpoint", "comment_count_hint", "api_root", "error"]
PAGE = ["domain", "post_id", "url", "title", "comment_count_in_sample"]

# Fixed value: most-commented posts kept per domain.
MAX_PAGES = 10

# Error texts of results.
NO_API = "no WordPress API header"
FALLBACK_FAILED = "SSL error + fallback failed: "
FALLBACK_NO_API = "SSL error, no WordPress API header"
NEEDS_AUTH = "comments endpoint requires auth"
FORBIDDEN = "comments endpoint forbidden"
OTHER_STATUS = "HTTP "
INVALID_JSON = "invalid JSON"
NO_LIST = "invalid comments response"
NO_COMMENTS = "no comments"

# Error text of a domain, or a request of it, that has no capture.
NOT_CAPTURED = "not captured"


def _body_error(body: Column, total: Column) -> Column:
    """What is wrong with a comment listing, or ''."""
    text = F.coalesce(body, F.lit(""))
    is_list = trim_space(text).startswith("[")
    return (
        F.when(~is_json(text), INVALID_JSON)
        .when(~is_list, NO_LIST)
        .when((F.json_array_length(text) == 0) & (total == 0), NO_COMMENTS)
        .otherwise("")
    )


def capture_facts(captures: DataFrame) -> DataFrame:
    """Short facts of the home-page and probe captures: (domain, kind, error, link, total, fault).

    `fault` is the error text of a completed comment probe, '' when it is fine.
    """
    status = F.col("status")
    is_probe = F.col("kind") == "comments_probe"
    answered = is_probe & F.col("error").isNull()
    total = comment_total(F.coalesce("x_wp_total", F.lit("")))
    fault = (
        F.when(status == 200, _body_error(F.col("body"), total))
        .when(status == 401, NEEDS_AUTH)
        .when(status == 403, FORBIDDEN)
        .otherwise(F.concat(F.lit(OTHER_STATUS), F.coalesce(status.cast("string"), F.lit("0"))))
    )
    return captures.where(
        F.col("kind").isin("home_head", "home_get", "home_http_get", "comments_probe")
    ).select(
        "domain",
        "kind",
        "error",
        F.when(~is_probe, F.coalesce("link_header", F.lit(""))).alias("link"),
        F.when(answered & (status == 200), total).otherwise(F.lit(0)).alias("total"),
        F.when(answered, fault).alias("fault"),
    )


def domain_facts(facts: DataFrame) -> DataFrame:
    """One row per domain with its captures side by side; NULL for a request not captured."""
    of = lambda kind: F.max(F.when(F.col("kind") == kind, F.struct("error", "link", "total", "fault"))).alias(kind)
    return facts.groupBy("domain").agg(
        of("home_head"), of("home_get"), of("home_http_get"), of("comments_probe")
    )


def _failure(capture: str) -> Column:
    """Error of a request, '' when it completed."""
    return F.when(F.col(capture).isNull(), NOT_CAPTURED).otherwise(
        F.coalesce(F.col(capture)["error"], F.lit(""))
    )


def choose_home_response(df: DataFrame) -> DataFrame:
    """Link header and failure of the home page: the HEAD answer if it names the API, else the GET answer."""
    head_failure = _failure("home_head")
    head_names = names_api(F.col("home_head.link"))
    failure = F.when(head_failure != "", head_failure).when(head_names, "").otherwise(_failure("home_get"))
    link = F.when(head_names, F.col("home_head.link")).otherwise(F.coalesce("home_get.link", F.lit("")))
    return df.withColumn("home_failure", failure).withColumn("home_link", link)


def find_api_root(df: DataFrame) -> DataFrame:
    """API root of a domain, or '' and the reason; a TLS failure falls back to plain HTTP."""
    https = F.concat(F.lit("https://"), F.col("domain"))
    http = F.concat(F.lit("http://"), F.col("domain"))
    failed = F.col("home_failure") != ""
    fell_back = failed & is_tls_error(F.col("home_failure"))
    http_failure = _failure("home_http_get")
    http_names = names_api(F.col("home_http_get.link"))
    named = names_api(F.col("home_link"))
    root = (
        F.when(fell_back & (http_failure == "") & http_names, F.concat(http, F.lit(API_ENDPOINT)))
        .when(~failed & named, api_root(F.col("home_link"), https))
        .otherwise("")
    )
    error = (
        F.when(fell_back & (http_failure != ""), F.concat(F.lit(FALLBACK_FAILED), http_failure))
        .when(fell_back & ~http_names, FALLBACK_NO_API)
        .when(fell_back, "")
        .when(failed, F.col("home_failure"))
        .when(~named, NO_API)
        .otherwise("")
    )
    return df.withColumn("api_root", root).withColumn("home_error", error)


def verify_results(domains: DataFrame, captures: DataFrame) -> DataFrame:
    """One verification row per input domain, flags as 0/1.

    Only captures of these domains are parsed.
    """
    work = domains.select("domain").distinct()
    facts = domain_facts(capture_facts(captures.join(work, "domain", "left_semi")))
    rows = find_api_root(choose_home_response(work.join(facts, "domain", "left")))
    confirmed = F.col("api_root") != ""
    probe_failure = _failure("comments_probe")
    probe_error = F.when(probe_failure != "", probe_failure).otherwise(F.coalesce("comments_probe.fault", F.lit("")))
    return rows.select(
        "domain",
        flag(confirmed).alias("wp_confirmed"),
        flag(confirmed & (probe_error == "")).alias("comments_endpoint"),
        F.when(confirmed, F.coalesce("comments_probe.total", F.lit(0))).otherwise(F.lit(0)).alias("comment_count_hint"),
        "api_root",
        F.when(confirmed, probe_error).otherwise(F.col("home_error")).alias("error"),
    )


def comments_per_post(captures: DataFrame) -> DataFrame:
    """Comments in the sample of each (domain, post_id); a void sample gives no rows."""
    usable = (F.col("kind") == "comments_sample") & F.col("error").isNull() & (F.col("status") == 200)
    posts = captures.where(usable).select("domain", F.explode(sampled_posts(F.col("body"))).alias("post_id"))
    return (
        posts.where(F.col("post_id") > 0)
        .groupBy("domain", "post_id")
        .agg(F.count("*").alias("comment_count_in_sample"))
    )


def top_posts(counts: DataFrame, max_pages: int = MAX_PAGES) -> DataFrame:
    """The most-commented posts of each domain; equal counts by post id.

    A limit below 1 means the default.
    """
    max_pages = max_pages if max_pages > 0 else MAX_PAGES
    order = Window.partitionBy("domain").orderBy(F.desc("comment_count_in_sample"), F.col("post_id"))
    rank = F.row_number().over(order)
    return counts.withColumn("_rank", rank).where(F.col("_rank") <= max_pages).drop("_rank")


def chosen_posts(results: DataFrame, captures: DataFrame, max_pages: int = MAX_PAGES) -> DataFrame:
    """Top posts of domains with a comment endpoint; only the samples of these are parsed."""
    open_domains = results.where(F.col("comments_endpoint") == 1).select("domain")
    return top_posts(comments_per_post(captures.join(open_domains, "domain", "left_semi")), max_pages)


def is_waiting() -> Column:
    """Of a result row: the request that decides it has no capture yet."""
    return F.col("error").isin(NOT_CAPTURED, FALLBACK_FAILED + NOT_CAPTURED)


def waiting_domains(results: DataFrame, chosen: DataFrame, captures: DataFrame) -> DataFrame:
    """Domains with a comment endpoint whose sample, or a post chosen from it, has no capture yet."""
    open_domains = results.where(F.col("comments_endpoint") == 1).select("domain")
    of = lambda kind: captures.where(F.col("kind") == kind)
    no_sample = open_domains.join(of("comments_sample").select("domain"), "domain", "left_anti")
    no_post = chosen.join(of("post").select("domain", "post_id"), ["domain", "post_id"], "left_anti").select("domain")
    return no_sample.union(no_post).distinct()


def verify_pages(results: DataFrame, captures: DataFrame, max_pages: int = MAX_PAGES) -> DataFrame:
    """Top posts of domains with a comment endpoint, looked up among the post captures."""
    return pages_of(chosen_posts(results, captures, max_pages), captures)


def pages_of(chosen: DataFrame, captures: DataFrame) -> DataFrame:
    """Chosen posts, looked up among the post captures.

    A chosen post that was not answered with a readable post is dropped, not replaced.
    Only the bodies of chosen posts are parsed.
    """
    answered = (F.col("kind") == "post") & F.col("error").isNull() & (F.col("status") == 200)
    posts = (
        captures.where(answered)
        .join(chosen.select("domain", "post_id"), ["domain", "post_id"], "left_semi")
        .select("domain", "post_id", post_fields(F.col("body")).alias("post"))
        .groupBy("domain", "post_id")
        .agg(F.min("post").alias("post"))
        .where(F.col("post").isNotNull())
    )
    return chosen.join(posts, ["domain", "post_id"]).select(
        "domain", "post_id", F.col("post.link").alias("url"), F.col("post.title").alias("title"), "comment_count_in_sample"
    )


def verify_all(
    domains: DataFrame, captures: DataFrame, max_pages: int = MAX_PAGES
) -> tuple[DataFrame, DataFrame]:
    """(results, pages) of a set of domains."""
    results = verify_results(domains, captures)
    return results, verify_pages(results, captures, max_pages)


def verify_totals(results: DataFrame, pages: DataFrame) -> DataFrame:
    """One row: domains checked, domains with comments, pages found."""
    return results.agg(
        F.count("*").alias("domains"),
        F.count_if(F.col("comments_endpoint") == 1).alias("with_comments"),
    ).withColumn("pages_found", pages.agg(F.count("*")).scalar())
