"""Verification and export runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkscout.operators.report import export_rows
from talkscout.operators.tables import unverified
from talkscout.operators.verify import MAX_PAGES, chosen_posts, is_waiting, pages_of, verify_results, waiting_domains
from talkscout.plans.discovery import discover_wordpress
from talkscout.plans.store import Store
from talkscout.sources.captures import Captures
from talkscout.sources.export import write_export
from talkscout.sources.manifest import DEFAULT_CRAWL


def verify_domains(
    store: Store, domains: DataFrame, captures: DataFrame | Captures, max_pages: int = MAX_PAGES
) -> tuple[DataFrame, DataFrame]:
    """Verify the given domains, replace their rows, and return this run's (results, pages).

    A domain gets no row, and stays on the work list, until the request that decides it is
    captured. One with a row whose sample or chosen posts are not all captured is marked as
    waiting, which keeps it on the work list too.
    Pages are found from the results as written, so the captures are not judged twice, and posts are chosen once.
    Of stored `captures`, those of a short list of domains are read without the others.
    """
    (batch,) = store.new_batches()
    zero = F.lit(0).cast("bigint")
    if isinstance(captures, Captures):
        domains = _written(store, domains.select("domain").distinct(), f"{batch}-domains")
        captures = captures.of(domains)
    results = verify_results(domains, captures).where(~is_waiting())
    store.append("results", results.withColumn("ordinal", zero), batch)
    results = store.batches("results", [batch])
    chosen = _written(store, chosen_posts(results, captures, max_pages), f"{batch}-posts")
    store.append("pages", pages_of(chosen, captures).withColumn("ordinal", zero), batch)
    late = waiting_domains(results, chosen, captures).withColumn("waits", F.lit(1))
    marks = results.select("domain").join(late, "domain", "left").withColumn("waits", F.coalesce("waits", F.lit(0)).cast("bigint"))
    store.append("waiting", marks.withColumn("ordinal", zero), batch)
    store.commit([batch])
    return results.drop("ordinal", "batch_id"), store.batches("pages", [batch]).drop("ordinal", "batch_id")


def _written(store: Store, rows: DataFrame, name: str) -> DataFrame:
    """Rows a run works with more than once, written down for it."""
    path = f"{store.root}/selections/{name}"
    rows.write.mode("overwrite").parquet(path)
    return store.spark.read.schema(rows.schema).parquet(path)


def work_list(store: Store) -> DataFrame:
    """WordPress candidates without a result, and domains that wait for a sample or a post."""
    late = store.table("waiting").where("waits = 1").select("domain")
    return unverified(store.table("wp_candidates"), store.table("results")).union(late).distinct()


def verify_wordpress(
    store: Store, captures: DataFrame | Captures, max_pages: int = MAX_PAGES
) -> tuple[DataFrame, DataFrame]:
    """Verify the WordPress candidates that are not finished."""
    return verify_domains(store, work_list(store), captures, max_pages)


def discover_and_verify(
    store: Store,
    files: DataFrame,
    captures: DataFrame | Captures,
    crawl: str = DEFAULT_CRAWL,
    partitions: int | None = None,
    max_pages: int = MAX_PAGES,
) -> tuple[DataFrame, DataFrame]:
    """Discover without recording progress, then verify all that was found, domains with an
    earlier result included."""
    found = discover_wordpress(store, files, crawl, partitions, record_progress=False).candidates
    return verify_domains(store, found.where(F.col("domain") != ""), captures, max_pages)


def export(store: Store, path: str) -> None:
    """Write the export rows of a store as Parquet."""
    rows = export_rows(store.table("disqus_candidates"), store.table("wp_candidates"), store.table("results"))
    write_export(rows, path)
