"""Disqus candidates from crawl records."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talkscout.functions.documents import LINKS_PATH, SCRIPTS_PATH, forum_reader, with_forum
from talkscout.functions.urls import is_target_uri_header, registered_domain, target_uri, url_host
from talkscout.sources.wat import BLOCK_BITS, FORUM_HOST

CANDIDATE = ["domain", "hostname", "sample_url", "disqus_shortname"]


def carry_forward(
    lines: DataFrame, file: str = "file_idx", order: str = "line_no", block: str | None = None
) -> DataFrame:
    """Lines that name the forum host, each with the last target URI above it in its file.

    For line tables with an explicit order. Gives (file, order, value, target_uri);
    '' where no header precedes.
    """
    header = is_target_uri_header(F.col("value"))
    marked = lines.where(header | F.col("value").contains(FORUM_HOST)).select(
        file,
        order,
        *([block] if block else []),
        F.when(header, target_uri(F.col("value"))).alias("uri"),
        F.when(~header, F.col("value")).alias("value"),
    )
    return _carry(marked, "value", file, order, block)


def forum_lines(
    lines: DataFrame,
    file: str = "file_idx",
    order: str = "line_no",
    block: str | None = None,
    scripts_path: Sequence[str] = SCRIPTS_PATH,
    links_path: Sequence[str] = LINKS_PATH,
) -> DataFrame:
    """Lines with a forum name, each with its target URI: (file, order, disqus_shortname, target_uri).

    Names are read off the lines before anything is shuffled, so the documents
    themselves, by far the largest part, stay where they were scanned.
    """
    header = is_target_uri_header(F.col("value"))
    marked = lines.where(header | F.col("value").contains(FORUM_HOST)).select(
        file,
        order,
        *([block] if block else []),
        F.when(header, target_uri(F.col("value"))).alias("uri"),
        F.when(~header, F.col("value")).alias("_line"),
    )
    named = with_forum(marked, "_line", "disqus_shortname", scripts_path, links_path).drop("_line")
    named = named.withColumn("disqus_shortname", F.nullif("disqus_shortname", F.lit("")))
    return _carry(named, "disqus_shortname", file, order, block)


def _carry(marked: DataFrame, payload: str, file: str, order: str, block: str | None) -> DataFrame:
    """Give each row with a payload the last `uri` above it in its file.

    A file is cut into blocks of lines, so that no task ever sorts a whole file: the
    window runs within a block, and the last URI of earlier blocks is carried over
    through a table with one row per block. `block` names an order-keeping block
    column; by default blocks are runs of 65,536 values of `order`.
    """
    block_of = F.col(block) if block else F.shiftright(order, BLOCK_BITS)
    blocks = (
        marked.select(file, order, payload, "uri", block_of.alias("_block"))
        .where(F.col(file).isNotNull() & F.col("_block").isNotNull())
        .repartition(file, "_block")
    )
    inside = Window.partitionBy(file, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    hits = blocks.withColumn("_inside", F.last("uri", ignorenulls=True).over(inside)).where(
        F.col(payload).isNotNull()
    )
    # Both branches read the same columns and rows, so the shuffled blocks are made once and reused.
    at_header = F.when(F.col("uri").isNotNull(), F.col(order))
    block_end = blocks.groupBy(file, "_block").agg(
        F.max_by("uri", at_header).alias("_end"), F.count(payload).alias("_hits")
    )
    above = Window.partitionBy(file).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        block_end.withColumn("_carried", F.last("_end", ignorenulls=True).over(above))
        .where(F.col("_hits") > 0)
        .select(file, "_block", "_carried")
    )
    return hits.join(carried, [file, "_block"]).select(
        file, order, payload, F.coalesce("_inside", "_carried", F.lit("")).alias("target_uri")
    )


def line_hits(named: DataFrame) -> DataFrame:
    """Add host and registered domain to `forum_lines`; '' where the URI has none."""
    return (
        named.withColumn("hostname", url_host(F.col("target_uri")))
        .withColumn("domain", registered_domain(F.col("hostname")))
        .withColumnRenamed("target_uri", "sample_url")
    )


def record_hits(
    records: DataFrame,
    scripts_path: Sequence[str] = SCRIPTS_PATH,
    links_path: Sequence[str] = LINKS_PATH,
) -> DataFrame:
    """Candidate of each matching record line; a NULL domain where there is none.

    Rows without a line are kept: they may stand for their file.
    """
    return hits_reader(scripts_path, links_path)(records)


def hits_reader(
    scripts_path: Sequence[str] = SCRIPTS_PATH, links_path: Sequence[str] = LINKS_PATH
) -> Callable[[DataFrame], DataFrame]:
    """`record_hits` whose expressions are made once, for callers that scan one group of files after the other."""
    pos_and_line = F.posexplode_outer("lines").alias("pos", "line")
    named = forum_reader("line", "disqus_shortname", scripts_path, links_path)
    hostname = F.when(F.col("disqus_shortname") != "", url_host(F.col("target_uri")))
    domain = F.nullif(registered_domain(F.col("hostname")), F.lit(""))

    def read(records: DataFrame) -> DataFrame:
        lines = records.select("*", pos_and_line).drop("lines")
        hosted = named(lines).drop("line").withColumn("hostname", hostname)
        return hosted.withColumn("domain", domain).withColumnRenamed("target_uri", "sample_url")

    return read


def _first(hits: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first by `order`; rows without a domain are dropped.

    The domain is tested on its way out, as an aggregate: a test of the key itself would
    be moved down to the hits and have every host parsed again.
    """
    first = F.min(F.struct(*order, "hostname", "sample_url", "disqus_shortname"))
    rows = hits.groupBy(*key).agg(first.alias("w"), F.max("domain").alias("_domain"))
    return rows.where(F.col("_domain") != "").select(*key, "w.*")


def first_per_file(
    hits: DataFrame, file: str = "file_idx", order: Sequence[str] = ("line_no",)
) -> DataFrame:
    """One row per (file, domain): the first in file order."""
    return _first(hits, [file, "domain"], order)


def first_per_domain(
    hits: DataFrame, file: str = "file_idx", order: Sequence[str] = ("line_no",)
) -> DataFrame:
    """One row per domain: the first in the lowest file."""
    return _first(hits, ["domain"], [file, *order])


def discover(lines: DataFrame, file: str = "file_idx", order: str = "line_no") -> DataFrame:
    """Disqus candidates of a line table, one per registered domain, by domain."""
    hits = line_hits(forum_lines(lines, file, order))
    return first_per_domain(hits, file, (order,)).select(*CANDIDATE).orderBy("domain")


def scan_winners(hits: DataFrame) -> DataFrame:
    """Per-file winners of `record_hits`: (file, domain, hostname, sample_url, disqus_shortname).

    One shuffle of rows that each task has already reduced to one per file and domain.
    """
    return first_per_file(hits, "file", ("block_start", "rid", "pos")).select("file", *CANDIDATE)


def scan_winners_and_files(hits: DataFrame) -> DataFrame:
    """`scan_winners`, and rows without a domain that stand for files without a candidate."""
    first = F.min(F.struct("block_start", "rid", "pos", "hostname", "sample_url", "disqus_shortname"))
    winners = hits.groupBy("file", "domain").agg(first.alias("w"))
    return winners.select("file", "domain", "w.hostname", "w.sample_url", "w.disqus_shortname")
