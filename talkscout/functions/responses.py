"""Expressions over captured HTTP responses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from talkscout.functions.urls import trim_space

# Link relation of the site API and the endpoint below a site.
API_RELATION = "api.w.org"
API_ENDPOINT = "/wp-json/"

_MAX = 2**63 - 1


def names_api(link_header: Column) -> Column:
    return F.coalesce(link_header.contains(API_RELATION), F.lit(False))


def api_root(link_header: Column, base_url: Column) -> Column:
    """First bracketed URL of the API relation in a Link header, else the usual endpoint."""
    parts = F.transform(F.split(link_header, ","), trim_space)
    urls = F.transform(
        parts, lambda p: F.when(p.contains(API_RELATION), F.regexp_extract(p, r"^<([^>]+)>", 1)).otherwise("")
    )
    return F.coalesce(F.get(F.filter(urls, lambda u: u != ""), F.lit(0)), F.concat(base_url, F.lit(API_ENDPOINT)))


def without_trailing_slashes(url: Column) -> Column:
    return F.rtrim(url, F.lit("/"))


def comments_url(root: Column, per_page: int) -> Column:
    """Comment listing below an API root."""
    return F.concat(without_trailing_slashes(root), F.lit(f"/wp/v2/comments?per_page={per_page}"))


def post_url(root: Column, post_id: Column) -> Column:
    """One post below an API root."""
    return F.concat(without_trailing_slashes(root), F.lit("/wp/v2/posts/"), post_id.cast("string"))


def comment_total(header: Column) -> Column:
    """Whole number in a header; 0 when it is none, the nearest bound on overflow."""
    number = header.try_cast("bigint")
    bound = F.when(header.startswith("-"), F.lit(-_MAX - 1)).otherwise(F.lit(_MAX))
    return F.when(header.rlike(r"^[+-]?[0-9]+\z"), F.coalesce(number, bound)).otherwise(F.lit(0).cast("bigint"))


def is_tls_error(error: Column) -> Column:
    return F.coalesce(error.contains("tls:") | error.contains("certificate"), F.lit(False))


def flag(condition: Column) -> Column:
    """Truth as 0/1, the form stored in tables."""
    return F.coalesce(condition, F.lit(False)).cast("bigint")


def short_title(title: Column, limit: int = 60, keep: int = 57) -> Column:
    """Cut a title over `limit` bytes to at most `keep` bytes, whole characters, and '...'."""
    lengths = F.filter(
        F.sequence(F.lit(0), F.lit(keep)), lambda n: F.octet_length(F.left(title, n)) <= keep
    )
    return F.when(
        F.octet_length(title) > limit, F.concat(F.left(title, F.array_max(lengths)), F.lit("..."))
    ).otherwise(title)


def header_lines(headers: Column, name: str) -> Column:
    """Values of all lines of a header, in order; names match in any case. `headers` are (name, value) structs."""
    return F.transform(
        F.filter(F.coalesce(headers, F.array()), lambda h: F.lower(h["name"]) == name.lower()), lambda h: F.coalesce(h["value"], F.lit(""))
    )


def header(headers: Column, name: str) -> Column:
    """Value of the first line of a header; NULL without one."""
    return F.get(header_lines(headers, name), F.lit(0))


def joined_header(headers: Column, name: str) -> Column:
    """Values of all lines of a header as one list, in order; NULL without a line."""
    lines = header_lines(headers, name)
    return F.when(F.size(lines) > 0, F.array_join(F.filter(lines, lambda line: line != ""), ", "))
