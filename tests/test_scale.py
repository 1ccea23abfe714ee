"""Properties the operators need at scale: plans, skew and independence of row order."""

import random
import re

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from talkscout.operators import disqus, tables, verify, wordpress
from talkscout.sources.captures import Captures, read_captures, write_captures
from talkscout.sources.url_index import read_url_index
from talkscout.sources.wat import read_wat_records

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    """Physical plan text; adaptive execution off, so that it is complete before the run."""
    spark = df.sparkSession
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.maxMetadataStringLength": "100000"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        return df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)


def exchanges(text):
    return len(re.findall(r"[-:] Exchange ", text)) + text.startswith("Exchange ")


@pytest.fixture
def index_file(spark, tmp_path):
    path = f"{tmp_path}/index"
    fx.spark_sql(spark, SF_DIR, fx.index()).drop("page_id", "partition_idx").coalesce(1).write.parquet(path)
    return path


def test_index_filter_reaches_the_scan(spark, index_file):
    text = plan(wordpress.wordpress_rows(read_url_index(spark, [index_file]), "file"))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    assert "EqualTo(fetch_status,200)" in pushed and "EqualTo(content_mime_detected,text/html)" in pushed
    assert "StringContains(url_path,/wp-json/)" in pushed and "EqualTo(url_host_registered_domain,wordpress.com)" in pushed
    assert exchanges(text) == 0


def test_index_scan_reads_only_what_the_query_needs(spark, index_file):
    text = plan(read_url_index(spark, [index_file]).select("url", "file"))
    assert "ReadSchema: struct<url:string>" in text


def test_winners_need_one_shuffle(spark, index_file):
    index = read_url_index(spark, [index_file])
    text = plan(wordpress.first_per_domain(wordpress.candidate_rows(index, "file"), "file"))
    assert exchanges(text) == 1 and "partial_min" in text
    assert exchanges(plan(wordpress.discover(index, "file"))) == 2  # by domain, and the final sort


def test_every_domain_of_a_partition_counts(spark):
    rows = spark.range(120_000).select(
        F.lit(0).alias("partition_idx"),
        F.concat(F.lit("d"), "id", F.lit(".org")).alias("url_host_registered_domain"),
        F.concat(F.lit("d"), "id", F.lit(".org")).alias("url_host_name"),
        F.lit("https://x/").alias("url"),
        F.lit("/wp-json/").alias("url_path"),
        F.lit(200).alias("fetch_status"),
        F.lit("text/html").alias("content_mime_detected"),
    )
    assert wordpress.discover(rows).count() == 120_000


def test_record_scan_has_no_shuffle_and_filters_first(spark, tmp_path):
    (tmp_path / "a.wat").write_text("WARC/1.0\n")
    text = plan(disqus.record_hits(read_wat_records(spark, [str(tmp_path)])))
    assert exchanges(text) == 0 and "Window" not in text and "PythonUDF" not in text
    assert text.index("from_json") < text.index("Contains(value")  # the scan's filter lies below
    assert text.count("from_json(StructField") == 1


def test_record_winners_need_one_shuffle(spark, tmp_path):
    (tmp_path / "a.wat").write_text("WARC/1.0\n")
    text = plan(disqus.scan_winners(disqus.record_hits(read_wat_records(spark, [str(tmp_path)]))))
    assert text.count("FileScan text") == 1 and exchanges(text) == 1
    assert "partial_min" in text and "Window" not in text


def test_line_scan_parses_once_and_shuffles_no_document(spark, tmp_path):
    fx.spark_sql(spark, SF_DIR, fx.wat_lines()).write.parquet(f"{tmp_path}/lines")
    text = plan(disqus.forum_lines(spark.read.parquet(f"{tmp_path}/lines")))
    assert text.count("from_json(StructField") == 1 and "ReusedExchange" in text


def test_bodies_are_not_shuffled(spark, tmp_path):
    fx.spark_sql(spark, SF_DIR, fx.captures()).write.parquet(f"{tmp_path}/captures")
    captures = spark.read.parquet(f"{tmp_path}/captures")
    facts = verify.domain_facts(verify.capture_facts(captures))
    above = plan(facts).split("Exchange")[0]
    assert "body#" not in above and exchanges(plan(facts)) == 1
    counts = plan(verify.top_posts(verify.comments_per_post(captures)))
    assert "WindowGroupLimit" in counts and "partial_count" in counts


def test_work_list_is_an_anti_join(spark):
    ids = spark.range(5).select(F.col("id").cast("string").alias("domain"))
    assert "LeftAnti" in plan(tables.unverified(ids, ids))


def test_captures_are_cut_to_the_work_list_before_they_are_parsed(spark, tmp_path):
    fx.spark_sql(spark, SF_DIR, fx.captures()).write.parquet(f"{tmp_path}/captures")
    captures = spark.read.parquet(f"{tmp_path}/captures")
    work = spark.range(3).select(F.col("id").cast("string").alias("domain"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        results, pages = verify.verify_all(work, captures)
        texts = plan(results), plan(pages)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for text in texts:
        lines = text.split("\n")
        depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
        for i, line in enumerate(lines):
            if "try_parse_json" in line or "from_json" in line:
                below = [x for x in lines[i + 1 :] if depth(x) > depth(line)]
                assert any("LeftSemi" in x for x in below), line
    counts = verify.comments_per_post(captures)
    assert plan(counts).count("from_json(") == 1


def test_posts_are_parsed_once(spark):
    from talkscout.functions.documents import post_fields

    df = spark.range(2).select(F.col("id").cast("string").alias("body"))
    text = plan(df.select(post_fields(F.col("body")).alias("post")))
    assert len(re.findall(r"try_parse_json|parseJson", text)) == 1


def test_carry_forward_across_blocks_of_one_large_file(spark):
    # one file, headers far apart, so that URIs cross several 65,536-line blocks
    lines = spark.range(400_000).select(
        F.lit(0).alias("file_idx"),
        F.col("id").alias("line_no"),
        F.when(F.col("id").isin(70_000, 70_002, 300_000), F.concat(F.lit("WARC-Target-URI: u"), "id"))
        .when(F.col("id") % 1000 == 1, "x disqus.com")
        .otherwise("filler")
        .alias("value"),
    )
    rows = disqus.carry_forward(lines).collect()
    assert len(rows) == 400
    for r in rows:
        uri = "" if r.line_no < 70_000 else "u70000" if r.line_no < 70_002 else "u70002" if r.line_no < 300_000 else "u300000"
        assert r.target_uri == uri


@pytest.mark.parametrize("seed", range(3))
def test_carry_forward_with_tiny_blocks(spark, monkeypatch, seed):
    monkeypatch.setattr(disqus, "BLOCK_BITS", 2)
    rng = random.Random(seed)
    rows, want, uri = [], {}, {}
    for n in sorted(rng.sample(range(3000), 600)):
        file = rng.choice([0, 0, 0, 1])
        kind = rng.random()
        value = f"WARC-Target-URI: u{n}" if kind < 0.2 else "WARC-Target-URI:" if kind < 0.25 else "x disqus.com" if kind < 0.6 else "y"
        if value.startswith("WARC"):
            uri[file] = value.partition(":")[2].strip()
        elif "disqus" in value:
            want[file, n] = uri.get(file, "")
        rows.append((file, n, value))
    rng.shuffle(rows)
    lines = spark.createDataFrame(rows, "file_idx INT, line_no BIGINT, value STRING")
    got = {(r.file_idx, r.line_no): r.target_uri for r in disqus.carry_forward(lines).collect()}
    assert got == want


def test_captures_are_read_by_kind(spark, tmp_path):
    captures = fx.spark_sql(spark, SF_DIR, fx.captures())
    write_captures(captures, f"{tmp_path}/captures")
    stored = read_captures(spark, f"{tmp_path}/captures")
    assert stored.columns == captures.columns
    assert sorted(map(tuple, stored.collect()), key=str) == sorted(map(tuple, captures.collect()), key=str)
    text = plan(verify.comments_per_post(stored))
    assert re.search(r"PartitionFilters: \[[^]]*comments_sample", text)


@pytest.mark.parametrize("parts", [1, 7])
def test_row_order_does_not_matter(spark, parts):
    def rows(df):
        return sorted(map(tuple, df.collect()), key=str)

    def shuffled(df):
        return df.orderBy(F.xxhash64(*[F.col(c).cast("string") for c in df.columns], F.lit(parts))).repartition(parts)

    index = fx.spark_sql(spark, SF_DIR, fx.index())
    assert rows(wordpress.discover(shuffled(index))) == rows(wordpress.discover(index))
    lines = fx.spark_sql(spark, SF_DIR, fx.wat_lines())
    assert rows(disqus.discover(shuffled(lines))) == rows(disqus.discover(lines))
    domains, captures = fx.spark_sql(spark, SF_DIR, fx.domains()), fx.spark_sql(spark, SF_DIR, fx.captures())
    for got, want in zip(verify.verify_all(shuffled(domains), shuffled(captures)), verify.verify_all(domains, captures)):
        assert rows(got) == rows(want)
    log = fx.spark_sql(spark, SF_DIR, fx.results_log())
    view = lambda df: tables.last_wins(df, ["domain"], ["domain", "error", "comment_count_hint"])
    assert rows(view(shuffled(log))) == rows(view(log))


def scanned_bytes(df):
    """Rows of a frame without a shuffle, and the size of the files its scan took, from the scan's metrics."""
    rows = df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return rows, sum(leaves.apply(i).metrics().apply("filesSize").value() for i in range(leaves.size()))


def test_short_list_of_domains_reads_few_bytes(spark, tmp_path):
    """100 of 150,000 domains: under 5 % of the bytes of a full read."""
    body = F.concat_ws("", *(F.sha2(F.concat(F.col("id").cast("string"), F.lit(f":{i}")), 512) for i in range(4)))
    rows = spark.range(150_000).select(
        F.concat("id", F.lit(".org")).alias("domain"), F.lit("comments_sample").alias("kind"), F.lit(None).cast("bigint").alias("post_id"),
        F.lit(200).alias("status"), F.lit(None).cast("string").alias("link_header"), F.lit(None).cast("string").alias("x_wp_total"),
        body.alias("body"), F.lit(None).cast("string").alias("error"),
    )
    stored = Captures(spark, f"{tmp_path}/captures", buckets=4096)
    stored.append(rows)
    threshold = spark.conf.get("spark.sql.parquet.pushdown.inFilterThreshold")
    try:
        _, whole = scanned_bytes(stored.all().where("domain = 'none'"))
        wanted = spark.range(0, 150_000, 1500).select(F.concat("id", F.lit(".org")).alias("domain"))
        chosen = stored.of(wanted)
        got, few = scanned_bytes(chosen.select("domain", "body"))
        assert sorted(got) == sorted(rows.join(wanted, "domain", "left_semi").select("domain", "body").collect()) and len(got) == 100
        assert whole > 50_000_000 and few < 0.05 * whole, (few, whole)
        text = chosen._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^]]*bucket", text) and "In(domain" in text
        assert stored.of(wanted, most=99).count() == 150_000  # a longer list is left to the join
        assert stored.of(wanted.limit(0)).count() == 0
    finally:
        spark.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", threshold)
