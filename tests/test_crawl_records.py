"""Record scan of crawl files, against a plain reading of the same bytes."""

import gzip
import json
import random

import pytest

from talkscout.operators import disqus
from talkscout.sources import wat
from talkscout.sources.wat import read_wat_lines, read_wat_records


def doc(script=None, link=None):
    urls = lambda url: [{"url": url}] if url else []
    inside = {"Scripts": urls(script), "Links": urls(link)}
    return json.dumps({"Envelope": {"Payload-Metadata": {"HTTP-Response-Metadata": {"HTML-Metadata": inside}}}})


def record(uri, *lines):
    head = ["WARC/1.0", "WARC-Type: metadata", f"WARC-Target-URI: {uri}", "Content-Length: 9", ""]
    return "".join(line + "\r\n" for line in [*head, *lines, ""])


def scan(spark, path):
    rows = disqus.scan_winners(disqus.record_hits(read_wat_records(spark, [str(path)]))).collect()
    return {(r.domain, r.hostname, r.sample_url, r.disqus_shortname) for r in rows}


def line_scan(spark, path):
    lines = read_wat_lines(spark, [str(path)])
    named = disqus.forum_lines(lines, "file", "line_at", block="block")
    rows = disqus.first_per_file(disqus.line_hits(named), "file", ("line_at",)).collect()
    return {(r.domain, r.hostname, r.sample_url, r.disqus_shortname) for r in rows}


def test_one_record(spark, tmp_path):
    path = tmp_path / "a.warc.wat"
    path.write_text(record("https://www.site.org/p", doc("//forum.disqus.com/embed.js")))
    assert scan(spark, path) == {("site.org", "www.site.org", "https://www.site.org/p", "forum")}


def test_first_line_of_a_domain_wins(spark, tmp_path):
    path = tmp_path / "a.warc.wat"
    path.write_text(
        record("https://www.site.org/1", doc("//one.disqus.com/embed.js"))
        + record("https://blog.site.org/2", doc("//two.disqus.com/embed.js"))
        + record("https://other.org/", doc(link="//Three.disqus.com/"))
    )
    assert scan(spark, path) == {
        ("site.org", "www.site.org", "https://www.site.org/1", "one"),
        ("other.org", "other.org", "https://other.org/", "three"),
    }


def test_uri_carries_over_records_without_one(spark, tmp_path):
    path = tmp_path / "a.warc.wat"
    path.write_text(
        record("https://site.org/", "no forum here")
        + "WARC/1.0\r\nWARC-Type: warcinfo\r\n\r\nx\r\n"
        + doc("//late.disqus.com/embed.js")
        + "\r\n"
    )
    assert scan(spark, path) == {("site.org", "site.org", "https://site.org/", "late")}


def test_lines_without_uri_forum_or_host_are_dropped(spark, tmp_path):
    path = tmp_path / "a.warc.wat"
    path.write_text(
        "WARC/1.0\r\n"
        + doc("//orphan.disqus.com/embed.js")
        + "\r\n"
        + record("", doc("//emptyuri.disqus.com/embed.js"))
        + record("mailto:x@y.org", doc("//nohost.disqus.com/embed.js"))
        + record("http://bad.org:port/", doc("//badport.disqus.com/embed.js"))
        + record("https://www.disqus.com/", doc("https://cdn.org/x.js"))
        + record("https://broken.org/", "{broken disqus.com")
    )
    assert scan(spark, path) == set()


def test_header_text_inside_a_line_is_no_header(spark, tmp_path):
    path = tmp_path / "a.warc.wat"
    path.write_text(
        record("https://site.org/", 'x "WARC-Target-URI: https://wrong.org/"', doc("//f.disqus.com/embed.js"))
    )
    assert scan(spark, path) == {("site.org", "site.org", "https://site.org/", "f")}


def test_file_that_starts_with_a_header(spark, tmp_path):
    path = tmp_path / "a.warc.wat"
    path.write_text("WARC-Target-URI: https://site.org/\n" + doc("//f.disqus.com/embed.js"))
    assert scan(spark, path) == {("site.org", "site.org", "https://site.org/", "f")}


def test_empty_file(spark, tmp_path):
    path = tmp_path / "a.warc.wat"
    path.write_text("")
    assert scan(spark, path) == set()


def many_records(n):
    parts = []
    for i in range(n):
        line = doc(f"//f{i}.disqus.com/embed.js") if i % 3 == 0 else "filler\rwith bare return " * (i % 7)
        parts.append(record(f"https://h{i % 40}.site{i % 25}.org/{i}", line))
        if i % 5 == 0:
            parts.append(doc(f"//carried{i}.disqus.com/embed.js") + "\n")
    return parts


def expected(text):
    """Straight reading of the text, line by line."""
    uri, first = "", {}
    for line in text.split("\n"):
        if line.startswith("WARC-Target-URI:"):
            uri = line[len("WARC-Target-URI:") :].strip()
        elif "disqus.com" in line:
            script = json.loads(line)["Envelope"]["Payload-Metadata"]["HTTP-Response-Metadata"]["HTML-Metadata"]["Scripts"]
            host = uri.split("/")[2]
            domain = ".".join(host.split(".")[-2:])
            first.setdefault(domain, (domain, host, uri, script[0]["url"][2:].split(".")[0]))
    return set(first.values())


def test_gzip_with_one_member_per_record(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(wat, "BLOCK_BITS", 3)
    parts = many_records(200)
    path = tmp_path / "a.warc.wat.gz"
    path.write_bytes(b"".join(gzip.compress(p.encode()) for p in parts))
    assert scan(spark, path) == expected("".join(parts)) == line_scan(spark, path)


@pytest.mark.parametrize("split_bytes", ["700", "4099"])
def test_uncompressed_file_read_in_many_splits(spark, tmp_path, split_bytes):
    text = "".join(many_records(300))
    path = tmp_path / "a.warc.wat"
    path.write_bytes(text.encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert read_wat_records(spark, [str(path)]).select("block_start").distinct().count() > 10
        assert scan(spark, path) == expected(text) == line_scan(spark, path)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_lines_of_any_length_count(spark, tmp_path):
    path = tmp_path / "a.wat"
    long = 11 * 1024 * 1024
    path.write_text(
        record("https://a.org/", doc("//a.disqus.com/embed.js"))
        + record("https://x.org/", "y" * long)
        + record("https://b.org/", doc("//b.disqus.com/embed.js").replace('"Links": []', f'"Links": [], "x": "{"z" * long}"'))
        + record("https://c.org/", doc("//c.disqus.com/embed.js"))
    )
    assert {r[0] for r in scan(spark, path)} == {"a.org", "b.org", "c.org"}


def test_a_file_can_keep_a_row_of_its_own(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.wat").write_text(record(f"https://{name}.org/", "nothing"))
    scanned = wat.located(spark.read.option("lineSep", wat.RECORD_BREAK).text(str(tmp_path)))
    rows = disqus.scan_winners_and_files(disqus.record_hits(wat.records(scanned, keep_files=True))).collect()
    assert sorted(r.file.rsplit("/", 1)[-1] for r in rows) == ["a.wat", "b.wat"]
    assert all(r.domain is None for r in rows)


def test_bytes_that_are_no_utf8(spark, tmp_path):
    path = tmp_path / "a.wat"
    text = record("https://a.org/", doc("//a.disqus.com/embed.js").replace('"Links": []', '"Links": [], "x": "?"'))
    path.write_bytes(text.encode().replace(b'"?"', b'"\xff\xfe"') + record("https://b.org/\xe9", doc("//b.disqus.com/embed.js")).encode("latin-1"))
    assert {(r[0], r[3]) for r in scan(spark, path)} == {("a.org", "a"), ("b.org", "b")}


@pytest.mark.parametrize("seed", range(4))
def test_random_files_against_a_plain_reading(spark, tmp_path, seed):
    rng = random.Random(seed)
    names = ["a.org", "b.org", "www.c.org", "blog.c.org", "d.org"]
    lines = ["WARC/1.0"]
    for i in range(rng.randrange(30, 400)):
        kind = rng.random()
        if kind < 0.3:
            lines.append(f"WARC-Target-URI: https://{rng.choice(names)}/{i}")
        elif kind < 0.5:
            lines.append(doc(f"//f{i}.disqus.com/embed.js"))
        else:
            lines.append(rng.choice(["", "WARC/1.0", "x", "a\rb", "WARC-Target-URI", " WARC-Target-URI: https://no.org/"]))
    first = next(i for i, l in enumerate(lines) if l.startswith("WARC-Target-URI:"))
    lines = [l for i, l in enumerate(lines) if i >= first or "disqus" not in l]
    text = rng.choice(["\n", "\r\n"]).join(lines)
    path = tmp_path / "a.wat.gz"
    path.write_bytes(gzip.compress(text.encode()))
    assert scan(spark, path) == expected(text) == line_scan(spark, path)
