import gzip

import pytest
from pyspark.sql import functions as F

from talkscout.sources import manifest as m


def lines(spark, *paths):
    return spark.createDataFrame([(p,) for p in paths], "path STRING")


def listed(files):
    return [(r.partition_idx, r.partition_url) for r in files.orderBy("partition_idx").collect()]


def test_index_selection(spark):
    df = lines(spark, " t/subset=warc/b ", "t/subset=robotstxt/a", "", "  ", "t/subset=warc/a\r", "t/subset=warc/a2")
    assert listed(m.index_files(df, "s3a://x/")) == [
        (0, "s3a://x/t/subset=warc/a"),
        (1, "s3a://x/t/subset=warc/a2"),
        (2, "s3a://x/t/subset=warc/b"),
    ]


def test_wat_selection_uses_the_suffix_and_the_default_base(spark):
    df = lines(spark, "c/2.warc.wat.gz", "c/1.warc.wat.gz", "c/1.warc.gz", "c/1.warc.wat.gz.tmp")
    assert listed(m.wat_files(df)) == [
        (0, m.BASE_URL + "c/1.warc.wat.gz"),
        (1, m.BASE_URL + "c/2.warc.wat.gz"),
    ]


def test_window(spark):
    files = m.wat_files(lines(spark, *(f"{i}.warc.wat.gz" for i in range(6))), "")
    idx = lambda *args: [i for i, _ in listed(m.window_of(files, *args))]
    assert idx() == [0, 1, 2, 3, 4, 5]
    assert idx(2, 2) == [2, 3]
    assert idx(4, 10) == [4, 5]
    assert idx(-3, 2) == [0, 1]
    assert idx(6, 2) == []
    assert idx(1, 0) == [1, 2, 3, 4, 5]


def test_suspicious_paths_are_flagged(spark):
    marks = ["'", '"', ";", "\\"]
    df = lines(spark, "subset=warc/plain", *(f"subset=warc/a{c}b" for c in marks))
    flags = {r.partition_url: r.suspicious for r in m.index_files(df, "").collect()}
    assert flags.pop("subset=warc/plain") is False
    assert set(flags.values()) == {True} and len(flags) == 4


def test_gzip_manifest(spark, tmp_path):
    path = tmp_path / "wat.paths.gz"
    path.write_bytes(gzip.compress(b"b.warc.wat.gz\na.warc.wat.gz\n"))
    assert listed(m.wat_files(m.read_manifest(spark, str(path)), "")) == [(0, "a.warc.wat.gz"), (1, "b.warc.wat.gz")]


@pytest.mark.parametrize(
    "values",
    [
        ["x"],
        ["same", "same", "same"],
        [f"common/prefix/{i * 7919 % 1000:04d}/é{i}" for i in range(1000)],
        ["a", "a/", "a-", "a/b", "", "ä", "z" * 50, "Z"],
    ],
)
def test_sorted_index_is_byte_order(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v STRING").repartition(5)
    got = [r.v for r in m.sorted_index(df, "v", "i").orderBy("i").collect()]
    assert got == sorted(values, key=lambda v: v.encode())
    assert [r.i for r in m.sorted_index(df, "v", "i").orderBy("i").collect()] == list(range(len(values)))


def test_file_keys_of_manifest_and_scan_agree(spark, tmp_path):
    folder = tmp_path / "with space+plus"
    folder.mkdir()
    (folder / "a.txt").write_text("x\n")
    scanned = spark.read.text(str(folder)).select(m.scanned_file_key(F.col("_metadata.file_path")).alias("k")).first().k
    listed_key = spark.range(1).select(m.file_key(F.lit(f"{folder}/a.txt")).alias("k")).first().k
    assert scanned == listed_key
