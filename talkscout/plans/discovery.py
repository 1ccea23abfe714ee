"""Discovery runs: scan the next files of a crawl and commit what they gave."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from talkscout.functions.documents import LINKS_PATH, SCRIPTS_PATH
from talkscout.operators import disqus, wordpress
from talkscout.operators.tables import failed_partitions, resume_offset
from talkscout.plans.store import Store
from talkscout.plans.waves import UnreadableWave, scan_readable, wave_size
from talkscout.sources.manifest import DEFAULT_CRAWL, EmptyManifest, file_key, scanned_file_key, window_of
from talkscout.sources.url_index import read_url_index
from talkscout.sources.wat import read_wat_records

#: Scans files (addresses, the group's file rows) into a batch.
Scan = Callable[[Sequence[str], DataFrame, str], None]

_FILE_ROWS = pa.schema(
    [("partition_idx", pa.int64()), ("partition_url", pa.string()), ("suspicious", pa.bool_()), ("error", pa.string())]
)


class Discovered(NamedTuple):
    """What a run found: one row per domain with the partition that won, and files it couldn't read, with the error."""

    candidates: DataFrame
    failed: dict[str, str]


def run_waves(
    store: Store,
    files: DataFrame,
    progress: str,
    crawl: str,
    partitions: int | None,
    resume: bool,
    retry_failed: bool,
    files_per_wave: int | None,
) -> Iterator[list[Row]]:
    """The files this run takes, wave by wave, in order: (partition_idx, partition_url, suspicious).

    The selection is written once; only the names of one wave at a time come to the driver,
    which has to hand them to the reader. Files that failed before come first, if asked for.
    """
    known = store.table(progress)
    offset = resume_offset(known, crawl) if resume else 0
    chosen = window_of(files, offset, partitions).select("partition_idx", "partition_url", "suspicious")
    if retry_failed:
        again = files.join(failed_partitions(known, crawl).select("partition_idx"), "partition_idx", "left_semi")
        chosen = again.select(*chosen.columns).union(chosen).distinct()
    path = f"{store.root}/selections/{store.new_batches()[0]}"
    chosen.write.parquet(path)
    chosen = store.spark.read.schema(chosen.schema).parquet(path)
    size, last = wave_size(store.spark, files_per_wave), -1
    while rows := chosen.where(F.col("partition_idx") > last).orderBy("partition_idx").limit(size).collect():
        yield rows
        last = rows[-1].partition_idx
        if len(rows) < size:  # these were the last ones
            break
    if last < 0 and files.isEmpty():
        raise EmptyManifest("no matching files in manifest")


def wave_files(spark: SparkSession, rows: Sequence[Row], failed: dict[str, str]) -> DataFrame:
    """File rows with their `file` key and error, as a local relation.

    The planner knows its size: a short list is joined by broadcast, a long one by shuffle.
    """
    named = [{**r.asDict(), "error": failed.get(r["partition_url"])} for r in rows]
    table = pa.Table.from_pylist([{n: r[n] for n in _FILE_ROWS.names} for r in named], _FILE_ROWS)
    return spark.createDataFrame(table).withColumn("file", file_key(F.col("partition_url")))


def by_partition(winners: DataFrame, files: DataFrame) -> DataFrame:
    """Winners with the number of the file they came from as `ordinal`; unlisted files are left out."""
    keyed = winners.withColumn("file", scanned_file_key(F.col("file")))
    return keyed.join(files.select("file", F.col("partition_idx").alias("ordinal")), "file")


def save_progress(
    store: Store, table: str, files: DataFrame, found: DataFrame, crawl: str, batch_id: str
) -> None:
    """One progress row per file; `found` is (partition_idx, candidates_found).

    `status` is suspicious (not read), failed (with the error), empty or ok.
    """
    n = F.coalesce("candidates_found", F.lit(0))
    status = (
        F.when(F.col("suspicious"), "suspicious").when(F.col("error").isNotNull(), "failed").when(n == 0, "empty").otherwise("ok")
    )
    rows = files.join(found, "partition_idx", "left").select(
        F.lit(0).cast("bigint").alias("ordinal"),
        F.lit(crawl).alias("crawl"),
        "partition_idx",
        "partition_url",
        n.alias("candidates_found"),
        F.current_timestamp().alias("scanned_at"),
        status.alias("status"),
        "error",
    )
    store.append(table, rows, batch_id)


def found_per_file(winners: DataFrame) -> DataFrame:
    """Number of rows per file, which is their `ordinal`."""
    return winners.groupBy(F.col("ordinal").alias("partition_idx")).agg(F.count("*").alias("candidates_found"))


class _Run:
    """Waves of one run: scanned, counted, committed."""

    def __init__(self, store: Store):
        self.store, self.batches, self.failed, self.read = store, [], {}, 0

    def wave(self, rows: Sequence[Row], names: Sequence[str], scan: Scan):
        """Scan a wave's files; returns their rows and the batches written."""
        batches, failed = scan_group(self.store, rows, names, self.store.new_batches(2 * len(names) + 1), scan)
        if failed and len(failed) == len(names) and (len(names) > 1 or not self.read):
            raise UnreadableWave(f"none of {len(names)} files could be read, the first one: {next(iter(failed.items()))}")
        self.read += len(names) - len(failed)
        self.failed.update(failed)
        self.batches += batches
        return wave_files(self.store.spark, rows, failed), batches


def scan_group(
    store: Store, rows: Sequence[Row], names: Sequence[str], batches: Sequence[str], scan: Scan
) -> tuple[list[str], dict[str, str]]:
    """Scan files of a group, each readable one into exactly one of the batches.

    Returns the batches written, and the unreadable files with the error.
    """
    files = wave_files(store.spark, rows, {})
    parts, failed = scan_readable(names, lambda paths, part: scan(paths, files, batches[part]))
    return list(batches[: max(parts, 1)]), failed


def discover_wordpress(
    store: Store,
    files: DataFrame,
    crawl: str = DEFAULT_CRAWL,
    partitions: int | None = None,
    resume: bool = False,
    record_progress: bool = True,
    files_per_wave: int | None = None,
    retry_failed: bool = False,
) -> Discovered:
    """Scan the URL-index files of a manifest selection, all or the next so many, and commit the candidates.

    Results and progress are committed wave by wave. Unreadable and suspicious files are
    recorded as such. A partition counts the domains first seen in it during the run: those of its
    wave at first, and when the run ends all counts are written anew over the whole run.
    """
    run, progress = _Run(store), "wp_scan_progress"
    waves = []

    def scan(paths, listed, batch):
        winners = wordpress.winners_per_partition(wordpress.candidate_rows(read_url_index(store.spark, paths), "file"), "file")
        store.append("wp_candidates", by_partition(winners, listed), batch)

    for rows in run_waves(store, files, progress, crawl, partitions, resume, retry_failed, files_per_wave):
        read, batches = run.wave(rows, [r.partition_url for r in rows if not r.suspicious], scan)
        if record_progress:
            counts = found_per_file(_first_of(store, batches).withColumnRenamed("partition_idx", "ordinal"))
            save_progress(store, progress, read, counts, crawl, batches[0])
        store.commit(batches)
        waves.append(batches[0])
    found = _first_of(store, run.batches)
    if record_progress and len(waves) > 1:
        (batch,) = store.new_batches()
        earlier = store.batches(progress, waves).withColumn("suspicious", F.col("status") == "suspicious")
        earlier = earlier.select("partition_idx", "partition_url", "suspicious", "error")
        save_progress(store, progress, earlier, found_per_file(found.withColumnRenamed("partition_idx", "ordinal")), crawl, batch)
        store.commit([batch])
    return Discovered(found.orderBy("domain"), run.failed)


def _first_of(store: Store, batches: Sequence[str]) -> DataFrame:
    """First WordPress row per domain in the given batches, with the partition it came from."""
    written = store.batches("wp_candidates", batches)
    return wordpress.first_per_domain(written, "ordinal").withColumnRenamed("ordinal", "partition_idx")


def disqus_scan(store: Store, scripts_path: Sequence[str], links_path: Sequence[str]) -> Scan:
    """Scans crawl-record files into batches of `disqus_candidates`."""
    hits = disqus.hits_reader(scripts_path, links_path)

    def scan(paths, listed, batch):
        winners = disqus.scan_winners(hits(read_wat_records(store.spark, paths)))
        store.append("disqus_candidates", by_partition(winners, listed), batch)

    return scan


def discover_disqus(
    store: Store,
    files: DataFrame,
    crawl: str = DEFAULT_CRAWL,
    partitions: int | None = None,
    resume: bool = False,
    scripts_path: Sequence[str] = SCRIPTS_PATH,
    links_path: Sequence[str] = LINKS_PATH,
    files_per_wave: int | None = None,
    retry_failed: bool = False,
) -> Discovered:
    """Scan the crawl-record files of a manifest selection, all or the next so many, and commit the candidates.

    Results and progress are committed wave by wave.
    """
    run, progress, scan = _Run(store), "disqus_scan_progress", disqus_scan(store, scripts_path, links_path)
    for rows in run_waves(store, files, progress, crawl, partitions, resume, retry_failed, files_per_wave):
        read, batches = run.wave(rows, [r.partition_url for r in rows], scan)
        read = read.withColumn("suspicious", F.lit(False))  # these files are read all the same
        save_progress(store, progress, read, found_per_file(store.batches("disqus_candidates", batches)), crawl, batches[0])
        store.commit(batches)
    written = store.batches("disqus_candidates", run.batches)
    first = disqus.first_per_domain(written, "ordinal", ()).withColumnRenamed("ordinal", "partition_idx")
    return Discovered(first.orderBy("domain"), run.failed)

