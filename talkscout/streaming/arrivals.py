"""Disqus discovery over arriving crawl-record files.

Structured Streaming keeps track of which files have come; which ones a micro-batch stands for is read
from the stream's checkpoint. They are scanned as a wave is, so an unreadable file is left out and
recorded as failed while the others are committed, and a file without a byte is recorded as empty. Micro-batches smaller than
a wave are scanned and committed beside the stream, those that came meanwhile as one group of a wave at most, since
planning a scan costs the same for few files as for many. A commit names the micro-batches it settles; a restart first takes those
that the checkpoint counts as done and no commit names, and goes on with the next files. The batches of a group are written under
the stream's id and the number of its first micro-batch, so a group that is repeated after a failure
replaces itself, and only itself. Partition numbers come from the
manifest, since files arrive in any order; all micro-batches of a stream are one series of the store, so that the first
row of a domain is that of the lowest partition, whenever it came.
"""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from talkscout.functions.documents import LINKS_PATH, SCRIPTS_PATH
from talkscout.plans.discovery import disqus_scan, found_per_file, save_progress, scan_group, wave_files
from talkscout.plans.store import Store
from talkscout.plans.waves import wave_size
from talkscout.sources.manifest import DEFAULT_CRAWL, WAT_SUFFIX, file_key

FILES_PER_BATCH = 100

_FILE_ENTRY = "path STRING, timestamp BIGINT, batchId BIGINT"


class _MicroBatch(NamedTuple):
    """A micro-batch by its name, and its files."""

    name: str
    paths: list[str]


class _Commits:
    """Calls `work` with the micro-batches that have come, in order and `most` at a time, in a thread that ends when none is open."""

    def __init__(self, work: Callable[[list[_MicroBatch]], None], most: int):
        self._work, self._most = work, most
        self._open: list[_MicroBatch] = []
        self._thread: threading.Thread | None = None
        self._error: BaseException | None = None
        self._changed = threading.Condition()

    def put(self, batch: _MicroBatch) -> None:
        """Hand over a micro-batch; returns when fewer than `most` are open, with `most` 1 when it is settled."""
        with self._changed:
            if self._error is None:
                self._open.append(batch)
                if self._thread is None:
                    self._thread = threading.Thread(target=self._run)
                    self._thread.start()
                self._changed.wait_for(lambda: self._error is not None or len(self._open) < self._most)
            if self._error is not None:
                raise self._error

    def _run(self) -> None:
        while True:
            with self._changed:
                group = self._open[: self._most]
                if not group:
                    self._thread = None
                    self._changed.notify_all()
                    return
            try:
                self._work(group)
            except BaseException as error:  # raised by `put` and `join`
                with self._changed:
                    self._error, self._thread = error, None
                    self._changed.notify_all()
                return
            with self._changed:
                del self._open[: len(group)]
                self._changed.notify_all()

    @property
    def busy(self) -> bool:
        return self._thread is not None

    def join(self, timeout: float | None = None) -> bool:
        """Wait until nothing is worked on; whether that came in time."""
        with self._changed:
            ended = self._changed.wait_for(lambda: self._thread is None, timeout)
            if self._error is not None:
                raise self._error
            return ended


class DisqusStream(StreamingQuery):
    """A stream that has ended when all its micro-batches are committed."""

    def __init__(self, query: StreamingQuery, commits: _Commits):
        super().__init__(query._jsq)
        self._commits = commits

    @property
    def isActive(self) -> bool:
        return super().isActive or self._commits.busy

    def awaitTermination(self, timeout: float | None = None) -> bool | None:
        until = None if timeout is None else time.monotonic() + timeout
        try:
            ended = super().awaitTermination(timeout)
        except BaseException:
            self._settle()
            raise
        if timeout is None:
            self._commits.join()
            return None
        return bool(ended) and self._commits.join(max(0.0, until - time.monotonic()))

    def processAllAvailable(self) -> None:
        super().processAllAvailable()
        self._commits.join()

    def stop(self) -> None:
        super().stop()
        self._settle()

    def _settle(self) -> None:
        """Wait for the group at work, so that a restart finds it either committed or left."""
        try:
            self._commits.join()
        except Exception:  # the stream's own end says more; what is open is taken by a restart
            pass


def files_of_batch(store: Store, checkpoint: str, number: int) -> list[str]:
    """The files of a micro-batch, empty and vanished ones too, by the stream's own record: addresses, percent-encoded.

    The checkpoint holds the offset up to which each micro-batch goes, and for each offset the files it stands for: in a
    log file of its own, or, where the log was compacted, in one with those of all offsets before, of which Spark reads
    what is wanted.
    """
    log = f"{checkpoint}/sources/0"

    def offset(batch: int) -> int:
        return json.loads(store.files.read(f"{checkpoint}/offsets/{batch}").splitlines()[-1])["logOffset"]

    first, last = (offset(number - 1) if number else -1), offset(number)
    names, paths, compacted = store.files.names(log), [], {}
    merged = sorted(int(name.removesuffix(".compact")) for name in names if name.endswith(".compact"))
    for wanted in range(first + 1, last + 1):
        if str(wanted) in names:
            lines = store.files.read(f"{log}/{wanted}").split("\n")
            paths += [json.loads(line)["path"] for line in lines if line.startswith("{")]
        else:
            compacted.setdefault(next(n for n in merged if n >= wanted), []).append(wanted)
    for holder, offsets in compacted.items():
        lines = store.spark.read.text(f"{log}/{holder}.compact").where(F.col("value").startswith("{"))
        entry = lines.select(F.from_json("value", _FILE_ENTRY).alias("e")).select("e.*")
        paths += [r.path for r in entry.where(F.col("batchId").between(offsets[0], offsets[-1])).select("path").collect()]
    return list(dict.fromkeys(paths))


def stream_disqus(
    store: Store,
    source_dir: str,
    files: DataFrame,
    checkpoint: str,
    crawl: str = DEFAULT_CRAWL,
    files_per_batch: int = FILES_PER_BATCH,
    suffix: str = WAT_SUFFIX,
    scripts_path: Sequence[str] = SCRIPTS_PATH,
    links_path: Sequence[str] = LINKS_PATH,
) -> StreamingQuery:
    """Scan all files below `source_dir` not seen under `checkpoint` yet, then stop.

    `files` is the manifest selection, written once; files it does not list are left out. Files
    count as new whatever their age: by default Spark passes over those a week older than the
    newest one. `files_per_batch` bounds the names a micro-batch brings to the driver; it paces the work and decides
    nothing else. A file that has gone or can't be read is recorded as failed, and `discover_disqus` with `retry_failed`
    takes it again. What the last micro-batches found is visible when `awaitTermination` returns.
    """
    spark = store.spark
    known = files.select("partition_idx", "partition_url", file_key(F.col("partition_url")).alias("file"))
    selection = f"{store.root}/selections/{store.new_batches()[0]}"
    known.write.parquet(selection)
    known = spark.read.schema(known.schema).parquet(selection)
    scan = disqus_scan(store, scripts_path, links_path)
    path = F.col("path")
    plain = F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)
    key = file_key(path)
    arrived = (
        spark.readStream.format("text")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*" + suffix)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", "36500d")
        .load(source_dir)
    )

    def settle(group: list[_MicroBatch]) -> None:
        done = store.committed()
        # Commits of single micro-batches, as they were once written, name their first batch only.
        group = [b for b in group if b.name not in done and f"{b.name}-000000" not in done]
        if not group:
            return
        series = group[0].name.rpartition("-")[0]
        passed = [b.name for b in group]
        arrivals = pa.table({"path": pa.array([p for b in group for p in b.paths], pa.string())})
        listed = spark.createDataFrame(arrivals).withColumn("path", plain).withColumn("file", key)
        chosen = known.withColumnRenamed("partition_url", "listed").join(listed, "file")
        chosen = chosen.select("partition_idx", "listed", F.col("path").alias("partition_url"), F.lit(False).alias("suspicious"))
        found = sorted(chosen.collect(), key=lambda r: (r.partition_idx, r.partition_url))
        if not found:
            store.commit([], series=series, passed=passed)
            return
        names = [r.partition_url for r in found]
        batches = [f"{group[0].name}-{part:06d}" for part in range(2 * len(names) + 1)]
        written, failed = scan_group(store, found, names, batches, scan)
        # Progress names files as the manifest does.
        failed = {r.listed: failed[r.partition_url] for r in found if r.partition_url in failed}
        read = wave_files(spark, [Row(partition_idx=r.partition_idx, partition_url=r.listed, suspicious=False) for r in found], failed)
        counts = found_per_file(store.batches("disqus_candidates", written))
        save_progress(store, "disqus_scan_progress", read, counts, crawl, written[0])
        store.commit(written, series=series, passed=passed)

    # What is open must be in the checkpoint still.
    retained = int(spark.conf.get("spark.sql.streaming.minBatchesToRetain")) - 2
    commits = _Commits(settle, max(1, min(wave_size(spark) // files_per_batch, retained)))

    def save(_: DataFrame, number: int) -> None:
        # The id of the query is kept in its checkpoint: a repeated micro-batch has the same name, another stream's has not.
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        commits.put(_MicroBatch(_name(query, number), files_of_batch(store, checkpoint, number)))

    for batch in _left_open(store, checkpoint):
        commits.put(batch)
    commits.join()
    query = (
        arrived.writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    return DisqusStream(query, commits)


def _name(query: str, number: int) -> str:
    return f"{query}-{number:08d}"


def _left_open(store: Store, checkpoint: str) -> list[_MicroBatch]:
    """Micro-batches that the stream's checkpoint counts as done and no commit settles: a driver was lost before."""
    numbers = lambda kind: {int(name) for name in store.files.names(f"{checkpoint}/{kind}") if name.isdigit()}
    offsets, ended = numbers("offsets"), sorted(numbers("commits"))
    if not ended:
        return []
    query, done = json.loads(store.files.read(f"{checkpoint}/metadata"))["id"], store.committed()
    there = [n for n in ended if n in offsets and (n == 0 or n - 1 in offsets)]
    left = [n for n in there if _name(query, n) not in done and f"{_name(query, n)}-000000" not in done]
    return [_MicroBatch(_name(query, n), files_of_batch(store, checkpoint, n)) for n in left]
