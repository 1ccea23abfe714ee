"""Result tables on shared storage.

Each table is a log of batches and, once it was compacted, a snapshot of its current rows. A batch has an
id of its own (of a run, or of a stream's micro-batch) and its own folder below each table it has rows for, so a
repeated batch replaces only itself. Readers see it once it is in the commit log, which is written last.
All tables of a batch thus appear together, and what a lost run left behind stays invisible.

The commit log numbers batches in the order of their first commit; that order, not a clock
or an id, says which row of a key is the first or the last. Drivers may commit at the same moment: a
commit takes its number by creating that number's file, so all of them see one order. Batches committed
as a series (the micro-batches of a stream) have one place in that order, the first one's, and inside it the
partition decides, so that it does not matter in which order files arrived.

A snapshot holds one row per key in folders by a hash of the key, with the row's place in the history. `compact` merges
the batches committed since into the folders whose keys they have, and leaves the others as
they are. A reader takes the snapshot as it is, without a shuffle, and looks at its keys only for the batches since. `vacuum` deletes
what no reader needs any more.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkscout.plans.commits import CommitLog, SharedFiles

_SCAN_PROGRESS = (
    "crawl STRING, partition_idx BIGINT, partition_url STRING, candidates_found BIGINT, scanned_at TIMESTAMP, "
    "status STRING, error STRING"
)

TABLES = {
    "wp_candidates": "domain STRING, hostname STRING, sample_url STRING",
    "disqus_candidates": "domain STRING, hostname STRING, sample_url STRING, disqus_shortname STRING",
    "results": (
        "domain STRING, wp_confirmed BIGINT, comments_endpoint BIGINT, comment_count_hint BIGINT, "
        "api_root STRING, error STRING"
    ),
    "pages": "domain STRING, post_id BIGINT, url STRING, title STRING, comment_count_in_sample BIGINT",
    "waiting": "domain STRING, waits BIGINT",
    "wp_scan_progress": _SCAN_PROGRESS,
    "disqus_scan_progress": _SCAN_PROGRESS,
}

KEYS = {
    "wp_candidates": ["domain"],
    "disqus_candidates": ["domain"],
    "results": ["domain"],
    "pages": ["domain", "post_id"],
    "waiting": ["domain"],
    "wp_scan_progress": ["crawl", "partition_idx"],
    "disqus_scan_progress": ["crawl", "partition_idx"],
}

_INSERT_OR_IGNORE = ("wp_candidates", "disqus_candidates")
# A row's place: number of its batch, of the series its batch belongs to, and its own in the batch.
_PLACE_DDL = "seq BIGINT, run BIGINT, ordinal BIGINT"
_PLACE = ("seq", "run", "ordinal")
_BATCHES = pa.schema([("batch_id", pa.string()), ("seq", pa.int64()), ("run", pa.int64())])

# Batches of one commit that can be told apart by number.
_BATCH_BITS = 24

#: Folders of a snapshot. A folder is what one task merges, so a larger table wants more.
BUCKETS = 32
#: A superseded folder may still be read by jobs that began before; it is kept this long.
GRACE_SECONDS = 7 * 24 * 3600.0


class Snapshot(NamedTuple):
    """Current rows of a table after the commits up to `upto`, those `skipped` left out: folder by bucket."""

    number: int
    upto: int
    skipped: frozenset[int]
    buckets: int
    folders: dict[int, str]

    def covers(self, number: int) -> bool:
        return number <= self.upto and number not in self.skipped


def _names(ddl: str) -> list[str]:
    return [field.split()[0] for field in ddl.split(", ")]


class Store:
    """Tables below one root folder that all executors can reach."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.files = SharedFiles(spark, self.root)
        self.commits = CommitLog(self.files, f"{self.root}/commits")

    # --- writing ---

    def new_batches(self, count: int = 1) -> list[str]:
        """Unused batch ids."""
        run = uuid.uuid4().hex
        return [f"{run}-{i:08d}" for i in range(count)]

    def append(self, table: str, rows: DataFrame, batch_id: str) -> None:
        """Write the rows of one batch: the table's columns and `ordinal`. Not visible yet."""
        columns = ["ordinal", *_names(TABLES[table])]
        rows.select(*columns).write.mode("overwrite").parquet(f"{self.root}/{table}/batch_id={batch_id}")

    def commit(self, batch_ids: Sequence[str], series: str | None = None, passed: Sequence[str] = ()) -> int:
        """Make batches visible, all at once, in the given order behind all committed before; returns the commit's number.

        Batches of one `series` count as committed with its first one, in the order of their rows' `ordinal`. `passed` names
        what the commit settles besides, as `is_committed` then says.
        """
        more = {"passed": list(passed)} if passed else {}
        return self.commits.append({"batches": list(batch_ids), "series": series, **more})

    def is_committed(self, batch_id: str) -> bool:
        return batch_id in self.committed()

    def committed(self) -> set[str]:
        """All batches committed, and what commits passed."""
        commits = self.commits.commits().values()
        return {name for commit in commits for name in (*commit.get("batches", ()), *commit.get("passed", ()))}

    # --- reading ---

    def _places(self, commits: dict[int, dict]) -> dict[str, tuple[int, int, int]]:
        """(seq, run, number of the commit) of each committed batch, by its first commit."""
        places, series = {}, {}
        for number, commit in commits.items():
            for i, batch in enumerate(commit.get("batches", ())):
                seq, name = number << _BATCH_BITS | i, commit["series"]
                run = series.setdefault(name, seq) if name else seq
                places.setdefault(batch, (seq, run, number))
        return places

    def _snapshot(self, table: str, commits: dict[int, dict]) -> Snapshot | None:
        """The table's snapshot that covers most."""
        found = [
            Snapshot(n, c["upto"], frozenset(c["skipped"]), c["buckets"], {int(k): v for k, v in c["folders"].items()})
            for n, c in commits.items()
            if c.get("snapshot") == table
        ]
        return max(found, key=lambda s: (s.upto, s.number), default=None)

    def _batch_rows(self, table: str, batch_ids: Sequence[str]) -> DataFrame:
        """Rows of the given batches, as far as they have any for the table."""
        names = {f"batch_id={batch}" for batch in batch_ids}
        paths = [f"{self.root}/{table}/{name}" for name in self.files.names(f"{self.root}/{table}") if name in names]
        ddl = f"ordinal BIGINT, {TABLES[table]}, batch_id STRING"
        if not paths:
            return self.spark.createDataFrame([], ddl)
        return self.spark.read.schema(ddl).option("basePath", f"{self.root}/{table}").parquet(*paths)

    def batches(self, table: str, batch_ids: Sequence[str]) -> DataFrame:
        """Rows of the given batches, committed or not."""
        return self._batch_rows(table, batch_ids)

    def _parts(self, table: str, commits: dict[int, dict]) -> tuple[Snapshot | None, DataFrame | None]:
        """The snapshot, and the rows of batches it doesn't cover with their places, if there are such batches."""
        snapshot = self._snapshot(table, commits)
        places = self._places(commits)
        since = [(b, seq, run) for b, (seq, run, n) in places.items() if snapshot is None or not snapshot.covers(n)]
        if snapshot is not None and not since:
            return snapshot, None
        rows = [dict(zip(_BATCHES.names, row, strict=True)) for row in since]
        known = self.spark.createDataFrame(pa.Table.from_pylist(rows, _BATCHES))
        # The list has a row of three short fields for each batch since the snapshot.
        return snapshot, self._batch_rows(table, [b for b, *_ in since]).join(known, "batch_id")

    def _snapshot_rows(self, table: str, snapshot: Snapshot, buckets: Sequence[int] | None = None) -> DataFrame:
        ddl = f"{_PLACE_DDL}, {TABLES[table]}"
        kept = [k for k in sorted(snapshot.folders) if buckets is None or k in buckets]
        paths = [f"{self.root}/snapshots/{table}/{snapshot.folders[k]}/bucket={k}" for k in kept]
        return self.spark.read.schema(ddl).parquet(*paths) if paths else self.spark.createDataFrame([], ddl)

    def _best(self, table: str, rows: DataFrame, *more: str) -> DataFrame:
        """One row per key, the first or the last, with its place; `more` are columns that the key decides."""
        pick, order = (F.min, ("run", "ordinal", "seq")) if table in _INSERT_OR_IGNORE else (F.max, ("seq", "ordinal", "run"))
        keys, columns = KEYS[table], _names(TABLES[table])
        row = pick(F.struct(*order, *(c for c in columns if c not in keys))).alias("row")
        found = rows.groupBy(*more, *keys).agg(row)
        return found.select(*more, *(f"row.{c}" for c in _PLACE), *(c if c in keys else f"row.{c}" for c in columns))

    def log(self, table: str) -> DataFrame:
        """All rows of a table that are visible, with their place in its history; of a snapshot, the rows it kept."""
        snapshot, since = self._parts(table, self.commits.commits())
        columns = [*_PLACE, *_names(TABLES[table]), "batch_id"]
        if snapshot is None:
            return since.select(*columns)
        rows = self._snapshot_rows(table, snapshot).withColumn("batch_id", F.lit(f"snapshot-{snapshot.number}"))
        return rows.select(*columns) if since is None else rows.select(*columns).unionByName(since.select(*columns))

    def table(self, name: str) -> DataFrame:
        """Current rows of a table, one per key."""
        columns = _names(TABLES[name])
        return self._current(name, *self._parts(name, self.commits.commits())).select(*columns)

    def _current(self, name: str, snapshot: Snapshot | None, since: DataFrame | None) -> DataFrame:
        if snapshot is None:
            return self._best(name, since)
        rows = self._snapshot_rows(name, snapshot)
        if since is None:
            return rows
        # Only keys of the batches since are looked at again; the others pass as they are.
        new = self._best(name, since)
        met = _same_keys(rows, new, KEYS[name], "left_semi")
        rest = _same_keys(rows, new, KEYS[name], "left_anti")
        return rest.unionByName(self._best(name, met.unionByName(new)))

    # --- upkeep ---

    def compact(self, name: str) -> None:
        """Merge the batches committed so far into the table's snapshot.

        Others may commit and compact meanwhile: what they commit is not in this snapshot and is read
        beside it, and of two snapshots the one that covers more counts.
        """
        commits = self.commits.commits()
        upto = max(commits, default=-1)
        snapshot, since = self._parts(name, commits)
        if since is None:
            return
        buckets = snapshot.buckets if snapshot else self.buckets
        bucket = F.pmod(F.xxhash64(*KEYS[name]), F.lit(buckets)).cast("int")
        new = self._best(name, since)
        if snapshot:
            touched = [r.bucket for r in since.select(bucket.alias("bucket")).distinct().collect()]  # at most `buckets`
            new = self._snapshot_rows(name, snapshot, touched).unionByName(new)
        folder = uuid.uuid4().hex
        path = f"{self.root}/snapshots/{name}/{folder}"
        # Dealt by bucket, the rows of a key are together: the aggregation takes no further shuffle.
        placed = new.withColumn("bucket", bucket).repartition(buckets, "bucket")
        self._best(name, placed, "bucket").write.partitionBy("bucket").parquet(path)
        written = {int(e.name.removeprefix("bucket=")): folder for e in self.files.entries(path) if e.name.startswith("bucket=")}
        skipped = sorted(set(range(upto + 1)) - commits.keys())
        folders = {**(snapshot.folders if snapshot else {}), **written}
        self.commits.append({"snapshot": name, "upto": upto, "skipped": skipped, "buckets": buckets, "folders": folders})

    def vacuum(self, grace_seconds: float = GRACE_SECONDS) -> list[str]:
        """Delete folders that nothing refers to any more and that are older than the grace time; returns their names.

        These are batches that a snapshot stands for, batches never committed, folders of earlier snapshots, and what
        runs and streams wrote down for themselves. The grace time must be longer than any run, stream or reading job.
        """
        limit = time.time() * 1000 - grace_seconds * 1000
        commits = self.commits.commits()
        places = self._places(commits)
        old: list[str] = []
        for table in TABLES:
            snapshot = self._snapshot(table, commits)
            settled = snapshot is not None and self.commits.changed(snapshot.number) <= limit
            kept = {b for b, (_, _, n) in places.items() if not (settled and snapshot.covers(n))}
            old += [f"{table}/{e.name}" for e in self.files.entries(f"{self.root}/{table}") if e.name.removeprefix("batch_id=") not in kept]
            if settled:
                used = set(snapshot.folders.values())
                old += [f"snapshots/{table}/{e.name}" for e in self.files.entries(f"{self.root}/snapshots/{table}") if e.name not in used]
        for kind in ("selections", "scanned"):
            old += [f"{kind}/{e.name}" for e in self.files.entries(f"{self.root}/{kind}")]
        gone = [name for name in old if self.files.changed(f"{self.root}/{name}") <= limit]
        for name in gone:
            self.files.delete(f"{self.root}/{name}")
        return gone


def _same_keys(rows: DataFrame, other: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Rows whose key is, or isn't, among the others'; null keys are equal."""
    a, b = rows.alias("a"), other.select(*keys).alias("b")
    same = F.lit(True)
    for key in keys:
        same = same & F.equal_null(F.col(f"a.{key}"), F.col(f"b.{key}"))
    return a.join(b, same, how)
