"""Token counts by a two-tier lookup on the map side.

The tokenizer drops white space and never joins across it, so a pre-token is here a run between
ASCII white space: the tokens of a text are those of its runs added up, and no run has to meet its
like in a shuffle. The first tier is a compact table of the most frequent runs' lengths in tokens, broadcast
to all tasks; the second is a cache in each worker, filled by encoding the runs that the table lacks.

Which runs are frequent is counted over all documents: every task keeps a summary of at most
FREQUENT runs (when there are too many, the counts are lowered until so many remain), and
the summaries are merged by files, FAN_IN at a time, without a shuffle. The table only saves work:
counts are those of the tokenizer whatever it holds.

Defined cases: null and empty texts have no bytes and no tokens; a null doc_id stays null; every row gives one
row, repeated ones too; special strings inside a text count as the tokenizer takes them by default; texts and
runs of any length are counted whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from talkscout.llm.shared import shared_folder, small_batches, texts_of, written

#: The table's bound: so many runs, of so many bytes at most.
FREQUENT = 1 << 16
LONGEST = 32
FAN_IN = 32
CACHED_RUNS = 500_000
CACHED_BYTES = 64
LIMIT = 2048
SUMMARY = "runs binary, counts array<long>"
COUNTS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


class LengthTable(NamedTuple):
    """Frequent runs, joined by spaces, and their lengths as 16-bit numbers."""

    runs: bytes
    lengths: bytes


class RunCounter:
    """Tokens per run: the table's lengths, and those of runs met and encoded since."""

    def __init__(self, path: str, table: LengthTable = LengthTable(b"", b"")):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.frequent = dict(zip(table.runs.split(), np.frombuffer(table.lengths, "<u2").tolist(), strict=True))
        self.lengths = self.frequent.copy()
        if self.encode([b"a b", b"\n", b"a", b"b"]) != [2, 0, 1, 1]:
            raise ValueError("the tokenizer must part texts at white space and drop it")

    def encode(self, runs: list[bytes]) -> list[int]:
        texts = [run.decode("utf-8", "replace") for run in runs]
        return [len(x) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def count(self, texts: Iterable[bytes]) -> list[int]:
        """Tokens of each text."""
        split = [text.split() for text in texts]
        lengths = self.lengths
        missed = list(set().union(*split) - lengths.keys())
        if missed:
            if len(lengths) + len(missed) > len(self.frequent) + CACHED_RUNS:
                lengths = self.lengths = self.frequent.copy()
                missed = list(set().union(*split) - lengths.keys())
            long = [run for run in missed if len(run) > CACHED_BYTES]
            for start in range(0, len(missed), 4096):
                part = missed[start : start + 4096]
                lengths.update(zip(part, self.encode(part), strict=True))
        found = [sum(map(lengths.__getitem__, runs)) for runs in split]
        if missed:
            for run in long:  # these would take too much room
                del lengths[run]
        return found


#: The counter of a worker process, for the table it was made with.
_counters: dict[tuple[str, str], RunCounter] = {}


def _counter(path: str, name: str, table) -> RunCounter:
    """One counter for all tasks of a worker process that use this table."""
    if (path, name) not in _counters:
        _counters.clear()
        _counters[path, name] = RunCounter(path, table.value)
    return _counters[path, name]


def lowered(counts: dict[bytes, int], most: int) -> dict[bytes, int]:
    """At most so many runs: all counts are lowered by the largest that has to go."""
    if len(counts) <= most:
        return counts
    values = np.fromiter(counts.values(), np.int64, len(counts))
    least = int(np.partition(values, len(values) - most - 1)[len(values) - most - 1])
    return {run: n - least for run, n in counts.items() if n > least}


def _summary(counts: dict[bytes, int]) -> pa.RecordBatch:
    runs, n = pa.array([b" ".join(counts)], pa.binary()), pa.array([list(counts.values())], pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([runs, n], names=["runs", "counts"])


def _summarise(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in small_batches(batches, 256):
            counts.update(chain.from_iterable(text.split() for text in texts_of(batch.column("text"))))
            if len(counts) > 4 * most:
                counts = Counter(lowered({r: n for r, n in counts.items() if len(r) <= LONGEST}, most))
        kept = lowered({r: n for r, n in counts.items() if len(r) <= LONGEST}, most)
        if kept:
            yield _summary(kept)

    return run


def _merge(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in small_batches(batches, 1):
            for runs, n in zip(batch.column("runs").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                for word, c in zip(runs.split(), n, strict=True):
                    counts[word] += c
                counts = Counter(lowered(counts, most))
        if counts:
            yield _summary(counts)

    return run


def _measure(path: str):
    """From the last summary: the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counter = RunCounter(path)
            for runs in batch.column("runs").to_pylist():
                lengths = [n for part in _parts(runs.split(), 4096) for n in counter.encode(part)]
                columns = [pa.array([runs], pa.binary()), pa.array([np.array(lengths, "<u2").tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["runs", "lengths"])

    return run


def _parts(items: list, size: int) -> Iterator[list]:
    for start in range(0, len(items), size):
        yield items[start : start + size]


def learn_table(documents: DataFrame, tokenizer_path: str, most: int = FREQUENT) -> LengthTable:
    """Lengths of the most frequent runs of all documents: at most `most`, of LONGEST bytes at most."""
    folder, level = shared_folder(documents.sparkSession), 0
    rows = written(documents.select("text").mapInArrow(_summarise(most), SUMMARY), folder, "summaries0")
    while (files := len(rows.inputFiles())) > 1:
        level += 1
        rows = written(rows.coalesce(-(-files // FAN_IN)).mapInArrow(_merge(most), SUMMARY), folder, f"summaries{level}")
    # One file is left, and one row of at most `most` runs.
    last = rows.coalesce(1).mapInArrow(_merge(most), SUMMARY).mapInArrow(_measure(tokenizer_path), "runs binary, lengths binary").first()
    return LengthTable(bytes(last.runs), bytes(last.lengths)) if last else LengthTable(b"", b"")


def _count(path: str, name: str, table, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path, name, table)
        for batch in small_batches(batches, 256):
            texts = texts_of(batch.column("text"))
            tokens = counter.count(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(map(len, texts), pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return run


def count_tokens(documents: DataFrame, tokenizer_path: str, limit: int = LIMIT, most: int = FREQUENT) -> DataFrame:
    """Per document: bytes in UTF-8, tokens, and whether these are more than `limit`."""
    spark = documents.sparkSession
    table = spark.sparkContext.broadcast(learn_table(documents, tokenizer_path, most))
    rows = documents.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
    return rows.mapInArrow(_count(tokenizer_path, uuid.uuid4().hex, table, limit), COUNTS)
