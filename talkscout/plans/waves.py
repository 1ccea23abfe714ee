"""Scanning the files of a run in waves, some of which may be unreadable."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

# Spark error conditions that blame an input file, not the cluster.
_FILE_FAULT = re.compile(r"\[(?:FAILED_READ_FILE|PATH_NOT_FOUND|CANNOT_READ_FILE_FOOTER)[^\n]*")

_WAVES_OF_TASKS = 4
_ERROR_CHARS = 300


class UnreadableWave(RuntimeError):
    """No file of a wave could be read: the fault is more likely with the address or the access than with the files."""


def wave_size(spark: SparkSession, size: int | None = None) -> int:
    """Files per wave. Waves are committed one after the other.

    A wave keeps all cores busy several times over, and is the most a failure can cost.
    """
    return size or _WAVES_OF_TASKS * spark.sparkContext.defaultParallelism


def scan_readable(paths: Sequence[str], scan: Callable[[Sequence[str], int], None]) -> tuple[int, dict[str, str]]:
    """Call `scan(paths, part)` so that every readable file is in exactly one finished part.

    Normally there is one part with all files. When Spark, after its own task retries,
    reports a file it cannot read, that file is left out and the rest is tried again in one
    go; a report that names none of the files is narrowed down by halving.
    A file is never taken in part. Returns the number of parts, and unreadable files with the error.
    """
    pending, parts, unreadable = [list(paths)] if paths else [], 0, {}
    while pending:
        group = pending.pop(0)
        try:
            scan(group, parts)
            parts += 1
        except (PySparkException, Py4JJavaError) as error:
            fault = _FILE_FAULT.search(str(error))
            if fault is None:
                raise
            bad = _named(group, fault.group()) if len(group) > 1 else group
            unreadable.update(dict.fromkeys(bad, fault.group()[:_ERROR_CHARS]))
            rest = [p for p in group if p not in bad]
            middle = len(rest) if bad else (len(rest) + 1) // 2
            pending[:0] = [part for part in (rest[:middle], rest[middle:]) if part]
    return parts, unreadable


def _named(paths: Sequence[str], report: str) -> list[str]:
    """The file an error report names, if it is one of `paths`."""
    keys = {p: re.sub(r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?/*", "", p) for p in paths}
    return sorted((p for p in paths if keys[p] in report), key=len)[-1:]
