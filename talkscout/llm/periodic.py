"""Runs of repeated words, by recompression.

A run is a stretch of words with smallest period q, of length max(6, 4 q) or more, that no word next to
it extends. Documents are taken in groups of bounded size (a longer document alone), their words numbered
and laid out one behind the other, with a number of its own between any two. This sequence is
recompressed: by turns every block of one symbol becomes a symbol (symbol, count), and every pair of a left
and a right symbol becomes a symbol for the pair, until little is left. That is a run-length grammar of
the sequence, and as both steps look at neighbours only, equal stretches get equal symbols but for
their ends.

The longest common extension of two places is found on the levels of the grammar: up, symbol by symbol, as long
as both places begin symbols of the next level, and, from the first two that differ, down again. On each level
that takes a few comparisons; the queries of a group go through the levels together, forward and backward.
A run of period q is at least 4 q long, so on a grid of step 2 q some place x has x + 2 q within the run
as well: the places x and x + q with equal words are the candidates, and their extensions the run's exact ends. Candidates
inside a run already found whose period divides q would give that run again and are passed over; a stretch found with several periods
has the smallest.

Defined cases: a null text is empty; null and blank texts have no run, four nulls and the digests of the empty string; a null
doc_id counts as the empty string where ids are hashed; repeated rows are independent; a text of any length is taken whole, by one
task; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from talkscout.llm.shared import small_batches, texts_of

LEAST_LENGTH, LEAST_POWER = 6, 4
GROUP_WORDS = 200_000
GROUP_ROWS = 2_000
QUERIES_AT_ONCE = 500_000
TOP = 8
RUNS = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string, n_words long, n_kept long"
)


class Level(NamedTuple):
    """Symbols of a level, and for each its first and last symbol on the level below; `parent` leads there from below."""

    symbols: np.ndarray
    first: np.ndarray
    last: np.ndarray
    parent: np.ndarray
    blocks: bool


def _sides(symbols: np.ndarray, salt: int) -> np.ndarray:
    """Whether a symbol is a left one: a bit of its hash."""
    mixed = (symbols.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(40)) & np.uint64(1) == 1


class Grammar:
    """The levels of a sequence's recompression, from the sequence itself on.

    Its first and its last number must occur once, and numbers must lie in [0, 2**31).
    """

    def __init__(self, sequence: np.ndarray):
        none = np.empty(0, np.int64)
        self.levels = [Level(sequence, none, none, none, False)]
        used, salt = int(sequence.max()) + 1, 0
        while len(symbols := self.levels[-1].symbols) > TOP:
            if salt % 2 == 0:
                starts = np.concatenate([[True], symbols[1:] != symbols[:-1]])
            else:
                left = _sides(symbols, salt)
                starts = np.concatenate([[True], ~(left[:-1] & ~left[1:])])
            first = np.flatnonzero(starts)
            last = np.append(first[1:] - 1, len(symbols) - 1)
            upper = symbols[first]
            many = np.flatnonzero(last > first)
            if len(many):
                # The rule of a new symbol: a symbol and how often, or the two of a pair.
                second = last[many] - first[many] + 1 if salt % 2 == 0 else symbols[last[many]]
                rules, names = np.unique(upper[many] << 32 | second, return_inverse=True)
                upper[many] = used + names
                used += len(rules)
            if len(many) or salt % 2:
                self.levels.append(Level(upper, first, last, np.cumsum(starts) - 1, salt % 2 == 0))
            salt += 1

    def extensions(self, a: np.ndarray, b: np.ndarray, back: bool = False) -> np.ndarray:
        """How many numbers from places a and b on are equal, for pairs a < b; backward counts a and b as well."""
        step = -1 if back else 1
        at_a, at_b = a.copy(), b.copy()
        where = np.zeros(len(a), np.int64)  # the level on which the two symbols differ
        going = np.arange(len(a))
        for h, level in enumerate(self.levels):
            symbols = level.symbols
            if h + 1 == len(self.levels):
                going = self._differing(symbols, at_a, at_b, going, step, where, h)
                break
            upper = self.levels[h + 1]
            edge, other = (upper.last, upper.first) if back else (upper.first, upper.last)
            begun = np.empty(0, np.int64)  # queries at edges of the next level with both places
            while len(going):
                x, y = at_a[going], at_b[going]
                up_x, up_y = upper.parent[x], upper.parent[y]
                ready = (edge[up_x] == x) & (edge[up_y] == y)
                begun = np.concatenate([begun, going[ready]])
                wait = ~ready
                going, x, y, up_x, up_y = going[wait], x[wait], y[wait], up_x[wait], up_y[wait]
                equal = symbols[x] == symbols[y]
                where[going[~equal]] = h
                going = going[equal]
                if upper.blocks:  # to the nearer end of the two blocks at once
                    x, y, up_x, up_y = x[equal], y[equal], up_x[equal], up_y[equal]
                    move = step * (np.minimum(step * (other[up_x] - x), step * (other[up_y] - y)) + 1)
                else:
                    move = step
                at_a[going] += move
                at_b[going] += move
            at_a[begun] = upper.parent[at_a[begun]]
            at_b[begun] = upper.parent[at_b[begun]]
            going = begun
        for h in range(len(self.levels) - 1, 0, -1):
            level, lower = self.levels[h], self.levels[h - 1].symbols
            edge = level.last if back else level.first
            down = np.flatnonzero(where == h)
            if not len(down):
                continue
            x, y = at_a[down], at_b[down]
            if level.blocks:
                count_x, count_y = level.last[x] - level.first[x] + 1, level.last[y] - level.first[y] + 1
                x, y = edge[x], edge[y]
                move = np.where(lower[x] == lower[y], np.minimum(count_x, count_y), 0) * step
                at_a[down], at_b[down] = x + move, y + move
                where[down] = h - 1
            else:
                at_a[down], at_b[down] = edge[x], edge[y]
                self._differing(lower, at_a, at_b, down, step, where, h - 1)
        return (at_a - a) * step

    @staticmethod
    def _differing(symbols, at_a, at_b, going, step, where, h) -> np.ndarray:
        """Step on until symbols differ; both ends of the sequence differ from all else."""
        while len(going):
            equal = symbols[at_a[going]] == symbols[at_b[going]]
            where[going[~equal]] = h
            going = going[equal]
            at_a[going] += step
            at_b[going] += step
        return going


def _candidates(sequence: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) of the grid for periods up to `most`, whose words are equal; in portions, by period."""
    places, periods, held = [], [], 0
    for q in range(1, most + 1):
        here = sequence[: len(sequence) - q : 2 * q]
        equal = np.flatnonzero(here == sequence[q :: 2 * q][: len(here)])
        for start in range(0, len(equal), QUERIES_AT_ONCE):
            part = equal[start : start + QUERIES_AT_ONCE] * (2 * q)
            places.append(part)
            periods.append(np.full(len(part), q))
            held += len(part)
            if held >= QUERIES_AT_ONCE:
                yield np.concatenate(places), np.concatenate(periods)
                places, periods, held = [], [], 0
    if held:
        yield np.concatenate(places), np.concatenate(periods)


def find_runs(sequence: np.ndarray, longest: int) -> np.ndarray:
    """Rows (start, period, length) of all runs, by start and period; `longest` is the greatest number of words of a document.

    The sequence's ends, and the places between documents, must hold numbers that occur once.
    """
    grammar = Grammar(sequence)
    period_of = np.ones(len(sequence), np.int64)  # of a run over a place, and where that run ends
    end_of = np.zeros(len(sequence), np.int64)
    found = []
    for places, periods in _candidates(sequence, longest // LEAST_POWER):
        new = (periods % period_of[places] != 0) | (end_of[places] < places + 2 * periods)
        places, periods = places[new], periods[new]
        if not len(places):
            continue
        start = places - grammar.extensions(places - 1, places + periods - 1, back=True)
        length = grammar.extensions(places, places + periods) + periods + places - start
        long = length >= np.maximum(LEAST_LENGTH, LEAST_POWER * periods)
        if not long.any():
            continue
        runs = np.unique(np.stack([start[long], length[long], periods[long]], axis=1), axis=0)
        runs = runs[np.concatenate([[True], (runs[1:, :2] != runs[:-1, :2]).any(axis=1)])]  # of a stretch, the smallest period
        found.append(runs)
        for s, n, q in runs.tolist():
            if end_of[s] < s + n:
                period_of[s : s + n], end_of[s : s + n] = q, s + n
    if not found:
        return np.empty((0, 3), np.int64)
    runs = np.unique(np.concatenate(found), axis=0)
    runs = runs[np.concatenate([[True], (runs[1:, :2] != runs[:-1, :2]).any(axis=1)])]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))][:, [0, 2, 1]]


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words, with a stretch repeated to the end in one of ten documents."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    times = -(-(n - a) // p)
    return words[:a] + (words[a : a + p] * times)[: n - a]


def _layout(documents: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all words, with numbers that occur once before, between and behind; and where documents begin."""
    words = pa.array([word for document in documents for word in document], pa.large_binary())
    codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.array([len(document) for document in documents])
    starts = np.cumsum(sizes + 1) - sizes
    sequence = np.empty(len(codes) + len(documents) + 1, np.int64)
    between = np.append(starts - 1, len(sequence) - 1)
    inside = np.ones(len(sequence), bool)
    inside[between] = False
    sequence[inside] = codes
    sequence[between] = len(codes) + np.arange(len(between))
    return sequence, starts


def runs_of(documents: list[list[bytes]]) -> list[np.ndarray]:
    """Per document the rows (start, period, length) of its runs, by start and period."""
    sequence, starts = _layout(documents)
    runs = find_runs(sequence, max(map(len, documents)))
    at = np.searchsorted(runs[:, 0], starts)
    runs[:, 0] -= starts[np.searchsorted(starts, runs[:, 0], side="right") - 1]
    return np.split(runs, at[1:])


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words that are in no run behind its first period."""
    if not len(runs):
        return words
    marks = np.zeros(len(words) + 1, np.int64)
    np.add.at(marks, runs[:, 0] + runs[:, 1], 1)
    np.add.at(marks, runs[:, 0] + runs[:, 2], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(marks[:-1]) == 0).tolist()]


def _row(doc_id: int | None, words: list[bytes], runs: np.ndarray) -> tuple:
    lines = b"".join(b"%d,%d,%d\n" % (start, length, period) for start, period, length in runs.tolist())
    kept = collapsed(words, runs)
    top = min(runs.tolist(), key=lambda r: (-r[2], r[0], r[1])) if len(runs) else None
    start, period, length = top or (None, None, None)
    milli = 1000 * length // period if top else None
    digests = [hashlib.sha256(x).hexdigest() for x in (lines, b" ".join(kept))]
    return doc_id, len(runs), start, length, period, milli, *digests, len(words), len(kept)


def _report(plant: bool):
    kinds = {"long": pa.int64(), "string": pa.string()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in RUNS.split(", "))])

    def rows(ids: list, documents: list[list[bytes]]) -> pa.RecordBatch:
        found = [_row(*x) for x in zip(ids, documents, runs_of(documents), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, documents, held = [], [], 0
        for batch in small_batches(batches, 256):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch.column("text")), strict=True):
                words = text.split()  # at \x20 and \x09-\x0D
                if ids and (held + len(words) > GROUP_WORDS or len(ids) >= GROUP_ROWS):
                    yield rows(ids, documents)
                    ids, documents, held = [], [], 0
                ids.append(doc_id)
                documents.append(planted(words, doc_id) if plant else words)
                held += len(words)
        if ids:
            yield rows(ids, documents)

    return run


def periodic_runs(documents: DataFrame, plant: bool = False) -> DataFrame:
    """Per document: number of runs, the longest one, and digests of all runs and of the text without their repetitions.

    With `plant`, one of ten documents first gets a stretch repeated to its end.
    """
    return documents.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(_report(plant), RUNS)
