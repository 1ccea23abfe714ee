"""Exact encoding with a merge-type piece model, by backtracking, and decoding.

A text's spaces become U+2581, with one more in front. No piece holds that mark behind
another character, so runs between are encoded on their own. In a run, an Aho-Corasick
automaton finds every piece; from the left the longest piece is taken that goes with the piece
before it, which holds if merging the two pieces' characters anew gives just these two. If no
piece fits, the last one is given up for a shorter one, and the position is marked in a
bitfield of failed positions, so that none is tried twice. Characters without a piece become
byte pieces.

Defined cases: null text is empty and has the end id only; a null doc_id stays null; every row
gives one row, repeated ones too; texts of any length are encoded whole; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from talkscout.llm.shared import small_batches, texts_of

MARK = "▁"
CACHED_RUNS = 600_000
CACHED_PAIRS = 500_000
CACHED_CHARS = 64
RUNS = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n+")
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class PieceModel:
    """Encoder and decoder for one model file."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.rank: dict[str, int] = {}
        self.bytes: dict[int, int] = {}
        self.others: set[int] = set()
        self.as_bytes: list[bytes] = []
        self.end = model.eos_id()
        order = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.as_bytes.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.as_bytes.append(b" \xe2\x81\x87 " if model.is_unknown(i) else b"")
                self.others.add(i)
            else:
                order.append((-model.get_score(i), i, piece))
                self.as_bytes.append(piece.replace(MARK, " ").encode())
        if len(self.bytes) != 256 or any(MARK in piece.lstrip(MARK) for _, _, piece in order):
            raise ValueError("the model must have byte pieces, and the space mark only in front")
        order.sort()
        self.byte_ids = set(self.bytes.values())
        self.ids = {piece: i for _, i, piece in order}
        self.rank = {piece: n for n, (_, _, piece) in enumerate(order)}
        self.chars = {piece for piece in self.rank if len(piece) == 1}
        self.neighbours = {piece[i : i + 2] for piece in self.rank for i in range(len(piece) - 1)}
        self.halves: dict[str, tuple[str, str]] = {}
        self.automaton = ahocorasick.Automaton()
        for piece in self.rank:
            if len(piece) == 1:
                self.rank[piece] = -1  # there from the start
                self.automaton.add_word(piece, 1)
        for piece in self.rank:
            if len(piece) > 1 and len(halves := self.merged(piece, 2)) == 2:  # others are never the outcome of merging
                self.halves[piece] = tuple(halves)
                self.automaton.add_word(piece, len(piece))
        self.automaton.make_automaton()
        self.runs: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[tuple[str, str], bool] = {}

    def merged(self, text: str, least: int = 1) -> list[str]:
        """Plain merging until so many parts are left: the best pair first, the leftmost of equals."""
        parts = list(text)
        while len(parts) > least:
            best = min(((self.rank.get(a + b, len(self.rank)), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))))
            if best[0] == len(self.rank):
                break
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return parts

    def fits(self, left: str, right: str) -> bool:
        found = self.pairs.get((left, right))
        if found is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            found = self.pairs[left, right] = self.apart(left, right)
        return found

    def apart(self, left: str, right: str) -> bool:
        """Whether merging the characters of both pieces anew ends with these two.

        Goes back in the order of merges: of the two parts that meet at the border the later
        one is undone, and no merge across the border may come before the one undone.
        """
        rank, halves, before = self.rank, self.halves, len(self.rank)
        while rank.get(left + right, before) >= before:
            if rank[left] > rank[right]:
                before, left = rank[left], halves[left][1]
            elif len(right) > 1:
                before, right = rank[right] + 1, halves[right][0]  # of equal merges the left one comes first
            else:
                return True
        return False

    def backtrack(self, run: str) -> list[str]:
        """Pieces of a run whose characters all have pieces."""
        size, fits = len(run), self.fits
        ends: list[list[int]] = [[] for _ in range(size + 1)]  # per start, the ends of pieces, shortest first
        for last, length in self.automaton.iter(run):
            ends[last + 1 - length].append(last + 1)
        failed = bytearray(size // 8 + 1)
        pieces: list[str] = []
        taken: list[list[int]] = []  # per piece, the ends not yet tried at its start
        at, left = 0, ends[0]
        while at < size:
            last = pieces[-1] if pieces else None
            while left:
                end = left.pop()
                piece = run[at:end]
                if not failed[end >> 3] >> (end & 7) & 1 and (last is None or fits(last, piece)):
                    pieces.append(piece)
                    taken.append(left)
                    at, left = end, ends[end].copy()
                    break
            else:
                if not pieces:
                    raise ValueError("no encoding")
                failed[at >> 3] |= 1 << (at & 7)
                at -= len(pieces.pop())
                left = taken.pop()
        return pieces

    def encode_run(self, run: str) -> tuple[int, ...]:
        ids: list[int] = []
        start = 0
        for i, char in enumerate(run):
            if char not in self.chars:
                if i > start:
                    ids += map(self.ids.__getitem__, self.backtrack(run[start:i]))
                ids += map(self.bytes.__getitem__, char.encode("utf-8", "surrogatepass"))
                start = i + 1
        if start < len(run):
            ids += map(self.ids.__getitem__, self.backtrack(run[start:]))
        return tuple(ids)

    def encode(self, text: str) -> list[int]:
        """Ids of a text, without the end id."""
        ids: list[int] = []
        if not text:
            return ids
        known = self.runs
        for run in RUNS.findall(MARK + text.replace(" ", MARK)):
            found = known.get(run)
            ids += self.run_ids(run) if found is None else found
        return ids

    def run_ids(self, run: str) -> tuple[int, ...]:
        """Ids of a run, remembered; a closing mark that no piece holds behind its neighbour is encoded apart."""
        found = self.runs.get(run)
        if found is None:
            if run[-1] in ".," and len(run) > 1 and run[-2:] not in self.neighbours:
                found = self.run_ids(run[:-1]) + self.encode_run(run[-1])
            else:
                found = self.encode_run(run)
            if len(run) <= CACHED_CHARS:
                if len(self.runs) >= CACHED_RUNS:
                    self.runs.clear()
                self.runs[run] = found
        return found

    def decode(self, ids) -> str:
        """The text of ids; bytes that are not UTF-8 become U+FFFD, one each.

        Control ids have no text and part the bytes before from those behind.
        """
        parts, start = [], 0
        for at in [i for i, x in enumerate(ids) if x in self.others] if not self.others.isdisjoint(ids) else ():
            parts += [ids[start:at], ids[at : at + 1]]
            start = at + 1
        parts.append(ids[start:])
        texts = [self._decode(part) for part in parts]
        first = next((x for x in ids if x not in self.others or self.as_bytes[x]), None)
        text = "".join(texts)
        if first is not None and first not in self.others and first not in self.byte_ids and text.startswith(" "):
            return text[1:]
        return text

    def _decode(self, ids) -> str:
        data = b"".join(map(self.as_bytes.__getitem__, ids))
        try:
            return data.decode()
        except UnicodeDecodeError:
            return data.decode("utf-8", "one-by-one")


@functools.cache
def piece_model(path: str) -> PieceModel:
    """One model for all tasks of a worker process, with the runs it remembers."""
    return PieceModel(path)


def _one_by_one(error):
    return "�", error.start + 1


def _register() -> None:
    import codecs

    codecs.register_error("one-by-one", _one_by_one)


_register()


def digest_partition(path: str):
    """The function for `mapInArrow` over (doc_id, text): counts and digests of ids and decoded texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        names = {i: str(i) for i in range(len(model.as_bytes))}
        for batch in small_batches(batches, 512):
            counts, ids_digests, text_digests = [], [], []
            for text in texts_of(batch.column("text")):
                ids = model.encode(text.decode("utf-8", "replace"))
                ids.append(model.end)
                counts.append(len(ids))
                ids_digests.append(hashlib.sha256(" ".join(map(names.__getitem__, ids)).encode()).hexdigest())
                text_digests.append(hashlib.sha256(model.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_digests), pa.array(text_digests)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def encode_partition(path: str):
    """The function for `mapInArrow` over (doc_id, text): the ids themselves and the decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in small_batches(batches, 256):
            ids = [[*model.encode(t.decode("utf-8", "replace")), model.end] for t in texts_of(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array([model.decode(x) for x in ids], pa.string())],
                names=["doc_id", "ids", "decoded"],
            )

    return run


def encoded(documents: DataFrame, model_path: str) -> DataFrame:
    """Per document: ids with the end id, and their decoded text."""
    rows = documents.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
    return rows.mapInArrow(encode_partition(model_path), "doc_id long, ids array<int>, decoded string")


def encoding_digests(documents: DataFrame, model_path: str) -> DataFrame:
    """Per document: count and digest of the ids, and the digest of their decoded text."""
    rows = documents.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
    return rows.mapInArrow(digest_partition(model_path), DIGESTS)
