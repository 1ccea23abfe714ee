"""Hierarchical multi-length packing of tokenised documents.

Each task packs the documents it scans, in pools of bounded size: there is no shuffle, no
group and nothing on the driver. Of a document, whole windows of the longest tier are cut
off; the rest goes to the tier of the smallest window that holds it. Windows are filled from
the longest tier down: the largest document opens a window, shorter tiers fill its gap with
whole documents (largest that fits first), and the last gap takes a piece cut from the
shortest. What a pool leaves open goes on to the next, so that a task pads one window only.
Finished windows are dealt to step groups of about equal token counts.

Defined cases: null text is empty and has the end id only; a null doc_id is carried as null;
repeated rows are packed as often as they occur; an empty table gives no pieces; other
columns are ignored.
"""

from __future__ import annotations

import bisect
import functools
import heapq
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from talkscout.llm.shared import small_batches, texts_of

TIERS = (512, 1024, 2048, 4096)
END_ID = 2
POOL_TOKENS = 1 << 20
STEP_TOKENS = 16 * 4096
CACHED_WORDS = 800_000
CACHED_MARKS = 50_000
#: Latin letters that normalisation leaves alone and that have one lower-case form, and ASCII signs but the apostrophe.
PLAIN = "^(?P<letters>[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)(?P<marks>[!-&(-/:-@\\[-`{-~]*)$"
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, tier int, step_group long"
)


def _byte_of_sign() -> dict[str, int]:
    """The byte that a sign of a byte-level vocabulary stands for: printable ones themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


class LetterEncoder:
    """Ids of many words of lower-case letters in one call.

    The words' merges, ordered as the tokenizer orders them, are given to a byte-pair encoder that has
    no end of word. A `!` behind each word stands for it, and joins the last byte before all else.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        suffix, signs = model["end_of_word_suffix"], _byte_of_sign()

        def as_bytes(token: str) -> bytes:
            body = token.removesuffix(suffix)
            return bytes(map(signs.__getitem__, body)) + (b"!" if body != token else b"")

        ids = {sign: model["vocab"][sign] for sign in signs}
        ranks = {bytes([b]): b for b in range(256)}
        ranks.update({bytes([b]) + b"!": 256 + b for b in range(256)})
        self.ids = np.zeros(512 + len(model["merges"]), np.uint32)
        for sign, b in signs.items():
            self.ids[b], self.ids[256 + b] = ids[sign], model["vocab"][sign + suffix]
        for i, merge in enumerate(model["merges"]):
            token = "".join(merge.split(" ") if isinstance(merge, str) else merge)
            joined = as_bytes(token)
            if joined not in ranks and b"!" not in joined[:-1]:
                ranks[joined] = 512 + i
                self.ids[512 + i] = model["vocab"][token]
        self.closes = np.zeros(len(self.ids), bool)
        self.closes[[i for token, i in ranks.items() if token.endswith(b"!")]] = True
        self.encoding = tiktoken.Encoding("letters", pat_str="[^ ]+", mergeable_ranks=ranks, special_tokens={})

    def parts(self, text: str) -> tuple[bytes, np.ndarray]:
        """Ids of `word! word!`, and the places behind each word's last."""
        found = self.encoding.encode_to_numpy(text)
        return self.ids[found].astype("<u4").tobytes(), np.flatnonzero(self.closes[found]) + 1


class WordEncoder:
    """Ids of a text as little-endian 32-bit numbers, by the ids of its words.

    The tokenizer drops white space and never joins across it, so words between ASCII white
    space are encoded on their own and remembered. It lower-cases, and parts letters from marks; so
    words of Latin letters, with ASCII signs behind or not, are encoded many at a time; signs and all
    other words by the tokenizer itself.
    """

    def __init__(self, path: str, end_id: int = END_ID):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = LetterEncoder(path)
        self.end = np.array([end_id], "<u4").tobytes()
        self.known: dict[bytes, bytes] = {}
        self.marks: dict[str, bytes] = {}

    def _ids(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def learn(self, words: set[bytes]) -> None:
        new = words - self.known.keys()
        if len(self.known) + len(new) > CACHED_WORDS:
            self.known, new = {}, words
        if not new:
            return
        all_new = pa.array(list(new), pa.binary())
        parts = pc.extract_regex(all_new.view(pa.string()), PLAIN)
        plain = parts.is_valid()
        odd = all_new.filter(pc.invert(plain)).to_pylist()
        self.known.update(zip(odd, self._ids([word.decode("utf-8", "replace") for word in odd]), strict=True))
        parts = parts.filter(plain)
        if not len(parts):
            return
        marks = pc.struct_field(parts, "marks").to_pylist()
        unknown = list(set(marks) - self.marks.keys())
        self.marks.update(zip(unknown, self._ids(unknown), strict=True))
        data, ends = self.letters.parts("! ".join(pc.utf8_lower(pc.struct_field(parts, "letters")).to_pylist()) + "!")
        ends = (4 * ends).tolist()
        ids = [data[a:b] + self.marks[mark] for a, b, mark in zip([0, *ends[:-1]], ends, marks, strict=True)]
        self.known.update(zip(all_new.filter(plain).to_pylist(), ids, strict=True))
        if len(self.marks) > CACHED_MARKS:
            self.marks = {}

    def encode(self, texts: list[bytes]) -> list[bytes]:
        split = [text.split() for text in texts]
        self.learn(set().union(*split))
        return [b"".join([*map(self.known.__getitem__, words), self.end]) for words in split]


@functools.cache
def word_encoder(path: str, end_id: int) -> WordEncoder:
    """One encoder for all tasks of a worker process, with the words it remembers."""
    return WordEncoder(path, end_id)


class Piece:
    """Tokens [start, start + length) of a document, whose ids are bytes."""

    __slots__ = ("doc_id", "ids", "start", "length")

    def __init__(self, doc_id, ids: bytes, start: int, length: int):
        self.doc_id, self.ids, self.start, self.length = doc_id, ids, start, length

    def cut(self, length: int) -> tuple[Piece, Piece]:
        rest = Piece(self.doc_id, self.ids, self.start + length, self.length - length)
        return Piece(self.doc_id, self.ids, self.start, length), rest


class Tier:
    """Pieces in order of length."""

    def __init__(self):
        self.lengths: list[int] = []
        self.pieces: list[Piece] = []

    def add(self, piece: Piece) -> None:
        at = bisect.bisect_right(self.lengths, piece.length)
        self.lengths.insert(at, piece.length)
        self.pieces.insert(at, piece)

    def take(self, at: int) -> Piece:
        self.lengths.pop(at)
        return self.pieces.pop(at)

    def largest(self, most: int) -> Piece | None:
        at = bisect.bisect_right(self.lengths, most) - 1
        return self.take(at) if at >= 0 else None


class Packer:
    """Windows of one task; `windows` yields (window size, pieces)."""

    def __init__(self, tiers=TIERS):
        self.sizes = sorted(tiers)
        self.pool = {size: Tier() for size in self.sizes}
        self.tokens = 0

    def route(self, piece: Piece) -> None:
        self.tokens += piece.length
        self.pool[next(size for size in self.sizes if piece.length <= size)].add(piece)

    def add(self, piece: Piece) -> Iterator[tuple[int, list[Piece]]]:
        longest = self.sizes[-1]
        while piece.length > longest:
            window, piece = piece.cut(longest)
            yield longest, [window]
        self.route(piece)

    def fill(self, gap: int, sizes: list[int]) -> list[Piece]:
        """Whole pieces of the given tiers into a gap, then one cut piece of the shortest tier that has any."""
        found = []
        for size in reversed(sizes):
            while gap and (piece := self.pool[size].largest(gap)):
                found.append(piece)
                gap -= piece.length
        for size in sizes:
            if gap and self.pool[size].pieces:
                whole = self.pool[size].take(0)
                piece, rest = whole.cut(gap)
                found.append(piece)
                self.tokens -= whole.length - piece.length
                self.route(rest)
                gap = 0
        return found

    def windows(self, last: bool) -> Iterator[tuple[int, list[Piece]]]:
        for k in reversed(range(len(self.sizes))):
            size = self.sizes[k]
            while self.pool[size].pieces:
                window = [self.pool[size].take(-1)]
                window += self.fill(size - window[0].length, self.sizes[: k + 1])
                used = sum(p.length for p in window)
                self.tokens -= used
                if used < size:  # nothing is left in this tier and below
                    if last:
                        yield from self.close(window)
                    else:
                        for piece in window:
                            self.route(piece)
                        return
                else:
                    yield size, window

    def close(self, window: list[Piece]) -> Iterator[tuple[int, list[Piece]]]:
        """The last window of a task: cut at whole shorter windows, the rest padded to the longest."""
        rest = window
        for size in reversed(self.sizes):
            while sum(p.length for p in rest) >= size:
                full, rest = self.split(rest, size)
                yield size, full
        if rest:
            yield self.sizes[-1], rest

    @staticmethod
    def split(pieces: list[Piece], size: int) -> tuple[list[Piece], list[Piece]]:
        left, right = [], []
        for piece in pieces:
            if size >= piece.length:
                left.append(piece)
                size -= piece.length
            elif size:
                a, b = piece.cut(size)
                left.append(a)
                right.append(b)
                size = 0
            else:
                right.append(piece)
        return left, right


def _step_groups(windows: list[tuple[int, list[Piece]]]) -> list[int]:
    """A group per window: longest first, each to the group with the fewest tokens."""
    groups = max(1, round(sum(size for size, _ in windows) / STEP_TOKENS))
    loads = [(0, g) for g in range(groups)]
    found = [0] * len(windows)
    for i in sorted(range(len(windows)), key=lambda i: -windows[i][0]):
        tokens, g = loads[0]
        found[i] = g
        heapq.heapreplace(loads, (tokens + windows[i][0], g))
    return found


def pack_partition(path: str, end_id: int = END_ID, tiers=TIERS, pool_tokens: int = POOL_TOKENS):
    """The function for `mapInArrow` over (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = word_encoder(path, end_id), Packer(tiers)
        schema = pa.schema([(n, pa.int32() if n == "tier" else pa.int64()) for n in (c.split()[0] for c in PIECES.split(", "))])
        base = TaskContext.get().partitionId() << 33
        counts = {"window": 0, "group": 0}

        def rows(windows: list[tuple[int, list[Piece]]]) -> pa.RecordBatch:
            columns: list[list] = [[] for _ in schema]
            groups = _step_groups(windows)
            for (size, pieces), group in zip(windows, groups, strict=True):
                offset = 0
                for p in pieces:
                    crc = zlib.crc32(memoryview(p.ids)[4 * p.start : 4 * (p.start + p.length)])
                    row = (p.doc_id, p.start, p.length, crc, len(p.ids) // 4, base + counts["window"], offset, size, base + counts["group"] + group)
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                    offset += p.length
                counts["window"] += 1
            counts["group"] += max(groups, default=-1) + 1
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        done: list[tuple[int, list[Piece]]] = []
        for batch in small_batches(batches, 256):
            ids = encoder.encode(texts_of(batch.column("text")))
            for doc_id, doc in zip(batch.column("doc_id").to_pylist(), ids, strict=True):
                done += packer.add(Piece(doc_id, doc, 0, len(doc) // 4))
            if packer.tokens >= pool_tokens or sum(size for size, _ in done) >= pool_tokens:
                done += packer.windows(last=False)
                yield rows(done)
                done = []
        done += packer.windows(last=True)
        if done:
            yield rows(done)

    return run


def pack(documents: DataFrame, tokenizer_path: str, end_id: int = END_ID, tiers=TIERS, pool_tokens: int = POOL_TOKENS) -> DataFrame:
    """Pieces of all documents, each token in exactly one; see the module for the columns' meaning."""
    rows = documents.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
    return rows.mapInArrow(pack_partition(tokenizer_path, end_id, tiers, pool_tokens), PIECES)
