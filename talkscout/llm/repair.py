"""Cheapest repair of a conversation's structure, by scalar big-integer weights.

A repair keeps, reroles or deletes each turn and inserts turns without text, so that the roles' initials
read `(s?(ua)+)?`. The nodes of a DAG are (turns read, state of that pattern), its edges the edits. The weight of
a path is one integer: its high digits are the cost, its low digits a fixed number of places that take
the letters of the edits in order (3 bits each, in ASCII order), and zeros behind the last one. So the
least integer is the cheapest path and, of equal costs, the one with the ASCII-least letters; nothing else is compared.
Two paths to a node have read the same turns; if one's letters began the other's, that one would have inserted more, at a
cost, so what comes behind never changes their order.

Turns are dealt out by conversation, sorted, and streamed. Each state keeps its weight and the digest of
its repaired text so far. Places that all states fill alike are settled: they leave the integers for the audit, whose
length is that of the conversation. Besides that string a task holds 16 bytes for each different turn. A
digest needs its turns in order, so one conversation is the work of one task.

Defined cases: a null role or text is one space, as are nulls in the text `conv_id:turn` that decides a
damage; rows without conv_id make up one conversation; null turns come first, and turns of equal number in the order
of (role, text) after damage; an empty role has no initial and cannot be kept, nor can one with another initial than
s, u, a; repeated rows are duplicates; conversations without rows give zeros, an empty audit and the digest of the
empty string; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Letters of the edits in ASCII order, by digit; digit 0 is the end.
LETTERS = "\0DIKR"
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5
BITS = 3
PLACES = 256
# States: nothing yet, after s, after u, after ua.
START, SYSTEM, USER, DONE = range(4)
MOVES = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": DONE}, DONE: {"u": USER}}
#: What can be inserted or reroled to in a state, as there is one kind only.
NEXT = {START: "user", SYSTEM: "user", USER: "assistant", DONE: "user"}
ACCEPTED = (START, DONE)
LEGAL = ("su", "ua", "au")
BATCH_CHARS = 1 << 20
REPAIRS = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string, n_turns long, kept long"
)


class Path:
    """The cheapest way to a state: weight, number of letters in its places, digest and number of turns of its result."""

    __slots__ = ("weight", "length", "digest", "turns")

    def __init__(self, weight: int, length: int, digest, turns: int):
        self.weight, self.length, self.digest, self.turns = weight, length, digest, turns


class Repair:
    """The repair of one conversation whose turns are fed in order."""

    def __init__(self, places: int = PLACES):
        self.places = places
        self.settled: list[str] = []
        self.paths = {START: Path(0, 0, hashlib.sha256(), 0)}
        self._insert()

    def _edge(self, path: Path, cost: int, letter: int) -> int:
        return path.weight + (cost << BITS * self.places) + (letter << BITS * (self.places - 1 - path.length))

    @staticmethod
    def _take(path: Path, weight: int, line: bytes | None) -> Path:
        """The path one edge on; `line` is the turn it adds."""
        if line is None:
            return Path(weight, path.length + 1, path.digest, path.turns)
        digest = path.digest.copy()
        digest.update(b"\n" + line if path.turns else line)
        return Path(weight, path.length + 1, digest, path.turns + 1)

    def _insert(self) -> None:
        """Insertions before the next turn; two in a row reach every state they can."""
        for _ in range(2):
            for state, path in list(self.paths.items()):
                role = NEXT[state]
                to, weight = MOVES[state][role[0]], self._edge(path, INSERT_COST, INSERT)
                if to not in self.paths or weight < self.paths[to].weight:
                    self.paths[to] = self._take(path, weight, role.encode() + b":")

    def feed(self, role: str, text: bytes, truncated: bool, must_go: bool) -> None:
        best: dict[int, tuple[int, Path, bytes | None]] = {}
        extra = TRUNCATED_COST if truncated else 0
        for state, path in self.paths.items():
            edges = [(state, self._edge(path, DELETE_COST, DELETE), None)]
            if not must_go:
                if (to := MOVES[state].get(role[:1])) is not None:
                    edges.append((to, self._edge(path, extra, KEEP), role))
                other = NEXT[state]
                edges.append((MOVES[state][other[0]], self._edge(path, REROLE_COST + extra, REROLE), other))
            for to, weight, own in edges:
                if to not in best or weight < best[to][0]:
                    best[to] = (weight, path, own)
        self.paths = {
            to: self._take(path, weight, None if own is None else own.encode("utf-8", "surrogatepass") + b":" + text)
            for to, (weight, path, own) in best.items()
        }
        self._insert()
        if max(path.length for path in self.paths.values()) > self.places - 8:
            self._settle()

    def _letters(self, low: int, count: int) -> str:
        return "".join(LETTERS[low >> BITS * (self.places - 1 - i) & 7] for i in range(count))

    def _settle(self) -> None:
        """Take off the first places, as far as all paths agree; make more places if that is little."""
        width = BITS * self.places
        mask = (1 << width) - 1
        lows = [path.weight & mask for path in self.paths.values()]
        differ = 0
        for low in lows:
            differ |= low ^ lows[0]
        same = min(self.places - -(-differ.bit_length() // BITS), min(path.length for path in self.paths.values()))
        self.settled.append(self._letters(lows[0], same))
        more = self.places if same < self.places // 2 else 0
        for path, low in zip(self.paths.values(), lows, strict=True):
            low = (low << BITS * same & mask) << BITS * more
            path.weight = path.weight >> width << width + BITS * more | low
            path.length -= same
        self.places += more

    def finish(self) -> tuple[int, str, str, int]:
        """Cost, audit, digest of the repaired turns, and their number."""
        path = min((self.paths[s] for s in ACCEPTED if s in self.paths), key=lambda path: path.weight)
        width = BITS * self.places
        audit = "".join(self.settled) + self._letters(path.weight & (1 << width) - 1, path.length)
        return path.weight >> width, audit, path.digest.hexdigest(), path.turns


class Conversation:
    """Faults and repair of one conversation whose rows are fed in order."""

    def __init__(self):
        self.repair = Repair()
        self.seen: set[bytes] = set()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = self.distinct = 0
        self.first = self.last = self.initial = None

    def feed(self, turn: int | None, role: str, text: bytes) -> None:
        self.turns += 1
        if turn is not None:
            self.distinct += turn != self.last
            self.first, self.last = turn if self.first is None else self.first, turn
        self.illegal += self.initial is not None and self.initial + role[:1] not in LEGAL
        self.initial = role[:1]
        name = role.encode("utf-8", "surrogatepass")
        key = hashlib.blake2b(b"%d:%b%b" % (len(name), name, text), digest_size=16).digest()
        end = text.rstrip()  # at \x20 and \x09-\x0D
        blank = not end
        duplicate = not blank and key in self.seen
        truncated = not blank and not duplicate and end[-1:] not in (b".", b"!", b"?")
        self.seen.add(key)
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        self.repair.feed(role, text, truncated, blank or duplicate)

    def row(self, conv_id: int | None) -> tuple:
        cost, audit, digest, kept = self.repair.finish()
        gaps = self.last - self.first + 1 - self.distinct if self.distinct else 0
        return conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit, digest, self.turns, kept


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with their damage; `copies` says how often a row stands there, 0 if it is dropped."""
    space = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind.isin(0, 1), "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def undamaged(conversations: DataFrame) -> DataFrame:
    """The rows as they are, for `repaired`."""
    space = F.lit(" ")
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), F.lit(1).alias("copies"),
    )


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = {"long": pa.int64(), "string": pa.string()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in REPAIRS.split(", "))])
    rows: list[tuple] = []
    current, now, chars = None, None, 0

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        columns = [batch.column(name).to_pylist() for name in ("conv_id", "turn", "role", "copies")]
        for conv_id, turn, role, copies, text in zip(*columns, texts, strict=True):
            if now is None or conv_id != current:
                if now is not None:
                    rows.append(now.row(current))
                    chars += 200 + len(rows[-1][7])
                    if chars > BATCH_CHARS:
                        yield batch_of(rows)
                        rows, chars = [], 0
                current, now = conv_id, Conversation()
            for _ in range(copies):
                now.feed(turn, role, text)
    if now is not None:
        rows.append(now.row(current))
    if rows:
        yield batch_of(rows)


def repaired(rows: DataFrame) -> DataFrame:
    """Per conversation: faults, and cost, audit and digest of the cheapest repair. `rows` as `damaged` or `undamaged` gives them."""
    order = F.col("turn").asc_nulls_first()
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", order, "role", "text").mapInArrow(_repair, REPAIRS)
