"""Hidden Markov language model over word classes.

Training tokens are counted by word over all training documents. The most frequent words are
classes of their own; the others go to a class by their last letters. Latent states emit
classes, a word follows from its class by its smoothed count. Baum-Welch: every partition runs
the scaled forward-backward recursion over its documents and sums up expected counts, which are
added over partitions for the next step. It starts from states that are random but stay. Since that
would need many steps, the first pass takes a step after each of PARTS parts of the training documents,
which together are all of them, and adds each part's expected counts to half of those so far; the steps
after it see all documents at once. For training, documents are cut into stretches of
bounded length, and looked up once: the steps read their classes as numbers; a text's likelihood is that of the scaled forward recursion over all its tokens.

The words' counts, which grow with the corpus, stay in a table. Only the most frequent words
(a fixed number) go to the tasks; the other words of each document are joined with the counts.

Defined cases: null text is empty and has the end token only; without training documents every
count is 0 and the model knows the end token alone; repeated rows score alike; a null doc_id counts
as the empty text in held_out; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkscout.llm.shared import shared_folder, small_batches, texts_of, written

STATES = 8
OWN_CLASSES = 20_000
FREQUENT = 200_000
ENDINGS = 512
STRETCH = 128
AT_ONCE = 1024
STEPS = 2
PARTS = 12
KEPT = 0.5
FIRST_STEPS = 12
SMOOTH = 20.0
END = b""  # no word is empty
SCORED = (
    "row_key long, doc_id long, held_out boolean, n_tokens long, n_known long, logs double, likelihood double, "
    "rare array<struct<word:binary,n:long>>"
)
RARE = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))


def held_out(doc_id):
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 1


def tokens_of(text: bytes) -> list[bytes]:
    """Words and the end token; bytes lower-case A-Z and split at \\x20 and \\x09-\\x0D."""
    words = text.lower().split()
    words.append(END)
    return words


def ending(word: bytes) -> int:
    """Class of a word that has none of its own, counted from 0."""
    tail = word[-3:]
    value = len(tail)
    for c in tail:
        value = (value * 257 + c) % 1_000_003
    return value * 7919 % 1_000_003 % ENDINGS


@dataclass
class Words:
    """What tasks know of words: ids of the frequent ones by rank, their counts, and per class totals."""

    rank: dict[bytes, int]
    counts: np.ndarray  # by rank
    class_of: np.ndarray  # by rank
    classes: int
    sizes: np.ndarray  # tokens per class
    kinds: np.ndarray  # distinct words per class
    tokens: int
    distinct: int

    def ids(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of a text's tokens, -1 for words that are not frequent, and their classes."""
        return self.ids_of(tokens_of(text))

    def ids_of(self, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ranks = np.fromiter(map(self.rank.get, tokens, repeat(-1)), np.int64, len(tokens))
        classes = self.class_of[ranks]
        for i in np.flatnonzero(ranks < 0).tolist():
            classes[i] = self.classes - ENDINGS + ending(tokens[i])
        return ranks, classes

    @property
    def stored(self) -> str:
        """Type in which classes are written."""
        return "<u2" if self.classes <= 1 << 16 else "<u4"


@dataclass
class Model:
    start: np.ndarray  # S
    moves: np.ndarray  # S x S
    emits: np.ndarray  # classes x S

    @classmethod
    def of_counts(cls, start: np.ndarray, moves: np.ndarray, emits: np.ndarray, words: Words) -> Model:
        """From expected counts, smoothed towards the classes' shares."""
        shares = (words.sizes + 0.5) / (words.sizes + 0.5).sum()
        emits = emits + SMOOTH * shares[:, None]
        return cls((start + 0.1) / (start + 0.1).sum(), (moves + 0.1) / (moves + 0.1).sum(axis=1, keepdims=True), emits / emits.sum(axis=0))


def _lockstep(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sequences by falling length: their order, all classes, first places, and how many are longer than t."""
    lengths = np.array([len(x) for x in sequences])
    order = np.argsort(-lengths, kind="stable")
    flat = np.concatenate([sequences[i] for i in order])
    starts = np.concatenate([[0], np.cumsum(lengths[order])[:-1]])
    active = np.searchsorted(-lengths[order], -np.arange(lengths.max()), side="left")
    return order, flat, starts, active


def log_likelihoods(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """log10 probability of each sequence of classes, by the scaled forward recursion; all run side by side."""
    order, flat, starts, active = _lockstep(sequences)
    total = np.zeros(len(order))
    alpha = np.broadcast_to(model.start, (len(order), len(model.start)))
    for t, n in enumerate(active):
        alpha = (alpha[:n] if t == 0 else alpha[:n] @ model.moves) * model.emits[flat[starts[:n] + t]]
        scale = alpha.sum(axis=1)
        alpha /= scale[:, None]
        total[:n] += np.log10(scale)
    out = np.empty(len(order))
    out[order] = total
    return out


def expected_counts(model: Model, sequences: list[np.ndarray], starts_text: list[bool], classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Baum-Welch: expected starts, moves and emissions of sequences (stretches of texts).

    The tokens of all sequences are laid out step by step, so that a step reads and writes one block of rows.
    """
    order, flat, starts, active = _lockstep(sequences)
    states = len(model.start)
    first = np.array(starts_text)[order]
    stationary = np.full(states, 1 / states)
    for _ in range(50):
        stationary = stationary @ model.moves
    ends = np.cumsum(active)
    steps = np.repeat(np.arange(len(active)), active)
    tokens = flat[starts[np.arange(len(flat)) - (ends - active)[steps]] + steps]
    emits = model.emits[tokens]
    alphas = np.empty((len(tokens), states))
    scales = np.empty((len(tokens), 1))
    before = np.where(first[:, None], model.start, stationary)
    for n, end in zip(active, ends, strict=True):
        alpha, scale = alphas[end - n : end], scales[end - n : end]
        np.multiply(before[:n], emits[end - n : end], out=alpha)
        np.sum(alpha, axis=1, keepdims=True, out=scale)
        alpha /= scale
        before = alpha @ model.moves
    emits /= scales
    moves, back = np.zeros((states, states)), model.moves.T.copy()
    beta = np.ones((0, states))
    for n, end in zip(active[::-1], ends[::-1], strict=True):
        m, now = len(beta), np.ones((n, states))
        alpha = alphas[end - n : end]
        if m:
            onward = emits[end : end + m] * beta
            moves += alpha[:m].T @ onward
            np.matmul(onward, back, out=now[:m])
        alpha *= now  # from here on the expected states
        beta = now
    shares = np.stack([np.bincount(tokens, alphas[:, s], classes) for s in range(states)], axis=1)
    return alphas[: active[0]][first].sum(axis=0), moves * model.moves, shares


def stretches(classes: np.ndarray) -> list[np.ndarray]:
    return [classes[i : i + STRETCH] for i in range(0, len(classes), STRETCH)]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def flush():
        if counts:
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
        counts.clear()

    for batch in small_batches(batches, 256):
        for text in texts_of(batch.column("text")):
            counts.update(tokens_of(text))
        if len(counts) > 500_000:
            yield from flush()
    yield from flush()


def _count_endings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tokens, kinds = np.zeros(ENDINGS, np.int64), np.zeros(ENDINGS, np.int64)
    for batch in batches:
        for word, n in zip(batch.column("word").to_pylist(), batch.column("c").to_pylist(), strict=True):
            k = ending(word)
            tokens[k] += n
            kinds[k] += 1
    yield pa.RecordBatch.from_arrays([pa.array(range(ENDINGS), pa.int32()), pa.array(tokens), pa.array(kinds)], names=["ending", "n", "kinds"])


def learn_words(counts: DataFrame) -> Words:
    """From the table (word, c): the most frequent words, FREQUENT at most, and totals of the others by ending."""
    level = F.floor(F.log2("c") * 16)  # so the driver gets a few hundred numbers to choose a least count from
    room, least = FREQUENT, None
    for r in counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():
        room -= r["count"]
        if room < 0:
            break
        least = r.level
    frequent = sorted(counts.where(level >= least).collect(), key=lambda r: (-r.c, r.word)) if least is not None else []
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    rank = {bytes(r.word): i for i, r in enumerate(frequent)}
    own = min(OWN_CLASSES, len(frequent))
    if END not in rank or rank[END] >= own:  # the end token always has a class of its own
        end = rank.setdefault(END, len(frequent))
    else:
        end = None
    size = max(len(rank), 1)
    n = np.zeros(size, np.int64)
    n[: len(frequent)] = [r.c for r in frequent]
    class_of = np.empty(size, np.int64)
    for word, i in rank.items():
        class_of[i] = i if i < own else own + 1 + ending(word)
    if end is not None:
        class_of[end] = own
    classes = own + 1 + ENDINGS
    sizes, kinds = np.zeros(classes, np.int64), np.zeros(classes, np.int64)
    rows = counts.mapInArrow(_count_endings, "ending int, n long, kinds long").groupBy("ending").agg(F.sum("n").alias("n"), F.sum("kinds").alias("kinds")).collect()
    for r in rows:
        sizes[own + 1 + r.ending], kinds[own + 1 + r.ending] = r.n, r.kinds
    for word, i in rank.items():  # those with a class of their own are not in one by ending
        if class_of[i] <= own:
            if i < len(frequent):
                sizes[own + 1 + ending(word)] -= n[i]
                kinds[own + 1 + ending(word)] -= 1
            sizes[class_of[i]], kinds[class_of[i]] = n[i], 1
    return Words(rank, n, class_of, classes, sizes, kinds, totals.n, totals.v)


def _expect(words, model):
    schema = pa.schema([("class", pa.int32()), *((f"s{i}", pa.float64()) for i in range(STATES))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, now = words.value, model.value
        start, moves, emits = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((known.classes, STATES))
        for batch in small_batches(batches, 1024):
            sequences, firsts = [], []
            for classes in batch.column("classes").to_pylist():
                parts = stretches(np.frombuffer(classes, known.stored).astype(np.int64))
                sequences += parts
                firsts += [True] + [False] * (len(parts) - 1)
            for i in range(0, len(sequences), AT_ONCE):
                a, b, c = expected_counts(now, sequences[i : i + AT_ONCE], firsts[i : i + AT_ONCE], known.classes)
                start, moves, emits = start + a, moves + b, emits + c
        seen = np.flatnonzero(emits.sum(axis=1))
        table = np.concatenate([start[None], moves, emits[seen]])
        names = np.concatenate([[-1], -2 - np.arange(STATES), seen])
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), *(pa.array(table[:, i]) for i in range(STATES))], schema=schema)

    return run


def _class_ids(words):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = words.value
        for batch in small_batches(batches, 1024):
            classes = [known.ids(text)[1].astype(known.stored).tobytes() for text in texts_of(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([pa.array(classes, pa.binary()), batch.column("part")], names=["classes", "part"])

    return run


def class_ids(training: DataFrame, words: Words, folder: str) -> DataFrame:
    """The classes of each training text's tokens, written in PARTS parts: texts are looked up once for all steps."""
    shared = training.sparkSession.sparkContext.broadcast(words)
    rows = training.select("text", F.pmod(F.xxhash64("row_key"), F.lit(PARTS)).cast("int").alias("part"))
    rows = rows.mapInArrow(_class_ids(shared), "classes binary, part int")
    rows.write.mode("overwrite").partitionBy("part").parquet(f"{folder}/training")
    return training.sparkSession.read.schema("classes binary, part int").parquet(f"{folder}/training")


def expected(training: DataFrame, words: Words, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts, moves and emissions of all texts, given by their classes: counted per partition, added up by class."""
    context = training.sparkSession.sparkContext
    names = [f"s{i}" for i in range(STATES)]
    schema = "class int, " + ", ".join(f"{n} double" for n in names)
    rows = training.select("classes").mapInArrow(_expect(context.broadcast(words), context.broadcast(model)), schema)
    start, moves, emits = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((words.classes, STATES))
    for r in rows.groupBy("class").agg(*(F.sum(n).alias(n) for n in names)).collect():  # a row per class at most
        values = r[1:]
        if r[0] == -1:
            start[:] = values
        elif r[0] < 0:
            moves[-2 - r[0]] = values
        else:
            emits[r[0]] = values
    return start, moves, emits


def baum_welch_step(training: DataFrame, words: Words, model: Model) -> Model:
    """One step over all training texts."""
    return Model.of_counts(*expected(training, words, model), words)


def first_pass(training: DataFrame, words: Words) -> Model:
    """A step after each part of the training texts; each text is in one part."""
    model, counts = first_model([], words), None
    for part in range(PARTS):
        found = expected(training.where(F.col("part") == part), words, model)
        counts = [KEPT * a + b for a, b in zip(counts, found, strict=True)] if counts else found
        if counts[2].any():  # else no text so far
            model = Model.of_counts(*counts, words)
    return model


def first_model(texts: list[bytes], words: Words) -> Model:
    """States that are random but stay, and Baum-Welch over a few texts, if there are any."""
    rng = np.random.default_rng(7)
    shares = (words.sizes + 0.5) / (words.sizes + 0.5).sum()
    emits = shares[:, None] * rng.uniform(0.5, 1.5, (words.classes, STATES))
    moves = np.full((STATES, STATES), 0.2 / STATES) + 0.8 * np.eye(STATES)
    model = Model(np.full(STATES, 1 / STATES), moves, emits / emits.sum(axis=0))
    sequences, firsts = [], []
    for text in texts:
        parts = stretches(words.ids(text)[1])
        sequences += parts
        firsts += [True] + [False] * (len(parts) - 1)
    for _ in range(FIRST_STEPS if sequences else 0):
        model = Model.of_counts(*expected_counts(model, sequences, firsts, words.classes), words)
    return model


def _score(words, model):
    kinds = {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}
    schema = pa.schema([(name, kinds.get(kind, RARE)) for name, kind in (c.split() for c in SCORED.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, now = words.value, model.value
        logs = np.log10(known.counts + 0.5)
        # log10 of a word's share in its class; the count's part of words that are not frequent comes from the join.
        own = known.classes - ENDINGS
        within = -np.log10(known.sizes + 0.5 * (known.kinds + 1))
        within[:own] = 0
        shared = np.where(known.class_of >= own, logs, 0)
        for batch in small_batches(batches, 2048):
            sequences, n, seen, base, rest, rare = [], [], [], [], [], []
            for text in texts_of(batch.column("text")):
                tokens = tokens_of(text)
                ranks, classes = known.ids_of(tokens)
                at = ranks[ranks >= 0]
                others = Counter(tokens[i] for i in np.flatnonzero(ranks < 0).tolist())
                rare.append([{"word": word, "n": c} for word, c in others.items()])
                sequences.append(classes)
                n.append(len(ranks))
                seen.append(int((known.counts[at] > 0).sum()))
                base.append(float(logs[at].sum()))
                rest.append(float(within[classes].sum() + shared[at].sum()))
            found = log_likelihoods(now, sequences) if sequences else np.empty(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_key"), batch.column("doc_id"), batch.column("held_out"), pa.array(n, pa.int64()), pa.array(seen, pa.int64()),
                 pa.array(base, pa.float64()), pa.array(found + np.array(rest), pa.float64()), pa.array(rare, RARE)], schema=schema,
            )

    return run


def score(documents: DataFrame, steps: int = STEPS) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = documents.sparkSession
    folder = shared_folder(spark)
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("row_key", F.xxhash64("doc_id", "text"))
    training = rows.where(~F.col("held_out"))

    counts = training.select("text").mapInArrow(_count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))
    counts = written(counts, folder, "counts")
    words = learn_words(counts)
    classes = class_ids(training, words, folder)
    model = first_pass(classes, words)
    for _ in range(steps):
        model = baum_welch_step(classes, words, model)

    shared = spark.sparkContext.broadcast(words)
    scored = rows.select("row_key", "doc_id", "held_out", "text").mapInArrow(_score(shared, spark.sparkContext.broadcast(model)), SCORED)
    scored = written(scored, folder, "scored")
    rare = scored.select("row_key", F.inline("rare"))
    met = rare.join(counts, "word", "left").select(
        "row_key", (F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("logs"), F.when(F.col("c") > 0, F.col("n")).otherwise(0).alias("known"), F.lit(0).alias("copies")
    )
    marks = scored.select("row_key", F.lit(0.0).alias("logs"), F.lit(0).cast("long").alias("known"), F.lit(1).alias("copies"))
    sums = met.unionByName(marks).groupBy("row_key").agg(F.sum("logs").alias("more_logs"), F.sum("known").alias("more_known"), F.sum("copies").alias("copies"))
    # Rows alike in id and text share a key; each has added the same words.
    sums = sums.select("row_key", (F.col("more_logs") / F.col("copies")).alias("more_logs"), (F.col("more_known") / F.col("copies")).cast("long").alias("more_known"))
    all_tokens = F.log10(F.lit(words.tokens + 0.5 * (words.distinct + 1)))
    return scored.drop("rare").join(sums, "row_key").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.col("more_known")).alias("n_known"), F.lit(words.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + F.col("more_logs") - F.col("n_tokens") * all_tokens).alias("base_score"),
        (F.col("likelihood") + F.col("more_logs")).alias("score"),
    )
