"""Near-duplicates by an inverted join on MinHash signature coordinates.

A document's set holds its distinct two-word shingles, as 64-bit hashes. Documents with equal
sets form a class (by a 128-bit hash of the set); only classes are compared. Each class is
posted under its coordinate-value pairs. Two classes with at least MATCHES equal coordinates
share one of each one's K - MATCHES + 1 rarest pairs, so only that prefix is listed, and pairs
that occur once are skipped. A list is not multiplied out: its members are compared with one
hub, the class that has most in common with others (of many copies of a text, the text itself),
then those outside the list's largest component with the next hub, and only what is left,
members outside the largest component, with all members of other components that counts
of rare and of frequent shingles don't rule out. So no
pair that could join two components goes uncompared. Compared pairs with enough collisions
are confirmed on full sets, for each class first the pair with most collisions and the others
only where they still would join two components.

A pair with a similarity of exactly 0.8 has fewer than 26 of 48 equal coordinates with a
probability of about 1 in 76,000; more similar pairs are missed less often.

Defined cases: null, empty and word-less texts have an empty set and are linked with nothing; a
text of one word has one shingle; repeated rows and ids are rows of their own, each with its
text's component; a null doc_id never is a component's id unless the component has no other, and is
kept if so; an empty table gives no rows; other columns are ignored or, by `keep_first`, kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkscout.llm.shared import fitted, shared_folder, small_batches, texts_of, written

COORDINATES = 48
MATCHES = 26
ROUNDS = 2
SHORT_LIST = 16
RARE = 64
SETS_PER_TASK = 2_000
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53], np.uint64)
SETS = "doc_id long, text_key long, n_shingles long, node long, check long, signature array<int>"


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of the two-word shingles."""
    words = text.lower().split()  # bytes: lower-cases A-Z, splits at \\x20 and \\x09-\\x0D
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    s = h[:-1] * MIX[0] + h[1:] * MIX[1] if len(words) > 1 else h * MIX[2]
    s ^= s >> np.uint64(33)
    s *= MIX[2]
    s ^= s >> np.uint64(29)
    s *= MIX[3]
    s ^= s >> np.uint64(32)
    return np.unique(s)


def _coefficients(coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    a = rng.integers(0, 2**63, coordinates, np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 2**63, coordinates, np.uint64)


def signature(s: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least value of each coordinate's hash."""
    least = np.full(len(a), 2**32 - 1, np.uint64)
    for start in range(0, len(s), 2048):
        values = (s[start : start + 2048, None] * a + b) >> np.uint64(32)
        np.minimum(least, values.min(axis=0), out=least)
    return least.astype(np.uint32).view(np.int32)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b = _coefficients(COORDINATES)
    for batch in small_batches(batches, 1024):
        sizes, nodes, checks, signatures = [], [], [], []
        for text in texts_of(batch.column("text")):
            s = shingles(text)
            key = xxhash.xxh3_128_digest(s.tobytes())
            sizes.append(len(s))
            nodes.append(int.from_bytes(key[:8], "little", signed=True))
            checks.append(int.from_bytes(key[8:], "little", signed=True))
            signatures.append(signature(s, a, b))
        flat = np.concatenate(signatures) if signatures else np.empty(0, np.int32)
        offsets = np.arange(0, len(flat) + 1, COORDINATES, dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
             pa.array(checks, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
            names=["doc_id", "text_key", "n_shingles", "node", "check", "signature"],
        )


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, 256):
        sets = [shingles(text).tobytes() for text in texts_of(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], names=["node", "set"])


def _single_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, 64):
        sets = [shingles(text).view(np.int64) for text in texts_of(batch.column("text"))]
        nodes = np.repeat(batch.column("node").to_numpy(), [len(x) for x in sets])
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(np.concatenate(sets))], names=["node", "shingle"])


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 256):
            linked = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                if len(x) > len(y):
                    x, y = y, x
                common = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                linked.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.drop_columns(["x", "y"]).filter(pa.array(linked, pa.bool_()))

    return run


def components(edges: DataFrame, folder: str, name: str) -> DataFrame:
    """(node, label) for the nodes of (a, b) edges: the least node of each component."""
    rows = 2 * edges.count()
    both = edges.select("a", "b").union(edges.select("b", "a")).distinct()
    both = written(fitted(both, rows), folder, f"{name}-edges")
    labels = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).select(F.col("a").alias("node"), "label")
    labels = written(fitted(labels, rows), folder, f"{name}-0")
    turn = 0
    while True:
        turn += 1
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        met = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        met = met.join(jump, "label", "left").select("node", F.least("label", F.coalesce("further", "label")).alias("label"), "old")
        met = written(fitted(met, rows), folder, f"{name}-{turn}")
        labels = met.select("node", "label")
        if met.where("label <> old").isEmpty():
            return labels


class _Comparison:
    """Classes, their lists, and what has been linked so far."""

    def __init__(self, documents: DataFrame, classes: DataFrame, folder: str, percent: int):
        self.documents, self.classes, self.folder, self.percent = documents, classes, folder, percent
        self.labels: DataFrame | None = None
        self.compared: DataFrame | None = None
        self.steps = 0

    def labelled(self, df: DataFrame, *names: str) -> DataFrame:
        """With the label of each node column as `l_<name>`."""
        for name in names:
            if self.labels is None:
                df = df.withColumn(f"l_{name}", F.col(name))
            else:
                found = self.labels.select(F.col("node").alias(name), F.col("label").alias(f"l_{name}"))
                df = df.join(found, name, "left").withColumn(f"l_{name}", F.coalesce(f"l_{name}", name))
        return df

    def joined(self, links: DataFrame, name: str) -> None:
        """Join the components (l_a, l_b) of new links: only these are looked at, with what was linked before as one node."""
        merged = components(links.select(F.col("l_a").alias("a"), F.col("l_b").alias("b")), self.folder, f"{name}-labels")
        if self.labels is not None:
            found = merged.select(F.col("node").alias("label"), F.col("label").alias("new"))
            rows = self.labels.count() + merged.count()
            kept = self.labels.join(found, "label", "left").select("node", F.coalesce("new", "label").alias("label"))
            merged = kept.union(merged.join(self.labels, "node", "left_anti"))
            merged = written(fitted(merged, rows), self.folder, f"{name}-joined")
        self.labels = merged

    def compare(self, pairs: DataFrame, rows: int | None = None) -> None:
        """Link what is similar among pairs (a, b), each once and a < b, of which there are at most `rows`."""
        self.steps += 1
        step = f"pairs{self.steps}"
        if self.compared is not None:
            pairs = pairs.join(self.compared, ["a", "b"], "left_anti")
        pairs = written(fitted(pairs, rows) if rows is not None else pairs, self.folder, f"{step}-taken")
        self.compared = pairs if self.compared is None else self.compared.union(pairs)
        side = lambda n: self.classes.select(F.col("node").alias(n), F.col("signature").alias(f"s_{n}"), F.col("n_shingles").alias(f"n_{n}"))
        equal = F.size(F.filter(F.zip_with("s_a", "s_b", lambda x, y: x == y), lambda x: x)).alias("matches")
        met = pairs.join(side("a"), "a").join(side("b"), "b")
        met = met.where(100 * F.least("n_a", "n_b") >= self.percent * F.greatest("n_a", "n_b")).select("a", "b", equal)
        met = written(fitted(met.where(F.col("matches") >= MATCHES), pairs.count()), self.folder, f"{step}-met")
        n = met.count()
        if not n:
            return
        nodes = met.select(F.col("a").alias("node")).union(met.select("b")).distinct()
        sets = fitted(self.texts_of(nodes), 2 * n, SETS_PER_TASK).mapInArrow(_full_sets, "node long, set binary")
        sets = written(fitted(sets.dropDuplicates(["node"]), 2 * n), self.folder, f"{step}-sets")
        # For each class the pair with most collisions first, then what still would join two components.
        best = met.groupBy("b").agg(F.max(F.struct("matches", "a")).alias("m")).select(F.col("m.a").alias("a"), "b")
        best = written(fitted(best, n), self.folder, f"{step}-first")
        self.confirm(best, n, sets, f"{step}-best")
        self.confirm(met.select("a", "b"), n, sets, f"{step}-rest", best)

    def texts_of(self, nodes: DataFrame) -> DataFrame:
        """(node, text) of the documents that stand for classes."""
        rows = self.classes.join(nodes, "node", "left_semi").select("node", "rep_id", F.col("text_key").alias("rep_key"))
        same = F.col("doc_id").eqNullSafe(F.col("rep_id")) & (F.col("text_key") == F.col("rep_key"))
        return self.documents.join(rows, same).select("node", "text")

    def left_over(self, lists: DataFrame, rows: int) -> DataFrame:
        """Pairs of lists that still span components: of those outside the largest one with all of others.

        Members of long lists are told apart by their full sets. Shingles that few of them have
        are joined, which counts what two members share of these. Of the other shingles they
        share at most what the one with fewer has. Pairs that can't be similar enough then are left out,
        and each pair is taken from one list only.
        """
        members = written(fitted(self.labelled(lists.select("node", "key"), "node"), rows), self.folder, "left")
        parts = members.groupBy("key", "l_node").agg(F.count("*").alias("n"))
        spans = parts.groupBy("key").agg(F.max(F.struct("n", "l_node")).alias("main"), F.sum("n").alias("all"), F.count("*").alias("parts"))
        spans = spans.where("parts > 1").select("key", F.col("main.l_node").alias("main"), (F.col("all") > SHORT_LIST).alias("long"))
        members = members.join(spans, "key").withColumn("out", F.col("l_node") != F.col("main"))
        members = written(fitted(members, rows), self.folder, "spans")

        long = members.where("long").groupBy("node", "l_node").agg(F.max("out").alias("out"), F.array_sort(F.collect_list("key")).alias("keys"))
        held = self.texts_of(long.select("node")).mapInArrow(_single_shingles, "node long, shingle long").distinct()
        held = written(held, self.folder, "held")
        rare = held.groupBy("shingle").agg(F.count("*").alias("n")).where(F.col("n") <= RARE)
        rare = written(fitted(held.join(rare, "shingle"), held.count()), self.folder, "rare")
        own = rare.groupBy("node").agg(F.count("*").alias("own"))
        sizes = long.join(self.classes.select("node", "n_shingles"), "node").join(own, "node", "left")
        sizes = sizes.select("node", "l_node", "out", "keys", F.col("n_shingles").alias("size"), (F.col("n_shingles") - F.coalesce("own", F.lit(0))).alias("often"))
        sizes = written(fitted(sizes, rows), self.folder, "sizes")

        other = lambda df: df.select(*(F.col(c).alias(f"o_{c}") for c in df.columns))
        can = lambda common: 100 * common >= self.percent * (F.col("size") + F.col("o_size") - common)
        least = F.least("often", "o_often")
        known = rare.where("n > 1").join(sizes.drop("keys"), "node")
        sharing = known.where("out").join(other(known), (F.col("shingle") == F.col("o_shingle")) & (F.col("l_node") != F.col("o_l_node")))
        sharing = sharing.groupBy("node", "o_node", "size", "o_size", "often", "o_often").agg(F.count("*").alias("shared"))
        sharing = sharing.where(can(least + F.col("shared"))).select("node", "o_node")

        listed = sizes.select("*", F.explode("keys").alias("key"))
        one_list = F.array_min(F.array_intersect("keys", "o_keys")) == F.col("key")
        apart = (F.col("key") == F.col("o_key")) & (F.col("l_node") != F.col("o_l_node"))
        # A row for each member and list, with all its lists, takes many times what the planner expects from the file of `sizes`.
        alike = listed.where("out").join(other(listed).hint("merge"), apart & can(least) & one_list).select("node", "o_node")

        brief = members.where("not long").select("key", "node", "l_node", "out")
        brief = brief.where("out").join(other(brief), apart).select("node", "o_node")
        return _ordered(sharing.union(alike).union(brief), "node", "o_node")

    def confirm(self, pairs: DataFrame, rows: int, sets: DataFrame, name: str, done: DataFrame | None = None) -> None:
        """Link pairs (a, b), at most `rows`, of different components that are similar by their full sets; those `done` are not."""
        pairs = self.labelled(pairs, "a", "b").where("l_a <> l_b").select("a", "b", "l_a", "l_b")
        pairs = written(fitted(pairs, rows), self.folder, f"{name}-open")
        rows = pairs.count()
        if not rows:
            return
        if done is not None:  # of the few pairs still open, not of all that met
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        x, y = sets.select(F.col("node").alias("a"), F.col("set").alias("x")), sets.select(F.col("node").alias("b"), F.col("set").alias("y"))
        held = fitted(pairs.join(x, "a").join(y, "b").select("l_a", "l_b", "x", "y"), rows, SETS_PER_TASK)
        found = written(held.mapInArrow(_confirm(self.percent), "l_a long, l_b long"), self.folder, name)
        if not found.isEmpty():
            self.joined(found, name)


def _ordered(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).where("a < b").distinct()


def _assigned(documents: DataFrame, percent: int, folder: str) -> DataFrame:
    """Per row: doc_id, text_key (64-bit hash of the text), n_shingles, component and its smallest doc_id; null without words."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    texts = texts.withColumn("text_key", F.xxhash64("text"))
    signed = written(texts.select("doc_id", "text", "text_key").mapInArrow(_sign, SETS), folder, "signed")
    classes = signed.where("n_shingles > 0").groupBy("node", "check").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("rep"), F.min("doc_id").alias("first_id"),
        F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"),
    )
    classes = classes.select("node", "n_shingles", "signature", "first_id", F.col("rep.doc_id").alias("rep_id"), F.col("rep.text_key").alias("text_key"))
    classes = written(fitted(classes, signed.count()), folder, "classes")

    key = F.shiftleft(F.col("pos").cast("long"), 32).bitwiseOR(F.col("col").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
    posted = classes.select("node", F.posexplode("signature")).select("node", key.alias("key"))
    counts = posted.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    prefix = COORDINATES - MATCHES + 1
    shared = posted.join(counts, "key").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("n", "key"))).alias("keys"))
    length = F.size("keys") + prefix - COORDINATES  # pairs that occur once are the rarest
    # How much a class has in common with others: the original of many near copies has most.
    common = F.aggregate("keys", F.lit(0.0), lambda total, k: total + F.log2(k["n"].cast("double"))).alias("common")
    lists = shared.where(length > 0).select("node", common, F.explode(F.slice("keys", 1, length)).alias("k"))
    lists = lists.select("node", "common", F.col("k.key").alias("key"))
    lists = written(fitted(lists, prefix * classes.count()), folder, "lists")
    rows = lists.count()

    work = _Comparison(texts, classes, folder, percent)
    for turn in range(ROUNDS):
        members = work.labelled(lists, "node").withColumnRenamed("l_node", "label")
        parts = members.groupBy("key", "label").agg(F.count("*").alias("n"), F.max(F.struct("common", "node")).alias("best"))
        parts = written(fitted(parts, rows), folder, f"parts{turn}")
        spans = parts.groupBy("key").agg(
            F.sum("n").alias("all"), F.max(F.struct("n", "label")).alias("main"), F.count("*").alias("parts"), F.max("best").alias("best")
        ).where("parts > 1")
        if turn % 2:  # the best one outside the list's largest component
            outside = parts.join(spans.select("key", F.col("main.label").alias("main")), "key").where("label <> main")
            hubs = outside.groupBy("key").agg(F.max("best").alias("best")).select("key", F.col("best.node").alias("hub"))
        else:
            hubs = spans.select("key", F.col("best.node").alias("hub"))
        met = work.labelled(members.join(hubs, "key").select("node", "label", "hub").distinct(), "hub").where("label <> l_hub")
        work.compare(_ordered(met, "node", "hub"), rows)
        # A list of two is done; so is one that a single component holds.
        lists = members.join(spans.where("all > 2").select("key"), "key", "left_semi").select("node", "common", "key")
        lists = written(fitted(lists, rows), folder, f"lists{turn}")
    work.compare(work.left_over(lists, rows))

    nodes = work.labelled(classes.select("node", "first_id"), "node")
    firsts = nodes.groupBy("l_node").agg(F.min("first_id").alias("component_id"))
    found = nodes.join(firsts, "l_node").select("node", "component_id", F.col("l_node").alias("component"))
    rows = signed.select("doc_id", "text_key", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("node")).alias("node"))
    return rows.join(found, "node", "left").drop("node")


def near_duplicates(documents: DataFrame, percent: int = 80, folder: str | None = None) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept."""
    rows = _assigned(documents, percent, folder or shared_folder(documents.sparkSession))
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_first(documents: DataFrame, percent: int = 80) -> DataFrame:
    """One document of each component, that with the smallest doc_id, with its own columns; all without words."""
    folder = shared_folder(documents.sparkSession)
    rows = _assigned(documents, percent, folder).where(F.col("component").isNotNull())
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key"))
    firsts = rows.groupBy("component").agg(first.alias("f")).select(F.col("f.doc_id").alias("_kept_id"), F.col("f.text_key").alias("_kept_key"))
    firsts = written(firsts, folder, "firsts")
    key = F.xxhash64(F.coalesce(documents["text"], F.lit("")))
    same = documents["doc_id"].cast("long").eqNullSafe(F.col("_kept_id")) & (key == F.col("_kept_key"))
    kept = documents.join(firsts, same, "left_semi")
    if not rows.groupBy("doc_id", "text_key").count().where("count > 1").isEmpty():  # rows that occur twice
        kept = kept.dropDuplicates(["doc_id", "text"])
    wordless = ~F.coalesce(documents["text"], F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return kept.unionByName(documents.where(wordless))
