"""Toxicity scores from a learned lexicon, Levenshtein automata and context windows.

Training takes a bounded sample of labelled documents. Terms are whole words, or stems that take
several endings, which toxic documents hold in different surroundings (so that what only copies
of one document share is no term) and next to no clean ones do. Words and stems form a trie. A word of a text that is no term is run through the
trie together with the Levenshtein automaton of the word, so that misspelled terms are found in
one walk: one edit for terms of five letters and more, two from eight on. A stem may match any
beginning of the word, but a word that only begins the stem is no form of it. Since a stem with its
last letters changed is a shorter stem, which training has passed over, that counts as a kind of
its own with its own learned worth; digits and signs that
stand for letters are read as such first. Words seen in clean training documents never count as
misspellings. How much others do is learned for each term: its near words speak for toxic documents,
and those that a single clean document holds against it, as they would have been new without that
document; the prior weighs as much as the documents with the term itself tell. Around each hit a window of words tells quotation (quotation marks, words of
reporting) from abuse; quoted hits weigh little. A document's score combines its hits' learned
precisions; without a hit it is the learned share of toxic documents without one.

Scores use nothing but the text; labels, lang, source and doc_id are no inputs.

Defined cases: null and empty texts have no hit and get the score for that; labels that are null
or belong to no document are passed over, and of several labels for a document the largest counts;
without labels the lexicon is empty and every score low; repeated rows score alike; a null doc_id
counts as the empty text in held_out; other columns are ignored by `scores` and kept by `keep_clean`.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkscout.llm.shared import shared_folder, small_batches, written

#: Bounds of the training sample: labelled documents of each class, those with the least hashes of doc_id.
MOST_TOXIC = 6_000
MOST_CLEAN = 12_000
#: Bound of the fit: so many words and stems are candidates for terms, those of the most toxic documents of the sample.
MOST_TERMS = 40_000
LEAST_PLACES = 3
LEAST_ENDINGS = 5
CHANCE = 0.05
CLEAN_SHARE = 0.02
STEM_CHARS = (4, 12)
WINDOW = 6
CACHED_WORDS = 400_000
#: Prior: of ten documents with a term one more misspells it, and of ten that seem to, nine are toxic.
MISSPELLED, MISSPELLED_TOXIC = 0.1, 0.9
#: For a stem whose last letters are changed it is every other one.
CHANGED_END_TOXIC = 0.5
NEAR = pa.list_(pa.struct([("term", pa.string()), ("word", pa.string())]))
SCORES = "doc_id long, held_out boolean, score double, predicted int, n_hits int"

LETTERS = re.compile(r"[^\W\d_]+")
# Signs written for letters, marks of quotation, words of reporting.
LEET = str.maketrans("013457@$!", "oieastasi")
QUOTES = re.compile("[\"“”„«»‘’]")
REPORTS = frozenset(
    "said says say called calls call wrote writes quoted quote quotes word words term terms "
    "dit disait mot citation sagte nannte wort zitat dijo llamó palabra cita".split()
)


def automaton_walk(trie: dict, word: str, edits: int) -> list[tuple[str, int]]:
    """Terms within so many edits of a word: the word's Levenshtein automaton, run on the trie.

    The automaton's states (characters read, edits) are bits, one number for each count of edits. Stems,
    below a star, are within so many edits of a beginning of the word; their names end in a star,
    or in a tilde if their last letter has to be changed for that.
    """
    size = len(word)
    chars: dict[str, int] = {}
    for i, c in enumerate(word):
        chars[c] = chars.get(c, 0) | 1 << i
    full = (1 << (size + 1)) - 1
    found = []
    stack = [(trie, tuple((1 << (e + 1)) - 1 & full for e in range(edits + 1)))]
    while stack:
        node, states = stack.pop()
        for c, child in node.items():
            if c == "":
                least = next((e for e, s in enumerate(states) if s >> size & 1), None)
                if least is not None:
                    found.append((child, least))
                continue
            if c == "*":
                continue
            match, moved = chars.get(c, 0), []
            for e, s in enumerate(states):
                now = (s & match) << 1
                if e:
                    before = states[e - 1]
                    now |= before | before << 1 | moved[e - 1] << 1
                moved.append(now & full)
            if stem := child.get("*"):
                least = next((e for e, s in enumerate(states) if (s & match) << 1 & full), None)
                changed = next((e for e, s in enumerate(moved) if s), None)
                if least is not None:
                    found.append((stem + "*", least))
                elif changed is not None and not stem.startswith(word):
                    found.append((stem + "~", changed))
            if any(moved):
                stack.append((child, tuple(moved)))
    return found


def edits_for(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 8 else 2


def unchanged_parts(term: str) -> list[str]:
    """One part more than edits: at least one of them stands unchanged in each misspelling."""
    n = edits_for(term) + 1
    return [term[i * len(term) // n : (i + 1) * len(term) // n] for i in range(n)]


@dataclass
class Lexicon:
    """Learned terms with their precisions; `clean` holds words that are no misspellings, `near` what a misspelled term's
    precision is multiplied by, if not by `fuzzy`. In `near` a star follows stems, a tilde stems with a changed end."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    fuzzy: float = 0.9
    none: float = 0.05
    clean: frozenset = frozenset()
    near: dict[str, float] = field(default_factory=dict)

    def __post_init__(self):
        self.trie: dict = {}
        alone = [term for term in self.words if edits_for(term)]
        begun = [stem for stem in self.stems if edits_for(stem)]
        for term, end in [*((term, "") for term in alone), *((stem, "*") for stem in begun)]:
            node = self.trie
            for c in term:
                node = node.setdefault(c, {})
            node[end] = term
        parts = sorted({part for term in alone for part in unchanged_parts(term)})
        self.parts = re.compile("|".join(map(re.escape, parts))) if parts else None
        self.lengths = {n for term in alone for n in range(len(term) - edits_for(term), len(term) + edits_for(term) + 1)}
        # A part of a stem stands no further from its place than there are edits.
        places = sorted({(len(stem) * i // (e + 1), e, part) for stem in begun for e in [edits_for(stem)] for i, part in enumerate(unchanged_parts(stem))})
        places = [f".{{{max(at - e, 0)},{at + e}}}{re.escape(part)}" for at, e, part in places]
        self.beginnings = re.compile("|".join(places), re.DOTALL) if places else None
        self.known: dict[str, tuple] = {}

    def __reduce__(self):
        return Lexicon, (self.words, self.stems, self.fuzzy, self.none, self.clean, self.near)

    def exact(self, word: str) -> tuple[str, float] | None:
        if word in self.words:
            return word, self.words[word]
        for n in range(STEM_CHARS[0], min(len(word), STEM_CHARS[1]) + 1):
            if word[:n] in self.stems:
                return word[:n], self.stems[word[:n]]
        return None

    def nearest(self, word: str) -> str | None:
        """The term that a word misspells; a star follows stems, a tilde stems with a changed end."""
        whole = len(word) in self.lengths and self.parts.search(word)
        if not (whole or self.beginnings and self.beginnings.match(word)) or word in self.clean:
            return None
        found = [(e, term) for term, e in automaton_walk(self.trie, word, 2) if e <= edits_for(term.rstrip("*~"))]
        return min(found, key=lambda x: (x[1][-1] == "~", x))[1] if found else None

    def misspelled(self, word: str) -> tuple[str, float] | None:
        term = self.nearest(word)
        if not term:
            return None
        if term in self.words:
            return term, self.words[term] * self.near.get(term, self.fuzzy)
        worth = self.near.get(term, CHANGED_END_TOXIC if term[-1] == "~" else self.fuzzy)
        return term[:-1], self.stems[term[:-1]] * worth

    def evidence(self, token: str) -> tuple[bool, set[tuple[str, str]]]:
        """Whether a token's words hold a term itself, and (term, word) of those that misspell one."""
        words = {word for _, word in _readings(token.lower())}
        own = {word for word in words if self.exact(word)}
        return bool(own), {(term, word) for word in words - own if (term := self.nearest(word))}

    def lookup(self, token: str) -> tuple[tuple[str, float, bool], ...]:
        """(term, precision, whether exact) of each hit in a text's token."""
        hits = self.known.get(token)
        if hits is None:
            if len(self.known) >= CACHED_WORDS:
                self.known.clear()
            hits = self.known[token] = tuple(self._lookup(token))
        return hits

    def _lookup(self, token: str) -> Iterator[tuple[str, float, bool]]:
        lower = token.lower()
        parts = LETTERS.findall(lower)
        exact = [hit for part in parts if (hit := self.exact(part))]
        if exact:
            yield from ((*hit, True) for hit in exact)
            return
        for part, folded in _readings(lower):
            if folded != part and (hit := self.exact(folded)):
                yield (*hit, False)
                return
            if hit := self.misspelled(folded):
                yield (*hit, False)
                return

    def hits(self, text: str) -> list[tuple[int, tuple]]:
        """(place among the tokens, hit) of all hits."""
        tokens = text.split()
        if not any(map(self.lookup, set(tokens))):
            return []
        return [(i, hit) for i, token in enumerate(tokens) for hit in self.lookup(token)]

    def score(self, text: str) -> tuple[float, int]:
        """Score of a text, and its number of hits."""
        hits = self.hits(text)
        if not hits:
            return self.none, 0
        tokens = text.split()
        abuse, quoted = 1.0, 1.0
        best: dict[tuple[str, bool], float] = {}
        for place, (term, precision, _) in hits:
            kind = quotation(tokens, place)
            key = (term, kind)
            best[key] = max(best.get(key, 0.0), precision)
        for (_, kind), precision in best.items():
            if kind:
                quoted *= 1 - 0.3 * precision
            else:
                abuse *= 1 - precision
        return 1 - abuse * max(quoted, 0.55), len(hits)


def _readings(token: str) -> list[tuple[str, str]]:
    """The parts of a token in lower case, and each with letters for signs."""
    whole = token.strip(".,;:!?\"'()[]{}*#$%&|<>_-~`“”„«»‘’…")
    return [(x, x if x.isalpha() else x.translate(LEET)) for x in dict.fromkeys([*LETTERS.findall(token), whole])]


def quotation(tokens: list[str], place: int) -> bool:
    """Whether the token stands between quotation marks with a word of reporting near."""
    start = max(0, place - WINDOW)
    before, after = tokens[start:place], tokens[place + 1 : place + 1 + WINDOW]
    own = tokens[place]
    opened = sum(len(QUOTES.findall(t)) for t in before) + bool(QUOTES.match(own))
    closed = sum(len(QUOTES.findall(t)) for t in after) + bool(QUOTES.search(own[1:]))
    near = {w for t in (*before, *after) for w in LETTERS.findall(t.lower())}
    return opened % 2 == 1 and closed > 0 and not near.isdisjoint(REPORTS)


def _texts(batches: Iterator[pa.RecordBatch], rows: int = 512):
    for batch in small_batches(batches, rows):
        yield batch, [x.decode("utf-8", "replace") if x else "" for x in batch.column("text").cast(pa.binary()).to_pylist()]


def _terms_of(text: str) -> set[str]:
    """Words of a text, and their beginnings, which end in a star."""
    words = set(LETTERS.findall(text.lower()))
    low, high = STEM_CHARS
    return {w for w in words if len(w) >= 3} | {w[:n] + "*" for w in words for n in range(low, min(high, len(w)) + 1)}


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per term and class, summed up within a task."""
    counts: dict[int, Counter] = {0: Counter(), 1: Counter()}

    def flush():
        for toxic, found in counts.items():
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(found), pa.string()), pa.array([toxic] * len(found), pa.int32()), pa.array(list(found.values()), pa.int64())],
                    names=["term", "toxic", "n"],
                )
            found.clear()

    for batch, texts in _texts(batches):
        for toxic, text in zip(batch.column("toxic").to_pylist(), texts, strict=True):
            counts[toxic].update(_terms_of(text))
        if sum(map(len, counts.values())) > 300_000:
            yield from flush()
    yield from flush()


def _places(terms: frozenset):
    """Where terms stand: term, word, the two words before and the two behind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _texts(batches, 128):
            found = set()
            for text in texts:
                words = ["", "", *LETTERS.findall(text.lower()), "", ""]
                for i in range(2, len(words) - 2):
                    word = words[i]
                    for n in (0, *range(STEM_CHARS[0], min(STEM_CHARS[1], len(word)) + 1)):
                        term = word[:n] + "*" if n else word
                        if term in terms:
                            found.add((term, word, f"{words[i - 2]} {words[i - 1]}", f"{words[i + 1]} {words[i + 2]}"))
            columns = zip(*found, strict=True) if found else ([], [], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["term", "word", "before", "behind"])

    return run


def surroundings(before: np.ndarray, behind: np.ndarray) -> int:
    """How many groups of places there are, if those that share what is before or behind are one.

    Copies with a changed word still share one side.
    """
    left, right = (np.unique(side, return_inverse=True) for side in (before, behind))
    pairs = np.unique(np.stack([left[1], right[1] + len(left[0])], axis=1), axis=0)
    parent = list(range(len(left[0]) + len(right[0])))

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    groups = len(parent)
    for x, y in pairs.tolist():
        x, y = root(x), root(y)
        groups -= x != y
        parent[x] = y
    return groups


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of places and distinct words per term; the rows come sorted by term, and one term's are held as numbers."""
    current, held = None, []

    def judged(term: str, parts: list[np.ndarray]) -> pa.RecordBatch:
        word, before, behind = np.concatenate(parts, axis=1)
        columns = [pa.array([term]), pa.array([surroundings(before, behind)], pa.int64()), pa.array([len(np.unique(word))], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["term", "groups", "endings"])

    for batch in batches:
        terms = batch.column("term").to_pylist()
        sides = np.stack([batch.column(n).to_numpy() for n in ("word", "before", "behind")])
        starts = [i for i, term in enumerate(terms) if not i or term != terms[i - 1]]
        for i, j in zip(starts, [*starts[1:], len(terms)], strict=True):
            if terms[i] != current and held:
                yield judged(current, held)
                held = []
            current = terms[i]
            held.append(sides[:, i:j])
    if held:
        yield judged(current, held)


def judged_terms(toxic_rows: DataFrame, terms: frozenset, least: int) -> dict[str, int]:
    """The terms in at least so many different surroundings, with their number of distinct words."""
    places = toxic_rows.mapInArrow(_places(terms), "term string, word string, before string, behind string")
    places = places.select("term", *(F.xxhash64(n).alias(n) for n in ("word", "before", "behind"))).distinct()
    judged = places.repartition("term").sortWithinPartitions("term").mapInArrow(_judge, "term string, groups long, endings long")
    return {r.term: r.endings for r in judged.where(F.col("groups") >= least).collect()}


def choose_terms(counts: dict[str, tuple[int, int]], endings: dict[str, int]) -> list[str]:
    """Of terms in enough different surroundings: stems with several endings, the longest of equals, then words beside them."""
    stems: list[str] = []
    strong = (t for t, n in endings.items() if t.endswith("*") and n >= LEAST_ENDINGS)
    for t in sorted(strong, key=lambda t: (-counts[t][0], -len(t), t)):
        inside = sum(counts[s][0] for s in stems if s.startswith(t[:-1]))
        if not any(t[:-1].startswith(s[:-1]) for s in stems) and inside < 0.9 * counts[t][0]:
            stems.append(t)
    words = [t for t in endings if not t.endswith("*") and not any(t.startswith(s[:-1]) for s in stems)]
    return stems + sorted(words)


def _evidence(lexicon: Lexicon):
    """Per document: class, whether terms themselves hit, and the words that only nearly match, each with its term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _texts(batches):
            exact, near = [], []
            for text in texts:
                found = [lexicon.evidence(t) for t in set(text.split()) if lexicon.lookup(t)]
                exact.append(any(own for own, _ in found))
                near.append([{"term": term, "word": word} for term, word in sorted(set().union(*(pairs for _, pairs in found)))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(exact, pa.bool_()), pa.array(near, NEAR)], names=["toxic", "exact", "near"]
            )

    return run


def held_out(doc_id):
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def train(documents: DataFrame, labels: DataFrame) -> Lexicon:
    """Learn a lexicon from labelled documents that are not held out."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("label_id")).agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    totals = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}

    def part(toxic: int, most: int) -> DataFrame:
        """The rows with the least hashes; a bound on the hash first leaves little more than these to sort."""
        share = min(1.0, 1.2 * most / max(totals.get(toxic, 0), 1) + 1e-4)
        near = known.where((F.col("toxic") == toxic) & (F.pmod(F.xxhash64("label_id"), F.lit(1_000_000)) <= int(share * 1_000_000)))
        return near.orderBy(F.pmod(F.xxhash64("label_id"), F.lit(1_000_000)), "label_id").limit(most)

    sample = part(1, MOST_TOXIC).union(part(0, MOST_CLEAN))
    own = documents.select(F.col("doc_id").cast("long").alias("label_id"), "text")
    # The sample has at most MOST_TOXIC + MOST_CLEAN rows of two numbers.
    of = lambda c: F.sum(F.when(F.col("toxic") == c, F.col("n")).otherwise(0))
    folder = shared_folder(documents.sparkSession)
    rows = written(own.join(F.broadcast(sample), "label_id").select("toxic", "text"), folder, "sample")
    shares = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    both = rows.mapInArrow(_count_terms, "term string, toxic int, n long").groupBy("term").agg(of(1).alias("t"), of(0).alias("n"))
    both = written(both, folder, "terms")
    # So many documents, in different surroundings, that not even one of all terms is expected to have them, all toxic, by chance.
    share = min(max((shares.get(1, 0) + 0.5) / (sum(shares.values()) + 1), 0.01), 0.9)
    least = max(LEAST_PLACES, math.ceil(math.log(max(both.count(), 1) / CHANCE) / -math.log(share)))
    telling = both.where((F.col("t") >= least) & (F.col("n") <= CLEAN_SHARE * F.col("t"))).orderBy(F.desc("t"), "term").limit(MOST_TERMS)
    counts = {r.term: (r.t, r.n) for r in telling.collect()}
    toxic_rows = rows.where("toxic = 1").select("text")
    chosen = choose_terms(counts, judged_terms(toxic_rows, frozenset(counts), least))
    precision = {term: (counts[term][0] + 0.5) / (sum(counts[term]) + 1) for term in chosen}
    lexicon = Lexicon(
        {term: p for term, p in precision.items() if not term.endswith("*")},
        {term[:-1]: p for term, p in precision.items() if term.endswith("*")},
    )
    seen = rows.mapInArrow(_evidence(lexicon), "toxic int, exact boolean, near array<struct<term:string,word:string>>")
    seen = written(seen.withColumn("id", F.monotonically_increasing_id()), folder, "evidence")
    totals = {r.toxic: r["count"] for r in seen.where("NOT exact").groupBy("toxic").count().collect()}
    near = seen.select("id", "toxic", "exact", F.explode("near").alias("near")).select("id", "toxic", "exact", "near.*")
    words = near.where("toxic = 0").groupBy("word").agg(F.count("*").alias("clean"))
    clean = frozenset(r.word for r in words.select("word").collect())
    # What speaks about a word unknown so far: toxic documents with a word that no clean one has, clean ones with a word that no other has.
    new = near.where("NOT exact").join(words, "word", "left").where("toxic = 1 AND clean IS NULL OR toxic = 0 AND clean = 1")
    by_term = new.groupBy("term").agg(*(F.count_distinct(F.when(F.col("toxic") == c, F.col("id"))).alias(n) for c, n in ((1, "t"), (0, "n"))))
    learned = {}
    for r in by_term.collect():
        prior = MISSPELLED * counts[r.term.replace("~", "*")][0]
        share = CHANGED_END_TOXIC if r.term[-1] == "~" else MISSPELLED_TOXIC
        learned[r.term] = (r.t + share * prior) / (r.t + r.n + prior)
    missed = totals.get(1, 0) - new.where("toxic = 1").select("id").distinct().count()
    none = (missed + 0.5) / (missed + totals.get(0, 0) + 10)
    return Lexicon(lexicon.words, lexicon.stems, MISSPELLED_TOXIC, min(none, 0.49), clean, learned)


def _score(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _texts(batches):
            found = [lexicon.score(text) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array([s for s, _ in found], pa.float64()),
                 pa.array([int(s >= 0.5) for s, _ in found], pa.int32()), pa.array([n for _, n in found], pa.int32())],
                names=["doc_id", "held_out", "score", "predicted", "n_hits"],
            )

    return run


def scores(documents: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Per document: whether held out, score, predicted label, number of hits."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(_score(lexicon), SCORES)


def _keep(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _texts(batches):
            yield batch.filter(pa.array([lexicon.score(text)[0] < 0.5 for text in texts], pa.bool_()))

    return run


def keep_clean(documents: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The documents that are not predicted toxic, with their own columns."""
    return documents.mapInArrow(_keep(lexicon), documents.schema)
