"""Quality rules: a threshold table compiled into one projection.

Every measure is a built-in column expression over one row, so the whole table of rules is
one `select` without a shuffle and without user functions. Words are `[^\\x20\\x09-\\x0D]+`.

The stop words are those of English, French, German and Spanish. Texts of 30 words or more in other
languages have next to none of them, so they fail the rule `stop_words` however clean they are.

Defined cases: null text counts as empty (no words, so it fails the base rule); any other
column may be null or missing; repeated rows are judged alike; extra columns are ignored by
`quality_report` and kept as they are by `keep_good`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"
WINDOW = 5

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in a is that for it on with as was be by at from this are or an not have "
    "le la les de des un une du en que et est pour dans qui au avec sur par pas ce "
    "der die das und ist zu den mit von ein eine nicht sich auf im dem für als auch es "
    "el los las y del se con para su una lo más o como"
).split()


@dataclass(frozen=True)
class Rule:
    """A document with at least `min_words` words fails if its measure is beyond the bound."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None
    min_words: int = 0

    def passes(self, measures: Column) -> Column:
        value = measures[self.measure]
        inside = F.lit(True)
        if self.low is not None:
            inside = inside & (value >= self.low)
        if self.high is not None:
            inside = inside & (value <= self.high)
        return (measures["n_words"] < self.min_words) | inside


RULES = (
    Rule("mean_word", "mean_word_chars", low=2, high=15, min_words=20),
    Rule("symbols", "symbol_ratio", high=0.05),
    Rule("stop_words", "stop_word_ratio", low=0.06, min_words=30),
    Rule("lines", "dup_line_ratio", high=0.4),
    Rule("stutter", "stutter_ratio", high=0.3, min_words=20),
)


def _let(value: Column, use) -> Column:
    """`use` of a value that is computed once per row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _forms(words) -> list[str]:
    """Words as they stand in a sentence: either case, with a mark behind or not."""
    return sorted({w + mark for word in words for w in (word, word.capitalize()) for mark in ("", ".", ",")})


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))


def _covered(positions: Column) -> Column:
    """How many places the windows that begin at these sorted positions cover."""
    steps = F.transform(
        positions, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(positions, i + 1) - p, F.lit(WINDOW)))
    )
    return F.aggregate(steps, F.lit(0), lambda total, x: total + x)


def _repeat_words(words: Column) -> Column:
    """Words in windows of five words found twice or more; windows are told apart by 64-bit hashes."""

    def of_keys(keys: Column) -> Column:
        pairs = F.array_sort(F.transform(keys, lambda key, i: F.struct(key.alias("key"), i.alias("at"))))

        def of_sorted(pairs: Column) -> Column:
            same = lambda x, i: F.coalesce(F.get(pairs, i)["key"] == x["key"], F.lit(False))
            repeated = F.filter(pairs, lambda x, i: same(x, i - 1) | same(x, i + 1))
            return _let(F.array_sort(F.transform(repeated, lambda x: x["at"])), _covered)

        return F.when(F.size(F.array_distinct(keys)) < F.size(keys), _let(pairs, of_sorted)).otherwise(F.lit(0))

    keys = F.transform(F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    return F.when(F.size(words) >= WINDOW, _let(keys, of_keys)).otherwise(F.lit(0))


def measures(text: Column) -> Column:
    """One struct with every count and ratio that rules can name."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    stops = _forms(STOP_WORDS)

    def of_counts(c: Column) -> Column:
        return F.struct(
            *(c[name].cast("long").alias(name) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
            _ratio(c["word_chars"], c["n_words"]).alias("mean_word_chars"),
            _ratio(c["n_symbols"], c["word_chars"]).alias("symbol_ratio"),
            _ratio(c["n_stop"], c["n_words"]).alias("stop_word_ratio"),
            _ratio(c["n_dup_lines"], c["n_lines"]).alias("dup_line_ratio"),
            _ratio(c["n_stutter"], c["n_words"]).alias("stutter_ratio"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(F.size(lines).alias("all"), F.size(F.array_distinct(lines)).alias("distinct"))

    def of_words(w: Column) -> Column:
        return _let(
            _let(lines, of_lines),
            lambda ls: F.struct(
                F.size(w).alias("n_words"),
                F.length(F.array_join(w, "")).alias("word_chars"),
                (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).alias("n_symbols"),
                ls["all"].alias("n_lines"),
                (ls["all"] - ls["distinct"]).alias("n_dup_lines"),
                _repeat_words(w).alias("n_repeat_words"),
                F.size(F.filter(w, lambda x: x.isin(stops))).alias("n_stop"),
                F.size(F.filter(w, lambda x, i: F.coalesce(F.get(w, i - 1) == x, F.lit(False)))).alias("n_stutter"),
            ),
        )

    return _let(_let(words, of_words), of_counts)


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])


def verdict(m: Column, rules=RULES) -> Column:
    """True where the base rule and every rule of the table pass."""
    kept = ~base_failed(m)
    for rule in rules:
        kept = kept & rule.passes(m)
    return kept


def quality_report(documents: DataFrame, rules=RULES) -> DataFrame:
    """Per document: id, counts, whether the base rule failed, verdict, and the rules that failed."""
    found = documents.select("doc_id", measures(F.col("text")).alias("m"))
    m = F.col("m")
    failed = F.filter(F.array(*(F.when(~rule.passes(m), F.lit(rule.name)) for rule in rules)), lambda x: x.isNotNull())
    return found.select(
        "doc_id",
        *(m[name].alias(name) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        base_failed(m).alias("base_failed"),
        verdict(m, rules).alias("kept"),
        F.concat_ws(",", failed).alias("failed_rules"),
    )


def keep_good(documents: DataFrame, rules=RULES) -> DataFrame:
    """The documents that pass, with their own columns."""
    return documents.where(_let(measures(documents["text"]), lambda m: verdict(m, rules)))
