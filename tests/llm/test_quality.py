"""Quality rules against a plain version, and that they are one projection."""

from collections import Counter

from talkscout.llm import quality

DOCS = "doc_id LONG, text STRING"


def plain(text):
    text = text or ""
    words = [w.decode() for w in text.encode().split()]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if x.encode().split()]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
        len(words) < 10 or 100 * len(covered) > 20 * len(words),
    )


def test_counts(spark):
    texts = [
        None, "", "   \n\t ", "one", "a b c d e a b c d e", "a a a a a a a a", "x\ny\nx\nx\n \n \n", "é ü # $$ <b>|&", " a\xa0b c", "a\x0bb\x0cc\rd",
        "the of and " * 30, "w*** " * 20, "long words here " * 40_000, " lead and trail ", "a b c d e f a b c d x a b c d e g",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, "x"), (3, "one")], DOCS).selectExpr("*", "1 AS kept", "2 AS m", "3 AS n_words")
    got = {r.doc_id: r for r in quality.quality_report(df.select("doc_id", "text")).collect()}
    for i, text in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain(text), text
    assert quality.quality_report(df).count() == len(texts) + 2
    assert quality.keep_good(df).columns == df.columns
    assert quality.quality_report(df.limit(0)).count() == 0


def test_rules(spark):
    good = "The house of the old man is near to the river and it was built with stones for his family. "
    texts = [good, "Er Er Er Er Er " * 3, "anst*** bler### " * 20, "blith drom fant gorl hesp " * 10, " | ".join(f"w{i}" for i in range(60))]
    texts[3] = " ".join(f"{a}{b}" for a in ("bli", "dro", "fan", "gor", "hes", "kim") for b in ("th", "mp", "lt", "sk", "rn", "pt"))
    got = [r.kept for r in quality.quality_report(spark.createDataFrame(list(enumerate(texts)), DOCS)).orderBy("doc_id").collect()]
    assert got == [True, False, False, False, False]


def test_one_projection(spark):
    df = spark.createDataFrame([(1, "a")], DOCS)
    plan = quality.quality_report(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
