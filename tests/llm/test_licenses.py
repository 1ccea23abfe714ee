"""Licence paragraphs: families, look-alikes, places, defined cases."""

import random
import textwrap

import numpy as np
import pytest

from talkscout.llm import licenses

PROSE = [f"Anst the ouer {a}ing of heon {b}tion and thner was ed." for a in ("bl", "st", "ha") for b in ("re", "on", "ti", "es")] * 8


@pytest.fixture(scope="module")
def model():
    return licenses.train(PROSE)


def test_families(model):
    for family, names in licenses.NAMES.items():
        found = model.judge(f"This work is licensed under the {names[0]}.")
        assert found[0] == family and found[3], (family, found)
    for family, notices in licenses.NOTICES.items():
        assert model.judge(notices[0])[0] == family


def test_lookalikes_and_prose_are_unknown(model):
    for text in [*licenses.LOOKALIKES, *PROSE[:12], "", "The license of the hotel bar was sold."]:
        family, _, _, confirmed = model.judge(text)
        assert family == licenses.UNKNOWN or not confirmed, text


def test_held_out_accuracy(model):
    rows = licenses.examples(PROSE, seed=99)
    right = sum(model.judge(text)[0] == family for text, family in rows)
    assert right / len(rows) > 0.9


def test_scan_agrees_with_scoring_every_line(model):
    text = "Anst the ouer.\nLicensed under the Apache License, Version 2.0.\nReed.\n\n(Released under the MIT License.)\nOf heon"
    found = list(model.scan(text))
    assert [(text[a:b], f) for a, b, f, *_ in found] == [
        ("Licensed under the Apache License, Version 2.0.", "apache-2.0"), ("(Released under the MIT License.)", "mit"),
    ]
    assert [f for line in text.split("\n") if (f := model.judge(line)[0]) != licenses.UNKNOWN] == ["apache-2.0", "mit"]


def test_defined_cases(spark, model):
    notice = "Licensed under CC BY-NC 4.0."
    rows = [(1, None), (2, ""), (None, notice), (3, "word " * 100_000 + "\n" + notice), (4, notice), (4, notice)]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING").selectExpr("*", "1 AS family", "'x' AS similarity")
    got = sorted(((r.doc_id, r.families) for r in licenses.license_report(df, model).collect()), key=str)
    assert got == sorted([(1, ""), (2, ""), (None, "cc-by-nc"), (3, "cc-by-nc"), (4, "cc-by-nc"), (4, "cc-by-nc")], key=str)
    places = licenses.license_paragraphs(df, model).where("doc_id = 3").collect()
    assert [(r.start, r.end) for r in places] == [(500_001, 500_001 + len(notice))]
    assert licenses.license_report(df.limit(0), model).count() == 0
    assert licenses.sample_paragraphs(df.limit(0)) == []


def wrapped(text, width):
    return "\n".join(textwrap.wrap(text, width))


@pytest.mark.parametrize("prose", [PROSE, [*PROSE, *(f"permission license software copyright notice warranty {i} free copies" for i in range(200))]])
def test_wrapped_notices_are_found_whatever_words_are_common(prose):
    """The bodies alone, without a title, between other lines and as paragraphs of their own."""
    found = licenses.train(prose)
    for family in ("mit", "bsd", "apache-2.0", "gpl", "isc", "lgpl", "agpl", "mpl-2.0", "unlicense", "zlib"):
        for width in (40, 72, 1000):
            for gap in ("\n", "\n\n"):
                text = gap.join([PROSE[0], wrapped(licenses.NOTICES[family][0], width), PROSE[1]])
                sure = [r for r in found.scan(text) if r[5]]
                assert [r[2] for r in sure] == [family], (family, width, gap, list(found.scan(text)))
                assert sure[0][4] > 0.6


def plain_scan(model, text):
    """All stretches of all paragraphs scored, those without an anchor dropped at the end."""
    out, at, lines = [], 0, []
    for line in [*text.split("\n"), ""]:
        if line.strip():
            lines.append((at, at + len(line)))
        else:
            sizes = [2**i for i in range(6) if 2**i < 2 * max(len(lines), 1)]
            spans = {(a, min(a + n, len(lines))) for n in sizes for a in range(0, len(lines), max(1, n // 2))}
            scored = []
            for a, b in spans:
                start, end = lines[a][0], lines[b - 1][1]
                words = licenses.words_of(text[start:end])
                dense = np.zeros(len(model.vocabulary))
                dense[[model.vocabulary[g] for g in licenses.ngrams(words) if g in model.vocabulary]] = 1
                z = (dense @ model.weights + model.bias) / model.temperature
                p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
                family = model.classes[int(p.argmax())]
                if family != "unknown" and p.max() >= 0.5 and not model.anchors.isdisjoint(words):
                    own = {*zip(words, words[1:]), *((w,) for w in words)}
                    like = max(len(own & t) / len(t) for t in model.templates[family])
                    scored.append((like < 0.6, -round(like, 9), b - a, -round(float(p.max()), 4), a, b, family))
            used = set()
            for *_, a, b, family in sorted(scored):
                if used.isdisjoint(range(a, b)):
                    used |= set(range(a, b))
                    out.append((lines[a][0], lines[b - 1][1], family))
            lines = []
        at += len(line) + 1
    return sorted(out)


def test_scan_against_scoring_every_stretch(model):
    rng = random.Random(3)
    for _ in range(25):
        parts = []
        for _ in range(rng.randrange(1, 7)):
            family = rng.choice(sorted(licenses.NOTICES))
            notice = rng.choice([wrapped(rng.choice(licenses.NOTICES[family]), rng.choice((35, 70))), rng.choice(licenses.FRAMES).format(rng.choice(licenses.NAMES[family]))])
            parts += rng.choices(PROSE, k=rng.randrange(4)) + [rng.choice([notice, rng.choice(licenses.LOOKALIKES)]), *([""] * rng.randrange(2))]
        text = "\n".join(parts)
        got = [(a, b, family) for a, b, family, *_ in model.scan(text)]
        assert got == plain_scan(model, text)


def test_windows_cover_every_line_and_end_at_the_paragraph():
    for n in (1, 2, 3, 5, 8, 31, 32, 33, 100):
        found = list(licenses.windows(n))
        assert len(set(found)) == len(found) and all(0 <= a < b <= n for a, b in found)
        for size in {b - a for a, b in found if b < n}:
            assert set(range(n)) == {i for a, b in found if b - a == size or b == n for i in range(a, b)}


def test_every_notice_has_an_anchor():
    for family in licenses.NAMES:
        for notice in licenses.notices_of(family):
            assert not licenses.anchors().isdisjoint(licenses.words_of(notice)), notice
