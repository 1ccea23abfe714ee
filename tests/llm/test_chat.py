"""Chat formatting: reversible template, loss masks, defined cases."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from talkscout.llm import chat

TURNS = "conv_id LONG, turn LONG, role STRING, text STRING"
pieces = st.sampled_from(["</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<ROLE x>>", "<</ROLE>>", "\\", "<", ">", "[", " ", "\n", "ok", "é"])
texts = st.lists(pieces, max_size=8).map("".join)
roles = st.one_of(st.sampled_from(["user", "assistant", "system", ""]), texts)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(roles, texts), max_size=5))
def test_turns_read_back(turns):
    assert chat.parse_turns("".join("".join(chat.format_turn(r, t)) for r, t in turns)) == turns


@settings(max_examples=200, deadline=None)
@given(texts)
def test_escaped_texts_hold_no_control_string(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not [m for m in chat.CONTROL.findall(escaped) if m != "\\"]


def test_examples(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "a </s>"), (1, 2, "user", "more"), (1, 3, "assistant", "b"), (1, 4, "user", "bye")]
    got = chat.prefix_targets(spark.createDataFrame(rows, TURNS)).orderBy("example").collect()
    assert [chat.unescape(r.text[r.mask_start : r.mask_end]) for r in got] == ["a </s>", "b", ""]
    assert [chat.parse_turns(r.text) for r in got] == [[r[2:] for r in rows[:n]] for n in (2, 4, 5)]


def test_defined_cases(spark):
    rows = [
        (1, 0, "assistant", None), (1, 0, "assistant", None), (2, None, None, "x"), (2, 0, "user", "y"),
        (None, 0, "user", "q"), (None, 1, "assistant", "z" * 500_000), (3, 1, "assistant", "b"), (3, 1, "assistant", "a"),
    ]
    df = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 AS n_turns", "'x' AS mask_start")
    got = {r.conv_id: r for r in chat.read_back(chat.prefix_targets(df)).collect()}
    sha = lambda *turns: hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    assert got[1].turns_sha256 == sha(("assistant", ""), ("assistant", "")) and got[1].loss_chars == 0 and got[1].n_examples == 2
    assert got[2].turns_sha256 == sha(("", "x"), ("user", "y")) and got[2].n_turns == 2 and got[2].n_examples == 1
    assert got[None].loss_chars == 500_000
    assert got[3].loss_sha256 == hashlib.sha256(b"ab").hexdigest()
    empty = spark.createDataFrame([], TURNS)
    assert chat.read_back(chat.prefix_targets(empty)).count() == 0
