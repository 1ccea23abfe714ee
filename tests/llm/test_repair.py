"""Conversation repair against a search over all repairs."""

import hashlib
import itertools
import re
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from talkscout.llm import repair

ROLES = st.sampled_from(["system", "user", "assistant", "tool", "ua", "", " "])
TEXTS = st.sampled_from(["Yes.", "No", "", " \n", "Yes. ", "What?", "x"])


def faults(turns):
    seen, found = set(), []
    for turn in turns:
        text = turn[1].strip(" \t\n\r\x0b\x0c")
        found.append("blank" if not text else "duplicate" if turn in seen else "truncated" if text[-1] not in ".!?" else "")
        seen.add(turn)
    return found


def every_repair(turns, most_inserts):
    """(cost, audit, repaired) of all repairs with at most so many insertions before each turn and behind the last."""
    kinds = faults(turns)

    def rest(i):
        for n in range(most_inserts + 1):
            for added in itertools.product(["user", "assistant"], repeat=n):
                start = (5 * n, "I" * n, [(role, "") for role in added])
                if i == len(turns):
                    yield start
                    continue
                extra = 5 if kinds[i] == "truncated" else 0
                edits = [(2, "D", [])]
                if kinds[i] not in ("blank", "duplicate"):
                    edits += [(extra, "K", [turns[i]]), *((1 + extra, "R", [(role, turns[i][1])]) for role in ("user", "assistant"))]
                for (a, b, c), (d, e, f) in itertools.product(edits, rest(i + 1)):
                    yield start[0] + a + d, start[1] + b + e, start[2] + c + f

    for cost, audit, turns_now in rest(0):
        if all(role[:1] for role, _ in turns_now) and re.fullmatch("(s?(ua)+)?", "".join(role[0] for role, _ in turns_now)):
            yield cost, audit, "\n".join(f"{role}:{text}" for role, text in turns_now)


@settings(max_examples=150, deadline=None)
@given(turns=st.lists(st.tuples(ROLES, TEXTS), max_size=4))
def test_least_of_all_repairs(turns):
    now = repair.Conversation()
    for i, (role, text) in enumerate(turns):
        now.feed(i, role, text.encode())
    cost, audit, text = min(every_repair(turns, 1))
    row = now.row(9)
    assert row[6:9] == (cost, audit, hashlib.sha256(text.encode()).hexdigest())
    kinds = faults(turns)
    assert row[2:5] == tuple(kinds.count(k) for k in ("blank", "duplicate", "truncated"))


def plain(turns):
    """Cost and audit by comparing (cost, letters), from the end."""
    kinds, layer = faults(turns), {0: (0, ""), 3: (0, "")}

    def inserted(layer):
        for _ in range(2):
            for p, role in repair.NEXT.items():
                to = repair.MOVES[p][role[0]]
                if to in layer:
                    new = (layer[to][0] + 5, "I" + layer[to][1])
                    layer[p] = min(layer.get(p, new), new)
        return layer

    layer = inserted(layer)
    for (role, _), kind in zip(reversed(turns), reversed(kinds), strict=True):
        now = {}
        for p in range(4):
            options = [(layer[p][0] + 2, "D" + layer[p][1])] if p in layer else []
            if kind not in ("blank", "duplicate"):
                for c, letter, cost in [(role[:1], "K", 0), ("u", "R", 1), ("a", "R", 1)]:
                    to = repair.MOVES[p].get(c)
                    if to in layer:
                        options.append((layer[to][0] + cost + 5 * (kind == "truncated"), letter + layer[to][1]))
            if options:
                now[p] = min(options)
        layer = inserted(now)
    return layer[0]


@settings(max_examples=60, deadline=None)
@given(turns=st.lists(st.tuples(ROLES, TEXTS), max_size=120), places=st.sampled_from([12, 16, 40]))
def test_long_conversations_settle(turns, places):
    now, kinds = repair.Repair(places), faults(turns)
    for (role, text), kind in zip(turns, kinds, strict=True):
        now.feed(role, text.encode(), kind == "truncated", kind in ("blank", "duplicate"))
    assert now.finish()[:2] == plain(turns)


def test_very_long_conversation():
    turns = [(role, f"{i}.") for i in range(20_000) for role in ("user", "tool")]
    now = repair.Repair()
    for role, text in turns:
        now.feed(role, text.encode(), False, False)
    cost, audit, _, n = now.finish()
    assert (cost, audit, n) == (20_000, "KR" * 20_000, 40_000)


def test_query_columns_and_defined_cases(spark):
    rows = [
        (1, 0, "user", "Hi."), (1, 1, "assistant", "Ho."), (2, None, None, None), (None, 3, "system", "Do."), (None, 3, "system", "Do."),
        (None, 9, "user", "Go."), (3, 2, "user", "Cut"), (3, 2, "assistant", "Yes."), (4, 1, "", "No."), (4, 7, "user", "A."),
    ]
    df = spark.createDataFrame(rows, "conv_id LONG, turn LONG, role STRING, text STRING").selectExpr("*", "1 AS gaps", "'x' AS audit", "2 AS copies")
    got = {r.conv_id: r for r in repair.repaired(repair.undamaged(df)).collect()}
    assert got.keys() == {1, 2, 3, 4, None}
    assert (got[1].cost, got[1].audit, got[1].gaps) == (0, "KK", 0)
    assert (got[2].blank, got[2].gaps, got[2].audit) == (1, 0, "D")
    assert (got[None].duplicate, got[None].gaps, got[None].illegal, got[None].audit) == (1, 5, 1, "RDR")
    assert (got[3].truncated, got[3].audit, got[3].cost) == (1, "DD", 4)
    assert (got[4].illegal, got[4].gaps, got[4].cost, got[4].audit) == (1, 5, 2, "RR")
    assert repair.repaired(repair.damaged(df.limit(0))).count() == 0


def test_damage(spark):
    rows = [(c, t, "assistant", f"Well. {c}!") for c in range(60) for t in range(3)]
    df = spark.createDataFrame(rows, "conv_id LONG, turn LONG, role STRING, text STRING")
    for r in repair.damaged(df).collect():
        kind = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        text = "" if kind in (0, 1) else f"Well {r.conv_id}" if kind == 2 else f"Well. {r.conv_id}!"
        assert (r.role, r.text, r.copies) == ("user" if kind == 4 else "assistant", text, {0: 0, 3: 2}.get(kind, 1))
    got = repair.repaired(repair.damaged(df)).collect()
    assert sorted(r.conv_id for r in got) == list(range(60))


def test_all_rows_dropped(spark):
    one = next((c, t) for c in range(1000) for t in range(20) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(*one, "user", "Hi.")], "conv_id LONG, turn LONG, role STRING, text STRING")
    row = repair.repaired(repair.damaged(df)).first()
    assert tuple(row)[:9] == (one[0], 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_against_sql(spark):
    from checks.compare import duck
    from talkscout.llm.oracles import ORACLES
    from talkscout.llm.queries import QUERIES

    name, sf = "op11_conversation_repair", "/root/testdata/sf0.001"
    got = sorted(map(tuple, QUERIES[name](spark, sf).collect()))
    want = sorted(duck(sf).execute(ORACLES[name]).fetchall())
    assert got == want
