"""Conversation repair against all possible edits of small conversations, and a plain search on longer ones."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import ODD

from caseloom.llm import repair

FORM = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id bigint, turn bigint, role string, text string, copies string, segment int"


def damage(rows):
    """Rows (conv_id, turn, role, text) after damage."""
    out = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(c, t, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        left = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not left else "duplicate" if (role, text) in seen else "" if left[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def choices(fault):
    return "D" if fault in ("blank", "duplicate") else "KRD"


def applied(rows, audit):
    """Roles and texts that an audit leaves; a role that is not kept follows from its place."""
    out, i = [], 0
    for e in audit:
        if e == "I" or e == "R":
            out.append(("assistant" if out and out[-1][0][:1] == "u" else "user", "" if e == "I" else rows[i][3]))
        if e == "K":
            out.append(rows[i][2:])
        i += e != "I"
    return out


def price(rows, found, audit):
    left = [e for e in audit if e != "I"]
    return sum({"K": 0, "R": 2, "D": 3, "I": 2}[e] for e in audit) + sum(e != "D" and f == "truncated" for e, f in zip(left, found))


def all_ways(rows, found):
    best = None
    for edits in itertools.product(*map(choices, found)):
        for inserts in itertools.product(range(3), repeat=len(rows) + 1):
            audit = "".join("I" * n + e for n, e in itertools.zip_longest(inserts, edits, fillvalue=""))
            if FORM.fullmatch("".join(r[:1] or "-" for r, _ in applied(rows, audit))):
                best = min(best or (99, ""), (price(rows, found, audit), audit))
    return best


def search(rows, found):
    """Plain dynamic programme over strings; a state is the form's last initial."""
    def inserts(at):
        for _ in range(2):
            for p, (c, a) in list(at.items()):
                q = "a" if p == "u" else "u"
                at[q] = min(at.get(q, (10**9, "")), (c + 2, a + "I"))
        return at
    at = inserts({"": (0, "")})
    for (_, _, role, _), fault in zip(rows, found):
        after = {}
        for p, (c, a) in at.items():
            add = fault == "truncated"
            need = "a" if p == "u" else "u"
            ways = [(p, 3, "D")]
            if choices(fault) != "D":
                ways += [(need, 2 + add, "R")] + [(role[:1], add, "K")] * (role[:1] == need or (role[:1] == "s" and p == ""))
            for q, w, e in ways:
                after[q] = min(after.get(q, (10**9, "")), (c + w, a + e))
        at = inserts(after)
    return min(at[q] for q in ("", "a") if q in at)


def plain(rows, edits=search):
    """Result rows from (conv_id, turn, role, text); rows of one turn by role and digest."""
    out = []
    digest = lambda x: hashlib.sha256(f"{len(x[2])}:{x[2]}{x[3]}".encode()).digest()
    for conv in {x[0] for x in rows}:
        here = sorted(damage([x for x in rows if x[0] == conv]), key=lambda x: (x[1] is not None, x[1] or 0, x[2].encode(), digest(x)))
        found = faults(here)
        turns = {x[1] for x in here} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(here))
        cost, audit = edits(here, found)
        left = applied(here, audit)
        assert FORM.fullmatch("".join(r[:1] or "-" for r, _ in left))
        text = "\n".join(f"{r}:{t}" for r, t in left)
        out.append((conv, gaps, *[found.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, parts=4):
    table = spark.createDataFrame([(*x, "x", 1) for x in rows], SCHEMA).repartition(parts)
    return sorted(map(tuple, repair.repaired(repair.damaged(table)).collect()), key=str)


def made(r, conversations, most):
    texts = ["Yes.", "No!", "why", "", " \n", "a. b", "Good? "]
    rows = []
    for c in range(conversations):
        for t in sorted(r.sample(range(most * 2), r.randrange(most + 1))):
            rows.append((c, t, r.choices(["system", "user", "assistant", "tool", "u", "", "D"], [1, 5, 5, 1, 1, 1, 1])[0], r.choice([*texts, f"{c} {t}."])))
    return rows


def test_all_ways_of_small_conversations(spark):
    rows = [x for x in made(random.Random(1), 120, 3)]
    assert run(spark, rows) == plain(rows, all_ways)


def test_many_conversations(spark):
    rows = made(random.Random(2), 400, 30)
    assert run(spark, rows) == plain(rows)


def test_one_conversation_over_many_parts(spark):
    r = random.Random(3)
    rows = [(7, t, r.choice(["user", "assistant"]), r.choice(["Yes.", "no", f"{t}!", f"{t}"])) for t in range(3000)] + made(r, 5, 4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        assert run(spark, rows) == plain(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_nulls_odd_texts_repeated_rows_and_ties(spark):
    r = random.Random(4)
    rows = [(i % 4, i, "user", t) for i, t in enumerate(ODD)] + [(None, t, r.choice([None, "user", "assistant"]), r.choice([None, "a.", "b"])) for t in [None, None, 1, 2, 2, 5]]
    rows += [(9, None, "user", "x."), (9, None, "assistant", "y.")] + [(10, 1, "user", "same.")] * 7 + [(11, 3, a, b) for a in ("assistant", "user") for b in ("p.", "q", "r.")]
    rows += [(12, 5, "user", "a."), (12, None, "user", "a."), (13, 2**62, "user", "Yes."), (13, -(2**62) + 1, "assistant", "No."), (14, 0, "user", "long. " * 200_000 + "x")]
    want = plain(rows)
    assert run(spark, rows) == want and run(spark, rows[::-1], 1) == want


def test_conversations_without_rows_left_and_empty_tables(spark):
    gone = [(c, 0, "user", "a.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    assert gone and run(spark, gone) == sorted([(c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c, *_ in gone], key=str)
    assert run(spark, []) == []


def test_given_conversations(spark, sf):
    table = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text")
    got = sorted(map(tuple, repair.repaired(repair.damaged(table)).collect()), key=str)
    assert got == plain([tuple(x) for x in table.collect()])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 8), max_size=40), min_size=1, max_size=6))
def test_grammar_keeps_sequences_and_their_matrices(sequences):
    g = repair.Grammar()
    short = g.compress(sequences)
    parts = {n: pair for pair, n in g.rules.items()}
    flat = lambda x: [z for y in parts[x] for z in flat(y)] if x in parts else [x]
    assert [[y for x in s for y in flat(x)] for s in short] == sequences
    stay = list(itertools.chain.from_iterable(itertools.pairwise(s) for s in short))
    distinct = {p for p in stay if p[0] != p[1]}
    assert all(stay.count(p) == 1 for p in distinct)
    for s, t in zip(sequences, short):
        show = lambda rows: [[e and (e[0], str(e[1])) for e in line] for line in rows]
        assert show(g.over(s, repair.IDENTITY)) == show(g.over(t, repair.IDENTITY))


@pytest.mark.parametrize("seed", range(3))
def test_ropes_compare_like_strings(seed):
    r = random.Random(seed)
    ropes = [repair.Rope("".join(r.choices("DIK", k=r.randrange(4)))) for _ in range(10)]
    for _ in range(150):
        ropes.append(r.choice(ropes[-12:]) + r.choice(ropes[-12:]) if ropes[-1].size < 5000 else repair.Rope("K"))
    for _ in range(3000):
        a, b = r.choice(ropes), r.choice(ropes)
        assert (a < b) == (str(a) < str(b))
