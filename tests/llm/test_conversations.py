"""Conversation repair against a plain search, over damage, awkward rows and chunks of a few rows."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnguard.llm import conv_repair

SPACE = " \t\n\v\f\r"
FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def broken(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(conv, turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def follows(sofar, c):
    """The roles so far, shortened to what matters, if c may come next in s?(ua)+."""
    new = sofar + c
    return next((s for s in ("s", "u", "a") if s == c), None) if any(
        re.fullmatch(p, new) for p in ("s", "u", "su", "ua", "au")) else None


def plain(rows):
    """Every prefix keeps its cheapest audits by the roles it ends in, as whole strings."""
    seen, best = set(), {"": (0, "", ())}

    def put(into, state, value):
        if state is not None and (state not in into or value[:2] < into[state][:2]):
            into[state] = value

    def inserted(states):
        for _ in range(3):
            for s, (cost, audit, kept) in list(states.items()):
                for role in ("user", "assistant"):
                    put(states, follows(s, role[0]), (cost + 5, audit + "I", kept + ((role, ""),)))
        return states
    faults, best = [], inserted(best)
    for _, role, text in rows:
        body = text.strip(SPACE)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
        new = {}
        for s, (cost, audit, kept) in best.items():
            put(new, s, (cost + 2, audit + "D", kept))
            if faults[-1] in ("", "truncated"):
                more = cost + 5 * (faults[-1] != "")
                if role and role[0] in "sua":
                    put(new, follows(s, role[0]), (more, audit + "K", kept + ((role, text),)))
                for r in ("user", "assistant"):
                    put(new, follows(s, r[0]), (more + 1, audit + "R", kept + ((r, text),)))
        best = inserted(new)
    cost, audit, kept = min((best[s] for s in ("", "a") if s in best), key=lambda v: v[:2])
    assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in kept))
    turns = [t for t, _, _ in rows if t is not None]
    first = [r[:1] for _, r, _ in rows]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()), kept


def plainly(rows):
    groups = defaultdict(list)
    for conv, *rest in rows:
        groups[conv].append(tuple(rest))
    return {c: plain(sorted(g, key=lambda r: (r[0] is not None, r[0] or 0))) for c, g in groups.items()}


def test_repair_of_the_table(spark, sf):
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    rows = [tuple(r) for r in turns.collect()]
    want = plainly(broken(rows))
    out = {r["conv_id"]: tuple(r[f] for f in FIELDS) for r in conv_repair.report(turns).collect()}
    assert set(out) == {r[0] for r in rows}
    assert all(out[c] == want[c][0] for c in want) and sum(o[5] > 0 for o in out.values()) > 5


@pytest.fixture
def many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small tables span tasks, too
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_long_and_random_conversations(spark, many_tasks):
    rng = np.random.default_rng(3)
    texts = ["Fine.", "Well!", "cut off", "", " \n", "Yes?", *[f"Text {i}." for i in range(30)]]
    roles = ["user", "assistant", "system", "tool", "umpire", ""]
    rows = []
    for conv in range(60):
        n = 400 if conv == 7 else int(rng.integers(1, 14))  # one holds a third of all rows, over tasks and chunks
        rows += [(conv, i + int(rng.integers(0, 2)) * 1000, roles[rng.choice(6, p=[.35, .35, .1, .1, .05, .05])], texts[rng.integers(len(texts))]) for i in range(n)]
    rows = [r for i, r in enumerate(rows) if r[:2] not in {x[:2] for x in rows[:i]}]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    want = plainly(rows)
    made = conv_repair.Repair(conv_repair.as_rows(df), chunk_rows=5)
    assert len(made.rules) > 3 and made.chunks.where("conv = 7").select("part").distinct().count() > 1
    out = {r["conv"]: tuple(r[f] for f in FIELDS) for r in made.summary().collect()}
    assert out == {c: w[0] for c, w in want.items()}
    kept = defaultdict(list)
    for r in made.turns().orderBy("conv", "place").collect():
        kept[r["conv"]].append((r["role"], r["text"]))
    assert all(tuple(kept[c]) == w[1] for c, w in want.items())
    bare = conv_repair.Repair(conv_repair.as_rows(df), rules=0, chunk_rows=5)  # without a grammar
    assert {r["conv"]: r["audit"] for r in bare.summary().collect()} == {c: w[0][6] for c, w in want.items()}


def test_matrices_multiply_in_any_order():
    rng = np.random.default_rng(1)
    for _ in range(30):
        a, b, c = (conv_repair.letter_matrix(conv_repair.SYMBOLS[i]) for i in rng.integers(0, 16, 3))
        left, right = conv_repair.times(conv_repair.times(a, b), c), conv_repair.times(a, conv_repair.times(b, c))
        flat = lambda m: [x and (x[0], "".join(conv_repair.letters(x[1]))) for x in m]
        assert flat(left) == flat(right)


def test_awkward_conversations(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(None, None, None, None), (1, None, "user", "Hi."), (1, 0, "assistant", "Yes."), (1, 0, "assistant", "Yes."), (2, 5, "", "x."),
            (3, 1, "user", "word " * 200_000 + "."), (3, 9, "assistant", None)] + [(4, 2, "user", "Same.")] * 50
    df = spark.createDataFrame(rows, schema).select("*", *[F.lit(1).alias(c) for c in ("conv", "part", "chunk", "copies", "k", "hi", "wide", "cost")])
    out = {r["conv"]: r for r in conv_repair.Repair(conv_repair.as_rows(df.repartition(4))).summary().collect()}
    assert out[None]["blank"] == 1 and out[None]["audit"] == "D" and out[None]["gaps"] == 0
    assert out[1]["audit"] == "KKD" and out[1]["duplicate"] == 1 and out[1]["cost"] == 2
    assert out[2]["audit"] == "D" and out[3]["gaps"] == 7 and out[3]["blank"] == 1
    assert out[4]["duplicate"] == 49 and out[4]["audit"] == "D" * 50
    gone = next(t for t in range(1000) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    rows = [(9, gone, "user", "Hi."), (None, 1, "user", "Hi.")]
    out = {r["conv_id"]: tuple(r[f] for f in FIELDS) for r in conv_repair.report(spark.createDataFrame(rows, schema)).collect()}
    assert out[9] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) and None in out
    assert conv_repair.report(spark.createDataFrame([], schema)).count() == 0
