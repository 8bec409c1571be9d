"""Conversation repair against a plain search over whole conversations."""

import hashlib
import random
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from daymark.llm import conversation_repair
from daymark.llm.conversation_repair import damaged, repair_conversations, summaries
from daymark.llm.queries import CONVERSATIONS, QUERIES

SPACE = " \t\n\x0b\x0c\r"


def spoil(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        yield from [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)


def repair(rows):
    """The answer for one conversation's rows, any order."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
    seen, faults = set(), []
    for _, _, role, text in rows:
        said = text.strip(SPACE)
        faults.append(
            "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else ""
        )
        seen.add((role, text))
    accepts = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    @lru_cache(maxsize=None)
    def best(i, state, inserted):
        found = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        if inserted < 2:
            for role in ("user", "assistant"):
                if role[0] in accepts[state]:
                    cost, audit, lines = best(i, role[0], inserted + 1)
                    found.append((cost + 2, "I" + audit, (role + ":", *lines)))
        if i < len(rows):
            cost, audit, lines = best(i + 1, state, 0)
            found.append((cost + 3, "D" + audit, lines))
            if faults[i] not in ("blank", "duplicate"):
                more = faults[i] == "truncated"
                for role, price, edit in ((rows[i][2], 0, "K"), ("user", 2, "R"), ("assistant", 2, "R")):
                    if role[:1] in accepts[state]:
                        cost, audit, lines = best(i + 1, role[:1], 0)
                        found.append((cost + price + more, edit + audit, (f"{role}:{rows[i][3]}", *lines)))
        return min(found) if found else (float("inf"), "", ())

    for i in range(len(rows), -1, -1):  # keeps the recursion shallow
        for state in accepts:
            best(i, state, 0)
    cost, audit, lines = best(0, "", 0)
    turns = [r[1] for r in rows if r[1] is not None]
    initials = [r[2][:1] for r in rows]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
        faults.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def wanted(rows):
    conversations = {r[0]: [] for r in rows}
    for row in spoil(rows):
        conversations[row[0]].append(row)
    return {conv: repair(its) for conv, its in conversations.items()}


def found(df):
    rows = df.collect()
    out = {
        r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows
    }
    assert len(out) == len(rows)
    return out


def made(seed, sizes, roles=("system", "user", "assistant", "tool", "", None), words=("Yes.", "so", " ", "", None, "Why?\n", "x")):
    draw = random.Random(seed)
    rows = []
    for conv, n in sizes.items():
        for i in range(n):
            turn = draw.choice([i, i, i, i + 1, None])
            text = draw.choice(words) if draw.random() < 0.4 else f"line {i}{draw.choice('.!x')}"
            rows.append((conv, turn, draw.choice(roles), text))
    draw.shuffle(rows)
    return rows


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(QUERIES["op11_conversation_repair"](spark, sf_dir)) == wanted(rows)


@pytest.mark.parametrize("stretch", [1, 3, 128])
def test_stretches_of_any_length_give_the_same(spark, stretch):
    rows = made(stretch, {1: 60, 2: 1, None: 25, 3: 7, 4: 40, 5: 2, 9: 300})
    df = spark.createDataFrame(rows, CONVERSATIONS).withColumns({"k": F.lit(1), "codes": F.lit("x"), "copies": F.lit(3)})
    assert found(summaries(repair_conversations(damaged(df), stretch))) == wanted(rows)


def test_vectors_that_never_meet_are_swept(spark):
    rows = [(1, i, "tool", f"note {i}.") for i in range(150)] + [(2, i, "system", f"note {i}") for i in range(150)]
    df = spark.createDataFrame(rows, CONVERSATIONS)
    assert found(summaries(repair_conversations(damaged(df), 4))) == wanted(rows)


def test_one_conversation_and_one_row_may_hold_most(spark):
    rows = made(7, {1: 900, 2: 5, 3: 5}) + [(1, 5, "user", "again.")] * 500
    df = spark.createDataFrame(rows, CONVERSATIONS)
    assert found(summaries(repair_conversations(damaged(df), 16))) == wanted(rows)


def test_empty_dropped_and_long(spark):
    empty = spark.createDataFrame([], CONVERSATIONS)
    assert summaries(repair_conversations(damaged(empty))).collect() == []
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "Gone."), (-5, 1, "user", "word " * 400_000 + "end."), (-5, 2, "assistant", "b" * 1_500_000)]
    got = found(summaries(repair_conversations(damaged(spark.createDataFrame(rows, CONVERSATIONS)))))
    assert got == wanted(rows)
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_costs_differ_by_constants_only():
    """Vectors are a handful, whatever the rows, and runs from two of them mostly meet."""
    draw = random.Random(1)
    vectors = {conversation_repair._AT_END, conversation_repair._UNKNOWN}
    while True:
        more = vectors | {conversation_repair._before(code, v) for code in range(8) for v in vectors}
        if more == vectors:
            break
        vectors = more
    assert len(vectors) < 60 and max(map(max, vectors)) < 256
    codes = bytes(draw.choice([1, 2, 2, 1, 0, 5, 6]) for _ in range(50))
    assert len({conversation_repair._back(codes, v) for v in vectors}) == 1
