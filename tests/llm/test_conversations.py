"""Operator 11: the cheapest repair of every conversation, by trying all of them."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from packhorse.llm import conversations as op

FOLDER = "/root/testdata/sf0.01"
WHITE = " \t\n\x0b\x0c\r"
GIVES = re.compile("(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def damage(rows):
    """(conv_id, turn, role, text) after the contract's damage, by a loop."""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        name = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(name.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        bare = text.rstrip(WHITE)
        kind = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append(kind)
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))


def cheapest(rows, kinds):
    """The least (cost, audit) of all repairs, from the last row to the first, with whole strings."""
    after = {"": (0, ""), "s": None, "u": None, "a": (0, "")}
    follows = {"": "u", "s": "u", "u": "a", "a": "u"}

    def with_inserts(best):
        for _ in range(4):
            for state, to in follows.items():
                if best[to] is not None:
                    new = (best[to][0] + 3, "I" + best[to][1])
                    best[state] = new if best[state] is None else min(best[state], new)
        return best

    after = with_inserts(after)
    for (_, _, role, _), kind in reversed(list(zip(rows, kinds, strict=True))):
        now = {}
        for state in follows:
            found = [(after[state][0] + 4, "D" + after[state][1])]
            if kind not in ("blank", "duplicate"):
                extra, to = 3 * (kind == "truncated"), follows[state]
                found.append((after[to][0] + 3 + extra, "R" + after[to][1]))
                first = role[:1]
                if first and (first == to or (first == "s" and state == "")):
                    found.append((after[first][0] + extra, "K" + after[first][1]))
            now[state] = min(found)
        after = with_inserts(now)
    return after[""]


def tried(rows, kinds):
    """As `cheapest`, by trying every edit of every row with up to two rows inserted anywhere."""
    best = None
    options = ["I" * k + edit for k in range(3) for edit in "DKR"]
    for edits in itertools.product(options, repeat=len(rows)):
        for end in ("", "I", "II"):
            audit, states, cost = "".join(edits) + end, [""], 0
            for (_, _, role, _), kind, part in zip(rows, kinds, edits, strict=True):
                for edit in part:
                    if edit == "D":
                        cost += 4
                        continue
                    expected = "a" if states[-1] == "u" else "u"
                    cost += 0 if edit == "K" else 3
                    if edit != "I":
                        cost += 3 * (kind == "truncated")
                        if kind in ("blank", "duplicate"):
                            cost += 1000
                    states.append(role[:1] or "-" if edit == "K" else expected)
            for _ in end:
                cost += 3
                states.append("a" if states[-1] == "u" else "u")
            if cost < 1000 and GIVES.fullmatch("".join(states)):
                best = min(best or (cost, audit), (cost, audit))
    return best


def texts_after(rows, audit):
    out, state, left = [], "", iter(rows)
    for edit in audit:
        if edit == "I":
            state = "a" if state == "u" else "u"
            out.append({"u": "user", "a": "assistant"}[state] + ":")
            continue
        _, _, role, text = next(left)
        if edit == "R":
            role = "assistant" if state == "u" else "user"
        if edit != "D":
            state = role[0]
            out.append(f"{role}:{text}")
    return out


def expected(rows):
    by = defaultdict(list)
    for row in rows:
        by[row[0]] += damage([row])
    out = []
    for conv, found in by.items():
        found = in_order(found)
        kinds = faults(found)
        cost, audit = cheapest(found, kinds)
        turns = [r[1] for r in found if r[1] is not None]
        pairs = ["".join(r[2][:1] for r in pair) for pair in itertools.pairwise(found)]
        text = "\n".join(texts_after(found, audit))
        out.append((
            conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *[kinds.count(k) for k in ("blank", "duplicate", "truncated")],
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(text.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def audited(df):
    return sorted((tuple(r) for r in op.audits(op.damaged(df), lost="lost").collect()), key=str)


def random_rows(seed, conversations, roles, texts, turns=9):
    pick = random.Random(seed)
    return [
        (conv, pick.choice([None, *range(turns)]), pick.choice(roles), pick.choice(texts))
        for conv in range(conversations) for _ in range(pick.randrange(1, turns))
    ]


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = op.op11_conversations(spark, FOLDER)
    assert found.columns == [
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    ]
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected(rows)


def test_cheapest_is_the_least_of_all():
    """The loop that the other tests rely on, against every sequence of edits."""
    pick = random.Random(5)
    for _ in range(25):
        rows = [(1, i, pick.choice(["user", "assistant", "system", "tool"]), pick.choice(["a.", "b", "", f"{i}!"])) for i in range(3)]
        assert cheapest(rows, faults(rows)) == tried(rows, faults(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_odd_roles_and_ties(spark, seed):
    roles = ["user", "assistant", "system", "", None, "User", "tool", "ü", "system prompt"]
    texts = ["Yes.", "No", "", " \t", None, "Why? \n", "x" * 5000 + "!", "日本。", "Yes."]
    rows = random_rows(seed, 120, roles, texts)
    rows += [(None, 1, "user", "hello."), (None, 1, "user", "hello."), (7, None, None, None), *rows[:5]]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert audited(df) == expected(rows)


def test_state_is_carried_over_batches(spark):
    """One conversation of half the rows, in batches of seven."""
    rows = [(5, i, "user" if i % 3 else "assistant", f"text {i % 900}" + "." * (i % 4 > 0)) for i in range(3000)]
    rows += random_rows(3, 400, ["user", "assistant"], ["Yes.", "No", ""])
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "7")
    try:
        assert audited(spark.createDataFrame(rows, SCHEMA).repartition(5)) == expected(rows)
    finally:
        spark.conf.set(setting, before)


def test_rows_of_the_repair(spark):
    """The operator's own rows spell out what the audit tells."""
    rows = random_rows(4, 60, ["user", "assistant", "system", None], ["Yes.", "No", "", None])
    df = op.damaged(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS name", "2 AS place", "3 AS fault"))
    told = {r.conv_id: r for r in op.audits(df, lost="lost").collect()}
    found = defaultdict(list)
    for row in op.repair(df, lost="lost").collect():
        found[row.conv_id].append(row)
    for conv, report in told.items():
        edits = sorted(found[conv], key=lambda r: r.place)
        assert "".join(r.edit for r in edits) == report.audit
        text = "\n".join(f"{r.role}:{r.text}" for r in edits if r.edit != "D")
        assert hashlib.sha256(text.encode()).hexdigest() == report.repaired_sha256
        assert GIVES.fullmatch("".join(r.role[0] for r in edits if r.edit != "D"))
        assert sum(r.fault == "truncated" for r in edits) == report.truncated


def test_lost_and_empty(spark):
    df = spark.createDataFrame([(1, 0, "user", "a.")], SCHEMA).selectExpr("*", "true AS lost")
    nothing = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in op.audits(df, lost="lost").collect()] == [(1, 0, 0, 0, 0, 0, 0, "", nothing)]
    assert op.repair(df, lost="lost").collect() == []
    assert op.audits(df.limit(0)).collect() == [] == op.repair(df.limit(0)).collect()
