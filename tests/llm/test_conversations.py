"""Conversation repair against plain dynamic programming, and that against all edits."""

import hashlib
import itertools
import random
import re
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import conversation_repair
from tallyhouse.llm.queries import QUERIES, damaged, table

GAPS = " \t\n\x0b\x0c\r"


def faults(rows):
    """First fault of each row."""
    seen, found = set(), []
    for _, role, text in rows:
        bare = text.rstrip(GAPS)
        found.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return found


def plainly(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, hash) of rows (turn, role, text) in order."""
    faulty, after = faults(rows), {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    best_of = {}

    def solve(i, last, depth=0):
        if (i, last, depth) in best_of:
            return best_of[i, last, depth]
        options = list(plain_options(i, last))
        if depth < 3:
            new = after[last]
            cost, edits, kept = solve(i, new, depth + 1)
            options.append((cost + 3, "I" + edits, (f"{names[new]}:", *kept)))
        best_of[i, last, depth] = min(options, key=lambda o: o[:2], default=(10**9, "", ()))
        return best_of[i, last, depth]

    def plain_options(i, last):
        if i == len(rows):
            return [(0, "", ())] if last in ("", "a") else []
        _, role, text = rows[i]
        cost, edits, kept = solve(i + 1, last)
        options = [(cost + 4, "D" + edits, kept)]
        if faulty[i] not in ("blank", "duplicate"):
            more, new = 3 * (faulty[i] == "truncated"), after[last]
            cost, edits, kept = solve(i + 1, new)
            options.append((cost + more + 3, "R" + edits, (f"{names[new]}:{text}", *kept)))
            if role[:1] == new or (role[:1] == "s" and last == ""):
                cost, edits, kept = solve(i + 1, role[:1])
                options.append((cost + more, "K" + edits, (f"{role}:{text}", *kept)))
        return options

    for i in range(len(rows), -1, -1):  # shallow recursion for long conversations
        for last in ("", "s", "u", "a"):
            solve(i, last)
    cost, audit, kept = solve(0, "")
    turns = [turn for turn, _, _ in rows if turn is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    counts = [faulty.count(name) for name in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest())


def by_all_edits(rows):
    """Least (cost, edits) over all strings of edits."""
    faulty, found = faults(rows), []
    for size in range(len(rows) + 4):
        for edits in itertools.product("DIKR", repeat=size):
            if sum(e != "I" for e in edits) != len(rows):
                continue
            for roles in itertools.product("ua", repeat=sum(e in "IR" for e in edits)):
                given, initials, cost, i = iter(roles), "", 0, 0
                for edit in edits:
                    if edit == "I":
                        initials, cost = initials + next(given), cost + 3
                        continue
                    if edit == "D":
                        cost += 4
                    elif faulty[i] in ("blank", "duplicate"):
                        cost += 10**6
                    else:
                        cost += 3 * (faulty[i] == "truncated") + 3 * (edit == "R")
                        initials += next(given) if edit == "R" else rows[i][1][:1] or "?"
                    i += 1
                if re.fullmatch("(s?(ua)+)?", initials):
                    found.append((cost, "".join(edits)))
    return min(found)


def random_rows(rng, n):
    roles = ["system", "user", "user", "assistant", "assistant", "tool", "", "bot"]
    texts = ["a.", "b", "c!", " ", "", "d?\n", "e. f", "g.\t"]
    rows = [(rng.choice([None, *range(8)]), rng.choice(roles), rng.choice(texts) + rng.choice(["", "x.", "y"])) for _ in range(n)]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def test_plain_version_against_all_edits():
    rng = random.Random(1)
    for _ in range(40):
        rows = random_rows(rng, rng.randint(0, 3))
        assert plainly(rows)[5:7] == by_all_edits(rows)


def test_few_vectors():
    assert len(conversation_repair.tables().vectors) == 30


@pytest.mark.parametrize("length", [1, 2, 3, 4])
def test_tables_against_single_steps(length):
    rng = random.Random(length)
    book, one = conversation_repair.Tables(length), conversation_repair.Tables(1)
    for _ in range(200):
        symbols = bytes(rng.randrange(8) for _ in range(rng.randint(0, 23)))
        exit, state = rng.randrange(30), rng.randrange(4)
        before, cost, steps = book.summary(symbols)
        assert book.vectors_after(symbols, exit)[1:] == (before[exit], cost[exit])
        assert one.vectors_after(symbols, exit)[1:] == (before[exit], cost[exit])
        edits, after = book.trace(symbols, exit, state)
        assert (edits, after) == one.trace(symbols, exit, state) and after == steps[exit, state]


def collected(found):
    return {row[0]: tuple(row)[1:] for row in found.collect()}


@pytest.mark.parametrize("rows_each", [1, 3, 4096])
def test_against_plain_version(spark, frame, rows_each):
    rng = random.Random(rows_each)
    talks = {i: random_rows(rng, rng.randint(1, 9)) for i in range(150)}
    talks[None] = random_rows(rng, 6)
    talks[500] = sorted(
        [(i % 900, rng.choice(["user", "assistant"]), f"t{rng.randrange(700)}" + rng.choice(".,")) for i in range(2500)],
        key=lambda r: (r[0], r[1], r[2]),
    )  # cut over ranges
    talks[501] = [(None, "user", "again.")] * 300 + [(3, "assistant", "ok.")] * 200
    table = frame(
        [(conv, *row, "x") for conv, rows in talks.items() for row in rows], "conv_id long, turn long, role string, text string, conv string"
    )
    found = conversation_repair.repair(table.repartition(5), rows_each=rows_each, chars_each=200)
    assert collected(found) == {conv: plainly(rows) for conv, rows in talks.items()}


def test_odd_rows(frame):
    rows = [(1, 0, "user", "gone."), (2, None, None, None), (2, 5, "user", "a\x00b."), (3, 1, "", "x."), (None, 2, "user", "y."),
            (4, 9, "user", "x" * 300_000 + "."), (4, 9, "user", "x" * 300_000 + "."), (4, 2**62, "assistant", "é 　")]
    table = frame(rows, "conv_id long, turn long, role string, text string")
    found = collected(conversation_repair.repair(table, times=F.when(F.col("conv_id") == 1, 0).otherwise(1)))
    nothing = hashlib.sha256(b"").hexdigest()
    assert found[1] == (0, 0, 0, 0, 0, 0, "", nothing)
    assert found[2][:7] == (0, 1, 0, 0, 1, 7, "DKI")
    assert found[3][6] == "D" and found[None][6] == "KI"
    assert found[4][:7] == (2**62 - 9 + 1 - 2, 0, 1, 1, 1, 7, "KDK")


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    given = table(spark, folder, "conversations")
    talks = {row[0]: [] for row in given.select("conv_id").distinct().collect()}
    for row in damaged(given).collect():
        talks[row["conv_id"]] += [(row["turn"], row["role"], row["text"])] * row["times"]
    expected = {conv: plainly(sorted(rows, key=lambda r: (r[0], r[1], r[2].encode()))) for conv, rows in talks.items()}
    assert collected(QUERIES["op11_conversation_repair"](spark, folder)) == expected
