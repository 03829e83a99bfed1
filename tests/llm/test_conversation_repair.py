"""Conversation repair against exhaustive search and plain recomputation."""

import functools
import hashlib
import itertools
import random
import re
import zlib

import pytest

from cellweave.llm import conversations as C
from cellweave.llm import queries
from cellweave.llm.common import table

LEGAL = re.compile(r"(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"


def exhaustive(signature):
    """All scripts with at most two inserts in each gap."""
    best = None
    gaps = [g for k in range(3) for g in itertools.product("ua", repeat=k)]
    edits = [[("D", "", 4)] + ([] if x in "-=" else [("K", x.lower(), 3 * x.isupper()), ("R", "u", 3 + 3 * x.isupper()), ("R", "a", 3 + 3 * x.isupper())]) for x in signature]
    for rows in itertools.product(*edits):
        for inserts in itertools.product(gaps, repeat=len(signature) + 1):
            roles = "".join("".join(g) + r[1] for g, r in zip(inserts, [*rows, ("", "", 0)], strict=True))
            if LEGAL.fullmatch(roles):
                audit = "".join("I" * len(g) + r[0] for g, r in zip(inserts, [*rows, ("", "", 0)], strict=True))
                found = (sum(r[2] for r in rows) + 3 * sum(map(len, inserts)), audit)
                best = found if best is None else min(best, found)
    return best


def backwards(signature):
    """The same from the end, with whole audits."""
    role_of = {0: "u", 1: "u", 2: "a", 3: "u"}
    after = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}

    @functools.cache
    def best(i, state, inserts):
        found = []
        if i == len(signature):
            if state in (0, 3):
                found.append((0, ""))
        else:
            x = signature[i]
            cost, audit = best(i + 1, state, 0)
            found.append((cost + 4, "D" + audit))
            if x not in "-=":
                for edit, role, price in (("K", x.lower(), 0), ("R", role_of[state], 3)):
                    if (state, role) in after:
                        cost, audit = best(i + 1, after[state, role], 0)
                        found.append((cost + price + 3 * x.isupper(), edit + audit))
        if inserts < 3:
            cost, audit = best(i, after[state, role_of[state]], inserts + 1)
            found.append((cost + 3, "I" + audit))
        return min(found, default=(10**9, ""))

    for i in range(len(signature), 0, -100):  # keeps the recursion shallow
        for state in range(4):
            best(i, state, 0)
    return best(0, 0, 0)


def solve(signatures):
    trie = C.Trie()
    return {s: trie.solve(s) for s in sorted(set(signatures))}


def test_all_short_signatures_by_exhaustive_search():
    some = ["".join(x) for n in range(3) for x in itertools.product("suaxSUAX-=", repeat=n)] + ["asu", "uAx", "s-a", "aau", "Uss", "xxx", "UUU", "aaa"]
    for s, found in solve(some).items():
        assert found == exhaustive(s), s


def test_random_signatures_from_the_end():
    rng = random.Random(3)
    some = ["".join(rng.choices("suaxSUAX-=", [2, 9, 9, 1, 1, 3, 3, 1, 2, 2], k=rng.randrange(1, 60))) for _ in range(1500)]
    for s, found in solve(some).items():
        assert found == backwards(s), s


def plain(rows):
    """Expected report of undamaged rows (conv_id, turn, role, text) of one conversation in order."""
    seen, letters, initials = set(), "", []
    for _, turn, role, text in rows:
        body = text.rstrip(SPACE)
        own = role[:1] if role[:1] in ("s", "u", "a") else "x"
        letters += "-" if not body else "=" if (role, text) in seen else own if body[-1] in ".!?" else own.upper()
        seen.add((role, text))
        initials.append(role[:1])
    turns = [r[1] for r in rows if r[1] is not None]
    cost, audit = backwards(letters)
    lines, at, state = [], 0, ""
    for edit in audit:
        turn = "assistant" if state == "u" else "user"
        if edit == "I":
            lines.append(f"{turn}:")
            state = turn[0]
            continue
        _, _, role, text = rows[at]
        at += 1
        if edit != "D":
            lines.append(f"{role if edit == 'K' else turn}:{text}")
            state = role[0] if edit == "K" else turn[0]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, letters.count("-"), letters.count("="), sum(map(str.isupper, letters)),
        sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [] if kind == 0 else [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def expected(rows):
    convs = {}
    for r in rows:
        convs.setdefault(r[0], [])
    for r in damage(rows):
        convs[r[0]].append(r)
    out = []
    for conv, some in convs.items():
        some.sort(key=lambda r: (r[1] is not None, r[1] or 0))
        out.append((conv, *plain(some)))
    return sorted(out, key=str)


NAMES = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
SCHEMA = "conv_id long, turn long, role string, text string, letter string, place int, gone boolean, head int"


def got(spark, rows):
    df = spark.createDataFrame([(*r, "z", 1, False, 2) for r in rows], SCHEMA).repartition(3)
    return sorted([tuple(r[c] for c in NAMES) for r in C.repair(C.damaged(df)).collect()], key=str)


def test_odd_rows(spark):
    rng = random.Random(8)
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(rng.randrange(1, 12)):
            if rng.random() < 0.9:
                rows.append((conv, turn * rng.choice([1, 1, 3]) if turn else rng.choice([0, None, -4]), rng.choice(["user", "assistant", "system", None, "", "User", "abbot", "tool"]), rng.choice(["Yes.", "yes", "No!", "", " \t", None, "é?", "Wait… \n", "\x85", "Hm.\x85"])))
    rows = list({(r[0], r[1]): r for r in rows}.values())  # one row a turn, else their order is a matter of choice
    assert got(spark, rows) == expected(rows)


def test_repeated_rows_stand_next_to_each_other(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Ho.")] * 3 + [(2, None, "user", "a.")] * 2
    found = {r[0]: r for r in got(spark, rows)}
    assert all(found[c][3] >= 1 for c in (1, 2))
    assert found[1][8] == hashlib.sha256(b"user:Hi.\nassistant:Ho.").hexdigest()


def test_a_long_conversation_and_empty_tables(spark):
    rng = random.Random(5)
    rows = [(7, k, rng.choice(["user", "assistant"]), f"Line {rng.randrange(1000)}{rng.choice(['.', ''])}") for k in range(3000)] + [(8, 0, "user", "x" * 100000 + "."), (9, 1, "assistant", "y.")]
    assert got(spark, rows) == expected(rows)
    assert C.repair(C.damaged(spark.createDataFrame([], SCHEMA))).collect() == []


@pytest.mark.parametrize("case", ["lost", "whole"])
def test_lost_conversations_and_whole_turns(spark, case):
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    if case == "lost":
        assert got(spark, [(gone, 0, "user", "x.")]) == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    else:
        from pyspark.sql import functions as F

        df = spark.createDataFrame([(1, 5, "assistant", "So."), (1, 9, "assistant", "And."), (2, 0, "user", "")], "conv_id long, turn long, role string, text string").withColumn("gone", F.lit(False))
        turns = C.repair(df, whole=True).orderBy("conv_id", "position").collect()
        assert [tuple(r) for r in turns] == [(1, 0, "user", "So."), (1, 1, "assistant", "And.")]


def test_query_on_conversations(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in table(spark, sf, "conversations", "conv_id", "turn", "role", "text").collect()]
    found = sorted([tuple(r[c] for c in NAMES) for r in queries.op13_conversation_repair(spark, sf).collect()], key=str)
    assert found == expected(rows)
