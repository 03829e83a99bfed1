"""Repair of conversations: the cheapest edits that give a legal order of roles, for all conversations at once.

What an edit costs depends on a row's role and fault alone, so a conversation is one signature: a letter a row. Equal
signatures are solved once. Sorted ones that follow each other share prefixes: each task holds the path of a trie, one
layer of the dynamic programme a letter, drops what the next signature does not share and adds what is new. At a terminal
node the answer is read off backwards.

A layer has four states: nothing yet, a system turn, a user turn, an assistant turn. Each holds the least cost of what
leads there up to this row's own edit, how these ways rank as text, and the last step. Ways of one layer have the same
number of rows' edits and end with one, and an audit fixes all roles, so none is the beginning of another: ranks decide
between ways of different states, and letters between ways of the same one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, shuffle_width

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3  # costs
#: States by what stands last, and where a role leads from each.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {"s": {EMPTY: SYSTEM}, "u": {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
AFTER_INSERT = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ENDS = (EMPTY, ASSISTANT)
MOST_INSERTS = 2  # a third one would come back to where the first led
BLANK, DUPLICATE = "-", "="  # letters of rows that must go; others are s, u, a, x, in capitals where truncated
Layer = tuple[tuple[int, int, int, str] | None, ...]  # by state: cost, rank, state before, letters of the step


def steps_of(letter: str | None, state: int, cost: int) -> Iterator[tuple[int, int, str]]:
    """Where a row with the letter leads from a state, at what cost and with what letters; without a row, inserts alone."""
    for k in range(MOST_INSERTS + 1):
        head, at = "I" * k, cost + INSERT * k
        if letter is None:
            yield state, at, head
        else:
            yield state, at + DELETE, head + "D"
            if letter not in (BLANK, DUPLICATE):
                extra = TRUNCATED if letter.isupper() else 0
                to = NEXT.get(letter.lower(), {}).get(state)
                if to is not None:
                    yield to, at + KEEP + extra, head + "K"
                yield AFTER_INSERT[state], at + REROLE + extra, head + "R"  # to the one role that may follow
        state = AFTER_INSERT[state]


def next_layer(layer: Layer, letter: str | None) -> Layer:
    best: list = [None] * 4
    for state, way in enumerate(layer):
        if way:
            for to, cost, letters in steps_of(letter, state, way[0]):
                found = (cost, way[1], letters, state)
                if best[to] is None or found < best[to]:
                    best[to] = found
    order = sorted((x[1], x[2]) for x in best if x)
    return tuple(x and (x[0], order.index((x[1], x[2])), x[3], x[2]) for x in best)


class Trie:
    """The path from the root to the last signature, a layer a node."""

    def __init__(self):
        self.signature, self.layers = "", [((0, 0, 0, ""), None, None, None)]

    def solve(self, signature: str) -> tuple[int, str]:
        """Least cost and audit. Signatures come in order, so what the trie drops does not come again."""
        shared, most = 0, min(len(self.signature), len(signature))
        while shared < most and self.signature[shared] == signature[shared]:
            shared += 1
        del self.layers[shared + 1 :]
        for letter in signature[shared:]:
            self.layers.append(next_layer(self.layers[-1], letter))
        self.signature = signature
        end = next_layer(self.layers[-1], None)
        cost, _, state = min((end[s][0], end[s][1], s) for s in ENDS if end[s])
        out = []
        for layer in [end, *reversed(self.layers[1:])]:
            _, _, state, letters = layer[state]
            out.append(letters)
        return cost, "".join(reversed(out))


def solve_all(signatures: DataFrame) -> DataFrame:
    """cost and audit of each distinct signature (column signature)."""
    ordered = signatures.select("signature").distinct().repartitionByRange(shuffle_width(signatures.sparkSession), "signature").sortWithinPartitions("signature")

    def run(batches):
        trie = Trie()
        for batch in batches:
            costs, audits = zip(*map(trie.solve, batch["signature"].to_pylist()), strict=True) if batch.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays([batch["signature"], pa.array(costs, pa.int64()), pa.array(audits, pa.string())], ["signature", "cost", "audit"])

    return ordered.mapInArrow(run, "signature string, cost long, audit string")


def damaged(df: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) after planted faults, chosen by a checksum of conv_id:turn; gone marks rows that
    are dropped. Nulls of role and text are one space, and so are those of conv_id and turn in the checksum."""
    kind = F.crc32(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" "))).cast("binary")) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    changed = df.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"), (kind == 0).alias("gone"), (kind == 3).alias("twice"),
    )
    return changed.withColumn("copy", F.explode(F.expr("if(twice, array(0, 1), array(0))"))).drop("twice", "copy")


def fault_letter(role: Column, text: Column, seen: Column) -> Column:
    """The letter of a row in its conversation's signature, by its first fault and its role's initial."""
    words = F.rtrim(F.translate(text, "\t\n\x0b\x0c\r", "     "))  # spaces of six kinds
    initial = F.substring(role, 1, 1)
    own = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    return F.when(words == "", BLANK).when(seen, DUPLICATE).when(~F.substring(words, -1, 1).isin(".", "!", "?"), F.upper(own)).otherwise(own)


ORDER = ["turn", "role", "mark", "place"]


def marked(rows: DataFrame) -> DataFrame:
    """rows (conv_id, turn, role, text, gone) with initial, letter, and the columns of ORDER. A row is a duplicate if role
    and text came earlier in its conversation; rows of one turn stand in order of role and text checksum. Windows are
    dealt by conversation, role and text, so a long conversation is spread over tasks."""
    wide = rows.withColumn("mark", F.xxhash64("text"))
    same = Window.partitionBy("conv_id", "gone", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    wide = wide.withColumn("place", F.row_number().over(same))
    initial = F.substring("role", 1, 1)
    return wide.withColumn("letter", fault_letter(F.col("role"), F.col("text"), F.col("place") > 1)).withColumn("initial", F.when(initial.isin("s", "u", "a"), initial).otherwise("x"))


def by_conversation(rows: DataFrame, *order: str) -> DataFrame:
    """Rows of a conversation together in one task, in order, nulls first."""
    return rows.repartition(shuffle_width(rows.sparkSession), "conv_id").sortWithinPartitions("conv_id", *order)


def signatures(rows: DataFrame) -> DataFrame:
    """conv_id, signature, gaps, blank, duplicate, truncated, illegal of marked rows. A task streams its conversations and
    holds one letter a row of the one at hand."""

    def run(batches):
        now, started = None, False
        letters, turns, initial, illegal, out = [], [], None, 0, []

        def end():
            if started:
                s = "".join(letters)
                blank, twice = s.count(BLANK), s.count(DUPLICATE)
                gaps = turns[1] - turns[0] + 1 - turns[2] if turns else 0
                out.append((now, s, gaps, blank, twice, sum(map(str.isupper, s)), illegal))

        def batch_of():
            columns = zip(*out, strict=True) if out else [()] * 7
            types = [pa.int64(), pa.string(), *[pa.int64()] * 5]
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["conv_id", "signature", "gaps", "blank", "duplicate", "truncated", "illegal"])
            out.clear()
            return made

        for batch in batches:
            for conv, turn, gone, letter, first in zip(*[batch[c].to_pylist() for c in ("conv_id", "turn", "gone", "letter", "initial")], strict=True):
                if not started or conv != now:
                    end()
                    now, started, letters, turns, initial, illegal = conv, True, [], [], None, 0
                if gone:
                    continue
                letters.append(letter)
                if initial is not None and initial + first not in ("su", "ua", "au"):
                    illegal += 1
                initial = first
                if turn is not None:
                    if not turns:
                        turns = [turn, turn, 1]
                    elif turn != turns[1]:
                        turns = [turns[0], turn, turns[2] + 1]
                if len(letters) > 4096:
                    letters = ["".join(letters)] if len(letters) > 1 else letters
            yield batch_of()
        end()
        yield batch_of()

    narrow = by_conversation(rows.select("conv_id", "gone", "letter", "initial", *ORDER), *ORDER)
    return narrow.select("conv_id", "turn", "gone", "letter", "initial").mapInArrow(run, "conv_id long, signature string, gaps long, blank long, duplicate long, truncated long, illegal long")


REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
TURNS = "conv_id long, position long, role string, text string"


def heads_and_rows(rows: DataFrame, answers: DataFrame) -> DataFrame:
    """Each conversation's answer and then its rows, in one task and in order."""
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    heads = answers.select("conv_id", F.lit(0).alias("part"), F.struct("audit", *numbers).alias("head"), *[F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("mark", "long"), ("place", "int"), ("text", "string"))])
    kind = heads.schema["head"].dataType
    body = rows.where("not gone").select("conv_id", F.lit(1).alias("part"), F.lit(None).cast(kind).alias("head"), *ORDER, "text")
    return by_conversation(heads.unionByName(body), "part", *ORDER).select("conv_id", "head", "role", "text")


class Editor:
    """Applies an audit to rows as they come: lines of the repaired conversation."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, EMPTY

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at, self.state = self.at + 1, AFTER_INSERT[self.state]
            yield ("user" if self.state == USER else "assistant"), ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = NEXT[role[0]][self.state]
            yield role, text
        elif edit == "R":
            self.state = AFTER_INSERT[self.state]
            yield ("user" if self.state == USER else "assistant"), text


def repaired_lines(both: DataFrame) -> DataFrame:
    """The turns of the repaired conversations: conv_id, position, role, text."""

    def run(batches):
        editor, conv, at = None, None, 0
        for batch in batches:
            out = []

            def put(lines):
                nonlocal at
                for role, text in lines:
                    out.append((conv, at, role, text))  # noqa: B023
                    at += 1

            for c, head, role, text in zip(*[batch[x].to_pylist() for x in ("conv_id", "head", "role", "text")], strict=True):
                if head is not None:
                    if editor:
                        put(editor.inserted())
                    editor, conv, at = Editor(head["audit"]), c, 0
                else:
                    put(editor.row(role, text))
            columns = zip(*out, strict=True) if out else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)], ["conv_id", "position", "role", "text"])
        if editor:
            lines = list(enumerate(editor.inserted(), at))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*[(conv, k, *line) for k, line in lines], strict=True) if lines else [()] * 4, (pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)], ["conv_id", "position", "role", "text"])

    return both.mapInArrow(run, TURNS)


def report(both: DataFrame) -> DataFrame:
    """One row a conversation: its faults, cost, audit and the checksum of its repaired text, which is hashed line by line
    as its rows come."""
    names = [x.split()[0] for x in REPORT.split(", ")]

    def run(batches):
        editor, conv, head, hashed, lines, out = None, None, None, None, 0, []

        def put(found):
            nonlocal lines
            for role, text in found:
                hashed.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                lines += 1

        def end():
            put(editor.inserted())
            out.append((conv, *[head[x] for x in names[1:-1]], hashed.hexdigest()))

        def batch_of():
            types = [*[pa.int64()] * 7, pa.string(), pa.string()]
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [()] * 9, types, strict=True)], names)
            out.clear()
            return made

        for batch in batches:
            for c, new, role, text in zip(*[batch[x].to_pylist() for x in ("conv_id", "head", "role", "text")], strict=True):
                if new is not None:
                    if editor:
                        end()
                    editor, conv, head, hashed, lines = Editor(new["audit"]), c, new, hashlib.sha256(), 0
                else:
                    put(editor.row(role, text))
            yield batch_of()
        if editor:
            end()
        yield batch_of()

    return both.mapInArrow(run, REPORT)


def repair(rows: DataFrame, whole: bool = False) -> DataFrame:
    """Of conversations' rows (conv_id, turn, role, text, and gone where a row stands for its conversation alone): one
    report a conversation, or with whole their repaired turns (conv_id, position, role, text).

    Rows without turn come first; those of one turn in order of role and text checksum, repeated rows next to each other.
    Null conversations are one; null roles and texts must have been filled. A conversation without rows left has zeros, an
    empty audit and the checksum of empty text. Extra columns are left out; an empty table gives no rows. A conversation's
    audit is one value, and its checksum runs through its text from first to last: so each is streamed by one task, which
    holds a letter a row. Everything else is spread, however long a conversation is.
    """
    marks = durable(marked(rows.select("conv_id", "turn", "role", "text", "gone")))
    found = durable(signatures(marks))
    answers = found.join(solve_all(found), "signature")
    both = heads_and_rows(marks, answers)
    return repaired_lines(both) if whole else report(both)
