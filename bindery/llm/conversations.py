"""Repair of the structure of conversations by a dynamic program over turns and grammar.

The initials of the roles must read `(s?(ua)+)?`. Edits keep, rerole or delete a row,
or insert one with an empty text. The cost to go from each place and state of the
grammar is found backwards; a walk forwards then takes, of the edits that lie on a
cheapest way, the one whose initial comes first in ASCII. From a state the grammar
lets only one of user and assistant follow, so an initial and a state name one edit.

Rows are narrowed to one byte (initial and fault) before the program runs: tasks
stream rows sorted by conversation and turn, and hold those bytes of one conversation
at a time, about as many as its audit has characters; the costs of one block of
places are kept, those of the others found again. The repaired turns come from a
second stream, in which a conversation's audit precedes its rows; no text is held
beyond an Arrow batch. A conversation is one sequence, and its digest is one
SHA-256, so its rows meet in one task; they are never held there together.

Defined cases: nulls in conv_id, turn, role and text read as one space where text is
wanted, so a null text is blank; rows without conv_id form one conversation; rows
of one turn go by role and then by a digest of role and text; equal rows repeat each
other; an empty table gives an empty result; a conversation of which no row is left
has zeros and an empty audit; very long texts are hashed as they come; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship
from .common import WORD, written

#: States of the grammar: nothing yet, after a system row, after a user row, after an assistant row.
BEGIN, SYSTEM, USER, ASSISTANT = range(4)
#: The state that a row of the one role that may be inserted leads to.
NEXT = (USER, USER, ASSISTANT, USER)
#: Initials by number, and the states they lead to from each state.
INITIALS = "sua"
KEEP = ((SYSTEM, None, None, None), (USER, USER, None, USER), (None, None, ASSISTANT, None), (None,) * 4)
LEGAL = {(0, 1), (1, 2), (2, 1)}
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
FAR = 1 << 60
#: Places whose costs are held at a time.
BLOCK = 4096

Costs = tuple[int, int, int, int]


def with_inserts(v: list[int]) -> Costs:
    u, a = min(v[USER], INSERT + v[ASSISTANT]), min(v[ASSISTANT], INSERT + v[USER])
    return min(v[BEGIN], INSERT + u), min(v[SYSTEM], INSERT + u), u, a


END = with_inserts([0, FAR, FAR, 0])


def before(after: Costs, code: int) -> Costs:
    """Costs to go in front of a row, from those behind it; code is 4 * initial + fault."""
    initial, fault = divmod(code, 4)
    v = [DELETE + x for x in after]
    if fault not in (BLANK, DUPLICATE):
        more = CUT if fault == TRUNCATED else 0
        for state in range(4):
            kept = KEEP[initial][state]
            v[state] = min(v[state], REROLE + more + after[NEXT[state]], FAR if kept is None else more + after[kept])
    return with_inserts(v)


def repair(codes: bytes) -> tuple[int, str]:
    """(least cost, the edits' initials)."""
    n, v = len(codes), END
    behind: dict[int, Costs] = {}
    for begin in reversed(range(0, n, BLOCK)):
        behind[begin] = v
        for code in reversed(codes[begin : begin + BLOCK]):
            v = before(v, code)
    cost, state, audit = v[BEGIN], BEGIN, bytearray()
    for begin in range(0, n, BLOCK):
        part = codes[begin : begin + BLOCK]
        table = [behind.pop(begin)]
        for code in reversed(part):
            table.append(before(table[-1], code))
        table.reverse()
        for i, code in enumerate(part):
            initial, fault = divmod(code, 4)
            here, after = table[i], table[i + 1]
            more = CUT if fault == TRUNCATED else 0
            while True:
                to_go = here[state]
                if to_go == DELETE + after[state]:
                    audit += b"D"
                    break
                if to_go == INSERT + here[NEXT[state]]:
                    audit += b"I"
                    state = NEXT[state]
                    continue
                kept = KEEP[initial][state]
                if kept is not None and to_go == more + after[kept]:
                    audit += b"K"
                    state = kept
                else:
                    audit += b"R"
                    state = NEXT[state]
                break
    while END[state]:
        audit += b"I"
        state = NEXT[state]
    return cost, audit.decode()


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, dropped: rows after the damage that the contract names; dropped rows stay, marked."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    role = F.when(fate == 4, "user").otherwise(spaced("role"))
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace(spaced("text"), "[.!?]", "")).otherwise(spaced("text"))
    copies = F.sequence(F.lit(1), F.when(fate == 3, 2).otherwise(1))
    hit = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), (fate == 0).alias("dropped"), F.explode(copies).alias("copy"))
    return hit.drop("copy")


def _coded(rows: DataFrame) -> DataFrame:
    """rows without text, with digest and code."""
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    blank = ~F.col("text").rlike(WORD)
    cut = F.col("text").rlike(r"[^\x20\x09-\x0D.!?][\x20\x09-\x0D]*\z")
    told = rows.select("conv_id", "turn", "role", _digest().alias("digest"), "dropped", initial.alias("initial"), F.when(blank, BLANK).when(cut, TRUNCATED).otherwise(SOUND).alias("fault"))
    seen = F.row_number().over(Window.partitionBy("conv_id", "digest", "dropped").orderBy("turn"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marked = told.repartition(parts, "conv_id").withColumn("seen", seen)
    fault = F.when(F.col("fault") == BLANK, BLANK).when(F.col("seen") > 1, DUPLICATE).otherwise(F.col("fault"))
    return marked.select("conv_id", "turn", "role", "digest", "dropped", (F.col("initial") * 4 + fault).alias("code"))


def _digest():
    return F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256)


class Summary(NamedTuple):
    conv_id: int | None
    gaps: int
    blank: int
    duplicate: int
    truncated: int
    illegal: int
    cost: int
    audit: str


SUMMARY = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
KINDS = {"long": pa.int64(), "string": pa.string()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(x, KINDS[k]) for x, (_, k) in zip(zip(*rows), fields)], names=[n for n, _ in fields])


def _gathered(rows: Iterator[tuple], schema: str, most: int = 5000) -> Iterator[pa.RecordBatch]:
    """Rows in batches of `most` rows or about as many kilobytes of their last column."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 1000 + len(row[-1] or "")
        if size >= 1000 * most:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation of rows (conv_id, turn, dropped, code) that are sorted."""

    def each() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns))

    def done(conv, codes: bytearray, turns: list) -> Summary:
        faults = [0] * 4
        for code in set(codes):
            faults[code % 4] += codes.count(code)
        illegal = sum((a // 4, b // 4) not in LEGAL for a, b in zip(codes, codes[1:]))
        first, last, n = turns
        return Summary(conv, last - first + 1 - n if n else 0, *faults[1:], illegal, *repair(bytes(codes)))

    def whole() -> Iterator[tuple]:
        started, conv, codes, turns = False, None, bytearray(), [0, 0, 0]
        for of, turn, dropped, code in each():
            if not started or of != conv:
                if started:
                    yield done(conv, codes, turns)
                started, conv, codes, turns = True, of, bytearray(), [0, 0, 0]
            if dropped:
                continue
            codes.append(code)
            if turn is not None:
                if not turns[2]:
                    turns = [turn, turn, 1]
                elif turn != turns[1]:
                    turns = [turns[0], turn, turns[2] + 1]
        if started:
            yield done(conv, codes, turns)

    return _gathered(whole(), SUMMARY)


def summaries(rows: DataFrame) -> DataFrame:
    """SUMMARY of every conversation of rows (conv_id, turn, role, text, dropped)."""
    ship(rows.sparkSession)
    ordered = _coded(rows).sortWithinPartitions("conv_id", "turn", "role", "digest")
    return ordered.select("conv_id", "turn", "dropped", "code").mapInArrow(_summaries, SUMMARY)


def _rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str, str | None, str | None]]:
    """(conv_id, edit, role, text) of every repaired row in order, before them a row (conv_id, "", None, None) for each conversation."""
    conv, audit, at, state = None, "", 0, BEGIN

    def inserts() -> Iterator[tuple]:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            state, at = NEXT[state], at + 1
            yield conv, "I", "user" if state == USER else "assistant", ""

    for batch in batches:
        for of, head, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if head:
                yield from inserts()
                conv, audit, at, state = of, text, 0, BEGIN
                yield conv, "", None, None
                continue
            yield from inserts()
            edit, at = audit[at], at + 1
            if edit == "K":
                state = KEEP[INITIALS.index(role[0])][state]
                yield conv, edit, role, text
            elif edit == "R":
                state = NEXT[state]
                yield conv, edit, "user" if state == USER else "assistant", text
    yield from inserts()


def _stream(rows: DataFrame, told: DataFrame) -> DataFrame:
    """Each conversation's audit (head) and then its rows, in order within a partition."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heads = told.select("conv_id", F.lit(True).alias("head"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("digest"), F.col("audit").alias("text"))
    lines = rows.filter("not dropped").select("conv_id", F.lit(False).alias("head"), "turn", "role", _digest().alias("digest"), "text")
    dealt = heads.union(lines).repartition(parts, "conv_id").sortWithinPartitions("conv_id", F.col("head").desc(), "turn", "role", "digest")
    return dealt.select("conv_id", "head", "role", "text")


def repaired(rows: DataFrame, told: DataFrame) -> DataFrame:
    """The turns of the repaired conversations: conv_id, place (from 0), edit, role, text. told comes from summaries(rows)."""
    schema = "conv_id long, place long, edit string, role string, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def turns() -> Iterator[tuple]:
            place = 0
            for conv, edit, role, text in _rebuilt(batches):
                if role is None:
                    place = 0
                    continue
                yield conv, place, edit, role, text
                place += 1

        return _gathered(turns(), schema)

    return _stream(rows, told).mapInArrow(run, schema)


def digests(rows: DataFrame, told: DataFrame) -> DataFrame:
    """conv_id and repaired_sha256, of `role:text` of the repaired turns joined by line breaks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def whole() -> Iterator[tuple]:
            conv, digest, n = None, None, 0
            for of, _, role, text in _rebuilt(batches):
                if role is None:
                    if digest is not None:
                        yield conv, digest.hexdigest()
                    conv, digest, n = of, hashlib.sha256(), 0
                    continue
                digest.update((f"\n{role}:{text}" if n else f"{role}:{text}").encode())
                n += 1
            if digest is not None:
                yield conv, digest.hexdigest()

        return _gathered(whole(), "conv_id long, repaired_sha256 string")

    return _stream(rows, told).mapInArrow(run, "conv_id long, repaired_sha256 string")


def op13_conversations(conversations: DataFrame) -> DataFrame:
    rows = damaged(conversations)
    told = written(summaries(rows), "conversation-audits")
    hashed = digests(rows, told).withColumnRenamed("conv_id", "of")
    return told.join(hashed, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
