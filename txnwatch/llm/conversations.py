"""Structure repair of conversations at the least cost, by whole-number weights in a DAG.

A repaired conversation's roles read ``(s?(ua)+)?`` by their initials: perhaps a system row, then
user and assistant in turn, or nothing at all. Edits: Keep costs 0, Rerole to user or assistant
3, Delete 4, Insert of an empty user or assistant row 3; a truncated row that isn't deleted adds
3; blank and duplicate rows must be deleted. Of the cheapest edits those whose initials come
first in ASCII order count (a text that ends comes before one that goes on).

Both aims are one whole number. Its high digits are the cost. Its low digits have a fixed
width, one place per edit from the left, filled with the edit's letter (D, I, K, R as 1 to 4)
and zero after the end. So the number of a path is the sum of its edges' numbers, the smallest
number belongs to the answer, and an ordinary minimum over a DAG decides everything. Nodes are
(rows taken, state of the role pattern); two ways to one node, ended right after a row, are never
the beginning of one another, so the smaller number stays smaller whatever follows.

The number of places is the same for conversations of any length: after ``BLOCK`` rows the
letters of the (at most four) states are put away and their order takes one place.

Rows are shuffled once, by conversation, sorted by Spark and read as a stream; a task holds the
rows of one conversation at a time, which are one row of the result. Whether a row repeats an earlier one
is found by a window over the same partitioning.

Order: by turn, nulls first, rows of one turn by role and text. Defined results: a null role or
text counts as one space; rows whose conversation is null form one; a row's first fault counts,
of blank, duplicate (role and text seen earlier), truncated (last character that isn't white space
none of ``.!?``); an empty role has no initial; gaps count over turns that aren't null; rows that repeat are
duplicates; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnwatch.llm.common import SPACES

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Digit of each edit's letter, in ASCII order.
DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
BITS = 3
BLOCK = 64
"""Rows after which letters are put away; results don't depend on it."""
NEXT = {"start": "user", "system": "user", "user": "assistant", "assistant": "user"}
"""The role that may follow. A conversation may end in ``start`` or after an assistant."""
STATES = tuple(NEXT)
ENDS = ("start", "assistant")
ROLE_OF = {"s": "system", "u": "user", "a": "assistant"}
BLANKS = SPACES.decode()


def _edges(initial: str, fault: str) -> list[tuple[int, int, int, str]]:
    """``from, to, cost, letters``: the inserts before a row and what is done with it."""
    out = []
    for start in STATES:
        state, inserted, seen = start, 0, set()
        while state not in seen:
            seen.add(state)
            ways = [(state, DELETE, "D")]
            if fault not in ("blank", "duplicate"):
                extra = TRUNCATED if fault == "truncated" else 0
                role = ROLE_OF.get(initial)
                if role == NEXT[state] or (role == "system" and state == "start"):
                    ways.append((role, KEEP + extra, "K"))
                ways.append((NEXT[state], REROLE + extra, "R"))
            for to, cost, letter in ways:
                out.append((STATES.index(start), STATES.index(to), inserted * INSERT + cost, "I" * inserted + letter))
            state, inserted = NEXT[state], inserted + 1
    return out


def _endings() -> list[tuple[int, int, str]]:
    out = []
    for start in STATES:
        state, inserted = start, 0
        while state not in ENDS:
            state, inserted = NEXT[state], inserted + 1
        out.append((STATES.index(start), inserted * INSERT, "I" * inserted))
    return out


#: Places of a block: its rows, two inserts before each and at the end, one for the order of the states.
PLACES = 1 + 3 * BLOCK + 2
LOW = BITS * PLACES


def _digits(letters: str) -> int:
    number = 0
    for letter in letters:
        number = number << BITS | DIGIT[letter]
    return number


def _weighed(edges: list) -> list:
    return [(*edge[:-1], _digits(edge[-1]), len(edge[-1]), edge[-1]) for edge in edges]


EDGES = {
    (initial, fault): _weighed(_edges(initial, fault))
    for initial in ("s", "u", "a", "")
    for fault in ("", "blank", "duplicate", "truncated")
}
ENDINGS = _weighed(_endings())


def cheapest(rows: Iterable[tuple[str, str]]) -> tuple[int, str]:
    """Cost and letters of the best edits for rows given as ``(initial, fault)``."""
    # per state: number, places used, (state before the block, letters of the block)
    live: dict[int, tuple[int, int, tuple]] = {0: (0, 1, (0, ""))}
    put_away: list[dict[int, tuple]] = []

    def closed() -> dict[int, tuple[int, int, tuple]]:
        put_away.append({state: at[2] for state, at in live.items()})
        order = sorted(live, key=lambda state: live[state][0] & ((1 << LOW) - 1))
        # the costs stay; the order of the letters is the first place of the next block
        return {
            state: (live[state][0] >> LOW << LOW | rank << (LOW - BITS), 1, (state, ""))
            for rank, state in enumerate(order)
        }

    for k, row in enumerate(rows):
        if k and k % BLOCK == 0:
            live = closed()
        best: dict[int, tuple[int, int, tuple]] = {}
        for start, to, cost, digits, places, letters in EDGES[row]:
            at = live.get(start)
            if at is None:
                continue
            number = at[0] + (cost << LOW) + (digits << (LOW - BITS * (at[1] + places)))
            if to not in best or number < best[to][0]:
                best[to] = (number, at[1] + places, (at[2][0], at[2][1] + letters))
        live = best
    ends = []
    for start, cost, digits, places, letters in ENDINGS:
        if start in live:
            number, used, (before, text) = live[start]
            ends.append((number + (cost << LOW) + (digits << (LOW - BITS * (used + places))), before, text + letters))
    number, state, text = min(ends)
    parts = [text]
    for block in reversed(put_away):
        state, text = block[state]
        parts.append(text)
    return number >> LOW, "".join(reversed(parts))


def fault_of(text: str, seen: bool) -> str:
    rest = text.rstrip(BLANKS)
    if not rest:
        return "blank"
    if seen:
        return "duplicate"
    return "" if rest[-1] in ".!?" else "truncated"


def repaired(rows: list[tuple[str, str]], letters: str) -> list[tuple[str, str]]:
    """The ``(role, text)`` rows that the edits leave."""
    out, state, left = [], "start", iter(rows)
    for letter in letters:
        if letter == "I":
            state = NEXT[state]
            out.append((state, ""))
            continue
        role, text = next(left)
        if letter == "D":
            continue
        if letter == "R":
            role = NEXT[state]
        state = ROLE_OF[role[0]]
        out.append((role, text))
    return out


RESULT = pa.schema([
    ("conv_id", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()),
    ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()),
    ("repaired", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))),
])
RESULT_DDL = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "cost bigint, audit string, repaired array<struct<role:string,text:string>>"
)
BATCH_ROWS, BATCH_CHARS = 2_000, 4 << 20


def judge(rows: list[tuple[int | None, str, str, bool]]) -> tuple:
    """Everything about one conversation from its ordered ``(turn, role, text, seen)`` rows."""
    turns = {turn for turn, *_ in rows if turn is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    faults = [fault_of(text, seen) for _, _, text, seen in rows]
    initials = [role[:1] for _, role, _, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit = cheapest((i if i in ROLE_OF else "", f) for i, f in zip(initials, faults))
    kept = repaired([(role, text) for _, role, text, _ in rows], audit)
    counts = tuple(faults.count(kind) for kind in ("blank", "duplicate", "truncated"))
    return (gaps, *counts, illegal, cost, audit, [{"role": r, "text": t} for r, t in kept])


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(column.to_pylist() for column in batch.columns))

    def made(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), RESULT)], schema=RESULT)

    out, chars = [], 0
    for conv_id, group in groupby(rows(), itemgetter(0)):
        there = [row[1:5] for row in group if row[5]]
        out.append((conv_id, *judge(there)))
        chars += sum(len(row[2]) for row in there)
        if len(out) >= BATCH_ROWS or chars >= BATCH_CHARS:
            yield made(out)
            out, chars = [], 0
    if out:
        yield made(out)


def _filled(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))


def repair(rows: DataFrame, there: Column | None = None) -> DataFrame:
    """One row per conversation of ``conv_id, turn, role, text``: faults, cost, audit, repaired rows.

    ``there``: false marks rows that only say that their conversation exists.
    """
    slim = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        _filled("role").alias("role"), _filled("text").alias("text"),
        (F.lit(True) if there is None else there).alias("there"),
    ).repartition("conv_id")
    digest = F.sha2(F.concat("role", F.lit("\0"), F.col("text")), 256)
    order = [F.col("turn").asc_nulls_first()]
    earlier = Window.partitionBy("conv_id", "there", digest, "role").orderBy(*order)
    return (
        slim.withColumn("seen", F.row_number().over(earlier) > 1)
        .select("conv_id", "turn", "role", "text", "seen", "there")
        .sortWithinPartitions("conv_id", *order, "role", "text", "seen")
        .mapInArrow(_judged, RESULT_DDL)
    )


def damaged(rows: DataFrame) -> DataFrame:
    """The rows with faults put in by the CRC-32 of ``conv_id:turn`` modulo 20, and ``there``: false where dropped."""
    key = F.concat(_filled("conv_id"), F.lit(":"), _filled("turn"))
    kind = F.crc32(key.cast("binary")) % 20
    marked = rows.select("conv_id", "turn", _filled("role").alias("role"), _filled("text").alias("text"), kind.alias("_kind"))
    text = F.when(F.col("_kind") == 1, F.lit("")).when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("_kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return marked.select(
        "conv_id", "turn", F.when(F.col("_kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.alias("text"), (F.col("_kind") != 0).alias("there"), F.explode(copies).alias("_copy"),
    ).drop("_copy")
