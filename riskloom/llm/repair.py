"""Conversation structure repair: lightest derivations of a legal turn sequence, popped from an agenda."""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import chunk_rank, join_null_safe, ranged, stored

BLANKS = " \t\n\x0b\x0c\r"
#: Legal orders of role initials, ``(s?(ua)+)?``: state -> initial -> next state.
LEGAL = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
START, GOALS = 0, (0, 3)
#: Roles that an edit may write, by initial.
WRITABLE = {"u": "user", "a": "assistant"}
FOLLOWING = {"su", "ua", "au"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Rows solved as one span; spans are then joined.
BLOCK = 1024
#: States that a state may lead to, itself included: nothing leads back to 0 and 1.
REACHED = {0: {0, 1, 2, 3}, 1: {1, 2, 3}, 2: {2, 3}, 3: {2, 3}}

#: A kept-or-edited row (initial, truncated), or a number of rows that must go.
Token = tuple[str, bool] | int
#: (state before, state after, cost, audit) of the best repair of a span of rows.
Item = tuple[int, int, int, str]


def written(state: int) -> str:
    """The initial of the only role that an edit may write in a state; the grammar never leaves a choice."""
    return next(initial for initial in LEGAL[state] if initial in WRITABLE)


@dataclass(frozen=True)
class Final:
    """Best weight of an item, the item it was deduced from, and the audit of the step between."""

    cost: int
    audit: str
    place: int
    state: int
    step: str


def lightest(start: int, goals: set[tuple[int, int]], deduced: Callable[[int, int], Iterable[tuple[int, int, int, str]]]) -> dict[tuple[int, int], Final]:
    """Best weights of items, by Knuth's generalisation of shortest paths, until all ``goals`` are final.

    An item (place, state) says that the rows before the place are repaired and
    leave the grammar in the state. ``deduced`` gives, for the item just
    finalised, (place, state, cost, audit) of what follows from it and one premise
    more: costs add and audits are appended, which never makes a weight smaller,
    so the least weight of the agenda is final. At one place two audits of equal
    cost hold as many letters for rows and as many insertions, so neither is the
    beginning of the other and appending keeps their order.
    """
    agenda = [(0, "", 0, start, 0, start, "")]
    final: dict[tuple[int, int], Final] = {}
    missing = set(goals)
    while agenda and missing:
        cost, audit, place, state, *source = heapq.heappop(agenda)
        if (place, state) in final:
            continue
        final[place, state] = Final(cost, audit, *source)
        missing.discard((place, state))
        for to, after, more, letters in deduced(place, state):
            if (to, after) not in final:
                heapq.heappush(agenda, (cost + more, audit + letters, to, after, place, state, letters))
    return final


def span_items(tokens: list[Token], starts: Iterable[int]) -> list[Item]:
    """Best repairs of a span of rows from each of the states in ``starts`` to every state they can reach."""

    def deduced(place: int, state: int) -> Iterator[tuple[int, int, int, str]]:
        initial = written(state)
        yield place, LEGAL[state][initial], INSERT, "I"
        if place == len(tokens):
            return
        token = tokens[place]
        if isinstance(token, int):
            yield place + 1, state, DELETE * token, "D" * token
            return
        own, cut = token
        late = TRUNCATED if cut else 0
        yield place + 1, state, DELETE, "D"
        yield place + 1, LEGAL[state][initial], REROLE + late, "R"
        if own in LEGAL[state]:
            yield place + 1, LEGAL[state][own], KEEP + late, "K"

    ends = {(len(tokens), state) for state in LEGAL}
    items = []
    for start in starts:
        # no state leads back to the first two, so these stay out of reach of most starts
        goals = {(place, state) for place, state in ends if state in REACHED[start]}
        final = lightest(start, goals, deduced)
        items += [(start, end[1], final[end].cost, final[end].audit) for end in sorted(goals & final.keys())]
    return items


def joined_spans(spans: list[list[Item]]) -> tuple[int, list[tuple[int, str]]]:
    """Cost of the best repair of spans that follow each other, and (state before, audit) of each span in it."""

    def deduced(place: int, state: int) -> Iterator[tuple[int, int, int, str]]:
        for before, after, cost, audit in spans[place] if place < len(spans) else []:
            if before == state:
                yield place + 1, after, cost, audit

    goals = {(len(spans), state) for state in GOALS}
    final = lightest(START, goals, deduced)
    at = min(goals & final.keys(), key=lambda goal: (final[goal].cost, final[goal].audit))
    cost, pieces = final[at].cost, []
    while at[0]:
        pieces.append((final[at].state, final[at].step))
        at = (final[at].place, final[at].state)
    return cost, pieces[::-1]


@dataclass
class Tally:
    """What a run of rows of one conversation counts, and what the next run needs to know of it."""

    gaps: tuple[int, int, int] | None = None  # least turn, greatest turn, distinct turns
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first: str | None = None
    last: str | None = None

    def add(self, other: Tally) -> None:
        """Append the rows of ``other``, which follow in turn order."""
        if other.gaps:
            low, high, distinct = other.gaps
            if self.gaps:
                # turns come in order, so only the turn at the border can be in both
                distinct += self.gaps[2] - (low == self.gaps[1])
                low = self.gaps[0]
            self.gaps = (low, high, distinct)
        self.blank += other.blank
        self.duplicate += other.duplicate
        self.truncated += other.truncated
        self.illegal += other.illegal
        if self.last is not None and other.first is not None:
            self.illegal += self.last + other.first not in FOLLOWING
        self.first = other.first if self.first is None else self.first
        self.last = self.last if other.last is None else other.last

    def row(self, turn: int | None, initial: str, fault: str, copies: int) -> list[Token]:
        """Append a row and its copies; the tokens they are to the agenda."""
        # a copy of a row never follows it legally
        added = Tally(None if turn is None else (turn, turn, 1), illegal=copies - 1, first=initial, last=initial)
        tokens: list[Token] = []
        if fault == "blank":
            added.blank = copies
            tokens = [copies]
        elif fault == "duplicate":
            added.duplicate = copies
            tokens = [copies]
        else:
            added.truncated = int(fault == "truncated")
            added.duplicate = copies - 1
            tokens = [(initial, fault == "truncated"), *([copies - 1] if copies > 1 else [])]
        self.add(added)
        return tokens


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows with planted faults, by the checksum of conversation and turn.

    Of twenty remainders 0 drops the row, 1 empties its text, 2 takes the ends of
    sentences out of it, 3 doubles it and 4 makes it a user's. Nulls of role and
    text are one space, as they are in the checksum's text.
    """
    blank = F.lit(" ")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"),
        F.coalesce(F.col("text").cast("string"), blank).alias("text"),
    )
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rows = rows.withColumn("_kind", F.crc32(name.cast("binary")) % 20).where("_kind <> 0")
    kind = F.col("_kind")
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(kind == 3, F.lit(2)).otherwise(F.lit(1)).cast("long").alias("copies"),
    )


def placed_rows(rows: DataFrame) -> DataFrame:
    """(conv_id, block, pos, turn, role, text, initial, fault, copies): rows in order, equal ones counted in one.

    Order is by turn, nulls first, then role and text. ``fault`` is the first of
    blank, duplicate and truncated that holds, or empty; of equal rows it is that
    of the first. A conversation of any length is many ranges and many blocks.
    """
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    bare = F.btrim("text", F.lit(BLANKS))
    rows = rows.withColumn("one", F.lit(1).cast("long")).withColumn("bare", bare)
    rows = rows.select(
        "conv_id",
        "turn",
        "role",
        "text",
        "copies",
        "one",
        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("said"),
        F.when(F.col("bare") == "", F.lit("blank")).when(~F.right("bare", F.lit(1)).isin(".", "!", "?"), F.lit("truncated")).otherwise(F.lit("")).alias("fault"),
    )
    rows = ranged(stored(rows, "repair-rows"), ["conv_id", "turn", "role", "text"], 16_384, "repair-ranges")
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    seen = rows.groupBy("conv_id", "said").agg(F.min(place).alias("earliest"), F.count("*").alias("times"))
    seen = seen.where("times > 1").select("conv_id", "said", "earliest")
    rows = chunk_rank(rows, ["conv_id"], "_part", ["turn", "role", "text"], {"pos": "one"})
    rows = join_null_safe(rows, seen, ["conv_id", "said"], "left")
    again = F.col("earliest").isNotNull() & ~place.eqNullSafe(F.col("earliest")) & (F.col("fault") != "blank")
    return rows.select(
        "conv_id",
        F.floor(F.col("pos") / BLOCK).cast("long").alias("block"),
        "pos",
        "turn",
        "role",
        "text",
        F.substring("role", 1, 1).alias("initial"),
        F.when(again, F.lit("duplicate")).otherwise(F.col("fault")).alias("fault"),
        "copies",
    )


_TALLY = "low long, high long, distinct long, blank long, duplicate long, truncated long, illegal long"
_SPANS = f"conv_id long, block long, {_TALLY}, first string, last string, items array<struct<before:int,after:int,cost:long,audit:string>>"
_PLANS = f"conv_id long, block long, state int, piece string, gaps long, {_TALLY.split('distinct long, ')[1]}, cost long, audit string"
_RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_KINDS = {
    "long": pa.int64(),
    "int": pa.int32(),
    "string": pa.string(),
    "array<struct<before:int,after:int,cost:long,audit:string>>": pa.list_(
        pa.struct([("before", pa.int32()), ("after", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
    ),
}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [field.split(" ", 1) for field in schema.split(", ")]
    columns = [pa.array(values, _KINDS[kind]) for values, (_, kind) in zip(zip(*rows), fields)]
    return pa.RecordBatch.from_arrays(columns, names=[name for name, _ in fields])


def _batches(rows: Iterable[tuple], schema: str, most: int = 1024) -> Iterator[pa.RecordBatch]:
    some: list[tuple] = []
    for row in rows:
        some.append(row)
        if len(some) == most:
            yield _batch(some, schema)
            some = []
    if some:
        yield _batch(some, schema)


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            yield from zip(*(column.to_pylist() for column in batch.slice(at, 1024).columns))


def repair_spans(rows: DataFrame) -> DataFrame:
    """One row per conversation and block of rows: its tally and the best repairs of its span."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def spans() -> Iterator[tuple]:
            for (conv, block), group in groupby(_rows(batches), key=lambda row: row[:2]):
                tally, tokens = Tally(), []
                for _, _, _, turn, initial, fault, copies in group:
                    tokens += tally.row(turn, initial, fault, copies)
                items = span_items(tokens, LEGAL if block else (START,))
                counts = (tally.blank, tally.duplicate, tally.truncated, tally.illegal, tally.first, tally.last)
                yield (conv, block, *(tally.gaps or (None,) * 3), *counts, [dict(zip(("before", "after", "cost", "audit"), item)) for item in items])

        return _batches(spans(), _SPANS)

    bare = rows.select("conv_id", "block", "pos", "turn", "initial", "fault", "copies")
    return bare.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "pos").mapInArrow(run, _SPANS)


def repair_plans(spans: DataFrame) -> DataFrame:
    """One row per conversation and block: the state before it and its part of the cheapest audit; block 0 has the totals."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def plans() -> Iterator[tuple]:
            for conv, group in groupby(_rows(batches), key=lambda row: row[0]):
                tally, items = Tally(), []
                for _, _, low, high, distinct, blank, duplicate, truncated, illegal, first, last, found in group:
                    gaps = None if low is None else (low, high, distinct)
                    tally.add(Tally(gaps, blank, duplicate, truncated, illegal, first, last))
                    items.append([(x["before"], x["after"], x["cost"], x["audit"]) for x in found])
                cost, pieces = joined_spans(items)
                low, high, distinct = tally.gaps or (0, -1, 0)
                totals = (high - low + 1 - distinct, tally.blank, tally.duplicate, tally.truncated, tally.illegal, cost, "".join(p for _, p in pieces))
                for block, (state, piece) in enumerate(pieces):
                    yield (conv, block, state, piece, *(totals if block == 0 else (None,) * 7))

        return _batches(plans(), _PLANS)

    return spans.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(run, _PLANS)


class Writer:
    """The repaired rows of one conversation, in order, as their digest."""

    def __init__(self, totals: tuple):
        self.totals, self.state, self.letters, self.at = totals, START, "", 0
        self.digest, self.started = hashlib.sha256(), False

    def say(self, role: str, text: str) -> None:
        self.digest.update((("\n" if self.started else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.started = True

    def insert(self) -> None:
        """The insertions in front of the next letter."""
        while self.letters[self.at : self.at + 1] == "I":
            self.write("")
            self.at += 1

    def write(self, text: str) -> None:
        initial = written(self.state)
        self.say(WRITABLE[initial], text)
        self.state = LEGAL[self.state][initial]

    def plan(self, state: int, letters: str) -> None:
        self.insert()
        self.state, self.letters, self.at = state, letters, 0

    def row(self, role: str, text: str, copies: int) -> None:
        for _ in range(copies):
            self.insert()
            letter = self.letters[self.at]
            self.at += 1
            if letter == "R":
                self.write(text)
            elif letter == "K":
                self.say(role, text)
                self.state = LEGAL[self.state][role[:1]]

    def result(self, conv: int | None) -> tuple:
        self.insert()
        gaps, blank, duplicate, truncated, illegal, cost, audit = self.totals
        return (conv, gaps, blank, duplicate, truncated, illegal, cost, audit, self.digest.hexdigest())


def repaired_digests(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """One row per conversation: its plan's totals and the digest of its repaired rows.

    A block's plan comes in front of its rows and rows stream by in order, so
    memory does not grow with a conversation. The digest of a conversation is one
    sequential hash, so one task reads its rows.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results() -> Iterator[tuple]:
            for conv, group in groupby(_rows(batches), key=lambda row: row[0]):
                writer = None
                for _, _, pos, role, text, copies, state, letters, *totals in group:
                    if pos is not None:
                        writer.row(role, text, copies)
                        continue
                    writer = writer or Writer(tuple(totals))
                    writer.plan(state, letters)
                yield writer.result(conv)

        return _batches(results(), _RESULT)

    totals = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    turns = rows.select("conv_id", "block", "pos", "role", "text", "copies")
    both = turns.unionByName(plans.select("conv_id", "block", "state", "piece", *totals), allowMissingColumns=True)
    both = both.select("conv_id", "block", "pos", "role", "text", "copies", "state", "piece", *totals)
    # a plan has no position, and nulls come first
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "block", "pos").mapInArrow(run, _RESULT)


def repaired(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per conv_id of ``conversations``: faults of its ``rows`` (conv_id, turn, role, text, copies) and their cheapest repair.

    A repair gives the role initials of ``s?(ua)+``, or nothing. Keeping a row is
    free; making it the user's or the assistant's costs 3, deleting it 4,
    inserting an empty one 3; a truncated row that stays costs 3 more; blank and
    duplicate rows are deleted. ``audit`` has the initials of the edits in order,
    the least in ASCII of the cheapest ones; ``repaired_sha256`` is of the
    repaired rows ``role:text``, joined by line feeds.

    Rows of one turn follow role and text; rows that repeat are duplicates. A null
    conv_id is a conversation; a null turn comes first and counts for no gap. A
    role that is empty or of another initial is never kept. A conversation without
    rows has zeros, an empty audit and the digest of nothing. Other columns are ignored.

    Blocks of rows are solved by their own tasks, for every state they may start
    in, and joined by the same search; audits, a byte a row, and the digest of one
    conversation are made by one task.
    """
    rows = stored(placed_rows(rows), "repair-placed")
    plans = stored(repair_plans(stored(repair_spans(rows), "repair-spans")), "repair-plans")
    found = repaired_digests(rows, plans)
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    none = {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256().hexdigest())}
    joined = join_null_safe(ids, found, ["conv_id"], "left")
    return joined.select("conv_id", *[F.coalesce(c, none.get(c, F.lit(0).cast("long"))).alias(c) for c in found.columns[1:]])
