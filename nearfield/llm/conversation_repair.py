"""Conversation structure repair: a generalised LR parser with weighted edits over the role grammar.

The grammar's LR(0) automaton is built from its rules. Stacks share what lies below their tops, as a
graph. Before each row, and after the last, empty rows may be inserted; the row itself is kept, given
another role, or deleted; then all reductions that the automaton allows are made side by side. Equal
stacks merge: the one of minimum (cost, audit) stays. That loses nothing, as of two edits of the same
rows with equal cost none begins with the other, so whatever follows leaves their order as it is.

Conversations are sorted over all tasks by range, so that a long one is spread, and cut into chunks of
at most ``CHUNK`` rows. A chunk that may go on with a conversation is parsed from every stack there
can be; a fold per conversation then joins its chunks, each reduced to costs and edits. Text travels
only to the table of repaired rows.

Rows stand by turn, null first; rows of one turn by role, then by the SHA-256 of role and text. Null
role or text reads as one space; null conversation ids are one conversation. A row's first fault counts:
blank (nothing but white space), duplicate (role and text seen earlier), truncated (the last other
character isn't ``[.!?]``). A role counts by its first character; an empty one can't be kept. Repeated
rows are duplicates. Empty tables give no rows; other columns, whatever their names, aren't read. A fold
holds about 20 bytes per row of its longest conversation, and so does that one's row of the report.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from nearfield.llm.common import query, stored
from nearfield.plans import sizing

GRAMMAR = {
    "conversation": ((), ("s", "turns"), ("turns",)),
    "turns": (("pair",), ("turns", "pair")),
    "pair": (("u", "a"),),
}
#: Roles that a row may be given, by their first character.
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
CHUNK_BITS = 10
FINE, CUT_OFF, BAD = "0", "1", "2"
#: What becomes of a row in the repaired conversation, besides the roles: kept or deleted.
KEPT, GONE = "=", "-"


class Grammar:
    """LR(0) automaton of the rules; the first rule's name is what is to be parsed.

    A stack is ``(state, stack below)``. Rules may recur on the left only, which bounds stacks.
    """

    def __init__(self, rules: dict[str, tuple[tuple[str, ...], ...]]):
        self.rules = rules
        goal = next(iter(rules))
        start = self._closed({("", (goal,), 0)})
        states, self.next, todo = {start: 0}, {}, [start]
        while todo:
            items = todo.pop()
            for symbol in sorted({rhs[dot] for _, rhs, dot in items if dot < len(rhs)}):
                to = self._closed({(l, r, d + 1) for l, r, d in items if d < len(r) and r[d] == symbol})
                if to not in states:
                    states[to] = len(states)
                    todo.append(to)
                self.next[states[items], symbol] = states[to]
        self.complete = {n: [(l, len(r)) for l, r, d in sorted(x) if d == len(r) and l] for x, n in states.items()}
        self.shifting = {state for state, symbol in self.next if symbol not in rules}
        self.accepting = self.next[0, goal]
        self.after = lru_cache(None)(self._after)
        self.start = self._reduced((0, None))
        self.stacks = self._reachable()

    def _closed(self, items: set) -> frozenset:
        todo = list(items)
        while todo:
            _, rhs, dot = todo.pop()
            if dot < len(rhs):
                new = {(rhs[dot], r, 0) for r in self.rules.get(rhs[dot], ())} - items
                items |= new
                todo += new
        return frozenset(items)

    def _reduced(self, stack) -> tuple:
        """The stack and all that reductions make of it, as far as these can go on or end."""
        found, todo = [], [stack]
        while todo:
            stack = todo.pop()
            found.append(stack)
            for name, size in self.complete[stack[0]]:
                below = stack
                for _ in range(size):
                    below = below[1]
                todo.append((self.next[below[0], name], below))
        return tuple(x for x in found if x[0] in self.shifting or x[0] == self.accepting)

    def _after(self, stack, symbol: str) -> tuple:
        to = self.next.get((stack[0], symbol)) if symbol not in self.rules else None
        return self._reduced((to, stack)) if to is not None else ()

    def _reachable(self) -> list:
        symbols = sorted({s for _, s in self.next} - set(self.rules))
        found = dict.fromkeys(self.start)
        todo = list(found)
        while todo:
            new = [t for s in symbols for t in self.after(todo[0], s) if t not in found]
            todo = todo[1:] + new
            found.update(dict.fromkeys(new))
        return list(found)


class Repair:
    """Cheapest edits of rows given as ``initials`` and ``faults``, a character each."""

    def __init__(self, grammar=GRAMMAR, roles=ROLES):
        self.grammar, self.roles = Grammar(grammar), tuple(roles)
        self.number = {stack: i for i, stack in enumerate(self.grammar.stacks)}
        self.transfer = lru_cache(1 << 15)(self._transfer)

    def _inserted(self, front: dict) -> dict:
        """With rows inserted wherever that is cheaper than what is there."""
        front, todo = dict(front), list(front)
        while todo:
            stack = todo.pop()
            cost, audit, marks = front[stack]
            for role in self.roles:
                _put_all(front, self.grammar.after(stack, role), (cost + INSERT, audit + "I", marks + role.upper()), todo)
        return front

    def _row(self, front: dict, initial: str, fault: str) -> dict:
        out: dict = {}
        for stack, (cost, audit, marks) in self._inserted(front).items():
            _put_all(out, (stack,), (cost + DELETE, audit + "D", marks + GONE))
            if fault != BAD:
                cost += TRUNCATED * (fault == CUT_OFF)
                _put_all(out, self.grammar.after(stack, initial), (cost, audit + "K", marks + KEPT))
                for role in self.roles:
                    _put_all(out, self.grammar.after(stack, role), (cost + REROLE, audit + "R", marks + role))
        return out

    def _transfer(self, initials: str, faults: str, first: bool) -> list[tuple[int, int, int, str, str]]:
        """``entry, exit, cost, audit, marks`` of a chunk, from the start only or from every stack."""
        out = []
        for group in (self.grammar.start,) if first else ((s,) for s in self.grammar.stacks):
            front = dict.fromkeys(group, (0, "", ""))
            for initial, fault in zip(initials, faults, strict=True):
                front = self._row(front, initial, fault)
            entry = -1 if first else self.number[group[0]]
            out += [(entry, self.number[stack], *value) for stack, value in front.items()]
        return out

    def ends(self) -> list[tuple[int, int, int, str, str]]:
        """A conversation's end, as one more chunk: from every stack to acceptance."""
        out = []
        for stack in self.grammar.stacks:
            for end, value in self._inserted({stack: (0, "", "")}).items():
                if end[0] == self.grammar.accepting:
                    out.append((self.number[stack], 0, *value))
        return out

    def whole(self, initials: str, faults: str) -> tuple[int, str, str]:
        """Cost, audit and marks of one conversation."""
        fold = Fold(self)
        fold.add(self.transfer(initials, faults, True))
        cost, parts = fold.end()
        return cost, "".join(a for a, _ in parts), "".join(m for _, m in parts)


def _put_all(front: dict, stacks, value: tuple, changed: list | None = None) -> None:
    for stack in stacks:
        if stack not in front or value < front[stack]:
            front[stack] = value
            if changed is not None:
                changed.append(stack)


class Fold:
    """Joins the chunks of a conversation, in order."""

    def __init__(self, repair: Repair):
        self.repair, self.front, self.way = repair, {-1: (0, "")}, []

    def add(self, transfer) -> None:
        front: dict = {}
        way: dict = {}
        for entry, exit, cost, audit, marks in transfer:
            if entry in self.front:
                before, tail = self.front[entry]
                value = (before + cost, tail + audit)
                if exit not in front or value < front[exit]:
                    front[exit], way[exit] = value, (entry, audit, marks)
        # what all have in common no longer decides between them
        same = len(commonprefix([audit for _, audit in front.values()]))
        self.front = {stack: (cost, audit[same:]) for stack, (cost, audit) in front.items()}
        self.way.append(way)

    def end(self) -> tuple[int, list[tuple[str, str]]]:
        """The cost, and audit and marks of each chunk; the last one has what follows it."""
        self.add(self.repair.ends())
        at, parts = 0, []
        for way in reversed(self.way):
            at, audit, marks = way[at]
            parts.append((audit, marks))
        parts.reverse()
        (audit, marks), (last_audit, last_marks) = parts[-2:]
        return self.front[0][0], [*parts[:-2], (audit + last_audit, marks + last_marks)]


TRANSFER = "array<struct<entry:int,exit:int,cost:long,audit:string,marks:string>>"


def groups(batches: Iterator[pa.RecordBatch], start: Callable, add: Callable, end: Callable, schema):
    """Rows of sorted batches, group by group of the first column; ``end`` gives result rows."""
    out: list = []
    own, state, some = None, None, False
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if not some or row[0] != own:
                if some:
                    out += end(own, state)
                own, state, some = row[0], start(), True
            add(state, row)
            if len(out) >= 4096:
                yield _batch(out, schema)
                out = []
    if some:
        out += end(own, state)
    if out:
        yield _batch(out, schema)


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _arrow(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _sorted_by(df: DataFrame, *keys: str) -> DataFrame:
    """Each conversation in one task, in order."""
    n = sizing.shuffle_partitions(df.sparkSession)
    return df.repartition(n, keys[0]).sortWithinPartitions(*keys)


def repair(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """A report on each conversation, and the rows of the repaired ones.

    The report is ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``; repaired rows
    are ``conv_id, part, place, role, text`` in the order of part, then place.
    """
    given = stored(
        rows.select(
            F.col(f"`{conv_id}`").alias("conv_id"),
            F.col(f"`{turn}`").alias("turn"),
            F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
            F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    lines = _judged(given)
    marked = stored(_parsed(lines))
    report = (
        lines.groupBy("conv_id")
        .agg(
            F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
            *(F.count_if(F.col("fault") == name).alias(name) for name in ("blank", "duplicate", "truncated")),
        )
        .unionByName(marked.filter("audit IS NOT NULL").select("conv_id", "illegal", "cost", "audit"), True)
    )
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    report = report.groupBy("conv_id").agg(*(F.max(c).alias(c) for c in (*numbers, "audit")))
    return report, _repaired(given, lines, marked)


def _judged(given: DataFrame) -> DataFrame:
    """Rows without their text, in order, with each one's first fault."""
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    light = given.select(
        "conv_id",
        "turn",
        "role",
        "row",
        same.alias("same"),
        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("is_blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("is_cut"),
    )
    first = light.groupBy("conv_id", "same").agg(F.min(F.struct("turn", "row")).alias("first"))
    first = first.select(F.col("first.row").alias("first_row"))
    fault = (
        F.when(F.col("is_blank"), "blank").when(F.col("first_row").isNull(), "duplicate").when(F.col("is_cut"), "truncated")
    )
    judged = light.join(first, F.col("row") == F.col("first_row"), "left").select(
        "conv_id", "turn", "role", "row", "same", fault.alias("fault")
    )
    order = ("conv_id", "turn", "role", "same", "row")
    placed = judged.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(placed.drop("same").withColumn("place", F.monotonically_increasing_id()))


def _parsed(lines: DataFrame) -> DataFrame:
    """Per chunk its first place and marks; with a conversation's last one cost, audit and illegal pairs."""
    code = F.when(F.col("fault").isin("blank", "duplicate"), BAD).when(F.col("fault") == "truncated", CUT_OFF)
    row = F.struct(
        "place",
        F.when(F.col("role") == "", "\0").otherwise(F.substring("role", 1, 1)).alias("initial"),
        code.otherwise(FINE).alias("code"),
    )
    chunks = (
        lines.groupBy("conv_id", F.shiftright("place", CHUNK_BITS).alias("part"))
        .agg(F.sort_array(F.collect_list(row)).alias("rows"))
        .select(
            "conv_id",
            F.col("rows")[0]["place"].alias("place"),
            F.array_join("rows.initial", "").alias("initials"),
            F.array_join("rows.code", "").alias("codes"),
        )
    )
    inner = chunks.drop("codes").schema.add("transfer", DataType.fromDDL(TRANSFER))
    within = (1 << CHUNK_BITS) - 1

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, schema = Repair(), _arrow(inner)
        names = ("entry", "exit", "cost", "audit", "marks")
        for batch in batches:
            out = []
            for own, place, initials, codes in zip(*(c.to_pylist() for c in batch.columns)):
                # only a chunk at the very start of its span may go on with a conversation
                found = machine.transfer(initials, codes, True)
                if not place & within:
                    found = found + machine.transfer(initials, codes, False)
                out.append((own, place, initials, [dict(zip(names, x)) for x in found]))
            if out:
                yield _batch(out, schema)

    ended = chunks.select("conv_id", "place").schema
    for name, kind in (("marks", "string"), ("illegal", "long"), ("cost", "long"), ("audit", "string")):
        ended = ended.add(name, kind)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Repair()

        def start():
            return [Fold(machine), [], "", 0]

        def add(state, row):
            _, place, initials, transfer = row
            pairs = state[2] + initials
            state[3] += sum(a + b not in LEGAL for a, b in zip(pairs, pairs[1:]))
            state[2] = initials[-1]
            state[1].append(place)
            state[0].add([tuple(x.values()) for x in transfer])

        def end(own, state):
            cost, parts = state[0].end()
            out = [(own, place, marks, None, None, None) for place, (_, marks) in zip(state[1], parts, strict=True)]
            out[-1] = (*out[-1][:3], state[3], cost, "".join(audit for audit, _ in parts))
            return out

        yield from groups(batches, start, add, end, _arrow(ended))

    return _sorted_by(chunks.mapInArrow(parse, inner), "conv_id", "place").mapInArrow(fold, ended)


def _repaired(given: DataFrame, lines: DataFrame, marked: DataFrame) -> DataFrame:
    steps = marked.select("conv_id", "place", "marks")
    schema = steps.select("conv_id", F.col("place").alias("part")).schema
    schema = schema.add("place", "integer").add("line", "long").add("mark", "string")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new = np.frombuffer("".join(ROLES).upper().encode(), np.uint8)
        for batch in batches:
            marks = batch.column("marks").cast(pa.binary())
            size = pc.binary_length(marks).to_numpy()
            chunk, ends = np.repeat(np.arange(len(size)), size), np.cumsum(size)
            mark = np.frombuffer(b"".join(marks.to_pylist()), np.uint8)
            given_row = ~np.isin(mark, new)
            before = np.concatenate([[0], np.cumsum(given_row)])
            first = batch.column("place").to_numpy()
            line = first[chunk] + before[:-1] - before[ends - size][chunk]
            stays = np.flatnonzero(mark != ord(GONE))
            columns = [
                batch.column("conv_id").take(pa.array(chunk[stays])),
                pa.array(first[chunk[stays]]),
                pa.array((stays - (ends - size)[chunk[stays]]).astype(np.int32)),
                pa.array(line[stays], mask=~given_row[stays]),
                pa.array(mark[stays].view("S1").astype(str)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    rows = stored(steps.mapInArrow(spread, schema))
    named = F.create_map(*(F.lit(x) for pair in ROLES.items() for x in pair))
    texts = lines.select(F.col("place").alias("line"), "row").join(given.select("row", "role", "text"), "row")
    kept = rows.filter("line IS NOT NULL").join(texts, "line")
    role = F.when(F.col("mark") == KEPT, F.col("role")).otherwise(named[F.col("mark")])
    new = rows.filter("line IS NULL").withColumn("role", named[F.lower("mark")]).withColumn("text", F.lit(""))
    columns = ("conv_id", "part", "place", "role", "text")
    return kept.withColumn("role", role).select(*columns).unionByName(new.select(*columns))


def digests(repaired: DataFrame) -> DataFrame:
    """SHA-256 of each repaired conversation as lines of ``role:text``, read as a stream."""
    lines = repaired.select("conv_id", "part", "place", F.concat("role", F.lit(":"), "text").alias("line"))
    schema = lines.select("conv_id").schema.add("repaired_sha256", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def add(state, row):
            state.append(hashlib.sha256()) if not state else state[0].update(b"\n")
            state[0].update(row[3].encode())

        yield from groups(batches, list, add, lambda own, state: [(own, state[0].hexdigest())], _arrow(schema))

    return _sorted_by(lines, "conv_id", "part", "place").mapInArrow(run, schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with faults chosen by the crc32 of conversation and turn."""
    names = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    df = conversations.select(
        "conv_id",
        "turn",
        *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")),
        (F.crc32(F.concat(names[0], F.lit(":"), names[1])) % 20).alias("way"),
    )
    times = F.when(F.col("way") == 0, 0).when(F.col("way") == 3, 2).otherwise(1)
    text = (
        F.when(F.col("way") == 1, "")
        .when(F.col("way") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
    )
    return df.select(
        "conv_id",
        "turn",
        F.when(F.col("way") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), times)).alias("copy"),
    ).drop("copy")


@query()
def op12_conversation_repair(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    report, repaired = repair(damaged(given))
    parts = given.select("conv_id").distinct().unionByName(report, True).unionByName(digests(repaired), True)
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return parts.groupBy("conv_id").agg(
        *(F.coalesce(F.max(c), F.lit(0)).alias(c) for c in numbers),
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
