"""Repair of conversations: find faulty rows, and the cheapest edits that make the roles alternate.

The roles of a sound conversation are `(system? (user assistant)+)?`. A generalised LR parser reads a conversation's rows
and, beside shifting a row as it stands, may delete it, give it another role, or insert a row. Its stacks share their
parts in a graph; stacks with equal tops are merged and the one with the least (cost, audit) counts.

The parser reads from the last row to the first, with the grammar turned round: audits then grow at the front, so
that the lesser of two audits stays the lesser whatever is put before them. Read forwards that fails: "K" < "KI",
but "KR" > "KIR". Audits are never compared as a whole: a gap's tops keep the letters added there and the rank of
the audit behind them. A conversation of any length so takes some bytes a row.

Spark deals the rows by conversation and sorts them; a task streams over them and never holds a conversation's texts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright.llm.tables import arrow_batch as _batch, arrow_schema as _arrow, saved, text_key

WHITE = " \t\n\x0b\x0c\r"
#: What an edit costs; an undeleted row that is cut off costs CUT_OFF beside its edit.
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
#: The roles that a row may be given.
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)

# The LR table of the turned grammar: whole = nothing | pairs | pairs s; pairs = pairs pair | pair; pair = a u.
_SHIFT = {(0, "a"): 1, (2, "a"): 1, (1, "u"): 4, (2, "s"): 6}
_REDUCE = {4: ("pair", 2), 3: ("pairs", 1), 5: ("pairs", 2)}
_GOTO = {(0, "pair"): 3, (2, "pair"): 5, (0, "pairs"): 2}
_ACCEPT = (0, 2, 6)
#: States that can be on top once all reductions are done.
_TOPS = (0, 1, 2, 6)


class _Node:
    """A stack top: its state and the nodes below it, one per state, of all stacks that share it."""

    __slots__ = ("state", "below")

    def __init__(self, state: int, below: list):
        self.state, self.below = state, below


def _merged(nodes: list[_Node]) -> list[_Node]:
    """One node per state; what lies below equal nodes is merged too, so a graph is no larger than the table."""
    by_state: dict[int, list[_Node]] = {}
    for node in nodes:
        if not any(node is known for known in by_state.setdefault(node.state, [])):
            by_state[node.state].append(node)
    return [
        same[0] if len(same) == 1 else _Node(state, _merged([b for n in same for b in n.below]))
        for state, same in by_state.items()
    ]


def _reduced(top: _Node) -> list[_Node]:
    """What a top becomes by one reduction; itself if there is none."""
    if top.state not in _REDUCE:
        return [top]
    symbol, pops = _REDUCE[top.state]
    ends = [top]
    for _ in range(pops):
        ends = _merged([b for e in ends for b in e.below])
    return [_Node(_GOTO[end.state, symbol], [end]) for end in ends]


def _push(node: _Node, role: str) -> _Node | None:
    """The top after shifting a role and doing every reduction; None if no stack of this top takes it.

    The table leads all stacks that take a role to the same top.
    """
    if (node.state, role) not in _SHIFT:
        return None
    tops = [_Node(_SHIFT[node.state, role], [node])]
    while any(t.state in _REDUCE for t in tops):
        tops = _merged([r for t in tops for r in _reduced(t)])
    return tops[0]


class _Gap:
    """The tops between two rows: per state the least (cost, letters added here, rank of the audit behind)."""

    def __init__(self):
        self.tops: dict[int, tuple] = {}

    def offer(self, cost: int, letters: str, rank: int, before: int, node: _Node) -> bool:
        mine = self.tops.get(node.state)
        if mine is None:
            self.tops[node.state] = (cost, letters, rank, before, node)
            return True
        node = _merged([mine[4], node])[0]
        if (cost, letters, rank) < mine[:3]:
            self.tops[node.state] = (cost, letters, rank, before, node)
            return True
        self.tops[node.state] = (*mine[:4], node)
        return False

    def insert(self) -> None:
        """Inserted rows, until none makes a top cheaper."""
        waiting = list(self.tops)
        while waiting:
            cost, letters, rank, before, node = self.tops[waiting.pop()]
            for role in ROLES:
                top = _push(node, role)
                if top and self.offer(cost + INSERT, "I" + letters, rank, before, top):
                    waiting.append(top.state)

    def ranks(self) -> dict[int, int]:
        order = sorted({t[1:3] for t in self.tops.values()})
        return {state: order.index(t[1:3]) for state, t in self.tops.items()}


def parse(initials: str, faults: bytes) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair of a conversation; of equal ones the audit that is least in ASCII.

    `initials` holds each row's role initial (any character), `faults` its fault. The audit has a letter per edit, in
    row order: K(eep), R(erole), D(elete), I(nsert).
    """
    if len(initials) <= 64:
        return _parse_known(initials, faults)
    return _parse(initials, faults)


def _parse(initials: str, faults: bytes) -> tuple[int, str]:
    gap = _Gap()
    gap.offer(0, "", 0, 0, _Node(0, []))
    gap.insert()
    known: dict[str, int] = {}
    trail = bytearray()

    def note() -> None:
        for state in _TOPS:
            top = gap.tops.get(state)
            trail.extend((known.setdefault(top[1], len(known)), top[3]) if top else (0, 0))

    note()
    for k in range(len(initials) - 1, -1, -1):
        after, ranks = gap, gap.ranks()
        gap = _Gap()
        for state, top in after.tops.items():
            cost, node, rank = top[0], top[4], ranks[state]
            gap.offer(cost + DELETE, "D", rank, state, node)
            if faults[k] in (BLANK, DUPLICATE):
                continue
            more = CUT_OFF if faults[k] == TRUNCATED else 0
            if kept := _push(node, initials[k]):
                gap.offer(cost + more, "K", rank, state, kept)
            for role in ROLES:
                if given := _push(node, role):
                    gap.offer(cost + more + REROLE, "R", rank, state, given)
        gap.insert()
        note()
    ranks = gap.ranks()
    cost, _, state = min((gap.tops[s][0], ranks[s], s) for s in _ACCEPT if s in gap.tops)
    letters = list(known)
    audit, width = [], 2 * len(_TOPS)
    for at in range(len(trail) - width, -1, -width):
        place = at + 2 * _TOPS.index(state)
        audit.append(letters[trail[place]])
        state = trail[place + 1]
    return cost, "".join(audit)


_parse_known = lru_cache(100_000)(_parse)


def flagged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, n and `fault` of every row, written once.

    A row's first fault counts: blank (no character but white space), duplicate (role and text seen earlier in the
    conversation), truncated (its last character that isn't white space is none of `.!?`). A null text is blank.
    Rows come in order of turn (nulls first), then role, then text; rows equal in all of these are interchangeable
    and `n` tells them apart. A null conv_id is a conversation like any other.
    """
    end = F.right(F.rtrim("text", F.lit(WHITE)), F.lit(1))
    fault = F.when(F.coalesce(end, F.lit("")) == "", BLANK).when(~end.isin(".", "!", "?"), TRUNCATED).otherwise(SOUND)
    known = saved(
        rows.select("conv_id", "turn", "role", "text").select("*", F.monotonically_increasing_id().alias("n"), fault.alias("fault")),
        "turns",
    )
    # one row per text before the shuffle, so a text said a billion times is no crowded key
    first = (
        known.where(F.col("fault") != BLANK)
        .groupBy("conv_id", "role", *text_key(F.col("text")))
        .agg(F.min(F.struct("turn", "n"))["n"].alias("n"))
        .select("n", F.lit(True).alias("is_first"))
    )
    again = F.col("is_first").isNull() & (F.col("fault") != BLANK)
    return known.join(first, "n", "left").withColumn("fault", F.when(again, DUPLICATE).otherwise(F.col("fault"))).drop("is_first")


def _in_order(rows: DataFrame, *before: str) -> DataFrame:
    """A conversation's rows next to each other in one partition, sorted."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *before, "turn", "role", "text", "n")


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


class _Summary:
    """What is kept of a conversation while its rows go by."""

    def __init__(self, conv_id):
        self.conv_id, self.initials, self.faults = conv_id, [], bytearray()
        self.least = self.last = None
        self.turns = 0

    def add(self, turn, initial: str, fault: int) -> None:
        self.initials.append(initial)
        self.faults.append(fault)
        if turn is not None and turn != self.last:
            self.least = turn if self.least is None else self.least
            self.last = turn
            self.turns += 1

    def result(self) -> tuple:
        roles = "".join(self.initials)
        cost, audit = parse(roles, bytes(self.faults))
        return (
            self.conv_id, 0 if self.last is None else self.last - self.least + 1 - self.turns,
            *[self.faults.count(k) for k in (BLANK, DUPLICATE, TRUNCATED)],
            sum(a + b not in LEGAL for a, b in zip(roles, roles[1:])), cost, audit,
        )


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def plans(rows: DataFrame) -> DataFrame:
    """Per conversation of `flagged` rows: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.

    gaps: turns missing between the least and the greatest (nulls ignored). illegal: neighbours whose role initials
    are none of su, ua, au. A conversation has one row here, with one letter per edit.
    """
    conv = rows.schema["conv_id"].dataType
    schema = T.StructType([
        T.StructField("conv_id", conv), *[T.StructField(c, T.LongType()) for c in _COUNTS], T.StructField("audit", T.StringType()),
    ])
    out = _arrow(schema)

    def run(batches):
        mine, done = None, []
        for conv_id, turn, initial, fault in _rows(batches):
            if mine is None or mine.conv_id != conv_id:
                if mine is not None:
                    done.append(mine.result())
                mine = _Summary(conv_id)
            # one character a row, and one that no rule knows where the role is empty
            mine.add(turn, initial or "\0", fault)
            if len(done) >= 10_000:
                yield _batch(done, out)
                done = []
        if mine is not None:
            done.append(mine.result())
        yield _batch(done, out)

    return _in_order(rows).select("conv_id", "turn", F.left("role", F.lit(1)).alias("initial"), "fault").mapInArrow(run, schema)


def _wanted(role: str) -> str:
    return "a" if role == "u" else "u"


def repaired(rows: DataFrame, plans_: DataFrame) -> DataFrame:
    """The rows of the repaired conversations: conv_id, place (from 0), role, text, edit (its letter).

    A conversation's rows come next to each other and in order. An audit goes before its conversation's rows, which
    stream by; neither texts nor rows are gathered.
    """
    schema = T.StructType([
        rows.schema["conv_id"], T.StructField("place", T.LongType()), T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()), T.StructField("edit", T.StringType()),
    ])
    out = _arrow(schema)
    both = rows.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", "n").unionByName(
        plans_.select("conv_id", F.lit(0).alias("kind"), F.col("audit").alias("text")), allowMissingColumns=True
    )

    def run(batches):
        audit, at, place, last, conv, done = "", 0, 0, "", None, []

        def put(role, text, edit):
            nonlocal place, last
            done.append((conv, place, role, text, edit))
            place, last = place + 1, (role or "")[:1]

        def inserts():
            nonlocal at
            while at < len(audit) and audit[at] == "I":
                put(ROLES[_wanted(last)], "", "I")
                at += 1

        for conv_id, kind, role, text in _rows(batches):
            if kind == 0:
                inserts()  # those after the last row of the conversation before
                conv, audit, at, place, last = conv_id, text, 0, 0, ""
                continue
            inserts()
            edit = audit[at]
            at += 1
            if edit != "D":
                put(role if edit == "K" else ROLES[_wanted(last)], text, edit)
            if len(done) >= 10_000:
                yield _batch(done, out)
                done.clear()
        inserts()
        yield _batch(done, out)

    return _in_order(both, "kind").select("conv_id", "kind", "role", "text").mapInArrow(run, schema)


def digests(rows: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 (lowercase hex) of its `role:text` lines, newline-joined, of rows as `repaired` returns them."""
    import hashlib

    schema = T.StructType([rows.schema["conv_id"], T.StructField("sha256", T.StringType())])
    out = _arrow(schema)

    def run(batches):
        mine, digest, done = None, None, []
        for conv_id, role, text in _rows(batches):
            if digest is None or mine != conv_id:
                if digest is not None:
                    done.append((mine, digest.hexdigest()))
                mine, digest, line = conv_id, hashlib.sha256(), ""
            else:
                line = "\n"
            digest.update(f"{line}{role}:{text}".encode("utf-8", "surrogatepass"))
            if len(done) >= 10_000:
                yield _batch(done, out)
                done = []
        if digest is not None:
            done.append((mine, digest.hexdigest()))
        yield _batch(done, out)

    return rows.select("conv_id", "role", "text").mapInArrow(run, schema)


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(plans, repaired rows) of conversations with columns conv_id, turn, role, text; other columns are ignored.

    Rows without a text are blank and go. A null role can't be kept. An empty table has no conversations.
    """
    known = saved(flagged(rows), "flagged-turns")
    found = saved(plans(known), "repair-plans")
    return found, repaired(known, found)
