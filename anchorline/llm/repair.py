"""Conversation structure repair: a generalised LR parser with weighted edits over the role grammar.

A conversation is repaired so that its roles' initials read ``(s?(ua)+)?``. The grammar's
LR tables are below; the parser keeps a graph-structured stack whose nodes share their
tails, and takes each row by every action that a stack allows: keep (K, nothing), rerole
to user or assistant (R, 3), delete (D, 4), after inserting up to two empty turns (I, 3
each). Blank and duplicate rows can only be deleted; a truncated row that stays costs 3
more. Equal stack tops are merged by the smaller (cost, audit), the audit being the
edits' initials in order, so the result is the cheapest repair, of several the one whose
audit is least in ASCII order.

A set of stacks with its relative costs recurs, so what a row does to it is worked out
once and then looked up. A task reads its rows sorted and holds a small record for each
row of one conversation, never its texts; the texts are read in a second sorted pass, row
by row, beside the audit.

A row's first fault counts: blank (nothing but white space), duplicate (role and text
stood in an earlier row of the conversation), truncated (the last character that is not
white space is not one of ``.!?``).

Defined cases: null roles and texts are one space; a null conv_id is a conversation; null
turns come first; rows of one turn are taken by role, then by text; repeated rows are
duplicates; rows whose ``present`` column is false or null count for nothing but the
name of their conversation; a conversation without rows is repaired to nothing at no
cost; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anchorline.llm.common import bound_batches

# C -> (nothing) | T | s T;  T -> T P | P;  P -> u a
SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 6, (3, "u"): 2, (5, "u"): 2}
REDUCE = {4: ("T", 1), 6: ("P", 2), 7: ("T", 2)}
GOTO = {(0, "P"): 4, (0, "T"): 3, (1, "P"): 4, (1, "T"): 5, (3, "P"): 7, (5, "P"): 7}
ACCEPT = {0, 3, 5}
INSERT_COST, REROLE_COST, DELETE_COST, TRUNCATED_COST = 3, 3, 4, 3
ROLES = {"u": "user", "a": "assistant"}
#: A stack that costs so much more than the best one can't win: two inserts and one deletion bring the best to where it can do the same.
BEYOND = 2 * INSERT_COST + DELETE_COST
LEGAL_PAIRS = {"su", "ua", "au"}

#: A stack is (state, stack below); equal ones are equal tuples that share their tails.
Stack = tuple[int, "Stack | None"]
#: Stacks with their costs above the best one, in the order of their audits.
Front = tuple[tuple[Stack, int], ...]
START: Front = (((0, None), 0),)


def shift(stack: Stack, initial: str) -> Stack | None:
    """The stack after a turn of this role, reduced; None if the grammar has no such turn here."""
    to = SHIFT.get((stack[0], initial))
    if to is None:
        return None
    stack = (to, stack)
    while stack[0] in REDUCE:
        name, length = REDUCE[stack[0]]
        for _ in range(length):
            stack = stack[1]
        stack = (GOTO[stack[0], name], stack)
    return stack


def _inserted(stack: Stack) -> Iterator[tuple[str, Stack]]:
    """Stacks after none, one or two inserted turns; more never pay."""
    yield "", stack
    for n in (1, 2):
        stack = next(s for s in (shift(stack, x) for x in "ua") if s)
        yield "I" * n, stack


class Parser:
    """What tokens (initial, must go, truncated) do to fronts; worked out once each."""

    def __init__(self) -> None:
        self.known: dict = {}

    def step(self, front: Front, token: tuple[str, bool, bool]) -> tuple[Front, int, list[tuple[int, str]]]:
        """The next front, the best stack's added cost, and for each new stack the old one's place and its edits."""
        made = self.known.get((front, token))
        if made is None:
            made = self.known[front, token] = self._step(front, token)
        return made

    def _step(self, front: Front, token: tuple[str, bool, bool]) -> tuple[Front, int, list[tuple[int, str]]]:
        initial, must_go, truncated = token
        best: dict[Stack, tuple[int, int, str]] = {}
        for place, (top, cost) in enumerate(front):
            for inserts, stack in _inserted(top):
                base = cost + INSERT_COST * len(inserts)
                ways = [("D", stack, DELETE_COST)]
                if not must_go:
                    stays = TRUNCATED_COST * truncated
                    ways += [("K", shift(stack, initial), stays), *(("R", shift(stack, x), REROLE_COST + stays) for x in ROLES)]
                for edit, to, more in ways:
                    if to is not None:
                        way = (base + more, place, inserts + edit)
                        best[to] = min(best.get(to, way), way)
        # Audits that end with a row's edit are never one the beginning of another, so old places and new edits order them.
        least = min(best.values())[0]
        ranked = sorted(((place, edits), cost - least, stack) for stack, (cost, place, edits) in best.items() if cost - least <= BEYOND)
        return tuple((stack, cost) for _, cost, stack in ranked), least, [way for way, _, _ in ranked]

    def end(self, front: Front) -> tuple[int, int, str]:
        """(added cost, place, inserts) of the cheapest complete parse."""
        return min((cost + INSERT_COST * len(i), place, i) for place, (top, cost) in enumerate(front) for i, stack in _inserted(top) if stack[0] in ACCEPT)


class _Conversation:
    """One conversation as its rows come in."""

    def __init__(self, parser: Parser):
        self.parser, self.front, self.cost = parser, START, 0
        self.ways: list[list[tuple[int, str]]] = []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.before = self.first = self.last = None

    def add(self, turn: int | None, initial: str, fault: str) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.turns == 0 else self.first
            self.last, self.turns = turn, self.turns + 1
        self.illegal += self.before is not None and self.before + initial not in LEGAL_PAIRS
        self.before = initial
        self.blank += fault == "b"
        self.duplicate += fault == "d"
        self.truncated += fault == "t"
        self.front, more, ways = self.parser.step(self.front, (initial if initial in "sua" and initial else "-", fault in "bd" and fault != "", fault == "t"))
        self.cost += more
        self.ways.append(ways)

    def result(self) -> tuple[int, int, int, int, int, int, str]:
        more, place, inserts = self.parser.end(self.front)
        edits = [inserts]
        for ways in reversed(self.ways):
            place, edit = ways[place]
            edits.append(edit)
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost + more, "".join(reversed(edits))


REPAIR_COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def _laid_out(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, present) of the rows, each conversation in one partition."""
    present = F.coalesce("present", F.lit(False)) if "present" in rows.columns else F.lit(True)
    space = lambda c: F.coalesce(F.col(c), F.lit(" "))
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"), present.alias("present"))


def fault(text: Column, seen: Column) -> Column:
    """A row's first fault: b(lank), d(uplicate), t(runcated) or empty."""
    return F.when(~text.rlike(r"[^\x20\x09-\x0D]"), "b").when(seen, "d").when(~text.rlike(r"[.!?][\x20\x09-\x0D]*\z"), "t").otherwise("")


def find_repairs(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) for every conversation of (conv_id, turn, role, text[, present])."""
    bound_batches(rows.sparkSession)
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    # A row counts as seen if it isn't the first of its kind; both sorts spill, and the exchange is one.
    kind = Window.partitionBy("conv_id", "present", "role", F.md5("text")).orderBy(F.col("turn").asc_nulls_first())
    base = _laid_out(rows).repartition("conv_id").withColumn("nth", F.row_number().over(kind))
    flat = base.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *order, "nth")
    small = flat.select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), fault(F.col("text"), F.col("nth") > 1).alias("fault"), "present")
    id_type = rows.schema["conv_id"].dataType
    types = ", ".join(f"{c} {'string' if c == 'audit' else 'long'}" for c in REPAIR_COLUMNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, now, key, done = Parser(), None, None, []

        def out() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True))
            kinds = [kind_of, *[pa.int64()] * 6, pa.string()]
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["conv_id", *REPAIR_COLUMNS])
            done.clear()
            return made

        for b in batches:
            kind_of = b.column(0).type
            for conv, turn, initial, wrong, there in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                if now is None or conv != key:
                    if now is not None:
                        done.append((key, *now.result()))
                        if len(done) >= 2000:
                            yield out()
                    now, key = _Conversation(parser), conv
                if there:
                    now.add(turn, initial, wrong)
        if now is not None:
            done.append((key, *now.result()))
            yield out()

    return small.mapInArrow(run, f"conv_id {id_type.simpleString()}, {types}")


def repaired_turns(rows: DataFrame, repairs: DataFrame) -> DataFrame:
    """(conv_id, position, role, text, edit): the repaired conversations, each in order in one partition; edit is K, R or I.

    ``repairs`` is the result of ``find_repairs`` for the same rows. A conversation's audit is
    sorted before its rows, so that a task needs one row at a time.
    """
    bound_batches(rows.sparkSession)
    audits = repairs.select("conv_id", F.lit(0).alias("part"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"))
    there = _laid_out(rows).where("present").select("conv_id", F.lit(1).alias("part"), "turn", "role", "text")
    dealt = audits.unionByName(there).repartition("conv_id")
    flat = dealt.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part", F.col("turn").asc_nulls_first(), "role", "text").select("conv_id", "part", "role", "text")
    id_type = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, position, stack, made = "", 0, 0, START[0][0], []

        def emit(conv: object, role: str, text: str, edit: str) -> None:
            nonlocal position
            made.append((conv, position, role, text, edit))
            position += 1

        def insert(conv: object) -> None:
            nonlocal at, stack
            while at < len(audit) and audit[at] == "I":
                initial = next(x for x in ROLES if shift(stack, x))
                stack, at = shift(stack, initial), at + 1
                emit(conv, ROLES[initial], "", "I")

        for b in batches:
            for conv, part, role, text in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if part == 0:
                    audit, at, position, stack = text, 0, 0, START[0][0]
                else:
                    edit, at = audit[at], at + 1
                    if edit != "D":
                        initial = role[:1] if edit == "K" else next(x for x in ROLES if shift(stack, x))
                        stack = shift(stack, initial)
                        emit(conv, role if edit == "K" else ROLES[initial], text, edit)
                insert(conv)
            if made:
                columns = list(zip(*made, strict=True))
                kinds = [b.column(0).type, pa.int64(), pa.string(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["conv_id", "position", "role", "text", "edit"])
                made.clear()

    return flat.mapInArrow(run, f"conv_id {id_type}, position long, role string, text string, edit string")


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, sha256): hex digests of ``role:text`` of each conversation's turns, joined by newlines.

    ``turns`` come as ``repaired_turns`` gives them; digests take one row at a time.
    """
    import hashlib

    id_type = turns.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, key, done, kind_of = None, None, [], None

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], kind_of), pa.array([x[1] for x in done], pa.string())], ["conv_id", "sha256"])
            done.clear()
            return made

        for b in batches:
            kind_of = b.column(0).type
            for conv, position, role, text in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if position == 0:
                    if h is not None:
                        done.append((key, h.hexdigest()))
                    h, key = hashlib.sha256(), conv
                else:
                    h.update(b"\n")
                h.update(f"{role}:{text}".encode())
            if len(done) >= 2000:
                yield out()
        if h is not None:
            done.append((key, h.hexdigest()))
            yield out()

    return turns.select("conv_id", "position", "role", "text").mapInArrow(run, f"conv_id {id_type}, sha256 string")
