"""Repair of conversations by depth-first branch-and-bound.

A conversation's turns are sound if their roles' initials read ``(s?(ua)+)?``: nothing, or user and
assistant in turn, after a system turn if there is one. Turns may be kept, given another role, or
deleted, and empty ones inserted; the cheapest edits are sought, and of equally cheap ones those
whose initials (K, R, D, I, in order) come first in ASCII.

Two sorted streams do it. The first holds the turns without their texts (faults, role initial, a
digest) and plans the edits of one conversation after the other. The second merges these plans with
the turns, a plan before its turns, and puts out the repaired turns as they pass. Texts are never
gathered; a task keeps a digest and some numbers a turn of one conversation, however long it is. One
conversation is one sequence, so it is not cut over tasks; nothing else is tied to a key.

The search is exact. Its stack is a list, so its depth has no limit. A node is (turns done, last
role): the suffix bound says what the rest of the turns costs at least from there, with roles and
faults taken into account and audits left out. Children are tried by bound and then by letter. The
incumbent is the best whole repair so far as (cost, audit). A prefix is dropped if its bound is not
below the incumbent's cost (at equal cost its audit comes later), or if the dominance table says that
a better prefix has reached the same node. The empty stack proves the incumbent.

Defined results: null roles and texts are one space; a null turn sorts first; turns with the same
number go by role, then digest of the text, so that repeats are adjacent. A null ``conv_id`` is a
conversation like others. A conversation without turns has zeros and an empty audit. Roles other
than s…, u…, a… are illegal where they stand and need an edit. Extra columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemill.llm.common import SPACES, Batches
from tastemill.staging import stage_table

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
#: What an edit costs, and what a truncated turn that is not deleted adds (fixed values of the task).
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED_COST = 3
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
#: Last role so far: none, system, user, assistant; and the roles that may follow.
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
ENDS = (START, ASSISTANT)
LEGAL_PAIRS = ("su", "ua", "au")
NAMES = {USER: "user", ASSISTANT: "assistant"}
FAR = 1 << 60

PLAN = "conv_id {id}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def _moves(fault: int, initial: str, state: int) -> list[tuple[str, int, int]]:
    """``(letter, cost, state after)`` of the edits of one turn, in ASCII order."""
    found = [(DELETE, COST[DELETE], state)]
    if fault not in (BLANK, DUPLICATE):
        extra = TRUNCATED_COST if fault == TRUNCATED else 0
        after = FOLLOWS[state].get(initial)
        if after is not None:
            found.append((KEEP, COST[KEEP] + extra, after))
        found += [(REROLE, COST[REROLE] + extra, to) for to in FOLLOWS[state].values() if to in NAMES]
    return found


def _inserted(state: int) -> int:
    """The role an inserted turn has: the only one of user and assistant that may follow."""
    return next(to for to in FOLLOWS[state].values() if to in NAMES)


def suffix_bounds(faults: bytes, initials: str) -> list[list[int]]:
    """``bounds[i][state]``: a lower bound of what the turns from ``i`` on cost after ``state``."""
    known: dict[tuple[int, str], list[list[tuple[str, int, int]]]] = {}
    last = [0 if state in ENDS else FAR for state in range(4)]

    def with_inserts(row: list[int]) -> list[int]:
        for _ in range(3):
            row = [min(row[s], COST[INSERT] + row[_inserted(s)]) for s in range(4)]
        return row

    bounds = [with_inserts(last)]
    for fault, initial in zip(reversed(faults), reversed(initials)):
        if (fault, initial) not in known:
            known[fault, initial] = [_moves(fault, initial, s) for s in range(4)]
        after = bounds[-1]
        bounds.append(with_inserts([min(cost + after[to] for _, cost, to in moves) for moves in known[fault, initial]]))
    bounds.reverse()
    return bounds


def cheapest_edits(faults: bytes, initials: str) -> tuple[int, str]:
    """``(cost, audit)`` of the cheapest repair of one conversation, ties to the least audit.

    >>> cheapest_edits(bytes([SOUND, SOUND, SOUND]), "uau")
    (3, 'KKIK')
    """
    bounds, n = suffix_bounds(faults, initials), len(faults)
    incumbent: tuple[int, str] | None = None
    # The least cost with which a node was reached. Equal costs are reached in the order of their audits: children leave
    # the stack by letter, and of two prefixes with equal cost and turns neither is the start of the other.
    dominance: dict[tuple[int, int], int] = {}
    # Prefixes are chains of (letter, chain before).
    stack: list[tuple[int, int, int, tuple | None]] = [(0, START, 0, None)]
    while stack:
        i, state, cost, chain = stack.pop()
        bound = cost + bounds[i][state]
        if bound >= FAR or (incumbent is not None and bound >= incumbent[0]):
            continue
        if dominance.get((i, state), FAR) <= cost:
            continue
        dominance[i, state] = cost
        if i == n and state in ENDS:
            incumbent = (cost, _letters(chain))
            continue
        children = [(INSERT, COST[INSERT], i, _inserted(state))]
        if i < n:
            children += [(letter, more, i + 1, to) for letter, more, to in _moves(faults[i], initials[i], state)]
        children.sort(key=lambda c: (c[1] + bounds[c[2]][c[3]], c[0]), reverse=True)
        stack += [(j, to, cost + more, (letter, chain)) for letter, more, j, to in children]
    assert incumbent is not None  # deleting all turns always is a repair
    return incumbent


def _letters(chain: tuple | None) -> str:
    found = []
    while chain is not None:
        found.append(chain[0])
        chain = chain[1]
    return "".join(reversed(found))


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with one space for a null role or text."""
    filled = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    return conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"), *filled)


def _digest(*columns: str) -> Column:
    """Roles may hold any character, so their length goes first."""
    return F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), *columns), 256))


def _ordered(rows: DataFrame) -> DataFrame:
    """Each conversation in one task, in order; kind 0 goes before its turns."""
    order = [F.asc_nulls_first(c) for c in ("conv_id", "kind", "turn", "role", "digest")]
    return rows.repartition("conv_id").sortWithinPartitions(*order)


def _runs(ids: list) -> Iterator[tuple[object, int, int]]:
    """Stretches of equal neighbours."""
    start = 0
    for k in range(1, len(ids) + 1):
        if k == len(ids) or ids[k] != ids[start]:
            yield ids[start], start, k
            start = k


def _judged(faults: list[int], first: list[bool], initials: list[str], numbers: list[int]) -> tuple:
    """A conversation's report from what its turns show; ``first`` says whether role and text are new."""
    judged = bytes(f if f == BLANK or new else DUPLICATE for f, new in zip(faults, first))
    marks = [x or "-" for x in initials]
    illegal = sum(a + b not in LEGAL_PAIRS for a, b in zip(marks, marks[1:]))
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    return gaps, *(judged.count(kind) for kind in (BLANK, DUPLICATE, TRUNCATED)), illegal, *cheapest_edits(judged, "".join(marks))


def _in_lists(rows: list[tuple]) -> tuple:
    """The report of (kind, turn, digest, fault, initial) of few turns."""
    own = [r for r in rows if r[0] == 1]
    seen: set[bytes] = set()
    new = [not (r[2] in seen or seen.add(r[2])) for r in own]
    return _judged([r[3] for r in own], new, [r[4] for r in own], [r[1] for r in own if r[1] is not None])


def _in_columns(parts: list[pa.RecordBatch]) -> tuple:
    """The same of many: digests stay in Arrow until they are numbers."""
    table = pa.Table.from_batches(parts)
    table = table.filter(pc.equal(table["kind"], 1)).combine_chunks()
    if not table.num_rows:
        return _judged([], [], [], [])
    codes = table["digest"].chunk(0).dictionary_encode().indices.to_numpy()
    first = np.zeros(len(codes), dtype=bool)
    first[np.unique(codes, return_index=True)[1]] = True
    return _judged(table["fault"].to_pylist(), first.tolist(), table["initial"].to_pylist(), table["turn"].drop_null().to_pylist())


def _plans(batches: Batches) -> Batches:
    """A row for each conversation of a stream in order."""
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    current, held, id_type = None, [], pa.null()

    def rows(found: list[tuple]) -> pa.RecordBatch:
        types = [id_type, *[pa.int64()] * 6, pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], t) for k, t in enumerate(types)], names)

    for batch in batches:
        id_type, found = batch.column("conv_id").type, []
        ids = batch.column("conv_id").to_pylist()
        columns = [batch.column(c).to_pylist() for c in ("kind", "turn", "digest", "fault", "initial")]
        turns_ = list(zip(*columns))
        for conv_id, start, stop in _runs(ids):
            if held and conv_id != current:
                found.append((current, *_in_columns(held)))
                held = []
            if stop < len(ids) and not held:
                found.append((conv_id, *_in_lists(turns_[start:stop])))
                continue
            # It may go on in the next batch, or has begun in the one before.
            current = conv_id
            held.append(batch.slice(start, stop - start))
        yield rows(found)
    if held:
        yield rows([(current, *_in_columns(held))])


def plan_repairs(conversations: DataFrame, reported: DataFrame | None = None) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`` of every conversation.

    ``gaps``: turn numbers that are missing between the first and the last. A turn is blank (white
    space only), else a duplicate (role and text were there before), else truncated (it does not end
    in . ! or ?). ``illegal``: neighbours whose roles may not follow each other. ``reported`` names,
    by its ``conv_id``, conversations that get a row even if they have no turns.
    """
    text = F.rtrim("text", F.lit(SPACES))
    fault = F.when(F.length(text) == 0, BLANK).when(~F.right(text, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(SOUND)
    light = turns(conversations).select(
        "conv_id",
        F.lit(1).alias("kind"),
        "turn",
        "role",
        _digest("role", "text").alias("digest"),
        fault.alias("fault"),
        F.substring("role", 1, 1).alias("initial"),
    )
    if reported is not None:
        names = reported.select("conv_id").distinct()
        light = light.unionByName(names.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    id_type = conversations.schema["conv_id"].dataType.simpleString()
    return _ordered(light).mapInArrow(_plans, PLAN.format(id=id_type))


def _edits(batches: Batches) -> Iterator[tuple[object, int, str, str | None]]:
    """``(conv_id, kind, role, text)`` of repaired turns (kind 1), each conversation opened by a row of kind 0."""
    audit: Iterator[str] = iter(())
    current, state = None, START

    def inserted(letter: str | None) -> Iterator[str]:
        """Roles inserted up to the next letter that needs a turn."""
        nonlocal state, pending
        while letter == INSERT:
            state = _inserted(state)
            yield NAMES[state]
            letter = next(audit, None)
        pending = letter

    pending: str | None = None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "kind", "audit", "role", "text")]
        for conv_id, kind, plan, role, text in zip(*columns):
            if kind == 0:
                audit, current, state = iter(plan), conv_id, START
                yield current, 0, "", None
                for name in inserted(next(audit, None)):
                    yield current, 1, name, ""
                continue
            letter = pending
            if letter == KEEP:
                state = FOLLOWS[state][role[:1]]
                yield current, 1, role, text
            elif letter == REROLE:
                state = _inserted(state)
                yield current, 1, NAMES[state], text
            for name in inserted(next(audit, None)):
                yield current, 1, name, ""


def _with_plans(conversations: DataFrame, plans: DataFrame) -> DataFrame:
    rows = turns(conversations).select("conv_id", F.lit(1).alias("kind"), "turn", "role", _digest("role", "text").alias("digest"), "text")
    heads = plans.select("conv_id", F.lit(0).alias("kind"), "audit")
    return _ordered(rows.unionByName(heads, allowMissingColumns=True)).select("conv_id", "kind", "audit", "role", "text")


def _streamed(conversations: DataFrame, plans: DataFrame, run: Callable[[Batches], Batches], schema: str) -> DataFrame:
    id_type = conversations.schema["conv_id"].dataType.simpleString()
    return _with_plans(conversations, plans).mapInArrow(run, f"conv_id {id_type}, {schema}")


def repaired_turns(conversations: DataFrame, plans: DataFrame) -> DataFrame:
    """``conv_id, position, role, text`` of the repaired conversations; positions count from 0."""
    id_type = conversations.schema["conv_id"].dataType
    arrow = pa.int64() if id_type.simpleString() == "bigint" else pa.int32() if id_type.simpleString() == "int" else pa.string()

    def run(batches: Batches) -> Batches:
        out, size, position = [], 0, 0
        for conv_id, kind, role, text in _edits(batches):
            position = position + 1 if kind else -1
            if kind:
                out.append((conv_id, position, role, text))
                size += len(text) + 100
            if size > 4_000_000:
                yield _batch(out, arrow)
                out, size = [], 0
        yield _batch(out, arrow)

    def _batch(rows: list[tuple], type_: pa.DataType) -> pa.RecordBatch:
        names, types = ("conv_id", "position", "role", "text"), (type_, pa.int64(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)

    return _streamed(conversations, plans, run, "position bigint, role string, text string")


def repaired_digests(conversations: DataFrame, plans: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256``: of ``role:text`` of the repaired turns, joined by line feeds, hashed as they pass."""
    id_type = conversations.schema["conv_id"].dataType.simpleString()
    arrow = {"bigint": pa.int64(), "int": pa.int32()}.get(id_type, pa.string())

    def run(batches: Batches) -> Batches:
        ids, found = [], []
        own, empty = None, True
        for conv_id, kind, role, text in _edits(batches):
            if kind == 0:
                if own is not None:
                    found.append(own.hexdigest())
                ids.append(conv_id)
                own, empty = hashlib.sha256(), True
                if len(ids) > 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(ids[:-1], arrow), pa.array(found, pa.string())], ["conv_id", "repaired_sha256"])
                    ids, found = ids[-1:], []
            else:
                own.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
                empty = False
        if own is not None:
            found.append(own.hexdigest())
        yield pa.RecordBatch.from_arrays([pa.array(ids, arrow), pa.array(found, pa.string())], ["conv_id", "repaired_sha256"])

    return _streamed(conversations, plans, run, "repaired_sha256 string")


def repair(conversations: DataFrame, reported: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Plans of all conversations (written once) and the repaired turns."""
    plans = stage_table("plans", plan_repairs(conversations, reported))
    return plans, repaired_turns(conversations, plans)
