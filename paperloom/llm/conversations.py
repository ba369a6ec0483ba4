"""Repair of conversation structure by an auction for shortest paths.

The turns of a conversation, in order, and the states of the role grammar ``(s?(ua)+)?`` span a lattice:
its arcs are the edits Keep (cost 0), Rerole (1), Delete (2) and Insert (5), a truncated turn that is not
deleted adds 5, and a blank or repeated turn can only be deleted. The cheapest path is found by the
auction algorithm: nodes have prices that never exceed the price of a successor plus the arc; the path
from the start is extended along the arc that holds with equality, the least label first, and where there is none the
price of its last node is raised and the path contracts by one arc. Prices start at the sums of the cheapest
edits of the turns that follow, and all numbers are integers. When the path reaches the end, every arc
of every cheapest path holds with equality, so the path taken is the least of them by its labels.

Turns are sorted by range partitioning, so one conversation may lie in many tasks. One that lies inside a
task and has at most ``LIMIT`` turns is repaired there. All others are cut into blocks of ``BLOCK`` turns: for
each pair of entry and exit state an auction gives a block's cost, and the order of its exits by their labels;
blocks of blocks do the same until one is left (a lattice over at most ``BLOCK`` children each time), and
the states found at the top go back down to the turns. Every step is an aggregate or join over blocks.

Defined results: a null role or text is one space; turns are ordered by number (nulls first), then role, then
text; equal rows are repeats of the first; a null conversation id is a conversation of its own; one
without turns has zeros and an empty audit; texts may have any length; an empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from ..session import materialize
from .common import columns_function, text_function

BLOCK = 256
LIMIT = 4096
SPACES = " \t\n\x0b\x0c\r"
ENDS = ".!?"
STATES = range(4)  # nothing yet, after s, after u, after a
WANTED = ((2, "user"), (2, "user"), (3, "assistant"), (2, "user"))  # by state: the next one, and the role that leads there
KEPT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("a", 2): 3, ("u", 3): 2}
LEGAL = {"su", "ua", "au"}
DELETE, INSERT, REROLE, CUT = 2, 5, 1, 5  # costs
FORCED, END = "-", "$"
NEVER = float("inf")

Arc = tuple  # label, step, state, cost


def turn_arcs(sign: str) -> list[list[Arc]]:
    """The arcs of one turn for each state, by label. ``sign`` is the initial of the role, in upper
    case for a truncated turn; or that the turn must go; or the end of the conversation."""
    out = []
    for state in STATES:
        follower = WANTED[state][0]
        if sign == END:
            out.append([("", 1, 3, 0)] if state in (0, 3) else [("I", 0, follower, INSERT)])
            continue
        arcs = [("D", 1, state, DELETE), ("I", 0, follower, INSERT)]
        if sign != FORCED:
            extra = CUT if sign.isupper() else 0
            kept = KEPT.get((sign.lower(), state))
            if kept is not None:
                arcs.append(("K", 1, kept, extra))
            arcs.append(("R", 1, follower, REROLE + extra))
        out.append(arcs)
    return out


TURNS = {sign: turn_arcs(sign) for sign in "suaxSUAX" + FORCED + END}


def reaches(layers: list[list[list[Arc]]], entry: int, exit: int) -> bool:
    states = {entry}
    for arcs in layers:
        todo, after = list(states), set()
        while todo:
            for _, step, state, _ in arcs[todo.pop()]:
                if step:
                    after.add(state)
                elif state not in states:
                    states.add(state)
                    todo.append(state)
        states = after
    return exit in states


def auction(layers: list[list[list[Arc]]], entry: int, exit: int) -> tuple[int, list[tuple[int, int, object]]] | None:
    """Cost and least path (layer, state, label of the arc taken) from ``entry`` to ``exit``, if there is one."""
    if not reaches(layers, entry, exit):
        return None
    n, floor = len(layers), 0
    prices = [[NEVER] * 4 for _ in range(n + 1)]
    prices[n][exit] = 0
    for layer in range(n - 1, -1, -1):
        floor += min(cost for arcs in layers[layer] for _, step, _, cost in arcs if step)
        prices[layer] = [floor] * 4
    path: list[tuple[int, int, object]] = []
    layer, state = 0, entry
    while layer < n or state != exit:
        best, chosen = NEVER, None
        if layer < n:
            for arc in layers[layer][state]:
                price = arc[3] + prices[layer + arc[1]][arc[2]]
                if price < best:
                    best, chosen = price, arc
        if prices[layer][state] < best:  # contraction
            prices[layer][state] = best
            if path:
                layer, state, _ = path.pop()
        elif chosen is None:
            layer, state, _ = path.pop()
        else:  # extension
            path.append((layer, state, chosen[0]))
            layer, state = layer + chosen[1], chosen[2]
    return prices[0][entry], path


@lru_cache(100_000)
def repaired(signs: str, entry: int = 0, exit: int = 3) -> tuple[str, int]:
    """The edits of turns given by their signs, and their cost."""
    cost, path = auction([TURNS[s] for s in signs], entry, exit)
    return "".join(label for *_, label in path), cost


def matrix_of(layers: list[list[list[Arc]]]) -> list[int]:
    """For each entry and exit the cost (-1: none), then the rank of the exit among those of the entry by labels."""
    costs, ranks = [-1] * 16, [-1] * 16
    for entry in STATES:
        found = []
        for exit in STATES:
            done = auction(layers, entry, exit)
            if done:
                costs[4 * entry + exit] = done[0]
                found.append(([label for *_, label in done[1]], exit))
        for rank, (_, exit) in enumerate(sorted(found)):
            ranks[4 * entry + exit] = rank
    return costs + ranks


@lru_cache(10_000)
def block_arcs(matrix: tuple[int, ...]) -> list[list[Arc]]:
    return [sorted((matrix[16 + 4 * q + x], 1, x, matrix[4 * q + x]) for x in STATES if matrix[4 * q + x] >= 0) for q in STATES]


@lru_cache(100_000)
def signs_matrix(signs: str) -> list[int]:
    return matrix_of([TURNS[s] for s in signs])


def route(children: list[list[int]], entry: int, exit: int) -> list[dict]:
    """Entry and exit of each child on the least of the cheapest paths."""
    _, path = auction([block_arcs(tuple(m)) for m in children], entry, exit)
    states = [state for _, state, _ in path] + [exit]
    return [{"entry": a, "exit": b} for a, b in zip(states, states[1:])]


def edited(turns: list[tuple[str, str]], audit: str, state: int = 0) -> list[tuple[str, str]]:
    """The turns (role, text) after the edits."""
    out, rest = [], iter(turns)
    for label in audit:
        role, text = ("", "") if label == "I" else next(rest)
        if label == "D":
            continue
        if label == "K":
            state = KEPT[role[:1], state]
        else:
            state, role = WANTED[state]
        out.append((role, text))
    return out


def sign_of(role: str, last: str) -> str:
    initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return initial if last in ENDS else initial.upper()


class Conversation:
    """The turns of one conversation that lies inside a task."""

    def __init__(self) -> None:
        self.turns: list[tuple[int | None, str, str]] = []

    def report(self) -> dict:
        signs, seen, counts = [], set(), {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in self.turns:
            bare = text.rstrip(SPACES)
            key = (role, text)
            if not bare:
                fault, sign = "blank", FORCED
            elif key in seen:
                fault, sign = "duplicate", FORCED
            else:
                sign = sign_of(role, bare[-1])
                fault = "truncated" if sign.isupper() else None
            seen.add(key)
            signs.append(sign)
            if fault:
                counts[fault] += 1
        audit, cost = repaired("".join(signs) + END)
        initials = [role[:1] for _, role, _ in self.turns]
        numbers = {t for t, *_ in self.turns if t is not None}
        turns = edited([t[1:] for t in self.turns], audit)
        return {**counts, "gaps": max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
                "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
                "cost": cost, "audit": audit, "turns": [{"role": r, "text": t} for r, t in turns]}


TURN = StructType([StructField("role", StringType()), StructField("text", StringType())])
REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _sorted_pass(rows: DataFrame, limit: int) -> DataFrame:
    """Reports of conversations inside a task, and the turns (``part``) of those at its borders or too long."""
    schema = StructType([StructField("conv", rows.schema["conv"].dataType), StructField("part", BooleanType()),
                         *[StructField(x, LongType()) for x in REPORT], StructField("audit", StringType()),
                         StructField("turns", ArrayType(TURN)), StructField("task", IntegerType()), StructField("seq", LongType()),
                         StructField("turn", LongType()), StructField("role", StringType()), StructField("text", StringType()),
                         StructField("is_blank", BooleanType()), StructField("sign", StringType()), StructField("key", BinaryType())])
    kinds = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        done: list[dict] = []
        conv, turns, begun, whole, seq = None, [], False, False, 0

        def parts(at: int) -> int:
            """Hand out the turns held so far one by one."""
            for turn, role, text in turns:
                bare = text.rstrip(SPACES)
                key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
                done.append({"conv": conv, "part": True, "task": task, "seq": at, "turn": turn, "role": role, "text": text,
                             "is_blank": not bare, "sign": sign_of(role, bare[-1]) if bare else FORCED, "key": key})
                at += 1
            turns.clear()
            return at

        def finish(inside: bool) -> None:
            if inside and not seq:
                one = Conversation()
                one.turns = turns
                done.append({"conv": conv, "part": False, **one.report()})
                turns.clear()
            elif not parts(seq):
                done.append({"conv": conv, "part": True})  # no turn here: the name alone

        for batch in batches:
            for name, turn, role, text, present in zip(*(c.to_pylist() for c in batch.columns)):
                if not begun or name != conv:
                    if begun:
                        finish(whole)
                        whole = True
                    conv, begun, seq = name, True, 0
                if present:
                    turns.append((turn, role, text))
                    if len(turns) > limit:
                        seq = parts(seq)
                if len(done) >= 500:
                    yield pa.RecordBatch.from_pylist(done, schema=kinds)
                    done = []
        if begun:
            finish(False)
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=kinds)

    ordered = rows.repartitionByRange("conv", "turn", "role", F.substring("text", 1, 64))
    return ordered.sortWithinPartitions("conv", "turn", "role", "text").mapInArrow(run, schema)


MATRIX = "array<int>"
STEP = pa.struct([("entry", pa.int32()), ("exit", pa.int32())])
EDITS = pa.struct([("audit", pa.string()), ("cost", pa.int64())])


def _block_edits(blocks: DataFrame, size: int) -> DataFrame:
    """``conv_key, block, entry, audit, cost`` of blocks given by ``conv_key, block, signs``."""
    of_signs = text_function(lambda signs: [signs_matrix(s) for s in signs], MATRIX, pa.list_(pa.int32()))
    of_children = text_function(lambda all_: [matrix_of([block_arcs(tuple(m)) for m in c]) for c in all_], MATRIX, pa.list_(pa.int32()))
    levels = [blocks]
    current = materialize(blocks.select("conv_key", "block", of_signs("signs").alias("matrix")), "block-costs")
    while (current.agg(F.max("block")).first()[0] or 0) > 0:
        upper = current.groupBy("conv_key", F.floor(F.col("block") / size).alias("block")).agg(
            F.sort_array(F.collect_list(F.struct("block", "matrix")))["matrix"].alias("children"))
        levels.append(materialize(upper, "block-children"))
        current = materialize(levels[-1].select("conv_key", "block", of_children("children").alias("matrix")), "block-costs")
    down = levels[-1].withColumn("entry", F.lit(0)).withColumn("exit", F.lit(3))
    steps = columns_function(lambda c, a, b: [route(*x) for x in zip(c, a, b)], "array<struct<entry:int,exit:int>>", pa.list_(STEP))
    for lower in reversed(levels[:-1]):
        children = down.select("conv_key", "block", F.posexplode(steps("children", "entry", "exit")).alias("nr", "step"))
        children = children.select("conv_key", (F.col("block") * size + F.col("nr")).alias("block"), "step.*")
        down = lower.join(children.hint("merge"), ["conv_key", "block"])
    edits = columns_function(lambda s, a, b: [dict(zip(("audit", "cost"), repaired(*x))) for x in zip(s, a, b)],
                             "struct<audit:string,cost:long>", EDITS)
    return down.select("conv_key", "block", "entry", edits("signs", "entry", "exit").alias("e")).select(
        "conv_key", "block", "entry", "e.audit", "e.cost")


def _in_blocks(parts: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Reports and repaired blocks of conversations whose turns lie in several tasks or are too many for one."""
    parts = parts.withColumn("conv_key", F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit("")))
    names = parts.groupBy("conv_key").agg(F.max("conv").alias("conv"))
    turns = parts.where(F.col("seq").isNotNull())
    earlier = Window.partitionBy("conv_key").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # a row per task
    before = turns.groupBy("conv_key", "task").agg(F.count("*").alias("n"))
    before = before.select("conv_key", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    placed = turns.join(before.hint("merge"), ["conv_key", "task"]).withColumn("pos", F.col("before") + F.col("seq"))
    placed = materialize(placed.withColumn("block", F.floor(F.col("pos") / size)), "placed-turns")
    firsts = placed.groupBy("conv_key", "key").agg(F.min("pos").alias("pos")).select("conv_key", "pos", F.lit(True).alias("first"))
    narrow = placed.select("conv_key", "pos", "block", "turn", "is_blank", "sign", F.substring("role", 1, 1).alias("initial"))
    following = narrow.select("conv_key", (F.col("pos") - 1).alias("pos"), F.col("initial").alias("next"))
    marked = narrow.join(firsts, ["conv_key", "pos"], "left").join(following, ["conv_key", "pos"], "left")
    again = ~F.col("is_blank") & F.col("first").isNull()
    marked = materialize(marked.select(
        "conv_key", "pos", "block", "turn", "is_blank", again.alias("again"), F.when(again, FORCED).otherwise(F.col("sign")).alias("sign"),
        F.col("next").isNull().alias("last"), (~F.concat("initial", "next").isin(*LEGAL)).alias("illegal")), "marked-turns")

    def number(condition: Column, name: str) -> Column:
        return F.count_if(condition).alias(name)

    distinct = marked.groupBy("conv_key", "turn").agg(
        number(F.col("is_blank"), "blank"), number(F.col("again"), "duplicate"),
        number(F.col("sign") != F.lower("sign"), "truncated"), number(F.col("illegal"), "illegal"))
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps")
    counts = distinct.groupBy("conv_key").agg(gaps, *[F.sum(x).alias(x) for x in ("blank", "duplicate", "truncated", "illegal")])

    spelled = F.array_join(F.sort_array(F.collect_list(F.struct("pos", "sign")))["sign"], "")
    blocks = marked.groupBy("conv_key", "block").agg(spelled.alias("signs"), F.max("last").alias("last"))
    blocks = materialize(blocks.select("conv_key", "block", F.concat("signs", F.when(F.col("last"), END).otherwise("")).alias("signs")), "blocks")
    edits = materialize(_block_edits(blocks, size), "block-edits")
    audits = edits.groupBy("conv_key").agg(F.sum("cost").alias("cost"), F.array_join(
        F.sort_array(F.collect_list(F.struct("block", "audit")))["audit"], "").alias("audit"))
    report = names.join(counts, "conv_key", "left").join(audits, "conv_key", "left").fillna(0, REPORT).fillna("", ["audit"])

    held = placed.groupBy("conv_key", "block").agg(F.sort_array(F.collect_list(F.struct("pos", "role", "text"))).alias("held"))
    apply = columns_function(
        lambda h, a, s: [[dict(zip(("role", "text"), t)) for t in edited([(x["role"], x["text"]) for x in rows], audit, state)]
                         for rows, audit, state in zip(h, a, s)],
        "array<struct<role:string,text:string>>", pa.list_(to_arrow_type(TURN)), 16)
    fixed = held.join(edits.hint("merge"), ["conv_key", "block"]).select("conv_key", "block", apply("held", "audit", "entry").alias("turns"))
    return report, fixed.join(names.hint("merge"), "conv_key").select("conv", "conv_key", "block", "turns")


def repair(conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           present: Column | None = None, limit: int = LIMIT, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Reports (``conv``, counts of faults, ``cost``, ``audit``) and repaired turns (``conv, conv_key, block, turns``).

    A row for which ``present`` does not hold names its conversation and is no turn. ``block`` is null for a conversation in one piece.
    """
    named = {"conv": F.col(f"`{conv_col}`"), "turn": F.col(f"`{turn_col}`").cast("long")}
    words = {name: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for name, c in (("role", role_col), ("text", text_col))}
    there = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    rows = conversations.select(*[c.alias(n) for n, c in {**named, **words}.items()], there.alias("present"))
    table = materialize(_sorted_pass(rows, limit), "conversations")
    inside = table.where(~F.col("part"))
    report, blocks = _in_blocks(table.where("part").drop(*REPORT, "audit", "turns"), block)
    report = inside.select("conv", *REPORT, "audit").unionByName(report.select("conv", *REPORT, "audit"))
    whole = inside.select("conv", F.lit(None).cast("string").alias("conv_key"), F.lit(None).cast("long").alias("block"), "turns")
    return report, whole.unionByName(blocks)


def digests(turns: DataFrame) -> DataFrame:
    """``conv, repaired_sha256`` of conversations with a turn left or in one piece: lines ``role:text``, newline-joined.

    SHA-256 is sequential, so the blocks of one conversation stream through one task, a block at a time.
    """
    line = F.transform("turns", lambda t: F.concat_ws(":", t["role"], t["text"]))
    whole = turns.where(F.col("block").isNull()).select("conv", F.sha2(F.array_join(line, "\n"), 256).alias("repaired_sha256"))
    schema = StructType([StructField("conv", turns.schema["conv"].dataType), StructField("repaired_sha256", StringType())])
    kinds = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, key, state, lines = None, None, None, 0

        def finished() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"conv": conv, "repaired_sha256": state.hexdigest()}], schema=kinds)

        for batch in batches:
            for row in range(batch.num_rows):
                name = batch.column(1)[row].as_py()
                if state is None or name != key:
                    if state is not None:
                        yield finished()
                    conv, key, state, lines = batch.column(0)[row].as_py(), name, hashlib.sha256(), 0
                for turn in batch.column(2)[row].as_py():
                    state.update((("\n" if lines else "") + turn["role"] + ":" + turn["text"]).encode())
                    lines += 1
        if state is not None:
            yield finished()

    split = turns.where(F.col("block").isNotNull()).repartition("conv_key").sortWithinPartitions("conv_key", "block")
    return whole.unionByName(split.select("conv", "conv_key", "turns").mapInArrow(run, schema))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` with the faults that a checksum of conversation and turn chooses; ``there`` is false for a dropped one."""
    def known(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.pmod(F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")), F.lit(20))
    rows = conversations.select("conv_id", "turn", known("role").alias("role"), known("text").alias("text"), fault.alias("fault"))
    copies = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), (F.col("fault") != 0).alias("there"), F.explode(copies).alias("copy"))
