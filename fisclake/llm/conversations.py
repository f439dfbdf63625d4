"""Conversation repair: a generalised LR parser over the grammar of roles that may also delete, rerole and insert turns."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fisclake.llm.shared import stored

#: A conversation is empty or pairs of user and assistant, behind a system turn or not. Symbols in lower case are turns.
GRAMMAR = (("C", ""), ("C", "B"), ("C", "sB"), ("B", "ua"), ("B", "Bua"))
TURNS = {"s": "system", "u": "user", "a": "assistant"}
#: What a turn may be made into, and what edits cost.
REROLED = "ua"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Turns of a conversation that are parsed together. Longer conversations are parsed in such pieces, from every stack top each.
PIECE = 1024
SPACES = " \t\n\x0b\x0c\r"
LEGAL = ("su", "ua", "au")

Top = tuple[int, str]
Stack = tuple


def closed(items: frozenset[tuple[int, int]]) -> frozenset[tuple[int, int]]:
    """Items (rule, dot) and those of every symbol that can stand behind a dot."""
    found, todo = set(items), list(items)
    while todo:
        rule, dot = todo.pop()
        after = GRAMMAR[rule][1][dot : dot + 1]
        for n, (left, _) in enumerate(GRAMMAR):
            if left == after and (n, 0) not in found:
                found.add((n, 0))
                todo.append((n, 0))
    return frozenset(found)


@cache
def automaton() -> tuple[list[dict[str, int]], list[int | None], list[bool], list[Stack]]:
    """Of each state: where symbols lead, the rule to reduce by as soon as it is reached, whether a conversation may end there, and a
    stack with it on top.

    Rules of C are only reduced at the end. Stacks with the same top take the same turns from there on, whatever lies below: merging
    them loses nothing (a test compares with all edits).
    """
    start = closed(frozenset((n, 0) for n, (left, _) in enumerate(GRAMMAR) if left == "C"))
    states, moves, stacks = [start], [], [(0, None)]
    for number, state in enumerate(states):  # grows
        moves.append({})
        for symbol in sorted({GRAMMAR[r][1][d] for r, d in state if d < len(GRAMMAR[r][1])}):
            target = closed(frozenset((r, d + 1) for r, d in state if GRAMMAR[r][1][d : d + 1] == symbol))
            if target not in states:
                states.append(target)
                stacks.append((len(stacks), stacks[number]))
            moves[number][symbol] = states.index(target)
    whole = [[r for r, d in s if d == len(GRAMMAR[r][1])] for s in states]
    return moves, [next((r for r in w if GRAMMAR[r][0] != "C"), None) for w in whole], [any(GRAMMAR[r][0] == "C" for r in w) for w in whole], stacks


def shifted(stack: Stack, symbol: str) -> Stack | None:
    """``stack`` with ``symbol`` on it, reduced; None where it can't follow."""
    moves, reduce, _, _ = automaton()
    target = moves[stack[0]].get(symbol)
    if target is None:
        return None
    stack = (target, stack)
    while (rule := reduce[stack[0]]) is not None:
        left, right = GRAMMAR[rule]
        for _ in right:
            stack = stack[1]
        stack = (moves[stack[0]][left], stack)
    return stack


class Tops:
    """The tops of the graph-structured stack: of each state the cheapest way there, of equal ones the one with the least audit. Tails are shared."""

    def __init__(self) -> None:
        self.best: dict[int, tuple[int, str, Stack]] = {}

    def add(self, cost: int, audit: str, stack: Stack | None) -> bool:
        if stack is None:
            return False
        known = self.best.get(stack[0])
        if known is not None and (known[0], known[1]) <= (cost, audit):
            return False
        self.best[stack[0]] = (cost, audit, stack)
        return True

    def insert(self) -> None:
        """Adds what inserted turns lead to."""
        todo = sorted(self.best)
        while todo:
            cost, audit, stack = self.best[todo.pop()]
            for symbol in REROLED:
                target = shifted(stack, symbol)
                if self.add(cost + INSERT, audit + "I", target):
                    todo.append(target[0])

    def turn(self, code: str, times: int) -> Tops:
        """The tops behind a turn. ``code``: its role's initial, in upper case if it is truncated, x for a role that can't stay; or d for one that must go,
        ``times`` times over."""
        after = Tops()
        for cost, audit, stack in self.best.values():
            after.add(cost + DELETE * times, audit + "D" * times, stack)
            if code == "d":
                continue
            more = TRUNCATED if code.isupper() else 0
            after.add(cost + more, audit + "K", shifted(stack, code.lower()))
            for symbol in REROLED:
                after.add(cost + more + REROLE, audit + "R", shifted(stack, symbol))
        return after


def parse(codes: str, times: list[int], begin: int = 0) -> dict[int, Top]:
    """The cheapest edits (cost, audit) of some turns that lead from the stack top ``begin`` to each other one, insertions behind them included."""
    tops = Tops()
    tops.add(0, "", automaton()[3][begin])
    tops.insert()
    for code, n in zip(codes, times, strict=True):
        tops = tops.turn(code, n)
        tops.insert()
    return {state: (cost, audit) for state, (cost, audit, _) in tops.best.items()}


def entrances() -> list[int]:
    """States that can be on top between turns."""
    return sorted(n for n, rule in enumerate(automaton()[1]) if rule is None)


def joined(pieces: list[dict[int, dict[int, Top]]]) -> tuple[int, list[tuple[int, int]]]:
    """The cheapest way through all pieces of a conversation (of each: by entrance, by exit): its cost, and entrance and exit of each piece.

    Audits grow from piece to piece; they are compared where two ways part, not from their beginning.
    """
    ways: dict[int, tuple] = {0: (0, None, 0, "")}  # top: cost, the way before, its top, audit of the last piece

    def path(way: tuple) -> list[tuple]:
        steps = []
        while way[1] is not None:
            steps.append(way)
            way = way[1]
        return steps

    def less(a: tuple, b: tuple) -> bool:
        if a[0] != b[0]:
            return a[0] < b[0]
        first, second = [a[3]], [b[3]]
        x, y = a[1], b[1]
        while x is not y:
            first.append(x[3])
            second.append(y[3])
            x, y = x[1], y[1]
        return "".join(reversed(first)) < "".join(reversed(second))

    for piece in pieces:
        after: dict[int, tuple] = {}
        for top, way in ways.items():
            for target, (cost, audit) in piece[top].items():
                new = (way[0] + cost, way, top, audit, target)
                if target not in after or less(new, after[target]):
                    after[target] = new
        ways = after
    best = None
    for top, way in ways.items():
        if automaton()[2][top] and (best is None or less(way, best)):
            best = way
    return best[0], [(w[2], w[4]) for w in reversed(path(best))]


def fault(text: Column) -> Column:
    """``b`` for a blank text, ``t`` for a truncated one, else empty."""
    last = F.rtrim(text, F.lit(SPACES))
    return F.when(last == "", "b").when(F.right(last, F.lit(1)).isin(*".!?"), "").otherwise("t")


def _initial(role: Column) -> Column:
    first = F.left(role, F.lit(1))
    return F.when(first.isin(*TURNS), first).otherwise("x")


def _units(rows: DataFrame) -> DataFrame:
    """One row for all equal rows (``n`` of them) of a turn; ``first``: whether it is the first of its role and text."""
    conv, same = F.col("conv"), F.struct("role", "text")
    hashed = rows.select("conv", "turn", "initial", "fault", F.md5(F.to_json(same)).alias("h"))
    units = hashed.groupBy("conv", "turn", "h").agg(F.count("*").alias("n"), F.min("initial").alias("initial"), F.min("fault").alias("fault"))
    first = hashed.groupBy("conv", "h").agg(F.min(F.struct(F.col("turn").isNotNull().alias("a"), F.col("turn").alias("b"))).alias("at"))
    found = units.alias("u").join(first.alias("f"), F.col("u.conv").eqNullSafe(F.col("f.conv")) & (F.col("u.h") == F.col("f.h")))
    return found.select("u.*", F.col("u.turn").eqNullSafe(F.col("at.b")).alias("first")).select(conv, "turn", "h", "n", "initial", "fault", "first")


_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_PIECES = {
    "piece": pa.int64(), "codes": pa.string(), "times": pa.list_(pa.int64()), "of": pa.list_(pa.int32()), "turns": pa.list_(pa.int64()), "hashes": pa.list_(pa.string()), "sure": pa.bool_(),
    "turn_count": pa.int64(), "low": pa.int64(), "high": pa.int64(), "first_turn": pa.int64(), "last_turn": pa.int64(), "first_role": pa.string(), "last_role": pa.string(),
    **dict.fromkeys(_COUNTS, pa.int64()),
}
_SPARK = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string", pa.bool_(): "boolean", pa.list_(pa.int64()): "array<long>", pa.list_(pa.int32()): "array<int>", pa.list_(pa.string()): "array<string>"}


def _piece(rows: list[dict], sure: bool) -> dict:
    codes, times, of = [], [], []
    counts = dict.fromkeys(_COUNTS, 0)
    for i, r in enumerate(rows):
        kept = int(r["first"] and r["fault"] != "b")
        counts["blank" if r["fault"] == "b" else "duplicate"] += r["n"] - kept
        cut = kept and r["fault"] == "t"
        counts["truncated"] += cut
        if kept:
            codes.append(r["initial"].upper() if cut else r["initial"])
            times.append(1)
            of.append(i)
        if r["n"] > kept:
            codes.append("d")
            times.append(r["n"] - kept)
            of.append(i)
    turns, roles = [r["turn"] for r in rows], [r["initial"] for r in rows]
    known = [t for t in turns if t is not None]
    counts["illegal"] = sum(r["n"] - 1 for r in rows) + sum(a + b not in LEGAL for a, b in zip(roles, roles[1:], strict=False))
    return {
        "conv": rows[0]["conv"], "piece": rows[0]["place"], "codes": "".join(codes), "times": times, "of": of, "turns": turns, "hashes": [r["h"] for r in rows], "sure": sure,
        "turn_count": len(set(known)), "low": min(known, default=None), "high": max(known, default=None), "first_turn": turns[0], "last_turn": turns[-1],
        "first_role": roles[0], "last_role": roles[-1], **counts,
    }


def _pieces(units: DataFrame, size: int) -> DataFrame:
    """Runs of at most ``size`` units of one conversation, in order: sorted over all tasks, so that a long conversation lies in several.

    ``sure``: the run is known to be the first of its conversation. ``codes`` is what ``parse`` takes, ``of`` the unit of each code.
    """
    kind = units.schema["conv"].dataType.simpleString()
    ordered = units.repartitionByRange("conv", "turn", "h").sortWithinPartitions("conv", "turn", "h").withColumn("place", F.monotonically_increasing_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, rows, sure = None, [], False  # the conversation the task begins with may have begun in the one before
        for batch in batches:
            schema = schema or pa.schema({"conv": batch.schema.field("conv").type, **_PIECES})
            done = []
            for row in batch.to_pylist():
                other = rows and row["conv"] != rows[0]["conv"]
                if other or len(rows) >= size:
                    done.append(_piece(rows, sure))
                    rows, sure = [], other
                rows.append(row)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema)
        if rows:
            yield pa.RecordBatch.from_pylist([_piece(rows, sure)], schema)

    return ordered.mapInArrow(run, ", ".join([f"conv {kind}", *(f"{c} {_SPARK[t]}" for c, t in _PIECES.items())]))


_WAYS = pa.list_(pa.struct([("entrance", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))


def _parsed(pieces: DataFrame) -> DataFrame:
    """``ways``: the cheapest edits of each piece by stack top before and behind it."""
    columns = [c for c in pieces.columns if c not in ("codes", "times", "of", "turns", "hashes", "sure")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ways = []
            for codes, times, sure in zip(*(batch.column(c).to_pylist() for c in ("codes", "times", "sure")), strict=True):
                found = {e: parse(codes, times, e) for e in ([0] if sure else entrances())}
                ways.append([{"entrance": e, "exit": x, "cost": cost, "audit": audit} for e, exits in found.items() for x, (cost, audit) in exits.items()])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(ways, _WAYS)], [*columns, "ways"])

    kinds = [f"{c} {pieces.schema[c].dataType.simpleString()}" for c in columns]
    return pieces.mapInArrow(run, ", ".join([*kinds, "ways array<struct<entrance:int,exit:int,cost:long,audit:string>>"]))


_CHOSEN = pa.list_(pa.struct([("piece", pa.int64()), ("entrance", pa.int32()), ("position", pa.int64()), ("audit", pa.string())]))


def _joined(parsed: DataFrame) -> DataFrame:
    """A conversation's pieces put together: its counts and cost, and the chosen edits of each piece."""
    kind = parsed.schema["conv"].dataType.simpleString()
    whole = parsed.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct(*(c for c in parsed.columns if c != "conv")))).alias("pieces"))

    def summary(pieces: list[dict]) -> dict:
        by_way = [{(w["entrance"], w["exit"]): (w["cost"], w["audit"]) for w in p["ways"]} for p in pieces]
        tables: list[dict[int, dict[int, Top]]] = []
        for own in by_way:
            tables.append({})
            for (entrance, out), top in own.items():
                tables[-1].setdefault(entrance, {})[out] = top
        cost, steps = joined(tables)
        chosen, position = [], 0
        for p, own, step in zip(pieces, by_way, steps, strict=True):
            audit = own[step][1]
            chosen.append({"piece": p["piece"], "entrance": step[0], "position": position, "audit": audit})
            position += len(audit) - audit.count("D")
        known = [p for p in pieces if p["low"] is not None]
        distinct = sum(p["turn_count"] for p in known) - sum(a["last_turn"] == b["first_turn"] for a, b in zip(known, known[1:], strict=False))
        gaps = known[-1]["high"] - known[0]["low"] + 1 - distinct if known else 0
        counts = {c: sum(p[c] for p in pieces) for c in _COUNTS}
        counts["illegal"] += sum(a["last_role"] + b["first_role"] not in LEGAL for a, b in zip(pieces, pieces[1:], strict=False))
        return {"gaps": gaps, **counts, "cost": cost, "chosen": chosen}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [summary(pieces.as_py()) for pieces in batch.column("pieces")]
            names = ["gaps", *_COUNTS, "cost"]
            yield pa.RecordBatch.from_arrays([batch.column("conv"), *(pa.array([m[c] for m in made], pa.int64()) for c in names), pa.array([m["chosen"] for m in made], _CHOSEN)], ["conv", *names, "chosen"])

    names = ", ".join(f"{c} long" for c in ("gaps", *_COUNTS, "cost"))
    return whole.mapInArrow(run, f"conv {kind}, {names}, chosen array<struct<piece:long,entrance:int,position:long,audit:string>>")


def edits(codes: str, times: list[int], audit: str, entrance: int) -> Iterator[tuple[str, int, str | None]]:
    """What ``audit`` does, step by step: the edit, the place in ``codes`` (-1 for an insertion) and the new role, None where it stays.
    Deletions are left out."""
    stack, at, left = automaton()[3][entrance], 0, 0
    for edit in audit:
        if edit == "D":
            left = left or times[at]
            left -= 1
            at += left == 0
            continue
        symbol = codes[at].lower() if edit == "K" else next(s for s in REROLED if shifted(stack, s))
        stack = shifted(stack, symbol)
        yield edit, -1 if edit == "I" else at, None if edit == "K" else TURNS[symbol]
        at += edit != "I"


def _kept(pieces: DataFrame, chosen: DataFrame) -> DataFrame:
    """``conv, position, edit, role, turn, h`` of every turn that the repaired conversations have."""
    kind = pieces.schema["conv"].dataType.simpleString()
    choice = chosen.select(F.explode("chosen").alias("c")).select("c.*")
    both = pieces.select("conv", "piece", "codes", "times", "of", "turns", "hashes").join(choice, "piece")
    names = {"position": pa.int64(), "edit": pa.string(), "role": pa.string(), "turn": pa.int64(), "h": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schema = pa.schema({"conv": batch.schema.field("conv").type, **names})
            for p in batch.to_pylist():
                rows = []
                for n, (edit, at, role) in enumerate(edits(p["codes"], p["times"], p["audit"], p["entrance"])):
                    unit = p["of"][at] if at >= 0 else None
                    turn, h = (p["turns"][unit], p["hashes"][unit]) if at >= 0 else (None, None)
                    rows.append({"conv": p["conv"], "position": p["position"] + n, "edit": edit, "role": role, "turn": turn, "h": h})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return both.mapInArrow(run, ", ".join([f"conv {kind}", *(f"{c} {_SPARK[t]}" for c, t in names.items())]))


def repair_conversations(
    rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", piece: int = PIECE
) -> tuple[DataFrame, DataFrame]:
    """Conversations brought into the form ``(s?(ua)+)?`` by the cheapest edits, of equally cheap ones those whose initials come first in ASCII.

    Two tables. By ``conversation``: ``gaps`` (turn numbers missing), the number of ``blank``, ``duplicate``, ``truncated`` turns (first
    fault of each) and ``illegal`` neighbours, ``cost`` and ``audit`` (initials of Keep, Rerole, Delete, Insert in order). And the repaired
    turns: ``conversation``, ``position`` (from 0), ``edit``, ``turn``, ``role``, ``text``; inserted ones have an empty text and no ``turn``.

    Null role or text: one space, hence blank. Null turns come first; different rows of one turn are ordered by a hash of role and text. A null
    conversation is one like any other. Equal rows of a turn are counted before anything moves; all but the first are duplicates. No rows:
    no rows. Other columns, whatever their names, are not looked at.

    Texts are reduced to their fault and a hash first and joined on again at the end, by conversation, turn and hash; only kept turns get
    one. Turns are sorted over all tasks; conversations of more than ``piece`` turns are parsed in pieces, from every stack top each. Only the edits (some
    dozen bytes a turn) of a conversation meet in a task, which its audit, one cell of the result, needs anyway.
    """
    space = F.lit(" ")
    plain = rows.select(
        F.col(conversation).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role).cast("string"), space).alias("role"), F.coalesce(F.col(text).cast("string"), space).alias("text")
    ).withColumns({"initial": _initial(F.col("role")), "fault": fault(F.col("text"))})
    pieces = stored(_pieces(_units(plain), piece), "conversations")
    chosen = stored(_joined(_parsed(pieces)), "conversation-edits")
    names = {c: F.col(c) for c in ("gaps", *_COUNTS, "cost")}
    audit = F.array_join(F.transform("chosen", lambda c: c["audit"]), "")
    found = chosen.select(F.col("conv").alias(conversation), *names.values(), audit.alias("audit"))
    kept = _kept(pieces, chosen)
    # Equal rows of a turn have equal texts: any of them will do.
    texts = plain.select("conv", "turn", F.md5(F.to_json(F.struct("role", "text"))).alias("h"), "role", "text").groupBy("conv", "turn", "h").agg(F.first("role").alias("own"), F.first("text").alias("text"))
    same = F.col("k.conv").eqNullSafe(F.col("t.conv")) & F.col("k.turn").eqNullSafe(F.col("t.turn")) & (F.col("k.h") == F.col("t.h"))
    turns = kept.alias("k").join(texts.alias("t"), same, "left").select(
        F.col("k.conv").alias(conversation), "position", "edit", F.col("k.turn").alias("turn"), F.coalesce("k.role", "own").alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    return found, turns


def conversation_digest(turns: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """``repaired_sha256`` of each conversation's ``role:text`` lines, hashed turn by turn: no conversation is held."""
    kind = turns.schema[conversation].dataType.simpleString()
    ordered = turns.select(F.col(conversation).alias("conv"), "position", "role", "text").repartition("conv").sortWithinPartitions("conv", "position")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, current, kind = None, None, None
        for batch in batches:
            kind = kind or batch.schema.field("conv").type
            done = []
            columns = (batch.column(c).to_pylist() for c in ("conv", "role", "text"))
            for conv, own in groupby(zip(*columns, strict=True), key=lambda r: r[0]):
                if state is None or conv != current:
                    done += [(current, state.hexdigest())] if state else []
                    state, current, first = hashlib.sha256(), conv, True
                for _, role, text in own:
                    state.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
                    first = False
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], kind), pa.array([d for _, d in done])], ["conv", "repaired_sha256"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([current], kind), pa.array([state.hexdigest()])], ["conv", "repaired_sha256"])

    return ordered.mapInArrow(run, f"conv {kind}, repaired_sha256 string").withColumnRenamed("conv", conversation)
