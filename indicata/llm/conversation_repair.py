"""Cheapest repair of damaged conversations by Four-Russians block tables.

Rows of a conversation are symbols: the role's initial (s, u, a or another),
truncated or not, or a row that has to go. The cost to repair the rest of a
conversation depends only on where one stands in the pattern ``(s?(ua)+)?``:
a vector of four costs, for the places before anything, behind ``s``, behind
``u`` and behind ``a``. Less their smallest entry, only a few vectors occur.
``tables`` numbers them and precomputes, for every vector and every block of
``BLOCK`` symbols, the vector before the block and the cost it adds.

A conversation is worked from its end, a block by one lookup. Then the blocks
are expanded backward one by one, from the vector behind each, and the edits
are read forward: in every place the least letter (D, I, K, R) that still
reaches the cheapest total, so of equally cheap edits the ASCII-least remain.

Rows are range-partitioned by conversation and turn and sorted, so texts move
once, and a conversation of any size is spread over tasks. A conversation that
lies within a partition, and within ``SEGMENT_ROWS`` rows and
``SEGMENT_CHARS`` characters, is done where it is read. The others are cut
into segments of at most that size. Each segment is a function on the numbered
vectors (worked out block by block for all of them at once) and then on the
four places; the functions of a conversation's segments are composed in order
by a pass that holds one vector. Its hash and audit are put together by a
pass over its segments, as a hash has to be.

Defined results: rows without role or text have one space instead; ids and
turns that are null are one space in the damage key; a null conv_id is a
conversation of its own. Rows of one turn are taken by role, then by the first
``TIE_CHARS`` characters of their text, then by its XXH64. A role without
characters has no initial and cannot be kept. Repeated rows are rows; empty
and very long texts are worked whole; extra columns are not read. An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.llm.common import crc32_sql, shuffle_partitions, stage

BLANKS = " \t\n\x0b\f\r"
ENDS = (".", "!", "?")
BLOCK = 4
SEGMENT_ROWS = 4_096
SEGMENT_CHARS = 4 << 20
TIE_CHARS = 64

# Costs of the edits, and what a truncated row adds if it stays.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
# Faults of a row; the first that holds counts.
SOUND, BLANK, DUPLICATE, CUT_OFF = range(4)
# Symbols: initial + 4 if truncated, or GOES.
INITIALS = "sua"
OTHER, GOES, SYMBOLS = 3, 8, 9
# Places in the pattern: before anything, behind s, behind u, behind a.
PLACES, START, AFTER_A = 4, 0, 3
#: Place behind the next user or assistant, and which of the two it is.
NEXT = (2, 2, 3, 2)
NEXT_ROLE = ("user", "user", "assistant", "user")
LEGAL = {"su", "ua", "au"}


def _kept(place: int, symbol: int) -> int | None:
    """Place behind a row that keeps its role, None if it does not fit."""
    initial = symbol % 4
    if initial == 0:
        return 1 if place == START else None
    if initial == OTHER or (initial == 1) != (NEXT[place] == 2):
        return None
    return NEXT[place]


def _with_inserts(costs: list[int]) -> tuple[int, ...]:
    """Costs of the places when rows may be inserted first; two inserts reach every place that any number reaches."""
    for _ in range(2):
        costs = [min(c, INSERT + costs[NEXT[p]]) for p, c in enumerate(costs)]
    return tuple(costs)


def _before(symbol: int, behind: tuple[int, ...]) -> tuple[int, ...]:
    """Costs before a row of ``symbol`` from those behind it."""
    out = []
    for place in range(PLACES):
        options = [DELETE + behind[place]]
        if symbol != GOES:
            more = TRUNCATED * (symbol // 4)
            options.append(REROLE + more + behind[NEXT[place]])
            kept = _kept(place, symbol)
            if kept is not None:
                options.append(more + behind[kept])
        out.append(min(options))
    return _with_inserts(out)


class Tables(NamedTuple):
    vectors: list[tuple[int, ...]]  # normalised; number 0 holds at the end
    end_cost: int
    one: np.ndarray  # [vector, symbol] -> vector before it
    one_cost: np.ndarray
    block: np.ndarray  # [vector, block code] -> vector before it
    block_cost: np.ndarray
    edits: list  # [vector behind][symbol][place] -> (letters, inserted roles, new role or None, place behind)
    finish: list  # [place] -> (letters, inserted roles)


@lru_cache(maxsize=1)
def tables() -> Tables:
    """All vectors that can occur, and the transitions of every block; built once in each Python worker."""

    def normal(v):
        return tuple(x - min(v) for x in v), min(v)

    far = INSERT * PLACES + DELETE  # more than any way on from a place that is no end
    end, end_cost = normal(_with_inserts([0, far, far, 0]))
    vectors, number, rows = [end], {end: 0}, []
    for v in vectors:  # grows while new vectors turn up
        row = []
        for s in range(SYMBOLS):
            w, cost = normal(_before(s, v))
            if w not in number:
                number[w] = len(vectors)
                vectors.append(w)
            row.append((number[w], cost))
        rows.append(row)
    one, one_cost = (np.array([[x[k] for x in row] for row in rows], np.int64) for k in (0, 1))
    block, block_cost = one, one_cost
    for _ in range(BLOCK - 1):
        # A further symbol in front: the code's leading digit.
        front = [(one[block, s], block_cost + one_cost[block, s]) for s in range(SYMBOLS)]
        block, block_cost = (np.concatenate([x[k] for x in front], axis=1) for k in (0, 1))

    def edit(v: int, symbol: int, place: int):
        behind, letters, inserted = vectors[v], "", []
        before = _before(symbol, behind)
        more = TRUNCATED * (symbol // 4) if symbol != GOES else 0
        while True:
            if DELETE + behind[place] == before[place]:
                return letters + "D", inserted, "", place
            if INSERT + before[NEXT[place]] == before[place]:
                letters, place = letters + "I", (inserted.append(NEXT_ROLE[place]), NEXT[place])[1]
                continue
            kept = _kept(place, symbol)
            if kept is not None and more + behind[kept] == before[place]:
                return letters + "K", inserted, None, kept
            return letters + "R", inserted, NEXT_ROLE[place], NEXT[place]

    edits = [[[edit(v, s, p) for p in range(PLACES)] for s in range(SYMBOLS)] for v in range(len(vectors))]
    finish = []
    for place in range(PLACES):
        roles = []
        while place not in (START, AFTER_A):
            roles.append(NEXT_ROLE[place])
            place = NEXT[place]
        finish.append(("I" * len(roles), roles))
    return Tables(vectors, end_cost, one, one_cost, block, block_cost, edits, finish)


def _blocks(symbols: bytes) -> tuple[np.ndarray, bytes]:
    """Codes of the full blocks, and the symbols of the last, shorter one."""
    full = len(symbols) // BLOCK * BLOCK
    digits = np.frombuffer(symbols[:full], np.uint8).reshape(-1, BLOCK).astype(np.int64)
    return digits @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1)), symbols[full:]


def boundaries(symbols: bytes, vector: int = 0) -> tuple[list[int], int]:
    """Vector number before every block (the last, shorter one included), then ``vector``; and the cost added."""
    t = tables()
    codes, rest = _blocks(symbols)
    out, cost = [vector], 0
    if rest:
        for s in reversed(rest):
            cost, vector = cost + t.one_cost.item(vector, s), t.one.item(vector, s)
        out.append(vector)
    for code in reversed(codes.tolist()):
        cost, vector = cost + t.block_cost.item(vector, code), t.block.item(vector, code)
        out.append(vector)
    return out[::-1], cost


def trace(symbols: bytes, vector: int = 0, place: int = START) -> tuple[list, int]:
    """The edit of every symbol, read forward from ``place`` with ``vector`` behind the last one; and the place behind it."""
    t = tables()
    bounds, _ = boundaries(symbols, vector)
    out = []
    for k in range(len(bounds) - 1):
        block = symbols[k * BLOCK : (k + 1) * BLOCK]
        behind = [bounds[k + 1]]
        for s in reversed(block[1:]):
            behind.append(t.one.item(behind[-1], s))
        for s, v in zip(block, reversed(behind)):
            step = t.edits[v][s][place]
            out.append(step)
            place = step[3]
    return out, place


def function_of(symbols: bytes) -> tuple[np.ndarray, np.ndarray]:
    """What a segment does to every vector behind it: the vector before it, and the cost added."""
    t = tables()
    codes, rest = _blocks(symbols)
    vector, cost = np.arange(len(t.vectors)), np.zeros(len(t.vectors), np.int64)
    for s in reversed(rest):
        cost, vector = cost + t.one_cost[vector, s], t.one[vector, s]
    for code in codes[::-1]:
        cost, vector = cost + t.block_cost[vector, code], t.block[vector, code]
    return vector, cost


def initial_code(initial: str) -> int:
    return INITIALS.index(initial) if initial and initial in INITIALS else OTHER


def symbol_of(initial: str, fault: int) -> int:
    return GOES if fault in (BLANK, DUPLICATE) else initial_code(initial) + 4 * (fault == CUT_OFF)


def fault_of(text: str, seen: bool) -> int:
    end = text.rstrip(BLANKS)[-1:]
    return BLANK if not end else DUPLICATE if seen else SOUND if end in ENDS else CUT_OFF


def faults(rows: list[tuple[str, str]]) -> list[int]:
    """Fault of each (role, text) of one conversation."""
    seen, out = set(), []
    for row in rows:
        out.append(fault_of(row[1], row in seen))
        seen.add(row)
    return out


def repaired_lines(rows: list[tuple[str, str]], steps: list) -> list[str]:
    """``role:text`` of what remains and of what is put in before it."""
    out = []
    for (role, text), (_, inserted, new_role, _) in zip(rows, steps):
        out.extend(f"{r}:" for r in inserted)
        if new_role is None:
            out.append(f"{role}:{text}")
        elif new_role:
            out.append(f"{new_role}:{text}")
    return out


def illegal_pairs(initials: list[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


def repair(rows: list[tuple[int | None, str, str]]) -> tuple:
    """gaps, blank, duplicate, truncated, illegal, cost, audit and repaired text's hash of the (turn, role, text) of one conversation, in order."""
    t = tables()
    turns = {r[0] for r in rows if r[0] is not None}
    said = [r[1:] for r in rows]
    found = faults(said)
    initials = [role[:1] for role, _ in said]
    symbols = bytes(map(symbol_of, initials, found))
    bounds, cost = boundaries(symbols)
    steps, place = trace(symbols)
    letters, roles = t.finish[place]
    lines = repaired_lines(said, steps) + [f"{r}:" for r in roles]
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        found.count(BLANK),
        found.count(DUPLICATE),
        found.count(CUT_OFF),
        illegal_pairs(initials),
        t.end_cost + cost + t.vectors[bounds[0]][START],
        "".join(s[0] for s in steps) + letters,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the damage that the checksum of ``conv_id:turn`` chooses."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(key) % 20).alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]+", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    hurt = rows.filter("kind <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("_"))
    return hurt.drop("_")


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
ROW = "seg long, pos long, turn long, role string, text string"


def _arrow(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(n, kinds[k]) for n, k in (f.split(" ") for f in schema.split(", "))])


def _batch(id_type: pa.DataType, schema: str, rows: list[tuple]) -> pa.RecordBatch:
    """Rows of (conv_id, *the columns of ``schema``)."""
    fields = _arrow(schema)
    columns = list(zip(*rows)) if rows else [()] * (1 + len(fields))
    return pa.RecordBatch.from_arrays([pa.array(columns[0], id_type), *(pa.array(c, f.type) for c, f in zip(columns[1:], fields))], ["conv_id", *fields.names])


def _grouped(batches: Iterator[pa.RecordBatch], segment_rows: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows to finished conversations (result columns) and rows of those that may go on elsewhere (row columns)."""
    part = TaskContext.get().partitionId()
    none_result, none_row = (None,) * 8, (None,) * 5
    held: list[tuple] = []  # (turn, role, text) of the conversation at hand
    here, chars, seg, pos, whole, id_type = None, 0, part << 24, part << 40, False, None
    out: list[tuple] = []

    def leave(finished: bool):
        nonlocal held, chars, seg, pos
        if held and finished:
            out.append((here, *repair(held), *none_row))
        elif held:
            out.extend((here, *none_result, seg, pos + k, *row) for k, row in enumerate(held))
            seg, pos = seg + 1, pos + len(held)
        held, chars = [], 0

    first = True
    for b in batches:
        id_type = b.schema.field("conv_id").type
        for conv, turn, role, text in zip(*(b.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text"))):
            if first or conv != here:
                # The first and the last conversation of a partition may have rows in others.
                leave(whole)
                here, whole, first = conv, not first, False
            elif len(held) >= segment_rows or chars >= SEGMENT_CHARS:
                leave(False)
                whole = False
            held.append((turn, role, text))
            chars += len(text)
        yield _batch(id_type, f"{RESULT}, {ROW}", out)
        out = []
    leave(False)
    if id_type is not None:
        yield _batch(id_type, f"{RESULT}, {ROW}", out)


def _id_type(df: DataFrame) -> str:
    return df.schema["conv_id"].dataType.simpleString()


def _per_row(df: DataFrame, schema: str, work: Callable[[dict], tuple]) -> DataFrame:
    """``work`` of every row, a row at a time: (the columns of ``schema``) after conv_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                cut = b.slice(k, 1)
                row = cut.to_pylist()[0]
                yield _batch(cut.schema.field("conv_id").type, schema, [(row["conv_id"], *work(row))])

    return df.mapInArrow(run, f"conv_id {_id_type(df)}, {schema}")


def _in_order(df: DataFrame, schema: str, start: Callable[[], object], step: Callable[[object, dict], tuple], backward: bool = False) -> DataFrame:
    """Pass over each conversation's segments in order, with a state of one conversation; ``step`` gives (state, output columns or None)."""
    order = F.col("seg").desc() if backward else F.col("seg")
    ordered = df.repartition(shuffle_partitions(df.sparkSession), "conv_id").sortWithinPartitions("conv_id", order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, state, first = None, None, True
        for b in batches:
            for k in range(b.num_rows):
                cut = b.slice(k, 1)
                row = cut.to_pylist()[0]
                if first or row["conv_id"] != here:
                    here, state, first = row["conv_id"], start(), False
                state, out = step(state, row)
                if out is not None:
                    yield _batch(cut.schema.field("conv_id").type, schema, [(here, *out)])

    return ordered.mapInArrow(run, f"conv_id {_id_type(df)}, {schema}")


SEGMENT = (
    "seg long, symbols binary, vectors array<long>, costs array<long>, blank long, duplicate long, truncated long, illegal long, "
    "first_initial string, last_initial string, first_turn long, last_turn long, low long, high long, turns long"
)


def _segment(row: dict) -> tuple:
    rows = row["rows"]
    initials, found = [r["initial"] for r in rows], [r["fault"] for r in rows]
    turns = [r["turn"] for r in rows if r["turn"] is not None]
    symbols = bytes(map(symbol_of, initials, found))
    vectors, costs = function_of(symbols)
    return (
        row["seg"], symbols, vectors.tolist(), costs.tolist(), found.count(BLANK), found.count(DUPLICATE), found.count(CUT_OFF), illegal_pairs(initials),
        initials[0], initials[-1], rows[0]["turn"], rows[-1]["turn"], min(turns, default=None), max(turns, default=None), len(set(turns)),
    )


def _step_back(state: tuple[int, int], row: dict) -> tuple:
    """The vector behind each segment, whether it is the last one, and the cost of all from it on."""
    t = tables()
    vector, cost, last = state
    before, total = row["vectors"][vector], cost + row["costs"][vector]
    return (before, total, False), (row["seg"], vector, last, total + t.vectors[before][START])


def _exits(row: dict) -> tuple:
    return row["seg"], [trace(row["symbols"], row["behind"], p)[1] for p in range(PLACES)]


def _step_on(place: int, row: dict) -> tuple:
    return row["exits"][place], (row["seg"], place)


def _piece(row: dict) -> tuple:
    """Audit and repaired lines of a segment (null: none)."""
    steps, place = trace(row["symbols"], row["behind"], row["place"])
    lines = repaired_lines([(r["role"], r["text"]) for r in row["rows"]], steps)
    letters, roles = tables().finish[place] if row["last"] else ("", [])
    lines.extend(f"{r}:" for r in roles)
    return row["seg"], "".join(s[0] for s in steps) + letters, "\n".join(lines) if lines else None


class _Whole:
    """What a conversation's segments add up to."""

    def __init__(self):
        self.sums, self.audit, self.hash, self.any = [0, 0, 0, 0], [], hashlib.sha256(), False
        self.before, self.low, self.high, self.turns, self.cost = None, None, None, 0, None


def _step_whole(w: _Whole, row: dict) -> tuple:
    for k, name in enumerate(("blank", "duplicate", "truncated", "illegal")):
        w.sums[k] += row[name]
    w.turns += row["turns"]
    if w.before is None:
        w.cost = row["cost"]
    else:
        w.sums[3] += w.before["last_initial"] + row["first_initial"] not in LEGAL
        w.turns -= row["first_turn"] is not None and row["first_turn"] == w.before["last_turn"]
    w.low = min((x for x in (w.low, row["low"]) if x is not None), default=None)
    w.high = max((x for x in (w.high, row["high"]) if x is not None), default=None)
    w.before = {k: row[k] for k in ("last_initial", "last_turn")}
    w.audit.append(row["audit"])
    if row["lines"] is not None:
        w.hash.update((("\n" if w.any else "") + row["lines"]).encode())
        w.any = True
    if not row["last"]:
        return w, None
    gaps = 0 if w.low is None else w.high - w.low + 1 - w.turns
    return w, (gaps, *w.sums, w.cost, "".join(w.audit), w.hash.hexdigest())


def _repair_segments(rows: DataFrame) -> DataFrame:
    """Results of conversations given as rows of numbered segments (a written table)."""
    digest = F.sha2(F.col("text"), 256)
    light = rows.select("conv_id", "seg", "pos", "turn", "role", digest.alias("digest"), F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1)).alias("end"))
    # Said twice or more: the first place, pre-aggregated; skewed keys are split by the join.
    again = light.groupBy(F.col("conv_id").alias("its_conv"), F.col("role").alias("its_role"), F.col("digest").alias("its_digest")).agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    on = F.col("conv_id").eqNullSafe(F.col("its_conv")) & (F.col("role") == F.col("its_role")) & (F.col("digest") == F.col("its_digest"))
    fault = (
        F.when(F.col("end") == "", BLANK).when(F.col("pos") > F.col("first"), DUPLICATE).when(F.col("end").isin(*ENDS), SOUND).otherwise(CUT_OFF)
    )
    flagged = light.join(again, on, "left").select("conv_id", "seg", "pos", "turn", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))
    # At most SEGMENT_ROWS rows in a group.
    grouped = flagged.groupBy("conv_id", "seg").agg(F.sort_array(F.collect_list(F.struct("pos", "turn", "initial", "fault"))).alias("rows"))
    segments = stage(_per_row(grouped, SEGMENT, _segment), "repair-segments")
    behind = stage(_in_order(segments.select("conv_id", "seg", "vectors", "costs"), "seg long, behind long, last boolean, cost long", _back_state, _step_back, backward=True), "repair-behind")
    known = segments.select("conv_id", "seg", "symbols").join(behind.drop("conv_id"), "seg")
    exits = _per_row(known, "seg long, exits array<long>", _exits)
    places = _in_order(exits, "seg long, place long", _start_place, _step_on)
    said = rows.groupBy("conv_id", "seg").agg(F.sort_array(F.collect_list(F.struct("pos", "role", "text"))).alias("rows"))
    traced = said.join(known.drop("conv_id"), "seg").join(places.drop("conv_id"), "seg")
    pieces = _per_row(traced, "seg long, audit string, lines string", _piece)
    sums = segments.drop("symbols", "vectors", "costs").join(behind.select("seg", "last", "cost"), "seg").join(pieces.drop("conv_id"), "seg")
    return _in_order(sums, RESULT, _Whole, _step_whole)


def _back_state() -> tuple[int, int, bool]:
    return 0, tables().end_cost, True


def _start_place() -> int:
    return START


def repair_conversations(rows: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation in (conv_id, turn, role, text)."""
    parts = shuffle_partitions(rows.sparkSession)
    # The last key spreads rows that are equal in all others over partitions.
    order = ["conv_id", "turn", "role", F.substring("text", 1, TIE_CHARS), F.xxhash64("text")]
    ordered = rows.select("conv_id", "turn", "role", "text", F.rand(0).alias("spread")).repartitionByRange(parts, *order, "spread").sortWithinPartitions(*order, "spread")
    done = stage(ordered.select("conv_id", "turn", "role", "text").mapInArrow(lambda batches: _grouped(batches, segment_rows), f"conv_id {_id_type(rows)}, {RESULT}, {ROW}"), "repair-rows")
    results = [f.split(" ")[0] for f in RESULT.split(", ")]
    closed = done.filter("pos IS NULL").select("conv_id", *results)
    return closed.unionByName(_repair_segments(done.filter("pos IS NOT NULL").select("conv_id", *[f.split(" ")[0] for f in ROW.split(", ")])))


def audit(conversations: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """The damage, the faults and the cheapest repair of every conversation, also of those that lost all rows."""
    found = repair_conversations(damaged(conversations), segment_rows)
    ids = conversations.select(F.col("conv_id").alias("original")).distinct()
    out = ids.join(found, F.col("original").eqNullSafe(F.col("conv_id")), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return out.select(
        F.col("original").alias("conv_id"),
        *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def oracle_sql() -> str:
    """``audit`` of the table ``conversations`` as DuckDB SQL: for each row in turn the cheapest, ASCII-least way to every place of the pattern."""
    ways = "e0 e1 e2 e3".split()
    edited = lambda way, cost, letter, line: f"{{'c': {way}.c + {cost}, 'a': {way}.a || '{letter}', 'l': {way}.l || {line}}}"
    put = {way: edited(way, INSERT, "I", f"chr(10) || '{role}:'") for way, role in zip(ways, NEXT_ROLE)}
    none, empty = "{'c': 1000000000, 'a': '', 'l': ''}", "{'c': 0, 'a': '', 'l': ''}"

    def with_inserts(source: str) -> str:
        """e0 to e3 of ``source`` when rows may be put in: a user before anything, behind s or a, an assistant behind u."""
        first = f"SELECT * REPLACE (least(e2, {put['e0']}, {put['e1']}, {put['e3']}) AS e2) FROM {source}"
        return f"(SELECT * REPLACE (least(e3, {put['e2']}) AS e3) FROM ({first}))"

    def stays(way: str, initial: str, role: str) -> str:
        kept = edited(way, "r.more", "K", "chr(10) || r.role || ':' || r.text")
        new = edited(way, f"{REROLE} + r.more", "R", f"chr(10) || '{role}:' || r.text")
        return f"CASE WHEN r.fault IN ({BLANK}, {DUPLICATE}) THEN {none} WHEN left(r.role, 1) = '{initial}' THEN {kept} ELSE {new} END"

    goes = {way: edited(way, DELETE, "D", "''") for way in ways}
    to_s = f"CASE WHEN r.fault NOT IN ({BLANK}, {DUPLICATE}) AND left(r.role, 1) = 's' THEN {edited('e0', 'r.more', 'K', "chr(10) || r.role || ':' || r.text")} ELSE {none} END"
    return f"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS s FROM conversations
),{crc32_sql("SELECT s FROM raw", "sums")},
hurt AS (
  SELECT conv_id, turn, CASE WHEN crc % 20 = 4 THEN 'user' ELSE role END AS role, CASE crc % 20 WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]+', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE WHEN crc % 20 = 3 THEN 2 ELSE 1 END)) FROM raw JOIN sums USING (s)) WHERE crc % 20 <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(text, {TIE_CHARS}), text) AS pos FROM hurt
), faulty AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN {BLANK} WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN {DUPLICATE}
    WHEN regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN {SOUND} ELSE {CUT_OFF} END AS fault FROM placed
), r AS (
  SELECT *, CASE WHEN fault = {CUT_OFF} THEN {TRUNCATED} ELSE 0 END AS more, left(lag(role) OVER (PARTITION BY conv_id ORDER BY pos), 1) || left(role, 1) AS two FROM faulty
), way AS (
  SELECT conv_id, 0::BIGINT AS pos, {empty} AS e0, {none} AS e1, {none} AS e2, {none} AS e3 FROM (SELECT DISTINCT conv_id FROM r)
  UNION ALL
  SELECT w.conv_id, r.pos, {goes['e0']}, least({goes['e1']}, {to_s}), least({goes['e2']}, {stays('e0', 'u', 'user')}, {stays('e1', 'u', 'user')}, {stays('e3', 'u', 'user')}),
    least({goes['e3']}, {stays('e2', 'a', 'assistant')})
  FROM {with_inserts("way")} w JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.pos = w.pos + 1
), ended AS (
  SELECT conv_id, least(e0, e3) AS e FROM {with_inserts("(SELECT * FROM way WHERE (conv_id, pos) IN (SELECT conv_id, max(pos) FROM r GROUP BY conv_id))")}
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count_if(fault = {BLANK})::BIGINT AS blank, count_if(fault = {DUPLICATE})::BIGINT AS duplicate,
    count_if(fault = {CUT_OFF})::BIGINT AS truncated, count_if(two NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal FROM r GROUP BY conv_id
)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(e.c, 0)::BIGINT AS cost, coalesce(e.a, '') AS audit, sha256(coalesce(substr(e.l, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM raw) i LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM i.conv_id LEFT JOIN ended d ON d.conv_id IS NOT DISTINCT FROM i.conv_id"""
