"""Conversation structure repair by Hirschberg divide and conquer (operator 11).

Rows of a conversation are put in order by turn (null first), then role, then
a digest of the text. The first fault of a row counts: ``blank`` (nothing but
blanks), ``duplicate`` (role and text seen earlier), ``truncated`` (does not
end with one of ``.!?``). Edits: Keep, Rerole, Delete, Insert, at the costs of
``COSTS``; the roles left must read ``(s?(ua)+)?`` by initials. The audit is
the string of edits of least cost, among those the least in ASCII.

The repair is a path through four states (nothing yet, after system, after
user, after assistant). A row, with any insertions before it, moves one state
to another at a cost. Forward vectors hold for each state the least cost of
reaching it and the rank of its least audit among the four (audits of one
length in rows are never prefixes of each other, so ranks decide), backward
vectors the least cost of ending well. Both meet in the middle; the crossing
of least sum and least rank is fixed and the halves are solved alike, so that
only vectors and the audit itself are ever held.

On Spark: equal rows of a turn are one row with a count. These light rows (no
texts) are sorted over the cluster and cut into segments of at most
``SEGMENT`` rows. A conversation of one segment is solved at once; of longer
ones each segment is summed up in a 4 x 4 matrix of costs and ranks, the same
divide and conquer chooses the crossings between segments (over a tree of
``FAN`` children a node, level by level), and segments are then solved side by
side. Texts move once: they meet their audit in the order of their
conversation and are edited as they stream by. A digest of a conversation is
sequential by nature, so one task streams one conversation, holding a batch.

Defined results: null role or text is one space (a blank, no role). Null turns
come first; null ids form one conversation. Rows that agree in turn, role and
text are copies: the first may stay, the others are duplicates. Texts are
compared by their 128-bit MD5. An empty text is blank; very long texts are
streamed like others. Ties of order beyond turn, role and digest are copies,
so none matter. An empty table gives empty results. Further columns of the
input are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlens.llm.common import cut, drop, small, table

SEGMENT = 1 << 16
FAN = 1 << 10
COSTS = {"K": 0, "R": 3, "D": 4, "I": 3}
TRUNCATED_COST = 3
#: Initials by number (0: any other) and the state after each; from a state the
#: next inserted or reroled row speaks as this state.
INITIALS = " sua"
NEXT = (2, 2, 3, 2)
SPEAKERS = {2: "user", 3: "assistant"}
KEPT = {(0, 1), (0, 2), (1, 2), (3, 2), (2, 3)}
LEGAL = {(1, 2), (2, 3), (3, 2)}
#: Cost of ending in each state, and the rows inserted for it.
ENDS = (0, 2 * COSTS["I"], COSTS["I"], 0)
LAST = ("", "II", "I", "")
NO = 1 << 40

Moves = Sequence[Sequence[tuple[int, int, object]]]  # by state: (next state, cost, audit or its rank)
Vector = tuple[tuple[int, int] | None, ...]           # by state: (cost, rank)


def _row_moves(initial: int, fault: int) -> Moves:
    """Of each state the cheapest and then least edits to each state."""
    late = TRUNCATED_COST * (fault == 1)
    out = []
    for q in range(4):
        best: dict[int, tuple[int, str]] = {}
        at = q
        for k in range(3):  # two insertions lead from any state to all that more lead to
            ways = [(at, COSTS["D"], "D")]
            if fault < 2:
                ways.append((NEXT[at], COSTS["R"] + late, "R"))
                if (at, initial) in KEPT:
                    ways.append((initial, COSTS["K"] + late, "K"))
            for to, cost, edit in ways:
                way = (k * COSTS["I"] + cost, "I" * k + edit)
                best[to] = min(best.get(to, way), way)
            at = NEXT[at]
        out.append(tuple((to, cost, edits) for to, (cost, edits) in sorted(best.items())))
    return tuple(out)


#: Moves of a row by its code: initial + 4 * (0 sound, 1 truncated, 2 to be deleted).
MOVES = [_row_moves(code & 3, code >> 2) for code in range(12)]


def ahead(vector: Vector, moves: Moves) -> Vector:
    best: dict[int, tuple] = {}
    for q, x in enumerate(vector):
        if x is not None:
            for to, cost, label in moves[q]:
                way = (x[0] + cost, x[1], label)
                if to not in best or way < best[to]:
                    best[to] = way
    order = sorted(best, key=lambda to: best[to][1:])
    return tuple((best[to][0], order.index(to)) if to in best else None for to in range(4))


def behind(vector: tuple[int, ...], moves: Moves) -> tuple[int, ...]:
    return tuple(min((cost + vector[to] for to, cost, _ in ways), default=NO) for ways in moves)


@lru_cache(maxsize=1 << 16)
def _ahead_row(vector: Vector, code: int) -> tuple[int, Vector]:
    new = ahead(vector, MOVES[code])
    least = min(x[0] for x in new if x)
    return least, tuple(x and (x[0] - least, x[1]) for x in new)


@lru_cache(maxsize=1 << 16)
def _behind_row(vector: tuple[int, ...], code: int) -> tuple[int, tuple[int, ...]]:
    new = behind(vector, MOVES[code])
    least = min(new)
    return least, tuple(min(x - least, NO) for x in new)


def only(state: int) -> tuple[int, ...]:
    return tuple(0 if q == state else NO for q in range(4))


class Rows:
    """Rows of a conversation by their codes; the vectors of rows repeat, so
    their steps (from least cost 0) are remembered."""

    def __init__(self, codes: Sequence[int]):
        self.codes = codes

    def __len__(self):
        return len(self.codes)

    def moves(self, k: int) -> Moves:
        return MOVES[self.codes[k]]

    def forward(self, start: int, lo: int, hi: int) -> Vector:
        total, vector = 0, tuple((0, 0) if q == start else None for q in range(4))
        for code in self.codes[lo:hi]:
            more, vector = _ahead_row(vector, code)
            total += more
        return tuple(x and (x[0] + total, x[1]) for x in vector)

    def backward(self, ends: tuple[int, ...], lo: int, hi: int) -> tuple[int, ...]:
        total, vector = 0, ends
        for k in range(hi - 1, lo - 1, -1):
            more, vector = _behind_row(vector, self.codes[k])
            total += more
        return tuple(x + total for x in vector)


class Nodes:
    """Segments, or nodes of segments, by their matrices of moves."""

    def __init__(self, matrices: Sequence[Moves]):
        self.matrices = matrices

    def __len__(self):
        return len(self.matrices)

    def moves(self, k: int) -> Moves:
        return self.matrices[k]

    def forward(self, start: int, lo: int, hi: int) -> Vector:
        vector = tuple((0, 0) if q == start else None for q in range(4))
        for k in range(lo, hi):
            vector = ahead(vector, self.matrices[k])
        return vector

    def backward(self, ends: tuple[int, ...], lo: int, hi: int) -> tuple[int, ...]:
        for k in range(hi - 1, lo - 1, -1):
            ends = behind(ends, self.matrices[k])
        return ends


def solve(items: Rows | Nodes, lo: int, hi: int, start: int, ends: tuple[int, ...]) -> Iterator[tuple[int, object, int]]:
    """(state before, edits, state after) of each item from ``lo`` to ``hi``."""
    if hi - lo == 1:
        _, label, to = min((cost + ends[to], label, to) for to, cost, label in items.moves(lo)[start])
        yield start, label, to
    elif hi > lo:
        mid = (lo + hi) // 2
        left, right = items.forward(start, lo, mid), items.backward(ends, mid, hi)
        *_, meet = min((x[0] + right[q], x[1], q) for q, x in enumerate(left) if x)
        yield from solve(items, lo, mid, start, only(meet))
        yield from solve(items, mid, hi, meet, ends)


@lru_cache(maxsize=1 << 14)
def _short(codes: bytes, start: int, ends: tuple[int, ...]) -> tuple[list[str], int]:
    return _edits(codes, start, ends)


def _edits(codes: bytes, start: int, ends: tuple[int, ...]) -> tuple[list[str], int]:
    """The edits at each row and the state reached."""
    done = list(solve(Rows(codes), 0, len(codes), start, ends))
    return [label for _, label, _ in done], done[-1][2] if done else start


def edits(codes: bytes, start: int = 0, ends: tuple[int, ...] = ENDS) -> tuple[list[str], int]:
    return _short(codes, start, ends) if len(codes) <= 16 else _edits(codes, start, ends)


def matrix(items: Rows | Nodes) -> tuple[list[int], list[int]]:
    """Costs and ranks (16 each, rank -1: no way) of crossing all ``items``."""
    found = [x for q in range(4) for x in items.forward(q, 0, len(items))]
    return [x[0] if x else NO for x in found], [x[1] if x else -1 for x in found]


def moves_of(costs: Sequence[int], ranks: Sequence[int]) -> Moves:
    return [[(to, costs[4 * q + to], ranks[4 * q + to]) for to in range(4) if ranks[4 * q + to] >= 0] for q in range(4)]


# -- on Spark ---------------------------------------------------------------

KEY = ("turn", "role", "digest")
BLANKS = r"[\x20\x09-\x0D]"


def _rows(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    t = F.coalesce(F.col(text), F.lit(" "))
    fault = F.when(~t.rlike(r"[^\x20\x09-\x0D]"), 2).when(t.rlike(rf"[.!?]{BLANKS}*\z"), 0).otherwise(1)
    return df.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
                     F.unhex(F.md5(t)).alias("digest"), fault.alias("fault"), t.alias("text"))


def _arrow(fn: Callable, df: DataFrame, kind: str) -> DataFrame:
    """``df`` with the columns that ``fn`` makes from columns of a batch."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    schema = StructType([*df.schema.fields, *StructType.fromDDL(kind).fields])
    types = [f.type for f in to_arrow_schema(StructType.fromDDL(kind))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = fn(batch)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(x, t) for x, t in zip(made, types, strict=True)]], names=schema.names)

    return df.mapInArrow(run, schema)


def _codes(batch: pa.RecordBatch) -> list[bytes]:
    return [bytes(b - 65 for b in x.encode()) for x in batch.column("codes").to_pylist()]


def _segments(rows: DataFrame, segment: int) -> DataFrame:
    """(conv, block) in order with the codes of at most ``segment`` distinct
    rows, the copies beyond the first, and sums for the report."""
    order = ["conv", *KEY]
    light = rows.groupBy(*order, "fault").agg(F.count(F.lit(1)).alias("n"))
    light = cut(light.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "place", F.monotonically_increasing_id()), "turns")
    local, task = F.col("place").bitwiseAND((1 << 33) - 1), F.shiftright("place", 33)
    most = light.agg(F.max(F.floor(local / segment))).first()[0] or 0
    firsts = light.filter("fault < 2").groupBy("conv", "role", "digest").agg(F.min("place").alias("place")).select(
        "place", F.lit(True).alias("first"))
    light = light.join(firsts, "place", "left").withColumn("first", F.coalesce("first", F.lit(False)))
    blank, first, n = F.col("fault") == 2, F.col("first"), F.col("n")
    initial = sum(F.when(F.substring("role", 1, 1) == c, k).otherwise(0) for k, c in enumerate(INITIALS) if k)
    code = initial + 4 * F.when(blank | ~first, 2).otherwise(F.col("fault"))
    row = F.struct("place", F.char(65 + code).alias("code"), n.alias("n"))
    by_place = F.array_sort(F.collect_list(row))
    block = task * F.lit(most + 1) + F.floor(local / segment)
    again = F.when(blank, 0).otherwise(n - F.when(first, 1).otherwise(0))
    return light.groupBy("conv", block.cast("bigint").alias("block")).agg(
        by_place.alias("all"), F.min(F.struct("place", *KEY)).alias("head"),
        F.sum(F.when(blank, n).otherwise(0)).alias("blank"), F.sum(again).alias("duplicate"),
        F.sum(F.when(first & (F.col("fault") == 1), 1).otherwise(0)).alias("truncated"),
    ).select("conv", "block", "head", "blank", "duplicate", "truncated",
             F.array_join(F.transform("all", lambda x: x["code"]), "").alias("codes"),
             F.filter(F.transform("all", lambda x, i: F.struct(i.alias("row"), (x["n"] - 1).alias("more"))),
                      lambda x: x["more"] > 0).alias("copies"))


def _crossings(segments: DataFrame, fan: int) -> DataFrame | None:
    """(conv, block, start, ends, last) of every segment of the conversations
    that have several; None if there are none."""
    several = small(segments.groupBy("conv").agg(F.count(F.lit(1)).alias("of")).filter("of > 1").select(
        F.col("conv").alias("long")))
    parts = segments.join(several, F.col("conv").eqNullSafe(F.col("long")), "left_semi").select("conv", "block", "codes")

    def sums(batch: pa.RecordBatch):
        return zip(*[matrix(Rows(c)) for c in _codes(batch)], strict=True) if len(batch) else ([], [])

    kind = "costs array<bigint>, ranks array<int>"
    levels = [cut(_arrow(sums, parts, kind).select("conv", F.col("block").alias("node"), "costs", "ranks"), "matrices")]
    schema = levels[0].schema
    tops = levels[0].select("conv").distinct().count()
    if not tops:
        return None

    def sorted_moves(t: pa.Table) -> tuple[pa.Table, Nodes]:
        t = t.sort_by("node")
        return t, Nodes([moves_of(c, r) for c, r in zip(t["costs"].to_pylist(), t["ranks"].to_pylist(), strict=True)])

    def up(t: pa.Table) -> pa.Table:
        t, items = sorted_moves(t)
        costs, ranks = matrix(items)
        return pa.table([t["conv"].slice(0, 1), pa.array([t["node"][0].as_py() // fan], pa.int64()),
                         pa.array([costs], pa.list_(pa.int64())), pa.array([ranks], pa.list_(pa.int32()))], names=schema.names)

    def down(t: pa.Table) -> pa.Table:
        t, items = sorted_moves(t)
        ends, last = tuple(t["ends"][0].as_py()), t["last"][0].as_py()
        ways = list(solve(items, 0, len(items), t["start"][0].as_py(), ends))
        stop = [only(to) for _, _, to in ways[:-1]] + [ends]
        return pa.table([t["conv"], t["node"], pa.array([w[0] for w in ways], pa.int32()),
                         pa.array(stop, pa.list_(pa.int64())), pa.array([last and k == len(ways) - 1 for k in range(len(ways))])],
                        names=["conv", "node", "start", "ends", "last"])

    parent = F.floor(F.col("node") / fan).cast("bigint")
    while levels[-1].count() > tops:
        levels.append(cut(levels[-1].groupBy("conv", parent.alias("parent")).applyInArrow(up, schema), "matrices"))
    chosen = levels[-1].select("conv", "node", F.lit(0).alias("start"), F.array(*[F.lit(x).cast("bigint") for x in ENDS]).alias("ends"),
                               F.lit(True).alias("last"))
    for level in reversed(levels[:-1]):
        above = chosen.select(F.col("conv").alias("of"), F.col("node").alias("parent"), "start", "ends", "last")
        joined = level.join(above, F.col("conv").eqNullSafe(F.col("of")) & (parent == F.col("parent")))
        chosen = cut(joined.groupBy("conv", "parent").applyInArrow(
            down, "conv {}, node bigint, start int, ends array<bigint>, last boolean".format(
                level.schema["conv"].dataType.simpleString())), "crossings")
    return chosen.withColumnRenamed("node", "block")


def _solved(segments: DataFrame, fan: int) -> DataFrame:
    """The segments with their edits (of distinct rows, and ``audit`` of all),
    costs and illegal neighbours."""
    crossings = _crossings(segments, fan)
    if crossings is None:
        asked = segments.withColumns({"start": F.lit(0), "ends": F.array(*[F.lit(x).cast("bigint") for x in ENDS]), "last": F.lit(True)})
    else:
        c = crossings.select(F.col("conv").alias("of"), F.col("block").alias("at"), "start", "ends", "last")
        asked = segments.join(c, F.col("conv").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at")), "left").drop("of", "at")
        asked = asked.withColumns({"start": F.coalesce("start", F.lit(0)), "last": F.coalesce("last", F.lit(True)),
                                   "ends": F.coalesce("ends", F.array(*[F.lit(x).cast("bigint") for x in ENDS]))})

    def of_batch(batch: pa.RecordBatch):
        out = []
        given = zip(_codes(batch), *[batch.column(c).to_pylist() for c in ("start", "ends", "last", "copies")], strict=True)
        for codes, start, ends, last, copies in given:
            labels, state = edits(codes, start, tuple(ends))
            more = {x["row"]: x["more"] for x in copies}
            tail = LAST[state] if last else ""
            piece = "".join(labels) + tail
            audit = "".join(e + "D" * more[k] if k in more else e for k, e in enumerate(labels)) + tail if more else piece
            late = sum(TRUNCATED_COST for c, e in zip(codes, labels, strict=True) if c >> 2 == 1 and e[-1] != "D")
            initials = np.frombuffer(codes, np.uint8) & 3
            legal = sum(int(((initials[:-1] == a) & (initials[1:] == b)).sum()) for a, b in LEGAL)
            out.append((piece, audit, sum(audit.count(e) * c for e, c in COSTS.items()) + late,
                        sum(more.values()) + len(codes) - 1 - legal, int(initials[0]), int(initials[-1])))
        return list(zip(*out, strict=True)) if out else [[]] * 6

    kind = "piece string, audit string, cost bigint, illegal bigint, first_initial int, last_initial int"
    return _arrow(of_batch, asked, kind).drop("codes", "copies", "start", "ends", "last")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
    """Per batch the events (conv, edit, turn, role, text) of sorted pieces and
    rows; ``edit`` None: the conversation ends."""
    conv, open_, letters, state, before = None, False, iter(()), 0, None
    for batch in batches:
        events: list = []
        for c, turn, role, digest, piece, text in zip(*[x.to_pylist() for x in batch.columns], strict=True):
            if piece is not None:
                if not open_ or c != conv:
                    for e in letters:
                        state = NEXT[state]
                        events.append((conv, e, None, SPEAKERS[state], ""))
                    if open_:
                        events.append((conv, None, None, None, None))
                    conv, open_, state, before = c, True, 0, None
                letters = iter(piece)
                continue
            if before == (turn, role, digest):
                continue  # a copy
            before = (turn, role, digest)
            for e in letters:
                if e in "IR":
                    state = NEXT[state]
                    role_, text_ = SPEAKERS[state], "" if e == "I" else text
                elif e == "K":
                    state, role_, text_ = INITIALS.index(role[0]), role, text
                if e != "D":
                    events.append((c, e, None if e == "I" else turn, role_, text_))
                if e != "I":
                    break
        yield events
    events = []
    for e in letters:
        state = NEXT[state]
        events.append((conv, e, None, SPEAKERS[state], ""))
    if open_:
        events.append((conv, None, None, None, None))
    yield events


def _streamed(rows: DataFrame, solved: DataFrame) -> DataFrame:
    """Texts and pieces of audits, each conversation in one task in order."""
    kind = {c: rows.schema[c].dataType for c in ("conv", *KEY)}
    pieces = solved.select("conv", *[F.col(f"head.{c}").alias(c) for c in KEY], "piece", F.lit(None).cast("string").alias("text"))
    texts = rows.select("conv", *KEY, F.lit(None).cast("string").alias("piece"), "text")
    both = pieces.select(*[F.col(c).cast(kind[c]) if c in kind else c for c in texts.columns]).union(texts)
    return both.repartition("conv").sortWithinPartitions("conv", *KEY, F.col("piece").isNull())


class Repair:
    """The repair of all conversations of ``df``.

    ``report``: one row per conversation that has rows, with the counts, the
    cost and the audit. ``rows()``: the repaired rows. ``digests()``: SHA-256 of
    each repaired conversation, ``role:text`` lines joined by newlines."""

    def __init__(self, df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", segment: int = SEGMENT, fan: int = FAN):
        self._rows = _rows(df, conv_col, turn_col, role_col, text_col)
        segments = cut(_segments(self._rows, segment), "segments")
        self._solved = cut(_solved(segments, fan), "audits")
        drop(segments)
        self._names = {"conv": conv_col, "turn": turn_col, "role": role_col, "text": text_col}

    @property
    def report(self) -> DataFrame:
        x = F.col("parts")
        gap = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
        turns = self._rows.groupBy("conv").agg(F.coalesce(gap, F.lit(0)).cast("bigint").alias("gaps")).select(
            F.col("conv").alias("of"), "gaps")
        sums = ("blank", "duplicate", "truncated", "illegal", "cost")
        whole = self._solved.groupBy("conv").agg(*[F.sum(c).cast("bigint").alias(c) for c in sums], F.array_sort(F.collect_list(
            F.struct("block", "audit", "first_initial", "last_initial"))).alias("parts"))
        pairs = F.zip_with(F.slice(x, 1, F.size(x) - 1), F.slice(x, 2, F.size(x) - 1), lambda a, b: F.struct(
            a["last_initial"].alias("a"), b["first_initial"].alias("b")))
        met = F.size(F.filter(pairs, lambda p: ~_any_legal(p)))
        whole = whole.select("conv", "blank", "duplicate", "truncated",
                             (F.col("illegal") + F.when(F.size(x) > 1, met).otherwise(0)).cast("bigint").alias("illegal"), "cost",
                             F.array_join(F.transform(x, lambda p: p["audit"]), "").alias("audit"))
        out = whole.join(turns, F.col("conv").eqNullSafe(F.col("of")))
        return out.select(F.col("conv").alias(self._names["conv"]), "gaps", *sums[:4], "cost", "audit")

    def rows(self) -> DataFrame:
        """(conversation, place, edit, turn, role, text) of the repaired
        conversations; inserted rows have no turn."""
        df = _streamed(self._rows, self._solved)
        of = {c: df.schema[c].dataType.simpleString() for c in ("conv", "turn")}
        n = self._names
        names = [n["conv"], "place", "edit", n["turn"], n["role"], n["text"]]
        kind = ", ".join(f"`{c}` {t}" for c, t in zip(
            names, [of["conv"], "bigint", "string", of["turn"], "string", "string"], strict=True))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            place = 0
            for events in _edited(_typed(batches, types := [])):
                out = []
                for conv, edit, turn, role, text in events:
                    if edit is None:
                        place = 0
                        continue
                    out.append((conv, place, edit, turn, role, text))
                    place += 1
                if out:
                    cols = list(zip(*out, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, [
                        types[0], pa.int64(), pa.string(), types[1], pa.string(), pa.string()], strict=True)], names=names)

        return df.mapInArrow(run, kind)

    def digests(self) -> DataFrame:
        df = _streamed(self._rows, self._solved)
        names = [self._names["conv"], "repaired_sha256"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sha, lines = hashlib.sha256(), 0
            for events in _edited(_typed(batches, types := [])):
                convs, done = [], []
                for conv, edit, _, role, text in events:
                    if edit is None:
                        convs.append(conv)
                        done.append(sha.hexdigest())
                        sha, lines = hashlib.sha256(), 0
                        continue
                    sha.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                    lines = 1
                if convs:
                    yield pa.RecordBatch.from_arrays([pa.array(convs, types[0]), pa.array(done, pa.string())], names=names)

        return df.mapInArrow(run, f"`{names[0]}` {df.schema['conv'].dataType.simpleString()}, `{names[1]}` string")


def _any_legal(p: Column) -> Column:
    legal = F.lit(False)
    for a, b in sorted(LEGAL):
        legal |= (p["a"] == a) & (p["b"] == b)
    return legal


def _typed(batches: Iterator[pa.RecordBatch], types: list) -> Iterator[pa.RecordBatch]:
    """The batches; ``types`` gets the column types of the first."""
    for batch in batches:
        types[:] = [c.type for c in batch.columns]
        yield batch


def damaged(df: DataFrame) -> DataFrame:
    """Deterministic faults by crc32 of ``conv_id:turn`` modulo 20: 0 drops the
    row, 1 empties the text, 2 removes its sentence ends, 3 repeats the row, 4
    makes its role user."""
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    kind = F.crc32(F.concat(conv, F.lit(":"), turn)) % 20
    text, role = (F.coalesce(F.col(c), F.lit(" ")) for c in ("text", "role"))
    hurt = df.select("conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
                     F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
                     kind.alias("kind")).filter("kind <> 0")
    times = F.when(F.col("kind") == 3, 2).otherwise(1)
    return hurt.withColumn("time", F.explode(F.sequence(F.lit(1), times))).drop("kind", "time")


def op11_conversation_repair(spark, sf_dir):
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    repair = Repair(damaged(given))
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    none = {c: F.lit(None).cast("bigint") for c in counts} | {c: F.lit(None).cast("string") for c in ("audit", "repaired_sha256")}
    parts = [repair.report, repair.digests(), given.select("conv_id").distinct()]
    wide = [p.select("conv_id", *[F.col(c) if c in p.columns else x.alias(c) for c, x in none.items()]) for p in parts]
    all_ = wide[0].union(wide[1]).union(wide[2]).groupBy("conv_id").agg(*[F.max(c).alias(c) for c in none])
    empty = hashlib.sha256(b"").hexdigest()
    return all_.select("conv_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
                       F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
