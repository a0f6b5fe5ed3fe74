"""Conversation structure repair by a square-root checkpointed dynamic programme.

The turns of a conversation are kept, reroled or deleted, and empty turns are
inserted, at the least cost that makes the role initials ``(s?(ua)+)?``.
Four states say what may follow (nothing yet, after s, after u, after a); a
row's cost vector holds the least cost to finish from each state before that
row.  Of the cheapest edits the ASCII-least string of initials (D < I < K < R)
is emitted, which a walk forward finds by taking the least edit that is tight
against the vectors.

Vectors are not stored for every row.  Rows are cut into blocks that grow
with their place (block b starts at row ``STEP * b^2``), so a conversation of
n rows has about sqrt(n) blocks of at most about sqrt(n) rows, and only the
vectors between blocks, the checkpoints, are stored:

1. every block becomes a 4 x 4 table of least costs from its first state to
   its last one (blocks are independent tasks);
2. one conversation's tables, sqrt(n) of them, give the checkpoint vectors
   from the last block to the first;
3. every block recomputes its vectors from the checkpoint behind it and walks
   forward from each of the four states;
4. following the walks' last states over the blocks gives each block's first
   state, and with it its edits.

No task holds a conversation: a group is a block's one-byte features or a
conversation's sqrt(n) tables.  Texts only pass by: they are ordered, looked
up for repeats by their digest and joined to their edits.  ``digests`` must
hash a conversation's texts in order; it streams them through a task sorted,
holding one row at a time and the edits' initials.

Defined cases: null role and null text are one space; a role's initial is its
first letter, and a role that starts with none of s, u, a (the empty one too)
can only be reroled or deleted; rows are ordered by turn, nulls first, ties
by role and text; repeated rows are all kept and all but the first are
duplicates; a null conversation id is one conversation; gaps that pass a
long are the largest long; long texts are used whole; an empty table gives no
rows.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orchard.llm.common import saved, shuffle_partitions
from orchard.operators.ordering import row_index

STEP = 32
INSERT, REROLE, DELETE, TRUNCATED = 3, 3, 4, 3
ROLES = ("system", "user", "assistant")
SPACE = r"\x20\x09-\x0D"
#: The state that an inserted or reroled turn leads to, from each state.
NEXT = np.array([2, 2, 3, 2])
#: The state that a kept turn leads to, by initial (none, s, u, a) and state; -1: not allowed.
KEEP = np.array([[-1, -1, -1, -1], [1, -1, -1, -1], [2, 2, -1, 2], [-1, -1, 3, -1]])
_FAR = 1 << 40
#: Turns that must follow the last row, by state.
_TAIL = (0, 2, 1, 0)
_MOST_LONG = (1 << 63) - 1


def damage(df: DataFrame) -> DataFrame:
    """The damage of the query, by crc32 of ``conv_id:turn`` modulo 20 (nulls are one space)."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))      # noqa: E731
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    rows = df.select("conv_id", "turn", part("role").alias("role"), part("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.explode(times).alias("copy")).drop("copy")


def block_of(row: Column) -> Column:
    return F.floor(F.sqrt(row / F.lit(float(STEP)))).cast("long")


def _conversation(c: Column) -> Column:
    """A key that is never null."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


def ordered(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(c, conv_id, turn, role, text, i, fault, feature)``: place and first fault of every row."""
    said = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))      # noqa: E731
    rows = df.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), said(role).alias("role"), said(text).alias("text"))
    key = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)
    rows = rows.select(_conversation(F.col("conv_id")).alias("c"), "*", key.alias("key"))
    # short sort keys: range bounds are sampled to the driver; the digest settles the rest
    order = [F.col("turn").asc_nulls_first(), F.left("role", F.lit(64)), F.left("text", F.lit(64)), F.col("key")]
    rows = saved(row_index(rows, order, by=["c"], name="i"))
    repeats = (rows.groupBy("c", "key").agg(F.min("i").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
                   .select(F.col("c").alias("rc"), F.col("key").alias("rk"), "first"))
    rows = rows.join(repeats, (F.col("c") == F.col("rc")) & (F.col("key") == F.col("rk")), "left")
    fault = (F.when(~F.col("text").rlike(f"[^{SPACE}]"), "blank").when(F.col("i") > F.col("first"), "duplicate")
              .when(~F.col("text").rlike(rf"[.!?][{SPACE}]*\z"), "truncated").otherwise("none"))
    rows = rows.withColumn("fault", fault)
    initial = F.coalesce(F.array_position(F.array(*[F.lit(r[0]) for r in ROLES]), F.left("role", F.lit(1))), F.lit(0))
    feature = F.col("fault").isin("blank", "duplicate").cast("int") + 2 * (F.col("fault") == "truncated").cast("int") + 4 * initial
    return rows.select("c", "conv_id", "turn", "role", "text", "i", "fault", feature.cast("byte").alias("feature"))


# ------------------------------------------------------------------ dynamic programme over blocks


def _step(feature: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Costs before a row, (items, 4 states, ends), from those after it."""
    must, cut, initial = feature & 1, (feature >> 1) & 1, feature >> 2
    keep = KEEP[initial]
    kept = np.take_along_axis(after, np.maximum(keep, 0)[:, :, None], 1)
    kept = np.where(keep[:, :, None] < 0, _FAR, kept)
    used = np.minimum(kept, REROLE + after[:, NEXT, :]) + TRUNCATED * cut[:, None, None]
    best = np.minimum(DELETE + after, np.where(must[:, None, None] == 1, _FAR, used))
    return with_inserts(np.minimum(best, _FAR))


def with_inserts(best: np.ndarray) -> np.ndarray:
    """Turns may be inserted before anything else happens."""
    u, a = np.minimum(best[:, 2], INSERT + best[:, 3]), np.minimum(best[:, 3], INSERT + best[:, 2])
    return np.stack([np.minimum(best[:, 0], INSERT + u), np.minimum(best[:, 1], INSERT + u), u, a], 1)


def finish(items: int) -> np.ndarray:
    """Costs behind the last row: the roles must be complete."""
    return np.tile(np.array([0, 2 * INSERT, INSERT, 0], np.int64)[None, :, None], (items, 1, 1))


def _ragged(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(flat values, starts, lengths) of a list column."""
    off = column.offsets.to_numpy().astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat, off[:-1] - off[0], np.diff(off)


def _backward(starts: np.ndarray, lengths: np.ndarray, behind: np.ndarray, step, keep: np.ndarray | None = None) -> np.ndarray:
    """All items at once, from their last place to the first: ``step(places, costs after)``.

    ``keep`` (places, 4) gets every place's vector.
    """
    order = np.argsort(-lengths, kind="stable")
    starts, lengths, cost = starts[order], lengths[order], behind[order].copy()
    for back in range(1, int(lengths[0]) + 1 if len(lengths) else 0):
        live = int(np.searchsorted(-lengths, -back, side="right"))
        at = starts[:live] + lengths[:live] - back
        cost[:live] = step(at, cost[:live])
        if keep is not None:
            keep[at] = cost[:live, :, 0]
    out = np.empty_like(cost)
    out[order] = cost
    return out


def block_tables(features: pa.ListArray) -> np.ndarray:
    """Least cost of every block from each first state to each last state, (blocks, 16)."""
    flat, starts, lengths = _ragged(features)
    unit = np.where(np.eye(4, dtype=bool), 0, _FAR).astype(np.int64)
    got = _backward(starts, lengths, np.tile(unit[None], (len(starts), 1, 1)), lambda at, cost: _step(flat[at], cost))
    return got.reshape(len(starts), 16)


def checkpoint_vectors(tables: pa.ListArray) -> np.ndarray:
    """Of conversations as flat lists of their blocks' tables: the vector behind every block, (blocks, 4)."""
    flat, starts, lengths = _ragged(tables)
    table, starts, lengths = flat.reshape(-1, 4, 4), starts // 16, lengths // 16
    behind = np.zeros((len(table), 4), np.int64)

    def step(at, cost):
        behind[at] = cost[:, :, 0]
        # a block's table ends before the inserts of the next block; the vector behind it holds them
        return np.minimum(table[at] + cost[:, None, :, 0], _FAR).min(2)[:, :, None]

    _backward(starts, lengths, finish(len(starts)), step)
    return behind


def walks(features: pa.ListArray, behind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From each of the four first states of every block: the last states (blocks, 4) and the
    edits (rows, 4) as ``state * 9 + inserted turns * 3 + (0 delete, 1 keep, 2 rerole)``."""
    flat, starts, lengths = _ragged(features)
    vector = np.zeros((len(flat), 4), np.int64)
    _backward(starts, lengths, behind[:, :, None], lambda at, cost: _step(flat[at], cost), keep=vector)
    order = np.argsort(-lengths, kind="stable")
    state = np.tile(np.arange(4), (len(starts), 1))
    codes = np.zeros((len(flat), 4), np.int8)
    for t in range(int(lengths.max()) if len(lengths) else 0):
        live = order[:int(np.searchsorted(-lengths[order], -t, side="left"))]
        at = starts[live] + t
        here = vector[at]
        last = lengths[live] == t + 1
        after = np.where(last[:, None], behind[live], vector[np.minimum(at + 1, len(flat) - 1)])
        f = flat[at]
        q = state[live]
        first, inserted, edit = q.copy(), np.zeros_like(q), np.full_like(q, -1)
        for _ in range(3):                                           # two inserted turns at most, then the row
            now = np.take_along_axis(here, q, 1)
            kept = np.take_along_axis(KEEP[f >> 2], q, 1)
            extra = TRUNCATED * ((f >> 1) & 1)[:, None]
            free = ((f & 1) == 0)[:, None]
            todo = edit < 0
            delete = todo & (DELETE + np.take_along_axis(after, q, 1) == now)
            insert = todo & ~delete & (INSERT + np.take_along_axis(here, NEXT[q], 1) == now)
            keep = todo & ~delete & ~insert & free & (kept >= 0) & (
                extra + np.take_along_axis(after, np.maximum(kept, 0), 1) == now)
            rerole = todo & ~delete & ~insert & ~keep
            edit = np.where(delete, 0, np.where(keep, 1, np.where(rerole, 2, edit)))
            inserted = inserted + insert
            q = np.where(keep, kept, np.where(rerole | insert, NEXT[q], q))
        codes[at] = first * 9 + inserted * 3 + edit
        state[live] = q
    return state, codes


def first_states(ends: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Of conversations as flat lists of their blocks' last states: every block's first state, and the last state of each."""
    flat, starts, lengths = _ragged(ends)
    table, starts, lengths = flat.reshape(-1, 4), starts // 4, lengths // 4
    first, state = np.zeros(len(table), np.int64), np.zeros(len(starts), np.int64)
    for t in range(int(lengths.max()) if len(lengths) else 0):
        live = lengths > t
        at = starts[live] + t
        first[at] = state[live]
        state[live] = table[at, state[live]]
    return first, state


def _lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    off = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off), pa.array(values.reshape(-1), type=kind))


def edits(rows: DataFrame) -> DataFrame:
    """``(c, i, code, tail)`` of every row of :func:`ordered`; ``tail``: turns inserted behind a conversation's last row."""
    features = F.transform(F.sort_array(F.collect_list(F.struct("i", "feature"))), lambda x: x["feature"])
    blocks = saved(rows.groupBy("c", block_of(F.col("i")).alias("b")).agg(features.alias("f")))

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            m = block_tables(x.column("f"))
            yield pa.RecordBatch.from_arrays([x.column("c"), x.column("b"), _lists(m, np.full(len(m), 16), pa.int64())], names=["c", "b", "m"])

    in_order = F.sort_array(F.collect_list(F.struct("b", "m")))
    convs = (blocks.mapInArrow(tables, "c string, b long, m array<long>").groupBy("c")
                   .agg(F.flatten(F.transform(in_order, lambda x: x["m"])).alias("m")))

    def checkpoints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            v = checkpoint_vectors(x.column("m"))
            n = np.diff(x.column("m").offsets.to_numpy()) // 16
            b = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield pa.RecordBatch.from_arrays([x.column("c").take(pa.array(np.repeat(np.arange(len(n)), n))), pa.array(b, pa.int64()),
                                              _lists(v, np.full(len(v), 4), pa.int64())], names=["c", "b", "v"])

    behind = convs.mapInArrow(checkpoints, "c string, b long, v array<long>")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            ends, codes = walks(x.column("f"), x.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, 4).astype(np.int64))
            n = np.diff(x.column("f").offsets.to_numpy())
            yield pa.RecordBatch.from_arrays([x.column("c"), x.column("b"), _lists(ends, np.full(len(ends), 4), pa.int8()),
                                              _lists(codes, n * 4, pa.int8())], names=["c", "b", "ends", "codes"])

    walked = saved(blocks.join(behind, ["c", "b"]).select("c", "b", "f", "v")
                         .mapInArrow(walk, "c string, b long, ends array<tinyint>, codes array<tinyint>"))
    in_order = F.sort_array(F.collect_list(F.struct("b", "ends")))
    chains = walked.groupBy("c").agg(F.flatten(F.transform(in_order, lambda x: x["ends"])).alias("ends"))

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            first, last = first_states(x.column("ends"))
            n = np.diff(x.column("ends").offsets.to_numpy()) // 4
            end = np.cumsum(n)
            tail = np.zeros(len(first), np.int32)
            tail[end - 1] = np.array(_TAIL)[last]
            yield pa.RecordBatch.from_arrays([x.column("c").take(pa.array(np.repeat(np.arange(len(n)), n))),
                                              pa.array(np.arange(len(first)) - np.repeat(end - n, n), pa.int64()),
                                              pa.array(first, pa.int32()), pa.array(tail, pa.int32())], names=["c", "b", "q", "tail"])

    started = chains.mapInArrow(chain, "c string, b long, q int, tail int")
    base = F.col("b") * F.col("b") * STEP
    own = F.filter(F.col("codes"), lambda _, j: F.pmod(j, F.lit(4)) == F.col("q"))
    each = walked.join(started, ["c", "b"]).select("c", base.alias("base"), "tail", F.size("codes").alias("n4"), F.posexplode(own))
    return each.select("c", (F.col("base") + F.col("pos")).alias("i"), F.col("col").cast("int").alias("code"),
                       F.when((F.col("pos") + 1) * 4 == F.col("n4"), F.col("tail")).otherwise(0).alias("tail"))


def repair(df: DataFrame, **columns) -> DataFrame:
    """Every row with its edit: ``(c, conv_id, i, turn, role, text, fault, code, tail, edit, before, new_role, behind)``.

    ``before`` / ``behind``: roles of the empty turns inserted before and
    behind the row; ``edit``: K, R or D; ``new_role``: the role that a row
    that stays has in the repaired conversation.
    """
    rows = saved(ordered(df, **columns))
    e = edits(rows.select("c", "i", "feature")).withColumnsRenamed({"c": "ec", "i": "ei"})
    both = rows.join(e, (F.col("c") == F.col("ec")) & (F.col("i") == F.col("ei"))).drop("ec", "ei", "feature")
    state, inserted, edit = F.floor(F.col("code") / 9), F.floor(F.col("code") / 3) % 3, F.col("code") % 3
    turns = F.array(F.lit("user"), F.lit("assistant"), F.lit("user"), F.lit("assistant"))
    first = F.when(state == 2, 2).otherwise(1)                       # after u comes a, else u
    return both.select("*", F.element_at(F.array(F.lit("D"), F.lit("K"), F.lit("R")), (edit + 1).cast("int")).alias("edit"),
                       F.slice(turns, first, inserted.cast("int")).alias("before"),
                       F.when(edit == 1, F.col("role")).when(edit == 2, F.element_at(turns, (first + inserted).cast("int"))).alias("new_role"),
                       F.slice(F.array(F.lit("user"), F.lit("assistant")), F.when(F.col("tail") == 1, 2).otherwise(1), F.col("tail")).alias("behind"))


def repaired(edited: DataFrame) -> DataFrame:
    """The repaired turns ``(conv_id, i, part, role, text)``, ordered by (i, part) within a conversation."""
    turn = lambda role, text: F.struct(role.alias("role"), text.alias("text"))      # noqa: E731
    empty = lambda roles: F.transform(roles, lambda r: turn(r, F.lit("")))      # noqa: E731
    own = F.when(F.col("edit") != "D", F.array(turn(F.col("new_role"), F.col("text")))).otherwise(F.array().cast("array<struct<role:string,text:string>>"))
    parts = F.concat(empty(F.col("before")), own, empty(F.col("behind")))
    return edited.select("conv_id", "i", F.posexplode(parts).alias("part", "t")).select("conv_id", "i", "part", "t.role", "t.text")


def digests(edited: DataFrame) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)`` of every conversation that has rows."""
    kind = edited.schema["conv_id"].dataType.simpleString()
    schema = (f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
              "audit string, repaired_sha256 string")
    turns = lambda name: F.transform(F.col(name), lambda r: F.concat(r, F.lit(":")))      # noqa: E731
    own = F.when(F.col("edit") != "D", F.array(F.concat("new_role", F.lit(":"), "text"))).otherwise(F.array().cast("array<string>"))
    said = F.concat(turns("before"), own, turns("behind"))
    audit = F.concat(F.repeat(F.lit("I"), F.size("before")), "edit", F.repeat(F.lit("I"), F.size("behind")))
    narrow = edited.select("c", "conv_id", "i", F.col("turn").cast("long").alias("turn"), F.left("role", F.lit(1)).alias("initial"), "fault",
                           F.size(said).alias("n"), audit.alias("audit"), F.array_join(said, "\n").alias("said"))
    narrow = narrow.repartition(shuffle_partitions(edited.sparkSession), "c").sortWithinPartitions("c", "i")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for x in batches:
            done = []
            cols = [x.column(n) for n in ("c", "conv_id", "turn", "initial", "fault", "n", "audit", "said")]
            for a in range(0, x.num_rows, 256):
                for c, conv, turn, initial, fault, n, audit, text in zip(*[col.slice(a, 256).to_pylist() for col in cols]):
                    if now is None or now.c != c:
                        done += [now.row()] if now else []
                        now = _Tally(c, conv)
                    now.add(turn, initial, fault, n, audit, text)
            if done:
                yield _batch(done, like)
        if now:
            yield _batch([now.row()], like)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    like = to_arrow_schema(_parse_datatype_string(schema))
    return narrow.mapInArrow(stream, schema)


def _batch(rows: list[tuple], like: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), like)], schema=like)


class _Tally:
    """Counts, edits and the running hash of one conversation."""

    def __init__(self, c: str, conv):
        self.c, self.conv = c, conv
        self.count = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.low = self.high = self.before = None
        self.turns = self.illegal = self.cost = 0
        self.audit: list[str] = []
        self.hash, self.any = hashlib.sha256(), False

    def add(self, turn, initial, fault, n, audit, text) -> None:
        if turn is not None and turn != self.high:                    # sorted by turn
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        if fault in self.count:
            self.count[fault] += 1
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        self.audit.append(audit)
        self.cost += (DELETE * audit.count("D") + INSERT * audit.count("I") + REROLE * audit.count("R")
                      + TRUNCATED * (fault == "truncated" and "D" not in audit))
        if n:
            self.hash.update((("\n" if self.any else "") + text).encode())
            self.any = True

    def row(self) -> tuple:
        gaps = min(self.high - self.low + 1 - self.turns, _MOST_LONG) if self.turns else 0
        return (self.conv, gaps, self.count["blank"], self.count["duplicate"], self.count["truncated"], self.illegal, self.cost,
                "".join(self.audit), self.hash.hexdigest())


def repair_digests(damaged: DataFrame, convs: DataFrame) -> DataFrame:
    """:func:`digests` for every id of ``convs``; an id without rows has zeros, no edits and the hash of nothing."""
    got = digests(repair(damaged)).withColumnRenamed("conv_id", "_c")
    ids = convs.select("conv_id").distinct()
    both = ids.join(got, ids["conv_id"].eqNullSafe(got["_c"]), "left").drop("_c")
    return both.fillna(0, [c for c in both.columns if c not in ("conv_id", "audit", "repaired_sha256")]).fillna(
        {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()})
