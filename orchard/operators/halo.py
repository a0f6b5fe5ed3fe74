"""Bellman sweeps over grid worlds in blocks with halos.

A cell's value after s sweeps depends on cells at most s steps away.  The
grid is cut into square blocks.  Between exchanges a block is one row of
packed arrays; an exchange sends it, and to each neighbour that exists the
cells within the number of sweeps of that border, and the task that has a
block with this halo runs all those sweeps on it as array operations.  One
exchange thus serves ``HALO`` sweeps, and the values
of a block's own cells are those of plain synchronous sweeps after every one
of them, so the largest change of each sweep comes out exactly as well.

Blocks are addressed by quotient and remainder of the coordinates, so any
64-bit ids work, however far apart.  A task sweeps one block at a time, or
small ones together: (side + 2 halo)^2
cells whatever the size of the grid.  Walls are absent; moves off the map or
into a wall stay; terminal cells have value 0.  Repeated cells count once
(the last one of a block's rows), null coordinates take no part.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchard.operators.mdp import DIRS, P_INTENDED, P_OTHER, grid_states
from orchard.session import cut_lineage

SIDE, HALO = 256, 50
TIE_DECIMALS = 9      # action values equal to so many places go to the first action


def _tiles(c: str, side: int, halo: int):
    """Blocks that hold coordinate ``c`` in their area or halo, each with the place in it (0 .. side + 2 halo - 1)."""
    at = F.pmod(F.col(c), F.lit(side))
    own = F.floor((F.col(c).cast("decimal(20,0)") - at) / F.lit(side)).cast("long")
    place = lambda shift: F.struct((own + shift).alias("t"), (at - shift * side + halo).cast("int").alias("p"))      # noqa: E731
    near = F.array(place(0), F.when(at < halo, place(-1)), F.when(at >= side - halo, place(1)))
    return F.filter(near, lambda s: s.isNotNull())


def _moved(a: np.ndarray, dx: int, dy: int, fill) -> np.ndarray:
    """Value of the neighbour in direction (dx, dy); ``fill`` beyond the block."""
    out = np.full_like(a, fill)
    n = a.shape[0]
    out[max(0, -dx):n - max(0, dx), max(0, -dy):n - max(0, dy)] = a[max(0, dx):n - max(0, -dx), max(0, dy):n - max(0, -dy)]
    return out


class Blocks(NamedTuple):
    """A state table with one row per block: ``(tx, ty, src, near, n, deltas, cells, v[, a])``.

    ``cells`` holds places, rewards and ends of the block's cells (:func:`_static`), ``v`` and ``a`` their values and
    actions in that order.  ``near`` has a bit for every direction of ``AROUND`` in which there may be a block, ``src``
    is the direction a row came from (its own block: the last one).
    """
    table: DataFrame
    kinds: dict[str, str]                     # columns of the cells and their types
    side: int
    parts: int


AROUND = [(dx, dy) for dx in (-1, 0, 1) for dy in (-1, 0, 1) if dx or dy] + [(0, 0)]
OWN = len(AROUND) - 1
CHUNK = 1 << 14                               # cells that are swept at once
TASK = 1 << 18                                # cells of a task


def _static(px: np.ndarray, py: np.ndarray, r: np.ndarray, end: np.ndarray, level: int) -> bytes:
    return zlib.compress(px.astype("<i4").tobytes() + py.astype("<i4").tobytes() + r.astype("<f8").tobytes() + end.astype("u1").tobytes(), level)


def _read(static: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    raw = zlib.decompress(static)
    n = len(raw) // 17
    return (np.frombuffer(raw, "<i4", n), np.frombuffer(raw, "<i4", n, 4 * n), np.frombuffer(raw, "<f8", n, 8 * n),
            np.frombuffer(raw, "u1", n, 16 * n).astype(bool))


def _runs(tx: np.ndarray, ty: np.ndarray) -> np.ndarray:
    """Where the blocks of rows sorted by block begin."""
    return np.flatnonzero(np.append(True, (tx[1:] != tx[:-1]) | (ty[1:] != ty[:-1])))


def _whole(batches):
    """Batches sorted by block as tables of whole blocks."""
    held = []
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([*held, b])
        last = int(_runs(t["tx"].to_numpy(), t["ty"].to_numpy())[-1])
        if last:
            yield t.slice(0, last)
        held = t.slice(last).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _schema(follow: bool) -> str:
    return "tx long, ty long, src int, near int, n int, deltas array<double>, cells binary, v binary" + (", a binary" if follow else "")


def _batch(rows: list[tuple], follow: bool) -> pa.RecordBatch:
    kinds = [("tx", pa.int64()), ("ty", pa.int64()), ("src", pa.int32()), ("near", pa.int32()), ("n", pa.int32()), ("deltas", pa.list_(pa.float64())),
             ("cells", pa.binary()), ("v", pa.binary()), ("a", pa.binary())][:9 if follow else 8]
    return pa.RecordBatch.from_arrays([pa.array([row[i] for row in rows], kind) for i, (_, kind) in enumerate(kinds)], names=[k for k, _ in kinds])


def _pack(follow: bool):
    """Arrow function: cells sorted by block to one row per block."""
    def run(batches):
        for t in _whole(batches):
            tx, ty, px, py, r, end, v = (t[c].to_numpy() for c in ("tx", "ty", "px", "py", "r", "terminal", "v"))
            a = t["a"].to_numpy() if follow else None
            if follow and not ((a >= 0) & (a < len(DIRS))).all():
                raise ValueError("an action is none of the four directions")
            begin = _runs(tx, ty)
            for i, j in zip(begin, [*begin[1:], len(tx)]):
                at = i + np.lexsort((py[i:j], px[i:j]))                   # stable: repeated cells keep their order
                row = (int(tx[i]), int(ty[i]), OWN, (1 << OWN) - 1, j - i, None, _static(px[at], py[at], r[at], end[at], 1), v[at].astype("<f8").tobytes())
                yield _batch([(*row, a[at].astype("u1").tobytes()) if follow else row], follow)
    return run


def _strips(side: int, wide: int, follow: bool):
    """Arrow function: every block, and what lies within ``wide`` of a neighbour's border for that neighbour, in its places."""
    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                out = [tuple(row.values())]
                px, py, r, end = _read(row["cells"])
                v, a = np.frombuffer(row["v"], "<f8"), np.frombuffer(row["a"], "u1") if follow else None
                for k, (dx, dy) in enumerate(AROUND[:OWN]):
                    tx, ty = row["tx"] + dx, row["ty"] + dy
                    if not row["near"] >> k & 1 or not all(-2**63 <= t < 2**63 for t in (tx, ty)):
                        continue
                    at = np.full(len(px), True)
                    for p, d in ((px, dx), (py, dy)):
                        if d:
                            at &= p >= side - wide if d > 0 else p < wide
                    at = np.flatnonzero(at)
                    piece = (tx, ty, AROUND.index((-dx, -dy)), 0, len(at), None, _static(px[at] - dx * side, py[at] - dy * side, r[at], end[at], 0), v[at].tobytes())
                    out.append((*piece, a[at].tobytes()) if follow else piece)
                yield _batch(out, follow)
    return run


def _swept(group, px, py, r, end, v, a, own, sweeps: int, gamma: float, wide: int, side: int, improve: bool):
    """Cells of some blocks with their halos after ``sweeps`` sweeps: values, actions (as they were without ``improve``)
    and the changes of every block, by sweep (the number of changed actions with ``improve``)."""
    size = side + 2 * wide + 1
    key = (group.astype(np.int64) * size + px + wide) * size + py + wide
    order = np.argsort(key, kind="stable")
    key = key[order]
    last = np.append(key[1:] != key[:-1], True)                           # of repeated cells the last one counts
    place = np.empty(len(key), np.int64)
    place[order] = np.cumsum(last) - last
    key, at = key[last], order[last]
    n = len(key)

    first = np.argsort(~(own & ~end)[at], kind="stable")                  # own live cells come first
    mine, rank = int((own & ~end).take(at).sum()), np.empty(n, np.int64)
    rank[first] = np.arange(n)
    to = []
    for _, dx, dy in DIRS:
        step = dx * size + dy
        near = np.minimum(np.searchsorted(key, key + step), n - 1)
        to.append(rank[np.where(key[near] == key + step, near, np.arange(n))[first]])
    place, at = rank[place], at[first]
    r, v, dead = r[at], v[at], np.flatnonzero(end[at])
    act = a[at].astype(np.int64) if a is not None else None
    chosen = np.choose(act, to) if a is not None else None
    u, total, best = np.empty(n), np.empty(n), np.empty(n)
    begin = np.flatnonzero(np.append(True, group[at[1:mine]] != group[at[:mine - 1]])) if mine else np.empty(0, np.int64)
    deltas = []

    def reach(v, picked):
        """Sum of the four neighbours' values, and the best one with ``picked``."""
        v.take(to[0], out=total, mode="clip")
        if picked:
            best[:] = total
        for t in to[1:]:
            v.take(t, out=u, mode="clip")
            np.add(total, u, out=total)
            if picked:
                np.maximum(best, u, out=best)

    for _ in range(sweeps):
        reach(v, chosen is None)
        if chosen is not None:
            v.take(chosen, out=best, mode="clip")
        np.multiply(total, P_OTHER, out=total)
        np.multiply(best, P_INTENDED - P_OTHER, out=best)
        np.add(total, best, out=total)
        np.multiply(total, gamma, out=total)
        np.add(total, r, out=total)
        total[dead] = 0.0
        if mine and not improve:
            np.subtract(total[:mine], v[:mine], out=u[:mine])
            deltas.append(np.maximum.reduceat(np.abs(u[:mine], out=u[:mine]), begin))
        v, total = total, v
    if improve:
        reach(v, False)
        q = np.stack([r + gamma * (P_OTHER * total + (P_INTENDED - P_OTHER) * v.take(t)) for t in to])
        new = np.round(q, TIE_DECIMALS).argmax(0)
        new[dead] = 0
        if mine:
            deltas.append(np.add.reduceat((new != act)[:mine].astype(float), begin))
        act = new
    changes = np.zeros((int(group[-1]) + 1, 1 if improve else sweeps))
    if mine:
        changes[group[at[:mine]][begin]] = np.stack(deltas, 1)
    return v[place], act[place] if act is not None else None, changes


def _block(sweeps: int, gamma: float, side: int, wide: int, follow: bool, improve: bool = False):
    """Arrow function: blocks with their halos, sorted by block, to the blocks after ``sweeps`` sweeps (and a greedy step
    with ``improve``).  Small blocks are swept together."""
    def sweep_all(blocks):
        cells = [_read(p["cells"]) for b in blocks for p in b]
        sizes = [len(c[0]) for c in cells]
        group = np.repeat([g for g, b in enumerate(blocks) for _ in b], sizes)
        own = np.repeat([p["src"] == OWN for b in blocks for p in b], sizes)
        px, py, r, end = (np.concatenate(c) for c in zip(*cells))
        v = np.concatenate([np.frombuffer(p["v"], "<f8") for b in blocks for p in b])
        a = np.concatenate([np.frombuffer(p["a"], "u1") for b in blocks for p in b]) if follow else None
        v, a, changes = _swept(group, px, py, r, end, v, a, own, sweeps, gamma, wide, side, improve)
        begin, g, out = np.cumsum([0, *sizes]), 0, []
        for i, p in enumerate(p for b in blocks for p in b):
            if p["src"] == OWN:
                near = sum(1 << q["src"] for q in blocks[g] if q["src"] != OWN)
                at = slice(begin[i], begin[i + 1])
                row = (p["tx"], p["ty"], OWN, near, p["n"], changes[g].tolist(), p["cells"], v[at].astype("<f8").tobytes())
                out.append((*row, a[at].astype("u1").tobytes()) if follow else row)
                g += 1
        return _batch(out, follow)

    def run(batches):
        held, cells = [], 0
        for t in _whole(batches):
            begin = _runs(t["tx"].to_numpy(), t["ty"].to_numpy())
            for i, j in zip(begin, [*begin[1:], t.num_rows]):
                block = t.slice(i, j - i).to_pylist()
                if all(p["src"] != OWN for p in block):                   # no cell of its own
                    continue
                held.append(block)
                cells += sum(p["n"] for p in block)
                if cells >= CHUNK:
                    yield sweep_all(held)
                    held, cells = [], 0
        if held:
            yield sweep_all(held)

    return run


def blocks(state: DataFrame, side: int = SIDE) -> Blocks:
    """The checkpointed blocks of ``state(x, y, r, terminal, v[, a])``."""
    follow = "a" in state.columns
    cols = ["x", "y", "r", "terminal", "v", *(["a"] if follow else [])]
    t, u = (_tiles(c, side, 0)[0] for c in ("x", "y"))
    tiles = (state.where(F.col("x").isNotNull() & F.col("y").isNotNull())
                  .select(t["t"].alias("tx"), u["t"].alias("ty"), t["p"].alias("px"), u["p"].alias("py"),
                          F.col("r").cast("double").alias("r"), "terminal", F.col("v").cast("double").alias("v"), *cols[5:]))
    table = cut_lineage(tiles.repartition("tx", "ty").sortWithinPartitions("tx", "ty").mapInArrow(_pack(follow), _schema(follow)))
    count, cells = table.agg(F.count(F.lit(1)), F.sum("n")).first()
    parts = max(3 * state.sparkSession.sparkContext.defaultParallelism, (cells or 0) // TASK)
    return Blocks(table, {c: state.schema[c].dataType.simpleString() for c in cols}, side, max(1, min(count, parts)))


def cells_of(state: Blocks) -> DataFrame:
    """The cells ``(x, y, r, terminal, v[, a])`` of blocks."""
    side, follow = state.side, "a" in state.kinds

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                px, py, r, end = _read(row["cells"])
                x, y = (np.full(len(p), row[t]) * side + p for t, p in (("tx", px), ("ty", py)))     # wraps round and back
                out = {"x": x, "y": y, "r": r, "terminal": end, "v": np.frombuffer(row["v"], "<f8")}
                if follow:
                    out["a"] = np.frombuffer(row["a"], "u1").astype(np.int32)
                yield pa.RecordBatch.from_pydict({c: pa.array(col) for c, col in out.items()})

    schema = "x long, y long, r double, terminal boolean, v double" + (", a int" if follow else "")
    return state.table.mapInArrow(run, schema).select(*[F.col(c).cast(kind).alias(c) for c, kind in state.kinds.items()])


def sweep(state: DataFrame | Blocks, sweeps: int, gamma: float, side: int = SIDE, halo: int = HALO,
          improve: bool = False) -> tuple[DataFrame | Blocks, list[float]]:
    """``sweeps`` (at most ``halo``) synchronous sweeps of ``state(x, y, r, terminal, v[, a])`` in one exchange.

    With a column ``a`` the sweeps follow that action, else the best one.
    Returns the checkpointed state (:class:`Blocks` of :func:`blocks` stay blocks) and the largest change of every sweep;
    with ``improve`` (one row of halo more) the actions become greedy for the
    new values, and the list holds the number of actions that changed per block, at most.
    """
    if not 0 < sweeps <= halo - improve < side + 1 - improve:
        raise ValueError("needs 0 < sweeps <= halo <= side")
    if not isinstance(state, Blocks):
        state, change = sweep(blocks(state, side), sweeps, gamma, side, halo, improve)
        return cells_of(state), change
    follow, wide = "a" in state.kinds, sweeps + improve
    out = cut_lineage(state.table.mapInArrow(_strips(side, wide, follow), _schema(follow)).repartition(state.parts, "tx", "ty").sortWithinPartitions("tx", "ty")
                      .mapInArrow(_block(sweeps, gamma, side, wide, follow, improve), _schema(follow)))
    top = out.select(F.posexplode("deltas").alias("i", "d")).groupBy("i").agg(F.max("d").alias("d")).collect()
    change = dict(map(tuple, top))
    return state._replace(table=out), [float(change.get(i, 0.0)) for i in range(1 if improve else sweeps)]


def start(cells: DataFrame, policy: DataFrame | None = None) -> DataFrame:
    """State table of a grid ``(x, y, code)`` at value 0; ``policy(x, y, a)`` fixes the actions."""
    s = grid_states(cells).select("x", "y", "r", "terminal", F.lit(0.0).alias("v"))
    if policy is None:
        return s
    p = policy.select("x", "y", F.col("a").cast("int").alias("a"))
    return s.join(p, ["x", "y"], "left").fillna(0, ["a"])


def values(state: DataFrame) -> DataFrame:
    return state.where(~F.col("terminal")).select("x", "y", "v")


def run_sweeps(state: DataFrame, sweeps: int, gamma: float, side: int = SIDE, halo: int = HALO, tol: float | None = None) -> tuple[DataFrame, list[float]]:
    """M7 / M8: ``sweeps`` sweeps, ``halo`` of them per exchange; with ``tol`` no exchange is begun after a change within it."""
    if sweeps < 1:
        return state, []
    deltas: list[float] = []
    state = blocks(state, side)
    while len(deltas) < sweeps:
        state, new = sweep(state, min(halo, sweeps - len(deltas)), gamma, side, halo)
        deltas += new
        if tol is not None and first_converged(deltas, tol) is not None:
            break
    return cells_of(state), deltas


def first_converged(deltas: list[float], tol: float) -> int | None:
    """The first sweep (from the second on) whose values match those of the sweep before."""
    return next((i for i, d in enumerate(deltas, 1) if i > 1 and d <= tol), None)


def convergence(cells: DataFrame, gamma: float, max_sweeps: int = 149, tol: float = 0.05, stop: bool = True, side: int = SIDE,
                halo: int = HALO) -> tuple[DataFrame, int | None]:
    """M12, value iteration: ``(iter, max_delta, first_converged)`` rows and the first converged sweep (None if none).

    ``stop``: rows end with the first converged sweep.
    """
    _, deltas = run_sweeps(start(cells), max_sweeps, gamma, side, halo, tol if stop else None)
    first = first_converged(deltas, tol)
    rows = [(i, d, first) for i, d in enumerate(deltas, 1) if not (stop and first is not None and i > first)]
    return cells.sparkSession.createDataFrame(rows, "iter INT, max_delta DOUBLE, first_converged INT"), first


def policy_iteration(cells: DataFrame, gamma: float, e_iters: int, p_iters: int, side: int = SIDE, halo: int = HALO) -> tuple[DataFrame, int]:
    """M10 in blocks: ``e_iters`` sweeps under the policy, then a greedy step in the same exchange, until no action
    changes or ``p_iters`` rounds.  Returns the state (values and actions) and the rounds."""
    state = blocks(start(cells).withColumn("a", F.lit(0)), side)        # greedy for value 0: the first action
    rounds = 0
    while rounds < p_iters:
        rounds += 1
        left = e_iters
        while left > halo - 1:
            state, _ = sweep(state, min(left - 1, halo), gamma, side, halo)
            left -= min(left - 1, halo)
        state, changed = sweep(state, left, gamma, side, halo, improve=True)
        if not changed[0]:
            break
    return cells_of(state), rounds


def policy_convergence(cells: DataFrame, gamma: float, most: int = 149, tol: float = 0.05, side: int = SIDE,
                       halo: int = HALO) -> tuple[DataFrame, int | None]:
    """M12, policy iteration: run i is i rounds of i sweeps at most, from value 0; rows ``(iter, rounds, max_delta,
    first_converged)`` up to the first run whose values match those of the run before (None if none)."""
    rows, last, first = [], None, None
    for i in range(1, most + 1):
        state, rounds = policy_iteration(cells, gamma, i, i, side, halo)
        v = values(state)
        if last is None:
            delta = v.agg(F.max(F.abs("v"))).first()[0]
        else:
            delta = v.join(last.withColumnRenamed("v", "_v"), ["x", "y"]).agg(F.max(F.abs(F.col("v") - F.col("_v")))).first()[0]
        rows.append((i, rounds, float(delta or 0.0)))
        last = v
        if i > 1 and rows[-1][2] <= tol:
            first = i
            break
    return cells.sparkSession.createDataFrame([(*r, first) for r in rows], "iter INT, rounds INT, max_delta DOUBLE, first_converged INT"), first


# ------------------------------------------------------------------ components (M5)
def _label(side: int):
    """Pandas function: every cell of a block with the first cell (by place) of its component inside the block."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        px, py = pdf["px"].to_numpy(), pdf["py"].to_numpy()
        open_ = np.zeros((side, side), bool)
        open_[px, py] = True
        label = np.where(open_, np.arange(side * side).reshape(side, side), side * side)
        may = [open_ & _moved(open_, dx, dy, False) for _, dx, dy in DIRS]
        while True:
            low = np.minimum.reduce([label, *[np.where(ok, _moved(label, dx, dy, side * side), label) for ok, (_, dx, dy) in zip(may, DIRS)]])
            flat = np.append(low.ravel(), side * side)
            low = flat[low]                                               # a label's own label: long ways halve
            if (low == label).all():
                break
            label = low
        at = label[px, py]
        row = np.full(side * side, -1)
        row[px * side + py] = np.arange(len(pdf))
        root = row[at]
        return pdf.assign(rx=pdf["x"].to_numpy()[root], ry=pdf["y"].to_numpy()[root])[["x", "y", "px", "py", "rx", "ry"]]
    return run


def block_components(cells: DataFrame, side: int = 64) -> tuple[DataFrame, DataFrame]:
    """``cells(x, y)`` with the root ``(rx, ry)`` of their component inside their block (checkpointed), and the pairs of
    roots ``(rx, ry, sx, sy)`` whose components touch across a border."""
    kind = {f.name: f.dataType.simpleString() for f in cells.schema}
    t, u = (_tiles(c, side, 0)[0] for c in ("x", "y"))
    tiles = (cells.where(F.col("x").isNotNull() & F.col("y").isNotNull())
                  .select("x", "y", t["t"].alias("tx"), u["t"].alias("ty"), t["p"].alias("px"), u["p"].alias("py")))
    schema = f"x {kind['x']}, y {kind['y']}, px int, py int, rx {kind['x']}, ry {kind['y']}"
    out = cut_lineage(tiles.groupBy("tx", "ty").applyInPandas(_label(side), schema))
    pairs = []
    for place, dx, dy in (("px", 1, 0), ("py", 0, 1)):
        last = out.where(F.col(place) == side - 1).select("rx", "ry", F.try_add(F.col("x"), F.lit(dx)).alias("x"), F.try_add(F.col("y"), F.lit(dy)).alias("y"))
        first = out.where(F.col(place) == 0).select("x", "y", F.col("rx").alias("sx"), F.col("ry").alias("sy"))
        pairs.append(last.join(first, ["x", "y"]).select("rx", "ry", "sx", "sy"))
    return out.select("x", "y", "rx", "ry"), cut_lineage(pairs[0].unionByName(pairs[1]).distinct())
