"""Conversation repair against a search over all edits, with the defined cases."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from orchard.llm import turn_repair
from orchard.llm.common import prepare

SCHEMA = "conv_id long, turn long, role string, text string, c string, code int"
EMPTY = hashlib.sha256().hexdigest()


@pytest.fixture(autouse=True)
def ready(spark):
    prepare(spark)


def damaged(rows):
    out = []
    for c, t, r, x in rows:
        c_, t_ = (" " if v is None else str(v) for v in (c, t))
        r, x = (" " if v is None else v for v in (r, x))
        kind = zlib.crc32(f"{c_}:{t_}".encode()) % 20
        x = {1: "", 2: re.sub("[.!?]", "", x)}.get(kind, x)
        out += [(c, t, "user" if kind == 4 else r, x)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def plain(rows):
    """The contract for one conversation, forward with whole audits and texts in every state."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    seen, faults = set(), []
    for _, _, r, x in rows:
        body = re.sub(r"[\x20\x09-\x0D]+$", "", x)
        faults.append("blank" if not body else "duplicate" if (r, x) in seen else "truncated" if body[-1] not in ".!?" else "none")
        seen.add((r, x))
    pairs = [a[2][:1] + b[2][:1] for a, b in itertools.pairwise(rows)]
    turns = [t for _, t, _, _ in rows if t is not None]
    nxt = {"": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}

    def inserts(best):
        for _ in range(2):
            for q, (cost, audit, said) in list(best.items()):
                put(best, nxt[q], (cost + 3, audit + "I", [*said, name[nxt[q]] + ":"]))
        return best

    def put(best, q, x):
        if q not in best or x[:2] < best[q][:2]:
            best[q] = x

    best = inserts({"": (0, "", [])})
    for (_, _, r, x), fault in zip(rows, faults):
        new = {}
        for q, (cost, audit, said) in best.items():
            put(new, q, (cost + 4, audit + "D", said))
            if fault in ("blank", "duplicate"):
                continue
            cost += 3 * (fault == "truncated")
            put(new, nxt[q], (cost + 3, audit + "R", [*said, f"{name[nxt[q]]}:{x}"]))
            if r[:1] == nxt[q] or (q == "" and r[:1] == "s"):
                put(new, r[:1], (cost, audit + "K", [*said, f"{r}:{x}"]))
        best = inserts(new)
    cost, audit, said = min((v for q, v in best.items() if q in ("", "a")), key=lambda v: v[:2])
    return (min(max(turns) - min(turns) + 1 - len(set(turns)), 2**63 - 1) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())


def check(spark, rows, damage=True):
    df = spark.createDataFrame([(*r, "mine", 1) for r in rows], SCHEMA)
    bad = damaged(rows) if damage else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    got = turn_repair.repair_digests(turn_repair.damage(df) if damage else df, df).collect()
    want = {c: plain([r for r in bad if r[0] == c]) for c in {r[0] for r in rows}}
    assert len(got) == len(want)
    for g in got:
        assert tuple(g)[1:] == want[g.conv_id], g
    return df


def conversations(n, seed, longest=14):
    r = random.Random(seed)
    texts = ["Yes.", "no", "Why? ", " \t\n", "", "Long  ", "done!\n", "。", "a.b", "...", None]
    rows = []
    for c in range(n):
        for t in range(r.randint(1, longest)):
            rows.append((c, r.choice([t, t, t, t, None, t + 5, 3]), r.choice(["user", "assistant"] * 4 + ["system", "tool", "", None, "ursula"]),
                         r.choice(texts) if r.random() < 0.5 else f"said {r.random()}."))
    return rows


def test_against_whole_paths(spark):
    check(spark, conversations(300, 1))
    check(spark, conversations(200, 2, 6), damage=False)


def test_a_hot_conversation_goes_over_many_blocks(spark):
    r = random.Random(4)
    hot = [(7, t, r.choice(["user", "assistant", "assistant", "system"]), f"t{r.randrange(1500)}" + r.choice(["", "."])) for t in range(4000)]
    rows = hot + conversations(6, 3) + [(99, t, ("user", "assistant")[t % 2], "word " * 60_000 + ".") for t in range(3)]
    df = check(spark, rows, damage=False)
    e = turn_repair.ordered(df).where("conv_id = 7")
    sizes = [x["count"] for x in e.groupBy(turn_repair.block_of(e["i"])).count().collect()]
    assert len(sizes) == 12 and max(sizes) <= 2 * (4000 * turn_repair.STEP) ** 0.5     # rows of a block, blocks: about sqrt(n)


def test_nulls_ties_repeats_and_empty_tables(spark):
    check(spark, [(None, None, None, None), (None, 1, "user", "Hi."), (None, 1, "user", "Hi."), (1, None, "assistant", "x"),
                  (2, -2**63, "user", "a."), (2, 2**63 - 1, "assistant", "b."), (3, 0, "system", "only.")], damage=False)
    empty = spark.createDataFrame([], SCHEMA)
    assert turn_repair.repair_digests(empty, empty).count() == 0
    ids = spark.createDataFrame([(5, 0, "user", "x", "", 0), (None, 0, "user", "x", "", 0)], SCHEMA)
    assert sorted(tuple(r)[1:] for r in turn_repair.repair_digests(empty, ids).collect()) == [(0, 0, 0, 0, 0, 0, "", EMPTY)] * 2


def test_repaired_turns_alternate(spark):
    df = spark.createDataFrame([(*r, "", 0) for r in conversations(150, 8)], SCHEMA)
    said = {}
    for r in turn_repair.repaired(turn_repair.repair(df)).orderBy("conv_id", "i", "part").collect():
        said[r.conv_id] = said.get(r.conv_id, "") + r.role[0]
    assert said and all(re.fullmatch("s?(ua)+", x) for x in said.values())


def test_checkpoints_equal_one_block():
    """Vectors recomputed from checkpoints give the walk of a conversation that is one block."""
    rng = np.random.default_rng(1)
    f = np.where(rng.random(900) < 0.1, 1, 2 * (rng.random(900) < 0.2)) + 4 * rng.integers(0, 4, 900)
    one = pa.array([f.tolist()], pa.list_(pa.int8()))
    _, codes = turn_repair.walks(one, turn_repair.finish(1)[:, :, 0])
    cut = np.split(f, [32, 128, 288, 512, 800])
    many = pa.array([c.tolist() for c in cut], pa.list_(pa.int8()))
    tables = turn_repair.block_tables(many)
    behind = turn_repair.checkpoint_vectors(pa.array([tables.reshape(-1).tolist()], pa.list_(pa.int64())))
    ends, parts = turn_repair.walks(many, behind)
    first, _ = turn_repair.first_states(pa.array([ends.reshape(-1).tolist()], pa.list_(pa.int8())))
    own = np.repeat(first, [len(c) for c in cut])
    assert (parts[np.arange(900), own] == codes[:, 0]).all()
