"""Vector codes against measuring every entry, with the defined cases."""

import hashlib
import math
import random

import numpy as np
import pytest

from orchard.llm import vector_codes
from orchard.llm.common import prepare

SCHEMA = "vec_id long, embedding array<double>, label int, code string, _q int"


@pytest.fixture(autouse=True)
def ready(spark):
    prepare(spark)


def plain(rows, parts=16, entries=64):
    ok = [(i, e, lab) for i, e, lab in rows if e and all(x is not None and math.isfinite(x) for x in e)]
    whole = [[max(-2**26, min(2**26, math.floor(256 * x))) for x in e] for _, e, _ in ok]
    order = sorted(range(len(ok)), key=lambda j: (ok[j][0] is None, ok[j][0] or 0, whole[j]))
    width = len(whole[order[0]]) // parts
    cut = [[w[p * width:(p + 1) * width] for p in range(parts)] for w in whole]
    book = [[cut[j][p] for j in order[:entries]] for p in range(parts)]

    def pick(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(book[p]))

    for _ in range(2):
        got = [[pick(p, c[p])[1] for p in range(parts)] for c in cut]
        for p in range(parts):
            new = list(book[p])
            for k in range(len(new)):
                mine = [c[p] for c, g in zip(cut, got) if g[p] == k]
                if mine:
                    new[k] = [sum(x) // len(mine) for x in zip(*mine)]
            book[p] = new
    out, by = [], {}
    for (i, _, lab), c in zip(ok, cut):
        d = [pick(p, c[p]) for p in range(parts)]
        err = sum(x for x, _ in d)
        by[lab] = by.get(lab, 0) + err
        out.append((i, "".join(f"{k:02x}" for _, k in d), err, lab))
    digest = hashlib.sha256(",".join(str(x) for b in book for e in b for x in e).encode()).hexdigest()
    return [(i, code, err, by[lab], digest) for i, code, err, lab in out]


def table(spark, rows):
    return spark.createDataFrame([(i, e, lab, "mine", 1) for i, e, lab in rows], SCHEMA)


def check(spark, rows):
    got = [tuple(r) for r in vector_codes.compress(table(spark, rows)).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])      # noqa: E731
    assert sorted(got, key=key) == sorted(plain(rows), key=key)


def vectors(n, dim, seed=3, spread=0.12):
    r = random.Random(seed)
    hot = [r.gauss(0, spread) for _ in range(dim)]
    rows = []
    for i in range(n):
        e = hot if i % 3 == 0 else [r.gauss(0, spread) for _ in range(dim)]   # a third of all rows is one vector
        rows.append((i * 7 % n, list(e), None if i % 11 == 0 else i % 4))
    return rows


def test_codes_equal_measuring_every_entry(spark):
    check(spark, vectors(700, 64))
    check(spark, vectors(200, 16, spread=3.0))


def test_ties_nulls_and_odd_rows(spark):
    r = random.Random(5)
    rows = [(i, [r.choice([-0.5, 0.0, 0.25, 0.5]) for _ in range(32)], i % 2) for i in range(300)]     # many equal distances
    rows += [(3, rows[3][1], 1)] * 4 + [(None, rows[9][1], None), (400, None, 1), (401, [], 1), (402, [None] + [0.0] * 31, 0),
                                        (403, [float("nan")] * 32, 0), (404, [float("inf")] + [1.0] * 31, 0),
                                        (405, [1e30, -1e300] * 16, 1), (406, [-1e9] * 32, 2)]
    check(spark, rows)
    short = vector_codes.compress(table(spark, rows + [(900, [0.5] * 31, 1), (901, [0.5] * 64, 1)]))
    assert not {900, 901} & {x.vec_id for x in short.collect()}       # another length than the table's


def test_few_rows_empty_tables_and_uneven_lengths(spark):
    check(spark, vectors(5, 16))
    assert vector_codes.compress(table(spark, [])).count() == 0
    assert vector_codes.compress(table(spark, [(1, None, 0)])).count() == 0
    assert vector_codes.compress(table(spark, [(1, [0.5] * 17, 0)])).count() == 0


def test_cells_keep_every_possible_winner():
    rng = np.random.default_rng(1)
    for scale in (3, 40, 5000):
        cells = vector_codes.Cells(rng.integers(-scale, scale, (64, 4)))
        for _ in range(3):                                             # later batches use the memo
            x = rng.integers(-2 * scale, 2 * scale, (4000, 4))
            code, dist = cells.nearest(x)
            full = ((x[:, None, :] - cells.entries[None]) ** 2).sum(2)
            assert (dist == full.min(1)).all() and (code == full.argmin(1)).all()
    assert np.mean([len(e) for _, e in cells.memo.values()]) < 20       # far fewer than 64 are measured


def test_a_shared_cell_hash_is_measured_in_full(monkeypatch):
    monkeypatch.setattr(vector_codes, "mix", lambda k: k & np.uint64(3))
    rng = np.random.default_rng(2)
    cells = vector_codes.Cells(rng.integers(-40, 40, (64, 4)))
    x = rng.integers(-80, 80, (500, 4))
    full = ((x[:, None, :] - cells.entries[None]) ** 2).sum(2)
    code, dist = cells.nearest(x)
    assert (dist == full.min(1)).all() and (code == full.argmin(1)).all()


def test_decode_gives_the_entries_back(spark):
    df = table(spark, vectors(300, 32))
    books = vector_codes.train(df)
    coded = vector_codes.encode_table(df, books)
    got = coded.select("code", vector_codes.decode(coded["code"], books).alias("v")).limit(20).collect()
    for r in got:
        want = np.concatenate([books.book[p, int(r.code[2 * p:2 * p + 2], 16)] for p in range(16)]) / 256
        assert list(want) == list(r.v)
