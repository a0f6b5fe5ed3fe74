"""Mixing sources against a plain sort, with the defined cases."""

import hashlib
import re

import pytest

from orchard.llm import mixing
from orchard.llm.common import prepare

SCHEMA = "doc_id long, text string, source string, size string, target long, _mix_hash int"


@pytest.fixture(autouse=True)
def ready(spark):
    prepare(spark)


def plain(rows, weights=(5, 2, 1), share=1.5, most=2.0):
    """(doc_id, source, size, source_size, target, taken), by sorting whole sources in memory."""
    sized = [(d, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for d, t, s in rows]
    names = sorted({s for _, s, _ in sized}, key=lambda s: (s is None, (s or "").encode()))
    total = {n: sum(z for _, s, z in sized if s == n) for n in names}
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    capped, level = set(), 0.0
    while True:
        rest = sum(total.values()) * share - sum(total[n] * most for n in capped)
        free = sum(weight[n] for n in names if n not in capped)
        level = rest / free if free else float("inf")
        now = {n for n in names if weight[n] * level > total[n] * most}
        if now <= capped:
            break
        capped |= now
    out = []
    for n in names:
        goal = min(weight[n] * level, total[n] * most)
        whole = int(goal // total[n]) if total[n] else 0
        left, below = goal - whole * total[n], 0

        def key(r):
            return int(hashlib.md5(f"{'' if r[0] is None else r[0]}:{r[2]}".encode()).hexdigest()[:15], 16)

        for d, s, z in sorted((r for r in sized if r[1] == n), key=key):
            out.append((d, s, z, total[n], goal, z * (whole + (left > 0 and below + z / 2 <= left))))
            below += z
    return out


def check(spark, rows):
    df = spark.createDataFrame([(d, t, s, "x", 7, 3) for d, t, s in rows], SCHEMA)
    got = [tuple(r) for r in mixing.mix(df).select("doc_id", "source", "size", "source_size", "target", "taken").collect()]
    key = lambda r: tuple((x is None, x) for x in r)      # noqa: E731
    for g, w in zip(sorted(got, key=key), sorted(plain(rows), key=key), strict=True):
        assert g[:4] == w[:4] and g[5] == w[5] and g[4] == pytest.approx(w[4])
    return df, got


def corpus():
    rows = []
    for i in range(3000):                                  # "hot" holds a third of all rows
        source = "hot" if i % 3 == 0 else ["a", "B", "é", "", None, "tiny"][i % 6] if i % 50 else "rare"
        rows.append((i, " ".join(["wörd"] * (i * 7 % 41)) + ("\t\n" if i % 2 else ""), source))
    return rows + [(9000, "long " * 200_000, "a"), (9001, None, "a"), (9002, "", "nothing"), (9003, None, "nothing")]


def test_mix_equals_a_sort(spark):
    _, got = check(spark, corpus())
    by = {}
    for d, s, size, total, goal, taken in got:
        assert taken <= 2 * size
        by.setdefault(s, [goal, 0, 0])[1] += taken
        by[s][2] = max(by[s][2], size)
    assert all(abs(goal - taken) <= most / 2 for goal, taken, most in by.values())


def test_repeated_rows_and_null_ids_meet_the_budget(spark):
    """Rows of one hash are taken one by one: a group of copies without ids is no all-or-nothing."""
    rows = [(None, "one two three", "x")] * 400 + [(5, "four words stand here", "x")] * 300 + [(i, "w " * 50, "y") for i in range(100)]
    _, got = check(spark, rows)
    for name in "xy":
        goal = next(r[4] for r in got if r[1] == name)
        assert abs(sum(r[5] for r in got if r[1] == name) - goal) <= 25


def test_empty_tables_and_one_source(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    _, got = check(spark, [(1, "a b c", "s")])
    check(spark, [(1, "", None), (2, None, None)])
    check(spark, [(None, None, None)])


def test_mix_is_the_same_in_any_layout(spark):
    df, got = check(spark, corpus())
    again = mixing.mix(df.repartition(17)).select("doc_id", "source", "size", "source_size", "target", "taken").collect()
    assert sorted(map(str, got)) == sorted(str(tuple(r)) for r in again)


def test_draw_repeats_rows_with_all_columns(spark):
    rows = corpus()[:600] + [(None, "one two three", "hot")] * 40
    df = spark.createDataFrame([(d, t, s, "x", 7, 3) for d, t, s in rows], SCHEMA)
    drawn = mixing.draw(df)
    assert drawn.columns == df.columns
    got = {}
    for r in drawn.collect():
        got[r.source] = got.get(r.source, 0) + len(re.findall(r"\S+", r.text or ""))
    want = {}
    for _, s, _, _, _, taken in plain(rows):
        want[s] = want.get(s, 0) + taken
    assert got == {s: n for s, n in want.items() if n}


def test_main_path_has_no_python(spark):
    df = mixing.mix(spark.createDataFrame([(1, "a", "s", "x", 7, 3)], SCHEMA))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
