"""Pair operators against brute force, with the defined cases."""

import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from orchard.llm import decontaminate, embedding_dedup, jaccard_join, pairs, substring_dedup
from orchard.llm.common import prepare
from orchard.llm.graph import components

DOCS = "doc_id long, text string, class_id string, h long, `_drop_id` string"


@pytest.fixture(autouse=True)
def ready(spark):
    prepare(spark)


def words(t):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", (t or "").lower())


def shingles(t):
    w = words(t)
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


def corpus(seed=1, n=30):
    """Random texts with exact copies, near copies, ties, empty, null and very long ones."""
    r = random.Random(seed)
    vocab = [f"w{i}é" for i in range(300)]
    rows, base = [], []
    for i in range(n):
        base.append([r.choice(vocab) for _ in range(r.choice([3, 6, 40, 80, 120]))])
        rows.append(" ".join(base[-1]))
    for b in base[:12]:
        for _ in range(6):
            c = list(b)
            for _ in range(r.randint(0, 3)):
                c[r.randrange(len(c))] = r.choice(vocab)
            rows.append(" ".join(c))
    rows += [rows[3]] * 5 + [rows[4].upper() + " !!"] + ["", None, "  \n ", "only four words here", "only four words here"]
    rows += [" ".join(r.choice(vocab) for _ in range(30_000))]
    return list(enumerate(rows))


def groups(n, links):
    root = list(range(n))
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 5, None) for i, t in rows], DOCS)


@pytest.mark.parametrize("limit,block", [(1024, 1024), (4, 3)])
def test_jaccard_join_is_brute_force(spark, monkeypatch, limit, block):
    monkeypatch.setattr(pairs, "BLOCK", block)
    rows = corpus()
    sets = [shingles(t) for _, t in rows]
    links = [(a, b) for a, b in itertools.combinations(range(len(rows)), 2) if sets[a] and sets[b]
             and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    cls = groups(len(rows), links)
    got = {r.doc_id: r for r in jaccard_join.jaccard_join(frame(spark, rows), limit=limit).collect()}
    assert len(got) == len(rows)
    assert [got[i].class_id for i in range(len(rows))] == cls
    assert [got[i].n_links for i in range(len(rows))] == [sum(i in x for x in links) for i in range(len(rows))]


def test_jaccard_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, "q r s t u"), (2, None)]
    df = frame(spark, rows)
    got = sorted(map(tuple, jaccard_join.jaccard_join(df).collect()), key=str)
    assert got == sorted([(1, 1, 1, 2, 0), (1, 1, 1, 2, 0), (None, 1, 1, 2, 0), (None, None, None, 0, 0),
                          (2, 2, 2, 0, 0)], key=str)
    kept = jaccard_join.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in kept.where("doc_id is not null").collect()) == [(1, "a b c d e f"), (2, None)]
    assert kept.where("doc_id is null").count() == 2
    assert jaccard_join.jaccard_join(df.limit(0)).count() == 0


def test_runs_reach_the_recall():
    assert 1 - (1 - 0.8 ** 3) ** jaccard_join.runs_for(0.999, 0.8, 3) >= 0.999
    bands, rows = substring_dedup.tune_bands()
    assert 1 - (1 - 0.8 ** rows) ** bands >= 0.999


@pytest.mark.parametrize("seed", range(5))
def test_pairs_meet_once(seed):
    import pyarrow as pa
    r = np.random.default_rng(seed)
    n, block = 23, 5
    nb = math.ceil(n / block)
    blk = r.integers(0, nb, n)
    rows = sorted((min(blk[i], o), max(blk[i], o), blk[i], i) for i in range(n) for o in range(nb))
    t = pa.table({"slot": [0] * len(rows), "key": [9] * len(rows), "lo": [int(x[0]) for x in rows],
                  "hi": [int(x[1]) for x in rows], "blk": [int(x[2]) for x in rows],
                  "slots": pa.array([[{"slot": 0, "key": 9, "size": n}]] * len(rows))})
    met = []
    for a, b in pairs.Pairs(t, 1):
        met += [tuple(sorted((rows[i][3], rows[j][3]))) for i, j in zip(a, b)]
    assert sorted(met) == list(itertools.combinations(range(n), 2))


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1100)] + [(5, None)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    root = groups(1200, [(a, b) for a, b in edges if b is not None])
    assert all(root[x] == y for x, y in got.items())
    assert {a for a, b in edges if b is not None and a != b} <= set(got)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("bucket,block", [(1024, 1024), (8, 5)])
def test_embeddings_are_brute_force(spark, monkeypatch, bucket, block):
    monkeypatch.setattr(pairs, "BLOCK", block)
    r = np.random.default_rng(5)
    rows = []
    for i in range(60):
        v = r.standard_normal(16)
        for _ in range(3):
            rows.append(((v + r.standard_normal(16) * r.choice([0.0, 0.04, 0.06])).tolist(), i % 3))
    rows += [(rows[0][0], None), (None, 1), ([0.0] * 16, 1), ([float("nan")] + [1.0] * 15, 1), ([float("inf")] * 16, 1),
             ([None] + [1.0] * 15, 1), ([], 1), (rows[0][0][:8], 0), ((np.array(rows[0][0]) * 1e-200).tolist(), 0)]
    df = spark.createDataFrame([(i, v, k, "z") for i, (v, k) in enumerate(rows)],
                               "vec_id long, embedding array<double>, label int, id string")
    def good(v, k):
        return k is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    def cos(a, b):
        a, b = np.array(a) / np.abs(a).max(), np.array(b) / np.abs(b).max()
        return a @ b / (np.linalg.norm(a) * np.linalg.norm(b))
    links = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2) if good(*rows[i]) and good(*rows[j])
             and rows[i][1] == rows[j][1] and len(rows[i][0]) == len(rows[j][0]) and cos(rows[i][0], rows[j][0]) >= 0.98]
    comp = groups(len(rows), links)
    got = {x.vec_id: x for x in embedding_dedup.near_duplicates(df, bucket=bucket).collect()}
    assert [got[i].component_id for i in range(len(rows))] == comp
    assert [got[i].n_links for i in range(len(rows))] == [sum(i in x for x in links) for i in range(len(rows))]
    assert all(x.kept == (x.vec_id == x.component_id) for x in got.values())
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def words_outside(spans, rows):
    """Words of every (id, text) row without those of the removed spans."""
    version = {(x.doc_id, x.text): x.version for x in
               frame(spans.sparkSession, rows).withColumn("version", F.xxhash64("text")).collect()}
    gone = {}
    for x in spans.where("removed").collect():
        gone.setdefault((x.doc_id, x.version), set()).update(range(x.first_word, x.first_word + x.words))
    return sorted((str(i), [w for k, w in enumerate(words(t or "")) if k not in gone.get((i, version[i, t]), ())])
                  for i, t in rows)


def test_substring_dedup_is_brute_force(spark):
    r = random.Random(9)
    vocab = [f"v{i}" for i in range(200)]
    passage = [" ".join(r.choice(vocab) for _ in range(60)) for _ in range(4)]
    near = passage[0].split()
    near[30] = "changed"
    texts = [passage[0] + "\nunique line " + str(i) if i < 5 else "\n".join(["short line", passage[i % 4]]) for i in range(9)]
    texts += [" ".join(near), passage[2], passage[3] + "\n" + passage[3], "short line", None, "", "short line\n"]
    rows = list(enumerate(texts)) + [(0, texts[0])]
    got = substring_dedup.repeats(frame(spark, rows)).collect()
    occ = sorted({(i, p, ln) for i, t in rows for p, ln in enumerate((t or "").split("\n")) if len(words(ln)) >= 40})
    sets = [shingles(x[2]) for x in occ]
    links = [(a, b) for a, b in itertools.combinations(range(len(occ)), 2)
             if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    root = groups(len(occ), links)
    want = {(occ[i][0], occ[i][1]): occ[root[i]][:2] for i in range(len(occ)) if sum(x == root[i] for x in root) > 1}
    assert {(x.doc_id, x.para): (x.cluster_doc_id, x.cluster_para) for x in got} == want
    assert all(x.removed == ((x.doc_id, x.para) != (x.cluster_doc_id, x.cluster_para)) for x in got)
    df = frame(spark, rows)
    out = substring_dedup.remove_repeats(df)
    assert out.columns == df.columns
    left = {x.doc_id: x.text for x in out.collect()}
    assert left[0] == texts[0] and left[1] == "unique line 1" and left[6] == texts[6]
    assert 9 not in left and left[12] == "short line" and left[13] is None and left[14] == ""
    assert ([x for x in words_outside(substring_dedup.passages(df), rows) if x[1]]
            == sorted((str(x.doc_id), words(x.text)) for x in out.collect() if words(x.text or "")))
    assert substring_dedup.repeats(df.limit(0)).count() == 0


def test_repeated_runs_inside_long_lines_and_across_short_ones(spark):
    r = random.Random(4)
    vocab = [f"v{i}é" for i in range(5000)]
    def say(n):
        return " ".join(r.choice(vocab) for _ in range(n))
    def wrapped(t):
        return re.sub(r"((?:\S+ ){11}\S+) ", r"\1\n", t)
    a, b, c = say(60), say(50), say(39)
    p1, p2 = say(70), say(70)
    rows = [(0, f"{p1} {a} {p2}"), (1, f"{(s1 := say(80))} ({a.upper()}). {(s2 := say(80))}"),
            (2, wrapped(say(30)) + "\n" + wrapped(b) + "\n" + say(20)),
            (3, wrapped(say(17) + " " + b) + "\n\nlast"), (4, b), (5, say(60) + " " + c), (6, c + " " + say(60)),
            (7, "ha " * 100), (8, None), (9, ""), (10, say(30) + "\n" + say(30)), (None, f"null {a} id")]
    rows.append(rows[0])
    df = frame(spark, rows)
    assert substring_dedup.repeats(df).where("removed and doc_id in (0, 1, 2, 3, 4)").count() == 0
    out = substring_dedup.remove_repeats(df)
    assert out.columns == df.columns
    left = out.select("doc_id", "text").collect()
    got = {x.doc_id: x.text for x in left}
    spans = substring_dedup.passages(df)
    assert {x.doc_id for x in spans.where("removed").collect()} == {0, 1, 3, 4, 7}
    assert ([x for x in words_outside(spans, rows) if x[1]]
            == sorted((str(x.doc_id), words(x.text)) for x in left if words(x.text or "")))
    one = spans.where("doc_id = 1 and removed").collect()
    assert [(x.kind, x.first_word, x.words, x.para) for x in one] == [("run", 80, 60, None)]
    assert substring_dedup.passages(df.limit(0)).count() == 0
    assert got[None] == rows[11][1] and [x.text for x in left if x.doc_id == 0] == [f"{p1} {p2}"] * 2
    assert got[1] == f"{s1} ({s2}" and got[2] == rows[2][1] and 4 not in got
    assert words(got[3]) == words(rows[3][1])[:17] + ["last"]
    assert all(got[i] == rows[i][1] for i in (5, 6, 8, 9, 10)) and words(got[7]) == ["ha"] * 40
    seen = {}
    for i, t in {(x.doc_id, x.text) for x in left}:
        w = words(t)
        for k in range(len(w) - 39):
            assert seen.setdefault(tuple(w[k:k + 40]), (i, k)) == (i, k)


def test_decontaminate_is_brute_force(spark):
    r = random.Random(2)
    vocab = [f"t{i}" for i in range(400)]
    items = [" ".join(r.choice(vocab) for _ in range(r.randint(15, 59))) for _ in range(20)]
    docs = []
    for k in range(40):
        w = [r.choice(vocab) for _ in range(r.choice([10, 200, 3000]))]
        it = items[k % 20].split()
        if k % 3 == 0:
            it[len(it) // 2] = "x"                       # containment near the threshold
        if k % 4:
            w[5:5] = it
        docs.append(" ".join(w))
    docs += [None, "", "four words are short", items[0].upper(), items[1] + " " + items[2]]
    rows = list(enumerate(docs)) + [(0, docs[0])]
    bench = list(enumerate(items)) + [(50, None), (51, "too short item"), (3, items[3])]
    bf = spark.createDataFrame([(i, t, 1) for i, t in bench], "item_id long, text string, doc_id int")
    def grams(t):
        w = words(t)
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    want = {}
    for i, t in rows:
        for j, s in bench:
            g = grams(s)
            if g and len(g & grams(t)) / len(g) >= 0.8:
                want[(i, j)] = len(g & grams(t)) / len(g)
    df = frame(spark, rows)
    got = {(x.doc_id, x.item_id): x.containment for x in decontaminate.find_leaks(df, bf).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    clean = decontaminate.remove_leaks(df, bf)
    assert clean.columns == df.columns
    assert {x.doc_id for x in clean.collect()} == {i for i, _ in rows} - {i for i, _ in want}
    assert decontaminate.find_leaks(df.limit(0), bf).count() == 0
    assert decontaminate.find_leaks(df, bf.limit(0)).count() == 0


def test_decontaminate_finds_every_short_item(spark):
    r = random.Random(3)
    items = [" ".join(f"i{k}x{j}" for j in range(5 + k % 6)) for k in range(60)]
    docs = []
    for it in items:
        w = [f"t{r.randrange(10 ** 6)}" for _ in range(1000)]
        docs.append(" ".join(w[:500]) + f" {it} " + " ".join(w[500:]))
    bf = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    df = frame(spark, list(enumerate(docs)))
    got = decontaminate.find_leaks(df, bf).collect()
    assert {(x.doc_id, x.item_id) for x in got} == {(k, k) for k in range(60)} and all(x.containment == 1 for x in got)
    plan = decontaminate.candidates(df.select("doc_id", "text"), bf, ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_decontaminate_runs_no_python(spark):
    df = frame(spark, [(1, "a b c d e f")])
    bf = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    plan = decontaminate.candidates(df.select("doc_id", "text"), bf, ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_shared_counts():
    r = np.random.default_rng(0)
    sets = [np.unique(r.integers(0, 30_000, r.integers(0, 9000))) for _ in range(12)]
    off = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    a, b = map(np.array, zip(*itertools.combinations(range(12), 2)))
    got = pairs.shared_counts(np.concatenate(sets).astype(np.int64), off, a, b)
    assert got.tolist() == [len(np.intersect1d(sets[i], sets[j])) for i, j in zip(a, b)]


def test_set_id_tells_bags_apart(spark):
    df = spark.createDataFrame([("a b c d e",), ("a b c d e ",), ("a b c d f",)], "text string")
    ids = [r.id for r in jaccard_join.shingle_sets(df).orderBy(F.monotonically_increasing_id()).collect()]
    assert ids[0] == ids[1] != ids[2]


def test_keep_one_judges_rows_of_one_id_each_on_its_own(spark):
    x, y, z = (" ".join(f"{c}{i}" for i in range(40)) for c in "xyz")
    near = x.rsplit(" ", 1)[0]
    rows = [(1, x), (5, x), (5, y), (7, z), (7, z), (7, near), (None, x), (None, None), (9, None), (9, ""), (2, y + " end")]
    df = spark.createDataFrame([(i, t, "c", 1, "d") for i, t in rows], DOCS)
    kept = jaccard_join.keep_one(df)
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert kept.columns == df.columns
    assert [g for g in got if g[0] != 9] == sorted([(1, x), (2, y + " end"), (7, z), (None, x), (None, None)], key=str)
    assert sum(g[0] == 9 for g in got) == 1                          # null and empty are one text
    two = spark.createDataFrame([(1, x, "", 0, ""), (1, y, "", 0, "")], DOCS)
    assert jaccard_join.keep_one(two).count() == 2
