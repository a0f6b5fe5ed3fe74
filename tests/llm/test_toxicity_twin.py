"""The whole toxicity score against plain loops over words, examples and votes."""

import math
import re
import zlib
from collections import Counter

import numpy as np

from orchard.llm import toxicity
from orchard.llm.common import prepare

SF = "/root/testdata/sf0.001"


def words_of(text):
    return Counter(re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower()))


def steps(x, y):
    """Isotonic steps from their definition: the largest of the smallest means, runs of one value pooled."""
    votes = sorted(set(x))
    total = [sum(b for a, b in zip(x, y) if a == v) for v in votes]
    size = [sum(1 for a in x if a == v) for v in votes]
    fit = [max(min(sum(total[a:b + 1]) / sum(size[a:b + 1]) for b in range(i, len(votes))) for a in range(i + 1))
           for i in range(len(votes))]
    middle, level = [], []
    for value in sorted(set(np.round(fit, 9))):
        pool = [i for i, f in enumerate(fit) if round(f, 9) == value]
        n = sum(size[i] for i in pool)
        middle.append(sum(votes[i] * size[i] for i in pool) / n)
        level.append((sum(total[i] for i in pool) + 0.5) / (n + 1))
    return middle, level


def twin(texts, toxic, hashes, k):
    """(score, three nearest examples) of every document, and whether label dependence was chosen."""
    n, rest = len(texts), {i: zlib.crc32(str(i).encode()) % 5 for i in texts}
    counts = {i: words_of(t) for i, t in texts.items()}
    df = Counter(w for c in counts.values() for w in c)
    learn = [i for i in texts if i in toxic and rest[i] != 0]
    inside = [i for i in learn if rest[i] != 4]
    calibrate = sorted((i for i in learn if rest[i] == 4), key=hashes.get)
    known = {w for i in inside for w in counts[i]}
    ones = sum(toxic[i] for i in inside)
    prior = (sum(toxic[i] for i in learn) + 0.5) / (len(learn) + 1)

    def dependence(w):
        d = sum(w in counts[i] for i in inside)
        a = sum(w in counts[i] and toxic[i] for i in inside)
        b, c, e = d - a, ones - a, len(inside) - ones - (d - a)
        den = d * (c + e) * (a + c) * (b + e)
        return len(inside) * (a * e - b * c) ** 2 / den if den else 0.0

    best = None
    for dependent in (False, True):
        weight = {w: (math.log((n + 1) / (df[w] + 1)) + 1) * (1 + dependence(w) * dependent) for w in known}

        def vector(i):
            v = {w: (1 + math.log(c)) * weight[w] for w, c in counts[i].items() if w in known}
            length = math.sqrt(sum(x * x for x in v.values()))
            return {w: x / length for w, x in v.items()}
        examples = {i: vector(i) for i in inside}

        def vote(i):
            q = vector(i)
            near = [(-round(sum(x * e.get(w, 0.0) for w, x in q.items()), 12), j) for j, e in examples.items()]
            near = sorted(x for x in near if x[0] < 0)[:k]
            w = [1 / (1 - min(-s, 1) + 0.1) for s, _ in near]
            return ((sum(a * toxic[j] for a, (_, j) in zip(w, near)) + 0.5 * prior) / (sum(w) + 0.5), [j for _, j in near[:3]])
        x, y = [vote(i)[0] for i in calibrate], [toxic[i] for i in calibrate]
        loss = 0.0
        for half in (1, 0):
            m, lv = steps(x[half::2], y[half::2])
            p = np.interp(x[1 - half::2], m, lv)
            loss -= sum(math.log(a if b else 1 - a) for a, b in zip(p, y[1 - half::2]))
        if best is None or loss < best[0] - 1e-9:
            m, lv = steps(x, y)
            best = loss, dependent, {i: (float(np.interp(vote(i)[0], m, lv)), vote(i)[1]) for i in texts}
    return best[2], best[1]


def test_the_whole_score_against_plain_loops(spark):
    prepare(spark)
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    hashes = {r.doc_id: r.h for r in docs.selectExpr("doc_id", "xxhash64(doc_id) AS h").collect()}
    toxic = {r.doc_id: r.toxic for r in labels.where("toxic IS NOT NULL").collect()}
    want, _ = twin(texts, toxic, hashes, 5)
    got = toxicity.score_toxicity(docs, labels, k=5).collect()
    assert len(got) == len(texts) == len(want)
    for r in got:
        assert abs(r.score - want[r.doc_id][0]) < 1e-6
        assert [e.doc_id for e in r.evidence] == want[r.doc_id][1]
        assert r.predicted == int(r.score >= 0.5)


def test_weights_are_chosen_on_the_calibration_rows(spark, monkeypatch):
    """Whichever weights lose less there score the texts; held-out labels change nothing."""
    prepare(spark)
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    losses, plain = [], toxicity.crossed_loss
    monkeypatch.setattr(toxicity, "crossed_loss", lambda *a: losses.append(plain(*a)) or losses[-1])
    one = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, labels).collect()}
    turned = labels.selectExpr("doc_id", "quality", "IF(pmod(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)), 5) = 0, 1 - toxic, "
                               "toxic) AS toxic")
    two = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, turned).collect()}
    assert one == two and len(losses) == 4 and losses[:2] == losses[2:]


def test_steps_are_joined_by_lines():
    x, y = np.array([0.0, 0.2, 0.4, 0.6]), np.array([0.0, 0.0, 1.0, 1.0])
    middle, level = toxicity.levels(x, y)
    assert np.allclose(middle, [0.1, 0.5])
    assert (np.diff(level) > 0).all()
    assert toxicity.crossed_loss(np.zeros(0), np.zeros(0)) == 0
