"""Text operators against brute force, exact round trips and held-out accuracy, with the defined cases."""

import bisect
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from orchard.llm import chat_format, lattice_lm, packing, quality, toxicity, url_filter
from orchard.llm.common import prepare
from orchard.llm.queries import pieces_file, tokenizer_file
from orchard.llm.text import ALNUM, Words, lowered, minhash, set_ids, shingles, slices

SF = "/root/testdata/sf0.01"


@pytest.fixture(autouse=True)
def ready(spark):
    prepare(spark)


def test_words_and_shingles():
    texts = ["The café, the CAFÉ!", "", "a b c d e f", "one", "x  y\nz", "a b c d e f"]
    w = Words(lowered(pa.array(texts)), ALNUM)
    want = [re.findall(r"[a-z0-9\x80-\U0010ffff]+", t.lower()) for t in texts]
    assert np.bincount(w.row, minlength=len(texts)).tolist() == [len(x) for x in want]
    flat = [x for y in want for x in y]
    assert w.text(np.arange(len(flat))).to_pylist() == flat
    assert len(set(w.hash.tolist())) == len(set(flat))
    s, row = shingles(w.hash, w.row, w.rows)
    assert np.bincount(row, minlength=6).tolist() == [1, 0, 2, 1, 1, 2]
    rows, sig = minhash(s, row, 8)
    assert rows.tolist() == [0, 2, 3, 4, 5] and (sig[1] == sig[4]).all()
    ids = set_ids(s, row)
    assert ids[1] == ids[4] and len(set(ids.tolist())) == 4


def test_slices_cover_the_batch():
    b = pa.RecordBatch.from_pydict({"text": ["x" * (1 << 20)] * 5 + [None, "", "y" * (5 << 20), "z"]})
    parts = [p for p in slices(b, "text")]
    assert sum(p.num_rows for p in parts) == b.num_rows and len(parts) > 2
    assert pa.Table.from_batches(parts).column("text").to_pylist() == b.column("text").to_pylist()


def test_url_filter_cases(spark):
    rows = [("http://WWW.Example.COM/en/x", "allow", "www.example.com/en/"), ("http://a.example.com/en/x", "block", "example.com/en/"),
            ("http://example.com/", "allow", "com/"), ("http://example.com", "allow", None), ("ftp://x.net/es/", "block", "net/es/"),
            ("http://x.net/ES/", "allow", None), ("http://notexample.org/casino", "block", None),
            ("http://x.org/casinos", "allow", None), ("http://ads.x.org/", "allow", None), ("http://ads.x.org/ads", "allow", None),
            ("http://ads-track.x.org/", "block", None), ("no scheme casino", "block", None), (None, "allow", None), ("", "allow", None),
            ("http://x.org?q=/en/", "allow", None), ("http://com/?x", "allow", "com/"), ("://", "allow", None),
            ("http://x.org/" + "a" * 100_000, "allow", None), ("http://example.com/", "allow", "com/")]
    df = spark.createDataFrame([(i, u, "mine", "clash") for i, (u, _, _) in enumerate(rows)],
                               "page_id long, url string, verdict string, _judged string")
    got = url_filter.filter_urls(df).orderBy("page_id").collect()
    assert [(r.verdict, r.rule) for r in got] == [(v, k) for _, v, k in rows]
    assert (got[0].host, got[0].path) == ("www.example.com", "/en/x") and (got[14].host, got[14].path) == ("x.org", "")
    assert (got[12].host, got[12].path) == ("", "") and got[0]._judged == "clash"
    assert url_filter.filter_urls(df.limit(0)).count() == 0


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "<|turn|>user<|text|>x<|end|>", "\\", "\\\\<|end|>\\", "a<\\s>", "<<s>s>", "", None, "é\n\\n",
             "[[INST]", "<|", "|>", "x" * 50_000]
    rows, want = [], {}
    r = random.Random(4)
    for c in range(12):
        turns = [(t, r.choice(["user", "assistant", "system", "<|text|>"]), r.choice(nasty)) for t in range(r.randint(1, 6))]
        turns.append(turns[-1])                                   # a repeated row
        rows += [(c, t, k, x, 1) for t, k, x in turns]
        want[c] = sorted(turns, key=lambda x: (x[0], x[1], x[2] or ""))
    rows.append((99, 0, None, None, 1))
    want[99] = [(0, "", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")
    ex = chat_format.format_chat(df)
    for e in ex.collect():
        for s in chat_format.CONTROL[3:]:
            assert s not in e.formatted
    for g in chat_format.read_back(ex).collect():
        t = [(k or "", x or "") for _, k, x in want[g.conv_id]]
        loss = "".join(x for k, x in t if k == "assistant")
        assert g.n_turns == len(t) and g.loss_chars == len(loss)
        assert g.turns_sha256 == hashlib.sha256("".join(f"{k}\n{x}\n" for k, x in t).encode()).hexdigest()
        assert g.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    n = sum(sum(k == "assistant" for _, k, _ in v) + (v[-1][1] != "assistant") for v in want.values())
    assert ex.count() == n
    assert chat_format.format_chat(df.limit(0)).count() == 0


def test_block_max_search_is_exact():
    r = np.random.default_rng(1)
    x = r.random((500, 40)) * (r.random((500, 40)) < 0.1)
    x[100:140] = x[100]                                            # ties
    n = np.linalg.norm(x, axis=1, keepdims=True)
    x = np.divide(x, n, out=x, where=n > 0)
    ids = r.permutation(500)
    index = toxicity.BlockMaxIndex.build(ids, np.zeros(500), x, block=16)
    q = np.vstack([x[:50], np.zeros((1, 40))])
    sim, who = index.nearest(q, 7)
    for i in range(len(q)):
        s = x @ q[i]
        o = [j for j in np.lexsort((ids, -np.round(s, 12))) if s[j] > 0][:7]
        assert np.allclose(sim[i, :len(o)], s[o]) and (who[i, len(o):] == -1).all()
        assert {int(index.ids[w]) for w in who[i] if w >= 0 and sim[i, len(o) - 1] < s[ids == index.ids[w]][0] - 1e-9} <= \
            set(ids[o].tolist())


def test_block_max_search_skips_blocks(monkeypatch):
    r = np.random.default_rng(2)
    labels = (np.arange(600) % 3 == 0).astype(float)
    x = r.random((600, 60)) * (r.random((600, 60)) < 0.2)
    x[:, :30] *= labels[:, None] == 0                              # the labels use words of their own
    x[:, 30:] *= labels[:, None] == 1
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    index = toxicity.BlockMaxIndex.build(np.arange(600), labels, x, block=20)
    looked, plain = [], toxicity.BlockMaxIndex.scores
    monkeypatch.setattr(toxicity.BlockMaxIndex, "scores", lambda self, *a: (looked.append(a[-1].sum()), plain(self, *a))[1])
    monkeypatch.setattr(toxicity, "CHUNK", 64)
    sim, who = index.nearest(x[:40], 5)
    assert sum(looked) < 40 * 30 * 0.8
    for i in range(40):
        s = np.round(x @ x[i], 12)
        want = np.lexsort((np.arange(600), -s))[:5]
        assert index.ids[who[i]].tolist() == want[s[want] > 0].tolist() and np.allclose(sim[i], s[want])


def test_postings_are_added_once(monkeypatch):
    monkeypatch.setattr(toxicity, "WIDE", 6)
    monkeypatch.setattr(toxicity, "CHUNK", 50)
    r = np.random.default_rng(3)
    x = r.random((300, 80)) * (r.random((300, 80)) < 0.15)
    x[120:150] = x[120]                                            # ties
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    ids = r.permutation(300)
    index = toxicity.BlockMaxIndex.build(ids, r.integers(0, 2, 300).astype(float), x, block=16)
    q = np.vstack([x[100:170], np.zeros((1, 80)), np.eye(80)[:3]])
    touched, plain = [], toxicity.within
    monkeypatch.setattr(toxicity, "within", lambda *a: (touched.append(a[1].sum()), plain(*a))[1])
    sim, who = index.nearest(q, 7)
    held, listed = (x > 0).sum(axis=0), index.wide < 0
    assert listed.sum() == 74 and sum(touched) == ((q > 0) * held)[:, listed].sum()
    for i in range(len(q)):
        s = np.round(x @ q[i], 12)
        want = [j for j in np.lexsort((ids, -s))[:7] if s[j] > 0]
        assert index.ids[who[i, :len(want)]].tolist() == ids[want].tolist() and (who[i, len(want):] == -1).all()
        assert np.allclose(sim[i, :len(want)], s[want], atol=1e-11)


def test_toxicity_looks_up_every_word(spark):
    r = np.random.default_rng(5)
    texts = [f"plain{i} " + " ".join(f"c{j}" for j in r.integers(0, 400, 30)) for i in range(400)]
    rare = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 in (1, 2)][:2]     # two examples of the index
    asks = [400 + i for i in range(2)]
    texts = [t + f" rareword{rare.index(i)}" if i in rare else t for i, t in enumerate(texts)]
    texts += [f"rareword{i} unseen{i}" for i in range(2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i in rare or i % 9 == 0)) for i in range(400)], "doc_id long, quality int, toxic int")
    got = {x.doc_id: x.evidence for x in toxicity.score_toxicity(docs, labels).collect()}
    assert [[e.doc_id for e in got[a]] for a in asks] == [[i] for i in rare]
    assert all(got[i][0].doc_id == i and abs(got[i][0].similarity - 1) < 1e-9 for i in rare)


def test_isotonic():
    x = np.array([0, 0, 1, 2, 3, 3, 4.0])
    k, v = toxicity.isotonic(x, np.array([0, 1, 0, 0, 1, 1, 1.0]))
    assert (np.diff(v) >= 0).all() and k[0] == 0 and v[-1] > v[0]


def held_out(got, labels, label):
    m = got.merge(labels, on="doc_id")
    m = m[m.held_out]
    y, p = m[label].to_numpy(), m.predicted.to_numpy()
    return (y == p).mean(), ((p == 1) & (y == 1)).sum() / max(1, (y == 1).sum())


@pytest.mark.parametrize("fn,label,floor", [(toxicity.score_toxicity, "toxic", 0.95), (quality.score_quality, "quality", 0.95)])
def test_classifiers(spark, fn, label, floor):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = fn(docs, labels).toPandas()
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    acc, _ = held_out(got, labels.toPandas(), label)
    assert acc >= floor


@pytest.mark.parametrize("fn,label", [(toxicity.score_toxicity, "toxic"), (quality.score_quality, "quality")])
def test_classifier_cases(spark, fn, label):
    docs = spark.createDataFrame([(1, None, 3, "y"), (2, "", 3, "y"), (2, "", 3, "y"), (None, "good text", 1, "z"), (3, "w " * 60_000, 2, "q")],
                                 "doc_id long, text string, x int, y string")
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (77, 1, 1), (None, 1, 1), (2, None, None)],
                                   "doc_id long, quality int, toxic int")
    for lab in (labels, labels.limit(0)):
        got = fn(docs, lab).toPandas()
        assert len(got) == 5 and got.score.between(0, 1).all() and got.predicted.isin([0, 1]).all()
    assert fn(docs.limit(0), labels).count() == 0
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.where("doc_id is null").count() == 1


def test_additive_model_learns_an_interaction():
    r = np.random.default_rng(0)
    x = r.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    m = quality.fit(x, y)
    assert ((m.score(x) > 0.5) == y).mean() > 0.97 and (0, 1) in [(i, j) for i, j, _ in m.pairs]


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once(seed):
    r = np.random.default_rng(seed)
    cap = 64
    counts = np.zeros(cap + 1, np.int64)
    counts[1:] = r.integers(0, 30, cap) * (r.random(cap) < 0.6)
    p = packing.plan(counts, cap)
    end = np.append(p["rank"][1:], 0)
    last = np.append(p["size"][1:] != p["size"][:-1], True)
    n = np.where(last, counts[p["size"]], end) - p["rank"]
    assert n.sum() == counts.sum() and (n > 0).all()
    spans = {}
    for s, k, q, at in zip(p["size"], n, p["sequence"], p["place"]):
        for i in range(k):
            spans.setdefault(int(q + i), []).append((int(at), int(s)))
    for v in spans.values():
        at = 0
        for a, s in sorted(v):
            assert a == at
            at += s
        assert at <= cap
    rooms = []                                                     # best fit decreasing, piece by piece
    for size in np.repeat(np.arange(cap + 1), counts)[::-1].tolist():
        at = bisect.bisect_left(rooms, size)
        rest = (rooms.pop(at) if at < len(rooms) else cap) - size
        bisect.insort(rooms, rest)
    assert len(spans) == len(rooms)
    assert len(packing.plan(np.zeros(cap + 1, np.int64), cap)["size"]) == 0


def test_packing_against_the_tokenizer(spark):
    from tokenizers import Tokenizer
    r = random.Random(0)
    morse = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    texts = ["Hello  WORLD it's\tfine", "", None, "<|endoftext|> x", "a <|endoftext|> b", "x<|endoftext|>y <|ENDOFTEXT|>",
             morse, morse.translate(str.maketrans("ab", "ba")), f"a {morse} b",      # two long words with one polynomial hash
             "é é 　 ß 12345 don't", "a b\x1cc",
             " ".join(r.choice(["the", "ofthstthor", "être", "42", "!!"]) for _ in range(9000)), "Hello  WORLD it's\tfine"]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts)] + [(0, texts[0], 1, 2)],
                               "doc_id long, text string, length int, pid int")
    packed = packing.pack(df, tokenizer_file(), with_ids=True)
    got = packed.toPandas()
    tok = Tokenizer.from_file(tokenizer_file())
    for i, t in enumerate(texts):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        mine = got[got.doc_id == i].sort_values("piece").drop_duplicates("piece")
        assert [x for p in mine.ids for x in p] == ids
        assert mine.length.tolist() == [min(4096, len(ids) - k) for k in range(0, len(ids), 4096)]
        assert mine.ids_crc32.tolist() == [zlib.crc32(np.array(ids[k:k + 4096], "<u4").tobytes()) for k in range(0, len(ids), 4096)]
    seqs = {x.sequence_id: x.ids for x in packing.sequences(packed).collect()}
    for x in got.itertuples():
        assert list(x.ids) == seqs[x.sequence_id][x.offset:x.offset + x.length]
    assert sum(map(len, seqs.values())) == got.length.sum() and max(map(len, seqs.values())) <= 4096
    assert packing.pack(df.limit(0), tokenizer_file()).count() == 0


def test_new_words_are_encoded_together_and_kept(monkeypatch):
    from tokenizers import Tokenizer
    plain, asked, copied, put = Tokenizer.from_file(tokenizer_file()), [], [], getattr(packing, "merged", None)

    class Counting:
        def __getattr__(self, name):
            return lambda texts, **how: (asked.append(len(texts)), getattr(plain, name)(texts, **how))[1]

    words = packing.WordIds(tokenizer_file())
    words.tok = Counting()
    monkeypatch.setattr(packing, "RECENT", 500, raising=False)
    monkeypatch.setattr(packing, "merged", lambda a, b: (copied.append(len(a[0]) + len(b[0])), put(a, b))[1], raising=False)
    r, seen = random.Random(4), set()
    kinds = [*"abtheé019'!.$<>|", "\u0301", "\u0327", "\u1100", "\u1161", "e\u0301", "\u0130", "\u03a3", "\u00a0", "\u3000",
             "\x1c", "\x00", "\U0001f600", "\u4e2d", "'s", "'LL", "<|endoftext|>", "<|ENDOFTEXT|>", "\u212b", "\u0966"]
    for limit in (1 << 20, 1 << 20, 3000):                         # the last round empties the cache now and then
        monkeypatch.setattr(packing, "CACHE_WORDS", limit)
        for _ in range(25):
            some = ["".join(r.choice(kinds) for _ in range(r.randint(1, 7))) for _ in range(r.choice([1, 63, 64, 65, 400]))]
            some += r.sample(sorted(seen), min(len(seen), 50))
            flat, ln = words.ids(Words(pa.array([" ".join(some)]), packing._KEEP_CASE))
            ids = [e.ids for e in plain.encode_batch_fast(some, add_special_tokens=False)]
            assert ln.tolist() == [len(x) for x in ids] and flat.tolist() == [i for x in ids for i in x]
            seen |= set(some)
        if limit > 1 << 19:
            assert sum(asked) < len(seen) / 64 + 60 and sum(copied) < 8 * len(seen) + 60 * 500
    assert words.ids(Words(pa.array(["", ""]), packing._KEEP_CASE))[0].tolist() == []


def test_lattice_sums_all_segmentations():
    names, logp = lattice_lm.vocabulary(pieces_file())
    have = dict(zip(names, logp))
    lat = lattice_lm.Lattice(names, logp)
    words = [b"the", b"onhaonan!!", "ñandú".encode(), b"x" * 200, b"\xff\x00", b"a"]
    data, size = np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words])
    got = lat.score(data, np.cumsum(size) - size, size)[0]
    for w, s in zip(words, got):
        w = lattice_lm.MARK + w
        f = [0.0] + [-np.inf] * len(w)
        for e in range(1, len(w) + 1):
            for b in range(max(0, e - lattice_lm.LONGEST_PIECE), e):
                if w[b:e] in have:
                    f[e] = np.logaddexp(f[e], f[b] + have[w[b:e]])
        assert abs(f[-1] - s) < 1e-9
    for _, b, n in lat.tables(data, np.cumsum(size) - size, size):
        use = lat.expected(b, n, np.ones(len(n)), 0)
        assert abs(sum(len(names[i]) * use[i] for i in np.flatnonzero(use)) - n.sum()) < 1e-6   # every byte is used once


@pytest.mark.parametrize("head", [0, 5, 1 << 18])
def test_language_model_base_is_brute_force(spark, head):
    r = random.Random(8)
    vocab = ["the", "The", "of", "ñ", "x" * 700, "rare", "b!"]
    texts = [" ".join(r.choices(vocab, [9, 3, 5, 2, 1, 1, 1], k=r.randint(0, 40))) + f"\t\x0bu{i % 7}" for i in range(40)] + [None, "", "the"]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, "the of")]
    df = spark.createDataFrame([(i, t, "en", 4) for i, t in rows], "doc_id long, text string, lang string, h int")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    fold = lambda i: 0 if i is None else zlib.crc32(str(i).encode()) % 10                      # noqa: E731
    toks = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low)) + ["\n"] for _, t in rows]
    c = pd.Series([w for (i, _), ws in zip(rows, toks) if fold(i) for w in ws]).value_counts()
    n, v = int(c.sum()), len(c)
    want = sorted(((-1 if i is None else i), len(ws), sum(w in c for w in ws),
                   round(sum(math.log10((c.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 8)) for (i, _), ws in zip(rows, toks))
    got = lattice_lm.score_texts(df, pieces_file(), component_col="lang", head=head, rounds=1).toPandas()
    assert sorted(zip(got.doc_id.fillna(-1).astype(int), got.n_tokens, got.n_known, got.base_score.round(8))) == want
    assert (got.train_tokens == n).all() and np.isfinite(got.score).all() and (got.score < 0).all()
    assert lattice_lm.score_texts(df.limit(0), pieces_file(), rounds=1).count() == 0


def test_lattice_beats_the_base_on_held_out_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = lattice_lm.score_texts(docs, pieces_file(), component_col="lang").where("held_out").toPandas()
    assert got.score.sum() / got.n_tokens.sum() > got.base_score.sum() / got.n_tokens.sum() - 0.3


def test_workers_give_memory_back(monkeypatch):
    """A task ends with freed memory returned, also when its reader stops early."""
    from orchard.llm import text
    calls = []
    monkeypatch.setattr(text, "give_back", lambda: calls.append(1))
    assert list(text.tidy(lambda it: (x + 1 for x in it))(iter([1, 2]))) == [2, 3] and calls == [1]
    left = text.tidy(lambda it: (x for x in it))(iter([1, 2]))
    next(left)
    left.close()
    assert calls == [1, 1]
