"""Registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orchard.llm import (chat_format, decontaminate, embedding_dedup, jaccard_join, lattice_lm, mixing, packing, quality, substring_dedup,
                         toxicity, turn_repair, url_filter, vector_codes)
from orchard.llm.common import prepare, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --------------------------------------------------------------------------
# op2: URL filters
# --------------------------------------------------------------------------

_AZ = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _term_hits(terms) -> str:
    return " + ".join(f"CASE WHEN regexp_matches(u, '(^|[^a-z0-9]){t}($|[^a-z0-9])') THEN 1 ELSE 0 END" for t in terms)


OP2_SQL = f"""
WITH a AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
b AS (SELECT page_id, {_AZ.format('url')} AS u,
             CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*')
                  ELSE '' END AS rest FROM a),
c AS (SELECT page_id, u, {_AZ.format("regexp_extract(rest, '^[^/]*')")} AS host,
             substr(rest, length(regexp_extract(rest, '^[^/]*')) + 1) AS path FROM b),
r(verdict, h, p) AS (VALUES {", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in url_filter.RULES)}),
m AS (SELECT page_id, arg_max(r.h || r.p, length(r.h || r.p)) AS rule,
             arg_max(r.verdict, length(r.h || r.p)) AS verdict
      FROM (SELECT DISTINCT page_id, host, path FROM c) d JOIN r
        ON (host = r.h OR ends_with(host, '.' || r.h)) AND starts_with(path, r.p) GROUP BY page_id)
SELECT c.page_id, host, path, m.rule AS rule,
       coalesce(m.verdict, CASE WHEN ({_term_hits(url_filter.STRICT)}) > 0
                                  OR ({_term_hits(url_filter.SOFT)}) >= 2 THEN 'block' ELSE 'allow' END) AS verdict
FROM c LEFT JOIN m USING (page_id)
"""


@register("op2_url_filter", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page url."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages).select("page_id", "host", "path", "rule", "verdict")


# --------------------------------------------------------------------------
# op5: chat formatting
# --------------------------------------------------------------------------

_ESC = "replace({}, '\\', '\\\\')"
for _s in chat_format.CONTROL:
    _ESC = f"replace({_ESC}, '{_s}', '{_s[0]}\\{_s[1:]}')"
_OVERHEAD = len(chat_format.TURN) + len(chat_format.TEXT) + len(chat_format.END)

OP5_SQL = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
           UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
n AS (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n,
             {_OVERHEAD} + length({_ESC.format('role')}) + length({_ESC.format('text')}) AS chars
      FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
p AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM n)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(upto) FILTER (WHERE role = 'assistant' OR i = n)::BIGINT AS formatted_chars
FROM p GROUP BY conv_id
"""


@register("op5_chat_format", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation (and of conversation -7), read back from its examples."""
    own = spark.sql("""SELECT -7L AS conv_id, t.turn, t.role, '</s>[INST] ok [/INST]' AS text
                       FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)""")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat_format.read_back(chat_format.format_chat(rows))


# --------------------------------------------------------------------------
# op4: n-gram Jaccard join
# --------------------------------------------------------------------------

_WORDS = r"list_filter(regexp_split_to_array(lower(coalesce({}, '')), '[\x00-\x2f\x3a-\x60\x7b-\x7f]+'), lambda w: w <> '')"
_SHINGLES = """CASE WHEN len(w) = 0 THEN []
            WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END"""

OP4_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents),
s AS (SELECT doc_id, {_SHINGLES} AS s FROM d),
g AS (SELECT doc_id, list_sort(s) AS s, len(s) AS n, md5(array_to_string(list_sort(s), chr(10))) AS k FROM s WHERE len(s) > 0),
u AS (SELECT k, any_value(n) AS n, any_value(s) AS s, count(*) AS c, min(doc_id) AS first FROM g GROUP BY k),
e AS (SELECT k, n, unnest(s) AS t FROM u),
p AS (SELECT a.k AS a, b.k AS b FROM e a JOIN e b ON a.t = b.t AND a.k < b.k AND a.n >= 0.8 * b.n AND b.n >= 0.8 * a.n
      GROUP BY a.k, b.k, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*)) - 1e-9),
l AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT k AS a, k AS b FROM u UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
cls AS (SELECT r.a AS k, min(u.first) AS class_id FROM r JOIN u ON r.b = u.k GROUP BY r.a),
deg AS (SELECT l.a AS k, sum(u.c) AS nrows, count(*) AS texts FROM l JOIN u ON l.b = u.k GROUP BY l.a)
SELECT g.doc_id, class_id, u.first AS copy_id, (coalesce(deg.nrows, 0) + u.c - 1)::BIGINT AS n_links,
       coalesce(deg.texts, 0)::BIGINT AS n_text_links
FROM g JOIN u USING (k) JOIN cls USING (k) LEFT JOIN deg USING (k)
UNION ALL SELECT doc_id, doc_id, doc_id, 0, 0 FROM s WHERE len(s) = 0
"""


@register("op4_jaccard_join", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document, Jaccard of five-word shingles >= 0.8."""
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))


# --------------------------------------------------------------------------
# op6: embedding near-duplicates
# --------------------------------------------------------------------------

OP6_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e, label FROM embeddings
                     WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
                       AND NOT list_contains(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)), true)
                       AND list_contains(list_transform(embedding, lambda x: x <> 0), true)),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e)
      AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a)
SELECT c.vec_id, (SELECT count(*) FROM l WHERE l.a = c.vec_id)::BIGINT AS n_links, component_id,
       c.vec_id = component_id AS kept FROM c
"""


@register("op6_embedding_dedup", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors, cosine >= 0.98 within a label."""
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


# --------------------------------------------------------------------------
# op10: substring dedup
# --------------------------------------------------------------------------

OP10_SQL = f"""
WITH RECURSIVE l AS (SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
x AS (SELECT doc_id, text, unnest(range(0, len(ls)))::INT AS para, unnest(ls) AS line FROM l),
d AS (SELECT doc_id, text, para, {_WORDS.format('line')} AS w FROM x),
g AS (SELECT doc_id, text, para, list_sort({_SHINGLES}) AS s FROM d WHERE len(w) >= 40),
o AS (SELECT DISTINCT doc_id, para, s, md5(array_to_string(s, chr(10))) AS k FROM g),
u AS (SELECT k, any_value(s) AS s, any_value(len(s)) AS n, count(*) AS c, min((doc_id, para)) AS first FROM o GROUP BY k),
e AS (SELECT k, n, unnest(s) AS t FROM u),
p AS (SELECT a.k AS a, b.k AS b FROM e a JOIN e b ON a.t = b.t AND a.k < b.k AND a.n >= 0.8 * b.n AND b.n >= 0.8 * a.n
      GROUP BY a.k, b.k, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*)) - 1e-9),
q AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT k AS a, k AS b FROM u UNION SELECT r.a, q.b FROM r JOIN q ON r.b = q.a),
cl AS (SELECT r.a AS k, min(u.first) AS first, sum(u.c) AS occurrences FROM r JOIN u ON r.b = u.k GROUP BY r.a),
f AS (SELECT o.doc_id, o.para, cl.first[1] AS cluster_doc_id, cl.first[2] AS cluster_para, cl.occurrences::BIGINT AS occurrences,
             NOT (o.doc_id = cl.first[1] AND o.para = cl.first[2]) AS removed
      FROM o JOIN cl USING (k) WHERE cl.occurrences > 1),
z AS (SELECT doc_id, para, w, (sum(len(w)) OVER (PARTITION BY doc_id ORDER BY para) - len(w))::BIGINT AS first_word FROM d),
v AS (SELECT doc_id, unnest(w) AS word, first_word + unnest(range(0, len(w))) AS pos
      FROM z ANTI JOIN (SELECT doc_id, para FROM f WHERE removed) USING (doc_id, para)),
y AS (SELECT doc_id, list(word ORDER BY pos) AS ws, list(pos ORDER BY pos) AS ps FROM v GROUP BY doc_id),
m AS (SELECT doc_id, unnest(range(1, len(ws) - 38)) AS i,
             unnest(list_transform(range(1, len(ws) - 38), lambda i: md5(array_to_string(ws[i:i+39], ' ')))) AS k
      FROM y WHERE len(ws) >= 40),
t AS (SELECT k, min((doc_id, i)) AS first FROM m GROUP BY k HAVING count(*) > 1),
c AS (SELECT m.doc_id, m.i, m.doc_id = t.first[1] AND m.i = t.first[2] AS stays FROM m JOIN t USING (k)),
b AS (SELECT doc_id, i, bool_or(stays) AS stays
      FROM (SELECT doc_id, i + unnest(range(0, 40)) AS i, stays FROM c) GROUP BY doc_id, i),
h AS (SELECT b.doc_id, y.ps[b.i] AS pos, stays FROM b JOIN y USING (doc_id)),
n AS (SELECT doc_id, pos, stays, pos - row_number() OVER (PARTITION BY doc_id, stays ORDER BY pos) AS island FROM h)
SELECT 'paragraph' AS kind, f.doc_id, f.para, z.first_word, len(z.w)::BIGINT AS words, cluster_doc_id, cluster_para, occurrences, removed
FROM f JOIN z USING (doc_id, para)
UNION ALL SELECT 'run', doc_id, NULL, min(pos)::BIGINT, count(*)::BIGINT, NULL, NULL, NULL, NOT stays FROM n GROUP BY doc_id, stays, island
"""


@register("op10_substring_dedup", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stretch that repeats (paragraphs, and runs of 40 words anywhere), by word span, and which ones go."""
    return substring_dedup.passages(table(spark, sf_dir, "documents")).drop("version")


# --------------------------------------------------------------------------
# op1, op7: classifiers (tested on held-out labels and against brute force)
# --------------------------------------------------------------------------


@register("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, with its nearest labelled examples."""
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op7_quality")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# --------------------------------------------------------------------------
# op8: best-fit packing (tested against a plain tokenizer run and an exact cover check)
# --------------------------------------------------------------------------


def tokenizer_file() -> str:
    """The public word BPE file; operators take the path as a parameter."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@register("op8_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document piece in sequences of 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file())


# --------------------------------------------------------------------------
# op3: benchmark decontamination
# --------------------------------------------------------------------------

_FULL_SHINGLES = ("CASE WHEN len(w) < 5 THEN []::VARCHAR[] ELSE list_distinct(list_transform(range(1, len(w) - 3), "
                  "lambda i: array_to_string(w[i:i+4], ' '))) END")
OP3_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents),
b AS (SELECT item_id, {_WORDS.format('text')} AS w FROM benchmark),
i AS (SELECT item_id, {_FULL_SHINGLES} AS s FROM b),
it AS (SELECT item_id, len(s) AS n, unnest(s) AS t FROM i),
ds AS (SELECT doc_id, unnest({_FULL_SHINGLES}) AS t FROM d)
SELECT doc_id, item_id, count(*) / n AS containment FROM it JOIN ds USING (t)
GROUP BY doc_id, item_id, n HAVING count(*) / n >= 0.8 - 1e-9
"""


@register("op3_decontaminate", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) with containment of five-word shingles >= 0.8."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# --------------------------------------------------------------------------
# op9: language-model scores (base columns tested against brute force)
# --------------------------------------------------------------------------


def pieces_file() -> str:
    """The public piece vocabulary; operators take the path as a parameter."""
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


@register("op9_lattice_lm")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and lattice log10 probability of every document."""
    return lattice_lm.score_texts(table(spark, sf_dir, "documents"), pieces_file(), component_col="lang")


# --------------------------------------------------------------------------
# op12: mixing sources to target weights
# --------------------------------------------------------------------------

OP12_SQL = """
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
h AS (SELECT *, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || size), 1, 15))::BIGINT AS h FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM h GROUP BY source),
w AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight, source_size * 2.0::DOUBLE AS bound FROM s),
c AS (SELECT *, sum(source_size) OVER () * 1.5::DOUBLE AS total, sum(weight) OVER () AS weights,
             coalesce(sum(bound) OVER o, 0) AS full_size, coalesce(sum(weight) OVER o, 0) AS full_weight, row_number() OVER p AS i
      FROM w WINDOW o AS (ORDER BY bound / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                    p AS (ORDER BY bound / weight, source NULLS LAST)),
l AS (SELECT arg_min((total - full_size) / (weights - full_weight), i) AS level FROM c
      WHERE weight * ((total - full_size) / (weights - full_weight)) <= bound),
t AS (SELECT source, source_size, least(weight * level, bound) AS target FROM w, l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
r AS (SELECT h.doc_id, h.size, e.source_size, e.target, e.whole, e.target - e.whole * e.source_size AS rest,
             coalesce(sum(h.size) OVER (PARTITION BY h.source ORDER BY h.h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM h JOIN e ON h.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (whole + CASE WHEN rest > 0 AND below + size / 2 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM r
"""


@register("op12_mix_sources", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


# --------------------------------------------------------------------------
# op13: vector code compression
# --------------------------------------------------------------------------

_PICK = """SELECT x.vec_id, x.label, x.part, x.v, arg_min(b.entry, ({d}, b.entry)) AS entry, min({d})::BIGINT AS dist
           FROM x JOIN {book} b USING (part) GROUP BY ALL"""
_DIST = "list_sum(list_transform(range(1, len(x.v) + 1), lambda i: (x.v[i] - b.v[i]) * (x.v[i] - b.v[i])))"
_MOVE = """SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM {book} b LEFT JOIN (
             SELECT part, entry, list(floor(s / n)::BIGINT ORDER BY i) AS v
             FROM (SELECT part, entry, i, sum(v[i])::DOUBLE AS s, count(*) AS n FROM {pick}, range(1, 1 + (SELECT max(len(v)) FROM x)) r(i)
                   GROUP BY ALL) GROUP BY ALL) m USING (part, entry)"""

OP13_SQL = f"""
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
           WHERE embedding IS NOT NULL AND NOT list_contains(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)), true)),
x AS (SELECT vec_id, label, part, q[part * (len(q) // 16) + 1:(part + 1) * (len(q) // 16)] AS v FROM v, range(16) r(part)),
b0 AS (SELECT part, v, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry FROM x QUALIFY entry < 64),
p1 AS MATERIALIZED ({_PICK.format(d=_DIST, book='b0')}), b1 AS MATERIALIZED ({_MOVE.format(book='b0', pick='p1')}),
p2 AS MATERIALIZED ({_PICK.format(d=_DIST, book='b1')}), b2 AS MATERIALIZED ({_MOVE.format(book='b1', pick='p2')}),
p3 AS MATERIALIZED ({_PICK.format(d=_DIST, book='b2')}),
c AS (SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(dist)::BIGINT AS error
      FROM p3 GROUP BY vec_id, label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) FROM b2) AS codebooks_sha256 FROM c
"""


@register("op13_vector_codes", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code of every vector and the squared error that it leaves."""
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


# --------------------------------------------------------------------------
# op11: conversation structure repair
# --------------------------------------------------------------------------

_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({s}) + 1),
            lambda j: ascii(substr({s}, j::INT, 1))::BIGINT)),
            lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
            lambda x, y: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END))))"""

OP11_SQL = f"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                            coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS s FROM conversations),
m AS (SELECT *, {_CRC.format(s='s')} % 20 AS kind FROM k),
d AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
             CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
      FROM m, range(2) r(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
o AS (SELECT *, row_number() OVER w AS i, left(role, 1) AS t, lag(left(role, 1)) OVER w AS before
      FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                     WHEN i > min(i) OVER (PARTITION BY conv_id, role, text) THEN 'duplicate'
                     WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' ELSE 'none' END AS fault FROM o),
st AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
              count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
              count(*) FILTER (i > 1 AND before || t NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM f GROUP BY conv_id),
ins(q, k, to_q, roles) AS (VALUES (0, 0, 0, []::VARCHAR[]), (0, 1, 2, ['user:']), (0, 2, 3, ['user:', 'assistant:']),
                                  (1, 0, 1, []), (1, 1, 2, ['user:']), (1, 2, 3, ['user:', 'assistant:']),
                                  (2, 0, 2, []), (2, 1, 3, ['assistant:']), (2, 2, 2, ['assistant:', 'user:']),
                                  (3, 0, 3, []), (3, 1, 2, ['user:']), (3, 2, 3, ['user:', 'assistant:'])),
op(q, e, t, to_q) AS (VALUES (0, 'D', '*', 0), (1, 'D', '*', 1), (2, 'D', '*', 2), (3, 'D', '*', 3),
                             (0, 'R', '*', 2), (1, 'R', '*', 2), (2, 'R', '*', 3), (3, 'R', '*', 2),
                             (0, 'K', 's', 1), (0, 'K', 'u', 2), (1, 'K', 'u', 2), (3, 'K', 'u', 2), (2, 'K', 'a', 3)),
w AS (SELECT conv_id, 0::BIGINT AS i, 0 AS q, {{'cost': 0::BIGINT, 'audit': '', 'said': []::VARCHAR[]}} AS b FROM st
      UNION ALL
      SELECT w.conv_id, w.i + 1, op.to_q, min({{'cost': w.b.cost + 3 * ins.k
               + CASE op.e WHEN 'D' THEN 4 ELSE CASE op.e WHEN 'R' THEN 3 ELSE 0 END + CASE fault WHEN 'truncated' THEN 3 ELSE 0 END END,
             'audit': w.b.audit || repeat('I', ins.k) || op.e,
             'said': w.b.said || ins.roles || CASE op.e WHEN 'D' THEN [] WHEN 'K' THEN [f.role || ':' || f.text]
                       ELSE [CASE op.to_q WHEN 3 THEN 'assistant:' ELSE 'user:' END || f.text] END}})
      FROM w JOIN f ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = w.i + 1 JOIN ins ON ins.q = w.q
             JOIN op ON op.q = ins.to_q AND (op.t = '*' OR op.t = f.t) AND (op.e = 'D' OR fault NOT IN ('blank', 'duplicate'))
      GROUP BY w.conv_id, w.i, op.to_q),
z AS (SELECT st.conv_id, min({{'cost': w.b.cost + 3 * ins.k, 'audit': w.b.audit || repeat('I', ins.k), 'said': w.b.said || ins.roles}}) AS b
      FROM st JOIN w ON st.conv_id IS NOT DISTINCT FROM w.conv_id AND w.i = st.n JOIN ins ON ins.q = w.q
      WHERE ins.to_q IN (0, 3) GROUP BY st.conv_id)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(z.b.cost, 0)::BIGINT AS cost,
       coalesce(z.b.audit, '') AS audit, sha256(coalesce(array_to_string(z.b.said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN st ON a.conv_id IS NOT DISTINCT FROM st.conv_id
     LEFT JOIN z ON a.conv_id IS NOT DISTINCT FROM z.conv_id
"""


@register("op11_turn_repair", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every damaged conversation."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return turn_repair.repair_digests(turn_repair.damage(turns), turns)
