"""URL filters: host/path rules first, then a weighted URL vocabulary.

Rules and vocabulary are parameters of the call (code, not data).  A rule
``(verdict, host, path)`` fits its host and every subdomain when the url's
path starts with the rule's path; the longest rule (host and path together) wins and
decides.  Other urls are judged by one Aho-Corasick pass over the lower-cased
url that counts *strict* and *soft* terms.  A hit counts only between
boundaries: the characters beside it are not ASCII letters or digits.  A url
is blocked on one strict hit, or on ``soft_min`` distinct soft terms.

Defined cases: a null url or one without ``://`` has an empty host and path
and fits no rule; its whole text (null: empty) still goes through the
vocabulary.  Repeated rows are judged alike; an empty table gives an empty
one.  Columns of the input are kept; the new ones (``host``, ``path``,
``rule``, ``verdict``, ``strict_hits``, ``soft_terms``) replace columns of
the same name.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orchard.llm.common import fresh

#: Fixed rules of the contract.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: One hit rejects.
STRICT = ("casino", "escort", "hentai", "jackpot", "malware", "phishing", "porn", "viagra", "warez", "xxx")
#: ``soft_min`` distinct terms reject.
SOFT = ("ad", "ads", "adult", "banner", "bet", "betting", "bonus", "cheap", "click", "crack", "dating", "deal",
        "deals", "doorway", "download", "feed", "free", "keygen", "loan", "nude", "offer", "pills", "poker", "popup",
        "promo", "replica", "sex", "slots", "spam", "sponsored", "torrent", "track", "tracker", "win")


def _automaton(strict: Sequence[str], soft: Sequence[str]):
    import ahocorasick
    a = ahocorasick.Automaton()
    for w in {*strict, *soft}:
        a.add_word(w, (w, w in set(strict)))
    if len(a):
        a.make_automaton()
    return a


def _hits(auto, text: str) -> tuple[int, list[str]]:
    strict, soft = 0, set()
    n = len(text)
    for end, (w, is_strict) in auto.iter(text):
        a, b = end - len(w), end + 1
        if a >= 0 and text[a].isascii() and text[a].isalnum():
            continue
        if b < n and text[b].isascii() and text[b].isalnum():
            continue
        if is_strict:
            strict += 1
        else:
            soft.add(w)
    return strict, sorted(soft)


def filter_urls(df: DataFrame, url: str = "url", rules: Sequence[tuple[str, str, str]] = RULES,
                strict: Sequence[str] = STRICT, soft: Sequence[str] = SOFT, soft_min: int = 2) -> DataFrame:
    """Add host, path, rule, verdict, strict_hits and soft_terms to ``df``."""
    by_host: dict[str, list[tuple[str, str]]] = {}
    for verdict, host, path in rules:
        by_host.setdefault(host, []).append((path, verdict))
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def split(u: str) -> tuple[str, str]:
        at = u.find("://")
        if at < 0:
            return "", ""
        rest = u[at + 3:]
        cut = min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))
        rest = rest[:cut]
        slash = rest.find("/")
        host, path = (rest, "") if slash < 0 else (rest[:slash], rest[slash:])
        return host.translate(lower), path

    def rule_for(host: str, path: str) -> tuple[str | None, str | None]:
        best = None
        at = 0
        while True:                      # the whole host, then its parents
            for p, v in by_host.get(host[at:], ()):
                if path.startswith(p) and (best is None or len(host[at:] + p) > len(best[0])):
                    best = host[at:] + p, v
            at = host.find(".", at) + 1
            if at == 0:
                return best or (None, None)

    @F.pandas_udf(T.StructType([
        T.StructField("host", T.StringType()), T.StructField("path", T.StringType()),
        T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType()),
        T.StructField("strict_hits", T.IntegerType()), T.StructField("soft_terms", T.ArrayType(T.StringType()))]))
    def judge(it: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        auto = _automaton(strict, soft)
        for urls in it:
            out = []
            for u in urls:
                u = u if isinstance(u, str) else ""
                host, path = split(u)
                rule, verdict = rule_for(host, path)
                hard, terms = _hits(auto, u.translate(lower)) if u and len(auto) else (0, [])
                if rule is None:
                    verdict = "block" if hard or len(terms) >= soft_min else "allow"
                out.append((host, path, rule, verdict, hard, terms))
            yield pd.DataFrame(out, columns=["host", "path", "rule", "verdict", "strict_hits", "soft_terms"])
    new = ("host", "path", "rule", "verdict", "strict_hits", "soft_terms")
    got, = fresh(df, "_judged")
    judged = df.withColumn(got, judge(F.col(url)))
    return judged.select(*[F.col(f"`{c}`") for c in df.columns if c not in new],
                         *[F.col(got)[c].alias(c) for c in new])

