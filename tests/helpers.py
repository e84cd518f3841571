"""Small tables, and a plain Python search to compare with."""

import math
import re
import unicodedata

from lexigrid import IndexStore
from lexigrid.model import BOOSTS, KEYWORDS, QUERY_TERMS, SCOPE
from lexigrid.session import fresh_dir, literal_table

KW = "site string, id bigint, field string, text string"


def keywords(spark, rows):
    return literal_table(spark, KW, rows)


def versioned(spark, rows):
    return literal_table(spark, KEYWORDS, rows)


def term(query_id, ord, text, site="a", attribute=None, **flags):
    names = ("exclude", "phrase", "sub_left", "sub_right")
    return (query_id, site, ord, text, attribute, *[flags.get(n) for n in names], flags.get("is_group", False))


def query_terms(spark, *rows):
    return literal_table(spark, QUERY_TERMS, list(rows))


def scope_table(spark, rows):
    return literal_table(spark, SCOPE, rows)


def boost_table(spark, rows):
    return literal_table(spark, BOOSTS, rows)


def stored(spark, rows, n_buckets=3, version=1):
    store = IndexStore(spark, fresh_dir(spark, "test-index"), n_buckets=n_buckets)
    store.write_version(keywords(spark, rows), version)
    return store


def rows_of(df, *columns):
    return sorted(tuple(r[c] for c in (columns or df.columns)) for r in df.collect())


def hits_of(df):
    found = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["id"], r["score"]))
    return found


def tokenise(text):
    return [t for t in re.split(r"[^\w]+|_", unicodedata.normalize("NFC", text.lower())) if t]


def brute_search(docs, clauses, boosts=None, scope=None):
    """Hits of one query: ``docs`` as keyword rows of its site, ``clauses`` compiled.

    A clause is ``(occur, kind, field, text)``.  Returns ``[(id, score)]``, best first.
    """
    toks = {(i, f): tokenise(t) for _, i, f, t in docs}
    fields = {f for _, f in toks}
    full = {k: v for k, v in toks.items() if v}
    n = {f: sum(1 for _, g in full if g == f) for f in fields}
    avg = {f: sum(len(v) for (_, g), v in full.items() if g == f) / n[f] for f in fields if n[f]}

    def idf(f, word):
        df = sum(1 for (_, g), v in full.items() if g == f and word in v)
        return math.log(1 + (n[f] - df + 0.5) / (df + 0.5))

    def weight(f, i, words, tf):
        dl = len(toks[i, f])
        return sum(idf(f, w) for w in words) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avg[f]))

    def clause_hits(kind, only, text):
        best = {}
        words = tokenise(text)
        wild = text.strip().lower()
        for (i, f), v in full.items():
            if only is not None and only != f:
                continue
            s = None
            if kind == "term":
                parts = [weight(f, i, [w], v.count(w)) for w in words if w in v]
                s = sum(parts) if parts else None
            elif kind == "phrase":
                tf = sum(v[p:p + len(words)] == words for p in range(len(v)))
                s = weight(f, i, words, tf) if tf else None
            else:
                match = {"prefix": str.startswith, "suffix": str.endswith, "contains": str.__contains__}[kind]
                s = 1.0 if any(match(w, wild) for w in v) else None
            if s is not None:
                factor = (boosts or {}).get(f, 1.0) if only is None else 1.0
                best[i] = max(best.get(i, -1.0), s * factor)
        return best

    live = [c for c in clauses if (tokenise(c[3]) if c[1] in ("term", "phrase") else c[3].strip())]
    if not live:
        return []
    scored = [(occur, clause_hits(kind, f, text)) for occur, kind, f, text in live]
    musts = [h for o, h in scored if o == "must"]
    shoulds = [h for o, h in scored if o == "should"]
    nots = [h for o, h in scored if o == "must_not"]
    result = []
    for i in {i for i, _ in toks}:
        if any(i in h for h in nots) or not all(i in h for h in musts):
            continue
        if not musts and shoulds and not any(i in h for h in shoulds):
            continue
        if scope is not None and i not in scope:
            continue
        result.append((i, round(sum(h.get(i, 0.0) for h in musts + shoulds), 6)))
    return sorted(result, key=lambda r: (-r[1], r[0]))
