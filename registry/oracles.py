"""The same results in plain SQL over the given tables, for the correctness check.

Written apart from the library: search oracles start from clauses compiled by
hand, and tokenise the tables themselves.
"""

from __future__ import annotations

PATTERN = r"[\p{L}\p{M}\p{N}]+"
SINCE = "TIMESTAMP '1998-06-01 00:00:00'"

DOC_KW = "SELECT lang AS site, doc_id AS id, 'attribute_text' AS field, text FROM documents"
PART_KW = """
SELECT 'catalog' AS site, p_partkey AS id, 'attribute_title' AS field, p_name AS text FROM part
UNION ALL SELECT 'catalog', p_partkey, 'attribute_slug', lower(replace(p_name, ' ', '-')) FROM part
UNION ALL SELECT 'catalog', p_partkey, 'field_1', p_brand FROM part
UNION ALL SELECT 'catalog', p_partkey, 'field_2', p_type FROM part"""
ALL_KW = f"{DOC_KW} UNION ALL {PART_KW}"


TOKENS = f"regexp_extract_all(lower(text), '{PATTERN}')"


def tokenised(keywords: str, tokens: str = TOKENS, stops=()) -> str:
    left_out = f"WHERE (site, term) NOT IN ({', '.join(map(str, stops))})" if stops else ""
    return f"""
kw AS ({keywords}),
tok AS (
  SELECT * FROM (
    SELECT site, id, field, CAST(unnest(range(len(toks))) AS INTEGER) AS pos, unnest(toks) AS term
    FROM (SELECT *, {tokens} AS toks FROM kw)
  ) {left_out}
)"""


STATS = """
post AS (
  SELECT site, field, term, id, count(*) AS tf, string_agg(CAST(pos AS VARCHAR), ' ' ORDER BY pos) AS positions
  FROM tok GROUP BY site, field, term, id
),
len AS (SELECT site, field, id, count(*) AS dl FROM tok GROUP BY site, field, id),
fs AS (
  SELECT site, field, count(*) AS n_docs, CAST(sum(dl) AS BIGINT) AS sum_dl FROM len GROUP BY site, field
),
ts AS (SELECT site, field, term, count(*) AS df FROM post GROUP BY site, field, term)"""

_BM25 = """
  ln(1 + (fs.n_docs - ts.df + 0.5) / (ts.df + 0.5))"""


def _saturated(tf: str) -> str:
    return f"{tf} * 2.2 / ({tf} + 1.2 * (0.25 + 0.75 * len.dl / (fs.sum_dl / fs.n_docs)))"


def _value(v) -> str:
    if v is None:
        return "CAST(NULL AS VARCHAR)"
    return str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"


def hits(clauses=None, clause_sql=None, boosts=None, scope=None, k=None, keywords=ALL_KW, scope_only=False,
         tokens=TOKENS, stops=()) -> str:
    """Hits of compiled clauses ``(query_id, site, ord, occur, kind, field, text)``."""
    if clause_sql is None:
        rows = ", ".join("(" + ", ".join(_value(v) for v in row) + ")" for row in clauses)
        clause_sql = f"SELECT * FROM (VALUES {rows}) v(query_id, site, ord, occur, kind, field, text)"
    boost = "1.0"
    if boosts:
        cases = " ".join(f"WHEN m.field = '{f}' THEN {b}" for f, b in boosts.items())
        boost = f"CASE WHEN m.only_field IS NOT NULL THEN 1.0 {cases} ELSE 1.0 END"
    inside = "true"
    scope_cte = ""
    if scope:
        scope_cte = f", scope AS ({scope})"
        inside = """(query_id NOT IN (SELECT query_id FROM scope)
          OR (query_id, id) IN (SELECT (query_id, id) FROM scope))"""
        if scope_only:
            inside = "(query_id, id) IN (SELECT (query_id, id) FROM scope)"
    stop_list = f"CAST({[f'{site} {word}' for site, word in stops]} AS VARCHAR[])"
    return rf"""
WITH {tokenised(keywords, tokens, stops)}, {STATS},
raw AS ({clause_sql}),
c AS (
  SELECT *, row_number() OVER () AS cid FROM (
    SELECT query_id, site, ord, occur, kind, field AS only_field, trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(13)) AS text,
      {tokens} AS toks, list_filter(range(len(toks)), lambda i: NOT list_contains({stop_list}, site || ' ' || toks[i + 1])) AS kept FROM raw)
  WHERE CASE WHEN kind IN ('term', 'phrase') THEN len(kept) > 0 ELSE text <> '' END
    AND site IN (SELECT site FROM kw)
),
q AS (
  SELECT query_id, site, count(*) FILTER (occur = 'must') AS n_must,
    count(*) FILTER (occur = 'should') AS n_should FROM c GROUP BY query_id, site
),
ct AS (
  SELECT cid, query_id, site, ord, occur, kind, only_field, len(kept) AS n_tokens,
    unnest(kept) AS off, unnest(list_transform(kept, lambda i: toks[i + 1])) AS term
  FROM c WHERE kind IN ('term', 'phrase')
),
term_hits AS (
  SELECT ct.cid, ct.query_id, ct.only_field, post.field, post.id,
    sum({_BM25} * {_saturated('post.tf')}) AS s
  FROM ct
  JOIN post ON post.site = ct.site AND post.term = ct.term AND (ct.only_field IS NULL OR ct.only_field = post.field)
  JOIN len ON len.site = post.site AND len.field = post.field AND len.id = post.id
  JOIN fs ON fs.site = post.site AND fs.field = post.field
  JOIN ts ON ts.site = post.site AND ts.field = post.field AND ts.term = post.term
  WHERE ct.kind = 'term' GROUP BY ALL
),
starts AS (
  SELECT ct.cid, ct.query_id, ct.site, ct.only_field, tok.field, tok.id, tok.pos - ct.off AS start
  FROM ct JOIN tok ON tok.site = ct.site AND tok.term = ct.term AND (ct.only_field IS NULL OR ct.only_field = tok.field)
  WHERE ct.kind = 'phrase'
  GROUP BY ct.cid, ct.query_id, ct.site, ct.only_field, tok.field, tok.id, tok.pos - ct.off, ct.n_tokens
  HAVING count(*) = ct.n_tokens
),
phrase_idf AS (
  SELECT ct.cid, ts.field, sum({_BM25}) AS idf
  FROM ct JOIN ts ON ts.site = ct.site AND ts.term = ct.term
  JOIN fs ON fs.site = ts.site AND fs.field = ts.field
  WHERE ct.kind = 'phrase' GROUP BY ct.cid, ts.field
),
phrase_tf AS (
  SELECT cid, query_id, site, only_field, field, id, count(*) AS tf FROM starts GROUP BY ALL
),
phrase_hits AS (
  SELECT p.cid, p.query_id, p.only_field, p.field, p.id, i.idf * {_saturated('p.tf')} AS s
  FROM phrase_tf p JOIN phrase_idf i ON i.cid = p.cid AND i.field = p.field
  JOIN len ON len.site = p.site AND len.field = p.field AND len.id = p.id
  JOIN fs ON fs.site = p.site AND fs.field = p.field
),
wild_hits AS (
  SELECT DISTINCT c.cid, c.query_id, c.only_field, post.field, post.id, CAST(1.0 AS DOUBLE) AS s
  FROM c JOIN post ON post.site = c.site AND (c.only_field IS NULL OR c.only_field = post.field) AND CASE c.kind
    WHEN 'prefix' THEN starts_with(post.term, lower(c.text))
    WHEN 'suffix' THEN ends_with(post.term, lower(c.text))
    WHEN 'contains' THEN contains(post.term, lower(c.text)) ELSE false END
),
m AS (
  SELECT * FROM term_hits UNION ALL SELECT * FROM phrase_hits UNION ALL SELECT * FROM wild_hits
),
per_clause AS (
  SELECT m.cid, m.query_id, m.id, max(m.s * {boost}) AS s FROM m GROUP BY m.cid, m.query_id, m.id
),
found AS (
  SELECT p.query_id, c.site, p.id, coalesce(sum(p.s) FILTER (c.occur <> 'must_not'), 0.0) AS score,
    count(*) FILTER (c.occur = 'must') AS must_hits,
    count(*) FILTER (c.occur = 'must_not') AS not_hits,
    count(*) FILTER (c.occur = 'should') AS should_hits
  FROM per_clause p JOIN c ON c.cid = p.cid GROUP BY p.query_id, c.site, p.id
){scope_cte},
accepted AS (
  SELECT f.query_id, f.site, f.id, round(f.score, 6) AS score FROM found f JOIN q ON q.query_id = f.query_id AND q.site = f.site
  WHERE not_hits = 0 AND must_hits = n_must AND (n_must > 0 OR should_hits > 0)
  UNION ALL
  SELECT DISTINCT q.query_id, q.site, kw.id, 0.0 FROM q JOIN kw ON kw.site = q.site
  WHERE n_must = 0 AND n_should = 0
    AND (q.query_id, q.site, kw.id) NOT IN (SELECT (query_id, site, id) FROM found WHERE not_hits > 0)
),
ranked AS (
  SELECT query_id, site, id, score,
    row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id, site) AS rank
  FROM accepted WHERE {inside}
)
SELECT CAST(query_id AS INTEGER) AS query_id, site, id, CAST(score AS DOUBLE) AS score,
  CAST(rank AS INTEGER) AS rank
FROM ranked WHERE {"true" if k is None else f"rank <= {k}"}
"""


def must(q, o, text, site="en", field=None, kind="term"):
    return (q, site, o, "must", kind, field, text)


def must_not(q, o, text, site="en", field=None, kind="term"):
    return (q, site, o, "must_not", kind, field, text)


def should(q, o, text, site="en", field=None):
    return (q, site, o, "should", "phrase", field, text)


TITLE, KIND = "attribute_title", "field_2"

SEARCH = {
    "search_bm25": hits([must(1, 0, "that"), must(1, 1, "with"), must(2, 0, "une", "fr"), must(2, 1, "la", "fr")]),
    "search_required": hits([
        must(1, 0, "the"), must(1, 1, "and"), must(2, 0, "die", "de"), must(3, 0, "los", "es"),
        must(4, 0, "red", "catalog"), must(4, 1, "bolt", "catalog"), must(5, 0, "the.and"),
    ]),
    "search_excluded": hits([
        must_not(1, 0, "the"), must(2, 0, "with"), must_not(2, 1, "that"),
        must_not(3, 0, "widget", "catalog"), must(3, 1, "economy", "catalog"),
    ]),
    "search_phrase": hits([
        should(1, 0, "of the"), should(2, 0, "de la", "fr"), should(3, 0, "the the"),
        should(4, 0, "red widget", "catalog"), should(4, 1, "blue bolt", "catalog", TITLE),
    ]),
    "search_slug": hits([
        should(1, 0, "by-nc"), should(2, 0, "red-widget", "catalog"), must(2, 1, "small", "catalog"),
        should(3, 0, "blue-bolt", "catalog"),
    ]),
    "search_field": hits([
        must(1, 0, "red", "catalog", TITLE), must(2, 0, "small", "catalog", KIND),
        must(3, 0, "small", "catalog", TITLE), must(4, 0, "brand", "catalog", "field_1"),
        must(5, 0, "the", "en", "attribute_text"), must(6, 0, "the", "en", "attribute_nowhere"),
    ]),
    "search_prefix": hits([
        must(1, 0, "ther", kind="prefix"), must(2, 0, "wid", "catalog", kind="prefix"),
        must(3, 0, "Eau", "fr", kind="prefix"), must(3, 1, "la", "fr"),
    ]),
    "search_suffix": hits([
        must(1, 0, "tion", kind="suffix"), must(2, 0, "lt", "catalog", kind="suffix"),
        must(3, 0, "heit", "de", kind="suffix"),
    ]),
    "search_contains": hits([
        must(1, 0, "ouea", kind="contains"), must(2, 0, "idge", "catalog", kind="contains"),
        must(3, 0, "a", "es", kind="contains"),
    ]),
    "search_boolean": hits([
        must(1, 0, "the"), must_not(1, 1, "with"), should(1, 2, "of the"),
        must_not(1, 3, "tion", kind="prefix"), should(2, 0, "of the"), must_not(2, 1, "and"),
        must(3, 0, "large", "catalog", KIND), must(3, 1, "wid", "catalog", TITLE, "prefix"),
        should(3, 2, "red widget", "catalog"), must(4, 0, "nosuchterm"), must(4, 1, "the"),
        must(5, 0, "the"), must(5, 0, "red", "catalog"), must(6, 0, "red", "catalog"), must(6, 0, "bolt", "catalog"),
        must_not(7, 0, "red", "catalog"), must(7, 0, "with"),
    ]),
    "search_scoped": hits(
        [must(1, 0, "the"), must(2, 0, "the"), must_not(3, 0, "the"), should(4, 0, "of the")],
        scope="SELECT unnest([1, 3, 4]) AS query_id, doc_id AS id FROM labels WHERE quality = 1",
    ),
    "search_boosted": hits(
        [
            must(1, 0, "small", "catalog"), must(2, 0, "red", "catalog"),
            must(3, 0, "small", "catalog", TITLE), must(4, 0, "wid", "catalog", kind="prefix"),
            should(5, 0, "red widget", "catalog"),
        ],
        boosts={TITLE: 3.0, KIND: 0.5},
    ),
    "search_topk": hits(
        [
            must(1, 0, "the"), must(2, 0, "de", "fr"), must(3, 0, "small", "catalog"),
            must(4, 0, "e", kind="suffix"),
        ],
        k=10,
    ),
    "search_empty": hits([must(6, 0, "that")]),
    "search_hook": hits([
        must(1, 0, "small", "catalog", TITLE), must(2, 0, "widget", "catalog", TITLE),
    ]),
    "search_batch": hits(
        clause_sql="""SELECT CAST(item_id AS INTEGER) AS query_id, 'en' AS site, 0 AS ord,
          'should' AS occur, 'phrase' AS kind, CAST(NULL AS VARCHAR) AS field, text FROM benchmark"""
    ),
}

ORDERS = """SELECT o_orderpriority AS site, o_orderkey AS id, o_orderstatus AS type,
  CAST(o_totalprice AS VARCHAR) AS price, o_orderdate FROM orders"""
ORDER_KW = f"""
  SELECT site, id, 'attribute_priority' AS field, site AS text FROM ({ORDERS}) WHERE o_orderdate >= {SINCE}
  UNION ALL
  SELECT site, id, 'attribute_price', price FROM ({ORDERS}) WHERE o_orderdate >= {SINCE}"""

TYPES = """SELECT p_brand AS type, min(p_size) = 1 AS has_titles,
  list(DISTINCT lower(p_type)) FILTER (p_size = 50) AS attributes FROM part GROUP BY p_brand"""
MAPPING = f"""
  SELECT 'attribute_title' AS field UNION SELECT 'attribute_slug'
  UNION SELECT 'attribute_' || unnest(attributes) FROM ({TYPES})
  UNION SELECT 'field_' || n_nationkey FROM nation WHERE n_regionkey > 0"""

VERSIONED = f"""
  SELECT site, CAST(1 AS BIGINT) AS version, id, field, text FROM ({DOC_KW})
  UNION ALL
  SELECT site, CAST(2 AS BIGINT), id, field, text FROM ({DOC_KW}) WHERE id IN (SELECT doc_id FROM labels)"""
POINTERS = "(VALUES ('en', CAST(2 AS BIGINT)), ('de', 1), ('fr', 1)) p(site, version)"
VERSION_STATS = f"""
  SELECT site, version, count(DISTINCT id) AS n_docs, CAST(sum(strlen(text)) AS BIGINT) AS n_bytes
  FROM ({VERSIONED}) GROUP BY site, version"""

CHANGES = """
  SELECT lang AS site, doc_id AS id, 'attribute_text' AS field, 'Changed: ' || text AS text FROM documents
  WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)
  UNION ALL
  SELECT 'en', item_id + 1000000000000, 'attribute_text', text FROM benchmark"""

LATEST = """
SELECT site, id, op, seq, field, text FROM (
  SELECT 'users' AS site, user_id AS id,
    CASE WHEN event_type = 'error' THEN 'delete' ELSE 'upsert' END AS op, event_id AS seq,
    'attribute_event' AS field, event_type || ' ' || props AS text,
    row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS nth
  FROM events WHERE NOT value < 1.0)
WHERE nth = 1 AND op <> 'delete'"""

STOPS = """(VALUES ('en', 'the'), ('en', 'of'), ('en', 'and'), ('en', 'with'), ('fr', 'de'),
  ('fr', 'la'), ('fr', 'le'), ('de', 'die'), ('de', 'und'), ('es', 'de'), ('es', 'los')) s(lang, term)"""

CLAUSES = r"""
WITH w AS (
  SELECT p_partkey, p_type, p_size,
    list_append(string_split(p_name, ' '), replace(p_name, ' ', '-')) AS words FROM part
), t AS (
  SELECT *, unnest(words) AS term, CAST(unnest(range(len(words))) AS INTEGER) AS ord FROM w
)
SELECT CAST(p_partkey AS INTEGER) AS query_id, 'catalog' AS site, ord,
  CASE WHEN p_size = 7 OR contains(term, '-') THEN 'should'
       WHEN p_type = 'MEDIUM' THEN 'must_not' ELSE 'must' END AS occur,
  CASE WHEN p_size = 7 OR contains(term, '-') THEN 'phrase'
       WHEN p_type = 'ECONOMY' THEN 'contains' WHEN p_type = 'LARGE' THEN 'suffix'
       WHEN p_type = 'SMALL' THEN 'prefix' ELSE 'term' END AS kind,
  CASE WHEN p_size > 40 THEN 'field_2' END AS field, term AS text
FROM t WHERE p_size <> 9"""

HANDLES = "(VALUES (1, 'brand'), (2, 'kind'), (3, 'economy'), (7, 'small')) h(field_id, handle)"

JOB_CLAUSES = [
    must(1, 0, "the"), must(2, 0, "changed"), must(3, 0, "red", "catalog"), must(4, 0, "die", "de"),
    should(5, 0, "of the"), must(6, 0, "small", "catalog"), must(7, 0, "with", "copy"),
]
UPSERTED = f"""
  SELECT * FROM ({ALL_KW}) WHERE (site, id) NOT IN (SELECT (site, id) FROM ({CHANGES}))
  UNION ALL SELECT * FROM ({CHANGES})"""

# after changes, removal of bad documents and a purge of what is neither labelled nor new
LAYERED = f"""
  SELECT * FROM ({UPSERTED}) WHERE (site = 'catalog' OR id NOT IN (SELECT doc_id FROM labels WHERE quality = 0))
    AND (id IN (SELECT doc_id FROM labels) OR id IN (SELECT item_id + 1000000000000 FROM benchmark))"""

# stop words of each site, left out of index and queries; the queries as compiled
SITE_STOPS = [
    ("en", "the"), ("en", "of"), ("en", "and"), ("en", "with"), ("fr", "de"), ("fr", "la"), ("fr", "le"),
    ("de", "die"), ("de", "und"), ("es", "de"), ("es", "los"), ("catalog", "the"), ("catalog", "of"), ("catalog", "and"), ("catalog", "with"),
]
STOPPED_CLAUSES = [
    must(1, 0, "the"), must(1, 1, "that"), must_not(2, 0, "of"), must(2, 1, "in"), should(3, 0, "in the that"),
    should(4, 0, "the in"), should(5, 0, "of the"), should(5, 1, "that of"), must(6, 0, "the and"),
    must(7, 0, "th", kind="prefix"), should(8, 0, "la que de", "es"), must(9, 0, "la", "fr"), must(9, 1, "une", "fr"), must(10, 0, "red", "catalog"),
]
IDEOGRAPHS = "translate(text, 'etaoinshr', '的一是不了人かなー')"
IDEOGRAPH_KW = f"SELECT lang AS site, doc_id AS id, 'attribute_text' AS field, {IDEOGRAPHS} AS text FROM documents"
_UNSPACED = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}ー"
PAIRS = rf"""flatten(list_transform(
  flatten(list_transform(regexp_extract_all(lower(text), '{PATTERN}'), lambda r: regexp_extract_all(r, '[{_UNSPACED}]+|[^{_UNSPACED}]+'))),
  lambda s: CASE WHEN regexp_matches(s, '^[{_UNSPACED}]') AND length(s) > 1
    THEN list_transform(range(1, length(s)), lambda i: substring(s, i, 2)) ELSE [s] END))"""

JOBS = {
    "search_stopwords": hits(STOPPED_CLAUSES, stops=SITE_STOPS),
    "delta_stopwords": hits(STOPPED_CLAUSES, keywords=LAYERED, stops=SITE_STOPS),
    "compact_stopwords": hits(STOPPED_CLAUSES, keywords=UPSERTED, stops=SITE_STOPS),
    "analyze_cjk": f"WITH {tokenised(IDEOGRAPH_KW, PAIRS)} SELECT site, id, field, pos, term FROM tok",
    "search_cjk": hits([
        must(1, 0, "一な"), should(2, 0, "一な的"), must(3, 0, "是"), must(4, 0, "一な的"), should(4, 1, "的か 的か"), must(5, 0, "d"),
        must(6, 0, "是", "fr", kind="prefix"), must_not(6, 1, "的か", "fr"),
    ], keywords=IDEOGRAPH_KW, tokens=PAIRS),
    "delta_search": hits(JOB_CLAUSES, keywords=LAYERED),
    "delta_merged_search": hits(JOB_CLAUSES, keywords=LAYERED),
    "delta_stats": f"WITH {tokenised(LAYERED)}, {STATS} SELECT * FROM ts JOIN fs USING (site, field)",
    "stream_search": hits(
        [
            must(1, 0, "click", "users"), must(2, 0, "view", "users"), must_not(3, 0, "click", "users"),
            must(4, 0, "purchase", "users"),
        ],
        keywords=f"SELECT site, id, field, text FROM ({LATEST})",
    ),
    "compact_search": hits(JOB_CLAUSES, keywords=UPSERTED),
    "compact_after_reload": ALL_KW,
    "purge_orphans_search": hits(JOB_CLAUSES, keywords=f"SELECT * FROM ({ALL_KW}) WHERE id IN (SELECT doc_id FROM labels)"),
    "bulk_delete_search": hits(
        JOB_CLAUSES,
        keywords=f"SELECT * FROM ({ALL_KW}) WHERE site = 'catalog' OR id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)",
    ),
    "delete_search": hits(JOB_CLAUSES, keywords=f"SELECT * FROM ({ALL_KW}) WHERE site <> 'catalog' OR id <> 7"),
    "reindex_search": hits(
        JOB_CLAUSES,
        keywords=f"SELECT * FROM ({ALL_KW}) WHERE site <> 'catalog' OR field IN ('attribute_title', 'field_1')",
    ),
    "mapping_search": hits(
        JOB_CLAUSES,
        keywords=f"SELECT * FROM ({ALL_KW}) WHERE field IN ('attribute_text', 'attribute_slug', 'field_2', 'field_9')",
    ),
    "clone_search": hits(
        JOB_CLAUSES, keywords=f"{ALL_KW} UNION ALL SELECT 'copy', id, field, text FROM ({DOC_KW}) WHERE site = 'en'"
    ),
    "stored_index_stats": f"""SELECT site, CAST(1 AS BIGINT) AS version, count(DISTINCT id) AS n_docs,
      CAST(sum(strlen(text)) AS BIGINT) AS n_bytes FROM ({ALL_KW}) GROUP BY site""",
}

CLAUSES_OPTIONS = r"""
WITH f AS (
  SELECT p_partkey, p_type, p_size, p_size < 30 AS has,
    list_append(string_split(p_name, ' '), replace(p_name, ' ', '-')) AS words FROM part
), t AS (
  SELECT *, unnest(words) AS term, CAST(unnest(range(len(words))) AS INTEGER) AS ord,
    p_type = 'MEDIUM' OR p_size < 10 AS exclude,
    p_type IN ('LARGE', 'ECONOMY') OR (has AND p_size % 2 = 0) AS sub_left,
    p_type IN ('SMALL', 'ECONOMY') OR (has AND p_size > 20 AND p_size % 3 = 0) AS sub_right FROM f
)
SELECT CAST(p_partkey AS INTEGER) AS query_id, 'catalog' AS site, ord,
  CASE WHEN p_size = 7 OR contains(term, '-') THEN 'should' WHEN exclude THEN 'must_not' ELSE 'must' END AS occur,
  CASE WHEN p_size = 7 OR contains(term, '-') THEN 'phrase' WHEN sub_left AND sub_right THEN 'contains'
       WHEN sub_left THEN 'suffix' WHEN sub_right THEN 'prefix' ELSE 'term' END AS kind,
  CASE WHEN p_size > 40 THEN 'field_2' END AS field, term AS text
FROM t WHERE p_size <> 9"""

ORACLES = {
    **JOBS,
    "clauses_options": CLAUSES_OPTIONS,
    "search_scope_only": hits(
        [must(1, 0, "the"), must(2, 0, "the"), must_not(3, 0, "the"), should(4, 0, "of the")],
        scope="SELECT unnest([1, 3, 4]) AS query_id, doc_id AS id FROM labels WHERE quality = 1", scope_only=True,
    ),
    "prefixed_names": f"""SELECT p_partkey, lower(p_type) AS attribute,
        coalesce('my_field_' || h.field_id, 'my_attribute_' || lower(p_type)) AS field, lower(p_type) AS handle
      FROM part LEFT JOIN {HANDLES} ON h.handle = lower(p_type)""",
    "language_stopwords": f"""WITH {tokenised(DOC_KW)}, left_over AS (
        SELECT * FROM tok WHERE (site, term) NOT IN (VALUES ('en', 'the'), ('de', 'und'), ('fr', 'les'), ('es', 'los'), ('de', 'dokument')))
      SELECT site, sum(CASE WHEN term IN ('the', 'und', 'les', 'los') THEN 1 ELSE 0 END)::BIGINT AS n_listed,
        sum(CASE WHEN term IN ('never', 'catalog') THEN 1 ELSE 0 END)::BIGINT AS n_unlisted FROM left_over GROUP BY site""",
    "worklist_chosen": "SELECT o_orderkey AS id, o_orderstatus AS type FROM orders WHERE o_orderstatus IN ('O', 'P')",
    "site_elements": "SELECT o_orderpriority AS site, o_orderkey AS id, o_orderstatus AS type FROM orders WHERE o_orderpriority = '2-HIGH'",
    "live_ids": "SELECT o_orderkey AS id FROM orders",
    "delete_document": f"SELECT * FROM ({ALL_KW}) WHERE site <> 'catalog' OR id <> 7",
    "worklist_full": "SELECT o_orderkey AS id, o_orderstatus AS type FROM orders",
    "updated_since": f"SELECT o_orderkey AS id, o_orderstatus AS type FROM orders WHERE o_orderdate >= {SINCE}",
    "hydrate_worklist": f"SELECT site, id, type, price FROM ({ORDERS}) WHERE o_orderdate >= {SINCE}",
    "catch_up_since": ORDER_KW,
    "fanout_reindex": f"SELECT *, unnest(['database', 'search']) AS sink FROM ({ORDER_KW})",
    "eligible_types": f"SELECT type, has_titles FROM ({TYPES}) WHERE has_titles OR len(coalesce(attributes, [])) > 0",
    "type_counts": f"""SELECT p_brand AS type, count(*) AS n FROM part WHERE p_brand IN
      (SELECT type FROM ({TYPES}) WHERE has_titles OR len(coalesce(attributes, [])) > 0) GROUP BY p_brand""",
    "build_keywords": """
      SELECT 'catalog' AS site, p_partkey AS id, 'attribute_title' AS field, p_name AS text
        FROM part WHERE p_type IN ('ECONOMY', 'LARGE')
      UNION ALL SELECT 'catalog', p_partkey, 'attribute_slug', lower(replace(p_name, ' ', '-'))
        FROM part WHERE p_type IN ('ECONOMY', 'LARGE', 'SMALL')
      UNION ALL SELECT 'catalog', p_partkey, 'attribute_vendor', upper(p_brand)
        FROM part WHERE p_type IN ('LARGE', 'SMALL')
      UNION ALL SELECT 'catalog', p_partkey, 'field_1', p_brand FROM part
      UNION ALL SELECT 'catalog', p_partkey, 'field_2', lower(p_type) FROM part""",
    "build_mapping": MAPPING,
    "mapping_diff": f"""WITH have AS (SELECT DISTINCT field FROM ({ALL_KW})), want AS ({MAPPING})
      SELECT field, 'removed' AS change FROM have WHERE field NOT IN (SELECT field FROM want)
      UNION ALL SELECT field, 'added' FROM want WHERE field NOT IN (SELECT field FROM have)""",
    "map_attribute": f"""SELECT p_partkey, lower(p_type) AS attribute,
        coalesce('field_' || h.field_id, 'attribute_' || lower(p_type)) AS field
      FROM part LEFT JOIN {HANDLES} ON h.handle = lower(p_type)""",
    "map_field": f"""SELECT p_partkey,
        CASE WHEN p_size < 10 THEN 'field_' || p_size WHEN p_type = 'SMALL' THEN 'other_' || p_size
          ELSE 'attribute_' || lower(p_name) END AS field,
        CASE WHEN p_size < 10 THEN coalesce(h.handle, 'field not found for ID ' || p_size)
          WHEN p_type = 'SMALL' THEN 'Unknown field other_' || p_size ELSE lower(p_name) END AS handle
      FROM part LEFT JOIN {HANDLES} ON h.field_id = p_size""",
    "analyze_tokens": f"WITH {tokenised(DOC_KW)} SELECT * FROM tok",
    "analyze_stopwords": f"""WITH {tokenised(DOC_KW)}
      SELECT * FROM tok WHERE (site, term) NOT IN (SELECT (lang, term) FROM {STOPS})""",
    "source_explained": f"""SELECT site, id, CASE field WHEN 'field_1' THEN 'brand' WHEN 'field_2' THEN 'kind'
        ELSE substr(field, 11) END AS handle, text AS source,
        array_to_string(regexp_extract_all(lower(text), '{PATTERN}'), ' ') AS tokens FROM ({ALL_KW})""",
    "postings": f"""WITH {tokenised(ALL_KW)}, {STATS}
      SELECT p.site, p.field, p.term, p.id, p.tf, len.dl, p.positions FROM post p
      JOIN len ON len.site = p.site AND len.field = p.field AND len.id = p.id""",
    "term_stats": f"WITH {tokenised(ALL_KW)}, {STATS} SELECT * FROM ts",
    "field_stats": f"WITH {tokenised(ALL_KW)}, {STATS} SELECT * FROM fs",
    "dictionary": f"""WITH {tokenised(ALL_KW)}, {STATS},
ways AS (
  SELECT *, 'prefix' AS kind, term AS key FROM ts
  UNION ALL SELECT *, 'suffix', array_to_string(list_transform(range(length(term), 0, -1), lambda i: substring(term, i, 1)), '') FROM ts
  UNION ALL SELECT *, 'contains', unnest(list_distinct(list_transform(range(1, length(term) + 1), lambda i: substring(term, i, 3)))) FROM ts
)
SELECT site, field, kind, key, count(*) AS n_terms, CAST(sum(df) AS BIGINT) AS df, min(term) AS first_term
FROM ways GROUP BY site, field, kind, key""",
    "clauses": CLAUSES,
    **SEARCH,
    "search_candidates": SEARCH["search_boolean"],
    "search_candidates_scoped": SEARCH["search_scoped"],
    "indexed_ids": f"SELECT DISTINCT site, id FROM ({ALL_KW})",
    "source": f"SELECT site, CAST(1 AS BIGINT) AS version, id, field, text FROM ({ALL_KW}) WHERE id = 7",
    "upsert_documents": f"""WITH ch AS ({CHANGES})
      SELECT * FROM ({DOC_KW}) WHERE (site, id) NOT IN (SELECT (site, id) FROM ch)
      UNION ALL SELECT * FROM ch""",
    "bulk_delete": f"SELECT * FROM ({DOC_KW}) WHERE id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)",
    "reindex_projection": f"""SELECT site, CAST(2 AS BIGINT) AS version, id, field, text FROM ({ALL_KW})
      WHERE field IN ('attribute_text', 'attribute_title', 'field_2', 'field_9')""",
    "clone_site": f"""SELECT 'copy' AS site, CAST(7 AS BIGINT) AS version, id, field, text
      FROM ({DOC_KW}) WHERE site = 'en'""",
    "drop_site": f"SELECT * FROM ({VERSIONED}) WHERE site <> 'en'",
    "orphan_ids": f"SELECT DISTINCT site, id FROM ({DOC_KW}) WHERE id NOT IN (SELECT doc_id FROM labels)",
    "purge_orphans": f"SELECT * FROM ({DOC_KW}) WHERE id IN (SELECT doc_id FROM labels)",
    "current_index": f"SELECT v.* FROM ({VERSIONED}) v JOIN {POINTERS} USING (site, version)",
    "purge_versions": f"""SELECT v.* FROM ({VERSIONED}) v LEFT JOIN {POINTERS} ON v.site = p.site
      WHERE p.version IS NULL OR p.version = v.version""",
    "orphaned_versions": f"""SELECT DISTINCT v.site, v.version FROM ({VERSIONED}) v
      JOIN {POINTERS} ON v.site = p.site WHERE p.version <> v.version""",
    "index_stats": f"SELECT s.* FROM ({VERSION_STATS}) s JOIN {POINTERS} USING (site, version)",
    "site_status": f"""SELECT x.site, s.version, s.n_docs, s.n_bytes
      FROM (VALUES ('en'), ('fr'), ('de'), ('es'), ('catalog'), ('xx')) x(site)
      LEFT JOIN (SELECT s.* FROM ({VERSION_STATS}) s JOIN {POINTERS} USING (site, version)) s ON s.site = x.site""",
    "list_versions": f"""SELECT lower('Texts_' || s.site) || '_' || s.version AS name, s.site, s.version,
        s.n_docs, s.n_bytes, p.version IS NULL AS orphaned
      FROM ({VERSION_STATS}) s LEFT JOIN {POINTERS} ON s.site = p.site AND s.version = p.version""",
    "latest_wins": LATEST,
    "stream_index": LATEST,
}
