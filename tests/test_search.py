import random

import pytest
from helpers import (
    boost_table,
    brute_search,
    hits_of,
    query_terms,
    scope_table,
    stored,
    term,
)
from pyspark.sql import functions as F

from lexigrid import search

WORDS = ["the", "red", "blue", "widget", "bolt", "ring", "wide", "übung", "a", "b2", "reading", "thread"]


def corpus(seed, n_docs=60):
    """Random documents of one hot word, some empty, in two fields, over two sites."""
    pick = random.Random(seed)
    rows = []
    for i in range(n_docs):
        for field, most in (("attribute_title", 4), ("field_1", 14)):
            size = pick.randint(0, most)
            words = [pick.choice(WORDS) if pick.random() < 0.6 else "the" for _ in range(size)]
            rows.append(("a" if i % 4 else "b", i, field, pick.choice([" ", "-", ", "]).join(words)))
    return rows


# compiled clauses and the query-term rows that give them
QUERIES = {
    1: ([("must", "term", None, "the")], [term(1, 0, "the")]),
    2: ([("must", "term", None, "Red"), ("must_not", "term", None, "blue")], [term(2, 0, "Red"), term(2, 1, "blue", exclude=True)]),
    3: ([("should", "phrase", None, "the the")], [term(3, 0, "the the", phrase=True)]),
    4: ([("should", "phrase", None, "red-widget"), ("should", "phrase", "attribute_title", "the blue")],
        [term(4, 0, "red-widget"), term(4, 1, "the blue", phrase=True, attribute="title")]),
    5: ([("must", "prefix", None, "wid")], [term(5, 0, "wid", sub_right=True)]),
    6: ([("must", "suffix", None, "ing"), ("must", "term", None, "bolt")], [term(6, 0, "ing", sub_left=True), term(6, 1, "bolt")]),
    7: ([("must", "contains", None, "rea")], [term(7, 0, "rea", sub_left=True, sub_right=True)]),
    8: ([("must_not", "term", None, "the")], [term(8, 0, "the", exclude=True)]),
    9: ([("must", "term", "attribute_none", "the")], [term(9, 0, "the", attribute="none")]),
    10: ([("must", "term", None, "red blue.bolt")], [term(10, 0, "red blue.bolt")]),
    11: ([("must", "term", None, "the"), ("should", "phrase", None, "red ring"), ("must_not", "prefix", None, "b")],
         [term(11, 0, "the"), term(11, 1, "red ring", phrase=True), term(11, 2, "b", sub_right=True, exclude=True)]),
    12: ([("must", "term", "attribute_title", "übung")], [term(12, 0, "ÜBUNG", attribute="title")]),
    13: ([("must_not", "contains", None, "e"), ("must_not", "term", None, "?")],
         [term(13, 0, "e", exclude=True, sub_left=True, sub_right=True), term(13, 1, "?", exclude=True)]),
    14: ([], [term(14, 0, "the", is_group=True), term(14, 1, " "), term(14, 2, "?!"), term(14, 3, " ", sub_right=True)]),
    15: ([("should", "phrase", None, "the red nosuchword")], [term(15, 0, "the red nosuchword", phrase=True)]),
}


def terms_of(spark, numbers=QUERIES):
    return query_terms(spark, *[row for q in numbers for row in QUERIES[q][1]])


def expected(rows, site="a", numbers=QUERIES, **options):
    docs = [r for r in rows if r[0] == site]
    found = {q: brute_search(docs, QUERIES[q][0], **options) for q in numbers}
    return {q: hits for q, hits in found.items() if hits}


def same_hits(found, wanted):
    assert found.keys() == wanted.keys()
    for q in wanted:
        assert [i for i, _ in found[q]] == [i for i, _ in wanted[q]], q
        assert [s for _, s in found[q]] == pytest.approx([s for _, s in wanted[q]], abs=2e-6), q


@pytest.fixture(scope="module")
def rows():
    return corpus(1)


@pytest.fixture(scope="module")
def index(spark, rows):
    return stored(spark, rows).index()


def test_all_kinds_at_once_equal_brute_force(spark, rows, index):
    same_hits(hits_of(search(index, terms_of(spark))), expected(rows))


@pytest.mark.parametrize("seed, n_buckets, n_spread", [(2, 1, 1), (3, 7, 5)])
def test_other_corpora_and_layouts(spark, seed, n_buckets, n_spread):
    rows = corpus(seed)
    index = stored(spark, rows, n_buckets).index()
    same_hits(hits_of(search(index, terms_of(spark), n_spread=n_spread)), expected(rows))


@pytest.mark.parametrize("number", [1, 3, 5, 8])
def test_one_kind_alone_plans_only_its_own_branch(spark, rows, index, number):
    found = hits_of(search(index, terms_of(spark, [number])))
    same_hits(found, expected(rows, numbers=[number]))


def test_queries_of_another_site(spark, rows, index):
    terms = terms_of(spark).withColumn("site", F.lit("b"))
    same_hits(hits_of(search(index, terms)), expected(rows, "b"))


def test_top_k_keeps_the_best_and_breaks_ties_by_id(spark, rows, index):
    found = hits_of(search(index, terms_of(spark), k=3))
    same_hits(found, {q: hits[:3] for q, hits in expected(rows).items()})


def test_unlimited_hits(spark, rows, index):
    same_hits(hits_of(search(index, terms_of(spark), k=None)), expected(rows))


def test_scope_limits_hits_and_an_empty_scope_does_not(spark, rows, index):
    ids = [i for i in range(0, 60, 3)]
    scoped = [1, 3, 5, 8]
    scope = scope_table(spark, [(q, i) for q in scoped for i in ids] * 2)
    wanted = expected(rows, numbers=[q for q in QUERIES if q not in scoped])
    wanted |= expected(rows, numbers=scoped, scope=set(ids))
    same_hits(hits_of(search(index, terms_of(spark), scope)), wanted)
    only = hits_of(search(index, terms_of(spark), scope, on_empty_scope="none"))
    same_hits(only, {q: h for q, h in wanted.items() if q in scoped})
    assert hits_of(search(index, terms_of(spark, [1]), on_empty_scope="none")) == {}


def test_boosts_apply_to_unscoped_clauses_only(spark, rows, index):
    boosts = boost_table(spark, [("title", 3.0)])
    found = hits_of(search(index, terms_of(spark), boosts=boosts))
    same_hits(found, expected(rows, boosts={"attribute_title": 3.0}))
    ones = boost_table(spark, [("title", 1.0)])
    same_hits(hits_of(search(index, terms_of(spark), boosts=ones)), expected(rows))


def test_hook_changes_the_clauses(spark, rows, index):
    found = hits_of(search(index, terms_of(spark, [2]), before_query=lambda c: c.where("occur = 'must'")))
    assert found[2] == hits_of(search(index, query_terms(spark, term(2, 0, "red"))))[2]


def test_only_empty_queries_give_no_rows_and_a_stable_schema(spark, index):
    hits = search(index, terms_of(spark, [14]))
    assert hits.columns == ["query_id", "site", "id", "score", "rank"] and hits.count() == 0


def test_postings_join_is_pruned_and_never_nested(spark, index):
    hits = search(index, terms_of(spark, [1, 3, 5]), k=10)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "dynamicpruning" in plan
    assert not any("positions" in line for line in plan.splitlines() if "tf#" in line and "FileScan" in line)


def test_aggregates_and_first_top_k_share_one_shuffle(spark, index):
    plan = search(index, terms_of(spark, [1]), k=10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # by (query, slot), then by query
    assert "REPARTITION_BY_COL" in plan


def test_results_do_not_depend_on_broadcasts(spark, rows, index):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        same_hits(hits_of(search(index, terms_of(spark))), expected(rows))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_clauses_may_share_a_number_and_a_query_its_sites(spark, rows, index):
    both = query_terms(spark, term(1, 0, "red"), term(1, 0, "bolt"))
    apart = query_terms(spark, term(1, 0, "red"), term(1, 1, "bolt"))
    assert hits_of(search(index, both)) == hits_of(search(index, apart))
    sites = query_terms(spark, term(1, 0, "red"), term(1, 0, "red", "b"))
    found = {(r["site"], r["id"], r["score"]) for r in search(index, sites).collect()}
    wanted = {(s, i, v) for s in "ab" for i, v in brute_search([r for r in rows if r[0] == s], [("must", "term", None, "red")])}
    assert {x[:2] for x in found} == {x[:2] for x in wanted}


def test_common_words_of_phrases_meet_only_candidates(spark, index):
    from lexigrid.operators.clauses import build_clauses
    from lexigrid.operators.lookups import asked_terms, exact_lookups, with_boosts
    from lexigrid.operators.matching import phrase_candidates, phrase_lookups, phrase_postings

    clauses = build_clauses(query_terms(spark, term(1, 0, "the the red", phrase=True), term(2, 0, "the b2", phrase=True)))
    lookups = with_boosts(exact_lookups(asked_terms(clauses, index.published), index.term_stats, index.field_stats), None)
    wanted = phrase_lookups(lookups)
    candidates = phrase_candidates(index.postings, wanted)
    needed = phrase_postings(candidates, wanted)
    key = ["site", "version", "bucket", "field", "term", "id"]
    assert index.postings.join(needed, key).count() <= needed.count() <= 3 * candidates.count()


def test_very_long_terms_under_wildcards(spark):
    long = "x" * 25_000 + "needle" + "y" * 25_000
    index = stored(spark, [("a", 1, "f", long), ("a", 2, "f", "needles"), ("a", 3, "f", "ab")]).index()
    terms = query_terms(
        spark, term(1, 0, "xneed", sub_left=True, sub_right=True), term(2, 0, "x" * 100, sub_right=True),
        term(3, 0, "yy", sub_left=True), term(4, 0, "b", sub_left=True, sub_right=True), term(5, 0, "needle", sub_right=True),
    )
    found = {q: [i for i, _ in hits] for q, hits in hits_of(search(index, terms)).items()}
    assert found == {1: [1], 2: [1], 3: [1], 4: [3], 5: [2]}


def test_only_postings_of_asked_terms_meet_candidates(spark, monkeypatch):
    from lexigrid.plans import search as module

    met = {}
    for name in ("candidate_matches", "phrase_matches"):
        real = getattr(module, name)
        monkeypatch.setattr(module, name, lambda rows, *how, name=name, real=real: met.update({name: rows}) or real(rows, *how))
    rows = [("a", n, "attribute_t", f"red bolt w{n} z{n}") for n in range(30)]
    asked = query_terms(spark, term(1, 0, "red"), term(1, 1, "w7"), term(2, 0, "bolt w8", phrase=True))
    found = hits_of(search(stored(spark, rows, n_buckets=1).index(), asked, candidates_from=0))
    assert {q: [i for i, _ in hits] for q, hits in found.items()} == {1: [7], 2: [8]}
    for name in ("candidate_matches", "phrase_matches"):
        assert {r["term"] for r in met[name].collect()} == {"red", "w7", "bolt", "w8"}


def test_ranges_of_terms_lose_none(spark):
    from lexigrid.operators.lookups import in_term_ranges
    from lexigrid.session import literal_table

    words = [f"{c}{n}" for c in "aé漢\U00020000" for n in range(20)]
    table = literal_table(spark, "term string", [(w,) for w in words])
    asked = [(w,) for w in words[::3]]
    assert set(asked) <= {tuple(r) for r in in_term_ranges(table, literal_table(spark, "term string", asked)).collect()}
    few = literal_table(spark, "term string", asked[:5])
    assert sorted(tuple(r) for r in in_term_ranges(table, few).collect()) == sorted(asked[:5])
    assert in_term_ranges(table, few.where("false")).isEmpty()
