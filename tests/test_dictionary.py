"""Wildcards by ranges of the dictionary."""

import random

import pytest
from helpers import keywords, query_terms, rows_of, stored, term

from lexigrid import search
from lexigrid.model import Index
from lexigrid.operators import lookups
from lexigrid.operators.clauses import build_clauses
from lexigrid.operators.postings import term_stats

KINDS = {"prefix": {"sub_right": True}, "suffix": {"sub_left": True}, "contains": {"sub_left": True, "sub_right": True}}
MATCH = {"prefix": str.startswith, "suffix": str.endswith, "contains": str.__contains__}


@pytest.fixture(scope="module")
def vocabulary():
    pick = random.Random(4)
    return sorted({"".join(pick.choice("aab\u00e9\u6f22\U00020000") for _ in range(pick.randint(1, 9))) for _ in range(300)})


@pytest.fixture(scope="module")
def store(spark, vocabulary):
    return stored(spark, [("a", i, f"attribute_f{i % 2}", f"{word} {word}") for i, word in enumerate(vocabulary)])


def patterns(vocabulary):
    """Parts of words, and some that are in none."""
    pick = random.Random(8)
    asked = ["a", "aa", "aaa", "\u00e9", "\U00020000", "zz", "aaaaaaaaaaaa", "abzab"]
    for word in pick.sample(vocabulary, 30):
        start = pick.randrange(len(word))
        asked.append(word[start : pick.randint(start + 1, len(word))])
    return [(kind, p) for p in asked for kind in KINDS]


def test_every_pattern_finds_its_words(spark, store, vocabulary):
    asked = patterns(vocabulary)
    rows = query_terms(spark, *[term(n, 0, p, **KINDS[kind]) for n, (kind, p) in enumerate(asked)])
    want = sorted((n, i) for n, (kind, p) in enumerate(asked) for i, word in enumerate(vocabulary) if MATCH[kind](word, p))
    assert rows_of(search(store.index(), rows), "query_id", "id") == want
    # an index without a dictionary gives the same
    served = store.index()
    bare = Index(served.keywords, served.postings, served.term_stats, served.field_stats, served.published)
    assert rows_of(search(bare, rows), "query_id", "id") == want


def test_one_row_per_clause_and_term(spark, store, vocabulary):
    asked = query_terms(spark, *[term(n, 0, p, **KINDS[kind]) for n, (kind, p) in enumerate(patterns(vocabulary))], term(999, 0, "a", attribute="f1", sub_left=True, sub_right=True))
    index = store.index()
    found = lookups.wildcard_lookups(lookups.asked_terms(build_clauses(asked), index.published), index.dictionary)
    keys = rows_of(found, "query_id", "clause", "field", "term")
    assert len(keys) == len(set(keys)) > 100
    assert {f for q, _, f, _ in keys if q == 999} == {"attribute_f1"}
    df = {(f, t): n for f, t, n in rows_of(index.term_stats, "field", "term", "df")}
    assert all(df[f, t] == n for f, t, n in rows_of(found, "field", "term", "df"))


def test_only_ranges_are_read(spark, monkeypatch):
    rows = [("a", i, "attribute_text", f"w{i:05d} {i * 7919 % 100003:06d}x") for i in range(4000)]
    store = stored(spark, rows)
    index = store.index()
    asked = lookups.asked_terms(build_clauses(query_terms(spark, term(1, 0, "w0123", sub_right=True), term(2, 0, "123x", sub_left=True))), index.published)
    found = lookups.wildcard_lookups(asked, index.dictionary, inner=False)
    assert {t for (t,) in rows_of(found.where("query_id = 1"), "term")} == {f"w{i:05d}" for i in range(1230, 1240)}
    plan = found._jdf.queryExecution().explainString(found.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line and "key" in line]
    assert len(pushed) >= 2 and all("GreaterThanOrEqual(key" in line and "LessThanOrEqual(key" in line for line in pushed)
    assert "term_stats" not in plan
    # of each kind's rows only those between the pattern and the last key that begins with it
    kept = []
    ranges = lookups._in_ranges
    monkeypatch.setattr(lookups, "_in_ranges", lambda *a: kept.append(ranges(*a)) or kept[-1])
    lookups.wildcard_lookups(asked, index.dictionary, inner=False)
    assert kept[0].count() <= 10 + rows_of(found, "query_id").count((2,))


def test_many_patterns_are_few_ranges(spark, store, vocabulary):
    index = store.index()
    asked = lookups.asked_terms(build_clauses(query_terms(spark, *[term(n, 0, w, sub_right=True) for n, w in enumerate(vocabulary)])), index.published)
    found = lookups.wildcard_lookups(asked, index.dictionary, inner=False)
    assert found.select("query_id").distinct().count() == len(vocabulary)


def test_dictionary_of_nothing_and_of_empty_terms(spark):
    none = stored(spark, [("a", 1, "attribute_f", "?!")])
    assert none.index().dictionary.count() == 0
    assert rows_of(search(none.index(), query_terms(spark, term(1, 0, "a", sub_right=True)))) == []
    assert keywords(spark, []).count() == 0 and term_stats(none.index().postings).count() == 0
