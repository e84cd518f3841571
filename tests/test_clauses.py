import pytest
from helpers import query_terms, term

from lexigrid.model import QUERY_OPTIONS, TermDefaults
from lexigrid.operators.clauses import build_clauses
from lexigrid.session import literal_table

FIELDS = "field_id int, handle string, searchable boolean"

CASES = [
    (("foo", {}), ("must", "term", None, "foo")),
    (("foo", {"exclude": True}), ("must_not", "term", None, "foo")),
    (("foo", {"attribute": "title"}), ("must", "term", "attribute_title", "foo")),
    (("foo", {"attribute": "body"}), ("must", "term", "field_7", "foo")),
    (("foo", {"attribute": ""}), ("must", "term", None, "foo")),
    (("foo", {"sub_right": True}), ("must", "prefix", None, "foo")),
    (("foo", {"sub_left": True}), ("must", "suffix", None, "foo")),
    (("foo", {"sub_left": True, "sub_right": True}), ("must", "contains", None, "foo")),
    (("foo", {"sub_right": True, "exclude": True}), ("must_not", "prefix", None, "foo")),
    (("foo bar", {"phrase": True}), ("should", "phrase", None, "foo bar")),
    (("foo bar", {"phrase": True, "exclude": True}), ("should", "phrase", None, "foo bar")),
    (("foo bar", {"phrase": True, "sub_right": True}), ("should", "phrase", None, "foo bar")),
    (("foo bar", {"phrase": True, "attribute": "body"}), ("should", "phrase", "field_7", "foo bar")),
    (("foo-bar", {}), ("should", "phrase", None, "foo-bar")),
    (("foo-bar", {"exclude": True, "sub_left": True}), ("should", "phrase", None, "foo-bar")),
    ((" foo ", {}), ("must", "term", None, "foo")),
    (("foo", {"is_group": True}), None),
    (("foo-bar", {"is_group": True}), None),
]


@pytest.fixture(scope="module")
def compiled(spark):
    rows = [term(i, 0, text, **flags) for i, ((text, flags), _) in enumerate(CASES)]
    fields = literal_table(spark, FIELDS, [(7, "body", True), (9, "body", True)])
    return {r["query_id"]: r for r in build_clauses(query_terms(spark, *rows), fields).collect()}


@pytest.mark.parametrize("number", range(len(CASES)))
def test_truth_table(compiled, number):
    expected = CASES[number][1]
    row = compiled.get(number)
    found = None if row is None else (row["occur"], row["kind"], row["field"], row["text"])
    assert found == expected


def test_options_override_defaults_and_terms_override_options(spark):
    terms = query_terms(spark, term(1, 0, "x"), term(2, 0, "x"), term(2, 1, "y", sub_right=False))
    options = literal_table(spark, QUERY_OPTIONS, [(2, None, True, True)])
    rows = build_clauses(terms, options=options, defaults=TermDefaults(exclude=True)).collect()
    found = {(r["query_id"], r["ord"]): (r["occur"], r["kind"]) for r in rows}
    assert found == {
        (1, 0): ("must_not", "term"), (2, 0): ("must_not", "contains"), (2, 1): ("must_not", "suffix"),
    }


def test_prefix_is_put_before_field_names(spark):
    fields = literal_table(spark, FIELDS, [(7, "body", True)])
    terms = query_terms(spark, term(1, 0, "x", attribute="body"), term(1, 1, "x", attribute="title"))
    rows = build_clauses(terms, fields, prefix="p_").collect()
    assert {r["field"] for r in rows} == {"p_field_7", "p_attribute_title"}


def test_all_white_space_is_trimmed(spark):
    built = build_clauses(query_terms(spark, term(1, 0, "\t wid\x0b\r\n\0")))
    assert [r["text"] for r in built.collect()] == ["wid"]
