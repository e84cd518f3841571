from helpers import keywords, rows_of, tokenise

from lexigrid.functions.analysis import analyze, explain_source, remove_stopwords
from lexigrid.functions.languages import LANGUAGE_NAMES, SPARK_LISTS, stopwords
from lexigrid.functions.names import listed, map_attribute, map_field, version_name
from lexigrid.model import Analyzer
from lexigrid.operators.postings import _token_grouper, postings
from lexigrid.session import literal_table
from pyspark.sql import functions as F

ROWS = [
    ("a", 1, "attribute_t", "The red, RED-red Übung's 3rd"), ("a", 2, "attribute_t", "?!"), ("a", 3, "field_7", ""),
    ("b", 1, "field_8", "la vie est la vie"), ("b", 2, "odd", "x" * 50 + " " + "y " * 3000),
]
FIELDS = "field_id int, handle string, searchable boolean"


def test_tokens_keep_order_and_positions(spark):
    found = rows_of(analyze(keywords(spark, ROWS)), "site", "id", "field", "pos", "term")
    wanted = sorted((s, i, f, p, t) for s, i, f, x in ROWS for p, t in enumerate(tokenise(x)))
    assert found == wanted


def test_other_analyzers(spark):
    rows = keywords(spark, [("a", 1, "f", "Foo-Bar baz")])
    found = analyze(rows, Analyzer(pattern=r"[^\s]+", lowercase=False))
    assert rows_of(found, "pos", "term") == [(0, "Foo-Bar"), (1, "baz")]


def test_postings_equal_grouped_tokens(spark):
    rows = keywords(spark, ROWS).withColumn("version", F.lit(1).cast("bigint"))
    found = {
        (r["site"], r["id"], r["field"], r["term"]): (r["tf"], r["dl"], r["head"], list(r["positions"]))
        for r in postings(rows, 4).collect()
    }
    wanted = {}
    for s, i, f, x in ROWS:
        words = tokenise(x)
        for t in set(words):
            at = [p for p, w in enumerate(words) if w == t]
            wanted[s, i, f, t] = (len(at), len(words), at[0] == 0, at)
    assert found == wanted


def test_grouping_does_not_depend_on_batches():
    import pyarrow as pa

    docs = [["b", "a", "b"], ["c"], ["a"] * 7, ["d", "c", "d", "d"]]
    n = len(docs)
    batch = pa.RecordBatch.from_pydict({
        "site": ["s"] * n, "version": [1] * n, "id": list(range(n)), "field": ["f"] * n,
        "tokens": pa.array(docs, pa.list_(pa.string())),
    })

    def rows(chunk, batches):
        out = [r for b in _token_grouper(chunk)(iter(batches)) for r in b.to_pylist()]
        return sorted(out, key=lambda r: (r["id"], r["term"]))

    whole = rows(1000, [batch])
    assert whole[0] == {
        "site": "s", "version": 1, "id": 0, "field": "f", "term": "a", "tf": 1, "dl": 3, "head": False, "positions": [1],
    }
    assert rows(1, [batch]) == rows(4, [batch]) == rows(5, [batch.slice(0, 1), batch.slice(1)]) == whole


def test_stopwords_leave_positions_alone(spark):
    sites = literal_table(spark, "site string, lang string", [("a", "en"), ("b", "fr"), ("c", "xx")])
    extra = literal_table(spark, "lang string, term string", [("fr", "vie"), ("xx", "q")])
    rows = keywords(spark, [("a", 1, "f", "the red of vie"), ("b", 1, "f", "la vie rouge"), ("c", 1, "f", "the q")])
    found = remove_stopwords(analyze(rows), sites, stopwords(spark, extra))
    assert rows_of(found, "site", "pos", "term") == [("a", 1, "red"), ("a", 3, "vie"), ("b", 2, "rouge"), ("c", 0, "the")]


def test_language_lists(spark):
    assert len(LANGUAGE_NAMES) == 34 and len(set(LANGUAGE_NAMES.values())) == 32
    assert set(SPARK_LISTS) <= set(LANGUAGE_NAMES.values())
    langs = {r["lang"] for r in stopwords(spark).select("lang").distinct().collect()}
    assert langs == {c for c, name in LANGUAGE_NAMES.items() if name in SPARK_LISTS}


def test_names_both_ways(spark):
    fields = literal_table(spark, FIELDS, [(7, "body", True), (8, "hidden", False), (8, "hidden", False)])
    handles = literal_table(spark, "h string", [("body",), ("hidden",), ("title",), (None,)])
    mapped = map_attribute(handles, fields, "h", "field", "p_")
    assert {r["h"]: r["field"] for r in mapped.collect()} == {
        "body": "p_field_7", "hidden": "p_field_8", "title": "p_attribute_title", None: None,
    }
    names = ["p_field_7", "p_field_99", "p_attribute_x_y", "field_7", "p_field_zz", "p_field_8b"]
    back = map_field(literal_table(spark, "f string", [(n,) for n in names]), fields, "f", "h", "p_")
    assert {r["f"]: r["h"] for r in back.collect()} == {
        "p_field_7": "body", "p_field_99": "field not found for ID 99", "p_attribute_x_y": "x_y",
        "field_7": "Unknown field field_7", "p_field_zz": "field not found for ID 0", "p_field_8b": "hidden",
    }


def test_all_digits_of_a_field_id_count(spark):
    fields = literal_table(spark, FIELDS, [(123456789, "nine", True)])
    back = map_field(literal_table(spark, "f string", [("field_1234567890",), ("field_123456789",)]), fields, "f", "h")
    assert {r["f"]: r["h"] for r in back.collect()} == {
        "field_1234567890": "field not found for ID 1234567890", "field_123456789": "nine"}


def test_explained_source(spark):
    fields = literal_table(spark, FIELDS, [(7, "body", True)])
    found = rows_of(explain_source(keywords(spark, ROWS[:3]), fields), "id", "handle", "source", "tokens")
    assert found == [
        (1, "t", ROWS[0][3], "the red red red übung s 3rd"), (2, "t", "?!", ""), (3, "body", "", ""),
    ]


def test_version_names(spark):
    rows = literal_table(spark, "site string, version bigint", [("EN", 12)])
    row = rows.select(version_name("Ix", "site", "version").alias("n")).first()
    assert row["n"] == "ix_en_12"
    shown = literal_table(spark, "n string", [("ix_a_1",), (".x",), ("other",)])
    assert rows_of(shown.where(listed(F.col("n"), "IX"))) == [("ix_a_1",)]
    assert rows_of(shown.where(listed(F.col("n"), "IX", True))) == [("ix_a_1",), ("other",)]
