"""Sites' own analyzers, kept with the versions they made."""

import pytest
from pyspark.sql import functions as F

from helpers import hits_of, keywords, query_terms, rows_of, term
from lexigrid import IndexStore, search
from lexigrid.functions.analysis import analyze, tokens
from lexigrid.model import CHANGES, Analyzer
from lexigrid.plans import jobs, layers
from lexigrid.session import fresh_dir, literal_table

STOPS = Analyzer(stopwords=("the", "of", "a"))
ROWS = [
    ("a", 1, "f", "the state of the art"), ("a", 2, "f", "state some more art"), ("a", 3, "f", "state art"),
    ("a", 4, "f", "the of"), ("a", 5, "f", ""), ("b", 1, "f", "the state of the art"),
]


def store_of(spark, rows=ROWS, analyzers=None):
    store = IndexStore(spark, fresh_dir(spark, "analyzers"), n_buckets=2)
    store.write_version(keywords(spark, rows), 1, analyzers or {"a": STOPS})
    return store


def ids(spark, store, *terms):
    found = hits_of(search(store.index(), query_terms(spark, *terms)))
    return {query: sorted(i for i, _ in hits) for query, hits in found.items()}


def changes(spark, day, *documents):
    rows = [(site, i, "upsert", 1, False, "f", text) for site, i, text in documents]
    made = literal_table(spark, "site string, id bigint, op string, seq bigint, is_draft boolean, field string, text string", rows)
    return made.withColumn("ts", F.lit(day).cast("timestamp")).select(*[c.split()[0] for c in CHANGES.split(", ")])


def test_stop_words_leave_gaps(spark):
    store = store_of(spark)
    got = rows_of(store.version("postings", 1).where("site = 'a'"), "id", "term", "tf", "dl", "head", "positions")
    assert got == [
        (1, "art", 1, 2, False, [4]), (1, "state", 1, 2, True, [1]), (2, "art", 1, 4, False, [3]), (2, "more", 1, 4, False, [2]),
        (2, "some", 1, 4, False, [1]), (2, "state", 1, 4, True, [0]), (3, "art", 1, 2, False, [1]), (3, "state", 1, 2, True, [0]),
    ]
    assert rows_of(store.version("field_stats", 1), "site", "n_docs", "sum_dl") == [("a", 3, 8), ("b", 1, 5)]
    assert ids(
        spark, store, term(1, 0, "state of the art", phrase=True), term(2, 0, "the art", phrase=True), term(3, 0, "the"),
        term(4, 0, "the"), term(4, 1, "more"), term(5, 0, "of", exclude=True), term(5, 1, "state"), term(6, 0, "the", "b"),
        term(7, 0, "th", sub_right=True), term(8, 0, "state art", phrase=True), term(9, 0, "of the", phrase=True),
    ) == {
        1: [1, 2],  # a gap is so many words, whichever
        2: [1, 2, 3], 4: [2], 5: [1, 2, 3], 6: [1], 8: [3],  # what has only stop words asks for nothing
    }


def test_another_analyzer_can_be_asked(spark):
    found = search(store_of(spark).index(), query_terms(spark, term(1, 0, "the"), term(1, 1, "state")), analyzer=Analyzer())
    assert hits_of(found) == {}  # "the" is required then, and no posting has it


def test_jobs_keep_the_analyzer(spark):
    store = store_of(spark)
    asked = (term(1, 0, "art"), term(2, 0, "the"), term(3, 0, "the", "c"), term(4, 0, "the", "b"), term(5, 0, "the new", phrase=True))
    want = {1: [1, 2, 3, 9], 3: [1], 4: [1], 5: [9]}
    new = [("a", 9, "the new art"), ("c", 1, "the third")]
    layers.apply_changes(store, changes(spark, "2024-01-01", *new), 2)
    assert ids(spark, store, *asked) == want
    layers.merge_layers(store, 3)
    assert ids(spark, store, *asked) == want and store.analyzers() == {"a": STOPS}
    jobs.compact(store, changes(spark, "2025-01-01", *new), 4)
    assert ids(spark, store, *asked) == want
    jobs.clone_site(store, "a", "d", 5)
    jobs.delete(store, 3, "a", 6)
    jobs.reindex_site(store, "a", literal_table(spark, "field string", [("f",)]), 7)
    assert store.analyzers() == {"a": STOPS, "d": STOPS}
    assert ids(spark, store, term(1, 0, "the"), term(2, 0, "the art", "d", phrase=True)) == {2: [1, 2, 3, 9]}
    jobs.update_mapping(store, literal_table(spark, "field string", [("g",)]), 8)
    assert store.analyzers() == {"a": STOPS, "d": STOPS}


def test_a_version_written_again_forgets_the_analyzer(spark):
    store = IndexStore(spark, fresh_dir(spark, "analyzers"), n_buckets=2)
    store.write_version(keywords(spark, ROWS), 1, STOPS, publish=False)
    store.write_version(keywords(spark, ROWS), 1)
    assert ids(spark, store, term(1, 0, "the")) == {1: [1, 4]} and store.analyzers() == Analyzer()


def test_each_site_has_its_own_way(spark):
    store = store_of(spark, ROWS, {"a": Analyzer(lowercase=False), "b": Analyzer(pattern="[^ ]+", stopwords=("state",))})
    assert ids(
        spark, store, term(1, 0, "State"), term(2, 0, "state"), term(3, 0, "THE", "b"), term(4, 0, "STATE", "b"), term(5, 0, "STA", sub_right=True),
        term(6, 0, "AR", "b", sub_right=True),
    ) == {2: [1, 2, 3], 3: [1], 6: [1]}


@pytest.mark.parametrize("text, terms", [
    ("東京都に abc", ["東京", "京都", "都に", "abc"]), ("日", ["日"]), ("x日本y", ["x", "日本", "y"]), ("ラーメン", ["ラー", "ーメ", "メン"]),
    ("한국어 문장", ["한국", "국어", "문장"]), ("𠀀𠀁𠀂", ["𠀀𠀁", "𠀁𠀂"]), ("", []), ("Naïve 12", ["naïve", "12"]), (None, None),
])
def test_unspaced_scripts_become_pairs(spark, text, terms):
    got = literal_table(spark, "text string", [(text,)]).select(tokens("text", Analyzer(pairs=True)).alias("t")).first()["t"]
    assert got == terms


def test_pairs_in_search(spark):
    rows = [("a", 1, "f", "東京都は大きい"), ("a", 2, "f", "京都と東京"), ("a", 3, "f", "都")]
    store = store_of(spark, rows, Analyzer(pairs=True, stopwords=("都は",)))
    assert ids(spark, store, term(1, 0, "東京都", phrase=True), term(2, 0, "京都"), term(3, 0, "都"), term(4, 0, "京都は大", phrase=True)) == {
        1: [1], 2: [1, 2], 3: [3], 4: [1],
    }
    rows = analyze(keywords(spark, rows), Analyzer(pairs=True, stopwords=("都は",))).where("id = 1")
    assert rows_of(rows, "pos", "term") == [(0, "東京"), (1, "京都"), (3, "は大"), (4, "大き"), (5, "きい")]
