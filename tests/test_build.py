"""What building and copying an index moves and sorts."""

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from helpers import keywords, rows_of, stored
from lexigrid import IndexStore
from lexigrid.functions.analysis import analyze
from lexigrid.model import Analyzer
from lexigrid.operators.postings import posting_blocks, postings, unpacked
from lexigrid.plans import layers
from lexigrid.plans.jobs import bulk_delete
from lexigrid.session import fresh_dir, literal_table
from registry.queries import QUERIES

TEXTS = [
    "the red of the", "of", "", " ?! ", "-theİstanbul the-", "Ærøª 5²x \x00 a", "的一 the ー", "éa the", "x\U00020000 the", "theǅɏ,the",
]
ROWS = [("a", n, "attribute_t", text) for n, text in enumerate(TEXTS)] + [("b", 0, "attribute_t", "the of"), ("a", 0, "attribute_s", "the")]


def test_blocks_hold_what_the_standard_way_finds(spark):
    rows = keywords(spark, ROWS).withColumn("version", F.lit(1).cast("bigint"))
    for analyzer in (Analyzer(), Analyzer(lowercase=False), Analyzer(pairs=True), Analyzer(pattern="[a-z]+"), Analyzer(stopwords=("of",))):
        found = {(r["site"], r["id"], r["field"], r["term"]): r["positions"] for r in unpacked(posting_blocks(rows, analyzer)).collect()}
        wanted = {}
        for r in sorted(analyze(rows, analyzer).collect(), key=lambda r: r["pos"]):
            wanted.setdefault((r["site"], r["id"], r["field"], r["term"]), []).append(r["pos"])
        assert found == wanted


def test_a_term_of_many_documents_is_moved_as_one_row(spark):
    rows = keywords(spark, [("a", n, "attribute_t", "common word") for n in range(50)]).withColumn("version", F.lit(1).cast("bigint")).coalesce(1)
    assert posting_blocks(rows).count() == 2 and postings(rows).count() == 100


def test_nothing_is_sorted_by_folder_and_copied_postings_not_at_all(spark, monkeypatch):
    kind, sorts = type(spark.range(0)), []
    real = kind.sortWithinPartitions
    monkeypatch.setattr(kind, "sortWithinPartitions", lambda self, *by, **how: sorts.append(by) or real(self, *by, **how))
    store = stored(spark, ROWS)
    built = len(sorts)
    assert built and not any({"site", "bucket", "kind"} & set(by) for by in sorts)
    bulk_delete(store, literal_table(spark, "site string, id bigint", [("a", 1)]), 2)
    # keywords and the vocabulary, but not the postings
    assert sorts[built:] == [("id", "field"), ("term", "field"), ("key",), ("field",)]
    assert ("a", 1) not in rows_of(store.live("postings"), "site", "id")
    for path in store.version("dictionary", 2).inputFiles():
        keys = [r["key"] for r in spark.read.parquet(path).collect()]
        assert keys == sorted(keys, key=str.encode)


EAST = [
    "是", "一な的", "d的一c", "的か、人人 (かー)", "", "「の」", "한국어 text 2", "的\U00020000的", "的 的", "“ABC”的—一", "ー", "é的Æ", "々的", "的\u3099か",
]


def _given(monkeypatch, spark, rows, analyzer):
    """The rows that the function on Arrow batches gets."""
    kind, seen = type(spark.range(0)), []
    real = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, *how: seen.append(self) or real(self, *how))
    posting_blocks(rows, analyzer)
    return seen[0].collect()


def test_pairs_of_common_ideographs_are_cut_in_batches(spark, monkeypatch):
    rows = keywords(spark, [(site, n, "attribute_t", text) for site in "ab" for n, text in enumerate(EAST)])
    rows = rows.withColumn("version", F.lit(1).cast("bigint"))
    for analyzer in (Analyzer(pairs=True), Analyzer(), {"a": Analyzer(pairs=True, stopwords=("的一",))}, Analyzer(pairs=True, lowercase=False)):
        found = {(r["site"], r["id"], r["term"]): r["positions"] for r in unpacked(posting_blocks(rows, analyzer)).collect()}
        wanted = {}
        for site in "ab":
            own = analyzer if isinstance(analyzer, Analyzer) else analyzer.get(site, Analyzer())
            for r in sorted(analyze(rows.where(F.col("site") == site), own).collect(), key=lambda r: r["pos"]):
                wanted.setdefault((r["site"], r["id"], r["term"]), []).append(r["pos"])
        assert found == wanted
    given = _given(monkeypatch, spark, rows, Analyzer(pairs=True))
    assert {r["id"] for r in given if r["text"] is None} == {7, 12, 13}


def test_no_list_is_null_where_batches_are_written(spark, monkeypatch):
    rows = keywords(spark, [("a", n, "attribute_t", text) for n, text in enumerate([*TEXTS, None])]).withColumn("version", F.lit(1).cast("bigint"))
    given = _given(monkeypatch, spark, rows, Analyzer())
    assert given and all(r["tokens"] is not None for r in given)
    # else Spark's writer takes a time that grows with the square of a batch's rows


def _shuffled(monkeypatch, spark):
    """The columns of each table that is shuffled to be written."""
    kind, seen = type(spark.range(0)), []
    real = kind.hint
    monkeypatch.setattr(kind, "hint", lambda self, name, *by: seen.append((name, set(self.columns))) or real(self, name, *by))
    return lambda column: [columns for name, columns in seen if name == "rebalance" and column in columns]


def test_postings_are_stored_where_they_are_made(spark, monkeypatch):
    shuffled = _shuffled(monkeypatch, spark)
    few, splits = stored(spark, ROWS, n_buckets=3), spark.conf.get("spark.sql.files.maxPartitionBytes")
    assert not shuffled("ids")
    many = stored(spark, ROWS, n_buckets=40)  # more folders than a task keeps open
    assert len(shuffled("ids")) == 1
    columns = ("site", "field", "term", "id", "tf", "dl", "head", "positions")
    assert rows_of(few.live("postings"), *columns) == rows_of(many.live("postings"), *columns) != []
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == splits
    for path in few.table("postings").inputFiles():
        terms = [r["term"] for r in spark.read.parquet(path).collect()]
        assert terms == sorted(terms, key=str.encode)


def test_layers_are_merged_without_a_shuffle_of_postings(spark, monkeypatch):
    store = stored(spark, ROWS)
    layers.remove(store, literal_table(spark, "site string, id bigint", [("a", 1)]), 2)
    kept = rows_of(store.live("postings"), "site", "bucket", "field", "term", "id", "positions")
    shuffled = _shuffled(monkeypatch, spark)
    layers.merge_layers(store, 3)
    assert not shuffled("positions")
    assert rows_of(store.live("postings"), "site", "bucket", "field", "term", "id", "positions") == kept != []
    assert ("a", 3) in rows_of(store.published(), "site", "version")
    # of another number of buckets they are
    layers.remove(store, literal_table(spark, "site string, id bigint", [("a", 2)]), 4)
    other = IndexStore(spark, store.root, n_buckets=5)
    layers.merge_layers(other, 5)
    assert shuffled("positions") and {r["bucket"] for r in other.version("postings", 5).collect()} <= set(range(5))


def test_short_texts_of_one_task_are_stored_in_files_of_bounded_length(spark):
    store = IndexStore(spark, fresh_dir(spark, "short"), n_buckets=3)
    rows = spark.range(500_001).coalesce(1).select(F.lit("a").alias("site"), "id", F.lit("attribute_t").alias("field"), F.lit("x").alias("text"))
    store.write_keywords(rows, 1)
    assert len(store.version("keywords", 1).inputFiles()) == 2


def test_copying_documents_makes_no_postings(spark, monkeypatch):
    folder = fresh_dir(spark, "given")
    texts = literal_table(spark, "doc_id bigint, text string, lang string", [(1, "red", "en"), (1, "red", "en"), (2, None, "en"), (3, "rot", "de")])
    texts.write.parquet(f"{folder}/documents.parquet")
    parts = "p_partkey bigint, p_name string, p_type string, p_brand string, p_size int"
    literal_table(spark, parts, [(1, "red bolt", "SMALL", "b", 1)]).write.parquet(f"{folder}/part.parquet")
    literal_table(spark, "n_nationkey bigint, n_name string, n_regionkey int", [(1, "N", 1)]).write.parquet(f"{folder}/nation.parquet")
    made = []
    monkeypatch.setattr(IndexStore, "write_postings", lambda self, *rows, **how: made.append(rows))
    for name in ("clone_site", "indexed_ids", "source", "reindex_projection", "mapping_diff"):
        assert QUERIES[name](spark, folder).columns
    copied = [("copy", 7, 1, "attribute_text", "red")] * 2 + [("copy", 7, 2, "attribute_text", "")]
    assert rows_of(QUERIES["clone_site"](spark, folder), "site", "version", "id", "field", "text") == copied
    assert not made


def test_keys_of_the_dictionary_are_not_gathered(spark):
    for path in stored(spark, ROWS).table("dictionary").inputFiles():
        group = pq.ParquetFile(path.removeprefix("file:")).metadata.row_group(0)
        ways = {group.column(n).path_in_schema: set(group.column(n).encodings) for n in range(group.num_columns)}
        assert not any("DICTIONARY" in way for name in ("key", "term") for way in ways[name])
