"""Layers of an index against an index built anew from the same documents."""

import os

import pytest
from helpers import hits_of, keywords, query_terms, rows_of, stored, term
from pyspark.sql import functions as F

from lexigrid import IndexStore, search
from lexigrid.model import CHANGES
from lexigrid.operators import upkeep
from lexigrid.plans import jobs, layers
from lexigrid.session import fresh_dir, literal_table

BASE = [("a", i, f, t) for i in range(1, 30) for f, t in (("attribute_title", f"red fox {i}"), ("attribute_text", f"the fox of the hill number {i % 4}"))]
BASE += [("b", i, "attribute_text", f"other site word{i} the fox") for i in range(1, 6)]
QUERIES = [
    term(1, 0, "fox"), term(2, 0, "the fox", phrase=True), term(3, 0, "num", sub_right=True), term(3, 1, "red"),
    term(4, 0, "red", exclude=True), term(5, 0, "new"), term(6, 0, "fox", "b"), term(7, 0, "ew", sub_left=True, sub_right=True),
    term(8, 0, "blue"), term(8, 1, "new fox", phrase=True), term(9, 0, "gone", exclude=True), term(10, 0, "the", "c"),
]


def log(spark, *rows):
    """Changes of whole documents: ``site, id, op, seq, text``."""
    made = [(s, i, op, None, n, False, "attribute_text", t) for s, i, op, n, t in rows]
    return literal_table(spark, CHANGES, made).withColumn("ts", F.lit("2024-01-01").cast("timestamp"))


def answers(store):
    return hits_of(search(store.index(), query_terms(store.spark, *QUERIES)))


def rebuilt(store):
    """A new index of what the store serves."""
    fresh = IndexStore(store.spark, fresh_dir(store.spark, "anew"), n_buckets=3)
    fresh.write_version(store.live("keywords").select("site", "id", "field", "text"), 1)
    return fresh


def stats_of(store):
    served, spark = store.index(), store.spark
    terms = upkeep.current(served.term_stats, served.published).groupBy("site", "field", "term").agg(F.sum("df").alias("df")).where("df <> 0")
    fields = upkeep.current(served.field_stats, served.published).groupBy("site", "field").agg(F.sum("n_docs"), F.sum("sum_dl")).where("`sum(n_docs)` <> 0")
    return rows_of(terms), rows_of(fields)


def files_below(root):
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_layers_answer_like_a_new_index(spark):
    store = stored(spark, BASE)
    first = log(spark, ("a", 3, "upsert", 1, "a new fox"), ("a", 90, "upsert", 1, "new blue hill"), ("a", 5, "delete", 1, None),
                ("c", 1, "upsert", 1, "the first of its site"), ("a", 404, "delete", 1, None))
    layers.apply_changes(store, first, 2)
    layers.apply_changes(store, log(spark, ("a", 3, "upsert", 2, "new again, the new fox"), ("b", 2, "upsert", 2, "red")), 3)
    layers.remove(store, literal_table(spark, "site string, id bigint", [("a", 7), ("b", 999)]), 4)
    live = set(rows_of(store.live("keywords"), "site", "id", "text"))
    assert ("a", 3, "new again, the new fox") in live and ("b", 2, "red") in live and ("c", 1, "the first of its site") in live
    assert not {("a", 5), ("a", 7)} & {(s, i) for s, i, _ in live}
    found, stats, fresh = answers(store), stats_of(store), rebuilt(store)
    assert found == answers(fresh) and found.keys() >= {1, 2, 3, 4, 5, 6, 7, 8, 10}
    assert stats == stats_of(fresh)

    # a log is applied once, and versions rise
    layers.apply_changes(store, log(spark, ("a", 3, "upsert", 1, "a new fox")), 11)
    assert 11 not in {v for _, v in rows_of(store.published(), "site", "version")}
    with pytest.raises(ValueError, match="not above"):
        layers.apply_changes(store, log(spark, ("a", 3, "upsert", 9, "late")), 4)

    # merged they are one version
    assert rows_of(layers.merge_layers(store, 9)) == [("a",), ("b",)]
    assert rows_of(store.published(), "site", "version") == [("a", 9), ("b", 9), ("c", 2)]
    assert answers(store) == found and stats_of(store) == stats
    assert layers.merge_layers(store, 10).isEmpty()
    assert {v for _, v in store.purge_versions()} == {1, 2, 3, 4}

    # the jobs that rewrite sites see base and layers as one
    layers.remove_orphans(store, literal_table(spark, "id bigint", [(1,), (2,), (3,)]), 12)
    assert {i for _, i in rows_of(store.live("keywords"), "site", "id")} == {1, 2, 3}
    jobs.bulk_delete(store, literal_table(spark, "site string, id bigint", [("a", 1)]), 13)
    assert [v for s, v in rows_of(store.published(), "site", "version") if s == "a"] == [13]
    jobs.clone_site(store, "b", "copy", 14)
    copied = [(i, t) for s, i, t in rows_of(store.live("keywords"), "site", "id", "text") if s == "copy"]
    assert (2, "red") in copied and len(copied) == 3
    assert answers(store) == answers(rebuilt(store))


def test_what_a_change_writes_is_in_proportion_to_it(spark):
    rows = [("a", i, "attribute_text", " ".join(f"w{(i * 7 + k) % 900}" for k in range(80))) for i in range(600)]
    store = stored(spark, rows)
    base = files_below(store.root)
    layers.apply_changes(store, log(spark, ("a", 5, "upsert", 1, "one two three")), 2)
    new = {f: size for f, size in files_below(store.root).items() if f not in base}
    assert sum(new.values()) < 0.2 * sum(base.values())
    assert store.version("postings", 2).count() == 3 and store.version("keywords", 2).count() == 1
    assert store.version("term_stats", 2).count() == 3 + 80  # its own words, and those that are one less now


def test_a_replayed_batch_changes_nothing(spark, monkeypatch):
    store = stored(spark, BASE)
    batch = log(spark, ("a", 3, "upsert", 1, "a new fox"), ("a", 5, "delete", 1, None))
    # the first try fails once the layer is served, the second before that
    monkeypatch.setattr(IndexStore, "record_applied", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        layers.apply_batch(store, batch, "s-0")
    monkeypatch.undo()
    served, found = rows_of(store.published()), answers(store)
    for _ in range(2):
        layers.apply_batch(store, batch, "s-0")
        assert rows_of(store.published()) == served and answers(store) == found
    monkeypatch.setattr(IndexStore, "publish_layer", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        layers.apply_batch(store, log(spark, ("a", 6, "delete", 2, None)), "s-1")
    monkeypatch.undo()
    assert answers(store) == found
    layers.apply_batch(store, log(spark, ("a", 6, "delete", 2, None)), "s-1")
    assert answers(store) == answers(rebuilt(store)) != found
    assert len(rows_of(store.published())) == len(served) + 1


def test_a_site_may_begin_with_a_layer_and_be_emptied(spark):
    store = IndexStore(spark, fresh_dir(spark, "none"), n_buckets=3)
    layers.apply_changes(store, log(spark, ("c", 1, "upsert", 1, "the only one")), 1)
    assert answers(store)[10]
    layers.apply_changes(store, log(spark, ("c", 1, "delete", 2, None)), 2)
    assert answers(store) == {} and rows_of(store.live("postings"), "id") == []
    assert keywords(spark, BASE).count() and store.drop_site("c") == [("c", 1), ("c", 2)]


def test_candidates_first_gives_the_same_hits_and_meets_few_postings(spark, monkeypatch):
    from lexigrid.plans import search as plan

    rows = [("a", i, "attribute_text", "the common words " + ("rare " if i in (7, 70) else "") + f"word{i}") for i in range(300)]
    store = stored(spark, rows)
    layers.apply_changes(store, log(spark, ("a", 70, "upsert", 1, "the rare again")), 2)
    asked = [term(1, 0, "the"), term(1, 1, "rare"), term(1, 2, "common", exclude=True), term(2, 0, "rare"), term(2, 1, "the"), term(2, 2, "wor", sub_right=True),
             term(3, 0, "the"), term(3, 1, "nowhere"), term(4, 0, "the common", phrase=True), term(4, 1, "word7", exclude=True), term(5, 0, "rare")]
    kept, written = {}, plan.written

    def keep(df, name):
        kept[name] = written(df, name)
        return kept[name]

    monkeypatch.setattr(plan, "written", keep)
    found = hits_of(search(store.index(), query_terms(spark, *asked), candidates_from=0))
    assert found == hits_of(search(store.index(), query_terms(spark, *asked))) and [i for i, _ in found[1]] == [70] and [i for i, _ in found[2]] == [7]
    # three candidates of each query, as the replaced version of one does not count, times the versions and clauses
    assert kept["rarest"].count() <= 6 and kept["needed"].count() <= 2 * 2 * kept["required"].count()


def test_what_a_layer_replaces_is_found_by_its_documents_first(spark, monkeypatch):
    from lexigrid.sources import store as module

    store = stored(spark, BASE)
    layers.remove(store, literal_table(spark, "site string, id bigint", [("a", 1), ("b", 2)]), 2)
    seen, real = [], upkeep.without_replaced

    def keep(rows, tombstones):
        if "term" in rows.columns:
            seen.append(rows)
        return real(rows, tombstones)

    monkeypatch.setattr(upkeep, "without_replaced", keep)
    monkeypatch.setattr(module, "without_replaced", keep)
    layers.remove(store, literal_table(spark, "site string, id bigint", [("a", 1), ("a", 3)]), 3)
    assert [rows_of(rows.select("site", "id").distinct()) for rows in seen] == [[("a", 3)]]
    fields = upkeep.current(store.table("field_stats"), store.published()).groupBy("site", "field").agg(F.sum("n_docs").alias("n"))
    assert rows_of(fields) == [("a", "attribute_text", 27), ("a", "attribute_title", 27), ("b", "attribute_text", 4)]


def test_replaced_documents_are_found_by_blocks_of_their_ids(spark):
    ids = [-130, -65, -64, -1, 0, 1, 63, 64, 127, 2**40, 2**63 - 1, -(2**63), None]
    rows = literal_table(spark, "site string, version bigint, id bigint", [(s, v, i) for s in ("a", "b", None) for v in (1, 2, 3) for i in ids])
    named = [("a", 2, -64), ("a", 2, 63), ("a", 2, 63), ("a", 3, 64), ("a", 3, 2**63 - 1), ("b", 3, -(2**63)), ("b", 3, 0), ("b", 2, 0), ("a", 2, None), (None, 3, 1)]
    blocks = upkeep.id_blocks(literal_table(spark, "site string, version bigint, id bigint", named))
    known = {t for t in named if None not in t}
    kept = [tuple(r) for r in rows.collect() if not any((r.site, r.id) == (s, i) and r.version < v for s, v, i in known)]
    assert sorted(map(str, kept)) == sorted(str(tuple(r)) for r in upkeep.without_replaced(rows, blocks).collect())
    found = upkeep.of_documents(rows, upkeep.id_blocks(literal_table(spark, "site string, id bigint", [("a", 64), ("b", -1), (None, 0), ("b", None)])))
    assert {(r.site, r.id) for r in found.collect()} == {("a", 64), ("b", -1)} and found.count() == 6


def test_many_replaced_documents_are_not_broadcast_one_by_one(spark, monkeypatch):
    from lexigrid.plans import search as plan
    from lexigrid.session import bounded
    from lexigrid.sources import store as module

    store = stored(spark, [("a", i, "attribute_text", f"the fox number {i % 4}") for i in range(3000)])
    layers.remove(store, spark.range(10, 2990).select(F.lit("a").alias("site"), "id"), 2)
    tombstones = store.tombstones()
    assert store.table("tombstones").count() == 2980 and tombstones.count() == 47
    asked = [term(1, 0, "fox"), term(2, 0, "the fox", phrase=True), term(3, 0, "number", exclude=True), term(4, 0, "the"), term(4, 1, "3")]
    found = hits_of(search(store.index(), query_terms(spark, *asked)))
    assert {q: len(hits) for q, hits in found.items()} == {1: 20, 2: 20, 4: 5}

    # what has more rows than may be broadcast is joined by shuffle, however small its files are
    joined = []

    def none(table, most=0):
        joined.append(table)
        return bounded(table, 0)

    monkeypatch.setattr(plan, "bounded", none)
    monkeypatch.setattr(module, "_BROADCAST_BLOCKS", 0)
    served = store.index()
    shuffled = upkeep.without_replaced(served.postings.select("site", "version", "id"), served.tombstones)
    assert shuffled.count() == 20 * 4 and "BroadcastHashJoin" not in shuffled._jdf.queryExecution().executedPlan().toString()
    assert hits_of(search(served, query_terms(spark, *asked))) == found and len(joined) == 1
    assert hits_of(search(served, query_terms(spark, *asked), candidates_from=0)) == found and len(joined) == 4
