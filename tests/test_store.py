import pytest
from helpers import hits_of, keywords, query_terms, rows_of, stored, term

from lexigrid import IndexStore, search
from lexigrid.operators import upkeep
from lexigrid.operators import reports
from lexigrid.plans import jobs
from lexigrid.plans.jobs import bulk_delete, clone_site, compact, delete, fan_out, purge_orphans, reindex_site
from lexigrid.session import fresh_dir, literal_table
from lexigrid.sources import store as store_module

ROWS = [
    ("a", 1, "attribute_title", "red widget"), ("a", 1, "field_1", "old text"),
    ("a", 2, "attribute_title", "blue widget"), ("a", 3, "attribute_title", ""),
    ("b", 1, "attribute_title", "red bolt"),
]
CHANGE = "site string, id bigint, op string, ts timestamp, seq bigint, is_draft boolean, field string, text string"


def served(store):
    index = store.index()
    return rows_of(upkeep.current(index.keywords, index.published), "site", "id", "field", "text")


def ask(store, text, site="a"):
    return [i for i, _ in hits_of(search(store.index(), query_terms(store.spark, term(1, 0, text, site)))).get(1, [])]


def log_of(spark, *rows):
    from datetime import datetime, timedelta, timezone

    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    return literal_table(
        spark, CHANGE,
        [(s, i, op, start + timedelta(minutes=t), n, False, f, x) for n, (s, i, op, t, f, x) in enumerate(rows)],
    )


def statistics_agree(store, version):
    """Stored statistics equal those of an index built anew from the stored documents."""
    rows = store.version("keywords", version).select("site", "id", "field", "text")
    anew = IndexStore(store.spark, fresh_dir(store.spark, "anew"), store.n_buckets)
    anew.write_version(rows, version)
    for name in ("postings", "term_stats", "field_stats"):
        columns = sorted(set(store.table(name).columns) - {"positions"})
        assert rows_of(store.version(name, version), *columns) == rows_of(anew.table(name), *columns)


def test_empty_store_has_nothing(spark):
    store = IndexStore(spark, fresh_dir(spark, "none"))
    assert store.index().postings.count() == 0 and store.published().count() == 0


def test_write_publish_and_withdraw(spark):
    store = stored(spark, ROWS)
    assert served(store) == sorted(ROWS)
    assert ask(store, "widget") == [1, 2]
    store.withdraw(literal_table(spark, "site string", [("a",)]))
    assert ask(store, "widget") == [] and ask(store, "bolt", "b") == [1]


def test_unpublished_and_rewritten_versions(spark):
    store = stored(spark, ROWS)
    other = keywords(spark, [("a", 9, "attribute_title", "green widget")])
    store.write_version(other, 2, publish=False)
    assert ask(store, "widget") == [1, 2]
    store.write_version(other, 2, publish=False)  # a retried job replaces its own folders
    store.publish_version(2)
    assert ask(store, "widget") == [9] and ask(store, "red", "b") == [1]
    with pytest.raises(ValueError):
        store.write_version(other, 2)


def test_reindex_keeps_only_mapped_fields(spark):
    store = stored(spark, ROWS)
    mapping = literal_table(spark, "field string", [("attribute_title",), ("field_8",)])
    assert reindex_site(store, "a", mapping, 2) == {"old": 1, "new": 2, "total": 3}
    assert served(store) == sorted(r for r in ROWS if r[2] == "attribute_title")
    assert ask(store, "old") == [] and ask(store, "red") == [1] and ask(store, "bolt", "b") == [1]
    statistics_agree(store, 2)
    with pytest.raises(ValueError):
        reindex_site(store, "nosite", mapping, 3)


def test_full_mapping_changes_nothing(spark):
    store = stored(spark, ROWS)
    before = served(store)
    reindex_site(store, "a", store.table("keywords").select("field"), 2)
    assert served(store) == before


def test_failed_rebuild_is_not_published(spark, monkeypatch):
    store = stored(spark, ROWS)

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(store_module, "field_stats", fail)
    with pytest.raises(RuntimeError):
        reindex_site(store, "a", store.table("keywords").select("field"), 2)
    assert rows_of(store.published(), "site", "version") == [("a", 1), ("b", 1)]


def test_clone_answers_like_its_source(spark):
    store = stored(spark, ROWS)
    clone_site(store, "a", "c", 2)
    terms = query_terms(spark, term(1, 0, "widget", "a"), term(2, 0, "widget", "c"))
    found = hits_of(search(store.index(), terms))
    assert found[1] == found[2]
    clone_site(store, "b", "c", 3)  # an existing target is replaced
    assert ask(store, "widget", "c") == [] and ask(store, "bolt", "c") == [1]
    statistics_agree(store, 2)


def test_compact_applies_a_log_and_leaves_other_sites(spark):
    store = stored(spark, ROWS)
    log = log_of(
        spark,
        ("a", 1, "upsert", 5, "attribute_title", "green ring ring"), ("a", 2, "upsert", 1, "field_1", "late"),
        ("a", 2, "delete", 2, None, None), ("c", 4, "upsert", 1, "attribute_title", "new site"),
    )
    compact(store, log, 2)
    assert served(store) == sorted([
        ("a", 1, "attribute_title", "green ring ring"), ("a", 3, "attribute_title", ""), ROWS[4],
        ("c", 4, "attribute_title", "new site"),
    ])
    assert ask(store, "ring") == [1] and ask(store, "widget") == [] and ask(store, "site", "c") == [4]
    assert rows_of(store.published(), "site", "version") == [("a", 2), ("b", 1), ("c", 2)]
    statistics_agree(store, 2)
    compact(store, log_of(spark, ("c", 4, "delete", 2, None, None)), 3, merge_files=True)
    assert ask(store, "site", "c") == []


def test_other_bucket_count_is_rewritten(spark):
    store = stored(spark, ROWS, n_buckets=2)
    wider = IndexStore(spark, store.root, n_buckets=5)
    clone_site(wider, "a", "c", 2)
    assert ask(wider, "widget", "c") == [1, 2] and ask(wider, "widget", "a") == [1, 2]


def test_fan_out_reaches_enabled_sinks_only(spark):
    seen = {}
    sinks = {n: (lambda df, n=n: seen.update({n: df.count()})) for n in ("x", "y", "z")}
    assert fan_out(keywords(spark, ROWS), sinks, {"x": True, "z": True, "y": False}) == ["x", "z"]
    assert seen == {"x": 5, "z": 5}
    assert fan_out(keywords(spark, ROWS), sinks, {}) == []


def test_purge_and_drop_delete_what_is_not_served(spark):
    rows = [("a b/c", 1, "f", "red"), ("b", 1, "f", "red"), ("d", 1, "f", "red")]
    store = stored(spark, rows)
    store.write_version(keywords(spark, rows[:2]), 2)
    assert store.purge_versions("b") == [("b", 1)]
    assert store.purge_versions() == [("a b/c", 1)]
    assert store.purge_versions() == []
    assert rows_of(upkeep.versions(store.table("postings"))) == [("a b/c", 2), ("b", 2), ("d", 1)]
    assert ask(store, "red", "a b/c") == [1] and ask(store, "red", "d") == [1]
    assert store.drop_site("b") == [("b", 2)] and store.drop_site("nosite") == []
    assert rows_of(store.published(), "site") == [("a b/c",), ("d",)]


def test_buckets_are_those_the_version_was_written_with(spark):
    rows = [("a", n, "attribute_t", f"word{n} common") for n in range(20)]
    store = IndexStore(spark, fresh_dir(spark, "reopened"), n_buckets=7)
    store.write_version(keywords(spark, rows), 1, publish=False)
    again = IndexStore(spark, store.root)
    again.publish_version(1)
    assert search(again.index(), query_terms(spark, term(1, 0, "common"))).count() == 20


def test_a_reload_is_not_undone_by_changes_from_before_it(spark):
    store = stored(spark, ROWS)
    log = log_of(spark, ("a", 1, "upsert", 1, "attribute_title", "changed once"), ("b", 1, "delete", 1, None, None))
    compact(store, log, 2)
    assert ask(store, "once") == [1] and ask(store, "bolt", "b") == []
    store.write_version(keywords(spark, ROWS), 3)
    compact(store, log, 4)
    assert served(store) == sorted(ROWS) and ask(store, "once") == []
    later = log.unionByName(log_of(spark, ("a", 1, "upsert", 9, "attribute_title", "changed twice")))
    compact(store, later, 4)
    assert ask(store, "twice") == [1] and ask(store, "bolt", "b") == [1]
    store.drop_site("a")
    compact(store, later, 5)  # a dropped site forgets what it took in
    assert served(store) == [("a", 1, "attribute_title", "changed twice"), ROWS[4]]


@pytest.mark.parametrize("broadcast_keys", [1_000_000, 0])
def test_deletes_and_purges_reach_postings_and_statistics(spark, monkeypatch, broadcast_keys):
    monkeypatch.setattr(jobs, "_BROADCAST_KEYS", broadcast_keys)
    store = stored(spark, ROWS)
    ids = "site string, id bigint"
    bulk_delete(store, literal_table(spark, ids, [("a", 1), ("a", 77), ("z", 1)]), 2)
    assert ask(store, "red") == [] and ask(store, "widget") == [2] and ask(store, "red", "b") == [1]
    assert rows_of(store.published(), "site", "version") == [("a", 2), ("b", 1)]
    statistics_agree(store, 2)
    bulk_delete(store, literal_table(spark, ids, [("a", 77)]), 3)
    assert rows_of(store.published(), "site", "version") == [("a", 2), ("b", 1)]
    delete(store, 2, "a", 3)
    assert ask(store, "widget") == []
    purge_orphans(store, literal_table(spark, "id bigint", [(3,), (8,)]), 4)
    assert served(store) == [("a", 3, "attribute_title", "")] and ask(store, "bolt", "b") == []
    purge_orphans(store, literal_table(spark, "id bigint", [(3,)]), 5)
    assert rows_of(store.published(), "site", "version") == [("a", 3), ("b", 4)]


def test_files_do_not_grow_with_shuffle_partitions(spark, monkeypatch):
    rows = [("a", n, "attribute_t", f"word{n} common word{n % 7}") for n in range(200)]
    log = log_of(spark, *[("a", n, "upsert", 1, "attribute_t", f"new{n}") for n in range(100)])
    monkeypatch.setattr(jobs, "_BROADCAST_KEYS", 0)
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        store = stored(spark, rows, n_buckets=8)
        compact(store, log, 2)
        files = store.version("postings", 2).select("_metadata.file_path").distinct().count()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert files <= 2 * 8
    statistics_agree(store, 2)


def test_reports_of_a_stored_index_read_no_text(spark):
    store = stored(spark, ROWS)
    found = reports.index_stats(store.table("keywords"), store.published())
    assert rows_of(found) == [("a", 1, 3, 29), ("b", 1, 1, 8)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan


def test_a_changed_mapping_rebuilds_only_sites_it_narrows(spark):
    store = stored(spark, ROWS)
    titles = literal_table(spark, "field string", [("attribute_title",), ("field_9",)])
    assert rows_of(jobs.update_mapping(store, titles, 2)) == [("a",)]
    assert rows_of(store.published(), "site", "version") == [("a", 2), ("b", 1)]
    assert ask(store, "old") == [] and ask(store, "red") == [1] and ask(store, "bolt", "b") == [1]
    statistics_agree(store, 2)
    assert jobs.update_mapping(store, titles, 3).count() == 0
    emptied = literal_table(spark, "field string", [("field_9",)])
    jobs.update_mapping(IndexStore(spark, store.root, 5), emptied, 3)
    assert served(store) == [] and ask(store, "red") == []
    assert rows_of(store.published(), "site", "version") == [("a", 3), ("b", 3)]
