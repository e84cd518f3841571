import pytest
from helpers import keywords, rows_of, versioned

from lexigrid.model import TYPES
from lexigrid.operators import reports, upkeep
from lexigrid.session import literal_table
from lexigrid.sources import elements as E
from lexigrid.sources.documents import build_keywords, build_mapping, mapping_diff

ROWS = [
    ("a", 1, "f", "one"), ("a", 1, "g", "uno"), ("a", 2, "f", "two"), ("b", 1, "f", "één"), ("b", 3, "f", ""),
]
IDS = "site string, id bigint"


def test_upsert_replaces_whole_documents_and_repeats_harmlessly(spark):
    base = keywords(spark, ROWS)
    changes = keywords(spark, [("a", 1, "f", "ONE"), ("b", 9, "f", "nine")])
    once = upkeep.upsert(base, changes)
    assert rows_of(once) == sorted([("a", 1, "f", "ONE"), *ROWS[2:], ("b", 9, "f", "nine")])
    assert rows_of(upkeep.upsert(once, changes)) == rows_of(once)


def test_deletes(spark):
    base = keywords(spark, ROWS)
    assert rows_of(upkeep.bulk_delete(base, literal_table(spark, IDS, []))) == sorted(ROWS)
    ids = literal_table(spark, IDS, [("a", 1), ("a", 77)])
    assert rows_of(upkeep.bulk_delete(base, ids)) == sorted(ROWS[2:])
    assert rows_of(upkeep.delete(base, 1, "b")) == sorted([*ROWS[:3], ROWS[4]])
    assert rows_of(upkeep.source(base, 1, "a")) == sorted(ROWS[:2])
    assert upkeep.source(base, 77).count() == 0


def test_orphans_are_judged_by_one_global_live_set(spark):
    base = keywords(spark, ROWS)
    live = literal_table(spark, "id bigint", [(1,), (1,), (5,)])
    assert rows_of(upkeep.orphan_ids(base, live)) == [("a", 2), ("b", 3)]
    once = upkeep.purge_orphans(base, live)
    assert rows_of(once) == rows_of(upkeep.bulk_delete(base, upkeep.orphan_ids(base, live)))
    assert rows_of(upkeep.purge_orphans(once, live)) == rows_of(once)


def test_versions_and_reports(spark):
    rows = versioned(spark, [
        ("a", 1, 1, "f", "x"), ("a", 2, 1, "f", "é"), ("a", 2, 1, "g", "yy"), ("a", 2, 2, "f", ""), ("b", 1, 1, "f", "z"),
    ])
    published = literal_table(spark, "site string, version bigint", [("a", 2)])
    sites = literal_table(spark, "site string, lang string", [("a", "en"), ("c", "de")])
    assert rows_of(reports.index_stats(rows, published)) == [("a", 2, 2, 4)]
    status = {r["site"]: r["n_docs"] for r in reports.site_status(sites, rows, published).collect()}
    assert status == {"a": 2, "c": None}
    assert rows_of(upkeep.orphaned_versions(rows, published)) == [("a", 1)]
    assert rows_of(upkeep.versions(upkeep.purge_versions(rows, published))) == [("a", 2), ("b", 1)]
    listed = reports.list_versions(rows, published, "IX")
    assert rows_of(listed, "name", "orphaned") == [("ix_a_1", True), ("ix_a_2", False), ("ix_b_1", True)]
    everything = reports.list_versions(rows, published, "none", show_all=True)
    assert {r["orphaned"] for r in everything.collect()} == {None} and everything.count() == 3
    assert reports.list_versions(rows, published, "IX", starting_with="ix_b").count() == 1
    assert reports.list_versions(rows, published, ".hidden", show_all=True).count() == 0


def test_site_selector(spark):
    base = keywords(spark, ROWS)
    sites = literal_table(spark, "site string", [("a",), ("b",)])
    assert E.select_site(base, None).count() == E.select_site(base, "*", sites).count() == 5
    assert E.select_site(base, "b", sites).count() == 2
    with pytest.raises(ValueError):
        E.select_site(base, "nosite", sites)


def test_worklist_order_and_types(spark):
    from datetime import datetime, timezone

    def day(n):
        return datetime(2024, 1, n, tzinfo=timezone.utc)

    elements = literal_table(
        spark, "site string, id bigint, type string, is_draft boolean, date_created timestamp, date_updated timestamp",
        [("a", 1, "x", True, day(1), day(5)), ("a", 2, "y", False, day(3), day(3)), ("b", 3, "x", None, day(2), day(9))],
    )
    assert [r["id"] for r in E.full_worklist(elements, newest_first=True).collect()] == [2, 3, 1]
    assert rows_of(E.full_worklist(elements, ["x"])) == [(1, "x"), (3, "x")]
    work = E.updated_since(elements, "2024-01-05")
    assert rows_of(work) == [(1, "x"), (3, "x")]
    assert rows_of(E.hydrate(elements, work, "b"), "id") == [(3,)]
    assert rows_of(E.without_drafts(elements), "id") == [(2,), (3,)]
    assert rows_of(E.catch_up(elements, "2024-01-04", "a"), "id") == [(1,)]


def test_build_keywords_by_type_and_layout(spark):
    elements = literal_table(
        spark, "site string, id bigint, type string, title string, slug string, body string",
        [("a", 1, "page", "T", None, "B"), ("a", 2, "file", "T2", "s2", "")],
    )
    types = literal_table(spark, TYPES, [("page", True, []), ("file", False, ["name"])])
    layouts = literal_table(spark, "type string, handle string", [("page", "body")])
    built = build_keywords(
        elements, ["title", "slug", "name"], {"body": 7}, types=types, layouts=layouts,
        extractors={"name": lambda df: df["title"]}, prefix="p_",
    )
    assert rows_of(built) == [
        ("a", 1, "p_attribute_slug", ""), ("a", 1, "p_attribute_title", "T"), ("a", 1, "p_field_7", "B"),
        ("a", 2, "p_attribute_name", "T2"), ("a", 2, "p_attribute_slug", "s2"),
    ]
    only_layouts = build_keywords(elements, ["slug"], {"body": 7}, layouts=layouts)
    assert rows_of(only_layouts, "id", "field") == [(1, "attribute_slug"), (1, "field_7"), (2, "attribute_slug")]
    with pytest.raises(ValueError):
        build_keywords(elements)


def test_mapping_and_its_drift(spark):
    types = literal_table(spark, TYPES, [("page", True, ["title", "name"]), ("bare", False, [])])
    fields = literal_table(spark, "field_id int, handle string, searchable boolean", [(1, "x", True), (2, "y", False)])
    mapping = build_mapping(types, fields)
    assert rows_of(mapping) == [("attribute_name",), ("attribute_slug",), ("attribute_title",), ("field_1",)]
    current = literal_table(spark, "field string", [("attribute_name",), ("field_9",), ("attribute_slug",)])
    assert rows_of(mapping_diff(current, mapping)) == [
        ("attribute_title", "added"), ("field_1", "added"), ("field_9", "removed"),
    ]
    assert rows_of(E.eligible_types(types), "type") == [("page",)]


def test_worklists_are_ordered_and_need_a_moment(spark):
    from datetime import datetime

    made = literal_table(spark, "id bigint, type string, date_created timestamp, date_updated timestamp", [
        (n, "t" if n % 2 else "u", datetime(2024, 1, 1 + n % 3), datetime(2024, 1, 1 + n % 3)) for n in range(6)
    ])
    assert [r["id"] for r in E.full_worklist(made, ["t"], newest_first=True).collect()] == [5, 1, 3]
    assert rows_of(E.updated_since(made, "2024-01-03"), "id") == rows_of(E.updated_since(made, datetime(2024, 1, 3)), "id") == [(2,), (5,)]
    for wrong in (None, "", "soon"):
        with pytest.raises((TypeError, ValueError)):
            E.updated_since(made, wrong)
