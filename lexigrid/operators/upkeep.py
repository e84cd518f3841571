"""Keeping keyword rows right: upserts, deletes, rebuilds, clones, purges.

All are joins on keys, so each is its own inverse of nothing twice: running one
a second time changes nothing.  Rows removed are found by ``left_anti``; Spark
broadcasts the key side when it is small and shuffles both sides when not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def indexed_ids(keywords: DataFrame) -> DataFrame:
    """All document IDs, per site."""
    return keywords.select("site", "id").distinct()


def source(keywords: DataFrame, doc_id: int, site: str | None = None) -> DataFrame:
    """Stored fields of one document; no rows if it is not indexed."""
    rows = keywords.where(F.col("id") == doc_id)
    return rows if site is None else rows.where(F.col("site") == site)


def upsert(keywords: DataFrame, changes: DataFrame) -> DataFrame:
    """Replace changed documents whole: fields missing from the change are gone after it."""
    touched = changes.select("site", "id").distinct()
    kept = keywords.join(touched, ["site", "id"], "left_anti")
    return kept.unionByName(changes.select(*keywords.columns))


def bulk_delete(keywords: DataFrame, ids: DataFrame) -> DataFrame:
    """Remove documents named by ``(site, id)``; unknown ones are no error."""
    return keywords.join(ids.select("site", "id"), ["site", "id"], "left_anti")


def delete(keywords: DataFrame, doc_id: int, site: str) -> DataFrame:
    """Remove one document of one site."""
    return keywords.where(~((F.col("site") == site) & (F.col("id") == doc_id)))


def current(rows: DataFrame, published: DataFrame) -> DataFrame:
    """Rows of the versions readers see."""
    return rows.join(published.select("site", "version"), ["site", "version"], "left_semi")


def id_blocks(ids: DataFrame) -> DataFrame:
    """Documents ``(site, id)``, of layers ``(site, version, id)``, in rows of up to 64 neighbouring IDs: ``block`` and a bit of ``ids`` for each.

    A broadcast row takes some 150 bytes of the driver and of each executor, so IDs that lie close together
    take a fraction of what they take one by one; where none do, there are as many rows.
    """
    keys = [c for c in ("site", "version") if c in ids.columns]
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), _place(F.col("id")))
    return ids.groupBy(*keys, F.shiftright("id", 6).alias("block")).agg(F.bit_or(bit).alias("ids"))


def _place(doc_id: Column) -> Column:
    return doc_id.bitwiseAND(F.lit(63)).cast("int")


def _in_blocks() -> Column:
    """That rows ``(site, id)`` are named by blocks whose columns are marked ``_``."""
    place = (F.col("site") == F.col("_site")) & (F.shiftright("id", 6) == F.col("_block"))
    return place & (F.getbit("_ids", _place(F.col("id"))) == 1)


def _marked(blocks: DataFrame) -> DataFrame:
    return blocks.select(*[F.col(c).alias(f"_{c}") for c in blocks.columns])


def of_documents(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """Rows ``(site, id, ...)`` of the documents that ``id_blocks`` hold."""
    return rows.join(_marked(blocks), _in_blocks(), "left_semi")


def without_replaced(rows: DataFrame, tombstones: DataFrame | None) -> DataFrame:
    """Rows ``(site, version, id, ...)`` but for those of documents that a later layer of their site names.

    ``tombstones(site, version, block, ids)`` are the ``id_blocks`` of the layers.
    """
    if tombstones is None:
        return rows
    return rows.join(_marked(tombstones), _in_blocks() & (F.col("version") < F.col("_version")), "left_anti")


def reindex_projection(
    keywords: DataFrame, published: DataFrame, mapping: DataFrame, version: int
) -> DataFrame:
    """Rows of a new version of every published site, without fields no longer mapped."""
    return (
        current(keywords, published)
        .join(mapping.select("field"), "field", "left_semi")
        .withColumn("version", F.lit(version).cast("bigint"))
        .select(*keywords.columns)
    )


def clone_site(
    keywords: DataFrame, published: DataFrame, source_site: str, target_site: str, version: int
) -> DataFrame:
    """Rows of a new version of ``target_site``: a copy of what ``source_site`` serves."""
    return (
        current(keywords.where(F.col("site") == source_site), published)
        .withColumn("site", F.lit(target_site))
        .withColumn("version", F.lit(version).cast("bigint"))
        .select(*keywords.columns)
    )


def drop_site(keywords: DataFrame, site: str) -> DataFrame:
    """What is left after removing every version of a site."""
    return keywords.where(F.col("site") != site)


def versions(rows: DataFrame) -> DataFrame:
    """The versions present, e.g. those a removal took away."""
    return rows.select("site", "version").distinct()


def orphaned_versions(rows: DataFrame, published: DataFrame) -> DataFrame:
    """Versions of served sites that no pointer names."""
    pointers = published.select("site", "version")
    return (
        versions(rows)
        .join(pointers, ["site", "version"], "left_anti")
        .join(pointers, "site", "left_semi")
    )


def purge_versions(rows: DataFrame, published: DataFrame) -> DataFrame:
    """Rows left once orphaned versions of served sites are gone."""
    pointers = published.groupBy("site").agg(F.collect_set("version").alias("_served"))
    return (
        rows.join(pointers, "site", "left")
        .where(F.col("_served").isNull() | F.array_contains("_served", F.col("version")))
        .select(*rows.columns)
    )


def orphan_ids(keywords: DataFrame, live: DataFrame) -> DataFrame:
    """Indexed documents, per site, whose ID is live nowhere."""
    return indexed_ids(keywords).join(live.select("id"), "id", "left_anti").select("site", "id")


def purge_orphans(keywords: DataFrame, live: DataFrame) -> DataFrame:
    """Rows of documents that are still live.

    The same result as deleting ``orphan_ids``, in one join instead of two.
    """
    return keywords.join(live.select("id"), "id", "left_semi").select(*keywords.columns)
