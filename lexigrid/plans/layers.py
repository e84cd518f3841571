"""Small changes of a stored index: layers over the versions a site serves.

A layer is a version that holds only the changed documents.  Beside them it has the IDs of all documents it replaces
or removes (tombstones), and statistics as differences: what its postings add, less what the replaced ones had.
A site serves its base and its layers together; search sums the statistics of all, and leaves out matches
of documents that a later layer names.  So a change writes in proportion to itself, and is found at once.  ``merge_layers``
makes them one version again; the jobs in ``jobs.py`` that write a whole new version do so too.

Versions are numbers that rise: a layer's must be above those its sites serve.  There is one writer at a time.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexigrid.model import Analyzers
from lexigrid.operators import upkeep
from lexigrid.plans.jobs import unapplied
from lexigrid.session import written
from lexigrid.sources.elements import without_drafts
from lexigrid.sources.store import IndexStore
from lexigrid.streaming.changes import newest_changes

_CONTENT = ["site", "id", "field", "text"]


def apply_changes(store: IndexStore, log: DataFrame, version: int, analyzer: Analyzers | None = None) -> None:
    """Bring the sites a change log names up to date with it, by a layer of the changed documents.

    As ``compact``, the store remembers what it applied, so a log may be given again.
    """
    fresh = written(unapplied(newest_changes(log), store), "changes")
    touched = written(fresh.select("site", "id", "ts", "seq").distinct(), "touched")
    if not touched.isEmpty():
        _write_layer(store, touched.select("site", "id"), fresh.where(F.col("op") != "delete").select(*_CONTENT), version, analyzer)
        store.record_applied(touched, version)


def remove(store: IndexStore, ids: DataFrame, version: int) -> None:
    """Remove documents ``(site, id)`` by a layer without content; unknown ones are no error."""
    indexed = upkeep.indexed_ids(store.live("keywords"))
    gone = written(indexed.join(ids.select("site", "id").distinct(), ["site", "id"], "left_semi"), "removed")
    if not gone.isEmpty():
        _write_layer(store, gone, None, version)


def remove_orphans(store: IndexStore, live: DataFrame, version: int) -> None:
    """Remove the documents of all sites whose ID is live nowhere, by a layer."""
    gone = written(upkeep.orphan_ids(store.live("keywords"), live), "removed")
    if not gone.isEmpty():
        _write_layer(store, gone, None, version)


def merge_layers(store: IndexStore, version: int) -> DataFrame:
    """Make one new version of each site that serves several; returns these sites.

    Postings are not computed again and, where all have the store's number of buckets, copied bucket by bucket without a shuffle.
    """
    pointers = store.published()
    sites = pointers.groupBy("site").agg(F.count("*").alias("n")).where("n > 1").select("site")
    sites = written(sites, "layered")
    if sites.isEmpty():
        return sites
    kept = {name: store.live(name).join(sites, "site", "left_semi") for name in ("keywords", "postings")}
    store.write_keywords(kept["keywords"], version)
    other = pointers.join(sites, "site", "left_semi").where(F.col("n_buckets") != store.n_buckets)
    same = other.isEmpty()
    store.write_postings(kept["postings"] if same else store.bucketed(kept["postings"]), version, clustered=same)
    store.write_analyzers(store.analyzers(), version)
    store.publish(sites.withColumn("version", F.lit(version)))
    return sites


def _write_layer(store: IndexStore, touched: DataFrame, changed: DataFrame | None, version: int, analyzer: Analyzers | None = None) -> None:
    """``touched(site, id)`` is a written table; ``changed`` is None where only removals are made."""
    sites = touched.select("site").distinct()
    later = store.published().join(sites, "site", "left_semi").where(F.col("version") >= version)
    if not later.isEmpty():
        raise ValueError(f"version {version} is not above those its sites serve")
    if changed is None:
        changed = store.table("keywords").select(*_CONTENT).where(F.lit(False))
    # the documents first: of the other postings nothing needs to be known
    replaced = upkeep.without_replaced(store.postings_of(touched), store.tombstones())
    store.write_layer(changed, touched, replaced, version, store.analyzers() if analyzer is None else analyzer)
    store.publish_layer(sites, version)


def stream_search(
    changes: DataFrame, store: IndexStore, checkpoint: str, analyzer: Analyzers | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """Index a stream of changes, drafts left out: each micro-batch becomes a layer that search finds at once.

    A batch has one version number, given to it by name before anything is written.  Replaying it
    writes the same folders again or, where its layer is served already, only notes its changes.
    A stream is known by its checkpoint.
    """
    stream = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()

    def apply(batch: DataFrame, batch_id: int) -> None:
        apply_batch(store, batch, f"{stream}-{batch_id}", analyzer)

    return (
        without_drafts(changes)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def apply_batch(store: IndexStore, batch: DataFrame, name: str, analyzer: Analyzers | None = None) -> None:
    """A named batch of changes as a layer; again, it changes nothing."""
    version = store.reserve(name)
    rows = written(batch, "batch")
    if store.published().where(F.col("version") == version).isEmpty():
        apply_changes(store, rows, version, analyzer)
    elif store.applied_by(version).isEmpty():
        store.record_applied(newest_changes(rows).select("site", "id", "ts", "seq").distinct(), version)
