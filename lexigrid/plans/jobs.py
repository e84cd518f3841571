"""Jobs that change a stored index.

Each writes a whole new version and publishes it last; ``layers.py`` has those that write only what changes.  Postings of documents
that did not change are copied, not computed again: where the changed documents
are few enough to broadcast, the others are read bucket by bucket and written to
the same buckets, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrid.functions.analysis import analyzer_of
from lexigrid.model import Analyzers
from lexigrid.operators import upkeep
from lexigrid.operators.postings import posting_rows, term_bucket
from lexigrid.session import literal_table, written
from lexigrid.sources.store import IndexStore
from lexigrid.streaming.changes import newest_changes

# document keys that are broadcast at most: below 100 MB with the site's name
_BROADCAST_KEYS = 1_000_000


def _served(store: IndexStore, name: str, site: str | None = None) -> DataFrame:
    rows = store.live(name)
    return rows if site is None else rows.where(F.col("site") == site)


def _pointer(store: IndexStore, site: str) -> tuple[int, int]:
    """The last version a site serves, and the buckets of all it serves, -1 if they differ."""
    rows = store.published().where(F.col("site") == site).collect()  # a base and its layers
    if not rows:
        raise ValueError(f"site {site!r} serves no index")
    buckets = {r["n_buckets"] for r in rows}
    return max(r["version"] for r in rows), buckets.pop() if len(buckets) == 1 else -1


def reindex_site(store: IndexStore, site: str, mapping: DataFrame, version: int) -> dict:
    """Rebuild a site without fields no longer mapped; publish the result.

    Returns the old and new version and the number of documents.  If writing
    fails nothing is published and readers keep the old version.
    """
    fields = mapping.select("field").distinct()
    old, old_buckets = _pointer(store, site)
    kept = _served(store, "keywords", site).join(fields, "field", "left_semi")
    store.write_keywords(kept, version)
    kept_postings = _served(store, "postings", site).join(fields, "field", "left_semi")
    _copy_postings(store, kept_postings, old_buckets, version)
    store.write_analyzers(store.analyzers(), version)
    store.publish_version(version)
    total = upkeep.indexed_ids(store.version("keywords", version)).count()
    return {"old": old, "new": version, "total": total}


def update_mapping(store: IndexStore, mapping: DataFrame, version: int) -> DataFrame:
    """After a change of field definitions: rebuild every served site that holds a field no longer mapped.

    All such sites become one new version; returns them.  New fields need no
    rebuild: documents bring them when they are next indexed.
    """
    fields = mapping.select("field").distinct()
    held = _served(store, "keywords").select("site", "field").distinct()
    stale = written(held.join(fields, "field", "left_anti").select("site").distinct(), "stale")
    if stale.isEmpty():
        return stale
    kept = {
        name: _served(store, name).join(stale, "site", "left_semi").join(fields, "field", "left_semi")
        for name in ("keywords", "postings")
    }
    store.write_keywords(kept["keywords"], version)
    other = store.published().join(stale, "site", "left_semi").where(F.col("n_buckets") != store.n_buckets)
    _copy_postings(store, kept["postings"], store.n_buckets if other.isEmpty() else -1, version)
    store.write_analyzers(store.analyzers(), version)
    store.publish(stale.withColumn("version", F.lit(version)))
    return stale


def clone_site(store: IndexStore, source_site: str, target_site: str, version: int) -> None:
    """Serve a copy of one site's index as another site's."""
    _, old_buckets = _pointer(store, source_site)
    renamed = {
        name: _served(store, name, source_site).withColumn("site", F.lit(target_site))
        for name in ("keywords", "postings")
    }
    store.write_keywords(renamed["keywords"], version)
    _copy_postings(store, renamed["postings"], old_buckets, version)
    store.write_analyzers({target_site: analyzer_of(store.analyzers(), source_site)}, version)
    store.publish_version(version)


def compact(
    store: IndexStore,
    log: DataFrame,
    version: int,
    analyzer: Analyzers | None = None,
    merge_files: bool = False,
) -> None:
    """Bring the sites a change log names up to date with it, as one new version.

    Other sites go on serving the version they have, and of the touched sites
    only the changed documents are analysed and shuffled.  A site named first
    here is created; one left without documents serves an empty index.

    Changed documents are analysed as their site is, unless ``analyzer`` says otherwise; documents that stay
    are not analysed again, so a site should keep its analyzer until it is built anew.

    The store remembers each document's last applied change, so running over
    the whole log again applies only newer ones: a full reload in between is
    not undone by changes from before it.

    Each run adds small files for the changed postings.  ``merge_files``
    shuffles all postings of the touched sites together again; use it now and
    then.
    """
    fresh = written(unapplied(newest_changes(log), store), "changes")
    touched = written(fresh.select("site", "id", "ts", "seq").distinct(), "touched")
    if touched.isEmpty():
        return
    changed = fresh.where(F.col("op") != "delete").select("site", "id", "field", "text")
    _replace(store, touched.select("site", "id"), changed, version, analyzer, merge_files)
    store.record_applied(touched, version)


def bulk_delete(store: IndexStore, ids: DataFrame, version: int) -> None:
    """Remove documents ``(site, id)`` from what is stored and found, as one new version of their sites.

    Unknown documents are no error; sites without a document to remove keep their version.
    """
    indexed = upkeep.indexed_ids(_served(store, "keywords"))
    gone = written(indexed.join(ids.select("site", "id").distinct(), ["site", "id"], "left_semi"), "removed")
    if not gone.isEmpty():
        _replace(store, gone, None, version)


def delete(store: IndexStore, doc_id: int, site: str, version: int) -> None:
    """Remove one document of one site."""
    bulk_delete(store, literal_table(store.spark, "site string, id bigint", [(site, doc_id)]), version)


def purge_orphans(store: IndexStore, live: DataFrame, version: int) -> None:
    """Remove the documents of all sites whose ID is live nowhere."""
    gone = written(upkeep.orphan_ids(_served(store, "keywords"), live), "removed")
    if not gone.isEmpty():
        _replace(store, gone, None, version)


def unapplied(newest: DataFrame, store: IndexStore) -> DataFrame:
    """Changes later than the last one applied to their document."""
    last = store.applied().groupBy("site", "id").agg(F.max(F.struct("ts", "seq")).alias("_applied"))
    rows = newest.join(last, ["site", "id"], "left")
    later = F.col("_applied").isNull() | (F.struct("ts", "seq") > F.col("_applied"))
    return rows.where(later).select(*newest.columns)


def _replace(
    store: IndexStore,
    touched: DataFrame,
    changed: DataFrame | None,
    version: int,
    analyzer: Analyzers | None = None,
    merge_files: bool = False,
) -> None:
    """New version of the sites of ``touched(site, id)``, a written table, without those documents but with ``changed``.

    Up to ``_BROADCAST_KEYS`` keys are sent to where the postings are read, which
    then stay in their buckets; more are joined by shuffle, and the postings
    brought back together by bucket.  The rows stored are the same.
    """
    few = touched.count() <= _BROADCAST_KEYS
    analyzer = store.analyzers() if analyzer is None else analyzer
    sites = touched.select("site").distinct()
    keys = F.broadcast(touched) if few else touched
    kept_rows = {
        name: _served(store, name).join(sites, "site", "left_semi").join(keys, ["site", "id"], "left_anti")
        for name in ("keywords", "postings")
    }
    columns = ["site", "id", "field", "text"]
    documents = kept_rows["keywords"].select(*columns)
    store.write_keywords(documents if changed is None else documents.unionByName(changed.select(*columns)), version)

    kept, added = kept_rows["postings"], None
    buckets = [r["n_buckets"] for r in store.published().join(sites, "site", "left_semi").select("n_buckets").distinct().collect()]
    bucket = term_bucket("term", store.n_buckets)
    if any(n != store.n_buckets for n in buckets):
        few, kept = False, kept.withColumn("bucket", bucket)
    if changed is not None:
        added = posting_rows(changed.withColumn("version", F.lit(version).cast("bigint")), analyzer).withColumn("bucket", bucket)
    if few and not merge_files:
        store.write_postings(kept, version, clustered=True, added=added)
    else:
        store.write_postings(kept if added is None else kept.unionByName(added), version)
    store.write_analyzers(analyzer, version)
    store.publish(sites.withColumn("version", F.lit(version)))


def _copy_postings(store: IndexStore, rows: DataFrame, old_buckets: int, version: int) -> None:
    same = old_buckets == store.n_buckets
    if not same:
        rows = rows.withColumn("bucket", term_bucket("term", store.n_buckets))
    store.write_postings(rows, version, clustered=same)


def fan_out(
    changes: DataFrame,
    sinks: Mapping[str, Callable[[DataFrame], None]],
    enabled: Mapping[str, bool] | None = None,
) -> list[str]:
    """Send one change set to every enabled sink; returns their names.

    The changes are computed once and written, so all sinks see the same rows.
    """
    chosen = [name for name in sinks if enabled is None or enabled.get(name, False)]
    if chosen:
        rows = written(changes, "changes")
        for name in chosen:
            sinks[name](rows)
    return chosen
