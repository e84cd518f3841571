"""An index on shared storage.

Layout below the root::

    keywords/version=V/site=S/             whole documents, long form
    postings/version=V/site=S/bucket=B/    a task's rows by term, field; a file per task, or few where they are shuffled
    term_stats/version=V/site=S/bucket=B/  sorted by term, field
    field_stats/version=V/site=S/
    dictionary/version=V/site=S/kind=K/    ways to the terms, each file sorted by key
    published/seq=N/                       which version each site serves; the last counts
    applied/version=V/site=S/              the last logged change of each document that V took in
    tombstones/version=V/site=S/           the documents that the layer V replaces in earlier versions
    analyzers/version=V/                   how V's sites cut text into terms, where that is not the standard way
    reserved/name=N/                       the version number a named batch has

A version is written whole, into its own folders, and never changed.  Writing
it again (a retried job) replaces those folders.  Readers only see a version
once its ``published`` rows exist, and those are written last.  A layer is a version of few documents that
a site serves beside an earlier one; its statistics are differences, see ``plans/layers.py``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from lexigrid.functions.analysis import STANDARD
from lexigrid.model import KEYWORDS, Analyzer, Analyzers, Index
from lexigrid.operators.lookups import dictionary
from lexigrid.operators.postings import field_stats, posting_blocks, term_bucket, term_stats, unpacked
from lexigrid.operators.upkeep import current, id_blocks, of_documents, orphaned_versions, without_replaced
from lexigrid.session import bounded, literal_table, written
from lexigrid.sources.elements import select_site

_SCHEMAS = {
    "keywords": f"{KEYWORDS}, bytes bigint",
    "postings": (
        "field string, term string, id bigint, tf bigint, dl bigint, head boolean, "
        "positions array<int>, version bigint, site string, bucket int"
    ),
    "term_stats": "field string, term string, df bigint, version bigint, site string, bucket int",
    "field_stats": "field string, n_docs bigint, sum_dl bigint, version bigint, site string",
    "dictionary": "key string, field string, term string, df bigint, bucket int, version bigint, site string, kind string",
    "published": "site string, version bigint, n_buckets int, seq bigint",
    "layout": "n_buckets int, version bigint",
    "applied": "id bigint, ts timestamp, seq bigint, version bigint, site string",
    "tombstones": "id bigint, version bigint, site string",
    "analyzers": "site string, pattern string, lowercase boolean, pairs boolean, stopwords array<string>, version bigint",
    "reserved": "version bigint, name string",
}
_PARTITIONS = {
    "keywords": ["site"],
    "postings": ["site", "bucket"],
    "term_stats": ["site", "bucket"],
    "field_stats": ["site"],
    "dictionary": ["site", "kind"],
    "tombstones": ["site"],
}
# point reads by id skip row groups; the filter is sized to what it holds.  Keys in order are stored as differences, without
# first gathering them in a dictionary of values, which keys and their terms soon outgrow
_OPTIONS = {
    "dictionary": {
        "parquet.writer.version": "v2",
        "parquet.enable.dictionary#key": "false",
        "parquet.enable.dictionary#term": "false",
    },
    "keywords": {
        "parquet.bloom.filter.enabled#id": "true",
        "parquet.bloom.filter.adaptive.enabled": "true",
    }
}
# stored texts are cut into tasks of about this size, or this number of short ones, to be indexed: a task's postings fit in memory
_SPLIT_BYTES = 16 << 20
_SPLIT_ROWS = 500_000
_CUTS = {"keywords": {"parquet.block.size": str(_SPLIT_BYTES), "maxRecordsPerFile": str(_SPLIT_ROWS)}}
# the first column tells rows apart, so that sorting seldom compares further; folders are no part of it
_ORDER = {
    "keywords": ["id", "field"],
    "postings": ["term", "field"],
    "term_stats": ["term", "field"],
    "field_stats": ["field"],
    "dictionary": ["key"],
    "tombstones": ["id"],
}
# terms whose ways one task makes and sorts, about 12 rows each: from the first number on tasks for all cores, never above the second
_DICTIONARY_TERMS = (50_000, 250_000)
# blocks of document IDs that are broadcast at most: about 160 MB in memory
_BROADCAST_BLOCKS = 1_000_000
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
_MAX_WRITERS = 64
_SPLITS = "spark.sql.files.maxPartitionBytes"


def _parsed(schema: str) -> list[StructField]:
    return StructType.fromDDL(schema).fields


def buckets_for(spark: SparkSession, *paths: str) -> int:
    """Buckets of about 1 GB for an index over the files at ``paths``; at least 8."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    size = 0
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        size += path.getFileSystem(conf).getContentSummary(path).getLength()
    return max(size >> 30, 8)


@contextmanager
def _many_writers(spark: SparkSession, fine: bool = False) -> Iterator[None]:
    """Let a task write several folders at once, so that its rows need not be sorted by folder first.

    ``fine`` lets tasks read no more than ``_SPLIT_BYTES``.
    """
    settings = {_WRITERS: str(_MAX_WRITERS)} | ({_SPLITS: str(_SPLIT_BYTES)} if fine else {})
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


class IndexStore:
    """Reads, writes and publishes index versions below one folder."""

    def __init__(self, spark: SparkSession, root: str, n_buckets: int = 64):
        """``n_buckets`` divides the terms of a site; see ``buckets_for``."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.n_buckets = n_buckets

    # reading -----------------------------------------------------------------

    def table(self, name: str) -> DataFrame:
        """All versions of one table, published or not."""
        path = f"{self.root}/{name}"
        reader = self.spark.read.schema(_SCHEMAS[name]).option("basePath", path)
        if self._exists(path):
            return reader.parquet(path)
        return self.spark.sql("SELECT 1 AS x WHERE false").select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in _parsed(_SCHEMAS[name])]
        )

    def _exists(self, folder: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def version(self, name: str, version: int) -> DataFrame:
        """One version of one table, published or not."""
        return self.table(name).where(F.col("version") == version)

    def published(self) -> DataFrame:
        """``(site, version, n_buckets)``: what each site serves.

        Every publication writes the pointers of all sites anew, so the newest
        set is complete by itself.
        """
        last = self._last_seq()
        pointers = self.table("published")
        pointers = pointers.where(F.lit(False)) if last is None else pointers.where(F.col("seq") == last)
        return pointers.select("site", "version", "n_buckets")

    def tombstones(self) -> DataFrame | None:
        """``(site, version, block, ids)`` of the layers served, a written table; None if the store has never had a layer."""
        rows = self.table("tombstones")
        return self._blocks(current(rows, self.published()).select("site", "version", "id")) if rows.inputFiles() else None

    def _blocks(self, ids: DataFrame) -> DataFrame:
        return bounded(written(id_blocks(ids), "blocks"), _BROADCAST_BLOCKS)

    def postings_of(self, touched: DataFrame) -> DataFrame:
        """The postings that the documents ``touched(site, id)`` have in the versions served, replaced ones included."""
        return of_documents(current(self.table("postings"), self.published()), self._blocks(touched.select("site", "id")))

    def live(self, name: str) -> DataFrame:
        """What is served of ``keywords`` or ``postings``: base and layers, without replaced documents."""
        return without_replaced(current(self.table(name), self.published()), self.tombstones())

    def bucketed(self, posting_table: DataFrame) -> DataFrame:
        """Postings, in rows or blocks, with this store's buckets."""
        return posting_table.withColumn("bucket", term_bucket("term", self.n_buckets))

    def index(self) -> Index:
        """The stored tables, ready for search; search reads published versions only."""
        tombstones = self.tombstones()
        return Index(
            tombstones=tombstones,
            keywords=without_replaced(self.table("keywords").drop("bytes"), tombstones),
            postings=self.table("postings"),
            term_stats=self.table("term_stats"),
            field_stats=self.table("field_stats"),
            dictionary=self.table("dictionary"),
            published=self.published(),
            analyzers=self.analyzers(),
        )

    def analyzers(self) -> Analyzers:
        """How the texts of the served sites were analysed, as stored with the versions they serve.

        Settings, of which there are as many as sites; a base and its layers have the same.
        """
        if not self._exists(f"{self.root}/analyzers"):
            return STANDARD
        rows = current(self.table("analyzers"), self.published()).collect()
        made = {r["site"]: Analyzer(r["pattern"], r["lowercase"], r["pairs"], tuple(r["stopwords"])) for r in rows}
        return made or STANDARD

    # writing -----------------------------------------------------------------

    def write_version(
        self, keywords: DataFrame, version: int, analyzer: Analyzers = STANDARD, publish: bool = True
    ) -> None:
        """Build and store one version of every site in ``keywords(site, id, field, text)``.

        The analyzer, one for all or each site's own, is kept with the version: searches and jobs use it.

        The text is read twice in all: to store it, and (from the stored copy)
        to index it.  The statistics come from narrow scans of the postings.
        """
        self.write_keywords(keywords, version)
        self.index_version(version, analyzer)
        if publish:
            self.publish_version(version)

    def index_version(self, version: int, analyzer: Analyzers = STANDARD) -> None:
        """Make the postings, statistics and dictionary of stored documents."""
        stored = self.version("keywords", version)
        blocks = self.bucketed(posting_blocks(stored, analyzer))
        # a task can write to so many folders without closing one
        in_place = self._sites(version) * self.n_buckets <= _MAX_WRITERS
        self.write_postings(blocks, version, in_place=in_place)
        self.write_analyzers(analyzer, version)

    def write_analyzers(self, analyzers: Analyzers, version: int) -> None:
        """Note how a version's sites are analysed; nothing where all are so in the standard way.

        Each site's own are noted whether or not the version has documents of it, so an emptied site keeps its own.
        """
        if isinstance(analyzers, Analyzer):
            sites = self.version("keywords", version).select("site").distinct().collect() if analyzers != STANDARD else []
            analyzers = {r["site"]: analyzers for r in sites}
        rows = [(s, a.pattern, a.lowercase, a.pairs, list(a.stopwords)) for s, a in sorted(analyzers.items()) if a != STANDARD]
        path = f"{self.root}/analyzers/version={version}"
        if rows or self._exists(path):
            schema = _SCHEMAS["analyzers"].removesuffix(", version bigint")
            literal_table(self.spark, schema, rows).repartition(1).write.mode("overwrite").parquet(path)

    def write_keywords(self, keywords: DataFrame, version: int, few: bool = False) -> None:
        """Store the documents of one version, where they are: no shuffle.

        ``few`` leaves out the filter on IDs, which has a least size whatever it holds.
        """
        if not self.published().where(F.col("version") == version).isEmpty():
            raise ValueError(f"version {version} is being served; use a new number")
        size = F.octet_length("text").cast("bigint").alias("bytes")  # reports then need no text
        self._write("keywords", version, keywords.select("site", "id", "field", "text", size), shuffle=False, lookup=not few)

    def write_postings(
        self,
        posting_table: DataFrame,
        version: int,
        clustered: bool = False,
        added: DataFrame | None = None,
        in_place: bool = False,
    ) -> None:
        """Store postings of one version, in rows or blocks, and the statistics that follow from them.

        ``in_place`` sorts rows and stores them where they are made, without a shuffle: each task then has a file in each folder.
        ``clustered`` says the rows already come bucket by bucket (they are
        read from another version), so no shuffle is needed, nor a sort: they are in order; ``added`` postings are
        shuffled and stored beside them.
        """
        layout = self.spark.range(1).select(F.lit(self.n_buckets).alias("n_buckets"))
        layout.write.mode("overwrite").parquet(f"{self.root}/layout/version={version}")
        self._write("postings", version, posting_table, shuffle=not (clustered or in_place), sort=not clustered, fine=clustered or in_place)
        if added is not None:
            self._write("postings", version, added, mode="append")
        stored = self.version("postings", version)
        self._write("term_stats", version, term_stats(stored))
        self._write_dictionary(version)
        self._write("field_stats", version, field_stats(stored))

    def write_layer(
        self, changed: DataFrame, touched: DataFrame, replaced: DataFrame, version: int, analyzer: Analyzers = STANDARD
    ) -> None:
        """Store ``changed(site, id, field, text)`` as a layer that replaces the documents ``touched(site, id)``.

        ``replaced`` are the postings these had so far; the layer's statistics are its own less theirs.
        """
        self.write_keywords(changed, version, few=True)
        layout = self.spark.range(1).select(F.lit(self.n_buckets).alias("n_buckets"))
        layout.write.mode("overwrite").parquet(f"{self.root}/layout/version={version}")
        self._write("postings", version, self.bucketed(posting_blocks(self.version("keywords", version), analyzer)))
        narrow = ["site", "bucket", "field", "term", "dl", "head"]
        added = self.version("postings", version).select(*narrow, F.lit(1).alias("sign"))
        both = added.unionByName(self.bucketed(replaced).select(*narrow, F.lit(-1).alias("sign")))
        # a term stays listed where both are equal, as the layer has postings of it
        terms = both.groupBy("site", "bucket", "field", "term").agg(F.sum("sign").alias("df"))
        fields = both.where("head").groupBy("site", "field").agg(
            F.sum("sign").alias("n_docs"), F.sum(F.col("sign") * F.col("dl")).alias("sum_dl")
        )
        self._write("term_stats", version, terms)
        self._write_dictionary(version)
        self._write("field_stats", version, fields)
        self._write("tombstones", version, touched.select("site", "id"))
        self.write_analyzers(analyzer, version)

    def publish_layer(self, sites: DataFrame, version: int) -> None:
        """Let these sites serve a layer beside what they serve."""
        new = sites.select("site", F.lit(version).cast("bigint").alias("version"), F.lit(self.n_buckets).alias("n_buckets"))
        self._write_pointers(self.published().unionByName(new))

    def reserve(self, name: str) -> int:
        """The version number of a named batch: the one it has, else the next after all that are known."""
        given = self.table("reserved")
        had = given.where(F.col("name") == name).first()
        if had is not None:
            return had["version"]
        known = given.select("version").union(self.published().select("version")).union(self.table("layout").select("version"))
        version = (known.agg(F.max("version")).first()[0] or 0) + 1
        row = self.spark.range(1).select(F.lit(version).cast("bigint").alias("version"))
        row.write.mode("overwrite").parquet(f"{self.root}/reserved/name={name}")
        return version

    def publish_version(self, version: int) -> None:
        """Let every site of a complete version serve it from now on."""
        sites = self.version("keywords", version).select("site").distinct()
        self.publish(sites.withColumn("version", F.lit(version)))

    def publish(self, pointers: DataFrame) -> None:
        """Point sites to versions, ``(site, version)``; all become visible at once.

        The number of buckets is that with which the version was written.
        """
        new = pointers.select(
            "site", F.col("version").cast("bigint").alias("version"),
        ).join(self.table("layout"), "version", "left").select(
            "site", "version", F.coalesce("n_buckets", F.lit(self.n_buckets)).alias("n_buckets")
        )
        self._write_pointers(self._without(new).unionByName(new))

    def applied(self) -> DataFrame:
        """``(site, id, ts, seq)``: logged changes taken in so far, by any version."""
        return self.table("applied").select("site", "id", "ts", "seq")

    def applied_by(self, version: int) -> DataFrame:
        """The changes a version has noted."""
        return self.version("applied", version)

    def record_applied(self, changes: DataFrame, version: int) -> None:
        """Remember changes ``(site, id, ts, seq)``; after publishing, so that a failed run forgets them."""
        path = f"{self.root}/applied/version={version}"
        changes.select("site", "id", "ts", "seq").write.mode("overwrite").partitionBy("site").parquet(path)

    def withdraw(self, sites: DataFrame) -> None:
        """Stop serving these sites."""
        self._write_pointers(self._without(sites))

    # removing ----------------------------------------------------------------

    def purge_versions(self, site: str | None = None) -> list[tuple[str, int]]:
        """Delete the versions no pointer names, of one served site or all; returns them."""
        rows = select_site(self._versions(), site)
        return self._remove(orphaned_versions(rows, self.published()))

    def drop_site(self, site: str) -> list[tuple[str, int]]:
        """Stop serving a site and delete all its versions; returns them."""
        rows = self._versions().where(F.col("site") == site)
        self.withdraw(literal_table(self.spark, "site string", [(site,)]))
        self._remove(self.table("applied").where(F.col("site") == site), ["applied"])
        return self._remove(rows)

    def _remove(self, rows: DataFrame, tables: Iterable[str] = tuple(_PARTITIONS)) -> list[tuple[str, int]]:
        # on the driver: there are no more names than versions
        names = sorted(tuple(r) for r in rows.select("site", "version").distinct().collect())
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        escape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        for name in tables:
            for site, version in names:
                folder = f"{self.root}/{name}/version={version}/site={escape(site)}"
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(conf).delete(path, True)
        return names

    def _sites(self, version: int) -> int:
        """How many sites a version has documents of, from the names of their folders."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/keywords/version={version}/site=*")
        return len(path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path))

    def _versions(self) -> DataFrame:
        # a layer that only removes has no documents
        return self.table("keywords").select("site", "version").union(self.table("tombstones").select("site", "version"))

    def _without(self, sites: DataFrame) -> DataFrame:
        return self.published().join(sites.select("site"), "site", "left_anti")

    def _write_pointers(self, pointers: DataFrame) -> None:
        last = self._last_seq()
        seq = 0 if last is None else last + 1
        # one file: there are no more pointers than sites
        path = f"{self.root}/published/seq={seq}"
        pointers.repartition(1).write.mode("errorifexists").parquet(path)

    def _last_seq(self) -> int | None:
        # read from the folder names, so without a job
        found = re.findall(r"/seq=(\d+)/", " ".join(self.table("published").inputFiles()))
        return max(map(int, found), default=None)

    def _write_dictionary(self, version: int) -> None:
        """Terms are dealt in ranges of bounded size; the rows a term has in the dictionary are made and sorted there, and not shuffled.

        Each file is in order of its keys, so a range of keys is a few of its pages.
        """
        terms = self.version("term_stats", version)
        n = terms.count()
        tasks = max(-(-n // _DICTIONARY_TERMS[1]), min(-(-n // _DICTIONARY_TERMS[0]), self.spark.sparkContext.defaultParallelism), 1)
        self._write("dictionary", version, dictionary(terms.repartitionByRange(tasks, "term", "site", "field")), shuffle=False)

    def _write(
        self,
        name: str,
        version: int,
        rows: DataFrame,
        shuffle: bool = True,
        mode: str = "overwrite",
        lookup: bool = True,
        sort: bool = True,
        fine: bool = False,
    ) -> None:
        parts = _PARTITIONS[name]
        rows = rows.drop("version")
        if shuffle:
            # adaptive execution splits the hot buckets and joins the small
            # ones, so a term in a third of all documents becomes many files
            rows = rows.hint("rebalance", *[F.col(c) for c in parts])
        if sort:
            rows = rows.sortWithinPartitions(*_ORDER[name])
        if "ids" in rows.columns:
            rows = unpacked(rows)
        with _many_writers(rows.sparkSession, fine):
            (
                rows.write.mode(mode)
                .options(**(_OPTIONS.get(name, {}) if lookup else {}), **_CUTS.get(name, {}))
                .option("compression", "zstd")
                .partitionBy(*parts)
                .parquet(f"{self.root}/{name}/version={version}")
            )
