"""The given tables, shaped as the library's inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrid.model import FIELDS, Analyzer, Analyzers, Index
from lexigrid.session import fresh_dir, literal_table
from lexigrid.sources.documents import build_keywords
from lexigrid.sources.store import IndexStore, buckets_for

_stores: dict[tuple[str, str], IndexStore] = {}
_documents: dict[tuple[str, str], IndexStore] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def part_fields(spark: SparkSession) -> DataFrame:
    """Custom fields of parts: ``size`` is not searchable."""
    return literal_table(spark, FIELDS, [(1, "brand", True), (2, "kind", True), (3, "size", False)])


def document_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents: site = language, one attribute ``text``."""
    docs = table(spark, sf_dir, "documents").withColumnsRenamed({"lang": "site", "doc_id": "id"})
    return build_keywords(docs, ["text"])


def ideograph_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with some of their letters as ideographs and kana: text of several scripts, most of it without blanks between words."""
    return document_keywords(spark, sf_dir).withColumn("text", F.translate("text", "etaoinshr", "的一是不了人かなー"))


def part_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.lit("catalog").alias("site"), F.col("p_partkey").alias("id"),
        F.col("p_type").alias("type"), F.col("p_name").alias("title"),
        F.lower(F.replace("p_name", F.lit(" "), F.lit("-"))).alias("slug"),
        F.col("p_brand").alias("brand"), F.col("p_type").alias("kind"),
        F.col("p_size").alias("size"),
    )


def part_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts: site ``catalog``, a title, a slug and two searchable custom fields."""
    return build_keywords(
        part_elements(spark, sf_dir), ["title", "slug"],
        {"brand": 1, "kind": 2, "size": 3}, fields=part_fields(spark),
    )


def all_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_keywords(spark, sf_dir).unionByName(part_keywords(spark, sf_dir))


def store(spark: SparkSession, sf_dir: str) -> IndexStore:
    """The stored index over all documents and parts, built on first use in a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stores:
        _stores[key] = new_store(spark, sf_dir)
    return _stores[key]


def documents(spark: SparkSession, sf_dir: str) -> Index:
    """What is served of the stored documents, for steps that ask for no postings, so none are made for them."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _stores:
        return index(spark, sf_dir)
    if key not in _documents:
        made = IndexStore(spark, fresh_dir(spark, "documents"))
        made.write_keywords(all_keywords(spark, sf_dir), 1)
        made.publish_version(1)
        _documents[key] = made
    return _documents[key].index()


def new_store(spark: SparkSession, sf_dir: str, analyzers: Analyzers = Analyzer()) -> IndexStore:
    """A store of its own, for jobs that change it."""
    buckets = buckets_for(spark, f"{sf_dir}/documents.parquet", f"{sf_dir}/part.parquet")
    made = IndexStore(spark, fresh_dir(spark, "index"), buckets)
    made.write_version(all_keywords(spark, sf_dir), 1, analyzers)
    return made


def index(spark: SparkSession, sf_dir: str) -> Index:
    return store(spark, sf_dir).index()


def order_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as elements: type = status, site = priority, both dates the order date."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("site"), F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("type"), F.col("o_orderdate").alias("date_created"),
        F.col("o_orderdate").alias("date_updated"), F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").cast("string").alias("price"),
    )


def part_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types derived from parts, by brand.

    A brand has titles if its smallest size is 1; its attributes are the kinds
    it sells in size 50.
    """
    return table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("type")).agg(
        (F.min("p_size") == 1).alias("has_titles"),
        F.sort_array(F.collect_set(F.when(F.col("p_size") == 50, F.lower("p_type")))).alias("attributes"),
    )


def nation_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Field definitions derived from nations: searchable outside region 0."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("int").alias("field_id"), F.lower("n_name").alias("handle"),
        (F.col("n_regionkey") > 0).alias("searchable"),
    )


def versioned_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of the documents: all of them, and those that have labels."""
    docs = document_keywords(spark, sf_dir)
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    first = docs.withColumn("version", F.lit(1).cast("bigint"))
    second = docs.join(labels, "id", "left_semi").withColumn("version", F.lit(2).cast("bigint"))
    columns = ["site", "version", "id", "field", "text"]
    return first.select(*columns).unionByName(second.select(*columns))


def pointers(spark: SparkSession) -> DataFrame:
    """What is served: the second version in English, the first in German and French."""
    return literal_table(
        spark, "site string, version bigint", [("en", 2), ("de", 1), ("fr", 1)]
    )


def document_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed documents: toxic ones get a new text, benchmark items are new."""
    docs = table(spark, sf_dir, "documents")
    toxic = table(spark, sf_dir, "labels").where(F.col("toxic") == 1).select("doc_id")
    changed = docs.join(toxic, "doc_id", "left_semi").select(
        F.col("lang").alias("site"), F.col("doc_id").alias("id"),
        F.lit("attribute_text").alias("field"), F.concat(F.lit("Changed: "), "text").alias("text"),
    )
    new = table(spark, sf_dir, "benchmark").select(
        F.lit("en").alias("site"), (F.col("item_id") + 1_000_000_000_000).alias("id"),
        F.lit("attribute_text").alias("field"), "text",
    )
    return changed.unionByName(new)


def event_changes(events: DataFrame) -> DataFrame:
    """Events as a change log of users: an error deletes the user, low values are drafts."""
    return events.select(
        F.lit("users").alias("site"), F.col("user_id").alias("id"),
        F.when(F.col("event_type") == "error", "delete").otherwise("upsert").alias("op"),
        F.col("ts"), F.col("event_id").alias("seq"), (F.col("value") < 1.0).alias("is_draft"),
        F.lit("attribute_event").alias("field"),
        F.concat_ws(" ", "event_type", "props").alias("text"),
    )


def benchmark_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query per benchmark item: its whole text as a phrase, over English documents."""
    no = F.lit(None).cast("boolean")
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").cast("int").alias("query_id"), F.lit("en").alias("site"),
        F.lit(0).alias("ord"), F.col("text").alias("term"),
        F.lit(None).cast("string").alias("attribute"), no.alias("exclude"),
        F.lit(True).alias("phrase"), no.alias("sub_left"), no.alias("sub_right"),
        F.lit(False).alias("is_group"),
    )


def part_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query terms derived from parts: the words of each name, then its slug.

    Flags follow the part: medium kinds exclude, small ones match prefixes,
    large ones suffixes; sizes over 40 name the field of the kind.
    """
    kind = F.col("p_type")
    words = F.concat(
        F.split("p_name", " "), F.array(F.replace("p_name", F.lit(" "), F.lit("-")))
    )
    return (
        table(spark, sf_dir, "part")
        .select("*", F.posexplode(words).alias("ord", "term"))
        .select(
            F.col("p_partkey").cast("int").alias("query_id"), F.lit("catalog").alias("site"),
            "ord", F.concat(F.lit(" "), "term").alias("term"),
            F.when(F.col("p_size") > 40, "kind").alias("attribute"),
            (kind == "MEDIUM").alias("exclude"), (F.col("p_size") == 7).alias("phrase"),
            kind.isin("LARGE", "ECONOMY").alias("sub_left"),
            kind.isin("SMALL", "ECONOMY").alias("sub_right"),
            (F.col("p_size") == 9).alias("is_group"),
        )
    )
