"""One entry per operator: ``name -> function(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrid.functions.analysis import analyze, explain_source, remove_stopwords
from lexigrid.functions.languages import stopwords
from lexigrid.functions.names import map_attribute, map_field
from lexigrid.model import BOOSTS, QUERY_TERMS, SITES, STOPWORDS, Analyzer
from lexigrid.operators import reports, upkeep
from lexigrid.operators.clauses import build_clauses
from lexigrid.plans import jobs, layers
from lexigrid.plans.jobs import fan_out
from lexigrid.plans.search import search
from lexigrid.session import fresh_dir, literal_table
from lexigrid.sources import elements as E
from lexigrid.sources.documents import build_keywords, build_mapping, mapping_diff
from lexigrid.sources.store import IndexStore
from lexigrid.streaming.changes import change_log, latest_wins, stream_index
from registry import datasets as D

SINCE = "1998-06-01 00:00:00"


def term(query_id, ord, text, site="en", attribute=None, **flags):
    """A row of the query-term table."""
    names = ("exclude", "phrase", "sub_left", "sub_right")
    return (
        query_id, site, ord, text, attribute, *[flags.get(n) for n in names],
        flags.get("is_group", False),
    )


# The literal queries, by registry key.
TERMS = {
    "search_bm25": [term(1, 0, "that"), term(1, 1, "with"), term(2, 0, "une", "fr"), term(2, 1, "la", "fr")],
    "search_required": [
        term(1, 0, "the"), term(1, 1, "and"), term(2, 0, "die", "de"), term(3, 0, "los", "es"),
        term(4, 0, "red", "catalog"), term(4, 1, "bolt", "catalog"), term(5, 0, "the.and"),
    ],
    "search_excluded": [
        term(1, 0, "the", exclude=True), term(2, 0, "with"), term(2, 1, "that", exclude=True),
        term(3, 0, "widget", "catalog", exclude=True), term(3, 1, "economy", "catalog"),
    ],
    "search_phrase": [
        term(1, 0, "of the", phrase=True), term(2, 0, "de la", "fr", phrase=True, exclude=True),
        term(3, 0, "the the", phrase=True), term(4, 0, "red widget", "catalog", phrase=True),
        term(4, 1, "blue bolt", "catalog", phrase=True, attribute="title"),
    ],
    "search_slug": [
        term(1, 0, "by-nc"), term(2, 0, "red-widget", "catalog"), term(2, 1, "small", "catalog"),
        term(3, 0, "blue-bolt", "catalog", exclude=True, sub_right=True),
    ],
    "search_field": [
        term(1, 0, "red", "catalog", "title"), term(2, 0, "small", "catalog", "kind"),
        term(3, 0, "small", "catalog", "title"), term(4, 0, "brand", "catalog", "brand"),
        term(5, 0, "the", "en", "text"), term(6, 0, "the", "en", "nowhere"),
    ],
    "search_prefix": [
        term(1, 0, "ther", sub_right=True), term(2, 0, "wid", "catalog", sub_right=True),
        term(3, 0, "Eau", "fr", sub_right=True), term(3, 1, "la", "fr"),
    ],
    "search_suffix": [
        term(1, 0, "tion", sub_left=True), term(2, 0, "lt", "catalog", sub_left=True),
        term(3, 0, "heit", "de", sub_left=True),
    ],
    "search_contains": [
        term(1, 0, "ouea", sub_left=True, sub_right=True),
        term(2, 0, "idge", "catalog", sub_left=True, sub_right=True),
        term(3, 0, "a", "es", sub_left=True, sub_right=True),
    ],
    "search_boolean": [
        term(1, 0, "the"), term(1, 1, "with", exclude=True), term(1, 2, "of the", phrase=True),
        term(1, 3, "tion", sub_right=True, exclude=True),
        term(2, 0, "of the", phrase=True), term(2, 1, "and", exclude=True),
        term(3, 0, "large", "catalog", "kind"), term(3, 1, "wid", "catalog", "title", sub_right=True),
        term(3, 2, "red widget", "catalog", phrase=True),
        term(4, 0, "nosuchterm"), term(4, 1, "the"),
        # clauses that share a number, and queries over two sites with equal IDs
        term(5, 0, "the"), term(5, 0, "red", "catalog"), term(6, 0, "red", "catalog"), term(6, 0, "bolt", "catalog"),
        term(7, 0, "red", "catalog", exclude=True), term(7, 0, "with"),
    ],
    "search_scoped": [
        term(1, 0, "the"), term(2, 0, "the"), term(3, 0, "the", exclude=True),
        term(4, 0, "of the", phrase=True),
    ],
    "search_boosted": [
        term(1, 0, "small", "catalog"), term(2, 0, "red", "catalog"),
        term(3, 0, "small", "catalog", "title"), term(4, 0, "wid", "catalog", sub_right=True),
        term(5, 0, "red widget", "catalog", phrase=True),
    ],
    "search_topk": [
        term(1, 0, "the"), term(2, 0, "de", "fr"), term(3, 0, "small", "catalog"),
        term(4, 0, "e", sub_left=True),
    ],
    "search_empty": [
        term(1, 0, "the", is_group=True), term(2, 0, "   "), term(3, 0, "?!."),
        term(4, 0, " * ", sub_right=False), term(5, 0, "", sub_right=True), term(6, 0, "that"),
        term(6, 1, "..."), term(7, 0, "the", "nosite"),
    ],
    "search_stopwords": [
        term(1, 0, "the"), term(1, 1, "that"), term(2, 0, "of", exclude=True), term(2, 1, "in"),
        term(3, 0, "in the that", phrase=True), term(4, 0, "the in", phrase=True), term(5, 0, "of the", phrase=True),
        term(5, 1, "that of", phrase=True), term(6, 0, "the and"), term(7, 0, "th", sub_right=True),
        term(8, 0, "la que de", "es", phrase=True), term(9, 0, "la", "fr"), term(9, 1, "une", "fr"), term(10, 0, "red", "catalog"),
    ],
    "search_cjk": [
        term(1, 0, "一な"), term(2, 0, "一な的", phrase=True), term(3, 0, "是"), term(4, 0, "一な的"),
        term(4, 1, "的か 的か", phrase=True), term(5, 0, "d"), term(6, 0, "是", "fr", sub_right=True), term(6, 1, "的か", "fr", exclude=True),
    ],
    "search_hook": [
        term(1, 0, "small", "catalog"), term(1, 1, "red", "catalog", exclude=True),
        term(2, 0, "widget", "catalog"),
    ],
}
# asked of an index that a job has changed
JOB_TERMS = [
    term(1, 0, "the"), term(2, 0, "changed"), term(3, 0, "red", "catalog"), term(4, 0, "die", "de"),
    term(5, 0, "of the", "en", phrase=True), term(6, 0, "small", "catalog"), term(7, 0, "with", "copy"),
]
BOOST_ROWS = [("title", 3.0), ("kind", 0.5)]
STOP_ROWS = [
    ("en", "the"), ("en", "of"), ("en", "and"), ("en", "with"), ("fr", "de"), ("fr", "la"),
    ("fr", "le"), ("de", "die"), ("de", "und"), ("es", "de"), ("es", "los"),
]
SITE_ROWS = [("en", "en"), ("fr", "fr"), ("de", "de"), ("es", "es"), ("catalog", "en")]
QUERY_HANDLES = [(1, "brand", True), (2, "kind", True), (3, "economy", True), (7, "small", False)]


def _search(key: str, **options):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        made = {name: make(spark, sf_dir) for name, make in options.items() if callable(make)}
        plain = {name: value for name, value in options.items() if not callable(value)}
        return search(
            D.index(spark, sf_dir), literal_table(spark, QUERY_TERMS, TERMS[key]),
            fields=D.part_fields(spark), **made, **plain,
        )

    return run


def _scope(spark, sf_dir):
    good = D.table(spark, sf_dir, "labels").where(F.col("quality") == 1)
    asked = F.array(F.lit(1), F.lit(3), F.lit(4))
    return good.select(F.explode(asked).alias("query_id"), F.col("doc_id").alias("id"))


def _title_only(clauses: DataFrame) -> DataFrame:
    return clauses.where(F.col("occur") != "must_not").withColumn("field", F.lit("attribute_title"))


def _search_hook(spark, sf_dir):
    return search(
        D.index(spark, sf_dir), literal_table(spark, QUERY_TERMS, TERMS["search_hook"]),
        fields=D.part_fields(spark), before_query=_title_only,
    )


def _search_batch(spark, sf_dir):
    return search(D.index(spark, sf_dir), D.benchmark_terms(spark, sf_dir))


def _after(job):
    """Hits of an index of its own after a job, so that postings and statistics show."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        store = D.new_store(spark, sf_dir)
        job(spark, sf_dir, store)
        return search(store.index(), literal_table(spark, QUERY_TERMS, JOB_TERMS), fields=D.part_fields(spark))

    return run


def _stop_analyzers():
    words = {site: tuple(word for lang, word in STOP_ROWS if lang == spoken) for site, spoken in SITE_ROWS}
    return {site: Analyzer(stopwords=listed) for site, listed in words.items()}


def _stopwords(job=None):
    """Hits of an index whose sites leave out their stop words, and keep doing so after a job."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        store = D.new_store(spark, sf_dir, _stop_analyzers())
        if job is not None:
            job(spark, sf_dir, store)
        return search(store.index(), literal_table(spark, QUERY_TERMS, TERMS["search_stopwords"]), fields=D.part_fields(spark))

    return run


def _search_cjk(spark, sf_dir):
    store = IndexStore(spark, fresh_dir(spark, "cjk"), 8)
    store.write_version(D.ideograph_keywords(spark, sf_dir), 1, Analyzer(pairs=True))
    return search(store.index(), literal_table(spark, QUERY_TERMS, TERMS["search_cjk"]))


def _change_log(spark, sf_dir):
    return D.document_changes(spark, sf_dir).withColumns(
        {"op": F.lit("upsert"), "ts": F.lit("2024-01-01 00:00:00").cast("timestamp"), "seq": F.lit(1).cast("bigint")}
    )


def _bad_documents(spark, sf_dir):
    bad = D.table(spark, sf_dir, "labels").where(F.col("quality") == 0).select("doc_id")
    ids = D.table(spark, sf_dir, "documents").join(bad, "doc_id", "left_semi")
    return ids.select(F.col("lang").alias("site"), F.col("doc_id").alias("id"))


def _compact_after_reload(spark, sf_dir):
    store, log = D.new_store(spark, sf_dir), _change_log(spark, sf_dir)
    jobs.compact(store, log, 2)
    store.write_version(D.all_keywords(spark, sf_dir), 3)
    jobs.compact(store, log, 4)
    served = store.index()
    return upkeep.current(served.keywords, served.published).select("site", "id", "field", "text")


def _as_layers(spark, sf_dir, store):
    """An upsert, a removal and a purge, each a layer over the one before."""
    layers.apply_changes(store, _change_log(spark, sf_dir), 2)
    layers.remove(store, _bad_documents(spark, sf_dir), 3)
    layers.remove_orphans(store, _live_or_new(spark, sf_dir), 4)


def _live_or_new(spark, sf_dir):
    new = D.table(spark, sf_dir, "benchmark").select((F.col("item_id") + 1_000_000_000_000).alias("id"))
    return _live(spark, sf_dir).union(new)


def _merged(spark, sf_dir, store):
    _as_layers(spark, sf_dir, store)
    layers.merge_layers(store, 5)


def _delta_stats(spark, sf_dir):
    """Document frequencies by difference, and the rows of fields beside them."""
    store = D.new_store(spark, sf_dir)
    _as_layers(spark, sf_dir, store)
    served = store.index()
    terms = upkeep.current(served.term_stats, served.published).groupBy("site", "field", "term").agg(F.sum("df").alias("df")).where("df > 0")
    fields = upkeep.current(served.field_stats, served.published).groupBy("site", "field").agg(
        F.sum("n_docs").alias("n_docs"), F.sum("sum_dl").alias("sum_dl")
    )
    return terms.join(fields, ["site", "field"])


def _stream_search(spark, sf_dir):
    """The change log of users, in several micro-batches, each replayed once, then searched."""
    store = D.IndexStore(spark, fresh_dir(spark, "index"), 8)
    path = fresh_dir(spark, "events")
    D.table(spark, sf_dir, "events").repartitionByRange(3, "event_id").write.parquet(path)
    stream = spark.readStream.schema(D.table(spark, sf_dir, "events").schema).option("maxFilesPerTrigger", 1).parquet(path)
    layers.stream_search(D.event_changes(stream), store, fresh_dir(spark, "index-state")).awaitTermination()
    rows = [term(1, 0, "click", "users"), term(2, 0, "view", "users"), term(3, 0, "click", "users", exclude=True), term(4, 0, "purchase", "users")]
    return search(store.index(), literal_table(spark, QUERY_TERMS, rows))


def _reindex(spark, sf_dir, store):
    mapping = literal_table(spark, "field string", [("attribute_title",), ("field_1",)])
    jobs.reindex_site(store, "catalog", mapping, 2)


def _narrow_mapping(spark):
    return literal_table(spark, "field string", [("attribute_text",), ("attribute_slug",), ("field_2",), ("field_9",)])


def _stored_index_stats(spark, sf_dir):
    store = D.store(spark, sf_dir)
    return reports.index_stats(store.table("keywords"), store.published())


def _clauses_options(spark, sf_dir):
    size = F.col("p_size")
    options = D.table(spark, sf_dir, "part").where(size < 30).select(
        F.col("p_partkey").cast("int").alias("query_id"), F.when(size < 10, True).alias("exclude"),
        (size % 2 == 0).alias("sub_left"), F.when(size > 20, size % 3 == 0).alias("sub_right"),
    )
    terms = D.part_terms(spark, sf_dir)
    for flag in ("exclude", "sub_left", "sub_right"):  # a part's own flag where it is set, else left open
        terms = terms.withColumn(flag, F.when(F.col(flag), True))
    return build_clauses(terms, D.part_fields(spark), options)


def _prefixed_names(spark, sf_dir):
    rows = _map_attribute_prefixed(spark, sf_dir)
    return map_field(rows, _handles(spark), "field", "handle", "my_")


def _map_attribute_prefixed(spark, sf_dir):
    rows = D.table(spark, sf_dir, "part").select("p_partkey", F.lower("p_type").alias("attribute"))
    return map_attribute(rows, _handles(spark), "attribute", "field", "my_")


def _language_stopwords(spark, sf_dir):
    own = literal_table(spark, STOPWORDS, [("xx", "never"), ("de", "dokument")])
    sites = literal_table(spark, SITES, SITE_ROWS[:4])
    return remove_stopwords(analyze(D.document_keywords(spark, sf_dir)), sites, stopwords(spark, own)).groupBy("site").agg(
        F.sum(F.when(F.col("term").isin(*LISTED), 1).otherwise(0)).alias("n_listed"),
        F.sum(F.when(F.col("term").isin("never", "catalog"), 1).otherwise(0)).alias("n_unlisted"),
    )


# a list applies to its own language only; ``les`` is in the Spanish one too, which the SQL does not know
LISTED = ("the", "und", "les", "los")


def _worklist_chosen(spark, sf_dir):
    return E.full_worklist(D.order_elements(spark, sf_dir), ["O", "P"], newest_first=True)


def _site_elements(spark, sf_dir):
    return E.select_site(D.order_elements(spark, sf_dir), "2-HIGH").select("site", "id", "type")


def _delete_document(spark, sf_dir):
    return upkeep.delete(D.all_keywords(spark, sf_dir), 7, "catalog")


def _worklist_full(spark, sf_dir):
    return E.full_worklist(D.order_elements(spark, sf_dir))


def _updated_since(spark, sf_dir):
    return E.updated_since(D.order_elements(spark, sf_dir), SINCE)


def _hydrate_worklist(spark, sf_dir):
    orders = D.order_elements(spark, sf_dir)
    return E.hydrate(orders, E.updated_since(orders, SINCE)).select("site", "id", "type", "price")


def _catch_up_since(spark, sf_dir):
    behind = E.catch_up(D.order_elements(spark, sf_dir), SINCE)
    return build_keywords(behind, ["priority", "price"])


def _fanout_reindex(spark, sf_dir):
    orders = D.order_elements(spark, sf_dir)
    rows = build_keywords(E.hydrate(orders, E.updated_since(orders, SINCE)), ["priority", "price"])
    paths = {name: fresh_dir(spark, name) for name in ("database", "search", "unused")}

    def to(path):
        return lambda df: df.write.parquet(path)

    sinks = {name: to(path) for name, path in paths.items()}
    done = fan_out(rows, sinks, {"database": True, "search": True, "unused": False})
    read = [spark.read.schema(rows.schema).parquet(paths[n]).withColumn("sink", F.lit(n)) for n in done]
    return read[0].unionByName(read[1])


def _eligible_types(spark, sf_dir):
    return E.eligible_types(D.part_types(spark, sf_dir)).select("type", "has_titles")


def _type_counts(spark, sf_dir):
    parts = D.table(spark, sf_dir, "part").select(F.col("p_brand").alias("type"))
    return E.type_counts(parts, D.part_types(spark, sf_dir))


def _build_keywords(spark, sf_dir):
    types = literal_table(
        spark, "type string, has_titles boolean, attributes array<string>",
        [("ECONOMY", True, []), ("SMALL", False, ["vendor"]), ("LARGE", True, ["vendor", "title"])],
    )
    elements = D.part_elements(spark, sf_dir)
    return build_keywords(
        elements, ["title", "slug", "vendor"], {"brand": 1, "kind": 2, "size": 3},
        types=types, fields=D.part_fields(spark),
        extractors={"vendor": F.upper("brand"), "kind": lambda df: F.lower(df["kind"])},
    )


def _handles(spark):
    return literal_table(spark, "field_id int, handle string, searchable boolean", QUERY_HANDLES)


def _map_attribute(spark, sf_dir):
    rows = D.table(spark, sf_dir, "part").select("p_partkey", F.lower("p_type").alias("attribute"))
    return map_attribute(rows, _handles(spark), "attribute", "field")


def _map_field(spark, sf_dir):
    size = F.col("p_size").cast("string")
    rows = D.table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(F.col("p_size") < 10, F.concat(F.lit("field_"), size))
        .when(F.col("p_type") == "SMALL", F.concat(F.lit("other_"), size))
        .otherwise(F.concat(F.lit("attribute_"), F.lower("p_name"))).alias("field"),
    )
    return map_field(rows, _handles(spark), "field", "handle")


def _mapping(spark, sf_dir):
    return build_mapping(D.part_types(spark, sf_dir), D.nation_fields(spark, sf_dir))


def _mapping_diff(spark, sf_dir):
    served = D.documents(spark, sf_dir)
    return mapping_diff(upkeep.current(served.keywords, served.published), _mapping(spark, sf_dir))


def _analyze_stopwords(spark, sf_dir):
    return remove_stopwords(
        analyze(D.document_keywords(spark, sf_dir)),
        literal_table(spark, SITES, SITE_ROWS), literal_table(spark, STOPWORDS, STOP_ROWS),
    )


def _source_explained(spark, sf_dir):
    return explain_source(D.all_keywords(spark, sf_dir), D.part_fields(spark))


def _postings(spark, sf_dir):
    return D.index(spark, sf_dir).postings.select(
        "site", "field", "term", "id", "tf", "dl", F.concat_ws(" ", "positions").alias("positions")
    )


def _term_stats(spark, sf_dir):
    return D.index(spark, sf_dir).term_stats.select("site", "field", "term", "df")


def _field_stats(spark, sf_dir):
    return D.index(spark, sf_dir).field_stats.select("site", "field", "n_docs", "sum_dl")


def _dictionary(spark, sf_dir):
    """What each key of the stored dictionary leads to."""
    ways = D.index(spark, sf_dir).dictionary
    return ways.groupBy("site", "field", "kind", "key").agg(
        F.count("*").alias("n_terms"), F.sum("df").alias("df"), F.min("term").alias("first_term")
    )


def _clauses(spark, sf_dir):
    return build_clauses(D.part_terms(spark, sf_dir), D.part_fields(spark))


def _indexed_ids(spark, sf_dir):
    served = D.documents(spark, sf_dir)
    return upkeep.indexed_ids(upkeep.current(served.keywords, served.published))


def _source(spark, sf_dir):
    served = D.documents(spark, sf_dir)
    return upkeep.source(upkeep.current(served.keywords, served.published), 7)


def _upsert_documents(spark, sf_dir):
    return upkeep.upsert(D.document_keywords(spark, sf_dir), D.document_changes(spark, sf_dir))


def _bulk_delete(spark, sf_dir):
    return upkeep.bulk_delete(D.document_keywords(spark, sf_dir), _bad_documents(spark, sf_dir))


def _reindex_projection(spark, sf_dir):
    served = D.documents(spark, sf_dir)
    mapping = literal_table(
        spark, "field string", [("attribute_text",), ("attribute_title",), ("field_2",), ("field_9",)]
    )
    return upkeep.reindex_projection(served.keywords, served.published, mapping, 2)


def _clone_site(spark, sf_dir):
    served = D.documents(spark, sf_dir)
    return upkeep.clone_site(served.keywords, served.published, "en", "copy", 7)


def _versioned(function):
    def run(spark, sf_dir):
        return function(D.versioned_keywords(spark, sf_dir), D.pointers(spark))

    return run


def _drop_site(spark, sf_dir):
    return upkeep.drop_site(D.versioned_keywords(spark, sf_dir), "en")


def _site_status(spark, sf_dir):
    sites = literal_table(spark, SITES, [*SITE_ROWS, ("xx", "xx")])
    return reports.site_status(sites, D.versioned_keywords(spark, sf_dir), D.pointers(spark))


def _list_versions(spark, sf_dir):
    return reports.list_versions(D.versioned_keywords(spark, sf_dir), D.pointers(spark), "Texts")


def _live(spark, sf_dir):
    return D.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))


def _orphan_ids(spark, sf_dir):
    return upkeep.orphan_ids(D.document_keywords(spark, sf_dir), _live(spark, sf_dir))


def _purge_orphans(spark, sf_dir):
    return upkeep.purge_orphans(D.document_keywords(spark, sf_dir), _live(spark, sf_dir))


def _latest_wins(spark, sf_dir):
    log = E.without_drafts(D.event_changes(D.table(spark, sf_dir, "events")))
    return latest_wins(log).select("site", "id", "op", "seq", "field", "text")


def _stream_index(spark, sf_dir):
    schema = D.table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    path = fresh_dir(spark, "log")
    stream_index(D.event_changes(stream), path, fresh_dir(spark, "log-state")).awaitTermination()
    return latest_wins(change_log(spark, path)).select("site", "id", "op", "seq", "field", "text")


QUERIES = {
    # sources
    "worklist_full": _worklist_full,
    "updated_since": _updated_since,
    "hydrate_worklist": _hydrate_worklist,
    "catch_up_since": _catch_up_since,
    "fanout_reindex": _fanout_reindex,
    "eligible_types": _eligible_types,
    "type_counts": _type_counts,
    "build_keywords": _build_keywords,
    "build_mapping": _mapping,
    "mapping_diff": _mapping_diff,
    # names and analysis
    "map_attribute": _map_attribute,
    "map_field": _map_field,
    "analyze_tokens": lambda spark, sf_dir: analyze(D.document_keywords(spark, sf_dir)),
    "analyze_stopwords": _analyze_stopwords,
    "source_explained": _source_explained,
    # the index
    "postings": _postings,
    "term_stats": _term_stats,
    "field_stats": _field_stats,
    "dictionary": _dictionary,
    # search
    "clauses": _clauses,
    **{key: _search(key) for key in TERMS if key not in ("search_scoped", "search_boosted", "search_topk", "search_hook")},
    "search_scoped": _search("search_scoped", scope=_scope),
    "search_boosted": _search("search_boosted", boosts=lambda spark, _: literal_table(spark, BOOSTS, BOOST_ROWS)),
    "search_topk": _search("search_topk", k=10),
    "search_hook": _search_hook,
    "search_batch": _search_batch,
    # by the documents of the rarest required clause, however few there are
    "search_candidates": _search("search_boolean", candidates_from=0),
    "search_candidates_scoped": _search("search_scoped", scope=_scope, candidates_from=0),
    "search_scope_only": _search("search_scoped", scope=_scope, on_empty_scope="none"),
    # jobs on a stored index
    "search_stopwords": _stopwords(),
    "delta_stopwords": _stopwords(_as_layers),
    "compact_stopwords": _stopwords(lambda spark, sf_dir, store: jobs.compact(store, _change_log(spark, sf_dir), 2)),
    "analyze_cjk": lambda spark, sf_dir: analyze(D.ideograph_keywords(spark, sf_dir), Analyzer(pairs=True)),
    "search_cjk": _search_cjk,
    "compact_search": _after(lambda spark, sf_dir, store: jobs.compact(store, _change_log(spark, sf_dir), 2)),
    "compact_after_reload": _compact_after_reload,
    "purge_orphans_search": _after(lambda spark, sf_dir, store: jobs.purge_orphans(store, _live(spark, sf_dir), 2)),
    "bulk_delete_search": _after(lambda spark, sf_dir, store: jobs.bulk_delete(store, _bad_documents(spark, sf_dir), 2)),
    "delete_search": _after(lambda spark, sf_dir, store: jobs.delete(store, 7, "catalog", 2)),
    "reindex_search": _after(_reindex),
    "mapping_search": _after(lambda spark, sf_dir, store: jobs.update_mapping(store, _narrow_mapping(spark), 2)),
    "clone_search": _after(lambda spark, sf_dir, store: jobs.clone_site(store, "en", "copy", 2)),
    "stored_index_stats": _stored_index_stats,
    # layers
    "delta_search": _after(_as_layers),
    "delta_merged_search": _after(_merged),
    "delta_stats": _delta_stats,
    "stream_search": _stream_search,
    # options and single steps
    "clauses_options": _clauses_options,
    "prefixed_names": _prefixed_names,
    "language_stopwords": _language_stopwords,
    "worklist_chosen": _worklist_chosen,
    "site_elements": _site_elements,
    "live_ids": lambda spark, sf_dir: E.live_ids(D.order_elements(spark, sf_dir)),
    "delete_document": _delete_document,
    # upkeep
    "indexed_ids": _indexed_ids,
    "source": _source,
    "upsert_documents": _upsert_documents,
    "bulk_delete": _bulk_delete,
    "reindex_projection": _reindex_projection,
    "clone_site": _clone_site,
    "drop_site": _drop_site,
    "orphan_ids": _orphan_ids,
    "purge_orphans": _purge_orphans,
    # versions and reports
    "current_index": _versioned(upkeep.current),
    "purge_versions": _versioned(upkeep.purge_versions),
    "orphaned_versions": _versioned(upkeep.orphaned_versions),
    "index_stats": _versioned(reports.index_stats),
    "site_status": _site_status,
    "list_versions": _list_versions,
    # streams
    "latest_wins": _latest_wins,
    "stream_index": _stream_index,
}
