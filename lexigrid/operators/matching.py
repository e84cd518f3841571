"""Lookups to document matches, and matches to scored documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexigrid.model import Bm25
from lexigrid.operators.upkeep import without_replaced
from lexigrid.session import written

_POSTING_KEY = ["site", "version", "bucket", "field", "term"]
_WANTED = (
    *_POSTING_KEY, "query_id", "clause", "occur", "n_must", "n_should", "idf", "avgdl", "boost"
)
_CLAUSE = ["query_id", "site", "version", "clause", "field"]  # a document is whole in one version
_DOCUMENT = [*_CLAUSE, "id"]
_PARTS = ("query_id", "site", "id", "clause", "field", "occur", "n_must", "n_should", "added", "flat")


def _saturated(tf: Column, bm25: Bm25) -> Column:
    norm = 1 - bm25.b + bm25.b * F.col("dl") / F.col("avgdl")
    return tf * (bm25.k1 + 1) / (tf + bm25.k1 * norm)


def term_matches(postings: DataFrame, lookups: DataFrame, bm25: Bm25, tombstones: DataFrame | None = None) -> DataFrame:
    """Postings of term and wildcard clauses, found in one scan; those of replaced documents are left out.

    A term's weight goes to ``added``.  A wildcard's goes to ``flat``: it is
    constant, however many terms match.  Positions are not read.
    """
    wanted = lookups.where(F.col("kind").isin("term", "prefix", "suffix", "contains"))
    weight = F.col("boost") * F.col("idf") * _saturated(F.col("tf").cast("double"), bm25)
    matched = postings.select(*_POSTING_KEY, "id", "tf", "dl").join(wanted.select(*_WANTED), _POSTING_KEY)
    return (
        without_replaced(matched, tombstones)
        .withColumn("added", weight)
        .withColumn("flat", F.when(F.col("idf").isNull(), F.col("boost")))
        .select(*_PARTS)
    )


def of_terms(postings: DataFrame, lookups: DataFrame) -> DataFrame:
    """The postings of the terms looked up.  A bucket has many other ones, which a join by document would shuffle too."""
    keys = lookups.where(F.col("kind").isin("term", "phrase")).select(*_POSTING_KEY).distinct()
    return postings.join(keys, _POSTING_KEY, "left_semi")


def rarest_required(lookups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of queries all of whose required clauses are in the vocabulary: the rarest one's lookups, and the other clauses'.

    A clause has at most as many documents as its terms have postings.  A query with a required clause that no term
    matches is in neither: nothing can answer it.
    """
    query = ["query_id", "site"]
    costs = lookups.where((F.col("kind") != "phrase") & (F.col("occur") == "must")).groupBy(*query, "clause", "n_must").agg(F.sum("df").alias("cost"))
    chosen = costs.groupBy(*query, "n_must").agg(
        F.count("*").alias("_found"), F.min_by("clause", F.struct("cost", "clause")).alias("_rarest")
    )
    chosen = chosen.where(F.col("_found") == F.col("n_must")).select(*query, "_rarest")
    both = lookups.join(chosen, query)
    first = F.col("clause") == F.col("_rarest")
    return both.where(first).drop("_rarest"), both.where(~first).drop("_rarest")


def candidate_postings(candidates: DataFrame, rest: DataFrame) -> DataFrame:
    """The key of each posting that may add to a candidate ``(query_id, site, id)``: candidates times terms, whatever their postings."""
    terms = rest.where(F.col("kind") == "term").select(*_WANTED)
    return candidates.join(terms, ["query_id", "site"]).select(*_WANTED, "id")


def candidate_matches(postings: DataFrame, needed: DataFrame, bm25: Bm25, tombstones: DataFrame | None = None) -> DataFrame:
    """The postings that are needed: each key meets at most one, so a common term costs no more than a rare one."""
    matched = postings.select(*_POSTING_KEY, "id", "tf", "dl").join(needed, [*_POSTING_KEY, "id"])
    weight = F.col("boost") * F.col("idf") * _saturated(F.col("tf").cast("double"), bm25)
    return without_replaced(matched, tombstones).withColumn("added", weight).withColumn("flat", F.lit(None).cast("double")).select(*_PARTS)


def phrase_lookups(lookups: DataFrame) -> DataFrame:
    """Lookups of phrases whose every token occurs in the field, numbered rarest first."""
    clause = Window.partitionBy(*_CLAUSE)
    return (
        lookups.where(F.col("kind") == "phrase")
        .withColumn("_found", F.count(F.lit(1)).over(clause))
        .withColumn("_nth", F.row_number().over(clause.orderBy("df", "offset")))
        .where(F.col("_found") == F.col("n_tokens"))
        .select(*_WANTED, "offset", "n_tokens", "_nth")
    )


def phrase_candidates(postings: DataFrame, wanted: DataFrame, tombstones: DataFrame | None = None) -> DataFrame:
    """The documents holding a phrase's rarest token."""
    rarest = wanted.where(F.col("_nth") == 1)
    matched = postings.select(*_POSTING_KEY, "id").join(rarest.select(*_POSTING_KEY, "query_id", "clause"), _POSTING_KEY)
    return without_replaced(matched, tombstones).select(*_DOCUMENT)


def phrase_postings(candidates: DataFrame, wanted: DataFrame) -> DataFrame:
    """The key of each posting a candidate must have: candidates times tokens, whatever the words."""
    return candidates.join(wanted, _CLAUSE).select(*_WANTED, "id", "offset", "n_tokens")


def phrase_matches(postings: DataFrame, needed: DataFrame, bm25: Bm25) -> DataFrame:
    """Candidates holding a phrase's tokens at consecutive positions of one field.

    A needed key meets at most one posting, so a common word costs no more
    than a rare one; the filter on it lets Spark prune the buckets read.
    A group is one document's field, so its arrays are bounded by its own
    text.  A phrase's start positions are what is left when every token's
    positions, moved back by its place in the phrase, are intersected.
    """
    gathered = (
        postings.select(*_POSTING_KEY, "id", "dl", "positions")
        .join(needed.where(F.col("offset") >= 0), [*_POSTING_KEY, "id"])
        .withColumn("starts", F.transform("positions", lambda p: p - F.col("offset")))
        .groupBy(*_DOCUMENT)
        .agg(
            F.collect_list("starts").alias("starts"),
            F.sum("idf").alias("idf"),
            *[F.first(c).alias(c) for c in ("occur", "n_must", "n_should", "n_tokens", "dl", "avgdl", "boost")],
        )
        .where(F.size("starts") == F.col("n_tokens"))
    )
    common = F.aggregate(
        F.slice("starts", F.lit(2), F.col("n_tokens")), F.col("starts")[0], F.array_intersect
    )
    weight = F.col("boost") * F.col("idf") * _saturated(F.col("tf").cast("double"), bm25)
    return (
        gathered.withColumn("tf", F.size(common))
        .where(F.col("tf") > 0)
        .withColumn("added", weight)
        .withColumn("flat", F.lit(None).cast("double"))
        .select(*_PARTS)
    )


def everything_else(asked: DataFrame, keywords: DataFrame) -> DataFrame:
    """All documents of the site, for queries that only say what must not occur."""
    negative = (
        asked.where((F.col("n_must") == 0) & (F.col("n_should") == 0))
        .select("query_id", "site", "version")
        .distinct()
    )
    none = F.lit(None)
    documents = keywords.join(negative, ["site", "version"], "left_semi").select("site", "version", "id").distinct()
    return (
        documents.join(negative, ["site", "version"])
        .select(
            "query_id", "site", "id", none.cast("int").alias("clause"), none.cast("string").alias("field"),
            F.lit("any").alias("occur"), F.lit(0).cast("bigint").alias("n_must"),
            F.lit(0).cast("bigint").alias("n_should"), none.cast("double").alias("added"),
            none.cast("double").alias("flat"),
        )
    )


def spread(parts: DataFrame, n_spread: int) -> DataFrame:
    """Split each query's documents ``n_spread`` ways, by document.

    This is the one shuffle of a search: the aggregates and the first top-k
    below all group by ``(query_id, slot)`` and more, so they stay in place,
    and a query with most of the hits is still shared by many tasks.
    """
    slot = F.pmod(F.xxhash64("id"), F.lit(n_spread).cast("bigint")).cast("int")
    return parts.withColumn("slot", slot).repartition("query_id", "slot")


def score_documents(parts: DataFrame) -> DataFrame:
    """``(query_id, slot, site, id, score)`` of the documents each query accepts.

    Tokens of a clause add up within a field; a clause counts its best field;
    a document sums its clauses.  It is accepted if it matches every must, no
    must_not and, where there is no must, at least one should.
    """
    query = ["query_id", "slot", "site", "id"]
    counts = ("n_must", "n_should")
    per_field = parts.groupBy(*query, "clause", "field", "occur").agg(
        (F.coalesce(F.sum("added"), F.lit(0.0)) + F.coalesce(F.max("flat"), F.lit(0.0))).alias("part"),
        *[F.max(c).alias(c) for c in counts],
    )
    per_clause = per_field.groupBy(*query, "clause", "occur").agg(
        F.max("part").alias("part"), *[F.max(c).alias(c) for c in counts]
    )

    def matched(occur):
        return F.count(F.when(F.col("occur") == occur, 1))

    scoring = F.col("occur").isin("must", "should")
    per_document = per_clause.groupBy(*query).agg(
        F.round(F.coalesce(F.sum(F.when(scoring, F.col("part"))), F.lit(0.0)), 6).alias("score"),
        matched("must").alias("_must"),
        matched("must_not").alias("_must_not"),
        matched("should").alias("_should"),
        *[F.max(c).alias(c) for c in counts],
    )
    accepted = (
        (F.col("_must_not") == 0)
        & (F.col("_must") == F.col("n_must"))
        & ((F.col("n_must") > 0) | (F.col("_should") > 0) | (F.col("n_should") == 0))
    )
    return per_document.where(accepted).select(*query, "score")


def top_k(scored: DataFrame, k: int | None) -> DataFrame:
    """``(query_id, site, id, score, rank)``: each query's best ``k``, ties by id, then site.

    First within each slot, where the rows already are, then over the at most
    ``slots * k`` rows left.  With ``k=None`` every hit is ranked.
    """
    if k is None:
        return _rank_all(scored)
    best = [F.desc("score"), F.asc("id"), F.asc("site")]
    in_slot = Window.partitionBy("query_id", "slot").orderBy(*best)
    scored = scored.withColumn("_nth", F.row_number().over(in_slot)).where(F.col("_nth") <= k)
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*best)))
    return ranked.where(F.col("rank") <= k).select("query_id", "site", "id", "score", "rank")


def _rank_all(scored: DataFrame) -> DataFrame:
    """Every hit with its rank, no query in one task.

    Hits are dealt in ranges of the final order and written with the range's
    number; a rank is the place in the range plus the query's hits in the ranges before.
    """
    best = [F.desc("score"), F.asc("id"), F.asc("site")]
    dealt = scored.select("query_id", "site", "id", "score").repartitionByRange("query_id", *best)
    dealt = written(dealt.withColumn("_part", F.spark_partition_id()), "hits")
    earlier = Window.partitionBy("query_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = dealt.groupBy("query_id", "_part").agg(F.count("*").alias("_n"))
    before = before.select("query_id", "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    nth = F.row_number().over(Window.partitionBy("query_id", "_part").orderBy(*best))
    return (
        dealt.withColumn("_nth", nth).join(before, ["query_id", "_part"])
        .select("query_id", "site", "id", "score", (F.col("_nth") + F.col("_before")).cast("int").alias("rank"))
    )
