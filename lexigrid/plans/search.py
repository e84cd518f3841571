"""A table of queries in, a table of hits out."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lexigrid.functions.names import attribute_field, map_attribute
from lexigrid.model import Analyzers, Bm25, Index, TermDefaults
from lexigrid.operators.clauses import build_clauses
from lexigrid.operators.lookups import (
    Needs,
    asked_terms,
    dictionary,
    exact_lookups,
    in_term_ranges,
    needs_metrics,
    wildcard_lookups,
    with_boosts,
)
from lexigrid.operators.matching import (
    candidate_matches,
    candidate_postings,
    everything_else,
    of_terms,
    phrase_candidates,
    phrase_lookups,
    phrase_matches,
    phrase_postings,
    rarest_required,
    score_documents,
    spread,
    term_matches,
    top_k,
)
from lexigrid.session import bounded, written

# postings of one term from which finding candidates first costs less than meeting all of them
CANDIDATES_FROM = 1_000_000


def search(
    index: Index,
    query_terms: DataFrame,
    scope: DataFrame | None = None,
    boosts: DataFrame | None = None,
    fields: DataFrame | None = None,
    options: DataFrame | None = None,
    defaults: TermDefaults = TermDefaults(),
    k: int | None = None,
    before_query: Callable[[DataFrame], DataFrame] | None = None,
    on_empty_scope: str = "all",
    analyzer: Analyzers | None = None,
    bm25: Bm25 = Bm25(),
    prefix: str = "",
    n_spread: int | None = None,
    candidates_from: int = CANDIDATES_FROM,
) -> DataFrame:
    """Answer every query of ``query_terms`` as ``(query_id, site, id, score, rank)``.

    A query over several sites is answered in each by its clauses for that site,
    and ranks their hits together.

    The small sides are resolved at once: the asked terms, then the indexed
    terms they match, then the postings that candidates of phrases need are
    written to the shared folder.  Their true sizes are then known when Spark plans the joins with
    postings: small ones are broadcast and prune the buckets read, large ones
    are shuffled.  The pass over postings itself runs when the result is used, or
    with ``k=None`` at once: all hits are written in their order before they are numbered.

    ``scope(query_id, id)``   the only documents a query may return; a query
                              without rows is unrestricted, or, with
                              ``on_empty_scope='none'``, returns nothing
    ``boosts(handle, boost)`` weights of fields in clauses that name no field
    ``fields``                custom-field definitions, to resolve handles
    ``options``, ``defaults`` flags for terms that leave them null
    ``before_query``          changes the clause table before it is matched
    ``analyzer``              another one than the sites' own
    ``k``                     hits kept per query; by default all
    ``n_spread``              tasks sharing one query's hits
                              (default: the session's shuffle partitions)
    ``candidates_from``       where a term asked for has as many postings, the documents of each query's rarest
                              required clause are found first, and only their postings of its other terms are
                              met: the same hits, at the cost of the rarest clause and two more jobs
    """
    if on_empty_scope not in ("all", "none"):
        raise ValueError("on_empty_scope is 'all' or 'none'")
    clauses = build_clauses(query_terms, fields, options, defaults, prefix)
    if before_query is not None:
        clauses = before_query(clauses)
    return search_clauses(
        index, clauses, scope, _boost_fields(boosts, fields, prefix), k, on_empty_scope,
        analyzer, bm25, n_spread, candidates_from,
    )


def search_clauses(
    index: Index,
    clauses: DataFrame,
    scope: DataFrame | None = None,
    field_boosts: DataFrame | None = None,
    k: int | None = None,
    on_empty_scope: str = "all",
    analyzer: Analyzers | None = None,
    bm25: Bm25 = Bm25(),
    n_spread: int | None = None,
    candidates_from: int = CANDIDATES_FROM,
) -> DataFrame:
    """The same for ready clauses, with boosts given per index field."""
    spark = clauses.sparkSession
    n_spread = n_spread or int(spark.conf.get("spark.sql.shuffle.partitions"))
    restrict = _restriction(scope, on_empty_scope)
    seen = Observation()
    asked = asked_terms(clauses, index.published, index.analyzers if analyzer is None else analyzer).observe(seen, *needs_metrics())
    asked = written(asked, "asked")
    needs = Needs(**seen.get)
    found = []
    if needs.exact or needs.phrase or not needs.wildcard:
        layered = None if index.tombstones is None else index.published
        found.append(exact_lookups(asked, index.term_stats, index.field_stats, layered))
    if needs.wildcard:
        ways = dictionary(index.term_stats) if index.dictionary is None else index.dictionary
        found.append(wildcard_lookups(asked, ways, needs.inner))
    common = Observation()
    lookups = with_boosts(_union(found), field_boosts).observe(common, F.coalesce(F.max("df"), F.lit(0)).alias("most"))
    lookups = written(lookups, "lookups")

    postings = in_term_ranges(index.postings, lookups)
    matches = []
    if needs.exact or needs.wildcard or not needs.phrase:
        if common.get["most"] < candidates_from:
            matches.append(restrict(term_matches(postings, lookups, bm25, index.tombstones)))
        else:
            matches += _by_candidates(postings, index.tombstones, lookups, bm25, restrict)
    if needs.phrase:
        wanted = phrase_lookups(lookups)
        candidates = restrict(phrase_candidates(postings, wanted, index.tombstones))
        needed = bounded(written(phrase_postings(candidates, wanted), "candidates"))
        matches.append(phrase_matches(of_terms(postings, lookups), needed, bm25))
    if needs.everything:
        matches.append(restrict(everything_else(asked, index.keywords)))
    return top_k(score_documents(spread(_union(matches), n_spread)), k)


def _by_candidates(
    postings: DataFrame, tombstones: DataFrame | None, lookups: DataFrame, bm25: Bm25, restrict: Callable[[DataFrame], DataFrame]
) -> list[DataFrame]:
    """Matches of terms and wildcards, for queries with required clauses only of documents that have the rarest one."""
    def every(rows: DataFrame) -> DataFrame:
        return restrict(term_matches(postings, rows, bm25, tombstones))

    first, rest = rarest_required(lookups)
    rarest = written(every(first), "rarest")
    candidates = written(rarest.select("query_id", "site", "id").distinct(), "required")
    needed = bounded(written(candidate_postings(candidates, rest), "needed"))
    exact = candidate_matches(of_terms(postings, lookups), needed, bm25, tombstones)
    wild = every(rest.where(F.col("kind") != "term")).join(bounded(candidates), ["query_id", "site", "id"], "left_semi").select(*rarest.columns)
    return [rarest, exact, wild, every(lookups.where(F.col("n_must") == 0))]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _restriction(scope: DataFrame | None, on_empty_scope: str) -> Callable[[DataFrame], DataFrame]:
    """A filter by scope, applied to matches before they are shuffled or scored.

    A small scope is broadcast into the scan's stage; a large one is joined by
    (query, document), a key no single query can make hot.
    """
    if scope is None:
        nothing = F.lit(on_empty_scope == "all")
        return (lambda rows: rows) if on_empty_scope == "all" else (lambda rows: rows.where(nothing))
    allowed = scope.select("query_id", "id").distinct()
    if on_empty_scope == "none":
        return lambda rows: rows.join(allowed, ["query_id", "id"], "left_semi")
    scoped = allowed.select("query_id").distinct().withColumn("_scoped", F.lit(True))
    inside = allowed.withColumn("_inside", F.lit(True))

    def restrict(rows: DataFrame) -> DataFrame:
        return (
            rows.join(scoped, "query_id", "left")
            .join(inside, ["query_id", "id"], "left")
            .where(F.col("_scoped").isNull() | F.col("_inside").isNotNull())
            .select(*rows.columns)
        )

    return restrict


def _boost_fields(boosts, fields, prefix):
    if boosts is None:
        return None
    if fields is None:
        return boosts.select(attribute_field("handle", prefix).alias("field"), "boost")
    return map_attribute(boosts, fields, "handle", "field", prefix).select("field", "boost")
