"""Clauses to lookups: which indexed terms, in which fields, a clause asks for.

Everything here works on the vocabulary (``term_stats`` and ``dictionary``), never on postings.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexigrid.functions.analysis import STANDARD, by_site, site_tokens, stop_lists
from lexigrid.model import Analyzers
from lexigrid.operators.postings import term_bucket
from lexigrid.session import literal_table, written

_WILDCARDS = ("prefix", "suffix", "contains")
_GRAM = 3  # characters of a pattern that are joined; the rest is verified
_RANGES = 16  # into which the patterns of a search are dealt


@dataclass(frozen=True)
class Needs:
    """Which kinds of matching a clause table asks for."""

    exact: bool
    wildcard: bool
    inner: bool
    phrase: bool
    everything: bool


def asked_terms(clauses: DataFrame, published: DataFrame, analyzer: Analyzers = STANDARD) -> DataFrame:
    """One row per token of each term or phrase clause, and per wildcard pattern.

    Clauses with nothing to match, or but stop words of their site, are dropped, and the rest numbered (``clause``)
    and counted (``n_must``, ``n_should``) per query and site.  ``version`` and ``bucket`` say where to look;
    a query whose site serves no index disappears.
    """
    is_wild = F.col("kind").isin(*_WILDCARDS)
    pattern = by_site(analyzer, F.col("site"), lambda a: F.lower("text") if a.lowercase else F.col("text"))
    per_query = Window.partitionBy("query_id", "site")
    in_order = per_query.orderBy("ord", "occur", "kind", "field", "text")

    def count(occur):
        return F.count(F.when(F.col("occur") == occur, 1)).over(per_query)

    pieces = F.when(is_wild, F.filter(F.array(pattern), lambda t: t != "")).otherwise(
        site_tokens("text", analyzer)
    )
    pieces = F.transform(pieces, lambda t, at: F.struct(at.alias("offset"), t.alias("term")))
    stops = stop_lists(analyzer)
    if stops:
        rows = literal_table(clauses.sparkSession, "site string, _stops array<string>", [(s, w) for s, w in stops.items() if s is not None])
        clauses = clauses.join(rows, "site", "left")
        listed = F.coalesce("_stops", F.array(*map(F.lit, stops.get(None, []))).cast("array<string>"))
        pieces = F.when(is_wild, pieces).otherwise(F.filter(pieces, lambda p: ~F.array_contains(listed, p["term"])))
    bucket = term_bucket("term", F.col("n_buckets"))
    return (
        clauses.withColumn("_pieces", pieces)
        .where(F.size("_pieces") > 0)
        .withColumn("n_tokens", F.size("_pieces"))
        .withColumn("clause", F.row_number().over(in_order))
        .withColumn("n_must", count("must"))
        .withColumn("n_should", count("should"))
        .join(published, "site")
        .select(
            "query_id", "site", "version", "n_buckets", "clause", "occur", "kind",
            F.col("field").alias("only_field"), "n_tokens", "n_must", "n_should",
            F.explode("_pieces").alias("_piece"),
        )
        .select("*", "_piece.*")
        .withColumn("bucket", F.when(~is_wild, bucket))
        .drop("n_buckets", "_piece")
    )


def needs_metrics() -> list[Column]:
    """Aggregates over asked terms from which ``Needs`` is read; observed while they are written."""

    def some(condition):
        return F.coalesce(F.max(condition), F.lit(False))

    kind = F.col("kind")
    return [
        some(kind == "term").alias("exact"),
        some(kind.isin(*_WILDCARDS)).alias("wildcard"),
        some(_is_inner(F.col("term"))).alias("inner"),
        some(kind == "phrase").alias("phrase"),
        some((F.col("n_must") == 0) & (F.col("n_should") == 0)).alias("everything"),
    ]


def _in_field() -> Column:
    only = F.col("only_field")
    return only.isNull() | (only == F.col("field"))


def exact_lookups(
    asked: DataFrame, term_stats: DataFrame, field_stats: DataFrame, layered: DataFrame | None = None
) -> DataFrame:
    """Per token of a term or phrase clause and field holding it: ``idf`` and ``avgdl``.

    With layers, of which ``layered(site, version)`` has all that are served, the statistics of a site are the
    sums over its versions; a token then has a row per version that lists it.
    """
    if layered is not None:
        served = field_stats.join(layered.select("site", "version"), ["site", "version"], "left_semi")
        field_stats = served.groupBy("site", "field").agg(F.sum("n_docs").alias("n_docs"), F.sum("sum_dl").alias("sum_dl")).where("n_docs > 0")
    where = ["site", "version", "field"] if layered is None else ["site", "field"]
    n, df = F.col("n_docs").cast("double"), F.col("df").cast("double")
    found = term_stats.join(
        asked.where(F.col("kind").isin("term", "phrase")), ["site", "version", "bucket", "term"]
    ).where(_in_field())
    if layered is not None:
        token = Window.partitionBy("query_id", "site", "clause", "offset", "field")
        found = found.withColumn("df", F.sum("df").over(token)).where("df > 0")
    return (
        found.join(field_stats, where)
        .withColumn("idf", F.log(1 + (n - df + 0.5) / (df + 0.5)))
        .withColumn("avgdl", F.col("sum_dl") / F.col("n_docs"))
        .drop("n_docs", "sum_dl")
    )


def dictionary(term_stats: DataFrame) -> DataFrame:
    """The vocabulary by what patterns ask for: one row per way ``(kind, key)`` to a term.

    ``prefix`` is the term itself, ``suffix`` the term reversed, ``contains`` what begins at each of its
    characters, up to three of them.  Every pattern is then a range of keys.
    """
    term = F.col("term")
    ways = F.concat(
        F.array(_way("prefix", term), _way("suffix", F.reverse(term))),
        F.transform(_runs(term), lambda g: _way("contains", g)),
    )
    return term_stats.select(*[c for c in term_stats.columns if c not in ("kind", "key")], F.inline(ways))


def _runs(text: Column) -> Column:
    """What begins at each character of a text that is not empty, up to ``_GRAM`` of them."""
    each = F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.substr(text, i, F.lit(_GRAM)))
    return F.array_distinct(F.when(F.length(text) > 0, each).otherwise(F.array().cast("array<string>")))


def _way(kind: str, key: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), key.alias("key"))


def wildcard_lookups(asked: DataFrame, ways: DataFrame, inner: bool = True) -> DataFrame:
    """The vocabulary terms each wildcard clause matches, per field; ``ways`` is the ``dictionary``.

    A prefix or suffix is one range of keys, and so is a short pattern inside a term.  Of a longer one the run of three
    characters that fewest terms have is looked up, and those terms are compared with the whole pattern.  What is read
    are the ranges of the patterns, by filters on ``key`` that a scan in its order can use; the vocabulary is not passed over.
    ``inner`` says whether any pattern is longer and looked for inside terms.
    """
    patterns = asked.where(F.col("kind").isin(*_WILDCARDS)).withColumnRenamed("term", "pattern").drop("bucket")
    pattern, term, key = F.col("pattern"), F.col("term"), F.col("key")
    contains = F.col("kind") == "contains"
    probes = patterns.where(~_is_inner(pattern)).withColumn(
        "probe", F.when(F.col("kind") == "suffix", F.reverse("pattern")).otherwise(pattern)
    )
    if inner:
        probes = written(probes.unionByName(_rarest_runs(patterns.where(_is_inner(pattern)), ways)), "probes")
    # an equi-join on the first characters, then a comparison: no nested loop
    leads = F.array_distinct(F.array(*[F.left(key, F.lit(n)) for n in range(1, _GRAM + 1)]))
    near = _in_ranges(ways, probes).withColumn("lead", F.explode(leads))
    first = probes.withColumn("lead", F.left("probe", F.lit(_GRAM)))
    # of several ways from a short pattern to a term the first counts
    only = key == F.array_min(F.filter(_runs(term), lambda g: g.startswith(F.col("probe"))))
    matches = key.startswith(F.col("probe")) & (~contains | (term.contains(pattern) & only))
    no = F.lit(None).cast("double")
    return (
        near.join(first, ["site", "version", "kind", "lead"])
        .where(_in_field() & matches)
        .drop("lead", "key", "probe", "pattern")
        .withColumn("idf", no)
        .withColumn("avgdl", no)
    )


def _is_inner(pattern: Column) -> Column:
    return (F.col("kind") == "contains") & (F.length(pattern) > _GRAM)


def _rarest_runs(patterns: DataFrame, ways: DataFrame) -> DataFrame:
    """Each pattern with ``probe``, the run of three of its characters that fewest terms have; without one, it is left out."""
    runs = F.filter(_runs(F.col("pattern")), lambda g: F.length(g) == _GRAM)
    grams = patterns.withColumn("probe", F.explode(runs))
    place = ["site", "version", "probe"]
    listed = _in_ranges(ways, grams).select("site", "version", F.col("key").alias("probe"))
    counts = listed.join(grams.select(*place).distinct(), place, "left_semi").groupBy(*place).agg(F.count("*").alias("_n"))
    return grams.join(counts, place).groupBy(*patterns.columns).agg(F.min_by("probe", F.struct("_n", "probe")).alias("probe"))


def _in_ranges(ways: DataFrame, probes: DataFrame) -> DataFrame:
    """The rows of the dictionary between neighbouring probes: at most ``_RANGES`` ranges, however many probes there are.

    Their ends come to the driver, as literals that a scan is given.  Keys hold no U+10FFFF, which is no character.
    """
    dealt = probes.select("kind", "probe").distinct().repartitionByRange(_RANGES, "kind", "probe")
    ends = dealt.groupBy(F.spark_partition_id().alias("part"), "kind").agg(
        F.min("probe").alias("low"), F.max(F.concat("probe", F.lit(chr(0x10FFFF)))).alias("high")
    )
    by_kind: dict[str, list[Column]] = {}
    for r in ends.collect():
        by_kind.setdefault(r["kind"], []).append((F.col("key") >= r["low"]) & (F.col("key") <= r["high"]))
    parts = [ways.where((F.col("kind") == kind) & reduce(Column.__or__, ranges)) for kind, ranges in sorted(by_kind.items())]
    return reduce(DataFrame.unionByName, parts) if parts else ways.where(F.lit(False))


def in_term_ranges(postings: DataFrame, lookups: DataFrame) -> DataFrame:
    """The postings whose term lies between neighbouring terms of the lookups: at most ``_RANGES`` ranges, however many terms.

    Their ends come to the driver, as literals: in files in order of their terms a scan passes over the pages between them.
    """
    dealt = lookups.select("term").distinct().repartitionByRange(_RANGES, "term")
    ends = dealt.groupBy(F.spark_partition_id().alias("part")).agg(F.min("term").alias("low"), F.max("term").alias("high"))
    ranges = [(F.col("term") >= r["low"]) & (F.col("term") <= r["high"]) for r in ends.collect()]
    return postings.where(reduce(Column.__or__, ranges)) if ranges else postings.where(F.lit(False))


def with_boosts(lookups: DataFrame, boosts: DataFrame | None) -> DataFrame:
    """Add ``boost``; ``boosts(field, boost)`` applies to clauses naming no field."""
    if boosts is None:
        return lookups.withColumn("boost", F.lit(1.0))
    factor = boosts.groupBy("field").agg(F.max("boost").cast("double").alias("_boost"))
    return (
        lookups.join(factor, "field", "left")
        .withColumn(
            "boost", F.when(F.col("only_field").isNull(), F.coalesce("_boost", F.lit(1.0))).otherwise(1.0)
        )
        .drop("_boost")
    )
