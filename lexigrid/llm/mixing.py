"""Mixing sources to target weights by Sainte-Lague apportionment, in DataFrame functions only.

The mix is made of blocks of equal numbers of words, in ``shards`` equal parts.
A block has at most one in ``FINE`` words of the smallest source, however large the others are, and at least one;
a number of ``blocks`` can be given instead.
Part after part, blocks go to the sources with the highest quotients
``target / (2 k - 1)``; the method is house-monotone, so the quota of a part is
the difference of two apportionments.  A source is a ring of its documents in a
seeded order; its blocks are taken from a seeded start onwards.  Taken words of
a document are thus lengths of overlaps, computed in closed form.

The running sums of a source are made in 4,096 ranges of the seeded order, so
that a source with a third of all rows is never in one task.  Per source there
is one row; only those rows are sorted together.

Words are runs of anything but ASCII white space.  Null and empty texts have
size 0 and are never taken.  Null sources are one source, the last.  Ties in the
seeded order go by ID, then by size: rows that share both are alike, and each is
taken for its own share.  Null IDs are allowed.  Extra columns pass through.  An
empty table, or one without words, gives rows with target 0 and nothing taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigrid.llm.common import SPACE, text_of, whole_row
from lexigrid.session import written

BLOCKS = 1 << 18  # at least about so many blocks make the mix, of more than one word each
FINE = 1000  # blocks, at least, of a source of as many words; of fewer words, a block is a word
SHARDS = 8
MOST = 3  # times that a source, and so a document, is taken at most
SEED = 17
_RANGE_DIGITS = 3  # hex digits of the seeded order that make a range


def weights_by_rank(rank: Column) -> Column:
    """1, 2, 3, repeating, for rank 1, 2, ..."""
    return (rank - 1) % 3 + 1


def size_of(text: str = "text") -> Column:
    """The number of words."""
    return F.size(F.array_remove(F.split(text_of(text), SPACE), "")).cast("bigint")


def targets(sizes: DataFrame, most: int = MOST) -> DataFrame:
    """``source, source_size`` to ``source, source_size, rank, weight, total, target``.

    All of ``total`` is shared by weight; a source stops at ``most`` times its
    size and the others share the rest.  Sources in ascending order of
    ``size / weight`` stop first, so the stopped ones are a prefix of that order.
    """
    everything = Window.partitionBy()
    ranked = (
        sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
        .withColumn("weight", weights_by_rank(F.col("rank")).cast("bigint"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("stop", F.col("source_size") * most)
    )
    order = Window.orderBy(F.col("stop") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("total") - F.coalesce(F.sum("stop").over(before), F.lit(0))) / F.sum("weight").over(after)
    fits = ranked.withColumn("level", level).withColumn("fits", F.col("level") * F.col("weight") <= F.col("stop"))
    # the first source, in that order, which its level does not stop
    shared = F.min(F.when(F.col("fits"), F.struct(F.col("stop") / F.col("weight"), "rank", "level"))).over(everything)["level"]
    return fits.withColumn(
        "target", F.when(F.col("stop") < F.col("weight") * shared, F.col("stop").cast("double"))
        .otherwise(F.coalesce(F.col("weight") * shared, F.col("stop").cast("double")))
    ).select("source", "source_size", "rank", "weight", "total", "target")


def quotas(shared: DataFrame, blocks: int | None = None, shards: int = SHARDS, most: int = MOST) -> DataFrame:
    """``source, shard, quota, block_words``: how many blocks each part of the mix takes from each source.

    The number of seats up to a part is found without listing all quotients: with ``S`` sources and
    ``T`` seats, the multiplier at which ``round(target * x)`` adds up to ``T`` lies within
    ``(T -+ S / 2) / total``, so each source's seats lie between two known numbers (one seat wider for
    the rounding of doubles) and only the at most ``4 S`` quotients between them are ranked.
    """
    per_part = Window.partitionBy("shard")
    smallest = F.min(F.when(F.col("source_size") > 0, F.col("source_size"))).over(Window.partitionBy())
    finest = F.floor(smallest / FINE) if blocks is None else F.lit(None).cast("bigint")
    bounded = (
        shared.withColumn("block_words", F.greatest(F.lit(1), F.least(F.floor(F.col("total") / (blocks or BLOCKS)), finest)))
        .withColumn("n_sources", F.count("*").over(Window.partitionBy()))
        .withColumn("shard", F.explode(F.sequence(F.lit(1), F.lit(shards))))
        .withColumn("seats", F.floor(F.floor(F.col("total") / F.col("block_words")) * F.col("shard") / shards))
        .withColumn("low", F.greatest(F.lit(0), F.floor(F.col("target") * (F.col("seats") - F.col("n_sources") / 2 - 1) / F.nullif(F.col("total"), F.lit(0)) + 0.5)))
        .withColumn("high", F.floor(F.col("target") * (F.col("seats") + F.col("n_sources") / 2 + 1) / F.nullif(F.col("total"), F.lit(0)) + 0.5))
        .withColumn("open", F.col("seats") - F.sum("low").over(per_part))
    )
    place = Window.partitionBy("shard").orderBy(F.desc("quotient"), "rank", "seat")
    chosen = (
        bounded.where("high > low").withColumn("seat", F.explode(F.sequence(F.col("low") + 1, F.col("high"))))
        .withColumn("quotient", F.col("target") / (2 * F.col("seat") - 1))
        .withColumn("place", F.row_number().over(place)).where("place <= open")
        .groupBy("shard", "rank").agg(F.count("*").alias("more"))
    )
    # a source is never taken more than `most` times, whatever a quota rounds up to
    fullest = F.floor(F.col("source_size") * most / F.col("block_words"))
    upto = bounded.join(chosen, ["shard", "rank"], "left").withColumn(
        "upto", F.least(fullest, F.col("low") + F.coalesce("more", F.lit(0)))
    )
    previous = F.coalesce(F.lag("upto").over(Window.partitionBy("rank").orderBy("shard")), F.lit(0))
    return upto.withColumn("quota", (F.col("upto") - previous).cast("bigint")).select(
        "source", "source_size", "target", "rank", "shard", "quota", "block_words"
    )


def _in_order(docs: DataFrame, seed: int) -> DataFrame:
    """``source, id, size`` to those with ``start``: words before the row in its source's seeded order."""
    ordered = docs.withColumn("key", F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("id").cast("string"), F.lit("")))))
    ordered = ordered.withColumn("range", F.left("key", F.lit(_RANGE_DIGITS)))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ordered.groupBy("source", "range").agg(F.sum("size").alias("words"))
        .withColumn("offset", F.coalesce(F.sum("words").over(before), F.lit(0))).drop("words")
        .withColumnsRenamed({"source": "s", "range": "r"})
    )
    within = Window.partitionBy("source", "range").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = ordered.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    on = F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r"))
    return placed.join(offsets, on).withColumn("start", F.col("offset") + F.col("inside")).drop("key", "range", "s", "r", "offset", "inside")


def mix(docs: DataFrame, id: str = "doc_id", source: str = "source", text: str = "text",
        blocks: int | None = None, shards: int = SHARDS, most: int = MOST, seed: int = SEED) -> DataFrame:
    """``id, source, size, source_size, target, taken`` per row; ``taken`` counts repeats."""
    slim = written(docs.select(F.col(id).alias("id"), F.col(source).alias("source"), size_of(text).alias("size")), "mix-sizes")
    shared = targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), most)
    taken = quotas(shared, blocks, shards, most).groupBy("source", "source_size", "target", "block_words").agg(F.sum("quota").alias("quota"))
    # where a source's blocks begin, in its first round
    n_blocks = F.greatest(F.lit(1), F.floor(F.col("source_size") / F.col("block_words")))
    name = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce("source", F.lit(""))))
    begin = F.pmod(F.conv(F.left(name, F.lit(12)), 16, 10).cast("bigint"), n_blocks) * F.col("block_words")
    ring = taken.select(F.col("source").alias("ring"), "source_size", "target", begin.alias("begin"),
                        (F.col("quota") * F.col("block_words")).alias("words"))
    rows = _in_order(slim, seed).join(ring, F.col("source").eqNullSafe(F.col("ring")))

    def upto(position: Column, row_start: Column, row_size: Column) -> Column:
        """Words of a row in the first ``position`` words of its ring, rounds included."""
        rounds = F.floor(position / F.nullif(F.col("source_size"), F.lit(0)))
        rest = position - rounds * F.col("source_size")
        return rounds * row_size + F.greatest(F.lit(0), F.least(row_size, rest - row_start))

    size, start = F.col("size"), F.col("start")
    words = upto(F.col("begin") + F.col("words"), start, size) - upto(F.col("begin"), start, size)
    return rows.select(
        "id", "source", "size", "source_size", F.coalesce("target", F.lit(0.0)).alias("target"),
        F.when(size > 0, words).otherwise(0).cast("bigint").alias("taken"),
    )


def mixed(docs: DataFrame, id: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """The mix as whole documents with their own columns, as often as they are taken.

    Where a block's edge cuts a document, it goes in whole with the probability
    of its part that is taken, drawn by the seeded hash of its ID.
    """
    seed = options.get("seed", SEED)
    found = mix(docs, id, source, text, **options).where("taken > 0")
    share = F.col("taken") / F.col("size")
    draw = F.pmod(F.xxhash64(F.lit(seed + 1), F.col("id")), F.lit(1_000_003)) / 1_000_003
    copies = found.select(F.col("id").alias("id_"), F.col("source").alias("source_"), F.col("size").alias("size_"),
                          (F.floor(share) + F.when(draw < share - F.floor(share), 1).otherwise(0)).cast("int").alias("copies"))
    # rows that share ID, source and size stay together, each with its own share of their copies
    grouped = copies.groupBy("id_", "source_", "size_").agg(F.avg("copies").alias("copies")).where("copies > 0")
    rows = docs.select(whole_row(docs), F.col(id).alias("id"), F.col(source).alias("source"), size_of(text).alias("size"))
    same = F.col("id").eqNullSafe(F.col("id_")) & F.col("source").eqNullSafe(F.col("source_")) & (F.col("size") == F.col("size_"))
    joined = rows.join(grouped.hint("shuffle_hash"), same)
    times = F.ceil("copies").cast("int")
    return joined.withColumn("time", F.explode(F.sequence(F.lit(1), times))).select("row.*")
