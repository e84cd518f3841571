"""Near copies by five-word shingles: pigeonhole blocks of the shingle set, verified exactly.

64 bits tell near copies of a similarity of 0.8 from others only at distances at which blocks of
them are too short to be keys.  Here the fingerprint is as wide as the shingle set: a bit per shingle,
of which a fraction is taken by hash so that 64 to 127 remain, whatever the length.  It is cut
into ``BLOCKS`` blocks by hash.  Two sets of similarity 0.8 differ in about a fifth of those bits, so
about half of their blocks are equal; each block is a join key of 64 bits.  Of pairs with all
shingles taken (texts of up to 127) the distance at that similarity is at most 28 bits, so the 32 blocks
must share one; of longer texts they do but for about one pair in millions.

A block that several texts share is not expanded into pairs at once.  Each of its texts first meets the one with the
most company in all its blocks (the original among its edited copies).  The links found make components, and of a
block's texts only those of different components are compared any more.

Where at most ``SMALL`` texts share a block these meet directly.  Larger blocks that still hold several components are taken
apart by what their texts can still differ in.  Of n shingles let u be in no other of these texts: they count
as differences to each of them.  A pair of similarity s differs in at most ``(n + m) * (1 - s) / (1 + s)`` shingles, so
without those u and v in at most ``free(n, u) + free(m, v)``, where ``free(n, u) = n * (1 - s) / (1 + s) - u``.  If that is below
zero the two can't be similar, and never meet: texts with many words of their own have no pairs among themselves.
Else the shared shingles, cut into twice as many blocks as the freer of both needs, have a block in common.
That text stands for the join, the other one looks for it, so the more two texts must agree in, the longer
are the runs of shingles that are compared.  In each block those outside its largest component
meet the others, in slices of a bounded number of texts.  No pair is left out, but for those already of one
class, and pairs all of whose equal blocks are empty ones (below one in millions).  Those that meet are compared by their whole
shingle sets, unless the sizes of both sets rule the similarity out, or their odd sketches, whose bits differ in no more
places than the sets have shingles of their own.

Null and empty texts have no shingles and no links.  Rows of equal text are one text here.  Columns other than
the text are not looked at; an empty table has no links.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrid.llm.common import text_of
from lexigrid.llm.components import stars
from lexigrid.session import written

WORDS = 5
SIMILARITY = 0.8
BLOCKS = 32
TAKEN = 64  # shingles, at least, of a set that has as many; below twice as many
ODD = 8  # longs of an odd sketch
SMALL = 16  # texts of a block that meet directly, at most
SLICE = 256  # texts of a block, about, that its other texts meet in one place

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers after which all bits depend on all."""
    x = (x ^ (x >> np.uint64(30))) * _MIX
    x = (x ^ (x >> np.uint64(27))) * _STEP
    return x ^ (x >> np.uint64(31))


def shingles(words: list[bytes], n: int = WORDS) -> np.ndarray:
    """The set of hashes of runs of ``n`` words, ascending; of fewer words, that of all of them."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    n = min(n, len(words))
    total = np.zeros(len(words) - n + 1, dtype=np.uint64)
    for i in range(n):
        total = _mixed(total * _STEP + hashed[i : len(words) - n + 1 + i])
    return np.unique(total)


def _level(n: int) -> int:
    """How often the set is halved."""
    return max(0, (n // TAKEN).bit_length() - 1)


def blocks(found: np.ndarray, similarity: float = SIMILARITY) -> np.ndarray:
    """The keys of a set's blocks, at each level at which a similar set may have its own."""
    keys = [np.zeros(0, dtype=np.uint64)]
    for level in {_level(len(found)), _level(int(similarity * len(found)))}:
        taken = found[found <= np.uint64((1 << (64 - level)) - 1)]
        block = (taken % np.uint64(BLOCKS)).astype(np.int64)
        sums = np.zeros(BLOCKS, dtype=np.uint64)
        np.add.at(sums, block, _mixed(taken + _STEP))
        keys.append(_mixed(sums[np.unique(block)] + np.uint64(level)))
    return np.concatenate(keys)


def odd_sketch(found: np.ndarray) -> np.ndarray:
    """``64 * ODD`` bits, each whether an odd number of the set's shingles hash to it."""
    bits = np.bincount((_mixed(found + _MIX) % np.uint64(64 * ODD)).astype(np.int64), minlength=64 * ODD) % 2
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def reachable(a: str, b: str, similarity: float) -> Column:
    """Whether the sizes and sketches of ``a`` and ``b``, structs of ``n, odd``, allow that similarity; false for no pair that has it."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    apart = sum(F.bit_count(F.col(f"{a}.odd")[i].bitwiseXOR(F.col(f"{b}.odd")[i])) for i in range(ODD))
    fits = F.least(n, m) + 1e-6 >= similarity * F.greatest(n, m)
    return fits & (apart * (1 + similarity) <= (n + m) * (1 - similarity) + 1e-6)


def sets_of(docs: DataFrame, text: str, wanted: DataFrame) -> DataFrame:
    """``text_hash, found``: the shingle sets of the texts whose hash is in ``wanted``."""

    def batch(texts: pd.Series) -> pd.Series:
        return pd.Series([shingles(t.encode().lower().split()).view(np.int64) for t in texts])

    t = text_of(text)
    rows = docs.select(F.xxhash64(t).alias("text_hash"), t.alias("text")).join(wanted, "text_hash", "left_semi")
    made = rows.select("text_hash", F.pandas_udf(batch, "array<bigint>")("text").alias("found"))
    return made.groupBy("text_hash").agg(F.first("found").alias("found"))


def shared_blocks(keyed: DataFrame) -> DataFrame:
    """``key, text_hash, crowd``: the blocks that several texts have, from ``text_hash, keys`` of each row."""
    members = written(keyed.select("text_hash", F.explode("keys").alias("key")).distinct(), "shingle-blocks")
    crowd = members.groupBy("key").agg(F.count("*").alias("crowd")).where("crowd > 1")
    return written(members.join(crowd, "key"), "shingle-shared")


def candidates(keyed: DataFrame) -> DataFrame:
    """``a < b``: pairs of text hashes that a block suggests first, from ``text_hash, keys`` of each row."""
    return _met(shared_blocks(keyed))


def _met(shared: DataFrame) -> DataFrame:
    company = shared.groupBy("text_hash").agg(F.sum("crowd").alias("company"))
    hubs = shared.join(company, "text_hash").groupBy("key").agg(F.max_by("text_hash", F.struct("company", "text_hash")).alias("other"))
    met = shared.join(hubs, "key").where("text_hash != other")
    return met.select(F.least("text_hash", "other").alias("a"), F.greatest("text_hash", "other").alias("b")).distinct()


def _verified(docs: DataFrame, pairs: DataFrame, text: str, similarity: float) -> DataFrame:
    """The pairs whose whole sets have that similarity."""
    wanted = pairs.select(F.col("a").alias("text_hash")).union(pairs.select("b")).distinct()
    sets = written(sets_of(docs, text, wanted), "shingle-sets")
    both = pairs.join(sets.withColumnsRenamed({"text_hash": "a", "found": "fa"}), "a").join(
        sets.withColumnsRenamed({"text_hash": "b", "found": "fb"}), "b"
    )
    common = F.size(F.array_intersect("fa", "fb"))
    return both.where(common >= F.lit(similarity) * (F.size("fa") + F.size("fb") - common)).select("a", "b")


def _placed(shared: DataFrame, star: DataFrame) -> DataFrame:
    """The members of blocks that hold several components, with their component ``part``.

    ``star`` has the smallest text ``a`` of the component of each text ``b`` that is linked to others.
    """
    of_text = star.select(F.col("b").alias("text_hash"), F.col("a").alias("root"))
    placed = shared.join(of_text, "text_hash", "left").select("key", "text_hash", "crowd", F.coalesce("root", "text_hash").alias("part"))
    several = placed.groupBy("key").agg(F.min("part").alias("x"), F.max("part").alias("y")).where("x != y").select("key")
    return placed.join(several, "key")


def _rung(x: float) -> int:
    return 1 << max(0, int(np.ceil(np.log2(x))))


def finer_blocks(found: np.ndarray, alone: np.ndarray, similarity: float = SIMILARITY) -> tuple[float, np.ndarray, np.ndarray]:
    """What a set may differ in, the keys of its finer blocks, and of each whether the set stands for it."""
    share = (1 - similarity) / (1 + similarity)
    free = len(found) * share - len(alone)
    rest = np.setdiff1d(found, alone, assume_unique=True)
    keys, home = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=bool)]
    # what a set looks for begins and ends beyond rounding of where another may stand
    level, last = _rung(4 * abs(free) + 2 - 1e-6), _rung(4 * share * len(found) / similarity + 2 + 1e-6)
    own = _rung(4 * max(free, 0) + 2 + 1e-7) if free >= -1e-7 else 0
    while level <= last:
        block = (_mixed(rest + _STEP) % np.uint64(level)).astype(np.int64)
        sums = np.zeros(level, dtype=np.uint64)
        np.add.at(sums, block, _mixed(rest + _MIX))
        keys.append(_mixed(sums[np.unique(block)] + np.uint64(level)))
        home.append(np.full(len(keys[-1]), level == own))
        level *= 2
    return free, np.concatenate(keys), np.concatenate(home)


def _finer(docs: DataFrame, text: str, placed: DataFrame, similarity: float) -> DataFrame:
    """``key, text_hash, part, home, free``: the finer blocks of these texts."""

    def batch(found: pd.Series, alone: pd.Series) -> pd.DataFrame:
        made = [finer_blocks(a.view(np.uint64), b.view(np.uint64), similarity) for a, b in zip(found, alone)]
        return pd.DataFrame({"free": [m[0] for m in made], "keys": [m[1].view(np.int64) for m in made], "home": [m[2] for m in made]})

    texts = written(placed.select("text_hash", "part").distinct(), "shingle-open")
    sets = written(sets_of(docs, text, texts), "shingle-open-sets")
    uses = sets.select("text_hash", F.explode("found").alias("shingle")).groupBy("shingle")
    once = uses.agg(F.count("*").alias("n"), F.first("text_hash").alias("text_hash")).where("n = 1")
    alone = once.groupBy("text_hash").agg(F.collect_list("shingle").alias("alone"))
    none = F.array().cast("array<bigint>")
    both = sets.join(alone, "text_hash", "left").withColumn("alone", F.coalesce("alone", none))
    made = both.select("text_hash", F.pandas_udf(batch, "free double, keys array<bigint>, home array<boolean>")("found", "alone").alias("m"))
    rows = made.select("text_hash", "m.free", F.explode(F.arrays_zip("m.keys", "m.home")).alias("k"))
    return rows.select(F.col("k.keys").alias("key"), "text_hash", F.col("k.home").alias("home"), "free").join(texts, "text_hash")


def across(placed: DataFrame, sketches: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``a < b``: the pairs of different components that share a block one of them stands for, and may be similar.

    ``placed`` has ``key, text_hash, part, home, free``.  The texts outside a block's largest component meet all its
    texts, the others those outside; a block of one component, or without a text that stands for it, costs nothing.
    """
    parts = placed.groupBy("key", "part").agg(F.count("*").alias("texts"), F.max("home").alias("home"))
    mixed = parts.groupBy("key").agg(
        F.max_by("part", F.struct("texts", "part")).alias("largest"), F.sum("texts").alias("crowd"), F.count("*").alias("n"), F.max("home").alias("any")
    ).where("n > 1 AND any").select("key", "largest", "crowd")
    held = placed.join(mixed, "key").join(sketches, "text_hash").select(
        "key", "text_hash", "part", "home", "free", "s", F.ceil(F.col("crowd") / SLICE).alias("slices"), (F.col("part") != F.col("largest")).alias("outside")
    )
    held = written(held, "shingle-held")
    sliced = held.withColumn("slice", F.pmod(F.xxhash64("text_hash"), "slices"))
    every_slice = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1))
    homes = held.where("home").withColumn("slice", every_slice)
    on = (F.col("x.key") == F.col("y.key")) & (F.col("x.slice") == F.col("y.slice")) & (F.col("x.part") != F.col("y.part"))
    on &= (F.col("x.free") + F.col("y.free") >= -1e-6) & reachable("x.s", "y.s", similarity)
    # two that stand for a block, both outside, meet twice otherwise
    once = ~(F.col("y.home") & F.col("y.outside")) | (F.col("x.text_hash") < F.col("y.text_hash"))
    met = [
        homes.where("outside").alias("x").join(sliced.alias("y"), on & once),
        homes.where("NOT outside").alias("x").join(sliced.where("outside AND NOT home").alias("y"), on),
    ]
    pairs = [m.select(F.least("x.text_hash", "y.text_hash").alias("a"), F.greatest("x.text_hash", "y.text_hash").alias("b")) for m in met]
    return pairs[0].union(pairs[1]).distinct()


def similar(docs: DataFrame, keyed: DataFrame, text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``a < b``: links between texts whose shingle sets have at least that Jaccard similarity.

    Of the pairs that share a block all that join two components are among them.
    ``keyed`` has ``text_hash, keys, n, odd`` of each row.
    """
    sketches = written(keyed.groupBy("text_hash").agg(F.first(F.struct("n", "odd")).alias("s")), "shingle-sketches")
    shared = shared_blocks(keyed)
    met = _met(shared).join(sketches.withColumnsRenamed({"text_hash": "a", "s": "sa"}), "a").join(
        sketches.withColumnsRenamed({"text_hash": "b", "s": "sb"}), "b"
    )
    pairs = written(met.where(reachable("sa", "sb", similarity)).select("a", "b"), "shingle-pairs")
    star = stars(_verified(docs, pairs, text, similarity))
    placed = written(_placed(shared, star), "shingle-placed")
    # in a small block each text stands for it, and nothing is known of what it has alone
    small = placed.where(F.col("crowd") <= SMALL).withColumns({"home": F.lit(True), "free": F.lit(float("inf"))})
    finer = written(_finer(docs, text, placed.where(F.col("crowd") > SMALL), similarity), "shingle-finer")
    columns = ["key", "text_hash", "part", "home", "free"]
    rest = across(small.select(*columns).union(finer.select(*columns)), sketches, similarity)
    rest = written(rest.join(pairs, ["a", "b"], "left_anti"), "shingle-rest")
    return written(star.union(_verified(docs, rest, text, similarity)), "shingle-links")
