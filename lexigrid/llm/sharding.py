"""Sharding by vector bin packing: bytes, words and rows of the shards are balanced jointly.

Rows with equal texts are a group.  A group with more than ``1 / items`` of all
bytes, words or rows is split into parts of about that size, each an item; all
other groups are gathered by hash into ``items`` bundles.  So there are at most
``7 * items`` items, whatever the corpus: a proven bound on all that reaches the
driver or is broadcast.  Items in descending order of their largest share are
placed one by one where the dot product of their vector with the shard's
residual capacity is highest.

The law is ``bytes``: sizes are near equal, and words and rows with them.  Slots
are gapless per shard: its items follow each other, and rows of an item are in
the order of text digest, ID and row hash, which one task sorts per item.

Null and empty texts have size 8 and are one group.  Null and repeated IDs are
allowed; rows alike in every column get slots of their own, but are one part.
Extra columns don't matter.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigrid.llm.common import SPACE, text_of, whole_row
from lexigrid.session import literal_table, written

SHARDS = 24
ITEMS = 4096
OVERHEAD = 8  # bytes of a row besides its text

_SIZES = ("bytes", "words", "rows")


def place(vectors: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each item; ``vectors`` has a row of bytes, words and rows for each."""
    total = vectors.sum(axis=0).astype(np.float64)
    share = vectors / np.where(total > 0, total / shards, 1.0)  # a shard's capacity is 1 in each dimension
    residual = np.where(total > 0, 1.0, 0.0)[None, :].repeat(shards, axis=0)
    found = np.zeros(len(vectors), dtype=np.int64)
    for i in np.lexsort((np.arange(len(vectors)), -share.max(axis=1))):
        best = int(np.argmax(residual @ share[i]))
        found[i] = best
        residual[best] -= share[i]
    return found


def row_hash(docs: DataFrame) -> Column:
    """A hash of all columns that have one; it tells rows that share an ID apart."""
    return F.xxhash64(*[F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind])


def _keys(docs: DataFrame, id: str, text: str) -> list[Column]:
    return [F.col(id).alias("id"), F.md5(text_of(text)).alias("digest"), row_hash(docs).alias("row_hash")]


class Plan:
    """Where each item of a corpus goes; holds at most ``7 * items`` rows."""

    def __init__(self, sizes: DataFrame, shards: int, items: int):
        """``sizes`` has ``id, digest, row_hash, bytes, words, rows`` and is read twice."""
        spark, self.items = sizes.sparkSession, items
        total = sizes.agg(*[F.sum(c).cast("double").alias(c) for c in _SIZES]).collect()[0]
        groups = sizes.groupBy("digest").agg(*[F.sum(c).alias(c) for c in _SIZES])
        share = F.greatest(*[F.col(c) / F.lit(total[c] or 1.0) for c in _SIZES])
        self.large = written(
            groups.where(share * items > 1).select(F.col("digest").alias("large"), F.ceil(share * items).cast("bigint").alias("parts")),
            "shard-large",
        )
        sums = self.named(sizes).groupBy("item").agg(*[F.sum(c).alias(c) for c in _SIZES]).orderBy("item").collect()
        where = place(np.array([[r[c] for c in _SIZES] for r in sums], dtype=np.float64).reshape(-1, 3), shards)
        rows, filled = [], [0] * shards
        for r, shard in zip(sums, where.tolist()):
            rows.append((r["item"], shard, filled[shard]))
            filled[shard] += r["rows"]
        self.placed = literal_table(spark, "item string, shard int, begin bigint", rows)

    def named(self, rows: DataFrame) -> DataFrame:
        """Rows with ``item``: a bundle, or a part of a large group."""
        part = F.pmod(F.xxhash64("id", "row_hash"), F.col("parts")).cast("string")
        bundle = F.pmod(F.xxhash64("digest"), F.lit(self.items)).cast("string")
        item = F.when(F.col("large").isNull(), bundle).otherwise(F.concat_ws(":", "large", part))
        joined = rows.join(F.broadcast(self.large), F.col("digest") == F.col("large"), "left")
        return joined.withColumn("item", item).drop("large", "parts")

    def slots(self, rows: DataFrame) -> DataFrame:
        """Rows with ``shard`` and ``slot``."""
        order = Window.partitionBy("item").orderBy("digest", "id", "row_hash")
        inside = self.named(rows).withColumn("inside", F.row_number().over(order) - 1)
        placed = inside.join(F.broadcast(self.placed), "item")
        return placed.withColumn("slot", F.col("begin") + F.col("inside")).drop("item", "begin", "inside")


def _sizes(docs: DataFrame, id: str, text: str) -> DataFrame:
    t = text_of(text)
    return written(docs.select(
        *_keys(docs, id, text),
        (F.octet_length(t) + OVERHEAD).cast("bigint").alias("bytes"),
        F.size(F.array_remove(F.split(t, SPACE), "")).cast("bigint").alias("words"),
        F.lit(1).cast("bigint").alias("rows"),
        F.crc32(t).alias("crc32"),
    ), "shard-sizes")


def assign(docs: DataFrame, id: str = "doc_id", text: str = "text", shards: int = SHARDS, items: int = ITEMS) -> DataFrame:
    """``id, bytes, words, crc32, digest, shard, slot`` per row."""
    sizes = _sizes(docs, id, text)
    return Plan(sizes, shards, items).slots(sizes).drop("rows", "row_hash")


def sharded(docs: DataFrame, id: str = "doc_id", text: str = "text", shards: int = SHARDS, items: int = ITEMS) -> DataFrame:
    """The rows with all their columns, ``shard`` and ``slot``; a column of such a name is replaced."""
    docs = docs.drop("shard", "slot")
    plan = Plan(_sizes(docs, id, text), shards, items)
    return plan.slots(docs.select(whole_row(docs), *_keys(docs, id, text))).select("row.*", "shard", "slot")
