"""What several operators share: word patterns and rows that extra columns can't disturb."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words are runs of anything but ASCII white space.
SPACE = r"[\x20\x09-\x0D]+"


def text_of(column: str = "text") -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text as an array."""
    return F.array_remove(F.split(text, SPACE), "")


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct ``row``; helpers beside it can't clash with extra columns."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def without(docs: DataFrame, removed: DataFrame, id: str, text: str) -> DataFrame:
    """The rows whose ``(id, text_hash)`` is not in ``removed``; nulls equal nulls.

    ``removed`` is the side that is hashed, so the texts are not sorted.
    """
    keyed = docs.select(whole_row(docs), F.col(id).alias("id"), F.xxhash64(text_of(text)).alias("text_hash"))
    removed = removed.select(F.col("id").alias("id_"), F.col("text_hash").alias("text_hash_")).distinct()
    same = F.col("id").eqNullSafe(F.col("id_")) & (F.col("text_hash") == F.col("text_hash_"))
    return keyed.join(removed.hint("shuffle_hash"), same, "left_anti").select("row.*")


def sampled(texts: DataFrame, most: int) -> list[str]:
    """Of the one column of texts the ``most`` distinct ones with the smallest hashes, sorted: the same ones in any order of rows.

    Only hashes are ordered; the texts chosen come to the driver whole.
    """
    hashed = texts.toDF("text").select("text", F.xxhash64("text").alias("hash"))
    smallest = [r["hash"] for r in hashed.select("hash").distinct().orderBy("hash").limit(most).collect()]
    if not smallest:
        return []
    return sorted(r["text"] for r in hashed.where(F.col("hash") <= smallest[-1]).select("text").distinct().collect())
