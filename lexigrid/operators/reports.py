"""Reports over index versions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrid.functions.names import listed, version_name
from lexigrid.operators.upkeep import current


def version_stats(keywords: DataFrame) -> DataFrame:
    """Documents and bytes of text per version.

    A stored table has the ``bytes`` of each text beside it, so no text is read.
    Summing per document first keeps the distinct count of a site that holds
    most documents from gathering in one task.
    """
    size = F.col("bytes") if "bytes" in keywords.columns else F.octet_length("text").cast("bigint")
    per_doc = keywords.groupBy("site", "version", "id").agg(F.sum(size).alias("bytes"))
    return per_doc.groupBy("site", "version").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("bytes").alias("n_bytes")
    )


def index_stats(keywords: DataFrame, published: DataFrame) -> DataFrame:
    """Documents and bytes of what each site serves."""
    return version_stats(current(keywords, published))


def site_status(sites: DataFrame, keywords: DataFrame, published: DataFrame) -> DataFrame:
    """One row per known site; nulls where it serves no index."""
    return (
        sites.select("site")
        .join(index_stats(keywords, published), "site", "left")
        .select("site", "version", "n_docs", "n_bytes")
    )


def list_versions(
    keywords: DataFrame,
    published: DataFrame,
    index_name: str,
    show_all: bool = False,
    starting_with: str | None = None,
) -> DataFrame:
    """Every version with its size, and whether no pointer names it.

    Hidden names (a leading dot) are left out, and so, unless ``show_all``, are
    those not ``starting_with`` the given text (default: the index name).

    The orphan flag is null in the ``show_all`` listing, which may hold
    versions that are not ours.
    """
    pointers = published.select("site", "version", F.lit(True).alias("_served"))
    rows = version_stats(keywords).join(pointers, ["site", "version"], "left")
    named = rows.withColumn("name", version_name(index_name, "site", "version"))
    orphaned = F.lit(None).cast("boolean") if show_all else F.col("_served").isNull()
    wanted = index_name if starting_with is None else starting_with
    return named.where(listed(F.col("name"), wanted, show_all)).select(
        "name", "site", "version", "n_docs", "n_bytes", orphaned.alias("orphaned")
    )
