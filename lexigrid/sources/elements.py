"""Scans of the element table and the worklists made from them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALL_SITES = "*"


def select_site(rows: DataFrame, site: str | None, sites: DataFrame | None = None) -> DataFrame:
    """Rows of one site; ``None`` or ``'*'`` means every site.

    With the ``sites`` dimension given, an unknown site is an error.
    """
    if site is None or site == ALL_SITES:
        return rows
    if sites is not None and sites.where(F.col("site") == site).isEmpty():
        raise ValueError(f"unknown site {site!r}")
    return rows.where(F.col("site") == site)


def eligible_types(types: DataFrame) -> DataFrame:
    """Types worth indexing: those with titles or at least one searchable attribute."""
    return types.where(F.col("has_titles") | (F.size("attributes") > 0))


def type_counts(elements: DataFrame, types: DataFrame) -> DataFrame:
    """Number of elements of each eligible type."""
    return (
        elements.join(eligible_types(types).select("type"), "type", "left_semi")
        .groupBy("type")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def full_worklist(
    elements: DataFrame, types: Sequence[str] | None = None, newest_first: bool = False
) -> DataFrame:
    """``(id, type)`` of all elements, or of the chosen types.

    The order matters only to somebody reading the list, so the sort is opt-in.
    """
    rows = elements if types is None else elements.where(F.col("type").isin(list(types)))
    if newest_first:
        rows = rows.orderBy(F.desc("date_created"), "id")
    return rows.select("id", "type")


def updated_since(elements: DataFrame, start: datetime | str) -> DataFrame:
    """``(id, type)`` of everything updated at or after ``start``, drafts included."""
    return elements.where(F.col("date_updated") >= _moment(start)).select("id", "type")


def _moment(value: datetime | str) -> Column:
    """A point in time; anything else is an error, not an empty worklist."""
    moment = value if isinstance(value, datetime) else datetime.fromisoformat(value)
    return F.lit(moment).cast("timestamp") if value is moment else F.lit(value).cast("timestamp")


def hydrate(elements: DataFrame, worklist: DataFrame, site: str | None = ALL_SITES) -> DataFrame:
    """The elements a worklist names, in one site or in all."""
    return select_site(elements, site).join(worklist.select("type", "id"), ["type", "id"], "left_semi")


def live_ids(elements: DataFrame) -> DataFrame:
    """Every element ID, over all sites.  May repeat: its users only test membership."""
    return elements.select("id")


def catch_up(
    elements: DataFrame, last_switch: datetime | str, site: str | None = ALL_SITES
) -> DataFrame:
    """Elements to index again after a time in which only the other index was kept."""
    changed = elements.where(F.col("date_updated") >= _moment(last_switch))
    return select_site(changed, site)


def without_drafts(elements: DataFrame) -> DataFrame:
    """What the live (streaming) path indexes; the batch scans above keep drafts."""
    return elements.where(~F.coalesce(F.col("is_draft"), F.lit(False)))


Extractor = Column | Callable[[DataFrame], Column]
