"""Names: index fields, handles and index versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrid.model import ATTRIBUTE_PREFIX, FIELD_PREFIX

# What stands for a field without a handle.
NO_SUCH_ID = "field not found for ID "
NO_SUCH_FIELD = "Unknown field "


def attribute_field(attribute: Column | str, prefix: str = "") -> Column:
    """Index field of a built-in attribute."""
    name = F.col(attribute) if isinstance(attribute, str) else attribute
    return F.concat(F.lit(prefix + ATTRIBUTE_PREFIX), name)


def custom_field(field_id: Column | str, prefix: str = "") -> Column:
    """Index field of a custom field."""
    number = F.col(field_id) if isinstance(field_id, str) else field_id
    return F.concat(F.lit(prefix + FIELD_PREFIX), number.cast("string"))


def _one_per(fields: DataFrame, key: str, value: str, how) -> DataFrame:
    # a dimension with a repeated key must not multiply the rows it is joined to
    return fields.groupBy(F.col(key).alias("_key")).agg(how(value).alias("_value"))


def map_attribute(
    rows: DataFrame, fields: DataFrame, attribute: str, out: str, prefix: str = ""
) -> DataFrame:
    """Add ``out``: the index field an attribute or custom-field handle names.

    A null attribute (no field named) stays null.
    """
    found = _one_per(fields, "handle", "field_id", F.min)
    return (
        rows.join(found, F.col(attribute) == F.col("_key"), "left")
        .withColumn(
            out,
            F.coalesce(custom_field("_value", prefix), attribute_field(attribute, prefix)),
        )
        .drop("_key", "_value")
    )


def map_field(
    rows: DataFrame, fields: DataFrame, field: str, out: str, prefix: str = ""
) -> DataFrame:
    """Add ``out``: the attribute or handle an index field name stands for."""
    as_attribute = prefix + ATTRIBUTE_PREFIX
    as_custom = prefix + FIELD_PREFIX
    name = F.col(field)
    number = F.coalesce(
        F.regexp_extract(F.substr(name, F.lit(len(as_custom) + 1)), r"^\s*(\d+)", 1)
        .try_cast("bigint"),
        F.lit(0),
    )
    found = _one_per(fields, "field_id", "handle", F.min)
    numbered = rows.withColumn("_number", F.when(name.startswith(as_custom), number))
    return (
        numbered.join(found, F.col("_number") == F.col("_key"), "left")
        .withColumn(
            out,
            F.when(
                name.startswith(as_attribute),
                F.substr(name, F.lit(len(as_attribute) + 1)),
            )
            .when(
                name.startswith(as_custom),
                F.coalesce(
                    F.col("_value"),
                    F.concat(F.lit(NO_SUCH_ID), F.col("_number").cast("string")),
                ),
            )
            .otherwise(F.concat(F.lit(NO_SUCH_FIELD), name)),
        )
        .drop("_key", "_value", "_number")
    )


def alias_name(index_name: str, site: Column | str) -> Column:
    """Stable name of a site's index."""
    handle = F.col(site) if isinstance(site, str) else site
    return F.lower(F.concat_ws("_", F.lit(index_name), handle))


def version_name(index_name: str, site: Column | str, version: Column | str) -> Column:
    """Name of one version of a site's index."""
    number = F.col(version) if isinstance(version, str) else version
    return F.concat_ws("_", alias_name(index_name, site), number.cast("string"))


def listed(name: Column, index_name: str, show_all: bool = False) -> Column:
    """Whether a listing shows ``name``: never hidden ones, and only our own unless asked."""
    shown = ~name.startswith(".")
    return shown if show_all else shown & name.startswith(index_name.lower())
