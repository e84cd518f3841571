"""Elements to long keyword rows, and the list of index fields."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrid.functions.names import attribute_field, custom_field
from lexigrid.model import ATTRIBUTE_PREFIX, FIELD_PREFIX, PREDEFINED_ATTRIBUTES
from lexigrid.session import literal_table
from lexigrid.sources.elements import Extractor


def build_keywords(
    elements: DataFrame,
    attributes: Sequence[str] = (),
    custom_fields: Mapping[str, int] | None = None,
    types: DataFrame | None = None,
    fields: DataFrame | None = None,
    layouts: DataFrame | None = None,
    extractors: Mapping[str, Extractor] | None = None,
    prefix: str = "",
    keep: Sequence[str] = ("site", "id"),
) -> DataFrame:
    """Turn each element into one ``(site, id, field, text)`` row per searchable field.

    ``attributes``     attribute names; text comes from the column of that name
    ``custom_fields``  custom-field handle -> field id; column named by the handle
    ``types``          (type, has_titles, attributes): limits each type to its own
                       attributes, plus ``slug``, plus ``title`` where it has titles
    ``fields``         (field_id, handle, searchable): keeps searchable fields only
    ``layouts``        (type, handle): the custom fields each type carries
    ``extractors``     attribute or handle -> Column, or function of the elements
                       giving one, where the text is not simply a column

    One map-only pass: columns become rows by ``unpivot``, and what does not
    apply is removed by joins with small dimensions.  Empty text is kept.
    """
    extractors = extractors or {}
    custom_fields = custom_fields or {}

    def text_of(name):
        made = extractors.get(name)
        if made is None:
            made = F.col(name)
        elif callable(made):
            made = made(elements)
        return F.coalesce(made.cast("string"), F.lit(""))

    outputs = {f"{ATTRIBUTE_PREFIX}{name}": name for name in attributes}
    outputs |= {f"{FIELD_PREFIX}{number}": handle for handle, number in custom_fields.items()}
    if not outputs:
        raise ValueError("name at least one attribute or custom field")

    typed = types is not None or layouts is not None
    key = [*keep, "type"] if typed and "type" not in keep else list(keep)
    wide = elements.select(*key, *[text_of(src).alias(out) for out, src in outputs.items()])
    long = wide.unpivot(key, list(outputs), "field", "text")

    if typed:
        applies = []
        if types is not None:
            own = types.select("type", F.explode("attributes").alias("attribute"))
            slug = types.select("type", F.lit("slug").alias("attribute"))
            title = types.where("has_titles").select("type", F.lit("title").alias("attribute"))
            named = own.unionByName(slug).unionByName(title)
            applies.append(named.select("type", attribute_field("attribute").alias("field")))
        if layouts is not None:
            numbers = literal_table(
                elements.sparkSession,
                "handle string, field string",
                [(handle, f"{FIELD_PREFIX}{number}") for handle, number in custom_fields.items()],
            )
            applies.append(layouts.join(numbers, "handle").select("type", "field"))
        listed = reduce(DataFrame.unionByName, applies).distinct().withColumn("_applies", F.lit(True))
        is_custom = F.col("field").startswith(FIELD_PREFIX)
        unlimited = is_custom if layouts is None else ~is_custom if types is None else F.lit(False)
        long = long.join(listed, ["type", "field"], "left").where(F.col("_applies") | unlimited)
    if fields is not None:
        hidden = fields.where(~F.col("searchable")).select(custom_field("field_id").alias("field"))
        long = long.join(hidden, "field", "left_anti")
    return long.select(*keep, F.concat(F.lit(prefix), "field").alias("field"), "text")


def build_mapping(types: DataFrame, fields: DataFrame, prefix: str = "") -> DataFrame:
    """``(field)``: every index field the current types and field definitions call for."""
    fixed = literal_table(types.sparkSession, "name string", [(n,) for n in PREDEFINED_ATTRIBUTES])
    predefined = fixed.select(attribute_field("name", prefix).alias("field"))
    attributes = types.select(F.explode("attributes").alias("name")).select(
        attribute_field("name", prefix).alias("field")
    )
    custom = fields.where("searchable").select(custom_field("field_id", prefix).alias("field"))
    return predefined.unionByName(attributes).unionByName(custom).distinct()


def mapping_diff(current: DataFrame, expected: DataFrame) -> DataFrame:
    """``(field, change)``: fields to be ``added`` to or ``removed`` from the current index."""
    have = current.select("field").distinct().withColumn("_have", F.lit(True))
    want = expected.select("field").distinct().withColumn("_want", F.lit(True))
    return (
        have.join(want, "field", "full_outer")
        .where(F.col("_have").isNull() | F.col("_want").isNull())
        .select("field", F.when(F.col("_have").isNull(), "added").otherwise("removed").alias("change"))
    )
