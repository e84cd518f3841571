"""Query terms to clauses.

A clause says what must, must not or should occur, how it is matched
(``term``, ``phrase``, ``prefix``, ``suffix``, ``contains``) and in which field
(null: in any).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrid.functions.names import attribute_field, map_attribute
from lexigrid.model import TermDefaults


def build_clauses(
    query_terms: DataFrame,
    fields: DataFrame | None = None,
    options: DataFrame | None = None,
    defaults: TermDefaults = TermDefaults(),
    prefix: str = "",
) -> DataFrame:
    """``(query_id, site, ord, occur, kind, field, text)``, one row per clause.

    A flag missing on a term comes from the query's ``options`` row, else from
    ``defaults``.  Term groups carry no meaning and give no clause.  A term
    with a hyphen is a pasted slug and becomes a phrase.  Phrases are optional:
    neither ``exclude`` nor the wildcard flags change them.
    """
    rows = query_terms.where(~F.coalesce(F.col("is_group"), F.lit(False)))
    if options is None:
        option = dict.fromkeys(("exclude", "sub_left", "sub_right"), F.lit(None).cast("boolean"))
    else:
        own = options.groupBy("query_id").agg(
            *[F.first(n, ignorenulls=True).alias(f"_{n}") for n in ("exclude", "sub_left", "sub_right")]
        )
        rows = rows.join(own, "query_id", "left")
        option = {n: F.col(f"_{n}") for n in ("exclude", "sub_left", "sub_right")}

    def flag(name):
        return F.coalesce(F.col(name), option[name], F.lit(getattr(defaults, name)))

    phrase = F.coalesce(F.col("phrase"), F.lit(False)) | F.col("term").contains("-")
    rows = rows.select(
        "query_id", "site", "ord", F.trim("term", F.lit(" \t\n\r\0\x0b")).alias("text"),
        F.when(F.col("attribute") != "", F.col("attribute")).alias("attribute"),
        F.when(phrase, "should").when(flag("exclude"), "must_not").otherwise("must").alias("occur"),
        F.when(phrase, "phrase")
        .when(flag("sub_left") & flag("sub_right"), "contains")
        .when(flag("sub_left"), "suffix")
        .when(flag("sub_right"), "prefix")
        .otherwise("term").alias("kind"),
    )
    if fields is None:
        named = rows.withColumn("field", attribute_field("attribute", prefix))
    else:
        named = map_attribute(rows, fields, "attribute", "field", prefix)
    return named.select("query_id", "site", "ord", "occur", "kind", "field", "text")
