"""Languages and their stop words."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, SparkSession

from lexigrid.model import STOPWORDS
from lexigrid.session import literal_table

# Language code -> name of its stop-word list.
LANGUAGE_NAMES = {
    "ar": "arabic",
    "bg": "bulgarian",
    "bn": "bengali",
    "ca": "catalan",
    "cs": "czech",
    "da": "danish",
    "de": "german",
    "el": "greek",
    "en": "english",
    "es": "spanish",
    "eu": "basque",
    "fa": "persian",
    "fi": "finnish",
    "fr": "french",
    "ga": "irish",
    "gl": "galician",
    "hi": "hindi",
    "hu": "hungarian",
    "hy": "armenian",
    "id": "indonesian",
    "it": "italian",
    "ja": "cjk",
    "ko": "cjk",
    "lt": "lithuanian",
    "lv": "latvian",
    "nb": "norwegian",
    "nl": "dutch",
    "pt": "portuguese",
    "ro": "romanian",
    "ru": "russian",
    "sv": "swedish",
    "th": "thai",
    "tr": "turkish",
    "zh": "cjk",
}

# The lists Spark ships.
SPARK_LISTS = (
    "danish",
    "dutch",
    "english",
    "finnish",
    "french",
    "german",
    "hungarian",
    "italian",
    "norwegian",
    "portuguese",
    "russian",
    "spanish",
    "swedish",
    "turkish",
)


def language_names(spark: SparkSession) -> DataFrame:
    """``(lang, name)`` of every known language code."""
    return literal_table(spark, "lang string, name string", sorted(LANGUAGE_NAMES.items()))


def stopwords(spark: SparkSession, extra: DataFrame | None = None) -> DataFrame:
    """``(lang, term)``: Spark's lists, plus the caller's own.

    A language without a list simply has no rows.
    """
    rows = []
    for lang, name in sorted(LANGUAGE_NAMES.items()):
        if name in SPARK_LISTS:
            words = StopWordsRemover.loadDefaultStopWords(name)
            rows += [(lang, word) for word in sorted({w.strip().lower() for w in words if w.strip()})]
    table = literal_table(spark, STOPWORDS, rows)
    return table if extra is None else table.unionByName(extra.select("lang", "term")).distinct()
