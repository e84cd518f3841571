"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule names the measures it needs and the condition under which it rejects.
On a bounded sample every rule's cost (seconds) and share of rejections are
measured; the cascade runs rules in descending order of rejections per second.
A document that one rule rejects is not measured for the next ones.  The order
changes the work, never the verdict.

Words are runs of anything but ASCII white space; null texts are empty.  All
measures are of the row alone, so repeated rows, ties and null or repeated IDs
get the same verdict each time, an empty table gives an empty result, and extra
columns pass through whatever their names are.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrid.llm.common import text_of, whole_row, words_of

SAMPLE_ROWS = 400  # rows measured to order the rules
SAMPLE_CHARS = 20_000  # of each; only the order depends on it
_REPEATS = 20  # times the sample is measured, to be longer than a job's start


@dataclass(frozen=True)
class Rule:
    """``rejects`` gets the measures as columns by name."""

    name: str
    needs: tuple[str, ...]
    rejects: Callable[[Callable[[str], Column]], Column]


RULES = (
    Rule("short", ("n_words",), lambda m: m("n_words") < 50),
    Rule("repeated", ("n_words", "n_repeat_words"), lambda m: 100 * m("n_repeat_words") > 50 * m("n_words")),
    Rule("symbols", ("n_symbols", "word_chars"), lambda m: 100 * m("n_symbols") > 4 * m("word_chars")),
    Rule("lines", ("n_lines", "n_dup_lines"), lambda m: 100 * m("n_dup_lines") > 50 * m("n_lines")),
    Rule("capitals", ("n_upper", "n_lower"), lambda m: 100 * m("n_upper") > 40 * (m("n_upper") + m("n_lower"))),
    Rule("long_words", ("word_chars", "n_words"), lambda m: m("word_chars") > 20 * m("n_words")),
)
BASE = ("short", "repeated")


def _count_only(text: Column, outside: str) -> Column:
    """Characters of ``text`` that are not in the class ``outside``."""
    return F.length(F.regexp_replace(text, outside, "")).cast("bigint")


def _starts(words: Column) -> Column:
    """For each window of three words its hash."""
    return F.when(
        F.size(words) >= 3,
        F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2])),
    ).otherwise(F.array().cast("array<bigint>"))


def _twice(sorted_windows: Column) -> Column:
    """Positions, ascending, of the windows that occur twice or more; input sorted by hash."""
    s = sorted_windows
    found = F.filter(
        s,
        lambda x, j: F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False)),
    )
    return F.sort_array(F.transform(found, lambda x: x["i"]))


def _covered(at: Column) -> Column:
    """Words that windows of three starting at the given positions cover, each once."""
    own = F.transform(at, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(at, j + 1) - x, F.lit(3))))
    return F.aggregate(own, F.lit(0).cast("bigint"), lambda a, x: a + x)


# name -> (steps it builds on, expression).  Each step is a column of its own: an array that a
# lambda reads must be there already, or it would be made again for each element.
_STEPS: dict[str, tuple[tuple[str, ...], Callable[[Callable[[str], Column]], Column]]] = {
    "words": (("text",), lambda m: words_of(m("text"))),
    "lines": (("text",), lambda m: F.filter(F.split(m("text"), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))),
    "windows": (("words",), lambda m: _starts(m("words"))),
    "sorted": (
        ("windows",),
        lambda m: F.when(
            F.size(F.array_distinct(m("windows"))) < F.size(m("windows")),
            F.sort_array(F.transform(m("windows"), lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    ),
    "twice": (("sorted",), lambda m: _twice(m("sorted"))),
    "n_words": (("words",), lambda m: F.size(m("words")).cast("bigint")),
    "word_chars": (("words",), lambda m: F.length(F.array_join(m("words"), "")).cast("bigint")),
    "n_symbols": (("text",), lambda m: _count_only(m("text"), "[^#*$%&|<>]+")),
    "n_upper": (("text",), lambda m: _count_only(m("text"), "[^A-Z]+")),
    "n_lower": (("text",), lambda m: _count_only(m("text"), "[^a-z]+")),
    "n_lines": (("lines",), lambda m: F.size(m("lines")).cast("bigint")),
    "n_dup_lines": (("lines",), lambda m: (F.size(m("lines")) - F.size(F.array_distinct(m("lines")))).cast("bigint")),
    "n_repeat_words": (("twice",), lambda m: F.coalesce(_covered(m("twice")), F.lit(0).cast("bigint"))),
}


def _m(name: str) -> Column:
    return F.col(f"m_{name}")


class _Frame:
    """Rows with the measures made so far; a measure is made once, and only where no rule has rejected yet."""

    def __init__(self, docs: DataFrame, text: str):
        self.df = docs.select(whole_row(docs), text_of(text).alias("m_text"), F.lit(None).cast("string").alias("failed_rule"))
        self.made = {"text"}

    def make(self, name: str, guarded: bool) -> None:
        if name in self.made:
            return
        below, expression = _STEPS[name]
        for step in below:
            self.make(step, guarded)
        value = expression(_m)
        self.df = self.df.withColumn(f"m_{name}", F.when(F.col("failed_rule").isNull(), value) if guarded else value)
        self.made.add(name)

    def apply(self, rule: Rule) -> None:
        for name in rule.needs:
            self.make(name, guarded=True)
        failed = F.when(rule.rejects(_m), rule.name)
        self.df = self.df.withColumn("failed_rule", F.coalesce(F.col("failed_rule"), failed))


def order_rules(docs: DataFrame, rules=RULES, text: str = "text", seed: int = 11) -> list[Rule]:
    """The rules by rejections per second on a sample of at most ``SAMPLE_ROWS`` rows, clipped to ``SAMPLE_CHARS``.

    Sample rows come from the first partitions that have enough of them, so the
    corpus is not read for it.  Without a row the given order stays.
    """
    spark = docs.sparkSession
    rows = docs.sample(0.1, seed).select(F.left(text_of(text), F.lit(SAMPLE_CHARS)).alias("text")).limit(SAMPLE_ROWS).collect()
    if not rows:
        return list(rules)
    sample = spark.createDataFrame(rows, "text string").withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(_REPEATS)))).cache()
    sample.count()

    def measured(some: list[Rule]) -> tuple[float, int]:
        frame, start = _Frame(sample, "text"), time.time()
        for rule in some:
            frame.apply(rule)
        rejected = frame.df.agg(F.count("failed_rule")).collect()[0][0]
        return time.time() - start, rejected

    measured([])
    idle, gain = min(measured([])[0] for _ in range(2)), {}
    for i, rule in enumerate(rules):
        measured([rule])
        seconds, rejected = measured([rule])
        gain[rule.name] = (-rejected / max(seconds - idle, 0.005), i)
    sample.unpersist()
    return sorted(rules, key=lambda r: gain[r.name])


def _fenced(df: DataFrame) -> DataFrame:
    """The same rows, with their columns made by an ``explode`` of one element.

    A later filter on the verdict would else be moved below the cascade, with all of it written
    into one condition, where arrays are made again for each element.
    """
    return df.select(F.explode(F.array(F.struct("*"))).alias("all")).select("all.*")


def cascade(docs: DataFrame, rules=RULES, text: str = "text", ordered: bool = False) -> DataFrame:
    """The rows as struct ``row`` with ``failed_rule``: the first rule of the cascade that rejects, or null."""
    frame = _Frame(docs, text)
    for rule in rules if ordered else order_rules(docs, rules, text):
        frame.apply(rule)
    return _fenced(frame.df.select("row", "failed_rule"))


def keep_good(docs: DataFrame, rules=RULES, text: str = "text") -> DataFrame:
    """The documents that no rule rejects, with their own columns."""
    return cascade(docs, rules, text).where(F.col("failed_rule").isNull()).select("row.*")


def report(docs: DataFrame, rules=RULES, text: str = "text") -> DataFrame:
    """Every row as struct ``row``, all base measures, ``base_failed``, ``failed_rule`` and ``kept``.

    Here all base measures are made for every row, as they are asked for; the
    cascade still skips what only its own rules need.
    """
    frame = _Frame(docs, text)
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for name in base:
        frame.make(name, guarded=False)
    for rule in order_rules(docs, rules, text):
        frame.apply(rule)
    base_failed = F.lit(False)
    for rule in RULES:
        if rule.name in BASE:
            base_failed = base_failed | rule.rejects(_m)
    return _fenced(frame.df.select(
        "row",
        *[_m(name).alias(name) for name in base],
        base_failed.alias("base_failed"),
        "failed_rule",
        (F.col("failed_rule").isNull() & ~base_failed).alias("kept"),
    ))
