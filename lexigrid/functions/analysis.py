"""Text analysis: text to terms."""

from __future__ import annotations

import unicodedata
from collections import defaultdict
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrid.functions.names import map_field
from lexigrid.model import Analyzer, Analyzers

STANDARD = Analyzer()

# Of texts of known characters the standard pattern's runs are what these separators leave, in any
# library that knows letters, marks and digits: all those characters have long had their categories.
SEPARATORS = r"[^\p{L}\p{M}\p{N}]+"
# known: up to Latin Extended-B, dashes and quotes, blanks and marks between ideographs, and of these, kana and hangul the common ones
_LATIN_END = 0x24F
_MARKS = ((0x2010, 0x2027), (0x3000, 0x3003), (0x3008, 0x3011), (0xFF01, 0xFF0F), (0xFF1A, 0xFF20))
UNSPACED = ((0x3041, 0x3096), (0x30A1, 0x30FA), (0x30FC, 0x30FC), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3))
LETTERS = tuple((c, c) for c in range(_LATIN_END + 1) if unicodedata.category(chr(c))[0] in "LMN")
_NOT_LATIN = f"[^\\x00-\\x{{{_LATIN_END:X}}}]"
_NOT_KNOWN = f"[^\\x00-\\x{{{_LATIN_END:X}}}{''.join(f'\\x{{{low:X}}}-\\x{{{high:X}}}' for low, high in _MARKS + UNSPACED)}]"

# scripts that are written without blanks between words
_UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}ー"
_STRETCHES = f"[{_UNSPACED}]+|[^{_UNSPACED}]+"


def tokens(text: Column | str, analyzer: Analyzer = STANDARD) -> Column:
    """The terms of a text, in order, as an array; stop words are still among them."""
    value = F.col(text) if isinstance(text, str) else text
    if analyzer.lowercase:
        value = F.lower(value)
    runs = F.regexp_extract_all(value, F.lit(analyzer.pattern), F.lit(0))
    if not analyzer.pairs:
        return runs
    stretches = F.flatten(F.transform(runs, lambda run: F.regexp_extract_all(run, F.lit(_STRETCHES), F.lit(0))))
    return F.flatten(F.transform(stretches, _paired))


def _paired(stretch: Column) -> Column:
    pairs = F.transform(F.sequence(F.lit(1), F.length(stretch) - 1), lambda at: F.substring(stretch, at, F.lit(2)))
    return F.when(stretch.rlike(f"^[{_UNSPACED}]") & (F.length(stretch) > 1), pairs).otherwise(F.array(stretch))


def analyzer_of(analyzers: Analyzers, site: str) -> Analyzer:
    return analyzers if isinstance(analyzers, Analyzer) else analyzers.get(site, STANDARD)


def by_site(analyzers: Analyzers, site: Column, make) -> Column:
    """``make(analyzer)`` of each row's site, once per way of cutting text into terms."""
    if isinstance(analyzers, Analyzer):
        return make(analyzers)
    ways = defaultdict(list)
    for name, analyzer in sorted(analyzers.items()):
        ways[replace(analyzer, stopwords=())].append(name)
    ways.pop(STANDARD, None)
    made = None
    for analyzer, names in ways.items():
        made = (F if made is None else made).when(site.isin(names), make(analyzer))
    return make(STANDARD) if made is None else made.otherwise(make(STANDARD))


def site_tokens(text: str, analyzers: Analyzers) -> Column:
    """The terms of a row's text, as its ``site`` has them."""
    return by_site(analyzers, F.col("site"), lambda analyzer: tokens(text, analyzer))


def known_text(text: str, analyzers: Analyzers) -> Column:
    """A row's text as its site's analyzer cuts it, lower-cased or not, if ``SEPARATORS`` cut it into the same runs; else null."""
    def plain(analyzer):
        if analyzer.pattern != STANDARD.pattern:
            return F.lit(None).cast("string")
        value = F.lower(text) if analyzer.lowercase else F.col(text)
        # most texts pass the first test, which is several times as fast
        return F.when(~value.rlike(_NOT_LATIN) | ~value.rlike(_NOT_KNOWN), value)

    return by_site(analyzers, F.col("site"), plain)


def stop_lists(analyzers: Analyzers) -> dict[str | None, list[str]]:
    """Stop words by site, with None for every site."""
    named = {None: analyzers} if isinstance(analyzers, Analyzer) else analyzers
    return {site: sorted(set(a.stopwords)) for site, a in named.items() if a.stopwords}


def analyze(keywords: DataFrame, analyzer: Analyzer = STANDARD) -> DataFrame:
    """One row per token: every column but ``text``, then ``pos`` (from 0) and ``term``."""
    keep = [c for c in keywords.columns if c != "text"]
    rows = keywords.select(*keep, F.posexplode(tokens("text", analyzer)).alias("pos", "term"))
    return rows.where(~F.col("term").isin(list(analyzer.stopwords))) if analyzer.stopwords else rows


def remove_stopwords(token_rows: DataFrame, sites: DataFrame, stopwords: DataFrame) -> DataFrame:
    """Drop each site's stop words; the other tokens keep their positions."""
    listed = sites.join(stopwords, "lang").select("site", "term").distinct()
    return token_rows.join(listed, ["site", "term"], "left_anti")


def explain_source(
    keywords: DataFrame, fields: DataFrame, analyzer: Analyzer = STANDARD, prefix: str = ""
) -> DataFrame:
    """Per stored field: its handle, its text and its blank-joined terms."""
    named = map_field(keywords, fields, "field", "handle", prefix)
    keep = [c for c in keywords.columns if c not in ("field", "text")]
    return named.select(
        *keep, "handle", F.col("text").alias("source"),
        F.concat_ws(" ", tokens("text", analyzer)).alias("tokens"),
    )
