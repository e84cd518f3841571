"""Table layouts and parameters shared by the whole library.

Every table is a plain DataFrame.  A *site* owns one searchable index; a
*version* is one complete, immutable build of it; ``published`` says which
version of a site readers see.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

ELEMENTS = (
    "site string, id bigint, type string, is_draft boolean, "
    "date_created timestamp, date_updated timestamp"
)
TYPES = "type string, has_titles boolean, attributes array<string>"
FIELDS = "field_id int, handle string, searchable boolean"
SITES = "site string, lang string"
KEYWORDS = "site string, version bigint, id bigint, field string, text string"
PUBLISHED = "site string, version bigint, n_buckets int"
QUERY_TERMS = (
    "query_id int, site string, ord int, term string, attribute string, exclude boolean, "
    "phrase boolean, sub_left boolean, sub_right boolean, is_group boolean"
)
QUERY_OPTIONS = "query_id int, exclude boolean, sub_left boolean, sub_right boolean"
SCOPE = "query_id int, id bigint"
BOOSTS = "handle string, boost double"
STOPWORDS = "lang string, term string"
CHANGES = (
    "site string, id bigint, op string, ts timestamp, seq bigint, "
    "is_draft boolean, field string, text string"
)

# The attributes every element has besides its own, and the two
# kinds of index field names.
PREDEFINED_ATTRIBUTES = ("title", "slug")
ATTRIBUTE_PREFIX = "attribute_"
FIELD_PREFIX = "field_"


@dataclass(frozen=True)
class Analyzer:
    """How text becomes terms: lower-case, then every run matching ``pattern``.

    ``pairs``      within a run, a stretch of ideographs, kana or hangul becomes its overlapping pairs of characters
                   (one alone stays), as such text has no blanks between words
    ``stopwords``  terms left out; the others keep their positions, so a phrase with stop words inside asks for
                   as many words there
    """

    pattern: str = r"[\p{L}\p{M}\p{N}]+"
    lowercase: bool = True
    pairs: bool = False
    stopwords: tuple[str, ...] = ()


# one analyzer for all sites, or each site's own; other sites then have the standard one
Analyzers = Analyzer | Mapping[str, Analyzer]


@dataclass(frozen=True)
class Bm25:
    """Parameters of the BM25 weighting (Robertson & Zaragoza, 2009)."""

    k1: float = 1.2
    b: float = 0.75


@dataclass(frozen=True)
class TermDefaults:
    """Flags of a query term when neither the term nor its query sets them."""

    exclude: bool = False
    sub_left: bool = False
    sub_right: bool = False


@dataclass(frozen=True)
class Index:
    """The tables that answer searches.

    ``keywords``    site, version, id, field, text
    ``postings``    site, version, bucket, field, term, id, tf, dl, head, positions
    ``term_stats``  site, version, bucket, field, term, df
    ``field_stats`` site, version, field, n_docs, sum_dl
    ``published``   site, version, n_buckets; several versions of a site are its base and layers
    ``tombstones``  site, version, block, ids: documents that a layer replaces in earlier versions, up to 64 in a
                    row, see ``id_blocks``; None where every site serves one version
    ``dictionary``  site, version, kind, key, field, term, df, bucket: the vocabulary in the order wildcards
                    ask for; None where it is made from ``term_stats`` in each search
    ``analyzers``   how the sites' texts were analysed, and so how their queries are

    ``dl`` (tokens of the document's field) rides on each posting so that
    scoring never joins postings with a per-document table.  ``head`` is true
    on exactly one posting per (document, field), the one holding the first
    token, so document-level totals come from a filtered scan of two narrow
    columns instead of a second pass over the text.
    """

    keywords: DataFrame
    postings: DataFrame
    term_stats: DataFrame
    field_stats: DataFrame
    published: DataFrame
    tombstones: DataFrame | None = None
    dictionary: DataFrame | None = None
    analyzers: Analyzers = Analyzer()
