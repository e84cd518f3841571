"""Full-text indexing and search over Spark DataFrames."""

from lexigrid.model import Analyzer, Bm25, Index, TermDefaults
from lexigrid.plans.search import search, search_clauses
from lexigrid.sources.documents import build_keywords
from lexigrid.sources.store import IndexStore

__all__ = [
    "Analyzer",
    "Bm25",
    "Index",
    "IndexStore",
    "TermDefaults",
    "build_keywords",
    "search",
    "search_clauses",
]
