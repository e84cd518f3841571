"""Quality by nearest neighbours in a latent-semantic space.

A document becomes counts of hashed words, of runs of three character classes
and of a few of its measures; tf-idf and a truncated SVD, fitted on a bounded
sample of labelled rows (``NEIGHBOURS``), turn them into unit vectors.  The
labelled vectors are broadcast, their number and size being fixed; every
document's cosines with all of them are computed exactly, in blocks, and the
labels of the ``K`` nearest vote with their similarity as weight.

Only the text is looked at.  Null texts are empty; an empty text has a term of
its own, so it has a vector and a score like any other.  Rows are scored by
themselves: repeated rows get equal scores.  Without a labelled row, and for a
vector that resembles none, the score is the prior: the labels' mean, or one
half.  Extra columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrid.llm.common import text_of, whole_row

NEIGHBOURS = 4_000  # labelled rows at most
RANK = 48
K = 25
_WORDS, _CLASSES, _MEASURES = 1024, 12, 64
_RUNS = _CLASSES**3
_DIM = _WORDS + _RUNS + _MEASURES
_BLOCK = 512  # documents multiplied at once
_PIECE = 1 << 20  # characters of a long text counted at once


def _class_table() -> np.ndarray:
    """Character classes of the first 256 code points; all others are letters."""
    table = np.full(257, 2, dtype=np.int64)
    for i in range(256):
        ch = chr(i)
        table[i] = (
            0 if ch == " " else 1 if ch.isspace() else 3 if ch.isupper() else 2 if ch.isalpha() else 4 if ch.isdigit()
            else 5 if ch in ".,;:" else 6 if ch in "!?" else 7 if ch in "#*$%&" else 8 if ch in "|<>" else 9 if ch in "()[]{}\"'" else 10 if ch in "-_/=+@" else 11
        )
    return table


_TABLE = _class_table()


@lru_cache(maxsize=1 << 18)
def _word(word: str) -> int:
    return zlib.crc32(word.encode()) % _WORDS


def _levels(value: float, first: int, levels: int = 8) -> list[int]:
    """A share as the terms of all steps up to it, so that near shares have terms in common."""
    return [first + k for k in range(max(1, min(levels, 1 + int(value * levels))))]


def terms(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of a text's terms and their weights before idf."""
    text = text or ""
    runs = np.zeros(_RUNS, dtype=np.int64)
    for start in range(0, len(text), _PIECE):
        part = text[start : start + _PIECE + 2]  # a run may go on into the next piece
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        c = _TABLE[np.minimum(codes, 256)]
        if len(c) > 2:
            runs += np.bincount((c[:-2] * _CLASSES + c[1:-1]) * _CLASSES + c[2:], minlength=_RUNS)
    words = text.split()
    times = Counter(words)
    counts = np.bincount([_word(w) for w in times], list(times.values()), _WORDS) if times else np.zeros(_WORDS)
    n, lines = max(1, len(words)), [x for x in text.split("\n") if x.strip()]
    again = sum(map(eq, words, words[1:])) / n
    grams = max(0, len(words) - 2)
    repeated = 1 - len(set(zip(words, words[1:], words[2:]))) / grams if grams else 0.0
    marks = [
        _levels(again, 0), _levels(repeated, 8),
        _levels(1 - len(set(lines)) / len(lines) if lines else 0.0, 16), _levels(min(1.0, len(words) / 400), 24),
        _levels(min(1.0, sum(map(len, words)) / n / 12), 32), [63] if not words else [],
    ]
    x = np.zeros(_DIM, dtype=np.float32)
    x[:_WORDS] = np.log1p(counts) * 0.3
    x[_WORDS : _WORDS + _RUNS] = np.sqrt(runs / max(1, len(text))) * 6
    x[[_WORDS + _RUNS + m for group in marks for m in group]] = 1.0
    at = np.nonzero(x)[0]
    return at.astype(np.int32), x[at]


@dataclass
class Model:
    idf: np.ndarray
    basis: np.ndarray  # terms x rank
    vectors: np.ndarray  # labelled rows x rank, of length one
    labels: np.ndarray
    prior: float

    def project(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        z = np.zeros((len(rows), self.basis.shape[1]), dtype=np.float32)
        for i, (at, weight) in enumerate(rows):
            z[i] = (weight * self.idf[at]) @ self.basis[at]
        norm = np.linalg.norm(z, axis=1, keepdims=True)
        return z / np.where(norm > 0, norm, 1)

    def score(self, rows: list[tuple[np.ndarray, np.ndarray]], k: int = K) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(rows), self.prior)
        k = min(k, len(self.labels))
        cosine = self.project(rows) @ self.vectors.T
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0.0).astype(np.float64) ** 8  # the nearest count most
        total = weight.sum(axis=1)
        voted = (weight * self.labels[near]).sum(axis=1) / np.where(total > 0, total, 1)
        return np.clip(np.where(total > 1e-9, voted, self.prior), 0.0, 1.0)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int], rank: int = RANK, seed: int = 3) -> Model:
    """Tf-idf and a randomised truncated SVD of the labelled rows."""
    y = np.array(labels, dtype=np.float64)
    x = np.zeros((len(rows), _DIM), dtype=np.float32)
    for i, (at, weight) in enumerate(rows):
        x[i, at] = weight
    idf = (np.log((1 + len(rows)) / (1 + (x > 0).sum(axis=0))) + 0.5).astype(np.float32)
    x *= idf
    rng, rank = np.random.default_rng(seed), max(1, min(rank, len(rows)))
    q = rng.normal(size=(_DIM, rank + 8)).astype(np.float32)
    for _ in range(4):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, v = np.linalg.svd(x @ q, full_matrices=False)
    basis = (q @ v.T[:, :rank]).astype(np.float32)
    model = Model(idf, basis, np.zeros((0, rank), dtype=np.float32), y, float(y.mean()) if len(y) else 0.5)
    model.vectors = model.project(rows)
    return model


def fit_from(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", most: int = NEIGHBOURS) -> Model:
    """Fits on at most ``most`` labelled rows, those first by the hash of their ID, as far as they have a document.

    ``labels`` must hold only rows that may be learned from.  Terms are made where
    the texts are; only the terms of these rows reach the driver.
    """
    chosen = labels.where(F.col(label).isNotNull() & F.col(id).isNotNull()).groupBy(id).agg(F.max(label).alias("label"))
    chosen = chosen.orderBy(F.xxhash64(id), id).limit(most).withColumnRenamed(id, "id_")
    texts = docs.select(F.col(id).alias("id"), text_of(text).alias("text")).join(F.broadcast(chosen), F.col("id") == F.col("id_"))

    def batches(frames):
        for frame in frames:
            made = [terms(t) for t in frame["text"]]
            yield pd.DataFrame({"id": frame["id"], "label": frame["label"], "at": [a for a, _ in made], "weight": [w for _, w in made]})

    kind = docs.select(id).schema[0].dataType.simpleString()
    rows = texts.select("id", "label", "text").mapInPandas(batches, f"id {kind}, label int, at array<int>, weight array<float>")
    rows = rows.orderBy("id").limit(2 * most).collect()  # a bound even if IDs are repeated
    if not rows:
        return Model(np.ones(_DIM, dtype=np.float32), np.zeros((_DIM, 1), dtype=np.float32), np.zeros((0, 1), dtype=np.float32), np.zeros(0), 0.5)
    return fit([(np.array(r["at"], dtype=np.int32), np.array(r["weight"], dtype=np.float32)) for r in rows], [r["label"] for r in rows])


def score_of(model, text: Column) -> Column:
    """The score as a column; ``model`` is a broadcast variable."""

    def batch(texts: pd.Series) -> pd.Series:
        out = np.empty(len(texts))
        for start in range(0, len(texts), _BLOCK):
            part = [terms(t) for t in texts.iloc[start : start + _BLOCK]]
            out[start : start + len(part)] = model.value.score(part)
        return pd.Series(out)

    return F.pandas_udf(batch, "double")(text)


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows as struct ``row`` with ``score``, from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(whole_row(docs), score_of(shared, text_of(text)).alias("score"))
