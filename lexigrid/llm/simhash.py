"""SimHash near-duplicates: pigeonhole blocks of fingerprints, verified by Hamming distance.

A text's fingerprint has a bit set if more than half of its shingles' XXH64
hashes have it.  Two fingerprints within ``distance`` bits, cut into
``distance + 3`` blocks, agree in at least three whole blocks; each choice of
three blocks is a join key of about 38 bits, so that keys stay selective with
billions of fingerprints.  Only distinct fingerprints are joined: copies of one
text are one row here, however many there are.  Links become classes by
alternating large-star and small-star steps, each written to the shared folder.

Edited copies of a five-word similarity of 0.8 differ in up to a third of the 64 bits.  ``similar_classes``
and ``keep_one(similarity=...)``, which the pipeline uses, add links between them: the same
method on a fingerprint as wide as the shingle set, see ``shingle_blocks``.

Null and empty texts have fingerprint 0 and link like any other.  Rows that
share a fingerprint are one class.  The class ID is the smallest ID, null only
where no row of the class has one.  Extra columns are not looked at.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrid.llm import shingle_blocks
from lexigrid.llm.common import text_of, whole_row
from lexigrid.llm.components import stars
from lexigrid.session import written

SEED = 42
WORDS = 3
DISTANCE = 2


def words_in(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits


def fingerprint(text: str | None, n: int = WORDS) -> int:
    """The fingerprint of one text, unsigned."""
    return _fingerprint(words_in(text), n)


def _fingerprint(words: list[bytes], n: int) -> int:
    if not words:
        return 0
    shingles = map(b" ".join, zip(*[words[i:] for i in range(n)])) if len(words) >= n else [b" ".join(words)]
    hashed = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashed), 1 << 14):  # bounded memory for very long texts
        part = hashed[start : start + (1 << 14)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashed), bitorder="little").view("<u8")[0])


def fingerprint_of(text: Column, n: int = WORDS) -> Column:
    """The fingerprint as a column, in the bits of a signed long."""

    def batch(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, n) for t in texts], dtype=np.uint64).view(np.int64))

    return F.pandas_udf(batch, "bigint")(text)


def keyed_of(text: Column, n: int = WORDS) -> Column:
    """The fingerprint as ``fp`` beside ``keys``, ``n`` and ``odd``: the blocks, size and sketch of the set of five-word shingles."""

    def batch(texts: pd.Series) -> pd.DataFrame:
        fps, keys, sizes, odd = np.zeros(len(texts), dtype=np.uint64), [], [], []
        for i, t in enumerate(texts):
            words = words_in(t)
            fps[i] = _fingerprint(words, n)
            found = shingle_blocks.shingles(words)
            keys.append(shingle_blocks.blocks(found).view(np.int64))
            sizes.append(len(found))
            odd.append(shingle_blocks.odd_sketch(found))
        return pd.DataFrame({"fp": fps.view(np.int64), "keys": keys, "n": np.array(sizes, dtype=np.int32), "odd": odd})

    return F.pandas_udf(batch, "fp bigint, keys array<bigint>, n int, odd array<bigint>")(text)


def block_masks(distance: int) -> list[int]:
    """For each choice of three of ``distance + 3`` blocks, the bits they hold, as signed longs."""
    blocks = distance + 3
    edges = [64 * i // blocks for i in range(blocks + 1)]
    single = [sum(1 << bit for bit in range(a, b)) for a, b in zip(edges, edges[1:])]
    masks = [a | b | c for a, b, c in combinations(single, 3)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(fingerprints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``a < b``: the pairs of distinct fingerprints (column ``fp``) within ``distance`` bits."""
    keys = F.explode(F.array(*[
        F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(mask)).alias("bits"))
        for i, mask in enumerate(block_masks(distance))
    ]))
    keyed = fingerprints.select("fp", keys.alias("key")).select("fp", "key.choice", "key.bits")
    a, b = keyed.alias("a"), keyed.alias("b")
    close = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= distance
    on = (F.col("a.choice") == F.col("b.choice")) & (F.col("a.bits") == F.col("b.bits"))
    pairs = a.join(b, on & (F.col("a.fp") < F.col("b.fp")) & close)
    return pairs.select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b")).distinct()


def classes(docs: DataFrame, id: str = "doc_id", text: str = "text", n: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """``id, text_hash, fp, root, component_id`` per row: its fingerprint and class.

    ``root`` is the smallest fingerprint of the class.
    """
    t = text_of(text)
    slim = docs.select(F.col(id).alias("id"), F.xxhash64(t).alias("text_hash"), fingerprint_of(t, n).alias("fp"))
    return _labelled(written(slim, "simhash-fps"), distance)


def _labelled(slim: DataFrame, distance: int) -> DataFrame:
    """``id, text_hash, fp`` with ``root`` and ``component_id``."""
    nodes = slim.groupBy("fp").agg(F.min("id").alias("least"))
    star = stars(links(nodes.select("fp"), distance))
    labelled = nodes.join(star.select(F.col("b").alias("fp"), F.col("a").alias("star")), "fp", "left").select(
        "fp", "least", F.coalesce("star", "fp").alias("root")
    )
    labelled = written(labelled, "simhash-roots")
    smallest = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = labelled.select("fp", "root").join(smallest, "root")
    return slim.join(of_fp, "fp").select("id", "text_hash", "fp", "root", "component_id")


def similar_classes(docs: DataFrame, id: str = "doc_id", text: str = "text", n: int = WORDS, distance: int = DISTANCE,
                    similarity: float = shingle_blocks.SIMILARITY) -> DataFrame:
    """As ``classes``, with classes joined where texts of both are near copies by five-word shingles, 0.8 similar or more."""
    if similarity < shingle_blocks.SIMILARITY:
        raise ValueError(f"blocks are made for a similarity of {shingle_blocks.SIMILARITY} or more")
    t = text_of(text)
    made = docs.select(F.col(id).alias("id"), F.xxhash64(t).alias("text_hash"), keyed_of(t, n).alias("made"))
    slim = written(made.select("id", "text_hash", "made.*"), "simhash-keyed")
    pairs = shingle_blocks.similar(docs, slim, text, similarity)
    found = written(_labelled(slim.select("id", "text_hash", "fp"), distance), "simhash-first")
    roots = found.select("text_hash", "root").distinct()
    edges = pairs.join(roots.withColumnsRenamed({"text_hash": "a", "root": "x"}), "a").join(
        roots.withColumnsRenamed({"text_hash": "b", "root": "y"}), "b"
    ).where("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    star = stars(edges)
    merged = found.groupBy("root").agg(F.min("component_id").alias("least")).join(
        star.select(F.col("b").alias("root"), F.col("a").alias("star")), "root", "left"
    ).select("root", "least", F.coalesce("star", "root").alias("star"))
    merged = written(merged, "simhash-merged")
    smallest = merged.groupBy("star").agg(F.min("least").alias("component_id"))
    of_root = merged.select("root", "star").join(smallest, "star")
    return found.drop("component_id").join(of_root, "root").select("id", "text_hash", "fp", F.col("star").alias("root"), "component_id")


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", n: int = WORDS, distance: int = DISTANCE,
             similarity: float | None = None) -> DataFrame:
    """One row of each class, that with the smallest ID, with all its columns.

    Of rows that share that ID, that with the smallest text hash stays, once.
    With ``similarity``, texts of that similarity by five-word shingles are of one class too.
    """
    if similarity is None:
        found = classes(docs, id, text, n, distance)
    else:
        found = similar_classes(docs, id, text, n, distance, similarity)
    found = written(found, "simhash-classes")
    first = found.where(F.col("id").eqNullSafe(F.col("component_id")))
    first = first.groupBy("id", "root").agg(F.min("text_hash").alias("keep_hash"), F.count("*").alias("rows"))
    again = first.where("rows > 1")
    others = found.join(again.select(F.col("id").alias("i"), F.col("root").alias("r"), "keep_hash"),
                        F.col("id").eqNullSafe(F.col("i")) & (F.col("root") == F.col("r")))
    removed = found.where(~F.col("id").eqNullSafe(F.col("component_id"))).select("id", "text_hash").union(
        others.where("text_hash != keep_hash").select("id", "text_hash")
    ).distinct()

    removed = removed.withColumnsRenamed({"id": "id_", "text_hash": "text_hash_"})
    hashed = docs.select(whole_row(docs), F.col(id).alias("id"), F.xxhash64(text_of(text)).alias("text_hash"))

    def same(table: DataFrame) -> Column:
        return F.col("id").eqNullSafe(table["id_"]) & (F.col("text_hash") == table["text_hash_"])

    kept = hashed.join(removed.hint("shuffle_hash"), same(removed), "left_anti")
    repeats = written(again.select(F.col("id").alias("id_"), F.col("keep_hash").alias("text_hash_")), "simhash-repeats")
    if repeats.isEmpty():
        return kept.select("row.*")
    once = kept.join(repeats, same(repeats), "left_semi").groupBy("id", "text_hash").agg(F.first("row").alias("row"))
    return kept.join(repeats, same(repeats), "left_anti").select("row.*").unionByName(once.select("row.*"))
