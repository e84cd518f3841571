"""Hard negatives by angular triangle filtering, with exact integer scores.

Components become integers, ``floor(scale * x)``; a row's score is its inner product with an anchor.  An anchor's
positives are its best rows of the same label; its negatives, for each positive, the best rows of other labels whose
score lies between two shares of the positive's.

Method.  Each row keeps its norm and its angles to a few reference directions (the means of the labels with most rows).
For an anchor at angle s and a row at angle t from one direction the angle between both lies from ``|s - t|`` to
``min(s + t, 2 pi - s - t)``; all directions together give an interval, whose cosines times both norms bound the score.
Bounds are widened by more than rounding can amount to.  Rows are taken in tiles of near angles: a tile whose bounds
miss an anchor's windows is skipped whole, then single pairs are; only pairs whose bounds overlap a window are
scored, in integers.  The window of a positive is its share interval, from the last kept score on once it has enough.

Anchors meet all rows in blocks: rows and anchors are dealt by hash into parts of about ``ROWS`` and ``ANCHORS``, and each
pair of parts is one group of bounded size.  For positives this is done within each label, so that a label with a third
of all rows is many parts; for negatives over all rows.  A group passes on at most its own best per anchor and
positive, and the best of those are the result.  The reference directions (at most ``DIRECTIONS``) are all that
reaches the driver.

Rows with a null label, a null vector, or a null or non-finite component take no part.  Shorter vectors count as
filled with zeros.  Ties go to the smaller ID, null last, then to either row; rows that share an ID, or all of
their values, are rows of their own.  Integers beyond a long are its ends, as are scores.  An empty table, or one
without anchors, gives no rows.  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexigrid.session import written

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # percent of the positive's score
DIRECTIONS = 16
ROWS, ANCHORS = 1 << 16, 1 << 13  # rows and anchors of a part, about
TILE = 256  # rows bounded at once
_ANCHOR_TILE = 512
_SLACK = 1e-6  # radians and share of the norms: far above the rounding of arc cosines and products
_LAST = np.iinfo(np.int64).max


def rows_of(table: DataFrame, id: str, label: Column, vector: str, anchor: Column, scale: int = SCALE) -> DataFrame:
    """``row, id, label, anchor, q`` of the rows that take part; ``q`` are the integers."""
    x = F.col(vector)
    sound = x.isNotNull() & F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    q = F.transform(x, lambda v: F.floor(v.cast("double") * F.lit(float(scale))))
    rows = table.where(sound & label.isNotNull())
    rows = rows.select(F.col(id).cast("bigint").alias("id"), label.alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"), q.alias("q"))
    return written(rows.withColumn("row", F.monotonically_increasing_id()), "negatives-rows")


def directions(rows: DataFrame, most: int = DIRECTIONS) -> np.ndarray:
    """Unit vectors: the means of the labels with most rows.  Any would do; these are near many rows."""
    chosen = rows.groupBy("label").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label").limit(most).select("label")
    parts = rows.join(chosen, "label").select("label", F.posexplode("q").alias("i", "v"))
    sums = parts.groupBy("label", "i").agg(F.sum(F.col("v").cast("double")).alias("v")).collect()
    labels = sorted({r["label"] for r in sums})
    found = np.zeros((len(labels), 1 + max((r["i"] for r in sums), default=0)))
    for r in sums:
        found[labels.index(r["label"]), r["i"]] = r["v"]
    length = np.linalg.norm(found, axis=1)
    return found[length > 0] / length[length > 0, None]


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Integer vectors as rows of a matrix, filled with zeros."""
    bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    values, sizes = lists.flatten().to_numpy(zero_copy_only=False), np.diff(bounds)
    found = np.zeros((len(lists), width), dtype=np.int64)
    found[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(bounds[:-1], sizes)] = values
    return found


def _exact(*matrices: np.ndarray) -> list[np.ndarray]:
    """The same numbers as doubles, longs or Python numbers, the first that hold all scores exactly."""
    most = max((max(abs(int(m.min(initial=0))), int(m.max(initial=0))) for m in matrices), default=0)
    room = most * most * max(m.shape[1] for m in matrices)
    kind = np.float64 if room < 1 << 53 else np.int64 if room < 1 << 63 else object
    return [m.astype(kind) for m in matrices]


def _whole(scores: np.ndarray) -> np.ndarray:
    if scores.dtype == object:
        scores = np.clip(scores, -_LAST, _LAST)
    return np.maximum(scores.astype(np.int64), -_LAST)  # so that its negative is a long too


def measured(rows: DataFrame, axes: np.ndarray) -> DataFrame:
    """With ``norm``, and ``angles`` to the reference directions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = _matrix(batch.column("q"), axes.shape[1]).astype(np.float64)
            norm = np.sqrt((q * q).sum(axis=1))
            cosine = (q @ axes.T) / np.where(norm > 0, norm, 1)[:, None]
            angles = pa.array(list(np.arccos(np.clip(cosine, -1, 1))), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_pydict(dict(zip(batch.schema.names, batch.columns)) | {"norm": pa.array(norm, pa.float64()), "angles": angles})

    width = max(axes.shape[1], rows.agg(F.max(F.size("q"))).first()[0] or 0)
    axes = np.pad(axes, ((0, 0), (0, width - axes.shape[1])))  # what a direction lacks is zero in it
    kind = rows.schema["label"].dataType.simpleString()
    return rows.select("row", "id", "label", "anchor", "q").mapInArrow(
        run, f"row bigint, id bigint, label {kind}, anchor boolean, q array<bigint>, norm double, angles array<double>"
    )


def _bounds(a: dict, least: np.ndarray, greatest: np.ndarray, small: np.ndarray, large: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Score bounds of anchors (rows) with things (columns) whose angles and norms lie in these ranges."""
    s = a["angles"][:, None, :]
    near = np.maximum(np.maximum(s - greatest, least - s), 0).max(axis=2, initial=0) - _SLACK
    far = np.minimum(s + greatest, 2 * np.pi - s - least).min(axis=2, initial=np.pi) + _SLACK
    high, low = np.cos(np.maximum(near, 0)), np.cos(np.minimum(far, np.pi))
    n = a["norm"][:, None]
    spare = n * large * _SLACK + 1
    return np.minimum(low * n * small, low * n * large) - spare, np.maximum(high * n * small, high * n * large) + spare


def _best(key: np.ndarray, score: np.ndarray, id: np.ndarray, row: np.ndarray, most: int) -> np.ndarray:
    """The places of the ``most`` best of each key, by score, then ID, in that order."""
    order = np.lexsort((row, id, -score, key))
    key = key[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, dtype=np.int64)
    nth = np.arange(len(key)) - np.repeat(first, np.diff(np.r_[first, len(key)]))
    return order[nth < most]


def _search(a: dict, x: dict, low: np.ndarray, high: np.ndarray, most: int, allowed) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For anchor ``i`` and window ``j`` the ``most`` best rows with ``low[i, j] <= score <= high[i, j]``: key ``i * windows + j``, place, score.

    ``allowed(anchors, rows)`` says which pairs may be scored at all.
    """
    windows = low.shape[1]
    at = np.lexsort((x["angles"].min(axis=1, initial=0), x["angles"].argmin(axis=1) if x["angles"].shape[1] else np.zeros(len(x["norm"]))))
    aq, xq = _exact(a["q"], x["q"])
    low = low.copy()
    kept = [np.zeros(0, dtype=np.int64)] * 3
    for begin in range(0, len(at) if len(low) else 0, TILE):
        tile = at[begin : begin + TILE]
        angles, norm = x["angles"][tile], x["norm"][tile]
        least, greatest = _bounds(a, angles.min(axis=0)[None, None], angles.max(axis=0)[None, None], norm.min()[None, None], norm.max()[None, None])
        some = np.flatnonzero(((greatest >= low) & (least <= high) & (low <= high)).any(axis=1))
        found = []
        for chunk in range(0, len(some), _ANCHOR_TILE):
            these = some[chunk : chunk + _ANCHOR_TILE]
            part = {"angles": a["angles"][these], "norm": a["norm"][these]}
            least, greatest = _bounds(part, angles[None], angles[None], norm[None], norm[None])
            overlap = np.zeros(least.shape, dtype=bool)
            for j in range(windows):
                overlap |= (greatest >= low[these, j, None]) & (least <= high[these, j, None]) & (low[these, j] <= high[these, j])[:, None]
            overlap &= allowed(these, tile)
            i, c = np.nonzero(overlap)
            if len(i) > overlap.size // 8:  # most of them: all at once costs less
                score = _whole(aq[these] @ xq[tile].T)[i, c]
            else:
                score = _whole((aq[these[i]] * xq[tile[c]]).sum(axis=1))
            found.append((these[i], tile[c], score))
        if not found:
            continue
        i, c, score = map(np.concatenate, zip(*found))
        for j in range(windows):
            inside = (score >= low[i, j]) & (score <= high[i, j])
            kept = [np.concatenate(pair) for pair in zip(kept, (i[inside] * windows + j, c[inside], score[inside]))]
        best = _best(kept[0], kept[2], x["id"][kept[1]], x["row"][kept[1]], most)
        kept = [k[best] for k in kept]
        # a full window needs nothing below its last score; one equal to it may have the smaller id
        full = np.bincount(kept[0], minlength=len(a["norm"]) * windows).reshape(-1, windows) >= most
        last = np.full(low.size, _LAST)
        np.minimum.at(last, kept[0], kept[2])
        low = np.where(full, np.maximum(low, last.reshape(-1, windows)), low)
    return tuple(kept)


def _part(rows: pa.Table, width: int) -> dict:
    angles = rows.column("angles").combine_chunks()
    n_axes = len(angles.flatten()) // max(1, len(rows))
    return {
        "row": rows.column("row").to_numpy(), "id": rows.column("id").fill_null(_LAST).to_numpy(), "norm": rows.column("norm").to_numpy(),
        "angles": angles.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), n_axes), "q": _matrix(rows.column("q").combine_chunks(), width),
    }


def _width(*tables: pa.Table) -> int:
    return max(int(np.diff(t.column("q").combine_chunks().offsets.to_numpy()).max(initial=0)) for t in tables)


def _met(left: DataFrame, right: DataFrame, function, schema: str) -> DataFrame:
    keys = ["arena", "a_part", "x_part"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(function, schema)


def _dealt(anchors: DataFrame, rows: DataFrame, arena: Column, n_rows: int, n_anchors: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``arena, a_part, x_part``; every anchor part of an arena with every row part."""

    def counted(side: DataFrame, size: int, name: str) -> DataFrame:
        return side.groupBy(arena.alias("arena")).agg(F.ceil(F.count("*") / size).cast("int").alias(name))

    sizes = written(counted(anchors, n_anchors, "a_parts").join(counted(rows, n_rows, "x_parts"), "arena"), "negatives-parts")

    def placed(side: DataFrame, own: str, own_parts: str, other: str, other_parts: str) -> DataFrame:
        return (
            side.withColumn("arena", arena).join(sizes, "arena")
            .withColumn(own, F.pmod(F.xxhash64("row"), F.col(own_parts)).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_parts) - 1)))
            .drop("a_parts", "x_parts")
        )

    return placed(anchors, "a_part", "a_parts", "x_part", "x_parts"), placed(rows, "x_part", "x_parts", "a_part", "a_parts")


def _positives(most: int):
    """Of an anchor part and a row part of one label: each anchor's best other rows."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        width = _width(anchors, rows)
        a, x = _part(anchors, width), _part(rows, width)
        low = np.full((len(anchors), 1), -_LAST)
        other = lambda i, c: a["row"][i][:, None] != x["row"][c][None]
        key, place, score = _search(a, x, low, np.full_like(low, _LAST), most, other)
        return pa.table({"anchor": a["row"][key], "positive": x["row"][place], "positive_id": _ids(x["id"][place]), "positive_score": score})

    return run


def _negatives(most: int, low: int, high: int):
    """Of an anchor part and a part of all rows: the best rows of other labels for each anchor and positive."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        width = _width(anchors, rows)
        a, x = _part(anchors, width), _part(rows, width)
        lists = anchors.column("scores").to_pylist()
        windows = max(map(len, lists), default=1)
        least, greatest = np.zeros((2, len(lists), windows), dtype=np.int64)
        greatest -= 1  # no window where there is no such positive
        for i, scores in enumerate(lists):
            for j, p in enumerate(scores):
                least[i, j], greatest[i, j] = -(-low * p // 100), high * p // 100
        codes = np.unique(np.concatenate([anchors.column("label").to_numpy(), rows.column("label").to_numpy()]), return_inverse=True)[1]
        la, lx = codes[: len(lists)], codes[len(lists) :]
        key, place, score = _search(a, x, least, greatest, most, lambda i, c: la[i][:, None] != lx[c][None])
        return pa.table({
            "anchor": a["row"][key // windows], "nth": (key % windows).astype(np.int32), "negative": x["row"][place],
            "negative_id": _ids(x["id"][place]), "negative_score": score,
        })

    return run


def _ids(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == _LAST)


def _first(found: DataFrame, keys: list[str], score: str, id: str, row: str, most: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc_nulls_last(id), row)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine(rows: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         n_rows: int = ROWS, n_anchors: int = ANCHORS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` from a table of ``rows_of``."""
    table = written(measured(rows, directions(rows)), "negatives-measured")
    anchors = written(table.where("anchor"), "negatives-anchors")
    columns = ["row", "id", "q", "norm", "angles"]

    left, right = _dealt(anchors, table, F.col("label"), n_rows, n_anchors)
    keys = ["arena", "a_part", "x_part"]
    met = _met(left.select(*keys, *columns), right.select(*keys, *columns), _positives(positives),
               "anchor bigint, positive bigint, positive_id bigint, positive_score bigint")
    best = written(_first(met, ["anchor"], "positive_score", "positive_id", "positive", positives), "negatives-positives")
    scores = best.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "positive_score"))).alias("p"))
    asked = anchors.join(scores, anchors["row"] == scores["anchor"]).select(*columns, "label", F.col("p.positive_score").alias("scores"))

    # windows of all labels: one arena
    left, right = _dealt(asked, table, F.lit(0), n_rows, n_anchors)
    met = _met(left.select(*keys, *columns, "label", "scores"), right.select(*keys, *columns, "label"), _negatives(negatives, low, high),
               "anchor bigint, nth int, negative bigint, negative_id bigint, negative_score bigint")
    found = _first(met, ["anchor", "nth"], "negative_score", "negative_id", "negative", negatives)
    pairs = best.select("anchor", (F.col("rank") - 1).alias("nth"), "positive_id", "positive_score")
    names = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    joined = reduce(lambda one, other: one.join(other[0], other[1]), [(pairs, ["anchor", "nth"]), (names, "anchor")], found)
    return joined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
