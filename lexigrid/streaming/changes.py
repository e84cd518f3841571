"""Keeping an index current from a stream of changes.

A change is the whole new content of one document: its rows share
``(site, id, ts, seq)``.  Changes are appended to a log; whoever reads the log
lets the newest change of each document win, so late and repeated rows are
harmless and no state or watermark is needed.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexigrid.model import CHANGES
from lexigrid.sources.elements import without_drafts

_CHANGE = ["site", "id", "ts", "seq"]


def change_log(spark: SparkSession, path: str) -> DataFrame:
    """Everything logged so far."""
    return spark.read.schema(f"{CHANGES}, stream string, batch bigint").parquet(path).drop("stream", "batch")


def stream_index(
    changes: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append a stream of changes, drafts left out, to the log at ``path``.

    Each micro-batch of each stream owns a folder and replaces it when replayed,
    so a restart adds nothing twice, and several streams can share a log.  A
    stream is known by its checkpoint.
    """
    stream = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()

    def append(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/stream={stream}/batch={batch_id}")

    return (
        without_drafts(changes)
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def newest_changes(log: DataFrame) -> DataFrame:
    """Rows of each document's newest change, deletes included.

    The newest key is found by aggregation, which combines before the shuffle,
    and joined back on the whole key, so one document with most of the changes
    never gathers in one task.
    """
    newest = log.groupBy("site", "id").agg(F.max(F.struct("ts", "seq")).alias("_last"))
    keys = newest.select("site", "id", "_last.ts", "_last.seq")
    return log.join(keys, _CHANGE, "left_semi").select(*log.columns)


def latest_wins(log: DataFrame) -> DataFrame:
    """The documents as the log leaves them: newest content, deleted ones gone."""
    return newest_changes(log).where(F.col("op") != "delete")


def apply_log(keywords: DataFrame, log: DataFrame) -> DataFrame:
    """Keyword rows after all logged changes."""
    newest = newest_changes(log)
    touched = log.select("site", "id").distinct()
    kept = keywords.join(touched, ["site", "id"], "left_anti")
    content = newest.where(F.col("op") != "delete")
    return kept.unionByName(content.select(*keywords.columns))
