"""Session helpers: literal tables and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_ARROW = {
    "int": pa.int32(),
    "bigint": pa.int64(),
    "string": pa.string(),
    "boolean": pa.bool_(),
    "double": pa.float64(),
    "array<string>": pa.list_(pa.string()),
    "timestamp": pa.timestamp("us", tz="UTC"),
}


# rows that may be broadcast at most, of some hundred bytes each in memory, however few their files have
BROADCAST_ROWS = 250_000


def literal_table(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A small table given in code.

    Built from Arrow so that Spark knows its true size (a table from a Python
    list has no statistics and is planned as if it were huge).
    """
    fields = T._parse_datatype_string(schema).fields
    columns = [
        pa.array([row[i] for row in rows], type=_ARROW[f.dataType.simpleString()])
        for i, f in enumerate(fields)
    ]
    return spark.createDataFrame(pa.table(columns, names=[f.name for f in fields]))


def shared_dir(spark: SparkSession) -> str:
    """The folder for written intermediate tables, visible to every executor.

    It is the folder the cluster names in ``spark.checkpoint.dir``.  Only a
    local session without that setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    made = tempfile.mkdtemp(prefix="lexigrid-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows as a table in the shared folder.

    Cuts the lineage, survives lost executors, and tells Spark the size of its files,
    so that joins with it are broadcast when it is small; see ``bounded``.  The folder
    is the caller's to clean, like any checkpoint folder.
    """
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded(table: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A written table that a join does not broadcast if it has more than ``most`` rows.

    Spark goes by the size of the files, where neighbouring keys and repeated values take next to nothing; the driver
    and each executor hold every row in full.  The rows are counted from the files' footers.
    """
    return table.hint("merge") if table.count() > most else table
