"""Headline timings; prints one JSON line.

``BENCH_SF_DIR`` names the data (default sf0.1), ``BENCH_CPUS`` the cores.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrid import IndexStore, search
from lexigrid.model import QUERY_TERMS
from lexigrid.plans.jobs import compact, purge_orphans
from lexigrid.plans.layers import apply_changes, merge_layers
from lexigrid.session import fresh_dir, literal_table
from registry import datasets as D
from registry.queries import term


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        # splits of the size that keeps all cores of one machine busy on small data
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def thousand_queries(spark: SparkSession, store: IndexStore) -> DataFrame:
    """1,000 queries of two required terms each, from the middle of the English vocabulary."""
    words = (
        store.table("term_stats")
        .where((F.col("site") == "en") & (F.col("df") > 1))
        .orderBy(F.desc("df"), "term").limit(2000).select("term").collect()
    )
    rows = [term(i // 2, i % 2, row["term"]) for i, row in enumerate(words)]
    return literal_table(spark, QUERY_TERMS, rows)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    spark.range(1000).selectExpr("sum(id)").collect()
    times: dict[str, float] = {}

    def timed(name, work):
        start = time.time()
        work()
        times[name] = round(time.time() - start, 3)

    store = IndexStore(spark, fresh_dir(spark, "bench"), n_buckets=8)
    timed("index_build", lambda: store.write_version(D.all_keywords(spark, sf_dir), 1))
    index = store.index()
    fields = D.part_fields(spark)

    def ask(*rows, **options):
        run(search(index, literal_table(spark, QUERY_TERMS, list(rows)), fields=fields, **options))

    batch = thousand_queries(spark, store)
    ask(term(1, 0, "and"))  # start-up is not part of any query's time
    timed("one_query", lambda: ask(term(1, 0, "that"), term(1, 1, "with")))
    timed("thousand_queries", lambda: run(search(index, batch, fields=fields, k=10)))
    timed("prefix_query", lambda: ask(term(1, 0, "ther", sub_right=True)))
    timed("contains_query", lambda: ask(term(1, 0, "ouea", sub_left=True, sub_right=True)))
    timed("phrase_query", lambda: ask(term(1, 0, "of the", phrase=True)))
    timed("phrase_batch", lambda: run(search(index, D.benchmark_terms(spark, sf_dir))))
    timed("excluded_query", lambda: ask(term(1, 0, "the", exclude=True)))
    changes = D.document_changes(spark, sf_dir).withColumns(
        {"op": F.lit("upsert"), "ts": F.lit("2024-01-01").cast("timestamp"), "seq": F.lit(1).cast("bigint")}
    )
    layered = IndexStore(spark, fresh_dir(spark, "bench"), n_buckets=8)
    layered.write_version(D.all_keywords(spark, sf_dir), 1)
    timed("incremental_upsert", lambda: apply_changes(layered, changes, 2))  # a layer; rewriting the sites is compact_upsert
    index = layered.index()
    timed("layered_query", lambda: ask(term(1, 0, "that"), term(1, 1, "with")))
    timed("merge_layers", lambda: merge_layers(layered, 3))
    timed("compact_upsert", lambda: compact(store, changes, 2))
    live = D.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    timed("orphan_purge", lambda: purge_orphans(store, live, 3))  # the job: documents, postings and statistics
    print(json.dumps({
        "metric": "total seconds of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
