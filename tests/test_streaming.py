from datetime import datetime, timedelta, timezone

from helpers import rows_of

from lexigrid.model import CHANGES
from lexigrid.session import fresh_dir, literal_table
from lexigrid.streaming.changes import apply_log, change_log, latest_wins, newest_changes, stream_index

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def changes(spark, *rows):
    made = [(s, i, op, START + timedelta(minutes=t), n, d, f, x) for s, i, op, t, n, d, f, x in rows]
    return literal_table(spark, CHANGES, made)


FIRST = [
    ("a", 1, "upsert", 5, 1, False, "f", "new"), ("a", 1, "upsert", 5, 1, False, "g", "also"),
    ("a", 2, "upsert", 1, 2, True, "f", "draft"), ("a", 3, "upsert", 1, 3, False, "f", "kept"),
    ("a", 4, "upsert", 1, 4, False, "f", "gone"),
]
SECOND = [
    ("a", 1, "upsert", 2, 5, False, "f", "late"), ("a", 4, "delete", 2, 6, False, None, None),
    ("a", 5, "upsert", 2, 7, False, "f", "tie"), ("a", 5, "upsert", 2, 8, False, "f", "tie wins"),
]
LEFT = [("a", 1, "f", "new"), ("a", 1, "g", "also"), ("a", 3, "f", "kept"), ("a", 5, "f", "tie wins")]
COLUMNS = ("site", "id", "field", "text")


def test_batches_late_rows_and_restart(spark):
    source, log, state = (fresh_dir(spark, n) for n in ("source", "log", "state"))

    def run():
        stream = spark.readStream.schema(CHANGES).parquet(source)
        stream_index(stream, log, state).awaitTermination()

    changes(spark, *FIRST).write.mode("append").parquet(source)
    run()
    changes(spark, *SECOND).write.mode("append").parquet(source)
    run()
    assert rows_of(latest_wins(change_log(spark, log)), *COLUMNS) == LEFT
    count = change_log(spark, log).count()
    run()  # nothing new: nothing added
    assert change_log(spark, log).count() == count == 8
    batch = latest_wins(changes(spark, *FIRST, *SECOND).where("not is_draft"))
    assert rows_of(batch, *COLUMNS) == LEFT


def test_hot_document_and_repeated_rows(spark):
    many = [("a", 1, "upsert", n, n, False, "f", str(n)) for n in range(300)]
    log = changes(spark, *many).repartition(7)
    assert rows_of(latest_wins(log), *COLUMNS) == [("a", 1, "f", "299")]
    plan = newest_changes(log)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_log_applied_to_documents(spark):
    base = literal_table(spark, "site string, id bigint, field string, text string",
                         [("a", 1, "h", "old"), ("a", 4, "f", "old"), ("b", 1, "f", "other")])
    found = apply_log(base, changes(spark, *FIRST, *SECOND).where("not is_draft"))
    assert rows_of(found, *COLUMNS) == sorted([*LEFT, ("b", 1, "f", "other")])


def test_two_streams_share_a_log(spark):
    log = fresh_dir(spark, "log")
    for n, row in enumerate([("a", 1, "upsert", 1, 1, False, "f", "one"), ("a", 2, "upsert", 1, 2, False, "f", "two")]):
        source = fresh_dir(spark, "source")
        changes(spark, row).write.parquet(source)
        stream_index(spark.readStream.schema(CHANGES).parquet(source), log, fresh_dir(spark, f"state{n}")).awaitTermination()
    assert rows_of(change_log(spark, log), "id", "text") == [(1, "one"), (2, "two")]
