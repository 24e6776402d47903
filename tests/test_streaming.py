from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from tellerframe.schemas import RAW_TRANSACTIONS
from tellerframe.sources.storage import fresh_path
from tellerframe.streaming import ingest


def arrival(spark, landing, *data):
    full = [(i, "ACC1", "Debit", "ATM", Decimal(a), "CAD", None, day, "10:00:00", "Completed", "x", "S", ts) for i, a, day, ts in data]
    spark.createDataFrame(full, RAW_TRANSACTIONS).coalesce(1).write.mode("append").parquet(landing)


def run(spark, landing, table, state, rules):
    stream = ingest.read_landing(spark, landing, RAW_TRANSACTIONS, files_per_batch=1)
    ingest.ingest(stream, table, state, rules).awaitTermination()
    return sorted((r.transaction_id, int(r.amount), str(r.transaction_date)) for r in spark.read.parquet(table).collect())


def test_batches_merge_by_version(spark, rules):
    landing, table, state = (fresh_path(spark, p) for p in ("landing", "table", "state"))
    arrival(spark, landing, ("A", 1, "2024-01-05", "t1"), ("B", 1, "2024-01-06", "t2"))
    assert run(spark, landing, table, state, rules) == [("A", 1, "2024-01-05"), ("B", 1, "2024-01-06")]
    # late row for a loaded month, a correction that moves months, and an outdated copy
    arrival(spark, landing, ("C", 1, "2024-01-01", "t1"), ("A", 2, "2024-02-05", "t3"), ("B", 9, "2024-01-06", "t1"))
    expected = [("A", 2, "2024-02-05"), ("B", 1, "2024-01-06"), ("C", 1, "2024-01-01")]
    assert run(spark, landing, table, state, rules) == expected
    # nothing new arrives: nothing changes
    assert run(spark, landing, table, state, rules) == expected


def test_replayed_batch_changes_nothing(spark, rules):
    table = fresh_path(spark, "table")
    landing = fresh_path(spark, "landing")
    arrival(spark, landing, ("A", 1, "2024-01-05", "t1"), ("A", 1, "2024-01-05", "t1"))
    batch = spark.read.schema(RAW_TRANSACTIONS).parquet(landing)
    for _ in range(2):
        ingest.merge_batch(batch, table, rules)
    assert spark.read.parquet(table).count() == 1


def test_late_rows_are_counted_and_handed_on(spark):
    path, given = fresh_path(spark, "split"), []
    make = lambda *rows: spark.createDataFrame([(i, t and datetime.fromisoformat(t)) for i, t in rows], "id string, at timestamp")
    first = make(("a", "2024-01-10"), ("a", "2024-01-09"), (None, "2024-01-01"), (None, "2024-01-02"), ("b", None))
    second = make(("a", "2024-01-11"), ("c", "2024-01-08"), ("d", "2024-01-09"), ("d", "2024-01-12"), ("b", None), (None, "2024-01-10"))
    for batch in (0, 1, 1):  # the second batch is run again
        ingest.split_batch((first, second)[batch], batch, "id", "at", "1 day", path, lambda late: given.append([r.id for r in late.collect()]))
    stored = {r.batch_id: (r.rows_in, r.kept, r.duplicates, r.late) for r in spark.read.parquet(f"{path}/counts").collect()}
    assert stored == {0: (5, 3, 2, 0), 1: (6, 3, 2, 1)}
    assert given == [[], ["c"], ["c"]]
    kept = sorted((str(r.id), str(r.at)[:10]) for r in spark.read.parquet(f"{path}/kept").filter("batch_id = 1").collect())
    assert kept == [("None", "2024-01-10"), ("b", "None"), ("d", "2024-01-09")]
