from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tellerframe.operators.upsert import newer_than, upsert
from tellerframe.schemas import RAW_TRANSACTIONS
from tellerframe.sinks import exports, tables
from tellerframe.sources import raw, seeds, storage
from tellerframe.sources.storage import fresh_path, shared_folder


def frame(spark, *data, schema="id string, month int, v int"):
    return spark.createDataFrame(list(data), schema)


@pytest.fixture
def path(spark):
    return fresh_path(spark, "test")


class TestUpsert:
    def test_replaces_and_inserts(self, spark, rows):
        out = upsert(frame(spark, ("a", 1, 1), ("b", 1, 1)), frame(spark, ("b", 2, 9), ("c", 1, 1)), ["id"])
        assert rows(out) == [("a", 1, 1), ("b", 2, 9), ("c", 1, 1)]

    def test_newer_version_wins_in_any_order(self, spark, rows):
        old, new = frame(spark, ("a", 1, 1)), frame(spark, ("a", 1, 2))
        assert rows(upsert(old, new, ["id"], "v")) == rows(upsert(new, old, ["id"], "v")) == [("a", 1, 2)]

    def test_columns_are_added(self, spark, rows):
        out = upsert(frame(spark, ("a", 1, 1)), frame(spark, ("b", 1, 2, "x"), schema="id string, month int, v int, extra string"), ["id"])
        assert rows(out, "id", "extra") == [("a", None), ("b", "x")]

    def test_null_keys_are_replaced_too(self, spark, rows):
        out = upsert(frame(spark, (None, 1, 1), ("a", 1, 1)), frame(spark, (None, 1, 2)), ["id"])
        assert rows(out, "id", "v") == [(None, 2), ("a", 1)]

    def test_needs_keys(self, spark, path):
        with pytest.raises(ValueError):
            upsert(frame(spark, ("a", 1, 1)), frame(spark, ("a", 1, 1)), [])
        with pytest.raises(ValueError):
            tables.load_table(frame(spark, ("a", 1, 1)), path, "upsert")
        with pytest.raises(ValueError):
            tables.load_table(frame(spark, ("a", 1, 1)), path, "merge")


class TestLoads:
    def test_modes_and_counts(self, spark, path, rows):
        df = frame(spark, ("a", 1, 1), ("b", 1, 1))
        assert [tables.load_table(df, f"{path}/r", "replace") for _ in range(2)] == [2, 2]
        assert [tables.load_table(df, f"{path}/a", "append") for _ in range(2)] == [2, 2]
        assert spark.read.parquet(f"{path}/r").count() == 2 and spark.read.parquet(f"{path}/a").count() == 4

    def test_empty_frame_is_skipped(self, spark, path):
        assert tables.load_table(frame(spark, ("a", 1, 1)).limit(0), path, "replace") == 0
        assert raw.read_optional(spark, path) is None

    def test_partitioned_upsert_moves_rows_and_drops_emptied_partitions(self, spark, path, rows):
        load = lambda *data: tables.load_table(frame(spark, *data), path, "upsert", ["id"], "month")
        load(("a", 1, 1), ("b", 2, 1), ("c", 3, 1), ("n", None, 1))
        load(("b", 3, 2), ("n", 1, 2), ("d", 4, 1))
        stored = spark.read.parquet(path)
        expected = [("a", 1, 1), ("b", 3, 2), ("c", 3, 1), ("d", 4, 1), ("n", 1, 2)]
        assert rows(stored, "id", "month", "v") == expected
        load(("b", 3, 2), ("n", 1, 2), ("d", 4, 1))
        assert rows(spark.read.parquet(path), "id", "month", "v") == expected

    def test_added_columns_survive_later_loads(self, spark, path, rows):
        wide = "id string, month int, v int, extra string"
        load = lambda df: tables.load_table(df, path, "upsert", ["id"], "month")
        load(frame(spark, ("a", 1, 1), ("b", 2, 1), ("c", 3, 1)))
        load(frame(spark, ("d", 3, 1, "x"), schema=wide))
        load(frame(spark, ("c", 3, 2)))
        stored = raw.read_parquet(spark, path, merge_schema=True)
        assert rows(stored, "id", "v", "extra") == [("a", 1, None), ("b", 1, None), ("c", 2, None), ("d", 1, "x")]

    def test_untouched_partitions_are_not_rewritten(self, spark, path):
        tables.load_table(frame(spark, ("a", 1, 1), ("b", 2, 1)), path, "upsert", ["id"], "month")
        before = {r[0] for r in spark.read.parquet(path).filter("month = 1").select(F.input_file_name()).collect()}
        tables.load_table(frame(spark, ("b", 2, 5)), path, "upsert", ["id"], "month")
        after = {r[0] for r in spark.read.parquet(path).filter("month = 1").select(F.input_file_name()).collect()}
        assert before == after

    def test_month_write_replaces_only_its_months(self, spark, path, rows):
        schema = "id string, day date"
        tables.write_by_month(frame(spark, ("a", date(2024, 1, 5)), ("b", date(2024, 2, 5)), schema=schema), path, "day", ["id"])
        tables.write_by_month(frame(spark, ("c", date(2024, 2, 6)), schema=schema), path, "day", ["id"])
        assert rows(spark.read.parquet(path), "id", tables.MONTH) == [("a", 202401), ("c", 202402)]

    def test_evolving_append(self, spark, path, rows):
        tables.write_staged(frame(spark, ("a",), schema="id string"), path)
        merged = tables.append_evolving(frame(spark, ("b", 1), schema="id string, extra int"), path)
        assert rows(merged, "id", "extra") == [("a", None), ("b", 1)]

    def test_arrival_mark(self, spark):
        df = frame(spark, (date(2024, 1, 1),), (date(2024, 1, 9),), (date(2024, 1, 10),), (None,), schema="arrived date")
        assert newer_than(df, "arrived", None).count() == 4
        assert newer_than(df, "arrived", date(2024, 1, 9)).count() == 3

    def test_arrived_keys_without_rows_go(self, spark, path, rows):
        load = lambda keys, *data: tables.load_table(frame(spark, *data), path, "upsert", ["id"], "month", keys=keys)
        load(None, ("a", 1, 1), ("b", 1, 1), ("c", 2, 1))
        load(frame(spark, ("b",), ("c",), schema="id string"), ("b", 1, 2))
        assert rows(spark.read.parquet(path), "id", "v") == [("a", 1), ("b", 2)]

    def test_a_broken_off_replacement_is_found_again(self, spark, path, rows, monkeypatch):
        table = f"{path}/t"
        tables.load_table(frame(spark, ("a", 1, 1)), table, "replace")
        real = storage._hadoop

        class Dies:
            """A file system whose driver is lost before the new table is in place."""

            def __init__(self, files):
                self.files = files

            def __getattr__(self, name):
                return getattr(self.files, name)

            def rename(self, source, target):
                if ".new-" in source.toString():
                    raise KeyboardInterrupt
                return self.files.rename(source, target)

        monkeypatch.setattr(storage, "_hadoop", lambda s, p: (real(s, p)[0], Dies(real(s, p)[1])))
        with pytest.raises(KeyboardInterrupt):
            tables.load_table(frame(spark, ("b", 1, 1)), table, "replace")
        monkeypatch.undo()
        assert rows(raw.read_optional(spark, table), "id") == [("a",)]
        tables.load_table(frame(spark, ("b", 1, 1)), table, "replace")
        assert rows(spark.read.parquet(table), "id") == [("b",)]


class TestSources:
    def test_csv_round_trip_and_corrupt_rows(self, spark, path, tmp_path):
        file = tmp_path / "t.csv"
        file.write_text("a,b\n1,x\nbad,y\n")
        from pyspark.sql import types as T

        schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
        got = {r.b: (r.a, r["_corrupt_record"]) for r in raw.read_raw_csv(spark, str(file), schema, keep_corrupt=True).collect()}
        assert got == {"x": (1, None), "y": (None, "bad,y")}

    def test_missing_table_is_optional(self, spark, path, rows):
        assert raw.read_optional(spark, path) is None
        tables.write_staged(frame(spark, ("a", 1, 1)), f"{path}/t")
        report = raw.optional_inventory(spark, {"t": f"{path}/t", "u": f"{path}/u"})
        assert rows(report) == [("t", "loaded", 1), ("u", "skipped", None)]

    def test_ingest_order_is_fixed_and_unique(self, spark):
        numbered = raw.with_ingest_order(spark.range(100).repartition(4))
        first = {(r.id, r["_ingest_order"]) for r in numbered.collect()}
        assert first == {(r.id, r["_ingest_order"]) for r in numbered.collect()}
        assert len({n for _, n in first}) == 100

    def test_seeds(self, spark, tmp_path):
        assert seeds.merchant_categories(spark).count() == 12
        file = tmp_path / "m.csv"
        file.write_text("merchant_category,category_group,is_essential\nGas,Transportation,true\n")
        assert seeds.merchant_categories(spark, str(file)).first() == ("Gas", "Transportation", True)

    def test_shared_folder_follows_the_session(self, spark):
        assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")

    def test_raw_schema_of_a_landing_file(self, spark, path):
        row = ("T1", "A1", "Debit", "Online", None, "CAD", None, "2024-01-01", "10:00:00", "Completed", "d", "S", "ts")
        tables.write_landing_csv(spark.createDataFrame([row], RAW_TRANSACTIONS), f"{path}/transactions_raw.csv")
        assert raw.read_feed_csv(spark, path, "transactions_raw").first() == row


def test_quarantine_file_only_with_rows(spark, path):
    bad = frame(spark, ("a", ["r1", "r2"]), schema="id string, reasons array<string>")
    assert not exports.write_quarantine(bad.limit(0), path, "d", "2024-01-01")
    assert not storage.path_exists(spark, f"{path}/dataset=d/run_date=2024-01-01")
    assert all(exports.write_quarantine(bad, path, "d", "2024-01-01") for _ in range(2))
    assert spark.read.option("header", True).csv(path).count() == 1
    assert spark.read.option("header", True).csv(path).first().reasons == "r1;r2"


def test_file_order_does_not_depend_on_tasks(spark):
    """Files of unlike size are packed out of order; the numbers follow names and places all the same."""
    from tellerframe.sources.raw import with_file_order

    path = fresh_path(spark, "files")
    sizes = [1, 400, 3, 2000, 50]
    start = 0
    for at, size in enumerate(sizes):
        spark.range(start, start + size, 1, 1).selectExpr("id", "repeat('x', 50) AS pad").coalesce(1).write.option("header", True).csv(f"{path}/{at}")
        start += size
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for split in ("128m", "20k", "2k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            rows = with_file_order(spark.read.option("header", True).schema("id long, pad string").csv([f"{path}/{i}" for i in range(len(sizes))]))
            assert rows.filter("id <> _ingest_order").isEmpty() and rows.count() == start
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
