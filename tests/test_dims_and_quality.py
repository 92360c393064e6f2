from __future__ import annotations

import os
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.conftest import T, values
from tidelake import schemas
from tidelake.operators import dims, filters, quality
from tidelake.session import materialize
from tidelake.sinks import versions
from tidelake.sources import files



def stamp(text):
    return F.lit(text).cast("timestamp")


def codes(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "symbol_code string")


def test_dimension_keeps_ids_and_creation_times(spark):
    empty = spark.createDataFrame([], schemas.DIM_SYMBOLS)
    first = dims.build_dim(empty, codes(spark, "BTCUSDT", "ABC"), stamp("2024-01-01"))
    assert values(first, "symbol_id", "symbol_code", "base_asset", "quote_asset") == [
        (1, "ABC", "ABC", ""), (2, "BTCUSDT", "BTC", "USDT"),
    ]
    second = dims.build_dim(first, codes(spark, "AAAETH", "BTCUSDT"), stamp("2024-02-01"))
    assert values(second, "symbol_id", "symbol_code", "created_at", "updated_at") == [
        (1, "ABC", T("2024-01-01"), T("2024-01-01")),
        (2, "BTCUSDT", T("2024-01-01"), T("2024-02-01")),
        (3, "AAAETH", T("2024-02-01"), T("2024-02-01")),
    ]
    again = dims.build_dim(second, codes(spark, "AAAETH", "BTCUSDT"), stamp("2024-02-01"))
    assert values(again) == values(second)


@pytest.mark.parametrize("single_task_rows", [0, 1000])
def test_ids_are_dense_however_they_are_numbered(spark, single_task_rows):
    known = spark.createDataFrame([(40, "S005")], "symbol_id long, symbol_code string")
    new = codes(spark, *[f"S{i:03d}" for i in range(100)])
    got = dict(values(dims.assign_ids(known, new, single_task_rows), "symbol_code", "symbol_id"))
    others = [c for c in sorted(got) if c != "S005"]
    assert got["S005"] == 40 and [got[c] for c in others] == list(range(41, 140))


def test_empty_and_missing_codes_are_no_symbols(spark):
    df = spark.createDataFrame([("A",), ("A",), ("",), (None,)], "symbol string")
    assert values(dims.distinct_codes(df)) == [("A",)]


def test_join_and_rejects_split_the_rows(spark):
    dim = spark.createDataFrame([(1, "A")], "symbol_id long, symbol_code string")
    fact = spark.createDataFrame([("A", 1), ("B", 2), (None, 3)], "symbol string, v int")
    assert values(dims.with_symbol_id(fact, dim), "symbol_id", "v") == [(1, 1)]
    assert values(dims.unknown_symbols(fact, dim), "v") == [(2,), (3,)]


def test_membership(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    listed = spark.createDataFrame([(1,), (1,), (9,)], "k int")
    assert values(filters.members(df, listed, "k"), "v") == [("a",), ("b",)]
    assert values(filters.strangers(df, listed, "k"), "v") == [("c",)]


def test_required_fields(spark):
    df = spark.createDataFrame([(1, 1), (None, 2), (3, None)], "a int, b int")
    assert filters.require(df, "a", "b").count() == 1 and filters.rejects(df, "a", "b").count() == 2


def test_duplicates_nulls_and_orphans(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k int, v string")
    assert values(quality.duplicate_keys(df, ["k"])) == [(1, 2)]
    assert values(quality.null_counts(df, ["k", "v"])) == [("k", 0), ("v", 1)]
    assert values(quality.orphans(df, spark.createDataFrame([(1,)], "id int"), "k", "id"), "k") == [(2,)]


def test_reconcile_tolerance(spark):
    counts = spark.createDataFrame([("a", 10_001), ("b", 10_002), ("c", 0), ("d", 1)], "table_name string, actual long")
    base = spark.createDataFrame([("a", 10_000), ("b", 10_000), ("c", 0), ("d", 0), ("gone", 5)], "table_name string, expected long")
    assert values(quality.reconcile(counts, base), "table_name", "ok") == [
        ("a", True), ("b", False), ("c", True), ("d", False), ("gone", False),
    ]


def silver(root: Path, symbol: str, hour: str, name: str, **columns):
    folder = root / "date=2024-01-01" / f"symbol={symbol}" / f"hour={hour}"
    folder.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table(columns), folder / name)


@pytest.fixture
def lake(tmp_path):
    root = tmp_path / "trades"
    text = pa.array(["1.5", "2"])
    number = pa.array([1.5, 2.0])
    silver(root, "A", "00", "part-1.parquet", price=text, qty=text, trade_id=pa.array([1, 2]))
    silver(root, "A", "01", "part-1.parquet", price=number, qty=text, trade_id=pa.array([3, 4]))
    silver(root, "B", "00", "part-1.parquet", price=number, qty=pa.array([5, 6]), trade_id=pa.array([5, 6]))
    bad = root / "date=2024-01-01" / "symbol=B" / "hour=02"
    bad.mkdir(parents=True)
    (bad / "part-9.parquet").write_bytes(b"no parquet")
    return root


TRADES = files.with_layout(schemas._struct("price:string qty:string trade_id:long", schemas._T))


def test_drift_scan(spark, lake):
    for through_spark in (False, True):
        scan = quality.scan_drift(spark, str(lake), TRADES, through_spark)
        got = {(r.symbol, r.hour): r for r in scan.collect()}
        assert {k: r.status for k, r in got.items()} == {
            ("A", "00"): "OK", ("A", "01"): "DRIFT", ("B", "00"): "DRIFT", ("B", "02"): "ERROR"}
        assert [tuple(m) for m in got["B", "00"].mismatches] == [("price", "double", "string"), ("qty", "int64", "string")]
        assert got["A", "00"].num_rows == 2 and got["B", "02"].error
        assert values(quality.drift_summaries({"trades": scan})) == [
            ("trades", "DRIFT", 2), ("trades", "ERROR", 1), ("trades", "OK", 1)]


def test_drift_repair(spark, lake, tmp_path):
    silver(lake, "C", "00", "part-1.parquet", price=pa.array([1.0]), trade_id=pa.array(["none"]))
    scan = materialize(quality.scan_drift(spark, str(lake), TRADES))
    target = tmp_path / "fixed"
    planned = quality.repair_drift(spark, scan, str(target), TRADES, dry_run=True)
    assert {r.status for r in planned.collect()} == {"PLANNED"} and not target.exists()
    for through_spark in (False, True):     # the second run leaves the same rows
        done = materialize(quality.repair_drift(spark, scan, str(target), TRADES, through_spark=through_spark))
        assert sorted((r.path.split("symbol=")[1][:1], r.status) for r in done.collect()) == [
            ("A", "REPAIRED"), ("B", "REPAIRED"), ("C", "FAILED")]
        fixed = spark.read.schema(TRADES).parquet(str(target))
        assert values(fixed, "trade_id", "price", "qty", "symbol", "hour") == [
            (3, "1.5", "1.5", "A", "01"), (4, "2", "2", "A", "01"), (5, "1.5", "5", "B", "00"), (6, "2", "6", "B", "00"),
        ]
    one = quality.repair_drift(spark, scan, str(tmp_path / "one"), TRADES, limit=1)
    assert one.count() == 1 and spark.read.schema(TRADES).parquet(str(tmp_path / "one")).count() == 2
    assert quality.swap_repaired(spark, done, str(target), str(lake)) == 2
    assert quality.swap_repaired(spark, done, str(target), str(lake)) == 0
    good = spark.read.schema(TRADES).parquet(*[str(p) for p in lake.glob("date=*/symbol=[AB]/hour=0[01]")])
    assert good.count() == 6


def test_repair_fails_where_no_file_can_be_read(spark, lake, tmp_path):
    scan = quality.scan_drift(spark, str(lake / "date=2024-01-01" / "symbol=B" / "hour=02"), TRADES)
    with pytest.raises(RuntimeError):
        quality.repair_drift(spark, scan, str(tmp_path / "x"), TRADES)


def test_many_paths_are_dealt_to_many_tasks(spark):
    paths = spark.range(2000).selectExpr("concat('p', id) AS path")
    dealt = paths.repartition(quality.repair_tasks(2000), "path").select(F.spark_partition_id().alias("t"))
    assert dealt.distinct().count() > 100


def test_second_scan_opens_no_old_file(spark, lake, tmp_path):
    first = materialize(quality.rescan_drift(spark, str(lake), TRADES), "scan")
    before = values(first, "path", "status", "num_rows")
    old = [p for p in lake.rglob("*.parquet")]
    for p in old:       # unreadable from now on, but of the same form
        stat = p.stat()
        p.write_bytes(b"x" * stat.st_size)
        os.utime(p, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    new = lake / "date=2024-02-01/symbol=NEWUSDT/hour=00"
    spark.range(3).select(F.col("id").alias("trade_id"), F.lit("1").alias("price")).coalesce(1).write.parquet(str(new))
    second = materialize(quality.rescan_drift(spark, str(lake), TRADES, first), "scan")
    assert values(second.filter("symbol != 'NEWUSDT'"), "path", "status", "num_rows") == before
    assert values(second.filter("symbol = 'NEWUSDT'"), "status", "num_rows") == [("OK", 3)]
    # a changed file is read again, one that is gone is left out
    old[0].write_bytes(b"short")
    old[1].unlink()
    third = quality.rescan_drift(spark, str(lake), TRADES, second)
    assert third.count() == second.count() - 1
    assert [r.status for r in third.filter(F.col("path").endswith(old[0].name)).collect()] == ["ERROR"]


def test_repaired_partitions_appear_at_once(spark, tmp_path, monkeypatch):
    """A reader never sees some of the rows: not before, not after, not where publishing dies."""
    path, target = str(tmp_path / "plain"), str(tmp_path / "repaired")
    slots = [F.lit("2024-01-01").alias("date"), F.lit("00").alias("hour")]

    def put(symbol, ids, kind):
        spark.createDataFrame([(i,) for i in ids], "trade_id long").select(
            "trade_id", (F.col("trade_id") + 0.5).cast(kind).alias("price"), F.lit(symbol).alias("symbol"), *slots
        ).coalesce(1).write.mode("append").partitionBy("date", "symbol", "hour").parquet(path)

    put("A", [1, 2], "string")
    put("A", [3], "double")     # a drifted file beside a sound one
    put("B", [4], "double")
    put("C", [5], "string")
    schema = files.with_layout(schemas.RAW_TRADE)
    table = versions.VersionedTable(path, schema, {n: F.col(n) for n in files.LAYOUT})
    assert table.adopt(spark) == 3
    scan = materialize(quality.rescan_drift(spark, path, schema), "scan")
    done = materialize(quality.repair_drift(spark, scan, target, schema), "done")

    def dies(*_):
        raise OSError("gone")

    with monkeypatch.context() as m:
        m.setattr(versions, "replace_snapshot", dies)
        with pytest.raises(OSError):
            quality.publish_repaired(spark, table, scan, done, target)
    assert table.read(spark).select("trade_id").count() == 5        # still the old files, whose prices drift
    replaced = quality.publish_repaired(spark, table, scan, done, target)
    assert sorted(f.split("/")[1] for f in replaced) == ["symbol=A", "symbol=B"]
    assert values(table.read(spark), "trade_id", "price") == [(i, f"{i}.5") for i in range(1, 6)]
    # the sound partition lies where it was; a second repair finds nothing
    assert [r for r in table.listed(spark) if r[2] == "live" and r[1] == ""] == [("date=2024-01-01/symbol=C/hour=00", "", "live")]
    table.write(table.read(spark, ["date=2024-01-01/symbol=C/hour=00"]))
    assert not list((tmp_path / "plain").glob("date=*/symbol=A/hour=00/*.parquet"))     # replaced two writes ago
