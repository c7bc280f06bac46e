import datetime as dt

import pytest

from ledgerbrook.operators import incremental
from ledgerbrook.sources import lake, state
from ledgerbrook.sources.schemas import RAW

BRANCHES = "branch_id string, branch_name string, city string, state string, branch_type string"


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_round_trip_of_each_format(rows, spark, tmp_path, fmt):
    data = [("B1", "Main, \"old\"", "X", "Y", None), ("B2", "Side", None, "Y", "Rural")]
    path = lake.write_files(rows(data, BRANCHES), str(tmp_path / "b"), fmt)
    df = lake.read_raw(spark, path, "branches", fmt)
    assert df.schema == RAW["branches"]
    assert sorted(map(tuple, df.collect())) == data


def test_bad_values_do_not_fail_a_load(spark, tmp_path):
    (tmp_path / "t").mkdir()
    header = "transaction_id,account_id,transaction_type,amount,timestamp,merchant_id,location,payment_method,status,channel,ingestion_timestamp"
    for n, line in enumerate(["T1,A1,UPI,abc,never,M1,X,Card,SUCCESS,ATM,2024-01-01 00:00:00",
                              "T2,A1,UPI,1.5,2024-01-01 10:00:00,M1,X,Card,SUCCESS,ATM,nonsense"]):
        (tmp_path / "t" / f"transactions_batch_{n:04d}.csv").write_text(f"{header}\n{line}\n")
    df = lake.read_raw(spark, str(tmp_path / "t"), "transactions")
    got = {r.transaction_id: (r.amount, r.ingestion_timestamp) for r in df.collect()}
    assert got == {"T1": ("abc", "2024-01-01 00:00:00"), "T2": ("1.5", "nonsense")}
    stamped = lake.stamped(df, "b7", dt.datetime(2024, 2, 2))
    got = {r.transaction_id: (r.ingestion_timestamp, r.ingestion_text, r.batch_id) for r in stamped.collect()}
    assert got == {"T1": (dt.datetime(2024, 1, 1), "2024-01-01 00:00:00", "b7"), "T2": (None, "nonsense", "b7")}
    absent = lake.stamped(df.drop("ingestion_timestamp"), "b7", dt.datetime(2024, 2, 2))
    assert {r.ingestion_timestamp for r in absent.collect()} == {dt.datetime(2024, 2, 2)}
    by_file = lake.stamped(lake.with_file_time(df.drop("ingestion_timestamp")), "b7", dt.datetime(2001, 2, 2))
    assert by_file.where("ingestion_timestamp > timestamp_ntz'2020-01-01'").count() == 2
    assert [f.rsplit("/", 1)[1] for f in lake.list_files(df)] == [
        "transactions_batch_0000.csv", "transactions_batch_0001.csv"]
    assert {r.file_name: r.records for r in lake.files_manifest(df).collect()} == {
        "transactions_batch_0000.csv": 1, "transactions_batch_0001.csv": 1}
    summary = lake.ingestion_summary({"transactions": df})
    assert sorted(map(tuple, summary.collect())) == [("TOTAL", 2, 2), ("transactions", 2, 2)]
    summary = lake.ingestion_summary({"transactions": df}, {"transactions": "s3a://lake/t"}, {"transactions": 1.5})
    assert sorted(map(tuple, summary.collect())) == [("TOTAL", 2, 2, None, 1.5), ("transactions", 2, 2, "s3a://lake/t", 1.5)]


def test_unknown_formats_and_layers_are_refused(rows, tmp_path):
    with pytest.raises(ValueError):
        lake.write_files(rows([(1,)], "x int"), str(tmp_path), "xlsx")
    with pytest.raises(ValueError):
        lake.layer_path("root", "cooked", "things")
    assert lake.layer_path("s3a://bucket/lake/", "raw", "accounts") == "s3a://bucket/lake/raw/accounts"


def test_partitioned_write_replaces_only_its_partitions(rows, spark, tmp_path):
    path = str(tmp_path / "p")
    lake.write_files(rows([(1, 1, "a"), (1, 2, "b")], "m int, d int, v string"), path, partition_by=("m", "d"))
    lake.write_files(rows([(1, 2, "c")], "m int, d int, v string"), path, partition_by=("m", "d"))
    df = spark.read.parquet(path)
    assert sorted((r.d, r.v) for r in df.collect()) == [(1, "a"), (2, "c")]
    pruned = df.where("m = 1 and d = 2")
    assert len(pruned.inputFiles()) == 2 and "PartitionFilters: [isnotnull(m" in _plan(pruned)


def _plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_empty_datasets_have_their_schema(spark):
    df = lake.empty(spark, "accounts")
    assert df.schema == RAW["accounts"] and df.count() == 0


def test_union_fills_missing_columns(rows):
    df = lake.union_batches([rows([("a", 1)], "k string, v int"), rows([("b",)], "k string")])
    assert sorted(map(tuple, df.collect())) == [("a", 1), ("b", None)]


def test_samples_are_exact_and_repeatable(rows):
    df = rows([(f"k{i}",) for i in range(50)], "k string")
    one = sorted(r.k for r in lake.sample_n(df, "k", 20).collect())
    assert len(set(one)) == 20
    assert one == sorted(r.k for r in lake.sample_n(df.repartition(7), "k", 20).collect())
    assert one != sorted(r.k for r in lake.sample_n(df, "k", 20, seed=7).collect())
    assert lake.sample_n(df, "k", 500).count() == 50


# ---- watermarks -------------------------------------------------------------------------


def test_watermark_log(spark, tmp_path):
    root = str(tmp_path)
    assert state.get_last_watermark(spark, root, "transactions") == "1970-01-01T00:00:00"
    state.update_watermark(spark, root, "transactions", dt.datetime(2024, 1, 2), "r1")
    state.update_watermark(spark, root, "accounts", dt.datetime(2025, 1, 2), "r1")
    state.update_watermark(spark, root, "transactions", dt.datetime(2024, 1, 3, 4, 5, 6, 7), "r2")
    assert state.get_last_watermark(spark, root, "transactions") == "2024-01-03T04:05:06.000007"
    assert state.get_last_watermark(spark, root, "accounts") == "2025-01-02T00:00:00"


def test_incremental_filters(rows):
    df = rows([(i, dt.datetime(2024, 1, d)) for i, d in enumerate([10, 13, 14, 15, 16])],
              "transaction_id int, ingestion_timestamp timestamp_ntz")
    ids = lambda out: sorted(r.transaction_id for r in out.collect())
    assert ids(incremental.newer_than(df, "2024-01-15 00:00:00")) == [4]
    assert ids(incremental.newer_or_late(df, "2024-01-15T00:00:00")) == [2, 3, 4]
    assert ids(incremental.newer_or_late(df, "1970-01-01T00:00:00")) == [0, 1, 2, 3, 4]
    following = lambda out: incremental.next_watermark(out, "2024-01-15 00:00:00").first().last_processed
    assert following(df) == dt.datetime(2024, 1, 16)
    assert following(df.where("transaction_id = 0")) == dt.datetime(2024, 1, 15)
    assert following(df.limit(0)) == dt.datetime(2024, 1, 15)


def test_published_versions(rows, spark, tmp_path):
    root = str(tmp_path)
    assert state.read_published(spark, root, "t") is None
    state.publish(rows([(1,)], "x int"), root, "t", "r1")
    one = state.read_published(spark, root, "t")
    state.publish(one.selectExpr("x + 1 as x"), root, "t", "r2")
    assert [r.x for r in state.read_published(spark, root, "t").collect()] == [2]
    assert [r.x for r in state.read_published(spark, root, "t", not_by="r2").collect()] == [1]
    state.publish(state.read_published(spark, root, "t", not_by="r2").selectExpr("x + 1 as x"), root, "t", "r2")
    assert [r.x for r in state.read_published(spark, root, "t").collect()] == [2]


def test_run_rows_are_replaced_not_added(rows, spark, tmp_path):
    root = str(tmp_path)
    row = rows([("c", "RANGE", 3, 2, 1)], "check_name string, check_type string, total_records long, passed_records long, failed_records long")
    for run in ("007", "008", "008"):
        state.write_run(row, root, "quality_results", run, "accounts")
    got = state.read_state(spark, root, "quality_results")
    assert sorted((r.run_id, r.dataset, r.failed_records) for r in got.collect()) == [
        ("007", "accounts", 1), ("008", "accounts", 1)]
