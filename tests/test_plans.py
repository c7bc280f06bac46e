"""Physical plans: what is pushed down, broadcast, split and kept out of Python."""

import datetime as dt
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from ledgerbrook.operators import cleansing, fraud, incremental, quality
from ledgerbrook.operators.dedup import latest_per_key
from ledgerbrook.operators.lookup import lookup
from ledgerbrook.plans.queries import REGISTRY

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def conf(spark, **settings):
    names = {k.replace("__", "."): v for k, v in settings.items()}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@contextmanager
def tiny_skew_limits(spark):
    with conf(spark, **{
        "spark__sql__autoBroadcastJoinThreshold": "-1",
        "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
        "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
        "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2.0",
        "spark__sql__adaptive__advisoryPartitionSizeInBytes": "16KB",
        "spark__sql__shuffle__partitions": "8",
    }):
        yield


spark_conf_defaults = {"spark.sql.adaptive.autoBroadcastJoinThreshold": str(10 * 1024 * 1024)}


@pytest.fixture(autouse=True)
def known_conf(spark):
    for k, v in spark_conf_defaults.items():
        spark.conf.set(k, v)


def skewed(spark, n=60000):
    """A third of the rows on one key, a tenth on NULL."""
    return spark.range(0, n, 1, 8).selectExpr(
        "id", "case when id % 3 = 0 then 7 when id % 10 = 1 then null else id % 2000 end k",
        "cast(id * 7919 as string) payload")


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_a_hot_key_is_split_over_tasks(spark, how):
    left = skewed(spark)
    right = latest_per_key(spark.range(0, 4000, 1, 4).selectExpr("id % 1500 as k", "id as v"), "k")
    plain = lookup(left, right, "k", how)
    expected = sorted(map(str, plain.collect()))
    with tiny_skew_limits(spark):
        df = lookup(left, right, "k", how)
        assert sorted(map(str, df.collect())) == expected
        assert "skew=true" in plan(df)


def test_a_hot_repeated_key_is_split_over_tasks(spark):
    with tiny_skew_limits(spark):
        _, failed, _ = quality.check_uniqueness(skewed(spark), "k")
        assert failed.count() == skewed(spark).where("k is not null").count()
        rows = failed.select("id")
        rows.collect()
        assert "skew=true" in plan(rows)


def test_hot_instants_are_split_on_the_way_back(spark):
    """A third of all transactions at one instant of one account."""
    tx = spark.range(0, 30000, 1, 8).selectExpr(
        "cast(id as string) transaction_id", "case when id % 3 = 0 then 'HOT' else concat('A', id % 997) end account_id",
        "cast(1 as decimal(15,2)) amount", "'SUCCESS' status", "'X' location",
        "case when id % 3 = 0 then timestamp_ntz'2024-01-01' else timestampadd(SECOND, cast(id as int) * 40, timestamp_ntz'2024-01-01') end transaction_timestamp")
    with tiny_skew_limits(spark):
        df = fraud.high_velocity(tx)
        got = df.groupBy("account_id").count().collect()
        hits = fraud.high_velocity(tx).select("transaction_id")
        hits.collect()
        assert "skew=true" in plan(hits)
    assert [tuple(r) for r in got] == [("HOT", 10000)]


def test_a_hot_day_is_cut_by_hours(spark):
    """A third of all transactions on one account within one day, at distinct instants."""
    tx = spark.range(0, 30000, 1, 8).selectExpr(
        "cast(id as string) transaction_id", "case when id % 3 = 0 then 'HOT' else concat('A', id % 997) end account_id",
        "cast(1 + id % 5 as decimal(15,2)) amount", "'SUCCESS' status", "'X' location",
        "timestampadd(SECOND, cast(case when id % 3 = 0 then id * 2 else id * 40 end as int), timestamp_ntz'2024-01-01') transaction_timestamp")
    got = {r.at: r for r in fraud.history_before(tx, "account_id").where("account_id = 'HOT'").collect()}
    assert len(got) == 10000
    count, total, first = 0, 0, None
    amounts = {r.at: r.amount for r in fraud.timed(tx).where("account_id = 'HOT'").collect()}
    for at in sorted(amounts):
        assert (got[at].prior_count, got[at].prior_amount, got[at].first_at) == (count, total, first)
        count, total, first = count + 1, total + amounts[at], at if first is None else first
    # windows: the instants of an hour, the hours of a day, the days of a party
    text = plan(fraud.history_before(tx, "account_id"))
    assert "Join" not in text and "hashpartitioning(account_id" in text
    largest = fraud.timed(tx).groupBy("account_id", F.expr("at div 3600000000")).count().agg(F.max("count")).first()[0]
    assert largest <= 600


def test_deduplication_limits_each_key_before_the_shuffle(spark):
    text = plan(latest_per_key(skewed(spark), "k"))
    final, exchange, partial = (text.index(w) for w in ("row_number(), 1, Final", "Exchange", "row_number(), 1, Partial"))
    assert final < exchange < partial


def test_points_are_counted_before_the_shuffle(spark):
    from ledgerbrook.plans import views

    text = plan(fraud.recent_activity(views.tx_events(spark, SMALL)))
    assert text.count("partial_count") >= 1
    # counts by point, windows by slice, and the last distinct: no more
    assert text.count("Exchange hashpartitioning") <= 3


def test_incremental_filter_and_columns_reach_the_scan(spark):
    from ledgerbrook.plans import views

    df = incremental.newer_than(views.tx_events(spark, SMALL), dt.datetime(2024, 1, 15)).select("transaction_id")
    text = df._jdf.queryExecution().toString()
    assert "GreaterThan(ts,2024-01-15" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_small_dimensions_are_broadcast_by_size_not_by_hint(spark):
    df = REGISTRY["enrich_transactions"](spark, SMALL)
    df.collect()
    assert "BroadcastHashJoin" in plan(df) and "SortMergeJoin" not in plan(df).split("== Initial Plan ==")[0]
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1",
              spark__sql__adaptive__autoBroadcastJoinThreshold="-1"):
        df = REGISTRY["enrich_transactions"](spark, SMALL)
        df.collect()
        assert "BroadcastHashJoin" not in plan(df)


def test_range_check_needs_no_shuffle(spark):
    df = cleansing.conform_accounts(spark.createDataFrame(
        [("A1", "C1", "1", "x")], "account_id string, customer_id string, balance string, account_status string"))
    passed, failed, _ = quality.check_range(df, "balance", 0)
    assert "Exchange" not in plan(passed) and "Exchange" not in plan(failed)
