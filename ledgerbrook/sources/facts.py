"""The stored fact table: days replaced as a whole, and an index of the days that hold a key.

Every merge writes the days it changes as a new version directory and then puts them in force by one append to the log
of days: readers see all of a merge or nothing of it, and one that fails leaves the table as it was. No
file is ever overwritten. The index is a bucketed table of (key, day), sorted by key, to which every merge adds its rows
before the fact changes: it may name a day that no longer holds a key, never miss one that does. A
batch is joined to it bucket by bucket, so the days concerned are known without opening the fact table.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerbrook.operators import fraud, sets
from ledgerbrook.operators.lookup import lookup
from ledgerbrook.sources import lake, state
from ledgerbrook.sources.schemas import ACCOUNT_DAY, ACCOUNT_TOTAL, ACTIVE_DAY, FACT

DAY_PARTITIONS = ("year", "month", "day")
FACTS, ACCOUNT_DAYS, PREFIXES, ACTIVE = "fact_transactions", "account_days", "account_totals", "active_accounts"
#: Buckets of an index, for its whole life.
BUCKETS = 64


def day_number() -> Column:
    """yyyyMMdd of a row's partition."""
    return F.col("year") * 10000 + F.col("month") * 100 + F.col("day")


def in_days(df: DataFrame, days: list[int]) -> DataFrame:
    """Rows of the given days (yyyyMMdd); a condition on partition columns alone."""
    return df.where(day_number().isin(days))


# ---- tables by day ---------------------------------------------------------------------------------


def table_path(root: str, table: str) -> str:
    return lake.layer_path(root, "curated", table)


def days_in_force(spark: SparkSession, root: str, table: str = FACTS) -> DataFrame:
    """day, version, records: the latest entry of every day in the log. One row per day, so few."""
    latest = F.max_by(F.struct("version", "records"), F.struct("put_at", "version"))
    log = state.read_state(spark, root, "days_in_force").where(F.col("dataset") == table)
    return log.groupBy("day").agg(latest.alias("v")).select("day", "v.*")


def read_days(spark: SparkSession, root: str, table: str, schema: StructType, wanted: Column | None = None) -> DataFrame:
    """A table by day as it is in force under its declared schema, with the partition columns; empty before its first row.

    `wanted` is a condition on the number `day`: other days are not listed. The frame names its files' directories, so
    later merges don't disturb it.
    """
    held = days_in_force(spark, root, table).where("records > 0")
    rows = (held if wanted is None else held.where(wanted)).orderBy("day").collect()
    if not rows:
        return spark.createDataFrame([], schema)
    base = table_path(root, table)
    paths = [f"{base}/version={r['version']}/year={r['day'] // 10000}/month={r['day'] // 100 % 100}/day={r['day'] % 100}" for r in rows]
    stored = StructType([*schema]).add("version", "string")
    return spark.read.option("basePath", base).schema(stored).parquet(*paths).drop("version")


def read_fact(spark: SparkSession, root: str, days: list[int] | None = None) -> DataFrame:
    """The fact table, or some days of it."""
    return read_days(spark, root, FACTS, FACT, None if days is None else F.col("day").isin(days))


def replace_days(df: DataFrame, root: str, days: list[int], run_id: str, put_at: dt.datetime | None = None, table: str = FACTS) -> None:
    """Put `df` (all rows of the given days, with the partition columns) in force for these days, at once."""
    spark = df.sparkSession
    version = f"{run_id}-{uuid.uuid4().hex[:8]}"
    path = f"{table_path(root, table)}/version={version}"
    lake.write_files(df, path, partition_by=DAY_PARTITIONS)
    counted = spark.read.schema(df.schema).parquet(path).groupBy(day_number().alias("day")).agg(F.count("*").alias("records"))
    _put(spark, root, table, {d: 0 for d in days} | {r["day"]: r["records"] for r in counted.collect()}, version, run_id, put_at)


def drop_days(spark: SparkSession, root: str, days: list[int], run_id: str, table: str) -> None:
    """Take days out of force."""
    if days:
        _put(spark, root, table, dict.fromkeys(days, 0), "", run_id)


def _put(spark: SparkSession, root: str, table: str, records: dict[int, int], version: str, run_id: str, put_at: dt.datetime | None = None) -> None:
    now = put_at or dt.datetime.now(dt.timezone.utc)
    entries = [(table, d, version, n, run_id, now) for d, n in sorted(records.items())]
    log = spark.createDataFrame(entries, "dataset string, day int, version string, records long, run_id string, put_at timestamp")
    state.append_state(log.coalesce(1), root, "days_in_force")  # one file, hence seen as a whole


# ---- totals of the time before a day ------------------------------------------------------------------


def add_account_days(spark: SparkSession, root: str, days: list[int], run_id: str) -> None:
    """Summarise the given days of the fact table per account. Carried totals of later months are void."""
    first = min(days)
    later = days_in_force(spark, root, PREFIXES).where((F.col("records") > 0) & (F.col("day") > first)).collect()
    drop_days(spark, root, [r["day"] for r in later], run_id, PREFIXES)
    summary = fraud.account_days(read_fact(spark, root, days))
    replace_days(_by_day(summary, "tx_date"), root, days, run_id, table=ACCOUNT_DAYS)


def _by_day(df: DataFrame, column: str) -> DataFrame:
    return df.withColumns({"year": F.year(column), "month": F.month(column), "day": F.dayofmonth(column)})


def read_account_days(spark: SparkSession, root: str, since: int = 0, until: int = 99_999_999) -> DataFrame:
    """Account days of since <= day < until."""
    return read_days(spark, root, ACCOUNT_DAYS, ACCOUNT_DAY, (F.col("day") >= since) & (F.col("day") < until)).drop(*DAY_PARTITIONS)


def _parts(spark: SparkSession, root: str, until: int) -> tuple[int, DataFrame]:
    """The first day of the latest month whose carried totals are in force, at or before `until`, and the totals per
    account to be merged into those before `until`: the carried ones, and the days since."""
    held = days_in_force(spark, root, PREFIXES).where((F.col("records") > 0) & (F.col("day") <= until))
    start = held.agg(F.max("day")).first()[0] or 0
    columns = ["account_id", "n", "total", "first_at"]
    carried = read_days(spark, root, PREFIXES, ACCOUNT_TOTAL, F.col("day") == start).select(*columns)
    return start, carried.unionByName(read_account_days(spark, root, start, until).select(*columns))


def totals_before(spark: SparkSession, root: str, day: int, run_id: str) -> DataFrame:
    """account_id, n, total, first_at: totals per account to be merged into those of all days before `day` (yyyyMMdd).

    They are carried to the beginning of a month the first time one is asked for, so what is read is one
    row per account and the days since. Rows of an account may be several: `fraud.merged_totals` adds them.
    """
    month = day // 100 * 100 + 1
    start, parts = _parts(spark, root, month)
    between = (F.col("records") > 0) & (F.col("day") >= start) & (F.col("day") < month)
    if start < month and days_in_force(spark, root, ACCOUNT_DAYS).where(between).limit(1).count():
        carried = fraud.merged_totals(parts, "account_id").withColumns(
            {"year": F.lit(month // 10000), "month": F.lit(month // 100 % 100), "day": F.lit(1)})
        replace_days(carried, root, [month], run_id, table=PREFIXES)
    return _parts(spark, root, day)[1]


# ---- sets of active accounts ---------------------------------------------------------------------------


def add_active_accounts(spark: SparkSession, root: str, days: list[int], run_id: str, high_value_above: float) -> None:
    """Collect the accounts of the given days as sets, and of other days of their months that have none yet.

    `high_value_above` is fixed in the stored days: after a change of it they have to be taken out of force (`drop_days`).
    """
    months = sorted({d // 100 for d in days})
    in_months = F.floor(F.col("day") / 100).isin(months) & (F.col("records") > 0)
    held, stored = (days_in_force(spark, root, t).where(in_months) for t in (FACTS, ACTIVE))
    lacking = [r["day"] for r in held.select("day").exceptAll(stored.select("day")).collect()]
    days = sorted({*days, *lacking})
    fact = read_fact(spark, root, days)
    known = state.read_state(spark, root, "account_numbers")
    fresh = lookup(fact.select("account_id").where("account_id is not null").distinct(), known.select("account_id"), "account_id", "left_anti")
    path = f"{root}/processed/new_accounts/run_id={run_id}"
    lake.write_files(fresh, path)
    fresh = spark.read.parquet(path)
    state.append_state(sets.numbered(fresh, "account_id", known, sets.lots_for(fresh.count())), root, "account_numbers")
    active = sets.active_accounts(fact, read_numbers(spark, root), list(DAY_PARTITIONS), high_value_above)
    replace_days(active, root, days, run_id, table=ACTIVE)


def read_numbers(spark: SparkSession, root: str) -> DataFrame:
    """account_id, number: numbers are given once and never change."""
    return state.read_state(spark, root, "account_numbers")


def read_active_accounts(spark: SparkSession, root: str, months: list[int]) -> DataFrame:
    """The sets of the days of the given months (yyyyMM), with their `month_id`."""
    rows = read_days(spark, root, ACTIVE, ACTIVE_DAY, F.floor(F.col("day") / 100).isin(months))
    return rows.withColumn("month_id", F.col("year") * 100 + F.col("month"))


# ---- keys ----------------------------------------------------------------------------------------


def index_table(spark: SparkSession, root: str, key: str) -> str:
    """Name of the index in this session's catalog; its files are under the root, whatever session made them."""
    location = f"{lake.layer_path(root, 'curated', 'fact_key_days')}/{key}"
    name = f"fact_key_days_{hashlib.md5(location.encode()).hexdigest()[:16]}"
    spark.sql(
        f"create table if not exists {name} ({key} string, day int) using parquet "
        f"clustered by ({key}) sorted by ({key}) into {BUCKETS} buckets location '{location}'"
    )
    return name


def days_of(spark: SparkSession, root: str, keys: DataFrame, key: str) -> DataFrame:
    """The distinct days that may hold one of the keys (one row per key)."""
    index = spark.table(index_table(spark, root, key))
    return index.join(keys.select(key), key, "left_semi").select("day").distinct()


def index_days(df: DataFrame, root: str, key: str) -> None:
    """Add the rows' keys with their days, one sorted file per bucket."""
    name = index_table(df.sparkSession, root, key)
    rows = df.where(F.col(key).isNotNull()).select(key, day_number().cast("int").alias("day"))
    rows.repartition(BUCKETS, key).write.mode("append").insertInto(name)
    df.sparkSession.catalog.refreshTable(name)
