"""The star schema: date dimension, versioned dimensions, fact table, upsert."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerbrook.functions import columns as fx
from ledgerbrook.operators import temporal
from ledgerbrook.operators.lookup import lookup
from ledgerbrook.settings import END_OF_TIME

VERSIONING = ("is_active", "valid_from", "valid_to")

FACT = (
    "transaction_id", "account_id", "customer_id", "merchant_id", "branch_id", "date_id",
    "transaction_type", "amount", "transaction_timestamp", "status", "payment_method",
    "channel", "location",
)


def dim_date(bounds: DataFrame) -> DataFrame:
    """One row per day from `first_day` to `last_day` of the one-row input."""
    days = bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("full_date"))
    day = F.dayofweek("full_date")
    return days.select(
        fx.date_id("full_date").alias("date_id"),
        "full_date",
        F.dayofmonth("full_date").alias("day_of_month"),
        F.month("full_date").alias("month"),
        F.year("full_date").alias("year"),
        F.quarter("full_date").alias("quarter"),
        F.date_format("full_date", "EEEE").alias("day_of_week"),
        day.isin(1, 7).alias("is_weekend"),
    )


def date_bounds(df: DataFrame, timestamp: str = "transaction_timestamp") -> DataFrame:
    return df.agg(F.to_date(F.min(timestamp)).alias("first_day"), F.to_date(F.max(timestamp)).alias("last_day"))


def _moment(value: dt.datetime | str) -> Column:
    return F.lit(str(value)).cast("timestamp_ntz")


def first_version(df: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    """A versioned dimension holding one active version per row."""
    return df.select(
        "*", F.lit(True).alias("is_active"), _moment(as_of).alias("valid_from"),
        _moment(END_OF_TIME).alias("valid_to"),
    )


def scd2(current: DataFrame, incoming: DataFrame, key: str, as_of: dt.datetime | str) -> DataFrame:
    """Merge a snapshot into a versioned dimension.

    A changed row closes its active version at `as_of` and opens another; a new
    key opens its first; unchanged keys and keys missing from the snapshot stay.
    Both sides of the join have one row per key, so it cannot be skewed. A snapshot
    that changes a version begun at or after `as_of` fails: for snapshots in any order
    there is `temporal.observe`.
    """
    columns = [c for c in current.columns if c not in VERSIONING]
    tracked = [c for c in columns if c != key]
    old = current.where("is_active").select(
        F.col(key), F.struct(*[F.col(c) for c in current.columns]).alias("old")
    )
    new = first_version(incoming.select(*columns), as_of).select(
        F.col(key), F.struct(*[F.col(c) for c in current.columns]).alias("new")
    )
    has_old, has_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    same = F.lit(True)
    for c in tracked:
        same = same & fx.same(F.col(f"old.{c}"), F.col(f"new.{c}"))
    changed = has_old & has_new & ~same
    closed = F.struct(*[
        F.lit(False).alias(c) if c == "is_active"
        else F.when(F.col("old.valid_from") < _moment(as_of), _moment(as_of))
        .otherwise(F.raise_error(F.lit(f"a version of {key} begins after the snapshot of {as_of}")).cast("timestamp_ntz")).alias(c)
        if c == "valid_to"
        else F.col(f"old.{c}").alias(c)
        for c in current.columns
    ])
    versions = F.array(
        F.when(changed, closed).when(has_old, F.col("old")),
        F.when(has_new & (changed | ~has_old), F.col("new")),
    )
    merged = (
        old.join(new, key, "full_outer").select(F.explode(versions).alias("version"))
        .where(F.col("version").isNotNull()).select("version.*")
    )
    return current.where(~F.col("is_active")).unionByName(merged)


def upsert(current: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Incoming rows replace current rows of the same key; repeating it changes nothing.

    Both sides hold one row per key.
    """
    return current.join(incoming.select(key), key, "left_anti").unionByName(incoming)


def fact_transactions(transactions: DataFrame, accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """Clean transactions with their customer, branch and date keys.

    `customer_id` is set only where the customer exists. Merchant, branch and date
    keys need no join: they are in the transaction, in the account and in the time.
    """
    owners = customers.select("customer_id", F.col("customer_id").alias("known_customer_id"))
    keys = lookup(accounts.select("account_id", "customer_id", "branch_id"), owners, "customer_id").select(
        "account_id", F.col("known_customer_id").alias("customer_id"), "branch_id"
    )
    return (
        lookup(transactions, keys, "account_id")
        .withColumn("date_id", fx.date_id("transaction_timestamp"))
        .select(*FACT, *[c for c in ("ingestion_timestamp",) if c in transactions.columns])
    )


def fact_as_of(transactions: DataFrame, accounts: DataFrame, customers: DataFrame, before_first: bool = False) -> DataFrame:
    """As `fact_transactions`, with the versions in force when the transaction happened.

    `accounts` and `customers` are all versions. `before_first` takes a key's first version for times before it.
    The two dimensions meet first, so the transactions are shuffled once, by account.
    """
    at = "transaction_timestamp"
    known = customers.select("customer_id", "valid_from", "valid_to", F.col("customer_id").alias("known_customer_id"))
    owned = accounts.select("account_id", "customer_id", "branch_id", "valid_from", "valid_to")
    owners = (
        temporal.composed(owned, "account_id", known, "customer_id", ["known_customer_id"], before_first)
        .drop("customer_id").withColumnRenamed("known_customer_id", "customer_id")
    )
    return (
        temporal.in_force(transactions, owners, "account_id", at, ["customer_id", "branch_id"], before_first)
        .withColumn("date_id", fx.date_id(at))
        .select(*FACT, *[c for c in ("ingestion_timestamp",) if c in transactions.columns])
    )


def loaded(fact: DataFrame, run_id: str, loaded_at: dt.datetime) -> DataFrame:
    """Add the audit columns."""
    return fact.withColumns({"pipeline_run_id": F.lit(run_id), "loaded_at": F.lit(loaded_at)})


def by_day(df: DataFrame) -> DataFrame:
    """Add the partition columns of the date layout."""
    ts = F.col("transaction_timestamp")
    return df.withColumns({"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)})
