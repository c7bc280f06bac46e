"""Exact distinct counts that can be merged: sets of keys as bitmaps over dense numbers.

Keys get numbers once and keep them. A set is a few rows (bucket, members), each a bitmap of 32768 consecutive numbers, so
sets of days merge into those of months, quarters or years by OR, whatever they have in common, and a day that
changes is the only one that is read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerbrook.operators.lookup import lookup

#: Bits of one of Spark's bitmaps.
BITS = 32768
#: Keys that are numbered in one window.
PER_LOT = 1 << 20


def lots_for(keys: int) -> int:
    """Lots for so many new keys."""
    return max(1, -(-keys // PER_LOT))


def numbered(keys: DataFrame, key: str, known: DataFrame | None = None, lots: int = 1) -> DataFrame:
    """key, number of the keys that `known` (key, number) lacks; NULL gets none.

    Numbers are dense within a lot (a hash of the key), and each lot goes on from its highest known number, so the
    number of lots may differ from one time to the next: numbers once given stay right.
    """
    fresh = keys.where(F.col(key).isNotNull()).select(key).distinct()
    lot = F.pmod(F.xxhash64(key), F.lit(lots).cast("bigint"))
    if known is not None:
        fresh = lookup(fresh, known.select(key), key, "left_anti")
    placed = fresh.withColumn("lot", lot).withColumn("place", F.row_number().over(Window.partitionBy("lot").orderBy(key)))
    used = F.lit(0)
    if known is not None:
        highest = known.groupBy(F.shiftright("number", 32).alias("lot")).agg(F.max(F.col("number").bitwiseAND(0xFFFFFFFF)).alias("used"))
        placed, used = lookup(placed, highest, "lot"), F.coalesce("used", F.lit(0))
    return placed.select(key, (F.shiftleft("lot", 32) + F.col("place") + used).cast("bigint").alias("number"))


def position() -> Column:
    return F.bitmap_bit_position("number")


def bucket() -> Column:
    return F.bitmap_bucket_number("number").alias("bucket")


def collected(rows: DataFrame, by: list[str]) -> DataFrame:
    """by, bucket, members: the sets of `number` per `by`."""
    return rows.groupBy(*by, bucket()).agg(F.bitmap_construct_agg(position()).alias("members"))


def merged(sets: DataFrame, by: list[str]) -> DataFrame:
    """by, bucket, members: the union of the sets per `by`."""
    return sets.groupBy(*by, "bucket").agg(F.bitmap_or_agg("members").alias("members"))


def sizes(sets: DataFrame, by: list[str], name: str) -> DataFrame:
    """by and the number of members; the sets must be merged by `by`."""
    return sets.groupBy(*by).agg(F.sum(F.bitmap_count("members")).alias(name))


def members(sets: DataFrame, by: list[str]) -> DataFrame:
    """by, number: one row per member. A bitmap gives at most 32768."""
    byte = lambda p: F.conv(F.hex(F.substring("members", F.shiftright(p, 3) + 1, F.lit(1))), 16, 10).cast("int")
    at = F.filter(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda p: F.getbit(byte(p), p.bitwiseAND(7)) == 1)
    return sets.select(*by, "bucket", F.explode(at).alias("p")).select(
        *by, ((F.col("bucket") - 1) * BITS + F.col("p") + 1).alias("number"))


# ---- accounts with transactions ------------------------------------------------------------------


def active_accounts(transactions: DataFrame, numbers: DataFrame, by: list[str], high_value_above: float) -> DataFrame:
    """by, bucket, members, high: the accounts with transactions, and how many high-value ones those that have any have.

    Transactions shrink to one row per account before they meet the numbers; `high` holds at most 32768 entries.
    """
    per_account = transactions.groupBy(*by, "account_id").agg(F.count_if(F.col("amount") > high_value_above).alias("times"))
    rows = lookup(per_account, numbers, "account_id", "inner").withColumn("position", position().cast("int"))
    high = F.collect_list(F.when(F.col("times") > 0, F.struct("position", "times")))
    return rows.groupBy(*by, bucket()).agg(F.bitmap_construct_agg(F.col("position").cast("bigint")).alias("members"), high.alias("high"))


def account_months(active: DataFrame, numbers: DataFrame) -> DataFrame:
    """month_id, account_id, high_value from `active_accounts` of days with their `month_id`."""
    seen = members(merged(active, ["month_id"]), ["month_id"]).withColumn("times", F.lit(0).cast("bigint"))
    high = active.select("month_id", "bucket", F.explode("high").alias("h")).select(
        "month_id", ((F.col("bucket") - 1) * BITS + F.col("h.position") + 1).alias("number"), F.col("h.times").alias("times"))
    per_number = seen.unionByName(high).groupBy("month_id", "number").agg(F.sum("times").alias("high_value"))
    return lookup(per_number, numbers, "number", "inner").select("month_id", "account_id", "high_value")


def accounts_by_period(days: DataFrame) -> DataFrame:
    """period (2024-05, 2024-Q2, 2024), active_accounts: exact distinct accounts, each level merged from the one below.

    `days` are sets with `year` and `month`.
    """
    months = merged(days, ["year", "month"]).withColumn("quarter", F.ceil(F.col("month") / 3).cast("int"))
    quarters = merged(months, ["year", "quarter"])
    years = merged(quarters, ["year"])
    levels = (
        sizes(months, ["year", "month"], "active_accounts").withColumn("period", F.format_string("%04d-%02d", "year", "month")),
        sizes(quarters, ["year", "quarter"], "active_accounts").withColumn("period", F.format_string("%04d-Q%d", "year", "quarter")),
        sizes(years, ["year"], "active_accounts").withColumn("period", F.format_string("%04d", "year")),
    )
    first, *others = (level.select("period", "active_accounts") for level in levels)
    for other in others:
        first = first.unionByName(other)
    return first
