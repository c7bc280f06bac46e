"""Small column expressions. Everything here stays inside Spark's codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerbrook.settings import MERCHANT_RISK

MONEY = "decimal(15,2)"
BIG_MONEY = "decimal(20,2)"

MINUTE = 60 * 1_000_000
DAY = 24 * 60 * MINUTE


def to_int(c: str | Column) -> Column:
    """Integer, or NULL where the text is malformed (also under ANSI)."""
    return F.col(c).try_cast("int") if isinstance(c, str) else c.try_cast("int")


def to_money(c: str | Column) -> Column:
    return F.col(c).try_cast(MONEY) if isinstance(c, str) else c.try_cast(MONEY)


def to_day(c: str | Column) -> Column:
    return F.col(c).try_cast("date") if isinstance(c, str) else c.try_cast("date")


def to_moment(c: str | Column) -> Column:
    """Business time carries no zone."""
    return F.col(c).try_cast("timestamp_ntz") if isinstance(c, str) else c.try_cast("timestamp_ntz")


def holds(condition: Column) -> Column:
    """The condition as TRUE or FALSE, NULL counting as FALSE."""
    return F.coalesce(condition, F.lit(False))


def micros(c: str | Column) -> Column:
    """Microseconds since the epoch of a zone-less timestamp, whatever the session zone is."""
    column = F.col(c) if isinstance(c, str) else c
    whole_minutes = F.unix_date(F.to_date(column)).cast("bigint") * 1440 + F.hour(column) * 60 + F.minute(column)
    seconds = F.extract(F.lit("SECOND"), column)
    return whole_minutes * MINUTE + (seconds * 1_000_000).cast("bigint")


def floor_to(c: Column, step: int) -> Column:
    """Start of the `step`-wide slice holding `c`, exact for negative values too."""
    return c - F.pmod(c, F.lit(step).cast("bigint"))


def date_id(c: str | Column) -> Column:
    """yyyyMMdd as an integer."""
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def month_id(c: str | Column) -> Column:
    """yyyyMM as an integer."""
    return F.year(c) * 100 + F.month(c)


def merchant_risk(category: str | Column) -> Column:
    """Risk class of a merchant category; NULL for an unknown one."""
    column = F.col(category) if isinstance(category, str) else category
    pairs = [F.lit(text) for pair in MERCHANT_RISK.items() for text in pair]
    return F.try_element_at(F.create_map(*pairs), column)


def same(left: Column, right: Column) -> Column:
    """Equality in which NULL equals NULL."""
    return left.eqNullSafe(right)


def chosen(pairs: list[tuple[Column, str]]) -> Column:
    """The texts whose condition holds, as an array in the given order."""
    none = F.array().cast("array<string>")
    return F.concat(none, *[F.when(condition, F.array(F.lit(text))).otherwise(none) for condition, text in pairs])
