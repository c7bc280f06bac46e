"""Keeping one well-defined row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerbrook.operators.lookup import lookup


def recency(df: DataFrame, key: str, newest: str) -> list:
    """A total order over the rows of one key: newest first, then every other column."""
    first = [newest] if newest in df.columns else []
    rest = [c for c in df.columns if c not in (key, *first)]
    return [F.desc_nulls_last(c) for c in first + rest] or [F.desc_nulls_last(key)]


def ranked(df: DataFrame, key: str, newest: str = "ingestion_timestamp", name: str = "copy_no") -> DataFrame:
    """Number the copies of each key, 1 being the one to keep."""
    window = Window.partitionBy(key).orderBy(*recency(df, key, newest))
    return df.withColumn(name, F.row_number().over(window))


def latest_per_key(df: DataFrame, key: str, newest: str = "ingestion_timestamp") -> DataFrame:
    """One row per key, the same one on every run.

    Spark turns `row_number = 1` into a group limit ahead of the shuffle, so each
    map task sends at most one row per key and a key with very many copies costs
    its reducer no more than one row per map task.
    """
    return ranked(df, key, newest).where("copy_no = 1").drop("copy_no")


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys occurring more than once, with their number of rows. NULL is no key."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("cnt")).where("cnt > 1")


def extra_copies(df: DataFrame, key: str, newest: str = "ingestion_timestamp") -> DataFrame:
    """What `latest_per_key` leaves out, as distinct rows with their number of `copies`.

    Identical copies are counted instead of listed, so a key with very many of
    them stays one row; only rows of repeated keys take part in the joins.
    The key must not be NULL.
    """
    repeated = lookup(df, repeated_keys(df, key).select(key), key, "left_semi")
    rows = repeated.groupBy(*df.columns).agg(F.count("*").alias("copies"))
    others = F.struct(*[c for c in df.columns if c != key])
    kept = latest_per_key(repeated, key, newest).select(key, others.alias("kept"))
    left_out = F.col("copies") - F.when(others.eqNullSafe(F.col("kept")), 1).otherwise(0)
    return lookup(rows, kept, key).select(*df.columns, left_out.alias("copies")).where("copies > 0")
