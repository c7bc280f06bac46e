"""Batch watermarks: what is new, what may still arrive late, where to go on next."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerbrook.settings import EPOCH, IncrementalSettings

DEFAULTS = IncrementalSettings()


def moment(value: dt.datetime | str) -> Column:
    return F.lit(str(value)).cast("timestamp_ntz")


def newer_than(df: DataFrame, watermark: dt.datetime | str, settings: IncrementalSettings = DEFAULTS) -> DataFrame:
    """Rows strictly after the watermark; the comparison reaches the file scan."""
    return df.where(F.col(settings.watermark_column) > moment(watermark))


def effective_watermark(watermark: dt.datetime | str, settings: IncrementalSettings = DEFAULTS) -> dt.datetime:
    """The watermark moved back by the days records may be late, not before the epoch."""
    stored = watermark if isinstance(watermark, dt.datetime) else dt.datetime.fromisoformat(watermark)
    return max(stored - dt.timedelta(days=settings.late_arriving_days), dt.datetime.fromisoformat(EPOCH))


def newer_or_late(df: DataFrame, watermark: dt.datetime | str, settings: IncrementalSettings = DEFAULTS) -> DataFrame:
    return newer_than(df, effective_watermark(watermark, settings), settings)


def next_watermark(processed: DataFrame, watermark: dt.datetime | str,
                   settings: IncrementalSettings = DEFAULTS) -> DataFrame:
    """One row: the newest value processed, or the old watermark if that is not older."""
    newest = F.max(settings.watermark_column).cast("timestamp_ntz")
    return processed.agg(F.greatest(newest, moment(watermark)).alias("last_processed"))


def last_watermarks(log: DataFrame) -> DataFrame:
    """The row in force per dataset of an append-only watermark log."""
    latest = F.max(F.struct("updated_at", "last_processed", "last_run_id"))
    return log.groupBy("dataset").agg(latest.alias("w")).select(
        "dataset", "w.last_processed", "w.last_run_id", "w.updated_at"
    )
