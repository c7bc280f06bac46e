"""Small run state as append-only Parquet logs; the latest row is the one in force.

An append either commits or leaves nothing behind, so a lost executor or driver
cannot damage a log, and readers never see a half-written state.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerbrook.operators.incremental import last_watermarks
from ledgerbrook.settings import EPOCH
from ledgerbrook.sources.schemas import STATE


def state_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/quality/{table}"


def read_state(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The log of a state table; empty before its first row."""
    try:
        return spark.read.schema(STATE[table]).parquet(state_path(root, table))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STATE[table])


def append_state(df: DataFrame, root: str, table: str) -> None:
    """Append rows, cast to the table's columns; columns the frame lacks become NULL."""
    columns = [
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in STATE[table]
    ]
    df.select(*columns).write.mode("append").parquet(state_path(root, table))


def write_run(df: DataFrame, root: str, table: str, run_id: str, dataset: str) -> None:
    """Write a run's rows for a dataset; repeating the run replaces them."""
    columns = [
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in STATE[table] if f.name not in ("run_id", "dataset")
    ]
    path = f"{state_path(root, table)}/run_id={run_id}/dataset={dataset}"
    df.select(*columns).write.mode("overwrite").parquet(path)


def append_row(spark: SparkSession, root: str, table: str, **values) -> None:
    names = [f.name for f in STATE[table]]
    row = spark.createDataFrame([tuple(values.get(n) for n in names)], STATE[table])
    append_state(row.coalesce(1), root, table)


# ---- watermarks ------------------------------------------------------------------


def get_last_watermark(spark: SparkSession, root: str, dataset: str) -> str:
    """ISO text of the last processed time; the epoch for a dataset never processed."""
    log = read_state(spark, root, "pipeline_watermarks").where(F.col("dataset") == dataset)
    row = last_watermarks(log).first()
    return row["last_processed"].isoformat() if row else EPOCH


def update_watermark(spark: SparkSession, root: str, dataset: str, new_watermark: dt.datetime, run_id: str,
                     updated_at: dt.datetime | None = None) -> None:
    """Put a new watermark in force; call it after a successful load only."""
    append_row(
        spark, root, "pipeline_watermarks", dataset=dataset, last_processed=new_watermark,
        last_run_id=run_id, updated_at=updated_at or dt.datetime.now(dt.timezone.utc),
    )


# ---- versioned tables ------------------------------------------------------------


def publish(df: DataFrame, root: str, table: str, run_id: str,
            published_at: dt.datetime | None = None) -> DataFrame:
    """Write a table as a new version directory, then put that version in force.

    No directory is ever overwritten: a table can be derived from itself, its
    readers are not disturbed, and a failure leaves the old version in force.
    """
    spark = df.sparkSession
    version = f"{run_id}-{uuid.uuid4().hex[:8]}"
    path = _version_path(root, table, version)
    df.write.parquet(path)
    append_row(spark, root, "published", dataset=table, run_id=run_id, version=version,
               published_at=published_at or dt.datetime.now(dt.timezone.utc))
    return spark.read.parquet(path)


def read_published(spark: SparkSession, root: str, table: str, not_by: str | None = None) -> DataFrame | None:
    """The version in force, or None before the first.

    `not_by` leaves out a run's own versions, so that a repeated run starts from
    the same version as its first attempt.
    """
    log = read_state(spark, root, "published").where(F.col("dataset") == table)
    if not_by is not None:
        log = log.where(F.col("run_id") != not_by)
    row = log.agg(F.max_by("version", "published_at").alias("version")).first()
    return spark.read.parquet(_version_path(root, table, row["version"])) if row["version"] else None


def _version_path(root: str, table: str, version: str) -> str:
    return f"{root.rstrip('/')}/curated/{table}/version={version}"
