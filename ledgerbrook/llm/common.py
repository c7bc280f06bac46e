"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than space, tab, newline, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the cluster's, or a temporary one where none is set (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerbrook-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage: write the rows as Parquet in the shared folder and read them again.

    A lost executor then costs a reread, not a recomputation.
    """
    path = f"{shared_folder(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts(total_bytes: int, each: int = 16 << 20, least: int = 8) -> int:
    """Number of partitions so that one holds about `each` bytes, however large the input is."""
    return max(least, -(-int(total_bytes) // each))


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of a text column, one cheap aggregate."""
    return df.agg(F.sum(F.octet_length(column))).first()[0] or 0


def no_null(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))
