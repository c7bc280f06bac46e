"""Reading and writing the lake: <root>/<layer>/<dataset>/, any Hadoop URI as root."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerbrook.settings import LAYERS
from ledgerbrook.sources.schemas import RAW

FORMATS = ("csv", "json", "parquet")


def layer_path(root: str, layer: str, dataset: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"Unknown layer: {layer}")
    return f"{root.rstrip('/')}/{layer}/{dataset}"


def _known(fmt: str) -> str:
    if fmt not in FORMATS:
        raise ValueError(f"Unsupported file format: {fmt}")
    return fmt


def reader_of(spark: SparkSession, modified_after: dt.datetime | None = None) -> DataFrameReader:
    """`modified_after` (UTC) leaves out older files when they are listed, so they are never opened."""
    if modified_after is None:
        return spark.read
    return spark.read.option("modifiedAfter", modified_after.isoformat(timespec="seconds")).option("timeZone", "UTC")


def read_raw(spark: SparkSession, path: str, dataset: str, fmt: str = "csv",
             modified_after: dt.datetime | None = None) -> DataFrame:
    """The files of a dataset under its declared schema; nothing is inferred.

    For CSV all files have the declared columns, in their order, or reading fails: `deliveries.read` takes
    any layout and keeps broken rows.
    """
    return read_files(spark, path, RAW[dataset], fmt, modified_after)


def read_files(spark: SparkSession, path: str | list[str], schema: StructType, fmt: str = "csv",
               modified_after: dt.datetime | None = None) -> DataFrame:
    reader = reader_of(spark, modified_after).schema(schema)
    if _known(fmt) == "csv":
        reader = reader.option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False)
    elif fmt == "json":
        reader = reader.option("mode", "PERMISSIVE")
    return reader.format(fmt).load(path)


def empty(spark: SparkSession, dataset: str) -> DataFrame:
    return spark.createDataFrame([], RAW[dataset])


def union_batches(batches: list[DataFrame]) -> DataFrame:
    """Batches of one dataset as one frame; a column missing from a batch becomes NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)


def delivered_schema(spark: SparkSession, path: str, fmt: str) -> StructType | None:
    """The columns that Parquet files bring, from a footer; None for formats bound row by row or header by header."""
    return spark.read.parquet(path).schema if _known(fmt) == "parquet" else None


def stamped(df: DataFrame, batch_id: str, ingested_at: dt.datetime) -> DataFrame:
    """Add the landing stamps; an ingestion time already in the data is kept.

    A row without one is stamped with the modification time of its file (`with_file_time`), which is the same in
    every run, or else with `ingested_at`. A malformed one becomes NULL and stays readable as `ingestion_text`,
    so that the quality gate can reject it.
    """
    text = F.nullif(F.trim(F.col("ingestion_timestamp").cast("string")), F.lit("")) if "ingestion_timestamp" in df.columns \
        else F.lit(None).cast("string")
    now = F.lit(str(ingested_at)).cast("timestamp_ntz")
    if "file_time" in df.columns:
        now = F.coalesce(F.col("file_time").cast("timestamp_ntz"), now)
    return df.withColumns({
        "ingestion_text": text,
        "ingestion_timestamp": F.when(text.isNull(), now).otherwise(text.try_cast("timestamp_ntz")),
        "batch_id": F.lit(batch_id),
    }).drop("file_time")


def with_file_time(df: DataFrame) -> DataFrame:
    """Add the modification time of the file of each row, for a frame (or stream) that reads files directly."""
    return df.select("*", F.col("_metadata.file_modification_time").alias("file_time"))


def write_files(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: tuple[str, ...] = (), options: dict | None = None) -> str:
    """Write a directory of files, CSV with a header and Parquet with Snappy; return the path.

    A partitioned write replaces only the partitions it has rows for. Its rows are
    brought together per partition value first, so that each task does not leave a
    small file in every partition; the rebalance hint lets Spark split a large
    value over several tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(_known(fmt)).mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    if fmt == "parquet":
        writer = writer.option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    for key, value in (options or {}).items():
        writer = writer.option(key, value)
    writer.save(path)
    return path


def list_files(df: DataFrame) -> list[str]:
    """The files behind a frame, from its plan; no rows are read."""
    return sorted(df.inputFiles())


def files_manifest(df: DataFrame) -> DataFrame:
    """Rows per source file of a frame that reads files directly."""
    return df.groupBy(F.col("_metadata.file_name").alias("file_name")).agg(F.count("*").alias("records"))


def ingestion_summary(frames: dict[str, DataFrame], paths: dict[str, str] | None = None,
                      seconds: dict[str, float] | None = None) -> DataFrame:
    """Records and files per dataset with a grand total, for frames reading files directly.

    With `paths` and `seconds` (where a dataset went and how long that took) each row names them as well.
    """
    per_file = [
        files_manifest(df).select(F.lit(name).alias("dataset"), "records") for name, df in frames.items()
    ]
    summary = (
        reduce(lambda a, b: a.unionByName(b), per_file)
        .rollup("dataset")
        .agg(F.sum("records").alias("records"), F.count("*").alias("batches"))
        .select(F.coalesce("dataset", F.lit("TOTAL")).alias("dataset"), "records", "batches")
    )
    for name, known, kind in (("path", paths, "string"), ("seconds", seconds, "double")):
        if known is not None:
            values = known | ({"TOTAL": sum(known.values())} if kind == "double" else {})
            pairs = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
            summary = summary.withColumn(name, F.try_element_at(pairs, F.col("dataset")).cast(kind))
    return summary


def sample_n(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly n rows (or all), the same ones on every run: the lowest seeded hashes.

    Each task keeps its own n best, so only those travel.
    """
    mixed = F.md5(F.concat(F.coalesce(key, F.lit("")), F.lit(f"#{seed}")))
    return df.orderBy(mixed, key).limit(n)
