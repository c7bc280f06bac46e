"""New-file ingestion: each raw transaction file is taken in exactly once.

The stream is one of files, not of rows: its checkpoint remembers the files seen, and every micro-batch is one run
of the batch load over the new ones, with columns bound by each file's own header. Its upsert makes a
repeated micro-batch harmless.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from ledgerbrook.plans import pipeline
from ledgerbrook.settings import Settings
from ledgerbrook.sources import deliveries, lake


def new_files(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream of the files of a dataset directory: path, modificationTime, length. Their content is not read."""
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select("path", "modificationTime", "length")


def ingest_available(spark: SparkSession, raw_dir: str, root: str, checkpoint: str, name: str = "transactions",
                     as_of: dt.datetime | None = None, settings: Settings = Settings(), fmt: str = "csv",
                     files_per_batch: int | None = None) -> int:
    """Load the transaction files not loaded before, then stop; return the number of batches.

    The dimensions must have been loaded. `checkpoint` and `root` are on shared storage.
    """
    stream = new_files(spark, f"{raw_dir.rstrip('/')}/transactions", files_per_batch)
    batches = []

    def load(batch: DataFrame, batch_id: int) -> None:
        now = as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        this = pipeline.Run(root, f"{name}-{batch_id:06d}", now, settings)
        # foreachBatch hands over a session of its own; its frames must stay in it.
        session = batch.sparkSession
        # the names of the new files, which the driver has listed
        paths = [deliveries.literal(r["path"]) for r in batch.select("path").collect()]

        def work() -> dict:
            raw = pipeline.delivered(session, this, paths, "transactions", fmt)
            return pipeline.load_transactions(session, this, lake.stamped(raw, this.run_id, now))

        pipeline.recorded(session, this, work)
        batches.append(batch_id)

    query = (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len(batches)
