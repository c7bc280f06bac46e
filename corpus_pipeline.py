"""From documents to training shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. Any
further columns pass through; names that stages add for themselves are chosen so that they don't clash with them.
A row without doc_id can't be named in a decision about documents: it is scored, mixed and sharded, and stays
in the two stages that decide by doc_id (near-duplicates, decontamination). An empty table passes all stages.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerbrook.llm import decontaminate, mixing, sharding, simhash, toxicity
from ledgerbrook.llm.common import table, written

SHARDS = 40
TOXIC = 0.5
#: Rows of a bucket when rows that share copies are numbered.
EACH = 1024


def fresh(docs: DataFrame, name: str) -> str:
    """A column name that `docs` doesn't have in any case."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below TOXIC; the model is fitted on labelled rows of `docs`."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    score = fresh(docs, "toxicity_score")
    return toxicity.score(docs, model, score).filter(F.col(score) < TOXIC).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by SimHash the one with the smallest doc_id; one row of it, if its row is repeated."""
    found = simhash.near_duplicates(docs)
    keep, rank = fresh(docs, "kept_id"), fresh(docs, "row_rank")
    kept = found.filter("doc_id = component_id").select(F.col("doc_id").alias(keep)).distinct()
    named = docs.filter("doc_id is not null").join(kept, F.col("doc_id") == F.col(keep), "left_semi")
    first = named.withColumn(rank, F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))).filter(F.col(rank) == 1).drop(rank)
    return first.unionByName(docs.filter("doc_id is null"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    hit = fresh(docs, "hit_id")
    hits = decontaminate.contained(docs, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias(hit)).distinct()
    return docs.join(hits, F.col("doc_id") == F.col(hit), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it. Rows equal in doc_id, source and size share their copies evenly: where
    they don't divide, the rows are numbered by a hash of their columns and the first ones get one more."""
    columns = docs.columns
    mixed = mixing.mix(docs).groupBy("doc_id", "source", "size").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    size, times, rows = fresh(docs, "mix_size"), fresh(docs, "mix_copies"), fresh(docs, "mix_rows")
    names = [fresh(docs, f"mix_{c}") for c in ("doc_id", "source", "of_size")]
    plan = written(mixed.toDF(*names, times, rows))
    sized = docs.withColumn(size, mixing.n_words("text"))

    def planned(some: DataFrame) -> DataFrame:
        same = F.col("doc_id").eqNullSafe(F.col(names[0])) & F.col("source").eqNullSafe(F.col(names[1])) & (F.col(size) == F.col(names[2]))
        return sized.join(some, same)

    def taken(joined: DataFrame, extra: Column) -> DataFrame:
        own = F.floor(F.col(times) / F.col(rows)) + extra
        return joined.withColumn(times, F.explode(F.array_repeat(F.lit(1), own.cast("int")))).select(*(F.col(f"`{c}`") for c in columns))

    divided = F.col(times) % F.col(rows) == 0
    even, uneven = taken(planned(plan.filter(divided)), F.lit(0)), plan.filter(~divided)
    n = uneven.count()
    if not n:
        return even
    # rows without doc_id can be many in one group, so they are numbered in buckets of about EACH
    row, bucket, number, before = fresh(docs, "mix_row"), fresh(docs, "mix_bucket"), fresh(docs, "mix_number"), fresh(docs, "mix_before")
    hashed = F.xxhash64(*(F.col(f"`{c}`") for c, kind in docs.dtypes if not re.search("map<|variant", kind)))
    shared = written(
        planned(F.broadcast(uneven) if n <= mixing.BROADCAST_ROWS else uneven)
        .withColumn(row, hashed).withColumn(bucket, F.pmod(F.col(row), F.ceil(F.col(rows) / EACH)))
    )
    others = [fresh(docs, f"mix_other_{i}") for i in range(4)]
    counts = shared.groupBy(*names, bucket).agg(F.count("*").alias(number))
    starts = counts.withColumn(before, F.coalesce(F.sum(number).over(Window.partitionBy(*names).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    starts = starts.select(*(F.col(c).alias(o) for c, o in zip([*names, bucket], others)), before)
    numbered = shared.withColumn(number, F.row_number().over(Window.partitionBy(*names, bucket).orderBy(row, "text")))
    same = [F.col(c).eqNullSafe(F.col(o)) for c, o in zip([*names, bucket], others)]
    numbered = numbered.join(starts, same[0] & same[1] & same[2] & same[3])
    return even.unionByName(taken(numbered, (F.col(before) + F.col(number) <= F.col(times) % F.col(rows)).cast("long")))


def to_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row."""
    return sharding.shard(docs, SHARDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", to_shards),
]

#: The stages use a trained model, random rounding and packing, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
