"""Benchmark decontamination by size-partitioned MinHash containment search, in DataFrame functions only.

Test items are partitioned by their number of distinct word shingles, in powers of two. Of an item with up to n
shingles the sketch is its bottom floor((1 - threshold) * n) + 1 hashes (a MinHash sketch of one permutation): a document that
contains at least `threshold` of the shingles misses at most (1 - threshold) * n of them, so it has at least one of the sketch,
however long it is. The sketches of all partitions make one small key table; documents' shingle hashes are looked up in
it, and only documents that hit are cut into shingle texts again and verified by exact containment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SPACE, no_null, written

SHINGLE = 5
THRESHOLD = 0.8
#: Key tables up to this many rows are broadcast (8 bytes each and overhead); longer ones are joined by shuffle.
BROADCAST_ROWS = 200_000


def words(text: Column) -> Column:
    """Lower-cased words; an empty array without any."""
    return F.filter(F.split(F.lower(text), SPACE), lambda w: w != "")


def _each(found: Column, make, size: int) -> Column:
    """make(first word's index) for every shingle of an array of words; none for fewer than `size` words."""
    return F.transform(F.sequence(F.lit(0), F.size(found) - size), make)


def shingle_texts(df: DataFrame, key: str, size: int) -> DataFrame:
    """key, shingle: distinct shingles as text. Fewer words than `size`: one shingle, the whole sequence; no words: none."""
    found = df.select(key, words(no_null("text")).alias("w")).filter(F.size("w") > 0)
    texts = F.when(F.size("w") <= size, F.array(F.array_join("w", " "))).otherwise(
        _each(F.col("w"), lambda i: F.array_join(F.slice("w", i + 1, F.lit(size)), " "), size)
    )
    return found.select(key, F.explode(F.array_distinct(texts)).alias("shingle"))


def _shingle_hashes(df: DataFrame, key: str, size: int) -> DataFrame:
    """key, hash: a hash per shingle, by the words' own hashes; repeats included, so nothing is shuffled or gathered."""
    found = df.select(key, words(no_null("text")).alias("w")).filter(F.size("w") > 0)
    hashed = found.select(key, F.transform("w", lambda w: F.xxhash64(w)).alias("h"))
    mixed = F.when(F.size("h") <= size, F.array(F.xxhash64(F.col("h")))).otherwise(
        _each(F.col("h"), lambda i: F.xxhash64(F.slice("h", i + 1, F.lit(size))), size)
    )
    return hashed.select(key, F.explode(mixed).alias("hash"))


def sketches(items: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """item_id, size_class, hash: the bottom hashes of every item, as many as its size partition asks for."""
    hashes = _shingle_hashes(items, "item_id", size).distinct()
    counted = hashes.withColumn("n", F.count("*").over(Window.partitionBy("item_id")))
    size_class = F.ceil(F.log2("n")).cast("int")
    length = F.floor((1 - F.lit(threshold)) * F.pow(F.lit(2.0), F.col("size_class")) + 1e-9) + 1
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.xxhash64("hash"), "hash"))
    return (
        counted.withColumn("size_class", size_class).withColumn("rank", rank)
        .filter(F.col("rank") <= length).select("item_id", "size_class", "hash")
    )


def contained(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """doc_id, item_id, n_item, n_common, containment: every pair whose document holds at least `threshold` of the item's distinct
    shingles. Words are lower-cased runs of characters other than white space.

    Null and empty texts of either side match nothing; an item of fewer words than a shingle matches documents that consist of
    it. Null ids match nothing. Repeated rows count once (a document is the union of its rows). Empty tables give no
    row; other columns are not looked at. A document with an item many times is one row.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id is not null and text is not null")
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("item_id is not null")
    keys = written(sketches(items, threshold, size))
    wanted = keys.select(F.col("hash").alias("wanted")).distinct()
    if keys.count() <= BROADCAST_ROWS:
        wanted, keys = F.broadcast(wanted), F.broadcast(keys)
    hits = _shingle_hashes(docs, "doc_id", size).join(wanted, F.col("hash") == F.col("wanted"), "left_semi").distinct()
    pairs = written(hits.join(keys, "hash").select("doc_id", "item_id").distinct())
    exact = shingle_texts(items, "item_id", size)
    of_items = exact.groupBy("item_id").agg(F.count("*").alias("n_item"))
    suspects = pairs.select(F.col("doc_id").alias("suspect")).distinct()
    found = shingle_texts(docs.join(suspects, F.col("doc_id") == F.col("suspect"), "left_semi"), "doc_id", size)
    of_pairs = exact.join(pairs, "item_id").select(F.col("doc_id").alias("in_doc"), "item_id", F.col("shingle").alias("part"))
    common = (
        found.join(of_pairs, (F.col("doc_id") == F.col("in_doc")) & (F.col("shingle") == F.col("part")))
        .select("doc_id", "item_id", "shingle").distinct()
        .groupBy("doc_id", "item_id").agg(F.count("*").alias("n_common"))
    )
    return (
        common.join(of_items, "item_id").withColumn("containment", F.col("n_common") / F.col("n_item"))
        .filter(F.col("n_common") >= F.lit(threshold) * F.col("n_item") - 1e-9)
        .select("doc_id", "item_id", "n_item", "n_common", "containment")
    )


def oracle(threshold: float = THRESHOLD, size: int = SHINGLE) -> str:
    """The same by comparing all shingles, in DuckDB SQL."""

    def shingles(key: str, name: str) -> str:
        w = r"list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
        return f"""select distinct {key}, unnest(case when len(w) <= {size} then [array_to_string(w, ' ')]
            else list_transform(range(1, len(w) - {size} + 2), lambda i: array_to_string(w[i : i + {size - 1}], ' ')) end) as shingle
            from (select {key}, {w} as w from {name}) where len(w) > 0"""

    return f"""with d as ({shingles('doc_id', 'documents')}), i as ({shingles('item_id', 'benchmark')}),
        n as (select item_id, count(*) as n_item from i group by item_id)
        select doc_id, item_id, n_item, count(*) as n_common, count(*) / n_item as containment
        from d join i using (shingle) join n using (item_id)
        group by doc_id, item_id, n_item having count(*) >= {threshold} * n_item - 1e-9"""
