"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions only.

Every source gets a share of all words in proportion to its weight, at most `cap` times
its own words; what a cap cuts off goes to the others by weight. A document is to be taken
target / source words times, which is rarely a whole number, so its fractional part is a
probability. Two fractional documents at a time (a pivotal fight) pass words from one to the
other, at random but so that both expectations hold, until one of them is whole; the other
goes on. Blocks of a source fight first; what they leave over fights in the next level of a
tree, until a source has one fractional document left, which is rounded to the nearer side. Of the last block,
up to three documents are turned over where that brings the words taken nearer to the target. So they differ from it by
at most half of one document, mostly by far less.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, written

#: Documents that fight in one fold. Any block has about as many, so no source is ever gathered in one task.
BLOCK = 64
#: Documents of the last block that may be turned over to come nearer to the target.
TURNS = 3
#: A table of sources up to this many rows is broadcast; a longer one is joined by Spark's choice.
BROADCAST_ROWS = 10_000


def n_words(column: str) -> Column:
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def sized(docs: DataFrame, size: Column | None = None) -> DataFrame:
    """doc_id, source and size: the words of the text (null: 0), or another size >= 0."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        (n_words("text") if size is None else size).cast("long").alias("size"),
    )


def targets(sizes: DataFrame, cap: int = 3, cycle: int = 3) -> DataFrame:
    """source, source_size, n_docs, target: one row per source.

    The capped sources are a prefix of the sources in order of size over weight: source i is
    capped if its cap is below its share of what the sources before it, all capped, leave.
    The windows see one row per source, never documents.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighted = sources.withColumn("weight", ((F.row_number().over(by_name) - 1) % cycle + 1).cast("double"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    limit = F.col("source_size").cast("double") * cap
    ranked = weighted.select(
        "*", limit.alias("limit"),
        F.sum("source_size").over(everything).cast("double").alias("total"),
        F.sum("weight").over(everything).alias("weights"),
        F.coalesce(F.sum(limit).over(before), F.lit(0.0)).alias("limits_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0.0)).alias("weights_before"),
    )
    rate = (F.col("total") - F.col("limits_before")) / (F.col("weights") - F.col("weights_before"))
    capped = ranked.withColumn("capped", F.col("limit") <= rate * F.col("weight"))
    spent = capped.select(
        "*",
        F.coalesce(F.sum(F.when(F.col("capped"), F.col("limit"))).over(everything), F.lit(0.0)).alias("spent"),
        F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everything).alias("free"),
    )
    share = (F.col("total") - F.col("spent")) * F.col("weight") / F.col("free")
    return spent.select(
        "source", "source_size", "n_docs",
        F.when(F.col("capped"), F.col("limit")).otherwise(F.least(share, F.col("limit"))).alias("target"),
    )


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the parts alone, so that reruns agree."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 40)) / F.lit(float(1 << 40))


def _fight(a: Column, b: Column, level: int, seed: int) -> Column:
    """struct(rest, done): of two fractional documents the one that still is and the one that is whole now."""
    a_size, b_size = a["size"].cast("double"), b["size"].cast("double")
    up = F.least((1 - a["p"]) * a_size, b["p"] * b_size)  # words that a can take from b
    down = F.least(a["p"] * a_size, (1 - b["p"]) * b_size)

    def settled(m: Column) -> Column:
        rise = _uniform(a["doc_id"], b["doc_id"], a["salt"], b["salt"], F.lit(level), F.lit(seed)) * (m["up"] + m["down"]) < m["down"]
        first = F.when(rise, (1 - a["p"]) * a_size <= b["p"] * b_size).otherwise(a["p"] * a_size <= (1 - b["p"]) * b_size)

        def ended(r: Column) -> Column:
            # r.rise: words go to a; r.first: a is whole first
            whole_a = a.withField("p", F.when(r["rise"], F.lit(1.0)).otherwise(F.lit(0.0)))
            whole_b = b.withField("p", F.when(r["rise"], F.lit(0.0)).otherwise(F.lit(1.0)))
            keep = lambda p: F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0))
            sign = F.when(r["rise"], F.lit(1.0)).otherwise(F.lit(-1.0))
            moved = F.when(r["rise"], m["up"]).otherwise(m["down"])
            rest_b = b.withField("p", keep(b["p"] - sign * moved / b_size))
            rest_a = a.withField("p", keep(a["p"] + sign * moved / a_size))
            return F.when(r["first"], F.struct(rest_b.alias("rest"), whole_a.alias("done"))).otherwise(
                F.struct(rest_a.alias("rest"), whole_b.alias("done"))
            )

        return _let(F.struct(rise.alias("rise"), first.alias("first")), ended)

    return _let(F.struct(up.alias("up"), down.alias("down")), settled)


def _rounded(acc: Column) -> Column:
    """All documents of the last block as whole ones: the rest goes to the nearer side, and up to TURNS times the document
    whose turning over brings the words taken nearest to their sum is turned, if any does."""

    def turned(v: Column) -> Column:
        change = lambda x: F.when(x["p"] > 0.5, -x["size"]).otherwise(x["size"])
        best = F.array_min(F.transform(v["docs"], lambda x, i: F.struct(F.abs(v["lack"] - change(x)).alias("off"), i.alias("at"))))
        return _let(best, lambda b: F.when(b["off"] < F.abs(v["lack"]), F.struct(
            F.transform(v["docs"], lambda x, i: F.when(i == b["at"], x.withField("p", 1 - x["p"])).otherwise(x)).alias("docs"),
            (v["lack"] - change(v["docs"][b["at"]])).alias("lack"),
        )).otherwise(v))

    rest = acc["rest"]
    docs = F.array_append(acc["done"], rest.withField("p", F.round(rest["p"])))
    state = F.struct(docs.alias("docs"), ((rest["p"] - F.round(rest["p"])) * rest["size"]).alias("lack"))
    for _ in range(TURNS):
        state = _let(state, turned)
    return state["docs"]


def _fold(block: Column, level: int, seed: int, last: bool) -> Column:
    """All documents of a block, one perhaps still fractional unless it is the last block of its source."""

    def step(acc: Column, x: Column) -> Column:
        return _let(
            _fight(acc["rest"], x, level, seed),
            lambda f: F.struct(f["rest"].alias("rest"), F.array_append(acc["done"], f["done"]).alias("done")),
        )

    start = F.struct(block[0].alias("rest"), F.slice(block, 1, 0).alias("done"))
    return F.aggregate(
        F.slice(block, 2, F.greatest(F.size(block) - 1, F.lit(0))), start, step,
        _rounded if last else lambda acc: F.array_append(acc["done"], acc["rest"]),
    )


def mix(docs: DataFrame, cap: int = 3, cycle: int = 3, seed: int = 0, size: Column | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, source, size, source_size, target, copies.

    Sources stand in code point order, null last, with weights 1 .. `cycle`, repeating. Nulls: a null
    text has no words, a null source is a source, a null doc_id is kept. Rows without words are
    taken at their probability and add no words. Repeated rows count each for itself; the same table
    gives the same copies up to exchange between rows that are equal in doc_id, source and size.
    An empty table gives no row. Other columns are not looked at.
    """
    # rows that repeat one another are gathered first and numbered again
    same = sized(docs, size).groupBy("doc_id", "source", "size").count()
    sizes = written(same.select("doc_id", "source", "size", F.explode(F.sequence(F.lit(1), F.col("count").cast("int"))).alias("salt")))
    goals = targets(sizes, cap, cycle).withColumnRenamed("source", "goal_source")
    n_sources, most = goals.agg(F.count("*"), F.max("n_docs")).first()
    if n_sources <= BROADCAST_ROWS:
        goals = F.broadcast(goals)
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = (
        sizes.join(goals, F.col("source").eqNullSafe(F.col("goal_source")))
        .select(
            "doc_id", "source", "size", "salt", "source_size", "n_docs", "target",
            F.least(F.floor(times), F.lit(cap)).cast("long").alias("base"),
            (times - F.floor(times)).alias("p"),
        )
    )
    fractional = (F.col("p") > 0) & (F.col("size") > 0)
    fixed = rows.filter(~fractional).select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("base") + (_uniform(F.col("doc_id"), F.col("source"), F.col("salt"), F.lit(seed)) < F.col("p")).cast("long")).alias("copies"),
    )
    open_ = rows.filter(fractional).select(
        "source", "source_size", "target", "n_docs",
        F.struct("doc_id", "size", "salt", "base", "p").alias("doc"),
    )
    settled, level = fixed, 0
    while True:
        last = BLOCK ** (level + 1) >= (most or 0)
        # a level leaves one open document per block, so block counts fall by BLOCK from level to level
        blocks = F.greatest(F.ceil(F.col("n_docs") / F.lit(float(BLOCK) ** (level + 1))), F.lit(1)).cast("long")
        key = F.pmod(F.xxhash64(F.col("doc.doc_id"), F.col("doc.size"), F.col("doc.salt"), F.lit(seed + level)), blocks)
        folded = (
            open_.withColumn("block", key)
            .groupBy("source", "block")
            .agg(F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.first("n_docs").alias("n_docs"),
                 F.array_sort(F.collect_list(F.col("doc"))).alias("docs"))
            .select("source", "source_size", "target", "n_docs", F.explode(_fold(F.col("docs"), level, seed, last)).alias("doc"))
        )
        folded = written(folded)
        whole = (F.col("doc.p") <= 0) | (F.col("doc.p") >= 1)
        level += 1
        done = folded if last else folded.filter(whole)
        settled = settled.unionByName(done.select(
            "doc.doc_id", "source", "doc.size", "source_size", "target",
            (F.col("doc.base") + F.round("doc.p").cast("long")).alias("copies"),
        ))
        if last:
            return settled
        open_ = folded.filter(~whole)
