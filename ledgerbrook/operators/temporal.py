"""Versioned dimensions from snapshots in any order, and the version in force at a time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerbrook.functions import columns as fx
from ledgerbrook.operators.lookup import lookup
from ledgerbrook.settings import END_OF_TIME

SEEN = ("first_seen", "last_seen")
#: Width of the slices in which versions are looked up.
SLICE_DAYS = 32


def _moment(value: dt.datetime | str) -> Column:
    return F.lit(str(value)).cast("timestamp_ntz")


# ---- history from snapshots --------------------------------------------------------------------


def seen_once(snapshot: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    """A snapshot as runs of one observation each."""
    return snapshot.withColumns({c: _moment(as_of) for c in SEEN})


def _differs(columns: list[str], key: str) -> Column:
    """Whether a row's values differ from those of the row before it; true for a key's first row."""
    values = F.struct(*[F.col(c) for c in columns])
    return ~values.eqNullSafe(F.lag(values).over(Window.partitionBy(key).orderBy("first_seen")))


def _islands(rows: DataFrame, starts: Column, key: str) -> DataFrame:
    """Rows of a key in time order, joined up to the next one that starts anew.

    An island is its first row, which takes the end of the last one from the row after the island. All windows
    share one order, so a task sorts its rows once, however many steps follow.
    """
    order = Window.partitionBy(key).orderBy("first_seen")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    numbered = rows.withColumn("__starts", starts).withColumn("__island", F.sum(F.col("__starts").cast("int")).over(order))
    end = F.struct("__island", "last_seen")
    ended = numbered.withColumns({
        "__opens": ~F.col("__island").eqNullSafe(F.lag("__island").over(order)),
        "__before": F.max(end).over(earlier), "__end": F.max(end).over(whole),
    })
    last = F.coalesce(F.lead("__before").over(order), F.col("__end"))["last_seen"]
    return ended.where("__opens").withColumn("last_seen", last).drop("__starts", "__island", "__opens", "__before", "__end")


def observe(runs: DataFrame | None, taken: list[dt.datetime], snapshot: DataFrame, key: str, as_of: dt.datetime) -> DataFrame:
    """Take a snapshot, of any time, into the runs of observations of a dimension.

    A run is a key with its values and the first and last of the consecutive snapshots that showed them;
    `taken` are the times of the snapshots so far (one per load, so a short list). A snapshot between two others divides the
    runs that it does not confirm; one of a time already taken replaces it. The outcome depends on the snapshots alone,
    not on the order of their arrival. Snapshots have one row per key; a key's runs meet in one window, at most
    one per snapshot. Each snapshot is a shuffle of its own, by the hint: otherwise all snapshots of a dimension, shuffled
    by the same key, would be taken in by one stage whose tasks hold every sort of every step at once.
    """
    if runs is None:
        return seen_once(snapshot, as_of)
    columns = [c for c in runs.columns if c != key and c not in SEEN]
    now = _moment(as_of)
    earlier, later = max((t for t in taken if t < as_of), default=None), min((t for t in taken if t > as_of), default=None)
    first, last = F.col("first_seen"), F.col("last_seen")
    none = F.lit(None).cast("timestamp_ntz")
    before = F.struct(first.alias("first_seen"), (F.least(last, _moment(earlier)) if earlier else none).alias("last_seen"))
    after = F.struct((F.greatest(first, _moment(later)) if later else none).alias("first_seen"), last.alias("last_seen"))
    sides = F.array_compact(F.array(F.when(first < now, before), F.when(last > now, after)))
    divided = runs.select(key, *columns, F.explode(sides).alias("seen")).select(key, *columns, "seen.*")
    rows = divided.unionByName(seen_once(snapshot.select(key, *columns), as_of)).hint("rebalance", key)
    ended = F.lag("last_seen").over(Window.partitionBy(key).orderBy("first_seen"))
    follows = F.lit(False)
    if earlier:
        follows |= (ended == _moment(earlier)) & (first == now)
    if later:
        follows |= (ended == now) & (first == _moment(later))
    return _islands(rows, _differs(columns, key) | ~fx.holds(follows), key).select(key, *columns, *SEEN)


def history(runs: DataFrame, key: str) -> DataFrame:
    """The versions of a dimension: values hold from the first snapshot that showed them to the first that showed others.

    Keys missing from a snapshot keep their values. Intervals of a key don't overlap and leave no gap, the
    last one is active.
    """
    columns = [c for c in runs.columns if c != key and c not in SEEN]
    versions = _islands(runs, _differs(columns, key), key)
    following = F.lead("first_seen").over(Window.partitionBy(key).orderBy("first_seen"))
    return versions.select(
        key, *columns, following.isNull().alias("is_active"), F.col("first_seen").alias("valid_from"),
        F.coalesce(following, _moment(END_OF_TIME)).alias("valid_to"),
    )


def runs_of(versions: DataFrame) -> DataFrame:
    """Runs from versions whose snapshots are not known: each was seen when it began."""
    return versions.withColumns({c: F.col("valid_from") for c in SEEN}).drop("is_active", "valid_from", "valid_to")


# ---- the version in force --------------------------------------------------------------------------


def _merged(versions: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """Versions reduced to some attributes: those that follow each other with equal ones are one. Empty versions don't count."""
    order = Window.partitionBy(key).orderBy("valid_from", "valid_to", *attributes)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    values = F.struct(F.col("valid_from").alias("at"), *attributes)
    before = F.lag(F.struct(F.col("valid_to").alias("at"), *attributes)).over(order)
    held = versions.where(F.col(key).isNotNull() & (F.col("valid_from") < F.col("valid_to"))).select(
        key, "valid_from", "valid_to", *[c for c in attributes if c != "valid_from"])
    opening = held.withColumns({
        "__opens": ~values.eqNullSafe(before), "__before": F.lag("valid_to").over(order), "__end": F.last("valid_to").over(whole),
    }).where("__opens")
    return opening.withColumn("valid_to", F.coalesce(F.lead("__before").over(order), F.col("__end"))).drop("__opens", "__before", "__end")


def _listed(versions: DataFrame, key: str, attributes: list[str], slice_days: int = SLICE_DAYS) -> DataFrame:
    """One row per key with its versions in time order, as `__chunks` of those that begin in one slice of time.

    A key has one version per change of the attributes, so one per snapshot at most.
    """
    begins = fx.floor_to(fx.micros("valid_from"), slice_days * fx.DAY).alias("__slice")
    version = F.struct(F.col("valid_from").alias("__from"), F.col("valid_to").alias("__to"), *attributes)
    chunks = _merged(versions, key, attributes).groupBy(key, begins).agg(F.sort_array(F.collect_list(version)).alias("versions"))
    return chunks.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("__slice", "versions"))).alias("__chunks"))


def _first() -> Column:
    return F.try_element_at(F.try_element_at("__chunks", F.lit(1))["versions"], F.lit(1))


def _holding(at: str, before_first: bool) -> Column:
    """The listed version that holds at a time: the last begun one, sought in the last begun chunk."""
    moment = F.col(at)
    chunk = F.try_element_at(F.filter("__chunks", lambda c: c["versions"][0]["__from"] <= moment), F.lit(-1))
    begun = F.try_element_at(F.filter(chunk["versions"], lambda v: v["__from"] <= moment), F.lit(-1))
    holding = F.try_element_at(F.filter(F.array(begun), lambda v: moment < v["__to"]), F.lit(1))
    if before_first:
        holding = F.coalesce(holding, F.when(moment < _first()["__from"], _first()))
    return holding


def in_force(facts: DataFrame, versions: DataFrame, key: str, at: str, attributes: list[str], before_first: bool = False,
             slice_days: int = SLICE_DAYS) -> DataFrame:
    """`facts` with `attributes` of the version of `key` that holds at the time `at`; NULL where none does.

    A version holds from valid_from (inclusive) to valid_to (exclusive); `versions` of a key don't overlap, empty ones
    don't count. With `before_first` a key's first version also holds before it began.

    A fact meets the list of its key's versions by equality, so facts are read and shuffled once, there is no range join,
    and a hot key is an ordinary skewed join that adaptive execution splits. A list is cut into slices of time; a fact
    looks at the beginnings of the slices and at the versions of one of them.
    """
    clash = [c for c in attributes if c in facts.columns]
    if clash:
        raise ValueError(f"columns exist already: {', '.join(clash)}")
    joined = lookup(facts, _listed(versions, key, attributes, slice_days), key)
    return joined.withColumn("__version", _holding(at, before_first)).select(
        *[F.col(c) for c in facts.columns], *[F.col("__version")[c].alias(c) for c in attributes]
    )


def composed(versions: DataFrame, key: str, others: DataFrame, on: str, attributes: list[str], before_first: bool = False) -> DataFrame:
    """The `versions` of a dimension by `key`, divided where the version of `on` among `others` changes, with its `attributes`.

    Facts that look up `key` in the outcome, with the same `before_first`, get what they would get by looking up `key` in
    `versions` and then `on` in `others`; so the dimensions are shuffled to meet, not the facts. With `before_first` a
    key's first version is divided from the other's first one on.
    """
    clash = [c for c in attributes if c in versions.columns]
    if clash:
        raise ValueError(f"columns exist already: {', '.join(clash)}")
    own = [c for c in versions.columns if c not in (key, "valid_from", "valid_to")]
    order = Window.partitionBy(key).orderBy("valid_from", "valid_to", *own)
    held = _merged(versions, key, own).withColumns({
        "__opens": F.lag("valid_from").over(order).isNull(), "valid_to": F.least("valid_to", F.lead("valid_from").over(order)),
    })
    joined = lookup(held, _listed(others, on, attributes), on)
    since = F.when(F.col("__opens"), F.least("valid_from", _first()["__from"])) if before_first else F.lit(None)
    started = joined.withColumn("valid_from", F.coalesce(since, F.col("valid_from")))
    ends = F.flatten(F.transform("__chunks", lambda c: F.flatten(F.transform(c["versions"], lambda v: F.array(v["__from"], v["__to"])))))
    inside = F.filter(ends, lambda t: (t > F.col("valid_from")) & (t < F.col("valid_to")))
    cuts = F.concat(F.array("valid_from"), F.coalesce(inside, F.array().cast("array<timestamp_ntz>")))
    divided = started.withColumn("__cuts", F.array_sort(F.array_distinct(cuts)))
    pieces = F.transform("__cuts", lambda t, i: F.struct(t.alias("valid_from"), F.coalesce(F.get("__cuts", i + 1), F.col("valid_to")).alias("valid_to")))
    exploded = divided.select(key, *own, "__chunks", F.explode(pieces).alias("__piece")).select(key, *own, "__chunks", "__piece.*")
    return exploded.withColumn("__version", _holding("valid_from", before_first)).select(
        key, *own, "valid_from", "valid_to", *[F.col("__version")[c].alias(c) for c in attributes]
    )
