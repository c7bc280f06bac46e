"""Joining a large side, which may be skewed, to a side with one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame


def lookup(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "left",
           keyed: bool = True) -> DataFrame:
    """Join `left` (any skew, NULL keys allowed) to `right` (one row per key).

    No broadcast is forced: Spark broadcasts `right` where its measured size is
    under `autoBroadcastJoinThreshold`, and otherwise shuffles both sides.
    In that case one key of `left` may hold a third of all rows, and adaptive
    execution has to split its partition over many tasks. It does so only
    where both join inputs are shuffles of their own, which the rebalance hint
    ensures: a `right` that was just deduplicated or grouped on the same key
    would otherwise be joined in place, and the hot key kept in one task.
    `right` is the small side, so its extra pass costs little; `keyed=False` says
    that it comes partitioned by something else and needs no hint.
    """
    return left.join(right.hint("rebalance") if keyed else right, on, how)
