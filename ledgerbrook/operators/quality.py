"""Rules over records: which rows fail which rule, and the counts per rule."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ledgerbrook.functions import columns as fx
from ledgerbrook.operators.dedup import repeated_keys
from ledgerbrook.operators.lookup import lookup
from ledgerbrook.settings import (
    ACCOUNT_STATUSES, CHANNELS, CUSTOMER_SEGMENTS, REQUIRED_FIELDS,
    TRANSACTION_STATUSES, TRANSACTION_TYPES, QualitySettings,
)

EMPTY_PASS_RATE = 100.0


@dataclass(frozen=True)
class Rule:
    """A named check. Row rules carry `fails`, a condition over the row's columns;
    key rules carry `bad_keys`, a function giving one row per failing key with its number of rows, `cnt`.

    `rejects=False` makes a rule count towards the results without sending its
    rows to quarantine.
    """

    name: str
    check_type: str
    columns: tuple[str, ...]
    reason: str
    fails: Column | None = None
    bad_keys: object = None
    rejects: bool = True


def completeness(*columns: str, name: str | None = None) -> Rule:
    """Fails where any of the columns is NULL."""
    if not columns:
        raise ValueError("completeness needs at least one column")
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    return Rule(name or "COMPLETENESS", "COMPLETENESS", columns, "Missing critical values", missing)


def in_range(column: str, low, high=None, name: str | None = None) -> Rule:
    """Passes within [low, high]; NULL fails."""
    inside = F.col(column) >= low
    if high is not None:
        inside = inside & (F.col(column) <= high)
    return Rule(name or f"RANGE_{column}", "RANGE", (column,), f"Out of range: {column}", ~fx.holds(inside))


def allowed(column: str, values, name: str | None = None) -> Rule:
    """Fails outside the list; NULL passes, completeness reports it."""
    outside = fx.holds(~F.col(column).isin(list(values)))
    return Rule(name or f"VALIDITY_{column}", "VALIDITY", (column,), f"Invalid value: {column}", outside)


def not_future(column: str, as_of: dt.datetime, name: str | None = None) -> Rule:
    """Fails after `as_of`; NULL passes."""
    late = fx.holds(F.col(column) > F.lit(as_of).cast("timestamp_ntz"))
    return Rule(name or f"TIMESTAMP_{column}", "TIMESTAMP", (column,), f"Future timestamp: {column}", late)


def unique(key: str, name: str | None = None, rejects: bool = True) -> Rule:
    """All copies of a repeated key fail; NULL keys never do."""
    return Rule(name or f"UNIQUENESS_{key}", "UNIQUENESS", (key,), f"Duplicate {key}",
                bad_keys=lambda df: repeated_keys(df, key), rejects=rejects)


def orphan_keys(df: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Distinct values of `column` without a parent row, with their number of rows.

    The values are counted before the join, so neither a hot parent nor a
    hot orphan reaches it more than once.
    """
    known = parent.select(F.col(parent_key).alias(column)).where(F.col(column).isNotNull()).distinct()
    used = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("cnt"))
    return used.join(known, column, "left_anti")


def well_formed(column: str, text: str, name: str | None = None) -> Rule:
    """Fails where the text was given and its typed column is NULL."""
    bad = F.col(text).isNotNull() & F.col(column).isNull()
    return Rule(name or f"FORMAT_{column}", "VALIDITY", (column,), f"Malformed value: {column}", bad)


def references(column: str, parent: DataFrame, parent_key: str, name: str | None = None) -> Rule:
    """Fails where a known value has no parent; NULL passes."""
    return Rule(name or f"REFERENTIAL_{column}", "REFERENTIAL", (column,), f"Unknown {column}",
                bad_keys=lambda df: orphan_keys(df, column, parent, parent_key))


# ---- evaluation ----------------------------------------------------------------


def _judged(df: DataFrame, rule: Rule, checked: DataFrame) -> tuple[DataFrame, Column]:
    """`checked` with whatever the rule needs, and the rule's failure condition."""
    if rule.fails is not None:
        return checked, rule.fails
    mark = f"__{rule.name}"
    bad = rule.bad_keys(df).select(*rule.columns, F.lit(True).alias(mark))
    return lookup(checked, bad, rule.columns[0]), F.col(mark)


def evaluate(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add `failed_rules`, the names of the rules each row fails. No row is dropped.

    Row rules cost nothing but an expression; each key rule adds a join with its
    failing keys, which are few where the data is mostly good.
    """
    if len({r.name for r in rules}) != len(rules):
        raise ValueError("rule names must differ")
    checked, failures = df, []
    for rule in rules:
        checked, failed = _judged(df, rule, checked)
        failures.append((failed, rule.name))
    return checked.select(*df.columns, fx.chosen(failures).alias("failed_rules"))


def is_rejected(rules: list[Rule]) -> Column:
    """Whether an evaluated row fails a rejecting rule."""
    names = F.array(*[F.lit(r.name) for r in rules if r.rejects]).cast("array<string>")
    return F.arrays_overlap("failed_rules", names)


def passed(evaluated: DataFrame, rules: list[Rule]) -> DataFrame:
    return evaluated.where(~is_rejected(rules)).drop("failed_rules")


def rejected(evaluated: DataFrame, rules: list[Rule], record_id: str) -> DataFrame:
    """One row per (rejected record, rule): ids, reason and the record as JSON."""
    reasons = F.create_map(*[F.lit(t) for r in rules for t in (r.name, r.reason)])
    rejecting = F.array(*[F.lit(r.name) for r in rules if r.rejects]).cast("array<string>")
    data = [c for c in evaluated.columns if c != "failed_rules"]
    return evaluated.select(
        F.col(record_id).alias("record_id"),
        F.explode(F.array_intersect("failed_rules", rejecting)).alias("failed_rule"),
        F.to_json(F.struct(*data)).alias("raw_data"),
    ).select("record_id", reasons[F.col("failed_rule")].alias("failure_reason"), "failed_rule", "raw_data")


def quarantined(rejects: DataFrame, dataset: str, run_id: str, rejected_at: dt.datetime) -> DataFrame:
    """Rejected rows in the shape of the rejected-records table.

    The id is a digest of the run, the dataset, the record, the rule and the number of the copy, so repeating a run
    gives the same ids. Only rows equal in all of these are numbered together.
    """
    copy = Window.partitionBy("record_id", "failed_rule", "raw_data").orderBy("failure_reason")
    parts = (F.lit(run_id), F.lit(dataset), F.coalesce("record_id", F.lit("")), F.col("failed_rule"), F.coalesce("raw_data", F.lit("")), F.row_number().over(copy).cast("string"))
    return rejects.select(
        F.sha2(F.concat_ws("\x1f", *parts), 256).alias("rejection_id"),
        F.lit(run_id).alias("run_id"),
        F.lit(dataset).alias("dataset"),
        "record_id", "failure_reason", "failed_rule", "raw_data",
        F.lit(rejected_at).alias("rejected_at"),
    )


def status_of(failed: Column, rate: Column, warn_from: float) -> Column:
    return F.when(failed == 0, "PASS").when(rate >= warn_from, "WARN").otherwise("FAIL")


def results(evaluated: DataFrame, rules: list[Rule], dataset: str, warn_from: float = 95.0) -> DataFrame:
    """One row per rule with its counts, from a single aggregation over the rows."""
    counts = evaluated.agg(
        F.count("*").alias("total_records"),
        *[F.count_if(F.array_contains("failed_rules", r.name)).alias(f"f{i}") for i, r in enumerate(rules)],
    )
    rows = F.array(*[
        F.struct(
            F.lit(r.name).alias("check_name"),
            F.lit(r.check_type).alias("check_type"),
            F.lit(",".join(r.columns)).alias("columns"),
            F.col("total_records"),
            (F.col("total_records") - F.col(f"f{i}")).alias("passed_records"),
            F.col(f"f{i}").alias("failed_records"),
        )
        for i, r in enumerate(rules)
    ])
    return _with_status(counts.select(F.inline(rows)), dataset, warn_from)


def observed(evaluated: DataFrame, rules: list[Rule], **more: Column) -> tuple[DataFrame, Observation]:
    """The evaluated rows with counts that any job which writes them collects on the way: all rows, the rejected ones, those
    that fail each rule, and `more` aggregates."""
    seen = Observation()
    counts = [F.count_if(F.array_contains("failed_rules", r.name)).alias(f"f{i}") for i, r in enumerate(rules)]
    rejected_rows = F.count_if(is_rejected(rules)).alias("rejected")
    named = [c.alias(name) for name, c in more.items()]
    return evaluated.observe(seen, F.count("*").alias("total"), rejected_rows, *counts, *named), seen


def results_of(spark: SparkSession, metrics: dict, rules: list[Rule], dataset: str, warn_from: float = 95.0) -> DataFrame:
    """The same rows as `results`, from the observed counts."""
    total = metrics["total"]
    rows = [
        (r.name, r.check_type, ",".join(r.columns), total, total - metrics[f"f{i}"], metrics[f"f{i}"]) for i, r in enumerate(rules)
    ]
    counts = spark.createDataFrame(
        rows, "check_name string, check_type string, columns string, total_records long, passed_records long, failed_records long")
    return _with_status(counts, dataset, warn_from)


def tally(df: DataFrame, rules: list[Rule], dataset: str, warn_from: float = 95.0) -> DataFrame:
    """The same rows as `results`, without judging every row by every rule.

    Row rules are counted in one aggregation; a key rule counts the rows of its failing keys from
    the rows per key, so no row is joined.
    """
    row_rules = [r for r in rules if r.fails is not None]
    counted = df.agg(F.count("*").alias("total"), *[F.count_if(r.fails).alias(f"f{i}") for i, r in enumerate(row_rules)])
    pairs = F.array(
        F.struct(F.lit("").alias("check"), F.col("total").alias("n")),
        *[F.struct(F.lit(r.name).alias("check"), F.col(f"f{i}").alias("n")) for i, r in enumerate(row_rules)],
    )
    failed = counted.select(F.inline(pairs))
    for r in rules:
        if r.fails is None:
            n = F.coalesce(F.sum("cnt"), F.lit(0)).alias("n")
            failed = failed.unionByName(r.bad_keys(df).agg(n).select(F.lit(r.name).alias("check"), "n"))
    # one row: the counts by rule
    by_name = failed.agg(F.map_from_entries(F.collect_list(F.struct("check", "n"))).alias("n"))
    rows = F.array(*[
        F.struct(
            F.lit(r.name).alias("check_name"), F.lit(r.check_type).alias("check_type"), F.lit(",".join(r.columns)).alias("columns"),
            F.col("n")[""].alias("total_records"), (F.col("n")[""] - F.col("n")[r.name]).alias("passed_records"),
            F.col("n")[r.name].alias("failed_records"),
        )
        for r in rules
    ])
    return _with_status(by_name.select(F.inline(rows)), dataset, warn_from)


def _with_status(counts: DataFrame, dataset: str, warn_from: float) -> DataFrame:
    rate = F.when(F.col("total_records") == 0, F.lit(EMPTY_PASS_RATE)).otherwise(
        F.col("passed_records") / F.col("total_records") * 100
    )
    return counts.withColumn("pass_rate", rate).select(
        F.lit(dataset).alias("dataset"), "*",
        status_of(F.col("failed_records"), F.col("pass_rate"), warn_from).alias("status"),
    )


# ---- one check at a time ---------------------------------------------------------


def _checked(df: DataFrame, rule: Rule, dataset: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    evaluated = evaluate(df, [rule])
    failed = evaluated.where(F.size("failed_rules") > 0).drop("failed_rules")
    return (
        passed(evaluated, [rule]),
        failed.withColumn("failure_reason", F.lit(rule.reason)),
        results(evaluated, [rule], dataset),
    )


def check_completeness(df: DataFrame, columns: list[str], dataset: str = "") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(passed, failed with `failure_reason`, one-row result); all three lazy."""
    return _checked(df, completeness(*columns), dataset)


def check_uniqueness(df: DataFrame, unique_key: str, dataset: str = "") -> tuple[DataFrame, DataFrame, DataFrame]:
    """As `check_completeness`; the result is counted from the keys, without the rows."""
    rule = unique(unique_key)
    repeated = rule.bad_keys(df).select(unique_key)
    per_key = df.groupBy(unique_key).agg(F.count("*").alias("n"))
    bad = F.col(unique_key).isNotNull() & (F.col("n") > 1)
    counts = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(bad, F.col("n"))), F.lit(0)).alias("failed"),
    )
    rate = F.when(F.col("total") == 0, F.lit(EMPTY_PASS_RATE)).otherwise(
        (F.col("total") - F.col("failed")) / F.col("total") * 100
    )
    result = counts.select(
        F.lit(dataset).alias("dataset"),
        F.lit(rule.name).alias("check_name"), F.lit(rule.check_type).alias("check_type"),
        F.lit(unique_key).alias("columns"),
        F.col("total").alias("total_records"),
        (F.col("total") - F.col("failed")).alias("passed_records"),
        F.col("failed").alias("failed_records"),
        rate.alias("pass_rate"),
        status_of(F.col("failed"), rate, 95.0).alias("status"),
    )
    return (
        lookup(df, repeated, unique_key, "left_anti"),
        lookup(df, repeated, unique_key, "left_semi").withColumn("failure_reason", F.lit(rule.reason)),
        result,
    )


def check_range(df: DataFrame, column: str, min_val, max_val=None, dataset: str = "") -> tuple[DataFrame, DataFrame, DataFrame]:
    return _checked(df, in_range(column, min_val, max_val), dataset)


# ---- declared rule sets ------------------------------------------------------------


def transaction_rules(settings: QualitySettings, accounts: DataFrame | None = None,
                      as_of: dt.datetime | None = None, landed: bool = False) -> list[Rule]:
    """Rules for conformed transactions; `landed` adds those for the landing stamps.

    Repeated ids are reported but not rejected: the newest copy is kept and the
    others are quarantined by the deduplication step.
    """
    required = ["transaction_timestamp" if c == "timestamp" else c for c in REQUIRED_FIELDS["transactions"]]
    rules = [
        completeness(*required),
        in_range("amount", settings.amount_min, settings.amount_max),
        allowed("transaction_type", TRANSACTION_TYPES),
        allowed("status", TRANSACTION_STATUSES),
        allowed("channel", CHANNELS),
        unique("transaction_id", rejects=False),
    ]
    if as_of is not None:
        rules.append(not_future("transaction_timestamp", as_of))
    if landed:
        rules.append(well_formed("ingestion_timestamp", "ingestion_text"))
        if as_of is not None:
            rules.append(not_future("ingestion_timestamp", as_of))
    if accounts is not None:
        rules.append(references("account_id", accounts, "account_id"))
    return rules


def customer_rules(settings: QualitySettings) -> list[Rule]:
    return [
        completeness(*REQUIRED_FIELDS["customers"]),
        in_range("age", settings.age_min, settings.age_max),
        allowed("customer_segment", CUSTOMER_SEGMENTS),
        unique("customer_id", rejects=False),
    ]


def account_rules(settings: QualitySettings, customers: DataFrame | None = None) -> list[Rule]:
    rules = [
        completeness(*REQUIRED_FIELDS["accounts"]),
        in_range("balance", settings.balance_min),
        allowed("account_status", ACCOUNT_STATUSES),
        unique("account_id", rejects=False),
    ]
    if customers is not None:
        rules.append(references("customer_id", customers, "customer_id"))
    return rules


def branch_rules() -> list[Rule]:
    return [completeness("branch_id"), unique("branch_id", rejects=False)]


def merchant_rules() -> list[Rule]:
    return [completeness("merchant_id"), unique("merchant_id", rejects=False)]
