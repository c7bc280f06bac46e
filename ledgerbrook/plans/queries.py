"""The registered queries. Each takes (spark, sf_dir) and reads whole tables.

Results leave in portable types: exact decimals as doubles, dates and times as
text, so that any engine's client compares them alike.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from ledgerbrook.functions import columns as fx
from ledgerbrook.operators import (
    analytics, cleansing, enrichment, fraud, incremental, quality, sets, temporal, warehouse,
)
from ledgerbrook.operators.dedup import latest_per_key, repeated_keys
from ledgerbrook.plans import views
from ledgerbrook.settings import SAMPLE_SIZES, FraudSettings, Settings
from ledgerbrook.sources import lake

SETTINGS = Settings()
# Looser thresholds than the defaults, so that the rules fire on the given events.
EVENT_RULES = replace(
    FraudSettings(), velocity_count=2, large_multiplier=5, large_history_days=7,
    failed_count=2, failed_minutes=720,
)
AS_OF_DATE = dt.date(2024, 12, 31)
AS_OF = dt.datetime(1998, 6, 1)
WATERMARK = "2024-01-15 00:00:00"
SNAPSHOT_1, SNAPSHOT_2 = "2020-01-01 00:00:00", "2024-01-01 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def portable(df: DataFrame) -> DataFrame:
    def converted(field):
        c = F.col(field.name)
        if isinstance(field.dataType, DecimalType):
            return c.cast("double").alias(field.name)
        if isinstance(field.dataType, DateType):
            return F.date_format(c, "yyyy-MM-dd").alias(field.name)
        if isinstance(field.dataType, (TimestampType, TimestampNTZType)):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(field.name)
        return c

    return df.select(*[converted(f) for f in df.schema])


def query(build: Query) -> Query:
    """Register a query under its function name."""
    REGISTRY[build.__name__] = lambda spark, sf_dir: portable(build(spark, sf_dir))
    return build


# ---- entities, cleaned ----------------------------------------------------------


def _clean(spark, d):
    return (
        cleansing.clean_transactions(views.tx_bulk(spark, d)),
        cleansing.clean_accounts(views.accounts(spark, d)),
        cleansing.clean_customers(views.customers(spark, d)),
    )


def _clean_merchants(spark, d):
    return cleansing.with_merchant_risk(cleansing.clean_merchants(views.merchants(spark, d)))


def _scored(spark, d):
    """Clean transactions with the threshold flags and score."""
    tx = cleansing.clean_transactions(views.tx_bulk(spark, d))
    return fraud.calculate_fraud_score(fraud.apply_rules(tx))


@query
def clean_customers(spark, d):
    return cleansing.clean_customers(views.customers(spark, d))


@query
def clean_accounts(spark, d):
    return cleansing.clean_accounts(views.accounts(spark, d))


@query
def clean_transactions(spark, d):
    return cleansing.clean_transactions(views.tx_bulk(spark, d))


@query
def clean_branches(spark, d):
    return cleansing.clean_branches(views.branches(spark, d))


@query
def clean_merchants(spark, d):
    return cleansing.clean_merchants(views.merchants(spark, d))


@query
def valid_customer_keys(spark, d):
    return cleansing.valid_keys(views.customers(spark, d), "customer_id", "customer_segment")


@query
def merchant_risk(spark, d):
    return _clean_merchants(spark, d).select("merchant_id", "merchant_category", "risk_category")


# ---- sources ----------------------------------------------------------------------


@query
def union_batches(spark, d):
    tx = views.tx_bulk(spark, d)
    batches = [tx.where(F.col("status") == s) for s in ("SUCCESS", "FAILED", "PENDING")]
    # one batch lacks a column, as an older file would
    batches[2] = batches[2].drop("payment_method")
    return (
        cleansing.conform_transactions(lake.union_batches(batches))
        .groupBy("transaction_type", "payment_method")
        .agg(F.count("*").alias("records"), analytics.money_sum("amount").alias("amount"))
    )


MANIFEST = ("customer", "events", "lineitem", "nation", "orders", "region", "supplier")


@query
def files_manifest(spark, d):
    return lake.union_batches([lake.files_manifest(views.table(spark, d, t)) for t in MANIFEST])


@query
def ingest_summary(spark, d):
    entities = {"branches": "nation", "merchants": "supplier", "customers": "customer",
                "accounts": "customer", "transactions": "lineitem"}
    return lake.ingestion_summary({name: views.table(spark, d, t) for name, t in entities.items()})


@query
def sample_n(spark, d):
    entities = {"branches": ("branch_id", views.branches), "merchants": ("merchant_id", views.merchants),
                "customers": ("customer_id", views.customers), "accounts": ("account_id", views.accounts)}
    return lake.union_batches([
        lake.sample_n(view(spark, d), key, SAMPLE_SIZES[name])
        .select(F.lit(name).alias("dataset"), F.col(key).alias("record_id"))
        for name, (key, view) in entities.items()
    ])


# ---- enrichment -------------------------------------------------------------------


@query
def enrich_customers(spark, d):
    customers = cleansing.clean_customers(views.customers(spark, d))
    return enrichment.enrich_customers(customers, AS_OF_DATE).select(
        "customer_id", "tenure_years", "high_income_flag"
    )


@query
def enrich_transactions(spark, d):
    return enrichment.enrich_transactions(*_clean(spark, d)).select(*enrichment.ENRICHED)


# ---- quality ------------------------------------------------------------------------


def _conformed(spark, d):
    return cleansing.conform_transactions(views.tx_bulk(spark, d))


def _rules(spark, d):
    return quality.transaction_rules(SETTINGS.quality, views.accounts(spark, d), AS_OF)


def _failing(spark, d, rule):
    df = _conformed(spark, d)
    return (
        quality.evaluate(df, [rule]).where(F.size("failed_rules") > 0)
        .select("transaction_id", "account_id", "amount", "status", "channel", "transaction_timestamp",
                F.lit(rule.reason).alias("failure_reason"))
    )


@query
def dq_completeness(spark, d):
    _, failed, _ = quality.check_completeness(_conformed(spark, d), ["transaction_id", "account_id", "amount"])
    return failed.select("transaction_id", "account_id", "amount", "merchant_id", "failure_reason")


@query
def dq_uniqueness(spark, d):
    _, _, result = quality.check_uniqueness(_conformed(spark, d), "transaction_id", "transactions")
    return result


@query
def dq_uniqueness_failed(spark, d):
    _, failed, _ = quality.check_uniqueness(_conformed(spark, d), "transaction_id")
    return failed.select("transaction_id", "account_id", "amount", "merchant_id", "failure_reason")


@query
def dq_uniqueness_passed(spark, d):
    good, _, _ = quality.check_uniqueness(_conformed(spark, d), "transaction_id")
    return good.select("transaction_id", "account_id", "amount", "merchant_id")


@query
def dup_keys(spark, d):
    return repeated_keys(views.tx_bulk(spark, d), "transaction_id")


@query
def dq_range(spark, d):
    _, failed, _ = quality.check_range(
        cleansing.conform_customers(views.customers(spark, d)), "age",
        SETTINGS.quality.age_min, SETTINGS.quality.age_max,
    )
    _, overdrawn, _ = quality.check_range(
        cleansing.conform_accounts(views.accounts(spark, d)), "balance", SETTINGS.quality.balance_min
    )
    _, amounts, _ = quality.check_range(
        _conformed(spark, d), "amount", SETTINGS.quality.amount_min, SETTINGS.quality.amount_max
    )
    value = {"customer_id": "age", "account_id": "balance", "transaction_id": "amount"}
    frames = zip(("customer_id", "account_id", "transaction_id"), (failed, overdrawn, amounts))
    return lake.union_batches([
        df.select(F.col(key).alias("record_id"), F.col(value[key]).cast("double").alias("value"), "failure_reason")
        for key, df in frames
    ])


@query
def dq_validity(spark, d):
    return _failing(spark, d, quality.allowed("channel", quality.CHANNELS))


@query
def dq_referential(spark, d):
    return _failing(spark, d, quality.references("account_id", views.accounts(spark, d), "account_id"))


@query
def dq_timestamp(spark, d):
    return _failing(spark, d, quality.not_future("transaction_timestamp", AS_OF))


@query
def dq_results(spark, d):
    return quality.tally(_conformed(spark, d), _rules(spark, d), "transactions")


@query
def dq_customers(spark, d):
    customers = cleansing.conform_customers(views.customers(spark, d))
    return quality.tally(customers, quality.customer_rules(SETTINGS.quality), "customers")


@query
def dq_accounts(spark, d):
    accounts = cleansing.conform_accounts(views.accounts(spark, d))
    parents = cleansing.clean_customers(views.customers(spark, d))
    return quality.tally(accounts, quality.account_rules(SETTINGS.quality, parents), "accounts")


@query
def dq_validity_domains(spark, d):
    """Every value outside the domain of its column, over all five domains."""
    domains = (
        (_conformed(spark, d), "transaction_id", {
            "transaction_type": quality.TRANSACTION_TYPES, "status": quality.TRANSACTION_STATUSES, "channel": quality.CHANNELS}),
        (cleansing.conform_accounts(views.accounts(spark, d)), "account_id", {"account_status": quality.ACCOUNT_STATUSES}),
        (cleansing.conform_customers(views.customers(spark, d)), "customer_id", {"customer_segment": quality.CUSTOMER_SEGMENTS}),
    )
    return lake.union_batches([
        quality.evaluate(df, [quality.allowed(c, values) for c, values in columns.items()])
        .select(F.col(key).alias("record_id"), F.explode("failed_rules").alias("failed_rule"))
        for df, key, columns in domains
    ])


@query
def dq_rejected(spark, d):
    rules = _rules(spark, d)
    rejects = quality.rejected(quality.evaluate(_conformed(spark, d), rules), rules, "transaction_id")
    return rejects.select("record_id", "failed_rule", "failure_reason")


@query
def dq_passed(spark, d):
    rules = _rules(spark, d)
    good = quality.passed(quality.evaluate(_conformed(spark, d), rules), rules)
    return good.select("transaction_id", "account_id", "amount", "status", "channel")


# ---- fraud ----------------------------------------------------------------------------


@query
def fraud_basic(spark, d):
    return _scored(spark, d).select(
        "transaction_id", "amount", "channel", "fraud_flag_high_amount", "fraud_flag_risky_merchant",
        "fraud_score", "is_fraudulent",
    )


@query
def fraud_risky_merchant_dim(spark, d):
    tx = cleansing.clean_transactions(views.tx_bulk(spark, d))
    flagged = fraud.flag_risky_merchant_class(enrichment.with_merchant(tx, _clean_merchants(spark, d)))
    return flagged.select("transaction_id", "merchant_id", "merchant_risk_category", "fraud_flag_risky_merchant")


HIT = ("transaction_id", "account_id", "amount", "transaction_timestamp")


@query
def fraud_velocity(spark, d):
    return fraud.high_velocity(views.tx_events(spark, d), EVENT_RULES).select(*HIT, "recent_count")


@query
def fraud_impossible_location(spark, d):
    return fraud.impossible_location(views.tx_events(spark, d), EVENT_RULES).select(*HIT, "location")


def _city_geo(spark, d):
    """Coordinates of four of the five cities of the events."""
    return views.table(spark, d, "nation").where("n_nationkey < 4").selectExpr(
        "concat('CITY-', n_nationkey) city", "cast(10 + 2 * n_nationkey as double) lat", "cast(3 * n_nationkey as double) lon")


@query
def fraud_distance(spark, d):
    return fraud.impossible_location(views.tx_events(spark, d), EVENT_RULES, _city_geo(spark, d)).select(*HIT, "location")


@query
def fraud_large_tx(spark, d):
    return fraud.large_transaction(views.tx_events(spark, d), EVENT_RULES).select(*HIT, "prior_count", "prior_amount")


@query
def fraud_failed_then_success(spark, d):
    return fraud.failed_then_success(views.tx_events(spark, d), EVENT_RULES).select(*HIT, "recent_failed")


@query
def fraud_unusual_frequency(spark, d):
    return fraud.unusual_frequency(views.tx_events(spark, d), EVENT_RULES).select(*HIT, "day_count")


def _events_scored(spark, d):
    return fraud.score_rules(fraud.evaluate_rules(views.tx_events(spark, d), EVENT_RULES), EVENT_RULES)


def _alerts(spark, d):
    return fraud.alerts(_events_scored(spark, d))


@query
def fraud_score(spark, d):
    return _events_scored(spark, d).select(
        "transaction_id", "account_id", *[fraud.rule_flag(r) for r in fraud.RULES], "risk_score", "severity"
    )


@query
def fraud_alerts(spark, d):
    return _alerts(spark, d).select(
        "transaction_id", "account_id", "rule", "amount", "risk_score", "severity", "alert_rank"
    )


@query
def fraud_by_rule(spark, d):
    return analytics.fraud_by_rule(_alerts(spark, d))


@query
def fraud_trend(spark, d):
    return analytics.fraud_trend(_events_scored(spark, d))


# ---- warehouse ------------------------------------------------------------------------


@query
def dim_date(spark, d):
    return warehouse.dim_date(warehouse.date_bounds(_conformed(spark, d)))


def _number(key: str, prefix: int):
    """The number in a key, whatever its length."""
    return F.substring(key, F.lit(prefix + 1), F.length(key)).cast("bigint")


@query
def scd2_customer(spark, d):
    customers = cleansing.clean_customers(views.customers(spark, d))
    n = _number("customer_id", 5)
    first = warehouse.first_version(customers.where(n % 25 != 0), SNAPSHOT_1)
    changed = F.when(n % 10 == 0, "Premium").when(n % 10 == 1, F.lit(None)).otherwise(F.col("customer_segment"))
    second = customers.where(n % 17 != 0).withColumn("customer_segment", changed)
    return warehouse.scd2(first, second, "customer_id", SNAPSHOT_2)


@query
def scd2_account(spark, d):
    accounts = cleansing.clean_accounts(views.accounts(spark, d))
    n = _number("account_id", 4)
    first = warehouse.first_version(accounts.where(n % 25 != 0), SNAPSHOT_1)
    moved = F.when(n % 10 == 0, F.col("balance") + 1).otherwise(F.col("balance")).cast(fx.MONEY)
    second = accounts.where(n % 17 != 0).withColumn("balance", moved)
    return warehouse.scd2(first, second, "account_id", SNAPSHOT_2)


def _taken(snapshots: list[tuple[str, object]], key: str):
    """The runs of observations after some snapshots have arrived in the given order."""
    runs, taken = None, []
    for time, frame in snapshots:
        as_of = dt.datetime.fromisoformat(time)
        runs = temporal.observe(runs, taken, frame, key, as_of)
        taken.append(as_of)
    return runs


def _customer_versions(spark, d):
    """Four yearly snapshots: the latest before the first, one of them without a seventh of the customers."""
    customers = cleansing.clean_customers(views.customers(spark, d))
    n = _number("customer_id", 5)
    premium = F.when(n % 10 == 0, "Premium").otherwise(F.col("customer_segment"))
    nulled = F.when(n % 10 == 1, F.lit(None)).otherwise(premium)
    frames = {
        "1993-01-01 00:00:00": customers.where(n % 25 != 0), "1995-03-01 00:00:00": customers.withColumn("customer_segment", premium),
        "1996-01-01 00:00:00": customers.where(n % 7 != 0), "1997-01-01 00:00:00": customers.where(n % 17 != 0).withColumn("customer_segment", nulled),
    }
    return temporal.history(_taken([(t, frames[t]) for t in sorted(frames, key=lambda t: t[3] not in "57")], "customer_id"), "customer_id")


def _account_versions(spark, d):
    accounts = cleansing.clean_accounts(views.accounts(spark, d)).select("account_id", "customer_id", "branch_id")
    n = _number("account_id", 4)
    moved = F.when(n % 10 == 0, F.lit("BRN-0000")).otherwise(F.col("branch_id"))
    sold = F.when(n % 10 == 1, F.lit("CUST-0000001")).otherwise(F.col("customer_id"))
    return temporal.history(_taken([
        ("1997-01-01 00:00:00", accounts.where(n % 17 != 0).withColumn("customer_id", sold)),
        ("1993-01-01 00:00:00", accounts.where(n % 25 != 0)), ("1995-03-01 00:00:00", accounts.withColumn("branch_id", moved)),
    ], "account_id"), "account_id")


@query
def scd2_late(spark, d):
    return _customer_versions(spark, d)


@query
def fact_as_of(spark, d):
    tx = cleansing.clean_transactions(views.tx_bulk(spark, d))
    return warehouse.fact_as_of(tx, _account_versions(spark, d), _customer_versions(spark, d)).select(*warehouse.FACT)


@query
def customers_in_force(spark, d):
    """The segment of each account's owner when a transaction happened, or the first one known."""
    tx = cleansing.clean_transactions(views.tx_bulk(spark, d)).select("transaction_id", "account_id", "transaction_timestamp")
    at = "transaction_timestamp"
    owned = temporal.in_force(tx, _account_versions(spark, d), "account_id", at, ["customer_id"], before_first=True)
    return temporal.in_force(owned, _customer_versions(spark, d), "customer_id", at, ["customer_segment", "valid_from"], before_first=True)


@query
def scd1_merchant(spark, d):
    merchants = _clean_merchants(spark, d)
    n = _number("merchant_id", 4)
    incoming = merchants.where(n % 3 != 0).withColumn("merchant_name", F.upper("merchant_name"))
    return warehouse.upsert(merchants.where(n % 7 != 0), incoming, "merchant_id")


@query
def scd1_branch(spark, d):
    branches = cleansing.clean_branches(views.branches(spark, d))
    n = _number("branch_id", 4)
    incoming = branches.where(n % 3 != 0).withColumn("branch_type", F.lit("Metro"))
    return warehouse.upsert(branches.where(n % 7 != 0), incoming, "branch_id")


@query
def fact_transactions(spark, d):
    return warehouse.fact_transactions(*_clean(spark, d)).select(*warehouse.FACT)


@query
def upsert_transactions(spark, d):
    tx = cleansing.clean_transactions(views.tx_bulk(spark, d)).select(
        "transaction_id", "account_id", "amount", "status", "ingestion_timestamp"
    )
    early = tx.where(F.col("ingestion_timestamp") <= incremental.moment("1997-01-01 00:00:00"))
    late = tx.where(F.col("ingestion_timestamp") > incremental.moment("1996-07-01 00:00:00"))
    return warehouse.upsert(early, late.withColumn("status", F.lit("SETTLED")), "transaction_id")


# ---- summaries ------------------------------------------------------------------------


@query
def merchant_risk_counts(spark, d):
    return analytics.merchant_risk_counts(_clean_merchants(spark, d))


@query
def daily_branch_metrics(spark, d):
    return analytics.daily_branch_metrics(warehouse.fact_transactions(*_clean(spark, d)))


@query
def customer_segment_summary(spark, d):
    return analytics.customer_segment_summary(*_clean(spark, d))


def _active_days(spark, d):
    """The sets of active accounts of every day, the numbers of accounts, and the dimensions."""
    tx, accounts, customers = _clean(spark, d)
    numbers = sets.numbered(accounts, "account_id", lots=sets.lots_for(accounts.count()))
    dated = tx.where("transaction_timestamp is not null").select(
        "account_id", "amount", F.to_date("transaction_timestamp").alias("tx_date"))
    return sets.active_accounts(dated, numbers, ["tx_date"], SETTINGS.high_value_above), numbers, accounts, customers


@query
def segment_summary_by_sets(spark, d):
    days, numbers, accounts, customers = _active_days(spark, d)
    active = days.withColumn("month_id", fx.month_id("tx_date"))
    return analytics.segment_summary(sets.account_months(active, numbers), accounts, customers)


@query
def active_accounts_by_period(spark, d):
    days, *_ = _active_days(spark, d)
    return sets.accounts_by_period(days.withColumns({"year": F.year("tx_date"), "month": F.month("tx_date")}))


@query
def fraud_summary(spark, d):
    return analytics.fraud_summary(_scored(spark, d), _clean_merchants(spark, d))


@query
def exec_overview(spark, d):
    return analytics.exec_overview(cleansing.clean_transactions(views.tx_bulk(spark, d)))


def _profiles(spark, d):
    _, accounts, customers = _clean(spark, d)
    return enrichment.account_profiles(accounts, customers)


@query
def top_customers(spark, d):
    return analytics.top_customers(cleansing.clean_transactions(views.tx_bulk(spark, d)), _profiles(spark, d))


@query
def segment_spend(spark, d):
    return analytics.segment_spend(cleansing.clean_transactions(views.tx_bulk(spark, d)), _profiles(spark, d))


@query
def branch_rollup(spark, d):
    tx, accounts, _ = _clean(spark, d)
    return analytics.branch_rollup(tx, accounts, cleansing.clean_branches(views.branches(spark, d)))


@query
def reconcile(spark, d):
    """Loaded rows against read rows: whatever is not loaded is in the rejects."""
    return _reconciled(spark, d)


@query
def reconcile_shortfall(spark, d):
    """The same where pending rows were lost on the way: must report FAIL."""
    return _reconciled(spark, d, F.col("status") != "PENDING")


def _reconciled(spark, d, arrived=None):
    rules = [r for r in _rules(spark, d) if r.rejects]
    judged = quality.evaluate(_conformed(spark, d), rules)
    return analytics.reconcile_keyed(
        judged, quality.is_rejected(rules), "transaction_id", "ingestion_timestamp", "transactions", arrived,
    )


@query
def pipeline_slice(spark, d):
    """Two batches from gate to fact: the second one, late rows included, is judged and upserted into the first. Counts
    per outcome and month of ingestion."""
    rules = [r for r in _rules(spark, d) if r.rejects]
    judged = quality.evaluate(_conformed(spark, d), rules)
    keep = ("transaction_id", "amount", "status", "ingestion_timestamp")
    good = quality.passed(judged, rules).select(*keep, "account_id", "transaction_timestamp")
    cut = incremental.moment("1996-01-01 00:00:00")
    first = latest_per_key(good.where(F.col("ingestion_timestamp") <= cut), "transaction_id")
    second = latest_per_key(
        incremental.newer_or_late(good, "1996-01-01T00:00:00"), "transaction_id"
    ).withColumn("status", F.lit("SETTLED"))
    fact = warehouse.upsert(first, second, "transaction_id").select("ingestion_timestamp", "amount", F.concat(F.lit("LOADED "), "status").alias("outcome"))
    rejects = judged.where(quality.is_rejected(rules)).select("ingestion_timestamp", "amount", F.lit("REJECTED").alias("outcome"))
    return (
        fact.unionByName(rejects).groupBy(fx.month_id("ingestion_timestamp").alias("month_id"), "outcome")
        .agg(F.count("*").alias("records"), analytics.money_sum("amount").alias("amount"))
    )


# ---- incremental ----------------------------------------------------------------------


@query
def incremental_filter(spark, d):
    return incremental.newer_than(views.tx_events(spark, d), WATERMARK).select(*HIT)


@query
def incremental_late(spark, d):
    late = incremental.newer_or_late(views.tx_events(spark, d), WATERMARK)
    return latest_per_key(late, "transaction_id").select(*HIT)


@query
def watermark_next(spark, d):
    return incremental.next_watermark(views.tx_events(spark, d), WATERMARK)


@query
def watermark_accepted(spark, d):
    """The next watermark from accepted rows alone: rejected rows may be newer."""
    rules = [r for r in _rules(spark, d) if r.fails is not None]
    judged = quality.evaluate(_conformed(spark, d), [*rules, quality.not_future("ingestion_timestamp", AS_OF)])
    return incremental.next_watermark(judged.where(F.size("failed_rules") == 0), "1992-01-01 00:00:00")


@query
def watermark_get(spark, d):
    """The watermark in force after one run per day of events."""
    log = views.tx_events(spark, d).groupBy(F.to_date("transaction_timestamp").alias("run_day")).agg(
        F.max("ingestion_timestamp").alias("last_processed")
    ).select(
        F.lit("transactions").alias("dataset"), "last_processed",
        F.date_format("run_day", "yyyyMMdd").alias("last_run_id"),
        F.col("run_day").cast("timestamp_ntz").alias("updated_at"),
    )
    return incremental.last_watermarks(log)
