"""Summary tables. Each aggregates the transactions to their keys before any join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerbrook.functions import columns as fx
from ledgerbrook.operators.lookup import lookup


def money_sum(c: str | Column) -> Column:
    """Exact sum, zero over no rows."""
    column = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.sum(column).cast(fx.BIG_MONEY), F.lit(0).cast(fx.BIG_MONEY))


def succeeded() -> Column:
    return F.col("status") == "SUCCESS"


def daily_branch_metrics(fact: DataFrame) -> DataFrame:
    """Per day and branch: all transactions, settled inflow and outflow, customers.

    Inflow is successful cash deposits, outflow every other successful type.
    Rows without a branch or date have no place in the table's key.
    """
    deposit = F.col("transaction_type") == "CASH_DEPOSIT"
    return (
        fact.where(F.col("branch_id").isNotNull() & F.col("date_id").isNotNull())
        .groupBy("date_id", "branch_id")
        .agg(
            F.count("*").alias("total_transactions"),
            money_sum(F.when(succeeded() & deposit, F.col("amount"))).alias("total_inflow"),
            money_sum(F.when(succeeded() & ~deposit, F.col("amount"))).alias("total_outflow"),
            F.count_distinct("customer_id").alias("unique_customers"),
        )
    )


def customer_segment_summary(transactions: DataFrame, accounts: DataFrame, customers: DataFrame,
                             high_value_above: float = 10000) -> DataFrame:
    """Per month and segment: active customers, their mean age, balance of their active
    accounts, high-value transactions.

    Transactions shrink to one row per (month, account) first, so no balance or
    age is counted twice and a hot account is one row by the time of the joins.
    """
    per_account = (
        transactions.withColumn("month_id", fx.month_id("transaction_timestamp"))
        .where(F.col("month_id").isNotNull())
        .groupBy("month_id", "account_id")
        .agg(F.count_if(F.col("amount") > high_value_above).alias("high_value"))
    )
    return segment_summary(per_account, accounts, customers)


def segment_summary(per_account: DataFrame, accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """The same from one row per (month_id, account_id) with its number of high-value transactions, `high_value`."""
    owned = lookup(per_account, accounts.select("account_id", "customer_id", "balance"), "account_id", "inner")
    people = customers.where(F.col("customer_segment").isNotNull()).select("customer_id", "customer_segment", "age")
    per_customer = (
        lookup(owned, people, "customer_id", "inner")
        .groupBy("month_id", "customer_segment", "customer_id", "age")
        .agg(money_sum("balance").alias("balance"), F.sum("high_value").alias("high_value"))
    )
    ages, known = F.sum("age"), F.count("age")
    return per_customer.groupBy("month_id", "customer_segment").agg(
        F.count("*").alias("total_customers"),
        # mean rounded half up, in integers
        F.when(known > 0, F.floor((ages * 2 + known) / (known * 2))).cast("int").alias("avg_age"),
        money_sum("balance").alias("total_balance"),
        F.sum("high_value").alias("high_value_transactions"),
    )


def fraud_summary(scored: DataFrame, merchants: DataFrame) -> DataFrame:
    """Per day, merchant risk class and channel: flagged count and amount, confirmed fraud."""
    flagged = F.col("fraud_score") > 0
    per_merchant = (
        scored.withColumn("date_id", fx.date_id("transaction_timestamp"))
        .groupBy("date_id", "merchant_id", "channel")
        .agg(
            F.count_if(flagged).alias("flagged"),
            money_sum(F.when(flagged, F.col("amount"))).alias("amount"),
            F.count_if("is_fraudulent").alias("confirmed"),
        )
    )
    risks = merchants.select("merchant_id", F.col("risk_category").alias("merchant_risk_category"))
    return (
        lookup(per_merchant, risks, "merchant_id")
        .groupBy("date_id", "merchant_risk_category", "channel")
        .agg(
            F.sum("flagged").alias("flagged_transactions"),
            money_sum("amount").alias("flagged_amount"),
            F.sum("confirmed").alias("confirmed_fraud"),
        )
    )


def merchant_risk_counts(merchants: DataFrame) -> DataFrame:
    return merchants.groupBy("risk_category").agg(F.count("*").alias("merchants"))


def exec_overview(transactions: DataFrame) -> DataFrame:
    """Volume, value and success rate over everything."""
    return transactions.agg(
        F.count("*").alias("total_transactions"),
        money_sum("amount").alias("total_value"),
        F.count_if(succeeded()).alias("successful"),
    ).withColumn(
        "success_rate",
        F.when(F.col("total_transactions") > 0, F.col("successful") / F.col("total_transactions") * 100),
    )


def _per_account(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("account_id").agg(
        F.count("*").alias("transactions"),
        money_sum(F.when(succeeded(), F.col("amount"))).alias("spent"),
        F.count_if(succeeded()).alias("successful"),
        money_sum("amount").alias("amount"),
    )


def top_customers(transactions: DataFrame, profiles: DataFrame, k: int = 10) -> DataFrame:
    """The k customers with the highest successful amount; ties go to the lower id."""
    owned = lookup(_per_account(transactions), profiles.select("account_id", "customer_id"), "account_id", "inner")
    return (
        owned.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.sum("transactions").alias("transactions"), money_sum("spent").alias("spent"))
        .orderBy(F.desc("spent"), "customer_id").limit(k)
    )


def segment_spend(transactions: DataFrame, profiles: DataFrame) -> DataFrame:
    owned = lookup(
        _per_account(transactions), profiles.select("account_id", "customer_id", "customer_segment"), "account_id", "inner"
    )
    return (
        owned.where(F.col("customer_segment").isNotNull())
        .groupBy("customer_segment")
        .agg(
            F.count_distinct("customer_id").alias("customers"),
            F.sum("transactions").alias("transactions"),
            money_sum("spent").alias("spent"),
        )
    )


def branch_rollup(transactions: DataFrame, accounts: DataFrame, branches: DataFrame) -> DataFrame:
    """Branch performance by state and city with subtotals; `level` is 0 for a city,
    1 for a state, 3 for the grand total, which counts every transaction. Those of no known account or branch are
    under state and city UNKNOWN."""
    per_branch = (
        lookup(_per_account(transactions), accounts.select("account_id", "branch_id"), "account_id")
        .groupBy("branch_id")
        .agg(F.sum("transactions").alias("transactions"), F.sum("successful").alias("successful"),
             money_sum("amount").alias("amount"))
    )
    return (
        lookup(per_branch, branches.select("branch_id", "state", "city"), "branch_id")
        .select(F.coalesce("state", F.lit("UNKNOWN")).alias("state"), F.coalesce("city", F.lit("UNKNOWN")).alias("city"),
                "transactions", "successful", "amount")
        .rollup("state", "city")
        .agg(
            F.grouping_id().cast("int").alias("level"),
            F.sum("transactions").alias("transactions"),
            F.sum("successful").alias("successful"),
            money_sum("amount").alias("amount"),
        )
    )


def fraud_by_rule(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("severity", "rule").agg(
        F.count("*").alias("alerts"), money_sum("amount").alias("amount")
    )


def fraud_trend(scored: DataFrame, days: int = 7) -> DataFrame:
    """Alerted transactions per day and severity, against the previous day on record and
    the sum of the last `days` calendar days. The windows hold one row per day."""
    daily = (
        scored.where("risk_score > 0")
        .withColumn("alert_date", F.to_date("transaction_timestamp"))
        .groupBy("severity", "alert_date").agg(F.count("*").alias("alerted"))
    )
    order = Window.partitionBy("severity").orderBy("alert_date")
    span = Window.partitionBy("severity").orderBy(F.unix_date("alert_date")).rangeBetween(1 - days, 0)
    return daily.select(
        "severity", "alert_date", "alerted",
        (F.col("alerted") - F.lag("alerted", 1, 0).over(order)).alias("change"),
        F.sum("alerted").over(span).alias("moving_total"),
    )


def reconcile(source: DataFrame, target: DataFrame, rejects: DataFrame, dataset: str) -> DataFrame:
    """One row comparing what was read with what was loaded plus what was rejected.

    `rejects` holds the amount of each rejected record, and the number of its
    `copies` where identical ones share a row. One aggregation counts all sides.
    """
    sides = {"source": source, "target": target, "rejected": rejects}
    amounts = [
        df.select(
            F.lit(side).alias("side"), "amount",
            (F.col("copies") if "copies" in df.columns else F.lit(1)).cast("bigint").alias("copies"),
        )
        for side, df in sides.items()
    ]
    rows = amounts[0].unionByName(amounts[1]).unionByName(amounts[2])
    totals = rows.agg(*[
        column
        for side in sides
        for column in (
            F.coalesce(F.sum(F.when(F.col("side") == side, F.col("copies"))), F.lit(0)).alias(f"{side}_count"),
            money_sum(F.when(F.col("side") == side, F.col("amount") * F.col("copies"))).alias(f"{side}_amount"),
        )
    ])
    return compared(totals, dataset)


def reconcile_keyed(judged: DataFrame, rejected: Column, key: str, newest: str, dataset: str,
                    target: Column | None = None) -> DataFrame:
    """The same row from judged rows alone, by one aggregation per key.

    Of the rows of a key that are not rejected the newest is loaded (order of `dedup.recency`), the others are
    rejected as copies. `target` is a condition for a kept row to count as loaded, for checks of the failing case.
    """
    columns = [c for c in judged.columns if c not in (key, newest, "failed_rules")]
    order = F.struct(*[F.col(c) for c in ([newest] if newest in judged.columns else []) + columns])
    good = ~rejected
    kept = F.struct(F.col("amount").alias("amount"), (F.lit(True) if target is None else fx.holds(target)).alias("loaded"))
    per_key = judged.groupBy(key).agg(
        F.count("*").alias("n"), F.sum("amount").alias("amount"),
        F.count_if(good).alias("good"), F.sum(F.when(good, F.col("amount"))).alias("good_amount"),
        F.max_by(F.when(good, kept), F.when(good, order)).alias("kept"),
    )
    has = F.col("good") > 0
    here = has & F.col("kept.loaded")
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("source_count"), money_sum("amount").alias("source_amount"),
        F.count_if(here).alias("target_count"), money_sum(F.when(here, F.col("kept.amount"))).alias("target_amount"),
        F.coalesce(F.sum(F.col("n") - has.cast("int")), F.lit(0)).alias("rejected_count"),
        (money_sum("amount") - money_sum(F.when(has, F.col("kept.amount")))).cast(fx.BIG_MONEY).alias("rejected_amount"),
    )
    return compared(totals, dataset)


def compared(totals: DataFrame, dataset: str) -> DataFrame:
    """Differences and verdicts of one row of counts and amounts."""
    differences = totals.select(
        F.lit(dataset).alias("dataset"),
        "source_count", "target_count", "rejected_count", "source_amount", "target_amount", "rejected_amount",
        (F.col("source_count") - F.col("target_count") - F.col("rejected_count")).alias("count_difference"),
        (F.col("source_amount") - F.col("target_amount") - F.col("rejected_amount"))
        .cast(fx.BIG_MONEY).alias("amount_difference"),
    )

    def verdict(difference: str) -> Column:
        return F.when(F.col(difference) == 0, "PASS").otherwise("FAIL")

    return differences.withColumns({
        "count_status": verdict("count_difference"),
        "amount_status": verdict("amount_difference"),
        "overall_status": F.when(
            (F.col("count_difference") == 0) & (F.col("amount_difference") == 0), "PASS"
        ).otherwise("FAIL"),
    })
