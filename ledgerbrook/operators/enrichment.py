"""Derived columns and the joins that add account, customer and merchant attributes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerbrook.functions import columns as fx
from ledgerbrook.operators.lookup import lookup

# Columns of an enriched transaction, in order.
ENRICHED = (
    "transaction_id", "account_id", "merchant_id", "transaction_type", "amount",
    "transaction_timestamp", "status", "channel", "customer_id", "customer_segment",
    "customer_city", "account_type", "tx_year", "tx_month", "tx_day_of_week", "is_weekend",
)
# Carried along when the input has them: the fact table needs them.
CARRIED = ("payment_method", "location", "ingestion_timestamp")


def enrich_customers(df: DataFrame, as_of: dt.date, high_income_above: float = 150000) -> DataFrame:
    """Tenure in years up to `as_of` and a flag for incomes above the limit."""
    return df.withColumns({
        "tenure_years": F.datediff(F.lit(as_of), "account_open_date") / 365,
        "high_income_flag": fx.holds(F.col("income") > high_income_above),
    })


def account_profiles(accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per account with the attributes of its customer.

    Joining the two dimensions first leaves a single join for the far larger
    transactions; the left joins give the same rows in either order.
    """
    owners = customers.select(
        "customer_id",
        F.col("customer_id").alias("known_customer_id"),
        "customer_segment",
        F.col("city").alias("customer_city"),
    )
    branch = ["branch_id"] if "branch_id" in accounts.columns else []
    owned = accounts.select("account_id", "customer_id", "account_type", *branch)
    return lookup(owned, owners, "customer_id").select(
        "account_id",
        F.col("known_customer_id").alias("customer_id"),
        "customer_segment", "customer_city", "account_type", *branch,
    )


def with_calendar(df: DataFrame) -> DataFrame:
    """Year, month, day of week (1 = Sunday) and weekend flag of the transaction time."""
    day = F.dayofweek("transaction_timestamp")
    return df.withColumns({
        "tx_year": F.year("transaction_timestamp"),
        "tx_month": F.month("transaction_timestamp"),
        "tx_day_of_week": day,
        "is_weekend": fx.holds(day.isin(1, 7)),
    })


def enrich_transactions(transactions: DataFrame, accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """Transactions with account, customer and calendar columns; orphans keep NULLs."""
    profiles = account_profiles(accounts, customers)
    carried = [c for c in CARRIED if c in transactions.columns]
    branch = ["branch_id"] if "branch_id" in profiles.columns else []
    joined = lookup(transactions, profiles, "account_id")
    return with_calendar(joined).select(*ENRICHED, *carried, *branch)


def with_merchant(transactions: DataFrame, merchants: DataFrame) -> DataFrame:
    """Add the merchant's risk class as `merchant_risk_category`."""
    risks = merchants.select("merchant_id", F.col("risk_category").alias("merchant_risk_category"))
    return lookup(transactions, risks, "merchant_id")
