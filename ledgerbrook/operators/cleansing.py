"""Typed, trimmed, filtered and deduplicated entities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerbrook.functions import columns as fx
from ledgerbrook.operators.dedup import latest_per_key


def conform_customers(df: DataFrame) -> DataFrame:
    """Types only; every row stays, malformed values become NULL."""
    return df.withColumns({
        "name": F.trim("name"),
        "gender": F.lower("gender"),
        "age": fx.to_int("age"),
        "income": fx.to_money("income"),
        "account_open_date": fx.to_day("account_open_date"),
    })


def conform_accounts(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "balance": fx.to_money("balance"),
        "account_status": F.trim("account_status"),
    })


def conform_transactions(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "amount": fx.to_money("amount"),
        "transaction_timestamp": fx.to_moment("timestamp"),
    }).drop("timestamp")


def conform_branches(df: DataFrame) -> DataFrame:
    return df.withColumn("branch_name", F.trim("branch_name"))


def conform_merchants(df: DataFrame) -> DataFrame:
    return df.withColumn("merchant_name", F.trim("merchant_name"))


def clean_customers(df: DataFrame) -> DataFrame:
    """Adults with an id, one row per id. An unknown age is dropped, an unknown name kept."""
    kept = conform_customers(df).where((F.col("age") >= 18) & F.col("customer_id").isNotNull())
    return latest_per_key(kept, "customer_id")


def clean_accounts(df: DataFrame) -> DataFrame:
    """Accounts with both ids, one row per account. Balance and status are not judged here."""
    kept = conform_accounts(df).where(F.col("account_id").isNotNull() & F.col("customer_id").isNotNull())
    return latest_per_key(kept, "account_id")


def clean_transactions(df: DataFrame) -> DataFrame:
    """Transactions with both ids and a positive amount, one row per id.

    Copies are dropped after the filters, so a bad copy never displaces a good one.
    """
    kept = conform_transactions(df).where(
        F.col("transaction_id").isNotNull() & F.col("account_id").isNotNull() & (F.col("amount") > 0)
    )
    return latest_per_key(kept, "transaction_id")


def clean_branches(df: DataFrame) -> DataFrame:
    return latest_per_key(conform_branches(df).where(F.col("branch_id").isNotNull()), "branch_id")


def clean_merchants(df: DataFrame) -> DataFrame:
    return latest_per_key(conform_merchants(df).where(F.col("merchant_id").isNotNull()), "merchant_id")


def with_merchant_risk(merchants: DataFrame) -> DataFrame:
    """Add `risk_category` from the merchant category, by a literal map (no join); a delivered class is kept."""
    mapped = fx.merchant_risk("merchant_category")
    if "risk_category" in merchants.columns:
        mapped = F.coalesce(F.nullif(F.trim("risk_category"), F.lit("")), mapped)
    return merchants.withColumn("risk_category", mapped)


def require_columns(df_schema: StructType | None, expected: StructType, dataset: str, optional: tuple[str, ...] = ()) -> None:
    """Refuse a delivery that lacks a required column, before any row is read."""
    if df_schema is None:
        return
    missing = [f.name for f in expected if f.name not in df_schema.names and f.name not in optional]
    if missing:
        raise ValueError(f"{dataset}: missing columns {', '.join(missing)}")


def valid_keys(df: DataFrame, key: str, *attributes: str) -> DataFrame:
    """Rows with a known key, reduced to the key and the named attributes."""
    return df.where(F.col(key).isNotNull()).select(key, *attributes)


def validate_schema(spark: SparkSession, df: DataFrame, expected: StructType) -> DataFrame:
    """Findings about columns: missing, of another type, or not expected.

    Looks at the schema alone and reads no rows.
    """
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    wanted = {f.name: f.dataType.simpleString() for f in expected}
    findings = []
    for name, kind in wanted.items():
        if name not in actual:
            findings.append((name, "MISSING", kind, None))
        elif actual[name] != kind:
            findings.append((name, "TYPE", kind, actual[name]))
    findings += [(name, "EXTRA", None, kind) for name, kind in actual.items() if name not in wanted]
    return spark.createDataFrame(
        findings, "column_name string, finding string, expected_type string, actual_type string"
    )
