"""Declared schemas: an all-text landing tier, the fact table and the run state."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, StructType

# ---- landing tier: text only, so that no bad value fails a load ---------------

RAW = {
    "branches": StructType()
    .add("branch_id", "string")
    .add("branch_name", "string")
    .add("city", "string")
    .add("state", "string")
    .add("branch_type", "string"),
    "merchants": StructType()
    .add("merchant_id", "string")
    .add("merchant_name", "string")
    .add("merchant_category", "string")
    .add("city", "string")
    .add("risk_category", "string"),
    "customers": StructType()
    .add("customer_id", "string")
    .add("name", "string")
    .add("age", "string")
    .add("gender", "string")
    .add("city", "string")
    .add("state", "string")
    .add("occupation", "string")
    .add("income", "string")
    .add("account_open_date", "string")
    .add("customer_segment", "string")
    .add("ingestion_timestamp", "string"),
    "accounts": StructType()
    .add("account_id", "string")
    .add("customer_id", "string")
    .add("account_type", "string")
    .add("branch_id", "string")
    .add("balance", "string")
    .add("account_status", "string")
    .add("created_at", "string")
    .add("ingestion_timestamp", "string"),
    "transactions": StructType()
    .add("transaction_id", "string")
    .add("account_id", "string")
    .add("transaction_type", "string")
    .add("amount", "string")
    .add("timestamp", "string")
    .add("merchant_id", "string")
    .add("location", "string")
    .add("payment_method", "string")
    .add("status", "string")
    .add("channel", "string")
    .add("ingestion_timestamp", "string"),
}

#: Columns a delivery may leave out: stamps are added, and risk classes follow from the category.
OPTIONAL = ("ingestion_timestamp", "risk_category", "occupation", "created_at")

# ---- fact table, as it is stored ------------------------------------------------

FACT = (
    StructType()
    .add("transaction_id", "string")
    .add("account_id", "string")
    .add("customer_id", "string")
    .add("merchant_id", "string")
    .add("branch_id", "string")
    .add("date_id", "integer")
    .add("transaction_type", "string")
    .add("amount", "decimal(15,2)")
    .add("transaction_timestamp", "timestamp_ntz")
    .add("status", "string")
    .add("payment_method", "string")
    .add("channel", "string")
    .add("location", "string")
    .add("ingestion_timestamp", "timestamp_ntz")
    .add("fraud_flag_high_amount", "boolean")
    .add("fraud_flag_risky_merchant", "boolean")
    .add("fraud_score", "integer")
    .add("is_fraudulent", "boolean")
    .add("pipeline_run_id", "string")
    .add("loaded_at", "timestamp")
    .add("year", "integer")
    .add("month", "integer")
    .add("day", "integer")
)

_PARTITIONS = (("year", "integer"), ("month", "integer"), ("day", "integer"))
_TOTALS = (("n", "long"), ("total", "decimal(28,2)"), ("first_at", "long"))
ACCOUNT_DAY, ACCOUNT_TOTAL = StructType().add("account_id", "string").add("tx_date", "date").add("day_count", "long"), StructType().add("account_id", "string")
for _name, _kind in (*_TOTALS, *_PARTITIONS):
    ACCOUNT_DAY, ACCOUNT_TOTAL = ACCOUNT_DAY.add(_name, _kind), ACCOUNT_TOTAL.add(_name, _kind)

#: Accounts with transactions on a day, as sets of account numbers (`operators.sets`).
ACTIVE_DAY = StructType().add("bucket", "long").add("members", "binary").add(
    "high", ArrayType(StructType().add("position", "integer").add("times", "long")))
for _name, _kind in _PARTITIONS:
    ACTIVE_DAY = ACTIVE_DAY.add(_name, _kind)

# ---- run state -----------------------------------------------------------------

STATE = {
    "pipeline_runs": StructType()
    .add("run_id", "string")
    .add("pipeline_name", "string")
    .add("start_time", "timestamp")
    .add("end_time", "timestamp")
    .add("status", "string")
    .add("records_read", "long")
    .add("records_processed", "long")
    .add("records_rejected", "long")
    .add("records_loaded", "long")
    .add("error_message", "string"),
    "quality_results": StructType()
    .add("run_id", "string")
    .add("dataset", "string")
    .add("check_name", "string")
    .add("check_type", "string")
    .add("total_records", "long")
    .add("passed_records", "long")
    .add("failed_records", "long")
    .add("pass_rate", "decimal(5,2)")
    .add("status", "string")
    .add("details", "string")
    .add("checked_at", "timestamp"),
    "rejected_records": StructType()
    .add("rejection_id", "string")
    .add("run_id", "string")
    .add("dataset", "string")
    .add("record_id", "string")
    .add("failure_reason", "string")
    .add("failed_rule", "string")
    .add("raw_data", "string")
    .add("rejected_at", "timestamp"),
    "pipeline_watermarks": StructType()
    .add("dataset", "string")
    .add("last_processed", "timestamp_ntz")
    .add("last_run_id", "string")
    .add("updated_at", "timestamp"),
    "reconciliation_results": StructType()
    .add("run_id", "string")
    .add("dataset", "string")
    .add("source_count", "long")
    .add("target_count", "long")
    .add("rejected_count", "long")
    .add("source_amount", "decimal(20,2)")
    .add("target_amount", "decimal(20,2)")
    .add("rejected_amount", "decimal(20,2)")
    .add("count_difference", "long")
    .add("amount_difference", "decimal(20,2)")
    .add("count_status", "string")
    .add("amount_status", "string")
    .add("overall_status", "string")
    .add("run_timestamp", "timestamp"),
    "days_in_force": StructType()
    .add("dataset", "string")
    .add("day", "integer")
    .add("version", "string")
    .add("records", "long")
    .add("run_id", "string")
    .add("put_at", "timestamp"),
    "account_numbers": StructType()
    .add("account_id", "string")
    .add("number", "long"),
    "resolutions": StructType()
    .add("run_id", "string")
    .add("dataset", "string")
    .add("rejection_id", "string")
    .add("record_id", "string")
    .add("outcome", "string")
    .add("resolved_at", "timestamp"),
    "snapshots": StructType()
    .add("dataset", "string")
    .add("run_id", "string")
    .add("as_of", "timestamp_ntz"),
    "schema_findings": StructType()
    .add("run_id", "string")
    .add("dataset", "string")
    .add("column_name", "string")
    .add("finding", "string")
    .add("files", "long")
    .add("example_file", "string"),
    "published": StructType()
    .add("dataset", "string")
    .add("run_id", "string")
    .add("version", "string")
    .add("published_at", "timestamp"),
}
