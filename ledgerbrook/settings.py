"""Thresholds and domains, as plain values with defaults."""

from __future__ import annotations

from dataclasses import dataclass, field

# ---- fixed values: results depend on exactly these -------------------------

LAYERS = ("raw", "processed", "curated", "rejected", "sample")
DATASETS = ("branches", "merchants", "customers", "accounts", "transactions")

TRANSACTION_TYPES = (
    "UPI", "CARD", "ATM", "NEFT", "IMPS", "RTGS", "CASH_DEPOSIT", "CASH_WITHDRAWAL",
)
TRANSACTION_STATUSES = ("SUCCESS", "FAILED", "PENDING")
CHANNELS = ("Mobile", "Internet Banking", "ATM", "Branch", "POS")
ACCOUNT_STATUSES = ("ACTIVE", "BLOCKED", "CLOSED")
CUSTOMER_SEGMENTS = ("Regular", "Premium", "High Net Worth", "Student", "Senior")

MERCHANT_RISK = {
    "Grocery": "LOW",
    "Travel": "HIGH",
    "Restaurant": "LOW",
    "Electronics": "HIGH",
    "Healthcare": "LOW",
    "Education": "LOW",
    "Entertainment": "MEDIUM",
    "Fuel": "MEDIUM",
    "Shopping": "MEDIUM",
    "Utilities": "LOW",
}

REQUIRED_FIELDS = {
    "transactions": (
        "transaction_id", "account_id", "amount", "timestamp", "transaction_type", "status",
    ),
    "customers": ("customer_id", "name", "age"),
    "accounts": ("account_id", "customer_id", "balance"),
}

SAMPLE_SIZES = {"branches": 20, "merchants": 50, "customers": 100, "accounts": 200}

RISK_WEIGHTS = {
    "HIGH_VELOCITY": 40,
    "IMPOSSIBLE_LOCATION": 80,
    "LARGE_TRANSACTION": 60,
    "FAILED_THEN_SUCCESS": 50,
    "UNUSUAL_FREQUENCY": 30,
}

EPOCH = "1970-01-01T00:00:00"
END_OF_TIME = "9999-12-31 00:00:00"

# ---- tunable thresholds with their default values ---------------------------


@dataclass(frozen=True)
class FraudSettings:
    high_amount: float = 10000.00
    high_amount_points: int = 50
    risky_channel: str = "Online"
    risky_channel_points: int = 20
    fraudulent_from: int = 50

    velocity_count: int = 5
    velocity_minutes: int = 10
    location_minutes: int = 30
    # used where city coordinates are given; without them any two different cities count
    location_km: float = 500.0
    large_multiplier: int = 10
    large_history_days: int = 30
    failed_count: int = 3
    failed_minutes: int = 60
    frequency_multiplier: int = 3
    frequency_days: int = 30

    weights: dict = field(default_factory=lambda: dict(RISK_WEIGHTS))

    # Length of one slice of an account's timeline; the longest look-back
    # where not given. Windows never hold more than one slice (plus the look-back),
    # however busy the account is.
    slice_minutes: int | None = None


@dataclass(frozen=True)
class QualitySettings:
    amount_min: float = 1
    amount_max: float = 10000000
    age_min: int = 18
    age_max: int = 100
    balance_min: float = 0
    warn_from: float = 95.0


@dataclass(frozen=True)
class IncrementalSettings:
    watermark_column: str = "ingestion_timestamp"
    late_arriving_days: int = 2
    dedup_key: str = "transaction_id"


@dataclass(frozen=True)
class Settings:
    pipeline_name: str = "daily_transactions"
    fraud: FraudSettings = FraudSettings()
    quality: QualitySettings = QualitySettings()
    incremental: IncrementalSettings = IncrementalSettings()
    high_income_above: float = 150000
    high_value_above: float = 10000
