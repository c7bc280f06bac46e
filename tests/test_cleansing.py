import datetime as dt
from decimal import Decimal

from ledgerbrook.operators import cleansing, enrichment
from ledgerbrook.operators.dedup import extra_copies, latest_per_key
from ledgerbrook.sources.schemas import RAW
from pyspark.sql.types import StructType

CUSTOMER = "customer_id string, name string, age string, gender string, income string, account_open_date string"


def test_transactions_lose_their_copies_and_get_a_typed_time(rows):
    df = rows([
        ("T1", "A1", "100.00", "2026-07-01 10:00:00"),
        ("T1", "A1", "100.00", "2026-07-01 10:00:00"),
        ("T2", "A2", "50.00", "2026-07-01 11:00:00"),
    ], "transaction_id string, account_id string, amount string, timestamp string")
    clean = cleansing.clean_transactions(df)
    assert clean.count() == 2
    assert "timestamp" not in clean.columns
    assert dict(clean.dtypes)["transaction_timestamp"] == "timestamp_ntz"
    assert dict(clean.dtypes)["amount"] == "decimal(15,2)"


def test_transaction_amounts_and_unknown_times(rows):
    data = [(f"T{i}", "A1", a, t) for i, (a, t) in enumerate([
        ("0", "2026-07-01"), ("0.01", "2026-07-01"), ("-1", "2026-07-01"), (None, "2026-07-01"),
        ("x", "2026-07-01"), ("5", None), ("6", "not a time"),
    ])]
    clean = cleansing.clean_transactions(
        rows(data, "transaction_id string, account_id string, amount string, timestamp string"))
    kept = {r.transaction_id: (r.amount, r.transaction_timestamp) for r in clean.collect()}
    assert kept == {
        "T1": (Decimal("0.01"), dt.datetime(2026, 7, 1)),
        "T5": (Decimal("5.00"), None),
        "T6": (Decimal("6.00"), None),
    }


def test_a_bad_copy_does_not_displace_a_good_one(rows):
    df = rows([
        ("T1", "A1", "-5", "2026-07-01", dt.datetime(2026, 7, 3)),
        ("T1", "A1", "5", "2026-07-01", dt.datetime(2026, 7, 2)),
        ("T1", "A1", "4", "2026-07-01", dt.datetime(2026, 7, 1)),
    ], "transaction_id string, account_id string, amount string, timestamp string, ingestion_timestamp timestamp_ntz")
    assert [r.amount for r in cleansing.clean_transactions(df).collect()] == [Decimal("5.00")]


def test_customers_by_age_and_id(rows):
    data = [(f"C{i}", " Ann ", age, "Female", "10.005", "2020-02-30") for i, age in
            enumerate([None, "17", "18", "abc", "25.7"])]
    data += [(None, "Bob", "40", "Male", "1", "2020-01-01"), ("C9", None, "40", "MALE", "1", "2020-01-01")]
    clean = {r.customer_id: r for r in cleansing.clean_customers(rows(data, CUSTOMER)).collect()}
    assert set(clean) == {"C2", "C9"}
    assert clean["C2"].name == "Ann" and clean["C2"].gender == "female" and clean["C2"].age == 18
    assert clean["C2"].account_open_date is None
    assert clean["C2"].income == Decimal("10.01")
    assert clean["C9"].name is None


def test_accounts_keep_negative_balances_and_unknown_statuses(rows):
    data = [("A1", "C1", "-5", " BLOCKED "), ("A2", "C1", "x", "UNKNOWN"), (None, "C1", "1", "ACTIVE"),
            ("A3", None, "1", "ACTIVE")]
    df = rows(data, "account_id string, customer_id string, balance string, account_status string")
    clean = {r.account_id: (r.balance, r.account_status) for r in cleansing.clean_accounts(df).collect()}
    assert clean == {"A1": (Decimal("-5.00"), "BLOCKED"), "A2": (None, "UNKNOWN")}


def test_branches_merchants_and_risk(rows):
    branches = rows([("B1", " Main "), ("B1", " Main "), (None, "x")], "branch_id string, branch_name string")
    assert [tuple(r) for r in cleansing.clean_branches(branches).collect()] == [("B1", "Main")]
    merchants = rows([("M1", " Shop ", "Travel"), ("M2", "Bar", "Fuel"), ("M3", "New", "Space"), ("M4", "N", None)],
                     "merchant_id string, merchant_name string, merchant_category string")
    risky = cleansing.with_merchant_risk(cleansing.clean_merchants(merchants))
    assert {r.merchant_id: r.risk_category for r in risky.collect()} == {
        "M1": "HIGH", "M2": "MEDIUM", "M3": None, "M4": None}


def test_valid_keys(rows):
    df = rows([("C1", "Regular"), (None, "Senior")], "customer_id string, customer_segment string")
    assert [tuple(r) for r in cleansing.valid_keys(df, "customer_id", "customer_segment").collect()] == [
        ("C1", "Regular")]


def test_schema_findings(spark, rows):
    df = rows([("B1", 1, "x")], "branch_id string, city int, extra string")
    expected = StructType([f for f in RAW["branches"] if f.name in ("branch_id", "city", "state")])
    found = {(r.column_name, r.finding) for r in cleansing.validate_schema(spark, df, expected).collect()}
    assert found == {("city", "TYPE"), ("state", "MISSING"), ("extra", "EXTRA")}
    assert cleansing.validate_schema(spark, df.select("branch_id"), StructType([expected["branch_id"]])).count() == 0


def test_latest_copy_and_the_copies_left_out(rows):
    data = [("a", 1, "x"), ("a", 2, "x"), ("a", 2, "x"), ("a", 2, "y"), ("b", 1, "x")] + [("c", 1, None)] * 3
    df = rows(data, "k string, ingestion_timestamp int, v string")
    assert sorted(map(tuple, latest_per_key(df, "k").collect())) == [("a", 2, "y"), ("b", 1, "x"), ("c", 1, None)]
    left = sorted(map(tuple, extra_copies(df, "k").collect()), key=str)
    assert left == [("a", 1, "x", 1), ("a", 2, "x", 2), ("c", 1, None, 2)]


def test_enriched_customers(rows):
    df = rows([("C1", dt.date(2024, 1, 1), Decimal("150000.00")), ("C2", None, Decimal("150000.01")),
               ("C3", dt.date(2025, 1, 1), None)],
              "customer_id string, account_open_date date, income decimal(15,2)")
    got = {r.customer_id: (r.tenure_years, r.high_income_flag)
           for r in enrichment.enrich_customers(df, dt.date(2024, 12, 31)).collect()}
    assert got == {"C1": (1.0, False), "C2": (None, True), "C3": (-1 / 365, False)}


def test_enriched_transactions_keep_orphans(rows):
    tx = rows([
        ("T1", "A1", "M1", "UPI", Decimal("1.00"), dt.datetime(2024, 9, 1, 12), "SUCCESS", "ATM"),
        ("T2", "A2", "M1", "UPI", Decimal("1.00"), dt.datetime(2024, 9, 7), "SUCCESS", "ATM"),
        ("T3", "A9", "M1", "UPI", Decimal("1.00"), dt.datetime(2024, 9, 2), "SUCCESS", "ATM"),
        ("T4", None, "M1", "UPI", Decimal("1.00"), None, "SUCCESS", "ATM"),
    ], """transaction_id string, account_id string, merchant_id string, transaction_type string,
          amount decimal(15,2), transaction_timestamp timestamp_ntz, status string, channel string""")
    accounts = rows([("A1", "C1", "Savings"), ("A2", "C7", "Current")],
                    "account_id string, customer_id string, account_type string")
    customers = rows([("C1", "Regular", "Pune")], "customer_id string, customer_segment string, city string")
    got = {r.transaction_id: r for r in enrichment.enrich_transactions(tx, accounts, customers).collect()}
    assert len(got) == 4
    assert (got["T1"].customer_id, got["T1"].customer_city, got["T1"].account_type) == ("C1", "Pune", "Savings")
    assert (got["T2"].customer_id, got["T2"].account_type) == (None, "Current")
    assert (got["T3"].account_id, got["T3"].customer_id, got["T3"].account_type) == ("A9", None, None)
    days = {k: (r.tx_year, r.tx_month, r.tx_day_of_week, r.is_weekend) for k, r in got.items()}
    assert days["T1"] == (2024, 9, 1, True)
    assert days["T2"] == (2024, 9, 7, True)
    assert days["T3"] == (2024, 9, 2, False)
    assert days["T4"] == (None, None, None, False)
