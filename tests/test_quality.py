import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerbrook.operators import quality as q
from ledgerbrook.settings import QualitySettings


def ids(df, name="id"):
    return sorted((r[name] for r in df.collect()), key=str)


def test_completeness_counts_a_row_once(rows):
    df = rows([(1, "a", "b"), (2, None, None), (3, "a", None)], "id int, x string, y string")
    passed, failed, result = q.check_completeness(df, ["x", "y"], "things")
    assert ids(passed) == [1] and ids(failed) == [2, 3]
    assert {r.failure_reason for r in failed.collect()} == {"Missing critical values"}
    row = result.first()
    assert (row.check_type, row.total_records, row.passed_records, row.failed_records) == ("COMPLETENESS", 3, 1, 2)
    assert row.status == "FAIL" and row.pass_rate == pytest.approx(100 / 3)
    with pytest.raises(ValueError):
        q.check_completeness(df, [])


def test_uniqueness_fails_all_copies_and_passes_nulls(rows):
    df = rows([("a",), ("a",), ("b",), (None,), (None,)], "id string")
    passed, failed, result = q.check_uniqueness(df, "id")
    assert ids(passed) == ["None", "None", "b"] or ids(passed) == [None, None, "b"]
    assert ids(failed) == ["a", "a"]
    assert {r.failure_reason for r in failed.collect()} == {"Duplicate id"}
    row = result.first()
    assert (row.total_records, row.passed_records, row.failed_records) == (5, 3, 2)


def test_range_is_inclusive_and_fails_null(rows):
    df = rows([(0,), (1,), (10,), (11,), (None,)], "id int")
    passed, failed, result = q.check_range(df, "id", 1, 10)
    assert ids(passed) == [1, 10]
    assert ids(failed) == [0, 11, None]
    assert {r.failure_reason for r in failed.collect()} == {"Out of range: id"}
    nan = rows([(float("nan"),)], "id double")
    assert q.check_range(nan, "id", 1)[0].count() == 1
    assert q.check_range(nan, "id", 1, 10)[0].count() == 0


@pytest.mark.parametrize("check", [
    lambda df: q.check_completeness(df, ["id"]),
    lambda df: q.check_uniqueness(df, "id"),
    lambda df: q.check_range(df, "id", 1),
])
def test_empty_input_has_three_parts(rows, check):
    passed, failed, result = check(rows([], "id int"))
    assert passed.count() == 0 and failed.count() == 0
    row = result.first()
    assert (row.total_records, row.failed_records, row.pass_rate, row.status) == (0, 0, 100.0, "PASS")


def test_rules_together_and_quarantine(rows):
    df = rows([
        ("T1", "A1", Decimal("5.00"), "ATM", dt.datetime(2024, 1, 1)),
        ("T2", "A9", Decimal("0.50"), "Fax", dt.datetime(2024, 1, 1)),
        ("T3", None, Decimal("5.00"), None, dt.datetime(2025, 1, 1)),
        ("T4", "A1", Decimal("5.00"), "ATM", None),
        ("T4", "A1", Decimal("6.00"), "ATM", None),
    ], "id string, account_id string, amount decimal(15,2), channel string, ts timestamp_ntz")
    parents = rows([("A1",), ("A1",), (None,)], "account_id string")
    rules = [
        q.in_range("amount", 1), q.allowed("channel", ["ATM", "POS"]), q.not_future("ts", dt.datetime(2024, 6, 1)),
        q.references("account_id", parents, "account_id"), q.unique("id", rejects=False),
    ]
    judged = q.evaluate(df, rules)
    failed = {(r.id, r.amount): sorted(r.failed_rules) for r in judged.collect()}
    assert failed == {
        ("T1", Decimal("5.00")): [],
        ("T2", Decimal("0.50")): ["RANGE_amount", "REFERENTIAL_account_id", "VALIDITY_channel"],
        ("T3", Decimal("5.00")): ["TIMESTAMP_ts"],
        ("T4", Decimal("5.00")): ["UNIQUENESS_id"],
        ("T4", Decimal("6.00")): ["UNIQUENESS_id"],
    }
    good, bad = q.passed(judged, rules), q.rejected(judged, rules, "id")
    assert good.count() + judged.where(q.is_rejected(rules)).count() == df.count()
    assert sorted((r.record_id, r.failed_rule) for r in bad.collect()) == [
        ("T2", "RANGE_amount"), ("T2", "REFERENTIAL_account_id"), ("T2", "VALIDITY_channel"), ("T3", "TIMESTAMP_ts")]
    raw = json.loads(bad.where("record_id = 'T3'").first().raw_data)
    assert raw["id"] == "T3" and raw["amount"] == 5.0
    filed = q.quarantined(bad, "transactions", "run-1", dt.datetime(2024, 1, 1))
    assert filed.columns == ["rejection_id", "run_id", "dataset", "record_id", "failure_reason", "failed_rule",
                             "raw_data", "rejected_at"]
    results = {r.check_name: (r.failed_records, r.status) for r in q.results(judged, rules, "transactions").collect()}
    assert results == {
        "RANGE_amount": (1, "FAIL"), "VALIDITY_channel": (1, "FAIL"), "TIMESTAMP_ts": (1, "FAIL"),
        "REFERENTIAL_account_id": (1, "FAIL"), "UNIQUENESS_id": (2, "FAIL"),
    }


def test_status_ladder(rows):
    df = rows([(i,) for i in range(1, 101)], "id int")
    status = lambda low: q.check_range(df, "id", low)[2].first().status
    assert [status(1), status(6), status(7)] == ["PASS", "WARN", "FAIL"]


def test_rule_names_must_differ(rows):
    with pytest.raises(ValueError):
        q.evaluate(rows([(1,)], "id int"), [q.in_range("id", 1), q.in_range("id", 2)])


def test_declared_rule_sets(rows):
    s = QualitySettings()
    customers = rows([("C1", "Ann", 30, "Regular"), ("C2", None, 101, "Odd")],
                     "customer_id string, name string, age int, customer_segment string")
    judged = {r.customer_id: sorted(r.failed_rules) for r in q.evaluate(customers, q.customer_rules(s)).collect()}
    assert judged == {"C1": [], "C2": ["COMPLETENESS", "RANGE_age", "VALIDITY_customer_segment"]}
    accounts = rows([("A1", "C1", Decimal("0.00"), "ACTIVE"), ("A2", "C5", Decimal("-1.00"), "UNKNOWN")],
                    "account_id string, customer_id string, balance decimal(15,2), account_status string")
    judged = {r.account_id: sorted(r.failed_rules)
              for r in q.evaluate(accounts, q.account_rules(s, customers)).collect()}
    assert judged == {"A1": [], "A2": ["RANGE_balance", "REFERENTIAL_customer_id", "VALIDITY_account_status"]}


def test_observed_counts_equal_counted_ones(rows, spark, tmp_path):
    df = rows([("a", 1), ("a", 50), (None, 5), ("b", None)], "k string, v int")
    rules = [q.completeness("k", "v"), q.in_range("v", 2, 10), q.unique("k", rejects=False)]
    evaluated = q.evaluate(df, rules)
    watched, seen = q.observed(evaluated, rules, largest=F.max("v"))
    watched.write.parquet(str(tmp_path / "judged"))
    told = seen.get
    assert (told["total"], told["rejected"], told["largest"]) == (4, 4, 50)
    got = q.results_of(spark, told, rules, "d")
    want = q.results(evaluated, rules, "d")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.columns == want.columns
