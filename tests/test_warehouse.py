import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerbrook.operators import analytics, warehouse
from ledgerbrook.settings import END_OF_TIME

D1, D2, D3 = (dt.datetime(2024, m, 1) for m in (1, 2, 3))
FOREVER = dt.datetime.fromisoformat(END_OF_TIME)
DIM = "k string, v string, w int"


def test_scd2_versions(rows):
    first = warehouse.first_version(rows([("same", "x", None), ("change", "x", 1), ("gone", "x", 1), ("null", None, 1)], DIM), D1)
    new = rows([("same", "x", None), ("change", "x", 2), ("new", "x", 1), ("null", "y", 1)], DIM)
    second = warehouse.scd2(first, new, "k", D2)
    got = sorted(((r.k, r.v, r.w, r.is_active, r.valid_from, r.valid_to) for r in second.collect()), key=str)
    assert got == sorted([
        ("same", "x", None, True, D1, FOREVER),
        ("change", "x", 1, False, D1, D2), ("change", "x", 2, True, D2, FOREVER),
        ("gone", "x", 1, True, D1, FOREVER),
        ("new", "x", 1, True, D2, FOREVER),
        ("null", None, 1, False, D1, D2), ("null", "y", 1, True, D2, FOREVER),
    ], key=str)
    again = warehouse.scd2(second, new, "k", D3)
    assert sorted(map(str, again.collect())) == sorted(map(str, second.collect()))
    third = warehouse.scd2(second, rows([("change", "x", 3)], DIM), "k", D3)
    changes = sorted((r.valid_from, r.valid_to, r.is_active) for r in third.where("k = 'change'").collect())
    assert changes == [(D1, D2, False), (D2, D3, False), (D3, FOREVER, True)]
    actives = third.where("is_active").groupBy("k").count()
    assert actives.where("count <> 1").count() == 0


def test_upsert_twice_is_once(rows):
    old, new = rows([("a", "1", 1), ("b", "1", 1)], DIM), rows([("b", "2", 2), ("c", "2", 2)], DIM)
    once = warehouse.upsert(old, new, "k")
    assert sorted(map(tuple, once.collect())) == [("a", "1", 1), ("b", "2", 2), ("c", "2", 2)]
    assert sorted(map(tuple, warehouse.upsert(once, new, "k").collect())) == sorted(map(tuple, once.collect()))


def test_dim_date(rows):
    bounds = warehouse.date_bounds(rows([(dt.datetime(2024, 2, 28, 5),), (dt.datetime(2024, 3, 2),), (None,)],
                                        "transaction_timestamp timestamp_ntz"))
    got = [tuple(r) for r in warehouse.dim_date(bounds).orderBy("date_id").collect()]
    assert [r[0] for r in got] == [20240228, 20240229, 20240301, 20240302]
    assert got[3] == (20240302, dt.date(2024, 3, 2), 2, 3, 2024, 1, "Saturday", True)


TX = """transaction_id string, account_id string, amount decimal(15,2), transaction_timestamp timestamp_ntz,
        status string, transaction_type string"""


def test_segment_summary_counts_each_balance_once(rows):
    tx = rows([(f"T{i}", f"A{i % 2}", Decimal("20000.00" if i == 0 else "5.00"), dt.datetime(2024, 5, i + 1), "SUCCESS", "UPI")
               for i in range(5)] + [("T9", "A9", Decimal("5.00"), dt.datetime(2024, 5, 1), "SUCCESS", "UPI")], TX)
    accounts = rows([("A0", "C1", Decimal("100.00")), ("A1", "C1", Decimal("10.50")), ("A2", "C2", Decimal("7.00"))],
                    "account_id string, customer_id string, balance decimal(15,2)")
    customers = rows([("C1", "Regular", 33), ("C2", "Regular", 60)], "customer_id string, customer_segment string, age int")
    got = [tuple(r) for r in analytics.customer_segment_summary(tx, accounts, customers).collect()]
    assert got == [(202405, "Regular", 1, 33, Decimal("110.50"), 1)]


def test_mean_age_rounds_half_up(rows):
    tx = rows([(f"T{i}", f"A{i}", Decimal("5.00"), dt.datetime(2024, 5, 1), "SUCCESS", "UPI") for i in range(2)], TX)
    accounts = rows([("A0", "C0", Decimal("1.00")), ("A1", "C1", None)],
                    "account_id string, customer_id string, balance decimal(15,2)")
    customers = rows([("C0", "Senior", 60), ("C1", "Senior", 61)], "customer_id string, customer_segment string, age int")
    row = analytics.customer_segment_summary(tx, accounts, customers).first()
    assert (row.avg_age, row.total_customers, row.total_balance) == (61, 2, Decimal("1.00"))


def test_daily_branch_metrics(rows):
    fact = rows([
        (20240101, "B1", "C1", Decimal("10.00"), "SUCCESS", "CASH_DEPOSIT"),
        (20240101, "B1", "C1", Decimal("3.00"), "SUCCESS", "UPI"),
        (20240101, "B1", None, Decimal("4.00"), "FAILED", "UPI"),
        (20240101, None, "C1", Decimal("4.00"), "SUCCESS", "UPI"),
    ], "date_id int, branch_id string, customer_id string, amount decimal(15,2), status string, transaction_type string")
    got = [tuple(r) for r in analytics.daily_branch_metrics(fact).collect()]
    assert got == [(20240101, "B1", 3, Decimal("10.00"), Decimal("3.00"), 1)]


def test_reconcile(rows):
    money = "amount decimal(15,2)"
    source = rows([(Decimal("1.00"),), (Decimal("2.00"),), (None,), (Decimal("2.00"),)], money)
    target = rows([(Decimal("1.00"),), (Decimal("2.00"),)], money)
    rejects = rows([(None, 1), (Decimal("2.00"), 1)], money + ", copies int")
    row = analytics.reconcile(source, target, rejects, "transactions").first()
    assert (row.source_count, row.target_count, row.rejected_count, row.count_difference) == (4, 2, 2, 0)
    assert (row.amount_difference, row.overall_status) == (Decimal("0.00"), "PASS")
    row = analytics.reconcile(source, target, rejects.where("amount is null"), "transactions").first()
    assert (row.count_difference, row.amount_difference, row.count_status, row.amount_status, row.overall_status) == (
        1, Decimal("2.00"), "FAIL", "FAIL", "FAIL")
    empty = source.limit(0)
    assert analytics.reconcile(empty, empty, empty, "transactions").first().overall_status == "PASS"


def test_keys_keep_all_their_digits(spark):
    from ledgerbrook.plans import views
    from ledgerbrook.plans.queries import _number

    df = spark.sql("select cast(id as bigint) id from values (7), (12345678), (123456789012) t(id)")
    got = df.select(F.expr(f"concat('CUST-', {views.key('id', 7)})").alias("k")).withColumn("n", _number("k", 5)).collect()
    assert [(r.k, r.n) for r in got] == [
        ("CUST-0000007", 7), ("CUST-12345678", 12345678), ("CUST-123456789012", 123456789012)]
    suppliers = spark.sql("select 123456L s_suppkey").select(F.expr(f"concat('MER-', {views.key('s_suppkey', 5)})").alias("k"))
    assert suppliers.first().k == "MER-123456"
