import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerbrook.operators import analytics, sets


def numbers_of(df):
    return {r.k: r.number for r in df.collect()}


def test_numbers_are_kept_and_dense_whatever_the_lots(rows):
    first = sets.numbered(rows([(f"a{i}",) for i in range(50)] * 2 + [(None,)], "k string"), "k", lots=3)
    one = numbers_of(first)
    assert len(one) == 50 and len(set(one.values())) == 50
    for lot in range(3):
        places = sorted(n & 0xFFFFFFFF for n in one.values() if n >> 32 == lot)
        assert places == list(range(1, len(places) + 1))
    known = rows(list(one.items()), "k string, number long")
    for lots in (1, 3, 5):
        more = numbers_of(sets.numbered(rows([(f"a{i}",) for i in range(40, 90)], "k string"), "k", known, lots))
        assert set(more) == {f"a{i}" for i in range(50, 90)}
        assert not set(more.values()) & set(one.values()) and len(set(more.values())) == 40
    assert numbers_of(sets.numbered(known.limit(0), "k")) == {}
    assert sets.lots_for(0) == 1 and sets.lots_for(sets.PER_LOT + 1) == 2


def test_members_come_back_at_the_edges_of_bitmaps(rows):
    wanted = [1, 2, 8, 9, 32767, 32768, 32769, 65536, 65537, (3 << 32) + 1, (3 << 32) + 32768]
    got = sets.members(sets.collected(rows([("x", n) for n in wanted] * 2, "g string, number long"), ["g"]), ["g"])
    assert sorted(r.number for r in got.collect()) == wanted


def test_merged_days_equal_a_distinct_count(spark, rows):
    rng = random.Random(5)
    data = [(2020 + rng.randrange(2), rng.randrange(1, 13), rng.randrange(1, 4), rng.choice([1, 7, 32768, 32769]) + rng.randrange(60))
            for _ in range(3000)]
    days = rows(data, "year int, month int, day int, number long")
    got = {r.period: r.active_accounts for r in sets.accounts_by_period(sets.collected(days, ["year", "month", "day"])).collect()}
    want = {}
    for year, month, _, number in data:
        for period in (f"{year:04d}", f"{year:04d}-{month:02d}", f"{year:04d}-Q{(month + 2) // 3}"):
            want.setdefault(period, set()).add(number)
    assert got == {k: len(v) for k, v in want.items()}
    assert sets.accounts_by_period(sets.collected(days.limit(0), ["year", "month", "day"])).count() == 0


def test_account_months_equal_the_months_read_whole(spark, rows):
    rng = random.Random(6)
    data = [(rng.choice(["A0", *[f"A{i}" for i in range(30)], None]), Decimal(rng.choice([5, 20000])), dt.datetime(2024, rng.randrange(1, 4), rng.randrange(1, 9)))
            for _ in range(600)] + [("A5", None, dt.datetime(2024, 5, 1))]
    tx = rows(data, "account_id string, amount decimal(15,2), transaction_timestamp timestamp_ntz")
    accounts = rows([(f"A{i}", f"C{i // 2}", Decimal(i)) for i in range(28)], "account_id string, customer_id string, balance decimal(15,2)")
    customers = rows([(f"C{i}", "Regular" if i % 3 else "Senior", 20 + i) for i in range(13)], "customer_id string, customer_segment string, age int")
    numbers = sets.numbered(tx, "account_id", lots=2)
    dated = tx.withColumn("tx_date", F.to_date("transaction_timestamp"))
    days = sets.active_accounts(dated, numbers, ["tx_date"], 10000)
    assert days.groupBy("tx_date", "bucket").count().where("count > 1").count() == 0
    months = sets.account_months(days.withColumn("month_id", F.date_format("tx_date", "yyyyMM").cast("int")), numbers)
    got = analytics.segment_summary(months, accounts, customers).collect()
    assert sorted(got) == sorted(analytics.customer_segment_summary(tx, accounts, customers).collect())
