"""Scoring a batch with carried totals equals scoring the whole history."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerbrook.operators import fraud
from ledgerbrook.settings import FraudSettings
from ledgerbrook.sources import facts
from ledgerbrook.sources.schemas import FACT

SETTINGS = FraudSettings(
    velocity_count=2, large_multiplier=2, large_history_days=5, failed_count=1, frequency_multiplier=2, frequency_days=10
)
FLAGS = [fraud.rule_flag(r) for r in fraud.RULES]


@pytest.fixture(autouse=True)
def interpreted(spark, monkeypatch):
    monkeypatch.setattr(facts, "BUCKETS", 4)
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.unset("spark.sql.codegen.wholeStage")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def number(day):
    return day.year * 10000 + day.month * 100 + day.day


def transactions(n=500):
    draw = random.Random(12)
    out = []
    for i in range(n):
        day = dt.datetime(2024, 1, 20) + dt.timedelta(days=int(75 * draw.random() ** 0.7))
        at = day + dt.timedelta(minutes=draw.choice([0, 1, 5, 20, 59, 60, 1380, 1430, 1439]), microseconds=draw.randrange(3))
        out.append((f"T{i}", draw.choice(["A1", "A1", "A2", "A3", "A4"]), at, Decimal(draw.choice([5, 10, 40, 300])),
                    draw.choice(["SUCCESS", "FAILED"]), draw.choice(["X", "Y"])))
    return out


def fact(spark, rows):
    values = []
    for i, account, at, amount, status, city in rows:
        known = {"transaction_id": i, "account_id": account, "transaction_timestamp": at, "amount": amount, "status": status, "location": city,
                 "customer_id": "C1" if account in ("A1", "A2") else None, "year": at.year, "month": at.month, "day": at.day}
        values.append(tuple(known.get(f.name) for f in FACT))
    return spark.createDataFrame(values, FACT)


def flags(df):
    return {r[0]: tuple(r)[1:] for r in df.select("transaction_id", *FLAGS).collect()}


def test_slices_with_carried_totals_equal_the_whole(spark, tmp_path):
    root, rows = str(tmp_path), sorted(transactions(), key=lambda r: r[2])
    late = [r for i, r in enumerate(rows) if i % 29 == 5]
    usual = [r for r in rows if r not in late]
    batches = [usual[:200] + late[:0], usual[200:300] + late[:4], usual[300:420] + late[4:9], usual[420:] + late[9:]]
    known, months = [], set()
    for n, batch in enumerate(batches):
        known += batch
        days = sorted({number(r[2]) for r in batch})
        facts.replace_days(fact(spark, [r for r in known if number(r[2]) in days]), root, days, f"r{n}")
        facts.add_account_days(spark, root, days, f"r{n}")
        since = dt.datetime.strptime(str(days[0]), "%Y%m%d").date()
        owned = fact(spark, rows).select("account_id", F.coalesce("customer_id", "account_id").alias("party_id")).distinct()
        totals = facts.totals_before(spark, root, days[0], f"r{n}").join(owned, "account_id")
        history = fraud.History(
            since, fraud.merged_totals(totals, "party_id"),
            facts.read_account_days(spark, root, number(since - dt.timedelta(days=SETTINGS.frequency_days))).select("account_id", "tx_date", "day_count"),
        )
        recent = facts.read_days(spark, root, facts.FACTS, FACT, F.col("day") >= number(since - dt.timedelta(days=1)))
        # what is read of the fact table begins a day before the first touched one
        assert recent.agg(F.min("transaction_timestamp")).first()[0].date() >= since - dt.timedelta(days=1)
        got = flags(fraud.evaluate_rules(recent, SETTINGS, history))
        whole = flags(fraud.evaluate_rules(fact(spark, known), SETTINGS))
        wanted = {r[0]: whole[r[0]] for r in known if r[2].date() >= since}
        assert got == wanted
        months |= {r["day"] for r in facts.days_in_force(spark, root, facts.PREFIXES).where("records > 0").collect()}
    assert len(months) >= 2 and all(any(f[i] for f in whole.values()) for i in range(len(FLAGS)))


def test_late_days_void_later_totals(spark, tmp_path):
    root = str(tmp_path)

    def totals(day):
        parts = fraud.merged_totals(facts.totals_before(spark, root, day, "r"), "account_id")
        return {r.account_id: (r.n, int(r.total)) for r in parts.collect()}

    def load(rows):
        days = sorted({number(r[2]) for r in rows})
        facts.replace_days(fact(spark, rows), root, days, "r")
        facts.add_account_days(spark, root, days, "r")

    at = lambda m, d: dt.datetime(2024, m, d, 12)
    assert totals(20240301) == {}
    load([("a", "A1", at(1, 5), Decimal(10), "SUCCESS", "X"), ("b", "A1", at(3, 5), Decimal(1), "SUCCESS", "X")])
    assert totals(20240310) == {"A1": (2, 11)} and totals(20240305) == {"A1": (1, 10)} and totals(20240105) == {}
    assert [r.day for r in facts.days_in_force(spark, root, facts.PREFIXES).where("records > 0").collect()] == [20240301]
    load([("c", "A2", at(2, 7), Decimal(5), "SUCCESS", "X"), ("d", "A1", at(2, 7), Decimal(5), "SUCCESS", "X")])
    assert facts.days_in_force(spark, root, facts.PREFIXES).where("records > 0").count() == 0
    assert totals(20240310) == {"A1": (3, 16), "A2": (1, 5)}
