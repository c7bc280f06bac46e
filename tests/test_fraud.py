import datetime as dt
import random
from dataclasses import replace
from decimal import Decimal

import pytest

from ledgerbrook.operators import fraud
from ledgerbrook.settings import FraudSettings

TX = """transaction_id string, account_id string, amount decimal(15,2), transaction_timestamp timestamp_ntz,
        status string, location string"""
T0 = dt.datetime(2024, 3, 1, 12)


def tx(rows, entries):
    """Entries of (id, account, minutes, amount, status, location)."""
    return rows([
        (i, a, None if amount is None else Decimal(str(amount)), None if m is None else T0 + dt.timedelta(minutes=m), s, loc)
        for i, a, m, amount, s, loc in entries
    ], TX)


def ids(df):
    return sorted(r.transaction_id for r in df.collect())


def test_amount_and_channel_flags(rows):
    df = rows([("T1", 500.0, "ATM"), ("T2", 1500.0, "Online")], "transaction_id string, amount double, channel string")
    settings = replace(FraudSettings(), high_amount=1000.0)
    got = {r.transaction_id: r for r in
           fraud.calculate_fraud_score(fraud.apply_rules(df, settings), settings).collect()}
    assert got["T1"].is_fraudulent is False and got["T1"].fraud_score == 0
    assert got["T2"].is_fraudulent is True and got["T2"].fraud_score == 70


def test_amount_limit_is_strict_and_scores_add_up(rows):
    df = rows([("a", Decimal("10000.00"), None), ("b", Decimal("10000.00"), "Online"),
               ("c", Decimal("10000.01"), "ATM"), ("d", Decimal("10000.01"), "Online"), ("e", None, "ATM")],
              "transaction_id string, amount decimal(15,2), channel string")
    got = {r.transaction_id: (r.fraud_score, r.is_fraudulent) for r in
           fraud.calculate_fraud_score(fraud.apply_rules(df)).collect()}
    assert got == {"a": (0, False), "b": (20, False), "c": (50, True), "d": (70, True), "e": (0, False)}


def test_merchant_class_flag(rows):
    df = rows([("a", "HIGH"), ("b", "LOW"), ("c", None)], "transaction_id string, merchant_risk_category string")
    got = {r.transaction_id: r.fraud_flag_risky_merchant for r in fraud.flag_risky_merchant_class(df).collect()}
    assert got == {"a": True, "b": False, "c": False}


def test_velocity_burst(rows):
    df = tx(rows, [(f"T{i:02d}", "A", 0.8 * i, 10, "SUCCESS", "X") for i in range(10)])
    assert ids(fraud.high_velocity(df)) == [f"T{i:02d}" for i in range(4, 10)]


def test_velocity_frame_is_inclusive_across_slices(rows):
    s = replace(FraudSettings(), velocity_count=2, slice_minutes=10)
    df = tx(rows, [("a", "A", 0, 1, "SUCCESS", "X"), ("b", "A", 10, 1, "SUCCESS", "X"),
                   ("c", "B", 0, 1, "SUCCESS", "X"), ("d", "B", 10.0001, 1, "SUCCESS", "X"),
                   ("e", "C", 5, 1, "SUCCESS", "X"), ("f", "C", 5, 1, "SUCCESS", "X"),
                   ("g", "C", None, 1, "SUCCESS", "X"), ("h", None, 5, 1, "SUCCESS", "X")])
    assert ids(fraud.high_velocity(df, s)) == ["b", "e", "f"]


def test_locations(rows):
    df = tx(rows, [
        ("a", "A", 0, 1, "SUCCESS", "X"), ("b", "A", 20, 1, "SUCCESS", None), ("c", "A", 30, 1, "SUCCESS", "Y"),
        ("d", "A", 31, 1, "SUCCESS", "Y"), ("e", "B", 0, 1, "SUCCESS", "X"), ("f", "B", 0, 1, "SUCCESS", "Y"),
        ("g", "B", 20, 1, "SUCCESS", None), ("h", "C", 0, 1, "SUCCESS", None), ("i", "C", 1, 1, "SUCCESS", None),
    ])
    assert ids(fraud.impossible_location(df)) == ["c", "e", "f", "g"]


def test_failed_then_success(rows):
    df = tx(rows, [
        ("f0", "A", 0, 1, "FAILED", "X"), ("f1", "A", 3, 1, "FAILED", "X"), ("f2", "A", 6, 1, "FAILED", "X"),
        ("f3", "A", 9, 1, "FAILED", "X"), ("s", "A", 15, 1, "SUCCESS", "X"),
        # one of three failures at the same instant as the success
        ("g0", "B", 0, 1, "FAILED", "X"), ("g1", "B", 1, 1, "FAILED", "X"), ("g2", "B", 2, 1, "FAILED", "X"),
        ("t", "B", 2, 1, "SUCCESS", "X"), ("u", "B", 60, 1, "SUCCESS", "X"), ("v", "B", 61.1, 1, "SUCCESS", "X"),
    ])
    assert ids(fraud.failed_then_success(df)) == ["s", "u"]


def test_large_against_own_history(rows):
    day = 24 * 60
    small = [(f"h{i:02d}", "A", i * day, 100, "SUCCESS", "X") for i in range(30)]
    df = tx(rows, small + [
        ("early", "A", 29.5 * day, 450000, "SUCCESS", "X"),
        ("b", "B", 0, 100, "SUCCESS", "X"), ("exact", "B", 30 * day, 1000, "SUCCESS", "X"),
        ("large", "B", 31 * day, 450000, "FAILED", "X"), ("first", "C", 0, 900000, "SUCCESS", "X"),
    ])
    assert ids(fraud.large_transaction(df)) == ["large"]


def test_average_is_per_customer_where_known(rows):
    day = 24 * 60
    entries = tx(rows, [("a", "A1", 0, 100, "SUCCESS", "X"), ("b", "A2", 31 * day, 1001, "SUCCESS", "X")])
    assert ids(fraud.large_transaction(entries)) == []
    owned = entries.selectExpr("*", "'C1' as customer_id")
    assert ids(fraud.large_transaction(owned)) == ["b"]


def test_busy_day(rows):
    day = 24 * 60
    data = [(f"p{d}", "A", d * day, 1, "SUCCESS", "X") for d in (0, 3)]
    data += [(f"q{i}", "A", 5 * day + i, 1, "SUCCESS", "X") for i in range(4)]
    data += [(f"r{i}", "B", i, 1, "SUCCESS", "X") for i in range(9)]
    data += [("s0", "C", 0, 1, "SUCCESS", "X")] + [(f"s{i}", "C", 40 * day + i, 1, "SUCCESS", "X") for i in range(1, 9)]
    assert ids(fraud.unusual_frequency(tx(rows, data))) == ["q0", "q1", "q2", "q3"]


def test_severity_ladder(rows):
    df = rows([(i,) for i in (0, 30, 39, 40, 50, 60, 79, 80, 100)], "s int")
    got = [r.v for r in df.orderBy("s").select(fraud.severity_of(df.s).alias("v")).collect()]
    assert got == [None, "LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "CRITICAL", "CRITICAL"]


def test_alerts_are_ranked_by_score(rows):
    df = tx(rows, [(f"T{i}", "A", i, 10, "SUCCESS", "X" if i < 6 else "Y") for i in range(7)])
    scored = fraud.score_rules(fraud.evaluate_rules(df))
    assert scored.count() == 7
    got = sorted((r.alert_rank, r.transaction_id, r.rule, r.risk_score, r.severity) for r in fraud.alerts(scored).collect())
    assert got == [
        (1, "T6", "HIGH_VELOCITY", 100, "CRITICAL"), (1, "T6", "IMPOSSIBLE_LOCATION", 100, "CRITICAL"),
        (3, "T4", "HIGH_VELOCITY", 40, "MEDIUM"), (3, "T5", "HIGH_VELOCITY", 40, "MEDIUM"),
    ]


# ---- against brute force, with a hot account ------------------------------------------


def brute(entries, s):
    """The definitions, row against row."""
    minute = dt.timedelta(minutes=1)
    flags = {}
    for i, a, t, amount, status, _ in entries:
        mine = [e for e in entries if e[1] == a]

        def trailing(minutes, strict=False):
            return [e for e in mine if t - minutes * minute <= e[2] and (e[2] < t if strict else e[2] <= t)]

        before = [e for e in mine if e[2] < t]
        cities = {e[5] for e in trailing(s.location_minutes) if e[5] is not None}
        days = {}
        for e in mine:
            if 1 <= (t.date() - e[2].date()).days <= s.frequency_days:
                days[e[2].date()] = days.get(e[2].date(), 0) + 1
        today = sum(e[2].date() == t.date() for e in mine)
        flags[i] = (
            len(trailing(s.velocity_minutes)) >= s.velocity_count,
            len(cities) > 1,
            bool(before) and t - min(e[2] for e in before) >= dt.timedelta(days=s.large_history_days)
            and amount * len(before) > s.large_multiplier * sum(e[3] for e in before),
            status == "SUCCESS" and sum(e[4] == "FAILED" for e in trailing(s.failed_minutes, True)) >= s.failed_count,
            bool(days) and today * len(days) > s.frequency_multiplier * sum(days.values()),
        )
    return flags


@pytest.mark.parametrize("seed,slice_minutes", [(1, None), (2, 60), (3, 7)])
def test_window_rules_equal_brute_force(rows, seed, slice_minutes):
    rng = random.Random(seed)
    s = replace(FraudSettings(), velocity_count=2, failed_minutes=90, failed_count=2, large_multiplier=2,
                large_history_days=1, frequency_multiplier=1, slice_minutes=slice_minutes)
    entries = []
    for n in range(260):
        account = "HOT" if rng.random() < 0.4 else f"A{rng.randrange(8)}"
        # few distinct instants, so that many rows share one; some before the epoch
        at = dt.datetime(1970, 1, 2, 23) - dt.timedelta(minutes=rng.choice([5, 7.5, 1]) * rng.randrange(900))
        entries.append((f"T{n:03d}", account, at, Decimal(rng.choice([1, 5, 5, 5, 40])),
                        rng.choice(["SUCCESS", "FAILED"]), rng.choice(["X", "X", "X", "Y", None])))
    got = {
        r.transaction_id: tuple(r[fraud.rule_flag(name)] for name in fraud.RULES)
        for r in fraud.evaluate_rules(rows(entries, """transaction_id string, account_id string,
            transaction_timestamp timestamp_ntz, amount decimal(15,2), status string, location string"""), s).collect()
    }
    expected = brute(entries, s)
    assert got == expected
    assert all(any(f[k] for f in expected.values()) for k in range(5))


def test_times_do_not_depend_on_the_session_zone(spark, rows):
    df = tx(rows, [("a", "A", None, 1, "SUCCESS", "X")]).selectExpr(
        "account_id", "timestamp_ntz'2024-03-31 02:30:00.000001' as transaction_timestamp")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")  # a time this zone skips
        at = fraud.timed(df).first().at
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert at == 1711852200000001


GEO = [("Pune", 18.5, 73.9), ("Mumbai", 19.1, 72.9), ("Delhi", 28.6, 77.2), ("Agra", 27.2, 78.0), ("Nowhere", None, None)]


def brute_far(entries, geo, minutes, km):
    """Ids of rows whose window holds two cities that far apart."""
    import math

    at = {c: (math.radians(a), math.radians(b)) for c, a, b in geo if a is not None}

    def apart(x, y):
        if x not in at or y not in at:
            return False
        (a, b), (c, d) = at[x], at[y]
        h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
        return 2 * 6371 * math.asin(math.sqrt(h)) >= km

    found = []
    for i, account, m, *_ in entries:
        window = [e for e in entries if e[1] == account and account and e[2] is not None and m is not None and m - minutes <= e[2] <= m]
        if any(apart(x[5], y[5]) for x in window for y in window):
            found.append(i)
    return sorted(found)


@pytest.mark.parametrize("slice_minutes", [None, 7])
def test_cities_must_be_far_apart(rows, slice_minutes):
    s = replace(FraudSettings(), slice_minutes=slice_minutes)
    geo = rows(GEO, "city string, lat double, lon double")
    draw = random.Random(6)
    entries = [
        (f"T{i:03d}", draw.choice(["A", "B", "C", None]), draw.choice([draw.randrange(0, 600) / 2, None if draw.random() < 0.05 else 30.0]), 1, "SUCCESS",
         draw.choice(["Pune", "Pune", "Mumbai", "Mumbai", "Delhi", "Agra", "Nowhere", "Unlisted", None])) for i in range(160)
    ]
    entries += [("near1", "D", 0, 1, "SUCCESS", "Pune"), ("near2", "D", 5, 1, "SUCCESS", "Mumbai"), ("far", "D", 30, 1, "SUCCESS", "Delhi"), ("gone", "D", 36, 1, "SUCCESS", None),
                ("unknown", "E", 0, 1, "SUCCESS", "Nowhere"), ("known", "E", 1, 1, "SUCCESS", "Pune")]
    got = ids(fraud.impossible_location(tx(rows, entries), s, geo))
    assert got == brute_far(entries, GEO, 30, 500) and "far" in got and "near2" not in got and "known" not in got
    scored = fraud.evaluate_rules(tx(rows, entries), s, city_geo=geo)
    assert ids(scored.where("is_impossible_location")) == got and scored.count() == len(entries)
