"""Snapshots in any order, versions in force at a time, the stored fact table."""

import datetime as dt
import itertools
import random
from decimal import Decimal

import pytest

from ledgerbrook.operators import temporal, warehouse
from ledgerbrook.sources import facts, state
from ledgerbrook.sources.schemas import FACT

DAYS = [dt.datetime(2024, 1, d) for d in range(1, 8)]


def brute_history(snapshots):
    """key -> list of (value, valid_from, valid_to, is_active) from {time: {key: value}}."""
    out = {}
    for key in sorted({k for s in snapshots.values() for k in s}):
        versions = []
        for time in sorted(snapshots):
            if key in snapshots[time] and (not versions or versions[-1][0] != snapshots[time][key]):
                versions.append((snapshots[time][key], time))
        ends = [t for _, t in versions[1:]] + [dt.datetime(9999, 12, 31)]
        out[key] = [(v, t, e, e.year == 9999) for (v, t), e in zip(versions, ends)]
    return out


def taken(rows, snapshots, order):
    runs, seen = None, []
    for time in order:
        frame = rows([(k, v) for k, v in snapshots[time].items()], "k string, v int")
        runs = temporal.observe(runs, seen, frame, "k", time)
        seen.append(time)
    return runs


def versions_of(runs):
    out = {}
    for r in sorted(temporal.history(runs, "k").collect(), key=lambda r: (r.k, r.valid_from)):
        out.setdefault(r.k, []).append((r.v, r.valid_from, r.valid_to, r.is_active))
    return out


def test_permuted_snapshots_give_one_history(rows):
    snapshots = {
        DAYS[0]: {"a": 1, "b": 1, "c": None}, DAYS[1]: {"a": 2, "b": 1}, DAYS[2]: {"a": 1, "c": None, "d": 4}, DAYS[3]: {"a": 1, "b": 3, "c": 5},
    }
    want = brute_history(snapshots)
    for order in list(itertools.permutations(snapshots))[::5]:
        assert versions_of(taken(rows, snapshots, order)) == want, order


def test_many_random_snapshots(rows):
    draw = random.Random(9)
    snapshots = {t: {f"k{i}": draw.choice([1, 2, None]) for i in range(12) if draw.random() < 0.8} for t in DAYS}
    order = [*DAYS]
    draw.shuffle(order)
    runs = taken(rows, snapshots, order)
    assert versions_of(runs) == brute_history(snapshots)
    # a snapshot delivered again, corrected, replaces the former one
    snapshots[DAYS[3]] = {f"k{i}": 7 for i in range(6)}
    again = temporal.observe(runs, DAYS, rows(list(snapshots[DAYS[3]].items()), "k string, v int"), "k", DAYS[3])
    assert versions_of(again) == brute_history(snapshots)


def test_three_runs_join_to_one(rows):
    """A snapshot that confirms what both its neighbours showed closes the gap it had made."""
    runs, seen = None, []
    for day, value in ((0, 1), (2, 1), (1, 5), (1, 1)):
        runs = temporal.observe(runs, seen, rows([("a", value), ("b", 2)], "k string, v int"), "k", DAYS[day])
        seen = sorted({*seen, DAYS[day]})
    assert sorted(map(tuple, runs.collect())) == [("a", 1, DAYS[0], DAYS[2]), ("b", 2, DAYS[0], DAYS[2])]


def test_a_stage_takes_in_one_snapshot_and_sorts_it_once(rows):
    """A task's memory does not add up over the snapshots: each has a shuffle and, behind it, one sort for all steps."""
    runs, taken_ = None, []
    for day in (0, 3, 1, 2):
        runs = temporal.observe(runs, taken_, rows([("a", "x", 1), ("b", None, day)], "k string, v string, w int"), "k", DAYS[day])
        taken_.append(DAYS[day])
    plan = _plan(temporal.history(runs, "k"))
    steps = [line.lstrip(" :+-") for line in plan.splitlines()]
    kinds = [next(k for k in ("Exchange", "Sort", "Union") if line.startswith(f"{k} ") or line == k) for line in steps if line.startswith(("Exchange ", "Sort ", "Union"))]
    assert kinds == ["Sort", "Exchange", "Union"] * 3, plan
    assert "Aggregate" not in plan


def test_a_merge_into_the_past_is_refused(rows):
    first = warehouse.first_version(rows([("a", 1), ("b", 1)], "k string, v int"), "2024-01-01 00:00:00")
    same = warehouse.scd2(first, rows([("a", 1)], "k string, v int"), "k", "2023-06-01 00:00:00")
    assert same.count() == 2
    with pytest.raises(Exception, match="begins after the snapshot"):
        warehouse.scd2(first, rows([("a", 2)], "k string, v int"), "k", "2023-06-01 00:00:00").collect()


# ---- the version in force -----------------------------------------------------------------------

VERSIONS = "k string, x int, valid_from timestamp_ntz, valid_to timestamp_ntz"


def brute_in_force(fact, versions, before_first):
    key, at = fact
    if key is None or at is None:
        return None
    mine = sorted((v for v in versions if v[0] == key and v[2] < v[3]), key=lambda v: v[2])
    for v in mine:
        if v[2] <= at < v[3]:
            return v[1]
    if before_first and mine and at < mine[0][2]:
        return mine[0][1]
    return None


@pytest.mark.parametrize("before_first", [False, True])
@pytest.mark.parametrize("slice_days", [1, 7, 10_000])
def test_versions_in_force_equal_brute_force(rows, before_first, slice_days):
    draw = random.Random(4)
    moment = lambda: dt.datetime(2023, 12, 1) + dt.timedelta(seconds=draw.randrange(90 * 86400))
    versions = []
    for k in ("a", "b", "c", "d"):
        cuts = sorted(moment() for _ in range({"a": 30, "b": 3, "c": 2, "d": 1}[k]))
        ends = [*cuts[1:], dt.datetime(9999, 12, 31)]
        versions += [(k, draw.randrange(100) if draw.random() < 0.9 else None, s, e) for s, e in zip(cuts, ends) if k != "b" or draw.random() < 0.7]
    versions += [("b", 999, DAYS[3], DAYS[3]), (None, 1, DAYS[0], DAYS[1])]
    edges = [v[2] for v in versions] + [v[2] - dt.timedelta(microseconds=1) for v in versions]
    data = [(draw.choice(["a", "b", "c", "d", "e", None]), draw.choice([moment(), draw.choice(edges), None])) for _ in range(600)]
    data += [("a", dt.datetime(1960, 5, 5)), ("a", dt.datetime(2100, 1, 1))]
    df = rows([(i, k, t) for i, (k, t) in enumerate(data)], "i int, k string, at timestamp_ntz")
    got = temporal.in_force(df, rows(versions, VERSIONS), "k", "at", ["x"], before_first, slice_days).collect()
    assert {r.i: r.x for r in got} == {i: brute_in_force(f, versions, before_first) for i, f in enumerate(data)} and len(got) == len(data)


def test_columns_may_not_clash(rows):
    df = rows([("a", DAYS[0], 1)], "k string, at timestamp_ntz, x int")
    with pytest.raises(ValueError, match="x"):
        temporal.in_force(df, rows([], VERSIONS), "k", "at", ["x"])


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_key_is_split_and_no_range_is_joined(spark, rows):
    facts_ = spark.range(0, 120_000, 1, 8).selectExpr(
        "if(id % 3 = 0, 'hot', concat('k', id % 5000)) k", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id % 1000) at", "repeat('x', 40) pad")
    versions = rows([("hot", 1, dt.datetime(2023, 1, 1), dt.datetime(9999, 12, 31))], VERSIONS)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "30k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = temporal.in_force(facts_, versions, "k", "at", ["x"])
        assert df.where("x = 1").count() == 40_000
        df.collect()
        plan = _plan(df)
        assert "skew=true" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    finally:
        for k in settings:
            spark.conf.unset(k)


@pytest.mark.parametrize("before_first", [False, True])
def test_composed_versions_equal_two_lookups(rows, before_first):
    """Looking up one dimension cut along another is looking up both in turn, also in gaps and before the first versions."""
    draw = random.Random(12)
    moment = lambda: dt.datetime(2023, 12, 1) + dt.timedelta(hours=draw.randrange(90 * 24))

    def versions(keys, value):
        out = []
        for k in keys:
            cuts = sorted({moment() for _ in range(draw.randrange(1, 7))})
            out += [(k, value(), s, e) for s, e in zip(cuts, [*cuts[1:], dt.datetime(9999, 12, 31)]) if draw.random() < 0.8]
        return out

    accounts = versions([f"a{i}" for i in range(15)], lambda: draw.choice(["c0", "c0", "c1", "c2", "nobody", None]))
    customers = versions(["c0", "c1", "c2"], lambda: draw.choice([1, 2, None])) + [("c1", 9, DAYS[2], DAYS[2])]
    edges = [t for v in accounts + customers for t in (v[2], v[2] - dt.timedelta(microseconds=1))]
    data = [(f"a{draw.randrange(17)}", draw.choice([moment(), draw.choice(edges), None])) for _ in range(500)] + [("a1", dt.datetime(1960, 5, 5))]
    want = {}
    for i, (account, at) in enumerate(data):
        owner = brute_in_force((account, at), accounts, before_first)
        want[i] = (owner, brute_in_force((owner, at), customers, before_first))
    owners = temporal.composed(
        rows(accounts, "k string, owner string, valid_from timestamp_ntz, valid_to timestamp_ntz"), "k",
        rows(customers, VERSIONS.replace("k string", "owner string")), "owner", ["x"], before_first)
    df = rows([(i, k, t) for i, (k, t) in enumerate(data)], "i int, k string, at timestamp_ntz")
    got = temporal.in_force(df, owners, "k", "at", ["owner", "x"], before_first).collect()
    assert {r.i: (r.owner, r.x) for r in got} == want and len(got) == len(data)


def test_versions_are_listed_once_per_change_of_what_is_asked(rows):
    daily = [("a", 1 if d < 4 else 2, d, DAYS[d], DAYS[d + 1]) for d in range(6) if d != 2]
    frame = rows(daily, "k string, x int, other int, valid_from timestamp_ntz, valid_to timestamp_ntz")
    (chunk,) = temporal._listed(frame, "k", ["x"]).first()["__chunks"]
    assert [tuple(v) for v in chunk["versions"]] == [(DAYS[0], DAYS[2], 1), (DAYS[3], DAYS[4], 1), (DAYS[4], DAYS[6], 2)]


def _above(plan, leaf):
    """Names of the nodes above each leaf of a kind."""
    path, found = [], []
    for line in plan.splitlines():
        name = line.lstrip(" :+-*()0123456789")
        depth = len(line) - len(line.lstrip(" :+-"))
        path = [(d, n) for d, n in path if d < depth] + [(depth, name.split(" ")[0])]
        if name.startswith(leaf):
            found.append([n for _, n in path[:-1]])
    return found


def test_facts_are_read_and_shuffled_once(spark, rows):
    """Shuffled facts are the most of what a run keeps on disk."""
    tx = spark.range(0, 1000, 1, 8).selectExpr(
        "cast(id as string) transaction_id", "concat('a', id % 50) account_id", "timestamp_ntz'2024-01-03' transaction_timestamp",
        *[f"'{c}' {c}" for c in ("merchant_id", "transaction_type", "amount", "status", "payment_method", "channel", "location")])
    whole = (DAYS[0], dt.datetime(9999, 12, 31))
    accounts = rows([(f"a{i}", f"c{i % 7}", "b", *whole) for i in range(50)], "account_id string, customer_id string, branch_id string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    customers = rows([(f"c{i}", *whole) for i in range(5)], "customer_id string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = warehouse.fact_as_of(tx, accounts, customers)
        plan = _plan(df)
        above = _above(plan, "Range ")
        assert len(above) == 1 and above[0].count("Exchange") == 1, plan
        assert df.where("customer_id is not null and branch_id = 'b'").count() == sum((i % 50) % 7 < 5 for i in range(1000))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# ---- stored facts --------------------------------------------------------------------------------


def fact_rows(spark, entries):
    """Fact rows of (id, day, amount)."""
    schema = FACT
    values = [
        tuple({"transaction_id": i, "amount": Decimal(a), "year": d // 10000, "month": d // 100 % 100, "day": d % 100}.get(f.name) for f in schema)
        for i, d, a in entries
    ]
    return spark.createDataFrame(values, schema)


def held(df):
    return sorted((r.transaction_id, r.year * 10000 + r.month * 100 + r.day) for r in df.collect())


def test_days_are_replaced_as_a_whole(spark, tmp_path):
    root = str(tmp_path)
    assert facts.read_fact(spark, root).count() == 0
    facts.replace_days(fact_rows(spark, [("a", 20240101, 1), ("b", 20240102, 1)]), root, [20240101, 20240102], "r1")
    old = facts.read_fact(spark, root)
    # a day loses all its rows, another gets one more; whoever read before sees what they saw
    facts.replace_days(fact_rows(spark, [("a", 20240102, 1), ("b", 20240102, 1)]), root, [20240101, 20240102], "r2")
    assert held(old) == [("a", 20240101), ("b", 20240102)]
    assert held(facts.read_fact(spark, root)) == [("a", 20240102), ("b", 20240102)]
    assert held(facts.read_fact(spark, root, [20240101])) == []
    # files of a merge that failed before its entry are not seen
    fact_rows(spark, [("z", 20240102, 9)]).write.partitionBy(*facts.DAY_PARTITIONS).parquet(f"{facts.table_path(root, facts.FACTS)}/version=r3-dead")
    assert held(facts.read_fact(spark, root)) == [("a", 20240102), ("b", 20240102)]
    assert len(state.read_state(spark, root, "days_in_force").inputFiles()) == 2


def test_the_index_names_the_days_without_opening_the_fact(spark, tmp_path):
    root = str(tmp_path)
    df = fact_rows(spark, [(f"t{i}", 20240101 + i % 5, 1) for i in range(500)])
    facts.index_days(df, root, "transaction_id")
    facts.replace_days(df, root, sorted({20240101 + i % 5 for i in range(500)}), "r1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys = fact_rows(spark, [("t7", 20240210, 5), ("t12", 20240210, 5), ("new", 20240210, 5)])
        days = facts.days_of(spark, root, keys, "transaction_id")
        assert [r.day for r in days.collect()] == [20240103]
        plan = _plan(days)
        assert "fact_transactions" not in " ".join(days.inputFiles()) and all("fact_key_days" in f for f in days.inputFiles())
        initial = plan.split("Initial Plan")[-1]
        index_side = [line for line in initial.splitlines() if "fact_key_days" in line or "SelectedBucketsCount" in line]
        assert any("Bucketed: true" in line for line in index_side), initial
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    facts.index_days(keys, root, "transaction_id")
    assert sorted(r.day for r in facts.days_of(spark, root, keys, "transaction_id").collect()) == [20240103, 20240210]
