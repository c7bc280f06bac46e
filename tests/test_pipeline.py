import datetime as dt

import pytest

from ledgerbrook.operators import fraud
from ledgerbrook.plans import pipeline
from ledgerbrook.sources import facts, lake, state
from ledgerbrook.streaming.files import ingest_available

AS_OF = dt.datetime(2024, 6, 1)
HEADERS = {
    "branches": "branch_id,branch_name,city,state,branch_type",
    "merchants": "merchant_id,merchant_name,merchant_category,city,risk_category",
    "customers": "customer_id,name,age,gender,city,state,occupation,income,account_open_date,customer_segment,ingestion_timestamp",
    "accounts": "account_id,customer_id,account_type,branch_id,balance,account_status,created_at,ingestion_timestamp",
    "transactions": "transaction_id,account_id,transaction_type,amount,timestamp,merchant_id,location,payment_method,status,channel,ingestion_timestamp",
}
DIMENSIONS = {
    "branches": ["B1, Main ,Pune,MH,Urban", "B2,Side,Agra,UP,Rural"],
    "merchants": ["M1,Shop,Travel,Pune,HIGH", "M2,Cafe,Restaurant,Agra,LOW"],
    "customers": ["C1,Ann,30,F,Pune,MH,Eng,200000,2020-01-01,Regular,2024-01-01 00:00:00",
                  "C2,Bob,50,M,Agra,UP,Eng,1000,2021-01-01,Senior,2024-01-01 00:00:00",
                  "C3,Kid,12,M,Agra,UP,None,0,2021-01-01,Student,2024-01-01 00:00:00"],
    "accounts": ["A1,C1,Savings,B1,100.00,ACTIVE,2020-01-01,2024-01-01 00:00:00",
                 "A2,C1,Current,B1,50.00,ACTIVE,2020-01-01,2024-01-01 00:00:00",
                 "A3,C2,Savings,B2,10.00,BLOCKED,2020-01-01,2024-01-01 00:00:00",
                 "A4,C9,Savings,B2,10.00,ACTIVE,2020-01-01,2024-01-01 00:00:00"],
}


def transaction(n, account, time, amount=10, status="SUCCESS", location="Pune", channel="ATM", ingested=None, kind="UPI"):
    ingested = ingested or f"{time[:10]} 23:00:00"
    return f"T{n:03d},{account},{kind},{amount},{time},M1,{location},Card,{status},{channel},{ingested}"


def slice_of(day):
    """Transactions of one day: a burst on A1, one normal on A3, defects."""
    base, date = day * 20, f"2024-05-{day:02d}"
    out = [transaction(base + i, "A1", f"{date} 10:0{i}:00", amount=20000 if i == 0 else 10) for i in range(5)]
    out += [transaction(base + 6, "A3", f"{date} 12:00:00", kind="CASH_DEPOSIT", location="Agra")]
    out += [transaction(base + 7, "A9", f"{date} 12:00:00"), transaction(base + 8, "A1", f"{date} 13:00:00", amount="-5"),
            transaction(base + 9, "A1", f"{date} 14:00:00", channel="Online"),
            transaction(base + 10, "A2", "2030-01-01 00:00:00", ingested=f"{date} 22:00:00")]
    return out


def write(folder, dataset, lines, name="part"):
    path = folder / dataset
    path.mkdir(parents=True, exist_ok=True)
    (path / f"{name}.csv").write_text("\n".join([HEADERS[dataset], *lines]) + "\n")


@pytest.fixture(autouse=True)
def interpreted(spark, monkeypatch):
    """Compiling hundreds of plans for a few rows takes longer than running them; so do many partitions and buckets."""
    monkeypatch.setattr(facts, "BUCKETS", 4)
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.unset("spark.sql.codegen.wholeStage")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    for dataset, lines in DIMENSIONS.items():
        write(folder, dataset, lines)
    return folder


def table(df, *without):
    columns = sorted(c for c in df.columns if c not in without)
    return sorted(map(str, df.select(*columns).collect()))


RUN_COLUMNS = ("pipeline_run_id", "loaded_at", "last_updated")


def outcome(spark, root):
    """All result tables, without run stamps."""
    return {
        "fact": table(pipeline.read_fact(spark, root), *RUN_COLUMNS),
        "alerts": table(state.read_published(spark, root, "fraud_alerts")),
        **{name: table(spark.read.parquet(f"{root}/analytics/{name}"), *RUN_COLUMNS)
           for name in ("daily_branch_metrics", "fraud_summary", "customer_segment_summary")},
    }


def test_days_one_by_one_and_repeated_equal_one_load(spark, raw, tmp_path):
    step, whole = str(tmp_path / "step"), str(tmp_path / "whole")
    for day in (1, 2):
        write(raw, "transactions", slice_of(day), f"day{day}")
        if day == 2:  # a late row of day 1, and a copy of a row of day 1 with another amount and day
            write(raw, "transactions", [
                transaction(900, "A1", "2024-05-01 10:06:00", ingested="2024-05-02 23:30:00"),
                transaction(26, "A3", "2024-05-02 12:00:00", amount=77, ingested="2024-05-02 23:30:00"),
                slice_of(2)[0], slice_of(2)[0],
            ], "late")
            write(raw, "customers", [DIMENSIONS["customers"][0].replace("Regular", "Premium")])
        record = pipeline.run(spark, str(raw), step, f"run-{day}", AS_OF + dt.timedelta(days=day - 1))
        assert record["status"] == "SUCCESS"
    before = table(state.read_published(spark, step, "dim_customer"))
    first = outcome(spark, step)
    stored = [r.day for r in facts.days_in_force(spark, step, facts.ACTIVE).where("records > 0").collect()]
    assert sorted(stored) == [20240501, 20240502]
    facts.drop_days(spark, step, [20240501], "old", facts.ACTIVE)  # as in a lake loaded before there were sets
    pipeline.run(spark, str(raw), step, "run-2", AS_OF + dt.timedelta(days=1))
    a = outcome(spark, step)
    assert a == first
    assert table(state.read_published(spark, step, "dim_customer")) == before

    write(raw, "customers", DIMENSIONS["customers"][1:], "rest")
    pipeline.run(spark, str(raw), whole, "run-1", AS_OF)
    assert a == outcome(spark, whole)
    assert len(a["fact"]) == 6 * 2 + 1

    fact = {r.transaction_id: r for r in pipeline.read_fact(spark, step).collect()}
    assert str(fact["T026"].amount) == "77.00" and fact["T026"].day == 2
    assert fact["T020"].is_fraudulent and fact["T020"].customer_id == "C1" and fact["T020"].branch_id == "B1"
    alerts = {(r.transaction_id, r.rule) for r in state.read_published(spark, step, "fraud_alerts").collect()}
    assert {("T024", "HIGH_VELOCITY"), ("T900", "HIGH_VELOCITY")} <= alerts

    verdicts = state.read_state(spark, step, "reconciliation_results").collect()
    assert [v.overall_status for v in verdicts] == ["PASS"] * 2
    rejects = state.read_state(spark, step, "rejected_records").where("run_id = 'run-1'")
    assert sorted((r.dataset, r.record_id, r.failed_rule) for r in rejects.collect()) == [
        ("accounts", "A4", "REFERENTIAL_customer_id"),
        ("customers", "C3", "RANGE_age"),
        ("transactions", "T027", "REFERENTIAL_account_id"),
        ("transactions", "T028", "RANGE_amount"),
        ("transactions", "T029", "VALIDITY_channel"),
        ("transactions", "T030", "TIMESTAMP_transaction_timestamp"),
    ]
    assert state.get_last_watermark(spark, step, "transactions") == "2024-05-02T23:30:00"
    late = state.read_state(spark, step, "rejected_records").where("run_id = 'run-2' and dataset = 'transactions'")
    assert sorted(r.failed_rule for r in late.collect()).count("DUPLICATE") == 2
    assert state.read_state(spark, step, "quality_results").where("dataset = 'transactions'").count() == 20
    versions = state.read_published(spark, step, "dim_customer").where("customer_id = 'C1'").orderBy("valid_from")
    assert [(r.customer_segment, r.is_active) for r in versions.collect()] == [("Regular", False), ("Premium", True)]
    assert pipeline.active(spark, step, "dim_customer").where("customer_id = 'C2'").count() == 1
    runs = state.read_state(spark, step, "pipeline_runs").orderBy("start_time").collect()
    assert [(r.run_id, r.status, r.records_read - r.records_rejected - r.records_loaded) for r in runs] == [
        (run, "SUCCESS", 0) for run in ("run-1", "run-2", "run-2")]
    dates = state.read_published(spark, step, "dim_date")
    assert dates.count() == 2


def test_rejected_rows_do_not_stop_later_loads(spark, raw, tmp_path):
    root = str(tmp_path / "lake")
    # nothing acceptable in the first load
    write(raw, "transactions", [transaction(1, "A9", "2024-05-01 12:00:00")], "day0")
    write(raw, "branches", ["B1,Main,Pune,MH,Urban", ",Nowhere,Agra,UP,Rural"], "more")
    write(raw, "merchants", ["M3,Bureau,Unlisted,Pune,HIGH", "M4,Mall,Shopping,Pune,"], "more")
    record = pipeline.run(spark, str(raw), root, "run-0", AS_OF)
    assert (record["status"], record["records_read"], record["records_loaded"]) == ("SUCCESS", 1, 0)
    assert state.get_last_watermark(spark, root, "transactions") == "1970-01-01T00:00:00"
    rejects = state.read_state(spark, root, "rejected_records").where("dataset in ('branches', 'transactions')")
    assert sorted(r.failed_rule for r in rejects.collect()) == ["COMPLETENESS", "DUPLICATE", "REFERENTIAL_account_id"]
    risks = {r.merchant_id: r.risk_category for r in pipeline.active(spark, root, "dim_merchant").collect()}
    assert risks == {"M1": "HIGH", "M2": "LOW", "M3": "HIGH", "M4": "MEDIUM"}

    write(raw, "transactions", [
        *slice_of(1), transaction(700, "A9", "2024-05-01 12:00:00", ingested="2099-01-01 00:00:00"),
        transaction(701, "A1", "2024-05-01 12:30:00", ingested="garbage"),
        transaction(702, "A1", "2024-05-01 12:31:00", ingested=" "),
    ], "day1")
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(hours=1)
    record = pipeline.run(spark, str(raw), root, "run-1", now)
    assert (record["records_loaded"], record["records_processed"]) == (7, record["records_read"])
    rules = state.read_state(spark, root, "rejected_records").where("run_id = 'run-1' and dataset = 'transactions'")
    found = {(r.record_id, r.failed_rule) for r in rules.collect()}
    assert {("T700", "TIMESTAMP_ingestion_timestamp"), ("T701", "FORMAT_ingestion_timestamp")} <= found
    # the unstamped row carries its file's time, so rows stamped more than two days earlier count as seen;
    # the next delivery is stamped after it
    later = str(now)[:19]
    write(raw, "transactions", [line.rsplit(",", 1)[0] + "," + later for line in slice_of(2)], "day2")
    # the account that some waited for arrives: they are judged again, once
    write(raw, "accounts", ["A9,C1,Savings,B2,70.00,ACTIVE,2020-01-01,2024-01-01 00:00:00"], "more")
    record = pipeline.run(spark, str(raw), root, "run-2", now + dt.timedelta(days=1))
    fact = {r.transaction_id: r for r in pipeline.read_fact(spark, root).collect()}
    assert record["status"] == "SUCCESS" and len(fact) == 13 + 3
    assert all(fact[i].account_id == "A9" and fact[i].customer_id == "C1" for i in ("T001", "T027", "T047")) and "T700" not in fact
    told = state.read_state(spark, root, "resolutions").collect()
    # T001 was late enough to be rejected by two runs
    assert sorted((r.record_id, r.outcome, r.run_id) for r in told) == [
        ("T001", "LOADED", "run-2"), ("T001", "LOADED", "run-2"), ("T027", "LOADED", "run-2"), ("T700", "REJECTED_AGAIN", "run-2")]
    assert state.read_state(spark, root, "reconciliation_results").where("run_id = 'run-2' and overall_status = 'PASS'").count() == 1
    assert pipeline.replay_set(spark, pipeline.Run(root, "run-2b", now)).count() == 0
    assert pipeline.replay_set(spark, pipeline.Run(root, "run-2", now)).count() == 4

    for f in (raw / "accounts").iterdir():
        f.write_text("account_id,balance\nA1,5\n")
    with pytest.raises(ValueError, match="customer_id"):
        pipeline.run(spark, str(raw), root, "run-3", now)


def test_a_failed_run_is_recorded(spark, raw, tmp_path):
    root = str(tmp_path / "lake")
    with pytest.raises(Exception):
        pipeline.run(spark, str(tmp_path / "nowhere"), root, "run-1", AS_OF)
    # no raw transactions: the dimensions load, the transactions do not
    this = pipeline.Run(root, "run-2", AS_OF)
    with pytest.raises(ValueError):
        pipeline.recorded(spark, this, lambda: pipeline.load_transactions(spark, this, lake.empty(spark, "transactions")))
    row = state.read_state(spark, root, "pipeline_runs").where("run_id = 'run-2'").first()
    assert row.status == "FAILED" and "dim_account" in row.error_message


def test_stream_takes_each_file_once(spark, raw, tmp_path):
    root, checkpoint = str(tmp_path / "lake"), str(tmp_path / "checkpoint")
    write(raw, "transactions", slice_of(1), "day1")
    this = pipeline.Run(root, "dims", AS_OF)
    names = ("branches", "merchants", "customers", "accounts")
    pipeline.load_dimensions(spark, this, {n: lake.read_raw(spark, str(raw / n), n) for n in names})
    load = lambda: ingest_available(spark, str(raw), root, checkpoint, as_of=AS_OF)
    assert load() == 1
    assert pipeline.read_fact(spark, root).count() == 6
    assert load() == 0
    write(raw, "transactions", slice_of(2), "day2")
    assert load() == 1
    fact = pipeline.read_fact(spark, root)
    assert fact.count() == fact.select("transaction_id").distinct().count() == 12
    runs = state.read_state(spark, root, "pipeline_runs").orderBy("run_id").collect()
    assert [(r.run_id, r.records_read, r.records_loaded) for r in runs] == [
        ("transactions-000000", 10, 6), ("transactions-000001", 10, 6)]


def test_alert_rules_are_the_declared_ones():
    assert set(fraud.RULES) == set(fraud.DEFAULTS.weights)
