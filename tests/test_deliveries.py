"""Raw files whose columns differ and lines that don't fit them, in batch and stream."""

import datetime as dt

import pytest

from ledgerbrook.plans import pipeline
from ledgerbrook.sources import deliveries, facts, lake, state
from ledgerbrook.sources.schemas import RAW
from ledgerbrook.streaming.files import ingest_available
from test_pipeline import AS_OF, HEADERS, outcome, raw, slice_of, write  # noqa: F401

COLUMNS = HEADERS["transactions"].split(",")


@pytest.fixture(autouse=True)
def interpreted(spark, monkeypatch):
    monkeypatch.setattr(facts, "BUCKETS", 4)
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.unset("spark.sql.codegen.wholeStage")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def put(folder, name, columns, lines, header=None):
    folder.mkdir(parents=True, exist_ok=True)
    rows = [dict(zip(COLUMNS, line.split(","))) for line in lines]
    text = [header or ",".join(columns), *(",".join(r.get(c.strip().lower().strip('"'), "x") for c in columns) for r in rows)]
    (folder / f"{name}.csv").write_text("\n".join(text) + "\n")


def mixed(folder):
    """The rows of two days over five files of four layouts."""
    lines = [*slice_of(1), *slice_of(2)]
    put(folder, "clean", COLUMNS, lines[:4])
    put(folder, "moved", [*COLUMNS[1::-1], *COLUMNS[2:]], lines[4:8])
    put(folder, "extra", [COLUMNS[0], "note", *COLUMNS[1:5], "other", *COLUMNS[5:]], lines[8:11])
    put(folder, "with [odd] name", COLUMNS[::-1], lines[11:15], header=" " + ",".join(f'"{c.upper()}"' for c in COLUMNS[::-1]))
    put(folder, "z clean", COLUMNS, lines[15:])
    (folder / "empty.csv").write_text("")
    return lines


def test_columns_are_bound_by_each_header(spark, tmp_path):
    lines = mixed(tmp_path / "t")
    df = deliveries.read(spark, str(tmp_path / "t"), "transactions")
    assert df.columns == [*RAW["transactions"].names, *deliveries.EXTRA.names]
    got = sorted(tuple(r) for r in df.select(*COLUMNS).collect())
    assert got == sorted(tuple(line.split(",")) for line in lines) and df.where("defect is not null").count() == 0
    assert df.where("file_time > timestamp'2020-01-01'").count() == len(lines)
    found = deliveries.layouts(spark, str(tmp_path / "t"))
    assert sorted(len(layout.files) for layout in found) == [1, 1, 1, 2]
    told = {(r.column_name, r.finding, r.files) for r in deliveries.findings(spark, found, RAW["transactions"]).collect()}
    assert {("note", "EXTRA", 1), ("other", "EXTRA", 1), ("account_id", "MOVED", 1), ("transaction_id", "MOVED", 1)} <= told
    assert not any(kind in ("MISSING", "ABSENT", "REPEATED") for _, kind, _ in told)


def test_absent_optional_columns_are_null(spark, tmp_path):
    lines = slice_of(1)
    put(tmp_path / "t", "all", COLUMNS, lines[:5])
    put(tmp_path / "t", "few", COLUMNS[:-1], lines[5:])
    rows = {r.transaction_id: r.ingestion_timestamp for r in deliveries.read(spark, str(tmp_path / "t"), "transactions").collect()}
    assert sorted(rows.values(), key=str).count(None) == len(lines) - 5 and len(rows) == len(lines)
    told = deliveries.findings(spark, deliveries.layouts(spark, str(tmp_path / "t")), RAW["transactions"]).collect()
    assert [(r.column_name, r.finding) for r in told] == [("ingestion_timestamp", "ABSENT")]


def test_lines_that_do_not_fit_are_kept_as_text(spark, tmp_path):
    lines = slice_of(1)
    broken = ["T1,A1", "T2," + "x," * 20, 'T3,"A1,UPI,10,2024-05-01 10:00:00,M1,Pune,Card,SUCCESS,ATM,2024-05-01 23:00:00', "just text"]
    write(tmp_path, "transactions", [*lines[:3], *broken[:2], "", *lines[3:], *broken[2:]])
    df = deliveries.read(spark, str(tmp_path / "transactions"), "transactions")
    assert sorted(r.raw_text for r in df.where("defect = 'MALFORMED'").collect()) == sorted(broken)
    assert df.where("defect is not null and transaction_id is not null").count() == 0
    assert df.where("defect is null").count() == len(lines)
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "a.json").write_text('{"transaction_id":"T1","extra":1}\n{"transaction_id":\n{"amount":"5","transaction_id":"T2"}\n')
    rows = deliveries.read(spark, str(tmp_path / "j"), "transactions", "json").collect()
    assert sorted((r.transaction_id or "", r.amount, r.defect) for r in rows) == [("", None, "MALFORMED"), ("T1", None, None), ("T2", "5", None)]


def test_files_without_required_columns(spark, tmp_path):
    lines = slice_of(1)
    put(tmp_path / "t", "good", COLUMNS, lines[:6])
    put(tmp_path / "t", "bad", [c for c in COLUMNS if c != "amount"], lines[6:])
    put(tmp_path / "t", "twice", [*COLUMNS, "status"], lines[:1])
    df = deliveries.read(spark, str(tmp_path / "t"), "transactions")
    assert df.where("defect = 'SCHEMA'").count() == len(lines) - 6 + 1 and df.where("defect is null").count() == 6
    found = deliveries.layouts(spark, str(tmp_path / "t"))
    deliveries.require_columns(found, RAW["transactions"], "transactions")
    told = {(r.column_name, r.finding) for r in deliveries.findings(spark, found, RAW["transactions"]).collect()}
    assert {("amount", "MISSING"), ("status", "REPEATED")} <= told
    with pytest.raises(ValueError, match="amount"):
        deliveries.require_columns([x for x in found if "amount" not in x.names], RAW["transactions"], "transactions")
    assert deliveries.read_layouts(spark, [], RAW["branches"]).count() == 0


def test_headers_over_many_splits(spark, tmp_path):
    put(tmp_path / "t", "large", COLUMNS[::-1], slice_of(1) * 400)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = deliveries.read(spark, str(tmp_path / "t"), "transactions")
        assert df.rdd.getNumPartitions() > 5 and df.count() == 400 * len(slice_of(1))
        assert df.where("defect is not null").count() == 0 and df.where("transaction_id = 'T020'").count() == 400
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_batch_and_stream_load_mixed_files(spark, raw, tmp_path):  # noqa: F811
    """Broken lines and a refused file are quarantined and reconciled; all readable rows load."""
    batch, stream = (str(tmp_path / name) for name in ("batch", "stream"))
    mixed(raw / "transactions")
    write(raw, "transactions", ["T1,A1", "x"], "broken")
    put(raw / "transactions", "refused", COLUMNS[:4], slice_of(3))
    put(raw / "merchants", "fewer", ["risk_category"], [])
    (raw / "merchants" / "fewer.csv").write_text("city,merchant_id,merchant_name,merchant_category\nPune,M9,New,Travel\n")
    record = pipeline.run(spark, str(raw), batch, "run-1", AS_OF)
    fact = {r.transaction_id: r for r in pipeline.read_fact(spark, batch).collect()}
    assert sorted(fact) == [f"T{d * 20 + i:03d}" for d in (1, 2) for i in (0, 1, 2, 3, 4, 6)]
    assert {(r.account_id, r.customer_id, r.location) for r in fact.values()} == {("A1", "C1", "Pune"), ("A3", "C2", "Agra")}
    assert record["records_read"] == record["records_processed"] == 20 + 2 + 10
    assert record["records_read"] - record["records_loaded"] == record["records_rejected"]

    this = pipeline.Run(stream, "dims", AS_OF)
    names = ("branches", "merchants", "customers", "accounts")
    pipeline.load_dimensions(spark, this, {n: pipeline.delivered(spark, this, str(raw / n), n) for n in names})
    assert ingest_available(spark, str(raw), stream, str(tmp_path / "checkpoint"), as_of=AS_OF) == 1
    assert outcome(spark, stream) == outcome(spark, batch)

    for root in (batch, stream):
        rejects = state.read_state(spark, root, "rejected_records").where("failed_rule in ('MALFORMED', 'SCHEMA')").collect()
        assert sorted((r.failed_rule, r.raw_data) for r in rejects)[:2] == [("MALFORMED", "T1,A1"), ("MALFORMED", "x")] and len(rejects) == 12
        assert len({r.rejection_id for r in rejects}) == 12
        verdict = state.read_state(spark, root, "reconciliation_results").first()
        assert (verdict.overall_status, verdict.source_count) == ("PASS", 32)
        told = state.read_state(spark, root, "schema_findings")
        assert told.where("dataset = 'transactions' and finding = 'MISSING'").count() == 6
    assert state.read_state(spark, batch, "schema_findings").where("dataset = 'merchants'").first().finding in ("ABSENT", "MOVED")
    assert pipeline.active(spark, batch, "dim_merchant").where("merchant_id = 'M9' and risk_category = 'HIGH'").count() == 1


def test_unstamped_rows_are_stamped_by_file(spark, tmp_path):
    put(tmp_path / "t", "few", COLUMNS[:-1], slice_of(1))
    put(tmp_path / "t", "all", COLUMNS, slice_of(2))
    df = lake.stamped(deliveries.read(spark, str(tmp_path / "t"), "transactions"), "b", dt.datetime(2001, 1, 1))
    assert df.where("year(ingestion_timestamp) > 2024").count() == df.where("year(ingestion_timestamp) = 2024").count() == 10
