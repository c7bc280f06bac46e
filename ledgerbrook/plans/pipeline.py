"""The daily load: raw files to dimensions, facts, alerts, summaries and run records.

Every step reads written tables and writes others under the lake root, which has
to be storage all executors share. So a lost executor costs a recomputed task, not
a run, and running a failed run again under the same id gives the same tables.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerbrook.operators import analytics, cleansing, fraud, incremental, quality, sets, temporal, warehouse
from ledgerbrook.operators.dedup import extra_copies, latest_per_key
from ledgerbrook.operators.lookup import lookup
from ledgerbrook.settings import EPOCH, Settings
from ledgerbrook.sources import deliveries, facts, lake, state
from ledgerbrook.sources.facts import day_number, in_days, read_fact
from ledgerbrook.sources.schemas import FACT, OPTIONAL, RAW

STAMPS = ("ingestion_timestamp", "ingestion_text", "batch_id")
FILE_CLOCK_SLACK = dt.timedelta(days=1)


@dataclass(frozen=True)
class Run:
    """One run of the pipeline: where it writes, when it happens, under which id."""

    root: str
    run_id: str
    as_of: dt.datetime
    settings: Settings = Settings()


def run(spark: SparkSession, raw_dir: str, root: str, run_id: str, as_of: dt.datetime | None = None,
        settings: Settings = Settings(), fmt: str = "csv") -> dict:
    """Load everything under `raw_dir/<dataset>/` newer than the watermark; return the run record.

    Transaction files that are older than the watermark less the days records may be late are not opened:
    a row is stamped before its file is written. FILE_CLOCK_SLACK allows for clocks that differ.
    """
    this = Run(root, run_id, as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), settings)
    folder = {name: f"{raw_dir.rstrip('/')}/{name}" for name in ("branches", "merchants", "customers", "accounts", "transactions")}

    def work() -> dict:
        since = state.get_last_watermark(spark, root, "transactions")
        oldest = incremental.effective_watermark(since, settings.incremental) - FILE_CLOCK_SLACK
        raw = {name: delivered(spark, this, path, name, fmt, oldest if name == "transactions" and since > EPOCH else None)
               for name, path in folder.items()}
        load_dimensions(spark, this, raw)
        stamped = lake.stamped(raw["transactions"], run_id, this.as_of)
        # a malformed stamp has no time to compare: the gate sees it as long as its file is read
        fresh = incremental.newer_or_late(stamped, since, settings.incremental)
        return load_transactions(spark, this, fresh.unionByName(stamped.where("ingestion_timestamp is null")), replay_set(spark, this))

    return recorded(spark, this, work)


def delivered(spark: SparkSession, this: Run, path: str | list[str], name: str, fmt: str = "csv",
              modified_after: dt.datetime | None = None) -> DataFrame:
    """A dataset's files bound by their own columns; what differs from the declared ones is filed as findings."""
    if fmt != "csv":
        cleansing.require_columns(lake.delivered_schema(spark, path, fmt), RAW[name], name, OPTIONAL)
        return deliveries.read(spark, path, name, fmt, modified_after)
    found = deliveries.layouts(spark, path, modified_after)
    state.write_run(deliveries.findings(spark, found, RAW[name]).coalesce(1), this.root, "schema_findings", this.run_id, name)
    deliveries.require_columns(found, RAW[name], name)
    return deliveries.read_layouts(spark, found, RAW[name])


def recorded(spark: SparkSession, this: Run, work) -> dict:
    """Run `work` and append its record, also where it fails."""
    started = dt.datetime.now(dt.timezone.utc)
    record = {"run_id": this.run_id, "pipeline_name": this.settings.pipeline_name, "start_time": started}
    try:
        record |= work() | {"status": "SUCCESS"}
    except Exception as error:
        record |= {"status": "FAILED", "error_message": str(error)}
        raise
    finally:
        record["end_time"] = dt.datetime.now(dt.timezone.utc)
        state.append_row(spark, this.root, "pipeline_runs", **record)
    return record


# ---- quality gate --------------------------------------------------------------------


#: What a delivery adds to its rows and only the gate needs.
DELIVERED = ("file_path", "raw_text", "defect")


def _gate(this: Run, df: DataFrame, rules: list[quality.Rule], dataset: str, key: str) -> tuple[DataFrame, DataFrame, DataFrame, dict]:
    """Judge a dataset once, file its results and rejects; return (good rows, rejects, all rows, counts).

    The counts are observed while the rows are written: `total`, `rejected` and `f<i>` of the judged rows, `broken` of the
    unreadable ones, `newest` ingestion time of the accepted ones. No job reads rows only to count them.

    The conformed rows are written before the rules read them, so raw text is parsed once and key rules read
    their columns only; the judged rows are written before they are used three times. Good rows hold
    one row per key; what deduplication leaves out is filed as DUPLICATE. Rows that could not be read are
    filed with their raw text; no rule sees them.
    """
    spark = df.sparkSession
    conformed = f"{this.root}/processed/conformed/{dataset}/run_id={this.run_id}"
    landing = Observation()
    broken_rows = F.count_if(F.col("defect").isNotNull()) if "defect" in df.columns else F.sum(F.lit(0).cast("bigint"))
    df.observe(landing, F.count("*").alias("landed"), broken_rows.alias("broken")).write.mode("overwrite").parquet(conformed)
    landed = spark.read.schema(df.schema).parquet(conformed)
    broken = landed.where("defect is not null") if "defect" in df.columns else None
    readable = landed if broken is None else landed.where("defect is null")
    path = f"{this.root}/processed/checked/{dataset}/run_id={this.run_id}"
    judged, seen = quality.observed(quality.evaluate(readable.drop(*DELIVERED), rules), rules)
    judged.write.mode("overwrite").parquet(path)
    checked = spark.read.parquet(path)

    results = quality.results_of(spark, seen.get, rules, dataset, this.settings.quality.warn_from)
    state.write_run(
        results.withColumn("details", F.to_json(F.struct("columns"))).withColumn("checked_at", F.lit(this.as_of)),
        this.root, "quality_results", this.run_id, dataset,
    )
    passed = quality.passed(checked, rules)
    copies = extra_copies(passed, key)
    rejects = quality.rejected(checked, rules, key).unionByName(copies.select(
        F.col(key).alias("record_id"),
        F.lit(f"Duplicate {key}").alias("failure_reason"),
        F.lit("DUPLICATE").alias("failed_rule"),
        F.to_json(F.struct("*")).alias("raw_data"),
    ))
    if broken is not None:
        rejects = rejects.unionByName(deliveries.defects(broken))
    state.write_run(
        quality.quarantined(rejects, dataset, this.run_id, this.as_of),
        this.root, "rejected_records", this.run_id, dataset,
    )
    accepted, chosen = latest_per_key(passed, key), Observation()
    newest = F.max("ingestion_timestamp" if "ingestion_timestamp" in accepted.columns else F.lit(None))
    accepted = accepted.observe(chosen, F.count("*").alias("accepted"), newest.cast("string").alias("newest"))
    lake.write_files(accepted, f"{this.root}/processed/{dataset}/run_id={this.run_id}")
    good = spark.read.parquet(f"{this.root}/processed/{dataset}/run_id={this.run_id}")
    once = F.lit(1).cast("bigint").alias("copies")
    left_out = [checked.where(quality.is_rejected(rules)).drop("failed_rules").select("*", once), copies]
    everything = [checked]
    if broken is not None:
        left_out.append(broken.drop(*DELIVERED).select("*", once))
        everything.append(broken.drop(*DELIVERED))
    counts = {"broken": 0} | {k: v or 0 for k, v in {**landing.get, **seen.get}.items()} | chosen.get
    return good, lake.union_batches(left_out), lake.union_batches(everything), counts


# ---- dimensions ------------------------------------------------------------------------


def _published(spark: SparkSession, this: Run, table: str, merged_from, incoming: DataFrame) -> DataFrame:
    """Publish the merge of the table in force with the incoming rows."""
    current = state.read_published(spark, this.root, table, not_by=this.run_id)
    return state.publish(merged_from(current, incoming), this.root, table, this.run_id)


def _versioned(spark: SparkSession, this: Run, table: str, snapshot: DataFrame, key: str) -> DataFrame:
    """Publish the versions of a dimension with this run's snapshot taken in, which may be older than others.

    What was observed when is kept beside the versions, so the order in which snapshots arrive makes no difference.
    """
    root, observed = this.root, f"{table}_observed"
    runs = state.read_published(spark, root, observed, not_by=this.run_id)
    log = state.read_state(spark, root, "snapshots").where((F.col("dataset") == table) & (F.col("run_id") != this.run_id))
    taken = [r["as_of"] for r in log.select("as_of").distinct().collect()]
    versions = state.read_published(spark, root, table, not_by=this.run_id)
    if runs is None and versions is not None:  # loaded before observations were kept
        runs = temporal.runs_of(versions)
        taken += [r["valid_from"] for r in versions.select("valid_from").distinct().collect()]
    state.append_row(spark, root, "snapshots", dataset=table, run_id=this.run_id, as_of=this.as_of)
    runs = state.publish(temporal.observe(runs, taken, snapshot, key, this.as_of), root, observed, this.run_id)
    return state.publish(temporal.history(runs, key), root, table, this.run_id)


def load_dimensions(spark: SparkSession, this: Run, raw: dict[str, DataFrame]) -> None:
    def overwritten(key: str):
        return lambda old, new: new if old is None else warehouse.upsert(old, new, key)

    def gated(name: str, conform, rules: list[quality.Rule], key: str) -> DataFrame:
        rows = raw[name].drop("file_time")
        return _gate(this, conform(rows), rules, name, key)[0]

    branches = gated("branches", cleansing.conform_branches, quality.branch_rules(), "branch_id")
    _published(spark, this, "dim_branch", overwritten("branch_id"), branches)
    merchants = gated("merchants", cleansing.conform_merchants, quality.merchant_rules(), "merchant_id")
    _published(spark, this, "dim_merchant", overwritten("merchant_id"), cleansing.with_merchant_risk(merchants))

    rules = this.settings.quality
    customers = cleansing.conform_customers(lake.stamped(raw["customers"], this.run_id, this.as_of))
    people, *_ = _gate(this, customers, quality.customer_rules(rules), "customers", "customer_id")
    known = _versioned(spark, this, "dim_customer", people.drop(*STAMPS), "customer_id")
    accounts = cleansing.conform_accounts(lake.stamped(raw["accounts"], this.run_id, this.as_of))
    owned, *_ = _gate(
        this, accounts, quality.account_rules(rules, known.where("is_active")), "accounts", "account_id"
    )
    _versioned(spark, this, "dim_account", owned.drop(*STAMPS), "account_id")


def active(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The rows in force of a published dimension."""
    df = state.read_published(spark, root, table)
    if df is None:
        raise ValueError(f"{table} has not been loaded yet")
    return df.where("is_active") if "is_active" in df.columns else df


# ---- transactions ----------------------------------------------------------------------


def replay_set(spark: SparkSession, this: Run) -> DataFrame:
    """Transactions quarantined for an account that this run has brought: rejection_id and the raw columns, from their raw_data.

    Rejections that another run has taken up are left out, so each is judged again once; a repeated run takes the same ones.
    """
    root = this.root
    log = state.read_state(spark, root, "rejected_records").where(
        (F.col("dataset") == "transactions") & (F.col("failed_rule") == "REFERENTIAL_account_id") & (F.col("run_id") != this.run_id))
    taken = state.read_state(spark, root, "resolutions").where(F.col("run_id") != this.run_id).select("rejection_id").distinct()
    accounts, before = active(spark, root, "dim_account"), state.read_published(spark, root, "dim_account", not_by=this.run_id)
    new = accounts.select("account_id")
    if before is not None:
        new = lookup(new, before.select("account_id").distinct(), "account_id", "left_anti")
    stored = [f"{c} string" for c in RAW["transactions"].names if c != "timestamp"] + ["transaction_timestamp string"]
    rows = lookup(log, taken, "rejection_id", "left_anti").select("rejection_id", F.from_json("raw_data", ", ".join(stored)).alias("r"))
    rows = rows.select("rejection_id", "r.*").withColumnRenamed("transaction_timestamp", "timestamp")
    path = f"{root}/processed/replay/run_id={this.run_id}"
    lake.write_files(lookup(rows, new, "account_id", "left_semi"), path)
    return spark.read.parquet(path)


def _resolve(this: Run, replay: DataFrame, good: DataFrame) -> None:
    """File what became of rejections that were judged again."""
    loaded = good.select("transaction_id", F.lit("LOADED").alias("loaded"))
    told = lookup(replay.select("rejection_id", "transaction_id"), loaded, "transaction_id").select(
        "rejection_id", F.col("transaction_id").alias("record_id"), F.coalesce("loaded", F.lit("REJECTED_AGAIN")).alias("outcome"),
        F.lit(this.as_of).alias("resolved_at"),
    )
    state.write_run(told, this.root, "resolutions", this.run_id, "transactions")


def load_transactions(spark: SparkSession, this: Run, raw: DataFrame, replay: DataFrame | None = None) -> dict:
    """Take in a batch of raw transactions, which may hold rows loaded before.

    `replay` are quarantined ones (`replay_set`) to be judged again with it.
    """
    if replay is not None:
        again = replay.drop("rejection_id").distinct()
        raw = raw.unionByName(lake.stamped(again, this.run_id, this.as_of), allowMissingColumns=True)
    settings, root = this.settings, this.root
    accounts, customers, merchants = (
        active(spark, root, name) for name in ("dim_account", "dim_customer", "dim_merchant")
    )
    rules = quality.transaction_rules(settings.quality, accounts, this.as_of, landed=True)
    good, left_out, source, counts = _gate(
        this, cleansing.conform_transactions(raw), rules,
        "transactions", settings.incremental.dedup_key,
    )
    # the versions in force at the time of each transaction; what is older than the first snapshot gets the first version
    dated = warehouse.fact_as_of(good, *(state.read_published(spark, root, t) for t in ("dim_account", "dim_customer")), before_first=True)
    fact = fraud.calculate_fraud_score(fraud.apply_rules(dated, settings.fraud), settings.fraud)
    days = merge_fact(spark, this, warehouse.loaded(fact, this.run_id, this.as_of))
    if days:
        refresh_alerts(spark, this, good, owners(accounts, customers), days)
        refresh_summaries(spark, this, days, accounts, customers, merchants)

    target = read_fact(spark, root, days).where(F.col("pipeline_run_id") == this.run_id)
    verdict = analytics.reconcile(source, target, left_out, "transactions")
    state.write_run(verdict.withColumn("run_timestamp", F.lit(this.as_of)),
                    root, "reconciliation_results", this.run_id, "transactions")
    outcome = state.read_state(spark, root, "reconciliation_results").where(F.col("run_id") == this.run_id).first()
    # only accepted rows move the watermark, and the gate accepts none from after the run
    known = dt.datetime.fromisoformat(state.get_last_watermark(spark, root, "transactions"))
    newest = dt.datetime.fromisoformat(counts["newest"]) if counts["newest"] else known
    if newest > known:
        state.update_watermark(spark, root, "transactions", newest, this.run_id)
    if replay is not None:
        _resolve(this, replay, good)
    return {
        "records_read": outcome["source_count"],
        # what was judged by itself: all rows but the copies that deduplication left out
        "records_processed": outcome["target_count"] + counts["rejected"] + counts["broken"],
        "records_rejected": outcome["rejected_count"],
        "records_loaded": outcome["target_count"],
    }


def merge_fact(spark: SparkSession, this: Run, incoming: DataFrame) -> list[int]:
    """Upsert into the fact table, rewriting only the days concerned; return those days.

    These are the days of the incoming rows and those that the index names for their keys: nothing of the fact
    table is read to find them. The list of days is the only thing brought to the driver. A run that
    fails in between can be repeated.
    """
    root, key = this.root, this.settings.incremental.dedup_key
    landing = f"{root}/processed/incoming_fact/run_id={this.run_id}"
    warehouse.by_day(incoming).write.mode("overwrite").parquet(landing)
    incoming = spark.read.parquet(landing)
    new = incoming.select(day_number().cast("int").alias("day"))
    days = sorted(r["day"] for r in new.unionByName(facts.days_of(spark, root, incoming, key)).distinct().collect())
    if not days:
        return days
    facts.index_days(incoming, root, key)
    facts.replace_days(warehouse.upsert(read_fact(spark, root, days), incoming, key), root, days, this.run_id)
    return days


def owners(accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """Account to party: its present customer, or itself where that is unknown."""
    known = customers.select("customer_id", F.col("customer_id").alias("party_id"))
    return lookup(accounts.select("account_id", "customer_id"), known, "customer_id").select(
        "account_id", F.coalesce("party_id", "account_id").alias("party_id")
    )


def refresh_alerts(spark: SparkSession, this: Run, batch: DataFrame, mapping: DataFrame, days: list[int]) -> None:
    """Score the accounts of the parties in the batch again from the first touched day on, and republish the alerts.

    `mapping` gives the party of each account. A late row changes the flags of later rows, and a customer's average spans
    their accounts; earlier days keep their alerts. What the rules need of the earlier time comes from totals per account
    and day, so the fact table is read from the day before the first touched one on.
    """
    root, settings = this.root, this.settings.fraud
    facts.add_account_days(spark, root, days, this.run_id)
    seen = lookup(batch.select("account_id").distinct(), mapping, "account_id").select(
        "account_id", F.coalesce("party_id", "account_id").alias("party_id")
    )
    touched = lookup(mapping, seen.select("party_id").distinct(), "party_id", "left_semi")
    # The rules and the histories read it several times, so it is written once.
    path = f"{root}/processed/touched/run_id={this.run_id}"
    lake.write_files(touched.unionByName(seen).distinct(), path)
    touched = spark.read.parquet(path)

    first = dt.datetime.strptime(str(min(days)), "%Y%m%d").date()
    number = lambda d: d.year * 10000 + d.month * 100 + d.day
    recent = facts.read_days(spark, root, facts.FACTS, FACT, F.col("day") >= number(first - dt.timedelta(days=1)))
    totals = lookup(facts.totals_before(spark, root, min(days), this.run_id), touched, "account_id", "inner")
    counted = facts.read_account_days(spark, root, number(first - dt.timedelta(days=settings.frequency_days)))
    history = fraud.History(
        first, fraud.merged_totals(totals, "party_id"), lookup(counted, touched, "account_id", "left_semi").select("account_id", "tx_date", "day_count")
    )
    path = f"{root}/processed/history/run_id={this.run_id}"
    lake.write_files(lookup(recent, touched, "account_id", "inner"), path)
    scored = fraud.score_rules(fraud.evaluate_rules(spark.read.parquet(path), settings, history), settings)
    rows = fraud.fired(scored).select(
        "transaction_id", "account_id", "amount", "transaction_timestamp", "rule", "risk_score", "severity",
    )
    old = state.read_published(spark, root, "fraud_alerts", not_by=this.run_id)
    if old is not None:
        again = touched.select("account_id", F.lit(True).alias("again"))
        kept = lookup(old.drop("alert_rank"), again, "account_id").where(
            F.col("again").isNull() | (F.to_date("transaction_timestamp") < F.lit(first))
        ).drop("again")
        kept = lookup(kept, batch.select("transaction_id"), "transaction_id", "left_anti")
        rows = kept.unionByName(rows)
    # alerts are ranked by their counts per score: written first, so that the rules run once
    path = f"{root}/processed/alerts/run_id={this.run_id}"
    lake.write_files(rows, path)
    state.publish(fraud.prioritized(spark.read.parquet(path)), root, "fraud_alerts", this.run_id)


def refresh_summaries(spark: SparkSession, this: Run, days: list[int], accounts: DataFrame,
                      customers: DataFrame, merchants: DataFrame) -> None:
    """Recompute the summary rows of the given days and of their months. Only the given days of the fact table are read:
    the distinct accounts of a month are merged from sets kept per day."""
    root = this.root
    fact = read_fact(spark, root)
    concerned = in_days(fact, days)
    daily = analytics.daily_branch_metrics(concerned)
    frauds = analytics.fraud_summary(concerned, merchants)
    facts.add_active_accounts(spark, root, days, this.run_id, this.settings.high_value_above)
    active = facts.read_active_accounts(spark, root, sorted({d // 100 for d in days}))
    segments = analytics.segment_summary(sets.account_months(active, facts.read_numbers(spark, root)), accounts, customers)
    stamp = F.lit(this.as_of).alias("last_updated")
    for name, df, part in (
        ("daily_branch_metrics", daily, "date_id"),
        ("fraud_summary", frauds, "date_id"),
        ("customer_segment_summary", segments, "month_id"),
    ):
        lake.write_files(df.select("*", stamp), f"{root}/analytics/{name}", partition_by=(part,))
    # partition values alone: no column of the table is read
    day = F.make_date("year", "month", "day")
    bounds = fact.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day")).where("first_day is not null")
    state.publish(warehouse.dim_date(bounds), root, "dim_date", this.run_id)
