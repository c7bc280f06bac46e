"""Threshold rules, time-window rules, scoring and alerts.

The window rules are evaluated on pre-aggregated points in time, never on the
transactions themselves:

1. transactions are counted per (account, instant, ...), with map-side combine;
2. the points of an account are cut into slices of its timeline, and the tail of
   a slice is repeated in the next one as far as the look-back needs it;
3. windows run per (account, slice) with running totals only, so their cost is
   linear in the number of points. A sliding frame would recompute each frame.
4. the few instants that raise a flag are joined back to the transactions.

So an account holding a third of all rows is spread over its slices, each bounded
by the number of distinct instants in it, and whole rows are shuffled only for
the join in step 4.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerbrook.functions import columns as fx
from ledgerbrook.operators.lookup import lookup
from ledgerbrook.settings import FraudSettings

RULES = (
    "HIGH_VELOCITY", "IMPOSSIBLE_LOCATION", "LARGE_TRANSACTION",
    "FAILED_THEN_SUCCESS", "UNUSUAL_FREQUENCY",
)
DEFAULTS = FraudSettings()


# ---- threshold rules ---------------------------------------------------------


def flag_high_amount(df: DataFrame, settings: FraudSettings = DEFAULTS) -> DataFrame:
    return df.withColumn("fraud_flag_high_amount", fx.holds(F.col("amount") > settings.high_amount))


def flag_risky_merchant(df: DataFrame, settings: FraudSettings = DEFAULTS) -> DataFrame:
    """The channel stands in for the merchant's risk; see `flag_risky_merchant_class`."""
    return df.withColumn("fraud_flag_risky_merchant", fx.holds(F.col("channel") == settings.risky_channel))


def flag_risky_merchant_class(df: DataFrame) -> DataFrame:
    """Flag by the merchant dimension's own risk class."""
    return df.withColumn("fraud_flag_risky_merchant", fx.holds(F.col("merchant_risk_category") == "HIGH"))


def apply_rules(df: DataFrame, settings: FraudSettings = DEFAULTS) -> DataFrame:
    return flag_risky_merchant(flag_high_amount(df, settings), settings)


def calculate_fraud_score(df: DataFrame, settings: FraudSettings = DEFAULTS) -> DataFrame:
    score = (
        F.when(F.col("fraud_flag_high_amount"), settings.high_amount_points).otherwise(0)
        + F.when(F.col("fraud_flag_risky_merchant"), settings.risky_channel_points).otherwise(0)
    )
    return df.withColumn("fraud_score", score).withColumn(
        "is_fraudulent", F.col("fraud_score") >= settings.fraudulent_from
    )


_TOTAL = "decimal(28,2)"


# ---- mergeable history ---------------------------------------------------------


def account_days(transactions: DataFrame) -> DataFrame:
    """What later days need to know of a day: per account its rows, and count, sum and first instant of its amounts."""
    known = F.col("amount").isNotNull()
    return (
        timed(transactions).withColumn("tx_date", F.to_date("transaction_timestamp"))
        .where(F.col("account_id").isNotNull() & F.col("tx_date").isNotNull())
        .groupBy("account_id", "tx_date")
        .agg(F.count("*").alias("day_count"), F.count_if(known).alias("n"),
             F.sum("amount").cast(_TOTAL).alias("total"), F.min(F.when(known, F.col("at"))).alias("first_at"))
    )


def merged_totals(parts: DataFrame, key: str) -> DataFrame:
    """Totals per key from totals of disjoint times: counts and sums add, the first instant is the earliest."""
    return parts.groupBy(key).agg(
        F.sum("n").alias("n"), F.sum("total").cast(_TOTAL).alias("total"), F.min("first_at").alias("first_at")
    )


@dataclass(frozen=True)
class History:
    """What rules need of the time before the day `since`, so that only rows from that day on are scored.

    `totals` are the merged totals per party_id of all earlier days, `days` the account_days from the frequency look-back
    before `since` on. The transactions that go with it reach back one day before `since`, which covers
    the look-backs in minutes.
    """

    since: dt.date
    totals: DataFrame
    days: DataFrame

# ---- window rules ------------------------------------------------------------


def timed(df: DataFrame) -> DataFrame:
    """Add `at`, the transaction time in microseconds."""
    return df.withColumn("at", fx.micros("transaction_timestamp"))


def _located(df: DataFrame) -> DataFrame:
    return df if "location" in df.columns else df.withColumn("location", F.lit(None).cast("string"))


def recent_activity(transactions: DataFrame, settings: FraudSettings = DEFAULTS) -> DataFrame:
    """What each (account, instant) saw in its look-backs.

    Columns: `recent_count` in the velocity window including the instant itself,
    `recent_failed` strictly before the instant, `city_changed` within the
    location window. One row per (account_id, at).

    Every point opens its count when it enters a look-back and closes it when it
    leaves, so a running total at an instant is the number inside the look-back.
    The frame of an instant holds two cities exactly when the latest change of
    city among the points so far lies inside it.
    """
    velocity = settings.velocity_minutes * fx.MINUTE
    failed = settings.failed_minutes * fx.MINUTE
    location = settings.location_minutes * fx.MINUTE
    longest = max(velocity, failed, location)
    width = settings.slice_minutes * fx.MINUTE if settings.slice_minutes else longest

    points = (
        timed(_located(transactions))
        .where(F.col("account_id").isNotNull() & F.col("at").isNotNull())
        .groupBy("account_id", "at", "location")
        .agg(F.count("*").alias("n"), F.count_if(F.col("status") == "FAILED").alias("n_failed"))
    )
    at = F.col("at")
    slices = F.sequence(fx.floor_to(at, width), fx.floor_to(at + longest, width), F.lit(width).cast("bigint"))
    sliced = points.withColumn("slice", F.explode(slices))

    zero, no_city = F.lit(0).cast("bigint"), F.lit(None).cast("string")

    def event(moment: Column, count: Column, failures: Column, city: Column, own: Column, real: bool) -> Column:
        return F.struct(
            moment.alias("at"), count.alias("count"), failures.alias("failures"),
            city.alias("city"), own.alias("own"), F.lit(real).alias("real"),
        )

    n, n_failed, never = F.col("n"), F.col("n_failed"), F.lit(False)
    events = F.array(
        event(at, n, zero, F.col("location"), at >= F.col("slice"), True),
        event(at + velocity + 1, -n, zero, no_city, never, False),
        event(at + 1, zero, n_failed, no_city, never, False),
        event(at + failed + 1, zero, -n_failed, no_city, never, False),
    )
    line = sliced.select("account_id", "slice", F.inline(events)).where(
        F.col("real") | ((F.col("at") < F.col("slice") + width) & ((F.col("count") != 0) | (F.col("failures") != 0)))
    )

    # The second window's order is a prefix of the first one's: one shuffle, one sort.
    timeline = Window.partitionBy("account_id", "slice").orderBy("at", "city")
    instant = (
        Window.partitionBy("account_id", "slice").orderBy("at")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before = F.last(F.when(F.col("city").isNotNull(), F.struct("at", "city")), ignorenulls=True).over(
        timeline.rowsBetween(Window.unboundedPreceding, -1)
    )
    seen = (
        line.withColumn("before", before)
        .withColumn("changed_at", F.when(F.col("city") != F.col("before.city"), F.col("before.at")))
        .withColumns({
            "recent_count": F.sum("count").over(instant),
            "recent_failed": F.sum("failures").over(instant),
            "last_change": F.max("changed_at").over(instant),
        })
        .where("own")
    )
    return seen.select(
        "account_id", "at", "recent_count", "recent_failed",
        fx.holds(F.col("last_change") >= F.col("at") - location).alias("city_changed"),
    ).distinct()


EARTH_KM = 6371.0


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance by the haversine formula; NULL where a coordinate is."""
    half = lambda a, b: F.pow(F.sin((F.radians(b) - F.radians(a)) / 2), F.lit(2))
    chord = half(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon1, lon2)
    return F.asin(F.sqrt(F.least(chord, F.lit(1.0)))) * (2 * EARTH_KM)


def far_apart(transactions: DataFrame, city_geo: DataFrame, settings: FraudSettings = DEFAULTS) -> DataFrame:
    """(account, instant) pairs whose location window holds two cities at least `location_km` apart.

    `city_geo` has city, lat and lon, one row per city; a city without coordinates is far from none. Of an account's slice the
    distinct cities are compared, never its points: every point then marks the timelines of the cities far from its own that
    the slice holds, and a running maximum gives each point the newest mark before it. So the cost grows with the points times the
    cities of a slice that are far from one another. A window is flagged where the newest such mark lies inside it.
    """
    location = settings.location_minutes * fx.MINUTE
    width = settings.slice_minutes * fx.MINUTE if settings.slice_minutes else location
    at = F.col("at")
    points = (
        timed(transactions).where(F.col("account_id").isNotNull() & at.isNotNull())
        .select("account_id", "at", F.col("location").alias("city")).distinct()
    )
    slices = F.sequence(fx.floor_to(at, width), fx.floor_to(at + location, width), F.lit(width).cast("bigint"))
    everywhere = points.withColumn("slice", F.explode(slices))
    sliced = everywhere.where("city is not null")
    key = ["account_id", "slice"]
    known = city_geo.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).select("city", "lat", "lon")
    held = lookup(sliced.select(*key, "city").distinct(), known, "city", "inner")
    other = held.select(*key, *[F.col(c).alias(f"other_{c}") for c in ("city", "lat", "lon")])
    apart = distance_km(F.col("lat"), F.col("lon"), F.col("other_lat"), F.col("other_lon")) >= settings.location_km
    far = held.join(other, key).where((F.col("city") != F.col("other_city")) & apart).select(*key, "other_city", "city")
    marks = sliced.withColumnRenamed("city", "other_city").join(far, [*key, "other_city"]).select(
        *key, "city", "at", F.col("at").alias("mark"), F.lit(False).alias("real"))
    seen = sliced.join(far.select(*key, "city").distinct(), [*key, "city"], "left_semi").select(
        *key, "city", "at", F.lit(None).cast("bigint").alias("mark"), F.lit(True).alias("real"))
    timeline = Window.partitionBy(*key, "city").orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    changes = seen.unionByName(marks).withColumn("changed_at", F.max("mark").over(timeline)).where("real and changed_at is not null")
    latest = changes.groupBy(*key, "at").agg(F.max("changed_at").alias("changed_at"))
    # points of other or unknown cities lie in the same windows: they join the timeline of their slice
    instants = everywhere.select(*key, "at").distinct().withColumn("changed_at", F.lit(None).cast("bigint"))
    hits = latest.select(*key).distinct()
    line = latest.unionByName(lookup(instants, hits, key, "left_semi"))
    whole = Window.partitionBy(*key).orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    flagged = line.withColumn("last_change", F.max("changed_at").over(whole))
    return flagged.where((at >= F.col("slice")) & (F.col("last_change") >= at - location)).select("account_id", "at").distinct()


def history_before(transactions: DataFrame, party: str, carried: DataFrame | None = None) -> DataFrame:
    """Totals of each (party, instant) over strictly earlier instants; `carried` are those before all transactions given.

    Columns: `at`, `largest` (largest amount at the instant), `prior_count`,
    `prior_amount`, `first_at`. Running totals are carried from days to hours to instants: each level
    starts from one row that holds the totals before it, so no window holds more than the instants of one hour, the
    hours of one day or the days of one party, and nothing is joined back.
    """
    points = (
        timed(transactions)
        .where(F.col(party).isNotNull() & F.col("at").isNotNull() & F.col("amount").isNotNull())
        .groupBy(party, "at")
        .agg(F.count("*").alias("n"), F.sum("amount").cast(_TOTAL).alias("total"), F.max("amount").alias("largest"))
        .select(party, fx.floor_to(F.col("at"), fx.DAY).alias("day"), fx.floor_to(F.col("at"), 60 * fx.MINUTE).alias("hour"),
                "at", "n", "total", F.col("at").alias("first"), "largest")
    )

    def gathered(rows: DataFrame, *keys: str) -> DataFrame:
        return rows.groupBy(party, *keys).agg(
            F.sum("n").alias("n"), F.sum("total").cast(_TOTAL).alias("total"), F.min("first").alias("first"))

    def before(rows: DataFrame, part: list[str], order: str, start: DataFrame | None = None, place: Column | None = None) -> DataFrame:
        """Totals before each row of a part, `start` giving those before its first row."""
        rows = rows.withColumn("real", F.lit(True))
        if start is not None:
            at = F.col(part[-1]) - 1 if place is None else place
            first = start.select(*part, at.alias(order), F.col("prior_count").alias("n"),
                                 F.col("prior_amount").alias("total"), F.col("first_at").alias("first"), F.lit(False).alias("real"))
            rows = rows.unionByName(first, allowMissingColumns=True)
        earlier = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumns({
            "prior_count": F.coalesce(F.sum("n").over(earlier), F.lit(0)),
            "prior_amount": F.coalesce(F.sum("total").over(earlier), F.lit(0)).cast(_TOTAL),
            "first_at": F.min("first").over(earlier),
        }).where("real")

    hours = gathered(points, "day", "hour")
    if carried is not None:
        carried = carried.select(party, F.col("n").alias("prior_count"), F.col("total").alias("prior_amount"), "first_at")
    days = before(gathered(hours, "day"), [party], "day", carried, F.lit(-(1 << 62)))
    hours = before(hours, [party, "day"], "hour", days)
    return before(points.drop("day"), [party, "hour"], "at", hours).select(
        party, "at", "largest", "prior_count", "prior_amount", "first_at")


def _is_large(amount: str, settings: FraudSettings) -> Column:
    # amount > multiplier * (sum / count), without the division
    return F.col(amount) * F.col("prior_count") > F.col("prior_amount") * settings.large_multiplier


def large_instants(transactions: DataFrame, settings: FraudSettings = DEFAULTS,
                   party: str = "account_id", carried: DataFrame | None = None) -> DataFrame:
    """Instants at which some amount exceeds the multiple of the party's earlier average."""
    old_enough = F.col("at") - F.col("first_at") >= settings.large_history_days * fx.DAY
    return (
        history_before(transactions, party, carried)
        .where((F.col("prior_count") > 0) & old_enough & _is_large("largest", settings))
        .select(party, "at", "prior_count", "prior_amount")
    )


def busy_days(transactions: DataFrame, settings: FraudSettings = DEFAULTS) -> DataFrame:
    """(account, day) pairs with more transactions than the multiple of the average
    over the active days among the days before."""
    return busy_among(
        transactions.withColumn("tx_date", F.to_date("transaction_timestamp"))
        .where(F.col("account_id").isNotNull() & F.col("tx_date").isNotNull())
        .groupBy("account_id", "tx_date").agg(F.count("*").alias("day_count")), settings
    )


def busy_among(per_day: DataFrame, settings: FraudSettings = DEFAULTS) -> DataFrame:
    """The same from counts per account and day."""
    before = Window.partitionBy("account_id").orderBy(F.unix_date("tx_date")).rangeBetween(
        -settings.frequency_days, -1
    )
    return (
        per_day
        .withColumn("active_days", F.count("*").over(before))
        .withColumn("days_total", F.sum("day_count").over(before))
        .where(F.col("day_count") * F.col("active_days") > F.col("days_total") * settings.frequency_multiplier)
    )


def party_of(transactions: DataFrame) -> DataFrame:
    """Add `party_id`: the customer, or the account where the customer is unknown."""
    if "party_id" in transactions.columns:
        return transactions
    customer = F.col("customer_id") if "customer_id" in transactions.columns else F.lit(None).cast("string")
    return transactions.withColumn("party_id", F.coalesce(customer, F.col("account_id")))


# ---- one rule at a time --------------------------------------------------------


def high_velocity(transactions: DataFrame, settings: FraudSettings = DEFAULTS) -> DataFrame:
    """Transactions reaching the count within the trailing window."""
    hits = recent_activity(transactions, settings).where(F.col("recent_count") >= settings.velocity_count)
    return lookup(timed(transactions), hits.select("account_id", "at", "recent_count"), ["account_id", "at"], "inner", keyed=False)


def impossible_location(transactions: DataFrame, settings: FraudSettings = DEFAULTS, city_geo: DataFrame | None = None) -> DataFrame:
    """Transactions whose trailing window holds two different cities, or with `city_geo` two that are `location_km` apart."""
    hits = recent_activity(transactions, settings).where("city_changed") if city_geo is None else far_apart(transactions, city_geo, settings)
    return lookup(timed(transactions), hits.select("account_id", "at"), ["account_id", "at"], "left_semi", keyed=False)


def failed_then_success(transactions: DataFrame, settings: FraudSettings = DEFAULTS) -> DataFrame:
    """Successful transactions after enough failed ones in the trailing window."""
    hits = recent_activity(transactions, settings).where(F.col("recent_failed") >= settings.failed_count)
    succeeded = timed(transactions).where(F.col("status") == "SUCCESS")
    return lookup(succeeded, hits.select("account_id", "at", "recent_failed"), ["account_id", "at"], "inner", keyed=False)


def large_transaction(transactions: DataFrame, settings: FraudSettings = DEFAULTS) -> DataFrame:
    """Transactions above the multiple of the party's earlier average."""
    tx = party_of(transactions)
    hits = large_instants(tx, settings, "party_id")
    return lookup(timed(tx), hits, ["party_id", "at"], "inner", keyed=False).where(_is_large("amount", settings))


def unusual_frequency(transactions: DataFrame, settings: FraudSettings = DEFAULTS) -> DataFrame:
    """Transactions on the unusually busy days of an account."""
    hits = busy_days(transactions, settings).select("account_id", "tx_date", "day_count")
    dated = transactions.withColumn("tx_date", F.to_date("transaction_timestamp"))
    return lookup(dated, hits, ["account_id", "tx_date"], "inner", keyed=False)


# ---- all rules, score, severity, alerts ----------------------------------------


def rule_flag(rule: str) -> str:
    return f"is_{rule.lower()}"


def evaluate_rules(transactions: DataFrame, settings: FraudSettings = DEFAULTS, history: History | None = None,
                   city_geo: DataFrame | None = None) -> DataFrame:
    """One boolean per window rule; every transaction stays, or those from `history.since` on.

    With `city_geo` the rule on locations asks for a distance (`far_apart`).
    """
    activity = recent_activity(transactions, settings)
    if city_geo is not None:
        apart = far_apart(transactions, city_geo, settings).withColumn("apart", F.lit(True))
        activity = activity.join(apart, ["account_id", "at"], "left").withColumn("city_changed", fx.holds(F.col("apart"))).drop("apart")
    activity = activity.where(
        (F.col("recent_count") >= settings.velocity_count)
        | (F.col("recent_failed") >= settings.failed_count)
        | F.col("city_changed")
    )
    tx = timed(party_of(transactions)).withColumn("tx_date", F.to_date("transaction_timestamp"))
    if history is None:
        large, busy = large_instants(tx, settings, "party_id"), busy_days(transactions, settings)
    else:
        tx = tx.where(F.col("tx_date") >= F.lit(history.since))
        large, busy = large_instants(tx, settings, "party_id", history.totals), busy_among(history.days, settings)
    busy = busy.select("account_id", "tx_date", "day_count")
    joined = lookup(tx, activity, ["account_id", "at"], keyed=False)
    joined = lookup(joined, large, ["party_id", "at"], keyed=False)
    joined = lookup(joined, busy, ["account_id", "tx_date"], keyed=False)
    flags = {
        "HIGH_VELOCITY": F.col("recent_count") >= settings.velocity_count,
        "IMPOSSIBLE_LOCATION": F.col("city_changed"),
        "LARGE_TRANSACTION": _is_large("amount", settings),
        "FAILED_THEN_SUCCESS": (F.col("recent_failed") >= settings.failed_count) & (F.col("status") == "SUCCESS"),
        "UNUSUAL_FREQUENCY": F.col("day_count").isNotNull(),
    }
    return joined.select(
        *transactions.columns, *[fx.holds(flag).alias(rule_flag(rule)) for rule, flag in flags.items()]
    )


def severity_of(score: Column) -> Column:
    return (
        F.when(score == 0, F.lit(None).cast("string"))
        .when(score < 40, "LOW").when(score < 60, "MEDIUM").when(score < 80, "HIGH")
        .otherwise("CRITICAL")
    )


def score_rules(flagged: DataFrame, settings: FraudSettings = DEFAULTS) -> DataFrame:
    """Weighted risk score up to 100, severity and the list of fired rules."""
    points = [F.when(F.col(rule_flag(r)), settings.weights[r]).otherwise(0) for r in RULES]
    names = fx.chosen([(F.col(rule_flag(r)), r) for r in RULES])
    total = points[0]
    for part in points[1:]:
        total = total + part
    return (
        flagged.withColumn("risk_score", F.least(total, F.lit(100)))
        .withColumn("severity", severity_of(F.col("risk_score")))
        .withColumn("fired_rules", names)
    )


def fired(scored: DataFrame) -> DataFrame:
    """One row per (transaction, fired rule)."""
    return scored.where("risk_score > 0").withColumn("rule", F.explode("fired_rules")).drop("fired_rules")


def prioritized(rows: DataFrame) -> DataFrame:
    """Add `alert_rank`: 1 + the number of alerts with a higher score.

    It comes from the alert counts per score, of which there are at most 101, so
    nothing is sorted globally.
    """
    per_score = rows.groupBy("risk_score").agg(F.count("*").alias("n"))
    higher = Window.partitionBy(F.lit(1)).orderBy(F.desc("risk_score")).rowsBetween(Window.unboundedPreceding, -1)
    ranks = per_score.select(
        "risk_score", (F.coalesce(F.sum("n").over(higher), F.lit(0)) + 1).alias("alert_rank")
    )
    return rows.join(F.broadcast(ranks), "risk_score")  # at most 101 rows


def alerts(scored: DataFrame) -> DataFrame:
    return prioritized(fired(scored))
