"""Price alerts, tiered rules, suppression, statistics and message texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import at_time, clean_number, count_where, epoch_seconds, lookup_join, with_zero_rows, without_nan
from tidemark.operators.series import ROWS_PER_SEGMENT, rolling, segmented
from tidemark.schema import ALERT_RULES, SEVERITY_COLORS
from tidemark.session import pin

Rule = tuple[str, str, str, str, float, str]


def price_alerts(
    prices: DataFrame, threshold: float = 10.0, time: str = "event_timestamp", keep: Sequence[str] = ()
) -> DataFrame:
    """PUMP above the threshold, DUMP below its negative, both strict; no change, no alert."""
    prices = without_nan(prices, "change_24h_pct", "price_usd")
    change = F.col("change_24h_pct")
    kind = F.when(change > threshold, "PUMP").when(change < -threshold, "DUMP")
    way = F.when(F.col("alert_type") == "PUMP", "up").otherwise("down")
    return (
        prices.filter((change > threshold) | (change < -threshold))
        .withColumn("alert_type", kind)
        .select(
            F.coalesce("crypto_id", F.lit("unknown")).alias("crypto_id"),
            "alert_type",
            F.concat(F.lit("Price "), way, F.lit(f" more than {threshold}% in 24h")).alias("message"),
            F.coalesce("price_usd", F.lit(0.0)).alias("price_usd"),
            F.col(time).alias("created_at"),
            *keep,
        )
    )


def _fires(operator: str, value: Column, threshold: float) -> Column:
    return {
        ">": value > threshold,
        "<": value < threshold,
        ">=": value >= threshold,
        "<=": value <= threshold,
    }.get(operator, F.lit(False))


def tiered_alerts(
    events: DataFrame, rules: Sequence[Rule] = tuple(ALERT_RULES), time: str = "event_timestamp", keep: Sequence[str] = ()
) -> DataFrame:
    """One row per event and rule that fires. The rules become expressions: no join, no shuffle.

    A rule whose metric the events lack, or is null, or whose operator is unknown, never fires.
    """
    fired, fires = [], F.lit(False)
    for rule_id, name, metric, operator, threshold, severity in rules:
        if metric not in events.columns:
            continue
        value = clean_number(F.col(metric).cast("double"))
        alert = F.struct(
            F.lit(rule_id).alias("rule_id"),
            F.lit(name).alias("name"),
            F.lit(metric).alias("metric"),
            F.lit(operator).alias("operator"),
            F.lit(float(threshold)).alias("threshold"),
            F.lit(severity).alias("severity"),
            value.alias("triggered_value"),
        )
        hit = F.coalesce(_fires(operator, value, threshold) & ~F.isnan(value), F.lit(False))
        fired.append(F.when(hit, alert))
        fires = fires | hit
    if not fired:
        raise ValueError("no rule uses a column of the events")
    return (
        events.filter(fires)
        .withColumn("_alert", F.explode_outer(F.array_compact(F.array(*fired))))
        .select(
            *keep,
            "_alert.*",
            F.coalesce("crypto_id", F.lit("unknown")).alias("crypto_id"),
            F.col(time).alias("triggered_at"),
        )
    )


def derived_metrics(
    prices: DataFrame, window: int = 20, hours: int = 24, rows_per_segment: int = ROWS_PER_SEGMENT
) -> DataFrame:
    """The two metrics the volume and trend rules need.

    price_vs_sma: distance to the moving average in percent. volume_ratio: events in the hour over
    the hourly mean of the `hours` before, empty hours counted; null when those had no event.
    """
    hour = F.date_trunc("HOUR", F.col("event_timestamp")).cast(prices.schema["event_timestamp"].dataType)
    hourly = prices.groupBy("crypto_id", hour.alias("_hour")).agg(F.count(F.lit(1)).alias("_events"))
    slot = F.floor(epoch_seconds("_hour") / 3600)
    before = Window.partitionBy("crypto_id").orderBy("_slot").rangeBetween(-hours, -1)
    volume = (
        hourly.withColumn("_slot", slot)
        .withColumn("volume_ratio", F.col("_events") / (F.sum("_events").over(before) / hours))
        .select("crypto_id", "_slot", "volume_ratio")
    )
    frame = {
        "_sma": lambda w: F.avg("price_usd").over(w.rowsBetween(-(window - 1), 0)),
        "_seen": lambda w: F.count("price_usd").over(w.rowsBetween(-(window - 1), 0)),
    }
    series = segmented(prices, ["crypto_id"], "event_timestamp", rows_per_segment)
    ratio = (F.col("price_usd") / F.when(F.col("_sma") != 0, F.col("_sma")) - 1) * 100
    rolled = (
        rolling(series, window - 1, frame)
        .withColumn("price_vs_sma", F.when(F.col("_seen") == window, ratio))
        .drop("_sma", "_seen")
        .withColumn("_slot", F.floor(epoch_seconds("event_timestamp") / 3600))
    )
    return lookup_join(rolled, volume, ["crypto_id", "_slot"]).drop("_slot")


def suppress_alerts(
    alerts: DataFrame, minutes: int = 30, rows_per_segment: int = ROWS_PER_SEGMENT
) -> DataFrame:
    """Mark alerts whose rule fired for the same asset less than `minutes` before.

    The alert before counts even when it was suppressed itself, so the previous one decides.
    """
    series = segmented(alerts, ["rule_id", "crypto_id"], "triggered_at", rows_per_segment)
    gap = epoch_seconds("triggered_at") - epoch_seconds("_previous")
    return (
        rolling(series, 1, {"_previous": lambda w: F.lag("triggered_at").over(w)})
        .withColumn("suppressed", F.coalesce(gap < minutes * 60, F.lit(False)))
        .drop("_previous")
    )


def alerts_by_hour(alerts: DataFrame, time: str = "triggered_at") -> DataFrame:
    """Alerts per hour of day; rows without a usable time are left out."""
    return (
        alerts.filter(F.col(time).isNotNull())
        .groupBy(F.date_format(time, "HH").alias("hour"))
        .agg(F.count(F.lit(1)).alias("alerts"))
    )


def _most(key: str, count: str = "alerts") -> Column:
    """Key with the largest count; the lower key wins a tie."""
    return F.min_by(F.col(key), F.struct(-F.col(count), F.col(key)))


def peak_hour(by_hour: DataFrame) -> DataFrame:
    return by_hour.agg(_most("hour").alias("peak_hour"), F.max("alerts").alias("alerts"))


def alert_patterns(alerts: DataFrame, as_of, days: int = 7, time: str = "triggered_at") -> DataFrame:
    """Counts by asset, by rule and by day of the last `days` days; `is_top` marks each maximum.

    One pass over the alerts with three grouping sets; days without alerts count 0. The counts
    are pinned, as the maxima are taken from them: one row per asset, rule and day.
    """
    today = F.to_date(F.lit(str(as_of)))
    first = F.date_sub(today, days - 1)
    day = F.to_date(time)
    recent = alerts.filter((day >= first) & (day <= today)).select(
        F.coalesce("crypto_id", F.lit("unknown")).alias("crypto"),
        F.coalesce("rule_id", F.lit("unknown")).alias("rule"),
        day.cast("string").alias("day"),
    )
    names = ["crypto", "rule", "day"]
    key, kind = F.coalesce(*names), F.lit(None).cast("string")
    for n in names:
        kind = F.when(F.col(n).isNotNull(), F.lit(n)).otherwise(kind)
    counts = (
        recent.groupingSets([[n] for n in map(F.col, names)], *names)
        .agg(F.count(F.lit(1)).alias("alerts"))
        .select(kind.alias("kind"), key.alias("key"), "alerts")
    )
    spine = alerts.sparkSession.range(days).select(
        F.lit("day").alias("kind"), F.date_sub(today, F.col("id").cast("int")).cast("string").alias("key"), F.lit(0).alias("alerts")
    )
    full = pin(with_zero_rows(counts, spine, "kind", "key"))
    top = full.groupBy("kind").agg(_most("key").alias("_top"))
    return full.join(F.broadcast(top), "kind").select(
        "kind", "key", "alerts", (F.col("key") == F.col("_top")).alias("is_top")
    )


def alert_statistics(alerts: DataFrame) -> DataFrame:
    """Total, by severity and by asset in one pass."""
    filled = alerts.select(
        F.coalesce("severity", F.lit("UNKNOWN")).alias("severity"),
        F.coalesce("crypto_id", F.lit("unknown")).alias("crypto_id"),
    )
    kind = (
        F.when(F.col("severity").isNotNull(), "severity")
        .when(F.col("crypto_id").isNotNull(), "crypto")
        .otherwise("total")
    )
    counts = (
        filled.groupingSets([[F.col("severity")], [F.col("crypto_id")], []], "severity", "crypto_id")
        .agg(F.count(F.lit(1)).alias("alerts"))
        .select(kind.alias("kind"), F.coalesce("severity", "crypto_id", F.lit("all")).alias("key"), "alerts")
    )
    zero = alerts.sparkSession.range(1).selectExpr("'total' kind", "'all' key", "0L alerts")
    return with_zero_rows(counts, zero, "kind", "key")


def alert_digest(alerts: DataFrame) -> DataFrame:
    return alerts.agg(
        F.count(F.lit(1)).alias("total"),
        count_where(F.col("severity") == "CRITICAL").alias("critical"),
        count_where(F.col("severity") == "HIGH").alias("high"),
    ).withColumn(
        "digest", F.format_string("Today: %d alerts (%d CRITICAL, %d HIGH)", "total", "critical", "high")
    )


def severity_color(severity: Column) -> Column:
    color = F.lit("good")
    for name, value in SEVERITY_COLORS.items():
        color = F.when(severity == name, F.lit(value)).otherwise(color)
    return color


def alert_messages(alerts: DataFrame) -> DataFrame:
    """Colour and text of tiered alerts; needs price and change next to the rule columns."""
    severity = F.coalesce("severity", F.lit("LOW"))
    text = F.format_string(
        "[%s] %s — %s | price=$%,.2f | change=%+.2f%%",
        severity,
        F.coalesce("name", F.lit("alert")),
        F.coalesce("crypto_id", F.lit("unknown")),
        F.coalesce("price_usd", F.lit(0.0)),
        F.coalesce("change_24h_pct", F.lit(0.0)),
    )
    return alerts.withColumns({"color": severity_color(severity), "message": text})


def price_alert_texts(alerts: DataFrame) -> DataFrame:
    """Notification text of PUMP and DUMP alerts; needs the change next to the alert columns."""
    change, price = F.col("change_24h_pct"), F.col("price_usd")
    pump = F.format_string("🚀 PUMP ALERT: %s up %.2f%% — Current price: $%,.2f", "crypto_id", change, price)
    dump = F.format_string("📉 DUMP ALERT: %s down %.2f%% — Current price: $%,.2f", "crypto_id", F.abs(change), price)
    return alerts.withColumns(
        {"text": F.when(F.col("alert_type") == "PUMP", pump).otherwise(dump), "color": F.lit("danger")}
    )


def error_text(step: Column, error: Column) -> Column:
    return F.concat(F.lit("⚠️ Pipeline Error in "), step, F.lit(": "), error)


def run_summary_text(summary: DataFrame) -> DataFrame:
    """Daily summary text of `run_summary` totals."""
    text = F.format_string(
        "📊 Daily Summary:\n• Total events: %d\n• Valid events: %d (%.1f%%)\n"
        "• Alerts triggered: %d\n• Quality score: %.1f%%",
        "total_events", "valid_events", "quality_score", "alerts_triggered", "quality_score",
    )
    return summary.withColumn("text", text)


def alert_history(alerts: DataFrame, as_of, days: int, time: str = "triggered_at") -> DataFrame:
    """Alerts of the last `days` calendar days."""
    start = F.date_sub(F.to_date(F.lit(str(as_of))), days - 1)
    return alerts.filter((F.to_date(time) >= start) & (F.col(time) <= at_time(as_of, alerts, time)))
