"""Step statistics, service levels, quality reports, trends, throughput and lag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import count_where, share_pct, with_zero_rows
from tidemark.schema import PIPELINE_STEPS, sla_thresholds, steps
from tidemark.sources.landed import since


def day_spine(spark: SparkSession, first: str, last: str) -> DataFrame:
    """All days from first to last, both included."""
    a, b = F.lit(first).cast("date"), F.lit(last).cast("date")
    return spark.range(1).select(F.explode(F.sequence(a, b)).alias("date"))


def hour_spine(spark: SparkSession, first: str, last: str) -> DataFrame:
    return day_spine(spark, first, last).withColumn(
        "hour", F.explode(F.sequence(F.lit(0), F.lit(23)))
    )


# ---- step statistics ------------------------------------------------------------
_STATS = [
    "total_events",
    "success_count",
    "failure_count",
    "success_rate_pct",
    "avg_duration_seconds",
    "max_duration_seconds",
    "min_duration_seconds",
]


def _step_aggregates() -> list[Column]:
    ok = count_where(F.col("status") == "success")
    seconds = F.coalesce("duration_seconds", F.lit(0.0))
    return [
        F.count(F.lit(1)).alias("total_events"),
        ok.alias("success_count"),
        (F.count(F.lit(1)) - ok).alias("failure_count"),
        share_pct(ok, F.count(F.lit(1)), 2, 0.0).alias("success_rate_pct"),
        F.round(F.avg(seconds), 4).alias("avg_duration_seconds"),
        F.round(F.max(seconds), 4).alias("max_duration_seconds"),
        F.round(F.min(seconds), 4).alias("min_duration_seconds"),
    ]


def _zero_filled() -> list[Column]:
    return [F.coalesce(c, F.lit(0)).alias(c) for c in _STATS[:3]] + [
        F.coalesce(c, F.lit(0.0)).alias(c) for c in _STATS[3:]
    ]


def step_stats(metrics: DataFrame) -> DataFrame:
    """Statistics of the six steps; a step without metrics is all zeros."""
    stats = metrics.groupBy("step").agg(*_step_aggregates())
    spine = F.broadcast(steps(metrics.sparkSession).select("step"))
    return spine.join(stats, "step", "left").select("step", *_zero_filled())


def hourly_report(metrics: DataFrame, first: str, last: str) -> DataFrame:
    """Step statistics for every hour of the days and all six steps."""
    spark = metrics.sparkSession
    day = F.to_date("recorded_at")
    stats = (
        metrics.filter(day.between(F.lit(first).cast("date"), F.lit(last).cast("date")))
        .groupBy(day.alias("date"), F.hour("recorded_at").alias("hour"), "step")
        .agg(*_step_aggregates())
    )
    names = F.array(*[F.lit(r) for r in PIPELINE_STEPS])
    spine = hour_spine(spark, first, last).withColumn("step", F.explode(names))
    return spine.join(stats, ["date", "hour", "step"], "left").select(
        "date", "hour", "step", *_zero_filled()
    )


def daily_report(metrics: DataFrame) -> DataFrame:
    """Per day: statistics of each step and of all steps (`ALL`), and the slowest step.

    Grouping sets give both levels in one pass; the slowest step is the one with the largest
    rounded mean duration, the earlier step on a tie.
    """
    known = metrics.filter(F.col("step").isin(PIPELINE_STEPS))
    stats = (
        known.withColumn("date", F.to_date("recorded_at"))
        .groupingSets([[F.col("date"), F.col("step")], [F.col("date")]], "date", "step")
        .agg(*_step_aggregates())
    )
    ordered = stats.join(F.broadcast(steps(metrics.sparkSession)), "step", "left")
    per_day = Window.partitionBy("date")
    rank = F.struct(-F.col("avg_duration_seconds"), F.col("step_order"))
    slowest = F.min_by(F.col("step"), F.when(F.col("step").isNotNull(), rank)).over(per_day)
    return ordered.withColumn("slowest_step", slowest).select(
        "date", F.coalesce("step", F.lit("ALL")).alias("step"), *_STATS, "slowest_step"
    )


# ---- service levels --------------------------------------------------------------
def sla_record(metrics: DataFrame) -> DataFrame:
    """Measurement against its limit; an unknown level has limit 0."""
    limits = sla_thresholds(metrics.sparkSession).select("sla_id", "max_seconds", F.lit(True).alias("known"))
    limit = F.coalesce("max_seconds", F.lit(0))
    return metrics.join(F.broadcast(limits), "sla_id", "left").select(
        "sla_id",
        "actual_seconds",
        limit.alias("max_seconds"),
        (F.col("actual_seconds") <= limit).alias("met"),
        "recorded_at",
        F.coalesce("known", F.lit(False)).alias("known"),
    )


def sla_compliance(recorded: DataFrame) -> DataFrame:
    """Compliance of the six levels; 100 percent without measurements."""
    total, met = F.count(F.lit(1)), count_where(F.col("met"))
    stats = recorded.groupBy("sla_id").agg(total.alias("total"), met.alias("met"))
    spine = F.broadcast(sla_thresholds(recorded.sparkSession).select("sla_id", "name", "description"))
    filled = spine.join(stats, "sla_id", "left").withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in ("total", "met")}
    )
    return filled.select(
        "sla_id",
        "name",
        "description",
        "total",
        "met",
        (F.col("total") - F.col("met")).alias("breached"),
        share_pct(F.col("met"), F.col("total"), 1, 100.0).alias("compliance_pct"),
    )


def sla_overall(compliance: DataFrame) -> DataFrame:
    """Plain mean of the rounded percentages of the levels."""
    return compliance.agg(F.round(F.avg("compliance_pct"), 1).alias("overall_compliance_pct"))


# ---- quality ---------------------------------------------------------------------
def validation_counters(validated: DataFrame, time: str) -> DataFrame:
    """Events and valid events per day and hour."""
    return validated.groupBy(F.to_date(time).alias("date"), F.hour(time).alias("hour")).agg(
        F.count(F.lit(1)).alias("total_events"), count_where(F.col("valid")).alias("valid_events")
    )


def _quality(*keys: str) -> list:
    total, valid = F.col("total_events"), F.col("valid_events")
    return [
        *keys,
        "total_events",
        "valid_events",
        (total - valid).alias("invalid_events"),
        share_pct(valid, total, 1, 100.0).alias("quality_score_pct"),
    ]


def quality_hourly(counters: DataFrame, first: str, last: str) -> DataFrame:
    """Quality of all 24 hours of each day; 100 percent in an hour without events."""
    spine = hour_spine(counters.sparkSession, first, last)
    filled = spine.join(counters, ["date", "hour"], "left").withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in ("total_events", "valid_events")}
    )
    return filled.select(*_quality("date", "hour"))


def quality_daily(hourly: DataFrame) -> DataFrame:
    summed = hourly.groupBy("date").agg(
        F.sum("total_events").alias("total_events"), F.sum("valid_events").alias("valid_events")
    )
    return summed.select(*_quality("date"))


def quality_alert(daily: DataFrame, threshold: float = 80.0) -> DataFrame:
    score = F.col("quality_score_pct")
    text = F.format_string(
        "Quality alert: score %.1f%% is below threshold %.1f%%", score, F.lit(threshold)
    )
    return daily.withColumn("alert", F.when(score < threshold, text))


def score_trend(
    history: DataFrame,
    as_of_date: str,
    score: str,
    days: int,
    margin: float,
    falling: str,
    empty: str,
    digits: int,
) -> DataFrame:
    """Mean of the newest (up to) three daily scores against the oldest three.

    Only `days` rows take part, whatever the size of the data behind the history.
    """
    today = F.lit(as_of_date).cast("date")
    recent = history.filter((F.col("date") > F.date_sub(today, days)) & (F.col("date") <= today))
    one = F.lit(1)
    newest = F.row_number().over(Window.partitionBy(one).orderBy(F.desc("date")))
    oldest = F.row_number().over(Window.partitionBy(one).orderBy("date"))
    ranked = recent.select("date", F.col(score).alias("_s")).withColumns(
        {"_new": newest, "_old": oldest}
    )
    means = ranked.agg(
        F.count(one).alias("days"),
        F.avg("_s").alias("_avg"),
        F.avg(F.when(F.col("_new") <= 3, F.col("_s"))).alias("_recent"),
        F.avg(F.when(F.col("_old") <= 3, F.col("_s"))).alias("_older"),
    )
    new, old = F.col("_recent"), F.col("_older")
    trend = (
        F.when(F.col("days") == 0, empty)
        .when((F.col("days") >= 2) & (new > old + margin), "improving")
        .when((F.col("days") >= 2) & (new < old - margin), falling)
        .otherwise("stable")
    )
    return means.select(
        trend.alias("trend"), F.round(F.coalesce("_avg", F.lit(0.0)), digits).alias("avg_score"), "days"
    )


def quality_trend(daily: DataFrame, as_of_date: str, days: int = 7) -> DataFrame:
    return score_trend(daily, as_of_date, "quality_score_pct", days, 2.0, "declining", "stable", 1)


def health_trend(history: DataFrame, as_of_date: str, days: int = 7) -> DataFrame:
    return score_trend(history, as_of_date, "overall_score", days, 5.0, "degrading", "unknown", 2)


# ---- resources -------------------------------------------------------------------
def throughput(traffic: DataFrame) -> DataFrame:
    """MB per second and GB per day from `messages_per_second` and `avg_message_size_kb`."""
    mb = F.round(F.col("messages_per_second") * F.col("avg_message_size_kb") / 1024, 4)
    return traffic.withColumn("mb_per_second", mb).withColumn(
        "gb_per_day", F.round(F.col("mb_per_second") * 86400 / 1024, 2)
    )


def traffic(events: DataFrame, time: str, body: str) -> DataFrame:
    """Message rate and mean size per hour."""
    hour = F.date_trunc("HOUR", F.col(time)).cast(events.schema[time].dataType)
    return events.groupBy(hour.alias("hour")).agg(
        (F.count(F.lit(1)) / 3600.0).alias("messages_per_second"),
        (F.avg(F.octet_length(body)) / 1024.0).alias("avg_message_size_kb"),
    )


def consumer_lag(counts: DataFrame) -> DataFrame:
    """Lag and status from `produced` and `consumed`; the status looks at the rounded percent."""
    lag = F.col("produced") - F.col("consumed")
    pct = F.col("lag_pct")
    return counts.withColumns(
        {"lag": lag, "lag_pct": share_pct(lag, F.col("produced"), 1, 0.0)}
    ).withColumn(
        "status", F.when(pct < 5, "healthy").when(pct < 20, "warning").otherwise("critical")
    )


def resource_flags(samples: DataFrame) -> DataFrame:
    """Host samples with the warnings of the limits they pass."""
    limits = [("cpu_percent", "CPU", 80), ("memory_percent", "Memory", 85), ("disk_percent", "Disk", 90)]
    used = {c: F.coalesce(c, F.lit(0.0)) for c, _, _ in limits}
    warnings = F.array_compact(
        F.array(
            *[
                F.when(used[c] > limit, F.format_string(f"{name} usage high: %.1f%% (threshold {limit}%%)", used[c]))
                for c, name, limit in limits
            ]
        )
    )
    return samples.withColumn("warnings", warnings).withColumn("healthy", F.size("warnings") == 0)


# ---- backfill --------------------------------------------------------------------
def check_backfill(days: int, asset: str | None, tracked) -> list[str]:
    """Assets of a backfill request, or an error for a bad one."""
    if not 1 <= days <= 365:
        raise ValueError(f"days must be between 1 and 365, got {days}")
    if asset is not None and asset not in tracked:
        raise ValueError(f"unknown asset {asset!r}")
    return [asset] if asset else list(tracked)


def backfill_plan(
    events: DataFrame, as_of, days: int, tracked, asset: str | None = None,
    lake_only: bool = False, table_only: bool = False,
) -> DataFrame:
    """Dry run: the events each asset would load and the targets that are on."""
    ids = check_backfill(days, asset, tracked)
    wanted = since(events, "event_timestamp", as_of, days * 24).filter(F.col("crypto_id").isin(ids))
    return wanted.groupBy("crypto_id").agg(F.count(F.lit(1)).alias("planned_events")).withColumns(
        {"to_lake": F.lit(not table_only), "to_table": F.lit(not lake_only)}
    )


def backfill_summary(events: DataFrame, inserted: DataFrame, lake: bool = True) -> DataFrame:
    """True counts per asset and in total: events, saved to the lake, inserted into the table."""
    marked = events.select("crypto_id", F.lit(1).alias("_event"), F.lit(0).alias("_new")).unionByName(
        inserted.select("crypto_id", F.lit(0).alias("_event"), F.lit(1).alias("_new"))
    )
    counts = (
        marked.rollup("crypto_id")
        .agg(F.sum("_event").alias("total_events"), F.sum("_new").alias("saved_table"))
        .select(
            F.coalesce("crypto_id", F.lit("TOTAL")).alias("crypto_id"),
            "total_events",
            (F.col("total_events") if lake else F.lit(0)).alias("saved_lake"),
            "saved_table",
        )
    )
    zero = events.sparkSession.range(1).selectExpr(
        "'TOTAL' crypto_id", "0L total_events", "0L saved_lake", "0L saved_table"
    )
    return with_zero_rows(counts, zero, "crypto_id")
