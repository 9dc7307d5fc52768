"""The registered queries: each operator over the benchmark tables."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import (
    alerts as al,
    audit,
    correlation as corr,
    deadletters as dl,
    dedup,
    indicators as ind,
    mapping,
    marts,
    monitoring as mon,
    observatory as obs,
    portfolio as pf,
    retention as ret,
    sentiment as sent,
    serve,
    validation as val,
    versions as ver,
)
from tidemark.session import apply_settings
from tidemark.sources import adapters as src, landed

Query = Callable[[SparkSession, str], DataFrame]
IDS, AS_OF, DAYS = src.ASSET_IDS, src.AS_OF, src.DAYS
CATALOG: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the function's name, with a result any SQL client can compare."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        apply_settings(spark)
        return portable(fn(spark, folder))

    CATALOG[fn.__name__] = run
    return fn


def portable(df: DataFrame) -> DataFrame:
    """Dates as text, times without zone, decimals as doubles."""
    casts = {}
    for f in df.schema:
        if isinstance(f.dataType, T.DateType):
            casts[f.name] = F.col(f.name).cast("string")
        elif isinstance(f.dataType, T.TimestampType):
            casts[f.name] = F.col(f.name).cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DecimalType):
            casts[f.name] = F.col(f.name).cast("double")
    return df.withColumns(casts) if casts else df


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# ---- shared inputs --------------------------------------------------------------
def _prices(s, d):
    return src.prices(s, d)


def _stored(s, d):
    return src.prices(s, d).drop("event_id")


def _alerts(s, d):
    return al.price_alerts(src.prices(s, d))


def _tiered(s, d):
    keep = ("price_usd", "change_24h_pct")
    return al.tiered_alerts(src.prices(s, d), keep=keep)


def _events(s, d):
    return landed.parse_events(src.raw_json(s, d))


def _validated(s, d):
    return val.validate_events(_events(s, d), IDS)


def _letters(s, d):
    _, invalid = val.split(_validated(s, d))
    return dl.dead_letters(invalid, "validate", F.col("received_at"))


def _windows(s, d, size="1 hour"):
    return marts.window_agg(_prices(s, d), size)


def _counters(s, d):
    return mon.validation_counters(_validated(s, d), "received_at")


def _snapshots(s, d):
    return ver.snapshots(
        _prices(s, d), "consume", "event_timestamp", ["crypto_id", "price_usd", "change_24h_pct"]
    )


def _before(df, column, day):
    return df.filter(F.col(column) < F.lit(f"{day} 00:00:00").cast(df.schema[column].dataType))


# ---- sources ---------------------------------------------------------------------
@query
def parse_events(s, d):
    return _events(s, d).drop("raw", "received_at")


@query
def flatten_quotes(s, d):
    return landed.flatten_quotes(src.quote_payloads(s, d), IDS)


@query
def backfill_events(s, d):
    return landed.backfill_events(src.history_payloads(s, d))


@query
def backfill_plan(s, d):
    return mon.backfill_plan(_prices(s, d), AS_OF, 30, IDS)


@query
def recent_prices(s, d):
    return landed.recent_prices(_prices(s, d), AS_OF)


@query
def recent_alerts(s, d):
    return landed.recent_alerts(_alerts(s, d), AS_OF)


@query
def dlq_scan(s, d):
    return dl.dlq_scan(_letters(s, d), "2024-01-15", "validate").select(
        "crypto_id", "error", "step", "failed_at", "date"
    )


@query
def audit_logs(s, d):
    entries = audit.audit_entries(src.audit_actions(s, d))
    return audit.audit_logs(entries, action="click", resource="r1").drop("details")


@query
def price_matrix(s, d):
    closes = corr.daily_closes(_prices(s, d), IDS, AS_OF, DAYS)
    return corr.price_matrix(closes, IDS, AS_OF, DAYS)


@query
def last_n_prices(s, d):
    return serve.last_n_prices(_prices(s, d), 200)


@query
def dim_assets(s, d):
    return src.assets(s, d)


# ---- sinks -----------------------------------------------------------------------
@query
def raw_partition_keys(s, d):
    return ret.partition_counts(ret.with_raw_keys(_events(s, d), AS_OF))


@query
def agg_partition_keys(s, d):
    return ret.partition_counts(ret.with_aggregate_keys(_windows(s, d), AS_OF))


@query
def idempotent_insert(s, d):
    """Every event arrives twice with different prices; the first half month is stored already."""
    p = _prices(s, d).select("crypto_id", "event_timestamp", "price_usd")
    arrivals = p.withColumn("arrival", F.lit(2)).unionByName(
        p.withColumns({"price_usd": F.col("price_usd") + 1, "arrival": F.lit(1)})
    )
    stored = _before(p, "event_timestamp", "2024-01-16").withColumn(
        "price_usd", F.col("price_usd") + 5
    )
    done = dedup.insert_if_absent(stored, arrivals, ["crypto_id", "event_timestamp"], "arrival")
    return _rounded(done, "price_usd")


def _backfill_new(s, d):
    history = landed.backfill_events(src.history_payloads(s, d)).withColumn("arrival", F.lit(0))
    stored = _before(_stored(s, d), "event_timestamp", "2024-01-16").withColumn(
        "event_timestamp", F.date_trunc("MILLISECOND", "event_timestamp")
    )
    return history, dedup.new_rows(history, stored, ["crypto_id", "event_timestamp"], "arrival")


@query
def backfill_insert_count(s, d):
    _, new = _backfill_new(s, d)
    return new.groupBy("crypto_id").agg(F.count(F.lit(1)).alias("inserted"))


@query
def backfill_summary(s, d):
    history, new = _backfill_new(s, d)
    return mon.backfill_summary(history, new)


@query
def sync_prices(s, d):
    p = _stored(s, d)
    incoming = dedup.prepare_prices(p.withColumn("source", F.lit(None).cast("string")))
    incoming = incoming.withColumn("arrival", F.lit(0))
    target = _before(p, "event_timestamp", "2024-01-10")
    return dedup.insert_if_absent(target, incoming, ["crypto_id", "event_timestamp"], "arrival")


@query
def sync_alerts(s, d):
    a = _alerts(s, d)
    return dedup.sync_alerts(_before(a, "created_at", "2024-01-20"), a)


@query
def dlq_records(s, d):
    return _letters(s, d).select("crypto_id", "error", "step", "failed_at", "date")


@query
def sla_record(s, d):
    return mon.sla_record(src.sla_metrics(s, d))


@query
def audit_entries(s, d):
    return audit.audit_entries(src.audit_actions(s, d)).drop("details")


@query
def snapshot_write(s, d):
    return _snapshots(s, d)


@query
def archive_candidates(s, d):
    return ret.archive_candidates(src.objects(s, d), AS_OF)


@query
def cold_manifest(s, d):
    return ret.cold_manifest(src.objects(s, d), AS_OF, 20)


@query
def ttl_live(s, d):
    return ret.ttl_live(src.cache_entries(s, d), AS_OF).drop("data")


@query
def ttl_purge_count(s, d):
    return ret.ttl_purge_count(src.cache_entries(s, d), AS_OF)


# ---- projections, filters, checks --------------------------------------------------
@query
def validate_events(s, d):
    return (
        _validated(s, d)
        .withColumn("errors", F.array_join("errors", " | "))
        .select("event_id", "valid", *val.EVENT_CHECKS, "errors")
    )


@query
def validate_aggregates(s, d):
    """Hourly windows, with faulty bounds where the count is a multiple of 3 or 7."""
    n = F.col("record_count")
    faulty = _windows(s, d).withColumns(
        {
            "min_price": F.when(n % 3 == 0, F.col("max_price") + 1).otherwise(F.col("min_price")),
            "window_end": F.when(n % 7 == 0, F.col("window_start")).otherwise(F.col("window_end")),
        }
    )
    return val.validate_aggregates(faulty).select(
        "crypto_id", "window_start", *val.AGGREGATE_CHECKS, "valid", F.size("errors").alias("error_count")
    )


@query
def price_alerts(s, d):
    return _alerts(s, d)


@query
def tiered_alerts(s, d):
    return _tiered(s, d).drop("price_usd", "change_24h_pct")


@query
def derived_metrics(s, d):
    m = al.derived_metrics(_prices(s, d))
    return _rounded(
        m.select("crypto_id", "event_timestamp", "price_vs_sma", "volume_ratio"),
        "price_vs_sma",
        "volume_ratio",
    )


@query
def tiered_alerts_derived(s, d):
    """All six rules, with the two derived metrics present."""
    fired = al.tiered_alerts(al.derived_metrics(_prices(s, d)))
    return fired.groupBy("crypto_id", "rule_id", "severity").agg(F.count(F.lit(1)).alias("alerts"))


@query
def stg_alerts(s, d):
    return marts.stg_alerts(_alerts(s, d))


@query
def alert_messages(s, d):
    return al.alert_messages(_tiered(s, d)).select("rule_id", "crypto_id", "triggered_at", "color", "message")


@query
def price_alert_texts(s, d):
    texts = al.price_alert_texts(al.price_alerts(_prices(s, d), keep=["change_24h_pct"]))
    return texts.select("crypto_id", "created_at", "text", "color")


@query
def prices_recent(s, d):
    return serve.prices_recent(_prices(s, d), "click", AS_OF)


@query
def alerts_recent(s, d):
    return serve.alerts_recent(_alerts(s, d), "click", AS_OF)


@query
def aggs_recent(s, d):
    recent = serve.windows_since(_prices(s, d), "1 hour", AS_OF, 24)
    return _rounded(serve.aggs_recent(recent, "click", AS_OF, 24), "avg_price")


@query
def dash_prices(s, d):
    return serve.dash_prices(_prices(s, d), AS_OF)


@query
def dash_alerts(s, d):
    return serve.dash_alerts(_alerts(s, d), AS_OF)


@query
def dash_aggs(s, d):
    recent = serve.windows_since(_prices(s, d), "1 hour", AS_OF, 24)
    return _rounded(serve.dash_aggs(recent, AS_OF, 24), "avg_price", "price_range")


@query
def resource_flags(s, d):
    flagged = mon.resource_flags(src.host_samples(s, d))
    return flagged.select("sample_id", "healthy", F.array_join("warnings", " | ").alias("warnings"))


@query
def consumer_lag(s, d):
    counts = _validated(s, d).groupBy(F.to_date("received_at").alias("date")).agg(
        F.count(F.lit(1)).alias("produced"), F.count_if("valid").alias("consumed")
    )
    return mon.consumer_lag(counts)


@query
def headline_class(s, d):
    return sent.headline_class(src.headlines(s, d)).drop("headline")


@query
def stg_prices(s, d):
    return _rounded(marts.stg_prices(_stored(s, d)), "price_change_usd")


@query
def not_null_checks(s, d):
    return val.not_null_checks(_events(s, d), ["crypto_id", "price_usd", "timestamp"])


@query
def price_history(s, d):
    return serve.price_history(_prices(s, d), "view")


@query
def price_comparison(s, d):
    return serve.price_comparison(_prices(s, d), src.assets(s, d), ["click", "view", "purchase"])


@query
def kpi_row(s, d):
    return serve.kpi_row(src.assets(s, d), _prices(s, d))


# ---- marts and windows ---------------------------------------------------------------
@query
def window_agg(s, d):
    return _rounded(_windows(s, d), "avg_price", "price_range", "avg_change_24h")


@query
def window_agg_minute(s, d):
    return _rounded(_windows(s, d, "1 minute"), "avg_price", "price_range", "avg_change_24h")


@query
def window_sessions(s, d):
    return _rounded(marts.session_agg(_prices(s, d), "30 minutes"), "avg_price", "avg_change_24h")


@query
def window_agg_sliding(s, d):
    sliding = marts.window_agg(_prices(s, d), "2 hours", "1 hour")
    return _rounded(sliding, "avg_price", "price_range", "avg_change_24h")


@query
def window_ohlc(s, d):
    return marts.window_ohlc(_prices(s, d), "1 hour")


@query
def fct_daily(s, d):
    return _rounded(marts.fct_daily(_prices(s, d)), "avg_price", "price_volatility", "avg_change_24h")


@query
def fct_daily_items(s, d):
    """Daily facts over the largest table, with as many assets as there are parts."""
    facts = marts.fct_daily(src.item_prices(s, d))
    return _rounded(facts, "avg_price", "price_volatility", "avg_change_24h")


@query
def fct_alerts(s, d):
    return _rounded(marts.fct_alerts(marts.stg_alerts(_alerts(s, d))), "alert_rate")


@query
def daily_mart(s, d):
    return _rounded(marts.daily_mart(_prices(s, d), _alerts(s, d)), "avg_price")


@query
def daily_mart_exact(s, d):
    return _rounded(marts.daily_mart_exact(_prices(s, d), _alerts(s, d)), "avg_price")


@query
def daily_mart_upsert(s, d):
    """A mart of the first twenty days, refreshed with the later events from the tenth on."""
    p, a = _prices(s, d), _alerts(s, d)
    old = marts.daily_mart_exact(_before(p, "event_timestamp", "2024-01-21"), a).withColumn(
        "total_volume", F.lit(-1).cast("bigint")
    )
    late = F.lit("2024-01-10 00:00:00").cast(p.schema["event_timestamp"].dataType)
    new = marts.daily_mart_exact(p.filter(F.col("event_timestamp") >= late), a)
    return _rounded(dedup.upsert(old, new, ["crypto_id", "trade_date"]), "avg_price")


@query
def latest_prices(s, d):
    return serve.latest_prices(_prices(s, d))


@query
def asset_summary(s, d):
    p = _prices(s, d)
    recent = serve.windows_since(p, "1 hour", AS_OF, 1)
    out = serve.asset_summary(src.assets(s, d), p, al.price_alerts(p), recent, AS_OF)
    return _rounded(out, "avg_price")


@query
def dashboard_latest(s, d):
    return serve.dashboard_latest(src.assets(s, d), _prices(s, d))


# ---- alert reports ----------------------------------------------------------------------
@query
def suppress_alerts(s, d):
    return al.suppress_alerts(_tiered(s, d), 30).select(
        "rule_id", "crypto_id", "triggered_at", "suppressed"
    )


@query
def alerts_by_hour(s, d):
    return al.alerts_by_hour(_tiered(s, d))


@query
def peak_hour(s, d):
    return al.peak_hour(al.alerts_by_hour(_tiered(s, d)))


@query
def alert_patterns(s, d):
    return al.alert_patterns(_tiered(s, d), AS_OF, DAYS)


@query
def alert_statistics(s, d):
    return al.alert_statistics(_tiered(s, d))


@query
def alert_digest(s, d):
    return al.alert_digest(_tiered(s, d))


# ---- quality, steps, service levels -------------------------------------------------------
@query
def step_stats(s, d):
    return mon.step_stats(src.step_metrics(s, d))


@query
def hourly_report(s, d):
    return mon.hourly_report(src.step_metrics(s, d), *src.day_bounds(s, d))


@query
def daily_report(s, d):
    return mon.daily_report(src.step_metrics(s, d))


@query
def sla_compliance(s, d):
    return mon.sla_compliance(mon.sla_record(src.sla_metrics(s, d)))


@query
def sla_overall(s, d):
    return mon.sla_overall(mon.sla_compliance(mon.sla_record(src.sla_metrics(s, d))))


@query
def quality_hourly(s, d):
    return mon.quality_hourly(_counters(s, d), *src.day_bounds(s, d))


@query
def quality_daily(s, d):
    return mon.quality_daily(mon.quality_hourly(_counters(s, d), *src.day_bounds(s, d)))


@query
def quality_alert(s, d):
    daily = mon.quality_daily(mon.quality_hourly(_counters(s, d), *src.day_bounds(s, d)))
    return mon.quality_alert(daily, 50.0).select("date", "quality_score_pct", "alert")


@query
def quality_trend(s, d):
    daily = mon.quality_daily(mon.quality_hourly(_counters(s, d), *src.day_bounds(s, d)))
    return mon.quality_trend(daily, src.day_bounds(s, d)[1], 7)


@query
def stream_quality(s, d):
    return val.stream_quality(_validated(s, d))


@query
def validation_summary(s, d):
    return val.validation_summary(_validated(s, d))


@query
def validation_errors(s, d):
    return val.validation_errors(_validated(s, d), "event_id")


@query
def error_counts(s, d):
    return val.error_counts(_validated(s, d))


@query
def run_summary(s, d):
    return val.run_summary(_validated(s, d))


@query
def dlq_replay(s, d):
    """Every event as a dead letter of one of the five event steps or an unknown one."""
    names = F.array(*[F.lit(x) for x in ("validate", "postgres", "s3", "alert", "other")])
    step = F.element_at(names, (F.col("event_id") % 5 + 1).cast("int"))
    letters = dl.dead_letters(_events(s, d), step, F.col("received_at"), error=F.lit("failed"))
    return dl.replay_summary(dl.replay(letters, IDS), "step", "outcome")


@query
def throughput(s, d):
    rates = mon.throughput(mon.traffic(src.table(s, d, "events"), "ts", "props"))
    return _rounded(rates, "messages_per_second", "avg_message_size_kb")


# ---- sentiment, portfolio ------------------------------------------------------------------
def _sentiment(s, d):
    lines = landed.headlines_with_title(src.headlines(s, d))
    return sent.sentiment(sent.headline_class(lines))


@query
def sentiment(s, d):
    return _sentiment(s, d)


@query
def sentiment_summary(s, d):
    return sent.sentiment_summary(_sentiment(s, d))


@query
def portfolio_value(s, d):
    return pf.portfolio_value(src.portfolio(s), serve.latest_prices(_prices(s, d)))


@query
def portfolio_market_value(s, d):
    return pf.portfolio_market_value(src.portfolio(s), _prices(s, d))


@query
def price_24h_ago(s, d):
    return pf.price_24h_ago(_prices(s, d), AS_OF)


@query
def portfolio_returns(s, d):
    p = _prices(s, d)
    out = pf.portfolio_returns(src.portfolio(s), serve.latest_prices(p), pf.price_24h_ago(p, AS_OF))
    return _rounded(out, "allocation")


# ---- observatory ------------------------------------------------------------------------------
def _present(s, d):
    """Partitions that exist: one pass over the prices tells those of three datasets."""
    days = _prices(s, d).groupBy("crypto_id", F.to_date("event_timestamp").alias("date")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    # An hourly window lies on the day of its events, so a day with prices has aggregates.
    names = F.array_compact(
        F.array(F.lit("raw"), F.lit("aggregations"), F.when(F.col("_n") >= 70, F.lit("technical")))
    )
    failures = src.step_metrics(s, d).filter("status = 'failure' and step = 'alert'")
    return days.select("crypto_id", "date", F.explode(names).alias("dataset")).unionByName(
        obs.partitions_of(failures, "recorded_at", "monitoring")
    )


def _completeness(s, d):
    return obs.completeness(src.assets(s, d), _present(s, d), *src.day_bounds(s, d))


def _observatory(s, d):
    checks = obs.price_checks(src.assets(s, d), _prices(s, d), AS_OF)
    last = src.day_bounds(s, d)[1]
    complete = obs.completeness(src.assets(s, d), _present(s, d), last, last)
    return obs.observatory(checks, complete, None, last)


@query
def freshness(s, d):
    return obs.freshness(src.assets(s, d), _prices(s, d), AS_OF)


@query
def completeness(s, d):
    return _completeness(s, d).withColumn("missing", F.array_join("missing", ","))


@query
def price_anomalies(s, d):
    return obs.price_anomalies(_prices(s, d))


@query
def price_anomalies_orders(s, d):
    return obs.price_anomalies(src.order_prices(s, d))


@query
def observatory(s, d):
    return _observatory(s, d).withColumn("missing", F.array_join("missing", ","))


@query
def health_report(s, d):
    return obs.health_report(_observatory(s, d))


@query
def health_recommendations(s, d):
    return obs.health_recommendations(_observatory(s, d))


@query
def health_trend(s, d):
    """Daily success rates as the score history."""
    daily = mon.daily_report(src.step_metrics(s, d)).filter("step = 'ALL'")
    history = daily.select("date", F.col("success_rate_pct").alias("overall_score"))
    return mon.health_trend(history, src.day_bounds(s, d)[1], 7)


# ---- correlation -------------------------------------------------------------------------------
def _closes(s, d):
    return corr.daily_closes(_prices(s, d), IDS, AS_OF, DAYS)


def _pairs(s, d):
    return corr.correlation_pairs(corr.price_matrix(_closes(s, d), IDS, AS_OF, DAYS), IDS)


@query
def correlation_pairs(s, d):
    return _rounded(_pairs(s, d), "correlation")


@query
def correlation_pairs_returns(s, d):
    matrix = corr.price_matrix(_closes(s, d), IDS, AS_OF, DAYS)
    return _rounded(corr.correlation_pairs(corr.matrix_returns(matrix, IDS), IDS), "correlation")


@query
def high_correlation(s, d):
    return corr.high_correlation(_pairs(s, d), 0.05)


@query
def correlation_extremes(s, d):
    return _rounded(corr.correlation_extremes(_pairs(s, d)), "lowest", "highest")


@query
def beta(s, d):
    return corr.beta(_closes(s, d), IDS, "click")


# ---- indicators -----------------------------------------------------------------------------------
@query
def sma(s, d):
    return ind.sma(ind.price_series(_prices(s, d)))


@query
def bollinger(s, d):
    return ind.bollinger(ind.price_series(_prices(s, d)))


@query
def rsi(s, d):
    return ind.rsi(ind.price_series(_prices(s, d)))


@query
def macd(s, d):
    return ind.macd(ind.price_series(_prices(s, d)))


@query
def technical_analysis(s, d):
    return ind.technical_analysis(ind.price_series(_prices(s, d)))


# ---- audit, storage, versions -----------------------------------------------------------------------
@query
def audit_report(s, d):
    return audit.audit_report(audit.audit_entries(src.audit_actions(s, d)))


@query
def storage_size(s, d):
    return ret.storage_size(src.objects(s, d))


@query
def cost_report(s, d):
    return ret.cost_report(src.objects(s, d), AS_OF, 20)


@query
def daily_counts(s, d):
    return ret.daily_counts(_prices(s, d), _alerts(s, d), _windows(s, d))


@query
def version_ids(s, d):
    return _snapshots(s, d).select("crypto_id", "date", "version_id")


@query
def list_versions(s, d):
    return ver.list_versions(_snapshots(s, d), "click", "consume", "2024-01-15")


@query
def version_counts(s, d):
    return ver.version_counts(_snapshots(s, d))


@query
def rollback(s, d):
    snaps = _snapshots(s, d)
    return ver.rollback(snaps, ver.first_versions(snaps))


@query
def rollback_preview(s, d):
    snaps = _snapshots(s, d)
    return ver.rollback_preview(snaps, ver.first_versions(snaps))


@query
def map_events(s, d):
    """A user function that fails on events without change; failing events are left out."""

    def price_per_change(event: dict) -> dict:
        return {
            "event_id": event["event_id"],
            "price_per_change": event["price_usd"] / int(event["change_24h_pct"]),
            "floor_price": math.floor(event["price_usd"]),
        }

    events = _prices(s, d).select("event_id", "price_usd", "change_24h_pct")
    mapped = mapping.map_events(
        events, price_per_change, "event_id bigint, price_per_change double, floor_price bigint"
    )
    return _rounded(mapping.succeeded(mapped), "price_per_change")
