"""Composite jobs: each chains operators and returns its named frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, StringType, StructField, StructType

from tidemark import schema
from tidemark.operators import (
    alerts as al,
    audit,
    correlation as corr,
    deadletters as dl,
    dedup,
    indicators as ind,
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
from tidemark.session import pin
from tidemark.sinks.lake import Lake, stored_prices
from tidemark.sources import landed

Frames = dict[str, DataFrame]
PRICE_KEY = ["crypto_id", "event_timestamp"]


def _report(lake: Lake | None, frames: Frames, name: str, date: str, *which: str) -> Frames:
    """Store the named frames as reports. They are pinned: what is stored is what is returned, computed once."""
    if lake is None:
        return frames
    frames = {key: pin(df) if key in which else df for key, df in frames.items()}
    for key in which:
        lake.report(frames[key], f"{name}_{key}", date)
    return frames


def ingest(
    raw: DataFrame, stored: DataFrame, as_of: str, tracked: Sequence[str] = schema.TRACKED_IDS,
    threshold: float = 10.0,
) -> Frames:
    """Batch ingestion: new prices, alerts, dead letters and the totals of the run."""
    checked = val.validate_events(landed.with_event_time(landed.parse_events(raw)), tracked)
    valid, invalid = val.split(checked)
    keyed = valid.withColumn("_arrival", landed.arrival(valid))
    fresh = dedup.new_rows(keyed, stored, ["crypto_id", "event_timestamp"], "_arrival")
    return {
        "prices": fresh.drop("_arrival"),
        "alerts": al.price_alerts(valid, threshold),
        "dead_letters": dl.dead_letters(invalid, "validate", F.lit(as_of).cast("timestamp")),
        "summary": al.run_summary_text(val.run_summary(checked, threshold)),
    }


def backfill(
    payloads: DataFrame, stored: DataFrame | None, as_of: str, days: int = 30, asset: str | None = None,
    tracked: Sequence[str] = schema.TRACKED_IDS, lake_only: bool = False, table_only: bool = False,
    dry_run: bool = False, lake: Lake | None = None,
) -> Frames:
    """Historical load; the target flags are honoured and the counts are those of the data.

    With a lake the events are written: raw events below `raw`, new prices into `prices`, each key once, so a second
    run adds nothing. Prices already there are then those of the lake. Without one the frames are returned only.
    """
    ids = mon.check_backfill(days, asset, tracked)
    history = landed.backfill_events(payloads).filter(F.col("crypto_id").isin(ids))
    if dry_run:
        plan = mon.backfill_plan(history, as_of, days, tracked, asset, lake_only, table_only)
        return {"plan": plan}
    wanted = landed.since(history, "event_timestamp", as_of, days * 24)
    keyed = wanted.withColumns({"_arrival": landed.arrival(wanted), "date": F.to_date("event_timestamp")})
    known = lake.matching(keyed, "prices", PRICE_KEY) if lake is not None else stored
    fresh = dedup.new_rows(keyed, known, PRICE_KEY, "_arrival").drop("_arrival", "date")
    if lake is not None:
        # What is new is settled before it is written, and counted as such.
        wanted, fresh = pin(wanted), pin(fresh)
        keyed = wanted.withColumns({"_arrival": landed.arrival(wanted), "date": F.to_date("event_timestamp")})
        if not table_only:
            text = F.to_json(F.struct(*wanted.columns))
            lake.insert_if_absent(
                keyed.select(text.alias("raw"), *PRICE_KEY, "date", "_arrival"), "raw", PRICE_KEY, "_arrival"
            )
        if not lake_only:
            prices = stored_prices(keyed, F.lit(as_of).cast("timestamp"), "_arrival")
            lake.insert_if_absent(prices, "prices", PRICE_KEY, "_arrival")
    inserted = fresh.limit(0) if lake_only else fresh
    return {
        "raw": wanted.limit(0) if table_only else wanted,
        "prices": inserted,
        "summary": mon.backfill_summary(wanted, inserted, lake=not table_only),
    }


def warehouse_sync(
    prices: DataFrame, alerts: DataFrame, raw_prices: DataFrame | None, raw_alerts: DataFrame | None, as_of: str,
    lake: Lake | None = None,
) -> Frames:
    """Last 24 hours into the warehouse tables, then the daily mart of the touched days.

    Only the touched days of the warehouse take part in the anti-join and in the mart. With a lake new prices and
    alerts are stored in its warehouse datasets, and the mart is merged; a second run adds nothing.
    Warehouse tables given as None are those of the lake.
    """
    day = F.date_sub(F.to_date(F.lit(as_of)), 1)
    incoming = dedup.prepare_prices(landed.since(prices, "event_timestamp", as_of, 24))
    recent_alerts = landed.since(alerts, "created_at", as_of, 24)
    if raw_prices is None:
        raw_prices = _warehouse(lake, "warehouse_prices", incoming)
    if raw_alerts is None:
        raw_alerts = _warehouse(lake, "warehouse_alerts", recent_alerts)
    touched_prices = raw_prices.filter(F.to_date("event_timestamp") >= day)
    touched_alerts = raw_alerts.filter(F.to_date("created_at") >= day)
    keyed = incoming.withColumn("_arrival", landed.arrival(incoming))
    new_prices = dedup.new_rows(keyed, touched_prices, PRICE_KEY, "_arrival").drop("_arrival")
    all_alerts = dedup.sync_alerts(touched_alerts, recent_alerts)
    if lake is not None:
        new_prices, all_alerts = pin(new_prices), pin(all_alerts)
    mart = marts.daily_mart_exact(
        touched_prices.unionByName(new_prices.select(*touched_prices.columns)), all_alerts
    )
    if lake is not None:
        mart = pin(mart)
        dated = new_prices.withColumns({"date": F.to_date("event_timestamp"), "_arrival": F.lit(0)})
        lake.insert_if_absent(dated, "warehouse_prices", PRICE_KEY, "_arrival")
        # An alert has no key of its own: the whole row is one.
        row_id = F.sha2(F.to_json(F.struct(*all_alerts.columns)), 256)
        dated = all_alerts.withColumns({"row_id": row_id, "date": F.to_date("created_at"), "_arrival": F.lit(0)})
        lake.insert_if_absent(dated, "warehouse_alerts", ["row_id"], "_arrival")
        lake.upsert(mart, "daily_summary", ["crypto_id", "trade_date"])
    return {"prices": new_prices, "alerts": all_alerts, "mart": mart}


def _warehouse(lake: Lake, dataset: str, like: DataFrame) -> DataFrame:
    """A warehouse table of the lake in the columns of what is about to come in."""
    fields = [f for f in like.schema if f.name != "date"]
    found = lake.stored(dataset, StructType([*fields, StructField("date", DateType())]))
    return found.select(*[f.name for f in fields])


def build_marts(raw_prices: DataFrame, raw_alerts: DataFrame) -> Frames:
    """Staging views and marts, with the not-null checks of the staged prices."""
    spark = raw_prices.sparkSession
    frames = {
        "stg_prices": marts.stg_prices(raw_prices),
        "stg_alerts": marts.stg_alerts(raw_alerts),
        "fct_daily": marts.fct_daily(raw_prices),
        "fct_alerts": marts.fct_alerts(raw_alerts),
        "dim_assets": schema.assets(spark),
        "not_null_checks": val.not_null_checks(
            raw_prices, ["crypto_id", "price_usd", "event_timestamp"]
        ),
    }
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return frames


def technical_run(prices: DataFrame, date: str, last: int | None = 200, lake: Lake | None = None) -> Frames:
    """Indicators of every asset over its last prices (all of them with `last=None`)."""
    wanted = serve.last_n_prices(prices, last) if last else prices
    frames = {"indicators": ind.technical_analysis(ind.price_series(wanted))}
    return _report(lake, frames, "technical", date, "indicators")


def correlation_run(
    prices: DataFrame, ids: Sequence[str], as_of: str, proxy: str, days: int = 30, lake: Lake | None = None
) -> Frames:
    closes = pin(corr.daily_closes(prices, ids, as_of, days))
    pairs = pin(corr.correlation_pairs(corr.price_matrix(closes, ids, as_of, days), ids))
    frames = {
        "pairs": pairs.withColumn("correlation", F.round("correlation", 4)),
        "high": corr.high_correlation(pairs),
        "extremes": corr.correlation_extremes(pairs),
        "betas": corr.beta(closes, ids, proxy),
    }
    return _report(lake, frames, "correlation", as_of[:10], *frames)


def portfolio_run(
    prices: DataFrame, portfolio: DataFrame | None, as_of: str, lake: Lake | None = None
) -> Frames:
    """Value, and returns where prices of a day ago exist."""
    held = schema.portfolio_or_default(portfolio, prices.sparkSession)
    current, before = serve.latest_prices(prices), pf.price_24h_ago(prices, as_of)
    frames = {"value": pf.portfolio_value(held, current)}
    if not before.isEmpty():
        frames["returns"] = pf.portfolio_returns(held, current, before)
    return _report(lake, frames, "portfolio", as_of[:10], *frames)


def sentiment_run(headlines: DataFrame, date: str, lake: Lake | None = None) -> Frames:
    scored = sent.sentiment(sent.headline_class(landed.headlines_with_title(headlines)))
    frames = {"scores": scored, "summary": sent.sentiment_summary(scored)}
    return _report(lake, frames, "sentiment", date, *frames)


def alerting_run(prices: DataFrame, minutes: int = 30, lake: Lake | None = None) -> Frames:
    """Tiered alerts, suppression of repeats, and message texts of those not suppressed.

    The history is appended, never replaced.
    """
    fired = al.tiered_alerts(prices, keep=("price_usd", "change_24h_pct"))
    flagged = pin(al.suppress_alerts(fired, minutes))
    frames = {
        "alerts": flagged,
        "messages": al.alert_messages(flagged.filter(~F.col("suppressed"))),
        "statistics": al.alert_statistics(flagged),
    }
    if lake is not None:
        lake.write(flagged.withColumn("date", F.to_date("triggered_at")), "alert_history")
    return frames


def health_run(
    assets: DataFrame, prices: DataFrame, present: DataFrame, as_of: str, date: str, lake: Lake | None = None
) -> Frames:
    """Observatory checks and the health report over them."""
    checks = obs.price_checks(assets, prices, as_of)
    observed = pin(obs.observatory(checks, obs.completeness(assets, present, date, date), None, date))
    frames = {
        "observatory": observed,
        "report": obs.health_report(observed),
        "recommendations": obs.health_recommendations(observed),
    }
    return _report(lake, frames, "health", date, *frames)


def health_trend_run(lake: Lake, date: str, days: int = 7) -> Frames:
    """Trend of the overall health scores in the stored reports."""
    fields = StructType([StructField("crypto_id", StringType()), StructField("score", DoubleType())])
    reports = lake.report_history("health_report", date, days, fields)
    history = reports.filter("crypto_id = 'OVERALL'").withColumnRenamed("score", "overall_score")
    return {"trend": mon.health_trend(history, date, days)}


def quality_run(
    validated: DataFrame, time: str, first: str, last: str, lake: Lake | None = None
) -> Frames:
    hourly = pin(mon.quality_hourly(mon.validation_counters(validated, time), first, last))
    daily = pin(mon.quality_daily(hourly))
    frames = {
        "hourly": hourly,
        "daily": daily,
        "trend": mon.quality_trend(daily, last),
        "alert": mon.quality_alert(daily),
    }
    return _report(lake, frames, "quality", last, *frames)


def sla_run(metrics: DataFrame, date: str, lake: Lake | None = None) -> Frames:
    compliance = mon.sla_compliance(mon.sla_record(metrics))
    frames = {"compliance": compliance, "overall": mon.sla_overall(compliance)}
    return _report(lake, frames, "sla", date, *frames)


def step_run(metrics: DataFrame, first: str, last: str, lake: Lake | None = None) -> Frames:
    frames = {
        "hourly": mon.hourly_report(metrics, first, last),
        "daily": mon.daily_report(metrics),
    }
    return _report(lake, frames, "steps", last, *frames)


def cost_run(objects: DataFrame, as_of: str, days: int = 30, lake: Lake | None = None) -> Frames:
    frames = {
        "sizes": ret.storage_size(objects),
        "manifest": ret.cold_manifest(objects, as_of, days),
        "cost": ret.cost_report(objects, as_of, days),
    }
    return _report(lake, frames, "cost", as_of[:10], "sizes", "cost")


def resource_run(samples: DataFrame, date: str, lake: Lake | None = None) -> Frames:
    return _report(lake, {"flags": mon.resource_flags(samples)}, "resources", date, "flags")


def replay_run(
    letters: DataFrame, date: str, step: str | None = None, tracked: Sequence[str] = schema.TRACKED_IDS
) -> Frames:
    replayed = dl.replay(dl.dlq_scan(letters, date, step), tracked)
    return {"letters": replayed, "summary": dl.replay_summary(replayed)}


def version_run(snaps: DataFrame, date: str) -> Frames:
    that_day = snaps.filter(F.col("date") == F.lit(date).cast("date"))
    return {"counts": ver.version_counts(that_day)}


def audit_run(actions: DataFrame, date: str, lake: Lake | None = None) -> Frames:
    entries = audit.audit_entries(actions)
    frames = {"entries": entries, "report": audit.audit_report(audit.audit_logs(entries, date))}
    return _report(lake, frames, "audit", date, "report")
