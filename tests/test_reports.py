"""Marts, serving, monitoring, observatory, portfolio, correlation, sentiment, audit, storage, versions."""

import math

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark import schema
from tidemark.functions import lookup_join
from tidemark.operators import audit, correlation as corr, dedup, mapping, marts, monitoring as mon
from tidemark.operators import observatory as obs, portfolio as pf, retention as ret, sentiment as sent
from tidemark.operators import serve, versions as ver
from tidemark.plans import jobs
from tidemark.sources import landed

NOW = "2026-06-09 12:00:00"
PRICE = "crypto_id string, price_usd double, change_24h_pct double, event_timestamp string"


def stamped(spark, data, ddl, *times):
    df = spark.createDataFrame(list(data), ddl)
    return df.withColumns({t: F.col(t).cast("timestamp") for t in times})


def prices(spark, *data):
    return stamped(spark, data, PRICE, "event_timestamp")


def alerts(spark, *data):
    ddl = "crypto_id string, alert_type string, message string, price_usd double, created_at string"
    return stamped(spark, data, ddl, "created_at")


# ---- marts -------------------------------------------------------------------------
@pytest.fixture()
def two_by_three(spark):
    p = prices(spark, ("a", 1.0, 1.0, "2026-06-09 01:00:00"), ("a", 3.0, 2.0, "2026-06-09 02:00:00"), ("b", 5.0, None, "2026-06-09 02:00:00"))
    a = alerts(spark, *[("a", "PUMP", "m", 1.0, f"2026-06-09 0{h}:30:00") for h in (1, 2, 3)])
    return p, a


def test_daily_mart_counts(two_by_three):
    p, a = two_by_three
    fields = ("crypto_id", "avg_price", "total_volume", "alert_count")
    assert rows(marts.daily_mart(p, a), *fields) == [("a", 2.0, 6, 6), ("b", 5.0, 1, 0)]
    assert rows(marts.daily_mart_exact(p, a), *fields) == [("a", 2.0, 2, 3), ("b", 5.0, 1, 0)]


def test_daily_facts(two_by_three):
    p, a = two_by_three
    daily = marts.fct_daily(p).filter("crypto_id = 'a'").first()
    assert (daily.price_volatility, daily.event_count, daily.avg_change_24h) == (2.0, 2, 1.5)
    fact = marts.fct_alerts(a).first()
    assert (fact.total_alerts, fact.pump_count, fact.dump_count, fact.alert_rate) == (3, 3, 0, 0.125)


def test_severity(spark):
    a = alerts(spark, ("a", "PUMP", "", 1.0, NOW), ("a", "DUMP", "", 1.0, NOW), ("a", "X", "", 1.0, NOW), ("a", None, "", 1.0, NOW))
    got = {r.alert_type: r.severity for r in marts.stg_alerts(a).collect()}
    assert got == {"PUMP": "HIGH", "DUMP": "HIGH", "X": "MEDIUM", None: "MEDIUM"}


def test_upsert_last_load_wins(spark):
    old = spark.createDataFrame([("a", 1, 10), ("b", 1, 20)], "crypto_id string, d int, v int")
    new = spark.createDataFrame([("a", 1, 11), ("c", 1, 30)], "crypto_id string, d int, v int")
    assert rows(dedup.upsert(old, new, ["crypto_id", "d"])) == [("a", 1, 11), ("b", 1, 20), ("c", 1, 30)]


def test_insert_if_absent(spark):
    ddl = "crypto_id string, t string, v int"
    target = spark.createDataFrame([("a", "1", 0)], ddl)
    incoming = spark.createDataFrame(
        [("a", "1", 9, 1), ("b", "1", 5, 2), ("b", "1", 4, 1), ("c", None, 7, 1), ("c", None, 8, 2)], ddl + ", n int"
    )
    done = dedup.insert_if_absent(target, incoming, ["crypto_id", "t"], "n")
    assert rows(done) == sorted([("a", "1", 0), ("b", "1", 4), ("c", None, 7), ("c", None, 8)], key=str)
    assert dedup.new_rows(incoming.limit(0), target, ["crypto_id", "t"], "n").count() == 0


def test_prepare_prices_fallbacks(spark):
    df = spark.createDataFrame([("a", None, "2026-06-09 10:00:00", None)], "crypto_id string, event_timestamp timestamp, timestamp string, source string")
    row = dedup.prepare_prices(df).first()
    assert row.source == "coingecko" and str(row.event_timestamp) == "2026-06-09 10:00:00"


def test_sync_alerts_keeps_each_row_once(spark):
    a = alerts(spark, ("a", "PUMP", "m", 1.0, NOW))
    assert dedup.sync_alerts(a, a).count() == 1


# ---- serving -------------------------------------------------------------------------
def test_serving(spark):
    p = prices(
        spark, ("a", 1.0, 1.0, "2026-06-09 11:30:00"), ("a", 2.0, -1.0, "2026-06-09 11:40:00"),
        ("b", 0.5, None, "2026-06-01 00:00:00"),
    ).withColumns({"market_cap_usd": F.lit(1.0), "source": F.lit("s")})
    assets = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C")], "crypto_id string, symbol string")
    assert [r.price_usd for r in serve.prices_recent(p, "a", NOW).collect()] == [2.0, 1.0]
    assert serve.prices_recent(p, "zzz", NOW).count() == 0
    assert rows(serve.dashboard_latest(assets, p), "crypto_id", "price_usd") == [("a", 2.0), ("b", 0.5), ("c", None)]
    assert rows(serve.kpi_row(assets, p)) == sorted(
        [("A", "$2.00", "-1.00%"), ("B", "$0.5000", "+0.00%"), ("C", "N/A", None)], key=str)
    assert rows(serve.price_comparison(p, assets, ["a", "c"])) == [("A", 2.0)]
    none = alerts(spark, ("b", "PUMP", "old", 1.0, "2026-06-01 00:00:00"))
    summary = serve.asset_summary(assets, p, none, serve.windows_since(p, "1 minute", NOW, 1), NOW)
    got = {r.crypto_id: r for r in summary.collect()}
    assert got["a"].avg_price == 2.0 and got["a"].alert_type is None and got["b"].avg_price is None
    assert got["c"].price_usd is None
    assert [r.price_usd for r in serve.last_n_prices(p, 1).collect()] == [2.0, 0.5]


def test_window_since_equals_filtered_full_windows(spark):
    p = prices(spark, *[("a", float(i), 1.0, f"2026-06-09 {i % 12:02d}:{i % 60:02d}:00") for i in range(200)])
    full = landed.since(marts.window_agg(p, "1 hour"), "window_start", "2026-06-09 12:30:00", 5)
    part = serve.windows_since(p, "1 hour", "2026-06-09 12:30:00", 5)
    assert rows(part) == rows(full) and full.count() > 0


# ---- sources -------------------------------------------------------------------------
def test_quotes_and_history(spark):
    body = '{"bitcoin": {"usd": 1.5, "usd_24h_change": 2.0}, "other": {"usd": 1}, "ethereum": {"usd": 3}}'
    df = spark.createDataFrame([(body, NOW)], "body string, fetched_at string")
    out = landed.flatten_quotes(df)
    assert rows(out, "crypto_id", "price_usd", "market_cap_usd", "change_24h_pct") == [("bitcoin", 1.5, None, 2.0), ("ethereum", 3.0, None, None)]
    h = spark.createDataFrame([("bitcoin", '{"prices": [[1704067200000, 42000.5]]}')], "crypto_id string, body string")
    row = landed.backfill_events(h).first()
    assert str(row.event_timestamp) == "2024-01-01 00:00:00" and row.price_usd == 42000.5
    assert row.market_cap_usd is None and row.change_24h_pct is None and row.source == "coingecko_historical"


def test_headlines_and_equality_filters(spark):
    df = spark.createDataFrame([("a", "x"), ("a", ""), ("a", None)], "crypto_id string, headline string")
    assert landed.headlines_with_title(df).count() == 1
    assert landed.where_equal(df, headline="x", crypto_id=None).count() == 1


def test_backfill(spark):
    for days in (0, 366):
        with pytest.raises(ValueError):
            mon.check_backfill(days, None, schema.TRACKED_IDS)
    with pytest.raises(ValueError):
        mon.check_backfill(30, "fake", schema.TRACKED_IDS)
    assert mon.check_backfill(1, "bitcoin", schema.TRACKED_IDS) == ["bitcoin"]
    h = spark.createDataFrame(
        [("bitcoin", '{"prices": [[1704067200000, 1.0], [1704067260000, 2.0]]}'), ("ethereum", '{"prices": [[1704067200000, 3.0]]}')],
        "crypto_id string, body string")
    stored = landed.backfill_events(h.limit(1)).limit(1)
    run = lambda **kw: jobs.backfill(h, stored, "2024-01-02 00:00:00", **kw)
    assert rows(run()["summary"]) == [("TOTAL", 3, 3, 2), ("bitcoin", 2, 2, 1), ("ethereum", 1, 1, 1)]
    assert rows(run(lake_only=True)["summary"])[0] == ("TOTAL", 3, 3, 0)
    only_table = run(table_only=True)
    assert rows(only_table["summary"])[0] == ("TOTAL", 3, 0, 2) and only_table["raw"].count() == 0
    assert rows(run(dry_run=True, asset="ethereum")["plan"]) == [("ethereum", 1, True, True)]
    assert rows(mon.backfill_summary(stored.limit(0), stored.limit(0))) == [("TOTAL", 0, 0, 0)]


# ---- steps, service levels, quality -----------------------------------------------------
def metrics(spark, *data):
    return stamped(spark, data, "step string, status string, duration_seconds double, recorded_at string", "recorded_at")


def test_step_stats(spark):
    m = metrics(spark, *[("consume", "success", 0.1, NOW)] * 8, *[("consume", "failure", 0.5, NOW)] * 2, *[("alert", "success", float(d), NOW) for d in (1, 2, 3)])
    got = {r.step: r for r in mon.step_stats(m).collect()}
    assert len(got) == 6 and got["consume"].success_rate_pct == 80.0 and got["alert"].avg_duration_seconds == 2.0
    assert (got["s3"].total_events, got["s3"].success_rate_pct, got["s3"].max_duration_seconds) == (0, 0.0, 0.0)
    hourly = mon.hourly_report(m, "2026-06-09", "2026-06-09")
    assert hourly.count() == 144 and hourly.filter("hour = 12 and step = 'consume'").first().total_events == 10
    daily = {r.step: r for r in mon.daily_report(m).collect()}
    assert daily["ALL"].total_events == 13 and daily["ALL"].slowest_step == "alert"
    nulls = metrics(spark, ("consume", "success", None, NOW), ("consume", "success", 1.0, NOW))
    assert mon.step_stats(nulls).filter("step = 'consume'").first().avg_duration_seconds == 0.5


def test_slowest_step_tie_takes_the_earlier_step(spark):
    m = metrics(spark, ("alert", "success", 1.0, NOW), ("validate", "success", 1.0, NOW))
    assert mon.daily_report(m).first().slowest_step == "validate"


def test_sla(spark):
    ddl = "sla_id string, actual_seconds double, recorded_at string"
    data = [("S001", 60.0, NOW)] * 8 + [("S001", 61.0, NOW)] * 2 + [("S999", 1.0, NOW)]
    recorded = mon.sla_record(stamped(spark, data, ddl, "recorded_at"))
    unknown = recorded.filter("not known").first()
    assert unknown.max_seconds == 0 and not unknown.met
    got = {r.sla_id: r for r in mon.sla_compliance(recorded).collect()}
    assert len(got) == 6 and got["S001"].compliance_pct == 80.0 and got["S002"].compliance_pct == 100.0
    assert mon.sla_overall(mon.sla_compliance(recorded)).first()[0] == 96.7
    assert mon.sla_overall(mon.sla_compliance(recorded.limit(0))).first()[0] == 100.0


def scores(spark, values, name="quality_score_pct"):
    return spark.createDataFrame(
        [(f"2026-06-{9 - i:02d}", float(v)) for i, v in enumerate(values)], f"date string, {name} double"
    ).withColumn("date", F.col("date").cast("date"))


def test_quality_trend(spark):
    down = [95, 90, 85, 80, 75, 70, 65]
    trend = lambda v: tuple(mon.quality_trend(scores(spark, v), "2026-06-09").first())
    assert trend(down)[0] == "improving" and trend(down[::-1])[0] == "declining"
    assert trend([90, 88]) == ("stable", 89.0, 2) and trend([50]) == ("stable", 50.0, 1) and trend([1] * 7) == ("stable", 1.0, 7)
    assert tuple(mon.quality_trend(scores(spark, [1]).limit(0), "2026-06-09").first()) == ("stable", 0.0, 0)


def test_health_trend(spark):
    trend = lambda v: tuple(mon.health_trend(scores(spark, v, "overall_score"), "2026-06-09").first())
    assert trend([80, 75, 70]) == ("stable", 75.0, 3)
    assert trend([90, 90, 90, 10, 10, 10])[0] == "improving" and trend([10] * 3 + [90] * 3)[0] == "degrading"
    assert tuple(mon.health_trend(scores(spark, [1], "overall_score").limit(0), "2026-06-09").first()) == ("unknown", 0.0, 0)


def test_quality_reports(spark):
    counters = spark.createDataFrame([("2026-06-09", 3, 10, 7)], "date string, hour int, total_events bigint, valid_events bigint").withColumn("date", F.col("date").cast("date"))
    hourly = mon.quality_hourly(counters, "2026-06-08", "2026-06-09")
    assert hourly.count() == 48
    daily = {str(r.date): r for r in mon.quality_daily(hourly).collect()}
    assert daily["2026-06-08"].quality_score_pct == 100.0 and daily["2026-06-09"].quality_score_pct == 70.0
    flags = mon.quality_alert(scores(spark, [70, 80, 90]))
    assert [r.alert for r in flags.orderBy(F.desc("date")).collect()] == [
        "Quality alert: score 70.0% is below threshold 80.0%", None, None]


def test_lag_throughput_resources(spark):
    c = spark.createDataFrame([(1000, 990), (1000, 700), (1000, 900), (0, 0)], "produced bigint, consumed bigint")
    assert rows(mon.consumer_lag(c), "lag", "lag_pct", "status") == [(0, 0.0, "healthy"), (10, 1.0, "healthy"), (100, 10.0, "warning"), (300, 30.0, "critical")]
    t = mon.throughput(spark.createDataFrame([(100.0, 10.0)], "messages_per_second double, avg_message_size_kb double")).first()
    assert (t.mb_per_second, t.gb_per_day) == (0.9766, 82.4)
    s = spark.createDataFrame([(80.0, 85.0, 90.0), (95.0, 50.0, 95.0), (None, None, None)], "cpu_percent double, memory_percent double, disk_percent double")
    got = [(r.healthy, len(r.warnings)) for r in mon.resource_flags(s).collect()]
    assert got == [(True, 0), (False, 2), (True, 0)]


# ---- observatory ------------------------------------------------------------------------
def test_freshness(spark):
    assets = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "crypto_id string")
    p = prices(spark, ("a", 1.0, None, "2026-06-09 11:30:00"), ("b", 1.0, None, "2026-06-09 07:00:00"), ("d", 1.0, None, "2026-06-09 10:00:00"))
    assert rows(obs.freshness(assets, p, NOW)) == [("a", 0.5, True), ("b", 5.0, False), ("c", 999.0, False), ("d", 2.0, False)]


def test_completeness(spark):
    assets = spark.createDataFrame([("a",), ("b",)], "crypto_id string")
    present = spark.createDataFrame([("a", "2026-06-09", d) for d in ("raw", "aggregations", "monitoring", "raw")], "crypto_id string, date string, dataset string").withColumn("date", F.col("date").cast("date"))
    got = {r.crypto_id: r for r in obs.completeness(assets, present, "2026-06-09", "2026-06-09").collect()}
    assert got["a"].completeness_pct == 60.0 and got["a"].missing == ["sentiment", "technical"]
    assert got["b"].completeness_pct == 0.0 and len(got["b"].missing) == 5


def test_anomalies(spark):
    flat = [("a", 100.0, None, NOW)] * 20 + [("a", 10000.0, None, NOW)]
    p = prices(spark, *flat, ("b", 1.0, None, NOW), ("b", 99.0, None, NOW), *[("c", 5.0, None, NOW)] * 5)
    got = {r.crypto_id: (r.anomaly_count, r.anomaly_pct) for r in obs.price_anomalies(p).collect()}
    assert got == {"a": (1, 4.76), "b": (0, 0.0), "c": (0, 0.0)}


def observed(spark, fresh, complete, odd, hours=0.5, missing=()):
    df = spark.createDataFrame([("a", hours, fresh, complete, list(missing), 0, odd)], "crypto_id string, hours_since_update double, is_fresh boolean, completeness_pct double, missing array<string>, anomaly_count bigint, anomaly_pct double")
    return df.withColumn("score", obs.observatory_score())


@pytest.mark.parametrize("fresh, complete, odd, score", [(True, 100.0, 0.0, 100.0), (False, 80.0, 0.0, 52.0), (True, 100.0, 5.0, 90.0), (False, None, None, 10.0)])
def test_score(spark, fresh, complete, odd, score):
    assert observed(spark, fresh, complete, odd).first().score == score


@pytest.mark.parametrize("score, grade, status", [(95, "A", "HEALTHY"), (90, "A", "HEALTHY"), (80, "B", "HEALTHY"), (75, "B", "HEALTHY"), (65, "C", "DEGRADED"), (60, "C", "DEGRADED"), (50, "D", "DEGRADED"), (45, "D", "CRITICAL"), (30, "F", "CRITICAL"), (0, "F", "CRITICAL")])
def test_grades(spark, score, grade, status):
    row = spark.range(1).select(obs.grade(F.lit(float(score))).alias("g"), obs.status(F.lit(float(score))).alias("s")).first()
    assert (row.g, row.s) == (grade, status)


def test_health(spark):
    good = observed(spark, True, 100.0, 0.0)
    assert rows(obs.health_report(good)) == [("OVERALL", 100.0, "A", "HEALTHY"), ("a", 100.0, "A", "HEALTHY")]
    assert [r.recommendation for r in obs.health_recommendations(good).collect()] == ["All systems healthy — no action required"]
    bad = observed(spark, False, 60.0, 7.5, 5.04, ("x", "y"))
    assert sorted(r.recommendation for r in obs.health_recommendations(bad).collect()) == [
        "a: 2 S3 paths missing — check data pipeline", "a: 7.5% price anomalies — validate source data",
        "a: data is 5.0h old — check ingestion pipeline"]


# ---- portfolio, correlation, sentiment -------------------------------------------------------
def test_portfolio(spark):
    held = spark.createDataFrame([("bitcoin", 0.5), ("ethereum", 0.3), ("solana", 0.2)], "crypto_id string, allocation double")
    now = spark.createDataFrame([("bitcoin", 110.0), ("ethereum", 90.0)], "crypto_id string, price_usd double")
    before = spark.createDataFrame([("bitcoin", 100.0), ("ethereum", 100.0), ("solana", 0.0)], "crypto_id string, price_usd double")
    value = pf.portfolio_value(held, now)
    assert {(r.total_value, r.top_holding) for r in value.collect()} == {(10000.0, "bitcoin")}
    assert rows(value, "crypto_id", "weight_pct", "current_price") == [("bitcoin", 50.0, 110.0), ("ethereum", 30.0, 90.0), ("solana", 20.0, None)]
    got = {r.crypto_id: r.return_pct for r in pf.portfolio_returns(held, now, before).collect()}
    assert got == {"bitcoin": 10.0, "ethereum": -10.0, "solana": 0.0, "TOTAL": pytest.approx(2.0, abs=1e-4)}
    zero = spark.createDataFrame([("a", 0.0)], "crypto_id string, allocation double")
    assert pf.portfolio_value(zero, now).first().weight_pct == 0.0
    assert schema.portfolio_or_default(held.limit(0), spark).count() == 5


def test_price_24h_ago_bounds(spark):
    p = prices(spark, ("a", 1.0, None, "2026-06-08 11:00:00"), ("a", 2.0, None, "2026-06-08 13:00:00"), ("a", 3.0, None, "2026-06-08 13:00:01"), ("b", 4.0, None, "2026-06-08 10:59:59"))
    assert rows(pf.price_24h_ago(p, NOW), "crypto_id", "price_usd") == [("a", 2.0)]
    run = jobs.portfolio_run(p.filter("crypto_id = 'b'"), None, NOW)
    assert set(run) == {"value"}


def closes(spark, **series):
    data = [(k, v, None, f"2026-06-{i + 1:02d} 10:00:00") for k, vs in series.items() for i, v in enumerate(vs) if v is not None]
    return corr.daily_closes(prices(spark, *data), list(series), NOW)


def test_correlation_and_beta(spark):
    c = closes(spark, a=[1.0, 2.0, 3.0, 5.0], b=[2.0, 4.0, 6.0, 10.0], c=[4.0, 3.0, 2.0, 1.0])
    matrix = corr.price_matrix(c, ["a", "b", "c"], NOW, 10)
    assert matrix.count() == 10 and matrix.filter("a is null").count() == 6
    pairs = corr.correlation_pairs(matrix, ["a", "b", "c"])
    got = {(r.crypto1, r.crypto2): r.correlation for r in pairs.collect()}
    assert got[("a", "b")] == pytest.approx(1) and got[("a", "c")] < -0.9
    assert rows(corr.high_correlation(pairs)) == [("a", "b", 1.0)]
    ends = corr.correlation_extremes(pairs).first()
    assert ends.highest_pair == "a/b" and ends.lowest < -0.9
    betas = {r.crypto_id: r.beta for r in corr.beta(c, ["a", "b", "c", "none"], "a").collect()}
    assert betas["b"] == 1.0 and betas["none"] == 0.0 and betas["c"] != 0.0
    flat = closes(spark, a=[1.0, 1.0, 1.0], b=[1.0, 2.0, 3.0])
    assert corr.beta(flat, ["a", "b"], "a").first().beta == 0.0


def test_gap_gives_no_return(spark):
    c = closes(spark, a=[1.0, 2.0, None, 8.0, 16.0])
    assert [r.daily_return for r in corr.daily_returns(c).orderBy("date").collect()] == [1.0, 1.0]
    wide = corr.matrix_returns(corr.price_matrix(c, ["a"], NOW, 10), ["a"])
    assert [r.a for r in wide.filter("a is not null").orderBy("date").collect()] == [1.0, 1.0]


def test_every_pair_is_correlated(spark):
    c = closes(spark, a=[1.0, 2.0, 3.0], b=[1.0, 3.0, 2.0], c=[3.0, 1.0, 2.0])
    assert corr.correlation_pairs(corr.price_matrix(c, list("abc"), NOW, 10), list("abc")).count() == 3


def test_many_ids_give_all_pairs(spark):
    ids = [f"c{i:03d}" for i in range(40)]
    c = closes(spark, **{k: [1.0, 2.0 + i, 3.0 + i * i] for i, k in enumerate(ids)})
    assert corr.correlation_pairs(corr.price_matrix(c, ids, NOW, 10), ids).count() == 40 * 39 // 2


def test_sentiment(spark):
    lines = {
        "up": ["Bitcoin surges to new record high", "Bullish rally as prices gain"],
        "down": ["Market crash", "Prices drop after hack"],
        "mixed": ["Prices rise then fall", "Nothing to see", "record", "crash"],
    }
    df = spark.createDataFrame([(k, h) for k, hs in lines.items() for h in hs], "crypto_id string, headline string")
    scored = sent.sentiment(sent.headline_class(df))
    assert rows(scored, "crypto_id", "sentiment_score", "sentiment_label") == [("down", -100.0, "BEARISH"), ("mixed", 0.0, "NEUTRAL"), ("up", 100.0, "BULLISH")]
    assert rows(sent.sentiment_summary(scored)) == [("BEARISH", 1), ("BULLISH", 1), ("NEUTRAL", 1)]
    assert rows(sent.sentiment_summary(scored.limit(0))) == [("BEARISH", 0), ("BULLISH", 0), ("NEUTRAL", 0)]
    supply = spark.createDataFrame([("a", "the supply")], "crypto_id string, headline string")
    assert sent.headline_class(supply).first().sentiment == "positive"
    assert sent.headline_class(supply, word_bounds=True).first().sentiment == "neutral"


# ---- audit, storage, versions -------------------------------------------------------------------
def test_audit(spark):
    data = [("insert", "r1", "me", NOW), ("insert", "r2", "me", NOW), ("delete", "r1", "me", NOW)]
    entries = audit.audit_entries(stamped(spark, data, "action string, resource string, actor string, timestamp string", "timestamp"))
    assert audit.audit_logs(entries, action="insert").count() == 2
    assert audit.audit_logs(entries, "2026-06-09", "insert", "r2").count() == 1
    assert audit.audit_logs(entries, "2026-06-10").count() == 0
    first = entries.first()
    assert len(first.audit_id) == 32 and first.details == {} and first.status == "success"
    assert rows(audit.audit_report(entries)) == [("action", "delete", 1), ("action", "insert", 2), ("resource", "r1", 2), ("resource", "r2", 1), ("total", "all", 3)]
    assert rows(audit.audit_report(entries.limit(0))) == [("total", "all", 0)]
    own = audit.ingestion_audit(prices(spark, ("bitcoin", 1.0, None, NOW)), "consume", "event_timestamp").first()
    assert (own.action, own.resource, own.actor) == ("consume", "bitcoin", "pipeline")


def objects(spark, *data):
    return stamped(spark, data, "prefix string, key string, size bigint, last_modified string", "last_modified")


def test_storage(spark):
    o = objects(spark, ("raw/", "raw/a", 1024 * 1024, "2020-01-01 00:00:00"), ("raw/", "raw/b", 2 * 1024 * 1024, NOW))
    assert rows(ret.storage_size(o)) == [("raw/", 3.0, 2)]
    assert rows(ret.cold_manifest(o, NOW)) == [("raw/a", 1024 * 1024, "COLD")]
    assert rows(ret.archive_candidates(o, NOW), "archive_key") == [("archive/a",)]
    edge = objects(spark, ("raw/", "raw/c", 1, "2026-06-02 12:00:00"))
    assert ret.archive_candidates(edge, NOW).count() == 0
    cost = ret.cost_report(o, NOW).first()
    assert cost.archival_candidates == 1 and cost.savings > 0
    empty = ret.cost_report(o.limit(0), NOW).first()
    assert (empty.total_objects, empty.total_size_mb, empty.savings) == (0, 0.0, 0.0)


def test_expiry(spark):
    e = ret.with_expiry(spark.range(1), NOW, 300)
    assert ret.ttl_live(e, "2026-06-09 12:05:00").count() == 1
    assert ret.ttl_live(e, "2026-06-09 12:05:01").count() == 0
    assert rows(ret.ttl_purge_count(e, "2026-06-09 12:05:01")) == [(1, 0)]


def test_partition_keys(spark):
    e = spark.createDataFrame([("a", "2026-06-09T10:00:00"), (None, None)], "crypto_id string, timestamp string")
    assert rows(ret.with_raw_keys(e, NOW), "date_path", "crypto_id") == [("2026/06/09", "a"), ("2026/06/09", "unknown")]


def test_versions(spark):
    data = prices(spark, ("bitcoin", 1.0, 1.0, "2026-06-09 01:00:00"), ("bitcoin", 1.0, 1.0, "2026-06-09 02:00:00"), ("bitcoin", 2.0, 1.0, "2026-06-09 03:00:00"))
    snaps = ver.snapshots(data, "consume", "event_timestamp", ["price_usd", "change_24h_pct"])
    ids = [r.version_id for r in snaps.orderBy("created_at").collect()]
    assert ids[0] == ids[1] != ids[2] and all(len(i) == 8 for i in ids)
    assert ver.list_versions(snaps, "bitcoin", "consume", "2026-06-09").count() == 3
    assert rows(ver.version_counts(snaps)) == [(3, 1)] and rows(ver.version_counts(snaps, "s3")) == [(0, 0)]
    assert ver.rollback_one(snaps, "bitcoin", "consume", ids[2], "2026-06-09").count() == 1
    assert ver.rollback_one(snaps, "bitcoin", "consume", "00000000", "2026-06-09").count() == 0
    preview = ver.rollback_preview(snaps, ver.first_versions(snaps)).first()
    assert (preview.current_version, preview.target_version, preview.versions_undone) == (ids[2], ids[0], 2)
    for bad in (("fake", "consume", "12345678"), ("bitcoin", "fake", "12345678"), ("bitcoin", "consume", "123")):
        with pytest.raises(ValueError):
            ver.check_rollback(*bad)


def test_map_events_keeps_failures(spark):
    def root(event: dict) -> dict:
        return {"n": event["n"], "root": math.sqrt(event["n"])}

    df = spark.createDataFrame([(4,), (-1,), (9,)], "n int")
    mapped = mapping.map_events(df, root, "n int, root double")
    assert rows(mapping.succeeded(mapped)) == [(4, 2.0), (9, 3.0)]
    bad = mapping.failed_letters(mapped).first()
    assert bad.event == '{"n":-1}' and bad.error.startswith("ValueError")


def test_lookup_join_has_a_way_beyond_the_bound(spark):
    big = spark.createDataFrame([(i % 3, i) for i in range(30)], "k int, v int")
    small = big.groupBy("k").agg(F.sum("v").alias("s"))
    few, many = lookup_join(big, small, ["k"]), lookup_join(big, small, ["k"], limit_bytes=1)
    assert rows(few) == rows(many)
    plan = few._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan and "broadcast" not in many._jdf.queryExecution().optimizedPlan().toString()


def test_tables(spark):
    for name in schema.TABLES:
        ddl = schema.create_table_sql(name)
        assert ddl.startswith(f"CREATE TABLE IF NOT EXISTS {name} (") and "USING parquet PARTITIONED BY" in ddl
    assert "price_usd decimal(20,8)" in schema.create_table_sql("crypto_prices")
    assert schema.assets(spark).count() == 5


def test_sessions_equal_those_of_spark(spark):
    """Also with events exactly the gap apart, on slot bounds, and of one instant."""
    df = spark.range(600).selectExpr(
        "if(id % 3 = 0, 'a', 'b') crypto_id",
        "timestamp_seconds(1700000000 + 60 * (pmod(hash(id), 2000) + if(id % 7 = 0, 5, 0))) event_timestamp",
        "cast(id as double) price_usd", "cast(null as double) change_24h_pct",
    )
    df = df.unionByName(spark.sql(
        "select 'a' crypto_id, t event_timestamp, 1.0D price_usd, 2.0D change_24h_pct "
        "from values (timestamp'2024-01-01 00:00:00'), (timestamp'2024-01-01 00:10:00'), (timestamp'2024-01-01 00:20:01'), "
        "(timestamp'2024-01-01 00:20:01'), (cast(null as timestamp)) as v(t)"
    ))
    for gap in ("10 minutes", "7 minutes", "1 hour"):
        got = marts.session_agg(df, gap).select("crypto_id", "session_start", "session_end", "record_count", "min_price", "max_price")
        own = df.filter("event_timestamp is not null").groupBy("crypto_id", F.session_window("event_timestamp", gap).alias("w"))
        want = own.agg(F.count(F.lit(1)), F.min("price_usd"), F.max("price_usd"))
        assert rows(got) == rows(want.select("crypto_id", "w.start", "w.end", *want.columns[2:]))
