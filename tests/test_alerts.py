import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import alerts as al

EVENT = "crypto_id string, price_usd double, change_24h_pct double, event_timestamp string"
ALERT = "rule_id string, crypto_id string, severity string, triggered_at string"


def events(spark, *data):
    df = spark.createDataFrame(list(data), EVENT)
    return df.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))


def fired(spark, *data):
    df = spark.createDataFrame(list(data), ALERT)
    return df.withColumn("triggered_at", F.col("triggered_at").cast("timestamp"))


@pytest.mark.parametrize("change, kind", [(15.0, "PUMP"), (-15.0, "DUMP"), (2.0, None), (10.0, None), (-10.0, None), (None, None)])
def test_price_alert(spark, change, kind):
    out = al.price_alerts(events(spark, ("bitcoin", 65000.0, change, "2026-06-09 10:00:00"))).collect()
    assert [r.alert_type for r in out] == ([kind] if kind else [])
    if kind:
        way = "up" if kind == "PUMP" else "down"
        assert out[0].message == f"Price {way} more than 10.0% in 24h"


def test_price_alert_defaults(spark):
    out = al.price_alerts(events(spark, (None, None, 50.0, "2026-06-09 10:00:00")), 20).first()
    assert out.crypto_id == "unknown" and out.price_usd == 0.0 and "20%" in out.message


def test_tiered_rules(spark):
    out = al.tiered_alerts(events(spark, ("bitcoin", 1.0, 25.0, "2026-06-09 10:00:00")))
    assert rows(out, "rule_id", "severity") == [("A001", "CRITICAL"), ("A003", "HIGH")]
    assert al.tiered_alerts(events(spark, ("bitcoin", 1.0, 2.0, "2026-06-09 10:00:00"))).count() == 0
    assert al.tiered_alerts(events(spark, ("bitcoin", 1.0, None, "2026-06-09 10:00:00"))).count() == 0
    nan = events(spark, ("bitcoin", 1.0, float("nan"), "2026-06-09 10:00:00"))
    assert al.tiered_alerts(nan).count() == 0


def test_rule_operators(spark):
    e = events(spark, ("bitcoin", 1.0, 5.0, "2026-06-09 10:00:00"))
    rules = [(op, op, "change_24h_pct", op, 5.0, "LOW") for op in (">", "<", ">=", "<=", "!=")]
    assert rows(al.tiered_alerts(e, rules), "rule_id") == [("<=",), (">=",)]


def test_all_rules_with_derived_metrics(spark):
    e = events(spark, ("bitcoin", 1.0, 0.0, "2026-06-09 10:00:00")).withColumns(
        {"volume_ratio": F.lit(2.5), "price_vs_sma": F.lit(5.0)}
    )
    assert rows(al.tiered_alerts(e), "rule_id") == [("A005",)]


def test_statistics(spark):
    a = fired(
        spark,
        ("A001", "bitcoin", "CRITICAL", "2026-06-09 10:30:00"),
        ("A001", "bitcoin", "CRITICAL", "2026-06-09 10:45:00"),
        ("A003", "ethereum", "HIGH", "2026-06-09 14:15:00"),
    )
    assert rows(al.alert_statistics(a)) == [
        ("crypto", "bitcoin", 2), ("crypto", "ethereum", 1), ("severity", "CRITICAL", 2),
        ("severity", "HIGH", 1), ("total", "all", 3),
    ]
    assert rows(al.alerts_by_hour(a)) == [("10", 2), ("14", 1)]
    assert rows(al.peak_hour(al.alerts_by_hour(a))) == [("10", 2)]
    assert al.alert_digest(a).first().digest == "Today: 3 alerts (2 CRITICAL, 1 HIGH)"
    assert al.alert_digest(a.limit(0)).first().digest == "Today: 0 alerts (0 CRITICAL, 0 HIGH)"
    assert rows(al.alert_statistics(a.limit(0))) == [("total", "all", 0)]
    missing = fired(spark, ("A001", None, None, "2026-06-09 10:30:00"))
    assert ("severity", "UNKNOWN", 1) in rows(al.alert_statistics(missing))
    assert ("crypto", "unknown", 1) in rows(al.alert_statistics(missing))


def test_peak_hour_tie_takes_the_earlier(spark):
    a = fired(spark, ("A", "b", "HIGH", "2026-06-09 14:00:00"), ("A", "b", "HIGH", "2026-06-09 10:00:00"))
    assert rows(al.peak_hour(al.alerts_by_hour(a))) == [("10", 1)]


def test_patterns(spark):
    a = fired(
        spark,
        ("A001", "bitcoin", "CRITICAL", "2026-06-09 10:30:00"),
        ("A001", "bitcoin", "CRITICAL", "2026-06-08 10:45:00"),
        ("A002", "ethereum", "CRITICAL", "2026-06-08 14:15:00"),
        ("A009", "old", "LOW", "2026-05-01 14:15:00"),
    )
    out = al.alert_patterns(a, "2026-06-09 23:00:00", 7)
    top = {(r["kind"], r["key"]) for r in out.filter("is_top").collect()}
    assert top == {("crypto", "bitcoin"), ("rule", "A001"), ("day", "2026-06-08")}
    days = {r["key"]: r["alerts"] for r in out.filter("kind = 'day'").collect()}
    assert len(days) == 7 and days["2026-06-05"] == 0 and days["2026-06-09"] == 1
    assert out.filter("key = 'old'").count() == 0


def test_suppression(spark):
    a = fired(
        spark,
        ("A001", "bitcoin", "HIGH", "2026-06-09 10:00:00"),
        ("A001", "bitcoin", "HIGH", "2026-06-09 10:20:00"),
        ("A001", "bitcoin", "HIGH", "2026-06-09 10:45:00"),
        ("A001", "bitcoin", "HIGH", "2026-06-09 11:15:00"),
        ("A002", "bitcoin", "HIGH", "2026-06-09 10:01:00"),
    )
    flags = {(r.rule_id, r.triggered_at.strftime("%H:%M")): r.suppressed for r in al.suppress_alerts(a).collect()}
    assert flags == {
        ("A001", "10:00"): False, ("A001", "10:20"): True, ("A001", "10:45"): True,
        ("A001", "11:15"): False, ("A002", "10:01"): False,
    }


def test_messages(spark):
    e = events(spark, ("bitcoin", 65000.0, 25.0, "2026-06-09 10:00:00"))
    m = al.alert_messages(al.tiered_alerts(e, keep=("price_usd", "change_24h_pct"))).filter("rule_id = 'A001'").first()
    assert m.message == "[CRITICAL] extreme_pump — bitcoin | price=$65,000.00 | change=+25.00%"
    assert m.color == "danger"
    t = al.price_alert_texts(al.price_alerts(e, keep=["change_24h_pct"])).first()
    assert t.text == "🚀 PUMP ALERT: bitcoin up 25.00% — Current price: $65,000.00"


def test_derived_metrics_volume_counts_empty_hours(spark):
    data = [("a", 1.0, 0.0, f"2026-06-09 0{h}:{m:02d}:00") for h, n in ((0, 3), (2, 6)) for m in range(n)]
    out = al.derived_metrics(events(spark, *data)).toPandas().sort_values("event_timestamp")
    assert out.volume_ratio.iloc[:3].isna().all()
    assert out.volume_ratio.iloc[3:].tolist() == [6 / (3 / 24)] * 6
    assert out.price_vs_sma.isna().all()


def test_nan_fires_nothing_and_leaves_aggregates(spark):
    from tidemark.operators import deadletters, marts
    from tidemark.operators.mapping import map_events

    nan = float("nan")
    df = spark.createDataFrame(
        [("a", nan, nan), ("a", 2.0, 20.0), ("a", 4.0, None)], "crypto_id string, price_usd double, change_24h_pct double"
    ).withColumn("event_timestamp", F.expr("timestamp'2026-06-09 10:00:00'"))
    fired = al.price_alerts(df)
    assert [(r.alert_type, r.price_usd) for r in fired.collect()] == [("PUMP", 2.0)]
    assert {r.change_24h_pct for r in al.tiered_alerts(df, keep=("change_24h_pct",)).collect()} == {20.0}
    window = marts.window_agg(df).first()
    assert (window.avg_price, window.price_range, window.avg_change_24h, window.record_count) == (3.0, 2.0, 20.0, 3)
    assert marts.fct_daily(df).first().max_price == marts.daily_mart(df, fired).first().max_price == 4.0
    letters = spark.createDataFrame(
        [('{"crypto_id": "a", "change_24h_pct": NaN}', "alert", "a")], "event string, step string, crypto_id string"
    )
    assert deadletters.replay(letters, ["a"]).first().outcome == "failed"
    mapped = map_events(df, lambda e: {"d": "1.5", "none": e["change_24h_pct"] is None}, "d string, none boolean, x decimal(20,8)")
    assert sorted(r.none for r in mapped.collect()) == [False, True, True]
