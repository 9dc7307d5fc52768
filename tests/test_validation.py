import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import deadletters as dl
from tidemark.operators import validation as val
from tidemark.sources.landed import parse_events, with_event_time

GOOD = {
    "crypto_id": "bitcoin",
    "price_usd": 65000.0,
    "market_cap_usd": 1.2e12,
    "change_24h_pct": 2.5,
    "timestamp": "2026-06-09T10:00:00+00:00",
    "source": "coingecko",
}


def checked(spark, *events):
    raw = spark.createDataFrame([(e if isinstance(e, str) else json.dumps(e),) for e in events], "value string")
    return val.validate_events(parse_events(raw))


def one(spark, **changes):
    return checked(spark, {**GOOD, **changes}).first()


def test_valid_event(spark):
    row = one(spark)
    assert row.valid and all(row[c] for c in val.EVENT_CHECKS) and row.errors == []


@pytest.mark.parametrize(
    "changes, failed, errors",
    [
        ({"crypto_id": None}, {"required_fields", "valid_crypto"},
         ["Missing required fields: ['crypto_id']", "Unknown crypto_id: None"]),
        ({"price_usd": -1.0}, {"price_positive", "price_range"},
         ["price_usd must be positive, got -1.0", "price_usd -1.0 out of range [0.0001, 10000000]"]),
        ({"price_usd": None}, {"required_fields", "price_positive", "price_range"},
         ["Missing required fields: ['price_usd']"]),
        ({"crypto_id": "fakecoin"}, {"valid_crypto"}, ["Unknown crypto_id: fakecoin"]),
        ({"timestamp": None}, {"required_fields", "timestamp_format"},
         ["Missing required fields: ['timestamp']"]),
        ({"timestamp": "nope"}, {"timestamp_format"}, ["Invalid timestamp format: nope"]),
        ({"price_usd": 2e7}, {"price_range"}, ["price_usd 20000000.0 out of range [0.0001, 10000000]"]),
        ({"change_24h_pct": -99.5}, {"change_range"}, ["change_24h_pct -99.5 out of range [-99, 1000]"]),
    ],
)
def test_invalid_events(spark, changes, failed, errors):
    row = one(spark, **changes)
    assert not row.valid
    assert {c for c in val.EVENT_CHECKS if not row[c]} == failed
    assert row.errors == errors


@pytest.mark.parametrize("changes", [
    {"change_24h_pct": None}, {"change_24h_pct": -99}, {"change_24h_pct": 1000},
    {"price_usd": 0.0001}, {"price_usd": 1e7},
])
def test_edges_pass(spark, changes):
    assert one(spark, **changes).valid


def test_nan_price_fails(spark):
    row = checked(spark, json.dumps({**GOOD, "price_usd": "X"}).replace('"X"', "NaN")).first()
    assert not row.price_positive and not row.price_range and not row.valid


@pytest.mark.parametrize("text, ok", [
    ("2026-06-09T10:00:00Z", True), ("2026-06-09", True), ("2026-06-09 10:00:00", True),
    ("10:00", False), ("2026-06", False), ("2026-13-45T00:00:00", False),
])
def test_timestamp_shapes(spark, text, ok):
    assert one(spark, timestamp=text).timestamp_format is ok


def test_text_that_is_not_json_is_rejected(spark):
    row = checked(spark, "{broken").first()
    assert not row.valid and row.raw == "{broken"


def test_malformed_time_is_null_not_an_error(spark):
    raw = spark.createDataFrame([(json.dumps({**GOOD, "timestamp": "bad"}),)], "value string")
    assert with_event_time(parse_events(raw)).first().event_timestamp is None


AGG = "crypto_id string, window_start timestamp, window_end timestamp, avg_price double, min_price double, max_price double, record_count bigint"


def aggregate(spark, avg=65000.0, low=64000.0, high=66000.0, n=10, start="2026-06-09 10:00:00", end="2026-06-09 10:01:00"):
    df = spark.createDataFrame([("bitcoin", start, end, avg, low, high, n)], AGG.replace("timestamp,", "string,"))
    df = df.withColumns({c: F.col(c).cast("timestamp") for c in ("window_start", "window_end")})
    return val.validate_aggregates(df).first()


def test_aggregates(spark):
    assert aggregate(spark).valid
    bad = aggregate(spark, low=67000.0, high=64000.0)
    assert not bad.price_order and bad.errors == ["Price order invalid: min=67000.0 avg=65000.0 max=64000.0"]
    none = aggregate(spark, avg=None)
    assert not none.avg_price_positive and not none.price_order and len(none.errors) == 2
    assert not aggregate(spark, n=0).record_count_positive
    assert not aggregate(spark, end="2026-06-09 10:00:00").window_order
    assert aggregate(spark, start=None).window_order


def test_quality_and_summary(spark):
    events = checked(spark, *[GOOD] * 8, *[{**GOOD, "price_usd": -1.0}] * 2)
    quality = val.stream_quality(events).first()
    assert quality.quality_score == 80.0 and quality.warning is None
    assert rows(val.validation_summary(events)) == [(10, 8, 2, 80.0, 4)]
    counts = dict(rows(val.error_counts(events)))
    assert counts["price_positive"] == 2 and counts["valid_crypto"] == 0
    empty = events.limit(0)
    assert rows(val.stream_quality(empty)) == [(0, 0.0, None)]
    assert rows(val.validation_summary(empty)) == [(0, 0, 0, 0.0, 0)]
    assert "below 80%" in val.stream_quality(events.filter("not valid")).first().warning


def test_run_summary(spark):
    events = checked(spark, GOOD, {**GOOD, "change_24h_pct": 15.0}, {**GOOD, "change_24h_pct": 10.0}, {**GOOD, "price_usd": None})
    assert rows(val.run_summary(events)) == [(4, 3, 1, 1, 1, 75.0)]


def test_not_null_checks(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "crypto_id string, n int")
    assert rows(val.not_null_checks(df, ["crypto_id", "n"])) == [("crypto_id", 1, False), ("n", 0, True)]


# ---- dead letters ----------------------------------------------------------------
def letters(spark, *items):
    df = spark.createDataFrame([(s, json.dumps(e)) for s, e in items], "step string, event string")
    return df.selectExpr("event", "'failed' error", "step", "timestamp'2026-06-09 10:00:00' failed_at", "'bitcoin' crypto_id", "date'2026-06-09' date")


def test_dead_letters_and_scan(spark):
    bad = val.split(checked(spark, GOOD, {**GOOD, "crypto_id": None}))[1]
    out = dl.dead_letters(bad, "validate", F.lit("2026-06-09 10:00:00").cast("timestamp"))
    row = out.first()
    assert out.count() == 1 and row.crypto_id == "unknown" and json.loads(row.event)["price_usd"] == 65000.0
    assert row.error == "[Missing required fields: ['crypto_id'], Unknown crypto_id: None]"
    assert dl.dlq_scan(out, "2026-06-09").count() == 1
    assert dl.dlq_scan(out, "2026-06-09", "alert").count() == 0
    assert dl.dlq_scan(out, "2026-06-10").count() == 0


def test_replay(spark):
    window = {"crypto_id": "bitcoin", "window_start": "2026-06-09T10:00:00", "window_end": "2026-06-09T10:01:00",
              "avg_price": 2.0, "min_price": 1.0, "max_price": 3.0, "record_count": 2}
    items = letters(
        spark,
        ("validate", GOOD), ("validate", {**GOOD, "price_usd": -1.0}),
        ("postgres", GOOD), ("postgres", {**GOOD, "timestamp": None}),
        ("s3", GOOD),
        ("alert", {**GOOD, "change_24h_pct": 15.0}), ("alert", {**GOOD, "change_24h_pct": -15.0}),
        ("alert", GOOD), ("alert", {**GOOD, "change_24h_pct": None}),
        ("spark_postgres", window), ("spark_s3", {**window, "record_count": 0}),
        ("other", GOOD),
    )
    out = dl.replay(items)
    assert rows(out, "step", "outcome") == sorted([
        ("validate", "valid"), ("validate", "failed"), ("postgres", "stored"), ("postgres", "failed"),
        ("s3", "stored"), ("alert", "PUMP"), ("alert", "DUMP"), ("alert", "no_alert"), ("alert", "failed"),
        ("spark_postgres", "valid"), ("spark_s3", "failed"), ("other", "failed"),
    ], key=str)
    assert rows(dl.replay_summary(out)) == [(12, 7, 5)]
    two = letters(spark, ("validate", GOOD), ("validate", {**GOOD, "crypto_id": "x"}))
    assert rows(dl.replay_summary(dl.replay(two))) == [(2, 1, 1)]
