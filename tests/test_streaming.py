"""Streams over landed files, restarts and repeated batches."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import alerts as al, marts
from tidemark.sinks.lake import Lake
from tidemark.sources.landed import read_landed_json
from tidemark.streaming import ingest, monitor, suppression, windows

NOW = {"availableNow": True}


class Topic:
    """A folder of JSON lines; each `put` is one file and, with one file per trigger, one batch."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.n = spark, folder, 0
        folder.mkdir()

    def put(self, *events):
        self.n += 1
        text = "\n".join(e if isinstance(e, str) else json.dumps(e) for e in events) + "\n"
        path = self.folder / f"{self.n:03d}.json"
        path.write_text(text)
        os.utime(path, (1_700_000_000 + self.n, 1_700_000_000 + self.n))  # files arrive in this order

    def stream(self):
        return read_landed_json(self.spark, str(self.folder), max_files=1)


def event(minute, price=1.0, crypto="bitcoin", change=0.0, second=0, hour=10):
    stamp = f"2026-06-09T{hour:02d}:{minute:02d}:{second:02d}+00:00"
    return {"crypto_id": crypto, "price_usd": price, "market_cap_usd": 1.0, "change_24h_pct": change, "timestamp": stamp, "source": "t"}


@pytest.fixture()
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


@pytest.fixture()
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def finish(query):
    query.awaitTermination(120)
    assert query.exception() is None
    return query


def run_ingest(topic, lake, tmp_path):
    return finish(ingest.start_ingestion(topic.stream(), lake, str(tmp_path / "cp"), trigger=NOW))


def test_ingestion(spark, topic, lake, tmp_path):
    topic.put(event(0), event(1, change=15.0), event(2, price=-1.0), "{broken")
    topic.put(event(0, price=9.0), event(3, crypto="fake"), event(4, change=-15.0))
    monitor.monitor(spark).settle(run_ingest(topic, lake, tmp_path))
    prices = lake.read("prices")
    assert prices.schema["price_usd"].dataType.simpleString() == "decimal(20,8)"
    assert sorted(float(r.price_usd) for r in prices.collect()) == [1.0, 1.0, 1.0]
    assert rows(lake.read("alerts"), "alert_type") == [("DUMP",), ("PUMP",)]
    letters = lake.read("dead_letters")
    assert letters.count() == 3 and "{broken" in {r.event for r in letters.collect()}
    assert lake.read("raw").count() == 4
    steps = lake.read("step_metrics")
    assert steps.filter("step <> 'consume'").count() == 8 and {r.status for r in steps.collect()} == {"success"}

    topic.put(event(1, price=7.0), event(30))
    run_ingest(topic, lake, tmp_path)  # resumes from its checkpoint
    assert lake.read("prices").count() == 4 and lake.read("dead_letters").count() == 3


def test_repeated_batch_leaves_one_copy(spark, lake):
    batch = spark.createDataFrame([(json.dumps(e),) for e in (event(0, change=15.0), event(1, price=-1.0))], "value string")
    for _ in range(2):
        ingest.ingest_batch(batch, 5, lake, ["bitcoin"], 10.0)
    assert [lake.read(d).count() for d in ("prices", "alerts", "dead_letters", "raw")] == [1, 1, 1, 1]


def test_alert_stream(spark, topic, tmp_path):
    topic.put(event(0, change=15.0), event(1), event(2, change=99.0, crypto="fake"))
    query = ingest.alert_stream(topic.stream()).writeStream.format("memory").queryName("alerted")
    finish(query.trigger(**NOW).start())
    assert rows(spark.table("alerted"), "crypto_id", "alert_type") == [("bitcoin", "PUMP")]


def run_windows(topic, lake, tmp_path):
    return finish(windows.start_aggregation(topic.stream(), lake, str(tmp_path / "cp"), "10 minutes", trigger=NOW))


def test_window_stream_merges_updates_and_drops_late_rows(spark, topic, lake, tmp_path):
    topic.put(event(0, 1.0), event(0, 3.0, second=30), event(1, 5.0))
    topic.put(event(0, 8.0, second=45), event(0, 1.0), event(2, price=-1.0))  # late but in time, copy, bad
    topic.put(event(50, 7.0))
    topic.put(event(51, 7.0))
    topic.put(event(0, 100.0, second=50))  # behind the watermark
    query = run_windows(topic, lake, tmp_path)
    got = {r.window_start.strftime("%H:%M"): r for r in lake.read("aggregations").collect()}
    assert set(got) == {"10:00", "10:01", "10:50", "10:51"}
    assert (got["10:00"].avg_price, got["10:00"].record_count, got["10:00"].price_range) == (4.0, 3, 7.0)
    assert windows.late_rows(query) == 1

    topic.put(event(52, 2.0))
    run_windows(topic, lake, tmp_path)
    assert lake.read("aggregations").count() == 5


def test_append_mode_with_dedup(spark, topic, tmp_path):
    topic.put(event(0, 1.0), event(0, 1.0), event(0, 3.0, second=1))
    topic.put(event(30))
    topic.put(event(31))
    stream = windows.aggregate_stream(topic.stream(), "5 minutes")
    query = stream.writeStream.outputMode("append").format("memory").queryName("appended")
    finish(query.option("checkpointLocation", str(tmp_path / "cp")).trigger(**NOW).start())
    got = spark.table("appended").filter("window_start = timestamp'2026-06-09 10:00:00'").first()
    assert (got.record_count, got.avg_price) == (2, 2.0)


def test_sessions_of_a_stream_equal_those_of_a_table(spark, topic, lake, tmp_path):
    at = [(10, 0), (10, 25), (10, 55), (11, 26), (11, 30), (13, 0), (10, 40)]  # the last one comes late
    topic.put(*[event(m, 1.0 + i, hour=h) for i, (h, m) in enumerate(at[:3])])
    topic.put(event(at[6][1], 7.0, hour=10), event(5, 2.0, crypto="solana"), event(at[3][1], 4.0, hour=11))
    topic.put(event(at[4][1], 5.0, hour=11))
    topic.put(event(at[5][1], 6.0, hour=13))
    topic.put(event(0, 1.0, hour=20))
    run = lambda: finish(windows.start_sessions(topic.stream(), lake, str(tmp_path / "cp"), "30 minutes", "1 hour", trigger=NOW))
    run()
    topic.put(event(0, 1.0, hour=23))
    run()
    table = spark.read.text(str(topic.folder))
    from tidemark.sources.landed import parse_events, with_event_time

    prices = with_event_time(parse_events(table)).filter("event_timestamp < '2026-06-09 23:00:00'")
    want = marts.session_agg(prices, "30 minutes")
    assert rows(lake.read("sessions"), *want.columns) == rows(want)
    assert sorted(r.record_count for r in want.collect()) == [1, 1, 1, 2, 4]


def test_merge_mode_accepts_any_lateness(spark, topic, lake, tmp_path):
    topic.put(event(0, 1.0), event(0, 3.0, second=30))
    topic.put(event(0, 7.0, hour=20))
    topic.put(event(0, 8.0, second=50))
    finish(windows.start_merging(topic.stream(), lake, str(tmp_path / "cp"), trigger=NOW))
    merged = windows.merged_windows(lake.read("partials"))
    got = {r.window_start.strftime("%H:%M"): (r.avg_price, r.min_price, r.max_price, r.record_count) for r in merged.collect()}
    assert got == {"10:00": (4.0, 1.0, 8.0, 3), "20:00": (7.0, 7.0, 7.0, 1)}


def merged(lake):
    found = windows.merged_windows(lake.read("partials")).collect()
    return {r.window_start.strftime("%d %H:%M"): (r.avg_price, r.record_count) for r in found}


def test_merge_mode_counts_an_event_once(spark, topic, lake, tmp_path):
    topic.put(event(0, 1.0), event(0, 1.0), event(0, 3.0, second=30), event(5, 1.0, crypto="solana"))
    topic.put(event(0, 9.0), event(0, 3.0, second=30), event(1, 2.0))  # two of the batch before
    finish(windows.start_merging(topic.stream(), lake, str(tmp_path / "cp"), trigger=NOW))
    want = {"09 10:00": (2.0, 2), "09 10:05": (1.0, 1), "09 10:01": (2.0, 1)}
    assert merged(lake) == want
    topic.put(event(1, 8.0), event(0, 1.0), event(0, 5.0, second=1))
    finish(windows.start_merging(topic.stream(), lake, str(tmp_path / "cp"), trigger=NOW))
    assert merged(lake) == {**want, "09 10:00": (3.0, 3)}


def test_merge_batch_that_runs_twice(spark, lake):
    first = spark.createDataFrame([(json.dumps(e),) for e in (event(0, 1.0), event(0, 3.0, second=9))], "value string")
    second = spark.createDataFrame([(json.dumps(e),) for e in (event(0, 1.0), event(0, 8.0, second=20))], "value string")
    for batch_id, batch in ((0, first), (0, first), (1, second), (1, second)):
        windows.merge_batch(batch, batch_id, lake, "r")
    assert merged(lake) == {"09 10:00": (4.0, 3)}
    assert lake.read("event_keys").count() == 3


def test_first_arrival_is_that_of_the_topic(spark, lake):
    ddl = "value string, received_at timestamp, partition int, offset long"
    at = spark.sql("select timestamp'2026-06-09 10:00:00' a, timestamp'2026-06-09 10:00:01' b").first()
    came = [(9.0, at.b, 0, 1), (2.0, at.a, 1, 8), (5.0, at.a, 1, 7), (7.0, at.a, 2, 1)]
    batch = spark.createDataFrame([(json.dumps(event(0, p)), *rest) for p, *rest in came], ddl).repartition(3)
    ingest.ingest_batch(batch, 0, lake, ["bitcoin"], 10.0)
    assert [float(r.price_usd) for r in lake.read("prices").collect()] == [5.0]


def test_bad_aggregates_become_dead_letters(spark, lake):
    ddl = "crypto_id string, window_start timestamp, window_end timestamp, avg_price double, min_price double, max_price double, price_range double, avg_change_24h double, record_count bigint"
    data = spark.sql("select 'a' c, timestamp'2026-06-09 10:00:00' s, timestamp'2026-06-09 10:01:00' e").collect()[0]
    batch = spark.createDataFrame([(data.c, data.s, data.e, 1.0, 0.5, 2.0, 1.5, 0.0, 2), (data.c, data.e, data.s, 1.0, 5.0, 2.0, 1.5, 0.0, 2)], ddl)
    windows.store_aggregates(batch, 0, lake)
    assert lake.read("aggregations").count() == 1
    letter = lake.read("dead_letters").first()
    assert letter.step == "spark_postgres" and json.loads(letter.event)["min_price"] == 5.0


def ingested(topic):
    from tidemark.sources.landed import parse_events, with_event_time

    return with_event_time(parse_events(topic.stream()))


def suppress(topic, lake, tmp_path, delay, bucket=60):
    fired = al.tiered_alerts(ingested(topic))
    return finish(suppression.start_suppression(fired, lake, str(tmp_path / "cp"), 30, NOW, delay, bucket))


def flags(lake, rule="A001"):
    return rows(lake.read("alert_history").filter(F.col("rule_id") == rule), "crypto_id", "triggered_at", "suppressed")


def test_suppression_stream_equals_batch(spark, topic, lake, tmp_path):
    minutes = [[0, 20, 55], [70, 59], [], [130, 131]]
    for batch in minutes:
        if batch:
            topic.put(*[event(m % 60, change=25.0, hour=10 + m // 60) for m in sorted(batch)])
    for _ in range(2):  # the second start continues after the first
        suppress(topic, lake, tmp_path, "0 seconds")
    got = flags(lake)
    want = {0: False, 20: True, 55: False, 59: True, 70: True, 130: False, 131: True}
    assert {10 * 60 + m: s for m, s in want.items()} == {t.hour * 60 + t.minute: s for _, t, s in got}
    assert len(got) == len(want)


def test_suppression_in_any_order_over_restarts(spark, topic, lake, tmp_path):
    """Alerts of two hours come shuffled within 40 minutes, in six runs of one query."""
    rng = random.Random(4)
    alerts = [
        event(s // 60 % 60, change=rng.choice([25.0, 15.0]), crypto=rng.choice(["bitcoin", "solana"]), hour=10 + s // 3600, second=s % 60)
        for s in sorted(rng.sample(range(10_800), 60))
    ]
    late = sorted(alerts, key=lambda e: (int(e["timestamp"][11:13]) * 60 + int(e["timestamp"][14:16])) + rng.uniform(0, 40))
    for n in range(0, 60, 10):
        topic.put(*late[n : n + 10])
        suppress(topic, lake, tmp_path, "45 minutes", 30)
    end = event(0, change=25.0, crypto="cardano", hour=20)
    topic.put(end)
    topic.put(event(59, change=25.0, crypto="cardano", hour=23))
    suppress(topic, lake, tmp_path, "45 minutes", 30)

    ddl = "crypto_id string, change_24h_pct double, timestamp string"
    table = spark.createDataFrame([(e["crypto_id"], e["change_24h_pct"], e["timestamp"]) for e in [*alerts, end]], ddl)
    fired = al.tiered_alerts(table.withColumn("event_timestamp", F.to_timestamp("timestamp")))
    want = al.suppress_alerts(fired, 30)
    columns = ["rule_id", "crypto_id", "triggered_at", "suppressed", "triggered_value"]
    assert rows(lake.read("alert_history"), *columns) == rows(want, *columns)


def test_state_of_suppression_goes_away(spark, topic, lake, tmp_path):
    for hour in range(10, 16):
        topic.put(*[event(m, change=25.0, crypto=c, hour=hour) for m in (1, 50) for c in ("bitcoin", "solana")])
    query = suppress(topic, lake, tmp_path, "1 minute")
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    # Two rules and two assets; the alert of minute 50 is known to the hour it is in and the next one.
    assert max(held) <= 3 * 8 and len(held) >= 6
    topic.put(event(0, change=0.0, crypto="bitcoin", hour=22), event(1, change=25.0, crypto="cardano", hour=22))
    topic.put(event(5, change=25.0, crypto="cardano", hour=23))
    topic.put(event(6, change=25.0, crypto="cardano", hour=23))
    query = suppress(topic, lake, tmp_path, "1 minute")
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 4


def test_alerts_without_a_time_pass(spark, topic, lake, tmp_path):
    timeless = {**event(0, change=25.0), "timestamp": "never"}
    topic.put(timeless, event(1, change=25.0))
    topic.put(event(30, change=25.0), timeless)
    suppress(topic, lake, tmp_path, "1 minute")
    got = flags(lake)
    assert sum(t is None for _, t, _ in got) == 2 and not any(s for _, t, s in got if t is None)


def test_a_bucket_covers_the_time_of_suppression(spark, topic):
    with pytest.raises(ValueError):
        suppression.suppress_stream(al.tiered_alerts(ingested(topic)), 30, bucket_minutes=29)


def test_step_metrics_count_rows_of_each_batch(spark, topic, lake, tmp_path):
    topic.put(event(0), event(1, change=15.0), event(2, price=-1.0), "{broken")
    topic.put(event(0, price=9.0), event(3, crypto="fake"), event(4, change=-15.0))
    query = run_ingest(topic, lake, tmp_path)
    monitor.monitor(spark).settle(query)
    got = {(r.batch_id, r.step): (r["rows"], r.valid, r.invalid, r.dropped) for r in lake.read("step_metrics").collect()}
    assert got == {
        (0, "consume"): (4, None, None, 0), (1, "consume"): (3, None, None, 0),
        (0, "validate"): (4, 2, 2, None), (1, "validate"): (3, 2, 1, None),
        (0, "postgres"): (2, None, None, 0), (1, "postgres"): (1, None, None, 1),
        (0, "s3"): (2, None, None, None), (1, "s3"): (2, None, None, None),
        (0, "alert"): (1, None, None, None), (1, "alert"): (1, None, None, None),
    }
    assert all(r.duration_seconds > 0 and r.status == "success" for r in lake.read("step_metrics").collect())


def test_late_rows_of_more_batches_than_spark_remembers(spark, topic, tmp_path):
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(kept, "10")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        topic.put(event(50), event(51, price=-1.0))
        topic.put(event(51))
        for n in range(102):
            topic.put(event(0, second=n % 60))
        checked = windows.valid_stream(topic.stream(), "1 minute")
        writer = checked.writeStream.foreachBatch(lambda batch, _: batch.write.format("noop").mode("overwrite").save())
        taken = []
        query = monitor.watched(writer.option("checkpointLocation", str(tmp_path / "cp")).trigger(**NOW), taken.append)
        query.awaitTermination(300)
        assert query.exception() is None
        assert windows.late_rows(query) == 102 and len(query.recentProgress) <= 10
        assert monitor.monitor(spark).batches(query) == len(taken) >= 104
        assert sum(t.observed["validated"]["invalid"] for t in taken if t.observed) == 1
        assert sum(t.rows for t in taken) == 105 and sum(t.dropped for t in taken) == 102
    finally:
        spark.conf.unset(kept)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_window_query_stores_its_step(spark, topic, lake, tmp_path):
    topic.put(event(0, 1.0), event(1, 5.0), event(1, price=-1.0))
    topic.put(event(50, 7.0))
    topic.put(event(51, 7.0))
    topic.put(event(0, 100.0, second=50))
    query = run_windows(topic, lake, tmp_path)
    assert windows.late_rows(query) == 1
    steps = lake.read("step_metrics").filter("step = 'spark_process'").collect()
    assert {(r["rows"], r.valid, r.invalid, r.dropped) for r in steps if r["rows"]} == {(3, 2, 1, 0), (1, 1, 0, 0), (1, 1, 0, 1)}
