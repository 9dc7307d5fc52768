"""Sinks, retention and the composite jobs."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tests.conftest import rows
from tidemark import schema
from tidemark.operators import deadletters as dl, validation as val, versions as ver
from tidemark.operators.alerts import price_alerts
from tidemark.plans import jobs
from tidemark.sinks.lake import DATASETS, Lake, create_tables, jdbc_options, stored_prices
from tidemark.sources import adapters as src
from tidemark.sources.landed import parse_events, read_lake
from tidemark.session import shared_dir

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def dated(spark, *data):
    df = spark.createDataFrame(list(data), "date string, crypto_id string, v int")
    return df.withColumn("date", F.col("date").cast("date"))


def test_write_prunes_and_reads_back(spark, lake):
    lake.write(dated(spark, ("2026-06-08", "a", 1), ("2026-06-09", "a", 2), ("2026-06-09", "b", 3)), "raw")
    read = read_lake(spark, lake.path("raw"), crypto_id="a")
    assert rows(read, "v") == [(1,), (2,)]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(crypto_id" in plan
    with pytest.raises(KeyError):
        lake.path("nothing")


def test_overwrite_touches_only_its_partitions(spark, lake):
    lake.write(dated(spark, ("2026-06-08", "a", 1), ("2026-06-09", "a", 2)), "prices")
    lake.write(dated(spark, ("2026-06-09", "a", 5)), "prices", "overwrite")
    assert rows(lake.read("prices"), "v") == [(1,), (5,)]
    with pytest.raises(ValueError):
        lake.write(dated(spark, ("2026-06-09", "a", 5)), "raw", "overwrite")


def test_runs_do_not_replace_each_other(spark, lake, tmp_path):
    runs = [lake.run_of(str(tmp_path / c)) for c in ("one", "two", "one")]
    assert runs[0] == runs[2] != runs[1]
    for run, v in zip(runs, (1, 2, 3)):
        lake.write_batch(dated(spark, ("2026-06-09", "a", v)), "raw", 0, run)
    lake.write(dated(spark, ("2026-06-09", "a", 4)), "raw")
    assert rows(lake.read("raw"), "v") == [(2,), (3,), (4,)]
    with pytest.raises(ValueError):
        lake.write_batch(dated(spark, ("2026-06-09", "a", 1)), "prices", 0, "r")


def test_batch_time_is_that_of_the_first_try(lake):
    first = lake.batch_time("r", 3)
    time.sleep(1.1)
    assert lake.batch_time("r", 3) == first < lake.batch_time("r", 4)


def test_ids_that_look_like_numbers_stay_text(spark, lake):
    lake.write(dated(spark, ("2026-06-01", "007", 1), ("2026-06-08", "010", 2)), "raw")
    assert rows(lake.read("raw"), "crypto_id") == [("007",), ("010",)]
    lake.archive("2026-06-02")
    assert rows(lake.read("archive"), "crypto_id", "v") == [("007", 1)]


def test_row_landing_during_archive_stays(spark, lake, monkeypatch):
    lake.write(dated(spark, ("2026-06-01", "a", 1)), "raw")
    touch = Lake._touch

    def land(self, path):
        if path.endswith("copied"):
            lake.write(dated(spark, ("2026-06-01", "a", 9)), "raw")
        touch(self, path)

    with monkeypatch.context() as m:
        m.setattr(Lake, "_touch", land)
        lake.archive("2026-06-02")
    assert rows(lake.read("archive"), "v") == [(1,)] and rows(lake.read("raw"), "v") == [(9,)]


def test_one_file_per_small_partition(spark, lake):
    many = spark.range(1000).repartition(8).selectExpr("date'2026-06-09' date", "'a' crypto_id", "id v")
    lake.write(many, "raw")
    assert len(list(Path(lake.path("raw")).rglob("*.parquet"))) == 1


def test_upsert(spark, lake):
    df = spark.createDataFrame([("a", 1, "2026-06-08"), ("a", 2, "2026-06-09"), ("b", 3, "2026-06-09")], "crypto_id string, v int, trade_date string")
    df = df.withColumn("trade_date", F.col("trade_date").cast("date"))
    lake.upsert(df, "daily_summary", ["crypto_id", "trade_date"])
    lake.upsert(df.filter("v = 2").withColumn("v", F.lit(9)), "daily_summary", ["crypto_id", "trade_date"])
    assert rows(lake.read("daily_summary"), "crypto_id", "v") == [("a", 1), ("a", 9), ("b", 3)]


def test_upsert_writes_its_own_rows_only(spark, lake):
    ddl = "crypto_id string, trade_date date, v int"
    day = spark.sql("select date'2026-06-08' d").first().d
    keys = ["crypto_id", "trade_date"]
    lake.upsert(spark.createDataFrame([(c, day, i) for i, c in enumerate("abcd")], ddl), "daily_summary", keys, 0, "r")
    before = set(Path(lake.path("daily_summary")).rglob("*.parquet"))
    for _ in range(2):  # a repeated batch replaces itself
        lake.upsert(spark.createDataFrame([("b", day, 9), ("e", day, 5)], ddl), "daily_summary", keys, 1, "r")
    after = set(Path(lake.path("daily_summary")).rglob("*.parquet"))
    assert before < after and lake.stored("daily_summary").count() == 6
    want = [("a", 0), ("b", 9), ("c", 2), ("d", 3), ("e", 5)]
    assert rows(lake.read("daily_summary"), "crypto_id", "v") == want
    plan = lake.read("daily_summary").filter(F.col("trade_date") == F.lit(day))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trade_date" in plan
    with pytest.raises(ValueError):
        lake.upsert(spark.createDataFrame([("b", day, 9)], ddl), "raw", keys)


@pytest.mark.parametrize("stopped", [False, True])
def test_compaction_leaves_one_row_per_key(spark, lake, monkeypatch, stopped):
    ddl = "crypto_id string, trade_date date, v int"
    days = spark.sql("select date'2026-06-08' a, date'2026-06-09' b").first()
    for batch, data in enumerate([[("a", days.a, 1), ("b", days.a, 2)], [("a", days.a, 7)], [("c", days.b, 3)]]):
        lake.upsert(spark.createDataFrame(data, ddl), "daily_summary", ["crypto_id", "trade_date"], batch, "r")
    want = [("a", 7), ("b", 2), ("c", 3)]
    if stopped:
        with monkeypatch.context() as m:
            m.setattr(Lake, "_delete_files", lambda *_: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                lake.compact("daily_summary")
        assert rows(lake.read("daily_summary"), "crypto_id", "v") == want
    assert lake.compact("daily_summary") >= 2
    assert rows(lake.stored("daily_summary"), "crypto_id", "v") == want == rows(lake.read("daily_summary"), "crypto_id", "v")
    lake.upsert(spark.createDataFrame([("a", days.a, 8)], ddl), "daily_summary", ["crypto_id", "trade_date"], 3, "r")
    assert rows(lake.read("daily_summary"), "crypto_id", "v")[0] == ("a", 8)


def test_new_and_emptied_datasets_read_as_no_rows(spark, lake):
    assert lake.read("raw").count() == 0 and set(DATASETS["raw"]) <= set(lake.read("raw").columns)
    assert lake.archive("2026-06-02").count() == 0 and lake.purge_expired("2026-06-09 12:00:00") == 0
    lake.write(dated(spark, ("2026-06-01", "a", 1)), "raw")
    for moved in (1, 0, 0):  # the first run empties the dataset
        assert sum(r.rows_moved for r in lake.archive("2026-06-02").collect()) == moved
    assert lake.read("raw").count() == 0 and lake.read("raw").schema["v"].dataType.simpleString() == "int"
    lake.write(dated(spark, ("2026-06-09", "b", 2)).withColumn("w", F.lit(1.5)), "raw")
    assert rows(lake.read("raw"), "crypto_id", "v", "w") == [("b", 2, 1.5)]
    assert rows(lake.read("archive"), "v") == [(1,)]


def test_insert_reads_the_days_that_come_in(spark, lake):
    lake.write(dated(spark, *[(f"2026-06-{d:02d}", "a", d) for d in range(1, 20)]), "prices")
    incoming = dated(spark, ("2026-06-02", "a", 2), ("2026-06-18", "a", 99), ("2026-06-18", "a", 18))
    known = lake.matching(incoming, "prices", ["crypto_id", "v"])
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and rows(known, "v") == [(18,), (2,)]
    arrived = incoming.withColumn("_n", F.monotonically_increasing_id())
    assert [lake.insert_if_absent(arrived, "prices", ["crypto_id", "v"], "_n") for _ in range(2)] == [1, 0]
    assert lake.read("prices").count() == 20


def test_archive_moves_old_days_and_can_be_repeated(spark, lake):
    lake.write(dated(spark, ("2026-06-01", "a", 1), ("2026-06-01", "b", 2), ("2026-06-08", "a", 3)), "raw")
    assert [(str(r.date), r.rows_moved) for r in lake.archive("2026-06-02").collect()] == [("2026-06-01", 2)]
    assert rows(lake.read("raw"), "v") == [(3,)] and rows(lake.read("archive"), "v") == [(1,), (2,)]
    assert lake.archive("2026-06-02").count() == 0
    assert lake.read("archive").count() == 2
    lake.write(dated(spark, ("2026-06-01", "a", 4)), "raw")  # arrives after its day was archived
    lake.archive("2026-06-02")
    assert rows(lake.read("archive"), "v") == [(1,), (2,), (4,)]


@pytest.mark.parametrize("stopped", ["before the copy was marked", "while deleting"])
def test_stopped_archive_run_is_finished(spark, lake, monkeypatch, stopped):
    lake.write(dated(spark, ("2026-06-01", "a", 1), ("2026-06-01", "b", 2), ("2026-06-08", "a", 3)), "raw")
    delete, touch = Lake._delete, Lake._touch

    def partly(self, path):
        delete(self, f"{path}/crypto_id=a")
        raise OSError("lost")

    def no_mark(self, path):
        if path.endswith("copied"):
            raise OSError("lost")
        touch(self, path)

    with monkeypatch.context() as m:
        m.setattr(*((Lake, "_delete", partly) if stopped == "while deleting" else (Lake, "_touch", no_mark)))
        with pytest.raises(OSError):
            lake.archive("2026-06-02")
    lake.archive("2026-06-02")
    assert rows(lake.read("raw"), "v") == [(3,)] and rows(lake.read("archive"), "v") == [(1,), (2,)]


def test_purge(spark, lake):
    df = spark.createDataFrame([(1, "2026-06-08 10:00:00"), (2, "2026-06-09 11:00:00"), (3, "2026-06-09 13:00:00"), (4, "2026-06-10 00:00:00")], "key int, expires_at string")
    df = df.withColumn("expires_at", F.col("expires_at").cast("timestamp")).withColumn("expires_on", F.to_date("expires_at"))
    lake.write(df, "cache")
    lake.write(df.filter("key = 4").withColumn("expires_at", F.lit("2026-06-09 14:00:00").cast("timestamp")), "cache")
    assert rows(lake.read("cache"), "key") == [(1,), (2,), (3,), (4,)]
    assert lake.purge_expired("2026-06-09 12:00:00") == 2
    assert rows(lake.read("cache"), "key") == [(3,), (4,)]
    assert lake.purge_expired("2026-06-09 12:00:00") == 0
    assert lake.stored("cache").count() == 2
    assert lake.purge_expired("2026-06-19 12:00:00") == 2 and lake.read("cache").count() == 0
    assert lake.purge_expired("2026-06-19 12:00:00") == 0


def test_purge_killed_between_its_steps(spark, lake, monkeypatch):
    df = spark.createDataFrame([(1, "2026-06-09 10:00:00"), (2, "2026-06-09 13:00:00")], "key int, expires_at string")
    df = df.withColumn("expires_at", F.col("expires_at").cast("timestamp")).withColumn("expires_on", F.to_date("expires_at"))
    lake.write(df.coalesce(1), "cache")
    with monkeypatch.context() as m:
        m.setattr(Lake, "_delete_files", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            lake.purge_expired("2026-06-09 12:00:00")
    assert rows(lake.read("cache"), "key") == [(1,), (2,)]  # as before: the expired entry is still there, none is doubled
    assert lake.purge_expired("2026-06-09 12:00:00") == 1
    assert rows(lake.stored("cache"), "key") == [(2,)]


def test_reports_are_replaced_per_day(spark, lake):
    for v in (1, 2):
        lake.report(spark.createDataFrame([(v,)], "v int"), "sla", "2026-06-09")
    assert rows(spark.read.json(lake.path("reports")), "v", "report") == [(2, "sla")]


def test_health_trend_reads_stored_reports(spark, lake):
    for day, score in ((1, 5.0), (7, 60.0), (8, 70.0), (9, 80.0)):
        frame = spark.createDataFrame([("OVERALL", score), ("a", 1.0)], "crypto_id string, score double")
        lake.report(frame, "health_report", f"2026-06-{day:02d}")
    lake.report(spark.createDataFrame([(1,)], "v int"), "sla", "2026-06-09")
    assert rows(jobs.health_trend_run(lake, "2026-06-09")["trend"]) == [("stable", 70.0, 3)]


def test_unreadable_json_rows_are_dropped(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"a": 1}\n{broken\n{"a": 2}\n')
    schema_a = StructType([StructField("a", IntegerType())])
    df = read_lake(spark, str(tmp_path), schema_a, "json")
    assert rows(df) == [(1,), (2,)] and schema_a.names == ["a"]


def test_jdbc_options():
    o = jdbc_options("jdbc:x", "t", user="u")
    assert (o["batchsize"], o["dbtable"], o["user"], o["numPartitions"]) == ("100", "t", "u", "8")


def test_create_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS market")
    create_tables(spark, "market")
    names = {r.tableName for r in spark.sql("SHOW TABLES IN market").filter("not isTemporary").collect()}
    assert names == set(schema.TABLES)
    spark.sql("DROP DATABASE market CASCADE")


def test_every_reported_dataset_has_a_writer_entry():
    assert {"raw", "prices", "alerts", "dead_letters", "aggregations", "reports"} <= set(DATASETS)


def test_checkpoint_folder_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


# ---- jobs -----------------------------------------------------------------------------
def reported(lake):
    return {p.name for p in Path(lake.path("reports")).iterdir()}


def test_ingest_job(spark):
    raw = src.raw_json(spark, SF).select("value")
    stored = src.prices(spark, SF).select("crypto_id", "event_timestamp").limit(0)
    stored = stored.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    out = jobs.ingest(raw, stored, src.AS_OF, src.ASSET_IDS)
    total = out["summary"].first()
    assert total.total_events == 1000 == out["prices"].count() + out["dead_letters"].count()
    assert out["alerts"].count() == total.alerts_triggered and "Total events: 1000" in total.text


def test_warehouse_sync_job(spark, lake):
    p = src.prices(spark, SF).drop("event_id")
    a = price_alerts(p)
    out = jobs.warehouse_sync(p, a, p.limit(0), a.limit(0), src.AS_OF, lake)
    assert out["prices"].count() == p.filter("event_timestamp >= '2024-01-30 00:00:00'").count()
    again = jobs.warehouse_sync(p, a, p, a, src.AS_OF, lake)
    assert again["prices"].count() == 0
    mart = lake.read("daily_summary")
    assert mart.count() == 5 and mart.agg(F.sum("total_volume")).first()[0] == out["prices"].count()


def history(spark, *prices):
    body = '{"prices": [' + ", ".join(f"[{1704067200000 + 3600000 * i}, {p}]" for i, p in enumerate(prices)) + "]}"
    return spark.createDataFrame([("bitcoin", body), ("solana", body)], "crypto_id string, body string")


def test_backfill_job_writes_both_targets_once(spark, lake):
    run = lambda h, **kw: jobs.backfill(h, None, "2024-01-02 00:00:00", 1, lake=lake, **kw)
    totals = lambda out: out["summary"].filter("crypto_id = 'TOTAL'").first()
    first = totals(run(history(spark, 1.0, 2.0, 3.0)))
    assert (first.total_events, first.saved_lake, first.saved_table) == (6, 6, 6)
    again = totals(run(history(spark, 1.0, 2.0, 3.0)))
    assert (again.total_events, again.saved_table) == (6, 0)
    assert lake.read("raw").count() == lake.read("prices").count() == 6
    assert run(history(spark, 9.0, 2.0, 3.0, 4.0), asset="solana")["prices"].count() == 1
    got = rows(lake.read("prices").filter("crypto_id = 'solana'"), "event_timestamp", "price_usd", "source")
    assert [float(p) for _, p, _ in got] == [1.0, 2.0, 3.0, 4.0] and {s for *_, s in got} == {"coingecko_historical"}


def test_backfill_flags_choose_the_target(spark, lake):
    run = lambda **kw: jobs.backfill(history(spark, 1.0), None, "2024-01-02 00:00:00", 1, lake=lake, **kw)
    assert set(run(dry_run=True)) == {"plan"} and not lake.exists("raw") and not lake.exists("prices")
    assert run(lake_only=True)["prices"].count() == 0
    assert (lake.read("raw").count(), lake.exists("prices")) == (2, False)
    run(table_only=True)
    assert (lake.read("raw").count(), lake.read("prices").count()) == (2, 2)


def test_warehouse_sync_through_the_lake(spark, lake):
    p = src.prices(spark, SF).drop("event_id")
    a = price_alerts(p)
    for _ in range(2):
        out = jobs.warehouse_sync(p, a, None, None, src.AS_OF, lake)
    assert out["prices"].count() == 0
    wanted = p.filter("event_timestamp >= '2024-01-30 00:00:00'")
    assert lake.read("warehouse_prices").count() == wanted.dropDuplicates(["crypto_id", "event_timestamp"]).count()
    assert lake.read("warehouse_alerts").count() == a.filter("created_at >= '2024-01-30 00:00:00'").distinct().count()
    assert lake.read("daily_summary").count() == 5


def test_mart_job(spark):
    p = src.prices(spark, SF).drop("event_id")
    out = jobs.build_marts(p, price_alerts(p))
    assert all(r.passed for r in out["not_null_checks"].collect())
    assert spark.sql("select count(*) from fct_daily").first()[0] == out["fct_daily"].count()


def test_report_jobs(spark, lake):
    p = src.prices(spark, SF)
    assets = src.assets(spark, SF)
    day = src.LAST_DAY
    assert jobs.technical_run(p, day, 100, lake)["indicators"].count() == 500
    jobs.correlation_run(p, src.ASSET_IDS, src.AS_OF, "click", lake=lake)
    run = jobs.portfolio_run(p, src.portfolio(spark), src.AS_OF, lake)
    assert set(run) == {"value", "returns"}
    jobs.sentiment_run(src.headlines(spark, SF), day, lake)
    jobs.sla_run(src.sla_metrics(spark, SF), day, lake)
    jobs.step_run(src.step_metrics(spark, SF), src.FIRST_DAY, day, lake)
    jobs.cost_run(src.objects(spark, SF), src.AS_OF, lake=lake)
    jobs.resource_run(src.host_samples(spark, SF), day, lake)
    jobs.audit_run(src.audit_actions(spark, SF), day, lake)
    present = spark.createDataFrame([("click", day, "raw")], "crypto_id string, date string, dataset string")
    health = jobs.health_run(assets, p, present.withColumn("date", F.col("date").cast("date")), src.AS_OF, day, lake)
    assert health["report"].count() == 6
    names = reported(lake)
    for name in ("technical_indicators", "correlation_betas", "portfolio_returns", "sentiment_summary", "sla_overall", "cost_cost", "health_report", "audit_report", "resources_flags", "steps_daily"):
        assert f"report={name}" in names


def test_alerting_job_appends_history(spark, lake):
    p = src.prices(spark, SF)
    for _ in range(2):
        out = jobs.alerting_run(p, lake=lake)
    assert lake.read("alert_history").count() == 2 * out["alerts"].count()
    assert out["messages"].count() == out["alerts"].filter("not suppressed").count()


def test_quality_replay_and_version_jobs(spark, lake):
    checked = val.validate_events(parse_events(src.raw_json(spark, SF)), src.ASSET_IDS)
    out = jobs.quality_run(checked, "received_at", src.FIRST_DAY, src.LAST_DAY, lake)
    assert out["daily"].count() == 30 and out["trend"].first().days == 7
    letters = dl.dead_letters(checked.filter("not valid"), "validate", F.col("received_at"))
    day = jobs.replay_run(letters, "2024-01-15", tracked=src.ASSET_IDS)["summary"].first()
    assert day.total > 0 and day.still_failing == day.total
    snaps = ver.snapshots(src.prices(spark, SF), "consume", "event_timestamp", ["price_usd"])
    assert jobs.version_run(snaps, "2024-01-15")["counts"].first().assets_with_versions == 5
