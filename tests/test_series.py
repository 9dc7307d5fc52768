"""Windows over segments against plain windows, and the recurrences against plain loops."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import indicators as ind
from tidemark.operators.alerts import suppress_alerts, tiered_alerts
from tidemark.operators.marts import stg_prices
from tidemark.operators.series import CUT_ROWS, SEG, rolling, segmented

BASE = pd.Timestamp("2024-01-01")


def frame(spark, series: dict):
    """Prices a minute apart; a value is a list of prices."""
    data = [
        (k, (BASE + pd.Timedelta(minutes=i)).to_pydatetime(), float(x))
        for k, xs in series.items()
        for i, x in enumerate(xs)
    ]
    return spark.createDataFrame(data, "crypto_id string, event_timestamp timestamp, price_usd double")


def loop_ema(x, span):
    out, a = [x[0]], 2.0 / (span + 1)
    for v in x[1:]:
        out.append(a * v + (1 - a) * out[-1])
    return np.array(out)


def loop_rsi(x, p=14):
    d = np.diff(x)
    gain, loss = np.maximum(d, 0), np.maximum(-d, 0)
    g, s, out = gain[:p].mean(), loss[:p].mean(), []
    for i in range(p, len(d)):
        g, s = (g * (p - 1) + gain[i]) / p, (s * (p - 1) + loss[i]) / p
        out.append(100.0 if s == 0 else 100 - 100 / (1 + g / s))
    return np.array(out)


@pytest.fixture(scope="module")
def skewed():
    rng = np.random.default_rng(7)
    walk = 100 + np.cumsum(rng.normal(size=1500))
    return {"hot": walk, "warm": 50 + rng.normal(size=130), "cold": 10 + rng.normal(size=20), "one": [5.0]}


def collected(df, key):
    pdf = df.toPandas().sort_values("event_timestamp")
    return pdf[pdf.crypto_id == key]


def test_long_series_is_split_evenly_and_short_ones_are_not(spark, skewed):
    series = segmented(frame(spark, skewed), ["crypto_id"], "event_timestamp", 100)
    sizes = series.rows.groupBy("crypto_id", SEG).count().toPandas()
    hot = sizes[sizes.crypto_id == "hot"]["count"]
    assert len(hot) == 15 and hot.max() < 130 and hot.sum() == 1500
    assert (sizes.crypto_id == "cold").sum() == 1
    assert series.rows.count() == sum(len(v) for v in skewed.values())


@pytest.mark.parametrize("per_segment", [1, 7, 20])
def test_more_segments_than_any_fixed_number(spark, skewed, per_segment):
    series = segmented(frame(spark, skewed), ["crypto_id"], "event_timestamp", per_segment)
    hot = series.rows.filter("crypto_id = 'hot'").orderBy("event_timestamp").toPandas()
    assert hot[SEG].is_monotonic_increasing and hot[SEG].iloc[0] == 0 and set(hot[CUT_ROWS]) == {1500}
    assert hot.groupby(SEG).size().max() <= 2 * per_segment and hot[SEG].max() >= 1499 // per_segment - 1
    again = segmented(frame(spark, skewed).repartition(3), ["crypto_id"], "event_timestamp", per_segment).rows
    assert again.exceptAll(series.rows).isEmpty()


def test_bursts_are_cut_too(spark):
    """Ten thousand rows within ten milliseconds, and a few a day around them."""
    burst = spark.range(10_000).selectExpr("'a' k", "timestamp_micros(1700000000000000 + id) t", "id v")
    calm = spark.range(200).selectExpr("'a' k", "timestamp_micros(1690000000000000 + id * 86400000000) t", "id v")
    none = spark.sql("select cast(null as string) k, timestamp'2024-01-01' t, 1L v union all select 'a', null, 2L")
    df = burst.unionByName(calm).unionByName(none)
    series = segmented(df, ["k"], "t", 500)
    sizes = series.rows.filter("k = 'a'").groupBy(SEG).count().toPandas()
    assert sizes["count"].max() <= 1000 and len(sizes) >= 15 and series.rows.count() == 10_202
    got = rolling(series, 1, {"p": lambda w: F.lag("v").over(w)})
    plain = df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("t")))
    assert got.exceptAll(plain).isEmpty() and got.count() == plain.count()


def test_nothing_to_cut_leaves_a_plain_window(spark, skewed):
    series = segmented(frame(spark, skewed), ["crypto_id"], "event_timestamp")
    plan = rolling(series, 1, {"p": lambda w: F.lag("price_usd").over(w)})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == 1 and "Union" not in plan and "Join" not in plan


@pytest.mark.parametrize("per_segment", [64, 333, 10_000])
def test_rolling_equals_plain_window(spark, skewed, per_segment):
    df = frame(spark, skewed)
    series = segmented(df, ["crypto_id"], "event_timestamp", per_segment)
    got = rolling(
        series, 19,
        {"m": lambda w: F.avg("price_usd").over(w.rowsBetween(-19, 0)),
         "n": lambda w: F.count("price_usd").over(w.rowsBetween(-19, 0))},
    )
    w = Window.partitionBy("crypto_id").orderBy("event_timestamp").rowsBetween(-19, 0)
    want = df.withColumns({"m": F.avg("price_usd").over(w), "n": F.count("price_usd").over(w)})
    order = ["crypto_id", "event_timestamp"]
    a = got.toPandas().sort_values(order).reset_index(drop=True)[want.columns]
    b = want.toPandas().sort_values(order).reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b)


def test_rolling_with_segments_shorter_than_the_frame(spark):
    x = np.arange(60.0)
    series = segmented(frame(spark, {"a": x}), ["crypto_id"], "event_timestamp", 5)
    got = collected(rolling(series, 19, {"s": lambda w: F.sum("price_usd").over(w.rowsBetween(-19, 0))}), "a")
    want = [x[max(0, i - 19): i + 1].sum() for i in range(60)]
    assert got.s.tolist() == want


@pytest.mark.parametrize("per_segment", [3, 11, 64, 10_000])  # below the RSI period, around it and above
def test_indicators_equal_loops(spark, skewed, per_segment):
    out = ind.scan_indicators(ind.price_series(frame(spark, skewed), per_segment))
    for key in ("hot", "warm"):
        x, got = np.array(skewed[key]), collected(out, key)
        line = loop_ema(x, 12) - loop_ema(x, 26)
        signal = loop_ema(line, 9)
        np.testing.assert_allclose(got.macd, line, atol=1e-9)
        np.testing.assert_allclose(got.signal, signal, atol=1e-9)
        np.testing.assert_allclose(got.histogram, line - signal, atol=1e-9)
        np.testing.assert_allclose(got.rsi.dropna(), loop_rsi(x), atol=1e-9)
        frames = np.lib.stride_tricks.sliding_window_view(x, 20)
        np.testing.assert_allclose(got.sma.dropna(), frames.mean(axis=1), atol=1e-9)
        np.testing.assert_allclose(
            got.upper.dropna(), frames.mean(axis=1) + 2 * frames.std(axis=1, ddof=1), atol=1e-9
        )
    cold = collected(out, "cold")
    assert cold.macd.isna().all() and cold.sma.notna().sum() == 1 and cold.rsi.notna().sum() == 5


def test_constant_stretch_keeps_its_strength_across_segments(spark):
    x = np.concatenate([[10, 12, 11, 13, 12, 14] * 4, np.full(300, 14.0)])
    split = collected(ind.rsi(ind.price_series(frame(spark, {"a": x}), 64)), "a").rsi.to_numpy()
    np.testing.assert_allclose(split, np.round(loop_rsi(x), 4), atol=1e-4)


def test_sma_counts(spark):
    up = [100 + i for i in range(30)]
    assert ind.sma(ind.price_series(frame(spark, {"a": up})), 5).count() == 26
    assert ind.sma(ind.price_series(frame(spark, {"a": up[:5]})), 10).count() == 0


def test_rsi_edges(spark):
    saw = [100 + (i % 3) for i in range(30)]
    values = [r.rsi for r in ind.rsi(ind.price_series(frame(spark, {"a": saw}))).collect()]
    assert values and all(0 <= v <= 100 for v in values)
    rising = ind.rsi(ind.price_series(frame(spark, {"a": range(1, 31)})))
    assert {r.rsi for r in rising.collect()} == {100.0}
    assert ind.rsi(ind.price_series(frame(spark, {"a": range(15)}))).count() == 0


def test_bollinger_order(spark):
    out = ind.bollinger(ind.price_series(frame(spark, {"a": range(1, 31)})), 10).toPandas()
    assert len(out) == 21 and (out.upper >= out.middle).all() and (out.middle >= out.lower).all()


def test_macd_lengths(spark):
    fifty = frame(spark, {"a": range(1, 51)})
    assert ind.macd(ind.price_series(fifty), 5, 10, 3).count() == 50
    assert ind.macd(ind.price_series(frame(spark, {"a": range(1, 35)}))).count() == 0
    assert ind.macd(ind.price_series(frame(spark, {"a": range(1, 36)}))).count() == 35


def test_nan_prices_are_left_out(spark):
    out = ind.sma(ind.price_series(frame(spark, {"a": [1, float("nan"), 3, 5]})), 3)
    assert [r.sma for r in out.collect()] == [3.0]


@pytest.mark.parametrize("per_segment", [50, 10_000])
def test_price_change_across_segments(spark, skewed, per_segment):
    out = stg_prices(frame(spark, skewed), per_segment)
    got = collected(out, "hot")
    x = np.array(skewed["hot"])
    assert got.price_change_usd.isna().sum() == 1 and pd.isna(got.is_price_increase.iloc[0])
    np.testing.assert_allclose(got.price_change_usd.iloc[1:], np.diff(x), atol=1e-12)


@pytest.mark.parametrize("per_segment", [40, 10_000])
def test_suppression_equals_loop(spark, per_segment):
    rng = np.random.default_rng(3)
    minutes = np.cumsum(rng.integers(1, 90, size=300))
    data = [("hot", (BASE + pd.Timedelta(minutes=int(m))).to_pydatetime(), 25.0) for m in minutes]
    events = spark.createDataFrame(data, "crypto_id string, event_timestamp timestamp, change_24h_pct double")
    out = suppress_alerts(tiered_alerts(events), 30, per_segment).toPandas()
    want = [False] + [bool(b - a < 30) for a, b in zip(minutes, minutes[1:])]
    for rule in ("A001", "A003"):
        got = out[out.rule_id == rule].sort_values("triggered_at").suppressed.tolist()
        assert got == want
