"""Technical indicators per asset: SMA, Bollinger bands, RSI, MACD."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import clean_number
from tidemark.operators.series import CUT_ROWS, ROWS_PER_SEGMENT, SEG, Series, rolling, segmented
from tidemark.session import ship_with_jobs


def price_series(
    prices: DataFrame, rows_per_segment: int = ROWS_PER_SEGMENT
) -> Series:
    """Usable prices of every asset, cut into segments."""
    usable = prices.select(
        "crypto_id", "event_timestamp", clean_number(F.col("price_usd").cast("double")).alias("price_usd")
    ).filter("crypto_id is not null and price_usd is not null and event_timestamp is not null")
    return segmented(usable, ["crypto_id"], "event_timestamp", rows_per_segment)


def sma(series: Series, window: int = 20) -> DataFrame:
    """Mean of the last `window` prices, from the first full window on."""
    frame = {"sma": lambda w: F.avg("price_usd").over(_last(w, window)), **_full(window)}
    return (
        rolling(series, window - 1, frame)
        .filter(F.col("_seen") == window)
        .select("crypto_id", "event_timestamp", F.round("sma", 6).alias("sma"))
    )


def bollinger(series: Series, window: int = 20, num_std: float = 2.0) -> DataFrame:
    """Rolling mean with bands of `num_std` sample deviations."""
    frame = {
        "_mean": lambda w: F.avg("price_usd").over(_last(w, window)),
        "_std": lambda w: F.stddev_samp("price_usd").over(_last(w, window)),
        **_full(window),
    }
    spread = F.col("_std") * float(num_std)
    return (
        rolling(series, window - 1, frame)
        .filter(F.col("_seen") == window)
        .select(
            "crypto_id",
            "event_timestamp",
            F.round(F.col("_mean") + spread, 6).alias("upper"),
            F.round("_mean", 6).alias("middle"),
            F.round(F.col("_mean") - spread, 6).alias("lower"),
        )
    )


def _last(window, rows: int):
    return window.rowsBetween(-(rows - 1), Window.currentRow)


def _full(window: int) -> dict:
    return {"_seen": lambda w: F.count("price_usd").over(_last(w, window))}


# ---- recurrences ---------------------------------------------------------------
# RSI and MACD carry a state from row to row. Each segment is read once in order; only its state
# (a few numbers and the last prices) moves on to the next segment.


@dataclass(frozen=True)
class Periods:
    rsi: int = 14
    fast: int = 12
    slow: int = 26
    signal: int = 9
    window: int = 20
    num_std: float = 2.0

    def step(self) -> np.ndarray:
        """How (fast, slow, signal) averages move over one row, new input left out."""
        f, s, g = (2.0 / (n + 1) for n in (self.fast, self.slow, self.signal))
        return np.array(
            [[1 - f, 0.0, 0.0], [0.0, 1 - s, 0.0], [g * (1 - f), -g * (1 - s), 1 - g]]
        )


@dataclass
class State:
    seen: int = 0
    gain: float = 0.0
    loss: float = 0.0
    averages: np.ndarray = field(default_factory=lambda: np.zeros(3))
    tail: np.ndarray = field(default_factory=lambda: np.empty(0))

    def text(self, **more: list) -> str:
        """As JSON, which keeps doubles exact."""
        return json.dumps(
            {
                "seen": int(self.seen),
                "gain": float(self.gain),
                "loss": float(self.loss),
                "averages": self.averages.tolist(),
                "tail": self.tail.tolist(),
                **more,
            }
        )

    @staticmethod
    def of(text: str | None) -> State:
        if text is None:
            return State()
        d = json.loads(text)
        return State(d["seen"], d["gain"], d["loss"], np.array(d["averages"]), np.array(d["tail"]))


_OUT = ["sma", "upper", "middle", "lower", "rsi", "macd", "signal", "histogram"]


def scan_indicators(series: Series, periods: Periods = Periods()) -> DataFrame:
    """All indicators in one ordered pass; a column is null where its series has no value yet."""
    enough = periods.slow + periods.signal
    rows = series.rows.withColumn("_length", F.count(F.lit(1)).over(series.whole()))
    state = F.lit(None).cast("string")
    if series.cut:
        # Only the first row of a segment carries the state, the others would only move copies.
        # The rows are partitioned by the join keys already, so a shuffled join moves one side.
        carried = _carried_states(rows, series, periods)
        rows = rows.withColumn("_row", F.row_number().over(series.window()))
        rows = rows.join(carried, [*series.keys, SEG], "left")
        state = F.when(F.col("_row") == 1, F.col("_carried"))
    long_enough = F.greatest(CUT_ROWS, "_length") >= enough
    rows = rows.select(
        *series.keys,
        SEG,
        series.order,
        "price_usd",
        state.alias("_state"),
        long_enough.alias("_long_enough"),
    )
    rows = rows.sortWithinPartitions(*series.keys, SEG, series.order)
    key, order = series.keys[0], series.order
    schema = f"{key} string, {order} {_type(rows, order)}, price_usd double, " + ", ".join(
        f"{c} double" for c in _OUT
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state = None, State()
        for batch in batches:
            parts = []
            for part in _runs(batch, key):
                group = (part[key].iat[0], part[SEG].iat[0])
                if group != current:
                    current, state = group, State.of(part["_state"].iat[0])
                values, state = _advance(state, part["price_usd"].to_numpy(), periods)
                out = part[[key, order, "price_usd"]].assign(**values)
                out.loc[~part["_long_enough"], ["macd", "signal", "histogram"]] = np.nan
                parts.append(out)
            if parts:
                yield pd.concat(parts)

    result = rows.mapInPandas(run, schema)
    return result.withColumns({c: clean_number(c) for c in _OUT})


def rsi(series: Series, period: int = 14) -> DataFrame:
    return (
        scan_indicators(series, Periods(rsi=period))
        .filter("rsi is not null")
        .select("crypto_id", "event_timestamp", F.round("rsi", 4).alias("rsi"))
    )


def macd(series: Series, fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    return (
        scan_indicators(series, Periods(fast=fast, slow=slow, signal=signal))
        .filter("macd is not null")
        .select(
            "crypto_id",
            "event_timestamp",
            *[F.round(c, 6).alias(c) for c in ("macd", "signal", "histogram")],
        )
    )


def technical_analysis(series: Series, periods: Periods = Periods()) -> DataFrame:
    """SMA, RSI, Bollinger bands and MACD side by side, one row per price."""
    digits = {"rsi": 4}
    return scan_indicators(series, periods).select(
        "crypto_id",
        "event_timestamp",
        "price_usd",
        *[F.round(c, digits.get(c, 6)).alias(c) for c in _OUT],
    )


def _type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def _runs(batch: pd.DataFrame, key: str) -> Iterator[pd.DataFrame]:
    """Stretches of one (key, segment) in a sorted batch."""
    if batch.empty:
        return
    same = (batch[key] == batch[key].shift()) & (batch[SEG] == batch[SEG].shift())
    starts = np.flatnonzero(~same.to_numpy())
    for a, b in zip(starts, [*starts[1:], len(batch)]):
        yield batch.iloc[a:b]


def _smooth(start: float, values: np.ndarray, alpha: float) -> np.ndarray:
    """y = (1 - alpha) * y + alpha * value, begun at `start`."""
    chain = pd.Series(np.concatenate([[start], values]))
    return chain.ewm(alpha=alpha, adjust=False).mean().to_numpy()[1:]


def _wilder(start: float, moves: np.ndarray, before: int, period: int) -> np.ndarray:
    """Mean of the first `period` moves, smoothed with 1 / period afterwards."""
    warm = int(np.clip(period - before, 0, len(moves)))
    head = start + np.cumsum(moves[:warm]) / period
    return np.concatenate(
        [head, _smooth(head[-1] if warm else start, moves[warm:], 1.0 / period)]
    )


def _ema(start: float, values: np.ndarray, span: int, fresh: bool) -> np.ndarray:
    alpha = 2.0 / (span + 1)
    if fresh:
        return np.concatenate([values[:1], _smooth(values[0], values[1:], alpha)])
    return _smooth(start, values, alpha)


def _advance(state: State, x: np.ndarray, p: Periods) -> tuple[dict[str, np.ndarray], State]:
    """Indicator values of a stretch of prices and the state after it."""
    n, fresh = len(x), state.seen == 0
    history = np.concatenate([state.tail, x])

    # A first price has no move; every later one has exactly one.
    moves = np.diff(x if fresh else np.concatenate([state.tail[-1:], x]))
    before = max(state.seen - 1, 0)
    gain = _wilder(state.gain, np.maximum(moves, 0.0), before, p.rsi)
    loss = _wilder(state.loss, np.maximum(-moves, 0.0), before, p.rsi)
    with np.errstate(divide="ignore", invalid="ignore"):
        strength = np.where(loss == 0, 100.0, 100.0 - 100.0 / (1.0 + gain / loss))
    strength[before + np.arange(len(moves)) < p.rsi] = np.nan
    if fresh:
        strength = np.concatenate([[np.nan], strength])

    fast = _ema(state.averages[0], x, p.fast, fresh)
    slow = _ema(state.averages[1], x, p.slow, fresh)
    line = fast - slow
    signal = _ema(state.averages[2], line, p.signal, fresh)

    mean, std = np.full(n, np.nan), np.full(n, np.nan)
    if len(history) >= p.window:
        frames = np.lib.stride_tricks.sliding_window_view(history, p.window)[-n:]
        mean[-len(frames):] = frames.mean(axis=1)
        std[-len(frames):] = frames.std(axis=1, ddof=1)

    values = {
        "sma": mean,
        "upper": mean + p.num_std * std,
        "middle": mean,
        "lower": mean - p.num_std * std,
        "rsi": strength,
        "macd": line,
        "signal": signal,
        "histogram": line - signal,
    }
    after = State(
        state.seen + n,
        gain[-1] if len(gain) else state.gain,
        loss[-1] if len(loss) else state.loss,
        np.array([fast[-1], slow[-1], signal[-1]]),
        history[-max(p.window - 1, 1):],
    )
    return values, after


def _carried_states(rows: DataFrame, series: Series, p: Periods) -> DataFrame:
    """The state each segment starts from: one row per segment of a long series."""
    key = series.keys[0]
    warm = p.rsi + 2
    # `_length` keeps the window, and with it the shuffle and the sort the main pass uses as well.
    long_rows = rows.filter(F.col(CUT_ROWS) > 0).select(
        key, SEG, series.order, "price_usd", "_length"
    )

    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each segment alone: row count, first prices and the state after it.

        Segments after the first begin with zero averages; `chain` adds their true start.
        """
        current, state, first, done = None, State(), np.empty(0), []

        def close() -> None:
            n = state.seen - (warm if current[1] else 0)
            own = State(n, state.gain, state.loss, state.averages, state.tail[-n:])
            done.append((*current, own.text(first=first.tolist())))

        for batch in batches:
            for part in _runs(batch, key):
                group = (part[key].iat[0], int(part[SEG].iat[0]))
                x = part["price_usd"].to_numpy()
                if group != current:
                    if current is not None:
                        close()
                    current, first = group, np.empty(0)
                    state = State(warm, tail=x[:1]) if group[1] else State()
                first = np.concatenate([first, x])[: p.rsi]
                _, state = _advance(state, x, p)
        if current is not None:
            close()
        if done:
            yield pd.DataFrame(done, columns=[key, SEG, "_summary"])

    def carried(start: float, moves: np.ndarray, own: float, n: int, warm: int) -> float:
        """The smoothed mean after a segment of `n` moves.

        `own` is the segment's share if all its moves but the first, which leads into it, were smoothed. The first
        `warm` moves of a series are only summed up, so theirs is taken out of it and put in as a plain mean.
        """
        keep = 1 - 1.0 / p.rsi
        smoothed = moves / p.rsi * keep ** (n - 1 - np.arange(len(moves), dtype=float))
        if not warm:
            return start * keep**n + smoothed[0] + own
        return (start + moves[:warm].sum() / p.rsi) * keep ** (n - warm) + own - smoothed[1:warm].sum()

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        """Hand the state from segment to segment; one row per segment, so this stays small."""
        state, out = None, []
        for name, seg, summary in pdf.sort_values(SEG).itertuples(index=False):
            own, first = State.of(summary), np.array(json.loads(summary)["first"])
            if state is None:
                state = own
                continue
            out.append((name, seg, state.text()))
            n = own.seen
            moves = np.diff(np.concatenate([state.tail[-1:], first]))
            warm = int(np.clip(p.rsi - max(state.seen - 1, 0), 0, n))
            state = State(
                state.seen + n,
                carried(state.gain, np.maximum(moves, 0.0), own.gain, n, warm),
                carried(state.loss, np.maximum(-moves, 0.0), own.loss, n, warm),
                np.linalg.matrix_power(p.step(), n) @ state.averages + own.averages,
                np.concatenate([state.tail, own.tail])[-max(p.window - 1, 1):],
            )
        return pd.DataFrame(out, columns=[key, SEG, "_carried"])

    summaries = long_rows.sortWithinPartitions(key, SEG, series.order).mapInPandas(
        summarise, f"{key} string, {SEG} int, _summary string"
    )
    return summaries.groupBy(key).applyInPandas(chain, f"{key} string, {SEG} int, _carried string")


ship_with_jobs(__name__)
