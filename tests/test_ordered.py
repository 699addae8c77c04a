"""Chunked ordered operators against plain Python, on series with gaps and one dominant key."""

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewire.operators import market as mk
from tidewire.operators.asof import asof_join, latest_row
from tidewire.operators.ordered import carry_forward, overlapping_blocks, previous_value, row_index
from tidewire.operators.windows import with_hourly_momentum, with_momentum

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def series(spark):
    rng = random.Random(3)
    rows = []
    for key, n in (("hot", 400), ("a", 60), ("b", 1), (None, 30)):
        t = 0
        for _ in range(n):
            t += rng.choice([1, 1, 2, 40, 900])
            rows.append((key, t, rng.choice([None, float(rng.randint(0, 9))])))
    return rows, spark.createDataFrame(rows, "k string, t long, v double")


def by_key(rows):
    groups = {}
    for key, t, v in sorted(rows, key=lambda r: (r[0] or "", r[1])):
        groups.setdefault(key, []).append((t, v))
    return groups


def chunk():
    return F.floor(F.col("t") / 100)


def test_row_index(series):
    rows, df = series
    got = {(r.k, r.t): r._idx for r in row_index(df, ["k"], ["t"], chunk()).collect()}
    expected = {(k, t): i for k, items in by_key(rows).items() for i, (t, _) in enumerate(items)}
    assert got == expected


def test_previous_value(series):
    rows, df = series
    got = {(r.k, r.t): r.p for r in previous_value(df, "v", ["k"], "t", chunk(), "p").collect()}
    expected = {
        (k, t): items[i - 1][1] if i else None
        for k, items in by_key(rows).items() for i, (t, _) in enumerate(items)
    }
    assert got == expected


def test_carry_forward(series):
    rows, df = series
    got = {(r.k, r.t): r.v for r in carry_forward(df, ["v"], ["k"], ["t"], chunk()).collect()}
    expected = {}
    for k, items in by_key(rows).items():
        last = None
        for t, v in items:
            last = v if v is not None else last
            expected[k, t] = last
    assert got == expected


def test_blocks_hold_the_rows_before_them(series):
    _, df = series
    indexed = row_index(df, ["k"], ["t"], chunk())
    blocks = overlapping_blocks(indexed, 10, 4).where("k = 'hot'").collect()
    own = [r for r in blocks if r._own]
    assert len(own) == 400 and len({r._idx for r in own}) == 400
    for number in {r._block for r in blocks}:
        indexes = sorted(r._idx for r in blocks if r._block == number)
        first = max(0, number * 10 - 4)
        assert indexes == list(range(first, min(number * 10 + 10, 400)))


def test_asof(spark):
    windows = [(START + timedelta(hours=h),) for h in range(0, 2000, 7)]
    rng = random.Random(5)
    times = sorted(rng.sample(range(0, 1500 * 3600, 1800), 60))
    readings = [(START + timedelta(seconds=s), None if i % 7 == 0 else float(i)) for i, s in enumerate(times)]
    w = spark.createDataFrame(windows, "window_start timestamp_ntz")
    s = spark.createDataFrame(readings, "ts timestamp_ntz, v double")
    for ahead in (0, 1):
        got = {r.window_start: r.v for r in asof_join(w, latest_row(s, "ts", ["v"], ahead)).collect()}
        for (start,) in windows:
            seen = [v for t, v in readings if t <= start + timedelta(hours=ahead)]
            assert got[start] == (seen[-1] if seen else None)


def test_momentum_forms_agree(spark):
    rows = [(START + timedelta(hours=h), round(math.sin(h), 4)) for h in range(1500)]
    df = spark.createDataFrame(rows, "window_start timestamp_ntz, avg_sentiment double")
    a, b = (
        {r.window_start: r.sentiment_momentum for r in f(df).collect()}
        for f in (with_momentum, with_hourly_momentum)
    )
    assert a == b and a[START] == 0.0
    assert a[rows[800][0]] == pytest.approx(rows[800][1] - rows[799][1], abs=1e-4)


def model(frame: pd.DataFrame) -> pd.DataFrame:
    """Each row from the at most 100 candles up to it."""
    out = []
    for i in range(len(frame)):
        part = frame.iloc[max(0, i - 99): i + 1]
        close, volume = part["close"].reset_index(drop=True), part["volume"].reset_index(drop=True)
        change = close.diff().fillna(0.0)
        gain, loss = change.clip(lower=0).tail(14).mean(), (-change).clip(lower=0).tail(14).mean()
        strength = np.nan if gain == 0 and loss == 0 else 100.0 if loss == 0 else 100 - 100 / (1 + gain / loss)
        fast, slow = (close.ewm(span=n).mean() for n in (12, 26))
        line = fast - slow
        mean, std = close.tail(20).mean(), close.tail(20).std()
        out.append({
            "btc_return_6h": close.iloc[-1] / close.iloc[-6] - 1 if len(close) >= 6 else np.nan,
            "btc_return_24h": close.iloc[-1] / close.iloc[-24] - 1 if len(close) >= 24 else np.nan,
            "rsi_14": strength if len(close) > 14 else np.nan,
            "macd": (line - line.ewm(span=9).mean()).iloc[-1] if len(close) > 26 else np.nan,
            "bb_position": np.nan if len(close) < 20 else 0.5 if std == 0
            else (close.iloc[-1] - (mean - 2 * std)) / (4 * std),
            "volume_ratio": volume.iloc[-1] / volume.tail(20).mean() if len(close) >= 20 else np.nan,
        })
    return pd.DataFrame(out)


@pytest.mark.parametrize("block_rows", [99, 150, 20_000])
def test_indicators(spark, block_rows):
    rng = np.random.default_rng(7)
    frames = []
    for symbol, close in {
        "walk": 100 + rng.normal(0, 1, 330).cumsum(), "flat": np.full(40, 5.0),
        "up": np.arange(1.0, 41.0), "short": np.arange(1.0, 6.0),
    }.items():
        hours = np.cumsum(rng.integers(1, 60, len(close)))
        frames.append(pd.DataFrame({
            "symbol": symbol, "open_time": [START + timedelta(hours=int(h)) for h in hours],
            "open": close, "high": close, "low": close, "close": close,
            "volume": rng.integers(1, 100, len(close)).astype(float),
        }))
    schema = ("symbol string, open_time timestamp_ntz, open double, high double, low double, close double, "
              "volume double")
    candles = spark.createDataFrame(pd.concat(frames), schema)
    got = mk.market_features(candles, block_rows).toPandas().sort_values(["symbol", "open_time"])
    for frame in frames:
        symbol = frame["symbol"].iloc[0]
        ours = got[got["symbol"] == symbol].reset_index(drop=True)
        assert len(ours) == len(frame)
        expected = model(frame)
        for column in expected:
            np.testing.assert_allclose(
                ours[column].astype(float), expected[column].astype(float), atol=1e-9, err_msg=f"{symbol} {column}"
            )


@pytest.mark.parametrize("block_rows", [99, 150, 20_000])
def test_linear_ema_equals_fold(spark, block_rows):
    rng = np.random.default_rng(11)
    rows = [(s, START + timedelta(hours=i), float(x)) for s, n in (("long", 730), ("short", 7)) for i, x in enumerate(1e5 + rng.normal(0, 1e3, n))]
    rows.append(("long", START + timedelta(hours=5, minutes=1), None))
    candles = spark.createDataFrame(rows, "symbol string, open_time timestamp_ntz, close double")
    got = mk.with_ema(candles, {"a": 12, "b": 26, "c": 9}, block_rows=block_rows).toPandas()
    assert list(got.columns) == ["symbol", "open_time", "close", "a", "b", "c"] and len(got) == len(rows) - 1
    for symbol, part in got.sort_values("open_time").groupby("symbol"):
        close = part["close"].tolist()
        for name, span in (("a", 12), ("b", 26), ("c", 9)):
            expected = [pd.Series(close[max(0, k - 99): k + 1]).ewm(span=span).mean().iloc[-1] for k in range(len(close))]
            np.testing.assert_allclose(part[name], expected, rtol=1e-12, err_msg=f"{symbol} {name}")


def test_macd_weights_equal_fold(spark):
    rng = np.random.default_rng(12)
    frames = [(rng.normal(3e4, 2e3, n).tolist(),) for n in (100, 100, 27, 26, 99)]
    got = spark.createDataFrame(frames, "x array<double>").select(
        mk.macd_of_frames(F.col("x")).alias("w"), mk.macd_histogram(F.col("x")).alias("f"), F.size("x").alias("n")
    ).collect()
    for r in got:
        assert (r.w is None) == (r.n <= 26) and (r.w is None or abs(r.w - r.f) < 1e-9)


def test_macro_fallback(spark):
    days = [datetime(2024, 1, d).date() for d in (1, 2, 3)]
    rows = [("A", days[0], 0.0), ("B", days[0], 7.0), ("A", days[1], 5.0), ("S", days[2], 4.0)]
    macro = spark.createDataFrame(rows, "ticker string, day date, close double")
    tickers = {"dxy": ("A", "B"), "gold_price": ("Z",), "sp500_return_1d": ("S",), "us_10y_yield": ("A",)}
    windows = spark.createDataFrame(
        [(datetime(2024, 1, 1, 22),), (datetime(2024, 1, 1, 23),), (datetime(2024, 1, 5),)],
        "window_start timestamp_ntz",
    )
    got = {r.window_start: r for r in mk.macro_asof(windows, macro, tickers).collect()}
    assert got[datetime(2024, 1, 1, 22)].dxy is None
    assert got[datetime(2024, 1, 1, 23)].dxy == 7.0
    assert got[datetime(2024, 1, 1, 23)].us_10y_yield == 0.0
    assert got[datetime(2024, 1, 5)].dxy == 5.0
    assert got[datetime(2024, 1, 5)].gold_price is None
    assert got[datetime(2024, 1, 5)].sp500_return_1d is None
