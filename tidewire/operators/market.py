"""Candle indicators and macro series.

Every indicator looks back over at most 100 candles. A symbol's series is cut into blocks that repeat
the 99 candles before them, so indicators of one long series are computed by many tasks, exactly.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire import fixed_values as fv
from tidewire.config import DEFAULT_CONFIG
from tidewire.functions.basics import bind, hours, literal_array, round_dp
from tidewire.operators.asof import Series, asof_join, latest_row
from tidewire.operators.ordered import month_of, overlapping_blocks, previous_value, row_index

BLOCK_ROWS = 20_000
KEY = ("symbol", "_block")


def _series() -> Window:
    return Window.partitionBy(*KEY).orderBy("_idx")


def _last(n: int) -> Window:
    return _series().rowsBetween(-(n - 1), 0)


def candle_blocks(candles: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    indexed = row_index(candles, ["symbol"], ["open_time"], month_of(F.col("open_time")))
    return overlapping_blocks(indexed, block_rows, fv.CANDLE_ROWS - 1)


def own_rows(blocks: DataFrame) -> DataFrame:
    """Drop the repeated candles after the window functions ran."""
    return blocks.where("_own").drop("_own", "_block", "_idx")


def seen(limit: int = fv.CANDLE_ROWS) -> Column:
    """Candles up to this one, at most `limit`."""
    return F.least(F.col("_idx") + 1, F.lit(limit))


def when_enough(rows: int, value: Column) -> Column:
    return F.when(seen() >= rows, value)


def n_row_return(n: int) -> Column:
    """last / close[-n] - 1: it spans n - 1 intervals and needs n candles."""
    return when_enough(n, F.try_divide("close", F.lag("close", n - 1).over(_series())) - 1)


def rolling_mean(column: str, n: int) -> Column:
    return when_enough(n, F.avg(column).over(_last(n)))


def rsi(n: int = 14) -> Column:
    """Simple-mean RSI over the column `_change`; NULL on a flat series, 100 without losses."""
    gain = F.avg(F.greatest("_change", F.lit(0.0))).over(_last(n))
    loss = F.avg(F.greatest(-F.col("_change"), F.lit(0.0))).over(_last(n))
    value = (
        F.when((loss == 0) & (gain == 0), F.lit(None).cast("double"))
        .when(loss == 0, 100.0)
        .otherwise(100 - 100 / (1 + F.try_divide(gain, loss)))
    )
    return when_enough(n + 1, value)


def with_change(blocks: DataFrame) -> DataFrame:
    return blocks.withColumn(
        "_change", F.coalesce(F.col("close") - F.lag("close").over(_series()), F.lit(0.0))
    )


def bollinger_position(n: int = 20) -> Column:
    mean, std = F.avg("close").over(_last(n)), F.stddev_samp("close").over(_last(n))
    low, width = mean - 2 * std, 4 * std
    value = F.when(width == 0, 0.5).otherwise(F.try_divide(F.col("close") - low, width))
    return when_enough(n, value)


def volume_ratio(n: int = 20) -> Column:
    return when_enough(n, F.try_divide("volume", F.avg("volume").over(_last(n))))


def recent(column: str = "close", rows: int = fv.CANDLE_ROWS) -> Column:
    """The last candles, oldest first; the array never exceeds `rows`."""
    return F.collect_list(column).over(_last(rows))


def _ema_step(state: Column, name: str, x: Column, span: int) -> list[Column]:
    """Numerator and denominator of a bias-adjusted EMA after one more value."""
    keep = 1 - 2 / (span + 1)
    return [
        (state[f"{name}_n"] * keep + x).alias(f"{name}_n"),
        (state[f"{name}_d"] * keep + 1).alias(f"{name}_d"),
    ]


def _zeros(*names: str) -> list[Column]:
    return [F.lit(0.0).alias(f"{n}_{part}") for n in names for part in "nd"]


def ema(values: Column, span: int) -> Column:
    """Bias-adjusted exponential mean of an array at its last element."""
    return F.aggregate(
        values,
        F.struct(*_zeros("e")),
        lambda state, x: F.struct(*_ema_step(state, "e", x, span)),
        lambda state: F.try_divide(state["e_n"], state["e_d"]),
    )


def macd_histogram(values: Column, fast: int = 12, slow: int = 26, signal: int = 9) -> Column:
    """(fast EMA - slow EMA) minus its own EMA, in one fold over the array."""
    def step(state: Column, x: Column) -> Column:
        averages = F.struct(*_ema_step(state, "f", x, fast), *_ema_step(state, "s", x, slow))

        def with_line(a: Column) -> Column:
            line = a["f_n"] / a["f_d"] - a["s_n"] / a["s_d"]
            return F.struct(
                *[a[c].alias(c) for c in ("f_n", "f_d", "s_n", "s_d")],
                *_ema_step(state, "g", line, signal),
                line.alias("line"),
            )

        return bind(averages, with_line)

    return F.aggregate(
        values,
        F.struct(*_zeros("f", "s", "g"), F.lit(0.0).alias("line")),
        step,
        lambda state: state["line"] - F.try_divide(state["g_n"], state["g_d"]),
    )


def macd_weights(rows: int = fv.CANDLE_ROWS, fast: int = 12, slow: int = 26, signal: int = 9) -> list[float]:
    """What each value of a full frame, oldest first, adds to `macd_histogram`.

    The averages inside a frame start with the frame, so line and histogram of a frame of given size are linear
    in its values, with the same weights wherever the frame lies. They are no sum of powers (the bias adjustment
    divides by another number at each place), so frames cannot be updated row by row as plain averages can.
    """
    def smoothed(xs: list[float], span: int) -> list[float]:
        keep, n, d, out = 1 - 2 / (span + 1), 0.0, 0.0, []
        for x in xs:
            n, d = n * keep + x, d * keep + 1
            out.append(n / d)
        return out

    weights = []
    for place in range(rows):
        one = [float(i == place) for i in range(rows)]
        line = [a - b for a, b in zip(smoothed(one, fast), smoothed(one, slow), strict=True)]
        weights.append(line[-1] - smoothed(line, signal)[-1])
    return weights


def macd_of_frames(values: Column, rows: int = fv.CANDLE_ROWS, least: int = 26) -> Column:
    """The histogram of frames of more than `least` values: full frames by their weights, shorter ones by the fold."""
    weighted = F.zip_with(values, literal_array(macd_weights(rows)), lambda x, w: x * w)
    full = F.aggregate(weighted, F.lit(0.0), lambda total, x: total + x)
    return F.when(F.size(values) == rows, full).when(F.size(values) > least, macd_histogram(values))


def with_ema(
    candles: DataFrame, spans: Mapping[str, int], column: str = "close", rows: int = fv.CANDLE_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add bias-adjusted exponential means over the last `rows` candles, one column per span, in linear time.

    A series is cut into chunks of `rows`. In a chunk, sums of values over powers of the decay run on from
    its start; a frame is the start of its own chunk up to the row and the end of the chunk before from the row after
    the one at the same place. The second is the chunk's total without the sum up to there, read `rows` - 1
    rows back, so a row costs a few additions and no frame is ever collected. Candles without a value are left out.
    """
    blocks = candle_blocks(candles.where(F.col(column).isNotNull()), block_rows)
    chunked = blocks.withColumns({"_chunk": F.floor(F.col("_idx") / rows), "_place": F.col("_idx") % rows})
    chunk = Window.partitionBy(*KEY, "_chunk")
    so_far = chunk.orderBy("_idx").rowsBetween(Window.unboundedPreceding, 0)
    for name, span in spans.items():
        keep = 1 - 2 / (span + 1)
        grown = F.col(column) * F.pow(F.lit(1 / keep), F.col("_place"))
        chunked = chunked.withColumns({"_sum": F.sum(grown).over(so_far), "_rest": F.sum(grown).over(chunk) + grown}).withColumn(
            "_rest", F.lag(F.col("_rest") - F.col("_sum"), rows - 1).over(_series())
        )
        before = F.when(F.col("_place") < rows - 1, F.coalesce("_rest", F.lit(0.0))).otherwise(0.0)
        numerator = F.pow(F.lit(keep), F.col("_place")) * (F.col("_sum") + before * keep**rows)
        weight = (1 - F.pow(F.lit(keep), seen(rows))) / (1 - keep)
        chunked = chunked.withColumn(name, numerator / weight)
    return own_rows(chunked.drop("_chunk", "_place", "_sum", "_rest"))


def market_features(candles: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Price features at every candle of every symbol, all from one pass over the blocks."""
    blocks = with_change(candle_blocks(candles, block_rows))
    measured = blocks.withColumns({
        "btc_return_6h": n_row_return(6),
        "btc_return_24h": n_row_return(24),
        "rsi_14": rsi(14),
        "bb_position": bollinger_position(20),
        "volume_ratio": volume_ratio(20),
        "_recent": recent(),
    })
    return own_rows(measured).select(
        "symbol",
        "open_time",
        *[F.col(c).alias(f"btc_{c}") for c in ("open", "close", "high", "low", "volume")],
        "btc_return_6h",
        "btc_return_24h",
        "rsi_14",
        macd_of_frames(F.col("_recent")).alias("macd"),
        "bb_position",
        "volume_ratio",
        F.lit(None).cast("double").alias("etf_net_flow_24h"),
    )


def candle_frame(windows: DataFrame, candles: DataFrame) -> DataFrame:
    """OHLCV of the last candle opened at or before each window start."""
    values = ["open_time", "open", "high", "low", "close", "volume"]
    return asof_join(windows, latest_row(candles, "open_time", values, lookahead_hours=0))


def daily_return(macro_daily: DataFrame) -> DataFrame:
    """Add `daily_return`, the change against the ticker's previous row, 6 decimals."""
    before = previous_value(
        macro_daily, "close", ["ticker"], "day", F.year("day"), "_before"
    )
    change = F.try_divide(F.col("close") - F.col("_before"), F.col("_before"))
    return before.withColumn("daily_return", round_dp(change, 6)).drop("_before")


def macro_series(
    macro_daily: DataFrame, tickers: Mapping[str, Sequence[str]], known_after_hours: int = 24
) -> Series:
    """Per output column and ticker: the last close (4 decimals), or the last daily return.

    A day's close is known `known_after_hours` after the day's midnight: with 24 at the day's end.
    """
    rows = daily_return(macro_daily).withColumns({
        "_ts": F.col("day").cast("timestamp_ntz") + hours(known_after_hours),
        "close": round_dp(F.col("close"), 4),
    })
    readings = {}
    for column, choices in tickers.items():
        value = F.col("daily_return" if column.endswith("_return_1d") else "close")
        for i, ticker in enumerate(choices):
            readings[f"_{column}_{i}"] = (F.col("ticker") == ticker, value)
    return Series(rows, "_ts", readings)


def choose_tickers(df: DataFrame, tickers: Mapping[str, Sequence[str]]) -> DataFrame:
    """The first usable reading per output column; 0.0 is usable only from the last ticker."""
    def choose(column: str, n: int) -> Column:
        names = [f"_{column}_{i}" for i in range(n)]
        return F.coalesce(*[F.nullif(F.col(c), F.lit(0.0)) for c in names[:-1]], F.col(names[-1]))

    read = [f"_{column}_{i}" for column, choices in tickers.items() for i in range(len(choices))]
    return df.withColumns({c: choose(c, len(t)) for c, t in tickers.items()}).drop(*read)


def macro_asof(
    windows: DataFrame,
    macro_daily: DataFrame,
    tickers: Mapping[str, Sequence[str]] = DEFAULT_CONFIG.macro_tickers,
    known_after_hours: int = 24,
) -> DataFrame:
    """Latest macro readings known at each window's end."""
    series = macro_series(macro_daily, tickers, known_after_hours)
    return choose_tickers(asof_join(windows, series), tickers)


def json_number(body: Column, path: str) -> Column:
    """A number out of a JSON snapshot, or NULL."""
    return F.get_json_object(body, path).try_cast("double")


# Where a snapshot of each kind holds its number.
SNAPSHOT_PATHS = {
    "btc_dominance": "$.data.market_cap_percentage.btc",
    "fear_greed_index": "$.data[0].value",
}


def snapshot_values(snapshots: DataFrame) -> DataFrame:
    """(ts, body) to (ts, btc_dominance, fear_greed_index)."""
    return snapshots.select(
        "ts", *[json_number(F.col("body"), path).alias(name) for name, path in SNAPSHOT_PATHS.items()]
    )


def snapshot_series(snapshots: DataFrame) -> Series:
    """The latest reading of each kind by itself: a snapshot of one kind does not hide the other."""
    values = {name: json_number(F.col("body"), path) for name, path in SNAPSHOT_PATHS.items()}
    return Series(snapshots, "ts", {name: (value.isNotNull(), value) for name, value in values.items()})
