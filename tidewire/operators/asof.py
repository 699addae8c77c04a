"""As-of join of a time series onto window rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.basics import hour_floor, hours
from tidewire.operators.ordered import carry_forward, month_of


def ceil_hour(ts: Column) -> Column:
    floor = hour_floor(ts)
    return F.when(floor < ts, floor + hours(1)).otherwise(floor)


@dataclass(frozen=True)
class Series:
    """A time series to look up.

    A reading is (condition, value): the value of the latest row that meets the condition and has
    `time <= window_start + lookahead_hours`, also when that value is NULL.
    """

    rows: DataFrame
    time: str
    readings: Mapping[str, tuple[Column, Column]]
    lookahead_hours: int = 1

    def hourly(self) -> DataFrame:
        """The last readings of each hour. Partial aggregation takes a hot hour apart."""
        boxes = [
            F.max(
                F.when(met, F.struct(F.col(self.time).alias("_t"), value.alias("_v")))
            ).alias(name)
            for name, (met, value) in self.readings.items()
        ]
        at = ceil_hour(F.col(self.time)) - hours(self.lookahead_hours)
        return self.rows.withColumn("window_start", at).groupBy("window_start").agg(*boxes)


def latest_row(rows: DataFrame, time: str, values: Sequence[str], lookahead_hours: int = 1) -> Series:
    """A series of which all `values` are read from the same, latest row."""
    row = F.struct(*[F.col(v) for v in values])
    return Series(rows, time, {f"_row_{values[0]}": (F.lit(True), row)}, lookahead_hours)


def asof_lookup(windows: DataFrame, *series: Series) -> DataFrame:
    """`window_start` and every reading as of each window; one row per distinct `window_start`.

    There is no range join: each series is reduced to its last rows per hour, all of them and the
    windows are unioned, and the readings are carried forward in one pass.
    """
    names = [name for one in series for name in one.readings]
    merged = windows.select("window_start").withColumn("_asked", F.lit(1))
    for one in series:
        hourly = one.hourly().withColumn("_asked", F.lit(0))
        merged = merged.unionByName(hourly, allowMissingColumns=True)
    filled = carry_forward(
        merged, names, [], ["window_start", "_asked"], month_of(F.col("window_start"))
    )
    values = []
    for one in series:
        for name in one.readings:
            found = F.col(f"{name}._v")
            values.append(F.col(f"{name}._v.*") if name.startswith("_row_") else found.alias(name))
    return filled.where("_asked = 1").select("window_start", *values)


def asof_join(windows: DataFrame, *series: Series) -> DataFrame:
    """Add the readings to each window; `windows` has one row per `window_start`.

    The windows are read twice, so let them be a stored table or a calendar.
    """
    return windows.join(asof_lookup(windows, *series), "window_start", "left")
