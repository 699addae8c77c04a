"""Landed market tables with text columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.schemas import CANDLE


def cast_candles(landed: DataFrame, epoch_millis: str | None = None) -> DataFrame:
    """Text prices to the candle schema; unreadable numbers become NULL.

    `epoch_millis` names a column with the open time in milliseconds.
    """
    if epoch_millis is not None:
        moment = F.timestamp_millis(F.col(epoch_millis).try_cast("bigint"))
        utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), moment.cast("timestamp_ntz"))
        landed = landed.withColumn("open_time", utc)
    return landed.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in CANDLE.fields])
