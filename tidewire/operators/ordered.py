"""Ordered computations that never need a whole series in one task.

A plain `Window.partitionBy(key)` puts every row of a key on one core. The helpers here cut each
series into chunks along its order and carry the missing context over the cuts, so results equal the
unbounded window while no task holds more than one chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def month_of(ts: Column) -> Column:
    """Chunk number that grows with time."""
    return F.year(ts) * 12 + F.month(ts)


def _attach(df: DataFrame, summary: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Left join one row per chunk back to the rows; NULL keys match each other."""
    right = summary.select(*[F.col(k).alias(f"_r_{k}") for k in keys], value)
    condition = F.lit(True)
    for k in keys:
        condition = condition & df[k].eqNullSafe(right[f"_r_{k}"])
    return df.join(right, condition, "left").drop(*[f"_r_{k}" for k in keys])


def row_index(
    df: DataFrame, by: Sequence[str], order: Sequence[str], chunk: Column, name: str = "_idx"
) -> DataFrame:
    """0-based position of each row in its series. `chunk` must not decrease along `order`."""
    by = list(by)
    chunked = df.withColumn("_chunk", chunk)
    running = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        chunked.groupBy(*by, "_chunk")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(running), F.lit(0)))
    )
    inside = Window.partitionBy(*by, "_chunk").orderBy(*order)
    return (
        _attach(chunked, offsets, [*by, "_chunk"], "_offset")
        .withColumn(name, F.col("_offset") + F.row_number().over(inside) - 1)
        .drop("_chunk", "_offset")
    )


def overlapping_blocks(df: DataFrame, size: int, overlap: int, index: str = "_idx") -> DataFrame:
    """Cut indexed series into blocks of `size` rows, each led by the `overlap` rows before it.

    Adds `_block` and `_own`; window functions that look back at most `overlap` rows are exact on
    (series, _block) for the rows with `_own`. The rows without it are copies to be dropped after.
    """
    if not 0 <= overlap <= size:
        raise ValueError("overlap must lie between 0 and size")
    block = F.floor(F.col(index) / size)
    following = F.floor((F.col(index) + overlap) / size)

    def place(number: Column, own: bool) -> Column:
        return F.struct(number.alias("_block"), F.lit(own).alias("_own"))

    places = F.when(following > block, F.array(place(block, True), place(following, False)))
    return (
        df.withColumn("_place", F.explode(places.otherwise(F.array(place(block, True)))))
        .select("*", "_place.*")
        .drop("_place")
    )


def previous_value(
    df: DataFrame, value: str, by: Sequence[str], order: str, chunk: Column, name: str
) -> DataFrame:
    """`lag(value)` over (by, order), computed chunk by chunk."""
    by = list(by)
    boxed = F.struct(F.col(order), F.col(value))
    chunked = df.withColumn("_chunk", chunk)
    lasts = chunked.groupBy(*by, "_chunk").agg(F.max(boxed).alias("_last"))
    carried = lasts.withColumn(
        "_carry", F.lag("_last").over(Window.partitionBy(*by).orderBy("_chunk"))
    )
    inside = Window.partitionBy(*by, "_chunk").orderBy(order)
    return (
        _attach(chunked, carried, [*by, "_chunk"], "_carry")
        .withColumn(name, F.coalesce(F.lag(boxed).over(inside), F.col("_carry"))[value])
        .drop("_chunk", "_carry")
    )


def carry_forward(
    df: DataFrame, values: Sequence[str], by: Sequence[str], order: Sequence[str], chunk: Column
) -> DataFrame:
    """Fill each of `values` with its latest non-NULL value at or before the row, chunk by chunk."""
    by = list(by)
    chunked = df.withColumn("_chunk", chunk)

    def boxed(value: str) -> Column:
        box = F.struct(*[F.col(o) for o in order], F.col(value))
        return F.max(F.when(F.col(value).isNotNull(), box)).alias(value)

    lasts = chunked.groupBy(*by, "_chunk").agg(*[boxed(v) for v in values])
    before = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.select(
        *by,
        "_chunk",
        F.struct(*[
            F.last(v, ignorenulls=True).over(before)[v].alias(v) for v in values
        ]).alias("_carry"),
    )
    inside = (
        Window.partitionBy(*by, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        _attach(chunked, carried, [*by, "_chunk"], "_carry")
        .withColumns({
            v: F.coalesce(F.last(v, ignorenulls=True).over(inside), F.col(f"_carry.{v}"))
            for v in values
        })
        .drop("_chunk", "_carry")
    )
