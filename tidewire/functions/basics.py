"""Small helpers shared by the other function modules."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` evaluated once per row.

    Inside a lambda an outer expression is evaluated per element; going through a one-element array
    makes it a lambda variable, so a lower-cased text is lower-cased once and not once per keyword.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def round_dp(value: Column, places: int) -> Column:
    """Decimal rounding, half up on the 12-digit decimal of the double.

    Going through DECIMAL removes the last-bit noise of differently ordered floating sums, so a
    result does not depend on how rows were partitioned.
    """
    return F.round(value.cast("decimal(38,12)"), places).cast("double")


def sql_literal(value: object) -> str:
    if isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    return f"{value!r}D" if isinstance(value, float) else repr(value)


def literal_array(values: Iterable[object]) -> Column:
    """An array constant, parsed from one SQL text in place of one call per element."""
    return F.expr(f"array({', '.join(map(sql_literal, values))})")


def literal_map(mapping: Mapping[str, object]) -> Column:
    pairs = (sql_literal(x) for pair in mapping.items() for x in pair)
    return F.expr(f"map({', '.join(pairs)})")


def hour_floor(ts: Column) -> Column:
    """Start of the hour of a TIMESTAMP_NTZ, by field arithmetic, so no session zone is involved."""
    return ts - F.make_dt_interval(F.lit(0), F.lit(0), F.minute(ts), F.extract(F.lit("SECOND"), ts))


def to_millis(ts: Column) -> Column:
    """Milliseconds since 1970 of a TIMESTAMP_NTZ holding UTC; the inverse of `cast_candles`' reading."""
    minutes = (F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint") * 24 + F.hour(ts)) * 60
    return (minutes + F.minute(ts)) * 60_000 + F.floor(F.extract(F.lit("SECOND"), ts) * 1000).cast(
        "bigint"
    )


def hours(n: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(n))
