"""Run registered queries and their SQL on the same folder and compare all values.

`python -m tests.oracle_check [folder] [name ...]` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from __spark_entry__ import oracle_sql, queries


def duck_connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for name in df.columns:
        if pd.api.types.is_datetime64_any_dtype(df[name]):
            df[name] = df[name].astype("datetime64[us]")
        elif df[name].dtype == object:
            df[name] = df[name].map(lambda v: None if v is None or v is pd.NaT or v != v else str(v))
    rows = df.astype(str)
    return df.loc[rows.sort_values(list(rows.columns)).index].reset_index(drop=True)


def differences(spark: SparkSession, con, folder: str, name: str) -> str | None:
    ours = canonical(queries()[name](spark, folder).toPandas())
    theirs = canonical(con.execute(oracle_sql()[name]).df())
    if list(ours.columns) != list(theirs.columns):
        return f"columns {list(ours.columns)} / {list(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    for column in ours.columns:
        a, b = ours[column], theirs[column]
        equal = (a == b) | (a.isna() & b.isna())
        if not equal.all():
            at = (~equal).idxmax()
            return f"{column}: {(~equal).sum()} differ, e.g. {ours.loc[at].to_dict()} / {b[at]!r}"
        if str(a.dtype) != str(b.dtype) and not (a.dtype == object or b.dtype == object):
            return f"type of {column}: {a.dtype} / {b.dtype}"
    return None if len(ours) else "no rows"


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck_connection(folder)
    for name in sys.argv[2:] or list(queries()):
        start = time.time()
        try:
            result = differences(spark, con, folder, name)
        except Exception as error:  # noqa: BLE001 - report and go on
            result = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if result is None else 'FAIL'} {name} {time.time() - start:.1f}s {result or ''}",
              flush=True)


if __name__ == "__main__":
    main()
