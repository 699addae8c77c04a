"""Helpers shared by the operators: Arrow slices, document keys and per-worker caches."""

from __future__ import annotations

import importlib
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE_ROWS = 256

Keep = Callable[[list[str | None]], list[bool]]


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of a few rows, so that temporary arrays stay small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def row_key(*columns: str) -> Column:
    """A 128-bit key of a row's values, never NULL: rows with equal values have equal keys."""
    values = [part for name in columns for part in (F.col(name).isNull(), F.col(name))]
    return F.struct(
        F.xxhash64(*values).alias("a"), F.xxhash64(F.lit("second half"), *values).alias("b")
    )


def filter_rows(docs: DataFrame, keeper: Callable[[], Keep]) -> DataFrame:
    """Rows of `docs` whose `text` passes; all columns stay as they are.

    `keeper()` is called once per task and returns a function from texts to decisions.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = keeper()
        for batch in slices(batches):
            yield batch.filter(pa.array(keep(batch.column("text").to_pylist()), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def worker_cache(name: str, make: Callable[[], Any]) -> Any:
    """An object that outlives a task in a reused Python worker; `make()` builds it when absent.

    A worker keeps one such object: what an earlier stage has left is dropped first.
    """
    host = importlib.import_module("pyspark.worker_util")
    cache = host.__dict__.setdefault("_tidewire_llm_cache", {})
    if name not in cache:
        cache.clear()
        cache[name] = make()
    return cache[name]
