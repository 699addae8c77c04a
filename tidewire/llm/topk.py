"""Exact top-k by inner product with bounds from multi-resolution segment statistics.

A vector is cut into segments at several resolutions; a segment is described by its mean and deviation.
Two segments of length L with means m, M and deviations s, S have a squared distance of at least
L * ((m - M)^2 + (s - S)^2). With the lengths of the vectors that is an upper bound L * (m * M + s * S) of
their inner product. Candidates are bounded coarse to fine; the exact score is computed for survivors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.session import materialize


@dataclass(frozen=True)
class TopKConfig:
    """Results per query, segments per resolution, and rows per block of candidates and of queries."""

    k: int = 5
    segments: tuple[int, ...] = (2, 8, 32)
    block_rows: int = 8192
    query_rows: int = 2048


DEFAULT = TopKConfig()


def usable(vector: Column) -> Column:
    """Whether a vector is not NULL and all its components are finite numbers."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(finite(x.cast("double")), F.lit(False)))


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id and `v`: floor(scale * x) of every component as long; unusable vectors take no part."""
    rows = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    return rows.select(F.col("vec_id").cast("bigint"), whole.alias("v"))


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of a matrix's segments, weighted so that their product is the bound."""
    cuts = np.unique(np.linspace(0, x.shape[1], segments + 1).astype(int))
    parts = []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        weight = np.sqrt(b - a)
        parts += [x[:, a:b].mean(axis=1) * weight, x[:, a:b].std(axis=1) * weight]
    return np.stack(parts, axis=1) if parts else np.zeros((len(x), 1))


def matrix(rows: list[list[int]], width: int) -> np.ndarray:
    """Rows of whole numbers as a matrix; shorter ones are filled with zeros."""
    out = np.zeros((len(rows), width), np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def search(
    queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, ids: np.ndarray, config: TopKConfig
) -> Iterator[tuple[int, int, int]]:
    """(query, candidate, score) of each query's k best in the block, ties to the smaller id."""
    order = np.argsort(ids, kind="stable")
    data, ids = data[order], ids[order]
    floats = data.astype(np.float64)
    levels = [statistics(floats, n) for n in config.segments]
    own = [statistics(queries.astype(np.float64), n) for n in config.segments]
    for i, query in enumerate(queries):
        bound = levels[0] @ own[0][i]
        bound[ids == query_ids[i]] = -np.inf
        probe = np.argpartition(-bound, min(4 * config.k, len(bound) - 1))[: 4 * config.k]
        probe = probe[ids[probe] != query_ids[i]]
        best = np.sort(data[probe] @ query)[::-1][: config.k]
        least = best[-1] if len(best) == config.k else -np.inf
        # Rounding may lower a bound by far less than this.
        slack = 1e-6 * (1 + abs(float(least))) if np.isfinite(least) else 0.0
        alive = np.flatnonzero((bound >= least - slack) & (ids != query_ids[i]))
        for level, of_query in zip(levels[1:], own[1:], strict=True):
            alive = alive[level[alive] @ of_query[i] >= least - slack]
        scores = data[alive] @ query
        top = np.argsort(-scores, kind="stable")[: config.k]
        for j in top:
            yield int(query_ids[i]), int(ids[alive[j]]), int(scores[j])


def top_k(vectors: DataFrame, queries: Column, config: TopKConfig = DEFAULT) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best other vectors of every query vector.

    `vectors` has vec_id and `v`; `queries` says which rows are queries. Candidates are dealt to blocks
    and queries to blocks; each pair of blocks is searched by itself, and only the k best of each pair
    move on. A query meets every candidate. Rows with the query's id are never its result; other
    repeated ids stay candidates, one result row each. Vectors of different lengths are filled with
    zeros. An empty table gives an empty result; a query with fewer than k candidates gets them all.
    """
    stored = materialize(vectors, "vectors")
    sizes = stored.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(queries).alias("queries"),
        F.coalesce(F.max(F.size("v")), F.lit(0)).alias("width"),
    ).first()
    blocks = max(1, -(-sizes["rows"] // config.block_rows))
    query_blocks = max(1, -(-sizes["queries"] // config.query_rows))
    width = sizes["width"]
    h = F.xxhash64("vec_id", "v")
    of = lambda n: F.pmod(h, F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    sides = stored.select(F.lit(False).alias("query"), of(blocks).alias("block"), every(query_blocks).alias("part"), "vec_id", "v").unionByName(
        stored.where(queries).select(F.lit(True).alias("query"), every(blocks).alias("block"), of(query_blocks).alias("part"), "vec_id", "v")
    )

    def run(key: tuple, group: pa.Table) -> pa.Table:
        is_query = group.column("query").to_numpy()
        ids = group.column("vec_id").to_numpy()
        values = matrix(group.column("v").to_pylist(), width)
        found = []
        if is_query.any() and not is_query.all():
            found = list(search(values[is_query], ids[is_query], values[~is_query], ids[~is_query], config))
        columns = zip(*found, strict=True) if found else ([], [], [])
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    part = sides.groupBy("block", "part").applyInArrow(run, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = part.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= config.k).select("query_id", "rank", "vec_id", "score")
