"""Packing documents into sequences by shortest-pack-first over the histogram of lengths.

Documents are encoded and cut into pieces of at most `size` tokens. Only the histogram of piece lengths,
at most `size` numbers, reaches the driver. There lengths are placed longest first, each time into the
emptiest open packs it fits, as counts of packing patterns. The patterns say which ranks of a length go
to which sequences; pieces are ranked within their length on Spark and looked up by that rank.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidewire.llm.common import slices, worker_cache
from tidewire.llm.encoders import WordEncoder
from tidewire.session import materialize

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1
SIZE = 2048
RANK_ROWS = 20_000
PIECE_SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


@dataclass(frozen=True)
class Placement:
    """Ranks `rank` .. `rank + count - 1` of one piece length go to consecutive sequences, at one offset."""

    length: int
    rank: int
    count: int
    sequence: int
    offset: int


def pieces(
    docs: DataFrame, size: int = SIZE, path: str = WORD_BPE, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """The pieces of every document: whole runs of `size` ids and the rest, with the end id last.

    A NULL text counts as empty, so its only id is the end. Repeated rows give repeated pieces. With
    `with_ids` the ids themselves are kept as an array.
    """
    columns = PIECE_SCHEMA + (", ids array<int>" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_cache(f"words {path}", lambda: WordEncoder(path))
        for batch in slices(batches):
            rows, kept = [], []
            for doc, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text")), strict=True):
                ids = np.append(encoder.encode(text or ""), np.uint32(end_id)).astype("<u4")
                for start in range(0, len(ids), size):
                    part = ids[start : start + size]
                    rows.append((doc, start, len(part), zlib.crc32(part.tobytes()), len(ids)))
                    kept.append(part.astype(np.int32))
            arrays = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
            if rows:
                extra = [pa.array(kept, pa.list_(pa.int32()))] if with_ids else []
                yield pa.RecordBatch.from_arrays(
                    arrays + extra, ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
                )

    narrow = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return narrow.mapInArrow(cut, columns)


def pack_histogram(histogram: dict[int, int], size: int = SIZE) -> list[Placement]:
    """Shortest-pack-first on counts: where the pieces of every length go.

    `open_packs[space]` lists groups of equal packs with that much space: (first sequence, count). Every
    step either uses up a length or fills a group, so steps depend on `size` and not on the counts.
    """
    open_packs: dict[int, list[tuple[int, int]]] = defaultdict(list)
    placements: list[Placement] = []
    next_sequence = 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        space = size
        while left:
            while space >= length and not open_packs[space]:
                space -= 1
            if space < length:
                repeat = size // length
                full, rest = divmod(left, repeat)
                for packs, per_pack in ((full, repeat), (min(rest, 1), rest)):
                    for k in range(per_pack if packs else 0):
                        placements.append(Placement(length, rank, packs, next_sequence, k * length))
                        rank += packs
                    if packs and size - per_pack * length:
                        open_packs[size - per_pack * length].append((next_sequence, packs))
                    next_sequence += packs
                left = 0
                continue
            first, packs = open_packs[space].pop()
            used = min(packs, left)
            placements.append(Placement(length, rank, used, first, size - space))
            rank, left = rank + used, left - used
            if used < packs:
                open_packs[space].append((first + used, packs - used))
            if space > length:
                open_packs[space - length].append((first, used))
    return placements


def ranked(parts: DataFrame, counts: dict[int, int]) -> DataFrame:
    """`parts` with `rank`, a number from 0 within each length.

    A length is dealt to buckets of about RANK_ROWS rows; rows are numbered within a bucket and the
    buckets' sizes are added up, so no task holds a length as a whole.
    """
    many = {n: -(-c // RANK_ROWS) for n, c in counts.items() if c > RANK_ROWS}
    buckets = F.lit(1)
    if many:
        table = F.create_map(*[F.lit(x) for pair in many.items() for x in pair])
        buckets = F.coalesce(table[F.col("length")], F.lit(1))
    order = ("doc_id", "start", "ids_crc32")
    dealt = parts.withColumn("bucket", F.pmod(F.xxhash64(*order, F.rand(7)), buckets))
    dealt = materialize(dealt, "pieces-dealt")
    sizes = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "bucket").orderBy(*order)
    numbered = dealt.withColumn("at", F.row_number().over(inside) - 1)
    return numbered.join(sizes, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("at")).drop(
        "bucket", "before", "at"
    )


def place(ranks: DataFrame, placements: list[Placement]) -> DataFrame:
    """Join the patterns to the ranked pieces: sequence_id and offset of each.

    The patterns are as many as `pack_histogram` takes steps, whatever the table's size, and are shipped
    as one sorted array; a piece finds its pattern by binary search over (length, rank).
    """
    ordered = sorted(placements, key=lambda p: (p.length, p.rank))
    starts = np.array([(p.length << 48) + p.rank for p in ordered], np.int64)
    shift = np.array([p.sequence - p.rank for p in ordered], np.int64)
    offsets = np.array([p.offset for p in ordered], np.int64)
    shared = ranks.sparkSession.sparkContext.broadcast((starts, shift, offsets))
    names = ranks.columns

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, shift, offsets = shared.value
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(starts, (batch.column("length").to_numpy() << 48) + rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rank + shift[at]), pa.array(offsets[at])],
                [*names, "sequence_id", "offset"],
            )

    added = [StructField(name, LongType()) for name in ("sequence_id", "offset")]
    schema = StructType([*ranks.schema.fields, *added])
    return ranks.mapInArrow(look_up, schema).drop("rank")


def pack(parts: DataFrame, size: int = SIZE) -> DataFrame:
    """Every piece with its `sequence_id` and `offset`; pieces lie in a sequence without gaps.

    `parts` is the result of `pieces`; it is written to the shared folder once, as the histogram and the
    ranking both read it. An empty table gives an empty result.
    """
    stored = materialize(parts, "pieces")
    rows = stored.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = {r["length"]: r["n"] for r in rows}
    return place(ranked(stored, counts), pack_histogram(counts, size))


def sequences(packed: DataFrame, size: int = SIZE, pad_id: int = 0) -> DataFrame:
    """sequence_id and its `size` ids, padded at the end; `packed` must hold `ids`.

    A sequence holds at most `size` pieces, which bounds each group. One that fills a power of two is
    not padded.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    ids = F.flatten(F.transform(parts, lambda p: p["ids"]))
    whole = packed.groupBy("sequence_id").agg(ids.alias("ids"))
    n = F.size("ids")
    padding = F.when(n.bitwiseAND(n - 1) == 0, F.lit(0)).otherwise(size - n)
    return whole.select("sequence_id", F.concat("ids", F.array_repeat(F.lit(pad_id), padding)).alias("ids"))
