"""Token counts of whole texts through a digest cache.

A text is known by the SHA-256 of its content and a count by that digest and the tokenizer's. Counts
found in the cache are taken from it; of the other texts each distinct one is encoded once and its
count is appended to the cache, so later runs over the same or copied texts encode nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from importlib.metadata import version

import public_tokenizers
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm.common import slices, worker_cache
from tidewire.llm.encoders import TokenCounter
from tidewire.session import materialize

CACHE_SCHEMA = "version string, digest binary, n_tokens bigint"
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer's file and the library that reads it; a change of either misses the cache."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read() + version("tokenizers").encode()).hexdigest()


def content_digest(text: Column) -> Column:
    """SHA-256 of the normalised content: NULL becomes empty, nothing else may change a count."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def read_cache(spark: SparkSession, cache: str, key: str) -> DataFrame:
    """digest and n_tokens of one tokenizer version; empty when the cache does not exist yet.

    Two runs may both have appended a text; its counts are equal and one is read.
    """
    try:
        stored = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], CACHE_SCHEMA)
    return stored.where(F.col("version") == key).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def encode_misses(docs: DataFrame, cache: str, path: str = BYTE_BPE) -> None:
    """Append the counts of all distinct texts that the cache does not hold.

    Copies of a text are dropped before the shuffle, so a text that a third of all rows share moves
    once per task. The append is one committed write: after a failure it is either there or not, and
    a rerun encodes what is missing.
    """
    key = tokenizer_version(path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_cache(f"counter {path}", lambda: TokenCounter(path))
        for batch in slices(batches):
            numbers = [counter.count(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([key] * len(numbers), pa.string()), batch.column("digest"),
                 pa.array(numbers, pa.int64())],
                ["version", "digest", "n_tokens"],
            )

    known = read_cache(docs.sparkSession, cache, key).select("digest")
    text = F.coalesce(F.col("text"), F.lit(""))
    distinct = docs.select(content_digest(F.col("text")).alias("digest"), text.alias("text"))
    misses = distinct.dropDuplicates(["digest"]).join(known, "digest", "left_anti")
    misses.mapInArrow(count, CACHE_SCHEMA).write.mode("append").parquet(cache)


def count_tokens(docs: DataFrame, cache: str, path: str = BYTE_BPE, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of `docs`; fills the cache first.

    NULL and empty texts have 0 bytes and 0 tokens. Repeated rows give repeated results; an empty
    table gives none. Special strings inside a text are what the tokenizer takes them for.
    """
    encode_misses(docs, cache, path)
    # Written once, so that the join reads both sides as they are and Spark can split the rows of a hot digest.
    counts = materialize(read_cache(docs.sparkSession, cache, tokenizer_version(path)), "counts")
    texts = docs.select(
        F.col("doc_id").cast("bigint"), content_digest(F.col("text")).alias("digest"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
    )
    return texts.join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
