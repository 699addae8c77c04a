"""News features on a stream: intake, duplicate filter, hourly aggregate, idempotent sink.

`published_at` is a TIMESTAMP_NTZ in UTC everywhere else. Watermarks need a TIMESTAMP, so it is cast
for the stateful part; the session zone must be UTC for that cast to keep the hour. State holds one
key per article and one row per hour within the watermark; use the RocksDB state store for large ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidewire.config import DEFAULT_CONFIG, EngineConfig
from tidewire.operators.articles import normalize_articles
from tidewire.operators.enrich import measure_articles, with_event
from tidewire.operators.windows import feature_aggregates, with_noise_ratio
from tidewire.sources.envelopes import parse_envelopes, repair_rows
from tidewire.sources.store import FeatureStore


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"event-time streams need spark.sql.session.timeZone=UTC, not {zone}")


def body_stream(spark: SparkSession, path: str, one_per_file: bool = True, max_files: int | None = None) -> DataFrame:
    """(path, body) of documents as they land in a folder, at most `max_files` files a batch."""
    reader = spark.readStream if max_files is None else spark.readStream.option("maxFilesPerTrigger", max_files)
    return reader.text(path, wholetext=one_per_file).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("body")
    )


def read_envelope_stream(
    spark: SparkSession, path: str, one_per_file: bool = True, max_files: int | None = None
) -> DataFrame:
    """Raw article rows of envelopes as they land in a folder."""
    return repair_rows(parse_envelopes(body_stream(spark, path, one_per_file, max_files).drop("path")))


def read_table_stream(spark: SparkSession, path: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    """The rows of a Parquet table and of the files that land in it.

    The table may be a folder or one file. A file stream takes folders only, unless its path is a pattern; so the
    last character is written as one.
    """
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    path = path.rstrip("/")
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def first_arrivals(cleaned: DataFrame, delay: str, salts: int = 16) -> DataFrame:
    """Each id once: the first to arrive wins, rows later than `delay` are dropped.

    All copies of an id meet in one task. So that an article with very many copies is no hot spot, the
    copies are first thinned in `salts` parts by the task that read them, which also parts copies that
    are equal in every column; 1 turns that off.
    """
    require_utc(cleaned.sparkSession)
    salt = F.pmod(F.spark_partition_id(), F.lit(salts))
    watched = (
        cleaned.withColumn("_salt", salt)
        .withColumn("published_at", F.col("published_at").cast("timestamp"))
        .withWatermark("published_at", delay)
    )
    if salts > 1:
        watched = watched.dropDuplicatesWithinWatermark(["id", "_salt"])
    return watched.dropDuplicatesWithinWatermark(["id"]).drop("_salt")


def clean_stream(raw: DataFrame, delay: str = "2 hours", **options) -> DataFrame:
    """Normalised articles with their text, each id once."""
    return first_arrivals(normalize_articles(raw, **options), delay)


def window_feature_stream(
    articles: DataFrame, delay: str = "2 hours", config: EngineConfig = DEFAULT_CONFIG
) -> DataFrame:
    """Hourly news features of normalised articles with `is_noise`; run it in update mode.

    Articles are measured where they are read, so the duplicate filter shuffles narrow rows and its
    state holds keys only.
    """
    wanted = ("id", "published_at", "is_noise", "category", "feed_ord", "entry_ord")
    carried = tuple(c for c in wanted if c in articles.columns)
    measured = with_event(measure_articles(articles, carried, config), config)
    kept = F.coalesce(~F.col("is_noise"), F.lit(False)) & F.col("relevant")
    hourly = (
        first_arrivals(measured.withColumn("kept", kept), delay)
        .groupBy(F.window("published_at", "1 hour"))
        .agg(*feature_aggregates(kept="kept"))
    )
    return with_noise_ratio(
        hourly.withColumn("window_start", F.col("window.start").cast("timestamp_ntz")).drop("window")
    )


def write_features(
    features: DataFrame, store: FeatureStore, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Upsert every changed hour, then refresh the momentum of the stored history.

    A repeated micro-batch has the same number and replaces its own rows. Without `interval` the query
    takes what is there and stops.
    """
    def upsert(batch: DataFrame, batch_id: int) -> None:
        store.refresh_momentum(store.upsert(batch, batch_id))

    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return (
        features.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(upsert)
        .start()
    )


def write_clean(
    cleaned: DataFrame, path: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Append cleaned articles to a table partitioned by day."""
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return (
        cleaned.withColumn("window_date", F.to_date("published_at"))
        .writeStream.outputMode("append")
        .format("parquet")
        .partitionBy("window_date")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
