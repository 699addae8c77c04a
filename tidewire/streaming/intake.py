"""News intake in micro-batches whose results do not depend on how the batches were cut.

Every micro-batch of landed envelopes is read once, and its rows are written to one table with their outcome:
accepted, late (older than the watermark that the batches before it left) or rejected (unreadable, or without
url, title or date). The copy of an article that counts is the first in arrival order among all accepted copies,
so it may change while copies arrive; the hours a batch touches are computed anew from the accepted rows. State
is what lies in these tables, partitioned by batch, outcome and day.

A batch writes its rows, then its progress, then its hours. A batch that is repeated has the same number and
replaces what it wrote; readers see batches with progress only.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from tidewire.config import DEFAULT_CONFIG, EngineConfig
from tidewire.operators.articles import dedup_first, with_clean_fields, with_window_start
from tidewire.operators.enrich import measure_articles, with_event
from tidewire.operators.windows import flagged_window_features
from tidewire.sources.envelopes import article_rows, with_feed_order
from tidewire.sources.store import FeatureStore
from tidewire.streaming.news import body_stream

ACCEPTED, LATE, REJECTED = "accepted", "late", "rejected"

_TEXT, _TIME, _LONG, _DOUBLE = StringType(), TimestampNTZType(), LongType(), DoubleType()
ROW = StructType([StructField(name, kind) for name, kind in (
    ("path", _TEXT), ("ingestion_time", _TIME), ("feed_ord", IntegerType()), ("entry_ord", IntegerType()),
    ("source", _TEXT), ("id", _TEXT), ("title", _TEXT), ("content", _TEXT), ("url", _TEXT), ("published_at", _TIME),
    ("content_hash", _TEXT), ("window_start", _TIME), ("relevant", BooleanType()), ("word_event", _TEXT),
    ("asset_mentioned", ArrayType(_TEXT)), ("headline_sentiment_score", _DOUBLE),
    ("headline_sentiment_conf", _DOUBLE), ("final_sentiment_score", _DOUBLE), ("error", _TEXT), ("origin", _TEXT),
)])
STORED = StructType([
    *ROW, StructField("batch", _LONG), StructField("outcome", _TEXT), StructField("window_date", DateType()),
])
COUNTS = StructType([
    StructField("watermark", _TIME), StructField("newest", _TIME),
    *[StructField(name, _LONG) for name in ("read", ACCEPTED, LATE, REJECTED)],
])
PROGRESS = StructType([*COUNTS, StructField("batch", _LONG)])
MEASURES = (
    "window_start", "id", "source", "relevant", "word_event", "asset_mentioned", "headline_sentiment_score",
    "headline_sentiment_conf", "final_sentiment_score", "ingestion_time", "feed_ord", "entry_ord", "content_hash",
)


class Intake:
    """The tables of one stream of envelopes, and what a batch does to them.

    `feeds` (source, feed_ord) is the order in which feeds win; without it the order of entries and the content
    hash decide. `delay` is how far behind the newest article one may be. One writer at a time.
    """

    def __init__(
        self, spark: SparkSession, path: str, delay: timedelta = timedelta(hours=2), feeds: DataFrame | None = None,
        config: EngineConfig = DEFAULT_CONFIG,
    ):
        self.spark, self.path, self.delay, self.feeds, self.config = spark, path.rstrip("/"), delay, feeds, config

    def _table(self, name: str, schema: StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def progress(self) -> DataFrame:
        """One row per finished batch: the watermark it met, its newest article, and how many rows went where."""
        return self._table("progress", PROGRESS)

    def watermark(self, batch: int) -> datetime | None:
        """What the batches before this one have settled: older articles are late."""
        newest = self.progress().where(F.col("batch") < batch).agg(F.max("newest")).first()[0]
        return None if newest is None else newest - self.delay

    def rows(self, outcome: str) -> DataFrame:
        """Rows of finished batches with that outcome, with `batch` and `window_date`."""
        stored = self._table("rows", STORED).where(F.col("outcome") == outcome)
        return stored.join(self.progress().select("batch"), "batch", "left_semi").drop("outcome")

    def survivors(self, accepted: DataFrame | None = None) -> DataFrame:
        """The first copy in arrival order of every accepted article and hour."""
        return dedup_first(self.rows(ACCEPTED) if accepted is None else accepted)

    def accounts(self) -> DataFrame:
        """batch, read, late, rejected, first, copies: where the rows of each batch are now.

        A later batch can turn a first copy into a further one; the sum over all outcomes stays what was read.
        """
        first = self.survivors(self.rows(ACCEPTED).select(*MEASURES, "batch")).groupBy("batch").agg(F.count(F.lit(1)).alias("first"))
        joined = self.progress().join(first, "batch", "left").fillna(0, ["first"])
        return joined.select("batch", "read", "late", "rejected", "first", (F.col("accepted") - F.col("first")).alias("copies"))

    def classify(self, bodies: DataFrame, watermark: datetime | None) -> DataFrame:
        """(path, body) to rows with their outcome; nothing is dropped."""
        read = article_rows(bodies)
        ordered = with_feed_order(read, self.feeds) if self.feeds is not None else read.withColumn("feed_ord", F.lit(0))
        clean = with_window_start(with_clean_fields(ordered.withColumnRenamed("error", "_unread")))
        error = F.coalesce("_unread", "_error")
        old = F.lit(False) if watermark is None else F.col("published_at") < F.lit(watermark.isoformat(" ")).cast("timestamp_ntz")
        outcome = F.when(error.isNotNull(), REJECTED).when(old, LATE).otherwise(ACCEPTED)
        judged = clean.withColumns({"error": error, "outcome": outcome})
        kept = [c for c in judged.columns if c in ROW.fieldNames() and c != "source"] + ["outcome"]
        measured = measure_articles(judged, tuple(kept), self.config)
        return measured.select(*ROW.fieldNames(), "outcome", F.when(F.col("outcome") != REJECTED, F.to_date("window_start")).alias("window_date"))

    def take(self, bodies: DataFrame, batch: int) -> None:
        """Write the rows of a batch and what there is to say about them, counted on the way."""
        watermark = self.watermark(batch)
        counted = Observation(f"intake-{batch}")
        rows = self.classify(bodies, watermark).observe(
            counted, F.count(F.lit(1)).alias("read"),
            *[F.count_if(F.col("outcome") == o).alias(o) for o in (ACCEPTED, LATE, REJECTED)],
            F.max(F.when(F.col("outcome") == ACCEPTED, F.col("published_at"))).alias("newest"),
        )
        rows.write.mode("overwrite").partitionBy("outcome", "window_date").parquet(f"{self.path}/rows/batch={batch}")
        told = counted.get
        row = (watermark, told["newest"], told["read"], told[ACCEPTED], told[LATE], told[REJECTED])
        self.spark.createDataFrame([row], COUNTS).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/progress/batch={batch}"
        )

    def touched(self, batch: int) -> DataFrame:
        """The hours for which a batch has brought accepted rows."""
        return self.rows(ACCEPTED).where(F.col("batch") == batch).select("window_start", "window_date").distinct()

    def features(self, hours: DataFrame, verdicts: DataFrame | None = None) -> DataFrame:
        """Features of the given hours from their surviving articles.

        `verdicts` (id, is_noise and maybe category) is read as it is at the time; without it every relevant article
        counts. Only the days of these hours are read, and of them no text.
        """
        days = hours.agg(F.min("window_date").alias("a"), F.max("window_date").alias("b")).first()
        accepted = self.rows(ACCEPTED)
        if days.a is not None:
            accepted = accepted.where(F.col("window_date").between(F.lit(days.a), F.lit(days.b)))
        near = accepted.select(*MEASURES).join(hours.select("window_start"), "window_start", "left_semi")
        first = self.survivors(near)
        judged = first.withColumn("is_noise", F.lit(False)) if verdicts is None else first.join(verdicts, "id", "left")
        kept = F.coalesce(~F.col("is_noise"), F.lit(False)) & F.col("relevant")
        return flagged_window_features(with_event(judged, self.config).withColumn("kept", kept))


def run_intake(
    intake: Intake, source: str, checkpoint: str, store: FeatureStore | None = None, verdicts: DataFrame | None = None,
    one_per_file: bool = True, max_files: int | None = None, interval: str | None = None,
    after: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Start the stream over the envelopes in `source`; a restart goes on after the last finished batch.

    With a `store` the hours of each batch are upserted and the momentum around them refreshed. Without `interval` the
    query takes what is there and stops. `after` is called with the number of each batch that is through.
    """
    def process(bodies: DataFrame, batch: int) -> None:
        intake.take(bodies, batch)
        if store is not None:
            store.refresh_momentum(store.upsert(intake.features(intake.touched(batch), verdicts), batch))
        if after is not None:
            after(batch)

    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return (
        body_stream(intake.spark, source, one_per_file, max_files).writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )
