"""Stage tables and the feature table on Parquet.

A stage table is rewritten from the stage before it: dynamic partition overwrite replaces the partitions
written, and repeating a failed run gives the same table. The feature table, which is also its own input,
keeps versions of its days.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType, TimestampType

from tidewire.operators.windows import with_momentum
from tidewire.schemas import FEATURE_COLUMNS, FEATURES
from tidewire.session import materialize

GRAINS = {"day": ("window_date",), "hour": ("window_date", "window_hour")}
STORED = StructType([
    *FEATURES.fields,
    StructField("created_at", TimestampType()),
    StructField("batch_seq", LongType()),
    StructField("window_date", DateType()),
])
MANIFEST = StructType([
    StructField("seq", LongType()), StructField("window_date", DateType()), StructField("version", StringType()),
])


def write_stage(df: DataFrame, path: str, grain: str = "hour") -> None:
    """Replace the hours (or days) present in `df`.

    The rebalance hint lets AQE put small partitions together and split a hot one over tasks, so a
    window with most of the rows is not written by one task.
    """
    keys = GRAINS[grain]
    dated = df.withColumns({
        "window_date": F.to_date("window_start"), "window_hour": F.hour("window_start"),
    })
    if grain == "day":
        dated = dated.drop("window_hour")
    (
        dated.hint("rebalance", *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def read_stage(spark: SparkSession, path: str, start_date=None, end_date=None) -> DataFrame:
    """Read a stage table, pruned to the given dates (end not included)."""
    stage = spark.read.parquet(path)
    if start_date is not None:
        stage = stage.where(F.col("window_date") >= F.lit(start_date).cast("date"))
    if end_date is not None:
        stage = stage.where(F.col("window_date") < F.lit(end_date).cast("date"))
    return stage.drop("window_date", "window_hour")


class FeatureStore:
    """One feature row per window in daily partitions, upserted by `window_start`.

    A write puts whole new days into a folder of its own, `data/version=...`, and then appends to the
    manifest which version each of them has from now on. Readers take the latest version of a day, so a
    write that ends half-way, whenever that is, changes nothing. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, part: str, schema: StructType) -> DataFrame:
        """A part of the table; empty where it is not there yet."""
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{part}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def create(self) -> None:
        """Make the table if it is not there; never touches existing rows."""
        self.spark.createDataFrame([], MANIFEST).write.mode("append").parquet(f"{self.path}/manifest")

    def stored(self) -> DataFrame:
        """All rows with their bookkeeping columns; a table that is not there yet is empty."""
        current = self._read("manifest", MANIFEST).groupBy("window_date").agg(
            F.max_by("version", "seq").alias("version")
        )
        data = self._read("data", StructType([*STORED.fields, StructField("version", StringType())]))
        return data.join(current, ["version", "window_date"], "left_semi").select(*STORED.fieldNames())

    def read(self) -> DataFrame:
        return self.stored().select(*FEATURE_COLUMNS)

    def latest(self, n: int = 5) -> DataFrame:
        return self.stored().orderBy(F.desc("window_start")).limit(n)

    def upsert(self, features: DataFrame, batch_seq: int) -> DataFrame:
        """Insert or replace whole rows by window; the last write wins, whatever its number.

        NULLs of the new row replace old values, and feature columns that `features` does not have are
        NULL. Of several rows for one window the one with the larger hash of its values is taken. The
        new rows are first written to the work folder: they are computed once, the days they touch
        are known, and a lost executor cannot change them half-way. Returns them.
        """
        shaped = features.to(FEATURES).select(
            "*",
            F.current_timestamp().alias("created_at"),
            F.lit(batch_seq).cast("bigint").alias("batch_seq"),
            F.to_date("window_start").alias("window_date"),
        )
        w = Window.partitionBy("window_start").orderBy(F.desc(F.xxhash64(*FEATURE_COLUMNS)))
        one = shaped.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
        incoming = materialize(one, "upsert")
        span = incoming.agg(F.min("window_date").alias("a"), F.max("window_date").alias("b")).first()
        if span.a is None:
            return incoming
        present = (
            self.stored()
            .where(F.col("window_date").between(F.lit(span.a), F.lit(span.b)))
            .join(incoming.select("window_date").distinct(), "window_date", "left_semi")
            .join(incoming.select("window_start"), "window_start", "left_anti")
            .select(*STORED.fieldNames())
        )
        self._replace_days(present.unionByName(incoming.select(*STORED.fieldNames())))
        return incoming

    def refresh_momentum(self, touched: DataFrame | None = None) -> None:
        """Recompute the momentum of the `touched` windows and the one after them, or of all.

        Rewrites only days where it changed.
        """
        rows = self.stored()
        before = None
        if touched is not None:
            span = touched.agg(F.min("window_start").alias("a"), F.max("window_start").alias("b")).first()
            if span.a is None:
                return
            at = F.col("window_start")
            a, b = (F.lit(x.isoformat(" ")).cast("timestamp_ntz") for x in (span.a, span.b))
            edge = rows.agg(F.max(F.when(at < a, at)).alias("a"), F.min(F.when(at > b, at)).alias("b")).first()
            before = edge.a
            low, high = (F.lit(x.isoformat(" ")).cast("timestamp_ntz") for x in (edge.a or span.a, edge.b or span.b))
            near = rows.where(at.between(low, high))
        else:
            near = rows
        fresh = with_momentum(near.select("window_start", "avg_sentiment")).select(
            "window_start", F.col("sentiment_momentum").alias("_momentum")
        )
        if before is not None:
            fresh = fresh.where(F.col("window_start") > F.lit(before.isoformat(" ")).cast("timestamp_ntz"))
        fresh = materialize(fresh, "momentum")
        stale = rows.join(fresh, "window_start").where(
            ~F.col("sentiment_momentum").eqNullSafe(F.col("_momentum"))
        )
        days = materialize(stale.select("window_date").distinct(), "stale-days")
        joined = rows.join(days, "window_date", "left_semi").join(
            fresh.withColumn("_found", F.lit(True)), "window_start", "left"
        )
        momentum = F.when(F.col("_found"), F.col("_momentum")).otherwise(F.col("sentiment_momentum"))
        self._replace_days(
            joined.withColumn("sentiment_momentum", momentum).select(*STORED.fieldNames())
        )

    def _replace_days(self, rows: DataFrame) -> None:
        version = uuid.uuid4().hex
        data = f"{self.path}/data/version={version}"
        rows.hint("rebalance", "window_date").write.partitionBy("window_date").parquet(data)
        days = self.spark.read.schema(STORED).parquet(data).select("window_date").distinct()
        last = self._read("manifest", MANIFEST).agg(F.max("seq")).first()[0]
        days.select(
            F.lit((last or 0) + 1).cast("bigint").alias("seq"), "window_date", F.lit(version).alias("version")
        ).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")


def merge_features(features: DataFrame, table: str, batch_seq: int) -> None:
    """The same upsert as a MERGE, for catalogs whose tables support it."""
    source = features.select(*FEATURE_COLUMNS).withColumns({
        "created_at": F.current_timestamp(), "batch_seq": F.lit(batch_seq).cast("bigint"),
    })
    condition = F.expr(f"{table}.window_start = source.window_start")
    source.alias("source").mergeInto(table, condition).whenMatched().updateAll().whenNotMatched() \
        .insertAll().merge()


def features_as_json(features: DataFrame) -> DataFrame:
    """(window_start, document): every field is present, NULLs too, times as ISO with `+00:00`."""
    shaped = features.select(
        F.date_format("window_start", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("window_start"),
        *[c for c in FEATURE_COLUMNS if c != "window_start"],
    )
    document = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return shaped.select("window_start", document.alias("document"))


def features_from_json(documents: DataFrame, column: str = "document") -> DataFrame:
    """Read feature documents back; an empty frame stays empty."""
    options = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss'+00:00'"}
    return documents.select(F.from_json(column, FEATURES, options).alias("f")).select("f.*")
