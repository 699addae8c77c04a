"""News features: one row per window from one grouped aggregate.

Everything is a partial + final aggregate keyed by `window_start`; a window that holds most of the
rows is combined on the map side and reaches the reducer as one partial row per task.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire import fixed_values as fv
from tidewire.functions.basics import hours, round_dp
from tidewire.operators.enrich import MEASURES
from tidewire.operators.ordered import month_of, previous_value

MOOD = "coalesce(final_sentiment_score, headline_sentiment_score, 0.0D)"
FINAL = "coalesce(final_sentiment_score, 0.0D)"
# int(2 * impact) repeats of a score, one repeat at impact 0: a weight, so nothing is exploded.
REPEATS = "CASE WHEN impact_score > 0 THEN impact_score * 2 ELSE 1 END"
HIGH, LOW = f"> {fv.POLARITY}D", f"< -{fv.POLARITY}D"

# group -> [(column, kind, aggregate)]. A kind says how the aggregate is finished: `mean` rounds to 4
# decimals, `int` and `double` cast, `flag` stays; an absent value is 0 or false.
AGGREGATES = {
    "volume": [("article_count", "int", "count(1)")],
    "sentiment": [
        ("avg_sentiment", "mean", f"avg({MOOD})"),
        ("max_sentiment", "mean", f"max({MOOD})"),
        ("min_sentiment", "mean", f"min({MOOD})"),
        ("sentiment_std", "mean", f"stddev_samp({MOOD})"),
    ],
    "buckets": [
        ("positive_count", "int", f"count_if({MOOD} {HIGH})"),
        ("negative_count", "int", f"count_if({MOOD} {LOW})"),
        ("neutral_count", "int", f"count_if(NOT ({MOOD} {HIGH} OR {MOOD} {LOW}))"),
    ],
    "weighted": [
        ("weighted_avg_sentiment", "mean", f"sum({FINAL} * ({REPEATS}))"),
    ],
    "impact": [
        ("avg_impact", "mean", "avg(impact_score)"),
        ("max_impact", "int", "max(impact_score)"),
        ("high_impact_count", "int", "count_if(impact_score >= 3)"),
        ("mid_impact_count", "int", "count_if(impact_score = 2)"),
        ("low_impact_count", "int", "count_if(impact_score <= 1)"),
    ],
    "net": [
        ("net_impact_sentiment", "double",
         f"sum(CASE WHEN {FINAL} {HIGH} THEN impact_score WHEN {FINAL} {LOW} THEN -impact_score END)"),
    ],
    "flags": [(name, "flag", f"bool_or(event_type = '{kind}')") for name, kind in fv.EVENT_FLAGS.items()],
    "events": [(name, "int", f"count_if(event_type = '{kind}')") for name, kind in fv.EVENT_COUNTS.items()],
    "assets": [
        (name, "int", f"count_if(array_contains(asset_mentioned, '{asset}'))")
        for name, asset in fv.ASSET_COUNTS.items()
    ],
    "sources": [
        ("avg_source_weight", "mean", "avg(source_weight)"),
        ("max_source_weight", "mean", "max(source_weight)"),
        ("avg_confidence", "mean", "avg(headline_sentiment_conf)"),
    ],
}
GROUPS = tuple(AGGREGATES)
_FINISH = {
    "mean": "coalesce(cast(round(cast({} AS decimal(38,12)), 4) AS double), 0.0D)",
    "int": "cast(coalesce({}, 0) AS int)",
    "double": "cast(coalesce({}, 0) AS double)",
    "flag": "coalesce({}, false)",
}


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def feature_aggregates(groups: Iterable[str] = GROUPS, kept: str | None = None) -> list[Column]:
    """Aggregate columns of the chosen groups over enriched rows.

    With the name of a flag in `kept`, rows where it is not true only count in `total_raw`.
    """
    only = f" FILTER (WHERE {kept})" if kept else ""
    columns = []
    for group in groups:
        for name, kind, aggregate in AGGREGATES[group]:
            value = aggregate + only
            if name == "weighted_avg_sentiment":
                value = f"try_divide({value}, sum({REPEATS}){only})"
            columns.append(F.expr(_FINISH[kind].format(value)).alias(name))
        if group == "volume":
            columns.append(F.expr("cast(count(1) AS int)").alias("total_raw"))
    return columns


def with_noise_ratio(df: DataFrame) -> DataFrame:
    """Share of cleaned rows that were not enriched; NULL when nothing was enriched."""
    share = F.try_divide(
        (F.col("total_raw") - F.col("article_count")).cast("double"), F.col("total_raw")
    )
    ratio = F.when(F.col("total_raw") > 0, round_dp(share, 4)).otherwise(0.0)
    return df.withColumn("noise_ratio", F.when(F.col("article_count") > 0, ratio))


def flagged_window_features(
    flagged: DataFrame, by: tuple[str, ...] = ("window_start",), kept: str = "kept"
) -> DataFrame:
    """All news features from one pass over cleaned rows with a `kept` flag and the measures."""
    return with_noise_ratio(flagged.groupBy(*by).agg(*feature_aggregates(kept=kept)))


def window_features(enriched: DataFrame, cleaned: DataFrame, by: str = "window_start") -> DataFrame:
    """All news features from two stage tables, in one aggregate.

    The cleaned table only contributes its count: it is first counted per window, then unioned in as
    one narrow row per window, so there is no join of two aggregates and no wide shuffle.
    """
    marked = enriched.select(
        by, F.lit(True).alias("kept"), F.lit(0).cast("bigint").alias("_cleaned"), *MEASURES
    )
    counted = cleaned.groupBy(by).agg(F.count(F.lit(1)).alias("_cleaned"))
    both = marked.unionByName(counted.withColumn("kept", F.lit(False)), allowMissingColumns=True)
    aggregates = feature_aggregates(kept="kept")
    return with_noise_ratio(
        both.groupBy(by)
        .agg(*aggregates, F.sum("_cleaned").cast("int").alias("_total"))
        .withColumn("total_raw", F.col("_total"))
        .drop("_total")
    )


def hour_calendar(df: DataFrame, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """Every hour from the first to the last window of `df` (or the given bounds).

    The driver reads the two bounds; the hours are made by a range, dealt over the tasks like any
    other rows.
    """
    first = F.min("window_start") if start is None else start
    last = F.max("window_start") if end is None else end
    bounds = df.agg(first.alias("first"), last.alias("last")).first()
    if bounds is None or bounds["first"] is None:
        return df.select("window_start").limit(0)
    n = int((bounds["last"] - bounds["first"]).total_seconds() // 3600) + 1
    begin = F.lit(bounds["first"].isoformat(" ")).cast("timestamp_ntz")
    step = F.make_dt_interval(F.lit(0), F.col("id").cast("int"))
    return df.sparkSession.range(n).select((begin + step).alias("window_start"))


ZEROS = {name: kind for group in AGGREGATES.values() for name, kind, _ in group} | {"total_raw": "int"}


def fill_empty_windows(features: DataFrame, calendar: DataFrame) -> DataFrame:
    """A row for every hour of the calendar; hours without articles get zeros, false and NULL ratio."""
    def present(*kinds: str) -> list[str]:
        return [c for c, kind in ZEROS.items() if kind in kinds and c in features.columns]

    joined = calendar.join(features, "window_start", "left")
    filled = joined.na.fill(0, present("int", "mean", "double"))
    return filled.na.fill(False, present("flag"))


def with_momentum(features: DataFrame) -> DataFrame:
    """Change of `avg_sentiment` against the previous window in the table, 0.0 for the first."""
    before = previous_value(
        features, "avg_sentiment", [], "window_start", month_of(F.col("window_start")), "_before"
    )
    change = round_dp(F.col("avg_sentiment") - F.col("_before"), 4)
    return before.withColumn("sentiment_momentum", _or_zero(change)).drop("_before")


def with_hourly_momentum(features: DataFrame) -> DataFrame:
    """The same for a table without gaps, where the previous window is one hour back.

    Each row also sends its average one hour ahead, and one grouping by hour brings both together.
    """
    own = F.struct(*[F.col(c) for c in features.columns])
    none = F.lit(None).cast("double")
    sent = F.array(
        F.struct(F.col("window_start").alias("_at"), own.alias("_own"), none.alias("_before")),
        F.struct(
            (F.col("window_start") + hours(1)).alias("_at"),
            F.when(F.lit(False), own).alias("_own"),
            F.col("avg_sentiment").alias("_before"),
        ),
    )
    met = (
        features.select(F.inline(sent))
        .groupBy("_at")
        .agg(F.max("_own").alias("_own"), F.max("_before").alias("_before"))
        .where(F.col("_own").isNotNull())
    )
    change = round_dp(F.col("_own.avg_sentiment") - F.col("_before"), 4)
    return met.select("_own.*", _or_zero(change).alias("sentiment_momentum"))
