"""Article intake: normalise, quarantine, window filter, first-wins dedup, per-feed limit."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidewire.functions.basics import hour_floor, hours
from tidewire.functions.dates import parse_date
from tidewire.functions.html import strip_html
from tidewire.functions.text import hash_text, normalize_whitespace, strip

ARRIVAL = ("ingestion_time", "feed_ord", "entry_ord")


def arrival_order(df: DataFrame) -> list[Column]:
    """A total order of articles: ingestion time, feed, entry, then the row's own values.

    Columns of ARRIVAL that the frame lacks are left out. Rows that still tie are equal.
    """
    own = F.col("content_hash") if "content_hash" in df.columns else F.xxhash64(*sorted(df.columns))
    return [*[F.col(c) for c in ARRIVAL if c in df.columns], own]


def union_sources(parts: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL of the feeds. Their order is data: part i gets `feed_ord` i."""
    return reduce(
        DataFrame.unionByName,
        [part.withColumn("feed_ord", F.lit(i)) for i, part in enumerate(parts)],
    )


def _first_rows(df: DataFrame, limit: int, by: Sequence[str | Column]) -> DataFrame:
    w = Window.partitionBy(*by).orderBy("entry_ord")
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= limit).drop("_rn")


def per_source_limit(
    df: DataFrame, limit: int, by: Sequence[str] = ("source",), salts: int = 256
) -> DataFrame:
    """The first `limit` entries of each feed in document order.

    Salted parts of each feed are cut first, so a feed that holds a third of all rows never arrives
    whole in one task, whatever the limit; the result is the same.
    """
    salted = _first_rows(df, limit, [*by, F.pmod(F.xxhash64("entry_ord"), F.lit(salts))])
    return _first_rows(salted, limit, by)


# Dates outside this range, its end not included, are taken for errors: one misread year would otherwise
# stretch the calendar of hours over centuries.
PLAUSIBLE_DATES = ("1990-01-01", "2100-01-01")

RAW_FIELDS = ("title", "content", "url", "raw_published_at")


def _full_fields(markup_to_text, legacy_zone_names: bool) -> Column:
    return F.struct(
        normalize_whitespace(markup_to_text(F.col("title"))).alias("_title"),
        normalize_whitespace(markup_to_text(F.col("content"))).alias("_content"),
        strip(F.coalesce(F.col("url"), F.lit(""))).alias("url"),
        parse_date(F.col("raw_published_at"), legacy_zone_names).alias("published_at"),
    )


def _error(row) -> Column:
    earliest, latest = (F.lit(day).cast("timestamp_ntz") for day in PLAUSIBLE_DATES)
    return (
        F.when(row["url"] == "", "no url")
        .when(row["_title"] == "", "no title")
        .when(row["published_at"].isNull(), "no date")
        .when((row["published_at"] < earliest) | (row["published_at"] >= latest), "implausible date")
    )


def _cut(name: str, chars: int | None) -> Column:
    return F.col(name) if chars is None else F.substring(name, 1, chars)


def _finish(
    full: DataFrame, kept: Sequence[str], title_chars: int | None, content_chars: int | None
) -> DataFrame:
    """Hashes and lengths are of the whole text; title and content are cut to the limits given."""
    return full.select(
        *kept,
        hash_text(F.col("url")).alias("id"),
        _cut("_title", title_chars).alias("title"),
        _cut("_content", content_chars).alias("content"),
        "url",
        "published_at",
        hash_text(F.col("_content")).alias("content_hash"),
        F.length("_content").alias("text_length"),
        F.length("_title").alias("title_length"),
    )


def with_clean_fields(
    df: DataFrame, markup_to_text=strip_html, legacy_zone_names=False,
    title_chars: int | None = None, content_chars: int | None = None,
) -> DataFrame:
    """Raw fields to clean fields plus `_error`, keeping every row and extra column.

    Texts stay whole unless a limit is given.
    """
    kept = [c for c in df.columns if c not in RAW_FIELDS]
    full = df.select(*kept, _full_fields(markup_to_text, legacy_zone_names).alias("_f"))
    return _finish(full.select(*kept, "_f.*", _error(F.col("_f")).alias("_error")), [*kept, "_error"],
                   title_chars, content_chars)


def normalize_articles(
    df: DataFrame, markup_to_text=strip_html, legacy_zone_names=False,
    title_chars: int | None = None, content_chars: int | None = None,
) -> DataFrame:
    """Cleaned records; rows without url, title or readable date are left out.

    Texts stay whole unless `title_chars` or `content_chars` is given.
    The row is dropped where its fields are made. A filter after it would be pushed below, and the
    markup and dates would be parsed once for the filter and again for the result.
    """
    kept = [c for c in df.columns if c not in RAW_FIELDS]
    fields = F.array(_full_fields(markup_to_text, legacy_zone_names))
    valid = F.filter(fields, lambda row: _error(row).isNull())
    return _finish(df.select(*kept, F.inline(valid)), kept, title_chars, content_chars)


def quarantine_split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with `_error`) of a frame that carries `_error`."""
    return df.where(F.col("_error").isNull()).drop("_error"), df.where(F.col("_error").isNotNull())


def window_filter(df: DataFrame, start: Column, end: Column, time: str = "published_at") -> DataFrame:
    """Half-open: start is in, end is out."""
    return df.where((F.col(time) >= start) & (F.col(time) < end))


def with_window_start(df: DataFrame, time: str = "published_at") -> DataFrame:
    return df.withColumn("window_start", hour_floor(F.col(time)))


def dedup_first(df: DataFrame, by: Sequence[str] = ("window_start", "id")) -> DataFrame:
    """The first copy of each article by ingestion time, feed order and entry order.

    `row_number = 1` is pruned to one row per key and task before the shuffle, so a key with very many
    copies is spread over the tasks that read it.
    """
    w = Window.partitionBy(*by).orderBy(*arrival_order(df))
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def window_anchor(ingestion_time: Column) -> Column:
    """Start of the last full hour before the ingestion time."""
    return hour_floor(ingestion_time) - hours(1)


def earliest_anchor(df: DataFrame, by: Sequence[str] = (), time: str = "ingestion_time") -> DataFrame:
    """Anchor from the earliest readable ingestion time per group; unreadable ones are skipped."""
    return df.groupBy(*by).agg(
        window_anchor(F.min(parse_date(F.col(time)))).alias("window_start")
    )


def stage_counters(flagged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows in, candidates (not noise), enriched and skipped, from the flags of `enrich.flag_kept`."""
    return flagged.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("is_candidate").alias("candidates"),
        F.count_if("kept").alias("enriched"),
        (F.count_if("is_candidate") - F.count_if("kept")).alias("skipped"),
    )


def write_split(rows: DataFrame, path: str, error: str = "error") -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Good rows, rows with an `error`, and how many of each: written in one pass, counted on the way.

    The rows are computed once, whatever is done with either part afterwards.
    """
    counted = Observation()
    bad = F.col(error).isNotNull()
    rows.observe(counted, F.count_if(~bad).alias("good"), F.count_if(bad).alias("quarantined")).withColumn(
        "_quarantined", bad
    ).write.partitionBy("_quarantined").parquet(path)
    stored = rows.sparkSession.read.schema(rows.schema.add("_quarantined", "boolean")).parquet(path)
    good, rest = (stored.where(F.col("_quarantined") == flag).drop("_quarantined") for flag in (False, True))
    return good.drop(error), rest, counted.get


def observed(df: DataFrame, observation: Observation) -> DataFrame:
    """Count rows as they pass; read `observation.get` after the frame's action."""
    return df.observe(observation, F.count(F.lit(1)).alias("rows"))
