"""Declared schemas of the stages. Timestamps are TIMESTAMP_NTZ holding UTC."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

RAW_ARTICLE = StructType([
    StructField(name, StringType())
    for name in ("title", "content", "url", "source", "raw_published_at")
])

# Elements stay text here: an element may be an object or a string that holds an encoded object.
ENVELOPE = StructType([
    StructField("ingestion_time", StringType()),
    StructField("articles", ArrayType(StringType())),
])

VERDICT = StructType([
    StructField("is_noise", BooleanType()),
    StructField("reason", StringType()),
    StructField("category", StringType()),
])

CANDLE = StructType(
    [StructField("symbol", StringType()), StructField("open_time", TimestampNTZType())]
    + [StructField(c, DoubleType()) for c in ("open", "high", "low", "close", "volume")]
)

MACRO_DAILY = StructType([
    StructField("ticker", StringType()),
    StructField("day", DateType()),
    StructField("close", DoubleType()),
])

ENRICHED_FIELDS = (
    "id", "title", "content", "url", "source", "event_type", "asset_mentioned", "impact_score",
    "timeframe", "source_weight", "headline_sentiment_score", "headline_sentiment_label",
    "headline_sentiment_conf", "content_sentiment_score", "content_sentiment_label",
    "final_sentiment_score", "final_sentiment_label",
)

_INT, _DBL, _BOOL = IntegerType(), DoubleType(), BooleanType()


def _fields(dtype, names: str) -> list[StructField]:
    return [StructField(name, dtype) for name in names.split()]


# The stored feature row without its bookkeeping column `created_at`.
FEATURES = StructType(
    [StructField("window_start", TimestampNTZType()), StructField("sentiment_momentum", _DBL)]
    + _fields(_INT, "article_count total_raw")
    + _fields(_DBL, "noise_ratio avg_sentiment max_sentiment min_sentiment sentiment_std "
                    "weighted_avg_sentiment")
    + _fields(_INT, "positive_count negative_count neutral_count")
    + _fields(_DBL, "avg_confidence avg_impact")
    + _fields(_INT, "max_impact high_impact_count mid_impact_count low_impact_count")
    + _fields(_DBL, "net_impact_sentiment")
    + _fields(_BOOL, "has_regulation has_hack has_institutional has_macro has_whale has_geopolitical "
                     "has_listing has_defi has_security")
    + _fields(_INT, "regulation_count hack_count institutional_count macro_count btc_mentions "
                    "eth_mentions regulation_mentions exchange_mentions market_mentions defi_mentions "
                    "etf_mentions")
    + _fields(_DBL, "avg_source_weight max_source_weight btc_open btc_close btc_high btc_low "
                    "btc_volume btc_return_6h btc_return_24h rsi_14 macd bb_position volume_ratio "
                    "btc_dominance fear_greed_index etf_net_flow_24h dxy gold_price sp500_return_1d "
                    "us_10y_yield")
)
FEATURE_COLUMNS = tuple(FEATURES.fieldNames())
