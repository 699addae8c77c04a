"""The whole job: articles, verdicts, candles and macro series to one feature row per hour."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidewire.config import DEFAULT_CONFIG, EngineConfig
from tidewire.functions.keywords import is_relevant
from tidewire.functions.verdicts import parse_verdict
from tidewire.operators.articles import (
    ARRIVAL,
    dedup_first,
    normalize_articles,
    quarantine_split,
    with_clean_fields,
    with_window_start,
)
from tidewire.operators.asof import asof_join, latest_row
from tidewire.operators.enrich import measure_articles, score_sentiment, text_of, with_event
from tidewire.operators.market import (
    choose_tickers,
    macro_series,
    market_features,
    snapshot_series,
)
from tidewire.operators.noise import INSTRUCTIONS, ask_classifier, single_prompts
from tidewire.operators.windows import (
    fill_empty_windows,
    flagged_window_features,
    hour_calendar,
    with_hourly_momentum,
)
from tidewire.schemas import FEATURES
from tidewire.session import materialize

PRICE_COLUMNS = (
    "btc_open", "btc_close", "btc_high", "btc_low", "btc_volume", "btc_return_6h", "btc_return_24h",
    "rsi_14", "macd", "bb_position", "volume_ratio", "etf_net_flow_24h",
)


class StageCounts:
    """Rows that pass the stages of a job, counted while the job runs.

    Give one to `news_features` or `hourly_features` and read `counts` after an action on the result. The counts cost
    no scan. They are those of one pass: a classifier given as code makes the job read articles twice, so its counts of
    `raw` and `normalised` are those of the first pass.
    """

    STAGES = ("raw", "normalised", "unique")

    def __init__(self) -> None:
        self._of = {stage: Observation() for stage in self.STAGES}

    def watch(self, df: DataFrame, stage: str, **flags: Column) -> DataFrame:
        return df.observe(
            self._of[stage], F.count(F.lit(1)).alias(stage), *[F.count_if(flag).alias(name) for name, flag in flags.items()]
        )

    @property
    def counts(self) -> dict[str, int]:
        """raw, normalised, unique, candidates and kept; waits until the job is through."""
        return {name: n for stage in self.STAGES for name, n in self._of[stage].get.items()}


def news_features(
    raw: DataFrame,
    verdicts: DataFrame | None,
    config: EngineConfig = DEFAULT_CONFIG,
    scorer: Callable | None = None,
    classifier: Callable | None = None,
    instructions: str = INSTRUCTIONS,
    counts: StageCounts | None = None,
) -> DataFrame:
    """News features of every hour with an article.

    Articles are measured while they are scanned; the duplicate filter and the verdict join then move
    narrow rows, never text. `verdicts` has one row per `id` with `is_noise` and maybe `category`.
    A `scorer` (see `score_sentiment`) replaces the word lists, a `classifier` (see `ask_classifier`) the
    verdicts; both are asked about relevant articles only, the classifier once per article.
    """
    if counts is not None:
        raw = counts.watch(raw, "raw")
    cleaned = with_window_start(normalize_articles(raw))
    if counts is not None:
        cleaned = counts.watch(cleaned, "normalised")
    relevant = is_relevant(text_of(cleaned), config)
    if classifier is not None:
        asked = single_prompts(dedup_first(cleaned.where(relevant)), instructions)
        verdicts = ask_classifier(asked.select("id", "prompt"), classifier).select(
            "id", parse_verdict(F.col("reply")).alias("_v")
        ).select("id", "_v.is_noise", "_v.category").dropDuplicates(["id"])
    if scorer is not None:
        cleaned = score_sentiment(cleaned, scorer, only=relevant)
    keys = [c for c in ("window_start", "id", *ARRIVAL) if c in cleaned.columns]
    measured = measure_articles(cleaned, tuple(keys), config)
    judged = with_event(dedup_first(measured).join(verdicts, "id", "left"), config)
    kept = F.coalesce(~F.col("is_noise"), F.lit(False)) & F.col("relevant")
    flagged = judged.withColumn("kept", kept)
    if counts is not None:
        flagged = counts.watch(
            flagged, "unique", candidates=F.coalesce(~F.col("is_noise"), F.lit(False)), kept=F.col("kept")
        )
    return flagged_window_features(flagged)


def rejected_articles(raw: DataFrame) -> DataFrame:
    """The rows that `news_features` leaves out, cleaned as far as they go, with the reason in `_error`."""
    return quarantine_split(with_clean_fields(raw))[1]


def merge_feature_groups(
    news: DataFrame,
    candles: DataFrame,
    macro_daily: DataFrame,
    snapshots: DataFrame,
    symbol: str,
    fear_greed: bool = False,
    config: EngineConfig = DEFAULT_CONFIG,
) -> DataFrame:
    """News, market and macro groups side by side, each read as of its window.

    Prices are those of the last candle opened by the window start; macro and snapshot readings are
    those known at the window's end, when the row is computed, each kind by itself. Dominance stays NULL in empty windows, and
    the fear-greed index is off unless asked for.
    """
    prices = market_features(candles.where(F.col("symbol") == symbol))
    read = asof_join(
        news,
        latest_row(prices, "open_time", list(PRICE_COLUMNS), lookahead_hours=0),
        macro_series(macro_daily, config.macro_tickers),
        snapshot_series(snapshots),
    )
    merged = choose_tickers(read, config.macro_tickers)
    return merged.withColumns({
        "btc_dominance": F.when(F.col("article_count") > 0, F.col("btc_dominance")),
        "fear_greed_index": F.col("fear_greed_index") if fear_greed else F.lit(None).cast("double"),
    })


def hourly_features(
    raw: DataFrame,
    verdicts: DataFrame | None,
    candles: DataFrame,
    macro_daily: DataFrame,
    snapshots: DataFrame,
    symbol: str,
    config: EngineConfig = DEFAULT_CONFIG,
    scorer: Callable | None = None,
    classifier: Callable | None = None,
    counts: StageCounts | None = None,
) -> DataFrame:
    """The stored feature row for every hour between the first and the last article.

    Runs the article job and writes its result, one row per hour, to the shared work folder: the
    calendar, the as-of joins and the momentum all read that small table and not the articles again.
    """
    news = materialize(news_features(raw, verdicts, config, scorer, classifier, counts=counts), "news-features")
    every_hour = fill_empty_windows(news, hour_calendar(news))
    merged = with_hourly_momentum(
        merge_feature_groups(every_hour, candles, macro_daily, snapshots, symbol, config=config)
    )
    return merged.to(FEATURES)
