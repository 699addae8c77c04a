"""Enrichment of articles: relevance, event, assets, impact and sentiment."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.config import DEFAULT_CONFIG, EngineConfig
from tidewire.functions import keywords as kw
from tidewire.functions import scoring as sc
from tidewire.functions.basics import literal_array
from tidewire.functions.text import article_text
from tidewire.schemas import ENRICHED_FIELDS

CLASSES = ("positive", "negative", "neutral")
PROBS_TYPE = "struct<positive:double,negative:double,neutral:double>"


def text_of(df: DataFrame) -> Column:
    names = [c for c in ("title", "description", "content") if c in df.columns]
    return article_text(*[F.col(c) for c in names])


def body_of(df: DataFrame) -> Column:
    """Content, or the description when there is no content."""
    if "description" not in df.columns:
        return F.col("content")
    return F.coalesce(F.nullif("content", F.lit("")), F.col("description"))


def relevance_gate(df: DataFrame, config: EngineConfig = DEFAULT_CONFIG) -> DataFrame:
    return df.where(kw.is_relevant(text_of(df), config))


def attach_source_weight(
    df: DataFrame, weights: DataFrame, default: float = DEFAULT_CONFIG.default_source_weight
) -> DataFrame:
    """Lookup in a weights table (source, weight) with one row per source.

    No broadcast is forced: the planner broadcasts the table while its size allows, and falls back to
    a shuffled join, whose hot sources AQE splits.
    """
    table = weights.select(F.col("source").alias("_source"), F.col("weight").cast("double").alias("_w"))
    return (
        df.join(table, F.coalesce(df["source"], F.lit("")) == table["_source"], "left")
        .withColumn("source_weight", F.coalesce("_w", F.lit(default)))
        .drop("_source", "_w")
    )


def score_sentiment(
    df: DataFrame, scorer_factory: Callable[[], Callable[[list[str]], list[dict]]], chars: int | None = None,
    only: Column | None = None,
) -> DataFrame:
    """Add `headline_probs` and `content_probs` from user code, loaded once per task.

    `scorer_factory()` returns a function from a list of texts to a list of class-probability dicts.
    It sees the whole texts, or their first `chars` characters; texts too short to score get NULL, and so do
    rows that do not meet the condition `only`. Only the text to be scored goes to Python and only the probabilities come back.
    """
    def model_input(text: Column) -> Column:
        shown = sc.scored_text(text, chars)
        return F.when(sc.is_scorable(shown) if only is None else sc.is_scorable(shown) & only, shown)

    @F.pandas_udf(PROBS_TYPE)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = scorer_factory()
        for batch in batches:
            texts = batch.dropna()
            probs = pd.DataFrame(scorer(list(texts)), index=texts.index, dtype="float64")
            yield probs.reindex(index=batch.index, columns=list(CLASSES))

    # The inputs are made in a step of their own: a Python function does not take lambdas as they are.
    inputs = F.struct(model_input(F.col("title")).alias("_h"), model_input(body_of(df)).alias("_c"))
    shown = df.select("*", F.inline(F.array(inputs)))
    return shown.withColumns({
        name: F.when(F.col(given).isNotNull(), score(F.col(given)))
        for name, given in (("headline_probs", "_h"), ("content_probs", "_c"))
    }).drop("_h", "_c")


def with_lexicon_probs(df: DataFrame) -> DataFrame:
    """The offline scorer: class probabilities from built-in expressions."""
    return df.withColumns({
        "headline_probs": sc.lexicon_probs(F.col("title")),
        "content_probs": sc.lexicon_probs(body_of(df)),
    })


def with_sentiment(df: DataFrame, chars: int | None = None) -> DataFrame:
    """The seven sentiment columns from `headline_probs` and `content_probs`."""
    body = body_of(df)
    has_body = F.coalesce(body, F.lit("")) != ""
    scored = df.withColumns({
        "_head": sc.sentiment_from_probs(F.col("title"), F.col("headline_probs")),
        "_body": sc.sentiment_from_probs(sc.scored_text(body, chars), F.col("content_probs")),
    })
    return (
        scored.withColumn(
            "final_sentiment_score",
            sc.blend_score(F.col("_head.score"), body, F.col("_body.score")),
        )
        .withColumns({
            "headline_sentiment_score": F.col("_head.score"),
            "headline_sentiment_label": F.col("_head.label"),
            "headline_sentiment_conf": F.col("_head.conf"),
            "content_sentiment_score": F.when(has_body, F.col("_body.score")).otherwise(0.0),
            "content_sentiment_label": F.when(has_body, F.col("_body.label")).otherwise("neutral"),
            "final_sentiment_label": sc.polarity_label(F.col("final_sentiment_score")),
        })
        .drop("_head", "_body", "headline_probs", "content_probs")
    )


def with_word_classes(
    df: DataFrame, hits: str = "_hits", config: EngineConfig = DEFAULT_CONFIG
) -> DataFrame:
    """What the words alone decide: `word_event` and the assets."""
    return df.withColumns({
        "word_event": kw.event_from_words(F.col(hits), config),
        "asset_mentioned": kw.detect_assets(F.col(hits), config),
    })


def with_event(df: DataFrame, config: EngineConfig = DEFAULT_CONFIG) -> DataFrame:
    """Event, timeframe and impact once the verdict's category is there (or missing for good).

    Without a `source_weight` from a table the configured weights are looked up by `source`.
    """
    if "source_weight" not in df.columns:
        df = df.withColumn("source_weight", sc.source_weight(F.col("source"), config))
    category = F.col("category") if "category" in df.columns else F.lit(None).cast("string")
    named = kw.standardize_category(category, config)
    return (
        df.withColumn("_named", named)
        .withColumn(
            "event_type",
            F.when(F.col("_named") != "unknown", F.col("_named")).otherwise(F.col("word_event")),
        )
        .withColumns({
            "timeframe": kw.timeframe(F.col("event_type"), config),
            "impact_score": sc.impact_score(
                F.col("event_type"), F.col("source_weight"), F.col("asset_mentioned"), config
            ),
        })
        .drop("_named", "word_event")
    )


def enrich_articles(df: DataFrame, config: EngineConfig = DEFAULT_CONFIG) -> DataFrame:
    """Stage output: kept articles with the published field list and the grouping keys.

    The relevance filter stops at the first word found; the full hit list is built for survivors only.
    """
    candidates = relevance_gate(df.where(~F.col("is_noise")), config)
    if "headline_probs" not in df.columns:
        candidates = with_lexicon_probs(candidates)
    found = candidates.withColumn("_hits", kw.hits(text_of(candidates), config.all_words))
    enriched = with_sentiment(with_event(with_word_classes(found, config=config), config))
    carried = [c for c in ("window_start", "feed_ord", "entry_ord", "doc_id") if c in df.columns]
    return enriched.select(*carried, *ENRICHED_FIELDS)


MEASURES = (
    "event_type", "asset_mentioned", "impact_score", "source_weight", "headline_sentiment_score",
    "headline_sentiment_conf", "final_sentiment_score",
)


def flag_kept(df: DataFrame, config: EngineConfig = DEFAULT_CONFIG) -> DataFrame:
    """Every article with `is_candidate` and `kept` instead of a filter, for one-pass counting."""
    relevant = kw.is_relevant(text_of(df), config)
    candidate = F.coalesce(~F.col("is_noise"), F.lit(False))
    return df.withColumn("is_candidate", candidate).withColumn(
        "kept", F.when(F.col("is_candidate"), relevant).otherwise(False)
    )


def measure_articles(
    df: DataFrame, keys: tuple[str, ...], config: EngineConfig = DEFAULT_CONFIG
) -> DataFrame:
    """Narrow rows for aggregation: keys, source, `relevant` and what the text decides; no text.

    This is row-local, so a job that only needs features runs it before the dedup shuffle and moves
    some hundred bytes per article in place of its text; `with_event` completes the measures after
    the verdicts are known. Measures of irrelevant rows are not used.
    """
    if "headline_probs" not in df.columns:
        df = with_lexicon_probs(df)
    found = df.withColumn("_hits", kw.hits(text_of(df), config.all_words))
    words = literal_array(config.relevance_words)
    flagged = found.withColumn("relevant", F.arrays_overlap("_hits", words))
    return with_sentiment(with_word_classes(flagged, config=config)).select(
        *keys, "source", "relevant", "word_event", "asset_mentioned",
        "headline_sentiment_score", "headline_sentiment_conf", "final_sentiment_score",
    )
