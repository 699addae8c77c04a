"""Impact and sentiment of one article."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewire import fixed_values as fv
from tidewire.config import EngineConfig
from tidewire.functions.basics import bind, literal_array, literal_map, round_dp
from tidewire.functions.keywords import hits, impact_base
from tidewire.functions.text import strip


def source_weight(source: Column, config: EngineConfig) -> Column:
    """Lookup in the configured weights, without a join."""
    if not config.source_weights:
        return F.lit(config.default_source_weight)
    known = F.try_element_at(literal_map(config.source_weights), F.coalesce(source, F.lit("")))
    return F.coalesce(known, F.lit(config.default_source_weight))


def impact_score(event_type: Column, weight: Column, assets: Column, config: EngineConfig) -> Column:
    """0 to 3: base by event, moved by the source's weight, raised for market-wide subjects."""
    def tune(base: Column) -> Column:
        return (
            F.when((base > 0) & (weight >= fv.STRONG_SOURCE), F.least(base + 1, F.lit(3)))
            .when((base > 0) & (weight <= fv.WEAK_SOURCE), base - 1)
            .otherwise(base)
        )

    market_wide = F.arrays_overlap(assets, literal_array(fv.IMPACT_BOOST_ASSETS))
    raised = bind(
        bind(impact_base(event_type, config), tune),
        lambda score: F.when((score < 3) & market_wide, score + 1).otherwise(score),
    )
    return raised.cast("int")


def scored_text(text: Column, chars: int | None = None) -> Column:
    """What a sentiment model gets to see: the whole text, or its first `chars` characters."""
    return strip(text if chars is None else F.substring(text, 1, chars))


def is_scorable(text: Column) -> Column:
    return F.length(strip(F.coalesce(text, F.lit("")))) >= fv.SHORTEST_SCORED


def sentiment_from_probs(text: Column, probs: Column) -> Column:
    """struct<score, label, conf> from struct<positive, negative, neutral>.

    A missing class counts as 0; ties go to positive, then negative. Short texts are neutral.
    """
    def read(p: Column) -> Column:
        pos, neg, neu = (
            F.coalesce(p[c], F.lit(0.0)) for c in ("positive", "negative", "neutral")
        )
        top = F.greatest(pos, neg, neu)
        label = F.when(pos == top, "positive").when(neg == top, "negative").otherwise("neutral")
        return F.struct(
            round_dp(pos - neg, 4).alias("score"), label.alias("label"), round_dp(top, 4).alias("conf")
        )

    silent = F.struct(
        F.lit(0.0).alias("score"), F.lit("neutral").alias("label"), F.lit(0.0).alias("conf")
    )
    return F.when(is_scorable(text), bind(probs, read)).otherwise(silent)


def blend_score(headline: Column, content_text: Column, content: Column) -> Column:
    """0.4 headline + 0.6 content, or the headline alone when there is no content."""
    mixed = round_dp(fv.HEADLINE_SHARE * headline + fv.CONTENT_SHARE * content, 4)
    return F.when(F.coalesce(content_text, F.lit("")) != "", mixed).otherwise(headline)


def polarity_label(score: Column) -> Column:
    return (
        F.when(score > fv.POLARITY, "positive")
        .when(score < -fv.POLARITY, "negative")
        .otherwise("neutral")
    )


# Our own small word lists for the offline scorer; any model can take its place.
GOOD_WORDS = (
    "surge", "rally", "gain", "approved", "record", "growth", "rebound", "launches", "adds", "buys",
    "breakout", "inflow", "profit", "recover",
)
BAD_WORDS = (
    "hack", "crash", "plunge", "lawsuit", "stolen", "ban", "breach", "drained", "recession", "loss",
    "outflow", "exploit", "fraud", "default",
)


def lexicon_probs(
    text: Column, good: Sequence[str] = GOOD_WORDS, bad: Sequence[str] = BAD_WORDS, chars: int | None = None
) -> Column:
    """Class probabilities from counts of distinct good and bad words in the scored text."""
    def shares(n: Column) -> Column:
        total = (n["good"] + n["bad"] + 1).cast("double")
        return F.struct(
            (n["good"] / total).alias("positive"),
            (n["bad"] / total).alias("negative"),
            (1 / total).alias("neutral"),
        )

    scored = scored_text(text, chars)
    counts = F.struct(
        F.size(hits(scored, good)).alias("good"), F.size(hits(scored, bad)).alias("bad")
    )
    return bind(counts, shares)
