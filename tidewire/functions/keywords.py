"""Substring dictionaries.

All matching is by substring on lower-cased text. `hits` searches every distinct word once and gives
the words found; labels, rules and relevance are then set operations on that short list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewire.config import EngineConfig
from tidewire.functions.basics import bind, literal_array, literal_map
from tidewire.functions.text import lowered


def hits(text: Column, words: Sequence[str]) -> Column:
    """The words that occur in the text, in dictionary order."""
    return bind(lowered(text), lambda t: F.filter(literal_array(words), lambda w: F.contains(t, w)))


def contains_any(text: Column, words: Sequence[str]) -> Column:
    """Stops at the first word found."""
    return bind(lowered(text), lambda t: F.exists(literal_array(words), lambda w: F.contains(t, w)))


def is_relevant(text: Column, config: EngineConfig) -> Column:
    return contains_any(text, config.relevance_words)


def detect_assets(found: Column, config: EngineConfig) -> Column:
    """Asset labels in dictionary order; `UNKNOWN` when there is none."""
    labels = F.array_compact(F.array(*[
        F.when(F.arrays_overlap(found, literal_array(words)), F.lit(label))
        for label, words in config.asset_words.items()
    ]))
    return bind(labels, lambda x: F.when(F.size(x) > 0, x).otherwise(F.array(F.lit("UNKNOWN"))))


def standardize_category(category: Column, config: EngineConfig) -> Column:
    """Event type of the first fragment, in order, that occurs in the category."""
    def read(value: Column) -> Column:
        result = F.lit("unknown")
        for fragment, event_type in reversed(config.category_fragments):
            result = F.when(F.contains(value, F.lit(fragment)), event_type).otherwise(result)
        return result

    return bind(lowered(category), read)


def event_from_words(found: Column, config: EngineConfig) -> Column:
    """First rule, by priority, with enough distinct keywords."""
    result = F.lit("unknown")
    for rule in reversed(config.ordered_rules):
        if rule.min_hits == 1:
            matched = F.arrays_overlap(found, literal_array(rule.words))
        else:
            matched = F.size(F.array_intersect(found, literal_array(rule.words))) >= rule.min_hits
        result = F.when(matched, rule.event_type).otherwise(result)
    return result


def classify_event(found: Column, category: Column, config: EngineConfig) -> Column:
    """The mapped category if it is known, else the keyword rules."""
    return bind(
        standardize_category(category, config),
        lambda c: F.when(c != "unknown", c).otherwise(event_from_words(found, config)),
    )


def timeframe(event_type: Column, config: EngineConfig) -> Column:
    return F.coalesce(F.try_element_at(literal_map(config.timeframes), event_type), F.lit("short"))


def impact_base(event_type: Column, config: EngineConfig) -> Column:
    return F.coalesce(F.try_element_at(literal_map(config.impact_base), event_type), F.lit(0))
