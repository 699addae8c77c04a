"""Immutable engine settings. Every operator takes a config, so dictionaries can be swapped."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from types import MappingProxyType

from tidewire import fixed_values as fv


@dataclass(frozen=True)
class EventRule:
    event_type: str
    priority: int
    min_hits: int
    words: tuple[str, ...]


def _frozen(mapping: Mapping):
    return field(default_factory=lambda: MappingProxyType(dict(mapping)))


@dataclass(frozen=True)
class EngineConfig:
    relevance_words: tuple[str, ...] = fv.RELEVANCE_WORDS
    asset_words: Mapping[str, tuple[str, ...]] = _frozen(fv.ASSET_WORDS)
    category_fragments: tuple[tuple[str, str], ...] = fv.CATEGORY_FRAGMENTS
    event_rules: tuple[EventRule, ...] = tuple(EventRule(*r) for r in fv.EVENT_RULES)
    timeframes: Mapping[str, str] = _frozen(fv.TIMEFRAMES)
    impact_base: Mapping[str, int] = _frozen(fv.IMPACT_BASE)
    source_weights: Mapping[str, float] = _frozen(fv.SOURCE_WEIGHTS)
    default_source_weight: float = fv.DEFAULT_SOURCE_WEIGHT
    macro_tickers: Mapping[str, tuple[str, ...]] = _frozen(fv.MACRO_TICKERS)

    @property
    def ordered_rules(self) -> tuple[EventRule, ...]:
        """Rules by falling priority; `sorted` is stable, so ties keep their written order."""
        return tuple(sorted(self.event_rules, key=lambda r: -r.priority))

    @property
    def all_words(self) -> tuple[str, ...]:
        """Every distinct keyword once: the shared hit list is searched a single time per text."""
        words = list(self.relevance_words)
        for group in self.asset_words.values():
            words.extend(group)
        for rule in self.event_rules:
            words.extend(rule.words)
        return tuple(dict.fromkeys(words))


DEFAULT_CONFIG = EngineConfig()
