"""tidewire: hourly news-signal features as Spark jobs."""

from tidewire.config import DEFAULT_CONFIG, EngineConfig, EventRule

__all__ = ["DEFAULT_CONFIG", "EngineConfig", "EventRule"]
