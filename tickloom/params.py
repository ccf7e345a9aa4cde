"""Tunable settings of the engine."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields, replace

MICROS = 1_000_000


@dataclass(frozen=True)
class Params:
    """Every limit the operators use; times are whole seconds of event time."""

    window_seconds: int = 60
    warmup_min_samples: int = 30
    data_gap_reset_seconds: int = 10
    stale_purge_seconds: int = 60
    z_score_threshold: float = 3.0
    retail_max: float = 500.0
    pro_max: float = 50_000.0
    ingestion_rate_threshold: float = 500.0
    burst_window_seconds: int = 5
    batch_flush_interval_ms: int = 100
    batch_flush_size: int = 500
    topic: str = "trades_raw"
    symbol_partitions: tuple[tuple[str, int], ...] = (("BTCUSDT", 0), ("ETHUSDT", 1))
    candle_seconds: int = 60
    # Width of the time slices that share the work on one symbol, in multiples of
    # the longest look-back. Larger: less overlap; smaller: more parallel tasks.
    slice_factor: int = 4

    def __post_init__(self) -> None:
        for name in (
            "window_seconds",
            "warmup_min_samples",
            "data_gap_reset_seconds",
            "stale_purge_seconds",
            "burst_window_seconds",
            "candle_seconds",
            "slice_factor",
        ):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} must be at least 1")

    @property
    def window_us(self) -> int:
        return self.window_seconds * MICROS

    @property
    def purge_us(self) -> int:
        return self.stale_purge_seconds * MICROS

    @property
    def pause_us(self) -> int:
        """Shortest gap that pauses scoring; a purge always pauses as well."""
        return min(self.data_gap_reset_seconds, self.stale_purge_seconds) * MICROS

    @property
    def lookback_us(self) -> int:
        return max(self.window_us, self.purge_us)

    @property
    def slice_us(self) -> int:
        return self.lookback_us * self.slice_factor

    @property
    def symbols(self) -> tuple[str, ...]:
        return tuple(symbol for symbol, _ in self.symbol_partitions)

    def with_(self, **changes) -> "Params":
        return replace(self, **changes)

    @classmethod
    def from_env(cls, env=os.environ) -> "Params":
        """Read the settings that have an environment variable of the same name."""
        names = {"topic": "KAFKA_TOPIC_RAW"}
        found = {}
        for f in fields(cls):
            raw = env.get(names.get(f.name, f.name.upper()))
            if raw is None or f.name == "symbol_partitions":
                continue
            kind = type(f.default)
            found[f.name] = kind(raw)
        return cls(**found)
