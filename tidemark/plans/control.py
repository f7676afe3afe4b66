"""Flow control: degradation levels by lag and memory, load shedding by priority, a circuit breaker."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# How many priority tiers are let through at each level of degradation.
TIERS_AT = {0: 3, 1: 3, 2: 2, 3: 1, 4: 1}


def shed(df: DataFrame, tiers: dict[str, int], level: int, key: str = "symbol", default: int = 3) -> DataFrame:
    """Rows whose key's tier is let through at this level.  The tiers are a literal: their size is the configuration's."""
    if level not in TIERS_AT:
        raise ValueError(f"level must be one of {sorted(TIERS_AT)}")
    if not tiers:
        return df if default <= TIERS_AT[level] else df.limit(0)
    tier = F.coalesce(F.create_map(*(F.lit(x) for pair in tiers.items() for x in pair))[F.col(key)], F.lit(default))
    return df.filter(tier <= TIERS_AT[level])


@dataclass
class Degradation:
    """Level 0 to 4 from consumer lag and memory share.

    It rises at once; it falls a level at a time, after a pause, and only once lag is below half of and memory below nine tenths of the
    level's threshold.
    """

    # Lags and memory shares of the levels 1 to 4.
    lag_steps: tuple[int, ...] = (100_000, 500_000, 1_000_000, 5_000_000)
    memory_steps: tuple[float, ...] = (0.70, 0.80, 0.90, 0.95)
    pause: float = 30.0
    clock: Callable[[], float] = time.monotonic
    level: int = 0
    changed: float = field(default=float("-inf"))

    def update(self, lag: int, memory: float = 0.0) -> int:
        wanted = max(sum(lag >= s for s in self.lag_steps), sum(memory >= s for s in self.memory_steps))
        now = self.clock()
        if wanted > self.level:
            self.level, self.changed = wanted, now
        elif wanted < self.level and now - self.changed >= self.pause:
            step = self.level - 1
            if lag < 0.5 * self.lag_steps[step] and memory < 0.9 * self.memory_steps[step]:
                self.level, self.changed = step, now
        return self.level


class Open(RuntimeError):
    """The breaker lets nothing through."""


@dataclass
class Breaker:
    """After so many failures calls are refused for a while; then they are tried, and so many successes close it."""

    failures: int = 5
    rest: float = 60.0
    successes: int = 2
    clock: Callable[[], float] = time.monotonic
    state: str = "closed"
    count: int = 0
    since: float = 0.0

    def call(self, do: Callable, *args, **kwargs):
        if self.state == "open":
            if self.clock() - self.since < self.rest:
                raise Open("refused: the last calls failed")
            self.state, self.count = "half-open", 0
        try:
            result = do(*args, **kwargs)
        except Exception:
            self.count += 1
            if self.state == "half-open" or self.count >= self.failures:
                self.state, self.since, self.count = "open", self.clock(), 0
            raise
        if self.state == "half-open":
            self.count += 1
            if self.count >= self.successes:
                self.state, self.count = "closed", 0
        else:
            self.count = 0
        return result
