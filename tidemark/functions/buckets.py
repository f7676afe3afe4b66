"""Time buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Candle widths in minutes.
FRAMES = {"1m": 1, "5m": 5, "15m": 15, "30m": 30, "1h": 60, "1d": 1440}


def frame(name: str) -> str:
    """A width's duration text; unknown widths raise."""
    if name not in FRAMES:
        raise ValueError(f"timeframe must be one of {', '.join(FRAMES)}")
    return f"{FRAMES[name]} minutes"


def bucket(ts: Column | str, width: str) -> Column:
    """The start of the tumbling window that holds a time (``window`` keeps the time's own type)."""
    return F.window(ts, width)["start"]


def coarsest_for(minutes: int, stored: list[str]) -> str | None:
    """The widest stored candle that an interval of so many minutes is made of; None: only raw trades will do."""
    fits = [f for f in stored if minutes % FRAMES[f] == 0 and (1440 % minutes == 0 or FRAMES[f] <= minutes)]
    return max(fits, key=FRAMES.__getitem__, default=None)
