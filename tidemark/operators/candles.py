"""Candles: aggregation, mergeable states, roll-up, merging and invariants."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.buckets import FRAMES, frame

KEYS = ("exchange", "symbol", "window_start")


SHIFT = Decimal(10**19)


def _order(ts: str, seq: str | None) -> Column:
    """A total order in one number, so the aggregates' buffers stay fixed-width and hash aggregation applies.

    A sequence takes nineteen digits at most, which stand below the time's.
    """
    us = F.unix_micros(F.col(ts).cast("timestamp")).cast("decimal(19,0)")
    return us.cast("decimal(38,0)") if seq is None else (us * SHIFT + F.coalesce(F.col(seq), F.lit(0)).cast("decimal(19,0)")).cast("decimal(38,0)")


STATE = ("open_time", "close_time", "open_seq", "close_seq", "open", "high", "low", "close", "volume", "quote_volume", "trade_count")


def candles(trades: DataFrame, width: str, *, ts: str = "ts", seq: str | None = "seq", keys: tuple[str, ...] = ("exchange", "symbol")) -> DataFrame:
    """One bar for each key and tumbling window of ``width`` (a frame's name, or a duration).

    Open and close follow event time, ties the sequence (from 0 on).  The result holds mergeable states (times and sequences of open and close,
    quote_volume), so bars roll up and merge without the trades.
    """
    width = frame(width) if width in FRAMES else width
    own = F.lit(None).cast("long") if seq is None else F.col(seq).cast("long")
    t = trades.select(*keys, "price", "quantity", ts, own.alias("_s"), F.window(ts, width).alias("_w"), _order(ts, seq).alias("_o"))
    notional = (F.col("price") * F.col("quantity")).cast("decimal(38,16)")
    # Grouping by the window itself keeps a stream's watermark.
    bars = t.groupBy(*keys, "_w").agg(
        F.min(ts).alias("open_time"),
        F.max(ts).alias("close_time"),
        F.min_by("_s", "_o").alias("open_seq"),
        F.max_by("_s", "_o").alias("close_seq"),
        F.min_by("price", "_o").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "_o").alias("close"),
        F.sum("quantity").cast("decimal(38,8)").alias("volume"),
        F.sum(notional).cast("decimal(38,8)").alias("quote_volume"),
        F.count("*").alias("trade_count"),
    )
    named = bars.select(*keys, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *bars.columns[len(keys) + 1 :])
    return named.withColumn("vwap", vwap())


def vwap() -> Column:
    """Volume-weighted price as a double; null without volume."""
    return F.col("quote_volume").cast("double") / F.nullif(F.col("volume").cast("double"), F.lit(0.0))


def _combined(bars: DataFrame, keys: list) -> DataFrame:
    """States put together: the open of the first (time, sequence), the close of the last, sums of sums."""
    first, last = _order("open_time", "open_seq"), _order("close_time", "close_seq")
    marked = bars.withColumns({"_f": first, "_l": last})
    out = marked.groupBy(*keys).agg(
        F.min("open_time").alias("open_time"),
        F.max("close_time").alias("close_time"),
        F.min_by("open_seq", "_f").alias("open_seq"),
        F.max_by("close_seq", "_l").alias("close_seq"),
        F.min_by("open", "_f").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "_l").alias("close"),
        F.sum("volume").cast("decimal(38,8)").alias("volume"),
        F.sum("quote_volume").cast("decimal(38,8)").alias("quote_volume"),
        F.sum("trade_count").alias("trade_count"),
    )
    return out.withColumn("vwap", vwap())


def roll_up(bars: DataFrame, width: str, keys: tuple[str, ...] = ("exchange", "symbol")) -> DataFrame:
    """Wider bars out of narrower ones."""
    w = F.window("window_start", frame(width) if width in FRAMES else width)
    marked = bars.withColumn("_w", w)
    return _combined(marked, [*keys, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end")])


def merge_additive(old: DataFrame, new: DataFrame) -> DataFrame:
    """Bars of disjoint slices of trades, put together by key: one shuffle of partial states."""
    return _combined(old.unionByName(new), ["exchange", "symbol", "window_start", "window_end"])


def over_venues(bars: DataFrame) -> DataFrame:
    """Bars of a symbol over all venues, out of those of each."""
    return _combined(bars, ["symbol", "window_start", "window_end"])


def merge_replace(old: DataFrame, new: DataFrame) -> DataFrame:
    """New bars in place of old ones of the same key; others stay.  Safe to run twice."""
    return old.join(new.select(*KEYS), list(KEYS), "left_anti").unionByName(new)


def upsert(old: DataFrame, new: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """MERGE by key: matched rows are replaced column by column where the new value isn't null, others inserted."""
    rest = [c for c in old.columns if c not in keys]
    o, n = old.withColumn("_old", F.lit(True)).alias("o"), new.withColumn("_new", F.lit(True)).alias("n")
    joined = o.join(n, list(keys), "full")
    return joined.select(*keys, *(F.when(F.col("_new"), F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}"))).otherwise(F.col(f"o.{c}")).alias(c) for c in rest))


def violations() -> dict[str, Column]:
    """What must not hold for a bar."""
    return {
        "price_order": ~((F.col("high") >= F.greatest("open", "close", "low")) & (F.col("low") <= F.least("open", "close", "high"))),
        "vwap_bounds": ~F.col("vwap").between(F.col("low").cast("double") - 1e-8, F.col("high").cast("double") + 1e-8),
        "positive_volume": ~((F.col("volume") > 0) & (F.col("trade_count") > 0)),
        "window_order": ~(F.col("window_end") > F.col("window_start")),
    }


def invariants(bars: DataFrame) -> DataFrame:
    """One row: how many bars there are and how many break each rule; a rule that can't be told counts as broken."""
    return bars.agg(F.count("*").alias("bars"), *(F.count_if(F.coalesce(rule, F.lit(True))).alias(name) for name, rule in violations().items()))


def buckets(trades: DataFrame, width: str, metrics: list[str], *, ts: str = "ts", seq: str | None = "seq") -> DataFrame:
    """Ad-hoc metrics by symbol and window, ordered: open, high, low, close, volume, count, vwap, twap."""
    known = {
        "open": F.min_by("price", "_o"), "high": F.max("price"), "low": F.min("price"), "close": F.max_by("price", "_o"),
        "volume": F.sum("quantity").cast("decimal(38,8)"), "trade_count": F.count("*"), "twap": F.avg(F.col("price").cast("double")),
        "vwap": F.sum((F.col("price") * F.col("quantity")).cast("decimal(38,16)")).cast("double") / F.nullif(F.sum("quantity").cast("double"), F.lit(0.0)),
    }
    if unknown := [m for m in metrics if m not in known]:
        raise ValueError(f"unknown metrics: {', '.join(unknown)}")
    t = trades.withColumn("_o", _order(ts, seq)).withColumn("_w", F.window(ts, frame(width) if width in FRAMES else width)["start"])
    return t.groupBy("symbol", F.col("_w").alias("bucket")).agg(*(known[m].alias(m) for m in metrics)).orderBy("symbol", "bucket")


def volume_profile(trades: DataFrame, width: str, step: float, *, ts: str = "ts") -> DataFrame:
    """Volume by symbol, window and price level."""
    level = (F.floor(F.col("price").cast("double") / step) * step).alias("price_level")
    return trades.groupBy("symbol", F.window(ts, frame(width))["start"].alias("bucket"), level).agg(F.sum("quantity").cast("decimal(38,8)").alias("volume"), F.count("*").alias("trade_count"))
