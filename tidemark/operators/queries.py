"""Interactive queries over trades, quotes and bars: filters, newest first, summaries, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.buckets import FRAMES


def where(df: DataFrame, *conditions: Column | None) -> DataFrame:
    for c in conditions:
        if c is not None:
            df = df.filter(c)
    return df


def one_of(column: str, values: str | list[str] | None) -> Column | None:
    if values is None or values == []:
        return None
    return F.col(column) == values if isinstance(values, str) else F.col(column).isin(list(values))


def named(column: str, name: str) -> Column:
    """A name as it is written or upper-cased; plain values, so the scan can prune."""
    bare = name.strip()
    return F.col(column).isin(*dict.fromkeys((bare, bare.upper())))


def at_least(column: str, value) -> Column | None:
    return None if value is None else F.col(column) >= F.lit(value)


def at_most(column: str, value) -> Column | None:
    return None if value is None else F.col(column) <= F.lit(value)


def limited(limit, most: int = 10_000) -> int:
    """A limit as a whole number from 1 to the most; anything else raises."""
    try:
        n = int(limit)
    except (TypeError, ValueError):
        raise ValueError(f"limit must be a whole number, not {limit!r}") from None
    if not 1 <= n <= most:
        raise ValueError(f"limit must be from 1 to {most}")
    return n


def newest(df: DataFrame, limit: int, offset: int = 0, ts: str = "ts", seq: str = "seq") -> DataFrame:
    """The newest rows first; ties go to the larger sequence."""
    out = df.orderBy(F.desc(ts), F.desc(seq))
    return (out.offset(offset) if offset else out).limit(limit)


def trades(df: DataFrame, *, symbols=None, exchanges=None, start=None, end=None, min_price=None, max_price=None, min_quantity=None, fields: list[str] | None = None, limit: int = 1000, offset: int = 0, ts: str = "ts", seq: str = "seq") -> DataFrame:
    """Filter, then order, then cut: all bounds inclusive."""
    found = where(df, one_of("symbol", symbols), one_of("exchange", exchanges), at_least(ts, start), at_most(ts, end), at_least("price", min_price), at_most("price", max_price), at_least("quantity", min_quantity))
    page = newest(found, limited(limit), offset, ts, seq)
    return page.select(*fields) if fields else page


quotes = trades


def bars(df: DataFrame, timeframe: str, *, symbol: str, exchange: str | None = None, start=None, end=None, limit=1000) -> DataFrame:
    """Bars of a symbol, newest first; names are trimmed, and taken as they are or upper-cased, timeframe and limit checked."""
    if timeframe not in FRAMES:
        raise ValueError(f"timeframe must be one of {', '.join(FRAMES)}")
    n = limited(limit)
    names = (named("symbol", symbol), None if exchange is None else named("exchange", exchange))
    return where(df, *names, at_least("window_start", start), at_most("window_start", end)).orderBy(F.desc("window_start"), "exchange").limit(n)


def page(df: DataFrame, after: tuple | None, size: int, ts: str = "ts", seq: str = "seq") -> DataFrame:
    """The next rows in time order after a (time, sequence) cursor: keyset paging, no row is skipped or read twice."""
    if after is not None:
        t, s = (F.lit(x) for x in after)
        df = df.filter((F.col(ts) > t) | ((F.col(ts) == t) & (F.col(seq) > s)))
    return df.orderBy(ts, seq).limit(size)


def symbols(df: DataFrame) -> DataFrame:
    return df.select("symbol").distinct().orderBy("symbol")


def time_range(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))


def replay_stats(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.agg(F.count("*").alias("total"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count_distinct("symbol").alias("symbols"), F.count_distinct("exchange").alias("exchanges"))


def summary(df: DataFrame, ts: str = "ts", seq: str = "seq", by: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Daily figures of each symbol over all venues; nothing for days without trades."""
    order = F.struct(ts, seq)
    return df.groupBy(*by, F.to_date(ts).alias("day")).agg(
        F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", order).alias("close"),
        F.sum("quantity").cast("decimal(38,8)").alias("volume"), F.count("*").alias("trade_count"),
        (F.sum((F.col("price") * F.col("quantity")).cast("decimal(38,16)")).cast("double") / F.nullif(F.sum("quantity").cast("double"), F.lit(0.0))).alias("vwap"),
    )


def latest_version(df: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """The row of the highest version of each key, by one aggregation."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*version)).alias("_r")).select(*keys, *(F.col(f"_r.{c}") for c in rest))


def repeated(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def hybrid(lake: DataFrame, tail: DataFrame, *, as_of, lag_seconds: int = 120, start=None, end=None, limit: int = 1000, key: str = "message_id", ts: str = "ts", seq: str = "seq") -> DataFrame:
    """Lake up to the commit lag, tail from there; a message in both is the lake's; newest rows, oldest first.

    Of either leg only the newest rows can be in the answer, so each gives a top-k, of some more rows than asked for, among which copies of a message
    count once (copies that lie farther apart are for compaction to remove).  A message has one time, so the legs share
    messages only at the cut.  Rows without a key are all kept.
    """
    cut = F.lit(as_of) - F.expr(f"INTERVAL {int(lag_seconds)} SECONDS")
    old = where(lake, at_least(ts, start), at_most(ts, end)).filter(F.col(ts) <= cut)
    fresh = where(tail, at_least(ts, start), at_most(ts, end)).filter(F.col(ts) >= cut)
    shared = old.filter((F.col(ts) >= cut) & F.col(key).isNotNull()).select(F.col(key).alias("_key"))
    fresh = fresh.join(shared, F.col(key) == F.col("_key"), "left_anti")
    legs = [_once(newest(leg, 2 * limit + 100, ts=ts, seq=seq), key, ts, seq) for leg in (old, fresh)]
    return newest(legs[0].unionByName(legs[1]), limit, ts=ts, seq=seq).orderBy(ts, seq)


def _once(df: DataFrame, key: str, ts: str, seq: str) -> DataFrame:
    """The first row of each key, by time and sequence; rows without a key are all kept."""
    first = F.row_number().over(Window.partitionBy(key).orderBy(ts, seq))
    return df.filter(F.col(key).isNotNull()).withColumn("_n", first).filter("_n = 1").drop("_n").unionByName(df.filter(F.col(key).isNull()))


def not_in(df: DataFrame, column: str, other: DataFrame, of: str) -> DataFrame:
    """``column NOT IN (SELECT of FROM other)`` as SQL has it: nothing if the other side holds a null, and no null rows unless it is empty.

    Two aggregates of the other side tell which case it is; the rest is an anti-join on the key.
    """
    told = other.agg(F.count("*").alias("_rows"), F.count_if(F.col(of).isNull()).alias("_nulls"))
    kept = df.join(other.select(F.col(of).alias("_of")), F.col(column) == F.col("_of"), "left_anti")
    return kept.join(F.broadcast(told)).filter((F.col("_rows") == 0) | (F.col("_nulls") == 0) & F.col(column).isNotNull()).drop("_rows", "_nulls")  # one row
