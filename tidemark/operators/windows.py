"""Row windows that don't gather a key in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered(df: DataFrame, *, keys: list[str], order: list[str], ts: str = "ts", bucket_seconds: int = 86_400, name: str = "_i") -> DataFrame:
    """Each row's place in its key's order, from 0: places within a time bucket, plus the rows of the buckets before, counted first."""
    cut = df.withColumn("_bucket", F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / int(bucket_seconds)))
    counts = cut.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*keys, "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    own = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    return cut.join(counts, [*keys, "_bucket"]).withColumn(name, F.col("_before") + F.row_number().over(own) - 1).drop("_bucket", "_before")


def over_preceding(df: DataFrame, n: int, out: dict[str, Column], *, keys: list[str], order: list[str], ts: str = "ts", block: int = 1 << 16, bucket_seconds: int = 86_400) -> DataFrame:
    """Aggregates over a row and the ``n`` rows before it in its key's order.

    Rows are dealt by blocks of their place; a block also gets the last ``n`` rows of the one before.  A key with most rows is
    so spread over many tasks.  The order must be total; ``ts`` is its first column.
    """
    if not 0 < n < block:
        raise ValueError("the frame must be smaller than a block")
    rows = numbered(df, keys=keys, order=order, ts=ts, bucket_seconds=bucket_seconds)
    own = F.floor(F.col("_i") / block)
    ahead = F.when(F.col("_i") % block >= block - n, own + 1)
    dealt = rows.withColumn("_own", own).withColumn("_block", F.explode(F.filter(F.array(own, ahead), lambda b: b.isNotNull())))
    w = Window.partitionBy(*keys, "_block").orderBy("_i").rowsBetween(-n, 0)
    return dealt.withColumns({name: c.over(w) for name, c in out.items()}).filter("_own = _block").drop("_i", "_own", "_block")


def preceding(df: DataFrame, out: dict[str, Column], *, keys: list[str], order: list[str], ts: str = "ts", block: int = 1 << 16, bucket_seconds: int = 86_400) -> DataFrame:
    """Each row with values of the row before it in its key's order, its place ``_i`` and its block ``_block``.

    Blocks share their edges: a block's last row also opens the next one.
    """
    rows = numbered(df.withColumns({f"_at_{name}": c for name, c in out.items()}), keys=keys, order=order, ts=ts, bucket_seconds=bucket_seconds).withColumn("_block", F.floor(F.col("_i") / block))
    edges = rows.filter(F.col("_i") % block == block - 1).select(*keys, (F.col("_block") + 1).alias("_block"), *(F.col(f"_at_{name}").alias(f"_edge_{name}") for name in out))
    w = Window.partitionBy(*keys, "_block").orderBy("_i")
    dealt = rows.join(edges, [*keys, "_block"], "left")
    values = {name: F.when(F.col("_i") % block == 0, F.col(f"_edge_{name}")).otherwise(F.lag(f"_at_{name}").over(w)) for name in out}
    return dealt.withColumns(values).drop(*(f"_at_{name}" for name in out), *(f"_edge_{name}" for name in out))


def over_range(df: DataFrame, seconds: int, out: dict[str, Column], *, keys: list[str], ts: str = "ts") -> DataFrame:
    """Aggregates over a row and those of its key at most so many seconds before it (a RANGE frame).

    Rows are dealt by spans of time as wide as the frame; a span also gets the rows of the one before.
    """
    second = F.unix_micros(F.col(ts).cast("timestamp"))
    own = F.floor(second / (int(seconds) * 1_000_000))
    dealt = df.withColumn("_us", second).withColumn("_own", own).withColumn("_span", F.explode(F.array(F.col("_own"), F.col("_own") + 1)))
    w = Window.partitionBy(*keys, "_span").orderBy("_us").rangeBetween(-int(seconds) * 1_000_000, 0)
    return dealt.withColumns({name: c.over(w) for name, c in out.items()}).filter("_own = _span").drop("_us", "_own", "_span")
