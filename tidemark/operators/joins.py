"""Joins the domain needs: exact, as-of, interval and spread."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact(trades: DataFrame, quotes: DataFrame, keys: list[str]) -> DataFrame:
    """Each trade with the quote of the same keys, if there is one."""
    return trades.join(quotes, keys, "left")


def as_of(left: DataFrame, right: DataFrame, *, keys: list[str], ts: str = "ts", seq: str = "seq", columns: list[str], bucket_seconds: int = 86_400) -> DataFrame:
    """Each left row with the named columns of the last right row of its key at or before its time.

    Time is cut into buckets, so a key with most rows is dealt over many tasks.  A bucket starts with the last right row of the buckets before,
    found among pre-aggregated rows of one a bucket; within it both sides are stacked and one window carries the last right
    row forward.  No pairs are made.  A right row of the same time comes before; the sequence orders right rows of one time.
    """
    bucket = F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / int(bucket_seconds)).alias("_bucket")
    value = F.struct(F.struct(*columns).alias("c")).alias("_c")  # a struct around, so null columns are values too
    r = right.select(*keys, bucket, F.col(ts).alias("_t"), F.lit(1).alias("_side"), F.col(seq).alias("_s"), value)
    l = left.select(F.struct("*").alias("_row"), *keys, bucket, F.col(ts).alias("_t"), F.lit(2).alias("_side"), F.col(seq).alias("_s"))
    last = r.groupBy(*keys, "_bucket").agg(F.max_by("_c", F.struct("_t", "_s")).alias("_c"))
    wanted = last.unionByName(l.select(*keys, "_bucket").distinct(), allowMissingColumns=True).groupBy(*keys, "_bucket").agg(F.max("_c").alias("_c"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    opening = wanted.select(*keys, "_bucket", F.lit(0).alias("_side"), F.last("_c", ignorenulls=True).over(earlier).alias("_c")).filter("_c is not null")
    stacked = l.unionByName(r, allowMissingColumns=True).unionByName(opening, allowMissingColumns=True)
    w = Window.partitionBy(*keys, "_bucket").orderBy(F.col("_t").asc_nulls_first(), "_side", "_s").rowsBetween(Window.unboundedPreceding, 0)
    carried = stacked.withColumn("_c", F.last("_c", ignorenulls=True).over(w)).filter("_side = 2")
    return carried.select("_row.*", *(F.col(f"_c.c.{c}").alias(c) for c in columns))


def interval(left: DataFrame, right: DataFrame, *, keys: list[str], seconds: int, ts: str = "ts", columns: list[str]) -> DataFrame:
    """Pairs of left rows and right rows of the key at most so many seconds earlier: equal buckets of that width, then the condition."""
    width = int(seconds)
    second = lambda c: F.unix_seconds(F.col(c).cast("timestamp"))
    l = left.withColumn("_b", F.explode(F.array(F.floor(second(ts) / width), F.floor(second(ts) / width) - 1)))
    r = right.select(*keys, F.col(ts).alias("_rts"), *columns).withColumn("_b", F.floor(second("_rts") / width))
    within = (F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.col("_rts").cast("timestamp"))).between(0, width * 1_000_000)
    return l.join(r, [*keys, "_b"]).filter(within).drop("_b")


def ranged(left: DataFrame, right: DataFrame, *, keys: list[str], value: str, low: str, high: str, width: float, columns: list[str]) -> DataFrame:
    """Pairs of left rows and right rows of the key whose interval [low, high] holds the left value.

    The number line is cut into cells of ``width``; an interval stands in each cell it touches, a value in one.  So pairs meet by equality, and once.
    """
    cell = lambda c: F.floor(F.col(c) / F.lit(width)).cast("long")
    r = right.select(*keys, F.col(low).alias("_low"), F.col(high).alias("_high"), *columns).filter("_low <= _high")
    r = r.withColumn("_cell", F.explode(F.sequence(cell("_low"), cell("_high"))))
    return left.withColumn("_cell", cell(value)).join(r, [*keys, "_cell"]).filter(F.col(value).between(F.col("_low"), F.col("_high"))).drop("_cell", "_low", "_high")


def spreads(trades: DataFrame, width: str, venues: list[str], ts: str = "ts") -> DataFrame:
    """Mean price by symbol and bucket for each venue, and the absolute difference of each pair; null where one is silent."""
    means = trades.groupBy("symbol", F.window(ts, width)["start"].alias("bucket")).pivot("exchange", venues).agg(F.avg("price").cast("double"))
    pairs = [(a, b) for i, a in enumerate(venues) for b in venues[i + 1 :]]
    return means.select("symbol", "bucket", *(F.round(F.abs(F.col(a) - F.col(b)), 6).alias(f"{a.lower()}_{b.lower()}") for a, b in pairs))
