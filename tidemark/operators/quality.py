"""Validation, dead letters, sequence events, gaps, jumps and reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import windows as X

YEAR_US = 365 * 86_400_000_000
# The twelve codes of the published validation rules, in order of precedence (the general ones last), and the types of errors by the column that a code names.
CODES = ("price_is_null", "price_must_be_positive", "quantity_is_null", "quantity_must_be_positive", "symbol_required", "invalid_side", "timestamp_in_future", "timestamp_too_old", "message_id_required", "invalid_asset_class", "deserialization_failed_or_null_fields", "unknown_validation_error")
KINDS = ("price", "quantity", "timestamp", "symbol", "side", "message_id", "asset_class")


def rules(as_of_us: Column) -> dict[str, Column]:
    """What each code finds wrong with a row.  A rule that can't be told holds no error of its own; the general code stands for the nulls that no other code names."""
    ts = F.col("timestamp")
    wrong = {
        "price_is_null": F.col("price").isNull(),
        "price_must_be_positive": F.col("price") <= 0,
        "quantity_is_null": F.col("quantity").isNull(),
        "quantity_must_be_positive": F.col("quantity") <= 0,
        "symbol_required": F.col("symbol").isNull(),
        "invalid_side": ~F.col("side").isin("BUY", "SELL"),
        "timestamp_in_future": ts >= as_of_us,
        "timestamp_too_old": ts <= as_of_us - YEAR_US,
        "message_id_required": F.col("message_id").isNull(),
        "invalid_asset_class": F.col("asset_class") != "crypto",
        "deserialization_failed_or_null_fields": F.col("side").isNull() | ts.isNull() | F.col("asset_class").isNull(),
    }
    return {code: wrong[code] for code in CODES if code in wrong}


def kind(reason: Column) -> Column:
    """The type of an error, by the first column that its code names."""
    out = F.when(reason.isNull(), F.lit(None).cast("string"))
    for name in KINDS:
        out = out.when(reason.contains(name), F.lit(f"{name}_validation"))
    return out.otherwise("unknown_error")


def validated(df: DataFrame, as_of_us: Column) -> DataFrame:
    """With ``errors`` (codes in order), ``is_valid``, ``error_reason`` (the first) and ``error_type``."""
    codes = F.array(*(F.when(wrong, F.lit(code)) for code, wrong in rules(as_of_us).items()))
    found = df.withColumn("errors", F.filter(codes, lambda c: c.isNotNull()))
    reason = F.get("errors", F.lit(0))
    return found.withColumns({"is_valid": F.size("errors") == 0, "error_reason": reason}).withColumn("error_type", kind(F.col("error_reason")))


def flagged(df: DataFrame, *, older: bool = False) -> DataFrame:
    """The stored layout's own flag and codes: price, quantity (``invalid_volume`` in the older layout) and quote volume must be positive."""
    own = {"invalid_price": F.col("price"), ("invalid_volume" if older else "invalid_quantity"): F.col("quantity")} | ({} if older else {"invalid_quote_volume": F.col("quote_volume")})
    codes = F.filter(F.array(*(F.when(~F.coalesce(c > 0, F.lit(False)), F.lit(code)) for code, c in own.items())), lambda c: c.isNotNull())
    return df.withColumn("validation_errors", codes).withColumn("is_valid", F.size("validation_errors") == 0)


def split(df: DataFrame, as_of_us: Column) -> tuple[DataFrame, DataFrame]:
    """(valid rows, dead letters): every row is in one of them."""
    checked = validated(df, as_of_us)
    return checked.filter("is_valid").select(*df.columns), checked.filter(~F.col("is_valid")).drop("is_valid")


def metrics(df: DataFrame, as_of_us: Column) -> DataFrame:
    return validated(df, as_of_us).groupBy(F.coalesce("error_type", F.lit("valid")).alias("error_type"), F.coalesce("error_reason", F.lit("none")).alias("error_reason")).agg(F.count("*").alias("n"))


def null_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: the number of rows and of nulls in each column."""
    return df.agg(F.count("*").alias("total"), *(F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns))


def sequence_events(df: DataFrame, *, seq: str, order: list, keys: tuple[str, ...] = ("exchange", "symbol"), large: int = 10, ts: str = "ts", block: int = 1 << 16) -> DataFrame:
    """Each message against the highest sequence before it: FIRST, OK, SMALL_GAP, LARGE_GAP, RESET or OUT_OF_ORDER.

    A reset (below half of the last) starts the count anew, which makes later rows depend on it: the rows after the
    last reset form a section with a running maximum of its own.  A key's rows are dealt by blocks of their place; what a block
    takes from those before it (the sections and the maximum of the last one) comes from one row for each block and section.
    """
    rows = X.preceding(df, {"_last": F.col(seq)}, keys=list(keys), order=order, ts=ts, block=block)
    rows = rows.withColumn("_reset", F.coalesce(F.col(seq) < F.col("_last") * 0.5, F.lit(False)).cast("int"))
    own = Window.partitionBy(*keys, "_block").orderBy("_i")
    marked = rows.withColumn("_part", F.sum("_reset").over(own.rowsBetween(Window.unboundedPreceding, 0)))  # sections within the block, 0 goes on from the one before
    tops = marked.groupBy(*keys, "_block", "_part").agg(F.max(seq).alias("_top"))
    blocks = tops.groupBy(*keys, "_block").agg(F.max("_part").alias("_resets"))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    begun = blocks.withColumn("_before", F.coalesce(F.sum("_resets").over(earlier), F.lit(0))).drop("_resets")
    sections = tops.join(begun, [*keys, "_block"]).withColumn("_section", F.col("_before") + F.col("_part"))
    within = Window.partitionBy(*keys, "_section").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = sections.withColumn("_from", F.max("_top").over(within)).select(*keys, "_block", "_part", "_from")
    high = F.max(seq).over(Window.partitionBy(*keys, "_block", "_part").orderBy("_i").rowsBetween(Window.unboundedPreceding, -1))
    joined = marked.withColumn("_high", high).join(carried, [*keys, "_block", "_part"]).withColumn("_high", F.greatest("_high", "_from"))
    gap = F.col(seq) - F.col("_high") - 1
    event = F.when(F.col("_reset") == 1, "RESET").when(F.col("_high").isNull(), "FIRST").when(F.col(seq) <= F.col("_high"), "OUT_OF_ORDER").when(gap == 0, "OK").when(gap <= large, "SMALL_GAP").otherwise("LARGE_GAP")
    return joined.withColumn("event", event).withColumn("gap", F.when(F.col("event").isin("SMALL_GAP", "LARGE_GAP"), gap).otherwise(F.lit(0))).select(*df.columns, "event", "gap")


def gaps(df: DataFrame, seq: str, keys: tuple[str, ...] = (), *, width: int = 1 << 16) -> DataFrame:
    """Ranges of missing numbers between consecutive ones.

    Numbers are dealt by ranges of ``width``; the first number after a range comes from one row for each range.
    """
    rows = df.select(*keys, seq).distinct().withColumn("_block", F.floor(F.col(seq) / width))
    first = rows.groupBy(*keys, "_block").agg(F.min(seq).alias("_first"))
    later = first.withColumn("_then", F.lead("_first").over(Window.partitionBy(*keys).orderBy("_block"))).drop("_first")
    nxt = F.coalesce(F.lead(seq).over(Window.partitionBy(*keys, "_block").orderBy(seq)), F.col("_then"))
    return rows.join(later, [*keys, "_block"]).withColumn("_n", nxt).filter(F.col("_n") - F.col(seq) > 1).select(*keys, (F.col(seq) + 1).alias("gap_start"), (F.col("_n") - 1).alias("gap_end"), (F.col("_n") - F.col(seq) - 1).alias("missing"))


def jumps(df: DataFrame, share: float, *, keys: tuple[str, ...] = ("symbol",), ts: str = "ts", seq: str = "seq", block: int = 1 << 16) -> DataFrame:
    """Trades whose price differs from the one before by more than a share of it."""
    rows = X.preceding(df, {"_before": F.col("price").cast("double")}, keys=list(keys), order=[ts, seq], ts=ts, block=block)
    change = F.abs(F.col("price").cast("double") - F.col("_before")) / F.nullif(F.col("_before"), F.lit(0.0))
    return rows.withColumn("jump", change).filter(F.col("jump") > share).select(*df.columns, "jump")


def audit(source: DataFrame, target: DataFrame, keys: list[str], *, warn: float = 1.0, missing: float = 5.0) -> DataFrame:
    """Counts of both sides by key, their difference, and ok, warning, missing_data or excess_data."""
    s = source.groupBy(*keys).agg(F.count("*").alias("source_rows"))
    t = target.groupBy(*keys).agg(F.count("*").alias("target_rows"))
    both = s.join(t, keys, "full").na.fill(0, ["source_rows", "target_rows"])
    delta = F.col("target_rows") - F.col("source_rows")
    pct = F.when(F.col("source_rows") == 0, 0.0).otherwise(F.abs(delta) * 100.0 / F.greatest("source_rows", F.lit(1)))
    status = F.when((F.col("source_rows") == 0) | (F.col("delta_pct") <= warn), "ok").when((F.col("delta") < 0) & (F.col("delta_pct") > missing), "missing_data").when((F.col("delta") > 0) & (F.col("delta_pct") > missing), "excess_data").otherwise("warning")
    return both.withColumn("delta", delta).withColumn("delta_pct", pct).withColumn("status", status)


# The minutes after which the newest candle of a width is stale.
STALE_AFTER = {"1m": 10, "5m": 20, "30m": 60, "1h": 120, "1d": 1500}


def freshness(bars: DataFrame, as_of: Column, limits: dict[str, int] = STALE_AFTER, frame_col: str = "timeframe") -> DataFrame:
    """Age of the newest bar of each timeframe against its limit in minutes."""
    age = F.unix_seconds(as_of.cast("timestamp")) - F.unix_seconds(F.col("latest").cast("timestamp"))
    wanted = F.explode(F.create_map(*(F.lit(x) for pair in limits.items() for x in pair))).alias(frame_col, "limit_minutes")
    spark = bars.sparkSession
    frames = spark.range(1).select(wanted)
    latest = bars.groupBy(frame_col).agg(F.max("window_start").alias("latest"))
    out = frames.join(latest, frame_col, "left").withColumn("age_seconds", age)
    return out.withColumn("status", F.when(F.col("latest").isNull(), "no_data").when(F.col("age_seconds") > F.col("limit_minutes") * 60, "stale").otherwise("healthy"))


def overall(statuses: dict[str, str]) -> str:
    """One status out of those of all timeframes: the worst of error, no_data, stale and healthy."""
    return next((s for s in ("error", "no_data", "stale") if s in statuses.values()), "healthy")
