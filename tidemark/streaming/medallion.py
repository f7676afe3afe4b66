"""Bronze to silver to gold as streams, with the same expressions that batches use."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import normalize as N
from tidemark.operators import quality as Q
from tidemark.sources.schemas import COINBASE


def _silver(df: DataFrame, **columns: Column) -> DataFrame:
    """The common trade layout out of a venue's columns."""
    named = {"asset_class": F.lit("crypto"), "trade_conditions": F.array().cast("array<string>"), "platform_sequence": F.lit(None).cast("bigint"), "vendor_data": F.lit(None).cast("map<string,string>")} | columns
    out = df.select(*(c.alias(n) for n, c in named.items()), "ingestion_timestamp")
    identity = N.message_id(F.col("exchange"), F.col("symbol"), F.col("trade_id"), F.col("timestamp"), F.col("price"), F.col("quantity"))
    return out.withColumn("message_id", identity).withColumn("currency", N.currency(F.col("canonical_symbol"))).withColumn("quote_volume", N.quote_volume(F.col("price"), F.col("quantity")))


def binance(df: DataFrame) -> DataFrame:
    """Raw JSON text in ``value`` to silver; other events than trades are left out."""
    # Keys differ by case only, so the message is read as a map.
    d = df.withColumn("m", F.from_json(F.col("value").cast("string"), "map<string,string>"))
    at = lambda key, kind="string": F.col("m")[key].try_cast(kind)
    d = d.filter((at("e") == "trade") & (F.coalesce(at("s"), F.lit("")) != ""))
    return _silver(
        d, exchange=F.lit("binance"), symbol=at("s"), canonical_symbol=N.joined_canonical(at("s")), trade_id=F.concat(F.lit("BINANCE-"), at("t")),
        timestamp=at("T", "bigint") * 1000, price=N.decimal(at("p")), quantity=N.decimal(at("q")), side=N.maker_side(at("m", "boolean")), source_sequence=at("t", "bigint"),
        vendor_data=F.map_filter("m", lambda k, v: k.isin("m", "M", "b", "a") & v.isNotNull()),
    )


def kraken(df: DataFrame) -> DataFrame:
    """Raw messages ``[id, [[price, volume, time, side, type, misc], ...], "trade", pair]``: a row for each trade in them."""
    parts = F.from_json(F.col("value").cast("string"), "array<string>")
    d = df.withColumn("a", parts).filter((F.size("a") >= 4) & (F.get("a", F.size("a") - 2) == "trade"))
    d = d.withColumn("pair", F.get("a", F.size("a") - 1)).withColumn("t", F.explode(F.from_json(F.get("a", F.lit(1)), "array<array<string>>")))
    at = lambda i: F.get("t", F.lit(i))
    us = N.seconds_text_micros(at(2))
    return _silver(
        d, exchange=F.lit("kraken"), symbol=F.col("pair"), canonical_symbol=N.slashed_canonical(F.col("pair")), trade_id=F.concat(F.lit("KRAKEN-"), us.cast("string"), F.lit("-"), F.substring(F.sha2(F.concat_ws("|", "pair", at(0), at(1), at(2)), 256), 1, 8)),
        timestamp=us, price=N.decimal(at(0)), quantity=N.decimal(at(1)), side=N.side(at(3)), source_sequence=F.lit(None).cast("bigint"), trade_conditions=N.order_type(at(4)),
    )


def coinbase(df: DataFrame) -> DataFrame:
    m = F.from_json(F.col("value").cast("string"), COINBASE)
    d = df.withColumn("m", m).filter((F.coalesce(F.col("m.product_id"), F.lit("")) != "") & (F.coalesce(F.col("m.trade_id"), F.lit("")) != ""))
    return _silver(
        d, exchange=F.lit("coinbase"), symbol=N.compact(N.dashed_canonical(F.col("m.product_id"))), canonical_symbol=N.dashed_canonical(F.col("m.product_id")), trade_id=F.concat(F.lit("COINBASE-"), F.col("m.trade_id")),
        timestamp=N.iso_micros(F.col("m.time")), price=N.decimal(F.col("m.price")), quantity=N.decimal(F.col("m.size")), side=N.side(F.col("m.side")), source_sequence=F.col("m.sequence_num"),
    )


VENUES: dict[str, Callable[[DataFrame], DataFrame]] = {"binance": binance, "kraken": kraken, "coinbase": coinbase}


def two_ways(stream: DataFrame, as_of_us: Column, valid_path: str, dead_path: str, checkpoint: str, *, trigger: dict | None = None) -> StreamingQuery:
    """Valid rows to one folder, dead letters to another, by one query that reads its source once.

    A batch's files carry its number, and a batch that runs again overwrites them: each row arrives once.
    """

    def put(batch: DataFrame, number: int) -> None:
        held = Q.validated(batch, as_of_us).persist()
        try:
            held.filter("is_valid").select(*batch.columns).write.mode("overwrite").parquet(f"{valid_path}/batch={number}")
            dead = held.filter(~F.col("is_valid")).select(F.to_json(F.struct(*batch.columns)).alias("raw_record"), "error_reason", "error_type")
            dead.write.mode("overwrite").parquet(f"{dead_path}/batch={number}")
        finally:
            held.unpersist()

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def gold(*streams: DataFrame, ts: str = "ts", key: str = "message_id", lateness: str = "5 minutes") -> DataFrame:
    """Venue streams in one, each message once within the watermark, with the date and hour it falls in."""
    out = streams[0]
    for s in streams[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    out = out.withWatermark(ts, lateness).dropDuplicatesWithinWatermark([key])
    return out.withColumn("exchange_date", F.to_date(ts)).withColumn("exchange_hour", F.hour(ts))


def candle_stream(trades: DataFrame, width: str, *, ts: str = "ts", seq: str = "seq", lateness: str = "5 minutes") -> DataFrame:
    """Bars that are put out once their window is closed."""
    from tidemark.operators.candles import candles

    return candles(trades.withWatermark(ts, lateness), width, ts=ts, seq=seq)


def candle_table(trades: DataFrame, width: str, path: str, checkpoint: str, *, ts: str = "ts", seq: str = "seq", lateness: str = "5 minutes", trigger: dict | None = None) -> StreamingQuery:
    """Bars as a table that each micro-batch brings up to date, open windows too: a batch writes the bars that it has changed, under its number."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    stream = candle_stream(trades, width, ts=ts, seq=seq, lateness=lateness)
    return stream.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def current(changes: DataFrame, keys: tuple[str, ...] = ("exchange", "symbol", "window_start"), version: str = "batch") -> DataFrame:
    """The last state of each key out of what batches have changed."""
    from tidemark.operators.queries import latest_version

    return latest_version(changes, list(keys), [version]).drop(version)


def tail(trades: DataFrame, as_of: Column, *, ts: str = "ts", minutes: int = 5) -> DataFrame:
    """The recent part of a table: what the hybrid query reads beyond the lake."""
    return trades.filter((F.col(ts) > as_of - F.expr(f"INTERVAL {int(minutes)} MINUTES")) & (F.col(ts) <= as_of))


def joined(trades: DataFrame, quotes: DataFrame, *, keys: list[str], seconds: int, ts: str = "ts", quote_ts: str = "quote_ts") -> DataFrame:
    """Stream-stream: trades with the quotes of at most so many seconds before; state is bounded by the watermarks."""
    t, q = trades.withWatermark(ts, "1 minute").alias("t"), quotes.withWatermark(quote_ts, "1 minute").alias("q")
    same = [F.col(f"t.{k}") == F.col(f"q.{k}") for k in keys]
    within = (F.col(f"q.{quote_ts}") <= F.col(f"t.{ts}")) & (F.col(f"q.{quote_ts}") >= F.col(f"t.{ts}") - F.expr(f"INTERVAL {int(seconds)} SECONDS"))
    condition = within
    for s in same:
        condition = condition & s
    return t.join(q, condition).select("t.*", *(F.col(f"q.{c}") for c in quotes.columns if c not in keys and c not in trades.columns))
