"""Registered queries that write and read again: streams, snapshots, compaction, incremental loads."""

from __future__ import annotations

import json
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import avro, records
from tidemark.operators import candles as C
from tidemark.plans.offload import offload
from tidemark.sources import views as V
from tidemark.sources.readers import avro_bronze, csv_by_date, file_stream, write
from tidemark.sources.scratch import scratch
from tidemark.sources.schemas import TableSpec, struct
from tidemark.sources.store import Store
from tidemark.streaming import medallion as M
from tidemark.streaming.sequence import sequence_stream
from tidemark.streaming.tail import Tail

TICKS = TableSpec("ticks", struct("seq bigint, symbol string, exchange string, price decimal(18,8), quantity decimal(18,8), ts timestamp_ntz, trade_id string, day date"), ("day",), ("ts", "seq"), 365, ("trade_id",))


def _ticks(spark: SparkSession, d: str) -> DataFrame:
    t = V.trades(spark, d)
    return t.select("seq", "symbol", "exchange", "price", "quantity", "ts", "trade_id", F.to_date("ts").alias("day"))


def _stream(spark: SparkSession, d: str) -> tuple[DataFrame, str]:
    """The trades as a stream of files, times as streams need them."""
    root = scratch(spark)
    t = V.trades(spark, d).withColumn("ts", F.col("ts").cast("timestamp")).withColumn("message_id", F.col("trade_id"))
    t.repartitionByRange(4, "ts").sortWithinPartitions("ts").write.parquet(f"{root}/in")
    return file_stream(spark, f"{root}/in", t.schema), root


def _drained(stream: DataFrame, root: str) -> DataFrame:
    q = stream.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/check").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{root}/out")


def stream_candles(spark: SparkSession, d: str) -> DataFrame:
    """Hourly bars as each micro-batch leaves them, open windows too."""
    from tidemark.plans.catalog import _BAR_COLUMNS, _rounded

    s, root = _stream(spark, d)
    M.candle_table(s.filter("quantity > 0"), "1h", f"{root}/bars", f"{root}/check").awaitTermination()
    bars = M.current(spark.read.parquet(f"{root}/bars")).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    return _rounded(bars.select("exchange", "symbol", "window_start", *_BAR_COLUMNS))


def stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    s, root = _stream(spark, d)
    twice = s.select("message_id", "exchange", "symbol", "ts")
    other = _stream(spark, d)[0].select("message_id", "exchange", "symbol", "ts")
    out = _drained(M.gold(twice, other, lateness="1 day"), root)
    return out.withColumns({"ts": F.col("ts").cast("timestamp_ntz"), "exchange_date": F.col("exchange_date").cast("string")})


def stream_sequence(spark: SparkSession, d: str) -> DataFrame:
    s, root = _stream(spark, d)
    return _drained(sequence_stream(s), root).groupBy("exchange", "symbol", "event").agg(F.count("*").alias("n"), F.sum("gap").alias("missing"))


def stream_dead_letters(spark: SparkSession, d: str) -> DataFrame:
    s, root = _stream(spark, d)
    raw = s.select("message_id", "symbol", "price", "quantity", "side", F.unix_micros("ts").alias("timestamp"), F.lit("crypto").alias("asset_class"))
    M.two_ways(raw, F.unix_micros(F.lit("2024-02-01 00:00:00").cast("timestamp")), f"{root}/valid", f"{root}/dead", f"{root}/check").awaitTermination()
    return spark.read.schema("raw_record string, error_reason string, error_type string, batch long").parquet(f"{root}/dead").groupBy("error_type", "error_reason").agg(F.count("*").alias("n"))


def snapshot_time_travel(spark: SparkSession, d: str) -> DataFrame:
    t, store = _ticks(spark, d), Store(spark, scratch(spark), TICKS)
    first = store.append(t.filter("seq % 2 = 0"), "even")
    store.append(t.filter("seq % 2 = 1"), "odd")
    store.append(t.filter("seq % 2 = 1"), "odd")  # once more: adds nothing
    counts = [store.read(number).select(F.lit(which).alias("which")) for which, number in (("then", first.id), ("now", None))]
    both = counts[0].unionByName(counts[1])
    return both.agg(F.count_if(F.col("which") == "then").alias("then"), F.count_if(F.col("which") == "now").alias("now"))


def compaction(spark: SparkSession, d: str) -> DataFrame:
    t, store = _ticks(spark, d), Store(spark, scratch(spark), TICKS)
    for i in range(3):
        store.append(t.filter(f"seq % 3 = {i}"))
    before = len(store.snapshot().files)
    store.compact()
    return store.read().agg(F.lit(len(store.snapshot().files) < before).alias("fewer_files"), F.count("*").alias("n"), F.sum("seq").alias("total"))


def incremental_offload(spark: SparkSession, d: str) -> DataFrame:
    t, store = _ticks(spark, d), Store(spark, scratch(spark), TICKS)
    for until in ("2024-01-15 00:00:00", "2024-02-15 00:00:00", "2024-02-15 00:00:00"):
        offload(t, store, "ticks", ts="ts", seq="seq", now=F.lit(until).cast("timestamp_ntz"))
    return store.read().groupBy("exchange", "symbol").agg(F.count("*").alias("n"), F.max("seq").alias("last"))


LOTS = TableSpec("lots", struct("symbol string, exchange string, ts timestamp_ntz, seq bigint, price decimal(18,8), quantity decimal(18,8), month string"), ("month",), ("ts", "seq"), None, ("symbol", "ts", "seq"))


def full_load(spark: SparkSession, d: str) -> DataFrame:
    """All line items into a fresh table by month, in time order within files, and what it holds."""
    lots = V.daily(spark, d).withColumn("month", F.date_format("ts", "yyyy-MM"))
    store = Store(spark, scratch(spark), LOTS)
    store.append(lots, "all")
    return store.read().groupBy("month").agg(F.count("*").alias("n"))


def candle_upsert_store(spark: SparkSession, d: str) -> DataFrame:
    t = V.trades(spark, d).filter("quantity > 0")
    bars = C.candles(t, "1d").drop("vwap").withColumn("window_date", F.to_date("window_start"))
    store = Store(spark, scratch(spark), TableSpec("bars", bars.schema, ("window_date",), ("exchange", "symbol"), None, ("exchange", "symbol", "window_start")))
    store.upsert(bars.filter("window_date < date'2024-01-20'"))
    store.upsert(bars.filter("window_date >= date'2024-01-10'"))
    return store.read().groupBy("exchange").agg(F.count("*").alias("bars"), F.sum("trade_count").alias("trades"))


def partition_overwrite(spark: SparkSession, d: str) -> DataFrame:
    """Two days are put in place anew, with a third of their rows; the other days stay."""
    t, store = _ticks(spark, d), Store(spark, scratch(spark), TICKS)
    store.append(t)
    store.overwrite_partitions(t.filter("day in ('2024-01-05', '2024-01-06') and seq % 3 = 0"))
    return store.read().groupBy(F.col("day").cast("string").alias("day")).agg(F.count("*").alias("n"))


def retention_delete(spark: SparkSession, d: str) -> DataFrame:
    t, store = _ticks(spark, d), Store(spark, scratch(spark), TICKS)
    store.append(t)
    store.delete_partitions("2024-01-15")
    return store.read().groupBy(F.col("day").cast("string").alias("day")).agg(F.count("*").alias("n"))


def snapshot_expiry(spark: SparkSession, d: str) -> DataFrame:
    """Old snapshots and the files only they hold go; the last one reads as before."""
    t, store = _ticks(spark, d), Store(spark, scratch(spark), TICKS)
    for i in range(3):
        store.append(t.filter(f"seq % 3 = {i}"))
    store.compact()
    store.expire(time.time() + 1, keep=1)
    return store.read().agg(F.lit(len(store.ids())).cast("long").alias("snapshots"), F.lit(len(store.orphans(time.time() + 10))).cast("long").alias("orphans"), F.count("*").alias("n"))


def stream_to_store(spark: SparkSession, d: str) -> DataFrame:
    """A stream's batches as appends, run twice; and the store's appends read as batches."""
    root = scratch(spark)
    t = _ticks(spark, d)
    t.repartitionByRange(3, "ts").write.parquet(f"{root}/in")
    store = Store(spark, f"{root}/table", TICKS)
    for _ in range(2):
        store.sink(file_stream(spark, f"{root}/in", t.schema, most_files=1), f"{root}/check").awaitTermination()
    out = None
    for _, rows in store.stream():
        out = rows if out is None else out.unionByName(rows)
    return out.groupBy("exchange").agg(F.count("*").alias("n"))


def dead_letter_files(spark: SparkSession, d: str) -> DataFrame:
    """Invalid rows as rolled JSON lines, read back."""
    from tidemark.operators import quality as Q
    from tidemark.plans import catalog
    from tidemark.streaming.letters import Letters

    dead = Q.split(catalog._raw(spark, d), catalog._as_of())[1]
    box = Letters(spark, scratch(spark), roll_bytes=1 << 20)
    box.put(dead.select(F.to_json(F.struct("message_id", "symbol", "side")).alias("raw_record"), "error_reason", "error_type"), "0")
    record = F.from_json("raw_record", "message_id string")
    return box.read().select(record["message_id"].alias("message_id"), "error_reason", "error_type")


def recent_tail(spark: SparkSession, d: str) -> DataFrame:
    """The last hours of the trades, at most fifty of a symbol, after three batches."""
    tail = Tail(spark, scratch(spark), minutes=720, most=50)
    t = V.trades(spark, d).select("symbol", "ts", "seq")
    for i in range(3):
        tail.add(t.filter(f"seq % 3 = {i}"), i)
    return tail.read(t.schema)


def csv_days(spark: SparkSession, d: str) -> DataFrame:
    """Orders as CSV, of which two days are read back."""
    root = scratch(spark)
    o = V.table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "MM/dd/yyyy").alias("day"))
    write(o, f"{root}/orders", "csv")
    return csv_by_date(spark, f"{root}/orders", o.schema, "day", ["1995-01-01", "1995-01-02"]).select("o_orderkey")


_FIELDS = [{"name": "seq", "type": "long"}, {"name": "symbol", "type": ["null", "string"]}, {"name": "price", "type": {"type": "bytes", "logicalType": "decimal", "precision": 18, "scale": 8}}, {"name": "sell", "type": "boolean"}]


def avro_registry(spark: SparkSession, d: str) -> DataFrame:
    """Trades as Avro behind a registry's header, by two versions of a schema, decoded by the number in each message; a few messages are bad."""
    registry = avro.SchemaFiles(spark, scratch(spark))
    both = [json.dumps({"type": "record", "name": "trade", "fields": _FIELDS[:n]}) for n in (3, 4)]
    first, second = (registry.register("trades", text) for text in both)
    t = V.trades(spark, d).select("seq", F.when(F.col("seq") % 7 != 0, F.col("symbol")).alias("symbol"), "price", (F.col("side") == "SELL").alias("sell"))
    made = avro.encoded(t.filter("seq % 2 = 0"), both[0], first, key="seq").unionByName(avro.encoded(t.filter("seq % 2 = 1"), both[1], second, key="seq"))
    bad = F.when(F.col("key").cast("long") % 50 == 0, F.substring("value", 1, 9)).when(F.col("key").cast("long") % 53 == 0, F.lit(b"\0\0\0\0\x63xx")).otherwise(F.col("value"))
    got = avro_bronze(made.withColumn("value", bad), registry.schemas("trades"))
    return got.select(F.col("key").cast("long").alias("seq"), "schema_id", F.col("record.symbol").alias("symbol"), F.round(F.col("record.price").cast("double"), 6).alias("price"), F.col("record.sell").alias("sell"))


def _message(spark: SparkSession, d: str, text: Column) -> DataFrame:
    return V.trades(spark, d).select(text.alias("value"), F.lit(None).cast("timestamp").alias("ingestion_timestamp"))


def _silver(df: DataFrame) -> DataFrame:
    return df.select("exchange", "symbol", "canonical_symbol", "currency", "trade_id", "timestamp", F.round(F.col("price").cast("double"), 6).alias("price"), F.round(F.col("quantity").cast("double"), 6).alias("quantity"), "side", "source_sequence")


def silver_binance(spark: SparkSession, d: str) -> DataFrame:
    """Trades as Binance's messages, some of another event or without a symbol, to silver."""
    price, ms = F.col("price").cast("string"), F.expr("unix_micros(cast(ts as timestamp)) div 1000")
    text = F.concat(F.lit('{"e":"'), F.when(F.col("seq") % 11 == 0, "aggTrade").otherwise("trade"), F.lit('","s":"'), F.when(F.col("seq") % 13 == 0, "").otherwise("ETHUSDT"), F.lit('","t":'), F.col("seq"), F.lit(',"p":"'), price, F.lit('","q":"1.5","T":'), ms, F.lit(',"m":'), (F.col("seq") % 2 == 0).cast("string"), F.lit(',"M":true}'))
    return _silver(M.binance(_message(spark, d, text)))


def silver_kraken(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of trades in one Kraken message each, and messages of other kinds, to silver."""
    seconds = (F.expr("unix_micros(cast(ts as timestamp))").cast("decimal(20,0)") / 1_000_000).cast("decimal(20,6)").cast("string")
    one = lambda side, kind: F.concat(F.lit('["'), F.col("price").cast("string"), F.lit('","0.25","'), seconds, F.lit(f'","{side}","{kind}",""]'))
    text = F.concat(F.lit("[7,["), one("b", "l"), F.lit(","), one("s", "m"), F.lit('],"'), F.when(F.col("seq") % 11 == 0, "spread").otherwise("trade"), F.lit('","XBT/USD"]'))
    return _silver(M.kraken(_message(spark, d, text))).drop("trade_id")


def silver_coinbase(spark: SparkSession, d: str) -> DataFrame:
    time_text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("789Z"))
    text = F.concat(F.lit('{"trade_id":"'), F.col("seq"), F.lit('","product_id":"BTC-EUR","price":"'), F.col("price").cast("string"), F.lit('","size":"2","time":"'), time_text, F.lit('","side":"'), F.when(F.col("seq") % 2 == 0, "BUY").otherwise("SELL"), F.lit('","sequence_num":'), F.col("seq"), F.lit("}"))
    return _silver(M.coinbase(_message(spark, d, text)))


def older_trades(spark: SparkSession, d: str) -> DataFrame:
    """Trades in the older layout, brought to the present one."""
    t = V.trades(spark, d)
    older = t.select(F.col("symbol"), F.when(F.col("seq") % 2 == 0, "BINANCE").otherwise("ASX").alias("exchange"), F.expr("unix_micros(cast(ts as timestamp)) div 1000").alias("exchange_timestamp"), F.col("price").cast("string").alias("price"), F.lit("3").alias("volume"), F.col("user_id").alias("company_id"), F.lit(0).alias("qualifiers"), F.lit("v").alias("venue"), F.lit(None).cast("string").alias("buyer_id"), F.col("seq").alias("sequence_number"), F.lit(1_700_000_000_000).alias("ingestion_timestamp"))
    got = records.from_older(older)
    return got.select("trade_id", "symbol", "exchange", "asset_class", "timestamp", F.round(F.col("price").cast("double"), 6).alias("price"), "currency", "side", "source_sequence", F.col("vendor_data")["company_id"].alias("company"))


QUERIES = {
    f.__name__: f
    for f in (
        stream_candles, stream_dedup, stream_sequence, stream_dead_letters, snapshot_time_travel, compaction, incremental_offload, full_load, candle_upsert_store, partition_overwrite, retention_delete,
        snapshot_expiry, stream_to_store, dead_letter_files, recent_tail, csv_days, avro_registry, silver_binance, silver_kraken, silver_coinbase, older_trades,
    )
}
