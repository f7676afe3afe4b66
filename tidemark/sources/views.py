"""The domain's tables as views over the supplied test tables, in Spark and as SQL text for a check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").try_cast("decimal(18,8)")
    exchange = F.when(F.col("user_id") % 3 == 0, "BINANCE").when(F.col("user_id") % 3 == 1, "KRAKEN").otherwise("COINBASE")
    return e.select(
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("symbol"),
        exchange.alias("exchange"),
        F.col("value").cast("decimal(18,8)").alias("price"),
        k.alias("quantity"),
        "ts",
        F.when(k % 2 == 1, "SELL").otherwise("BUY").alias("side"),
        F.concat_ws("-", exchange, F.col("event_id").cast("string")).alias("trade_id"),
        F.col("user_id"),
    )


TRADES = """trades AS (SELECT event_id AS seq, event_type AS symbol,
  CASE WHEN user_id % 3 = 0 THEN 'BINANCE' WHEN user_id % 3 = 1 THEN 'KRAKEN' ELSE 'COINBASE' END AS exchange,
  CAST(value AS DECIMAL(18,8)) AS price, TRY_CAST(json_extract_string(props, '$.k') AS DECIMAL(18,8)) AS quantity, ts,
  CASE WHEN TRY_CAST(json_extract_string(props, '$.k') AS DECIMAL(18,8)) % 2 = 1 THEN 'SELL' ELSE 'BUY' END AS side,
  (CASE WHEN user_id % 3 = 0 THEN 'BINANCE' WHEN user_id % 3 = 1 THEN 'KRAKEN' ELSE 'COINBASE' END) || '-' || event_id AS trade_id,
  user_id FROM events)"""


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    cent = F.lit("0.01").cast("decimal(18,8)")
    return trades(spark, sf_dir).select("seq", "symbol", "exchange", "ts", (F.col("price") - cent).cast("decimal(18,8)").alias("bid_price"), (F.col("price") + cent).cast("decimal(18,8)").alias("ask_price"), (F.col("quantity") + 1).cast("decimal(18,8)").alias("bid_quantity"), (F.col("quantity") + 1).cast("decimal(18,8)").alias("ask_quantity"))


QUOTES = """quotes AS (SELECT seq, symbol, exchange, ts, CAST(price - 0.01 AS DECIMAL(18,8)) AS bid_price, CAST(price + 0.01 AS DECIMAL(18,8)) AS ask_price,
  CAST(quantity + 1 AS DECIMAL(18,8)) AS bid_quantity, CAST(quantity + 1 AS DECIMAL(18,8)) AS ask_quantity FROM trades)"""


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as dated trades: many ties in time, ordered further by order and line."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_partkey").cast("string").alias("symbol"), F.lit("LOT").alias("exchange"), F.col("l_shipdate").alias("ts"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"), (F.col("l_extendedprice") / F.col("l_quantity")).cast("decimal(18,8)").alias("price"), F.col("l_quantity").cast("decimal(18,8)").alias("quantity"))


DAILY = """daily AS (SELECT CAST(l_partkey AS VARCHAR) AS symbol, 'LOT' AS exchange, l_shipdate AS ts, l_orderkey * 8 + l_linenumber AS seq,
  CAST(l_extendedprice / l_quantity AS DECIMAL(18,8)) AS price, CAST(l_quantity AS DECIMAL(18,8)) AS quantity FROM lineitem)"""
