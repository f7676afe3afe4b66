"""Records to canonical rows: conversion with a pinned schema, checks of enumerations, and the older trade layout."""

from __future__ import annotations

import random
import time
from collections.abc import Callable
from datetime import datetime, timezone
from decimal import Decimal, InvalidOperation

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import normalize as N
from tidemark.sources.schemas import ASSET_CLASSES, QUOTE, SIDES, TRADE

# Venues by asset class.
EQUITY_VENUES = ("ASX", "NYSE", "NASDAQ")
CRYPTO_VENUES = ("BINANCE", "COINBASE", "KRAKEN")


def exact(value, name: str) -> Decimal:
    """A number as decimal(18,8); one that is negative, no number or has too many digits raises."""
    try:
        d = value if isinstance(value, Decimal) else Decimal(str(value))
        q = d.quantize(Decimal(1).scaleb(-8))
    except InvalidOperation:
        raise ValueError(f"{name} is no decimal(18,8): {value!r}") from None
    if d < 0 or q != d or q.adjusted() >= 10:
        raise ValueError(f"{name} is no decimal(18,8): {value!r}")
    return q


def _micros(value) -> int:
    if isinstance(value, datetime):
        moment = value if value.tzinfo else value.replace(tzinfo=timezone.utc)
        whole = int(moment.timestamp())
        return whole * 1_000_000 + moment.microsecond
    if isinstance(value, int):
        return value if value > 10**15 else value * 1000
    raise ValueError(f"not a time: {value!r}")


def _row(record: dict, schema, numbers: tuple[str, ...], now_us: int) -> tuple:
    r = {"currency": "USD", "side": "UNKNOWN", "ingestion_timestamp": now_us} | {k: v for k, v in record.items() if v is not None}
    if r.get("asset_class") not in ASSET_CLASSES:
        raise ValueError(f"asset_class must be one of {', '.join(ASSET_CLASSES)}")
    if r["side"] not in SIDES:
        raise ValueError(f"side must be one of {', '.join(SIDES)}")
    r["timestamp"] = _micros(r["timestamp"])
    for n in numbers:
        r[n] = exact(r[n], n)
    for own in ("trade_id", "quote_id"):
        r.setdefault(own, f"{r['exchange']}-{r['timestamp'] // 1000}")
    r["vendor_data"], r["trade_conditions"] = r.get("vendor_data") or None, r.get("trade_conditions") or None
    return tuple(r.get(f.name) for f in schema)


def _identified(df: DataFrame, own_id: str, numbers: tuple[str, ...]) -> DataFrame:
    made = N.message_id(*(F.col(c) for c in ("exchange", "symbol", own_id, "timestamp", *numbers)))
    return df.withColumn("message_id", F.coalesce("message_id", made))


def trades(spark: SparkSession, records: list[dict], now_us: int = 0) -> DataFrame:
    """Trade records as rows; defaults are filled in, and a record of a wrong kind raises."""
    numbers = ("price", "quantity")
    return _identified(spark.createDataFrame([_row(r, TRADE, numbers, now_us) for r in records], TRADE), "trade_id", numbers)


def quotes(spark: SparkSession, records: list[dict], now_us: int = 0) -> DataFrame:
    numbers = ("bid_price", "bid_quantity", "ask_price", "ask_quantity")
    return _identified(spark.createDataFrame([_row(r, QUOTE, numbers, now_us) for r in records], QUOTE), "quote_id", numbers)


def from_older(df: DataFrame, currency: str = "AUD") -> DataFrame:
    """The older trade layout (company_id, exchange_timestamp in ms, volume, qualifiers, venue, buyer_id, sequence_number) as trades."""
    exchange = F.upper(F.col("exchange"))
    vendor = F.create_map(*(x for c in ("company_id", "qualifiers", "venue", "buyer_id") for x in (F.lit(c), F.col(c).cast("string"))))
    us = F.col("exchange_timestamp") * 1000
    named = {
        "message_id": F.lit(None).cast("string"), "trade_id": F.concat(F.col("exchange"), F.lit("-"), F.col("exchange_timestamp").cast("string")), "symbol": F.col("symbol"), "exchange": F.col("exchange"),
        "asset_class": F.when(exchange.isin(*CRYPTO_VENUES), "crypto").otherwise("equities"), "timestamp": us, "price": F.col("price").try_cast("decimal(18,8)"), "quantity": F.col("volume").try_cast("decimal(18,8)"),
        "currency": F.lit(currency), "side": F.lit("UNKNOWN"), "trade_conditions": F.lit(None).cast("array<string>"), "source_sequence": F.col("sequence_number").cast("bigint"), "ingestion_timestamp": N.epoch_micros(F.col("ingestion_timestamp")),
        "platform_sequence": F.lit(None).cast("bigint"), "vendor_data": F.map_filter(vendor, lambda k, v: v.isNotNull()),
    }
    return _identified(df.select(*(c.alias(n) for n, c in named.items())), "trade_id", ("price", "quantity"))


def retried(do: Callable[[], object], *, attempts: int = 3, first: float = 0.1, most: float = 10.0, retry: tuple[type[Exception], ...] = (OSError, ConnectionError), sleep: Callable[[float], None] = time.sleep):
    """Run a write again after errors that may pass, waiting longer each time; other errors and the last one raise."""
    for n in range(attempts):
        try:
            return do()
        except retry:
            if n == attempts - 1:
                raise
            sleep(min(most, first * 2**n) * random.uniform(0.8, 1.2))
    return None


def routed(batch: DataFrame, put: Callable[[DataFrame], object], dead_path: str, number: int, **options) -> bool:
    """A micro-batch's write: retried while errors may pass; a batch that can't be written goes to the dead letters whole, so its offsets can be committed."""
    try:
        retried(lambda: put(batch), **options)
    except Exception as e:  # noqa: BLE001
        reason = F.lit(f"{type(e).__name__}: {e}"[:500])
        batch.select(F.to_json(F.struct("*")).alias("raw_record"), reason.alias("error_reason"), F.lit("write_failure").alias("error_type")).write.mode("overwrite").parquet(f"{dead_path}/batch={number}")
        return False
    return True
