from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest

from tidemark.functions import records as R
from tidemark.sources.schemas import QUOTE, TRADE

GOOD = {"symbol": "BTCUSDT", "exchange": "BINANCE", "asset_class": "crypto", "timestamp": datetime(2026, 1, 1, 0, 0, 0, 123), "price": "16500.5", "quantity": 0.05}


def test_trades_have_defaults_and_stable_ids(spark):
    a, b = (R.trades(spark, [GOOD | {"vendor_data": {}}, GOOD | {"timestamp": 1767225600123, "side": "SELL", "vendor_data": {"k": "v"}}]) for _ in range(2))
    assert a.schema.names == TRADE.names
    x, y = a.collect()
    assert (x.timestamp, x.price, x.side, x.currency, x.trade_id, x.vendor_data) == (1767225600000123, Decimal("16500.50000000"), "UNKNOWN", "USD", "BINANCE-1767225600000", None)
    assert y.timestamp == 1767225600123000 and y.vendor_data == {"k": "v"}
    assert [r.message_id for r in a.collect()] == [r.message_id for r in b.collect()] and x.message_id != y.message_id


@pytest.mark.parametrize("change", [{"asset_class": "bonds"}, {"side": "HOLD"}, {"price": "abc"}, {"price": -1}, {"price": "1.123456789"}, {"price": 10**10}, {"timestamp": "soon"}])
def test_wrong_records_raise(spark, change):
    with pytest.raises(ValueError):
        R.trades(spark, [GOOD | change])


def test_quotes(spark):
    q = {k: GOOD[k] for k in ("symbol", "exchange", "asset_class", "timestamp")} | {"bid_price": 1, "bid_quantity": 2, "ask_price": 3, "ask_quantity": 4}
    out = R.quotes(spark, [q])
    assert out.schema.names == QUOTE.names and out.first().ask_price == 3


def test_older_trades(spark):
    rows = [("BHP", 123, "ASX", 1672531199900, Decimal("45.67"), 1000, 0, "X", None, 1672531200000, 12345), ("BTC", 1, "kraken", 1672531199900, Decimal("1"), 1, 0, "Y", "b", 1672531200000, None)]
    df = spark.createDataFrame(rows, "symbol string, company_id int, exchange string, exchange_timestamp long, price decimal(18,6), volume long, qualifiers int, venue string, buyer_id string, ingestion_timestamp long, sequence_number long")
    x, y = R.from_older(df).orderBy("symbol").collect()
    assert (x.quantity, x.timestamp, x.asset_class, x.currency) == (1000, 1672531199900000, "equities", "AUD")
    assert x.vendor_data == {"company_id": "123", "qualifiers": "0", "venue": "X"} and y.vendor_data["buyer_id"] == "b" and y.asset_class == "crypto"


def test_retries_and_dead_batches(spark, tmp_path):
    tries, waits = [], []

    def shaky(_=None):
        tries.append(1)
        if len(tries) < 3:
            raise OSError("later")
        return "done"

    assert R.retried(shaky, sleep=waits.append) == "done" and len(waits) == 2 and waits[1] > waits[0]
    df = spark.createDataFrame([(1, "a")], "i int, s string")

    def broken(_):
        raise ValueError("never")

    assert not R.routed(df, broken, f"{tmp_path}/dead", 7, sleep=waits.append)
    assert spark.read.parquet(f"{tmp_path}/dead").first().error_reason == "ValueError: never"
    assert R.routed(df, lambda b: b.count(), f"{tmp_path}/dead", 8)
