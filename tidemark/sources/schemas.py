"""Canonical column types and layouts of the engine's tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRICE = T.DecimalType(18, 8)
TOTAL = T.DecimalType(38, 8)


_PLAIN = {"string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "boolean": T.BooleanType(), "binary": T.BinaryType(), "timestamp": T.TimestampType(), "timestamp_ntz": T.TimestampNTZType(), "date": T.DateType(), "decimal(18,8)": PRICE, "decimal(38,8)": TOTAL}


def _type(text: str) -> T.DataType:
    if text.startswith("array<"):
        return T.ArrayType(_type(text[6:-1]))
    if text.startswith("map<string,"):
        return T.MapType(T.StringType(), _type(text[11:-1]))
    return _PLAIN[text]


def struct(text: str) -> T.StructType:
    """Fields written as ``name type, ...``; unlike Spark's own parser this needs no session."""
    return T.StructType([T.StructField(*(name, _type(kind))) for name, kind in (f.split(" ", 1) for f in text.split(", "))])


# Field names and types of the published trade, quote, reference and candle formats (a candle's states beside them).
TRADE = struct("message_id string, trade_id string, symbol string, exchange string, asset_class string, timestamp bigint, price decimal(18,8), quantity decimal(18,8), currency string, side string, trade_conditions array<string>, source_sequence bigint, ingestion_timestamp bigint, platform_sequence bigint, vendor_data map<string,string>")
QUOTE = struct("message_id string, quote_id string, symbol string, exchange string, asset_class string, timestamp bigint, bid_price decimal(18,8), bid_quantity decimal(18,8), ask_price decimal(18,8), ask_quantity decimal(18,8), currency string, source_sequence bigint, ingestion_timestamp bigint, platform_sequence bigint, vendor_data map<string,string>")
REFERENCE = struct("message_id string, company_id string, symbol string, exchange string, asset_class string, company_name string, isin string, currency string, listing_date bigint, delisting_date bigint, is_active boolean, ingestion_timestamp bigint, vendor_data map<string,string>")
CANDLE = struct("exchange string, symbol string, window_start timestamp, window_end timestamp, open_time timestamp, close_time timestamp, open_seq bigint, close_seq bigint, open decimal(18,8), high decimal(18,8), low decimal(18,8), close decimal(18,8), volume decimal(38,8), quote_volume decimal(38,8), trade_count bigint, vwap decimal(38,8)")
RAW = struct("value binary, topic string, partition int, offset bigint, kafka_timestamp timestamp, ingestion_timestamp timestamp, ingestion_date date")
DEAD = struct("raw_record string, error_reason string, error_type string, bronze_source string, failed_at timestamp, dlq_date date")

COINBASE = struct("trade_id string, product_id string, price string, size string, time string, side string, sequence_num bigint")

ASSET_CLASSES = ("equities", "crypto", "futures", "options")
SIDES = ("BUY", "SELL", "SELL_SHORT", "UNKNOWN")


@dataclass(frozen=True)
class TableSpec:
    """A logical table: its columns, partition columns, order within files, days to keep and natural key."""

    name: str
    schema: T.StructType
    partitions: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    keep_days: int | None = None
    key: tuple[str, ...] = ()
    properties: dict[str, str] = field(default_factory=lambda: {"compression": "zstd", "parquet.compression.codec.zstd.level": "3", "parquet.block.size": str(128 << 20)})

    def conform(self, df: DataFrame) -> DataFrame:
        """The table's columns in order, cast; a missing column fails, others are left out."""
        missing = [f.name for f in self.schema if f.name not in df.columns]
        if missing:
            raise ValueError(f"{self.name} lacks {', '.join(missing)}")
        return df.select(*(F.col(f.name).cast(f.dataType) for f in self.schema))


def _candle_spec(frame: str, days: int) -> TableSpec:
    schema = T.StructType([*CANDLE.fields, T.StructField("window_date", T.DateType())])
    return TableSpec(f"ohlcv_{frame}", schema, ("window_date",), ("exchange", "symbol", "window_start"), days, ("exchange", "symbol", "window_start"))


# Days that candles of each width are kept.
CANDLE_DAYS = {"1m": 90, "5m": 180, "15m": 180, "30m": 365, "1h": 1095, "1d": 1825}
TABLES = {
    t.name: t
    for t in (
        TableSpec("trades", T.StructType([*TRADE.fields, T.StructField("trade_date", T.DateType())]), ("trade_date", "exchange"), ("timestamp", "source_sequence"), 365, ("message_id",)),
        TableSpec("quotes", T.StructType([*QUOTE.fields, T.StructField("quote_date", T.DateType())]), ("quote_date", "exchange"), ("timestamp", "source_sequence"), 365, ("message_id",)),
        TableSpec("bronze", RAW, ("ingestion_date",), ("offset",), 7, ("topic", "partition", "offset")),
        TableSpec("dead_letters", DEAD, ("dlq_date",), ("failed_at",), 30),
        *(_candle_spec(f, d) for f, d in CANDLE_DAYS.items()),
    )
}


class Registry:
    """Logical to physical names with aliases; swapping an alias cuts readers over at once.

    Given a session, aliases are kept in files below the root, a new one for each swap, so every process sees the last one.
    """

    def __init__(self, root: str, overrides: dict[str, str] | None = None, spark=None):
        self.root, self.names, self.spark = root.rstrip("/"), dict(overrides or {}), spark

    def _files(self):
        from tidemark.sources.files import Files

        return Files(self.spark, f"{self.root}/_aliases")

    def path(self, logical: str) -> str:
        target = self.names.get(logical, logical)
        if self.spark is not None:
            files = self._files()
            own = sorted(n for n, *_ in files.children("") if n.startswith(f"{logical}@"))
            target = files.read(own[-1]) if own else target
        return target if "/" in target else f"{self.root}/{target}"

    def swap(self, logical: str, physical: str) -> None:
        if self.spark is None:
            self.names[logical] = physical
            return
        files = self._files()
        own = sorted(n for n, *_ in files.children("") if n.startswith(f"{logical}@"))
        files.create(f"{logical}@{int(own[-1].rpartition('@')[2]) + 1 if own else 1:08d}", physical)

    def tables(self) -> list[str]:
        """Logical tables that exist below the root."""
        from tidemark.sources.files import Files

        files = Files(self.spark, self.root)
        return sorted(t for t in TABLES if files.exists(f"{self.path(t)}/_log"))

    def spec(self, logical: str) -> TableSpec:
        if logical not in TABLES:
            raise KeyError(f"unknown table {logical}")
        return TABLES[logical]


def date_bounds(date_col: str, ts_col: str, start, end) -> list[Column]:
    """Inclusive bounds on a timestamp, with the bounds they imply for its date column, so partitions are pruned."""
    out = []
    if start is not None:
        out += [F.col(date_col) >= F.to_date(F.lit(start)), F.col(ts_col) >= F.lit(start)]
    if end is not None:
        out += [F.col(date_col) <= F.to_date(F.lit(end)), F.col(ts_col) <= F.lit(end)]
    return out
