"""Sources and sinks beyond the store: raw streams, relational databases, text files; egress formats."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.schemas import RAW

# Venues with their asset classes, and the kinds of topics.
EXCHANGES = {"binance": "crypto", "kraken": "crypto", "coinbase": "crypto", "asx": "equities"}
DATA_TYPES = ("trades", "quotes", "reference_data")


def topic(asset_class: str, data_type: str, exchange: str) -> str:
    """market.{asset class}.{data type}.{exchange}"""
    if data_type not in DATA_TYPES:
        raise ValueError(f"data type must be one of {', '.join(DATA_TYPES)}")
    return f"market.{asset_class}.{data_type}.{exchange.lower()}"


def topics(*, exchange: str | None = None, asset_class: str | None = None, data_type: str | None = None) -> list[str]:
    """All topics, or those of a venue, an asset class or a data type."""
    return [topic(a, d, e) for e, a in EXCHANGES.items() for d in DATA_TYPES if exchange in (None, e) and asset_class in (None, a) and data_type in (None, d)]


def kafka_stream(spark: SparkSession, servers: str, subscribe: list[str], *, most: int = 10_000, starting: str = "latest") -> DataFrame:
    """Raw messages with their metadata.  Needs the Kafka connector on the class path."""
    df = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", ",".join(subscribe)).option("startingOffsets", starting).option("maxOffsetsPerTrigger", most).option("failOnDataLoss", "false").load()
    return raw(df)


def raw(df: DataFrame) -> DataFrame:
    """The bronze layout out of a source with Kafka's columns."""
    out = df.select("value", "topic", "partition", "offset", F.col("timestamp").alias("kafka_timestamp"), F.current_timestamp().alias("ingestion_timestamp"))
    return out.withColumn("ingestion_date", F.to_date("ingestion_timestamp")).select(*RAW.names)


def avro_bronze(df: DataFrame, schemas: dict[int, str]) -> DataFrame:
    """Bronze that decodes at ingest: the raw layout, the schema's number and the record; bad messages stay with a null record."""
    from tidemark.functions import avro

    return avro.decoded(df, schemas)


def file_stream(spark: SparkSession, path: str, schema: T.StructType, *, most_files: int | None = None) -> DataFrame:
    """A folder of Parquet files as a stream, some files at a time."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", most_files) if most_files else reader).parquet(path)


def json_lines(spark: SparkSession, path: str, schema: T.StructType, *, stream: bool = False) -> DataFrame:
    """Whole messages as text, parsed by a pinned schema; lines that can't be parsed have a null ``message`` and keep ``value``."""
    lines = (spark.readStream if stream else spark.read).text(path)
    return lines.filter(F.trim("value") != "").withColumn("message", F.from_json("value", schema))


def jdbc_window(spark: SparkSession, url: str, table: str, ts: str, seq: str, low: str, high: str, *, low_seq: int | None = None, columns: str = "*", partition_column: str | None = None, bounds: tuple | None = None, parts: int = 8, properties: dict | None = None) -> DataFrame:
    """The half-open window (low, high] of a database table, by time or by (time, sequence), read in parallel by a numeric column's ranges where one is named."""
    for name in (table, ts, seq):
        identifier(name)
    literal = lambda x: "'" + str(x).replace("'", "''") + "'"
    query = f"(SELECT {columns} FROM {table} WHERE {ts} > {literal(low)} AND {ts} <= {literal(high)}) w"
    if low_seq is not None:  # rows of the last time that came after the mark's sequence
        query = f"(SELECT {columns} FROM {table} WHERE ({ts} > {literal(low)} OR ({ts} = {literal(low)} AND {seq} > {int(low_seq)})) AND {ts} <= {literal(high)}) w"
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", query).options(**(properties or {}))
    if partition_column:
        identifier(partition_column)
        reader = reader.option("partitionColumn", partition_column).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", parts)
    return reader.load()


def identifier(name: str) -> str:
    """A plain or dotted identifier; anything else raises."""
    if not name or not all(part.isidentifier() for part in name.split(".")):
        raise ValueError(f"not an identifier: {name!r}")
    return name


def csv_by_date(spark: SparkSession, path: str, schema: T.StructType, date_column: str, days: list[str], *, fmt: str = "MM/dd/yyyy") -> DataFrame:
    """The rows of CSV files that fall on given days."""
    df = spark.read.schema(schema).option("header", True).csv(path)
    return df.filter(F.to_date(F.col(date_column), fmt).isin([F.lit(d).cast("date") for d in days]))


def instruments(spark: SparkSession, text: str) -> DataFrame:
    """(exchange, symbol) out of a configuration text of ``name:`` lines each followed by ``- symbol`` lines."""
    rows, own = [], None
    for line in text.splitlines():
        bare = line.split("#")[0].strip()
        if bare.endswith(":"):
            own = bare[:-1]
        elif bare.startswith("- ") and own:
            rows.append((own, bare[2:].strip("\"' ")))
    return spark.createDataFrame(rows, "exchange string, symbol string")


def write(df: DataFrame, path: str, kind: str, fields: list[str] | None = None) -> None:
    """Egress as json, csv or parquet, with an allow-list of fields."""
    if kind not in ("json", "csv", "parquet"):
        raise ValueError(f"unknown format {kind}")
    if fields and (unknown := [f for f in fields if f not in df.columns]):
        raise ValueError(f"unknown fields: {', '.join(unknown)}")
    writer = (df.select(*fields) if fields else df).write.mode("overwrite")
    (writer.option("header", True).csv if kind == "csv" else getattr(writer, kind))(path)


def kafka_avro_sink(df: DataFrame, servers: str, to: str, key: str, schema_json: str, number: int) -> None:
    """Rows as Avro messages with a registry's header, keyed by a column.  Needs the Kafka connector on the class path."""
    from tidemark.functions import avro

    avro.encoded(df, schema_json, number, key=key).write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", to).save()


def kafka_sink(df: DataFrame, servers: str, to: str, key: str) -> None:
    """Rows as JSON messages keyed by a column.  Needs the Kafka connector on the class path."""
    df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value")).write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", to).save()


def local_text(path: str) -> str:
    return Path(path).read_text()
