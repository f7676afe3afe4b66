"""The recent tail of a stream: rows of the last minutes, at most so many a symbol, kept in a folder that each micro-batch renews.

Each batch writes the tail whole, as a generation of its own, so readers see one generation and a batch that runs again writes the same one.  The tail is small by its two
bounds; older generations go once a newer one is there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources.files import Files


class Tail:
    """Recent rows of all symbols.

    ``minutes`` counts back from the newest row seen, ``most`` is the greatest number of rows of a symbol; the newest stay.
    """

    def __init__(self, spark: SparkSession, root: str, *, minutes: int = 5, most: int = 10_000, ts: str = "ts", seq: str = "seq", keys: tuple[str, ...] = ("symbol",), keep: int = 2):
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark, root)
        self.minutes, self.most, self.ts, self.seq, self.keys, self.keep = minutes, most, ts, seq, keys, keep

    def generations(self) -> list[int]:
        """Numbers of the generations that are whole."""
        return sorted({int(n.split("/")[0][4:]) for n, *_ in self.files.children("", True) if n.startswith("gen=") and n.endswith("/_SUCCESS")})

    def trimmed(self, rows: DataFrame) -> DataFrame:
        """What of the rows belongs to the tail."""
        newest = rows.agg(F.max(self.ts).alias("_newest"))
        recent = rows.join(F.broadcast(newest)).filter(F.col(self.ts) > F.col("_newest") - F.expr(f"INTERVAL {int(self.minutes)} MINUTES")).drop("_newest")  # one row
        place = F.row_number().over(Window.partitionBy(*self.keys).orderBy(F.desc(self.ts), F.desc(self.seq)))
        return recent.withColumn("_place", place).filter(F.col("_place") <= self.most).drop("_place")

    def add(self, batch: DataFrame, number: int) -> None:
        """The tail after a batch, as generation ``number`` + 1."""
        before = [g for g in self.generations() if g <= number]
        rows = batch
        if before:
            rows = self.spark.read.schema(batch.schema).parquet(f"{self.root}/gen={before[-1]}").unionByName(batch)
        self.trimmed(rows).write.mode("overwrite").parquet(f"{self.root}/gen={number + 1}")
        for g in before[: 1 - self.keep]:
            self.files.delete(f"gen={g}", True)

    def read(self, schema) -> DataFrame:
        """The last whole generation."""
        last = self.generations()
        return self.spark.read.schema(schema).parquet(f"{self.root}/gen={last[-1]}") if last else self.spark.createDataFrame([], schema)

    def stats(self, schema) -> DataFrame:
        """Rows, oldest and newest time of each symbol."""
        return self.read(schema).groupBy(*self.keys).agg(F.count("*").alias("n"), F.min(self.ts).alias("oldest"), F.max(self.ts).alias("newest"))

    def follow(self, stream: DataFrame, checkpoint: str, *, trigger: dict | None = None) -> StreamingQuery:
        return stream.writeStream.foreachBatch(self.add).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
