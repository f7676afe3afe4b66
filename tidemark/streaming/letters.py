"""Dead letters as JSON lines in files that are rolled by size: written, listed, read back, counted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.files import Files

LETTER = "raw_record string, error_reason string, error_type string, retries int, failed_at timestamp"
ROLL_BYTES = 100 << 20  # Fixed value: the size from which a file is followed by another.


class Letters:
    """A folder of dead letters, by day.

    Every write has files of its own; a file holds no more records than fill ``roll_bytes`` at the records' mean size, which the write counts first.
    """

    def __init__(self, spark: SparkSession, root: str, *, roll_bytes: int = ROLL_BYTES):
        self.spark, self.root, self.roll_bytes, self.files = spark, root.rstrip("/"), roll_bytes, Files(spark, root)

    def put(self, rows: DataFrame, batch: str) -> None:
        """Rows with raw_record, error_reason, error_type (retries and failed_at are filled in).  A batch that runs again replaces itself."""
        made = rows.select("raw_record", "error_reason", "error_type", (F.col("retries") if "retries" in rows.columns else F.lit(0)).cast("int").alias("retries"), (F.col("failed_at") if "failed_at" in rows.columns else F.current_timestamp()).alias("failed_at"))
        made = made.withColumn("day", F.to_date("failed_at"))
        size = made.agg(F.avg(F.length(F.to_json(F.struct("*"))))).first()[0]
        if size is None:
            return
        most = max(1, int(self.roll_bytes / (size + 1)))
        made.write.option("maxRecordsPerFile", most).partitionBy("day").mode("overwrite").json(f"{self.root}/batch={batch}")

    def list(self, day: str | None = None) -> list[tuple[str, int]]:
        """(path, bytes) of the files, all or a day's."""
        return sorted((f"{self.root}/{n}", size) for n, size, _ in self.files.children("", True) if n.endswith(".json") and (day is None or f"/day={day}/" in n))

    def read(self, day: str | None = None, reason: str | None = None) -> DataFrame:
        """The letters, all, a day's, or those of a reason."""
        paths = [p for p, _ in self.list(day)]
        if not paths:
            return self.spark.createDataFrame([], LETTER)
        found = self.spark.read.schema(LETTER).json(paths)
        return found if reason is None else found.filter(F.col("error_reason") == reason)

    def stats(self) -> dict:
        """Files, bytes, letters, and letters by reason."""
        files = self.list()
        by = {r["error_reason"]: r["count"] for r in self.read().groupBy("error_reason").count().collect()}  # reasons are few
        return {"files": len(files), "bytes": sum(b for _, b in files), "letters": sum(by.values()), "reasons": by}
