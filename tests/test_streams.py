from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import candles as C
from tidemark.operators import quality as Q
from tidemark.plans import stored
from tidemark.sources import views as V

SF = "/root/testdata/sf0.001"


def test_streamed_candles_are_all_the_bars(spark):
    """Open windows too; that they equal the batch's is checked with the other queries."""
    want = C.candles(V.trades(spark, SF).filter("quantity > 0"), "1h").count()
    assert stored.stream_candles(spark, SF).count() == want


def test_a_repeated_message_arrives_once(spark):
    assert stored.stream_dedup(spark, SF).count() == V.trades(spark, SF).count()


def test_streamed_sequence_events_equal_batch_events(spark):
    got = stored.stream_sequence(spark, SF).groupBy("event").agg(F.sum("n"))
    want = Q.sequence_events(V.trades(spark, SF), seq="seq", order=["ts", "seq"]).groupBy("event").count()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_dead_letters_of_a_stream(spark):
    zero = V.trades(spark, SF).filter("quantity = 0").count()
    assert {(r.error_reason, r.n) for r in stored.stream_dead_letters(spark, SF).collect()} >= {("quantity_must_be_positive", zero)}


def test_stream_stream_join(spark, tmp_path):
    from tidemark.sources.readers import file_stream
    from tidemark.streaming.medallion import joined

    t = spark.sql("SELECT 'A' AS symbol, timestamp'2026-01-01 00:00:10' AS ts, 1 AS seq")
    q = spark.sql("SELECT 'A' AS symbol, timestamp'2026-01-01 00:00:08' AS quote_ts, 5 AS bid UNION ALL SELECT 'A', timestamp'2026-01-01 00:00:01', 6")
    t.write.parquet(f"{tmp_path}/t")
    q.write.parquet(f"{tmp_path}/q")
    out = joined(file_stream(spark, f"{tmp_path}/t", t.schema), file_stream(spark, f"{tmp_path}/q", q.schema), keys=["symbol"], seconds=5)
    run = out.writeStream.format("parquet").option("path", f"{tmp_path}/o").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    run.awaitTermination()
    assert [r.bid for r in spark.read.parquet(f"{tmp_path}/o").collect()] == [5]
