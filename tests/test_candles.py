from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal
from random import Random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.buckets import coarsest_for, frame
from tidemark.operators import candles as C

BASE = datetime(2026, 1, 21, 12, 0, 0)
SCHEMA = "exchange string, symbol string, ts timestamp_ntz, seq long, price decimal(18,8), quantity decimal(18,8)"


def trades(spark, rows):
    return spark.createDataFrame([(e, s, BASE + timedelta(seconds=t), i, Decimal(str(p)), Decimal(str(q))) for i, (e, s, t, p, q) in enumerate(rows)], SCHEMA)


def only(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_four_trades_make_one_bar(spark):
    bar = only(C.candles(trades(spark, [("x", "BTC", 10 * i, 100 + i, 1) for i in range(4)]), "1m"))
    assert (bar.open, bar.high, bar.low, bar.close, bar.volume, bar.trade_count) == (100, 103, 100, 103, 4, 4)
    assert bar.window_start == BASE and bar.window_end == BASE + timedelta(minutes=1)
    assert bar.vwap == pytest.approx(101.5)


def test_a_single_trade_is_its_own_bar(spark):
    bar = only(C.candles(trades(spark, [("x", "BTC", 0, 100, 1)]), "1m"))
    assert bar.open == bar.high == bar.low == bar.close == 100 and bar.vwap == 100


def test_order_follows_time_then_sequence_not_arrival(spark):
    df = trades(spark, [("x", "BTC", 5, 7, 1), ("x", "BTC", 1, 3, 1), ("x", "BTC", 5, 9, 1), ("x", "BTC", 1, 4, 1)])
    bar = only(C.candles(df.orderBy(F.rand(1)), "1m"))
    assert (bar.open, bar.close) == (3, 9)


def test_order_within_a_second(spark):
    rows = [("x", "B", BASE + timedelta(microseconds=us), i, Decimal(p), Decimal(1)) for i, (us, p) in enumerate([(900_000, 2), (100_000, 1), (950_000, 3)])]
    bar = only(C.candles(spark.createDataFrame(rows, SCHEMA), "1m"))
    assert (bar.open, bar.close) == (1, 3)


def test_venues_are_kept_apart_and_no_volume_has_no_vwap(spark):
    out = {r.exchange: r for r in C.candles(trades(spark, [("x", "B", 0, 1, 0), ("y", "B", 0, 5, 2)]), "1m").collect()}
    assert out["x"].vwap is None and out["y"].vwap == 5


def random_trades(spark, n=600):
    r = Random(3)
    return trades(spark, [(r.choice("xy"), r.choice(["A", "B"]), r.randrange(0, 3 * 86400), r.randrange(1, 500), r.randrange(0, 9)) for _ in range(n)]).filter("quantity > 0")


def rows_of(df):
    return sorted(tuple(r) for r in df.drop("vwap").select(sorted(c for c in df.columns if c != "vwap")).collect())


@pytest.mark.parametrize("wide", ["5m", "15m", "30m", "1h", "1d"])
def test_rolling_up_equals_aggregating(spark, wide):
    t = random_trades(spark)
    assert rows_of(C.roll_up(C.candles(t, "1m"), wide)) == rows_of(C.candles(t, wide))


def test_merging_disjoint_slices_equals_the_whole(spark):
    t = random_trades(spark)
    a, b = C.candles(t.filter("seq % 2 = 0"), "1h"), C.candles(t.filter("seq % 2 = 1"), "1h")
    assert rows_of(C.merge_additive(a, b)) == rows_of(C.candles(t, "1h"))


def test_replacing_twice_is_replacing_once(spark):
    t = random_trades(spark)
    old, new = C.candles(t.filter("seq < 300"), "1d"), C.candles(t, "1d")
    once = C.merge_replace(old, new)
    assert rows_of(C.merge_replace(once, new)) == rows_of(once)


def test_invariants_hold_and_breaches_are_counted(spark):
    bars = C.candles(random_trades(spark), "15m")
    row = only(C.invariants(bars))
    assert row.bars == bars.count() and (row.price_order, row.vwap_bounds, row.positive_volume, row.window_order) == (0, 0, 0, 0)
    broken = only(C.invariants(bars.withColumn("high", F.lit(Decimal(-1))).withColumn("volume", F.lit(None).cast("decimal(38,8)"))))
    assert broken.price_order == row.bars and broken.positive_volume == row.bars


def test_upsert_keeps_old_values_where_new_ones_are_null(spark):
    old, new = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, s string, v int"), spark.createDataFrame([(2, None, 9), (3, "c", 3)], "k int, s string, v int")
    assert sorted(map(tuple, C.upsert(old, new, ("k",)).collect())) == [(1, "a", 1), (2, "b", 9), (3, "c", 3)]


def test_planner_picks_the_coarsest_bars():
    assert coarsest_for(60, ["1m", "5m", "30m"]) == "30m"
    assert coarsest_for(45, ["1m", "30m"]) == "1m"
    assert coarsest_for(15, ["30m"]) is None


def test_unknown_metrics_and_frames_raise(spark):
    t = random_trades(spark, 5)
    with pytest.raises(ValueError):
        C.buckets(t, "1m", ["median"])
    with pytest.raises(ValueError):
        frame("7m")


def test_merging_settles_ties_by_sequence(spark):
    """Three trades of one time, and slices that part them: the bar opens with the first sequence and closes with the last, in either order."""
    at = datetime(2026, 1, 1)
    rows = [("x", "A", at, q, Decimal(p), Decimal(1)) for q, p in ((1, 10), (2, 20), (3, 30))]
    df = spark.createDataFrame(rows, "exchange string, symbol string, ts timestamp_ntz, seq long, price decimal(18,8), quantity decimal(18,8)")
    one, two = C.candles(df.filter("seq <> 2"), "1m"), C.candles(df.filter("seq = 2"), "1m")
    for a, b in ((one, two), (two, one)):
        r = C.roll_up(C.merge_additive(a, b), "1h").first()
        assert (int(r.open), int(r.close), r.open_seq, r.close_seq) == (10, 30, 1, 3)
    big = C.candles(df.withColumn("seq", F.col("seq") + F.lit((1 << 63) - 10)), "1m").first()
    assert (int(big.open), int(big.close)) == (10, 30)
