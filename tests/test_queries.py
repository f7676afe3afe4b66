from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import joins as J
from tidemark.operators import quality as Q
from tidemark.operators import queries as P
from tidemark.operators.candles import candles
from tidemark.plans.control import Breaker, Degradation, Open, shed
from tidemark.plans.engine import Engine

BASE = datetime(2026, 1, 21, 12, 0, 0)


@pytest.fixture(scope="module")
def trades(spark):
    rows = [("BTC" if i % 2 else "ETH", "x" if i % 3 else "y", BASE + timedelta(seconds=i), i, Decimal(i + 1), Decimal(i % 5), f"t{i}") for i in range(60)]
    return spark.createDataFrame(rows, "symbol string, exchange string, ts timestamp_ntz, seq long, price decimal(18,8), quantity decimal(18,8), trade_id string").cache()


def seqs(df):
    return [r.seq for r in df.collect()]


def test_filters_come_before_the_cut(trades):
    assert seqs(P.trades(trades, symbols="BTC", min_price=20, max_price=30, limit=3)) == [29, 27, 25]
    assert seqs(P.trades(trades, exchanges=["y"], limit=2, offset=1)) == [54, 51]


@pytest.mark.parametrize("limit", [0, -1, 10_001, "ten", None])
def test_bad_limits_raise(limit):
    with pytest.raises(ValueError):
        P.limited(limit)


def test_names_reach_the_query_as_values_only(trades):
    assert P.trades(trades, symbols="BTC' OR '1'='1").count() == 0


def test_the_newest_rows_need_no_full_sort(trades):
    assert "TakeOrderedAndProject" in P.trades(trades, symbols="BTC", limit=5)._jdf.queryExecution().executedPlan().toString()


def test_hybrid_prefers_the_lake_and_keeps_rows_without_key(spark, trades):
    lake = trades.withColumn("leg", F.lit("lake"))
    tail = trades.filter("seq >= 30").withColumn("leg", F.lit("tail")).withColumn("trade_id", F.when(F.col("seq") == 59, F.lit(None)).otherwise(F.col("trade_id")))
    tail = tail.unionByName(tail.filter("seq = 59"))
    as_of = F.lit(BASE + timedelta(seconds=70)).cast("timestamp_ntz")
    out = P.hybrid(lake, tail, as_of=BASE + timedelta(seconds=70), lag_seconds=30, limit=25, key="trade_id").collect()
    assert as_of is not None
    assert [r.seq for r in out] == [*range(36, 59), 59, 59]
    assert {r.leg for r in out if r.seq <= 40} == {"lake"} and {r.leg for r in out if r.seq > 40} == {"tail"}


def test_replay_by_cursor_gives_every_row_once(spark, trades):
    engine = Engine(spark, trades)
    got, cursor = [], None
    for _ in range(20):
        rows, cursor = next(engine.replay(batch=17, cursor=cursor))
        got += [r.seq for r in rows]
        if cursor is None:
            break
    assert got == list(range(60))
    assert [len(r) for r, _ in engine.replay(batch=25)] == [25, 25, 10]
    told = engine.place(next(engine.replay(batch=15))[1])
    assert (told["total"], told["batch"], told["sent"], told["progress"]) == (60, 1, 15, 25.0)
    with pytest.raises(ValueError):
        engine.place("nonsense")


def test_failing_queries_open_the_breaker(spark, trades):
    engine = Engine(spark, trades)
    engine.breaker = Breaker(failures=2)
    bad = trades.select(F.raise_error(F.lit("no")).alias("x"))
    for _ in range(2):
        with pytest.raises(Exception, match="no"):
            engine.fetch(bad)
    with pytest.raises(Open):
        engine.fetch(trades)
    engine.breaker = Breaker()
    assert len(engine.fetch(trades.limit(3))) == 3


def test_summary_reads_stored_bars_first(spark, trades):
    stored = Engine(spark, trades.limit(0), bars={"1d": candles(trades, "1d")})
    plain = Engine(spark, trades)
    row = lambda e, **k: [str(x) for x in e.summary("BTC", "2026-01-21", **k).select("open", "high", "low", "close", "volume", "trade_count").first()]
    assert row(stored) == row(plain)
    assert Engine(spark, trades, bars={"1d": candles(trades.limit(0), "1d")}).summary("BTC", "2026-01-21").count() == 1
    assert stored.status(F.lit(BASE).cast("timestamp_ntz"), {"1d": 1500})["overall"] in ("healthy", "stale")


def test_not_in_knows_nulls(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    right = lambda *v: spark.createDataFrame([(x,) for x in v], "b int")
    values = lambda r: sorted((x.a is not None, x.a or 0) for x in P.not_in(left, "a", r, "b").collect())
    assert values(right(1)) == [(True, 2)] and values(right(1, None)) == [] and len(values(right())) == 3


@pytest.mark.parametrize("block", [3, 7, 1 << 16])
def test_blocks_of_sequences_are_the_whole(spark, block):
    from random import Random

    r = Random(block)
    numbers = [r.choice([i, i, i + r.randrange(30), max(1, i // 3), i - 2]) for i in range(1, 120)]
    df = spark.createDataFrame([("x", "A", BASE + timedelta(seconds=i), i, q) for i, q in enumerate(numbers)], "exchange string, symbol string, ts timestamp_ntz, at long, q long")
    last = high = None
    want = []
    for q in numbers:
        if last is not None and q < last * 0.5:
            want.append(("RESET", 0))
            high = q
        elif high is None:
            want.append(("FIRST", 0))
            high = q
        elif q <= high:
            want.append(("OUT_OF_ORDER", 0))
        else:
            gap = q - high - 1
            want.append(("OK" if gap == 0 else "SMALL_GAP" if gap <= 10 else "LARGE_GAP", gap))
            high = q
        last = q
    got = Q.sequence_events(df, seq="q", order=["ts", "at"], block=block).orderBy("at").collect()
    assert [(x.event, x.gap) for x in got] == want
    prices = df.withColumnsRenamed({"q": "price", "at": "seq"})
    jumps = {x.seq for x in Q.jumps(prices, 0.5, block=block).collect()}
    assert jumps == {i for i in range(1, len(numbers)) if numbers[i - 1] and abs(numbers[i] - numbers[i - 1]) / numbers[i - 1] > 0.5}
    missing = {x for g in Q.gaps(df, "q", width=block).collect() for x in range(g.gap_start, g.gap_end + 1)}
    assert missing == set(range(min(numbers), max(numbers))) - set(numbers)


def test_command_line(spark, tmp_path):
    import io

    from tidemark.plans import cli
    from tidemark.sources.schemas import TABLES
    from tidemark.sources.store import Store

    root = f"file://{tmp_path}"
    spec = TABLES["trades"]
    rows = spark.range(30).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in spec.schema if f.name not in ("message_id", "symbol", "exchange", "timestamp", "price", "quantity", "source_sequence", "trade_date")), F.col("id").cast("string").alias("message_id"), F.lit("BTC").alias("symbol"), F.lit("x").alias("exchange"), (F.lit(1_767_225_600_000_000) + F.col("id") * 1_000_000).alias("timestamp"), F.lit(1).alias("price"), F.lit(2).alias("quantity"), F.col("id").alias("source_sequence"), F.lit("2026-01-01").cast("date").alias("trade_date"))
    Store(spark, f"{root}/trades", spec).append(rows)

    def run(*arguments):
        out = io.StringIO()
        return cli.run(spark, ["--root", root, *arguments], out), out.getvalue().splitlines()

    assert len(run("trades", "--limit", "5")[1]) == 6 and "29" in run("trades", "--limit", "1")[1][1]
    assert run("--format", "json", "trades", "--symbol", "ETH")[1] == []
    assert run("--format", "csv", "symbols")[1] == ["symbol", "BTC"] and len(run("snapshots")[1]) == 2 and "30" in run("stats")[1][1]
    assert run("quotes")[0] == 2 and run("trades", "--limit", "0")[0] == 2
    code, lines = run("--format", "json", "replay", "--batch", "12", "--batches", "2")
    assert code == 0 and len([x for x in lines if x.startswith("{")]) == 24 and "24 of 30 rows, 80.0 %" in lines[-1]


def test_recent_tail_keeps_its_bounds(spark, tmp_path, trades):
    from tidemark.streaming.tail import Tail

    tail = Tail(spark, f"file://{tmp_path}/tail", minutes=1, most=4)
    rows = trades.select("symbol", "ts", "seq")
    for n in range(3):
        tail.add(rows.filter(F.col("seq").between(20 * n, 20 * n + 19)), n)
    tail.add(rows.filter("seq >= 40"), 2)  # a batch that runs again
    got = tail.read(rows.schema).collect()
    want = sorted((r.ts for r in rows.collect()), reverse=True)
    by = {}
    for r in got:
        by.setdefault(r.symbol, []).append(r)
    assert all(len(v) <= 4 for v in by.values()) and max(r.ts for r in got) == want[0] and all(r.ts > want[0] - timedelta(minutes=1) for r in got)
    assert len(tail.generations()) <= 3 and tail.stats(rows.schema).count() == len(by)


def test_dead_letters_roll(spark, tmp_path):
    from tidemark.streaming.letters import Letters

    box = Letters(spark, f"file://{tmp_path}/dead", roll_bytes=2000)
    rows = spark.range(100).select(F.concat(F.lit("record "), "id").alias("raw_record"), F.when(F.col("id") % 4 == 0, "price_is_null").otherwise("symbol_required").alias("error_reason"), F.lit("x").alias("error_type")).coalesce(1)
    box.put(rows, "1")
    box.put(rows, "1")  # runs again
    told = box.stats()
    assert told["letters"] == 100 and told["reasons"] == {"price_is_null": 25, "symbol_required": 75} and told["files"] >= 5 and max(b for _, b in box.list()) < 3000
    assert box.read(reason="price_is_null").count() == 25 and box.list("1999-01-01") == []


def test_engine_rolls_stored_bars_up(spark, trades):
    from tidemark.operators.candles import candles

    engine = Engine(spark, trades.limit(0), bars={"1m": candles(trades, "1m")})
    bar = engine.ohlcv("btc ", "1h", limit=1).collect()[0]
    assert bar.high == 60 and bar.trade_count > 0
    assert len(engine.ohlcv_batch([{"symbol": "BTC", "timeframe": "1m"}])) == 1
    with pytest.raises(ValueError):
        engine.ohlcv_batch([{"symbol": "BTC", "timeframe": "1m", "limit": 10_000}] * 3)
    assert Engine(spark, trades).summary("BTC", "2026-01-21").count() == 1 and Engine(spark, trades).summary("BTC", "2026-01-22").count() == 0


def test_as_of_takes_the_last_quote_at_or_before(spark):
    t = spark.createDataFrame([("A", BASE, 1), ("A", BASE + timedelta(seconds=5), 2), ("B", BASE, 3)], "symbol string, ts timestamp_ntz, seq long")
    q = spark.createDataFrame([("A", BASE, 1, 10), ("A", BASE + timedelta(seconds=4), 2, None), ("A", BASE + timedelta(seconds=6), 3, 30)], "symbol string, ts timestamp_ntz, seq long, bid int")
    assert sorted((r.seq, r.bid) for r in J.as_of(t, q, keys=["symbol"], columns=["bid"]).collect()) == [(1, 10), (2, None), (3, None)]


@pytest.mark.parametrize("width", [1, 7, 86_400])
def test_as_of_does_not_depend_on_its_buckets(spark, width):
    from random import Random

    r = Random(9)
    t = [(r.choice("AB"), BASE + timedelta(seconds=r.randrange(60)), i) for i in range(80)]
    q = [(r.choice("AB"), BASE + timedelta(seconds=r.randrange(60)), i, r.choice([None, i])) for i in range(30)]
    out = J.as_of(spark.createDataFrame(t, "symbol string, ts timestamp_ntz, seq long"), spark.createDataFrame(q, "symbol string, ts timestamp_ntz, seq long, bid int"), keys=["symbol"], columns=["bid"], bucket_seconds=width)
    want = {}
    for s, at, i in t:
        before = [x for x in q if x[0] == s and x[1] <= at]
        want[i] = max(before, key=lambda x: (x[1], x[2]))[3] if before else None
    assert {x.seq: x.bid for x in out.collect()} == want


@pytest.mark.parametrize(("block", "seconds"), [(4, 1), (7, 11), (1 << 16, 86_400)])
def test_row_frames_do_not_depend_on_their_blocks(trades, block, seconds):
    from pyspark.sql import Window

    from tidemark.operators.windows import over_preceding

    t = trades.withColumn("ts", F.date_trunc("minute", "ts").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("seq") % 7))
    w = Window.partitionBy("symbol").orderBy("ts", "seq").rowsBetween(-3, 0)
    want = {r.seq: (r.s, r.n) for r in t.select("seq", F.sum("price").over(w).alias("s"), F.count("*").over(w).alias("n")).collect()}
    got = over_preceding(t, 3, {"s": F.sum("price"), "n": F.count("*")}, keys=["symbol"], order=["ts", "seq"], block=block, bucket_seconds=seconds)
    assert {r.seq: (r.s, r.n) for r in got.collect()} == want and got.count() == 60


def test_sequence_events(spark):
    numbers = [1, 2, 5, 30, 29, 30, 31, 3, 4, 4]
    df = spark.createDataFrame([("x", "A", BASE + timedelta(seconds=i), i, q) for i, q in enumerate(numbers)], "exchange string, symbol string, ts timestamp_ntz, at long, q long")
    got = [(r.event, r.gap) for r in Q.sequence_events(df, seq="q", order=["ts"]).orderBy("at").collect()]
    assert got == [("FIRST", 0), ("OK", 0), ("SMALL_GAP", 2), ("LARGE_GAP", 24), ("OUT_OF_ORDER", 0), ("OUT_OF_ORDER", 0), ("OK", 0), ("RESET", 0), ("OK", 0), ("OUT_OF_ORDER", 0)]


def test_every_row_is_valid_or_a_dead_letter(spark):
    now = 10**15
    rows = [("m", "A", Decimal(1), Decimal(1), "BUY", now - 5, "crypto"), (None, "A", None, Decimal(0), "HOLD", None, None), ("m", "", Decimal(-1), Decimal(1), "SELL", now + 1, "crypto"), ("m", "A", Decimal(1), Decimal(1), None, 1, "crypto")]
    df = spark.createDataFrame(rows, "message_id string, symbol string, price decimal(18,8), quantity decimal(18,8), side string, timestamp long, asset_class string")
    valid, dead = Q.split(df, F.lit(now))
    assert valid.count() == 1
    got = sorted((r.error_reason, list(r.errors)) for r in dead.collect())
    assert got == [("price_is_null", ["price_is_null", "quantity_must_be_positive", "invalid_side", "message_id_required", "deserialization_failed_or_null_fields"]), ("price_must_be_positive", ["price_must_be_positive", "timestamp_in_future"]), ("timestamp_too_old", ["timestamp_too_old", "deserialization_failed_or_null_fields"])]
    kinds = {r.error_reason: r.error_type for r in dead.collect()}
    assert kinds == {"price_is_null": "price_validation", "price_must_be_positive": "price_validation", "timestamp_too_old": "timestamp_validation"}
    edge = df.limit(1).withColumn("timestamp", F.lit(now))
    assert [r.error_reason for r in Q.split(edge, F.lit(now))[1].collect()] == ["timestamp_in_future"]


def test_audit_statuses(spark):
    df = lambda counts: spark.createDataFrame([(k,) for k, n in counts.items() for _ in range(n)], "k string")
    out = {r.k: r.status for r in Q.audit(df({"a": 100, "b": 100, "c": 100, "d": 100}), df({"a": 100, "b": 97, "c": 90, "d": 110, "e": 5}), ["k"]).collect()}
    assert out == {"a": "ok", "b": "warning", "c": "missing_data", "d": "excess_data", "e": "ok"}


def test_degradation_rises_at_once_and_falls_slowly():
    now = [0.0]
    d = Degradation(clock=lambda: now[0])
    assert d.update(600_000) == 2
    assert d.update(0) == 2
    now[0] = 31
    assert d.update(300_000) == 2 and d.update(100) == 1 and d.update(100) == 1
    now[0] = 62
    assert d.update(100) == 0


def test_shedding(spark, trades):
    assert {r.symbol for r in shed(trades, {"BTC": 1}, 3).select("symbol").distinct().collect()} == {"BTC"}
    assert shed(trades, {"BTC": 1}, 0).count() == 60


def test_breaker_opens_rests_and_closes():
    now = [0.0]
    b = Breaker(clock=lambda: now[0])
    for _ in range(5):
        with pytest.raises(ZeroDivisionError):
            b.call(lambda: 1 / 0)
    with pytest.raises(Open):
        b.call(lambda: 1)
    now[0] = 61
    assert b.call(lambda: 1) == 1 and b.state == "half-open"
    assert b.call(lambda: 1) == 1 and b.state == "closed"
