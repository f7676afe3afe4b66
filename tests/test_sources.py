from __future__ import annotations

import json
import time
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import avro
from tidemark.functions import normalize as N
from tidemark.operators.candles import candles
from tidemark.plans.offload import Mark, Marks, Metrics, due, has_new, maintain, offload, reaggregate, run_layers
from tidemark.plans.stored import TICKS
from tidemark.sources import readers as R
from tidemark.sources.schemas import TABLES, Registry, TableSpec
from tidemark.sources.store import Conflict, Snapshot, Store
from tidemark.streaming import medallion as M

BASE = datetime(2026, 1, 1)


def ticks(spark, numbers, day=0):
    rows = [(i, "A", "x", Decimal(i), Decimal(1), BASE + timedelta(days=day, seconds=i), f"t{i}", date(2026, 1, 1 + day)) for i in numbers]
    return spark.createDataFrame(rows, TICKS.schema)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, f"file://{tmp_path}/t", TICKS)


def seqs(df):
    return sorted(r.seq for r in df.select("seq").collect())


def test_time_travel_and_repeated_batches(spark, store):
    first = store.append(ticks(spark, range(3)), "b1")
    store.append(ticks(spark, range(3, 5), 1), "b2")
    store.append(ticks(spark, range(3, 5), 1), "b2")
    assert seqs(store.read()) == [0, 1, 2, 3, 4] and seqs(store.read(first.id)) == [0, 1, 2]
    assert store.at(first.at).id == first.id and store.at(first.at - 1) is None
    assert store.history().count() == 2 and store.partitions().count() == 2
    assert store.stats()["rows"] == 5


def test_a_second_writer_of_the_same_snapshot_fails(spark, store):
    base = store.append(ticks(spark, [1]))
    with pytest.raises(Conflict):
        store._commit(Snapshot(0, 0.0, "x", {}), "overwrite", lambda _: base.files)


def test_an_append_that_loses_begins_again(spark, store):
    base = store.append(ticks(spark, [1]))
    store.append(ticks(spark, [2]), "b2")
    new = store._put(ticks(spark, [3]))
    store._commit(base, "append", lambda b: b.files | new, "b3", retries=2)
    assert seqs(store.read()) == [1, 2, 3]
    again = store._commit(base, "append", lambda b: b.files | {"x": {}}, "b2", retries=2)  # committed by the other
    assert again.id == 3 and seqs(store.read()) == [1, 2, 3]


def test_batch_ids_are_kept_for_good(spark, store):
    base = store.create()
    for start in range(0, 2500, 500):
        ids = tuple(f"b{i}" for i in range(start, start + 500))
        base = store._commit(Snapshot(base.id, 0.0, "x", {}, base.batches + ids, base.sealed), "append", lambda _: {}, None)
    assert len(base.batches) <= 1000 and len(base.sealed) >= 1
    assert all(store.holds(base, f"b{i}") for i in (0, 777, 1500, 2499)) and not store.holds(base, "b2500")


def test_upsert_moves_a_key_to_another_partition(spark, store):
    store.append(ticks(spark, [1, 2]).unionByName(ticks(spark, [3], 1)))
    store.upsert(ticks(spark, [1, 3], 2))
    assert sorted((r.seq, str(r.day)) for r in store.read().collect()) == [(1, "2026-01-03"), (2, "2026-01-01"), (3, "2026-01-03")]
    store.upsert(ticks(spark, [2], 2))
    assert seqs(store.read()) == [1, 2, 3] and store.partitions().count() == 1


def test_tables_are_made_described_and_dropped(spark, tmp_path):
    r = Registry(f"file://{tmp_path}", spark=spark)
    assert r.tables() == []
    t = Store(spark, r.path("trades"), r.spec("trades"))
    assert not t.exists() and t.create().id == 1 and t.create().id == 1 and r.tables() == ["trades"] and t.read().count() == 0
    assert {x.column for x in t.describe().collect() if x.is_partition} == {"trade_date", "exchange"}
    r.swap("trades", "trades_v2")
    again = Registry(f"file://{tmp_path}", spark=spark)  # another process sees the swap
    assert again.path("trades").endswith("/trades_v2") and again.tables() == []
    r.swap("trades", "trades")
    assert again.tables() == ["trades"]
    t.drop()
    assert again.tables() == []


def test_streams_go_into_and_out_of_the_store(spark, store, tmp_path):
    source = ticks(spark, range(6))
    source.write.parquet(f"{tmp_path}/in")
    stream = R.file_stream(spark, f"{tmp_path}/in", source.schema)
    for _ in range(2):  # the second run finds nothing new
        store.sink(stream, f"{tmp_path}/check").awaitTermination()
    assert seqs(store.read()) == list(range(6))
    store.append(ticks(spark, [9]))
    got = [seqs(rows) for _, rows in store.stream()]
    assert sorted(sum(got, [])) == [0, 1, 2, 3, 4, 5, 9] and [seqs(rows) for s, rows in store.stream(store.ids()[-2])] == [[9]]


def test_bounds_prune_the_manifest(spark, store):
    store.append(ticks(spark, [1]).unionByName(ticks(spark, [2], 1)).unionByName(ticks(spark, [3], 2)))
    df = store.read(between=("2026-01-02", "2026-01-02"))
    assert seqs(df) == [2] and len(df.inputFiles()) == 1


def test_late_data_is_aggregated_again(spark, tmp_path):
    t = ticks(spark, range(0, 300, 10))
    spec = TableSpec("bars", candles(t, "1m").drop("vwap").withColumn("window_date", F.to_date("window_start")).schema, ("window_date",), ("exchange", "symbol"), None, ("exchange", "symbol", "window_start"))
    bars = Store(spark, f"file://{tmp_path}/bars", spec)
    now = F.lit(BASE + timedelta(seconds=290)).cast("timestamp_ntz")
    reaggregate(t, bars, "1m", now=now, minutes=10)
    late = t.unionByName(ticks(spark, [205]))
    reaggregate(late, bars, "1m", now=now, minutes=2)
    want = {r.window_start: r.trade_count for r in candles(late, "1m").collect()}
    assert {r.window_start: r.trade_count for r in bars.read().collect()} == want


def test_metrics_and_the_check_for_new_data(spark, store):
    source, m = ticks(spark, range(5)), Metrics()
    now = F.lit(BASE + timedelta(seconds=100, minutes=5)).cast("timestamp_ntz")
    assert has_new(source, store, "t", ts="ts", seq="seq", now=now)
    offload(source, store, "t", ts="ts", seq="seq", now=now, metrics=m)
    assert not has_new(source, store, "t", ts="ts", seq="seq", now=now)
    with pytest.raises(Exception):
        offload(source.drop("price"), store, "t", ts="ts", seq="seq", now=now, metrics=m)
    text = m.text()
    assert 'rows_total{table="t"} 5' in text and 'loads_total{table="t",kind="failed"} 1' in text and 'seconds_count{table="t"} 1' in text


def test_database_windows(spark, tmp_path, monkeypatch):
    seen = {}

    class Reader:
        def format(self, kind):
            return self

        def option(self, k, v):
            seen[k] = v
            return self

        def options(self, **more):
            return self

        def load(self):
            return "rows"

    class Session:
        read = Reader()

    assert R.jdbc_window(Session(), "jdbc:x", "t", "ts", "seq", "2026-01-01", "2026-01-02", low_seq=7, partition_column="seq", bounds=(0, 100)) == "rows"
    assert seen["dbtable"] == "(SELECT * FROM t WHERE (ts > '2026-01-01' OR (ts = '2026-01-01' AND seq > 7)) AND ts <= '2026-01-02') w" and seen["numPartitions"] == 8
    with pytest.raises(ValueError):
        R.jdbc_window(Session(), "jdbc:x", "t; drop", "ts", "seq", "a", "b")


def test_overwrite_upsert_and_delete_touch_their_partitions_only(spark, store):
    store.append(ticks(spark, range(3)).unionByName(ticks(spark, range(10, 13), 1)))
    store.overwrite_partitions(ticks(spark, [7]))
    assert seqs(store.read()) == [7, 10, 11, 12]
    store.upsert(ticks(spark, [11, 20], 1).withColumn("price", F.lit(Decimal(99))))
    assert {(r.seq, int(r.price)) for r in store.read().collect()} == {(7, 7), (10, 10), (11, 99), (12, 12), (20, 99)}
    assert store.delete_partitions("2026-01-02", dry_run=True) == ["day=2026-01-01"] and 7 in seqs(store.read())
    store.delete_partitions("2026-01-02")
    assert seqs(store.read()) == [10, 11, 12, 20]


def test_compaction_expiry_and_orphans(spark, store):
    for i in range(4):
        store.append(ticks(spark, [i]))
    assert store.compact(dry_run=True) == {"day=2026-01-01": 1} and len(store.snapshot().files) == 4
    store.compact()
    assert len(store.snapshot().files) == 1 and seqs(store.read()) == [0, 1, 2, 3]
    assert seqs(store.read(4)) == [0, 1, 2, 3]
    assert store.expire(time.time() + 1, keep=1) == [1, 2, 3, 4] and seqs(store.read()) == [0, 1, 2, 3]
    ticks(spark, [9]).drop("day").write.parquet(f"{store.root}/data/day=2026-01-09")
    lost = store.orphans(time.time() + 10)
    assert len([p for p in lost if p.endswith(".parquet")]) >= 1
    store.orphans(time.time() + 10, dry_run=False)
    assert not store.orphans(time.time() + 10) and seqs(store.read()) == [0, 1, 2, 3]
    assert maintain(store)["compacted"] == {}
    with pytest.raises(RuntimeError, match="audit"):
        maintain(store, audit=lambda: ["trades: missing_data"])


def test_incremental_loads_lose_and_repeat_nothing(spark, store):
    source = ticks(spark, range(20))
    until = lambda s: F.lit(BASE + timedelta(seconds=s, minutes=5)).cast("timestamp_ntz")
    load = lambda s: offload(source, store, "ticks", ts="ts", seq="seq", now=until(s))
    assert load(9) == 10 and load(9) == 0 and load(19) == 10
    assert seqs(store.read()) == list(range(20))
    mark = Marks(store).get("ticks")
    assert mark.status == "success" and mark.last_seq == 19


def test_marks():
    m = Mark("s").begin(0)
    with pytest.raises(RuntimeError):
        m.begin(60)
    assert m.begin(1801).status == "running"
    assert m.fail("x", 1).failures == 1 and m.fail("x", 1).last_ts is None


def test_layers_stop_after_a_failure():
    def bad():
        raise ValueError("no")

    out = run_layers({"bronze_kraken": bad, "bronze_binance": lambda: 3, "silver_trades": lambda: 1})
    assert out == {"bronze_binance": 3, "bronze_kraken": "failed: no"}
    assert due("5m", 30) and not due("5m", 31) and due("1d", 5)


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("o")).first()["o"]


@pytest.mark.parametrize(("text", "want"), [("BTCUSDT", "BTC/USDT"), ("ETHBTC", "ETH/BTC"), (" btcusd ", "BTC/USD"), ("XYZ", "XYZ"), (None, None)])
def test_joined_symbols(spark, text, want):
    assert one(spark, N.joined_canonical, text) == want


@pytest.mark.parametrize(("text", "want"), [("XBT/USD", "BTC/USD"), ("ETH/XBT", "ETH/BTC"), ("XBT", "BTC")])
def test_slashed_symbols(spark, text, want):
    assert one(spark, N.slashed_canonical, text) == want


@pytest.mark.parametrize(("text", "want"), [("1.5", Decimal("1.5")), ("abc", None), ("-1", None), ("1.123456789", None), ("99999999999", None), (None, None)])
def test_decimals(spark, text, want):
    assert one(spark, N.decimal, text) == want


def test_times(spark):
    assert one(spark, N.seconds_text_micros, "1737118158.321597") == 1737118158321597
    assert one(spark, N.iso_micros, "2026-01-01T00:00:00.123456789Z") == 1767225600123456
    assert one(spark, N.iso_micros, "soon") is None
    assert one(spark, N.epoch_micros, 1767225600123, "long") == 1767225600123000


def test_registry_header(spark):
    good = bytearray(b"\x00\x00\x00\x01\x02abc")
    assert one(spark, N.schema_id, good, "binary") == 258 and one(spark, N.body, good, "binary") == bytearray(b"abc")
    assert one(spark, N.schema_id, bytearray(b"\x01\x00\x00\x01\x02"), "binary") is None and one(spark, N.schema_id, bytearray(b"\x00"), "binary") is None


def test_avro_bodies(spark):
    schema = json.dumps({"type": "record", "name": "t", "fields": [{"name": "s", "type": "string"}, {"name": "n", "type": ["null", "long"]}, {"name": "d", "type": "double"}, {"name": "l", "type": {"type": "array", "items": "int"}}]})
    body = b"\x06abc" + b"\x02\x0b" + b"\x00\x00\x00\x00\x00\x00\xf8\x3f" + b"\x04\x02\x04\x00"
    df = spark.createDataFrame([(1, bytearray(body)), (2, bytearray(body[:5])), (3, None)], "i int, b binary")
    out = {r.i: r.o for r in df.select("i", avro.decode(F.col("b"), schema).alias("o")).collect()}
    assert (out[1].s, out[1].n, out[1].d, out[1].l) == ("abc", -6, 1.5, [1, 2])
    assert out[2] is None or out[2].s is None
    assert out[3] is None


RAW = [
    ("binance", '{"e":"trade","E":1,"s":"BTCUSDT","t":5,"p":"100.5","q":"2","T":1767225600123,"m":true,"M":true}'),
    ("binance", '{"e":"depth","s":"BTCUSDT"}'),
    ("kraken", '[1,[["5541.2","0.15","1534614057.321597","s","l",""],["5541.3","0.25","1534614057.421597","b","m",""]],"trade","XBT/USD"]'),
    ("coinbase", '{"trade_id":"7","product_id":"BTC-USD","price":"1.5","size":"3","time":"2026-01-01T00:00:00.5Z","side":"BUY","sequence_num":9}'),
]


def test_venues_to_silver(spark):
    df = spark.createDataFrame(RAW, "venue string, value string").withColumn("ingestion_timestamp", F.lit(1))
    out = None
    for venue, build in M.VENUES.items():
        own = build(df.filter(F.col("venue") == venue))
        out = own if out is None else out.unionByName(own)
    rows = sorted((r.exchange, r.canonical_symbol, float(r.price), r.side, r.timestamp, r.currency) for r in out.collect())
    assert rows == [("binance", "BTC/USDT", 100.5, "SELL", 1767225600123000, "USDT"), ("coinbase", "BTC/USD", 1.5, "BUY", 1767225600500000, "USD"), ("kraken", "BTC/USD", 5541.2, "SELL", 1534614057321597, "USD"), ("kraken", "BTC/USD", 5541.3, "BUY", 1534614057421597, "USD")]
    assert out.select("message_id").distinct().count() == 4


def test_topics_names_and_formats(spark, tmp_path):
    assert R.topic("crypto", "trades", "Binance") == "market.crypto.trades.binance"
    assert len(R.topics(asset_class="crypto", data_type="trades")) == 3
    with pytest.raises(ValueError):
        R.identifier("t; DROP TABLE x")
    df = spark.createDataFrame([(1, "a")], "i int, s string")
    for kind in ("json", "csv", "parquet"):
        R.write(df, f"{tmp_path}/{kind}", kind, ["i"])
    assert spark.read.parquet(f"{tmp_path}/parquet").columns == ["i"]
    with pytest.raises(ValueError):
        R.write(df, f"{tmp_path}/x", "json", ["nope"])
    assert R.instruments(spark, "binance:\n  - BTCUSDT # main\nkraken:\n  - 'XBT/USD'\n").count() == 2
    (tmp_path / "a.csv").write_text("d,v\n01/02/2026,1\n01/03/2026,2\n")
    assert R.csv_by_date(spark, f"{tmp_path}/a.csv", "d string, v int", "d", ["2026-01-03"]).first().v == 2
    (tmp_path / "a.txt").write_text('{"e":"trade"}\nnot json\n')
    assert R.json_lines(spark, f"{tmp_path}/a.txt", TABLES["bronze"].schema).count() == 2


def test_registry_swaps_aliases():
    r = Registry("/lake")
    assert r.path("trades") == "/lake/trades"
    r.swap("trades", "trades_v2")
    assert r.path("trades") == "/lake/trades_v2" and r.spec("trades").key == ("message_id",)
    with pytest.raises(KeyError):
        r.spec("none")
