"""The registered queries over the supplied tables, and SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import normalize as N
from tidemark.functions.buckets import FRAMES
from tidemark.operators import candles as C
from tidemark.operators import joins as J
from tidemark.operators import quality as Q
from tidemark.operators import queries as P
from tidemark.operators import windows as X
from tidemark.sources import views as V

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

AS_OF = "2024-01-20 00:00:00"
WITH = f"WITH {V.TRADES}, {V.QUOTES}, {V.DAILY} "
DOUBLES = ("open", "high", "low", "close", "volume", "quote_volume", "vwap", "twap")


def register(name: str, sql: str | None = None):
    def keep(query: Query) -> Query:
        _QUERIES[name] = query
        if sql is not None:
            _SQL[name] = WITH + sql
        return query

    return keep


def _rounded(df: DataFrame) -> DataFrame:
    """Money as doubles, rounded half up by the same steps in both engines; times as they are."""
    half_up = lambda c: F.floor(F.col(c).cast("double") * 1e6 + 0.5) / F.lit(1e6)
    return df.select(*(half_up(c).alias(c) if c in DOUBLES else F.col(c) for c in df.columns))


def _half_up(expression: str) -> str:
    return f"floor(({expression}) * 1e6 + 0.5) / 1e6"


def _ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


# --- filters, newest first, paging -------------------------------------------------------------------------------


@register("trades_filter_topk", "SELECT seq, symbol, exchange, CAST(price AS DOUBLE) AS price, CAST(quantity AS DOUBLE) AS quantity, ts, side FROM trades WHERE symbol = 'click' AND exchange = 'BINANCE' AND ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-25' ORDER BY ts DESC, seq DESC LIMIT 1000")
def _(spark, d):
    found = P.trades(V.trades(spark, d), symbols="click", exchanges="BINANCE", start=_ts("2024-01-05 00:00:00"), end=_ts("2024-01-25 00:00:00"), limit=1000)
    return found.select("seq", "symbol", "exchange", F.col("price").cast("double").alias("price"), F.col("quantity").cast("double").alias("quantity"), "ts", "side")


@register("trades_multi_filter", "SELECT symbol, exchange, CAST(price AS DOUBLE) AS price, ts, trade_id FROM trades WHERE symbol IN ('click', 'view') AND exchange IN ('BINANCE', 'KRAKEN') AND price >= 10 AND price <= 200 AND quantity >= 5 ORDER BY ts DESC, seq DESC LIMIT 100 OFFSET 20")
def _(spark, d):
    page = P.trades(V.trades(spark, d), symbols=["click", "view"], exchanges=["BINANCE", "KRAKEN"], min_price=10, max_price=200, min_quantity=5, fields=["symbol", "exchange", "price", "ts", "trade_id"], limit=100, offset=20)
    return page.withColumn("price", F.col("price").cast("double"))


@register("quotes_filter", "SELECT seq, symbol, exchange, ts, CAST(bid_price AS DOUBLE) AS bid_price, CAST(ask_price AS DOUBLE) AS ask_price FROM quotes WHERE symbol IN ('purchase', 'view') AND exchange = 'KRAKEN' ORDER BY ts DESC, seq DESC LIMIT 500")
def _(spark, d):
    found = P.quotes(V.quotes(spark, d), symbols=["purchase", "view"], exchanges=["KRAKEN"], limit=500)
    return found.select("seq", "symbol", "exchange", "ts", F.col("bid_price").cast("double").alias("bid_price"), F.col("ask_price").cast("double").alias("ask_price"))


@register("ohlcv_query", """, t AS (SELECT exchange, symbol, time_bucket(INTERVAL '1 hour', ts) AS window_start, price, ts, seq FROM trades WHERE upper(symbol) = 'VIEW' AND exchange = 'COINBASE')
SELECT exchange, symbol, window_start, CAST(arg_min(price, row(ts, seq)) AS DOUBLE) AS open, CAST(arg_max(price, row(ts, seq)) AS DOUBLE) AS close FROM t WHERE window_start <= TIMESTAMP '2024-01-20' GROUP BY ALL ORDER BY window_start DESC LIMIT 200""")
def _(spark, d):
    found = P.bars(C.candles(V.trades(spark, d), "1h"), "1h", symbol=" view ", exchange="coinbase", end=_ts(AS_OF), limit="200")
    return _rounded(found.select("exchange", "symbol", "window_start", "open", "close"))


@register("replay_page", "SELECT seq, symbol, exchange, ts FROM trades WHERE ts > TIMESTAMP '2024-01-10' OR (ts = TIMESTAMP '2024-01-10' AND seq > 5) ORDER BY ts, seq LIMIT 250")
def _(spark, d):
    return P.page(V.trades(spark, d).select("seq", "symbol", "exchange", "ts"), (_ts("2024-01-10 00:00:00"), 5), 250)


@register("raw_sql", "SELECT exchange, side, count(*) AS n FROM trades WHERE quantity > 50 GROUP BY ALL")
def _(spark, d):
    return spark.sql("SELECT exchange, side, count(*) AS n FROM {t} WHERE quantity > 50 GROUP BY exchange, side", t=V.trades(spark, d))


@register("symbol_patterns", "SELECT symbol, count(*) AS n FROM trades WHERE symbol LIKE 'c%' OR symbol IN ('view') GROUP BY symbol")
def _(spark, d):
    t = V.trades(spark, d)
    return t.filter(F.col("symbol").like("c%") | F.col("symbol").isin("view")).groupBy("symbol").agg(F.count("*").alias("n"))


@register("symbols_distinct", "SELECT DISTINCT symbol FROM trades")
def _(spark, d):
    return P.symbols(V.trades(spark, d))


@register("ts_range", "SELECT min(ts) AS first_ts, max(ts) AS last_ts FROM trades")
def _(spark, d):
    return P.time_range(V.trades(spark, d))


@register("table_stats", "SELECT 'trades' AS name, count(*) AS n FROM trades UNION ALL SELECT 'quotes', count(*) FROM quotes UNION ALL SELECT 'daily', count(*) FROM daily")
def _(spark, d):
    one = lambda name, df: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
    return one("trades", V.trades(spark, d)).unionByName(one("quotes", V.quotes(spark, d))).unionByName(one("daily", V.daily(spark, d)))


@register("replay_stats", "SELECT count(*) AS total, min(ts) AS first_ts, max(ts) AS last_ts, count(DISTINCT symbol) AS symbols, count(DISTINCT exchange) AS exchanges FROM trades")
def _(spark, d):
    return P.replay_stats(V.trades(spark, d))


# --- candles -----------------------------------------------------------------------------------------------------

_BAR_PARTS = [f"{_half_up(x)} AS {n}" if n != "trade_count" else f"{x} AS {n}" for x, n in (
    ("CAST(arg_min(price, row(ts, seq)) AS DOUBLE)", "open"), ("CAST(max(price) AS DOUBLE)", "high"), ("CAST(min(price) AS DOUBLE)", "low"), ("CAST(arg_max(price, row(ts, seq)) AS DOUBLE)", "close"),
    ("CAST(sum(quantity) AS DOUBLE)", "volume"), ("count(*)", "trade_count"), ("CAST(sum(CAST(price * 10000 AS HUGEINT) * CAST(quantity AS HUGEINT)) AS DOUBLE) / 10000.0 / nullif(CAST(sum(quantity) AS DOUBLE), 0)", "vwap"),
)]
_BAR, _BAR_PLAIN = ", ".join(_BAR_PARTS), ", ".join(_BAR_PARTS[:-1])
_BAR_COLUMNS = ("open", "high", "low", "close", "volume", "trade_count", "vwap")


def _bars(name: str, minutes: int) -> None:
    @register(f"ohlcv_{name}", f"SELECT exchange, symbol, time_bucket(INTERVAL '{minutes} minutes', ts, TIMESTAMP '1970-01-01') AS window_start, min(ts) AS open_time, max(ts) AS close_time, {_BAR} FROM trades WHERE quantity > 0 GROUP BY 1, 2, 3")
    def _(spark, d):
        bars = C.candles(V.trades(spark, d).filter("quantity > 0"), name)
        return _rounded(bars.select("exchange", "symbol", "window_start", "open_time", "close_time", *_BAR_COLUMNS))


for _name, _minutes in FRAMES.items():
    _bars(_name, _minutes)


def _rolled(name: str, steps: tuple[str, ...], minutes: int) -> None:
    @register(name, f"SELECT exchange, symbol, time_bucket(INTERVAL '{minutes} minutes', ts, TIMESTAMP '1970-01-01') AS window_start, {_BAR} FROM trades WHERE quantity > 0 GROUP BY 1, 2, 3")
    def _(spark, d):
        bars = C.candles(V.trades(spark, d).filter("quantity > 0"), steps[0])
        for step in steps[1:]:
            bars = C.roll_up(bars, step)
        return _rounded(bars.select("exchange", "symbol", "window_start", *_BAR_COLUMNS))


_rolled("ohlcv_rollup_1m_1h", ("1m", "1h"), 60)
_rolled("ohlcv_rollup_1m_5m_30m", ("1m", "5m", "30m"), 30)
_rolled("ohlcv_rollup_1h_1d", ("1h", "1d"), 1440)


@register("ohlcv_daily_lots", f"SELECT symbol, time_bucket(INTERVAL '1 day', ts, TIMESTAMP '1970-01-01') AS window_start, {_BAR_PLAIN} FROM daily GROUP BY 1, 2")
def _(spark, d):
    return _rounded(C.candles(V.daily(spark, d), "1d").select("symbol", "window_start", *_BAR_COLUMNS[:-1]))


@register("candle_merge", f"SELECT exchange, symbol, time_bucket(INTERVAL '60 minutes', ts, TIMESTAMP '1970-01-01') AS window_start, {_BAR} FROM (SELECT * REPLACE (date_trunc('hour', ts) AS ts) FROM trades WHERE quantity > 0) GROUP BY 1, 2, 3")
def _(spark, d):
    # Times cut to the hour: all trades of a bar are ties, which the sequence settles.
    t = V.trades(spark, d).filter("quantity > 0").withColumn("ts", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    old, new = C.candles(t.filter("seq % 3 <> 0"), "1h"), C.candles(t.filter("seq % 3 = 0"), "1h")
    return _rounded(C.merge_additive(old, new).select("exchange", "symbol", "window_start", *_BAR_COLUMNS))


@register("candle_replace", f"""SELECT exchange, symbol, time_bucket(INTERVAL '1 day', ts) AS window_start, round(CAST(sum(quantity) AS DOUBLE), 6) AS volume, count(*) AS trade_count
FROM trades WHERE quantity > 0 AND (ts < TIMESTAMP '2024-01-15' OR side = 'BUY') GROUP BY 1, 2, 3
UNION ALL SELECT exchange, symbol, w, v, n FROM (SELECT exchange, symbol, time_bucket(INTERVAL '1 day', ts) AS w, round(CAST(sum(quantity) AS DOUBLE), 6) AS v, count(*) AS n, count_if(side = 'BUY') AS b FROM trades WHERE quantity > 0 AND ts >= TIMESTAMP '2024-01-15' GROUP BY 1, 2, 3) WHERE b = 0""")
def _(spark, d):
    t = V.trades(spark, d).filter("quantity > 0")
    new = C.candles(t.filter((F.col("ts") >= _ts("2024-01-15 00:00:00")) & (F.col("side") == "BUY")), "1d")
    return _rounded(C.merge_replace(C.candles(t, "1d"), new).select("exchange", "symbol", "window_start", "volume", "trade_count"))


@register("candle_upsert", """, o AS (SELECT c_custkey AS k, c_acctbal AS v, c_mktsegment AS s FROM customer WHERE c_custkey % 3 <> 0), n AS (SELECT c_custkey AS k, c_acctbal + 1 AS v, CASE WHEN c_custkey % 2 = 0 THEN 'NEW' END AS s FROM customer WHERE c_custkey % 2 = 0)
SELECT coalesce(o.k, n.k) AS k, round(coalesce(n.v, o.v), 6) AS v, coalesce(n.s, o.s) AS s FROM o FULL JOIN n ON o.k = n.k""")
def _(spark, d):
    c = V.table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"), F.col("c_mktsegment").alias("s"))
    new = c.filter("k % 2 = 0").select("k", (F.col("v") + 1).alias("v"), F.lit("NEW").alias("s"))
    return C.upsert(c.filter("k % 3 <> 0"), new, ("k",)).select("k", F.round("v", 6).alias("v"), "s")


@register("candle_invariants", f"""SELECT count(*) AS bars, CAST(count_if(NOT (high >= greatest(open, close, low) AND low <= least(open, close, high))) AS BIGINT) AS price_order,
CAST(count_if(NOT coalesce(vwap BETWEEN low - 1e-5 AND high + 1e-5, false)) AS BIGINT) AS vwap_bounds, CAST(count_if(NOT (volume > 0 AND trade_count > 0)) AS BIGINT) AS positive_volume, CAST(0 AS BIGINT) AS window_order
FROM (SELECT {_BAR} FROM trades GROUP BY exchange, symbol, time_bucket(INTERVAL '5 minutes', ts))""")
def _(spark, d):
    return C.invariants(C.candles(V.trades(spark, d), "5m"))


@register("candle_table_stats", "SELECT count(*) AS bars, count(DISTINCT CAST(w AS DATE)) AS dates, count(DISTINCT symbol) AS symbols, count(DISTINCT exchange) AS exchanges, min(w) AS first_window, max(w) AS last_window FROM (SELECT DISTINCT exchange, symbol, time_bucket(INTERVAL '30 minutes', ts) AS w FROM trades)")
def _(spark, d):
    return C.candles(V.trades(spark, d), "30m").agg(F.count("*").alias("bars"), F.count_distinct(F.to_date("window_start")).alias("dates"), F.count_distinct("symbol").alias("symbols"), F.count_distinct("exchange").alias("exchanges"), F.min("window_start").alias("first_window"), F.max("window_start").alias("last_window"))


# --- aggregations ------------------------------------------------------------------------------------------------


@register("market_summary", f"SELECT symbol, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, {_BAR} FROM trades GROUP BY 1, 2")
def _(spark, d):
    return _rounded(P.summary(V.trades(spark, d)).withColumn("day", F.col("day").cast("string")))


@register("agg_vwap_twap", f"SELECT symbol, time_bucket(INTERVAL '15 minutes', ts) AS bucket, {_BAR}, round(avg(CAST(price AS DOUBLE)), 6) AS twap FROM trades WHERE exchange = 'KRAKEN' GROUP BY 1, 2")
def _(spark, d):
    return _rounded(C.buckets(V.trades(spark, d).filter("exchange = 'KRAKEN'"), "15m", ["open", "high", "low", "close", "volume", "trade_count", "vwap", "twap"]))


@register("summary_from_bars", f"SELECT symbol, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, {_BAR} FROM trades WHERE quantity > 0 GROUP BY 1, 2")
def _(spark, d):
    bars = C.over_venues(C.candles(V.trades(spark, d).filter("quantity > 0"), "1d"))
    return _rounded(bars.select("symbol", F.to_date("window_start").cast("string").alias("day"), *_BAR_COLUMNS))


@register("approx_distinct", "SELECT symbol, true AS near FROM trades GROUP BY symbol")
def _(spark, d):
    t = V.trades(spark, d).groupBy("symbol").agg(F.approx_count_distinct("user_id", 0.02).alias("a"), F.count_distinct("user_id").alias("n"))
    return t.select("symbol", (F.abs(F.col("a") - F.col("n")) <= 0.1 * F.col("n")).alias("near"))


@register("volume_profile", "SELECT symbol, time_bucket(INTERVAL '1 day', ts) AS bucket, floor(CAST(price AS DOUBLE) / 25.0) * 25.0 AS price_level, round(CAST(sum(quantity) AS DOUBLE), 6) AS volume, count(*) AS trade_count FROM trades GROUP BY 1, 2, 3")
def _(spark, d):
    return _rounded(C.volume_profile(V.trades(spark, d), "1d", 25.0))


@register("group_statistics", "SELECT symbol, count(*) AS n, round(CAST(sum(quantity) AS DOUBLE), 6) AS total, round(avg(CAST(price AS DOUBLE)), 6) AS mean, round(CAST(min(price) AS DOUBLE), 6) AS least, round(CAST(max(price) AS DOUBLE), 6) AS most FROM daily GROUP BY symbol ORDER BY n DESC, symbol LIMIT 100")
def _(spark, d):
    price = F.col("price").cast("double")
    return V.daily(spark, d).groupBy("symbol").agg(F.count("*").alias("n"), F.round(F.sum("quantity").cast("double"), 6).alias("total"), F.round(F.avg(price), 6).alias("mean"), F.round(F.min(price), 6).alias("least"), F.round(F.max(price), 6).alias("most")).orderBy(F.desc("n"), "symbol").limit(100)


@register("having_active", "SELECT * FROM (SELECT exchange, symbol, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS trade_count FROM trades GROUP BY 1, 2, 3) WHERE trade_count > 20")
def _(spark, d):
    return V.trades(spark, d).groupBy("exchange", "symbol", F.to_date("ts").cast("string").alias("day")).agg(F.count("*").alias("trade_count")).filter("trade_count > 20")


@register("latest_version_dedup", "SELECT user_id, symbol, seq, CAST(price AS DOUBLE) AS price FROM (SELECT *, row_number() OVER (PARTITION BY user_id, symbol ORDER BY ts DESC, seq DESC) AS n FROM trades) WHERE n = 1")
def _(spark, d):
    t = V.trades(spark, d).select("user_id", "symbol", "ts", "seq", F.col("price").cast("double").alias("price"))
    return P.latest_version(t, ["user_id", "symbol"], ["ts", "seq"]).drop("ts")


@register("duplicates_having", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def _(spark, d):
    return P.repeated(V.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("venue_statistics", "SELECT exchange, count(*) AS n, count(DISTINCT symbol) AS symbols, round(avg(CAST(price AS DOUBLE)), 6) AS mean, round(stddev_samp(CAST(price AS DOUBLE)), 6) AS deviation, round(sum(CAST(price AS DOUBLE) * CAST(quantity AS DOUBLE)), 4) AS notional FROM trades GROUP BY exchange")
def _(spark, d):
    price, quantity = F.col("price").cast("double"), F.col("quantity").cast("double")
    return V.trades(spark, d).groupBy("exchange").agg(F.count("*").alias("n"), F.count_distinct("symbol").alias("symbols"), F.round(F.avg(price), 6).alias("mean"), F.round(F.stddev_samp(price), 6).alias("deviation"), F.round(F.sum(price * quantity), 4).alias("notional"))


@register("venue_bars", "SELECT exchange, count(*) AS bars, round(avg(n), 6) AS mean_trades, max(n) AS most_trades, min(n) AS least_trades, round(avg((h - l) / nullif(o, 0) * 100), 6) AS mean_range FROM (SELECT exchange, symbol, time_bucket(INTERVAL '5 minutes', ts) AS w, count(*) AS n, CAST(max(price) AS DOUBLE) AS h, CAST(min(price) AS DOUBLE) AS l, CAST(arg_min(price, row(ts, seq)) AS DOUBLE) AS o FROM trades GROUP BY 1, 2, 3) GROUP BY exchange")
def _(spark, d):
    bars = C.candles(V.trades(spark, d), "5m").withColumns({c: F.col(c).cast("double") for c in ("open", "high", "low")})
    return bars.groupBy("exchange").agg(F.count("*").alias("bars"), F.round(F.avg("trade_count"), 6).alias("mean_trades"), F.max("trade_count").alias("most_trades"), F.min("trade_count").alias("least_trades"), F.round(F.avg((F.col("high") - F.col("low")) / F.nullif(F.col("open"), F.lit(0.0)) * 100), 6).alias("mean_range"))


@register("range_and_bands", "SELECT symbol, round((h - l) / o * 100, 2) AS range_pct, round(m - s, 6) AS band_low, round(m + s, 6) AS band_high FROM (SELECT symbol, CAST(max(price) AS DOUBLE) AS h, CAST(min(price) AS DOUBLE) AS l, CAST(arg_min(price, row(ts, seq)) AS DOUBLE) AS o, avg(CAST(price AS DOUBLE)) AS m, stddev_samp(CAST(price AS DOUBLE)) AS s FROM trades GROUP BY symbol)")
def _(spark, d):
    price = F.col("price").cast("double")
    s = V.trades(spark, d).groupBy("symbol").agg(F.max(price).alias("h"), F.min(price).alias("l"), F.min_by(price, F.struct("ts", "seq")).alias("o"), F.avg(price).alias("m"), F.stddev_samp(price).alias("s"))
    return s.select("symbol", F.round((F.col("h") - F.col("l")) / F.col("o") * 100, 2).alias("range_pct"), F.round(F.col("m") - F.col("s"), 6).alias("band_low"), F.round(F.col("m") + F.col("s"), 6).alias("band_high"))


@register("volume_30s", "SELECT symbol, time_bucket(INTERVAL '30 seconds', ts) AS bucket, round(CAST(sum(quantity) AS DOUBLE), 6) AS volume FROM trades GROUP BY 1, 2")
def _(spark, d):
    return _rounded(V.trades(spark, d).groupBy("symbol", F.window("ts", "30 seconds")["start"].alias("bucket")).agg(F.sum("quantity").alias("volume")))


@register("hourly_partition_counts", "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(hour(ts) AS INTEGER) AS hour, exchange, count(*) AS n FROM trades GROUP BY 1, 2, 3")
def _(spark, d):
    return V.trades(spark, d).groupBy(F.to_date("ts").cast("string").alias("day"), F.hour("ts").alias("hour"), "exchange").agg(F.count("*").alias("n"))


@register("minute_bars", "SELECT symbol, date_trunc('minute', ts) AS minute, count(*) AS n, round(CAST(max(price) AS DOUBLE), 6) AS high FROM trades GROUP BY 1, 2")
def _(spark, d):
    return _rounded(V.trades(spark, d).groupBy("symbol", F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("minute")).agg(F.count("*").alias("n"), F.max("price").alias("high")))


@register("trade_rate", "SELECT exchange, count(*) AS n, round(count(*) / CAST(date_diff('second', date_trunc('second', min(ts)), date_trunc('second', max(ts))) AS DOUBLE), 6) AS per_second FROM trades GROUP BY exchange")
def _(spark, d):
    second = F.unix_seconds(F.col("ts").cast("timestamp"))
    return V.trades(spark, d).groupBy("exchange").agg(F.count("*").alias("n"), F.round(F.count("*") / (F.max(second) - F.min(second)).cast("double"), 6).alias("per_second"))


@register("latency_quantiles", "SELECT exchange, round(avg(ms), 6) AS mean_ms, round(quantile_cont(ms, 0.5), 6) AS p50, round(quantile_cont(ms, 0.95), 6) AS p95, round(quantile_cont(ms, 0.99), 6) AS p99 FROM (SELECT exchange, CAST((seq * 7919) % 1000 AS DOUBLE) AS ms FROM trades) GROUP BY exchange")
def _(spark, d):
    event = N.micros(F.col("ts"))
    ms = N.latency_ms(event, event + (F.col("seq") * 7919) % 1000 * 1000).cast("double")
    # Equal latencies are counted first, so a venue's task holds each once.
    counted = V.trades(spark, d).select("exchange", ms.alias("ms")).groupBy("exchange", "ms").agg(F.count("*").alias("n"))
    quantiles = (F.round(F.expr(f"percentile(ms, {q}, n)"), 6).alias(a) for q, a in ((0.5, "p50"), (0.95, "p95"), (0.99, "p99")))
    return counted.groupBy("exchange").agg(F.round(F.sum(F.col("ms") * F.col("n")) / F.sum("n"), 6).alias("mean_ms"), *quantiles)


@register("ingest_verification", "SELECT symbol, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts, min(length(trade_id)) AS shortest, max(length(trade_id)) AS longest FROM trades GROUP BY symbol")
def _(spark, d):
    return V.trades(spark, d).groupBy("symbol").agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.min(F.length("trade_id")).cast("long").alias("shortest"), F.max(F.length("trade_id")).cast("long").alias("longest"))


@register("cube_rollup", "SELECT exchange, symbol, CAST(grouping(exchange) * 2 + grouping(symbol) AS BIGINT) AS level, count(*) AS n FROM trades GROUP BY CUBE (exchange, symbol)")
def _(spark, d):
    return V.trades(spark, d).cube("exchange", "symbol").agg(F.grouping_id().alias("level"), F.count("*").alias("n"))


@register("grouping_sets", "SELECT exchange, side, count(*) AS n FROM trades GROUP BY GROUPING SETS ((exchange), (side), ())")
def _(spark, d):
    return V.trades(spark, d).groupingSets([["exchange"], ["side"], []], "exchange", "side").agg(F.count("*").alias("n"))


# --- windows -----------------------------------------------------------------------------------------------------


@register("moving_avg_10", "SELECT seq, symbol, round(avg(CAST(price AS DOUBLE)) OVER (PARTITION BY symbol ORDER BY ts, seq ROWS BETWEEN 10 PRECEDING AND CURRENT ROW), 6) AS moving_avg FROM trades")
def _(spark, d):
    t = V.trades(spark, d).select("seq", "symbol", "ts", F.col("price").cast("double").alias("price"))
    return X.over_preceding(t, 10, {"mean": F.avg("price")}, keys=["symbol"], order=["ts", "seq"]).select("seq", "symbol", F.round("mean", 6).alias("moving_avg"))


@register("range_frame", "SELECT seq, symbol, count(*) OVER (PARTITION BY symbol ORDER BY ts RANGE BETWEEN INTERVAL '10 minutes' PRECEDING AND CURRENT ROW) AS recent FROM trades")
def _(spark, d):
    t = V.trades(spark, d).select("seq", "symbol", "ts")
    return X.over_range(t, 600, {"recent": F.count("*")}, keys=["symbol"]).select("seq", "symbol", "recent")


@register("sliding_volume", "SELECT symbol, w AS window_start, round(CAST(sum(quantity) AS DOUBLE), 6) AS volume FROM (SELECT symbol, quantity, unnest([time_bucket(INTERVAL '30 minutes', ts), time_bucket(INTERVAL '30 minutes', ts) - INTERVAL '30 minutes']) AS w FROM trades) GROUP BY 1, 2")
def _(spark, d):
    return _rounded(V.trades(spark, d).groupBy("symbol", F.window("ts", "1 hour", "30 minutes")["start"].alias("window_start")).agg(F.sum("quantity").alias("volume")))


@register("sessions", "SELECT user_id, min(ts) AS session_start, count(*) AS n FROM (SELECT user_id, ts, sum(g) OVER (PARTITION BY user_id ORDER BY ts, seq) AS s FROM (SELECT user_id, ts, seq, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts, seq) + INTERVAL '2 hours' THEN 0 ELSE 1 END AS g FROM trades)) GROUP BY user_id, s")
def _(spark, d):
    return V.trades(spark, d).groupBy("user_id", F.session_window("ts", "2 hours").alias("w")).agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("session_start"), "n")


@register("ranked_symbols", "SELECT exchange, symbol, n, rank() OVER (PARTITION BY exchange ORDER BY n DESC) AS place, dense_rank() OVER (PARTITION BY exchange ORDER BY n DESC) AS dense_place, ntile(2) OVER (PARTITION BY exchange ORDER BY n DESC, symbol) AS half FROM (SELECT exchange, symbol, count(*) AS n FROM trades GROUP BY 1, 2)")
def _(spark, d):
    n = V.trades(spark, d).groupBy("exchange", "symbol").agg(F.count("*").alias("n"))
    w = Window.partitionBy("exchange").orderBy(F.desc("n"))
    return n.select("exchange", "symbol", "n", F.rank().over(w).cast("long").alias("place"), F.dense_rank().over(w).cast("long").alias("dense_place"), F.ntile(2).over(Window.partitionBy("exchange").orderBy(F.desc("n"), "symbol")).cast("long").alias("half"))


@register("seq_gaps", "SELECT exchange, symbol, seq + 1 AS gap_start, n - 1 AS gap_end, n - seq - 1 AS missing FROM (SELECT exchange, symbol, seq, lead(seq) OVER (PARTITION BY exchange, symbol ORDER BY seq) AS n FROM trades) WHERE n - seq > 1")
def _(spark, d):
    return Q.gaps(V.trades(spark, d), "seq", ("exchange", "symbol"))


@register("missing_sequences", "SELECT g AS seq FROM (SELECT unnest(range(lo, hi + 1)) AS g FROM (SELECT min(seq) AS lo, max(seq) AS hi FROM trades WHERE exchange = 'KRAKEN')) EXCEPT SELECT seq FROM trades WHERE exchange = 'KRAKEN'")
def _(spark, d):
    own = V.trades(spark, d).filter("exchange = 'KRAKEN'").select("seq")
    # Gaps between neighbours, opened up: no list of all numbers is made.
    return Q.gaps(own, "seq").select(F.explode(F.sequence("gap_start", "gap_end")).alias("seq"))


@register("seq_events", """, s AS (SELECT exchange, symbol, ts, CASE WHEN seq % 97 = 0 THEN seq // 3 WHEN seq % 89 = 0 THEN seq - 20 ELSE seq END AS q, seq FROM trades),
r AS (SELECT *, CASE WHEN q < lag(q) OVER (PARTITION BY exchange, symbol ORDER BY ts, seq) * 0.5 THEN 1 ELSE 0 END AS z FROM s),
p AS (SELECT *, sum(z) OVER (PARTITION BY exchange, symbol ORDER BY ts, seq) AS part FROM r),
h AS (SELECT *, max(q) OVER (PARTITION BY exchange, symbol, part ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high FROM p)
SELECT exchange, symbol, CASE WHEN z = 1 THEN 'RESET' WHEN high IS NULL THEN 'FIRST' WHEN q <= high THEN 'OUT_OF_ORDER' WHEN q - high - 1 = 0 THEN 'OK' WHEN q - high - 1 <= 10 THEN 'SMALL_GAP' ELSE 'LARGE_GAP' END AS event, count(*) AS n FROM h GROUP BY 1, 2, 3""")
def _(spark, d):
    seq = F.col("seq")
    q = F.when(seq % 97 == 0, F.expr("seq div 3")).when(seq % 89 == 0, seq - 20).otherwise(seq)
    return Q.sequence_events(V.trades(spark, d).withColumn("q", q), seq="q", order=["ts", "seq"]).groupBy("exchange", "symbol", "event").agg(F.count("*").alias("n"))


@register("price_jumps", "SELECT seq, symbol, round(j, 6) AS jump FROM (SELECT seq, symbol, abs(CAST(price AS DOUBLE) - b) / nullif(b, 0) AS j FROM (SELECT *, CAST(lag(price) OVER (PARTITION BY symbol ORDER BY ts, seq) AS DOUBLE) AS b FROM trades)) WHERE j > 0.5")
def _(spark, d):
    return Q.jumps(V.trades(spark, d), 0.5).select("seq", "symbol", F.round("jump", 6).alias("jump"))


# --- joins and sets ----------------------------------------------------------------------------------------------


@register("trade_quote_join", "SELECT t.seq, t.symbol, CAST(t.price AS DOUBLE) AS price, CAST(q.bid_price AS DOUBLE) AS bid_price, CAST(q.ask_price AS DOUBLE) AS ask_price FROM trades t LEFT JOIN (SELECT * FROM quotes WHERE exchange = 'KRAKEN') q ON t.symbol = q.symbol AND t.ts = q.ts")
def _(spark, d):
    q = V.quotes(spark, d).filter("exchange = 'KRAKEN'").select("symbol", "ts", "bid_price", "ask_price")
    return J.exact(V.trades(spark, d), q, ["symbol", "ts"]).select("seq", "symbol", *(F.col(c).cast("double").alias(c) for c in ("price", "bid_price", "ask_price")))


@register("asof_join", "SELECT t.seq, t.symbol, CAST(q.bid_price AS DOUBLE) AS bid_price FROM (SELECT * FROM trades WHERE exchange = 'BINANCE') t ASOF LEFT JOIN (SELECT * FROM quotes WHERE exchange = 'KRAKEN') q ON t.symbol = q.symbol AND t.ts >= q.ts")
def _(spark, d):
    t, q = V.trades(spark, d).filter("exchange = 'BINANCE'"), V.quotes(spark, d).filter("exchange = 'KRAKEN'")
    return J.as_of(t, q, keys=["symbol"], columns=["bid_price"]).select("seq", "symbol", F.col("bid_price").cast("double").alias("bid_price"))


@register("interval_join", "SELECT t.seq, q.seq AS quote_seq FROM trades t JOIN quotes q ON t.symbol = q.symbol AND q.ts <= t.ts AND q.ts >= t.ts - INTERVAL '300 seconds' WHERE t.exchange = 'BINANCE' AND q.exchange = 'KRAKEN'")
def _(spark, d):
    t, q = V.trades(spark, d).filter("exchange = 'BINANCE'"), V.quotes(spark, d).filter("exchange = 'KRAKEN'").withColumnRenamed("seq", "quote_seq")
    return J.interval(t.select("seq", "symbol", "ts"), q, keys=["symbol"], seconds=300, columns=["quote_seq"]).select("seq", "quote_seq")


@register("spread_matrix", """, m AS (SELECT symbol, time_bucket(INTERVAL '1 hour', ts) AS bucket, avg(CAST(price AS DOUBLE)) FILTER (exchange = 'BINANCE') AS b, avg(CAST(price AS DOUBLE)) FILTER (exchange = 'KRAKEN') AS k, avg(CAST(price AS DOUBLE)) FILTER (exchange = 'COINBASE') AS c FROM trades GROUP BY 1, 2)
SELECT symbol, bucket, round(abs(b - k), 6) AS binance_kraken, round(abs(b - c), 6) AS binance_coinbase, round(abs(k - c), 6) AS kraken_coinbase FROM m""")
def _(spark, d):
    t = V.trades(spark, d).withColumn("price", F.col("price").cast("double"))
    return J.spreads(t, "1 hour", ["BINANCE", "KRAKEN", "COINBASE"])


@register("reference_join", "SELECT n_name, r_name, count(*) AS suppliers, round(sum(s_acctbal), 4) AS balance FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2")
def _(spark, d):
    s, n, r = (V.table(spark, d, t) for t in ("supplier", "nation", "region"))
    return s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).groupBy("n_name", "r_name").agg(F.count("*").alias("suppliers"), F.round(F.sum("s_acctbal"), 4).alias("balance"))


@register("anti_join_seed", "SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)")
def _(spark, d):
    c, o = V.table(spark, d, "customer"), V.table(spark, d, "orders")
    return c.join(o, c.c_custkey == o.o_custkey, "left_anti").select("c_custkey")


@register("semi_join", "SELECT c_custkey FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 100000)")
def _(spark, d):
    c, o = V.table(spark, d, "customer"), V.table(spark, d, "orders").filter("o_totalprice > 100000")
    return c.join(o, c.c_custkey == o.o_custkey, "left_semi").select("c_custkey")


@register("hybrid_union_dedup", f"""SELECT trade_id, seq, ts, leg FROM (SELECT trade_id, seq, ts, CASE WHEN ts <= TIMESTAMP '{AS_OF}' - INTERVAL '2 minutes' THEN 'lake' ELSE 'tail' END AS leg FROM trades WHERE ts >= TIMESTAMP '2024-01-19' AND ts <= TIMESTAMP '{AS_OF}' ORDER BY ts DESC, seq DESC LIMIT 400)""")
def _(spark, d):
    t = V.trades(spark, d).select("trade_id", "seq", "ts")
    lake, tail = t.withColumn("leg", F.lit("lake")), t.filter(F.col("ts") >= _ts("2024-01-19 20:00:00")).withColumn("leg", F.lit("tail"))
    as_of = _ts(AS_OF)
    return P.hybrid(lake, tail, as_of=as_of, start=_ts("2024-01-19 00:00:00"), end=as_of, limit=400, key="trade_id")


@register("not_in_nulls", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT CASE WHEN o_totalprice > 150000 THEN o_custkey END FROM orders WHERE o_totalprice > 150000)")
def _(spark, d):
    o = V.table(spark, d, "orders").filter("o_totalprice > 150000").select(F.when(F.col("o_totalprice") > 150000, F.col("o_custkey")).alias("k"))
    return P.not_in(V.table(spark, d, "customer"), "c_custkey", o, "k").select("c_custkey")


@register("range_join", "SELECT c_custkey, n_nationkey FROM customer JOIN nation ON c_acctbal BETWEEN n_nationkey * 400.0 - 1000 AND n_nationkey * 400.0 - 100")
def _(spark, d):
    bands = V.table(spark, d, "nation").select("n_nationkey", (F.col("n_nationkey") * 400.0 - 1000).alias("low"), (F.col("n_nationkey") * 400.0 - 100).alias("high"))
    c = V.table(spark, d, "customer").select("c_custkey", F.col("c_acctbal").cast("double").alias("v"))
    return J.ranged(c, bands, keys=[], value="v", low="low", high="high", width=500.0, columns=["n_nationkey"]).select("c_custkey", "n_nationkey")


@register("setop_intersect", "SELECT user_id FROM trades WHERE exchange = 'BINANCE' AND symbol = 'click' INTERSECT SELECT user_id FROM trades WHERE symbol = 'purchase'")
def _(spark, d):
    t = V.trades(spark, d)
    return t.filter("exchange = 'BINANCE' and symbol = 'click'").select("user_id").intersect(t.filter("symbol = 'purchase'").select("user_id"))


@register("setop_except", "SELECT user_id FROM trades EXCEPT SELECT user_id FROM trades WHERE symbol = 'purchase' AND price > 50")
def _(spark, d):
    t = V.trades(spark, d)
    return t.select("user_id").subtract(t.filter("symbol = 'purchase' and price > 50").select("user_id"))


@register("venue_union", "SELECT symbol, venue, count(*) AS n FROM (SELECT symbol, 'A' AS venue FROM trades WHERE exchange = 'BINANCE' UNION ALL SELECT symbol, 'B' FROM trades WHERE exchange = 'KRAKEN') GROUP BY 1, 2")
def _(spark, d):
    t = V.trades(spark, d)
    legs = [t.filter(F.col("exchange") == e).select(F.lit(v).alias("venue"), "symbol") for e, v in (("BINANCE", "A"), ("KRAKEN", "B"))]
    return legs[0].unionByName(legs[1]).groupBy("symbol", "venue").agg(F.count("*").alias("n"))


# --- validation, normalisation -----------------------------------------------------------------------------------

_RAW = """, raw AS (SELECT trade_id AS message_id, CASE WHEN seq % 50 = 0 THEN NULL WHEN seq % 53 = 0 THEN '' ELSE symbol END AS symbol, CASE WHEN seq % 31 = 0 THEN NULL WHEN seq % 37 = 0 THEN -price ELSE price END AS price, quantity,
CASE WHEN seq % 41 = 0 THEN 'HOLD' ELSE side END AS side, CASE WHEN seq % 43 = 0 THEN NULL ELSE epoch_us(ts) END AS timestamp, CASE WHEN seq % 47 = 0 THEN 'equities' ELSE 'crypto' END AS asset_class FROM trades)"""
_WRONG = (
    ("price_is_null", "price IS NULL"), ("price_must_be_positive", "price <= 0"), ("quantity_is_null", "quantity IS NULL"), ("quantity_must_be_positive", "quantity <= 0"), ("symbol_required", "symbol IS NULL"),
    ("invalid_side", "side NOT IN ('BUY', 'SELL')"), ("timestamp_in_future", "timestamp >= as_of"), ("timestamp_too_old", "timestamp <= as_of - 31536000000000"), ("message_id_required", "message_id IS NULL"),
    ("invalid_asset_class", "asset_class <> 'crypto'"), ("deserialization_failed_or_null_fields", "side IS NULL OR timestamp IS NULL OR asset_class IS NULL"),
)


def _reason(as_of: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN '{n}'" for n, c in _WRONG).replace("as_of", f"epoch_us(TIMESTAMP '{as_of}')") + " ELSE 'none' END"


_REASON = _reason("2024-01-25")
_KIND = "CASE WHEN r = 'none' THEN 'valid' " + " ".join(f"WHEN contains(r, '{k}') THEN '{k}_validation'" for k in ("price", "quantity", "timestamp", "symbol", "side", "message_id", "asset_class")) + " ELSE 'unknown_error' END"


def _raw(spark, d):
    t, seq = V.trades(spark, d), F.col("seq")
    every = lambda n: seq % n == 0
    return t.select(F.col("trade_id").alias("message_id"), F.when(every(50), None).when(every(53), "").otherwise(F.col("symbol")).alias("symbol"), F.when(every(31), None).when(every(37), -F.col("price")).otherwise(F.col("price")).alias("price"), "quantity", F.when(every(41), "HOLD").otherwise(F.col("side")).alias("side"), F.when(every(43), None).otherwise(N.micros(F.col("ts"))).alias("timestamp"), F.when(every(47), "equities").otherwise("crypto").alias("asset_class"))


def _as_of():
    return N.micros(_ts("2024-01-25 00:00:00"))


@register("dlq_reasons", f"{_RAW} SELECT {_KIND} AS error_type, r AS error_reason, count(*) AS n FROM (SELECT {_REASON} AS r FROM raw) GROUP BY 1, 2")
def _(spark, d):
    return Q.metrics(_raw(spark, d), _as_of())


@register("validate_split_counts", f"{_RAW} SELECT CAST(count_if(r = 'none') AS BIGINT) AS valid, CAST(count_if(r <> 'none') AS BIGINT) AS invalid FROM (SELECT {_REASON} AS r FROM raw)")
def _(spark, d):
    valid, dead = Q.split(_raw(spark, d), _as_of())
    return valid.agg(F.count("*").alias("valid")).join(dead.agg(F.count("*").alias("invalid")))


@register("validation_errors", f"{_RAW} SELECT message_id, concat_ws(',', " + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in _WRONG).replace("as_of", "epoch_us(TIMESTAMP '2024-01-25')") + f") AS errors FROM raw WHERE ({_REASON}) <> 'none'")
def _(spark, d):
    return Q.split(_raw(spark, d), _as_of())[1].select("message_id", F.concat_ws(",", "errors").alias("errors"))


@register("stored_flags", f"{_RAW} SELECT message_id, coalesce(price > 0, false) AND coalesce(quantity > 0, false) AND coalesce(CAST(price AS DOUBLE) * CAST(quantity AS DOUBLE) > 0, false) AS is_valid, concat_ws(',', CASE WHEN NOT coalesce(price > 0, false) THEN 'invalid_price' END, CASE WHEN NOT coalesce(quantity > 0, false) THEN 'invalid_quantity' END, CASE WHEN NOT coalesce(CAST(price AS DOUBLE) * CAST(quantity AS DOUBLE) > 0, false) THEN 'invalid_quote_volume' END) AS validation_errors FROM raw")
def _(spark, d):
    found = Q.flagged(_raw(spark, d).withColumn("quote_volume", N.quote_volume(F.col("price"), F.col("quantity"))))
    return found.select("message_id", "is_valid", F.concat_ws(",", "validation_errors").alias("validation_errors"))


@register("null_profile", f"{_RAW} SELECT count(*) AS total, CAST(count_if(symbol IS NULL) AS BIGINT) AS symbol_nulls, CAST(count_if(price IS NULL) AS BIGINT) AS price_nulls, CAST(count_if(timestamp IS NULL) AS BIGINT) AS timestamp_nulls FROM raw")
def _(spark, d):
    return Q.null_profile(_raw(spark, d), ["symbol", "price", "timestamp"])


@register("json_extract", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, json_extract_string(props, '$.missing') AS missing FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL")
def _(spark, d):
    e = V.table(spark, d, "events").withColumn("p", F.from_json("props", "k int, missing string"))
    return e.select("event_id", F.col("p.k").alias("k"), F.col("p.missing").alias("missing")).filter("k is not null")


_PAIRS = "SELECT n_nationkey AS k, list_extract(['BTCUSDT','ETHBTC','SOLUSDC','DOGEUSD','XRPEUR','ADAXYZ','btcbusd'], n_nationkey % 7 + 1) AS s, list_extract(['XBT/USD','ETH/XBT','XDG/EUR','XBT'], n_nationkey % 4 + 1) AS p, list_extract(['BTC-USD','ETH-EUR'], n_nationkey % 2 + 1) AS c FROM nation"
_ENDS = "|".join(N.QUOTES)


@register("normalize_symbol", f""", v AS ({_PAIRS}), x AS (SELECT *, upper(trim(s)) AS u, regexp_extract(upper(trim(s)), '^(.+?)({_ENDS})$', 2) AS q FROM v)
SELECT k, regexp_replace(u, '^(.+?)({_ENDS})$', '\\1/\\2') AS joined, CASE WHEN q <> '' THEN regexp_extract(u, '^(.+?)({_ENDS})$', 1) ELSE u[:-5] END AS base, CASE WHEN q <> '' THEN q ELSE right(u, 4) END AS quote,
replace(replace(p, 'XBT', 'BTC'), 'XDG', 'DOGE') AS slashed, replace(c, '-', '/') AS dashed, CASE WHEN contains(p, '/') THEN replace(split_part(p, '/', 2), 'XBT', 'BTC') ELSE 'USD' END AS currency FROM x""")
def _(spark, d):
    key = F.col("n_nationkey")
    pick = lambda n, *names: F.element_at(F.array(*map(F.lit, names)), key % n + 1)
    v = V.table(spark, d, "nation").select(key.alias("k"), pick(7, "BTCUSDT", "ETHBTC", "SOLUSDC", "DOGEUSD", "XRPEUR", "ADAXYZ", "btcbusd").alias("s"), pick(4, "XBT/USD", "ETH/XBT", "XDG/EUR", "XBT").alias("p"), pick(2, "BTC-USD", "ETH-EUR").alias("c"))
    base, quote = N.split_symbol(F.col("s"))
    slashed = N.slashed_canonical(F.col("p"))
    return v.select("k", N.joined_canonical(F.col("s")).alias("joined"), base.alias("base"), quote.alias("quote"), slashed.alias("slashed"), N.dashed_canonical(F.col("c")).alias("dashed"), N.currency(slashed, "USD").alias("currency"))


@register("normalize_suffix", f"""SELECT k, CASE WHEN s LIKE '%USDT' THEN 'USDT' WHEN s LIKE '%USD' THEN 'USD' WHEN s LIKE '%BTC' THEN 'BTC' WHEN s LIKE '%ETH' THEN 'ETH' ELSE right(s, 4) END AS currency, s[:-5] || '/USDT' AS fixed FROM ({_PAIRS})""")
def _(spark, d):
    key = F.col("n_nationkey")
    names = F.array(*map(F.lit, ("BTCUSDT", "ETHBTC", "SOLUSDC", "DOGEUSD", "XRPEUR", "ADAXYZ", "btcbusd")))
    v = V.table(spark, d, "nation").select(key.alias("k"), F.element_at(names, key % 7 + 1).alias("s"))
    return v.select("k", N.suffix_currency(F.col("s")).alias("currency"), N.fixed_canonical(F.col("s"), "USDT").alias("fixed"))


@register("message_ids", "SELECT event_id, sha256(concat_ws('|', event_type, CAST(event_id AS VARCHAR), coalesce(CASE WHEN user_id % 2 = 0 THEN event_type END, ''))) AS id FROM events")
def _(spark, d):
    e = V.table(spark, d, "events")
    return e.select("event_id", N.message_id(F.col("event_type"), F.col("event_id"), F.when(F.col("user_id") % 2 == 0, F.col("event_type"))).alias("id"))


@register("normalize_times", "SELECT event_id, epoch_us(ts) AS us, CAST(CAST(CAST(epoch_us(ts) / 1000000.0 AS DECIMAL(20,6)) AS DECIMAL(30,6)) * 1000000 AS BIGINT) AS from_seconds, (epoch_us(ts) // 1000) * 1000 AS from_millis FROM events")
def _(spark, d):
    us = N.micros(F.col("ts"))
    text = (us.cast("decimal(20,0)") / 1_000_000).cast("decimal(20,6)").cast("string")
    return V.table(spark, d, "events").select("event_id", us.alias("us"), N.seconds_text_micros(text).alias("from_seconds"), N.epoch_micros(F.expr("unix_micros(cast(ts as timestamp)) div 1000")).alias("from_millis"))


@register("normalize_sides", "SELECT event_id, CASE WHEN user_id % 2 = 0 THEN 'SELL' ELSE 'BUY' END AS maker_side, CASE user_id % 4 WHEN 0 THEN 'BUY' WHEN 1 THEN 'SELL' WHEN 2 THEN 'SELL' ELSE 'UNKNOWN' END AS side, CASE user_id % 3 WHEN 0 THEN 'limit' WHEN 1 THEN 'market' ELSE '' END AS order_type FROM events")
def _(spark, d):
    u = F.col("user_id")
    pick = lambda n, *names: F.element_at(F.array(*map(F.lit, names)), (u % n + 1).cast("int"))
    return V.table(spark, d, "events").select("event_id", N.maker_side(u % 2 == 0).alias("maker_side"), N.side(pick(4, "b", "S", "sell", "?")).alias("side"), F.concat_ws(",", N.order_type(pick(3, "l", "m", "x"))).alias("order_type"))


@register("decimal_guard", "SELECT event_id, round(CAST(CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 THEN NULL ELSE price END AS DOUBLE), 6) AS price FROM (SELECT event_id, CAST(value AS DECIMAL(18,8)) AS price FROM events)")
def _(spark, d):
    e = V.table(spark, d, "events").withColumn("p", F.col("value").cast("decimal(18,8)").cast("string"))
    text = F.when(F.col("event_id") % 3 == 0, F.lit("abc")).when(F.col("event_id") % 3 == 1, F.lit("-1.5")).otherwise(F.col("p"))
    return e.select("event_id", F.round(N.decimal(text).cast("double"), 6).alias("price"))


@register("load_shedding", "SELECT symbol, count(*) AS n FROM trades WHERE symbol IN ('click', 'purchase') GROUP BY symbol")
def _(spark, d):
    from tidemark.plans.control import shed

    return shed(V.trades(spark, d), {"click": 1, "purchase": 1, "view": 2}, level=3).groupBy("symbol").agg(F.count("*").alias("n"))


# --- stores and offload ------------------------------------------------------------------------------------------


@register("audit_status", """, s AS (SELECT exchange, symbol, count(*) AS source_rows FROM trades GROUP BY 1, 2), t AS (SELECT exchange, symbol, count(*) AS target_rows FROM trades WHERE NOT (symbol = 'click' AND seq % 9 = 0) AND NOT (symbol = 'view' AND seq % 40 = 0) GROUP BY 1, 2)
SELECT exchange, symbol, source_rows, target_rows, target_rows - source_rows AS delta, round(abs(target_rows - source_rows) * 100.0 / source_rows, 6) AS delta_pct, CASE WHEN abs(target_rows - source_rows) * 100.0 / source_rows <= 1 THEN 'ok' WHEN abs(target_rows - source_rows) * 100.0 / source_rows > 5 THEN 'missing_data' ELSE 'warning' END AS status FROM s JOIN t USING (exchange, symbol)""")
def _(spark, d):
    t = V.trades(spark, d)
    target = t.filter(~((F.col("symbol") == "click") & (F.col("seq") % 9 == 0)) & ~((F.col("symbol") == "view") & (F.col("seq") % 40 == 0)))
    return Q.audit(t, target, ["exchange", "symbol"]).withColumn("delta_pct", F.round("delta_pct", 6))


@register("incremental_window", f"SELECT seq, symbol, ts FROM trades WHERE (ts > TIMESTAMP '2024-01-18' OR (ts = TIMESTAMP '2024-01-18' AND seq > 0)) AND ts <= TIMESTAMP '{AS_OF}' - INTERVAL '5 minutes'")
def _(spark, d):
    from tidemark.plans.offload import window

    return window(V.trades(spark, d), "ts", "seq", (_ts("2024-01-18 00:00:00"), 0), _ts(AS_OF)).select("seq", "symbol", "ts")


@register("freshness_health", f"""SELECT f.timeframe, f.limit_minutes, l.latest, coalesce(date_diff('second', l.latest, TIMESTAMP '{AS_OF}'), -1) AS age_seconds, CASE WHEN l.latest IS NULL THEN 'no_data' WHEN date_diff('second', l.latest, TIMESTAMP '{AS_OF}') > f.limit_minutes * 60 THEN 'stale' ELSE 'healthy' END AS status
FROM (VALUES ('1m', 10), ('5m', 20), ('30m', 60), ('1h', 120), ('1d', 1500)) f(timeframe, limit_minutes) LEFT JOIN (SELECT '1m' AS timeframe, max(time_bucket(INTERVAL '1 minute', ts)) AS latest FROM trades WHERE ts < TIMESTAMP '{AS_OF}' UNION ALL SELECT '1h', max(time_bucket(INTERVAL '1 hour', ts)) FROM trades WHERE ts < TIMESTAMP '{AS_OF}' UNION ALL SELECT '1d', max(time_bucket(INTERVAL '1 day', ts)) FROM trades WHERE ts < TIMESTAMP '2024-01-10') l ON f.timeframe = l.timeframe""")
def _(spark, d):
    t = V.trades(spark, d)
    until = lambda text: t.filter(F.col("ts") < _ts(text))
    bars = [C.candles(until(e), f).select(F.lit(f).alias("timeframe"), "window_start") for f, e in (("1m", AS_OF), ("1h", AS_OF), ("1d", "2024-01-10 00:00:00"))]
    return Q.freshness(bars[0].unionByName(bars[1]).unionByName(bars[2]), _ts(AS_OF), {"1m": 10, "5m": 20, "30m": 60, "1h": 120, "1d": 1500}).withColumn("age_seconds", F.coalesce("age_seconds", F.lit(-1)))


@register("retention_keep", "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n FROM trades WHERE CAST(ts AS DATE) >= DATE '2024-01-25' - 10 GROUP BY 1")
def _(spark, d):
    from tidemark.plans.offload import retained

    return retained(V.trades(spark, d).withColumn("day", F.to_date("ts")), "day", F.lit("2024-01-25").cast("date"), 10).groupBy(F.col("day").cast("string").alias("day")).agg(F.count("*").alias("n"))


@register("watermark_max", "SELECT ts AS max_ts, seq AS max_seq FROM trades ORDER BY ts DESC, seq DESC LIMIT 1")
def _(spark, d):
    from tidemark.plans.offload import high_mark

    return high_mark(V.trades(spark, d), "ts", "seq")


# --- streams and snapshots ---------------------------------------------------------------------------------------

_STORED = {
    "stream_candles": f"SELECT exchange, symbol, time_bucket(INTERVAL '60 minutes', ts, TIMESTAMP '1970-01-01') AS window_start, {_BAR} FROM trades WHERE quantity > 0 GROUP BY 1, 2, 3",
    "stream_dedup": "SELECT DISTINCT trade_id AS message_id, exchange, symbol, ts, CAST(CAST(ts AS DATE) AS VARCHAR) AS exchange_date, CAST(hour(ts) AS INTEGER) AS exchange_hour FROM trades",
    "stream_sequence": """, p AS (SELECT *, CASE WHEN seq < lag(seq) OVER (PARTITION BY exchange, symbol ORDER BY ts, seq) * 0.5 THEN 1 ELSE 0 END AS z FROM trades), r AS (SELECT *, sum(z) OVER (PARTITION BY exchange, symbol ORDER BY ts, seq) AS part FROM p),
h AS (SELECT *, max(seq) OVER (PARTITION BY exchange, symbol, part ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high FROM r), g AS (SELECT *, CASE WHEN z = 0 AND seq > high AND seq - high > 1 THEN seq - high - 1 ELSE 0 END AS gap FROM h)
SELECT exchange, symbol, CASE WHEN z = 1 THEN 'RESET' WHEN high IS NULL THEN 'FIRST' WHEN seq <= high THEN 'OUT_OF_ORDER' WHEN gap = 0 THEN 'OK' WHEN gap <= 10 THEN 'SMALL_GAP' ELSE 'LARGE_GAP' END AS event, count(*) AS n, CAST(sum(gap) AS BIGINT) AS missing FROM g GROUP BY 1, 2, 3""",
    "stream_dead_letters": f"SELECT {_KIND} AS error_type, r AS error_reason, count(*) AS n FROM (SELECT {_reason('2024-02-01')} AS r FROM (SELECT trade_id AS message_id, symbol, price, quantity, side, epoch_us(ts) AS timestamp, 'crypto' AS asset_class FROM trades)) WHERE r <> 'none' GROUP BY 1, 2",
    "snapshot_time_travel": "SELECT CAST(count_if(seq % 2 = 0) AS BIGINT) AS \"then\", count(*) AS now FROM trades",
    "compaction": "SELECT true AS fewer_files, count(*) AS n, CAST(sum(seq) AS BIGINT) AS total FROM trades",
    "incremental_offload": "SELECT exchange, symbol, count(*) AS n, max(seq) AS last FROM trades WHERE ts <= TIMESTAMP '2024-02-15' - INTERVAL '5 minutes' GROUP BY 1, 2",
    "full_load": "SELECT strftime(ts, '%Y-%m') AS month, count(*) AS n FROM daily GROUP BY 1",
    "partition_overwrite": "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n FROM trades WHERE CAST(ts AS DATE) NOT IN (DATE '2024-01-05', DATE '2024-01-06') OR seq % 3 = 0 GROUP BY 1",
    "retention_delete": "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n FROM trades WHERE CAST(ts AS DATE) >= DATE '2024-01-15' GROUP BY 1",
    "snapshot_expiry": "SELECT CAST(1 AS BIGINT) AS snapshots, CAST(0 AS BIGINT) AS orphans, count(*) AS n FROM trades",
    "stream_to_store": "SELECT exchange, count(*) AS n FROM trades GROUP BY 1",
    "dead_letter_files": f"{_RAW} SELECT message_id, r AS error_reason, {_KIND} AS error_type FROM (SELECT *, {_REASON} AS r FROM raw) WHERE r <> 'none'",
    "recent_tail": "SELECT symbol, ts, seq FROM (SELECT symbol, ts, seq, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, seq DESC) AS n FROM trades WHERE ts > (SELECT max(ts) FROM trades) - INTERVAL '720 minutes') WHERE n <= 50",
    "csv_days": "SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) IN (DATE '1995-01-01', DATE '1995-01-02')",
    "avro_registry": "SELECT seq, CAST(CASE WHEN seq % 50 = 0 THEN CASE WHEN seq % 2 = 0 THEN 1 ELSE 2 END WHEN seq % 53 = 0 THEN 99 WHEN seq % 2 = 0 THEN 1 ELSE 2 END AS INTEGER) AS schema_id, CASE WHEN seq % 50 = 0 OR seq % 53 = 0 OR seq % 7 = 0 THEN NULL ELSE symbol END AS symbol, CASE WHEN seq % 50 = 0 OR seq % 53 = 0 THEN NULL ELSE round(CAST(price AS DOUBLE), 6) END AS price, CASE WHEN seq % 2 = 0 OR seq % 53 = 0 THEN NULL ELSE side = 'SELL' END AS sell FROM trades",
    "silver_binance": "SELECT 'binance' AS exchange, 'ETHUSDT' AS symbol, 'ETH/USDT' AS canonical_symbol, 'USDT' AS currency, 'BINANCE-' || seq AS trade_id, (epoch_us(ts) // 1000) * 1000 AS timestamp, round(CAST(price AS DOUBLE), 6) AS price, CAST(1.5 AS DOUBLE) AS quantity, CASE WHEN seq % 2 = 0 THEN 'SELL' ELSE 'BUY' END AS side, seq AS source_sequence FROM trades WHERE seq % 11 <> 0 AND seq % 13 <> 0",
    "silver_kraken": "SELECT 'kraken' AS exchange, 'XBT/USD' AS symbol, 'BTC/USD' AS canonical_symbol, 'USD' AS currency, epoch_us(ts) AS timestamp, round(CAST(price AS DOUBLE), 6) AS price, CAST(0.25 AS DOUBLE) AS quantity, unnest(['BUY', 'SELL']) AS side, CAST(NULL AS BIGINT) AS source_sequence FROM trades WHERE seq % 11 <> 0",
    "silver_coinbase": "SELECT 'coinbase' AS exchange, 'BTCEUR' AS symbol, 'BTC/EUR' AS canonical_symbol, 'EUR' AS currency, 'COINBASE-' || seq AS trade_id, epoch_us(ts) AS timestamp, round(CAST(price AS DOUBLE), 6) AS price, CAST(2 AS DOUBLE) AS quantity, CASE WHEN seq % 2 = 0 THEN 'BUY' ELSE 'SELL' END AS side, seq AS source_sequence FROM trades",
    "older_trades": "SELECT CASE WHEN seq % 2 = 0 THEN 'BINANCE' ELSE 'ASX' END || '-' || (epoch_us(ts) // 1000) AS trade_id, symbol, CASE WHEN seq % 2 = 0 THEN 'BINANCE' ELSE 'ASX' END AS exchange, CASE WHEN seq % 2 = 0 THEN 'crypto' ELSE 'equities' END AS asset_class, (epoch_us(ts) // 1000) * 1000 AS timestamp, round(CAST(price AS DOUBLE), 6) AS price, 'AUD' AS currency, 'UNKNOWN' AS side, seq AS source_sequence, CAST(user_id AS VARCHAR) AS company FROM trades",
    "candle_upsert_store": "SELECT exchange, count(*) AS bars, CAST(sum(n) AS BIGINT) AS trades FROM (SELECT exchange, symbol, time_bucket(INTERVAL '1 day', ts) AS w, count(*) AS n FROM trades WHERE quantity > 0 GROUP BY 1, 2, 3) GROUP BY exchange",
}


def queries() -> dict[str, Query]:
    from tidemark.plans import stored

    return _QUERIES | stored.QUERIES


def oracle_sql() -> dict[str, str]:
    return _SQL | {name: WITH + sql for name, sql in _STORED.items()}
