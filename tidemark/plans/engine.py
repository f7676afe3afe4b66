"""The engine's calls: what the service's endpoints and commands answered, as lazy data frames."""

from __future__ import annotations

import base64
import json
import threading
import uuid
from collections.abc import Iterator
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.buckets import FRAMES, coarsest_for
from tidemark.operators import candles as C
from tidemark.operators import quality as Q
from tidemark.operators import queries as P
from tidemark.plans.control import Breaker
from tidemark.sources.store import Store


class Engine:
    """Queries over a trades table, and optionally quotes, a recent tail, stored bars by frame and the store's snapshots."""

    def __init__(self, spark: SparkSession, trades: DataFrame, quotes: DataFrame | None = None, tail: DataFrame | None = None, bars: dict[str, DataFrame] | None = None, store: Store | None = None, *, ts: str = "ts", seq: str = "seq", key: str = "trade_id"):
        self.spark, self.all_trades, self.all_quotes, self.tail_rows, self.stored, self.store = spark, trades, quotes, tail, bars or {}, store
        self.ts, self.seq, self.key, self.breaker = ts, seq, key, Breaker()

    def fetch(self, df: DataFrame, seconds: float = 30.0) -> list:
        """The rows of a page, through the breaker: failing or overlong queries count, and after some of them calls are refused for a while."""

        def run() -> list:
            sc, group = self.spark.sparkContext, f"tidemark-{uuid.uuid4().hex}"
            late = threading.Event()

            def stop() -> None:
                late.set()
                sc.cancelJobGroup(group)

            timer = threading.Timer(seconds, stop)
            sc.setJobGroup(group, "a page", interruptOnCancel=True)
            timer.start()
            try:
                return df.collect()
            except Exception as e:
                raise (TimeoutError(f"no answer within {seconds:g} s") if late.is_set() else e) from e
            finally:
                timer.cancel()
                sc.setLocalProperty("spark.jobGroup.id", None)

        return self.breaker.call(run)

    def trades(self, symbol=None, exchange=None, start=None, end=None, limit: int = 1000, **more) -> DataFrame:
        return P.trades(self.all_trades, symbols=symbol, exchanges=exchange, start=start, end=end, limit=limit, ts=self.ts, seq=self.seq, **more)

    def quotes(self, symbol=None, exchange=None, start=None, end=None, limit: int = 1000, **more) -> DataFrame:
        return P.quotes(self.all_quotes, symbols=symbol, exchanges=exchange, start=start, end=end, limit=limit, ts=self.ts, seq=self.seq, **more)

    def recent(self, as_of: Any, start=None, end=None, limit: int = 1000) -> DataFrame:
        return P.hybrid(self.all_trades, self.tail_rows, as_of=as_of, start=start, end=end, limit=limit, key=self.key, ts=self.ts, seq=self.seq)

    def _bars(self, frame: str, trades: DataFrame | None = None) -> DataFrame:
        """Stored bars of the frame; else the widest stored ones that make it up; else raw trades."""
        if frame in self.stored:
            return self.stored[frame]
        finer = coarsest_for(FRAMES[frame], [f for f in self.stored if FRAMES[f] < FRAMES[frame]])
        return C.roll_up(self.stored[finer], frame) if finer else C.candles(self.all_trades if trades is None else trades, frame, ts=self.ts, seq=self.seq)

    def ohlcv(self, symbol: str, timeframe: str, exchange: str | None = None, start=None, end=None, limit=1000) -> DataFrame:
        if timeframe not in FRAMES:
            raise ValueError(f"timeframe must be one of {', '.join(FRAMES)}")
        own = None
        if timeframe not in self.stored:  # bars are made of the asked symbol's trades only
            own = P.where(self.all_trades, P.named("symbol", symbol), None if exchange is None else P.named("exchange", exchange))
        return P.bars(self._bars(timeframe, own), timeframe, symbol=symbol, exchange=exchange, start=start, end=end, limit=limit)

    def ohlcv_batch(self, requests: list[dict]) -> list[DataFrame]:
        """Several bar queries; at most five, and 25,000 rows together."""
        if not 1 <= len(requests) <= 5:
            raise ValueError("one to five queries")
        if sum(P.limited(r.get("limit", 1000)) for r in requests) > 25_000:
            raise ValueError("the limits add up to more than 25000")
        return [self.ohlcv(**r) for r in requests]

    def summary(self, symbol: str, day: str, exchange: str | None = None) -> DataFrame:
        """A day's figures over all venues or one; no row without trades.  Stored daily bars answer where there are any for the day, trades else."""
        on = F.lit(day).cast("date")
        if "1d" in self.stored:
            bars = P.where(self.stored["1d"], F.col("symbol") == symbol, P.one_of("exchange", exchange), F.to_date("window_start") == on)
            made = C.over_venues(bars).select("symbol", F.to_date("window_start").alias("day"), "open", "high", "low", "close", "volume", "trade_count", "vwap")
            if made.limit(1).count():
                return made
        own = P.where(self.all_trades, F.col("symbol") == symbol, P.one_of("exchange", exchange), F.col(self.ts) >= on.cast("timestamp_ntz"), F.col(self.ts) < F.date_add(on, 1).cast("timestamp_ntz"))
        return P.summary(own, self.ts, self.seq)

    def aggregate(self, width: str, metrics: list[str], symbols=None, exchanges=None, start=None, end=None) -> DataFrame:
        own = P.where(self.all_trades, P.one_of("symbol", symbols), P.one_of("exchange", exchanges), P.at_least(self.ts, start), P.at_most(self.ts, end))
        return C.buckets(own, width, metrics, ts=self.ts, seq=self.seq)

    def symbols(self, exchange: str | None = None) -> DataFrame:
        return P.symbols(P.where(self.all_trades, P.one_of("exchange", exchange)))

    def date_range(self) -> DataFrame:
        return P.time_range(self.all_trades, self.ts)

    def stats(self) -> DataFrame:
        """Rows, times, symbols and venues, and how many snapshots the store has."""
        return P.replay_stats(self.all_trades, self.ts).withColumn("snapshots", F.lit(len(self.store.ids()) if self.store else 0).cast("long"))

    def status(self, as_of: Column, limits: dict[str, int] = Q.STALE_AFTER) -> dict[str, str]:
        """The health of each timeframe (one that can't be read is in error) and of all together."""
        told = {}
        for f in limits:
            try:
                told[f] = self.fetch(Q.freshness(self._bars(f).select(F.lit(f).alias("timeframe"), "window_start"), as_of, {f: limits[f]}))[0]["status"]
            except Exception:  # noqa: BLE001
                told[f] = "error"
        return told | {"overall": Q.overall(told)}

    def health(self, as_of: Column, limits: dict[str, int] = Q.STALE_AFTER) -> DataFrame:
        frames = [self._bars(f).select(F.lit(f).alias("timeframe"), "window_start") for f in limits]
        both = frames[0]
        for f in frames[1:]:
            both = both.unionByName(f)
        return Q.freshness(both, as_of, limits)

    # --- replay: one pass in time order, in batches, with a cursor that survives restarts

    def _replayed(self, symbol, exchange, start, end) -> DataFrame:
        return P.where(self.all_trades, P.one_of("symbol", symbol), P.one_of("exchange", exchange), P.at_least(self.ts, start), P.at_most(self.ts, end))

    def replay(self, batch: int = 1000, symbol=None, exchange=None, start=None, end=None, cursor: str | None = None) -> Iterator[tuple[list, str | None]]:
        """(rows, cursor) in time order; the cursor is null after the last batch.

        One sort serves all batches: its partitions come to the driver one after another.  A cursor holds the place (time, sequence) of the last row, the total, and the batch's
        number; given one, the replay goes on behind that row.
        """
        own, done = self._replayed(symbol, exchange, start, end), self.place(cursor)
        kind = own.schema[self.ts].dataType
        total = done["total"] if done else own.count()
        number, sent = (done["batch"], done["sent"]) if done else (0, 0)
        if done:
            t = F.lit(done["ts"]).cast(kind)
            own = own.filter((F.col(self.ts) > t) | ((F.col(self.ts) == t) & (F.col(self.seq) > done["seq"])))
        held: list = []
        for row in own.orderBy(self.ts, self.seq).toLocalIterator(prefetchPartitions=True):
            if len(held) == batch:
                number, sent = number + 1, sent + batch
                yield held, self._cursor(held[-1], total, number, sent)
                held = []
            held.append(row)
        if held:
            yield held, None

    def _cursor(self, row, total: int, number: int, sent: int) -> str:
        return base64.urlsafe_b64encode(json.dumps({"ts": str(row[self.ts]), "seq": row[self.seq], "total": total, "batch": number, "sent": sent}).encode()).decode()

    @staticmethod
    def place(cursor: str | None) -> dict | None:
        """What a cursor tells: time and sequence of the last row, total, batch number, rows sent, and the progress in percent; one that can't be read raises."""
        if not cursor:
            return None
        try:
            told = json.loads(base64.urlsafe_b64decode(cursor))
            return told | {"progress": round(100.0 * told["sent"] / told["total"], 2) if told["total"] else 100.0}
        except (ValueError, KeyError, TypeError):
            raise ValueError("not a cursor of a replay") from None

    # --- snapshots

    def snapshots(self, limit: int | None = None) -> DataFrame:
        h = self.store.history().orderBy(F.desc("snapshot_id"))
        return h.limit(limit) if limit else h

    def at_snapshot(self, number: int, where: str | None = None, limit: int = 1000) -> DataFrame:
        df = self.store.read(number, where)
        return df.limit(P.limited(limit))

    def rewind(self, moment: float) -> DataFrame:
        """The table as it was at a moment; empty before its first snapshot."""
        s = self.store.at(moment)
        return self.store.read(s.id) if s else self.spark.createDataFrame([], self.store.spec.schema)

    def sql(self, text: str, **tables: DataFrame) -> DataFrame:
        return self.spark.sql(text, **({"trades": self.all_trades} | tables))
