"""Incremental loads by watermark, retention, and the order of the periodic jobs."""

from __future__ import annotations

import json
import time
import uuid
from collections import Counter
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.buckets import FRAMES
from tidemark.operators import candles as C
from tidemark.sources.store import Store

BUFFER = "INTERVAL 5 MINUTES"
STALE_SECONDS = 30 * 60
# The periodic candle jobs and the minutes between their runs.
SCHEDULE = {"1m": 5, "5m": 15, "30m": 30, "1h": 60, "1d": 1440}
LAYERS = (("bronze_binance", "bronze_kraken", "bronze_coinbase"), ("silver_trades",), tuple(f"gold_ohlcv_{f}" for f in ("1m", "5m", "15m", "30m", "1h", "1d")))


def window(df: DataFrame, ts: str, seq: str, after: tuple[Column, int] | None, now: Column) -> DataFrame:
    """Rows after a (time, sequence) mark and not younger than the buffer.  Both bounds reach the scan."""
    df = df.filter(F.col(ts) <= now - F.expr(BUFFER))
    if after is None:
        return df
    t, s = after
    return df.filter((F.col(ts) >= t) & ((F.col(ts) > t) | (F.col(seq) > s)))


def high_mark(df: DataFrame, ts: str, seq: str) -> DataFrame:
    """One row: the highest (time, sequence), by both together."""
    return df.agg(F.max(F.struct(ts, seq)).alias("m")).select(F.col(f"m.{ts}").alias("max_ts"), F.col(f"m.{seq}").alias("max_seq"))


def retained(df: DataFrame, date_col: str, as_of: Column, days: int) -> DataFrame:
    return df.filter(F.col(date_col) >= F.date_sub(as_of, days))


@dataclass
class Mark:
    """A source's watermark: initialized -> running -> success or failed."""

    source: str
    last_ts: str | None = None
    last_seq: int | None = None
    status: str = "initialized"
    failures: int = 0
    updated: float = 0.0
    error: str | None = None

    def begin(self, now: float) -> Mark:
        if self.status == "running" and now - self.updated < STALE_SECONDS:
            raise RuntimeError(f"{self.source} is being loaded")
        return Mark(self.source, self.last_ts, self.last_seq, "running", self.failures, now)

    def succeed(self, ts: str | None, seq: int | None, now: float) -> Mark:
        return Mark(self.source, ts or self.last_ts, seq if ts else self.last_seq, "success", 0, now)

    def fail(self, error: str, now: float) -> Mark:
        return Mark(self.source, self.last_ts, self.last_seq, "failed", self.failures + 1, now, error[:500])


class Marks:
    """Watermarks as one small JSON file for each source."""

    def __init__(self, store: Store):
        self.files = store.store

    def get(self, source: str) -> Mark:
        path = f"_marks/{source}.json"
        return Mark(**json.loads(self.files.read(path))) if self.files.exists(path) else Mark(source)

    def put(self, mark: Mark) -> None:
        self.files.write(f"_marks/{mark.source}.json", json.dumps(asdict(mark)))


def has_new(source: DataFrame, target: Store, name: str, *, ts: str, seq: str, now: Column) -> bool:
    """Whether there is anything to load: the first row of the window is enough."""
    return bool(window(source, ts, seq, _after(source, Marks(target).get(name), ts), now).limit(1).count())


def _after(source: DataFrame, mark: Mark, ts: str) -> tuple[Column, int] | None:
    return None if mark.last_ts is None else (F.lit(mark.last_ts).cast(source.schema[ts].dataType), mark.last_seq)


def offload(source: DataFrame, target: Store, name: str, *, ts: str, seq: str, now: Column, clock: Callable[[], float] = time.time, metrics: Metrics | None = None) -> int:
    """Load what is new into the target once: window, anti-join on the key, one write, and the mark out of what was written.

    The source is read once, by that write; so a row that arrives meanwhile is either written or lies behind no mark.  Only the target's
    rows from the mark on can be met again, so only these are read for the anti-join.
    """
    marks, began = Marks(target), clock()
    mark = marks.get(name).begin(began)
    marks.put(mark)
    try:
        after = _after(source, mark, ts)
        new = target.spec.conform(window(source, ts, seq, after, now))
        before, keys = target.snapshot(), list(target.spec.key)
        if before and before.files:
            known = target.read()
            new = new.join((known if after is None else known.filter(F.col(ts) >= after[0])).select(*keys), keys, "left_anti")
        done = target.append(new, batch=f"{name}:{mark.last_ts}:{mark.last_seq}:{uuid.uuid4().hex}")
        added = target.added(done, before)
        top = added.agg(F.count("*").alias("n"), F.max(F.struct(ts, seq)).alias("m")).select("n", F.col(f"m.{ts}").cast("string").alias("ts"), F.col(f"m.{seq}").alias("seq")).first()
        marks.put(mark.succeed(top["ts"], top["seq"], clock()))
        if metrics:
            metrics.loaded(name, top["n"], clock() - began)
        return top["n"]
    except Exception as e:
        marks.put(mark.fail(str(e), clock()))
        if metrics:
            metrics.failed(name, type(e).__name__)
        raise


class Metrics:
    """Counters, gauges and histograms of loads, in this process; ``text`` gives them in the usual exposition format."""

    BOUNDS = (1, 5, 10, 30, 60, 300)

    def __init__(self, prefix: str = "tidemark_offload"):
        self.prefix, self.counters, self.gauges, self.seconds = prefix, Counter(), {}, {}

    def loaded(self, table: str, rows: int, seconds: float) -> None:
        self.counters["rows_total", table, ""] += rows
        self.counters["loads_total", table, "success"] += 1
        self.gauges["rows_per_second", table] = rows / seconds if seconds > 0 else 0.0
        self.gauges["last_success", table] = time.time()
        self.seconds.setdefault(table, []).append(seconds)

    def failed(self, table: str, kind: str) -> None:
        self.counters["loads_total", table, "failed"] += 1
        self.counters["errors_total", table, kind] += 1

    def text(self) -> str:
        lines = []
        for (name, table, kind), n in sorted(self.counters.items()):
            label = f',kind="{kind}"' if kind else ""
            lines.append(f'{self.prefix}_{name}{{table="{table}"{label}}} {n}')
        lines += [f'{self.prefix}_{name}{{table="{table}"}} {value:g}' for (name, table), value in sorted(self.gauges.items())]
        for table, seen in sorted(self.seconds.items()):
            lines += [f'{self.prefix}_seconds_bucket{{table="{table}",le="{b}"}} {sum(x <= b for x in seen)}' for b in (*self.BOUNDS, "+Inf") if b != "+Inf"]
            lines += [f'{self.prefix}_seconds_bucket{{table="{table}",le="+Inf"}} {len(seen)}', f'{self.prefix}_seconds_sum{{table="{table}"}} {sum(seen):g}', f'{self.prefix}_seconds_count{{table="{table}"}} {len(seen)}']
        return "\n".join(lines) + "\n"


def reaggregate(trades: DataFrame, bars: Store, frame: str, *, now: Column, minutes: int, ts: str = "ts", seq: str = "seq") -> None:
    """Late data: the bars of the last ``minutes`` are made anew out of all their trades and put in place of the stored ones, whole windows only."""
    width = F.expr(f"INTERVAL {FRAMES[frame]} MINUTES")
    low, high = (F.window(x, f"{FRAMES[frame]} minutes")["start"] for x in (now - F.expr(f"INTERVAL {int(minutes)} MINUTES"), now))
    recent = trades.filter((F.col(ts) >= low) & (F.col(ts) < high + width))
    made = C.candles(recent, frame, ts=ts, seq=seq)
    bars.upsert(made.withColumn("window_date", F.to_date("window_start")))


def run_layers(jobs: dict[str, Callable[[], int]]) -> dict[str, int | str]:
    """Bronze, then silver, then gold; the jobs of a layer side by side; a failed one doesn't stop its layer, but the next."""
    from concurrent.futures import ThreadPoolExecutor

    out: dict[str, int | str] = {}
    for layer in LAYERS:
        own = [j for j in layer if j in jobs]
        with ThreadPoolExecutor(max(1, len(own))) as pool:
            for name, future in [(n, pool.submit(jobs[n])) for n in own]:
                try:
                    out[name] = future.result()
                except Exception as e:  # noqa: BLE001
                    out[name] = f"failed: {e}"
        if any(isinstance(out[n], str) for n in own):
            break
    return out


def maintain(store: Store, *, target_bytes: int = 128 << 20, keep_seconds: float = 7 * 86400, keep: int = 3, audit: Callable[[], list[str]] | None = None) -> dict:
    """Compact, expire, audit; the audit's complaints raise after the rest is done."""
    out = {"compacted": store.compact(target_bytes), "expired": store.expire(time.time() - keep_seconds, keep)}
    bad = audit() if audit else []
    if bad:
        raise RuntimeError("audit: " + "; ".join(bad))
    return out


def due(frame: str, minute: int) -> bool:
    """Whether a candle job runs at this minute of the day (the daily one at five past midnight)."""
    return minute == 5 if frame == "1d" else minute % SCHEDULE[frame] == 0
