"""Command line: ``python -m tidemark.plans.cli <command> --root <folder of tables>``.

Commands: trades, quotes, summary, snapshots, stats, symbols, replay.  Output is a table, CSV or JSON lines.
"""

from __future__ import annotations

import argparse
import csv
import json
import sys
from collections.abc import Iterable, Sequence
from typing import TextIO

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.engine import Engine
from tidemark.sources.schemas import Registry
from tidemark.sources.store import Store


def engine(spark: SparkSession, root: str) -> Engine:
    """An engine over the tables below a folder: trades, and quotes and daily bars if they are there."""
    registry = Registry(root, spark=spark)
    store = lambda name: Store(spark, registry.path(name), registry.spec(name))
    there = registry.tables()
    quotes = store("quotes").read() if "quotes" in there else None
    bars = {t.removeprefix("ohlcv_"): store(t).read() for t in there if t.startswith("ohlcv_")}
    return Engine(spark, store("trades").read(), quotes, bars=bars, store=store("trades"), ts="timestamp", seq="source_sequence", key="message_id")


def parser() -> argparse.ArgumentParser:
    main = argparse.ArgumentParser(prog="tidemark", description=__doc__.split("\n")[0])
    main.add_argument("--root", required=True, help="the folder of tables")
    main.add_argument("--format", choices=("table", "csv", "json"), default="table")
    commands = main.add_subparsers(dest="command", required=True)

    def command(name: str, text: str, *, filters: bool = True, limit: int | None = 100) -> argparse.ArgumentParser:
        p = commands.add_parser(name, help=text)
        if filters:
            p.add_argument("--symbol")
            p.add_argument("--exchange")
            p.add_argument("--start", type=int, help="microseconds since 1970, inclusive")
            p.add_argument("--end", type=int)
        if limit:
            p.add_argument("--limit", type=int, default=limit)
        return p

    command("trades", "newest trades")
    command("quotes", "newest quotes")
    day = command("summary", "a day's figures of a symbol", filters=False, limit=None)
    day.add_argument("symbol")
    day.add_argument("day", help="YYYY-MM-DD")
    day.add_argument("--exchange")
    command("snapshots", "snapshots of the trades table", filters=False, limit=20)
    command("stats", "rows, times, symbols and venues", filters=False, limit=None)
    command("symbols", "distinct symbols", filters=False, limit=None).add_argument("--exchange")
    again = command("replay", "trades in time order, in batches", limit=None)
    again.add_argument("--batch", type=int, default=1000)
    again.add_argument("--batches", type=int, help="stop after so many")
    again.add_argument("--cursor", help="go on behind a batch")
    return main


def put(rows: Iterable, columns: Sequence[str], kind: str, out: TextIO) -> None:
    """Rows as an aligned table, CSV or JSON lines."""
    rows = [[None if v is None else v if isinstance(v, (int, float, str, bool)) else str(v) for v in r] for r in rows]
    if kind == "json":
        out.writelines(json.dumps(dict(zip(columns, r, strict=True))) + "\n" for r in rows)
    elif kind == "csv":
        writer = csv.writer(out)
        writer.writerow(columns)
        writer.writerows(rows)
    else:
        text = [list(columns), *([("" if v is None else str(v)) for v in r] for r in rows)]
        width = [max(len(r[i]) for r in text) for i in range(len(columns))]
        out.writelines("  ".join(v.ljust(w) for v, w in zip(r, width, strict=True)).rstrip() + "\n" for r in text)


def run(spark: SparkSession, arguments: Sequence[str], out: TextIO = sys.stdout) -> int:
    """Run one command; 2 for arguments that make no sense to the engine."""
    a = parser().parse_args(arguments)
    e = engine(spark, a.root)
    bounds = {k: getattr(a, k) for k in ("symbol", "exchange", "start", "end") if hasattr(a, k)}

    def show(df: DataFrame) -> int:
        put(e.fetch(df), df.columns, a.format, out)
        return 0

    try:
        if a.command in ("trades", "quotes"):
            if a.command == "quotes" and e.all_quotes is None:
                raise ValueError("there is no table of quotes")
            return show(getattr(e, a.command)(**bounds, limit=a.limit).drop("vendor_data", "trade_conditions"))
        if a.command == "summary":
            return show(e.summary(a.symbol, a.day, a.exchange))
        if a.command == "snapshots":
            return show(e.snapshots(a.limit))
        if a.command == "stats":
            return show(e.stats())
        if a.command == "symbols":
            return show(e.symbols(a.exchange))
        for n, (rows, cursor) in enumerate(e.replay(a.batch, cursor=a.cursor, **bounds), 1):
            put(rows, rows[0].__fields__, a.format, out)
            if cursor:
                told = e.place(cursor)
                out.write(f"# batch {told['batch']}, {told['sent']} of {told['total']} rows, {told['progress']} %, cursor {cursor}\n")
            if n == a.batches:
                break
        return 0
    except ValueError as error:
        print(f"tidemark: {error}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    from tidemark.session import session

    sys.exit(run(session("tidemark-cli"), sys.argv[1:]))
