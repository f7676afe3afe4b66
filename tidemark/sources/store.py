"""Tables of Parquet files with a snapshot log: appends, overwrites, upserts, time travel and upkeep.

A table is a folder of data files and ``_log/NNNNNNNN.json``, one manifest a snapshot, made by a rename that fails if the number is taken (``Files.create``),
so two writers can't both commit it; an append that loses begins again on the other's snapshot.  Data files are written where they stay and count from the commit on.
Readers list the files of one snapshot, pruned by their partitions where bounds are given;
compaction and deletes write new manifests and old files stay until expiry.  What the driver holds is file names and counts.  Batch ids are kept for good: a
manifest holds the last ones and the names of sealed lists of those before.
"""

from __future__ import annotations

import hashlib
import json
import math
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.files import Exists, Files
from tidemark.sources.schemas import TableSpec


class Conflict(RuntimeError):
    """Another writer has committed in the meantime."""


@dataclass(frozen=True)
class Snapshot:
    id: int
    at: float
    operation: str
    files: dict[str, dict]  # relative path -> bytes, partition
    batches: tuple[str, ...] = ()
    sealed: tuple[str, ...] = ()  # files of the batch ids before

    def to_json(self) -> str:
        return json.dumps({"id": self.id, "at": self.at, "operation": self.operation, "files": self.files, "batches": list(self.batches), "sealed": list(self.sealed)})

    @classmethod
    def of(cls, text: str) -> Snapshot:
        d = json.loads(text)
        return cls(d["id"], d["at"], d["operation"], d["files"], tuple(d["batches"]), tuple(d.get("sealed", ())))


class Store:
    """One table."""

    def __init__(self, spark: SparkSession, root: str, spec: TableSpec):
        self.spark, self.root, self.spec = spark, root.rstrip("/"), spec
        self.store = Files(spark, self.root)

    # --- the table itself

    def exists(self) -> bool:
        return self.store.exists("_log")

    def create(self) -> Snapshot:
        """An empty table; one that is there already stays as it is."""
        return self.snapshot() or self._commit(None, "create", lambda base: {})

    def drop(self, purge: bool = True) -> None:
        """Take the table away: its log, and its files too unless they are to stay."""
        self.store.delete("_log", True)
        if purge:
            self.store.delete("data", True)

    def describe(self) -> DataFrame:
        """Columns, types, what the table is partitioned, ordered and keyed by."""
        s = self.spec
        rows = [(f.name, f.dataType.simpleString(), f.name in s.partitions, f.name in s.order, f.name in s.key) for f in s.schema]
        return self.spark.createDataFrame(rows, "column string, type string, is_partition boolean, is_order boolean, is_key boolean")

    # --- snapshots

    def ids(self) -> list[int]:
        return sorted(int(n[:-5]) for n, *_ in self.store.children("_log") if n.endswith(".json"))

    def snapshot(self, number: int | None = None) -> Snapshot | None:
        ids = self.ids()
        if number is None:
            number = ids[-1] if ids else None
        if number is None:
            return None
        if number not in ids:
            raise KeyError(f"{self.spec.name} has no snapshot {number}")
        return Snapshot.of(self.store.read(f"_log/{number:08d}.json"))

    def snapshots(self, limit: int | None = None) -> list[Snapshot]:
        """Newest first."""
        return [self.snapshot(i) for i in self.ids()[::-1][:limit]]

    def at(self, moment: float) -> Snapshot | None:
        """The last snapshot committed at or before a moment."""
        return next((s for s in self.snapshots() if s.at <= moment), None)

    def history(self) -> DataFrame:
        """The snapshots as a table: id, time, operation, number of files, bytes."""
        rows = [(s.id, float(s.at), s.operation, len(s.files), sum(f["bytes"] for f in s.files.values())) for s in self.snapshots()]
        return self.spark.createDataFrame(rows, "snapshot_id long, committed_at double, operation string, files long, bytes long")

    def files(self, number: int | None = None) -> DataFrame:
        s = self.snapshot(number)
        rows = [(p, f["bytes"], f["partition"]) for p, f in (s.files if s else {}).items()]
        return self.spark.createDataFrame(rows, "path string, bytes long, part string")

    def partitions(self, number: int | None = None) -> DataFrame:
        return self.files(number).groupBy("part").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))

    def _commit(self, base: Snapshot | None, operation: str, files: Callable[[Snapshot | None], dict], batch: str | None = None, retries: int = 0) -> Snapshot:
        """Write the next manifest.  ``files`` makes its list out of the snapshot it follows; appends do so again when another writer was first."""
        while True:
            done, sealed = (base.batches if base else ()) + ((batch,) if batch else ()), base.sealed if base else ()
            if len(done) > 1000:
                name = f"_batches/{hashlib.sha256(json.dumps(done[:1000]).encode()).hexdigest()}.json"
                if not self.store.exists(name):
                    self.store.write(name, json.dumps(done[:1000]))
                done, sealed = done[1000:], (*sealed, name)
            new = Snapshot((base.id if base else 0) + 1, time.time(), operation, files(base), done, sealed)
            try:
                self.store.create(f"_log/{new.id:08d}.json", new.to_json())
                return new
            except Exists:
                if not retries:
                    raise Conflict(f"{self.root}: snapshot {new.id}") from None
                retries, base = retries - 1, self.snapshot()
                if self.holds(base, batch):
                    return base

    def holds(self, base: Snapshot | None, batch: str | None) -> bool:
        """Whether a batch was committed by a snapshot or before it."""
        return bool(base and batch) and (batch in base.batches or any(batch in json.loads(self.store.read(n)) for n in base.sealed))

    # --- reading and writing

    def _frame(self, names: list[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], self.spec.schema)
        df = self.spark.read.schema(self.spec.schema).option("basePath", f"{self.root}/data").parquet(*(f"{self.root}/{p}" for p in names))
        return df.select(*self.spec.schema.names)

    def read(self, number: int | None = None, where: str | None = None, between: tuple | None = None) -> DataFrame:
        """A snapshot's rows.  Bounds on the first partition column prune the manifest; ``where`` reaches the scan, where folders and Parquet statistics prune."""
        s = self.snapshot(number)
        low, high = between or (None, None)
        of = lambda f: f["partition"].split("/")[0].partition("=")[2]
        df = self._frame([p for p, f in (s.files if s else {}).items() if (low is None or of(f) >= str(low)) and (high is None or of(f) <= str(high))])
        return df.filter(where) if where else df

    def added(self, new: Snapshot, base: Snapshot | None) -> DataFrame:
        """The rows of the files that a snapshot has beyond another."""
        return self._frame([p for p in new.files if base is None or p not in base.files])

    def stream(self, start: int = 0):
        """The files of appends after a snapshot, oldest first: (snapshot, rows); what a stream out of the table takes as its batches."""
        for number in (i for i in self.ids() if i > start):
            new = self.snapshot(number)
            if new.operation == "append":
                yield new, self.added(new, self.snapshot(number - 1) if number - 1 in self.ids() else None)

    def sink(self, stream: DataFrame, checkpoint: str, *, trigger: dict | None = None, name: str | None = None):
        """A stream's micro-batches as appends; a batch that runs again adds nothing."""
        label = name or checkpoint.rstrip("/").rpartition("/")[2]
        put = lambda batch, number: self.append(batch, f"{label}:{number}")
        return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()

    def _put(self, df: DataFrame, dealt: DataFrame | None = None) -> dict[str, dict]:
        """Write rows as new files: one shuffle by partition columns (if not dealt out already), rows in the table's order within a file."""
        if dealt is not None:
            df = dealt
        else:
            df = self.spec.conform(df)
            if self.spec.partitions:
                # A rebalance splits a partition that is too large for a task and merges small ones.
                df = df.hint("rebalance", *self.spec.partitions)
        if self.spec.order:
            df = df.sortWithinPartitions(*self.spec.partitions, *self.spec.order)
        load = f"load={uuid.uuid4().hex}"  # a folder of its own for each write, as one more partition column that isn't read
        writer = df.write.options(**self.spec.properties)
        if self.spec.partitions:
            writer = writer.partitionBy(*self.spec.partitions)
        writer.parquet(f"{self.root}/data/{load}")
        self.store.delete(f"data/{load}/_SUCCESS")
        return {f"data/{load}/{name}": {"bytes": size, "partition": name.rpartition("/")[0]} for name, size, _ in self.store.children(f"data/{load}", True) if name.endswith(".parquet")}

    def append(self, df: DataFrame, batch: str | None = None, retries: int = 3) -> Snapshot:
        """Add rows.  A batch that was committed before is left out, so a repeated load adds nothing."""
        base = self.snapshot()
        if self.holds(base, batch):
            return base
        new = self._put(df)
        return self._commit(base, "append", lambda base: (base.files if base else {}) | new, batch, retries)

    def overwrite_partitions(self, df: DataFrame, batch: str | None = None) -> Snapshot:
        """Put rows in place of all rows of the partitions they fall in."""
        base = self.snapshot()
        new = self._put(df)
        touched = {f["partition"] for f in new.values()}
        kept = {p: f for p, f in (base.files if base else {}).items() if f["partition"] not in touched}
        return self._commit(base, "overwrite", lambda _: kept | new, batch)

    def upsert(self, df: DataFrame, batch: str | None = None) -> Snapshot:
        """Replace rows of equal key, insert others; only the partitions that new rows or the keys' old rows fall in are read whole and written."""
        base = self.snapshot()
        if self.holds(base, batch):
            return base
        new = self.spec.conform(df)
        parts, key = list(self.spec.partitions), list(self.spec.key)
        old = self.read()
        if parts and base and base.files:
            touched = new.select(*parts)
            if not set(parts) <= set(key):  # a key may have moved: its old row lies in another partition
                touched = touched.unionByName(old.select(*dict.fromkeys(key + parts)).join(new.select(*key), key, "left_semi").select(*parts))
            old = old.join(touched.distinct(), parts, "left_semi")
            escaped = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
            values = touched.distinct().select(*(F.coalesce(F.col(c).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")) for c in parts)).collect()
            gone = {"/".join(f"{c}={escaped(v)}" for c, v in zip(parts, row, strict=True)) for row in values}
        kept = old.join(new.select(*key), key, "left_anti")
        files = self._put(kept.unionByName(new))
        gone = gone | {f["partition"] for f in files.values()} if parts and base and base.files else set()
        rest = {p: f for p, f in (base.files if base else {}).items() if parts and f["partition"] not in gone}
        return self._commit(base, "upsert", lambda _: rest | files, batch)

    # --- upkeep

    def expired_partitions(self, cutoff: str) -> list[str]:
        """Partitions whose first column is a date before the cutoff."""
        s = self.snapshot()
        return sorted({f["partition"] for f in (s.files if s else {}).values() if f["partition"].split("/")[0].partition("=")[2] < cutoff})

    def delete_partitions(self, cutoff: str, dry_run: bool = False) -> list[str]:
        gone = self.expired_partitions(cutoff)
        if gone and not dry_run:
            base = self.snapshot()
            kept = {p: f for p, f in base.files.items() if f["partition"] not in set(gone)}
            self._commit(base, "delete", lambda _: kept)
        return gone

    def compact(self, target_bytes: int = 128 << 20, dry_run: bool = False) -> dict[str, int]:
        """Rewrite each partition of several files that fill less than half of the target into as few as needed; files left by partition."""
        base = self.snapshot()
        groups: dict[str, list[str]] = {}
        for p, f in (base.files if base else {}).items():
            if f["bytes"] < target_bytes // 2:
                groups.setdefault(f["partition"], []).append(p)
        plan = {g: max(1, math.ceil(sum(base.files[p]["bytes"] for p in ps) / target_bytes)) for g, ps in groups.items() if len(ps) > 1}
        plan = {g: n for g, n in plan.items() if n < len(groups[g])}
        if dry_run or not plan:
            return plan
        # One job for all partitions; a partition of several files is cut by a hash of its order columns.
        old = [p for g in plan for p in groups[g]]
        df = self._frame(old)
        several = {g: n for g, n in plan.items() if n > 1}
        cuts = F.lit(1)
        if several:
            folder = F.concat_ws("/", *(F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in self.spec.partitions))
            cuts = F.coalesce(F.create_map(*(F.lit(x) for pair in several.items() for x in pair))[folder], F.lit(1))
        cut = F.pmod(F.xxhash64(*(self.spec.order or self.spec.schema.names)), cuts)
        new = self._put(df, df.repartition(len(old), *self.spec.partitions, cut))
        files = {p: f for p, f in base.files.items() if p not in set(old)} | new
        self._commit(base, "compact", lambda _: files)
        return plan

    def expire(self, older_than: float, keep: int = 3) -> list[int]:
        """Drop snapshots older than a moment, but for the newest ``keep``, and the files that no snapshot left holds."""
        ids = self.ids()
        gone = [s for s in (self.snapshot(i) for i in ids[: max(0, len(ids) - keep)]) if s.at < older_than]
        held = {p for i in ids if i not in {s.id for s in gone} for p in self.snapshot(i).files}
        for s in gone:
            for p in s.files.keys() - held:
                self.store.delete(p)
            self.store.delete(f"_log/{s.id:08d}.json")
        return [s.id for s in gone]

    def orphans(self, older_than: float, dry_run: bool = True) -> list[str]:
        """Data files in no snapshot that are older than a moment."""
        held = {p for i in self.ids() for p in self.snapshot(i).files}
        found = sorted(f"data/{n}" for n, _, at in self.store.children("data", True) if f"data/{n}" not in held and at < older_than)
        if not dry_run:
            for p in found:
                self.store.delete(p)
        return found

    def stats(self) -> dict[str, Any]:
        s = self.snapshot()
        return {"name": self.spec.name, "snapshots": len(self.ids()), "files": len(s.files) if s else 0, "bytes": sum(f["bytes"] for f in s.files.values()) if s else 0, "rows": self.read().count()}
