"""Windows that repeat: anchors, a count-min sketch of them, and spans to remove.

A text is a row of symbols (bytes, or words as 64-bit hashes).  Of each window of ``span`` symbols the least hash of its
``k``-grams is the window's anchor, the leftmost of equal ones.  The choice depends on the window's symbols only: equal
windows have equal anchors at equal offsets, and a window whose anchor occurs once does not repeat.  About two in
``span - k + 2`` positions are anchors, and consecutive windows share them.

Texts are written once, and each row is named by the task that wrote it (its part) and its place (``placed``).  What is found
about texts is laid beside them by part (``laid``) and met there (``Beside``): texts are read in order as often as needed and never shuffled, and
equal rows stay apart.

Tasks write sparse count-min sketches of their anchors' hashes; they are merged by ranges of cells, where they overestimate how often each
hash occurs.  The width is a multiple of the number of anchors, and the merged sketch is a table that anchors are joined with, block by block:
nothing of it is broadcast, and its load is the same at any size.  Anchors that occur again are grouped exactly
by the operators; those that may occur more than ``hot`` times go through ``resolve``, where equal surroundings are combined first and
groups that are still large are split by their windows' offsets, so no task gets a large group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

U = np.uint64
MULTIPLIER = 0x9E3779B97F4A7C15
INVERSE = pow(MULTIPLIER, -1, 1 << 64)
SEGMENT = 1 << 18
INDEX_BITS = 20
INDEX = U((1 << INDEX_BITS) - 1)
FLUSH = 1 << 19
PLACE_BITS = 33  # of a row's name, below its part

_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the multiplier and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 19)
        with np.errstate(over="ignore"):
            for i, base in enumerate((MULTIPLIER, INVERSE)):
                row = np.full(size, base, U)
                row[0] = 1
                _powers[i] = np.cumprod(row, dtype=U)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
        x = (x ^ (x >> U(29))) * U(0xBF58476D1CE4E5B9)
        return x ^ (x >> U(32))


def prefix_hash(symbols: np.ndarray) -> np.ndarray:
    """Prefix sums of symbol times power: the hash of [a, b) is (p[b] - p[a]) * inverse power a."""
    p = np.zeros(len(symbols) + 1, U)
    np.cumsum(symbols * powers(len(symbols))[0], out=p[1:])
    return p


def gram_hash(p: np.ndarray, k: int) -> np.ndarray:
    """Mixed hashes of all k-grams."""
    g = p[k:] - p[:-k]
    return mix(g * powers(len(g))[1])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have, m = 1, x
    while have < width:
        step = min(have, width - have)
        m = np.minimum(m[:-step], m[step:])
        have += step
    return m


BYTE_SYMBOLS = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))


def byte_symbols(data: bytes) -> np.ndarray:
    return BYTE_SYMBOLS[np.frombuffer(data, np.uint8)]


_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True


def word_symbols(data: bytes) -> np.ndarray:
    """A hash for each word; words are cut as ``bytes.split()`` does."""
    out, at = [], 0
    while at < len(data):
        end = min(len(data), at + (1 << 22))
        while end < len(data) and not _BLANK[data[end]]:
            end += 1
        raw = np.frombuffer(data, np.uint8, end - at, at)
        inside = np.zeros(len(raw) + 2, np.int8)
        inside[1:-1] = ~_BLANK[raw]
        edge = np.diff(inside)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        p = prefix_hash(BYTE_SYMBOLS[raw])
        out.append(mix((p[ends] - p[starts]) * powers(len(raw) + 1)[1][starts] + (ends - starts).astype(U)))
        at = end
    return np.concatenate(out) if out else np.empty(0, U)


@dataclass
class Anchors:
    """Anchors of a chunk: the text's place in the batch, the anchor's and its windows' first and last places in the text, the hash."""

    text: np.ndarray
    at: np.ndarray
    first: np.ndarray
    last: np.ndarray
    hash: np.ndarray
    low: np.ndarray  # of the first window, in the chunk
    prefix: np.ndarray

    def window_hashes(self, span: int) -> np.ndarray:
        """The hash of the window that starts at each place of the chunk."""
        return gram_hash(self.prefix, span)


def _chunks(texts: Iterable[np.ndarray], span: int) -> Iterator[list[tuple[int, int, np.ndarray]]]:
    parts, size = [], 0
    for i, symbols in enumerate(texts):
        for a in range(0, len(symbols) - span + 1, SEGMENT):
            part = symbols[a : a + SEGMENT + span - 1]
            parts.append((i, a, part))
            size += len(part)
            if size >= SEGMENT:
                yield parts
                parts, size = [], 0
    if parts:
        yield parts


def anchors(texts: Iterable[np.ndarray], k: int, span: int) -> Iterator[Anchors]:
    """The anchors of texts given as symbols, some texts at a time; long ones are taken in segments that share their edges."""
    for parts in _chunks(texts, span):
        symbols = np.concatenate([x for *_, x in parts])
        sizes = np.array([len(x) for *_, x in parts])
        offsets = np.cumsum(sizes) - sizes
        p = prefix_hash(symbols)
        g = gram_hash(p, k)
        least = sliding_min((g & ~INDEX) | np.arange(len(g), dtype=U), span - k + 1)
        whole = np.ones(len(least), bool)  # windows that lie within one part
        for o in offsets[1:]:
            whole[max(0, o - span + 1) : o] = False
        starts = np.flatnonzero(whole)
        own = (least[starts] & INDEX).astype(np.int64)
        runs = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        low, high, at = starts[runs], starts[np.r_[runs[1:], len(starts)] - 1], own[runs]
        part = np.searchsorted(offsets, low, side="right") - 1
        base = np.array([a for _, a, _ in parts]) - offsets
        yield Anchors(np.array([i for i, *_ in parts])[part], at + base[part], low + base[part], high + base[part], g[at], low, p)


def placed(df: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """(row, id, raw) and more, as a written table; ``row`` holds the part that a row was written to and its place there."""
    rows = df.select(*more, F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string").cast("binary"), F.lit(b"")).alias("raw"))
    return common.settled(rows.withColumn("row", F.monotonically_increasing_id()))


def laid(df: DataFrame) -> str:
    """Write rows about texts (``row`` and more) by the part of their text, in order of place.  A part is as large as a task's share of the texts."""
    path = common.scratch(df.sparkSession, "beside")
    dealt = df.withColumn("part", F.shiftright("row", PLACE_BITS)).repartition("part").sortWithinPartitions("part", "row")
    dealt.write.option("compression", "zstd").partitionBy("part").parquet(path)
    return path


class Beside:
    """Reads what was laid beside texts, one part at a time."""

    def __init__(self, path: str):
        (self.fs, self.root), self.part, self.table, self.names = common.open_fs(path), None, None, None

    def _load(self, part: int) -> pa.Table | None:
        from pyarrow import fs

        if part != self.part:
            found = self.fs.get_file_info(fs.FileSelector(f"{self.root}/part={part}", allow_not_found=True))
            tables = [pq.ParquetFile(self.fs.open_input_file(f.path)).read() for f in found if f.path.endswith(".parquet")]
            self.part, self.table = part, pa.concat_tables(tables).combine_chunks() if tables else None
            if tables:
                self.table = self.table.sort_by("row") if len(tables) > 1 else self.table
                self.names = self.table.column("row").to_numpy()
        return self.table

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, pa.Table | None]:
        """For a batch's rows: (their places in the batch, what is beside them), one for each row that was laid."""
        at, found = [], []
        parts = rows >> PLACE_BITS
        for part in np.unique(parts):
            if (table := self._load(int(part))) is None:
                continue
            own = np.flatnonzero(parts == part)
            low, high = (np.searchsorted(self.names, rows[own], side) for side in ("left", "right"))
            n = high - low
            at.append(np.repeat(own, n))
            found.append(table.take(pa.array(np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum()))))
        return (np.concatenate(at), pa.concat_tables(found)) if at else (np.empty(0, np.int64), None)


def occurrences(rows: DataFrame, symbols: Callable[[bytes], np.ndarray], k: int, span: int) -> DataFrame:
    """(row, at, shape, hash) of all anchors, settled.  ``shape`` is how far before the anchor its first window starts, and how many windows follow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            name = batch.column("row").to_numpy()
            for a in anchors(map(symbols, batch.column("raw").to_pylist()), k, span):
                yield pa.RecordBatch.from_arrays([pa.array(name[a.text]), pa.array(a.at, pa.int32()), pa.array((a.at - a.first << 16) + (a.last - a.first), pa.int32()), pa.array(a.hash.view(np.int64))], names=["row", "at", "shape", "hash"])

    return common.settled(rows.select("row", "raw").mapInArrow(common.lean(run), "row long, at int, shape int, hash long"))


BLOCK_BITS = 10  # cells of a block of the sketch, in each of two rows
BLOCK = 1 << BLOCK_BITS


def _partial(parts: int, blocks_each: int):
    """Sparse sketches of a task's anchors, cut into ranges of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            cell, count = np.unique(np.concatenate(held) if held else np.empty(0, np.int64), return_counts=True)
            part = cell // (blocks_each * 2 * BLOCK)
            edges = np.r_[0, np.flatnonzero(np.diff(part)) + 1, len(cell)] if len(cell) else np.zeros(1, np.int64)
            low, count = (cell - part * (blocks_each * 2 * BLOCK)).astype(np.uint32), np.minimum(count, (1 << 16) - 1).astype(np.uint16)
            cut = list(zip(edges[:-1], edges[1:], strict=True))
            return pa.RecordBatch.from_arrays([pa.array(part[edges[:-1]], pa.int64()), pa.array([low[a:b].tobytes() for a, b in cut], pa.binary()), pa.array([count[a:b].tobytes() for a, b in cut], pa.binary())], names=["part", "cells", "counts"])

        for batch in batches:
            block = batch.column("block").to_numpy() * (2 * BLOCK)
            held += [block + batch.column("c1").to_numpy(), block + BLOCK + batch.column("c2").to_numpy()]
            if sum(map(len, held)) >= 2 * FLUSH:
                yield out()
                held = []
        yield out()

    return common.lean(run)


def _merged(blocks_each: int, hot: int):
    """Partial sketches in order of their range: for each block with cells that were hit again, bits that say which, and which were often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = None, np.zeros(blocks_each * 2 * BLOCK, np.uint32)

        def out() -> pa.RecordBatch:
            by_block = total.reshape(blocks_each, 2 * BLOCK)
            own = np.flatnonzero((by_block > 1).any(axis=1))
            bits = [np.packbits(by_block[own] > most, axis=1, bitorder="little").view(np.int64) for most in (1, hot)]
            lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1) * (2 * BLOCK // 64), pa.int32()), pa.array(b.ravel())) for b in bits]
            return pa.RecordBatch.from_arrays([pa.array(own + part * blocks_each), *lists], names=["of", "again", "often"])

        for batch in batches:
            for p, cells, counts in zip(*(batch.column(c) for c in ("part", "cells", "counts")), strict=True):
                if part is not None and p.as_py() != part:
                    yield out()
                    total[:] = 0
                part = p.as_py()
                total[np.frombuffer(cells.as_buffer(), np.uint32)] += np.frombuffer(counts.as_buffer(), np.uint16)
        if part is not None:
            yield out()

    return common.lean(run)


def passing(found: DataFrame, hot: int, each: int = 4) -> DataFrame:
    """The occurrences whose hash may occur again by the merged sketch, and whether more than ``hot`` times.

    The sketch has ``each`` cells for an anchor in each of its two rows; ranges of blocks hold some four million anchors (fewer on small tables, for some parallel work).
    """
    n = max(1, found.count())
    block_bits = max(9, (n * each >> BLOCK_BITS).bit_length())
    parts = 1 << max(8, min(block_bits, (n >> 22).bit_length()))
    blocks_each = (1 << block_bits) // parts
    h = F.xxhash64("hash")
    celled = found.withColumns({"block": F.shiftrightunsigned(h, 64 - block_bits), "c1": h.bitwiseAND(BLOCK - 1), "c2": F.shiftright(h, BLOCK_BITS).bitwiseAND(BLOCK - 1) + BLOCK})
    partial = celled.select("block", "c1", (F.col("c2") - BLOCK).alias("c2")).mapInArrow(_partial(parts, blocks_each), "part long, cells binary, counts binary")
    blocks = partial.repartition("part").sortWithinPartitions("part").mapInArrow(_merged(blocks_each, hot), "of long, again array<long>, often array<long>")
    hit = lambda bits: " and ".join(f"(shiftright({bits}[cast(shiftright({c}, 6) as int)], cast({c} & 63 as int)) & 1) = 1" for c in ("c1", "c2"))
    return celled.join(blocks, F.col("block") == F.col("of")).filter(hit("again")).select("row", "at", "shape", "hash", F.expr(hit("often")).alias("hot"))


def repeated(rows: DataFrame, symbols: Callable[[bytes], np.ndarray], k: int, span: int, hot: int) -> tuple[str, str]:
    """Folders of the occurrences of anchors that may occur again, laid beside the texts: the usual ones, and those that may be hot."""
    found = occurrences(rows, symbols, k, span)
    marked = common.settled(passing(found, hot))
    out = tuple(laid(marked.filter(which).drop("hot")) for which in ("not hot", "hot"))
    common.drop(found, marked)
    return out


def around(path: str, cut: Callable[[list[bytes], np.ndarray, np.ndarray, np.ndarray], list[bytes]], span: int):
    """A function for ``mapInArrow`` over placed texts: (row, id, hash, at, first, body) of the occurrences laid beside them.

    ``cut`` gives the bodies: what the windows of an occurrence cover, from its first symbol to its stop.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        beside = Beside(path)
        for batch in common.slices(batches):
            name = batch.column("row").to_numpy()
            texts, found = beside.of(name)
            if found is None or not len(texts):
                continue
            raw, (at, shape) = batch.column("raw").to_pylist(), (found.column(c).to_numpy().astype(np.int64) for c in ("at", "shape"))
            first = at - (shape >> 16)
            body = cut(raw, texts, first, first + (shape & 0xFFFF) + span)
            yield pa.RecordBatch.from_arrays([pa.array(name[texts]), batch.column("id").take(pa.array(texts)), found.column("hash").combine_chunks(), pa.array(at, pa.int32()), pa.array(first, pa.int32()), pa.array(body, pa.binary())], names=["row", "id", "hash", "at", "first", "body"])

    return common.lean(run)


AROUND = "row long, id long, hash long, at int, first int, body binary"
CONTEXT = "p1 long, p2 long, shift int, hash long, low int, high int, before int, body binary, own long"
VALUES = "c1 long, c2 long, vals array<long>"


def halves(symbols: Callable[[bytes], list | bytes], joined: Callable, span: int):
    """Cut contexts in two by their windows' offsets before the anchor.  A half's group is named by the symbols that all its windows share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            rows = []
            for p1, p2, shift, _, low, high, before, body, own in zip(*(batch.column(i).to_pylist() for i in range(9)), strict=True):
                parts, middle = symbols(body), (low + high) // 2
                last = len(parts) - span  # the last window's start
                for a, b, l, h in ((0, min(last, before - middle), middle, high), (max(0, before - middle + 1), last, low, middle)):
                    if a <= b and l < h:
                        left = before - a
                        cut = parts[a : b + span]
                        core = hashlib.blake2b(b"%d %d " % (l, h) + joined(cut[left - l : left + span - h + 1]), digest_size=8).digest()
                        rows.append((p1, p2, shift + a, int.from_bytes(core, "little", signed=True), l, h, left, joined(cut), own))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=[x.split()[0] for x in CONTEXT.split(", ")])

    return common.lean(run)


def resolve(found: DataFrame, owner: Column, start: Column, combine: Callable[[str], Column], removes: Callable[[Column], Column], few: Callable, half: Callable, span: int, wide: int, most: int) -> DataFrame:
    """(row, spans) of the windows of hot anchors that are to go, out of ``AROUND`` rows.

    Equal contexts (the body, and where the anchor stands in it) are put together first, map-side too; ``start`` is the aggregate over their
    occurrences (a count, or the least owner) and ``combine`` that over contexts.  A group of at most ``most`` distinct ones is solved by one
    task (``few``: contexts in order of hash to ``VALUES``, a value for each window).  The contexts of other groups are cut in two by
    their windows' offsets before the anchor, from 0 to ``wide`` - 1 (``half``), and grouped anew by all that their windows then share; after
    ``log2(wide)`` cuts a context is one window, and equal ones are one.  So groups end up small whatever their anchor's number.  The
    values of its windows come back to a context, and ``removes`` tells from a value and the occurrence's owner whether a window goes.
    """
    parts = ("hash", "before", "body")
    places = found.groupBy("row", owner.cast("long").alias("owner"), "hash", (F.col("at") - F.col("first")).alias("before"), "body").agg(F.collect_set("first").alias("firsts"))
    named = common.settled(places.withColumns({"row1": F.xxhash64(*parts), "row2": F.xxhash64(F.lit(1), *parts)}))
    whole = named.groupBy("row1", "row2", *parts).agg(start.cast("long").alias("own"))
    level = common.settled(whole.select(F.col("row1").alias("p1"), F.col("row2").alias("p2"), F.lit(0).alias("shift"), "hash", F.lit(0).alias("low"), F.lit(wide).alias("high"), "before", "body", "own"))
    solved = None
    while True:
        marked = level.withColumns({"row1": F.xxhash64(*parts), "row2": F.xxhash64(F.lit(1), *parts)})
        distinct = common.settled(marked.groupBy("row1", "row2", *parts, (F.col("high") - F.col("low") > 1).alias("more")).agg(combine("own").alias("own")).withColumnsRenamed({"row1": "c1", "row2": "c2"}))
        # Joins are on one of two hashes, the other is a condition: so both sides have exchanges of their own and adaptive execution may split hot keys.
        big = common.settled(distinct.filter("more").groupBy("hash", F.xxhash64("hash").alias("h2")).count().filter(F.col("count") > most).select(F.col("hash").alias("h1"), "h2"))
        in_big = (F.col("hash") == F.col("h1")) & (F.xxhash64("hash").bitwiseXOR(F.col("h2")) == 0)
        values = distinct.join(big, in_big, "left_anti").select("c1", "c2", *parts, "own").repartition("hash").sortWithinPartitions("hash").mapInArrow(few, VALUES)
        own = common.settled(marked.select("p1", "p2", "shift", "row1", "row2").join(values, (F.col("row1") == F.col("c1")) & (F.col("row2").bitwiseXOR(F.col("c2")) == 0)).select("p1", "p2", "shift", "vals"))
        solved = own if solved is None else solved.unionByName(own)
        if not big.limit(1).count():
            break
        level = common.settled(level.join(big, in_big, "left_semi").mapInArrow(half, CONTEXT))
    # A context's windows are in one solved part each: at most ``wide`` parts.
    joined = solved.groupBy("p1", "p2").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("shift", "vals"))), lambda x: x["vals"])).alias("vals"))
    met = named.join(joined, (F.col("row1") == F.col("p1")) & (F.col("row2").bitwiseXOR(F.col("p2")) == 0))
    gone = met.withColumn("gone", F.filter(F.transform("vals", lambda v, i: F.when(removes(v), i)), lambda i: i.isNotNull())).filter(F.size("gone") > 0)
    low, high = F.element_at("gone", 1), F.element_at("gone", -1)
    return gone.select("row", F.transform("firsts", lambda x: packed_span(x + low, x + high + span)).alias("spans"))


def packed_span(start: Column, stop: Column) -> Column:
    return F.shiftleft(start.cast("long"), 32) + stop


def values_batch(table: pa.Table, flat: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
    """``VALUES`` for contexts and their windows' values, one after another."""
    offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
    return pa.RecordBatch.from_arrays([table.column("c1").combine_chunks(), table.column("c2").combine_chunks(), pa.ListArray.from_arrays(offsets, pa.array(flat.astype(np.int64)))], names=["c1", "c2", "vals"])


def grouped(batches: Iterator[pa.RecordBatch], solve) -> Iterator[pa.RecordBatch]:
    """Solve whole groups of rows of equal ``hash``; the last group of a batch waits for the next batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < 5000:
            continue
        table = pa.Table.from_batches(held)
        hashes = table.column("hash").to_numpy()
        cut = int(np.flatnonzero(hashes != hashes[-1])[-1]) + 1 if hashes[0] != hashes[-1] else 0
        if cut:
            yield solve(table.slice(0, cut))
            held = table.slice(cut).to_batches()
    if held:
        yield solve(pa.Table.from_batches(held))


def spans_beside(usual: DataFrame, often: DataFrame) -> str:
    """Spans (row, start, stop) and (row, spans) laid beside the texts."""
    return laid(usual.select("row", F.array(packed_span(F.col("start"), F.col("stop"))).alias("spans")).unionByName(often))


def spans_of(beside: Beside, rows: np.ndarray) -> list[list[tuple[int, int]]]:
    """The maximal runs to remove of each of a batch's rows."""
    at, found = beside.of(rows)
    packed: list[list[int]] = [[] for _ in rows]
    if found is not None:
        for i, x in zip(at.tolist(), found.column("spans").to_pylist(), strict=True):
            packed[i] += x
    return [union(p) for p in packed]


def union(packed: list[int]) -> list[tuple[int, int]]:
    """Maximal runs of spans, each packed as start * 2**32 + stop."""
    out: list[list[int]] = []
    for x in sorted(packed):
        a, b = x >> 32, x & 0xFFFFFFFF
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]
