"""Suffix-array dedup: byte strings of a given length that also start elsewhere, by a hash-compared suffix sort.

Occurrences of an anchor (see ``windows``) come together with the bytes around them that its windows cover.  In such a
group the suffixes that start at the anchor, and the reversed prefixes that end before it, are sorted by mergesort.  Two are
compared by a binary search for their longest common extension, on prefix polynomial hashes modulo 2**64; so a
comparison takes a logarithmic number of steps.  The extensions of neighbours in the sorted order are then verified byte by
byte; a group whose hashes collided is sorted again by its bytes.  A window that starts ``o`` bytes before its anchor occurs elsewhere
if another occurrence agrees on ``o`` bytes before and on the rest after; both classes follow from the sorted orders.

Anchors that may occur very often go through ``windows.resolve``: equal surroundings are counted first, then distinct ones sorted
in the same way; groups that are too many for a task are cut by their windows' offsets until they are small, and sorted and verified then.
Matches stay within a text because windows do.  Strings are judged on the input.

Defined cases: null texts count as empty; texts shorter than the string keep all; every row is a text of its own, repeated
rows too, which so lose all that is long enough; null ids are kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.llm import windows as W

U = np.uint64


class Suffixes:
    """Strings within one buffer, each a start and a length, compared by prefix hashes."""

    def __init__(self, data: np.ndarray, start: np.ndarray, length: np.ndarray):
        self.data = np.r_[data, np.zeros(1, np.uint8)]
        self.start, self.length = start, length
        self.prefix = W.prefix_hash(W.BYTE_SYMBOLS[data])
        self.inverse = W.powers(len(data) + 1)[1]
        self.steps = int(length.max(initial=0)).bit_length()

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many first bytes the strings a and b have in common, by binary search on hashes."""
        x, y = self.start[a], self.start[b]
        low, high = np.zeros(len(a), np.int64), np.minimum(self.length[a], self.length[b])
        px, py, ix, iy = self.prefix[x], self.prefix[y], self.inverse[x], self.inverse[y]
        for _ in range(self.steps):
            middle = (low + high + 1) >> 1
            same = (self.prefix[x + middle] - px) * ix == (self.prefix[y + middle] - py) * iy
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return np.minimum(low, high)

    def before(self, a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether string a comes before b (or is equal, where asked)."""
        n = self.extension(a, b)
        end_a, end_b = n == self.length[a], n == self.length[b]
        byte = self.data[np.minimum(self.start[a] + n, len(self.data) - 1)] < self.data[np.minimum(self.start[b] + n, len(self.data) - 1)]
        return np.where(end_a, ~end_b | or_equal, ~end_b & byte)

    def sort(self, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(order, extension with the one before or -1) within groups, which are given in order."""
        n = len(group)
        place = np.arange(n)
        edges = np.flatnonzero(np.r_[True, np.diff(group) != 0]) if n else place
        sizes = np.diff(np.r_[edges, n])
        first, size = np.repeat(edges, sizes), np.repeat(sizes, sizes)
        order, local, width = place.copy(), place - first, 1
        while width < sizes.max(initial=0):
            run = local // width
            other = first + (run ^ 1) * width
            have = np.clip(first + size - other, 0, width)
            right = (run & 1).astype(bool)
            low, high = np.zeros(n, np.int64), have.copy()
            while len(at := np.flatnonzero(low < high)):
                middle = (low[at] + high[at]) >> 1
                less = self.before(order[other[at] + middle], order[at], right[at])
                low[at], high[at] = np.where(less, middle + 1, low[at]), np.where(less, high[at], middle)
            merged = np.empty_like(order)
            merged[first + (run >> 1) * 2 * width + local - run * width + low] = order
            order, width = merged, width * 2
        common = np.full(n, -1, np.int64)
        later = np.flatnonzero(local > 0)
        common[later] = self.extension(order[later - 1], order[later])
        for g in np.unique(first[later[~self.holds(order[later - 1], order[later], common[later])]]):
            self._by_bytes(order, common, g, g + size[g])
        return order, common

    def holds(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether strings agree on their first n bytes, compared byte by byte, and are in order after."""
        good = self.before(a, b, np.ones(len(a), bool))
        for i in range(0, len(a), 1 << 16):
            part = slice(i, i + (1 << 16))
            size = n[part]
            offset = np.cumsum(size) - size
            step = np.arange(size.sum()) - np.repeat(offset, size)
            differs = self.data[np.repeat(self.start[a[part]], size) + step] != self.data[np.repeat(self.start[b[part]], size) + step]
            good[part] &= np.bincount(np.repeat(np.arange(len(size)), size)[differs], minlength=len(size)) == 0
        return good

    def _by_bytes(self, order: np.ndarray, common: np.ndarray, a: int, b: int) -> None:
        """Sort one group by its bytes, after a collision."""
        text = {i: self.data[self.start[i] : self.start[i] + self.length[i]].tobytes() for i in order[a:b]}
        order[a:b] = sorted(text, key=text.__getitem__)
        for p in range(a + 1, b):
            x, y = text[order[p - 1]], text[order[p]]
            common[p] = next((i for i, (s, t) in enumerate(zip(x, y, strict=False)) if s != t), min(len(x), len(y)))


def repeated(group: np.ndarray, left: np.ndarray, contexts: list[bytes], count: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """For distinct contexts of anchors, in order of group: the least and the greatest offset of a repeated window, or -1.

    ``left`` bytes of a context stand before its anchor; the windows start at each of its bytes that leaves ``span``.
    """
    n = len(contexts)
    size = np.array([len(c) for c in contexts], np.int64)
    data = np.frombuffer(b"".join(contexts), np.uint8)
    start = np.cumsum(size) - size
    after = Suffixes(data, start + left, size - left)
    ahead = Suffixes(data[::-1], len(data) - start - left, left)
    least_offset = left - (size - span)
    orders = [(*s.sort(group), np.empty(n, np.int64)) for s in (after, ahead)]
    low, high = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    for offset in range(int(least_offset.min(initial=0)), int(left.max(initial=-1)) + 1):
        at = np.flatnonzero((least_offset <= offset) & (offset <= left))
        if not len(at):
            continue
        for (order, common, label), depth in zip(orders, (span - offset, offset), strict=True):
            label[order] = np.cumsum(common < depth)
        window = orders[0][2][at] * (n + 1) + orders[1][2][at]
        _, where = np.unique(window, return_inverse=True)
        often = at[np.bincount(where, count[at])[where] > 1]
        high[often] = offset
        low[often] = np.where(low[often] < 0, offset, low[often])
    return low, high


def _cut_bytes(raw: list[bytes], texts: np.ndarray, first: np.ndarray, stop: np.ndarray) -> list[bytes]:
    return [raw[t][a:b] for t, a, b in zip(texts.tolist(), first.tolist(), stop.tolist(), strict=True)]


def _solve(span: int):
    def solve(table: pa.Table) -> pa.RecordBatch:
        hashes, at = table.column("hash").to_numpy(), table.column("at").to_numpy().astype(np.int64)
        left = at - table.column("first").to_numpy()
        known: dict[tuple, int] = {}  # equal contexts are sorted once
        own = np.array([known.setdefault(x, len(known)) for x in zip(hashes.tolist(), left.tolist(), table.column("body").to_pylist(), strict=True)], np.int64)
        count = np.bincount(own, minlength=len(known))
        keys = list(known)
        group = np.array([x[0] for x in keys], np.int64)
        edge = np.flatnonzero(np.r_[True, np.diff(group) != 0]) if len(keys) else np.empty(0, np.int64)
        members = np.add.reduceat(count, edge) if len(edge) else edge
        alone = np.repeat(members, np.diff(np.r_[edge, len(group)])) < 2
        some = np.flatnonzero(~alone)
        low, high = np.full(len(keys), -1, np.int64), np.full(len(keys), -1, np.int64)
        low[some], high[some] = repeated(group[some], np.array([keys[i][1] for i in some], np.int64), [keys[i][2] for i in some], count[some], span)
        rows = np.flatnonzero(high[own] >= 0)
        start, stop = at[rows] - high[own[rows]], at[rows] + span - low[own[rows]]
        return pa.RecordBatch.from_arrays([table.column("row").combine_chunks().take(pa.array(rows)), pa.array(start, pa.int32()), pa.array(stop, pa.int32())], names=["row", "start", "stop"])

    return common.lean(lambda batches: W.grouped(batches, solve))


def _few(span: int):
    def solve(table: pa.Table) -> pa.RecordBatch:
        bodies, left = table.column("body").to_pylist(), table.column("before").to_numpy().astype(np.int64)
        low, high = repeated(table.column("hash").to_numpy(), left, bodies, table.column("own").to_numpy(), span)
        sizes = np.array([len(x) - span + 1 for x in bodies], np.int64)
        first = np.cumsum(sizes) - sizes
        flat = np.ones(sizes.sum(), np.int64)
        often = np.flatnonzero(high >= 0)
        flat[first[often] + left[often] - high[often]] = 2
        flat[first[often] + left[often] - low[often]] = 2
        return W.values_batch(table, flat, sizes)

    return common.lean(lambda batches: W.grouped(batches, solve))


def spans(rows: DataFrame, *, span: int = 200, k: int = 64, hot: int = 1024, most: int = 256) -> str:
    """The folder of spans in bytes, laid beside the texts (``windows.placed``): strings that also start elsewhere."""
    with common.released() as keep:
        usual, often = W.repeated(rows, W.byte_symbols, k, span, hot)
        texts = rows.select("row", F.lit(None).cast("long").alias("id"), "raw")  # whose a text is doesn't matter
        plain = texts.mapInArrow(W.around(usual, _cut_bytes, span), W.AROUND).repartition("hash").sortWithinPartitions("hash").mapInArrow(_solve(span), "row long, start int, stop int")
        found = texts.mapInArrow(W.around(often, _cut_bytes, span), W.AROUND)
        hot_spans = W.resolve(found, F.lit(0), F.sum(F.size("firsts")), F.sum, lambda v: v > 1, _few(span), W.halves(lambda b: b, bytes, span), span, span - k + 1, most)
        keep.append(W.spans_beside(plain, hot_spans))
    return keep[0]


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _kept(raw: bytes, cut: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for a, b in cut:
        out.append(raw[at:a])
        at = b
    return b"".join([*out, raw[at:]])


def _cut(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        beside = W.Beside(path)
        for batch in common.slices(batches):
            rows = []
            for raw, cut in zip(batch.column("raw").to_pylist(), W.spans_of(beside, batch.column("row").to_numpy()), strict=True):
                kept = _kept(raw, cut)
                rows.append((len(raw), len(raw) - len(kept), len(cut), hashlib.sha256(kept).hexdigest()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string())))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return common.lean(run)


def dedup(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row."""
    rows = W.placed(df, id_col, text_col)
    return rows.mapInArrow(_cut(spans(rows, **options)), RESULT)


def cleaned(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows and columns of the input with the repeated bytes taken out of the text; what is left of a cut character goes too."""
    names = df.columns
    slim = F.struct(*(F.lit(None).cast("string").alias(c) if c == text_col else F.col(c) for c in names)).alias("own")
    rows = W.placed(df, id_col, text_col, slim)
    path = spans(rows, **options)
    schema = rows.select("own").schema.add("kept", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        beside = W.Beside(path)
        for batch in common.slices(batches):
            found = W.spans_of(beside, batch.column("row").to_numpy())
            kept = [_kept(raw, cut).decode("utf-8", "ignore") if cut else raw.decode() for raw, cut in zip(batch.column("raw").to_pylist(), found, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("own"), pa.array(kept, pa.string())], names=["own", "kept"])

    return rows.select("own", "row", "raw").mapInArrow(common.lean(run), schema).select(*(F.col("kept").alias(c) if c == text_col else F.col("own")[c].alias(c) for c in names))
