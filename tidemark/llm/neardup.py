"""Near-duplicate documents by SetSketch registers: banded, estimated jointly by likelihood, then verified.

A document is the set of its distinct word shingles, as 64-bit hashes.  Each of ``m`` hash functions' least value over a set, seen
as an exponential variate, is rounded to a power of ``b`` near 1 and truncated: a SetSketch register.  Registers of a union are
the maxima of registers, and two sets agree in one with about the probability of their similarity; so they are banded.

1. Texts are written once (``windows.placed``) and read for registers and a digest of the set.  Documents with equal sets are one class, named
   by its smallest id; only the class goes on, with its registers.
2. Each class is compared with the smallest class of its buckets, one each; so a group of copies costs a comparison for each copy, not for
   each pair.  Links give components.
3. Classes of buckets that hold several components are open: they may have links that no comparison has seen.  A prefix filter finds them: of two
   sets that are similar, the first tokens in any one order must share one.  The order is by how often a token occurs in open sets, as
   a merged sketch of bounded size tells (it only orders, so a full one loses nothing); so what a template brings to all of its documents comes last, and
   documents that only share a template don't meet.  Tokens that one component has alone are left out, and a token's classes meet across components
   only (``_across``): two components split at the highest bit in which their ranks differ, so members of one are never paired.
4. A comparison first estimates the similarity by maximum likelihood from the registers that are greater, equal and smaller, given
   both sizes; what lies ``margin`` standard errors below the threshold is left out.  The rest is verified on full sets, read from the texts again.

Bands of 4 registers, 28 of them, miss a pair of similarity 0.8 with probability 4e-7 if the registers are independent; a function is a
sum of both halves of a mixed hash times two random numbers of its own, and in simulation none was missed.

Defined cases: null and blank texts have empty sets and no links; a text with fewer words than a shingle has its whole
sequence as its one shingle; rows of one id are one document, judged by the text of the least digest; rows without an
id have no links, no component, and are kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.llm import windows as W
from tidemark.llm.components import components

U = np.uint64
BANDS, BAND = 28, 4
M = BANDS * BAND
BASE = 1.001
RATE = 20.0
TOP = 65535
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_LOW, _HIGH = np.random.default_rng(2021).integers(0, 1 << 31, (2, M), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_PLUS = np.random.default_rng(2022).integers(0, 1 << 32, M, dtype=np.uint32)


def shingles(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; a shorter text's whole sequence is its one shingle."""
    symbols = W.word_symbols(text.translate(LOWER))
    if not len(symbols):
        return symbols
    if len(symbols) < words:
        return W.mix(W.prefix_hash(symbols)[-1:] + U(len(symbols)))
    return np.unique(W.gram_hash(W.prefix_hash(symbols), words) + U(words))


def registers(hashes: np.ndarray) -> np.ndarray:
    """The SetSketch registers of a set that isn't empty."""
    mixed = W.mix(hashes)
    low, high = mixed.astype(np.uint32), (mixed >> U(32)).astype(np.uint32)
    least = np.full(M, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(low), 1024):
        values = low[i : i + 1024, None] * _LOW
        values += high[i : i + 1024, None] * _HIGH
        values += _PLUS
        np.minimum(least, values.min(axis=0), out=least)
    h = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(h) / math.log(BASE)), 0, TOP).astype(np.uint16)


def band_keys(regs: np.ndarray) -> np.ndarray:
    """A key for each band of rows of registers."""
    parts = regs.reshape(-1, BANDS, BAND).astype(U)
    packed = parts[..., 0] | parts[..., 1] << U(16) | parts[..., 2] << U(32) | parts[..., 3] << U(48)
    return W.mix(W.mix(packed) + (np.arange(BANDS, dtype=U) + U(1)) * U(W.MULTIPLIER))


def likeliest(greater: np.ndarray, smaller: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood similarities from the numbers of registers where a's is greater and smaller, given the sizes."""
    u, v = size_a / (size_a + size_b), size_b / (size_a + size_b)
    equal = M - greater - smaller
    scale = math.log(BASE)

    def value(j: np.ndarray) -> np.ndarray:
        up = -np.log1p(-np.maximum(u - v * j, 0) * (BASE - 1) / BASE) / scale
        down = -np.log1p(-np.maximum(v - u * j, 0) * (BASE - 1) / BASE) / scale
        tiny = 1e-12
        return greater * np.log(np.maximum(up, tiny)) + smaller * np.log(np.maximum(down, tiny)) + equal * np.log(np.maximum(1 - up - down, tiny))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(50):  # the likelihood has one top
        a, b = low + (high - low) / 3, high - (high - low) / 3
        up = value(a) < value(b)
        low, high = np.where(up, a, low), np.where(up, high, b)
    return (low + high) / 2


DOCUMENTS = "row long, id long, n long, d1 long, d2 long, regs binary"


def _documents(words: int):
    """Sizes, digests and registers of placed texts; only sizes for empty sets and null ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            rows = []
            for name, raw in zip(batch.column("id").to_pylist(), batch.column("raw").to_pylist(), strict=True):
                found = shingles(raw, words)
                if not len(found) or name is None:
                    rows.append((len(found), None, None, None))
                    continue
                with np.errstate(over="ignore"):
                    digest = np.array([found.sum(), W.mix(found + U(1)).sum()]).view(np.int64).tolist()
                rows.append((len(found), *digest, registers(found).tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), *(pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary())))], names=["row", "id", "n", "d1", "d2", "regs"])

    return common.lean(run)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            keys = band_keys(np.frombuffer(b"".join(batch.column("regs").to_pylist()), np.uint16))
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(batch.column("node").to_numpy(), BANDS))], names=["bucket", "node"])


def _estimated(threshold: float, margin: float):
    least = threshold - margin * math.sqrt(threshold * (1 - threshold) / M)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, M) for c in ("regs_a", "regs_b"))
            j = likeliest((x > y).sum(axis=1), (x < y).sum(axis=1), batch.column("n_a").to_numpy().astype(float), batch.column("n_b").to_numpy().astype(float))
            keep = pa.array(j >= least)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b", "n_a", "n_b")], names=["a", "b", "n_a", "n_b"])

    return common.lean(run)


def _both(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Which members of the sorted set p are in the sorted set q."""
    return q[np.minimum(np.searchsorted(q, p), len(q) - 1)] == p


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, U)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both = [int(_both(_unpacked(x), _unpacked(y)).sum()) for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(both, pa.int64())], names=["a", "b", "both"])


def _sets(rows: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """(of, set): the sorted full sets of named classes, out of their texts; settled."""
    path = W.laid(nodes.select("row", "node"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        beside = W.Beside(path)
        for batch in common.slices(batches):
            at, found = beside.of(batch.column("row").to_numpy())
            if found is not None and len(at):
                sets = [shingles(x.as_py(), words).tobytes() for x in batch.column("raw").take(pa.array(at))]
                yield pa.RecordBatch.from_arrays([found.column("node").combine_chunks(), pa.array(sets, pa.binary())], names=["of", "set"])

    out = common.settled(rows.select("row", "raw").mapInArrow(common.lean(run), "of long, set binary"))
    common.remove(path)
    return out


def _met(pairs: DataFrame, ends: DataFrame, *columns: str) -> DataFrame:
    """Pairs (a, b) with columns of both ends."""
    for e in "ab":
        pairs = pairs.join(ends.select(F.col("of").alias(f"of_{e}"), *(F.col(c).alias(f"{c}_{e}") for c in columns)), F.col(e) == F.col(f"of_{e}")).drop(f"of_{e}")
    return pairs


def _likely(pairs: DataFrame, nodes: DataFrame, threshold: float, margin: float) -> DataFrame:
    """The pairs of classes whose registers don't rule them out, with both sizes; settled."""
    known = nodes.select(F.col("node").alias("of"), "n", "regs")
    return common.settled(_met(pairs.select("a", "b"), known, "n", "regs").mapInArrow(_estimated(threshold, margin), "a long, b long, n_a long, n_b long"))


def _links(likely: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs that are similar on full sets; settled."""
    measured = _met(likely.select("a", "b"), sets, "set").mapInArrow(common.lean(_measured), "a long, b long, both long").withColumnsRenamed({"a": "x", "b": "y"})
    found = likely.join(measured, (F.col("a") == F.col("x")) & (F.col("b") == F.col("y")))
    return common.settled(found.filter(100 * F.col("both") >= round(threshold * 100) * (F.col("n_a") + F.col("n_b") - F.col("both"))).select("a", "b"))


ORDER_BITS, ORDER_BLOCK = 22, 14  # cells of the sketch that orders tokens, and of a block of it


def _often(sets: DataFrame) -> np.ndarray:
    """How often tokens occur in sets, by cell of their hash: a merged sketch of 2**ORDER_BITS bytes (counts to 127, then steps of a quarter of a power of two)."""
    block = 1 << ORDER_BLOCK

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << ORDER_BITS, np.uint32)
        for batch in batches:
            for data in batch.column("set").to_pylist():
                total[(W.mix(_unpacked(data)) >> U(64 - ORDER_BITS)).astype(np.int64)] += np.uint32(1)  # a set's tokens are distinct; of two in one cell one counts
        cell = np.flatnonzero(total)
        edges = np.r_[0, np.flatnonzero(np.diff(cell >> ORDER_BLOCK)) + 1, len(cell)] if len(cell) else np.zeros(1, np.int64)
        cut = list(zip(edges[:-1], edges[1:], strict=True))
        yield pa.RecordBatch.from_arrays([pa.array((cell >> ORDER_BLOCK)[edges[:-1]], pa.int64()), pa.array([(cell[a:b] & (block - 1)).astype(np.uint16).tobytes() for a, b in cut], pa.binary()), pa.array([total[cell[a:b]].tobytes() for a, b in cut], pa.binary())], names=["block", "cells", "counts"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total = None, np.zeros(block, np.float64)

        def out() -> pa.RecordBatch:
            steps = np.where(total < 128, total, np.minimum(255, 128 + 4 * (np.log2(np.maximum(total, 128)) - 7)))
            return pa.RecordBatch.from_arrays([pa.array([own], pa.int64()), pa.array([steps.astype(np.uint8).tobytes()], pa.binary())], names=["block", "steps"])

        for batch in batches:
            for b, cells, counts in zip(*(batch.column(c) for c in ("block", "cells", "counts")), strict=True):
                if own is not None and b.as_py() != own:
                    yield out()
                    total[:] = 0
                own = b.as_py()
                total[np.frombuffer(cells.as_buffer(), np.uint16)] += np.frombuffer(counts.as_buffer(), np.uint32)
        if own is not None:
            yield out()

    found = sets.select("set").mapInArrow(common.lean(partial), "block long, cells binary, counts binary").repartition("block").sortWithinPartitions("block").mapInArrow(merged, "block long, steps binary")
    out = np.zeros(1 << ORDER_BITS, np.uint8)
    for r in found.collect():  # 2**ORDER_BITS bytes in all
        out[r["block"] * block : (r["block"] + 1) * block] = np.frombuffer(r["steps"], np.uint8)
    return out


def _prefixes(shared, percent: int):
    """(token, of, n, reach) of the first tokens of each set in the order of the sketch, but for those that occur once.

    A similar partner's first common token stands here, and the partner has at most ``reach`` tokens.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = np.frombuffer(zlib.decompress(shared.value), np.uint8)
        for batch in common.slices(batches, 500):
            parts = []
            for of, data in zip(batch.column("of").to_pylist(), batch.column("set").to_pylist(), strict=True):
                tokens = _unpacked(data)
                f = often[(W.mix(tokens) >> U(64 - ORDER_BITS)).astype(np.int64)]
                n = len(tokens)
                first = np.lexsort((tokens, f))[: n + (-percent * n // 100) + 1]
                place = np.flatnonzero(f[first] > 1)
                parts.append((tokens[first[place]].view(np.int64), np.full(len(place), of), np.full(len(place), n), (n - place) * (100 + percent) // percent - n))
            columns = [np.concatenate(c).astype(np.int64) for c in zip(*parts, strict=True)] if parts else [np.empty(0, np.int64)] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["token", "of", "n", "reach"])

    return common.lean(run)


def _across(open_nodes: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of open classes (node, label) of different components that a prefix filter doesn't rule out."""
    percent = round(threshold * 100)
    shared = sets.sparkSession.sparkContext.broadcast(zlib.compress(_often(sets).tobytes(), 1))
    index = sets.mapInArrow(_prefixes(shared, percent), "token long, of long, n long, reach long")
    index = common.settled(index.join(open_nodes, F.col("of") == F.col("node")).drop("of"))
    # Components are ranked within a token: one row for each, however many classes they hold.
    each = index.groupBy("token", "label").agg(F.max(F.col("reach") >= F.col("n")).alias("front"))
    of_token = Window.partitionBy("token")
    ranked = each.select("token", "label", (F.row_number().over(of_token.orderBy("label")) - 1).alias("rank"), F.count("*").over(of_token).alias("labels"), F.max("front").over(of_token).alias("some"))
    ranked = ranked.filter("labels > 1 and some").select(F.col("token").alias("t1"), F.col("label").alias("l1"), "rank", F.ceil(F.log2("labels")).cast("int").alias("levels"))
    entries = index.join(ranked, (F.col("token") == F.col("t1")) & (F.col("label") == F.col("l1"))).select("token", "node", "n", "reach", "rank", F.explode(F.sequence(F.lit(0), F.col("levels") - 1)).alias("bit"))
    entries = common.settled(entries.select("node", "n", "reach", F.xxhash64("token", "bit", F.expr("shiftright(rank, bit + 1)")).alias("at"), F.expr("shiftright(rank, bit) & 1").alias("side")))
    other = entries.filter("side = 1").select(*(F.col(c).alias(f"{c}_2") for c in entries.columns))
    met = entries.filter("side = 0").join(other, (F.col("at") == F.col("at_2")) & (F.col("n_2") <= F.col("reach")) & (F.col("n") <= F.col("reach_2")))
    return met.select(F.least("node", "node_2").alias("a"), F.greatest("node", "node_2").alias("b")).filter("a < b").distinct()


def near_duplicates(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 5, threshold: float = 0.8, margin: float = 6.0) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row."""
    return _judged(W.placed(df, id_col, text_col), words, threshold, margin).select("id", "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _judged(rows: DataFrame, words: int, threshold: float, margin: float) -> DataFrame:
    """(row, id, n_shingles, component_id) of placed texts."""
    with common.released() as keep:
        documents = common.settled(rows.select("row", "id", "raw").mapInArrow(_documents(words), DOCUMENTS))

        # Classes of equal sets.  Of several texts of one id the least digest counts.
        members = documents.filter(F.col("d1").isNotNull()).groupBy("id").agg(F.min(F.struct("d1", "d2", "n", "row")).alias("d")).select("id", "d.*")
        classes = common.settled(members.groupBy("d1", "d2").agg(F.min(F.struct("id", "row", "n")).alias("c")).select(F.col("d1").alias("e1"), F.col("d2").alias("e2"), F.col("c.id").alias("node"), F.col("c.row").alias("row"), F.col("c.n").alias("n")))
        named = common.settled(members.select("id", "d1", "d2").join(classes.select("e1", "e2", "node"), (F.col("d1") == F.col("e1")) & (F.col("d2").bitwiseXOR(F.col("e2")) == 0)).select("id", "node"))
        nodes = common.settled(documents.select(F.col("row").alias("at"), "regs").join(classes.select("node", "row", "n"), F.col("at") == F.col("row")).select("node", "row", "n", "regs"))

        banded = nodes.select("node", "regs").mapInArrow(common.lean(_bands), "bucket long, node long")
        least = banded.groupBy("bucket", F.xxhash64("bucket").alias("b2")).agg(F.min("node").alias("pivot"), F.count("*").alias("size")).filter("size > 1").select(F.col("bucket").alias("of"), "b2", "pivot")
        buckets = common.settled(banded.join(least, (F.col("bucket") == F.col("of")) & (F.xxhash64("bucket").bitwiseXOR(F.col("b2")) == 0)).select("bucket", "node", "pivot"))

        def full_sets(of: DataFrame) -> DataFrame:
            return _sets(rows, of.withColumnRenamed("node", "of").join(nodes.select("node", "row"), F.col("of") == F.col("node")), words)

        likely = _likely(buckets.filter("node <> pivot").groupBy(F.col("node").alias("b")).agg(F.min("pivot").alias("a")), nodes, threshold, margin)
        labels = components(_links(likely, full_sets(likely.select(F.explode(F.array("a", "b")).alias("node")).distinct()), threshold))
        seen = buckets.select("bucket", "node").join(labels.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left").select("bucket", "node", F.coalesce("label", "node").alias("label"))
        mixed = seen.groupBy("bucket", F.xxhash64("bucket").alias("b2")).agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select(F.col("bucket").alias("of"), "b2")
        open_nodes = common.settled(seen.join(mixed, (F.col("bucket") == F.col("of")) & (F.xxhash64("bucket").bitwiseXOR(F.col("b2")) == 0)).groupBy("node").agg(F.min("label").alias("label")))
        sets = full_sets(open_nodes.select("node"))
        pairs = _across(open_nodes, sets, threshold)
        # The second round's links join the first one's components, so only these are put together.
        ends = _links(_likely(pairs, nodes, threshold, margin), sets, threshold)
        for e in "ab":
            ends = ends.join(labels.select(F.col("node").alias(f"of_{e}"), F.col("label").alias(f"label_{e}")), F.col(e) == F.col(f"of_{e}"), "left")
        wider = components(ends.select(F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b")))
        keep += [documents, named, labels, wider]
    groups = named.join(labels.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left").select("id", F.coalesce("label", "node").alias("group"))
    groups = groups.join(wider.select(F.col("node").alias("of"), F.col("label").alias("wide")), F.col("group") == F.col("of"), "left").select(F.col("id").alias("member"), F.coalesce("wide", "group").alias("component"))
    out = documents.select("row", "id", "n").join(groups, F.col("id") == F.col("member"), "left")
    return out.select("row", "id", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))


def representatives(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 5, threshold: float = 0.8, margin: float = 6.0) -> DataFrame:
    """One row, with all its columns, of each group: the one with the smallest id.

    Of rows that repeat a kept id one stays (of the texts that aren't empty that of the least SHA-256); of rows without an id one of each text.
    """
    rows = W.placed(df, id_col, text_col, F.struct("*").alias("own"))
    judged = _judged(rows, words, threshold, margin).withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))
    text = rows.select(F.col("row").alias("at"), F.sha2("raw", 256).alias("sha"), F.octet_length("raw").alias("size"))
    kept = judged.filter("kept").join(text, F.col("row") == F.col("at")).groupBy("id", F.when(F.col("id").isNull(), F.col("sha"))).agg(F.min(F.struct((F.col("size") == 0), "sha", "row")).alias("one"))
    chosen = W.laid(kept.select(F.col("one.row").alias("row")))
    schema = rows.select("own").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        beside = W.Beside(chosen)
        for batch in batches:
            at, _ = beside.of(batch.column("row").to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column("own").take(pa.array(at, pa.int64()))], names=["own"])

    return rows.select("own", "row").mapInArrow(common.lean(run), schema).select("own.*")
