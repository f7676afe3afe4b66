"""Substring dedup over word windows with a count-min prefilter.

A window is a number of consecutive words of one document.  The merged sketch of the windows' anchors (see ``windows``)
overestimates how often a window occurs; only windows whose anchor is estimated to repeat are grouped exactly, word by
word, so none is lost and none goes by a collision.  The document with the smallest id that holds a window keeps it;
everywhere else the words it covers go.  Windows are judged on the input.

Defined cases: null and blank texts have no words; texts shorter than a window keep all; a null id counts as
larger than every id; rows of one id don't remove each other's words (repeated rows among them); an empty table gives no rows;
other columns are ignored.
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

LAST_ID = (1 << 63) - 1


def _cut_words(raw: list[bytes], texts: np.ndarray, first: np.ndarray, stop: np.ndarray) -> list[bytes]:
    split: dict[int, list[bytes]] = {}
    out = []
    for t, a, b in zip(texts.tolist(), first.tolist(), stop.tolist(), strict=True):
        if t not in split:
            split = {t: raw[t].split()}
        out.append(b" ".join(split[t][a:b]))
    return out


def _least(table: pa.Table, owner: str, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For the windows of rows, one after another: row, place in the row, own id, and the least id that has the window.

    Words are numbered exactly.  Windows are put in order by their anchor's hash and a hash of their numbers, and equal
    hashes' numbers are compared word by word; where these differ, the windows are put in order by the numbers themselves.
    """
    numbers: dict[bytes, int] = {}
    hashes = table.column("hash").to_numpy()
    ids = table.column(owner).combine_chunks().fill_null(LAST_ID).to_numpy()
    bodies = table.column("body").to_pylist()
    known: dict[tuple, int] = {}  # equal bodies of an anchor are looked at once, with their least id
    own = np.array([known.setdefault(x, len(known)) for x in zip(hashes.tolist(), bodies, strict=True)], np.int64)
    least_id = np.full(len(known), LAST_ID, np.int64)
    np.minimum.at(least_id, own, ids)
    words = [np.array([numbers.setdefault(w, len(numbers) + 1) for w in body.split(b" ")], np.int64) for _, body in known]
    sizes = np.array([len(w) - span + 1 for w in words], np.int64)
    offset = np.cumsum(sizes) - sizes
    flat = np.concatenate(words) if words else np.empty(0, np.int64)
    places = np.repeat(np.arange(len(words)) * (span - 1), sizes) + np.arange(sizes.sum())  # a window's first word in flat
    group = np.repeat(np.array([h for h, _ in known], np.int64), sizes)
    least = np.empty(len(places), np.int64)
    if len(places):
        hashed = W.gram_hash(W.prefix_hash(W.mix(flat.astype(np.uint64))), span)[places].view(np.int64)
        order = np.lexsort((hashed, group))
        fresh = np.r_[True, (np.diff(hashed[order]) != 0) | (np.diff(group[order]) != 0)]
        view = np.lib.stride_tricks.sliding_window_view(flat, span)
        again = np.flatnonzero(~fresh)
        if any((view[places[order[part]]] != view[places[order[part - 1]]]).any() for part in np.array_split(again, len(again) // 65536 + 1)):
            _, code = np.unique(view[places], axis=0, return_inverse=True)
            order = np.lexsort((code, group))
            fresh = np.r_[True, (np.diff(code[order]) != 0) | (np.diff(group[order]) != 0)]
        edge = np.flatnonzero(fresh)
        least[order] = np.repeat(np.minimum.reduceat(np.repeat(least_id, sizes)[order], edge), np.diff(np.r_[edge, len(places)]))
    n = sizes[own]
    row = np.repeat(np.arange(len(own)), n)
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return row, place, ids[row], least[np.repeat(offset[own], n) + place]


def _grouped(span: int):
    """Rows in order of their anchors' hashes: the spans whose windows occur under a smaller id."""

    def solve(table: pa.Table) -> pa.RecordBatch:
        row, place, ids, least = _least(table, "id", span)
        gone = least < ids
        row, place = row[gone], place[gone]
        starts = np.flatnonzero(np.r_[True, np.diff(row) != 0]) if len(row) else np.empty(0, np.int64)
        owner = row[starts]
        first = table.column("first").to_numpy()[owner]
        low, high = place[starts], place[np.r_[starts[1:], len(row)] - 1] if len(row) else place
        return pa.RecordBatch.from_arrays([table.column("row").combine_chunks().take(pa.array(owner)), pa.array((first + low).astype(np.int32)), pa.array((first + high + span).astype(np.int32))], names=["row", "start", "stop"])

    return common.lean(lambda batches: W.grouped(batches, solve))


def _few(span: int):
    def solve(table: pa.Table) -> pa.RecordBatch:
        row, _, _, least = _least(table, "own", span)
        return W.values_batch(table, least, np.bincount(row, minlength=table.num_rows))

    return common.lean(lambda batches: W.grouped(batches, solve))


RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _cut(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        beside = W.Beside(path)
        for batch in common.slices(batches):
            rows = []
            for raw, spans in zip(batch.column("raw").to_pylist(), W.spans_of(beside, batch.column("row").to_numpy()), strict=True):
                words = raw.split()
                kept, at = [], 0
                for a, b in spans:
                    kept += words[at:a]
                    at = b
                kept += words[at:]
                rows.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return common.lean(run)


def spans(rows: DataFrame, *, span: int = 50, k: int = 12, hot: int = 1024, most: int = 256) -> str:
    """The folder of spans in words, laid beside the texts (``windows.placed``): what to remove."""
    with common.released() as keep:
        usual, often = W.repeated(rows, W.word_symbols, k, span, hot)
        texts = rows.select("row", "id", "raw")
        plain = texts.mapInArrow(W.around(usual, _cut_words, span), W.AROUND).repartition("hash").sortWithinPartitions("hash").mapInArrow(_grouped(span), "row long, start int, stop int")
        found = texts.mapInArrow(W.around(often, _cut_words, span), W.AROUND)
        hot_spans = W.resolve(found, F.coalesce("id", F.lit(LAST_ID)), F.min("owner"), F.min, lambda v: v < F.col("owner"), _few(span), W.halves(lambda b: b.split(b" "), b" ".join, span), span, span - k + 1, most)
        keep.append(W.spans_beside(plain, hot_spans))
    return keep[0]


def dedup(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row."""
    rows = W.placed(df, id_col, text_col)
    return rows.mapInArrow(_cut(spans(rows, **options)), RESULT)
