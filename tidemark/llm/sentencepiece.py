"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

The model file is read on the driver (its path is a parameter) and its pieces and log scores are broadcast as arrays;
their size is the vocabulary's.  A unigram model's scores are used as they are.  A BPE model holds merge ranks instead
of log scores; they become the log probabilities of a Zipf law over the ranks.

Encoding puts the white-space marker U+2581 before the text and in place of each space and takes the segmentation of the
highest summed score.  A character that no piece covers counts as unknown, ten below the lowest score, and turns
into byte pieces.  No piece has a marker after another character, nor a line feed beside anything, which is verified when
the model is read; so the best segmentation of a text is made of those of its chunks, and short chunks are remembered by
worker (up to a number of bytes).  The model's settings for the marker before a text and for extra spaces are followed; a model with a character map is refused.

Decoding joins the pieces, turns byte pieces into bytes, markers into spaces and drops the first one.  A U+2581 of
the text itself is encoded as bytes, so decoding gives back every text exactly (but for spaces that the model has dropped).

Defined cases: null and empty texts give no ids and decode to the empty text; repeated rows are each encoded; texts of
any length are encoded whole; other columns are kept or ignored as asked; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import common

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)  # Fixed values: the kinds of pieces in a model file.
UNKNOWN_PENALTY = 10.0
REMEMBERED, ENTRY, LONGEST = 128 << 20, 250, 200  # bytes of remembered chunks in a worker, of one beside its content, and characters of the longest


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """The (number, value) pairs of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind == 2:
            size = varint()
            yield key >> 3, data[at : at + size]
            at += size
        else:
            size = 8 if kind == 1 else 4
            yield key >> 3, struct.unpack_from("<d" if kind == 1 else "<f", data, at)[0]
            at += size


def read_pieces(path: str) -> tuple[list[tuple[str, float, int]], bool, bool]:
    """(piece, log score, kind) by id, whether texts get a marker before them, and whether extra spaces go, from a model file on the driver.

    A character map, or white space that isn't escaped, is refused: its texts would be encoded wrongly.
    """
    with open(path, "rb") as f:
        data = f.read()
    pieces, unigram, normalizer = [], True, {}
    for number, value in _fields(data):
        if number == 1:
            own = dict(_fields(value))
            pieces.append((own.get(1, b"").decode(), own.get(2, 0.0), own.get(3, NORMAL)))
        elif number == 2:
            unigram = dict(_fields(value)).get(3, 1) == 1
        elif number == 3:
            normalizer = dict(_fields(value))
    # The numbers and defaults of the normalizer's fields.
    charsmap, prefix, shorten, escape = (normalizer.get(n, d) for n, d in ((2, b""), (3, 1), (4, 1), (5, 1)))
    if charsmap or not escape:
        raise ValueError("the model normalizes characters, which isn't supported")
    if unigram:
        return pieces, bool(prefix), bool(shorten)
    total = math.log(sum(1 / (2.7 - s) for _, s, k in pieces if k == NORMAL))
    return [(p, -math.log(2.7 - s) - total if k == NORMAL else s, k) for p, s, k in pieces], bool(prefix), bool(shorten)


@dataclass
class Trie:
    """A double-array trie over bytes: from node n by byte c to base[n] + c if check says n; value is the piece's id."""

    base: array = field(default_factory=lambda: array("i", [0]))
    check: array = field(default_factory=lambda: array("i", [-1]))
    value: array = field(default_factory=lambda: array("i", [-1]))

    @classmethod
    def of(cls, words: dict[bytes, int]) -> Trie:
        nodes: list[dict[int, int]] = [{}]
        ids = [-1]
        for word, number in words.items():
            at = 0
            for c in word:
                if (nxt := nodes[at].get(c)) is None:
                    nxt = nodes[at][c] = len(nodes)
                    nodes.append({})
                    ids.append(-1)
                at = nxt
            ids[at] = number
        trie = cls()
        place, free, queue = {0: 0}, 1, [0]
        for node in queue:
            children = nodes[node]
            if not children:
                continue
            low = min(children)
            at = max(1, free - low)
            while True:
                need = at + 256 + 1 - len(trie.check)
                if need > 0:
                    trie.check.extend([-1] * need)
                    trie.base.extend([0] * need)
                    trie.value.extend([-1] * need)
                if all(trie.check[at + c] < 0 for c in children):
                    break
                at += 1
            own = place[node]
            trie.base[own] = at
            for c, child in children.items():
                place[child] = at + c
                trie.check[at + c] = own
                trie.value[at + c] = ids[child]
                queue.append(child)
            while trie.check[free] >= 0:
                free += 1
            if at + low - free > 4096:  # leave thin gaps behind
                free = at + low - 4096
        return trie


@dataclass
class Model:
    pieces: list[tuple[str, float, int]]
    trie: Trie
    digest: str
    prefix: bool = True
    shorten: bool = False

    @classmethod
    def load(cls, path: str) -> Model:
        pieces, prefix, shorten = read_pieces(path)
        words = {p.encode(): i for i, (p, _, k) in enumerate(pieces) if k in (NORMAL, USER)}
        if any(MARK in p.lstrip(MARK) or ("\n" in p and len(p) > 1) for p, _, k in pieces if k in (NORMAL, USER)):
            raise ValueError("a piece reaches over a word's end")
        if sum(k == BYTE for *_, k in pieces) != 256:
            raise ValueError("the model has no byte pieces")
        return cls(pieces, Trie.of(words), hashlib.sha256(repr((pieces, prefix, shorten)).encode()).hexdigest(), prefix, shorten)


class Codec(dict):
    """Encoder and decoder of one model; as a dictionary, the remembered chunks."""

    CHUNK = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")

    def __init__(self, model: Model):
        super().__init__()
        self.prefix, self.shorten, self.held = model.prefix, model.shorten, 0
        self.base, self.check, self.value = list(model.trie.base), list(model.trie.check), list(model.trie.value)
        # A piece of the user's costs next to nothing, so it is taken wherever it stands.
        most = max([0.0, *(s for _, s, k in model.pieces if k == NORMAL)])
        self.scores = [len(p.encode()) * most - 0.1 if k == USER else s for p, s, k in model.pieces]
        self.unknown = min(s for _, s, k in model.pieces if k == NORMAL) - UNKNOWN_PENALTY
        self.byte_id = [0] * 256
        self.as_bytes = []
        for i, (p, _, k) in enumerate(model.pieces):
            if k == BYTE:
                self.byte_id[int(p[3:5], 16)] = i
                self.as_bytes.append(bytes([int(p[3:5], 16)]))
            else:
                self.as_bytes.append(b"" if k == CONTROL else p.replace(MARK, " ").encode())

    def __missing__(self, chunk: str) -> tuple[int, ...]:
        ids = tuple(self.viterbi(chunk.encode()))
        if len(chunk) <= LONGEST:
            self.held += ENTRY + 4 * len(chunk) + 8 * len(ids)
            if self.held > REMEMBERED:
                self.clear()
                self.held = 0
            self[chunk] = ids
        return ids

    def viterbi(self, data: bytes) -> list[int]:
        """Ids of the best segmentation of a chunk; of equal scores the one with the longer last piece."""
        base, check, value, scores = self.base, self.check, self.value, self.scores
        size = len(data)
        best = [-math.inf] * (size + 1) if size <= LONGEST * 4 else array("d", [-math.inf]) * (size + 1)
        best[0] = 0.0
        begin, piece = ([0] * (size + 1), [-1] * (size + 1)) if size <= LONGEST * 4 else (array("i", [0]) * (size + 1), array("i", [-1]) * (size + 1))
        for start in range(size):
            so_far = best[start]
            if so_far == -math.inf:
                continue
            lead = data[start]
            width = 1 if lead < 128 else 2 if lead < 224 else 3 if lead < 240 else 4
            node, single = 0, False
            for at in range(start, size):
                nxt = base[node] + data[at]
                if check[nxt] != node:
                    break
                node = nxt
                if (number := value[node]) >= 0:
                    end = at + 1
                    if end - start == width:
                        single = True
                    if (score := so_far + scores[number]) > best[end]:
                        best[end], begin[end], piece[end] = score, start, number
                if not base[node]:
                    break
            if not single and (score := so_far + self.unknown) > best[start + width]:
                best[start + width], begin[start + width], piece[start + width] = score, start, -1
        ids, end = [], size
        while end:
            start, number = begin[end], piece[end]
            ids.extend((number,) if number >= 0 else [self.byte_id[b] for b in reversed(data[start:end])])
            end = start
        return ids[::-1]

    def encode(self, text: str | None) -> list[int]:
        if text and self.shorten:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return []
        first, *rest = text.split(MARK)
        ids = list(chain.from_iterable(map(self.__getitem__, self.CHUNK.findall(MARK * self.prefix + first.replace(" ", MARK)))))
        for part in rest:  # a marker of the text's own
            ids += [self.byte_id[b] for b in MARK.encode()]
            ids += chain.from_iterable(map(self.__getitem__, self.CHUNK.findall(part.replace(" ", MARK))))
        return ids

    def decode(self, ids: list[int] | None) -> str:
        data = b"".join(map(self.as_bytes.__getitem__, ids or ()))
        return (data.removeprefix(b" ") if self.prefix else data).decode("utf-8", "replace")


_held: dict[str, Codec] = {}


def codec(model: Model) -> Codec:
    """This worker's codec of a model."""
    if model.digest not in _held:
        _held.clear()
        _held[model.digest] = Codec(model)
    return _held[model.digest]


def encode(df: DataFrame, model_path: str, *, text_col: str = "text", ids_col: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """The kept columns (all but the text where none are named) and the ids of each text."""
    keep = [c for c in df.columns if c != text_col] if keep is None else keep
    shared = df.sparkSession.sparkContext.broadcast(Model.load(model_path))
    schema = df.select(*keep).schema.add(ids_col, T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(shared.value)
        for batch in common.slices(batches):
            ids = [c.encode(t) for t in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), pa.array(ids, pa.list_(pa.int32()))], names=[*keep, ids_col])

    return df.select(*keep, F.col(text_col).cast("string").alias("_encoded_text")).mapInArrow(common.lean(run), schema)


def decode(df: DataFrame, model_path: str, *, ids_col: str = "ids", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns and the text of each list of ids; null ids give the empty text."""
    keep = [c for c in df.columns if c != ids_col] if keep is None else keep
    shared = df.sparkSession.sparkContext.broadcast(Model.load(model_path))
    schema = df.select(*keep).schema.add(text_col, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(shared.value)
        for batch in batches:
            texts = [c.decode(x) for x in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), pa.array(texts, pa.string())], names=[*keep, text_col])

    return df.select(*keep, F.col(ids_col).alias("_decoded_ids")).mapInArrow(common.lean(run), schema)


DIGEST = "n_bytes long, n_tokens long, n_byte_tokens long, ids_sha256 string, exact boolean"


def digest(df: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Both ways in one pass: sizes, the SHA-256 of the ids as 32-bit little-endian numbers, and whether decoding them gives the text."""
    shared = df.sparkSession.sparkContext.broadcast(Model.load(model_path))
    names = [id_col, *(x.split()[0] for x in DIGEST.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(shared.value)
        low, high = min(c.byte_id), max(c.byte_id)
        for batch in common.slices(batches):
            rows = []
            for text in batch.column(1).to_pylist():
                ids = array("i", c.encode(text))
                n_byte = sum(low <= i <= high for i in ids) if high - low == 255 else sum(i in c.byte_id for i in ids)
                rows.append((len((text or "").encode()), len(ids), n_byte, hashlib.sha256(ids.tobytes()).hexdigest(), c.decode(ids) == (text or "")))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))], names=names)

    return df.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("_t")).mapInArrow(common.lean(run), f"{id_col} long, {DIGEST}")
