"""Toxicity by a weighted lexicon, matched with Aho-Corasick over folded text.

Folding lower-cases, maps look-alike letters of other scripts and digits used as letters to plain letters, drops
zero-width characters and turns everything else that is no letter into a blank.  The lexicon holds words and beginnings of words;
its weights are lower confidence bounds of the log ratio of how often toxic and clean labelled documents use them.  A hit inside an
exception phrase doesn't count: such phrases are named, or learned as those that only clean labelled texts use.  Summed weights and the same divided by the square root of the number of words go
into a logistic curve that is fitted to the labels as well.

Learning reads at most ``max_rows`` labelled documents (those with the smallest hashes of their ids), so the sample, the
lexicon out of it and what is broadcast are bounded at any size; scoring reads every whole text, with no shuffle.

Defined cases: null and empty texts score as texts without hits; a null id is held out as the empty string would be;
null labels are skipped and of several labels of one document the largest counts; repeated rows are scored each; with
no labels of either class the lexicon is empty and every score is the base rate's; further columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

# Letters of other scripts and digits or signs that stand for Latin letters.
LOOKALIKES = "аaеeоoрpсcхxуyіiјjѕsԁdһhԛqԝwкkмmтtвbнhαaεeοoρpνvιiκkτtυu"
DIGITS = "0o1i3e4a5s7t8b9g@a$s"
ZERO_WIDTH = "​‌‍⁠﻿­"
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "class clown", "sore loser penalty", "idiot proof")
LENGTHS = range(3, 9)


class _Fold(dict):
    """Translation table that fills itself."""

    def __missing__(self, code: int):
        c = chr(code)
        if 0xFF01 <= code <= 0xFF5E:  # full-width forms
            c = chr(code - 0xFEE0).lower()
        self[code] = value = c if c.isalpha() else " "
        return value


def fold_table() -> dict:
    table = _Fold({ord(a): b for pairs in (LOOKALIKES, DIGITS) for a, b in zip(pairs[::2], pairs[1::2], strict=True)})
    table.update({ord(c): None for c in ZERO_WIDTH})
    return table


def fold(text: str, table: dict) -> str:
    return text.lower().translate(table)


@dataclass
class Model:
    terms: dict[str, float]
    exceptions: tuple[str, ...]
    bias: float
    total: float
    dense: float


class Matcher:
    """The automaton of a model's terms and exception phrases."""

    def __init__(self, terms: dict[str, float], exceptions: tuple[str, ...]):
        self.table, self.automaton = fold_table(), ahocorasick.Automaton()
        for term, weight in terms.items():
            self.automaton.add_word(" " + term, (len(term), weight))
        for phrase in exceptions:
            folded = " " + " ".join(fold(phrase, self.table).split())
            self.automaton.add_word(folded, (len(folded) - 1, None))
        self.empty = len(self.automaton) == 0
        if not self.empty:
            self.automaton.make_automaton()

    def features(self, text: str | None) -> tuple[float, int]:
        """(summed weights of hits outside exception phrases, number of words)."""
        words = fold(text or "", self.table).split()
        hits, spared = [], []
        for end, (size, weight) in () if self.empty else self.automaton.iter(f" {' '.join(words)} "):
            if weight is None:
                if spared and end - size <= spared[-1][1]:  # ends come in order
                    spared[-1] = (min(spared[-1][0], end - size), end)
                else:
                    spared.append((end - size, end))
            else:
                hits.append((end, weight))
        total, at = 0.0, 0
        for end, weight in hits:  # and so do hits
            while at < len(spared) and spared[at][1] < end - 1:  # a term may end with the blank after its word
                at += 1
            if at == len(spared) or end < spared[at][0]:
                total += weight
        return total, len(words)


def _x(total: float, n: int) -> tuple[float, float]:
    return math.log1p(max(total, 0.0)), total / math.sqrt(n + 1)


def held_out(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _terms(word: str) -> set[str]:
    """A word's beginnings, and the whole word (with a blank after it)."""
    return {word[:k] for k in LENGTHS if k <= len(word)} | {word + " "}


def _counts(sample: DataFrame, only: set[str] | None) -> DataFrame:
    """(term, n, times): in how many of the texts each term occurs, and how often in all; the empty term counts all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, found, times = fold_table(), Counter(), Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                own = Counter()
                for word, n in Counter(fold(text or "", table).split()).items():
                    own[""] += n
                    for term in _terms(word):
                        if only is None or term in only:
                            own[term] += n
                found.update(own.keys())
                times.update(own)
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64()), pa.array([times[t] for t in found], pa.int64())], names=["term", "n", "times"])

    return sample.select("text").mapInArrow(common.lean(run), "term string, n long, times long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("times").alias("times"))


def _signatures(sample: DataFrame, size: int = 16) -> DataFrame:
    """(at, signature): minima of ``size`` hash functions over the words of each sampled text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odd = np.random.default_rng(7).integers(1, 1 << 62, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                codes = np.array([zlib.crc32(w) for w in set((text or "").encode().split())] or [0], dtype=np.uint64)
                rows.append((codes[:, None] * odd[None, :] >> np.uint64(31)).min(axis=0).astype(np.int64).tolist())
            yield pa.RecordBatch.from_arrays([batch.column("at"), pa.array(rows, pa.list_(pa.int64()))], names=["at", "signature"])

    return sample.select("at", "text").mapInArrow(common.lean(run), "at long, signature array<long>")


def _distinct(signatures: np.ndarray, least: int = 6) -> np.ndarray:
    """Which rows stay when of rows that agree in at least ``least`` places only the first is kept."""
    stays = np.ones(len(signatures), dtype=bool)
    for column in signatures.T:
        order = np.argsort(column, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(column[order]) != 0])
        first = np.repeat(order[starts], np.diff(np.r_[starts, len(order)]))
        same = (signatures[order] == signatures[first]).sum(axis=1) >= least
        stays[order[same & (order != first)]] = False
    return stays


def _surprise(a: int, b: int, base: float) -> float:
    """How unlikely it is, as a negative logarithm, that so many of the a + b documents with a term are toxic."""
    p = a / (a + b)
    if p <= base:
        return 0.0
    return (a + b) * (p * math.log(p / base) + ((1 - p) * math.log((1 - p) / (1 - base)) if b else 0.0))


def lexicon(toxic: dict[str, tuple[int, int]], clean: dict[str, tuple[int, int]], n_toxic: int, n_clean: int, *, least_weight: float) -> dict[str, float]:
    """Words and beginnings of words that toxic texts surely use more often, none of which begins another.

    A term's weight is the logarithm of its rates' ratio, less a margin for the number of documents that tell it.  A term must be more
    surprising than the best of that many candidates would be by chance.  Of nested terms the longest one stays that is about as frequent as the best.
    """
    scored: dict[str, tuple[float, int]] = {}
    base, needed = n_toxic / max(1, n_toxic + n_clean), math.log(10 * max(1, len(toxic)))
    words, others = (max(1, x.get("", (0, 0))[1]) for x in (toxic, clean))
    for term, (a, times) in toxic.items():
        b, elsewhere = clean.get(term, (0, 0))
        ratio = math.log((times + 0.5) / words * others / (elsewhere + 0.5))
        weight = ratio - 1.64 * math.sqrt(1 / (a + 0.5) + (1 / (b + 0.5) if b else 1))
        if term and weight >= least_weight and _surprise(a, b, base) >= needed:
            scored[term] = (weight, a)
    kept: dict[str, float] = {}
    barred: set[str] = set()
    for term in sorted(scored, key=lambda t: (-scored[t][0] * scored[t][1], t)):
        if term in barred or any(term[:k] in kept for k in range(1, len(term))):
            continue
        best = max((t for t in scored if t.startswith(term) and scored[t][1] >= 0.95 * scored[term][1]), key=lambda t: (len(t), scored[t]))
        kept[best] = scored[best][0]
        barred.update(best[:k] for k in range(1, len(best) + 1))
    return dict(sorted(kept.items()))


def spared(sample: DataFrame, terms: dict[str, float], *, least: int = 3) -> tuple[str, ...]:
    """Two-word phrases with a term in them that ``least`` clean texts of the sample use and no toxic one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, found = fold_table(), [Counter(), Counter()]
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                words = fold(text or "", table).split()
                hit = [any(t in terms for t in _terms(w)) for w in words]
                found[toxic].update({f"{a} {b}" for a, b, x, y in zip(words, words[1:], hit, hit[1:], strict=False) if x or y})
        yield pa.RecordBatch.from_arrays([pa.array([p for own in found for p in own], pa.string()), pa.array([n for own in found for n in own.values()], pa.int64()), pa.array([i for i, own in enumerate(found) for _ in own], pa.int32())], names=["phrase", "n", "toxic"])

    told = sample.select("text", "toxic").mapInArrow(common.lean(run), "phrase string, n long, toxic int").groupBy("phrase").agg(F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("clean"), F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"))
    return tuple(sorted(r["phrase"] for r in told.filter((F.col("clean") >= least) & (F.col("toxic") == 0)).select("phrase").collect()))


def _fit(rows: list[tuple[float, float, int]], ridge: float = 0.05) -> np.ndarray:
    """Bias and two weights by Newton's method."""
    x = np.array([[1.0, a, b] for a, b, _ in rows]).reshape(-1, 3)
    y = np.array([r[2] for r in rows], dtype=float)
    w = np.zeros(3)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(3), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-7:
            break
    return w


def learn(documents: DataFrame, labels: DataFrame, *, max_rows: int = 20_000, least_weight: float = 1.3, min_documents: int = 3, exceptions: tuple[str, ...] = EXCEPTIONS) -> Model:
    """Lexicon and curve from labelled documents that aren't held out."""
    spark = documents.sparkSession
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows).collect()  # bounded by max_rows
    if len({r["toxic"] > 0 for r in chosen}) < 2:
        rate = (sum(r["toxic"] > 0 for r in chosen) + 0.5) / (len(chosen) + 1)
        return Model({}, exceptions, math.log(rate / (1 - rate)), 0.0, 0.0)
    chosen_df = spark.createDataFrame([(r["doc_id"], int(r["toxic"] > 0)) for r in chosen], "doc_id long, toxic int")
    labelled = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen_df), "doc_id")
    # Of rows that repeat an id one is learned from, so there are at most max_rows.
    single = labelled.groupBy("doc_id").agg(F.min_by(F.struct("text", "toxic"), F.xxhash64("text")).alias("one"))
    drawn = common.settled(single.select(F.col("doc_id").alias("at"), "one.text", "one.toxic"))
    # Copies of one document are one piece of evidence.  max_rows bounds what comes to the driver.
    seen = _signatures(drawn).collect()
    stays = _distinct(np.array([r["signature"] for r in seen], dtype=np.int64).reshape(len(seen), -1)) if seen else []
    apart = spark.createDataFrame([(r["at"],) for r, ok in zip(seen, stays, strict=True) if ok], "at long")
    sample = drawn.join(F.broadcast(apart), "at")
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    counted = _counts(sample.filter("toxic = 1"), None).filter(F.col("n") >= min_documents).collect()
    toxic = {r["term"]: (r["n"], r["times"]) for r in counted}
    clean = {r["term"]: (r["n"], r["times"]) for r in _counts(sample.filter("toxic = 0"), set(toxic)).collect()}
    terms = lexicon(toxic, clean, sizes.get(1, 0), sizes.get(0, 0), least_weight=least_weight)
    exceptions = (*exceptions, *(p for p in spared(sample, terms) if p not in exceptions))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(terms, exceptions)
        for batch in batches:
            rows = [_x(*matcher.features(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.float64()), pa.array([r[1] for r in rows], pa.float64()), batch.column("toxic")], names=["a", "b", "toxic"])

    fitted = _fit([tuple(r) for r in sample.mapInArrow(common.lean(run), "a double, b double, toxic int").collect()])
    return Model(terms, exceptions, *map(float, fitted))


def score(df: DataFrame, model: Model, *, keep: list[str], text_col: str = "text", score_col: str = "score") -> DataFrame:
    """The kept columns and the score, the probability of label 1."""
    schema = df.select(*keep).schema.add(score_col, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model.terms, model.exceptions)
        for batch in common.slices(batches):
            scores = []
            for text in batch.column(len(keep)).to_pylist():
                a, b = _x(*matcher.features(text))
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, model.bias + model.total * a + model.dense * b)))))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), pa.array(scores, pa.float64())], names=[*keep, score_col])

    return df.select(*keep, F.col(text_col).cast("string").alias("_scored_text")).mapInArrow(common.lean(run), schema)


def clean(documents: DataFrame, labels: DataFrame, *, threshold: float = 0.7, **options) -> DataFrame:
    """The rows whose score stays below the threshold, with the input's columns."""
    model = learn(documents, labels, **options)
    return score(documents, model, keep=documents.columns, score_col="_toxicity").filter(F.col("_toxicity") < threshold).drop("_toxicity")


def toxicity(documents: DataFrame, labels: DataFrame, *, threshold: float = 0.7, **options) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    model = learn(documents, labels, **options)
    return score(documents, model, keep=["doc_id"]).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
