"""Every operator on nulls, empty and very long texts, ties and repeated rows, empty tables, and clashing extra columns."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import ann, common, licences, mixing, neardup, ogg, sentencepiece, substring, suffix, toxicity, warc

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(60_000))
ROWS = [
    (1, "Plain text of a few words.", "en", "a", 26),
    (1, "Plain text of a few words.", "en", "a", 26),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (None, "A text without an id, you idiot.", "en", "b", 32),
    (4, " \t\n", "en", "b", 3),
    (5, LONG, "en", "b", len(LONG)),
    (6, LONG, "en", None, len(LONG)),
    (7, "é中\U0001f600 ▁ \x85 word", "de", "a", 12),
    (2, "another text under the same id", "en", "c", 30),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["id", "raw", "key", "size", "target", "taken", "score", "spans", "row", "node", "label", "ids", "n", "_text", "hash", "payload"]


def with_clashes(df):
    return df.select("*", *(F.lit("x").alias(c) for c in CLASH))


@pytest.fixture(scope="module")
def docs(spark):
    return with_clashes(spark.createDataFrame(ROWS, SCHEMA))


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, None, None), (None, 1, 1), (4, 0, 1), (4, 0, 0)], "doc_id long, quality int, toxic int")


def count(df, key="doc_id"):
    return len(df.collect())


def test_suffix(docs, none):
    out = [r for r in suffix.dedup(docs).collect()]
    assert len(out) == len(ROWS)
    by = {(r.doc_id, r.n_bytes): r for r in out}
    assert by[5, len(LONG)].n_removed == len(LONG) and by[6, len(LONG)].n_spans == 1
    assert by[3, 0].kept_sha256 == hashlib.sha256(b"").hexdigest() == by[2, 0].kept_sha256
    assert by[1, 26].n_removed == 0 and by[None, 32].n_removed == 0
    assert count(suffix.dedup(none)) == 0
    cleaned = suffix.cleaned(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == len(ROWS)
    assert {r.text for r in cleaned.filter("doc_id in (5, 6)").collect()} == {""}
    assert cleaned.filter("doc_id = 7").first().text == ROWS[8][1]


def test_substring(docs, none):
    by = {(r.doc_id, r.n_words): r for r in substring.dedup(docs).collect()}
    assert by[5, 60_000].n_removed == 0 and by[6, 60_000].n_removed == 60_000
    assert by[2, 0].n_removed == by[3, 0].n_removed == by[4, 0].n_removed == 0
    assert by[7, 4].kept_sha256 == hashlib.sha256(b" ".join(ROWS[8][1].encode().split())).hexdigest()
    assert count(substring.dedup(none)) == 0


def test_near_duplicates(docs, none):
    out = neardup.near_duplicates(docs, words=2).collect()
    assert len(out) == len(ROWS)
    by = {(r.id, r.n_shingles): r for r in out}
    assert by[6, 59_999].component_id == 5 and not by[6, 59_999].kept and by[5, 59_999].kept
    assert by[None, 6].kept and by[None, 6].component_id is None
    assert by[3, 0].component_id == 3 and by[1, 5].kept
    assert count(neardup.near_duplicates(none)) == 0
    kept = neardup.representatives(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {1, 2, 3, 4, 5, 7, None}


def test_toxicity(docs, none, labels, spark):
    out = toxicity.toxicity(docs, labels).collect()
    assert len(out) == len(ROWS) and all(0 <= r.score <= 1 for r in out)
    assert all(r.held_out is not None for r in out)
    assert count(toxicity.toxicity(none, labels)) == 0 and count(toxicity.toxicity(docs, labels.limit(0))) == len(ROWS)
    assert toxicity.clean(docs, labels).columns == docs.columns


def test_mixing(docs, none):
    out = mixing.mix(docs).collect()
    assert len(out) == len(ROWS) and all(r.taken <= 2 * r["size"] for r in out)
    assert {r.doc_id: r.taken for r in out}[3] == 0
    assert count(mixing.mix(none)) == 0
    rows = mixing.mixed_rows(docs)
    assert rows.columns == docs.columns and rows.filter("doc_id in (3, 4)").count() == 0


def test_sentencepiece(docs, none):
    out = sentencepiece.digest(docs, MODEL).collect()
    assert len(out) == len(ROWS) and all(r.exact for r in out)
    assert {r.n_bytes: r.n_tokens for r in out}[0] == 0
    encoded = sentencepiece.encode(docs, MODEL, keep=["doc_id"], ids_col="tokens")
    texts = sorted(r.text for r in sentencepiece.decode(encoded, MODEL, ids_col="tokens").collect())
    assert texts == sorted(r[1] or "" for r in ROWS)
    assert count(sentencepiece.digest(none, MODEL)) == 0


def test_ogg(docs, none):
    out = ogg.probe(ogg.store(docs)).collect()
    assert len(out) == len(ROWS)
    assert sorted(r.n_bytes for r in out) == sorted(len((r[1] or "").encode()) for r in ROWS)
    assert all(r.payload_bytes % 576 == 0 and r.payload_bytes >= 576 for r in out)
    assert len({r.media_sha256 for r in out if r.id in (5, 6)}) == 1
    assert count(ogg.probe(ogg.store(none))) == 0


def test_licences(docs, none, spark):
    assert len(licences.scanned(docs).collect()) == len({r[0] for r in ROWS})
    assert count(licences.scanned(none)) == 0


def test_warc(spark, docs, none):
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit("http://x/\r\n ü").alias("url"), F.col("text").alias("html"), "payload", "size", "id", "hash")
    back = warc.read_archives(warc.write_archives(pages, common.scratch(spark, "t"))).collect()
    assert len(back) == len(ROWS)
    assert sorted((r.page_id or 0, r.record_type) for r in back if r.payload_bytes == 0) == [(2, "revisit"), (3, "response")]
    assert {r.refers_to for r in back if r.record_type == "revisit"} == {3, 6}
    assert [bytes(r.payload).decode() for r in back if r.page_id == 7] == [ROWS[8][1]]
    assert sum(r.page_id == 1 and r.record_type == "response" for r in back) == 2
    assert count(warc.read_archives(warc.write_archives(pages.limit(0), common.scratch(spark, "t")))) == 0


def test_ann(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [None, 1.0]), (7, [2.0, 0.0]), (7, [3.0, 0.0]), (None, [1.0, 1.0]), (8, [1.0, 0.0, 0.0]), (9, []), (10, [float("inf"), 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit(1)).withColumn("part", F.lit(1)).withColumn("score", F.lit(1))
    out = [tuple(r) for r in ann.nearest(df, df, k=3).orderBy("query_id", "rank").collect()]
    assert out == [(1, 1, 2, 0.0), (1, 2, 7, 1.0), (2, 1, 1, 0.0), (2, 2, 7, 1.0), (7, 1, 1, 1.0), (7, 2, 2, 1.0)]
    assert count(ann.nearest(df.limit(0), df.limit(0))) == 0


def test_pipeline_stages(spark, docs, none, labels, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for start in (docs, none):
        df = start
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, df, str(tmp_path)).write.parquet(path := common.scratch(spark, "edge"))
            df = spark.read.parquet(path)
            if i < len(corpus_pipeline.STAGES) - 1:
                assert df.columns == docs.columns
        assert "ids" in df.columns and (start is docs) == (df.count() > 0)
