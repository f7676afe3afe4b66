"""Operators against plain versions on small tables."""

from __future__ import annotations

import hashlib
import math
import re
import struct
import textwrap
import time
import zlib
from collections import Counter, defaultdict
from random import Random

import numpy as np
import pytest
import sentencepiece as library
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import ann, common, components, licences, mixing, neardup, ogg, sentencepiece, substring, suffix, toxicity, warc
from tidemark.llm import windows as W

SF = "/root/testdata/sf0.001"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def docs(spark):
    r = Random(5)
    words = [f"{a}{b}{c}" for a in "abcdef" for b in "xyzuv" for c in "klmn"]
    passage = " ".join(r.choice(words) for _ in range(90))
    made = []
    for i in range(40):
        text = " ".join(r.choice(words) for _ in range(r.randrange(0, 250)))
        if i % 3 == 0:
            at = r.randrange(0, len(text) + 1)
            text = f"{text[:at]} {passage} {text[at:]}"
        made.append((10_000 + i, text))
    base = made[3][1].split() or ["x"]
    for i in range(30):  # near copies, some beyond the threshold
        copy = list(base)
        for _ in range(i % 12):
            copy[r.randrange(len(copy))] = r.choice(words)
        made.append((11_000 + i, " ".join(copy)))
    made += [(12_000, "ab" * 400), (12_001, "a" * 900), (12_002, "z " * 500), (12_003, made[5][1]), (12_004, made[5][1] + " end")]
    frame = spark.createDataFrame(made, "doc_id long, text string")
    return common.table(spark, SF, "documents").select("doc_id", "text").unionByName(frame).cache()


@pytest.fixture(scope="module")
def texts(docs):
    return [(r.doc_id, (r.text or "").encode()) for r in docs.orderBy("doc_id").collect()]


@pytest.mark.parametrize(("hot", "most"), [(1024, 256), (3, 256), (3, 2)])
def test_suffix_equals_counting_every_string(docs, texts, hot, most):
    seen = Counter(w[a : a + 200] for _, w in texts for a in range(len(w) - 199))
    got = {r.doc_id: tuple(r) for r in suffix.dedup(docs, hot=hot, most=most).collect()}
    for name, w in texts:
        gone = np.zeros(len(w) + 1, np.int8)
        for a in range(len(w) - 199):
            if seen[w[a : a + 200]] > 1:
                gone[a : a + 200] = 1
        kept = bytes(c for c, g in zip(w, gone, strict=False) if not g)
        runs = int((np.diff(np.r_[0, gone]) == 1).sum())
        assert got[name] == (name, len(w), len(w) - len(kept), runs, hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize(("hot", "most"), [(1024, 256), (2, 256), (2, 1)])
def test_substring_equals_indexing_every_window(docs, texts, hot, most):
    first: dict = {}
    for name, w in texts:
        words = w.split()
        for a in range(len(words) - 49):
            first.setdefault(tuple(words[a : a + 50]), name)
    got = {r.doc_id: tuple(r) for r in substring.dedup(docs, hot=hot, most=most).collect()}
    for name, w in texts:
        words = w.split()
        gone = [False] * len(words)
        for a in range(len(words) - 49):
            if first[tuple(words[a : a + 50])] < name:
                gone[a : a + 50] = [True] * 50
        kept = [x for x, g in zip(words, gone, strict=True) if not g]
        assert got[name] == (name, len(words), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest())


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_equal_comparing_all_pairs(docs, texts, size):
    sets, parent = {}, {}
    for name, w in texts:
        words = w.translate(neardup.LOWER).split()
        sets[name] = {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()
        parent[name] = name

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    names = sorted(sets)
    for i, x in enumerate(names):
        for y in names[:i]:
            p, q = sets[x], sets[y]
            if p and q and min(len(p), len(q)) * 100 >= 80 * max(len(p), len(q)):
                both = len(p & q)
                if 100 * both >= 80 * (len(p) + len(q) - both):
                    a, b = sorted((find(x), find(y)))
                    parent[b] = a
    got = {r.id: tuple(r) for r in neardup.near_duplicates(docs, words=size).collect()}
    for x in names:
        assert got[x] == (x, len(sets[x]), find(x), find(x) == x)


def test_registers_of_a_union_are_maxima_and_likelihood_finds_the_similarity():
    r = np.random.default_rng(1)
    a, b = (r.integers(0, 1 << 63, n, dtype=np.uint64) for n in (1500, 900))
    both = r.integers(0, 1 << 63, 2600, dtype=np.uint64)
    x, y = np.r_[a, both], np.r_[b, both]
    rx, ry = neardup.registers(x), neardup.registers(y)
    assert (neardup.registers(np.r_[x, y]) == np.maximum(rx, ry)).all()
    guess = neardup.likeliest(np.array([(rx > ry).sum()]), np.array([(rx < ry).sum()]), np.array([float(len(x))]), np.array([float(len(y))]))[0]
    assert abs(guess - 2600 / 5000) < 0.2


@pytest.mark.parametrize("shared", [10, 14, 17])
def test_thousands_of_dissimilar_sets_of_one_template(spark, shared):
    """All share a template, so buckets hold them together; the few pairs that are similar are found, and others aren't even paired."""
    r = Random(shared)
    template = [f"t{i}" for i in range(shared * 5)]
    texts = [" ".join(template + [f"u{n}x{i}" for i in range(100 - shared * 5)]) for n in range(1500)]
    texts += [t.replace("x0", "y0") for t in texts[:40]]
    names = list(range(len(texts)))
    r.shuffle(names)
    df = spark.createDataFrame(list(zip(names, texts, strict=True)), "doc_id long, text string")
    got = {x.id: x.component_id for x in neardup.near_duplicates(df, words=1).collect()}
    for n in range(1500):
        want = min(names[n], names[1500 + n]) if n < 40 else names[n]
        assert got[names[n]] == want and (n >= 40 or got[names[1500 + n]] == want)


def test_representatives_keep_one_row_of_repeated_ones(spark):
    rows = [(1, "the same long text of some words", "a")] * 1000 + [(2, "the same long text of some words", "a"), (3, "another text of its own here", "b")] + [(None, "no id at all in this text", "c")] * 5 + [(4, "", None)] * 3
    out = neardup.representatives(spark.createDataFrame(rows, "doc_id long, text string, id string")).collect()
    assert sorted(map(str, (tuple(r) for r in out))) == sorted(map(str, [(1, rows[0][1], "a"), (3, rows[1001][1], "b"), (None, rows[1002][1], "c"), (4, "", None)]))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(51)) and all(got[i] == 100 for i in range(100, 140)) and got[201] == 200


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=40), min_size=1, max_size=30), st.integers(1, 3))
def test_the_hash_compared_sort_is_the_sort_by_bytes(strings, groups):
    strings = [s.replace(b"\xff", b"a") for s in strings]
    group = np.sort(np.arange(len(strings)) % groups)
    size = np.array([len(s) for s in strings], np.int64)
    order, common_bytes = suffix.Suffixes(np.frombuffer(b"".join(strings), np.uint8), np.cumsum(size) - size, size).sort(group)
    for g in range(groups):
        own = [i for i in range(len(strings)) if group[i] == g]
        got = [strings[i] for i in order if group[i] == g]
        assert got == sorted(strings[i] for i in own)
    for p in range(1, len(strings)):
        if group[order[p]] == group[order[p - 1]]:
            a, b = strings[order[p - 1]], strings[order[p]]
            assert common_bytes[p] == next((i for i, (s, t) in enumerate(zip(a, b, strict=False)) if s != t), min(len(a), len(b)))


def test_collisions_are_found_and_sorted_by_bytes(monkeypatch):
    monkeypatch.setattr(W, "BYTE_SYMBOLS", np.zeros(256, np.uint64))  # every string of a length looks alike
    strings = [b"banana", b"apple", b"cherry", b"apple pie"]
    size = np.array([len(s) for s in strings])
    order, n = suffix.Suffixes(np.frombuffer(b"".join(strings), np.uint8), np.cumsum(size) - size, size).sort(np.zeros(4, int))
    assert [strings[i] for i in order] == sorted(strings) and n.tolist() == [-1, 5, 0, 0]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=30, max_size=300))
def test_each_window_has_one_anchor_at_an_offset_of_its_own(symbols):
    x = W.mix(np.array(symbols, np.uint64) + np.uint64(1))
    seen, owner = {}, defaultdict(int)
    for a in W.anchors([x], 4, 20):
        for at, first, last, h in zip(a.at, a.first, a.last, a.hash, strict=True):
            for p in range(first, last + 1):
                owner[p] += 1
                assert p <= at <= p + 16
                assert seen.setdefault(tuple(symbols[p : p + 20]), (at - p, h)) == (at - p, h)
    assert owner == {p: 1 for p in range(len(symbols) - 19)}


def test_word_hashes_cut_as_python_does():
    text = b"one two\x0btwo \xc2\x85 one\r\n\tthree"
    h = W.word_symbols(text)
    words = text.split()
    assert len(h) == len(words) and all((h[i] == h[j]) == (words[i] == words[j]) for i in range(len(h)) for j in range(len(h)))


@pytest.mark.parametrize("options", [{}, {"shard_rows": 40, "leaf": 8, "most_cells": 4, "sample_rows": 100}])
def test_ann_recall(spark, options):
    df = common.table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = df.collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    hits = total = 0
    got = defaultdict(list)
    for r in ann.nearest(df, df.filter("vec_id % 10 = 0"), **options).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    for q, found in got.items():
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1))
        d[ids == q] = np.inf
        best = ids[np.lexsort((ids, d))][:10]
        hits += len({v for v, _ in found} & set(best.tolist()))
        total += 10
        assert all(abs(d[ids == v][0] - s) < 1e-12 for v, s in found)
    verified = ann.visits(df, df.filter("vec_id % 10 = 0"), **options).agg(F.sum("verified")).first()[0]
    assert len(got) == 200 and hits / total >= 0.9 and (options or verified < 0.8 * len(got) * len(ids))


def test_ann_ties_go_to_smaller_ids(spark):
    rows = [(i, [1.0, 0.0, 0.0, 0.0]) for i in range(500, 0, -1)] + [(1000 + i, [0.0, 1.0, 0.0, i / 1000]) for i in range(50)] + [(7, [1.0, 0.0, 0.0, 0.0])] * 30
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in ann.nearest(df, df.filter("vec_id in (1, 2, 400, 1000)"), shard_rows=16).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    first = list(range(1, 12))
    assert got[1] == first[1:] and got[2] == [1, *first[2:]] and got[400] == first[:10] and len(got[1000]) == 10


def test_chi_square_quantile():
    assert ann.chi_square_quantile(0.95, 8) == pytest.approx(15.507313, abs=1e-5)
    with pytest.raises(ValueError):
        ann.chi_square_quantile(0.5, 3)


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    labels = common.table(spark, sf, "labels")
    out = toxicity.toxicity(common.table(spark, sf, "documents"), labels).join(labels, "doc_id").filter("held_out")
    n = {(r.toxic, r.predicted): r["count"] for r in out.groupBy("toxic", "predicted").count().collect()}
    assert n.get((0, 1), 0) <= 0.005 * n[0, 0] and n[1, 1] >= 0.9 * (n[1, 1] + n.get((1, 0), 0))


def test_folding_and_exceptions():
    m = toxicity.Matcher({"idiot": 2.0}, ("idiot proof",))
    assert m.features("You 1D10T! and idi​ot, іdіоt")[0] == 6.0
    assert m.features("An idiot-proof tool")[0] == 0.0
    assert m.features(None) == (0, 0)


def test_toxicity_query_is_the_plain_score(spark):
    """The query against folding, matching and the curve written plainly, for every document."""
    sf = "/root/testdata/sf0.01"
    docs, labels = common.table(spark, sf, "documents"), common.table(spark, sf, "labels")
    model = toxicity.learn(docs, labels)
    table = toxicity.fold_table()
    phrases = [" ".join(toxicity.fold(p, table).split()) for p in model.exceptions]
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    for row in docs.collect():
        words = toxicity.fold(row.text or "", table).split()
        text, total = f" {' '.join(words)} ", 0.0
        inside = [False] * len(text)
        for p in phrases:
            for m in re.finditer(f"(?= {re.escape(p)})", text):
                inside[m.start() : m.start() + len(p) + 1] = [True] * (len(p) + 1)
        at = 0
        for w in words:
            total += sum(v for t, v in model.terms.items() if f"{w} ".startswith(t) and not inside[at + min(len(t), len(w))])
            at += len(w) + 1
        x = model.bias + model.total * math.log1p(max(total, 0.0)) + model.dense * total / math.sqrt(len(words) + 1)
        score = 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))
        r = got[row.doc_id]
        assert abs(r.score - score) < 1e-9 and r.predicted == (r.score >= 0.7) and r.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1)


def test_many_exceptions_take_linear_time():
    m = toxicity.Matcher({"trash ": 2.0, "idiot": 1.0}, ("trash can", "can trash"))
    began = time.perf_counter()
    assert m.features("trash can foo " * 100_000)[0] == 0.0 and m.features("trash foo " * 100_000)[0] == 200_000.0
    assert time.perf_counter() - began < 5
    assert m.features("trash can trash x trash")[0] == 2.0 and m.features("idiots trash cans")[0] == 1.0


def test_phrases_of_clean_texts_are_learned(spark):
    rows = [("a clown fish swims", 0)] * 3 + [("you clown fool", 1), ("clown fish idiot", 0), ("idiot savant", 0), ("idiot savant", 0), ("idiot savant", 0), ("idiot savant", 1)]
    assert toxicity.spared(spark.createDataFrame(rows, "text string, toxic int"), {"clown ": 1.0, "idiot": 1.0}) == ("a clown", "clown fish")


def test_mixing_pours_water(spark):
    sizes = spark.createDataFrame([("sa", 100), ("sb", 10), ("sc", 1000), ("n", 0)], "_key string, source_size long")
    got = {r._key: r.target for r in mixing.targets(sizes).collect()}
    caps, weights, total = {"sa": 200.0, "sb": 20.0, "sc": 2000.0, "n": 0.0}, {"sa": 3, "sb": 1, "sc": 2, "n": 3}, 1665.0
    full: set = set()
    while True:  # clamp, and pour what is over on the others by weight
        left = total - sum(caps[k] for k in full)
        share = {k: left * w / sum(v for j, v in weights.items() if j not in full) for k, w in weights.items() if k not in full}
        over = {k for k, v in share.items() if v > caps[k]}
        if not over:
            break
        full |= over
    assert got == pytest.approx({k: caps[k] if k in full else share[k] for k in caps})


def test_mixed_rows_hold_the_taken_words(spark):
    df = spark.createDataFrame([(i, " ".join(["w"] * (i % 17 + 1)), "s" if i % 3 else None, 0) for i in range(200)], "doc_id long, text string, source string, n_chars long")
    plan = mixing.mix(df).groupBy("doc_id").agg(F.first("taken").alias("taken"))
    rows = mixing.mixed_rows(df).groupBy("doc_id").agg(F.sum(mixing.words(F.col("text"))).alias("n"))
    assert plan.join(rows, "doc_id", "left").filter("coalesce(n, 0) <> taken").count() == 0


def test_mixed_rows_keep_white_space(spark):
    text = " line one\n\nline\ttwo  end\n"
    df = spark.createDataFrame([(i, text, s) for s in "abc" for i in range(40)], "doc_id long, text string, source string")
    out = {r.text for r in mixing.mixed_rows(df).collect()}
    assert text in out and all(text.startswith(x) for x in out) and len(out) <= 4


@pytest.mark.parametrize("bin_rows", [1, 7, 4096])
def test_mixing_takes_the_first_of_a_seeded_order(spark, bin_rows):
    r = Random(3)
    rows = [(i % 300, " ".join(["w"] * r.randrange(0, 30)), r.choice(["a", "a", "a", "b", None])) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df, bin_rows=bin_rows).collect()
    assert len(got) == len(rows)
    for own in {x.source_size for x in got}:
        part = [x for x in got if x.source_size == own]
        whole = int(part[0].target // own)
        assert sum(x.taken for x in part) == int(part[0].target + 0.5)
        order = sorted(part, key=lambda x: (hashlib.md5(f"0:{x.doc_id}".encode()).hexdigest(), str(x.doc_id), x.size))
        extra = [x.taken - whole * x.size for x in order if x.size]
        full = [e == x.size for e, x in zip(extra, (x for x in order if x.size), strict=True)]
        assert sum(a != b for a, b in zip(full, full[1:], strict=False)) <= 1 and sum(0 < e for e, f in zip(extra, full, strict=True) if not f) <= 1


def _varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def _message(fields):
    out = b""
    for k, v in fields:
        out += _varint(k << 3) + _varint(v) if isinstance(v, int) else _varint(k << 3 | 5) + struct.pack("<f", v) if isinstance(v, float) else _varint(k << 3 | 2) + _varint(len(v)) + v
    return out


def test_pieces_are_as_likely_as_the_librarys():
    model = sentencepiece.Model.load(MODEL)
    codec, pieces = sentencepiece.Codec(model), iter(model.pieces)
    proto = b""
    with open(MODEL, "rb") as f:
        for number, value in sentencepiece._fields(f.read()):
            if number == 1:
                p, s, k = next(pieces)
                value = _message([(1, p.encode()), (2, float(s)), (3, k)])
            elif number == 2:
                value = _message([(a, 1 if a == 3 else b) for a, b in sentencepiece._fields(value)])
            proto += _message([(number, value)])
    lib = library.SentencePieceProcessor(model_proto=proto)
    for text in ["The quick  brown fox", "naïve café — 中文 \U0001f600", "a\nb\n\n c", " lead", "x" * 300, "1234567890 internationalization"]:
        mine, theirs = codec.encode(text), lib.encode(text)
        worth = lambda ids: sum(model.pieces[i][1] for i in ids)
        assert codec.decode(mine) == text
        assert mine == theirs or worth(mine) >= worth(theirs) - 1e-3


def _unigram(tmp_path, normalizer, extra=()):
    """The model file as a unigram model, with the scores that are used here; and the library's reader of it."""
    model = sentencepiece.Model.load(MODEL)
    pieces, proto = iter(model.pieces), b""
    with open(MODEL, "rb") as f:
        for number, value in sentencepiece._fields(f.read()):
            if number == 1:
                p, s, k = next(pieces)
                value = _message([(1, p.encode()), (2, float(s)), (3, k)])
            elif number == 2:
                value = _message([(a, 1 if a == 3 else b) for a, b in sentencepiece._fields(value)])
            elif number == 3:
                value = _message([(1, b"identity"), *normalizer])
            proto += _message([(number, value)])
    for piece, kind in extra:
        proto += _message([(1, _message([(1, piece.encode()), (2, 0.0), (3, kind)]))])
    path = tmp_path / "unigram.model"
    path.write_bytes(proto)
    return str(path), None if any(n == 2 for n, _ in normalizer) else library.SentencePieceProcessor(model_proto=proto)


def test_digest_of_a_table_is_the_librarys(spark, tmp_path):
    """Every text of a table: the number of tokens and their hash, where the library's best segmentation is worth the same."""
    path, lib = _unigram(tmp_path, [(3, 1), (4, 0), (5, 1)])
    docs = common.table(spark, SF, "documents").select("doc_id", "text")
    got = {r.doc_id: r for r in sentencepiece.digest(docs, path).collect()}
    codec, same = sentencepiece.Codec(sentencepiece.Model.load(path)), 0
    worth = lambda ids: sum(codec.scores[i] for i in ids)
    for row in docs.collect():
        text, r = row.text or "", got[row.doc_id]
        theirs = lib.encode(text)
        if r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(theirs)}i", *theirs)).hexdigest():
            same += 1
            assert r.n_tokens == len(theirs) and r.n_byte_tokens == sum(lib.is_byte(i) for i in theirs)
        else:
            assert abs(worth(codec.encode(text)) - worth(theirs)) < 1e-2
        assert r.exact and r.n_bytes == len(text.encode())
    assert same >= 0.9 * len(got)


@pytest.mark.parametrize("normalizer", [[(3, 0), (4, 0)], [(3, 1), (4, 1)], [(3, 0), (4, 1)]])
def test_normalizer_settings_are_followed(tmp_path, normalizer):
    path, lib = _unigram(tmp_path, normalizer)
    codec = sentencepiece.Codec(sentencepiece.Model.load(path))
    for text in ["two  blanks here ", " lead", "", "   ", "plain text", "a\n b"]:
        assert codec.encode(text) == lib.encode(text) and codec.decode(codec.encode(text)) == lib.decode(lib.encode(text))


def test_a_character_map_is_refused_and_users_pieces_are_forced(tmp_path):
    path, _ = _unigram(tmp_path, [(2, b"abc")])
    with pytest.raises(ValueError):
        sentencepiece.Model.load(path)
    path, lib = _unigram(tmp_path, [(3, 1), (4, 0)], [("xqzt", sentencepiece.USER)])
    codec = sentencepiece.Codec(sentencepiece.Model.load(path))
    assert codec.encode("axqztb xqzt") == lib.encode("axqztb xqzt") and len(codec.scores) - 1 in codec.encode("axqztb")


def test_long_unbroken_texts_stay_small(tmp_path):
    codec = sentencepiece.Codec(_model())
    text = "ab1" * 300_000
    assert codec.decode(codec.encode(text)) == text and len(codec) == 0
    for i in range(30_000):
        codec.encode(f"w{i}" * 20)
    assert codec.held <= sentencepiece.REMEMBERED


@settings(max_examples=80, deadline=None)
@given(st.text(max_size=60))
def test_decoding_gives_the_text_back(text):
    codec = sentencepiece.codec(_model())
    text = text.encode("utf-8", "ignore").decode()
    assert codec.decode(codec.encode(text)) == text


_cache: list = []


def _model():
    if not _cache:
        _cache.append(sentencepiece.Model.load(MODEL))
    return _cache[0]


def test_ogg_pages_and_faults():
    payload = ogg.padded(bytes(range(256)) * 700)
    media = ogg.encode(payload, 179_200)
    got = ogg.decode(media)
    assert got["payload"] == payload and got["n_bytes"] == 179_200 and got["streams"] == 2 and got["last_ms"] == len(payload) * 1000 // ogg.RATE
    slow, at = 0, 0
    for byte in media[:100]:
        slow ^= byte << 24
        for _ in range(8):
            slow = (slow << 1 ^ (0x04C11DB7 if slow >> 31 else 0)) & 0xFFFFFFFF
    assert ogg.checksum(media[:100]) == slow and at == 0
    for bad in (media[:-1], media[: len(media) // 2], media[:5000] + b"x" + media[5001:], media[media.find(b"OggS", 10) :]):
        with pytest.raises((ValueError, KeyError, StopIteration, IndexError, struct.error)):
            ogg.decode(bad)


def test_ogg_query_is_an_independent_readers(spark):
    """The query's columns against a reader that only follows the format: pages by their lacing, no streams of ours assumed but the header."""
    docs = common.table(spark, SF, "documents").select("doc_id", "text")
    media = {r.id: bytes(r.media) for r in ogg.store(docs).collect()}
    got = {r.id: r for r in ogg.probe(ogg.store(docs)).collect()}
    for row in docs.collect():
        raw = (row.text or "").encode()
        payload = raw + b"\xff" * ((-len(raw)) % 576 if raw else 576)
        data, at, streams, pages = media[row.doc_id], 0, defaultdict(bytearray), 0
        while at < len(data):
            assert data[at : at + 4] == b"OggS"
            serial, n = int.from_bytes(data[at + 14 : at + 18], "little"), data[at + 26]
            size = sum(data[at + 27 : at + 27 + n])
            if int.from_bytes(data[at + 18 : at + 22], "little") > 0:  # not the header's page
                streams[serial] += data[at + 27 + n : at + 27 + n + size]
            at, pages = at + 27 + n + size, pages + 1
        assert bytes(max(streams.values(), key=len)) == payload or len(streams) == 2 and payload in map(bytes, streams.values())
        r, samples = got[row.doc_id], np.frombuffer(payload, np.uint8)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert (r.media_bytes, r.media_sha256, r.error) == (len(data), hashlib.sha256(data).hexdigest(), None)
        assert f"pages={pages};" in r.feature and f"last_ms={len(payload) * 1000 // ogg.RATE};peak={samples.max()};mean={samples.mean():.3f}" in r.feature


def test_a_corrupt_media_row_is_told(spark):
    good = ogg.encode(ogg.padded(b"hello"), 5)
    rows = [(1, good), (2, good[:-3]), (3, b"junk"), (4, None), (5, good.replace(b"hello", b"hallo"))]
    got = {r.id: r for r in ogg.probe(spark.createDataFrame(rows, "id long, media binary")).collect()}
    assert got[1].error is None and got[1].n_bytes == 5 and all(got[i].error and got[i].feature is None for i in (2, 3, 4, 5))


def test_attempts_of_writers_dont_meet(spark, tmp_path):
    """What another attempt left behind isn't read; a file that was changed after raises; revisits are compared with their response."""
    pages = spark.createDataFrame([(i, f"http://x/{i}", f"<p>{i % 7}</p>") for i in range(60)], "page_id long, url string, html string")
    out = f"file://{tmp_path}/a"
    manifest = warc.write_archives(pages, out, roll_bytes=2000)
    first = manifest.collect()
    (tmp_path / "a" / "pages-000000-99999-00000.warc.gz").write_bytes(b"left by a lost attempt")
    rows = warc.checked(warc.read_archives(manifest, with_payload=False)).collect()
    assert sorted(r.page_id for r in rows) == list(range(60)) and len(first) > 1
    path = first[0].path.removeprefix("file://")
    with open(path, "ab") as f:
        f.write(warc.member(warc.record_bytes(99, None, b"x", None, True), 6))
    with pytest.raises(Exception, match="manifest"):
        warc.read_archives(manifest, with_payload=False).collect()
    bad = [(1, 3, "A", "response", None, None, None), (2, 3, "B", "revisit", 1, None, None)]
    with pytest.raises(ValueError, match="revisits"):
        warc.checked(spark.createDataFrame(bad, warc.ROWS))


def test_warc_members_and_faults(tmp_path):
    record = warc.record_bytes(7, "http://x", b"<p>hello</p>", None, True)
    data = warc.member(record, 6) + warc.member(warc.record_bytes(8, None, b"<p>hello</p>", 7, False), 6)
    import io

    rows = list(warc.records(io.BytesIO(data), True))
    assert [(r[0], r[1], r[3], r[4]) for r in rows] == [(7, 12, "response", None), (8, 12, "revisit", 7)] and rows[0][6] == b"<p>hello</p>"
    assert rows[0][2] == rows[1][2] == warc.digest32(b"<p>hello</p>")
    for bad in (data[:-20], warc.member(record.replace(b"hello", b"hallo"), 6), warc.member(record[:-4], 6), warc.member(record + b"x", 6)):
        with pytest.raises((ValueError, zlib.error)):
            list(warc.records(io.BytesIO(bad), True))


def test_licences_are_named(spark):
    rows = [(1, "Intro\nReleased under the MIT License.\nMore"), (2, "Licensed under the Apache License, Version 2.0."), (3, "He lost his driving license on the way."), (4, "Licensed under CC BY-NC 4.0."), (5, "This work is licensed under the GNU General Public License, version 3.")]
    rows += [(6, "Licensed under the EUPL"), (7, "Text before.\n\nLicensed under the Zlib License.\n"), (8, "This is proprietary software; redistribution is strictly prohibited"), (9, "All rights reserved."), (10, "Distributed under the GNU GPL v3")]
    rows += [(11, "// Permission is hereby granted, free of charge, to any\n// person obtaining a copy of this software and associated\n// documentation files, to deal in the Software without restriction.\n//\n// The end.")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_licences, r.n_unknown, r.families) for r in licences.scanned(frame).collect()}
    want = {1: "mit", 2: "apache-2.0", 3: "", 4: "cc-by-nc", 5: "gpl-3.0", 6: "unknown", 7: "unknown", 8: "unknown", 9: "all-rights-reserved", 10: "gpl-3.0", 11: "mit"}
    assert got == {k: (int(v != ""), int(v == "unknown"), v) for k, v in want.items()}
    plan = licences.scanned(frame)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_licences_of_all_paragraphs_are_the_plain_models(spark):
    """The query on a whole table against the model, applied to each paragraph and line in plain Python."""
    model = licences.Model()
    docs = common.table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text").dropDuplicates(["doc_id"])
    made = ["All rights reserved.", "Released under CC BY-SA 4.0.", "Subject to the Mozilla terms, v. 2.0", "GNU", "x", "", "of the the of the", "License: MIT", "* * *"]
    made += [" ".join(n.split()[a:]) for own in licences.TEMPLATES.values() for n in own for a in range(4)] + list(licences.NOT_LICENCES) + list(licences.OTHERS)
    wrapped = ["\n".join(textwrap.wrap(n, 30)) for own in licences.TEMPLATES.values() for n in own]
    docs = docs.unionByName(spark.createDataFrame([(-1, "\n".join(made)), (-2, "\n\n".join(wrapped)), (-3, None)], "doc_id long, text string")).cache()

    def judge(text):
        tokens = licences._tokens(text)
        grams = licences._grams(tokens)
        p = model.probabilities(grams)
        best = min(p, key=lambda f: (-p[f], f))
        if best == licences.NONE and p[best] >= model.least_none:
            return None
        least = licences.LEAST_OVERLAP if p[best] >= model.least else licences.SURE_OVERLAP
        return best if best not in (licences.NONE, licences.UNKNOWN) and model.overlap(grams, best) >= least else licences.UNKNOWN

    want = {}
    for row in docs.collect():
        found = []
        for paragraph in re.split(r"\n[^\w\n]*(?=\n)", row.text or ""):
            lines = paragraph.split("\n")
            whole, own = judge(paragraph) if len(lines) > 1 else None, [x for x in map(judge, lines) if x]
            found += [whole] if whole not in (None, licences.UNKNOWN) or whole and not own else own
        want[row.doc_id] = (len(found), found.count(licences.UNKNOWN), ",".join(sorted(set(found))))
    got = {r.doc_id: (r.n_licences, r.n_unknown, r.families) for r in licences.scanned(docs).collect()}
    differ = {k: (got[k], want[k]) for k in want if got[k] != want[k]}
    assert not differ, dict(list(differ.items())[:5])
    assert sum(v[1] for k, v in want.items() if k >= 0) <= 0.1 * max(1, sum(v[0] for k, v in want.items() if k >= 0))


@pytest.mark.parametrize("size", [2, 5])
def test_a_text_of_exactly_a_shingle_equals_its_repeats(spark, size):
    rows = [(1, "ok " * size), (2, "ok " * (size + 1)), (3, "ok " * (size + 4)), (4, "ok " * (size - 1)), (5, "no " * size)]
    got = {r.id: tuple(r) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=size).collect()}
    assert got == {1: (1, 1, 1, True), 2: (2, 1, 1, False), 3: (3, 1, 1, False), 4: (4, 1, 4, True), 5: (5, 1, 5, True)}
