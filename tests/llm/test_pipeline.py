"""The pipeline's rows against a plain version of its five stages."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import corpus_pipeline
from tidemark.llm import common, neardup, sentencepiece, toxicity

SF = "/root/testdata/sf0.001"


def plain_near_duplicates(rows, words=5):
    sets = {}
    for r in rows:
        w = (r["text"] or "").encode().translate(neardup.LOWER).split()
        sets[r["doc_id"]] = {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()
    group = {i: i for i in sets}
    for x in sorted(sets):
        for y in sorted(sets):
            if y < x and sets[x] and sets[y]:
                both = len(sets[x] & sets[y])
                if 100 * both >= 80 * (len(sets[x]) + len(sets[y]) - both):
                    a, b = sorted((group[x], group[y]))
                    group = {k: a if v == b else v for k, v in group.items()}
    return [r for r in rows if group[r["doc_id"]] == r["doc_id"]]


def plain_suffixes(rows, span=200):
    texts = [(r["text"] or "").encode() for r in rows]
    seen = Counter(t[a : a + span] for t in texts for a in range(len(t) - span + 1))
    out = []
    for r, t in zip(rows, texts, strict=True):
        gone = bytearray(len(t))
        for a in range(len(t) - span + 1):
            if seen[t[a : a + span]] > 1:
                gone[a : a + span] = b"\1" * span
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g).decode("utf-8", "ignore")
        out.append(r | {"text": kept, "n_chars": len(kept)})
    return out


def plain_mix(rows):
    size = {r["doc_id"]: len(r["text"].encode().split()) for r in rows}
    sources = sorted({r["source"] for r in rows})
    total = {s: sum(size[r["doc_id"]] for r in rows if r["source"] == s) for s in sources}
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sources)}
    target: dict = {}
    while len(target) < len(sources):
        left = 1.5 * sum(total.values()) - sum(target.values())
        open_ = {s: left * weight[s] / sum(weight[x] for x in sources if x not in target) for s in sources if s not in target}
        over = {s: 2.0 * total[s] for s, v in open_.items() if v > 2 * total[s]}
        target |= over or open_
    out = []
    for s in sources:
        whole = math.floor(target[s] / total[s] + 1e-9) if total[s] else 0
        rest = math.floor(target[s] + 0.5) - whole * total[s]
        for r in sorted((r for r in rows if r["source"] == s), key=lambda r: (hashlib.md5(f"0:{r['doc_id']}".encode()).hexdigest(), str(r["doc_id"]))):
            n = size[r["doc_id"]]
            extra = max(0, min(n, rest))
            rest -= n
            copies = whole + (extra == n)
            out += [r] * (copies if n else 0)
            if 0 < extra < n:
                cut = b"".join(re.findall(rb"[ \t-\r]*[^ \t-\r]+", r["text"].encode())[:extra]).decode()
                out.append(r | {"text": cut, "n_chars": len(cut)})
    return out


def test_the_pipeline_equals_its_plain_version(spark):
    docs, labels = common.table(spark, SF, "documents"), common.table(spark, SF, "labels")
    model = toxicity.learn(docs, labels)
    matcher = toxicity.Matcher(model.terms, model.exceptions)

    def score(text):
        a, b = toxicity._x(*matcher.features(text))
        return 1 / (1 + math.exp(-(model.bias + model.total * a + model.dense * b)))

    rows = [r.asDict() for r in docs.collect()]
    rows = [r for r in rows if score(r["text"]) < 0.7]
    rows = plain_mix(plain_suffixes(plain_near_duplicates(rows)))
    codec = sentencepiece.Codec(sentencepiece.Model.load(corpus_pipeline.MODEL_PATH))
    want = Counter((r["doc_id"], r["source"], r["n_chars"], tuple(codec.encode(r["text"]))) for r in rows)
    got = Counter((r.doc_id, r.source, r.n_chars, tuple(r.ids)) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == want and len(want) > 50


def test_a_thousand_equal_rows_leave_their_text_once(spark):
    """Near duplicates keep one row, so the suffix stage finds no other copy to cut its text by."""
    text = " ".join(f"w{i * 7919 % 1009}" for i in range(120))
    rows = [(1, text, "en", "a", len(text))] * 1000 + [(2, text, "en", "a", len(text))] * 3 + [(None, text + " end", "en", "b", len(text) + 4)] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_duplicate_stage(spark, df, SF)
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "None"]
    out = corpus_pipeline.suffix_stage(spark, kept.filter("doc_id = 1"), SF).collect()
    assert [(r.doc_id, r.text) for r in out] == [(1, text)]


def test_stages_are_five_and_named_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "suffix_dedup", "mixing", "encoding"]
