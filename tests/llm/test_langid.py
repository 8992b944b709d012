from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from quillmine.llm import langid as L


def brute(text):
    words = "".join(c.lower() if c.isalpha() else " " for c in text or "").split()
    out = Counter()
    for w in words:
        s = "\x01" + w + "\x01"
        out.update(w)
        out.update(s[i : i + 2] for i in range(len(s) - 1))
        out.update(s[i : i + 3] for i in range(len(s) - 2))
    return out


def value(gram):
    code = 0
    for c in gram:
        code = code << 21 | ord(c)
    return code


@pytest.mark.parametrize("block", [1, 2, 5, 1 << 18])
@pytest.mark.parametrize("text", [None, "", "!!! 123", "a", " Ab, cd--É ", "Hello  wörld a bb ccc, x.", "日本語 テスト", "ab " * 50])
def test_ngrams_equal_brute_force(monkeypatch, text, block):
    monkeypatch.setattr(L, "BLOCK", block)
    codes, counts = L.ngrams(None if text is None else text.encode())
    want = Counter()
    for g, n in brute(text).items():
        want[value(g)] += n
    assert dict(zip(codes.tolist(), counts.tolist(), strict=True)) == dict(want)


def test_held_out_accuracy(spark):
    got = L.op1_language_rank_order(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id").where("held_out").collect()
    assert len(got) > 200
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_defined_cases(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr"), (3, None, "en"), (4, "12 !", "fr"), (5, "the dog", None), (None, "le chat", None), (1, "the cat and the dog", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").select("*", F.lit(1).alias("score"), F.lit("x").alias("TEXT"))
    got = sorted((str(r.id), r.lang) for r in L.predict(df, L.profiles(df)).collect())
    assert got == sorted([("1", "en"), ("1", "en"), ("2", "fr"), ("3", "und"), ("4", "und"), ("5", "en"), ("None", "fr")])
    assert {r.lang for r in L.predict(df, L.profiles(df.limit(0))).collect()} == {"und"}
    assert L.predict(df.limit(0), {}).count() == 0


def test_predictions_equal_brute_force(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    counts = {}
    for r in rows:
        if crc32(str(r.doc_id).encode()) % 4 != 2 and r.lang is not None:
            counts.setdefault(r.lang, Counter()).update(brute(r.text))
    rank = lambda c: {g: k for k, g in enumerate(sorted(c, key=lambda g: (-c[g], value(g)))[:400])}
    known = {lang: rank(c) for lang, c in sorted(counts.items())}
    got = {r.doc_id: r for r in L.op1_language_rank_order(spark, "/root/testdata/sf0.001").collect()}
    for r in rows:
        own = rank(brute(r.text))
        far = {lang: sum(min(abs(k - places[g]), 400) if g in places else 400 for g, k in own.items()) for lang, places in known.items()}
        best = min(far, key=lambda lang: (far[lang], lang))
        assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == (best, pytest.approx(1 - far[best] / (400 * len(own))))


def test_very_long_texts_are_counted_whole(spark):
    rows = [(1, "the cat and the dog " * 60_000, "en"), (2, "le chat et le chien " * 60_000 + "x", "fr"), (3, "le chat " * 9 + "the cat and the dog " * 60_000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.id: r.lang for r in L.predict(df, L.profiles(df)).collect()} == {1: "en", 2: "fr", 3: "en"}
