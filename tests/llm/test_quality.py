import math

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quillmine.llm import quality as Q


def test_features_are_sorted_sets_and_tell_repetition():
    assert len(Q.features(None)) == len(Q.features("")) == len(Q.features(" \n")) == 0
    for text in ("a", "word", "É ü", "one two one two", "x " * 30_000):
        ids = Q.features(text)
        assert (np.diff(ids) > 0).all() and ids.min() >= 0 and ids.max() < 1 << Q.BITS
    assert set(Q.features("Aa bb")) == set(Q.features("aa BB"))
    one, two = set(Q.features("zq zq")) - set(Q.features("zq")), set(Q.features("kv kv")) - set(Q.features("kv"))
    assert one & two  # "the same word again" is one feature for all words
    long, parts = "ab cd " * 5000, set(Q.features("ab cd ab cd"))
    assert set(Q.features(long)) == parts  # the way of long texts gives what that of short ones does


def test_descent_finds_the_hinge_minimum():
    rng = np.random.default_rng(0)
    y = np.where(rng.random(60) < 0.5, 1.0, -1.0)
    xs = []
    for s in y:
        ids = np.sort(rng.choice(8, 3, replace=False)).astype(np.int32)
        xs.append((ids, rng.normal(s * 0.4, 1, 3)))
    w, b = Q._descend(xs, y, np.ones(60), 400, 1)
    value = lambda w, b: 0.5 * (w @ w + b * b) + sum(max(0, 1 - s * (w[i] @ v + b)) for (i, v), s in zip(xs, y, strict=True))
    best = value(w, b)
    for _ in range(300):
        step = np.zeros_like(w)
        step[:8] = rng.normal(0, 0.02, 8)
        assert value(w + step, b + rng.normal(0, 0.02)) >= best - 1e-2


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = Q.op8_quality_nbsvm(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert len(got) > 50 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    good, bad = [r.score for r in got if r.quality == 1], [r.score for r in got if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.85
    assert np.mean([r.predicted == r.quality for r in got]) > 0.85


@pytest.fixture
def some(spark):
    docs = spark.createDataFrame([(i, f"plain words number {'abc'[i % 3]} here" if i % 2 else "%%% $$$ | | junk|| %%%") for i in range(60)] + [(100, None), (101, ""), (None, "plain words"), (1, "plain words again"), (102, "plain " * 100_000)], "doc_id long, text string").select("*", F.lit(9).alias("score"), F.lit("q").alias("Text"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(3, 1), (3, 0), (7, None), (None, 1)], "doc_id long, quality int")
    return docs, labels


def test_defined_cases(spark, some):
    docs, labels = some
    model = Q.train(docs, labels)
    got = Q.score(docs, model).collect()
    assert len(got) == docs.count()
    by = {r.id: r.score for r in got}
    assert by[100] == by[101] and by[2] < 0.3 < by[5] and by[102] > 0.3
    kept = Q.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.score >= 0.3 for r in got)
    one = Q.train(docs, labels.where("quality = 1"))
    assert len({r.score for r in Q.score(docs, one).collect()}) == 1 and Q.score(docs, one).first().score > 0.9
    none = Q.train(docs, labels.limit(0))
    assert {round(r.score, 9) for r in Q.score(docs, none).collect()} == {0.5}
    assert Q.score(docs.limit(0), model).count() == 0 and Q.keep_good(docs.limit(0), model).count() == 0


def test_the_bound_on_rows_holds_and_repeats(some):
    docs, labels = some
    a, b = Q.train(docs, labels, max_rows=10), Q.train(docs.repartition(3), labels.repartition(2), max_rows=10)
    assert (a[0] == b[0]).all() and a[1:] == b[1:]


def plain_features(text):
    """The ids of the indicators, one by one."""
    raw = (text or "").encode().lower()
    words = raw.split()
    if not words:
        return set()
    fold = lambda x, salt: ((x + salt) * 0x9E3779B97F4A7C15 % (1 << 64)) >> 64 - Q.BITS
    out = {fold(int.from_bytes(raw[i : i + n], "big"), n << 40) for n in (1, 2, 3) for i in range(len(raw) - n + 1)}
    h = [xxhash.xxh32_intdigest(w) for w in words]
    out |= {fold(x, 4 << 40) for x in h}
    return out | {fold(Q.SAME if a == b else (b ^ a << 24) % (1 << 64), 5 << 40) for a, b in zip(h, h[1:], strict=False)}


def test_scores_equal_brute_force(spark, some):
    """Ratios from counts of labelled rows, and scores from sums over plain sets of indicators."""
    docs, labels = some
    (r, w), slope, offset = model = Q.train(docs, labels)
    rows = docs.collect()
    label = {}
    for i, y in ((x.doc_id, x.quality) for x in labels.collect()):
        if i is not None and y is not None:
            label.setdefault(i, []).append(y)
    sets = [(plain_features(x.text), sum(label[x.doc_id]) * 2 >= len(label[x.doc_id])) for x in rows if x.doc_id in label]
    count = {y: np.full(1 << Q.BITS, 1.0) for y in (True, False)}
    for ids, y in sets:
        for i in ids:
            count[y][i] += 1
    ratio = np.log(count[True] / count[True].sum()) - np.log(count[False] / count[False].sum())
    assert r == pytest.approx(ratio, abs=1e-5)
    got = sorted((str(x.id), round(x.score, 5)) for x in Q.score(docs, model).collect())
    want = []
    for x in rows:
        ids = sorted(plain_features(x.text))
        norm = math.sqrt(sum(float(r[i]) ** 2 for i in ids)) or 1.0
        margin = sum(float(w[i]) * float(r[i]) for i in ids) / norm
        want.append((str(x.doc_id), round(1 / (1 + math.exp(-(slope * margin + offset))), 5)))
    assert got == sorted(want)
