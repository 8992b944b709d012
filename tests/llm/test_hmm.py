import itertools
import math
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmine.llm import hmm as H


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(H, "CLASSES", 4)
    monkeypatch.setattr(H, "END", 3)
    monkeypatch.setattr(H, "OWN", 1)
    monkeypatch.setattr(H, "TAILS", 2)
    rng = np.random.default_rng(5)
    return H.Model(rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(4), 3).T)


def paths(seq, m):
    for states in itertools.product(range(3), repeat=len(seq)):
        p = m.start[states[0]] * m.emit[seq[0], states[0]]
        for t in range(1, len(seq)):
            p *= m.move[states[t - 1], states[t]] * m.emit[seq[t], states[t]]
        yield states, p


SEQUENCES = [[0, 1, 2, 3], [3], [2, 2, 1, 0, 0, 3], [1, 3], [0, 1, 2, 3]]


@pytest.mark.parametrize("chunk", [1, 9, 1000])
def test_forward_equals_all_paths(small, monkeypatch, chunk):
    monkeypatch.setattr(H, "CHUNK", chunk)
    got = H.log10_forward([np.array(s) for s in SEQUENCES], small)
    assert got == pytest.approx([math.log10(sum(p for _, p in paths(s, small))) for s in SEQUENCES])


@pytest.mark.parametrize("block", [1, 2, 3, 100])
@pytest.mark.parametrize("chunk", [1, 1000])
def test_counts_equal_all_paths(small, monkeypatch, block, chunk):
    monkeypatch.setattr(H, "BLOCK", block)
    monkeypatch.setattr(H, "CHUNK", chunk)
    start, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((4, 3))
    for s in SEQUENCES:
        all_paths = list(paths(s, small))
        whole = sum(p for _, p in all_paths)
        for states, p in all_paths:
            start[states[0]] += p / whole
            for t, x in enumerate(states):
                emit[s[t], x] += p / whole
                if t:
                    move[states[t - 1], x] += p / whole
    want = np.concatenate([start, move.ravel(), emit.ravel()])
    assert H.expected_counts([np.array(s) for s in SEQUENCES], small) == pytest.approx(want)


def test_probabilities_of_all_texts_sum_to_one(small):
    texts = [[*s, 3] for n in range(6) for s in itertools.product(range(3), repeat=n)]
    shorter = sum(10 ** H.log10_forward([np.array(t) for t in texts], small))
    assert 0.5 < shorter < 1


def test_query_base_and_gain(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = {r.doc_id: r for r in H.op6_hmm_language_model(spark, "/root/testdata/sf0.001").collect()}
    learnt = [r for r in rows if crc32(str(r.doc_id).encode()) % 5 != 1]
    count, total = Counter(), 0
    for r in learnt:
        count.update([*r.text.encode().lower().split(), None])
    total, v = sum(count.values()), len(count)
    assert len(got) == len(rows)
    for r in rows:
        t, g = [*r.text.encode().lower().split(), None], got[r.doc_id]
        assert (g.held_out, g.n_tokens, g.n_known, g.train_tokens) == (crc32(str(r.doc_id).encode()) % 5 == 1, len(t), sum(w in count for w in t), total)
        assert g.base_score == pytest.approx(sum(math.log10((count[w] + 0.5) / (total + 0.5 * (v + 1))) for w in t))
    held = [g for g in got.values() if g.held_out]
    assert sum(g.score for g in held) > sum(g.base_score for g in held)


@pytest.mark.parametrize("known", [0, 2, 1000])
def test_defined_cases(spark, known):
    long = "y" * 100
    rows = [(1, "a b a " + long), (2, None), (3, ""), (4, "A b\x0bc " + long), (4, "a"), (None, "b zzz")]
    df = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit(1).alias("score"), F.lit("q").alias("Text"))
    got = sorted((str(r.id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 9), r.score < 0) for r in H.score(df, F.col("id") != 3, known=known).collect())
    count = Counter(w for i, t in rows if i not in (3, None) for w in [*(t or "").lower().split(), None])
    n, v = sum(count.values()), len(count)
    want = []
    for i, t in rows:
        words = [*(t or "").lower().split(), None]
        want.append((str(i), len(words), sum(w in count for w in words), n, round(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words), 9), True))
    assert got == sorted(want)
    nothing = H.score(df, F.lit(False)).collect()
    assert len(nothing) == 6 and all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 for r in nothing)
    assert H.score(df.limit(0), F.lit(True)).count() == 0


def test_rounds_go_over_whole_texts_until_they_gain_little(spark):
    rng = np.random.default_rng(2)
    texts = [np.append(rng.integers(0, 20, n) + 20 * (np.arange(n) // 500), H.END).astype(np.int32) for n in (30, 700, 1600, 5, 900)]
    share = (np.bincount(np.concatenate(texts), minlength=H.CLASSES) + 0.5) / (sum(map(len, texts)) + 0.5 * H.CLASSES)
    tokens, model, logs = sum(map(len, texts)), H.Model.begin(share, 3, 7), []
    while len(logs) < 2 or logs[-1] - logs[-2] >= 1e-3:
        logs.append(H.log10_forward(texts, model).sum() / tokens)
        model = H.Model.from_counts(H.expected_counts(texts, model), share, 3)
    frame = lambda some: spark.createDataFrame([(H._packed(t),) for t in some], "classes binary")
    got = H.learn([frame(texts)], share, tokens, 3, 1e-3, 7)
    assert len(logs) > 3
    assert got.emit == pytest.approx(model.emit) and got.move == pytest.approx(model.move) and got.start == pytest.approx(model.start)
    by_block = H.learn([frame(texts[:2]), frame(texts[2:])], share, tokens, 3, 1e-3, 7)
    assert H.log10_forward(texts, by_block).sum() / tokens > logs[-1] - 0.01
