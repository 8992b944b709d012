import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quillmine.llm import simhash as S


def brute_fp(text, width=3):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    h = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps, radius=2):
    root = {i: i for i in range(len(fps))}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if ((fps[i] ^ fps[j]) & (1 << 64) - 1).bit_count() <= radius:
                root[max(top(i), top(j))] = min(top(i), top(j))
    low = {}
    for i in range(len(fps)):
        low[top(i)] = min(low.get(top(i), 1 << 64), ids[i])
    return [low[top(i)] for i in range(len(fps))]


@pytest.mark.parametrize("text", [None, "", " \t\n", "one", "Two Words", "a b c", "a a a a a a", "É É é x\x0by z", "w " * 9000])
def test_fingerprint_equals_brute_force(text):
    assert S.fingerprint(None if text is None else text.encode(), 3) == brute_fp(text)


@pytest.mark.parametrize("bucket", [1, 3, 64])
def test_links_connect_what_brute_force_does(spark, bucket):
    rng = random.Random(bucket)
    fps = set()
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(12):
            fps.add(x)
            x ^= sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3)))
    fps |= {1 << b for b in range(64)} | {0}
    fps = sorted(fps)
    rows = spark.createDataFrame([(S._signed(x),) for x in fps], "fp long")
    got = S.components(S.links(rows, bucket=bucket))
    found = {r.node: r.root for r in got.collect()}
    ids = [S._signed(x) for x in fps]
    assert [found.get(i, i) for i in ids] == brute_components(ids, fps)


def test_rows_nulls_ties_and_clashing_columns(spark):
    rows = [(3, "a b c d e f", "x"), (1, "A B C D E F", None), (9, None, "x"), (7, "", "y"), (5, "quite another text here now", "z"), (5, "quite another text here now", "z"), (None, "alone in its words, it is", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string").withColumn("component", F.lit(1)).withColumn("TEXT_", F.lit(1))
    got = sorted(((r.id, r.component) for r in S.near_duplicates(df, width=3).collect()), key=str)
    assert got == sorted([(3, 1), (1, 1), (9, 7), (7, 7), (5, 5), (5, 5), (None, None)], key=str)
    clash = df.select("*", F.lit("q").alias("Text"))
    assert S.near_duplicates(clash, width=3).count() == 7
    assert S.near_duplicates(df.limit(0), width=3).count() == 0


def test_query_equals_brute_force(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    fps = [brute_fp(r.text) for r in rows]
    want = {r.doc_id: (f"{f:016x}", c) for r, f, c in zip(rows, fps, brute_components([r.doc_id for r in rows], fps), strict=True)}
    got = S.op5_simhash_near_dedup(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == want


def pairs_at(similarity, n, rng, keep=lambda a, b: True, words=150):
    """``n`` pairs of texts whose shingles are barely ``similarity`` or more alike."""
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    sets = lambda t: set(S.shingle_hashes(t.encode()).tolist())
    found = []
    while len(found) < n:
        a = [word() for _ in range(words)]
        b, was = list(a), " ".join(a)
        while True:
            b[rng.randrange(len(b))] = word()
            x, y = sets(" ".join(a)), sets(" ".join(b))
            if len(x & y) < similarity * len(x | y):
                break
            was = " ".join(b)
        if keep(" ".join(a), was):
            found.append((" ".join(a), was))
    return found


def test_parity_bits_pass_every_pair_of_the_required_similarity():
    apart = lambda x, y: S.parity_distance(S.parity_bits(x), S.parity_bits(y))
    sets = lambda t: np.unique(S.shingle_hashes(t.encode()))
    for words in (10, 150, 1000):
        pairs = [(sets(a), sets(b)) for a, b in pairs_at(0.8, 20, random.Random(words), words=words)]
        assert all(apart(x, y) <= len(np.setxor1d(x, y)) for x, y in pairs)
        assert all(apart(x, y) > (len(x) + len(y)) / 9 for (x, _), (_, y) in zip(pairs, pairs[1:], strict=False))
    long, short = sets(" ".join(map(str, range(9000)))), sets(" ".join(map(str, range(100))))
    assert apart(long, short) <= len(np.setxor1d(long, short)) and apart(short, long) == apart(long, short)


@pytest.mark.parametrize("bucket", [0, 64])
def test_every_pair_of_the_required_similarity_is_linked(spark, bucket):
    texts = [t for words in (12, 40, 150) for pair in pairs_at(0.8, 60, random.Random(words), words=words) for t in pair]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in S.deduplicate(docs, bucket=bucket).collect()) == list(range(0, len(texts), 2))
