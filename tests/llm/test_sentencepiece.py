import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from quillmine.llm import sentencepiece as S

CASES = ["", " ", "  a", "   ", "a", "Hello  World\n x", "日本語 テスト 🎉 x", "aaaaaaaaaaaaaaaa " * 3, " " * 100 + "x" + " " * 33, "x" * 700, "é́ ﷽", " 龘 \U0001f600  龘", "<s> <0x41> </s>", "abc\x00def\ttab\r\n", "naïve " * 40 + "\U0010ffff"]


@pytest.fixture(scope="module")
def pieces():
    return S.Pieces()


def mixed(seed, n):
    rng = random.Random(seed)
    parts = ["a", "b", "the", "ing", " ", "  ", "é", "1", ".", "\n", "ou", "ß", "漢", "x", "Th", "=", "ed", "ZZ", "--"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 80))) for _ in range(n)]


def test_ids_are_those_of_the_public_library(pieces):
    library = sentencepiece.SentencePieceProcessor(model_file=S.MODEL)
    texts = CASES + mixed(1, 400) + [" " * n + "x" + " " * n for n in range(1, 90)] + ["▁x▁▁y"]
    for some in (texts, texts[::-1]):
        assert [i.tolist() for i in pieces.encode(some)] == library.encode(some)
        pieces.forget()


def test_round_trip(pieces):
    texts = CASES + mixed(2, 300)
    assert pieces.decode(pieces.encode(texts)) == texts
    assert pieces.decode([]) == []


def test_unigram_paths_equal_brute_force(pieces):
    uni = S.Pieces()
    uni.unigram = True
    rng = np.random.default_rng(3)
    uni.score = rng.normal(-8, 3, uni.n).tolist()

    def best(word):
        table = [(0.0, [])]
        for j in range(1, len(word) + 1):
            options = []
            for i in range(max(0, j - uni.longest), j):
                p = word[i:j]
                if p in uni.usable and p not in uni.spaces:
                    options.append((table[i][0] + uni.score[uni.usable[p]], [*table[i][1], uni.usable[p]]))
            table.append(max(options, key=lambda o: o[0]))
        return table[-1]

    for word in ["▁there", "▁international", "▁aaaaaaa", "▁thingsandothers"]:
        ids, _ = uni._paths([word])
        assert sum(uni.score[i] for i in ids) == pytest.approx(best(word)[0])


def test_operator(spark):
    rows = [(1, "Hello  World"), (2, None), (3, ""), (4, "word " * 30_000), (4, "word " * 30_000), (None, "x"), (5, "a▁b")]
    df = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit(1).alias("token_ids"), F.lit(2).alias("Text"))
    out = S.encode(df).cache()
    got = out.collect()
    assert sorted((str(r.id), r.n_tokens, r.round_trip) for r in got) == sorted([("1", 3, True), ("2", 0, True), ("3", 0, True), ("4", 30_001, True), ("4", 30_001, True), ("None", 1, True), ("5", 2, False)])
    assert all(r.n_tokens == len(r.token_ids) for r in got)
    back = {r.id: r.text for r in S.decode(out).collect()}
    assert back[1] == "Hello  World" and back[2] == back[3] == "" and back[4] == "word " * 30_000
    odd = spark.createDataFrame([(1, None), (2, [None, -1, 40_000, 1])], "id long, token_ids array<int>")
    assert [r.text for r in S.decode(odd).collect()] == ["", ""]
    assert S.encode(df.limit(0)).count() == 0


def test_query_decodes_to_whole_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = S.op2_sentencepiece(spark, "/root/testdata/sf0.001")
    assert out.where("not round_trip").count() == 0
    back = {r.id: r.text for r in S.decode(out, id_col="doc_id").collect()}
    assert back == {r.doc_id: r.text for r in docs.collect()}
