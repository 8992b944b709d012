import random
import re

import pytest
import sentencepiece

pipeline = pytest.importorskip("corpus_pipeline")

from quillmine.llm import decontaminate, quality, secrets, simhash  # noqa: E402
from quillmine.llm.sentencepiece import MODEL  # noqa: E402

SF = "/root/testdata/sf0.001"


def cut(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def test_run_equals_the_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    judge = quality._judge(model)
    good = [i for i in sorted(rows) if judge(rows[i].text) >= 0.3]
    assert 0 < len(good) < len(rows)
    shingles = {i: set(simhash.shingle_hashes(rows[i].text.encode()).tolist()) for i in good}
    like = lambda a, b: a == b or len(a & b) >= 0.8 * len(a | b)
    group = {i: i for i in good}
    while True:
        new = {i: min(group[j] for j in good if like(shingles[i], shingles[j])) for i in good}
        if new == group:
            break
        group = new
    one = [i for i in good if group[i] == i]
    stay = {r.doc_id for r in simhash.deduplicate(docs.where(docs.doc_id.isin(good))).collect()}
    assert set(one) == stay and len(stay) < len(good)
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = cut(r.text)
        n = min(10, len(w))
        windows |= {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()
    sizes = {len(w) for w in windows}
    holds = lambda w: any(tuple(w[k : k + n]) in windows for n in sizes for k in range(len(w) - n + 1))
    clean = [i for i in good if i in stay and not holds(cut(rows[i].text))]
    masked = {i: rows[i].text for i in clean}
    left = docs.where(docs.doc_id.isin(clean))
    for r in secrets.scan(left, secrets.scanner_of(left)).collect():
        text = masked[r.id]
        for f in reversed([f for f in r.findings if f.secret]):
            text = text[: f.start - 1] + secrets.MASK + text[f.start - 1 + f.length :]
        masked[r.id] = text
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = {r.doc_id: r for r in pipeline.run(spark, SF).collect()}
    assert sorted(got) == clean
    assert all(list(got[i].token_ids) == library.encode(masked[i]) and got[i].round_trip for i in clean)


def test_stages_keep_the_columns_and_stand_nulls_repeats_and_none(spark):
    text = "this is a document of some ordinary words that nobody would throw away at all"
    rows = [(1, text, "en", "s", 1), (2, text, None, "s", 1), (2, text, None, "s", 1), (None, None, None, None, None), (4, "", "en", None, 0), (5, "password=b7db7aa4a5fcc78305 " + text * 2, "en", "s", 9), (None, "another one without a number of its own, but with words", "en", "s", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 as score", "2 as fp", "3 as th", "4 as k")
    for some in (docs, docs.limit(0)):
        now = some
        for name, stage in pipeline.STAGES[:-1]:
            now = stage(spark, now, SF)
            assert now.columns == docs.columns, name
            now = spark.createDataFrame(now.collect(), now.schema)
        last = pipeline.STAGES[-1][1](spark, now, SF).collect()
        assert len(last) == now.count()


def test_dedup_keeps_one_row_of_each_group(spark):
    text = "a b c d e f g"
    rows = [(3, text), (1, text.upper()), (1, text.upper()), (None, text), (None, "only this one here"), (None, "only this one here"), (7, None), (8, ""), (9, "something else it is")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in simhash.deduplicate(docs).collect()), key=str)
    assert got == sorted([(1, text.upper()), (None, "only this one here"), (7, None), (9, "something else it is")], key=str)


@pytest.mark.parametrize("bucket", [-9, 3, 1000])
def test_similar_texts_are_found_and_no_others(spark, bucket):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    texts = []
    for k in range(12):
        base = [word() for _ in range(400)]
        for _ in range(25 if k == 0 else 4):
            w = list(base)
            for _ in range(rng.choice([0, 1, 2, 4, 12, 60])):
                w[rng.randrange(len(w))] = word()
            texts.append(" ".join(w))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [set(simhash.shingle_hashes(t.encode()).tolist()) for t in texts]
    close = lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
    root = list(range(len(texts)))
    for _ in texts:
        root = [min(root[j] for j in range(len(texts)) if i == j or close(i, j)) for i in range(len(texts))]
    got = {r.doc_id for r in simhash.deduplicate(docs, bucket=bucket).collect()}
    assert got == {i for i, r in enumerate(root) if i == r}


def test_decontamination_removes_only_what_it_should(spark):
    ten = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, "x " + ten), (1, "clean"), (None, ten), (None, "clean"), (3, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, ten)], "item_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in decontaminate.remove_contaminated(docs, bench).collect()), key=str)
    assert got == sorted([(1, "clean"), (None, "clean"), (3, None)], key=str)


def test_intermediate_tables_go(spark):
    from quillmine.llm import common

    with common.passing(spark):
        held = common.settle(spark.range(3), "some")
        path = common._made.paths[-1]
        assert held.count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
