import duckdb
from pyspark.sql import functions as F

from quillmine.llm import decontaminate as D


def test_query_equals_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.01/{t}.parquet'")
    want = sorted(con.execute(D.OP3_SQL).fetchall())
    got = sorted(tuple(r) for r in D.op3_benchmark_decontamination(spark, "/root/testdata/sf0.01").collect())
    assert got == want
    assert 0 < sum(r[-1] for r in got) < len(got)


def brute(doc, items, window=10):
    import re

    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    w, hit, names = cut(doc), set(), set()
    for i, text in items:
        v = cut(text)
        n = min(len(v), window)
        for a in range(len(v) - n + 1 if v else 0):
            for b in range(len(w) - n + 1):
                if w[b : b + n] == v[a : a + n]:
                    hit.update(range(b, b + n))
                    names |= {str(i)} - {"None"}
    return len(w), len(hit), sorted(names)


def test_cases_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(D, "SHINGLES", 20)
    monkeypatch.setattr(D, "WINDOWS", 3)  # several passes
    ten = "one two three four five six seven eight nine ten"
    items = [(1, ten + " eleven twelve"), (2, "ab ab ab ab ab ab ab ab ab ab ab"), (10, "Lone"), (3, "tiny item here"), (4, None), (5, ""), (6, "!!"), (7, ten + " eleven twelve"), (None, "É accent word"), (7, ten + " eleven twelve")]
    docs = [(1, f"x {ten.upper()}, y"), (2, ten.replace("ten", "tenn")), (3, "ab " * 25), (4, "a tiny item, here; and tiny item."), (5, None), (6, ""), (7, "lone " * 5 + "\x00lone"), (8, "é accent word É accent word"), (9, ten + " eleven twelve " + ten), (9, ten), (9, ten), (None, "lone"), (11, "four five six seven eight " * 300)]
    d = spark.createDataFrame(docs, "doc_id long, text string").select("*", F.lit(1).alias("n_hit"), F.lit("z").alias("w"), F.lit("q").alias("Text"))
    b = spark.createDataFrame(items, "item_id long, text string").select("*", F.lit(3).alias("window"))
    got = sorted((str(r.id), r.n_words, r.n_hit, r.items) for r in D.contamination(d, b).collect())
    assert got == sorted((str(i), *brute(t, items)) for i, t in docs)
    assert all(r.n_hit == 0 and r.items == [] for r in D.contamination(d, b.limit(0)).collect())
    assert D.contamination(d.limit(0), b).count() == 0


def test_very_long_texts_and_words_are_searched_whole(spark):
    item = " ".join(f"w{i}" for i in range(10))
    huge = "z" * 300_000
    docs = spark.createDataFrame([(1, "x y " * 200_000 + item + " x" * 1000), (2, f"a {huge} b"), (3, "x y " * 1000)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, f"A {huge} B")], "item_id long, text string")
    got = {r.id: (r.n_words, r.n_hit, r.n_items) for r in D.contamination(docs, bench).collect()}
    assert got == {1: (401_010, 10, 1), 2: (3, 3, 1), 3: (2000, 0, 0)}
    empty = {r.id: (r.n_hit, r.n_items) for r in D.contamination(docs, bench.limit(0)).collect()}
    assert empty == {1: (0, 0), 2: (0, 0), 3: (0, 0)} and D.contamination(docs.limit(0), bench).count() == 0
