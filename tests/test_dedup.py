import random

import pytest

from quillmine.functions.indel import indel_ratio
from quillmine.operators import dedup as D
from quillmine.operators.explore import Query, explore, filtered
from quillmine.spine import first_per_key


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_indel_ratio_equals_dynamic_programming():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choice("abcé ") for _ in range(rng.randint(0, 90))) for _ in range(2))
        want = 200.0 * lcs(a, b) / (len(a) + len(b)) if a or b else 100.0
        assert indel_ratio(a, b) == pytest.approx(want)
    assert indel_ratio("kitten", "sitting") == pytest.approx(200 * 4 / 13)


def brute(rows, threshold=90.0):
    """The definition, read literally."""
    seen, one = set(), []
    for r in rows:
        if r["pmid"] not in seen:
            seen.add(r["pmid"])
            one.append(r)
    title = lambda r: (r["title"] or "").lower().strip()
    doi, exact, fuzzy, dois, titles = set(), set(), set(), set(), set()
    for r in one:
        if r["doi"]:
            doi |= {r["pmid"]} if r["doi"] in dois else set()
            dois.add(r["doi"])
        if title(r):
            exact |= {r["pmid"]} if title(r) in titles else set()
            titles.add(title(r))
    blocks = {}
    for r in one:
        if r["pmid"] not in doi | exact and title(r):
            words = title(r).split()
            blocks.setdefault((r["year"], " ".join(words[:3]) if len(words) >= 3 else title(r)), []).append(r)
    for block in blocks.values():
        for i, a in enumerate(block):
            if a["pmid"] in fuzzy:
                continue
            for b in block[i + 1 :]:
                x, y = title(a), title(b)
                if b["pmid"] not in fuzzy and 100.0 * min(len(x), len(y)) >= threshold * max(len(x), len(y)) and indel_ratio(x, y) >= threshold:
                    fuzzy.add(b["pmid"])
    gone = {r["pmid"] for r in one if r["is_retracted"]} | {r["pmid"] for r in one if r["retraction_of_pmid"]}
    return doi, exact, fuzzy, [r["pmid"] for r in one if r["pmid"] not in doi | exact | fuzzy | gone]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("parts", [1, 5])
def test_layers_equal_the_definition(spark, seed, parts):
    rng = random.Random(seed)
    bases = ["the effect of one thing on another thing in general practice", "a study of magnetic resonance in many patients over years", "The Effect of one", "short", " Deep learning for\t medical imaging"]
    rows = []
    for i in range(120):
        t = rng.choice([*bases, None, ""])
        if t and rng.random() < 0.7:
            chars = list(t)
            for _ in range(rng.randint(0, 6)):
                chars[rng.randrange(min(20, len(chars)), len(chars)) if len(chars) > 20 else rng.randrange(len(chars))] = rng.choice("abc ")
            t = "".join(chars) + rng.choice(["", " ", "\t", " more words", "X"])
        rows.append({"pmid": str(rng.randint(0, 100)), "title": t, "doi": rng.choice([None, "", f"10.1/{rng.randint(0, 60)}"]), "year": rng.choice([2001, 2002, None]), "is_retracted": rng.random() < 0.05, "retraction_of_pmid": rng.choice(["", "", "", "", "7"]), "_pos": i})
    df = spark.createDataFrame(rows, "pmid string, title string, doi string, year long, is_retracted boolean, retraction_of_pmid string, _pos long").repartition(parts)
    doi, exact, fuzzy, stay = brute(rows)
    left, flags = D.deduplicate(df)
    by = {}
    for r in flags.collect():
        by.setdefault(r.reason, set()).add(r.pmid)
    assert by.get("doi_duplicate", set()) == doi and by.get("exact_title_duplicate", set()) == exact and by.get("fuzzy_title_duplicate", set()) == fuzzy
    assert [r.pmid for r in left.orderBy("_pos").collect()] == stay
    again, _ = D.deduplicate(left)
    assert again.count() <= left.count()
    found = D.statistics(df, left, flags).first()
    assert found.rows_removed == len(rows) - len(stay) and found.pmid_duplicates == len(rows) - len({r["pmid"] for r in rows})


def blocks(spark, many):
    """Many blocks of four titles that grow, and one large block whose matches fill several batches."""
    rows = [(f"case {i} of something seen by somebody else somewhere" + "x" * (0, 2, 5, 40)[v], 2001 + i % 3) for i in range(many) for v in range(4)]
    rows += [("one large block " + "y" * 60 + "z" * (i % 25), None) for i in range(60)]
    rows = [{"pmid": str(i), "title": t + " " * (i % 2), "doi": f"10.1/{i // 2}" if i % 7 == 0 else "", "year": y, "is_retracted": i % 11 == 0, "retraction_of_pmid": "", "_pos": i} for i, (t, y) in enumerate(rows)]
    return rows, spark.createDataFrame(rows, "pmid string, title string, doi string, year long, is_retracted boolean, retraction_of_pmid string, _pos long")


def test_followers_of_many_blocks_come_of_one_pass_a_task(spark):
    rows, df = blocks(spark, 100)
    _, _, fuzzy, _ = brute([{**r, "doi": ""} for r in rows])
    distinct = df.dropDuplicates(["title"]).drop("doi").join(D.title_copies(df), "pmid", "left_anti")
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = D.greedy_followers(D.fuzzy_pairs(distinct))
        got = [r.pmid for r in found.collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
    assert sorted(got) == sorted(fuzzy) and len(fuzzy) > 200
    assert "FlatMapGroups" not in found._jdf.queryExecution().optimizedPlan().toString()  # a call of Python a block


def test_layers_read_the_papers_a_fixed_few_times(spark):
    rows, df = blocks(spark, 20)
    doi, exact, fuzzy, stay = brute(rows)
    left, flags = D.deduplicate(df)
    found = D.statistics(df, left, flags)
    assert found.first().asDict() == {"pmid_duplicates": 0, "doi_duplicates": len(doi), "fuzzy_duplicates": len(exact) + len(fuzzy), "retracted": sum(r["is_retracted"] for r in rows), "retraction_notices": 0, "rows_removed": len(rows) - len(stay)}
    reads = lambda frame: frame._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD")
    assert reads(flags) <= 3 and reads(left) <= 4 and reads(found) <= 8


def scans(frame):
    """How often the plan that ran reads the rows; exchanges that it uses again are not read twice."""
    return frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("Scan ExistingRDD")


def test_statistics_come_of_one_pass_and_one_count_of_keys(spark):
    rows, df = blocks(spark, 20)
    rows += [{**r, "_pos": r["_pos"] + 1000} for r in rows[:9]]
    df = spark.createDataFrame(rows, df.schema).repartition(3)
    _, _, _, stay = brute(rows)
    left, flags = D.deduplicate(df)
    found = D.statistics(df, None, flags)
    got = found.collect()
    assert got == D.statistics(df, left, flags).collect() and got[0].rows_removed == len(rows) - len(stay) and got[0].pmid_duplicates == 9
    assert scans(found) == 2


def test_rows_removed_follow_from_flags_where_keys_are_null(spark):
    rows = [(None, "a title", "10.1/1", 0), (None, "a title", "10.1/1", 1), ("1", "a title", "10.1/1", 2), ("2", "A title ", "", 3), ("1", "other", "", 4), ("", None, None, 5)]
    df = spark.createDataFrame([(k, t, d, 2001, p) for k, t, d, p in rows], "pmid string, title string, doi string, year long, _pos long")
    left, flags = D.deduplicate(df)
    got = D.statistics(df, None, flags).collect()
    assert got == D.statistics(df, left, flags).collect() and got[0].rows_removed == 4


@pytest.mark.parametrize("small", [0, 2, 5, 1000])
def test_small_and_large_blocks_have_the_same_followers(spark, monkeypatch, small):
    rows, df = blocks(spark, 15)
    rows = [{**r, "title": r["title"].replace("yy", "éy", i % 5)} for i, r in enumerate(rows)]
    df = spark.createDataFrame(rows, df.schema).repartition(3)
    _, _, fuzzy, _ = brute(rows)
    monkeypatch.setattr(D, "SMALL", small)
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = [r.pmid for r in D.flag(df).where("reason = 'fuzzy_title_duplicate'").collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
    assert sorted(got) == sorted(fuzzy) and len(fuzzy) > 30


def test_ratio_of_titles_with_common_ends():
    rng = random.Random(2)
    for _ in range(200):
        head, tail, a, b = ("".join(rng.choice("abé ") for _ in range(rng.randint(0, n))) for n in (30, 30, 6, 6))
        a, b = head + a + tail, head + b + tail
        if a or b:
            assert indel_ratio(a, b) == 200.0 * lcs(a, b) / (len(a) + len(b))


def test_length_band_is_part_of_the_definition(spark):
    a = "one two three " + "x" * 80
    rows = [("1", a, 0), ("2", a[:-16], 1), ("3", a[:-4] + "yy", 2)]
    df = spark.createDataFrame([(p, t, None, 2001, i) for p, t, i in rows], "pmid string, title string, doi string, year long, _pos long")
    got = {(r.a, r.b) for r in D.fuzzy_pairs(df).collect()}
    assert got == {("1", "3")}
    assert D.fuzzy_pairs(df.limit(0)).count() == 0


def test_status_stands_in_for_the_flag(spark):
    rows = [("1", "Retracted"), ("2", "retraction"), ("3", None), ("4", "was retracte now")]
    df = spark.createDataFrame(rows, "pmid string, publication_status string")
    assert sorted(r.pmid for r in D.retracted(df).collect()) == ["1", "4"]
    assert D.retracted(df.drop("publication_status")).count() == 0 and D.notices(df).count() == 0


def test_first_per_key_keeps_the_first(spark):
    rows = [(str(i % 7), 100 - i) for i in range(100)]
    got = {r.pmid: r._pos for r in first_per_key(spark.createDataFrame(rows, "pmid string, _pos long").repartition(6), "pmid").collect()}
    assert got == {str(k): min(p for q, p in rows if q == str(k)) for k in range(7)}


def test_explore_guards_and_samples(spark):
    rows = [(str(i), f"Title {i} (x", None if i % 4 == 0 else "10.1/x" if i % 4 == 1 else "", None if i % 5 == 0 else 2000 + i % 10, None if i % 3 == 0 else i % 3 == 1, i) for i in range(60)]
    df = spark.createDataFrame(rows, "pmid string, title string, doi string, year long, exclude_flag boolean, _pos long").repartition(4)
    n = lambda **k: filtered(df, Query(**k)).count()
    assert n(has_doi=True) == 15 and n(excluded="included") == 40 and n(excluded="excluded") == 20
    assert n(title_contains="(x", title_use_regex=True) == 0 and n(title_contains="(x") == 60 and n(title_contains="title") == 0
    assert n(has_abstract=True, language="en") == 60  # columns that don't exist
    first, total = explore(df, Query(year_min=2003, limit=5))
    assert [r.pmid for r in first.collect()] == [str(i) for i in range(60) if i % 5 and i % 10 >= 3][:5] and total == sum(1 for i in range(60) if i % 5 and i % 10 >= 3)
    strided, total = explore(df, Query(mode="stride", stride=13, limit=100, columns=["pmid", "missing"]))
    assert [r.pmid for r in strided.collect()] == ["0", "13", "26", "39", "52"] and total == 60
    one, _ = explore(df, Query(mode="random", limit=9))
    two, _ = explore(df.repartition(1), Query(mode="random", limit=9))
    three, _ = explore(df, Query(mode="random", limit=9, seed=1))
    assert one.collect() == two.collect() != three.collect() and one.count() == 9
