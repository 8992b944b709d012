import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quillmine.functions import article_xml
from quillmine.plans import steps
from quillmine.plans.config import load
from quillmine.sources.batches import import_folder
from quillmine.spine import ConcurrentCommit, Spine, with_positions
from quillmine.streaming.ingest import ingest, resume_date

RAW = "pmid string, raw_xml string, fetch_date string, fetch_query string, fetch_batch string"


def article(pmid, title="T", last="Smith", extra=""):
    return f"<PubmedArticle><MedlineCitation><PMID Version='1'>{pmid}</PMID><Article><ArticleTitle>{title}</ArticleTitle><Abstract><AbstractText>A</AbstractText></Abstract><AuthorList><Author><LastName>{last}</LastName><ForeName>J</ForeName></Author></AuthorList></Article>{extra}</MedlineCitation></PubmedArticle>"


@pytest.fixture
def spine(spark, tmp_path):
    return Spine(spark, f"{tmp_path}/papers")


def test_staging_is_merged_in_order(spark, spine):
    rows = lambda *ids: spark.createDataFrame([(i, "x", "2024", "q", "b") for i in ids], RAW)
    assert not spine.exists() and spine.count() == 0 and spine.keys().count() == 0 and not spine.inspect()["exists"]
    spine.append_staging(rows("1"))
    assert spine.keys().count() == 1 and spine.keys(staged=False).count() == 0
    spine.append_staging(rows("2", "3"))
    assert spine.merge_staging() == 3 and spine.merge_staging() == 3
    assert [r.pmid for r in spine.table().orderBy("_pos").collect()] == ["1", "2", "3"]
    assert sorted(r._pos for r in spine.table().collect()) == [0, 1, 2]


def test_mutations(spark, spine):
    df = lambda rows, schema: spark.createDataFrame(rows, schema)
    spine.write(df([("1", "a", 1), ("2", "b", 2), ("3", "c", 3)], "pmid string, x string, y int"))
    spine.append(df([("4", 2.5)], "pmid string, z double"))
    spine.add_columns(df([("1", None, "n"), ("2", "new", "m"), ("9", "no", "no")], "pmid string, x string, w string"))
    got = {r.pmid: (r.x, r.y, r.z, r.w) for r in spine.table().collect()}
    assert got == {"1": ("a", 1, None, "n"), "2": ("new", 2, None, "m"), "3": ("c", 3, None, None), "4": (None, None, 2.5, None)}
    with pytest.raises(ValueError):
        spine.add_columns(df([("1", "a"), ("1", "b")], "pmid string, x string"))
    spine.update_columns(df([("2", "z")], "pmid string, x string"))
    assert {r.pmid: r.x for r in spine.table().collect()} == {"1": None, "2": "z", "3": None, "4": None}
    assert spine.remove_rows(df([("2",), ("8",)], "pmid string")) == 1 and spine.count() == 3
    assert spine.read(["pmid", "nothing"]).columns == ["pmid"]
    with pytest.raises(ValueError):
        spine.read(["nothing"])
    with pytest.raises(ValueError):
        spine.scan(["pmid", "nothing"])
    assert spine.preview(["pmid"], 2).count() == 2 and spine.migrate() == 3


def test_files_are_zstd_with_bounded_row_groups(spark, spine, tmp_path):
    spine.write(spark.range(150_000, numPartitions=1).select(F.col("id").cast("string").alias("pmid")))
    file = next(tmp_path.glob("papers/v-*/part-*"))
    meta = pq.ParquetFile(file).metadata
    assert meta.num_row_groups >= 3 and meta.row_group(0).num_rows <= 50_000 and meta.row_group(0).column(0).compression == "ZSTD"
    assert spine.inspect()["rows"] == 150_000


def test_positions_follow_the_frame(spark):
    df = spark.range(1000, numPartitions=7)
    assert with_positions(df, 5).where("_pos <> id + 5").count() == 0


def batch(folder, name, *articles, **more):
    (folder / name).write_text(json.dumps({"query": "q", "batch_id": name, "retstart": 0, "retmax": 9, "total_count": 9, "timestamp": "2024-05-01T10:00:00.123", "data": "<PubmedArticleSet>" + "".join(articles) + "</PubmedArticleSet>"} | more))


def test_import_of_batch_files(spark, spine, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    batch(folder, "pubmed_batch_1.json", article(11111111), article(22222222))
    batch(folder, "pubmed_batch_2.json", article(22222222, "other"), article(3))
    batch(folder, "pubmed_batch_3.json", data="")
    (folder / "pubmed_batch_4.json").write_text("{ not json")
    batch(folder, "something.json", article(4))
    assert import_folder(spine, str(folder)) == {"files": 3, "articles": 3, "duplicates": 1}
    assert import_folder(spine, str(folder)) == {"files": 3, "articles": 0, "duplicates": 4}
    assert [r.pmid for r in spine.table().orderBy("_pos").collect()] == ["11111111", "22222222", "3"]
    assert spine.table().where("pmid = '22222222' and raw_xml like '%other%'").count() == 0


def test_stream_takes_each_file_and_key_once(spark, spine, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    batch(folder, "a.json", article(1), article(2))
    spine.append_staging(spark.createDataFrame([("2", article(2), "2024-01-01T00:00:00", "q", "b")], RAW))  # left by a run that broke off
    for more in (None, "b.json", None):
        if more:
            batch(folder, more, article(2), article(3))
        ingest(spark, str(folder), spine, f"{tmp_path}/check").awaitTermination()
    assert sorted(r.pmid for r in spine.table().collect()) == ["1", "2", "3"]
    assert resume_date(spine) == "2024-05-01T10:00:00.123"


def test_steps_run_and_leave_metadata(spark, spine, tmp_path):
    rows = [("1", article(1, "Deep learning for medical imaging")), ("2", article(2, "deep learning for medical imaging ")), ("3", article(3, "", extra="<MedlineJournalInfo/>")), ("4", "<broken")]
    spine.write(spark.createDataFrame(rows, "pmid string, raw_xml string"))
    config = load(overrides={"general": {"steps": ["parse", "deduplicate", "filter"]}, "filter": {"keywords": ["x"], "output_column": "hit"}, "parse": {"prepare_llm_input": True, "flag_exclusions": True}})
    told = []
    metas = steps.run(spine, config, f"{tmp_path}/log", told.append)
    assert [m.status for m in metas] == ["ok"] * 3 and len(told) == 3
    assert metas[0].extra == {"parsed": 4} and metas[1].extra["rows_removed"] == 1 and metas[2].extra["match_rate"] == 0.0
    assert json.load(open(f"{tmp_path}/log/parse_meta.json"))["rows_after"] == 4
    assert {r.pmid for r in spine.table().collect()} == {"1", "3", "4"}
    assert spine.table().where("hit").count() == 0 and spine.table().where("exclude_flag").count() == 0
    again = steps.run(spine, load(overrides={"general": {"steps": ["parse"]}}))
    assert again[0].extra == {"parsed": 2}  # those whose titles are empty
    steps.register("broken", lambda *_: 1 / 0)
    config["general"] |= {"steps": ["broken", "parse"], "on_error": "skip"}
    assert [m.status for m in steps.run(spine, config)] == ["failed", "ok"]
    config["general"]["on_error"] = "fail"
    with pytest.raises(ZeroDivisionError):
        steps.run(spine, config)


def test_malformed_articles_are_empty():
    assert article_xml.parse_article("<PubmedArticle><PMID>1</PMID>") == {} and article_xml.parse_article(None) == {} and article_xml.parse_article("<PubmedArticle></PubmedArticle>") == {}


def test_a_merge_that_breaks_off_does_nothing_and_writers_at_once_fail(spark, spine, monkeypatch):
    rows = lambda *ids: spark.createDataFrame([(i, "x", "2024", "q", "b") for i in ids], RAW)
    spine.append_staging(rows("1"))
    spine.append_staging(rows("2"))
    monkeypatch.setattr(Spine, "_commit", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        spine.merge_staging()
    monkeypatch.undo()
    assert spine.keys(staged=False).count() == 0 and spine.merge_staging() == 2
    other, before = Spine(spark, spine.path), spine._read_state()[1]
    other.append(rows("3"))
    with pytest.raises(ConcurrentCommit):
        spine._commit(before, main=[])
    assert [r._pos for r in spine.table().orderBy("_pos").collect()] == [0, 1, 2]


def test_a_state_that_was_cut_short_does_not_count(spark, spine, tmp_path):
    spine.write(spark.createDataFrame([("1", 2001), ("2", 2003)], "pmid string, year long"))
    number = spine._read_state()[1]
    (tmp_path / "papers" / f"_state-{number + 1}").write_text('{"main": [')
    assert spine.count() == 2 and spine.year_range() == (2001, 2003)
    spine.append(spark.createDataFrame([("3", 2009)], "pmid string, year long"))
    assert spine.count() == 3 and spine.year_range() == (2001, 2009)
    for _ in range(12):
        spine.write(spine.table())
    assert len(list(tmp_path.glob("papers/_state-*"))) <= 11 and spine.count() == 3
    assert not list(tmp_path.glob("papers/rows-*"))
