import json

import pytest
from pyspark.sql import functions as F

from quillmine.functions import affiliation as A
from quillmine.functions import article_xml, geography, json_repair
from quillmine.functions import normalize as N
from quillmine.functions import text as T
from quillmine.operators import affiliations, exports, reports
from quillmine.operators import extractions as E

XML = """<?xml version="1.0"?><!DOCTYPE x><PubmedArticleSet><PubmedArticle><MedlineCitation><PMID Version="1">11111111</PMID>
<Article PubModel="Print"><Journal><ISSN IssnType="Print">1234-5678</ISSN><JournalIssue CitedMedium="Internet"><Volume>5</Volume><PubDate><Year>2024</Year><Month>Mar</Month><Day>5</Day></PubDate></JournalIssue><Title>Journal of X</Title><ISOAbbreviation>J X</ISOAbbreviation></Journal>
<ArticleTitle>Deep <i>learning <b>lost</b></i> for t<sup>2</sup> imaging </ArticleTitle><Pagination><MedlinePgn>1-9</MedlinePgn></Pagination>
<Abstract><AbstractText Label="AIM">One &amp; two.</AbstractText><AbstractText>Three.</AbstractText></Abstract>
<AuthorList><Author EqualContribution="Y"><LastName>Smith</LastName><ForeName>Jane</ForeName><Initials>J</Initials><AffiliationInfo><Affiliation>Univ A. Electronic address: j@a.org.</Affiliation></AffiliationInfo><AffiliationInfo><Affiliation>Second</Affiliation></AffiliationInfo></Author><Author><CollectiveName>Group</CollectiveName></Author><Author><LastName>Doe</LastName></Author></AuthorList>
<Language>eng</Language><GrantList><Grant><GrantID>G1</GrantID><Agency>NIH</Agency></Grant><Grant/></GrantList><PublicationTypeList><PublicationType UI="D1">Journal Article</PublicationType><PublicationType UI="D2">Review</PublicationType></PublicationTypeList></Article>
<MedlineJournalInfo><Country>England</Country><MedlineTA>J X</MedlineTA><NlmUniqueID>99</NlmUniqueID></MedlineJournalInfo>
<CommentsCorrectionsList><CommentsCorrections RefType="RetractionOf"><PMID> 777 </PMID></CommentsCorrections><CommentsCorrections RefType="RetractionIn"><PMID>8</PMID></CommentsCorrections></CommentsCorrectionsList>
<MeshHeadingList><MeshHeading><DescriptorName UI="M1" MajorTopicYN="Y">Heart</DescriptorName><QualifierName UI="Q1" MajorTopicYN="N">imaging</QualifierName></MeshHeading></MeshHeadingList>
<KeywordList Owner="NOTNLM"><Keyword MajorTopicYN="N">CMR</Keyword></KeywordList></MedlineCitation>
<PubmedData><History><PubMedPubDate PubStatus="received"><Year>2023</Year><Month>13</Month></PubMedPubDate></History><PublicationStatus>ppublish</PublicationStatus><ArticleIdList><ArticleId IdType="doi">10.1/OLD</ArticleId><ArticleId IdType="pubmed">11111111</ArticleId><ArticleId IdType="doi">https://doi.org/10.1/NEW.</ArticleId></ArticleIdList></PubmedData></PubmedArticle>
<PubmedArticle><MedlineCitation><PMID>22222222</PMID><Article PubModel="Preprint"><ArticleTitle>Machine learning in oncology</ArticleTitle><ArticleDate><Year>2022</Year><Month>07</Month></ArticleDate></Article></MedlineCitation></PubmedArticle></PubmedArticleSet>"""


def test_all_fields_of_an_article():
    one, two = article_xml.parse_articles(XML)
    assert one["title"] == "Deep learning  for t2 imaging" and one["abstract"] == "AIM: One & two. Three."
    assert one["authors"] == [{"last_name": "Smith", "first_name": "Jane", "initials": "J", "is_corresponding": True, "affiliation": "Univ A", "equal_contribution": True}, {"last_name": "Doe"}]
    assert one["publication_date"] == {"year": 2024, "month": 3, "day": 5, "iso_date": "2024-03-05"}
    assert one["journal"] == {"title_abbreviated": "J X", "nlm_id": "99", "country": "England", "title": "Journal of X", "iso_abbreviation": "J X", "issn": "1234-5678", "issn_type": "Print", "volume": "5", "cited_medium": "Internet", "pagination": "1-9"}
    assert one["grants"] == [{"id": "G1", "agency": "NIH"}] and one["publication_status"] == "ppublish" and one["doi"] == "10.1/new"
    assert one["mesh_headings"] == [{"descriptor": "Heart", "descriptor_ui": "M1", "descriptor_major": True, "qualifiers": [{"name": "imaging", "ui": "Q1", "major": False}]}]
    assert one["keywords"] == [{"keyword": "CMR", "major": False, "owner": "NOTNLM"}] and one["history"] == [{"year": 2023, "iso_date": "2023", "status": "received"}]
    assert one["is_retracted"] and one["retraction_of_pmid"] == "777" and not one["is_preprint"]
    assert two["is_preprint"] and not two["is_retracted"] and two["publication_date"]["iso_date"] == "2022-07"
    row = article_xml.spine_row(XML)
    assert row[4:6] == (2024, 3) and json.loads(row[7])[1]["type"] == "Review"
    assert article_xml.spine_row(None)[0] == "" and article_xml.spine_row("<x")[4] is None


def test_batches_are_split(spark):
    df = spark.createDataFrame([(XML, "b", "q")], "data string, batch_id string, query string")
    got = article_xml.split_articles(df).orderBy("article_pos").collect()
    assert [r.pmid for r in got] == ["11111111", "22222222"] and got[1].raw_xml.startswith("<PubmedArticle>")
    parsed = article_xml.parse_frame(article_xml.split_articles(df)).orderBy("pmid").collect()
    assert [r.title for r in parsed] == ["Deep learning  for t2 imaging", "Machine learning in oncology"] and parsed[0].query == "q"


def values(spark, f, *rows):
    names = [f"c{i}" for i in range(len(rows[0]))]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + ", ".join(f"{n} string" for n in names))
    return [r.v for r in df.select("i", f(*[F.col(n) for n in names]).alias("v")).orderBy("i").collect()]


def test_strip_space_takes_all_white_space_of_unicode_and_no_more(spark):
    space = [chr(i) for i in (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
    others = [chr(i) for i in (0x1C, 0x1F, 0x180E, 0x200B, 0xFEFF)]
    texts = [f"{c}\n a{c}b {c}" for c in space + others]
    assert values(spark, T.strip_space, *[(t,) for t in texts], (" \u3000\n",), (None,)) == [f"a{c}b" for c in space] + [f"{c}\n a{c}b {c}" for c in others] + ["", None]


def test_text(spark):
    assert values(spark, T.normalize_doi, (" DOI:10.1/A.",), ("https://dx.doi.org/10.2/b);/ ",), ("10.3/c",), (None,)) == ["10.1/a", "10.2/b", "10.3/c", None]
    assert values(spark, T.normalize_title, ("  A b\t",), ("",)) == ["a b", ""]
    assert values(spark, T.title_block_key, ("a b  c d",), ("a b",), ("a b c",)) == ["a b c", "a b", "a b c"]
    assert values(spark, T.shorten, ("x" * 50,), ("x" * 51,)) == ["x" * 50, "x" * 50 + "…"]
    kinds = lambda *k: json.dumps([{"type": x} for x in k])
    assert values(spark, T.exclusion_reason, (kinds("Journal Article", "Letter", "Review"),), (kinds("Case Reports"),), (kinds("x"),), (None,), ("bad",)) == ["Letter or Comment", "Case Report", "", "", ""]
    two = json.dumps([{"last_name": "Smith", "initials": "J", "affiliation": "X"}, {"first_name": "Ann", "affiliation": "Y*"}, {"last_name": "Li"}])
    got = values(spark, T.author_block, (two,), (json.dumps([{"last_name": "A"}]),), ("bad",), (None,), ("[]",))
    assert got == ["First author:           Smith J — X\nCorresponding (*):      Ann — Y*\nLast author:            Li", "First author:           A", "", "", ""]
    assert T.system_message(" x ").endswith("DOMAIN CONTEXT:\nx") and T.system_message("") == T.RULES


def test_normal_names(spark):
    assert values(spark, N.specialty, ("Medical Imaging",), (" heart center",), ("",), ("NotReported",), ("x",)) == ["Radiology", "Cardiology", "Unclear", "NotReported", "Other"]
    assert values(spark, N.relevance, ("main",), ("not relevant here",), ("relevantly",), ("uses CCTA",), ("x" * 31,), ("x",), ("0",), ("TRUE",)) == ["Main", "NotRelevant", "Main", "Main", "Main", "NotRelevant", "NotRelevant", "Main"]
    assert values(spark, N.study_type, ("RCT",), ("meta-analysis of x",), ("case series",), ("a review",), ("Other",), ("?",), ("SystematicReviewOrMetaAnalysis",)) == ["OriginalResearch", "SystematicReviewOrMetaAnalysis", "CaseReportOrSeries", "Review", "Other", "Other", "SystematicReviewOrMetaAnalysis"]
    assert values(spark, N.majority, ("A", "A", "B"), ("A", None, None), (None, "", "Unclear"), ("A", "B", "B"), ("A", "B", "C")) == ["A", "Mixed", "Unclear", "B", "Mixed"]
    assert values(spark, N.institution, ("Innsbruck Medical University",), ("Charité - Universitätsmedizin",), ("Centro X, IRCCS",), ("Heart CENTRE Y ,",)) == ["Medical University of Innsbruck", "Charité-Universitätsmedizin", "Centro X", "Heart Center Y"]
    assert values(spark, N.meaningful_institution, ("Medical Center",), ("Leiden University Medical Center",), ("Big Pharma GmbH of X",), ("Klinik für Innere Medizin",), ("University of Bern",)) == [False, True, False, False, False]
    assert values(spark, geography.detect_country, ("Boston, MA",), ("Tbilisi, Georgia.",), ("a woman",), ("X, USA.",), ("Seoul, South Korea",), ("",), (None,), ("nowhere",)) == ["united states", "united states", "oman", "united states", "south korea", "unknown", "unknown", "unknown"]
    assert values(spark, geography.region, ("italy",), ("unknown",), (None,)) == ["Southern Europe", "Unknown", "Unknown"]


AFFILIATIONS = {
    "Department of Radiology, Massachusetts General Hospital, Harvard Medical School, Boston, MA, USA.": ("Harvard Medical School", "Massachusetts General Hospital", None),
    "National Heart, Lung, and Blood Institute, Bethesda, MD": (None, None, "National Heart, Lung, and Blood Institute"),
    "Department of Cardiology Aarhus University Hospital, Aarhus, Denmark": (None, "Cardiology Aarhus University Hospital", None),
    "Seoul National University Bundang Hospital, Seongnam, Korea": (None, "Seoul National University Bundang Hospital", None),
    "University of Bern, Switzerland; Hospital X, Paris": ("University of Bern", None, None),
    "Some words about a Hospital without commas": (None, "Some words about a Hospital without commas", None),
    "": (None, None, None),
    "Berlin, Germany": (None, None, None),
    "Hospital of the University, Leiden": (None, "Hospital of the University", None),
    "Institut Pasteur, Paris": ("Institut Pasteur", None, None),
    "The Broad Institute, Somewhere U.S.A., and Karolinska University Hospital": (None, "Karolinska University Hospital", "Broad Institute"),
    "Division of Imaging at University College London, EC1A 1BB, UK": ("Imaging at University College London", None, None),
    "Great Ormond Street, Hospital for Children, London": (None, "Hospital for Children", None),
    "2 University of Oslo, a@b.no": ("University of Oslo", None, None),
}


def test_affiliations(spark):
    assert {a: A.parse_affiliation(a) for a in AFFILIATIONS} == AFFILIATIONS
    assert A.parse_affiliation(None) == (None, None, None) and A.tidy("Universit√§t X. ") == "Universität X"
    df = spark.createDataFrame([(i, a) for i, a in enumerate([*AFFILIATIONS, None])], "i int, a string")
    got = {r.a: (r.university, r.hospital, r.institution) for r in A.with_entities(df, "a").collect()}
    assert got == AFFILIATIONS | {None: (None, None, None)}
    named = {"Dept of X, Heart Institute of Y, 12 Long Street, Zagreb, Croatia": "Heart Institute of Y", "": "Unknown", None: "Unknown", "Only this": "Only this", "a, b, ": "Unknown", "Paris, France": "Paris", "France, Spain": "France", "Some Place, Bern, Thun; Big Hospital": "Some Place"}
    named |= {"Section of Surgery, Great House of Healing and of other things, France": "Great House of Healing and of other things", "Division of X, Team of Y, Nowhere 7": "Nowhere 7", "Division of X, Team of Y 1": "Division of X", "x" * 90 + ", Basel 4056": "x" * 80}
    assert values(spark, A.institution_name, *[(k,) for k in named]) == list(named.values())
    assert A.with_institution(df, "a").count() == len(AFFILIATIONS) + 1


BROKEN = {
    "strip_markdown_fences": '```json\n{"a": 1}\n```', "extract_json_object": 'Here: {"a": 1} ok', "strip_special_chars": '﻿​[1]', "fix_smart_quotes": "{“a”: 1}",
    "fix_trailing_commas": '{"a": [1, 2,], }', "fix_literal_newlines": '{"a": "x\ny"}', "fix_single_quoted_keys": "{'a': 1}",
}


def test_json_repair(spark):
    for step, raw in BROKEN.items():
        content, fixed, history, error = json_repair.repair(raw)
        assert json_repair.valid(content) and fixed == "pattern" and error is None and json.loads(history)[-1] == {"step": step, "success": True}, step
    assert json_repair.repair('{"a": 1}') == ('{"a": 1}', None, "[]", None)
    assert json_repair.repair("no")[3] == "pattern_fix_failed" and json_repair.repair("no", pattern=False)[3] == "no_repair_attempted"
    assert json_repair.repair("no", model=lambda r: "{}")[:2] == ("{}", "pattern+llm") and json_repair.repair("no", False, lambda r: "{}")[1] == "llm"
    assert json_repair.repair("no", model=lambda r: "still no")[3] == "llm_fix_failed" and json_repair.repair("no", model=lambda r: '{"_unrecoverable": true}')[3] == "unrecoverable"
    rows = spark.createDataFrame([(r,) for r in [*BROKEN.values(), None]], "raw_response string")
    assert json_repair.repair_frame(rows).where("error_label is null").count() == len(BROKEN)


def test_keyword_filter(spark):
    authors = lambda *a: json.dumps([{"last_name": "x", "affiliation": p} for p in a])
    rows = [("1", authors("Paris, FRANCE", "Bern, switzerland and France"), None), ("2", authors("Paris, France France"), None), ("3", "bad", "in France"), ("4", None, None), ("5", authors(None, "x"), "")]
    df = spark.createDataFrame(rows, "pmid string, authors string, affiliation_raw string")
    tag = lambda **k: {r.pmid for r in affiliations.filter_papers(df, affiliations.KeywordFilter(["France", "Switzerland"], "hit", **k)).where("hit").collect()}
    assert tag() == {"1", "2"} and tag(min_author_matches=2) == {"1"} and tag(also_check_columns=["affiliation_raw", "none"]) == {"1", "2", "3"} and tag(case_sensitive=True) == {"1", "2"}
    assert affiliations.filter_papers(df, affiliations.KeywordFilter(["france"], drop_non_matching=True)).columns == df.columns
    with pytest.raises(ValueError):
        affiliations.KeywordFilter([])


def test_records(spark):
    rows = [("1", "s", "r", "{}", None, None, 1.0, "a", 1), ("1", "s", "r", None, "bad", None, 1.0, "b", 0), ("2", "s", "r", "nope", None, "pattern", None, "c", 2), ("3", "s", "r", None, "x", None, 0.5, "d", 3)]
    df = spark.createDataFrame(rows, "pmid string, schema_name string, run_id string, extracted_json string, error_label string, fix_applied string, cost_usd double, created_at string, seq long")
    now = E.latest(df)
    papers = spark.createDataFrame([(str(i),) for i in range(1, 5)], "pmid string")
    assert sorted(r.pmid for r in E.pending(papers, now, "s", "r").collect()) == ["3", "4"]
    assert E.summary(now).first().asDict() == {"total": 3, "n_success": 2, "n_failed": 1, "n_repaired": 1, "total_cost": 1.5, "first_at": "a", "last_at": "d"}
    snap = E.snapshot_summary(now, papers).first()
    assert (snap.n_success, snap.n_repaired, snap.coverage_pct) == (1, 1, 75.0)
    lines = [json.loads(r.value) for r in E.export_lines(now).collect()]
    assert lines == [{"pmid": "1", "data": {}}, {"pmid": "2", "data": {"_raw": "nope"}}]
    assert E.exists(now, "1", "s", "r") and not E.exists(now, "9", "s", "r")
    cache = spark.createDataFrame([("k", "n", "v", 10.0), ("l", "n", "vv", 9.9), ("m", "o", "v", 0.0)], "key string, namespace string, value string, created_at double")
    assert E.cache_live(cache, 20.0, 10.0).count() == 1 and E.cache_clear(cache, "n").count() == 1 and E.cache_clear(cache).count() == 0


def test_reports(spark):
    df = spark.createDataFrame([("b", 0), ("a", 1), ("a", 2), ("b", 3), ("c", 4), (None, 5)], "v string, _pos long")
    assert [(r.v, r.n) for r in reports.most_common(df, "v", 2).collect()] == [("b", 2), ("a", 2)]
    journal = values(spark, reports.journal_title, ('{"title": "", "journal_title": "J"}',), ('{"iso_abbrev": "I"}',), ("bad",), (None,))
    assert journal == ["J", "I", None, None]
    grants = spark.createDataFrame([([" NIH", "NIH ", "", None],), (["NIH", "X"],), (None,)], "a array<string>")
    assert sorted((r.g, r["count"]) for r in reports.distinct_per_paper(grants, F.col("a"), "g").groupBy("g").count().collect()) == [("NIH", 2), ("X", 1)]
    counts = spark.createDataFrame([("x", y, 3) for y in range(2001, 2007)] + [("y", y, 3) for y in range(2001, 2006)] + [("z", y, 2) for y in range(2001, 2008)], "country string, year long, n long")
    got = {r.country: r.apc for r in reports.annual_change(counts, "country").collect()}
    import numpy as np

    years = np.arange(2001, 2027)
    line = lambda n: np.polyfit(years, np.log(np.where(years < 2007, n, 0) + 0.5), 1)[0]
    assert got["x"] == pytest.approx((np.exp(line(3)) - 1) * 100) and got["y"] is None and got["z"] is None
    table = spark.createDataFrame([("heart", "H", 1), ("european heart journal", "E", 2), ("h", "S", 0)], "entry string, scope string, ord int")
    names = spark.createDataFrame([("European Heart Journal",), ("Heart",), ("Lung",), ("xy",)], "j string")
    assert {r.j: r.scope for r in reports.classify_by_part(names, "j", table).collect()} == {"European Heart Journal": "E", "Heart": "H", "Lung": "Other", "xy": "Other"}
    assert reports.change_bounds(spark.createDataFrame([(float(i),) for i in range(101)] + [(None,)], "apc double")).first() == (5.0, 95.0)


def test_joins_of_papers_and_records(spark):
    papers = spark.createDataFrame([("1", "old", 0), ("1", "new", 1), ("2", "two", 2)], "pmid string, title string, _pos long")
    records = spark.createDataFrame([("1", "Original Research", " J ", 0), ("1", "Other", "J", 1), ("9", "OriginalResearch", "K", 2), ("3", "OriginalResearch", "J", 3)], "pmid string, study string, journal string, seq long")
    assert E.with_papers(papers, records).count() == 4 and [r._pos for r in E.extracted_only(papers, records).orderBy("_pos").collect()] == [0, 1]
    assert {(r.pmid, r.title) for r in E.looked_up(records, papers, ["title"]).collect()} == {("1", "new"), ("9", None), ("3", None)}
    scopes = spark.createDataFrame([("j", "Cardiac")], "journal string, scope string")
    assert sorted((r["name"], r["count"], r.scope) for r in E.original_journals(records, "journal", "study", scopes).collect()) == [("J", 2, "Cardiac"), ("K", 1, "Other")]


def test_ranks_bounds_and_focus(spark):
    counts = spark.createDataFrame([("a", 2, 9), ("b", 5, 1), ("c", 2, 3), ("d", 1, 0)], "v string, n long, first long")
    assert {r.v: r["rank"] for r in reports.rank(counts, "v", "first").collect()} == {"b": 1, "c": 2, "a": 3, "d": 4}
    assert {r.v: r["rank"] for r in reports.rank(counts, "v").collect()} == {"b": 1, "a": 2, "c": 3, "d": 4}
    change = lambda *x: spark.createDataFrame([(float(i),) for i in x], "apc double")
    assert reports.colour_bounds(change(*range(-100, 1)), change(*range(1, 101))).first() == (-25.0, 45.0)
    assert reports.colour_bounds(change(3, 3)).first() == (-2.0, 3.0) and reports.colour_bounds(change(-3, -3)).first() == (-3.0, 2.0)
    focus = lambda n: reports.names_focus(n, ["inselspital bern"], "bern", ["hospital", "klinik"], ["children"])
    assert values(spark, focus, ("Inselspital Bern",), ("Bern University Hospital",), ("Children Hospital Bern",), ("Bern",)) == [True, True, False, False]


def test_labels(spark):
    long = "University Hospital of a city with a long name"
    assert values(spark, T.wrap_label, ("short",), (long,), ("x" * 60,), ("a" * 40 + " b",), ("a" * 39 + " b",)) == ["short", "University Hospital of a city with a\nlong name", "x" * 40 + "…", "a" * 40 + "\nb", "a" * 39 + "\nb"]
    assert values(spark, T.title_case, ("cardiac MRI of o'neil",), (None,)) == ["Cardiac Mri Of O'Neil", None]
    assert values(spark, lambda c: T.pretty(c, {"a": "A!"}), ("a",), ("b",)) == ["A!", "b"]
    people = spark.createDataFrame([((["x", "y"], "z"),), (([], "z"),), ((None, None),)], "a struct<affiliations:array<string>,affiliation:string>")
    assert [r.v for r in people.select(T.affiliation_of(F.col("a")).alias("v")).collect()] == ["x", "z", ""]
    assert spark.createDataFrame([(["1", "2"],)], "i array<string>").select(T.id_list_key(F.col("i"))).first()[0] == __import__("hashlib").md5(b"1,2").hexdigest()


def test_exports(spark):
    papers = spark.createDataFrame([("1", 2001, "J", "en", 0), ("2", 2001, "J", "en", 1), ("3", None, "K", "fr", 2)], "pmid string, year long, journal string, language string, _pos long")
    records = spark.createDataFrame([("1", '{"k": "x"}', None, None, 1.0)], "pmid string, extracted_json string, error_label string, fix_applied string, cost_usd double")
    assert json.loads(exports.json_bytes(papers.orderBy("pmid"), 2)) == [{"pmid": "1", "year": 2001, "journal": "J", "language": "en", "_pos": 0}, {"pmid": "2", "year": 2001, "journal": "J", "language": "en", "_pos": 1}]
    frames = exports.sheets(papers, records, ["k"])
    assert [tuple(r) for r in frames["Years"].collect()] == [(2001, 2)] and frames["Fields"].first().value == "x"
    assert {k: v.count() for k, v in exports.dashboard(papers, "year", "language", "language", "journal", "language").items()} == {"years": 1, "specialties": 2, "regions": 2, "journals": 2, "studies": 2}
    found = reports.snapshot(papers, records, ["k", "none"])
    assert found["corpus"]["total"] == 3 and found["distributions"] == {"k": {"x": 1}, "none": {}} and found["run"]["coverage_pct"] == 33.33


def test_storage_reads_footers(spark, tmp_path):
    from quillmine.spine import storage

    spark.range(10, numPartitions=2).write.parquet(f"{tmp_path}/t")
    got = storage([str(p) for p in tmp_path.glob("t/part-*")])
    assert got["rows"] == 10 and got["row_groups"] == 2 and got["columns"] == ["id"] and got["codecs"] == ["SNAPPY"]
