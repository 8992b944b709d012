import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from quillmine import cli
from quillmine.plans import config, fetch, steps
from quillmine.plans.extract import CostCapExceeded, ErrorRateExceeded, Store, extract, gate
from quillmine.plans.fields import Field, check, json_schema, model_class, problems, spark_type
from quillmine.plans.tracker import Processed, batched
from quillmine.sources import eutils
from quillmine.sources import literature_api as api
from quillmine.sources.cache import ResponseCache
from quillmine.sources.chat_api import ChatClient, Unavailable
from quillmine.sources.registry import read_registry, write_registry
from quillmine.spine import Spine


def test_months_packing_and_division():
    got = fetch.months(date(2023, 11, 15), date(2024, 2, 1))
    assert got == [(date(2023, 11, 1), date(2023, 11, 30)), (date(2023, 12, 1), date(2023, 12, 31)), (date(2024, 1, 1), date(2024, 1, 31)), (date(2024, 2, 1), date(2024, 2, 29))]
    sizes = lambda *n: [x[2] for x in fetch.pack([(date(2024, 1, 1 + i), date(2024, 1, 1 + i), c) for i, c in enumerate(n)])]
    assert sizes(9900, 1, 9899, 1) == [9900, 9900, 1] and sizes(20_000, 0, 5) == [20_000, 5] and sizes(0, 0) == [0] and sizes() == []
    daily = {date(2024, 1, 1 + i): 4000 for i in range(31)} | {date(2024, 1, 9): 50_000}
    count = lambda a, b: sum(n for d, n in daily.items() if a <= d <= b)
    parts = fetch.plan_queries(date(2024, 1, 1), date(2024, 1, 31), count)
    assert sum(n for *_, n in parts) == sum(daily.values()) and all(n <= fetch.LIMIT or a == b for a, b, n in parts)
    assert all(b < c for (_, b, _), (c, _, _) in zip(parts, parts[1:], strict=False))

    def fails(a, b):
        raise OSError

    assert fetch.plan_queries(date(2024, 1, 1), date(2024, 1, 31), fails) == []
    assert fetch.resume_from("2024-03-05T10:00:00.12") == "2024/02/27" and fetch.resume_from(None) == "2000/01/01"
    with pytest.raises(ValueError):
        fetch.check_range("2024/02/01", "2024/01/01")
    with pytest.raises(ValueError):
        fetch.parse_date("2024-01-01")


def offline(kind, term, start, end, at=0, size=0):
    """A transport with three articles a day."""
    total = 3 * ((end - start).days + 1)
    if kind == "search":
        return total
    return "".join(f"<PubmedArticle><PMID>{start.toordinal() * 10 + i}</PMID></PubmedArticle>" for i in range(at, min(at + size, total)))


def test_data_source_reads_every_window(spark):
    spark.dataSource.register(api.LiteratureSource)
    options = {"transport": "quillmine_offline:offline", "term": "x", "start": "2024-01-05", "end": "2024-02-10", "batch": "50", "rate": "1000"}
    import sys
    import types

    module = types.ModuleType("quillmine_offline")
    module.offline = offline
    sys.modules["quillmine_offline"] = module
    windows = api.Reader(options).partitions()
    assert sum(min(50, 180 - w.at) for w in windows) == 180 and len({w.batch for w in windows}) == len(windows)
    rows = [next(api.Reader(options).read(w)) for w in windows]
    assert sum(r[5].count("<PMID>") for r in rows) == 180
    with pytest.raises(ValueError):
        api.check_format("json", "abstract")


def test_retries_and_rate_limit():
    calls, slept = [], []

    def flaky(status):
        calls.append(1)
        if len(calls) < 3:
            raise api.TransportError(status)
        return "ok"

    assert api.with_retries(flaky, 429, sleep=slept.append) == "ok" and len(slept) == 2 and 1 <= slept[0] <= 2 <= slept[1] <= 3
    calls.clear()
    with pytest.raises(api.TransportError):
        api.with_retries(flaky, 404, sleep=slept.append)
    assert len(calls) == 1
    now = [0.0]
    limit = api.RateLimit(2, lambda: now[0], lambda s: now.__setitem__(0, now[0] + s))
    for _ in range(12):
        limit.wait()
    assert now[0] == pytest.approx(5.0)


def test_fields():
    good = [Field("a", "string", "d"), Field("o", "object"), Field("x", "integer", parent="o", required=False), Field("l", "list[object]"), Field("e", "enum", values=["p", "q"], parent="l")]
    schema = json_schema(good, "s")["json_schema"]
    assert schema["strict"] and schema["schema"]["required"] == ["a", "o", "l"]
    assert schema["schema"]["properties"]["o"] == {"type": "object", "properties": {"x": {"type": "integer", "description": ""}}, "additionalProperties": False, "description": ""}
    assert schema["schema"]["properties"]["l"]["items"]["properties"]["e"] == {"type": "string", "enum": ["p", "q"], "description": ""}
    assert spark_type(good) == "struct<`a`:string,`o`:struct<`x`:bigint>,`l`:array<struct<`e`:string>>>"
    for bad in ([Field("a", "string"), Field("a", "string")], [Field("a", "date")], [Field("a", "enum")], [Field("a", "string", parent="b")], [Field("a", "object", parent="b"), Field("b", "object", parent="a")]):
        with pytest.raises(ValueError):
            check(bad)


def test_records_are_held_against_their_fields():
    fields = [Field("a", "string"), Field("n", "integer", required=False), Field("l", "list[integer]"), Field("o", "object"), Field("e", "enum", values=["p"], parent="o"), Field("r", "list[object]", required=False), Field("b", "boolean", parent="r")]
    assert problems({"a": "x", "l": [1, 2], "o": {"e": "p"}, "r": [{"b": True}], "n": None}, fields) == []
    assert problems({"n": True, "l": [1, "2"], "o": {"e": "q"}, "r": [{"b": 1}, 3], "z": 0}, fields) == ["z is not foreseen", "a is missing", "n is no integer", "l is no list[integer]", "o.e is none of its values", "r[0].b is no boolean", "r[1]. is no object"]
    assert problems([], fields) == ["record is no object"]


def test_fields_as_a_model():
    pydantic = pytest.importorskip("pydantic")
    fields = [Field("a", "string"), Field("n", "integer", required=False), Field("l", "list[integer]"), Field("o", "object"), Field("e", "enum", values=["p", "q"], parent="o"), Field("r", "list[object]", required=False), Field("b", "boolean", parent="r")]
    model = model_class(fields)
    got = model.model_validate({"a": "x", "l": [1, 2], "o": {"e": "p"}, "r": [{"b": True}]})
    assert got.model_dump() == {"a": "x", "n": None, "l": [1, 2], "o": {"e": "p"}, "r": [{"b": True}]}
    for bad in ({"a": "x", "l": [], "o": {"e": "z"}}, {"a": "x", "l": []}, {"a": "x", "l": [], "o": {"e": "p"}, "more": 1}):
        with pytest.raises(pydantic.ValidationError):
            model.model_validate(bad)


def test_tracker(tmp_path):
    done = Processed(f"{tmp_path}/ids.json")
    done.done(["a", "b"])
    assert Processed(f"{tmp_path}/ids.json").left(["b", "c", "a", "d"]) == ["c", "d"]
    assert list(batched(range(5), 2)) == [[0, 1], [2, 3], [4]]
    with pytest.raises(ValueError):
        list(batched([1], 0))


def settings(**more):
    return config.DEFAULTS["extract"] | {"schema_name": "s", "wave": 2} | more


def client(fails=False):
    """A client defined in a function, so that workers need not import this file."""

    def answer(system, prompt, schema):
        if fails and "Two" in prompt:
            raise ConnectionError
        if fails and "Three" in prompt:
            return {"content": "never JSON"}
        return {"content": '```json\n{"study_type": "RCT"}\n```' if "Two" in prompt else '{"study_type": "RCT"}', "cost_usd": 0.001, "model_used": "m"}

    return answer


FIELDS = [Field("study_type", "string", "kind")]


@pytest.fixture
def papers(spark):
    return spark.createDataFrame([("1", "One", "a", "yes"), ("2", "Two", "b", None), ("3", "Three", "c", "yes")], "pmid string, title string, abstract string, keep string")


def test_extraction_resumes_repairs_and_gates(spark, tmp_path, papers):
    store = Store(spark, f"{tmp_path}/x")
    assert gate(papers, "keep").count() == 2 and gate(papers, None).count() == 3
    got = extract(papers, store, "r", FIELDS, client(), settings(filter_column="keep"))
    assert (got["total"], got["failed"]) == (2, 0)
    got = extract(papers, store, "r", FIELDS, client(), settings())
    assert got["total"] == 3 and got["cost_usd"] == pytest.approx(0.003)
    by = {r.pmid: r for r in store.all().collect()}
    assert by["2"].fix_applied == "pattern" and by["1"].fix_applied is None and json.loads(by["2"].extracted_json) == {"study_type": "RCT"}


def test_failures_stay_pending_and_are_limited(spark, tmp_path, papers):
    store = Store(spark, f"{tmp_path}/x")

    with pytest.raises(ErrorRateExceeded):
        extract(papers, store, "r", FIELDS, client(fails=True), settings(max_error_rate=0.5))
    assert {r.pmid: r.error_label for r in store.all().collect()} == {"1": None, "2": "api_error: ConnectionError", "3": "pattern_fix_failed"}
    assert extract(papers, store, "r", FIELDS, client(), settings(max_error_rate=0.5))["failed"] == 0


def test_cost_cap_stops_between_waves(spark, tmp_path, papers):
    store = Store(spark, f"{tmp_path}/x")
    with pytest.raises(CostCapExceeded):
        extract(papers, store, "r", FIELDS, client(), settings(wave=1, max_cost_usd=0.0015))
    assert store.all().count() == 2


def test_config_and_cli(spark, tmp_path, capsys):
    path = tmp_path / "c.yaml"
    path.write_text("general: {steps: [parse]}\nfilter: {keywords: [a]}\n")
    got = config.load(str(path), {"general": {"output_dir": "o"}})
    assert got["general"] == {"output_dir": "o", "steps": ["parse"], "on_error": "fail"} and got["filter"]["min_author_matches"] == 1
    with pytest.raises(NotImplementedError):
        config.load(overrides={"general": {"steps": ["embed"]}})
    with pytest.raises(ValueError):
        config.load(overrides={"general": {"steps": ["nothing"]}})
    assert cli.main(["--output", str(tmp_path), "inspect", "parse"]) == 0 and "no metadata" in capsys.readouterr().out
    assert cli.main(["--output", str(tmp_path), "status"]) == 0 and json.loads(capsys.readouterr().out.splitlines()[-1])["exists"] is False


def test_registry(spark, tmp_path):
    rows = spark.createDataFrame([("Heart", 5, 2, "Cardiac"), (" ", 1, 0, "x"), ('The "Lung"', 1, 1, "")], "journal_name string, count_total int, count_european int, scope string")
    write_registry(rows, f"{tmp_path}/r")
    assert [tuple(r) for r in read_registry(spark, f"{tmp_path}/r").collect()] == [("heart", "Cardiac")]


def busy(kind, *args):
    """A transport of 25,000 articles on the second of January and none else; ids are numbers."""
    day = date(2024, 1, 2)
    if kind == "fetch_ids":
        return "".join(f"<PubmedArticle><MedlineCitation><PMID>{i}</PMID></MedlineCitation></PubmedArticle>" for i in args[0])
    term, start, end, *page = args
    total = 25_000 if start <= day <= end else 0
    if kind == "search":
        return {"count": total, "web_env": "w", "query_key": "1"}
    if kind == "ids":
        assert page[1] <= 9_999
        return [str(10_000_000 + i) for i in range(page[0], min(page[0] + page[1], total))]
    if total > 9_999:
        raise api.TransportError(400, "too many")
    return ""


def module_of(name, function):
    import sys
    import types

    module = types.ModuleType(name)
    module.call = function
    sys.modules[name] = module
    return f"{name}:call"


def test_a_day_of_too_many_results_is_fetched_whole_by_ids():
    options = {"transport": module_of("quillmine_busy", busy), "term": "x", "start": "2024-01-01", "end": "2024-01-31", "batch": "500", "rate": "100000"}
    reader = api.Reader(options)
    windows = reader.partitions()
    assert all(w.ids and len(w.ids) <= 200 for w in windows) and len({w.batch for w in windows}) == len(windows)
    rows = [next(reader.read(w)) for w in windows]
    assert sum(r[5].count("<PMID>") for r in rows) == 25_000 and all(r[6] is None for r in rows)
    assert fetch.id_chunks(["a", "b", "a", "c"], 2) == [["a", "b"], ["c"]]


def test_windows_of_a_process_share_one_limiter():
    assert api.limiter(7.5) is api.limiter(7.5)
    slept = []
    limit = api.RateLimit(2, clock=lambda: sum(slept), sleep=slept.append)
    for _ in range(6):
        limit.wait()
    assert sum(slept) == pytest.approx(2.0)


def test_cache_expires_when_read(tmp_path):
    now = [100.0]
    cache = ResponseCache(f"{tmp_path}/c", 10, lambda: now[0])
    assert cache.get("n", "p") is None and not cache.has("n", "p")
    cache.put("n", "p", "v")
    cache.put("m", "p", "w")
    now[0] = 110.0
    assert cache.get("n", "p") == "v" and cache.has("m", "p")
    now[0] = 110.5
    assert cache.get("n", "p") is None and not list(tmp_path.glob("c/n/*"))
    cache.put("n", "q", "x")
    assert cache.clear(older_than=5) == 1 and cache.get("n", "q") == "x" and cache.clear("n") == 1 and cache.clear() == 0


def test_answers_are_cached_and_failing_windows_are_told(tmp_path):
    calls = []

    def counted(kind, *args):
        calls.append(kind)
        if kind == "fetch" and args[3] == 50:
            raise api.TransportError(400, "bad")
        return offline(kind, *args)

    options = {"transport": module_of("quillmine_counted", counted), "term": "x", "start": "2024-01-05", "end": "2024-01-10", "batch": "50", "rate": "100000", "cache": f"{tmp_path}/c"}
    for _ in range(2):
        rows = [next(api.Reader(options).read(w)) for w in api.Reader(options).partitions()]
        assert len(rows) == 2 and rows[0][5].count("<PMID>") == 50 and rows[1][5] is None and rows[1][6].startswith("TransportError")
    assert calls == ["search", "fetch", "fetch", "fetch"]  # the failure alone is asked again


def test_requests_to_the_public_service(monkeypatch):
    asked = []

    def get(service, **params):
        asked.append((service, params))
        return json.dumps({"esearchresult": {"count": "3", "webenv": "W", "querykey": "1", "idlist": ["1", "2"]}}) if service == "esearch" else "<x/>"

    monkeypatch.setattr(eutils, "_get", get)
    a, b = date(2024, 1, 1), date(2024, 1, 31)
    assert eutils.call("search", "t", a, b) == {"count": 3, "web_env": "W", "query_key": "1"} and eutils.call("ids", "t", a, b, 0, 2) == ["1", "2"]
    assert eutils.call("fetch", "t", a, b, 200, 100) == "<x/>" and asked[-1][1] | {"WebEnv": "W", "retstart": 200, "retmax": 100} == asked[-1][1]
    assert eutils.call("fetch_ids", ["1", "2"]) == "<x/>" and asked[-1] == ("efetch", {"id": "1,2", "retmode": "xml"})
    assert asked[0][1]["mindate"] == "2024/01/01" and asked[0][1]["usehistory"] == "y"


def test_chat_client_retries_and_types_its_errors(spark, tmp_path, papers):
    slept, answers = [], [api.TransportError(429), api.TransportError(502), {"choices": [{"message": {"content": "{}"}}], "model": "m2", "usage": {"prompt_tokens": 5, "completion_tokens": 2, "cost": 0.1}}]

    def send(url, body, headers):
        answer = answers.pop(0)
        if isinstance(answer, Exception):
            raise answer
        return answer

    got = ChatClient("u", "m", send=send, sleep=slept.append)("s", "p", {})
    assert got == {"content": "{}", "model_used": "m2", "input_tokens": 5, "output_tokens": 2, "cost_usd": 0.1} and len(slept) == 2
    answers[:] = [Unavailable(503)]
    with pytest.raises(Unavailable):
        ChatClient("u", "m", send=send, sleep=slept.append)("s", "p", {})

    def broke(system, prompt, schema):
        from quillmine.sources.chat_api import PaymentRequired

        raise PaymentRequired(402)

    with pytest.raises(Exception, match="402"):
        extract(papers, Store(spark, f"{tmp_path}/y"), "r", FIELDS, broke, settings())


def test_requests_of_a_task_run_at_the_same_time(spark, tmp_path, papers):
    def slow(system, prompt, schema):
        import time

        time.sleep(1)
        return {"content": "{}"}

    import time

    wide = spark.range(24, numPartitions=1).select(F.col("id").cast("string").alias("pmid"), F.lit("t").alias("title"), F.lit("a").alias("abstract"))
    begun = time.monotonic()
    assert extract(wide, Store(spark, f"{tmp_path}/z"), "r", FIELDS, slow, settings(wave=24, concurrency=12))["total"] == 24
    assert time.monotonic() - begun < 20


def test_default_steps_run_on_a_stub(spark, tmp_path, capsys):
    """fetch, parse, deduplicate and extract by configuration alone."""
    (tmp_path / "stub_service.py").write_text(
        "from datetime import date\n"
        "def call(kind, term, start, end, at=0, size=0):\n"
        "    total = 2 * ((end - start).days + 1)\n"
        "    if kind == 'search':\n        return total\n"
        "    if at == 4:\n        from quillmine.sources.literature_api import TransportError\n        raise TransportError(400)\n"
        "    one = '<PubmedArticle><MedlineCitation><PMID>{0}</PMID><Article><ArticleTitle>Title number {0}</ArticleTitle></Article></MedlineCitation></PubmedArticle>'\n"
        "    return ''.join(one.format(start.toordinal() * 100 + i) for i in range(at, min(at + size, total)))\n"
        "def answer(system, prompt, schema):\n    return {'content': '{\"a\": \"x\"}', 'cost_usd': 0.5}\n"
    )
    import sys

    sys.path.insert(0, str(tmp_path))
    spark.sparkContext.addPyFile(f"{tmp_path}/stub_service.py")
    over = {"general": {"output_dir": f"{tmp_path}/out"}, "fetch": {"transport": "stub_service:call", "query": "x", "start": "2024/01/05", "end": "2024/01/06", "batch": 4, "rate": 1000}}
    spine = Spine(spark, f"{tmp_path}/out/papers")
    metas = steps.run(spine, config.load(overrides=over), f"{tmp_path}/out/step_log")
    assert [m.step for m in metas] == ["fetch", "parse", "deduplicate"] and all(m.status == "ok" for m in metas)
    assert metas[0].extra["failed_batches"] > 0 and spine.count() == metas[0].extra["added"] > 0 and spine.table().where("title like 'Title number%'").count() == spine.count()
    again = steps.run(spine, config.load(overrides=config.merge(over, {"general": {"steps": ["fetch"]}})))
    assert again[0].extra["added"] == 0
    few = config.merge(over, {"general": {"steps": ["fetch"]}, "fetch": {"tolerate": 0}})
    with pytest.raises(steps.TooManyFailures):
        steps.run(spine, config.load(overrides=few))
    asked = config.merge(over, {"general": {"steps": ["extract"]}, "extract": {"client": "stub_service:answer", "fields": [{"name": "a", "type": "string"}], "run_id": "r"}})
    meta = steps.run(spine, config.load(overrides=asked), f"{tmp_path}/out/step_log")[0]
    assert meta.extra["total"] == spine.count() and meta.extra["cost_usd"] == pytest.approx(0.5 * spine.count())
    with pytest.raises(ValueError, match="query"):
        steps.run(spine, config.load(overrides={"general": {"steps": ["fetch"]}}))
    assert set(steps.step_logs(f"{tmp_path}/out/step_log")) == {"fetch", "parse", "deduplicate", "extract"} and "extract" in steps.list_steps()
    assert cli.main(["--output", f"{tmp_path}/out", "inspect"]) == 0 and "deduplicate" in json.loads(capsys.readouterr().out)


def test_progress_modes(caplog):
    import io
    import logging

    out = io.StringIO()
    steps.reporter("json", out)({"step": "a"})
    steps.reporter("tty", out)({"step": "b"})
    assert out.getvalue() == '__PROGRESS__ {"step": "a"}\n\r\x1b[Kstep=b'
    with caplog.at_level(logging.INFO, "quillmine"):
        steps.reporter("log")({"step": "c"})
    assert "step=c" in caplog.text
    with pytest.raises(ValueError):
        steps.reporter("none")


def test_exports_of_the_package():
    import quillmine

    assert all(getattr(quillmine, n) for n in quillmine.__all__) and quillmine.run is steps.run and quillmine.load_config is config.load
    with pytest.raises(AttributeError):
        quillmine.nothing
