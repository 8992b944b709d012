"""Steps over the spine, run in the order of the configuration, each leaving its metadata."""

from __future__ import annotations

import json
import logging
import sys
import time
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from datetime import UTC, date, datetime

from pyspark.sql import functions as F

from quillmine import files

from quillmine.functions.article_xml import parse_frame
from quillmine.functions.text import exclusion_reason, llm_input
from quillmine.operators.affiliations import KeywordFilter, filter_papers, filter_statistics
from quillmine.operators.dedup import DedupConfig, deduplicate, statistics
from quillmine.plans.extract import Store, extract
from quillmine.plans.fetch import check_range, resume_from
from quillmine.plans.fields import Field
from quillmine.sources.batches import articles
from quillmine.sources.chat_api import ChatClient
from quillmine.sources.literature_api import LiteratureSource, transport
from quillmine.spine import Spine
from quillmine.streaming.ingest import resume_date


@dataclass
class StepMeta:
    step: str
    started_at: str
    seconds: float = 0.0
    rows_before: int = 0
    rows_after: int = 0
    status: str = "ok"
    error: str = ""
    extra: dict = field(default_factory=dict)


class Step:
    """A step: ``run`` does it and gives what its metadata should say; what isn't fit raises ValueError."""

    def validate_input(self, spine: Spine, config: dict) -> None:
        """Whether the step can begin."""

    def run(self, spine: Spine, config: dict) -> dict:
        raise NotImplementedError

    def validate_output(self, spine: Spine, config: dict) -> None:
        """Whether the step has left what it should."""


class TooManyFailures(RuntimeError):
    pass


class FetchStep(Step):
    """Fetch what a query finds, from some days before the latest fetch on, and append what the spine lacks.

    Up to ``tolerate`` batches may fail; they are told in the metadata and fetched again by the next run,
    since it begins with an overlap."""

    def validate_input(self, spine: Spine, config: dict) -> None:
        if not config.get("query"):
            raise ValueError("fetch.query is empty")
        check_range(config["start"], config.get("end") or date.today().strftime("%Y/%m/%d"))
        transport(config["transport"])

    def run(self, spine: Spine, config: dict) -> dict:
        spine.merge_staging()
        begin, end = config["start"], config.get("end") or date.today().strftime("%Y/%m/%d")
        if (latest := resume_date(spine)) and (later := resume_from(latest)) <= end:
            begin = max(begin, later)  # a range that ended before is gone through again, for what failed then
        start, end = check_range(begin, end)
        options = {"transport": config["transport"], "term": config["query"], "start": start.isoformat(), "end": end.isoformat(), "timestamp": datetime.now(UTC).isoformat()}
        options |= {k: str(config[k]) for k in ("batch", "rate", "readers", "cache", "ttl") if config.get(k) is not None}
        spine.spark.dataSource.register(LiteratureSource)
        held = f"{spine.path}-fetch/{uuid.uuid4().hex}"  # answers are kept whatever becomes of the step
        spine.spark.read.format("literature").options(**options).load().write.parquet(held)
        batches = spine.spark.read.parquet(held)
        n, bad = batches.agg(F.count("*"), F.count_if(F.col("error").isNotNull())).first()
        if bad > config["tolerate"]:
            raise TooManyFailures(f"{bad} of {n} batches failed")
        rank = F.transform(F.split("batch_id", "_"), lambda x: F.lpad(x, 12, "0"))  # batches in their order
        found = articles(batches.where("data is not null").withColumn("file", F.array_join(rank, "_")))
        before = spine.count()
        fresh = found.join(spine.keys(), "pmid", "left_anti") if spine.exists() else found
        spine.append_staging(fresh)
        return {"batches": n, "failed_batches": bad, "added": spine.merge_staging() - before, "from": begin}


class ExtractStep(Step):
    """Ask a model about each paper that the run lacks; records go to ``extractions`` beside the spine."""

    def validate_input(self, spine: Spine, config: dict) -> None:
        if not config["fields"]:
            raise ValueError("extract.fields is empty")
        if not config.get("client") and not (config.get("url") and config.get("model")):
            raise ValueError("extract needs a client, or a url and a model")

    def run(self, spine: Spine, config: dict) -> dict:
        client = transport(config["client"]) if config.get("client") else ChatClient(config["url"], config["model"], config["key_variable"])
        fields = [f if isinstance(f, Field) else Field(**f) for f in config["fields"]]
        return extract(spine.table(), Store(spine.spark, f"{config['output_dir']}/extractions"), config["run_id"], fields, client, config)


def unparsed(papers):
    """Rows without a title; one that was parsed to an empty title is parsed again."""
    return papers if "title" not in papers.columns else papers.where("title is null or title = ''")


def parse_step(spine: Spine, config: dict) -> dict:
    """Parse what isn't parsed yet.  remove_html, min_abstract_length and language_filter, all off by default,
    strip tags from titles and abstracts and flag what is too short or of another language."""
    todo = unparsed(spine.table()).select("pmid", "raw_xml")
    parsed = parse_frame(todo)
    if config.get("remove_html"):
        parsed = parsed.withColumns({c: F.regexp_replace(c, "<[^>]+>", "") for c in ("title", "abstract")})
    if config.get("min_abstract_length"):
        parsed = parsed.withColumn("abstract_too_short", F.char_length("abstract") < config["min_abstract_length"])
    if config.get("language_filter"):
        parsed = parsed.withColumn("other_language", ~F.col("language").isin(config["language_filter"]))
    if config.get("prepare_llm_input"):
        parsed = parsed.withColumn("llm_input", llm_input(F.col("title"), F.col("abstract"), F.col("mesh_terms"), F.col("keywords")))
    if config.get("flag_exclusions"):
        parsed = parsed.withColumn("exclude_reason", exclusion_reason(F.col("pub_type"))).withColumn("exclude_flag", F.col("exclude_reason") != "")
    n = todo.count()
    if n:
        spine.add_columns(parsed.drop("raw_xml"))
    return {"parsed": n}


def dedup_step(spine: Spine, config: dict) -> dict:
    wanted = ["pmid", "doi", "title", "year", "is_retracted", "retraction_of_pmid", "publication_status", "_pos"]
    papers = spine.read(wanted)
    stay, flags = deduplicate(papers, DedupConfig(**{k: v for k, v in config.items() if k in DedupConfig.__dataclass_fields__}))
    found = statistics(papers, stay, flags.persist()).first().asDict()
    spine.write(spine.table().join(stay.select("pmid", "_pos"), ["pmid", "_pos"], "left_semi"))
    flags.unpersist()
    return found


def filter_step(spine: Spine, config: dict) -> dict:
    wanted = KeywordFilter(**{k: v for k, v in config.items() if k in KeywordFilter.__dataclass_fields__})
    tagged = filter_papers(spine.table(), KeywordFilter(**{**asdict(wanted), "drop_non_matching": False}))
    found = filter_statistics(tagged, wanted.output_column).first().asDict()
    spine.write(tagged.where(wanted.output_column).drop(wanted.output_column) if wanted.drop_non_matching else tagged)
    return found


REGISTRY: dict[str, Step | Callable[[Spine, dict], dict]] = {"fetch": FetchStep(), "parse": parse_step, "deduplicate": dedup_step, "filter": filter_step, "extract": ExtractStep()}


def register(name: str, step: Step | Callable[[Spine, dict], dict]) -> None:
    REGISTRY[name] = step


def list_steps() -> list[str]:
    return list(REGISTRY)


def execute(name: str, spine: Spine, config: dict) -> dict:
    """One step: checks before, the work, checks after."""
    if name not in REGISTRY:
        raise KeyError(f"no step {name!r} is registered")
    step = REGISTRY[name]
    if not isinstance(step, Step):
        return step(spine, config)
    step.validate_input(spine, config)
    told = step.run(spine, config)
    step.validate_output(spine, config)
    return told


def run(spine: Spine, config: dict, log: str | None = None, tell: Callable[[dict], None] | None = None) -> list[StepMeta]:
    """Run the configured steps.  A failing step ends the run, or is passed over with on_error: skip; either
    way its metadata is written to ``log`` and told as a progress event."""
    out = []
    for name in config["general"]["steps"]:
        meta, begun = StepMeta(name, datetime.now(UTC).isoformat()), time.monotonic()
        out.append(meta)
        try:
            meta.rows_before = spine.count()
            meta.extra = execute(name, spine, {"output_dir": config["general"]["output_dir"], **config.get(name, {})})
            meta.rows_after = spine.count()
        except Exception as e:
            meta.status, meta.error = "failed", str(e)
            if config["general"]["on_error"] != "skip":
                raise
        finally:
            meta.seconds = round(time.monotonic() - begun, 3)
            if log:
                files.write_text(f"{log}/{name}_meta.json", json.dumps(asdict(meta), default=str))
            if tell:
                tell({"step": name, "status": meta.status, "seconds": meta.seconds})
    return out


def step_logs(log: str) -> dict[str, dict]:
    """The metadata of every step that has left some, by step."""
    return {n.removesuffix("_meta.json"): json.loads(files.read_text(f"{log}/{n}")) for n in files.names(log) if n.endswith("_meta.json")}


def progress_line(event: dict) -> str:
    return "__PROGRESS__ " + json.dumps(event)


def reporter(mode: str = "json", out=None) -> Callable[[dict], None]:
    """What tells events: as lines of JSON, as a line that is written over (tty), or as log records."""
    out = out or sys.stdout
    short = lambda e: " ".join(f"{k}={v}" for k, v in e.items())
    if mode == "json":
        return lambda e: print(progress_line(e), file=out, flush=True)
    if mode == "tty":
        return lambda e: print("\r\x1b[K" + short(e), end="", file=out, flush=True)
    if mode == "log":
        return lambda e: logging.getLogger("quillmine").info(short(e))
    raise ValueError(f"unknown mode {mode!r}")
