"""Extraction by a language model, in waves.

A wave is a bounded number of papers.  Their requests run on the executors, their records are appended
to the store, and the driver adds up the cost before it starts another wave; so cost caps and resuming
are exact to a wave, and a lost executor repeats no more than its part of one.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmine import schemas
from quillmine.functions import text as T
from quillmine.functions.json_repair import repair, valid
from quillmine.operators.extractions import latest, pending
from quillmine.plans.fields import Field, json_schema
from quillmine.sources.chat_api import PaymentRequired


class CostCapExceeded(RuntimeError):
    pass


class ErrorRateExceeded(RuntimeError):
    pass


class Store:
    """Extraction records in Parquet, by schema and run; what is written later replaces what was."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def all(self) -> DataFrame:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        if not path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], f"{schemas.EXTRACTIONS}, seq long")
        return latest(self.spark.read.schema(f"{schemas.EXTRACTIONS}, seq long").parquet(self.path))

    def write(self, records: DataFrame) -> None:
        records.withColumn("seq", F.lit(time.time_ns())).write.mode("append").partitionBy("schema_name", "run_id").parquet(self.path)


def prompts(papers: DataFrame, config: dict) -> DataFrame:
    """(pmid, prompt)."""
    has = papers.columns
    col = lambda c, on=True: F.col(c) if on and c in has else F.lit(None).cast("string")
    block = T.author_block(F.col("authors")) if "authors" in has else F.lit("")
    extra = {c: F.col(c) for c in config["extra_columns"] if c in has}
    return papers.select("pmid", T.user_message(col("title", config["include_title"]), col("abstract", config["include_abstract"]), block, **extra).alias("prompt"))


def gate(papers: DataFrame, column: str | None) -> DataFrame:
    """Rows whose gate is true: a boolean, or text that isn't blank, no, false or 0."""
    if not column or column not in papers.columns:
        return papers
    c = F.col(column)
    if papers.schema[column].dataType.simpleString() == "boolean":
        return papers.where(c)
    return papers.where(~F.lower(F.trim(c.cast("string"))).isin("", "no", "false", "0"))


def extract(papers: DataFrame, store: Store, run_id: str, fields: list[Field], client: Callable[[str, str, dict], dict], config: dict, fixer: Callable[[str], str] | None = None) -> dict:
    """Extract what the run lacks; counts of the run so far.

    ``client`` takes the system message, the prompt and the schema and gives ``content`` with any of the
    record's fields on models, tokens and cost; what it raises becomes a failed record, but for
    ``PaymentRequired``, which ends the run.  Each task has ``concurrency`` requests under way at a time.
    """
    schema, name = json_schema(fields, config["schema_name"]), config["schema_name"]
    system, pattern, concurrency = T.system_message(config["user_instruction"]), config["pattern_fix"], config.get("concurrency", 1)
    spark = papers.sparkSession
    types = spark.createDataFrame([], schemas.EXTRACTIONS).schema

    def ask(pmid: str, prompt: str) -> dict:
        begun = time.monotonic()
        record = {"pmid": pmid, "schema_name": name, "run_id": run_id, "raw_response": "", "created_at": datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%S.%fZ")}
        try:
            answer = client(system, prompt, schema)
        except PaymentRequired:
            raise
        except Exception as e:  # noqa: BLE001  a failed request is a record
            return record | {"error_label": f"api_error: {type(e).__name__}"}
        raw = answer.get("content") or ""
        content, fixed, history, error = (raw, None, "[]", None) if valid(raw) else repair(raw, pattern, fixer)
        record |= {k: v for k, v in answer.items() if k in types.names and k not in ("pmid", "schema_name", "run_id")}
        return record | {"raw_response": raw, "extracted_json": None if error else content, "fix_applied": fixed, "fix_history": history, "error_label": error, "latency_ms": int((time.monotonic() - begun) * 1000)}

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        for batch in batches:
            with ThreadPoolExecutor(max(1, concurrency)) as pool:
                made = list(pool.map(ask, batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in made], to_arrow_type(f.dataType)) for f in types], types.names)

    spent = lambda: store.all().where((F.col("schema_name") == name) & (F.col("run_id") == run_id)).agg(F.coalesce(F.sum("cost_usd"), F.lit(0.0))).first()[0]
    cap, last = config["max_cost_usd"], None
    while True:
        left = pending(gate(papers, config["filter_column"]), store.all(), name, run_id)
        if last is not None:  # waves go by key, so a failure isn't tried again in the same call
            left = left.where(F.col("pmid") > last)
        keys = [(r.pmid,) for r in left.select("pmid").orderBy("pmid").limit(config["wave"]).collect()]  # a wave's keys, whose number is a parameter
        if not keys:
            break
        if cap is not None and (cost := spent()) >= cap:
            raise CostCapExceeded(f"{cost:.4f} of {cap} spent")
        wave = spark.createDataFrame(keys, "pmid string")
        asked = prompts(papers.join(F.broadcast(wave), "pmid", "left_semi"), config)
        store.write(asked.repartition(max(1, spark.sparkContext.defaultParallelism), "pmid").mapInArrow(run, types))
        last = keys[-1][0]
    n, bad = store.all().where((F.col("schema_name") == name) & (F.col("run_id") == run_id)).agg(F.count("*"), F.count_if(F.col("error_label").isNotNull())).first()
    if n and bad / n > config["max_error_rate"]:
        raise ErrorRateExceeded(f"{bad} of {n} extractions failed")
    return {"total": n, "failed": bad, "cost_usd": spent(), "schema": json.dumps(schema)}
