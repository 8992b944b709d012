"""The store of extraction records: upserts, what is pending, summaries and export; and cached responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY = ("pmid", "schema_name", "run_id")


def latest(records: DataFrame, order: str = "seq") -> DataFrame:
    """Of each paper, schema and run the record that was written last."""
    row = F.row_number().over(Window.partitionBy(*KEY).orderBy(F.desc(order)))
    return records.withColumn("__row", row).where("__row = 1").drop("__row")


def done(records: DataFrame, schema_name: str, run_id: str) -> DataFrame:
    return records.where((F.col("schema_name") == schema_name) & (F.col("run_id") == run_id) & F.col("error_label").isNull()).select("pmid").distinct()


def pending(papers: DataFrame, records: DataFrame, schema_name: str, run_id: str) -> DataFrame:
    """Papers without a success in this run; failures are tried again."""
    return papers.join(done(records, schema_name, run_id), "pmid", "left_anti")


def exists(records: DataFrame, pmid: str, schema_name: str, run_id: str) -> bool:
    found = records.where((F.col("pmid") == pmid) & (F.col("schema_name") == schema_name) & (F.col("run_id") == run_id))
    return bool(found.limit(1).count())


def summary(records: DataFrame, *by: str) -> DataFrame:
    """Totals of a run: an error label makes a failure, a fix without one a repair."""
    good = F.col("error_label").isNull()
    return records.groupBy(*by).agg(
        F.count("*").alias("total"), F.count_if(good).alias("n_success"), F.count_if(~good).alias("n_failed"),
        F.count_if(good & F.col("fix_applied").isNotNull()).alias("n_repaired"), F.round(F.coalesce(F.sum("cost_usd"), F.lit(0.0)), 6).alias("total_cost"),
        F.coalesce(F.min("created_at"), F.lit("")).alias("first_at"), F.coalesce(F.max("created_at"), F.lit("")).alias("last_at"))


def snapshot_summary(records: DataFrame, papers: DataFrame) -> DataFrame:
    """As reports count: a success must also have JSON that is an object, and any fix is a repair."""
    parsed = F.try_parse_json("extracted_json").isNotNull() & F.col("extracted_json").rlike(r"^\s*\{")
    good = F.col("error_label").isNull() & F.coalesce(parsed, F.lit(False))
    n = papers.agg(F.countDistinct("pmid").alias("papers"))
    out = records.agg(F.count("*").alias("total"), F.count_if(good).alias("n_success"), F.count_if(F.coalesce("fix_applied", F.lit("")) != "").alias("n_repaired"))
    return out.crossJoin(F.broadcast(n)).withColumn("coverage_pct", F.round(100.0 * F.col("total") / F.greatest("papers", F.lit(1)), 2))  # one row each


def runs(records: DataFrame) -> DataFrame:
    return records.select("schema_name", "run_id").distinct().orderBy("schema_name", F.desc("run_id"))


def latest_run(records: DataFrame) -> DataFrame:
    """Each schema's run with the last record (ties: the larger name)."""
    return records.groupBy("schema_name").agg(F.max_by("run_id", F.struct("created_at", "run_id")).alias("run_id"))


def field_distribution(records: DataFrame, fields: list[str]) -> DataFrame:
    """(field, value, n) of fields in the extracted JSON; nulls are left out, failures are counted too."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.get_json_object("extracted_json", f"$.{f}").alias("value")) for f in fields])
    return records.select(F.inline(pairs)).where("value is not null").groupBy("field", "value").agg(F.count("*").alias("n"))


def export_lines(records: DataFrame) -> DataFrame:
    """One line of JSON for each success, by key; what doesn't parse is wrapped."""
    good = records.where("extracted_json is not null and error_label is null")
    content = F.when(F.try_parse_json("extracted_json").isNotNull(), F.col("extracted_json")).otherwise(F.to_json(F.struct(F.col("extracted_json").alias("_raw"))))
    return good.orderBy("pmid").select(F.concat(F.lit('{"pmid": '), F.to_json(F.array("pmid")).substr(F.lit(2), F.char_length(F.to_json(F.array("pmid"))) - 2), F.lit(', "data": '), content, F.lit("}")).alias("value"))


def cache_live(cache: DataFrame, now: float, ttl: float) -> DataFrame:
    """Responses that haven't expired; one of exactly that age is alive."""
    return cache.where(F.lit(now) - F.col("created_at") <= ttl)


def cache_clear(cache: DataFrame, namespace: str | None = None, older_than: float | None = None, now: float = 0.0) -> DataFrame:
    """What is left after clearing a namespace, old entries, or old entries of a namespace; or everything."""
    gone = F.lit(True)
    if namespace is not None:
        gone = gone & (F.col("namespace") == namespace)
    if older_than is not None:
        gone = gone & (F.lit(now) - F.col("created_at") > older_than)
    return cache.where(~gone)


def cache_statistics(cache: DataFrame) -> DataFrame:
    return cache.groupBy("namespace").agg(F.count("*").alias("entries"), F.sum(F.char_length("value")).alias("size"))


def with_papers(papers: DataFrame, records: DataFrame, on: str = "pmid") -> DataFrame:
    """Papers with their records: those that have both, one row a record."""
    return papers.join(records, on)


def looked_up(records: DataFrame, papers: DataFrame, columns: list[str], on: str = "pmid", order: str = "_pos") -> DataFrame:
    """Records with columns of their paper, null where it is missing; of papers with one key the last counts."""
    last = papers.groupBy(on).agg(F.max_by(F.struct(*columns), order).alias("__paper"))
    return records.join(last, on, "left").select(*records.columns, *[F.col(f"__paper.{c}").alias(c) for c in columns])


def extracted_only(papers: DataFrame, records: DataFrame, on: str = "pmid") -> DataFrame:
    """Papers that have a record."""
    return papers.join(records.select(on).distinct(), on, "left_semi")


ORIGINAL = ["OriginalResearch", "Original Research"]  # fixed values: the forms of the answer that counts


def original_journals(records: DataFrame, journal: str, study: str, scopes: DataFrame, k: int = 10, order: str = "seq") -> DataFrame:
    """(name, count, scope): the journals with most records of original research, ties as they first occur;
    ``scopes`` is (journal in lower case, scope)."""
    named = records.where(F.col(study).isin(ORIGINAL)).select(F.trim(journal).alias("name"), F.col(order).alias("__order")).where("name <> ''")
    top = named.groupBy("name").agg(F.count("*").alias("count"), F.min("__order").alias("__first")).orderBy(F.desc("count"), "__first").limit(k)
    return top.join(scopes, F.lower("name") == scopes["journal"], "left").select("name", "count", F.coalesce("scope", F.lit("Other")).alias("scope"))
