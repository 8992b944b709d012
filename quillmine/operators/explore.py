"""Interactive queries: a chain of filters, then a sample."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from quillmine.spine import POS

MOST_KEYS = 100_000  # keys of the first rows that a stride may go through on the driver


@dataclass
class Query:
    year_min: int | None = None
    year_max: int | None = None
    has_doi: bool = False
    has_abstract: bool = False
    excluded: str = "all"  # all, included or excluded
    title_contains: str = ""
    title_use_regex: bool = False
    language: str | None = None
    columns: list[str] | None = None
    limit: int = 100
    mode: str = "first"  # first, random or stride
    stride: int = 10
    seed: int = 42


def valid_regex(pattern: str) -> bool:
    try:
        re.compile(pattern)
    except re.error:
        return False
    return True


def filtered(papers: DataFrame, q: Query) -> DataFrame:
    """Each filter holds only where its column exists; null years, DOIs and titles fail theirs.

    Titles are searched case-sensitively; a pattern that isn't one matches nothing."""
    has = set(papers.columns)
    out = papers
    if "year" in has:
        out = out if q.year_min is None else out.where(F.col("year") >= q.year_min)
        out = out if q.year_max is None else out.where(F.col("year") <= q.year_max)
    for wanted, column in ((q.has_doi, "doi"), (q.has_abstract, "abstract")):
        if wanted and column in has:
            out = out.where(F.col(column) != "")
    if "exclude_flag" in has and q.excluded != "all":
        flagged = F.coalesce("exclude_flag", F.lit(False))
        out = out.where(flagged if q.excluded == "excluded" else ~flagged)
    if q.title_contains and "title" in has:
        if not q.title_use_regex:
            out = out.where(F.col("title").contains(q.title_contains))
        else:
            out = out.where(F.col("title").rlike(q.title_contains) if valid_regex(q.title_contains) else F.lit(False))
    if q.language and "language" in has:
        out = out.where(F.col("language") == q.language)
    return out


def sample_keys(found: DataFrame, q: Query, key: str = "pmid") -> DataFrame:
    """Keys and positions of the sample: the first rows, a repeatable random choice, or every so manieth row.

    The random choice orders by a hash of key and seed, so it is the same however rows are partitioned."""
    slim = found.select(key, POS)
    if q.mode == "first":
        return slim.orderBy(POS).limit(q.limit)
    if q.mode == "random":
        return slim.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(str(q.seed)))), POS).limit(q.limit)
    return strided(slim, q.stride).orderBy(POS).limit(q.limit)


def strided(slim: DataFrame, stride: int) -> DataFrame:
    """Every ``stride``-th row by position, the first included, numbered within ranges of positions and
    not in one task: ranges' counts give each its start."""
    parts = slim.withColumn("__part", F.floor(F.col(POS) / 100_000))
    sizes = parts.groupBy("__part").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = parts.join(sizes.select("__part", before.alias("__before")), "__part")
    row = F.row_number().over(Window.partitionBy("__part").orderBy(POS)) - 1 + F.col("__before")
    return placed.withColumn("__row", row).where(F.col("__row") % stride == 0).drop("__part", "__before", "__row")


def explore(papers: DataFrame, q: Query) -> tuple[DataFrame, int]:
    """(sample, number of matches): keys are sampled first, wide columns are then read for them alone.

    Matches are counted by the job that samples.  At most ``limit`` rows come to the driver, which gives
    them in order; a stride's rows are every so manieth of the first limit * stride."""
    spark, seen = papers.sparkSession, Observation()
    columns = [c for c in dict.fromkeys(q.columns or papers.columns) if c in papers.columns]
    needed = columns if q.mode == "first" else ["pmid"]  # selected before they are observed, or all would be read
    found = filtered(papers, q).select(*dict.fromkeys([*needed, POS])).observe(seen, F.count(F.lit(1)).alias("n"))
    if q.mode == "first":
        rows = found.orderBy(POS).limit(q.limit).select(*columns).collect()
    else:
        if q.mode == "stride" and q.limit * q.stride <= MOST_KEYS:
            keys = [r for r in found.select("pmid", POS).orderBy(POS).limit((q.limit - 1) * q.stride + 1).collect()][:: q.stride]
        else:
            keys = sample_keys(found, q).collect()
        wanted = papers.where(F.col("pmid").isin([r["pmid"] for r in keys]) & F.col(POS).isin([r[POS] for r in keys]))
        rows = wanted.orderBy(POS).select(*columns).collect()
    return spark.createDataFrame(rows, papers.select(*columns).schema), seen.get["n"]
