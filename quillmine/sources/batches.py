"""Batches of articles from JSON files, and their import into the spine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmine.functions.article_xml import split_articles
from quillmine.spine import Spine, first_per_key

BATCH = "query string, batch_id string, retstart long, retmax long, total_count long, timestamp string, data string, _corrupt_record string"


def read_batches(spark: SparkSession, folder: str, pattern: str = "pubmed_batch*.json") -> DataFrame:
    """The batch files of a folder in the order of their names; files that aren't JSON are left out."""
    rows = spark.read.schema(BATCH).option("multiLine", True).option("mode", "PERMISSIVE").option("pathGlobFilter", pattern).json(folder)
    return rows.withColumn("file", F.col("_metadata.file_name")).where("_corrupt_record is null and data is not null").drop("_corrupt_record")


def articles(batches: DataFrame) -> DataFrame:
    """Rows of the spine from batches, the first of each PMID."""
    found = split_articles(batches.select("file", F.col("timestamp").alias("fetch_date"), F.col("query").alias("fetch_query"), F.col("batch_id").alias("fetch_batch"), "data"))
    first = first_per_key(found.withColumn("__order", F.struct("file", "article_pos")), "pmid", order="__order")
    return first.orderBy("__order").select("pmid", "raw_xml", "fetch_date", "fetch_query", "fetch_batch")


def import_folder(spine: Spine, folder: str) -> dict:
    """Append what the spine lacks; how many files and articles there were, and how many were known or repeated."""
    batches = read_batches(spine.spark, folder).cache()
    files = batches.select("file").distinct().count()
    total = split_articles(batches).count()
    fresh = articles(batches).join(spine.keys(), "pmid", "left_anti")
    before = spine.count()
    spine.append(fresh)
    added = spine.count() - before
    batches.unpersist()
    return {"files": files, "articles": added, "duplicates": total - added}
