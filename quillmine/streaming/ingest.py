"""Ingest of article batches as a stream of files.

Each trigger takes the files that are new, splits them, leaves out what the spine has and appends the
rest.  The checkpoint remembers files, the anti-join keys, so a batch that runs twice adds nothing and
no state grows with the corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillmine.sources.batches import BATCH, articles
from quillmine.spine import Spine


def stream_batches(spark: SparkSession, folder: str, pattern: str = "*.json", files: int = 1000) -> DataFrame:
    rows = spark.readStream.schema(BATCH.replace(", _corrupt_record string", "")).option("multiLine", True).option("maxFilesPerTrigger", files).option("pathGlobFilter", pattern).json(folder)
    return rows.withColumn("file", F.col("_metadata.file_name")).where("data is not null")


def ingest(spark: SparkSession, folder: str, spine: Spine, checkpoint: str, pattern: str = "*.json") -> StreamingQuery:
    """Take in all files that are new, then stop; staging left by a run that broke off is merged first."""
    spine.merge_staging()

    def commit(batch: DataFrame, _: int) -> None:
        fresh = articles(batch).join(spine.keys(), "pmid", "left_anti")
        if fresh.limit(1).count():
            spine.append_staging(fresh)
            spine.merge_staging()

    return stream_batches(spark, folder, pattern).writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def resume_date(spine: Spine) -> str | None:
    """The latest fetch date, as ISO text, which sorts as the dates do."""
    return spine.table().agg(F.max("fetch_date")).first()[0] if spine.exists() else None
