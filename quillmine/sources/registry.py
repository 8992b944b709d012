"""The journal registry: a CSV table of journals with their scope."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """(journal, scope) with journals in lower case; blank names and scopes are left out."""
    rows = spark.read.option("header", True).csv(path).select(F.lower(F.trim("journal_name")).alias("journal"), F.trim("scope").alias("scope"))
    return rows.where("journal <> '' and scope <> ''")


def write_registry(rows: DataFrame, path: str) -> None:
    rows.coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
