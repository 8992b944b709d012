"""The driver's tables seen as a literature corpus, for Spark and, as common table expressions, for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def papers(spark: SparkSession, sf: str) -> DataFrame:
    """A document is a paper: its first line the title, all of it the abstract; toxic ones were retracted."""
    marked = table(spark, sf, "labels").select("doc_id", "toxic")
    rows = table(spark, sf, "documents").join(marked, "doc_id", "left")
    return rows.select(
        F.col("doc_id").cast("string").alias("pmid"), F.substring_index("text", "\n", 1).alias("title"), F.col("text").alias("abstract"), F.col("lang").alias("language"), F.col("source").alias("journal"),
        (F.lit(2001) + F.col("doc_id") % 26).cast("long").alias("year"), F.when(F.col("doc_id") % 5 != 0, F.concat(F.lit("10.1/"), F.floor(F.col("doc_id") / 3).cast("string"))).alias("doi"),
        F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("is_retracted"), F.col("doc_id").alias("_pos"))


PAPERS = """p AS (SELECT CAST(d.doc_id AS VARCHAR) AS pmid, split_part(d.text, chr(10), 1) AS title, d.text AS abstract, d.lang AS language, d.source AS journal,
  CAST(2001 + d.doc_id % 26 AS BIGINT) AS year, CASE WHEN d.doc_id % 5 <> 0 THEN concat('10.1/', CAST(d.doc_id // 3 AS VARCHAR)) END AS doi,
  coalesce(l.toxic = 1, false) AS is_retracted, d.doc_id AS pos FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def extractions(spark: SparkSession, sf: str) -> DataFrame:
    """An event is a record: its user the paper, its type the schema, its day the run, its value the cost."""
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("pmid"), F.col("event_type").alias("schema_name"), F.to_date("ts").cast("string").alias("run_id"), F.col("props").alias("extracted_json"),
        F.when(F.col("value") < 5, "pattern_fix_failed").alias("error_label"), F.when((F.col("value") >= 1) & (F.col("value") < 20), "pattern").alias("fix_applied"),
        F.col("value").alias("cost_usd"), stamp.alias("created_at"), F.col("event_id").alias("seq"))


EXTRACTIONS = """e AS (SELECT CAST(user_id AS VARCHAR) AS pmid, event_type AS schema_name, CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id, props AS extracted_json,
  CASE WHEN value < 5 THEN 'pattern_fix_failed' END AS error_label, CASE WHEN value >= 1 AND value < 20 THEN 'pattern' END AS fix_applied,
  value AS cost_usd, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS created_at, event_id AS seq FROM events)"""


def authored(spark: SparkSession, sf: str) -> DataFrame:
    """A conversation is a paper: each turn an author, its role the name, its text the affiliation."""
    turns = table(spark, sf, "conversations").groupBy(F.col("conv_id").cast("string").alias("pmid")).agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    author = F.transform("turns", lambda t: F.struct(t["role"].alias("last_name"), F.substring(t["role"], 1, 1).alias("initials"), t["text"].alias("affiliation"), (t["role"] == "user").alias("is_corresponding")))
    return turns.select("pmid", F.to_json(author).alias("authors"))


# A name for each of the 25 nations by its key, so that names of countries meet what looks for them.
COUNTRIES = ["united states", "canada", "germany", "france", "england", "scotland", "ireland", "sweden", "italy", "spain", "poland", "russia", "china", "japan", "south korea", "india", "thailand", "turkey", "iran", "egypt", "australia", "brazil", "south africa", "oman", "atlantis"]
COUNTRY = "[" + ", ".join(f"'{c}'" for c in COUNTRIES) + "][CAST(n_nationkey AS INTEGER) + 1]"


def residents(spark: SparkSession, sf: str) -> DataFrame:
    """A customer is a paper: its nation the country, the nation's region the region, its segment the specialty."""
    c, n, r = (table(spark, sf, t) for t in ("customer", "nation", "region"))
    n = n.withColumn("country", F.element_at(F.array(*map(F.lit, COUNTRIES)), (F.col("n_nationkey") + 1).cast("int")))
    return c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey).join(F.broadcast(r), n.n_regionkey == r.r_regionkey)  # 25 and 5 rows


RESIDENTS = f"g AS (SELECT *, {COUNTRY} AS country FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"


def studies(spark: SparkSession, sf: str) -> DataFrame:
    """An order is a paper of its year, with its customer's nation and segment and its status."""
    o = table(spark, sf, "orders")
    c = residents(spark, sf).select("c_custkey", "country", "r_name", "c_mktsegment")
    return o.join(c, o.o_custkey == c.c_custkey).select(F.col("o_orderkey").cast("string").alias("pmid"), F.year("o_orderdate").cast("long").alias("year"), "country", F.col("r_name").alias("region"), F.col("c_mktsegment").alias("specialty"), F.col("o_orderpriority").alias("study_type"), F.col("o_orderstatus").alias("status"))


STUDIES = f"""{RESIDENTS}, s AS (SELECT CAST(o_orderkey AS VARCHAR) AS pmid, CAST(year(o_orderdate) AS BIGINT) AS year, country, r_name AS region,
  c_mktsegment AS specialty, o_orderpriority AS study_type, o_orderstatus AS status FROM orders JOIN g ON o_custkey = c_custkey)"""


# Steps by which the four variants of a title grow, so that its neighbours are alike and others may not be.
STEPS = (0, 2, 5, 40)


def variants(spark: SparkSession, sf: str) -> DataFrame:
    """A customer is four papers of like titles: one of another year, some with copied keys, DOIs and titles,
    some retracted, some notices of a retraction.  Customers are dealt out first, as a file may be read by one task."""
    v, k = F.col("v"), F.col("c_custkey")
    base = F.concat(F.lit("Case "), k.cast("string"), F.lit(" of "), "country", F.lit(" seen by "), "c_mktsegment")
    grown = F.concat(base, F.repeat(F.lit("x"), F.element_at(F.array(*map(F.lit, STEPS)), v + 1)))
    rows = residents(spark, sf).select("c_custkey", "country", "c_mktsegment").repartition("c_custkey").select("*", F.explode(F.array(*map(F.lit, range(4)))).alias("v"))
    return rows.select(
        F.when((k % 17 == 0) & (v == 3), k * 4).otherwise(k * 4 + v).cast("string").alias("pmid"), F.when((k % 5 == 0) & (v == 3), F.concat(F.lit(" "), F.upper(base))).otherwise(grown).alias("title"),
        F.when(k % 7 != 0, F.lit(2001) + F.when(v == 3, 1).otherwise(0)).cast("long").alias("year"), F.when((k % 3 == 0) & v.isin(1, 2), F.concat(F.lit("10.1/"), k.cast("string"))).otherwise("").alias("doi"),
        ((k % 11 == 0) & (v == 1)).alias("is_retracted"), F.when((k % 13 == 0) & (v == 2), "1").otherwise("").alias("retraction_of_pmid"), (k * 4 + v).cast("long").alias("_pos"))


VARIANTS = f"""{RESIDENTS}, v0 AS (SELECT *, concat('Case ', CAST(c_custkey AS VARCHAR), ' of ', country, ' seen by ', c_mktsegment) AS base FROM g, range(4) AS r(v)),
 v1 AS (SELECT c_custkey AS k, v, CAST(CASE WHEN c_custkey % 17 = 0 AND v = 3 THEN c_custkey * 4 ELSE c_custkey * 4 + v END AS VARCHAR) AS pmid,
  CASE WHEN c_custkey % 5 = 0 AND v = 3 THEN ' ' || upper(base) ELSE base || repeat('x', {list(STEPS)}[CAST(v AS INTEGER) + 1]) END AS title,
  CAST(CASE WHEN c_custkey % 7 <> 0 THEN 2001 + CASE WHEN v = 3 THEN 1 ELSE 0 END END AS BIGINT) AS year, CASE WHEN c_custkey % 3 = 0 AND v IN (1, 2) THEN '10.1/' || CAST(c_custkey AS VARCHAR) ELSE '' END AS doi,
  c_custkey % 11 = 0 AND v = 1 AS is_retracted, CASE WHEN c_custkey % 13 = 0 AND v = 2 THEN '1' ELSE '' END AS retraction_of_pmid, c_custkey * 4 + v AS pos FROM v0)"""
# Of two variants one is the other's beginning, so their longest common subsequence is the shorter.
ALIKE = """pairs AS (SELECT a.k, a.v AS va, b.v AS vb, a.pmid AS a, b.pmid AS b, 200.0 * least(length(a.t), length(b.t)) / (length(a.t) + length(b.t)) AS ratio FROM {0} a JOIN {0} b
  ON a.k = b.k AND a.pos < b.pos AND a.year IS NOT DISTINCT FROM b.year AND least(length(a.t), length(b.t)) * 100.0 >= greatest(length(a.t), length(b.t)) * 90.0 AND 200.0 * least(length(a.t), length(b.t)) / (length(a.t) + length(b.t)) >= 90.0),
 like_ AS (SELECT k, bool_or(va = 0 AND vb = 1) AS p01, bool_or(va = 0 AND vb = 2) AS p02, bool_or(va = 1 AND vb = 2) AS p12, bool_or(va = 0 AND vb = 3) AS p03, bool_or(va = 1 AND vb = 3) AS p13, bool_or(va = 2 AND vb = 3) AS p23 FROM pairs GROUP BY k),
 gone AS (SELECT k, p01 AS g1, p02 OR (p12 AND NOT p01) AS g2, p03 OR (p13 AND NOT p01) OR (p23 AND NOT (p02 OR (p12 AND NOT p01))) AS g3 FROM like_),
 followers AS (SELECT t.pmid FROM {0} t JOIN gone USING (k) WHERE (v = 1 AND g1) OR (v = 2 AND g2) OR (v = 3 AND g3))"""
DEDUPED = f"""{VARIANTS}, one AS (SELECT *, regexp_replace(lower(title), '^\\s+|\\s+$', '', 'g') AS t FROM (SELECT *, row_number() OVER (PARTITION BY pmid ORDER BY pos) AS r FROM v1) WHERE r = 1),
 dois AS (SELECT pmid FROM (SELECT pmid, row_number() OVER (PARTITION BY doi ORDER BY pos) AS r FROM one WHERE doi <> '') WHERE r > 1),
 titles AS (SELECT pmid FROM (SELECT pmid, row_number() OVER (PARTITION BY t ORDER BY pos) AS r FROM one WHERE t <> '') WHERE r > 1),
 rest AS (SELECT * FROM one WHERE pmid NOT IN (SELECT pmid FROM dois UNION SELECT pmid FROM titles)), {ALIKE.format('rest')},
 flags AS (SELECT pmid, 'd' AS why FROM dois UNION ALL SELECT pmid, 'f' FROM titles UNION ALL SELECT pmid, 'f' FROM followers UNION ALL SELECT pmid, 'r' FROM one WHERE is_retracted UNION ALL SELECT pmid, 'n' FROM one WHERE retraction_of_pmid <> ''),
 stay AS (SELECT * FROM one WHERE pmid NOT IN (SELECT pmid FROM flags))"""
