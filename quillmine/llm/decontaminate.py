"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations only.

An item is cut into windows.  A window occurs in a document where all its shingles do, in place, so any
one of its shingles is a sufficient prefix for the join.  Shingles are ordered by how often they occur in
all documents; each window is joined by the rarest of its own; then come the bounds of length and
position, the window's hash and, for what is left, the window itself, word by word.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmine.llm.common import LOWER, UPPER, lower_ascii, pick, settle

NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SHINGLES = 1_000_000  # hashes of shingles broadcast at a time, 8 bytes each
WINDOWS = 50_000  # windows broadcast at a time, 40 bytes each however long their words


def words(text: Column) -> Column:
    """Lower-cased (A-Z) runs of digits, ASCII letters and all characters beyond ASCII; null has none."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NO_WORD), "")


def _positions(count: Column) -> Column:
    """1 to count, or nothing."""
    return F.when(count >= 1, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))


def contamination(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = 10, shingle: int = 5) -> DataFrame:
    """(id, text_hash, n_words, n_hit, n_items, items): one row for each row of ``documents``.

    Windows are the runs of ``window`` words of an item, or all its words if there are fewer but some.
    n_hit counts the document's words inside any occurrence of a window, n_items the items of which a
    window occurs, and items is the sorted array of their ids as strings.  Null texts have no words;
    a null item id counts among hits, not among items.  Rows with equal id and text are judged alike; an
    empty table of either kind hits nothing.  Texts of any length are searched whole, in time linear in it.
    Whole texts are read, once to count the benchmark's words and once to find its windows, and are
    never shuffled; larger benchmarks are gone through in several passes of bounded size.
    """
    items = pick(benchmark, item=item_col, text=item_text_col).select("item", words(F.col("text")).alias("w"))
    length = F.least(F.size("w"), F.lit(window))
    cut = items.where(F.size("w") > 0).select("item", F.explode(F.transform(_positions(F.size("w") - length + 1), lambda i: F.slice("w", i, length))).alias("window"))
    cut = settle(cut.distinct(), "windows-of-items")
    windows = settle(cut.select("window").distinct().withColumn("wid", F.monotonically_increasing_id()), "windows")
    docs = pick(documents, id=id_col, text=text_col).withColumn("th", F.xxhash64("text"))
    id_type = docs.schema["id"].dataType.simpleString()
    split = docs.select("id", "th", words(F.col("text")).alias("w"))

    # The windows' shingles, of ``shingle`` words or of all that a shorter window has, at their places.
    size, run = F.size("window"), F.least(F.size("window"), F.lit(shingle))
    inside = windows.select("wid", size.alias("size"), run.alias("run"), F.xxhash64("window").alias("whole"), "window", F.explode(F.sequence(F.lit(0), size - run)).alias("off"))
    inside = inside.select("wid", "size", "run", "whole", "off", F.xxhash64("run", F.slice("window", F.col("off") + 1, F.col("run"))).alias("key"))
    inside = settle(inside, "window-shingles")
    runs = [r["run"] for r in inside.select("run").distinct().collect()]  # at most as many as a shingle has words

    def places(*columns: str) -> DataFrame:
        """The documents' shingles of the same lengths: their place and hash."""
        begun = split.select(*columns, "w", F.posexplode("w").alias("at", "first")).drop("first")
        of = [F.struct(F.lit(r).alias("run"), F.xxhash64(F.lit(r), F.slice("w", F.col("at") + 1, F.lit(r))).alias("key")) for r in runs]
        if len(of) == 1:
            made = begun.withColumn("shingle", of[0])
        else:
            made = begun.withColumn("shingle", F.explode(F.array(*of)))
        return made.where(F.col("at") + F.col("shingle.run") <= F.size("w")).select(*columns, "w", "at", F.col("shingle.key").alias("key"))

    def nowhere() -> DataFrame:
        return split.where("false").select("id", "th", F.lit(0).cast("long").alias("wid"), F.lit(0).alias("begins"), F.lit(0).alias("ends"))

    # How often each occurs, and each window's rarest (ties: smaller hash, then place); a window with a
    # shingle that no document has can't occur.
    held = nowhere()
    if runs:
        known = settle(inside.select("key").distinct(), "benchmark-shingles")
        passes = max(1, -(-known.count() // SHINGLES))
        counted = reduce(DataFrame.union, [places().select("key").join(F.broadcast(known.where(F.pmod("key", F.lit(passes)) == k)), "key") for k in range(passes)])
        counted = settle(counted.groupBy("key").agg(F.count("*").alias("n")), "shingle-counts")
        first = inside.join(counted, "key", "left").groupBy("wid").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "key", "off", "size", "whole")).alias("f"))
        prefix = settle(first.where("f.n > 0").select("wid", "f.key", "f.off", "f.size", "f.whole", (F.monotonically_increasing_id() % 1_000_003).alias("nth")), "window-prefixes")
        begins = F.col("at") - F.col("off")  # from 0
        found = F.slice("w", F.greatest(begins, F.lit(0)) + 1, F.col("size"))
        agrees = (begins >= 0) & (begins + F.col("size") <= F.size("w")) & (F.xxhash64(found) == F.col("whole"))
        passes = max(1, -(-prefix.count() // WINDOWS))
        met = []
        for k in range(passes):
            some = prefix.where(F.pmod("nth", F.lit(passes)) == k).withColumnRenamed("key", "of")
            met.append(places("id", "th").join(F.broadcast(some), (F.col("key") == F.col("of")) & agrees).select("id", "th", "wid", begins.alias("begins"), (begins + F.col("size")).alias("ends"), found.alias("found")))
        held = reduce(DataFrame.union, met).join(windows, "wid").where("found = window").select("id", "th", "wid", "begins", "ends")
    held = settle(held.distinct(), "window-hits")

    by = Window.partitionBy("id", "th").orderBy("begins", "ends")
    before = F.coalesce(F.max("ends").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    covered = held.withColumn("new", F.greatest(F.lit(0), F.col("ends") - F.greatest("begins", before))).groupBy("id", "th").agg(F.sum("new").alias("n_hit"))
    named = held.select("id", "th", "wid").distinct().join(windows.join(cut, "window").select("wid", "item"), "wid")
    named = named.groupBy("id", "th").agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"))
    result = covered.join(named, (covered.id.eqNullSafe(named.id)) & (covered.th == named.th), "left").select(covered.id.alias("rid"), covered.th.alias("rth"), "n_hit", "items")
    out = split.select("id", "th", F.size("w").cast("long").alias("n_words")).join(result, F.col("id").eqNullSafe(F.col("rid")) & (F.col("th") == F.col("rth")), "left")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(F.col("id").cast(id_type).alias("id"), F.col("th").alias("text_hash"), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(listed).cast("long").alias("n_items"), listed.alias("items"))


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows and columns of ``documents`` whose texts hold no window of the benchmark."""
    bad = contamination(documents, benchmark, id_col, text_col, **options).where("n_hit > 0")
    key = lambda c: F.coalesce(c.cast("string"), F.lit("\0"))
    bad = settle(bad.select(key(F.col("id")).alias("k"), F.col("text_hash").alias("h")).distinct(), "contaminated")
    names = documents.columns
    rows = documents.toDF(*[f"_{i}" for i in range(len(names))])
    rows = rows.withColumn("k", key(F.col(f"_{names.index(id_col)}"))).withColumn("h", F.xxhash64(f"_{names.index(text_col)}"))
    return rows.join(bad, ["k", "h"], "left_anti").select(*[F.col(f"_{i}").alias(n) for i, n in enumerate(names)])


def op3_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    out = contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP3_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
wi AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS win
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)),
dp AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d CROSS JOIN (SELECT DISTINCT n FROM wi)),
dw AS (SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS win FROM dp),
m AS (SELECT dw.doc_id, dw.p, dw.n, wi.item_id FROM dw JOIN wi ON dw.win = wi.win AND dw.n = wi.n),
h AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""
