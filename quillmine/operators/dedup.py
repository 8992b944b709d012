"""Layers of deduplication over a paper table with positions.

Every layer gives a frame of flagged keys; one anti-join removes them all at the end.  Layers do not
see each other's flags, but that fuzzy matching leaves out what the layers before it flagged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from string import ascii_lowercase

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmine.functions.indel import indel_ratio, with_ratio
from quillmine.functions.text import normalize_title, title_block_key
from quillmine.spine import POS

RETRACTED = r"\bretracted?\b"
SOME = r"(?U)\S"
SMALL = 16  # titles of a block that are compared in passing; larger blocks are joined with themselves


@dataclass
class DedupConfig:
    check_doi: bool = True
    check_title_fuzzy: bool = True
    fuzzy_threshold: float = 90.0
    remove_retracted: bool = True


def later_copies(df: DataFrame, key: str) -> DataFrame:
    """The keys of all rows but the first of each value of ``key``; null and empty values have no copies."""
    row = F.row_number().over(Window.partitionBy(key).orderBy(POS))
    return df.where(f"{key} is not null and {key} <> ''").withColumn("__row", row).where("__row > 1").select("pmid")


def doi_copies(papers: DataFrame) -> DataFrame:
    return later_copies(papers, "doi")


def title_copies(papers: DataFrame) -> DataFrame:
    return later_copies(papers.withColumn("__title", normalize_title(F.col("title"))), "__title")


def _letters(text: str) -> Column:
    """How often each of a to z stands in a column's texts."""
    return F.expr("array(" + ", ".join(f"octet_length({text}) - octet_length(replace({text}, '{c}', ''))" for c in ascii_lowercase) + ")")


def fuzzy_pairs(papers: DataFrame, threshold: float = 90.0, year: str = "year") -> DataFrame:
    """(block, a, b, ratio): pairs of titles that are alike, a before b, within one year and block of first words.

    The band of lengths is part of the definition: it is narrower than what the ratio alone would need.
    Blocks are joined on their key, which Spark can split where one is large; its hash stands first, so that
    rows are sorted by a number.  A common subsequence has no more of a letter than either title, so pairs
    whose letters in common are too few are left out in the join, and only texts of the others are scored.
    """
    titled = papers.where(F.col("title").rlike(SOME)).withColumn("__t", normalize_title(F.col("title")))
    return _pairs(titled.select(F.col(year).alias("y"), title_block_key(F.col("__t")).alias("k"), F.col(POS).alias("p"), "pmid", F.col("__t").alias("t")), threshold)


def _pairs(keyed: DataFrame, threshold: float) -> DataFrame:
    counted = keyed.select(F.xxhash64("y", "k").alias("h"), "*", F.char_length("t").alias("n"), _letters("t").alias("c"))
    others = F.col("n") - F.aggregate("c", F.lit(0), lambda total, x: total + x)
    side = counted.withColumn("c", F.concat("c", F.array(others)))
    a, b = side.alias("a"), side.alias("b")
    near = (F.col("a.h") == F.col("b.h")) & F.col("a.y").eqNullSafe(F.col("b.y")) & F.col("a.k").eqNullSafe(F.col("b.k")) & (F.col("a.p") < F.col("b.p"))
    band = F.least("a.n", "b.n") * 100.0 >= F.greatest("a.n", "b.n") * threshold
    common = F.aggregate(F.zip_with("a.c", "b.c", lambda x, y: F.least(x, y)), F.lit(0), lambda total, x: total + x)
    enough = common * 200.0 >= (F.col("a.n") + F.col("b.n")) * threshold
    pairs = a.join(b, near & band & enough).select(F.struct("a.y", "a.k").alias("block"), F.col("a.p").alias("pa"), F.col("b.p").alias("pb"), F.col("a.pmid").alias("a"), F.col("b.pmid").alias("b"), F.col("a.t").alias("ta"), F.col("b.t").alias("tb"))
    return with_ratio(pairs, "ta", "tb").where(F.col("ratio") >= threshold).select("block", "pa", "pb", "a", "b", "ratio")


def greedy_followers(pairs: DataFrame) -> DataFrame:
    """(pmid): in order of position, each title that still stands removes those after it that are like it.

    Only matches reach this step, sorted by block in each task, which goes through them once and holds the
    followers of one block.  Blocks whose hashes are equal go together, which changes nothing: no pair links them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, gone = None, set()
        for batch in batches:
            found = []
            for block, lead, follow, key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if block != now:
                    now, gone = block, set()
                if lead not in gone and follow not in gone:
                    gone.add(follow)
                    found.append(key)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["pmid"])

    rows = pairs.select(F.xxhash64("block").alias("block"), "pa", "pb", "b")
    return rows.repartition("block").sortWithinPartitions("block", "pa", "pb").mapInArrow(run, "pmid string")


def is_retracted(papers: DataFrame) -> Column:
    """Whether a paper was retracted, by its flag or, for want of it, by its publication status."""
    if "is_retracted" in papers.columns:
        return F.col("is_retracted")
    if "publication_status" in papers.columns:
        return F.lower("publication_status").rlike(RETRACTED)
    return F.lit(False)


def is_notice(papers: DataFrame) -> Column:
    if "retraction_of_pmid" not in papers.columns:
        return F.lit(False)
    return F.col("retraction_of_pmid") != ""


def retracted(papers: DataFrame) -> DataFrame:
    return papers.where(is_retracted(papers)).select("pmid")


def notices(papers: DataFrame) -> DataFrame:
    return papers.where(is_notice(papers)).select("pmid")


def _later(key: Column) -> Column:
    """Whether a row has a key and isn't the first with it; rows without one are dealt out by ``pmid``."""
    key = F.when(key != "", key)
    row = F.row_number().over(Window.partitionBy(F.xxhash64(F.coalesce(key, F.col("pmid"))), key).orderBy(POS))
    return key.isNotNull() & (row > 1)


def _followers_in_passing(sized: DataFrame, threshold: float) -> DataFrame:
    """(pmid, bits, follows) of rows that have any: whether a title of a small block follows one that stands.

    Rows come sorted by block and position.  A title follows if a title before it is like it and follows none
    itself, so each is compared only with those that stand, and a task holds those of one block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        standing = []
        for batch in batches:
            look = batch.column("look")
            follows, some = np.zeros(batch.num_rows, bool), batch.filter(look)
            places, nth, titles = (c.to_numpy(zero_copy_only=False).tolist() for c in (look, some.column("nth"), some.column("t")))
            for i, first, title in zip(np.flatnonzero(places).tolist(), nth, titles, strict=True):
                if first == 1:
                    standing = [title]
                    continue
                n = len(title)
                for lead in standing:
                    if min(n, len(lead)) * 100.0 >= max(n, len(lead)) * threshold and indel_ratio(lead, title) >= threshold:
                        follows[i] = True
                        break
                else:
                    standing.append(title)
            bits = batch.column("bits")
            out = pa.RecordBatch.from_arrays([batch.column("pmid"), bits, pa.array(follows)], ["pmid", "bits", "follows"])
            yield out.filter(pa.array(follows | (bits.to_numpy() != 0)))

    rows = sized.sortWithinPartitions("h", "y", "k", "p").select("nth", "t", F.expr(f"t is not null and size between 2 and {SMALL}").alias("look"), "pmid", "bits")
    return rows.where("look or bits <> 0").mapInArrow(run, "pmid string, bits int, follows boolean")


def flag(papers: DataFrame, config: DedupConfig | None = None) -> DataFrame:
    """(pmid, reason) of all rows to remove, over papers with one row a key; a key may have several reasons.

    The layers mark rows in passing, a bit for each reason, and carry only the columns that layers look at.
    Titles that no layer before fuzzy matching flags are dealt out by block; small blocks are gone through
    as they come, those of over ``SMALL`` titles are joined with themselves.
    """
    config = config or DedupConfig()
    rows, why = papers, {}
    if config.check_doi:
        rows, why["doi_duplicate"] = rows.withColumn("__doi", _later(F.col("doi"))), F.col("__doi")
    if config.check_title_fuzzy:
        rows = rows.withColumn("__t", normalize_title(F.col("title")))
        rows, why["exact_title_duplicate"] = rows.withColumn("__exact", _later(F.col("__t"))), F.col("__exact")
    before = (1 << len(why)) - 1
    if config.remove_retracted:
        why |= {"retracted": is_retracted(papers), "retraction_notice": is_notice(papers)}
    bits = F.lit(0)
    for i, of in enumerate(why.values()):
        bits = bits.bitwiseOR(F.when(of, F.lit(1 << i)).otherwise(0))
    named = [F.when(F.col("bits").bitwiseAND(1 << i) != 0, F.lit(reason)) for i, reason in enumerate(why)]
    reasons = lambda *found: F.explode(F.array_compact(F.array(*found)).cast("array<string>")).alias("reason")
    if not config.check_title_fuzzy:
        return rows.withColumn("bits", bits).select("pmid", reasons(*named))
    fuzzy = "fuzzy_title_duplicate"
    marked = rows.select("pmid", F.col(POS).alias("p"), F.col("year").alias("y"), F.col("__t").alias("t"), bits.alias("bits"))
    is_open = (F.col("bits").bitwiseAND(before) == 0) & (F.col("t") != "")
    left = marked.select("pmid", "p", F.when(is_open, F.col("y")).alias("y"), F.when(is_open, F.col("t")).alias("t"), "bits").withColumn("k", title_block_key(F.col("t")))
    left = left.withColumn("h", F.when(F.col("t").isNotNull(), F.xxhash64("y", "k")).otherwise(F.xxhash64("pmid")))
    block = Window.partitionBy("h", "y", "k").orderBy("p")
    sized = left.withColumns({"nth": F.row_number().over(block), "size": F.count("t").over(block.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))})
    passed = _followers_in_passing(sized, config.fuzzy_threshold).select("pmid", reasons(*named, F.when(F.col("follows"), F.lit(fuzzy))))
    # asking for the bits again gives both branches the same columns, so that Spark deals rows out once
    large = sized.where((F.col("size") > SMALL) & F.col("t").isNotNull() & (F.col("bits").bitwiseAND(before) == 0)).select("y", "k", "p", "pmid", "t")
    return passed.union(greedy_followers(_pairs(large, config.fuzzy_threshold)).select("pmid", F.lit(fuzzy)))


def deduplicate(papers: DataFrame, config: DedupConfig | None = None) -> tuple[DataFrame, DataFrame]:
    """(the papers that stay, the flags): the first row of each key, without what any layer flags.

    Copies of keys are few, so no task looks for its own first ones before rows are dealt out.
    """
    first = F.lag(F.lit(1)).over(Window.partitionBy("pmid").orderBy(POS)).isNull()
    one = papers.withColumn("__first", first).where("__first").drop("__first")
    flags = flag(one, config)
    return one.join(flags.select("pmid"), "pmid", "left_anti"), flags


def statistics(papers: DataFrame, stay: DataFrame | None, flags: DataFrame) -> DataFrame:
    """One row: copies of keys, flags by reason, rows removed.

    Without ``stay``, rows removed are counted by the flags of ``deduplicate``: copies of keys and the keys flagged.
    """
    reason = lambda *names: F.count_if(F.col("reason").isin(*names))
    by = flags.agg(reason("doi_duplicate").alias("doi_duplicates"), reason("exact_title_duplicate", "fuzzy_title_duplicate").alias("fuzzy_duplicates"), reason("retracted").alias("retracted"), reason("retraction_notice").alias("retraction_notices"), *([F.countDistinct("pmid").alias("gone")] if stay is None else []))
    counts = papers.agg(F.count("*").alias("n"), F.countDistinct("pmid").alias("k"), F.count_if(F.col("pmid").isNull()).alias("nulls")).select((F.col("n") - F.col("k")).alias("pmid_duplicates"), "n", "k", "nulls")
    found = by.crossJoin(counts)  # one row each
    if stay is None:
        removed = F.col("n") - F.col("k") - F.least("nulls", F.lit(1)) + F.col("gone")  # null is a key that no flag removes
    else:
        found, removed = found.crossJoin(stay.agg(F.count("*").alias("left"))), F.col("n") - F.col("left")
    return found.select("pmid_duplicates", "doi_duplicates", "fuzzy_duplicates", "retracted", "retraction_notices", removed.alias("rows_removed"))
