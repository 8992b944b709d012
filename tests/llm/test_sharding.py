import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quillmine.llm.sharding import _at_or_below, op9_sampled_splitters, shard_by_bytes


def check(got, texts, shards, slack):
    assert sorted((r.id, r.size, r.crc) for r in got if r.id is not None) == sorted((i, len((t or "").encode()) + 1, None if t is None else zlib.crc32(t.encode())) for i, t in texts if i is not None)
    assert len(got) == len(texts)
    slots, size = defaultdict(list), defaultdict(int)
    for r in got:
        slots[r.shard].append(r.slot)
        size[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(shards))
    mean = sum(size.values()) / shards
    assert max(size.values()) <= mean * (1 + slack) + max(r.size for r in got)
    assert min(size.get(s, 0) for s in range(shards)) >= mean * (1 - slack) - max(r.size for r in got)


def test_query_has_even_shards_and_keeps_copies_together(spark):
    got = op9_sampled_splitters(spark, "/root/testdata/sf0.01").withColumnsRenamed({"doc_id": "id", "text_crc32": "crc"}).collect()
    texts = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    check(got, texts, 8, 0.02)
    at = defaultdict(set)
    for r in got:
        at[r.crc, r.size].add(r.shard)
    assert all(len(s) == 1 for s in at.values())


@pytest.mark.parametrize("ranges", [16, 256])
def test_hot_text_nulls_and_repeats(spark, ranges):
    rows = [(i, "hot text of a third of all rows") for i in range(700)] + [(i, None) for i in range(700, 1400)] + [(i, f"text {i} " * (i % 17)) for i in range(1400, 2200)] + [(5000, "same")] * 300 + [(None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit(1).alias("shard"), F.lit("no").alias("Text")).repartition(5)
    check(shard_by_bytes(df, ranges=ranges).collect(), rows, 8, 0.02)


def test_empty_and_single(spark):
    assert shard_by_bytes(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert [tuple(r) for r in shard_by_bytes(spark.createDataFrame([(1, "a" * 2_000_000)], "doc_id long, text string")).select("id", "size", "slot").collect()] == [(1, 2_000_001, 0)]


def test_groups_of_equal_texts_stay_whole_while_they_fit(spark):
    """Groups of many sizes, the largest nearly a shard; only that of over a shard is divided, over as few as it takes."""
    sizes = [60, 150, 300, 900, 960, 5, 2, 1900]
    rows = [(k * 10_000 + i, f"the text of group {k} " * 5) for k, n in enumerate(sizes) for i in range(n)]
    rows += [(900_000 + i, f"another {i:05d} text, all by itself, as long as the others are, or nearly so, it is to be hoped" * 1) for i in range(8000 - sum(sizes))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = shard_by_bytes(df, ranges=64).collect()
    check(got, rows, 8, 0.03)
    at = defaultdict(set)
    for r in got:
        at[r.id // 10_000].add(r.shard)
    assert [len(at[k]) for k in range(7)] == [1] * 7 and 2 <= len(at[7]) <= 3


def test_splitters_are_looked_up_by_blocks(spark):
    keys = sorted({(x * 7919) % 10_007 - 5000 for x in range(500)})
    for some in ([], keys[:1], keys[:16], keys[:17], keys):
        rows = spark.createDataFrame([(x,) for x in (-6000, *keys[::7], 0, 6000)], "key long")
        for r in rows.withColumn("n", _at_or_below(some, F.col("key"))).collect():
            assert r.n == sum(x <= r.key for x in some)
