"""Shards of nearly equal bytes by sampled splitters.

Rows are ordered by a hash of their text, so equal texts are neighbours.  A size-weighted sample of the
keys gives quantiles as boundaries of many small ranges, and ranges found overfull are cut again between
keys.  Exact sizes of the ranges give each its place among all bytes, and the shards' boundaries fall
between groups of equal texts.  Groups of over a hundredth of a shard are placed before, the largest
first, each in one shard as long as it fits; what they leave of the shards is the others' room.  Every
step is DataFrame work: no task holds more than a small share of bytes and of rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmine.llm.common import pick, settle

LARGE = 0.01  # share of a shard's bytes or rows from which on a group is placed by itself


def _at_or_below(splitters: list[int], key: Column) -> Column:
    """How many of the ascending splitters are at or below the row's key: first by blocks, then in one block."""
    flat = lambda listed: F.size(F.filter(listed, lambda s: s <= key))
    listed = F.array(*map(F.lit, splitters)).cast("array<long>")
    if len(splitters) <= 16:
        return flat(listed)
    block = math.isqrt(len(splitters))
    heads = flat(F.array(*map(F.lit, splitters[::block])).cast("array<long>"))
    inside = F.slice(listed, (heads - 1) * block + 1, F.lit(block))
    return F.when(heads == 0, 0).otherwise((heads - 1) * block + flat(inside))


def _place(groups: list[tuple[int, int, int]], total: int, shards: int) -> tuple[dict[int, list[tuple[int, int]]], list[float]]:
    """Of groups (key, rows, bytes a row): {key: [(shard, rows), ...]}, and the bytes that each shard still has room for.

    The largest come first and go whole to the shard with the most room, or, where none has enough, to
    as few shards as it takes."""
    share, load, placed = total / shards, [0.0] * shards, {}
    for key, rows, size in sorted(groups, key=lambda g: (-g[1] * g[2], g[0])):
        left, placed[key] = rows, []
        while left:
            s = min(range(shards), key=lambda s: (load[s], s))
            room = int((share - load[s]) // size)
            take = left if left <= room or left == 1 or load[s] >= share else min(left, max(1, room))
            placed[key].append((s, take))
            load[s] += take * size
            left -= take
    rest = total - sum(r * z for _, r, z in groups)
    level, low = 0.0, sorted(load)
    for k in range(1, shards + 1):  # water over the loads
        level = (rest + sum(low[:k])) / k
        if k == shards or level <= low[k]:
            break
    return placed, [max(0.0, level - x) for x in load]


def shard_by_bytes(documents: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", ranges: int = 256, draws: int = 32) -> DataFrame:
    """(id, size, crc, shard, slot): one row for each row of the input.

    size is the text's UTF-8 bytes plus 1 (null: 1), crc its CRC-32 (null: null); slots count from 0
    without gaps within a shard.  Rows of equal text stay in one shard, however many they are, unless
    they have more bytes than a shard has room for; then they are divided over as few as it takes, so that
    sizes stay near equal whatever one text's share.  Ranges are ``ranges``, or one for each million rows
    if that is more, and ``draws`` samples a range come to the driver.  Repeated rows are rows like others;
    an empty table gives an empty result.  Texts of any length are read once and never shuffled.
    """
    text = F.col("text")
    slim = pick(documents, id=id_col, text=text_col).select(
        "id", (F.octet_length(F.coalesce(text, F.lit(""))) + F.lit(1)).cast("long").alias("size"), F.crc32(text).alias("crc"),
        F.xxhash64("text", F.octet_length("text")).alias("key"), F.xxhash64("id", F.monotonically_increasing_id()).alias("tie"))
    slim, spark = settle(slim, "shard-rows"), documents.sparkSession
    all_bytes, rows = slim.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    if not rows:
        return slim.select("id", "size", "crc", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    ranges = max(ranges, rows // 1_000_000)

    # Groups of equal texts that are placed by themselves: at most 100 a shard by bytes and as many by rows.
    large = slim.groupBy("key").agg(F.count("*").alias("n"), F.max("size").alias("size"))
    large = large.where((F.col("n") * F.col("size") > LARGE * all_bytes / shards) | (F.col("n") > max(1, LARGE * rows / shards)))
    large = [tuple(r) for r in large.collect()]
    placed, room = _place(large, all_bytes, shards)
    parts = {key: 1 + n * ranges // rows for key, n, _ in large}  # of a range's rows each
    grouped = [(key, k, parts[key]) for k, key in enumerate(sorted(parts))]
    table = F.broadcast(spark.createDataFrame(grouped, "key long, nth int, parts int"))
    big = slim.join(table, "key").select("id", "size", "crc", "key", "tie", (-1 - F.col("nth") * F.lit(1 << 32) - F.pmod("tie", "parts")).alias("at"))

    rest = slim.join(table, "key", "left_anti")
    # Half of a row's weight is its size and half is the same for all, so ranges are even in bytes and in rows.
    rest = rest.withColumn("weight", F.col("size") + F.lit(all_bytes / rows))
    whole = 2.0 * all_bytes
    even = F.pmod(F.xxhash64("tie", "key", F.lit("draw")), F.lit(1 << 53)) / float(1 << 53)
    sample = rest.withColumn("drawn", F.floor(F.col("weight") * (ranges * draws / whole) + even)).where("drawn > 0").select("key", "drawn")
    by_key = sample.groupBy("key").agg(F.sum("drawn").alias("drawn"))  # at most some ranges * draws rows, a parameter
    upto = settle(by_key.withColumn("upto", F.sum("drawn").over(Window.orderBy("key").rowsBetween(Window.unboundedPreceding, 0))), "shard-sample")
    step = (upto.agg(F.max("upto")).first()[0] or 1) / ranges
    cut = lambda df, start, step: [r.key for r in df.where(F.floor((F.col("upto") - start) / step) > F.floor((F.col("upto") - F.col("drawn") - start) / step)).select("key").orderBy("key").collect()]
    first = cut(upto, F.lit(0), step)
    ranged = rest.withColumn("range", _at_or_below(first, F.col("key")))
    full = [r["range"] for r in ranged.groupBy("range").agg(F.sum("weight").alias("w")).where(F.col("w") > 2 * whole / ranges).collect()]
    second = []
    if full:
        inside = upto.withColumn("range", _at_or_below(first, F.col("key"))).where(F.col("range").isin(full))
        inside = inside.withColumn("start", F.min(F.col("upto") - F.col("drawn")).over(Window.partitionBy("range")))
        second = cut(inside, F.col("start"), step / 2)
    rest = rest.withColumn("at", _at_or_below(sorted({*first, *second}), F.col("key")).cast("long")).drop("weight")

    # Exact bytes of every range and of every large group's part, in order: two for each range at most.
    starts, before, counts = [], 0, {}
    for r in rest.groupBy("at").agg(F.sum("size").alias("size")).orderBy("at").collect():
        starts.append((r["at"], before, None))
        before += r["size"]
    for r in big.groupBy("key", "at").agg(F.count("*").alias("n")).orderBy("key", F.desc("at")).collect():
        starts.append((r["at"], counts.get(r["key"], 0), r["key"]))
        counts[r["key"]] = counts.get(r["key"], 0) + r["n"]
    starts = F.broadcast(spark.createDataFrame([x[:2] for x in starts], "at long, start long"))
    by, group = Window.partitionBy("at").orderBy("key", "tie"), Window.partitionBy("at", "key")
    so_far = F.sum("size").over(by.rowsBetween(Window.unboundedPreceding, 0))
    rest = rest.join(starts, "at").withColumn("run", so_far).withColumn("row", F.row_number().over(by))
    rest = rest.withColumn("held", F.sum("size").over(group)).withColumn("opened", F.min(F.col("run") - F.col("size")).over(group))
    # A group's middle decides, so that it is never cut; where rooms end before the bytes do, the roomiest takes the rest.
    ends, last = [], max(range(shards), key=lambda s: room[s])
    for s in range(shards):
        ends.append((ends[-1] if ends else 0.0) + room[s])
    middle, shard = F.col("start") + F.col("opened") + F.col("held") / 2, None
    for s in range(shards):
        if room[s] > 0:
            shard = F.when(middle < ends[s], s) if shard is None else shard.when(middle < ends[s], s)
    rest = rest.withColumn("shard", (F.lit(last) if shard is None else shard.otherwise(F.lit(last))).cast("int"))
    pieces = {key: [(sum(n for _, n in placed[key][:k]), s) for k, (s, _) in enumerate(placed[key])] for key in placed}
    pieces = spark.createDataFrame([(key, x) for key, x in pieces.items()], "key long, pieces array<struct<begin:long,shard:int>>")
    big = big.join(starts, "at").withColumn("row", F.row_number().over(by)).join(F.broadcast(pieces), "key")
    reached = F.filter("pieces", lambda p: p["begin"] < F.col("start") + F.col("row"))
    big = big.withColumn("shard", F.element_at(reached, -1)["shard"])
    names = ("id", "size", "crc", "shard", "at", "row")
    done = settle(rest.select(*names).union(big.select(*names)), "shard-placed")
    before, bases = {}, []
    for r in done.groupBy("shard", "at").agg(F.count("*").alias("n"), F.min("row").alias("first"), F.max("row").alias("last")).orderBy("at", "shard").collect():
        bases.append((r["shard"], r["at"], before.get(r["shard"], 0) - r["first"]))
        before[r["shard"]] = before.get(r["shard"], 0) + r["n"]
    bases = F.broadcast(spark.createDataFrame(bases, "shard int, at long, base long"))
    return done.join(bases, ["shard", "at"]).select("id", "size", "crc", "shard", (F.col("row") + F.col("base")).alias("slot"))


def op9_sampled_splitters(spark, sf_dir: str) -> DataFrame:
    out = shard_by_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
