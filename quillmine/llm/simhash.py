"""Near-duplicates by SimHash, found by multi-index hashing (Norouzi, Punjani and Fleet, 2012).

The 64 bits are cut into segments.  Where two fingerprints differ in at most r bits, some segment
differs in few: with m segments, a = r // m and b = r - m * a, one of the first b + 1 segments
differs in at most a bits or one of the others in at most a - 1.  So each fingerprint probes the
segments' tables with small Hamming balls, and complete distances are verified on what it meets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmine.llm.common import give_back, map_arrow, pick, settle, small, tune
from quillmine.llm.components import components


def shingle_hashes(raw: bytes | None, width: int = 5, seed: int = 42) -> np.ndarray:
    """XXH64 of a text's word shingles, repeats included, as unsigned 64-bit numbers.

    A-Z are lower-cased; words are runs without ASCII white space.  Fewer words than a shingle make one
    of them all; no words, or a null text, make none.
    """
    words = (raw or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    of, n = xxhash.xxh64_intdigest, max(1, len(words) - width + 1)
    if n == 1:
        return np.array([of(joined, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    return np.fromiter((of(joined[s:e], seed) for s, e in zip(starts, ends[width - 1 :].tolist(), strict=True)), np.uint64, n)


def simhash(h: np.ndarray) -> int:
    """The number of which a bit is 1 if it is set in over half of the hashes; zero if there are none."""
    counts = np.zeros(64, np.int64)
    for k in range(0, len(h), 8192):
        block = np.ascontiguousarray(h[k : k + 8192].astype("<u8")).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(h), bitorder="little").view("<u8")[0])


def fingerprint(raw: bytes | None, width: int = 5, seed: int = 42) -> int:
    """The SimHash of a text's word shingles as an unsigned 64-bit number."""
    return simhash(shingle_hashes(raw, width, seed))


def fingerprints(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, seed: int = 42) -> DataFrame:
    """(id, fp): one row for each row of the input; fp holds the 64 bits as a signed long."""
    tune(documents.sparkSession)
    rows = pick(documents, id=id_col, text=text_col)
    return _fingerprints(rows, width, seed)


def _fingerprints(rows: DataFrame, width: int, seed: int) -> DataFrame:
    """The rows with fp in the text's place."""
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batch):
        return {"id": batch["id"], "fp": _longs([fingerprint(t, width, seed) for t in batch["text"].cast(pa.binary()).to_pylist()])}

    return map_arrow(rows, f"id {id_type}, fp long", run)


def _longs(x: list[int]) -> pa.Array:
    return pa.array(np.array(x, np.uint64).view(np.int64))


def _ball(bits: int, radius: int) -> list[int]:
    """The masks of at most ``radius`` set bits."""
    return [sum(1 << i for i in at) for k in range(radius + 1) for at in combinations(range(bits), k)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _probes(segment: int, key: Column, masks: list[int]) -> Column:
    listed = F.array(*[F.lit(x).cast("long") for x in masks])
    return F.transform(listed, lambda m: F.struct(F.lit(segment).alias("seg"), key.bitwiseXOR(m).alias("key")))


def links(distinct: DataFrame, radius: int = 2, segments: int = 2, bucket: int = 64) -> DataFrame:
    """(a, b): links among the distinct fingerprints ``fp`` that join all pairs within ``radius`` bits.

    A table bucket of up to ``bucket`` fingerprints gives each of its pairs that holds.  Larger buckets
    would give the square of their size; fingerprints that probe one go an exact way that cannot: each
    lists all values within radius / 2 bits, two share a value if and only if they are within
    ``radius``, and a value is shared by at most as many fingerprints as the ball has members; those
    are linked to their least.  The two ways together connect what any pair within the radius does.
    """
    if radius % 2 or 64 % segments:
        raise ValueError("radius must be even, and segments must divide 64")
    bits, near, extra = 64 // segments, radius // segments, radius % segments
    part = lambda s: F.shiftrightunsigned("fp", s * bits).bitwiseAND(F.lit((1 << bits) - 1)) if segments > 1 else F.col("fp")
    table, probes = [], []
    for s in range(segments):
        if (reach := near if s <= extra else near - 1) < 0:
            continue
        table.append(F.struct(F.lit(s).alias("seg"), part(s).alias("key")))
        probes.append(_probes(s, part(s), _ball(bits, reach)))
    in_table = distinct.select(F.col("fp").alias("b"), F.inline(F.array(*table)))
    probing = distinct.select(F.col("fp").alias("a"), F.inline(F.concat(*probes)))
    large = settle(in_table.groupBy("seg", "key").count().where(F.col("count") > bucket).select("seg", "key"), "simhash-large")
    held = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    small = probing.join(in_table.join(large, ["seg", "key"], "left_anti"), ["seg", "key"]).where((F.col("a") != F.col("b")) & held).select("a", "b")
    exact = probing.join(large, ["seg", "key"], "left_semi").select("a").distinct()
    around = F.array(*[F.lit(_signed(x)) for x in _ball(64, radius // 2)])
    spread = exact.select("a", F.explode(F.transform(around, lambda m: F.col("a").bitwiseXOR(m))).alias("value"))
    shared = spread.groupBy("value").agg(F.min("a").alias("hub"), F.collect_list("a").alias("all")).where(F.size("all") > 1)
    hubs = shared.select("hub", F.explode("all").alias("b")).where("hub <> b").select(F.col("hub").alias("a"), "b")
    return small.union(hubs)


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, seed: int = 42, radius: int = 2) -> DataFrame:
    """(id, fp, component): one row for each row of the input.

    component is the smallest id that can be reached over links of at most ``radius`` differing bits.
    Equal texts share a fingerprint and are one node however many they are; rows without words
    share fingerprint zero and are linked like any other.  Null ids are kept, and are a component's
    name only where it has no other.  An empty table gives an empty result.  Texts of any length are
    hashed whole, 8192 shingles at a time.
    """
    tune(documents.sparkSession)
    rows = settle(_fingerprints(pick(documents, id=id_col, text=text_col), width, seed), "simhash-rows")
    nodes = settle(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-nodes")
    rooted = _rooted(nodes, radius)
    names = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = settle(rooted.join(names, "root").select("fp", "component"), "simhash-named")
    return rows.join(named, "fp").select("id", "fp", "component")


def _rooted(nodes: DataFrame, radius: int) -> DataFrame:
    """The distinct fingerprints with the root of their component, which is one of its fingerprints."""
    found = components(links(nodes.select("fp"), radius), "simhash-links")
    return nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def parity_bits(shingles: np.ndarray) -> bytes:
    """Whether the number of shingles with each value of the hash's last bits is odd; two bits a shingle or more.

    Two sets' bits differ in at most as many places as shingles stand in one of the sets only (the bitmap
    filter of Sandes, Teodoro and Melo, 2020), also after the longer is folded to the length of the
    other, so no pair of similar sets is lost by comparing them."""
    size = 64
    while size < 2 * len(shingles):
        size *= 2
    odd = np.bincount((shingles & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def parities(shingles: np.ndarray) -> np.ndarray:
    """Such bits as eight words of 64, whatever the number of shingles, for comparisons in the JVM."""
    odd = np.bincount((shingles & np.uint64(511)).astype(np.int64), minlength=512) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def parity_distance(x: bytes, y: bytes) -> int:
    """In how many places two sets' parity bits differ, the longer ones folded."""
    a, b = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
    while len(a) != len(b):
        if len(a) < len(b):
            a, b = b, a
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


PARITIES = tuple(f"p{k}" for k in range(8))


def deduplicate(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8, width: int = 5, seed: int = 42, bucket: int = 64) -> DataFrame:
    """The rows and columns of ``documents`` with one row of each group of similar ones, that of its smallest id.

    Two texts are linked if their sets of word shingles have a Jaccard similarity of ``similarity`` or
    more, and groups are what links connect; equal texts are linked whatever they hold, and so are texts
    without words, null among them.  ``similar_groups`` below misses no similar pair.  Null ids come
    last; of rows with one id the smallest hash of the text stays, and of rows with one id and text that
    of the smallest hash over all columns.  An empty table gives an empty result.  Texts of any length
    are compared whole.  Ids of candidates and of rows that go are broadcast up to half a million; beyond, texts
    are shuffled to them.
    """
    tune(documents.sparkSession)
    rows = pick(documents, id=id_col, text=text_col).select(F.struct(F.col("id").isNull().alias("none"), "id", F.xxhash64("text").alias("node")).alias("row"))
    texts = settle(rows.groupBy("row").agg(F.count("*").alias("n")), "similar-texts")
    found = similar_groups(documents, text_col, similarity, width, seed, bucket)
    nodes = texts.groupBy(F.col("row.node").alias("node")).agg(F.min("row").alias("row"))
    group = nodes.join(found, "node", "left").select("row", F.coalesce("root", "node").alias("root"))
    stay = settle(group.groupBy("root").agg(F.min("row").alias("row")).select("row"), "similar-stay")
    go = texts.join(stay, texts.row.eqNullSafe(stay.row), "left_anti")
    again = texts.where("n > 1").join(stay, texts.row.eqNullSafe(stay.row), "left_semi")
    return _without(documents, small(settle(go.select("row"), "similar-go")), settle(again.select("row"), "similar-again"), id_col, text_col)


def similar_groups(documents: DataFrame, text_col: str = "text", similarity: float = 0.8, width: int = 5, seed: int = 42, bucket: int = 64) -> DataFrame:
    """(node, root) of the texts (by xxhash64) that are similar to others, with what names their group.

    Candidates come in two ways.  SimHash fingerprints that multi-index hashing finds within two bits of
    each other are tried first.  But at a Jaccard similarity of 0.8 fingerprints differ in some ten bits,
    where no small Hamming ball reaches.  So a prefix-filtered join (Chaudhuri, Ganti and Kaushik, 2006)
    completes them: in any one order of shingles, two sets of a similarity share one of the first
    n - ceil(similarity * n) + 1 of either.  Each set stands under these, the rarest first, and those
    that meet are compared unless their sizes, the places where they meet or their parity bits show that
    they are not similar; no pair is lost, and every link is verified on the shingles themselves.

    The number of pairs would grow with the square of a group's size.  So each set is first tried with one
    hub under each shingle; what that joins is one component from then on, and pairs within a component
    are left out, which changes no component.  Under shingles that more than ``bucket`` sets hold, those
    outside the shingle's largest component are tried with other members of it, the nearest first, and
    only those that are still outside are compared with all.
    """
    texts = pick(documents, text=text_col).withColumn("node", F.xxhash64("text"))
    usual = _usual(texts, width, seed)
    kept = settle(_sketches(texts, usual, similarity, width, seed), "similar-sketches")
    nodes = settle(kept.groupBy("node").agg(*[F.first(c).alias(c) for c in ("fp", "size", "bits", *PARITIES)]), "similar-nodes")
    check = _Check(texts, nodes, similarity, width, seed)

    held = settle(_meetings(kept, usual, bucket), "similar-meetings")
    hubs = held.where((F.col("node") != F.col("hub.node")) & _fits(F.col("meta"), F.col("hub.meta"), similarity))
    pairs = hubs.select(F.col("hub.node").alias("a"), F.col("node").alias("b")).union(_near_fingerprints(nodes))
    known = _joined(None, check.links(pairs))

    shared = held.withColumn("s", F.count("*").over(Window.partitionBy("node")))  # under how many shingles a set meets others
    rooted = _rooted_by(shared.select("node", "meta", "value", "n", "s"), known)
    few = rooted.where(F.col("n") <= bucket).groupBy("value").agg(F.collect_list(F.struct("node", "meta", "root", "s")).alias("all"), F.min("root").alias("low"), F.max("root").alias("high"))
    x = F.col("x")
    other = lambda y: (y["node"] > x["node"]) & (y["root"] != x["root"]) & _fits(x["meta"], y["meta"], similarity, x["s"], y["s"])
    few = few.where("low <> high").select("all", F.explode("all").alias("x")).select(F.col("x.node").alias("a"), F.explode(F.filter("all", other)).alias("y"))
    known = _joined(known, check.links(few.select("a", F.col("y.node").alias("b"))))

    many = settle(rooted.where(F.col("n") > bucket).select("value", "node", "meta", "s"), "similar-many")
    under = many.groupBy("node").agg(F.array_sort(F.collect_set("value")).alias("under"))
    many = settle(many.join(under, "node").join(nodes.select("node", *PARITIES), "node"), "similar-many")
    if many.limit(1).count():
        for nearest in (4, 16, None):
            rooted = _rooted_by(many, known)
            inside, outside = _main_and_others(rooted, nearest or 0)
            if not outside.limit(1).count():
                break
            if nearest:
                fits = _fits(F.col("meta"), F.col("hub.meta"), similarity, F.col("s"), F.col("hub.s"))
                pairs = outside.join(inside, "value").where(fits).select(F.col("hub.node").alias("a"), F.col("node").alias("b"))
            else:
                pairs = _with_all(outside, rooted, similarity)
            known = _joined(known, check.links(pairs, nearest))
    return known


def _joined(known: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, root) of the components that new links make with those that are known."""
    stars = links if known is None else known.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")).union(links)
    return settle(components(stars, "similar-components"), "similar-known")


def _usual(texts: DataFrame, width: int, seed: int, share: int = 16, most: int = 200_000) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that occur in several of one in ``share`` texts, at most ``most`` of them, and their counts.

    They only say in which order shingles are taken and which are dealt to several tasks; any order finds
    the same pairs."""

    def run(batch):
        held = [np.unique(shingle_hashes(t, width, seed)) for t in batch["text"].cast(pa.binary()).to_pylist()]
        return {"h": pa.array(np.concatenate(held).view(np.int64))}

    some = texts.where(F.pmod("node", F.lit(share)) == 0).dropDuplicates(["node"]).select("text")
    counts = map_arrow(some, "h long", run).groupBy("h").count().where("count > 1")
    got = counts.orderBy(F.desc("count"), "h").limit(most).toArrow()
    keys, n = got.column(0).to_numpy().view(np.uint64), got.column(1).to_numpy()
    order = np.argsort(keys)
    return keys[order], n[order]


def _prefix(shingles: np.ndarray, usual: tuple[np.ndarray, np.ndarray], similarity: float) -> np.ndarray:
    """The first shingles of a set, the rarest first, of which similar sets share one: all but as many as
    a similar set must share, and one more.  Sets without shingles get a value of their own."""
    if not len(shingles):
        return np.zeros(1, np.uint64)
    keys, n = usual
    often = np.zeros(len(shingles), np.int64)
    if len(keys):
        at = np.minimum(np.searchsorted(keys, shingles), len(keys) - 1)
        often = np.where(keys[at] == shingles, n[at], 0)
    return shingles[np.lexsort((shingles, often))[: len(shingles) - max(1, int(np.ceil(similarity * len(shingles) - 1e-6))) + 1]]


def _sketches(texts: DataFrame, usual: tuple[np.ndarray, np.ndarray], similarity: float, width: int, seed: int) -> DataFrame:
    """(node, fp, size, bits, prefix) of the texts; of equal texts in one task only the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            fresh = []
            for i, node in enumerate(batch.column("node").to_pylist()):
                if node not in seen:
                    seen.add(node)
                    fresh.append(i)
            for k in range(0, len(fresh), 256):
                some = batch.take(pa.array(fresh[k : k + 256]))
                lists = [shingle_hashes(t, width, seed) for t in some.column("text").cast(pa.binary()).to_pylist()]
                sets = [np.unique(h) for h in lists]
                prefixes = [_prefix(h, usual, similarity).view(np.int64) for h in sets]
                ends = np.cumsum([0, *map(len, prefixes)]).astype(np.int32)
                odd = np.array([parities(h) for h in sets]).reshape(-1, len(PARITIES))
                yield pa.RecordBatch.from_pydict({
                    "node": some.column("node"), "fp": _longs([simhash(h) for h in lists]), "size": pa.array([len(h) for h in sets], pa.int64()),
                    "bits": pa.array([parity_bits(h) for h in sets], pa.binary()), "prefix": pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(prefixes)))} | {c: pa.array(np.ascontiguousarray(odd[:, k])) for k, c in enumerate(PARITIES)})
        give_back()

    return texts.select("node", "text").mapInArrow(run, "node long, fp long, size long, bits binary, prefix array<long>, " + ", ".join(f"{c} long" for c in PARITIES))


def _meetings(sketches: DataFrame, usual: tuple[np.ndarray, np.ndarray], bucket: int, share: int = 16, each: int = 65_536) -> DataFrame:
    """(value, node, meta, hub, n): the sets that stand under each shingle that several have in their prefix.

    meta is size and place in one number, hub the set of the smallest node with its meta, n how many sets
    there are.  All prefixes are shuffled here once.  Shingles that the sample shows under more than
    ``each`` sets are dealt to several tasks; each part then has a hub of its own, and n is over ``bucket``."""
    meta = F.shiftleft("size", 32).bitwiseOR(F.col("at").cast("long")).alias("meta")
    rows = sketches.select("node", "size", F.posexplode("prefix").alias("at", "value")).select("value", "node", meta)
    keys, often = usual
    parts = -(-often.astype(np.int64) * share // each)
    hot, by = parts > 1, ["value"]
    if hot.any():  # of the bounded list of usual shingles
        table = sketches.sparkSession.createDataFrame(list(zip(keys[hot].view(np.int64).tolist(), parts[hot].tolist(), strict=True)), "value long, parts long")
        rows = rows.join(F.broadcast(table), "value", "left").withColumn("part", F.when(F.col("parts").isNotNull(), F.pmod("node", "parts"))).drop("parts")
        by = ["value", "part"]
    w = Window.partitionBy(*by)
    rows = rows.withColumn("hub", F.min(F.struct("node", "meta")).over(w)).withColumn("top", F.max("node").over(w)).withColumn("n", F.count("*").over(w))
    split = F.col("part").isNotNull() if len(by) > 1 else F.lit(False)
    rows = rows.withColumn("n", F.when(split, F.greatest("n", F.lit(bucket + 1))).otherwise(F.col("n")))
    return rows.where((F.col("hub.node") != F.col("top")) | split).select("value", "node", "meta", "hub", "n")


def _fits(x: Column, y: Column, similarity: float, sx: Column | None = None, sy: Column | None = None) -> Column:
    """Whether what is known of two sets allows the similarity: their sizes, the shingles that are left from where
    they meet, and under how many shingles of their prefixes either meets others at all (``sx`` and ``sy``).

    Of the two prefixes one ends first in the order.  All that the sets share up to there stands in both prefixes, and
    beyond it the one has no more shingles than follow its prefix; so what they share is bounded by the smaller
    of sx and sy and the larger of the rests."""
    size, left = lambda m: F.shiftright(m, 32), lambda m: F.shiftright(m, 32) - m.bitwiseAND(F.lit((1 << 32) - 1))
    needed = (size(x) + size(y)) * (similarity / (1 + similarity)) - 1e-6
    return ((size(x) == 0) & (size(y) == 0)) | (_sizes_fit(x, y, similarity, sx, sy) & (F.least(left(x), left(y)) >= needed))


def _sizes_fit(x: Column, y: Column, similarity: float, sx: Column | None = None, sy: Column | None = None) -> Column:
    """The part of ``_fits`` that doesn't depend on where the two sets meet."""
    m, n = F.shiftright(x, 32), F.shiftright(y, 32)
    fits = F.least(m, n) + 1e-6 >= F.greatest(m, n) * similarity
    if sx is None:
        return fits
    needed = (m + n) * (similarity / (1 + similarity)) - 1e-6
    return ((m == 0) & (n == 0)) | (fits & (F.least(sx, sy) + F.ceil(F.greatest(m, n) * similarity - 1e-6) - 1 >= needed))


def _near_fingerprints(nodes: DataFrame) -> DataFrame:
    """Pairs of texts whose fingerprints are equal or near, each by the least text of a fingerprint."""
    least = settle(nodes.groupBy("fp").agg(F.min("node").alias("least")), "similar-fingerprints")
    same = nodes.join(least, "fp").where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b"))
    near = links(least.select("fp"))
    for end in "ab":
        near = near.join(least.select(F.col("fp").alias(end), F.col("least").alias(end * 2)), end)
    return same.union(near.select(F.col("aa").alias("a"), F.col("bb").alias("b")))


def _rooted_by(rows: DataFrame, known: DataFrame) -> DataFrame:
    """The rows with the root of each node's component, as far as it is known."""
    return settle(rows.join(known, "node", "left").withColumn("root", F.coalesce("root", "node")), "similar-rooted")


def _main_and_others(rows: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """Of each value with several roots: (value, hub), a member of the largest component, another for each
    value and turn, and the rows of all other components."""
    hub = F.min_by(F.struct("node", "meta", "s"), F.xxhash64("node", "value", F.lit(turn)))
    by = rows.groupBy("value", "root").agg(F.count("*").alias("n"), hub.alias("hub"))
    main = by.groupBy("value").agg(F.max(F.struct("n", "root", "hub")).alias("m"), F.count("*").alias("roots")).where("roots > 1")
    main = settle(main.select("value", F.col("m.root").alias("main"), F.col("m.hub").alias("hub")), "similar-main")
    outside = settle(rows.join(main.select("value", "main"), "value").where("root <> main").drop("main"), "similar-outside")
    return main.select("value", "hub"), outside


def _with_all(outside: DataFrame, rows: DataFrame, similarity: float, each: int = 4096) -> DataFrame:
    """Pairs of each outside row with all of other roots under its value whose parities allow the similarity,
    each pair under the first value that both stand under, dealt in parts of some ``each`` rows."""
    parts = rows.join(outside.select("value").distinct(), "value", "left_semi").groupBy("value").agg(F.ceil(F.count("*") / each).cast("int").alias("parts"))
    parts = settle(parts, "similar-parts")
    x = outside.join(parts, "value").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).alias("x")
    y = rows.join(parts, "value").withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int")).alias("y")
    met = (F.col("x.value") == F.col("y.value")) & (F.col("x.part") == F.col("y.part")) & (F.col("x.root") != F.col("y.root"))
    apart = reduce(lambda a, b: a + b, [F.bit_count(F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))) for c in PARITIES])
    both = F.shiftright("x.meta", 32) + F.shiftright("y.meta", 32)
    near = apart <= both * ((1 - similarity) / (1 + similarity)) + 1e-6
    first = F.get(F.array_intersect("x.under", "y.under"), F.lit(0)) == F.col("x.value")
    rough = _sizes_fit(F.col("x.meta"), F.col("y.meta"), similarity, F.col("x.s"), F.col("y.s"))
    return x.join(y, met & rough & near & first).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


class _Check:
    """Verifies pairs of texts, first by their parity bits, then by their shingles."""

    def __init__(self, texts: DataFrame, nodes: DataFrame, similarity: float, width: int, seed: int):
        self.texts, self.nodes, self.similarity, self.width, self.seed = texts, nodes.select("node", "size", "bits"), similarity, width, seed

    def links(self, pairs: DataFrame, nearest: int | None = None) -> DataFrame:
        """The pairs (a, b) that are similar; of each b only the ``nearest`` by parity bits are tried, if that is given."""
        similarity = self.similarity
        pairs = pairs if nearest else pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        pairs = settle(pairs.where("a <> b").distinct(), "similar-pairs")

        def compare(batch):
            """The pairs whose parity bits allow the similarity, and how far they are apart."""
            far, good = [], []
            for i, (m, n, x, y) in enumerate(zip(*[batch[c].to_pylist() for c in ("m", "n", "x", "y")], strict=True)):
                if min(m, n) + 1e-6 >= similarity * max(m, n) and (d := parity_distance(x, y)) <= (m + n) * (1 - similarity) / (1 + similarity) + 1e-6:
                    far.append(d)
                    good.append(i)
            return {"a": batch["a"].take(pa.array(good, pa.int64())), "b": batch["b"].take(pa.array(good, pa.int64())), "apart": pa.array(far, pa.int64())}

        joined = pairs.join(self.nodes.toDF("a", "m", "x"), "a").join(self.nodes.toDF("b", "n", "y"), "b").select("a", "b", "m", "n", "x", "y")
        likely = map_arrow(joined, "a long, b long, apart long", compare)
        if nearest:
            by = Window.partitionBy("b").orderBy("apart", "a")
            likely = likely.withColumn("nth", F.row_number().over(by)).where(F.col("nth") <= nearest)
        likely = settle(likely.select("a", "b"), "similar-likely")

        wanted = settle(likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct(), "similar-wanted")

        width, seed = self.width, self.seed

        def sets(batch):
            held = [np.unique(shingle_hashes(t, width, seed)).tobytes() for t in batch["text"].cast(pa.binary()).to_pylist()]
            return {"node": batch["node"], "shingles": pa.array(held, pa.binary())}

        some = self.texts.join(small(wanted), "node", "left_semi").select("node", "text")
        held = settle(map_arrow(some, "node long, shingles binary", sets).groupBy("node").agg(F.first("shingles").alias("shingles")), "similar-shingles")

        def verify(batch):
            good = []
            for x, y in zip(batch["x"].to_pylist(), batch["y"].to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(len(x) == len(y) == 0 or both >= similarity * (len(x) + len(y) - both))
            return {"a": batch["a"], "b": batch["b"], "good": pa.array(good, pa.bool_())}

        joined = likely.join(held.toDF("a", "x"), "a").join(held.toDF("b", "y"), "b").select("a", "b", "x", "y")
        return settle(map_arrow(joined, "a long, b long, good boolean", verify).where("good").select("a", "b"), "similar-links")


def _without(documents: DataFrame, go: DataFrame, again: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``documents`` but those of the texts in ``go``, and one of each that ``again`` names."""
    names = documents.columns
    numbered = documents.toDF(*[f"_{i}" for i in range(len(names))])
    key = lambda c: F.coalesce(c.cast("string"), F.lit("\0"))
    keyed = lambda df: df.select(key(F.col("row.id")).alias("k"), F.col("row.node").alias("h"))
    rows = numbered.withColumn("k", key(F.col(f"_{names.index(id_col)}"))).withColumn("h", F.xxhash64(f"_{names.index(text_col)}"))
    rows = rows.join(keyed(go), ["k", "h"], "left_anti")
    if again.limit(1).count():
        hashed = [F.col(f.name) for f in numbered.schema.fields if "map<" not in f.dataType.simpleString()]
        repeats = rows.join(keyed(again), ["k", "h"], "left_semi").withColumn("n", F.row_number().over(Window.partitionBy("k", "h").orderBy(F.xxhash64(*hashed))))
        rows = rows.join(keyed(again), ["k", "h"], "left_anti").union(repeats.where("n = 1").drop("n"))
    return rows.select(*[F.col(f"_{i}").alias(n) for i, n in enumerate(names)])


def op5_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    out = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), width=3)
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))
