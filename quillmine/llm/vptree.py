"""Approximate nearest neighbours by cosine: a vantage-point tree in each shard.

A small tree over a sample deals vectors to regions, and a hash of their id to the shards of a region.
On the unit sphere the Euclidean distance is a metric and falls as the cosine grows, so the triangle
inequality bounds what a subtree can hold.  A subtree is passed over where its bound exceeds ``factor``
times the distance of the worst neighbour found so far: 1 restores exact search, less passes over
more.  A query goes to its own region first and then to those alone that its bound admits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmine.llm.common import pick, settle, tune

SAMPLE, LEVELS = 4096, 7  # vectors that the tree of regions is made of, and its depth at most
SLACK = 1e-7  # for rounding: bounds are distances, of which the square is accurate to 1e-15 or so


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of rows with rows, in double precision; equal vectors get equal results wherever they stand."""
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


class Tree:
    """Nodes are (vantage point, inner child, outer child, bounds of the distances in either) or leaves."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, copies: int, leaf: int = 64, seed: int = 1):
        # Of equal vectors only the smallest ids can be among the nearest.
        order = np.lexsort((ids, *vectors.T[:1]))
        ids, vectors = ids[order], vectors[order]
        _, same = np.unique(vectors, axis=0, return_inverse=True)
        by = np.lexsort((ids, same.ravel()))
        group = same.ravel()[by]
        first = np.concatenate([[True], group[1:] != group[:-1]])
        nth = np.arange(len(by)) - np.maximum.accumulate(np.where(first, np.arange(len(by)), 0))
        other = np.concatenate([[True], ids[by][1:] != ids[by][:-1]]) | first
        by = by[(nth < copies) & other]
        self.ids, self.raw, self.unit = ids[by], vectors[by], _unit(vectors[by])
        self.leaf, rng, self.nodes = leaf, np.random.default_rng(seed), []
        todo = [(np.arange(len(by)), None, 0)]
        while todo:
            at, parent, side = todo.pop()
            if parent is not None:
                self.nodes[parent][1 + side] = len(self.nodes)
            if len(at) <= leaf:
                self.nodes.append([at])
                continue
            few = at[rng.integers(0, len(at), 5)]  # of some, that from which the others' distances vary most
            spread = [self._far(self.unit[at[: 16 * leaf]], self.unit[v]).var() for v in few]
            point = few[int(np.argmax(spread))]
            d = self._far(self.unit[at], self.unit[point])
            order = np.argsort(d, kind="stable")
            cut = len(at) // 2
            a, b = order[:cut], order[cut:]
            self.nodes.append([point, 0, 0, d[a].min(), d[a].max(), d[b].min(), d[b].max()])
            todo += [(at[b], len(self.nodes) - 1, 1), (at[a], len(self.nodes) - 1, 0)]

    @staticmethod
    def _far(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (x @ y)))

    def search(self, raw: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k nearest of each row, nearest first, ties to the smaller id."""
        q, n = _unit(raw), len(raw)
        score, best = np.full((n, k), -2.0), np.full((n, k), -1)

        def look(at: np.ndarray, who: np.ndarray) -> None:
            got = np.round(q[who] @ self.unit[at].T, 12)
            some = got.max(1) >= score[who, -1]
            who, got = who[some], got[some]
            if not len(who):
                return
            s = np.concatenate([score[who], got], 1)
            p = np.concatenate([best[who], np.broadcast_to(at, got.shape)], 1)
            order = np.lexsort((np.where(p < 0, np.iinfo(np.int64).max, self.ids[p]), -s))[:, :k]
            score[who], best[who] = np.take_along_axis(s, order, 1), np.take_along_axis(p, order, 1)

        def walk(home: bool) -> None:
            todo = [(0, np.arange(n))]
            while todo:
                i, who = todo.pop()
                node = self.nodes[i]
                if len(node) == 1:
                    if home:
                        at_home[who] = i
                    who = who if home else who[at_home[who] != i]
                    if len(who) and len(node[0]):
                        look(node[0], who)
                    continue
                d = self._far(q[who], self.unit[node[0]])
                if home:
                    inner = d <= (node[4] + node[5]) / 2
                    outer = ~inner
                else:
                    reach = factor * np.sqrt(np.maximum(0.0, 2.0 - 2.0 * score[who, -1])) + SLACK
                    inner = np.maximum(node[3] - d, d - node[4]) <= reach
                    outer = np.maximum(node[5] - d, d - node[6]) <= reach
                for child, some in ((node[2], outer), (node[1], inner)):
                    if some.any():
                        todo.append((child, who[some]))

        at_home = np.full(n, -1)
        walk(True)  # each query's own leaf first, so that the others' bounds tell
        walk(False)
        exact = np.full((n, k), -2.0)
        for j in range(k):
            have = best[:, j] >= 0
            exact[have, j] = cosines(raw[have], self.raw[best[have, j]])
        ids = np.where(best < 0, -1, self.ids[best])
        return ids, np.where(best < 0, np.nan, exact)


class Regions:
    """The upper tree: vantage points and cuts by node, and of each region the exact bounds of its rows'
    distances to the points above it."""

    def __init__(self, unit: np.ndarray, levels: int, seed: int = 1):
        self.levels, self.count = levels, 1 << levels
        self.points, self.cuts = np.zeros((self.count - 1, unit.shape[1])), np.full(self.count - 1, np.inf)
        members, rng = {0: np.arange(len(unit))}, np.random.default_rng(seed)
        for node in range(self.count - 1):
            at = members.pop(node, np.empty(0, np.int64))
            if not len(at):
                continue
            few = at[rng.integers(0, len(at), 5)]
            point = few[int(np.argmax([Tree._far(unit[at], unit[v]).var() for v in few]))]
            d = Tree._far(unit[at], unit[point])
            self.points[node], self.cuts[node] = unit[point], np.median(d)
            members[2 * node + 1], members[2 * node + 2] = at[d <= self.cuts[node]], at[d > self.cuts[node]]
        nodes = np.arange(self.count) + self.count - 1
        self.above = np.empty((self.count, levels), np.int64)  # the nodes over each region, the nearest last
        for level in range(levels - 1, -1, -1):
            nodes = (nodes - 1) // 2
            self.above[:, level] = nodes
        self.rows, self.low, self.high = np.zeros(self.count, np.int64), np.full((self.count, levels), np.inf), np.full((self.count, levels), -np.inf)

    def of(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(region, distance to the point of each level) of rows."""
        node, far = np.zeros(len(unit), np.int64), np.empty((len(unit), self.levels))
        for level in range(self.levels):
            far[:, level] = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * np.einsum("ij,ij->i", unit, self.points[node])))
            node = 2 * node + 1 + (far[:, level] > self.cuts[node])
        return node - (self.count - 1), far

    def admitted(self, unit: np.ndarray, reach: np.ndarray) -> np.ndarray:
        """Which regions may hold a row within ``reach`` of each query."""
        far = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (unit @ self.points.T)))[:, self.above]
        gap = np.maximum(self.low - far, far - self.high).max(2) if self.levels else np.zeros((len(unit), 1))
        return (gap <= reach[:, None] + SLACK) & (self.rows > 0)


def _regions(rows: DataFrame, dim: int, count: int, shard_rows: int) -> Regions:
    """A tree over at most ``SAMPLE`` rows, those of the smallest hashes, with as many regions as shards fill, at most 2 ** ``LEVELS``."""
    levels = min(LEVELS, max(0, -(-count // shard_rows) - 1).bit_length())
    if not levels:
        return Regions(np.empty((0, dim)), 0)
    share = int(min(1.0, 2 * SAMPLE / count) * (1 << 30)) + 1
    order = F.xxhash64("id", F.lit("regions"))
    got = rows.where(F.pmod(order, F.lit(1 << 30)) < share).orderBy(order, "id").limit(SAMPLE).select("v").toArrow()
    return Regions(_unit(got.column(0).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)), levels)


def nearest(vectors: DataFrame, queries: Column, k: int = 5, factor: float = 0.3, shard_rows: int = 8192, id_col: str = "vec_id", vector_col: str = "embedding", block: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query, all others if fewer.

    ``queries`` is a condition on the column ``id``.  Rows of the query's own id are no candidates.
    Null ids, and vectors that are null, zero, hold a null or a non-finite component, or whose length
    isn't the table's most frequent one (ties: the longest), take no part; nor do those whose squares
    overflow or vanish, for which no cosine can be told.  A repeated id counts once,
    with the vector that sorts first.  score is the cosine in double precision.  An empty table gives an
    empty result.  Each task holds one shard of about ``shard_rows`` rows and a block of queries; the
    queries stream past it.
    """
    tune(vectors.sparkSession)
    rows = pick(vectors, id=id_col, v=vector_col).select(F.col("id").cast("long").alias("id"), F.col("v").cast("array<double>").alias("v"))
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    sound = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & (square > 1e-280) & (square < 1e280)
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(sound)
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    dim, count = (sizes[0]["n"], sizes[0]["count"]) if sizes else (1, 0)
    rows = rows.where(F.size("v") == dim).groupBy("id").agg(F.min("v").alias("v"))
    rows = settle(rows, "vectors")
    regions = _regions(rows, dim, count, shard_rows)

    def matrix(batch: pa.RecordBatch) -> np.ndarray:
        return batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(regions.of(_unit(matrix(batch)))[0].astype(np.int32))], ["id", "v", "region"])

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high, n = regions.low.copy(), regions.high.copy(), regions.rows.copy()
        for batch in batches:
            if batch.num_rows:
                home, far = regions.of(_unit(matrix(batch)))
                np.minimum.at(low, home, far)
                np.maximum.at(high, home, far)
                np.add.at(n, home, 1)
        for r in np.flatnonzero(n):
            levels = max(regions.levels, 1)
            yield pa.RecordBatch.from_pydict({"region": pa.array([int(r)] * levels, pa.int32()), "level": pa.array(list(range(levels)), pa.int32()), "low": pa.array((low[r].tolist() or [0.0]), pa.float64()), "high": pa.array((high[r].tolist() or [0.0]), pa.float64()), "n": pa.array([int(n[r])] * levels, pa.int64())})

    placed = settle(rows.mapInArrow(place, "id long, v array<double>, region int"), "vectors-placed")
    bounds = placed.select("v").mapInArrow(ends, "region int, level int, low double, high double, n long").groupBy("region", "level").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
    for r in bounds.collect():  # a row for each region and level
        regions.rows[r["region"]] = r["n"]
        if regions.levels:
            regions.low[r["region"], r["level"]], regions.high[r["region"], r["level"]] = r["low"], r["high"]
    parts = -(-regions.rows // shard_rows)
    first = np.cumsum(parts) - parts
    shards = int(parts.sum()) or 1
    table = [(int(r), int(first[r]), int(parts[r])) for r in np.flatnonzero(parts)]
    table = F.broadcast(placed.sparkSession.createDataFrame(table, "region int, first int, parts int"))  # at most 2 ** LEVELS rows
    dealt = placed.join(table, "region")
    held = dealt.select((F.col("first") + F.pmod(F.xxhash64("id"), "parts")).cast("int").alias("shard"), F.lit(0).alias("kind"), "id", "v")
    asked = dealt.where(queries)
    at_home = asked.select(F.explode(F.sequence("first", F.col("first") + F.col("parts") - 1)).alias("shard"), F.lit(1).alias("kind"), "id", "v")

    def answer(tree: Tree, ids: np.ndarray, q: np.ndarray) -> pa.RecordBatch:
        distinct, same = np.unique(q, axis=0, return_inverse=True)
        found, score = tree.search(distinct, k + 1, factor)
        found, score = found[same.ravel()], score[same.ravel()]
        keep = ~np.isnan(score) & (found != ids[:, None])
        keep &= keep.cumsum(1) <= k
        rows, cols = np.nonzero(keep)
        return pa.RecordBatch.from_pydict({"query_id": pa.array(ids[rows]), "vec_id": pa.array(found[rows, cols]), "score": pa.array(score[rows, cols])})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tree, ids, vecs = None, None, [], []
        for batch in batches:
            shard, kind = batch.column("shard").to_numpy(), batch.column("kind").to_numpy()
            own, v = batch.column("id").to_numpy(), matrix(batch)
            edges = np.flatnonzero(np.concatenate([[True], (shard[1:] != shard[:-1]) | (kind[1:] != kind[:-1])]))
            for a, b in zip(edges, [*edges[1:], len(shard)], strict=True):
                if now != (shard[a], kind[a]):
                    if ids and now[1] == 1 and tree is not None:
                        yield answer(tree, np.concatenate(ids), np.concatenate(vecs))
                    if kind[a] == 0 or now is None or now[0] != shard[a]:
                        tree = None
                    if kind[a] == 1 and now == (shard[a], 0):
                        tree = Tree(np.concatenate(ids), np.concatenate(vecs), k + 1)
                    now, ids, vecs = (shard[a], kind[a]), [], []
                ids.append(own[a:b])
                vecs.append(v[a:b])
                if kind[a] == 1 and sum(map(len, ids)) >= block:
                    if tree is not None:
                        yield answer(tree, np.concatenate(ids), np.concatenate(vecs))
                    ids, vecs = [], []
        if ids and now[1] == 1 and tree is not None:
            yield answer(tree, np.concatenate(ids), np.concatenate(vecs))

    def search(some: DataFrame) -> DataFrame:
        both = held.union(some).repartition(4 * shards, "shard").sortWithinPartitions("shard", "kind", "id")
        return both.mapInArrow(run, "query_id long, vec_id long, score double")

    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    best = lambda df: df.withColumn("rank", rank).where(F.col("rank") <= k)
    found = best(search(at_home)).select("query_id", "rank", "vec_id", "score")
    if not regions.levels:
        return found
    found = settle(found, "vectors-found")

    def admit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                far = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * some.column("worst").to_numpy(zero_copy_only=False)))
                fit = regions.admitted(_unit(matrix(some)), np.where(some.column("n").to_numpy() < k, np.inf, factor * far))
                fit[np.arange(some.num_rows), some.column("region").to_numpy()] = False
                who, where = np.nonzero(fit)
                n = parts[where]
                if n.sum():
                    who, begin = np.repeat(who, n), np.repeat(first[where], n)
                    shard = begin + np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)
                    rows = some.take(pa.array(who))
                    yield pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int32)), pa.array(np.ones(len(who), np.int32)), rows.column("id"), rows.column("v")], ["shard", "kind", "id", "v"])

    worst = found.groupBy(F.col("query_id").alias("id")).agg(F.min("score").alias("worst"), F.count("*").cast("int").alias("n"))
    bounded = asked.join(worst, "id", "left").select("id", "v", "region", F.coalesce("worst", F.lit(-1.0)).alias("worst"), F.coalesce("n", F.lit(0)).alias("n"))
    more = search(bounded.mapInArrow(admit, "shard int, kind int, id long, v array<double>"))
    return best(found.drop("rank").union(more)).select("query_id", "rank", "vec_id", "score")


def op4_vantage_point_ann(spark, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 50 == 0)
