"""Quality classifier: naive Bayes support vectors (Wang and Manning, 2012).

N-gram indicators are scaled by the log ratio of their class counts; a linear model with hinge
loss is then fitted by dual coordinate descent (Hsieh et al., 2008) and its margins are mapped to
probabilities by a logistic curve fitted on margins of rows left out of the fit.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmine.llm.common import crc_mod, map_arrow, pick, tune

BITS = 18
SAME = 0x9E3779B9  # stands for "the word before, again", so that repetition is one n-gram for all words
MIX = np.uint64(0x9E3779B97F4A7C15)


def _fold(x: np.ndarray, salt: int) -> np.ndarray:
    return (((x + np.uint64(salt)) * MIX) >> np.uint64(64 - BITS)).astype(np.int32)


def features(text: str | None) -> np.ndarray:
    """Sorted ids of the indicators that are set: byte 1- to 3-grams, words and word pairs."""
    raw = (text or "").encode("utf-8", "replace").lower()
    words = raw.split()
    if not words:
        return np.empty(0, np.int32)
    b = np.frombuffer(raw, np.uint8).astype(np.uint64)
    parts = [_fold(np.unique(b), 1 << 40)]
    if len(b) > 1:
        two = b[:-1] << np.uint64(8) | b[1:]
        parts.append(_fold(two, 2 << 40))
        parts.append(_fold(two[:-1] << np.uint64(8) | b[2:], 3 << 40))
    of = xxhash.xxh32_intdigest
    h = np.array([of(w) for w in words], np.uint64)
    parts.append(_fold(h, 4 << 40))
    if len(h) > 1:
        again = np.where(h[1:] == h[:-1], np.uint64(SAME), h[1:] ^ (h[:-1] << np.uint64(24)))
        parts.append(_fold(again, 5 << 40))
    on = np.zeros(1 << BITS, bool) if len(b) > 20_000 else None
    if on is None:
        return np.unique(np.concatenate(parts))
    for p in parts:
        on[p] = True
    return np.flatnonzero(on).astype(np.int32)


def _descend(xs: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, cost: np.ndarray, epochs: int, seed: int) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss; the bias is the weight of a constant feature."""
    w, bias, alpha = np.zeros(1 << BITS), 0.0, np.zeros(len(y))
    square = np.array([v @ v + 1.0 for _, v in xs])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(y)):
            ids, v = xs[i]
            slope = y[i] * (w[ids] @ v + bias) - 1
            if (slope >= 0 and alpha[i] == 0) or (slope <= 0 and alpha[i] == cost[i]):
                continue
            new = min(max(alpha[i] - slope / square[i], 0.0), cost[i])
            step = (new - alpha[i]) * y[i]
            w[ids] += step * v
            bias += step
            worst, alpha[i] = max(worst, abs(slope)), new
        if worst < 1e-3:
            break
    return w, bias


def _ratio(rows: list[np.ndarray], y: np.ndarray, smooth: float) -> np.ndarray:
    count = {s: np.full(1 << BITS, smooth) for s in (1, -1)}
    for ids, s in zip(rows, y, strict=True):
        count[int(s)][ids] += 1
    return np.log(count[1] / count[1].sum()) - np.log(count[-1] / count[-1].sum())


def _scaled(rows: list[np.ndarray], r: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for ids in rows:
        v = r[ids]
        out.append((ids, v / (np.sqrt(v @ v) or 1.0)))
    return out


def _logistic(m: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt's curve by Newton steps, with his smoothed targets."""
    up, down = (y > 0).sum(), (y < 0).sum()
    t = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    x, ab = np.stack([m, np.ones_like(m)], 1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ ab, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (t - p) - 1e-6 * ab)
        ab = ab + np.clip(step, -2, 2)
        if abs(step).max() < 1e-8:
            break
    return float(ab[0]), float(ab[1])


def fit(rows: list[np.ndarray], label: np.ndarray, c: float = 1.0, smooth: float = 1.0, epochs: int = 12, seed: int = 7) -> tuple[np.ndarray, float, float]:
    """(weights of the raw scaled indicators' ratio, and the curve's slope and offset).

    Returned are ``r * w`` folded into (r, w): a float32 array of two rows, r and w.  With one class
    only, or no rows, every text gets that class's smoothed share.
    """
    y = np.where(label > 0, 1.0, -1.0)
    n, up = len(y), (y > 0).sum()
    if up in (0, n):
        share = (up + 1) / (n + 2)
        return np.zeros((2, 1 << BITS), np.float32), 0.0, float(np.log(share / (1 - share)))
    weigh = lambda s: c * np.where(s > 0, 0.5 * len(s) / max((s > 0).sum(), 1), 0.5 * len(s) / max((s < 0).sum(), 1))
    margin, part = np.zeros(n), np.random.default_rng(seed).integers(0, 3, n)
    for k in range(3):
        fit_on, left = np.flatnonzero(part != k), np.flatnonzero(part == k)
        if len(set(y[fit_on])) < 2 or not len(left):
            continue
        r = _ratio([rows[i] for i in fit_on], y[fit_on], smooth)
        w, b = _descend(_scaled([rows[i] for i in fit_on], r), y[fit_on], weigh(y[fit_on]), epochs, seed)
        margin[left] = [w[ids] @ v + b for ids, v in _scaled([rows[i] for i in left], r)]
    slope, offset = _logistic(margin, y)
    r = _ratio(rows, y, smooth)
    w, b = _descend(_scaled(rows, r), y, weigh(y), epochs, seed)
    return np.stack([r, w]).astype(np.float32), slope, slope * b + offset


def train(documents: DataFrame, labels: DataFrame, usable: Column | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_rows: int = 8000) -> tuple[np.ndarray, float, float]:
    """Fit on at most ``max_rows`` labelled rows, those whose ids have the smallest xxhash64.

    The bound keeps the fit in one task and lets the labels be broadcast; texts are never shuffled.
    ``usable`` is a condition on the column ``id``.  Repeated labels of an id count as their majority
    (ties: 1); null labels and null ids are not used.
    """
    tune(documents.sparkSession)
    known = pick(labels, id=id_col, label=label_col).where("id is not null and label is not null")
    if usable is not None:
        known = known.where(usable)
    known = known.groupBy("id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(max_rows)
    texts = pick(documents, id=id_col, text=text_col).join(F.broadcast(known), "id").select("id", "label", "text")

    def indicators(batch):
        ids = [features(t) for t in batch["text"].to_pylist()]
        return {"id": batch["id"].cast(pa.string()), "label": batch["label"], "ids": pa.array([i.tobytes() for i in ids], pa.binary())}

    def one(batches):
        got = sorted((i, y, x) for b in batches for i, y, x in zip(*[c.to_pylist() for c in b.columns], strict=True))
        model, slope, offset = fit([np.frombuffer(x, np.int32) for _, _, x in got], np.array([y for _, y, _ in got]))
        yield pa.RecordBatch.from_pydict({"model": pa.array([model.tobytes()], pa.binary()), "slope": [slope], "offset": [offset]})

    rows = map_arrow(texts, "id string, label int, ids binary", indicators).repartition(1)
    got = rows.mapInArrow(one, "model binary, slope double, offset double").first()
    if got is None:
        return fit([], np.empty(0))
    return np.frombuffer(got.model, np.float32).reshape(2, -1), got.slope, got.offset


def _judge(model: tuple[np.ndarray, float, float]) -> Callable[[str | None], float]:
    (r, w), slope, offset = model

    def one(text: str | None) -> float:
        ids = features(text)
        v = r[ids].astype(np.float64)
        m = w[ids] @ v / (np.sqrt(v @ v) or 1.0)
        return float(1 / (1 + np.exp(-np.clip(slope * m + offset, -700, 700))))

    return one


def score(documents: DataFrame, model: tuple[np.ndarray, float, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score): the probability of label 1 for every whole text, one row for each row of the input.

    Null and empty texts set no indicator and get the score of the offset alone; repeated rows get equal
    scores.  Texts count whole; memory for one is some forty times its size while its indicators are found.
    """
    tune(documents.sparkSession)
    one = _judge(model)

    def run(batch):
        return {"id": batch["id"], "score": pa.array([one(t) for t in batch["text"].to_pylist()], pa.float64())}

    rows = pick(documents, id=id_col, text=text_col)
    return map_arrow(rows, f"id {rows.schema['id'].dataType.simpleString()}, score double", run)


def keep_good(documents: DataFrame, model: tuple[np.ndarray, float, float], threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows and columns of ``documents`` whose score reaches the threshold; texts aren't shuffled."""
    tune(documents.sparkSession)
    judge, names = _judge(model), documents.columns
    at = names.index(text_col)

    def run(batches):
        for batch in batches:
            good = [judge(t) >= threshold for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(good, pa.bool_()))

    rows = documents.toDF(*[f"_{i}" for i in range(len(names))])
    return rows.mapInArrow(run, rows.schema).toDF(*names)


def op8_quality_nbsvm(spark, sf_dir: str) -> DataFrame:
    documents, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train(documents, labels, ~crc_mod(F.col("id"), 5, 0))
    out = score(documents, model)
    return out.select(F.col("id").alias("doc_id"), crc_mod(F.col("id"), 5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
