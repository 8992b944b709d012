"""Language-model scores by a hidden Markov model trained with Baum-Welch over the whole corpus.

Each word belongs to one class: the most frequent words each to their own, the others to one by their
last bytes.  Latent states emit classes, and a class emits its words by their counts, so a text's
probability is that of its classes, by the scaled forward recursion, times that of each word in its
class.  The states' parameters are few whatever the corpus; the words' counts grow with it and stay
distributed.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmine.llm.common import crc_mod, pick, settle, tune

OWN, TAILS = 2000, 1023  # classes of one word each, and classes by a word's last bytes; then one for the end
END = OWN + TAILS
CLASSES = END + 1
BLOCK = 4096  # steps of a sequence whose forward variables are held at a time
CHUNK = 300_000  # forward variables of so many tokens are held for sequences that advance together
AT_ONCE = 2_000_000  # tokens that a task gathers before it goes through them


def tokens(raw: bytes | None) -> list[bytes]:
    """Lower-cased (A-Z) runs without ASCII white space; null has none."""
    return (raw or b"").lower().split()


def tail_class(word: bytes) -> int:
    return OWN + crc32(word[-3:]) % TAILS


class Model:
    """Start, transition and emission probabilities of the states (emission: by class, then state)."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit

    @staticmethod
    def begin(share: np.ndarray, states: int, seed: int) -> Model:
        """Sticky states that emit at random about the classes' shares."""
        rng = np.random.default_rng(seed)
        emit = share[:, None] * rng.gamma(4.0, 0.25, (CLASSES, states))
        move = np.full((states, states), 0.1 / max(states - 1, 1))
        np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
        return Model(np.full(states, 1 / states), move, emit / emit.sum(0))

    @staticmethod
    def from_counts(counts: np.ndarray, share: np.ndarray, states: int) -> Model:
        """The next parameters; each row of counts is smoothed by one more observation, of emissions
        by the classes' shares, so nothing has probability zero."""
        start, move, emit = np.split(counts, [states, states + states * states])
        start, move, emit = start + 1 / states, move.reshape(states, states) + 1 / states, emit.reshape(CLASSES, states) + share[:, None]
        return Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def _together(sequences: list[np.ndarray]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Groups of sequences of like length: (their numbers, classes by step and sequence, number at each step)."""
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    while order:
        longest = len(sequences[order[0]])
        n = max(1, min(CHUNK // min(longest, BLOCK), 8 * CHUNK // longest))
        some, order = order[:n], order[n:]
        seen = np.full((longest, len(some)), END, np.intp)
        for j, i in enumerate(some):
            seen[: len(sequences[i]), j] = sequences[i]
        lengths = np.array([len(sequences[i]) for i in some])
        yield some, seen, np.searchsorted(-lengths, -np.arange(longest), "left")


def log10_forward(sequences: list[np.ndarray], model: Model) -> np.ndarray:
    """The exact log10 probability of each sequence of classes (none is empty: each has its end)."""
    out = np.zeros(len(sequences))
    for some, seen, count in _together(sequences):
        total, ones, a = np.zeros(len(some)), np.ones(len(model.start)), None
        for t in range(len(seen)):
            a = (model.start if t == 0 else a[: count[t]] @ model.move) * model.emit.take(seen[t, : count[t]], 0, mode="clip")
            scale = a @ ones
            a /= scale[:, None]
            total[: count[t]] += np.log10(scale)
        out[some] = total
    return out


def expected_counts(sequences: list[np.ndarray], model: Model) -> np.ndarray:
    """Baum-Welch counts of starts, moves and emissions, one after the other."""
    return _expected(sequences, model)[0]


def _expected(sequences: list[np.ndarray], model: Model) -> tuple[np.ndarray, float]:
    """Those counts, and the log10 probability of all sequences.

    Forward variables are held for ``BLOCK`` steps; of longer sequences those at the blocks' beginnings
    are, and each block is gone through again on the way back, so memory doesn't grow with a text."""
    k, log = len(model.start), 0.0
    start, move, emit, ones, moved = np.zeros(k), np.zeros((k, k)), np.zeros((CLASSES, k)), np.ones(k), np.ascontiguousarray(model.move.T)
    for _, seen, count in _together(sequences):

        def forward(t: int, a: np.ndarray | None, seen=seen, count=count):
            e = model.emit.take(seen[t, : count[t]], 0, mode="clip")
            a = (model.start if t == 0 else a[: count[t]] @ model.move) * e
            scale = 1 / (a @ ones)
            a *= scale[:, None]
            e *= scale[:, None]
            return a, e, scale

        saved, a, last = [], None, (len(seen) - 1) // BLOCK * BLOCK
        for t in range(last + 1):
            if t % BLOCK == 0:
                saved.append(a)
            if t < last:
                a, _, _ = forward(t, a)
        after = None  # scaled emission times backward variable of the step after
        for block in range(len(saved) - 1, -1, -1):
            a, steps, flat, shares = saved[block], [], [], []
            for t in range(block * BLOCK, min(len(seen), (block + 1) * BLOCK)):
                a, e, scale = forward(t, a)
                log -= float(np.log10(scale).sum())
                steps.append((t, a, e))
            while steps:
                t, a, e = steps.pop()
                share = a.copy()
                if after is not None:
                    n = len(after)
                    move += a[:n].T @ after
                    b = after @ moved
                    share[:n] *= b
                    e[:n] *= b
                after = e
                shares.append(share)
                flat.append(seen[t, : count[t]])
            if block == 0:
                start += share.sum(0)
            flat, share = np.concatenate(flat), np.concatenate(shares)
            for j in range(k):
                emit[:, j] += np.bincount(flat, share[:, j], CLASSES)
    return np.concatenate([start, (move * model.move).ravel(), emit.ravel()]), log


def _packed(classes: np.ndarray) -> bytes:
    return zstandard.compress(classes.astype("<u2").tobytes(), 1)


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(raw), "<u2").astype(np.int32)


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) of the column ``text``, with each text's end as a null word.  Each task sums its own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, ends = Counter(), 0
        for batch in batches:
            for raw in batch.column("text").cast(pa.binary()).to_pylist():
                seen.update(tokens(raw))
                ends += 1
            if len(seen) > 400_000:
                yield from emit(seen, 0)
                seen = Counter()
        yield from emit(seen, ends)

    def emit(seen: Counter, ends: int) -> Iterator[pa.RecordBatch]:
        words, n = [*seen, *([None] if ends else [])], [*seen.values(), *([ends] if ends else [])]
        for k in range(0, len(words), 50_000):
            yield pa.RecordBatch.from_pydict({"word": pa.array(words[k : k + 50_000], pa.binary()), "n": pa.array(n[k : k + 50_000], pa.int64())})

    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _common(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The most frequent words with their counts, of ``most`` times 65 bytes in all, the most frequent first.

    Counts are binned finely, and the bins' sizes tell from which count on all words fit; so however
    many tasks there are, no more than that comes to the driver."""
    known = counts.where("word is not null and octet_length(word) <= 65536").withColumn("bin", F.floor(F.log2(F.col("n").cast("double")) * 32).cast("int"))
    left, least = most * 65, None
    for r in sorted(known.groupBy("bin").agg(F.sum(F.octet_length("word") + 48).alias("bytes")).collect(), reverse=True):
        if (left := left - r["bytes"]) < 0:
            break
        least = r["bin"]
    if least is None:
        return []
    got = known.where(F.col("bin") >= least).select("word", "n").toArrow()
    return sorted(zip(got.column(0).to_pylist(), got.column(1).to_pylist(), strict=True), key=lambda x: (-x[1], x[0]))


def _gathered(batches: Iterator[pa.RecordBatch], column: str = "classes") -> Iterator[tuple[list[pa.RecordBatch], list[np.ndarray]]]:
    """Batches by some ``AT_ONCE`` tokens, with their sequences: the more advance together, the less a step costs."""
    held, sequences, size = [], [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        sequences += [_unpacked(c) for c in batch.column(column).to_pylist()]
        size += sum(map(len, sequences[-batch.num_rows :]))
        if size >= AT_ONCE:
            yield held, sequences
            held, sequences, size = [], [], 0
    if held:
        yield held, sequences


def learn(blocks: list[DataFrame], share: np.ndarray, tokens: int, states: int = 8, gain: float = 1e-3, seed: int = 11) -> Model:
    """Incremental Baum-Welch (Neal and Hinton, 1998) over the packed ``classes`` of all blocks of the texts, from
    states about the classes' shares of all texts.

    A round goes over every text whole, block by block; after each block its counts replace those that it
    gave in the round before, and the parameters follow from the counts of all blocks, so a round improves
    them as often as there are blocks.  One block is the usual algorithm.  Rounds end when one has raised
    the mean log10 probability of a token by less than ``gain``."""
    size = states + states * states + CLASSES * states
    model, before, held = Model.begin(share, states, seed), -np.inf, np.zeros((len(blocks), size))

    def step(model: Model):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size + 1)
            for _, sequences in _gathered(batches):
                counts, log = _expected(sequences, model)
                total[:-1] += counts
                total[-1] += log
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"at": pa.array(at.astype(np.int32)), "n": pa.array(total[at])})

        return run

    while tokens:
        log = 0.0
        for b, texts in enumerate(blocks):
            counted = np.zeros(size + 1)
            got = texts.select("classes").mapInArrow(step(model), "at int, n double").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
            counted[got.column(0).to_numpy()] = got.column(1).to_numpy()
            held[b], log = counted[:-1], log + counted[-1]
            model = Model.from_counts(held.sum(0), share, states)
        if log / tokens - before < gain:
            break
        before = log / tokens
    return model


def score(documents: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", states: int = 8, gain: float = 1e-3, known: int = 200_000, seed: int = 11, blocks: int = 8) -> DataFrame:
    """(id, learnt, n_tokens, n_known, train_tokens, base_score, score): one row for each row of the input.

    ``usable`` is a condition on the column ``id``: the rows to learn from (``learnt``).  Tokens are a text's words
    and one end.  base_score adds up log10((c + 0.5) / (N + 0.5 (V + 1))) over the tokens; score is the
    model's log10 probability of the text, null texts being empty.  Words that weren't learnt share, in
    either, the place that the smoothing leaves them.

    The model is that of ``learn`` above, over every whole text to learn from, in ``blocks`` blocks.  The most
    frequent words are looked up in each task (``known`` times 65 bytes of them); all others are joined with the table of counts.  Rows
    with equal ids are scored each on its own.  An empty table, or nothing to learn from, is no error.
    """
    spark = documents.sparkSession
    tune(spark)
    rows = pick(documents, id=id_col, text=text_col).withColumn("learnt", F.coalesce(usable, F.lit(False)))
    counts = settle(word_counts(rows.where("learnt").select("text")), "words")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    common = _common(counts, known)
    index = {w: i for i, (w, _) in enumerate(common)}
    near_class = np.array([i if i < OWN else tail_class(w) for i, (w, _) in enumerate(common)], np.int32)
    near_log = np.log10(np.array([n for _, n in common], np.float64) + 0.5)

    def by_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, kinds = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
        for batch in batches:
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
                c = END if word is None else near_class[index[word]] if word in index else tail_class(word)
                held[c] += n
                kinds[c] += 1
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_pydict({"class": pa.array(at.astype(np.int32)), "n": pa.array(held[at]), "v": pa.array(kinds[at])})

    held, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in counts.mapInArrow(by_class, "class int, n long, v long").groupBy("class").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        held[r["class"]], kinds[r["class"]] = r.n, r.v
    share = (held + 0.5) / (held.sum() + 0.5 * CLASSES)
    room = np.log10(held + 0.5 * (kinds + 1))
    whole = float(np.log10(total + 0.5 * (distinct + 1)))
    ends = int(held[END])

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Classes of each text, and sums over those of its words whose counts are at hand."""
        for batch in batches:
            packed, n, logs, rooms, near, rare, times = [], [], [], [], [], [], []
            for raw in batch.column("text").cast(pa.binary()).to_pylist():
                words = tokens(raw)
                at = np.fromiter(map(index.get, words, repeat(-1)), np.int32, len(words))
                here = at >= 0
                line = np.empty(len(words) + 1, np.int32)
                line[:-1][here] = near_class[at[here]]
                far = [words[i] for i in np.flatnonzero(~here)]
                line[:-1][~here] = [tail_class(w) for w in far]
                line[-1] = END
                bag = Counter(far)
                packed.append(_packed(line))
                n.append(len(line))
                own = line < OWN
                both = near_log[at[here]]
                logs.append((float(both.sum()), float(both[at[here] < OWN].sum())))
                rooms.append(float(room[line[:-1][~own[:-1]]].sum()))
                near.append(int(here.sum()) + (ends > 0))
                rare.append(list(bag))
                times.append(list(bag.values()))
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("id"), "learnt": batch.column("learnt"), "classes": pa.array(packed, pa.binary()), "n_tokens": pa.array(n, pa.int64()),
                "log_near": pa.array([x - y for x, y in logs], pa.float64()), "log_own": pa.array([y for _, y in logs], pa.float64()), "rooms": pa.array(rooms, pa.float64()), "near": pa.array(near, pa.int64()),
                "rare": pa.array(rare, pa.list_(pa.binary())), "times": pa.array(times, pa.list_(pa.int32()))})

    id_type = rows.schema["id"].dataType.simpleString()
    made = rows.select("id", "text", "learnt").mapInArrow(classify, f"id {id_type}, learnt boolean, classes binary, n_tokens long, log_near double, log_own double, rooms double, near long, rare array<binary>, times array<int>")
    made = settle(made.withColumn("row", F.monotonically_increasing_id()), "classes", "snappy")

    files = sorted(made.inputFiles())
    parts = [spark.read.schema(made.schema).parquet(*files[b::blocks]) for b in range(min(blocks, len(files)))]
    model = learn([p.where("learnt") for p in parts], share, int(total), states, gain, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, sequences in _gathered(batches):
            logs, at = log10_forward(sequences, model), 0
            for batch in held:
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(logs[at : at + batch.num_rows])], [*batch.schema.names[:-1], "hmm"])
                at += batch.num_rows

    slim = made.select("id", "row", "learnt", "n_tokens", "log_near", "log_own", "rooms", "near", "classes")
    slim = slim.mapInArrow(run, f"id {id_type}, row long, learnt boolean, n_tokens long, log_near double, log_own double, rooms double, near long, hmm double")
    far = made.select("row", F.inline(F.arrays_zip(F.col("rare").alias("word"), F.col("times").alias("k"))))
    far = far.join(counts.where("word is not null"), "word", "left").groupBy("row").agg(
        F.sum(F.col("k") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("log_far"), F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(0)).alias("far"))
    log = F.col("log_near") + F.coalesce("log_far", F.lit(0.0))  # of words outside the classes of one word
    end = float(np.log10(ends + 0.5))
    return slim.join(far, "row", "left").select(
        "id", "learnt", "n_tokens", (F.col("near") + F.coalesce("far", F.lit(0))).cast("long").alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (log + F.col("log_own") + end - F.col("n_tokens") * whole).alias("base_score"), (F.col("hmm") + log - F.col("rooms")).alias("score"))


def op6_hmm_language_model(spark, sf_dir: str) -> DataFrame:
    held_out = crc_mod(F.col("id"), 5, 1)
    out = score(spark.read.parquet(f"{sf_dir}/documents.parquet"), ~held_out)
    return out.select(F.col("id").alias("doc_id"), (~F.col("learnt")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
