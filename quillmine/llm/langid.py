"""Language identification by rank-order n-gram profiles (Cavnar and Trenkle, 1994)."""

from __future__ import annotations

import functools
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmine.llm.common import crc_mod, map_arrow, pick, tune

GAP = 1  # the code of what stands between words
BLOCK = 1 << 18  # characters counted at a time


@functools.cache
def _alphabet() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: the lower-cased letter, a mark itself, or GAP; and whether it is a letter."""
    code, letter = np.full(0x110000, GAP, np.uint32), np.zeros(0x110000, bool)
    for i in range(0x41, 0x40000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            code[i], letter[i] = ord(low) if len(low) == 1 else i, True
        elif unicodedata.category(c)[0] == "M":
            code[i] = i
    return code, letter


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of counts by code, codes ascending."""
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    if len(parts) == 1:
        return parts[0]
    codes, counts = np.concatenate([c for c, _ in parts]), np.concatenate([n for _, n in parts])
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[first], np.add.reduceat(counts, first)


def ngrams(raw: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """(codes, counts) of the letter 1- to 3-grams of a whole text, a gap at either end of each word.

    A code holds up to three code points of 21 bits, so different n-grams have different codes.
    Null and texts without a letter have none.
    """
    code, letter = _alphabet()
    text = (raw or b"").decode("utf-8", "replace")
    parts, held, any_letter = [], np.array([GAP], np.uint64), False
    for at in range(0, len(text), BLOCK):
        points = np.frombuffer(text[at : at + BLOCK].encode("utf-32-le", "replace"), np.uint32)
        any_letter = any_letter or bool(letter[points].any())
        k = len(held)
        z = np.concatenate([held, code[points].astype(np.uint64), [np.uint64(GAP)] if at + BLOCK >= len(text) else np.empty(0, np.uint64)])
        keep = np.ones(len(z), bool)
        keep[k:] = (z[k:] != GAP) | (z[k - 1 : -1] != GAP)
        z = z[keep]
        two = z[:-1] << np.uint64(21) | z[1:]
        three = two[:-1] << np.uint64(21) | z[2:]
        three = three[max(k - 2, 0) :][z[max(k - 1, 1) : -1] != GAP] if len(z) > 2 else three[:0]
        one = z[k:]
        parts.append(np.unique(np.concatenate([one[one != GAP], two[k - 1 :], three]).astype(np.int64), return_counts=True))
        held = z[-2:]
    return _merged(parts) if any_letter else _merged([])


def profiles(documents: DataFrame, usable: Column | None = None, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", length: int = 400) -> dict[str, np.ndarray]:
    """Each language's most frequent n-grams, most frequent first (ties: smaller code first).

    All whole texts with a language count, but for those that ``usable``, a condition on the column
    ``id``, leaves out.  Counts are summed in each task before they are shuffled; the driver gets
    ``length`` numbers a language and nothing else, so ``lang`` should hold languages and no free text.
    Repeated rows count as often as they stand; an empty table gives no profile.
    """
    tune(documents.sparkSession)
    rows = pick(documents, id=id_col, lang=lang_col, text=text_col).where("lang is not null")
    rows = (rows if usable is None else rows.where(usable)).select("lang", "text")

    def emit(by: dict) -> Iterator[pa.RecordBatch]:
        for lang, parts in by.items():
            codes, counts = _merged(parts)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(codes), pa.string()), "code": pa.array(codes, pa.int64()), "n": pa.array(counts, pa.int64())})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by, held = defaultdict(list), 0
        for batch in batches:
            for lang, raw in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                by[lang].append(ngrams(raw))
                held += len(by[lang][-1][0])
                if held > 2_000_000:
                    by = defaultdict(list, {k: [_merged(v)] for k, v in by.items()})
                    if (held := sum(len(v[0][0]) for v in by.values())) > 1_000_000:
                        yield from emit(by)
                        by, held = defaultdict(list), 0
        yield from emit(by)

    total = rows.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    best = defaultdict(list)
    for r in total.withColumn("rank", rank).where(F.col("rank") <= length).orderBy("lang", "rank").collect():
        best[r.lang].append(r.code)
    return {k: np.array(v, np.int64) for k, v in best.items()}


def predict(documents: DataFrame, known: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text", length: int = 400) -> DataFrame:
    """(id, lang, score): one row for each row of the input, by the smallest out-of-place distance.

    The distance adds up how far each of the document's ``length`` most frequent n-grams is from its
    place in the language's profile, ``length`` for one that it lacks; ties go to the language that
    sorts first.  score is 1 less the distance as a share of the largest possible.  A null text, one
    without a letter and any text where nothing was learned are ``und`` with score 0.  Whole texts count,
    block by block however long; repeated rows are each predicted.
    """
    tune(documents.sparkSession)
    names = sorted(known)
    codes = np.unique(np.concatenate([known[n] for n in names])) if names else np.empty(0, np.int64)
    place = np.full((len(names), len(codes)), -1, np.int64)
    for i, n in enumerate(names):
        place[i, np.searchsorted(codes, known[n])] = np.arange(len(known[n]))

    def one(raw):
        found, counts = ngrams(raw)
        if not len(found) or not names:
            return "und", 0.0
        top = found[np.argsort(-counts, kind="stable")[:length]]
        at = np.minimum(np.searchsorted(codes, top), len(codes) - 1)
        there = place[:, at]
        off = np.where((there >= 0) & (codes[at] == top), np.minimum(np.abs(there - np.arange(len(top))), length), length).sum(1)
        best = int(off.argmin())
        return names[best], 1.0 - float(off[best]) / (length * len(top))

    def run(batch):
        got = [one(t) for t in batch["text"].cast(pa.binary()).to_pylist()]
        return {"id": batch["id"], "lang": pa.array([g[0] for g in got], pa.string()), "score": pa.array([g[1] for g in got], pa.float64())}

    rows = pick(documents, id=id_col, text=text_col)
    return map_arrow(rows, f"id {rows.schema['id'].dataType.simpleString()}, lang string, score double", run)


def op1_language_rank_order(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = predict(documents, profiles(documents, ~crc_mod(F.col("id"), 4, 2)))
    return out.select(F.col("id").alias("doc_id"), crc_mod(F.col("id"), 4, 2).alias("held_out"), F.col("lang").alias("lang_pred"), "score")
