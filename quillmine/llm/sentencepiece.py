"""SentencePiece encoding and decoding by batched Viterbi in numpy.

Words of equal length advance together, a character at a time.  The hashes of all their substrings
probe the sorted hashes of the pieces; at each place the best last piece is kept as a backpointer.

For a unigram model the best piece is that of the largest sum of scores.  For a BPE model the paths
are exact too: a prefix's encoding ends in the one piece that was reachable by merges and that agrees
with the last piece of what stands before it, i.e. the pair of them is left as it is by the merges.
Whether it is follows from undoing the two pieces' merges in reverse order, latest first: the pair
fails where the neighbours at the seam could have merged before the merge that was undone.  So the
ids are those that the public library gives, which the tests compare.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quillmine.llm.common import by_size, give_back, map_arrow, pick, tune

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # fixed values of the model format
BASE, MIX = 0x9E3779B97F4A7C15 | 1, np.uint64(0xD6E8FEB86659FD93)
FILTER, CACHE = 20, 20  # bits of the tables that spare most probes
LONG = 32  # longer words are cut wherever no piece can span two characters
MOST_WORDS = 300_000  # encoded words that a worker remembers
AT_ONCE = 1 << 20  # bytes of texts that are encoded at a time, unless one has more
DECODED = 32  # texts that are decoded at a time
STEP = 100_000  # characters of words that advance together


def _fields(raw: bytes) -> Iterator[tuple[int, object]]:
    """The fields of a protocol buffer message: varints, 32- and 64-bit values and byte strings."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(tag & 7) or varint()
        yield tag >> 3, raw[at : at + size]
        at += size


class Pieces:
    """A model's pieces and the tables that encoding and decoding need."""

    def __init__(self, path: str = MODEL):
        self.text, self.score, self.kind, self.unigram = [], [], [], False
        dummy, squeeze, chars = 1, 1, b""
        with open(path, "rb") as f:
            model = f.read()
        for field, value in _fields(model):
            if field == 1:
                got = dict(_fields(value))
                self.text.append(got.get(1, b"").decode())
                self.score.append(struct.unpack("<f", got.get(2, bytes(4)))[0])
                self.kind.append(got.get(3, NORMAL))
            elif field == 2:
                kind = dict(_fields(value)).get(3, 1)
                if kind not in (1, 2):
                    raise ValueError("only unigram and BPE models are supported")
                self.unigram = kind == 1
            elif field == 3:
                got = dict(_fields(value))
                dummy, squeeze, chars = got.get(3, 1), got.get(4, 1), got.get(2, b"")
        if USER in self.kind or chars or squeeze:
            raise ValueError("models with user-defined symbols or a normalizer are not supported")
        self.dummy = bool(dummy)
        n = len(self.text)
        self.usable = {t: i for i, (t, k) in enumerate(zip(self.text, self.kind, strict=True)) if k in (NORMAL, UNUSED)}
        self.byte = {int(t[3:5], 16): i for i, (t, k) in enumerate(zip(self.text, self.kind, strict=True)) if k == BYTE}
        self.unk = self.kind.index(UNKNOWN) if UNKNOWN in self.kind else 0
        self.longest = max(map(len, self.usable), default=1)
        self.inner = {p[i : i + 2] for p in self.usable for i in range(len(p) - 1)}
        if any(p[1] == SPACE and p[0] != SPACE for p in self.inner):
            raise ValueError("models with pieces across a space are not supported")
        held = [bytes([int(t[3:5], 16)]) if k == BYTE else b"" if k in (CONTROL, UNKNOWN) else t.replace(SPACE, " ").encode() for t, k in zip(self.text, self.kind, strict=True)]
        self.bytes_at = np.concatenate([[0], np.cumsum([len(b) for b in held])])
        self.bytes = np.frombuffer(b"".join(held), np.uint8)
        self.left, self.right = np.full(n + 1, -1), np.full(n + 1, -1)
        self.order = np.full(n + 1, -1)
        self.spaces = {p: i for p, i in self.usable.items() if len(p) > 1 and not p.strip(SPACE)}
        reach = dict(self.usable)
        if not self.unigram:
            rest = [i for p, i in self.usable.items() if p not in self.spaces and len(p) > 1]
            if self.spaces and (any(SPACE * 2 in p for p in self.usable if p not in self.spaces) or max(self.score[i] for i in self.spaces.values()) >= min(self.score[i] for i in rest)):
                raise ValueError("models with such pieces of spaces are not supported")
            for place, i in enumerate(sorted(rest, key=lambda i: -self.score[i])):
                self.order[i] = place
            for i in rest:
                last = self._merge(self.text[i])
                if last is None:
                    del reach[self.text[i]]
                else:
                    self.left[i], self.right[i] = last
            for p in self.spaces:
                del reach[p]
            made = np.array([i for i in rest if self.text[i] in reach], np.int64)
            code = self.left[made] * (n + 1) + self.right[made]
            by = np.argsort(code)
            self.pairs, self.pair_order = code[by], self.order[made][by]
        self.n = n
        h = {self._hash(p): i for p, i in reach.items()}
        if len(h) < len(reach):
            raise ValueError("two pieces have one hash")
        self.keys = np.array(sorted(h), np.uint64)
        self.key_ids = np.array([h[int(k)] for k in self.keys], np.int32)
        self.maybe = np.zeros(1 << FILTER, bool)
        self.maybe[(self.keys * MIX) >> np.uint64(64 - FILTER)] = True
        self.forget()

    def forget(self) -> None:
        """Start with no word and no pair remembered."""
        self.pair_key = np.full(1 << CACHE, -1, np.int64)
        self.pair_fits = np.zeros(1 << CACHE, bool)
        self.words: dict[str, int] = {"": 0}
        self.flat, self.starts, self.sizes = np.empty(0, np.int32), np.zeros(1, np.int64), np.zeros(1, np.int64)

    def _hash(self, piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * BASE + ord(c) + 1) & (1 << 64) - 1
        return h

    def _merge(self, piece: str) -> tuple[int, int] | None:
        """The last merge that makes a piece of its characters; None if the merges end otherwise."""
        now, last = list(piece), None
        while len(now) > 1:
            best = max(((self.score[self.usable[a + b]], -k) for k, (a, b) in enumerate(zip(now, now[1:], strict=False)) if a + b in self.usable), default=None)
            if best is None:
                return None
            k = -best[1]
            last = now[k], now[k + 1]
            now[k : k + 2] = [now[k] + now[k + 1]]
        return tuple(self.usable.get(x, len(self.text)) for x in last)

    def _fit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the merges leave the piece b after the piece a, for arrays of pairs."""
        code = a * (self.n + 1) + b
        slot = ((code.astype(np.uint64) * MIX) >> np.uint64(64 - CACHE)).astype(np.int64)
        if len(miss := np.flatnonzero(self.pair_key[slot] != code)):
            new, first = np.unique(code[miss], return_index=True)
            x, y, at = a[miss][first], b[miss][first], np.arange(len(new))
            limit, fits = np.full(len(new), np.iinfo(np.int64).max), np.ones(len(new), bool)
            while len(at):
                pair = x * (self.n + 1) + y
                k = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
                bad = (self.pairs[k] == pair) & (self.pair_order[k] < limit)
                fits[at[bad]] = False
                ox, oy = self.order[x], self.order[y]
                go = ~bad & ((ox >= 0) | (oy >= 0))
                x, y, at, ox, oy = x[go], y[go], at[go], ox[go], oy[go]
                first_side = ox > oy
                limit = np.where(first_side, ox, oy + 1)
                x, y = np.where(first_side, self.right[x], x), np.where(first_side, y, self.left[y])
            where = np.searchsorted(new, code[miss])
            out = np.empty(len(code), bool)
            hit = np.ones(len(code), bool)
            hit[miss] = False
            out[hit] = self.pair_fits[slot[hit]]
            out[miss] = fits[where]
            s = slot[miss][first]
            self.pair_key[s], self.pair_fits[s] = new, fits
            # Where two new pairs share a slot, key and answer must be of one pair.
            wrong = self.pair_key[s] != new
            if wrong.any():
                last = dict(zip(s.tolist(), range(len(s)), strict=True))
                k = np.fromiter(last.values(), np.int64)
                self.pair_key[s[k]], self.pair_fits[s[k]] = new[k], fits[k]
            return out
        return self.pair_fits[slot]

    def _paths(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words of one length, one after the other, and how many each has."""
        size, w = len(words[0]), len(words)
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(w, size).astype(np.uint64)
        h, power = np.zeros((w, size + 1), np.uint64), np.uint64(1)
        for j in range(size):
            h[:, j + 1] = h[:, j] * np.uint64(BASE) + points[:, j] + np.uint64(1)
        longest = min(self.longest, size)
        found = np.full((longest + 1, w, size), -1, np.int32)
        with np.errstate(over="ignore"):
            for n in range(1, longest + 1):
                power = power * np.uint64(BASE)
                sub = h[:, n:] - h[:, : size + 1 - n] * power
                r, c = np.nonzero(self.maybe[(sub * MIX) >> np.uint64(64 - FILTER)])
                probe = sub[r, c]
                k = np.minimum(np.searchsorted(self.keys, probe), len(self.keys) - 1)
                ok = self.keys[k] == probe
                found[n, r[ok], c[ok]] = self.key_ids[k[ok]]
        found[1][found[1] < 0] = self.n
        last, back = np.full((w, size + 1), -1, np.int64), np.zeros((w, size + 1), np.int16)
        best = np.zeros((w, size + 1)) if self.unigram else None
        scores = np.append(np.array(self.score), min(self.score) - 10.0) if self.unigram else None
        for j in range(1, size + 1):
            lengths = np.arange(1, min(j, longest) + 1)
            ends = found[lengths, :, j - lengths]
            n, r = np.nonzero(ends >= 0)
            piece, n = ends[n, r].astype(np.int64), n + 1
            if self.unigram:
                value = np.full((len(lengths), w), -np.inf)
                value[n - 1, r] = best[r, j - n] + scores[piece]
                top = value.argmax(0)
                rows = np.arange(w)
                best[:, j], back[:, j], last[:, j] = value[top, rows], top + 1, ends[top, rows]
                continue
            fits = np.ones(len(r), bool)
            inside = np.flatnonzero(n < j)
            fits[inside] = self._fit(last[r[inside], j - n[inside]], piece[inside])
            back[r[fits], j], last[r[fits], j] = n[fits], piece[fits]
        at, out, rows = np.full(w, size), [], np.arange(w)
        while (at > 0).any():
            ids = last[rows, at]  # for a character that no piece has, n + 1 + its code point
            ids = np.where(ids == self.n, self.n + 1 + points[rows, at - 1].astype(np.int64), ids)
            out.append(np.where(at > 0, ids, -1))
            at = at - np.where(at > 0, back[rows, at], 0)
        made = np.stack(out[::-1], 1)
        return self._spelt(made[made >= 0], (made >= 0).sum(1))

    def _spelt(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters that no piece has become the ids of their UTF-8 bytes, or the unknown id."""
        other = ids > self.n
        if not other.any():
            return ids, sizes
        if not self.byte:
            return np.where(other, self.unk, ids), sizes
        point = np.where(other, ids - self.n - 1, 0)
        count = 1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000)
        ends = np.cumsum(count)
        nth = np.arange(ends[-1]) - np.repeat(ends - count, count)
        long, left, point, other = np.repeat(count, count), np.repeat(count, count) - 1 - nth, np.repeat(point, count), np.repeat(other, count)
        lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[long]
        byte = np.where(nth == 0, lead | point >> 6 * left, 0x80 | point >> 6 * left & 0x3F)
        table = np.array([self.byte[b] for b in range(256)])
        last = np.cumsum(sizes) - 1
        return np.where(other, table[byte & 0xFF], np.repeat(ids, count)), np.diff(ends[last], prepend=0)

    def _cut(self, word: str) -> list[str]:
        if len(word) <= LONG:
            return [word]
        out, begin = [], 0
        for i in range(1, len(word)):
            if word[i - 1 : i + 1] not in self.inner:
                out.append(word[begin:i])
                begin = i
        return [*out, word[begin:]]

    def _learn(self, words: list[str]) -> None:
        """Remember the ids of new words, each of which stands after a space."""
        by: dict[int, list[str]] = {}
        flat, sizes, begin = [self.flat], [], len(self.flat)
        for w in words:
            by.setdefault(min(len(w), LONG), []).append(w)
        for size, group in by.items():
            if size == LONG:
                cut = [self._cut(SPACE + w) for w in group]
                known: dict[str, np.ndarray] = {}
                for length, parts in groupby(sorted({p for c in cut for p in c}, key=len), len):
                    parts, step = list(parts), max(1, STEP // length)
                    for k in range(0, len(parts), step):
                        ids, n = self._paths(parts[k : k + step])
                        known.update(zip(parts[k : k + step], np.split(ids, np.cumsum(n)[:-1]), strict=True))
                got = [np.concatenate([known[p] for p in c]) for c in cut]
                flat += got
                sizes.append(np.array([len(g) for g in got], np.int64))
            else:
                step = STEP // (size + 1)
                for k in range(0, len(group), step):
                    ids, n = self._paths([SPACE + w for w in group[k : k + step]])
                    flat.append(ids)
                    sizes.append(n)
            self.words.update(zip(group, range(len(self.words), len(self.words) + len(group)), strict=True))
        sizes = np.concatenate(sizes)
        self.flat = np.concatenate(flat).astype(np.int32)
        self.starts = np.concatenate([self.starts, begin + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])

    def _run(self, count: int) -> list[int]:
        """The ids of so many spaces with no word after them, by merges: leftmost first, scores being equal."""
        if self.unigram:
            return self._paths([SPACE * count])[0].tolist()
        best = {len(p): self.score[i] for p, i in self.spaces.items()}
        most, now = max(best, default=1), [1] * count
        if count > 2 * most and len(full := self._run(most)) == 1:  # nothing is longer, so it stays as it is
            return full * (count // most - 1) + self._run(most + count % most)
        while True:
            found = max(((best[a + b], -k) for k, (a, b) in enumerate(zip(now, now[1:], strict=False)) if a + b in best), default=None)
            if found is None:
                break
            k = -found[1]
            now[k : k + 2] = [now[k] + now[k + 1]]
        return [self.spaces.get(SPACE * n, self.usable.get(SPACE, self.unk)) for n in now]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        split = [t.replace(SPACE, " ").split(" ") if t else [] for t in texts]
        if not self.dummy:
            raise ValueError("models without a dummy prefix are not supported")
        new = set().union(*split) - self.words.keys()
        if len(self.words) + len(new) > MOST_WORDS:
            self.forget()
            new = set().union(*split) - {""}
        if new:
            self._learn(list(new))
        lone, out = self.usable.get(SPACE, -1), []
        for parts in split:
            at = np.fromiter(map(self.words.__getitem__, parts), np.int64, len(parts))
            starts, sizes = self.starts[at], self.sizes[at]
            ends = np.cumsum(sizes)
            ids = self.flat[np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]
            if len(gaps := np.flatnonzero(at == 0)):
                ids = self._with_runs(at, gaps, ids, ends, sizes, lone)
            out.append(ids)
        return out

    def _with_runs(self, at, gaps, ids, ends, sizes, lone) -> np.ndarray:
        """Put in the spaces that have no word; a last one may be taken from the word that follows."""
        got, begin, runs = [], 0, {}
        for run in np.split(gaps, np.flatnonzero(np.diff(gaps) > 1) + 1):
            follows = run[-1] + 1
            place = int(ends[run[0]])
            got.append(ids[begin:place])
            begin, count = place, len(run)
            if follows < len(at) and ids[place] == lone:
                begin, count = place + 1, count + 1
            if count not in runs:
                runs[count] = np.array(self._run(count), np.int32)
            got.append(runs[count])
        return np.concatenate([*got, ids[begin:]])

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        """The text of each list of ids, without the space that encoding put first."""
        if not ids:
            return []
        flat = np.concatenate(ids).astype(np.int64)
        sizes = self.bytes_at[flat + 1] - self.bytes_at[flat]
        ends = np.cumsum(sizes)
        held = self.bytes[np.repeat(self.bytes_at[flat] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
        cut = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum([len(i) for i in ids])])]
        texts = [held[a:b].decode("utf-8", "replace") for a, b in zip(cut[:-1], cut[1:], strict=True)]
        return [t[1:] if self.dummy and t[:1] == " " else t for t in texts]


def encode(documents: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, token_ids, round_trip): one row for each row of the input.

    round_trip says that decoding gives the whole text again; it does but for a literal U+2581, which
    the format holds to be a space.  Null texts are encoded like empty ones, as no tokens; repeated rows
    are each encoded, and an empty table gives an empty result.  Where two encodings have one score, the
    longer last piece wins (unigram) or the merge further left (BPE).  Texts are encoded whole; a word of
    many letters is gone through letter by letter, some 20 microseconds each.  The model
    is read on the driver; workers get its pieces, whose number is the model's.
    """
    tune(documents.sparkSession)
    pieces = Pieces(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in by_size(batch, "text", AT_ONCE):
                texts = [(t or b"").decode("utf-8", "replace") for t in some.column("text").cast(pa.binary()).to_pylist()]
                ids = pieces.encode(texts)
                back = [a == b for k in range(0, len(ids), DECODED) for a, b in zip(pieces.decode(ids[k : k + DECODED]), texts[k : k + DECODED], strict=True)]
                offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
                listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids).astype(np.int32)))
                yield pa.RecordBatch.from_pydict({"id": some.column("id"), "n_tokens": pa.array(np.diff(offsets).astype(np.int64)), "token_ids": listed, "round_trip": pa.array(back, pa.bool_())})
        pieces.forget()
        give_back()

    rows = pick(documents, id=id_col, text=text_col)
    return rows.select("id", "text").mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_tokens long, token_ids array<int>, round_trip boolean")


def decode(encoded: DataFrame, model: str = MODEL, id_col: str = "id", tokens_col: str = "token_ids") -> DataFrame:
    """(id, text) of rows with token ids.  A null or empty list is an empty text, ids that the model
    lacks and null ids are left out, bytes that aren't UTF-8 become U+FFFD."""
    tune(encoded.sparkSession)
    pieces = Pieces(model)

    def run(batch):
        ids = [np.array([i for i in t or () if i is not None and 0 <= i < pieces.n], np.int64) for t in batch["ids"].to_pylist()]
        return {"id": batch["id"], "text": pa.array(pieces.decode(ids), pa.string())}

    rows = pick(encoded, id=id_col, ids=tokens_col)
    return map_arrow(rows, f"id {rows.schema['id'].dataType.simpleString()}, text string", run)


def op2_sentencepiece(spark, sf_dir: str) -> DataFrame:
    out = encode(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.withColumnRenamed("id", "doc_id")
