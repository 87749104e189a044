"""Byte-level BPE: encoding by merge ranks and decoding.

A text is split by a pattern; each distinct pre-token of a run of texts is encoded once. All pre-tokens that are new lie one after the other in one
doubly linked list of tokens over their bytes (no links between pre-tokens), and one queue holds the places of all pairs that a rank merges: a bucket of
list positions for each rank, under three levels of 64-bit words whose first set bits give the lowest rank in use. Ranks of one
pre-token don't depend on others, so the queue takes a whole bucket at once: entries whose pair has changed are stale and skipped, of overlapping pairs
the left one counts, and the merges of a bucket are made in one vectorised step, which makes a pre-token of a million bytes as cheap as a
million bytes of short ones. Where a merge of a bucket gives a pair of a *lower* rank (vocabularies have some), that pair comes before the
pre-token's other pairs of the bucket: the merges up to it are made and the rest goes back.

A pre-token that is a token as a whole is that token, as in the usual implementations. Encoded pre-tokens are kept by a worker for later texts, up to
``KEPT`` of them. A null text has null ids and a null decoded value, an empty one has none and nothing. Equal rows get equal
ids; extra columns stay, those with the names of the new ones are replaced. A text of any length is taken whole: it's cut between a character that is no space
and a space, where no match of the pattern goes on (a pattern given instead must keep to that). One pre-token's arrays take some 40 bytes a byte of it.
"""

from __future__ import annotations

import base64
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pre-tokens that a worker keeps, bytes of text that it takes at once, and characters of one text.
KEPT = 400_000
RUN_BYTES = 12 << 20
LONG = 4 << 20
_NONE = np.iinfo(np.int32).max
_CUT = regex.compile(r"\S\s")


class RankQueue:
    """Buckets of positions by rank; the lowest rank with a bucket comes first."""

    def __init__(self, ranks: int):
        self.buckets: dict[int, list[np.ndarray]] = {}
        self.low = [0] * ((ranks >> 6) + 1)
        self.mid = [0] * ((ranks >> 12) + 1)
        self.top = 0

    def push(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = np.flatnonzero(np.diff(ranks)) + 1
        for r, part in zip(ranks[np.r_[0, cuts]].tolist() if len(ranks) else (), np.split(positions, cuts), strict=False):
            self.put(r, part)

    def put(self, r: int, positions: np.ndarray) -> None:
        own = self.buckets.get(r)
        if own is not None:
            own.append(positions)
            return
        self.buckets[r] = [positions]
        self.low[r >> 6] |= 1 << (r & 63)
        self.mid[r >> 12] |= 1 << ((r >> 6) & 63)
        self.top |= 1 << (r >> 12)

    def pop(self) -> tuple[int, np.ndarray] | None:
        """The lowest rank and its positions, in order and each once."""
        if not self.top:
            return None
        a = (self.top & -self.top).bit_length() - 1
        b = a << 6 | (self.mid[a] & -self.mid[a]).bit_length() - 1
        r = b << 6 | (self.low[b] & -self.low[b]).bit_length() - 1
        self.low[b] &= self.low[b] - 1
        if not self.low[b]:
            self.mid[a] &= self.mid[a] - 1
            if not self.mid[a]:
                self.top &= self.top - 1
        parts = self.buckets.pop(r)
        if len(parts) == 1:
            return r, parts[0]
        p = np.sort(np.concatenate(parts), kind="stable")
        return r, p[np.r_[True, p[1:] != p[:-1]]]


class Vocabulary:
    """Tokens by rank, and the rank that each pair of tokens merges to."""

    def __init__(self, file: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file.splitlines() if line)}
        n = max(self.ranks.values()) + 1
        if any(bytes([i]) not in self.ranks for i in range(256)):
            raise ValueError("the vocabulary lacks a byte, so it can't encode every text")
        if n >= 1 << 20:
            raise ValueError("a vocabulary of 2**20 ranks or more")
        self.n = n
        self.bytes = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        content = [b""] * n
        keys, merged = [], []
        for token, r in self.ranks.items():
            content[r] = token
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if a is not None and b is not None:
                    keys.append(a << 20 | b)
                    merged.append(r)
        order = np.argsort(np.array(keys, np.int64))
        self.keys, self.merged = np.r_[np.array(keys, np.int64)[order], np.iinfo(np.int64).max], np.r_[np.array(merged, np.int32)[order], _NONE].astype(np.int32)
        # A token that is part of one of lower rank may bring that one up.
        left, right = self.keys[:-1] >> 20, self.keys[:-1] & ((1 << 20) - 1)
        self.backward = np.zeros(n, bool)
        self.backward[left[left > self.merged[:-1]]] = True
        self.backward[right[right > self.merged[:-1]]] = True
        self.content = np.frombuffer(b"".join(content), np.uint8)
        self.starts = np.r_[0, np.cumsum([len(c) for c in content])]

    def merge_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 20 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.merged[at], _NONE)

    def merge(self, data: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of the bytes, and the piece of each; ``piece`` is the number of the piece that each byte belongs to, in order."""
        n = len(data)
        end = self.n  # the token beside a piece, which no pair has
        token = np.r_[self.bytes[data], end]
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        edge = np.flatnonzero(np.diff(piece))
        after[edge] = n
        before[edge + 1] = n
        before[:1] = n
        rank = np.full(n + 1, _NONE, np.int32)
        rank[:n] = self.merge_ranks(token[:n], token[after[:n]])
        queue = RankQueue(self.n)
        some = np.flatnonzero(rank != _NONE)
        queue.push(rank[some], some)
        while (lowest := queue.pop()) is not None:
            r, p = lowest
            p = p[rank[p] == r]
            if not len(p):
                continue
            right = after[p]
            if len(p) > 1 and (linked := right[:-1] == p[1:]).any():
                # Of pairs that overlap one after the other, each second one falls.
                opens = np.flatnonzero(np.r_[True, ~linked])
                even = (np.arange(len(p)) - np.repeat(opens, np.diff(np.r_[opens, len(p)]))) % 2 == 0
                c, right = p[even], right[even]
            else:
                c = p
            beyond = after[right]
            if self.backward[r]:
                near = token[before[c]]
                near[1:][beyond[:-1] == c[1:]] = r
                own = np.full(len(c), r)
                low = (self.merge_ranks(near, own) < r) | (self.merge_ranks(own, token[beyond]) < r)
                if low.any():
                    at = np.flatnonzero(low)
                    pieces, first = np.unique(piece[c[at]], return_index=True)
                    limit = np.full(len(c), n)
                    where = np.minimum(np.searchsorted(pieces, piece[c]), len(pieces) - 1)
                    held = pieces[where] == piece[c]
                    limit[held] = c[at[first]][where[held]]
                    keep = c <= limit
                    if not keep.all():
                        queue.put(r, c[~keep])
                        back = np.setdiff1d(p, c, assume_unique=True)
                        if len(back):
                            queue.put(r, back)
                        c, right, beyond = c[keep], right[keep], beyond[keep]
            token[c] = r
            after[c] = beyond
            before[beyond] = c
            rank[right] = _NONE
            token[right] = -1
            fresh = np.concatenate([before[c], c])
            fresh = fresh[fresh < n]
            new = self.merge_ranks(token[fresh], token[after[fresh]])
            rank[fresh] = new
            some = new != _NONE
            if some.any():
                fresh, new = fresh[some], new[some]
                order = np.argsort(fresh, kind="stable")
                fresh, new = fresh[order], new[order]
                once = np.r_[True, fresh[1:] != fresh[:-1]]
                queue.push(new[once], fresh[once])
        heads = np.flatnonzero(token[:n] >= 0)
        return token[heads].astype(np.int32), piece[heads]

    def decode(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts in turn, and where each begins (and the total)."""
        size = self.starts[ids + 1] - self.starts[ids]
        return self.content[spread(self.starts[ids], size)], np.r_[0, np.cumsum(size)][first]


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0] .. start[0] + size[0] - 1, start[1] .. and so on."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)


@lru_cache(maxsize=2)
def vocabulary(file: bytes) -> Vocabulary:
    return Vocabulary(file)


class Encoder:
    """Encodes texts, keeping the ids of pre-tokens that it has met."""

    def __init__(self, vocab: Vocabulary, pattern: str):
        self.vocab, self.pattern = vocab, regex.compile(pattern)
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.ids, self.first = np.empty(0, np.int32), np.zeros(1, np.int64)

    def _learn(self) -> None:
        """Encodes the pre-tokens that have no ids yet."""
        known = len(self.first) - 1
        new = [t.encode() for t in list(self.number)[known:]]
        whole = np.array([self.vocab.ranks.get(t, -1) for t in new], np.int32)
        rest = np.flatnonzero(whole < 0)
        data = np.frombuffer(b"".join(new[i] for i in rest), np.uint8)
        ids, piece = self.vocab.merge(data, np.repeat(rest, [len(new[i]) for i in rest]))
        own = np.flatnonzero(whole >= 0)
        ids, piece = np.r_[ids, whole[own]], np.r_[piece, own]
        self.ids = np.r_[self.ids, ids[np.argsort(piece, kind="stable")]]
        self.first = np.r_[self.first, self.first[-1] + np.cumsum(np.bincount(piece, minlength=len(new)))]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in turn, and where each text's begin (and the total)."""
        if len(self.number) > KEPT:
            self.clear()
        split, number = self.pattern.findall, self.number.__getitem__
        numbers, count = [], np.zeros(len(texts) + 1, np.int64)
        for i, t in enumerate(texts):
            for part in _parts(t or ""):
                numbers.append(np.fromiter(map(number, split(part)), np.int32))
                count[i + 1] += len(numbers[-1])
        if len(self.number) >= len(self.first):
            self._learn()
        at = np.concatenate(numbers) if numbers else np.empty(0, np.int32)
        size = self.first[at + 1] - self.first[at]
        return self.ids[spread(self.first[at], size)], np.r_[0, np.cumsum(size)][np.cumsum(count)]


def _parts(text: str) -> Iterator[str]:
    lo = 0
    while len(text) - lo > LONG:
        cut = _CUT.search(text, lo + LONG)
        if not cut:
            break
        yield text[lo : cut.start() + 1]
        lo = cut.start() + 1
    yield text[lo:]


def _runs(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Consecutive rows of about RUN_BYTES together, one at least."""
    ends = np.cumsum(sizes)
    lo = 0
    while lo < len(sizes):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + RUN_BYTES, "right")))
        yield lo, hi
        lo = hi


@lru_cache(maxsize=2)
def encoder_of(file: bytes, pattern: str) -> Encoder:
    return Encoder(vocabulary(file), pattern)


def encode(df: DataFrame, ranks: str, pattern: str, text_col: str = "text", decoded_col: str | None = None) -> DataFrame:
    """``df`` with ``ids`` (array of ranks) by the rank file ``ranks`` and, if named, the bytes decoded from them in ``decoded_col``."""
    new = ["ids", *([decoded_col] if decoded_col else [])]
    cols = [c for c in df.columns if c not in new]
    k = cols.index(text_col)
    with open(ranks, "rb") as f:
        shipped = df.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file, some hundred KB

    def run(batches):
        encoder = encoder_of(shipped.value, pattern)
        vocab = encoder.vocab
        for b in batches:
            text = b.column(k)
            sizes = pa.compute.binary_length(text).fill_null(0).to_numpy().astype(np.int64)
            for lo, hi in _runs(sizes):
                part = b.slice(lo, hi - lo)
                null = part.column(k).is_null() if part.column(k).null_count else None
                ids, first = encoder.encode(part.column(k).to_pylist())
                out = [pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids), mask=null)]
                if decoded_col:
                    data, at = vocab.decode(ids, first)
                    out.append(_binary(data, at, null))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(cols)], *out], names=[*cols, *new])

    kinds = {"ids": "array<int>", decoded_col: "binary"}
    schema = df.select(*(F.col(f"`{c}`") for c in cols)).withColumns({c: F.lit(None).cast(kinds[c]) for c in new}).schema
    return df.select(*(F.col(f"`{c}`") for c in cols)).mapInArrow(run, schema)


def decode(df: DataFrame, ranks: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with the bytes of its ids in ``out_col``; null ids give null. An id outside the vocabulary is an error."""
    cols = [c for c in df.columns if c != out_col]
    k = cols.index(ids_col)
    with open(ranks, "rb") as f:
        shipped = df.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        vocab = vocabulary(shipped.value)
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                lists = part.column(k)
                n = np.asarray(lists.value_lengths().fill_null(0), dtype=np.int64)
                data, at = vocab.decode(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.r_[0, np.cumsum(n)])
                yield pa.RecordBatch.from_arrays([*part.columns[: len(cols)], _binary(data, at, lists.is_null() if lists.null_count else None)], names=[*cols, out_col])

    src = df.select(*(F.col(f"`{c}`") for c in cols))
    return src.mapInArrow(run, src.withColumn(out_col, F.lit(None).cast("binary")).schema)


def _binary(data: np.ndarray, at: np.ndarray, null: pa.Array | None) -> pa.Array:
    out = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())
    return out if null is None else pa.compute.if_else(null, pa.scalar(None, pa.binary()), out)
