"""SentencePiece encoding by sampling, and lossless decoding.

A text's pieces form a lattice: an edge for each run of characters that is a piece, and for a character that is no piece
of its own an edge of its UTF-8 bytes as byte pieces. A segmentation has the probability of the product of its edges' weights,
normalised. It is drawn by forward filtering (sums of weights of all ways to reach each position) and backward
sampling (from the end, each last edge in proportion to its share of that sum). Random numbers are a hash of (seed, row key,
unit number, step), so a row gets the same segmentation on every run and in every partition.

The vocabulary's scores are negative merge ranks. A piece of rank r weighs (r + 2) ** -alpha with a
Zipf-like alpha, so frequent pieces and segmentations into few pieces are likelier.

No piece of the vocabulary holds a space mark after another character, nor a character that has no piece (checked when the
model is read), so a text's lattice falls into units: spaces with the word after them, and characters without a piece. Units
are drawn independently and equal units share their forward sums, all units of a chunk in one vectorised
pass; that is the same distribution as one lattice over the text. Units over ``LONG`` characters are done one by one.

A space is the mark U+2581 and a U+2581 of the text itself goes as bytes, no space is put before a text and nothing is normalised:
decoding gives back every text, byte for byte. A null text has null pieces; an empty one has none. Keys that aren't whole numbers count by their hash; rows with a null key
draw as key 0, equal rows draw equally.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm.tokens import chunks, mix

ALPHA, SEED = 1.0, 0
LONG = 48
CHUNK = 1 << 21
FILTER_BITS = 17
#: Distinct units in one vectorised pass.
DISTINCT = 8_000
_U = np.uint64
_MARK = 0x2581


class Pieces:
    """The vocabulary as tables: piece hashes by length, weights, bytes of each piece."""

    def __init__(self, model: bytes, alpha: float):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.vocab_size()
        self.byte_ids = np.full(256, -1, np.int32)
        by_length: dict[int, list[tuple[int, int]]] = {}
        content = [b""] * n
        self.weight = np.zeros(n)
        singles = set()
        for i in range(n):
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                continue
            piece = sp.id_to_piece(i)
            self.weight[i] = (max(0.0, -sp.get_score(i)) + 2.0) ** -alpha
            if sp.is_byte(i):
                b = int(piece[3:5], 16)
                self.byte_ids[b] = i
                content[i] = bytes([b])
                continue
            if piece.strip("▁") and "▁" in piece[1:]:
                raise ValueError(f"a piece has a space mark inside: {piece!r}")
            content[i] = piece.replace("▁", " ").encode()
            codes = np.array([[ord(x) for x in piece]], np.int64)
            by_length.setdefault(len(piece), []).append((int(self._hash(codes)[0]), i))
            if len(piece) == 1:
                singles.add(piece)
        if (self.byte_ids < 0).any():
            raise ValueError("the model has no byte pieces, so it can't be lossless")
        for length, items in by_length.items():
            if length > 1 and any(c not in singles for _, i in items for c in sp.id_to_piece(i)):
                raise ValueError("a piece has a character that is no piece")
        self.lengths = sorted(by_length)
        self.tables = {}
        for length, items in by_length.items():
            items.sort()
            h = np.array([x for x, _ in items], np.uint64)
            assert len(np.unique(h)) == len(h)
            # Most runs of characters are no piece: a table of the hashes' first bits says so without a search.
            seen = np.zeros(1 << FILTER_BITS, bool)
            seen[h >> _U(64 - FILTER_BITS)] = True
            self.tables[length] = (h, np.array([i for _, i in items], np.int32), seen)
        self.single = np.zeros(0x110000, bool)
        self.single[[ord(x) for x in singles]] = True
        self.single[[0x20, _MARK]] = [("▁" in singles), False]
        self.starts = np.r_[0, np.cumsum([len(c) for c in content])]
        self.content = np.frombuffer(b"".join(content), np.uint8)

    @staticmethod
    def _hash(codes: np.ndarray) -> np.ndarray:
        """Of rows of code points."""
        with np.errstate(over="ignore"):
            h = np.zeros(len(codes), np.uint64)
            for k in range(codes.shape[1]):
                h = h * _U(0x9E3779B97F4A7C15) + mix(codes[:, k].astype(np.uint64) + _U(1))
            return h

    def lookup(self, length: int, h: np.ndarray) -> np.ndarray:
        """Piece ids, -1 where there is none."""
        keys, ids, seen = self.tables[length]
        out = np.full(len(h), -1, np.int32)
        some = np.flatnonzero(seen[h >> _U(64 - FILTER_BITS)])
        own = h[some]
        at = np.searchsorted(keys, own)
        at[at == len(keys)] = 0
        out[some] = np.where(keys[at] == own, ids[at], -1)
        return out


@lru_cache(maxsize=2)
def pieces(model: bytes, alpha: float = ALPHA) -> Pieces:
    return Pieces(model, alpha)


def _shipped(spark: SparkSession, path: str):
    """The model file's bytes, read by the driver and broadcast (a file of some hundred KB): workers need no such path."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _uniform(key: np.ndarray, unit: np.ndarray, step: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(mix(key + unit * _U(0x9E3779B97F4A7C15)) + _U(step)) >> _U(11)) * 2.0**-53


def _units(codes: np.ndarray, texts: np.ndarray, p: Pieces) -> np.ndarray:
    """Where units start: at texts, at the first space of a run, at and after characters without a piece."""
    plain = p.single[codes]
    space = codes == 0x20
    start = np.ones(len(codes), bool)
    start[1:] = (space[1:] & ~space[:-1]) | ~plain[1:] | ~plain[:-1]
    start[texts[texts < len(codes)]] = True
    return np.flatnonzero(start)


def encode_chunk(codes: np.ndarray, texts: np.ndarray, keys: np.ndarray, p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts in turn, and where each text's begin (and the total).

    codes: code points of all texts; texts: offsets of the texts in them (and the total); keys: uint64 row keys.
    """
    if not len(codes):
        return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
    start = _units(codes, texts, p)
    size = np.diff(np.r_[start, len(codes)])
    text = np.searchsorted(texts, start, "right") - 1
    number = (np.arange(len(start)) - np.searchsorted(start, texts[text])).astype(np.uint64)
    key = keys[text]
    # Pieces begin at characters of their own; a character without a piece gives as many as it has bytes.
    piece = np.full(len(codes), -1, np.int32)
    count = np.zeros(len(codes), np.int64)
    bare = ~p.single[codes[start]]
    marked = np.where(codes == 0x20, _MARK, codes)
    for lo, hi in ((1, 4), (5, 8), (9, 12), (13, 20), (21, LONG)):
        at = np.flatnonzero(~bare & (size >= lo) & (size <= hi))
        if len(at):
            for x, y, z in _draw(marked, start[at], size[at], key[at], number[at], hi, p):
                piece[start[at[x]] + y] = z
    for u in np.flatnonzero(~bare & (size > LONG)):
        places, ids = _draw_long(marked[start[u] : start[u] + size[u]], key[u : u + 1], number[u : u + 1], p)
        piece[start[u] + places] = ids
    count[piece >= 0] = 1
    own = start[bare]
    raw = [chr(c).encode("utf-8", "surrogatepass") for c in codes[own]]
    count[own] = [len(x) for x in raw]
    first = np.r_[0, np.cumsum(count)]
    ids = np.empty(first[-1], np.int32)
    ids[first[:-1][piece >= 0]] = piece[piece >= 0]
    if len(own):
        n = count[own]
        ids[np.arange(n.sum()) + np.repeat(first[own] - (np.cumsum(n) - n), n)] = p.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
    return ids, first[texts]


def _edges(grid: np.ndarray, size: np.ndarray, p: Pieces) -> tuple[np.ndarray, list[int]]:
    """ids[k, i, j]: the piece of length lengths[k] that ends at character j of unit i (1-based), or -1."""
    n, width = grid.shape
    lengths = [x for x in p.lengths if x <= width]
    ids = np.full((len(lengths), n, width + 1), -1, np.int32)
    with np.errstate(over="ignore"):
        mixed = mix(grid.astype(np.uint64) + _U(1))
        h = np.zeros((n, width), np.uint64)
        for length in range(1, (lengths or [0])[-1] + 1):
            span = width - length + 1
            h = h[:, :span] * _U(0x9E3779B97F4A7C15) + mixed[:, length - 1 :]
            if length in p.tables:
                found = p.lookup(length, h.ravel()).reshape(n, span)
                ends = np.arange(length, width + 1)
                ids[lengths.index(length), :, length:] = np.where(ends[None, :] <= size[:, None], found, -1)
    return ids, lengths


def _forward(ids: np.ndarray, lengths: list[int], p: Pieces) -> np.ndarray:
    """For each unit and position the cumulated sums of the edges that end there; the last is the sum of all ways to reach it."""
    kinds, n, ends = ids.shape
    w = np.where(ids >= 0, p.weight[ids], 0.0).transpose(2, 0, 1).copy()
    lens = np.array(lengths)
    alpha = np.zeros((ends, n))
    alpha[0] = 1
    share = np.zeros((n, ends, kinds))
    for j in range(1, ends):
        here = lens <= j
        ways = np.cumsum(alpha[j - lens[here]] * w[j, here], axis=0)
        alpha[j] = ways[-1]
        share[:, j, here] = ways.T
        share[:, j, ~here] = ways[-1][:, None]
    return share


def _draw(codes: np.ndarray, start: np.ndarray, size: np.ndarray, key: np.ndarray, number: np.ndarray, width: int, p: Pieces):
    """(unit index, start character, piece id) arrays of the drawn pieces, a part for each step."""
    pos = np.arange(width)
    grid = np.where(pos[None, :] < size[:, None], codes[np.minimum(start[:, None] + pos[None, :], len(codes) - 1)], 0).astype(np.int32)
    rows = np.ascontiguousarray(grid).view(np.dtype((np.void, grid.itemsize * width))).ravel()
    _, first, same = np.unique(rows, return_index=True, return_inverse=True)
    order = np.argsort(same, kind="stable")
    for lo in range(0, len(first), DISTINCT):
        a, b = np.searchsorted(same[order], [lo, lo + DISTINCT])
        live = order[a:b]
        own = first[lo : lo + DISTINCT]
        ids, lengths = _edges(grid[own], size[own], p)
        share = _forward(ids, lengths, p)
        lens = np.array(lengths)
        kind_of, left, k, m = same[live] - lo, size[live], key[live], number[live]
        step = 0
        while len(live):
            here = share[kind_of, left]
            u = _uniform(k, m, step) * here[:, -1]
            kind = np.minimum((here <= u[:, None]).sum(axis=1), len(lens) - 1)
            piece = ids[kind, kind_of, left]
            left = left - lens[kind]
            yield live, left, piece
            more = left > 0
            live, kind_of, left, k, m = live[more], kind_of[more], left[more], k[more], m[more]
            step += 1


def _draw_long(codes: np.ndarray, key: np.ndarray, number: np.ndarray, p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Start characters and ids of the pieces of one unit of any length. Its sums are scaled back now and then, each with the power it was scaled by."""
    n = len(codes)
    end, length, ids = [], [], []
    for x in p.lengths:
        if x <= n:
            found = p.lookup(x, p._hash(np.lib.stride_tricks.sliding_window_view(codes, x)))
            at = np.flatnonzero(found >= 0)
            end.append(at + x)
            length.append(np.full(len(at), x))
            ids.append(found[at])
    end, length, ids = np.concatenate(end), np.concatenate(length), np.concatenate(ids)
    order = np.argsort(end, kind="stable")
    first = np.searchsorted(end[order], np.arange(n + 2)).tolist()
    weight = p.weight[ids[order]].tolist()
    length, ids = length[order].tolist(), ids[order].tolist()
    alpha, power = [1.0], [0]

    def ways(j: int) -> list[float]:
        """For the edges that end at j, sums of the ways that end with them and those before, on the scale of position j - 1."""
        scale, total, out = power[j - 1], 0.0, []
        for e in range(first[j], first[j + 1]):
            i = j - length[e]
            x = alpha[i] * weight[e]
            total += x if power[i] == scale else math.ldexp(x, power[i] - scale)
            out.append(total)
        return out

    for j in range(1, n + 1):
        total, scale = ways(j)[-1], power[j - 1]
        if total < 2.0**-500:
            total, scale = total * 2.0**500, scale - 500
        alpha.append(total)
        power.append(scale)
    places, out, j, step = [], [], n, 0
    while j > 0:
        shares = ways(j)
        u = float(_uniform(key, number, step)[0]) * shares[-1]
        e = first[j] + min(bisect_right(shares, u), len(shares) - 1)
        out.append(ids[e])
        j -= length[e]
        places.append(j)
        step += 1
    return np.array(places), np.array(out, np.int32)


def decode_ids(ids: np.ndarray, first: np.ndarray, p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each begins (and the total)."""
    n = p.starts[ids + 1] - p.starts[ids]
    ends = np.cumsum(n)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(p.starts[ids] - (ends - n), n)
    return p.content[at], np.r_[0, ends][first]


def _code_points(c) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a chunk and the texts' offsets in them."""
    codes = np.frombuffer(c.data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.int64)
    heads = np.r_[0, np.cumsum((c.data & 0xC0) != 0x80)]
    return codes, heads[c.offsets]


def _strings(data: np.ndarray, at: np.ndarray, null: pa.Array | None) -> pa.Array:
    text = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))).cast(pa.string())
    return text if null is None else pa.compute.if_else(null, pa.scalar(None, pa.string()), text)


def encode(df: DataFrame, model: str, key_col: str = "doc_id", text_col: str = "text", alpha: float = ALPHA, seed: int = SEED, decoded_col: str | None = None) -> DataFrame:
    """``df`` with one more column, ``pieces`` (array of ids), and the texts decoded from them in ``decoded_col``, if named; columns of these names are replaced."""
    new = ["pieces", *([decoded_col] if decoded_col else [])]
    cols = [c for c in df.columns if c not in new]
    k = cols.index(text_col)
    shipped = _shipped(df.sparkSession, model)

    def run(batches):
        p = pieces(shipped.value, alpha)
        for b in batches:
            key = b.column(len(cols)).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            with np.errstate(over="ignore"):
                key = mix(key + _U(seed) * _U(0xD1B54A32D192ED03))
            text = b.column(k)
            lo = 0
            for c in chunks(text, CHUNK):
                codes, texts = _code_points(c)
                ids, first = encode_chunk(codes, texts, key[c.lo : c.hi], p)
                part = b.slice(lo, c.hi - lo)
                lo = c.hi
                null = text.slice(c.lo, c.hi - c.lo).is_null() if text.null_count else None
                out = [pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids), mask=null)]
                if decoded_col:
                    out.append(_strings(*decode_ids(ids, first, p), null))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(cols)], *out], names=[*cols, *new])

    own = "_draw"
    while own in cols:
        own += "_"
    number = F.col(key_col).cast("long") if df.schema[key_col].dataType.typeName() in ("byte", "short", "integer", "long") else F.xxhash64(key_col)
    src = df.select(*cols, F.when(F.col(key_col).isNotNull(), number).otherwise(F.lit(0)).cast("long").alias(own))
    kinds = {"pieces": "array<int>", decoded_col: "string"}
    schema = df.select(cols).withColumns({c: F.lit(None).cast(kinds[c]) for c in new}).schema
    return src.mapInArrow(run, schema)


def decode(df: DataFrame, model: str, pieces_col: str = "pieces", out_col: str = "decoded") -> DataFrame:
    """``df`` with the texts of its pieces in ``out_col``."""
    cols = [c for c in df.columns if c != out_col]
    k = cols.index(pieces_col)
    shipped = _shipped(df.sparkSession, model)

    def run(batches):
        p = pieces(shipped.value)
        for b in batches:
            for lo in range(0, b.num_rows, 200):
                part = b.slice(lo, 200)
                lists = part.column(k)
                n = np.asarray(lists.value_lengths().fill_null(0), dtype=np.int64)
                ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                text = _strings(*decode_ids(ids, np.r_[0, np.cumsum(n)], p), lists.is_null() if lists.null_count else None)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(cols)], text], names=[*cols, out_col])

    schema = df.select(cols).withColumn(out_col, F.lit(None).cast("string")).schema
    return df.select(cols).mapInArrow(run, schema)
