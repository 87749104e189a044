"""Language-model scoring by a hashed maximum-entropy model with a class-factored softmax.

Slots are the end of a text, one for all other words, and the most frequent words; SIDE slots by frequency make a class.
P(slot) = P(class | features) P(slot in class | features, class), both softmaxes of sums of weight rows for the word before (with
the word itself a bigram) and, within a class, the word two before (a skip). Features are of the words themselves: a word without a slot has its
own hash in them, and weight rows grow with the number of distinct words between ROWS[0] and ROWS[1] (a task sends all its rows).

The words of the other slot are factored in the same way: the first bits of a word's hash name one of SIDE groups and one of SIDE parts of
it, with softmaxes over rows of the word before and, for parts, the skip; the words of one part share it by (c + 0.5). An unseen word
has 0.5 of the other slot's sum, so probabilities of all known words and one unseen word add up to 1.

* Counts: every training token; tasks combine words before the exchange, the counts are a written table.
* Training: ROUNDS rounds. Each takes another part of the training texts (by hash, together all of them). The gradient of
  the part's log-likelihood at the round's weights is, for each row and output, how often the output came less how often the model
  expected it. Tasks sum both, their sums are added up in two levels of groups of bounded size, and the weights take one step: STEP of
  the log of the ratio of both, damped by PRIOR expected cases (the exponentiated form of the gradient). Sums don't depend on how rows
  lie in tasks, so neither do scores, but for rounding (some 1e-6 of a score).
* Scoring: one pass in sparse batches. The words of a bounded count table (at most TABLE words, by a count threshold)
  are looked up there; all others leave their hashes, which meet the written counts in a join and come back as sums by text.

Words are told apart by 64-bit hashes. Null and empty texts are one end token; repeated rows count and are scored as often as they come. Rows with a null
id are scored; whether they're learnt from is for the caller's condition (null: no). Without training rows all counts are 0. Other columns aren't read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm.scratch import Scratch
from quillon.llm.tokens import SPACED, chunks, mix

SIDE = 32
BITS = 5
SLOTS = SIDE * SIDE
TABLE = 1 << 17
ROUNDS, STEP, PRIOR = 3, 0.7, 100.0
#: A weight's bound: sums of two and a bias stay far from what a float can't be the exponential of.
LARGEST = 12.0
#: Least and most rows of a part that is hashed.
ROWS = 1 << 13, 1 << 14
#: Rows of weights sent together, and tokens done together.
BLOCK, TILE = 512, 16384
#: Tokens whose sums are kept in floats before they're added to doubles.
FLUSH = 500_000
#: The hash that stands for the end of a text, and the slots of the end and of other words.
END = np.uint64(0xE0D0C0B0A0908071)
END_SLOT, OTHER = 0, 1
_U = np.uint64


class Parts:
    """First rows of the parts of the weight matrix, and its height, by the rows of a hashed part."""

    def __init__(self, rows: int):
        self.rows = rows
        own = SLOTS + rows
        sizes = {"prev": own, "class_bias": 1, "word_prev": 2 * rows, "word_skip": 2 * rows, "word_bias": SIDE, "group_prev": own, "group_bias": 1, "part_prev": rows, "part_skip": rows, "part_bias": SIDE}
        at = 0
        for name, n in sizes.items():
            setattr(self, name, at)
            at += n
        self.height = at

    @classmethod
    def of(cls, w: np.ndarray) -> Parts:
        return cls((len(w) - cls(0).height) // (cls(1).height - cls(0).height))


def _tokens(c) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes with an end after each text, and where each text begins (and the total)."""
    w = c.words(SPACED)
    first = w.first + np.arange(len(w.first))
    out = np.full(first[-1], END, np.uint64)
    inside = np.ones(first[-1], bool)
    inside[first[1:] - 1] = False
    out[inside] = c.hashes(w)
    return out, first


def _count_words(batches):
    parts, size = [], 0

    def merged():
        h, n = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return h, np.bincount(n, np.concatenate([p[1] for p in parts])).astype(np.int64)

    for b in batches:
        for c in chunks(b.column("text")):
            h, n = np.unique(_tokens(c)[0], return_counts=True)
            parts.append((h, n))
            size += len(h)
            if size > 1_000_000:
                parts = [merged()]
                size = len(parts[0][0])
                if size > 500_000:
                    yield _count_batch(*parts[0])
                    parts, size = [], 0
    if parts:
        yield _count_batch(*merged())


def _count_batch(h: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["word", "c"])


@dataclass
class Vocabulary:
    """words: sorted hashes of the count table; counts and slots (OTHER: none of its own) go with them. mass: by the first bits of a hash, the summed (c + 0.5) of the words in OTHER."""

    words: np.ndarray
    counts: np.ndarray
    slots: np.ndarray
    total: int
    distinct: int
    #: Summed (c + 0.5) of the words in OTHER, one unseen word included.
    other: float
    mass: np.ndarray = field(default_factory=lambda: np.zeros(SLOTS))

    @staticmethod
    def place(h: np.ndarray) -> np.ndarray:
        """Group * SIDE + part of each hash."""
        return (h >> _U(64 - 2 * BITS)).astype(np.int64)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slot and count of each hash; count -1 where the table doesn't have it."""
        if not len(self.words):
            return np.where(h == END, END_SLOT, OTHER), np.full(len(h), -1)
        at = np.searchsorted(self.words, h)
        at[at == len(self.words)] = 0
        hit = self.words[at] == h
        return np.where(hit, self.slots[at], np.where(h == END, END_SLOT, OTHER)), np.where(hit, self.counts[at], -1)


def build_vocabulary(counts: DataFrame) -> Vocabulary:
    sums = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    # A histogram of at most some hundred bins gives the least count with which the table keeps its bound.
    level = F.floor(F.log2("c") * 8)
    bins = sorted(((r["b"], r["n"]) for r in counts.groupBy(level.alias("b")).agg(F.count("*").alias("n")).collect()), reverse=True)
    took, least = 0, None
    for b, n in bins:
        if took + n > TABLE:
            break
        took, least = took + n, b
    got = counts.where(level >= least).toPandas() if least is not None else pd.DataFrame({"word": [], "c": []}, dtype="int64")
    h, c = got["word"].to_numpy().astype(np.int64).view(np.uint64), got["c"].to_numpy().astype(np.int64)
    order = np.argsort(h)
    h, c = h[order], c[order]
    rank = np.lexsort((h, -c))
    rank = rank[h[rank] != END][: SLOTS - 2]
    slots = np.full(len(h), OTHER)
    slots[rank] = np.arange(2, 2 + len(rank))
    slots[h == END] = END_SLOT
    n, v = sums["n"] or 0, sums["v"]
    inside = slots != OTHER
    rest = v - int(inside.sum())
    other = (n - int(c[inside].sum())) + 0.5 * (rest + 1)
    # At most SLOTS rows.
    twice = np.zeros(SLOTS, np.int64)
    sums = counts.groupBy(F.shiftrightunsigned("word", 64 - 2 * BITS).cast("int").alias("place")).agg(F.sum(2 * F.col("c") + 1).alias("n")).toArrow()
    twice[sums["place"].to_numpy()] = sums["n"].to_numpy()
    np.subtract.at(twice, Vocabulary.place(h[inside]), 2 * c[inside] + 1)
    return Vocabulary(h, c, slots, n, v, other, twice / 2)


def _logs(p: np.ndarray) -> np.ndarray:
    """Logs of shares along the last axis; what has none is as good as impossible."""
    return np.log(np.maximum(p / np.maximum(p.sum(axis=-1, keepdims=True), 1e-300), np.exp(-2 * LARGEST)))


def first_weights(voc: Vocabulary) -> np.ndarray:
    """Zero but for the biases, which give the frequencies."""
    parts = Parts(min(ROWS[1], max(ROWS[0], 1 << (max(voc.distinct - 1, 0) // 512).bit_length())))
    w = np.zeros((parts.height, SIDE), np.float32)
    p = np.full(SLOTS, 0.5)
    np.add.at(p, voc.slots[voc.slots != OTHER], voc.counts[voc.slots != OTHER])
    p[OTHER] = voc.other
    for grid, one, each in ((p.reshape(SIDE, SIDE), parts.class_bias, parts.word_bias), (voc.mass.reshape(SIDE, SIDE), parts.group_bias, parts.part_bias)):
        w[one] = _logs(grid.sum(axis=1))
        w[each : each + SIDE] = _logs(grid)
    return w


def _before(x: np.ndarray, first: np.ndarray, end) -> tuple[np.ndarray, np.ndarray]:
    """The values of the token before and of the one two before; before a text's first word stands the end."""
    prev = np.r_[np.array([end], x.dtype), x[:-1]]
    skip = np.r_[np.array([end, end], x.dtype), x[:-2]][: len(x)]
    heads = first[:-1]
    prev[heads] = end
    skip[heads] = end
    second = heads + 1
    skip[second[second < len(x)]] = end
    return prev, skip


@dataclass
class Stage:
    """One softmax for some tokens: weight rows (a row of the array for each feature, the bias last) and outputs."""

    rows: np.ndarray
    target: np.ndarray


def stages(parts: Parts, voc: Vocabulary, slots: np.ndarray, first: np.ndarray, words: np.ndarray) -> tuple[list[Stage], np.ndarray]:
    """Class and slot of all tokens, group and part of those in OTHER; and where those are."""
    own = np.where(slots == OTHER, SLOTS + (words & _U(parts.rows - 1)).astype(np.int64), slots)
    prev, _ = _before(own, first, END_SLOT)
    prev_word, skip_word = _before(words, first, END)
    cls = slots // SIDE
    at = np.flatnonzero(slots == OTHER)
    place = voc.place(words[at])
    group = place // SIDE

    def row(word: np.ndarray, salt: int, bits: int) -> np.ndarray:
        return (mix(word + _U(salt << 40)) & _U(bits - 1)).astype(np.int64)

    with np.errstate(over="ignore"):
        before, skipped = prev_word * _U(SIDE), skip_word * _U(SIDE)
        slot_rows = [parts.word_prev + row(before + cls.astype(np.uint64), 0, 2 * parts.rows), parts.word_skip + row(skipped + cls.astype(np.uint64), 1, 2 * parts.rows)]
        part_rows = [parts.part_prev + row(before[at] + group.astype(np.uint64), 2, parts.rows), parts.part_skip + row(skipped[at] + group.astype(np.uint64), 3, parts.rows)]
    same = lambda x, n: np.full(n, x)
    return [
        Stage(np.stack([parts.prev + prev, same(parts.class_bias, len(slots))]), cls),
        Stage(np.stack([*slot_rows, parts.word_bias + cls]), slots % SIDE),
        Stage(np.stack([parts.group_prev + prev[at], same(parts.group_bias, len(at))]), group),
        Stage(np.stack([*part_rows, parts.part_bias + group]), place % SIDE),
    ], at


def _tiles(w: np.ndarray, stage: Stage):
    """(slice, exponentials of the summed rows, their sums) for TILE tokens at a time; the arrays are used again."""
    n = len(stage.target)
    z, more = np.empty((min(TILE, n), SIDE), np.float32), np.empty((min(TILE, n), SIDE), np.float32)
    for lo in range(0, n, TILE):
        s = slice(lo, min(lo + TILE, n))
        m = s.stop - lo
        np.take(w, stage.rows[0, s], axis=0, out=z[:m], mode="clip")
        for r in stage.rows[1:]:
            np.take(w, r[s], axis=0, out=more[:m], mode="clip")
            z[:m] += more[:m]
        np.exp(z[:m], out=z[:m])
        yield s, z[:m], z[:m].sum(axis=1)


def stage_log_probs(w: np.ndarray, stage: Stage) -> np.ndarray:
    """Natural log probability of each token's output."""
    out = np.empty(len(stage.target))
    for s, e, total in _tiles(w, stage):
        out[s] = np.log(e[np.arange(len(e)), stage.target[s]] / total)
    return out


def log_probs(w: np.ndarray, voc: Vocabulary, slots: np.ndarray, first: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Natural log probabilities: of each token's slot; and, for a token in OTHER, of a known word of its part there, by its (c + 0.5), which isn't in it (else 0)."""
    todo, at = stages(Parts.of(w), voc, slots, first, words)
    of_slot = stage_log_probs(w, todo[0]) + stage_log_probs(w, todo[1])
    in_other = np.zeros(len(slots))
    known = np.log(max(voc.other - 0.5, 0.5) / voc.other)
    in_other[at] = known - np.log(np.maximum(voc.mass[voc.place(words[at])], 0.5)) + stage_log_probs(w, todo[2]) + stage_log_probs(w, todo[3])
    return of_slot, in_other


def _sum_equal(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, how often each comes, and the sums of their rows of values: the second half of a key's rows is added to the first until one is left."""
    order = np.argsort(keys)
    own = keys[order]
    heads = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    n = np.diff(np.r_[heads, len(own)])
    rows = values[order]
    start, left = heads[n > 1], n[n > 1]
    while len(left):
        half = left // 2
        ends = np.cumsum(half)
        to = np.arange(ends[-1]) + np.repeat(start - (ends - half), half)
        rows[to] += rows[to + np.repeat(left - half, half)]
        left = left - half
        start, left = start[left > 1], left[left > 1]
    return own[heads], n, rows[heads]


def _gather(w: np.ndarray, came: np.ndarray, expected: np.ndarray, met: np.ndarray, voc: Vocabulary, words: np.ndarray, first: np.ndarray) -> None:
    """Adds to both sides of the gradient, and to each row's number of tokens, what these texts give; biases stay as they are."""
    todo, _ = stages(Parts.of(w), voc, voc.find(words)[0], first, words)
    for stage in todo:
        for r in stage.rows[:-1]:
            np.add.at(came.reshape(-1), r * SIDE + stage.target, np.float32(1))
        for s, e, total in _tiles(w, stage):
            e /= total[:, None]
            for r in stage.rows[:-1]:
                own, n, sums = _sum_equal(r[s], e)
                expected[own] += sums
                met[own] += n


def _sums(voc, weights):
    def run(batches):
        v, w = voc.value, weights.value
        came, recent, expected, met = np.zeros(w.shape, np.float32), np.zeros(w.shape, np.float32), np.zeros(w.shape), np.zeros(len(w), np.int64)
        n = 0
        for b in batches:
            for c in chunks(b.column("text")):
                h, first = _tokens(c)
                _gather(w, came, recent, met, v, h, first)
                n += len(h)
                if n > FLUSH:
                    expected += recent
                    recent[:] = 0
                    n = 0
        expected += recent
        task = TaskContext.get().partitionId()
        for lo in range(0, len(w), BLOCK):
            at = lo + np.flatnonzero(met[lo : lo + BLOCK])
            if len(at):
                sent = (x.tobytes() for x in (at, met[at], came[at], expected[at].astype(np.float32)))
                yield pa.RecordBatch.from_arrays([pa.array([lo], pa.int32()), pa.array([task // 64], pa.int32()), *(pa.array([x]) for x in sent)], names=["block", "part", "at", "met", "came", "expected"])

    return run


_UPDATE = "block int, part int, at binary, met binary, came binary, expected binary"


def _add_up(pdf: pd.DataFrame) -> pd.DataFrame:
    """One row for the block: sums by weight row."""
    joined = lambda c, kind: np.concatenate([np.frombuffer(x, kind) for x in pdf[c]])
    at, own = np.unique(joined("at", np.int64), return_inverse=True)
    out = {"block": [pdf["block"].iloc[0]], "part": [0], "at": [at.tobytes()]}
    met = np.zeros(len(at), np.int64)
    np.add.at(met, own, joined("met", np.int64))
    out["met"] = [met.tobytes()]
    for c in ("came", "expected"):
        total = np.zeros((len(at), SIDE))
        np.add.at(total, own, joined(c, np.float32).reshape(-1, SIDE))
        out[c] = [total.astype(np.float32).tobytes()]
    return pd.DataFrame(out)


def train(texts: DataFrame, voc: Vocabulary) -> np.ndarray:
    """``texts`` has a column text and a long column part, which says in which round a row is learnt."""
    sc = texts.sparkSession.sparkContext
    shared = sc.broadcast(voc)
    w = first_weights(voc)
    tasks = max(sc.defaultParallelism, -(-texts.rdd.getNumPartitions() // ROUNDS))
    for r in range(ROUNDS):
        now = sc.broadcast(w)
        sums = texts.where(F.col("part") == r).select("text").coalesce(tasks).mapInArrow(_sums(shared, now), _UPDATE)
        sums = sums.groupBy("block", "part").applyInPandas(_add_up, _UPDATE).groupBy("block").applyInPandas(_add_up, _UPDATE)
        w = w.copy()
        for u in sums.toLocalIterator():
            at, met = np.frombuffer(bytes(u["at"]), np.int64), np.frombuffer(bytes(u["met"]), np.int64)[:, None]
            came, expected = (np.frombuffer(bytes(u[c]), np.float32).reshape(-1, SIDE) for c in ("came", "expected"))
            ratio = met * came / np.maximum(expected, 1e-12 * met)
            w[at] = np.clip(w[at] + STEP * np.log((ratio + PRIOR) / (met + PRIOR)), -LARGEST, LARGEST)
        now.unpersist()
    return w


_SCORES = "n_tokens long, n_known long, base_ln double, score_ln double, rare array<struct<word: long, more: float>>"


def _score_rows(voc, weights):
    names = ["id", "n_tokens", "n_known", "base_ln", "score_ln", "rare"]

    def run(batches):
        v, w = voc.value, weights.value
        for b in batches:
            lo = 0
            for c in chunks(b.column("text")):
                h, first = _tokens(c)
                slots, counts = v.find(h)
                p, seen = log_probs(w, v, slots, first, h)
                tabled = counts >= 0
                own = np.where(tabled, np.log(np.maximum(counts, 0) + 0.5), 0.0)
                unseen = np.where(slots == OTHER, -np.log(v.other), 0.0)
                p += np.where(slots == OTHER, np.where(tabled, own + seen, unseen), 0.0)
                rare = ~tabled
                add = lambda x: np.add.reduceat(x, first[:-1])  # noqa: E731  each text has its end, so none is empty
                cuts = np.r_[0, np.cumsum(rare)][first].astype(np.int32)
                more = pa.array((seen - unseen)[rare].astype(np.float32))
                lists = pa.ListArray.from_arrays(pa.array(cuts), pa.StructArray.from_arrays([pa.array(h[rare].view(np.int64)), more], names=["word", "more"]))
                ids = b.column("id").slice(lo, c.hi - lo)
                lo = c.hi
                yield pa.RecordBatch.from_arrays([ids, pa.array(np.diff(first)), pa.array(add((counts > 0).astype(np.int64))), pa.array(add(own)), pa.array(add(p)), lists], names=names)

    return run


def score_texts(df: DataFrame, learns: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_tokens, n_known, train_tokens, base_score and score (log10).

    ``learns``: a condition on ``df`` for the rows that are learnt from.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "lm")
    texts = df.where(learns).select(F.coalesce(text_col, F.lit("")).alias("text"), F.pmod(F.xxhash64(text_col), F.lit(ROUNDS)).alias("part"))
    counts = texts.select("text").mapInArrow(_count_words, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))
    counts = scratch.keep(counts, "counts")
    voc = build_vocabulary(counts)
    w = train(texts, voc)
    sc = spark.sparkContext
    kind = df.schema[id_col].dataType.simpleString()
    src = df.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = src.mapInArrow(_score_rows(sc.broadcast(voc), sc.broadcast(w)), f"id {kind}, {_SCORES}")
    rows = scratch.keep(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    # What the table lacks. A word is at most as frequent here as the table's threshold, or never learnt; a learnt one has ``more`` by the tree.
    rare = rows.select("row", F.inline("rare"))
    seen = rare.join(counts, "word", "left").groupBy("row").agg(F.sum(F.log(F.coalesce("c", F.lit(0)) + 0.5)).alias("ln"), F.count("c").alias("known"), F.sum(F.when(F.col("c").isNotNull(), F.col("more").cast("double"))).alias("more"))
    out = rows.drop("rare").join(seen, "row", "left")
    ln = F.coalesce("ln", F.lit(0.0))
    ten = float(np.log(10))
    base = F.col("base_ln") + ln - F.col("n_tokens") * float(np.log(voc.total + 0.5 * (voc.distinct + 1)))
    return out.select(F.col("id").alias(id_col), "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(voc.total).cast("long").alias("train_tokens"), (base / ten).alias("base_score"), ((F.col("score_ln") + ln + F.coalesce("more", F.lit(0.0))) / ten).alias("score"))
