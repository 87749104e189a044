"""Toxicity by a convolutional text classifier in numpy.

Words are hashed into embedding rows. Filters of several widths slide over the whole text, each keeps its maximum, and
a logistic layer gives a logit. Embeddings start with the shrunken log odds of a word's presence in one column and
noise in the rest (rows seen in fewer than ``LEAST`` training texts stay at zero); all parts are then trained by Adam, gradients flowing through the positions of the maxima.
Each language's threshold is calibrated on rows kept out of the gradient steps; a text's language is guessed from its own
function words, never from a column. A score is the logistic function of logit minus threshold.

All labelled rows are learnt. Up to ``sample`` ids of each class, with texts of at most ``longest`` bytes and together of at most ``total_bytes`` a class, are trained
on by the driver. Where there is more, words' odds are counted over all rows; groups of rows by hash of id (about 2 * ``sample`` rows or ``total_bytes``, whole texts) train from one start,
and the mean of their changes is the model; thresholds come from
counts of all calibration rows by language and logit (in steps of 1 / ``STEPS``); then only counts and sums by weight reach the driver. Languages other than
the four whose function words are known share the threshold of all. An id counts once: where documents repeat it,
the greatest text by order is taken; an id with both labels isn't learnt. Scoring reads
each row's whole text once, without a shuffle; repeated rows get equal scores. Words never seen have zero embeddings; nulls and empty texts have no
word. Without labelled rows of both classes every score is 0, or 1 where only class 1 was seen. Other columns of the tables aren't read, and ``drop_toxic`` keeps them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm.scratch import Scratch
from quillon.llm.tokens import ALNUM, Chunk, chunks

SAMPLE = 2500
LONGEST, BYTES = 1 << 20, 24 << 20
LEAST = 6
#: Rows for words, then as many for words' first bytes by each of PREFIXES; a word's embedding is the sum of its rows.
BUCKETS, DIM, PREFIXES = 1 << 16, 8, (4, 7)
WIDTHS, FILTERS = (1, 2, 3), 6
EPOCHS, RATE, SEED = 4, 0.01, 7
#: Of all rows: logits are counted in steps, within LIMIT either way; changes are summed as whole multiples of 1 / UNIT, so in any order alike.
STEPS, LIMIT, UNIT = 1024, 64, 1 << 32
#: Function words that tell the language of a text.
FUNCTION_WORDS = {
    "en": "the and of to that is with for it was are this from be",
    "fr": "le la les et des une est dans du pour que qui sur au avec",
    "de": "der die das und den von zu mit ist nicht ein eine auf im dem",
    "es": "el los las y del una con por se su para al como es lo",
}
_U = np.uint64


def _hash_words(words: str) -> np.ndarray:
    c = next(chunks(pa.array([words])))
    return c.hashes(c.words(ALNUM))


_LANG = {k: np.unique(_hash_words(v)) for k, v in FUNCTION_WORDS.items()}
_LANG_ROWS = np.zeros((BUCKETS, len(_LANG)), np.float32)
for _i, _v in enumerate(_LANG.values()):
    _LANG_ROWS[(_v & _U(BUCKETS - 1)).astype(np.int64), _i] = 1


def bucket_ids(c: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Embedding rows of each word and, for each text, where its words begin (and the total)."""
    w = c.words(ALNUM)
    rows = [(c.hashes(w, prefix=k) & _U(BUCKETS - 1)).astype(np.int32) + np.int32(i * BUCKETS) for i, k in enumerate((None, *PREFIXES))]
    return np.stack(rows, axis=1), w.first


def languages(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Index of the language with most function words, -1 where there is none."""
    hits = np.stack([np.r_[0, np.cumsum(_LANG_ROWS[ids[:, 0], k], dtype=np.float64)] for k in range(len(_LANG))], axis=1)
    per = hits[first[1:]] - hits[first[:-1]]
    return np.where(per.max(axis=1) > 0, per.argmax(axis=1), -1)


@dataclass
class TextCnn:
    embed: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    thresholds: np.ndarray
    constant: float | None = None

    def _pool(self, x: np.ndarray, width: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Maxima of the filters of a width over one text, and where; short texts are padded with zeros."""
        if len(x) < width:
            x = np.vstack([x, np.zeros((width - len(x), DIM), np.float32)])
        y = sum(x[j : len(x) - width + 1 + j] @ self.filters[k][j] for j in range(width))
        at = y.argmax(axis=0)
        return y[at, np.arange(FILTERS)], at

    def vectors(self, ids: np.ndarray) -> np.ndarray:
        return sum(self.embed[ids[:, k]] for k in range(ids.shape[1]))

    def features(self, ids: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        x = self.vectors(ids)
        pooled = [self._pool(x, w, k) for k, w in enumerate(WIDTHS)]
        return np.concatenate([p for p, _ in pooled]) + self.bias, [a for _, a in pooled]

    def logits(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Of all texts of a chunk at once."""
        if not len(first) - 1:
            return np.empty(0)
        pad = max(WIDTHS) - 1
        n = len(ids)
        x = np.vstack([self.vectors(ids), np.zeros((pad, DIM), np.float32)])
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        sizes = np.diff(first)
        full = sizes > 0
        pooled = []
        for k, w in enumerate(WIDTHS):
            y = sum(x[j : n + j] @ self.filters[k][j] for j in range(w)) if n else np.zeros((0, FILTERS), np.float32)
            # A window that runs into the next text counts only in texts shorter than the width, where it's built anew.
            if w > 1 and n:
                over = np.arange(n) + w > first[doc + 1]
                y[over] = -np.inf
            p = np.zeros((len(sizes), FILTERS), np.float32)
            if n:
                p[full] = np.maximum.reduceat(y, first[:-1][full], axis=0)
            for i in np.flatnonzero(sizes < w):
                p[i] = self._pool(self.vectors(ids[first[i] : first[i + 1]]), w, k)[0]
            pooled.append(p)
        z = np.maximum(np.concatenate(pooled, axis=1) + self.bias, 0)
        return z @ self.out + self.out_bias

    def scores(self, c: Chunk) -> np.ndarray:
        if self.constant is not None:
            return np.full(c.hi - c.lo, self.constant)
        ids, first = bucket_ids(c)
        z = self.logits(ids, first) - self.thresholds[languages(ids, first)]
        return 1 / (1 + np.exp(-np.clip(z.astype(float), -500, 500)))


def train(texts: list[np.ndarray], y: np.ndarray, keep_out: np.ndarray) -> TextCnn:
    """``texts`` are embedding rows; rows of ``keep_out`` calibrate the thresholds only."""
    if len(set(y.tolist())) < 2:
        return TextCnn(np.empty(0), [], np.empty(0), np.empty(0), 0.0, np.empty(0), float(y[0]) if len(y) else 0.0)
    rng = np.random.default_rng(SEED)
    own = np.flatnonzero(~keep_out)
    if len(set(y[own].tolist())) < 2:
        own = np.arange(len(y))
    df = np.zeros((2, (1 + len(PREFIXES)) * BUCKETS), np.float32)
    for i in own:
        df[y[i], np.unique(texts[i])] += 1
    m, moves = _start(df, np.bincount(y[own], minlength=2), rng)
    _fit(m, texts, y, own, moves, rng)
    _calibrate(m, texts, y, np.flatnonzero(keep_out) if len(set(y[keep_out].tolist())) == 2 else np.arange(len(y)))
    return m


def _start(df: np.ndarray, n: np.ndarray, rng: np.random.Generator) -> tuple[TextCnn, np.ndarray]:
    """The model to start from and which of its embeddings may move; ``df``: texts of each class with each row, ``n``: texts of each class."""
    both = df.sum(axis=0)
    odds = (np.log((df[1] + 0.5) / (n[1] + 1)) - np.log((df[0] + 0.5) / (n[0] + 1))) * both / (both + 8)
    embed = rng.normal(0, 0.05, ((1 + len(PREFIXES)) * BUCKETS, DIM)).astype(np.float32)
    embed[:, 0] = odds
    embed[both < LEAST] = 0
    filters = [rng.normal(0, 0.1, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    for f in filters:
        f[:, 0, ::2] += 1.0 / len(f)
    m = TextCnn(embed, filters, np.zeros(len(WIDTHS) * FILTERS, np.float32), np.full(len(WIDTHS) * FILTERS, 0.3, np.float32), -2.0, np.zeros(len(_LANG) + 1))
    return m, both >= LEAST


def _fit(m: TextCnn, texts: list[np.ndarray], y: np.ndarray, own: np.ndarray, moves: np.ndarray, rng: np.random.Generator, weight: np.ndarray | None = None) -> None:
    dense = [*m.filters, m.bias, m.out]
    mom, var, step, bias_state = [np.zeros_like(p) for p in dense], [np.zeros_like(p) for p in dense], 0, np.zeros(2)
    weight = len(own) / (2 * np.bincount(y[own], minlength=2)) if weight is None else weight
    batch = 16
    for _ in range(EPOCHS):
        order = rng.permutation(own)
        for lo in range(0, len(order), batch):
            grads, gb = [np.zeros_like(p) for p in dense], 0.0
            rows = order[lo : lo + batch]
            for i in rows:
                ids = texts[i]
                pre, at = m.features(ids)
                z = np.maximum(pre, 0)
                p = 1 / (1 + np.exp(-np.clip(z @ m.out + m.out_bias, -30, 30)))
                g = (p - y[i]) * weight[y[i]] / len(rows)
                gb += g
                grads[-1] += g * z
                gz = g * m.out * (pre > 0)
                grads[-2] += gz
                for k, w in enumerate(WIDTHS):
                    gk = gz[k * FILTERS : (k + 1) * FILTERS]
                    for j in range(w):
                        pos = at[k] + j
                        ok = pos < len(ids)
                        rows_j = ids[pos[ok]]
                        grads[k][j][:, ok] += m.vectors(rows_j).T * gk[ok]
                        change = -0.2 * RATE * gk[ok][:, None] * m.filters[k][j][:, ok].T
                        for k2 in range(rows_j.shape[1]):
                            np.add.at(m.embed, rows_j[:, k2], change * moves[rows_j[:, k2], None])
            step += 1
            for k, (param, grad) in enumerate(zip(dense, grads)):
                grad += 1e-4 * param
                mom[k] = 0.9 * mom[k] + 0.1 * grad
                var[k] = 0.999 * var[k] + 0.001 * grad * grad
                param -= RATE * (mom[k] / (1 - 0.9**step)) / (np.sqrt(var[k] / (1 - 0.999**step)) + 1e-8)
            bias_state = np.array([0.9 * bias_state[0] + 0.1 * gb, 0.999 * bias_state[1] + 0.001 * gb * gb])
            m.out_bias -= float(RATE * (bias_state[0] / (1 - 0.9**step)) / (np.sqrt(bias_state[1] / (1 - 0.999**step)) + 1e-8))


def _best_threshold(z: np.ndarray, y: np.ndarray, n: np.ndarray | None = None) -> float:
    """Between two neighbouring logits, where F1 is greatest; ties go to the widest gap. ``n``: rows of each logit, of which ``y`` are of class 1."""
    order = np.argsort(-z)
    hits = np.cumsum(y[order])
    f1 = 2 * hits / ((np.arange(1, len(z) + 1) if n is None else np.cumsum(n[order])) + y.sum())
    gaps = z[order] - np.r_[z[order][1:], z.min() - 1]
    best = np.flatnonzero(f1 >= f1.max() - 1e-9)
    i = best[gaps[best].argmax()]
    return float(z[order][i] - gaps[i] / 2)


def _calibrate(m: TextCnn, texts: list[np.ndarray], y: np.ndarray, rows: np.ndarray) -> None:
    ids = np.concatenate([texts[i] for i in rows])
    first = np.r_[0, np.cumsum([len(texts[i]) for i in rows])]
    _set_thresholds(m, m.logits(ids, first), languages(ids, first), y[rows], np.ones(len(rows), np.int64))


def _set_thresholds(m: TextCnn, z: np.ndarray, lang: np.ndarray, y: np.ndarray, n: np.ndarray) -> None:
    """From ``n`` rows of each logit and language, of which ``y`` are of class 1."""
    m.thresholds[:] = whole = _best_threshold(z, y, n)
    for k in range(len(_LANG)):
        own = lang == k
        pos = y[own].sum()
        if pos >= 5 and pos < n[own].sum():
            # Few positives move a language's threshold only part of the way.
            m.thresholds[k] = whole + (_best_threshold(z[own], y[own], n[own]) - whole) * pos / (pos + 20)


# --- all rows ---------------------------------------------------------------------------------------------------------
def _texts_of(column) -> tuple[np.ndarray, np.ndarray]:
    """``bucket_ids`` of all texts of a column."""
    parts = [bucket_ids(c) for c in chunks(column)]
    ids = np.concatenate([i for i, _ in parts]) if parts else np.empty((0, 1 + len(PREFIXES)), np.int32)
    return ids, np.r_[0, np.cumsum(np.concatenate([np.diff(f) for _, f in parts]))] if parts else np.zeros(1, np.int64)


def _count_words(rows: DataFrame) -> np.ndarray:
    """Texts of each class with each embedding row."""
    size = (1 + len(PREFIXES)) * BUCKETS

    def run(batches):
        df = np.zeros(2 * size, np.int64)
        for b in batches:
            y = b.column(0).to_numpy()
            lo = 0
            for c in chunks(b.column(1)):
                ids, first = bucket_ids(c)
                own = y[lo : lo + c.hi - c.lo]
                doc = np.repeat(np.arange(len(own)), np.diff(first))
                pairs = np.unique(doc[:, None] * size + ids)
                df += np.bincount(own[pairs // size] * size + pairs % size, minlength=2 * size)
                lo += len(own)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], names=["i", "n"])

    got = rows.select(F.col("y").cast("long"), "text").mapInArrow(run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(2 * size, np.float32)
    out[got["i"].to_numpy()] = got["n"].to_numpy()
    return out.reshape(2, size)


def _dense(m: TextCnn) -> np.ndarray:
    """All weights but the embeddings, in rows of DIM."""
    x = np.concatenate([*(f.ravel() for f in m.filters), m.bias, m.out, [m.out_bias]]).astype(np.float64)
    return np.r_[x, np.zeros(-len(x) % DIM)].reshape(-1, DIM)


def _moved(m: TextCnn, change: np.ndarray) -> TextCnn:
    """The model with ``change`` (rows of embeddings, then of ``_dense``) added."""
    flat, at, parts = (_dense(m) + change[len(m.embed) :]).ravel(), 0, []
    for p in (*m.filters, m.bias, m.out):
        parts.append(flat[at : at + p.size].reshape(p.shape).astype(np.float32))
        at += p.size
    return TextCnn((m.embed + change[: len(m.embed)]).astype(np.float32), parts[:-2], parts[-2], parts[-1], float(flat[at]), m.thresholds)


def _fit_groups(rows: DataFrame, start: TextCnn, moves: np.ndarray, weight: np.ndarray, groups: int) -> TextCnn:
    """``start`` with the mean of the changes that ``groups`` groups of rows make, each by itself."""
    shared = rows.sparkSession.sparkContext.broadcast((start, moves, weight))
    names = [f"v{k}" for k in range(DIM)]

    def run(table):
        first_model, may_move, w = shared.value
        table = table.sort_by("id").combine_chunks()
        ids, first = _texts_of(table["text"])
        y = table["y"].to_numpy().astype(np.int64)
        m = _moved(first_model, np.zeros((len(first_model.embed) + len(_dense(first_model)), DIM)))
        _fit(m, [ids[first[i] : first[i + 1]] for i in range(len(y))], y, np.arange(len(y)), may_move, np.random.default_rng(SEED), w)
        change = np.vstack([m.embed.astype(np.float64) - first_model.embed, _dense(m) - _dense(first_model)])
        some = np.flatnonzero(change.any(axis=1) | (np.arange(len(change)) >= len(m.embed)))
        units = np.rint(change[some] * UNIT).astype(np.int64)
        return pa.table([pa.array(some), *(pa.array(units[:, k]) for k in range(DIM))], names=["i", *names])

    group = F.pmod(F.xxhash64(F.col("id"), F.lit(SEED)), F.lit(groups))
    changes = rows.select(group.alias("group"), "id", "y", "text").groupBy("group").applyInArrow(run, ", ".join(["i long", *(f"{v} long" for v in names)]))
    got = changes.groupBy("i").agg(F.count("*").alias("n"), *(F.sum(v).alias(v) for v in names)).toArrow()
    total = np.zeros((len(start.embed) + len(_dense(start)), DIM))
    total[got["i"].to_numpy()] = np.stack([got[v].to_numpy() for v in names], axis=1) / UNIT
    # Each group has the dense rows.
    return _moved(start, total / got["n"].to_numpy().max())


def _calibrate_all(rows: DataFrame, model: TextCnn) -> None:
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for b in batches:
            y = b.column(0).to_numpy()
            ids, first = _texts_of(b.column(1))
            step = np.floor(np.clip(m.logits(ids, first), -LIMIT, LIMIT) * STEPS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(languages(ids, first)), pa.array(step), pa.array(y)], names=["lang", "step", "y"])

    got = rows.select(F.col("y").cast("long"), "text").mapInArrow(run, "lang long, step long, y long").groupBy("lang", "step").agg(F.sum("y").alias("y"), F.count("*").alias("n")).toArrow().sort_by([("lang", "ascending"), ("step", "ascending")])
    if len(got):
        # A language's steps and, for the threshold of all, every step of every language.
        _set_thresholds(model, (got["step"].to_numpy() + 0.5) / STEPS, got["lang"].to_numpy(), got["y"].to_numpy(), got["n"].to_numpy())


def _fit_all(rows: DataFrame, group_rows: int, group_bytes: int) -> TextCnn:
    """The model of all ``rows`` (id, y, keep_out, size, text), trained by groups of about so many rows and bytes."""
    sizes = {(r["keep_out"], r["y"]): (r["n"], r["size"]) for r in rows.groupBy("keep_out", "y").agg(F.count("*").alias("n"), F.sum("size").alias("size")).collect()}
    if len(classes := {y for _, y in sizes}) < 2:
        return TextCnn(np.empty(0), [], np.empty(0), np.empty(0), 0.0, np.empty(0), float(*classes))
    both = {k: (k, 0) in sizes and (k, 1) in sizes for k in (False, True)}
    own = [k for k in (False, True) if not k or not both[False]]
    n = np.array([sum(sizes.get((k, y), (0, 0))[0] for k in own) for y in (0, 1)])
    size = sum(sizes.get((k, y), (0, 0))[1] for k in own for y in (0, 1))
    learnt = rows.where(F.col("keep_out").isin(own))
    start, moves = _start(_count_words(learnt), n, np.random.default_rng(SEED))
    groups = max(1, -(-int(n.sum()) // group_rows), -(-size // group_bytes))
    model = _fit_groups(learnt, start, moves, n.sum() / (2 * n), groups)
    _calibrate_all(rows.where("keep_out") if both[True] else rows, model)
    return model


def fit_toxicity(df: DataFrame, labels: DataFrame, label: str, train_rows: Column, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, longest: int = LONGEST, total_bytes: int = BYTES) -> TextCnn:
    """``train_rows``: a condition on labels for the rows that may be learnt."""
    y = F.col(label).cast("int")
    known = labels.where(train_rows).where(y.isin(0, 1)).groupBy(F.col(id_col).alias("id")).agg(F.min(y).alias("y"), F.max(y).alias("y2")).where("y = y2").select("id", "y")
    # Repeats of an id are combined in the exchange of the join.
    id_text = F.col("id").cast("string")
    every = df.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text")).join(known, "id").groupBy("id", "y").agg(F.max("text").alias("text"))
    every = every.select(id_text.alias("id"), "y", (F.pmod(F.crc32(id_text.cast("binary")), F.lit(4)) == 0).alias("keep_out"), F.octet_length("text").alias("size"), "text")
    scratch = Scratch(df.sparkSession, "labelled")
    every = scratch.keep(every, "rows", "zstd")
    few = every.where(F.col("size") <= longest)
    classes = few.groupBy("y").agg(F.count("*").alias("n"), F.sum("size").alias("size")).collect()
    model = None
    if all(r["n"] <= sample and r["size"] <= total_bytes for r in classes):
        got = few.select("id", "y", "keep_out", "text").toArrow().sort_by("id").combine_chunks()
        texts = []
        for c in chunks(got["text"]):
            ids, first = bucket_ids(c)
            texts += [ids[first[i] : first[i + 1]] for i in range(c.hi - c.lo)]
        model = train(texts, got["y"].to_numpy().astype(np.int64), got["keep_out"].to_numpy().astype(bool))
    if model is None or not every.where(F.col("size") > longest).isEmpty():
        model = _fit_all(every, 2 * sample, total_bytes)
    scratch.drop(every)
    return model


def score_toxicity(df: DataFrame, model: TextCnn, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score of every row."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        m = shared.value
        for b in batches:
            s = [m.scores(c) for c in chunks(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(np.concatenate(s) if s else np.empty(0), pa.float64())], names=["id", "score"])

    out = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, score double")
    return out.withColumnRenamed("id", id_col)


def drop_toxic(df: DataFrame, model: TextCnn, text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows of ``df`` with a score below ``limit``, all columns."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    k = df.columns.index(text_col)

    def run(batches):
        m = shared.value
        for b in batches:
            s = [m.scores(c) for c in chunks(b.column(k))]
            yield b.filter(pa.array(np.concatenate(s) < limit if s else np.empty(0, bool)))

    return df.mapInArrow(run, df.schema)
