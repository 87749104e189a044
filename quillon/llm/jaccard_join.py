"""N-gram Jaccard join by PartEnum signatures.

Each text becomes the set of its distinct word n-grams, as 64-bit hashes. Sizes are cut into bands; for a band of
sizes l..u two sets at the threshold differ in at most k elements, k from u. The element domain is hashed into n1
first-level groups and each group into n2 second-level parts, and every subset of n2-k2 parts of a group is one
signature: the hash of what the set has in it. By the pigeonhole principle similar sets share a signature. A set
also enters the band above when it can have a partner there. Of a band's groups it signs the first ones only, as many as its
own largest partner there asks for.

Subsets that hold next to nothing would put unrelated sets together. n1 has ``spare`` more groups than the argument
needs, so linked sets share signatures of spare + 1 groups at least. A set with at most ``spare`` thin groups (one of their subsets has
fewer than ``least`` elements) doesn't sign for thin subsets; any other set signs for all. A shared subset is thin for both sets or
for neither, so a set still shares spare + 1 - (its thin groups) signatures with each partner, and the join stays complete.

What happens to the buckets:
* Equal sets are one class, named by a 64-bit hash of the set; all work is on classes, so copies cost one row each.
* A bucket's classes are compared with one pivot, the class that meets most others; verified pairs are edges.
* A class of fewer shared signatures than linked sets must share is out before that.
* After components of those edges, only pairs of classes of one pivot and of different components are left. A round of
  comparisons between likely fellows, a linear number, leaves few components. The rest is complete:
  pairs are found by what they differ in from the pivot: linked classes have a certain part of those differences in common, so
  one lies in a prefix of both (see ``_differences``), and they're compared too. Prefixes travel packed, a row a class and part of its pivot's
  classes, and meet in a task by part. No link that matters for
  components is lost. These last pairs are few on prose; where thousands of classes are alike but not linked (pages of one template whose fields have few
  values), their number grows with the square of the group.
* The sets of classes that share a bucket are written once; each text is split into words three times in all. Narrow tables of pairs and classes are broadcast
  where a count allows it, so that only sets cross an exchange, once to their pivot.
* All rows of a signature meet in one window task, 20 bytes a class and signature; other groups are joins and sums, which are combined or split.

Nulls and texts without a word have an empty set, no link and a class of their own. Two different sets are taken for
equal with a chance of 2**-64 for each pair, and words as ``tokens`` says.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillon.llm.components import components
from quillon.llm.scratch import Scratch
from quillon.llm.tokens import SPACED, chunks, mix, windows

_U = np.uint64
#: Least and most bits, as powers of two, of the filter that marks the documents whose sets are needed (32 MB at most; beyond that more sets than needed are passed on).
FILTER_BITS = 16, 28
#: Groups beyond those that the argument needs, as a share of them.
SPARE = 0.25
#: Fewer elements a group than this (before the spare ones), and groups are cut into parts: half as much again in signatures, of more elements each.
WHOLE = 2.5


@dataclass(frozen=True)
class Rule:
    """Link when den * |intersection| >= num * |union|, over n-grams of ``size`` words."""

    size: int = 5
    num: int = 80
    den: int = 100

    def differ(self, a: int, b: int) -> int:
        """Most elements in which linked sets of these sizes differ."""
        return (self.den - self.num) * (a + b) // (self.den + self.num)

    def linked(self, inter: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.den * inter >= self.num * (a + b - inter)


@dataclass(frozen=True)
class Band:
    index: int
    low: int
    high: int
    n1: int
    n2: int
    k2: int
    spare: int
    least: int


def _weak_share(mean: float, least: int, subsets: int) -> float:
    """About the share of groups with a subset of fewer than ``least`` elements, where a subset has ``mean`` on average."""
    return min(1.0, subsets * sum(math.exp(-mean) * mean**i / math.factorial(i) for i in range(least)))


@lru_cache(maxsize=4096)
def band(rule: Rule, index: int) -> Band:
    """The index-th size band; each is wide enough that partners are at most one band apart."""
    low = 1 if index == 0 else band(rule, index - 1).high + 1
    high = max(low * rule.den // rule.num, low * 27 // 20)
    k = rule.differ(high, high)
    if k and low < WHOLE * (k + 1):
        n2, k2 = 3, 1
    else:
        n2, k2 = 1, 0
    n1 = k // (k2 + 1) + 1
    spare = 0 if n1 <= 4 else 2 + int(n1 * SPARE)
    total = n1 + spare
    mean, subsets = low * (n2 - k2) / (total * n2), math.comb(n2, k2)
    least = 1
    while least < 8 and (weak := total * _weak_share(mean, least + 1, subsets)) + 2 * math.sqrt(weak) <= spare:
        least += 1
    return Band(index, low, high, total, n2, k2, spare, least)


def bands_of(rule: Rule, n: int) -> list[Band]:
    i = 0
    while (b := band(rule, i)).high < n:
        i += 1
    above = band(rule, i + 1)
    return [b, above] if rule.den * n >= rule.num * above.low else [b]


def text_sets(batch_column: pa.Array, rule: Rule) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each row."""
    for c in chunks(batch_column):
        w = c.words(SPACED)
        h = c.hashes(w)
        with np.errstate(over="ignore"):
            g, doc = windows(h, w, rule.size, 1)
            at = np.searchsorted(doc, np.arange(c.hi - c.lo + 1))
            for i in range(c.hi - c.lo):
                a, b = w.first[i], w.first[i + 1]
                if b - a >= rule.size:
                    yield np.unique(g[at[i] : at[i + 1]])
                elif b > a:
                    x = _U(b - a)
                    for y in h[a:b]:
                        x = mix(np.array([x * _U(31) + y]))[0]
                    yield np.array([x], np.uint64)
                else:
                    yield np.empty(0, np.uint64)


def set_key(s: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        x = mix(np.array([mix(s).sum(dtype=np.uint64) + _U(len(s))]))[0]
    return int(x.view(np.int64))


def signed_groups(rule: Rule, b: Band, n: int) -> int:
    """How many first groups a set of n elements signs: what its difference to the largest partner in the band needs, and the spare ones.

    It grows with n, so of two partners the smaller one's groups are signed by both, and they're enough: of those at most k // (k2 + 1) have more than k2
    of the k elements in which the two may differ.
    """
    return rule.differ(n, min(n * rule.den // rule.num, b.high)) // (b.k2 + 1) + 1 + b.spare


def signatures(s: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """All signatures of one non-empty set, and for each its band and how many signatures of that band a partner shares at least, as band * 2**16 + number."""
    out, info = [], []
    with np.errstate(over="ignore"):
        for b in bands_of(rule, len(s)):
            x = mix(s + _U(1000003 * (b.index + 1)))
            parts = b.n1 * b.n2
            part = ((x >> _U(32)) * _U(parts) >> _U(32)).astype(np.int64)
            y = mix(x)
            total = np.bincount(part, (y & _U(0xFFFFFFFF)).astype(float), parts).astype(np.uint64)
            total += np.bincount(part, (y >> _U(32)).astype(float), parts).astype(np.uint64) << _U(32)
            count = np.bincount(part, minlength=parts)
            if b.n2 == 1:
                sums, sizes = total[:, None], count[:, None]
            else:
                subsets = list(itertools.combinations(range(b.n2), b.n2 - b.k2))
                t, c = total.reshape(b.n1, b.n2), count.reshape(b.n1, b.n2)
                sums = np.stack([t[:, j].sum(axis=1, dtype=np.uint64) for j in map(list, subsets)], axis=1)
                sizes = np.stack([c[:, j].sum(axis=1) for j in map(list, subsets)], axis=1)
            tag = np.arange(sums.size, dtype=np.uint64).reshape(sums.shape) + _U(b.index << 32)
            sig = mix(mix(sums) + tag)
            signed = signed_groups(rule, b, len(s))
            sig, sizes = sig[:signed], sizes[:signed]
            full = sizes >= b.least
            empty = int((~full).any(axis=1).sum())
            # A partner that doesn't sign its empty subsets may share only one with a set that does.
            own, least = (sig.ravel(), 1) if empty > b.spare else (sig[full], b.spare + 1 - empty)
            out.append(own)
            info.append(np.full(len(own), (b.index << 16) + least, np.int32))
    return np.concatenate(out), np.concatenate(info)


def _class_rows(rule: Rule):
    def run(batches):
        for b in batches:
            sets = list((len(s), set_key(s) if len(s) else None) for s in text_sets(b.column("text"), rule))
            n, key = zip(*sets) if sets else ((), ())
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(n, pa.int64()), pa.array(key, pa.int64())], names=["id", "n", "key"])

    return run


def _signature_rows(rule: Rule):
    def run(batches):
        seen: set[int] = set()
        for b in batches:
            sig, key, info, rows = [], [], [], 0
            for s in text_sets(b.column("text"), rule):
                if not len(s) or (k := set_key(s)) in seen:
                    continue
                if len(seen) >= 200_000:
                    seen.clear()
                seen.add(k)
                x, y = signatures(s, rule)
                sig.append(x)
                info.append(y)
                key.append((k, len(x)))
                rows += len(x)
                if rows >= 50_000:
                    yield _signature_batch(sig, key, info)
                    sig, key, info, rows = [], [], [], 0
            if rows:
                yield _signature_batch(sig, key, info)

    return run


def _signature_batch(sig: list, key: list, info: list) -> pa.RecordBatch:
    k = np.repeat(np.array([x for x, _ in key], np.int64), [n for _, n in key])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(sig).view(np.int64)), pa.array(k), pa.array(np.concatenate(info))], names=["sig", "key", "info"])


def _slot(ids: np.ndarray, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(ids.astype(np.int64).view(np.uint64)) >> _U(64 - bits)).astype(np.int64)


def _needed_filter(ids: DataFrame):
    """The number of bits, as a power of two, and a broadcast table of them that has the slots of ``id`` set; slots are combined before they're sent."""
    least, most = FILTER_BITS
    n_bits = min(most, max(least, (16 * ids.count()).bit_length()))

    def fill(batches):
        bits = np.zeros(1 << n_bits, bool)
        for b in batches:
            bits[_slot(b.column("id").to_numpy(zero_copy_only=False), n_bits)] = True
        words = np.packbits(bits).view(np.int64)
        at = np.flatnonzero(words)
        for i in range(0, len(at), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(at[i : i + 100_000]), pa.array(words[at[i : i + 100_000]])], names=["at", "bits"])

    got = ids.select("id").coalesce(8).mapInArrow(fill, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toPandas()
    words = np.zeros((1 << n_bits) // 64, np.int64)
    words[got["at"].to_numpy()] = got["bits"].to_numpy()
    return n_bits, ids.sparkSession.sparkContext.broadcast(words.tobytes())


def _set_rows(rule: Rule, n_bits: int, needed):
    def run(batches):
        bits = np.frombuffer(needed.value, np.uint8)
        for b in batches:
            ids = b.column("id").to_numpy(zero_copy_only=False)
            slot = _slot(ids, n_bits)
            hit = np.flatnonzero(bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8) & 1)
            for lo in range(0, len(hit), 1000):
                at = hit[lo : lo + 1000]
                text = b.column("text").take(pa.array(at))
                sets = [s for s in text_sets(text, rule)]
                keys = [set_key(s) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([pa.array(ids[at], pa.int64()), pa.array(keys, pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["id", "key", "grams"])

    return run


def _sorted_sets(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for x, y in zip(b.column("x"), b.column("y")):
        yield np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)


def _in(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which of x are in y; both sorted."""
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return y[at] == x


#: Minima of hashes of a class's differences to its pivot: by these, likely fellows are put side by side.
SKETCH = 4


def _compare(rule: Rule):
    """linked, n (size of u) and sketch, the SKETCH minima over the elements in which u and v differ."""

    def run(batches):
        seeds = mix(np.arange(1, SKETCH + 1, dtype=np.uint64))
        for b in batches:
            n, sketch = [], []
            for x, y in _sorted_sets(b):
                both = _in(x, y)
                n.append((len(x), len(y), int(both.sum())))
                d = np.concatenate([x[~both], y[~_in(y, x)]])
                with np.errstate(over="ignore"):
                    sketch.append(mix(d[None, :] ^ seeds[:, None]).min(axis=1).view(np.int64).tolist() if len(d) else [0] * SKETCH)
            n = np.array(n, np.int64).reshape(-1, 3)
            linked = rule.linked(n[:, 2], n[:, 0], n[:, 1])
            d = n[:, 0] + n[:, 1] - 2 * n[:, 2]
            yield pa.RecordBatch.from_arrays([b.column("u"), b.column("v"), pa.array(linked), pa.array(n[:, 0]), pa.array(d), pa.array(sketch, pa.list_(pa.int64()))], names=["u", "v", "linked", "n", "d", "sketch"])

    return run


def _small(df: DataFrame, most: int = 500_000) -> DataFrame:
    """A written table of a few numbers a row: broadcast where a count says that it has at most ``most`` rows, else joined as it is."""
    return F.broadcast(df) if df.count() <= most else df


def _sets_of(docs: DataFrame, classes: DataFrame, keys: DataFrame, rule: Rule, scratch: Scratch) -> DataFrame:
    """(key, grams) of the classes named, written; each is read from the text of its first document."""
    need = scratch.keep(keys.join(classes, "key").select("key", F.col("rep").alias("id")), "need")
    n_bits, needed = _needed_filter(need)
    sets = docs.where("id is not null").mapInArrow(_set_rows(rule, n_bits, needed), "id long, key long, grams binary")
    # The filter lets some other documents through, copies too, and a row that is in the table twice, id included, gives its set twice.
    sets = scratch.keep(sets.join(_small(need), ["id", "key"]).select("key", "grams").dropDuplicates(["key"]), "sets", "none")
    scratch.drop(need)
    return sets


def _with_sets(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """``pairs`` (u, v, ..., a written narrow table) with x and y, the sets of u and v. Only sets that a pair needs cross an exchange."""
    x = sets.select(F.col("key").alias("u"), F.col("grams").alias("x")).join(_small(pairs), "u")
    y = sets.select(F.col("key").alias("v"), F.col("grams").alias("y")).join(_small(pairs.select("v").distinct()), "v", "left_semi")
    return x.join(y, "v")


def _verify(sets: DataFrame, pairs: DataFrame, rule: Rule, scratch: Scratch) -> DataFrame:
    """(u, v, linked, n, d, sketch) of the class pairs, by their whole sets."""
    tested = _with_sets(sets, pairs).select("u", "v", "x", "y").mapInArrow(_compare(rule), "u long, v long, linked boolean, n long, d long, sketch array<long>")
    return scratch.keep(tested, "tested")


def _differences(rule: Rule):
    """Rows (pivot, part, key, n, d, near, c, elements, places): a prefix of the elements in which a class and its pivot differ, dealt to the pivot's parts by element.

    For classes a, b of one pivot, |a ^ b| = |A| + |B| - 2 |A & B|, where A and B are their differences to the pivot. Linked
    classes differ in at most k elements, so |A & B| >= t = (|A| + |B| - k) / 2, and in any fixed order of the elements
    the first |A| - t + 1 of A and |B| - t + 1 of B have one in common, after which (it included) both have t elements or more. Elements that are common among the
    pivot's classes come last, and those that the pivot lacks first: edits made independently rarely share them.

    Where t <= 0, both classes are linked to the pivot: with r = (den - num) / (den + num), sets link when they differ in at most r (a + b)
    elements. |A| + |B| <= r (a + b) means that one of them, say A, has |A| <= r a, so it's linked to the pivot p; and |B| <= r a - |A| + r b,
    where a <= p + |A|, so |B| <= r (p + b). Such pairs are of one component, and need no row.
    """

    def run(batches):
        for b in batches:
            meta = zip(*(b.column(c).to_pylist() for c in ("u", "v", "linked", "c", "parts", "common")))
            rows = []
            for (u, v, near, c, parts, common), (x, y) in zip(meta, _sorted_sets(b)):
                both = np.concatenate([x[~_in(x, y)], y[~_in(y, x)]])
                d, n = len(both), len(x)
                if common:
                    often = np.array(common, np.int64).view(np.uint64)
                    order = np.argsort(often)
                    at = np.minimum(np.searchsorted(often[order], both), len(often) - 1)
                    rank = np.where(often[order][at] == both, order[at] + 1, 0)
                    both = both[np.argsort(rank, kind="stable")]
                k = rule.differ(n, n * rule.den // rule.num)
                least = max(d - k, 0)
                if near:
                    # A class linked to the pivot is of its component: only classes that aren't can add something.
                    least = max(least, rule.differ(-(-n * rule.num // rule.den), len(y)) + 1)
                t = -((k - d - least) // 2)
                e = both[: max(0, min(d, d - t + 1))]
                place = np.arange(len(e), dtype=np.int32)
                with np.errstate(over="ignore"):
                    part = mix(e) % _U(parts) if parts > 1 else np.zeros(len(e), np.uint64)
                for i in np.unique(part):
                    rows.append((v, int(i), u, n, d, near, c, e[part == i].tobytes(), place[part == i].tobytes()))
                if len(rows) >= 2000:
                    yield _difference_batch(rows)
                    rows = []
            if rows:
                yield _difference_batch(rows)

    return run


_DIFFERENCES = pa.schema([("pivot", pa.int64()), ("part", pa.int64()), ("key", pa.int64()), ("n", pa.int64()), ("d", pa.int64()), ("near", pa.bool_()), ("c", pa.int64()), ("elements", pa.binary()), ("places", pa.binary())])


def _difference_batch(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), _DIFFERENCES)], schema=_DIFFERENCES)


#: Classes whose differences a part holds, by expectation, if each class has some in each part; pairs that are tested at once.
PART, TESTED = 2048, 1 << 20


def _fellows(rule: Rule):
    """(u, v): classes of one pivot with an element in common, after which both have as many left as linked ones must; a part's rows are one group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(batches))
        key, n, d, c = (t.column(x).to_numpy() for x in ("key", "n", "d", "c"))
        near = t.column("near").to_numpy().astype(bool)
        e = [np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("elements")]
        row = np.repeat(np.arange(len(e)), [len(x) for x in e])
        e = np.concatenate(e)
        place = np.concatenate([np.frombuffer(x.as_buffer(), np.int32) for x in t.column("places")]).astype(np.int64)
        order = np.argsort(e, kind="stable")
        e, row, place = e[order], row[order], place[order]
        at = np.arange(len(e))
        heads = np.r_[True, e[1:] != e[:-1]] if len(e) else np.empty(0, bool)
        after = np.r_[at[heads], len(e)][np.cumsum(heads)] - at - 1  # each meets those after it in the run of its element
        total = np.r_[0, np.cumsum(after)]
        for lo in range(0, int(total[-1]), TESTED):
            pair = np.arange(lo, min(lo + TESTED, int(total[-1])))
            i = np.searchsorted(total, pair, "right") - 1
            j = i + 1 + pair - total[i]
            x, y = row[i], row[j]
            most = (rule.den - rule.num) * (n[x] + n[y]) // (rule.den + rule.num)
            may = (key[x] != key[y]) & (c[x] != c[y]) & ~(near[x] & near[y]) & (np.abs(n[x] - n[y]) <= most) & (np.abs(d[x] - d[y]) <= most)
            may &= 2 * np.minimum(d[x] - place[i], d[y] - place[j]) >= d[x] + d[y] - most
            u, v = key[x[may]], key[y[may]]
            pairs = np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["u", "v"])

    return run


def _join(df: DataFrame, id_col: str, text_col: str, rule: Rule) -> tuple[DataFrame, DataFrame, DataFrame, Scratch]:
    """Rows (id, n, key), classes (key, rep, class_size, n), verified links between classes (u, v), and where they're kept."""
    spark = df.sparkSession
    scratch = Scratch(spark, "jaccard")
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = scratch.keep(docs.mapInArrow(_class_rows(rule), "id long, n long, key long"), "rows")
    classes = scratch.keep(rows.where("key is not null and id is not null").groupBy("key").agg(F.min("id").alias("rep"), F.count("*").alias("class_size")), "classes")

    pairs = _pivot_pairs(docs.where("id is not null").mapInArrow(_signature_rows(rule), "sig long, key long, info int"), scratch)
    if pairs.isEmpty():
        edges = spark.createDataFrame([], "u long, v long")
    else:
        edges = _edges(docs, classes, pairs, rule, scratch)
    return rows, classes, edges, scratch


def jaccard_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Rule = Rule()) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, class_key (null: empty set), class_size.

    component_id is the smallest id reachable by links, the row's own included. Rows with a null id are kept, each
    alone (component null). Other columns of ``df`` aren't read.
    """
    rows, classes, edges, scratch = _join(df, id_col, text_col, rule)
    found = components(edges, scratch).withColumnRenamed("node", "key")
    small = found.join(classes.select("key", "rep"), "key").groupBy("component").agg(F.min("rep").alias("component_id"))
    found = found.join(small, "component").select("key", "component_id")
    named = classes.join(found, "key", "left").select("key", "class_size", F.coalesce("component_id", "rep").alias("component_id"))
    out = rows.where("key is not null and id is not null").join(named, "key")
    alone = rows.where("key is null or id is null").select("key", "id", "n", F.lit(1).cast("long").alias("class_size"), F.col("id").alias("component_id"))
    return out.unionByName(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("key").alias("class_key"), "class_size")


def jaccard_pairs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Rule = Rule()) -> DataFrame:
    """Representative pairs (id_a, id_b), id_a < id_b, each once and each at the threshold or above by the whole sets.

    They connect every component. A component of m rows has m*(m-1)/2 links at most, so neither all
    links nor their number by row are given. A class stands for its equal texts by its smallest id, to which each of the others is a pair.
    """
    rows, classes, edges, _ = _join(df, id_col, text_col, rule)
    rep = classes.select("key", "rep")
    between = edges.join(rep.select(F.col("key").alias("u"), F.col("rep").alias("a")), "u").join(rep.select(F.col("key").alias("v"), F.col("rep").alias("b")), "v").select("a", "b")
    copies = rows.where("id is not null").join(rep, "key").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    return between.unionByName(copies).where("a != b").select(F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b")).distinct()


def _edges(docs: DataFrame, classes: DataFrame, pairs: DataFrame, rule: Rule, scratch: Scratch) -> DataFrame:
    """Links between classes, enough of them for the same components as all; ``pairs`` are those of ``_pivot_pairs``."""
    # Pairs between a pivot's classes come later: each of those classes is in a pair with it.
    sets = _sets_of(docs, classes, pairs.select(F.col("u").alias("key")).unionByName(pairs.select(F.col("v").alias("key"))).distinct(), rule, scratch)
    tested = _verify(sets, pairs, rule, scratch)
    scratch.drop(pairs)
    done = tested.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    edges = tested.where("linked").select("u", "v")
    k = lambda x, y: f"({rule.den - rule.num} * ({x} + {y}) div {rule.den + rule.num})"
    # Classes with an equal minimum are compared with the next in line: a linear number of pairs, which leaves few components.
    left = _mixed(tested, edges, scratch)
    own = left.select("v", "u", "n", "d", "c", F.posexplode("sketch").alias("i", "low"))
    line = Window.partitionBy("v", "i", "low").orderBy("d", "u")
    before = own.withColumns({f"{x}0": F.lag(x).over(line) for x in ("u", "n", "d", "c")})
    near = before.where(f"c != c0 and abs(n - n0) <= {k('n', 'n0')} and abs(d - d0) <= {k('n', 'n0')}")
    near = near.select(F.least("u", "u0").alias("u"), F.greatest("u", "u0").alias("v")).distinct().join(done, ["u", "v"], "left_anti")
    more = _verify(sets, scratch.keep(near, "near"), rule, scratch)
    scratch.drop(left)
    edges = edges.unionByName(more.where("linked").select("u", "v"))
    done = done.unionByName(more.select("u", "v"))
    left = _mixed(tested, edges, scratch)
    if not left.isEmpty():
        left = scratch.keep(left.select("u", "v", "linked", "c"), "left")
        # Rows of some KB.
        common = _small(_common(sets, left, scratch), 2_000)
        parts = scratch.keep(left.groupBy("v").agg(F.ceil(F.count("*") / PART).alias("parts")).where("parts > 1"), "parts")
        rows = _with_sets(sets, left).join(common, "v", "left").join(_small(parts), "v", "left").select("u", "v", "linked", "c", F.coalesce("parts", F.lit(1)).alias("parts"), "common", "x", "y")
        rows = rows.mapInArrow(_differences(rule), "pivot long, part long, key long, n long, d long, near boolean, c long, elements binary, places binary")
        rest = rows.groupBy("pivot", "part").applyInArrow(_fellows(rule), "u long, v long").distinct()
        last = _verify(sets, scratch.keep(rest.join(done, ["u", "v"], "left_anti"), "rest"), rule, scratch)
        edges = edges.unionByName(last.where("linked").select("u", "v"))
    edges = scratch.keep(edges, "links")
    scratch.drop(sets)
    return edges


def _pivot_pairs(sigs: DataFrame, scratch: Scratch) -> DataFrame:
    """(u, v): each class of a bucket with a pivot v that all classes of the bucket are compared with.

    Signature rows cross one exchange. Those that two classes or more have make the buckets, and buckets of the same classes are one group, named by
    a hash of its classes; there are far fewer groups, so what follows is on small tables. A class that shares fewer signatures of a band than any partner
    must is out of that band. A group's pivot is the class with the most bucket fellows, ties go to the greater key.
    """
    by_sig = Window.partitionBy("sig")
    known = sigs.withColumn("last", F.lag("key").over(by_sig.orderBy("key"))).where("last is null or last != key").drop("last")
    buckets = known.withColumns({"m": F.count("*").over(by_sig), "g": F.bit_xor(F.xxhash64("key")).over(by_sig)}).where("m > 1")
    groups = scratch.keep(buckets.groupBy("g", "key", "info").agg(F.count("*").alias("n"), F.sum("m").alias("m")), "groups")
    # A class has rows in two bands at most.
    stats = groups.groupBy("key", "info").agg(F.sum("n").alias("n"), F.sum("m").alias("w")).where("n >= info & 65535")
    stats = scratch.keep(stats.select("key", "info", F.sum("w").over(Window.partitionBy("key")).alias("w")), "stats")
    by_group = Window.partitionBy("g")
    left = groups.join(_small(stats), ["key", "info"]).select("g", "key", "w")
    left = left.withColumns({"p": F.max(F.struct("w", "key")).over(by_group), "least": F.min("key").over(by_group), "most": F.max("key").over(by_group)}).where("least != most").select("g", "key", "p")
    before, groups = groups, scratch.keep(left, "pivots")
    scratch.drop(before)
    scratch.drop(stats)
    best = scratch.keep(groups.groupBy("key").agg(F.max("p").alias("best")), "best")
    # A class is compared with the heaviest of its pivots, and with a group's own only where the fellows there differ in that.
    met = groups.join(_small(best), "key").select("g", "key", F.col("p.key").alias("own"), F.col("best.key").alias("best"))
    split = scratch.keep(met.groupBy("g").agg(F.min("best").alias("lo"), F.max("best").alias("hi")).where("lo != hi").select("g"), "split")
    pairs = met.select("key", F.col("best").alias("v")).unionByName(met.join(_small(split), "g", "left_semi").select("key", F.col("own").alias("v")))
    pairs = scratch.keep(pairs.where("key != v").select(F.col("key").alias("u"), "v").distinct(), "pairs")
    scratch.drop(split)
    scratch.drop(groups)
    scratch.drop(best)
    return pairs


#: Elements a task names for a pivot as common, and the differences it holds before it counts them.
COMMON, HELD = 512, 1 << 20


def _common(sets: DataFrame, left: DataFrame, scratch: Scratch) -> DataFrame:
    """(v, common): for pivots with many classes, elements in which many of them differ from it, the commonest last.

    Each task counts what it meets and names a bounded number of elements by pivot. This only orders elements, so what
    it misses costs time and no link.
    """
    many = left.groupBy("v").agg(F.count("*").alias("m")).where("m >= 32")

    def counted(vs: list, es: list) -> Iterator[pa.RecordBatch]:
        v = np.repeat(np.array(vs, np.int64), [len(e) for e in es])
        e = np.concatenate(es)
        order = np.lexsort((e, v))
        v, e = v[order], e[order]
        heads = np.flatnonzero(np.r_[True, (v[1:] != v[:-1]) | (e[1:] != e[:-1])])
        n = np.diff(np.r_[heads, len(e)])
        v, e, n = v[heads][n > 2], e[heads][n > 2], n[n > 2]
        order = np.lexsort((e, -n, v))
        v, e, n = v[order], e[order], n[order]
        place = np.arange(len(v)) - np.searchsorted(v, v)
        top = place < COMMON
        if top.any():
            yield pa.RecordBatch.from_arrays([pa.array(v[top]), pa.array(e[top]), pa.array(n[top])], names=["v", "element", "n"])

    def run(batches):
        vs, es, held = [], [], 0
        for b in batches:
            for v, (x, y) in zip(b.column("v").to_pylist(), _sorted_sets(b)):
                vs.append(v)
                es.append(np.concatenate([x[~_in(x, y)], y[~_in(y, x)]]).view(np.int64))
                held += len(es[-1])
                if held > HELD:
                    yield from counted(vs, es)
                    vs, es, held = [], [], 0
        if vs:
            yield from counted(vs, es)

    # A pivot's classes lie together, HELD // 256 at most by expectation, so that a task sees what they have in common.
    part = F.pmod(F.xxhash64("u"), F.ceil(F.col("m") / (HELD // 256)))
    some = scratch.keep(left.join(many, "v").select("u", "v", part.alias("part")), "some")
    met = _with_sets(sets, some).repartition("v", "part").select("v", "x", "y").mapInArrow(run, "v long, element long, n long")
    often = met.groupBy("v", "element").agg(F.sum("n").alias("n"))
    # The more tasks name elements for a pivot, the more of them repeat each other; the commonest of all are kept.
    rank = F.row_number().over(Window.partitionBy("v").orderBy(F.desc("n"), "element"))
    often = often.withColumn("rank", rank).where(F.col("rank") <= 2 * COMMON)
    return scratch.keep(often.groupBy("v").agg(F.sort_array(F.collect_list(F.struct("n", "element"))).alias("e")).select("v", F.col("e.element").alias("common")), "common")


def _mixed(tested: DataFrame, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of ``tested`` whose pivot v meets classes of more than one component, with c, the component of u."""
    comp = scratch.keep(components(edges, scratch), "comp")
    placed = tested.join(comp.select(F.col("node").alias("u"), F.col("component").alias("c")), "u", "left").join(comp.select(F.col("node").alias("v"), F.col("component").alias("cv")), "v", "left")
    placed = scratch.keep(placed.withColumns({"c": F.coalesce("c", "u"), "cv": F.coalesce("cv", "v")}), "placed")
    pivots = placed.groupBy("v").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo != hi").select("v")
    out = scratch.keep(placed.join(pivots, "v").drop("cv"), "mixed")
    scratch.drop(comp)
    scratch.drop(placed)
    return out


def keep_one_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Rule = Rule()) -> DataFrame:
    """One row of ``df``, with all columns, for each component: that of the smallest id. Of rows that repeat that id one stays.

    Rows with a null id are in no group and all stay, copies too.
    """
    found = jaccard_components(df, id_col, text_col, rule)
    kept = found.where(F.col(id_col) == F.col("component_id")).groupBy(F.col(id_col).alias("_kept")).agg(F.count("*").alias("_n"))
    kept = Scratch(df.sparkSession, "kept").keep(kept, "ids")
    once, more = (df.join(kept.where(c), df[id_col] == kept["_kept"], "left_semi") for c in ("_n = 1", "_n > 1"))
    return once.unionByName(more.dropDuplicates([id_col])).unionByName(df.where(F.col(id_col).isNull()))
