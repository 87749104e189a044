"""Benchmark decontamination with a generalised suffix automaton of the normalised test items.

Items and documents become words of lowered ASCII letters and digits and any non-ASCII characters. The automaton
accepts every run of words of any item. Streaming a document's words through it gives, at each word, the longest
run ending there that some item has; a run of ``window`` words or more is hit whole, and so is an occurrence of a
whole item that is shorter than a window. Words that can't be part of a hit never reach the automaton: a
vectorised test first finds runs whose neighbouring pairs all occur in items.

Items become a written table of word hashes, equal items one row with all their ids, dealt by hash into blocks of about ``block_words`` words (an item is never cut).
The driver reads ``PASS`` blocks at a time and broadcasts them; a task builds an automaton of each. So many blocks are one pass over the
documents, without a shuffle; where there are more, a pass writes the documents with the spans found so far and the next one
adds its own. What the driver and a task hold is some ``block_words`` words a block, or the longest item where that has more, and the ids of those items: copies of an item
add their ids only. Words are compared by hash (see ``tokens``).

Nulls and texts without a word have no hits. Items without a word or text have no window; items with a null id
count for hits but aren't listed. Repeated items share their windows and are all listed. Repeated documents get equal results. Columns
of ``df`` that aren't named are kept by ``decontaminate`` (but ``_spans``, which it uses itself) and not read by ``find_contamination``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.scratch import Scratch
from quillon.llm.tokens import ALNUM, Chunk, Words, chunks, mix

_U = np.uint64
#: Ids and words.
Item = tuple[tuple[str, ...], tuple[int, ...]]
#: Blocks of items in one pass over the documents.
PASS = 4


class SuffixAutomaton:
    """All word runs of the items; ``reach[v]`` is the state whose class holds the run of ``window`` words that ends v's runs."""

    def __init__(self, items: tuple[Item, ...], window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        ends: dict[int, set[int]] = {}
        by_words: dict[tuple[int, ...], list[str]] = {}
        for names, words in items:
            by_words.setdefault(words, []).extend(names)
        #: Names of each distinct item; elsewhere items are numbers.
        self.names = [tuple(x) for x in by_words.values()]
        items = tuple(enumerate(by_words))
        for name, words in items:
            v = 0
            for x in words:
                v = self._extend(v, x)
                ends.setdefault(v, set()).add(name)
        order = sorted(range(1, len(self.link)), key=self.length.__getitem__)
        # Only states of a window or more need their items, so none is handed up to shorter ones: sizes add up to the number of windows.
        owners: dict[int, set[int]] = {v: names for v, names in ends.items() if self.length[v] >= window}
        for v in reversed(order):
            if v in owners and self.length[self.link[v]] >= window:
                owners.setdefault(self.link[v], set()).update(owners[v])
        self.reach = [0] * len(self.link)
        self.short: list[tuple[tuple[int, int], ...]] = [()] * len(self.link)
        at_state: dict[int, list[tuple[int, int]]] = {}
        for name, words in items:
            if 0 < len(words) < window:
                v = 0
                for x in words:
                    v = self.next[v][x]
                at_state.setdefault(v, []).append((len(words), name))
        for v in order:
            up = self.link[v]
            if self.length[v] >= window:
                self.reach[v] = v if self.length[up] < window else self.reach[up]
            self.short[v] = self.short[up] + tuple(at_state.get(v, ()))
        self.owners = {v: frozenset(owners[v]) for v in set(self.reach) if v}

    def _extend(self, last: int, x: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if x in nxt[last]:
            q = nxt[last][x]
            return q if length[q] == length[last] + 1 else self._clone(last, q, x)
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and x not in nxt[p]:
            nxt[p][x] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][x]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, q, x)
        return cur

    def _clone(self, p: int, q: int, x: int) -> int:
        new = len(self.next)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = new
        while p >= 0 and self.next[p].get(x) == q:
            self.next[p][x] = new
            p = self.link[p]
        return new

    def scan(self, words: list[int], spans: list[list[int]], names: set[int], base: int) -> None:
        """Adds the hit spans (word positions from ``base``, merged) and the items of one run of words."""
        nxt, link, length, reach, short = self.next, self.link, self.length, self.reach, self.short
        v = n = 0
        for i, x in enumerate(words):
            while v and x not in nxt[v]:
                v = link[v]
                n = length[v]
            if x not in nxt[v]:
                continue
            v = nxt[v][x]
            n += 1
            hit = 0
            if n >= self.window:
                hit = n
                names |= self.owners[reach[v]]
            for k, name in short[v]:
                if n >= k:
                    hit = max(hit, k)
                    names.add(name)
            if hit:
                a = base + i + 1 - hit
                if spans and a <= spans[-1][1]:
                    while len(spans) > 1 and a <= spans[-2][1]:
                        spans.pop()
                    spans[-1] = [min(a, spans[-1][0]), base + i + 1]
                else:
                    spans.append([a, base + i + 1])


class Matcher:
    """Automaton and word-pair test of one block of items."""

    def __init__(self, items: tuple[Item, ...], window: int):
        self.auto = SuffixAutomaton(items, window)
        lengths = [min(len(w), window) for _, w in items if w]
        self.least = min(lengths, default=0)
        known = np.unique(np.array([x for _, w in items for x in w], np.uint64))
        pairs = np.array([x for _, w in items for x in zip(w, w[1:])], np.uint64).reshape(-1, 2)
        self.known = known if self.least == 1 else np.unique(_pair(pairs[:, 0], pairs[:, 1]))
        self.table = np.zeros(1 << 20, bool)
        self.table[(self.known >> _U(44)).astype(np.int64)] = True

    def find(self, h: np.ndarray, w: Words) -> Iterator[tuple[int, list[list[int]], set[str]]]:
        """(row, spans as word indexes of the chunk, item names) of the rows with a hit."""
        if not self.least or not len(h):
            return
        one = self.least == 1
        x = h if one else _pair(h[:-1], h[1:])
        ok = self.table[(x >> _U(44)).astype(np.int64)]
        if not one:
            ok &= w.doc[:-1] == w.doc[1:]
        at = np.flatnonzero(ok)
        at = at[np.isin(x[at], self.known)]
        if not len(at):
            return
        new = np.flatnonzero(np.r_[True, (np.diff(at) != 1) | (w.doc[at[1:]] != w.doc[at[:-1]])])
        row, spans, names = -1, [], set()
        for a, b in zip(at[new], at[np.r_[new[1:], len(at)] - 1]):
            end = int(b) + (1 if one else 2)
            if end - a < self.least:
                continue
            if w.doc[a] != row:
                if spans:
                    yield row, spans, {x for i in names for x in self.auto.names[i]}
                row, spans, names = int(w.doc[a]), [], set()
            self.auto.scan(h[a:end].tolist(), spans, names, int(a))
        if spans:
            yield row, spans, {x for i in names for x in self.auto.names[i]}


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(a * _U(0x9E3779B97F4A7C15) + b)


_built: dict[str, list[Matcher]] = {}


def _matchers(key: str, blocks: list[tuple[Item, ...]], window: int) -> list[Matcher]:
    """Of the pass with this key; a worker keeps those of one pass."""
    if key not in _built:
        _built.clear()
        _built[key] = [Matcher(x, window) for x in blocks]
    return _built[key]


class ItemBlocks:
    """The items' word hashes, written and dealt into blocks of about ``block_words`` words."""

    def __init__(self, items: DataFrame, item_id: str, item_text: str, block_words: int, scratch: Scratch):
        def run(batches):
            for b in batches:
                words = []
                for c in chunks(b.column("t")):
                    w = c.words(ALNUM)
                    h = c.hashes(w).view(np.int64)
                    words += [h[w.first[i] : w.first[i + 1]] for i in range(c.hi - c.lo)]
                yield pa.RecordBatch.from_arrays([b.column("i"), pa.array(words, pa.list_(pa.int64()))], names=["i", "words"])

        src = items.select(F.col(item_id).cast("string").alias("i"), F.col(item_text).alias("t"))
        each = src.mapInArrow(run, "i string, words array<long>").where("size(words) > 0")
        # A null id is "\0", which is left out where items are listed.
        self.table = scratch.keep(each.groupBy("words").agg(F.sort_array(F.collect_list(F.coalesce("i", F.lit("\0")))).alias("ids")), "items")
        total = self.table.agg(F.sum(F.size("words"))).first()[0] or 0
        self.blocks = max(1, -(-total // block_words))
        self.passes = -(-self.blocks // PASS)

    def read(self, number: int) -> tuple[str, list[tuple[Item, ...]]]:
        """A key and the blocks of one pass."""
        block = F.pmod(F.xxhash64("words"), F.lit(self.blocks))
        blocks: dict[int, list[Item]] = {}
        for r in self.table.withColumn("b", block).where(F.floor(F.col("b") / PASS) == number).toArrow().to_pylist():
            blocks.setdefault(r["b"], []).append((tuple(r["ids"]), tuple(x & 0xFFFFFFFFFFFFFFFF for x in r["words"])))
        return uuid.uuid4().hex, [tuple(sorted(blocks[k])) for k in sorted(blocks)]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def _hits(c: Chunk, matchers: list[Matcher]) -> tuple[Words, dict[int, tuple[list, set]]]:
    """Words of a chunk and, for its rows with a hit, merged spans of word numbers in the row and item names."""
    w = c.words(ALNUM)
    h = c.hashes(w)
    found: dict[int, tuple[list, set]] = {}
    for m in matchers:
        for row, spans, names in m.find(h, w):
            s, n = found.get(row, ([], set()))
            at = int(w.first[row])
            found[row] = (_merged([*s, *((a - at, b - at) for a, b in spans)]), n | names)
    return w, found


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _span_lists(spans: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], _SPANS)


def _earlier(b: pa.RecordBatch, column: str, number: int) -> list[list[tuple[int, int]]]:
    """Spans that earlier passes found."""
    return [[(x["start"], x["end"]) for x in s] for s in b.column(column).to_pylist()] if number else [[] for _ in range(b.num_rows)]


def find_contamination(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 13, block_words: int = 200_000) -> DataFrame:
    """One row per input row: id, n_words, n_hit, item_ids (array of strings, sorted) and spans (array of structs: hit word positions, start included, end not)."""
    scratch = Scratch(df.sparkSession, "decontaminate")
    blocks = ItemBlocks(items, item_id, item_text, block_words, scratch)
    kind = df.schema[id_col].dataType.simpleString()
    out = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def step(number: int):
        shared = df.sparkSession.sparkContext.broadcast(blocks.read(number))
        last = number == blocks.passes - 1

        def run(batches):
            matchers = _matchers(*shared.value, window)
            for b in batches:
                n_words, spans = [], _earlier(b, "spans", number)
                names = [set(x) for x in b.column("item_ids").to_pylist()] if number else [set() for _ in spans]
                for c in chunks(b.column("text")):
                    w, found = _hits(c, matchers)
                    n_words += np.diff(w.first).tolist()
                    for i, (s, n) in found.items():
                        spans[c.lo + i] = _merged([*spans[c.lo + i], *s])
                        names[c.lo + i] |= n - {"\0"}
                hit = [b.column("id"), pa.array([sorted(x) for x in names], pa.list_(pa.string())), _span_lists(spans)]
                if last:
                    n_hit = [sum(y - x for x, y in s) for s in spans]
                    yield pa.RecordBatch.from_arrays([hit[0], pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), *hit[1:]], names=["id", "n_words", "n_hit", "item_ids", "spans"])
                else:
                    yield pa.RecordBatch.from_arrays([hit[0], b.column("text"), *hit[1:]], names=["id", "text", "item_ids", "spans"])

        return run, f"id {kind}, {'n_words long, n_hit long' if last else 'text string'}, item_ids array<string>, spans array<struct<start:long,end:long>>"

    for number in range(blocks.passes - 1):
        before, out = out, scratch.keep(out.mapInArrow(*step(number)), "marked")
        scratch.drop(before)
    return out.mapInArrow(*step(blocks.passes - 1)).withColumnRenamed("id", id_col)


def decontaminate(df: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 13, coverage: tuple[int, int] = (1, 20), block_words: int = 200_000) -> DataFrame:
    """The rows of ``df``, all columns: hit spans go from the text, and a row whose share of hit words is ``coverage`` or more goes whole.

    A removed span reaches from its first word's first byte to its last word's last byte.
    """
    scratch = Scratch(df.sparkSession, "decontaminate")
    blocks = ItemBlocks(items, item_id, item_text, block_words, scratch)
    num, den = coverage
    columns = df.columns
    k = columns.index(text_col)

    def step(number: int):
        shared = df.sparkSession.sparkContext.broadcast(blocks.read(number))
        last = number == blocks.passes - 1

        def run(batches):
            matchers = _matchers(*shared.value, window)
            for b in batches:
                text, spans = b.column(k), _earlier(b, "_spans", number)
                keep, changed = np.ones(len(text), bool), {}
                for c in chunks(text):
                    w, found = _hits(c, matchers)
                    for i, (s, _) in found.items():
                        spans[c.lo + i] = _merged([*spans[c.lo + i], *s])
                    for i in range(c.hi - c.lo) if last else ():
                        if spans[c.lo + i]:
                            rest = _without_spans(c, w, i, spans[c.lo + i], num, den)
                            keep[c.lo + i] = rest is not None
                            changed[c.lo + i] = rest
                cols = [b.column(j) for j in range(len(columns))]
                if not last:
                    yield pa.RecordBatch.from_arrays([*cols, _span_lists(spans)], names=[*columns, "_spans"])
                    continue
                if changed:
                    cols[k] = pa.array([changed.get(i, x) for i, x in enumerate(text.to_pylist())], text.type)
                yield pa.RecordBatch.from_arrays(cols, names=columns).filter(pa.array(keep))

        return run, df.schema if last else df.withColumn("_spans", F.lit(None).cast("array<struct<start:long,end:long>>")).schema

    out = df
    for number in range(blocks.passes - 1):
        before, out = out, scratch.keep(out.mapInArrow(*step(number)), "marked")
        scratch.drop(before)
    return out.mapInArrow(*step(blocks.passes - 1))


def _without_spans(c: Chunk, w: Words, i: int, spans: list[tuple[int, int]], num: int, den: int) -> str | None:
    """A row's text without its hit spans, or none where they're num / den of its words or more."""
    first = int(w.first[i])
    if den * sum(y - x for x, y in spans) >= num * (int(w.first[i + 1]) - first):
        return None
    at, parts = int(c.offsets[i]), []
    for x, y in spans:
        parts.append(c.data[at : w.start[first + x]].tobytes())
        at = int(w.end[first + y - 1])
    parts.append(c.data[at : c.offsets[i + 1]].tobytes())
    return b"".join(parts).decode()
