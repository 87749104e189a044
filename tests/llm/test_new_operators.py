"""Byte-level BPE, vector codes and phrases beside plain versions, with their edge cases; words that no hash may take for equal."""

import base64
import itertools
import random
import re
import tracemalloc
from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import tiktoken
from pyspark.sql import functions as F

from quillon.llm import byte_bpe, decontaminate, jaccard_join, language_model, phrases, queries, sentencepiece_sampling, skew, tokens, vector_codes
from quillon.llm.queries import PIECE_MODEL

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SF = "/root/testdata/sf0.001"


# --- byte-level BPE ---------------------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    rng = random.Random(4)
    letters = ["ab", "aab ", "éül", "中文字", "0123", "'s't'll've ", "\n \t", "!?.", "\U0001f600\U0001f1e9", "the ", "ing", "  ", "\x00\x7f", "<|endoftext|>"]
    out = [None, "", " ", "\n", "<|endoftext|>", "a" * 7000, "ab" * 4000, " " * 900, "=-" * 700, "don't we'll 'sky''s", "".join(rng.choice("abcdefghij") for _ in range(30_000))]
    out += ["".join(rng.choice(rng.choice(letters)) for _ in range(rng.randrange(1, 150))) for _ in range(600)]
    vocabulary = [*byte_bpe.vocabulary(open(RANKS, "rb").read()).ranks]
    out += [b"".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 14))).decode("utf-8", "replace") for _ in range(400)]
    return [*out, b"".join(rng.choice(vocabulary) for _ in range(9000)).decode("utf-8", "ignore").replace(" ", "")]


def test_bpe_equals_the_library_and_decodes(spark, library, monkeypatch):
    texts = odd_texts()
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*texts, *texts[:20]])], "doc_id long, text string, ids string")
    out = byte_bpe.encode(df, RANKS, public_tokenizers.PATTERN, decoded_col="decoded")
    assert out.columns == ["doc_id", "text", "ids", "decoded"]
    got = out.collect()
    assert len(got) == len(texts) + 20
    for r in got:
        assert r["ids"] == (None if r["text"] is None else library.encode_ordinary(r["text"]))
        assert r["decoded"] == (None if r["text"] is None else r["text"].encode())
    again = byte_bpe.decode(out.select("doc_id", "ids", F.lit("x").alias("decoded"), "text"), RANKS).collect()
    assert all(r["decoded"] == (None if r["text"] is None else r["text"].encode()) for r in again)
    assert byte_bpe.encode(df.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_long_texts_are_cut_where_no_match_goes_on(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "LONG", 50)
    monkeypatch.setattr(byte_bpe, "KEPT", 200)
    encoder = byte_bpe.Encoder(byte_bpe.vocabulary(open(RANKS, "rb").read()), public_tokenizers.PATTERN)
    texts = odd_texts()
    for lo in range(0, len(texts), 100):  # what a worker keeps is dropped again and again
        ids, first = encoder.encode(texts[lo : lo + 100])
        for i, t in enumerate(texts[lo : lo + 100]):
            assert ids[first[i] : first[i + 1]].tolist() == library.encode_ordinary(t or "")


def test_rank_queue_pops_in_order():
    queue, rng = byte_bpe.RankQueue(50_000), random.Random(1)
    put = {}
    for _ in range(200):
        r = np.array([rng.choice([0, 63, 64, 4095, 4096, 49_999, rng.randrange(50_000)]) for _ in range(5)])
        p = np.array([rng.randrange(1000) for _ in range(5)])
        queue.push(r, p)
        for a, b in zip(r.tolist(), p.tolist(), strict=True):
            put.setdefault(a, set()).add(b)
    popped = []
    while (x := queue.pop()) is not None:
        popped.append(x[0])
        assert set(x[1].tolist()) == put[x[0]]
    assert popped == sorted(put)


def test_op11_equals_the_library(spark, library):
    docs = {r["doc_id"]: r["text"] or "" for r in queries.table(spark, SF, "documents").collect()}
    got = queries.op11_byte_bpe(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode_ordinary(docs[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256(docs[r["doc_id"]].encode()).hexdigest())


# --- vector codes -----------------------------------------------------------------------------------------------------
def brute_codes(vectors, parts, entries, rounds):
    """{row: (codes, error)} and codebooks of (id, vector) rows, by the definition over all rows."""
    ints = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in vectors]
    order = sorted(ints, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(order[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v in order[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    best = lambda v, p: min((far(cut(v, p), e), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        new = []
        for p in range(parts):
            groups = {}
            for _, v in ints:
                groups.setdefault(best(v, p)[1], []).append(cut(v, p))
            new.append([[sum(c) // len(c) for c in zip(*groups[k], strict=True)] if k in groups else e for k, e in enumerate(books[p])])
        books = new
    found = [[best(v, p) for p in range(parts)] for _, v in ints]
    return [([k for _, k in f], sum(d for d, _ in f)) for f in found], books


@pytest.mark.parametrize("share", [2000, 3])
def test_codes_equal_brute_force(spark, share, monkeypatch):
    monkeypatch.setattr(skew, "SHARE", share)
    monkeypatch.setattr(vector_codes, "CELLS", 60)
    rng = random.Random(6)
    few = lambda: [rng.choice([-0.5, -1 / 256, 0.0, 0.3, 1.5, rng.uniform(-1, 1)]) for _ in range(8)]
    vectors = [(rng.choice([*range(40), None]), few()) for _ in range(60)] + [(7, [0.25] * 8)] * 40
    bad = [(1, None), (2, [0.1] * 7 + [None]), (3, [float("nan")] * 8), (4, [float("inf")] + [0.0] * 7)]
    unlike = [(500, [0.1] * 16), (501, []), (502, [0.1] * 7), (503, [1e30] * 8)]
    rows = [(i, v, rng.choice(["a", "a", None]), 9) for i, v in (*vectors, *bad, *unlike)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string, codes int").withColumns({"number": F.lit(1), "error": F.lit("x"), "weight": F.lit(1)}).repartition(5)
    out = vector_codes.compress(df, parts=4, entries=6)
    want, books = brute_codes(vectors, 4, 6, 2)
    assert out.codebooks.tolist() == books
    got = out.rows.collect()
    assert out.rows.columns == ["vec_id", "embedding", "label", "number", "weight", "codes", "error"]
    key = lambda i, v, c, e: (str(i), str(v), str(c), e)
    coded = sorted(key(r["vec_id"], r["embedding"], r["codes"], r["error"]) for r in got if r["codes"] is not None)
    assert coded == sorted(key(i, v, c, e) for (i, v), (c, e) in zip(vectors, want, strict=True))
    assert sorted(r["vec_id"] for r in got if r["codes"] is None and r["error"] is None) == [500, 501, 502, 503]
    totals = Counter()
    for r in got:
        totals[r["label"]] += r["error"] or 0
    grouped = vector_codes.group_errors(out.rows, "label", "weight").collect()
    assert len(grouped) == len(got) and all(r["weight"] == totals[r["label"]] for r in grouped)


def test_few_or_no_vectors(spark):
    kind = "vec_id long, embedding array<float>"
    assert vector_codes.compress(spark.createDataFrame([], kind)).rows.count() == 0
    assert vector_codes.compress(spark.createDataFrame([(1, None)], kind)).rows.count() == 0
    got = vector_codes.compress(spark.createDataFrame([(3, [0.5] * 16), (1, [-0.5] * 16)], kind))
    assert got.codebooks.shape == (16, 2, 1) and {r["vec_id"]: (r["codes"], r["error"]) for r in got.rows.collect()} == {3: ([1] * 16, 0), 1: ([0] * 16, 0)}
    far = vector_codes.compress(spark.createDataFrame([(1, [1e30] * 16)], kind)).rows.collect()
    assert [(r["vec_id"], r["codes"], r["error"]) for r in far] == [(1, None, None)]


def test_lookup_by_heavy_and_light_keys(spark):
    left = spark.createDataFrame([(k, i) for i, k in enumerate([None] * 50 + ["a"] * 30 + ["b"] * 2 + ["c", "none"])], "k string, i int")
    right = spark.createDataFrame([(None, 50, 0), ("a", 30, 1), ("b", 2, 2), ("c", 1, 3)], "of string, uses long, v int")
    got = skew.lookup(left, right, {"k": "of"}, "uses", 84, share=4)
    assert got.columns == ["k", "i", "v"] and Counter(r["v"] for r in got.collect()) == {0: 50, 1: 30, 2: 2, 3: 1}


# --- phrases ----------------------------------------------------------------------------------------------------------
def brute_phrases(rows, longest, least, inside, top):
    n, f = Counter(), {}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\\x0a-\\x0d]", text):
            w = re.findall("[^\\x20\\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, longest + 1):
                f.setdefault(lang, Counter()).update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, count in f.items():
        many = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        best = []
        for p, a in many.items():
            parts = [(p[i:j], a) for i in range(len(p)) for j in range(i + 1, len(p) + 1)]
            assert parts
            if any(len(q) > len(p) and 100 * b >= inside * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in many.items()):
                continue
            score, k = min((2_000_000 * a // (count[p[:k]] + count[p[k:]]), k) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        out += [(lang, i, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(best)[:top], 1)]
    return sorted(out)


def phrase_rows(df, **how):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in phrases.mine_phrases(df, **how).collect())


def test_automata_of_a_shard_whose_phrases_all_pass_stay_small(monkeypatch):
    """As a corpus grows more of a shard's phrases pass: memory is of one automaton, whatever their number."""
    sizes, plain = [], phrases.ahocorasick.Automaton

    def kept(kind):
        class Kept:
            def __init__(self):
                self.own = plain(kind)
                self.add_word, self.iter = self.own.add_word, self.own.iter

            def make_automaton(self):
                self.own.make_automaton()
                sizes.append(self.own.get_stats()["total_size"])

        return Kept()

    monkeypatch.setattr(phrases.ahocorasick, "Automaton", kept)
    rng = np.random.default_rng(3)
    text = " ".join(f"w{i}" for i in (rng.zipf(1.3, 150_000) % 30_000).tolist())
    ids, words, lang = phrases._number(["en"], [text.encode()])
    row = {"ids": ids.tobytes(), "words": words, "langs": ["en"], "lang_of": lang}
    cells = phrases._own_cells(phrases._cells(row, 4, 40)[2])[0]
    row["passed"] = [{"bits": np.packbits(np.ones(len(cells), bool)).tobytes(), "size": len(cells)}]
    total = sum(int(count.sum()) for _, count in phrases._count(row, 4, 40))
    assert total == 4 * 150_000 - 6
    assert max(sizes) < 16 << 20


def test_a_shard_whose_phrases_all_pass_is_counted_in_little_memory(monkeypatch):
    """A phrase that is alone in its cell isn't put into an automaton, and a length that is done needs no memory."""
    added, plain = [], phrases.ahocorasick.Automaton

    class Kept:
        def __init__(self, kind):
            own = plain(kind)
            self.make_automaton, self.iter = own.make_automaton, own.iter
            self.add_word = lambda word, i: added.append(1) or own.add_word(word, i)

    monkeypatch.setattr(phrases.ahocorasick, "Automaton", Kept)
    rng = np.random.default_rng(4)
    words = (rng.zipf(1.3, 150_000) % 30_000).tolist()
    ids, names, lang = phrases._number(["en"], [" ".join(f"w{i}" for i in words).encode()])
    row = {"ids": ids.tobytes(), "words": names, "langs": ["en"], "lang_of": lang}
    cells = phrases._own_cells(phrases._cells(row, 4, 40)[2])[0]
    row["passed"] = [{"bits": np.packbits(np.ones(len(cells), bool)).tobytes(), "size": len(cells)}]
    want = Counter(tuple(words[i : i + n]) for n in (1, 2, 3, 4) for i in range(len(words) - n + 1))
    tracemalloc.start()
    try:
        before = tracemalloc.get_traced_memory()[0]
        got, seen = 0, 0
        for part, count in phrases._count(row, 4, 40):
            got, seen = got + len(part), seen + int((count == 1).sum())
        peak = tracemalloc.get_traced_memory()[1] - before
    finally:
        tracemalloc.stop()
    assert got == len(want) and seen == sum(f == 1 for f in want.values())
    assert len(added) <= sum(f > 1 for p, f in want.items() if len(p) > 1) + 9
    assert peak < 44 << 20, peak


def test_batches_for_python_workers_are_bounded_by_bytes(spark):
    key, many = "spark.sql.execution.arrow.maxBytesPerBatch", lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"]) for b in batches)
    df = spark.range(0, 60, 1, 1).select(F.repeat(F.lit("x"), 100_000).alias("x"))
    was = spark.conf.get(key, None)
    with phrases._batches(spark, 1_000_000):
        assert max(r["n"] for r in df.mapInArrow(many, "n long").collect()) <= 11
    assert spark.conf.get(key, None) == was


@pytest.mark.parametrize("small", [False, True])
def test_phrases_equal_brute_force(spark, small, monkeypatch):
    if small:  # many shards, ranges and automata
        for name, value in (("SHARD_BYTES", 300), ("RANGE_ENTRIES", 200), ("AUTOMATON", 7), ("FILTER_BITS", 4)):
            monkeypatch.setattr(phrases, name, value)
    rng = random.Random(8)
    vocabulary = ["a", "B", "the", "of", "Köln", "köln", "x1", " ", "\U0001f600", "-", "'", "w" * 300]
    sentence = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" "] * 8 + ["  ", "\t", ". ", ",", "!\n", "\x0b", " ; "]) for _ in range(n))
    rows = [(rng.choice(["en", "de", None, "und"]), sentence(rng.randrange(60))) for _ in range(60)]
    rows += [("en", "new york city hall, new york"), ("en", None), (None, ""), ("de", "... ,,"), ("fr", "one"), ("en", sentence(3000))] + [("en", "deep learning model zoo")] * 9
    df = spark.createDataFrame(rows, "lang string, text string").withColumns({"phrase": F.lit("x"), "f": F.lit(1), "size": F.lit("y")}).repartition(3)
    for how in ({"longest": 4, "least": 4, "inside": 80, "top": 2000}, {"longest": 3, "least": 3, "inside": 50, "top": 5}):
        want = brute_phrases(rows, **how)
        assert phrase_rows(df, **how) == want and len(want) > 10
    assert phrase_rows(df.limit(0)) == [] and phrase_rows(df.select(F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("text"))) == []


def test_cells_that_collide_lose_nothing(spark, monkeypatch):
    """All phrases of a length in a handful of cells: bounds are far too high, counts are right."""
    plain = phrases._cells

    def few(row, longest, bits):
        ids, places, cells = plain(row, longest, bits)
        return ids, places, [c % np.uint64(3) for c in cells]

    monkeypatch.setattr(phrases, "_cells", few)
    rng = random.Random(9)
    row = {"langs": ["en"], "words": [f"w{i}" for i in range(9)], "lang_of": np.zeros(9, np.int32), "ids": np.array([rng.choice([*range(9), -1]) for _ in range(500)], np.int32).tobytes()}
    own, _ = phrases._own_cells(few(row, 3, 40)[2])
    row["passed"] = [{"bits": np.packbits(np.ones(len(own), bool)).tobytes(), "size": len(own)}]
    got = {tuple(x for x in p.tolist() if x >= 0): int(n) for part, count in phrases._count(row, 3, 40) for p, n in zip(part, count, strict=True)}
    ids, want = np.frombuffer(row["ids"], np.int32).tolist(), Counter()
    for n in (1, 2, 3):
        want.update(tuple(ids[i : i + n]) for i in range(len(ids) - n + 1) if -1 not in ids[i : i + n])
    assert got == want


def test_packs_round_trip():
    rng = np.random.default_rng(1)
    for n in (1, 2, 1000):
        cells = np.unique(rng.integers(0, 1 << 50, n).astype(np.uint64))
        counts = rng.integers(1, 70_000, len(cells))
        a, b = phrases._unpack(phrases._pack(cells, counts))
        assert (a == cells).all() and (b == counts).all()


# --- words that are told apart ----------------------------------------------------------------------------------------
def two_words(n):
    """A word over two letters by the number of ones in each place's binary digits, and the same with the letters swapped: equal under any polynomial modulo 2**64 from 1,024 letters on."""
    a = "".join("ab"[i.bit_count() & 1] for i in range(n))
    return a, a.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [1024, 2048, 4096])
@pytest.mark.parametrize("fold", [True, False])
def test_hashes_tell_long_words_apart(n, fold):
    c = next(tokens.chunks(pa.array([" ".join(two_words(n)), two_words(n)[1]])))
    h = c.hashes(c.words(), fold)
    assert h[0] != h[1] and h[1] == h[2]


def test_operators_tell_long_words_apart(spark):
    a, b = two_words(1024)
    df = spark.createDataFrame([(1, a), (2, b), (3, f"{a} {b}"), (4, a)], "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_components(df).collect()} == {1: 1, 2: 2, 3: 3, 4: 1}
    hits = decontaminate.find_contamination(df, spark.createDataFrame([(9, a)], "item_id long, text string"))
    assert {r["doc_id"]: r["n_hit"] for r in hits.collect()} == {1: 1, 2: 0, 3: 1, 4: 1}
    scored = language_model.score_texts(df, F.col("doc_id") == 1).collect()
    assert {r["doc_id"]: r["n_known"] for r in scored} == {1: 2, 2: 1, 3: 2, 4: 2}


def test_copies_of_an_item_add_their_ids_only(spark):
    words = " ".join(f"w{i}" for i in range(13))
    items = spark.range(20_000).selectExpr("id as item_id", f"'{words}' as text").unionByName(spark.createDataFrame([(None, words)], "item_id long, text string"))
    blocks = decontaminate.ItemBlocks(items, "item_id", "text", 2000, decontaminate.Scratch(spark, "items"))
    assert blocks.passes == 1 and blocks.blocks == 1
    _, got = blocks.read(0)
    assert sum(len(w) for b in got for _, w in b) == 13
    found = decontaminate.find_contamination(spark.createDataFrame([(1, f"x {words} y"), (2, "x")], "doc_id long, text string"), items, block_words=2000)
    assert {r["doc_id"]: (r["n_hit"], len(r["item_ids"])) for r in found.collect()} == {1: (13, 20_000), 2: (0, 0)}


def test_pieces_take_keys_of_any_type(spark):
    df = spark.createDataFrame([("k1", "some text here"), ("k2", "some text here"), ("k1", "some text here"), (None, "some text here")], "key string, text string")
    got = sentencepiece_sampling.encode(df, PIECE_MODEL, "key", decoded_col="decoded").collect()
    assert got[0]["pieces"] == got[2]["pieces"] and all(r["decoded"] == "some text here" for r in got)


def test_jaccard_signs_only_the_groups_that_partners_need():
    """Fewer signatures than elements at a similarity of 0.8, and any two linked sets still share as many as the filter asks for, neighbouring bands included."""
    rng, rule = np.random.default_rng(5), jaccard_join.Rule(5, 80, 100)
    for n in (60, 150, 300, 500, 1000):
        assert len(jaccard_join.signatures(np.unique(rng.integers(0, 2**63, n).astype(np.uint64)), rule)[0]) < 0.75 * n
    for rule in (rule, jaccard_join.Rule(4, 85, 100), jaccard_join.Rule(5, 50, 100)):
        for n in [1, 3, 6, 10, 19, 36, 37, 49, 50, 90, 123, 300, 700] * 12:
            a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            k = rule.differ(n, n)
            gone = int(rng.integers(0, k + 1))
            more = int(rng.integers(0, k - gone + 1))
            b = np.unique(np.r_[rng.permutation(a)[gone:], rng.integers(0, 2**63, more).astype(np.uint64)])
            if not len(b) or not rule.linked(np.array(len(np.intersect1d(a, b))), len(a), len(b)):
                continue
            (x, p), (y, q) = jaccard_join.signatures(a, rule), jaccard_join.signatures(b, rule)
            shared = np.intersect1d(x, y)
            stays = lambda s, info, i: np.isin(s[info >> 16 == i], shared).sum() >= (info[info >> 16 == i][0] & 65535)
            assert len(shared) and any(stays(x, p, i) and stays(y, q, i) for i in set((p[np.isin(x, shared)] >> 16).tolist()))


@pytest.mark.parametrize("parts", [1, 3])
def test_jaccard_differences_are_a_row_a_class_and_part(parts):
    """Rows don't grow with the differing elements; no link between classes of different components is missed, and none is named twice in a part."""
    rng, rule = np.random.default_rng(parts), jaccard_join.Rule(5, 80, 100)
    pivot = np.unique(rng.integers(0, 2**63, 200).astype(np.uint64))
    sets = []
    for _ in range(40):
        own = np.r_[rng.permutation(pivot)[: rng.integers(100, 160)], rng.integers(0, 2**63, rng.integers(20, 60)).astype(np.uint64)]
        for _ in range(3):
            sets.append(np.unique(np.r_[rng.permutation(own)[rng.integers(0, 12) :], rng.integers(0, 2**63, rng.integers(0, 12)).astype(np.uint64)]))
    linked = lambda a, b: bool(rule.linked(np.array(len(np.intersect1d(a, b))), len(a), len(b)))
    cols = {"u": range(len(sets)), "v": [-1] * len(sets), "linked": [linked(s, pivot) for s in sets], "c": range(len(sets)), "parts": [parts] * len(sets), "common": [None] * len(sets), "x": [s.tobytes() for s in sets], "y": [pivot.tobytes()] * len(sets)}
    batch = pa.RecordBatch.from_arrays([pa.array(list(x)) for x in cols.values()], names=list(cols))
    rows = pa.Table.from_batches(list(jaccard_join._differences(rule)(iter([batch]))))
    assert len(sets) <= rows.num_rows <= parts * len(sets)
    got = set()
    for i in range(parts):
        pairs = [tuple(r.values()) for b in jaccard_join._fellows(rule)(iter(rows.filter(pc.equal(rows.column("part"), i)).to_batches())) for r in b.to_pylist()]
        assert len(pairs) == len(set(pairs)) and all(u < v for u, v in pairs)
        got |= set(pairs)
    want = {(i, j) for i, j in itertools.combinations(range(len(sets)), 2) if linked(sets[i], sets[j]) and not (cols["linked"][i] and cols["linked"][j])}
    assert want and want <= got
