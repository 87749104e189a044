"""Training-data operators beside brute force, and their edge cases: nulls, empty and long texts, ties, repeats, empty tables, extra columns."""

import itertools
import json
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillon.llm import chat_format, components, decontaminate, jaccard_join, language_model, quality_classifier, quality_rules, scratch, sentencepiece_sampling, sharding, tokens, toxicity, url_filter
from quillon.llm.queries import PIECE_MODEL, TOOLS, URL_RULES, chat_messages, fold

DOCS = "doc_id long, text string"


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), DOCS)


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s or "")


def words(s):
    return re.findall(r"[^\x20\x09-\x0D]+", s or "")


# --- tokens -----------------------------------------------------------------------------------------------------------
def test_words_and_hashes():
    texts = ["The  cat\tsat\n", None, "", "é THE ção", "a" * 3000, "\x0b x\x0c"]
    got = []
    for c in tokens.chunks(pa.array(texts), 10):
        w = c.words()
        h = c.hashes(w)
        got += [h[w.first[i] : w.first[i + 1]].tolist() for i in range(c.hi - c.lo)]
    assert [len(x) for x in got] == [len(words(t)) for t in texts]
    assert got[0][0] == got[3][1] and len({x for g in got for x in g}) == len({lower(x) for t in texts for x in words(t)})


# --- n-gram Jaccard join ----------------------------------------------------------------------------------------------
def brute_components(texts, size, num, den):
    sets = []
    for t in texts:
        w = words(lower(t))
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set()))
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return [(i, len(sets[i]), find(i)) for i in range(len(texts))]


@pytest.mark.parametrize(("size", "num"), [(4, 85), (5, 80), (1, 90)])
def test_jaccard_equals_brute_force(spark, size, num):
    rng = random.Random(size)
    base = [[f"w{rng.randrange(5000)}" for _ in range(n)] for n in (1, 3, 6, 12, 30, 60, 150, 400)]
    texts = [None, "", "  ", "A b C", "a B c"]
    for b in base:
        for k in range(14):
            w = list(b)
            for _ in range(rng.randrange(0, max(2, len(b) // 15) + k // 3)):
                i = rng.randrange(len(w)) if w else 0
                rng.choice([lambda: w.__setitem__(i, f"x{rng.randrange(9)}"), lambda: w.__delitem__(i) if len(w) > 1 else None, lambda: w.insert(i, f"y{rng.randrange(9)}")])()
            texts.append(" ".join(w))
    rng.shuffle(texts)
    df = frame(spark, texts).withColumn("key", F.lit("clash")).withColumn("n", F.lit(1))
    got = jaccard_join.jaccard_components(df, rule=jaccard_join.Rule(size, num, 100))
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == brute_components(texts, size, num, 100)
    kept = jaccard_join.keep_one_each(df, rule=jaccard_join.Rule(size, num, 100))
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {c for _, _, c in brute_components(texts, size, num, 100)}


def test_jaccard_repeats_nulls_and_nothing(spark):
    assert jaccard_join.jaccard_components(spark.createDataFrame([], DOCS)).count() == 0
    t = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(3, t), (3, t), (1, t), (None, t), (5, None)], DOCS)
    assert sorted(((r["doc_id"], r["component_id"]) for r in jaccard_join.jaccard_components(df).collect()), key=str) == sorted([(3, 1), (3, 1), (1, 1), (None, None), (5, 5)], key=str)


def test_jaccard_pairs_are_links_and_connect_components(spark):
    """No partial count of links is given; the pairs given are links, and join what brute force joins."""
    base = [f"w{i}" for i in range(120)]
    texts = [" ".join([*base[:k], f"x{k}", *base[k + 1 :]]) for k in (3, 40, 80, 118)] + [" ".join(base)] * 3 + ["other text of one", None]
    df, rule = frame(spark, texts), jaccard_join.Rule(4, 85, 100)
    assert jaccard_join.jaccard_components(df, rule=rule).columns == ["doc_id", "n_shingles", "component_id", "class_key", "class_size"]
    pairs = [tuple(r) for r in jaccard_join.jaccard_pairs(df, rule=rule).collect()]
    assert len(set(pairs)) == len(pairs) and all(a < b for a, b in pairs)
    for a, b in pairs:
        assert brute_components([texts[a], texts[b]], 4, 85, 100)[1][2] == 0
    parent = list(range(len(texts)))
    for _ in texts:
        for a, b in pairs:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert parent == [c for _, _, c in brute_components(texts, 4, 85, 100)]
    assert jaccard_join.jaccard_pairs(df.limit(0), rule=rule).count() == 0


def test_signatures_are_complete():
    """Any two linked sets share a signature, for random pairs at the threshold."""
    rng = np.random.default_rng(0)
    rule = jaccard_join.Rule(4, 85, 100)
    for n in [1, 2, 5, 7, 9, 14, 25, 33, 80, 200, 700]:
        for _ in range(30):
            a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            cut = rng.integers(0, rule.differ(len(a), len(a)) + 1)
            gone = rng.integers(0, cut + 1)
            b = np.unique(np.r_[a[min(gone, len(a) - 1) :], rng.integers(0, 2**63, cut - gone).astype(np.uint64)])
            i = len(np.intersect1d(a, b))
            if len(b) and rule.linked(np.array(i), len(a), len(b)):
                (x, p), (y, q) = jaccard_join.signatures(a, rule), jaccard_join.signatures(b, rule)
                shared = np.intersect1d(x, y)
                assert len(shared)
                bands = set(p[np.isin(x, shared)] >> 16)
                assert any(np.isin(x[p >> 16 == k], shared).sum() >= (p[p >> 16 == k][0] & 65535) for k in bands)


@pytest.mark.parametrize("seed", [28480, 45633, 49335, 90822])
def test_signature_filter_keeps_both_sides_of_short_pairs(seed):
    """Sets of 30 and 26 shingles, one with many empty groups and one with few: both stay in a band in which they share signatures."""
    rng, rule = np.random.default_rng(seed), jaccard_join.Rule(4, 85, 100)
    a = np.unique(rng.integers(0, 2**63, 30).astype(np.uint64))
    b = np.sort(rng.permutation(a)[:26])
    assert rule.linked(np.array(26), 30, 26)
    (x, p), (y, q) = jaccard_join.signatures(a, rule), jaccard_join.signatures(b, rule)
    shared = np.intersect1d(x, y)
    stays = lambda s, info, k: np.isin(s[info >> 16 == k], shared).sum() >= (info[info >> 16 == k][0] & 65535)
    assert any(stays(x, p, k) and stays(y, q, k) for k in set((p[np.isin(x, shared)] >> 16).tolist()))


def test_components_of_chains_and_stars(spark):
    e = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 140)] + [(7, 7)]
    got = components.components(spark.createDataFrame(e, "u long, v long"), scratch.Scratch(spark, "t"))
    assert {(r["node"], r["component"]) for r in got.collect()} == {(i, 0) for i in range(41)} | {(i, 100) for i in range(100, 140)}


# --- sharding ---------------------------------------------------------------------------------------------------------
@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 17, 1000])
def test_sharding(spark, n):
    texts = [None if i % 7 == 3 else "é" * (i % 5) + str(i % 11) for i in range(n)]
    df = frame(spark, texts)
    got = sharding.shard(df, shards=4).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(n))
    assert sorted(r["shard"] + 4 * r["slot"] for r in got) == list(range(n))
    for r in got:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
    again = sharding.shard(df.repartition(5).withColumn("crc", F.lit(0)), shards=4).collect()
    assert {(r["doc_id"], r["shard"], r["slot"]) for r in got} == {(r["doc_id"], r["shard"], r["slot"]) for r in again}


def test_sharding_keeps_and_writes_whole_rows(spark, tmp_path):
    rows = [(None if i % 9 == 0 else i // 2, None if i % 7 == 3 else f"text {i % 5}", ["a", str(i)]) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, tags array<string>").repartition(3)
    out = sharding.shard(df, shards=4)
    assert out.columns == [*df.columns, *sharding.ADDED]
    placed = {(r["doc_id"], r["text"], *r["tags"]): (r["shard"], r["slot"]) for r in out.collect()}
    assert set(placed) == {(i, t, *tags) for i, t, tags in rows} and len(set(placed.values())) == 300
    back = sharding.write_shards(out, str(tmp_path / "out"))
    assert {(r["doc_id"], r["text"], *r["tags"]): (r["shard"], r["slot"]) for r in back.collect()} == placed
    for k in range(4):
        one = [spark.read.parquet(str(f)).collect() for f in sorted((tmp_path / "out" / f"shard={k}").glob("*.parquet"))]
        assert [r["slot"] for rows in one for r in rows] == list(range(75))
    again = sharding.shard(df.repartition(7), shards=4).collect()
    assert {(r["doc_id"], r["text"], *r["tags"]): (r["shard"], r["slot"]) for r in again} == placed
    with pytest.raises(ValueError):
        sharding.shard(out)


# --- quality rules ----------------------------------------------------------------------------------------------------
def brute_measures(t):
    t = t or ""
    w = words(t)
    seen, covered = {}, set()
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i : i + 3]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            covered |= {i + k for i in at for k in range(3)}
    ln = [x for x in t.split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), len(ln) - len(set(ln)), len(covered)


def test_quality_measures(spark):
    texts = [None, "", " \n\t", "a b c a b c", "x\nx\n\nx y", "a a a a a", "#é$ |b| \x0b c", "one two three four " * 300, "\r\n".join(["l 1", "l 2", "l 1"]), "A" * 5000]
    df = frame(spark, texts).withColumn("n_words", F.lit(-1))
    for r in quality_rules.quality_cascade(df).collect():
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute_measures(texts[r["doc_id"]])
    good = " ".join(f"word{i}" for i in range(80))
    kept = quality_rules.keep_good(frame(spark, [good, "short", good + " &&&" * 40, good.upper(), None]).withColumn("n_words", F.lit("x")))
    assert [(r["doc_id"], r["n_words"]) for r in kept.collect()] == [(0, "x")]
    assert quality_rules.keep_good(spark.createDataFrame([], DOCS)).count() == 0


# --- chat -------------------------------------------------------------------------------------------------------------
MESSAGES = "conv_id string, turn int, role string, text string, call_id string, name string, arguments string, answers string, after array<string>"


def test_chat_statuses_levels_and_json(spark):
    call = lambda turn, i, args, after=(), name="reply": ("c", turn, "assistant", None, i, name, args, None, list(after))
    good = '{"turn": 1, "prompt": "é\\n\\"x\\""}'
    rows = [
        ("c", 0, "user", "hi\n", None, None, None, None, None), call(1, "a", good), call(2, "b", good, ["a"]), ("c", 3, "tool", "r", None, None, None, "b", None), ("c", 4, "tool", "r", None, None, None, "a", None),
        ("c", 5, "tool", "r", None, None, None, "zz", None), call(6, "a", good), call(7, "d", '{"turn": "1", "prompt": "x"}'), call(8, "e", "{"), call(9, "f", good, name="other"), call(10, "x", good, ["y"]), call(11, "y", good, ["x"]), call(12, "g", '{"turn": 1, "prompt": "x", "more": 1}'),
    ]
    got = {r["turn"]: r for r in chat_format.format_chat(spark.createDataFrame(rows, MESSAGES), TOOLS).collect()}
    assert [got[i]["status"] for i in range(13)] == [None, "ok", "ok", "ok", "ok", "no_call", "repeated_call", "bad_arguments", "bad_arguments", "unknown_tool", "cycle", "cycle", "bad_arguments"]
    assert [got[i]["level"] for i in range(5)] == [0, 1, 2, 2, 1]
    assert got[1]["json"] == json.dumps({"arguments": {"prompt": 'é\n"x"', "turn": 1}, "call_id": "a", "content": "", "name": "reply", "role": "assistant"}, ensure_ascii=False, separators=(",", ":"), sort_keys=True)
    assert json.loads(got[3]["json"]) == {"content": "r", "result_of": "b", "role": "tool"}
    assert chat_format.format_chat(spark.createDataFrame([], MESSAGES), TOOLS).count() == 0


def test_chat_query_shape(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "q"), (1, 2, "assistant", "a"), (1, 3, "user", None), (2, 0, "assistant", "x")]
    got = {(r["conv_id"], r["turn"]): r for r in chat_format.format_chat(chat_messages(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")), TOOLS).collect()}
    assert [(k, got[k]["status"], got[k]["level"]) for k in sorted(got)] == [((1, 0), None, 0), ((1, 1), "ok", 1), ((1, 2), "ok", 1), ((1, 3), "no_result", 2), ((2, 0), None, 0)]


# --- decontamination --------------------------------------------------------------------------------------------------
def alnum(s):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(s))


def brute_hits(text, items, window):
    w = alnum(text)
    hit, names = set(), set()
    for name, t in items:
        iw = alnum(t)
        n = min(len(iw), window)
        for i in range(len(iw) - n + 1 if n else 0):
            for j in range(len(w) - n + 1):
                if w[j : j + n] == iw[i : i + n]:
                    hit |= set(range(j, j + n))
                    names.add(name)
    return len(w), len(hit), sorted(names)


@pytest.mark.parametrize("block", [10**6, 12])
@pytest.mark.parametrize("shortest", [1, 2, 4])
def test_decontamination_equals_brute_force(spark, block, shortest):
    rng = random.Random(shortest)
    word = lambda: rng.choice("ab cd e f g é h".split())
    items = [(i, " ".join(word() for _ in range(rng.randrange(shortest, 9)))) for i in range(12)] + [(98, None), (99, " - "), (1, "ab cd e")]
    texts = [", ".join(word() for _ in range(rng.randrange(0, 60))) for _ in range(40)] + [None, "", items[3][1].upper(), "ab"]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_contamination(frame(spark, texts), bench, window=5, block_words=block).collect()
    want = [brute_hits(t, [(str(i), x) for i, x in items], 5) for t in texts]
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["item_ids"]) for r in found} == dict(enumerate(want))
    df = frame(spark, texts).withColumn("n_hit", F.lit("x"))
    for r in decontaminate.decontaminate(df, bench, window=5, coverage=(1, 2), block_words=block).collect():
        n, hit, _ = want[r["doc_id"]]
        assert not (hit and 2 * hit >= n) and len(alnum(r["text"])) == n - hit
        assert hit or r["text"] == texts[r["doc_id"]]
    assert decontaminate.find_contamination(frame(spark, texts), bench.limit(0)).agg(F.sum("n_hit")).first()[0] == 0


def test_decontamination_in_many_blocks(spark):
    """Blocks in several passes find what one block finds; a worker builds each automaton once, and the driver reads one pass at a time."""
    rng = random.Random(7)
    items = spark.createDataFrame([(i % 50, " ".join(f"x{rng.randrange(400)}" for _ in range(rng.randrange(3, 40)))) for i in range(60)], "item_id long, text string")
    items = items.unionByName(items.limit(5)).unionByName(spark.createDataFrame([(None, "only here now"), (7, None)], items.schema))
    listed = [r["text"] or "" for r in items.collect()]
    texts = [" ".join(rng.choice(listed) if rng.random() < 0.4 else f"y{rng.randrange(99)}" for _ in range(12)) for _ in range(60)] + [None, "", "z " * 30_000 + listed[0]]
    df = frame(spark, texts + texts[:4]).withColumn("spans", F.lit(1))
    whole, split = (decontaminate.find_contamination(df, items, block_words=n).orderBy("doc_id").collect() for n in (10**6, 120))
    scratch_ = scratch.Scratch(spark, "blocks")
    blocks = decontaminate.ItemBlocks(items, "item_id", "text", 120, scratch_)
    assert blocks.passes >= 3 and all(len(blocks.read(i)[1]) <= decontaminate.PASS for i in range(blocks.passes))
    assert whole == split and any(r["n_hit"] for r in whole)
    left = [sorted(decontaminate.decontaminate(df, items, block_words=n).collect(), key=lambda r: (r["doc_id"], r["text"] or "")) for n in (10**6, 120)]
    assert left[0] == left[1]
    assert decontaminate.find_contamination(df.limit(0), items).count() == 0


# --- url filter -------------------------------------------------------------------------------------------------------
@pytest.mark.parametrize("form", ["list", "table", "merged"])
def test_url_filter_equals_brute_force(spark, form):
    rng = random.Random(1)
    rules = [url_filter.parse_rule(*r) for r in URL_RULES] + [url_filter.UrlRule("block", "a.net", ""), url_filter.UrlRule("allow", "b.a.net", "/x"), url_filter.UrlRule("block", "net", "/x/y/z/long/path")]
    rules += [url_filter.UrlRule(rng.choice(["block", "allow"]), ".".join(rng.choice("a b org net example com".split()) for _ in range(rng.randrange(1, 4))), rng.choice(["", "/", "/x", "/x/", "/de"])) for _ in range(60)]
    rules += rules[:5]
    urls = [None, "", "nothing", "http://", "x://NET", "x://net/", "http://evilnet/", "http://a.net?x#y", "http://a.net/" + "x/" * 20_000]
    urls += ["http://" + ".".join(rng.choice("a b org net example com".split()) for _ in range(rng.randrange(1, 5))) + rng.choice(["", "/", "/x", "/en/", "/de/1", "/fr/", "/x/y/z/long/path"]) for _ in range(400)]
    # One host has most pages, and pages come twice.
    urls += ["https://b.a.net/x/" + str(i % 90) for i in range(900)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumns({"rule": F.lit(1), "key": F.lit("k")}).repartition(3)
    given, more = rules, {}
    if form != "list":
        table = [(r.verdict, r.host.upper(), r.path) for r in rules] + [(None, "net", "/"), ("block", None, "/"), ("block", "", "/"), ("block", "net", None)]
        given, more = spark.createDataFrame(table, "verdict string, host string, path string"), {"small": 0} if form == "merged" else {}
    out = url_filter.filter_urls(pages.unionByName(pages.where("page_id < 9")), given, **more)
    rows = out.collect()
    assert len(rows) == len(urls) + 9 and out.columns == ["page_id", "host", "path", "rule", "verdict"]
    got = {r["page_id"]: r for r in rows}
    assert len(set(rows)) == len(urls)
    for i, u in enumerate(urls):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u or "")
        host, path = (lower(m[1]), m[2]) if m else ("", "")
        fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: r.rank, default=None)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == (host, path, best and best.name, best.verdict if best else "allow")
    assert url_filter.filter_urls(pages.limit(0), given, **more).count() == 0
    assert url_filter.filter_urls(pages, []).where("rule is not null").count() == 0


# --- sentencepiece ----------------------------------------------------------------------------------------------------
TEXTS = ["Hello world", "", None, "  two  spaces\n\n\ttabs ", "▁mark ▁▁", "naïve 東京 🙂\u0301", "x" * 400, "\0\x01", "ação " * 50, "https://a.example/" + "q1w2" * 60]


def test_sentencepiece_is_lossless_and_reproducible(spark):
    df = frame(spark, TEXTS).withColumn("decoded", F.lit(1))
    out = sentencepiece_sampling.decode(sentencepiece_sampling.encode(df, PIECE_MODEL), PIECE_MODEL).collect()
    assert {r["doc_id"]: r["decoded"] for r in out} == dict(enumerate(TEXTS))
    again = sentencepiece_sampling.encode(df.repartition(4), PIECE_MODEL).collect()
    assert {r["doc_id"]: r["pieces"] for r in again} == {r["doc_id"]: r["pieces"] for r in out}
    other = sentencepiece_sampling.encode(df, PIECE_MODEL, seed=1).collect()
    assert {r["doc_id"]: r["pieces"] for r in other} != {r["doc_id"]: r["pieces"] for r in out}


def test_sentencepiece_samples_the_lattice():
    """Shares of drawn segmentations against all segmentations of a word, for the vectorised and the one-by-one form."""
    with open(PIECE_MODEL, "rb") as f:
        p = sentencepiece_sampling.pieces(f.read())
    text = " there"
    codes = np.array([ord(c) for c in text])
    marked = np.where(codes == 32, 0x2581, codes)
    index = {}
    for n in p.lengths:
        for i in range(len(marked) - n + 1):
            x = int(p.lookup(n, p._hash(marked[None, i : i + n]))[0])
            if x >= 0:
                index.setdefault(i, []).append((n, x))
    ways = {}

    def walk(i, path, w):
        if i == len(marked):
            ways[tuple(path)] = w
        for n, x in index.get(i, []):
            walk(i + n, [*path, x], w * p.weight[x])

    walk(0, [], 1.0)
    total, n = sum(ways.values()), 6000
    keys = tokens.mix(np.arange(n, dtype=np.uint64))
    ids, first = sentencepiece_sampling.encode_chunk(np.tile(codes, n), np.arange(n + 1) * len(codes), keys, p)
    drawn = [tuple(ids[first[i] : first[i + 1]].tolist()) for i in range(n)]
    alone = [tuple(sentencepiece_sampling._draw_long(marked, keys[i : i + 1], np.zeros(1, np.uint64), p)[1][::-1].tolist()) for i in range(n)]
    for sample in (drawn, alone):
        assert set(sample) <= set(ways)
        for way, w in ways.items():
            share = w / total
            assert abs(sample.count(way) / n - share) < 5 * (share * (1 - share) / n) ** 0.5 + 1e-3


# --- models -----------------------------------------------------------------------------------------------------------
def test_language_model(spark):
    rng = random.Random(2)
    texts = [" ".join(w for _ in range(rng.randrange(1, 30)) for k in [rng.randrange(12)] for w in (f"a{k}", f"b{k}")) for _ in range(400)] + [None, "", "never seen"]
    df = frame(spark, texts)
    got = language_model.score_texts(df, fold() != 1).collect()
    count, total = {}, 0
    for i, t in enumerate(texts):
        if zlib.crc32(str(i).encode()) % 5 != 1:
            for w in [*words(lower(t)), None]:
                count[w] = count.get(w, 0) + 1
                total += 1
    for r in got:
        w = [*words(lower(texts[r["doc_id"]])), None]
        base = sum(np.log10((count.get(x, 0) + 0.5) / (total + 0.5 * (len(count) + 1))) for x in w)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(x in count for x in w), total)
        assert r["base_score"] == pytest.approx(base, abs=1e-9)
    held = [r for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert language_model.score_texts(df.limit(0), F.lit(True)).count() == 0
    assert language_model.score_texts(df.limit(5), F.lit(False)).count() == 5


def test_language_model_is_a_distribution():
    counts = {f"w{i}": 50 - i for i in range(40)}
    h = {w: int(next(tokens.chunks(pa.array([w]))).hashes(next(tokens.chunks(pa.array([w]))).words())[0]) for w in counts}
    order = sorted(counts, key=lambda w: h[w])
    voc = language_model.Vocabulary(np.array([h[w] for w in order], np.uint64), np.array([counts[w] for w in order]), np.arange(2, 42), sum(counts.values()), 40, 0.5)
    w = language_model.first_weights(voc)
    p = np.exp([language_model.log_probs(w, voc, np.array([s]), np.array([0, 1]), np.array([9], np.uint64))[0][0] for s in range(language_model.SLOTS)])
    assert p.sum() == pytest.approx(1, abs=1e-4)


def test_language_model_learns_words_without_a_slot(spark):
    """A rare word is likelier after the word it always follows than after another: both have the same counts."""
    common = " ".join(f"c{i}" for i in range(1100))
    learnt = [common] * 60 + [f"x{i} y{i}" for i in range(200) for _ in range(40)]
    asked = [f"x{i} y{i}" for i in range(200)] + [f"x{i} y{(i + 1) % 200}" for i in range(200)]
    df = frame(spark, learnt + asked)
    got = {r["doc_id"]: r["score"] for r in language_model.score_texts(df, F.col("doc_id") < len(learnt)).collect()}
    right, wrong = (sum(got[len(learnt) + k + i] for i in range(200)) / 200 for k in (0, 200))
    assert right > wrong + 1


def test_language_model_of_other_words_is_a_distribution(spark):
    words_ = np.sort(tokens.mix(np.arange(1, 5001, dtype=np.uint64)))
    c = 1 + np.arange(5000) % 7
    voc = language_model.build_vocabulary(spark.createDataFrame([(int(w), int(n)) for w, n in zip(words_.view(np.int64), c)], "word long, c long"))
    biases = language_model.first_weights(voc)
    w = biases + np.random.default_rng(0).normal(0, 0.5, biases.shape).astype(np.float32) * (biases == 0)
    rare = words_[voc.find(words_)[0] == language_model.OTHER]
    assert len(rare) == 5000 - 1022 and voc.mass.sum() == pytest.approx(voc.other - 0.5)
    at = np.arange(0, 2 * len(rare) + 1, 2)
    texts = np.stack([np.full(len(rare), words_[17]), rare], axis=1).ravel()
    p = language_model.log_probs(w, voc, voc.find(texts)[0], at, texts)[1][1::2]
    # Parts without a word have next to nothing, and take next to nothing.
    assert (np.exp(p) * (voc.find(rare)[1] + 0.5)).sum() + 0.5 / voc.other == pytest.approx(1, abs=1e-3)


def test_language_model_doesnt_depend_on_partitions(spark):
    rng = random.Random(5)
    texts = [" ".join(f"w{int(rng.paretovariate(0.6))}" for _ in range(rng.randrange(60))) for _ in range(600)]
    df = frame(spark, texts)
    got = [{r["doc_id"]: r["score"] / r["n_tokens"] for r in language_model.score_texts(df.coalesce(1) if n == 1 else df.repartition(n, "doc_id"), fold() != 1).collect()} for n in (1, 4, 7)]
    for other in got[1:]:
        assert max(abs(got[0][k] - v) for k, v in other.items()) < 1e-6


def test_language_model_equals_a_naive_softmax():
    """Probabilities and gradient sums of one short text, token by token with plain loops over the weight rows."""
    rng = np.random.default_rng(3)
    h = np.sort(tokens.mix(np.arange(1, 1301, dtype=np.uint64)))
    slots = np.full(1300, language_model.OTHER)
    slots[:1022] = np.arange(2, 1024)
    mass = np.zeros(language_model.SLOTS)
    np.add.at(mass, language_model.Vocabulary.place(h[1022:]), 1.5)
    voc = language_model.Vocabulary(h, np.ones(1300, int), slots, 1300, 1300, float(mass.sum() + 0.5), mass)
    w = language_model.first_weights(voc)
    w += rng.normal(0, 0.3, w.shape).astype(np.float32)
    text = np.r_[h[rng.integers(0, 1300, 40)], language_model.END]
    first = np.array([0, 41])
    own = voc.find(text)[0]
    todo, at = language_model.stages(language_model.Parts.of(w), voc, own, first, text)
    came, expected, met = np.zeros_like(w), np.zeros(w.shape), np.zeros(len(w), np.int64)
    language_model._gather(w, came, expected, met, voc, text, first)
    want_came, want_expected, of_token = np.zeros_like(w), np.zeros(w.shape), np.zeros((len(todo), 41))
    for k, stage in enumerate(todo):
        for j, target in enumerate(stage.target):
            z = sum(w[r].astype(float) for r in stage.rows[:, j])
            p = np.exp(z) / np.exp(z).sum()
            of_token[k, j if k < 2 else at[j]] = np.log(p[target])
            for r in stage.rows[:-1, j]:
                want_came[r, target] += 1
                want_expected[r] += p
    assert np.allclose(came, want_came) and np.allclose(expected, want_expected, atol=1e-5) and met.sum() == sum(len(s.target) * (len(s.rows) - 1) for s in todo)
    of_slot, in_other = language_model.log_probs(w, voc, own, first, text)
    assert np.allclose(of_slot, of_token[0] + of_token[1], atol=1e-5)
    known = np.log((voc.other - 0.5) / voc.other) - np.log(mass[voc.place(text[at])])
    assert np.allclose(in_other[at], known + of_token[2, at] + of_token[3, at], atol=1e-5)


def labelled(spark, n, bad):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        w = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(5, 80))]
        y = i % 3 == 0
        rows.append((i, bad(rng, w) if y else " ".join(w)))
        labels.append((i, int(y)))
    rows += [(n, None), (n + 1, ""), (n + 2, "w " * 5000)]
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, y int"), dict(labels)


def check_scores(got, truth, least):
    assert all(0 <= r["score"] <= 1 for r in got)
    held = [(r["score"] >= 0.5, truth[r["doc_id"]]) for r in got if r["doc_id"] in truth and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert sum(a == b for a, b in held) / len(held) >= least


def test_toxicity(spark):
    df, labels, truth = labelled(spark, 500, lambda rng, w: " ".join([*w[:3], rng.choice(["vile", "nasty", "vileness"]), *w[3:], "nasty"]))
    model = toxicity.fit_toxicity(df, labels, "y", fold() != 0)
    got = toxicity.score_toxicity(df, model).collect()
    assert len(got) == 503
    check_scores(got, truth, 0.95)
    left = toxicity.drop_toxic(df.withColumn("score", F.lit(9)), model)
    assert {r["doc_id"] for r in left.collect()} == {r["doc_id"] for r in got if r["score"] < 0.5} and "score" in left.columns
    none = toxicity.fit_toxicity(df, labels.limit(0), "y", F.lit(True))
    assert toxicity.score_toxicity(df, none).where("score != 0").count() == 0
    assert toxicity.score_toxicity(df.limit(0), model).count() == 0


def test_toxicity_repeated_ids_and_long_texts(spark, monkeypatch):
    """20,000 repeats of one labelled id are one training row; an id with both labels and texts beyond the bounds are none."""
    got = []
    monkeypatch.setattr(toxicity, "train", lambda texts, y, keep_out: got.append((texts, y)) or toxicity.TextCnn(np.empty(0), [], np.empty(0), np.empty(0), 0.0, np.empty(0), 0.5))
    docs = spark.createDataFrame([(i, f"w{i} " * 4) for i in range(40)] + [(50, "x" * (toxicity.LONGEST + 1))], DOCS)
    docs = docs.unionByName(spark.range(20_000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("again "), F.col("id").cast("string")).alias("text")))
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(7, 1), (8, 1), (50, 0), (99, 1), (None, 1), (9, None)], "doc_id long, y int")
    toxicity.fit_toxicity(docs, labels, "y", F.lit(True))
    assert len(got[0][0]) == 39 and got[0][1].sum() == 20


def test_toxicity_learns_from_rows_beyond_the_first_models(spark):
    """A word that only rows outside the first model's have is learnt, however rows are dealt; thresholds too are of all rows."""
    df, labels, truth = labelled(spark, 500, lambda rng, w: " ".join([*w[:3], "vile", *w[3:]]))
    more = [(1000 + i, f"w{i % 300} w{i * 7 % 300} " + ("dreadful dreadful" if i % 2 else "pleasant")) for i in range(400)]
    # Those texts are too long for the first model.
    more = [(i, t + " filler" * 40) for i, t in more]
    df = df.where("length(text) < 250").unionByName(spark.createDataFrame(more, DOCS))
    labels = labels.unionByName(spark.createDataFrame([(i, i % 2) for i, _ in more], "doc_id long, y int"))
    how = {"sample": 60, "longest": 250}
    model = toxicity.fit_toxicity(df, labels, "y", fold() != 0, **how)
    got = toxicity.score_toxicity(df, model).collect()
    held = [(r["score"] >= 0.5, r["doc_id"] % 2 == 1) for r in got if r["doc_id"] >= 1000 and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert len(held) > 50 and sum(a == b for a, b in held) / len(held) >= 0.95
    again = toxicity.fit_toxicity(df.repartition(7), labels.repartition(3), "y", fold() != 0, **how)
    assert np.array_equal(again.embed, model.embed) and np.array_equal(again.thresholds, model.thresholds)


def test_toxicity_logits_equal_a_naive_convolution():
    rng = np.random.default_rng(4)
    texts = pa.array([" ".join(f"w{rng.integers(90)}" for _ in range(n)) for n in (0, 1, 2, 3, 7, 40, 1)])
    shape = ((1 + len(toxicity.PREFIXES)) * toxicity.BUCKETS, toxicity.DIM)
    filters = [rng.normal(0, 1, (w, toxicity.DIM, toxicity.FILTERS)).astype(np.float32) for w in toxicity.WIDTHS]
    n = len(filters) * toxicity.FILTERS
    m = toxicity.TextCnn(rng.normal(0, 1, shape).astype(np.float32), filters, rng.normal(0, 1, n).astype(np.float32), rng.normal(0, 1, n).astype(np.float32), 0.5, rng.normal(0, 1, 5))
    c = next(tokens.chunks(texts))
    ids, first = toxicity.bucket_ids(c)
    for i, got in enumerate(m.scores(c)):
        own = ids[first[i] : first[i + 1]]
        x = [sum(m.embed[r] for r in row) for row in own]
        pooled = []
        for f in filters:
            y = x + [np.zeros(toxicity.DIM)] * max(0, len(f) - len(x))
            pooled += [max(sum(y[a + j] @ f[j][:, k] for j in range(len(f))) for a in range(len(y) - len(f) + 1)) for k in range(toxicity.FILTERS)]
        z = np.maximum(np.array(pooled) + m.bias, 0) @ m.out + m.out_bias - m.thresholds[toxicity.languages(own, np.array([0, len(own)]))[0]]
        assert got == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-4)


def test_quality_classifier(spark):
    df, labels, truth = labelled(spark, 500, lambda rng, w: " ".join(x + "!!" for x in w).upper())
    got = quality_classifier.classify(df, labels, "y", fold() != 0).collect()
    assert len(got) == 503
    check_scores(got, truth, 0.95)
    assert {r["score"] for r in quality_classifier.classify(df, labels.limit(0), "y", F.lit(True)).collect()} == {0.5}
    assert quality_classifier.classify(df.limit(0), labels, "y", F.lit(True)).count() == 0


def test_quality_scores_equal_plain_discriminants(spark):
    """Against densities from the definition: moments by numpy, inverse covariance and determinant, row by row; rows repeated in the table count twice."""
    df, labels, _ = labelled(spark, 120, lambda rng, w: " ".join(x + "!" * rng.randrange(3) for x in w))
    df = df.unionByName(df.where("doc_id < 9")).withColumn("_y", F.lit("x"))
    got = {r["doc_id"]: r["score"] for r in quality_classifier.classify(df, labels, "y", fold() != 0).collect()}
    x = {}
    rows = df.collect()
    for r in rows:
        x[r["doc_id"]] = quality_classifier.statistics(next(tokens.chunks(pa.array([r["text"]], pa.string()))))[0]
    y = {r["doc_id"]: r["y"] for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5}
    own = [np.array([x[r["doc_id"]] for r in rows if y.get(r["doc_id"]) == k]) for k in (0, 1)]
    d, total = len(quality_classifier.FEATURES), len(own[0]) + len(own[1])
    cov = [np.cov(o.T, bias=True) for o in own]
    pooled = np.diag(sum(len(o) * v for o, v in zip(own, cov)) / total)
    shrunk = [(1 - a) * v + a * np.diag(pooled) + quality_classifier.RIDGE * np.eye(d) for o, v in zip(own, cov) for a in [min(1, quality_classifier.SHRINK + d / len(o))]]
    for i, v in x.items():
        dens = [np.log(len(o) / total) - 0.5 * np.log(np.linalg.det(s)) - 0.5 * (v - o.mean(axis=0)) @ np.linalg.inv(s) @ (v - o.mean(axis=0)) for o, s in zip(own, shrunk)]
        assert got[i] == pytest.approx(1 / (1 + np.exp(-(dens[1] - dens[0]) / quality_classifier.TEMPER)), abs=1e-6)


# --- cascade, lanes and the pipeline ------------------------------------------------------------------------------------
def test_quality_order_is_stable_and_the_cascade_stops(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 9) for _ in range(rng.randrange(120))) for _ in range(300)] + ["A " * 200] * 40 + [None, ""]
    df = frame(spark, texts)
    orders = [[r.name for r in quality_rules.rule_order(d)] for d in (df, df.repartition(5), df.orderBy(F.desc("doc_id")).coalesce(1))]
    assert orders[0] == orders[1] == orders[2] and sorted(orders[0]) == sorted(r.name for r in quality_rules.RULES)
    # The first rule rejects most rows for its work; a rule that never rejects comes after those that do.
    assert orders[0].index("symbols") > orders[0].index("short")
    short = next(r for r in quality_rules.RULES if r.name == "short")
    bomb = quality_rules.QualityRule("bomb", ("n_upper",), lambda m: F.raise_error(F.lit("taken")).isNull())
    few = frame(spark, ["too short", None])
    assert {r[0] for r in few.select(quality_rules.cascade([short, bomb], F.col("text"))).collect()} == {"short"}
    with pytest.raises(Exception, match="taken"):
        few.select(quality_rules.cascade([bomb, short], F.col("text"))).collect()
    got = {r["doc_id"]: r for r in quality_rules.quality_cascade(df).collect()}
    kept = {r["doc_id"] for r in quality_rules.keep_good(df).collect()}
    assert kept == {k for k, r in got.items() if r["kept"]}
    assert quality_rules.quality_cascade(df.limit(0)).count() == 0


def test_chat_doesnt_depend_on_the_order_of_rows(spark):
    """Turns repeat, whole rows repeat, conversation and turn can be null, and one conversation holds most rows."""
    rng = random.Random(9)
    good = '{"turn": 1, "prompt": "p"}'
    rows = [(rng.choice(["hot", "hot", "c", None]), rng.choice([*range(30), None]), "user", f"t{rng.randrange(5)}", rng.choice([None, f"i{rng.randrange(40)}"]), "reply", rng.choice([good, "{"]), rng.choice([None, f"i{rng.randrange(40)}"]), rng.choice([None, [], [f"i{rng.randrange(40)}"]])) for _ in range(300)]
    rows += rows[:7]
    df = spark.createDataFrame(rows, MESSAGES).withColumn("seq", F.lit("other"))
    results = []
    for d in (df.coalesce(1), df.repartition(6, F.rand(1)), df.orderBy(F.rand(2)).repartition(3)):
        results.append(sorted(map(str, chat_format.format_chat(d, TOOLS).collect())))
    assert results[0] == results[1] == results[2] and len(results[0]) == len(rows)


def test_chat_long_chain_against_the_turns_takes_few_rounds(spark, monkeypatch):
    n = 120
    good = '{"turn": 1, "prompt": "p"}'
    rows = [("c", n - i, "user", "x", f"i{i}", "reply", good, None, [f"i{i - 1}"] if i else []) for i in range(n)]
    kept = []
    keep = scratch.Scratch.keep
    monkeypatch.setattr(scratch.Scratch, "keep", lambda self, df, name="t", *a: kept.append(name) or keep(self, df, name, *a))
    got = {r["call_id"]: r["level"] for r in chat_format.format_chat(spark.createDataFrame(rows, MESSAGES), TOOLS).collect()}
    assert got == {f"i{i}": i + 1 for i in range(n)} and kept.count("ready") <= 12


# --- nulls, repeats, long texts, other columns ------------------------------------------------------------------------
def test_language_model_takes_odd_rows(spark):
    """Null ids, repeated rows, a very long text and columns with the operator's own names."""
    rows = [(None, "a b c"), (1, "a b c"), (1, "a b c"), (2, "a b " * 60_000), (3, None), (4, "zz")]
    df = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("x") for c in ("id", "row", "rare", "word", "score", "part")})
    got = language_model.score_texts(df, fold() != 1).collect()
    assert len(got) == 6 and {r["train_tokens"] for r in got} == {sum(len(words(t or "")) + 1 for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 5 != 1)}
    assert len({r["score"] for r in got if r["doc_id"] in (None, 1)}) == 1 and next(r for r in got if r["doc_id"] == 2)["n_tokens"] == 120_001


def test_sentencepiece_takes_odd_rows(spark):
    """Null and repeated keys draw alike for equal texts; an empty table stays one; a text without spaces is one long unit."""
    long = "日本語のテキスト" * 3000 + "x" * 20_000
    df = spark.createDataFrame([(None, "some words here"), (0, "some words here"), (0, "some words here"), (1, long)], DOCS).withColumn("_draw", F.lit(5))
    got = sentencepiece_sampling.encode(df, PIECE_MODEL, decoded_col="text2").collect()
    assert all(r["text2"] == r["text"] for r in got) and len({tuple(r["pieces"]) for r in got if r["doc_id"] != 1}) == 1
    out = sentencepiece_sampling.encode(df.limit(0), PIECE_MODEL)
    assert out.count() == 0 and out.columns == [*df.columns, "pieces"]
    assert sentencepiece_sampling.decode(out, PIECE_MODEL).count() == 0


def test_jaccard_takes_odd_rows(spark):
    """A very long text and its near copy, repeated rows with their ids, and columns with the operator's own names."""
    long = [f"w{i}" for i in range(60_000)]
    near = [*long[:30_000], "changed", *long[30_001:]]
    rows = [(5, " ".join(long)), (9, " ".join(near)), (9, " ".join(near)), (2, "one two three four five six"), (2, "one two three four five six"), (3, "one two three four five six"), (7, None)]
    df = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("x") for c in ("id", "key", "n", "component_id", "_kept", "_n")})
    got = sorted((r["doc_id"], r["component_id"]) for r in jaccard_join.jaccard_components(df).collect())
    assert got == [(2, 2), (2, 2), (3, 2), (5, 5), (7, 7), (9, 5), (9, 5)]
    kept = jaccard_join.keep_one_each(df)
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 5, 7] and kept.columns == df.columns


def test_jaccard_leftovers_are_complete(spark):
    """Many variants of one text, hardly any of them linked to the one that all are compared with; links between them are found."""
    rng = random.Random(11)
    base = [f"b{i}" for i in range(120)]
    texts = []
    for g in range(30):
        own = list(base)
        for i in rng.sample(range(120), 9):
            own[i] = f"g{g}x{i}"
        for _ in range(4):
            t = list(own)
            for i in rng.sample(range(120), rng.randrange(3)):
                t[i] = f"r{rng.randrange(10**9)}"
            texts.append(" ".join(t))
    for cut in range(20, 120, 3):
        texts.append(" ".join(base[:cut]))
    rng.shuffle(texts)
    rule = jaccard_join.Rule(4, 85, 100)
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_components(frame(spark, texts), rule=rule).collect()}
    assert got == {i: c for i, _, c in brute_components(texts, 4, 85, 100)}
