"""Full-text index and search: postings with positions, Boolean, prefix, phrase and nearness queries, BM25 ranks, stored indexes."""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillon.operators import match as query
from quillon.operators.merge import Snapshots

TOKEN = r"([\p{L}\p{N}\p{Co}]+)"
K1, B = 1.2, 0.75
#: Words of the texts in one part of a stored index; parts are by word.
PART_WORDS = 20_000_000


def _folds() -> dict[str, str]:
    """Latin letters with one mark, and the letter without it: those that decompose into an ASCII letter and one more code point. The long s is an s."""
    out = {"\u017f": "s"}
    for x in map(chr, range(0xC0, 0x2000)):
        parts = unicodedata.normalize("NFD", x.lower())
        if len(x.lower()) == 1 and len(parts) == 2 and "a" <= parts[0] <= "z":
            out[x.lower()] = parts[0]
    return out


_FOLDS = _folds()
#: Combining marks that are left out of words, so a letter and its mark are the letter.
_MARKS = "".join(map(chr, range(0x300, 0x332)))


#: The same for Python strings.
_TABLE = {**{ord(k): v for k, v in _FOLDS.items()}, **{ord(c): None for c in _MARKS}}


def fold(c: Column) -> Column:
    return F.translate(F.lower(c), "".join(_FOLDS) + _MARKS, "".join(_FOLDS.values()))


def tokens(c: Column) -> Column:
    """Folded words in order; null has none."""
    return F.regexp_extract_all(fold(F.coalesce(c, F.lit(""))), F.lit(TOKEN), F.lit(1))


def bucket(c: Column, buckets: int) -> Column:
    return F.pmod(F.crc32(c.cast("binary")), F.lit(buckets)).cast("int")


@dataclass
class FtsIndex:
    """postings: (doc, column, term, pos); lengths: (doc, length).

    An index from ``build_index`` follows its table: each action splits the texts again. One from ``FtsStore`` is what was stored, whatever happens to
    the table, until it's built again; its postings lie in ``buckets`` folders by word, as many as the texts' size asks for, so a query of words reads only theirs.
    """

    postings: DataFrame
    lengths: DataFrame
    buckets: int = 0
    columns: list[str] = field(default_factory=list)

    def _parts(self, words: Iterable[str]) -> Column:
        return F.col("bucket").isin(sorted({zlib.crc32(w.encode()) % self.buckets for w in words}))

    # --- matching -------------------------------------------------------------------------------------------------
    def words(self, words: list[str], column: str | None = None) -> DataFrame:
        """Postings of the words, in one column or all."""
        p = self.postings if column is None else self.postings.where(F.col("column") == column)
        if self.buckets:
            p = p.where(self._parts(words))
        return p.where(F.col("term").isin(*words) if words else F.lit(False))

    def term(self, word: str, column: str | None = None, prefix: bool = False) -> DataFrame:
        if not prefix:
            return self.words([word], column).select("doc").distinct()
        p = self.postings if column is None else self.postings.where(F.col("column") == column)
        return p.where(F.col("term").startswith(word)).select("doc").distinct()

    def all_of(self, words: list[str], column: str | None = None) -> DataFrame:
        """Documents with all words; none for an empty list, as in the other methods."""
        hits = self.words(words, column).groupBy("doc").agg(F.count_distinct("term").alias("n"))
        return hits.where(F.col("n") == len(set(words))).select("doc")

    def any_of(self, words: list[str], column: str | None = None) -> DataFrame:
        return self.words(words, column).select("doc").distinct()

    def without(self, docs: DataFrame, words: list[str]) -> DataFrame:
        return docs.join(self.any_of(words), "doc", "left_anti")

    def phrase(self, words: list[str], column: str | None = None) -> DataFrame:
        """Words side by side, in order: each word's position less its place in the phrase is one start."""
        if not words:
            return self.any_of([])
        places = F.create_map(*(x for w in dict.fromkeys(words) for x in (F.lit(w), F.array(*(F.lit(i) for i, v in enumerate(words) if v == w)))))
        p = self.words(words, column).select("doc", "column", "pos", F.explode(places[F.col("term")]).alias("place"))
        starts = p.groupBy("doc", "column", (F.col("pos") - F.col("place")).alias("start")).agg(F.count_distinct("place").alias("n"))
        return starts.where(F.col("n") == len(words)).select("doc").distinct()

    def near(self, a: str, b: str, distance: int = 10) -> DataFrame:
        """Both words in one column with at most ``distance`` words between them. The nearest two are neighbours among the words' positions, so one sort finds them."""
        before = Window.partitionBy("doc", "column").orderBy("pos")
        p = self.words([a, b]).select("doc", "column", "pos", "term", F.lag("pos").over(before).alias("p0"), F.lag("term").over(before).alias("t0"))
        other = F.lit(True) if a == b else F.col("term") != F.col("t0")
        return p.where(other & (F.col("pos") - F.col("p0") <= distance + 1)).select("doc").distinct()

    # --- ranks ----------------------------------------------------------------------------------------------------
    def bm25(self, words: list[str], docs: DataFrame | None = None) -> DataFrame:
        """(doc, rank) of the documents with all words, or of ``docs``: negative, best first in ascending order."""
        asked = list(dict.fromkeys(words))
        if not asked:
            return self.any_of([]).select("doc", F.lit(0.0).alias("rank"))
        f = [F.count_if(F.col("term") == w).alias(f"f{i}") for i, w in enumerate(asked)]
        tf = self.words(asked).groupBy("doc").agg(*f)
        # Two tables of one row.
        sizes = self.lengths.agg(F.count("*").alias("n_docs"), F.avg("length").alias("avg_len"))
        found = tf.agg(*(F.count_if(F.col(f"f{i}") > 0).alias(f"n{i}") for i in range(len(asked))))
        hits = tf.join(docs, "doc", "left_semi") if docs is not None else tf.where(" and ".join(f"f{i} > 0" for i in range(len(asked))))
        return self._ranked(hits, found, [f"f{i}" for i in range(len(asked))], sizes)

    def _ranked(self, hits: DataFrame, found: DataFrame, counts: list[str], sizes: DataFrame) -> DataFrame:
        """``hits``: documents with their counts of each thing asked for; ``found``: one row, n0, n1 ...: documents with each."""
        scored = hits.join(self.lengths, "doc").join(F.broadcast(sizes), F.lit(True)).join(F.broadcast(found), F.lit(True))
        score = F.lit(0.0)
        for i, c in enumerate(counts):
            n, n_docs, count = F.col(f"n{i}"), F.col("n_docs"), F.col(c)
            idf = F.greatest(F.log((n_docs - n + 0.5) / (n + 0.5)), F.lit(1e-6))
            score += idf * count * (K1 + 1) / (count + K1 * (1 - B + B * F.col("length") / F.col("avg_len")))
        return scored.select("doc", (-score).alias("rank"))

    def _tree(self, text: str):
        return query.Parser(text, self.columns, lambda x: query.split_words(x, _TABLE)).parse()

    def _read(self, tree) -> DataFrame:
        """Postings of the parts that hold a query's words; all parts if it has words by their beginning."""
        words = {w for p in query.phrases_of(tree) for w in p.words}
        if not self.buckets or any(prefix for _, prefix in words):
            return self.postings
        return self.postings.where(self._parts(w for w, _ in words))

    def match(self, text: str) -> DataFrame:
        """Documents that match a query string (see ``match``); an empty string gives none."""
        if not text.strip():
            return self.any_of([])
        tree = self._tree(text)
        return query.matching(self._read(tree), tree)[0].select("doc")

    def match_ranked(self, text: str) -> DataFrame:
        """(doc, rank) of the documents that match, by BM25 over the query's phrases: each distinct one counts once, those of NEAR wherever they are."""
        if not text.strip():
            return self.bm25([])
        tree = self._tree(text)
        hits, phrases = query.matching(self._read(tree), tree)
        if not phrases:
            return self.bm25([])
        n = range(len(phrases))
        at = query.places(self._read(tree), phrases).groupBy("doc", "phrase").agg(F.lit(1).alias("one"))
        found = at.agg(*(F.count_if(F.col("phrase") == i).alias(f"n{i}") for i in n))
        sizes = self.lengths.agg(F.count("*").alias("n_docs"), F.avg("length").alias("avg_len"))
        return self._ranked(hits.select("doc", *(F.col(f"n{i}").alias(f"f{i}") for i in n)), found, [f"f{i}" for i in n], sizes)

    def top(self, words: list[str], documents: DataFrame, key: str, n: int = 20) -> DataFrame:
        """The documents, all columns, with all words, best rank first; ties by key. The n best are found before the texts are joined."""
        best = self.bm25(words).orderBy("rank", "doc").limit(n)
        return documents.join(best.withColumnRenamed("doc", "_doc"), F.col(key) == F.col("_doc")).drop("_doc").orderBy("rank", key)


def build_index(df: DataFrame, key: str, columns: list[str]) -> FtsIndex:
    """Of the named text columns; documents without a word still count in lengths."""
    words = df.select(F.col(key).alias("doc"), *(tokens(F.col(c).cast("string")).alias(c) for c in columns))
    cols = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("w")) for c in columns)))
    postings = words.select("doc", cols.alias("x")).select("doc", "x.column", F.posexplode("x.w").alias("pos", "term"))
    lengths = words.select("doc", sum((F.size(c) for c in columns), F.lit(0)).cast("long").alias("length"))
    return FtsIndex(postings, lengths, columns=list(columns))


class FtsStore:
    """One stored index in a folder; it's stale until ``rebuild`` is called, and readers keep the one that they opened."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.snapshots = spark, Snapshots(spark, folder)

    def rebuild(self, df: DataFrame, key: str, columns: list[str]) -> FtsIndex:
        after = self.snapshots.number()
        path = self.snapshots.new()
        index = build_index(df, key, columns)
        index.lengths.write.parquet(f"{path}/lengths")
        words = self.spark.read.parquet(f"{path}/lengths").agg(F.sum("length")).first()[0] or 0
        buckets = -(-max(words, 1) // PART_WORDS)
        # A common word's postings lie in several tasks and files.
        spread = index.postings.withColumn("bucket", bucket(F.col("term"), buckets)).hint("rebalance", "bucket")
        spread.sortWithinPartitions("bucket", "term").write.partitionBy("bucket").parquet(f"{path}/postings")
        self.spark.createDataFrame([(i, c, buckets) for i, c in enumerate(columns)], "pos int, name string, buckets long").coalesce(1).write.parquet(f"{path}/columns")
        self.snapshots.publish(path, after)
        return self.open()

    def open(self) -> FtsIndex:
        path = self.snapshots.current()
        if path is None:
            raise FileNotFoundError(f"no index in {self.snapshots.folder}")
        columns = self.spark.read.parquet(f"{path}/columns").orderBy("pos").collect()
        return FtsIndex(self.spark.read.parquet(f"{path}/postings"), self.spark.read.parquet(f"{path}/lengths"), columns[0]["buckets"], [r["name"] for r in columns])



def contains_folded(c: Column, text: str) -> Column:
    """Accent- and case-insensitive containment without an index."""
    return F.contains(F.collate(c, "UNICODE_CI_AI"), F.lit(text))
