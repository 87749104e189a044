"""Full-text query strings, compiled to one pass over an index's postings.

    expr    := expr OR expr | expr AND expr | expr NOT expr     NOT binds tightest, all from the left
             | (expr) | columns : (expr) | terms
    terms   := term term ...                                    all of them; binds tighter than NOT
    term    := [columns :] [^] phrase | [columns :] NEAR(phrase phrase ..., distance)
    phrase  := string [*] + string [*] ...                      words side by side; * takes words that begin so
    columns := name | {name name} | - name | - {name name}

A string is a bare word (letters, digits, _ and anything beyond ASCII) or quoted, with "" for a quote in it; it is folded and split as the texts were, and several
words are a phrase. ^ takes phrases at a column's beginning only. Phrases are near if, for some start of one, each has a start not after it and at
most its own length and the distance (10) before it. A string without words takes no part in a phrase; a phrase without words matches nothing, but is left out
where terms stand side by side.

Each distinct phrase is numbered. The postings of all words asked for are read once; grouped by document, column, phrase and start they give the
phrases' places, and one more grouping by document gives what phrases it has, on which the whole expression is a condition.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class MatchSyntaxError(ValueError):
    pass


@dataclass(frozen=True)
class Phrase:
    """words: (word, whether words that begin so will do); columns: None is all."""

    words: tuple[tuple[str, bool], ...]
    columns: frozenset[str] | None = None
    first: bool = False


@dataclass(frozen=True)
class Near:
    phrases: tuple[Phrase, ...]
    distance: int


@dataclass(frozen=True)
class Op:
    kind: str
    left: object
    right: object


_LEX = re.compile(r'\s*(?:"((?:[^"]|"")*)"|([0-9A-Za-z_\x1a\x80-\U0010ffff]+)|([(){}:+*^,-]))')


class Parser:
    """Tokens are (kind, text): kinds string and bare, the operators, and marks by themselves. ``split`` gives the words of a string."""

    def __init__(self, text: str, names: list[str], split: Callable[[str], list[str]]):
        self.names, self.split, self.at = names, split, 0
        self.tokens: list[tuple[str, str]] = []
        pos, end = 0, len(text.rstrip())
        while pos < end:
            m = _LEX.match(text, pos)
            if not m:
                raise MatchSyntaxError(f"syntax error near {text[pos : pos + 20]!r}")
            quoted, bare, mark = m.groups()
            if quoted is not None:
                self.tokens.append(("string", quoted.replace('""', '"')))
            elif bare in ("AND", "OR", "NOT"):
                self.tokens.append((bare, bare))
            else:
                self.tokens.append(("bare", bare) if bare else (mark, mark))
            pos = m.end()

    def peek(self, ahead: int = 0) -> str:
        return self.tokens[self.at + ahead][0] if self.at + ahead < len(self.tokens) else ""

    def take(self, *kinds: str) -> str:
        if self.peek() not in kinds:
            raise MatchSyntaxError(f"syntax error near {self.tokens[self.at][1]!r}" if self.peek() else "the query ends too soon")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def parse(self):
        out = self.expr(0, None)
        if self.peek():
            raise MatchSyntaxError(f"syntax error near {self.tokens[self.at][1]!r}")
        return out

    def expr(self, level: int, columns):
        """OR, AND and NOT are levels 0 to 2."""
        if level == 3:
            return self.primary(columns)
        out = self.expr(level + 1, columns)
        while self.peek() == ("OR", "AND", "NOT")[level]:
            kind = self.take(self.peek())
            out = Op(kind, out, self.expr(level + 1, columns))
        return out

    def primary(self, columns):
        mark = self.at
        own = self.columns(columns)
        if self.peek() == "(":
            self.take("(")
            out = self.expr(0, own)
            self.take(")")
            return out
        self.at = mark
        out = self.term(columns)
        while self.peek() in ("string", "bare", "{", "-", "^"):
            more = self.term(columns)
            # A term without words is left out.
            out = more if out == _NOTHING else out if more == _NOTHING else Op("AND", out, more)
        return out

    def columns(self, outer):
        """The columns before a colon within those around; ``outer`` where there are none."""
        at, minus = self.at, False
        if self.peek() == "-":
            self.take("-")
            minus = True
        names: list[str] = []
        if self.peek() == "{":
            self.take("{")
            names.append(self.take("string", "bare"))
            while self.peek() != "}":
                names.append(self.take("string", "bare"))
            self.take("}")
        elif self.peek() in ("string", "bare") and self.peek(1) == ":":
            names.append(self.take("string", "bare"))
        elif minus:
            self.take("string")
        else:
            self.at = at
            return outer
        self.take(":")
        known = {n.lower(): n for n in self.names}
        if bad := [n for n in names if n.lower() not in known]:
            raise MatchSyntaxError(f"no such column: {bad[0]}")
        own = frozenset(known[n.lower()] for n in names)
        own = frozenset(self.names) - own if minus else own
        return own if outer is None else own & outer

    def term(self, outer):
        columns = self.columns(outer)
        if self.peek() == "bare" and self.tokens[self.at][1] == "NEAR" and self.peek(1) == "(":
            self.take("bare")
            self.take("(")
            phrases = [self.phrase(columns)]
            while self.peek() in ("string", "bare"):
                phrases.append(self.phrase(columns))
            distance = 10
            if self.peek() == ",":
                self.take(",")
                number = self.take("bare")
                if not number.isdigit():
                    raise MatchSyntaxError(f"expected a number, not {number!r}")
                distance = int(number)
            self.take(")")
            phrases = [p for p in phrases if p.words]
            return _NOTHING if not phrases else phrases[0] if len(phrases) == 1 else Near(tuple(phrases), distance)
        first = self.peek() == "^"
        if first:
            self.take("^")
        out = self.phrase(columns, first)
        return out if out.words else _NOTHING

    def phrase(self, columns, first: bool = False) -> Phrase:
        words: list[tuple[str, bool]] = []
        while True:
            own = [(w, False) for w in self.split(self.take("string", "bare"))]
            if self.peek() == "*":
                self.take("*")
                if own:
                    own[-1] = (own[-1][0], True)
            words += own
            if self.peek() != "+":
                return Phrase(tuple(words), columns, first)
            self.take("+")


_NOTHING = Phrase(())


def split_words(text: str, folds: dict[int, str | None]) -> list[str]:
    """The words of a string as the index has them."""
    text = text.lower().translate(folds)
    return "".join(c if unicodedata.category(c)[0] in "LN" or unicodedata.category(c) == "Co" else " " for c in text).split()


def phrases_of(tree) -> list[Phrase]:
    """Distinct phrases, in order."""
    if isinstance(tree, Phrase):
        return [tree] if tree.words else []
    parts = tree.phrases if isinstance(tree, Near) else [*phrases_of(tree.left), *phrases_of(tree.right)]
    return list(dict.fromkeys(parts))


def _nears(tree) -> list[Near]:
    if isinstance(tree, Op):
        return list(dict.fromkeys([*_nears(tree.left), *_nears(tree.right)]))
    return [tree] if isinstance(tree, Near) else []


def _is_word(word: str, prefix: bool) -> Column:
    return F.col("term").startswith(word) if prefix else F.col("term") == word


def places(postings: DataFrame, phrases: list[Phrase]) -> DataFrame:
    """(doc, column, phrase, start): where each phrase begins."""
    uses = []
    for i, p in enumerate(phrases):
        within = F.lit(True) if p.columns is None else F.col("column").isin(*p.columns) if p.columns else F.lit(False)
        for k, (word, prefix) in enumerate(p.words):
            # Only the phrase's own place can be at the beginning.
            at = within & (F.col("pos") == k) if p.first else within
            uses.append(F.when(at & _is_word(word, prefix), F.struct(F.lit(i).alias("phrase"), F.lit(k).alias("place"))))
    each = postings.select("doc", "column", "pos", F.explode(F.array_compact(F.array(*uses))).alias("use"))
    starts = each.groupBy("doc", "column", F.col("use.phrase").alias("phrase"), (F.col("pos") - F.col("use.place")).alias("start")).agg(F.count_distinct("use.place").alias("n"))
    size = F.element_at(F.array(*(F.lit(len(p.words)) for p in phrases)), F.col("phrase") + 1)
    return starts.where(F.col("n") == size).drop("n")


def _near_docs(at: DataFrame, near: Near, number: dict[Phrase, int], out: int) -> DataFrame:
    """(doc, phrase = ``out``): documents with a column that has a start by which all phrases began not too long ago."""
    so_far = Window.partitionBy("doc", "column").orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    rows = at.where(F.col("phrase").isin(*(number[p] for p in near.phrases)))
    close = F.lit(True)
    for i, p in enumerate(near.phrases):
        last = F.max(F.when(F.col("phrase") == number[p], F.col("start"))).over(so_far)
        rows = rows.withColumn(f"_p{i}", last)
        close &= F.coalesce(F.col(f"_p{i}") >= F.col("start") - len(p.words) - near.distance, F.lit(False))
    return rows.where(close).select("doc", F.lit(out).alias("phrase")).distinct()


def matching(postings: DataFrame, tree) -> tuple[DataFrame, list[Phrase]]:
    """(doc, found: {phrase number: places}) of the documents that match, and the phrases by number."""
    phrases, nears = phrases_of(tree), _nears(tree)
    spark = postings.sparkSession
    if not phrases:
        return spark.createDataFrame([], postings.select("doc").schema).withColumn("found", F.expr("map(0, cast(0 as bigint))")), phrases
    words = {w for p in phrases for w in p.words}
    asked = F.lit(False)
    for w in sorted(words):
        asked |= _is_word(*w)
    at = places(postings.where(asked), phrases)
    number = {p: i for i, p in enumerate(phrases)}
    counts = at.groupBy("doc", "phrase").agg(F.count("*").alias("n"))
    for i, near in enumerate(nears):
        number[near] = len(phrases) + i
        counts = counts.unionByName(_near_docs(at, near, number, len(phrases) + i).withColumn("n", F.lit(1).cast("long")))
    columns = [F.sum(F.when(F.col("phrase") == i, F.col("n")).otherwise(0)).alias(f"n{i}") for i in range(len(phrases) + len(nears))]

    def holds(x) -> Column:
        if not isinstance(x, Op):
            return F.col(f"n{number[x]}") > 0 if x in number else F.lit(False)
        a, b = holds(x.left), holds(x.right)
        return a & b if x.kind == "AND" else a | b if x.kind == "OR" else a & ~b

    return counts.groupBy("doc").agg(*columns).where(holds(tree)), phrases
