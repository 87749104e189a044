"""Quality rules as a short-circuit cascade, in DataFrame operations only.

Each rule rejects rows by a condition over text measures. On a bounded sample (``SAMPLE_ROWS`` rows, the smallest by hash of id and text)
the work of each measure is estimated (``WORK``, in characters touched) and the rows that each rule rejects are counted. The next
rule is always the one that rejects most of the sample rows left, per work for measures that no earlier rule has taken. Equal samples
give equal orders, on every run and cluster.

The cascade is one nested expression: a measure is taken where the first rule needs it, and only for rows that no earlier rule
rejected; later rules use it again. The order never changes which rows are kept, only ``first_failed`` and the work.

Measures are row-local array functions: no shuffle, and memory in proportion to one text. Nulls count as texts
without words. Repeated rows get equal results. Columns other than the named ones aren't read; ``keep_good`` keeps them all.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 1024
_SPACE = "\t\n\u000b\u000c\r"
_SYMBOLS = "#*$%&|<>"
_UP = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _without(c: Column, chars: str) -> Column:
    return F.translate(c, chars, "")


def words(c: Column) -> Column:
    return F.array_remove(F.split(F.translate(_text(c), _SPACE, " " * len(_SPACE)), " "), "")


def word_chars(c: Column) -> Column:
    return F.length(_without(_text(c), f" {_SPACE}")).cast("long")


def n_symbols(c: Column) -> Column:
    return (F.length(_text(c)) - F.length(_without(_text(c), _SYMBOLS))).cast("long")


def n_upper(c: Column) -> Column:
    return (F.length(_text(c)) - F.length(_without(_text(c), _UP))).cast("long")


def lines(c: Column) -> Column:
    """The \\n-split lines that have a word."""
    return F.filter(F.split(_text(c), "\n"), lambda x: F.length(_without(x, f" {_SPACE}")) > 0)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is built once, however often it's used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def n_repeat_words(w: Column) -> Column:
    """Words of the array in three-word windows that the array has twice or more, the first of them included.

    Windows are compared by hash; they're sorted only where the distinct ones are fewer than all.
    """

    def covered(o: Column) -> Column:
        same = lambda j, k: F.coalesce(F.get(o, j)["h"] == F.get(o, k)["h"], F.lit(False))
        twice = F.filter(o, lambda x, j: same(j, j + 1) | ((j > 0) & same(j, j - 1)))
        return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

    def counted(g: Column) -> Column:
        ordered = F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(g)) < F.size(g), _let(ordered, covered)).otherwise(0)

    grams = F.slice(F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))), F.lit(1), F.greatest(F.size(w) - 2, F.lit(0)))
    return _let(grams, counted).cast("long")


def _line_counts(c: Column) -> Column:
    return _let(lines(c), lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))


#: What measures are made of: how a part is built from the text, and its work, in characters touched, as a condition over the text alone.
_LENGTH = lambda t: F.length(_text(t))
PARTS: dict[str, Callable[[Column], Column]] = {"words": words, "lines": _line_counts}
PART_WORK: dict[str, Callable[[Column], Column]] = {"words": lambda t: 4 * _LENGTH(t), "lines": lambda t: 3 * _LENGTH(t)}
#: Measures by name: the part they use (none: the text), how they come from it, and their work beyond the part's.
MEASURES: dict[str, tuple[str | None, Callable[[Column], Column], Callable[[Column], Column]]] = {
    "n_words": ("words", lambda w: F.size(w).cast("long"), lambda t: F.lit(1)),
    "word_chars": (None, word_chars, lambda t: 2 * _LENGTH(t)),
    "n_symbols": (None, n_symbols, lambda t: 2 * _LENGTH(t)),
    "n_upper": (None, n_upper, lambda t: 2 * _LENGTH(t)),
    "n_lines": ("lines", lambda x: x["n"], lambda t: F.lit(1)),
    "n_dup_lines": ("lines", lambda x: x["dup"], lambda t: F.lit(1)),
    "n_repeat_words": ("words", n_repeat_words, lambda t: 12 * _LENGTH(t)),
}
Measure = Callable[[str], Column]


@dataclass(frozen=True)
class QualityRule:
    """``rejects`` is a condition over measures, got by name; ``needs`` are their names."""

    name: str
    needs: tuple[str, ...]
    rejects: Callable[[Measure], Column]


#: Base rules of the contract, then rules on symbols, capitals and repeated lines.
RULES = (
    QualityRule("short", ("n_words",), lambda m: m("n_words") < 50),
    QualityRule("repeats", ("n_repeat_words", "n_words"), lambda m: 100 * m("n_repeat_words") > 50 * m("n_words")),
    QualityRule("symbols", ("n_symbols", "n_words"), lambda m: 10 * m("n_symbols") > m("n_words")),
    QualityRule("capitals", ("n_upper", "word_chars"), lambda m: 100 * m("n_upper") > 35 * m("word_chars")),
    QualityRule("lines", ("n_dup_lines", "n_lines"), lambda m: 10 * m("n_dup_lines") > 4 * m("n_lines")),
)


def _needed(rule: QualityRule, have: set[str]) -> list[str]:
    """Parts and measures that the rule needs beyond those at hand, parts first."""
    out = [MEASURES[m][0] for m in rule.needs if m not in have and MEASURES[m][0] and MEASURES[m][0] not in have]
    return list(dict.fromkeys(out)) + [m for m in rule.needs if m not in have]


def rule_order(df: DataFrame, rules: tuple[QualityRule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE_ROWS, ready: frozenset[str] = frozenset()) -> list[QualityRule]:
    """The rules in cascade order. ``ready``: measures that cost nothing, since they are taken for each row anyway."""
    text = F.col("_text")
    # Few rows beyond those wanted come to the sort.
    share = min(1.0, 8 * rows / max(df.count(), 1))
    sample = df.select(df[text_col].alias("_text"), F.xxhash64(F.col(id_col).cast("string"), text_col).alias("_h")).where(F.shiftrightunsigned("_h", 33) < int(share * 2**31)).orderBy("_h").limit(rows)
    work = {**PART_WORK, **{m: w for m, (_, _, w) in MEASURES.items()}}
    measured = {m: _let(PARTS[p](text), f) if p else f(text) for m, (p, f, _) in MEASURES.items()}
    flags = [F.coalesce(r.rejects(measured.__getitem__), F.lit(False)).alias(f"r{i}") for i, r in enumerate(rules)]
    counts = sample.select(*flags, *(w(text).alias(f"w_{m}") for m, w in work.items())).groupBy(*(f"r{i}" for i in range(len(rules))))
    # A row for each set of rules that reject together, at most 2**len(rules) and at most one a sample row.
    got = counts.agg(F.count("*").alias("n"), *(F.sum(f"w_{m}").alias(f"w_{m}") for m in work)).collect()
    order, have, left = [], set(ready), list(range(len(rules)))
    while left:
        alive = [r for r in got if not any(r[f"r{i}"] for i in order)]
        gain = {i: sum(r["n"] for r in alive if r[f"r{i}"]) for i in left}
        cost = {i: sum(r[f"w_{m}"] or 0 for r in alive for m in _needed(rules[i], have)) + 1 for i in left}
        best = max(left, key=lambda i: (gain[i] / cost[i], -cost[i], -i))
        order.append(best)
        left.remove(best)
        have |= {*_needed(rules[best], have)}
    return [rules[i] for i in order]


def cascade(order: list[QualityRule], text: Column, ready: dict[str, Column] | None = None) -> Column:
    """The name of the first rule in ``order`` that rejects, or null. ``ready`` has measures that need not be taken."""

    def check(i: int, have: dict[str, Column]) -> Column:
        if i == len(order):
            return F.lit(None).cast("string")

        def take(names: list[str], have: dict[str, Column]) -> Column:
            if not names:
                return F.when(order[i].rejects(have.__getitem__), F.lit(order[i].name)).otherwise(check(i + 1, have))
            name = names[0]
            if name in PARTS:
                value = PARTS[name](text)
            else:
                part, f, _ = MEASURES[name]
                value = f(have[part] if part else text)
            return _let(value, lambda x: take(names[1:], {**have, name: x}))

        return take(_needed(order[i], set(have)), have)

    return check(0, ready or {})


#: Measures that ``quality_cascade`` gives for each row; the others are taken only where a rule needs them.
GIVEN = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality_cascade(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[QualityRule, ...] = RULES) -> DataFrame:
    """One row per input row: id, the measures of GIVEN (long), first_failed (null: none) and kept."""
    # Lines are counted and compared at once, so n_lines is at hand where n_dup_lines is.
    ready = (*GIVEN, "n_lines")
    order = rule_order(df, rules, id_col, text_col, ready=frozenset(ready))
    t = df[text_col]
    both = _let(words(t), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), n_repeat_words(w).alias("n_repeat_words")))
    m = df.select(df[id_col].alias("id"), t.alias("_text"), both.alias("w"), _line_counts(t).alias("l"), word_chars(t).alias("word_chars"), n_symbols(t).alias("n_symbols"))
    m = m.select("id", "_text", "w.n_words", "word_chars", "n_symbols", F.col("l.n").alias("n_lines"), F.col("l.dup").alias("n_dup_lines"), "w.n_repeat_words")
    m = m.withColumn("first_failed", cascade(order, F.col("_text"), {x: F.col(x) for x in ready}))
    return m.select(F.col("id").alias(id_col), *GIVEN, "first_failed", F.col("first_failed").isNull().alias("kept"))


def keep_good(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[QualityRule, ...] = RULES) -> DataFrame:
    """The rows of ``df`` that no rule rejects; one filter, so a rejected row costs only the measures up to the rule that rejects it."""
    return df.where(cascade(rule_order(df, rules, id_col, text_col), df[text_col]).isNull())
