"""Quality rules as a learned decision list (dealt operator 8), DataFrame functions only.

``text_statistics`` measures texts in one projection.  ``learn_rules`` grows
conjunctions of thresholds by sequential covering on a bounded sample of
labelled rows and prunes them on rows kept apart; ``RuleList.verdict`` is the
list as one ordered conditional expression.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYMBOLS = "#*$%&|<>"
MAX_EXAMPLES = 20_000  # labelled rows that rules are learned from, the smallest by a hash of their id
#: what rules may ask about, from the columns of text_statistics
STATISTICS = {
    "n_words": "n_words",
    "mean_word_chars": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "bangs_per_word": "n_bangs / greatest(n_words, 1)",
    "distinct_word_share": "n_distinct_words / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_word_share": "n_repeat_words / greatest(n_words, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once: the only element of an array, transformed."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _covered(places: Column, width: int) -> Column:
    """Words covered by windows that start at ascending places."""
    step = F.transform(places, lambda p, i: F.least(F.lit(width), F.coalesce(F.get(places, i + 1) - p, F.lit(width))))
    return F.aggregate(step, F.lit(0), lambda a, x: a + x)


def repeat_words(words: Column, width: int = 5) -> Column:
    """Words in windows of ``width`` words that a text has twice or more.

    Windows are compared by a 64-bit hash; only texts with an equal pair sort
    them, so the work is n log n at most.
    """
    def grams(w):
        return F.transform(F.sequence(F.lit(0), F.size(w) - width), lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(width))))

    def places(s):
        twice = F.transform(s, lambda x, i: F.when((x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]), x["p"]))
        return F.array_sort(F.filter(twice, lambda p: p.isNotNull()))

    def several(g):
        pairs = F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        return F.when(F.size(F.array_distinct(g)) < F.size(g), let(pairs, lambda s: let(places(s), lambda p: _covered(p, width)))).otherwise(0)

    return F.when(F.size(words) > width, let(grams(words), several)).otherwise(0)


def _occurrences(text: Column, character: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(character), F.lit("")))


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the counts of every whole text; a null text is empty.

    Words are runs without space, tab, line feed, vertical tab, form feed and
    carriage return.  word_chars: code points in words.  n_symbols: any of
    ``#*$%&|<>``.  n_lines: line-feed-separated lines with a word.
    n_dup_lines: those equal to an earlier one.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    symbols = F.col("t")
    for c in SYMBOLS:
        symbols = F.replace(symbols, F.lit(c), F.lit(""))

    def lines(x):
        return F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))

    def words(w):
        return F.struct(F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                        F.size(F.array_distinct(w)).cast("long").alias("n_distinct_words"), repeat_words(w).cast("long").alias("n_repeat_words"))

    split = F.array_remove(F.split("t", r"[ \t\n\x0b\f\r]+"), "")
    with_word = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^ \t\n\x0b\f\r]"))
    return rows.select("doc_id", let(split, words).alias("w"), let(with_word, lines).alias("l"),
                       (F.length("t") - F.length(symbols)).cast("long").alias("n_symbols"),
                       _occurrences(F.col("t"), "!").cast("long").alias("n_bangs")).select("doc_id", "w.*", "l.*", "n_symbols", "n_bangs")


@dataclass
class Rule:
    """A conjunction of (statistic, at least, threshold) that rejects, and its record on pruning rows."""

    conditions: list[tuple[str, bool, float]]
    hits: int = 0
    misses: int = 0

    def holds(self, row: dict[str, float]) -> bool:
        return all((row[s] >= v) if at_least else (row[s] < v) for s, at_least, v in self.conditions)

    def column(self) -> Column:
        out = F.lit(True)
        for s, at_least, v in self.conditions:
            c = F.expr(STATISTICS[s]).cast("double")
            out = out & ((c >= v) if at_least else (c < v))
        return out

    def __str__(self) -> str:
        return " and ".join(f"{s} {'>=' if g else '<'} {v:.4g}" for s, g, v in self.conditions)


@dataclass
class RuleList:
    rules: list[Rule] = field(default_factory=list)

    def rule_number(self) -> Column:
        """The number (from 1) of the first rule that holds, else null."""
        out = None
        for i, r in enumerate(self.rules, 1):
            out = F.when(r.column(), i) if out is None else out.when(r.column(), i)
        return F.lit(None).cast("int") if out is None else out

    def verdict(self) -> Column:
        """True: keep."""
        return self.rule_number().isNull()


def _gain(p: int, n: int, before: float) -> float:
    return p * (math.log2(p / (p + n)) - before) if p else 0.0


def _best_condition(rows: list[tuple[dict, int]], cuts: int) -> tuple[float, tuple[str, bool, float]] | None:
    """The condition of the largest information gain over rows (statistics, 1 for bad)."""
    bad = sum(b for _, b in rows)
    good, best = len(rows) - bad, None
    before = math.log2(bad / len(rows))
    for s in STATISTICS:
        values = sorted((r[s], b) for r, b in rows)
        step, below_bad, last = max(1, len(values) // cuts), 0, None
        for i, (v, b) in enumerate(values):
            # a threshold is a value with smaller ones below it; bad rows' values are all tried where they're few
            if last is not None and v > last and (i % step == 0 or b or values[i - 1][1]):
                for at_least, p, n in ((True, bad - below_bad, good - (i - below_bad)), (False, below_bad, i - below_bad)):
                    g = _gain(p, n, before)
                    if g > 0 and (best is None or g > best[0]):
                        best = (g, (s, at_least, (v + last) / 2))
            below_bad, last = below_bad + b, v
    return best


def _grow(rows: list[tuple[dict, int]], cuts: int) -> list[tuple[str, bool, float]]:
    """Conditions until none but bad rows hold them, or none tells more (each leaves fewer rows)."""
    conditions: list[tuple[str, bool, float]] = []
    while any(not b for _, b in rows):
        found = _best_condition(rows, cuts)
        if found is None:
            break
        conditions.append(found[1])
        one = Rule([found[1]])
        rows = [x for x in rows if one.holds(x[0])]
    return conditions


def _record(conditions, rows) -> tuple[int, int]:
    rule = Rule(conditions)
    held = [b for r, b in rows if rule.holds(r)]
    return sum(held), len(held) - sum(held)


def _prune(conditions, rows):
    """The leading conditions of the largest (hits - misses) / (hits + misses), the fewest of equals."""
    best, kept = None, conditions
    for k in range(1, len(conditions) + 1):
        p, n = _record(conditions[:k], rows)
        worth = (p - n) / (p + n) if p + n else -1.0
        if best is None or worth > best + 1e-9:
            best, kept = worth, conditions[:k]
    return kept


def cover(rows: list[tuple[dict, int]], precision: float = 0.95, least: int = 5, cuts: int = 64) -> RuleList:
    """Ordered rules that reject bad rows, by sequential covering (rows: statistics, 1 for bad).

    Every third row prunes, the others grow.  A rule is taken if on all rows
    left it hits ``least`` bad ones at ``precision`` or better; then what it
    covers is taken away.  It ends when no rule is good enough, after as many
    rules as that takes: at most one for each ``least`` bad rows.
    """
    out = RuleList()
    while True:
        grow, prune = [x for i, x in enumerate(rows) if i % 3], rows[::3]
        if sum(b for _, b in grow) < least:
            break
        conditions = _grow(grow, cuts)
        if not conditions:
            break
        conditions = _prune(conditions, prune)
        p, n = _record(conditions, rows)
        if p < least or p < precision * (p + n):
            break
        out.rules.append(Rule(conditions, p, n))
        rows = [x for x in rows if not out.rules[-1].holds(x[0])]
    return out


def learn_rules(statistics: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES, **kw) -> RuleList:
    """Rules from the statistics of rows with a quality label (0: bad, 1: good).

    At most ``max_examples`` labelled rows come to the driver, as eight
    numbers each: those of the smallest hash of their id, the one bounded
    sample.  Rows equal in id and statistics count once.  Null ids and labels
    are left out; an id labelled twice is good only if both say so.  Labels of one kind or none give an empty list.
    """
    marked = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").alias("_id"))
              .agg(F.min("quality").cast("int").alias("quality"))
              .orderBy(F.xxhash64("_id"), "_id").limit(max_examples))
    numbers = [F.expr(e).cast("double").alias(s) for s, e in STATISTICS.items()]
    # at most max_examples rows are broadcast
    rows = statistics.join(F.broadcast(marked), F.col("doc_id") == F.col("_id")).select("doc_id", "quality", *numbers).distinct()
    rows = rows.orderBy(F.xxhash64("doc_id"), *rows.columns).limit(max_examples).collect()
    rows.sort(key=lambda r: tuple(r))
    return cover([({s: r[s] for s in STATISTICS}, 1 - r["quality"]) for r in rows], **kw)
