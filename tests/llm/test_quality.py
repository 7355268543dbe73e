"""Operator 8: statistics against plain Python, learned rules, the registered query."""
import random

import pytest

from fraudflow.llm import catalog, quality
from fraudflow.llm.quality import Rule, RuleList, cover, learn_rules, text_statistics
from pyspark.sql import functions as F

from . import brute
from .conftest import EDGE, SMALL, pairs, table

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
LABELS = "doc_id long, quality int, toxic int, text string, n_words string"


def measured(df):
    return {r["doc_id"]: tuple(r[c] for c in BASE) for r in text_statistics(df).collect()}


def test_statistics_of_edge_cases(edge):
    assert measured(edge) == {i: brute.quality_base(t) for i, t in EDGE}


def test_statistics_of_random_texts(spark):
    rng = random.Random(4)
    rows = [(i, "".join(rng.choices(["a", "b", "c", " ", "\n", " ", "#", "é", "\t", "\x0c", "日", "!", "\r"], k=rng.randint(0, 90)))) for i in range(400)]
    assert measured(table(spark, rows)) == {i: brute.quality_base(t) for i, t in rows}


def test_registered_query(spark):
    docs = pairs(spark.read.parquet(f"{SMALL}/documents.parquet"))
    got = {r["doc_id"]: r for r in catalog.QUERIES["op8_quality_rules"](spark, SMALL).collect()}
    assert len(got) == len(docs)
    for i, t in docs:
        w = brute.quality_base(t)
        assert tuple(got[i][c] for c in BASE) == w
        assert got[i]["base_failed"] == (w[0] < 10 or 100 * w[4] > 20 * w[0])
        assert got[i]["kept"] == (not got[i]["base_failed"] and got[i]["rule"] is None)


def test_rules_of_the_middle_table(spark):
    """Rules from part of the labels hold on the rest."""
    stats = text_statistics(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).cache()
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    rules = learn_rules(stats, labels.where(~held))
    out = stats.join(labels.where(held), "doc_id").select("quality", rules.verdict().alias("kept")).groupBy("quality", "kept").count().collect()
    n = {(r["quality"], r["kept"]): r["count"] for r in out}
    stats.unpersist()
    assert n.get((0, False), 0) >= 0.95 * (n.get((0, False), 0) + n.get((0, True), 0))
    assert n.get((1, True), 0) >= 0.98 * (n.get((1, False), 0) + n.get((1, True), 0))


def row(**kw):
    return dict.fromkeys(quality.STATISTICS, 1.0) | kw


def test_covering_finds_a_conjunction():
    rng = random.Random(0)
    rows = []
    for _ in range(900):
        a, b = rng.random(), rng.random()
        rows.append((row(symbols_per_word=a, dup_line_share=b), int(a >= 0.7 and b >= 0.6)))
    rules = cover(rows).rules
    assert len(rules) == 1 and rules[0].misses <= 3 and rules[0].hits >= 0.95 * sum(b for _, b in rows)
    assert {c[0] for c in rules[0].conditions} == {"symbols_per_word", "dup_line_share"}


def test_covering_goes_on_as_long_as_rules_are_found():
    """Twenty separate faults need twenty rules."""
    rng = random.Random(2)
    rows = []
    for i in range(8000):
        at = rng.randrange(40)
        rows.append((row(mean_word_chars=at + rng.random(), n_words=rng.random()), int(at % 2 == 0)))
    rules = cover(rows).rules
    assert len(rules) >= 20
    left = [b for r, b in rows if not any(x.holds(r) for x in rules)]
    assert sum(left) <= 0.02 * sum(b for _, b in rows) and len(left) - sum(left) >= 0.95 * sum(1 - b for _, b in rows)


def test_a_repeated_row_is_one_example(spark):
    docs = [(i, ("## & %% " * 12 if i % 4 == 0 else f"plain words of text {i} go on and on ") * 3) for i in range(240)]
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0, "x", "y") for i, _ in docs], LABELS)
    once = learn_rules(text_statistics(table(spark, docs)), labels)
    often = learn_rules(text_statistics(table(spark, docs + [docs[1]] * 500)), labels)
    assert once.rules and once == often


def test_pruning_drops_what_only_fits_noise():
    rows = [(row(symbols_per_word=float(i % 10), n_words=float(i * 37 % 101)), int(i % 10 >= 8)) for i in range(300)]
    assert [len(r.conditions) for r in cover(rows).rules] == [1]


@pytest.mark.parametrize("marks", [[], [(1, 1), (4, 1)], [(1, 0), (4, 0)], [(None, 0), (4, None), (10**9, 0)], [(4, 0), (4, 1)]])
def test_labels_of_one_kind_or_none(spark, edge, marks):
    labels = spark.createDataFrame([(i, q, 0, "x", "y") for i, q in marks], LABELS)
    rules = learn_rules(text_statistics(edge), labels)
    assert rules.rules == []
    assert all(r["v"] for r in text_statistics(edge).select(rules.verdict().alias("v")).collect())


def test_list_is_ordered(spark, edge):
    rules = RuleList([Rule([("n_words", False, 5.0)]), Rule([("n_words", False, 100.0), ("mean_word_chars", True, 1.0)])])
    got = {r["doc_id"]: r["r"] for r in text_statistics(edge).select("doc_id", rules.rule_number().alias("r")).collect()}
    assert got[1] == got[4] == 1 and got[10] == 2 and got[19] is None


def test_empty_table(empty):
    assert text_statistics(empty).collect() == []


def test_plan_is_native(spark):
    plan = text_statistics(spark.read.parquet(f"{SMALL}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Exchange"))
