"""Operator 11: targets against rounds in plain Python, draws, repeated rows, edge cases."""
import random

import pytest
from pyspark.sql import functions as F

from fraudflow.llm.mixing import emit, measure, mix, repeating_weights, source_rates

from . import brute
from .conftest import DOCS, EDGE


def sourced(spark, rows, parts=3):
    """(doc_id, text, source) rows as documents."""
    return spark.createDataFrame([(i, t, None, s, None, "x", "y", 7, None) for i, t, s in rows], DOCS).repartition(parts)


@pytest.mark.parametrize("seed", range(3))
def test_targets_and_copies(spark, seed):
    rng = random.Random(seed)
    names = [None, "", "b", "B", "é", "z", "\U0001f600", "Ａ"]
    rows = [(i, "w " * rng.choice([0, 1, 5, 60]), rng.choice(names[: 3 + seed * 2]) if i % 3 else names[2]) for i in range(900)]
    docs = sourced(spark, rows)
    got = mix(docs).collect()
    assert len(got) == len(rows)
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len(brute.SPACE_WORDS.findall(t))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    want = brute.mix_targets(size, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    taken = dict.fromkeys(size, 0)
    for r in got:
        assert r["source_size"] == size[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert r["copies"] - r["rate"] < 1 and r["rate"] - r["copies"] < 1 and r["copies"] <= 3
        taken[r["source"]] += r["size"] * r["copies"]
    for s in size:
        assert taken[s] == pytest.approx(want[s], rel=0.25)
    assert sorted(map(tuple, mix(docs.repartition(7)).collect()), key=str) == sorted(map(tuple, got), key=str)


def test_stops_chain(spark):
    """Each round's excess pushes another source over its stop."""
    sizes = {"a": 1, "b": 20, "c": 30, "d": 5000}
    weights = spark.createDataFrame([("a", 1000), ("b", 100), ("c", 10), ("d", 1)], "source string, weight int")
    docs = sourced(spark, [(i, "w " * n, s) for i, (s, n) in enumerate(sizes.items())])
    got = {r["source"]: r["target"] for r in source_rates(measure(docs), weights).collect()}
    assert got == pytest.approx(brute.mix_targets(sizes, {"a": 1000, "b": 100, "c": 10, "d": 1}))
    assert (got["a"], got["b"], got["c"]) == (3, 60, 90)


def test_repeated_rows_draw_apart(spark):
    """A text that most rows share, with one id or none, is taken about as often as its rate says."""
    rows = [(None, "same text here", "a")] * 600 + [(7, "x y", "b")] * 600 + [(i, "z", "c") for i in range(600)]
    got = mix(sourced(spark, rows)).groupBy("source", "target").agg(F.sum(F.col("size") * F.col("copies")).alias("taken")).collect()
    assert len(got) == 3
    for r in got:
        assert r["taken"] == pytest.approx(r["target"], rel=0.2)


def test_edge_cases(spark, edge, empty):
    assert mix(empty).collect() == []
    got = {r["doc_id"]: r for r in mix(edge, carry=("key", "text")).collect()}
    assert {i: r["size"] for i, r in got.items()} == {i: len(brute.SPACE_WORDS.findall(t or "")) for i, t in EDGE}
    assert all(r["copies"] == 1 and r["carried"]["key"] == "y" for r in got.values())  # one source takes all of itself
    nothing = mix(sourced(spark, [(1, None, "a"), (2, "", None)])).collect()
    assert [(r["target"], r["copies"]) for r in nothing] == [(0.0, 0)] * 2


def test_emitted_copies(spark):
    docs = sourced(spark, [(i, "w " * 9, "ab"[i % 5 == 0]) for i in range(50)])
    mixed = mix(docs, (1, 5), carry=("text",))
    rows = emit(mixed).select("doc_id", "copy", "carried.text").collect()
    assert len(rows) == mixed.agg(F.sum("copies")).first()[0]
    assert len({(r["doc_id"], r["copy"]) for r in rows}) == len(rows)
    assert {r["text"] for r in rows} == {"w " * 9}


def test_weights_follow_code_points(spark):
    got = repeating_weights(measure(sourced(spark, [(1, "a", "b"), (2, "a", None), (3, "a", "B"), (4, "a", "\U0001f600"), (5, "a", "Ａ")]))).collect()
    assert {r["source"]: r["weight"] for r in got} == {"B": 5, "b": 2, "Ａ": 1, "\U0001f600": 5, None: 2}
