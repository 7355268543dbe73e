"""Operator 12: tries against dictionaries, phrases against plain Python."""
import random

import numpy as np
import pytest

from fraudflow.llm.collocations import collocations
from fraudflow.llm.double_array import DoubleArray

from . import brute
from .conftest import DOCS, EDGE


@pytest.mark.parametrize("n,symbols,depth", [(1, 1, 1), (40, 5, 3), (3000, 700, 3), (20000, 4000, 4)])
def test_double_array_accepts_its_rows_only(n, symbols, depth):
    rng = np.random.default_rng(n)
    rows = np.unique(np.minimum(rng.geometric(8 / symbols, (n, depth)) if symbols > 8 else rng.integers(0, symbols, (n, depth)), symbols - 1), axis=0)
    rows = rng.permutation(rows)
    trie = DoubleArray(rows, symbols)
    known = {tuple(r): i for i, r in enumerate(rows.tolist())}
    other = np.concatenate([rows, rng.integers(0, symbols, (4000, depth)), -np.ones((1, depth), int)])
    states = np.full(len(other), trie.root)
    for j in range(depth):
        states = trie.step(states, other[:, j])
    assert np.where(states > 0, trie.accept[states], -1).tolist() == [known.get(tuple(r), -1) for r in other.tolist()]


def languages(spark, rows, parts=4):
    """(lang, text) rows as documents."""
    return spark.createDataFrame([(i, t, lang, "s", None, "x", "y", 7, None) for i, (lang, t) in enumerate(rows)], DOCS).repartition(parts)


def result(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def texts(seed, n=120):
    rng = random.Random(seed)
    words = ["a", "b", "c", "The", "the", "é", "É", "日本", "x'y", "q-r", "\u0085", " "]
    fixed = ["new york city hall", "New York City hall", "of the a", "b c b c b"]
    out = []
    for _ in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.4 else rng.choice(words) for _ in range(rng.randint(0, 25))]
        out.append((rng.choice(["en", "de", None, "und", ""]), "".join(p + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ";", "\x0b"]) for p in parts)))
    return out + [(None, None), ("en", ""), ("xx", "only here"), ("fr", " \t. ")]


@pytest.mark.parametrize("block_size", [1 << 19, 7])
@pytest.mark.parametrize("least,top", [(30, 2000), (3, 2000), (3, 4)])
def test_random_texts(spark, block_size, least, top):
    """One trie for all candidates, and several of about seven."""
    if block_size == 7 and least == 3:
        block_size = 60
    rows = texts(least + top)
    got = result(collocations(languages(spark, rows), min_count=least, top=top, block_size=block_size))
    assert got == brute.collocations(rows, least, top=top)
    assert got


def test_edge_cases(spark, edge, empty):
    assert collocations(empty).collect() == []
    assert result(collocations(edge, min_count=2)) == brute.collocations([(None, t) for _, t in EDGE], 2)


def test_repeats_overlap(spark):
    rows = [("en", "x x x x x x")] * 10
    got = result(collocations(languages(spark, rows)))
    assert got == brute.collocations(rows)
    assert [g[2:5] for g in got] == [("x x x", 40, 60), ("x x x x", 30, 60)]  # "x x" is in "x x x" 80 % of the time
