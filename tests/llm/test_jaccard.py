"""Operator 9 against a brute-force version."""
import itertools
import random

import numpy as np
import pytest

from fraudflow.llm import jaccard
from fraudflow.llm.components import components
from fraudflow.llm.jaccard import choose_match, near_duplicates, prefix_length

from . import brute
from .conftest import EDGE, pairs, table


def result(df, **kw):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_duplicates(df, **kw).collect())


def expected(rows, **kw):
    return sorted((d, *v) for d, v in brute.jaccard_join(rows, **kw).items())


def test_edge_cases(edge):
    assert result(edge) == expected(EDGE)


def test_small_table(small):
    got = result(small)
    assert got == expected(pairs(small))
    assert any(d != c for d, _, c in got)


def family(seed, count=120):
    """Copies of a few texts with random edits: many similarities about the threshold."""
    rng, out = random.Random(seed), []
    for f in range(4):
        base = [f"f{f}_{i}" for i in range(rng.choice([9, 40, 120]))]
        for _ in range(count // 4):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
                at = rng.randrange(len(words))
                words[at: at + rng.randint(0, 2)] = [f"e{rng.randrange(40)}"] * rng.randint(0, 2)
            out.append(" ".join(words + base[:rng.choice([0, 0, 3])]))
    return list(enumerate(out))


@pytest.mark.parametrize("seed", range(3))
def test_families(spark, seed, monkeypatch):
    monkeypatch.setattr(jaccard, "SEGMENT_WORDS", 700)
    monkeypatch.setattr(jaccard, "OFTEN", 3)
    rows = family(seed)
    assert result(table(spark, rows, 4)) == expected(rows)


def test_empty_table(empty):
    assert result(empty) == []


def test_null_and_repeated_ids(spark):
    words = " ".join(f"v{i}" for i in range(30))
    rows = [(None, words), (4, words + " x"), (4, words), (4, "other text of five words"), (9, words), (None, None), (None, "a")]
    got = [(r["doc_id"], r["component_id"]) for r in near_duplicates(table(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted([(None, 4), (4, 4), (4, 4), (4, 4), (9, 4), (None, None), (None, None)], key=str)


def test_prefixes_never_miss():
    """Two sets at the threshold share the smaller k within their prefixes, for any k of each."""
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randint(1, 40)
        a = set(rng.sample(range(60), n))
        b = set(a)
        for _ in range(rng.randint(0, n // 3)):
            b.discard(rng.choice(sorted(b))) if b and rng.random() < 0.5 else b.add(rng.randrange(60))
        if not b or 100 * len(a & b) < 75 * len(a | b):
            continue
        for k, m in itertools.product(range(1, 5), repeat=2):
            k, m = (min(j, -(-len(s) * 75 // 100)) for j, s in ((k, a), (m, b)))  # as choose_match has it
            x, y = (set(sorted(s)[: prefix_length(len(s), j, 75)]) for s, j in ((a, k), (b, m)))
            assert len(x & y) >= min(k, m)


def test_match_grows_with_frequent_prefixes():
    rare, often = np.full(90, 2), np.full(90, 10_000)
    assert choose_match(100, often, 75)[0] >= choose_match(100, np.concatenate([rare[:40], often[:50]]), 75)[0]


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(230)] + [(i, i + 1) for i in range(1000, 1060)] + [(7, 7)]
    ids = {x for p in links if p[0] != p[1] for x in p}
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == brute.components(ids, [p for p in links if p[0] != p[1]])
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_registered_query(spark):
    from fraudflow.llm import catalog

    from .conftest import SMALL

    rows = pairs(spark.read.parquet(f"{SMALL}/documents.parquet"))
    got = catalog.QUERIES["op9_ngram_jaccard_join"](spark, SMALL).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == expected(rows)


def test_more_groups_than_partitions(spark, small, monkeypatch):
    """Groups are counted by the text's bytes."""
    from fraudflow.llm import store

    monkeypatch.setattr(store, "GROUP_BYTES", 5_000)
    assert store.group_count(small) > 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert result(small) == expected(pairs(small))
