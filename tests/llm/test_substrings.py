"""Operator 10 against a brute-force version."""
import pytest

from fraudflow.llm import substrings
from fraudflow.llm.substrings import drop_repeats
from pyspark.sql import functions as F

from . import brute
from .conftest import EDGE, pairs, table


def result(df, **kw):
    rows = drop_repeats(df, **kw).withColumn("h", F.sha2("kept_text", 256)).collect()
    return sorted((r["doc_id"], r["n_words"], r["n_removed"], r["h"]) for r in rows)


def expected(rows, k=20):
    return sorted((d, *v) for d, v in brute.substring_dedup(rows, k).items())


def test_edge_cases(edge):
    assert result(edge) == expected(EDGE)


@pytest.mark.parametrize("segment_words", [500, 2_000_000])
def test_small_table(small, segment_words, monkeypatch):
    monkeypatch.setattr(substrings, "SEGMENT_WORDS", segment_words)
    assert result(small) == expected(pairs(small))


def test_short_windows(small):
    assert result(small, min_words=3) == expected(pairs(small), 3)


def test_empty_table(empty):
    assert result(empty) == []


def test_repeated_rows_and_null_ids(spark):
    words = " ".join(f"v{i}" for i in range(30))
    rows = [(None, words), (None, words), (3, words), (3, words), (3, words + " more"), (9, "z " + words)]
    got = [(r["doc_id"], r["n_removed"]) for r in drop_repeats(table(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted([(None, 0), (None, 0), (3, 30), (3, 30), (3, 30), (9, 30)], key=str)


def test_hot_passage_is_spread(spark):
    """A passage in every document: all but its first occurrence go, whatever the partitions."""
    hot = " ".join(f"h{i}" for i in range(25))
    rows = [(i, f"a{i} b{i} {hot} c{i} " + " ".join(f"u{i}_{j}" for j in range(30))) for i in range(300)]
    got = {r["doc_id"]: r["n_removed"] for r in drop_repeats(table(spark, rows, 7)).collect()}
    assert got == {i: 25 if i else 0 for i in range(300)}


def test_registered_query(spark):
    from fraudflow.llm import catalog

    from .conftest import SMALL

    rows = pairs(spark.read.parquet(f"{SMALL}/documents.parquet"))
    got = catalog.QUERIES["op10_substring_dedup"](spark, SMALL).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == expected(rows)


def test_more_groups_than_partitions(small, monkeypatch):
    from fraudflow.llm import store

    monkeypatch.setattr(store, "GROUP_BYTES", 5_000)
    assert result(small) == expected(pairs(small))
