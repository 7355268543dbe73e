"""Operator 5 against a brute-force version."""
from fraudflow.llm import catalog
from fraudflow.llm.positional_index import build_index, decontaminate, search
from fraudflow.session import work_path
from pyspark.sql import functions as F

from . import brute
from .conftest import EDGE, NEAR, PASSAGE, SMALL, pairs, table

ITEMS = [(1, PASSAGE), (2, "One two THREE"), (3, None), (4, ""), (5, "x x x x x x x x x x x"), (7, " ".join(NEAR[40:52])),
         (8, "日本 語 ünï"), (9, "nowhere"), (10, "One two THREE"), (None, "one two three")]


def items(spark, rows=ITEMS):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "item_id long, text string, doc_id string, segment int")


def result(df):
    text = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return sorted((r["doc_id"], r["n_words"], r["n_hit"], r["n"], r["h"], r["n_hit"] > 0)
                  for r in df.withColumn("h", F.sha2(text, 256)).withColumn("n", F.size("items")).collect())


def expected(rows, its):
    return sorted((d, *v) for d, v in brute.decontaminate(rows, [x for x in its if x[0] is not None]).items())


def test_edge_cases(spark, edge):
    assert result(decontaminate(edge, items(spark))) == expected(EDGE, ITEMS)


def test_blocks_of_items(spark, edge):
    assert result(decontaminate(edge, items(spark), block_words=4)) == expected(EDGE, ITEMS)


def test_registered_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    got = catalog.QUERIES["op5_decontamination"](spark, SMALL).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in got) == expected(pairs(docs), bench)
    assert any(r["contaminated"] for r in got)


def test_empty_tables(spark, edge, empty):
    assert result(decontaminate(empty, items(spark))) == []
    assert {r[2] for r in result(decontaminate(edge, items(spark, [])))} == {0}


def test_repeated_rows(spark):
    rows = [(1, PASSAGE)] * 3 + [(None, PASSAGE), (None, "a")]
    got = sorted((r["n_words"], r["n_hit"]) for r in decontaminate(table(spark, rows), items(spark)).collect())
    assert got == [(1, 0), (60, 60), (60, 60), (60, 60), (60, 60)]


def test_proximity(spark):
    path = work_path(spark, "positions-test")
    build_index(table(spark, [(1, "alpha beta gamma"), (2, "alpha and beta gamma"), (3, "gamma beta alpha"), (4, "alpha"),
                              (5, "alpha a b c d e f beta gamma")]), path)
    def at(slop):
        (found,) = search(spark, path, items(spark, [(1, "alpha beta gamma")]), slop=slop)
        return {r["doc_id"]: r["spans"][0]["exact"] for r in found.collect()}
    assert at(0) == {1: True}
    assert at(1) == {1: True, 2: False}
    assert at(2) == {1: True, 2: False, 3: False}


def test_window_of_many_items(spark):
    """A passage that hundreds of items share, in many documents."""
    rows = [(i, f"start{i} {PASSAGE} end{i}" if i % 2 else f"plain text {i}") for i in range(60)]
    its = [(100 + i, PASSAGE if i % 3 else f"{PASSAGE} more{i}") for i in range(400)]
    assert result(decontaminate(table(spark, rows), items(spark, its))) == expected(rows, its)
