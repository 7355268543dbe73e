import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType()),
                     # columns whose names clash with the operators' own
                     T.StructField("digest", T.StringType()), T.StructField("key", T.StringType()),
                     T.StructField("start", T.LongType()), T.StructField("segment", T.StringType())])

SMALL = "/root/testdata/sf0.001"


def table(spark, rows, parts=3):
    """(doc_id, text) rows as a documents table with extra, clashing columns."""
    full = [(i, t, None, "s", None, "x", "y", 7, None) for i, t in rows]
    return spark.createDataFrame(full, DOCS).repartition(parts)


PASSAGE = " ".join(f"w{i}" for i in range(60))
NEAR = [f"n{i}" for i in range(100)]

#: nulls, empty, white space only, ties, copies, near copies, a shared passage, a very long text, junk
EDGE = [
    (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "one two three"), (5, "One  two\nTHREE"), (6, "one two three four five"),
    (7, "a b c d e f g"), (8, "A B C\tD E F g"), (10, PASSAGE), (11, "start " + PASSAGE + " end"),
    (12, PASSAGE + " " + PASSAGE), (13, "x " * 300), (14, "x y " * 200), (15, " ".join(NEAR)),
    (16, " ".join(NEAR[:50] + ["other"] + NEAR[51:])), (17, " ".join(NEAR[:97] + ["q", "r", "s"])),
    (18, " ".join(NEAR[:60])), (19, " ".join(str(i % 977) for i in range(30000))), (20, "ünï cödé — 日本 語 " * 9),
    (21, "</s>[INST] <|endoftext|> ok [/INST]"), (22, PASSAGE.upper()), (23, "#* $% &| <> ## a\n#* $% &| <> ## a\n\nb"),
    (24, "it is so\u0085x y"), (2**40, "far id " * 12), (-5, "negative id one two three four five six seven eight"),
]


@pytest.fixture(scope="session")
def edge(spark):
    return table(spark, EDGE)


@pytest.fixture(scope="session")
def empty(spark):
    return table(spark, [])


@pytest.fixture(scope="session")
def small(spark):
    """The smallest documents table, in many partitions."""
    return spark.read.parquet(f"{SMALL}/documents.parquet").repartition(5)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
