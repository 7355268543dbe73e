"""The corpus pipeline: five stages over ``documents``, each one operator of ``fraudflow.llm``.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor
kept, and returns the columns of ``documents``; the last returns packed pieces.
``run`` writes each stage's result to the shared work folder as Parquet and
reads it back as the next one's documents.  A stage stores what it decides (the
rows to drop, the spans to cut) and removes the tables that this took.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudflow.llm.jaccard import near_duplicates
from fraudflow.llm.packing import pack_documents
from fraudflow.llm.positional_index import decontaminate
from fraudflow.llm.store import settled, stored
from fraudflow.llm.substrings import drop_repeats, repeats
from fraudflow.llm.toxicity import fit, score_documents
from fraudflow.operators.ranking import global_row_number
from fraudflow.session import scratch

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
REJECT_SCORE = 0.7  # documents of this toxicity score or more go


def _keyed(docs: DataFrame) -> DataFrame:
    """The documents with a key ``_row`` for each row, as ids may be null or repeat.

    Rows of files are numbered by their file and their place in it, which no
    change of the cluster alters; other tables are stored with their numbers.
    """
    spark, docs = docs.sparkSession, docs.select(*COLUMNS)
    if not docs.inputFiles():
        return stored(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")
    placed = docs.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    files = global_row_number(placed.select("_file").distinct(), ["_file"], out="_n")
    files = stored(files.withColumnRenamed("_file", "_path"), "files")
    return placed.join(files, F.col("_file") == F.col("_path")).select(*COLUMNS, (F.shiftleft("_n", 33) + F.col("_at")).alias("_row"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under REJECT_SCORE, learned from all labels of ``docs``.

    Rows of equal id stay or go by their own texts.
    """
    with scratch(spark, "toxicity"):
        model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_documents(docs, model, carry=COLUMNS).where(F.col("score") < REJECT_SCORE).select(*COLUMNS)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies (0.75 or more on five-word shingles) one document.

    It is that of the smallest id, null last, and of several such rows the
    first.  Documents without words are in no group and stay.  Rows of equal
    id go by their own texts.
    """
    keyed = _keyed(docs)

    def copies():
        rows = near_duplicates(keyed, id_col="_row").where("n_shingles > 0").select(F.col("doc_id").alias("_row"), "component_id")
        rows = rows.join(keyed.select("_row", "doc_id"), "_row")
        rows = stored(rows.select("_row", "component_id", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row").alias("order")), "linked-rows")
        first = stored(rows.groupBy("component_id").agg(F.min("order").alias("first")), "first-rows")
        return rows.join(first, "component_id").where(F.col("_row") != F.col("first._row")).select("_row")

    return keyed.join(settled(spark, "copies", copies), "_row", "left_anti").select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 20 words or more that stand earlier; untouched texts stay as they are."""
    spans = settled(spark, "repeats", lambda: repeats(docs))
    cut = drop_repeats(docs, carry=tuple(c for c in COLUMNS if c not in ("doc_id", "text")), cut=spans)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    n_chars = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return cut.select("doc_id", text.alias("text"), "lang", "source", n_chars.alias("n_chars"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of ten words with a benchmark item.

    Rows of equal id, or without one, stay or go by their own texts.
    """
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed = _keyed(docs)
    hit = settled(spark, "contaminated", lambda: decontaminate(keyed, items, id_col="_row").where(F.col("n_hit") > 0).select(F.col("doc_id").alias("_row")))
    return keyed.join(hit, "_row", "left_anti").select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences of 2048 tokens: doc_id, start, length, doc_tokens, sequence_id, offset, ids_crc32."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), derive={"ids_crc32": F.crc32("ids")}, keep_ids=False)


STAGES = [
    ("toxicity", toxicity),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: cosine neighbours, components and token ids are beyond SQL; tests/llm/test_pipeline.py has a brute-force version
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
