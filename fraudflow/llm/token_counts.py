"""Token counts with a digest cache (dealt operator 4)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists
from .store import stored
from .tokenize import encoder, version
from .words import lean

CACHE_SCHEMA = "digest binary, tokenizer string, n_tokens long"


def read_cache(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    """Stored counts of one tokenizer version (digest, n_tokens), one row a digest."""
    if not path_exists(spark, cache):
        spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache)  # makes an empty cache readable
    rows = spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("tokenizer") == tokenizer)
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, tokenizer_path: str, cache: str, id_col: str = "doc_id",
                 text_col: str = "text", limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs``.

    The normalised content is the text with null as empty; any further
    normalisation would change counts.  Its SHA-256 and the tokenizer's
    digest are joined to the stored counts in ``cache`` (a Parquet folder on
    shared storage).  Of the digests that miss, the text of one id each is
    encoded, rows equal in id and text once a batch, and one row a digest is
    appended, so a later call over grown data encodes only what is new.  An
    append that fails half-way leaves no rows; one done twice is harmless, as
    equal digests have equal counts.

    Null ids and repeated rows keep a result row each.  Only the columns
    named are read, so others may have any name.
    """
    spark = docs.sparkSession
    tokenizer = version(tokenizer_path)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    keys = rows.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))

    # one id of each missing digest; ids only, so hot texts meet as one partial row a task
    misses = (keys.groupBy("digest").agg(F.min(F.struct("doc_id")).alias("own"))
              .join(read_cache(spark, cache, tokenizer), "digest", "left_anti")
              .select(F.col("digest").alias("d"), F.col("own.doc_id").alias("i")))
    texts = rows.join(misses, (F.col("digest") == F.col("d")) & F.col("doc_id").eqNullSafe(F.col("i")), "left_semi")

    def encode(batches):
        import pyarrow as pa

        lean(tokenizers=True)
        counts, last = encoder(tokenizer_path).counts, None
        for b in batches:
            # rows equal in id and text come one after the other from the join
            codes = b.column("digest").dictionary_encode()
            at = np.unique(codes.indices.to_numpy(zero_copy_only=False), return_index=True)[1]
            digests = b.column("digest").take(pa.array(at))
            at = pa.array([i for i, d in zip(at.tolist(), digests.to_pylist()) if d != last], pa.int64())
            last = b.column("digest")[-1].as_py() if len(codes) else last
            yield pa.record_batch({"digest": b.column("digest").take(at), "n_tokens": pa.array(counts(b.column("text").take(at)))})

    found = texts.select("digest", "text").mapInArrow(encode, "digest binary, n_tokens long")
    (found.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
     .select("digest", F.lit(tokenizer).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache))
    return (keys.join(stored(read_cache(spark, cache, tokenizer), "token-counts"), "digest")
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
