"""Mixing sources to target weights (dealt operator 11), DataFrame functions only.

Words are summed by source, targets follow from the sources' weights, and a
source's repetition rate is its target over its size.  Every document is
taken floor(rate) times, plus once more where a draw seeded by its digest
falls below the rate's fraction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import global_row_number
from .store import stored

WORD = r"[^\x20\x09-\x0D]+"
_BITS = 52  # of a draw: thirteen hexadecimal digits, exact in a double


def draw(key: Column) -> Column:
    """A number in [0, 1) from the MD5 of a string."""
    return F.conv(F.substring(F.md5(key), 1, _BITS // 4), 16, 10).cast("double") / F.lit(float(1 << _BITS))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
            seed: int = 0, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, source, size (words), key and row of every document, and the columns to carry.

    ``key`` holds the seed, the id (``-`` if null) and the text's MD5; a null
    text is empty.  ``row`` tells rows of equal key apart.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.md5(text))
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), key.alias("key"),
                       F.monotonically_increasing_id().alias("row"), F.struct(*carry).alias("carried") if carry else F.lit(None).alias("carried"))


def repeating_weights(measured: DataFrame, weights: Sequence[int] = (5, 2, 1)) -> DataFrame:
    """source, weight: the weights dealt in turn to the sources by code point, null last."""
    sources = global_row_number(stored(measured.select("source").distinct(), "mix-sources"), [F.col("source").isNull(), "source"], out="at")
    return sources.select("source", F.element_at(F.array(*map(F.lit, weights)), (F.col("at") % len(weights) + 1).cast("int")).alias("weight"))


def source_rates(measured: DataFrame, weights: DataFrame, most: int = 3) -> DataFrame:
    """source, source_size, target, rate, stored.

    The sources share the sum of all sizes by weight.  A target stops at
    ``most`` times its source's size, and what that leaves over is shared
    again by weight until no target is above: every source below its stop has
    the same target a weight.  Each round is one sum over the sources; the
    driver holds two numbers.  A source without words gets none.
    """
    sizes = measured.groupBy("source").agg(F.sum("size").alias("source_size"))
    weights = weights.select(F.col("source").alias("s"), F.col("weight").cast("double").alias("weight"))
    sizes = stored(sizes.join(weights, F.col("source").eqNullSafe(F.col("s"))).drop("s"), "mix-sizes")
    stop = (F.col("source_size") * most).cast("double")
    total, weight = sizes.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
    share, stopped = (total, weight), 0
    while True:
        target = F.lit(float(share[0])) * F.col("weight") / F.lit(share[1] or 1.0)
        above = target > stop
        n, used, open_ = sizes.agg(F.count_if(above), F.coalesce(F.sum(F.when(above, F.col("source_size"))), F.lit(0)),
                                   F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0))).first()
        if n == stopped:
            break
        share, stopped = (total - most * used, open_), n
    target = F.when(above, stop).otherwise(target)
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0))
    return stored(sizes.select("source", "source_size", target.alias("target"), rate.alias("rate")), "mix-rates")


def mix(docs: DataFrame, weights: DataFrame | Sequence[int] = (5, 2, 1), id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", most: int = 3, seed: int = 0, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies of every row, and ``carried`` (a struct of the columns to carry).

    ``weights`` is a table (source, weight) with a row for each source (null
    included), or weights dealt in turn.  Nothing but counts is shuffled by
    source, and documents meet the sources' rates in a join that Spark can
    split; without columns to carry it is over narrow rows.

    Draws depend on seed, id and text, so reruns agree however rows are
    partitioned.  Rows that are equal in id and text draw apart by their place
    in the scan, else a text that a third of the rows share would be taken all
    or not at all; which of them is taken more often depends on the input's
    splits, as they are the same row.  Null ids, null sources (a source of
    their own) and empty texts (size 0) are kept.  An empty table gives no
    rows.  Only the columns named are read, so others may have any name.
    """
    measured = stored(measure(docs, id_col, text_col, source_col, seed).drop("carried"), "mix-measured")
    if not isinstance(weights, DataFrame):
        weights = repeating_weights(measured, weights)
    rates = source_rates(measured, weights, most).withColumnRenamed("source", "s")
    repeated = stored(measured.groupBy("key").count().where("count > 1").select(F.col("key").alias("k")), "mix-repeated")
    rows = measure(docs, id_col, text_col, source_col, seed, carry) if carry else measured.withColumn("carried", F.lit(None))
    rows = rows.join(repeated, F.col("key") == F.col("k"), "left")
    key = F.when(F.col("k").isNull(), F.col("key")).otherwise(F.concat_ws(":", "key", "row"))
    rows = rows.withColumn("key", key).join(rates, F.col("source").eqNullSafe(F.col("s")))
    whole = F.floor("rate")
    copies = whole + (draw(F.col("key")) < F.col("rate") - whole).cast("long")
    out = rows.select("doc_id", "source", "size", "source_size", "target", "rate", copies.alias("copies"), "carried")
    return out if carry else out.drop("carried")


def emit(mixed: DataFrame) -> DataFrame:
    """The mix itself: a row for each copy of each document, numbered from 1 in ``copy``."""
    return mixed.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
