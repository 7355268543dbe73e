"""Distributed Bloom filter of known bad senders (AG17, JN3, UDF1, SNK4, ML13).

A *one-word blocked* Bloom filter (Putze, Sanders, Singler, "Cache-, Hash-
and Space-Efficient Bloom Filters", 2007): a key's k bits all lie in one
64-bit word, chosen by one hash; the bit positions come from a second
hash.  That shape maps onto plain DataFrame operations:

* **build** = one aggregate: ``groupBy(block).agg(bit_or(mask))`` over the
  distinct keys, combined map-side (the partition-filter-then-merge of the
  original, done by Spark's partial/final aggregation);
* **probe** = ``word & mask == mask`` for the word of the key's block — no
  Python, no JVM internals, works on batch and streaming frames.

The filter's size is fixed by (n, fpp) before it is built: ``num_blocks``
words of 8 bytes.  Up to ``MAX_PACKED_BYTES`` all words are one binary value
that goes with the plan, and the probe is a scalar expression: no join, so no
join in a micro-batch either.  A bigger filter's words are broadcast up to
``max_broadcast_blocks``, and joined by shuffle beyond; the hits are the same.
False positives are part of the semantics (at most ``fpp`` on keys never
inserted); false negatives cannot happen; a null key never matches.
"""

from __future__ import annotations

import logging
import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import BLOOM_FPP

BLOCK_BITS = 64
SALT = "fraudflow-bloom-v1"
DEFAULT_MAX_BROADCAST_BLOCKS = 4 << 20     # 4 Mi words = 32 MiB of filter
MAX_PACKED_BYTES = 1 << 20                 # some 700,000 keys at 1 %
log = logging.getLogger(__name__)


def _fpr(bits_per_key: float, k: int) -> float:
    """False-positive rate of a one-word blocked filter (Poisson block load)."""
    lam = BLOCK_BITS / bits_per_key
    p, total = math.exp(-lam), 0.0
    for j in range(0, 600):
        if j:
            p *= lam / j
        total += p * (1.0 - (1.0 - 1.0 / BLOCK_BITS) ** (j * k)) ** k
        if j > lam and p < 1e-18:
            break
    return total


def plan_size(n: int, fpp: float = BLOOM_FPP) -> tuple[int, int]:
    """(num_blocks, k): the fewest bits per key meeting ``fpp``, k <= 10."""
    n = max(int(n), 1)
    c = 1.0
    while c < 200:
        for k in range(1, 11):
            if _fpr(c, k) <= fpp:
                return max(1, math.ceil(n * c / BLOCK_BITS)), k
        c += 0.1
    raise ValueError(f"fpp {fpp} is too small for a one-word blocked filter")


def _hashes(key: Column) -> tuple[Column, Column]:
    k = key.cast("string")
    return F.xxhash64(k), F.xxhash64(F.lit(SALT), k)


def block_of(key: Column, num_blocks: int) -> Column:
    return F.pmod(_hashes(key)[0], F.lit(num_blocks).cast("bigint"))


def mask_of(key: Column, k: int) -> Column:
    h2 = _hashes(key)[1]
    m = None
    for i in range(k):
        pos = F.shiftright(h2, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), pos)
        m = bit if m is None else m.bitwiseOR(bit)
    return m


@dataclass
class BloomFilter:
    """Filter words (``block``, ``word``) as a DataFrame plus its parameters."""
    words: DataFrame
    num_blocks: int
    k: int
    n: int
    fpp: float
    _packed: bytes | None = field(default=None, repr=False, compare=False)

    # -- probe -------------------------------------------------------------
    def packed(self) -> bytes | None:
        """All words in one value, 8 bytes a block, highest first; None for a filter over MAX_PACKED_BYTES."""
        if self._packed is None and self.num_blocks * 8 <= MAX_PACKED_BYTES:
            rows = self.words.select("block", "word").toArrow()
            words = np.zeros(self.num_blocks, ">i8")
            words[rows["block"].to_numpy()] = rows["word"].to_numpy()
            self._packed = words.tobytes()
            self.release()  # later probes don't read the words
        return self._packed

    def hit(self, key: Column) -> Column:
        """The probe as a scalar expression over the packed words; a null key is no hit."""
        if (words := self.packed()) is None:
            raise ValueError(f"a filter of {self.num_blocks} blocks isn't packed: probe it with might_contain")
        at = (block_of(key, self.num_blocks) * 8 + 1).cast("int")
        word = F.conv(F.hex(F.substring(F.lit(words), at, F.lit(8))), 16, -10).cast("bigint")
        mask = mask_of(key, self.k)
        return key.isNotNull() & (word.bitwiseAND(mask) == mask)

    def might_contain(self, df: DataFrame, key: str, out: str = "bf_hit",
                      max_broadcast_blocks: int = DEFAULT_MAX_BROADCAST_BLOCKS, packed: bool = True) -> DataFrame:
        """JN3 / UDF1: add boolean ``out``; null key -> false.

        Without ``packed``, or beyond its bound, the words are joined.  They are broadcast up to ``max_broadcast_blocks`` (as rows of a
        hash table about 64 bytes each, 256 MiB at the default), else shuffled
        to; the answer is the same.  A null key has no block: in a shuffle it
        is dealt out by the whole row's hash, and meets nothing.
        """
        kc = F.col(key)
        if packed and self.packed() is not None:
            return df.withColumn(out, self.hit(kc))
        words = self.words.select(F.col("block").alias("_bf_b"), F.col("word").alias("_bf_w"))
        block = block_of(kc, self.num_blocks)
        if self.num_blocks <= max_broadcast_blocks:
            words = F.broadcast(words)
        else:
            log.info("Bloom filter of %d blocks: probed by a shuffle", self.num_blocks)
            # negative numbers are no blocks
            block = F.coalesce(block, -1 - F.pmod(F.xxhash64(*df.columns), F.lit(1 << 31)))
        probe = df.withColumn("_bf_block", block).withColumn("_bf_mask", mask_of(kc, self.k))
        j = probe.join(words, F.col("_bf_block") == F.col("_bf_b"), "left")
        hit = (kc.isNotNull() &
               (F.coalesce(F.col("_bf_w"), F.lit(0).cast("bigint")).bitwiseAND(F.col("_bf_mask"))
                == F.col("_bf_mask")))
        return j.withColumn(out, hit).drop("_bf_block", "_bf_mask", "_bf_b", "_bf_w")

    def release(self) -> None:
        """Let go of the words held in memory; later probes read them again."""
        self.words.unpersist()

    # -- persistence (SNK4) --------------------------------------------------
    def save(self, path: str) -> None:
        spark = self.words.sparkSession
        self.words.write.mode("overwrite").parquet(f"{path}/words")
        spark.createDataFrame(
            [(self.num_blocks, self.k, self.n, self.fpp, SALT)],
            "num_blocks bigint, k int, n bigint, fpp double, salt string",
        ).coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "BloomFilter":
        meta = spark.read.parquet(f"{path}/meta").first()
        if meta["salt"] != SALT:
            raise ValueError(f"filter at {path} was built with another hash salt")
        nb = int(meta["num_blocks"])
        return BloomFilter(_keep(spark.read.parquet(f"{path}/words"), nb), nb,
                           int(meta["k"]), int(meta["n"]), float(meta["fpp"]))


def build(keys: DataFrame, key: str, n: int | None = None, fpp: float = BLOOM_FPP) -> BloomFilter:
    """AG17: filter over the non-null values of ``key``.

    The keys need not be distinct: ``bit_or`` is idempotent, so repeated
    keys collapse in the partial (map-side) aggregate — no separate
    ``distinct`` shuffle.

    ``n`` is the capacity (the original uses the exact distinct count, which
    the offline job computes anyway).  When not given it is an upper bound
    from a HyperLogLog sketch — map-side, no shuffle of the keys: the
    estimate (rsd 1 %) plus 5 standard deviations.  A larger capacity only
    lowers the false-positive rate.  The words are materialised as a
    checkpoint so every probe reads the same filter.
    """
    ks = keys.where(F.col(key).isNotNull()).select(key)
    if n is None:
        est = ks.agg(F.approx_count_distinct(key, 0.01).alias("n")).first()["n"] or 0
        n = int(math.ceil(est * 1.05)) + 16
    num_blocks, k = plan_size(n, fpp)
    kc = F.col(key)
    words = (ks.select(block_of(kc, num_blocks).alias("block"), mask_of(kc, k).alias("mask"))
               .groupBy("block").agg(F.bit_or("mask").alias("word")))
    words = words.checkpoint(eager=True)
    return BloomFilter(_keep(words, num_blocks), num_blocks, k, int(n), fpp)


def _keep(words: DataFrame, num_blocks: int) -> DataFrame:
    """Hold a broadcastable filter in executor memory: every micro-batch of
    a stream re-broadcasts it, from memory instead of from files.  Bigger
    filters stay on the shared storage (they are joined by shuffle)."""
    if num_blocks <= DEFAULT_MAX_BROADCAST_BLOCKS:
        from pyspark import StorageLevel
        words = words.persist(StorageLevel.MEMORY_AND_DISK)
    return words


def quality_report(bf: BloomFilter, df: DataFrame, label: str = "is_fraud",
                   key: str = "sender_account") -> DataFrame:
    """ML13: false negatives (must be 0), false positives on clean senders,
    and how many transactions the filter flags — one row.

    One aggregate per sender gives both sender sets (bad: a fraud row;
    clean: non-fraud rows only), one probe tags them, and the transaction
    count is one more probe over the rows.
    """
    per = (df.where(F.col(key).isNotNull()).groupBy(key)
             .agg(F.count_if(F.col(label)).alias("_f"),
                  F.count_if(F.col(label) == F.lit(False)).alias("_ok")))
    tagged = bf.might_contain(per, key)
    bad, clean = F.col("_f") > 0, (F.col("_f") == 0) & (F.col("_ok") > 0)
    s = tagged.agg(F.count_if(bad).alias("bad_senders"),
                   F.count_if(bad & ~F.col("bf_hit")).alias("false_negatives"),
                   F.count_if(clean).alias("clean_senders"),
                   F.count_if(clean & F.col("bf_hit")).alias("false_positives"))
    t = bf.might_contain(df.select(key), key).agg(
        F.count(F.lit(1)).alias("total_tx"), F.count_if(F.col("bf_hit")).alias("tx_flagged"))
    cols = ["bad_senders", "false_negatives", "clean_senders", "false_positives",
            "total_tx", "tx_flagged"]

    def pad(d):
        return d.select(*[(F.col(x) if x in d.columns else F.lit(None)).cast("bigint").alias(x)
                          for x in cols])
    # two one-row aggregates, stacked then folded (no cross join)
    one = pad(s).unionByName(pad(t)).agg(*[F.max(x).alias(x) for x in cols])
    return (one.withColumn("fp_rate", F.when(F.col("clean_senders") > 0,
                                             F.col("false_positives") / F.col("clean_senders"))
                                       .otherwise(F.lit(0.0)))
               .withColumn("flagged_ratio", F.when(F.col("total_tx") > 0,
                                                   F.col("tx_flagged") / F.col("total_tx"))
                                             .otherwise(F.lit(0.0))))
