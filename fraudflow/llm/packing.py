"""Packing documents into fixed-length token sequences (dealt operator 3).

A document's ids, closed by an end id, are cut at multiples of the sequence
length: every full piece is a sequence of its own.  The rests are packed by
cutting-stock column generation over their length histogram (cutting_stock.py):
lengths are rounded up to classes of ``unit`` tokens, and every class gives its
pieces, ranked by document, to the patterns' places in order.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import work_path
from .cutting_stock import plan
from .tokenize import encoder
from .words import lean


def token_pieces(docs: DataFrame, tokenizer_path: str, size: int = 2048, end_id: int = 1,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, length, doc_tokens, ids: every document's pieces of at most ``size`` ids.

    ``ids`` holds little-endian unsigned 32-bit ids.  A null or empty text is
    the end id alone; every input row is packed, also where ids repeat.
    """
    def run(batches):
        import pyarrow as pa

        lean(tokenizers=True)
        enc = encoder(tokenizer_path)
        for b in batches:
            doc, text = b.column("doc_id"), b.column("text")
            for row, ids, off in enc.ids(text):
                n = np.diff(off) + 1
                flat = np.insert(ids, off[1:], np.uint32(end_id)).astype("<u4")
                first = np.cumsum(n) - n
                k = -(-n // size)
                rows = np.repeat(np.arange(len(n)), k)
                start = (np.arange(len(rows)) - np.repeat(np.cumsum(k) - k, k)) * size
                length = np.minimum(size, n[rows] - start)
                at = first[rows] + start
                bounds = np.concatenate([at, [len(flat)]]).astype(np.int64) * 4
                ids_col = pa.Array.from_buffers(pa.large_binary(), len(rows),
                                                [None, pa.py_buffer(bounds), pa.py_buffer(flat)])
                yield pa.record_batch({
                    "doc_id": doc.take(pa.array(row + rows)), "start": pa.array(start), "length": pa.array(length),
                    "doc_tokens": pa.array(n[rows]), "ids": ids_col.cast(pa.binary())})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, start long, length long, doc_tokens long, ids binary")


def place(pieces: DataFrame, size: int = 2048, unit: int = 16, gap: float = 1e-3) -> DataFrame:
    """``pieces`` (doc_id, start, length, ...) with sequence_id and offset.

    ``pieces`` should be stored: it is read three times.  The histogram has at
    most size / unit classes and the rank offsets a row for each class and
    shuffle partition, whatever the input's size.  Ranks are counted within a
    class and a hash of the document, so a length shared by a third of all
    pieces is ranked in many tasks.
    """
    spark = pieces.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = pieces.withColumns({
        "_class": F.when(F.col("length") == size, 0).otherwise(F.ceil(F.col("length") / unit)).cast("int"),
        "_bucket": F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)).cast("int")})
    counts = rows.groupBy("_class", "_bucket").agg(F.count("*").alias("_n"))
    total = {r["_class"]: r["n"] for r in counts.groupBy("_class").agg(F.sum("_n").alias("n")).collect()}
    full = total.pop(0, 0)
    classes = sorted(total)
    patterns = plan(np.array(classes, np.int64), np.array([total[c] for c in classes], np.int64), size // unit, gap)

    # per class: the first rank, first sequence and multiplicity of each pattern that uses it
    tables, seq = {c: ([], [], []) for c in classes}, full
    given = dict.fromkeys(classes, 0)
    for pattern, n in patterns:
        for i in np.flatnonzero(pattern):
            c, k = classes[i], int(pattern[i])
            for col, v in zip(tables[c], (given[c], seq, k)):
                col.append(v)
            given[c] += n * k
        seq += n
    tables = {c: [np.array(x, np.int64) for x in t] for c, t in tables.items()}

    offsets = counts.select("_class", "_bucket", (F.sum("_n").over(
        Window.partitionBy("_class").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))).alias("_before"))
    ranked = (rows.withColumn("_rank", F.row_number().over(
        Window.partitionBy("_class", "_bucket").orderBy("doc_id", "start", "doc_tokens")) - 1)
        .join(offsets, ["_class", "_bucket"])
        .withColumn("_rank", F.col("_rank") + F.coalesce("_before", F.lit(0)))
        .drop("_before", "_bucket"))

    def seat(batches):
        import pyarrow as pa

        for b in batches:
            cls = b.column("_class").to_numpy(zero_copy_only=False)
            rank = b.column("_rank").to_numpy(zero_copy_only=False)
            out = rank.astype(np.int64)  # class 0: a sequence each
            for c in np.unique(cls):
                if c:
                    first, seqs, k = tables[int(c)]
                    own = cls == c
                    p = np.searchsorted(first, rank[own], "right") - 1
                    out[own] = seqs[p] + (rank[own] - first[p]) // k[p]
            yield pa.record_batch([*(b.column(n) for n in names), pa.array(out)], names=[*names, "sequence_id"])

    names = pieces.columns
    schema = pieces.schema.add("sequence_id", "long")
    seated = ranked.select(*names, "_class", "_rank").mapInArrow(seat, schema)
    before = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start", "doc_tokens")
    return seated.withColumn("offset", F.coalesce(
        F.sum("length").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))


def pack_documents(docs: DataFrame, tokenizer_path: str, size: int = 2048, end_id: int = 1, unit: int | None = None,
                   id_col: str = "doc_id", text_col: str = "text", derive: dict[str, Column] | None = None,
                   keep_ids: bool = True) -> DataFrame:
    """Every piece with its place: doc_id, start, length, doc_tokens, [ids], sequence_id, offset.

    ``derive`` adds columns computed from a piece's row (with its ids) while
    it is cut; ``keep_ids=False`` drops the ids after that.  The pieces are
    written once to the shared work folder, so texts are encoded once.  The
    places are sums over bounded tables; an empty table gives no rows.
    ``unit`` (default size / 128) rounds lengths up: smaller wastes less, costs more.
    """
    unit = unit or max(1, size // 128)
    if size % unit:
        raise ValueError(f"size {size} is no multiple of unit {unit}")
    pieces = token_pieces(docs, tokenizer_path, size, end_id, id_col, text_col).withColumns(derive or {})
    path = work_path(docs.sparkSession, "pieces")
    (pieces if keep_ids else pieces.drop("ids")).write.parquet(path)
    return place(docs.sparkSession.read.parquet(path), size, unit)


def padding(placed: DataFrame, size: int = 2048) -> DataFrame:
    """One row: n_sequences, n_tokens, pad_share (the share of sequence places left empty)."""
    n = F.count_distinct("sequence_id")
    return placed.agg(n.alias("n_sequences"), F.sum("length").alias("n_tokens"),
                      (1 - F.sum("length") / (n * size)).alias("pad_share"))
