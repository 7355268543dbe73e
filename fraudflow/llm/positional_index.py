"""Benchmark decontamination over a positional inverted index (dealt operator 5).

``build_index`` stores the postings of every token of the training texts, a
row for each term of a segment (a run of documents of one task): its places on
the segment's line of words.  A segment has all postings of its documents, so lists
are intersected without moving them between segments.

``search`` takes benchmark items in blocks of bounded size.  The frequencies
of a block's terms are summed over the index, and per window the offset-adjusted
lists are intersected from the rarest term on, exactly (a phrase) or within
``slop`` places (proximity).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_path
from .words import LOWER, NON_ALNUM, Powers, lean, slices, span_hashes, spans

INDEX = "segment long, term string, n long, places binary, ids array<long>, sizes array<long>"
MATCHES = "segment long, row int, doc_id long, n_words long, spans array<struct<item_id:long,start:long,end:long,exact:boolean>>"
SEGMENT_WORDS = 1_500_000  # a segment's line of words must stay under 2^32
BLOCK_WORDS = 1_000_000  # words of benchmark items that one search takes at once


def build_index(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                segment_words: int = SEGMENT_WORDS) -> None:
    """Write the positional index of ``docs`` to ``path`` (Parquet on shared storage).

    Words: ASCII letters lower-cased, runs of ASCII letters, digits and
    non-ASCII characters.  A segment's texts stand on one line of words; a
    term's row holds its places on that line (32-bit, ascending), the row
    without a term the segment's doc ids and word counts, which give each
    text's place.  A null text has no words; rows with equal or null ids stay
    apart.  A run of documents ends a segment at about ``segment_words`` words.
    """
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        lean()

        def flush():
            segment = (TaskContext.get().partitionId() << 32) + number
            code, s, e = np.concatenate(codes), np.concatenate(starts), np.concatenate(ends)
            line = np.argsort(code, kind="stable")
            c = code[line]
            head = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]])) if len(c) else np.zeros(0, np.int64)
            places = line.astype("<u4")
            raw = np.concatenate(texts)
            edges = np.append(head, len(c))
            for at in range(0, len(head), 50_000):
                k = edges[at: at + 50_001]
                x, y = s[line[k[:-1]]], e[line[k[:-1]]]
                size = np.cumsum(np.concatenate([[0], y - x]))
                data = raw[np.repeat(x - size[:-1], y - x) + np.arange(size[-1])]
                n = len(k) - 1
                term = pa.Array.from_buffers(pa.string(), n, [None, pa.py_buffer(size.astype(np.int32)), pa.py_buffer(data)])
                where = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(((k - k[0]) * 4).astype(np.int32)), pa.py_buffer(places[k[0]: k[-1]])])
                yield pa.record_batch([pa.array(np.full(n, segment)), term, pa.array(np.diff(k)), where,
                                       pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int64()))], names=fields)
            yield pa.record_batch([pa.array([segment]), pa.array([None], pa.string()), pa.array([len(c)]), pa.array([None], pa.binary()),
                                   pa.array([ids], pa.list_(pa.int64())), pa.array([np.concatenate(sizes)], pa.list_(pa.int64()))], names=fields)

        powers, number, total, size, ids, codes, starts, ends, texts, sizes = Powers(), 0, 0, 0, [], [], [], [], [], []
        for b in batches:
            doc = b.column("doc_id").to_pylist()
            for row, buf, off in slices(b.column("text")):
                low = LOWER[buf]
                s, e, first = spans(low, off, NON_ALNUM)
                codes.append(span_hashes(low, s, e, powers))
                starts.append(s + size)
                ends.append(e + size)
                texts.append(low)
                sizes.append(np.diff(first))
                ids += doc[row: row + len(off) - 1]
                total, size = total + len(s), size + len(low)
                if total >= segment_words:
                    yield from flush()
                    number, total, size, ids, codes, starts, ends, texts, sizes = number + 1, 0, 0, [], [], [], [], [], []
        if ids:
            yield from flush()

    fields = [x.split()[0] for x in INDEX.split(", ")]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows.mapInArrow(run, INDEX).write.parquet(path)


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_words: int) -> Iterator[list[tuple[int, list[str]]]]:
    """The items' words in blocks of about ``block_words`` words, one block on the driver at a time."""
    rows = items.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t")).where("i IS NOT NULL")
    block, size = [], 0
    for r in rows.toLocalIterator():
        raw = LOWER[np.frombuffer((r["t"] or "").encode(), np.uint8)]
        s, e, _ = spans(raw, np.array([0, len(raw)]), NON_ALNUM)
        raw = raw.tobytes()
        block.append((r["i"], [raw[a:b].decode() for a, b in zip(s.tolist(), e.tolist())]))
        size += len(s)
        if size >= block_words:
            yield block
            block, size = [], 0
    if block:
        yield block


def _windows(block, window: int, number: dict[str, int], frequency: np.ndarray) -> dict[int, list]:
    """Windows filed under their rarest term: (terms by number, places from the rarest on, item ids).

    Windows with a term that is nowhere are left out.
    """
    out: dict[tuple, set] = {}
    for item, words in block:
        terms = [number[w] for w in words]
        for j in range(max(1, len(terms) - window + 1) if terms else 0):
            w = tuple(terms[j: j + window])
            if w in out:
                out[w].add(item)
            elif frequency[list(w)].all():
                out[w] = {item}
    filed: dict[int, list] = {}
    for w, ids in out.items():
        order = sorted(range(len(w)), key=lambda k: (frequency[w[k]], k))
        filed.setdefault(w[order[0]], []).append((np.array(w, np.int32), np.array(order, np.int16), sorted(ids)))
    return filed


def _near(places: np.ndarray, want: np.ndarray, slop: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which of ``want`` have one of the ascending ``places`` within ``slop``, from low on and before high."""
    at = np.searchsorted(places, np.maximum(want - slop, low))
    ok = at < len(places)
    ok[ok] = places[at[ok]] <= np.minimum(want + slop, high - 1)[ok]
    return ok


def search(spark: SparkSession, path: str, items: DataFrame, window: int = 10, slop: int = 0, item_id: str = "item_id",
           item_text: str = "text", block_words: int = BLOCK_WORDS) -> list[DataFrame]:
    """A frame for each block of items: segment, row, doc_id, n_words, spans of the documents with matches.

    A window is ``window`` consecutive words of an item, or all words of a
    shorter one.  With ``slop`` 0 a match is the exact phrase.  Otherwise every
    word must stand within ``slop`` places of its place after the rarest
    word's (any order, ``exact`` false unless all stand exactly), and the span
    is the window's length from the start that the rarest word implies.
    """
    index = spark.read.schema(INDEX).parquet(path)
    return [_search_block(spark, index, block, window, slop) for block in item_blocks(items, item_id, item_text, block_words)]


def _search_block(spark: SparkSession, index: DataFrame, block, window: int, slop: int) -> DataFrame:
    terms = sorted({t for _, words in block for t in words})
    number = {t: i for i, t in enumerate(terms)}
    wanted = spark.createDataFrame(list(number.items()), "term string, number int")
    # the block's terms are bounded by block_words; from here on they go by number
    postings = index.where("term IS NOT NULL").join(F.broadcast(wanted), "term")
    frequency = np.zeros(len(terms), np.int64)
    for r in postings.groupBy("number").agg(F.sum("n").alias("n")).collect():
        frequency[r["number"]] = r["n"]
    filed = _windows(block, window, number, frequency)
    windows = spark.sparkContext.broadcast(filed)
    own = postings.select("segment", "number", "places", "ids", "sizes")

    def intersect(group):
        import pyarrow as pa

        lists, ids, sizes, segment = {}, [], [], group.column("segment")[0].as_py()
        for p in group.to_pylist():
            if p["number"] is None:
                ids, sizes = p["ids"], np.array(p["sizes"], np.int64)
            else:
                lists[p["number"]] = p["places"]
        ends = np.cumsum(sizes)
        base = ends - sizes
        ready = {}

        def places(t):
            if t not in ready:
                ready[t] = np.frombuffer(lists[t], "<u4").astype(np.int64)
            return ready[t]

        found = []
        # only windows whose rarest term the segment has
        for w, order, items_ in (x for t in lists for x in windows.value.get(t, ())):
            w, order = w.tolist(), order.tolist()
            if any(t not in lists for t in w):
                continue
            at = places(w[order[0]])
            row = np.searchsorted(ends, at, "right")  # the text that the rarest word stands in
            low, high, at = base[row], ends[row], at - order[0]
            exact = np.ones(len(at), bool)
            for k in order[1:]:
                ok = _near(places(w[k]), at + k, slop, low, high)
                at, exact, row, low, high = (x[ok] for x in (at, exact, row, low, high))
                if not len(at):
                    break
                if slop:
                    exact &= _near(places(w[k]), at + k, 0, low, high)
            begin = at - low
            found += [(int(r), i, max(0, int(b)), int(min(b + len(w), sizes[r])), bool(x))
                      for r, b, x in zip(row, begin, exact) for i in items_]
        found.sort()
        by: dict[int, list] = {}
        for r, i, b, e, x in found:
            by.setdefault(r, []).append({"item_id": i, "start": b, "end": e, "exact": x})
        rows = list(by)
        return pa.table({
            "segment": pa.array([segment] * len(rows), pa.int64()), "row": pa.array(rows, pa.int32()),
            "doc_id": pa.array([ids[r] for r in rows], pa.int64()), "n_words": pa.array([int(sizes[r]) for r in rows], pa.int64()),
            "spans": pa.array(list(by.values()), span_type)})

    import pyarrow as pa

    span_type = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("exact", pa.bool_())]))
    documents = index.where("term IS NULL").select("segment", F.lit(None).cast("int").alias("number"), "places", "ids", "sizes")
    # neither side is dealt by segment yet: one shuffle brings a segment's postings and its documents together
    return own.unionByName(documents).groupBy("segment").applyInArrow(intersect, MATCHES)


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, items (ascending ids) for every row of ``docs``.

    A document word is hit if any exact occurrence of an item's window covers
    it.  Items with null id are left out, items of equal id are one.  No items
    or no words: no hits.  Passages that a third of all documents share cost
    each segment the matches in its own documents.
    """
    spark = docs.sparkSession
    path = work_path(spark, "positions")
    build_index(docs, path, id_col, text_col)
    index = spark.read.schema(INDEX).parquet(path)
    every = index.where("term IS NULL").select("segment", F.arrays_zip("ids", "sizes").alias("z")).selectExpr(
        "segment", "posexplode(z) AS (row, d)").select("segment", "row", F.col("d.ids").alias("doc_id"), F.col("d.sizes").alias("n_words"))
    blocks = search(spark, path, items, window, 0, item_id, item_text, block_words)
    if not blocks:
        return every.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<long>").alias("items"))
    found = blocks[0]
    for more in blocks[1:]:
        found = found.unionByName(more)
    found = found.groupBy("segment", "row").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    # words covered by the spans, in the order of their starts
    covered = F.aggregate(F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("b"), s["end"].alias("e")))),
                          F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto")),
                          lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), s["e"] - F.greatest(s["b"], a["upto"]))).alias("n"),
                                                F.greatest(a["upto"], s["e"]).alias("upto")),
                          lambda a: a["n"])
    found = found.select("segment", "row", covered.alias("n_hit"),
                         F.array_sort(F.array_distinct(F.transform("spans", lambda s: s["item_id"]))).alias("items"))
    return every.join(found, ["segment", "row"], "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<long>")).alias("items"))
