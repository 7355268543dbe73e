"""Similarity join on word n-grams with adaptive multi-match prefixes (dealt operator 9).

After Wang, Li, Feng, "Can We Beat the Prefix Filtering?" (2012).  A text is
the set of its 64-bit shingle hashes.  With all shingles in one global order,
rarest first, two sets with at least ``o`` in common share at least ``k`` of
their first ``n - o + k`` shingles.  Each text picks its ``k`` by the cost of
the postings that its longer prefix meets and of the candidates left, and a
pair is verified if it shares the smaller ``k`` of the two.

Shingles that only one text has can't be shared; they come first in the order
and are counted, never sent back or joined.  Equal sets are one class.  In
every posting list the most central text is compared with all others first.
Pairs that this has joined need no more comparison.  Of the others, two that
were compared with the same central text follow where what they have in common
with it could do, or where they share a shingle that it lacks; all pairs
without such a text follow.  So a group of near copies costs about its size,
and no link that would join two components is lost.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, LongType, StructField, StructType

from .components import components
from .store import group_count, stored
from .words import (LOWER, SPACES, U64, Powers, grams, lean, mix, multipliers, pack, pack_sorted, slices, span_hashes,
                    spans, unpack, unpack_sorted)

SEGMENT_WORDS = 600_000  # words that a task gathers before it sends shingles on
OFTEN = 16  # a shingle of more documents of a segment is sent once, with their number
MAX_MATCH = 8  # longest multi-match
VERIFY_COST = 16  # of comparing two sets, in postings read
SEED = 5
PARTS = "segment long, kind int, bucket int, codes binary, rows binary, counts binary, ids array<long>, sizes array<long>, sets array<binary>"
TEXTS = "doc_id long, n long, set_id binary, shingles binary, counts binary"


def _shingles(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each text, by row; a shorter text is one shingle."""
    h, ok = grams(words, first, n, SEED)
    at = np.flatnonzero(ok)
    rows = np.searchsorted(first, at, "right") - 1
    h = h[at]
    size = np.diff(first)
    short = np.flatnonzero((size > 0) & (size < n))
    if len(short):
        k = multipliers(n, SEED + 1)
        own = np.zeros(len(short), U64)
        for j in range(n - 1):
            has = size[short] > j
            own[has] += words[first[short[has]] + j] * k[j]
        rows = np.concatenate([rows, short])
        h = np.concatenate([h, mix(own + size[short].astype(U64))])
    order = np.lexsort((h, rows))
    rows, h = rows[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (h[1:] != h[:-1])
    return rows[new], h[new]


def _segments(batches, n: int):
    """(ids, rows, hashes) of runs of documents of one task."""
    powers, ids, rows, hashes, words_seen, docs = Powers(), [], [], [], 0, 0
    for b in batches:
        doc = b.column("doc_id").to_pylist()
        for at, buf, off in slices(b.column("text")):
            low = LOWER[buf]
            s, e, first = spans(low, off, SPACES)
            r, h = _shingles(span_hashes(low, s, e, powers), first, n)
            rows.append(r + docs)
            hashes.append(h)
            ids += doc[at: at + len(off) - 1]
            docs, words_seen = docs + len(off) - 1, words_seen + len(s)
            if words_seen >= SEGMENT_WORDS:
                yield ids, np.concatenate(rows), np.concatenate(hashes)
                ids, rows, hashes, words_seen, docs = [], [], [], 0, 0
    if ids:
        yield ids, np.concatenate(rows), np.concatenate(hashes)


def texts_with_counts(docs: DataFrame, n: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """TEXTS: every row's set size and set id, with its shared shingles in the global order.

    ``shingles`` (64-bit) and ``counts`` (how many rows have each) leave out
    those of one row only, and are null where so many are that no other text
    can reach the threshold.  ``set_id`` is an order-free 128-bit digest.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    buckets = group_count(rows)
    fields = [x.split()[0] for x in PARTS.split(", ")]

    def _batch(parts):
        import pyarrow as pa

        types = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(),
                 pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.binary()))
        return [pa.record_batch([pa.array(x, t) for x, t in zip(zip(*parts[i: i + 64]), types)], names=fields)
                for i in range(0, len(parts), 64)]

    def send(batches):
        from pyspark import TaskContext

        lean()
        for number, (ids, rows, hashes) in enumerate(_segments(batches, n)):
            segment = (TaskContext.get().partitionId() << 32) + number
            size = np.bincount(rows, minlength=len(ids))
            edge = np.concatenate([[0], np.cumsum(size)])
            digest = np.zeros((len(ids), 2), U64)
            for k in (0, 1):
                total = np.zeros(len(hashes) + 1, U64)
                np.cumsum(mix(hashes + U64(k + 1)), dtype=U64, out=total[1:])
                digest[:, k] = total[edge[1:]] - total[edge[:-1]]
            sets = [x.tobytes() for x in digest]
            order = np.argsort(hashes, kind="stable")
            h, r = hashes[order], rows[order]
            new = np.ones(len(h), bool)
            new[1:] = h[1:] != h[:-1]
            head = np.flatnonzero(new)
            count = np.diff(np.append(head, len(h)))
            often = np.repeat(count > OFTEN, count)
            hot = count > OFTEN
            # the rows of what is sent once stay with the segment's documents
            parts = [(segment, 1, int(segment % buckets), pack_sorted(h[head[hot]]), pack(r[often]), pack(count[hot]),
                      ids, size.tolist(), sets)]
            once = head[hot]
            h = np.concatenate([h[~often], h[once]])
            r = np.concatenate([r[~often], np.full(len(once), len(ids))])
            w = np.concatenate([np.ones(int((~often).sum()), np.int64), count[hot]])
            bucket = (h % U64(buckets)).astype(np.int32)
            by = np.lexsort((h, bucket))
            h, r, w = h[by], r[by], w[by]
            edges = np.searchsorted(bucket[by], np.arange(buckets + 1))
            for k in np.flatnonzero(np.diff(edges)):
                x = slice(edges[k], edges[k + 1])
                parts.append((segment, 0, int(k), pack_sorted(h[x]), pack(r[x]), pack(w[x]), None, None, None))
            yield from _batch(parts)

    def count(group):
        """How many rows have each shingle of a bucket; those of one row are left out."""
        import pyarrow as pa

        kind = group.column("kind").to_numpy()
        keep = group.filter(pa.array(kind == 1))
        sent = group.filter(pa.array(kind == 0)).select(["segment", "codes", "rows", "counts"]).to_pylist()
        out = []
        if sent:
            codes = [unpack_sorted(p["codes"]) for p in sent]
            of = np.repeat(np.arange(len(sent), dtype=np.int32), [len(c) for c in codes])
            codes = np.concatenate(codes)
            rows = np.concatenate([unpack(p["rows"]).astype(np.uint32) for p in sent])
            weight = np.concatenate([unpack(p["counts"]).astype(np.int64) for p in sent])
            order = np.argsort(codes, kind="stable")
            c = codes[order]
            new = np.ones(len(c), bool)
            new[1:] = c[1:] != c[:-1]
            total = np.add.reduceat(weight[order], np.flatnonzero(new))[np.cumsum(new) - 1]
            shared = total > 1
            order, total = order[shared], total[shared]
            back = np.argsort(of[order], kind="stable")
            order, total = order[back], total[back]
            edges = np.searchsorted(of[order], np.arange(len(sent) + 1))
            for i in np.flatnonzero(np.diff(edges)):
                x = slice(edges[i], edges[i + 1])
                out.append((sent[i]["segment"], 0, 0, pack(codes[order[x]]), pack(rows[order[x]]), pack(total[x]), None, None, None))
        made = pa.Table.from_batches([b.cast(keep.schema) for b in _batch(out)], schema=keep.schema)
        return pa.concat_tables([keep, made])

    def gather(group):
        """A segment's texts with their shared shingles."""
        import pyarrow as pa

        parts = group.to_pylist()
        mine = next(p for p in parts if p["kind"] == 1)
        ids, size = mine["ids"], np.array(mine["sizes"], np.int64)
        got = [p for p in parts if p["kind"] == 0]
        none = np.zeros(0, U64)
        codes = np.concatenate([unpack(p["codes"]) for p in got] or [none])
        rows = np.concatenate([unpack(p["rows"]) for p in got] or [none]).astype(np.int64)
        total = np.concatenate([unpack(p["counts"]) for p in got] or [none]).astype(np.int64)
        once = rows == len(ids)
        if once.any():  # give the rows of the segment's frequent shingles back
            hot, often, m = unpack_sorted(mine["codes"]), unpack(mine["rows"]).astype(np.int64), unpack(mine["counts"]).astype(np.int64)
            at = np.searchsorted(hot, codes[once])
            k, start = m[at], (np.cumsum(m) - m)[at]
            where = np.repeat(start - (np.cumsum(k) - k), k) + np.arange(k.sum())
            codes = np.concatenate([codes[~once], np.repeat(codes[once], k)])
            rows = np.concatenate([rows[~once], often[where]])
            total = np.concatenate([total[~once], np.repeat(total[once], k)])
        order = np.lexsort((codes, total, rows))
        codes, rows, total = codes[order], rows[order], total[order]
        edges = np.searchsorted(rows, np.arange(len(ids) + 1))
        # what a text of n shingles needs in common with any other: ceil(n * percent / 100)
        enough = (100 * np.diff(edges) >= percent * size) & (size > 0)
        shingles, counts = [None] * len(ids), [None] * len(ids)
        for i in np.flatnonzero(enough):
            x = slice(edges[i], edges[i + 1])
            shingles[i], counts[i] = codes[x].tobytes(), pack(total[x])
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "n": pa.array(size), "set_id": pa.array(mine["sets"], pa.binary()),
                         "shingles": pa.array(shingles, pa.binary()), "counts": pa.array(counts, pa.binary())})

    parts = stored(rows.mapInArrow(send, PARTS).repartition(buckets, "bucket").groupBy("bucket").applyInArrow(count, PARTS), "shingle-counts")
    return stored(parts.groupBy("segment").applyInArrow(gather, TEXTS), "shingle-sets")


def prefix_length(n: int, k: int, percent: int) -> int:
    """Of n shingles in the global order, how many a k-match prefix holds."""
    return n - -(-n * percent // 100) + k


def choose_match(n: int, counts: np.ndarray, percent: int) -> tuple[int, int]:
    """The multi-match k with the least estimated cost, and how many shared shingles its prefix holds.

    Cost: the postings that the prefix meets, plus verifying the candidates
    left, at most a k-th of these postings.
    """
    alone = n - len(counts)
    total = np.concatenate([[0], np.cumsum(counts)])
    best = None
    for k in range(1, min(MAX_MATCH, -(-n * percent // 100)) + 1):  # no more than any partner has in common
        q = min(len(counts), max(0, prefix_length(n, k, percent) - alone))
        met = int(total[q])
        cost = met + VERIFY_COST * met / k
        if best is None or cost < best[0]:
            best = (cost, k, q)
    return best[1:]


def _compared(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, ...) with how many shingles they have in common, whether that reaches the
    threshold, and which shared shingles of a (in the global order) b lacks.

    Pairs without ``all`` are left out if they don't share enough of their prefixes.
    """
    def side(x):
        return classes.select(*(F.col(c).alias(f"{x}_{c}") for c in ("set_id", "n", "k", "q", "shingles")))

    names = pairs.columns
    both = pairs.join(side("a"), F.col("a") == F.col("a_set_id")).join(side("b"), F.col("b") == F.col("b_set_id"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            c = batch.select(["all", *(f"{x}_{y}" for y in ("n", "k", "q", "shingles") for x in "ab")]).to_pydict()
            keep, common, linked, lacks = [], [], [], []
            for whole, na, nb, ka, kb, qa, qb, sa, sb in zip(*c.values()):
                x, y = np.frombuffer(sa, U64), np.frombuffer(sb, U64)
                keep.append(whole or len(np.intersect1d(x[:qa], y[:qb], assume_unique=True)) >= min(ka, kb))
                if keep[-1]:
                    other = ~np.isin(x, y, assume_unique=True)
                    common.append(len(x) - int(other.sum()))
                    linked.append(100 * common[-1] >= percent * (na + nb - common[-1]))
                    lacks.append(x[other].tobytes() if whole else None)
            out = batch.select(names).filter(pa.array(keep, pa.bool_()))
            yield pa.record_batch([*out.columns, pa.array(common, pa.int64()), pa.array(linked, pa.bool_()), pa.array(lacks, pa.binary())],
                                  names=[*names, "common", "linked", "lacks"])

    schema = StructType([*pairs.schema, StructField("common", LongType()), StructField("linked", BooleanType()), StructField("lacks", BinaryType())])
    return both.select(*names, *(f"{x}_{y}" for x in "ab" for y in ("n", "k", "q", "shingles"))).mapInArrow(run, schema)


def _of_several_labels(rows: DataFrame, *keys: str) -> DataFrame:
    """The rows of lists (by ``keys``) that have more than one label; in the others all are joined already."""
    several = rows.groupBy(*keys).agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select(*keys)
    return rows.join(stored(several, "several-labels"), list(keys), "left_semi")


def _pairs(rows: DataFrame, keys: tuple[str, ...], percent: int, also) -> DataFrame:
    """Pairs (a, b) of a list whose labels differ and whose shared shingles could reach the threshold.

    Common shingles are at most the shared ones of either, and a link needs
    100 * common >= percent * (sum of sizes - common).
    """
    x, y = rows.alias("x"), rows.alias("y")
    on = (F.col("x.label") != F.col("y.label")) & (F.col("x.set_id") < F.col("y.set_id")) & also
    for k in keys:
        on = on & (F.col(f"x.{k}") == F.col(f"y.{k}"))
    on = on & (F.least("x.shared", "y.shared") * (100 + percent) >= (F.col("x.n") + F.col("y.n")) * percent)
    return x.join(y, on).select(F.col("x.set_id").alias("a"), F.col("y.set_id").alias("b"))


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``.

    Words: ASCII letters lower-cased, runs without white space.  A text's set
    holds its distinct runs of ``n`` words; fewer words are one run.  Two
    texts are linked when their Jaccard similarity is ``percent`` / 100 or
    more; component_id is the smallest id of a row that links reach, itself
    included.  Null or empty texts have no shingles and are linked with none,
    also with each other.  Rows with equal sets are one class, whatever their
    ids.  A component whose ids are all null has a null component_id.
    """
    texts = texts_with_counts(docs, n, percent, id_col, text_col)
    classes = texts.where("shingles IS NOT NULL").groupBy("set_id").agg(
        F.min("doc_id").alias("first_id"), F.first("n").alias("n"), F.first("shingles").alias("shingles"), F.first("counts").alias("counts"))

    def prefixes(batches):
        import pyarrow as pa

        for b in batches:
            k, q, centre, shared = [], [], [], []
            size = b.column("n").to_pylist()
            for m, c in zip(size, b.column("counts").to_pylist()):
                c = unpack(c).astype(np.int64)
                x, y = choose_match(m, c, percent)
                k.append(x)
                q.append(y)
                shared.append(len(c))
                centre.append((int(c.sum()) + m - len(c)) / m)
            yield pa.record_batch([b.column("set_id"), b.column("first_id"), b.column("n"), pa.array(shared), pa.array(k), pa.array(q),
                                   pa.array(centre), b.column("shingles")],
                                  names=["set_id", "first_id", "n", "shared", "k", "q", "centre", "shingles"])

    classes = stored(classes.mapInArrow(prefixes, "set_id binary, first_id long, n long, shared long, k long, q long, centre double, shingles binary"), "classes")

    def post(batches):
        import pyarrow as pa

        for b in batches:
            q = np.array(b.column("q").to_pylist(), np.int64)
            for at in range(0, len(q), 256):
                part = b.slice(at, 256)
                codes = [np.frombuffer(s, np.int64)[:m] for s, m in zip(part.column("shingles").to_pylist(), q[at: at + 256])]
                rows = pa.array(np.repeat(np.arange(len(codes)), [len(c) for c in codes]))
                yield pa.record_batch([pa.array(np.concatenate(codes)), *(part.column(c).take(rows) for c in ("set_id", "n", "shared", "centre"))],
                                      names=["shingle", "set_id", "n", "shared", "centre"])

    postings = classes.mapInArrow(post, "shingle long, set_id binary, n long, shared long, centre double")
    # the most central text of each list of two or more
    rank = F.struct("centre", "set_id")
    heads = stored(postings.groupBy("shingle").agg(F.max(rank).alias("head"), F.count("*").alias("size")).where("size > 1")
                   .select("shingle", F.col("head.set_id").alias("hub"), F.col("head.centre").alias("hub_centre")), "hubs")
    lists = stored(postings.join(heads, "shingle"), "postings")
    first = lists.where("set_id <> hub").select(F.col("set_id").alias("a"), F.col("hub").alias("b"), "hub_centre").distinct()
    # a text's home is the most central hub that it is compared with
    home = first.groupBy("a").agg(F.max(F.struct("hub_centre", "b")).alias("m")).select(F.col("a").alias("i"), F.col("m.b").alias("home"))
    first = first.join(home, F.col("a") == F.col("i")).select("a", "b", "hub_centre", (F.col("b") == F.col("home")).alias("all"))
    checked = stored(_compared(first, classes, percent), "hub-pairs")
    links = checked.where("linked")

    # a text's label is the most central hub it is linked with, followed once
    label = stored(links.groupBy("a").agg(F.max(F.struct("hub_centre", "b")).alias("m")).select("a", F.col("m.b").alias("label")), "labels")
    up = label.select(F.col("a").alias("label"), F.col("label").alias("up"))
    label = label.join(up, "label", "left").select(F.col("a").alias("i"), F.coalesce("up", "label").alias("label"))
    homes = checked.where("all").select(F.col("a").alias("set_id"), F.col("b").alias("home"), F.col("common").alias("at_home"), "lacks")
    facts = stored(classes.select("set_id", "n", "shared").join(homes, "set_id", "left").join(label, F.col("set_id") == F.col("i"), "left").select(
        "set_id", "n", "shared", F.coalesce("home", "set_id").alias("home"), F.coalesce("at_home", "n").alias("at_home"),
        F.coalesce("label", "set_id").alias("label"), "lacks"), "facts")

    # Two texts of one home have in common at most what the lesser has with it, and
    # what both have beyond it.  So either the first alone can reach the threshold ...
    lists = stored(_of_several_labels(lists.select("shingle", "set_id").join(facts.drop("lacks"), "set_id"), "shingle"), "mixed-postings")
    near = F.least("x.at_home", "y.at_home") * (100 + percent) >= (F.col("x.n") + F.col("y.n")) * percent
    rest = _pairs(lists, ("shingle",), percent, (F.col("x.home") != F.col("y.home")) | near)

    # ... or they share a shingle that their home lacks
    def beyond(batches):
        import pyarrow as pa

        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                codes = []
                for n, c, lacks in zip(*(part.column(x).to_pylist() for x in ("n", "at_home", "lacks"))):
                    z = np.frombuffer(lacks, np.int64)
                    least = max(1, -(-n * percent // 100) - c)  # so many must be shared, so the last ones needn't be listed
                    codes.append(z[: max(0, len(z) - least + 1)])
                rows = pa.array(np.repeat(np.arange(len(codes)), [len(c) for c in codes]))
                yield pa.record_batch([pa.array(np.concatenate(codes)), *(part.column(x).take(rows) for x in kept)], names=["shingle", *kept])

    kept = ["set_id", "n", "shared", "home", "label"]
    extra = facts.where("lacks IS NOT NULL").select(*kept, "at_home", "lacks").mapInArrow(
        beyond, "shingle long, set_id binary, n long, shared long, home binary, label binary")
    extra = stored(_of_several_labels(stored(extra, "beyond-home"), "home", "shingle"), "mixed-beyond-home")
    rest = rest.union(_pairs(extra, ("home", "shingle"), percent, F.lit(True))).distinct().withColumn("all", F.lit(False))
    more = _compared(rest, classes, percent).where("linked").select("a", "b")

    found = components(stored(links.select("a", "b").union(more), "all-links"))
    ids = (classes.select("set_id", "first_id").join(found, F.col("set_id") == F.col("node"), "left")
           .select("set_id", "first_id", F.coalesce("component", "set_id").alias("component")))
    least = ids.groupBy("component").agg(F.min("first_id").alias("component_id"))
    of_class = stored(ids.select("set_id", "component").join(stored(least, "least"), "component").select("set_id", "component_id"), "class-components")
    return (texts.select("doc_id", "n", F.when(F.col("shingles").isNotNull(), F.col("set_id")).alias("set_id"))
            .join(of_class, "set_id", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")))
