"""Substring deduplication over suffixes dealt out by prefix (dealt operator 10).

Every place of a text where ``min_words`` words follow is a suffix.  Suffixes
are split into groups by a prefix of variable length: one word, or as many
more of ``LEVELS`` as it takes until the prefix is no longer frequent, so a
word or phrase that a third of all texts share is spread over many groups.

No suffix trees are built (README: what they would move).  Nothing is asked
below depth ``min_words``, and a node of that depth is the set of suffixes
with the same ``min_words`` words: a group finds these by the suffixes' 64-bit
codes.  Repeats that overlap or touch join into spans.

Before suffixes leave a task, those whose words also start earlier in the
same task are decided there, so a passage comes at most once from each run
of documents, however many hold it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import work_path
from .store import group_count, shuffles_dropped
from .words import (SPACES, U64, Powers, grams, lean, mix, multipliers, pack, pack_sorted, slices, span_hashes, spans,
                    unpack, unpack_sorted)

LEVELS = (1, 2, 3, 5, 10)  # words of a prefix, and the whole suffix after these
SEED = 20
SEGMENT_WORDS = 750_000  # words that a task gathers before it sends suffixes on
NO_ID = -(1 << 63)  # stands for a null id, before all others
PARTS = "segment long, kind int, bucket int, codes binary, rows binary, starts binary, own binary, ids binary, keys array<long>"


class Segment:
    """A run of documents of one task: their word hashes and ids."""

    def __init__(self) -> None:
        self.words, self.n, self.ids, self.keys, self.size = [], [], [], [], 0

    def add(self, words, first, ids, keys) -> None:
        self.words.append(words)
        self.n.append(np.diff(first))
        self.ids.append(ids)
        self.keys.append(keys)
        self.size += len(words)

    def done(self):
        """Words and first word of each document, ids and keys, in the order of ids."""
        words, n, ids, keys = map(np.concatenate, (self.words, self.n, self.ids, self.keys))
        first = np.cumsum(n) - n
        order = np.argsort(ids, kind="stable")
        if (np.diff(order) < 0).any():
            size = n[order]
            at = np.repeat(first[order] - (np.cumsum(size) - size), size) + np.arange(len(words))
            words, n, ids, keys = words[at], size, ids[order], keys[order]
        return words, np.concatenate([[0], np.cumsum(n)]), ids, keys


def segments(batches, limit: int = SEGMENT_WORDS):
    """The documents (doc_id, key, text) of a task as segments of about ``limit`` words."""
    powers, out = Powers(), Segment()
    for b in batches:
        ids = b.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
        keys = b.column("key").to_numpy(zero_copy_only=False)
        for row, buf, off in slices(b.column("text")):
            s, e, first = spans(buf, off, SPACES)
            out.add(span_hashes(buf, s, e, powers), first, ids[row: row + len(off) - 1], keys[row: row + len(off) - 1])
            if out.size >= limit:
                yield out.done()
                out = Segment()
    if out.ids:
        yield out.done()


def _numbered(ends: tuple[int, ...], words: np.ndarray, rest: np.ndarray, heavy):
    """(level, positions, prefix codes) level by level; ``heavy`` picks what goes on to the next."""
    k = multipliers(max(ends), SEED)
    h, done = np.zeros(len(rest), U64), 0
    for level, end in enumerate(ends):
        for j in range(done, end):
            h = h + words[rest + j] * k[j]
        done = end
        codes = mix(h) + U64(level)
        yield level, rest, codes
        on = heavy(level, codes)
        rest, h = rest[on], h[on]
        if not len(rest):
            return


def frequent_prefixes(docs: DataFrame, min_words: int, groups: int) -> dict[int, np.ndarray]:
    """By level, the ascending codes of prefixes that more than 1 / groups of all suffixes have.

    At most ``groups`` a level, so the table's size is set by the number of
    tasks.  A task passes on what makes up 1 / (2 groups) of its own suffixes;
    what is frequent over all is so in some task.
    """
    levels = tuple(n for n in LEVELS if n < min_words)

    def count(batches):
        import pyarrow as pa

        lean()
        for words, first, _, _ in segments(batches):
            _, ok = grams(words, first, min_words, SEED)
            rest = np.flatnonzero(ok)
            least = max(2, len(rest) // (2 * groups))
            rows = [(-1, np.zeros(1, U64), np.array([len(rest)]))]

            def heavy(level, codes):
                seen, back, n = np.unique(codes, return_inverse=True, return_counts=True)
                often = n >= least
                rows.append((level, seen[often], n[often]))
                return often[back]

            if len(rest):
                for _ in _numbered(levels, words, rest, heavy):
                    pass
            yield pa.record_batch({
                "level": pa.array(np.concatenate([np.full(len(c), k, np.int32) for k, c, _ in rows])),
                "code": pa.array(np.concatenate([c for _, c, _ in rows]).view(np.int64)),
                "n": pa.array(np.concatenate([n for _, _, n in rows]).astype(np.int64))})

    path = work_path(docs.sparkSession, "prefixes")
    (docs.mapInArrow(count, "level int, code long, n long").groupBy("level", "code").agg(F.sum("n").alias("n"))
     .write.parquet(path))
    counts = docs.sparkSession.read.parquet(path)
    total = counts.where("level = -1").agg(F.sum("n")).first()[0] or 0
    out: dict[int, list[int]] = {k: [] for k in range(len(levels))}
    for r in counts.where((F.col("level") >= 0) & (F.col("n") > total / groups)).collect():
        out[r["level"]].append(r["code"])
    return {k: np.sort(np.array(v, np.int64).view(U64)) for k, v in out.items()}


def _among(codes: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(codes), bool)
    at = np.searchsorted(table, codes)
    at[at == len(table)] = 0
    return table[at] == codes


def repeats(docs: DataFrame, min_words: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key, starts, ends: the maximal word spans that repeat earlier text, by document.

    ``key`` is xxhash64 of the text (null: empty).  A window of ``min_words``
    words repeats if its words also start in a smaller doc_id, or earlier in
    the same row; rows of equal id don't count against each other.  Null ids
    stand before all others.  Only documents with repeats are returned, rows
    equal in id and text once.
    """
    spark = docs.sparkSession
    rows = _rows(docs, id_col, text_col)
    buckets = group_count(rows)
    table = frequent_prefixes(rows, min_words, 8 * buckets)
    levels = tuple(n for n in LEVELS if n < min_words)

    def send(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        lean()
        for number, (words, first, ids, keys) in enumerate(segments(batches)):
            segment = (TaskContext.get().partitionId() << 32) + number
            codes, ok = grams(words, first, min_words, SEED)
            at = np.flatnonzero(ok)
            doc = np.searchsorted(first, at, "right") - 1
            start = at - first[doc]
            order = np.argsort(codes[at], kind="stable")  # within a code by id, then row and place
            code, d = codes[at][order], doc[order]
            new = np.ones(len(code), bool)
            new[1:] = code[1:] != code[:-1]
            head = d[np.flatnonzero(new)][np.cumsum(new) - 1] if len(code) else d
            again = np.zeros(len(code), bool)  # an earlier start in the same row
            again[1:] = ~new[1:] & (d[1:] == d[:-1])
            again |= ids[d] > ids[head]
            own, rest = order[again], order[~again]
            # documents of the segment, with the repeats found here
            parts = [(segment, 1, int(segment % buckets), b"", pack(doc[own]), pack(start[own]), b"",
                      pack_sorted(ids.view(U64) + U64(1 << 63)), keys.tolist())]
            group = np.zeros(len(words), U64)
            last = mix(codes)
            rest_at = np.sort(at[rest])
            group[rest_at] = last[rest_at]
            for level, pos, prefix in (_numbered(levels, words, rest_at, lambda k, c: _among(c, table[k])) if len(rest_at) else ()):
                light = ~_among(prefix, table[level])
                group[pos[light]] = mix(prefix[light])
            bucket = (group[at[rest]] % U64(buckets)).astype(np.int32)
            by = np.argsort(bucket, kind="stable")  # codes stay in order within a bucket
            edges = np.searchsorted(bucket[by], np.arange(buckets + 1))
            c, r, s = codes[at[rest]][by], doc[rest][by], start[rest][by]
            for k in np.flatnonzero(np.diff(edges)):
                x = slice(edges[k], edges[k + 1])
                mine = np.unique(r[x])
                parts.append((segment, 0, int(k), pack_sorted(c[x]), pack(r[x]), pack(s[x]), pack_sorted(mine),
                              pack_sorted(ids[mine].view(U64) + U64(1 << 63)), None))
            yield from _batches(parts)

    def _batches(parts):
        import pyarrow as pa

        types = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
        for i in range(0, len(parts), 64):
            yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*parts[i: i + 64]), types)], names=fields)

    def decide(group):
        """Of a bucket's subtrees: the leaves below nodes of full depth that aren't the earliest."""
        import pyarrow as pa

        kind = group.column("kind").to_numpy()
        keep = group.filter(pa.array(kind == 1))
        sent = group.filter(pa.array(kind == 0)).to_pylist()
        out = []
        if sent:
            codes, rows_, starts, ids, of = [], [], [], [], []
            for i, p in enumerate(sent):
                r = unpack(p["rows"])
                mine = unpack_sorted(p["own"])
                codes.append(unpack_sorted(p["codes"]))
                rows_.append(r.astype(np.uint32))
                starts.append(unpack(p["starts"]).astype(np.uint32))
                ids.append(unpack_sorted(p["ids"])[np.searchsorted(mine, r)])
                of.append(np.full(len(r), i, np.int32))
            codes, rows_, starts, ids, of = map(np.concatenate, (codes, rows_, starts, ids, of))
            order = np.argsort(codes)
            c = codes[order]
            new = np.ones(len(c), bool)
            new[1:] = c[1:] != c[:-1]
            least = np.minimum.reduceat(ids[order], np.flatnonzero(new))[np.cumsum(new) - 1]
            gone = order[ids[order] > least]
            gone = gone[np.argsort(of[gone], kind="stable")]
            edges = np.searchsorted(of[gone], np.arange(len(sent) + 1))
            for i in np.flatnonzero(np.diff(edges)):
                x = gone[edges[i]: edges[i + 1]]
                out.append((sent[i]["segment"], 0, 0, b"", pack(rows_[x]), pack(starts[x]), b"", b"", None))
        made = pa.Table.from_batches([b.cast(keep.schema) for b in _batches(out)], schema=keep.schema)
        return pa.concat_tables([keep, made])

    def join(group):
        """A segment's documents with all their repeating windows as maximal spans."""
        import pyarrow as pa

        parts = group.to_pylist()
        mine = next(p for p in parts if p["kind"] == 1)
        ids, keys = unpack_sorted(mine["ids"]) - U64(1 << 63), np.array(mine["keys"], np.int64)
        r = np.concatenate([unpack(p["rows"]) for p in parts]).astype(np.int64)
        s = np.concatenate([unpack(p["starts"]) for p in parts]).astype(np.int64)
        order = np.lexsort((s, r))
        r, s = r[order], s[order]
        new = np.ones(len(r), bool)
        new[1:] = (r[1:] != r[:-1]) | (s[1:] > s[:-1] + min_words)
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(r)) - 1
        of, begin, end = r[head], s[head], (s[tail] + min_words if len(r) else s)
        docs_, at = np.unique(of, return_index=True)
        off = pa.array(np.append(at, len(of)).astype(np.int32))
        return pa.table({"doc_id": pa.array(ids.view(np.int64)[docs_]), "key": pa.array(keys[docs_]),
                         "starts": pa.ListArray.from_arrays(off, pa.array(begin)),
                         "ends": pa.ListArray.from_arrays(off, pa.array(end))})

    fields = [x.split()[0] for x in PARTS.split(", ")]
    path = work_path(spark, "suffixes")
    with shuffles_dropped(spark):
        (rows.mapInArrow(send, PARTS).repartition(buckets, "bucket").groupBy("bucket").applyInArrow(decide, PARTS)
         .write.parquet(path))
    found = (spark.read.schema(PARTS).parquet(path).groupBy("segment")
             .applyInArrow(join, "doc_id long, key long, starts array<long>, ends array<long>"))
    return found.groupBy("doc_id", "key").agg(F.first("starts").alias("starts"), F.first("ends").alias("ends"))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("text"))


def drop_repeats(docs: DataFrame, min_words: int = 20, id_col: str = "doc_id", text_col: str = "text",
                 carry: tuple[str, ...] = (), cut: DataFrame | None = None) -> DataFrame:
    """doc_id, text, n_words, n_removed, kept_text, *carry for every row of ``docs``.

    ``cut``: the spans, if ``repeats`` has found them already.

    ``kept_text``: the words that no repeating window covers, joined by one
    space.  Words are runs without space, tab, line feed, vertical tab, form
    feed and carriage return, compared as they are.  A null text has none.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      *(F.col(c) for c in carry), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("_id"), F.xxhash64(text).alias("_key"))
    cut = repeats(docs, min_words, id_col, text_col) if cut is None else cut
    both = out.join(cut, (F.col("_id") == cut["doc_id"]) & (F.col("_key") == cut["key"]), "left").select(
        *(out[c] for c in out.columns if c not in ("_id", "_key")), "starts", "ends")
    names = both.columns[:-2]

    def keep(batches):
        import pyarrow as pa

        for b in batches:
            texts = b.column("text")
            starts, ends = b.column("starts"), b.column("ends")
            for row, buf, off in slices(texts):
                n = len(off) - 1
                s, e, first = spans(buf, off, SPACES)
                gone = np.zeros(len(s) + 1, np.int64)
                x, y = starts.slice(row, n), ends.slice(row, n)
                k = x.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                base = np.repeat(first[:-1], k)
                np.add.at(gone, x.flatten().to_numpy() + base, 1)
                np.add.at(gone, y.flatten().to_numpy() + base, -1)
                kept = np.cumsum(gone)[:-1] == 0
                upto = np.concatenate([[0], np.cumsum(kept)])[first]
                size = (e - s)[kept] + 1  # a space after each word
                has = np.diff(upto) > 0
                size[upto[1:][has] - 1] -= 1  # but none after the last
                ends_ = np.concatenate([[0], np.cumsum(size)])
                at = np.repeat(s[kept] - ends_[:-1], size) + np.arange(ends_[-1])
                data = np.append(buf, np.uint8(32))[at]
                data[SPACES[data]] = 32
                new = pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(ends_[upto].astype(np.int64)), pa.py_buffer(data)])
                words = np.diff(first)
                yield pa.record_batch([*(b.column(c).slice(row, n) for c in names), pa.array(words), pa.array(words - np.diff(upto)), new.cast(pa.string())],
                                      names=[*names, "n_words", "n_removed", "kept_text"])

    schema = both.select(*names).schema.add("n_words", "long").add("n_removed", "long").add("kept_text", "string")
    return both.mapInArrow(keep, schema)
