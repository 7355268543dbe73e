"""Phrase collocation mining (dealt operator 12).

Texts are stored once as runs of word hashes.  Level by level, the phrases of
m words that can be frequent are filed in double-array tries, which are
broadcast; a task moves the states of all its text positions through the trie
together and counts the accepting ones, and the counts of all tasks are
summed.  Neighbouring accepting positions name the candidates of the next
level (Apriori: both the first m and the last m words are candidates), and
those that reach the least count are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .double_array import DoubleArray
from .store import stored
from .words import LOWER, Powers, byte_table, slices, span_hashes, spans

BREAKS = byte_table(".,;:!?\n\x0b\x0c\r")  # a phrase doesn't cross these
SEPARATORS = BREAKS | byte_table(" \t")
BLOCK = 1 << 19  # candidates in a trie; each trie is one broadcast, and one scan of the texts
CHUNK = 1 << 20  # bytes of text taken together
_PAIRS = 1 << 19  # proposals, or words, that a task gathers before it hands them on


def _strings(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    size = ends - starts
    to = np.concatenate([[0], np.cumsum(size)])
    data = buf[np.repeat(starts - to[:-1], size) + np.arange(to[-1])]
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(to.astype(np.int64)), pa.py_buffer(data.tobytes()))


def spell(hashes: np.ndarray, codes: np.ndarray) -> bytes:
    """A run of words: its distinct hashes, and each word's place among them from 1 (0 is a break), in two bytes where they do."""
    width = "<u2" if len(hashes) < 1 << 16 else "<u4"
    return np.uint32(len(hashes)).tobytes() + hashes.astype("<u8").tobytes() + codes.astype(width).tobytes()


def read_run(blob) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes (0, the break, first) and codes of a run."""
    n = int(np.frombuffer(blob, "<u4", 1)[0])
    hashes = np.zeros(n + 1, np.uint64)
    hashes[1:] = np.frombuffer(blob, "<u8", n, 4)
    return hashes, np.frombuffer(blob, "<u2" if n < 1 << 16 else "<u4", offset=4 + 8 * n)


def _merged(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Hashes, counts and spellings of several lists of words, one row a hash."""
    hashes = np.concatenate([p[0] for p in parts])
    one, at, back = np.unique(hashes, return_index=True, return_inverse=True)
    n = np.bincount(back, np.concatenate([p[1] for p in parts]), len(one)).astype(np.int64)
    return one, n, pa.concat_arrays([p[2] for p in parts]).take(pa.array(at))


def encode_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, words), a row a chunk and language, and rows (lang, hash, word, n) of the task's words.

    ``words`` (see ``spell``) holds 64-bit hashes, and a break at each piece's start.
    """
    powers = Powers()
    names = ["lang", "words", "hash", "word", "n"]
    known: dict[str, list] = {}

    def vocabulary(lang):
        one, n, word = _merged(known.pop(lang))
        return pa.record_batch([pa.array([lang] * len(one)), pa.nulls(len(one), pa.binary()), pa.array(one.view(np.int64)),
                                word.cast(pa.string()), pa.array(n)], names)

    for b in batches:
        langs = b.column(0).dictionary_encode()
        code = langs.indices.to_numpy(zero_copy_only=False)
        for row, buf, off in slices(b.column(1), CHUNK):
            low = LOWER[buf]
            starts, ends, first = spans(low, off, SEPARATORS)
            if not len(starts):
                continue
            h = span_hashes(low, starts, ends, powers)
            h[h == 0] = 1
            cut = np.concatenate([[0], np.cumsum(BREAKS[low])])
            new = np.ones(len(h), bool)
            new[1:] = cut[starts[1:]] > cut[ends[:-1]]
            new[first[:-1][first[:-1] < len(h)]] = True
            of = np.repeat(code[row: row + len(off) - 1], np.diff(first))
            for c in np.unique(of):
                own = np.flatnonzero(of == c)
                place = np.arange(len(own)) + np.cumsum(new[own])
                one, at, back, n = np.unique(h[own], return_index=True, return_inverse=True, return_counts=True)
                codes = np.zeros(place[-1] + 1, np.uint32)
                codes[place] = back + 1
                lang = langs.dictionary[int(c)].as_py()
                yield pa.record_batch([pa.array([lang]), pa.array([spell(one, codes)], pa.binary()), pa.nulls(1, pa.int64()),
                                       pa.nulls(1, pa.string()), pa.nulls(1, pa.int64())], names)
                parts = known.setdefault(lang, [])
                parts.append((one, n, _strings(low, starts[own[at]], ends[own[at]])))
                if sum(len(x) for x, _, _ in parts) > _PAIRS:
                    known[lang] = [_merged(parts)]
                    if len(known[lang][0][0]) > _PAIRS // 2:
                        yield vocabulary(lang)
    for lang in list(known):
        yield vocabulary(lang)


class PhraseTrie:
    """Candidates of one level, language first, as a double array over the words that occur in them.

    A word's number is spelled in two digits, so that a node has at most the
    root of the vocabulary's size of children: wide nodes would leave the
    array mostly empty.
    """

    def __init__(self, langs: np.ndarray, keys: np.ndarray) -> None:
        """langs: strings, keys: a matrix of word hashes, in the order of the candidates' numbers."""
        self.langs, lang = np.unique(langs.astype(str), return_inverse=True)
        self.keys, self.lang = keys, lang
        self.words = np.unique(keys)
        self.base = int(np.ceil(np.sqrt(len(self.words))))
        digits = np.stack(np.divmod(np.searchsorted(self.words, keys), self.base), axis=2).reshape(len(keys), -1)
        self.trie = DoubleArray(np.concatenate([lang[:, None], digits], axis=1), max(len(self.langs), self.base))

    def arrays(self) -> dict:
        return vars(self) | {"trie": vars(self.trie)}

    @classmethod
    def of(cls, arrays: dict) -> PhraseTrie:
        out = cls.__new__(cls)
        out.__dict__.update(arrays, trie=DoubleArray.of(arrays["trie"]))
        return out

    def accepted(self, lang: str, hashes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """At each position of a run, the number of the candidate that starts there, or -1."""
        n, depth, trie = len(codes), self.keys.shape[1], self.trie
        out = np.full(n, -1, np.int64)
        at = int(np.searchsorted(self.langs, lang))
        if at == len(self.langs) or self.langs[at] != lang or n < depth:
            return out
        symbol = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        symbol[self.words[symbol] != hashes] = -1
        high, low = (d[codes] for d in np.divmod(symbol.astype(np.int32), np.int32(self.base)))  # no word: the high digit is negative
        alive = np.flatnonzero(high[: n - depth + 1] >= 0)
        states = np.broadcast_to(trie.step(np.array([trie.root]), np.array([at])), alive.shape)
        for j in range(depth):
            for digit in (high, low):
                states = trie.step(states, digit[alive + j])
                live = states > 0
                alive, states = alive[live], states[live]
        out[alive] = trie.accept[states]
        return out


def _summed(values: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    one, at = np.unique(values, return_inverse=True)
    return one, np.bincount(at, n, len(one)).astype(np.int64)


def scan(words: DataFrame, held: Broadcast, whole: bool, more: bool) -> DataFrame:
    """Partial counts (code, word, n) of a trie's candidates, and with ``more`` of proposals, which are a word longer.

    A candidate's code is -1 less its number.  A proposal is a candidate and
    the word after it: with ``whole`` (the trie holds all candidates of its
    level) only if its last words are a candidate as well, and the code names
    both; else the code is the candidate's number and ``word`` the hash.
    """
    def run(batches):
        t = PhraseTrie.of(held.value)
        size, depth = t.keys.shape
        count = np.zeros(size, np.int64)
        waiting: list = []

        def rows(code, word, n):
            return pa.record_batch([pa.array(code), pa.array(word) if word is not None else pa.array(np.zeros(len(code), np.int64)), pa.array(n)],
                                   ["code", "word", "n"])

        def proposals():
            code, n = _summed(*map(np.concatenate, zip(*waiting)))
            waiting.clear()
            return rows(code, None, n)

        for b in batches:
            for lang, blob in zip(b.column(0).to_pylist(), b.column(1)):
                hashes, codes = read_run(blob.as_buffer())
                ids = t.accepted(lang, hashes, codes)
                count += np.bincount(ids[ids >= 0], minlength=size)
                if more and whole:
                    at = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
                    waiting.append(_summed(ids[at] * size + ids[at + 1], np.ones(len(at), np.int64)))
                    if sum(len(x) for x, _ in waiting) > _PAIRS:
                        yield proposals()
                elif more:
                    at = np.flatnonzero(ids[: max(0, len(codes) - depth)] >= 0)
                    at = at[codes[at + depth] > 0]
                    p, n = _summed(ids[at] * len(hashes) + codes[at + depth], np.ones(len(at), np.int64))
                    if len(p):
                        yield rows(p // len(hashes), hashes[p % len(hashes)].view(np.int64), n)
        if waiting:
            yield proposals()
        at = np.flatnonzero(count)
        yield rows(-1 - at, None, count[at])

    return words.mapInArrow(run, "code long, word long, n long")


def spelled_out(sums: DataFrame, held: Broadcast, whole: bool) -> DataFrame:
    """lang, key, f of summed codes."""
    def run(batches):
        t = PhraseTrie.of(held.value)
        size, depth = t.keys.shape
        for b in batches:
            code, word = (b.column(i).to_numpy() for i in (0, 1))
            for own in (code < 0, code >= 0):
                c, w = code[own], word[own]
                number = -1 - c if len(c) and c[0] < 0 else c // size if whole else c
                key = t.keys[number]
                if len(c) and c[0] >= 0:
                    last = t.keys[c % size, -1] if whole else w.view(np.uint64)
                    key = np.concatenate([key, last[:, None]], axis=1)
                key = np.ascontiguousarray(key, "<u8")
                fixed = pa.Array.from_buffers(pa.binary(key.shape[1] * 8), len(key), [None, pa.py_buffer(key.tobytes())])
                yield pa.record_batch([pa.array(t.langs[t.lang[number]].tolist(), pa.string()), fixed.cast(pa.binary()),
                                       b.column(2).filter(pa.array(own))], ["lang", "key", "f"])

    return sums.mapInArrow(run, "lang string, key binary, f long")


def count_level(words: DataFrame, candidates: DataFrame, depth: int, min_count: int, more: bool,
                block_size: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """lang, key, f of stored candidates (lang, key), and the candidates of the next level if there is ``more``.

    Candidates are dealt by hash to tries of about block_size.  A trie is
    built on the driver, broadcast, and given up after its scan.
    """
    spark = words.sparkSession
    blocks = -(-candidates.count() // block_size)
    dealt = candidates.select("lang", "key", F.pmod(F.xxhash64("lang", "key"), F.lit(max(1, blocks))).alias("block"))
    found = None
    for b in range(blocks):
        own = dealt.where(F.col("block") == b).toArrow()
        keys = np.frombuffer(b"".join(own.column("key").to_pylist()), "<u8").reshape(-1, depth).copy()
        if not len(keys):
            continue
        held = spark.sparkContext.broadcast(PhraseTrie(np.array(own.column("lang").to_pylist()), keys).arrays())
        sums = scan(words, held, blocks == 1, more).groupBy("code", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= min_count)
        sums = stored(spelled_out(sums, held, blocks == 1), f"phrases-{depth}-{b}")
        held.destroy()
        found = sums if found is None else found.union(sums)
    if found is None:
        found = candidates.select("lang", "key", F.lit(0).cast("long").alias("f")).where(F.lit(False))
    return found.where(F.length("key") == 8 * depth), found.where(F.length("key") > 8 * depth).select("lang", "key")


def _part(key: Column, start: Column, size: Column) -> Column:
    """``size`` words of a key from word ``start`` (0-based)."""
    return F.substring(key, start * 8 + 1, size * 8)


def phrase_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = 30, longest: int = 4,
                  block_size: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(lang, m, key, f) of all phrases of up to ``longest`` words found min_count times, and (lang, key, word, n) of all words.

    ``key``: the words' 64-bit hashes, 8 bytes each.
    """
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    encoded = stored(rows.mapInArrow(encode_texts, "lang string, words binary, hash long, word string, n long"), "phrase-words")
    texts = encoded.where("words is not null").select("lang", "words")
    vocabulary = encoded.where("hash is not null").groupBy("lang", "hash").agg(F.min("word").alias("word"), F.sum("n").alias("n"))
    vocabulary = stored(vocabulary.withColumn("key", _little_endian(F.col("hash"))), "phrase-vocabulary")
    candidates, levels = vocabulary.where(F.col("n") >= min_count).select("lang", "key"), None
    for m in range(1, longest + 1):
        counts, candidates = count_level(texts, candidates, m, min_count, m < longest, block_size)
        counts = counts.select("lang", F.lit(m).alias("m"), "key", "f")
        levels = counts if levels is None else levels.union(counts)
    return levels, vocabulary


def _little_endian(value: Column) -> Column:
    """A long as 8 bytes, lowest first."""
    h = F.lpad(F.hex(value), 16, "0")
    return F.unhex(F.concat(*(F.substring(h, i, 2) for i in range(15, 0, -2))))


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = 30, longest: int = 4,
                 top: int = 2000, covered: int = 80, scale: int = 1_000_000, block_size: int = BLOCK) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of two to ``longest`` words.

    Words are runs of other characters than space and tab, ASCII lower-cased,
    within pieces cut at ``. , ; : ! ?`` and line ends.  ``a`` is the phrase's
    count, ``l`` and ``r`` those of the parts of its worst cut, ``n`` the
    language's words, and the score floor(2 * scale * a / (l + r)), in
    decimals.  Phrases that stand in a longer one found ``covered`` percent as
    often are dropped.  Ties go by count, then by phrase.

    A null language counts as ``und`` (with the language of that name), a null
    text as empty; a text of any length is one run.  Repeated rows count each.
    An empty table, or one without frequent phrases, gives no rows.  Only the
    columns named are read, so others may have any name.

    At a fixed min_count the candidates grow with the data.  Beyond block_size
    they are dealt to several tries, each with a scan of its own; what doesn't
    change is the result.
    """
    levels, vocabulary = phrase_counts(docs, lang_col, text_col, min_count, longest, block_size)
    counts = stored(levels, "phrase-levels")
    part = counts.select(F.col("lang").alias("pl"), F.col("key").alias("pk"), F.col("f").alias("pf"))
    phrases = counts.where("m > 1")

    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("m") - 1)))
    cuts = cuts.withColumns({"lk": _part(F.col("key"), F.lit(0), F.col("k")), "rk": _part(F.col("key"), F.col("k"), F.col("m") - F.col("k"))})
    for side in ("l", "r"):
        cuts = stored(cuts, f"phrase-cuts-{side}").join(part, (F.col("lang") == F.col("pl")) & (F.col(side + "k") == F.col("pk")))
        cuts = cuts.withColumn(side, F.col("pf")).drop("pl", "pk", "pf", side + "k")
    wide = lambda c: F.col(c).cast("decimal(24,0)")
    score = F.expr("a2 div lr")
    cuts = cuts.withColumns({"a2": wide("f") * 2 * scale, "lr": wide("l") + wide("r")}).withColumn("score", score)
    best = cuts.groupBy("lang", "m", "key", "f").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inner = phrases.where("m > 2").select("lang", "key", "m", "f", F.explode(F.sequence(F.lit(2), F.col("m") - 1)).alias("size"))
    inner = inner.withColumn("start", F.explode(F.sequence(F.lit(0), F.col("m") - F.col("size"))))
    inner = (inner.select(F.col("lang").alias("il"), _part(F.col("key"), F.col("start"), F.col("size")).alias("ik"), "f")
             .groupBy("il", "ik").agg(F.max("f").alias("outer")))
    same = (F.col("lang") == F.col("il")) & (F.col("key") == F.col("ik")) & (wide("outer") * 100 >= wide("f") * covered)
    kept = stored(best.join(inner, same, "left_anti"), "phrases-kept")

    spelled = kept.select("lang", "key", F.posexplode(F.transform(F.sequence(F.lit(0), F.col("m") - 1), lambda i: _part(F.col("key"), i, F.lit(1)))).alias("at", "wk"))
    names = vocabulary.where(F.col("n") >= min_count).select(F.col("lang").alias("vl"), F.col("key").alias("vk"), "word")
    spelled = (spelled.join(names, (F.col("lang") == F.col("vl")) & (F.col("wk") == F.col("vk")))
               .groupBy("lang", "key").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("words"))
               .select("lang", "key", F.array_join("words.word", " ").alias("phrase")))
    totals = vocabulary.groupBy("lang").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("f").desc(), "phrase")
    ranked = kept.join(spelled, ["lang", "key"]).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("f").alias("a"),
                                              "cut.l", "cut.r", "n", F.col("cut.score").cast("long").alias("score"))
