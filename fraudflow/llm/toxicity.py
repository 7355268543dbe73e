"""Toxicity by nearest labelled examples (dealt operator 1).

Texts are TF-IDF vectors over all words of the labelled texts, and over those
word beginnings that go with toxicity.  How much a word goes with toxic labels
is a factor of its weight, never a reason to leave it out.  A block-max
inverted index of the labelled examples finds the exact top-k by cosine, for
many texts at once.  Examples are laid out by content, so that neighbours in
meaning share a block of 64.  The postings of rarer terms are summed first.
For the terms that stand in many examples every block knows its largest
weights, which bound what they can add: only blocks whose bound reaches the
k-th best are multiplied out.  That is done in single precision; all examples
within its error of the k-th best are compared again exactly.  Votes are
weighted by distance and calibrated on the examples themselves, each left out
once.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from .store import stored
from .words import LOWER, NON_ALNUM, U64, Powers, byte_sums, lean, mix, slices, span_hashes, spans

BEGINNINGS = (4, 5, 6)  # characters
MAX_EXAMPLES = 20_000  # labelled rows that a model is fitted on, the smallest by a hash of their id
BLOCK = 64
HIGH = 20  # bits of a term's hash that lead to its number
SLICE = 1 << 19  # bytes of text whose words are looked up together
GROUP = 80  # texts that are multiplied with the index together, at most
COMMON = 0.05  # share of the examples from which a term is kept in rows of weights instead of a posting list
ERROR = 1e-4  # of a cosine in single precision: terms of a text x 2^-24, with room to spare
NEIGHBOURS = 15
MAX_BROADCAST = 512 << 20  # bytes of a model that is sent to the executors
CALIBRATE = 5_000  # examples that are left out in turn for the calibration, evenly from all
PLAIN = 0.05  # factor of a term that doesn't go with toxicity; of one that surely does it is 1
CHI = 10.83  # chi-square (0.1 %) from which a term goes with toxicity


def _lower(buf: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 letters in lower case."""
    out = LOWER[buf]
    if len(buf) > 1:
        at = np.flatnonzero(buf[:-1] == 0xC3) + 1
        at = at[(buf[at] >= 0x80) & (buf[at] <= 0x9E) & (buf[at] != 0x97)]
        out[at] += 0x20
    return out


def features(buf: np.ndarray, off: np.ndarray, powers: Powers, within: np.ndarray | None = None):
    """The lower-cased bytes, and (text row, feature hash, byte start, byte end, characters
    or 0 for a word) of all words and word beginnings.

    ``within``: 65,536 flags by the low bits of the beginnings' hashes that are wanted.
    """
    low = _lower(buf)
    s, e, first = spans(low, off, NON_ALNUM)
    rows = np.repeat(np.arange(len(off) - 1), np.diff(first))
    begins = (low & 0xC0) != 0x80
    edge = np.append(np.flatnonzero(begins), len(low))
    upto = np.zeros(len(low) + 1, np.int32)  # characters before each byte
    np.cumsum(begins, out=upto[1:])
    a, b = upto[s], upto[e]
    sums = byte_sums(low, powers)
    out = []
    for kind, n in enumerate((0, *BEGINNINGS)):
        if n:
            long = b - a > n
            r, x, y = rows[long], s[long], edge[a[long] + n]
        else:
            r, x, y = rows, s, e
        h = mix(span_hashes(low, x, y, powers, sums) + U64(kind))
        if n and within is not None:
            ok = within[(h & U64(0xFFFF)).astype(np.int64)]
            r, h, x, y = r[ok], h[ok], x[ok], y[ok]
        out.append((r, h, x, y, np.full(len(r), n, np.int32)))
    return low, [np.concatenate(x) for x in zip(*out)]


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All places of the ranges [start, end), one after the other."""
    n = ends - starts
    return np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(n.sum())


@dataclass
class Model:
    """A fitted index; all arrays are bounded by the words of the examples."""

    hashes: np.ndarray = field(default_factory=lambda: np.zeros(0, U64))  # ascending
    high: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))  # by a hash's high bits, the first term
    terms: list[str] = field(default_factory=list)  # empty for those that don't go with toxicity
    beginnings: np.ndarray = field(default_factory=lambda: np.zeros(0, U64))  # hashes
    idf: np.ndarray = field(default_factory=lambda: np.zeros(0))  # times the factor of the association
    ids: list[int] = field(default_factory=list)
    toxic: np.ndarray = field(default_factory=lambda: np.zeros(0))
    prior: float = 0.0
    without: float = 0.0  # score of a text with none of the terms
    points: tuple[np.ndarray, np.ndarray] = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))  # calibration
    # by example: from its first, terms and weights
    own: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    own_terms: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    own_weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    counts: np.ndarray | None = None  # by example, of which the weights are made
    norms: np.ndarray = field(default_factory=lambda: np.zeros(0))  # by example, what its weights are divided by
    logs: np.ndarray = field(default_factory=lambda: np.zeros(0))  # by count, one more than its logarithm
    shared: object = None  # its broadcast
    # postings of rarer terms: from each term's first, examples and weights
    edges: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    rows: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    # common terms: their column or -1, their weights (blocks x BLOCK x columns), the largest of each block
    column: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    common: np.ndarray = field(default_factory=lambda: np.zeros((0, BLOCK, 0), np.float32))
    bounds: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))

    @property
    def postings(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """By term: examples, weights."""
        self._ready()
        weights = self._weights(np.arange(len(self.own_terms)), np.repeat(np.arange(len(self.ids)), np.diff(self.own)))
        order = np.argsort(self.own_terms, kind="stable")
        rows = np.repeat(np.arange(len(self.ids)), np.diff(self.own))[order]
        edges = np.searchsorted(self.own_terms[order], np.arange(len(self.terms) + 1))
        return [(rows[a:b], weights[order][a:b]) for a, b in zip(edges, edges[1:])]

    def _weights(self, places: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Weights of entries, and whose they are."""
        if self.counts is None:
            return self.own_weights[places]
        return self.logs[self.counts[places]] * self.idf[self.own_terms[places]] / self.norms[of]

    def flags(self) -> np.ndarray:
        out = np.zeros(1 << 16, bool)
        out[(self.beginnings & U64(0xFFFF)).astype(np.int64)] = True
        return out

    def vectors(self, buf, off, powers, flags):
        """(rows, term numbers, counts) of the texts of a slice, by row and term."""
        _, (r, h, *_) = features(buf, off, powers, flags)
        at = self.find(h)
        ok = at >= 0
        m = max(1, len(self.terms))
        key, n = np.unique(r[ok] * m + at[ok], return_counts=True)
        return key // m, key % m, n

    def find(self, h: np.ndarray) -> np.ndarray:
        """The number of each hash's term, or -1: hashes are spread evenly, so their high bits tell where to look."""
        if not len(self.hashes):
            return np.full(len(h), -1)
        if not len(self.high):
            self.high = np.searchsorted(self.hashes, np.arange(1 << HIGH, dtype=U64) << U64(64 - HIGH)).astype(np.int32)
        known = np.append(self.hashes, U64(0))
        at = self.high[(h >> U64(64 - HIGH)).astype(np.int64)].astype(np.int64)
        left = np.flatnonzero((at < len(self.hashes)) & (known[at] < h))
        while len(left):  # few steps: a place has less than one hash on the average
            at[left] += 1
            left = left[(at[left] < len(self.hashes)) & (known[at[left]] < h[left])]
        return np.where((at < len(self.hashes)) & (known[at] == h), at, -1)

    def weigh(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        w = (1 + np.log(counts)) * self.idf[terms]
        return w / np.sqrt((w * w).sum())

    def build(self, rows, terms, weights) -> None:
        """The inverted index of examples from (example, term, weight) entries."""
        by = np.lexsort((terms, rows))
        self.own = np.searchsorted(rows[by], np.arange(len(self.ids) + 1))
        self.own_terms, self.own_weights = terms[by].astype(np.int32), weights[by]
        self._invert()

    def common_weights(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The weights of the common terms of (terms, counts) vectors, a row each."""
        df = np.zeros(len(self.terms), np.int64)
        for terms, _ in vectors:
            df[terms] += 1
        column = np.full(len(df), -1, np.int32)
        many = np.flatnonzero(df >= max(2, COMMON * len(vectors)))
        column[many] = np.arange(len(many))
        out = np.zeros((len(vectors), len(many)), np.float32)
        for row, (terms, counts) in zip(out, vectors):
            at, w = column[terms], self.weigh(terms, counts.astype(np.int64))
            row[at[at >= 0]] = w[at >= 0]
        return out

    def _ready(self) -> None:
        """The index, which isn't sent with the model."""
        if self.counts is not None and len(self.norms) != len(self.ids):
            self.logs = 1 + np.log(np.maximum(1, np.arange(int(self.counts.max(initial=0)) + 1)))
            self.norms = np.array([np.sqrt((w * w).sum()) for w in (
                self.logs[self.counts[a:b]] * self.idf[self.own_terms[a:b]] for a, b in zip(self.own, self.own[1:]))])
            self._invert()

    def _invert(self) -> None:
        n, m = len(self.ids), len(self.terms)
        df = np.bincount(self.own_terms, minlength=m)
        many = np.flatnonzero(df >= max(2, COMMON * n))
        self.column = np.full(m, -1, np.int32)
        self.column[many] = np.arange(len(many))
        blocks = -(-n // BLOCK)
        self.common = np.zeros((blocks * BLOCK, len(many)), np.float32)
        df[many] = 0
        self.edges = np.concatenate([[0], np.cumsum(df)])
        narrow = np.uint16 if n <= 1 << 16 else np.int32
        self.rows, self.weights = np.zeros(self.edges[-1], narrow), np.zeros(self.edges[-1], np.float32)
        upto = self.edges[:-1].copy()
        for a in range(0, n, 256):  # some examples at a time: no second copy of all entries
            some = np.arange(a, min(n, a + 256))
            x = np.arange(self.own[some[0]], self.own[some[-1] + 1])
            of = np.repeat(some, self.own[some + 1] - self.own[some])
            w, terms = self._weights(x, of), self.own_terms[x]
            at = self.column[terms]
            self.common[of[at >= 0], at[at >= 0]] = w[at >= 0]
            few = np.flatnonzero(at < 0)
            few = few[np.argsort(terms[few], kind="stable")]
            t = terms[few]
            head = np.flatnonzero(np.diff(t, prepend=-1))
            place = upto[t] + np.arange(len(t)) - np.repeat(head, np.diff(np.append(head, len(t))))
            self.rows[place], self.weights[place] = of[few], w[few]
            upto[t[head]] += np.diff(np.append(head, len(t)))
        self.common = self.common.reshape(blocks, BLOCK, len(many))
        self.bounds = self.common.max(axis=1)

    def __getstate__(self):
        """What the index is made of; it is made again where it is used."""
        made = ("high", "norms", "logs", "edges", "rows", "weights", "column", "common", "bounds")
        return {k: v for k, v in self.__dict__.items() if k != "shared" and (self.counts is None or k not in made)}

    def __setstate__(self, state) -> None:
        self.__init__()
        self.__dict__.update(state)

    def size(self) -> int:
        """Bytes that are sent."""
        return sum(v.nbytes for v in self.__getstate__().values() if isinstance(v, np.ndarray)) + sum(len(t) + 4 for t in self.terms)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int = NEIGHBOURS, leave: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of largest cosine above 0, all that equal the last of them, and these cosines."""
        return self.nearest_of(np.array([0, len(terms)]), terms, weights, k, np.array([leave]))[0]

    def nearest_of(self, edges: np.ndarray, terms: np.ndarray, weights: np.ndarray, k: int = NEIGHBOURS,
                   leave: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` for many texts: text i has the terms from edges[i] to edges[i + 1]."""
        self._ready()
        texts = len(edges) - 1
        leave = np.full(texts, -1) if leave is None else leave
        if not len(self.ids):
            return [(np.zeros(0, np.int64), np.zeros(0))] * texts
        of = np.repeat(np.arange(texts), np.diff(edges))
        col = self.column[terms]
        common = np.zeros((texts, self.common.shape[2]), np.float32)
        common[of[col >= 0], col[col >= 0]] = weights[col >= 0]
        bound = common @ self.bounds.T
        out: list = [None] * texts
        vector = np.zeros(len(self.terms))
        # texts whose best blocks are close need much the same blocks
        order = np.argsort(bound.argmax(axis=1), kind="stable")
        for group in np.array_split(order, -(-texts // GROUP)) if texts else ():
            for i, found in zip(group, self._candidates(group, edges, terms, weights, col, common[group], bound[group], k + 1)):
                x = slice(edges[i], edges[i + 1])
                vector[terms[x]] = weights[x]
                y = _ranges(self.own[found], self.own[found + 1])
                by = np.repeat(np.arange(len(found)), self.own[found + 1] - self.own[found])
                cosine = np.round(np.bincount(by, vector[self.own_terms[y]] * self._weights(y, found[by]), len(found)), 12)
                vector[terms[x]] = 0
                ok = (cosine > 0) & (found != leave[i])
                found, cosine = found[ok], cosine[ok]
                if len(found) > k:
                    ok = cosine >= np.partition(cosine, len(found) - k)[len(found) - k]
                    found, cosine = found[ok], cosine[ok]
                top = np.lexsort((found, -cosine))
                out[i] = found[top], cosine[top]
        return out

    def _candidates(self, group, edges, terms, weights, col, common, bound, k):
        """For each text of a group, examples that hold its k best."""
        n, blocks = len(self.ids), len(self.common)
        score = np.zeros((len(group), blocks * BLOCK), np.float32)
        for i, e in enumerate(group):
            x = np.arange(edges[e], edges[e + 1])
            x = x[col[x] < 0]
            a, b = self.edges[terms[x]], self.edges[terms[x] + 1]
            y = _ranges(a, b)
            score[i] = np.bincount(self.rows[y], np.repeat(weights[x].astype(np.float32), b - a) * self.weights[y], blocks * BLOCK)
        score = score.reshape(len(group), blocks, BLOCK)
        if n <= k:
            return [np.arange(n)] * len(group)
        bound = bound + score.max(axis=2) + ERROR
        # the best block's examples give the k-th best a floor
        one, best = np.arange(len(group)), bound.argmax(axis=1)
        first = score[one, best] + (self.common[best] @ common[:, :, None])[:, :, 0]
        floor = np.partition(first, BLOCK - k, axis=1)[:, BLOCK - k] if k <= BLOCK else np.zeros(len(group))
        some = np.flatnonzero((bound >= floor[:, None] - ERROR).any(axis=0))
        rows = self.common
        if len(some) < blocks:
            rows, score = rows[some], score[:, some]
        score += (common @ rows.reshape(-1, common.shape[1]).T).reshape(len(group), len(some), BLOCK)
        tops = score.max(axis=2)
        if len(some) >= k:  # the k-th best block's best is no better than the k-th best of all
            floor = np.maximum(floor, np.partition(tops, len(some) - k, axis=1)[:, len(some) - k])
        least = np.maximum(floor - 2 * ERROR, np.finfo(np.float32).tiny)
        g, s = np.nonzero(tops >= least[:, None])
        near = score[g, s]
        h, r = np.nonzero(near >= least[g][:, None])
        g, value, found = g[h], near[h, r], some[s[h]] * BLOCK + r
        edge = np.searchsorted(g, np.arange(len(group) + 1))
        out = []
        for a, b in zip(edge, edge[1:]):
            own = value[a:b]
            out.append(found[a:b][own >= np.partition(own, len(own) - k)[len(own) - k] - 2 * ERROR] if len(own) > k else found[a:b])
        return out

    def vote(self, near: np.ndarray, cosine: np.ndarray) -> float:
        w = 1 / (1.05 - np.minimum(cosine, 1))
        return float((w @ self.toxic[near] + self.prior) / (w.sum() + 1))

    def calibrate(self, votes: np.ndarray, toxic: np.ndarray) -> None:
        """Monotone steps from votes to smoothed shares, by pooling adjacent violators."""
        order = np.argsort(votes, kind="stable")
        pools: list[list[float]] = []  # [sum of votes, toxic, rows]
        for part in np.array_split(order, max(1, min(50, len(order) // 20))):
            if len(part):
                pools.append([votes[part].sum(), toxic[part].sum(), len(part)])
                while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
                    last = pools.pop()
                    pools[-1] = [x + y for x, y in zip(pools[-1], last)]
        if pools:
            x = np.array([p[0] / p[2] for p in pools])
            y = np.array([(p[1] + self.prior) / (p[2] + 1) for p in pools])
            self.points = (x, np.maximum.accumulate(y))

    def score(self, vote: float) -> float:
        return float(min(1.0, max(0.0, np.interp(vote, *self.points))))


def fit(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES,
        id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model from ``labels`` (doc_id, toxic 0 or 1) and the texts of ``docs``.

    At most ``max_examples`` labelled rows are used, those of the smallest
    hash of their id: the one bounded sample.  Rows equal in id and text count
    once.  Rows with a null id or label are left out, an id labelled twice is
    toxic if either says so.  Terms:
    all words of these texts, and the beginnings that go with toxicity, which
    are those of three times the usual share of toxic examples and a
    chi-square (continuity-corrected) of CHI or more.  A term's idf is taken
    times PLAIN up to 1 as its chi-square goes from CHI to infinity.
    """
    chosen = (labels.where(F.col(id_col).isNotNull() & F.col("toxic").isin(0, 1))
              .groupBy(F.col(id_col).cast("long").alias("_id")).agg(F.max("toxic").cast("int").alias("toxic"))
              .orderBy(F.xxhash64("_id"), "_id").limit(max_examples))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.withColumn("digest", F.md5(F.coalesce("text", F.lit(""))))
    # at most max_examples rows are broadcast: first their ids, then one of each id and text
    own = F.col("doc_id") == F.col("_id")
    pairs = texts.join(F.broadcast(stored(chosen, "labelled")), own).select("_id", "digest", "toxic").distinct()
    pairs = stored(pairs.orderBy(F.xxhash64("_id"), "_id", "digest").limit(max_examples).withColumnRenamed("digest", "_digest"), "labelled-texts")
    sample = (texts.join(F.broadcast(pairs), own & (F.col("digest") == F.col("_digest")))
              .groupBy("doc_id", "digest", "toxic").agg(F.any_value("text").alias("text")))
    sample = stored(sample.select("doc_id", "toxic", "text"), "examples")

    def count(batches):
        import pyarrow as pa

        lean()
        powers = Powers()
        for b in batches:
            toxic = b.column("toxic").to_numpy()
            for row, buf, off in slices(b.column("text"), SLICE):
                low, (r, h, s, e, k) = features(buf, off, powers)
                order = np.lexsort((r, h))
                r, h, s, e, k = r[order], h[order], s[order], e[order], k[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
                r, h, s, e, k = r[new], h[new], s[new], e[new], k[new]  # once a text
                head = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
                t = toxic[row + r].astype(np.int64)
                raw = low.tobytes()
                yield pa.record_batch({
                    "hash": pa.array(h[head].view(np.int64)), "n": pa.array(np.diff(np.append(head, len(h)))),
                    "n_toxic": pa.array(np.add.reduceat(t, head) if len(head) else head), "kind": pa.array(k[head]),
                    "term": pa.array([raw[x:y].decode("utf-8", "replace") for x, y in zip(s[head].tolist(), e[head].tolist())], pa.string())})

    counts = (sample.mapInArrow(count, "hash long, n long, n_toxic long, kind int, term string").groupBy("hash", "kind")
              .agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("n_toxic"), F.min("term").alias("term")))
    totals = sample.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("t")).first()
    n, t = totals["n"], totals["t"]
    m = Model(prior=(t + 1) / (n + 20) if n else 0.0)
    if not t or t == n:
        m.without = m.prior
        m.points = (np.array([0.0, 1.0]), np.array([m.prior, m.prior]))
        return m
    # how far the toxic examples with a term are above what chance gives, in squared deviations
    over = F.greatest(F.lit(0.0), F.col("n_toxic") - F.col("n") * float(t) / n - 0.5)
    chi = over * over / (F.col("n") * (float(t) / n) * (float(n - t) / n))
    goes = (F.col("chi") >= CHI) & (F.col("n_toxic") * n >= 3 * t * F.col("n"))
    top = (counts.withColumn("chi", chi).where((F.col("kind") == 0) | goes)
           .select("hash", "kind", "n", F.when(goes, F.col("chi")).alias("chi"), F.when(goes, F.col("term")).otherwise("").alias("term")).toArrow())
    hashes = top["hash"].to_numpy().view(U64)
    order = np.argsort(hashes, kind="stable")
    m.hashes = hashes[order]
    m.terms = top["term"].take(order).to_pylist()
    m.beginnings = m.hashes[top["kind"].to_numpy()[order] > 0]
    chi = np.nan_to_num(top["chi"].cast("double").to_numpy().astype(float), nan=CHI)[order]
    m.idf = (np.log((n + 1) / (top["n"].to_numpy()[order] + 1)) + 1) * (PLAIN + (1 - PLAIN) * (1 - CHI / chi))

    del top, hashes, order, chi
    import pyarrow as pa

    flags = m.flags()

    def vectors(batches):
        import pyarrow as pa

        lean()
        powers = Powers()
        for batch in batches:
            for row, buf, off in slices(batch.column("text"), SLICE):
                r, term, k = m.vectors(buf, off, powers, flags)
                at = pa.array(np.searchsorted(r, np.arange(len(off))).astype(np.int32))
                part = batch.slice(row, len(off) - 1)
                yield pa.record_batch([part.column("doc_id"), part.column("toxic"), pa.ListArray.from_arrays(at, pa.array(term.astype(np.int32))), pa.ListArray.from_arrays(at, pa.array(k.astype(np.int32)))],
                                      names=["doc_id", "toxic", "terms", "counts"])

    got = sample.mapInArrow(vectors, "doc_id long, toxic int, terms array<int>, counts array<int>").toArrow().combine_chunks()
    terms, counts = (got[c].chunk(0) if got.num_rows else pa.array([], pa.list_(pa.int32())) for c in ("terms", "counts"))
    edges, terms, counts = terms.offsets.to_numpy(), terms.values.to_numpy(), counts.values.to_numpy()
    ids, toxic = got["doc_id"].to_pylist(), got["toxic"].to_pylist()
    part = [slice(x, y) for x, y in zip(edges.tolist(), edges[1:].tolist())]
    goes = np.array([bool(x) for x in m.terms])
    none = [y for x, y in zip(part, toxic) if not goes[terms[x]].any()]
    m.without = (sum(none) + m.prior) / (len(none) + 1)
    full = [i for i, x in enumerate(part) if x.stop > x.start]
    # ids decide nothing: examples are ordered by vector and label, then laid out by content
    full.sort(key=lambda i: (hashlib.blake2b(terms[part[i]].tobytes() + counts[part[i]].tobytes(), digest_size=16).digest(), toxic[i], ids[i]))
    if full:
        vectors_ = [(terms[part[i]], counts[part[i]]) for i in full]
        order = by_content(m.common_weights(vectors_))
        m.ids, m.toxic = [ids[full[i]] for i in order], np.array([toxic[full[i]] for i in order], float)
        m.own = np.concatenate([[0], np.cumsum([len(vectors_[i][0]) for i in order])])
        m.own_terms = np.concatenate([vectors_[i][0] for i in order])
        m.counts = np.concatenate([vectors_[i][1].astype(np.min_scalar_type(counts.max())) for i in order])
        del got, terms, counts, part, vectors_
        chosen = np.unique(np.linspace(0, len(m.ids) - 1, min(len(m.ids), CALIBRATE)).astype(np.int64))
        m.calibrate(_votes(docs.sparkSession, m, chosen), m.toxic[chosen])
    return m


def by_content(rows: np.ndarray) -> np.ndarray:
    """An order in which similar rows stand together: halved at the median of the widest of eight main directions,
    and the halves again, down to blocks."""
    if not rows.shape[1]:
        return np.arange(len(rows))
    mean = rows.mean(axis=0)
    values, vectors = np.linalg.eigh(rows.T @ rows / len(rows) - np.outer(mean, mean))
    seen = rows @ vectors[:, np.argsort(-values)[:8]]
    out, left = [], [np.arange(len(rows))]
    while left:
        part = left.pop()
        if len(part) <= BLOCK:
            out.append(part)
            continue
        own = seen[part]
        part = part[np.argsort(own[:, own.var(axis=0).argmax()], kind="stable")]
        half = -(-len(part) // (2 * BLOCK)) * BLOCK  # whole blocks on the one side
        left += [part[half:], part[:half]]
    return np.concatenate(out)


def send(spark, model: Model):
    """The model as a broadcast, made once, if it isn't larger than MAX_BROADCAST; the calibration isn't part of it."""
    if (size := model.size()) > MAX_BROADCAST:
        raise ValueError(f"a model of {size >> 20} MB: fit it on fewer examples (max_examples)")
    if model.shared is None:
        model.shared = spark.sparkContext.broadcast(model)
    return model.shared


def _votes(spark, model: Model, chosen: np.ndarray) -> np.ndarray:
    """The votes of the chosen examples by their neighbours but themselves."""
    shared = send(spark, model)

    def run(batches):
        import pyarrow as pa

        lean()
        m = shared.value
        m._ready()
        for b in batches:
            i, votes = b.column("id").to_numpy(), []
            for part in np.array_split(chosen[i], -(-len(i) // 512)):
                x = _ranges(m.own[part], m.own[part + 1])
                size = m.own[part + 1] - m.own[part]
                near = m.nearest_of(np.concatenate([[0], np.cumsum(size)]), m.own_terms[x], m._weights(x, np.repeat(part, size)), leave=part)
                votes += [m.vote(*found) for found in near]
            yield pa.record_batch({"id": b.column("id"), "vote": pa.array(votes, pa.float64())})

    parts = max(1, min(spark.sparkContext.defaultParallelism, len(chosen) // 250))
    got = spark.range(0, len(chosen), 1, parts).mapInArrow(run, "id long, vote double").toArrow()
    out = np.zeros(len(chosen))
    out[got["id"].to_numpy()] = got["vote"].to_numpy()
    return out


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", k: int = NEIGHBOURS,
                    carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, score, terms, neighbours (doc_id, cosine, toxic) for every row of ``docs``.

    ``terms`` are those that go with toxicity; all words count for the score.
    Examples as near as the k-th all vote; ``neighbours`` shows k.
    ``carry`` names columns of ``docs`` to give instead of doc_id.

    Every whole text is scored; a null or empty one, like any without the
    model's terms, gets the share of toxic ones among the examples without a
    term that goes with toxicity.
    """
    def run(batches):
        import pyarrow as pa

        lean()
        model = shared.value
        model.points = points
        powers, flags = Powers(), model.flags()
        goes = np.array([bool(t) for t in model.terms])
        near_type = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))
        plain = (model.without, [], [])
        for b in batches:
            for row, buf, off in slices(b.column(text_at), SLICE):
                n = len(off) - 1
                r, term, count = model.vectors(buf, off, powers, flags)
                edges = np.searchsorted(r, np.arange(n + 1))
                # texts of one vector are scored once
                same: dict[bytes, list] = {}
                for i in np.flatnonzero(np.diff(edges)).tolist():
                    x = slice(edges[i], edges[i + 1])
                    same.setdefault(term[x].tobytes() + count[x].tobytes(), []).append(i)
                first = np.array([i[0] for i in same.values()], np.int64)
                x = _ranges(edges[first], edges[first + 1])
                size = edges[first + 1] - edges[first]
                w = (1 + np.log(count[x])) * model.idf[term[x]]
                at = np.repeat(np.arange(len(first)), size)
                w = w / np.sqrt(np.bincount(at, w * w, len(first)))[at]
                found = model.nearest_of(np.concatenate([[0], np.cumsum(size)]), term[x], w, k)
                every = [plain] * n
                for rows_, (near, cosine) in zip(same.values(), found):
                    own = term[edges[rows_[0]]: edges[rows_[0] + 1]]
                    made = (model.score(model.vote(near, cosine)), [model.terms[j] for j in own[goes[own]]],
                            [{"doc_id": model.ids[j], "cosine": float(c), "toxic": int(model.toxic[j])} for j, c in zip(near[:k], cosine)])
                    for i in rows_:
                        every[i] = made
                scores, terms, near = zip(*every) if n else ((), (), ())
                yield pa.record_batch([*(b.column(i).slice(row, n) for i in range(kept)), pa.array(scores, pa.float64()), pa.array(terms, pa.list_(pa.string())), pa.array(near, near_type)],
                                      names=names)

    shared, points = send(docs.sparkSession, model), model.points
    first = docs.select(*carry) if carry else docs.select(F.col(id_col).cast("long").alias("doc_id"))
    names, kept = [*first.columns, "score", "terms", "neighbours"], len(first.columns)
    rows, text_at = first, kept
    if carry and text_col in first.columns and dict(first.dtypes)[text_col] == "string":
        text_at = first.columns.index(text_col)  # carried as it is: not sent twice
    else:
        rows = docs.select(*(carry or [F.col(id_col).cast("long").alias("doc_id")]), F.col(text_col).cast("string").alias("_text"))
    schema = StructType([*first.schema, StructField("score", DoubleType()), StructField("terms", ArrayType(StringType())),
                         StructField("neighbours", ArrayType(StructType().add("doc_id", LongType()).add("cosine", DoubleType()).add("toxic", IntegerType())))])
    return rows.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    """Rows kept from learning: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))
