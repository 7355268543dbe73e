"""The corpus pipeline, stage by stage, against brute-force versions."""
import sys

import numpy as np
import public_tokenizers as P
import tokenizers

import corpus_pipeline as C
from fraudflow.llm.tokenize import encoder
from fraudflow.llm.toxicity import fit
from fraudflow.llm.words import Powers, lean, slices

from . import brute
from .conftest import DOCS, EDGE, PASSAGE, SMALL, table
from .test_tokens import check_places

FOUR = ["doc_id", "text", "lang", "source", "n_chars"]


def rows(df):
    return sorted((tuple(r) for r in df.select(*FOUR).collect()), key=str)


def brute_scores(model, texts):
    """Scores by comparing each text with every example."""
    import pyarrow as pa

    m = len(model.terms)
    dense = np.zeros((len(model.ids), m))
    for t, (r, w) in enumerate(model.postings):
        dense[r, t] = w
    out, powers, flags = [], Powers(), model.flags()
    for row, buf, off in slices(pa.array(texts, pa.string())):
        r, t, n = model.vectors(buf, off, powers, flags)
        for i in range(len(off) - 1):
            own = r == i
            if not own.any():
                out.append(model.without)
                continue
            v = np.zeros(m)
            v[t[own]] = model.weigh(t[own], n[own])
            cosine = np.round(dense @ v, 12)
            near = np.flatnonzero((cosine > 0) & (cosine >= np.sort(cosine)[-15:][0]))  # all that equal the 15th
            out.append(model.score(model.vote(near, cosine[near])))
    return out


def test_all_stages(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = rows(docs)
    for name, stage in C.STAGES[:-1]:
        out = C.stored(stage(spark, docs, sf), f"test-{name}")
        assert out.columns == FOUR
        got, pairs_ = rows(out), [(r[0], r[1]) for r in before]
        if name == "toxicity":
            scores = brute_scores(fit(docs, spark.read.parquet(f"{sf}/labels.parquet")), [t for _, t in pairs_])
            assert all(s < 1e-3 or abs(s - 0.7) > 1e-6 for s in scores)
            want = [r for r, s in zip(before, scores) if s < 0.7]
            assert 0 < len(want) < len(before)
        elif name == "ngram_jaccard_join":
            found = brute.jaccard_join(pairs_)
            want = [r for r in before if found[r[0]][1] == r[0]]
            assert len(want) < len(before)
        elif name == "substring_dedup":
            found = brute.substring_dedup(pairs_)
            assert {r[0] for r in got} == set(found)
            old = {r[0]: r for r in before}
            for r in got:
                n, removed, digest = found[r[0]]
                if removed:
                    assert brute.hashlib.sha256(r[1].encode()).hexdigest() == digest and r[4] == len(r[1])
                else:
                    assert r == old[r[0]]
            assert sum(v[1] for v in found.values()) > 0
            want = got
        else:
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            found = brute.decontaminate(pairs_, items)
            want = [r for r in before if not found[r[0]][-1]]
            assert len(want) < len(before)
        assert got == want, name
        before, docs = got, out
    tk = tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = {r[0]: tk.encode(r[1] or "", add_special_tokens=False).ids + [1] for r in before}
    check_places(C.packing(spark, docs, sf).collect(), want, 2048)
    # run() does the same
    whole = sorted((r["doc_id"], r["start"], r["ids_crc32"]) for r in C.run(spark, sf).collect())
    assert whole == sorted((r["doc_id"], r["start"], r["ids_crc32"]) for r in C.packing(spark, docs, sf).collect())


def test_stages_of_edge_cases(spark, edge, empty):
    more = EDGE + [(None, PASSAGE), (None, None), (10, PASSAGE), (4, "one two three")]
    docs = table(spark, more)
    assert docs.schema == DOCS
    for name, stage in C.STAGES[:-1]:
        assert rows(stage(spark, empty, SMALL)) == []
        got = rows(stage(spark, docs, SMALL))
        if name == "toxicity":
            assert len(got) == len(more)
        elif name == "ngram_jaccard_join":
            ids = [r[0] for r in got]
            assert 5 not in ids and 22 not in ids
            # one of the rows of id 10, and of the copies without id only the empty text
            assert ids.count(10) == 1 and ids.count(None) == 1 and ids.count(4) == 1
        elif name == "substring_dedup":
            assert len(got) == len(more)
    assert C.packing(spark, empty, SMALL).collect() == []
    assert len(C.packing(spark, docs, SMALL).collect()) >= len(more)


def test_rows_of_files_keep_their_keys(spark, tmp_path):
    """A row's key follows from its file and place, not from how the scan is split."""
    docs = [(i % 7 or None, f"text {i}") for i in range(300)]
    table(spark, docs, 5).write.parquet(str(tmp_path / "d"))
    keys = []
    for size in ("128m", "1k"):
        own = spark.newSession()
        own.conf.set("spark.sql.files.maxPartitionBytes", size)
        got = C._keyed(own.read.parquet(str(tmp_path / "d"))).select("_row", "text").collect()
        keys.append(sorted(map(tuple, got)))
    assert keys[0] == keys[1] and len({k for k, _ in keys[0]}) == 300


def test_groups_without_ids_keep_one_row(spark):
    rows_ = [(None, PASSAGE)] * 4 + [(None, "alone " * 9)]
    got = rows(C.ngram_jaccard_join(spark, table(spark, rows_), SMALL))
    assert sorted(r[1][:5] for r in got) == ["alone", PASSAGE[:5]]


def test_stages_leave_only_what_they_decide(spark):
    """No intermediate table stays on disk."""
    import os

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    base = C.ngram_jaccard_join.__globals__["settled"].__globals__["work_path"](spark, "x").rsplit("/", 1)[0]
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    for name in ("ngram_jaccard_join", "substring_dedup", "benchmark_decontamination"):
        dict(C.STAGES)[name](spark, docs, "/root/testdata/sf0.01")
    left = sorted(n.rsplit("-", 1)[0] for n in set(os.listdir(base)) - before)
    assert left == ["contaminated", "copies", "files", "files", "repeats"]


def test_registered_names():
    import __spark_entry__ as E

    q = E.queries()
    assert q["pipeline"] and sum(k.startswith("op") and k[2:].split("_")[0].isdigit() for k in q) == 13
    assert C.ORACLE_SQL is None and [n for n, _ in C.STAGES][0] == "toxicity" and len(C.STAGES) == 5


def test_rows_of_one_id_go_by_their_own_texts(spark):
    """One contaminated row, or one copy, takes no other row of its id, or without id, with it."""
    item = next(r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect() if len(r["text"].split()) >= 10)
    clean = [(None, "clean words of no benchmark"), (None, "other clean words here"), (5, "a third clean text")]
    got = rows(C.benchmark_decontamination(spark, table(spark, [*clean, (None, item), (5, item)]), SMALL))
    assert sorted((r[:2] for r in got), key=str) == sorted(clean, key=str)
    own = [(7, PASSAGE), (8, "a text of its own that nothing else resembles at all")]
    got = rows(C.ngram_jaccard_join(spark, table(spark, [*own, (8, PASSAGE)]), SMALL))
    assert [r[:2] for r in got] == own


def _own_mb() -> float:
    with open("/proc/self/smaps_rollup") as f:
        return sum(int(line.split()[1]) for line in f if line.startswith("Private_Dirty")) / 1024


def test_a_stage_begins_without_the_memory_of_the_stages_before():
    """The scoring stage lets the packing stage's tokenizer go, and gives back what tasks have freed."""
    path = P.path("byte_bpe_50k.json")
    lean()
    before = _own_mb()
    encoder(path)
    parts = [np.ones(1 << 13) for _ in range(2000)]  # 131 MB in pieces that stay in the heap
    pin = np.ones(1 << 13)
    lean(tokenizers=True)
    assert encoder(path) is sys.modules["_encoders"].__dict__[path]
    full = _own_mb()
    del parts
    lean()
    assert "_encoders" not in sys.modules
    assert _own_mb() - before < 0.3 * (full - before) and len(pin)
