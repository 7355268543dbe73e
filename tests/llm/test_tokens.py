"""Operators 3 and 4 against the tokenizer library itself."""
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tokenizers

from fraudflow.llm import catalog, tokenize
from fraudflow.llm.cutting_stock import knapsack, plan, solve
from fraudflow.llm.packing import pack_documents, padding
from fraudflow.llm.token_counts import count_tokens
from fraudflow.session import work_path

from .conftest import EDGE, SMALL, pairs, table

BPE = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tk = tokenizers.Tokenizer.from_file(BPE)
    return lambda texts: [e.ids for e in tk.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_pieces_are_exact(library, monkeypatch):
    rng = random.Random(5)
    alphabet = list("ab 1'\n\t .,<|>é　  \u0085ñß\r\x1c日sлΩ") + ["<|endoftext|>", "'ll", "  ", "\n\n", " \n", "𝟙", "​"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(5000)] + [None, "", " ", "\n"]
    monkeypatch.setattr(tokenize, "KEEP", 3000)  # forget now and then
    enc = tokenize.Encoder(BPE)
    assert enc.pieces
    want = library(texts)
    column = pa.array(texts)
    for i in range(0, len(texts), 500):
        assert enc.counts(column.slice(i, 500)).tolist() == [len(x) for x in want[i: i + 500]]
    got = []
    for row, ids, off in enc.ids(column):
        assert row == len(got)
        got += [ids[a:b].tolist() for a, b in zip(off, off[1:])]
    assert got == want


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers_get_whole_texts(spark, edge, name):
    path = P.path(name)
    if name.endswith(".json"):
        tk = tokenizers.Tokenizer.from_file(path)
        count = lambda t: len(tk.encode(t or "", add_special_tokens=False).ids)
    else:
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(sp.encode(t or ""))
    got = {r["doc_id"]: r["n_tokens"] for r in count_tokens(edge, path, work_path(spark, "cache-test")).collect()}
    assert got == {i: count(t) for i, t in EDGE}


def test_cache_encodes_only_new_digests(spark, edge, library, monkeypatch):
    cache = work_path(spark, "cache-test")
    first = count_tokens(edge, BPE, cache).collect()
    stored = spark.read.parquet(cache)
    n = stored.count()
    assert n == len({t or "" for _, t in EDGE})
    more = table(spark, EDGE + [(77, "brand new text"), (78, "brand new text"), (None, None), (6, "one two three four five six")])
    got = count_tokens(more, BPE, cache, limit=3).collect()
    assert spark.read.parquet(cache).count() == n + 2  # "brand new text", and row 6's new text
    want = {i: (len((t or "").encode()), len(x)) for (i, t), x in zip(EDGE, library([t for _, t in EDGE]))}
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in first} == want
    assert len(got) == len(EDGE) + 4
    assert all(r["over_limit"] == (r["n_tokens"] > 3) for r in got)


@pytest.mark.parametrize("row", [(None, "one text for all"), (3, "one text for all")])
def test_cache_has_one_row_a_digest(spark, row):
    """Rows equal in id and text, or of no id, are encoded once."""
    cache = work_path(spark, "cache-test")
    got = count_tokens(table(spark, [row] * 1000 + [(5, None), (6, "")], 7), BPE, cache).collect()
    assert len(got) == 1002
    assert spark.read.parquet(cache).count() == 2


def test_empty_tables(spark, empty):
    assert count_tokens(empty, BPE, work_path(spark, "cache-test")).collect() == []
    assert pack_documents(empty, BPE).collect() == []


def check_places(rows, want, size):
    by, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by) == set(want)
    for d, pieces in by.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(want[d]))
            part = np.array(want[d][at: at + r["length"]], "<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(part) if "ids_crc32" in r else bytes(r["ids"]) == part
            at += r["length"]
        assert at == len(want[d])
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(sequences)


@pytest.mark.parametrize("size,unit", [(2048, None), (64, 1)])
def test_packing_edge_cases(edge, library, size, unit):
    want = {i: x + [1] for (i, _), x in zip(EDGE, library([t for _, t in EDGE]))}
    check_places(pack_documents(edge, BPE, size, unit=unit).collect(), want, size)


def test_packing_query(spark, library):
    docs = pairs(spark.read.parquet(f"{SMALL}/documents.parquet"))
    want = {i: x + [1] for (i, _), x in zip(docs, library([t for _, t in docs]))}
    df = catalog.QUERIES["op3_packing"](spark, SMALL)
    n = check_places(df.collect(), want, 2048)
    assert n <= 1.03 * sum(map(len, want.values())) / 2048 + 1
    assert padding(df).first()["n_sequences"] == n


def test_packing_repeated_rows(spark):
    got = pack_documents(table(spark, [(1, "a b c")] * 50 + [(None, "a"), (None, None)]), BPE, 16).collect()
    assert len(got) == 52
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == 52


def test_column_generation_is_near_the_bound():
    rng = np.random.default_rng(0)
    sizes, demand = np.arange(1, 65), rng.integers(1, 500, 64)
    made = plan(sizes, demand, 64)
    assert sum(p * n for p, n in made).tolist() == demand.tolist()
    assert all((p * sizes).sum() <= 64 for p, _ in made)
    # no plan takes fewer sequences than the linear program's optimum
    best = solve(sizes, demand, 64, gap=1e-9)[1].sum()
    assert np.ceil(best - 1e-6) <= sum(n for _, n in made) <= np.ceil(best) + 1
    assert best > (demand * sizes).sum() / 64
    assert plan(np.array([], int), np.array([], int), 64) == []
    value, pattern = knapsack(np.array([0.3, 0.5, 0.75]), np.array([2, 3, 5]), 10)
    assert (round(value, 9), pattern.tolist()) == (1.6, [2, 2, 0])
