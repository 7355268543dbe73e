"""Operator 1: exact neighbours against brute force, held-out accuracy, edge cases."""
import numpy as np
import pytest

from fraudflow.llm import catalog, toxicity
from fraudflow.llm.toxicity import Model, fit, held_out, score_documents


from .conftest import EDGE, table

MID = "/root/testdata/sf0.01"
LABELS = "doc_id long, toxic int, quality int, text string, terms string"


def labels(spark, rows):
    return spark.createDataFrame([(i, t, 0, "x", "y") for i, t in rows], LABELS)


def made(spark, n=400):
    """Texts of which every fifth is toxic and says so."""
    docs = [(i, " ".join(f"word{(i * 7 + j * j) % 97}" for j in range(30)) + (" vilest insults" if i % 5 == 0 else "")) for i in range(n)]
    return docs, [(i, int(i % 5 == 0)) for i in range(n)]


def test_block_max_neighbours_are_exact():
    rng = np.random.default_rng(3)
    m = Model(terms=[f"t{i}" for i in range(40)], idf=rng.uniform(1, 5, 40), ids=list(range(500)), toxic=rng.integers(0, 2, 500).astype(float))
    vecs = []
    for _ in range(500):
        t = np.sort(rng.choice(40, rng.integers(1, 9), replace=False))
        vecs.append((t, m.weigh(t, rng.integers(1, 5, len(t)))))
    dense = np.zeros((500, 40))
    for i, (t, w) in enumerate(vecs):
        dense[i, t] = w
    m.build(np.repeat(np.arange(500), [len(t) for t, _ in vecs]), np.concatenate([t for t, _ in vecs]), np.concatenate([w for _, w in vecs]))
    for i, (t, w) in enumerate(vecs):
        cosine = np.round(dense @ dense[i], 9)
        cosine[i] = 0
        least = max(np.sort(cosine)[-15], 1e-9)
        near, got = m.nearest(t, w, leave=i)
        # all that equal the 15th are neighbours
        assert set(near) >= set(np.flatnonzero(cosine >= least + 1e-8)) and set(near) <= set(np.flatnonzero(cosine >= least - 1e-8))
        np.testing.assert_allclose(got, -np.sort(-cosine)[: len(got)], atol=1e-8)


@pytest.mark.parametrize("seed,n", [(0, 20), (1, 130), (2, 900)])
def test_many_texts_at_once(seed, n):
    """Common and rare terms, copies, texts without any term in common, groups of several sizes."""
    rng = np.random.default_rng(seed)
    size = 300
    odds = 1 / np.arange(1, size + 1)
    draw = lambda: np.sort(rng.choice(size, rng.integers(1, 40), replace=False, p=odds / odds.sum()))
    m = Model(terms=[""] * (size + 1), idf=rng.uniform(0.1, 5, size + 1), ids=list(range(n)), toxic=rng.integers(0, 2, n).astype(float))
    sets = [draw() for _ in range(n - n // 4)]
    sets += sets[: n // 4]
    counts = [rng.integers(1, 4, len(t)) for t in sets[: n - n // 4]]
    counts += counts[: n // 4]
    m.own = np.concatenate([[0], np.cumsum([len(t) for t in sets])])
    m.own_terms, m.counts = np.concatenate(sets).astype(np.int32), np.concatenate(counts).astype(np.uint8)
    m._ready()
    dense = np.zeros((n, size + 1))
    for i, (t, c) in enumerate(zip(sets, counts)):
        dense[i, t] = m.weigh(t, c)
    texts = [draw() for _ in range(150)] + sets[:5] + [np.array([size])]
    weights = [m.weigh(t, np.ones(len(t))) for t in texts]
    found = m.nearest_of(np.concatenate([[0], np.cumsum([len(t) for t in texts])]), np.concatenate(texts), np.concatenate(weights))
    for t, w, (near, got) in zip(texts, weights, found):
        v = np.zeros(size + 1)
        v[t] = w
        cosine = np.round(dense @ v, 12)
        want = np.flatnonzero((cosine > 0) & (cosine >= np.sort(cosine)[-15:][0]))
        assert sorted(near) == want.tolist()
        np.testing.assert_allclose(got, -np.sort(-cosine[want]), atol=1e-11)


def test_votes_take_no_account_of_ids(spark):
    """Equal texts of either label: the score is the same whatever their ids."""
    rows_ = [(i, "same words here", int(i % 3 == 0)) for i in range(60)] + [(100 + i, f"other plain words w{i}", 0) for i in range(60)]
    scores = []
    for ids in (range(60), reversed(range(60))):
        own = [(j, *r[1:]) for j, r in zip(ids, rows_)] + rows_[60:]
        docs = table(spark, [r[:2] for r in own] + [(999, "same words here")])
        model = fit(docs, labels(spark, [(i, t) for i, _, t in own]))
        scores.append({r["doc_id"]: r["score"] for r in score_documents(docs, model).collect()}[999])
    assert scores[0] == scores[1]


def test_a_repeated_row_is_one_example(spark):
    docs, marks = made(spark)
    once = fit(table(spark, docs), labels(spark, marks))
    often = fit(table(spark, docs + [docs[5]] * 300), labels(spark, marks + [marks[5]] * 3))
    assert sorted(once.ids) == sorted(often.ids) and once.prior == often.prior
    few = fit(table(spark, [(7, f"{t} x{i}") for i, (_, t) in enumerate(docs)] + docs), labels(spark, [(7, 1), *marks]), max_examples=50)
    assert len(few.ids) <= 50


def test_too_large_a_model_is_refused(spark, monkeypatch):
    docs, marks = made(spark)
    model = fit(table(spark, docs), labels(spark, marks))
    monkeypatch.setattr(toxicity, "MAX_BROADCAST", 1000)
    with pytest.raises(ValueError, match="max_examples"):
        score_documents(table(spark, docs), model)


def test_held_out_accuracy(spark):
    rows = {r["doc_id"]: r for r in catalog.QUERIES["op1_toxicity"](spark, MID).collect()}
    assert len(rows) == spark.read.parquet(f"{MID}/documents.parquet").count()
    marked = spark.read.parquet(f"{MID}/labels.parquet").collect()
    clean = [rows[r["doc_id"]]["predicted"] for r in marked if r["toxic"] == 0]
    toxic = [rows[r["doc_id"]]["predicted"] for r in marked if r["toxic"] == 1 and rows[r["doc_id"]]["held_out"]]
    assert sum(clean) <= 0.02 * len(clean)
    assert sum(toxic) >= 0.4 * len(toxic)  # a few hundred labels only
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows.values())


def test_scores_and_evidence(spark):
    docs, marks = made(spark)
    model = fit(table(spark, docs), labels(spark, marks))
    assert any(t.startswith("vile") for t in model.terms)
    more = [(1000, "these vilest insults again word3 word5"), (1001, "a harmless text"), (1002, None), (1003, ""), (1004, "VILEST " * 2000)]
    out = {r["doc_id"]: r for r in score_documents(table(spark, docs + more), model).collect()}
    assert out[1000]["score"] > 0.7 > 0.1 > out[1001]["score"] == out[1002]["score"] == out[1003]["score"]
    assert out[1004]["score"] > 0.5
    assert all(out[i]["score"] > 0.7 for i, t in marks if t) and all(out[i]["score"] < 0.3 for i, t in marks if not t)
    near = out[1000]["neighbours"]
    assert near and all(r["toxic"] for r in near) and "vilest" in out[1000]["terms"]


@pytest.mark.parametrize("marks", [[], [(1, 0), (4, 0)], [(1, 1), (4, 1)], [(None, 1), (4, None), (10**9, 1)]])
def test_labels_of_one_kind_or_none(spark, edge, marks):
    model = fit(edge, labels(spark, marks))
    out = score_documents(edge, model).collect()
    assert len(out) == len(EDGE) and len({r["score"] for r in out}) == 1 and 0 <= out[0]["score"] <= 1


def test_empty_table(spark, empty):
    assert score_documents(empty, fit(empty, labels(spark, [(1, 1)]))).collect() == []


def test_bounded_sample(spark):
    docs, marks = made(spark)
    model = fit(table(spark, docs), labels(spark, marks), max_examples=100)
    assert len(model.ids) <= 100


def test_held_out_split(spark):
    import zlib
    ids = [*range(50), -3, 2**40]
    got = spark.createDataFrame([(i,) for i in [*ids, None]], "doc_id long").select("doc_id", held_out().alias("h")).collect()
    assert {r["doc_id"]: r["h"] for r in got} == {**{i: zlib.crc32(str(i).encode()) % 3 == 1 for i in ids}, None: False}


def test_rare_words_and_exact_copies(spark):
    """Every example is found by all its words, also one whose words no other example has."""
    docs, marks = made(spark)
    rare = [(2000 + i, " ".join(f"r{i}x{j}" for j in range(12)), i % 2) for i in range(40)]
    model = fit(table(spark, docs + [r[:2] for r in rare]), labels(spark, marks + [(i, t) for i, _, t in rare]))
    assert len(model.ids) == len(docs) + len(rare)
    out = {r["doc_id"]: r for r in score_documents(table(spark, [(i + 1000, t) for i, t, _ in rare]), model).collect()}
    for i, _, toxic in rare:
        near = out[i + 1000]["neighbours"]
        assert [(r["doc_id"], r["toxic"], round(r["cosine"], 9)) for r in near] == [(i, toxic, 1.0)]


def test_more_toxic_words_than_the_old_cap(spark):
    docs = [(i, " ".join(f"plain{(i * 7 + j * j) % 97}" for j in range(20)) + (f" slur{i // 50:04d}q" if i % 5 == 0 else "")) for i in range(4000)]
    docs = [(i, t.replace("slur", chr(97 + i // 50 % 26) + chr(97 + i // 1300) + "slur")) for i, t in docs]
    marks = [(i, int(i % 5 == 0)) for i, _ in docs]
    model = fit(table(spark, docs), labels(spark, marks))
    assert len([t for t in model.terms if t]) > 80
    new = [(10_000 + i, f"plain1 plain2 {docs[i][1].split()[-1]}") for i in range(0, 4000, 50)]
    out = score_documents(table(spark, new), model).collect()
    assert len(out) == 80 and all(r["score"] >= 0.7 for r in out)
