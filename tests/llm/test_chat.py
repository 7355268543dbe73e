"""Operator 2: exact round trips against plain Python."""
import hashlib

import pytest

from fraudflow.llm import catalog
from fraudflow.llm.chat import byte_tokens, chat_windows, read_loss, read_turns, word_tokens
from pyspark.sql import functions as F

from .conftest import SMALL

SCHEMA = "conv_id long, turn long, role string, text string, window long, tok string, rank string, cid string"
CONTROL = "</s>[INST] ok [/INST] <|end|> <|user|> &lt; &amp;lt; &#91; & [ < | |> &#124;"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "t", "r", "c") for r in rows], SCHEMA).repartition(3)


ROWS = ([(1, i, "user" if i % 2 == 0 else "assistant", f"turn {i} " + "word " * (i * 7 % 40)) for i in range(200)]
        + [(2, 0, "system", "be kind " * 10)] + [(2, i, ("user", "assistant")[i % 2], f"say {i} " * 30) for i in range(1, 90)]
        + [(3, 0, "user", None), (3, 1, None, CONTROL), (3, 2, "assistant", CONTROL), (3, 3, "a|>b<&", ""), (3, 4, "assistant", "")]
        + [(4, 5, "assistant", "long " * 3000), (4, 9, "user", "after"), (4, 11, "assistant", "x")]
        + [(5, None, "user", "no turn"), (5, -3, "assistant", "minus"), (5, 10**12, "assistant", "far")]
        + [(6, 1, "assistant", "same"), (6, 1, "assistant", "same"), (6, 1, "user", "same"), (None, 0, "user", "q"), (None, 1, "assistant", "ünï 日本 𝟙")]
        + [(7, 0, "system", "only a system turn")] + [(8, 0, "system", "huge " * 2000), (8, 1, "user", "a"), (8, 2, "assistant", "b")])


def want(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    for k, v in out.items():
        v.sort(key=lambda r: (r[1] if r[1] is not None else -(1 << 62), r[2] or "", r[3] or ""))
        out[k] = [(r[2] or "", r[3] or "") for r in v]
    return out


def read(df):
    """{conv: [(window, n_repeated, turns, loss texts, row)]} in order."""
    out = {}
    cols = df.select("*", read_turns(F.col("text")).alias("turns"), read_loss(F.col("text"), F.col("loss_spans")).alias("loss"))
    for r in sorted(cols.collect(), key=lambda r: r["window"]):
        out.setdefault(r["conv_id"], []).append((r["n_repeated"], [(t["role"], t["text"]) for t in r["turns"]], r["loss"], r))
    return out


@pytest.mark.parametrize("budget,tokens,turns", [(1024, 256, 4), (120, 40, 2), (60, 0, 1), (10, 5, 3)])
@pytest.mark.parametrize("count", [byte_tokens, word_tokens])
def test_round_trip(spark, budget, tokens, turns, count):
    got, expected = read(chat_windows(table(spark, ROWS), budget, tokens, turns, tokens=count)), want(ROWS)
    assert set(got) == set(expected)
    for conv, windows in got.items():
        said = [t for n, ts, _, _ in windows for t in ts[n:]]
        assert said == expected[conv]
        assert [x for _, _, loss, _ in windows for x in loss] == [t for r, t in said if r == "assistant"]
        lead = expected[conv][0][0] == "system"
        for i, (n, ts, _, r) in enumerate(windows):
            assert len(ts) == r["n_turns"] and n <= turns + lead
            if i and lead:
                assert ts[0] == expected[conv][0]
            if n > lead:  # the repeated turns are those just before
                upto = sum(len(w[1]) - w[0] for w in windows[:i])
                assert ts[lead: n] == expected[conv][upto - (n - lead): upto]
            assert r["over_budget"] == (r["tokens"] > budget)
            if r["over_budget"]:
                assert len(ts) - n == 1 or (lead and budget <= 120)


def test_budget_is_kept(spark):
    rows = [r for r in ROWS if r[0] in (1, 2)]
    out = chat_windows(table(spark, rows), 400, 100, 3, tokens=word_tokens).collect()
    assert len(out) > 10 and not any(r["over_budget"] for r in out)
    assert sum(r["tokens"] for r in out) > 0.4 * 400 * len(out)


@pytest.mark.parametrize("kind", ["chinese", "run", "emoji", "english", "control"])
def test_no_window_takes_more_tokens_than_it_says(spark, kind):
    """By a byte-level tokenizer's own count, whatever the script."""
    import random

    import public_tokenizers as P
    import tokenizers

    rng = random.Random(3)
    letters = {"chinese": [chr(c) for c in range(0x4E00, 0x9000, 7)], "run": list("qzxjkvw0189"), "emoji": ["🙂", "👩‍🚀", "𝟙", "é"],
               "english": ["the ", "river ", "is ", "wide, "], "control": list("<|[&>;]")}[kind]
    rows = [(1, i, ("user", "assistant")[i % 2], "".join(rng.choices(letters, k=rng.randint(0, 400 if kind == "chinese" else 120)))) for i in range(60)]
    tk = tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    marks = ["<|user|>", "<|assistant|>", "<|end|>"]
    tk.add_special_tokens([tokenizers.AddedToken(m, normalized=False) for m in marks])
    out = chat_windows(table(spark, rows), budget=3000, history_tokens=400).collect()
    assert len(out) > 1
    for r in out:
        n = len(tk.encode(r["text"], add_special_tokens=False).ids)
        assert n <= r["tokens"] and (n <= 3000 or r["over_budget"])


def test_tokens(spark):
    df = spark.createDataFrame([("Hi, you 2!",), ("",)], "t string").select(word_tokens(F.col("t")).alias("n"))
    assert [r["n"] for r in df.collect()] == [8, 3]


def test_empty_table(spark):
    assert chat_windows(table(spark, [])).collect() == []


def test_registered_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    expected = want(rows)
    got = catalog.QUERIES["op2_chat_formatting"](spark, SMALL).collect()
    assert {r["conv_id"] for r in got} == set(expected)
    for r in got:
        turns = expected[r["conv_id"]]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert r["n_turns"] == len(turns) and r["loss_chars"] == len(loss) and r["formatted_chars"] > len(loss)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
