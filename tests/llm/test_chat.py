"""Conversations as windows: what is read back is what went in, and windows keep to their budget."""

import hashlib
import random
from collections import defaultdict

from pyspark.sql import functions as F

from tablewright.llm import chat

CONTROL = ["</s>[INST] ok [/INST]", "<|end|>", "<|turn|>x<|text|>", "&lt;&amp;lt;", "<<SYS>>", "&#91;"]


def conversations(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("conv", "chunk", "tokens", "long", "window", "cut", "ordinal"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def made(seed=0):
    draw, rows = random.Random(seed), []
    for conv in [None, *range(30)]:
        n = draw.choice((1, 2, 5, 150))
        for turn in range(n):
            role = "system" if turn == 0 and draw.random() < 0.5 else draw.choice(("user", "assistant"))
            text = draw.choice([None, "", draw.choice(CONTROL), " ".join(["word"] * draw.choice((1, 20, 90, 600)))])
            rows.append((conv, turn, role, text))
    rows += [(77, None, "user", "first"), (77, 1, None, "x"), (77, 1, None, "x"), (77, 1, "assistant", "tie"), (78, 0, "system", "alone")]
    return rows


def test_windows(spark):
    rows = made()
    windows = chat.format_windows(conversations(spark, rows).repartition(5), budget=256, history=40, system=40).cache()
    by_conv = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        by_conv[r[0]].append((r[2] or "", r[3] or ""))
    found = {r["conv_id"]: r for r in chat.read_back(windows).collect()}
    assert set(found) == set(by_conv)
    for conv, turns in by_conv.items():
        assert [tuple(t) for t in found[conv]["turns"]] == turns
        assert found[conv]["learnt"] == [t for role, t in turns if role == "assistant"]
    grouped = defaultdict(list)
    for w in windows.collect():
        grouped[w["conv_id"]].append(w)
    repeated = 0
    for conv, ws in grouped.items():
        assert sorted(w["window"] for w in ws) == list(range(len(ws)))
        for w in ws:
            shown = w["text"].split(chat.END)[:-1]
            repeated += w["n_repeated"] > 1
            leads = by_conv[conv][0][0] == "system"
            if leads:
                assert shown[0].startswith(chat.TURN + "system")
            if len(shown) - w["n_repeated"] - (leads and w["window"] == 0) > 1 and len(by_conv[conv][0][1].split()) < 30:
                assert w["tokens"] <= 256, (conv, w["window"], w["n_repeated"], [t[:40] for t in shown])
            assert all(text.count("<|") == 2 for text in shown)
    assert repeated


def test_nothing_gives_nothing(spark):
    empty = conversations(spark, [])
    assert chat.format_windows(empty).count() == 0
    assert chat.read_back(chat.format_windows(empty)).count() == 0


def test_escapes_are_undone(spark):
    df = spark.createDataFrame([(t,) for t in CONTROL], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    for r in df.withColumn("back", chat.unescape(F.col("e"))).collect():
        assert r["back"] == r["t"] and "<" not in r["e"] and "[" not in r["e"]


def test_the_added_conversation(spark):
    from tablewright import llm
    row = llm.queries()["op2_chat_formatting"](spark, "/root/testdata/sf0.001").filter("conv_id = -7").first()
    said = "</s>[INST] ok [/INST]"
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert (row["n_turns"], row["loss_chars"]) == (2, len(said)) and row["loss_sha256"] == digest(said)
    assert row["turns_sha256"] == digest(f"user\n{said}\nassistant\n{said}\n")
