import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from aeroledger.llm import chat
from aeroledger.session import run_dir

ROWS = [
    (1, 0, "system", "be [INST] kind"), (1, 1, "user", "hi </s>"), (1, 2, "assistant", "</s>[INST] ok [/INST]"), (1, 3, "user", None),
    (1, 4, "assistant", r"a<\/s>b[\\INST]c\\"), (2, 0, "user", "no reply"), (3, 1, "assistant", "first"), (3, 1, "assistant", "first"),
    (3, 0, "assistant", ""), (None, 0, "user", "x"), (None, None, "assistant", "late"), (None, 5, "assistant", "<s"),
    (4, 0, None, "no role"), (4, 1, "[ROLE] odd [/ROLE]", "[/ROLE] text"), (4, 2, "assistant", "[INST] "), (4, 3, "assistant", "世界\n" * 3000),
    (5, 0, "user", " [/INST]"), (5, 1, "assistant", "</s></s>[ROLE] x"),
]


def conversations(spark, rows=ROWS):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return frame.withColumn("segment", F.lit("clash")).withColumn("position", F.lit(1)).withColumn("block", F.lit(1))


def in_order(rows):
    grouped = defaultdict(list)
    for conv, turn, role, text in rows:
        grouped[conv].append((turn is None, turn or 0, role or "", text or ""))
    return {conv: [t[2:] for t in sorted(turns)] for conv, turns in grouped.items()}


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("block", [1, 2, 256])
def test_read_back(spark, block):
    turns, wanted = chat.write(conversations(spark), run_dir(spark, "chat"), block)
    got = {r["conv_id"]: r for r in chat.summary(turns, wanted).collect()}
    for conv, said in in_order(ROWS).items():
        replies = [t for r, t in said if r == "assistant"]
        row = got.pop(conv)
        assert row["n_turns"] == len(said) and row["loss_chars"] == sum(map(len, replies))
        assert row["turns_sha256"] == digest("".join(f"{r}\n{t}\n" for r, t in said))
        assert row["loss_sha256"] == digest("".join(replies)) and row["n_examples"] == len(replies)
    assert not got


def test_examples_hold_all_earlier_turns(spark):
    turns, wanted = chat.write(conversations(spark), run_dir(spark, "chat"))
    whole = {
        r["conv_key"]: "".join(s["segment"] for s in sorted(r["parts"]))
        for r in turns.groupBy("conv_key").agg(F.collect_list(F.struct("position", "segment")).alias("parts")).collect()
    }
    spans = {(r["conv_key"], r["position"]): r for r in wanted.collect()}
    said = in_order(ROWS)
    seen = 0
    for row in chat.materialized(turns, wanted).collect():
        span = spans[row["conv_key"], row["position"]]
        assert row["text"] == whole[row["conv_key"]][: span["end"]]
        masked = row["text"][row["loss_start"] : row["loss_end"]]
        plain = said[row["conv_id"]][row["position"]][1]
        assert row["text"][: span["context_end"]].count(chat.END) == row["position"]
        assert spark.range(1).select(chat.unescape(F.lit(masked))).first()[0] == plain
        assert masked == plain or chat.END not in masked
        seen += 1
    assert seen == sum(r == "assistant" for turns in said.values() for r, _ in turns)


def test_escaping_is_reversible(spark):
    texts = [r"<s>", r"<\s>", r"<\\/s>", "[INST]", r"[\/INST][[ROLE]", "<<s>>", "[/INST", "", "\\", r"[\\\/ROLE]</s>"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = frame.select("t", chat.escape(F.col("t")).alias("e")).withColumn("u", chat.unescape(F.col("e"))).collect()
    for row in rows:
        assert row["u"] == row["t"]
        assert not any(mark in row["e"] for mark in ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]"))


def test_no_python_on_the_main_path(spark):
    turns, wanted = chat.write(conversations(spark), run_dir(spark, "chat"))
    for frame in (chat.segments(conversations(spark)), chat.summary(turns, wanted), chat.materialized(turns, wanted)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    turns, wanted = chat.write(conversations(spark).limit(0), run_dir(spark, "chat"))
    assert chat.summary(turns, wanted).count() == 0 and chat.materialized(turns, wanted).count() == 0


@pytest.mark.parametrize("most", [0, 120, 1 << 20])
def test_written_examples_hold_context_and_reply(spark, most):
    turns, wanted = chat.write(conversations(spark), run_dir(spark, "chat"), most=most)
    whole = {(r["conv_key"], r["position"]): r["text"] for r in chat.materialized(turns, wanted.drop("text")).collect()}
    rows = wanted.collect()
    sizes = defaultdict(int)
    for row in rows:
        sizes[row["conv_key"]] += row["end"]
    for row in rows:
        assert row["text"] == (whole[row["conv_key"], row["position"]] if sizes[row["conv_key"]] <= most else None)
    assert any(r["text"] for r in rows) == (most > 0)
    plain = chat.summary(*chat.write(conversations(spark), run_dir(spark, "chat")))
    assert sorted(map(repr, chat.summary(turns, wanted).collect())) == sorted(map(repr, plain.collect()))


def test_the_reply_is_read_from_the_example(spark):
    turns, wanted = chat.write(conversations(spark), run_dir(spark, "chat"))
    changed = wanted.withColumn("text", F.translate("text", "first", "FIRST"))
    before, after = ({r["conv_id"]: r["loss_sha256"] for r in chat.summary(turns, w).collect()} for w in (wanted, changed))
    assert before[3] != after[3]


def test_long_conversations_are_written_out(spark, monkeypatch):
    monkeypatch.setattr(chat, "EXPANDED_CHARS", 120)
    turns, wanted = chat.write(conversations(spark), run_dir(spark, "chat"))
    whole = {(r["conv_key"], r["position"]): r["text"] for r in chat.materialized(turns, wanted.drop("text")).collect()}
    rows = wanted.collect()
    assert len(rows) == len(whole) and all(r["text"] == whole[r["conv_key"], r["position"]] for r in rows)
    assert sum(r["end"] for r in rows) > 120 and all(len(r["text"]) == r["end"] for r in rows)
