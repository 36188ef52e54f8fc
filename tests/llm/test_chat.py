"""Chat formatting: the fold against a plain loop over events, escapes against hostile texts, and odd rows."""

import random

import pytest
from pyspark.sql import functions as F

from quillspark.llm import chat

LOG = "conv_id long, message long, seq long, kind string, role string, text string"


def folded(spark, rows):
    got = chat.fold_events(spark.createDataFrame(rows, LOG)).collect()
    return sorted((r.conv_id, r.message, r.role, r.text) for r in got)


def plain(rows):
    """One event after the other, with every message's state in a dictionary."""
    state = {}
    for conv, message, _, kind, role, text in sorted(set(rows), key=lambda r: r[2]):
        if kind == "regenerate":
            for key in [k for k in state if k[0] == conv and k[1] > message]:
                del state[key]
        entry = state.setdefault((conv, message), {"role": "", "text": "", "gone": False})
        entry["role"] = role if role is not None else entry["role"]
        if kind == "delta":
            entry["text"] += text or ""
        else:
            entry["text"], entry["gone"] = text or "", kind == "delete"
    return sorted((*k, v["role"], v["text"]) for k, v in state.items() if not v["gone"])


@pytest.mark.parametrize("seed", range(3))
def test_fold_equals_a_plain_loop(spark, seed):
    draw = random.Random(seed)
    rows = []
    for conv in range(20):
        for seq in range(draw.randint(1, 40)):
            kind = draw.choice(["open", "delta", "delta", "delta", "edit", "regenerate", "delete"])
            text = None if kind in ("regenerate", "delete") else draw.choice(["a", "bc", "", None, "dé"])
            rows.append((conv, draw.randint(0, 4), seq, kind, draw.choice(["user", "assistant"]) if kind == "open" else None, text))
    rows += draw.sample(rows, 15)  # delivered twice
    draw.shuffle(rows)
    # a delta after a delete of the same message stays deleted in both
    assert folded(spark, rows) == plain(rows)


def test_regenerate_takes_back_later_messages(spark):
    rows = [
        (1, 0, 0, "open", "user", "hi"),
        (1, 1, 1, "open", "assistant", "first"),
        (1, 2, 2, "open", "user", "and?"),
        (1, 1, 3, "regenerate", None, None),
        (1, 1, 4, "delta", None, "sec"),
        (1, 1, 5, "delta", None, "ond"),
        (1, 2, 6, "open", "user", "thanks"),
        (1, 3, 7, "noise", "user", "left out"),
        (1, None, 8, "open", "user", "left out"),
    ]
    assert folded(spark, rows) == [(1, 0, "user", "hi"), (1, 1, "assistant", "second"), (1, 2, "user", "thanks")]


HOSTILE = ["", "\\", "\\\\", "#", "##", "###", "####", "#####", "</turn>", "<</turn>\n", "<\\/turn>", "### user ###\n", " ###\n", "a\n", "\\###", "#\\#", "é</", "😀##", "</turn"]


def test_hostile_texts_come_back(spark):
    rows, want = [], {}
    for i, a in enumerate(HOSTILE):
        for j, b in enumerate(HOSTILE):
            conv = i * 100 + j
            rows += [(conv, 0, "user" + b, a), (conv, 1, "assistant", b + a), (conv, 2, "assistant", a)]
            want[conv] = ([("user" + b, a), ("assistant", b + a), ("assistant", a)], [b + a, a])
    messages = spark.createDataFrame(rows, "conv_id long, message long, role string, text string")
    made = chat.render(messages)
    for r in chat.read_back(made).collect():
        assert ([tuple(t) for t in r.turns], r.loss_texts) == want[r.conv_id]
        assert r.formatted.count("</turn>\n") == 3
    for r in made.collect():  # spans are code points of the whole text
        assert [r.formatted[s.start : s.stop] for s in r.loss] == [r.formatted[s.at :].split(" ###\n", 1)[1].split("</turn>\n")[0] for s in r.loss]


def test_odd_rows(spark):
    schema = "conv_id long, turn long, role string, text string, events int, message int"
    rows = [
        (None, 0, "user", "x", 1, 1),
        (None, 1, "assistant", "y", 1, 1),
        (1, 0, None, None, 1, 1),
        (1, None, "user", "first", 1, 1),
        (2, 0, "assistant", "same", 1, 1),
        (2, 0, "assistant", "same", 1, 1),
        (3, 5, "user", "long " * 50_000, 1, 1),
    ]
    docs = spark.createDataFrame(rows, schema)
    made = chat.read_back(chat.format_conversations(chat.conversation_log(docs)))
    got = {r.conv_id: ([tuple(t) for t in r.turns], r.loss_texts) for r in made.collect()}
    assert got == {
        None: ([("user", "x"), ("assistant", "y")], ["y"]),
        1: ([("user", "first"), ("", "")], []),
        2: ([("assistant", "same")] * 2, ["same"] * 2),
        3: ([("user", "long " * 50_000)], []),
    }
    assert chat.format_digests(chat.conversation_log(docs.limit(0))).count() == 0


def test_no_python_in_tasks(spark, sf_dir):
    log = chat.conversation_log(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    plan = chat.read_back(chat.format_conversations(log))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
    shuffles = plan.split("== Physical Plan ==")[1].count("Exchange hashpartitioning")
    assert shuffles == 1  # everything is dealt by conversation, once


def test_events_tell_the_rows(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    log = chat.conversation_log(rows)
    assert {r.kind for r in log.select("kind").distinct().collect()} == {"open", "delta", "edit", "regenerate"}
    back = chat.fold_events(log).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("message", "role", "text"))).alias("m"))
    want = {}
    for r in sorted(rows.collect(), key=lambda r: (r.conv_id, r.turn)):
        want.setdefault(r.conv_id, []).append((r.role, r.text))
    assert {r.conv_id: [(m.role, m.text) for m in r.m] for r in back.collect()} == want
