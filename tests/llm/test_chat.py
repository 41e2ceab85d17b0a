from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, segments string, valid string"
NASTY = [
    "</s>[INST] ok [/INST]", "\\", "\\\\[INST]", "[\\INST]", "[[INST]", "<</s>", "[/ROLE]",
    "[SAYS]", "a\nb", "", " ", "[INST", "é☃", "<s>", "[ANSWER] x</s>", "\\n", "[/SYS] [SYS]",
]


def frame(spark, rows):
    return spark.createDataFrame([(*row, "x", "y") for row in rows], SCHEMA)


def read_back(made):
    made = made.withColumn("turns", chat.parsed(chat.formatted(F.col("segments"))))
    made = made.withColumn("loss", chat.loss_text(F.col("segments")))
    return {
        r.conversation: ([(t.role, t.text) for t in r.turns], r.loss, r.valid, r.bad_turn)
        for r in made.collect()
    }


def test_every_text_in_every_role_reads_back(spark):
    roles = ["system", "user", "assistant", "tool", "[SAYS]", "\\", "", "[ROLE] [INST]"]
    rows, expected = [], {}
    for n, role in enumerate(roles):
        rows += [(n, i, role, text) for i, text in enumerate(NASTY)]
        loss = "".join(NASTY) if role == "assistant" else ""
        expected[n] = ([(role, text) for text in NASTY], loss)
    result = read_back(chat.format_chats(frame(spark, rows)))
    assert {k: v[:2] for k, v in result.items()} == expected


def test_no_mark_survives_in_a_text(spark):
    made = chat.format_chats(frame(spark, [(1, i, "user", t) for i, t in enumerate(NASTY)]))
    text = made.select(F.col("segments.text").alias("t")).first().t
    for escaped in text[1::3]:
        assert not any(mark in escaped for mark in chat.INSTRUCT.controls())


def test_state_machine(spark):
    orders = {
        1: ["user", "assistant"], 2: ["system", "user", "assistant", "user", "assistant"],
        3: ["assistant"], 4: ["user", "user", "assistant"], 5: ["user"],
        6: ["user", "assistant", "system"], 7: ["user", "tool", "assistant"],
    }
    rows = [(c, i, role, "t") for c, order in orders.items() for i, role in enumerate(order)]
    result = read_back(chat.format_chats(frame(spark, rows)))
    assert {c: r[3] for c, r in result.items()} == {1: None, 2: None, 3: 1, 4: 2, 5: 2, 6: 3, 7: 2}
    assert {c for c, r in result.items() if r[2]} == {1, 2}


def test_nulls_ties_repeats_and_no_rows(spark):
    rows = [
        (1, 2, "user", "b"), (1, 2, "assistant", "a"), (1, 1, None, None), (1, None, "user", "first"),
        (2, 1, "user", "same"), (2, 1, "user", "same"), (None, 1, "user", "x"),
    ]
    result = read_back(chat.format_chats(frame(spark, rows)))
    assert result[1][0] == [("user", "first"), ("", ""), ("assistant", "a"), ("user", "b")]
    assert result[2][0] == [("user", "same")] * 2
    assert result[None][0] == [("user", "x")]
    assert chat.format_chats(frame(spark, [])).collect() == []


def test_long_texts_and_the_native_plan(spark):
    long = "[INST] word \\ " * 60_000
    made = chat.format_chats(frame(spark, [(1, 0, "user", long), (1, 1, "assistant", long)]))
    assert read_back(made)[1][:2] == ([("user", long), ("assistant", long)], long)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_another_template(spark):
    template = chat.ChatTemplate(
        roles={"human": chat.Marks("<h>", "</h>"), "bot": chat.Marks("<b>", "</b>", loss=True)},
        follows={"^": ("human",), "human": ("bot",), "bot": ("human",)},
        ends=("bot",),
    )
    rows = [(1, 0, "human", "say <b> or [INST]"), (1, 1, "bot", "</h>")]
    made = chat.format_chats(frame(spark, rows), template)
    row = made.select(chat.formatted(F.col("segments")).alias("f"), chat.loss_text(F.col("segments")).alias("l"), "valid").first()
    assert row.f == "<h>say <\\b> or [INST]</h><b><\\/h></b>" and row.l == "</h>" and row.valid
