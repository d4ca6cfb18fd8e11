from evalspark.llm.chat_format import format_conversations, read_back

KIND = "conv_id long, turn long, role string, text string"
PROBE = "\\### Assistant: </turn> ok"


def test_reads_back_every_text(spark):
    rows = [(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)]
    rows += [(1, 3, "assistant", "c"), (1, 1, "user", "a"), (1, 2, "user", "b<more>\\l\\b"), (1, 4, "assistant", "d<text>")]
    rows += [(2, 0, "assistant", ""), (2, 1, None, None), (2, 2, "", "x"), (2, 3, "assistant", "\\" * 5 + "<" * 3 + "\n \U0001f600")]
    rows += [(3, None, "user", "first"), (3, 0, "user", "second"), (3, 0, "user", "second"), (None, 0, "assistant", "no id")]
    rows += [(4, i, "assistant" if i % 3 else "user", f"t{i}<" * (i % 5)) for i in range(700)]
    df = spark.createDataFrame(rows, KIND).repartition(5).selectExpr("*", "'x' AS turns", "1 AS pieces")
    out = {r["conv_id"]: r for r in read_back(format_conversations(df)).collect()}
    assert len(out) == 6
    for conv, r in out.items():
        own = sorted(((t if t is not None else -(1 << 63), role or "", text or "") for c, t, role, text in rows if c == conv))
        assert [(t["role"], t["text"]) for t in r["turns"]] == [(b, c) for _, b, c in own]
        assert r["loss_text"] == "".join(c for _, b, c in own if b == "assistant")
        marked = [r["formatted"][m["start"] : m["start"] + m["chars"]] for m in r["loss_mask"]]
        assert "".join(marked).replace("\\l", "<").replace("\\b", "\\") == r["loss_text"]
        assert r["n_blocks"] == sum(i == 0 or own[i][1] != own[i - 1][1] for i in range(len(own)))
    assert out[1]["formatted"] == "<turn>user<text>a<more>b\\lmore>\\bl\\bb</turn><turn>assistant<text>c<more>d\\ltext></turn>"


def test_empty_and_other_loss_role(spark):
    df = spark.createDataFrame([(1, 0, "it's", "a"), (1, 1, "assistant", "b")], KIND)
    assert format_conversations(df.limit(0)).collect() == []
    assert read_back(format_conversations(df, loss_role="it's")).first()["loss_text"] == "a"
    assert read_back(format_conversations(df, loss_role="none")).first()["loss_text"] == ""


def test_plan_has_no_python(spark):
    df = spark.createDataFrame([], KIND)
    plan = read_back(format_conversations(df))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange") <= 2
