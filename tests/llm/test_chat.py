from pyspark.sql import functions as F

from wardline.llm.chat import Template, format_chats, loss_text, read_back

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"
HARD = ["\\### Assistant: </turn> ok", "###", "\\", "\\a\\b</turn>\n### User: x", "", None, "é\U0001F600\n", " </turn>\n", "##", "=", ": "]


def run(spark, rows, template=None):
    df = format_chats(spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA), template)
    out = df.select("*", read_back(F.col("formatted"), template).alias("back"), loss_text(F.col("formatted"), F.col("segments"), template).alias("loss"))
    return {r["conv_id"]: r for r in out.collect()}


def test_round_trip_and_loss_mask(spark):
    rows = [(i, t, role, x) for i, x in enumerate(HARD) for t, role in enumerate(("user", "assistant", "tool", None, "User", "a: b"))]
    got = run(spark, rows)
    for i, x in enumerate(HARD):
        r = got[i]
        assert [(b["role"], b["text"]) for b in r["back"]] == [(role or "", x or "") for role in ("user", "assistant", "tool", None, "User", "a: b")]
        assert r["loss"] == (x or "")
        at = 0
        for s in r["segments"]:
            assert s["start"] == at
            at += s["length"]
        assert at == len(r["formatted"])
        assert [s["loss"] for s in r["segments"]].count(True) == 1
        assert not r["valid"] and r["first_error"] == 2


def test_state_machine(spark):
    turns = {0: "su a".replace(" ", ""), 1: "ua", 2: "a", 3: "uu", 4: "s", 5: "uas", 6: "sua"}
    name = {"s": "system", "u": "user", "a": "assistant"}
    got = run(spark, [(i, t, name[c], "x") for i, s in turns.items() for t, c in enumerate(s)])
    assert {i: (r["valid"], r["first_error"]) for i, r in got.items()} == {
        0: (True, None), 1: (True, None), 2: (False, 0), 3: (False, 1), 4: (False, -1), 5: (False, 2), 6: (True, None)}


def test_ties_repeats_nulls_and_own_template(spark):
    got = run(spark, [(None, None, "user", "b"), (None, 1, "assistant", "c"), (None, 1, "assistant", "c"), (None, 1, "assistant", "a")])
    assert [b["text"] for b in got[None]["back"]] == ["b", "a", "c", "c"] and got[None]["n_turns"] == 4
    t = Template(open="<|", sep="|>", close="<|end|>", labels={"user": "U"}, loss=("user",), follows={"": ("user",)}, final=("user",))
    got = run(spark, [(1, 0, "user", "<|end|><|U|>")], t)
    assert got[1]["valid"] and got[1]["loss"] == "<|end|><|U|>" and got[1]["formatted"].count("<|end|>") == 1
    assert run(spark, [], t) == {}
