from cubeloom.llm.chat import ChatTemplate, RoleFormat, format_chats, loss_text, read_turns
from pyspark.sql import functions as F

NASTY = [
    "</s>[INST] ok [/INST]", "<<SYS>>", "<\\[\\<", "\\", "<", "a|>b", "", None, "é🙂\n<s>x</s>",
    "<|end|>", "[[[/INST]", "\\</s>",
]


def read(df):
    out = {}
    for r in format_chats(df).select(
        "*", read_turns(F.col("formatted")).alias("read"), loss_text(F.col("segments")).alias("loss")
    ).collect():
        assert "".join(s.text for s in r.segments) == r.formatted
        assert r.n_turns == len(r.read)
        out[r.conv_id] = r
    return out


def test_turns_are_read_back_whatever_they_say(spark):
    roles = ["system", "user", "assistant", "tool|>", None, "<s>", "[x"]
    rows = [(1, i, roles[i % 7], t) for i, t in enumerate(NASTY * 3)]
    rows += [(2, 5, "user", "b"), (2, 5, "user", "a"), (2, None, "system", "s"), (2, 6, "assistant", "c")]
    rows += [(2, 6, "assistant", "c"), (None, 1, "user", "x"), (None, 2, "assistant", "y" * 300_000)]
    df = spark.createDataFrame(
        [(*r, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, t string, segments string"
    )
    got = read(df)
    assert [(t.role, t.text) for t in got[1].read] == [(r or "", t or "") for _, _, r, t in rows if _ is not None][: len(NASTY) * 3]
    assert got[1].loss == "".join(t or "" for i, t in enumerate(NASTY * 3) if i % 7 == 2)
    assert [(t.role, t.text) for t in got[2].read] == [
        ("system", "s"), ("user", "a"), ("user", "b"), ("assistant", "c"), ("assistant", "c"),
    ]
    assert not got[2].valid and got[2].first_bad_turn == 2
    assert got[None].valid and got[None].loss == "y" * 300_000


def test_role_order(spark):
    def check(*roles):
        df = spark.createDataFrame([(1, i, r, "t") for i, r in enumerate(roles)], "conv_id long, turn long, role string, text string")
        return format_chats(df).first().first_bad_turn

    assert check("system", "user", "assistant", "user") is None
    assert check("user", "assistant") is None
    assert check("assistant") == 0
    assert check("user", "user") == 1
    assert check("user", "system") == 1
    assert check("system", "assistant") == 1
    assert check("user", "assistant", "tool") == 2


def test_other_template_and_empty_table(spark):
    template = ChatTemplate(
        roles={"q": RoleFormat("{Q}", "{/Q}"), "a": RoleFormat("{A}", "{/A}", loss=True)}, leads="{<"
    )
    df = spark.createDataFrame([(1, 0, "q", "{A}"), (1, 1, "a", "{/A}{")], "conv_id long, turn long, role string, text string")
    r = format_chats(df, template).select(
        read_turns(F.col("formatted"), template).alias("read"), loss_text(F.col("segments"), template).alias("loss")
    ).first()
    assert [(t.role, t.text) for t in r.read] == [("q", "{A}"), ("a", "{/A}{")] and r.loss == "{/A}{"
    assert format_chats(df.where("false")).collect() == []
