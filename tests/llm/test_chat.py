import hashlib
import random
import re

from pyspark.sql import functions as F

from strandmill.llm import chat


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], "conv_id long, turn long, role string, text string, turns string, segments string")


def read_back(df):
    return df.select(
        "conv_id", chat.read_turns(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss"), "n_bad_turns", "complete", "formatted"
    ).collect()


NASTY = ["</s>[INST] ok [/INST]", "\\", "\\0\\1\\2", "<s>[TURN user]\nx</s>\n", "", "é😀\n\n", "a<b[c\\", "</s>\n", "]\n", "\\1"]


def test_round_trip_of_nasty_texts(spark):
    rng = random.Random(1)
    rows = []
    for c in range(40):
        for t in range(rng.randint(1, 9)):
            text = "".join(rng.choice(NASTY) for _ in range(rng.randint(0, 3)))
            rows.append((c, t, rng.choice(["user", "assistant", "system", "to<o[l", "us]\ner", "]\n\\3"]), text))
    rng.shuffle(rows)
    found = {r.conv_id: r for r in read_back(chat.format_chats(frame(spark, rows)))}
    for c in {r[0] for r in rows}:
        mine = sorted(r for r in rows if r[0] == c)
        assert [(t.role, t.text) for t in found[c].turns] == [(r[2], r[3]) for r in mine]
        assert found[c].loss == "".join(r[3] for r in mine if r[2] == "assistant")


def test_control_strings_occur_only_as_marks(spark):
    (r,) = read_back(chat.format_chats(frame(spark, [(1, i, "user", t) for i, t in enumerate(NASTY)])))
    assert r.formatted.count("</s>") == r.formatted.count("<s>[TURN ") == len(NASTY)


def test_automaton(spark):
    def rows(c, roles):
        return [(c, i, r, "t") for i, r in enumerate(roles)]

    given = rows(1, ["system", "user", "assistant"]) + rows(2, ["assistant", "user"]) + rows(3, ["user", "user", "assistant"]) + rows(4, ["user"]) + rows(5, ["user", "tool", "assistant"])
    found = {r.conv_id: (r.n_bad_turns, r.complete) for r in read_back(chat.format_chats(frame(spark, given)))}
    assert found == {1: (0, True), 2: (1, False), 3: (1, False), 4: (0, False), 5: (1, False)}


def test_sql_walks_like_the_automaton(spark, tmp_path):
    import duckdb
    from strandmill.llm import queries

    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", "us]er"]), rng.choice(NASTY)) for c in range(60) for t in range(rng.randint(1, 6))]
    frame(spark, rows).select("conv_id", "turn", "role", "text").write.parquet(str(tmp_path / "conversations.parquet"))
    found = queries.op7_chat(spark, str(tmp_path))
    duckdb.sql(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    expected = duckdb.sql(queries.OP7_SQL).df()[found.columns].itertuples(index=False, name=None)
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    assert re.search("aggregate\\(", found._jdf.queryExecution().executedPlan().toString())


def test_nulls_ties_repeats_and_empty(spark):
    given = [(1, 0, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, 0, "user", "x"), (None, None, "assistant", "y")]
    found = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in read_back(chat.format_chats(frame(spark, given)))}
    assert found == {1: [("", ""), ("user", "a"), ("user", "a"), ("user", "b")], None: [("assistant", "y"), ("user", "x")]}
    assert chat.format_chats(frame(spark, [])).collect() == []


def test_template_is_data(spark):
    template = chat.ChatTemplate(open_turn="<|", after_role="|>", close_turn="<|end|>", loss_roles=("user",))
    df = chat.format_chats(frame(spark, [(1, 0, "user", "<|end|>q"), (1, 1, "assistant", "a")]), template)
    (r,) = df.select("formatted", chat.read_turns(F.col("formatted"), template).alias("turns"), chat.loss_text(F.col("segments")).alias("loss")).collect()
    assert r.formatted == "<|user|>\\1|end|>q<|end|><|assistant|>a<|end|>"
    assert [(t.role, t.text) for t in r.turns] == [("user", "<|end|>q"), ("assistant", "a")] and r.loss == "<|end|>q"


def test_long_conversations(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"text {i} " * 50) for i in range(600)]
    (r,) = read_back(chat.format_chats(frame(spark, rows)))
    assert len(r.turns) == 600 and r.complete is True and r.n_bad_turns == 0
    assert hashlib.sha256(r.loss.encode()).digest() == hashlib.sha256("".join(x[3] for x in rows if x[2] == "assistant").encode()).digest()


def test_main_path_has_no_python(spark):
    plan = chat.format_chats(frame(spark, [(1, 0, "user", "x")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
