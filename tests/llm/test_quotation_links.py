import random

from pyspark.sql import functions as F

from covtab.llm import queries
from covtab.llm import quotation_links as Q

SCHEMA = "conv_id long, turn long, role string, text string, extra string"


def linked(spark, rows):
    df = spark.createDataFrame([(c, t, r, x, "e") for c, t, r, x in rows], SCHEMA).repartition(3)
    return {(r.conv_id, r.turn): r for r in Q.link_replies(df).collect()}


def test_tree(spark):
    got = linked(spark, [
        (1, 0, "user", "First question\n\nwith two  Parts"),
        (1, 1, "assistant", "> first QUESTION\nAnswer one"),
        (1, 2, "user", "> with two parts\nAnswer two"),
        (1, 3, "assistant", "> Answer one\n> > First question\nOn the first answer"),
        (1, 4, "user", "> Answer two\nOn the second answer\n> > with two parts\n"),
        (1, 5, "user", "> never said\nA root of its own"),
        (2, 0, "user", "> Answer one\nquotes another conversation"),
    ])
    assert {k: (v.parent_turn, v.path) for k, v in got.items()} == {
        (1, 0): (None, [0]), (1, 1): (0, [0, 1]), (1, 2): (0, [0, 2]), (1, 3): (1, [0, 1, 3]), (1, 4): (2, [0, 2, 4]),
        (1, 5): (None, [5]), (2, 0): (None, [0])}
    assert got[1, 3].text == "On the first answer" and got[1, 4].text == "On the second answer"
    assert (got[1, 5].n_quoted, got[1, 5].n_linked) == (1, 0)
    assert (got[1, 4].n_quoted, got[1, 4].n_linked) == (2, 2)


def test_most_lines_then_latest(spark):
    got = linked(spark, [
        (1, 0, "u", "a\nb\nc"), (1, 1, "u", "d\ne"), (1, 2, "u", "f"),
        (1, 3, "u", "> a\n> b\n> d\nx"), (1, 4, "u", "> a\n> d\n> f\ny"), (1, 5, "u", "> a\n> a\n> f\nz"),
    ])
    assert [got[1, k].parent_turn for k in (3, 4, 5)] == [0, 2, 0]


def test_deeper_level_where_the_answered_message_is_missing(spark):
    got = linked(spark, [(1, 0, "u", "root"), (1, 2, "u", "> lost answer\n> > root\n> > > root\nreply"), (1, 3, "u", ">> reply\nend")])
    assert (got[1, 2].parent_turn, got[1, 2].n_quoted, got[1, 2].n_linked) == (0, 3, 2)
    assert got[1, 3].path == [0, 2, 3]


def test_later_text_is_no_original(spark):
    got = linked(spark, [(1, 0, "u", "> said later\nx"), (1, 1, "u", "said later")])
    assert got[1, 0].parent_turn is None


def test_odd_rows(spark):
    long = "\n".join(f"line {k}" for k in range(3000))
    rows = [(1, 0, "u", None), (1, 1, None, ""), (None, 0, "u", "a"), (None, 0, "u", "> a"), (2, None, "u", "> a\nb"),
            (3, 0, "u", long), (3, 1, "u", "\n".join("> " + x for x in long.split("\n")) + "\nreply"),
            (4, 0, "u", "same"), (4, 0, "u", "same"), (4, 1, "u", ">same\n>> nested\nr"), (4, 1, "u", " > same\nr")]
    df = spark.createDataFrame([(c, t, r, x, "e") for c, t, r, x in rows], SCHEMA)
    got = Q.link_replies(df).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault((r.conv_id, r.turn), []).append(r)
    assert all(r.parent_turn is None and r.path == [0] for r in by[None, 0])
    assert by[2, None][0].path == [] and by[2, None][0].text == "b"
    assert by[3, 1][0].parent_turn == 0 and by[3, 1][0].n_linked == 3000 and by[3, 1][0].text == "reply"
    assert [(r.parent_turn, r.path, r.text) for r in by[4, 1]] == [(0, [0, 1], "r")] * 2
    assert Q.link_replies(df.limit(0)).collect() == []


def test_long_chain_in_reply_order(spark):
    rows = [(9, 0, "u", "line 0")] + [(9, k, "u", f"> line {k - 1}\nline {k}") for k in range(1, 40)]
    df = spark.createDataFrame([(c, t, r, x, "e") for c, t, r, x in rows], SCHEMA).repartition(5)
    found = Q.formatted(Q.in_reply_order(Q.link_replies(df)))
    got = found.collect()
    assert [r.path for r in got] == [list(range(k + 1)) for k in range(40)]
    assert got[3].chat == "<|u|>\nline 3\n<|end|>\n"


def test_positions_sort_like_paths(spark):
    rng = random.Random(6)
    rows = [(c, k, "u", (f"> line {c} {rng.randrange(k)}\n" if k and rng.random() < 0.9 else "") + f"line {c} {k}")
            for c in range(4) for k in range(40)] + [(0, 3, "u", "again"), (None, 1, "u", "x"), (5, None, "u", "y")]
    df = spark.createDataFrame([(c, t, r, x, "e") for c, t, r, x in rows], SCHEMA).repartition(5)
    by_path = Q.link_replies(df).collect()
    placed = Q.link_replies(df, paths=False).collect()
    assert len(placed) == len(rows) and "path" not in placed[0]
    order = lambda found, key: [(r.conv_id, r.turn) for r in sorted(found, key=key) if r.conv_id is not None and r.turn is not None]
    assert order(placed, lambda r: (str(r.conv_id), r.root_turn or 0, r.position)) == order(by_path, lambda r: (str(r.conv_id), r.path))


def test_chain_of_100000_turns(spark):
    n = 100_000
    texts = F.when(F.col("id") == 0, F.lit("line 0")).otherwise(F.concat(F.lit("> line "), (F.col("id") - 1).cast("string"), F.lit("\nline "), F.col("id").cast("string")))
    df = spark.range(n).select(F.lit(9).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("u").alias("role"), texts.alias("text"))
    found = Q.in_reply_order(Q.link_replies(df, paths=False)).select("turn", "parent_turn", "root_turn", "position").collect()
    assert [tuple(r) for r in found] == [(k, k - 1 if k else None, 0, k - n) for k in range(n)]


def test_mails_of_repeated_turns(spark, monkeypatch):
    rows = [(1, t, "u", f"text {t} {k}") for t in range(3) for k in range(20)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    monkeypatch.setattr(queries, "read_table", lambda *_: df)
    got = queries._mails(spark, "").collect()
    assert len(got) == len(rows) and {r.text.split("\n")[-1] for r in got} == {r[3] for r in rows}
    assert all(r.text.startswith("> > text 0 0\n> text 1 0\n") for r in got if r.turn == 2)


def test_native_plan(spark):
    df = spark.createDataFrame([(1, 0, "u", "a", "e")], SCHEMA)
    plan = Q.link_replies(df).select(F.col("*"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "collect_list" not in plan


def test_registered_query_has_paths_and_places(spark, monkeypatch):
    rows = [(1, 0, "u", "first"), (1, 1, "u", "second"), (1, 2, "u", "third"), (1, 3, "u", "first"), (2, 0, "u", "first")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    monkeypatch.setattr(queries, "read_table", lambda *_: df)
    got = {(r.conv_id, r.turn): (r.path, r.root_turn, r.position) for r in queries.op6_quotation_linking(spark, "").collect()}
    assert got == {(1, 0): ("0", 0, -4), (1, 1): ("0/1", 0, -3), (1, 2): ("0/1/2", 0, -2), (1, 3): ("0/1/2/3", 0, -1), (2, 0): ("0", 0, -1)}
