from collections import Counter

import pytest

from covtab.llm import quality_rules as Q

SPACES = " \t\n\x0b\x0c\r"


def words(text):
    for c in SPACES:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def plain_counts(text):
    text = text or ""
    w = words(text)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    times = Counter(windows)
    covered = set()
    for i, win in enumerate(windows):
        if times[win] > 1:
            covered.update(range(i, i + 5))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered))


def check(df, rows):
    got = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
           for r in Q.judge(df).collect()]
    want = []
    for i, t in rows:
        c = plain_counts(t)
        want.append((i, *c, c[0] < 10 or 100 * c[4] > 20 * c[0]))
    assert sorted(map(str, got)) == sorted(map(str, want))


CASES = [
    (20, "a b c d e a b c d e f g h"), (21, "x " * 40), (22, "one\ntwo\none\n \n \none"), (23, "a b c d e f g h i j"),
    (24, "#*$%&|<>"), (25, "p q r s t u p q r s t u p q r s t"), (26, "é " * 9 + "\x0b\x0ch\r\nx"),
    (27, "the cat and the dog in the house of that man with " * 1 + "many other words that are not so common here"),
]


def test_counts(table, odd_rows):
    check(table(odd_rows + CASES), odd_rows + CASES)
    check(table(odd_rows + CASES, clashing=True), odd_rows + CASES)


def test_clashing_columns_are_replaced_or_kept(table, odd_rows):
    df = table(odd_rows, clashing=True)
    assert Q.judge(df).count() == len(odd_rows)
    assert Q.keep_good(df).columns == df.columns


def test_empty(table):
    assert Q.judge(table([])).collect() == [] and Q.keep_good(table([])).collect() == []


def test_rules(table):
    good = ("The old house stood on the hill and it was for many years the home of a man who had been to sea. "
            "He said that they would come back in the spring, but no one of them was seen there again.")
    rows = [(1, good), (2, good.upper()), (3, " ".join(f"{w}###" for w in good.split())),
            (4, " ".join(f"zq{k}x" for k in range(40))), (5, good + "\n- a line...\n" * 3), (6, "short text"), (7, None)]
    got = {r.doc_id: (r.kept, set(r.failed_rules)) for r in Q.judge(table(rows)).collect()}
    assert got[1] == (True, set())
    assert got[2][1] == {"upper_words"} and got[3][1] == {"symbols", "stop_words"} and got[4][1] == {"stop_words"}
    assert not got[6][0] and not got[7][0]
    assert {r.doc_id for r in Q.keep_good(table(rows)).collect()} == {i for i, (kept, _) in got.items() if kept}


def test_labelled_documents(spark):
    """Good documents that pass the base rule stay, most bad ones go."""
    sf = "/root/testdata/sf0.01"
    try:
        docs = spark.read.parquet(f"{sf}/documents.parquet")
    except Exception:
        pytest.skip("test data not present")
    judged = Q.judge(docs).select("doc_id", "kept", "base_failed").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    rows = judged.where("NOT base_failed").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in judged.where("quality = 0").collect()]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.25 * len(bad)


def test_native_plan(table):
    plan = Q.judge(table([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Python" not in plan and "Arrow" not in plan


def test_languages_without_a_list_and_any_length(spark):
    from tests.llm.conftest import SCHEMA

    russian = ("Старый дом стоял на холме и много лет был домом человека который когда-то ходил в море он говорил что они вернутся "
               "весной однако никто из них больше никогда здесь не появился и соседи скоро забыли его имя навсегда")
    odd = " ".join(f"zq{k}x" for k in range(40))
    rows = [(1, russian, "ru"), (2, russian, None), (3, odd, "en"), (4, odd, "EN-gb"), (5, odd, "fi"), (6, odd, "")]
    df = spark.createDataFrame([(i, t, lang, "s", len(t)) for i, t, lang in rows], SCHEMA)
    got = {r.doc_id: (r.kept, r.failed_rules) for r in Q.judge(df).collect()}
    assert all(got[k] == (True, []) for k in (1, 2, 5, 6)) and all(got[k] == (False, ["stop_words"]) for k in (3, 4))
    assert {r.doc_id for r in Q.keep_good(df).collect()} == {1, 2, 5, 6}
    assert {r.doc_id for r in Q.keep_good(df.drop("lang")).collect()} == {1, 2, 3, 4, 5, 6}
    counts = spark.range(1).selectExpr("10000000000000L AS n_words", "1L AS one")
    assert counts.select(Q.rule_failed(Q.RULES[0])).first()[0] is False
