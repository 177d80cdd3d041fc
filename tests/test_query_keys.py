"""Canonical query keys: stop lists from a text, phrases, word forms, synonyms, analyser tokens."""

import pytest
from featuremill.functions import text
from pyspark.sql import functions as F


def keys(spark, queries, *args, **kw):
    df = spark.createDataFrame([(i, q) for i, q in enumerate(queries)], "i int, q string")
    plan = df.select("i", text.canonical_query_key(F.col("q"), *args, **kw).alias("k"))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
    return [r.k for r in plan.orderBy("i").collect()]


def test_stop_list_text(spark, tmp_path):
    path = tmp_path / "stop.txt"
    path.write_text("# comment\n\nдля\n  И  \n\t\n#eng\neng arzon\neng\n", encoding="utf-8")
    assert text.read_stop_list(spark, str(path)) == ["для", "и", "eng arzon", "eng"] == text.stop_list(path.read_text("utf-8").splitlines())


def test_stop_words_on_word_boundaries_and_phrases_first(spark):
    stop = ["для", "и", "aksiya", "aksiya tavarlar", "eng", "eng arzon", "eng arzon narsalar"]
    made = keys(spark, ["Красные КРОССОВКИ для бега", "подля", "aksiya tavarlar krossovka", "eng arzon narsalar telefon", "для и", None], stop)
    assert made == ["бега красные кроссовки", "подля", "krossovka", "telefon", None, None]
    assert keys(spark, ["  Красные   КРОССОВКИ "]) == ["красные кроссовки"]


def test_word_forms_do_not_matter(spark):
    suffixes = ["ые", "ый", "ая", "и", "ок", "а", "s", "es", "ses"]
    made = keys(spark, ["красные кроссовки", "КРОССОВКИ красный", "красная кроссовка", "dresses", "glasses", "as", "s"], (), suffixes)
    assert made[0] == made[1] == made[2] == "красн кроссовк"
    # The longest suffix that leaves three letters goes; shorter words stay.
    assert made[3:] == ["dres", "glas", "as", "s"]
    assert keys(spark, ["c++ c.", "abc.", "abcx"], (), ["."]) == ["c++ c.", "abc", "abcx"]


def test_synonyms_share_a_key(spark):
    groups = text.synonym_groups([["кроссовк", "Кед"], ["phone", "telefon", "smartfon"]])
    assert groups["кроссовк"] == "кед" and groups["telefon"] == "phone"
    made = keys(spark, ["кроссовки telefon", "smartfon кеды", "кеда"], (), ["и", "ы", "а"], groups)
    assert made == ["phone кед", "phone кед", "кед"]
    with pytest.raises(ValueError, match="two groups"):
        text.synonym_groups([["a", "b"], ["b", "c"]])


def test_analyser_tokens(spark):
    rows = [
        (1, [(0, "красн"), (0, "красн"), (1, "кроссовк"), (1, "кед")]), (2, [(7, "b"), (3, "a")]), (3, []), (4, None), (5, [(None, "x"), (1, None)]), (6, [(0, "a"), (1, "a")]),
    ]
    df = spark.createDataFrame(rows, "i int, t array<struct<position: int, token: string>>")
    made = {r.i: r.k for r in df.select("i", text.canonical_key_of_tokens(F.col("t")).alias("k")).collect()}
    assert made == {1: "кед красн", 2: "a b", 3: None, 4: None, 5: None, 6: "a a"}
