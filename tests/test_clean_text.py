"""Cleaning, answer location, offsets and Unicode."""

import pytest
from pyspark.sql import functions as F

from corpusqa.functions.text import analyze, char_to_token, char_tokens, clean_text, token_to_char_map
from corpusqa.operators import clean
from corpusqa.operators.clean import answerable, first_passage_per_docid, locate_answers, rejected


def test_blank_removal_keeps_newline_and_ideographic_space(spark):
    df = spark.createDataFrame([("a b\tc\nd　e",)], "t string")
    assert df.select(clean_text("t").alias("c")).first().c == "abc\nd　e"


def test_answer_location_golden(spark):
    passages = spark.createDataFrame([(1, "abcab")], "docid long, passage string")  # 'ab cab' cleaned
    train = spark.createDataFrame(
        [(1, 1, "q", "ab"), (2, 1, "q", "ab"), (3, 1, "q", "bd"), (4, 1, "q", ""), (5, 2, "q", "ab")],
        "id long, docid long, question string, answer string",
    )
    loc = {r.id: (r.start_index, r.end_index) for r in locate_answers(train, passages).collect()}
    assert loc[1] == (0, 2) and loc[2] == (0, 2)
    assert loc[3][0] == -1 and loc[4][0] == -1 and loc[5][0] == -1
    rej = {r.id: r.reason for r in rejected(locate_answers(train, passages)).collect()}
    assert rej == {3: "answer_not_in_passage", 4: "empty_answer", 5: "missing_docid"}
    assert sorted(r.id for r in answerable(locate_answers(train, passages)).collect()) == [1, 2]


@pytest.mark.parametrize("bound", [0, 1_000_000])
def test_first_row_per_docid(spark, monkeypatch, bound):
    monkeypatch.setattr(clean, "BROADCAST_DOCIDS", bound)
    rows = [(i, i % 700 if i % 3 else 1, f"text {i}") for i in range(2000)] + [(3000, None, "no id"), (3001, None, "nor this"), (3002, 9999, None)]
    first = {}
    for ordinal, docid, text in rows:
        first.setdefault(docid, text)
    df = spark.createDataFrame(rows[::-1], "ordinal long, docid long, passage string").repartition(5)
    out = first_passage_per_docid(df)
    assert out.columns == ["docid", "passage"]
    got = [(r.docid, r.passage) for r in out.collect()]
    assert dict(got) == first and len(got) == len(first)
    if bound:  # the texts stay where they are
        assert "hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()
    assert first_passage_per_docid(df.filter("ordinal < 0")).count() == 0


def test_unicode_code_points(spark):
    df = spark.createDataFrame([("a😀b",)], "t string")
    r = df.select(F.instr("t", F.lit("b")).alias("i"), F.length("t").alias("n"), char_tokens("t").alias("k")).first()
    assert r.i - 1 == 2 and r.n == 3 and r.k == ["a", "😀", "b"]


def test_offset_maps(spark):
    text = "Ab\ncD e"
    df = spark.createDataFrame([(text,)], "t string")
    r = df.select(char_tokens("t").alias("k"), token_to_char_map("t").alias("m")).first()
    assert r.k == ["a", "b", "c", "d", "e"]
    assert r.m == [0, 1, 3, 4, 6]
    o2t = [df.select(char_to_token("t", F.lit(i)).alias("x")).first().x for i in range(len(text))]
    assert o2t == [0, 1, 2, 2, 3, 4, 4]                    # tokens before each character
    assert len(r.m) == len(r.k)                            # map length = token count


def test_analyze_words_and_han_bigrams(spark):
    df = spark.createDataFrame([("Héllo,Wörld.今天天气x1",)], "t string")
    assert df.select(analyze("t").alias("a")).first().a == ["héllo", "wörld", "x1", "今天", "天天", "天气"]


def test_strip_accents(spark):
    import unicodedata

    from corpusqa.functions.text import _ACCENTED, _BASE, strip_accents

    df = spark.createDataFrame([("Héllo Ça ñandú Øre",)], "t string")
    assert df.select(strip_accents("t").alias("s")).first().s == "Hello Ca nandu Øre"   # Ø has no decomposition
    assert len(_ACCENTED) == len(_BASE) > 100
    for a, b in zip(_ACCENTED, _BASE):
        assert unicodedata.normalize("NFD", a)[0] == b
