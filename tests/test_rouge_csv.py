"""ROUGE-L (A3, A4) and CSV round trip."""


import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusqa.operators.metrics import lcs_length, rouge_l, rouge_l_f
from corpusqa.schemas import PASSAGES
from corpusqa.session import scratch_path
from corpusqa.sources.csv_io import read_table, write_table


def lcs_dp(a, b):
    prev = [0] * (len(b) + 1)
    for x in a:
        cur = [0]
        for j, y in enumerate(b):
            cur.append(prev[j] + 1 if x == y else max(prev[j + 1], cur[j]))
        prev = cur
    return prev[-1]


def test_rouge_golden():
    assert lcs_length("ABCBDAB", "BDCABA") == 4
    assert rouge_l_f("ABCBDAB", "BDCABA") == pytest.approx(8 / 13, abs=1e-6)
    assert rouge_l_f("", "abc") == 0.0
    assert rouge_l_f("a b c", "abc") == pytest.approx(1.0)   # whitespace is not a token


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcd疫情 ", max_size=40), st.text(alphabet="abcd疫情 ", max_size=40))
def test_lcs_matches_dynamic_programming(a, b):
    assert lcs_length(a, b) == lcs_dp(a, b)
    assert rouge_l_f(a, b) == pytest.approx(rouge_l_f(b, a))


def test_rouge_udf(spark):
    df = spark.createDataFrame([(1, "ABCBDAB", "BDCABA"), (2, "疫情", "疫情")], "example_id long, prediction string, label string")
    got = {r.example_id: r.rouge_l_f for r in rouge_l(df).collect()}
    assert got[1] == pytest.approx(8 / 13) and got[2] == pytest.approx(1.0)


def test_csv_round_trip(spark):
    values = ['  lead "q", x\ny  ', "a\r\nb", None, 'back\\slash"', "NA", "", "\nstarts with newline"]
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], PASSAGES)
    path = scratch_path(spark, "rt")
    write_table(df, path)
    back = {r.docid: r.passage for r in read_table(spark, path, PASSAGES).collect()}
    for i, v in enumerate(values):
        assert back[str(i)] == v


def test_tsv_round_trip(spark):
    from corpusqa.schemas import TRAIN_RAW
    rows = [("1", "7", "what\tis", 'say "x"'), ("2", "8", "NA", "multi\nline")]
    df = spark.createDataFrame(rows, TRAIN_RAW)
    path = scratch_path(spark, "tsv")
    write_table(df, path, sep="\t")
    assert sorted(read_table(spark, path, TRAIN_RAW, sep="\t").collect()) == sorted(df.collect())


def test_best_eval_predictions_sink(spark):
    from corpusqa.operators.metrics import best_eval_run
    from corpusqa.sources.csv_io import write_best_eval_predictions
    from corpusqa.schemas import PREDICTIONS_EVAL
    from pyspark.sql import types as T

    log = spark.createDataFrame(
        [("r", "dev.csv", 50, 1.0, 0.5), ("r", "dev.csv", 100, 0.9, 0.7), ("r", "train.csv", 150, 0.8, 0.9),
         ("r", "dev.csv", 200, 0.7, 0.7)],
        "run string, file string, global_step long, loss double, eval_accuracy double")
    best = best_eval_run(log)
    assert [(r.run, r.global_step) for r in best.collect()] == [("r", 100)]   # first of the ties, dev only
    preds = spark.createDataFrame(
        [("r", 50, "1", "a", "b"), ("r", 100, "1", "c", "d"), ("r", 200, "1", "e", "f")],
        "run string, global_step long, example_id string, prediction string, label string")
    path = scratch_path(spark, "best-preds")
    write_best_eval_predictions(preds, best, path)
    schema = T.StructType([T.StructField("run", T.StringType())] + PREDICTIONS_EVAL.fields)
    rows = read_table(spark, path, schema).collect()
    assert [(r.example_id, r.prediction) for r in rows] == [("1", "c")]
