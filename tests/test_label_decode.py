"""Overlap labels (J3) and span decoding (D1-D4): FIXTURES goldens."""

import pytest

from corpusqa.operators.decode import best_span_per_chunk, best_span_per_question, topk_positions
from corpusqa.operators.label import class_index, overlap_label

LABELS = [
    ((0, 9), (3, 5), ("known", 11, 13)),
    ((0, 9), (4, 4), ("known", 12, 12)),
    ((0, 9), (0, 0), ("unknown", -1, -1)),
    ((0, 9), (9, 12), ("unknown", -1, -1)),
    ((10, 19), (8, 10), ("unknown", -1, -1)),
    ((10, 19), (8, 11), ("known", 8, 9)),
    ((10, 19), (18, 25), ("known", 16, 17)),
    ((10, 19), (5, 30), ("known", 8, 17)),
    ((10, 19), (10, 19), ("known", 8, 17)),
    ((0, 9), (20, 22), ("unknown", -1, -1)),
]


@pytest.mark.parametrize("chunk,answer,expected", LABELS)
def test_overlap_label_goldens(spark, chunk, answer, expected):
    df = spark.createDataFrame([(chunk[0], chunk[1], answer[0], answer[1], 6)],
                               "doc_start int, doc_end int, token_start int, token_end int, question_len int")
    s, e, lab = overlap_label()
    r = df.select(lab.alias("l"), s.alias("s"), e.alias("e")).first()
    assert (r.l, r.s, r.e) == expected


def test_class_index(spark):
    df = spark.createDataFrame([("known",), ("unknown",)], "label string")
    assert [r.c for r in df.select(class_index().alias("c")).collect()] == [0, 1]


def _feature(spark, example_id=1, chunk_idx=0, rank=1, docid=5):
    start = [1, 0, 0, 0, 5, 2, 0, 0, 9, 0]
    end = [0.5, 0, 0, 0, 0, 3, 4, 1, 9, 0]
    return spark.createDataFrame(
        [(example_id, docid, rank, chunk_idx, 0, 2, 8, [float(x) for x in start], [float(x) for x in end])],
        "example_id long, docid long, rank long, chunk_idx int, doc_start int, question_len int, "
        "bert_doc_end int, start_logits array<float>, end_logits array<float>",
    )


def test_span_decoding_top3(spark):
    r = best_span_per_chunk(_feature(spark), k=3).first()
    assert (r.best_start, r.best_end) == (4, 6)
    assert r.best_score == pytest.approx(7.5)
    # passage tokens: doc_start + i - question_len - 2
    assert (0 + r.best_start - 2 - 2, 0 + r.best_end - 2 - 2) == (0, 2)


def test_span_decoding_top1_falls_back(spark):
    r = best_span_per_chunk(_feature(spark), k=1).first()
    assert (r.best_start, r.best_end, r.best_score) == (8, 8, -1000.0)
    w = best_span_per_question(best_span_per_chunk(_feature(spark), k=1)).first()
    assert w.best is None and w.last_docid == 5


def test_topk_ties_by_lower_index(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0, 2.0, 3.0],)], "x array<float>")
    assert df.select(topk_positions("x", 4).alias("t")).first().t == [1, 2, 4, 3]


def test_best_per_question_earliest_wins_ties(spark):
    a = best_span_per_chunk(_feature(spark, chunk_idx=0), k=3)
    b = best_span_per_chunk(_feature(spark, chunk_idx=1, docid=9), k=3)
    c = best_span_per_chunk(_feature(spark, chunk_idx=0, rank=2, docid=11), k=3)
    w = best_span_per_question(a.unionByName(b).unionByName(c)).first()
    assert w.best.docid == 5 and w.best.chunk_idx == 0
    assert w.last_docid == 11          # last feature: rank 2


def test_nan_never_wins(spark):
    nan = float("nan")
    rows = [(1, 5, 1, 0, 0, 2, 8, [1.0, 0, 0, 0, nan, 2.0, 0, 0, 9.0, 0], [0.5, 0, 0, 0, 0, 3.0, nan, 1.0, 9.0, 0])]
    df = spark.createDataFrame(
        [(*r[:7], [float(x) for x in r[7]], [float(x) for x in r[8]]) for r in rows],
        "example_id long, docid long, rank long, chunk_idx int, doc_start int, question_len int, "
        "bert_doc_end int, start_logits array<float>, end_logits array<float>",
    )
    r = best_span_per_chunk(df).first()
    assert r.best_score == r.best_score and (r.best_start, r.best_end) == (5, 7)
    nans = df.selectExpr("* except (start_logits)", f"transform(start_logits, x -> float('nan')) AS start_logits")
    assert best_span_per_question(best_span_per_chunk(nans)).first().best is None
