"""Span decoding: top-k positions, candidate spans, best span per chunk and
per question, answer text and prediction rows (D1-D8, P7, P8, J4, J5).

Per-chunk work (D1-D3) is in-row array code; per-question selection (D4, D5)
is a single grouped aggregation with partial (map-side) aggregation, so a
question with very many chunks is combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusqa.functions.arrays import let
from corpusqa.functions.text import sub_token_to_char_map, token_to_char_map
from corpusqa.operators.clean import passages_of

# Fixed values of the reference: span top-k, score of an invalid span, the
# no-answer threshold and the fallback answer text.
SPAN_TOP_K = 10
INVALID_SCORE = -1000.0
NO_ANSWER_THRESHOLD = 0.0
FALLBACK_ANSWER = "疫情"


def topk_positions(col, k: int = SPAN_TOP_K) -> Column:
    """Indices of the k largest values, largest first, ties by lower index."""
    c = F.col(col) if isinstance(col, str) else col
    keyed = F.transform(c, lambda v, i: F.struct((-v).alias("nv"), i.alias("i")))
    # sort_array: array_sort would call a comparing expression for each pair
    return F.transform(F.slice(F.sort_array(keyed), 1, k), lambda x: x["i"])


def is_valid_span(s, e, q, bert_doc_end) -> Column:
    """End after start, both inside the document part of the sequence."""
    return (
        (e - s >= 1)
        & (s >= q + 2) & (s < bert_doc_end - 1)
        & (e > q + 2) & (e <= bert_doc_end - 1)
    )


def span_candidates(start_col="start_logits", end_col="end_logits", q_col="question_len",
                    bde_col="bert_doc_end", k: int = SPAN_TOP_K) -> Column:
    """J4 + D2: all (s, e) pairs from the two top-k lists, start-major, with
    score ``(start[s] + end[e]) - (start[0] + end[0])`` in single precision,
    or -1000 for an invalid pair. Both top-k lists are computed once per row
    (``let``), not once per candidate."""
    st, en = F.col(start_col), F.col(end_col)
    q, bde = F.col(q_col), F.col(bde_col)
    cls = F.element_at(st, 1) + F.element_at(en, 1)
    tops = F.struct(topk_positions(st, k).alias("s"), topk_positions(en, k).alias("e"))

    def pair(s, e):
        total = (F.element_at(st, s + 1) + F.element_at(en, e + 1)) - cls
        # NaN is greater than everything in Spark, but no score
        score = F.when(is_valid_span(s, e, q, bde) & ~F.isnan(total), total).otherwise(F.lit(INVALID_SCORE).cast("float"))
        return F.struct(s.alias("s"), e.alias("e"), score.cast("float").alias("score"))

    return let(tops, lambda t: F.flatten(F.transform(t["s"], lambda s: F.transform(t["e"], lambda e: pair(s, e)))))


def best_span_per_chunk(features: DataFrame, k: int = SPAN_TOP_K) -> DataFrame:
    """D3: first maximum over the candidates of each feature row."""
    cands = span_candidates(k=k)
    best = F.array_max(
        F.transform(cands, lambda c, j: F.struct(c["score"].alias("score"), (-j).alias("neg_ord"),
                                                 c["s"].alias("s"), c["e"].alias("e")))
    )
    return (
        features.withColumn("_best", best)
        .withColumn("best_score", F.col("_best.score"))
        .withColumn("best_start", F.col("_best.s"))
        .withColumn("best_end", F.col("_best.e"))
        .drop("_best")
    )


def best_span_per_question(chunk_best: DataFrame, order_cols=("rank", "chunk_idx"),
                           threshold: float = NO_ANSWER_THRESHOLD) -> DataFrame:
    """D4 + D5 in one aggregation per ``example_id``.

    ``best``: the highest scoring feature with score > threshold, earliest
    feature (by ``order_cols``) on ties -- the reference's strict ``<`` update.
    ``last_docid``: docid of the example's last feature (used by the fallback).
    """
    order_cols = [c for c in order_cols if c in chunk_best.columns]
    neg = [(-F.col(c)).alias("neg_" + c) for c in order_cols]
    payload = [F.col(c) for c in ("docid", "chunk_idx", "doc_start", "question_len", "best_start",
                                  "best_end") if c in chunk_best.columns]
    cand = F.when((F.col("best_score") > F.lit(threshold)) & ~F.isnan("best_score"),
                  F.struct(F.col("best_score").alias("score"), *neg, *payload))
    return chunk_best.groupBy("example_id").agg(
        F.max(cand).alias("best"),
        F.max_by("docid", F.struct(*[F.col(c) for c in order_cols])).alias("last_docid"),
        F.count(F.lit(1)).alias("n_features"),
    )


def _with_answer(winners: DataFrame, passages: DataFrame, pieces=None) -> DataFrame:
    """Winners left-joined to the passage of their best span, with the
    answer columns; rows without a span keep nulls. One reference to
    ``winners`` so the decode plan runs once, and one map of a passage's tokens."""
    w = winners.select(
        "*",
        F.col("best.docid").alias("_docid"),
        (F.col("best.doc_start") + F.col("best.best_start") - F.col("best.question_len") - 2).alias("tok_start"),
        (F.col("best.doc_start") + F.col("best.best_end") - F.col("best.question_len") - 2).alias("tok_end"),
    )
    p = passages.select(F.col("docid").alias("_docid"), "passage")
    j = w.join(p, "_docid", "left")
    char_of_token = sub_token_to_char_map("passage", pieces) if pieces else token_to_char_map("passage")

    def span(m):
        start, end = (F.get(m, F.col(c)).cast("int") for c in ("tok_start", "tok_end"))
        text = let(F.struct(start.alias("s"), end.alias("e")), lambda x: F.substring("passage", x["s"] + 1, x["e"] - x["s"] + 1))
        return F.struct(start.alias("char_start"), end.alias("char_end"), text.alias("answer"))

    found = j.withColumn("_span", F.when(F.col("best").isNotNull() & F.col("passage").isNotNull(), let(char_of_token, span)))
    return found.select("*", "_span.*").drop("passage", "_span")


def winner_passages(winners: DataFrame, passages: DataFrame) -> DataFrame:
    """Passages of the winning documents only. Pass a stored ``winners`` table."""
    return passages_of(passages, winners.filter(F.col("best.docid").isNotNull()).select(F.col("best.docid").alias("docid")))


def span_text(winners: DataFrame, passages: DataFrame, pieces=None) -> DataFrame:
    """Sequence positions -> passage tokens -> characters -> answer text.

    Passages are joined for the winning rows only. Tokens are characters, or what
    ``pieces(character) -> array<string>`` gives (T2).
    """
    return _with_answer(winners.filter(F.col("best").isNotNull()), passages, pieces).select(
        "example_id", F.col("_docid").alias("docid"), F.col("best.score").alias("score"), "tok_start", "tok_end",
        "char_start", "char_end", "answer",
    )


def unanswered(winners: DataFrame) -> DataFrame:
    """Examples with no span above the threshold, with their last docid."""
    return winners.filter(F.col("best").isNull()).select("example_id", F.col("last_docid").alias("docid"))


def predict_test(winners: DataFrame, passages: DataFrame, fallback: str = FALLBACK_ANSWER, pieces=None) -> DataFrame:
    """D8 (test layout) + P8: (id, docid, answer); unanswered examples get the
    fallback text and the docid of their last feature (Q17)."""
    a = _with_answer(winners, passages, pieces)
    return a.select(
        F.col("example_id").alias("id"),
        F.coalesce(F.col("_docid"), F.col("last_docid")).alias("docid"),
        F.coalesce(F.col("answer"), F.lit(fallback)).alias("answer"),
    )


def predict_eval(winners: DataFrame, examples: DataFrame, passages: DataFrame,
                 fallback: str = FALLBACK_ANSWER, pieces=None) -> DataFrame:
    """D7 + D8 (eval layout): (example_id, prediction, label), label being the
    examples' ``gold`` text."""
    a = _with_answer(winners, passages, pieces)
    return a.join(examples.select("example_id", F.col("gold").alias("label")), "example_id").select(
        "example_id",
        F.coalesce(F.col("answer"), F.lit(fallback)).alias("prediction"),
        "label",
    )
