"""End-to-end plans: prepare, training set, evaluation and prediction.

Each step returns lazy DataFrames; Spark plans every output table as one
job. Shuffles happen at the passage lookup join, the postings build, the
retrieval join/aggregation, the (docid, capacity) chunk join, sampling and
the per-question decode.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusqa.operators import clean, decode, encode, metrics, retrieval, sample
from corpusqa.session import materialize
from corpusqa.sources import csv_io


@dataclass
class Prepared:
    raw_passages: DataFrame   # one row per docid, blanks kept: what is indexed
    passages: DataFrame
    located: DataFrame
    answerable: DataFrame
    rejected: DataFrame
    examples: DataFrame


def prepare(passages_raw: DataFrame, train_raw: DataFrame) -> Prepared:
    """Preprocess: clean passages and train rows, locate answers, split off
    rejected rows, build examples (char positions, inclusive end).

    A docid that occurs more than once stands for its first row: by the column
    ``ordinal`` if there is one, else in the order in which the rows are read.
    """
    if "ordinal" not in passages_raw.columns:
        passages_raw = passages_raw.withColumn("ordinal", F.monotonically_increasing_id())
    raw = clean.first_passage_per_docid(passages_raw)
    p = clean.clean_passages(raw)
    t = clean.clean_questions(train_raw, ("question", "answer"))
    loc = clean.locate_answers(t, p)
    ok = clean.answerable(loc)
    ex = clean.qa_examples(ok).withColumnRenamed("guid", "example_id")
    return Prepared(raw, p, loc, ok, clean.rejected(loc), ex)


def training_features(examples: DataFrame, passages: DataFrame, mode: str = encode.TRAIN,
                      vocab: DataFrame | None = None, **kw) -> DataFrame:
    """Labelled (question, chunk) features of train or eval examples."""
    return encode.build_features(examples, passages, mode=mode, vocab=vocab, **kw)


def retrieve(index: retrieval.Index, questions: DataFrame, k: int = retrieval.DEFAULT_K) -> DataFrame:
    """Top-k hits of raw questions, joined back to their cleaned text:
    (id, docid, rank, score, question)."""
    hits = retrieval.bm25_topk(index, questions, k)
    return hits.join(clean.clean_questions(questions.select("id", "question")), "id")


def test_features(hits: DataFrame, passages: DataFrame, vocab: DataFrame | None = None, **kw) -> DataFrame:
    """Unlabelled features of retrieved pairs (example_id = question id). Pass stored ``hits``."""
    ex = hits.select(F.col("id").alias("example_id"), "docid", "rank", "question")
    return encode.build_features(ex, clean.passages_of(passages, ex), mode=encode.TEST, vocab=vocab, **kw)


def decode_features(scored: DataFrame, order_cols=("rank", "chunk_idx")) -> DataFrame:
    """Best span per chunk, then per question (winners table)."""
    return decode.best_span_per_question(decode.best_span_per_chunk(scored), order_cols)


def predict(index: retrieval.Index, questions: DataFrame, passages: DataFrame, scorer,
            k: int = retrieval.DEFAULT_K, keep_unmatched: bool = False, **kw) -> DataFrame:
    """Search and predict: (id, docid, answer). The index is over raw passages,
    ``questions`` are raw, ``passages`` cleaned. ``scorer(features)`` adds logits,
    e.g. ``lambda f: score.score_features(encode.encode_inputs(f), load_model)``.

    A question without any retrieved document produces no row, as in the
    reference (Q8); with ``keep_unmatched`` it gets the fallback answer and a
    null docid instead.
    """
    hits = materialize(retrieve(index, questions, k), "hits")   # small, read by several branches
    feats = test_features(hits, passages, **kw)
    winners = materialize(decode_features(scorer(feats)), "winners")      # one row per question
    out = decode.predict_test(winners, decode.winner_passages(winners, passages))
    if keep_unmatched:
        missing = questions.select("id").join(out.select("id"), "id", "left_anti")
        out = out.unionByName(
            missing.select("id", F.lit(None).cast(out.schema["docid"].dataType).alias("docid"),
                           F.lit(decode.FALLBACK_ANSWER).alias("answer"))
        )
    return out


def evaluate(examples: DataFrame, passages: DataFrame, scorer, **kw) -> DataFrame:
    """Eval predictions (example_id, prediction, label) for labelled examples."""
    scored = scorer(training_features(examples, passages, mode=encode.EVAL, **kw))
    return _eval_predictions(decode.best_span_per_chunk(scored), examples, passages)


def _eval_predictions(chunks: DataFrame, examples: DataFrame, passages: DataFrame) -> DataFrame:
    winners = materialize(decode.best_span_per_question(chunks, ("chunk_idx",)), "eval_winners")
    return decode.predict_eval(winners, examples, decode.winner_passages(winners, passages))


def evaluate_run(run: str, global_step: int, examples: DataFrame, passages: DataFrame, scorer, log_path: str,
                 file: str = metrics.DEV_FILE, features: DataFrame | None = None, **kw) -> DataFrame:
    """One evaluation: predictions with their run and step, and a row of the log
    at ``log_path`` with the mean ROUGE-L and the loss (S8). ``file`` names the
    examples' file; best runs are chosen by the dev file's rows (A7). ``features``: the
    examples' stored EVAL features, if several evaluations share them.

    Features are scored once: each chunk's best span and losses are written, without logits.
    """
    scored = scorer(training_features(examples, passages, mode=encode.EVAL, **kw) if features is None else features)
    chunks = decode.best_span_per_chunk(metrics.with_losses(scored))
    chunks = materialize(chunks.select("example_id", "docid", "chunk_idx", "doc_start", "question_len", "best_score", "best_start",
                                       "best_end", "start_ce", "end_ce", "class_ce"), "eval_chunks")
    predictions = materialize(_eval_predictions(chunks, examples, passages), "eval_predictions")
    spark = examples.sparkSession
    row = spark.range(1).select(
        F.lit(run).alias("run"), F.lit(file).alias("file"), F.lit(global_step).cast("long").alias("global_step"),
        metrics.mean_loss(chunks).select("loss").scalar().alias("loss"),
        metrics.rouge_l_mean(predictions).select("rouge_l_mean").scalar().alias("eval_accuracy"),
    )
    csv_io.append_eval_log(row, log_path)
    return predictions.select(F.lit(run).alias("run"), F.lit(global_step).cast("long").alias("global_step"), "*")


def best_predictions(predictions: DataFrame, log_path: str, path: str) -> None:
    """Of all evaluations' predictions, those of each run's best one."""
    log = csv_io.read_eval_log(predictions.sparkSession, log_path)
    csv_io.write_best_eval_predictions(predictions, metrics.best_eval_run(log), path)


def training_set(examples: DataFrame, passages: DataFrame, vocab: DataFrame, batch_size: int = 64,
                 seed: int = sample.DEFAULT_SEED, **kw) -> DataFrame:
    """Encoded, sampled and batched training rows."""
    feats = materialize(training_features(examples, passages, mode=encode.TRAIN, vocab=vocab, **kw),
                        "train_features")
    chosen = sample.sample_training(feats, seed)
    return sample.shuffle_batches(encode.encode_inputs(chosen), batch_size, seed)
