"""Counts, losses and scores over recorded outputs.

ROUGE-L (A3) is the one per-row Python helper: the longest common
subsequence is computed bit-parallel on Python integers (Hyyrö 2004) inside
an Arrow-batched pandas UDF. Everything else is built-in Spark.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusqa.functions.arrays import let

# Fixed value: evaluation every 50 steps, loss rounded to 4 digits.
DEFAULT_EVAL_STEPS = 50
LOSS_DIGITS = 4
DEV_FILE = "dev.csv"


def prediction_counts(winners: DataFrame) -> DataFrame:
    """A1: examples, answered (known) and unanswered (unknown); known +
    unknown = examples holds by construction."""
    return winners.agg(
        F.count(F.lit(1)).cast("long").alias("n_examples"),
        F.count_if(F.col("best").isNotNull()).cast("long").alias("n_known"),
        F.count_if(F.col("best").isNull()).cast("long").alias("n_unknown"),
    )


def stage_counts(stages: dict) -> DataFrame:
    """A2: one row per pipeline stage with its row count (stage, n)."""
    out = None
    for name, df in stages.items():
        row = df.agg(F.count(F.lit(1)).cast("long").alias("n")).select(F.lit(name).alias("stage"), "n")
        out = row if out is None else out.unionByName(row)
    return out


def observe_count(df: DataFrame, name: str):
    """A2 without an extra job: attach a row-count observation to ``df``.

    Returns (df_observed, observation); ``observation.get`` holds
    ``{"n": rows}`` once an action on ``df_observed`` has finished.
    """
    from pyspark.sql import Observation

    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("n")), obs


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence of two token strings."""
    if not a or not b:
        return 0
    if len(a) < len(b):
        a, b = b, a
    masks: dict = {}
    for i, ch in enumerate(b):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(b)) - 1
    v = full
    for ch in a:
        u = v & masks.get(ch, 0)
        v = ((v + u) | (v - u)) & full
    return len(b) - bin(v).count("1")


def rouge_l_f(prediction: str | None, label: str | None) -> float:
    """ROUGE-L F (Lin 2004) with characters as tokens, whitespace skipped;
    F = 2PR/(P+R), 0 when either side is empty. Symmetric in its arguments."""
    p = "".join(ch for ch in (prediction or "") if not ch.isspace())
    r = "".join(ch for ch in (label or "") if not ch.isspace())
    if not p or not r:
        return 0.0
    lcs = lcs_length(p, r)
    if lcs == 0:
        return 0.0
    prec, rec = lcs / len(p), lcs / len(r)
    return 2 * prec * rec / (prec + rec)


def _rouge_batch(prediction: pd.Series, label: pd.Series) -> pd.Series:
    return pd.Series([rouge_l_f(p, r) for p, r in zip(prediction, label)], dtype="float64")


def rouge_l_udf(pred: Column, label: Column) -> Column:
    """Arrow-batched ROUGE-L F of two string columns."""
    return F.pandas_udf(_rouge_batch, "double")(pred, label)


def rouge_l(predictions: DataFrame, pred_col: str = "prediction", label_col: str = "label") -> DataFrame:
    """A3: per-row ROUGE-L F."""
    return predictions.withColumn("rouge_l_f", rouge_l_udf(F.col(pred_col), F.col(label_col)))


def rouge_l_mean(predictions: DataFrame, pred_col: str = "prediction", label_col: str = "label") -> DataFrame:
    """A4: mean ROUGE-L F over all rows (the reference's eval score)."""
    return rouge_l(predictions, pred_col, label_col).agg(
        F.count(F.lit(1)).cast("long").alias("n"), F.avg("rouge_l_f").alias("rouge_l_mean")
    )


def _lse(arr: Column) -> Column:
    """log-sum-exp of a float array; the maximum is computed once (``let``)."""
    return let(
        F.array_max(arr),
        lambda m: m + F.log(F.aggregate(arr, F.lit(0.0).cast("double"), lambda acc, v: acc + F.exp(v - m))),
    )


def qa_loss(scored: DataFrame) -> DataFrame:
    """A5: start CE (ignore -1) + end CE (ignore -1) + 2 x class CE, each the
    mean over its rows, over a labelled and scored feature table."""
    return mean_loss(with_losses(scored))


def with_losses(scored: DataFrame) -> DataFrame:
    """The three CE of each row: ``start_ce``, ``end_ce``, ``class_ce``; null where ignored."""
    st, en, cl = F.col("start_logits"), F.col("end_logits"), F.col("class_logits")
    sp, ep = F.col("bert_start_position"), F.col("bert_end_position")
    s_ce = F.when(sp >= 0, _lse(st) - F.element_at(st, sp + 1).cast("double"))
    e_ce = F.when(ep >= 0, _lse(en) - F.element_at(en, ep + 1).cast("double"))
    c_ce = _lse(cl) - F.element_at(cl, F.col("class_label") + 1).cast("double")
    return scored.withColumns({"start_ce": s_ce, "end_ce": e_ce, "class_ce": c_ce})


def mean_loss(rows: DataFrame) -> DataFrame:
    agg = rows.agg(F.avg("start_ce").alias("start_loss"), F.avg("end_ce").alias("end_loss"), F.avg("class_ce").alias("class_loss"))
    return agg.withColumn("loss", F.col("start_loss") + F.col("end_loss") + F.lit(2.0) * F.col("class_loss"))


def running_loss(loss_log: DataFrame, eval_steps: int = DEFAULT_EVAL_STEPS, digits: int = LOSS_DIGITS,
                 accumulation: int = 1) -> DataFrame:
    """Running mean of the loss, reset every ``eval_steps * accumulation`` steps
    (``accumulation``: gradient-accumulation factor) and rounded as the reference reports it. Windows are per reset period.

    The mean is a sequential double sum divided by the count, as in the
    reference. Rounding is Spark's ``round``: half-up on the shortest decimal
    form of the double. Python's ``round`` works on the exact binary value, so
    the two can differ by one in the last digit when the shortest form ends
    in 5 right after the kept digits.
    """
    w = (
        Window.partitionBy(F.floor(F.col("step") / (eval_steps * accumulation)))
        .orderBy("step")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return loss_log.select("step", "loss", F.round(F.avg("loss").over(w), digits).alias("running_loss"))


def best_eval_run(eval_log: DataFrame, dev_file: str = DEV_FILE) -> DataFrame:
    """Per run, the first evaluation on the dev file whose score beat
    every earlier one (strict ``>`` starting from 0)."""
    cand = eval_log.filter((F.col("file") == dev_file) & (F.col("eval_accuracy") > 0))
    best = cand.groupBy("run").agg(
        F.max(F.struct(F.col("eval_accuracy"), (-F.col("global_step")).alias("neg_step"), "loss")).alias("b")
    )
    return best.select(
        "run",
        (-F.col("b.neg_step")).cast("long").alias("global_step"),
        F.col("b.eval_accuracy").alias("eval_accuracy"),
        F.col("b.loss").alias("loss"),
    )
