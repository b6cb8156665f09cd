"""Deterministic logits in place of a model's, for the driver queries.

``pseudo_logits`` can be restated in SQL, so that everything after the model is
checked by value. It needs integer ids and is no scorer for real use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusqa.functions.arrays import let
from corpusqa.operators.chunk import DEFAULT_MAX_SEQ_LENGTH
from corpusqa.operators.score import balance_features

# Fixed constants of the pseudo-logit rule (see FIXTURES.md).
_START_MULT = (7919, 6007, 104729, 613)
_END_MULT = (15485863, 7507, 32452843, 997)


def _of_row(ex, doc, chunk, mult):
    a, b, c = (F.lit(m).cast("long") for m in mult[:3])
    return ex.cast("long") * a + doc.cast("long") * b + chunk.cast("long") * c


def _pseudo(of_row, i, mult):
    n = (of_row + i.cast("long") * F.lit(mult[3]).cast("long")) % 1000
    return (n / F.lit(100.0) - F.lit(5.0)).cast("float")


def pseudo_logits(features: DataFrame, max_seq_length: int = DEFAULT_MAX_SEQ_LENGTH,
                  class_logits: DataFrame | None = None) -> DataFrame:
    """Deterministic logits over the whole padded sequence.

    ``start[i] = ((ex*7919 + doc*6007 + chunk*104729 + i*613) % 1000)/100 - 5``,
    ``end[i]`` likewise with the second set of constants; for example ids
    divisible by 10, position 0 of both is 10 so no span scores above 0.
    ``class_logits`` (docid, class_logits) is left-joined, default [0, 0].
    """
    features = balance_features(features)
    ex, doc, ch = F.col("example_id"), F.col("docid"), F.col("chunk_idx")
    seq = F.sequence(F.lit(0), F.lit(max_seq_length - 1))
    ten = F.lit(10.0).cast("float")
    hot = (ex % 10) == 0

    def arr(mult):
        row = F.struct(_of_row(ex, doc, ch, mult).alias("n"), hot.alias("hot"))  # once a row
        return let(row, lambda r: F.transform(seq, lambda i: F.when((i == 0) & r["hot"], ten).otherwise(_pseudo(r["n"], i, mult))))

    out = features.withColumn("start_logits", arr(_START_MULT)).withColumn("end_logits", arr(_END_MULT))
    zero = F.array(F.lit(0.0).cast("float"), F.lit(0.0).cast("float"))
    if class_logits is None:
        return out.withColumn("class_logits", zero)
    return out.join(class_logits, "docid", "left").withColumn(
        "class_logits", F.coalesce(F.col("class_logits"), zero)
    )


def label_class_logits(labels: DataFrame) -> DataFrame:
    """Class logits from the ``labels`` table: [quality, 1 - quality]."""
    return labels.select(
        F.col("doc_id").alias("docid"),
        F.array(F.col("quality").cast("float"), (F.lit(1) - F.col("quality")).cast("float")).alias("class_logits"),
    )


def load_hash_model():
    """A model of whole numbers over the input ids, as ``score_features`` loads it."""
    import numpy as np

    def predict(ids, mask, seg):
        place = np.arange(ids.shape[1])
        start = ((ids * 31 + place * 17) % 1000 / 100.0 - 5.0) * mask
        end = ((ids * 57 + place * 29 + seg) % 1000 / 100.0 - 5.0) * mask
        used = mask.sum(axis=1)
        return start, end, np.stack([used % 7, (ids.sum(axis=1) % 11)], axis=1)

    return predict
