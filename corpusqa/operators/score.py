"""Scoring of features (M1).

``score_features`` runs a user-supplied model over Arrow batches of the three
input columns (an iterator Pandas UDF); all other columns stay in the JVM. The model
is loaded once per Python worker through the ``load_fn`` factory.
"""

from __future__ import annotations

import uuid
from typing import Callable, Iterator, Tuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusqa.functions.worker import once_per_worker
from corpusqa.session import target_partitions

LOGIT_FIELDS = [
    T.StructField("start_logits", T.ArrayType(T.FloatType()), True),
    T.StructField("end_logits", T.ArrayType(T.FloatType()), True),
    T.StructField("class_logits", T.ArrayType(T.FloatType()), True),
]

def balance_features(features: DataFrame) -> DataFrame:
    """Hash-partition feature rows on their full key before per-row scoring.

    Feature rows are small in bytes but expensive per row (512-wide arrays,
    sorts, 100 candidate spans), so byte-based partition coalescing would
    put them in too few tasks; an explicit partition count is kept as is.
    The full (example, document, chunk) key keeps a hot question spread.
    """
    n = target_partitions(features.sparkSession)
    return features.repartition(n, "example_id", "docid", "chunk_idx")


def score_features(features: DataFrame, load_fn: Callable[[], Callable[[np.ndarray, np.ndarray, np.ndarray], tuple]],
                   batch_size: int = 64) -> DataFrame:
    """M1: forward pass of a user model over ``input_ids, input_mask,
    segment_ids``; appends start/end/class logits.

    ``load_fn()`` returns ``predict(ids, mask, seg) -> (start, end, cls)``
    taking and returning 2-D numpy arrays. It is called once per Python worker
    process, however many tasks the worker runs: the model is kept under an id
    drawn here. Features are scored where they are; ``balance_features`` before
    ``encode_inputs`` spreads them while rows are still small.
    """
    model = uuid.uuid4().hex

    @F.pandas_udf(T.StructType(LOGIT_FIELDS))
    def scored(batches: Iterator[Tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        predict = once_per_worker(("model", model), load_fn)
        for columns in batches:
            out = ([], [], [])
            for lo in range(0, len(columns[0]), batch_size):
                inputs = [np.stack(c.iloc[lo:lo + batch_size].to_numpy()) for c in columns]
                for own, logits in zip(out, predict(*inputs)):
                    own += list(np.asarray(logits, dtype=np.float32))
            yield pd.DataFrame(dict(zip([f.name for f in LOGIT_FIELDS], out)))

    name = "logits"
    while name in features.columns:
        name = "_" + name
    out = features.withColumn(name, scored("input_ids", "input_mask", "segment_ids"))
    return out.select(*[F.col(f"`{c}`") for c in features.columns], *[F.col(f"{name}.{f.name}") for f in LOGIT_FIELDS])
