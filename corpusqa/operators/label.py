"""Interval-overlap labels of chunks against a known answer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed label names and their class index (E7): known = 0, unknown = 1.
KNOWN, UNKNOWN = "known", "unknown"
CLASS_LABELS = [KNOWN, UNKNOWN]


def overlap_label(a="doc_start", b="doc_end", s="token_start", e="token_end", q="question_len"):
    """Closed chunk [a, b] against closed answer [s, e] (token positions).

    1. ``a >= e or b <= s``: unknown, (-1, -1). Touching in one token is no overlap.
    2. ``a <= s and e <= b``: known, answer shifted into the sequence.
    3. otherwise known, clipped to the chunk (E9).
    Returns (bert_start_position, bert_end_position, label) columns.
    """
    a, b, s, e, q = (F.col(x) if isinstance(x, str) else x for x in (a, b, s, e, q))
    off = q + F.lit(2) - a
    unknown = (a >= e) | (b <= s)
    inside = (a <= s) & (e <= b)
    start = (
        F.when(unknown, F.lit(-1))
        .when(inside, s + off)
        .otherwise(F.greatest(s + off, q + F.lit(2)))
    )
    end = (
        F.when(unknown, F.lit(-1))
        .when(inside, e + off)
        .otherwise(F.least(e + off, b + off))
    )
    label = F.when(unknown, F.lit(UNKNOWN)).otherwise(F.lit(KNOWN))
    return start.cast("int"), end.cast("int"), label


def class_index(label_col="label") -> Column:
    """Known -> 0, unknown -> 1."""
    return (F.array_position(F.array(*[F.lit(x) for x in CLASS_LABELS]), F.col(label_col)) - 1).cast("int")
