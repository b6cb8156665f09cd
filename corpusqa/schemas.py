"""Declared schemas of the logical tables (no type inference)."""

from pyspark.sql import types as T

S = T.StringType()

PASSAGES = T.StructType([T.StructField("docid", S), T.StructField("passage", S)])
TRAIN_RAW = T.StructType([T.StructField(c, S) for c in ("id", "docid", "question", "answer")])
TRAIN_CLEAN = T.StructType(
    TRAIN_RAW.fields + [T.StructField("start_index", T.IntegerType()), T.StructField("end_index", T.IntegerType())]
)
TEST = T.StructType([T.StructField("id", S), T.StructField("question", S)])
PREDICTIONS_TEST = T.StructType([T.StructField("id", S), T.StructField("docid", S), T.StructField("answer", S)])
PREDICTIONS_EVAL = T.StructType([T.StructField(c, S) for c in ("example_id", "prediction", "label")])
