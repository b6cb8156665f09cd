"""CSV / TSV sources and sinks.

Options are chosen so that a write followed by a read gives the same values:
RFC-4180 quoting with doubled quotes, multi-line values, no whitespace
trimming on write, ``NA`` kept as text. Null is written as a marker with a
control character, so that the empty string stays what it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusqa.schemas import PREDICTIONS_EVAL, S, T

BEST_PREDICTIONS = T.StructType([T.StructField("run", S), *PREDICTIONS_EVAL.fields])
NULL = "\x01null"

READ_OPTIONS = {
    "header": "true",
    "nullValue": NULL,
    "emptyValue": "",
    "quote": '"',
    "escape": '"',
    "mode": "FAILFAST",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
WRITE_OPTIONS = {
    "header": "true",
    "nullValue": NULL,
    "emptyValue": '""',
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_table(spark: SparkSession, path: str, schema: StructType, sep: str = ",", multi_line: bool = True) -> DataFrame:
    """S1 (comma) / S2 (tab): scan a headed CSV with a declared schema. Without
    ``multi_line``, for files whose values hold no line break, a large file is
    split among tasks."""
    return spark.read.options(**READ_OPTIONS).option("multiLine", multi_line).option("sep", sep).schema(schema).csv(path)


def write_table(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite", single_file: bool = False) -> None:
    """Write a headed CSV (one file per partition unless
    ``single_file``, which funnels everything through one task and is only
    meant for small outputs such as a submission file)."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).options(**WRITE_OPTIONS).option("sep", sep).csv(path)


def append_eval_log(df: DataFrame, path: str) -> None:
    """Append evaluation rows (run, file, global_step, loss, eval_accuracy), with the
    time of writing."""
    rows = df.select("run", "file", "global_step", "loss", "eval_accuracy", F.current_timestamp().alias("written"))
    rows.write.mode("append").parquet(path)


def read_eval_log(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the log. An evaluation that was repeated counts once: the row
    written last for a (run, file, global_step)."""
    last = F.max(F.struct("written", "loss", "eval_accuracy")).alias("last")
    rows = spark.read.parquet(path).groupBy("run", "file", "global_step").agg(last)
    return rows.select("run", "file", "global_step", "last.loss", "last.eval_accuracy")


def write_best_eval_predictions(predictions: DataFrame, best: DataFrame, path: str) -> None:
    """Write the eval predictions of each run's best evaluation only.

    ``predictions`` carries (run, global_step, example_id, prediction, label)
    for every evaluation; ``best`` is the output of ``best_eval_run``.
    """
    chosen = predictions.join(best.select("run", "global_step"), ["run", "global_step"], "left_semi")
    write_table(chosen.select("run", "example_id", "prediction", "label"), path)
