"""Cleaning, answer location and the example lookup join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusqa.functions.text import char_to_sub_token, char_to_token, clean_text
from corpusqa.session import materialize


def clean_passages(passages: DataFrame, text_col: str = "passage") -> DataFrame:
    """P2 on passages: remove spaces and tabs from the passage column."""
    return passages.withColumn(text_col, clean_text(text_col))


def clean_questions(questions: DataFrame, cols=("question",)) -> DataFrame:
    """P2 on question tables (train: question and answer; test: question)."""
    out = questions
    for c in cols:
        out = out.withColumn(c, clean_text(c))
    return out


# Repeated docids that are broadcast, at most (a docid and an ordinal each).
BROADCAST_DOCIDS = 1_000_000


def first_passage_per_docid(passages: DataFrame, order_col: str = "ordinal") -> DataFrame:
    """Duplicates keep the first row per docid, by ``order_col`` (the row's
    place in its source, unique there). Null docids are one docid.

    Only (docid, order) is shuffled, to find the docids that repeat: a partial
    aggregate, so a hot docid is combined map-side. They are written, and counted: up to
    ``BROADCAST_DOCIDS`` are broadcast to the rows, which stay where they are; beyond
    that they are joined.
    """
    by_docid = passages.groupBy("docid").agg(F.min(order_col).alias("first"), F.count(F.lit(1)).alias("n"))
    repeated = materialize(by_docid.filter("n > 1").select(F.col("docid").alias("_docid"), "first"), "repeated-docids")
    n = repeated.count()
    if n == 0:
        return passages.select("docid", "passage")
    if n <= BROADCAST_DOCIDS:
        repeated = F.broadcast(repeated)
    rows = passages.join(repeated, F.col("docid").eqNullSafe(F.col("_docid")), "left")
    return rows.filter(F.col("first").isNull() | (F.col(order_col) == F.col("first"))).select("docid", "passage")


def passages_of(passages: DataFrame, docids: DataFrame, n: int | None = None) -> DataFrame:
    """The passages of the documents in ``docids(docid)``, ``n`` rows at most; null is a docid. Up to
    ``BROADCAST_DOCIDS`` go to the texts, which stay where they are; more are joined."""
    wanted = docids.select(F.col("docid").alias("_docid")).distinct()
    if (wanted.count() if n is None else n) <= BROADCAST_DOCIDS:
        wanted = F.broadcast(wanted)
    return passages.join(wanted, F.col("docid").eqNullSafe(F.col("_docid")), "left_semi")


def locate_answers(train: DataFrame, passages: DataFrame) -> DataFrame:
    """Join each cleaned train row to its cleaned passage and find the answer.

    ``start_index`` is the 0-based first occurrence, -1 if absent; ``end_index``
    is exclusive (start + len). Empty or null answers get -1 (Q3, Q4).
    Rows whose docid is missing keep a null passage and -1.
    """
    p = passages.select("docid", F.col("passage"))
    j = train.join(p, "docid", "left")
    found = F.instr(F.col("passage"), F.col("answer")) - 1
    ok = F.col("answer").isNotNull() & (F.length("answer") > 0) & F.col("passage").isNotNull()
    start = F.when(ok, found).otherwise(F.lit(-1))
    return (
        j.withColumn("start_index", start.cast("int"))
        .withColumn("end_index", (F.col("start_index") + F.coalesce(F.length("answer"), F.lit(0))).cast("int"))
    )


def answerable(located: DataFrame) -> DataFrame:
    """Keep rows whose answer was found in the passage."""
    return located.filter(F.col("start_index") >= 0)


def rejected(located: DataFrame) -> DataFrame:
    """The dropped rows as a table, with the reason."""
    reason = (
        F.when(F.col("passage").isNull(), F.lit("missing_docid"))
        .when(F.col("answer").isNull() | (F.length("answer") == 0), F.lit("empty_answer"))
        .otherwise(F.lit("answer_not_in_passage"))
    )
    return located.filter(F.col("start_index") < 0).withColumn("reason", reason)


def qa_examples(answerable_rows: DataFrame, pieces=None) -> DataFrame:
    """P5 + J1: examples with inclusive character end (``end = end_index - 1``),
    the answer's token positions and its text ``gold``. What needs the passage is
    taken here, so that examples do not carry a copy of the corpus. Tokens are
    characters, or what ``pieces(character) -> array<string>`` gives (T2)."""
    end = F.col("end_index") - 1
    place = lambda c: char_to_sub_token("passage", c, pieces) if pieces else char_to_token("passage", c)
    return answerable_rows.select(
        F.col("id").alias("guid"),
        "docid",
        "question",
        F.col("start_index").alias("start"),
        end.alias("end"),
        place(F.col("start_index")).cast("int").alias("token_start"),
        place(end).cast("int").alias("token_end"),
        F.substring(F.col("passage"), F.col("start_index") + 1, F.col("end_index") - F.col("start_index")).alias("gold"),
        F.length("passage").cast("long").alias("passage_len"),
    )


def missing_docids(train: DataFrame, passages: DataFrame) -> DataFrame:
    """J1 error path as a report: train rows whose docid has no passage."""
    return train.join(passages.select("docid"), "docid", "left_anti")
