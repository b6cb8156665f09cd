"""A growing index against one built at once."""

import os

from pyspark.sql import functions as F

from corpusqa.operators import retrieval, segments
from corpusqa.session import scratch_path
from corpusqa.sources import driver_tables as dt

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _same(spark, path, passages, questions):
    """The index at ``path`` has the rows and the hits of one built from ``passages``."""
    grown, built = segments.open_index(spark, path), retrieval.build_index(passages)
    assert _rows(grown.postings.select("term", "docid", "tf", "dl")) == _rows(built.postings.select("term", "docid", "tf", "dl"))
    assert _rows(grown.term_stats) == _rows(built.term_stats)
    assert _rows(grown.doc_stats) == _rows(built.doc_stats)
    assert _rows(grown.corpus_stats) == _rows(built.corpus_stats)
    assert _rows(retrieval.bm25_topk(grown, questions, 5)) == _rows(retrieval.bm25_topk(built, questions, 5))


def test_loads_replacements_deletions_and_merge(spark):
    path = scratch_path(spark, "segments")
    table = lambda rows: spark.createDataFrame(rows, "docid int, passage string")
    questions = spark.createDataFrame([(1, "red fox"), (2, "blue whale sea"), (3, "nothing here")], "id int, question string")
    first = [(1, "red fox red"), (2, "blue whale"), (3, "the sea"), (4, ""), (None, "red sea"), (5, None)]
    assert segments.append_documents(table(first), path) == 6
    _same(spark, path, table(first), questions)
    # 1 and the null docid replaced, 2 unchanged, 6 new; the first row of 6 counts
    second = [(1, "green fox"), (2, "blue whale"), (None, "whale whale"), (6, "red red fox")]
    assert segments.append_documents(table(second + [(6, "later")]).coalesce(1), path) == 3
    now = [(1, "green fox"), (2, "blue whale"), (3, "the sea"), (4, ""), (None, "whale whale"), (5, None), (6, "red red fox")]
    _same(spark, path, table(now), questions)
    assert segments.append_documents(table(second), path) == 0          # a repeated load
    assert segments.segment_numbers(spark, path) == [1, 2]
    assert segments.delete_documents(spark.createDataFrame([(2,), (6,), (99,)], "docid int"), path) == 2
    now = [r for r in now if r[0] not in (2, 6)]
    _same(spark, path, table(now), questions)
    assert segments.append_documents(table([(2, "blue whale")]), path) == 1   # back after its deletion
    now.append((2, "blue whale"))
    _same(spark, path, table(now), questions)
    number = segments.merge_segments(spark, path)
    assert segments.segment_numbers(spark, path) == [number]
    _same(spark, path, table(now), questions)
    assert segments.append_documents(table([(3, "a red fox at sea")]), path) == 1
    now = [r for r in now if r[0] != 3] + [(3, "a red fox at sea")]
    segments.drop_merged(spark, path)
    _same(spark, path, table(now), questions)


def test_failed_load_is_not_seen(spark):
    path = scratch_path(spark, "segments")
    table = lambda rows: spark.createDataFrame(rows, "docid int, passage string")
    questions = spark.createDataFrame([(1, "red fox")], "id int, question string")
    segments.append_documents(table([(1, "red fox"), (2, "fox")]), path)
    table([(7, "left over")]).write.parquet(f"{path}/segment=2/docs")    # a load that stopped half way
    _same(spark, path, table([(1, "red fox"), (2, "fox")]), questions)
    segments.append_documents(table([(2, "red red fox")]), path)
    _same(spark, path, table([(1, "red fox"), (2, "red red fox")]), questions)


def test_half_of_a_corpus_replaced(spark):
    path = scratch_path(spark, "segments")
    now = dt.passages(spark, SF).drop("ordinal")
    before = now.withColumn("passage", F.when(F.col("docid") % 2 == 0, F.concat(F.lit("whale "), "passage")).otherwise(F.col("passage")))
    segments.append_documents(before, path)
    assert segments.append_documents(now, path) == now.filter((F.col("docid") % 2 == 0) & F.col("passage").isNotNull()).count()
    _same(spark, path, now, dt.test_questions(spark, SF))
    assert os.path.isdir(f"{path}/segment=1")
