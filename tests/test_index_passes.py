"""Texts are read, analysed and moved once for an index, and not moved where few are looked up."""

import re

from pyspark.sql import functions as F

from corpusqa.operators import decode, retrieval


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_documents_of_a_held_index_come_from_its_blocks(spark):
    docs = spark.createDataFrame([(1, "one two two"), (2, ""), (None, "two"), (4, None)], "docid long, passage string")
    index = retrieval.held(retrieval.build_index(docs, shards=2))
    assert sorted(index.docs.select("docid", "dl").collect(), key=str) == sorted(
        docs.select("docid", F.when(F.col("passage") == "", 0).otherwise(F.size(F.split("passage", " "))).cast("long").alias("dl")).collect(), key=str)
    assert index.corpus_stats.first()[:] == (4, 4 / 3)
    assert sorted(r.term for r in index.blocks.select("term").distinct().collect()) == ["one", "two"]
    for table in (index.docs, index.corpus_stats):
        assert "/blocks-" in _plan(table) and "regexp" not in _plan(table)


def test_few_winners_do_not_move_the_texts(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        winners = spark.range(3).select("id", F.struct(F.col("id").alias("docid")).alias("best"))
        passages = spark.range(9).select(F.col("id").alias("docid"), F.lit("text").alias("passage"))
        found = decode.winner_passages(winners, passages)
        assert "SortMergeJoin" not in _plan(found) and "BroadcastHashJoin" in _plan(found)
        assert sorted(r.docid for r in found.collect()) == [0, 1, 2]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_losses_of_chunks_give_the_loss_without_logits(spark):
    from corpusqa.operators import metrics

    rows = spark.createDataFrame(
        [([0.5, 2.0], [1.0, 0.0], [0.0, 1.0], 1, 0, 1), ([3.0, 1.0], [0.0, 0.0], [1.0, 0.0], -1, -1, 0)],
        "start_logits array<float>, end_logits array<float>, class_logits array<float>, bert_start_position int, bert_end_position int, class_label int")
    chunks = metrics.with_losses(rows).select("start_ce", "end_ce", "class_ce")
    assert [r.start_ce is None for r in chunks.collect()] == [False, True]
    assert metrics.mean_loss(chunks).first() == metrics.qa_loss(rows).first()


def _asked(spark, n_docs, n_questions):
    docs = spark.range(n_docs).select(F.col("id").alias("docid"), F.concat(F.lit("common word"), F.col("id") % 97, F.lit(" rare"), F.col("id") % 800).alias("passage"))
    own = spark.range(n_questions).select("id", F.concat(F.lit("common word"), F.col("id") % 97, F.lit(" rare"), F.col("id") * 7 % 800).alias("question"))
    return docs, own


def test_questions_go_to_few_parts_not_to_every_shard(spark):
    """Before: a row for each question and shard."""
    docs, questions = _asked(spark, 3000, 50)
    index = retrieval.held(retrieval.build_index(docs, shards=40))
    hits = retrieval.bm25_topk(index, questions, 5)
    parts = spark.sparkContext.defaultParallelism
    plan = hits._jdf.queryExecution().analyzed().toString()
    assert parts < 40 and re.search(rf"sequence\(0, {parts - 1}\b", plan)
    assert hits.groupBy("id").count().filter("count = 5").count() == 50


def test_bound_of_the_first_part_loses_no_hit(spark, monkeypatch):
    docs, questions = _asked(spark, 4000, 300)
    docs = docs.unionByName(spark.createDataFrame([(None, "common word3 rare7 extra"), (9999, "common word3 rare21")], "docid long, passage string"))
    questions = questions.unionByName(spark.createDataFrame([(None, "extra word3"), (7777, None), (7778, "unknown")], "id long, question string"))
    rows = lambda: sorted(retrieval.bm25_topk(index, questions, 10).collect(), key=str)
    for own in ({}, {"docid": 5}):
        index = retrieval.held(retrieval.build_index(docs, shards=9))
        if own:  # documents that count no more
            index.dead = index.docs.filter("docid IN (5, 97, 1003) OR docid IS NULL").select("docid", "shard")
        monkeypatch.setattr(retrieval, "MANY", 1 << 40)
        once = rows()
        monkeypatch.setattr(retrieval, "MANY", 1)
        assert rows() == once and len(once) > 2900
        assert not own or not {None, 5, 97, 1003} & {r.docid for r in once}


def test_recall_joins_the_texts_once(spark):
    """Before: the examples were made anew for the questions and for the gold documents."""
    import __spark_entry__ as entry

    plan = _plan(entry.queries()["recall_at_k"](spark, "/root/testdata/sf0.001"))
    assert "/examples-" in plan and "instr(" not in plan
