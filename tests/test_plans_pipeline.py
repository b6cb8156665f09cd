"""End-to-end plans on a small Chinese-text fixture (delimiter 。)."""


from corpusqa.operators import retrieval
from corpusqa.operators.metrics import observe_count
from corpusqa.operators import encode, score
from corpusqa.operators.tokens import build_char_vocab
from corpusqa.plans import pipeline
from corpusqa.plans.stand_in import pseudo_logits

DOCS = [(1, "新冠 病毒 是 一种 冠状病毒。它 通过 飞沫 传播。"), (2, "口罩 可以 防止 飞沫 传播。勤 洗手 也 很 重要。"),
        (3, "疫苗 接种 可以 预防 重症。")]
TRAIN = [(1, 1, "病毒怎样传播", "通过飞沫传播"), (2, 2, "怎样防止传播", "口罩"), (3, 3, "如何预防", "不存在的答案")]


def test_prepare_and_predict(spark):
    passages = spark.createDataFrame(DOCS, "docid long, passage string")
    train = spark.createDataFrame(TRAIN, "id long, docid long, question string, answer string")
    prep = pipeline.prepare(passages, train)
    assert sorted(r.id for r in prep.answerable.collect()) == [1, 2]
    assert [r.id for r in prep.rejected.collect()] == [3]
    index = retrieval.build_index(prep.raw_passages)
    qs = spark.createDataFrame([(10, "飞沫 传播"), (11, "xyz")], "id long, question string")
    out = pipeline.predict(index, qs, prep.passages, pseudo_logits, delimiter="。")
    rows = {r.id: r for r in out.collect()}
    assert set(rows) == {10}                          # zero-hit question gives no row (Q8)
    kept = {r.id: r for r in pipeline.predict(index, qs, prep.passages, pseudo_logits,
                                              keep_unmatched=True, delimiter="。").collect()}
    assert kept[11].answer == "疫情" and kept[11].docid is None and kept[10] == rows[10]
    ev = pipeline.evaluate(prep.examples, prep.passages, pseudo_logits, delimiter="。").collect()
    assert len(ev) == 2 and all(r.label for r in ev)


def test_observe_count(spark):
    df, obs = observe_count(spark.range(123), "rows")
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["n"] == 123


def test_duplicate_docids_stand_for_their_first_row(spark):
    docs = [(5, 1, "later words"), (2, 1, "apple. pear"), (3, 2, "plum."), (9, 2, "plum.")]
    passages = spark.createDataFrame(docs, "ordinal long, docid long, passage string")
    train = spark.createDataFrame([(7, 1, "q", "pear")], "id long, docid long, question string, answer string")
    prep = pipeline.prepare(passages, train)
    assert sorted((r.docid, r.passage) for r in prep.raw_passages.collect()) == [(1, "apple. pear"), (2, "plum.")]
    assert [(r.example_id, r.gold) for r in prep.examples.collect()] == [(7, "pear")]
    assert "passage" not in prep.examples.columns
    index = retrieval.build_index(prep.raw_passages)
    assert index.corpus_stats.first().n_docs == 2
    assert sorted((r.term, r.tf, r.dl) for r in index.postings.collect()) == [("apple", 1, 2), ("pear", 1, 2), ("plum", 1, 1)]


def test_stray_blanks_in_chinese_do_not_part_words(spark):
    docs = spark.createDataFrame([(1, "新 冠 病毒 virus load"), (2, "口罩")], "docid long, passage string")
    terms = {r.term for r in retrieval.build_index(docs).postings.collect()}
    assert terms == {"新冠", "冠病", "病毒", "virus", "load", "口罩"}
    qs = spark.createDataFrame([(1, "冠 病")], "id long, question string")
    assert [r.docid for r in retrieval.bm25_topk(retrieval.build_index(docs), qs).collect()] == [1]


def test_user_model_is_loaded_once_per_worker_and_ids_may_be_strings(spark, tmp_path):
    marks = str(tmp_path)

    def load():
        import os
        import uuid

        import numpy as np

        open(f"{marks}/{os.getpid()}-{uuid.uuid4().hex}", "w").close()

        def predict(ids, mask, seg):
            place = np.arange(ids.shape[1])
            return (ids + place) * mask * 1.0, (ids + 2 * place) * mask * 1.0, np.zeros((len(ids), 2))

        return predict

    passages = spark.createDataFrame([(f"d-{i}", f"文本 {i} 内容。第二句。") for i in range(40)], "docid string, passage string")
    train = spark.createDataFrame([], "id string, docid string, question string, answer string")
    prep = pipeline.prepare(passages, train)
    vocab = build_char_vocab(prep.passages)
    qs = spark.createDataFrame([(f"q-{i}", f"内容 {i}") for i in range(40)], "id string, question string")
    scorer = lambda f: score.score_features(encode.encode_inputs(score.balance_features(f), 64), load)
    plan = scorer(pipeline.test_features(qs.selectExpr("id", "'d-1' docid", "1L rank", "question"), prep.passages, vocab=vocab, max_seq_length=64, max_question_length=16, overlap=5))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "MapInPandas" not in plan   # other columns stay in the JVM
    out = pipeline.predict(retrieval.build_index(prep.raw_passages), qs, prep.passages, scorer, vocab=vocab, max_seq_length=64, max_question_length=16, overlap=5)
    assert out.count() == 40 and all(r.docid.startswith("d-") for r in out.collect())
    loads = [f.name.split("-")[0] for f in tmp_path.iterdir()]
    assert loads and len(loads) == len(set(loads))


def test_tokenizer_of_the_questions(spark):
    from pyspark.sql import functions as F

    passages = spark.createDataFrame([(1, "甲乙丙。")], "docid long, passage string")
    ex = spark.createDataFrame([(1, 1, "two words", 1)], "example_id long, docid long, question string, rank long")
    f = encode.build_features(ex, passages, mode=encode.TEST, tokenizer=lambda c: F.split(F.col(c), " ")).first()
    assert f.question_len == 2


def test_evaluation_chain(spark, tmp_path):
    from corpusqa.sources import csv_io

    passages = spark.createDataFrame(DOCS, "docid long, passage string")
    train = spark.createDataFrame(TRAIN, "id long, docid long, question string, answer string")
    prep = pipeline.prepare(passages, train)
    log = f"{tmp_path}/log"
    runs = [pipeline.evaluate_run("r", s, prep.examples, prep.passages, pseudo_logits, log, delimiter="。") for s in (50, 100, 50)][:2]
    rows = csv_io.read_eval_log(spark, log).collect()   # step 50, evaluated twice, has one row
    assert sorted(r.global_step for r in rows) == [50, 100] and len({r.eval_accuracy for r in rows}) == 1
    pipeline.best_predictions(runs[0].unionByName(runs[1]), log, f"{tmp_path}/best")
    best = csv_io.read_table(spark, f"{tmp_path}/best", csv_io.BEST_PREDICTIONS).collect()
    # equal scores: the earlier evaluation; none above 0: no best run
    assert len(best) == (2 if rows[0].eval_accuracy > 0 else 0)
