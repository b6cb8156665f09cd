import random

import numpy as np

from corpusqa.llm import quality as q
from corpusqa.llm.queries import op5_quality

DIR = "/root/testdata/sf0.1"


def test_held_out_grades(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{DIR}/labels.parquet")
    learn, held = labels.filter("doc_id % 4 <> 2"), labels.filter("doc_id % 4 = 2")
    rated = q.select(docs, learn).select("row.doc_id", "expected_grade", "p_top", "keep").join(held, "doc_id").collect()
    assert len(rated) > 900
    good = [r for r in rated if r.quality == 1 and r.toxic == 0]
    toxic = [r for r in rated if r.toxic == 1]
    poor = [r for r in rated if r.toxic == 0 and r.quality == 0]
    assert sum(r.keep for r in good) >= 0.97 * len(good)
    assert sum(not r.keep for r in toxic) >= 0.75 * len(toxic)
    mean = [sum(r.expected_grade for r in own) / len(own) for own in (toxic, poor, good)]
    assert mean[0] < mean[1] < mean[2]
    assert all(0 <= r.p_top <= 1 and 0 <= r.expected_grade <= 2 for r in rated)


def test_query_rates_all(spark):
    small = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{small}/documents.parquet").count()
    assert op5_quality(spark, small).count() == n


def test_training_finds_ordered_thresholds():
    rng = random.Random(1)
    rows = []
    for _ in range(600):
        y = rng.choice([0, 1, 2])
        words = [10 + y, 100 + rng.randrange(20), 100 + rng.randrange(20)]
        rows.append((y, words, [0.0] * q.FORM))
    model = q.train(rows)
    assert model.thresholds[0] < model.thresholds[1]
    s = [float(model.weights[10 + y]) for y in range(3)]
    assert s[0] < model.thresholds[0] < s[1] < model.thresholds[1] < s[2]
    below = model.at_most(s[1])
    assert below[0] < 0.5 < below[1]
    again = q.train(rows)
    assert np.array_equal(again.weights, model.weights)


def test_cases(spark):
    docs = [(i, f"good words number {i}", "x") for i in range(30)] + [(100 + i, "%% junk ## " * 5, "x") for i in range(30)]
    docs += [(200, None, "x"), (201, "", "x"), (None, "good words", "x"), (0, "good words number 0", "x"), (203, "good words " * 60_000, "x")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, grade string")
    labels = [(i, 1, 0) for i in range(30)] + [(100 + i, 0, 0) for i in range(30)] + [(0, None, 0), (None, 1, 0), (999, 0, 1), (5, 1, 0)]
    labelled = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = q.select(frame, labelled).collect()
    assert len(rows) == len(docs)
    keep = {r.row.doc_id: r.keep for r in rows}
    assert all(keep[i] for i in range(30)) and not any(keep[100 + i] for i in range(30))
    assert rows[0].row.asDict().keys() == {"doc_id", "text", "grade"}
    assert q.select(frame.filter("false"), labelled).count() == 0
    none = q.select(frame, labelled.filter("false")).collect()
    assert all(r.keep and r.p_top is None for r in none)


def test_samples_hold_one_row_of_an_id(spark):
    """A chosen id that holds most of the rows counts once."""
    from corpusqa.llm import language_id, quality, secrets

    texts = {1: ("the cat sat on the mat", "en"), 2: ("le chat est sur la table", "fr"), 3: ("password = abcdefgh12345678", "en")}
    rows = [(i, t, lang) for i, (t, lang) in texts.items()]
    once = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    hot = spark.createDataFrame(rows + rows[:1] * 300 + rows[2:] * 300, once.schema).repartition(7)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 0, 1)], "doc_id long, quality int, toxic int")
    seen = []
    for module, fit in ((language_id, lambda d: language_id.fit(d)), (quality, lambda d: quality.fit(d, labels)), (secrets, lambda d: secrets.fit(d))):
        plain = module.train
        try:
            module.train = lambda *a: seen.append(a)
            fit(once), fit(hot)
        finally:
            module.train = plain
    sizes = [len(a[0]) for a in seen]
    assert len(sizes) == 6 and sizes[::2] == sizes[1::2]
