import numpy as np

from corpusqa.llm import language_id as g
from corpusqa.llm.queries import op3_language_id
from tests.llm.conftest import crc

DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "lang").collect()}
    rows = op3_language_id(spark, DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(truth)
    assert all(r.held_out == (crc(r.doc_id) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_tables_equal_the_network():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 256, (5, g.WINDOW)).astype(np.uint8)
    model = g.train(x, np.array([0, 1, 0, 1, 1]), ["a", "b"])
    z = []
    for own in x:
        e = model.embed[own]
        spans = np.stack([e[i : i + g.REACH] for i in range(g.WINDOW - g.REACH + 1)])
        h = np.maximum(np.einsum("soe,oef->sf", spans, model.filters).max(axis=0) + model.bias, 0)
        logit = h @ model.out + model.out_bias
        z.append(np.exp(logit) / np.exp(logit).sum())
    assert np.allclose(g.Predictor(model).probabilities(x), z, atol=1e-4)
    assert g.train(x, np.array([0, 1, 0, 1, 1]), ["a", "b"]).bias.tolist() == model.bias.tolist()


def test_cases(spark):
    docs = [(i, w * 30, lang, "s") for i in range(40) for w, lang in [(("the house is ", "en"), ("das haus ist ", "de"))[i % 2]]]
    odd = [(100, None, "en", "s"), (101, "", "en", "s"), (102, "12 34 !?", "de", "s"), (None, "the house", "en", "s"), (104, "das haus ist " * 30_000, None, "s"), (0, docs[0][1], "en", "s")]
    frame = spark.createDataFrame(docs + odd, "doc_id long, text string, lang string, row string")
    got = {}
    for r in g.identify(frame).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert len(got[0]) == 2
    for i in (100, 101, 102):
        assert (got[i][0].lang_pred, got[i][0].score) == ("und", 0.0)
    assert got[104][0].lang_pred == "de" and got[None][0].lang_pred == "en" and not got[None][0].held_out


def test_empty_and_unlabelled(spark):
    kind = "doc_id long, text string, lang string"
    assert g.identify(spark.createDataFrame([], kind)).count() == 0
    rows = g.identify(spark.createDataFrame([(1, "some text", None)], kind)).collect()
    assert [(r.lang_pred, r.score) for r in rows] == [("und", 0.0)]
