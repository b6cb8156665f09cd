import duckdb
import pytest
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from corpusqa.llm import quality
from corpusqa.llm.oracle import LINE_DEDUP
from tests.llm.conftest import SMALL
from tests.llm.test_decontaminate import brute
from tests.llm.test_packing import check
from tests.llm.test_simhash import groups, plain

KIND = "doc_id long, text string, lang string, source string, n_chars long"


def near_dedup(rows):
    rows = sorted(rows, key=lambda r: r[0])
    first = groups([plain(r[1]) for r in rows])
    return [r for i, r in enumerate(rows) if first[i] == i]


def line_dedup(rows):
    import pandas as pd

    con = duckdb.connect()
    con.register("documents", pd.DataFrame([(r[0], r[1]) for r in rows], columns=["doc_id", "text"]))
    new = {i: (text, dropped) for i, text, _, dropped in con.sql(f"SELECT doc_id, text, n_lines, n_dropped FROM ({LINE_DEDUP})").fetchall()}
    out = []
    for r in rows:
        text, dropped = new[r[0]]
        if dropped and not text.strip():
            continue
        out.append((r[0], text, r[2], r[3], len(text) if dropped else r[4]))
    return out


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    assert [n for n, _ in pipeline.STAGES] == ["quality_classifier", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
    at, rows, last = docs, None, None
    for k, (name, stage) in enumerate(pipeline.STAGES):
        before = [tuple(r) for r in at.collect()]
        out = pipeline.stored(stage(spark, at, SMALL), name)
        rows = [tuple(r) for r in out.collect()]
        if k < 4:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        if k == 0:
            keep = {r.row.doc_id for r in quality.select(docs, spark.read.parquet(f"{SMALL}/labels.parquet")).filter("keep").collect()}
            assert sorted(rows) == sorted(r for r in before if r[0] in keep) and 0 < len(rows) < len(before)
        elif k == 1:
            assert sorted(rows) == sorted(line_dedup(before))
        elif k == 2:
            assert sorted(rows) == sorted(near_dedup(before)) and len(rows) < len(before)
        elif k == 3:
            found = brute([(r[0], r[1]) for r in before], items)
            assert sorted(rows) == sorted(r for r in before if not (found[r[0]][1] and 20 * found[r[0]][1] >= found[r[0]][0]))
        else:
            tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
            placed = out.collect()
            check(placed, 4096)
            size = {}
            for r in placed:
                size[r.doc_id] = size.get(r.doc_id, 0) + r.length
            assert size == {r[0]: len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in before}
        at, last = out, rows
    assert sorted(tuple(r)[:5] for r in pipeline.run(spark, SMALL).collect()) == sorted(r[:5] for r in last)


@pytest.fixture()
def tables(spark, tmp_path):
    def write(docs, labels, items):
        spark.createDataFrame(docs, KIND + ", row string, keep string").write.parquet(f"{tmp_path}/documents.parquet")
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
        spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
        return str(tmp_path)

    return write


def test_odd_rows(spark, tables):
    passage = " ".join(f"word{i} of the passage" for i in range(20))
    docs = [
        (1, None, None, None, None), (2, "", "en", "s", 0), (3, " \n ", "en", "s", 3),
        (4, "a copy of some text in words", "en", "s", 28), (5, "a copy of some text in words", "en", "s", 28),
        (6, "twice the very same row here", "en", "s", 28), (6, "twice the very same row here", "en", "s", 28),
        (None, "no id but some words of its own", "en", "s", 31),
        (7, "x " * 100_000, "en", "s", 200_000), (8, passage, "en", "s", len(passage)),
    ]
    path = tables([(*d, "x", "y") for d in docs], [], [(1, passage), (2, None), (3, "")])
    at = spark.read.parquet(f"{path}/documents.parquet")
    kept = []
    for name, stage in pipeline.STAGES[:-1]:
        at = pipeline.stored(stage(spark, at, path), name)
        kept.append(sorted(str(r.doc_id) for r in at.collect()))
        assert at.columns[-2:] == ["row", "keep"]
    assert len(kept[0]) == len(docs)  # no labels: nothing is rejected
    assert len(kept[1]) == len(docs)
    assert kept[2] == sorted(map(str, [1, 4, 6, None, 7, 8]))
    assert kept[3] == sorted(map(str, [1, 4, 6, None, 7]))
    rows = pipeline.run(spark, path).collect()
    assert {str(r.doc_id) for r in rows} == set(kept[3])


def test_empty_tables(spark, tables):
    assert pipeline.run(spark, tables([], [], [])).count() == 0
