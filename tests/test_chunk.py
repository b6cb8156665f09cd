"""Packing, windows and sentence split (C1-C5): FIXTURES goldens and
property tests against a plain restatement of the rule."""

from itertools import accumulate

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusqa.operators.chunk import explode_chunks, pack_chunks, pack_expr, split_sentences

GOLDEN = [
    ([3, 4, 9, 2, 30, 5, 6], 10, 4,
     [(0, 6), (7, 15), (16, 17), (18, 27), (24, 33), (30, 39), (36, 45), (42, 47), (48, 52), (53, 58)]),
    ([10], 10, 4, [(0, 9)]),
    ([11], 10, 4, [(0, 9), (6, 10)]),
    ([14, 3], 10, 4, [(0, 9), (6, 13), (12, 13), (14, 16)]),
    ([250], 150, 100, [(0, 149), (50, 199), (100, 249), (150, 249), (200, 249)]),
]


def restated(lens, cap, ov):
    """The chunks found without carrying a state: sentences that follow one another
    and fit are grouped from each group's first on; windows are cut by place."""
    starts = [sum(lens[:i]) for i in range(len(lens))] if len(lens) < 1000 else list(accumulate([0, *lens[:-1]]))
    out, i = [], 0
    while i < len(lens):
        if lens[i] > cap:
            begin, end = starts[i], starts[i] + lens[i]
            out += [(a, min(a + cap, end) - 1, True) for a in range(begin, end, cap - ov)]
            i += 1
            continue
        j = i + 1
        while j < len(lens) and lens[j] <= cap and starts[j] + lens[j] - starts[i] <= cap:
            j += 1
        out.append((starts[i], starts[j - 1] + lens[j - 1] - 1, False))
        i = j
    return out


@pytest.mark.parametrize("lens,cap,ov,expected", GOLDEN)
def test_packing_goldens(spark, lens, cap, ov, expected):
    df = spark.createDataFrame([(lens, cap)], "lens array<int>, cap int")
    got = df.select(pack_expr("lens", "cap", ov).alias("c")).first().c
    assert [(c.doc_start, c.doc_end) for c in got] == expected
    assert restated(lens, cap, ov) == [(a, b, w) for a, b, w in
                                       [(c.doc_start, c.doc_end, c.is_window) for c in got]]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.integers(1, 60), min_size=1, max_size=25), min_size=1, max_size=8),
       st.integers(11, 40))
def test_packing_properties(spark, docs, cap):
    ov = 10
    df = spark.createDataFrame([(d, cap) for d in docs], "lens array<int>, cap int")
    got = [r.c for r in df.select(pack_expr("lens", "cap", ov).alias("c")).collect()]
    for lens, chunks in zip(docs, got):
        c = [(x.doc_start, x.doc_end, x.is_window) for x in chunks]
        assert c == restated(lens, cap, ov)
        n = sum(lens)
        covered = set()
        for a, b, w in c:
            assert 0 <= a <= b < n
            assert b - a + 1 <= cap                     # within capacity
            covered.update(range(a, b + 1))
        assert covered == set(range(n))                 # every token covered
        plain = [(a, b) for a, b, w in c if not w]
        for (a1, b1), (a2, b2) in zip(plain, plain[1:]):
            assert b1 < a2                              # only windows overlap


def test_sentence_split_ideographic(spark):
    # 。 closes a sentence; the last token closes the final one; blanks and
    # newlines give no token.
    text = "今天天气好。我们去公园。\n晚上回家"
    df = spark.createDataFrame([(1, text)], "docid long, passage string")
    rows = split_sentences(df).orderBy("sent_idx").collect()
    assert [(r.sent_start, r.sent_end, r.sent_len) for r in rows] == [(0, 5, 6), (6, 11, 6), (12, 15, 4)]


def test_pack_chunks_rows(spark):
    text = "一二三。四五六七。八九十一二三四五六七八九十一二。" + "甲乙丙。"
    # sentence lengths 4, 5, 16, 4 (29 tokens); capacity 10, overlap 2
    df = spark.createDataFrame([(7, text, 10)], "docid long, passage string, capacity int")
    packed = pack_chunks(df, "capacity", overlap=2)
    rows = explode_chunks(packed.drop("passage"), keep=["docid", "capacity"]).orderBy("chunk_idx").collect()
    got = [(r.chunk_idx, r.doc_start, r.doc_end, r.is_window) for r in rows]
    assert got == [(0, 0, 8, False), (1, 9, 18, True), (2, 17, 24, True), (3, 25, 28, False)]
    assert [(a, b, w) for _, a, b, w in got] == restated([4, 5, 16, 4], 10, 2)


def test_capacity_must_exceed_overlap(spark):
    df = spark.createDataFrame([(1, "abc.", 100)], "docid long, passage string, capacity int")
    with pytest.raises(Exception):
        pack_chunks(df, "capacity", overlap=100).collect()


def test_one_very_long_text(spark):
    """Five million characters in one document, with sentences of all lengths."""
    text = "一二三。" * 1_000_000 + "长" * 1_000_000 + "。末"
    df = spark.createDataFrame([(1, text, 413)], "docid long, passage string, capacity int")
    rows = explode_chunks(pack_chunks(df, "capacity").drop("passage"), keep=["docid"]).orderBy("chunk_idx").collect()
    assert [(r.doc_start, r.doc_end, r.is_window) for r in rows] == restated([4] * 1_000_000 + [1_000_001, 1], 413, 100)
