import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corpusqa.llm import packing as p
from corpusqa.llm.queries import op4_best_fit_packing
from tests.llm.conftest import SMALL

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def check(rows, capacity):
    """Gapless sequences within the capacity; returns their number."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by)


def test_query_equals_tokenizer(spark, documents, tokenizer):
    want = {}
    for doc, text, _ in documents:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        for k in range(0, len(ids), 4096):
            own = ids[k : k + 4096]
            want[doc, k // 4096] = (k, len(own), zlib.crc32(own.tobytes()))
    rows = op4_best_fit_packing(spark, SMALL).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    least = -(-sum(v[1] for v in want.values()) // 4096)
    assert check(rows, 4096) <= least * 1.05 + 1


def test_encoder_equals_tokenizer(tokenizer):
    encode = p.Encoder(PATH)
    rng = random.Random(2)
    parts = ["The", "don't", "I'LL", "naïve", "ÉCOLE", "12.5", "²½", "--", "a_b", "<|endoftext|>", "<|", "x" * 150, "\t", "\n\n", "  ", "日本", "Σας", "é", "İ", "\x1c", "\x1f", "\xa0", "\x85", "\x0b", "ß", "ñ's", "&&&", "˿", ""]
    texts = [rng.choice(["", " ", "\n"]).join(rng.choices(parts, k=8)) for _ in range(400)] + ["", " ", *parts]
    for t in texts:
        assert np.frombuffer(encode(t), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_plan_fills_exactly_where_sums_allow():
    # pairs and triples that fill 100 exactly, by construction
    rng = random.Random(4)
    counts = Counter()
    for _ in range(500):
        a = rng.randrange(1, 98)
        b = rng.randrange(1, 99 - a)
        counts.update([a, b, 100 - a - b])
    plan = p.Plan(dict(counts), 100)
    assert not plan.left.any()
    assert plan.sequences <= 505
    for lengths in ({7: 1000}, {100: 3}, {1: 12345}, {51: 10, 50: 3}, {60: 5, 40: 7, 3: 11, 1: 2}):
        plan = p.Plan(lengths, 100)
        assert not plan.left.any()
        used = Counter()
        for e in plan.entries:
            used[e.length] += e.uses * e.times
        assert used == lengths
    assert p.Plan({51: 10, 50: 3}, 100).sequences == 12
    assert p.Plan({}, 100).sequences == 0
    with pytest.raises(ValueError):
        p.Plan({101: 1}, 100)


def test_pack_any_lengths(spark):
    rng = random.Random(6)
    rows = [(i % 900, rng.choice([3, 3, 3, rng.randrange(1, 65)]), "x") for i in range(1000)]
    frame = spark.createDataFrame(rows, "id long, length int, item string")
    out = p.pack(frame, capacity=64)
    assert out.columns == ["id", "length", "item", "sequence_id", "offset"]
    got = out.collect()
    assert Counter((r.id, r.length) for r in got) == Counter((r[0], r[1]) for r in rows)
    assert check(got, 64) <= -(-sum(r[1] for r in rows) // 64) + 2
    assert p.pack(frame.filter("false"), capacity=64).count() == 0


def test_cases(spark, tokenizer):
    docs = [(1, None), (2, ""), (2, ""), (None, "a b"), (4, "one two three " * 40_000), (4, "other")]
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, row string")
    rows = p.pack_documents(frame, PATH).collect()
    assert Counter(r.doc_id for r in rows if r.length == 1) == {1: 1, 2: 2}
    long = [r for r in rows if r.doc_id == 4 and r.start + r.length > 2]
    assert sum(r.length for r in long) == 120_001 and sorted(r.piece for r in long) == list(range(30))
    check(rows, 4096)
    assert p.pack_documents(frame.filter("false"), PATH).count() == 0
    ids = p.token_pieces(frame, PATH, with_ids=True).filter("row.doc_id is null").first()
    assert np.frombuffer(bytes(ids.ids), "<u4").tolist() == [*tokenizer.encode("a b", add_special_tokens=False).ids, 1]
