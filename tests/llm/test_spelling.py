import re
import zlib
from collections import Counter

import numpy as np
import pytest

from corpusqa.llm import spelling as s
from corpusqa.llm.queries import op12_spelling
from tests.llm.conftest import SMALL


def plain_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    if len(a) == len(b):
        return a[k + 1 :] == b[k + 1 :]
    return a[k + 1 :] == b[k:] if len(a) > len(b) else a[k:] == b[k + 1 :]


def plain(docs):
    """{word: (form, root, n, n_near, form_n)}, every pair of words compared."""
    count = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}
    by_size = {}
    for w in words:
        by_size.setdefault(len(w), []).append(w)
    near = {w: [x for k in (-1, 0, 1) for x in by_size.get(len(w) + k, []) if plain_edit(w, x)] for w in words}
    form = {}
    for w, own in near.items():
        best = min(own, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def found(out):
    rows = out.collect()
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(got) == len(rows)
    return got


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    want = plain(docs)
    assert found(op12_spelling(spark, SMALL)) == want
    assert any(v[0] for v in want.values()) and any(v[3] for v in want.values())


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int")


def test_variants_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    base = ["".join(rng.choice(list("abcdefghéßÿ×"), int(rng.integers(7, 12)))) for _ in range(120)]
    rows = []
    for i in range(400):
        words = []
        for w in rng.choice(base, 30, p=(p := 1 / np.arange(1, 121)) / p.sum()):
            if rng.random() < 0.1:
                k = int(rng.integers(0, len(w)))
                w = [w[:k] + w[k + 1 :], w[:k] + "x" + w[k:], w[:k] + "q" + w[k + 1 :]][int(rng.integers(3))]
            words.append(w.upper() if rng.random() < 0.1 and w.isascii() else w)
        rows.append((i, " ".join(words)))
    rows += [(500, "rotator rotatorr rotatorrs rotatorrst 7rotator-rotator")] * 3  # a chain, and rows that repeat
    rows += [(501, "rotator " * 4000 + "rotatorr " * 350 + "rotatorrs " * 30), (3, None), (4, ""), (None, "without an id, without an id")]
    rows += [(5, "aaaaaaa aaaaaaaa " * 40), (6, "aaaaaaab")] * 3
    want = plain(rows)
    assert found(s.variants(frame(spark, rows))) == want
    assert [want[w][0] for w in ("rotatorrst", "rotatorrs", "rotatorr")] == ["rotatorrs", "rotatorr", "rotator"]
    assert want["rotatorrst"][1] == "rotator"


def test_long_words_and_empty_table(spark):
    long = "abcdefgh" * 40_000
    rows = [(1, f"{long} {long}x"), (2, f"{long}\n{long}x and {long}")]
    got = found(s.variants(frame(spark, rows), noise=None))
    assert {len(w): v[2:4] for w, v in got.items()} == {len(long): (3, 1), len(long) + 1: (2, 1)}
    assert found(s.variants(frame(spark, []))) == {}


@pytest.mark.parametrize("word", ["abcdefg", "aaaaaaa", "étéétés"])
def test_neighbourhood_is_full(word):
    """Whatever the edit, the reduced word of the result is a neighbour."""
    keys = set(np.concatenate(list(s.neighbourhood(["xyzabca", word])), axis=1)[1].tolist())
    letters = "abcdefghijklmnopqrstuvwxyzéÿ"
    for k in range(len(word) + 1):
        for c in letters:
            assert s.reduced([word[:k] + c + word[k:]])[0] in keys
            assert k == len(word) or s.reduced([word[:k] + c + word[k + 1 :]])[0] in keys
        assert k == len(word) or s.reduced([word[:k] + word[k + 1 :]])[0] in keys


def test_parts_of_a_neighbourhood(monkeypatch):
    keys = lambda: set(np.concatenate(list(s.neighbourhood(["abcabcabcabcxyz"])), axis=1)[0].tolist())
    whole = keys()
    monkeypatch.setattr(s, "CHUNK", 32)
    assert keys() == whole
    words = ["abcdefg", "abcdefgh", "xbcdefg", "abcdefgh"] * 5
    assert sorted(i for at in s._by_length(words) for i in at) == list(range(20))
