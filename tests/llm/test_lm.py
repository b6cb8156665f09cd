import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from corpusqa.llm import lm
from corpusqa.llm.queries import op10_lm_scoring
from tests.llm.conftest import SMALL, crc


def split(text):
    return lm.tokens((text or "").encode())


def base_scores(docs):
    counts = Counter()
    for i, t in docs:
        if crc(i) % 10:
            counts.update(split(t))
    total, distinct = sum(counts.values()), len(counts)
    out = {}
    for i, t in docs:
        own = split(t)
        score = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in own)
        out[i] = (crc(i) % 10 == 0, len(own), sum(counts[w] > 0 for w in own), total, score)
    return out, counts


def plain_model(docs, counts, order=3):
    """P(word | history) by the definition of interpolated discounting, word by word."""
    total, distinct = sum(counts.values()), len(counts)
    kept = {}
    for n in range(2, order + 1):
        found = Counter()
        for i, t in docs:
            if crc(i) % 10:
                own = split(t)
                for g in zip(*[own[k:] for k in range(n)]):
                    found[g] += 1
        kept |= {g: c for g, c in found.items() if c >= lm.LEAST[n - 1]}
    heirs = {}
    for g, c in kept.items():
        heirs.setdefault(g[:-1], []).append(max(c - lm.DISCOUNT, 0))
    size = lambda h: counts[h[0]] if len(h) == 1 else kept[h]

    def prob(w, h):
        if not h:
            return (counts[w] + 0.1) / (total + 0.1 * (distinct + 1))
        if h not in heirs:
            return prob(w, h[1:])
        own = max(kept.get((*h, w), 0) - lm.DISCOUNT, 0) / size(h)
        return own + max(1 - sum(heirs[h]) / size(h), 1e-12) * prob(w, h[1:])

    def score(text):
        own, out = split(text), 0.0
        for i, w in enumerate(own):
            out += math.log10(prob(w, tuple(own[max(0, i - order + 1) : i])))
        return out

    return score


def test_query_equals_brute_force(spark, documents):
    docs = [(i, t) for i, t, _ in documents]
    want, counts = base_scores(docs)
    score = plain_model(docs, counts)
    rows = {r.doc_id: r for r in op10_lm_scoring(spark, SMALL).collect()}
    assert rows.keys() == want.keys()
    texts = dict(docs)
    for i, (held, n, known, total, base) in want.items():
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert math.isclose(r.score, score(texts[i]), rel_tol=1e-9)
    held = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_probabilities_sum_to_one():
    """From every state, over all words and one never seen."""
    words, grams = {"a": 6, "b": 4, "c": 2, "": 3}, {"ab": 3, "ba": 2, "b": 2, "aba": 3}
    h = lm._Words()
    of = lambda g: h[g.encode()]
    two = lambda x, y: int(lm._hash_long(np.uint64([y]), lm._hash_long(np.uint64([x]), np.uint64(42)))[0])
    pair = lambda x, y: two(of(x), of(y))
    rows = {of(w): (n, 0.0) for w, n in words.items()}
    rows[of("a")], rows[of("b")] = (6, 2.5), (4, 3.0)
    rows |= {pair("a", "b"): (3, 2.5), pair("b", "a"): (2, 0.0), pair("b", ""): (2, 0.0)}
    rows[two(pair("a", "b"), pair("b", "a"))] = (3, 0.0)
    arcs = lm.Arcs(np.array(list(rows), np.uint64), *(np.array(c) for c in zip(*rows.values())))
    seen = set()
    for history in ([], ["a"], ["b"], ["a", "b"], ["c", "b"], ["x"]):
        def score(more):
            own = np.array([of(w) for w in [*history, *more]], np.uint64)
            return lm.walk(own, np.array([len(own)]), [arcs], 3, 15, 4)[0][0] if len(own) else 0.0

        share = [10 ** (score([w]) - score([])) for w in [*words, "never"]]
        assert math.isclose(sum(share), 1, rel_tol=1e-9), history
        seen.add(round(share[0], 9))
    assert len(grams) == 4 and len(seen) > 3


def test_cases(spark):
    long = "alpha beta gamma " * 50_000
    docs = [(1, "A a b"), (2, None), (3, ""), (4, "b never"), (4, "b never"), (None, "a b"), (7, long), (16, "new words here")]
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, uid string")
    rows = lm.score_documents(frame).collect()
    assert len(rows) == len(docs)
    counts = Counter()
    for i, t in docs:
        if i is None or crc(i) % 10:
            counts.update(split(t))
    for r in rows:
        assert r.train_tokens == sum(counts.values())
        assert math.isfinite(r.score)
    assert {r.doc_id: r.n_tokens for r in rows}[2] == 1
    assert not [r for r in rows if r.doc_id is None][0].held_out
    assert lm.score_documents(frame.filter("false")).count() == 0


def test_rare_grams_are_kept_in_a_large_corpus(spark, monkeypatch):
    """An n-gram that occurs often enough counts however many tokens there are; neither
    the broadcasts nor the chunks change a score."""
    filler = "alpha beta gamma delta " * 75_000
    docs = [(1, filler), (2, filler), (3, "quick amber foxes sleep"), (5, "quick amber foxes dream"), (6, "foxes amber quick"), (8, None), (9, "quick amber foxes")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(lm, "crc32_mod", lambda col, n: F.when(F.col(col) < 7, F.lit(1)).otherwise(0))
    counts = Counter(w for i, t in docs if i < 7 for w in split(t))
    assert 2 < 1e-5 * sum(counts.values())  # the words of the rare phrase
    monkeypatch.setitem(globals(), "crc", lambda i: int(i < 7))
    want = plain_model(docs, counts)
    for top, sieve, chunk in ((lm.TOP_SHARE, lm.SIEVE, lm.CHUNK), (2.0, 8, 2)):
        monkeypatch.setattr(lm, "TOP_SHARE", top)
        monkeypatch.setattr(lm, "SIEVE", sieve)
        monkeypatch.setattr(lm, "CHUNK", chunk)
        rows = {r.doc_id: r for r in lm.score_documents(frame).collect()}
        for i, t in docs:
            assert math.isclose(rows[i].score, want(t), rel_tol=1e-9, abs_tol=1e-5), (i, top, sieve)
        assert rows[3].score > rows[3].base_score + 5


def test_ngrams_do_not_become_rows(spark, monkeypatch):
    """What is written between the steps has a row for each chunk and bucket, however many
    n-grams there are; single n-grams as rows took more memory and disk than there is."""
    docs = [(i, " ".join(f"w{i * k % 30011}" for k in range(30_000))) for i in range(1, 4)] * 2
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    written, store = [], lm.stored

    def counted(df, name):
        out = store(df, name)
        written.append(out.count())
        return out

    monkeypatch.setattr(lm, "stored", counted)
    assert lm.score_documents(frame).count() == 6
    assert written and sum(written) < 1000


def test_chunks_of_one_text(spark, monkeypatch):
    """A chunk may have no n-grams of higher orders; how texts are dealt changes no score."""
    monkeypatch.setattr(lm, "CHUNK", 1)
    docs = [(1, "a b c"), (2, "a b c"), (3, "a b c d"), (4, "a"), (5, ""), (6, None), (7, "b c Éé d"), (7, "b c d"), (8, "a b c a b c")] * 2
    want, counts = base_scores(docs)
    score = plain_model(docs, counts)
    rows = lm.score_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    got = sorted((r.doc_id, r.n_tokens, round(r.score, 9), r.train_tokens) for r in rows)
    assert got == sorted((i, len(split(t)), round(score(t), 9), want[i][3]) for i, t in docs)


def test_packed_numbers_come_back():
    for values in (np.array([], np.uint64), np.array([0, 2**64 - 1, 5], np.uint64), np.array([True, False]), np.array([-1.5, 0.0])):
        assert np.array_equal(lm._unpack(lm._pack(values), values.dtype), values)
