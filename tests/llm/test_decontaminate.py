import re

from corpusqa.llm import decontaminate as d
from corpusqa.llm.queries import op6_decontaminate
from tests.llm.conftest import SMALL, sha

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def fold(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=13):
    """doc_id -> (n_words, n_hit, item ids), by hashing the windows of each length."""
    out = {}
    wanted = {}
    for item, text in items:
        own = fold(text)
        n = min(window, len(own))
        for i in range(len(own) - n + 1 if n else 0):
            wanted.setdefault(n, {}).setdefault(tuple(own[i : i + n]), set()).add(str(item))
    for doc, text in docs:
        own = fold(text)
        hit, found = set(), set()
        for n, windows in wanted.items():
            for i in range(len(own) - n + 1):
                ids = windows.get(tuple(own[i : i + n]))
                if ids:
                    hit.update(range(i, i + n))
                    found |= ids
        out[doc] = (len(own), len(hit), sorted(found))
    return out


def test_query_equals_brute_force(spark, documents):
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    want = brute([(i, t) for i, t, _ in documents], items)
    rows = {r.doc_id: r for r in op6_decontaminate(spark, SMALL).collect()}
    assert len(rows) == len(documents)
    assert any(r.contaminated for r in rows.values())
    for doc, (n, hit, found) in want.items():
        r = rows[doc]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == (n, hit, len(found), sha(",".join(found)))
        assert r.contaminated == (hit > 0 and 20 * hit >= n)


def test_cases(spark, monkeypatch):
    phrase = " ".join(f"w{i}" for i in range(15))
    gap = phrase.replace("w7", "w7 extra")
    docs = [
        (1, phrase.upper(), "x"),
        (2, "lead " + phrase + " tail " + phrase, None),
        (3, gap, "x"),
        (4, None, None),
        (5, "", "x"),
        (6, "short one", "x"),
        (6, "short one", "x"),
        (None, "is short, one!", "x"),
        (8, "w1 " * 40_000, "x"),
    ]
    # clashing names beside the text
    frame = spark.createDataFrame(docs, "doc_id long, text string, row string")
    items = [("a", phrase), ("b", "short one"), ("c", None), ("d", "--"), ("a", phrase)]
    bench = spark.createDataFrame(items, "item_id string, text string")
    want = [(r[0], v) for r, v in zip(docs, [brute([(0, t)], items)[0] for _, t, _ in docs])]
    for words, shard in ((200_000, 1 << 20), (3, 50)):
        monkeypatch.setattr(d, "BATCH_WORDS", words)
        monkeypatch.setattr(d, "SHARD_TOKENS", shard)
        rows = d.find(frame, bench).collect()
        got = [(r.row.doc_id, (r.n_words, r.n_hit, r["items"])) for r in rows]
        assert sorted(map(str, got)) == sorted(map(str, want))
        assert {r.row.doc_id for r in rows if r.near_items == ["a"]} == {3}
        assert all(0 <= h.start < h.end <= r.n_words for r in rows for h in r.hits)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert d.find(docs, items).count() == 0
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert [(r.n_words, r.n_hit) for r in d.find(one, items).collect()] == [(2, 0)]


def test_clean_judges_rows_by_text(spark):
    docs = spark.createDataFrame([(1, "alpha beta", "k"), (1, "other words here", "k"), (2, None, "k")], "doc_id long, text string, own_id string")
    items = spark.createDataFrame([(1, "alpha beta")], "item_id long, text string")
    kept = d.clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, "other words here"), (2, None)]
