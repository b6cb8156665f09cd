import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusqa.llm import exact_topk as t


def brute(q, q_ids, x, x_ids, k):
    out = []
    for v, own in zip(q, q_ids):
        scored = [(sum(int(a) * int(b) for a, b in zip(v, w)), -i) for w, i in zip(x, x_ids) if i != own]
        out.append(sorted(scored, reverse=True)[:k])
    return out


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 300), st.integers(1, 8), st.integers(1, 4), st.sampled_from([1, 3, 200, 10**9]))
def test_walk_equals_brute_force(seed, n, k, dim, top):
    rng = np.random.default_rng(seed)
    x = rng.integers(-top, top + 1, (n, dim))
    ids = rng.permutation(n).tolist()
    m = max(1, n // 3)
    kind = object if top == 10**9 else float
    queries, data = t.Points(x[:m].astype(kind), ids[:m]), t.Points(x.astype(kind), ids)
    want = brute(x[:m], ids[:m], x, ids, k)
    for floor in (None, [own[-1][0] if len(own) == k else -np.inf for own in want]):
        found = t.dual_search(queries, data, k, floor)
        assert [[(s, -i) for s, i in own] for own in found] == want


def test_tree_covers_its_points():
    x = np.random.default_rng(1).normal(size=(1000, 5))
    tree = t.CoverTree(x)
    assert sorted(tree.order.tolist()) == list(range(1000))
    for centre, radius, (a, b), children in zip(tree.centre, tree.radius, tree.span, tree.children):
        assert (np.linalg.norm(x[tree.order[a:b]] - x[centre], axis=1) <= radius + 1e-9).all()
        if children:
            assert sorted(tree.span[c] for c in children)[0][0] == a and sum(tree.span[c][1] - tree.span[c][0] for c in children) == b - a
            centres = x[[tree.centre[c] for c in children]]
            gaps = np.linalg.norm(centres[:, None] - centres[None], axis=2) + np.eye(len(centres)) * 9
            assert gaps.min() >= max(tree.radius[c] for c in children) - 1e-9
        else:
            assert b - a <= t.LEAF or radius == 0


def clustered(rng, n, dim=16, groups=12):
    """Whole-number vectors of one length about ``groups`` directions."""
    at = rng.normal(size=(groups, dim))
    at *= 2000 / np.linalg.norm(at, axis=1)[:, None]
    return np.floor(at[rng.integers(groups, size=n)] + rng.normal(scale=40, size=(n, dim)))


def test_clusters_are_pruned():
    x = clustered(np.random.default_rng(4), 4000)
    ids, tally = list(range(4000)), []
    found = t.dual_search(t.Points(x[::50], ids[::50]), t.Points(x, ids), 5, tally=tally)
    assert sum(tally) < 80 * 4000 / 4
    assert [[(s, -i) for s, i in own] for own in found] == brute(x[::50], ids[::50], x, ids, 5)


def test_other_shards_are_ruled_out_by_floors(spark, monkeypatch):
    monkeypatch.setattr(t, "SHARD_ROWS", 100)
    monkeypatch.setattr(t, "LIST_BYTES", 2000)  # several lists of queries
    x = clustered(np.random.default_rng(5), 2000) / 256
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    walked, walks = [], t._walks
    monkeypatch.setattr(t, "_walks", lambda *a, own: walked.append((own, walks(*a, own=own))) or walked[-1][1])
    got = {}
    for r in t.search(frame, F.col("vec_id") % 50 == 0, 5).collect():
        got.setdefault(r.query_id, []).append((r.score, -r.vec_id))
    whole = np.floor(x * 256)
    ids = list(range(2000))
    assert [sorted(got[i], reverse=True) for i in ids[::50]] == brute(whole[::50], ids[::50], whole, ids, 5)
    assert len(walked) > 2 and {own for own, _ in walked} == {True, False}


def test_search_and_cases(spark, monkeypatch):
    monkeypatch.setattr(t, "SHARD_ROWS", 40)
    monkeypatch.setattr(t, "BLOCK_ROWS", 4)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(200)]
    rows += [(i, rows[0][1]) for i in range(200, 260)]  # ties
    rows += [(300, None), (350, [1.0, None, 2.0, 3.0, 4.0, 5.0]), (400, [float("nan")] * 6), (450, [float("inf")] * 6), (None, [1.0] * 6), (50, rows[50][1])]
    rows += [(500, [1.0, 2.0]), (501, [3.0, 1.0])]  # of their own
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, rows string")
    got = {}
    for r in t.search(frame, F.col("vec_id") % 50 == 0, 5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    usable = [(i, [int(np.floor(256 * e)) for e in v]) for i, v in rows if i is not None and v and all(e is not None and np.isfinite(e) for e in v)]
    want = {}
    for i, v in usable:
        if i % 50 == 0:
            own = [(j, w) for j, w in usable if len(w) == len(v)]
            best = brute([v], [i], [w for _, w in own], [j for j, _ in own], 5)[0]
            want[i] = [(n + 1, -j, s) for n, (s, j) in enumerate(best)]
    assert {k: sorted(v) for k, v in got.items()} == want
    assert len(want[500]) == 1
    assert t.search(frame.filter("false"), F.col("vec_id") % 50 == 0, 5).count() == 0
