import hashlib

import numpy as np
import pytest

from corpusqa.llm import vector_codes as v
from corpusqa.llm.queries import op13_vector_codes


def plain(rows, parts=16, entries=64, rounds=2):
    """{place: (code, error)} and the digest, by the definition."""
    x = np.array([[int(np.floor(256 * float(c))) for c in r[1]] for r in rows])
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, x[i].tolist()))
    codes, errors, books = [], np.zeros(len(rows), int), []
    for cut in np.array_split(np.arange(x.shape[1]), parts):
        own = x[:, cut]
        book = own[order[:entries]].copy()
        for step in range(rounds + 1):
            d = ((own[:, None] - book) ** 2).sum(axis=2)
            entry = d.argmin(axis=1)
            if step < rounds:
                for e in set(entry.tolist()):
                    book[e] = [sum(c) // len(c) for c in own[entry == e].T.tolist()]
        codes.append(entry)
        errors += d.min(axis=1)
        books.append(book)
    text = ",".join(str(n) for b in books for n in b.ravel().tolist())
    return ["".join(f"{c:02x}" for c in row) for row in np.array(codes).T], errors.tolist(), hashlib.sha256(text.encode()).hexdigest()


def write(spark, tmp_path, rows):
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<float>, label int, v string, dim string")
    frame.write.parquet(f"{tmp_path}/embeddings.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("dim", [32, 35, 7])
def test_query_equals_brute_force(spark, tmp_path, dim):
    rng = np.random.default_rng(dim)
    rows = [(i * 3 % 400, [round(float(c), 1) for c in rng.normal(0, 0.4, dim)], None if i % 5 == 0 else i % 3) for i in range(400)]
    rows += [(1000 + i, rows[0][1], 1) for i in range(150)]  # a hot vector
    odd = [(2000, None, 1), (2001, [None] + [0.0] * (dim - 1), 1), (2002, [float("nan")] * dim, 1), (2003, [float("inf")] * dim, 2)]
    got = {r.vec_id: r for r in op13_vector_codes(spark, write(spark, tmp_path, rows + odd)).collect()}
    codes, errors, sha = plain(rows)
    labels = {}
    for r, e in zip(rows, errors):
        labels[r[2]] = labels.get(r[2], 0) + e
    assert got.keys() == {r[0] for r in rows}
    for r, code, e in zip(rows, codes, errors):
        assert (got[r[0]].code, got[r[0]].error, got[r[0]].label_error, got[r[0]].codebooks_sha256) == (code, e, labels[r[2]], sha)


def test_tree_finds_the_nearest_and_leaves_out_subtrees():
    rng = np.random.default_rng(1)
    centres = rng.integers(-200, 200, (8, 4))
    points = np.concatenate([c + rng.integers(-6, 7, (8, 4)) for c in centres])
    points[50] = points[3]  # equal entries: the lower index
    queries = np.concatenate([points, points[rng.integers(0, 64, 2000)] + rng.integers(-4, 5, (2000, 4))])
    tree = v.Gnat(points)
    index, best = tree.nearest(queries)
    d = ((queries[:, None] - points) ** 2).sum(axis=2)
    assert (index == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    assert tree.compared < 0.5 * len(queries) * len(points)
    same = v.Gnat(np.zeros((64, 4), np.int64))
    assert same.nearest(queries)[0].max() == 0
    grid = np.array([[a, b] for a in range(8) for b in range(8)]) * 2  # many equal distances
    around = np.array([[a, b] for a in range(-1, 17) for b in range(-1, 17)])
    assert (v.Gnat(grid).nearest(around)[0] == ((around[:, None] - grid) ** 2).sum(axis=2).argmin(axis=1)).all()


def test_cases(spark, tmp_path):
    rows = [(1, [0.5, 1.0], None), (1, [0.5, 0.25], None), (None, [1.0, 1.0], 2), (4, [], 2), (5, [1e30, -1e30], 2), (6, [2.0], 3)]
    got = op13_vector_codes(spark, write(spark, tmp_path, rows)).collect()
    assert len(got) == len(rows)
    assert {len(r.code) for r in got} == {32}
    assert sum(r.error for r in got) == 0  # fewer vectors than entries: each is one
    assert len({r.codebooks_sha256 for r in got}) == 3
    assert v.encode(spark.createDataFrame([], "vec_id long, embedding array<float>, label int"))[0].count() == 0
