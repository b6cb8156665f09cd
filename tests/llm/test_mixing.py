import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusqa.llm import mixing as m
from corpusqa.llm.queries import op11_mixing
from tests.llm.conftest import SMALL


def plain_targets(sizes, weights=(5, 2, 1)):
    """By the rule: share, stop, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, left = dict.fromkeys(sizes, 0.0), set(sizes), float(sum(sizes.values()))
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += left * weight[s] / total
        left = sum(max(0, target[s] - 3 * sizes[s]) for s in open_)
        for s in list(open_):
            if target[s] >= 3 * sizes[s]:
                target[s] = 3.0 * sizes[s]
                open_.discard(s)
    return target


def highest(units, seats):
    """Sainte-Laguë, a seat at a time."""
    quota = dict.fromkeys([u for u, _, _ in units], 0)
    for _ in range(min(seats, sum(most for _, _, most in units))):
        u = max((v / (2 * quota[u] + 1), [-ord(c) for c in str(u)], u) for u, v, most in units if v and quota[u] < most)[-1]
        quota[u] += 1
    return quota


def plain_mix(rows, block, shard):
    """{doc_id: (size, target, taken)}, block by block."""
    h = lambda *p: int(hashlib.md5(":".join(map(str, p)).encode()).hexdigest()[:8], 16)
    size = {i: len(re.findall(r"[^\x20\x09-\x0d]+", t or "")) for i, t, _ in rows}
    sizes = Counter()
    for i, _, s in rows:
        sizes[s] += size[i]
    target = plain_targets(sizes)
    quota = highest([(s, target[s], -(-3 * n // block)) for s, n in sizes.items()], round(sum(sizes.values()) / block))
    taken = dict.fromkeys(size, 0)
    for s, n in sizes.items():
        shards = {}
        for i, _, of in rows:
            if of == s and size[i]:
                shards.setdefault(h(m.SEED, i) % -(-n // shard), []).append(i)
        words = {u: sum(size[i] for i in own) for u, own in shards.items()}
        inner = highest([(u, w, -(-3 * w // block)) for u, w in words.items()], quota[s])
        for u, own in shards.items():
            laid = [i for i in sorted(own, key=lambda i: (h(m.SEED, i), i)) for _ in range(size[i])]
            full, turn = words[u] // block, h(m.SEED, "s" + s if s is not None else "", u)
            blocks = [laid[k * block : (k + 1) * block] for k in sorted(range(full), key=lambda k: (k * 2654435761 + turn) % full)]
            order = [i for b in blocks for i in b] + laid[full * block :]
            for place in range(min(inner[u] * block, 3 * words[u])):
                taken[order[place % len(order)]] += 1
    return {i: (size[i], target[s], taken[i]) for i, _, s in rows}


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, source string, size string, `group` int")


@pytest.mark.parametrize("block, shard, few", [(4, 60, 1000), (4, 60, 3), (64, 1 << 16, 1000)])
def test_equals_plain(spark, monkeypatch, block, shard, few):
    monkeypatch.setattr(m, "FEW", few)
    monkeypatch.setattr(m, "GRID", 8)
    sources = ["b", "b", "b", "a", "é", "Z", None, "b", "c"]
    rows = [(i, " ".join(["word"] * ((i * 7) % 23)) + ("\t" if i % 2 else " \n"), sources[i % 9]) for i in range(200)]
    rows += [(900, None, "a"), (901, "", "empty"), (902, " \t ", None), (903, "w " * 700, "c"), (904, "one", "tiny")]
    out = m.mix(frame(spark, rows), block=block, shard=shard)
    got = {r.row.doc_id: (r.size, round(r.target, 6), r.taken) for r in out.collect()}
    assert got == {i: (n, round(t, 6), k) for i, (n, t, k) in plain_mix(rows, block, shard).items()}
    assert out.schema["row"].dataType.names == ["doc_id", "source", "size", "group"]


def test_targets_are_met(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    source = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    rows = op11_mixing(spark, SMALL).collect()
    target = {source[r.doc_id]: r.target for r in rows}
    taken = Counter()
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        taken[source[r.doc_id]] += r.taken
    for s, t in target.items():
        assert abs(taken[s] - t) <= m.BLOCK, s
    assert sorted(map(str, rows)) == sorted(map(str, op11_mixing(spark, SMALL).collect()))


def test_cases(spark):
    rows = [(1, "twice the same", "a")] * 3 + [(None, "no id", None), (None, "no id either", None), (5, "long " * 300_000, "b")]
    got = m.mix(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    assert all(r.taken <= 3 * r.size for r in got)
    assert sum(r.target for r in got if r.source_size > 9) == pytest.approx(300_014 - 3 * 14)
    assert m.mix(frame(spark, [])).count() == 0
    assert [r.taken for r in m.mix(frame(spark, [(1, None, None), (2, "", "a")])).collect()] == [0, 0]


def test_many_seats(spark):
    units = spark.range(3000).select(F.lit("g").alias("group"), "id", (F.col("id") * F.col("id") + 1).alias("votes"), F.lit(10_000_000).alias("most")).withColumnRenamed("id", "unit")
    seats = spark.createDataFrame([("g", 50_000_000)], "group string, seats long")
    quota = {r.unit: r.quota for r in m.apportion(units, seats).collect()}
    assert sum(quota.values()) == 50_000_000
    # no seat would move: the least quotient that has one is no less than the greatest that has none
    assert min((u * u + 1) / (2 * q - 1) for u, q in quota.items() if q) >= max((u * u + 1) / (2 * quota.get(u, 0) + 1) for u in range(3000))
