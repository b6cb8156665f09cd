import itertools
import random

import numpy as np
import xxhash

from corpusqa.llm import simhash as s
from corpusqa.llm.queries import op9_simhash
from tests.llm.conftest import SMALL


def plain(text, k=3):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        folded = folded.replace(c, " ")
    words = [w for w in folded.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    votes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in votes) > len(votes))


def groups(fps, radius=2):
    """Smallest index reachable, for each."""
    own = np.array(fps, np.uint64)
    left, out = set(range(len(fps))), [0] * len(fps)
    while left:
        first = min(left)
        todo, seen = [first], {first}
        while todo:
            i = todo.pop()
            near = set(np.flatnonzero(np.bitwise_count(own ^ own[i]) <= radius).tolist()) - seen
            seen |= near
            todo += near
        for i in seen:
            out[i] = first
        left -= seen
    return out


def test_query_equals_brute_force(spark, documents):
    fps = [plain(t) for _, t, _ in documents]
    ids = [i for i, _, _ in documents]
    order = sorted(range(len(ids)), key=ids.__getitem__)
    first = groups([fps[i] for i in order])
    want = {ids[i]: (f"{fps[i]:016x}", ids[order[first[n]]]) for n, i in enumerate(order)}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op9_simhash(spark, SMALL).collect()}
    assert got == want
    assert any(k != c for k, (_, c) in got.items())


def test_sliced_links_connect_what_is_near():
    rng = random.Random(3)
    for radius in (1, 2, 3):
        buckets = []
        for n in (130, 70, 9, 2, 2, 1):
            base = rng.getrandbits(64)
            buckets.append(sorted({base ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5))) % (1 << 64) for _ in range(n)}))
        buckets.sort(key=len, reverse=True)
        flat = [x for b in buckets for x in b]
        pairs = s.sliced_links(np.array(flat, np.uint64), np.array([len(b) for b in buckets]), radius)
        root = list(range(len(flat)))

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        for a, b in pairs:
            assert bin(flat[a] ^ flat[b]).count("1") <= radius
            x, y = find(a), find(b)
            assert x != y  # a forest
            root[max(x, y)] = min(x, y)
        at = 0
        for b in buckets:
            assert [find(at + i) - at for i in range(len(b))] == groups(b, radius)
            at += len(b)


def test_masks_leave_no_pair_apart():
    for radius in (1, 2, 3):
        own = s.masks(list(range(64)), radius)
        for bits in itertools.islice(itertools.combinations(range(0, 64, 3), radius), 4000):
            diff = sum(1 << b for b in bits)
            assert any(not diff & m for m in own)


def test_large_buckets_are_cut_not_capped(spark, monkeypatch):
    monkeypatch.setattr(s, "BUCKET", 8)
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(50)}
    base = rng.getrandbits(64)
    fps |= {base ^ (1 << i) for i in range(20)} | {base ^ (1 << i) ^ (1 << 40 + i % 20) for i in range(20)}
    fps = sorted(fps)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in fps]
    found = s.links(spark.createDataFrame(signed, "fp long"), 2).collect()
    at = {x[0]: i for i, x in enumerate(signed)}
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for r in found:
        assert bin((r.a ^ r.b) & (1 << 64) - 1).count("1") <= 2
        x, y = find(at[r.a]), find(at[r.b])
        root[max(x, y)] = min(x, y)
    assert [find(i) for i in range(len(fps))] == groups(fps)


def test_cases(spark):
    long = " ".join(f"word{i}" for i in range(300_000))
    docs = [
        (3, None), (5, ""), (9, " \t\n"), (None, ""),
        (7, "One two"), (2, "one\ntwo"), (7, "One two"),
        (4, "É one"), (6, "é one"),
        (8, long), (1, long.upper()),
    ]
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, fp string, component_id long")
    rows = s.near_duplicates(frame).collect()
    got = sorted((str(r.doc_id), r.fp & (1 << 64) - 1, r.component_id) for r in rows)
    comp = {3: 3, 5: 3, 9: 3, None: 3, 7: 2, 2: 2, 4: 4, 6: 6, 8: 1, 1: 1}
    assert got == sorted((str(i), plain(t), comp[i]) for i, t in docs)
    kept = s.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 6]


def test_keep_one_takes_one_row_of_each_component(spark):
    texts = [" ".join(f"{name}{i}" for i in range(40)) for name in ("red", "blue", "green", "white", "black")]
    docs = [
        (None, texts[0]), (None, texts[1]), (None, texts[1]), (None, texts[2]), (9, texts[2]),
        # two texts under one id, one of them a copy of a smaller id's
        (5, texts[3]), (5, texts[4]), (4, texts[4]),
    ]
    kept = s.keep_one(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted([("None", texts[0]), ("None", texts[1]), ("9", texts[2]), ("5", texts[3]), ("4", texts[4])])


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert s.near_duplicates(frame).count() == 0
    assert s.keep_one(frame).count() == 0
