"""SimHash near-dedup: fingerprints, bit-sliced comparison, components."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusqa.llm.common import byte_values, pieces, sized, stored, widen
from corpusqa.llm.components import components

BITS = 64
SEED = 42
# Most members of a bucket that one comparison takes; larger buckets are cut
# finer (see ``links``).
BUCKET = 1024


def fingerprint(raw: bytes, shingle: int) -> int:
    """SimHash of a UTF-8 text, unsigned. A-Z are lower-cased, words are runs of
    other than space and 0x09-0x0D; a text of fewer words than ``shingle`` is one
    shingle, a text without words has fingerprint zero."""
    import numpy as np
    import xxhash

    words = raw.lower().split()
    if not words:
        return 0
    buf = b" ".join(words)
    n = len(words) - shingle + 1
    if n <= 1:
        return xxhash.xxh64_intdigest(buf, SEED)
    length = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(length + 1) - 1
    begin = (end - length)[:n].tolist()
    end = end[shingle - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for i in range(0, n, 1 << 18):  # a long text in parts
        h = np.fromiter((digest(buf[a:b], SEED) for a, b in zip(begin[i : i + (1 << 18)], end[i : i + (1 << 18)])), "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for k in range(0, len(bits), 255):  # sums of 255 bits fit a byte
            counts += np.add.reduce(bits[k : k + 255], axis=0, dtype=np.uint8)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3, out: str = "fp") -> DataFrame:
    """The rows of ``docs`` without ``text``, with the signed 64-bit fingerprint ``out``."""
    keep = [c for c in docs.columns if c != text]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for part in pieces(batch):
                fp = np.array([fingerprint(t, shingle) for t in byte_values(part.column(len(keep)))], np.uint64)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(fp.view(np.int64))], names=[*keep, out])

    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`"))
    return rows.mapInArrow(run, widen(rows.drop(text).schema, f"`{out}` long"))


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def masks(free: list[int], radius: int) -> list[int]:
    """Bit sets of which two fingerprints within ``radius`` share at least one:
    of radius + 2 blocks of the free bits, at least two hold no difference."""
    n = radius + 2
    blocks = [free[len(free) * i // n : len(free) * (i + 1) // n] for i in range(n)]
    return [sum(1 << b for block in pair for b in block) for pair in combinations(blocks, 2)]


def sliced_links(fps, sizes, radius: int):
    """Pairs (i, j) that join all fingerprints of a bucket within ``radius`` of
    each other, as a spanning forest.

    ``fps``: uint64, buckets one after another; ``sizes``: their sizes, falling.
    Bit planes lie vertically (plane b holds bit b of every row), so XOR with the
    planes moved by s rows compares every row with the one s places on; the
    differences go into carry-save counters, one bit of each counter per word.
    Words of 64 rows are abandoned as soon as all their counts exceed the radius.
    """
    import numpy as np

    n = len(fps)
    size = np.repeat(sizes, sizes)
    left = size - (np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes))  # rows of the bucket from here on
    bits = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    width = n // 64 + 2
    planes = np.zeros((BITS, width * 8), np.uint8)
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    planes[:, : packed.shape[1]] = packed
    planes = planes.view("<u8")
    root = np.arange(n)
    found: list[tuple[int, int]] = []
    levels = (radius + 1).bit_length()
    for s in range(1, int(sizes[0]) if n else 0):
        rows = int(np.searchsorted(-size, -s, side="left"))  # rows of buckets larger than s
        words = rows // 64 + 1
        q, r = divmod(s, 64)
        ahead = np.zeros((BITS, words), np.uint64)
        have = planes[:, q : q + words]
        ahead[:, : have.shape[1]] = have >> np.uint64(r)
        if r:
            more = planes[:, q + 1 : q + words + 1]
            ahead[:, : more.shape[1]] |= more << np.uint64(64 - r)
        diff = planes[:, :words] ^ ahead
        mask = np.zeros(words * 64, np.uint8)
        mask[:rows] = left[:rows] > s
        open_ = np.packbits(mask, bitorder="little").view("<u8").copy()  # rows still within the radius
        alive = np.flatnonzero(open_)
        counter = np.zeros((levels, len(alive)), np.uint64)
        for b in range(BITS):
            carry = diff[b, alive]
            for c in range(levels):
                carry, counter[c] = counter[c] & carry, counter[c] ^ carry
            # a counter above the radius, or one that has run over
            above, same = carry, ~np.zeros(len(alive), np.uint64)
            for c in reversed(range(levels)):
                if radius >> c & 1:
                    same = same & counter[c]
                else:
                    above = above | (same & counter[c])
                    same = same & ~counter[c]
            open_[alive] &= ~above
            if b % 8 == 7:
                on = open_[alive] != 0
                if not on.all():
                    alive, counter = alive[on], counter[:, on]
                    if not len(alive):
                        break
        if not len(alive):
            continue
        i = np.flatnonzero(np.unpackbits(open_.view(np.uint8), bitorder="little"))
        i = i[root[i] != root[i + s]]
        for a, b in zip(i.tolist(), (i + s).tolist()):
            x, y = root[a], root[b]
            if x != y:  # members of a bucket are few: relabel the larger root's
                lo, hi = (x, y) if x < y else (y, x)
                first = a - int(size[a] - left[a])
                own = root[first : first + int(size[a])]
                own[own == hi] = lo
                found.append((a, b))
    return found


def _bucket_links(buckets: DataFrame, radius: int) -> DataFrame:
    """(members array<long>) -> (a, b)."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            lists = batch.column(0)
            sizes = np.diff(lists.offsets.to_numpy())
            order = np.argsort(-sizes, kind="stable")
            flat = lists.values.to_numpy(zero_copy_only=False)
            start = lists.offsets.to_numpy()[:-1]
            i = 0
            while i < len(order):
                j = i + max(1, int(np.searchsorted(np.cumsum(sizes[order[i:]]), 1 << 17)))
                own = order[i:j]
                fps = np.concatenate([np.sort(flat[start[k] : start[k] + sizes[k]].view(np.uint64)) for k in own])
                pairs = sliced_links(fps, sizes[own], radius)
                i = j
                if pairs:
                    ab = fps[np.array(pairs)].view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(ab.max(axis=1)), pa.array(ab.min(axis=1))], names=["a", "b"])

    return buckets.select("members").mapInArrow(run, "a long, b long")


def links(fps: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (``fp``, no repeats) at
    ``radius`` or fewer differing bits, directly or through others.

    Fingerprints meet in buckets by the bits of each mask. A bucket of more than
    ``BUCKET`` members is cut by the masks of the bits it leaves free, and so on:
    each step leaves about half the free bits, and no more than 2 to their number
    of distinct fingerprints can share the rest. No bucket is capped.
    """
    level = {0: masks(list(range(BITS)), radius)}
    rows, found = fps.select("fp", F.lit(0).cast("long").alias("mask")), []
    while level:
        kids = None
        for m, own in level.items():
            kids = (F.when if kids is None else kids.when)(F.col("mask") == _signed(m), F.array(*[F.lit(_signed(k)) for k in own]))
        keyed = rows.select("fp", F.explode(kids).alias("mask")).withColumn("key", F.col("fp").bitwiseAND(F.col("mask"))).distinct()
        sizes = keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).filter("n > 1")
        sized = stored(keyed.join(sizes, ["mask", "key"]), "buckets")
        small = sized.filter(F.col("n") <= BUCKET).groupBy("mask", "key").agg(F.collect_list("fp").alias("members"))
        found.append(_bucket_links(small, radius))
        rows = sized.filter(F.col("n") > BUCKET).select("fp", "mask")
        every = (1 << BITS) - 1
        large = [r[0] & every for r in rows.select("mask").distinct().collect()]  # some of this level's masks
        level = {m: [m | k for k in masks([b for b in range(BITS) if not m >> b & 1], radius)] for m in large}
    out = found[0]
    for x in found[1:]:
        out = out.union(x)
    return out


def _roots(rows: DataFrame, radius: int) -> DataFrame:
    """(fp, root, low) for each distinct ``fp`` of ``rows``: its component's smallest
    fingerprint, and its own smallest doc_id."""
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct-fingerprints")
    roots = components(links(distinct, radius))
    return distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fp`` (signed), ``component_id``.

    component_id is the smallest doc_id reachable over links of ``radius`` or
    fewer bits, the row's own included. Texts that are null or have no words
    share fingerprint zero and are linked like any other. Rows with a null
    doc_id take part; a component of such rows alone has a null component_id.
    Repeated rows and repeated ids are kept as they are. An empty table gives an
    empty result; other columns of ``docs`` are not read.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = stored(fingerprints(rows, "text", shingle), "fingerprints")
    named = _roots(rows, radius)
    least = named.groupBy("root").agg(F.min("low").alias("component_id"))
    named = named.join(least, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest
    doc_id, null ids last; of repeated ids the one whose text has the smallest hash, and
    of equal ids and texts the smallest row.

    Which go is found on ids and hashes alone. The others stay where they are
    if those are few enough to be broadcast.
    """
    content = F.xxhash64(F.col(f"`{text}`"))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), content.alias("content"), F.col(f"`{text}`").alias("text"))
    rows = stored(fingerprints(rows, "text", shingle), "fingerprints")
    named = rows.join(_roots(rows, radius).select("fp", "root"), "fp").groupBy("root", "doc_id", "content").agg(F.count("*").alias("n"))
    named = stored(named, "copies")
    first = named.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "content")).alias("first"))
    kept = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("content") == F.col("first.content"))
    named = named.join(first, "root").select(F.col("doc_id").alias("copy_id"), F.col("content").alias("copy"), "n", kept.alias("kept"))
    copies = sized(named.filter(~F.col("kept") | (F.col("n") > 1)), "copies-to-drop")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    own = docs.select(F.col(f"`{doc_id}`").alias("own_id"), content.alias("own"), row.alias("row"))
    same = F.col("own_id").eqNullSafe(F.col("copy_id")) & (F.col("own") == F.col("copy"))
    out = own.join(copies, same, "left_anti").select("row")
    equal = copies.filter("kept")
    if not equal.isEmpty():  # rows of one id and text: one of them
        out = out.union(own.join(equal, same, "left_semi").groupBy("own_id", "own").agg(F.min("row").alias("row")).select("row"))
    return out.select("row.*")
