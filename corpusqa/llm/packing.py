"""Best-fit packing by exact-complement hashing.

Pieces are packed by length alone, so the plan needs the number of pieces of
each length and nothing else: at most ``capacity`` numbers, whatever the size
of the corpus. The driver plans over these counts; Spark counts the lengths,
numbers the pieces of each length and joins them to the plan.
"""

from __future__ import annotations

import math
import re
import unicodedata
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusqa.functions.worker import once_per_worker
from corpusqa.llm.common import pieces, stored, widen

CAPACITY = 4096
END_ID = 1
MEMO = 300_000  # words and word parts that a worker's memo holds before it starts afresh


# ---- token ids -------------------------------------------------------------


class Encoder:
    """Token ids of whole texts with a tokenizer file, as little-endian uint32 bytes.

    The tokenizer splits at white space and then into runs of letters, single
    numerals and runs of other signs, and codes each part by itself. So ids are
    memoised: by word, and by part for words not seen before. That holds where
    lower-casing and normalising work character by character, which is checked
    by text: all characters below U+0180, none of the tokenizer's own marks.
    Other texts are coded by the tokenizer as a whole.
    """

    LIMIT = 0x180

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        kinds = [unicodedata.category(chr(c)) for c in range(self.LIMIT)]
        of = lambda k: "".join(re.escape(chr(c)) for c in range(self.LIMIT) if kinds[c][0] == k)
        space = "\t\n\x0b\x0c\r \x85\xa0"
        self.parts = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{of('L')}]+|[{of('N')}]|[^{space}{of('L')}{of('N')}]+").findall
        # byte -> the printable character that stands for it in the vocabulary
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        other = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in plain)}
        self.byte = [other.get(b, chr(b)) for b in range(256)]
        self.words: dict[str, bytes] = {}
        self.seen: dict[str, bytes] = {}

    def _ids(self, ids) -> bytes:
        import numpy as np

        return np.array(ids, "<u4").tobytes()

    def _part(self, part: str) -> bytes:
        got = self.seen.get(part)
        if got is None:
            if len(self.seen) >= MEMO:
                self.seen.clear()
            coded = part if part.isascii() and part.isprintable() else "".join([self.byte[b] for b in part.encode()])
            got = self.seen[part] = self._ids([t.id for t in self.model.tokenize(coded)])
        return got

    def _word(self, word: str) -> bytes:
        got = b"".join(map(self._part, self.parts(word.lower())))
        if len(self.words) >= MEMO:
            self.words.clear()
        if len(word) < 100:
            self.words[word] = got
        return got

    def whole(self, text: str) -> bytes:
        return self._ids(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def simple(self, text: str) -> bool:
        if "<|" in text:
            return False
        return text.isascii() or not _beyond(text)

    def __call__(self, text: str) -> bytes:
        if not self.simple(text):
            return self.whole(text)
        get, word = self.words.get, self._word
        out = []
        for w in text.replace("\n", " ").split(" "):
            got = get(w)
            out.append(word(w) if got is None else got)
        return b"".join(out)


_beyond = re.compile("[^\x00-\u017f]").search


def token_pieces(docs: DataFrame, tokenizer: str, text: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """The rows of ``docs`` without ``text`` in a struct ``row``, once for each
    piece of the text's ids (with ``END_ID`` after them): piece, start, length,
    ids_crc32 and, if asked for, ids. Null texts are empty: one piece of one id."""
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text])
    rows = docs.select(own.alias("row"), F.col(f"`{text}`").alias("text"))
    end = END_ID.to_bytes(4, "little")

    def run(batches):
        import zlib

        import pyarrow as pa

        encode = once_per_worker(("encoder", tokenizer), lambda: Encoder(tokenizer))
        step = capacity * 4
        for batch in batches:
            for part in pieces(batch, 200):
                at, number, start, length, crc, ids = [], [], [], [], [], []
                for i, t in enumerate(part.column(1).to_pylist()):
                    raw = encode(t or "") + end
                    for k in range(0, len(raw), step):
                        own = raw[k : k + step]
                        at.append(i)
                        number.append(k // step)
                        start.append(k // 4)
                        length.append(len(own) // 4)
                        crc.append(zlib.crc32(own))
                        if with_ids:
                            ids.append(own)
                columns = [part.column(0).take(pa.array(at, pa.int64())), pa.array(number, pa.int32())]
                columns += [pa.array(x, pa.int64()) for x in (start, length, crc)]
                names = ["row", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns, names = [*columns, pa.array(ids, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kinds = "piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return rows.mapInArrow(run, widen(rows.select("row").schema, kinds))


# ---- the plan --------------------------------------------------------------


@dataclass
class Entry:
    """``uses`` pieces of ``length`` in each of ``times`` sequences from ``first_sequence`` on."""

    length: int
    uses: int
    times: int
    first_rank: int
    first_sequence: int
    offset: int


class Plan:
    """Patterns of lengths, each for a number of sequences, over counted pieces."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        import numpy as np

        self.capacity = capacity
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            if not 0 < length <= capacity:
                raise ValueError(f"a piece of length {length} does not fit {capacity}")
            self.left[length] = n
        self.rank = [0] * (capacity + 1)
        self.sequences = 0
        self.entries: list[Entry] = []
        self._exact()
        self._best_fit()

    # index of sums: which single lengths and pairs are there is read off the
    # availability vector and its mirror image, under the pieces already taken

    def _single(self, gap: int, taken: dict[int, int]) -> list[int] | None:
        return [gap] if gap > 0 and self.left[gap] > taken.get(gap, 0) else None

    def _pair(self, gap: int, free) -> list[int] | None:
        import numpy as np

        half = gap // 2
        if half < 1:
            return None
        small = free[1 : half + 1]
        big = free[gap - half : gap][::-1]  # gap - 1 ... gap - half
        ok = (small > 0) & (big > 0)
        if gap % 2 == 0 and ok[-1]:
            ok[-1] = free[half] > 1
        at = np.flatnonzero(ok)
        return [int(gap - at[0] - 1), int(at[0] + 1)] if len(at) else None

    def _triple(self, gap: int, free) -> list[int] | None:
        import numpy as np

        for a in np.flatnonzero(free[: gap - 1] > 0)[::-1].tolist():
            if 3 * a < gap:
                break  # a is the largest of the three
            free[a] -= 1
            pair = self._pair(gap - a, free)
            free[a] += 1
            if pair and pair[0] <= a:
                return [a, *pair]
        return None

    def _fill(self, gap: int, taken: dict[int, int]) -> list[int] | None:
        if gap == 0:
            return []
        found = self._single(gap, taken)
        if found:
            return found
        free = self.left[: gap + 1].copy()
        for length, n in taken.items():
            if length <= gap:
                free[length] -= n
        return self._pair(gap, free) or self._triple(gap, free)

    def _exact(self) -> None:
        """From the longest length down: add the longest piece that fits until a
        single, pair or triple fills the gap exactly, and use the combination as
        often as its pieces last."""
        import numpy as np

        for length in range(self.capacity, 0, -1):
            while self.left[length]:
                taken, gap = {length: 1}, self.capacity - length
                while True:
                    found = self._fill(gap, taken)
                    if found is not None:
                        break
                    free = self.left[: gap + 1].copy()
                    for k, n in taken.items():
                        if k <= gap:
                            free[k] -= n
                    fits = np.flatnonzero(free > 0)
                    if not len(fits):
                        break
                    k = int(fits[-1])
                    n = min(int(free[k]), max(1, (gap - 3 * k) // k))  # many of a short length at once
                    taken[k] = taken.get(k, 0) + n
                    gap -= n * k
                if found is None:
                    break  # this length waits for best fit
                for k in found:
                    taken[k] = taken.get(k, 0) + 1
                self._emit(taken, min(int(self.left[k]) // n for k, n in taken.items()))

    def _emit(self, pattern: dict[int, int], times: int) -> None:
        offset = 0
        for length in sorted(pattern, reverse=True):
            uses = pattern[length]
            self.entries.append(Entry(length, uses, times, self.rank[length], self.sequences, offset))
            self.rank[length] += uses * times
            self.left[length] -= uses * times
            offset += uses * length
        self.sequences += times

    def _best_fit(self) -> None:
        """The rest, longest first: each piece goes to the fullest open pattern
        that still holds it. Open patterns of one gap form a list."""
        from bisect import bisect_left, insort

        open_: dict[int, list[tuple[dict[int, int], int]]] = {}
        gaps: list[int] = []

        def put(pattern: dict[int, int], times: int, gap: int) -> None:
            if gap not in open_:
                open_[gap] = []
                insort(gaps, gap)
            open_[gap].append((pattern, times))

        rest = {k: int(self.left[k]) for k in range(self.capacity, 0, -1) if self.left[k]}
        for length, n in rest.items():
            while n:
                i = bisect_left(gaps, length)
                if i == len(gaps):
                    uses = min(n, self.capacity // length)
                    times = n // uses
                    put({length: uses}, times, self.capacity - uses * length)
                    n -= uses * times
                    continue
                gap = gaps[i]
                pattern, times = open_[gap].pop()
                if not open_[gap]:
                    del open_[gap]
                    gaps.pop(i)
                uses = min(gap // length, max(1, n // times))
                used = min(times, n // uses)
                put(pattern | {length: pattern.get(length, 0) + uses}, used, gap - uses * length)
                if used < times:
                    put(pattern, times - used, gap)
                n -= uses * used
        for gap in gaps:
            for pattern, times in open_[gap]:
                self._emit(pattern, times)


# ---- placing the pieces ----------------------------------------------------


def pack(items: DataFrame, length: str = "length", order: list[str] | None = None, capacity: int = CAPACITY) -> DataFrame:
    """``items`` with sequence_id and offset: rows of ``length`` 1 to ``capacity``
    put into as few sequences as the plan finds, gapless from offset 0.

    Pieces of one length are numbered within blocks dealt by a hash of ``order``
    (all other columns by default) and the blocks' sums are added up, so a
    length that a third of all pieces has is no task of its own. Rows that are
    equal in ``order`` are alike to the plan. An empty table gives an empty
    result; a null or unfit length is an error.
    """
    spark = items.sparkSession
    own = order or [c for c in items.columns if c != length]
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    rows = items.select(F.struct("*").alias("item"), F.col(f"`{length}`").cast("long").alias("len"), *[F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(own)])
    by = [f"o{i}" for i in range(len(own))]
    rows = rows.withColumn("block", F.pmod(F.xxhash64(*by), F.lit(blocks)))
    counts = rows.groupBy("len", "block").agg(F.count("*").alias("n"))
    totals = {r.len: r.n for r in counts.groupBy("len").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    plan = Plan(totals, capacity)
    before = Window.partitionBy("len").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("len", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("len", "block").orderBy(*by)
    ranked = rows.withColumn("inside", F.row_number().over(inside) - 1).join(starts, ["len", "block"])
    ranked = ranked.select("item", "len", (F.col("first") + F.col("inside")).alias("rank"))
    # the plan as one sorted array of entries for each length; a piece finds its own by rank
    entries: dict[int, list] = {}
    for e in plan.entries:
        entries.setdefault(e.length, []).append((e.first_rank, e.uses, e.times, e.first_sequence, e.offset))
    kind = "len long, entries array<struct<first_rank: long, uses: long, times: long, first_sequence: long, at: long>>"
    table = spark.createDataFrame([(k, v) for k, v in entries.items()], kind)
    mine = F.element_at(F.filter("entries", lambda e: e.first_rank <= F.col("rank")), -1)
    placed = ranked.join(F.broadcast(table), "len").select("item", "len", "rank", mine.alias("e"))
    k = F.col("rank") - F.col("e.first_rank")
    return placed.select(
        "item.*",
        (F.col("e.first_sequence") + F.floor(k / F.col("e.uses"))).alias("sequence_id"),
        (F.col("e.at") + k % F.col("e.uses") * F.col("len")).alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of every document: doc_id, piece, start, length,
    ids_crc32, sequence_id, offset. Null texts are empty; a null doc_id and
    repeated rows are packed like any other; other columns are not read."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    cut = token_pieces(rows, tokenizer, capacity=capacity)
    cut = stored(cut.select("row.doc_id", "piece", "start", "length", "ids_crc32"), "pieces")
    return pack(cut, order=["doc_id", "piece", "ids_crc32"], capacity=capacity)
