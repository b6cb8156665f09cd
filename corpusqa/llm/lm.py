"""LM scoring with a weighted backoff automaton.

States are n-grams that have followers, arcs the n-grams themselves: from the state
of its first words an n-gram leads, by its last word, on to the longest end that is a state.
Where a state has no arc for a word, its failure arc leads to the state without the
first word. Interpolated absolute discounting gives the weights:
P(w|h) = max(c(hw) - d, 0) / c(h) + b(h) P(w|h'), b(h) the failure arc's, what the kept
n-grams of h leave. So a state's probabilities sum to one over all words.

The automaton grows with the corpus: it has every word, and each n-gram of higher order seen
``LEAST`` times, with its count and the mass that it leaves to its followers. An n-gram is known
by a 64-bit hash of those of itself without the last and without the first word.

Texts are read once and kept in chunks, as places in a chunk's list of words. A chunk asks
for each of its n-grams once, telling how often it has it in training texts: the buckets of n-grams,
dealt by hash, add up what the chunks tell, and answer each in the order that it asked in. An
n-gram is only asked for if the two of the order below that it is made of are frequent
enough, by the answers before. With its answers a chunk has the part of the automaton that its
texts can reach, and each text is traversed left to right, a state carried along.
"""

from __future__ import annotations

import math
import os
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusqa.llm.common import byte_values, crc32_mod, stored, widen
from corpusqa.session import target_partitions

END = b""  # the token after a text's last word; no word is empty
ALPHA = 0.1
DISCOUNT = 0.5
LEAST = (1, 2, 3)  # n-grams of each order are kept from so many occurrences on
FLUSH = 1 << 20  # tokens of a chunk, about; a longer text is one by itself
CHUNK = 8192  # rows of a chunk, at most
STEP = 1 << 18  # tokens that are walked at a time
BUCKET = 1 << 20  # tokens for each bucket of n-grams, about
TOP_SHARE, SIEVE = 5e-6, 28  # of broadcasts that are no longer made; tests set them


def tokens(raw: bytes) -> list[bytes]:
    """Words of a UTF-8 text with A-Z lower-cased, then the end token."""
    words = raw.lower().split()
    words.append(END)
    return words


def log_share(count: int, total: int, distinct: int) -> float:
    return math.log10((count + ALPHA) / (total + ALPHA * (distinct + 1)))


def _hash_long(x, seed):
    """Spark's xxhash64 of longs, for arrays of uint64; ``seed`` a number or such an array."""
    import numpy as np

    p1, p2, p3, p4, p5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    turn = lambda v, r: (v << np.uint64(r)) | (v >> np.uint64(64 - r))
    h = turn(x * p2, 31) * p1 ^ (seed + (p5 + np.uint64(8)))
    h = turn(h, 27) * p1 + p4
    h = (h ^ (h >> np.uint64(33))) * p2
    h = (h ^ (h >> np.uint64(29))) * p3
    return h ^ (h >> np.uint64(32))


class _Words(dict):
    """Spark's xxhash64 of words, unsigned; forgets them when they are many."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= 1 << 18:
            self.clear()
        self[word] = out = xxhash.xxh64_intdigest(word, 42)
        return out


def _texts(column, words: _Words, size: int, rows: int):
    """(first row, hashes, sizes) of an Arrow string column: the texts' tokens one
    after another, in parts of about ``size`` tokens and at most ``rows`` rows."""
    import numpy as np

    first, own, held = 0, [], 0
    for i in range(len(column)):
        found = tokens(byte_values(column.slice(i, 1))[0])
        own.append(np.fromiter(map(words.__getitem__, found), np.uint64, len(found)))
        held += len(found)
        if held >= size or len(own) >= rows or i == len(column) - 1:
            yield first, np.concatenate(own), np.array([len(x) for x in own])
            first, own, held = i + 1, [], 0


def _orders(hashes, sizes, order: int):
    """(ctx, suf, key, inside) for n-grams of order 2 to ``order`` at every token
    they start from; ``inside`` is whether one text has all their words."""
    import numpy as np

    inside = np.ones(len(hashes), bool)
    inside[np.cumsum(sizes) - 1] = False
    inside, key = inside[:-1], hashes
    for _ in range(2, order + 1):
        ctx, suf = key[:-1], key[1:]
        key = _hash_long(suf, _hash_long(ctx, np.uint64(42)))
        yield ctx, suf, key, inside
        inside = inside[:-1] & inside[1:]


def _pack(values) -> bytes:
    """An array as bytes: the first byte of every number, then the second, and so on, compressed."""
    import numpy as np
    import pyarrow as pa

    raw = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(packed: bytes, kind):
    import numpy as np
    import pyarrow as pa

    size, kind = int.from_bytes(packed[:8], "little"), np.dtype(kind)
    raw = pa.decompress(packed[8:], size * kind.itemsize, codec="zstd", asbytes=True)
    return np.frombuffer(raw, np.uint8).reshape(kind.itemsize, size).T.copy().view(kind).reshape(size)


def _chunks(rows: DataFrame) -> DataFrame:
    """``rows`` (row, text, train) in chunks: their ``row`` values, the texts' sizes, the hashes of
    the chunk's words and the place there of each token."""
    most, many = FLUSH, CHUNK

    def run(batches):
        import numpy as np
        import pandas as pd
        import pyarrow as pa

        words = _Words()
        for batch in batches:
            row, text, train = (batch.column(i) for i in range(3))
            for first, hashes, sizes in _texts(text, words, most, many):
                own = train.slice(first, len(sizes)).to_numpy(zero_copy_only=False).astype(bool)
                at, vocab = pd.factorize(hashes)
                chunk = int.from_bytes(os.urandom(8), "little", signed=True)
                packed = [_pack(x) for x in (sizes, own, vocab, at.astype(np.int32))]
                values = [pa.ListArray.from_arrays(pa.array([0, len(sizes)], pa.int32()), pa.concat_arrays([row.slice(first, len(sizes))]))]
                values += [pa.array([x]) for x in (chunk, *packed, len(hashes), int(sizes[own].sum()))]
                yield pa.RecordBatch.from_arrays(values, names=["row", "chunk", "sizes", "train", "vocab", "ids", "tokens", "trained"])

    kind = T.StructType([T.StructField("row", T.ArrayType(rows.schema["row"].dataType))])
    return rows.select("row", "text", "train").mapInArrow(run, widen(kind, "chunk long, sizes binary, train binary, vocab binary, ids binary, tokens long, trained long"))


class _Level:
    """A chunk's n-grams of one order. ``at``: for every token the n-gram that starts there, -1 if
    none is asked for; of each n-gram ``key``, ``head`` (the n-gram without its last word, in the order below),
    ``n`` (training occurrences in all texts; 0 if not kept), ``mine`` (whether this chunk, of
    those that have it, is the one to add its mass) and ``mass``."""

    def __init__(self, at, key, head=None):
        import numpy as np

        self.at, self.key, self.head = at, key, head
        self.by = np.argsort(key)
        self.n = self.mass = self.mine = None

    def heirs(self, least: int):
        """The n-grams that may have followers, in the order of their keys."""
        return self.by if self.n is None else self.by[self.n[self.by] >= least]


def _levels(chunk: dict, told: dict, least: tuple[int, ...], upto: int) -> list[_Level]:
    """The n-grams of orders 1 to ``upto`` of a chunk with what it was told of them."""
    import numpy as np
    import pandas as pd

    sizes, ids = _unpack(chunk["sizes"], np.int64), _unpack(chunk["ids"], np.int32).astype(np.int64)
    doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    out = [_Level(ids, _unpack(chunk["vocab"], np.uint64))]
    for order in range(1, upto + 1):
        if order > 1:
            low = out[-1]
            there = (doc[: max(len(doc) - order + 1, 0)] == doc[order - 1 :]) & (low.at[:-1] >= 0) & (low.at[1:] >= 0)
            if order > 2:
                often = np.append(low.n >= least[order - 1], False)[low.at]
                there &= often[:-1] & often[1:]
            code, grams = pd.factorize(low.at[:-1][there] * len(low.key) + low.at[1:][there])
            head, tail = np.divmod(grams, max(len(low.key), 1))
            at = np.full(len(there), -1, np.int64)
            at[there] = code
            out.append(_Level(at, _hash_long(low.key[tail], _hash_long(low.key[head], np.uint64(42))), head))
        own = out[-1]
        if (n := told.get((order, "n"), None if len(own.key) else np.zeros(0, np.int64))) is not None:
            own.n, own.mine = np.zeros(len(own.key), np.int64), np.zeros(len(own.key), bool)
            own.n[own.by], own.mine[own.by] = n >> 1, n & 1
        if (mass := told.get((order, "mass"))) is not None:
            own.mass = np.zeros(len(own.key))
            own.mass[own.heirs(least[order]) if order > 1 else own.by] = mass
    return out


ASKED = "order int, bucket int, chunk long, key binary, n binary, mass binary"
TOLD = "order int, bucket int, chunk long, kept long, n binary, mass binary"


def _told(answers) -> dict:
    """Of a chunk's answers, (order, "n" or "mass") -> numbers in the order of the keys asked for."""
    import numpy as np

    out = {}
    for row in sorted(answers.select(["order", "bucket", "n", "mass"]).to_pylist(), key=lambda r: r["bucket"]):
        for what, kind in (("n", np.int64), ("mass", np.float64)):
            if row[what] is not None:
                out.setdefault((row["order"], what), []).append(_unpack(row[what], kind))
    return {k: np.concatenate(v) for k, v in out.items()}


def _ask(chunk: dict, told: dict, turn: int, least: tuple[int, ...], buckets: int):
    """What a chunk asks for in a turn: counts of n-grams of order ``turn + 1``, and the mass
    of those of order ``turn - 1``, whose followers' counts it knows (with the counts of words)."""
    import numpy as np
    import pyarrow as pa

    order = len(least)
    levels = _levels(chunk, told, least, min(turn + 1, order))
    train = np.repeat(_unpack(chunk["train"], bool), _unpack(chunk["sizes"], np.int64))
    rows = []

    def put(m, which, n, mass):
        key = levels[m - 1].key[which]
        to = ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        ends = [0, *(np.flatnonzero(to[1:] != to[:-1]) + 1).tolist(), len(to)] if len(to) else []
        for a, b in zip(ends, ends[1:]):
            rows.append((m, int(to[a]), chunk["chunk"], _pack(key[a:b]), *(None if x is None else _pack(x[which[a:b]]) for x in (n, mass))))

    def own_count(m):
        level = levels[m - 1]
        seen = level.at[train[: len(level.at)] & (level.at >= 0)]
        return np.bincount(seen, minlength=len(level.key)).astype(np.int64)

    if turn < order:
        put(turn + 1, levels[turn].by, own_count(turn + 1), None)
    if turn > 1:
        level, mass = levels[turn - 2], np.zeros(len(levels[turn - 2].key))
        if turn <= order:
            above = levels[turn - 1]
            add = above.mine
            mass = np.bincount(above.head[add], above.n[add] - DISCOUNT, len(mass))
        if turn == 2:
            put(1, level.by, own_count(1), mass)
        else:
            put(turn - 1, level.heirs(least[turn - 1]), None, mass)
    schema = [("order", pa.int32()), ("bucket", pa.int32()), ("chunk", pa.int64()), ("key", pa.binary()), ("n", pa.binary()), ("mass", pa.binary())]
    return pa.table([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(schema)], names=[n for n, _ in schema])


def _answer(asked: DataFrame, least: tuple[int, ...]) -> DataFrame:
    """For every row asked, the counts of its n-grams, twice, and one more where the chunk is the one to
    add their mass; 0 for n-grams not kept; ``kept``, the n-grams it is to add; the masses."""

    def run(key, asks):
        import numpy as np
        import pandas as pd
        import pyarrow as pa

        order = key[0].as_py()
        keys = [_unpack(x.as_py(), np.uint64) for x in asks.column("key")]
        ends = np.cumsum([len(x) for x in keys])[:-1]
        at, found = pd.factorize(np.concatenate(keys))
        del keys
        packed, kept = {"n": None, "mass": None}, [0] * asks.num_rows
        for what, kind in (("n", np.int64), ("mass", np.float64)):
            if asks.column(what).null_count:
                continue
            values = np.concatenate([_unpack(x.as_py(), kind) for x in asks.column(what)])
            total = np.bincount(at, values, len(found)).astype(kind)
            if what == "n":
                total[total < least[order - 1]] = 0
                first = at > np.concatenate([[-1], np.maximum.accumulate(at)[:-1]])
                total = 2 * total[at] + (first & (total[at] > 0))
                kept = [int((x & 1).sum()) for x in np.split(total, ends)]
            else:
                total = total[at]
            packed[what] = [_pack(x) for x in np.split(total, ends)]
        out = {c: asks.column(c) for c in ("order", "bucket", "chunk")} | {"kept": pa.array(kept, pa.int64())}
        for what, values in packed.items():
            out[what] = pa.array(values, pa.binary()) if values else pa.nulls(asks.num_rows, pa.binary())
        return pa.table(out)

    return asked.groupBy("order", "bucket").applyInArrow(run, TOLD)


class Arcs:
    """Rows of the automaton by key: (key, n, mass), keys sorted."""

    def __init__(self, key, n, mass):
        import numpy as np

        order = np.argsort(key)
        self.key, self.n, self.mass = key[order], n[order], np.nan_to_num(mass[order])

    def find(self, key):
        """(n, mass) of each key; zeros where there is no row."""
        import numpy as np

        if not len(self.key):
            return np.zeros(len(key), np.int64), np.zeros(len(key))
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        hit = self.key[at] == key
        return np.where(hit, self.n[at], 0), np.where(hit, self.mass[at], 0.0)


def walk(hashes, sizes, tables: list[Arcs], order: int, total: int, distinct: int):
    """(score, base score, known tokens) of texts whose tokens follow one another, by the
    rows of the automaton in ``tables``."""
    import numpy as np

    def find(keys):
        n, mass = zip(*(t.find(keys) for t in tables))
        return sum(n), sum(mass)  # a key has a row in one table

    found = [find(hashes)]
    for _, _, key, inside in _orders(hashes, sizes, order):
        n, mass = find(key)
        found.append((np.where(inside, n, 0), np.where(inside, mass, 0.0)))
    return traverse(found, sizes, total, distinct)


def traverse(found: list, sizes, total: int, distinct: int):
    """(score, base score, known tokens) of texts whose tokens follow one another. ``found`` has,
    for each order, the counts and masses of the n-grams that start at each token; zeros where no
    n-gram of a text is in the automaton.

    ``arc[m][t]`` is the log-probability of token t from the state of the m tokens before it,
    ``fail[m][t]`` the weight of the failure arc of the state of the m tokens up to t; NaN where
    there is none. Both follow from the counts. From every state, failure arcs taken, token t
    has a weight and a next state. Then one traversal, left to right.
    """
    import numpy as np

    def log(values, there):
        return np.where(there, np.log10(np.where(there, values, 1.0)), np.nan)

    order, size = len(found), int(sizes.sum())
    n, mass = found[0]
    known = n > 0
    p = (n + ALPHA) / (total + ALPHA * (distinct + 1))  # of a token after the longest history so far
    base = np.log10(p)
    arc, fail = [base], [np.full(size, np.nan)]
    for m, above in enumerate(found[1:], 1):  # histories of m tokens
        of, state = n[:-1], mass[:-1] > 0
        back = np.where(state, np.maximum(1 - mass[:-1] / np.maximum(of, 1), 1e-12), 1.0)
        fail.append(np.concatenate([np.full(m - 1, np.nan), log(back, state), [np.nan]])[:size])
        n, mass = above
        own = np.where(n > 0, (n - DISCOUNT) / np.maximum(of, 1), 0.0)
        p = np.concatenate([p[:m], own + back * p[m:]])[:size]
        arc.append(np.concatenate([np.full(m, np.nan), log(p[m:], n > 0)])[:size])
    # the longest state of at most m tokens that ends at t
    ends = [np.zeros(size, np.uint8)]
    for m in range(1, order):
        ends.append(np.where(np.isnan(fail[m]), ends[-1], m).astype(np.uint8))
    weight, after = [arc[0]], [ends[min(1, order - 1)]]
    for m in range(1, order):
        there = ~np.isnan(arc[m])
        weight.append(np.where(there, arc[m], np.concatenate([[np.nan], fail[m][:-1]])[:size] + weight[-1]))
        after.append(np.where(there, ends[min(m + 1, order - 1)], after[-1]))
    after, states, first = [a.tobytes() for a in after], bytearray(size), 0
    for length in sizes.tolist():
        state = 0
        for t in range(first, first + length):
            states[t] = state
            state = after[state][t]
        first += length
    scores = np.choose(np.frombuffer(states, np.uint8), weight)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    return np.bincount(doc, scores, len(sizes)), np.bincount(doc, base, len(sizes)), np.bincount(doc, known, len(sizes)).astype(np.int64)


def _walk_chunk(chunk: dict, told: dict, least: tuple[int, ...], total: int, distinct: int):
    """(sizes, score, base score, known tokens) of a chunk's texts, ``STEP`` tokens at a time."""
    import numpy as np

    sizes, levels = _unpack(chunk["sizes"], np.int64), []
    for level in _levels(chunk, told, least, len(least)):
        mass = np.zeros(len(level.key)) if level.mass is None else level.mass
        levels.append((level.at, np.append(level.n, 0), np.append(mass, 0.0)))  # the last is for -1: none
    ends, first, parts = np.cumsum(sizes), 0, []
    while first < len(sizes):
        start = int(ends[first] - sizes[first])
        last = max(int(np.searchsorted(ends, start + STEP, "right")), first + 1)
        found = []
        for m, (at, n, mass) in enumerate(levels):
            own = at[start : max(int(ends[last - 1]) - m, start)]
            found.append((n[own], mass[own]))
        parts.append((sizes[first:last], *traverse(found, sizes[first:last], total, distinct)))
        first = last
    return [np.concatenate(c) for c in zip(*parts)]


def score(docs: DataFrame, train: Column, least: tuple[int, ...] = LEAST, text: str = "text") -> DataFrame:
    """The rows of ``docs`` without ``text``, in a struct ``row``, and n_tokens, n_known,
    train_tokens, base_score (add-``ALPHA`` unigrams) and score (the automaton's log10 probability).
    The automaton learns from the rows for which ``train`` is true; its n-grams of order i are kept from
    ``least[i - 1]`` occurrences on.

    Null texts are empty: the end token alone. Rows that repeat are scored each
    by itself; an empty table gives an empty result; columns may have any names.
    """
    keep = [c for c in docs.columns if c != text]
    own = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.struct(F.lit(0).alias("none"))
    rows = docs.select(own.alias("row"), F.col(f"`{text}`").alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    chunks = stored(_chunks(rows), "chunks")
    tokens, total = chunks.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("trained"), F.lit(0))).first()
    buckets = max(2 * target_partitions(docs.sparkSession), tokens // BUCKET)
    bare, answers = chunks.select("chunk", "sizes", "train", "vocab", "ids"), []

    def first_turn(batches):
        for batch in batches:
            for chunk in batch.to_pylist():
                yield from _ask(chunk, {}, 1, least, buckets).to_batches()

    def meet(f, schema, chunks):
        told = reduce(DataFrame.union, answers).select("chunk", "order", "bucket", "n", "mass")
        return chunks.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(f, schema)

    def later(turn):
        return lambda own, told: _ask(own.to_pylist()[0], _told(told), turn, least, buckets)

    for turn in range(1, max(len(least), 2) + 1):
        asked = meet(later(turn), ASKED, bare) if turn > 1 else bare.mapInArrow(first_turn, ASKED)
        answers.append(stored(_answer(asked, least), "answers"))
    distinct = answers[1].filter("order = 1").agg(F.coalesce(F.sum("kept"), F.lit(0))).first()[0]

    def run(own, told):
        import pyarrow as pa

        n, scores, base, known = _walk_chunk(own.drop_columns(["row"]).to_pylist()[0], _told(told), least, total, distinct)
        row = own.column("row").combine_chunks().flatten()
        return pa.table({"row": row, "n_tokens": pa.array(n, pa.int64()), "n_known": pa.array(known), "train_tokens": pa.array([total] * len(n), pa.int64()), "base_score": pa.array(base), "score": pa.array(scores)})

    kind = T.StructType([T.StructField("row", chunks.schema["row"].dataType.elementType)])
    schema = widen(kind, "n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return meet(run, schema, chunks.select("row", *bare.columns))


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = 10) -> DataFrame:
    """Train on the documents whose crc32(doc_id as text) mod ``folds`` is not 0
    and score all. A null doc_id has no remainder: held out is false and the
    row trains."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = rows.withColumn("held_out", F.coalesce(crc32_mod("doc_id", folds) == 0, F.lit(False)))
    out = score(rows, ~F.col("held_out"))
    return out.select("row.doc_id", "row.held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
