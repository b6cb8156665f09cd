"""Benchmark decontamination over a positional inverted index.

The index is stored by document shards: a shard holds up to ``SHARD_TOKENS``
tokens of whole documents as one row with its dictionary, the postings of every
term (positions within the shard, rising) and the documents' places. A search
intersects, within each shard, the offset-adjusted postings of a window's
terms from the rarest on. No posting list is shuffled, and a term that stands
in every document is spread over all shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusqa.llm.common import byte_values, pieces, sized, stored, widen

WINDOW = 13
SLOP = 2
SHARD_TOKENS = 1 << 20
BATCH_WORDS = 200_000  # words of benchmark items that one search takes to the tasks

# A-Z to a-z; all but digits, letters and bytes from 0x80 on to a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(raw: bytes) -> list[bytes]:
    """Words of a UTF-8 text: runs of digits, letters and characters from U+0080
    on, A-Z lower-cased."""
    return raw.translate(_FOLD).split()


class _Terms(dict):
    def __missing__(self, word):
        n = self[word] = len(self)
        return n


def build_index(docs: DataFrame, text: str = "text") -> DataFrame:
    """The stored index of ``docs``. A row is a shard: rows (array of a struct of
    the other columns, in order), starts (first position of each row, and the
    end), terms (the dictionary, one term a line), offsets and positions
    (postings; little-endian int32). A gap of ``WINDOW`` * 2 positions between
    rows keeps phrases and near matches within a row. Null texts have no words."""
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text])
    rows = docs.select(own.alias("row"), F.col(f"`{text}`").alias("text"))

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        def shard():
            ids = np.concatenate(held)
            place = np.concatenate(where)
            order = np.argsort(ids, kind="stable")
            offsets = np.zeros(len(terms) + 1, np.int64)
            np.cumsum(np.bincount(ids, minlength=len(terms)), out=offsets[1:])
            values = pa.concat_arrays(own)
            lists = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            columns = [lists, pa.array([starts], pa.list_(pa.int32())), pa.array([b"\n".join(terms)], pa.binary())]
            columns += [pa.array([x.astype("<i4").tobytes()], pa.binary()) for x in (offsets, place[order])]
            columns.append(pa.array([(TaskContext.get().partitionId() << 32) + done], pa.int64()))
            return pa.RecordBatch.from_arrays(columns, names=["rows", "starts", "terms", "offsets", "positions", "shard"])

        def fresh():
            return _Terms(), [np.zeros(0, np.int32)], [np.zeros(0, np.int32)], [0], []

        terms, held, where, starts, own = fresh()
        done = 0
        for batch in batches:
            for part in pieces(batch, 500):
                first = 0
                for i, raw in enumerate(byte_values(part.column(1))):
                    found = words(raw)
                    held.append(np.fromiter(map(terms.__getitem__, found), np.int32, len(found)))
                    where.append(np.arange(starts[-1], starts[-1] + len(found), dtype=np.int32))
                    starts.append(starts[-1] + len(found) + 2 * WINDOW)
                    if starts[-1] >= SHARD_TOKENS:
                        own.append(part.column(0).slice(first, i + 1 - first))
                        yield shard()
                        done += 1
                        terms, held, where, starts, own = fresh()
                        first = i + 1
                if first < part.num_rows:
                    own.append(part.column(0).slice(first))
        if own:
            yield shard()

    schema = T.StructType([T.StructField("rows", T.ArrayType(rows.schema["row"].dataType))])
    schema = widen(schema, "starts array<int>, terms binary, offsets binary, positions binary, shard long")
    return stored(rows.mapInArrow(run, schema), "postings")


def _item_batches(items: DataFrame):
    """The benchmark as lists of (item_id, words), each of ``BATCH_WORDS`` words or
    one item. One list at a time is on the driver."""
    batch, size = [], 0
    for r in items.toLocalIterator():
        own = words((r[1] or "").encode())
        if own:
            batch.append((r[0], own))
            size += len(own)
        if size >= BATCH_WORDS:
            yield batch
            batch, size = [], 0
    yield batch


def intersect(at, lists, shifts, slop: int):
    """The places of ``at`` for which every list holds place + shift, or a position
    at most ``slop`` from it. Lists rise, rarest first."""
    import numpy as np

    for own, shift in zip(lists, shifts):
        if not len(at):
            break
        want = at + shift
        i = np.searchsorted(own, want - slop)
        at = at[(i < len(own)) & (own[np.minimum(i, len(own) - 1)] <= want + slop)]
    return at


def search(index: DataFrame, items: list, window: int = WINDOW, slop: int = SLOP) -> DataFrame:
    """Matches of a list of (item_id, words) in the index: a row of the index in
    ``row``, its ``n_words``, ``hits`` (word ranges [start, end) of the windows'
    occurrences), ``items`` and ``near_items`` (items with a window that occurs, or
    whose words all stand at most ``slop`` places from where an occurrence at some
    place would have them). All rows of the index are returned."""
    shared = index.sparkSession.sparkContext.broadcast(items)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        range_of = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for k in range(batch.num_rows):
                starts = np.array(batch.column(1)[k].as_py(), np.int64)
                raw = batch.column(2)[k].as_py()
                term = {w: i for i, w in enumerate(raw.split(b"\n"))} if raw else {}
                offsets = np.frombuffer(batch.column(3)[k].as_py(), "<i4").astype(np.int64)
                positions = np.frombuffer(batch.column(4)[k].as_py(), "<i4")
                count = np.append(np.diff(offsets), 0)  # last: a term that the shard lacks
                hit: dict[int, list] = {}
                exact: dict[int, set] = {}
                close: dict[int, set] = {}
                for item, own in shared.value:
                    t = np.array([term.get(w, -1) for w in own])
                    n = min(window, len(t))
                    have = count[t]
                    lacking = np.append(0, np.cumsum(have == 0))
                    for s in np.flatnonzero(lacking[n:] == lacking[:-n]).tolist():
                        shifts = np.argsort(have[s : s + n], kind="stable").tolist()
                        lists = [positions[offsets[t[s + j]] : offsets[t[s + j] + 1]] for j in shifts]
                        rare, first = lists[0], lists[0] - shifts[0]  # places where the window would begin
                        near = first if not slop else np.unique(first[:, None] + np.arange(-slop, slop + 1))
                        near = intersect(near, lists, shifts, slop)
                        if not len(near):
                            continue
                        full = intersect(first, lists[1:], shifts[1:], 0)
                        inside = rare[np.searchsorted(rare, near + shifts[0] - slop)]  # a word of the match
                        for d in (np.searchsorted(starts, inside, "right") - 1).tolist():
                            close.setdefault(d, set()).add(item)
                        for d, p in zip((np.searchsorted(starts, full, "right") - 1).tolist(), full.tolist()):
                            hit.setdefault(d, []).append((p, n))
                            exact.setdefault(d, set()).add(item)
                rows = batch.column(0)[k].values
                n = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column(5)[k].as_py()] * n, pa.int64()),
                        pa.array(range(n), pa.int32()),
                        rows,
                        pa.array(np.diff(starts) - 2 * WINDOW, pa.int64()),
                        pa.array([[{"start": p - int(starts[d]), "end": p + m - int(starts[d])} for p, m in hit.get(d, ())] for d in range(n)], range_of),
                        pa.array([sorted(map(str, exact.get(d, ()))) for d in range(n)], pa.list_(pa.string())),
                        pa.array([sorted(map(str, close.get(d, ()))) for d in range(n)], pa.list_(pa.string())),
                    ],
                    names=["shard", "place", "row", "n_words", "hits", "items", "near_items"],
                )

    row = T.StructField("row", index.schema["rows"].dataType.elementType)
    found = "n_words long, hits array<struct<start: long, end: long>>, items array<string>, near_items array<string>"
    return index.mapInArrow(run, widen(T.StructType([*T.StructType.fromDDL("shard long, place int").fields, row]), found))


def find(docs: DataFrame, items: DataFrame, text: str = "text", window: int = WINDOW, slop: int = SLOP) -> DataFrame:
    """Every row of ``docs`` (the other columns in ``row``) with its matches of
    ``items`` (two columns: id, text): n_words, n_hit (words inside an occurrence
    of a window), hits (word ranges [start, end)), items and near_items (ids as
    strings, sorted; near_items without items).

    Null and empty texts have no words and no matches; items without words match
    nothing. Items that repeat are one id. Empty tables give no rows, or rows
    without matches. All items are looked for: in lists of ``BATCH_WORDS`` words,
    one search of the index for each.
    """
    index = build_index(docs, text)
    found = None
    for batch in _item_batches(items):
        more = search(index, batch, window, slop)
        found = more if found is None else found.union(more)
    all_of = lambda c: F.sort_array(F.array_distinct(F.flatten(F.collect_list(c))))
    found = found.groupBy("shard", "place").agg(
        F.first("row").alias("row"), F.first("n_words").alias("n_words"), all_of("hits").alias("hits"), all_of("items").alias("items"), all_of("near_items").alias("near")
    )
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
    step = lambda acc, x: F.struct(
        F.greatest(acc["end"], x["end"]).alias("end"), (acc["n"] + F.greatest(F.lit(0).cast("long"), x["end"] - F.greatest(acc["end"], x["start"]))).alias("n")
    )
    return found.select(
        "row", "n_words", F.aggregate("hits", start, step, lambda acc: acc["n"]).alias("n_hit"), "hits", "items", F.array_except("near", "items").alias("near_items")
    )


def contaminated(n_hit, n_words):
    """A twentieth of the words or more stands in occurrences of windows."""
    return (n_hit > 0) & (F.lit(20) * n_hit >= n_words)


def clean(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated by ``items``. A row is known
    by its id and its text's digest, so rows that share an id are judged apart. The others
    stay where they are if the contaminated are few enough to be broadcast."""
    text_of = F.col(f"`{text}`")
    digest = F.sha2(F.coalesce(text_of, F.lit("")), 256)
    found = find(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), digest.alias("digest"), text_of.alias("text")), items, slop=0)
    bad = found.filter(contaminated(F.col("n_hit"), F.col("n_words"))).select(F.col("row.doc_id").alias("bad_id"), F.col("row.digest").alias("bad")).distinct()
    bad = sized(bad, "contaminated")
    own = docs.select(F.struct("*").alias("doc"), F.col(f"`{doc_id}`").alias("own_id"), digest.alias("own"))
    return own.join(bad, F.col("own_id").eqNullSafe(F.col("bad_id")) & (F.col("own") == F.col("bad")), "left_anti").select("doc.*")
