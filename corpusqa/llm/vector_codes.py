"""Product codes of vectors; a codebook's entries are searched through a GNAT.

A vector becomes integers and is cut into parts. Each part position has a codebook,
made by rounds of assigning every part to its nearest entry and moving the entries
to the floored means. Entries and rounds are a bounded table on the driver; what a
task passes on in a round is one count and sum for each entry and component.

The nearest entry is found in a geometric near-neighbour access tree (Brin 1995):
a node's split points keep, for every child, the least and largest distance from
the split point to the child's entries. Where a query's own distance to a split
point lies outside such a range by more than the query's best distance so far, the
child goes as a whole. Ranges and best distances are widened by more than what
rounding can cost, and a child goes only if it is strictly out of reach, so equal
distances stay; entries themselves are compared by exact integer squared distances.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusqa.llm.common import stored, widen

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
BRANCHES = 8  # split points of a node, at most
LEAF = 8  # entries of a leaf, at most, unless they are all equal
LIMIT = 1 << 26  # integers beyond it are set to it, so that squared distances stay exact
WIDER = 1e-9  # of a distance; a double's rounding is 1e-16


class Gnat:
    """Nearest of integer points, ties to the lower index. ``compared`` counts the
    distances that were taken."""

    def __init__(self, points):
        self.points, self.compared = points, 0
        self.root = self._node(list(range(len(points))))

    def _distance(self, i, own):
        import numpy as np

        d = self.points[own] - self.points[i]
        return np.sqrt((d * d).sum(axis=1).astype(float))

    def _node(self, own: list[int]):
        """(split points or the leaf's entries, least, largest, children)."""
        import numpy as np

        far = self._distance(own[0], own)
        if len(own) <= LEAF or not far.any():
            return np.array(own), None, None, []
        splits, near = [own[0]], far
        while len(splits) < BRANCHES and near.any():
            splits.append(own[int(near.argmax())])
            near = np.minimum(near, self._distance(splits[-1], own))
        splits.sort()
        to = np.array([self._distance(s, own) for s in splits])
        which, inner = to.argmin(axis=0), ~np.isin(own, splits)
        children, least, largest = [], [], []
        for j in range(len(splits)):
            at = np.flatnonzero((which == j) & inner)
            if len(at):
                children.append(self._node([own[i] for i in at]))
                least.append(to[:, at].min(axis=1) * (1 - WIDER))
                largest.append(to[:, at].max(axis=1) * (1 + WIDER))
            else:
                children.append(None)
                least.append(np.full(len(splits), np.inf))
                largest.append(np.full(len(splits), -np.inf))
        return np.array(splits), np.array(least), np.array(largest), children

    def nearest(self, queries):
        """(index, squared distance) of each row's nearest point."""
        import numpy as np

        best = np.full(len(queries), np.iinfo(np.int64).max)
        index = np.full(len(queries), len(self.points))

        def visit(node, at):
            if not len(at):
                return
            ids, least, largest, children = node
            d = queries[at][:, None, :] - self.points[ids]
            d = np.einsum("qew,qew->qe", d, d)
            self.compared += d.size
            first = d.argmin(axis=1)  # the lowest index: ids rise
            own, entry = d[np.arange(len(at)), first], ids[first]
            better = (own < best[at]) | (own == best[at]) & (entry < index[at])
            best[at[better]], index[at[better]] = own[better], entry[better]
            if not children:
                return
            away = np.sqrt(d.astype(float))
            for own_child in (True, False):  # the child of the nearest split point first
                for j, child in enumerate(children):
                    if child is None:
                        continue
                    some = np.flatnonzero((first == j) == own_child)
                    reach = np.sqrt(best[at[some]].astype(float))[:, None] * (1 + WIDER)
                    near = away[some]
                    inside = (near * (1 - WIDER) - largest[j] <= reach) & (least[j] - near * (1 + WIDER) <= reach)
                    visit(child, at[some[inside.all(axis=1)]])

        visit(self.root, np.arange(len(queries)))
        return index, best


def quantised(vectors: DataFrame, vec_id: str, vector: str, label: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, dim, v array<int>): floor(scale * x) of each component, of the rows
    whose vector is not null and holds no null or non-finite component."""
    x = F.col(f"`{vector}`")
    odd = F.exists(x, lambda e: e.isNull() | F.isnan(e.cast("double")) | (F.abs(e.cast("double")) == float("inf")))
    whole = lambda e: F.greatest(F.least(F.floor(F.lit(float(scale)) * e.cast("double")), F.lit(LIMIT)), F.lit(-LIMIT)).cast("int")
    # a product beyond the largest double is infinite, and so past the limit
    value = F.transform(x, lambda e: F.when(F.abs(e.cast("double")) < float(LIMIT), whole(e)).when(e > 0, LIMIT).otherwise(-LIMIT))
    rows = vectors.filter(x.isNotNull() & ~F.coalesce(odd, F.lit(False)))
    return rows.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{label}`").alias("label"), F.size(x).alias("dim"), value.alias("v"))


def bounds(dim: int, parts: int) -> list[tuple[int, int]]:
    """Where each part begins and ends. If ``dim`` isn't a multiple, the first parts are one longer."""
    size, more = divmod(dim, parts)
    ends = [i * size + min(i, more) for i in range(parts + 1)]
    return list(zip(ends, ends[1:]))


def _matrix(column, dim: int):
    import numpy as np

    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


def _moved(rows: DataFrame, books: list, dim: int) -> list:
    """The codebooks after one round over all ``rows``."""
    import numpy as np

    spans = bounds(dim, len(books))

    def run(batches):
        import pyarrow as pa

        trees = [Gnat(b) for b in books]
        count = [np.zeros(len(b), np.int64) for b in books]
        total = [np.zeros_like(b) for b in books]
        for batch in batches:
            v = _matrix(batch.column(0), dim)
            for p, (first, last) in enumerate(spans):
                entry, _ = trees[p].nearest(v[:, first:last])
                count[p] += np.bincount(entry, minlength=len(books[p]))
                for place in range(first, last):  # a batch's sums are exact as doubles
                    total[p][:, place - first] += np.bincount(entry, v[:, place], len(books[p])).astype(np.int64)
        out = [(p, e, w, int(total[p][e, w]), int(count[p][e])) for p in range(len(books)) for e in np.flatnonzero(count[p]).tolist() for w in range(total[p].shape[1])]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["part", "entry", "place", "total", "n"])

    sums = rows.select("v").mapInArrow(run, "part long, entry long, place long, total long, n long")
    out = [b.copy() for b in books]
    for r in sums.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():  # as many as the codebooks have numbers
        out[r.part][r.entry, r.place] = r.total // r.n
    return out


def _coded(rows: DataFrame, books: list, dim: int) -> DataFrame:
    """vec_id, label, code, error."""
    spans = bounds(dim, len(books))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        trees = [Gnat(b) for b in books]
        for batch in batches:
            v = _matrix(batch.column(2), dim)
            found = [tree.nearest(v[:, first:last]) for tree, (first, last) in zip(trees, spans)]
            text = np.array([entry for entry, _ in found], np.uint8).T.tobytes().hex()
            size = 2 * len(books)
            codes = pa.array([text[i : i + size] for i in range(0, len(text), size)], pa.string())
            error = pa.array(sum(d for _, d in found), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), codes, error], names=["vec_id", "label", "code", "error"])

    schema = T.StructType([rows.schema["vec_id"], rows.schema["label"]])
    return rows.select("vec_id", "label", "v").mapInArrow(run, widen(schema, "code string, error long"))


def encode(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, dict[int, list]]:
    """(vec_id, label, dim, code, error) and, by number of components, the codebooks:
    for each part an integer matrix of up to ``entries`` (at most 256) rows.

    Rows whose vector is null or holds null or non-finite components are left out; a
    null vec_id comes after all others, a null label is a label. Vectors of another
    number of components have codebooks of their own, made one after the other; if
    the number isn't a multiple of ``parts``, the first parts are one longer. With fewer vectors
    than ``entries`` the codebooks are as short. Repeated ids are vectors each; the
    smaller vector comes first. Components beyond 2^26 in size, scaled, count as 2^26.
    An empty table gives an empty result and no codebooks.
    """
    import numpy as np

    rows = stored(quantised(vectors, vec_id, vector, label, scale), "vectors")
    books: dict[int, list] = {}
    coded = []
    for dim in sorted(r.dim for r in rows.select("dim").distinct().collect()):
        own = rows.filter(F.col("dim") == dim)
        first = [r.v for r in own.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).select("v").collect()]
        start = np.array(first, np.int64).reshape(len(first), dim)
        books[dim] = [start[:, a:b].copy() for a, b in bounds(dim, parts)]
        for _ in range(rounds):
            books[dim] = _moved(own, books[dim], dim)
        coded.append(_coded(own, books[dim], dim).withColumn("dim", F.lit(dim)))
    if not coded:
        empty = rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), "dim")
        return empty, books
    return reduce(DataFrame.union, coded), books


def digest(books: list) -> str:
    """sha256 of all integers of the codebooks, by part, entry and place."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` with label_error: the sum of the errors of equal labels (nulls together),
    null where it is no long."""
    total = F.expr("try_cast(sum(cast(error as decimal(38, 0))) as bigint)")
    by = coded.groupBy("label").agg(total.alias("label_error")).withColumnRenamed("label", "of")
    return coded.join(by, F.col("label").eqNullSafe(F.col("of"))).drop("of")
