"""Exact top-k by inner product: dual-tree search with cover trees.

Vectors go to the nearest of a bounded set of drawn centres and so into shards of
bounded size, each of which is put into a cover tree; so are the queries, in blocks
by the same centres. Each pair of a query block and a shard is one dual-tree walk: a
pair of nodes is pruned when even the best product that their covering radii allow is
below the worst kth score of the node's queries.

A block first walks the shards of its own centre. The kth scores that it has from
there go along to all other shards, most of which they rule out at the root if the
vectors lie in clusters. Queries are sent to the shards in lists of bounded size;
vectors are shuffled once, into shards, and after that only results are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusqa.llm.common import release, stored

CENTRES = 1024  # drawn centres, at most
SHARD_ROWS = 4096  # vectors of a shard, about
BLOCK_ROWS = 1024  # queries of a block, at most
LIST_BYTES = 1 << 25  # of query components that are sent to the shards at a time, about
BRANCHES = 8  # children of a node, at most
LEAF = 64  # vectors of a leaf, at most; a pair of leaves is one matrix product
QUERY_LEAF = 16  # queries of a leaf, at most
EXACT = 1 << 53  # whole numbers below this are exact as doubles


class CoverTree:
    """Nodes of a cover tree over the rows of a matrix.

    A node has a centre (one of its points), a covering radius and its points as
    a range of ``order``. Its children's centres are drawn farthest first until
    they cover it with half its radius, or ``BRANCHES`` are drawn, and each point
    goes to the nearest. So the centres of siblings lie at least as far apart as
    the largest of their covering radii. Nodes of up to ``leaf`` points, or of
    radius zero, are leaves.
    """

    def __init__(self, x, leaf: int = LEAF):
        import numpy as np

        self.x, self.leaf = x, leaf
        self.order = np.arange(len(x))
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.span: list[tuple[int, int]] = []
        self.children: list[list[int]] = []
        if len(x):
            self._grow()
        self.centre, self.radius = np.array(self.centre, np.int64), np.array(self.radius)

    def _distance(self, points, centre):
        import numpy as np

        d = points - centre
        return np.sqrt(np.einsum("ij,ij->i", d, d))

    def _grow(self) -> None:
        import numpy as np

        stack = [(0, len(self.x), 0, -1)]  # begin, end, centre, parent
        while stack:
            begin, end, centre, parent = stack.pop()
            node = len(self.centre)
            own = self.order[begin:end]
            far = self._distance(self.x[own], self.x[centre])
            self.centre.append(centre)
            self.radius.append(float(far.max()))
            self.span.append((begin, end))
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(node)
            if end - begin <= self.leaf or self.radius[node] == 0:
                continue
            nearest, which, centres = far.copy(), np.zeros(len(own), np.int64), [centre]
            while nearest.max() > self.radius[node] / 2 and len(centres) < BRANCHES:
                new = int(own[int(nearest.argmax())])
                d = self._distance(self.x[own], self.x[new])
                closer = d < nearest
                which[closer] = len(centres)
                nearest = np.minimum(nearest, d)
                centres.append(new)
            by = np.argsort(which, kind="stable")
            self.order[begin:end] = own[by]
            ends = begin + np.cumsum(np.bincount(which, minlength=len(centres)))
            first = begin
            for c, last in zip(centres, ends.tolist()):
                stack.append((first, last, c, node))
                first = last


class Points:
    """Vectors of whole numbers with ids and their cover tree. Components are doubles or,
    where products could reach 2^53, Python integers in object arrays."""

    def __init__(self, x, ids, leaf: int = LEAF):
        import numpy as np

        self.x, self.ids = x, np.array(ids, np.int64)
        self.tree = CoverTree(x.astype(float), leaf)
        self.norm = np.sqrt(np.einsum("ij,ij->i", self.tree.x, self.tree.x))

    def exact(self) -> Points:
        import numpy as np

        whole = np.array([[int(e) for e in r] for r in self.x], object)
        return Points(whole.reshape(self.x.shape), self.ids, self.tree.leaf)


def dual_search(queries: Points, data: Points, k: int, floor=None, tally: list | None = None):
    """For each query its ``k`` best rows of ``data`` by inner product, ties to
    the smaller id, never a row of its own id: lists of (score, id) by query.

    ``floor`` holds for each query a score that ``k`` other rows are known to reach
    (-inf: none): what is below is left out. The number of products that were taken
    is added to ``tally``.
    """
    import numpy as np

    q, x, q_ids, x_ids = queries.x, data.x, queries.ids, data.ids
    if not len(q) or not len(x):
        return [[] for _ in q_ids]
    exact = q.dtype == object
    qt, xt = queries.tree, data.tree
    # the k best so far of each query, by falling score, then id; worst: the kth score, or the floor
    best = np.full((len(q), k), -np.inf, q.dtype)
    best_ids = np.full((len(q), k), np.iinfo(np.int64).max)
    worst = np.full(len(q), -np.inf, q.dtype) if floor is None else np.array(floor, q.dtype)

    def bounds(a, b):
        """The largest product of a point of query node a and one of data node b; either may be a list."""
        ca, cb, ra, rb = qt.centre[a], xt.centre[b], qt.radius[a], xt.radius[b]
        qn, xn = queries.norm[ca], data.norm[cb]
        top = (qt.x[ca] * xt.x[cb]).sum(axis=-1) + ra * xn + rb * qn + ra * rb
        return top + 1e-9 * (np.abs(top) + (ra + qn) * (rb + xn))  # rounding

    def products_of(i, j):
        if tally is not None:
            tally.append(len(i) * len(j))
        products = q[i] @ x[j].T
        products[q_ids[i][:, None] == x_ids[j]] = -np.inf
        return products

    def seed(i) -> None:
        """A first floor for queries ``i``: the kth score in the leaf on the way of the best centres."""
        ways = [(0, i)]
        while ways:
            b, i = ways.pop()
            if xt.children[b]:
                way = (qt.x[i] @ xt.x[xt.centre[xt.children[b]]].T).argmax(axis=1)
                ways += [(c, i[way == n]) for n, c in enumerate(xt.children[b]) if (way == n).any()]
            elif xt.span[b][1] - xt.span[b][0] >= k:
                worst[i] = np.sort(products_of(i, xt.order[slice(*xt.span[b])]), axis=1)[:, -k]

    def base(a: int, b: int) -> None:
        i, j = qt.order[slice(*qt.span[a])], xt.order[slice(*xt.span[b])]
        ca, far = xt.centre[b], xt.radius[b] * queries.norm[i]
        top = qt.x[i] @ xt.x[ca] + far  # the node's bound for each query alone
        i = i[top + 1e-9 * (np.abs(top) + far + queries.norm[i] * data.norm[ca]) >= worst[i]]
        products = products_of(i, j)
        r, c = np.nonzero((products >= worst[i][:, None]) & (products > -np.inf))
        if not len(r):
            return
        rows = np.unique(r)
        score = np.concatenate([products[r, c], best[i[rows]].ravel()])
        ids = np.concatenate([x_ids[j[c]], best_ids[i[rows]].ravel()])
        of = np.concatenate([r, np.repeat(rows, k)])
        order = sorted(range(len(of)), key=lambda n: (of[n], -score[n], ids[n])) if exact else np.lexsort((ids, -score, of))
        order = np.array(order, np.int64)
        top = order[np.searchsorted(of[order], rows)[:, None] + np.arange(k)]
        best[i[rows]], best_ids[i[rows]] = score[top], ids[top]
        worst[i[rows]] = np.maximum(worst[i[rows]], best[i[rows], -1])

    if (worst == -np.inf).any():
        seed(np.flatnonzero(worst == -np.inf))
    group = np.full(len(qt.centre), -np.inf)  # worst kth score of a query node's points
    stack = [(float(bounds(0, 0)), 0, 0)]
    while stack:
        top, a, b = stack.pop()
        if top >= group[a]:  # what is noted may be out of date: kth scores only rise
            group[a] = worst[qt.order[slice(*qt.span[a])]].min()
        if top < group[a]:
            continue
        qa, xb = qt.children[a], xt.children[b]
        if not qa and not xb:
            base(a, b)
            continue
        if qa and (not xb or qt.radius[a] >= xt.radius[b]):
            pairs = [(top, c, b) for top, c in zip(bounds(qa, b).tolist(), qa)]
        else:
            pairs = [(top, a, c) for top, c in zip(bounds(a, xb).tolist(), xb)]
        stack += sorted(p for p in pairs if p[0] >= group[a])  # the most promising on top
    return [[(int(v), int(n)) for v, n in zip(*own) if v > -np.inf] for own in zip(best, best_ids)]


def quantised(vectors: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """(vec_id, dim, v array<double>): floor(scale * x) of each component. Rows whose
    id or vector is null, or that hold null or non-finite components, are left out."""
    x = F.col(f"`{vector}`")
    odd = F.exists(x, lambda e: e.isNull() | F.isnan(e.cast("double")) | (F.abs(e.cast("double")) == float("inf")))
    rows = vectors.filter(F.col(f"`{vec_id}`").isNotNull() & x.isNotNull() & ~F.coalesce(odd, F.lit(False)))
    value = F.transform(x, lambda e: F.floor(F.lit(float(scale)) * e.cast("double")).cast("double"))
    return rows.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.size(x).alias("dim"), value.alias("v"))


def _matrix(column):
    """An Arrow column of lists of one length, as a matrix of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def centres_of(rows: DataFrame, most: int) -> dict:
    """{dim: matrix}: the vectors of the ``most`` smallest hashes of ids, each once."""
    import numpy as np

    drawn = rows.select(F.xxhash64("vec_id").alias("h"), "vec_id", "dim", "v").orderBy("h", "vec_id", "v").limit(most).collect()
    by_dim: dict = {}
    for r in drawn:
        by_dim.setdefault(r.dim, set()).add(tuple(r.v))
    return {dim: np.array(sorted(own)).reshape(len(own), dim) for dim, own in by_dim.items()}


def _dealt(rows: DataFrame, centres: dict) -> DataFrame:
    """``rows`` (vec_id, dim, v) with ``cell``, the number of the nearest centre of their
    dimension; 0 where none was drawn."""
    shared = rows.sparkSession.sparkContext.broadcast(centres)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        half = {dim: (c * c).sum(axis=1) / 2 for dim, c in shared.value.items()}
        for batch in batches:
            dims = batch.column(1).to_numpy()
            cell = np.zeros(len(dims), np.int64)
            for dim in np.unique(dims).tolist():
                if dim in half and len(half[dim]) > 1:
                    at = np.flatnonzero(dims == dim)
                    v = _matrix(batch.column(2).take(pa.array(at)))
                    cell[at] = (v @ shared.value[dim].T - half[dim]).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=["vec_id", "dim", "v", "cell"])

    return rows.select("vec_id", "dim", "v").mapInArrow(run, "vec_id long, dim int, v array<double>, cell long")


def _blocks(table) -> dict:
    """{dim: [(cell, ids, matrix, floors)]} of an Arrow table of queries, in blocks of one cell."""
    import numpy as np

    out: dict = {}
    table = table.combine_chunks().sort_by([("dim", "ascending"), ("cell", "ascending"), ("vec_id", "ascending")])
    dims, cells = (table.column(c).to_numpy() for c in ("dim", "cell"))
    edges = [0, *(np.flatnonzero((dims[1:] != dims[:-1]) | (cells[1:] != cells[:-1])) + 1).tolist(), len(dims)]
    for begin, end in zip(edges, edges[1:]):
        for a in range(begin, end, BLOCK_ROWS):
            own = table.slice(a, min(BLOCK_ROWS, end - a)).combine_chunks()
            v, ids, floor = (own.column(c).combine_chunks() for c in ("v", "vec_id", "floor"))
            out.setdefault(int(dims[a]), []).append((int(cells[a]), ids.to_numpy(), _matrix(v), floor.to_pylist()))
    return out


def _walks(shards: DataFrame, blocks: dict, k: int, own: bool) -> DataFrame:
    """(query_id, vec_id, score): the walks of the query blocks with the shards of their own
    cell, or with all others."""
    shared = shards.sparkSession.sparkContext.broadcast(blocks)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        trees: dict = {}  # of blocks that the task's shards have met
        for batch in batches:
            for n in range(batch.num_rows):
                dim, cell, rows = (c[n] for c in batch.columns)
                dim, cell = dim.as_py(), cell.as_py()
                met = [i for i, b in enumerate(shared.value.get(dim, ())) if (b[0] == cell) == own]
                if not met:
                    continue
                x = _matrix(rows.values.field("v"))
                data = Points(x, rows.values.field("vec_id").to_numpy())
                most = float(np.abs(x).max()) * dim if dim else 0.0
                for i in met:
                    _, ids, q, floors = shared.value[dim][i]
                    queries = trees.get((dim, i)) or trees.setdefault((dim, i), Points(q, ids, QUERY_LEAF))
                    floors = [-np.inf if f is None else f for f in floors]
                    if dim and float(np.abs(q).max()) * most >= EXACT:
                        found = dual_search(queries.exact(), data.exact(), k, floors)
                    else:
                        found = dual_search(queries, data, k, floors)
                    out = [(a, j, s) for a, best in zip(ids.tolist(), found) for s, j in best]
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["query_id", "vec_id", "score"])

    return shards.select("dim", "cell", "rows").mapInArrow(run, "query_id long, vec_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def search(vectors: DataFrame, queries, k: int, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: for each row for which the column ``queries``
    (over vec_id) holds, its ``k`` best other rows by inner product of quantised
    vectors; all, if fewer. Vectors are compared with those of their own number of
    components. Of ids that repeat, each row is a candidate, but not for its own id,
    and the smallest vector is the query. An empty table gives an empty result."""
    rows = stored(quantised(vectors, vec_id, vector, scale), "quantised")
    centres = centres_of(rows, min(CENTRES, -(-rows.count() // SHARD_ROWS)))
    dealt = stored(_dealt(rows, centres), "dealt")
    counts = dealt.groupBy("dim", "cell").agg(F.ceil(F.count("*") / F.lit(SHARD_ROWS)).alias("parts"))
    placed = dealt.withColumn("at", F.monotonically_increasing_id()).join(counts, ["dim", "cell"])
    shards = placed.groupBy("dim", "cell", F.pmod("at", "parts")).agg(F.collect_list(F.struct("vec_id", "v")).alias("rows"))
    shards = stored(shards.select("dim", "cell", "rows"), "shards")
    asked = dealt.filter(queries).groupBy("vec_id").agg(F.min(F.struct("dim", "v", "cell")).alias("own"))
    asked = stored(asked.select("vec_id", "own.*"), "queries")
    release(rows, dealt)
    size = asked.agg(F.coalesce(F.sum(F.col("dim").cast("long") + 4), F.lit(0))).first()[0] * 8
    lists = max(1, -(-size // LIST_BYTES))
    found = []
    for n in range(lists):
        own = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(lists)) == n)
        blocks = _blocks(own.withColumn("floor", F.lit(None).cast("long")).toArrow())
        found.append(stored(_walks(shards, blocks, k, own=True), "found"))
        if any(len(c) > 1 for c in centres.values()):
            floors = _best(found[-1], k).filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
            blocks = _blocks(own.join(floors, "vec_id", "left").toArrow())
            found.append(stored(_walks(shards, blocks, k, own=False), "found"))
    return _best(reduce(DataFrame.union, found), k).select("query_id", "rank", "vec_id", "score")
