"""Lexical retrieval as ordinary tables.

The index is four tables, and a view of one:

* ``blocks(shard, term, docids, tfs, dls)`` -- the postings of a term within a shard of
  documents, by docid, as lists side by side. Where they are written, a row without a term
  comes first in each shard: its documents and their lengths
* ``postings(term, docid, tf, dl)``  -- one row per (term, document): the same, unrolled
* ``term_stats(term, df)``
* ``doc_stats(docid, dl)``, with each document's shard
* ``corpus_stats(n_docs, avgdl, n_terms, n_postings)``

Texts go to their shard once and are analysed once there; what is counted, sorted and listed there
stays there.

Search is BM25 (Robertson & Zaragoza 2009):
``sum qtf * ln(1 + (N - df + 0.5)/(df + 0.5)) * tf / (tf + k1 * (1 - b + b * dl / avgdl))``
Each shard reads the postings of the questions' terms once, then the questions, as a stream; it keeps
the k best documents of a question and passes over stretches of ``BLOCK`` postings that cannot lift a document
among them (block-max bounds, Ding & Suel 2011). Only k rows a shard and question go on to
the question's top-k (``row_number() <= k``, a partial + final ``WindowGroupLimit``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusqa.functions.text import analyze
from corpusqa.session import exists, materialize, release, target_partitions

# Fixed BM25 parameters (the usual defaults of full-text search servers).
K1 = 1.2
B = 0.75
# Default number of documents retrieved per question.
DEFAULT_K = 10
BLOCK = 128  # postings of a block
SHARD_DOCS = 16_384  # documents of a shard, about, at most
PART_TERMS = 16_000_000  # terms of the documents that are searched as one part, about, at most
ROWS_BYTES = 1 << 26  # of a part's frequent terms as rows over all its documents
ASKED = 8_192  # questions of a list
MANY = 4_096  # questions that are stored before the search
SLACK = 2e-6  # of a score: scores that are equal when rounded are told apart by docid
LISTS = ("docids", "tfs", "dls")


@dataclass
class Index:
    postings: DataFrame
    blocks: DataFrame
    term_stats: DataFrame
    doc_stats: DataFrame
    corpus_stats: DataFrame
    docs: DataFrame  # (docid, dl, shard): ``doc_stats`` with the shard whose blocks hold the document
    dead: DataFrame | None = None  # (docid, shard): documents in ``blocks`` that count no more
    shards: list[int] | None = None  # numbers in ``blocks``; None: read them there
    counted: DataFrame | None = None  # ``blocks`` with the rows of documents: what is written


def build_index(passages: DataFrame, text_col: str = "passage", analyzer=None, shards: int | None = None,
                digest: bool = False) -> Index:
    """Build the index tables from (docid, passage).

    Documents are dealt to shards by a hash of the docid: the one shuffle, of the texts.
    Terms are counted per document and gathered per term within the shard.
    ``analyzer(col) -> array<string>`` replaces the built-in analyser; use the
    same one for queries. The tables are lazy: ``held`` or ``write_index`` make them once.
    With ``digest`` the documents in ``counted`` have the SHA-256 of their texts.
    """
    n = shards or shard_count(passages.sparkSession, passages.count())
    terms = passages.select("docid", (analyzer or analyze)(text_col).alias("terms"))
    docs = terms.select("docid", F.size("terms").cast("long").alias("dl"), shard_of("docid", n).cast("long").alias("shard"))
    corpus = docs.agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.avg("dl").alias("avgdl"),
    )
    dealt = passages.select(shard_of("docid", n).alias("shard"), "docid", F.col(text_col).alias("passage"))
    dealt = dealt.repartitionById(n, "shard").sortWithinPartitions("shard")
    own = [F.sha2("passage", 256).alias("digest")] if digest else []
    terms = dealt.select("shard", "docid", (analyzer or analyze)("passage").alias("terms"), *own)
    lists = [*zip(LISTS, (terms.schema["docid"].dataType, T.IntegerType(), T.IntegerType())), *[("digests", T.StringType())] * digest]
    schema = T.StructType([T.StructField("shard", T.LongType()), T.StructField("term", T.StringType()), *[T.StructField(name, T.ArrayType(t)) for name, t in lists]])
    counted = terms.groupBy("shard").applyInArrow(_count_shard, schema)
    blocks = term_blocks(counted)
    return Index(unroll(blocks), blocks, document_frequencies(blocks), docs.select("docid", "dl"), corpus, docs, shards=list(range(n)), counted=counted)


def term_blocks(counted: DataFrame) -> DataFrame:
    return counted.filter(F.col("term").isNotNull()).select("shard", "term", *LISTS)


def counted_docs(counted: DataFrame, digest: bool = False) -> DataFrame:
    """The documents (docid, dl, shard) in ``counted``, with their ``digest`` if it was taken."""
    lists = {"docid": "docids", "dl": "dls"} | ({"digest": "digests"} if digest else {})
    rows = counted.filter(F.col("term").isNull()).select("shard", F.inline_outer(F.arrays_zip(*lists.values())).alias(*lists))
    return rows.select("docid", F.col("dl").cast("long").alias("dl"), *(["digest"] if digest else []), "shard")


def _count_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks of one shard from its documents (shard, docid, terms), by term, after a row with the
    documents as they came; a docid that comes again is one document with the first one's length."""
    import numpy as np
    import pyarrow.compute as pc

    shard, terms, lengths, docids, digests = None, [], [], [], []
    for batch in batches:
        shard = batch.column("shard")[0].as_py() if batch.num_rows else shard
        rows = batch.column("terms")
        terms.append(rows.flatten().dictionary_encode())
        lengths.append(pc.list_value_length(rows))
        docids.append(batch.column("docid"))
        if "digest" in batch.schema.names:
            digests.append(batch.column("digest"))
    if shard is None:
        return
    lengths, docids = pa.concat_arrays(lengths), pa.concat_arrays(docids)
    whole = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
    no_digests = [pa.nulls(1, pa.list_(pa.string()))] if digests else []
    names = ["shard", "term", *LISTS, *["digests"] * len(no_digests)]
    own = [whole(docids), pa.nulls(1, pa.list_(pa.int32())), whole(lengths.cast(pa.int32())), *([whole(pa.concat_arrays(digests))] if digests else [])]
    yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.nulls(1, pa.string()), *own], names=names)
    if not sum(map(len, terms)):
        return
    sizes = pc.fill_null(lengths, 0).to_numpy()
    ids = docids.dictionary_encode("encode")
    by_id = pc.sort_indices(ids.dictionary, null_placement="at_start").to_numpy()
    place = np.empty(len(by_id), np.int64)
    place[by_id] = np.arange(len(by_id))
    doc = place[ids.indices.to_numpy()]
    dl = np.zeros(len(by_id), np.int32)
    dl[doc[::-1]] = sizes[::-1]
    coded = pa.chunked_array(terms).unify_dictionaries().combine_chunks()
    coded = coded.chunk(0) if isinstance(coded, pa.ChunkedArray) else coded
    by_term = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(by_term), np.int64)
    rank[by_term] = np.arange(len(by_term))
    code = pc.fill_null(coded.indices, -1).to_numpy()
    del terms
    key = (rank[code] * len(by_id) + np.repeat(doc, sizes))[code >= 0]  # a null is no term
    key, tf = np.unique(key, return_counts=True)
    term, doc = np.divmod(key, len(by_id))
    first = np.flatnonzero(np.diff(term, prepend=-1))
    ends = np.append(first, len(term))
    words, docid = coded.dictionary.take(pa.array(by_term[term[first]])), ids.dictionary.take(pa.array(by_id[doc]))
    lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), x) for x in (docid, pa.array(tf, pa.int32()), pa.array(dl[doc]))]
    lists += [pa.nulls(len(words), pa.list_(pa.string())) for _ in no_digests]
    out = pa.RecordBatch.from_arrays([pa.array(np.full(len(words), shard)), words, *lists], names=names)
    for at in range(0, len(words), 1 << 16):
        yield out.slice(at, 1 << 16)


def shard_count(spark: SparkSession, n_docs: int) -> int:
    """Shards of ``n_docs`` documents: at most about ``SHARD_DOCS`` in each, and as many
    shards as the cluster runs at once if the documents are few."""
    return max(-(-n_docs // SHARD_DOCS), min(target_partitions(spark), -(-n_docs // 512)), 1)


def shard_of(docid: str, shards: int) -> Column:
    """A document's shard; shards are partitions to ``repartitionById``."""
    return F.pmod(F.xxhash64(docid), F.lit(shards).cast("long")).cast("int")


def gather_blocks(counted: DataFrame) -> DataFrame:
    """Rows (shard, docid, term, tf, dl), dealt by shard, as ``blocks``: no shuffle. Documents are dealt
    by a hash of the docid, so a term of every document is a bounded row in each shard."""
    rows = counted.groupBy("shard", "term").agg(F.sort_array(F.collect_list(F.struct("docid", "tf", "dl"))).alias("p"))
    lists = [F.col("p")[field].alias(name) for field, name in zip(("docid", "tf", "dl"), LISTS)]
    return rows.select(F.col("shard").cast("long").alias("shard"), "term", *lists)


def unroll(blocks: DataFrame) -> DataFrame:
    """The postings (term, docid, tf, dl) of ``blocks``."""
    rows = blocks.select("term", F.inline_outer(F.arrays_zip(*LISTS)).alias("docid", "tf", "dl"))
    return rows.select("term", "docid", F.col("tf").cast("long").alias("tf"), F.col("dl").cast("long").alias("dl"))


def document_frequencies(blocks: DataFrame) -> DataFrame:
    return blocks.groupBy("term").agg(F.sum(F.size("docids")).alias("df"))


def held(index: Index) -> Index:
    """The index of ``build_index`` with its blocks and documents written below the checkpoint folder:
    all tables come from them, so that texts are read and analysed once."""
    counted = materialize(index.counted, "blocks")
    blocks, docs = term_blocks(counted), counted_docs(counted)
    corpus = docs.agg(F.count(F.lit(1)).alias("n_docs"), F.avg("dl").alias("avgdl"))
    return replace(index, blocks=blocks, postings=unroll(blocks), term_stats=document_frequencies(blocks), corpus_stats=corpus,
                   doc_stats=docs.select("docid", "dl"), docs=docs, counted=counted)


def _flat(rows: pa.Table, name: str):
    return rows.column(name).combine_chunks().flatten()


def _chosen(rows: pa.Table, mask, lists: dict) -> pa.Table:
    """``rows`` with ``lists``, flat arrays as long as the rows' docids, in place of those of the
    same names: in each row the entries where ``mask`` is set; rows without any are left out."""
    import numpy as np
    import pyarrow.compute as pc

    sizes = pc.list_value_length(rows.column("docids")).to_numpy()
    ends = np.concatenate([[0], np.cumsum(mask.to_numpy(zero_copy_only=False))])[np.concatenate([[0], np.cumsum(sizes)])]
    out = rows.drop_columns([name for name in lists if name in rows.column_names])
    for name, values in lists.items():
        out = out.append_column(name, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values.filter(mask)))
    return out.filter(pa.array(np.diff(ends) > 0))


def blocks_of(blocks: DataFrame, docids: DataFrame, without: bool = False) -> DataFrame:
    """``blocks`` cut to the documents of ``docids(docid, shard)``, or, with ``without``, to all
    others: shard by shard, each block's row once. Null is a docid like any other."""

    def cut(rows: pa.Table, own: pa.Table) -> pa.Table:
        import pyarrow.compute as pc

        found = pc.is_in(_flat(rows, "docids"), value_set=own.column("docid").combine_chunks())
        return _chosen(rows, pc.invert(found) if without else found, {name: _flat(rows, name) for name in LISTS}).select(names)

    names = blocks.columns
    return blocks.groupBy("shard").cogroup(docids.select("docid", "shard").groupBy("shard")).applyInArrow(cut, blocks.schema)


def frequencies_of(blocks: DataFrame, docids: DataFrame) -> DataFrame:
    """(term, df) among the documents of ``docids(docid, shard)`` alone: shard by shard, where only
    the docids of a block go. Null is a docid like any other."""

    def count(rows: pa.Table, own: pa.Table) -> pa.Table:
        import numpy as np
        import pyarrow.compute as pc

        found = pc.is_in(_flat(rows, "docids"), value_set=own.column("docid").combine_chunks()).to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(rows.column("docids")).to_numpy())])
        df = np.diff(np.concatenate([[0], np.cumsum(found)])[ends])
        return pa.table({"term": rows.column("term"), "df": pa.array(df, pa.int64())}).filter(pa.array(df > 0))

    own = blocks.select("shard", "term", "docids").groupBy("shard").cogroup(docids.select("docid", "shard").groupBy("shard"))
    return own.applyInArrow(count, "term string, df long").groupBy("term").agg(F.sum("df").alias("df"))


def postings_with_stats(index: Index) -> DataFrame:
    """Every posting with its term's and its document's statistics: (term, docid, tf, dl, df,
    doc_dl). Terms meet the blocks' rows, documents their shard's; postings are unrolled at the end.
    A null docid meets no document."""

    def meet(rows: pa.Table, docs: pa.Table) -> pa.Table:
        import pyarrow.compute as pc

        place = pc.index_in(_flat(rows, "docids"), value_set=docs.column("docid").combine_chunks(), skip_nulls=True)
        lists = {name: _flat(rows, name) for name in LISTS} | {"doc_dls": docs.column("dl").combine_chunks().take(place)}
        return _chosen(rows, pc.is_valid(place), lists).select(names)

    blocks = index.blocks.join(index.term_stats, "term").select("shard", "term", "df", *LISTS)
    schema = T.StructType([*blocks.drop("shard").schema, T.StructField("doc_dls", T.ArrayType(T.LongType()))])
    names = schema.names
    met = blocks.groupBy("shard").cogroup(index.docs.groupBy("shard")).applyInArrow(meet, schema)
    rows = met.select("term", "df", F.inline_outer(F.arrays_zip(*LISTS, "doc_dls")).alias("docid", "tf", "dl", "doc_dl"))
    return rows.select("term", "docid", F.col("tf").cast("long").alias("tf"), F.col("dl").cast("long").alias("dl"), "df", "doc_dl")


def corpus_stats(index: Index) -> DataFrame:
    """One row: documents, average length, distinct terms, postings."""
    c = index.corpus_stats
    return c.select(
        F.col("n_docs").cast("long").alias("n_docs"),
        F.col("avgdl").alias("avgdl"),
        index.term_stats.select(F.count(F.lit(1))).scalar().cast("long").alias("n_terms"),
        index.postings.select(F.count(F.lit(1))).scalar().cast("long").alias("n_postings"),
    )


# Rows per written postings file (keeps files in the hundreds of MB at any scale).
MAX_ROWS_PER_FILE = 20_000_000


def write_index(index: Index, path: str, buckets: int | None = None, mode: str = "overwrite") -> None:
    """Persist the index as Parquet.

    Blocks are written where they are made, a shard's documents, then its rows by term; all else comes
    from the stored blocks. Postings lie in them by (term, docid) shard after shard and are
    unrolled when read. With ``buckets`` they are also written one by one, range-partitioned by
    (term, docid) into so many parts: a very
    common term is split over several files, and Parquet min/max statistics still
    prune by term. A document without any term is in ``doc_stats`` with ``dl = 0``. Overwrite makes the build
    idempotent (Q6).
    """
    spark = index.blocks.sparkSession
    index.counted.sortWithinPartitions("shard", "term").write.mode(mode).parquet(f"{path}/blocks")
    counted = spark.read.parquet(f"{path}/blocks")
    blocks = term_blocks(counted)
    if buckets:
        postings = unroll(blocks).repartitionByRange(buckets, "term", "docid").sortWithinPartitions("term", "docid")
        postings.write.mode(mode).option("maxRecordsPerFile", MAX_ROWS_PER_FILE).parquet(f"{path}/postings")
    counted_docs(counted).write.mode(mode).parquet(f"{path}/doc_stats")
    document_frequencies(blocks).write.mode(mode).parquet(f"{path}/term_stats")
    ds = spark.read.parquet(f"{path}/doc_stats")
    ds.agg(F.count(F.lit(1)).alias("n_docs"), F.avg("dl").alias("avgdl")).write.mode(mode).parquet(
        f"{path}/corpus_stats"
    )


def read_index(spark: SparkSession, path: str) -> Index:
    """Open a stored index."""
    r = spark.read
    docs, counted = r.parquet(f"{path}/doc_stats"), r.parquet(f"{path}/blocks")
    blocks = term_blocks(counted)
    return Index(
        r.parquet(f"{path}/postings") if exists(spark, f"{path}/postings") else unroll(blocks),
        blocks,
        r.parquet(f"{path}/term_stats"),
        docs.select("docid", "dl"),
        r.parquet(f"{path}/corpus_stats"),
        docs,
        counted=counted,
    )


def query_terms(questions: DataFrame, id_col: str = "id", text_col: str = "question", analyzer=None) -> DataFrame:
    """R2 on questions: (id, term, qtf). A repeated query word counts once per
    occurrence, as a match query's clauses do."""
    return (
        questions.select(F.col(id_col).alias("id"), (analyzer or analyze)(text_col).alias("_terms"))
        .select("id", F.explode_outer("_terms").alias("term"))
        .filter(F.col("term").isNotNull())
        .groupBy("id", "term")
        .agg(F.count(F.lit(1)).alias("qtf"))
    )


def _over(scores, least):
    """Places of ``scores`` that are over ``least``: looked for by eight."""
    import numpy as np

    over = scores > least
    if len(over) % 8 or len(over) < 4096:
        return np.flatnonzero(over)
    eights = np.flatnonzero(over.view(np.uint64))
    if 4 * len(eights) > len(over) // 8:
        return np.flatnonzero(over)
    row, column = over.reshape(-1, 8)[eights].nonzero()
    return eights[row] * 8 + column


def best_of_shard(docs, norms, tops, block_tops, weights, k: int, scores, rows=None, spare=None, rank=None, least: float = -math.inf):
    """A question's best ``k`` documents of a shard: (places, scores, postings read).

    One entry for each of the question's terms: ``docs`` rising places of documents,
    ``norms`` what a posting gives for a weight of one, ``tops`` and ``block_tops`` the
    largest of these in all and by block, ``weights``. ``rows``: a matrix of what some terms
    give in each of the shard's documents, and each term's row there or -1.
    ``scores`` and ``spare`` are zeroed arrays over
    the shard's documents, and are so again afterwards. Equal scores are told apart by ``rank``, else by place.
    ``least``: a kth score among other documents; what lies below is not wanted.

    Terms go by rising number of postings. The best documents by the rarest terms are scored
    in full: their kth score is a bound. Once it is beyond what the remaining
    terms can give together, no new document can enter: from then on only documents
    that still can are looked up, and only in blocks whose bound can lift them.
    """
    import numpy as np

    spare = np.zeros_like(scores) if spare is None else spare
    matrix, row = rows or (None, [-1] * len(docs))
    order = sorted(range(len(docs)), key=lambda t: len(docs[t]))
    sizes = [len(docs[t]) for t in order]
    rest = [0.0] * (len(order) + 1)
    for i in range(len(order) - 1, -1, -1):
        rest[i] = rest[i + 1] + weights[order[i]] * tops[order[i]]
    dense = len(order)  # from here on all terms have a row
    while dense and row[order[dense - 1]] >= 0:
        dense -= 1
    own_rows = np.array([row[t] for t in order[dense:]], np.int64)
    own_weights = np.array([weights[t] for t in order[dense:]])
    worst, n, read, touched = least, 0, 0, []

    def add(i):
        t = order[i]
        if row[t] >= 0:
            scores[:] += matrix[row[t]] * weights[t]
            touched.append(None)
        else:
            touched.append(docs[t].astype(np.int64, copy=False))
            np.add.at(scores, touched[-1], norms[t] * weights[t])
        return sizes[i]

    def gain(i, places):
        """What term ``i`` adds in ``places``."""
        t = order[i]
        if row[t] >= 0:
            return matrix[row[t]].take(places) * weights[t]
        if 4 * len(places) > sizes[i]:
            d = docs[t].astype(np.int64, copy=False)
            spare[d] = norms[t]
            out = spare.take(places) * weights[t]
            spare[d] = 0
            return out
        at = docs[t].searchsorted(places.astype(docs[t].dtype))
        at[at == sizes[i]] = 0
        return norms[t].take(at) * (docs[t].take(at) == places) * weights[t]

    def whole(places, own, i):
        """Scores of ``places``, ``own`` by the terms before ``i``."""
        nonlocal read
        read += len(places) * (len(order) - i)
        for j in range(i, dense):
            own = own + gain(j, places)
        x = max(i - dense, 0)
        return own + own_weights[x:] @ matrix[own_rows[x:, None], places] if x < len(own_rows) else own

    def kth(places, own, i):
        """The kth score among the best of ``places`` by the terms before ``i``."""
        if len(places) > 2 * k:
            best = own.argpartition(-2 * k)[-2 * k :]
            places, own = places[best], own[best]
        return float(np.partition(whole(places, own, i), -k)[-k])

    # first the rare terms: those without a row, if there are rows
    first = max(8 * k, len(scores) >> 5)
    few = 0
    while worst < 0 and n < len(order) and (read < k or read + sizes[n] <= first or rows and n < dense):
        few += read < first
        read += add(n)
        n += 1
    if few and n < len(order) and all(d is not None for d in touched[:few]):
        left = touched[0] if few == 1 else np.concatenate(touched[:few])
        if few > 1:  # each place once
            at = np.arange(len(left))
            spare[left] = at
            left = left[spare.take(left) == at]
            spare[left] = 0
        if len(left) >= k:
            worst = kth(left, scores.take(left), n)
    while n < len(order) and (rest[n] > worst - SLACK or rows and n < dense):
        read += add(n)
        n += 1
    left = _over(scores, max(worst - rest[n] - SLACK, 0))
    own = scores.take(left)
    if len(left) > (2 if least < 0 else 16) * k and n < len(order):
        worst = max(worst, kth(left, own, n))
    for i in range(n, len(order)):
        stay = np.flatnonzero(own + rest[i] > worst - SLACK)
        if len(stay) < len(left):
            left, own = left[stay], own[stay]
        if i >= dense and len(left) <= 32 * k:
            own = whole(left, own, i)
            break
        t = order[i]
        if row[t] < 0 and 4 * len(left) <= sizes[i]:
            at = docs[t].searchsorted(left.astype(docs[t].dtype))
            at[at == sizes[i]] = sizes[i] - 1
            lift = np.flatnonzero(own + weights[t] * block_tops[t].take(at // BLOCK) + rest[i + 1] > worst - SLACK)
            left, own, at = left[lift], own[lift], at[lift]
            own = own + norms[t].take(at) * (docs[t].take(at) == left) * weights[t]
        else:
            own = own + gain(i, left)
        read += len(left)
    if len(own) > 4 * k:
        worst = max(worst, float(np.partition(own, -k)[-k]))
    stay = np.flatnonzero(own > max(worst - SLACK, 0))
    left, own = left[stay], own[stay]
    if 4 * read > len(scores) or any(d is None for d in touched):
        scores.fill(0)
    else:
        for d in touched:
            scores[d] = 0
    best = np.lexsort((left if rank is None else rank.take(left), -np.round(own, 6)))[:k]
    return left[best], own[best], read


def _packed(**lists) -> bytes:
    """``lists`` (Arrow arrays of any lengths) as compressed bytes."""
    row = [pa.LargeListArray.from_arrays(pa.array([0, len(x)], pa.int64()), x) for x in lists.values()]
    batch = pa.RecordBatch.from_arrays(row, names=list(lists))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(data) -> dict:
    with pa.ipc.open_stream(data) as rows:
        batch = rows.read_next_batch()
    return {name: batch.column(name).flatten() for name in batch.schema.names}


_PACKS = "part int, kind int, data binary"


def _packs(parts: list, kinds: list, data: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(kinds, pa.int32()), pa.array(data, pa.binary())], names=["part", "kind", "data"])


def _pack_postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of blocks (part, shard, term, docids, tfs, dls) packed: a document and its length once
    in each pack."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        shards = batch.column("shard").to_numpy()
        ends = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)] if len(shards) else []
        for x, y in zip(ends, ends[1:]):
            rows = batch.slice(x, y - x)
            coded = rows.column("docids").flatten().dictionary_encode("encode")
            codes = coded.indices.to_numpy()
            dls = np.zeros(len(coded.dictionary), np.int32)
            dls[codes] = rows.column("dls").flatten().to_numpy(zero_copy_only=False)
            data = _packed(shard=rows.column("shard")[:1], terms=rows.column("term"), sizes=pc.list_value_length(rows.column("docids")), codes=coded.indices, tfs=rows.column("tfs").flatten(), docids=coded.dictionary, dls=pa.array(dls))
            yield _packs([rows.column("part")[0].as_py()], [_POSTINGS], [data])


def _pack_dead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents (part, shard, docid) that count no more, packed by part."""
    import pyarrow.compute as pc

    for batch in batches:
        for part in pc.unique(batch.column("part")).to_pylist():
            own = batch.filter(pc.equal(batch.column("part"), part))
            yield _packs([part], [_DEAD], [_packed(shards=own.column("shard"), docids=own.column("docid"))])


def _pack_questions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Questions (id, terms, weights, home, least) in lists of one ``home``, which is given as part."""
    import pyarrow.compute as pc

    for batch in batches:
        for home in pc.unique(batch.column("home")).to_pylist():
            rows = batch.filter(pc.equal(batch.column("home"), home))
            for x in range(0, rows.num_rows, ASKED):
                own = rows.slice(x, ASKED)
                lists = {name: own.column(name) for name in ("id", "least")} | {name: own.column(name).flatten() for name in ("terms", "weights")}
                yield _packs([home], [_QUESTION], [_packed(sizes=pc.list_value_length(own.column("terms")), **lists)])


class _Shards:
    """The postings of a few shards, ready for search as one."""

    def __init__(self, packed: list[bytes], dead: list[bytes], avgdl: float, k1: float, b: float):
        import numpy as np
        import pyarrow.compute as pc

        # the postings stay packed until they are dealt
        packs = [{name: x for name, x in _unpacked(p).items() if name not in ("codes", "tfs")} | {"packed": p} for p in packed]
        packs.sort(key=lambda p: p["shard"][0].as_py())
        dead = [_unpacked(d) for d in dead]
        shards = [p["shard"][0].as_py() for p in packs]
        # documents by shard, then docid, so that a term's lists follow one another
        docids, lengths, place = [], [], []
        for shard in sorted(set(shards)):
            own = [p for p, s in zip(packs, shards) if s == shard]
            ids = pc.unique(pa.concat_arrays([p["docids"] for p in own]))
            ids = ids.take(pc.sort_indices(ids, null_placement="at_start"))
            dl, at = np.zeros(len(ids)), sum(map(len, docids))
            for p in own:
                here = pc.index_in(p["docids"], value_set=ids).to_numpy()
                dl[here] = p["dls"].to_numpy()
                place.append(here + at)
            gone = [d["docids"].filter(pc.equal(d["shards"], shard)) for d in dead]
            if sum(map(len, gone)):  # no posting of theirs gives anything
                dl[pc.is_in(ids, value_set=pa.concat_arrays(gone)).to_numpy(zero_copy_only=False)] = np.inf
            docids.append(ids)
            lengths.append(dl)
        self.docids, n = pa.concat_arrays(docids), sum(map(len, docids))
        over = k1 * (1 - b + b * np.concatenate(lengths) / avgdl)
        self.rank = np.empty(n, np.int64)
        self.rank[pc.sort_indices(self.docids, null_placement="at_start").to_numpy()] = np.arange(n)
        # rows of terms, dealt to their places by term
        coded = pa.chunked_array([p["terms"] for p in packs]).combine_chunks().dictionary_encode()
        self.terms, codes = coded.dictionary, coded.indices.to_numpy()
        sizes = np.concatenate([p["sizes"].to_numpy() for p in packs]).astype(np.int64)
        order = np.argsort(codes, kind="stable")
        starts = np.empty(len(sizes), np.int64)
        starts[order] = np.cumsum(sizes[order]) - sizes[order]
        self.sizes = np.bincount(codes, sizes, minlength=len(self.terms)).astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        total, row = int(self.sizes.sum()), 0
        self.docs, self.norms = np.empty(total, np.int32), np.empty(total)
        for p, own in zip(packs, place):
            size = sizes[row : row + len(p["sizes"])]
            to = np.repeat(starts[row : row + len(size)] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            row += len(size)
            postings = _unpacked(p["packed"])
            doc, tf = own[postings["codes"].to_numpy()], postings["tfs"].to_numpy()
            self.docs[to] = doc
            self.norms[to] = tf / (tf + over[doc])
        self.tops = np.maximum.reduceat(self.norms, self.starts)
        # where the blocks of BLOCK postings of each term begin
        per = -(-self.sizes // BLOCK)
        self.first = np.concatenate([[0], np.cumsum(per)])
        at = np.repeat(self.starts - self.first[:-1] * BLOCK, per) + np.arange(self.first[-1]) * BLOCK
        self.block_tops = np.maximum.reduceat(self.norms, at)
        width = -(-n // 8) * 8
        # terms of many documents also as a row over all documents
        common = np.flatnonzero(self.sizes > n // 8)
        common = common[np.argsort(-self.sizes[common], kind="stable")][: ROWS_BYTES // (8 * width)]
        self.matrix, self.row = np.zeros((len(common), width)), dict(zip(common.tolist(), range(len(common))))
        for t, row in self.row.items():
            own = slice(self.starts[t], self.starts[t] + self.sizes[t])
            self.matrix[row, self.docs[own]] = self.norms[own]
        self.scores, self.spare = np.zeros(width), np.zeros(width)

    def answer(self, asked: dict, k: int) -> tuple:
        """The best documents of the questions ``asked`` (id, terms, weights, least): the questions' numbers,
        docids, scores."""
        import numpy as np
        import pyarrow.compute as pc

        ends = np.concatenate([[0], np.cumsum(asked["sizes"].to_numpy())]).tolist()
        at = pc.fill_null(pc.index_in(asked["terms"], value_set=self.terms), -1).to_numpy()
        known = at >= 0
        x, top = self.starts[at], self.tops[at].tolist()
        y, x = (x + self.sizes[at]).tolist(), x.tolist()
        first, last = self.first[at].tolist(), self.first[at + 1].tolist()
        row = [self.row.get(t, -1) for t in at.tolist()]
        known, weights, least = known.tolist(), asked["weights"].to_pylist(), asked["least"].to_pylist()
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for q in range(len(least)):
            here = [t for t in range(ends[q], ends[q + 1]) if known[t]]
            if sum([weights[t] * top[t] for t in here]) <= max(least[q] - SLACK, 0):
                continue
            best, score, _ = best_of_shard(
                [self.docs[x[t] : y[t]] for t in here], [self.norms[x[t] : y[t]] for t in here], [top[t] for t in here],
                [self.block_tops[first[t] : last[t]] for t in here], [weights[t] for t in here], k, self.scores,
                (self.matrix, [row[t] for t in here]), self.spare, self.rank, least[q])
            found.append((np.full(len(best), q), best, score))
        q, best, score = (np.concatenate(c) for c in zip(*found))
        return q, self.docids.take(pa.array(best)), pa.array(score)


# What a part reads, in this order.
_DEAD, _POSTINGS, _QUESTION = 0, 1, 2


def _part_search(k: int, k1: float, b: float, names: list[str]):
    """Of the rows of one part, by ``kind``: the documents that count no more, the postings,
    the questions, each question's best documents. Questions are answered as they are read, so what
    a part holds is its postings and a few lists of questions. ``names``: the columns of a row for each hit, or, with
    the terms among them, of a row for each question."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        held, shards, avgdl = {_DEAD: [], _POSTINGS: []}, None, None
        for batch in batches:
            for part, kind, data, mean in zip(*(batch.column(name) for name in ("part", "kind", "data", "avgdl"))):
                kind = kind.as_py()
                if kind != _QUESTION:
                    held[kind].append(data.as_py())
                    avgdl = mean.as_py()
                    continue
                own = _unpacked(data.as_buffer())
                if shards is None and held[_POSTINGS]:
                    shards = _Shards(held[_POSTINGS], held[_DEAD], avgdl, k1, b)
                    held = {_DEAD: [], _POSTINGS: []}
                    pa.default_memory_pool().release_unused()
                if shards is None and "terms" not in names:
                    continue
                n = len(own["id"])
                q, docids, scores = shards.answer(own, k) if shards else (np.zeros(0, np.int64), None, pa.array([], pa.float64()))
                if "terms" not in names:
                    yield pa.RecordBatch.from_arrays([own["id"].take(pa.array(q)), docids, scores], names=names)
                    continue
                lists = lambda ends, x: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(ends)]), pa.int32()), x)
                hits = np.bincount(q, minlength=n)
                docids = lists(hits, docids) if shards else pa.nulls(n, pa.list_(pa.null()))
                columns = [own["id"], lists(own["sizes"].to_numpy(), own["terms"]), lists(own["sizes"].to_numpy(), own["weights"]), pa.array([part.as_py()] * n, pa.int32()), docids, lists(hits, scores)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _place(shard: str, shards: list[int]) -> Column:
    """The place of a shard's number in ``shards``, rising numbers in a few runs."""
    out = F.lit(None).cast("int")
    for place, number in reversed(list(enumerate(shards))):
        if place == 0 or shards[place - 1] != number - 1:  # a run begins
            end = next((i for i in range(place + 1, len(shards)) if shards[i] != shards[i - 1] + 1), len(shards))
            out = F.when(F.col(shard).between(number, shards[end - 1]), (F.col(shard) - number + place).cast("int")).otherwise(out)
    return out


def bm25_topk(index: Index, questions: DataFrame, k: int = DEFAULT_K, id_col: str = "id",
              text_col: str = "question", analyzer=None, k1: float = K1, b: float = B) -> DataFrame:
    """R1 + J2: top-k documents per question: (id, docid, rank, score).

    Ties: ``round(score, 6) desc, docid asc``. Questions with no matching term
    yield no rows (Q8). Each question term is weighted by its stored document
    frequency; ``N`` and ``avgdl`` are scalar subqueries over the (one-row) corpus
    statistics. Neighbouring shards are searched as one part, of about ``PART_TERMS`` terms
    at most. A block goes to its part once, however many questions
    ask for it; questions go to every part, in lists. From ``MANY`` questions on, these are analysed
    and weighted once, blocks go without a join with the asked terms, and each question is
    asked in one part first: its kth score there is what a document of another part must reach.
    """
    spark = index.blocks.sparkSession
    shards = index.shards
    if shards is None:
        shards = sorted(r.shard for r in index.blocks.select("shard").distinct().collect())
    n_terms = index.corpus_stats.select((F.col("n_docs") * F.col("avgdl")).alias("n")).first()["n"] or 0
    at_once = spark.sparkContext.defaultParallelism
    parts = max(min(len(shards), max(-(-int(n_terms) // (PART_TERMS * at_once)), 1) * at_once), 1)
    many = questions.count() >= MANY
    qt = query_terms(questions, id_col, text_col, analyzer)
    n_docs, avgdl = (index.corpus_stats.select(c).scalar() for c in ("n_docs", "avgdl"))
    idf = F.log(F.lit(1.0) + (n_docs - F.col("df") + F.lit(0.5)) / (F.col("df") + F.lit(0.5)))
    asked = qt.select("term").distinct()
    stats = index.term_stats if many else index.term_stats.join(asked, "term", "left_semi")
    blocks = index.blocks if many else index.blocks.join(asked, "term", "left_semi")
    weighted = qt.join(stats, "term").select("id", "term", (F.col("qtf") * idf).alias("weight"))
    asked = weighted.groupBy("id").agg(F.collect_list(F.struct("term", "weight")).alias("q"))
    asked = asked.select("id", F.col("q")["term"].alias("terms"), F.col("q")["weight"].alias("weights"))
    part = F.floor(_place("shard", shards) * F.lit(parts) / F.lit(max(len(shards), 1))).cast("int").alias("part")
    told = blocks.select(part, "shard", "term", *LISTS).mapInArrow(_pack_postings, _PACKS)
    if index.dead is not None:  # a part hears of its dead documents, at most all of its own
        told = told.unionByName(index.dead.select(part, "shard", "docid").mapInArrow(_pack_dead, _PACKS))
    told = told.withColumn("avgdl", avgdl)
    id_type, docid_type = qt.schema["id"].dataType, index.postings.schema["docid"].dataType
    hit = T.StructType([T.StructField("id", id_type), T.StructField("docid", docid_type), T.StructField("score", T.DoubleType())])

    def search(asked: DataFrame, of_part, schema: T.StructType) -> DataFrame:
        """The answers to ``asked`` in the parts that ``of_part`` makes of a list's."""
        rows = asked.mapInArrow(_pack_questions, _PACKS).withColumn("part", of_part(F.col("part"))).withColumn("avgdl", F.lit(None).cast("double"))
        rows = rows.unionByName(told)
        rows = rows.repartitionById(max(parts, 2), "part").sortWithinPartitions("part", "kind")  # a task a part
        return rows.groupBy("part").applyInArrow(_part_search(k, k1, b, schema.names), schema)

    every = F.sequence(F.lit(0), F.lit(parts - 1))
    no_bound = F.lit(float("-inf")).alias("least")
    if many and parts > 1:
        asked = materialize(asked, "asked")
        home = F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("home")
        in_lists = [T.StructField(name, T.ArrayType(t)) for name, t in (("docids", docid_type), ("scores", T.DoubleType()))]
        schema = T.StructType([T.StructField("id", id_type), *asked.schema.fields[1:], T.StructField("home", T.IntegerType()), *in_lists])
        found = materialize(search(asked.select("*", home, no_bound), lambda p: p, schema), "first-hits")
        release(asked)
        least = F.when(F.size("scores") == k, F.array_min("scores")).otherwise(F.lit(float("-inf"))).alias("least")
        scored = search(found.select("id", "terms", "weights", "home", least), lambda p: F.explode(F.array_remove(every, p)), hit)
        scored = scored.unionByName(found.select("id", F.inline(F.arrays_zip("docids", "scores")).alias("docid", "score")))
    else:
        scored = search(asked.select("*", F.lit(0).alias("home"), no_bound), lambda p: F.explode(every), hit)
    scored = scored.withColumn("score", F.round("score", 6))
    w = Window.partitionBy("id").orderBy(F.col("score").desc(), F.col("docid").asc())
    return (
        scored.withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
        .select("id", "docid", F.col("rank").cast("long").alias("rank"), "score")
    )


def retrieve_pairs(hits: DataFrame, questions: DataFrame, passages: DataFrame,
                   id_col: str = "id") -> DataFrame:
    """Expand each question to its retrieved (question, passage) pairs.

    Passages are joined back on docid only for the k hits (late
    materialisation); hits are small relative to the corpus, the passage side
    is shuffled on docid unless AQE finds it small.
    """
    q = questions.withColumnRenamed(id_col, "id")
    return hits.join(q, "id").join(passages.select("docid", "passage"), "docid")


def write_passages(passages: DataFrame, path: str, partitions: int | None = None, mode: str = "overwrite") -> None:
    """Store passages range-partitioned and sorted by docid, so parquet
    min/max statistics let docid lookups skip row groups."""
    n = partitions or target_partitions(passages.sparkSession)
    (
        passages.repartitionByRange(n, "docid").sortWithinPartitions("docid")
        .write.mode(mode).option("maxRecordsPerFile", MAX_ROWS_PER_FILE).parquet(path)
    )


def recall_at_k(hits: DataFrame, gold: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    """Share of questions whose gold docid is among the top-k hits.

    ``gold(id, docid)``; questions without any hit count as misses.
    """
    h = hits.filter(F.col("rank") <= k).select("id", "docid", F.lit(1).alias("hit"))
    j = gold.select("id", "docid").join(h, ["id", "docid"], "left")
    per_q = j.groupBy("id").agg(F.max(F.coalesce("hit", F.lit(0))).alias("hit"))
    return per_q.agg(
        F.lit(k).cast("long").alias("k"),
        F.count(F.lit(1)).cast("long").alias("n_questions"),
        F.sum("hit").cast("long").alias("n_hits"),
        F.round(F.avg("hit"), 6).alias("recall"),
    )
