"""An index that grows (S4, S5, Q6): segments, taken back documents, merges.

``path/segment=<n>/`` holds one load: ``blocks`` (see ``retrieval``, as written) of its documents alone,
``docs(docid, dl, digest, shard)``, ``gone(docid, in_segment, in_shard)``: the copies in
earlier segments that it replaces or deletes, ``terms(term, df)``: what it adds to each
term's document frequency, less what the gone copies had, and ``corpus``: one row, the
same for the corpus statistics, written last. A segment counts once ``corpus`` is whole,
so a load that failed is not seen, and the next one writes over it.

Statistics are sums over segments, so opening an index counts no postings. Search finds
replaced copies in their shard and gives them no score. ``merge_segments`` writes all live documents
as one segment from which on readers read. There is one writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusqa.operators import retrieval
from corpusqa.operators.clean import first_passage_per_docid, passages_of
from corpusqa.session import materialize, release

SHARD_BITS = 32  # a shard of an opened index: segment * 2^32 + shard of the segment


def segment_numbers(spark: SparkSession, path: str) -> list[int]:
    """The segments that readers read, rising: the whole ones from the last merge on."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    whole = sorted(
        int(name.removeprefix("segment=")) for name in names
        if name.startswith("segment=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}/corpus/_SUCCESS"))
    )
    if not whole:
        return []
    first = spark.read.parquet(f"{path}/segment={whole[-1]}/corpus").first()["first_segment"]
    return [n for n in whole if n >= first]


def _read(spark: SparkSession, path: str, numbers: list[int], name: str) -> DataFrame:
    """Table ``name`` of the segments, with the column ``segment``."""
    found = spark.read.option("basePath", path).parquet(*[f"{path}/segment={n}/{name}" for n in numbers])
    return found.withColumn("segment", F.col("segment").cast("int"))


def _live(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows (docid, segment, ...) but for the copies that a later segment took back."""
    dead = gone.select(F.col("docid").alias("_docid"), F.col("in_segment").alias("_segment"))
    return rows.join(dead, F.col("docid").eqNullSafe(F.col("_docid")) & (F.col("segment") == F.col("_segment")), "left_anti")


def _of_opened(segment: str, shard: str):
    return F.shiftleft(F.col(segment).cast("long"), SHARD_BITS) + F.col(shard)


def _blocks(spark: SparkSession, path: str, numbers: list[int]) -> DataFrame:
    """The blocks of the segments, by the shards of the opened index."""
    return retrieval.term_blocks(_read(spark, path, numbers, "blocks").withColumn("shard", _of_opened("segment", "shard")))


def _dead(gone: DataFrame) -> DataFrame:
    return gone.select("docid", _of_opened("in_segment", "in_shard").alias("shard"))


def open_index(spark: SparkSession, path: str) -> retrieval.Index:
    """The live documents of all segments as one index."""
    numbers = segment_numbers(spark, path)
    if not numbers:
        raise ValueError(f"no whole segment in {path}")
    gone = _read(spark, path, numbers, "gone").filter(F.col("in_segment") >= numbers[0])
    if gone.isEmpty():
        gone = None
    blocks = _blocks(spark, path, numbers)
    dead = None if gone is None else _dead(gone)
    terms = _read(spark, path, numbers, "terms").groupBy("term").agg(F.sum("df").alias("df")).filter("df > 0")
    sums = _read(spark, path, numbers, "corpus").agg(*[F.sum(c).alias(c) for c in ("n_docs", "n_texts", "sum_dl")])
    docs = _read(spark, path, numbers, "docs")
    docs = (docs if gone is None else _live(docs, gone)).select("docid", "dl", _of_opened("segment", "shard").alias("shard"))
    return retrieval.Index(
        retrieval.unroll(blocks if dead is None else retrieval.blocks_of(blocks, dead, without=True)),
        blocks,
        terms,
        docs.select("docid", "dl"),
        sums.select("n_docs", F.try_divide("sum_dl", "n_texts").alias("avgdl")),
        docs,
        dead,
    )


def append_documents(passages: DataFrame, path: str, text_col: str = "passage", analyzer=None) -> int:
    """Add (docid, passage) to the index and replace the documents whose text differs
    from the one stored; the first row of a docid counts. Documents that are stored
    already with the same text are passed over, so a repeated load adds nothing. Returns the number of
    documents written. The same ``analyzer`` for all loads.

    What is new is found on (docid, digest) alone; texts are read again for these, and go
    straight to their shards.
    """
    spark = passages.sparkSession
    numbers = segment_numbers(spark, path)
    rows = passages.withColumnRenamed(text_col, "passage")
    if "ordinal" not in rows.columns:
        rows = rows.withColumn("ordinal", F.monotonically_increasing_id())
    rows = first_passage_per_docid(rows)
    keys = rows.select("docid", F.sha2("passage", 256).alias("digest"))
    if numbers:
        stored = _live(_read(spark, path, numbers, "docs"), _read(spark, path, numbers, "gone"))
        stored = stored.select(F.col("docid").alias("_docid"), F.col("digest").alias("_digest"), F.col("segment").alias("in_segment"), F.col("shard").alias("in_shard"))
        keys = keys.join(stored, F.col("docid").eqNullSafe(F.col("_docid")), "left")
        keys = keys.filter(F.col("in_segment").isNull() | ~F.col("digest").eqNullSafe(F.col("_digest")))
    else:
        keys = keys.withColumns({"in_segment": F.lit(None).cast("int"), "in_shard": F.lit(None).cast("long")})
    fresh = materialize(keys.select("docid", "digest", "in_segment", "in_shard"), "fresh-docids")
    n_docs = fresh.count()
    if n_docs:
        own = passages_of(rows, fresh.select("docid"), n_docs) if numbers else rows
        counted = retrieval.build_index(own, analyzer=analyzer, shards=retrieval.shard_count(spark, n_docs), digest=True).counted
        gone = fresh.filter("in_segment IS NOT NULL").select("docid", "in_segment", "in_shard")
        _write(spark, path, numbers, None, counted, gone, n_docs)
    release(fresh)
    return n_docs


def delete_documents(docids: DataFrame, path: str) -> int:
    """Take the documents of ``docids(docid)`` out of the index; unknown ones are passed
    over. Returns the number of documents taken out."""
    spark = docids.sparkSession
    numbers = segment_numbers(spark, path)
    if not numbers:
        return 0
    wanted = docids.select(F.col("docid").alias("_docid"))
    stored = _live(_read(spark, path, numbers, "docs"), _read(spark, path, numbers, "gone"))
    found = stored.join(wanted, F.col("docid").eqNullSafe(F.col("_docid")), "left_semi")
    gone = materialize(found.select("docid", F.col("segment").alias("in_segment"), F.col("shard").alias("in_shard")), "gone-docids")
    n = gone.count()
    if n:
        none = lambda name: _read(spark, path, numbers[:1], name).drop("segment").filter(F.lit(False))
        _write(spark, path, numbers, none("docs").drop("shard"), none("blocks"), gone, 0)
    release(gone)
    return n


def merge_segments(spark: SparkSession, path: str) -> int:
    """Write the live documents as one segment, from which on the index is read. Returns
    its number. The older ones stay until ``drop_merged``, for readers that have them open."""
    numbers = segment_numbers(spark, path)
    index = open_index(spark, path)
    docs = _live(_read(spark, path, numbers, "docs"), _read(spark, path, numbers, "gone")).select("docid", "dl", "digest")
    none = _read(spark, path, numbers[:1], "gone").drop("segment").filter(F.lit(False))
    n_docs = index.corpus_stats.first()["n_docs"]
    shards = retrieval.shard_count(spark, n_docs)
    dealt = index.postings.select(retrieval.shard_of("docid", shards).alias("shard"), "docid", "term", F.col("tf").cast("int").alias("tf"), F.col("dl").cast("int").alias("dl"))
    blocks = retrieval.gather_blocks(dealt.repartitionById(shards, "shard"))
    return _write(spark, path, numbers, docs, blocks, none, n_docs, merged=True)


def drop_merged(spark: SparkSession, path: str) -> None:
    """Delete the segments that no reader needs since the last merge."""
    first = segment_numbers(spark, path)[0]
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("segment=") and int(name.removeprefix("segment=")) < first:
            fs.delete(status.getPath(), True)


def _write(spark: SparkSession, path: str, numbers: list[int], docs: DataFrame | None, blocks: DataFrame, gone: DataFrame,
           n_docs: int, merged: bool = False) -> int:
    """``blocks`` by ``shard_count`` shards of ``n_docs`` documents; without ``docs`` these are in ``blocks``."""
    number = numbers[-1] + 1 if numbers else 1
    out = f"{path}/segment={number}"
    put = lambda df, name: df.write.mode("overwrite").parquet(f"{out}/{name}")
    own = lambda name: spark.read.parquet(f"{out}/{name}")
    shard = retrieval.shard_of("docid", retrieval.shard_count(spark, n_docs)).cast("long")
    put(blocks.sortWithinPartitions("shard", "term"), "blocks")
    put(retrieval.counted_docs(own("blocks"), digest=True) if docs is None else docs.withColumn("shard", shard), "docs")
    put(gone, "gone")
    df, counts = retrieval.document_frequencies(retrieval.term_blocks(own("blocks"))), _counts(own("docs"), 1)
    if numbers and not merged and not own("gone").isEmpty():
        taken = own("gone").select(F.col("docid").alias("_docid"), "in_segment")
        lost = retrieval.frequencies_of(_blocks(spark, path, numbers), _dead(own("gone")))
        df = df.unionByName(lost.select("term", (-F.col("df")).alias("df")))
        of_gone = _read(spark, path, numbers, "docs").join(
            taken, F.col("docid").eqNullSafe(F.col("_docid")) & (F.col("segment") == F.col("in_segment")), "left_semi")
        counts = counts.unionByName(_counts(of_gone, -1))
    put(df.groupBy("term").agg(F.sum("df").alias("df")), "terms")
    first = number if merged or not numbers else numbers[0]
    put(counts.agg(*[F.sum(c).alias(c) for c in counts.columns]).withColumn("first_segment", F.lit(first)), "corpus")
    return number


def _counts(docs: DataFrame, sign: int) -> DataFrame:
    parts = {"n_docs": F.count(F.lit(1)), "n_texts": F.count("dl"), "sum_dl": F.coalesce(F.sum("dl"), F.lit(0))}
    return docs.agg(*[(n * sign).cast("long").alias(name) for name, n in parts.items()])
