"""Sharded export of ordered rows (N5, N7): training batches as files.

``path/data/shard=<n>/`` holds one Parquet file: the rows of ranks ``n * rows`` to
``(n + 1) * rows - 1``, in order. ``path/manifest`` has one row a shard (shard, n_rows, first_rank,
last_rank, digest), taken from the rows as they were written. Shards that no longer agree with
it (lost or damaged files) are found by ``damaged_shards`` and written again alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusqa.session import materialize, release, target_partitions

ORDER = "order_rank"
ROWS = 65_536  # rows of a shard; a multiple of the batch size keeps batches whole


def write_shards(rows: DataFrame, path: str, rows_per_shard: int = ROWS, order_col: str = ORDER) -> None:
    """Write ``rows`` with their global rank (0 to n - 1, each once) as shards and a
    manifest. Rows are shuffled once by shard; a shard is sorted within its task. Raises if ranks are
    missing or repeated."""
    numbered = rows.withColumn("shard", F.floor(F.col(order_col) / rows_per_shard).cast("long"))
    _write(numbered, path, order_col)
    spark = rows.sparkSession
    rows.limit(0).write.mode("overwrite").parquet(f"{path}/schema")
    found = _summary(_stored(spark, path), rows.columns, order_col)
    found = found.withColumn("rows_per_shard", F.lit(rows_per_shard).cast("long")).withColumn("order_col", F.lit(order_col))
    found.write.mode("overwrite").parquet(f"{path}/manifest")
    listed = spark.read.parquet(f"{path}/manifest")
    last = listed.agg(F.max("shard")).first()[0]
    first_wrong = F.col("first_rank") != F.col("shard") * rows_per_shard
    uneven = F.col("n_rows") != F.col("last_rank") - F.col("first_rank") + 1
    short = (F.col("shard") != F.lit(last)) & (F.col("n_rows") != rows_per_shard)
    if last is not None and (listed.count() != last + 1 or not listed.filter(first_wrong | uneven | short).isEmpty()):
        raise ValueError(f"{order_col} is not a rank: ranks are missing or repeated")


def _write(numbered: DataFrame, path: str, order_col: str, mode: str = "static") -> None:
    by_shard = numbered.repartition(target_partitions(numbered.sparkSession), "shard").sortWithinPartitions("shard", order_col)
    by_shard.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("shard").parquet(f"{path}/data")


def _stored(spark: SparkSession, path: str, **options) -> DataFrame:
    """The rows of the shard files, and ``shard``; none if there are no files."""
    fields = spark.read.parquet(f"{path}/schema").schema.fields
    schema = T.StructType([*fields, T.StructField("shard", T.LongType())])
    return spark.read.schema(schema).options(**options).parquet(f"{path}/data")


def _summary(stored: DataFrame, columns: list[str], order_col: str) -> DataFrame:
    count = F.count(F.lit(1)).cast("long").alias("n_rows")
    rank = F.col(order_col).cast("long")
    digest = F.bit_xor(F.xxhash64(*[F.col(f"`{c}`") for c in columns])).alias("digest")
    return stored.groupBy(F.col("shard").cast("long").alias("shard")).agg(count, F.min(rank).alias("first_rank"), F.max(rank).alias("last_rank"), digest)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(shard, n_rows, first_rank, last_rank, digest, rows_per_shard, order_col)."""
    return spark.read.parquet(f"{path}/manifest")


def read_shards(spark: SparkSession, path: str, shards: list[int] | None = None) -> DataFrame:
    """The rows of all shards, or of those listed (other files are not read). Rows of a
    file are in order; ``shard`` says which it is."""
    rows = _stored(spark, path)
    return rows if shards is None else rows.filter(F.col("shard").isin(shards))


def damaged_shards(spark: SparkSession, path: str) -> DataFrame:
    """(shard): those whose files are gone, cannot be read or hold other rows than the
    manifest says."""
    stored = _stored(spark, path, ignoreCorruptFiles=True, ignoreMissingFiles=True)
    listed = manifest(spark, path)
    order_col = listed.select("order_col").first()
    found = _summary(stored, stored.columns[:-1], order_col[0] if order_col else stored.columns[0])
    return listed.join(found, ["shard", "n_rows", "first_rank", "last_rank", "digest"], "left_anti").select("shard")


def repair_shards(rows: DataFrame, path: str) -> int:
    """Write the damaged shards again, from the ``rows`` that were exported; the others
    stay as they are. Returns how many were written."""
    spark = rows.sparkSession
    damaged = materialize(damaged_shards(spark, path), "damaged-shards")  # found before files change
    n = damaged.count()
    if n:
        first = manifest(spark, path).select("rows_per_shard", "order_col").first()
        numbered = rows.withColumn("shard", F.floor(F.col(first["order_col"]) / first["rows_per_shard"]).cast("long"))
        _write(numbered.join(damaged, "shard", "left_semi").select(*rows.columns, "shard"), path, first["order_col"], "dynamic")
    release(damaged)
    return n
