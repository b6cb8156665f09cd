"""Sharded export: order, manifest, repair of single shards."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from corpusqa.session import scratch_path
from corpusqa.sources import shards


def _rows(spark, n):
    return spark.range(n).select(F.col("id").alias("order_rank"), F.concat(F.lit("text "), F.col("id")).alias("text"), F.array("id").alias("ids")).repartition(5)


def test_files_are_in_order(spark):
    path = scratch_path(spark, "shards")
    shards.write_shards(_rows(spark, 1_003), path, 100)
    files = glob.glob(f"{path}/data/shard=*/*.parquet")
    assert len(files) == 11
    back = shards.read_shards(spark, path).withColumn("place", F.col("_metadata.row_index"))
    assert back.filter((F.col("order_rank") % 100 != F.col("place")) | (F.floor(F.col("order_rank") / 100) != F.col("shard"))).isEmpty()
    assert back.count() == 1_003 and shards.read_shards(spark, path, [3, 10]).count() == 103
    listed = [tuple(r) for r in shards.manifest(spark, path).select("shard", "n_rows", "first_rank", "last_rank").orderBy("shard").collect()]
    assert listed == [(s, min(100, 1_003 - s * 100), s * 100, min(s * 100 + 99, 1_002)) for s in range(11)]


def test_damaged_shards_are_written_alone(spark):
    path = scratch_path(spark, "shards")
    rows = _rows(spark, 500)
    shards.write_shards(rows, path, 100)
    assert shards.repair_shards(rows, path) == 0
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/data/shard=*/*.parquet")}
    lost, broken = (f for s in (1, 3) for f in before if f"shard={s}/" in f)
    os.truncate(broken, 10)
    os.truncate(lost, 0)
    for crc in glob.glob(f"{path}/data/shard=[13]/.*.crc"):
        os.truncate(crc, 0)
    assert sorted(r[0] for r in shards.damaged_shards(spark, path).collect()) == [1, 3]
    assert shards.repair_shards(rows, path) == 2
    assert shards.damaged_shards(spark, path).isEmpty()
    kept = [f for f in before if "shard=1/" not in f and "shard=3/" not in f]
    assert all(os.stat(f).st_mtime_ns == before[f] for f in kept) and len(kept) == 3
    assert sorted(r[0] for r in shards.read_shards(spark, path).select("order_rank").collect()) == list(range(500))


def test_order_must_be_a_rank(spark):
    with pytest.raises(ValueError):
        shards.write_shards(_rows(spark, 300).filter("order_rank <> 150"), scratch_path(spark, "shards"), 100)
    with pytest.raises(ValueError):
        shards.write_shards(_rows(spark, 300).unionByName(_rows(spark, 1)), scratch_path(spark, "shards"), 100)
    empty = scratch_path(spark, "shards")
    shards.write_shards(_rows(spark, 0), empty, 100)
    assert shards.manifest(spark, empty).isEmpty() and shards.read_shards(spark, empty).isEmpty()
    assert shards.repair_shards(_rows(spark, 0), empty) == 0
