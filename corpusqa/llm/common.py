"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusqa.session import materialize, release  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read again: computed
    once for all its readers, and safe when an executor is lost."""
    return materialize(df, name)


BROADCAST_KEYS = 1_000_000  # rows of a table of keys that is broadcast, at most


def sized(keys: DataFrame, name: str) -> DataFrame:
    """A table of keys, written and counted: up to ``BROADCAST_KEYS`` go to the rows they
    are joined to, which stay where they are; more are joined by a shuffle."""
    out = stored(keys, name)
    return F.broadcast(out) if out.count() <= BROADCAST_KEYS else out


def crc32_mod(col: str, n: int):
    """crc32 of a column's text, modulo ``n`` (null stays null)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % F.lit(n)


def byte_values(column) -> list[bytes]:
    """An Arrow string column as UTF-8 bytes; null as empty."""
    import pyarrow as pa

    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if x is None else x for x in column.cast(kind).to_pylist()]


def pieces(batch, rows: int = 2000) -> Iterator:
    """An Arrow batch in slices of at most ``rows`` rows, to bound Python's copies."""
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores put before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def widen(schema: T.StructType, ddl: str) -> T.StructType:
    """``schema`` with the columns of a DDL string after its own."""
    return T.StructType([*schema.fields, *T.StructType.fromDDL(ddl).fields])
