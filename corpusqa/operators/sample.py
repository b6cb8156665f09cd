"""Sampling, splits, ordering and batches.

Randomness is a keyed hash (md5 of seed and row key), so every result is the
same for any partitioning (Q20). Nothing here uses a window over the whole
table: the one-negative choice is a grouped ``min``, and the global shuffle
rank is built from a bounded histogram of hash prefixes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusqa.operators.label import KNOWN, UNKNOWN

DEFAULT_SEED = 1
# Rank buckets: first 4 hex digits of the md5 key -> at most 65,536 buckets.
RANK_PREFIX_HEX = 4


def row_key(seed, *cols, salt: str = "") -> Column:
    parts = [F.lit(str(seed))] + ([F.lit(salt)] if salt else []) + [F.col(c).cast("string") for c in cols]
    return F.md5(F.concat_ws("_", *parts))


def sample_training(features: DataFrame, seed: int = DEFAULT_SEED) -> DataFrame:
    """Every known chunk plus one pseudo-random unknown chunk per example.

    Examples without any known chunk are left out (they are reported by
    ``no_known_examples``; the reference stops with an assertion there).
    The negative is the unknown row with the smallest md5 key: a grouped
    ``min`` with map-side partial aggregation, skew safe.
    """
    keyed = features.withColumn("_k", row_key(seed, "example_id", "docid", "chunk_idx"))
    has_known = keyed.filter(F.col("label") == KNOWN).select("example_id").distinct()
    known = keyed.filter(F.col("label") == KNOWN)
    pick = (
        keyed.filter(F.col("label") == UNKNOWN)
        .groupBy("example_id")
        .agg(F.min(F.struct("_k", "docid", "chunk_idx")).alias("_m"))
        .select("example_id", F.col("_m.docid").alias("docid"), F.col("_m.chunk_idx").alias("chunk_idx"))
        .join(has_known, "example_id", "left_semi")
    )
    unknown = keyed.join(pick, ["example_id", "docid", "chunk_idx"], "left_semi")
    return known.unionByName(unknown).drop("_k")


def sampling_stats(features: DataFrame) -> DataFrame:
    """Single-answer, multi-answer and has-unknown example counts, plus the
    examples without a known chunk and the number of selected rows."""
    per = features.groupBy("example_id").agg(
        F.count_if(F.col("label") == KNOWN).alias("n_known"),
        F.count_if(F.col("label") == UNKNOWN).alias("n_unknown"),
    )
    ok = F.col("n_known") >= 1
    return per.agg(
        F.count_if(F.col("n_known") == 1).cast("long").alias("single_answer"),
        F.count_if(F.col("n_known") > 1).cast("long").alias("multi_answer"),
        F.count_if(ok & (F.col("n_unknown") > 0)).cast("long").alias("has_unknown_sample"),
        F.count_if(~ok).cast("long").alias("no_known"),
        F.sum(F.when(ok, F.col("n_known") + F.least(F.col("n_unknown"), F.lit(1))).otherwise(0))
        .cast("long").alias("n_selected"),
    )


def no_known_examples(features: DataFrame) -> DataFrame:
    """Examples none of whose chunks is labelled known (Q10)."""
    return (
        features.groupBy("example_id")
        .agg(F.count_if(F.col("label") == KNOWN).alias("n_known"), F.count(F.lit(1)).alias("n_chunks"))
        .filter(F.col("n_known") == 0)
        .select("example_id", F.col("n_chunks").cast("long").alias("n_chunks"))
    )


def train_dev_split(examples: DataFrame, dev_fraction: float = 0.2, seed: int = DEFAULT_SEED,
                    id_col: str = "id") -> DataFrame:
    """Hash split on the id: dev when the first 4 hex digits of
    md5('<seed>_split_<id>') fall below ``dev_fraction`` (0 to 1) of 16^4."""
    if not 0 <= dev_fraction <= 1:
        raise ValueError(f"dev_fraction must lie between 0 and 1, not {dev_fraction}")
    key = F.conv(F.substring(row_key(seed, id_col, salt="split"), 1, 4), 16, 10).cast("int")
    return examples.withColumn("split", F.when(key < round(dev_fraction * 16 ** 4), F.lit("dev")).otherwise(F.lit("train")))


def union_splits(parts: dict) -> DataFrame:
    """UNION ALL of several feature tables, tagged with a ``split`` column."""
    out = None
    for name, df in parts.items():
        t = df.withColumn("split", F.lit(name))
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return out


def global_rank(df: DataFrame, key_col: str, tie_cols=(), prefix_hex: int = RANK_PREFIX_HEX) -> DataFrame:
    """0-based rank of every row by ``key_col`` (a hex hash) over the whole table.

    Rows are counted per hash prefix (at most 16^prefix_hex groups, a proven
    bound), prefix offsets come from a running sum over that small table, and
    the rank inside a prefix group is a window over that group only.
    """
    pref = F.substring(F.col(key_col), 1, prefix_hex)
    d = df.withColumn("_p", pref)
    counts = d.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_off",
        F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n"),
    ).select("_p", "_off")
    w = Window.partitionBy("_p").orderBy(F.col(key_col), *[F.col(c) for c in tie_cols])
    return (
        d.join(F.broadcast(offsets), "_p")
        .withColumn("order_rank", (F.col("_off") + F.row_number().over(w) - 1).cast("long"))
        .drop("_p", "_off")
    )


def shuffle_batches(selected: DataFrame, batch_size: int = 64, seed: int = DEFAULT_SEED) -> DataFrame:
    """N5 + N7: seeded random order and batch assignment (last batch partial)."""
    keyed = selected.withColumn("order_key", row_key(seed, "example_id", "docid", "chunk_idx", salt="order"))
    ranked = global_rank(keyed, "order_key", ("example_id", "docid", "chunk_idx"))
    return ranked.withColumn("batch_id", F.floor(F.col("order_rank") / batch_size).cast("long"))


def step_batches(batches: DataFrame, train_steps: int = 1000) -> DataFrame:
    """The rows of every training step. Step s takes batch ``s mod n_batches``
    (the cycled epochs replay the same batches), so each row is exploded to the
    steps that use its batch: its columns and ``step``."""
    n_batches = batches.select(F.max("batch_id") + 1).scalar()
    uses = F.when(F.col("batch_id") < train_steps, F.sequence(F.col("batch_id"), F.lit(train_steps - 1).cast("long"), n_batches))
    return batches.withColumn("step", F.explode_outer(uses)).filter(F.col("step").isNotNull())


def feature_order(features: DataFrame, order_cols=("rank", "chunk_idx")) -> DataFrame:
    """Sequential position of each feature inside its example.

    With a hit rank, position = (chunks of the example's earlier hits) +
    chunk_idx: the running sum runs over the per-(example, hit) chunk
    counts (at most k rows per example), so even an example whose hits
    hold a third of all chunks is never one window task. Without a rank the
    position is the chunk index itself.
    """
    if "rank" not in features.columns:
        return features.withColumn("feature_ord", F.col("chunk_idx").cast("long"))
    per_hit = features.groupBy("example_id", "rank").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("example_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    off = per_hit.select("example_id", "rank", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    return features.join(off, ["example_id", "rank"]).withColumn(
        "feature_ord", (F.col("_off") + F.col("chunk_idx")).cast("long")
    ).drop("_off")
