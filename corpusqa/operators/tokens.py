"""Tokens, vocabulary and ids.

Character mode (the default, used by all driver queries) is built-in Spark:
every non-blank, non-control character is one lower-cased token. Ids come
from a vocabulary *table*, which the distinct tokens of each row are joined to; the
lookup of a row's tokens among its own entries is an Arrow function (``pyarrow.compute.index_in``).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import accumulate
from operator import and_

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusqa.functions.text import ZERO_TOKEN_CLASS, char_tokens

# Special tokens and their ids (BERT vocabulary layout).
PAD, UNK, CLS, SEP, MASK = "[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]"
SPECIAL_TOKENS = [PAD, UNK, CLS, SEP, MASK]
PAD_ID, UNK_ID, CLS_ID, SEP_ID = 0, 1, 2, 3
FIRST_REGULAR_ID = 5


def build_char_vocab(passages: DataFrame, text_col: str = "passage") -> DataFrame:
    """Vocabulary table (token, token_id): the distinct lower-case characters
    of the passages in code-point order, ids from 5; ids 0-4 are the special
    tokens. Each row is first reduced to its distinct raw characters; the
    zero-token filter and the per-character lower-casing of ``char_tokens``
    then run on that small set, and only distinct values are shuffled."""
    spark = passages.sparkSession
    raw = F.array_distinct(F.split(F.col(text_col), ""))
    kept = F.filter(raw, lambda ch: (ch != "") & ~ch.rlike("^" + ZERO_TOKEN_CLASS + "$"))
    chars = (
        passages.select(F.explode_outer(F.array_distinct(F.transform(kept, lambda t: F.lower(t)))).alias("token"))
        .filter(F.col("token").isNotNull())
        .distinct()
    )
    regular = chars.select(
        "token",
        # one ordered partition is fine here: the set is bounded by the
        # number of distinct characters
        (F.rank().over(Window.orderBy("token")) + FIRST_REGULAR_ID - 1).cast("int").alias("token_id"),
    )
    special = spark.createDataFrame([(t, i) for i, t in enumerate(SPECIAL_TOKENS)], "token string, token_id int")
    return special.unionByName(regular)


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _looked_up(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Ids of each row's tokens by its own entries (token, id); null where there is none."""
    for lists, entries in batches:
        out = []
        for tokens, own in zip(lists, entries):
            if not tokens.is_valid:
                out.append(None)
            elif not own.is_valid:
                out.append(pa.nulls(len(tokens.values), pa.int32()))
            else:
                found = pc.index_in(tokens.values, value_set=own.values.field("token"))
                out.append(pc.take(own.values.field("id"), found))
        sizes = [0 if x is None else len(x) for x in out]
        offsets = pa.array([0, *accumulate(sizes)], pa.int32())
        values = pa.concat_arrays([pa.array([], pa.int32()), *(x for x in out if x is not None)])
        yield pa.ListArray.from_arrays(offsets, values, mask=lists.is_null())


def token_ids(df: DataFrame, vocab: DataFrame, keys: list[str], tokens_col: str = "tokens", out_col: str = "token_ids",
              unk_id: int = UNK_ID) -> DataFrame:
    """T5: array of ids for an array of tokens; unknown tokens map to [UNK].

    ``keys`` tell the rows' token arrays apart. The distinct tokens of a row meet the
    vocabulary table (token, token_id), whatever its size, and come back as one list of entries, at most one
    for each distinct token of the row; the arrays themselves stay where they are if the rows
    are partitioned by ``keys`` already.
    """
    wanted = df.select(*keys, F.explode_outer(F.array_distinct(tokens_col)).alias("_token")).filter(F.col("_token").isNotNull())
    known = wanted.join(vocab.select(F.col("token").alias("_token"), F.col("token_id").cast("int").alias("_id")), "_token")
    entry = F.struct(F.col("_token").alias("token"), F.col("_id").alias("id"))
    entries = known.groupBy(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]).agg(F.collect_set(entry).alias("_entries"))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)])
    found = df.join(entries, same, "left")
    ids = F.transform(_looked_up(F.col(tokens_col), F.col("_entries")), lambda i: F.coalesce(i, F.lit(unk_id)))
    return found.withColumn(out_col, ids).drop("_entries", *[f"_key{i}" for i in range(len(keys))])


def question_tokens(questions: DataFrame, max_question_length: int = 96, text_col: str = "question",
                    tokenizer=char_tokens) -> DataFrame:
    """T3 + P6: question tokens truncated to the maximum; characters, or what
    ``tokenizer(column) -> array<string>`` gives."""
    toks = tokenizer(text_col)
    return questions.withColumn("question_tokens", F.slice(toks, 1, max_question_length)).withColumn(
        "question_len", F.size("question_tokens")
    )
