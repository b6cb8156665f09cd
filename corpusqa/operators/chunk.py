"""Sentence split and greedy packing into token-bounded chunks.

Packing runs as one expression per document row: no Python, no shuffle. Chunks are closed token intervals
``[doc_start, doc_end]`` of the passage's token sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusqa.functions.text import DEFAULT_DELIMITER, n_sub_tokens, n_tokens, sentence_lengths, sub_sentence_lengths

# Fixed values of the reference: window overlap inside an over-long sentence,
# and the capacity rule max_doc_length = max_seq_length - question_len - 3.
DEFAULT_OVERLAP = 100
DEFAULT_MAX_SEQ_LENGTH = 512
DEFAULT_MAX_QUESTION_LENGTH = 96
SPECIAL_TOKENS_PER_SEQUENCE = 3

CHUNK_TYPE = "array<struct<doc_start:int,doc_end:int,is_window:boolean>>"

_FLUSH = "named_struct('doc_start', acc.st, 'doc_end', acc.st + acc.cur - 1, 'is_window', false)"
_WITH_FLUSH = f"IF(acc.cur > 0, concat(acc.out, array({_FLUSH})), acc.out)"

_EMPTY = f"cast(array() AS {CHUNK_TYPE})"

# The greedy rule is an ``aggregate`` over the sentence lengths. An aggregate
# copies its growing output with every element, so the lengths are cut into
# about sqrt(n) blocks of sqrt(n) sentences: an inner aggregate collects the
# chunks of a block, the outer one appends them to the output once a block.
_PACK_SQL = f"""
aggregate(
  IF(size({{lens}}) = 0, cast(array() AS array<array<int>>),
     transform(sequence(1, size({{lens}}), cast(ceil(sqrt(size({{lens}}))) AS int)),
               i -> slice({{lens}}, i, cast(ceil(sqrt(size({{lens}}))) AS int)))),
  named_struct('pos', 0, 'st', 0, 'cur', 0, 'out', {_EMPTY}),
  (done, block) -> aggregate(
    block,
    named_struct('pos', done.pos, 'st', done.st, 'cur', done.cur, 'out', {_EMPTY}),
    (acc, x) -> CASE
      WHEN x > {{cap}} THEN named_struct(
        'pos', acc.pos + x, 'st', acc.st, 'cur', 0,
        'out', concat({_WITH_FLUSH},
                      transform(sequence(0, x - 1, {{cap}} - {{overlap}}),
                                o -> named_struct('doc_start', acc.pos + o,
                                                  'doc_end', acc.pos + least(o + {{cap}} - 1, x - 1),
                                                  'is_window', true))))
      WHEN acc.cur > 0 AND acc.cur + x <= {{cap}} THEN named_struct(
        'pos', acc.pos + x, 'st', acc.st, 'cur', acc.cur + x, 'out', acc.out)
      ELSE named_struct('pos', acc.pos + x, 'st', acc.pos, 'cur', x, 'out', {_WITH_FLUSH})
    END,
    acc -> named_struct('pos', acc.pos, 'st', acc.st, 'cur', acc.cur, 'out', concat(done.out, acc.out))),
  acc -> {_WITH_FLUSH}
)
"""


def capacity(question_len_col: str = "question_len", max_seq_length: int = DEFAULT_MAX_SEQ_LENGTH):
    """C4: max_doc_length = max_seq_length - question_len - 3."""
    return F.lit(max_seq_length) - F.col(question_len_col) - F.lit(SPECIAL_TOKENS_PER_SEQUENCE)


def pack_expr(lens_col: str, cap_col: str, overlap: int = DEFAULT_OVERLAP):
    """C2 + C3 as one expression over an array of sentence lengths."""
    return F.expr(_PACK_SQL.format(lens=lens_col, cap=cap_col, overlap=int(overlap)))


def split_sentences(passages: DataFrame, delimiter: str = DEFAULT_DELIMITER,
                    text_col: str = "passage") -> DataFrame:
    """C1 as rows: (docid, sent_idx, sent_start, sent_end, sent_len).

    Token offsets are a running sum over the sentences of a document, which
    come from one row and are read once.
    """
    s = passages.select(
        "docid", F.posexplode_outer(sentence_lengths(text_col, delimiter)).alias("sent_idx", "sent_len")
    ).filter(F.col("sent_len").isNotNull())
    earlier = Window.partitionBy("docid").orderBy("sent_idx").rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("_before", F.coalesce(F.sum("sent_len").over(earlier), F.lit(0)))
    return s.select(
        "docid",
        F.col("sent_idx").cast("int").alias("sent_idx"),
        F.col("_before").cast("int").alias("sent_start"),
        (F.col("_before") + F.col("sent_len") - 1).cast("int").alias("sent_end"),
        F.col("sent_len").cast("int").alias("sent_len"),
    )


def pack_chunks(passages: DataFrame, cap_col: str = "capacity", overlap: int = DEFAULT_OVERLAP,
                delimiter: str = DEFAULT_DELIMITER, text_col: str = "passage",
                keep=("docid",), pieces=None) -> DataFrame:
    """One row per (document, capacity) with its ordered chunk array. Tokens are
    characters, or what ``pieces(character) -> array<string>`` gives (T2).

    ``cap_col`` holds max_doc_length per row; it must exceed ``overlap``
    (Q12: fail early instead of the reference's silent loss).
    """
    guarded = F.when(
        F.col(cap_col) > F.lit(overlap), F.col(cap_col)
    ).otherwise(F.raise_error(F.lit(f"max_doc_length must be greater than the overlap {overlap}")))
    df = passages.select(
        *keep, text_col,
        guarded.cast("int").alias("_cap"),
        (sub_sentence_lengths(text_col, pieces, delimiter) if pieces else sentence_lengths(text_col, delimiter)).alias("_lens"),
        (n_sub_tokens(text_col, pieces) if pieces else n_tokens(text_col)).alias("n_tokens"),
    )
    out = df.withColumn("chunks", pack_expr("_lens", "_cap", overlap))
    return out.drop("_lens").withColumnRenamed("_cap", cap_col)


def explode_chunks(packed: DataFrame, keep=None) -> DataFrame:
    """One row per chunk with its 0-based ``chunk_idx``."""
    keep = [c for c in packed.columns if c != "chunks"] if keep is None else list(keep)
    rows = packed.select(*keep, F.posexplode_outer("chunks").alias("chunk_idx", "c")).filter(F.col("c").isNotNull())
    return rows.select(
        *keep,
        F.col("chunk_idx").cast("int").alias("chunk_idx"),
        F.col("c.doc_start").alias("doc_start"),
        F.col("c.doc_end").alias("doc_end"),
        F.col("c.is_window").alias("is_window"),
    )
