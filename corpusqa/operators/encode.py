"""Features: (question, chunk) rows and their model inputs.

Chunking is done once per distinct (docid, capacity) -- the reference redoes
it for every (question, document) pair and every evaluation -- and joined
back to the questions on that key. Token ids are computed once per document
and only the chunk's slice travels with each chunk row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusqa.functions.text import DEFAULT_DELIMITER, all_sub_tokens, char_to_sub_token, char_to_token, char_tokens
from corpusqa.operators.chunk import (
    DEFAULT_MAX_QUESTION_LENGTH,
    DEFAULT_MAX_SEQ_LENGTH,
    DEFAULT_OVERLAP,
    capacity,
    explode_chunks,
    pack_chunks,
)
from corpusqa.operators.label import class_index, overlap_label
from corpusqa.operators.tokens import CLS_ID, PAD_ID, SEP_ID, question_tokens, token_ids

TRAIN, EVAL, TEST = "train", "eval", "test"


def doc_chunks(pairs: DataFrame, passages: DataFrame, overlap: int = DEFAULT_OVERLAP,
               delimiter: str = DEFAULT_DELIMITER, vocab: DataFrame | None = None, pieces=None) -> DataFrame:
    """Chunk rows for distinct (docid, capacity) pairs.

    With a vocabulary the chunk's token ids (unpadded) are attached as
    ``chunk_ids``: ids are looked up once for the whole document, then each
    chunk keeps only its slice before the explode.
    """
    keys = pairs.select("docid", "capacity").distinct()
    docs = keys.join(passages.select("docid", "passage"), "docid")
    packed = pack_chunks(docs, cap_col="capacity", overlap=overlap, delimiter=delimiter,
                         keep=("docid",), pieces=pieces)
    if vocab is None:
        return explode_chunks(packed.drop("passage"), keep=["docid", "capacity", "n_tokens"])
    with_tok = packed.withColumn("tokens", all_sub_tokens("passage", pieces) if pieces else char_tokens("passage")).drop("passage")
    with_ids = token_ids(with_tok, vocab, ["docid"], "tokens", "doc_ids").drop("tokens")
    sliced = with_ids.withColumn(
        "chunks",
        F.transform(
            "chunks",
            lambda c: F.struct(
                c["doc_start"].alias("doc_start"),
                c["doc_end"].alias("doc_end"),
                c["is_window"].alias("is_window"),
                F.slice("doc_ids", c["doc_start"] + 1, c["doc_end"] - c["doc_start"] + 1).alias("chunk_ids"),
            ),
        ),
    ).drop("doc_ids")
    return sliced.select(
        "docid", "capacity", "n_tokens", F.posexplode_outer("chunks").alias("chunk_idx", "c")
    ).filter(F.col("c").isNotNull()).select(
        "docid", "capacity", "n_tokens",
        F.col("chunk_idx").cast("int").alias("chunk_idx"),
        "c.doc_start", "c.doc_end", "c.is_window", "c.chunk_ids",
    )


def build_features(examples: DataFrame, passages: DataFrame, mode: str = TRAIN,
                   max_seq_length: int = DEFAULT_MAX_SEQ_LENGTH,
                   max_question_length: int = DEFAULT_MAX_QUESTION_LENGTH,
                   overlap: int = DEFAULT_OVERLAP, delimiter: str = DEFAULT_DELIMITER,
                   vocab: DataFrame | None = None, tokenizer=char_tokens, pieces=None) -> DataFrame:
    """(question, chunk) feature rows.

    ``examples`` has ``example_id, docid, question`` and, for train/eval, the
    answer's ``token_start, token_end``, or ``passage, start, end`` (character
    positions, end inclusive) to take them from. Any other columns (e.g.
    ``rank``) are carried along. ``tokenizer(column) -> array<string>`` cuts the
    questions (T3). With ``pieces(character) -> array<string>`` (T2) passages and
    questions are cut by it, and ``token_start, token_end`` must be, too.
    """
    if pieces:
        tokenizer = lambda c: all_sub_tokens(c, pieces)
    q = question_tokens(examples, max_question_length, tokenizer=tokenizer).withColumn(
        "capacity", capacity("question_len", max_seq_length).cast("int")
    )
    if mode in (TRAIN, EVAL) and "token_start" not in q.columns:
        place = lambda c: char_to_sub_token("passage", c, pieces) if pieces else char_to_token("passage", c)
        q = q.withColumn("token_start", place("start").cast("int")).withColumn("token_end", place("end").cast("int"))
    if "passage" in q.columns:
        q = q.drop("passage")
    # chunk keys come from the plain projection: an Arrow function is opaque
    # to column pruning, so taking the keys after the id lookup would run it
    # twice
    keys = q.select("docid", "capacity")
    if vocab is None:
        q = q.drop("question_tokens")
    else:
        q = token_ids(q, vocab, ["example_id"], "question_tokens", "question_ids").drop("question_tokens")
    chunks = doc_chunks(keys, passages, overlap, delimiter, vocab, pieces)
    f = q.join(chunks, ["docid", "capacity"])
    f = f.withColumn("doc_length", (F.col("doc_end") - F.col("doc_start")).cast("int")).withColumn(
        "bert_doc_end", (F.col("question_len") + F.col("doc_end") - F.col("doc_start") + 3).cast("int")
    )
    if mode in (TRAIN, EVAL):
        st, en, lab = overlap_label()
        f = (
            f.withColumn("bert_start_position", st)
            .withColumn("bert_end_position", en)
            .withColumn("bert_answer_span", (F.col("bert_end_position") - F.col("bert_start_position")).cast("int"))
            .withColumn("label", lab)
            .withColumn("class_label", class_index("label"))
        )
    return f


def encode_inputs(features: DataFrame, max_seq_length: int = DEFAULT_MAX_SEQ_LENGTH,
                  pad: bool = True) -> DataFrame:
    """input_ids, input_mask, segment_ids ([CLS] q [SEP] d [SEP]),
    padded with 0 to ``max_seq_length`` when ``pad``."""
    ids = F.concat(
        F.array(F.lit(CLS_ID)), F.col("question_ids"), F.array(F.lit(SEP_ID)),
        F.col("chunk_ids"), F.array(F.lit(SEP_ID)),
    )
    used = F.col("question_len") + F.size("chunk_ids") + F.lit(3)
    seg = F.concat(
        F.array_repeat(F.lit(0), F.col("question_len") + F.lit(2)),
        F.array_repeat(F.lit(1), F.size("chunk_ids") + F.lit(1)),
    )
    mask = F.array_repeat(F.lit(1), used)
    out = features.withColumn("input_ids", ids).withColumn("segment_ids", seg).withColumn("input_mask", mask)
    if pad:
        for c in ("input_ids", "segment_ids", "input_mask"):
            out = out.withColumn(
                c, F.concat(F.col(c), F.array_repeat(F.lit(PAD_ID), F.lit(max_seq_length) - F.size(c)))
            )
    return out


def mode_view(features: DataFrame, mode: str) -> DataFrame:
    """The column subset the reference fills in each mode."""
    common = ["example_id", "doc_start", "question_len"]
    cols = {
        TRAIN: common + ["docid", "chunk_idx", "doc_end", "doc_length", "bert_start_position",
                         "bert_end_position", "bert_answer_span", "label", "token_start", "token_end"],
        EVAL: common + ["docid", "chunk_idx", "bert_doc_end", "bert_start_position", "bert_end_position",
                        "bert_answer_span", "label", "start", "end"],
        TEST: common + ["docid", "chunk_idx", "bert_doc_end"],
    }[mode]
    extra = [c for c in ("input_ids", "input_mask", "segment_ids", "rank") if c in features.columns]
    return features.select(*[c for c in cols if c in features.columns], *extra)
