"""Registered queries over the driver tables (one per SURVEY §2 key).

Every query reads whole tables (no id subsets, no row caps) and ends in an
explicit projection whose column names and types match the SQL oracle in
``corpusqa.plans.oracle``. Arrays are reported as joined strings or md5
digests of joined strings so that both engines compare equal values.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusqa.functions.text import (
    byte_pieces,
    char_to_sub_token_map,
    char_to_token_map,
    char_tokens,
    n_tokens,
    sub_token_to_char_map,
    token_to_char_map,
)
from corpusqa.operators import chunk, clean, decode, encode, metrics, retrieval, sample, score, segments, tokens
from corpusqa.plans import pipeline, stand_in
from corpusqa.schemas import PASSAGES, PREDICTIONS_TEST, TEST, TRAIN_CLEAN, TRAIN_RAW
from corpusqa.session import materialize, scratch_path
from corpusqa.sources import csv_io, driver_tables as dt, shards
from corpusqa.streaming import questions as streaming

# Fixed parameters of the driver queries.
DELIM = "."          # the driver tables hold Latin text without the ideographic stop
K = 10
MAX_SEQ = 512
MAX_Q = 96
CAPACITY = MAX_SEQ - MAX_Q - 3
BATCH = 64
SHARD_ROWS = 16 * BATCH
TRAIN_STEPS = 1000
SEED = 1


def _s(c):
    return F.col(c).cast("string")


def _md5_join(col):
    return F.md5(F.array_join(F.col(col), " "))


class Ctx:
    """Lazy DataFrames shared by the queries of one (spark, sf_dir)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf = spark, sf_dir

    @cached_property
    def prep(self) -> pipeline.Prepared:
        return pipeline.prepare(self.table_passages, dt.train_raw(self.spark, self.sf))

    @cached_property
    def table_passages(self) -> DataFrame:
        return dt.passages(self.spark, self.sf, self.spark.sparkContext.defaultParallelism)

    @cached_property
    def spread_passages(self) -> DataFrame:
        return clean.first_passage_per_docid(dt.passages(self.spark, self.sf))

    @property
    def texts(self) -> DataFrame:
        # passages that are looked up: the scan's own partitions
        return self.prep.passages

    @cached_property
    def passages(self) -> DataFrame:
        # passages for work on every row: spread
        return clean.clean_passages(self.spread_passages)

    @cached_property
    def questions(self) -> DataFrame:
        return clean.clean_questions(dt.test_questions(self.spark, self.sf))

    @cached_property
    def raw_questions(self) -> DataFrame:
        return dt.test_questions(self.spark, self.sf)

    @cached_property
    def conv_questions(self) -> DataFrame:
        return clean.clean_questions(dt.conversation_questions(self.spark, self.sf))

    @cached_property
    def fresh_index(self) -> retrieval.Index:
        return retrieval.build_index(self.prep.raw_passages)

    @cached_property
    def index(self) -> retrieval.Index:
        # postings, frequencies and searches come from the blocks: written once
        return retrieval.held(self.fresh_index)

    @cached_property
    def hits(self) -> DataFrame:
        # questions x k rows, read by several branches (chunk keys, feature
        # join, late passage join): written once under the checkpoint folder
        return materialize(retrieval.bm25_topk(self.index, self.raw_questions, K), "hits")

    @cached_property
    def examples(self) -> DataFrame:
        # answerable training examples feed the chunk keys, the feature join,
        # the split and the eval labels: written once
        return materialize(self.prep.examples, "examples")

    @cached_property
    def vocab(self) -> DataFrame:
        # at most a row for each character: stored, and joined by documents and questions
        return materialize(tokens.build_char_vocab(self.passages), "vocab")

    def _kw(self):
        return dict(max_seq_length=MAX_SEQ, max_question_length=MAX_Q, delimiter=DELIM)

    @cached_property
    def test_feats(self) -> DataFrame:
        h = self.hits.join(self.questions, "id")
        return pipeline.test_features(h, self.texts, **self._kw())

    @cached_property
    def test_scored(self) -> DataFrame:
        return decode.best_span_per_chunk(stand_in.pseudo_logits(self.test_feats, MAX_SEQ))

    @cached_property
    def test_winners(self) -> DataFrame:
        # one row per question, read by the answer, fallback and count steps
        return materialize(decode.best_span_per_question(self.test_scored, ("rank", "chunk_idx")), "winners")

    @cached_property
    def winner_passages(self) -> DataFrame:
        return decode.winner_passages(self.test_winners, self.texts)

    @cached_property
    def train_feats(self) -> DataFrame:
        # read by several steps (sampling reads it four times): written once
        f = pipeline.training_features(self.examples, self.texts, encode.TRAIN, **self._kw())
        return materialize(f, "train_features")

    @cached_property
    def split(self) -> DataFrame:
        return sample.train_dev_split(self.examples, 0.2, SEED, id_col="example_id")

    @cached_property
    def dev_examples(self) -> DataFrame:
        return self.split.filter(F.col("split") == "dev").drop("split")

    @cached_property
    def eval_feats(self) -> DataFrame:
        return pipeline.training_features(self.dev_examples, self.texts, encode.EVAL, **self._kw())

    @cached_property
    def eval_scored(self) -> DataFrame:
        cl = stand_in.label_class_logits(dt.labels(self.spark, self.sf))
        return stand_in.pseudo_logits(self.eval_feats, MAX_SEQ, cl)

    @cached_property
    def eval_predictions(self) -> DataFrame:
        w = materialize(decode.best_span_per_question(decode.best_span_per_chunk(self.eval_scored), ("chunk_idx",)),
                        "eval_winners")
        return decode.predict_eval(w, self.dev_examples, decode.winner_passages(w, self.texts))

    @cached_property
    def selected(self) -> DataFrame:
        return sample.sample_training(self.train_feats, SEED)


# ---------------------------------------------------------------- queries

def q_clean_passages(c: Ctx):
    return c.passages.select("docid", "passage", F.length("passage").cast("long").alias("n_chars"))


def q_clean_questions(c: Ctx):
    b = c.questions.select(F.lit("benchmark").alias("qset"), "id", "question")
    v = c.conv_questions.select(F.lit("conversation").alias("qset"), "id", "question")
    return b.unionByName(v)


def q_analyze_terms(c: Ctx):
    return retrieval.query_terms(c.raw_questions).select("id", "term", F.col("qtf").cast("long").alias("qtf"))


def q_build_postings(c: Ctx):
    return c.index.postings.select("term", "docid", F.col("tf").cast("long").alias("tf"), "dl")


def q_term_stats(c: Ctx):
    return c.index.term_stats.select("term", F.col("df").cast("long").alias("df"))


def q_doc_stats(c: Ctx):
    return retrieval.build_index(c.spread_passages).doc_stats.select("docid", "dl")


def q_corpus_stats(c: Ctx):
    return retrieval.corpus_stats(c.index).withColumn("avgdl", F.round("avgdl", 6))


def q_bm25_topk(c: Ctx):
    return c.hits


def q_bm25_topk_conversations(c: Ctx):
    return retrieval.bm25_topk(c.index, dt.conversation_questions(c.spark, c.sf), K)


def q_retrieve_pairs(c: Ctx):
    r = retrieval.retrieve_pairs(c.hits, c.questions, clean.passages_of(c.texts, c.hits))
    return r.select("id", "docid", "rank", "question", F.length("passage").cast("long").alias("passage_len"))


def q_recall_at_k(c: Ctx):
    """Train questions (first sentence of a document) against their own document as
    the gold answer."""
    gold = c.examples.select(F.col("example_id").alias("id"), "docid")  # stored before the index: texts are joined once
    tq = dt.train_raw(c.spark, c.sf).join(gold, "id", "left_semi")
    hits = retrieval.bm25_topk(c.index, tq, K)
    return retrieval.recall_at_k(hits, gold, K)


def q_contains_at_k(c: Ctx):
    """Benchmark questions: is a retrieved document one that contains the
    whole (cleaned) question text? Checked only on the k hits per question."""
    r = retrieval.retrieve_pairs(c.hits, c.questions, clean.passages_of(c.texts, c.hits))
    hit = r.groupBy("id").agg(F.max(F.when(F.instr("passage", F.col("question")) > 0, 1).otherwise(0)).alias("hit"))
    allq = c.questions.select("id").join(hit, "id", "left")
    return allq.agg(
        F.lit(K).cast("long").alias("k"),
        F.count(F.lit(1)).cast("long").alias("n_questions"),
        F.sum(F.coalesce("hit", F.lit(0))).cast("long").alias("n_hits"),
    )


def q_locate_answer(c: Ctx):
    return c.prep.located.select("id", "docid", "question", "answer", "start_index", "end_index")


def q_answerable_train(c: Ctx):
    return c.prep.answerable.select("id", "docid", "question", "answer", "start_index", "end_index")


def q_rejected_train(c: Ctx):
    return c.prep.rejected.select("id", "docid", "answer", "reason")


def q_qa_examples(c: Ctx):
    return c.prep.examples.select(
        "example_id", "docid", "question", "start", "end", "token_start", "token_end", "gold", "passage_len"
    )


def q_missing_docids(c: Ctx):
    return clean.missing_docids(dt.train_raw(c.spark, c.sf), c.texts).select("id", "docid")


def q_char_tokens(c: Ctx):
    return c.passages.select(
        "docid",
        n_tokens("passage").cast("long").alias("n_tokens"),
        F.array_join(char_tokens("passage"), " ").alias("tokens"),
    )


def q_question_tokens(c: Ctx):
    t = tokens.question_tokens(c.questions, MAX_Q)
    return t.select(
        "id",
        F.col("question_len").cast("long").alias("question_len"),
        n_tokens("question").cast("long").alias("n_tokens_full"),
        F.array_join("question_tokens", " ").alias("tokens"),
    )


def q_offset_map(c: Ctx):
    """T4 char->token as an array per document, reported as a digest."""
    m = char_to_token_map("passage")
    return c.passages.select("docid", F.size(m).cast("long").alias("n_chars"), F.md5(F.array_join(m, ",")).alias("map_md5"))


def q_token_to_char(c: Ctx):
    """T4 token->char as an array per document, reported as a digest."""
    m = token_to_char_map("passage")
    return c.passages.select("docid", F.size(m).cast("long").alias("n_tokens"), F.md5(F.array_join(m, ",")).alias("map_md5"))


def q_vocab(c: Ctx):
    return c.vocab.select("token", F.col("token_id").cast("long").alias("token_id"))


def q_token_ids(c: Ctx):
    t = c.passages.select("docid", char_tokens("passage").alias("tokens"))
    ids = tokens.token_ids(t, c.vocab, ["docid"], "tokens", "ids")
    return ids.select(
        "docid",
        F.size("ids").cast("long").alias("n_ids"),
        _md5_join("ids").alias("ids_md5"),
        F.aggregate("ids", F.lit(0).cast("long"), lambda a, x: a + x).alias("ids_sum"),
    )


def q_split_sentences(c: Ctx):
    return chunk.split_sentences(c.passages, DELIM)


def _packed(c: Ctx):
    docs = c.passages.withColumn("capacity", F.lit(CAPACITY))
    return chunk.explode_chunks(
        chunk.pack_chunks(docs, "capacity", chunk.DEFAULT_OVERLAP, DELIM, keep=("docid",)).drop("passage"),
        keep=["docid", "capacity"],
    )


def q_pack_chunks(c: Ctx):
    return _packed(c).select("docid", F.col("capacity").cast("long").alias("capacity"), "chunk_idx",
                             "doc_start", "doc_end", "is_window")


def q_sliding_windows(c: Ctx):
    return q_pack_chunks(c).filter(F.col("is_window"))


def q_explode_chunks(c: Ctx):
    return c.test_feats.select(
        F.col("example_id").alias("id"), "docid", "rank", F.col("capacity").cast("long").alias("capacity"),
        "chunk_idx", "doc_start", "doc_end", "is_window", "question_len", "bert_doc_end",
    )


_LABEL_COLS = ["example_id", "docid", "chunk_idx", "doc_start", "doc_end", "doc_length", "question_len",
               "token_start", "token_end", "bert_start_position", "bert_end_position", "bert_answer_span", "label"]


def q_label_chunks(c: Ctx):
    return c.train_feats.select(*_LABEL_COLS)


def q_class_labels(c: Ctx):
    return c.train_feats.select("example_id", "chunk_idx", "label", "class_label")


def q_encode_inputs(c: Ctx):
    h = c.hits.join(c.questions, "id")
    f = pipeline.test_features(h, c.texts, vocab=c.vocab, **c._kw())
    e = encode.encode_inputs(f, MAX_SEQ)
    return e.select(
        F.col("example_id").alias("id"), "docid", "rank", "chunk_idx", "bert_doc_end",
        F.aggregate("input_mask", F.lit(0).cast("long"), lambda a, x: a + x).alias("n_used"),
        F.size("input_ids").cast("long").alias("seq_len"),
        _md5_join("input_ids").alias("ids_md5"),
        _md5_join("input_mask").alias("mask_md5"),
        _md5_join("segment_ids").alias("seg_md5"),
    )


def q_eval_features(c: Ctx):
    """The eval-mode view of the labelled dev features."""
    return encode.mode_view(c.eval_feats, encode.EVAL)


def q_train_features(c: Ctx):
    """The train-mode view."""
    return encode.mode_view(c.train_feats, encode.TRAIN)


def q_test_features(c: Ctx):
    """The test-mode view."""
    return encode.mode_view(c.test_feats, encode.TEST)


def q_dedup_passages(c: Ctx):
    """A passage table that holds every document twice, the second time with
    another text and a later ordinal; the first stays."""
    first = dt.passages(c.spark, c.sf)
    again = first.select((F.col("ordinal") + F.lit(1 << 60)).alias("ordinal"), "docid", F.concat(F.lit("later "), "passage").alias("passage"))
    return clean.first_passage_per_docid(again.unionByName(first)).select("docid", "passage")


def _stored_index(c: Ctx) -> retrieval.Index:
    path = scratch_path(c.spark, "index")
    retrieval.write_index(c.fresh_index, path)
    return retrieval.read_index(c.spark, path)


def q_index_roundtrip(c: Ctx):
    """S4 + S5: the stored index, read back: every posting with its term's and
    its document's statistics."""
    return retrieval.postings_with_stats(_stored_index(c))


def q_bm25_topk_stored(c: Ctx):
    return retrieval.bm25_topk(_stored_index(c), c.raw_questions, K)


def _grown_index(c: Ctx) -> str:
    """Three loads of the whole table: with an earlier text in every third docid, as it is
    (these are replaced), and again (adds nothing). The path of the index."""
    path = scratch_path(c.spark, "grown-index")
    now = c.table_passages
    earlier = F.when(F.col("docid") % 3 == 0, F.concat(F.lit("earlier text "), "passage")).otherwise(F.col("passage"))
    for load in (now.withColumn("passage", earlier), now, now):
        segments.append_documents(load, path)
    return path


def q_index_append(c: Ctx):
    """An index grown by loads has the rows of one built at once."""
    return retrieval.postings_with_stats(segments.open_index(c.spark, _grown_index(c)))


def q_bm25_topk_appended(c: Ctx):
    """R1 over the segments of a grown index, replaced documents among them."""
    return retrieval.bm25_topk(segments.open_index(c.spark, _grown_index(c)), c.raw_questions, K)


def q_index_merge(c: Ctx):
    """Q6: the grown index, its segments merged into one."""
    path = _grown_index(c)
    segments.merge_segments(c.spark, path)
    segments.drop_merged(c.spark, path)
    return retrieval.postings_with_stats(segments.open_index(c.spark, path))


def q_sub_token_maps(c: Ctx):
    """T2, T4 with 0 to 4 tokens a character (its UTF-8 bytes): both maps as digests."""
    there, back = char_to_sub_token_map("passage", byte_pieces), sub_token_to_char_map("passage", byte_pieces)
    md5 = lambda m: F.md5(F.array_join(m, ","))
    return c.passages.select("docid", F.size(back).cast("long").alias("n_tokens"), md5(there).alias("token_md5"), md5(back).alias("char_md5"))


def q_sub_token_spans(c: Ctx):
    """E8, D6 with several tokens a character: the answers' places in tokens, and the
    text that the tokens give back."""
    ex = clean.qa_examples(c.prep.answerable, byte_pieces).withColumnRenamed("guid", "example_id")
    # winners as if the model had found the answer in a chunk that starts the document
    best = F.struct(
        "docid", F.lit(0).alias("doc_start"), F.lit(0).alias("question_len"), (F.col("token_start") + 2).alias("best_start"),
        (F.col("token_end") + 2).alias("best_end"), F.lit(1.0).alias("score"),
    )
    spans = decode.span_text(ex.select("example_id", best.alias("best")), c.texts, byte_pieces)
    return spans.select("example_id", "docid", F.col("tok_start").alias("token_start"), F.col("tok_end").alias("token_end"), "char_start", "char_end", "answer")


def q_sub_token_chunks(c: Ctx):
    """C1-C5 over several tokens a character."""
    docs = c.passages.withColumn("capacity", F.lit(CAPACITY))
    packed = chunk.pack_chunks(docs, "capacity", chunk.DEFAULT_OVERLAP, DELIM, keep=("docid",), pieces=byte_pieces)
    return chunk.explode_chunks(packed.drop("passage"), keep=["docid"])


def q_export_shards(c: Ctx):
    """The training batches as shard files, read again: every row with its file's
    shard and its place in the file."""
    path = scratch_path(c.spark, "shards")
    rows = sample.shuffle_batches(c.selected, BATCH, SEED).select("example_id", "docid", "chunk_idx", "order_rank", "batch_id")
    shards.write_shards(rows, path, SHARD_ROWS)
    return shards.read_shards(c.spark, path).withColumn("place", F.col("_metadata.row_index")).withColumn("shard", F.col("shard").cast("long"))


def q_export_manifest(c: Ctx):
    """The manifest of the shard files."""
    path = scratch_path(c.spark, "shards")
    shards.write_shards(sample.shuffle_batches(c.selected, BATCH, SEED).select("example_id", "docid", "chunk_idx", "order_rank"), path, SHARD_ROWS)
    return shards.manifest(c.spark, path).select("shard", "n_rows", "first_rank", "last_rank")


def q_stream_predictions(c: Ctx):
    """§2.11: the questions as a stream of files, answered batch by batch against the
    stored index, each batch once; what the sink holds."""
    source, out, progress = (scratch_path(c.spark, f"stream-{x}") for x in ("questions", "answers", "progress"))
    c.raw_questions.repartition(2, "id").write.parquet(source)
    stream = streaming.question_stream(c.spark, source, c.raw_questions.schema, max_files_per_trigger=1)
    scorer = lambda f: stand_in.pseudo_logits(f, MAX_SEQ)
    streaming.stream_predictions(stream, _stored_index(c), c.texts, out, progress, scorer, K, DELIM).awaitTermination()
    return c.spark.read.parquet(out).select("id", "docid", "answer")


def q_score_model(c: Ctx):
    """M1: a model of whole numbers over the encoded inputs."""
    h = c.hits.join(c.questions, "id")
    f = score.balance_features(pipeline.test_features(h, c.texts, vocab=c.vocab, **c._kw()))
    s = score.score_features(encode.encode_inputs(f, MAX_SEQ), stand_in.load_hash_model)
    total = lambda x: F.round(F.aggregate(x, F.lit(0.0).cast("double"), lambda a, v: a + v.cast("double")), 2)
    return s.select(
        F.col("example_id").alias("id"), "docid", "chunk_idx", total("start_logits").alias("start_sum"), total("end_logits").alias("end_sum"),
        F.get("class_logits", F.lit(0)).cast("double").alias("class0"), F.get("class_logits", F.lit(1)).cast("double").alias("class1"),
    )


def q_sample_training(c: Ctx):
    return c.selected.select("example_id", "docid", "chunk_idx", "label")


def q_sampling_stats(c: Ctx):
    return sample.sampling_stats(c.train_feats)


def q_no_known_examples(c: Ctx):
    return sample.no_known_examples(c.train_feats)


def q_train_dev_split(c: Ctx):
    return c.split.select("example_id", "split")


def q_union_splits(c: Ctx):
    tr_ids = c.split.filter(F.col("split") == "train").select("example_id")
    tr = c.selected.join(tr_ids, "example_id", "left_semi")
    u = sample.union_splits({"train": tr.select("example_id", "docid", "chunk_idx", "label"),
                             "dev": c.eval_feats.select("example_id", "docid", "chunk_idx", "label")})
    return u.select("split", "example_id", "docid", "chunk_idx", "label")


def q_shuffle_batches(c: Ctx):
    b = sample.shuffle_batches(c.selected, BATCH, SEED)
    return b.select("example_id", "docid", "chunk_idx", "order_rank", "batch_id")


def q_step_batches(c: Ctx):
    return sample.step_batches(sample.shuffle_batches(c.selected, BATCH, SEED), TRAIN_STEPS).select(
        "step", "batch_id", "example_id", "docid", "chunk_idx"
    )


def q_feature_order(c: Ctx):
    return sample.feature_order(c.test_feats).select(
        F.col("example_id").alias("id"), "docid", "rank", "chunk_idx", "feature_ord"
    )


def q_pseudo_logits(c: Ctx):
    s = stand_in.pseudo_logits(c.test_feats, MAX_SEQ)

    def tot(col):
        return F.round(F.aggregate(col, F.lit(0.0).cast("double"), lambda a, x: a + x.cast("double")), 3)

    return s.select(
        F.col("example_id").alias("id"), "docid", "chunk_idx",
        tot("start_logits").alias("start_sum"), tot("end_logits").alias("end_sum"),
        F.element_at("start_logits", 1).cast("double").alias("start0"),
        F.element_at("end_logits", 2).cast("double").alias("end1"),
    )


def q_topk_positions(c: Ctx):
    s = stand_in.pseudo_logits(c.test_feats, MAX_SEQ)
    return s.select(
        F.col("example_id").alias("id"), "docid", "chunk_idx",
        F.array_join(decode.topk_positions("start_logits"), ",").alias("start_top"),
        F.array_join(decode.topk_positions("end_logits"), ",").alias("end_top"),
    )


def q_valid_spans(c: Ctx):
    s = stand_in.pseudo_logits(c.test_feats, MAX_SEQ)
    cands = decode.span_candidates()
    return s.select(
        F.col("example_id").alias("id"), "docid", "chunk_idx",
        F.size(F.filter(cands, lambda x: x["score"] > F.lit(decode.INVALID_SCORE))).cast("long").alias("n_valid"),
    )


def q_span_candidates(c: Ctx):
    s = stand_in.pseudo_logits(c.test_feats, MAX_SEQ)
    x = s.select(F.col("example_id").alias("id"), "docid", "chunk_idx",
                 F.posexplode_outer(decode.span_candidates()).alias("cand_idx", "c")).filter(F.col("c").isNotNull())
    return x.select("id", "docid", "chunk_idx", F.col("cand_idx").cast("long").alias("cand_idx"),
                    F.col("c.s").alias("s"), F.col("c.e").alias("e"),
                    F.round(F.col("c.score").cast("double"), 6).alias("score"))


def q_best_span_per_chunk(c: Ctx):
    return c.test_scored.select(
        F.col("example_id").alias("id"), "docid", "chunk_idx", "best_start", "best_end",
        F.round(F.col("best_score").cast("double"), 6).alias("best_score"),
    )


def q_best_span_per_question(c: Ctx):
    w = c.test_winners.filter(F.col("best").isNotNull())
    return w.select(
        F.col("example_id").alias("id"), F.col("best.docid").alias("docid"), F.col("best.chunk_idx").alias("chunk_idx"),
        F.col("best.best_start").alias("best_start"), F.col("best.best_end").alias("best_end"),
        F.round(F.col("best.score").cast("double"), 6).alias("score"),
    )


def q_unanswered(c: Ctx):
    return decode.unanswered(c.test_winners).select(F.col("example_id").alias("id"), "docid")


def q_span_text(c: Ctx):
    return decode.span_text(c.test_winners, c.winner_passages).select(
        F.col("example_id").alias("id"), "docid", "char_start", "char_end", "answer"
    )


def q_predict_test(c: Ctx):
    return decode.predict_test(c.test_winners, c.winner_passages)


def q_predict_eval(c: Ctx):
    return c.eval_predictions


def q_prediction_counts(c: Ctx):
    return metrics.prediction_counts(c.test_winners)


def q_stage_counts(c: Ctx):
    return metrics.stage_counts({
        "questions": c.questions,
        "retrieved_pairs": c.hits,
        "test_features": c.test_feats,
        "answered": c.test_winners.filter(F.col("best").isNotNull()),
        "train_examples": c.prep.examples,
        "train_features": c.train_feats,
        "selected_features": c.selected,
    })


def q_rouge_l(c: Ctx):
    return metrics.rouge_l(c.eval_predictions).select("example_id", F.round("rouge_l_f", 6).alias("rouge_l_f"))


def q_rouge_l_mean(c: Ctx):
    return metrics.rouge_l_mean(c.eval_predictions).select("n", F.round("rouge_l_mean", 6).alias("rouge_l_mean"))


def q_qa_loss(c: Ctx):
    l = metrics.qa_loss(c.eval_scored)
    return l.select(*[F.round(x, 6).alias(x) for x in ("start_loss", "end_loss", "class_loss", "loss")])


def q_running_loss(c: Ctx):
    loss = dt.loss_log(c.spark, c.sf)
    plain = metrics.running_loss(loss)
    gathered = metrics.running_loss(loss, accumulation=4).select("step", F.col("running_loss").alias("running_loss_4"))
    return plain.join(gathered, "step")


def q_eval_log(c: Ctx):
    path = scratch_path(c.spark, "eval_log")
    log = dt.eval_log(c.spark, c.sf)
    for f in ("dev.csv", "train.csv"):   # one append per evaluated file
        csv_io.append_eval_log(log.filter(F.col("file") == f), path)
    csv_io.append_eval_log(log.filter(F.col("file") == "dev.csv"), path)   # again: its rows count once
    return csv_io.read_eval_log(c.spark, path)


def q_best_eval_run(c: Ctx):
    return metrics.best_eval_run(dt.eval_log(c.spark, c.sf))


def q_csv_roundtrip(c: Ctx):
    path = scratch_path(c.spark, "passages_csv")
    csv_io.write_table(c.passages.select(_s("docid").alias("docid"), "passage"), path)
    back = csv_io.read_table(c.spark, path, PASSAGES)
    return back.select(F.col("docid").cast("long").alias("docid"), "passage")


def q_tsv_roundtrip(c: Ctx):
    path = scratch_path(c.spark, "train_tsv")
    raw = dt.train_raw(c.spark, c.sf)
    csv_io.write_table(raw.select(*[_s(x).alias(x) for x in ("id", "docid", "question", "answer")]), path, sep="\t")
    back = csv_io.read_table(c.spark, path, TRAIN_RAW, sep="\t")
    return back.select(F.col("id").cast("long").alias("id"), F.col("docid").cast("long").alias("docid"),
                       "question", "answer")


def q_predictions_tsv_roundtrip(c: Ctx):
    path = scratch_path(c.spark, "test_prediction")
    p = q_predict_test(c)
    csv_io.write_table(p.select(_s("id").alias("id"), _s("docid").alias("docid"), "answer"), path, sep="\t")
    back = csv_io.read_table(c.spark, path, PREDICTIONS_TEST, sep="\t")
    return back.select(F.col("id").cast("long").alias("id"), F.col("docid").cast("long").alias("docid"), "answer")


def q_train_clean_roundtrip(c: Ctx):
    """The cleaned train file with the answers' places, written and read again."""
    path = scratch_path(c.spark, "train_clean")
    rows = c.prep.answerable.select(*[_s(x).alias(x) for x in ("id", "docid")], "question", "answer", "start_index", "end_index")
    csv_io.write_table(rows, path)
    back = csv_io.read_table(c.spark, path, TRAIN_CLEAN)
    return back.select(F.col("id").cast("long").alias("id"), F.col("docid").cast("long").alias("docid"),
                       "question", "answer", "start_index", "end_index")


def q_test_file_roundtrip(c: Ctx):
    """The cleaned test file, written and read again."""
    path = scratch_path(c.spark, "test_clean")
    csv_io.write_table(c.questions.select(_s("id").alias("id"), "question"), path)
    return csv_io.read_table(c.spark, path, TEST).select(F.col("id").cast("long").alias("id"), "question")


def _eval_chain(c: Ctx):
    """Two evaluations of one run, the second with start and end logits swapped:
    (predictions of both, path of the log)."""
    cl = stand_in.label_class_logits(dt.labels(c.spark, c.sf))
    plain = lambda f: stand_in.pseudo_logits(f, MAX_SEQ, cl)

    def swapped(f):
        s = plain(f).withColumnRenamed("start_logits", "x")
        return s.withColumnRenamed("end_logits", "start_logits").withColumnRenamed("x", "end_logits")

    log = scratch_path(c.spark, "eval_log")
    feats = materialize(c.eval_feats, "eval_features")
    runs = [pipeline.evaluate_run("run", step, c.dev_examples, c.texts, scorer, log, features=feats, **c._kw()) for step, scorer in ((50, plain), (100, swapped))]
    return runs[0].unionByName(runs[1]), log


def q_eval_chain(c: Ctx):
    """The log of both evaluations."""
    _, log = _eval_chain(c)
    return c.spark.read.parquet(log).select("run", "file", "global_step", F.round("loss", 6).alias("loss"), F.round("eval_accuracy", 6).alias("eval_accuracy"))


def q_best_eval_predictions(c: Ctx):
    """The predictions of the better evaluation (A7, S7), read back."""
    predictions, log = _eval_chain(c)
    path = scratch_path(c.spark, "best_eval_predictions")
    pipeline.best_predictions(predictions, log, path)
    back = csv_io.read_table(c.spark, path, csv_io.BEST_PREDICTIONS)
    return back.select("run", F.col("example_id").cast("long").alias("example_id"), "prediction", "label")


QUERIES = {name[2:]: fn for name, fn in list(globals().items()) if name.startswith("q_") and callable(fn)}


def make(name):
    fn = QUERIES[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Ctx(spark, sf_dir))

    run.__name__ = name
    return run
