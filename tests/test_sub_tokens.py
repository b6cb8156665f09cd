"""Any number of tokens a character: maps, packing, spans and features."""

from pyspark.sql import functions as F

from corpusqa.functions.text import byte_pieces, char_to_sub_token, char_to_sub_token_map, sub_token_to_char_map
from corpusqa.operators import clean, decode, encode
from corpusqa.operators.chunk import explode_chunks, pack_chunks

TEXTS = ["", "abc", "né\n\nß 中。é", "\n 　", "中文。ab。​é。", "x" * 30 + "é" * 30 + "."]


def _pieces(text):
    zero = lambda ch: ch in "\n 　​"
    return [[] if zero(ch) else [f"{b:02x}" for b in ch.lower().encode()] for ch in text]


def test_maps(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, t string")
    rows = df.select("id", char_to_sub_token_map("t", byte_pieces).alias("there"), sub_token_to_char_map("t", byte_pieces).alias("back")).collect()
    for i, there, back in rows:
        pieces = _pieces(TEXTS[i])
        assert there == [sum(map(len, pieces[:c])) for c in range(len(pieces))]
        assert back == [c for c, p in enumerate(pieces) for _ in p]


def test_two_tokens_for_some_characters(spark):
    """A vocabulary of pieces: a table of characters cut in two, the rest whole."""
    pieces = lambda ch: F.when(ch == "½", F.array(F.lit("1"), F.lit("##2"))).when(ch == " ", F.array().cast("array<string>")).otherwise(F.array(ch))
    row = spark.createDataFrame([("a ½b½",)], "t string")
    there, back, at = row.select(char_to_sub_token_map("t", pieces), sub_token_to_char_map("t", pieces), char_to_sub_token("t", F.lit(4), pieces)).first()
    assert (there, back, at) == ([0, 1, 1, 3, 4], [0, 2, 2, 3, 4, 4], 4)


def test_chunks_cover_all_tokens(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "docid int, passage string").withColumn("capacity", F.lit(16))
    packed = pack_chunks(df, "capacity", 4, "。", keep=("docid",), pieces=byte_pieces)
    sizes = {r["docid"]: r["n_tokens"] for r in packed.collect()}
    seen = {i: set() for i in sizes}
    for r in explode_chunks(packed, ["docid"]).collect():
        assert 0 < r["doc_end"] - r["doc_start"] + 1 <= 16
        seen[r["docid"]] |= set(range(r["doc_start"], r["doc_end"] + 1))
    for i, t in enumerate(TEXTS):
        assert sizes[i] == len([b for p in _pieces(t) for b in p]) and seen[i] == set(range(sizes[i]))


def test_answers_come_back_from_features(spark):
    """Examples, labelled features and decoding agree on byte tokens: the label's
    positions give the gold answer."""
    passages = spark.createDataFrame([(1, "où est né Zoë? à Nîmes. en été déjà. fin."), (2, "中文句子。答案在这里。完。")], "docid int, passage string")
    train = spark.createDataFrame([(7, 1, "né où?", "à Nîmes"), (8, 2, "哪里", "答案")], "id int, docid int, question string, answer string")
    ex = clean.qa_examples(clean.answerable(clean.locate_answers(train, passages)), byte_pieces).withColumnRenamed("guid", "example_id")
    f = encode.build_features(ex, passages, max_seq_length=64, max_question_length=16, overlap=4, pieces=byte_pieces)
    known = f.filter(F.col("label") == "known")
    best = F.struct("docid", "doc_start", "question_len", F.col("bert_start_position").alias("best_start"), F.col("bert_end_position").alias("best_end"), F.lit(1.0).alias("score"))
    spans = decode.span_text(known.select("example_id", best.alias("best")), passages, byte_pieces)
    assert {(r["example_id"], r["answer"]) for r in spans.collect()} == {(7, "à Nîmes"), (8, "答案")}


def test_token_ids_by_join(spark):
    """Any rows, repeated and null keys, tokens that are not in the vocabulary; no job runs
    while the plan is made."""
    from corpusqa.operators.tokens import token_ids

    rows = [(1, "x", ["a", "b", "a", "?"]), (1, "x", ["a", "b", "a", "?"]), (None, "x", ["b"]), (1, "y", []), (2, "x", None), (3, "z", ["?", None])]
    df = spark.createDataFrame(rows, "id int, part string, words array<string>")
    vocab = spark.createDataFrame([("a", 5), ("b", 6), ("c", 7)], "token string, token_id int")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("token-ids", "planning")
    out = token_ids(df, vocab, ["id", "part"], "words", "ids")
    assert list(tracker.getJobIdsForGroup("token-ids")) == [] and out.columns == [*df.columns, "ids"]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    got = sorted(((r["id"], r["part"], r["words"], r["ids"]) for r in out.collect()), key=repr)
    ids = {"a": 5, "b": 6}
    assert got == sorted(((i, p, w, None if w is None else [ids.get(x, 1) for x in w]) for i, p, w in rows), key=repr)
