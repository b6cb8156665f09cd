"""DuckDB SQL oracles for the registered queries.

Each string is a stand-alone statement over the driver's views (documents,
benchmark, conversations, events, labels, ...). The CTEs restate every rule
in plain SQL -- including greedy packing as a recursive CTE -- independently
of the Spark code, so an equal result is a real check.
"""

from __future__ import annotations

# Fixed parameters, equal to corpusqa.plans.driver_queries.
K = 10
MAX_SEQ = 512
MAX_Q = 96
OVERLAP = 100
CAPACITY = MAX_SEQ - MAX_Q - 3
BATCH = 64
SHARD_ROWS = 16 * BATCH
TRAIN_STEPS = 1000
SEED = "1"
DEV_THRESHOLD = "3333"   # 0.2 * 16^4 as four hex digits
ZERO = r"[\p{Zs}\p{Cc}\p{Cf}]"
SENT = r"[^.]*\.|[^.]+"


# ------------------------------------------------------------ expressions

def clean(x):
    return f"replace(replace({x}, ' ', ''), chr(9), '')"


def kept(x):
    return f"regexp_replace({x}, '{ZERO}', '', 'g')"


def ntok(x):
    return f"length({kept(x)})"


def toks(x):
    return (f"(CASE WHEN length({kept(x)}) = 0 THEN []::VARCHAR[] "
            f"ELSE list_transform(string_split({kept(x)}, ''), lambda t: lower(t)) END)")


def nbytes(x):
    """Tokens of a text in byte mode: the UTF-8 bytes of what is kept, lower-cased."""
    return f"octet_length(encode(lower({kept(x)})))"


def o2t(p, c):
    return f"length({kept(f'substring({p}, 1, {c})')})"


def t2o_list(p):
    return (f"list_filter(list_transform(string_split({p}, ''), lambda ch, i: "
            f"CASE WHEN regexp_matches(ch, '^{ZERO}$') THEN -1 ELSE i - 1 END), lambda x: x >= 0)")


def lens(p):
    return f"list_transform(regexp_extract_all({kept(p)}, '{SENT}'), lambda s: length(s))"


def terms(x):
    words = rf"regexp_extract_all(lower(regexp_replace({x}, '\p{{Han}}', ' ', 'g')), '[\p{{L}}\p{{N}}]+')"
    bigr = (rf"flatten(list_transform(regexp_extract_all({x}, '\p{{Han}}+'), lambda r: "
            rf"list_transform(range(1, greatest(length(r) - 1, 1) + 1), lambda i: substring(r, i, 2))))")
    return f"list_concat({words}, {bigr})"


# ------------------------------------------------------------ base CTEs

BASE = f"""
P AS (SELECT doc_id AS docid, {clean('text')} AS passage, text AS raw FROM documents),
TQ AS (SELECT item_id AS id, {clean('text')} AS question, text AS raw FROM benchmark),
CQ AS (SELECT conv_id * 1000 + turn AS id, {clean('text')} AS question, text AS raw FROM conversations WHERE role = 'user'),
TRAW AS (
  SELECT doc_id AS id, doc_id AS docid, s[1] AS question,
         s[1 + (doc_id * 37) % len(s)] || CASE WHEN doc_id % 50 = 0 THEN '@@' ELSE '' END AS answer
  FROM (SELECT doc_id, regexp_extract_all(text, '{SENT}') AS s FROM documents)),
TR AS (SELECT id, docid, {clean('question')} AS question, {clean('answer')} AS answer FROM TRAW),
LOC0 AS (
  SELECT t.id, t.docid, t.question, t.answer, p.passage,
         CAST(CASE WHEN t.answer IS NOT NULL AND length(t.answer) > 0 AND p.passage IS NOT NULL
                   THEN strpos(p.passage, t.answer) - 1 ELSE -1 END AS INTEGER) AS start_index
  FROM TR t LEFT JOIN P p ON t.docid = p.docid),
LOC AS (SELECT *, CAST(start_index + coalesce(length(answer), 0) AS INTEGER) AS end_index FROM LOC0),
EX AS (SELECT id AS example_id, docid, passage, question, start_index AS start, end_index - 1 AS "end"
       FROM LOC WHERE start_index >= 0)
"""


def bm25(prefix, qtable):
    """Index + BM25 top-k for question table ``qtable(id, question)``."""
    return f"""
{prefix}DT AS (SELECT docid, {terms('raw')} AS terms FROM P),
{prefix}POST AS (SELECT term, docid, count(*) AS tf, any_value(dl) AS dl
                 FROM (SELECT docid, len(terms) AS dl, unnest(terms) AS term FROM {prefix}DT) GROUP BY term, docid),
{prefix}TS AS (SELECT term, count(*) AS df FROM {prefix}POST GROUP BY term),
{prefix}DS AS (SELECT docid, CAST(len(terms) AS BIGINT) AS dl FROM {prefix}DT),
{prefix}CS AS (SELECT count(*) AS n_docs, avg(dl) AS avgdl FROM {prefix}DS),
{prefix}QT AS (SELECT id, term, count(*) AS qtf FROM (SELECT id, unnest({terms('raw')}) AS term FROM {qtable})
               GROUP BY id, term),
{prefix}SC AS (
  SELECT q.id, p.docid,
         sum(q.qtf * ln(1.0 + (cs.n_docs - ts.df + 0.5) / (ts.df + 0.5))
             * (p.tf / (p.tf + 1.2 * (0.25 + 0.75 * p.dl / cs.avgdl)))) AS score
  FROM {prefix}QT q JOIN {prefix}TS ts USING (term) JOIN {prefix}POST p USING (term), {prefix}CS cs
  GROUP BY q.id, p.docid),
{prefix}HITS AS (
  SELECT id, docid, CAST(rank AS BIGINT) AS rank, score FROM (
    SELECT id, docid, round(score, 6) AS score,
           row_number() OVER (PARTITION BY id ORDER BY round(score, 6) DESC, docid ASC) AS rank
    FROM {prefix}SC) WHERE rank <= {K})
"""


def pack(prefix, doccap):
    """Greedy packing as a recursive CTE over ``doccap(docid, capacity, lens)``.

    State per sentence: (st, cur) of the open chunk; each step lists the
    chunks it emits; a final flush closes the open chunk after the last
    sentence.
    """
    flush = "{'doc_start': r.st, 'doc_end': r.st + r.cur - 1, 'is_window': false}"
    return f"""
{prefix}S AS (
  SELECT docid, capacity, sidx, len,
         CAST(sum(len) OVER (PARTITION BY docid, capacity ORDER BY sidx ROWS UNBOUNDED PRECEDING) - len AS BIGINT) AS pos
  FROM (SELECT docid, CAST(capacity AS BIGINT) AS capacity, CAST(unnest(lens) AS BIGINT) AS len,
               CAST(generate_subscripts(lens, 1) AS BIGINT) AS sidx FROM {doccap})),
{prefix}R AS (
  SELECT docid, CAST(capacity AS BIGINT) AS capacity, CAST(0 AS BIGINT) AS sidx, CAST(0 AS BIGINT) AS st,
         CAST(0 AS BIGINT) AS cur,
         CAST([] AS STRUCT(doc_start BIGINT, doc_end BIGINT, is_window BOOLEAN)[]) AS emitted
  FROM {doccap}
  UNION ALL
  SELECT s.docid, s.capacity, s.sidx,
    CASE WHEN s.len > s.capacity THEN r.st
         WHEN r.cur > 0 AND r.cur + s.len <= s.capacity THEN r.st
         ELSE s.pos END,
    CASE WHEN s.len > s.capacity THEN 0
         WHEN r.cur > 0 AND r.cur + s.len <= s.capacity THEN r.cur + s.len
         ELSE s.len END,
    CASE WHEN s.len > s.capacity THEN
           list_concat(CASE WHEN r.cur > 0 THEN [{flush}] ELSE [] END,
                       list_transform(range(0, s.len, s.capacity - {OVERLAP}),
                                      lambda o: {{'doc_start': s.pos + o,
                                                 'doc_end': s.pos + least(o + s.capacity - 1, s.len - 1),
                                                 'is_window': true}}))
         WHEN r.cur > 0 AND r.cur + s.len <= s.capacity THEN []
         WHEN r.cur > 0 THEN [{flush}]
         ELSE [] END
  FROM {prefix}R r JOIN {prefix}S s ON s.docid = r.docid AND s.capacity = r.capacity AND s.sidx = r.sidx + 1),
{prefix}LAST AS (SELECT docid, capacity, max(sidx) AS m FROM {prefix}S GROUP BY docid, capacity),
{prefix}CH0 AS (
  SELECT docid, capacity, unnest(emitted) AS c FROM {prefix}R
  UNION ALL
  SELECT r.docid, r.capacity, {flush} FROM {prefix}R r
  JOIN {prefix}LAST l ON r.docid = l.docid AND r.capacity = l.capacity AND r.sidx = l.m WHERE r.cur > 0),
{prefix}CH AS (
  SELECT docid, capacity,
         CAST(row_number() OVER (PARTITION BY docid, capacity ORDER BY c.doc_start) - 1 AS INTEGER) AS chunk_idx,
         CAST(c.doc_start AS INTEGER) AS doc_start, CAST(c.doc_end AS INTEGER) AS doc_end, c.is_window AS is_window
  FROM {prefix}CH0)
"""


VOCAB = f"""
VOCAB AS (
  SELECT * FROM (VALUES ('[PAD]', 0), ('[UNK]', 1), ('[CLS]', 2), ('[SEP]', 3), ('[MASK]', 4)) v(token, token_id)
  UNION ALL
  SELECT token, CAST(rank() OVER (ORDER BY token) + 4 AS INTEGER) AS token_id
  FROM (SELECT DISTINCT unnest({toks('passage')}) AS token FROM P)),
VMAP AS (SELECT map(list(token), list(token_id)) AS m FROM VOCAB)
"""

# Train / eval features: question length, capacity, answer token positions.
TRAIN_FEATS = f"""
EXQ AS (
  SELECT example_id, docid, passage, question, start, "end",
         CAST(least({ntok('question')}, {MAX_Q}) AS INTEGER) AS question_len,
         CAST({MAX_SEQ} - least({ntok('question')}, {MAX_Q}) - 3 AS INTEGER) AS capacity,
         CAST({o2t('passage', 'start')} AS INTEGER) AS token_start,
         CAST({o2t('passage', '"end"')} AS INTEGER) AS token_end
  FROM EX),
TRDC AS (SELECT x.docid, x.capacity, {lens('p.passage')} AS lens
         FROM (SELECT DISTINCT docid, capacity FROM EXQ) x JOIN P p USING (docid)),
{pack('TRK', 'TRDC')},
TRF0 AS (
  SELECT e.example_id, e.docid, e.start, e."end", e.question_len, e.capacity, e.token_start, e.token_end,
         c.chunk_idx, c.doc_start, c.doc_end, c.is_window,
         CAST(c.doc_end - c.doc_start AS INTEGER) AS doc_length,
         CAST(e.question_len + c.doc_end - c.doc_start + 3 AS INTEGER) AS bert_doc_end,
         (c.doc_start >= e.token_end OR c.doc_end <= e.token_start) AS unk,
         (c.doc_start <= e.token_start AND e.token_end <= c.doc_end) AS inside,
         e.question_len + 2 - c.doc_start AS off
  FROM EXQ e JOIN TRKCH c USING (docid, capacity)),
TRF AS (
  SELECT *,
    CAST(CASE WHEN unk THEN -1 WHEN inside THEN token_start + off
              ELSE greatest(token_start + off, question_len + 2) END AS INTEGER) AS bert_start_position,
    CAST(CASE WHEN unk THEN -1 WHEN inside THEN token_end + off
              ELSE least(token_end + off, doc_end + off) END AS INTEGER) AS bert_end_position,
    CASE WHEN unk THEN 'unknown' ELSE 'known' END AS label,
    CAST(CASE WHEN unk THEN 1 ELSE 0 END AS INTEGER) AS class_label
  FROM TRF0),
TRFL AS (SELECT *, CAST(bert_end_position - bert_start_position AS INTEGER) AS bert_answer_span FROM TRF)
"""

SAMPLE = f"""
SK AS (SELECT *, md5(concat_ws('_', '{SEED}', example_id, docid, chunk_idx)) AS k FROM TRFL),
HASK AS (SELECT DISTINCT example_id FROM SK WHERE label = 'known'),
PICK AS (SELECT example_id, arg_min(chunk_idx, k) AS chunk_idx, arg_min(docid, k) AS docid
         FROM SK WHERE label = 'unknown' GROUP BY example_id),
SEL AS (
  SELECT * FROM SK WHERE label = 'known'
  UNION ALL
  SELECT s.* FROM SK s JOIN PICK p USING (example_id, docid, chunk_idx)
  WHERE s.example_id IN (SELECT example_id FROM HASK))
"""

SPLIT = f"""
SPL AS (SELECT *, CASE WHEN substring(md5('{SEED}_split_' || CAST(example_id AS VARCHAR)), 1, 4) < '{DEV_THRESHOLD}'
                       THEN 'dev' ELSE 'train' END AS split FROM EX)
"""

# Test features from the benchmark hits.
TEST_FEATS = f"""
{bm25('', 'TQ')},
HQ AS (SELECT h.id, h.docid, h.rank, q.question FROM HITS h JOIN TQ q USING (id)),
TQL AS (SELECT id, docid, rank, question,
               CAST(least({ntok('question')}, {MAX_Q}) AS INTEGER) AS question_len,
               CAST({MAX_SEQ} - least({ntok('question')}, {MAX_Q}) - 3 AS INTEGER) AS capacity FROM HQ),
TEDC AS (SELECT x.docid, x.capacity, {lens('p.passage')} AS lens
         FROM (SELECT DISTINCT docid, capacity FROM TQL) x JOIN P p USING (docid)),
{pack('TEK', 'TEDC')},
TF AS (
  SELECT t.id AS example_id, t.docid, t.rank, t.question, t.question_len, t.capacity,
         c.chunk_idx, c.doc_start, c.doc_end, c.is_window,
         CAST(t.question_len + c.doc_end - c.doc_start + 3 AS INTEGER) AS bert_doc_end
  FROM TQL t JOIN TEKCH c USING (docid, capacity))
"""


def logits(src, name, class_join=False):
    def arr(a, b, c, d):
        return (f"list_transform(range({MAX_SEQ}), lambda i: CASE WHEN f.example_id % 10 = 0 AND i = 0 "
                f"THEN CAST(10.0 AS FLOAT) ELSE CAST(((f.example_id * {a} + f.docid * {b} + f.chunk_idx * {c} "
                f"+ i * {d}) % 1000) / 100.0 - 5.0 AS FLOAT) END)")
    cl = ("coalesce(l.cl, [CAST(0.0 AS FLOAT), CAST(0.0 AS FLOAT)])" if class_join
          else "[CAST(0.0 AS FLOAT), CAST(0.0 AS FLOAT)]")
    join = ("LEFT JOIN (SELECT doc_id AS docid, [CAST(quality AS FLOAT), CAST(1 - quality AS FLOAT)] AS cl "
            "FROM labels) l ON l.docid = f.docid" if class_join else "")
    return f"""
{name} AS (
  SELECT f.*, {arr(7919, 6007, 104729, 613)} AS sl, {arr(15485863, 7507, 32452843, 997)} AS el, {cl} AS cl
  FROM {src} f {join})
"""


def topk(x):
    return f"list_transform(list_sort(list_transform({x}, lambda v, i: {{'nv': -v, 'i': i - 1}}))[1:10], lambda z: z.i)"


def cands(name, src):
    valid = ("e - s >= 1 AND s >= question_len + 2 AND s < bert_doc_end - 1 "
             "AND e > question_len + 2 AND e <= bert_doc_end - 1")
    return f"""
{name} AS (
  SELECT *, flatten(list_transform(st, lambda s: list_transform(et, lambda e:
      {{'s': s, 'e': e,
       'score': CASE WHEN {valid} THEN CAST((sl[s + 1] + el[e + 1]) - (sl[1] + el[1]) AS FLOAT)
                     ELSE CAST(-1000.0 AS FLOAT) END}}))) AS cands
  FROM (SELECT *, {topk('sl')} AS st, {topk('el')} AS et FROM {src}))
"""


def best_chunk(name, src):
    return f"""
{name} AS (
  SELECT *, b.score AS best_score, b.s AS best_start, b.e AS best_end FROM (
    SELECT *, list_max(list_transform(cands, lambda c, j: {{'score': c.score, 'neg': -j, 's': c.s, 'e': c.e}})) AS b
    FROM {src}))
"""


def winners(name, src, order):
    neg = ", ".join(f"'n_{o}': -{o}" for o in order)
    okey = " * 100000 + ".join(order)
    return f"""
{name} AS (
  SELECT example_id,
         max(CASE WHEN best_score > 0 THEN {{'score': best_score, {neg}, 'docid': docid, 'chunk_idx': chunk_idx,
             'doc_start': doc_start, 'question_len': question_len, 'best_start': best_start, 'best_end': best_end}}
             END) AS best,
         arg_max(docid, {okey}) AS last_docid
  FROM {src} GROUP BY example_id)
"""


def span_text(name, src):
    return f"""
{name}0 AS (
  SELECT w.example_id, w.best.docid AS docid,
         w.best.doc_start + w.best.best_start - w.best.question_len - 2 AS tok_start,
         w.best.doc_start + w.best.best_end - w.best.question_len - 2 AS tok_end, p.passage
  FROM {src} w JOIN P p ON p.docid = w.best.docid WHERE w.best IS NOT NULL),
{name} AS (
  SELECT example_id, docid, char_start, char_end,
         substring(passage, char_start + 1, char_end - char_start + 1) AS answer
  FROM (SELECT *, CAST({t2o_list('passage')}[tok_start + 1] AS INTEGER) AS char_start,
               CAST({t2o_list('passage')}[tok_end + 1] AS INTEGER) AS char_end FROM {name}0))
"""


TEST_DECODE = f"""
{TEST_FEATS},
{logits('TF', 'TL')},
{cands('TC', 'TL')},
{best_chunk('TB', 'TC')},
{winners('TW', 'TB', ['rank', 'chunk_idx'])},
{span_text('TSPAN', 'TW')},
PRED AS (
  SELECT w.example_id AS id, coalesce(s.docid, w.last_docid) AS docid, coalesce(s.answer, '疫情') AS answer
  FROM TW w LEFT JOIN TSPAN s USING (example_id))
"""

EVAL_DECODE = f"""
{TRAIN_FEATS},
{SPLIT},
DEVF AS (SELECT f.* FROM TRFL f JOIN SPL s USING (example_id) WHERE s.split = 'dev'),
{logits('DEVF', 'EL', class_join=True)},
{cands('EC', 'EL')},
{best_chunk('EB', 'EC')},
{winners('EW', 'EB', ['chunk_idx'])},
{span_text('ES', 'EW')},
EPRED AS (
  SELECT w.example_id, coalesce(s.answer, '疫情') AS prediction,
         substring(x.passage, x.start + 1, x."end" - x.start + 1) AS label
  FROM EW w LEFT JOIN ES s USING (example_id) JOIN EX x USING (example_id))
"""

INDEX_ROWS = "SELECT p.term, p.docid, p.tf, p.dl, t.df, d.dl AS doc_dl FROM POST p JOIN TS t USING (term) JOIN DS d USING (docid)"

# Rank of the selected training rows in the seeded order.
RANKED = f"""
SB AS (SELECT example_id, docid, chunk_idx,
              CAST(row_number() OVER (ORDER BY md5(concat_ws('_', '{SEED}', 'order', example_id, docid,
                   chunk_idx)), example_id, docid, chunk_idx) - 1 AS BIGINT) AS order_rank FROM SEL)
"""

ENCODED = f"""
        ENC0 AS (
          SELECT f.*, list_transform({toks('f.question')}[1:{MAX_Q}], lambda t: coalesce(v.m[t], 1)) AS qids,
                 list_transform({toks('p.passage')}[f.doc_start + 1:f.doc_end + 1],
                                lambda t: coalesce(v.m[t], 1)) AS cids
          FROM TF f JOIN P p USING (docid), VMAP v),
        ENC AS (
          SELECT *, list_concat([2], qids, [3], cids, [3]) AS ids0,
                 list_concat(list_transform(range(question_len + 2), lambda i: 0),
                             list_transform(range(len(cids) + 1), lambda i: 1)) AS seg0
          FROM ENC0)"""

# The dev features scored once more with start and end logits swapped.
SWAPPED = f"""
EL2 AS (SELECT * REPLACE (el AS sl, sl AS el) FROM EL),
{cands('EC2', 'EL2')},
{best_chunk('EB2', 'EC2')},
{winners('EW2', 'EB2', ['chunk_idx'])},
{span_text('ES2', 'EW2')},
EPRED2 AS (
  SELECT w.example_id, coalesce(s.answer, '疫情') AS prediction,
         substring(x.passage, x.start + 1, x."end" - x.start + 1) AS label
  FROM EW2 w LEFT JOIN ES2 s USING (example_id) JOIN EX x USING (example_id))
"""


def rouge(name, src):
    """ROUGE-L F of ``src(example_id, prediction, label)``. The longest common
    subsequence grows by label character: ``t[v]`` is the first place in the
    prediction by which a common subsequence of length v ends."""
    return f"""
{name}0 AS (
  SELECT example_id, string_split(p, '') AS p, string_split(r, '') AS r, length(p) AS np, length(r) AS nr
  FROM (SELECT example_id, regexp_replace(coalesce(prediction, ''), '\\s', '', 'g') AS p,
               regexp_replace(coalesce(label, ''), '\\s', '', 'g') AS r FROM {src})),
{name}1 AS (
  SELECT *, CASE WHEN np = 0 OR nr = 0 THEN 0 ELSE len(list_reduce(
    list_concat([[]::BIGINT[]], list_transform(r, lambda c: list_filter(list_transform(range(1, np + 1),
      lambda i: CASE WHEN p[i] = c THEN i END), lambda i: i IS NOT NULL))),
    lambda t, m: list_filter(list_transform(range(1, len(t) + 2), lambda v: list_min(list_concat(
      CASE WHEN v <= len(t) THEN [t[v]] ELSE []::BIGINT[] END,
      list_filter(m, lambda i: i > coalesce(t[v - 1], 0))))), lambda x: x IS NOT NULL))) END AS lcs
  FROM {name}0),
{name} AS (
  SELECT example_id, CASE WHEN lcs = 0 THEN 0.0 ELSE 2 * (lcs / np) * (lcs / nr) / (lcs / np + lcs / nr) END AS f
  FROM {name}1)
"""


EVENTS = """
EL AS (SELECT event_type AS run, CASE WHEN event_id % 2 = 0 THEN 'dev.csv' ELSE 'train.csv' END AS file,
              event_id AS global_step, value AS loss, value / 500.0 AS eval_accuracy FROM events)
"""


def q(*ctes, body):
    return "WITH RECURSIVE " + ",\n".join(c.strip() for c in ctes) + "\n" + body


def lse(x):
    return (f"(list_max({x}) + ln(list_reduce(list_transform({x}, lambda v: exp(v - list_max({x}))), "
            f"lambda a, b: a + b)))")


def loss(src):
    return f"""
        SELECT sl_ AS start_loss, el_ AS end_loss, cl_ AS class_loss, sl_ + el_ + 2.0 * cl_ AS loss
        FROM (SELECT avg(CASE WHEN bert_start_position >= 0
                              THEN {lse('sl')} - CAST(sl[bert_start_position + 1] AS DOUBLE) END) AS sl_,
                     avg(CASE WHEN bert_end_position >= 0
                              THEN {lse('el')} - CAST(el[bert_end_position + 1] AS DOUBLE) END) AS el_,
                     avg({lse('cl')} - CAST(cl[class_label + 1] AS DOUBLE)) AS cl_
              FROM {src})"""


def _md5_join(x):
    return f"md5(array_to_string({x}, ' '))"


ORACLE: dict[str, str] = {
    "clean_passages": q(BASE, body="SELECT docid, passage, CAST(length(passage) AS BIGINT) AS n_chars FROM P"),
    "clean_questions": q(BASE, body="SELECT 'benchmark' AS qset, id, question FROM TQ "
                                    "UNION ALL SELECT 'conversation', id, question FROM CQ"),
    "analyze_terms": q(BASE, bm25('', 'TQ'), body="SELECT id, term, qtf FROM QT"),
    "build_postings": q(BASE, bm25('', 'TQ'), body="SELECT term, docid, tf, dl FROM POST"),
    "term_stats": q(BASE, bm25('', 'TQ'), body="SELECT term, df FROM TS"),
    "doc_stats": q(BASE, bm25('', 'TQ'), body="SELECT docid, dl FROM DS"),
    "corpus_stats": q(BASE, bm25('', 'TQ'), body=(
        "SELECT n_docs, round(avgdl, 6) AS avgdl, (SELECT count(*) FROM TS) AS n_terms, "
        "(SELECT count(*) FROM POST) AS n_postings FROM CS")),
    "bm25_topk": q(BASE, bm25('', 'TQ'), body="SELECT id, docid, rank, score FROM HITS"),
    "bm25_topk_conversations": q(BASE, bm25('', 'CQ'), body="SELECT id, docid, rank, score FROM HITS"),
    "retrieve_pairs": q(BASE, bm25('', 'TQ'), body=(
        "SELECT h.id, h.docid, h.rank, q.question, CAST(length(p.passage) AS BIGINT) AS passage_len "
        "FROM HITS h JOIN TQ q USING (id) JOIN P p USING (docid)")),
    "recall_at_k": q(BASE, "XQ AS (SELECT id, question AS raw FROM TRAW WHERE id IN (SELECT example_id FROM EX))", bm25('', 'XQ'), body=f"""
        SELECT CAST({K} AS BIGINT) AS k, count(*) AS n_questions, CAST(sum(hit) AS BIGINT) AS n_hits,
               round(avg(hit), 6) AS recall
        FROM (SELECT e.example_id,
                     max(CASE WHEN h.docid IS NOT NULL THEN 1 ELSE 0 END) AS hit
              FROM EX e LEFT JOIN HITS h ON h.id = e.example_id AND h.docid = e.docid GROUP BY e.example_id)"""),
    "contains_at_k": q(BASE, bm25('', 'TQ'), body=f"""
        SELECT CAST({K} AS BIGINT) AS k, count(*) AS n_questions, CAST(sum(coalesce(hit, 0)) AS BIGINT) AS n_hits
        FROM TQ LEFT JOIN (
          SELECT h.id, max(CASE WHEN strpos(p.passage, q.question) > 0 THEN 1 ELSE 0 END) AS hit
          FROM HITS h JOIN TQ q USING (id) JOIN P p USING (docid) GROUP BY h.id) x USING (id)"""),
    "locate_answer": q(BASE, body="SELECT id, docid, question, answer, start_index, end_index FROM LOC"),
    "answerable_train": q(BASE, body=(
        "SELECT id, docid, question, answer, start_index, end_index FROM LOC WHERE start_index >= 0")),
    "rejected_train": q(BASE, body="""
        SELECT id, docid, answer,
               CASE WHEN passage IS NULL THEN 'missing_docid'
                    WHEN answer IS NULL OR length(answer) = 0 THEN 'empty_answer'
                    ELSE 'answer_not_in_passage' END AS reason
        FROM LOC WHERE start_index < 0"""),
    "qa_examples": q(BASE, TRAIN_FEATS, body=(
        'SELECT example_id, docid, question, start, "end", token_start, token_end, '
        'substring(passage, start + 1, "end" - start + 1) AS gold, CAST(length(passage) AS BIGINT) AS passage_len FROM EXQ')),
    "missing_docids": q(BASE, body="SELECT id, docid FROM TRAW WHERE docid NOT IN (SELECT docid FROM P)"),
    "char_tokens": q(BASE, body=(
        f"SELECT docid, CAST({ntok('passage')} AS BIGINT) AS n_tokens, "
        f"array_to_string({toks('passage')}, ' ') AS tokens FROM P")),
    "question_tokens": q(BASE, body=(
        f"SELECT id, CAST(least({ntok('question')}, {MAX_Q}) AS BIGINT) AS question_len, "
        f"CAST({ntok('question')} AS BIGINT) AS n_tokens_full, "
        f"array_to_string({toks('question')}[1:{MAX_Q}], ' ') AS tokens FROM TQ")),
    "offset_map": q(BASE, f"""
        CH AS (SELECT docid, unnest(string_split(passage, '')) AS ch,
                      generate_subscripts(string_split(passage, ''), 1) AS pos FROM P WHERE passage <> ''),
        BEF AS (SELECT docid, pos, coalesce(sum(CASE WHEN regexp_matches(ch, '^{ZERO}$') THEN 0 ELSE 1 END) OVER (
                         PARTITION BY docid ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
                FROM CH),
        MAPS AS (SELECT docid, string_agg(CAST(before AS VARCHAR), ',' ORDER BY pos) AS m FROM BEF GROUP BY docid)""",
                    body="""
        SELECT p.docid, CAST(length(p.passage) AS BIGINT) AS n_chars, md5(coalesce(m.m, '')) AS map_md5
        FROM P p LEFT JOIN MAPS m ON p.docid = m.docid"""),
    "token_to_char": q(BASE, body=(
        f"SELECT docid, CAST(len({t2o_list('passage')}) AS BIGINT) AS n_tokens, "
        f"md5(array_to_string({t2o_list('passage')}, ',')) AS map_md5 FROM P")),
    "vocab": q(BASE, VOCAB, body="SELECT token, CAST(token_id AS BIGINT) AS token_id FROM VOCAB"),
    "token_ids": q(BASE, VOCAB, body=f"""
        SELECT docid, CAST(len(ids) AS BIGINT) AS n_ids, {_md5_join('ids')} AS ids_md5,
               CAST(coalesce(list_sum(ids), 0) AS BIGINT) AS ids_sum
        FROM (SELECT docid, list_transform({toks('passage')}, lambda t: coalesce(v.m[t], 1)) AS ids
              FROM P, VMAP v)"""),
    "split_sentences": q(BASE, body=f"""
        SELECT docid, sent_idx, CAST(sent_end - sent_len + 1 AS INTEGER) AS sent_start,
               CAST(sent_end AS INTEGER) AS sent_end, sent_len
        FROM (SELECT docid, sent_idx, sent_len,
                     sum(sent_len) OVER (PARTITION BY docid ORDER BY sent_idx ROWS UNBOUNDED PRECEDING) - 1 AS sent_end
              FROM (SELECT docid, CAST(unnest(l) AS INTEGER) AS sent_len,
                           CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS sent_idx
                    FROM (SELECT docid, {lens('passage')} AS l FROM P)))"""),
    "pack_chunks": q(BASE, f"PKD AS (SELECT docid, {CAPACITY} AS capacity, {lens('passage')} AS lens FROM P)",
                     pack('PK', 'PKD'),
                     body="SELECT docid, capacity, chunk_idx, doc_start, doc_end, is_window FROM PKCH"),
    "sliding_windows": q(BASE, f"PKD AS (SELECT docid, {CAPACITY} AS capacity, {lens('passage')} AS lens FROM P)",
                         pack('PK', 'PKD'),
                         body="SELECT docid, capacity, chunk_idx, doc_start, doc_end, is_window FROM PKCH "
                              "WHERE is_window"),
    "explode_chunks": q(BASE, TEST_FEATS, body=(
        "SELECT example_id AS id, docid, rank, CAST(capacity AS BIGINT) AS capacity, chunk_idx, doc_start, doc_end, "
        "is_window, question_len, bert_doc_end FROM TF")),
    "label_chunks": q(BASE, TRAIN_FEATS, body=(
        "SELECT example_id, docid, chunk_idx, doc_start, doc_end, doc_length, question_len, token_start, token_end, "
        "bert_start_position, bert_end_position, bert_answer_span, label FROM TRFL")),
    "class_labels": q(BASE, TRAIN_FEATS, body="SELECT example_id, chunk_idx, label, class_label FROM TRFL"),
    "encode_inputs": q(BASE, VOCAB, TEST_FEATS, ENCODED, body=f"""
        SELECT example_id AS id, docid, rank, chunk_idx, bert_doc_end, CAST(len(ids0) AS BIGINT) AS n_used,
               CAST({MAX_SEQ} AS BIGINT) AS seq_len,
               {_md5_join(f"list_concat(ids0, list_transform(range({MAX_SEQ} - len(ids0)), lambda i: 0))")} AS ids_md5,
               {_md5_join(f"list_concat(list_transform(range(len(ids0)), lambda i: 1), "
                          f"list_transform(range({MAX_SEQ} - len(ids0)), lambda i: 0))")} AS mask_md5,
               {_md5_join(f"list_concat(seg0, list_transform(range({MAX_SEQ} - len(seg0)), lambda i: 0))")} AS seg_md5
        FROM ENC"""),
    "eval_features": q(BASE, TRAIN_FEATS, SPLIT, body="""
        SELECT f.example_id, f.doc_start, f.question_len, f.docid, f.chunk_idx, f.bert_doc_end,
               f.bert_start_position, f.bert_end_position, f.bert_answer_span, f.label, f.start, f."end"
        FROM TRFL f JOIN SPL s USING (example_id) WHERE s.split = 'dev'"""),
    "sample_training": q(BASE, TRAIN_FEATS, SAMPLE, body="SELECT example_id, docid, chunk_idx, label FROM SEL"),
    "sampling_stats": q(BASE, TRAIN_FEATS, body="""
        SELECT CAST(count(*) FILTER (WHERE nk = 1) AS BIGINT) AS single_answer,
               CAST(count(*) FILTER (WHERE nk > 1) AS BIGINT) AS multi_answer,
               CAST(count(*) FILTER (WHERE nk >= 1 AND nu > 0) AS BIGINT) AS has_unknown_sample,
               CAST(count(*) FILTER (WHERE nk = 0) AS BIGINT) AS no_known,
               CAST(sum(CASE WHEN nk >= 1 THEN nk + least(nu, 1) ELSE 0 END) AS BIGINT) AS n_selected
        FROM (SELECT example_id, count(*) FILTER (WHERE label = 'known') AS nk,
                     count(*) FILTER (WHERE label = 'unknown') AS nu FROM TRFL GROUP BY example_id)"""),
    "no_known_examples": q(BASE, TRAIN_FEATS, body="""
        SELECT example_id, CAST(count(*) AS BIGINT) AS n_chunks FROM TRFL GROUP BY example_id
        HAVING count(*) FILTER (WHERE label = 'known') = 0"""),
    "train_dev_split": q(BASE, SPLIT, body="SELECT example_id, split FROM SPL"),
    "union_splits": q(BASE, TRAIN_FEATS, SAMPLE, SPLIT, body="""
        SELECT 'train' AS split, s.example_id, s.docid, s.chunk_idx, s.label
        FROM SEL s JOIN SPL p USING (example_id) WHERE p.split = 'train'
        UNION ALL
        SELECT 'dev', f.example_id, f.docid, f.chunk_idx, f.label
        FROM TRFL f JOIN SPL p USING (example_id) WHERE p.split = 'dev'"""),
    "shuffle_batches": q(BASE, TRAIN_FEATS, SAMPLE, f"""
        SB AS (SELECT example_id, docid, chunk_idx,
                      CAST(row_number() OVER (ORDER BY md5(concat_ws('_', '{SEED}', 'order', example_id, docid,
                           chunk_idx)), example_id, docid, chunk_idx) - 1 AS BIGINT) AS order_rank FROM SEL)""",
                         body=f"SELECT *, CAST(floor(order_rank / {BATCH}) AS BIGINT) AS batch_id FROM SB"),
    "step_batches": q(BASE, TRAIN_FEATS, SAMPLE, f"""
        SB AS (SELECT example_id, docid, chunk_idx,
                      CAST(floor((row_number() OVER (ORDER BY md5(concat_ws('_', '{SEED}', 'order', example_id,
                      docid, chunk_idx)), example_id, docid, chunk_idx) - 1) / {BATCH}) AS BIGINT) AS batch_id
               FROM SEL)""", body=f"""
        SELECT s.step, b.batch_id, b.example_id, b.docid, b.chunk_idx
        FROM (SELECT range AS step FROM range({TRAIN_STEPS})) s
        JOIN SB b ON b.batch_id = s.step % (SELECT max(batch_id) + 1 FROM SB)"""),
    "feature_order": q(BASE, TEST_FEATS, body="""
        SELECT example_id AS id, docid, rank, chunk_idx,
               CAST(row_number() OVER (PARTITION BY example_id ORDER BY rank, chunk_idx) - 1 AS BIGINT) AS feature_ord
        FROM TF"""),
    "pseudo_logits": q(BASE, TEST_FEATS, logits('TF', 'TL'), body="""
        SELECT example_id AS id, docid, chunk_idx,
               round(list_reduce(list_transform(sl, lambda x: CAST(x AS DOUBLE)), lambda a, b: a + b), 3) AS start_sum,
               round(list_reduce(list_transform(el, lambda x: CAST(x AS DOUBLE)), lambda a, b: a + b), 3) AS end_sum,
               CAST(sl[1] AS DOUBLE) AS start0, CAST(el[2] AS DOUBLE) AS end1
        FROM TL"""),
    "topk_positions": q(BASE, TEST_FEATS, logits('TF', 'TL'), body=f"""
        SELECT example_id AS id, docid, chunk_idx, array_to_string({topk('sl')}, ',') AS start_top,
               array_to_string({topk('el')}, ',') AS end_top FROM TL"""),
    "valid_spans": q(BASE, TEST_FEATS, logits('TF', 'TL'), cands('TC', 'TL'), body="""
        SELECT example_id AS id, docid, chunk_idx,
               CAST(len(list_filter(cands, lambda c: c.score > -1000.0)) AS BIGINT) AS n_valid FROM TC"""),
    "span_candidates": q(BASE, TEST_FEATS, logits('TF', 'TL'), cands('TC', 'TL'), body="""
        SELECT id, docid, chunk_idx, cand_idx, c.s AS s, c.e AS e, round(CAST(c.score AS DOUBLE), 6) AS score
        FROM (SELECT example_id AS id, docid, chunk_idx, unnest(cands) AS c,
                     CAST(generate_subscripts(cands, 1) - 1 AS BIGINT) AS cand_idx FROM TC)"""),
    "best_span_per_chunk": q(BASE, TEST_FEATS, logits('TF', 'TL'), cands('TC', 'TL'), best_chunk('TB', 'TC'),
                             body="""
        SELECT example_id AS id, docid, chunk_idx, best_start, best_end,
               round(CAST(best_score AS DOUBLE), 6) AS best_score FROM TB"""),
    "best_span_per_question": q(BASE, TEST_DECODE, body="""
        SELECT example_id AS id, best.docid AS docid, best.chunk_idx AS chunk_idx, best.best_start AS best_start,
               best.best_end AS best_end, round(CAST(best.score AS DOUBLE), 6) AS score
        FROM TW WHERE best IS NOT NULL"""),
    "unanswered": q(BASE, TEST_DECODE, body="SELECT example_id AS id, last_docid AS docid FROM TW WHERE best IS NULL"),
    "span_text": q(BASE, TEST_DECODE, body="SELECT example_id AS id, docid, char_start, char_end, answer FROM TSPAN"),
    "predict_test": q(BASE, TEST_DECODE, body="SELECT id, docid, answer FROM PRED"),
    "predictions_tsv_roundtrip": q(BASE, TEST_DECODE, body=(
        "SELECT id, docid, answer FROM PRED")),
    "predict_eval": q(BASE, EVAL_DECODE, body="SELECT example_id, prediction, label FROM EPRED"),
    "prediction_counts": q(BASE, TEST_DECODE, body="""
        SELECT count(*) AS n_examples, count(*) FILTER (WHERE best IS NOT NULL) AS n_known,
               count(*) FILTER (WHERE best IS NULL) AS n_unknown FROM TW"""),
    "stage_counts": q(BASE, TEST_DECODE, TRAIN_FEATS, SAMPLE, body="""
        SELECT 'questions' AS stage, count(*) AS n FROM TQ
        UNION ALL SELECT 'retrieved_pairs', count(*) FROM HITS
        UNION ALL SELECT 'test_features', count(*) FROM TF
        UNION ALL SELECT 'answered', count(*) FROM TW WHERE best IS NOT NULL
        UNION ALL SELECT 'train_examples', count(*) FROM EX
        UNION ALL SELECT 'train_features', count(*) FROM TRFL
        UNION ALL SELECT 'selected_features', count(*) FROM SEL"""),
    "qa_loss": q(BASE, TRAIN_FEATS, SPLIT,
                 "DEVF AS (SELECT f.* FROM TRFL f JOIN SPL s USING (example_id) WHERE s.split = 'dev')",
                 logits('DEVF', 'EL', class_join=True), body=f"""
        SELECT round(start_loss, 6) AS start_loss, round(end_loss, 6) AS end_loss, round(class_loss, 6) AS class_loss,
               round(loss, 6) AS loss FROM ({loss('EL')})"""),
    "running_loss": q("LL AS (SELECT event_id AS step, value AS loss FROM events)", body="""
        SELECT step, loss,
               CAST(round(CAST(CAST(list_reduce(w, lambda a, b: a + b) / len(w) AS VARCHAR) AS DECIMAL(38, 18)), 4)
                    AS DOUBLE) AS running_loss,
               CAST(round(CAST(CAST(list_reduce(w4, lambda a, b: a + b) / len(w4) AS VARCHAR) AS DECIMAL(38, 18)), 4)
                    AS DOUBLE) AS running_loss_4
        FROM (SELECT step, loss, list(loss) OVER (PARTITION BY floor(step / 50) ORDER BY step
                                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS w,
                     list(loss) OVER (PARTITION BY floor(step / 200) ORDER BY step
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS w4 FROM LL)"""),
    "eval_log": q(EVENTS, body="SELECT run, file, global_step, loss, eval_accuracy FROM EL"),
    "best_eval_run": q(EVENTS, body="""
        SELECT run, global_step, eval_accuracy, loss FROM (
          SELECT *, row_number() OVER (PARTITION BY run ORDER BY eval_accuracy DESC, global_step ASC) AS rn
          FROM EL WHERE file = 'dev.csv' AND eval_accuracy > 0) WHERE rn = 1"""),
    "csv_roundtrip": q(BASE, body="SELECT docid, passage FROM P"),
    "tsv_roundtrip": q(BASE, body="SELECT id, docid, question, answer FROM TRAW"),
    "train_clean_roundtrip": q(BASE, body=(
        "SELECT id, docid, question, answer, start_index, end_index FROM LOC WHERE start_index >= 0")),
    "test_file_roundtrip": q(BASE, body="SELECT id, question FROM TQ"),
    "dedup_passages": "SELECT doc_id AS docid, text AS passage FROM documents",
    "index_roundtrip": q(BASE, bm25('', 'TQ'), body=INDEX_ROWS),
    "index_append": q(BASE, bm25('', 'TQ'), body=INDEX_ROWS),
    "index_merge": q(BASE, bm25('', 'TQ'), body=INDEX_ROWS),
    "bm25_topk_appended": q(BASE, bm25('', 'TQ'), body="SELECT id, docid, rank, score FROM HITS"),
    "sub_token_maps": q(BASE, f"""
        CH AS (SELECT docid, ch, pos, CAST({nbytes('ch')} AS INTEGER) AS n
               FROM (SELECT docid, unnest(string_split(passage, '')) AS ch,
                            generate_subscripts(string_split(passage, ''), 1) AS pos FROM P WHERE passage <> '')),
        BEF AS (SELECT *, CAST(sum(n) OVER (PARTITION BY docid ORDER BY pos) - n AS BIGINT) AS before FROM CH),
        MAPS AS (SELECT docid, CAST(sum(n) AS BIGINT) AS n_tokens, string_agg(CAST(before AS VARCHAR), ',' ORDER BY pos) AS there,
                        string_agg(array_to_string(list_transform(range(n), lambda x: pos - 1), ','), ',' ORDER BY pos)
                          FILTER (WHERE n > 0) AS back
                 FROM BEF GROUP BY docid)""", body="""
        SELECT p.docid, coalesce(m.n_tokens, 0) AS n_tokens, md5(coalesce(m.there, '')) AS token_md5, md5(coalesce(m.back, '')) AS char_md5
        FROM P p LEFT JOIN MAPS m ON p.docid = m.docid"""),
    "sub_token_spans": q(BASE, f"""
        SP AS (SELECT example_id, docid, passage, CAST({nbytes('substring(passage, 1, start)')} AS INTEGER) AS token_start,
                      CAST({nbytes('substring(passage, 1, "end")')} AS INTEGER) AS token_end,
                      flatten(list_transform(string_split(passage, ''), lambda ch, i: list_transform(range({nbytes('ch')}), lambda x: i - 1))) AS m
               FROM EX),
        PLACES AS (SELECT *, CAST(m[token_start + 1] AS INTEGER) AS char_start, CAST(m[token_end + 1] AS INTEGER) AS char_end FROM SP)""", body="""
        SELECT example_id, docid, token_start, token_end, char_start, char_end,
               substring(passage, char_start + 1, char_end - char_start + 1) AS answer FROM PLACES"""),
    "sub_token_chunks": q(BASE, f"""
        DC AS (SELECT docid, {CAPACITY} AS capacity,
                      list_filter(list_transform(regexp_extract_all(passage, '{SENT}'), lambda s: CAST({nbytes('s')} AS BIGINT)), lambda n: n > 0) AS lens
               FROM P)""", pack('BY', 'DC'), body="SELECT docid, chunk_idx, doc_start, doc_end, is_window FROM BYCH"),
    "export_shards": q(BASE, TRAIN_FEATS, SAMPLE, RANKED, body=f"""
        SELECT *, CAST(floor(order_rank / {BATCH}) AS BIGINT) AS batch_id, CAST(floor(order_rank / {SHARD_ROWS}) AS BIGINT) AS shard,
               order_rank % {SHARD_ROWS} AS place FROM SB"""),
    "export_manifest": q(BASE, TRAIN_FEATS, SAMPLE, RANKED, body=f"""
        SELECT CAST(floor(order_rank / {SHARD_ROWS}) AS BIGINT) AS shard, count(*) AS n_rows, min(order_rank) AS first_rank,
               max(order_rank) AS last_rank FROM SB GROUP BY 1"""),
    "stream_predictions": q(BASE, TEST_DECODE, body="SELECT id, docid, answer FROM PRED"),
    "bm25_topk_stored": q(BASE, bm25('', 'TQ'), body="SELECT id, docid, rank, score FROM HITS"),
    "train_features": q(BASE, TRAIN_FEATS, body="""
        SELECT example_id, doc_start, question_len, docid, chunk_idx, doc_end, doc_length, bert_start_position,
               bert_end_position, bert_answer_span, label, token_start, token_end FROM TRFL"""),
    "test_features": q(BASE, TEST_FEATS, body=(
        "SELECT example_id, doc_start, question_len, docid, chunk_idx, bert_doc_end, rank FROM TF")),
    "score_model": q(BASE, VOCAB, TEST_FEATS, ENCODED, body="""
        SELECT example_id AS id, docid, chunk_idx,
               round(list_sum(list_transform(ids0, lambda x, i: CAST(CAST((x * 31 + (i - 1) * 17) % 1000 / 100.0 - 5.0 AS FLOAT) AS DOUBLE))), 2)
                 AS start_sum,
               round(list_sum(list_transform(ids0, lambda x, i: CAST(CAST((x * 57 + (i - 1) * 29 + seg0[i]) % 1000 / 100.0 - 5.0 AS FLOAT) AS DOUBLE))), 2)
                 AS end_sum,
               CAST(len(ids0) % 7 AS DOUBLE) AS class0, CAST(list_sum(ids0) % 11 AS DOUBLE) AS class1
        FROM ENC"""),
    "rouge_l": q(BASE, EVAL_DECODE, rouge('RG', 'EPRED'), body="SELECT example_id, round(f, 6) AS rouge_l_f FROM RG"),
    "rouge_l_mean": q(BASE, EVAL_DECODE, rouge('RG', 'EPRED'), body="SELECT count(*) AS n, round(avg(f), 6) AS rouge_l_mean FROM RG"),
    "eval_chain": q(BASE, EVAL_DECODE, SWAPPED, rouge('RG', 'EPRED'), rouge('RG2', 'EPRED2'), f"""
        LOG AS (SELECT 50 AS global_step, (SELECT loss FROM ({loss('EL')})) AS loss, (SELECT avg(f) FROM RG) AS acc
                UNION ALL SELECT 100, (SELECT loss FROM ({loss('EL2')})), (SELECT avg(f) FROM RG2))""", body="""
        SELECT 'run' AS run, 'dev.csv' AS file, CAST(global_step AS BIGINT) AS global_step, round(loss, 6) AS loss,
               round(acc, 6) AS eval_accuracy FROM LOG"""),
    "best_eval_predictions": q(BASE, EVAL_DECODE, SWAPPED, rouge('RG', 'EPRED'), rouge('RG2', 'EPRED2'), body="""
        SELECT 'run' AS run, example_id, prediction, label
        FROM (SELECT *, 50 AS step FROM EPRED UNION ALL SELECT *, 100 FROM EPRED2)
        WHERE step = (SELECT CASE WHEN (SELECT avg(f) FROM RG2) > (SELECT avg(f) FROM RG) THEN 100 ELSE 50 END)"""),
}
