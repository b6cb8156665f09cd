"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

from corpusqa.llm import chat_format, decontaminate, line_dedup, mixing, vector_codes

_LINE = "trim(regexp_replace(line, '[ \\t\\r\\f]+', ' ', 'g'))"

LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM documents WHERE text IS NOT NULL
), tokens AS (
  SELECT doc_id, pos, list_transform(string_split({_LINE}, ' '), lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '{line_dedup.FIELD}' ELSE x END) AS tok
  FROM lines WHERE {_LINE} <> ''
), placed AS (
  SELECT doc_id, pos, tok, len(tok) AS n, tok[1:{line_dedup.LEAD}] AS lead FROM tokens
  WHERE len(list_filter(tok, lambda x: x <> '{line_dedup.FIELD}')) > 0
), rest AS (
  SELECT doc_id, pos, n, lead, unnest(tok[{line_dedup.LEAD} + 1:]) AS token, unnest(range(n - {line_dedup.LEAD})) AS i FROM placed WHERE n > {line_dedup.LEAD}
), constant AS (
  SELECT n, lead, i, token FROM rest GROUP BY ALL HAVING count(DISTINCT doc_id) >= {line_dedup.MIN_DOCS}
), fields AS (
  SELECT r.doc_id, r.pos, count(c.token) AS same, list(c.token ORDER BY r.i) AS fields
  FROM rest r LEFT JOIN constant c ON r.n = c.n AND r.lead = c.lead AND r.i = c.i AND r.token = c.token
  GROUP BY r.doc_id, r.pos
), template AS (
  SELECT p.doc_id, p.pos, p.n, p.lead, f.fields
  FROM placed p LEFT JOIN fields f ON p.doc_id = f.doc_id AND p.pos = f.pos
  WHERE least(p.n, {line_dedup.LEAD}) + coalesce(f.same, 0) >= {line_dedup.SIMILAR} * p.n
), recurring AS (
  SELECT n, lead, fields, min((doc_id, pos)) AS first FROM template GROUP BY n, lead, fields
  HAVING count(DISTINCT doc_id) >= {line_dedup.MIN_DOCS}
), long AS (
  SELECT l.doc_id, l.pos, {_LINE} AS line FROM lines l JOIN placed p ON l.doc_id = p.doc_id AND l.pos = p.pos WHERE p.n >= {line_dedup.LONG}
), same_long AS (
  SELECT line, min((doc_id, pos)) AS first FROM long GROUP BY line HAVING count(DISTINCT doc_id) >= {line_dedup.LONG_DOCS}
), dropped AS (
  SELECT t.doc_id, t.pos FROM template t JOIN recurring r
    ON t.n = r.n AND t.lead = r.lead AND t.fields IS NOT DISTINCT FROM r.fields
  WHERE (t.doc_id, t.pos) <> r.first
  UNION
  SELECT l.doc_id, l.pos FROM long l JOIN same_long s ON l.line = s.line WHERE (l.doc_id, l.pos) <> s.first
), kept AS (
  SELECT l.doc_id, count(*) AS n_lines, count(d.pos) AS n_dropped,
    string_agg(CASE WHEN d.pos IS NULL THEN l.line END, chr(10) ORDER BY l.pos) AS text
  FROM lines l LEFT JOIN dropped d ON l.doc_id = d.doc_id AND l.pos = d.pos GROUP BY l.doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
  coalesce(k.n_lines, 0)::BIGINT AS n_lines, coalesce(k.n_dropped, 0)::BIGINT AS n_dropped
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""


def _escaped(column: str) -> str:
    """Length of a text after escaping: one more for each control string or backslash."""
    return f"(length({column}) + len(regexp_extract_all({column}, '\\\\|<\\||</?s>|<</?SYS>>|\\[/?INST\\]')))"


CHAT_FORMAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS place
  FROM (SELECT conv_id, turn, role, text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized AS (
  SELECT *, {len(chat_format.TURN) + 1 + len(chat_format.END)} + {_escaped('role')} + length(role) - length(replace(role, chr(10), '')) + {_escaped('text')} AS size
  FROM turns
), ends AS (
  SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY place) AS upto, max(place) OVER (PARTITION BY conv_id) AS last FROM sized
)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  coalesce(sum(CASE WHEN role = '{chat_format.REPLY}' THEN length(text) END), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = '{chat_format.REPLY}' THEN text END, '' ORDER BY place), '')) AS loss_sha256,
  sum(CASE WHEN role = '{chat_format.REPLY}' OR place = last THEN upto ELSE 0 END)::BIGINT AS formatted_chars,
  count(CASE WHEN role = '{chat_format.REPLY}' OR place = last THEN 1 END)::BIGINT AS n_examples
FROM ends GROUP BY conv_id
"""

_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_W, _S = decontaminate.WINDOW, decontaminate.SLOP

DECONTAMINATE = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), {_W}) AS n, w[i + 1 : i + least(len(w), {_W})] AS win
  FROM (SELECT item_id, w, unnest(range(greatest(len(w) - {_W}, 0) + 1)) AS i FROM items WHERE len(w) > 0)
), places AS (
  SELECT doc_id, n, i, w[i + 1 : i + n] AS win
  FROM (SELECT doc_id, w, n, unnest(range(greatest(len(w) - n + 1, 0))) AS i FROM docs, (SELECT DISTINCT n FROM windows))
), found AS (SELECT p.doc_id, p.i, p.n, x.item_id FROM places p JOIN windows x ON p.n = x.n AND p.win = x.win),
hits AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM found) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM found) GROUP BY doc_id),
-- near matches: every word of a window stands at most {_S} places from where an occurrence would have it
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS place FROM docs),
spread AS (SELECT item_id, win, n, unnest(win) AS word, unnest(range(n)) AS off FROM windows),
often AS (SELECT word, count(*) AS c FROM words GROUP BY word),
rare AS (
  SELECT item_id, win, n, arg_min((s.word, off), coalesce(c, 0)) AS w FROM spread s LEFT JOIN often o ON s.word = o.word GROUP BY item_id, win, n
), starts AS (
  SELECT DISTINCT r.item_id, r.win, r.n, x.doc_id, x.place - r.w[2] + d AS start
  FROM rare r JOIN words x ON x.word = r.w[1], (SELECT unnest(range(-{_S}, {_S} + 1)) AS d)
), near AS (
  SELECT DISTINCT a.doc_id, a.item_id
  FROM starts a JOIN spread s ON a.item_id = s.item_id AND a.win = s.win
    JOIN words x ON x.doc_id = a.doc_id AND x.word = s.word AND x.place BETWEEN a.start + s.off - {_S} AND a.start + s.off + {_S}
  GROUP BY a.doc_id, a.item_id, a.win, a.n, a.start HAVING count(DISTINCT s.off) = a.n
), near_only AS (
  SELECT doc_id, count(DISTINCT item_id) AS n FROM near ANTI JOIN found USING (doc_id, item_id) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(i.n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated,
  coalesce(o.n, 0)::BIGINT AS n_near_items
FROM docs d LEFT JOIN hits h USING (doc_id) LEFT JOIN ids i USING (doc_id) LEFT JOIN near_only o USING (doc_id)
"""

EXACT_TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, x.vec_id, list_dot_product(q.v, x.v)::BIGINT AS score
  FROM v q JOIN v x ON q.vec_id % 50 = 0 AND x.vec_id <> q.vec_id
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5
"""



def _hash(*parts: str) -> str:
    return f"('0x' || substr(md5(concat_ws(':', '{mixing.SEED}', {', '.join(parts)})), 1, 8))::BIGINT"


MIXING = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce('s' || source, '') AS name, {_hash("coalesce(doc_id::VARCHAR, '')")} AS key,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size
  FROM documents
), weighted AS (
  SELECT name, size, [5, 2, 1][rank % 3 + 1] AS weight, {mixing.MOST} * size AS most
  FROM (SELECT name, sum(size)::BIGINT AS size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM sized GROUP BY name, source)
), stopped AS (  -- with the sources that stop first, by target for one unit of weight
  SELECT sum(most) OVER upto AS own, sum(weight) OVER upto AS w FROM weighted WINDOW upto AS (ORDER BY most / weight, name ROWS UNBOUNDED PRECEDING)
), share AS (
  SELECT max((t - own) / (all_w - w)) AS level FROM (SELECT sum(size)::DOUBLE AS t, sum(weight)::DOUBLE AS all_w FROM weighted),
    (SELECT own, w FROM stopped UNION ALL SELECT 0, 0) WHERE w < all_w
), sources AS (
  SELECT *, least(most::DOUBLE, weight * level) AS target, ceil(size / {mixing.SHARD})::BIGINT AS shards FROM weighted, share
), source_quota AS (
  SELECT name, count(*) AS quota FROM (
    SELECT name, row_number() OVER (ORDER BY target / (2 * i + 1) DESC, name) AS place
    FROM (SELECT name, target, unnest(range(ceil(most / {mixing.BLOCK})::BIGINT)) AS i FROM sources WHERE target > 0)
  ) WHERE place <= (SELECT round_even(sum(size) / {mixing.BLOCK}, 0) FROM sources) GROUP BY name
), placed AS (
  SELECT doc_id, d.name, d.size, key % shards AS unit, sum(d.size) OVER (PARTITION BY d.name, key % shards ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) - d.size AS begin
  FROM sized d JOIN sources s USING (name) WHERE d.size > 0
), shards AS (SELECT name, unit, sum(size)::BIGINT AS words FROM placed GROUP BY ALL
), quota AS (
  SELECT name, unit, words, count(*) AS quota FROM (
    SELECT name, unit, words, quota, row_number() OVER (PARTITION BY name ORDER BY words / (2 * i + 1) DESC, unit) AS place
    FROM (SELECT name, unit, words, unnest(range(ceil({mixing.MOST} * words / {mixing.BLOCK})::BIGINT)) AS i FROM shards) JOIN source_quota USING (name)
  ) WHERE place <= quota GROUP BY ALL
), budget AS (
  SELECT name, unit, words, words // {mixing.BLOCK} AS n_full, least(quota * {mixing.BLOCK}, {mixing.MOST} * words) AS budget, {_hash('name', 'unit')} AS turn FROM quota
), blocks AS (
  SELECT doc_id, size, begin, words, budget, turn, n_full, unnest(range(begin::BIGINT // {mixing.BLOCK}, (begin + size - 1)::BIGINT // {mixing.BLOCK} + 1)) AS k FROM placed JOIN budget USING (name, unit)
), ordered AS (
  SELECT *, budget % words AS rest, CASE WHEN k < n_full THEN (k * 2654435761 + turn) % n_full ELSE n_full END AS place FROM blocks
), cut AS (
  SELECT *, k * {mixing.BLOCK} + CASE WHEN place < rest // {mixing.BLOCK} THEN {mixing.BLOCK} WHEN place = rest // {mixing.BLOCK} THEN rest % {mixing.BLOCK} ELSE 0 END AS upto FROM ordered
), taken AS (
  SELECT doc_id, any_value(budget // words * size) + sum(greatest(least(upto, begin + size) - greatest(k * {mixing.BLOCK}, begin), 0)) AS taken FROM cut GROUP BY doc_id
)
SELECT d.doc_id, d.size, s.size AS source_size, s.target, coalesce(t.taken, 0)::BIGINT AS taken
FROM sized d JOIN sources s USING (name) LEFT JOIN taken t ON d.doc_id = t.doc_id
"""

_FAR = "list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"


def _assigned(n: int) -> str:
    """Each part's nearest entry of codebook ``n``: squared distance and index as one number."""
    return f"near{n} AS (SELECT vec_id, label, p, x, min({_FAR} * {vector_codes.ENTRIES} + e) AS k FROM parts JOIN book{n} USING (p) GROUP BY ALL)"


def _moved(n: int) -> str:
    """Codebook ``n + 1``."""
    return f"""mean{n} AS (
  SELECT p, e, list(m ORDER BY i) AS c FROM (
    SELECT p, k % {vector_codes.ENTRIES} AS e, i, floor(sum(x[i + 1]) / count(*))::BIGINT AS m
    FROM (SELECT *, unnest(range(len(x))) AS i FROM near{n}) GROUP BY ALL
  ) GROUP BY ALL
), book{n + 1} AS (SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{n} b LEFT JOIN mean{n} m ON b.p = m.p AND b.e = m.e)"""


VECTOR_CODES = f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({vector_codes.SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
  SELECT vec_id, label, p, v[p * w + 1 : (p + 1) * w] AS x
  FROM (SELECT *, len(v) // {vector_codes.PARTS} AS w, unnest(range({vector_codes.PARTS})) AS p FROM kept)
), book0 AS (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c
  FROM parts WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {vector_codes.ENTRIES})
), {_assigned(0)}, {_moved(0)}, {_assigned(1)}, {_moved(1)}, {_assigned(2)},
digest AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book2
), coded AS (
  SELECT vec_id, label, string_agg(format('{{:02x}}', k % {vector_codes.ENTRIES}), '' ORDER BY p) AS code,
    sum(k // {vector_codes.ENTRIES})::BIGINT AS error
  FROM near2 GROUP BY ALL
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded, digest
"""

ORACLE: dict[str, str] = {
    "op1_line_dedup": LINE_DEDUP,
    "op2_chat_format": CHAT_FORMAT,
    "op6_decontaminate": DECONTAMINATE,
    "op8_exact_topk": EXACT_TOPK,
    "op11_mixing": MIXING,
    "op13_vector_codes": VECTOR_CODES,
}
