"""Line dedup with a log-template tree, in DataFrame operations only.

A line descends a tree of fixed depth: by its number of tokens, then by its
first ``LEAD`` tokens, tokens with a digit standing as ``<*>``. A token that stands
at its place in the leaf's lines of ``min_docs`` or more documents is constant, any
other is a variable field and becomes ``<*>``. A line's template is what is left; it recurs if ``min_docs`` or more documents hold
it and at least ``similar`` of its tokens are constant.

A line of ``LONG`` tokens or more recurs, whatever its template, if ``long_docs``
documents hold it as it is, numerals included.

Of a recurring template or long line the first (by doc_id, then place) stays, all
others are dropped. The tree's tables hold 64-bit hashes, never text. Tokens are taken
only of lines in leaves of ``min_docs`` or more lines, and of equal lines only once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusqa.functions.arrays import let
from corpusqa.llm.common import free_name, release, stored

LEAD = 4
MIN_DOCS = 3
LONG = 50
LONG_DOCS = 2
SIMILAR = 0.7
FIELD = "<*>"


def spaced(line: Column) -> Column:
    """A line with single spaces."""
    return F.trim(F.regexp_replace(line, "[ \\t\\r\\f]+", " "))


def masked(plain: Column) -> Column:
    """A line with single spaces, its tokens that hold a digit as ``<*>``."""
    return F.when(plain.rlike("[0-9]"), F.regexp_replace(plain, "(?<![^ ])[^ 0-9]*+[0-9][^ ]*", FIELD)).otherwise(plain)


def _document(doc_id: str, text: str) -> Column:
    """Rows with equal id and text are one document."""
    return F.xxhash64(F.col(f"`{doc_id}`"), F.length(f"`{text}`"), F.xxhash64(F.col(f"`{text}`")))


def parse(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The tree's places of all lines that are not blank: doc, doc_id, pos, leaf,
    line (hashes), n (tokens), plain (not all tokens are fields), exact (of long lines,
    the hash with numerals)."""
    rows = docs.select(_document(doc_id, text).alias("doc"), F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = rows.filter(F.col("text").isNotNull())
    lines = rows.select("doc", "doc_id", F.posexplode_outer(F.split("text", "\n", -1)).alias("pos", "line"))
    lines = lines.select("doc", "doc_id", "pos", spaced(F.col("line")).alias("plain_line")).filter("plain_line <> ''")
    lines = lines.withColumn("m", masked(F.col("plain_line")))
    place = let(
        F.split("m", " "),
        lambda tokens: F.struct(
            F.size(tokens).alias("n"),
            F.xxhash64(F.size(tokens), F.array_join(F.slice(tokens, 1, LEAD), " ")).alias("leaf"),
            F.exists(tokens, lambda t: t != FIELD).alias("plain"),
        ),
    )
    lines = lines.select("doc", "doc_id", "pos", F.xxhash64("m").alias("line"), place.alias("p"), "plain_line")
    exact = F.when(F.col("p.n") >= LONG, F.xxhash64("plain_line")).alias("exact")
    return lines.select("doc", "doc_id", "pos", "line", "p.leaf", "p.n", "p.plain", exact)


def _distinct_lines(docs: DataFrame, places: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(leaf, line, n, tokens) of the lines at ``places`` (doc, pos, leaf, line, n): hashes
    of the tokens after the lead."""
    wanted = places.groupBy("doc").agg(F.collect_list(F.struct("pos", "leaf", "line", "n")).alias("at"))
    rows = docs.select(_document(doc_id, text).alias("doc"), F.col(f"`{text}`").alias("text"))
    found = let(F.split("text", "\n", -1), lambda own: F.transform("at", lambda p: F.struct(p["leaf"].alias("leaf"), p["line"].alias("line"), p["n"].alias("n"), F.get(own, p["pos"]).alias("text"))))
    # the same join at every size: what it shuffles grows with the input
    lines = rows.join(wanted.hint("merge"), "doc").select(F.explode_outer(found).alias("l")).select("l.leaf", "l.line", "l.n", masked(spaced(F.col("l.text"))).alias("m"))
    tokens = let(F.split("m", " "), lambda own: F.transform(F.slice(own, LEAD + 1, F.greatest(F.col("n") - LEAD, F.lit(0))), lambda t: F.xxhash64(t)))
    # rows that repeat are one document
    return lines.select("leaf", "line", "n", tokens.alias("tokens")).dropDuplicates(["leaf", "line"])


def _later(found: DataFrame, by: list[str], least: int) -> DataFrame:
    """(doc, pos) of all but the first of the lines equal in ``by``, if ``least`` documents hold them."""
    by_doc = found.groupBy(*by, "doc").agg(F.min(F.struct("doc_id", "doc", "pos")).alias("first"))
    recurring = by_doc.groupBy(*by).agg(F.count("*").alias("docs"), F.min("first").alias("first")).filter(F.col("docs") >= least)
    out = found.join(recurring.select(*by, F.struct("first.doc", "first.pos").alias("first")), by)
    return out.filter(F.struct("doc", "pos") != F.col("first")).select("doc", "pos")


def dropped_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_docs: int = MIN_DOCS,
    similar: float = SIMILAR,
    long_docs: int | None = LONG_DOCS,
) -> DataFrame:
    """(doc, dropped): places of the lines to drop, for each document that has any."""
    whole = stored(parse(docs, doc_id, text), "lines")
    busy = whole.groupBy("leaf").agg(F.count("*").alias("n_lines")).filter(F.col("n_lines") >= min_docs).select("leaf")
    lines = stored(whole.filter("plain").join(busy, "leaf", "left_semi").drop("exact"), "busy-lines")
    # each distinct line once: a place that holds it, and its documents
    held = lines.groupBy("leaf", "line", "doc").agg(F.min("pos").alias("pos"), F.min("n").alias("n"))
    distinct = held.groupBy("leaf", "line").agg(F.min("n").alias("n"), F.count("*").alias("docs"), F.min(F.struct("doc", "pos")).alias("first"))
    distinct = stored(distinct.select("leaf", "line", "n", "docs", "first.doc", "first.pos"), "distinct-lines")
    tokens = stored(_distinct_lines(docs, distinct, doc_id, text), "tokens")
    # constant tokens of a leaf, by the documents that hold them; a line of enough documents counts once
    few = held.join(distinct.filter(F.col("docs") < min_docs).select("leaf", "line"), ["leaf", "line"], "left_semi").select("leaf", "line", "doc")
    few = tokens.join(few, ["leaf", "line"]).select("leaf", "doc", F.posexplode("tokens").alias("i", "token")).distinct()
    many = tokens.join(distinct.filter(F.col("docs") >= min_docs).select("leaf", "line"), ["leaf", "line"], "left_semi")
    many = many.select("leaf", F.posexplode("tokens").alias("i", "token"), F.lit(min_docs).alias("docs"))
    constant = few.select("leaf", "i", "token", F.lit(1).alias("docs")).union(many).groupBy("leaf", "i", "token").agg(F.sum("docs").alias("docs"))
    constant = constant.filter(F.col("docs") >= min_docs).select("leaf", "i", "token", F.lit(True).alias("constant"))
    # each distinct line's template
    cut = tokens.select("leaf", "line", "n", F.posexplode_outer("tokens").alias("i", "token"))
    cut = cut.join(constant, ["leaf", "i", "token"], "left")
    template = cut.groupBy("leaf", "line").agg(
        F.min("n").alias("n"),
        F.count("constant").alias("same"),
        F.bit_xor(F.when(F.col("constant"), F.xxhash64("i", "token"))).alias("fields"),
    )
    similar_enough = F.least("n", F.lit(LEAD)) + F.col("same") >= F.lit(similar) * F.col("n")
    template = template.filter(similar_enough).select("leaf", "line", F.xxhash64("n", "same", "fields").alias("template"))
    found = stored(lines.select("leaf", "line", "doc", "doc_id", "pos").join(template, ["leaf", "line"]), "templates")
    out = _later(found, ["leaf", "template"], min_docs)
    if long_docs is not None:
        out = out.union(_later(whole.filter("plain and exact is not null"), ["exact"], long_docs))
    dropped = stored(out.groupBy("doc").agg(F.collect_set("pos").alias("dropped")), "dropped")
    release(whole, lines, distinct, tokens, found)
    return dropped


def dedup_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_docs: int = MIN_DOCS,
    similar: float = SIMILAR,
    long_docs: int | None = LONG_DOCS,
) -> DataFrame:
    """``docs`` with ``text`` without the lines dropped, and two columns more:
    n_lines and n_dropped.

    Blank lines, and lines all of whose tokens hold digits, stay. Null texts stay
    null with no lines; an empty text is one blank line. Rows equal in id and text
    are one document and lose the same lines. A null doc_id comes first. An empty
    table gives an empty result; other columns are carried as they are.
    """
    drops = dropped_lines(docs, doc_id, text, min_docs, similar, long_docs)
    key, text_col = free_name(docs, "line_doc"), F.col("own_text")
    own = docs.select(_document(doc_id, text).alias("doc"), F.struct("*").alias(key), F.col(f"`{text}`").alias("own_text"))
    joined = own.join(drops.hint("merge"), "doc", "left")
    lines = F.split(text_col, "\n", -1)
    # array_except goes by hash and keeps the order
    staying = lambda own: F.array_except(F.sequence(F.lit(0), F.size(own) - 1), F.col("dropped"))
    kept = let(lines, lambda own: F.array_join(F.transform(staying(own), lambda i: F.get(own, i)), "\n"))
    n_lines, n_dropped = free_name(docs, "n_lines"), free_name(docs, "n_dropped")
    columns = [F.col(f"{key}.`{c}`") for c in docs.columns if c != text]
    at = docs.columns.index(text)
    columns.insert(at, F.when(F.col("dropped").isNull(), text_col).otherwise(kept).alias(text))
    return joined.select(
        *columns,
        F.when(text_col.isNull(), 0).otherwise(F.size(lines)).cast("long").alias(n_lines),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias(n_dropped),
    )
