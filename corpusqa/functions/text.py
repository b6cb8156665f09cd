"""Column expressions for text: cleaning, character tokens, offsets, terms.

All functions return ``Column`` objects built from Spark SQL built-ins, so
they stay inside the JVM and inside whole-stage code generation where the
expression allows it.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusqa.functions.arrays import let

# Fixed values that must equal the reference's behaviour.
# Blank removal deletes exactly these two characters (space, tab); newlines
# and the ideographic space stay in the text.
BLANKS = " \t"
# Characters that produce no token in the character tokenizer: space
# separators, control and format characters (newline, CR, tab, U+3000, ...).
ZERO_TOKEN_CLASS = r"[\p{Zs}\p{Cc}\p{Cf}]"
# Word characters for the retrieval analyser (Han characters are handled as
# overlapping bigrams instead, see ``analyze``).
WORD_RUN = r"[\p{L}\p{N}]+"
HAN_CHAR = r"\p{IsHan}"
HAN_RUN = r"\p{IsHan}+"
# Sentence delimiter of the reference (ideographic full stop).
DEFAULT_DELIMITER = "。"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean_text(col) -> Column:
    """Delete every space and tab (nothing else)."""
    return F.translate(_c(col), BLANKS, "")


def kept_text(col) -> Column:
    """Text with the zero-token characters removed; one char = one token."""
    return F.regexp_replace(_c(col), ZERO_TOKEN_CLASS, "")


def char_tokens(col) -> Column:
    """Per-character tokens (lower-cased), zero-token chars dropped.

    Lower-casing is applied per token so a character whose lower case is
    longer still stays one token and offsets keep lining up.
    """
    k = kept_text(col)
    return F.when(F.length(k) == 0, F.array().cast("array<string>")).otherwise(
        F.transform(F.split(k, ""), lambda t: F.lower(t))
    )


def n_tokens(col) -> Column:
    return F.length(kept_text(col))


def char_to_token(text_col, char_idx) -> Column:
    """T4 char -> token: number of tokens produced before character ``char_idx``.

    Equals the reference's ``original_to_tokenized_index[char_idx]`` without
    materialising the whole map.
    """
    return F.length(kept_text(F.substring(_c(text_col), F.lit(1), _c(char_idx))))


def token_to_char_map(text_col) -> Column:
    """T4 token -> char: 0-based character index of every token."""
    chars = F.split(_c(text_col), "")
    idx = F.transform(
        chars, lambda ch, i: F.when(ch.rlike("^" + ZERO_TOKEN_CLASS + "$"), F.lit(-1)).otherwise(i)
    )
    return F.when(F.length(_c(text_col)) == 0, F.array().cast("array<int>")).otherwise(
        F.filter(idx, lambda i: i >= 0)
    )


def char_to_token_map(text_col) -> Column:
    """T4 char -> token: for every character the number of tokens before it. One
    pass over the tokens: each repeats its number for the characters up to it."""
    return _tokens_before(token_to_char_map(text_col), F.length(_c(text_col)))


def _tokens_before(char_of_token: Column, n_chars: Column) -> Column:
    """For each of ``n_chars`` characters the tokens before it, from each token's character."""

    def spread(at):
        return F.flatten(
            F.transform(
                F.sequence(F.lit(0), F.size(at) - 2),
                lambda j: F.array_repeat(j, F.get(at, j + 1) - F.get(at, j)),
            )
        )

    return F.when(n_chars == 0, F.array().cast("array<int>")).otherwise(
        let(F.concat(F.array(F.lit(-1)), char_of_token, F.array(n_chars - 1)), spread)
    )


def byte_pieces(ch: Column) -> Column:
    """The tokens of one character in byte mode: the UTF-8 bytes of its lower case, two hex
    digits each; none for a zero-token character."""
    digits = F.lower(F.hex(F.encode(F.lower(ch), "UTF-8")))
    return F.when(ch.rlike("^" + ZERO_TOKEN_CLASS + "$"), F.array().cast("array<string>")).otherwise(
        F.regexp_extract_all(digits, F.lit(".."), F.lit(0))
    )


def sub_tokens(col, pieces) -> Column:
    """For every character the array of its tokens, by ``pieces(character) ->
    array<string>``; any number of them, also none."""
    return F.when(F.length(_c(col)) == 0, F.array().cast("array<array<string>>")).otherwise(
        F.transform(F.split(_c(col), ""), pieces)
    )


def all_sub_tokens(col, pieces) -> Column:
    """The tokens of a text, character by character."""
    return F.flatten(sub_tokens(col, pieces))


def n_sub_tokens(col, pieces) -> Column:
    return F.aggregate(sub_tokens(col, pieces), F.lit(0), lambda n, t: n + F.size(t))


def sub_token_to_char_map(text_col, pieces) -> Column:
    """T4 token -> char with any number of tokens a character."""
    return F.flatten(F.transform(sub_tokens(text_col, pieces), lambda t, i: F.array_repeat(i, F.size(t))))


def char_to_sub_token_map(text_col, pieces) -> Column:
    """T4 char -> token with any number of tokens a character: those before it, the place of
    its first."""
    return _tokens_before(sub_token_to_char_map(text_col, pieces), F.length(_c(text_col)))


def char_to_sub_token(text_col, char_idx, pieces) -> Column:
    """T4 char -> token for one character, without the map."""
    return n_sub_tokens(F.substring(_c(text_col), F.lit(1), _c(char_idx)), pieces)


def sub_sentence_lengths(text_col, pieces, delimiter: str = DEFAULT_DELIMITER) -> Column:
    """C1 with any number of tokens a character. A last sentence without tokens is none."""
    parts = F.regexp_extract_all(_c(text_col), F.lit(sentence_pattern(delimiter)), F.lit(0))
    return F.filter(F.transform(parts, lambda s: n_sub_tokens(s, pieces)), lambda n: n > 0)


def sentence_pattern(delimiter: str = DEFAULT_DELIMITER) -> str:
    """Regex matching one sentence: text up to and including the delimiter,
    or a trailing run without it."""
    if len(delimiter) != 1:
        raise ValueError("delimiter must be a single character")
    d = re.escape(delimiter)
    return f"[^{d}]*{d}|[^{d}]+"


def sentence_lengths(text_col, delimiter: str = DEFAULT_DELIMITER) -> Column:
    """Token length of every sentence; the delimiter closes a sentence and
    the last token closes the final one."""
    parts = F.regexp_extract_all(kept_text(text_col), F.lit(sentence_pattern(delimiter)), 0)
    return F.transform(parts, lambda s: F.length(s))


def _accent_table(first: int = 0x00C0, last: int = 0x024F) -> tuple[str, str]:
    """Rule-built mapping of precomposed Latin letters to their base letter:
    every code point whose canonical decomposition is one ASCII letter
    followed only by combining marks."""
    src, dst = [], []
    for cp in range(first, last + 1):
        ch = chr(cp)
        d = unicodedata.normalize("NFD", ch)
        if len(d) > 1 and d[0].isascii() and d[0].isalpha() and all(unicodedata.category(m) == "Mn" for m in d[1:]):
            src.append(ch)
            dst.append(d[0])
    return "".join(src), "".join(dst)


_ACCENTED, _BASE = _accent_table()


def strip_accents(col) -> Column:
    """Optional T2 accent stripping as a JVM ``translate``: precomposed Latin
    letters become their base letter, one character for one, so every offset
    stays valid. Apply the same way to passages and questions."""
    return F.translate(_c(col), _ACCENTED, _BASE)


def analyze(col) -> Column:
    """R2: retrieval terms of a text, the same analyser for index and query.

    Letter/digit runs (lower-cased) are words; Han characters are split out of
    them and indexed as overlapping character bigrams (a single Han character
    alone becomes a unigram). Texts are analysed as they are, with the blanks
    that part their words; blanks between Han characters are passed over.
    """
    word_runs = lambda text: F.regexp_extract_all(F.lower(text), F.lit(WORD_RUN), 0)
    c = F.regexp_replace(_c(col), r"(?<=\p{IsHan})[ \t]+(?=\p{IsHan})", "")
    words = word_runs(F.regexp_replace(c, HAN_CHAR, " "))
    runs = F.regexp_extract_all(c, F.lit(HAN_RUN), 0)
    bigrams = F.flatten(
        F.transform(
            runs,
            lambda r: F.transform(
                F.sequence(F.lit(1), F.greatest(F.length(r) - 1, F.lit(1))),
                lambda i: F.substring(r, i, 2),
            ),
        )
    )
    # a text without Han characters is its words: one pass in place of four
    return F.when(~_c(col).rlike(HAN_CHAR), word_runs(_c(col))).otherwise(F.concat(words, bigrams))


# Note on explode: every explode over a computed array in this package uses
# the ``_outer`` form followed by a null filter. A plain ``explode`` makes
# Catalyst infer ``size(array) > 0`` and push that filter below projections
# and repartitions, which evaluates the (expensive) array expression twice,
# once inside the scan task.
