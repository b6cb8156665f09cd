"""Spelling variants: words at one edit, found over a reduced alphabet.

Letters are hashed to a few symbols. Words that differ by one edit have reduced words that
are equal or differ by one edit, so a word's candidates are those whose reduced word is in
the full one-edit neighbourhood of its own. A reduced word stands as a polynomial
of its symbols modulo 2^64; all neighbours follow from sums over its beginnings and
ends. A sieve of bits of fixed size holds the reduced words of the vocabulary:
neighbours that it rules out are never shuffled. What joins is verified on the words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusqa.llm.common import byte_values, pieces, release, stored, widen
from corpusqa.session import spread

LEAST = 7  # code points of a word, at least
SEEN = 2  # occurrences, at least
RATIO = 10  # a form occurs so many times as often, at least
NOISE = 31  # one in so many runs of a document loses a letter
SYMBOLS = 13  # letters whose code points are equal modulo it have one symbol
SIEVE = 26  # bits of a reduced word that find its place in the sieve
FLUSH = 1 << 18  # distinct words that a task holds before it passes them on
STEP = 0x9E3779B97F4A7C15  # of the polynomial
CHUNK = 1 << 18  # neighbours made at a time


def occurrences(docs: DataFrame, doc_id: str, text: str, least: int = LEAST, noise: int | None = NOISE) -> DataFrame:
    """(word, n): the runs of letters of all texts, A-Z lower-cased, each without a letter where
    ``noise`` says so; those of ``least`` code points or more."""

    def run(batches):
        import re
        from collections import Counter
        from zlib import crc32

        import pyarrow as pa

        letters = re.compile("[a-zÀ-ÿ]{%d,}" % least)

        def out(held):
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        held: Counter = Counter()
        for batch in batches:
            for part in pieces(batch, 500):
                for key, raw in zip(part.column(0).to_pylist(), byte_values(part.column(1))):
                    runs = Counter(letters.findall(raw.lower().decode()))
                    begin = crc32(f"{key}:".encode())
                    for word, n in runs.items():
                        if noise:
                            h = crc32(word.encode(), begin)
                            if h % noise == 0:
                                at = h % len(word)
                                word = word[:at] + word[at + 1 :]
                                if len(word) < least:
                                    continue
                        held[word] += n
                    if len(held) >= FLUSH:
                        yield out(held)
                        held = Counter()
        if held:
            yield out(held)

    rows = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("id"), F.col(f"`{text}`").alias("text"))
    return rows.filter("text is not null").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _mix(x):
    import numpy as np

    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _values(words: list[str]):
    """For words of one length, the number of each letter's symbol, a row a word; and those of all symbols."""
    import numpy as np

    letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)
    values = _mix(np.arange(1, SYMBOLS + 1, dtype=np.uint64))
    return values[letters % SYMBOLS], values


def _sums(values):
    """Powers of STEP, and the sums over the first letters of each row."""
    import numpy as np

    power = np.concatenate([[np.uint64(1)], np.full(values.shape[1], np.uint64(STEP))]).cumprod(dtype=np.uint64)
    before = np.zeros((len(values), values.shape[1] + 1), np.uint64)
    before[:, 1:] = (values * power[:-1]).cumsum(axis=1, dtype=np.uint64)
    return power, before


def reduced(words: list[str]):
    """Reduced words, of words of one length, as numbers: the sum of symbol i times STEP to the power i."""
    return _sums(_values(words)[0])[1][:, -1]


def neighbourhood(words: list[str]):
    """Of words of one length, a row a word, parts of the numbers of the reduced word and of all
    reduced words one edit from it."""
    import numpy as np

    values, symbols = _values(words)
    power, before = _sums(values)
    whole, n = before[:, -1:], values.shape[1]
    back = np.uint64(pow(STEP, -1, 1 << 64))  # a letter less: what follows goes down by a power
    yield whole
    some = max(1, CHUNK // (2 * SYMBOLS * len(words)))
    for first in range(0, n + 1, some):
        at = slice(first, min(first + some, n))
        yield before[:, at] + (whole - before[:, 1:][:, at]) * back
        yield (whole[:, :, None] + (symbols - values[:, at, None]) * power[at, None]).reshape(len(words), -1)
        at = slice(first, first + some)
        yield (before[:, at, None] + symbols * power[at, None] + ((whole - before[:, at]) * np.uint64(STEP))[:, :, None]).reshape(len(words), -1)


def _by_length(words: list[str]):
    """Places of words of one length: as many as make ``CHUNK`` neighbours, one at least."""
    found: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        found.setdefault(len(word), []).append(i)
    for size, own in found.items():
        some = max(1, CHUNK // (2 * SYMBOLS * (size + 1)))
        for k in range(0, len(own), some):
            yield own[k : k + some]


def one_edit(a: str, b: str) -> bool:
    """Whether one code point put in, left out or replaced makes ``a`` into ``b``."""
    if len(a) < len(b):
        a, b = b, a
    more = len(a) - len(b)
    if more > 1 or a == b:
        return False
    same, upto = 0, len(b)  # letters that begin both, halving
    while same < upto:
        mid = (same + upto + 1) // 2
        if a[same:mid] == b[same:mid]:
            same = mid
        else:
            upto = mid - 1
    return a[same + 1 :] == b[same + 1 - more :]


def _keyed(words: DataFrame) -> DataFrame:
    """(word, n, key): with the reduced word."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            own = batch.column(0).to_pylist()
            keys = np.zeros(len(own), np.uint64)
            for at in _by_length(own):
                keys[at] = reduced([own[i] for i in at])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys.view(np.int64))], names=["word", "n", "key"])

    return words.mapInArrow(run, "word string, n long, key long")


def _sieve(words: DataFrame):
    """Bits; that of every reduced word is set."""
    import numpy as np

    bit = f"bit_or(shiftleft(1L, cast(shiftrightunsigned(key, {64 - SIEVE}) & 63 as int)))"
    rows = words.groupBy(F.shiftrightunsigned("key", 64 - SIEVE + 6).alias("at")).agg(F.expr(bit).alias("bits")).toArrow()
    out = np.zeros(1 << SIEVE - 6, np.uint64)
    out[rows.column("at").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near, n) of ``words`` (word, n, key): each word's words at one edit, with their n."""
    shared = words.sparkSession.sparkContext.broadcast(_sieve(words))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        sieve = shared.value
        for batch in batches:
            words = batch.column(0).to_pylist()
            for at in _by_length(words):
                held, of = [], []
                for keys in neighbourhood([words[i] for i in at]):
                    bit = keys >> np.uint64(64 - SIEVE)
                    row, place = np.nonzero(sieve[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1))
                    held.append(keys[row, place])
                    of.append(row)
                # equal letters in a row give a neighbour more than once
                pairs = np.unique(np.array([np.concatenate(of).astype(np.uint64), np.concatenate(held)]), axis=1)
                own = pa.array(np.array(at)[pairs[0].astype(np.int64)])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(own), pa.array(pairs[1].view(np.int64))], names=["word", "key"])

    def verified(batches):
        import pyarrow as pa

        for batch in batches:
            yield batch.filter(pa.array(map(one_edit, batch.column(0).to_pylist(), batch.column(1).to_pylist()), pa.bool_()))

    schema = widen(T.StructType([words.schema["word"]]), "key long")
    asked = spread(words.select("word")).mapInArrow(run, schema)
    known = words.select(F.col("word").alias("near"), "n", "key")
    # the number of one reduced word may be that of another: only the words decide
    pairs = asked.join(known, "key").filter(F.abs(F.length("word") - F.length("near")) <= 1).select("word", "near", "n")
    return pairs.mapInArrow(verified, pairs.schema)


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) from ``forms`` (word, form): forms are followed to the last, the way
    doubling each time. A form occurs more often than its word, so there is an end."""
    links = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = stored(links.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        release(links)
        links = new.select("word", "root")
        links.scratch_path = new.scratch_path
        if not new.filter("moved").limit(1).count():
            return links


def variants(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least: int = LEAST,
    seen: int = SEEN,
    ratio: int = RATIO,
    noise: int | None = NOISE,
) -> DataFrame:
    """word, form, root, n, n_near, form_n: the words of ``least`` code points or more that
    occur ``seen`` times or more; n_near of them differ from a word by one code point put in,
    left out or replaced. Its form is the most frequent of these (ties: the first by code
    point) if it occurs ``ratio`` times as often, else null; the root is the last form of forms.

    ``noise``: of the runs of a document, those whose crc32 (of id, colon, run) it divides
    lose the letter at that hash's place; None: none do. Null texts have no words, a null
    id is an empty one; rows that repeat count each. An empty table gives an empty result.
    """
    words = occurrences(docs, doc_id, text, least, noise).filter(F.col("n") >= seen)
    words = stored(_keyed(words), "vocabulary")
    # falling count, then code points: bytes of UTF-8 have their order
    first = F.min(F.struct((-F.col("n")).alias("less"), F.col("near").alias("form")))
    near = stored(near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), first.alias("best")), "near")
    own = words.select("word", "n").join(near, "word", "left")
    form_n = -F.col("best.less")
    has_form = form_n >= ratio * F.col("n")
    own = stored(
        own.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has_form, F.col("best.form")).alias("form"), F.when(has_form, form_n).alias("form_n")), "forms"
    )
    roots = _roots(own.filter("form is not null").select("word", "form"))
    out = own.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
