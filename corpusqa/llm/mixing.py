"""Mixing sources to target weights by Sainte-Laguë apportionment.

Texts are laid end to end in seeded order within shards of a source, and a shard is cut
into blocks of equally many words. The mix has a fixed number of blocks. They go
to sources, and a source's to its shards, by highest quotients: the votes (a
source's target, a shard's words) divided by 1, 3, 5, ... Each unit's blocks are so
an integer quota. A shard takes whole passes over itself as often as its
quota covers it, and the rest from its blocks in seeded order.

Quotients are never listed: the blocks of a group fix a threshold, found by counting,
for a grid of thresholds at a time, how many quotients reach it. Only sums of
the tables of sources and shards reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusqa.llm.common import release, stored

BLOCK = 64  # words of a block
SHARD = 1 << 16  # words of a shard, about
MOST = 3  # times that a document is taken, at most
SEED = "mix"
WORD = r"[^\x20\x09-\x0D]+"
GRID = 32  # thresholds tried at a time
FEW = 1000  # quotients of a group that are ranked one by one


def hash32(*parts):
    """An unsigned 32-bit hash of the columns as text; null as empty."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def ranked(rows: DataFrame, *order) -> DataFrame:
    """Stored ``rows`` with ``rank`` from 0 by ``order``, without a window over all of them:
    a row's rank is its place in its range of the order and the sizes of the ranges before."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    low = F.lit((1 << 33) - 1)
    out = stored(sorted_rows.withColumn("range", F.shiftright(place, 33)).withColumn("rank", place.bitwiseAND(low)), "ranked")
    before, offset = 0, F.lit(0).cast("long")
    for r in out.groupBy("range").count().orderBy("range").collect():  # a row a partition
        offset = F.when(F.col("range") == r.range, F.lit(before)).otherwise(offset)
        before += r["count"]
    return out.withColumn("rank", F.col("rank") + offset).drop("range")


def targets(sources: DataFrame, most: int = MOST) -> DataFrame:
    """``sources`` (size, weight and others) with target: all sizes shared by weight;
    a target stops at ``most`` times its source's size, and the excess is shared by weight again until
    none is above. A round's sums fix a level; every round stops one source at least."""
    capped = F.lit(False)
    most_words = F.col("size") * most
    level, stopped = 0.0, -1
    while True:
        total, own, weight, n = sources.agg(
            F.coalesce(F.sum("size"), F.lit(0)),
            F.coalesce(F.sum(F.when(capped, most_words)), F.lit(0)),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0)),
            F.count(F.when(capped, 1)),
        ).first()
        if n == stopped or not weight:
            break
        stopped, level = n, (total - own) / weight
        capped = capped | (most_words < F.col("weight") * level)
    return sources.withColumn("target", F.least(most_words.cast("double"), F.col("weight") * F.lit(float(level))))


def _reach(votes, threshold, most):
    """How many of a unit's quotients votes / 1, votes / 3, ... are at least ``threshold``."""
    return F.least(most, F.floor((votes / threshold + 1) / 2))


def apportion(units: DataFrame, seats: DataFrame) -> DataFrame:
    """(group, unit, quota): ``seats`` (group, seats) given to ``units`` (group, unit, votes,
    most) by highest quotients, ties to the smaller unit, none more than its ``most``.

    low and high enclose each group's threshold: fewer quotients than seats reach
    high, no fewer reach low. What lies between is ranked at the end: quotients of ``FEW``
    or less, or those that are all but equal.
    """
    units = stored(units.filter("votes > 0 and most > 0").select("group", "unit", F.col("votes").cast("double").alias("votes"), F.col("most").cast("long").alias("most")), "units")
    ends = units.groupBy("group").agg(F.sum("most").alias("all"), F.max("votes").alias("top"), F.min(F.col("votes") / (2 * F.col("most"))).alias("last"))
    state = ends.join(seats, "group").filter("seats > 0")
    state = state.select("group", F.least("seats", "all").alias("seats"), F.col("last").alias("low"), (F.col("top") * 2).alias("high"), F.col("all").alias("n_low"), F.lit(0).cast("long").alias("n_high"))
    state = stored(state, "thresholds")
    # over FEW quotients between the bounds, which are not all but equal
    open_ = (F.col("n_low") > F.col("seats")) & (F.col("n_low") - F.col("n_high") > FEW) & (F.col("high") > F.col("low") * (1 + 1e-12))
    while state.filter(open_).limit(1).count():
        grid = state.filter(open_).select("*", F.explode(F.sequence(F.lit(1), F.lit(GRID - 1))).alias("i"))
        grid = grid.withColumn("at", F.col("low") * F.pow(F.col("high") / F.col("low"), F.col("i") / F.lit(float(GRID))))
        counts = units.join(grid, "group").groupBy("group", "at").agg(F.sum(_reach(F.col("votes"), F.col("at"), F.col("most"))).alias("n"), F.first("seats").alias("seats"))
        found = counts.groupBy("group").agg(
            F.max(F.when(F.col("n") >= F.col("seats"), F.struct("at", "n"))).alias("enough"),
            F.min(F.when(F.col("n") < F.col("seats"), F.struct("at", "n"))).alias("few"),
        )
        new = state.join(found, "group", "left")
        new = stored(
            new.select(
                "group", "seats",
                F.coalesce("enough.at", "low").alias("low"), F.coalesce("few.at", "high").alias("high"),
                F.coalesce("enough.n", "n_low").alias("n_low"), F.coalesce("few.n", "n_high").alias("n_high"),
            ),
            "thresholds",
        )
        release(state)
        state = new
    sure = units.join(state, "group")
    sure = sure.withColumn("sure", _reach(F.col("votes"), F.when(F.col("n_low") == F.col("seats"), F.col("low")).otherwise(F.col("high")), F.col("most")).cast("long")).withColumn("upto", _reach(F.col("votes"), F.col("low"), F.col("most")).cast("long"))
    open_seats = sure.filter("upto > sure").select("group", "unit", "votes", (F.col("seats") - F.col("n_high")).alias("left"), F.explode(F.sequence(F.col("sure"), F.col("upto") - 1)).alias("i"))
    rank = F.row_number().over(Window.partitionBy("group").orderBy((F.col("votes") / (2 * F.col("i") + 1)).desc(), "unit"))
    more = open_seats.withColumn("rank", rank).filter("rank <= left").groupBy("group", "unit").agg(F.count("*").alias("more"))
    out = sure.join(more, ["group", "unit"], "left")
    return out.select("group", "unit", (F.col("sure") + F.coalesce("more", F.lit(0))).alias("quota"))


def cycled(sources: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """``sources`` with ``weight``: by code point, null last, the weights in turn."""
    rows = ranked(sources, F.col("source").asc_nulls_last())
    return rows.withColumn("weight", F.get(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights)).cast("int"))).drop("rank")


def _taken(size, offset, words, quota, turn, block: int, most: int):
    """Words taken of a text that lies at ``offset`` of a shard of ``words``: the passes over the
    whole shard, and what the rest takes of the blocks that the text meets. Block k has
    the place (k * step + turn) mod full among the full blocks; a short last block comes last."""
    full, budget = F.floor(words / block), F.least(quota * block, words * most)
    passes, rest = F.floor(budget / words), budget % words
    chosen, part = F.floor(rest / block), rest % block
    step = F.when(full % 2654435761 != 0, 2654435761).otherwise(2246822519)  # primes: every block has a place of its own
    first, last = F.floor(offset / block), F.floor((offset + size - 1) / block)

    def of(k):
        place = F.when(k < full, (k * step + turn) % F.greatest(full, F.lit(1))).otherwise(full)
        upto = F.when(place < chosen, block).when(place == chosen, part).otherwise(0)  # words of the block, from its start
        begin, end = F.greatest(k * block, offset), F.least(k * block + upto, offset + size)
        return F.greatest(end - begin, F.lit(0)).cast("long")

    some = F.aggregate(F.sequence(first, last), F.lit(0).cast("long"), lambda n, k: n + of(k))
    return passes * size + F.when(rest > 0, some).otherwise(0)


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    block: int = BLOCK,
    shard: int = SHARD,
    most: int = MOST,
    seed: str = SEED,
) -> DataFrame:
    """The rows of ``docs`` without ``text``, and size, source_size, target and taken: the
    words that the mix takes of a text, repeats counted, ``most`` times its size at most.

    All that a source's shards take is its quota of blocks, or ``most`` times its size
    where that is less. Null and empty texts have no words and take none. A null source
    is a source, the last. Rows that repeat are documents each; where ids repeat, size and
    text order them, so that reruns agree. A null doc_id counts as an empty one. An empty table gives an
    empty result; other columns are carried whatever their names, in a struct ``row``.
    """
    keep = [c for c in docs.columns if c != text]
    own = F.struct(*[F.col(f"`{c}`") for c in keep])
    of, words = F.col(f"`{source}`"), F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long")
    name = F.coalesce(F.concat(F.lit("s"), of.cast("string")), F.lit(""))  # null differs from all
    key = hash32(F.lit(seed), F.col(f"`{doc_id}`"))
    sized = docs.select(own.alias("row"), words.alias("size"), of.alias("source"), name.alias("group"), key.alias("key"), F.col(f"`{doc_id}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("content"))
    sized = stored(sized, "sizes")
    sources = stored(sized.groupBy("group").agg(F.first("source").alias("source"), F.sum("size").alias("size")), "sources")
    sources = stored(targets(cycled(sources, weights), most).withColumn("shards", F.ceil(F.col("size") / shard)), "targets")
    total = sources.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    seats = docs.sparkSession.createDataFrame([("", round(total / block))], "group string, seats long")
    votes = sources.select(F.lit("").alias("group"), F.col("group").alias("unit"), F.col("target").alias("votes"), F.ceil(F.col("size") * most / block).alias("most"))
    quotas = apportion(votes, seats).select(F.col("unit").alias("group"), F.col("quota").alias("seats"))
    placed = sized.filter("size > 0").drop("row", "source").join(sources.select("group", "shards"), "group").withColumn("unit", F.col("key") % F.col("shards"))
    shards = stored(placed.groupBy("group", "unit").agg(F.sum("size").alias("words")), "shards")
    inner = apportion(shards.select("group", "unit", F.col("words").alias("votes"), F.ceil(F.col("words") * most / block).alias("most")), quotas)
    shards = shards.join(inner, ["group", "unit"], "left").select("group", "unit", "words", F.coalesce("quota", F.lit(0)).alias("quota"))
    turn = hash32(F.lit(seed), F.col("group"), F.col("unit"))
    # rows of one shard, about ``shard`` words or one long text
    order = Window.partitionBy("group", "unit").orderBy("key", "id", "size", "content")
    offset = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    laid = sized.join(sources.select("group", "shards", F.col("size").alias("source_size"), "target"), "group")
    # texts without words are in no shard, and dealt out all the same
    laid = laid.withColumn("unit", F.when(F.col("size") > 0, F.col("key") % F.col("shards")).otherwise(-1 - F.col("key") % 4096)).withColumn("offset", offset)
    laid = laid.join(shards, ["group", "unit"], "left")
    taken = F.when(F.col("size") > 0, _taken(F.col("size"), F.col("offset"), F.col("words"), F.col("quota"), turn, block, most)).otherwise(0)
    return laid.select("row", "size", "source_size", "target", taken.cast("long").alias("taken"))
