"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks. DataFrame functions only.

Targets: the words of all documents are shared out by the sources' weights; a
source stops at ``most_passes`` times its own words, and what it leaves goes to
the others by weight, until none is above. A round is one aggregate over the
sources; three sums reach the driver.

Blocks: the mix has as many blocks of ``block_words`` words as fit its size. They
go one by one to the source with the highest quotient target / (2 k + 1), k
being the blocks that it has. A source that gets more words than it has is
taken whole so many times; the rest is a number of blocks of one more pass.
That number is dealt in the same way to the source's shards (documents by
seeded hash, some ``shard_words`` words each), by their blocks. A shard lays its
documents end to end in seeded order and takes its quota of blocks at even
distances from a seeded start, so a document's words follow from its place.

Apportionment needs no loop over blocks: divisors a little larger and smaller than
the right one bound every party's seats, and only the few quotients between
the bounds are ranked. Ranks come from range partitions and their sizes, so
neither sources nor shards meet in one task, and a hot source is as many shards
as its words need. Its documents meet their source's row over ``SALTS`` salts.

Defined results: a null or empty text has size 0 and is taken 0 times; a null
source is a source of its own, the last; rows that repeat an id each have their
own place; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm.scratch import stored

WORD = r"[^\x20\x09-\x0D]+"
SALTS = 64


def _draw(*parts) -> Column:
    """A seeded number below 2^60: the first 15 hex digits of the MD5 of the parts, joined by colons."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` with ``number``, their place (from 1) in ``order``: sorted by range partitions, whose sizes give offsets."""
    parts = stored(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), name)
    sizes = parts.groupBy("part").agg(F.count("*").alias("n"))  # a row per partition
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    local = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return parts.withColumn("local", local).join(sizes, "part").withColumn("number", F.col("before") + F.col("local")).drop(
        "part", "local", "before")


def apportion(parties: DataFrame, name: str) -> DataFrame:
    """Sainte-Laguë seats: ``parties`` (``grp, party, weight, total``: the seats of the group) with ``seats``.

    Of equal quotients the smaller party's comes first.
    """
    parties = parties.filter((F.col("weight") > 0) & (F.col("total") > 0))
    sums = parties.groupBy("grp").agg(F.count("*").alias("parties"), F.sum(F.col("weight").cast("double")).alias("sum"))
    # Round(weight / divisor) seats add up to the total at most if the divisor is sum / (total - parties / 2), and to no less
    # if it is sum / (total + parties / 2). One seat more on either side covers rounding of doubles.
    share = lambda sign: F.col("weight") * (F.col("total") + sign * F.col("parties") / 2) / F.col("sum")
    low = F.greatest(F.floor(share(-1) - 0.5), F.lit(0)).cast("long")
    high = (F.floor(share(1) + 0.5) + 1).cast("long")
    bounds = stored(parties.join(sums, "grp").select("grp", "party", "weight", "total", low.alias("low"), high.alias("high")),
                    f"{name}-bounds")
    quotients = bounds.select("grp", "party", "weight", F.explode(F.sequence("low", "high")).alias("k"))
    quotient = (F.col("weight") / (2 * F.col("k") + 1)).alias("quotient")
    ranked = numbered(quotients.select("grp", "party", quotient),
                      [F.col("grp"), F.col("quotient").desc(), F.col("party")], f"{name}-quotients")
    left = bounds.groupBy("grp").agg((F.first("total") - F.sum("low")).alias("left"))
    first = ranked.groupBy("grp").agg(F.min("number").alias("first")).join(left, "grp")
    more = ranked.join(first, "grp").filter(F.col("number") - F.col("first") < F.col("left"))
    more = more.groupBy("grp", "party").agg(F.count("*").alias("more"))
    return bounds.join(more, ["grp", "party"], "left").select(
        "grp", "party", (F.col("low") + F.coalesce("more", F.lit(0))).alias("seats"))


def targets(sources: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most_passes: int = 3) -> DataFrame:
    """``sources`` (``source, source_size``) with ``party`` (the place by code points, null last) and ``target``."""
    rows = numbered(sources, [F.col("source").isNull(), F.col("source")], "mix-sources")
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("number") - 1) % len(weights) + 1).cast("int"))
    rows = stored(rows.select("source", "source_size", F.col("number").alias("party"), weight.cast("long").alias("weight")), "mix-weights")
    wide = lambda c: c.cast("decimal(19,0)")
    capped, full = F.lit(False), -1
    while True:
        most = most_passes * F.col("source_size")
        row = rows.agg(F.sum("source_size").alias("size"), F.sum(F.when(capped, most)).alias("capped"),
                       F.sum(F.when(~capped, F.col("weight"))).alias("open"), F.sum(capped.cast("long")).alias("full")).first()
        if row["size"] is None or not row["open"] or row["full"] == full:
            break
        left, open_weight, full = row["size"] - (row["capped"] or 0), row["open"], row["full"]
        capped = wide(most) * F.lit(open_weight).cast("decimal(18,0)") <= wide(F.col("weight")) * F.lit(left).cast("decimal(18,0)")
    if row["size"] is None or not row["open"]:  # no rows, or no words
        return rows.withColumn("target", (most_passes * F.col("source_size")).cast("double"))
    open_target = (wide(F.col("weight")) * F.lit(left).cast("decimal(18,0)")).cast("double") / F.lit(float(open_weight))
    return rows.withColumn("target", F.when(capped, most.cast("double")).otherwise(open_target))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = (5, 2, 1),
        most_passes: int = 3, block_words: int = 16, shard_words: int = 1 << 20, seed: int = 13) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken``: how many words of each document the mix takes."""
    block = F.lit(block_words).cast("long")
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), size.alias("size"))
    rows = stored(rows.withColumn("key", _draw(F.lit(seed), F.col("doc_id"), F.col("size"))), "mix-sizes")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    aims = stored(targets(sources, weights, most_passes).withColumn("grp", F.lit(0)), "mix-targets")

    # Blocks of the sources, and from them whole passes and the blocks of one more.
    total = aims.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("size")).first()["size"]
    total = (2 * total + block_words) // (2 * block_words)
    seats = apportion(aims.select("grp", "party", F.col("target").alias("weight"), F.lit(total).cast("long").alias("total")),
                      "mix-blocks")
    words = F.least(F.coalesce("seats", F.lit(0)) * block, most_passes * F.col("source_size"))
    aims = aims.join(seats.select("party", "seats"), "party", "left").withColumn("words", words)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("words") / F.col("source_size"))).otherwise(0).cast("long")
    aims = aims.withColumn("passes", passes).withColumn("rest", F.col("words") - F.col("passes") * F.col("source_size"))
    shards = F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1))
    aims = stored(aims.select("source", "party", "source_size", "target", "passes",
                              F.floor((2 * F.col("rest") + block) / (2 * block)).cast("long").alias("blocks"),
                              shards.cast("long").alias("shards")), "mix-plan")

    salted = aims.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumnRenamed("source", "of")
    named = rows.withColumn("salt", (F.col("key") % SALTS).cast("int"))
    named = named.join(salted, named["source"].eqNullSafe(salted["of"]) & (named["salt"] == salted["salt"]))
    named = stored(named.select("doc_id", "source", "size", "key", "party", "source_size", "target", "passes", "blocks",
                                (F.shiftright("key", SALTS.bit_length() - 1) % F.col("shards")).alias("shard")), "mix-places")
    held = named.filter("size > 0")

    # Quotas of the shards: of their whole blocks.
    cells = held.groupBy("party", "shard").agg(F.floor(F.sum("size") / block).cast("long").alias("whole"), F.first("blocks").alias("blocks"))
    cells = stored(cells.withColumn("start", F.when(F.col("whole") > 0, _draw(F.lit(seed), F.col("party"), F.col("shard")) % F.col("whole"))
                                    .otherwise(0)), "mix-shards")
    most = cells.groupBy("party").agg(F.least(F.sum("whole"), F.first("blocks")).alias("total"))
    quotas = apportion(cells.select("party", "shard", "whole").join(most, "party").select(
        F.col("party").alias("grp"), F.col("shard").alias("party"), F.col("whole").alias("weight"), "total"), "mix-quotas")
    quotas = quotas.select(F.col("grp").alias("party"), F.col("party").alias("shard"), F.col("seats").alias("quota"))
    cells = cells.join(quotas, ["party", "shard"], "left").select("party", "shard", "whole", "start", F.coalesce("quota", F.lit(0)).alias("quota"))

    # Words of the last pass before a place: of the blocks chosen before it, and of the one it lies in.
    in_order = Window.partitionBy("party", "shard").orderBy("key", "size", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    laid = held.join(cells, ["party", "shard"]).withColumn("stop", F.sum("size").over(in_order))

    def chosen(place: Column) -> Column:
        at = F.least(F.floor(place / block).cast("long"), F.col("whole"))
        count = lambda j: F.floor((j * F.col("quota") + F.col("start")) / F.col("whole")).cast("long")
        part = F.when((at < F.col("whole")) & (count(at + 1) > count(at)), place - at * block).otherwise(0)
        return F.when(F.col("whole") > 0, count(at) * block + part).otherwise(0)

    taken = F.col("passes") * F.col("size") + chosen(F.col("stop")) - chosen(F.col("stop") - F.col("size"))
    own = ["doc_id", "source", "size", "source_size", "target"]
    empty = named.filter("size = 0").select(*own, F.lit(0).cast("long").alias("taken"))
    return laid.select(*own, taken.cast("long").alias("taken")).unionByName(empty)
