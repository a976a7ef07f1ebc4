"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words from its weight. A document's expected number of copies
is its share of that target; the whole part is certain, and the fraction is the inclusion
probability of one more copy. Documents compete for these by their Pareto rank (random odds divided
by inclusion odds) until the words of the source are reached.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from membervane.llm.common import staged, word_count
from membervane.operators.rows import with_index

#: The uniform number of a document: so many hexadecimal digits of a digest of its id.
DIGITS = 13
RESULT = ("doc_id", "source", "size", "source_size", "target", "copies", "taken")


def uniform(doc_id: Column, salt: str) -> Column:
    """A number in (0, 1) that depends on the id and the salt only."""
    digest = F.md5(F.concat(F.lit(f"{salt}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))
    return (F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(16**DIGITS))


def source_targets(sizes: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """``source, source_size`` with ``target``: words shared by weight, at most ``most`` times the size.

    Sources by code point, null last, take the weights in turn. What lies above a limit goes to
    the others by weight, until none is above. Two numbers of each round reach the driver.
    """
    ordered = with_index(sizes.withColumn("_null", F.col("source").isNull()), ["_null", "source"], "_rank", True)
    choices = F.array(*[F.lit(int(w)) for w in weights])
    ordered = ordered.withColumn("_weight", F.element_at(choices, (F.col("_rank") % len(weights) + 1).cast("int")))
    total, all_weights = ordered.agg(F.sum("source_size"), F.sum("_weight")).first()
    rest, open_weights = total or 0, all_weights or 1
    while True:
        full = most * F.col("source_size") / F.col("_weight") <= F.lit(float(rest)) / F.lit(float(open_weights))
        words, left = ordered.agg(F.sum(F.when(full, F.col("source_size"))), F.sum(F.when(~full, F.col("_weight")))).first()
        found = ((total or 0) - most * (words or 0), left or 0)
        if found == (rest, open_weights) or not found[1]:
            break
        rest, open_weights = found
    share = F.col("_weight") * F.lit(float(rest)) / F.lit(float(open_weights))
    target = F.when(full, F.lit(float(most)) * F.col("source_size")).otherwise(share)
    return ordered.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    most: int = 3,
    merit: Column | None = None,
    salt: str = "mix",
    carry: bool = False,
) -> DataFrame:
    """How many copies of each document the mix takes.

    ``docs`` has ``doc_id``, ``text`` and ``source``; the result has one row per row of it: ``doc_id,
    source, size, source_size, target, copies, taken``, and with ``carry`` the other columns of ``docs`` that have no such name and no leading underscore (the decisions only
    need a small table by source, so texts are not shuffled for that). ``merit`` (default 1 for all) makes the
    inclusion probabilities unequal inside a source: expected copies are in proportion to it.

    The sample of a source has a fixed size in words: ranks are taken while their words fit, and the
    last place goes to the document whose size comes nearest to what is still missing. The running
    sum is made per range partition, so one source may hold any share of the rows.

    Null text has size 0 and takes 0 words. A null source is a source of its own. Rows that share a
    ``doc_id`` share its random number and are decided alike when their sizes agree. An empty table
    gives an empty result. Other columns are not read.
    """
    merit = F.lit(1.0) if merit is None else merit.cast("double")
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit("null"))
    extra = [c for c in docs.columns if c not in RESULT and not c.startswith("_")] if carry else []
    full = docs.withColumns({"size": word_count(F.col("text")), "_merit": merit}).withColumn("source", F.col("source").cast("string"))
    full = full.select("doc_id", "source", "size", "_merit", *extra).withColumn("_key", key)
    docs = staged(full.select("doc_id", "source", "size", "_merit", "_key"), "mix-sizes")
    sources = docs.groupBy("_key").agg(
        F.first("source").alias("source"), F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("_merit")).alias("_worth")
    )
    sources = staged(sources, "mix-sources")
    targets = source_targets(sources.select("source", "source_size"), weights, most).withColumn("_key", key)
    sources = staged(sources.join(targets.select("_key", "target"), "_key"), "mix-targets")

    expected = F.when(F.col("_worth") > 0, F.col("target") * F.col("_merit") / F.col("_worth")).otherwise(0.0)
    expected = F.least(F.lit(float(most)), F.greatest(F.lit(0.0), expected))
    share = expected - F.floor(expected)
    u = uniform(F.col("doc_id"), salt)
    rank = (u / (1 - u)) / (F.col("_share") / (1 - F.col("_share")))

    def shared(rows: DataFrame) -> DataFrame:
        rows = rows.join(sources.drop("source"), "_key").withColumns({"_whole": F.floor(expected), "_share": share})
        rows = rows.withColumn("_rank", F.when((F.col("_share") > 0) & (F.col("size") > 0), rank))
        return rows.withColumn("_id", F.coalesce("doc_id", F.lit(-(2**63))))

    shares = shared(docs)

    missing = shares.groupBy("_key").agg((F.first("target") - F.sum(F.col("_whole") * F.col("size"))).alias("_missing"))
    missing = staged(missing, "mix-missing")
    placed = shares.where(F.col("_rank").isNotNull()).select("_key", "_rank", "_id", "size")
    placed = staged(placed.orderBy("_key", "_rank", "_id").withColumn("_part", F.spark_partition_id()), "mix-order")
    parts = placed.groupBy("_key", "_part").agg(F.sum("size").alias("_words"))
    earlier = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_key", "_part", F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_key", "_part").orderBy("_rank", "_id")
    summed = placed.withColumn("_sum", F.sum("size").over(inside))
    summed = summed.join(parts, ["_key", "_part"]).withColumn("_sum", F.col("_sum") + F.col("_before"))
    summed = staged(summed.join(missing, "_key").drop("_part", "_before"), "mix-sums")

    place = F.struct(F.col("_rank"), F.col("_id"))
    fits = F.col("_sum") <= F.col("_missing")
    cuts = summed.groupBy("_key").agg(
        F.max(F.when(fits, place)).alias("_cut"),
        (F.first("_missing") - F.coalesce(F.max(F.when(fits, F.col("_sum"))), F.lit(0))).alias("_gap"),
    )
    cuts = staged(cuts, "mix-cuts")
    off = F.abs(F.col("_gap") - F.col("size"))
    last = (
        summed.where(~fits)
        .join(cuts, "_key")
        .where(off < F.col("_gap"))
        .groupBy("_key")
        .agg(F.min(F.struct(off.alias("off"), F.col("_rank"), F.col("_id"))).alias("_last"))
    )
    cuts = staged(cuts.join(last, "_key", "left").select("_key", "_cut", "_last"), "mix-choice")
    chosen = (place <= F.col("_cut")) | ((F.col("_last._rank") == F.col("_rank")) & (F.col("_last._id") == F.col("_id")))
    copies = F.col("_whole") + F.when(F.coalesce(chosen, F.lit(False)), 1).otherwise(0)
    decided = (shared(full) if carry else shares).join(cuts, "_key", "left").withColumn("copies", copies)
    return decided.withColumn("taken", F.col("copies") * F.col("size")).select(*RESULT, *extra)
