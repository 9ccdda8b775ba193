"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A source whose target exceeds its size is taken in complete epochs first; the rest is a
weighted sample without replacement: each document draws an exponential key scaled by its
quality weight, documents are taken in key order until the token budget is met.

The order within a source is cut into ranges of the key, so that no source is sorted or
summed in one task: ranges are added up first, then rows are ordered within their range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.llm.common import keep, words

SHARE = 1.5  # of all sizes that the mix has
WEIGHTS = (5, 2, 1)  # of the sources in their order, repeating
MOST = 2.0  # times its size that a source may be taken
ROWS_PER_RANGE = 4_000
SEED = 17


def sizes(docs: DataFrame, *carry: Column) -> DataFrame:
    """The ``carry`` columns (default doc_id, source) and ``size``, the words of the whole text."""
    carry = carry or (F.col("doc_id"), F.col("source"))
    return docs.select(*carry, F.size(words(F.col("text"))).cast("long").alias("size"))


def source_targets(
    sized: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """(source, source_size, target, docs): one row per source, null being a source of its own.

    Sources share the budget by weight; none gets more than ``most`` times its size, and
    what is cut off is shared again among the others. The level of this sharing comes in
    closed form: with sources ordered by capacity per weight, the full ones are a prefix.
    """
    totals = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs")
    )
    # one row per source from here on: windows over the few sources, not over documents
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(weights)
    weighted = totals.withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place + 1)
    ).withColumn("room", F.col("source_size") * most)
    filling = Window.orderBy(F.col("room") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    budget = F.sum("source_size").over(everything) * share
    spent = F.coalesce(F.sum("room").over(before), F.lit(0.0))
    left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    # the level if this source is the first that is not full; the true one is the highest
    level = weighted.withColumn(
        "level", F.greatest(F.lit(0.0), (budget - spent) / left)
    ).withColumn("full", F.col("room") <= F.col("level") * F.col("weight"))
    first_open = F.min(F.when(~F.col("full"), F.struct(F.col("room") / F.col("weight"), "level"))).over(
        everything
    )["level"]
    return level.select(
        "source",
        "source_size",
        F.when(F.col("full") | first_open.isNull(), F.col("room"))
        .otherwise(first_open * F.col("weight"))
        .alias("target"),
        "docs",
    )


def draw_key(doc_id: Column, weight: Column, seed: int = SEED) -> Column:
    """Exponential key -ln(u) / weight, u uniform in (0, 1) from a hash of the id."""
    bits = F.shiftrightunsigned(F.xxhash64(F.coalesce(doc_id, F.lit(-1)), F.lit(seed)), 11)
    u = (bits.cast("double") + 0.5) / float(1 << 53)
    return -F.log(u) / weight


def quality_weights(labels: DataFrame) -> DataFrame:
    """(doc_id, weight): 2 for documents labelled good, 0.5 for bad; others weigh 1."""
    return (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.when(F.min("quality") > 0, 2.0).otherwise(0.5).alias("weight"))
    )


def _named(source: Column) -> Column:
    """Text that tells sources apart, a null source included."""
    return F.coalesce(F.concat(F.lit("source "), source), F.lit("none"))


def mix(sized: DataFrame, weights_by_doc: DataFrame | None = None, **options) -> DataFrame:
    """One row per row of ``sized`` with source_size, target, ``copies`` and ``taken``.

    ``sized`` has doc_id, source, size (see ``sizes``); other columns are carried along.
    ``copies`` is how often the document is in the mix, ``taken`` its words there. All rows
    get the source's complete epochs; the document at the end of the fractional part is
    taken if that brings the source nearer to its target. Ties of the key (repeated ids) go
    by id and size. Documents without words are taken as often as their epochs. An empty
    table gives no rows. The draw depends on ids and weights only, so reruns agree.
    """
    targets = keep(source_targets(sized, **options), "mix-targets")
    rows_most = targets.agg(F.max("docs")).first()[0] or 1
    ranges = max(1, -(-rows_most // ROWS_PER_RANGE))

    rows = sized
    if weights_by_doc is not None:
        given = weights_by_doc.select("doc_id", F.col("weight").alias("weight_"))
        rows = rows.join(given, "doc_id", "left")
        weight = F.coalesce("weight_", F.lit(1.0))
    else:
        weight = F.lit(1.0)
    key = draw_key(F.col("doc_id"), weight)
    # 1 - exp(-key) rises with the key and spreads the rows over all ranges
    part = F.floor((1 - F.exp(-key)) * ranges).cast("int")
    keyed = rows.select(
        *[F.col(f"`{c}`") for c in sized.columns],
        _named(F.col("source")).alias("name_"),
        key.alias("key_"),
        F.least(part, F.lit(ranges - 1)).alias("range_"),
    )
    by_range = Window.partitionBy("name_").orderBy("range_")
    starts = (
        keyed.groupBy("name_", "range_")
        .agg(F.sum("size").alias("in_range_"))
        .withColumn("start_", F.sum("in_range_").over(by_range) - F.col("in_range_"))
        .drop("in_range_")
    )
    plan = starts.join(
        targets.select(_named(F.col("source")).alias("name_"), "source_size", "target"), "name_"
    )
    within = Window.partitionBy("name_", "range_").orderBy("key_", "doc_id", "size")
    upto = F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0))
    # the join has the window's keys, so rows are shuffled for both at once
    joined = keyed.withColumn("upto_", upto).join(plan, ["name_", "range_"])
    epochs = F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1)))
    rest = F.col("target") - epochs * F.col("source_size")
    middle = F.col("start_") + F.col("upto_") - F.col("size") / 2
    copies = (epochs + (middle < rest).cast("int")).cast("int")
    return joined.select(
        *[F.col(f"`{c}`") for c in sized.columns],
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"),
    )
