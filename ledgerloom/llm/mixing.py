"""Mixing sources to target weights by weighted fair queueing.

Each source's documents are shuffled by a hash of id and text and queued, pass after pass over the source;
a document's virtual finish time is the words its source has queued up to it, divided by the source's
target. Merged in order of finish time, the sources advance in proportion to their targets; the
merged queue is cut where the budget is used up. Built-in functions only.

* Targets share the budget by weight. None is above ``passes`` times its source's size; what is over goes
  to the others by weight until none is above (the water level in :func:`_targets`).
* Running sums are two-level: a source's shuffled queue is dealt into about sqrt(rows) ranges, the sums of the
  ranges are added up in order, then the rows inside each range. So a source with a third of all rows is
  spread over many tasks. The merged queue is treated alike: finish times form about sqrt(rows) ranges,
  and only the range in which the budget runs out is sorted by row, since the order inside ranges
  that are taken in full, or not at all, cannot change what is taken.
* What the driver reads is one row at a time: totals, the range of the cut, the cut.

Defined results: null text has size 0; null is a source of its own, last in order; sources are ordered by
code point and weighted in that order, the weights repeating; rows that repeat in full are taken one by one.
Documents without words take nothing. Reruns give the same result, whatever the partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.common import WORD, cut, text_or_empty

WEIGHTS = (1, 2, 3)
PASSES = 3


def _row_key() -> Column:
    """Shuffles the documents of a source; the same on every run."""
    identity = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text_or_empty().cast("binary")))
    return F.md5(identity.cast("binary"))


def _fraction(key: Column) -> Column:
    """The key's place in [0, 1)."""
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def _sizes(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id", F.col("source").cast("string").alias("source"),
        F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size"), _row_key().alias("key"),
    )


def _targets(sizes: DataFrame, weights: Sequence[int], passes: int, budget: int | None) -> DataFrame:
    """One row for each source: rows, source_size, target. Windows run over the list of sources only."""
    everywhere = W.partitionBy()
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    place = F.row_number().over(everywhere.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((place - 1) % len(weights) + 1).cast("int")).cast("double")
    sources = sources.withColumn("weight", weight)
    total = F.sum("source_size").over(everywhere) if budget is None else F.lit(budget)
    most = F.col("source_size") * passes
    # in the order in which rising water reaches each source's limit
    order = everywhere.orderBy(most / F.col("weight"), "weight", F.col("source").asc_nulls_last())
    filled = F.coalesce(F.sum(most).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    level = (total - filled).cast("double") / open_weight
    sources = sources.withColumn("level", level).withColumn("step", F.row_number().over(order))
    holds = F.when(most >= F.col("level") * F.col("weight"), F.struct("step", "level"))
    sources = sources.withColumn("water", F.min(holds).over(everywhere))
    target = F.when(
        F.col("water").isNull() | (F.col("step") < F.col("water.step")), most.cast("double")
    ).otherwise(F.col("water.level") * F.col("weight"))
    return sources.select(F.col("source").alias("of_source"), "source_size", "n", target.alias("target"))


def _queued(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Each row with the words queued in its source up to and with it, in one pass over the source."""
    rows = sizes.join(targets, F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source")
    rows = rows.withColumn("part", F.floor(_fraction(F.col("key")) * F.ceil(F.sqrt("n"))).cast("long"))
    sums = rows.groupBy(F.col("source").alias("s"), F.col("part").alias("p")).agg(F.sum("size").alias("words"))
    before = F.sum("words").over(W.partitionBy("s").orderBy("p")) - F.col("words")
    sums = sums.select("s", "p", before.alias("before"))
    inside = W.partitionBy("source", "part").orderBy("key", "size").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("inside", F.sum("size").over(inside))
    return rows.join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p"))).select(
        "doc_id", "source", "size", "key", "source_size", "target", (F.col("before") + F.col("inside")).alias("queued"),
    )


def _finish(nth: Column) -> Column:
    """Virtual finish time of a row in the given pass over its source (null where the target is 0)."""
    return F.when(F.col("target") > 0, (nth * F.col("source_size") + F.col("queued")).cast("double") / F.col("target"))


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, passes: int = PASSES, budget: int | None = None
) -> DataFrame:
    """Each row of docs: doc_id, source, size, source_size, target, times (how often it is taken), taken, key, queued."""
    sizes = cut(_sizes(docs))
    rows = cut(_queued(sizes, cut(_targets(sizes, weights, passes, budget))))
    totals = rows.agg(F.count("*"), F.sum("size")).first()
    total = (totals[1] or 0) if budget is None else budget
    ranges = max(1, int(totals[0] ** 0.5))

    turns = rows.select(
        "key", "size", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))).alias("nth"), "source_size", "queued", "target"
    ).select("key", "size", "nth", _finish(F.col("nth")).alias("finish")).where("finish IS NOT NULL")
    turns = turns.withColumn("range", F.floor((1 - 1 / (1 + F.col("finish"))) * ranges).cast("long"))
    sums = turns.groupBy("range").agg(F.sum("size").alias("words"))
    reached = F.sum("words").over(W.orderBy("range"))
    over = sums.select("range", "words", reached.alias("reached")).where(F.col("reached") > total)
    edge = over.orderBy("range").first()
    if edge is None:
        last = None
    else:
        running = F.sum("size").over(W.partitionBy("range").orderBy("finish", "key", "nth").rowsBetween(W.unboundedPreceding, 0))
        left = total - (edge["reached"] - edge["words"])
        last = (
            turns.where(F.col("range") == edge["range"]).withColumn("running", running).where(F.col("running") <= left)
            .agg(F.max(F.struct("finish", "key", "nth")).alias("last")).first()["last"]
        )

    def taken_in(nth: int) -> Column:
        finish = _finish(F.lit(nth))
        place = F.floor((1 - 1 / (1 + finish)) * ranges)
        if edge is None:
            inside = finish.isNotNull()
        else:
            inside = place < edge["range"]
            if last is not None:
                here = F.struct(finish.alias("finish"), F.col("key"), F.lit(nth).alias("nth"))
                cut_at = F.struct(F.lit(last["finish"]).alias("finish"), F.lit(last["key"]).alias("key"), F.lit(last["nth"]).alias("nth"))
                inside = inside | ((place == edge["range"]) & (here <= cut_at))
        return F.coalesce(inside, F.lit(False)).cast("long")

    times = sum((taken_in(nth) for nth in range(1, passes)), taken_in(0))
    rows = rows.withColumn("times", times)
    return rows.select(
        "doc_id", "source", "size", "source_size", "target", "times", (F.col("times") * F.col("size")).alias("taken"), "key",
        "queued",
    )


def mixed_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, passes: int = PASSES) -> DataFrame:
    """The documents of the mix in the order of their virtual finish times, each as often as it is taken, with their columns.

    A global range sort gives the order, so what a reader has taken from the front is near the targets at any point.

    Rows of a source that repeat id and text share what is taken of them; where it does not divide, the first in the
    order of the input are written once more. These are numbered in two levels, by input partition and inside it.
    """
    queue = ["queued", "source_size", "target"]
    taken = mix(docs, weights, passes).groupBy("key", "source").agg(
        F.sum("times").alias("all_times"), F.count("*").alias("copies"), *[F.min(c).alias(c) for c in queue]
    )
    taken = taken.where("all_times > 0").withColumn("odd", F.col("all_times") % F.col("copies"))
    taken = taken.withColumn("times", F.expr("all_times div copies")).select("key", "source", "times", "odd", *queue)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("row"), _row_key().alias("row_key"), F.col("source").cast("string").alias("row_source"))
    same = (F.col("row_key") == F.col("key")) & F.col("row_source").eqNullSafe(F.col("source"))
    made = rows.join(taken.where("odd = 0"), same).select("row", "times", "key", *queue)

    uneven = cut(taken.where("odd > 0"))
    if not uneven.isEmpty():
        placed = rows.withColumn("part", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id())
        placed = cut(placed.join(uneven, same).drop("row_key", "row_source"))
        sums = placed.groupBy(F.col("key").alias("k"), F.col("source").alias("s"), F.col("part").alias("p")).agg(F.count("*").alias("here"))
        sums = sums.withColumn("before", F.sum("here").over(W.partitionBy("k", "s").orderBy("p")) - F.col("here"))
        placed = placed.withColumn("nth", F.row_number().over(W.partitionBy("key", "source", "part").orderBy("place")))
        placed = placed.join(sums, (F.col("key") == F.col("k")) & F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
        once_more = (F.col("before") + F.col("nth") <= F.col("odd")).cast("long")
        more = placed.select("row", (F.col("times") + once_more).alias("times"), "key", *queue)
        made = made.unionByName(more.where("times > 0"))
    turns = made.withColumn("nth", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)))
    return turns.withColumn("finish", _finish(F.col("nth"))).orderBy("finish", "key", "nth").select("row.*")
