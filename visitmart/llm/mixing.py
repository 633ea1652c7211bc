"""Mixing sources to target weights by weighted fair queueing.

Sources are weighed in the order of their names (code points, null last) by a repeating list
of weights. They share a budget, a multiple of all tokens, by weight; no source gets more than
``max_repeats`` times what it holds, and what it can't take is shared again by the others.

The documents of a source are shuffled by a hash and queued ``max_repeats`` times, one pass
after the other. A queued document finishes at the virtual time (tokens of its source up to
and with it) / (target of its source). All queues are put into one order by that time, sorted
by range over the cluster, and the order is cut at the budget. Each source then has been
served in step with its target.

Running sums are two-level scans: documents in small groups, then sums of the groups. No task
holds a source, however hot it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitmart.llm.common import staged

WEIGHTS = (5, 2, 1)
BUDGET_PERCENT = 150
MAX_REPEATS = 2
WORD = r"[^\x20\x09-\x0D]+"
#: Documents whose running sum one task makes at once.
GROUP_DOCS = 20_000


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, percent: int = BUDGET_PERCENT, repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    With limits ``repeats * source_size`` the targets are ``min(limit, weight * level)`` for
    the one level at which they add up to the budget. In the order of limit / weight, the
    sources before some point get their limit; the level follows from what the others share.
    The windows run over one row per source, not over documents.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    index = F.row_number().over(in_order) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (index % len(weights) + 1).cast("int"))
    filling = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    levels = by_source.withColumn("weight", weight.cast("long")).select(
        "source",
        "source_size",
        "weight",
        (F.sum("source_size").over(everything) * percent / 100).alias("budget"),
        F.coalesce(F.sum(F.col("source_size") * repeats).over(before), F.lit(0)).alias("filled"),
        F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing)).alias("sharing"),
        F.row_number().over(filling).alias("place"),
    )
    level = (F.col("budget") - F.col("filled")) / F.col("sharing")
    # The first source, in filling order, that stays under its limit sets the level; none does if all are full.
    open_place = F.when(F.col("weight") * level <= F.col("source_size") * repeats, F.col("place"))
    found = levels.withColumn("level", F.min_by(level, open_place).over(everything))
    limit = (F.col("source_size") * repeats).cast("double")
    return found.select(
        "source",
        "source_size",
        F.coalesce(F.least(limit, F.col("weight") * F.col("level")), limit).alias("target"),
    )


def _scanned(rows: DataFrame, group: list[str], part: str, order: list[Column], value: str, out: str) -> DataFrame:
    """Running sums of ``value`` within ``group``, in the order of (part, order): sums of parts, then inside parts."""
    parts = rows.groupBy(*group, part).agg(F.sum(value).alias("_part_sum"))
    ahead = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_ahead", F.coalesce(F.sum("_part_sum").over(ahead), F.lit(0))).drop("_part_sum")
    named = parts.select(*[F.col(c).alias(f"_{c}") for c in [*group, part]], "_ahead")
    same = None
    for c in [*group, part]:
        meets = rows[c].eqNullSafe(named[f"_{c}"])
        same = meets if same is None else same & meets
    inside = Window.partitionBy(*group, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = rows.join(named, same, "left").drop(*[f"_{c}" for c in [*group, part]])
    return joined.withColumn(out, F.col("_ahead") + F.sum(value).over(inside)).drop("_ahead")


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    percent: int = BUDGET_PERCENT,
    repeats: int = MAX_REPEATS,
    seed: int = 0,
    group_docs: int = GROUP_DOCS,
    row_col: str | None = None,
) -> DataFrame:
    """(row, doc_id, source, size, source_size, target, passes, taken) for every row of (doc_id, source, text).

    ``passes`` are the times the document lies before the cut, ``taken`` is ``size`` times
    these. ``row`` is the long column ``row_col``, if that is given, and else any number. Equal
    seeds give equal results. Null texts and texts without words have size 0 and take 0; a
    source of such texts only has target 0. Null sources are one source, the last. Rows
    repeated in full are documents of their own that follow each other in the queue, in an
    order that does not matter to their sizes. No rows in, no rows out.
    """
    named = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text").cast("string")).alias("size"),
        (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row"),
    )
    sized = staged(named, "mix_sizes")
    targets = staged(source_targets(sized, weights, percent, repeats), "mix_targets")
    total = sized.agg(F.count("*").alias("rows"), F.coalesce(F.sum("size"), F.lit(0)).alias("size")).first()
    budget = total["size"] * min(percent, 100 * repeats) / 100

    # A document's place in its source's shuffle: its hash, and among equal ids what follows it. The shuffle is cut into
    # ranges of about group_docs documents by all of this, so that rows of one id are cut as well.
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"))
    last = [F.col("digest"), F.col("doc_id"), F.col("size"), F.col("row")]
    in_source = [F.col("source").isNull(), F.col("source"), *last]
    shuffled = sized.withColumn("digest", digest).repartitionByRange(max(1, total["rows"] // group_docs), *in_source)
    shuffled = staged(shuffled.withColumn("part", F.spark_partition_id()), "mix_shuffled")
    queued = _scanned(shuffled, ["source"], "part", last, "size", "upto")

    same_source = queued["source"].eqNullSafe(targets["source"])
    with_target = queued.join(targets, same_source, "left").drop(targets["source"]).drop("part")
    rounds = with_target.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    finish = (F.col("upto") + F.col("pass") * F.col("source_size")) / F.col("target")
    timed = rounds.withColumn("finish", F.when(F.col("target") > 0, finish)).where("finish IS NOT NULL")

    # One global order by finish time; the number of a row's range is kept with it in the staged table.
    order = [F.col("finish"), F.col("source").isNull(), F.col("source"), F.col("pass"), *last]
    ranged = timed.repartitionByRange(max(1, repeats * total["rows"] // group_docs), *order)
    ranged = staged(ranged.withColumn("range", F.spark_partition_id()), "mix_order")
    served = _scanned(ranged, [], "range", order, "size", "served")
    passes = served.where(F.col("served") <= F.lit(budget)).groupBy("row").agg(F.count("*").alias("passes"))
    counted = sized.join(passes, "row", "left").withColumn("passes", F.coalesce("passes", F.lit(0).cast("long")))
    own = counted["source"].eqNullSafe(targets["source"])
    return counted.join(targets, own, "left").select(
        "row",
        "doc_id",
        counted["source"],
        "size",
        "source_size",
        "target",
        "passes",
        (F.col("size") * F.col("passes")).alias("taken"),
    )
