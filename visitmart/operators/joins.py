"""Joins whose keys can be very uneven."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SALT = "__salt"

# Most that a broadcast side may hold: rows, and bytes of them as JSON text.
BROADCAST_ROWS = 1000
BROADCAST_BYTES = 8 << 20


def fits_broadcast(frame: DataFrame) -> bool:
    """True if the frame is counted to be small: one aggregate, of which a row per task is moved."""
    size = F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*frame.columns)))), F.lit(0))
    rows, size = frame.agg(F.count("*"), size).first()
    return rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def single_key_join(facts: DataFrame, facts_key: str, lookup: DataFrame, lookup_key: str, value) -> DataFrame:
    """Inner join of the rows that carry one key value on both sides.

    All rows share the key, so a shuffle join on it alone would run in one task. The
    lookup rows are counted first, when the plan is built. A few of them are broadcast. If
    they are many, the fact rows' input partition becomes part of the join key, which also
    spreads copies of one row, and the lookup rows are repeated for each of its values.

    The lookup is meant to hold the key once. If it repeats it, each fact row comes once per
    lookup row, so the result has as many rows as the two counts multiplied.
    """
    left = facts.where(F.col(facts_key) == value)
    right = lookup.where(F.col(lookup_key) == value)
    if fits_broadcast(right):
        return left.join(F.broadcast(right), left[facts_key] == right[lookup_key], "inner")
    partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = 1 << (partitions - 1).bit_length()
    # The partition number, not a random one: a re-run task gives the same salt.
    left = left.withColumn(_SALT, F.spark_partition_id().bitwiseAND(F.lit(salts - 1)))
    # Spark's size estimate does not see the repetition, so it must not choose a broadcast here.
    right = right.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("merge")
    match = (left[facts_key] == right[lookup_key]) & (left[_SALT] == right[_SALT])
    return left.join(right, match, "inner").drop(left[_SALT]).drop(right[_SALT])


def full_outer_chain(first: DataFrame, others: Sequence[DataFrame], key: str) -> DataFrame:
    """Full outer joins of the other frames, one after the other, all on the first frame's key.

    Each frame has one row per key, as a GROUP BY gives, and value columns of its own names. The
    result's key is the first frame's: rows without a partner there have a NULL key and stay
    apart, as do all rows whose own key is NULL.

    No join is run. The frames are stacked and gathered by key once, and what each key has is
    then written out as the rows that the joins would give. So the rows without a partner are
    spread by the keys that they still have, and never meet under their NULL. A frame that repeats
    a key, or NULL, ends the query with an error that names both: its rows can't be told apart here.
    """
    sides = [first, *others]
    values = [[name for name in side.columns if name != key] for side in sides]
    on = [f"__on_{at}" for at in range(len(sides))]
    stacked = None
    for at, side in enumerate(sides):
        rows = side.withColumn(on[at], F.lit(True))
        stacked = rows if stacked is None else stacked.unionByName(rows, allowMissingColumns=True)
    gathered = stacked.groupBy(key).agg(
        *[F.first(name, ignorenulls=True).alias(name) for names in values for name in names],
        *[F.count(flag).alias(flag) for flag in on],
    )
    for at, flag in enumerate(on):
        repeated = F.concat(F.lit(f"frame {at} of the chain repeats the key "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))
        gathered = gathered.withColumn(flag, F.when(F.col(flag) > 1, F.raise_error(repeated)).otherwise(F.col(flag) > 0))
    partners = F.col(key).isNotNull() & F.col(on[0])
    together = F.when(partners, F.array(*on))
    apart = [
        F.when(~partners & F.col(flag), F.array(*[F.lit(other == flag) for other in on])) for flag in on
    ]
    seen = gathered.withColumn("__seen", F.explode(F.array(together, *apart))).where("__seen IS NOT NULL")
    return seen.select(
        F.when(F.get("__seen", F.lit(0)), F.col(key)).alias(key),
        *[F.when(F.get("__seen", F.lit(at)), F.col(name)).alias(name) for at, names in enumerate(values) for name in names],
    )
