"""Sharding by a permutation-filled lookup table.

Each shard has its own order of preference over the slots of a table of prime size: it starts
at one slot and goes on by a fixed step, which visits every slot because the size is prime.
The shards take turns; in its turn a shard claims the next slot of its order that is free.
Slots end up spread evenly, and a shard that joins or leaves moves few of them.

A row's key is hashed to a slot and the slot names the shard: one broadcast hash lookup per
row, no shuffle. The table has ``slots`` rows whatever the input, so its broadcast is bounded.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitmart.llm.common import staged

#: Slots of the table; prime, and far more than shards, so that shares differ by under a percent.
SLOTS = 65537
SHARDS = 64
#: Hex digits of a key's MD5 that are read as its number: 60 bits, never negative.
DIGITS = 15


def _digest(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:DIGITS], 16)


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The index of the shard that owns each slot.

    ``slots`` must be prime and at least the number of shards, names must differ.
    """
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must have names that differ")
    if slots < max(2, len(shards)) or any(slots % n == 0 for n in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be a prime number, no smaller than the number of shards")
    at = [_digest(f"start:{name}") % slots for name in shards]
    step = [_digest(f"step:{name}") % (slots - 1) + 1 for name in shards]
    owner = [-1] * slots
    free = slots
    while free:
        for shard in range(len(shards)):
            while owner[at[shard]] >= 0:
                at[shard] = (at[shard] + step[shard]) % slots
            owner[at[shard]] = shard
            free -= 1
            if not free:
                break
    return owner


def slot_of(key: Column, slots: int) -> Column:
    """The slot of a key, by its text; a null key counts as empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, DIGITS), 16, 10).cast("long") % F.lit(slots)


def table_frame(spark: SparkSession, owner: list[int]) -> DataFrame:
    """The lookup table as rows (owned, owner)."""
    return spark.sql(
        "SELECT CAST(pos AS bigint) AS owned, CAST(col AS int) AS owner FROM (SELECT posexplode(split(:owners, ',')))",
        args={"owners": ",".join(map(str, owner))},
    )


def place(rows: DataFrame, key: str, shards: list[str] | None = None, slots: int = SLOTS) -> DataFrame:
    """All rows with ``slot`` (long) and ``shard`` (int, index into ``shards``).

    Rows of equal keys share a shard; so do rows whose key is null. Columns of the input that
    have the names of the new ones are replaced. An empty input gives an empty result.
    """
    names = shards or [f"shard-{n}" for n in range(SHARDS)]
    owners = table_frame(rows.sparkSession, lookup_table(names, slots))
    other = [c for c in rows.columns if c.lower() not in ("slot", "shard")]
    keyed = rows.select(*[F.col(f"`{c}`") for c in other], slot_of(F.col(f"`{key}`"), slots).alias("slot"))
    # The outer join keeps every row by construction; each slot is in the table.
    found = keyed.join(F.broadcast(owners), keyed["slot"] == owners["owned"], "left")
    return found.select(*[keyed[f"`{c}`"] for c in keyed.columns], owners["owner"].alias("shard"))


#: Bytes of rows, before compression, that a writer of a shard takes, about.
WRITER_BYTES = 256 << 20


def _row_bytes(rows: DataFrame) -> Column:
    """About the bytes of a row: those of its texts, and eight for every other column."""
    texts = [field.name for field in rows.schema if field.dataType.simpleString() in ("string", "binary")]
    size = F.lit(8 * (len(rows.columns) - len(texts))).cast("long")
    for name in texts:
        size = size + F.coalesce(F.octet_length(F.col(f"`{name}`")).cast("long"), F.lit(0))
    return size


def write_shards(placed: DataFrame, path: str, writer_bytes: int = WRITER_BYTES) -> None:
    """Placed rows as one folder per shard.

    The bytes of each shard are counted first, and its rows dealt over as many writers as these ask
    for, in turn by row number: neither a large input nor a shard with a hot key is one task's file.
    """
    sizes = placed.groupBy("shard").agg(F.sum(_row_bytes(placed)).alias("_bytes"))
    # One row for each shard, so never more than the lookup table has slots.
    writers = staged(sizes.select("shard", F.greatest(F.ceil(F.col("_bytes") / writer_bytes), F.lit(1)).alias("_writers")), "shard_writers")
    total = writers.agg(F.coalesce(F.sum("_writers"), F.lit(1))).first()[0]
    numbered = placed.withColumn("_number", F.monotonically_increasing_id()).join(F.broadcast(writers), "shard")
    # At least two tasks for each writer, so that few writers meet in one, however small the session's number is.
    tasks = max(2 * total, int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = numbered.repartition(tasks, F.col("shard"), F.pmod("_number", "_writers"))
    dealt.select(*[F.col(f"`{c}`") for c in placed.columns]).write.partitionBy("shard").parquet(path)
