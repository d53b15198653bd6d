"""Sharding by a permutation-filled lookup table, on DataFrame functions alone.

Every shard has its own order of preference over the slots of a table of prime size. The shards
take turns; at its turn a shard claims the first slot of its order that is still free. Slots so
differ by at most one between shards, and few move when a shard comes or goes. A document's
slot is a hash of its id modulo the table's size.

Edge cases: a null id hashes as the empty string; repeated ids share a slot; texts and other
columns are not looked at; an empty table gives no rows. Shard names must be distinct and not
be more than the slots.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A prime, more than a hundred times the number of shards.
SLOTS = 8191


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The shard number of every slot. The table has a fixed size and holds no data."""
    if not is_prime(slots) or len(set(shards)) != len(shards) or not 0 < len(shards) <= slots:
        raise ValueError("slots must be prime and at least as many as the distinct shards")
    place = [_number(f"{name}|offset") % slots for name in shards]
    skip = [_number(f"{name}|skip") % (slots - 1) + 1 for name in shards]
    table, free, turn = [-1] * slots, slots, 0
    while free:
        shard = turn % len(shards)
        while table[place[shard]] >= 0:
            place[shard] = (place[shard] + skip[shard]) % slots
        table[place[shard]] = shard
        free, turn = free - 1, turn + 1
    return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """A key's slot: the first 32 bits of its md5 modulo the table's size."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % slots


def table_frame(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """(slot, shard) as a frame of ``slots`` rows."""
    names = F.array(*[F.lit(name) for name in shards])
    numbers = F.split(F.lit(",".join(map(str, fill(shards, slots)))), ",")
    exploded = spark.range(1).select(F.posexplode(numbers).alias("slot", "number"))
    return exploded.select(
        F.col("slot").cast("long").alias("slot"),
        F.element_at(names, F.col("number").cast("int") + 1).alias("shard"),
    )


def place(
    docs: DataFrame, shards: list[str], slots: int = SLOTS, id_: str = "doc_id"
) -> DataFrame:
    """(id, slot, shard) of every row: one broadcast lookup, no shuffle."""
    table = table_frame(docs.sparkSession, shards, slots)
    # ``slots`` rows whatever the data: a proven bound.
    keyed = docs.select(F.col(id_), slot_of(F.col(id_), slots).alias("slot"))
    return keyed.join(F.broadcast(table), "slot").select(id_, "slot", "shard")
