"""Placement of documents on shards by a permutation-filled lookup table.

Every shard orders the slots of a prime-sized table by a permutation of its own
(an offset and a step taken from hashes of its name).  The shards take turns,
as often per round as their weight says, each claiming its next free slot,
until the table is full.  A document's key hashes to a slot, and the table says
which shard holds it: one probe, whatever the number of documents.  When a
shard leaves, the slots of the others hardly move.

The table has ``slots`` rows, a parameter bounded at 2**20, so it is filled
once, written into the plan and broadcast; documents are only projected and
probed, never shuffled.  A null key is placed like an empty one, and repeated
keys land together.  An empty input gives an empty result.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Parameters of the registered query.
SHARDS = tuple(f"shard-{i:02d}" for i in range(24))
SLOTS = 16381


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill_table(shards: tuple[str, ...], slots: int = SLOTS, weights: dict[str, int] | None = None) -> list[int]:
    """Index of the shard in ``shards`` that holds each slot."""
    if not _is_prime(slots) or slots > 1 << 20:
        raise ValueError("slots must be a prime below 2**20")
    if not shards or len(set(shards)) != len(shards) or len(shards) > slots:
        raise ValueError("shards must be distinct names, at least one and at most one per slot")
    at = [_number("offset:" + s) % slots for s in shards]
    step = [_number("step:" + s) % (slots - 1) + 1 for s in shards]
    turns = [max(1, (weights or {}).get(s, 1)) for s in shards]
    holder, free = [-1] * slots, slots
    while free:
        for i in range(len(shards)):
            for _ in range(min(turns[i], free)):
                while holder[at[i]] >= 0:
                    at[i] = (at[i] + step[i]) % slots
                holder[at[i]] = i
                free -= 1
    return holder


def table_frame(spark: SparkSession, shards: tuple[str, ...], slots: int = SLOTS, weights=None) -> DataFrame:
    """(slot, shard) rows of the filled table."""
    holders = ",".join(map(str, fill_table(shards, slots, weights)))
    names = F.array(*[F.lit(s) for s in shards])
    rows = spark.range(1).select(F.posexplode(F.split(F.lit(holders), ",")).alias("slot", "holder"))
    return rows.select("slot", F.element_at(names, F.col("holder").cast("int") + 1).alias("shard"))


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """60 bits of the key's md5 modulo the table size."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long"), F.lit(slots)).cast("int")


def place(
    docs: DataFrame,
    shards: tuple[str, ...] = SHARDS,
    slots: int = SLOTS,
    key_col: str = "doc_id",
    weights: dict[str, int] | None = None,
) -> DataFrame:
    """``docs`` with ``slot`` and ``shard`` (columns of those names are replaced)."""
    table = table_frame(docs.sparkSession, shards, slots, weights)
    rest = docs.drop("slot", "shard").withColumn("slot", slot_of(F.col(key_col), slots))
    return rest.join(F.broadcast(table), "slot")  # ``slots`` rows
