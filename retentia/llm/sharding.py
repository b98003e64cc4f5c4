"""Sharding by a permutation-filled lookup table (consistent hashing with equal shares).

Each shard has its own order of preference over the slots of a prime-sized table, given by an offset and a
stride. The shards take turns; at its turn a shard claims the first slot of its order that is still free. So
the shards' slot counts differ by one at most, and a shard that leaves moves little beside its own slots. A row
is placed by one hash and one look-up in the broadcast table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retentia.llm.common import draw, fresh

MAX_TABLE = 1 << 20  # slots; the table is broadcast, so its size is a checked setting and never follows the data


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _stable(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill_slots(shards: Sequence[str], size: int) -> list[int]:
    """The shard number of every slot. Work and result depend on the settings only."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct names, one at least")
    if not _is_prime(size) or not len(shards) <= size <= MAX_TABLE:
        raise ValueError(f"the table size must be a prime between the number of shards and {MAX_TABLE}")
    at = [_stable(f"{s}:offset") % size for s in shards]
    stride = [_stable(f"{s}:stride") % (size - 1) + 1 for s in shards] if size > 2 else [1] * len(shards)
    owner, free = [-1] * size, size
    while free:
        for shard in range(len(shards)):
            while owner[at[shard]] >= 0:
                at[shard] = (at[shard] + stride[shard]) % size
            owner[at[shard]] = shard
            free -= 1
            if not free:
                break
    return owner


def slot_table(spark: SparkSession, shards: Sequence[str], size: int) -> DataFrame:
    """(slot, shard) rows, from one literal."""
    owners = ",".join(map(str, fill_slots(shards, size)))
    names = F.array(*[F.lit(s) for s in shards])
    slots = spark.range(1).select(F.posexplode(F.split(F.lit(owners), ",")).alias("slot", "owner"))
    return slots.select("slot", F.get(names, F.col("owner").cast("int")).alias("shard"))


def assign_shards(df: DataFrame, key: str | Column, shards: Sequence[str], size: int, seed: int = 0) -> DataFrame:
    """``df`` with the columns ``slot`` and ``shard``. No shuffle: one hash and one broadcast look-up per row.

    Equal keys share a slot; null keys go together, to the slot of the empty string. An empty table stays
    empty. Columns of ``df`` already named slot or shard are replaced.
    """
    key = F.col(key) if isinstance(key, str) else key
    at, name = fresh(df, "_slot"), fresh(df, "_shard")
    table = slot_table(df.sparkSession, shards, size).select(F.col("slot").alias(at), F.col("shard").alias(name))
    placed = df.withColumn(at, F.pmod(draw(seed, "shard", key), F.lit(size)).cast("int"))
    joined = placed.join(F.broadcast(table), at)
    keep = [c for c in df.columns if c.lower() not in ("slot", "shard")]
    return joined.select(*keep, F.col(at).alias("slot"), F.col(name).alias("shard"))
