"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime size.  The shards
take turns, each claiming its most preferred free slot, until the table is full; so shares differ
by one slot at most, and adding or removing a shard moves little else.  A row's slot is its key's
hash modulo the prime, and the table (a fixed number of rows) is broadcast: placement is one
look-up, no shuffle, and no key, however frequent, changes the cost.
"""
from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import free_name

SHARDS = 32
SLOTS = 4099  # prime, over 100 slots a shard
ROWS_A_FILE = 1_000_000


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def preference(name: str, slots: int) -> tuple[int, int]:
    """Start and step of a shard's walk over the slots (every step visits all, slots being prime)."""
    return _number(f"start {name}") % slots, _number(f"step {name}") % (slots - 1) + 1


def fill_table(shards: list[str], slots: int = SLOTS, weights: list[int] | None = None) -> list[int]:
    """Shard number of every slot.  With weights a shard claims so many slots at each turn."""
    if slots < len(shards) or slots < 3 or any(slots % d == 0 for d in range(2, int(slots ** 0.5) + 1)):
        raise ValueError("a prime number of slots, no fewer than shards, is needed")
    if not shards or any(w < 0 for w in weights or []) or (weights and not sum(weights)):
        raise ValueError("at least one shard with a positive weight is needed")
    walks = [preference(s, slots) for s in shards]
    at, table, free = [0] * len(shards), [-1] * slots, slots
    while free:
        for i, (start, step) in enumerate(walks):
            for _ in range(weights[i] if weights else 1):
                while free and table[slot := (start + at[i] * step) % slots] >= 0:
                    at[i] += 1
                if free:
                    table[slot] = i
                    free -= 1
    return table


def names(n: int) -> list[str]:
    return [f"shard-{i}" for i in range(n)]


def table_frame(spark: SparkSession, table: list[int]) -> DataFrame:
    """(slot, shard) rows of a table, made by the JVM from one literal."""
    text = F.split(F.lit(",".join(map(str, table))), ",")
    return spark.range(1).select(F.posexplode(text).alias("__slot", "__shard")).select(
        F.col("__slot").cast("long"), F.col("__shard").cast("int"))


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key (string): the first 60 bits of its MD5 modulo the number of slots."""
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long") % slots


def row_key(df: DataFrame, key: str = "doc_id", instead: tuple[str, ...] = ("source", "lang", "n_chars")) -> Column:
    """The key as a string; where it is null, the row's columns `instead` as far as there are any,
    so that rows without a key spread too."""
    other = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in instead if c in df.columns]
    return F.coalesce(F.col(f"`{key}`").cast("string"), F.concat_ws("|", F.lit("null"), *other))


def place(df: DataFrame, shards: list[str] | None = None, slots: int = SLOTS, key: str = "doc_id") -> DataFrame:
    """`df` with columns slot (long) and shard (int), replaced if there.  Row by row: repeated rows
    go to the same shard, extra columns stay, an empty table gives an empty result."""
    table = table_frame(df.sparkSession, fill_table(shards or names(SHARDS), slots))
    own, at, shard = (free_name(df, n) for n in ("__own", "__slot", "__shard"))
    out = df.withColumn(own, slot_of(row_key(df, key), slots)).join(
        F.broadcast(table.toDF(at, shard)), F.col(own) == F.col(at))
    return out.withColumns({"slot": F.col(at), "shard": F.col(shard)}).drop(own, at, shard)


def write_shards(df: DataFrame, path: str, files: int | None = None) -> None:
    """One folder per shard, in about `files` files each, by default as many as hold ROWS_A_FILE rows of the
    largest shard.  A shard's rows are dealt over its files by a hash of the row, so a rerun deals them alike
    and a shard need not fit one task; repeated rows meet in one file.  Rows with a null shard get a folder
    of their own, null ids and texts and extra columns stay, an empty table writes no shard."""
    shards, most = df.groupBy("shard").count().agg(F.count(F.lit(1)), F.max("count")).first()
    files = files or -(-(most or 1) // ROWS_A_FILE)
    names = [F.col(f"`{c}`") for c in df.columns if "map<" not in df.schema[c].dataType.simpleString()]
    dealt = df.repartition(max(1, shards * files), F.col("shard"), F.pmod(F.xxhash64(*names), F.lit(files)))
    dealt.write.partitionBy("shard").parquet(path)
