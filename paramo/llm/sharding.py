"""Operator 6, sharding by a permutation-filled lookup table.

Every shard prefers the slots of a prime-sized table in the order
``(offset + j * skip) mod M``, with offset and skip hashed from its name.
The shards take turns; in its turn a shard claims the first slot of its
order that is still free.  So every shard gets floor(M / n) or
ceil(M / n) slots, and when a shard goes, few of the others' slots move.
A document is placed by hashing its key to a slot and looking the slot up.

The table has M rows for any corpus (M is a parameter, by default the
smallest prime of at least 100 slots a shard), so broadcasting it is bounded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paramo.llm.common import numbered, pick, position

#: Attempts at claiming a slot that one Spark expression makes before the state is looked at.
ATTEMPTS = 50_000
MAX_SLOTS = 1_000_003


def next_prime(n: int) -> int:
    """The smallest prime of at least ``n`` (and at least 2)."""
    n = max(2, n)
    while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def hashed(text: Column) -> Column:
    """60 bits of the MD5 of ``text`` as a long; DuckDB can compute the same."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def slot_of(key: Column, text: Column | None, slots: int) -> Column:
    """Slot of a key.  Rows without a key are spread by their text; rows without both share one slot."""
    parts = [key.cast("string")] + ([F.concat(F.lit("text:"), F.md5(text))] if text is not None else [])
    return F.pmod(hashed(F.coalesce(*parts, F.lit("none"))), F.lit(slots))


def lookup_table(spark: SparkSession, shards: Sequence[str], slots: int | None = None) -> DataFrame:
    """``(slot, shard)``: index into ``shards`` for each of the ``slots`` slots.

    The claiming is a fold over attempts inside one Spark expression; its
    state is the table as bytes (two a slot), each shard's next position, the
    shard whose turn it is, its position, and the number of claimed slots.
    Raises ValueError for no shards, repeated names, or a table that is not
    prime, smaller than the shards, or above ``MAX_SLOTS``."""
    n, m = len(shards), slots or next_prime(100 * max(1, len(shards)))
    if not 0 < n < 65_535 or len(set(shards)) < n:
        raise ValueError("the shards need distinct names, at least one and under 65,535")
    if m < n or m > MAX_SLOTS or next_prime(m) != m:
        raise ValueError(f"{m} slots for {n} shards: a prime between them and {MAX_SLOTS} is needed")
    names = F.array(*[F.lit(s) for s in shards])
    start = spark.range(1).select(
        F.transform(names, lambda s: F.pmod(hashed(F.concat(F.lit("offset:"), s)), F.lit(m))).alias("off"),
        F.transform(names, lambda s: F.pmod(hashed(F.concat(F.lit("skip:"), s)), F.lit(m - 1)) + 1 if m > 2 else F.lit(1).cast("long")).alias("skip"),
        F.unhex(F.repeat(F.lit("FFFF"), m)).alias("tbl"), F.array_repeat(F.lit(0).cast("long"), n).alias("nxt"),
        F.lit(0).alias("turn"), F.lit(0).cast("long").alias("at"), F.lit(0).alias("claimed"))
    slot = "cast((off[s.turn] + s.at * skip[s.turn]) % {m} as int)".format(m=m)
    fold = f"""aggregate(sequence(1, {ATTEMPTS}), named_struct('tbl', tbl, 'nxt', nxt, 'turn', turn, 'at', at, 'claimed', claimed),
      (s, x) -> CASE
        WHEN s.claimed = {m} THEN s
        WHEN substring(s.tbl, 2 * {slot} + 1, 2) = X'FFFF' THEN named_struct(
          'tbl', overlay(s.tbl PLACING unhex(lpad(hex(s.turn), 4, '0')) FROM 2 * {slot} + 1 FOR 2),
          'nxt', transform(s.nxt, (v, k) -> IF(k = s.turn, s.at + 1, v)),
          'turn', (s.turn + 1) % {n},
          'at', IF({n} = 1, s.at + 1, s.nxt[(s.turn + 1) % {n}]),
          'claimed', s.claimed + 1)
        ELSE named_struct('tbl', s.tbl, 'nxt', s.nxt, 'turn', s.turn, 'at', s.at + 1, 'claimed', s.claimed)
      END)"""
    state = start
    while True:
        row = state.select("off", "skip", F.expr(fold).alias("s")).select("off", "skip", "s.*").first()
        if row["claimed"] == m:
            break
        state = spark.range(1).select(*[F.lit(bytes(row[c]) if c == "tbl" else row[c]).cast(state.schema[c].dataType).alias(c) for c in state.columns])
    return (spark.range(m).select(F.col("id").alias("slot"), F.lit(bytes(row["tbl"])).alias("tbl"))
            .select("slot", F.conv(F.hex(F.substring("tbl", (2 * F.col("slot") + 1).cast("int"), F.lit(2))), 16, 10).cast("int").alias("shard")))


def assign_shards(docs: DataFrame, shards: Sequence[str], key: str = "doc_id", text: str | None = "text",
                  slots: int | None = None) -> DataFrame:
    """``(key, slot, shard)`` for every row of ``docs``.

    Repeated rows go to one shard; a row without a key goes by its text, one
    without both to a fixed slot.  An empty table gives an empty result.
    Other columns are not read."""
    m = slots or next_prime(100 * max(1, len(shards)))
    table = lookup_table(docs.sparkSession, shards, m)
    rows = pick(docs, **{"id": key} | ({"txt": text} if text else {}))
    placed = rows.select("id", slot_of(F.col("id"), F.col("txt") if text else None, m).alias("slot"))
    return placed.join(F.broadcast(table), "slot").select(F.col("id").alias(key), "slot", "shard")


def with_shard(docs: DataFrame, shards: Sequence[str], key: str = "doc_id", text: str | None = "text",
               slots: int | None = None, name: str = "shard") -> DataFrame:
    """All columns of ``docs`` and the shard; a column of ``docs`` called ``name`` gives way to it.

    Rows go where :func:`assign_shards` sends them, repeated ones to one
    shard; an empty table stays empty."""
    m = slots or next_prime(100 * max(1, len(shards)))
    table = lookup_table(docs.sparkSession, shards, m)
    rows, _ = numbered(docs, **{"id": key} | ({"txt": text} if text else {}))
    rows = rows.withColumn("slot", slot_of(F.col("id"), F.col("txt") if text else None, m))
    joined = rows.join(F.broadcast(table), "slot")
    kept = [i for i, c in enumerate(docs.columns) if c.lower() != name.lower()]
    return joined.select(*[F.col(f"c{i}") for i in kept], "shard").toDF(*[docs.columns[i] for i in kept], name)


def write_shards(sharded: DataFrame, path: str, shard: str = "shard", parts: int = 8) -> None:
    """Write one folder a shard; each shard is spread over ``parts`` tasks by row hash, so none gathers a whole shard."""
    own = sharded.columns[position(sharded, shard)]
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in sharded.columns]), F.lit(parts))
    sharded.repartition(F.col(f"`{own}`"), salt).write.partitionBy(own).parquet(path)
