"""Reproducible shuffle into shards: a Feistel permutation of the global row numbers.

The permutation works on pairs (left, right) below (a, b), the least near-square with a * b >= N;
a number that it moves beyond N is moved again until it falls below N (cycle walking), which
keeps it a permutation of 0..N-1. Shard and slot of any row number can be computed from N, the
seed and the number of shards alone. Built from DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from rentrank.llm import order
from rentrank.llm.store import partitions, saved, table, text_hash

SHARDS = 8
ROUNDS = 6
#: Moves that the expression makes at most. A walk is no longer than a * b - N + 1 <= sqrt(N) + 2
#: moves, and every move beyond the first is needed by a share of at most 2 / sqrt(N): for N up
#: to 3,800 the bound holds for certain, beyond it fails with a chance below (2 / 61) ** 64. Such
#: a row would raise an error, never be misplaced.
WALK = 64


def _round(x: Column, a: int, b: int, seed: int) -> Column:
    """One pass of the Feistel network over a number below a * b."""
    keys = F.array(*[F.lit(i) for i in range(ROUNDS)])
    start = F.struct((x % a).alias("l"), F.floor(x / a).cast("long").alias("r"))

    def step(s: Column, i: Column) -> Column:
        def mixed(half: Column, below: int) -> Column:
            return F.pmod(F.xxhash64(F.lit(seed), i, half), F.lit(below))

        even = F.struct(((s["l"] + mixed(s["r"], a)) % a).alias("l"), s["r"].alias("r"))
        odd = F.struct(s["l"].alias("l"), ((s["r"] + mixed(s["l"], b)) % b).alias("r"))
        return F.when(i % 2 == 0, even).otherwise(odd)

    return F.aggregate(keys, start, step, lambda s: s["l"] + s["r"] * a)


def permuted(number: Column, n: int, seed: int = 0) -> Column:
    """Where the permutation of 0..n-1 puts ``number`` (a long)."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    b = max(1, -(-n // a))
    once = _round(number, a, b, seed)
    if a * b == n:
        return once
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK - 1)),
        once,
        lambda x, _: F.when(x < n, x).otherwise(_round(x, a, b, seed)),
    )
    settled = F.when(walked < n, walked)
    return F.coalesce(settled, F.raise_error(F.lit("cycle walk too long")).cast("long"))


def numbered(rows: DataFrame, key: str, spread: str, ties: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` with ``row_number``: 0..N-1 in the order of ``key``, then ``spread``, then ``ties``.

    ``spread`` is a long hash that tells apart the rows of a key. Rows equal in all of these get
    their numbers in any order. Only a count per bucket passes through one task.
    """
    n = partitions(rows.sparkSession)
    limits = order.bounds(rows, key, n)
    placed = saved(rows.withColumn("_bucket", order.bucket(F.col(key), F.col(spread), limits, n)), "numbered")
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("_bucket").count()
    starts = counts.select("_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_bucket").orderBy(F.asc_nulls_last(key), spread, *ties)
    ranked = placed.withColumn("_rank", F.row_number().over(within))
    joined = ranked.join(saved(starts, "starts"), "_bucket")
    return joined.withColumn("row_number", (F.col("_start") + F.col("_rank") - 1).cast("long")).drop(
        "_bucket", "_start", "_rank"
    )


def sharded(docs: DataFrame, shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``docs``.

    Law ``rows``: the shards' counts are at most one apart; slots are gapless from 0 in each.
    The order that is shuffled is by doc_id (NULL last), text hash, size, crc: it does not depend
    on how the table is laid out in files. Rows alike in all of these share their places among
    them. NULL text counts as empty (size 1, crc 0).
    """
    text = F.coalesce("text", F.lit(""))
    narrow = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        text_hash().alias("_text"),
    )
    rows = numbered(narrow, "doc_id", "_text", ("size", "text_crc32"))
    n = docs.count()
    if not n:
        place = F.lit(0).cast("long")
    else:
        place = permuted(F.col("row_number"), n, seed)
    return rows.withColumn("_place", place).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        (F.col("_place") % shards).cast("int").alias("shard"),
        F.floor(F.col("_place") / shards).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards of equal counts."""
    return sharded(table(spark, sf_dir, "documents"))
