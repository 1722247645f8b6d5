"""Equi-joins that stay balanced when one key holds a large share of the rows.

AQE's skew join cannot help where one side is an aggregate (that side is not a plain shuffle
stage), which is the usual shape here, so hot keys are cut into slices explicitly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE = "_slice"

# A key is hot if it fills more than this many average shuffle partitions, so there can be at
# most partitions / HOT_FILL such keys, whatever the data size.
HOT_FILL = 2
# ... and no fewer rows than these: a slice of less is not worth a task, so a batch that is small
# against the number of partitions has no hot keys.
LEAST_ROWS = 32
# Items the frequency sketch tracks per shuffle partition, which keeps its error far below one
# partition's share; and the most it can track at all.
TRACKED_PER_PARTITION = 50
TRACKED_MOST = 1_000_000


def shuffle_partitions(frame: DataFrame) -> int:
    text = frame.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")
    return int(text) if text.isdigit() else 200


def hot_keys(frame: DataFrame, key: str, partitions: int | None = None) -> dict:
    """The hot keys and how many slices each is cut into: the average partitions it would fill.

    A mergeable frequency sketch does it in one pass and shuffles one sketch per task, not the
    keys. At most ``partitions / HOT_FILL`` keys come back, so they fit the driver, and both sides
    of a join see the same ones. NULL is a key here.
    """
    n = partitions or shuffle_partitions(frame)
    wanted = max(1, n // HOT_FILL)
    tracked = min(TRACKED_MOST, max(10_000, n * TRACKED_PER_PARTITION, wanted))
    found = frame.agg(
        F.expr(f"approx_top_k(`{key}`, {min(wanted, tracked)}, {tracked})").alias("top"),
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(key).isNull()).alias("nulls"),
    ).first()
    average = max(found["total"] / n, LEAST_ROWS / HOT_FILL)
    counts = {r["item"]: r["count"] for r in found["top"] or [] if r["item"] is not None}
    counts[None] = found["nulls"]
    return {k: -int(-c // average) for k, c in counts.items() if c >= HOT_FILL * average}


def _with_slices(frame: DataFrame, key: str, hot: dict) -> DataFrame:
    """``frame`` with ``_many``, the slices of its key: a hash look-up in the short list of hot keys."""
    kind = frame.schema[key].dataType.simpleString()
    named = frame.sparkSession.createDataFrame(list(hot.items()), f"_hot {kind}, _many int")
    found = frame.join(F.broadcast(named), F.col(key).eqNullSafe(F.col("_hot")), "left").drop("_hot")
    return found.withColumn("_many", F.coalesce("_many", F.lit(1)))


def _content(frame: DataFrame) -> Column:
    """A hash of a row, by all columns that have one."""
    plain = [f.name for f in frame.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.xxhash64(*plain)


def spread_hot_keys(left: DataFrame, right: DataFrame, key: str, hot: dict) -> tuple[DataFrame, DataFrame]:
    """Both sides with a slice column, to be joined on ``[key, SLICE]``.

    Rows of a hot key go to slices by their partition and their content, so they are spread if they
    lie in one partition (as after an earlier join by the same key) and if they are copies that lie
    in several; neither changes when a task is re-run. Exact copies in one partition stay together.
    ``right`` must be unique on ``key``: its row for a hot key is repeated once per slice.
    """
    salted = left.withColumns({"_content": _content(left), "_task": F.spark_partition_id()})
    turn = F.pmod(F.pmod("_content", "_many") + F.col("_task"), "_many")
    left = _with_slices(salted, key, hot).withColumn(SLICE, turn.cast("int")).drop("_content", "_task", "_many")
    right = _with_slices(right, key, hot)
    return left, right.withColumn(SLICE, F.explode(F.sequence(F.lit(0), F.col("_many") - 1))).drop("_many")


def lookup_join(
    left: DataFrame, right: DataFrame, key: str, how: str, measure: DataFrame | None = None
) -> DataFrame:
    """Join ``left`` to ``right`` (unique on ``key``) with the hot keys of ``left`` in slices.

    Keys are counted on ``measure`` if ``left`` is costly to compute twice. Without a hot key
    this is the plain join.
    """
    hot = hot_keys(left if measure is None else measure, key)
    if not hot:
        return left.join(right, key, how)
    left, right = spread_hot_keys(left, right, key, hot)
    return left.join(right, [key, SLICE], how).drop(SLICE)
