"""Places in a global order, without a global sort: buckets by range, then work within each.

Rows are ordered by (doc_id, hash of the text), NULL ids last. Bounds between the buckets are
percentiles of doc_id, so they only decide the balance; the order itself holds whatever they are.
Rows that share one heavy id (or have none) are spread over several buckets by their hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Accuracy of the percentiles: a bucket is off by at most 1 / ACCURACY of the rows.
ACCURACY = 10_000


def bounds(frame: DataFrame, key: str, buckets: int) -> list[int]:
    """``buckets - 1`` ascending percentiles of ``key``; a heavy key takes several of them."""
    if buckets < 2:
        return []
    shares = [i / buckets for i in range(1, buckets)]
    found = frame.agg(F.percentile_approx(key, shares, max(ACCURACY, 20 * buckets))).first()[0]
    return list(found or [])


def _at_most(limits: Column, n: int, value: Column, strict: bool) -> Column:
    """How many of the ascending ``limits`` are below (or at) ``value``: a binary search."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(n.bit_length()))])

    def step(low: Column, size: Column) -> Column:
        limit = F.get(limits, low + size - 1)
        passed = limit < value if strict else limit <= value
        return F.when(passed, low + size).otherwise(low)

    return F.aggregate(steps, F.lit(0), step)


def _part(spread: Column, parts: Column) -> Column:
    """0 to parts - 1, ascending with ``spread``, in equal shares of the long range."""
    share = spread.cast("double") / float(1 << 64) + 0.5
    return F.least(F.floor(share * parts).cast("int"), parts - 1)


def bucket(key: Column, spread: Column, limits: list[int], buckets: int) -> Column:
    """The bucket of a row, ascending with ``key``: 0 to buckets - 1, or from there on for NULL.

    ``spread`` (a long hash) deals out the rows of a key that is several bounds at once, and
    those without key, in the order of ``spread``.
    """
    missing = F.lit(buckets) + _part(spread, F.lit(buckets))
    if not limits:
        return F.when(key.isNull(), missing).otherwise(F.lit(0))
    array = F.array(*[F.lit(x).cast("long") for x in limits])
    low = _at_most(array, len(limits), key, strict=True)
    high = _at_most(array, len(limits), key, strict=False)
    own = F.when(high > low + 1, low + _part(spread, high - low)).otherwise(high)
    return F.when(key.isNull(), missing).otherwise(own)
