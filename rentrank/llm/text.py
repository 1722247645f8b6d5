"""Column helpers on words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lowered(word: Column) -> Column:
    """A-Z as a-z, and nothing else. Most words need no work."""
    return F.when(word.rlike("[A-Z]"), F.translate(word, UPPER, UPPER.lower())).otherwise(word)
