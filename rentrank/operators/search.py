"""The search form as a filter over listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentrank.functions.text import string_to_number

WHOLE_HOME_TYPES = ("studio", "1 bed", "whole property")


def search_listings(
    listings: DataFrame,
    min_rent: int,
    max_rent: int,
    place: str = "London",
    min_term_months: int = 6,
) -> DataFrame:
    """Rooms the saved search asks for.

    In the place, within the rent limits, let for the whole week, with a double room and a
    photo, from a private landlord, with no minimum term above ``min_term_months``, and not a
    whole home.
    """
    home = F.lower(F.coalesce(F.col("type"), F.lit("")))
    whole_home = F.lit(False)
    for text in WHOLE_HOME_TYPES:
        whole_home = whole_home | home.contains(text)
    term = F.coalesce(string_to_number(F.col("minimum_term")), F.lit(0))
    return listings.filter(
        F.col("average_price").between(min_rent, max_rent)
        & F.lower("area").contains(place.lower())
        & F.col("available_all_week")
        & F.array_contains("room_sizes", "double")
        & (F.col("image_url") != "")
        & F.lower("poster_type").contains("landlord")
        & (term <= min_term_months)
        & ~whole_home
    )
