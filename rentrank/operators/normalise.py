"""From the feature map of a page to typed columns. No shuffle: a listing is one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentrank.functions.numbers import weekly_to_monthly
from rentrank.functions.text import clean_string, integer_text, string_to_number
from rentrank.settings import FALSE_WORDS, TRUE_WORDS

# Page labels and the standard names they stand for.
LABELS = {
    "bills_included": ("bills_included?",),
    "total_number_of_rooms": ("total_#_rooms",),
    "garden_or_patio": ("garden/patio",),
    "balcony_or_roof_terrace": ("balcony/roof_terrace",),
    "number_of_flatmates": ("#_flatmates", "#_housemates"),
}
PLAIN_LABELS = (
    "available", "minimum_term", "maximum_term", "broadband_included", "furnishings",
    "living_room",
)
BOOL_FIELDS = (
    "bills_included", "broadband_included", "furnishings", "garden_or_patio", "living_room",
)
INT_FIELDS = ("number_of_flatmates", "total_number_of_rooms")


def _entries(features: Column) -> Column:
    return F.coalesce(F.map_entries(features), F.expr("array()"))


def _open_rooms(features: Column) -> Column:
    """Map entries that are rooms still to let, in page order."""
    return F.filter(
        _entries(features),
        lambda e: e["key"].startswith("£") & ~e["value"].contains("(NOW LET)"),
    )


def _mean(values: Column) -> Column:
    """Mean of the non-NULL values, added up left to right; NULL for none. One pass."""

    def add(acc: Column, v: Column) -> Column:
        total = acc["total"] + F.coalesce(v, F.lit(0.0))
        return F.struct(total.alias("total"), (acc["n"] + v.isNotNull().cast("int")).alias("n"))

    start = F.struct(F.lit(0.0).alias("total"), F.lit(0).alias("n"))
    return F.aggregate(values, start, add, lambda acc: F.try_divide(acc["total"], acc["n"]))


def average_price(features: Column) -> Column:
    """Mean monthly price over the distinct price labels of open rooms, truncated."""

    def monthly(entry: Column) -> Column:
        number = string_to_number(entry["key"])
        weekly = F.lower(entry["key"]).contains("pw")
        return F.when(weekly, weekly_to_monthly(number)).otherwise(number.cast("double"))

    return _mean(F.transform(_open_rooms(features), monthly)).try_cast("int")


def room_sizes(features: Column) -> Column:
    """double or single per open room, in page order; NULL for none."""
    sizes = F.transform(
        _open_rooms(features),
        lambda e: F.when(e["value"].contains("double"), "double").otherwise("single"),
    )
    # ``when`` would work the sizes out twice.
    return F.get(F.filter(F.array(sizes), lambda s: F.size(s) > 0), F.lit(0))


def average_deposit(features: Column) -> Column:
    """Mean of the numbers under the labels that mention a deposit."""
    rows = F.filter(_entries(features), lambda e: F.lower(e["key"]).contains("deposit"))
    numbers = F.transform(rows, lambda e: string_to_number(e["value"]).cast("double"))
    return _mean(numbers)


def feature(features: Column, name: str) -> Column:
    """Page text of a standard field, under its own name or a label; the later label wins."""
    labels = LABELS.get(name, (name,))
    if len(labels) == 1:
        found = features[labels[0]]
    else:
        rows = F.filter(_entries(features), lambda e: e["key"].isin(*labels))
        found = F.try_element_at(rows, F.lit(-1))["value"]
    return F.coalesce(found, features[name]) if name in LABELS else found


def to_bool(text: Column) -> Column:
    """Known words as BOOLEAN; NULL for any other text."""
    word = clean_string(text)
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def rename_features(df: DataFrame) -> DataFrame:
    """One text column per standard field, read from ``features``."""
    names = (*PLAIN_LABELS, *LABELS)
    return df.withColumns({name: feature(F.col("features"), name) for name in names})


def cast_fields(df: DataFrame) -> DataFrame:
    """Typed columns, with the page text beside them in ``raw_<name>``."""
    raw = {f"raw_{name}": F.col(name) for name in (*BOOL_FIELDS, *INT_FIELDS)}
    typed = {name: to_bool(F.col(name)) for name in BOOL_FIELDS}
    typed |= {name: integer_text(F.col(name)) for name in INT_FIELDS}
    return df.withColumns(raw).withColumns(typed)


def normalise_features(df: DataFrame) -> DataFrame:
    """All columns that come out of the feature map, which is dropped."""
    features = F.col("features")
    return (
        cast_fields(rename_features(df))
        .withColumns(
            {
                "average_price": average_price(features),
                "average_deposit": average_deposit(features),
                "room_sizes": room_sizes(features),
            }
        )
        .drop("features")
    )
