"""Schemas of the stored tables and of the inputs."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: field names, their types and their order are the interface. ---

ROOM_SCHEMA = T.StructType(
    [
        T.StructField("status", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("date_added", T.DateType()),
        T.StructField("type", T.StringType()),
        T.StructField("area", T.StringType()),
        T.StructField("nearest_station", T.StringType()),
        T.StructField("available_all_week", T.BooleanType()),
        T.StructField("direct_line_to_office", T.BooleanType()),
        T.StructField("location", T.StringType()),
        T.StructField("location_1", T.StringType()),
        T.StructField("location_2", T.StringType()),
        T.StructField("average_price", T.IntegerType()),
        T.StructField("average_deposit", T.DoubleType()),
        T.StructField("available", T.StringType()),
        T.StructField("minimum_term", T.StringType()),
        T.StructField("maximum_term", T.StringType()),
        T.StructField("bills_included", T.BooleanType()),
        T.StructField("broadband_included", T.BooleanType()),
        T.StructField("furnishings", T.BooleanType()),
        T.StructField("garden_or_patio", T.BooleanType()),
        T.StructField("living_room", T.BooleanType()),
        T.StructField("balcony_or_roof_terrace", T.StringType()),
        T.StructField("number_of_flatmates", T.IntegerType()),
        T.StructField("total_number_of_rooms", T.IntegerType()),
        T.StructField("room_sizes", T.ArrayType(T.StringType())),
        T.StructField("score", T.DoubleType()),
        T.StructField("image_url", T.StringType()),
        T.StructField("poster_type", T.StringType()),
        T.StructField("collective_word_count", T.IntegerType()),
        T.StructField("preferable_poster_type", T.BooleanType()),
    ]
)

# Value of a field that the page did not give. Fields not named here default to NULL.
ROOM_DEFAULTS = {
    "status": "",
    "url": "",
    "id": "",
    "image_url": "",
    "poster_type": "",
    "collective_word_count": 0,
    "preferable_poster_type": False,
}

EXPORT_COLS = [
    "status", "id", "url", "poster_type", "date_added", "type", "area", "score",
    "collective_word_count", "average_price", "average_deposit", "location_1", "location_2",
    "direct_line_to_office", "location", "nearest_station", "available", "minimum_term",
    "maximum_term", "bills_included", "broadband_included", "furnishings", "garden_or_patio",
    "living_room", "balcony_or_roof_terrace", "number_of_flatmates", "total_number_of_rooms",
]

# --- End of fixed values. ---

# Page text that did not fit the typed column, kept beside it, and typed helpers.
ROOM_EXTRAS = T.StructType(
    [
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("location_1_mins", T.IntegerType()),
        T.StructField("location_2_mins", T.IntegerType()),
        T.StructField("raw_bills_included", T.StringType()),
        T.StructField("raw_broadband_included", T.StringType()),
        T.StructField("raw_furnishings", T.StringType()),
        T.StructField("raw_garden_or_patio", T.StringType()),
        T.StructField("raw_living_room", T.StringType()),
        T.StructField("raw_number_of_flatmates", T.StringType()),
        T.StructField("raw_total_number_of_rooms", T.StringType()),
    ]
)

LISTINGS_SCHEMA = T.StructType(ROOM_SCHEMA.fields + ROOM_EXTRAS.fields)

# What a run did not take: a url without an id, or a room that breaks a rule.
REJECT_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("url", "id", "reason")]
)

CURATION_SCHEMA = T.StructType(
    [T.StructField("list_name", T.StringType()), T.StructField("id", T.StringType())]
)

STATUS_SCHEMA = T.StructType(
    [T.StructField("id", T.StringType()), T.StructField("status", T.StringType())]
)

PAGE_SCHEMA = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)

RESULT_PAGE_SCHEMA = T.StructType(
    [T.StructField("page_no", T.LongType()), T.StructField("html", T.StringType())]
)

COMMUTE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("dest", T.IntegerType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("body", T.StringType()),
    ]
)

# What the extraction job reads off one listing page.
EXTRACT_SCHEMA = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("expired", T.BooleanType()),
        T.StructField("contactable", T.BooleanType()),
        T.StructField("image_url", T.StringType()),
        T.StructField("notices", T.ArrayType(T.StringType())),
        T.StructField("key_features", T.ArrayType(T.StringType())),
        T.StructField("features", T.MapType(T.StringType(), T.StringType())),
        T.StructField("poster_type", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ]
)

#: The latest flags of pages: time and flags in one number (``operators.live``).
FLAGS_SCHEMA = T.StructType([T.StructField("url", T.StringType()), T.StructField("p", T.LongType())])
