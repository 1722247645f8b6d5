"""Direct-line flag, location text, commute times and poster preference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentrank.functions.text import clean_string, float_text, integer_text
from rentrank.operators.membership import of_batch
from rentrank.operators.skew import lookup_join
from rentrank.settings import DIRECT_LINE_STATIONS

ROUTES_SCHEMA = "routes array<struct<duration:string>>"
NO_ROUTE = "N/A"


def direct_line(station: Column, stations: tuple[str, ...] = DIRECT_LINE_STATIONS) -> Column:
    """Whether the cleaned station name is in the (small, fixed) list; blank is false."""
    names = sorted({name.strip().lower() for name in stations})
    return F.coalesce(clean_string(station).isin(*names), F.lit(False))


def location_text(latitude: Column, longitude: Column) -> Column:
    return F.concat(float_text(latitude), F.lit(", "), float_text(longitude))


def commute_minutes(status_code: Column, body: Column) -> Column:
    """Whole minutes of the first route of a good reply; NULL for any other reply."""
    first = F.get(F.from_json(body, ROUTES_SCHEMA)["routes"], F.lit(0))
    seconds = integer_text(F.replace(first["duration"], F.lit("s"), F.lit("")))
    return F.when(status_code == 200, F.floor(seconds / 60).cast("int"))


def commute_text(minutes: Column) -> Column:
    return F.coalesce(F.concat(minutes.cast("string"), F.lit(" mins")), F.lit(NO_ROUTE))


def commute_columns(responses: DataFrame, anchors: tuple[int, ...] = (1, 2)) -> DataFrame:
    """One row per id with ``location_<n>_mins`` and whether there was a reply at all.

    Several replies for one (id, dest) count as the slowest good one. The buffers are plain
    numbers, so a hash aggregate collapses the replies of a hot id before the shuffle.
    """
    minutes = responses.select(
        "id", "dest", commute_minutes(F.col("status_code"), F.col("body")).alias("minutes")
    )
    aggregates = []
    for n in anchors:
        here = F.col("dest") == n
        aggregates.append(F.max(F.when(here, F.col("minutes"))).alias(f"location_{n}_mins"))
        aggregates.append(F.count_if(here).alias(f"_replies_{n}"))
    return minutes.filter(F.col("id").isNotNull()).groupBy("id").agg(*aggregates)


def commute_times(
    df: DataFrame,
    responses: DataFrame | None,
    anchors: tuple[int, ...] = (1, 2),
    measure: DataFrame | None = None,
    batch: DataFrame | None = None,
) -> DataFrame:
    """Attach ``location_1`` and ``location_2``; NULL where commutes are off or unknown.

    Listings without coordinates are never asked about, so they keep NULL. Given ``batch``, the
    ids of ``df`` as a written table, replies to others are left out before their JSON is read.
    """
    empty = {"location_1": "string", "location_2": "string"}
    empty |= {"location_1_mins": "int", "location_2_mins": "int"}
    if responses is None or not anchors:
        return df.withColumns({name: F.lit(None).cast(kind) for name, kind in empty.items()})
    if batch is not None:
        responses = of_batch(responses, batch, "id")
    joined = lookup_join(df, commute_columns(responses, anchors), "id", "left", measure)
    has_place = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    columns = {}
    for n in (1, 2):
        if n not in anchors:
            columns[f"location_{n}_mins"] = F.lit(None).cast("int")
            columns[f"location_{n}"] = F.lit(None).cast("string")
            continue
        minutes = F.col(f"location_{n}_mins")
        asked = has_place & (F.col(f"_replies_{n}") > 0)
        columns[f"location_{n}"] = F.when(asked, commute_text(minutes))
        columns[f"location_{n}_mins"] = F.when(asked, minutes)
    return joined.withColumns(columns).drop(*[f"_replies_{n}" for n in anchors])


def preferable_poster(poster_type: Column, has_place: Column, commute_enabled: bool) -> Column:
    """Set only for listings with coordinates, and only when commutes are on."""
    wanted = poster_type.contains("flatmate") & has_place & F.lit(commute_enabled)
    return F.coalesce(wanted, F.lit(False))


def enrich(
    df: DataFrame,
    responses: DataFrame | None,
    commute_enabled: bool = True,
    anchors: tuple[int, ...] = (1, 2),
    measure: DataFrame | None = None,
    batch: DataFrame | None = None,
) -> DataFrame:
    has_place = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    df = df.withColumns(
        {
            "direct_line_to_office": direct_line(F.col("nearest_station")),
            "location": location_text(F.col("latitude"), F.col("longitude")),
            "preferable_poster_type": preferable_poster(
                F.col("poster_type"), has_place, commute_enabled
            ),
        }
    )
    return commute_times(df, responses if commute_enabled else None, anchors, measure, batch)
