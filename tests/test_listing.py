import datetime

import pytest
from pyspark.sql import functions as F

from rentrank.operators import enrich, export, live, markers, normalise, score, search, validate
from rentrank.plans.rooms import to_room_schema
from rentrank.schema import EXPORT_COLS, LISTINGS_SCHEMA
from rentrank.settings import SCORE_WEIGHTS, JobConfig

DAY = datetime.date(2001, 8, 1)


def bag(spark, **features):
    rows = [(list(features.items()),)]  # a Python dict would lose its order on the way
    entries = spark.createDataFrame(rows, "entries array<struct<key:string,value:string>>")
    return entries.select(F.map_from_entries("entries").alias("features"))


def of(spark, function, features):
    return bag(spark, **features).select(function(F.col("features")).alias("r")).collect()[0].r


def rule_price(features):
    import re

    prices = []
    for key, value in features.items():
        match = re.search(r"[\d,]+", key)
        digits = match.group().replace(",", "") if match else ""
        if key.startswith("£") and "(NOW LET)" not in value and digits:
            prices.append(int(digits) * 52 / 12 if "pw" in key.lower() else int(digits))
    return int(sum(prices) / len(prices)) if prices else None


@pytest.mark.parametrize(
    "features",
    [
        {},
        {"£700_pcm": "double (NOW LET)"},
        {"£700_pcm": "double", "£801_pcm": "single"},
        {"£1,200_pcm": "double", "£150_PW": "single", "£151_pw": "x (NOW LET)"},
        {"£,_pcm": "double"},
        {"£192.50_pw": "single", "price_£9": "double"},
        {"£100_pw": "a", "£101_pw": "b", "£103_pw": "c", "£107_pw": "d"},
    ],
)
def test_average_price(spark, features):
    assert of(spark, normalise.average_price, features) == rule_price(features)


def test_room_sizes(spark):
    features = {"£1_pcm": "single", "£2_pcm": "Double double", "£3_pcm": "Double", "£4": "double (NOW LET)"}
    assert of(spark, normalise.room_sizes, features) == ["single", "double", "single"]
    assert of(spark, normalise.room_sizes, {"deposit": "£1"}) is None


def test_average_deposit(spark):
    features = {"deposit": "£500", "Deposit_(room_2)": "601.9", "deposit_x": "none", "rent": "9"}
    assert of(spark, normalise.average_deposit, features) == 550.5
    assert of(spark, normalise.average_deposit, {"deposit": "none"}) is None


def test_null_features_are_no_features(spark):
    frame = spark.createDataFrame([(None,)], "features map<string,string>")
    row = normalise.normalise_features(frame).collect()[0]
    assert row.average_price is None and row.room_sizes is None and row.furnishings is None


def test_labels_casts_and_bools(spark):
    features = {
        "#_housemates": "3", "#_flatmates": "a few", "bills_included?": " SOME ",
        "total_#_rooms": "6+", "garden/patio": "No", "furnishings": "Part furnished",
        "balcony/roof_terrace": "Yes", "living_room": "ｓｈａｒｅｄ",
    }
    row = normalise.normalise_features(bag(spark, **features)).collect()[0]
    assert (row.number_of_flatmates, row.raw_number_of_flatmates) == (None, "a few")
    assert (row.total_number_of_rooms, row.raw_total_number_of_rooms) == (None, "6+")
    assert (row.bills_included, row.garden_or_patio, row.living_room) == (True, False, True)
    assert (row.furnishings, row.raw_furnishings) == (None, "Part furnished")
    assert row.balcony_or_roof_terrace == "Yes" and row.broadband_included is None


def test_direct_line(evaluate):
    values = [" BOND Street ", "St. John's Wood", "Brixton", "", None, "Bond Street Station"]
    expected = [True, True, False, False, False, False]
    assert evaluate(enrich.direct_line, values) == expected


def test_commute(spark):
    rows = [
        ("a", 1, 200, '{"routes":[{"duration":"1931s"},{"duration":"5s"}]}'),
        ("a", 2, 200, '{"routes":[]}'),
        ("b", 1, 403, "denied"),
        ("b", 2, 200, "not json"),
        ("c", 1, 200, '{"routes":[{"duration":"60s"}]}'),
        ("c", 1, 200, '{"routes":[{"duration":"120s"}]}'),
        (None, 1, 200, "{}"),
    ]
    responses = spark.createDataFrame(rows, "id string, dest int, status_code int, body string")
    places = [("a", 1.0, 2.0), ("b", 1.0, 2.0), ("c", 1.0, 2.0), ("d", 1.0, 2.0), ("a", None, 2.0), (None, 1.0, 2.0)]
    rooms = spark.createDataFrame(places, "id string, latitude double, longitude double")
    found = enrich.commute_times(rooms, responses).collect()
    texts = {(r.id, r.latitude, r.location_1, r.location_2) for r in found}
    assert len(found) == len(texts) and texts == {
        ("a", 1.0, "32 mins", "N/A"), ("b", 1.0, "N/A", "N/A"), ("c", 1.0, "2 mins", None),
        ("d", 1.0, None, None), ("a", None, None, None), (None, 1.0, None, None),
    }
    one = enrich.commute_times(rooms, responses, anchors=(1,)).filter("id = 'b'").collect()[0]
    assert (one.location_1, one.location_2) == ("N/A", None)
    off = enrich.enrich(
        rooms.withColumns({"nearest_station": F.lit(""), "poster_type": F.lit("flatmate")}),
        responses, commute_enabled=False,
    ).collect()
    assert all(r.location_1 is None and r.preferable_poster_type is False for r in off)


def listing(spark, **values):
    base = {"id": "1", "url": "u?id=1", "date_added": DAY, "location": "51.5, -0.1"}
    base |= values
    fields = [f for f in LISTINGS_SCHEMA.fields if f.name in base]
    from pyspark.sql.types import StructType

    frame = spark.createDataFrame([tuple(base[f.name] for f in fields)], StructType(fields))
    return to_room_schema(frame)


def test_defaults(spark):
    row = listing(spark).collect()[0]
    assert (row.status, row.image_url, row.poster_type) == ("", "", "")
    assert (row.collective_word_count, row.preferable_poster_type, row.score) == (0, False, None)
    assert listing(spark).columns == LISTINGS_SCHEMA.fieldNames()


def score_of(spark, weights=SCORE_WEIGHTS, **values):
    return score.with_score(listing(spark, **values), weights).collect()[0].score


def test_score_terms(spark):
    assert score_of(spark) == 0.0
    # (60-32)/40*6 + (60-70)/40*6 + (1-6/12) + 4 + 3 + (1-(5-2)/4)*2 + (1-(600-700)/300)*5 + 8*3/7
    value = score_of(
        spark, location_1="32 mins", location_2="70 mins", minimum_term="6 months",
        bills_included=True, living_room=True, furnishings=False, total_number_of_rooms=5,
        average_price=600, collective_word_count=3,
    )
    total = 0.7 * 6 + -0.25 * 6 + 0.5 + 4 + 3 + 0.25 * 2 + (1 + 1 / 3) * 5 + 8 * 3 / 7
    assert value == round(total, 1)


def test_score_of_text_that_is_no_number(spark):
    assert score_of(spark, location_1="N/A", minimum_term="None") == 0.0
    assert score_of(spark, raw_total_number_of_rooms="6+") == 0.0
    assert score_of(spark, raw_total_number_of_rooms="4+") == 1.0


def test_score_at_ties_and_other_weights(spark):
    assert score_of(spark, {"location_1": 0.35}, location_1="20 mins") == 0.3
    assert score_of(spark, {"location_1": 0.25}, location_1="20 mins") == 0.2
    assert score_of(spark, {"gender": 9, "status": 4, "nothing": 2}) == 0.0
    assert score_of(spark, {"balcony_or_rooftop_terrace": 5}, balcony_or_roof_terrace="Yes") == 0.0


def test_validity_order(spark):
    cases = [
        ({"room_sizes": None}, "room_sizes"),
        ({"room_sizes": []}, "room_sizes"),
        ({"room_sizes": ["single", "single"], "location": None}, "room_sizes"),
        ({"room_sizes": ["single", "double"], "location": None}, "location"),
        ({"room_sizes": ["double"], "available_all_week": False}, "available_all_week"),
        ({"room_sizes": ["double"], "available_all_week": None}, "available_all_week"),
        ({"room_sizes": ["double"], "available_all_week": True}, None),
    ]
    for values, reason in cases:
        rooms = listing(spark, **values)
        assert rooms.select(validate.reject_reason()).collect()[0][0] == reason
        assert validate.valid_listings(rooms).count() == (reason is None)
        assert validate.rejected_listings(rooms).count() == (reason is not None)


def test_export(spark):
    rows = [("a", 5.0, 900), ("b", None, 900), ("c", 9.5, 900), ("d", 9.5, 200), ("e", 5.0, 201), ("f", 1.0, None)]
    rooms = listing(spark).drop("id", "score", "average_price").crossJoin(
        spark.createDataFrame(rows, "id string, score double, average_price int")
    )
    found = export.export_ranked(rooms, 200)
    assert found.columns == EXPORT_COLS
    rows = found.collect()
    assert [r.id for r in rows] == ["b", "c", "a", "e"]
    assert rows[0].date_added == "01-Aug"


def test_markers(spark):
    cases = [
        ({"status": "FAVOURITE", "score": 1.0}, ["favourites"]),
        ({"status": "FAVOURITE", "score": 99.0}, ["favourites"]),
        ({"status": "MESSAGED", "score": 15.1}, ["new_listings"]),
        ({"score": 15.0}, []),
        ({"score": 20.0, "date_added": datetime.date(2001, 7, 31)}, []),
        ({"score": 20.0, "location": None}, []),
        ({"score": None}, []),
    ]
    for values, layers in cases:
        rooms = listing(spark, **values)
        assert [r.layer for r in markers.map_markers(rooms, DAY).collect()] == layers
    rooms = listing(spark, status="FAVOURITE", score=20.5, image_url="i.jpg", average_price=700)
    assert markers.map_markers(rooms, DAY, show_favourites=False).count() == 0
    row = markers.map_markers(rooms, DAY, show_new_listings=False).collect()[0]
    assert (row.latitude, row.longitude) == (51.5, -0.1)
    assert row.popup == (
        "<b>ID:</b> 1<br><b>Date added:</b> 2001-08-01<br><b>Score:</b> 20.5<br><b>Price:</b> 700<br>"
        '<a href="u?id=1" target="_blank">View room</a><br><img src="i.jpg" width="100">'
    )


def test_search(spark):
    good = dict(
        average_price=700, area="North London", available_all_week=True, room_sizes=["single", "double"],
        image_url="i", poster_type="Live out landlord", minimum_term="6 months", type="Double room",
    )
    bad = [
        {"average_price": 199}, {"average_price": 1001}, {"average_price": None}, {"area": "Leeds"},
        {"available_all_week": False}, {"room_sizes": ["single"]}, {"image_url": ""},
        {"poster_type": "agent"}, {"minimum_term": "12 months"}, {"type": "Studio flat"},
    ]
    assert search.search_listings(listing(spark, **good), 200, 1000).count() == 1
    for change in bad:
        rooms = listing(spark, **(good | change))
        assert search.search_listings(rooms, 200, 1000).count() == 0, change


def test_live(spark):
    rooms = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("e",), (None,)], "url string")
    rows = [
        ("a", "2001-01-01", True, True), ("a", "2001-01-02", False, True),
        ("b", "2001-01-01", False, True), ("b", "2001-01-02", False, False),
        ("c", "2001-01-01", True, True), ("e", "2001-01-01", True, False),
        (None, "2001-01-01", False, True),
    ]
    pages = spark.createDataFrame(rows, "url string, fetched_at string, expired boolean, contactable boolean")
    pages = pages.withColumn("fetched_at", F.col("fetched_at").cast("timestamp"))
    assert [r.url for r in live.live_listings(rooms, pages).collect()] == ["a"]
    gone = {r.url for r in live.gone_listings(rooms, pages).collect()}
    assert gone == {"b", "c", "d", "e", None}


def test_config_checks():
    with pytest.raises(ValueError):
        JobConfig(DAY, "d", number_of_pages=-1)
    with pytest.raises(ValueError):
        JobConfig(DAY, "d", min_rent=5, max_rent=4)
    assert JobConfig(DAY, "d", update_only=True).pages_to_read == 0
