"""Listing-shaped tables that Spark derives from the driver's tables.

Every table is a projection or aggregate of the given Parquet, so its size grows with them: one
listing per ``orders`` row.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rentrank.operators.skew import lookup_join
from rentrank.settings import DIRECT_LINE_STATIONS

RUN_DATE = date(2001, 8, 1)
NEW_FROM = "2001-01-01"
DOMAIN = "https://rooms.example"

OTHER_STATIONS = (
    "Brixton", "Clapham Common", "Morden", "Balham", "Ealing Common", "Acton Town", "Hounslow",
    "Cockfosters",
)
STATIONS = DIRECT_LINE_STATIONS + OTHER_STATIONS
POSTERS = ("current flatmate", "live out landlord", "agent")
TYPES = ("Double room", "Studio flat", "Room in a shared house", "Whole property to let")
ROOM_TEXTS = ("double", "single", "double (NOW LET)")  # return flags A, N, R
AREAS = ("London", "North London", "Reading", "South London")
WORDS = (
    "we", "us", "our", "ours", "together", "household", "home", "shared", "sharing",
    "We", "our,", "the", "room", "is", "quiet", "nice",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders``, dealt out evenly: its rows are narrow, what is made of them is not."""
    return table(spark, sf_dir, "orders").repartition(tasks(spark))


def tasks(spark: SparkSession) -> int:
    """As many tasks as a shuffle has, at least one per core."""
    partitions = spark.conf.get("spark.sql.shuffle.partitions", "200")
    cores = spark.sparkContext.defaultParallelism
    return max(cores, int(partitions) if partitions.isdigit() else cores)


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.get(F.split(F.lit("|".join(values)), r"\|"), index.cast("int"))


def price_label(quantity: Column, weekly: Column) -> Column:
    """£… per week or per month; 1,000 and up with a comma."""
    week = F.concat(F.lit("£"), (100 + 3 * quantity).cast("string"), F.lit("_pw"))
    month = F.concat(F.lit("£"), F.format_number(500 + 10 * quantity, 0), F.lit("_pcm"))
    return F.when(weekly, week).otherwise(month)


def listing_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, prices): the price entries of each order in page order.

    Lines are in page order by ship date, line number, return flag and quantity (lines equal in
    all four give the same entry). Every third line number is a weekly price. A repeated label
    keeps its first place and takes its last value; both are numbers, so the first aggregate is
    a hash aggregate, and it leaves at most 100 labels per order, however many lines the order
    has: the list in the second stays small.
    """
    flags = F.array(*[F.lit(flag) for flag in "ANR"])
    day = F.unix_date(F.col("l_shipdate").cast("date")).cast("bigint")
    flag = F.array_position(flags, F.col("l_returnflag"))
    # Day, line number (any INT) and flag side by side: the last two take less than 34 bits.
    place = day * 2**34 + F.col("l_linenumber").cast("bigint") * 4 + flag
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.col("l_linenumber") % 3 == 0).alias("weekly"),
        place.alias("place"),
    )
    labels = rows.groupBy("o_orderkey", "quantity", "weekly").agg(
        F.min("place").alias("first"), F.max("place").alias("last")
    )
    entry = F.struct("first", "quantity", "weekly", F.pmod("last", F.lit(4)).alias("flag"))
    lists = labels.groupBy("o_orderkey").agg(F.sort_array(F.collect_list(entry)).alias("entries"))

    def as_entry(e: Column) -> Column:
        value = _pick(ROOM_TEXTS, e["flag"] - 1)
        return F.struct(price_label(e["quantity"], e["weekly"]).alias("key"), value.alias("value"))

    return lists.select("o_orderkey", F.transform("entries", as_entry).alias("prices"))


def label_entries() -> Column:
    """The entries other than prices, in page order; an absent label is left out."""
    okey, ckey = F.col("o_orderkey"), F.col("o_custkey")
    pounds = F.concat(F.lit("£"), F.floor(F.col("o_totalprice") / 1000).cast("string"))
    priority = F.substring("o_orderpriority", 1, 1)
    amenity = F.when(ckey % 4 == 0, "Yes").when(ckey % 4 == 1, "No").when(ckey % 4 == 2, "shared")
    mates = (okey % 6).cast("string")
    flat = F.when((okey % 3 == 0) | (okey % 3 == 2), mates)
    house = F.when(
        (okey % 3 == 1) | (okey % 3 == 2),
        F.when(ckey % 17 == 0, "a few").otherwise((ckey % 7).cast("string")),
    )
    swap = ckey % 2 == 1
    entries = [
        ("deposit", F.when(okey % 11 == 0, "none").otherwise(pounds)),
        ("deposit_(room_2)", F.when(okey % 4 == 0, F.concat(pounds, F.lit("0.50")))),
        ("available", F.when(okey % 2 == 0, "Now").otherwise("01 Sep")),
        ("minimum_term", F.when(priority == "5", "None").otherwise(F.concat(priority, F.lit(" months")))),
        ("maximum_term", F.lit("None")),
        ("bills_included?", F.when(F.col("o_orderstatus") == "F", "Yes")
            .when(F.col("o_orderstatus") == "O", "No").otherwise("Some")),
        ("furnishings", F.when(okey % 3 == 0, "Furnished").when(okey % 3 == 1, "Unfurnished")
            .otherwise("Part furnished")),
        ("garden/patio", amenity),
        ("living_room", amenity),
        ("broadband_included", amenity),
        ("balcony/roof_terrace", amenity),
        ("total_#_rooms", F.when(ckey % 13 == 0, "6+").otherwise((ckey % 5 + 2).cast("string"))),
        (F.when(swap, "#_housemates").otherwise("#_flatmates"), F.when(swap, house).otherwise(flat)),
        (F.when(swap, "#_flatmates").otherwise("#_housemates"), F.when(swap, flat).otherwise(house)),
    ]
    structs = [
        F.struct((F.lit(k) if isinstance(k, str) else k).alias("key"), v.alias("value"))
        for k, v in entries
    ]
    return F.filter(F.array(*structs), lambda e: e["value"].isNotNull())


def listing_columns(orders: DataFrame, *features: Column) -> DataFrame:
    """Wide listings as a projection of ``orders``, with ``features`` if given."""
    okey, ckey = F.col("o_orderkey"), F.col("o_custkey")
    okey_text = okey.cast("string")
    name = _pick(STATIONS, ckey % len(STATIONS))
    station = (
        F.when(okey % 4 == 0, name)
        .when(okey % 4 == 1, F.upper(name))
        .when(okey % 4 == 2, F.concat(F.lit("  "), name, F.lit(" ")))
        .otherwise(F.concat(F.lit("\u00a0"), F.lower(name), F.lit("\u00a0")))
    )
    placed = okey % 19 != 0
    words = F.transform(
        F.sequence(F.lit(0), (okey % 12 + 2).cast("int")),
        lambda i: _pick(WORDS, (okey * (i + 3) + ckey * i + i * i) % len(WORDS)),
    )
    return orders.select(
        okey_text.alias("id"),
        F.concat(F.lit("listing?listing_id="), okey_text, F.lit("&mode=list")).alias("url"),
        *features,
        _pick(TYPES, ckey % len(TYPES)).alias("type"),
        _pick(AREAS, okey % len(AREAS)).alias("area"),
        station.alias("nearest_station"),
        F.when(placed, F.round(51.3 + (ckey % 4000) / 10000, 6)).alias("latitude"),
        F.when(placed, F.round(-0.5 + (okey % 7000) / 10000, 6)).alias("longitude"),
        (okey % 10 != 0).alias("available_all_week"),
        F.when(okey % 8 == 0, "").otherwise(
            F.concat(F.lit("https://img.example/"), okey_text, F.lit(".jpg"))
        ).alias("image_url"),
        _pick(POSTERS, ckey % len(POSTERS)).alias("poster_type"),
        F.array_join(words, " ").alias("description"),
        F.when(F.col("o_orderdate") < F.lit(NEW_FROM).cast("timestamp"),
               F.col("o_orderdate").cast("date")).otherwise(F.lit(RUN_DATE)).alias("date_added"),
        (okey % 6 == 0).alias("expired"),
        (okey % 5 != 0).alias("contactable"),
    )


def _orders_with_features(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Column]:
    """Orders, and their feature map with prices first; only the order columns are shuffled."""
    orders = orders_table(spark, sf_dir)
    prices = listing_prices(spark, sf_dir)
    keys = table(spark, sf_dir, "orders").select("o_orderkey")
    joined = lookup_join(orders, prices, "o_orderkey", "left", keys)
    none = F.expr("array()").cast("array<struct<key:string,value:string>>")
    return joined, F.map_from_entries(F.concat(F.coalesce("prices", none), label_entries()))


def listings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide listings with the feature map."""
    joined, features = _orders_with_features(spark, sf_dir)
    # A generated column is made once a row; a projected one again in each filter that names it.
    made = joined.withColumn("features", F.explode(F.array(features)))
    return listing_columns(made, F.col("features"))


def listings_to_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``listings_raw`` for pages that are read more than once: what needs no HTML reads no lines, which a
    generated column would have made."""
    joined, features = _orders_with_features(spark, sf_dir)
    return listing_columns(joined, features.alias("features"))


def listings_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide listings whose feature map has no prices: no lines are read."""
    features = F.map_from_entries(label_entries()).alias("features")
    return listing_columns(orders_table(spark, sf_dir), features)


def known_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = orders_table(spark, sf_dir)
    old = orders.filter(F.col("o_orderdate") < F.lit(NEW_FROM).cast("timestamp"))
    return old.select(F.col("o_orderkey").cast("string").alias("id"))


def curation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(list_name, id) by the modulus of the order key; some ids are in two lists."""
    okey = F.col("o_orderkey")
    lists = F.array_compact(
        F.array(
            F.when(okey % 17 == 0, "ignored"),
            F.when(okey % 23 == 0, "favourites"),
            F.when(okey % 29 == 0, "messaged"),
        )
    )
    orders = orders_table(spark, sf_dir)
    return orders.select(F.explode(lists).alias("list_name"), okey.cast("string").alias("id"))


def status_updates(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    status = (
        F.when(kind == "click", "f")
        .when(kind == "purchase", "Messaged")
        .when(kind == "error", "IGNORE")
        .when(kind == "signup", "maybe")
    )
    return events.select(F.col("event_id").cast("string").alias("id"), status.alias("status"), "ts")


def commute_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Route replies for two anchors per listing: good, without a route, refused, or missing."""
    okey, ckey, dest = F.col("o_orderkey"), F.col("o_custkey"), F.col("dest")
    seconds = (600 + (ckey * 37 + okey * dest * 13) % 4800).cast("string")
    kind = (okey + dest) % 10
    good = F.concat(F.lit('{"routes":[{"duration":"'), seconds, F.lit('s"}]}'))
    body = (
        F.when(kind == 0, '{"routes":[]}').when(kind == 1, "{}").when(kind == 2, "denied").otherwise(good)
    )
    orders = orders_table(spark, sf_dir).filter(okey % 23 != 0)
    return orders.withColumn("dest", F.explode(F.array(F.lit(1), F.lit(2)))).select(
        okey.cast("string").alias("id"),
        "dest",
        F.when(kind == 2, 403).otherwise(200).alias("status_code"),
        body.alias("body"),
    )


def page_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(url, fetched_at, expired, contactable): up to two snapshots per listing.

    Every 13th listing has none; the older one is always live.
    """
    orders = orders_table(spark, sf_dir).filter(F.col("o_orderkey") % 13 != 0)
    columns = listing_columns(orders).select("id", "url", "expired", "contactable")
    late = F.col("age") == 0
    return columns.withColumn("age", F.explode(F.array(F.lit(0), F.lit(1)))).select(
        "url",
        F.when(late, F.lit("2001-08-01 06:00:00").cast("timestamp"))
        .otherwise(F.lit("2001-07-01 06:00:00").cast("timestamp"))
        .alias("fetched_at"),
        (late & F.col("expired")).alias("expired"),
        (~late | F.col("contactable")).alias("contactable"),
    )


def _tag(name: str, css: str, content: Column) -> Column:
    return F.concat(F.lit(f'<{name} class="{css}">'), content, F.lit(f"</{name}>"))


def render_pages(listings: DataFrame) -> DataFrame:
    """(page_id, url, html): listings written out as listing pages.

    The small rows are spread evenly before they grow to pages, so that parsing is spread too. Their
    feature table is written before, as a lambda is no generated code: after it, pages that a reader
    does not want are not put together.
    """
    def row(label: Column, value: Column) -> Column:
        return F.concat(F.lit("<dt> "), label, F.lit("</dt>\n<dd>"), value, F.lit("<br></dd>"))

    # The labels of a page are spelt out together, as a lambda is no generated code.
    labels = F.upper(F.replace(F.array_join(F.map_keys("features"), "\u0001"), F.lit("_"), F.lit(" ")))
    labels = F.split(F.replace(labels, F.lit("£"), F.lit("&pound;")), "\u0001")
    rows = F.array_join(F.zip_with(labels, F.map_values("features"), row), "")
    listings = listings.withColumn("features", rows).repartition(tasks(listings.sparkSession))
    notice = F.when(F.col("available_all_week"), "No pets").otherwise("Room available weekends only")
    script = F.concat(
        F.lit("<script>var page = {location: { zoom: 1, latitude: \""),
        F.col("latitude").cast("string"),
        F.lit('", longitude: "'),
        F.col("longitude").cast("string"),
        F.lit('"}};</script>'),
    )
    image = F.concat(
        F.lit('<img class="photo-gallery__main-image" src="'), F.col("image_url"), F.lit('">')
    )
    station = F.concat(F.replace(F.col("nearest_station"), F.lit("&"), F.lit("&amp;")), F.lit("Station 5 min"))
    key_features = F.concat(
        F.lit("<li>"), F.replace(F.col("type"), F.lit(" "), F.lit("\n  ")), F.lit("</li><li>"),
        F.col("area"), F.lit(" E14</li><li>E14 Area info</li><li>"), station, F.lit("</li>"),
    )
    contact = F.when(F.col("contactable"), '<ul class="links contact_methods"><li>Message</li></ul>')
    gone = F.when(F.col("expired"), '<section class="listing-contact--expired">Gone</section>')
    html = F.concat(
        F.lit("<!DOCTYPE html><html><body><!-- listing -->"),
        F.coalesce(script, F.lit("")),
        image,
        _tag("ul", "key-features", key_features),
        _tag("ul", "feature-list", F.concat(F.lit("<li>"), notice, F.lit("</li>"))),
        _tag("dl", "feature-list", F.col("features")),
        _tag("div", "advertiser-info", F.concat(F.lit("<p><em>"), F.col("poster_type"), F.lit("</em></p>"))),
        _tag("p", "detaildesc", F.col("description")),
        F.coalesce(contact, F.lit("")),
        F.coalesce(gone, F.lit("")),
        F.lit("</body></html>"),
    )
    return listings.select(F.col("id").cast("bigint").alias("page_id"), "url", html.alias("html"))


def repeated_pages(pages: DataFrame) -> DataFrame:
    """Each page twice, page ids shared by many urls or absent, and an older, empty copy of some."""
    absent = F.col("page_id") % 7 == 0
    newest = pages.withColumn("page_id", F.when(~absent, F.col("page_id") % 97))
    older = pages.filter(~absent).select(F.lit(-1).cast("bigint").alias("page_id"), "url", F.lit("").alias("html"))
    return newest.unionByName(newest).unionByName(older)


def snapshot_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_snapshots`` as (page_id, url, html, fetched_at), with the flags in the markup."""
    flags = page_snapshots(spark, sf_dir)
    contact = F.when(F.col("contactable"), '<ul class="contact_methods"><li>Message</li></ul>')
    gone = F.when(F.col("expired"), '<section class="a listing-contact--expired">Gone</section>')
    html = F.concat(
        F.lit("<html><body><!-- snapshot --><p>Room</p>"), F.coalesce(contact, F.lit("")),
        F.coalesce(gone, F.lit("")), F.lit("</body></html>"),
    )
    return flags.select(F.lit(None).cast("bigint").alias("page_id"), "url", html.alias("html"), "fetched_at")


def result_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_no, html): per order a page of ten results, some blank, some seen on other pages."""
    okey = F.col("o_orderkey")

    def item(j: Column) -> Column:
        listing = (okey * 5 + j * 7).cast("string")
        url = F.when((okey + j) % 9 == 0, "").otherwise(
            F.concat(F.lit("listing?listing_id="), listing, F.lit("&amp;mode=list"))
        )
        return F.concat(F.lit('<li data-listing-url="'), url, F.lit('">Room</li>'))

    items = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(9)), item), "\n")
    html = F.concat(
        F.lit('<html><ul class="nav"><li data-listing-url="x">no</li></ul>'),
        _tag("ul", "listing-results", items),
        F.lit("</html>"),
    )
    return orders_table(spark, sf_dir).select(okey.alias("page_no"), html.alias("html"))
