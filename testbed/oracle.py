"""The expected results in SQL, written from the rules, over the driver's tables.

The common table expressions below rebuild the derived tables (``testbed.derived``) on their own.
"""

from __future__ import annotations

from rentrank.settings import DIRECT_LINE_STATIONS
from testbed import derived as D

BLANKS = " \t\r\n\u00a0"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def texts(values) -> str:
    return "[" + ", ".join(text(v) for v in values) + "]"


def pick(values, index: str) -> str:
    return f"{texts(values)}[({index}) + 1]"


ID = "CAST(o_orderkey AS VARCHAR)"
POUNDS = "'£' || CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS VARCHAR)"
AMENITY = "CASE o_custkey % 4 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' WHEN 2 THEN 'shared' END"
FLAT = "CASE WHEN o_orderkey % 3 IN (0, 2) THEN CAST(o_orderkey % 6 AS VARCHAR) END"
HOUSE = """CASE WHEN o_orderkey % 3 IN (1, 2) THEN
    CASE WHEN o_custkey % 17 = 0 THEN 'a few' ELSE CAST(o_custkey % 7 AS VARCHAR) END END"""
SWAP = "o_custkey % 2 = 1"
NEW_DAY = f"DATE '{D.RUN_DATE}'"

LABELS = f"""[
  {{'pos': 1001, 'key': 'deposit', 'value': CASE WHEN o_orderkey % 11 = 0 THEN 'none' ELSE {POUNDS} END}},
  {{'pos': 1002, 'key': 'deposit_(room_2)', 'value': CASE WHEN o_orderkey % 4 = 0 THEN {POUNDS} || '0.50' END}},
  {{'pos': 1003, 'key': 'available', 'value': CASE WHEN o_orderkey % 2 = 0 THEN 'Now' ELSE '01 Sep' END}},
  {{'pos': 1004, 'key': 'minimum_term', 'value': CASE WHEN o_orderpriority LIKE '5%' THEN 'None'
      ELSE substr(o_orderpriority, 1, 1) || ' months' END}},
  {{'pos': 1005, 'key': 'maximum_term', 'value': 'None'}},
  {{'pos': 1006, 'key': 'bills_included?', 'value':
      CASE o_orderstatus WHEN 'F' THEN 'Yes' WHEN 'O' THEN 'No' ELSE 'Some' END}},
  {{'pos': 1007, 'key': 'furnishings', 'value':
      CASE o_orderkey % 3 WHEN 0 THEN 'Furnished' WHEN 1 THEN 'Unfurnished' ELSE 'Part furnished' END}},
  {{'pos': 1008, 'key': 'garden/patio', 'value': {AMENITY}}},
  {{'pos': 1009, 'key': 'living_room', 'value': {AMENITY}}},
  {{'pos': 1010, 'key': 'broadband_included', 'value': {AMENITY}}},
  {{'pos': 1011, 'key': 'balcony/roof_terrace', 'value': {AMENITY}}},
  {{'pos': 1012, 'key': 'total_#_rooms', 'value':
      CASE WHEN o_custkey % 13 = 0 THEN '6+' ELSE CAST(o_custkey % 5 + 2 AS VARCHAR) END}},
  {{'pos': CASE WHEN {SWAP} THEN 1014 ELSE 1013 END, 'key': '#_flatmates', 'value': {FLAT}}},
  {{'pos': CASE WHEN {SWAP} THEN 1013 ELSE 1014 END, 'key': '#_housemates', 'value': {HOUSE}}}
]"""

CTES = f"""
price_rows AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS id,
    CASE WHEN l_linenumber % 3 = 0
      THEN '£' || CAST(100 + 3 * CAST(l_quantity AS INT) AS VARCHAR) || '_pw'
      ELSE '£' || format('{{:,}}', 500 + 10 * CAST(l_quantity AS INT)) || '_pcm' END AS key,
    CASE l_returnflag WHEN 'A' THEN 'double' WHEN 'N' THEN 'single' ELSE 'double (NOW LET)' END AS value,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY
      CAST(l_shipdate AS DATE), l_linenumber, l_returnflag, l_quantity, CASE WHEN l_linenumber % 3 = 0 THEN 1 ELSE 0 END) AS pos
  FROM lineitem),
price_entries AS (
  SELECT id, min(pos) AS pos, key, arg_max(value, pos) AS value FROM price_rows GROUP BY id, key),
label_entries AS (
  SELECT id, e.pos AS pos, e.key AS key, e.value AS value
  FROM (SELECT {ID} AS id, unnest({LABELS}) AS e FROM orders) WHERE e.value IS NOT NULL),
entries AS (
  SELECT id, pos, key, value FROM label_entries
  UNION ALL
  SELECT id, pos, key, value FROM price_entries WHERE id IN (SELECT {ID} FROM orders)),
base AS (
  SELECT {ID} AS id, 'listing?listing_id=' || {ID} || '&mode=list' AS url,
    {pick(D.TYPES, "o_custkey % 4")} AS type,
    {pick(D.AREAS, "o_orderkey % 4")} AS area,
    CASE o_orderkey % 4
      WHEN 0 THEN name WHEN 1 THEN upper(name) WHEN 2 THEN '  ' || name || ' '
      ELSE chr(160) || lower(name) || chr(160) END AS nearest_station,
    CASE WHEN o_orderkey % 19 <> 0 THEN
      round(51.3::DOUBLE + (o_custkey % 4000) / 10000::DOUBLE, 6) END AS latitude,
    CASE WHEN o_orderkey % 19 <> 0 THEN
      round(-0.5::DOUBLE + (o_orderkey % 7000) / 10000::DOUBLE, 6) END AS longitude,
    o_orderkey % 10 <> 0 AS available_all_week,
    CASE WHEN o_orderkey % 8 = 0 THEN '' ELSE 'https://img.example/' || {ID} || '.jpg' END AS image_url,
    {pick(D.POSTERS, "o_custkey % 3")} AS poster_type,
    list_transform(range(o_orderkey % 12 + 3), lambda i:
      {texts(D.WORDS)}[(o_orderkey * (i + 3) + o_custkey * i + i * i) % 16 + 1]) AS words,
    CASE WHEN o_orderdate < TIMESTAMP '{D.NEW_FROM}' THEN CAST(o_orderdate AS DATE)
      ELSE {NEW_DAY} END AS date_added,
    o_orderkey % 6 = 0 AS expired, o_orderkey % 5 <> 0 AS contactable
  FROM (SELECT *, {pick(D.STATIONS, f"o_custkey % {len(D.STATIONS)}")} AS name FROM orders)),
prices AS (
  SELECT id,
    CAST(trunc(list_reduce(list(price ORDER BY pos), lambda a, b: a + b) / count(*)) AS INT) AS average_price,
    string_agg(size, ',' ORDER BY pos) AS room_sizes
  FROM (
    SELECT id, pos,
      CASE WHEN lower(key) LIKE '%pw%' THEN n * 52 / 12 ELSE n::DOUBLE END AS price,
      CASE WHEN value LIKE '%double%' THEN 'double' ELSE 'single' END AS size
    FROM (SELECT *, CAST(replace(regexp_extract(key, '[0-9,]+'), ',', '') AS BIGINT) AS n FROM entries
          WHERE key LIKE '£%' AND value NOT LIKE '%(NOW LET)%'))
  GROUP BY id),
deposits AS (
  SELECT id, list_reduce(list(n::DOUBLE ORDER BY pos), lambda a, b: a + b) / count(*) AS average_deposit
  FROM (SELECT id, pos, TRY_CAST(replace(regexp_extract(value, '[0-9,]+'), ',', '') AS BIGINT) AS n
        FROM entries WHERE lower(key) LIKE '%deposit%')
  WHERE n IS NOT NULL GROUP BY id),
texts AS (
  SELECT id,
    max(value) FILTER (WHERE key = 'available') AS available,
    max(value) FILTER (WHERE key = 'minimum_term') AS minimum_term,
    max(value) FILTER (WHERE key = 'maximum_term') AS maximum_term,
    max(value) FILTER (WHERE key = 'bills_included?') AS bills_text,
    max(value) FILTER (WHERE key = 'broadband_included') AS broadband_text,
    max(value) FILTER (WHERE key = 'furnishings') AS furnishings_text,
    max(value) FILTER (WHERE key = 'garden/patio') AS garden_text,
    max(value) FILTER (WHERE key = 'living_room') AS living_text,
    max(value) FILTER (WHERE key = 'balcony/roof_terrace') AS balcony_or_roof_terrace,
    max(value) FILTER (WHERE key = 'total_#_rooms') AS rooms_text,
    arg_max(value, pos) FILTER (WHERE key IN ('#_flatmates', '#_housemates')) AS mates_text
  FROM entries GROUP BY id),
typed AS (
  SELECT id, available, minimum_term, maximum_term, balcony_or_roof_terrace, rooms_text, mates_text,
    furnishings_text, bills_text, broadband_text, garden_text, living_text,
    {{bool:bills_text}} AS bills_included,
    {{bool:broadband_text}} AS broadband_included,
    {{bool:furnishings_text}} AS furnishings,
    {{bool:garden_text}} AS garden_or_patio,
    {{bool:living_text}} AS living_room,
    CASE WHEN regexp_full_match(mates_text, '[0-9]+') THEN CAST(mates_text AS INT) END AS number_of_flatmates,
    CASE WHEN regexp_full_match(rooms_text, '[0-9]+') THEN CAST(rooms_text AS INT) END AS total_number_of_rooms
  FROM texts),
responses AS (
  SELECT {ID} AS id, dest, CASE WHEN (o_orderkey + dest) % 10 = 2 THEN 403 ELSE 200 END AS status_code,
    CASE (o_orderkey + dest) % 10 WHEN 0 THEN '{{{{"routes":[]}}}}' WHEN 1 THEN '{{{{}}}}' WHEN 2 THEN 'denied'
      ELSE '{{{{"routes":[{{{{"duration":"' || CAST(600 + (o_custkey * 37 + o_orderkey * dest * 13) % 4800 AS VARCHAR)
        || 's"}}}}]}}}}' END AS body
  FROM orders CROSS JOIN (VALUES (1), (2)) AS d(dest) WHERE o_orderkey % 23 <> 0),
replies AS (
  SELECT id, dest, CASE WHEN status_code = 200 AND json_valid(body) THEN
      CAST(replace(json_extract_string(body, '$.routes[0].duration'), 's', '') AS BIGINT) // 60 END AS minutes
  FROM responses),
commutes AS (
  SELECT id,
    max(minutes) FILTER (WHERE dest = 1) AS minutes_1, count(*) FILTER (WHERE dest = 1) AS asked_1,
    max(minutes) FILTER (WHERE dest = 2) AS minutes_2, count(*) FILTER (WHERE dest = 2) AS asked_2
  FROM replies GROUP BY id),
joined AS (
  SELECT b.*, t.* EXCLUDE (id), p.average_price, p.room_sizes, d.average_deposit,
    lower(trim(nearest_station, '{BLANKS}')) IN ({{stations}}) AS direct_line_to_office,
    CAST(latitude AS VARCHAR) || ', ' || CAST(longitude AS VARCHAR) AS location,
    CASE WHEN latitude IS NOT NULL AND asked_1 > 0
      THEN coalesce(CAST(minutes_1 AS VARCHAR) || ' mins', 'N/A') END AS location_1,
    CASE WHEN latitude IS NOT NULL AND asked_2 > 0
      THEN coalesce(CAST(minutes_2 AS VARCHAR) || ' mins', 'N/A') END AS location_2,
    CASE WHEN latitude IS NOT NULL AND asked_1 > 0 THEN minutes_1 END AS m1,
    CASE WHEN latitude IS NOT NULL AND asked_2 > 0 THEN minutes_2 END AS m2,
    CAST(len(list_filter(words, lambda w: list_contains({{counted}}, w))) AS INT) AS collective_word_count,
    contains(poster_type, 'flatmate') AND latitude IS NOT NULL AS preferable_poster_type
  FROM base b LEFT JOIN typed t USING (id) LEFT JOIN prices p USING (id)
    LEFT JOIN deposits d USING (id) LEFT JOIN commutes c USING (id)),
rooms AS (
  SELECT *, CAST(printf('%.1f', {{score}}) AS DOUBLE) AS score,
    CASE WHEN room_sizes IS NULL OR NOT contains(room_sizes, 'double') THEN 'room_sizes'
      WHEN location IS NULL THEN 'location'
      WHEN NOT available_all_week THEN 'available_all_week' END AS reason
  FROM joined),
seeds AS (
  SELECT unnest(list_filter([
      CASE WHEN o_orderkey % 17 = 0 THEN 'ignored' END,
      CASE WHEN o_orderkey % 23 = 0 THEN 'favourites' END,
      CASE WHEN o_orderkey % 29 = 0 THEN 'messaged' END], lambda x: x IS NOT NULL)) AS list_name,
    {ID} AS id FROM orders),
updates AS (
  SELECT CAST(event_id AS VARCHAR) AS id, CASE event_type WHEN 'click' THEN 'f' WHEN 'purchase' THEN 'Messaged'
    WHEN 'error' THEN 'IGNORE' WHEN 'signup' THEN 'maybe' END AS status FROM events),
merged AS (
  SELECT list_name, id FROM seeds
  UNION
  SELECT CASE lower(status) WHEN 'f' THEN 'favourites' WHEN 'messaged' THEN 'messaged'
    WHEN 'ignore' THEN 'ignored' END AS list_name, id
  FROM updates WHERE lower(status) IN ('f', 'messaged', 'ignore')),
statuses AS (
  SELECT id, CASE WHEN id IN (SELECT id FROM merged WHERE list_name = 'messaged') THEN 'MESSAGED'
    WHEN id IN (SELECT id FROM merged WHERE list_name = 'favourites') THEN 'FAVOURITE' ELSE '' END AS status
  FROM base WHERE id NOT IN (SELECT id FROM merged WHERE list_name = 'ignored')),
snapshots AS (
  SELECT url, 1 AS age, FALSE AS expired, TRUE AS contactable FROM base WHERE CAST(id AS BIGINT) % 13 <> 0
  UNION ALL
  SELECT url, 0, expired, contactable FROM base WHERE CAST(id AS BIGINT) % 13 <> 0),
latest AS (
  SELECT url, arg_min(expired, age) AS expired, arg_min(contactable, age) AS contactable
  FROM snapshots GROUP BY url)
"""


def _bool(column: str) -> str:
    word = f"lower(trim({column}, '{BLANKS}'))"
    return (
        f"CASE WHEN {word} IN ('furnished', 'yes', 'shared', 'some') THEN TRUE "
        f"WHEN {word} IN ('unfurnished', 'no') THEN FALSE END"
    )


def _flag(column: str, weight: int) -> str:
    return f"{weight} * CASE WHEN {column} THEN 1::DOUBLE ELSE 0::DOUBLE END"


def _falling(value: str, low: int, high: int, weight: int) -> str:
    return f"{weight} * coalesce(1 - (({value})::DOUBLE - {low}) / {high - low}, 0::DOUBLE)"


ROOM_COUNT = "coalesce(total_number_of_rooms, TRY_CAST(regexp_extract(rooms_text, '[0-9]+') AS INT))"
TERM = "TRY_CAST(regexp_extract(minimum_term, '[0-9]+') AS INT)"

# The terms in weight order; two weights have no column and add nothing.
SCORE = " + ".join(
    [
        _flag("direct_line_to_office", 1),
        _falling("m1", 20, 60, 6),
        _falling("m2", 20, 60, 6),
        _falling(TERM, 0, 12, 1),
        _flag("bills_included", 4),
        _flag("broadband_included", 1),
        _flag("garden_or_patio", 1),
        _flag("living_room", 3),
        _falling(ROOM_COUNT, 2, 6, 2),
        _falling("average_price", 700, 1000, 5),
        _flag("furnishings", 2),
        "8 * (collective_word_count::DOUBLE / 7)",
        _flag("preferable_poster_type", 1),
    ]
)

COUNTED = ("we", "us", "our", "ours", "together", "household", "home", "shared", "sharing")


def listing_sql(query: str) -> str:
    """``query`` over the derived tables."""
    ctes = CTES
    for name in ("bills", "broadband", "furnishings", "garden", "living"):
        ctes = ctes.replace("{bool:%s_text}" % name, _bool(f"{name}_text"))
    ctes = ctes.replace("{stations}", ", ".join(text(s.lower()) for s in DIRECT_LINE_STATIONS))
    ctes = ctes.replace("{counted}", texts(COUNTED)).replace("{score}", SCORE)
    ctes = ctes.replace("{{", "{").replace("}}", "}")
    return f"WITH {ctes.strip()} {query}"


EXPORT = """
SELECT s.status, r.id, r.url, poster_type, strftime(date_added, '%d-%b') AS date_added, type, area, score,
  collective_word_count, average_price, average_deposit, location_1, location_2, direct_line_to_office,
  location, nearest_station, available, minimum_term, maximum_term, bills_included, broadband_included,
  furnishings, garden_or_patio, living_room, balcony_or_roof_terrace, number_of_flatmates,
  total_number_of_rooms
FROM rooms r JOIN statuses s USING (id)
WHERE reason IS NULL AND average_price > 700
ORDER BY score DESC NULLS FIRST, r.id, r.url
"""

POPUP = """'<b>ID:</b> ' || r.id || '<br><b>Date added:</b> ' || CAST(date_added AS VARCHAR)
  || '<br><b>Score:</b> ' || CAST(score AS VARCHAR) || '<br><b>Price:</b> '
  || coalesce(CAST(average_price AS VARCHAR), 'None') || '<br><a href="' || r.url || '" target="_blank">View room</a>'
  || CASE WHEN image_url <> '' THEN '<br><img src="' || image_url || '" width="100">' ELSE '' END"""

FAVOURITE = "lower(s.status) = 'favourite'"

MARKERS = (
    f"SELECT 'favourites' AS layer, r.id, latitude, longitude, {POPUP} AS popup "
    f"FROM rooms r JOIN statuses s USING (id) WHERE {FAVOURITE} AND location IS NOT NULL "
    f"UNION ALL SELECT 'new_listings', r.id, latitude, longitude, {POPUP} "
    f"FROM rooms r JOIN statuses s USING (id) WHERE score > 15 AND date_added = {NEW_DAY} "
    f"AND NOT {FAVOURITE} AND location IS NOT NULL"
)

# Field and the column of its page text.
PAGE_TEXTS = {
    "bills_included": "bills_text", "broadband_included": "broadband_text", "furnishings": "furnishings_text",
    "garden_or_patio": "garden_text", "living_room": "living_text", "number_of_flatmates": "mates_text",
    "total_number_of_rooms": "rooms_text",
}
UNREAD = "".join(
    f" UNION ALL SELECT 1, 'unread_{name}', count(*) FROM fresh WHERE {column} IS NOT NULL AND {name} IS NULL"
    for name, column in PAGE_TEXTS.items()
) + "".join(f" UNION ALL SELECT 1, 'no_route_{n}', count(*) FROM fresh WHERE location_{n} = 'N/A'" for n in (1, 2))

# Two daily runs: what the result pages name, what is parsed, what is kept, what is still up.
RUNS = """, wanted AS (
  SELECT DISTINCT CAST(o_orderkey * 5 + j * 7 AS VARCHAR) AS id
  FROM orders CROSS JOIN range(10) AS g(j) WHERE (o_orderkey + j) % 9 <> 0),
fresh AS (
  SELECT * FROM rooms WHERE id IN (SELECT id FROM wanted)
    AND id NOT IN (SELECT id FROM merged WHERE list_name = 'ignored')),
added AS (SELECT * FROM fresh WHERE reason IS NULL),
live AS (SELECT * FROM added WHERE url IN (SELECT url FROM latest WHERE NOT expired AND contactable))"""

ORACLES: dict[str, str] = {
    "average_price": listing_sql("SELECT b.id, average_price FROM base b LEFT JOIN prices USING (id)"),
    "room_sizes": listing_sql("SELECT b.id, room_sizes FROM base b LEFT JOIN prices USING (id)"),
    "average_deposit": listing_sql(
        "SELECT b.id, average_deposit FROM base b LEFT JOIN deposits USING (id)"
    ),
    "typed_features": listing_sql(
        "SELECT id, available, minimum_term, maximum_term, bills_included, broadband_included, furnishings, "
        "furnishings_text AS raw_furnishings, garden_or_patio, living_room, balcony_or_roof_terrace, "
        "number_of_flatmates, mates_text AS raw_number_of_flatmates, total_number_of_rooms, "
        "rooms_text AS raw_total_number_of_rooms FROM typed"
    ),
    "string_to_number": """
        SELECT source, row_id, TRY_CAST(replace(regexp_extract(txt, '[0-9,]+'), ',', '') AS BIGINT) AS number
        FROM (SELECT 'pages' AS source, page_id AS row_id, url AS txt FROM pages
              UNION ALL SELECT 'part', p_partkey, p_name FROM part)""",
    "id_from_url": """
        SELECT page_id, nullif(split_part(split_part(url, '=', 2), '&', 1), '') AS id FROM pages""",
    "clean_string": f"""
        SELECT doc_id, lower(trim(nfc_normalize(chr(160) || ' ' || text || chr(9)), '{BLANKS}')) AS cleaned
        FROM documents""",
    "word_count": """
        SELECT doc_id, CAST(len(list_filter(string_split(text, ' '), lambda w:
          list_contains(['the', 'of', 'and', 'to', 'in', 'la', 'de', 'und'], w))) AS INT) AS n_words
        FROM documents""",
    "new_urls": listing_sql(
        f"SELECT url, id FROM base WHERE id NOT IN (SELECT {ID} FROM orders "
        f"WHERE o_orderdate < TIMESTAMP '{D.NEW_FROM}') "
        "AND id NOT IN (SELECT id FROM seeds WHERE list_name = 'ignored')"
    ),
    "distinct_urls": "SELECT url, min(page_id) AS pos FROM pages GROUP BY url ORDER BY pos, url",
    "collect_urls": """
        SELECT url, min(page_no) AS page_no, CAST(arg_min(pos, (page_no, pos)) AS INT) AS pos FROM (
          SELECT o_orderkey AS page_no, row_number() OVER (PARTITION BY o_orderkey ORDER BY j) - 1 AS pos,
            'listing?listing_id=' || CAST(o_orderkey * 5 + j * 7 AS VARCHAR) || '&mode=list' AS url
          FROM orders CROSS JOIN range(10) AS r(j) WHERE (o_orderkey + j) % 9 <> 0)
        GROUP BY url""",
    "direct_line": listing_sql("SELECT id, nearest_station, direct_line_to_office FROM joined"),
    "commute_minutes": listing_sql("SELECT id, location_1, location_2, m1 AS location_1_mins, m2 AS location_2_mins FROM joined"),
    "last_tuesday": """
        SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE)
            - CAST((isodow(o_orderdate) - 2 + 7) % 7 AS INT), '%Y-%m-%dT09:00:00Z') AS arrival
        FROM orders""",
    "score": listing_sql("SELECT id, score FROM rooms"),
    "rescore": listing_sql(
        "SELECT id, CAST(printf('%.1f', "
        + " + ".join([_falling("average_price", 700, 1000, 10), _flag("direct_line_to_office", 3)])
        + ") AS DOUBLE) AS score FROM rooms"
    ),
    "valid_listings": listing_sql("SELECT id, room_sizes, location FROM rooms WHERE reason IS NULL"),
    "rejected_reasons": listing_sql(
        "SELECT reason, count(*) AS n FROM rooms WHERE reason IS NOT NULL GROUP BY reason"
    ),
    "merge_curation": listing_sql("SELECT list_name, id FROM merged ORDER BY list_name, id"),
    "new_curation": listing_sql(
        "SELECT list_name, id FROM merged EXCEPT SELECT list_name, id FROM seeds"
    ),
    "invalid_statuses": listing_sql("SELECT id, status FROM updates WHERE status = 'maybe'"),
    "drop_ignored": listing_sql(
        "SELECT id, url FROM base WHERE id NOT IN (SELECT id FROM merged WHERE list_name = 'ignored')"
    ),
    "apply_statuses": listing_sql("SELECT id, status FROM statuses"),
    "live_listings": listing_sql(
        "SELECT id, url FROM base WHERE url IN (SELECT url FROM latest WHERE NOT expired AND contactable)"
    ),
    "export_ranked": listing_sql(EXPORT),
    "newest_k": """
        SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 200""",
    "search_listings": listing_sql(
        "SELECT id, average_price, area, type FROM joined WHERE average_price BETWEEN 200 AND 900 "
        "AND contains(lower(area), 'london') AND available_all_week AND contains(room_sizes, 'double') "
        f"AND image_url <> '' AND contains(poster_type, 'landlord') AND coalesce({TERM}, 0) <= 6 "
        "AND type NOT IN ('Studio flat', 'Whole property to let')"
    ),
    "map_markers": listing_sql(MARKERS),
    "run_metrics": listing_sql(
        "SELECT 'listings' AS metric, count(*) AS n FROM base "
        "UNION ALL SELECT 'active', count(*) FROM latest WHERE NOT expired AND contactable "
        "UNION ALL SELECT 'gone', count(*) FROM base WHERE url NOT IN "
        "(SELECT url FROM latest WHERE NOT expired AND contactable) "
        "UNION ALL SELECT 'new', count(*) FROM base WHERE id NOT IN (SELECT id FROM seeds "
        f"WHERE list_name = 'ignored') AND date_added = {NEW_DAY}"
    ),
    "append_listings": listing_sql(
        f"SELECT id, CASE WHEN date_added = {NEW_DAY} THEN '{D.DOMAIN}/' || url ELSE url END AS url, "
        "location, date_added, score FROM rooms WHERE reason IS NULL"
    ),
    "extract_listing": listing_sql(
        f"SELECT id, url, type, area, ltrim(nearest_station, '{BLANKS}') AS nearest_station, 'E14 ' AS postcode, "
        "available_all_week, image_url, latitude, longitude, poster_type, collective_word_count, expired, "
        "contactable, features FROM joined JOIN (SELECT id, string_agg(key || '=' || value, ';' ORDER BY pos) "
        "AS features FROM entries GROUP BY id) USING (id)"
    ),
    "feature_rows": listing_sql("SELECT id, key, value FROM entries"),
    "extract_links": """
        SELECT page_id, CAST(generate_subscripts(links, 1) - 1 AS INT) AS pos,
          replace(unnest(list_transform(links, lambda a: regexp_extract(a, 'href="([^"]*)"', 1))), '&amp;', '&') AS link,
          replace(unnest(list_transform(links, lambda a: regexp_extract(a, '>([^<]*)<', 1))), '&amp;', '&') AS text
        FROM (SELECT page_id, regexp_extract_all(regexp_extract(html, '(?s)<nav>.*?</nav>'), '<a [^>]*>[^<]*</a>') AS links
              FROM pages)""",
    "incremental_ingest": listing_sql(
        f"SELECT id, '{D.DOMAIN}/' || url AS url, score FROM rooms WHERE reason IS NULL "
        "AND id NOT IN (SELECT id FROM seeds WHERE list_name = 'ignored')"
    ),
    "ingest_duplicates": listing_sql(
        f"SELECT id, '{D.DOMAIN}/' || url AS url, score FROM rooms "
        "WHERE id NOT IN (SELECT id FROM seeds WHERE list_name = 'ignored') "
        f"AND id NOT IN (SELECT {ID} FROM orders WHERE o_orderdate < TIMESTAMP '{D.NEW_FROM}')"
    ),
    "rejected_urls": """
        SELECT DISTINCT url, CAST(NULL AS VARCHAR) AS id, 'no id in url' AS reason FROM pages
        WHERE url IS NOT NULL AND split_part(split_part(url, '=', 2), '&', 1) = ''""",
    "expire_from_pages": listing_sql(
        f"SELECT id, '{D.DOMAIN}/' || url AS url FROM base "
        "WHERE url IN (SELECT url FROM latest WHERE NOT expired AND contactable)"
    ),
    "daily_run": listing_sql(
        f"{RUNS} SELECT l.id, '{D.DOMAIN}/' || url AS url, s.status, score FROM live l JOIN statuses s USING (id)"
    ),
    "run_counts": listing_sql(
        f"{RUNS} SELECT 1 AS run, 'stored' AS metric, 0 AS n UNION ALL SELECT 1, 'active', 0 "
        "UNION ALL SELECT 1, 'expired', 0 UNION ALL SELECT 1, 'dropped', 0 "
        "UNION ALL SELECT 1, 'invalid_statuses', count(*) FROM updates WHERE status = 'maybe' "
        "UNION ALL SELECT 1, 'retrieved', count(*) FROM wanted "
        "UNION ALL SELECT 1, 'crawled', count(*) FROM base WHERE id IN (SELECT id FROM wanted) "
        "UNION ALL SELECT 1, 'new', count(*) FROM fresh "
        "UNION ALL SELECT 1, 'rejected', count(*) FROM fresh WHERE reason IS NOT NULL "
        "UNION ALL SELECT 1, 'added', count(*) FROM added UNION ALL SELECT 1, 'listings', count(*) FROM added "
        "UNION ALL SELECT 2, 'stored', count(*) FROM added UNION ALL SELECT 2, 'active', count(*) FROM live "
        "UNION ALL SELECT 2, 'expired', (SELECT count(*) FROM added) - (SELECT count(*) FROM live) "
        "UNION ALL SELECT 2, 'dropped', 0 UNION ALL SELECT 2, 'invalid_statuses', 0 "
        f"UNION ALL SELECT 2, 'listings', count(*) FROM live {UNREAD}"
    ),
    "run_rejects": listing_sql(
        f"{RUNS} SELECT '{D.DOMAIN}/' || url AS url, id, reason FROM fresh WHERE reason IS NOT NULL "
        f"UNION ALL SELECT '{D.DOMAIN}/listing?listing_id=' || id || '&mode=list', id, 'no page' "
        "FROM wanted WHERE id NOT IN (SELECT id FROM base)"
    ),
    "marker_features": listing_sql(
        f"SELECT 'Feature' AS type, 'Point' AS geometry, * FROM ({MARKERS})"
    ),
    "status_stream": listing_sql("SELECT list_name, id FROM merged"),
}
