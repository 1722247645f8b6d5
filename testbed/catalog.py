"""The registered queries, each over the whole of the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentrank.functions.dates import last_tuesday_9am
from rentrank.functions.text import clean_string, count_words, id_from_url, string_to_number
from rentrank.operators import curate, enrich, export, extract, ingest, live, markers, metrics
from rentrank.operators import normalise, score, search, validate
from rentrank.plans import daily
from rentrank.plans.daily import RunPaths
from rentrank.plans.pages import current_flags, latest_pages, with_absolute_urls
from rentrank.plans.rooms import new_rooms, score_rooms
from rentrank.schema import EXPORT_COLS
from rentrank.session import work_dir
from rentrank.settings import JobConfig
from rentrank.sources import tables
from rentrank.streaming import ingest as streaming
from testbed import derived as D

CONFIG = JobConfig(run_date=D.RUN_DATE, domain=D.DOMAIN, min_rent=700)
FREQUENT_WORDS = ("the", "of", "and", "to", "in", "la", "de", "und")
OTHER_WEIGHTS = {"average_price": 10, "direct_line_to_office": 3}


def _order_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"))


def rooms(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = D.listings_raw(spark, sf_dir).withColumn(
        "collective_word_count", count_words(F.col("description"), extract.COLLECTIVE_WORDS)
    )
    responses = D.commute_responses(spark, sf_dir)
    return score_rooms(raw, responses, CONFIG, measure=_order_ids(spark, sf_dir))


def merged_curation(spark: SparkSession, sf_dir: str) -> DataFrame:
    updates = D.status_updates(D.table(spark, sf_dir, "events"))
    return curate.merge_curation(D.curation(spark, sf_dir), updates)


def curated_rooms(spark: SparkSession, sf_dir: str) -> DataFrame:
    measure = _order_ids(spark, sf_dir)
    return curate.apply_statuses(rooms(spark, sf_dir), merged_curation(spark, sf_dir), measure)


def average_price(spark, sf_dir):
    raw = D.listings_raw(spark, sf_dir)
    return raw.select("id", normalise.average_price(F.col("features")).alias("average_price"))


def room_sizes(spark, sf_dir):
    sizes = F.array_join(normalise.room_sizes(F.col("features")), ",")
    return D.listings_raw(spark, sf_dir).select("id", sizes.alias("room_sizes"))


def average_deposit(spark, sf_dir):
    raw = D.listings_labels(spark, sf_dir)
    return raw.select("id", normalise.average_deposit(F.col("features")).alias("average_deposit"))


def typed_features(spark, sf_dir):
    typed = normalise.cast_fields(normalise.rename_features(D.listings_labels(spark, sf_dir)))
    return typed.select(
        "id", *normalise.PLAIN_LABELS, *normalise.LABELS, "raw_furnishings",
        "raw_number_of_flatmates", "raw_total_number_of_rooms",
    )


def string_numbers(spark, sf_dir):
    pages = D.table(spark, sf_dir, "pages").select(
        F.lit("pages").alias("source"), F.col("page_id").alias("row_id"), F.col("url").alias("txt")
    )
    part = D.table(spark, sf_dir, "part").select(
        F.lit("part").alias("source"), F.col("p_partkey").alias("row_id"), F.col("p_name").alias("txt")
    )
    number = string_to_number(F.col("txt")).alias("number")
    return pages.unionByName(part).select("source", "row_id", number)


def ids_from_urls(spark, sf_dir):
    return D.table(spark, sf_dir, "pages").select("page_id", id_from_url(F.col("url")).alias("id"))


def clean_strings(spark, sf_dir):
    padded = F.concat(F.lit("\u00a0 "), F.col("text"), F.lit("\t"))
    return D.table(spark, sf_dir, "documents").select("doc_id", clean_string(padded).alias("cleaned"))


def word_count(spark, sf_dir):
    words = count_words(F.col("text"), FREQUENT_WORDS).alias("n_words")
    return D.table(spark, sf_dir, "documents").select("doc_id", words)


def new_urls(spark, sf_dir):
    batch = D.listing_columns(D.orders_table(spark, sf_dir)).select("url")
    ignored = D.curation(spark, sf_dir).filter(F.col("list_name") == "ignored")
    return ingest.new_urls(batch, D.known_ids(spark, sf_dir), ignored)


def distinct_urls(spark, sf_dir):
    pages = D.table(spark, sf_dir, "pages").select("url", F.col("page_id").alias("pos"))
    return ingest.distinct_urls(pages.unionByName(pages)).orderBy("pos", "url")


def collect_urls(spark, sf_dir):
    found = extract.result_urls(D.result_pages(spark, sf_dir))
    return ingest.distinct_urls(found, ("page_no", "pos"))


def direct_line(spark, sf_dir):
    flag = enrich.direct_line(F.col("nearest_station")).alias("direct_line_to_office")
    columns = D.listing_columns(D.orders_table(spark, sf_dir))
    return columns.select("id", "nearest_station", flag)


def commute_minutes(spark, sf_dir):
    listings = D.listing_columns(D.orders_table(spark, sf_dir)).select("id", "latitude", "longitude")
    responses = D.commute_responses(spark, sf_dir)
    measure = _order_ids(spark, sf_dir)
    return enrich.commute_times(listings, responses, measure=measure).drop("latitude", "longitude")


def last_tuesday(spark, sf_dir):
    arrival = last_tuesday_9am(F.col("o_orderdate").cast("date")).alias("arrival")
    return D.table(spark, sf_dir, "orders").select("o_orderkey", arrival)


def scores(spark, sf_dir):
    return rooms(spark, sf_dir).select("id", "score")


def rescored(spark, sf_dir):
    return score.rescore(rooms(spark, sf_dir), OTHER_WEIGHTS).select("id", "score")


def valid_listings(spark, sf_dir):
    valid = validate.valid_listings(rooms(spark, sf_dir))
    return valid.select("id", F.array_join("room_sizes", ",").alias("room_sizes"), "location")


def rejected_reasons(spark, sf_dir):
    return validate.rejected_counts(rooms(spark, sf_dir))


def merge_curation(spark, sf_dir):
    return curate.sorted_ids(merged_curation(spark, sf_dir))


def new_curation(spark, sf_dir):
    updates = D.status_updates(D.table(spark, sf_dir, "events"))
    return curate.new_curation(D.curation(spark, sf_dir), updates)


def invalid_statuses(spark, sf_dir):
    updates = D.status_updates(D.table(spark, sf_dir, "events"))
    return curate.invalid_statuses(updates).select("id", "status")


def drop_ignored(spark, sf_dir):
    listings = D.listing_columns(D.orders_table(spark, sf_dir)).select("id", "url")
    return curate.drop_ignored(listings, merged_curation(spark, sf_dir))


def apply_statuses(spark, sf_dir):
    listings = D.listing_columns(D.orders_table(spark, sf_dir)).select("id", F.lit("").alias("status"))
    return curate.apply_statuses(listings, merged_curation(spark, sf_dir))


def live_listings(spark, sf_dir):
    listings = D.listing_columns(D.orders_table(spark, sf_dir)).select("id", "url")
    return live.live_listings(listings, D.page_snapshots(spark, sf_dir))


def export_ranked(spark, sf_dir):
    valid = validate.valid_listings(curated_rooms(spark, sf_dir))
    # A sort reads its rows twice (for the bounds, then for the rows); written, they are made once.
    narrow = export.above_min_rent(valid, CONFIG.min_rent).select(*EXPORT_COLS)
    return export.export_ranked(tables.written(narrow, "rooms-to-rank"), CONFIG.min_rent)


def newest_k(spark, sf_dir):
    orders = D.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    order = [F.desc("o_orderdate"), F.asc("o_orderkey")]
    return ingest.newest(orders, order, CONFIG.number_of_pages)


def search_listings(spark, sf_dir):
    typed = normalise.normalise_features(D.listings_raw(spark, sf_dir))
    found = search.search_listings(typed, min_rent=200, max_rent=900)
    return found.select("id", "average_price", "area", "type")


def map_markers(spark, sf_dir):
    return markers.map_markers(curated_rooms(spark, sf_dir), D.RUN_DATE, CONFIG.min_marker_score)


def run_metrics(spark, sf_dir):
    """Counts over listings, snapshots and ids, each table in one pass."""
    listings = D.listing_columns(D.orders_table(spark, sf_dir)).select("id", "url")
    flags = live.latest_page_flags(D.page_snapshots(spark, sf_dir))
    up = ~F.col("expired") & F.col("contactable")
    marked = listings.join(flags, "url", "left").withColumn("up", F.coalesce(up, F.lit(False)))
    counts = metrics.counted(marked, listings=F.lit(True), active=F.col("up"), gone=~F.col("up"))
    return counts.unionByName(metrics.run_metrics(new=new_urls(spark, sf_dir)))


def append_listings(spark, sf_dir):
    columns = ["id", "url", "location", "date_added", "score"]
    valid = validate.valid_listings(rooms(spark, sf_dir)).select(*columns)
    valid = tables.written(valid, "valid-rooms")  # both sides below read it; made once
    is_new = F.col("date_added") == F.lit(D.RUN_DATE)
    url = ingest.absolute_url(CONFIG.domain, F.col("url"))
    stored, added = valid.filter(~is_new), valid.filter(is_new).withColumn("url", url)
    return ingest.append_listings(stored, added)


def extract_listing(spark, sf_dir):
    found = extract.extract_listings(D.render_pages(D.listings_raw(spark, sf_dir)))
    pairs = F.transform(F.map_entries("features"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return found.withColumn("features", F.array_join(pairs, ";"))


def feature_rows(spark, sf_dir):
    found = extract.extract_listings(D.render_pages(D.listings_raw(spark, sf_dir)))
    return found.select("id", F.explode("features"))


def extract_links(spark, sf_dir):
    pages = D.table(spark, sf_dir, "pages")
    return extract.extract_links(pages, "page_id", "nav", "", "a", "href")


def incremental_ingest(spark, sf_dir):
    """Pages land as files; two batches add the valid new rooms; the last read is the table."""
    base = work_dir(spark, "ingest")
    landing, listings, lists = f"{base}/pages", f"{base}/listings", f"{base}/curation"
    pages = D.render_pages(D.listings_raw(spark, sf_dir))
    pages.write.parquet(landing)
    tables.append_to_curation(D.curation(spark, sf_dir), lists)
    half = -(-D.tasks(spark) // 2)  # rendering writes a file per task
    stream = tables.stream_parquet(spark, landing, pages.schema, files_per_batch=half)
    tables.store_commute_responses(D.commute_responses(spark, sf_dir), f"{base}/commutes")
    responses = tables.scan_commute_responses(spark, f"{base}/commutes")
    streaming.incremental_ingest(
        stream, listings, lists, f"{base}/checkpoint", CONFIG, responses, f"{base}/rejects", 2
    ).awaitTermination()
    return tables.load_listings(spark, listings).select("id", "url", "score")


def ingest_duplicates(spark, sf_dir):
    """Pages that landed twice, share page ids across urls, have none, or are older copies."""
    pages = D.repeated_pages(D.render_pages(D.listings_to_render(spark, sf_dir)))
    ignored = D.curation(spark, sf_dir).filter(F.col("list_name") == "ignored")
    responses = D.commute_responses(spark, sf_dir)
    found = new_rooms(pages, D.known_ids(spark, sf_dir), ignored, responses, CONFIG)
    return found.select("id", "url", "score")


def rejected_urls(spark, sf_dir):
    """Urls that give no id, of all crawled pages."""
    return daily.rejected_urls(latest_pages(D.table(spark, sf_dir, "pages")))


def expire_from_pages(spark, sf_dir):
    """Listings whose latest snapshot, read off its HTML, is still up; snapshots have crawl urls."""
    listings = D.listing_columns(D.orders_table(spark, sf_dir)).select("id", "url")
    listings = with_absolute_urls(listings, CONFIG.domain)
    snapshots = with_absolute_urls(D.snapshot_pages(spark, sf_dir), CONFIG.domain)
    return live.live_listings(listings, current_flags(snapshots, listings))


def status_stream(spark, sf_dir):
    base = work_dir(spark, "statuses")
    tables.append_to_curation(D.curation(spark, sf_dir), f"{base}/curation")
    path = f"{sf_dir}/events.parquet"
    events = tables.stream_parquet(spark, path, spark.read.parquet(path).schema)
    streaming.status_stream(
        D.status_updates(events), f"{base}/curation", f"{base}/checkpoint"
    ).awaitTermination()
    return tables.load_curation(spark, f"{base}/curation")


def daily_inputs(spark, sf_dir) -> RunPaths:
    """The tables that a run reads, written from the derived ones."""
    base = work_dir(spark, "daily")
    names = ("listings", "curation", "export", "markers", "pages", "results", "snapshots", "commutes", "rejects", "flags")
    paths = RunPaths(*[f"{base}/{n}" for n in names])
    tables.store_pages(D.render_pages(D.listings_raw(spark, sf_dir)), paths.listing_pages, CONFIG.domain)
    D.result_pages(spark, sf_dir).write.parquet(paths.result_pages)
    D.snapshot_pages(spark, sf_dir).write.parquet(paths.snapshots)
    tables.store_commute_responses(D.commute_responses(spark, sf_dir), paths.commute_responses)
    tables.append_to_curation(D.curation(spark, sf_dir), paths.curation)
    updates = D.status_updates(D.table(spark, sf_dir, "events"))
    blank = F.lit(None).cast("string")
    edited = [F.col(c) if c in updates.columns else blank.alias(c) for c in EXPORT_COLS]
    tables.write_export(updates.select(*edited), paths.export)
    return paths


def two_runs(spark, paths: RunPaths) -> tuple[DataFrame, DataFrame]:
    """The counts of a first run, which adds rooms, and of a second, which drops expired ones."""
    every_page = replace(CONFIG, number_of_pages=2**62)
    first = daily.daily_run(spark, paths, every_page)
    later = replace(every_page, update_only=True, check_expired=True, keep_versions=2)
    return first, daily.daily_run(spark, paths, later)


def daily_run(spark, sf_dir):
    """Two full runs over written tables; the last read is the listings table."""
    paths = daily_inputs(spark, sf_dir)
    two_runs(spark, paths)
    return tables.load_listings(spark, paths.listings).select("id", "url", "status", "score")


def run_counts(spark, sf_dir):
    """What the two runs report."""
    first, second = two_runs(spark, daily_inputs(spark, sf_dir))
    return first.withColumn("run", F.lit(1)).unionByName(second.withColumn("run", F.lit(2)))


def run_rejects(spark, sf_dir):
    """What a first run did not take, and the retrieved urls without a page, from its table."""
    paths = daily_inputs(spark, sf_dir)
    daily.daily_run(spark, paths, replace(CONFIG, number_of_pages=2**62))
    return tables.load_rejects(spark, paths.rejects)


def marker_features(spark, sf_dir):
    """The GeoJSON lines of the markers, read back."""
    kind = (
        "type string, geometry struct<type:string,coordinates:array<double>>, "
        "properties struct<layer:string,id:string,popup:string>"
    )
    lines = markers.geojson_features(map_markers(spark, sf_dir))
    return lines.select(F.from_json("value", kind).alias("f")).select(
        F.col("f.type").alias("type"), F.col("f.geometry.type").alias("geometry"),
        F.get("f.geometry.coordinates", F.lit(0)).alias("longitude"),
        F.get("f.geometry.coordinates", F.lit(1)).alias("latitude"), "f.properties.*",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "average_price": average_price,
    "room_sizes": room_sizes,
    "average_deposit": average_deposit,
    "typed_features": typed_features,
    "string_to_number": string_numbers,
    "id_from_url": ids_from_urls,
    "clean_string": clean_strings,
    "word_count": word_count,
    "new_urls": new_urls,
    "distinct_urls": distinct_urls,
    "collect_urls": collect_urls,
    "direct_line": direct_line,
    "commute_minutes": commute_minutes,
    "last_tuesday": last_tuesday,
    "score": scores,
    "rescore": rescored,
    "valid_listings": valid_listings,
    "rejected_reasons": rejected_reasons,
    "merge_curation": merge_curation,
    "new_curation": new_curation,
    "invalid_statuses": invalid_statuses,
    "drop_ignored": drop_ignored,
    "apply_statuses": apply_statuses,
    "live_listings": live_listings,
    "export_ranked": export_ranked,
    "newest_k": newest_k,
    "search_listings": search_listings,
    "map_markers": map_markers,
    "run_metrics": run_metrics,
    "append_listings": append_listings,
    "extract_listing": extract_listing,
    "feature_rows": feature_rows,
    "extract_links": extract_links,
    "incremental_ingest": incremental_ingest,
    "ingest_duplicates": ingest_duplicates,
    "rejected_urls": rejected_urls,
    "expire_from_pages": expire_from_pages,
    "status_stream": status_stream,
    "daily_run": daily_run,
    "run_counts": run_counts,
    "run_rejects": run_rejects,
    "marker_features": marker_features,
}
