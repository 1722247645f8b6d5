"""Benchmark passages in training documents, by a positional inverted index of the documents.

The index holds, per document and term that any benchmark item uses, the term's positions; it is
a bucketed table, so that nothing of it is shuffled when it is searched. A window of an item is
looked up from its rarest term: the positions of that term, less its place in the item, say where
the item would have to begin; the window's next rarest term, shifted alike, thins these out, and
what is left is intersected with every term of the item. Runs of consecutive hits as long as a
window are exact phrase matches; with terms up to SLOP words off their places, proximity matches.
Built from DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from rentrank.llm.store import bucketed, saved, table, text_hash
from rentrank.llm.text import lowered

WINDOW = 10
#: Words that a term of a proximity match may be off its place.
SLOP = 3
#: Java has it as: anything but a digit, a letter (A-Z are lower-cased later) or beyond ASCII.
GAP = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
DOC = ["_id", "_text"]


def _pieces(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), GAP)


def word_count(text: str = "text") -> Column:
    """Words of a text: its pieces but for an empty first and last one."""
    pieces = _pieces(text)
    n = F.size(pieces)
    first = F.when(F.get(pieces, F.lit(0)) == "", 1).otherwise(0)
    last = F.when((n > 1) & (F.get(pieces, n - 1) == ""), 1).otherwise(0)
    return (n - first - last).cast("long")


def _words(texts: DataFrame, key: list[str], text: str) -> DataFrame:
    """``key``, _at, _word. Places count from 0, or from 1 if the text begins with a gap."""
    spread = texts.select(*key, F.posexplode(_pieces(text)).alias("_at", "_raw"))
    return spread.filter("_raw <> ''").select(*key, "_at", lowered(F.col("_raw")).alias("_word"))


def items_of(benchmark: DataFrame) -> DataFrame:
    """_item, _off, _word, _len: the words, from 0, of each distinct item text (by its hash)."""
    rows = benchmark.select(text_hash().alias("_item"), "text").dropDuplicates(["_item"])
    words = _words(rows, ["_item"], "text")
    whole = Window.partitionBy("_item")
    return words.select(
        "_item", (F.col("_at") - F.min("_at").over(whole)).alias("_off"), "_word",
        F.count(F.lit(1)).over(whole).cast("int").alias("_len"),
    )


def document_key() -> list[Column]:
    """What a document is found by: its id and text. Rows alike in both have the same matches."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("_id"), text_hash().alias("_text")]


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The positional index: _id, _text, _term, _tf, _places (ascending not promised).

    ``terms``: (_word, _term). A written table, in buckets by document. Rows alike in id and text are
    one before they are dealt out, however many there are.
    """
    once = docs.select(*document_key(), F.col("text").alias("_body")).groupBy(*DOC).agg(F.first("_body").alias("_body"))
    found = _words(once, DOC, "_body").join(terms, "_word").select(*DOC, "_term", "_at")
    postings = found.groupBy(*DOC, "_term").agg(F.collect_list("_at").alias("_places"))
    return bucketed(postings.withColumn("_tf", F.size("_places")), "postings", *DOC)


def _anchors(items: DataFrame, index: DataFrame, window: int) -> DataFrame:
    """_item, _len, _off, _term, _off2, _term2: each window's two rarest terms, once.

    Windows with a term that no document has are left out: they match nowhere. A window of one
    word has itself as its second term.
    """
    rarity = index.groupBy("_term").agg(F.sum("_tf").alias("_freq"))
    ranked = items.join(saved(rarity, "rarity"), "_term", "left")
    starts = F.explode(
        F.sequence(
            F.greatest(F.lit(0), F.least(F.col("_off"), F.col("_len") - window) - window + 1),
            F.greatest(F.lit(0), F.least(F.col("_off"), F.col("_len") - window)),
        )
    )
    spread = ranked.select("*", starts.alias("_start")).filter(F.col("_off") - F.col("_start") < window)
    own = Window.partitionBy("_item", "_start")
    order = own.orderBy("_freq", "_word", "_off")
    rare = spread.select(
        "_item", "_len", "_off", "_term",
        F.row_number().over(order).alias("_rank"),
        F.coalesce(F.lead("_off").over(order), F.col("_off")).alias("_off2"),
        F.coalesce(F.lead("_term").over(order), F.col("_term")).alias("_term2"),
        F.min(F.col("_freq").isNotNull()).over(own).alias("_all"),
    )
    return rare.filter("_rank = 1 AND _all").drop("_rank", "_all").distinct()


def candidates(items: DataFrame, index: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """_id, _text, _item, _len, _begin: where an item may begin in a document.

    A candidate has some window's two rarest terms at their places, or the second at most
    ``slop`` words off its place.
    """
    anchors = saved(_anchors(items, index, window), "anchors")
    first = index.join(anchors, "_term").select(
        *DOC, "_item", "_len", F.explode("_places").alias("_at"), "_off", "_off2", F.col("_term2").alias("_term")
    )
    # Of the index only the lists of the second terms are dealt out again.
    seconds = saved(anchors.select(F.col("_term2").alias("_term")).distinct(), "seconds")
    lists = index.join(seconds, "_term", "left_semi").select(*DOC, "_term", F.explode("_places").alias("_place"))
    begin = (F.col("_at") - F.col("_off")).alias("_begin")
    wanted = F.col("_at") - F.col("_off") + F.col("_off2")
    # One row per place that will do, so that terms meet by place: never each with each.
    places = F.explode(F.sequence(wanted - slop, wanted + slop)) if slop else wanted
    found = first.withColumn("_place", places).join(lists, [*DOC, "_term", "_place"])
    return found.select(*DOC, "_item", "_len", begin).distinct()


def met_words(items: DataFrame, index: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """_id, _text, _item, _len, _begin, _off, _exact: words of items where an item may begin.

    ``_off`` is the word's place in the item; the document has the word at most ``slop`` words off
    that place after ``_begin``, or, if ``_exact``, at it.
    """
    asked, lists = _asked(saved(candidates(items, index, window, slop), "candidates"), items, index)
    lists, columns = lists.distinct(), [*DOC, "_item", "_len", "_begin", "_off"]
    if not slop:
        met = asked.withColumnRenamed("_wanted", "_place").join(lists, [*DOC, "_term", "_place"])
        return met.select(*columns, F.lit(True).alias("_exact"))
    places = F.explode(F.sequence(F.col("_wanted") - slop, F.col("_wanted") + slop))
    met = asked.withColumn("_place", places).join(lists, [*DOC, "_term", "_place"])
    at_place = F.max(F.col("_place") == F.col("_wanted")).alias("_exact")
    return met.groupBy(*columns).agg(at_place)


def _runs(met: DataFrame, window: int) -> DataFrame:
    """Longest runs of an item's words in ``met`` that are as long as a window or the item."""
    begin = [*DOC, "_item", "_len", "_begin"]
    run = F.col("_off") - F.row_number().over(Window.partitionBy(*begin).orderBy("_off"))
    runs = met.withColumn("_run", run).groupBy(*begin, "_run").agg(
        F.min("_off").alias("_from"), F.max("_off").alias("_to")
    )
    return runs.filter(F.col("_to") - F.col("_from") + 1 >= F.least(F.col("_len"), F.lit(window)))


def _asked(starts: DataFrame, items: DataFrame, index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every word of each candidate's item, and the lists of the candidates' documents."""
    documents = saved(starts.select(*DOC).distinct(), "candidate-documents")
    lists = index.join(documents, DOC, "left_semi").select(*DOC, "_term", F.explode("_places").alias("_place"))
    words = items.select("_item", "_off", "_term")
    return starts.join(words, "_item").withColumn("_wanted", F.col("_begin") + F.col("_off")), lists


def phrases(met: DataFrame, window: int = WINDOW) -> DataFrame:
    """_id, _text, _item, _first, _last: word places of the exact phrase matches in ``met``.

    A match is a longest run of consecutive words of an item, at least ``window`` of them, or all
    words of a shorter item.
    """
    return _runs(met.filter("_exact"), window).select(
        *DOC, "_item", (F.col("_begin") + F.col("_from")).alias("_first"), (F.col("_begin") + F.col("_to")).alias("_last")
    )


def passages(met: DataFrame, window: int = WINDOW) -> DataFrame:
    """_id, _text, _item, _begin: the proximity matches in ``met``, exact ones among them."""
    return _runs(met, window).select(*DOC, "_item", "_begin").distinct()


def exact_matches(items: DataFrame, index: DataFrame, window: int = WINDOW) -> DataFrame:
    """The exact phrase matches of all documents."""
    return phrases(met_words(items, index, window), window)


def near_matches(items: DataFrame, index: DataFrame, window: int = WINDOW, slop: int = SLOP) -> DataFrame:
    """The proximity matches of all documents.

    Some window's rarest term stands at its place, its next rarest and every word of a window at
    most ``slop`` words off their own: insertions and swaps of words don't hide a passage.
    """
    return passages(met_words(items, index, window, slop), window)


def indexed(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items with term numbers, index of ``docs``), as written tables."""
    items = saved(items_of(benchmark), "items")
    numbered = items.select("_word").distinct().select("_word", F.xxhash64("_word").alias("_term"))
    terms = saved(numbered, "terms")
    items = saved(items.join(terms, "_word"), "item-terms")
    return items, build_index(docs, terms)


def hits(matches: DataFrame, names: DataFrame) -> DataFrame:
    """_id, _text, n_hit, _items: words inside any match, and the item ids that matched.

    ``names``: (_item, _name), the ids of each item text.
    """
    # Matches that overlap or touch count once: a match adds what lies beyond all before it.
    before = Window.partitionBy(*DOC).orderBy("_first", "_last").rowsBetween(Window.unboundedPreceding, -1)
    spans = matches.select(*DOC, "_first", "_last").distinct()
    reach = F.coalesce(F.max("_last").over(before), F.lit(-1))
    fresh = F.greatest(F.lit(0), F.col("_last") - F.greatest(F.col("_first") - 1, reach))
    covered = spans.withColumn("_fresh", fresh).groupBy(*DOC).agg(F.sum("_fresh").cast("long").alias("n_hit"))
    named = matches.select(*DOC, "_item").distinct().join(names, "_item")
    listed = named.groupBy(*DOC).agg(F.array_sort(F.collect_set("_name")).alias("_items"))
    return covered.join(listed, DOC)


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, near_items for every row of ``docs``.

    Words are runs of digits, letters and characters beyond ASCII, A-Z as a-z. A window is
    ``window`` consecutive words of an item, or all of a shorter one; items without words match
    nothing. A word is hit inside any occurrence of a window. NULL text has no words. Items of
    one item_id are one item; a NULL item_id is not listed, though its words are hit. ``near_items``
    counts the items with a proximity match (see ``near_matches``), those that occur among them; it
    has no part in ``contaminated``. Repeated rows come back as often.
    """
    items, index = indexed(docs, benchmark)
    names = benchmark.select(text_hash().alias("_item"), F.col("item_id").cast("string").alias("_name")).distinct()
    # A window that occurs is also near, so the words met for one search serve both.
    met = saved(met_words(items, index, window, SLOP), "met-words")
    exact = hits(saved(phrases(met, window), "matches"), names)
    named = passages(met, window).select(*DOC, "_item").distinct().join(names, "_item")
    near = named.groupBy(*DOC).agg(F.count_distinct("_name").alias("near_items"))
    found = saved(near.join(exact, DOC, "left"), "hits")
    rows = docs.select("doc_id", *document_key(), word_count().alias("n_words"))
    listed = F.coalesce("_items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return rows.join(found, DOC, "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"), F.coalesce("near_items", F.lit(0).cast("long")).alias("near_items"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in which no window of the benchmark occurs."""
    items, index = indexed(docs, benchmark)
    found = saved(exact_matches(items, index, window).select(*DOC).distinct(), "contaminated")
    own_id, own_text = document_key()
    same = (own_id == found["_id"]) & (own_text == found["_text"])
    return docs.join(found, same, "left_anti")


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of the benchmark occurs in all documents."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS n,
    array_to_string(words[s : s + least(len(words), 10) - 1], ' ') AS phrase
  FROM (SELECT item_id, words, unnest(range(1, greatest(1, len(words) - 9) + 1)) AS s FROM items WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT doc_id, n, s, array_to_string(words[s : s + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS s FROM docs, sizes)),
found AS (SELECT doc_id, item_id, n, s FROM grams JOIN windows USING (n, phrase)),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT doc_id, n, s FROM found)) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id),
places AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS place FROM docs),
freq AS (SELECT word, count(*) AS f FROM places GROUP BY word),
texts AS (SELECT row_number() OVER () AS i, item_id, words, len(words) AS n FROM items WHERE len(words) > 0),
asked AS (SELECT i, n, unnest(words) AS word, unnest(range(n)) AS o FROM texts),
spread AS (
  SELECT i, n, s, o, word, f
  FROM (SELECT i, n, word, o, unnest(range(greatest(1, n - 9))) AS s FROM asked) LEFT JOIN freq USING (word)
  WHERE o BETWEEN s AND s + 9),
ranked AS (
  SELECT i, n, o, word, row_number() OVER own AS rank, coalesce(lead(o) OVER own, o) AS o2,
    coalesce(lead(word) OVER own, word) AS word2, bool_and(f IS NOT NULL) OVER (PARTITION BY i, s) AS known
  FROM spread WINDOW own AS (PARTITION BY i, s ORDER BY f, word, o)),
anchors AS (SELECT DISTINCT i, n, o, word, o2, word2 FROM ranked WHERE rank = 1 AND known),
starts AS (
  SELECT DISTINCT doc_id, i, n, place - o AS b FROM anchors JOIN places USING (word) JOIN docs USING (doc_id)
  WHERE place - o + o2 + 4 >= 1
    AND list_contains(words[greatest(1, place - o + o2 - 2) : place - o + o2 + 4], word2)),
met AS (
  SELECT doc_id, i, n, b, o FROM starts JOIN asked USING (i, n) JOIN docs USING (doc_id)
  WHERE b + o + 4 >= 1 AND list_contains(words[greatest(1, b + o - 2) : b + o + 4], word)),
runs AS (
  SELECT DISTINCT doc_id, i
  FROM (SELECT *, o - row_number() OVER (PARTITION BY doc_id, i, b ORDER BY o) AS run FROM met)
  GROUP BY doc_id, i, n, b, run HAVING count(*) >= least(n, 10)),
near AS (SELECT doc_id, count(DISTINCT item_id) AS near_items FROM runs JOIN texts USING (i) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated, coalesce(near_items, 0) AS near_items
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id) LEFT JOIN near USING (doc_id)
"""
