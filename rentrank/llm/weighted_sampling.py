"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

Each term k of weight w draws, from hashes of the term alone, r and c ~ Gamma(2, 1) and
beta ~ U(0, 1); with t = floor(ln w / r + beta) its sample is ln a = ln c - r * (t - beta + 1).
A document's sample is the least ln a of its terms. The least value is the same in two documents
exactly if the same (term, t) won it, whose chance is the generalised Jaccard similarity
sum(min(w, w')) / sum(max(w, w')) of their weights. So the value itself is the sample, and one
``min`` per sample and document is all that has to be aggregated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from rentrank.llm import order
from rentrank.llm.store import partitions, saved, table, text_hash

#: Samples of a fingerprint; the likeness has a standard error of at most 1 / (2 * sqrt(SAMPLES)).
SAMPLES = 48
SPACE = "[\\x09-\\x0D\\x20]+"
_UNIT = float(1 << 32)


def _uniform(bits: Column) -> Column:
    """A number in (0, 1) of the low 32 bits."""
    return (bits.bitwiseAND(F.lit(0xFFFFFFFF)) + 0.5) / _UNIT


def sample(term: Column, log_weight: Column, i: int) -> Column:
    """ln a of sample ``i`` for a term (a long hash) of the given weight's logarithm."""
    one, two, three = (F.xxhash64(term, F.lit(3 * i + j)) for j in range(3))
    r = -F.log(_uniform(one) * _uniform(F.shiftrightunsigned(one, 32)))
    c = -F.log(_uniform(two) * _uniform(F.shiftrightunsigned(two, 32)))
    beta = _uniform(three)
    return F.log(c) - r * (F.floor(log_weight / r + beta) - beta + 1)


def weighed_terms(texts: DataFrame, key: list[str], text: str) -> DataFrame:
    """``key``, _term, _weight: a text's distinct words (64-bit hashes) and ln of their counts.

    Words are sorted and their runs measured within the row, so nothing is held beyond one text.
    A text without words has one row of NULLs.
    """
    words = F.array_remove(F.split(F.col(text), SPACE), "")
    hashed = texts.select(*key, F.sort_array(F.transform(words, lambda w: F.xxhash64(w))).alias("_all"))

    def end_of_run(x: Column, i: Column) -> Column:
        after = F.get("_all", i + 1)
        return F.when(after.isNull() | (after != x), i)

    ends = hashed.select(*key, "_all", F.array_compact(F.transform("_all", end_of_run)).alias("_ends"))

    def run(end: Column, j: Column) -> Column:
        before = F.coalesce(F.get("_ends", j - 1), F.lit(-1))
        return F.struct(F.get("_all", end).alias("_term"), (end - before).alias("_count"))

    runs = ends.select(*key, F.inline_outer(F.transform("_ends", run)))
    return runs.select(*key, "_term", F.log(F.col("_count").cast("double")).alias("_weight"))


def samples(texts: DataFrame, key: list[str], text: str, count: int = SAMPLES) -> DataFrame:
    """``key`` and an array ``samples`` for each key; weights are term counts.

    Without terms the array is NULL. Of a sample 32 bits of its hash are kept. If ``texts`` is
    hash-partitioned by some of the ``key`` columns, nothing is shuffled.
    """
    least = [F.min(sample(F.col("_term"), F.col("_weight"), i)).alias(f"_s{i}") for i in range(count)]
    drawn = weighed_terms(texts, key, text).groupBy(*key).agg(*least)
    kept = F.array(*[F.hash(f"_s{i}") for i in range(count)])
    return drawn.select(*key, F.when(F.col("_s0").isNotNull(), kept).alias("samples"))


def likeness(a: Column, b: Column) -> Column:
    """The share of equal samples; 1 for two texts without terms, 0 if just one has none."""
    same = F.aggregate(
        F.zip_with(a, b, lambda x, y: F.when(x == y, 1.0).otherwise(0.0)),
        F.lit(0.0),
        lambda total, x: total + x,
    )
    return (
        F.when(a.isNull() & b.isNull(), F.lit(1.0))
        .when(a.isNull() | b.isNull(), F.lit(0.0))
        .otherwise(same / F.size(a))
    )


def printed(values: Column) -> Column:
    """A fingerprint as hex, 8 digits per sample. A text without terms gives ''."""
    digits = F.transform(values, lambda x: F.lower(F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")))
    return F.coalesce(F.array_join(digits, ""), F.lit(""))


def _with_next(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` in buckets of descending order, each with the text that follows.

    Adds to every bucket, as a guest, the row that the next bucket begins with (after the last
    bucket, the first), so that what follows a row is always at hand. Columns: _bucket, _place
    (1.. within the bucket), _guest, doc_id, _text, _next.
    """
    n = partitions(docs.sparkSession)
    limits = order.bounds(docs, "doc_id", n)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("_text"), text_hash().alias("_hash"))
    rows = rows.withColumn("_bucket", order.bucket(F.col("doc_id"), F.col("_hash"), limits, n))
    # The first row of each bucket: its largest (doc_id, hash); a table of one row per bucket.
    tops = rows.groupBy("_bucket").agg(F.max(F.struct("doc_id", "_hash")).alias("top"))
    # NULL ids come last: their buckets follow all others, whatever their number.
    ranked = tops.withColumn("_last", F.col("top.doc_id").isNull())
    chain = Window.orderBy("_last", F.desc("_bucket"))
    whole = chain.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    to = F.coalesce(F.lag("_bucket").over(chain), F.last("_bucket").over(whole))
    guests = saved(ranked.select("_bucket", "top", to.alias("_to")), "tops")
    heads = rows.join(
        guests.select(F.col("_bucket").alias("_from"), "top", "_to"),
        (F.col("_bucket") == F.col("_from")) & (F.col("_hash") == F.col("top._hash")) & F.col("doc_id").eqNullSafe(F.col("top.doc_id")),
    ).dropDuplicates(["_bucket"])
    both = rows.withColumn("_guest", F.lit(False)).unionByName(
        heads.select("doc_id", "_text", "_hash", F.col("_to").alias("_bucket"), F.lit(True).alias("_guest"))
    )
    within = Window.partitionBy("_bucket").orderBy("_guest", F.desc_nulls_last("doc_id"), F.desc("_hash"))
    dealt = both.repartitionById(n, "_bucket")  # a bucket to a task, not by the hash of its number
    return dealt.select(
        "_bucket", "_guest", "doc_id", "_text",
        F.row_number().over(within).alias("_place"),
        F.lead("_text").over(within).alias("_next"),
    )


def fingerprinted(docs: DataFrame, count: int = SAMPLES) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text replaces the last third (rounded down) of a text's code points by the first
    as many of the next document's, in descending order of (doc_id, text hash), NULL ids last;
    after the last comes the first (a lone document follows itself). NULL text counts as empty.
    A text without words has the fingerprint '', like only to another such. Repeated rows come
    back as often. Texts are shuffled once, into ranges of doc_id; terms and samples stay there.
    """
    rows = _with_next(docs)
    third = F.floor(F.length("_text") / 3).cast("int")
    edited = F.concat(
        F.col("_text").substr(F.lit(1), F.length("_text") - third),
        F.col("_next").substr(F.lit(1), third),
    )
    whole = rows.select(
        "_bucket", "_place", "_guest", "doc_id", "_text", F.length("_text").cast("long").alias("n_chars"),
        F.when(~F.col("_guest"), edited).alias("_edited"),
    )
    # A row's facts go with both of its texts as parts of the key, so that no join brings them back.
    facts = ["doc_id", "n_chars", "edited_sha256"]
    digest = F.sha2(F.col("_edited").cast("binary"), 256)
    none = F.lit(None).cast("string")
    sides = F.array(
        F.struct(F.lit(0).alias("_side"), none.alias("edited_sha256"), F.col("_text").alias("_words")),
        F.struct(F.lit(1).alias("_side"), digest.alias("edited_sha256"), F.col("_edited").alias("_words")),
    )
    key = ["_bucket", "_place"]
    texts = whole.select(*key, "_guest", "doc_id", "n_chars", F.inline(sides))
    drawn = samples(texts, [*key, "_guest", "_side", *facts], "_words", count)
    by_row = drawn.groupBy(*key, "_guest", "doc_id", "n_chars").agg(
        F.max("edited_sha256").alias("edited_sha256"),
        F.max(F.when(F.col("_side") == 0, F.col("samples"))).alias("_own"),
        F.max(F.when(F.col("_side") == 1, F.col("samples"))).alias("_new"),
    )
    after = F.lead("_own").over(Window.partitionBy("_bucket").orderBy("_place"))
    return by_row.withColumn("_after", after).filter(~F.col("_guest")).select(
        *facts,
        printed(F.col("_own")).alias("fingerprint"),
        printed(F.col("_new")).alias("edited_fingerprint"),
        likeness(F.col("_own"), F.col("_new")).alias("near_edited"),
        likeness(F.col("_own"), F.col("_after")).alias("near_next"),
    )


def op8_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprinted(table(spark, sf_dir, "documents"))
