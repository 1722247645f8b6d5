"""Phrase collocations, by marginalising the counts of the longest windows.

Every word begins one window: itself and the words that follow it in its piece, ``LONGEST`` in all,
padded at the piece's end. Only these windows are counted. A phrase of k words begins where a
window does, so its count is the sum over all windows that begin with it: one ROLLUP over the
window's columns gives the counts of all shorter phrases, and of all words.

A phrase is no more frequent than the pairs of words in it, so a window may be cut before a pair
that is too rare. Such pairs are told by counts in ``2 ** CELL_BITS`` cells that pairs hash to: a
cell below the least count holds only rare pairs. Cells only spare work: where many pairs share a
cell, windows stay longer and the counts are the same. Words are known by 64-bit hashes; two words
with one hash are an error, never a wrong count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from rentrank.llm.buffers import Hasher, mixed, stretches, utf8
from rentrank.llm.store import partitions, saved, table
from rentrank.llm.text import UPPER

LONGEST = 4
LEAST = 30
TOP = 2000
SCALE = 2_000_000
#: Per cent of a phrase's count that a longer one must have to stand for it.
COVERED = 80
NO_LANG = "und"
#: The cells are a bit each when they are sent to the tasks: 32 MB, whatever the corpus.
CELL_BITS = 28
#: Bytes of text that a task reads at once.
STRETCH = 1 << 20

W = [f"w{i}" for i in range(LONGEST)]

# What ends a piece, and what lies between the words of one.
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
BLANKS = b" \x09"

_CLASS = np.zeros(256, np.uint8)
_CLASS[list(BLANKS)] = 1
_CLASS[list(BREAKS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[list(UPPER.encode())] += 32


class _Words:
    """The words of a stretch of bytes: hash, row, and whether the next one is in the same piece."""

    def __init__(self, data: np.ndarray, start: int, end: int, offsets: np.ndarray):
        self.data = _LOWER[data[start:end]]
        kind = _CLASS[self.data]
        edges = offsets[(offsets >= start) & (offsets < end)] - start
        inside = kind == 0
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        first[edges] |= inside[edges]
        before = edges[edges > 0] - 1
        last[before] |= inside[before]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.hash = Hasher(self.data).of(self.start, self.end)
        self.hash[self.hash == 0] = 1  # 0 is the pad
        self.row = np.searchsorted(offsets, self.start + start, "right") - 1
        piece = np.cumsum(kind == 2)[self.start] if len(self.data) else self.start
        self.follows = np.zeros(len(self.start), bool)
        self.follows[:-1] = (piece[1:] == piece[:-1]) & (self.row[1:] == self.row[:-1])

    def cells(self, lang: np.ndarray) -> np.ndarray:
        """The cell of each word's pair with the next one."""
        following = np.r_[self.hash[1:], np.zeros(min(1, len(self.hash)), np.uint64)]
        pair = mixed(self.hash + lang) * np.uint64(3) + following
        return mixed(pair) >> np.uint64(64 - CELL_BITS)

    def text(self, i: int) -> str:
        return self.data[self.start[i] : self.end[i]].tobytes().decode()


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[_Words, np.ndarray, np.ndarray, list]]:
    """(words, code of the language and its hash per word, names of the codes) of a batch's stretches."""
    langs = batch.column("lang").dictionary_encode()
    names = langs.dictionary.to_pylist()
    codes = langs.indices.to_numpy(zero_copy_only=False)
    salt = np.array([int.from_bytes(name.encode()[:8].ljust(8, b"\0"), "little") for name in names], np.uint64)
    salt = mixed(salt + np.uint64(1))
    data, offsets = utf8(batch.column("text"))
    breaks = np.flatnonzero(_CLASS[data] == 2)
    for start, end in stretches(offsets, STRETCH, breaks):
        words = _Words(data, start, end, offsets)
        lang = codes[words.row]
        yield words, lang, salt[lang] if len(names) else salt, names


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), "text").filter(F.length("text") > 0)


def _pair_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for words, _, salt, _ in _stretches(batch):
            cell, count = np.unique(words.cells(salt)[words.follows], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cell.view(np.int64)), pa.array(count)], ["cell", "c"])


def full_cells(docs: DataFrame, least: int = LEAST) -> np.ndarray:
    """A bit for each cell, 64 to a number: does it hold ``least`` pairs of words or more?"""
    counted = _texts(docs).mapInArrow(_pair_cells, "cell long, c long").groupBy("cell").agg(F.sum("c").alias("c"))
    bit = F.expr("shiftleft(1L, CAST(cell % 64 AS INT))")
    packed = counted.filter(F.col("c") >= least).groupBy(F.expr("cell DIV 64").alias("at")).agg(F.bit_or(bit).alias("bits"))
    found = packed.toArrow()  # at most 2 ** CELL_BITS / 64 rows of 16 bytes
    bits = np.zeros((1 << CELL_BITS) // 64, np.int64)
    bits[found.column("at").to_numpy()] = found.column("bits").to_numpy()
    return bits.view(np.uint64)


def _has(bits: np.ndarray, cell: np.ndarray) -> np.ndarray:
    return (bits[cell >> np.uint64(6)] >> (cell & np.uint64(63))) & np.uint64(1) == 1


def _counter(cells):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The windows of each stretch, counted."""
        bits = cells.value
        for batch in batches:
            for words, lang, salt, names in _stretches(batch):
                n = len(words.hash)
                goes_on = words.follows & _has(bits, words.cells(salt))
                columns, reach = [pa.array(lang), pa.array(words.hash.view(np.int64))], np.ones(n, bool)
                for k in range(1, LONGEST):
                    lead, link = np.zeros(n, np.uint64), np.zeros(n, bool)
                    lead[: max(n - k, 0)] = words.hash[k:]
                    link[: max(n - k + 1, 0)] = goes_on[k - 1 :]
                    reach = reach & link
                    columns.append(pa.array(np.where(reach, lead, np.uint64(0)).view(np.int64)))
                windows = pa.table(columns, names=["lang", *W])
                counted = windows.group_by(["lang", *W], use_threads=False).aggregate([([], "count_all")])
                name = pa.array(names, pa.string()).take(counted.column("lang").combine_chunks())
                arrays = [name, *[counted.column(w).combine_chunks() for w in W], counted.column("count_all").combine_chunks()]
                yield pa.RecordBatch.from_arrays(arrays, ["lang", *W, "c"])

    return run


def _speller(cells):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """hash and word, once a stretch, of the words in pairs of full cells."""
        bits = cells.value
        for batch in batches:
            for words, _, salt, _ in _stretches(batch):
                pairs = words.follows & _has(bits, words.cells(salt))
                pairs[1:] |= pairs[:-1].copy()
                at = np.flatnonzero(pairs)
                h, first = np.unique(words.hash[at], return_index=True)
                spelt = pa.array([words.text(i) for i in at[first]], pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), spelt], ["h", "word"])

    return run


def padded_windows(docs: DataFrame, cells, least: int = LEAST) -> DataFrame:
    """lang, w0 to w3 (hashes, 0: padded), c; written. Tails that make no phrase of ``least`` are padded.

    The windows are dealt out by their first three words, so that the counts of a window and of
    those three words need one shuffle.
    """
    n = partitions(docs.sparkSession)
    kinds = ", ".join(f"{w} long" for w in W)
    counted = _texts(docs).mapInArrow(_counter(cells), f"lang string, {kinds}, c long")
    dealt = counted.repartition(n, "lang", *W[:-1])
    full = dealt.groupBy("lang", *W).agg(F.sum("c").alias("c"))
    last = F.when(F.col("c") >= least, F.col(W[-1])).otherwise(F.lit(0).cast("long"))
    full = full.withColumn(W[-1], last).groupBy("lang", *W).agg(F.sum("c").alias("c"))
    head = F.sum("c").over(Window.partitionBy("lang", *W[:-1]))
    short = full.withColumn("_head", head).withColumn(W[-2], F.when(F.col("_head") >= least, F.col(W[-2])).otherwise(F.lit(0).cast("long")))
    return saved(short.groupBy("lang", *W).agg(F.sum("c").alias("c")), "windows")


def phrases(windows: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """((lang, k, w0 to w3, f): phrases of k words that occur ``least`` times; (lang, n): all words)."""
    rolled = windows.rollup("lang", *W).agg(F.sum("c").alias("f"), F.grouping_id().alias("_level"))
    # Level 0 keeps all words of the window, each further bit drops the last one left.
    k = sum(F.when(F.shiftright("_level", i).bitwiseAND(F.lit(1)) == 0, 1).otherwise(0) for i in range(LONGEST))
    rolled = saved(
        rolled.select("lang", k.cast("int").alias("k"), *[F.coalesce(w, F.lit(0)).alias(w) for w in W], "f", "_level")
        .filter((F.shiftright("_level", LONGEST) == 0) & ((F.col("k") == 0) | (F.col("f") >= least))),
        "rolled",
    )
    whole = F.get(F.array(*W), F.col("k") - 1) != 0
    found = rolled.filter((F.col("k") > 0) & whole).drop("_level")
    return found, rolled.filter("k = 0").select("lang", F.col("f").alias("n"))


def _part(start: int, size: int) -> list[Column]:
    """The words [start, start + size) as the columns of a phrase of their own."""
    inside = [F.col(W[start + i]) if i < size else F.lit(0).cast("long") for i in range(LONGEST)]
    return [c.alias(w) for c, w in zip(inside, W)]


def _parts(candidates: DataFrame, kinds: list[tuple[int, int, int]], name: str) -> DataFrame:
    """One row per candidate of k words and (k, start, size): the part's words as ``name``."""
    rows = [F.struct(F.lit(k).alias("_of"), F.lit(start).alias("start"), F.struct(*_part(start, size)).alias(name)) for k, start, size in kinds]
    return candidates.select("*", F.inline(F.array(*rows))).filter("k = _of").drop("_of")


def _like(frame: DataFrame, prefix: str, column: str) -> DataFrame:
    """Counts to join with a part: ``prefix``lang, the part as a struct, and its count."""
    return frame.select(F.col("lang").alias(f"{prefix}lang"), F.struct(*W).alias(prefix), F.col(column).alias(f"{prefix}f"))


def scored(found: DataFrame) -> DataFrame:
    """lang, k, w0 to w3, a, l, r, score of every phrase of two words or more, by its lowest cut."""
    candidates = found.filter("k > 1").withColumnRenamed("f", "a")
    cuts = []
    for k in range(2, LONGEST + 1):
        for cut in range(1, k):
            left, right = F.struct(*_part(0, cut)).alias("_left"), F.struct(*_part(cut, k - cut)).alias("_right")
            cuts.append(F.struct(F.lit(k).alias("_of"), F.lit(cut).alias("cut"), left, right))
    cut = candidates.select("*", F.inline(F.array(*cuts))).filter("k = _of").drop("_of")
    for side in ("l", "r"):
        part = "_left" if side == "l" else "_right"
        counts = _like(found, side, "f")
        cut = cut.join(counts, (F.col("lang") == F.col(f"{side}lang")) & (F.col(part) == F.col(side))).drop(f"{side}lang", side, part)
    score = F.expr(f"(CAST({SCALE} AS DECIMAL(10,0)) * CAST(a AS DECIMAL(20,0))) DIV (CAST(lf AS DECIMAL(20,0)) + CAST(rf AS DECIMAL(20,0)))")
    lowest = F.min(F.struct(score.alias("score"), "cut", "lf", "rf"))
    best = cut.groupBy("lang", "k", *W, "a").agg(lowest.alias("m"))
    return best.select("lang", "k", *W, "a", F.col("m.lf").alias("l"), F.col("m.rf").alias("r"), F.col("m.score").alias("score"))


def uncovered(candidates: DataFrame) -> DataFrame:
    """``candidates`` less those that a longer one, nearly as frequent, contains."""
    kinds = [(k, s, m) for k in range(3, LONGEST + 1) for m in range(2, k) for s in range(k - m + 1)]
    longer = _parts(candidates.select("lang", "k", *W, "a"), kinds, "part")
    most = longer.groupBy(F.col("lang").alias("_lang"), "part").agg(F.max("a").alias("_most"))
    joined = candidates.join(most, (F.col("lang") == F.col("_lang")) & (F.struct(*W) == F.col("part")), "left")
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    kept = F.col("_most").isNull() | (100 * wide("_most") < COVERED * wide("a"))
    return joined.filter(kept).drop("_lang", "part", "_most")


def spelt(rows: DataFrame, words: DataFrame) -> DataFrame:
    """``rows`` with ``phrase``: their words, by ``words`` (h, word; repetitions allowed)."""
    differ = F.raise_error(F.lit("two words have one hash")).cast("string")
    known = words.groupBy("h").agg(F.min("word").alias("word"), F.max("word").alias("_other"))
    known = known.select("h", F.when(F.col("word") == F.col("_other"), F.col("word")).otherwise(differ).alias("word"))
    each = rows.select("lang", *W, F.posexplode(F.slice(F.array(*W), 1, F.col("k"))).alias("_at", "h"))
    texts = each.join(saved(known, "words"), "h").groupBy("lang", *W).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_at", "word"))), lambda s: s["word"]), " ").alias("phrase")
    )
    return rows.join(texts, ["lang", *W])


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best ``top`` phrases of each language.

    A-Z count as a-z. A NULL or empty text has no words; a NULL lang is ``und``, together with
    texts that say so. Repeated rows count as often as they occur. Phrases with the same score are
    ranked by count, then by their bytes. A table without phrases gives no rows. A piece of a text
    is read as a whole; a text with several is read in stretches, however long it is.
    """
    spark = docs.sparkSession
    cells = spark.sparkContext.broadcast(full_cells(docs, least))
    found, totals = phrases(padded_windows(docs, cells, least), least)
    best = saved(uncovered(scored(found)), "collocations")
    words = _texts(docs).mapInArrow(_speller(cells), "h long, word string")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = spelt(best, words).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of two to four words of each language of all documents."""
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = f"""
WITH pieces AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM pieces),
grams AS (
  SELECT lang, k, unnest([ws[i:i + k - 1] FOR i IN range(1, len(ws) - k + 2)]) AS g
  FROM words, range(1, 5) t(k) WHERE len(ws) >= k
), f AS (SELECT lang, k, g, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, g, f AS a FROM f WHERE k > 1 AND f >= 30),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM cand),
sides AS (
  SELECT c.*, x.f AS l, y.f AS r, ((2000000::HUGEINT * a) // (x.f + y.f))::BIGINT AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.g = c.g[1:cut] JOIN f y ON y.lang = c.lang AND y.g = c.g[cut + 1:c.k]
), best AS (SELECT * FROM sides QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
parts AS (
  SELECT lang, unnest([g[s:s + m - 1] FOR s IN range(1, k - m + 2)]) AS part, a
  FROM cand, range(2, 4) t(m) WHERE m < k
), most AS (SELECT lang, part, max(a) AS most FROM parts GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN most m ON m.lang = b.lang AND m.part = b.g
  WHERE most IS NULL OR 100 * most::HUGEINT < 80 * a::HUGEINT
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank,
  array_to_string(g, ' ') AS phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""
