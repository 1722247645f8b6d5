"""Repeated byte strings, found by a logarithmic family of suffix arrays.

Equal texts are one text first. The rest is dealt into batches; each gets a suffix array, is scanned
against the levels before it (``suffix_index``) and joins them. A string of ``MATCH`` bytes that
occurs twice has the same anchors in both places, so the suffix at its first anchor was found to
share its symbols up to the last one. What the scans found says where such strings may start:

* where a suffix shares more than the matches up to the next anchor need, they all are repeated;
* elsewhere, strings with the same first and last anchor are compared. Ranges of starts with wholly
  equal bytes are counted as one; what is left are the ends of long matches, and of these the bytes
  left and right of the shared middle are brought together and compared start by start.

Strings are known by 64-bit hashes, texts by one too (two texts with one hash are an error).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rentrank.llm.buffers import Hasher, mixed, utf8
from rentrank.llm.store import bucketed, partitions, saved, table, text_hash
from rentrank.llm.suffix_index import GRAM, MATCH, WHOLE, Family, parsed, suffixes

BATCHES = 3
#: A middle with more different surroundings than this is compared start by start across tasks.
CROWD = 2_000
#: Rows of surroundings that a task compares together.
TOGETHER = 20_000

RANGE = "id long, p int, n int, whole boolean, key long, body long, left int, middle int"


def distinct_texts(docs: DataFrame) -> DataFrame:
    """id, copies, n_bytes, sha, text of every different text, in buckets by id."""
    read = docs.select(text_hash().alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    sha = F.sha2(F.col("text").cast("binary"), 256)
    once = read.groupBy("id").agg(
        F.count(F.lit(1)).alias("copies"), F.first("text").alias("text"), F.min(sha).alias("sha"), F.max(sha).alias("_other")
    )
    differ = F.raise_error(F.lit("two texts have one hash")).cast("string")
    one = F.when(F.col("sha") == F.col("_other"), F.col("sha")).otherwise(differ)
    found = once.select("id", "copies", F.octet_length("text").cast("long").alias("n_bytes"), one.alias("sha"), "text")
    return bucketed(found, "texts", "id", compression="zstd")


def _long(texts: DataFrame) -> DataFrame:
    return texts.filter(F.col("n_bytes") >= MATCH).select("id", "text")


def _values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, row of each) of a list column."""
    row = np.repeat(np.arange(len(column)), column.value_lengths().to_numpy(zero_copy_only=False))
    return column.flatten().to_numpy(zero_copy_only=False), row


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of places where a match may start, and those where one surely does (key NULL)."""
    names = [f.split()[0] for f in RANGE.split(", ")]
    for batch in batches:
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        pos, row = _values(batch.column("pos"))
        m, _ = _values(batch.column("m"))
        for anchors, data, starts, lo, hi, i, j in parsed(batch):
            if not len(anchors.at):
                continue
            most = np.zeros(len(anchors.at), np.int8)
            here = (row >= i) & (row < j)
            place = pos[here] + starts[row[here] - i]
            at = np.minimum(np.searchsorted(anchors.at, place), len(anchors.at) - 1)
            hit = anchors.at[at] == place
            np.maximum.at(most, at[hit], m[here][hit])
            # Starts from an anchor to the next one, where all their matches are shared.
            sure = np.zeros(len(data) + 1, np.int64)
            full = (most >= WHOLE) & (anchors.beyond >= 0)
            np.add.at(sure, anchors.at[full], 1)
            np.add.at(sure, anchors.at[anchors.next[full]] + 1, -1)
            sure = np.cumsum(sure)[:-1] > 0
            first, last, f, end = anchors.rows()
            a = np.searchsorted(anchors.at, f)
            need = 1 + sum(((to >= 0) & (anchors.at[np.maximum(to, 0)] <= end)).astype(np.int8) for to in (s[a] for s in anchors.steps))
            own = (first >= lo) & (first < hi)
            use = own & (most[a] >= need)
            first, last, f, end = first[use], last[use], f[use], end[use]
            told = np.r_[0, np.cumsum(sure)]
            whole = told[last + 1] - told[first] == last + 1 - first
            key = anchors.hasher.of(f, end + GRAM).view(np.int64)
            body = anchors.hasher.of(first, last + MATCH).view(np.int64)
            text = np.searchsorted(anchors.edges, first, "right") - 1
            columns = [ids[i + text], first - starts[text], last + 1 - first, whole, key, body, f - first, end + GRAM - f]
            sure[:lo], sure[hi:] = False, False
            known = _runs(sure)
            text = np.searchsorted(anchors.edges, known[0], "right") - 1
            kinds = [np.int64, np.int32, np.int32, bool, np.int64, np.int64, np.int32, np.int32]
            arrays = [pa.array(c.astype(k)) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names)
            plain = [ids[i + text], (known[0] - starts[text]).astype(np.int32), (known[1] - known[0]).astype(np.int32)]
            rest = [pa.nulls(len(text), a.type) for a in arrays[3:]]
            yield pa.RecordBatch.from_arrays([*map(pa.array, plain), *rest], names)


def _runs(flags: np.ndarray) -> np.ndarray:
    """(starts, ends) of the runs of True."""
    edge = np.diff(np.r_[0, flags.astype(np.int8), 0])
    return np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)])


def possible_ranges(texts: DataFrame, found: DataFrame) -> DataFrame:
    """The ranges (see RANGE) of all texts with a find; written."""
    lists = found.groupBy("id").agg(F.collect_list(F.struct("pos", "m")).alias("_at"))
    lists = lists.select("id", F.col("_at.pos").alias("pos"), F.col("_at.m").alias("m"))
    return saved(_long(texts).join(lists, "id").mapInArrow(_ranges, RANGE), "ranges")


def _surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes left and right of the middle of each range."""
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        ranges = batch.column("ranges")
        value, row = ranges.flatten(), np.repeat(np.arange(len(ranges)), ranges.value_lengths().to_numpy(zero_copy_only=False))
        v = {name: value.field(name).to_numpy(zero_copy_only=False) for name in ("p", "n", "left", "middle", "key", "crowd", "alone")}
        start = offsets[row] + v["p"]
        around = [
            data[s : s + a].tobytes() + data[s + a + b : s + n - 1 + MATCH].tobytes()
            for s, a, b, n in zip(start.tolist(), v["left"].tolist(), v["middle"].tolist(), v["n"].tolist())
        ]
        columns = [v["key"], ids[row], *[v[c] for c in ("p", "n", "left", "middle", "crowd", "alone")]]
        names = ["key", "id", "p", "n", "left", "middle", "crowd", "alone", "around"]
        yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(around, pa.binary())], names)


def _starts(rows: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, start in the range) of every match's surroundings, with the middle's key and place."""
    around = rows.column("around")
    around = around.combine_chunks() if isinstance(around, pa.ChunkedArray) else around
    data, offsets = utf8(around)
    col = lambda c: rows.column(c).to_numpy()
    n = col("n").astype(np.int64)
    row = np.repeat(np.arange(len(n)), n)
    j = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    start = offsets[row] + j
    h = Hasher(data).of(start, start + MATCH - col("middle")[row])
    place = (col("left")[row] - j).astype(np.int64).view(np.uint64)
    return mixed(h + mixed(place + np.uint64(1)) + mixed(col("key").view(np.uint64))[row]), row, j


def _same_starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, p, n: runs of starts that another row of the same key has as well. Rows come sorted by key."""
    kept: list[pa.RecordBatch] = []

    def found(rows: pa.Table) -> pa.RecordBatch:
        h, row, j = _starts(rows)
        _, inverse, count = np.unique(h, return_inverse=True, return_counts=True)
        again = (count[inverse] > 1) & rows.column("alone").to_numpy()[row]
        # A run ends with its row as well: one place between rows keeps them apart.
        spread = np.zeros(len(h) + rows.num_rows + 1, bool)
        spread[np.arange(len(h)) + row] = again
        first, end = _runs(spread)
        owner = np.searchsorted(np.arange(rows.num_rows) + np.cumsum(rows.column("n").to_numpy()), first, "right")
        begin = first - np.arange(rows.num_rows)[owner] - (np.cumsum(rows.column("n").to_numpy()) - rows.column("n").to_numpy())[owner]
        ids, p = rows.column("id").to_numpy()[owner], rows.column("p").to_numpy()[owner] + begin
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(p.astype(np.int32)), pa.array((end - first).astype(np.int32))], ["id", "p", "n"])

    held = 0
    for batch in batches:
        if not len(batch):
            continue
        kept.append(batch)
        held += len(batch)
        if held < TOGETHER:
            continue
        rows = pa.Table.from_batches(kept)
        key = rows.column("key").to_numpy()
        cut = int(np.flatnonzero(key != key[-1])[-1]) + 1 if key[0] != key[-1] else 0
        if cut:
            yield found(rows.slice(0, cut))
            kept = rows.slice(cut).to_batches()
            held = rows.num_rows - cut
    if held:
        yield found(pa.Table.from_batches(kept))


def _each_start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        h, row, j = _starts(batch)
        columns = [h.view(np.int64), batch.column("id").to_numpy()[row], (batch.column("p").to_numpy()[row] + j).astype(np.int32), batch.column("alone").to_numpy(zero_copy_only=False)[row]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["h", "id", "p", "alone"])


def _sure(column: str) -> Column:
    return F.coalesce(column, F.lit(True))


def repeated_starts(texts: DataFrame, ranges: DataFrame) -> DataFrame:
    """id, p, n: the places p to p + n - 1 of a text start strings that also start elsewhere."""
    n = partitions(texts.sparkSession)
    sure = ranges.filter(_sure("whole")).select("id", "p", "n")
    some = ranges.filter(F.col("key").isNotNull())
    one = F.struct("id", "p", "n", "left", "middle")
    bodies = saved(
        some.groupBy("key", "body").agg(F.count(F.lit(1)).alias("c"), F.min("whole").alias("whole"), F.min(one).alias("one")), "bodies"
    )
    open_ = ~F.col("whole") & (F.col("c") == 1)
    crowds = bodies.groupBy("key").agg(F.count(F.lit(1)).alias("crowd"), F.max(open_).alias("_open"))
    crowds = saved(crowds.filter("crowd > 1 AND _open").select("key", "crowd"), "crowds")
    # Ranges that occur twice byte by byte, where the scans did not tell.
    twice = bodies.filter((F.col("c") > 1) & ~F.col("whole")).select("key", "body")
    equal = some.filter(~F.col("whole")).join(saved(twice, "twice"), ["key", "body"], "left_semi").select("id", "p", "n")
    asked = bodies.join(crowds, "key").select("one.*", "key", "crowd", open_.alias("alone"))
    lists = asked.groupBy("id").agg(F.collect_list(F.struct("p", "n", "left", "middle", "key", "crowd", "alone")).alias("ranges"))
    kinds = "key long, id long, p int, n int, left int, middle int, crowd long, alone boolean, around binary"
    around = saved(_long(texts).join(lists, "id").mapInArrow(_surroundings, kinds), "surroundings")
    few = around.filter(F.col("crowd") <= CROWD).repartition(n, "key").sortWithinPartitions("key")
    single = saved(around.filter(F.col("crowd") > CROWD).mapInArrow(_each_start, "h long, id long, p int, alone boolean"), "starts")
    again = single.groupBy("h").count().filter("count > 1").select("h")
    crowded = single.filter("alone").join(saved(again, "again"), "h", "left_semi").select("id", "p", F.lit(1).alias("n"))
    parts = [sure, equal, few.mapInArrow(_same_starts, "id long, p int, n int"), crowded]
    return reduce(DataFrame.unionByName, parts)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text: the bytes that matches cover, and what is left."""
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        p, row = _values(batch.column("p"))
        n, _ = _values(batch.column("n"))
        bounds = np.searchsorted(row, np.arange(len(batch) + 1))
        out = []
        for i in range(len(batch)):
            text = data[offsets[i] : offsets[i + 1]]
            part = slice(bounds[i], bounds[i + 1])
            cover = np.zeros(len(text) + 1, np.int32)
            np.add.at(cover, p[part], 1)
            np.add.at(cover, p[part].astype(np.int64) + n[part] - 1 + MATCH, -1)
            gone = np.cumsum(cover)[:-1] > 0
            first, end = _runs(gone)
            out.append((int(gone.sum()), first.tolist(), end.tolist(), hashlib.sha256(text[~gone].tobytes()).hexdigest()))
        removed, first, end, sha = zip(*out) if out else ([], [], [], [])
        spans = [pa.array(x, pa.list_(pa.int32())) for x in (first, end)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(removed, pa.int64()), *spans, pa.array(sha, pa.string())], ["id", "n_removed", "starts", "ends", "kept"]
        )


def repeated_spans(texts: DataFrame, batches: int = BATCHES) -> DataFrame:
    """id, n_removed, starts, ends, kept of every text of ``texts`` with a repeated string.

    ``texts`` as from ``distinct_texts``. The spans [start, end) are bytes, apart and ascending;
    ``kept`` is the SHA-256 of the other bytes.
    """
    family = Family(texts.sparkSession)
    for batch in range(batches):
        share = F.pmod(F.shiftright("id", 7), F.lit(batches)) == batch
        family.add(suffixes(_long(texts).filter(share)))
    ranges = possible_ranges(texts, family.found())
    lists = repeated_starts(texts, ranges).groupBy("id").agg(F.collect_list(F.struct("p", "n")).alias("_at"))
    lists = lists.select("id", F.col("_at.p").alias("p"), F.col("_at.n").alias("n"))
    kinds = "id long, n_removed long, starts array<int>, ends array<int>, kept string"
    return _long(texts).join(lists, "id").mapInArrow(_cut, kinds)


def deduplicated(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, starts, ends for every row of ``docs``.

    Texts are UTF-8 bytes, NULL an empty one. Every byte goes that lies in a string of ``MATCH``
    bytes which also starts anywhere else, in this text or another; a text that occurs more than
    once goes wholly if it is that long, in all rows. Shorter texts stay. Repeated rows and rows
    without doc_id are rows like others. An empty table has no rows.
    """
    texts = distinct_texts(docs)
    alone = texts.filter("copies = 1").select("id", "n_bytes", F.col("sha").alias("_sha"))
    more = texts.filter("copies > 1").select("id", "n_bytes", F.col("sha").alias("_sha"))
    spans = repeated_spans(texts, batches)
    cut = alone.join(spans, "id", "left").select(
        "id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("starts", F.array().cast("array<int>")).alias("starts"), F.coalesce("ends", F.array().cast("array<int>")).alias("ends"),
        F.coalesce("kept", "_sha").alias("kept_sha256"),
    )
    gone = F.col("n_bytes") >= MATCH
    ends = lambda x: F.when(gone, F.array(x.cast("int"))).otherwise(F.array().cast("array<int>"))
    whole = more.select(
        "id", "n_bytes", F.when(gone, F.col("n_bytes")).otherwise(F.lit(0)).alias("n_removed"),
        ends(F.lit(0)).alias("starts"), ends(F.col("n_bytes")).alias("ends"),
        F.when(gone, F.sha2(F.lit(b""), 256)).otherwise(F.col("_sha")).alias("kept_sha256"),
    )
    per_text = saved(cut.unionByName(whole), "cut-texts")
    rows = saved(docs.select("doc_id", text_hash().alias("id")), "rows")
    return rows.join(per_text, "id").select(
        "doc_id", "n_bytes", "n_removed", F.size("starts").cast("long").alias("n_spans"), "kept_sha256", "starts", "ends"
    )


def op12_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents less the bytes of strings of 400 that occur more than once."""
    return deduplicated(table(spark, sf_dir, "documents")).drop("starts", "ends")
