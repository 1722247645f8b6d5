"""Suffix arrays over sampled suffixes, kept as a logarithmic family of sorted levels.

Suffixes start at anchors. The anchors of a text are the least hashes of ``GRAM``-byte strings in
every run of ``RUN`` of them, so every string of ``MATCH`` bytes holds anchors that its bytes alone
decide: equal strings have the same ones at the same places. A suffix is known by its first string
(64 bits) and by hashes of the stretches from its anchor to later ones, each longer than the one
before. Suffixes sorted by these are a suffix array: what two neighbours have in common is the most
that either has in common with any other.

A new batch is sorted together with the levels that there are; whatever shares more with a
neighbour than was known is a find. The batch and all levels below the first gap become the level
that fills the gap, so levels double in size and a suffix is rewritten a logarithmic number of times.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentrank.llm.buffers import Hasher, utf8
from rentrank.llm.store import partitions, saved

MATCH = 400
GRAM = 32
RUN = 230
SPAN = RUN + GRAM - 1
#: Least distance between the anchors that a suffix is compared at; three lie in a match.
STEP = 100
STEPS = (MATCH - GRAM) // STEP
#: Symbols that a suffix shares with another where they agree beyond the next anchor's match.
WHOLE = STEPS + 2
#: Bytes of text handled at once; parts of a longer text see this much around them.
STRETCH = 1 << 20
BEFORE, AFTER = 2 * SPAN, 4 * MATCH

_PLACE = np.uint64((1 << 24) - 1)
SUFFIX = "g long, rest long, id long, pos int"
ORDER = ["g", "rest", "id", "pos"]


def regions(offsets: np.ndarray) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(from, to, own from, own to, first row, last row + 1) of bytes to handle at once.

    Rows are taken several at a time, a long one in parts that overlap; each byte is one part's own.
    """
    i, rows = 0, len(offsets) - 1
    while i < rows:
        start = int(offsets[i])
        j = int(np.searchsorted(offsets, start + STRETCH, "right")) - 1
        if j > i:
            end = int(offsets[j])
            yield start, end, start, end, i, j
            i = j
            continue
        end = int(offsets[i + 1])
        for s in range(start, end, STRETCH):
            yield max(start, s - BEFORE), min(end, s + STRETCH + AFTER), s, min(s + STRETCH, end), i, i + 1
        i += 1


class Anchors:
    """The anchors of the texts that ``edges`` bound in ``data``, and the suffixes at them."""

    def __init__(self, data: np.ndarray, edges: np.ndarray):
        self.edges, self.hasher, n = edges, Hasher(data), len(data)
        places = np.arange(max(n - GRAM + 1, 0))
        grams = self.hasher.of(places, places + GRAM)
        least = (grams & ~_PLACE) | places.astype(np.uint64)
        span = 1
        while 2 * span <= RUN:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        least = np.minimum(least[: len(least) - (RUN - span)], least[RUN - span :])
        #: The anchor of the run that starts at a place; runs that leave their text say nothing.
        self.of_run = (least & _PLACE).astype(np.int64)
        found = self.of_run[self._inside(SPAN)]
        self.at = found[np.r_[True, found[1:] != found[:-1]]] if len(found) else found
        self.text = np.searchsorted(edges, self.at, "right") - 1
        self.gram = grams[self.at].view(np.int64)
        self.steps, base = [], np.arange(len(self.at))
        for _ in range(STEPS):
            base = self._anchor_from(base, self.at[np.maximum(base, 0)] + STEP)
            self.steps.append(base)
        #: The next anchor's place, or none (-1); and the first anchor beyond all matches from there.
        self.next = self._anchor_from(np.arange(len(self.at)), self.at + 1)
        after = self.at[np.maximum(self.next, 0)] + MATCH - GRAM
        self.beyond = self._anchor_from(self.next, after)

    def _inside(self, length: int) -> np.ndarray:
        """Whether ``length`` bytes from each place lie in one text."""
        change = np.zeros(max(len(self.of_run), int(self.edges[-1])) + 2, np.int64)
        np.add.at(change, self.edges[:-1], 1)
        np.add.at(change, np.maximum(self.edges[1:] - length + 1, self.edges[:-1]), -1)
        return np.cumsum(change)[: len(self.of_run)] > 0

    def _anchor_from(self, of: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The first anchor at or after ``place`` in the text of anchor ``of``; -1 if there is none."""
        if not len(self.at):
            return of
        i = np.minimum(np.searchsorted(self.at, place), len(self.at) - 1)
        good = (of >= 0) & (self.at[i] >= place) & (self.text[i] == self.text[np.maximum(of, 0)])
        return np.where(good, i, -1)

    def rest(self) -> np.ndarray:
        """16 bits for each later stretch of a suffix, 0 where there is none."""
        out = np.zeros(len(self.at), np.uint64)
        for to in [*self.steps, self.beyond]:
            h = self.hasher.of(self.at, np.where(to >= 0, self.at[np.maximum(to, 0)] + GRAM, self.at)) if len(self.at) else out
            out = (out << np.uint64(16)) | np.where(to >= 0, h >> np.uint64(48), np.uint64(0))
        return out.view(np.int64)

    def rows(self) -> tuple[np.ndarray, ...]:
        """(first, last, f, l): ranges of match starts with the same first and last anchor f, l."""
        p = np.flatnonzero(self._inside(MATCH))
        f, last = self.of_run[p], self.of_run[p + MATCH - SPAN]
        new = np.ones(len(p), bool)
        new[1:] = (f[1:] != f[:-1]) | (last[1:] != last[:-1]) | (p[1:] != p[:-1] + 1)
        at = np.flatnonzero(new)
        end = np.r_[at[1:], len(p)][: len(at)] - 1
        return p[at], p[end], f[at], last[at]


def parsed(batch: pa.RecordBatch) -> Iterator[tuple[Anchors, np.ndarray, np.ndarray, int, int, int, int]]:
    """(anchors, data, places of the texts' starts, own from, own to, first row, last row + 1) for each region of a batch's texts."""
    data, offsets = utf8(batch.column("text"))
    for lo, hi, own_lo, own_hi, i, j in regions(offsets):
        edges = np.clip(offsets[i : j + 1], lo, hi) - lo
        yield Anchors(data[lo:hi], edges), data[lo:hi], offsets[i:j] - lo, own_lo - lo, own_hi - lo, i, j


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        for anchors, _, starts, lo, hi, i, _ in parsed(batch):
            own = (anchors.at >= lo) & (anchors.at < hi)
            pos = (anchors.at - starts[anchors.text])[own].astype(np.int32) if len(own) else np.empty(0, np.int32)
            columns = [anchors.gram[own], anchors.rest()[own], ids[i + anchors.text[own]], pos]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ORDER)


def suffixes(texts: DataFrame) -> DataFrame:
    """g, rest, id, pos: the sampled suffixes of ``texts`` (id, text), in no order yet."""
    return texts.select("id", "text").mapInArrow(_suffixes, SUFFIX)


def shared(g: np.ndarray, rest: np.ndarray, g2: np.ndarray, rest2: np.ndarray) -> np.ndarray:
    """How many symbols two suffixes have in common from the start."""
    differ = (rest ^ rest2).view(np.uint64)
    same = np.ones(len(g), np.int8)
    for i in range(1, WHOLE):
        same += (differ >> np.uint64(64 - 16 * i)) == 0
    return np.where(g == g2, same, 0).astype(np.int8)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted suffixes with what each shares with its neighbours; the first and last are marked."""
    part, kept, before = TaskContext.get().partitionId(), None, None

    def out(rows: dict, most: np.ndarray, edge: np.ndarray) -> pa.RecordBatch:
        m = np.maximum(rows["m"], most)
        use = rows["keep"] | (m > rows["m"]) | (edge > 0)
        columns = [*[rows[c] for c in ORDER], m, rows["keep"], m > rows["m"], edge, np.full(len(m), part, np.int32)]
        names = [*ORDER, "m", "keep", "found", "edge", "part"]
        return pa.RecordBatch.from_arrays([pa.array(c[use]) for c in columns], names)

    first = True
    for batch in batches:
        rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names}
        if not len(batch):
            continue
        if kept is not None:
            rows = {c: np.concatenate([kept[c], rows[c]]) for c in rows}
        with_last = shared(rows["g"][:-1], rows["rest"][:-1], rows["g"][1:], rows["rest"][1:])
        left = np.r_[np.int8(0 if before is None else before), with_last].astype(np.int8)
        most = np.maximum(left[:-1], with_last)
        edge = np.zeros(len(most), np.int8)
        if first and len(edge):
            edge[0], first = 1, False
        if len(most):
            yield out({c: v[:-1] for c, v in rows.items()}, most, edge)
        kept, before = {c: v[-1:] for c, v in rows.items()}, left[-1]
    if kept is not None:
        yield out(kept, np.array([before], np.int8), np.array([3 if first else 2], np.int8))


class Family:
    """Levels of sorted suffixes, and what their scans have found."""

    def __init__(self, spark):
        self.spark, self.levels, self.finds = spark, {}, []

    def add(self, batch: DataFrame) -> None:
        """Scan ``batch`` (g, rest, id, pos) against all levels and put it into the family.

        The whole is sorted by ranges, so a suffix that many texts share is spread over tasks; only
        a partition's first and last suffix come to the driver.
        """
        gap = next(k for k in range(len(self.levels) + 1) if k not in self.levels)
        fresh = batch.select(*ORDER, F.lit(0).cast("byte").alias("m"), F.lit(True).alias("keep"))
        old = [level.withColumn("keep", F.lit(k < gap)) for k, level in self.levels.items()]
        every = reduce(DataFrame.unionByName, old, fresh)
        ordered = every.repartitionByRange(partitions(self.spark), *ORDER).sortWithinPartitions(*ORDER)
        kinds = f"{SUFFIX}, m byte, keep boolean, found boolean, edge byte, part int"
        scan = saved(ordered.mapInArrow(_neighbours, kinds), f"suffix-level{gap}")
        self.finds += [scan.filter("found").select("id", "pos", "m"), self._across(scan)]
        self.levels = {k: level for k, level in self.levels.items() if k > gap}
        self.levels[gap] = scan.filter("keep").select(*ORDER, "m")

    def _across(self, scan: DataFrame) -> DataFrame:
        """Finds between the last suffix of a partition and the first of the next that has any."""
        edges = scan.filter("edge > 0").select(*ORDER, "edge", "part").collect()
        ends = sorted(edges, key=lambda r: (r.part, r.edge == 2))
        found = []
        for a, b in zip(ends, ends[1:]):
            if a.part != b.part:
                one, two = [np.array([x], np.int64) for x in (a.g, a.rest)], [np.array([x], np.int64) for x in (b.g, b.rest)]
                m = int(shared(*one, *two)[0])
                found += [(r.id, r.pos, m) for r in (a, b) if m]
        return self.spark.createDataFrame(found, "id long, pos int, m byte")

    def found(self) -> DataFrame:
        """id, pos, m: suffixes that share m symbols with another one (repeated where m has grown)."""
        return reduce(DataFrame.unionByName, self.finds)
