"""Near-duplicates by SimHash: fingerprints, BK-tree search, components.

Fingerprints within ``radius`` bits agree wholly in one of ``radius + 1`` blocks of bits, so a
shard is a value of a block: its tree holds every fingerprint with that value, and every such
fingerprint is searched for in it. Trees grow in number with the corpus, so a tree goes to the
task of its shard rather than to all. A tree has at most about SHARD_NODES nodes: the fingerprints
of a fuller shard are dealt to several trees, and its searches go to each of them, in as many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentrank.llm import bktree
from rentrank.llm.components import components
from rentrank.llm.store import partitions, saved, table, text_hash

WORDS = 3
RADIUS = 2
SEED = 42
BITS = 64
SHARD_NODES = 4096
#: Rows that a task searches together, and shingles that it hashes together.
SEARCH_ROWS = 200_000
HASH_ROWS = 65_536


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The 64-bit SimHash of a text's word shingles; 0 if it has no words."""
    tokens = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not tokens:
        return 0
    line = b" ".join(tokens)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    width = min(words, len(tokens))
    starts, ends = starts[: len(tokens) - width + 1], ends[width - 1 :]
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(starts), HASH_ROWS):
        spans = zip(starts[i : i + HASH_ROWS].tolist(), ends[i : i + HASH_ROWS].tolist())
        hashes = [xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in spans]
        raw = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(counts * 2 > len(starts), bitorder="little")
    return int(set_bits.view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``fp``, the fingerprint's bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(text, words) for text in batch.column("text").to_pylist()]
            fp = pa.array(np.array(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in keep] + [fp], [*keep, "fp"])

    chosen = docs.select(*keep, "text")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in chosen.schema if f.name != "text")
    return chosen.mapInArrow(run, f"{kinds}, fp long")


def _shards(distinct: DataFrame, radius: int) -> DataFrame:
    """(block, value, slice, member, fp): every fingerprint in each tree that it is searched in."""
    blocks = radius + 1
    width = -(-BITS // blocks)
    mask = (1 << width) - 1
    values = [
        F.struct(F.lit(i).alias("block"), F.shiftrightunsigned("fp", i * width).bitwiseAND(F.lit(mask)).alias("value"))
        for i in range(blocks)
    ]
    spread = distinct.select("fp", F.inline(F.array(*values)))
    sizes = spread.groupBy("block", "value").count().filter(F.col("count") > SHARD_NODES)
    full = sizes.select("block", "value", F.ceil(F.col("count") / SHARD_NODES).cast("int").alias("trees"))
    trees = F.coalesce("trees", F.lit(1))
    dealt = spread.join(full, ["block", "value"], "left").select(
        "block", "value", "fp", F.pmod(F.xxhash64("fp"), trees).cast("int").alias("own"),
        F.explode(F.sequence(F.lit(0), trees - 1)).alias("slice"),
    )
    return dealt.select("block", "value", "slice", (F.col("own") == F.col("slice")).alias("member"), "fp")


def _search(tree: np.ndarray, member: np.ndarray, asked: np.ndarray, fp: np.ndarray, radius: int):
    """Star links of what ``asked`` rows find among the members of their trees."""
    _, tree = np.unique(tree, return_inverse=True)
    # A tree without members has nothing to find.
    names, dense = np.unique(tree[member], return_inverse=True)
    forest = bktree.Forest(dense, fp[member])
    place = np.searchsorted(names, tree)
    has = (place < len(names)) & asked
    has[has] = names[place[has]] == tree[has]
    query = fp[has]
    a, b = [], []
    for of, node in forest.search(place[has], query, radius):
        x, y = query[of], forest.fingerprint[node]
        other = x != y
        a.append(x[other])
        b.append(y[other])
    if not a:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return bktree.stars(np.concatenate(a), np.concatenate(b))


def _searcher(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by shard, members first."""
        kept: list[np.ndarray] | None = None

        def found(rows):
            shard, member, asked, fp = rows
            node, root = _search(shard, member, asked, fp, radius)
            return pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array(root.view(np.int64))], ["u", "v"])

        for batch in batches:
            b = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in batch.schema.names}
            # The number of a shard within this task: it changes where block, value or slice do.
            ids = np.stack([b["block"], b["value"], b["slice"]])
            turn = np.r_[1, (ids[:, 1:] != ids[:, :-1]).any(axis=0).astype(np.int64)] if len(batch) else np.empty(0, np.int64)
            if kept is not None and len(batch) and len(kept[0]):
                turn[0] = int((last != ids[:, 0]).any())
            base = kept[0][-1] if kept is not None and len(kept[0]) else 0
            if len(batch):
                last = ids[:, -1]
            rows = [base + np.cumsum(turn), b["member"], np.ones(len(batch), bool), b["fp"].view(np.uint64)]
            kept = rows if kept is None else [np.concatenate(x) for x in zip(kept, rows)]
            if len(kept[0]) < SEARCH_ROWS:
                continue
            whole = kept[0] < kept[0][-1]
            if whole.any():
                yield found([x[whole] for x in kept])
                kept = [x[~whole] for x in kept]
            elif not kept[1][-1]:  # one shard, all of its members at hand: its searches so far
                yield found(kept)
                kept = [x[kept[1]] for x in kept]
                kept[2][:] = False
        if kept is not None and len(kept[0]):
            yield found(kept)

    return run


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v): links that tie together whatever fingerprints lie within ``radius`` bits.

    ``distinct``: a column fp without repetitions. A search's finds come back as one link per
    fingerprint to the smallest it is tied to, so that a tight group never makes all its pairs.
    """
    n = partitions(distinct.sparkSession)
    dealt = _shards(distinct, radius).repartition(n, "block", "value", "slice")
    ordered = dealt.sortWithinPartitions("block", "value", "slice", F.desc("member"))
    return ordered.mapInArrow(_searcher(radius), "u long, v long")


def classes(marked: DataFrame, radius: int = RADIUS, least: str = "doc_id") -> DataFrame:
    """(fp, least): per fingerprint the smallest ``least`` over all it is tied to.

    ``marked`` has the columns fp and ``least`` and should be a written table.
    """
    per_print = saved(marked.groupBy("fp").agg(F.min(least).alias("own")), "prints")
    tied = components(links(per_print.select("fp"), radius))
    rooted = per_print.join(tied, F.col("fp") == F.col("u"), "left").select(
        "fp", "own", F.coalesce("v", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("own").alias("least"))
    return saved(rooted.join(smallest, "root").select("fp", F.col("least").alias(least)), "classes")


def near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of ``docs``.

    A-Z count as a-z; words lie between ASCII white space; a bit is set where more than half the
    shingles' hashes (XXH64, seed 42) have it. Fewer words than a shingle: one shingle of all. A
    NULL or blank text has fingerprint zero, which links like any other. Fingerprints at
    ``radius`` or fewer differing bits link; component_id is the smallest doc_id reachable
    (NULL ids don't count; NULL if there are only such). Repeated rows come back as often.
    """
    marked = saved(fingerprints(docs, words), "fingerprints")
    group = classes(marked, radius).withColumnRenamed("doc_id", "component_id")
    return marked.join(group, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: that of the smallest doc_id.

    Rows with a NULL doc_id come after all others; ties by the text's hash; rows that agree in
    doc_id and text are one.
    """
    mark = F.struct(
        F.col("doc_id").isNull().alias("late"), F.col("doc_id").alias("id"), text_hash().alias("text")
    )
    marked = saved(fingerprints(docs.select("doc_id", "text", mark.alias("mark")), words, ("mark",)), "fingerprints")
    kept = classes(marked, radius, "mark").select(F.col("mark.id").alias("_kept_id"), F.col("mark.text").alias("_kept_text")).distinct()
    kept = saved(kept, "kept")
    same = docs["doc_id"].eqNullSafe(kept["_kept_id"]) & (text_hash() == kept["_kept_text"])
    stays = docs.join(kept, same, "left_semi")
    # Only a doc_id that occurs more than once can still have rows to spare.
    often = docs.groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("_often"))
    often = saved(often, "often")
    again = stays["doc_id"].eqNullSafe(often["_often"])
    single = stays.join(often, again, "left_anti")
    # The columns of documents may have any names, so they are one column meanwhile.
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    repeated = stays.join(often, again, "left_semi").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), whole.alias("row"))
    return single.unionByName(repeated.dropDuplicates(["doc_id", "text"]).select("row.*"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: 3-word shingles, 2 bits."""
    return near_duplicates(table(spark, sf_dir, "documents"))
