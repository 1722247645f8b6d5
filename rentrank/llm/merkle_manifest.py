"""A Merkle manifest of a dataset, by nested intervals of leaf ranks.

Every row is a leaf; the leaves of a source, in the order of doc_id, make a tree in which runs of
``ARITY`` nodes become their digest, and the sources' roots, in the order of source, make the tree
above. A node carries the interval [lo, hi) of leaf ranks that it covers. An ancestor is attached
to a node by containment: its level's bucket of the node's ``lo``, its interval around the node's.
Siblings are what is left of the parent's children without the node's own interval.

Trees are joined level by level from the top, so that what is attached to the leaves is one row
per run of ``ARITY``; a group has at most ``ARITY`` rows, however large its source is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from rentrank.llm import order
from rentrank.llm.store import partitions, saved, table
from rentrank.llm.text import UPPER

ARITY = 16
#: Of the documents, those whose unsigned crc32 of the decimal doc_id this divides are tampered with.
TAMPERED = 5
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: What lies on the way from a node to a root: digests left and right of it, one pair a level.
PATH = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the concatenated parts."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for NULL, else the UTF-8 byte count, ``:`` and the value; integers in decimal."""
    text = value.cast("string")
    sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(sized, F.lit("-"))


def leaf(text: Column | None = None) -> Column:
    """A row's leaf; ``text`` in place of its own text."""
    values = {name: F.col(name) for name in FIELDS}
    if text is not None:
        values["text"] = text
    return digest(*[field(v) for v in values.values()])


def tampered_leaf() -> Column:
    """The leaf after the text's A-Z were lower-cased, NULL for rows that are left alone."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    return F.when(hit, leaf(F.translate("text", UPPER, UPPER.lower())))


def _starts(placed: DataFrame, tree: list[str], part: str) -> DataFrame:
    """``tree``, ``part``, _start, n: leaves of the tree in earlier parts, and in all of them."""
    whole = Window.partitionBy(*tree)
    before = whole.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(*tree, part).count()
    return counts.select(
        *tree, part, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"),
        F.sum("count").over(whole).alias("n"),
    )


def _numbered(placed: DataFrame, tree: list[str], part: str, *by: Column | str) -> DataFrame:
    """``placed`` with its rank and ``n``, the leaves of its tree. Parts ascend with ``by``."""
    starts = saved(_starts(placed, tree, part), "merkle-starts")
    own = Window.partitionBy(*tree, part).orderBy(*by)
    ranked = placed.withColumn("_at", F.row_number().over(own) - 1)
    return ranked.join(starts, [*tree, part]).withColumn("rank", F.col("_start") + F.col("_at")).drop(
        "_start", "_at", part
    )


def leaves(docs: DataFrame) -> DataFrame:
    """tree, rank, n, doc_id, leaf, tampered of every row; written. ``tree`` sorts like source, NULL first.

    Within a source leaves ascend by doc_id, NULL ids last; rows that share one are ordered by
    their leaf, so that the manifest does not depend on how the table lies in files. Texts are
    read once and never shuffled.
    """
    n = partitions(docs.sparkSession)
    key = F.coalesce(F.concat(F.lit("+"), F.col("source")), F.lit(""))
    read = docs.select(key.alias("tree"), "doc_id", leaf().alias("leaf"), tampered_leaf().alias("tampered"))
    read = saved(read, "merkle-leaves")
    limits = order.bounds(read, "doc_id", n)
    spread = F.xxhash64("leaf")
    placed = read.withColumn("_part", order.bucket(F.col("doc_id"), spread, limits, n))
    ranked = _numbered(placed, ["tree"], "_part", F.asc_nulls_last("doc_id"), spread, "leaf")
    return saved(ranked, "merkle-ranked")


def _bucket_of(level: int) -> Column:
    """The bucket, among those of ``level``, of the leaf rank ``lo``."""
    return F.expr(f"lo DIV {ARITY**level}")


def _parents(nodes: DataFrame, level: int) -> DataFrame:
    """The nodes of ``level`` above ``nodes`` (tree, n, lo, hi, digest), with their children."""
    child = F.sort_array(F.collect_list(F.struct("lo", "hi", "digest")))
    above = nodes.filter(F.col("n") > ARITY ** (level - 1)).groupBy(
        "tree", "n", _bucket_of(level).alias("bucket")
    ).agg(child.alias("children"))
    return above.select(
        "tree", "n", "bucket", "children", F.array_min("children.lo").alias("lo"),
        F.array_max("children.hi").alias("hi"), digest(F.array_join("children.digest", "")).alias("digest"),
    )


def levels(ranked: DataFrame, digest_column: str) -> tuple[list[DataFrame], DataFrame]:
    """(the trees' inner levels from the lowest, their roots (tree, root)), by ``rank`` and ``n``.

    A level is written before the next is made; their number is the logarithm of the largest tree.
    """
    nodes = ranked.select("tree", "n", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), F.col(digest_column).alias("digest"))
    top = ranked.agg(F.max("n")).first()[0] or 0
    roots, found, level = nodes.filter("n = 1"), [], 0
    while top > ARITY**level:
        level += 1
        found.append(saved(_parents(nodes, level), f"merkle-level{level}"))
        nodes = found[-1].select("tree", "n", "lo", "hi", "digest")
        roots = roots.unionByName(nodes.filter(F.col("n") <= ARITY**level))
    return found, roots.select("tree", F.col("digest").alias("root"))


def _siblings(lo: Column, hi: Column) -> Column:
    """One step of a path: the parent's children less the node's own interval, left and right."""
    left = F.filter("_children", lambda c: c["hi"] <= lo)
    right = F.filter("_children", lambda c: c["lo"] >= hi)
    join = lambda nodes: F.array_join(F.transform(nodes, lambda c: c["digest"]), "")
    return F.struct(join(left).alias("before"), join(right).alias("after"))


def attached(nodes: DataFrame, above: DataFrame, level: int) -> DataFrame:
    """``nodes`` (tree, lo, hi, ...) with the path and subroot of their ancestor at ``level``.

    ``above`` has that level's tree, bucket, lo, hi, children, path and subroot; the path becomes
    one step longer.
    """
    a = above.select(
        F.col("tree").alias("_tree"), F.col("bucket").alias("_bucket"), F.col("lo").alias("_lo"),
        F.col("hi").alias("_hi"), F.col("children").alias("_children"), F.col("path").alias("_path"), "subroot",
    )
    same = (F.col("tree") == F.col("_tree")) & (_bucket_of(level) == F.col("_bucket"))
    inside = (F.col("_lo") <= F.col("lo")) & (F.col("hi") <= F.col("_hi"))
    path = F.concat(F.array(_siblings(F.col("lo"), F.col("hi"))), "_path")
    return nodes.join(a, same & inside).withColumn("path", path.cast(PATH)).drop(
        "_tree", "_bucket", "_lo", "_hi", "_children", "_path"
    )


def with_paths(ranked: DataFrame, inner: list[DataFrame], base: DataFrame) -> DataFrame:
    """``ranked`` with ``path`` and ``subroot``.

    ``base``: tree, subroot, and the path from there on; a leaf's path goes up to its tree's root
    and then along that one.
    """
    above = None
    for level in range(len(inner), 0, -1):
        nodes = inner[level - 1]
        paths = nodes.filter(F.col("n") <= ARITY**level).join(base, "tree")
        if above is not None:
            paths = paths.unionByName(attached(nodes.filter(F.col("n") > ARITY**level), above, level + 1))
        above = saved(paths, f"merkle-paths{level}")
    spans = ranked.withColumns({"lo": F.col("rank"), "hi": F.col("rank") + 1})
    found = spans.filter("n = 1").join(base, "tree")
    if above is not None:
        found = found.unionByName(attached(spans.filter("n > 1"), above, 1))
    return found.drop("lo", "hi")


def proof(path: Column) -> Column:
    """One digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "").cast("binary"), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` leads to along ``path``."""
    return F.aggregate(path, leaf, lambda node, s: digest(s["before"], node, s["after"]))


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row of ``docs``.

    The proof is of the table as it is; ``folded_root`` starts from the tampered leaf where the
    row is one of those tampered with (a NULL doc_id is not), and ``verified`` says whether it
    still is the root. Rows without siblings (one row in all) have the digest of nothing as their
    proof. An empty table has no rows. Repeated rows are leaves of their own, next to each other.
    Source NULL is a tree of its own, before that of the empty source.
    """
    ranked = leaves(docs)
    inner, roots = levels(ranked, "leaf")
    n = partitions(docs.sparkSession)
    ordered = saved(roots.repartitionByRange(n, "tree").withColumn("_part", F.spark_partition_id()), "merkle-roots")
    sources = ordered.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "root", "_part")
    sources = saved(_numbered(sources, ["tree"], "_part", "of"), "merkle-sources")
    upper, top = levels(sources, "root")
    top = top.select("tree", F.col("root").alias("subroot"), F.array().cast(PATH).alias("path"))
    base = with_paths(sources, upper, top).select(
        F.col("of").alias("tree"), F.col("root").alias("subroot"), F.col("subroot").alias("root"), "path"
    )
    base = saved(base, "merkle-base")
    root = base.agg(F.first("root")).first()[0]  # one digest
    found = with_paths(ranked, inner, base.drop("root"))
    return found.select(
        "doc_id", "leaf", "subroot", F.lit(root).alias("root"), proof(F.col("path")).alias("proof_sha256"),
        folded(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, and the check of every row's proof."""
    return manifest(table(spark, sf_dir, "documents"))


def _sized(value: str) -> str:
    return f"coalesce(octet_length(encode({value}))::VARCHAR || ':' || {value}, '-')"


def _leaf_sql(text: str) -> str:
    parts = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(_sized(p) for p in parts) + ")"


#: DuckDB has no crc32: its table, and then byte by byte over the decimal digits.
ORACLE = f"""
WITH RECURSIVE crc_table AS (
  SELECT i, list_reduce([i::UBIGINT] || [0::UBIGINT FOR b IN range(8)],
    lambda c, b: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END) AS v
  FROM range(256) r(i)
), lookup AS (SELECT list(v ORDER BY i) AS v FROM crc_table), crc AS (
  SELECT doc_id, xor(list_reduce([4294967295::UBIGINT] || [ascii(x)::UBIGINT FOR x IN string_split(doc_id::VARCHAR, '')],
    lambda c, x: xor(c // 256, v[((xor(c, x) % 256) + 1)::BIGINT])), 4294967295::UBIGINT) AS crc
  FROM documents, lookup
), leaves AS (
  SELECT d.doc_id, source, {_leaf_sql('text')} AS leaf,
    CASE WHEN crc % 5 = 0 THEN {_leaf_sql(f"translate(text, '{UPPER}', '{UPPER.lower()}')")} END AS tampered,
    row_number() OVER (PARTITION BY source ORDER BY d.doc_id) - 1 AS rank,
    count(*) OVER (PARTITION BY source) AS n
  FROM documents d JOIN crc USING (doc_id)
), nodes AS (
  SELECT 0 AS level, source, rank AS pos, n AS left_over, leaf AS digest FROM leaves
  UNION ALL
  SELECT level + 1, source, pos // 16, any_value((left_over + 15) // 16), sha256(string_agg(digest, '' ORDER BY pos))
  FROM nodes WHERE left_over > 1 GROUP BY level, source, pos // 16
), subroots AS (
  SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS rank, count(*) OVER () AS n
  FROM nodes WHERE left_over = 1
), tops AS (
  SELECT 0 AS level, rank AS pos, n AS left_over, subroot AS digest FROM subroots
  UNION ALL
  SELECT level + 1, pos // 16, any_value((left_over + 15) // 16), sha256(string_agg(digest, '' ORDER BY pos))
  FROM tops WHERE left_over > 1 GROUP BY level, pos // 16
), steps AS (
  SELECT l.doc_id, 0 AS part, a.level,
    coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS before,
    coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS after
  FROM leaves l
  JOIN nodes a ON a.source IS NOT DISTINCT FROM l.source AND a.pos = l.rank // (16 ** a.level)::BIGINT AND a.left_over > 1
  JOIN nodes b ON b.source IS NOT DISTINCT FROM a.source AND b.level = a.level AND b.pos // 16 = a.pos // 16
  GROUP BY l.doc_id, a.level
  UNION ALL
  SELECT l.doc_id, 1, a.level,
    coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), ''),
    coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '')
  FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source
  JOIN tops a ON a.pos = s.rank // (16 ** a.level)::BIGINT AND a.left_over > 1
  JOIN tops b ON b.level = a.level AND b.pos // 16 = a.pos // 16
  GROUP BY l.doc_id, a.level
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY part, level) AS step FROM steps
), fold AS (
  SELECT doc_id, 0 AS step, coalesce(tampered, leaf) AS node FROM leaves
  UNION ALL
  SELECT f.doc_id, f.step + 1, sha256(before || node || after)
  FROM fold f JOIN numbered n ON n.doc_id = f.doc_id AND n.step = f.step + 1
), last AS (SELECT doc_id, arg_max(node, step) AS folded_root FROM fold GROUP BY doc_id),
proofs AS (SELECT doc_id, sha256(string_agg(before || after, '' ORDER BY step)) AS proof FROM numbered GROUP BY doc_id)
SELECT l.doc_id, leaf, subroot, (SELECT digest FROM tops WHERE left_over = 1) AS root,
  coalesce(proof, sha256('')) AS proof_sha256, folded_root,
  folded_root = (SELECT digest FROM tops WHERE left_over = 1) AS verified
FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source
JOIN last USING (doc_id) LEFT JOIN proofs USING (doc_id)
"""
