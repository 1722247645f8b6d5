"""The manifest against hashes worked out leaf by leaf in Python."""

import zlib
from hashlib import sha256

import pytest

from rentrank.llm import merkle_manifest as m

KINDS = "doc_id long, source string, lang string, n_chars int, text string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(leaves):
    """(root, siblings of each leaf from the lowest level: pairs of those before and after)."""
    paths, owners, nodes = [[] for _ in leaves], [[i] for i in range(len(leaves))], list(leaves)
    while len(nodes) > 1:
        runs = [range(i, min(i + 16, len(nodes))) for i in range(0, len(nodes), 16)]
        for run in runs:
            for at in run:
                step = [nodes[x] for x in run if x < at], [nodes[x] for x in run if x > at]
                for leaf in owners[at]:
                    paths[leaf].append(step)
        owners = [[leaf for at in run for leaf in owners[at]] for run in runs]
        nodes = [h(*[nodes[at] for at in run]) for run in runs]
    return nodes[0], paths


def plain(rows):
    leaf = lambda r: h(*map(field, r))
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for source in order:
        by_source[source].sort(key=lambda r: (r[0] is None, r[0] or 0))
        trees.append(tree([leaf(r) for r in by_source[source]]))
    root, above = tree([t[0] for t in trees])
    out = []
    for source, (subroot, paths), upper in zip(order, trees, above):
        for r, path in zip(by_source[source], paths):
            steps = path + upper
            node = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                node = leaf((*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])))
            for before, after in steps:
                node = h(*before, node, *after)
            proof = h(*[x for before, after in steps for x in before + after])
            out.append((r[0], leaf(r), subroot, root, proof, node, node == root))
    return sorted(out, key=repr)


def run(spark, rows, extra=""):
    frame = spark.createDataFrame(rows, KINDS) if rows else spark.createDataFrame([], KINDS)
    for name in extra.split():
        frame = frame.withColumn(name, m.F.lit("x"))
    got = m.manifest(frame)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("sizes", [(1,), (16,), (17,), (273, 1, 0, 40), (1,) * 18])
def test_trees_of_all_depths(spark, sizes):
    rows, at = [], 0
    for source, size in enumerate(sizes):
        for _ in range(size):
            at += 1
            rows.append((at * 7919 % 10_007, f"s{source}", "en", at, f"Text É {at}"))
    assert run(spark, rows) == plain(rows)


def test_nulls_empty_texts_ties_and_clashing_names(spark):
    rows = [
        (1, None, None, None, None), (2, "", "", 0, ""), (3, "-", "en", 3, "A:B"), (None, "x", "en", 1, "Q"),
        (5, "x", None, 2, "QQ"), (5, "x", None, 2, "QQ"), (6, "é", "en", 9, "ÄÖ Z" * 30_000), (7, "z", "en", 1, "Z"),
    ]
    names = "tree leaf n rank lo hi digest bucket children path subroot root of _part _path tampered"
    assert run(spark, rows, names) == plain(rows)


def test_rows_that_share_an_id_are_ordered_by_leaf_whatever_the_files(spark):
    rows = [(4, "s", "en", i, f"t{i}") for i in range(40)]
    assert run(spark, rows) == run(spark, rows[::-1])


def test_what_was_changed_does_not_verify(spark):
    rows = [(i, "s", "en", 1, "Upper" if i % 2 else "lower") for i in range(60)]
    hit = {i for i in range(60) if i % 2 and zlib.crc32(str(i).encode()) % 5 == 0}
    assert hit and {r[0] for r in run(spark, rows) if not r[6]} == hit


def test_empty_table(spark):
    assert run(spark, []) == []


def test_registered_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = m.op11_merkle_manifest(spark, "/root/testdata/sf0.001").collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain(rows)
