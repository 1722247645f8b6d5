"""Collocations against counts of all phrases in Python, and the parts by themselves."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rentrank.llm import buffers
from rentrank.llm import collocations as m


def plain(rows, least=30, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    cand = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    out = {}
    for (lang, g), a in cand.items():
        longer = [c for (x, p), c in cand.items() if x == lang and len(p) > len(g) and any(p[i : i + len(g)] == g for i in range(len(p)))]
        if any(100 * c >= 80 * a for c in longer):
            continue
        sides = [(f[lang, g[:k]], f[lang, g[k:]]) for k in range(1, len(g))]
        score, _, (left, right) = min((2_000_000 * a // (x + y), i, (x, y)) for i, (x, y) in enumerate(sides))
        out.setdefault(lang, []).append((-score, -a, " ".join(g).encode(), left, right))
    return sorted(
        (lang, i, p.decode(), -a, left, right, n[lang], -score)
        for lang, found in out.items()
        for i, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1)
    )


def run(spark, rows, parts=3, names="", **parameters):
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(parts)
    for name in names.split():
        frame = frame.withColumn(name, F.lit("x"))
    got = m.collocations(frame, **parameters)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in got.collect())


def some_texts(seed, n=120, words="red Blue green ÉTÉ sun a b c".split()):
    rng = random.Random(seed)
    ends = [" ", " ", " ", "\t", "  ", ". ", ", ", "\n", "!", "\x0b", "\x0c ", "\r\n"]
    return [(rng.choice(["en", "de", None, "und"]), "".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randint(0, 60)))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_against_all_phrases(spark, seed):
    rows = some_texts(seed)
    want = plain(rows, 4)
    assert len(want) > 20 and run(spark, rows, least=4, names="w0 w1 c k f a l r n score _level _left part") == want


def test_few_cells_and_short_stretches_change_nothing(spark, monkeypatch):
    rows = some_texts(7)
    want = run(spark, rows, least=5)
    bits = m.full_cells(spark.createDataFrame(rows, "lang string, text string"), 5)
    assert len(bits) == (1 << m.CELL_BITS) // 64 and bits.any()
    # All cells full: no window is cut before the exact counts.
    monkeypatch.setattr(m, "full_cells", lambda docs, least: np.full(len(bits), 2**64 - 1, np.uint64))
    assert run(spark, rows, least=5) == want == plain(rows, 5)


def test_top_and_ties(spark):
    rows = [("en", f"{a} {b}") for a in "pqrs" for b in "tu" for _ in range(30)]
    assert run(spark, rows, top=3) == plain(rows, top=3) and len(run(spark, rows, top=3)) == 3


def test_nulls_empty_and_long_texts_repeats_and_empty_tables(spark):
    long = ("one two three. " * 20_000) + "x" * 100_000
    rows = [(None, None), ("en", ""), ("en", " \t\n.,"), ("und", long), (None, "one two"), *[("en", "same row")] * 31]
    assert run(spark, rows) == plain(rows)
    assert run(spark, [("en", None)]) == [] and run(spark, []) == []


def test_stretches_cut_rows_whole_and_long_rows_at_breaks():
    data = b"aaa.bbb" + b"c" * 50 + b".dd.ee" + b"f"
    offsets = np.array([0, 7, 7, len(data) - 1, len(data)])
    breaks = np.array([i for i, c in enumerate(data) if c == ord(".")])
    cuts = list(buffers.stretches(offsets, 10, breaks))
    assert [data[a:b] for a, b in cuts] == [b"aaa.bbb", b"c" * 50 + b".", b"dd.eef"]
    assert list(buffers.stretches(np.array([0]), 10, breaks[:0])) == []


def test_hashes_tell_stretches_apart_and_agree_across_texts():
    data, offsets = buffers.utf8(pa.array(["abcabc", None, "", "xabc"]).slice(0, 4))
    assert offsets.tolist() == [0, 6, 6, 6, 10]
    h = buffers.Hasher(data).of(np.array([0, 3, 7, 0, 0]), np.array([3, 6, 10, 2, 4]))
    assert h[0] == h[1] == h[2] and len(set(h.tolist())) == 3


def test_two_words_with_one_hash_are_an_error(spark):
    rows = spark.createDataFrame([("en", 2, 1, 2, 0, 0)], "lang string, k int, w0 long, w1 long, w2 long, w3 long")
    words = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "h long, word string")
    with pytest.raises(Exception, match="one hash"):
        m.spelt(rows, words).collect()


def test_registered_query(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("lang", "text").collect()]
    assert sorted(tuple(r) for r in m.op13_phrase_collocations(spark, "/root/testdata/sf0.001").collect()) == plain(rows)
