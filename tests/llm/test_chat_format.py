import random

import duckdb
import pytest
from pyspark.sql import functions as F

from check import TABLES, differences
from rentrank.llm import chat_format as chat

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    """(conversation, perspective) to the rendered text and what is learned of it."""
    out = {}
    by = {}
    for c, t, s, x in rows:
        if c is not None:
            by.setdefault(c, []).append((t is not None, t or 0, s or "", x or ""))
    for c, turns in by.items():
        turns.sort()
        for me in {s for _, _, s, _ in turns if s != "system"}:
            whole, learned = "", []
            for _, _, s, x in turns:
                who = "assistant" if s == me else "system" if s == "system" else f"user name={s}"
                whole += f"<|{who}|>\n{x}\n<|end|>\n"
                if s == me:
                    learned.append(f"{x}\n<|end|>\n")
            out[c, me] = whole, learned
    return out


def rebuilt(got):
    out, by = {}, {}
    for r in got:
        by.setdefault((r.conv_id, r.perspective), []).append(r)
    for key, rows in by.items():
        rows.sort(key=lambda r: r.position)
        assert [r.position for r in rows] == list(range(len(rows)))
        whole = "".join(r.segment for r in rows)
        at = 0
        for r in rows:
            assert r.start == at
            at += len(r.segment)
            assert (r.role == "assistant") == (r.mask_start is not None) == (r.mask_end is not None)
            assert (r.name is not None) == (r.role == "user")
        out[key] = whole, [whole[r.mask_start : r.mask_end] for r in rows if r.mask_start is not None]
    return out


def test_equals_plain_rendering(spark):
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["ann", "bob", "çem", "system", None]), rng.choice(["hi", "", None, "Ü b\nc"])) for c in range(20) for t in range(rng.randint(1, 9))]
    rows += [(50, t, rng.choice("xyz"), f"w{t}") for t in range(2000)]  # a long one, over several stretches
    rows += [(51, None, "a", "no turn"), (51, None, None, None), (51, -3, "b", "x"), (51, 700, "b", "y"), (51, 700, "b", "y")]
    rows += [(52, 0, "system", "alone"), (None, 0, "a", "lost"), (53, 1, "a", "z" * 200_000)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("start", F.lit("clash")).withColumn("name", F.lit(1))
    assert rebuilt(chat.perspectives(frame).collect()) == plain(rows)


def test_empty_table(spark):
    assert chat.perspectives(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("stretch", [1, 256])
def test_query_equals_sql(spark, monkeypatch, stretch):
    monkeypatch.setattr(chat, "STRETCH", stretch)
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    got = chat.op5_perspective_rotation(spark, SF_DIR).toPandas()
    assert differences(got, db.sql(chat.ORACLE).df()) is None
