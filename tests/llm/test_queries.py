"""The registered queries over whole tables, against brute force where SQL has no say."""

import hashlib
import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from rentrank.llm import language_model as lm
from rentrank.llm import collocations, decontamination, merkle_manifest, packing, sharding, simhash, suffix_dedup, toxicity, weighted_sampling
from rentrank.llm.registry import ORACLES, QUERIES
from tests.llm.test_decontamination import plain as plain_contamination
from tests.llm.test_language_model import plain_score
from tests.llm.test_packing import check as check_pieces
from tests.llm.test_sharding import check as check_shards
from tests.llm.test_simhash import plain_fingerprint, plain_groups
from tests.llm.test_toxicity import Plain as PlainToxicity
from tests.llm.test_weighted_sampling import alike, edited

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return [tuple(r) for r in rows]


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLES) <= set(oracle_sql())
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash_near_dedup", "benchmark_decontamination", "packing",
    ]


def test_op1(spark, docs, monkeypatch):
    """With production parameters, scores are worked out anew from the sample, word by word."""
    seen, fit, count = [], toxicity.fitted, toxicity._fitted
    monkeypatch.setattr(toxicity, "_fitted", lambda sample: seen.append(sample.filter("fit").collect()) or count(sample))
    monkeypatch.setattr(toxicity, "fitted", lambda frame, labels: seen.append(fit(frame, labels)) or seen[1])
    got = {r.doc_id: r for r in QUERIES["op1_kneser_ney_toxicity"](spark, SF_DIR).collect()}
    plain, model = PlainToxicity([(r.text, r.toxic) for r in seen[0]]), seen[1]
    for d, t in docs[::8]:
        n = len(toxicity.words_of(t))
        mild, above, below = (p / max(1, n) for p in plain.parts(t))
        z = model.offset + sum(s * x for s, x in zip(model.slopes, (mild, math.sqrt(above), -math.sqrt(-below))))
        assert got[d].score == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-6)
        assert got[d].predicted == int(got[d].score >= 0.5)
    assert set(got) == {d for d, _ in docs}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())


def test_op2(spark, docs, monkeypatch):
    """With production parameters, each document's score is worked out anew token by token."""
    seen, fit = [], lm.fitted
    monkeypatch.setattr(lm, "fitted", lambda frame: seen.append(fit(frame)) or seen[0])
    got = {r.doc_id: r for r in QUERIES["op2_log_bilinear_scoring"](spark, SF_DIR).collect()}
    words = {d: [*(t or "").encode().lower().split(), None] for d, t in docs}
    train = Counter(w for d, ws in words.items() if zlib.crc32(str(d).encode()) % 10 for w in ws)
    n, v = sum(train.values()), len(train)
    for d, ws in words.items():
        base = sum(math.log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        assert (got[d].n_tokens, got[d].n_known, got[d].train_tokens) == (len(ws), sum(train[w] > 0 for w in ws), n)
        assert got[d].base_score == pytest.approx(base, rel=1e-9)
    far = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in far) > sum(r.base_score for r in far)
    for d, t in docs[::8]:
        want = plain_score(t, seen[0][3], seen[0][2], train) if len(t) <= 3000 else got[d].score
        assert got[d].score == pytest.approx(want, rel=1e-5)


def test_op4(spark, docs):
    check_shards([tuple(r) for r in QUERIES["op4_feistel_sharding"](spark, SF_DIR).collect()], docs)


def test_op8(spark, docs):
    got = {r.doc_id: r for r in QUERIES["op8_weighted_sampling"](spark, SF_DIR).collect()}
    down = sorted(docs, reverse=True)
    new = edited(down)
    for i, (d, t) in enumerate(down):
        after = got[down[(i + 1) % len(down)][0]].fingerprint
        assert got[d].n_chars == len(t) and got[d].edited_sha256 == hashlib.sha256(new[d].encode()).hexdigest()
        assert (got[d].near_next, got[d].near_edited) == (alike(got[d].fingerprint, after), alike(got[d].fingerprint, got[d].edited_fingerprint))
    by_text = {}
    for d, t in docs:
        by_text.setdefault(t, set()).add(got[d].fingerprint)
    assert all(len(p) == 1 for p in by_text.values())


def test_op9(spark, docs):
    check_pieces(QUERIES["op9_packing"](spark, SF_DIR).collect(), docs, packing.tokenizer_path())


def test_op10(spark, docs):
    got = sorted((tuple(r) for r in QUERIES["op10_simhash_near_dedup"](spark, SF_DIR).collect()), key=repr)
    assert got == plain_groups(docs)


def test_pipeline(spark, docs):
    """Stage by stage against brute force; each stage's decisions are the next one's input."""
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    frame = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = toxicity.fitted(frame, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    toxic = {r.doc_id for r in toxicity.scored(frame, model).filter("predicted = 1").collect()}
    left = [(d, t) for d, t in docs if d not in toxic]
    left = [(d, t) for d, t in left if d in {c for _, _, c in plain_groups(left)}]
    assert len({plain_fingerprint(t) for _, t in left}) == len(left)
    dirty = {r[0] for r in plain_contamination(left, items) if r[5]}
    left = [(d, t) for d, t in left if d not in dirty]
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    check_pieces(got, left, packing.tokenizer_path())
    columns = frame.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, frame, SF_DIR).columns == columns, name


def test_stages_take_empty_and_odd_tables(spark):
    odd = spark.createDataFrame(
        [(None, None, None, None, None, "x"), (1, "", "en", "s", 0, None), (1, "", "en", "s", 0, "y")],
        "doc_id long, text string, lang string, source string, n_chars long, fp string",
    )
    for frame in (odd, odd.limit(0)):
        kept = frame
        for _, stage in corpus_pipeline.STAGES:
            kept = stage(spark, kept, SF_DIR)
            kept.collect()
    assert corpus_pipeline.drop_toxic(spark, odd, SF_DIR).columns == odd.columns


NAMES = (
    "_text _text2 _id _hash _item _begin _len _off _term _places _body _kept_id _kept_text _often mark fp row u v own _bucket "
    "_place _guest _next _rank _start row_number tree rank digest leaf path id g rest pos m keep p n whole key body codes units "
    "tail logs known word kind c held_out text_hash w0 k f a l r score _unit unit"
)


def test_columns_of_any_name(spark):
    """Every stage and operator on documents that have a column for each name used inside."""
    texts = [None, "", "one two three four", "one two three four", "Red. red red. " * 40, "the quick brown fox " * 30]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)] + [(2, texts[2], "en", "s", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    many = frame.withColumns({name: F.lit("x") for name in NAMES.split()})
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, many, SF_DIR)
        if name != "packing":
            assert got.columns == many.columns, name
        assert got.count() >= 1, name
    for run in (
        simhash.near_duplicates, sharding.sharded, weighted_sampling.fingerprinted, merkle_manifest.manifest,
        suffix_dedup.deduplicated, lm.scored, lambda d: collocations.collocations(d, 3),
        lambda d: decontamination.contaminated(d, spark.read.parquet(f"{SF_DIR}/benchmark.parquet")),
    ):
        assert sorted(map(str, run(many).collect())) == sorted(map(str, run(frame).collect()))
