import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rentrank.llm import language_model as lm

SCHEMA = "doc_id long, text string"


@pytest.fixture
def short(monkeypatch):
    monkeypatch.setattr(lm, "STEPS", 150)


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def some_docs():
    rng = random.Random(3)
    tongues = [[f"{c}{a}{b}" for a in "aeiou" for b in "nrstl"] for c in ("", "qu", "ö")]
    docs = []
    for i in range(300):
        words = tongues[i % 3]
        docs.append((i, " ".join(rng.choices(words, weights=[1 / (k + 1) for k in range(25)], k=rng.randint(1, 60)))))
    docs += [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "Once UPON once"), (1004, "an\x1can É é"), (1005, "an " * 20_000)]
    return docs + [(7, docs[7][1]), (7, docs[7][1]), (7, "another"), (None, "unseen words only"), (None, None)]


def train(d):
    return d is not None and zlib.crc32(str(d).encode()) % 10 != 0


def test_counts_and_base(spark, short):
    docs = some_docs()
    frame = spark.createDataFrame(docs, SCHEMA).withColumn("codes", F.lit(1)).withColumn("held_out", F.lit("x"))
    got = lm.scored(frame).collect()
    count = Counter(w for d, t in docs if train(d) for w in tokens(t))
    n, v = sum(count.values()), len(count)
    want = {}
    for d, t in docs:
        own = tokens(t)
        base = sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        want.setdefault((d, len(own)), []).append((sum(count[w] > 0 for w in own), base))
    assert len(got) == len(docs)
    for r in got:
        known, base = want[r.doc_id, r.n_tokens].pop()
        assert (r.n_known, r.train_tokens, r.held_out) == (known, n, not train(r.doc_id))
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert math.isfinite(r.score) and r.score < 0
    assert not any(want.values())
    far = [r for r in got if r.held_out and 20 < r.n_tokens < 100]
    assert sum(r.score for r in far) > sum(r.base_score for r in far)


def test_probabilities_add_up(spark, short):
    """Over all known words, one unseen word per class of rare ones and the end: one, in any context."""
    docs = some_docs()[:300]
    frame = spark.createDataFrame(docs, SCHEMA)
    words = sorted({w for d, t in docs if train(d) for w in tokens(t)[:-1]})
    unseen = {}
    for i in range(20_000):
        word = f"zz{i}".encode() if i else b"zz"
        unseen.setdefault(lm._ending_class(word[-2:]), word)
    for a in "abcdefghijklmnopqrstuvwxyz":
        for b in "abcdefghijklmnopqrstuvwxyz":
            unseen.setdefault(lm._ending_class((a + b).encode()), f"zz{a}{b}".encode())
    assert len(unseen) == lm.ENDINGS
    # Asked as held-out texts of a two-word beginning and each word: the ends' parts are taken off.
    held = [i for i in range(10_000, 10_000_000) if not train(i)][: len(words) + lm.ENDINGS]
    start = "an ar "
    probes = [(i, start + w.decode()) for i, w in zip(held, [*words, *unseen.values()])]
    scores = {}

    def model_of(extra):
        return {r.doc_id: r.score for r in lm.scored(spark.createDataFrame(docs + extra, SCHEMA)).collect()}

    scores = model_of(probes)
    words_of = lm.word_counts(frame.filter(~lm.held_out(F.col("doc_id"), 10)))
    vocabulary = vocabulary_of(words_of)
    counts = lm.triples(lm.coded(frame, vocabulary).filter("NOT held_out"))
    table = lm.trained(counts)
    assert np.allclose((10**table).sum(axis=1), 1)
    code = lambda w: unit_of(vocabulary, w)[0]
    one, two = code(b"an"), code(b"ar")
    assert one <= lm.FREQUENT and two <= lm.FREQUENT
    total = 0.0
    for i, text in probes:
        w = text[len(start) :].encode()
        end = table[two * lm.CLASSES + code(w), 0]
        total += 10 ** (scores[i] - end)
    # What is left of each score is P(an) P(ar | an) P(word | an ar).
    head = table[0, one] + table[one, two]
    ends = 10 ** table[one * lm.CLASSES + two, 0]
    assert total + ends * 10**head == pytest.approx(10**head, rel=1e-6)


def test_contrastive_training_nears_the_truth():
    rng = np.random.default_rng(0)
    counts = np.zeros((lm.CLASSES**2, lm.CLASSES), np.int64)
    for one in range(lm.CLASSES):
        p = rng.dirichlet(np.full(4, 0.5))
        for k in range(4):
            counts[one, (one * 7 + k) % lm.CLASSES] = int(1000 * p[k])
    table = lm.trained(counts)
    share = counts.sum(axis=0) / counts.sum()
    live = counts > 0
    model = (counts[live] * table[live]).sum()
    alone = (counts * np.log10(share + 1e-12)[None, :])[live].sum()
    assert model > 0.75 * alone  # both negative


def test_empty_and_nothing_to_learn(spark):
    assert lm.scored(spark.createDataFrame([], SCHEMA)).collect() == []
    got = lm.scored(spark.createDataFrame([(None, "a b")], SCHEMA)).collect()[0]
    assert (got.n_tokens, got.n_known, got.train_tokens, got.base_score) == (3, 0, 0, 0.0)
    assert got.score == pytest.approx(-3 * math.log10(lm.CLASSES), abs=1e-6)


def test_tokens_at_text_borders():
    context, code = lm._tokens([b"\x05\x06\x00", b"\x00", b"\x07\x00"])
    k = lm.CLASSES
    assert code.tolist() == [5, 6, 0, 0, 7, 0]
    assert context.tolist() == [0, 5, 5 * k + 6, 0, 0, 7]


def test_probabilities_without_words_of_their_own_add_up(spark, short, monkeypatch):
    monkeypatch.setattr(lm, "OWN", 0)
    test_probabilities_add_up(spark, short)


def test_context_tells_words_of_one_class_apart(spark, short):
    """Two words of one ending class, equally frequent, each after its own kind of word."""
    rng = random.Random(4)
    common = [f"{a}{b}" for a in "bcdfghjklmnp" for b in "aeiou"] + ["qa", "qe", "qi"]
    beginnings, ends = ["ustart", "vstart"], ["redend", "blueend"]  # one class of endings each
    docs = []
    for i in range(1500):
        words = []
        for k in range(20):
            words += rng.choices(common, k=4) + ([beginnings[k % 2], ends[k % 2]] if k < 4 else [])
        docs.append((i, " ".join(words)))
    held = [i for i in range(5_000, 9_000) if not train(i)][:4]
    probes = [(h, f"ba ba {b} {e} ba") for h, (b, e) in zip(held, [(b, e) for b in beginnings for e in ends])]
    got = {r.doc_id: r for r in lm.scored(spark.createDataFrame(docs + probes, SCHEMA)).collect()}
    same, other = [got[held[0]], got[held[3]]], [got[held[1]], got[held[2]]]
    assert sum(r.base_score for r in same) == pytest.approx(sum(r.base_score for r in other))
    assert sum(r.score for r in same) > sum(r.score for r in other) + 1


def test_units_by_class(monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 2)
    monkeypatch.setattr(lm, "OWN", 3)
    words = np.array([50, -7, 30, 90, 10, 70])
    kinds = np.array([3, 3, 0, 3, 1, 0])
    v = lm.Vocabulary.of(words, kinds, np.array([10, 20, 30, 9, 40, 5]))
    assert v.words.tolist() == [-7, 10, 30, 50, 70, 90] and v.counts.tolist() == [20, 40, 30, 10, 5, 9]
    # 10 and 30 are the frequent ones; -7, 50 and 90 have vectors, 70 shares that of its class.
    assert v.first[:5].tolist() == [3, 4, 5, 6, 10] and v.first[-1] == 3 + lm.ENDINGS + 3
    assert dict(zip(v.words.tolist(), v.codes.tolist())) == {-7: 6, 10: 1, 30: 2, 50: 6, 70: 3, 90: 6}
    units = dict(zip(v.words.tolist(), v.units.tolist()))
    assert units[10] == 1 and units[30] == 2 and units[70] == 3 and {units[w] for w in (-7, 50, 90)} == {7, 8, 9}
    assert [v.unit_counts[units[w]] for w in (-7, 50, 90)] == [20, 10, 9] and v.unit_counts.sum() == 39


def test_counted_words_are_the_most_frequent(spark):
    rows = [(i, 0, c) for i, c in enumerate([1] * 50 + [2] * 20 + [3] * 10 + [1000, 5000])]
    counts = spark.createDataFrame(rows, "word long, kind int, c long")
    for most, want in ((1, 1), (2, 2), (11, 2), (12, 12), (40, 32), (82, 82), (1000, 82)):
        assert lm.most_frequent(counts, most).num_rows == want
    assert lm.most_frequent(counts.limit(0)).num_rows == 0


def vocabulary_of(words):
    often = lm.most_frequent(words)
    return lm.Vocabulary.of(*(often.column(c).to_numpy() for c in ("word", "kind", "c")))


def unit_of(vocabulary, word):
    """(class, unit) of a word of bytes."""
    h = lm.Hasher(np.frombuffer(word, np.uint8)).of(np.array([0]), np.array([len(word)])).view(np.int64)[0]
    at = np.searchsorted(vocabulary.words, h)
    if at < len(vocabulary.words) and vocabulary.words[at] == h:
        return int(vocabulary.codes[at]), int(vocabulary.units[at])
    kind = lm._ending_class(word[-2:])
    return 1 + lm.FREQUENT + kind, int(vocabulary.first[kind])


def plain_score(text, model, vocabulary, count):
    """A text's score token by token, from the model's parameters."""
    score, one, two = 0.0, (0, 0), (0, 0)
    for word in [*(text or "").encode().lower().split(), None]:
        code, unit = (0, 0) if word is None else unit_of(vocabulary, word)
        score += model.log_class[two[0] * lm.CLASSES + one[0], code]
        if code > lm.FREQUENT:
            w, c = model.words, code - 1 - lm.FREQUENT
            a, b = int(w.first[c]), int(w.first[c + 1])
            z = [float((w.one[one[1]] + w.two[two[1]]) @ w.out[u] + w.bias[u]) for u in range(a, b)]
            top = max(z)
            if b - a > 1:
                score += (z[unit - a] - top - math.log(sum(math.exp(x - top) for x in z))) / math.log(10)
            if unit == a:
                score += math.log10(count[word] + 0.1) - w.rest[c]
        one, two = (code, unit), one
    return score


def test_scores_token_by_token(spark, short, monkeypatch):
    """Each document's score from the model's parameters, with words counted for all tasks, in the tail, and unseen."""
    docs = some_docs()
    rng = random.Random(5)
    docs += [(2000 + i, " ".join(f"w{rng.randint(0, 400)}{rng.choice('abcdefg')}x" for _ in range(rng.randint(1, 50)))) for i in range(80)]
    monkeypatch.setattr(lm, "COUNTED", 100)
    monkeypatch.setattr(lm, "OWN", 15)
    seen, fit = [], lm.fitted
    monkeypatch.setattr(lm, "fitted", lambda docs: seen.append(fit(docs)) or seen[0])
    got = lm.scored(spark.createDataFrame(docs, SCHEMA)).collect()
    _, _, vocabulary, model = seen[0]
    assert len(vocabulary.words) <= 100 and np.abs(model.words.out).sum() > 0
    count = Counter(w for d, t in docs if train(d) for w in tokens(t)[:-1])
    want = {}
    for d, t in docs:
        want.setdefault((d, len(tokens(t))), []).append(plain_score(t, model, vocabulary, count))
    for r in got:
        near = min(want[r.doc_id, r.n_tokens], key=lambda x: abs(x - r.score))
        assert r.score == pytest.approx(near, rel=1e-5, abs=1e-5)
