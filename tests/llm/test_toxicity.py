import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rentrank.llm import toxicity as tox

DOCS, LABELS = "doc_id long, text string", "doc_id long, quality int, toxic int"


def corpus(n=600):
    rng = random.Random(6)
    plain = [f"{a}{b}{c}" for a in "bdfg" for b in "aeo" for c in ("l", "ment", "tion")]
    bad = ["scoundrel", "blackguard", "knavish", "knaveries"]
    docs, labels = [], []
    for i in range(n):
        words = rng.choices(plain, weights=[1 / (k + 1) for k in range(len(plain))], k=rng.randint(5, 80))
        toxic = i % 5 == 0
        if toxic:
            for _ in range(1 + len(words) // 20):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        docs.append((i, " ".join(words)))
        if i % 3:
            labels.append((i, 1, int(toxic)))
    return docs, labels


class Plain:
    """The same ratios, from plain dictionaries."""

    def __init__(self, sample):
        self.chunks = {0: Counter(), 1: Counter()}
        for text, toxic in set(sample):
            for w in set(tox.words_of(text)):
                h = b""
                for sofar, chunk in tox.chain(w):
                    self.chunks[toxic][h, sofar, chunk] += 1
                    h = sofar
        self.before = defaultdict(set)
        self.after = {0: defaultdict(Counter), 1: defaultdict(Counter)}
        for y in (0, 1):
            for (h, _, u), n in self.chunks[y].items():
                self.before[u].add(h)
                self.after[y][h][u] += n
        self.total = sum(map(len, self.before.values()))
        self.sizes, self.ratios = {}, {}

    def size(self, h, *ys):
        """(documents, chunks) after ``h`` in the classes ``ys``."""
        if (h, ys) not in self.sizes:
            after = sum((self.after[y][h] for y in ys), Counter())
            self.sizes[h, ys] = sum(after.values()), len(after)
        return self.sizes[h, ys]

    def spelled(self, y, word):
        p, h, lost = 1.0, b"", False
        for sofar, u in tox.chain(word):
            kept = not lost and max(self.chunks[z][h, sofar, u] for z in (0, 1)) > 1
            own, kinds = self.size(h, y)
            weight = (kinds + tox.STRENGTH) / (own + tox.STRENGTH)
            if kept:
                size, kinds = self.size(h, 0, 1)
                shared = (self.chunks[0][h, sofar, u] + self.chunks[1][h, sofar, u] - 1) / (size + tox.STRENGTH)
                shared += (kinds + tox.STRENGTH) / (size + tox.STRENGTH) * len(self.before[u]) / self.total
                p *= max(0, self.chunks[y][h, sofar, u] - 1) / (own + tox.STRENGTH) + weight * shared
            else:
                p *= (1.0 if lost else weight) * 0.001  # whatever the backoff says, both classes alike
                lost = True
            h = sofar
        return p

    def parts(self, text):
        for w in set(tox.words_of(text)) - set(self.ratios):
            self.ratios[w] = math.log(self.spelled(1, w) / self.spelled(0, w))
        ratios = [self.ratios[w] for w in tox.words_of(text)]
        mild = [max(-tox.MILD, min(tox.MILD, r)) for r in ratios]
        beyond = [r - m for r, m in zip(ratios, mild)]
        return [sum(mild), sum(b for b in beyond if b > 0), sum(b for b in beyond if b < 0)]


def test_ratios_equal_plain_counting(spark, monkeypatch):
    monkeypatch.setattr(tox, "STRENGTH", 2.0)
    monkeypatch.setattr(tox, "MILD", 0.5)
    docs, labels = corpus(60)
    mark = {d: y for d, _, y in labels}
    sample = sorted({(t, mark[d]) for d, t in docs if d in mark})
    frame = spark.createDataFrame([(t, y, True) for t, y in sample], "text string, toxic int, fit boolean")
    model, plain = tox._fitted(frame), Plain(sample)
    texts = [docs[0][1], docs[1][1], "never seen at all", "scoundrelly bal", "", None, "bal bal\tBAL"]
    n, parts = tox.Scorer(model)(texts)
    assert n.tolist() == [len(tox.words_of(t)) for t in texts]
    for got, text in zip(parts.tolist(), texts):
        assert got == pytest.approx(plain.parts(text), abs=1e-9)


def test_held_out_documents_are_told_apart(spark):
    docs, labels = corpus()
    docs += [(None, "scoundrel"), (9000, None), (9001, ""), (9002, " \n"), (9003, "bal " * 50_000), (0, docs[0][1])]
    frame = spark.createDataFrame(docs, DOCS).withColumn("score", F.lit("x")).withColumn("toxic", F.lit(9))
    marks = spark.createDataFrame(labels + [(None, 1, 1), (77, None, None), (1, 1, 0)], LABELS).withColumn("text", F.lit("no"))
    model = tox.fitted(frame, marks)
    got = tox.scored(frame, model).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    far = [(r.predicted, r.doc_id % 5 == 0) for r in got if r.held_out and r.doc_id is not None and r.doc_id < 600]
    assert sum(p == y for p, y in far) / len(far) > 0.97
    kept = tox.without_toxic(frame, model)
    assert kept.columns == frame.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(r.doc_id) for r in got if not r.predicted)


def test_forgetting_changes_nothing(spark, monkeypatch):
    docs, labels = corpus(80)
    mark = {d: y for d, _, y in labels}
    frame = spark.createDataFrame([(t, mark[d], True) for d, t in docs if d in mark], "text string, toxic int, fit boolean")
    model = tox._fitted(frame)
    texts = [t for _, t in docs]
    whole = tox.Scorer(model)(texts)[1]
    monkeypatch.setattr(tox, "REMEMBERED", 5)
    few = tox.Scorer(model)
    assert np.concatenate([few(texts[i : i + 3])[1] for i in range(0, len(texts), 3)]) == pytest.approx(whole)


def test_stretches_change_nothing(spark, monkeypatch):
    docs, labels = corpus(80)
    mark = {d: y for d, _, y in labels}
    frame = spark.createDataFrame([(t, mark[d], True) for d, t in docs if d in mark], "text string, toxic int, fit boolean")
    events = lambda: sorted(map(tuple, frame.groupBy("toxic").agg(F.concat_ws(" ", F.collect_list("text")).alias("text")).mapInArrow(
        tox._events, tox.EVENTS).groupBy("parent", "node", "unit").sum("toxic", "ordinary").collect()))
    counted = events()
    model = tox._fitted(frame)
    texts = pa.array([*(t for _, t in docs), None, "", " \n", " ".join(t for _, t in docs), "bal" * 500, "\u00e9 bal. " * 300])
    n, parts = tox.Scorer(model)(texts)
    assert n.tolist() == [len(tox.words_of(t)) for t in texts.to_pylist()]
    monkeypatch.setattr(tox, "STRETCH", 7)
    again = tox.Scorer(model)(texts)
    assert again[0].tolist() == n.tolist() and again[1] == pytest.approx(parts)
    assert [w for ws, _ in tox._stretches(b"bal, knave\xc3\xa9 x" * 9) for w in ws] == tox.WORD.findall(b"bal, knave\xc3\xa9 x" * 9)
    monkeypatch.setattr(tox, "COUNTED", 3)
    assert events() == counted


@pytest.mark.parametrize("labels, score", [([], None), ([(1, 1, 0)], 0.0), ([(1, 1, 1)], 1.0)])
def test_one_class_or_none(spark, labels, score):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], DOCS)
    model = tox.fitted(docs, spark.createDataFrame(labels, LABELS))
    got = [r.score for r in tox.scored(docs, model).collect()]
    assert len(got) == 2 and (score is None or got == pytest.approx([score] * 2, abs=1e-6))


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    model = tox.fitted(empty, spark.createDataFrame([(1, 1, 0), (2, 1, 1)], LABELS))
    assert tox.scored(empty, model).collect() == []
    assert tox.without_toxic(empty, model).collect() == []


def of_class(docs, toxic):
    labels = [(i, 1, int(i in toxic)) for i, _ in docs if i is not None and zlib.crc32(str(i).encode()) % 5]
    return docs, [*dict.fromkeys(labels)]


def outside(n, start):
    """``n`` ids outside the held-out fold."""
    ids = (i for i in range(start, start + 10 * n) if zlib.crc32(str(i).encode()) % 5)
    return [next(ids) for _ in range(n)]


def drawn(spark, docs, labels):
    rows = tox._sample(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    return {(r.text, r.toxic) for r in rows}, rows


def test_a_text_above_the_word_budget_shuts_out_no_other(spark, monkeypatch):
    monkeypatch.setattr(tox, "TRAIN_WORDS", 100)
    ids = outside(21, 0)
    for long in ids[:3]:
        docs = [(i, "bad " * 101 if i == long else f"fine {i}") for i in ids] + [(i, f"mild {i}") for i in outside(9, 1000)]
        got, _ = drawn(spark, *of_class(docs, set(ids)))
        assert got == {(t, int(i in ids)) for i, t in docs if i != long}
    # One that only what is left has no room for is passed over as well.
    docs = [(i, "w " * 60 + str(i) if k < 3 else f"s {i}") for k, i in enumerate(ids)] + [(5000, "mild")]
    got, _ = drawn(spark, *of_class(docs, set(ids)))
    toxic = [t for t, y in got if y]
    assert sum(t.startswith("w") for t in toxic) <= 1 and sum(t.startswith("s") for t in toxic) == 18


def test_a_class_of_nothing_but_long_texts_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(tox, "TRAIN_WORDS", 100)
    ids = outside(3, 0)
    docs = [(i, f"bad{i} " * 101) for i in ids] + [(i, f"mild {i}") for i in outside(9, 1000)]
    docs, labels = of_class(docs, set(ids))
    with pytest.raises(ValueError, match="toxic = \\[1\\]"):
        tox.fitted(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))


def test_copies_take_no_places(spark, monkeypatch):
    monkeypatch.setattr(tox, "TRAIN_DOCS", 12)
    ids = outside(62, 0)
    docs = [(i, "copied" if k < 50 else f"bad {i}") for k, i in enumerate(ids)]
    docs += [(ids[51], "of a repeated id"), (ids[51], "of a repeated id"), (ids[0], "copied")]
    docs = [d for d in docs if d[1] != f"bad {ids[61]}"] + [(i, f"mild {i}") for i in outside(9, 1000)]
    got, rows = drawn(spark, *of_class(docs, set(ids)))
    want = {(t, int(i in ids)) for i, t in docs}
    assert len(rows) == len(got) and got <= want
    assert sum(y for _, y in got) == min(12, sum(y for _, y in want)) and len(got) - sum(y for _, y in got) == 9
    monkeypatch.setattr(tox, "TRAIN_DOCS", 100)
    assert drawn(spark, *of_class(docs, set(ids)))[0] == want


def test_a_class_of_copies_still_fits(spark):
    ids, plain = outside(30, 0), outside(90, 1000)
    docs = [(i, "scoundrel knave scoundrel") for i in ids] + [(i, f"mild weather {i % 7} again {i}") for i in plain]
    docs, labels = of_class(docs, set(ids))
    frame, marks = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    got = tox.scored(frame, tox.fitted(frame, marks)).collect()
    assert all(r.predicted == int(r.doc_id in ids) for r in got)


def test_few_keeps_numbers_as_they_are():
    rng = np.random.default_rng(5)
    for n in (0, 1, 300, 70_000):
        numbers = np.log(rng.integers(1, 1 + n, n) / 7)
        few = tox.Few(numbers)
        at = rng.permutation(n)
        assert few[at].tolist() == numbers[at].tolist()
