"""Toxicity of texts by class-conditional Kneser-Ney models.

Two models, one of toxic and one of ordinary texts, give every word a probability; a text's score
compares their log-likelihoods per word. A model spells a word in chunks: each chunk, the word's
end included, is conditioned on all of the word before it. Counts are of documents, so that a line
repeated in one text weighs no more than once.

Discounting is absolute, by one: an expression seen once in a class leaves its mass to the backoff
wholly. The backoff of both classes is the same: the counts of both together, which back off to
the continuation counts of the chunk (how many beginnings it continues). It also gets the weight
of STRENGTH further counts, so that a history that was rarely seen says little. A word that is rare,
or new but begins like others, is so judged by its longest beginning that was seen.

Most words favour one class a little, by chance or by topic; an abusive one does strongly. So a
text's log-likelihood ratio, the sum of its words', is kept in three parts (within MILD of zero,
beyond it above, beyond it below), each divided by the number of words. A logistic function of the
three (the strong ones by their roots), fitted on documents the models have not seen, is the score;
its offset puts one half where the fit tells these documents apart best, by F1.

Counts come from a bounded sample of labelled documents and are summed by Spark. What was seen
only once in either class has no part of its own and is not kept.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rentrank.llm.store import saved, table

FOLDS = 5
#: The models are fitted on at most so many distinct labelled texts, and so many words, of each
#: class: those whose hash is smallest. Everything else is over all rows.
TRAIN_DOCS = 7_000
TRAIN_WORDS = 4_000_000
#: Of the sample, documents with this remainder of their hash fit the calibration instead.
CALIBRATION = 3
#: Weight of the backoff beyond the discounts, in counts.
STRENGTH = 50.0
#: Log-likelihood ratios of a word up to which they are mild.
MILD = 2.0
#: Bytes after which a word is cut into chunks.
CHUNKS = (3, 5, 7, 9)
#: How strongly the logistic fit is pulled towards slope 0.
PULL = 0.05
#: Words whose ratios a worker remembers before it begins anew.
REMEMBERED = 300_000
#: Bytes of text that are taken out of a batch and scored together; a longer text is cut between words.
STRETCH = 1 << 19
#: Distinct words of texts that are counted together.
COUNTED = 50_000

ROOT = 0
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
GAP = re.compile(rb"[^0-9a-z\x80-\xff]")
EVENTS = "parent long, node long, unit long, toxic long, ordinary long"


def words_of(text: str | None) -> list[bytes]:
    """Runs of digits, letters and characters beyond ASCII, A-Z as a-z."""
    return WORD.findall((text or "").encode().lower())


def _hash(value: bytes) -> int:
    return xxhash.xxh64_intdigest(value)


def chain(word: bytes) -> list[tuple[bytes, bytes]]:
    """(the word so far with the chunk, the chunk) for each chunk; the last says that it ends."""
    cuts = [0, *(c for c in CHUNKS if c < len(word))]
    steps = [(word[:b], word[a:b]) for a, b in zip(cuts, cuts[1:])]
    return [*steps, (word + b"\n", word[cuts[-1] :] + b"\n")]


def _signed(values) -> pa.Array:
    return pa.array(np.asarray(values, np.uint64).view(np.int64))


def held_out(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, a multiple of ``folds``. Rows without id are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(True))


def _events(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents of either class have a chunk after a beginning, some texts at a time."""
    for batch in batches:
        words: tuple[Counter, Counter] = (Counter(), Counter())
        for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist()):
            words[toxic].update(set(words_of(text.as_py())))
            if len(words[0]) + len(words[1]) >= COUNTED:
                yield from _counted(words)
                words = (Counter(), Counter())
        yield from _counted(words)


def _counted(words: tuple[Counter, Counter]) -> Iterator[pa.RecordBatch]:
    """The chunks of the words of ordinary and toxic texts, COUNTED words at a time."""
    pairs = [(word, toxic, n) for toxic in (0, 1) for word, n in words[toxic].items()]
    for i in range(0, len(pairs), COUNTED):
        rows: dict[tuple[int, int, int], list[int]] = {}
        for word, toxic, n in pairs[i : i + COUNTED]:
            parent = ROOT
            for sofar, chunk in chain(word):
                node = _hash(sofar)
                rows.setdefault((parent, node, _hash(chunk)), [0, 0])[toxic] += n
                parent = node
        keys = list(rows)
        yield pa.RecordBatch.from_arrays(
            [*(_signed([k[j] for k in keys]) for j in range(3)),
             pa.array([rows[k][1] for k in keys], pa.int64()), pa.array([rows[k][0] for k in keys], pa.int64())],
            ["parent", "node", "unit", "toxic", "ordinary"],
        )


class Few:
    """Numbers, many of them alike: each is kept once, and a short code of it per place."""

    def __init__(self, numbers: np.ndarray):
        self.values, codes = np.unique(numbers, return_inverse=True)
        self.codes = codes.astype(np.min_scalar_type(len(self.values)))

    def __getitem__(self, places: np.ndarray) -> np.ndarray:
        return self.values[self.codes[places]]


@dataclass
class Model:
    """Sorted hashes of beginnings, and what belongs to each; logarithms to base e.

    Ratios and weights come from small counts, so few of them differ.
    """

    nodes: np.ndarray
    node_ratio: Few  # log P(chunk | beginning) of toxic less that of ordinary
    node_weight: Few  # the same of the backoff weights for what follows
    root_weight: float
    #: The score is the logistic function of slopes @ features + offset.
    slopes: np.ndarray
    offset: float


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, toxic, fit, calibrate: the bounded sample of labelled texts outside the held-out fold.

    Copies count once, whatever their ids, before anything is drawn. A text beyond the whole word
    budget is not drawn, one beyond what is left of it is passed over: others keep their places.
    """
    marked = labels.filter(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"), FOLDS))
    marked = marked.groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    text = F.coalesce("text", F.lit(""))
    rank = F.xxhash64(text, F.lit("toxicity")).alias("rank")
    size = F.size(F.split(text, "\\s+"))
    # So many words have a blank each but one: of most texts, the length says enough.
    over = F.when(F.length(text) >= 2 * TRAIN_WORDS, size > TRAIN_WORDS).otherwise(False).alias("over")
    hashed = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", rank, over).distinct()
    distinct = hashed.join(marked, F.col("doc_id") == F.col("_id")).select("rank", "over", "toxic").distinct()
    distinct = saved(distinct, "labelled-texts")
    there = {r["toxic"] for r in distinct.select("toxic").distinct().collect()}
    small = distinct.filter("NOT over")
    first = [small.filter(F.col("toxic") == y).orderBy("rank").limit(TRAIN_DOCS) for y in (0, 1)]
    chosen = saved(first[0].unionByName(first[1]).select(F.col("rank").alias("_rank"), "toxic"), "sample-ranks")
    texts = docs.select(text.alias("text"), rank).join(F.broadcast(chosen), F.col("rank") == F.col("_rank"))
    texts = saved(texts.dropDuplicates(["rank", "toxic"]).select("text", "rank", "toxic", size.alias("size")), "sample")
    # At most 2 * TRAIN_DOCS rows of three numbers.
    sizes = sorted(tuple(r) for r in texts.select("toxic", "rank", "size").collect())
    taken = [row for y in (0, 1) for row in _within_budget([(r, n) for t, r, n in sizes if t == y], y)]
    if lost := there - {t for t, *_ in taken}:
        raise ValueError(f"all labelled texts with toxic = {sorted(lost)} have more than {TRAIN_WORDS} words")
    parts = docs.sparkSession.createDataFrame(taken, "_toxic int, _rank long, fit boolean, calibrate boolean")
    same = (F.col("rank") == F.col("_rank")) & (F.col("toxic") == F.col("_toxic"))
    return texts.join(F.broadcast(parts), same).select("text", "toxic", "fit", "calibrate")


def _within_budget(sizes: list[tuple[int, int]], toxic: int) -> list[tuple[int, int, bool, bool]]:
    """(toxic, rank, fit, calibrate) of a class's texts, given as (rank, words), as long as words last."""
    left, ranks = TRAIN_WORDS, []
    for rank, n in sizes:
        if n <= left:
            left -= n
            ranks.append(rank)
    fit = [r % CALIBRATION > 0 for r in ranks]
    # A class with too few texts for two parts has its first one in both.
    fits = [f or (i == 0 and not any(fit)) for i, f in enumerate(fit)]
    calibrates = [not f or (i == 0 and all(fit)) for i, f in enumerate(fit)]
    return list(zip([toxic] * len(ranks), ranks, fits, calibrates))


def _fitted(sample: DataFrame) -> Model:
    """The models of the sample's ``fit`` rows. Their size is bounded by the sample's."""
    events = sample.filter("fit").select("text", "toxic").mapInArrow(_events, EVENTS)
    summed = events.groupBy("parent", "node", "unit").agg(F.sum("toxic").alias("t"), F.sum("ordinary").alias("o"))
    events = saved(summed, "events")
    contexts = events.groupBy("parent").agg(
        F.sum("t").alias("ht"), F.sum("o").alias("ho"), F.count_if(F.col("t") > 0).alias("nt"),
        F.count_if(F.col("o") > 0).alias("no"), F.count(F.lit(1)).alias("n"),
    )
    contexts = saved(contexts, "contexts")
    beginnings = events.groupBy("unit").agg(F.count(F.lit(1)).alias("before"))
    total = max(1, events.count())

    def own(c: str, h: str) -> Column:
        return F.greatest(F.col(c) - 1, F.lit(0)) / (F.col(h) + STRENGTH)

    def weight(n: str, h: str) -> Column:
        return (F.col(n) + STRENGTH) / (F.col(h) + STRENGTH)

    both = F.col("ht") + F.col("ho") + STRENGTH
    shared = (F.col("t") + F.col("o") - 1) / both + (F.col("n") + STRENGTH) / both * F.col("before") / total
    seen = events.filter(F.greatest("t", "o") > 1).join(contexts, "parent").join(beginnings, "unit")
    toxic = own("t", "ht") + weight("nt", "ht") * shared
    ordinary = own("o", "ho") + weight("no", "ho") * shared
    # What both classes leave to the backoff is the same distribution: only its weights differ.
    after = contexts.select(F.col("parent").alias("node"), F.log(weight("nt", "ht") / weight("no", "ho")).alias("w"))
    kept = seen.select("node", F.log(toxic / ordinary).alias("r")).join(after, "node", "left")
    got = kept.select("node", "r", F.coalesce("w", F.lit(0.0)).alias("w")).toArrow()
    nodes = got.column("node").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(nodes)
    ratio, weights = (got.column(c).to_numpy().astype(float)[order] for c in ("r", "w"))
    root = after.filter(F.col("node") == ROOT).first()
    return Model(nodes[order], Few(ratio), Few(weights), root["w"] if root else 0.0, np.ones(3), 0.0)


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, whether it is there) of each of ``wanted`` among the sorted ``keys``."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class Scorer:
    """Log-likelihood ratios of texts; remembers those of words."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[bytes, float] = {}

    def _learn(self, words: list[bytes]) -> None:
        m = self.model
        ratio, weight = np.zeros(len(words)), np.full(len(words), m.root_weight)
        alive = np.ones(len(words), bool)
        chains = [[_hash(sofar) for sofar, _ in chain(w)] for w in words]
        for level in range(len(CHUNKS) + 1):
            alive &= np.array([len(c) > level for c in chains])
            at, there = _found(m.nodes, np.array([c[level] if len(c) > level else 0 for c in chains], np.uint64))
            lost, there = alive & ~there, alive & there
            ratio[there] += m.node_ratio[at[there]]
            # The first chunk that is not known comes from the backoff, and all after it as well.
            ratio[lost] += weight[lost]
            weight[there] = m.node_weight[at[there]]
            alive = there
        self.known.update(zip(words, ratio.tolist()))

    def _add(self, pieces: list[tuple[int, list[bytes]]], n: np.ndarray, parts: np.ndarray) -> None:
        """Add the words of ``pieces``, each with its text's number, to the texts' sums."""
        new = [w for w in set().union(*(words for _, words in pieces)) if w not in self.known]
        if len(new) + len(self.known) > REMEMBERED:
            self.known.clear()
            new = list(set().union(*(words for _, words in pieces)))
        if new:
            self._learn(new)
        for i, words in pieces:
            ratio = np.fromiter(map(self.known.__getitem__, words), float, len(words))
            mild = np.clip(ratio, -MILD, MILD)
            beyond = ratio - mild
            n[i] += len(words)
            parts[i] += mild.sum(), beyond[beyond > 0].sum(), beyond[beyond < 0].sum()

    def __call__(self, texts: list[str | None] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(words, parts of the log-likelihood ratio: mild, above, below) of each text.

        Of an Arrow array only one text at a time is taken out.
        """
        n, parts = np.zeros(len(texts), np.int64), np.zeros((len(texts), 3))
        pieces: list[tuple[int, list[bytes]]] = []
        held = 0
        for i, text in enumerate(texts):
            text = text.as_py() if isinstance(text, pa.Scalar) else text
            for words, length in _stretches((text or "").encode().lower()):
                if held and held + length > STRETCH:
                    self._add(pieces, n, parts)
                    pieces, held = [], 0
                pieces.append((i, words))
                held += length
        self._add(pieces, n, parts)
        return n, parts

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Between 0 and 1; a text without words gets the calibration's offset alone."""
        z = features(*self(texts)) @ self.model.slopes + self.model.offset
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _stretches(data: bytes) -> Iterator[tuple[list[bytes], int]]:
    """(words, bytes) of stretches of ``data`` of about STRETCH bytes, cut between words."""
    start = 0
    while start < len(data):
        gap = GAP.search(data, start + STRETCH) if len(data) - start > STRETCH else None
        end = gap.end() if gap else len(data)
        yield WORD.findall(data, start, end), end - start
        start = end


def features(n: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """The parts per word, the strong ones by their roots: a text is no worse for its worst words."""
    per_word = parts / np.maximum(n, 1)[:, None]
    per_word[:, 1:] = np.sign(per_word[:, 1:]) * np.sqrt(np.abs(per_word[:, 1:]))
    return per_word


def _best_cut(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """Where the texts of label 1 are told apart best, by F1: halfway between two of ``z``."""
    order = np.argsort(-z, kind="stable")
    z, hit = z[order], (weight * y)[order]
    found = np.cumsum(hit)
    f1 = 2 * found / (np.cumsum(weight[order]) + hit.sum())
    f1[:-1][z[:-1] == z[1:]] = -1  # equal ones stay together
    i = int(np.argmax(f1))
    return float((z[i] + z[i + 1]) / 2) if i + 1 < len(z) else float(z[i] - 1)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Slopes and offset of a logistic fit with a slight pull towards slope 0, by Newton steps."""
    scale = np.std(x, axis=0)
    scale[scale == 0] = 1.0
    features = np.column_stack([x / scale, np.ones(len(x))])
    beta, pull = np.zeros(features.shape[1]), np.diag([PULL] * x.shape[1] + [1e-6])
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(features @ beta, -30, 30)))
        gradient = features.T @ (weight * (p - y)) + pull @ beta
        curve = (features * (weight * p * (1 - p))[:, None]).T @ features + pull
        step = np.linalg.solve(curve, gradient)
        step /= max(1.0, float(np.abs(step).max()))
        beta -= step
        if np.abs(step).max() < 1e-9:
            break
    return beta[:-1] / scale, float(beta[-1])


def fitted(docs: DataFrame, labels: DataFrame) -> Model:
    """Models and calibration from the labelled rows of ``docs`` outside the held-out fold.

    Without labelled texts of both classes the score is the toxic share of the labels everywhere.
    """
    sample = saved(_sample(docs, labels), "fit")
    classes = {r["toxic"] for r in sample.select("toxic").distinct().collect()}
    marked = labels.filter(~held_out(F.col("doc_id"), FOLDS)).groupBy("toxic").count().collect()
    share = {r["toxic"]: r["count"] for r in marked}
    toxic, ordinary = share.get(1, 0), share.get(0, 0)
    if classes != {0, 1}:
        none = np.empty(0)
        odds = float(np.log((toxic + 1e-9) / (ordinary + 1e-9)))
        return Model(none.astype(np.uint64), Few(none), Few(none), 0.0, np.zeros(3), odds)
    model = _fitted(sample)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            columns = [batch.column("toxic"), *(pa.array(x) for x in features(*scorer(batch.column("text"))).T)]
            yield pa.RecordBatch.from_arrays(columns, ["toxic", "mild", "above", "below"])

    # At most 2 * TRAIN_DOCS rows of four numbers.
    kinds = "toxic int, mild double, above double, below double"
    rest = sample.filter("calibrate").select("text", "toxic").mapInArrow(run, kinds).toArrow()
    # The executors get the model once more, with its slopes: they need not keep both.
    shared.unpersist()
    y = rest.column("toxic").to_numpy().astype(float)
    x = np.stack([rest.column(c).to_numpy() for c in ("mild", "above", "below")], axis=1)
    # As often as in all labels, not as in the sample.
    weight = np.where(y == 1, toxic / (y == 1).sum(), ordinary / (y == 0).sum())
    weight *= len(y) / weight.sum()
    model.slopes, _ = _logistic(x, y, weight)
    model.offset = -_best_cut(x @ model.slopes, y, weight)
    return model


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every row. NULL text counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            score = scorer.scores(batch.column("text"))
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    chosen = docs.select("doc_id", held_out(F.col("doc_id"), FOLDS).alias("held_out"), "text")
    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that score below one half, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            score = scorer.scores(batch.column("text"))
            yield batch.filter(pa.array(score < 0.5))

    return docs.mapInArrow(run, docs.schema)


def op1_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from the labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    return scored(docs, fitted(docs, table(spark, sf_dir, "labels")))
