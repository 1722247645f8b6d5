"""Log-probabilities of texts by a log-bilinear neural model over word classes.

A word's class is the word itself if it is among the most frequent ones, else a class of its last
bytes; the end of a text is a class too. The neural part predicts the class of a token from those
of the two before it: two projected class vectors add up to a context vector, whose product with
the vectors of all classes (plus a bias) is the score of each. It is trained by noise-contrastive
estimation on the counts of all class triples of the training texts, a table of at most
CLASSES ** 3 numbers however large the corpus. As there are only CLASSES ** 2 contexts, one batched
matrix product gives the normalised log-probabilities of every class in every context.

Within a class of rare words a second log-bilinear model, of words, tells them apart. The OWN most
frequent words have their own vectors, the others of a class share theirs, so the model has a bound
and a normalised token a bounded price, whatever the corpus. The two words before the token add up to the context. It is trained
by noise-contrastive estimation on all training tokens of these classes, in mini-batches inside
Spark's tasks, whose parameters are averaged after each pass. Scores are normalised over the class.
It starts as the unigram model: a word's share of the class's tokens in all training texts, smoothed
by 0.1 per word and 0.1 for words not seen. By this share the words without vectors of their own
divide what the class's shared vector gets.

Words are counted where they lie and the counts added up. The counts of the COUNTED most frequent
ones go to all tasks; only tokens of other words, none of them frequent, are dealt out by word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentrank.llm.buffers import Hasher, mixed, stretches, utf8
from rentrank.llm.store import partitions, saved, table, text_hash
from rentrank.llm.text import UPPER
from rentrank.llm.toxicity import held_out

FOLDS = 10
#: Classes: the end of a text (0), frequent words, endings of the others.
FREQUENT = 63
ENDINGS = 32
CLASSES = 1 + FREQUENT + ENDINGS
ENDING_BYTES = 2
ADDED = 0.1
#: Words whose counts all tasks know, at most (12 MB); steps of the search for their least count.
COUNTED, PER_DOUBLING = 1 << 20, 4
#: The neural model.
WIDTH, BATCH, NOISE, STEPS, RATE = 32, 1024, 64, 3_000, 0.02
#: Draws from the triple table, which holds all tokens, follow their number up to so many per cell.
DRAWS = 10
#: The model of words: words with vectors of their own (at most; 97 numbers each), passes, tokens and
#: noise words of a step, its rate, rows sent together.
OWN, PASSES, WORD_BATCH, WORD_NOISE, WORD_RATE, BLOCK = 1 << 13, 1, 4096, 24, 0.05, 32
#: Bytes of text that a task reads at once.
STRETCH = 1 << 20

CODES = "doc_id {id}, text_hash long, held_out boolean, codes binary, units binary, logs double, known long, tail binary"
OUT = (
    "doc_id {id}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)

_BLANK = np.zeros(256, bool)
_BLANK[[*range(9, 14), 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[list(UPPER.encode())] += 32


def _ending_classes(ending: np.ndarray) -> np.ndarray:
    return (mixed(ending.astype(np.uint64) + np.uint64(1)) % np.uint64(ENDINGS)).astype(np.int64)


def _ending_class(ending: bytes) -> int:
    return int(_ending_classes(np.array([int.from_bytes(ending[-ENDING_BYTES:], "big")]))[0])


def _tokens_of(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(hash, class of the ending, row) of the words of stretches of a text column."""
    raw, offsets = utf8(column)
    for start, end in stretches(offsets, STRETCH, np.flatnonzero(_BLANK[raw])):
        data = _LOWER[raw[start:end]]
        inside = ~_BLANK[data]
        edges = offsets[(offsets >= start) & (offsets < end)] - start
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        first[edges] |= inside[edges]
        before = edges[edges > 0] - 1
        last[before] |= inside[before]
        begin, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
        final = data[stop - 1].astype(np.int64)
        ending = np.where(stop - begin > 1, data[np.maximum(stop - 2, 0)].astype(np.int64) << 8, 0) + final
        row = np.searchsorted(offsets, begin + start, "right") - 1
        yield Hasher(data).of(begin, stop).view(np.int64), _ending_classes(ending), row


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for word, kind, _ in _tokens_of(batch.column("text")):
            found, at, n = np.unique(word, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(kind[at].astype(np.int32)), pa.array(n)], ["word", "kind", "c"])


def word_counts(train: DataFrame) -> DataFrame:
    """word (64-bit hash), kind (class of its ending), c: all words of the training texts; written."""
    counted = train.select("text").mapInArrow(_counter, "word long, kind int, c long")
    return saved(counted.groupBy("word").agg(F.min("kind").alias("kind"), F.sum("c").alias("c")), "words")


def most_frequent(counts: DataFrame, most: int = 0) -> pa.Table:
    """The words from a least count on that leaves no more than ``most`` (COUNTED) of them.

    Counts are looked at in steps of a quarter of a doubling; a few hundred numbers reach the driver.
    """
    step = F.floor(F.log2("c") * PER_DOUBLING).cast("int").alias("step")
    sizes = counts.groupBy(step).count().orderBy(F.desc("step")).collect()
    total, least = 0, None
    for r in sizes:
        total += r["count"]
        if total > (most or COUNTED):
            break
        least = r["step"]
    if least is None:
        return counts.limit(0).toArrow()
    return counts.filter(F.floor(F.log2("c") * PER_DOUBLING) >= least).toArrow()


@dataclass
class Vocabulary:
    """What all tasks know of words: the classes of frequent ones, the units and the counts.

    Units are the frequent words and the end (their classes), then of each other class its shared
    one and its words.
    """

    words: np.ndarray  # sorted hashes
    counts: np.ndarray  # training tokens
    codes: np.ndarray  # class: 1 to FREQUENT, or that of the ending
    units: np.ndarray
    first: np.ndarray  # the shared unit of each class; one entry more, the number of units
    unit_counts: np.ndarray  # training tokens by unit, of the words alone

    @staticmethod
    def of(words: np.ndarray, kinds: np.ndarray, counts: np.ndarray) -> Vocabulary:
        order = np.argsort(words)
        words, kinds, counts = (np.asarray(x, np.int64)[order] for x in (words, kinds, counts))
        rank = np.empty(len(words), np.int64)
        rank[np.lexsort([words, -counts])] = np.arange(len(words))
        codes = np.where(rank < FREQUENT, 1 + rank, 1 + FREQUENT + kinds)
        own = (rank >= FREQUENT) & (rank < FREQUENT + OWN)
        sizes = np.bincount(kinds[own], minlength=ENDINGS)
        first = 1 + FREQUENT + np.r_[0, np.cumsum(1 + sizes)]
        units = np.where(rank < FREQUENT, codes, first[kinds])
        place = np.flatnonzero(own)
        place = place[np.argsort(kinds[place], kind="stable")]
        units[place] = first[kinds[place]] + 1 + np.arange(len(place)) - (np.cumsum(sizes) - sizes)[kinds[place]]
        known = np.zeros(first[-1])
        known[units[place]] = counts[place]
        return Vocabulary(words, counts, codes, units, first, known)


def coded(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, text_hash, held_out, and what is known of each text before its tail is counted.

    ``codes``: the class of each token, the end included, a byte each. ``units``: of each token of a
    class of rare words, two bytes each. ``logs``, ``known``: over the counted ones of the latter,
    the sum of log10(c + 0.1) and the number with c > 0. ``tail``: the hashes of the others.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        logs_of = np.log10(own.counts + ADDED)

        def parts(word, kind):
            """(class, unit, log10(c + 0.1), is it counted) of tokens."""
            found, at, back = np.unique(word, return_index=True, return_inverse=True)
            place = np.searchsorted(own.words, found).clip(max=max(len(own.words) - 1, 0))
            met = own.words[place] == found if len(own.words) else np.zeros(len(found), bool)
            rest = kind[at]
            code, unit, logs = 1 + FREQUENT + rest, own.first[rest], np.zeros(len(found))
            code[met], unit[met], logs[met] = own.codes[place[met]], own.units[place[met]], logs_of[place[met]]
            return code.astype(np.uint8)[back], unit.astype("<u2")[back], logs[back], met[back]

        for batch in batches:
            n = len(batch)
            found = [(word, row, *parts(word, kind)) for word, kind, row in _tokens_of(batch.column("text"))]
            empty = [np.empty(0, k) for k in (np.int64, np.int64, np.uint8, "<u2", float, bool)]
            word, row, code, unit, logs, met = (np.concatenate(x) for x in zip(empty, *found))
            every = np.zeros(len(code) + n, np.uint8)
            every[np.arange(len(code)) + row] = code
            rare = code > FREQUENT
            tail = rare & ~met

            def lists(of: np.ndarray, mark: np.ndarray, more: int = 0) -> pa.Array:
                ends = np.cumsum(np.bincount(row[mark], minlength=n) + more) * of.itemsize
                return pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(np.r_[0, ends].astype(np.int64)), pa.py_buffer(of)]).cast(pa.binary())

            columns = [batch.column(c) for c in ("doc_id", "text_hash", "held_out")]
            columns += [lists(every, np.ones(len(code), bool), 1), lists(unit[rare], rare)]
            columns += [pa.array(np.bincount(row[rare], logs[rare], n).astype(float)), pa.array(np.bincount(row[rare & met], minlength=n)), lists(word[tail], tail)]
            names = ["doc_id", "text_hash", "held_out", "codes", "units", "logs", "known", "tail"]
            yield pa.RecordBatch.from_arrays(columns, names)

    chosen = docs.select("doc_id", text_hash().alias("text_hash"), held_out(F.col("doc_id"), FOLDS).alias("held_out"), "text")
    return chosen.mapInArrow(run, CODES.format(id=chosen.schema["doc_id"].dataType.simpleString()))


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, text_hash, word, times: the tail of each text, each word once."""
    for batch in batches:
        tails = [np.frombuffer(t, np.int64) for t in batch.column("tail").to_pylist()]
        row = np.repeat(np.arange(len(tails)), [len(t) for t in tails])
        word = np.concatenate([np.empty(0, np.int64), *tails])
        order = np.lexsort([word, row])
        row, word = row[order], word[order]
        new = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (word[1:] != word[:-1])][: len(row)])
        times = np.diff(np.r_[new, len(row)])
        ids, hashes = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "text_hash"))
        columns = [ids[row[new]], hashes[row[new]], word[new], times]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["id", "text_hash", "word", "times"])


def tail_sums(codes: DataFrame, counts: DataFrame) -> DataFrame:
    """_id, _hash, tail_logs, tail_known, tail_tokens: sums over the tails of the rows alike in id and text.

    None of these words is among the most frequent, so none holds more of the tokens than a share of
    one in COUNTED.
    """
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id")
    words = codes.filter(F.length("tail") > 0).select(key, "text_hash", "tail").mapInArrow(_spread, "id long, text_hash long, word long, times long")
    c = F.coalesce("c", F.lit(0))
    sums = words.join(counts.select("word", "c"), "word", "left").groupBy(F.col("id").alias("_id"), F.col("text_hash").alias("_hash"))
    return sums.agg(
        F.sum(F.col("times") * F.log10(c + ADDED)).alias("tail_logs"),
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("tail_known"), F.sum("times").alias("tail_tokens"),
    )


def _units(codes: list[bytes], units: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, unit, unit before, unit before that) of the tokens of rare classes of some texts."""
    code = np.frombuffer(b"".join(codes), np.uint8).astype(np.int64)
    sizes = np.fromiter(map(len, codes), np.int64, len(codes))
    start = np.cumsum(sizes) - sizes
    place = np.flatnonzero(code > FREQUENT)
    code[place] = np.frombuffer(b"".join(units), "<u2")
    one = np.r_[0, code[:-1]]
    one[start] = 0
    two = np.r_[0, one[:-1]]
    two[start] = 0
    return place, code[place], one[place], two[place]


class WordModel:
    """P(unit | its class, the two units before), log-bilinear: each unit has a vector as the word before,
    one as the word before that, one as the predicted word, and a bias."""

    def __init__(self, vocabulary: Vocabulary, tokens: np.ndarray, types: np.ndarray):
        """``tokens`` and ``types`` by class of the other model; the vectors start as the unigram model."""
        first, rng = vocabulary.first, np.random.default_rng(1)
        n = int(first[-1])
        self.first = first
        self.one, self.two = (rng.normal(0, 0.1, (n, WIDTH)).astype(np.float32) for _ in range(2))
        self.out = np.zeros((n, WIDTH), np.float32)
        #: Rest of each class: log10 of what its words' counts are divided by. Words: log10(count + 0.1).
        self.rest = np.zeros(ENDINGS)
        self.own = np.log10(vocabulary.unit_counts + ADDED)
        share = vocabulary.unit_counts + ADDED
        for c in range(ENDINGS):
            words = slice(first[c] + 1, first[c + 1])
            n_rest = tokens[1 + FREQUENT + c] - vocabulary.unit_counts[words].sum()
            share[first[c]] = n_rest + ADDED * (types[1 + FREQUENT + c] - (first[c + 1] - first[c] - 1) + 1)
            self.rest[c] = np.log10(share[first[c]])
            share[first[c] : first[c + 1]] /= share[first[c] : first[c + 1]].sum()
        self.bias = np.log(share).astype(np.float32)
        self.noise = share  # of each class by itself

    def flat(self) -> np.ndarray:
        return np.column_stack([self.one, self.two, self.out, self.bias])

    def load(self, flat: np.ndarray) -> None:
        self.one, self.two, self.out = (np.ascontiguousarray(flat[:, i * WIDTH : (i + 1) * WIDTH]) for i in range(3))
        self.bias = np.ascontiguousarray(flat[:, -1])

    def by_class(self, unit: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(first unit, first of the next class, places) of the classes among ``unit`` with words of their own."""
        kind = np.searchsorted(self.first, unit, "right") - 1
        order = np.argsort(kind, kind="stable")
        ends = np.searchsorted(kind[order], np.arange(ENDINGS + 1))
        for c in range(ENDINGS):
            if ends[c] < ends[c + 1] and self.first[c + 1] - self.first[c] > 1:
                yield int(self.first[c]), int(self.first[c + 1]), order[ends[c] : ends[c + 1]]

    def log_shares(self, unit: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """log10 P(unit | class, context), normalised over the class."""
        out = np.zeros(len(unit))
        for a, b, every in self.by_class(unit):
            rows = max(1, (1 << 20) // (b - a))
            for i in range(0, len(every), rows):
                some = every[i : i + rows]
                z = (self.one[one[some]] + self.two[two[some]]) @ self.out[a:b].T + self.bias[a:b]
                z -= z.max(axis=1, keepdims=True)
                got = z[np.arange(len(some)), unit[some] - a].astype(float)
                out[some] = (got - np.log(np.exp(z).sum(axis=1, dtype=float))) / np.log(10)
        return out

    def learn(self, texts: Iterator[tuple[list[bytes], list[bytes]]]) -> tuple[np.ndarray, np.ndarray]:
        """Steps over all tokens; (rows' changes times uses, uses by table) for the average over tasks."""
        before, rng = self.flat(), np.random.default_rng(2)
        uses = np.zeros((len(before), 3), np.float32)
        squares = {k: np.zeros(len(before), np.float32) for k in ("one", "two", "out", "bias")}

        def step(name: str, rows: np.ndarray, slopes: np.ndarray) -> None:
            order = np.argsort(rows, kind="stable")
            at = np.flatnonzero(np.r_[True, np.diff(rows[order]) > 0])
            rows, slopes = rows[order][at], np.add.reduceat(slopes[order], at)
            squares[name][rows] += (slopes**2).mean(axis=1) if slopes.ndim > 1 else slopes**2
            rate = WORD_RATE / np.sqrt(squares[name][rows] + 1e-12)
            getattr(self, name)[rows] -= (rate[:, None] if slopes.ndim > 1 else rate) * slopes

        for codes, units in texts:
            _, unit, one, two = _units(codes, units)
            for i, seen in enumerate((one, two, unit)):
                uses[:, i] += np.bincount(seen, minlength=len(before))
            for a, b, every in self.by_class(unit):
                every = rng.permutation(every)
                reach = np.cumsum(self.noise[a:b])
                chance = np.log(WORD_NOISE * self.noise[a:b]).astype(np.float32)
                for i in range(0, len(every), WORD_BATCH):
                    some = every[i : i + WORD_BATCH]
                    drawn = a + np.searchsorted(reach, rng.random(WORD_NOISE) * reach[-1], "right").clip(max=b - a - 1)
                    word, context = unit[some], self.one[one[some]] + self.two[two[some]]
                    true = np.einsum("ij,ij->i", context, self.out[word]) + self.bias[word] - chance[word - a]
                    false = context @ self.out[drawn].T + self.bias[drawn] - chance[drawn - a]
                    pull = (-1 / (1 + np.exp(true.clip(-60, 60)))).astype(np.float32)
                    push = 1 / (1 + np.exp(-false.clip(-60, 60)))
                    back = pull[:, None] * self.out[word] + push @ self.out[drawn]
                    rows = np.r_[word, drawn]
                    step("out", rows, np.concatenate([pull[:, None] * context, push.T @ context]))
                    step("bias", rows, np.r_[pull, push.sum(axis=0)])
                    step("one", one[some], back)
                    step("two", two[some], back)
        each = np.repeat(uses, [WIDTH, WIDTH, WIDTH], axis=1)
        return (self.flat() - before) * np.column_stack([each, uses[:, 2]]), uses


def learned(codes: DataFrame, model: WordModel) -> WordModel:
    """``model`` after PASSES over all rows of ``codes``, its rows averaged over the tasks by their uses."""
    spark, n = codes.sparkSession, len(model.bias)
    for _ in range(PASSES):
        shared = spark.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = WordModel.__new__(WordModel)
            own.__dict__.update(shared.value.__dict__)
            own.load(shared.value.flat())

            def texts() -> Iterator[tuple[list[bytes], list[bytes]]]:
                for batch in batches:
                    some = [batch.column(c).to_pylist() for c in ("codes", "units")]
                    for i in range(0, len(some[0]), 512):
                        yield some[0][i : i + 512], some[1][i : i + 512]

            change, uses = own.learn(texts())
            whole = np.column_stack([change, uses]).astype(np.float32)
            for i in range(0, n, BLOCK):
                values = pa.array([whole[i : i + BLOCK].tobytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([i // BLOCK], pa.int32()), values], ["block", "rows"])

        def added(table: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(x.as_py(), np.float32).astype(float) for x in table.column("rows"))
            return pa.table({"block": table.column("block")[:1], "rows": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

        kind = "block int, rows binary"
        tasks = codes.select("codes", "units").coalesce(partitions(spark)).mapInArrow(run, kind)
        found = tasks.groupBy("block").applyInArrow(added, kind).toArrow().sort_by("block").column("rows").to_pylist()
        if found:
            whole = np.frombuffer(b"".join(found), np.float32).reshape(n, -1)
            change, uses = whole[:, :-3], np.maximum(whole[:, -3:], 1)
            each = np.column_stack([np.repeat(uses, WIDTH, axis=1), uses[:, 2]])
            model.load(model.flat() + change / each)
    return model


def _tokens(codes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(context, class) of the tokens of some texts; before a text stand two ends."""
    code = np.frombuffer(b"".join(codes), np.uint8).astype(np.int64)
    sizes = np.fromiter(map(len, codes), np.int64, len(codes))
    start = np.cumsum(sizes) - sizes  # every text has its end, so none is empty
    one = np.r_[0, code[:-1]]
    one[start] = 0
    two = np.r_[0, one[:-1]]
    two[start] = 0
    return two * CLASSES + one, code


def triples(codes: DataFrame) -> np.ndarray:
    """Counts (contexts, classes) over the rows of ``codes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CLASSES**3, np.int64)
        for batch in batches:
            texts = batch.column("codes").to_pylist()
            for i in range(0, len(texts), 256):
                context, code = _tokens(texts[i : i + 256])
                np.add.at(counts, context * CLASSES + code, 1)
        cell = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(counts[cell])], ["cell", "n"])

    found = codes.select("codes").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(CLASSES**3, np.int64)
    out[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    return out.reshape(CLASSES**2, CLASSES)


def trained(counts: np.ndarray, seed: int = 1) -> np.ndarray:
    """log10 P(class | context) for all contexts: log-bilinear, by noise-contrastive estimation."""
    rng = np.random.default_rng(seed)
    unigram = counts.sum(axis=0) + 1.0
    noise = unigram / unigram.sum()
    weights = {
        "look": rng.normal(0, 0.1, (CLASSES, WIDTH)), "two": rng.normal(0, 0.1, (WIDTH, WIDTH)) + np.eye(WIDTH),
        "one": rng.normal(0, 0.1, (WIDTH, WIDTH)) + np.eye(WIDTH), "out": rng.normal(0, 0.1, (CLASSES, WIDTH)),
        "bias": np.log(noise),
    }
    cells = np.flatnonzero(counts.ravel())
    if len(cells):
        reach = np.cumsum(counts.ravel()[cells], dtype=float)
        means = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in weights.items()}
        steps = max(STEPS, -(-min(int(counts.sum()), DRAWS * CLASSES**3) // BATCH))
        for step in range(1, steps + 1):
            cell = cells[np.searchsorted(reach, rng.random(BATCH) * reach[-1], "right").clip(max=len(cells) - 1)]
            context, word = np.divmod(cell, CLASSES)
            far, near = np.divmod(context, CLASSES)
            drawn = rng.choice(CLASSES, NOISE, p=noise)
            slopes = _slopes(weights, far, near, word, drawn, np.log(NOISE * noise))
            rate = RATE * (1 - step / (steps + 1)) ** 0.5
            for k, g in slopes.items():
                m, v = means[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                weights[k] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    else:
        weights["out"][:] = 0.0  # nothing to learn from: all classes alike
    # All contexts in one product: (classes, classes, width) @ (width, classes).
    far = weights["look"] @ weights["two"]
    near = weights["look"] @ weights["one"]
    scores = ((far[:, None] + near[None, :]).reshape(-1, WIDTH) @ weights["out"].T) + weights["bias"]
    scores -= scores.max(axis=1, keepdims=True)
    return (scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))) / np.log(10)


def _slopes(w: dict, far, near, word, drawn, chance) -> dict:
    """Gradients of the contrastive loss of a batch, whose tokens share the drawn noise."""
    context = w["look"][far] @ w["two"] + w["look"][near] @ w["one"]
    n = len(word)
    true = (context * w["out"][word]).sum(axis=1) + w["bias"][word] - chance[word]
    false = context @ w["out"][drawn].T + w["bias"][drawn] - chance[drawn]
    pull = np.zeros((n, CLASSES))
    np.add.at(pull.T, drawn, (1 / (1 + np.exp(-false))).T)
    pull[np.arange(n), word] -= 1 / (1 + np.exp(true))
    pull /= n
    back = pull @ w["out"]
    look = np.zeros_like(w["look"])
    np.add.at(look, far, back @ w["two"].T)
    np.add.at(look, near, back @ w["one"].T)
    return {
        "look": look, "two": w["look"][far].T @ back, "one": w["look"][near].T @ back,
        "out": pull.T @ context, "bias": pull.sum(axis=0),
    }


@dataclass
class Model:
    log_class: np.ndarray  # (contexts, classes), log10
    tokens: np.ndarray  # training tokens of each class
    types: np.ndarray  # distinct training words of each class
    words: WordModel

    def constants(self):
        n, v = int(self.tokens.sum()), int(self.types.sum())
        base = np.log10(n + ADDED * (v + 1))
        # Frequent words and the end are classes of their own; the others share theirs.
        rare = np.arange(CLASSES) > FREQUENT
        own = np.where(rare, 0.0, np.log10(self.tokens + ADDED))
        return n, base, own, (self.tokens > 0) & ~rare


def _scorer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        n, base, own, known_class = model.constants()
        words = model.words
        # Of a token beyond its class's share: nothing if the word has vectors, whose count is in the
        # document's sum; otherwise that sum is divided by the rest of the class.
        less = words.own.copy()
        less[words.first[:-1]] = words.rest
        for batch in batches:
            if not len(batch):
                continue
            out = {k: [] for k in ("n_tokens", "n_known", "base_score", "score")}
            names = ("logs", "known", "tail_logs", "tail_known", "tail_tokens", "n_tail")
            logs, known, tail_logs, tail_known, tail_tokens, n_tail = (batch.column(k).to_numpy(zero_copy_only=False) for k in names)
            # Rows alike in id and text have the sums of their tails together.
            alike = np.maximum(1, tail_tokens // np.maximum(1, n_tail))
            logs, known = logs + tail_logs / alike, known + tail_known // alike
            texts, units = (batch.column(k).to_pylist() for k in ("codes", "units"))
            for i in range(0, len(texts), 256):
                part = texts[i : i + 256]
                context, code = _tokens(part)
                place, unit, one, two = _units(part, units[i : i + 256])
                inner = np.zeros(len(code))
                inner[place] = words.log_shares(unit, one, two) - less[unit]
                sizes = np.fromiter(map(len, part), np.int64, len(part))
                start = np.cumsum(sizes) - sizes
                total = lambda x: np.add.reduceat(x, start)
                own_logs, own_known = logs[i : i + 256], known[i : i + 256]
                out["n_tokens"].append(sizes)
                out["n_known"].append(total(known_class[code].astype(np.int64)) + own_known)
                out["base_score"].append(total(own[code]) + own_logs - sizes * base)
                out["score"].append(total(model.log_class[context, code] + inner) + own_logs)
            done = [pa.array(np.concatenate(out[k])) for k in ("n_tokens", "n_known", "base_score", "score")]
            done.insert(2, pa.array(np.full(len(texts), n)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), *done],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return run


def fitted(docs: DataFrame) -> tuple[DataFrame, DataFrame, Vocabulary, Model]:
    """(codes, word counts, vocabulary, model) of ``docs``, learned from nine tenths of them."""
    train = docs.filter(~held_out(F.col("doc_id"), FOLDS))
    words = word_counts(train)
    often = most_frequent(words)
    vocabulary = Vocabulary.of(*(often.column(c).to_numpy() for c in ("word", "kind", "c")))
    codes = saved(coded(docs, vocabulary), "codes")
    counts = triples(codes.filter("NOT held_out"))
    tokens = counts.sum(axis=0)
    types = (tokens > 0).astype(np.int64)
    types[1 + FREQUENT :] = 0
    for r in words.groupBy("kind").count().collect():  # ENDINGS rows
        types[1 + FREQUENT + r["kind"]] = r["count"]
    frequent = vocabulary.codes <= FREQUENT
    kinds = often.column("kind").to_numpy()[np.argsort(often.column("word").to_numpy())]
    types[1 + FREQUENT :] -= np.bincount(kinds[frequent], minlength=ENDINGS)
    model = Model(trained(counts), tokens, types, learned(codes.filter("NOT held_out"), WordModel(vocabulary, tokens, types)))
    return codes, words, vocabulary, model


def scored(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row.

    Rows whose crc32 of the id is no multiple of FOLDS are learned from (rows without id never).
    Tokens are the words between ASCII white space, A-Z as a-z, and the end of the text; NULL text
    is its end alone. Rows alike in id and text get the same scores. Scores are log10.
    """
    codes, words, _, model = fitted(docs)
    sums = tail_sums(codes, words)
    same = (F.coalesce(codes["doc_id"].cast("long"), F.lit(0)) == sums["_id"]) & (codes["text_hash"] == sums["_hash"])
    zero = lambda c, kind: F.coalesce(c, F.lit(0)).cast(kind).alias(c)
    joined = codes.join(sums, same, "left").select(
        "doc_id", "held_out", "codes", "units", "logs", "known", zero("tail_logs", "double"), zero("tail_known", "long"),
        zero("tail_tokens", "long"), (F.length("tail") / 8).cast("long").alias("n_tail"),
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return joined.mapInArrow(_scorer(shared), OUT.format(id=joined.schema["doc_id"].dataType.simpleString()))


def op2_log_bilinear_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probabilities of all documents, learned from nine tenths of them."""
    return scored(table(spark, sf_dir, "documents"))
