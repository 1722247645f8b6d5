"""Packing documents into sequences: combinations of lengths by non-negative least squares.

A document's ids are cut into whole windows, one piece of a multiple of UNIT, and a tail shorter
than UNIT. Shallow combinations of up to DEPTH piece lengths that fill a window exactly are
enumerated; non-negative least squares finds how often to repeat each so that the histogram of the
pieces is used up; the counts are rounded down to what the histogram holds, what they leave is
filled up greedily, and the rest follows, with all tails, end to end in a last run of sequences.
The end of that run is cut into powers of two, which need no padding.

Only the histogram (one count per length) reaches the driver. Each piece knows its rank among those
of its length, and so its sequence and offset, without any piece being moved.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from rentrank.llm.store import saved, table

LENGTH = 4096
UNIT = 128
DEPTH = 4
END_ID = 2
TOKENIZER = "word_bpe_49k.json"
#: Words whose ids a worker remembers, before it begins anew: about 200 bytes each.
REMEMBERED = 900_000
#: Texts that are looked up together, and new words that are encoded as one text.
TEXTS, WORDS = 2_000, 5_000
#: Characters one of which may stand between words that are encoded as one text.
MARKS = "^~"
POINTS = ".,;:!?"

TOKENS = "doc_id {id}, ids binary, n long, part int, bin int, rank long, fulls long, tails long"
PIECES = (
    "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


class WordIds:
    """Ids of texts as bytes, word by word.

    The tokenizer drops white space and never joins what white space parts, so a text's ids are
    those of its words, and a word's have to be found once.
    """

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.known: dict[str, bytes] = {}
        single = [(c, i[0]) for c in MARKS if len(i := self._ids(c)) == 1]
        self.mark, self.mark_id = single[0] if single else (None, None)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _learn(self, words: list[str]) -> None:
        """Find the ids of ``words``: many as one text, told apart by a mark that none contains."""
        plain = [w for w in words if self.mark and self.mark not in w]
        for i in range(0, len(plain), WORDS):
            part = plain[i : i + WORDS]
            ids = np.array(self._ids(f" {self.mark} ".join(part)), self.kind)
            ends = np.r_[np.flatnonzero(ids == self.mark_id), len(ids)]
            if len(ends) == len(part):  # else each by itself, below
                width, raw, start = ids.itemsize, ids.tobytes(), 0
                for word, end in zip(part, ends.tolist()):
                    self.known[word] = raw[start * width : end * width]
                    start = end + 1
        for word in words:
            if word not in self.known:
                self.known[word] = np.array(self._ids(word), self.kind).tobytes()

    def _of_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word: those of its plain form, then those of the points that end it."""
        forms = [_form(w) for w in words]
        known = self.known
        new = {f for f, _ in forms if f not in known}
        if new:
            if len(known) + len(new) > REMEMBERED:
                known.clear()
                new = {f for f, _ in forms}
            self._learn(list(new | {p for _, p in forms}))
        return [known[f] + known[p] if p else known[f] for f, p in forms]

    def __call__(self, texts: pa.Array, end: int) -> list[bytes]:
        """The ids of each text, then ``end``, as little-endian numbers."""
        out = []
        for i in range(0, len(texts), TEXTS):
            # At ASCII white space only, which the tokenizer drops; pieces may be empty.
            split = pc.ascii_split_whitespace(pc.fill_null(texts.slice(i, TEXTS), ""))
            coded = split.flatten().dictionary_encode()
            ids = self._of_words(coded.dictionary.to_pylist())
            pool = np.frombuffer(b"".join(ids), self.kind)
            size = np.fromiter(map(len, ids), np.int64, len(ids)) // pool.itemsize
            start = np.cumsum(size) - size
            word = coded.indices.to_numpy()
            many = size[word]
            ends = np.cumsum(many)
            flat = pool[np.repeat(start[word] - ends + many, many) + np.arange(many.sum())]
            reach = np.r_[0, ends][np.cumsum(pc.list_value_length(split).to_numpy())]
            last = np.array([end], self.kind).tobytes()
            out += [flat[a:b].tobytes() + last for a, b in zip([0, *reach[:-1].tolist()], reach.tolist())]
        return out


def _form(word: str) -> tuple[str, str]:
    """(what a word is remembered as, the points after it).

    After a letter or a digit a run of points is a token by itself to the tokenizer, and it
    lower-cases, so words that differ in these only are remembered once.
    """
    core = word.rstrip(POINTS)
    if not core.isalnum():
        return word, ""
    if core.isascii():
        return core.lower(), word[len(core) :]
    # What the tokenizer makes of some letters ends in a mark, which would take in the points.
    return (core, word[len(core) :]) if normalize("NFC", core).lower()[-1].isalnum() else (word, "")


_TOKENIZERS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """A worker's own, kept from task to task."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordIds(path)
    return _TOKENIZERS[path]


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenized(docs: DataFrame, path: str) -> DataFrame:
    """Each document's ids with its places among those of its task.

    bin: the multiple of UNIT in its last part window; rank: earlier pieces of that bin in this
    task (part); fulls, tails: whole windows and tail ids before it in this task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_ids(path)
        width = np.dtype(encode.kind).itemsize
        part = TaskContext.get().partitionId()
        ranks, fulls, tails = np.zeros(LENGTH // UNIT, np.int64), 0, 0
        for batch in batches:
            ids = encode(batch.column("text"), END_ID)
            n = np.fromiter((len(x) // width for x in ids), np.int64, len(ids))
            bins = n % LENGTH // UNIT
            rank = np.empty(len(n), np.int64)
            for g in np.unique(bins):
                own = bins == g
                rank[own] = ranks[g] + np.arange(own.sum())
                ranks[g] += own.sum()
            before = [np.cumsum(x) - x for x in (n // LENGTH, n % UNIT)]
            columns = [
                batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array(n),
                pa.array(np.full(len(n), part, np.int32)), pa.array(bins.astype(np.int32)), pa.array(rank),
                pa.array(before[0] + fulls), pa.array(before[1] + tails),
            ]
            fulls += int((n // LENGTH).sum())
            tails += int((n % UNIT).sum())
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "n", "part", "bin", "rank", "fulls", "tails"])

    chosen = docs.select("doc_id", "text")
    return chosen.mapInArrow(run, TOKENS.format(id=chosen.schema["doc_id"].dataType.simpleString()))


def combinations(total: int, depth: int) -> list[tuple[int, ...]]:
    """Ascending tuples of 2 to ``depth`` numbers from 1 that add up to ``total``."""
    found = []

    def extend(head: tuple[int, ...], left: int, low: int) -> None:
        if head and left >= low:
            found.append((*head, left))
        if len(head) + 2 <= depth:
            for x in range(low, left // 2 + 1):
                extend((*head, x), left - x, x)

    extend((), total, 1)
    return sorted(set(found), key=lambda c: (len(c), c))


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 with the least |a x - b|, by the active-set method."""
    x, passive = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    tiny = 1e-10 * max(1.0, float(np.abs(b).max(initial=0)))
    for _ in range(3 * a.shape[1]):
        slope = a.T @ (b - a @ x)
        slope[passive] = -np.inf
        if passive.all() or slope.max() <= tiny:
            break
        passive[np.argmax(slope)] = True
        while True:
            s = np.zeros_like(x)
            s[passive] = np.linalg.lstsq(a[:, passive], b, rcond=None)[0]
            bad = passive & (s <= 0)
            if not bad.any():
                break
            step = np.min(x[bad] / np.maximum(x[bad] - s[bad], 1e-300))
            x += step * (s - x)
            passive &= x > tiny
            x[~passive] = 0
        x = s
    return x


@dataclass
class Plan:
    """Where the pieces of each bin go; sequences are numbered as whole windows, combinations, run."""

    fulls: int
    #: Per bin: first rank of each stretch, and its sequence, pieces per sequence and offset.
    stretches: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    #: Per bin: how many pieces combinations take; where the others begin in the run.
    taken: np.ndarray
    run_start: np.ndarray
    combined: int
    tails_start: int
    run_length: int

    def edges(self) -> np.ndarray:
        """Where the sequences of the run begin, and where it ends."""
        whole = self.run_length // LENGTH * LENGTH
        left, at, ends = self.run_length - whole, whole, []
        for bit in reversed(range(LENGTH.bit_length())):
            if left >> bit & 1:
                at += 1 << bit
                ends.append(at)
        return np.r_[np.arange(0, whole + 1, LENGTH), np.array(ends, np.int64)].astype(np.int64)


def solved(counts: np.ndarray, fulls: int, tails: int) -> Plan:
    """The plan for ``counts[g]`` pieces of g units."""
    bins = LENGTH // UNIT
    combos = combinations(bins, DEPTH)
    a = np.zeros((bins, len(combos)))
    for j, c in enumerate(combos):
        np.add.at(a[:, j], list(c), 1)
    left = counts.copy()
    left[0] = 0
    scale = max(1.0, float(left.max(initial=0)))
    wanted = np.floor(nnls(a, left / scale) * scale + 1e-6).astype(np.int64)
    repeats = np.zeros(len(combos), np.int64)
    # First the solution, the most repeated combinations before others, then whatever still fits.
    for limit, order in ((wanted, np.argsort(-wanted, kind="stable")), (None, np.arange(len(combos)))):
        for j in order:
            uses = a[:, j] > 0
            room = int((left[uses] // a[uses, j].astype(np.int64)).min())
            times = room if limit is None else min(room, int(limit[j]))
            repeats[j] += times
            left -= times * a[:, j].astype(np.int64)
    stretches: dict[int, list] = {g: [] for g in range(1, bins)}
    used, sequence = np.zeros(bins, np.int64), fulls
    for j in np.flatnonzero(repeats):
        offset = 0
        for g in sorted(set(combos[j])):
            many = combos[j].count(g)
            stretches[g].append((used[g], sequence, many, offset))
            used[g] += many * repeats[j]
            offset += many * g * UNIT
        sequence += int(repeats[j])
    rest = left * np.arange(bins) * UNIT
    return Plan(
        fulls=fulls,
        stretches={g: tuple(np.array(x, np.int64) for x in zip(*s)) for g, s in stretches.items() if s},
        taken=used,
        run_start=np.cumsum(rest) - rest,
        combined=sequence,
        tails_start=int(rest.sum()),
        run_length=int(rest.sum()) + tails,
    )


def _in_run(plan: Plan, edges: np.ndarray, doc, start, length, at):
    """Pieces laid into the run at ``at``, cut where a sequence ends."""
    first = np.searchsorted(edges, at, "right") - 1
    last = np.searchsorted(edges, at + length - 1, "right") - 1
    many = last - first + 1
    of = np.repeat(np.arange(len(doc)), many)
    sequence = np.repeat(first, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    begin = np.maximum(at[of], edges[sequence])
    end = np.minimum(at[of] + length[of], edges[sequence + 1])
    return doc[of], start[of] + begin - at[of], end - begin, plan.combined + sequence, begin - edges[sequence]


def placed(plan: Plan, n: np.ndarray, bins, rank, fulls, tails) -> tuple[np.ndarray, ...]:
    """(row, start, length, sequence, offset) of all pieces of documents with ``n`` ids.

    ``rank``, ``fulls``, ``tails`` count over all documents before each.
    """
    edges = plan.edges()
    rows = np.arange(len(n))
    many = n // LENGTH
    of = np.repeat(rows, many)
    k = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    out = [(of, k * LENGTH, np.full(len(of), LENGTH), fulls[of] + k, np.zeros(len(of), np.int64))]
    body = many * LENGTH
    for g in np.unique(bins[bins > 0]):
        size = int(g) * UNIT
        own = rows[(bins == g) & (rank < plan.taken[g])]
        if len(own):
            ranks, sequences, per, offsets = plan.stretches[int(g)]
            s = np.searchsorted(ranks, rank[own], "right") - 1
            j = rank[own] - ranks[s]
            out.append((own, body[own], np.full(len(own), size), sequences[s] + j // per[s], offsets[s] + j % per[s] * size))
        own = rows[(bins == g) & (rank >= plan.taken[g])]
        at = plan.run_start[g] + (rank[own] - plan.taken[g]) * size
        out.append(_in_run(plan, edges, own, body[own], np.full(len(own), size), at))
    tail = n % UNIT
    own = rows[tail > 0]
    at = plan.tails_start + tails[own]
    out.append(_in_run(plan, edges, own, (body + bins * UNIT)[own], tail[own], at))
    return tuple(np.concatenate([np.asarray(x[i], np.int64) for x in out]) for i in range(5))


def _lay(plan: Plan, kind: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            col = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in ("n", "bin", "rank", "fulls", "tails")}
            row, start, length, sequence, offset = placed(
                plan, col["n"], col["bin"].astype(np.int64), col["rank"], col["fulls"], col["tails"]
            )
            order = np.lexsort((start, row))
            row, start, length, sequence, offset = (x[order] for x in (row, start, length, sequence, offset))
            crc, last, ids = np.empty(len(row), np.int64), -1, None
            for i, (r, s, k) in enumerate(zip(row.tolist(), start.tolist(), length.tolist())):
                if r != last:
                    ids, last = np.frombuffer(batch.column("ids")[r].as_buffer(), kind), r
                crc[i] = zlib.crc32(ids[s : s + k].astype("<u4"))
            columns = [batch.column("doc_id").take(pa.array(row)), *map(pa.array, (start, length, crc, col["n"][row], sequence, offset))]
            yield pa.RecordBatch.from_arrays(
                columns, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            )

    return run


def packed(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset for every piece.

    A document's ids are those the tokenizer file ``path`` gives, then END_ID; a NULL or blank
    text is END_ID alone. Each id lies in exactly one piece; sequences have at most LENGTH ids,
    gapless from offset 0, and only the last few are shorter, each a power of two. Repeated rows
    are packed as often; an empty table gives no pieces.
    """
    written = saved(tokenized(docs, path), "tokens")
    lanes = [F.count_if(F.col("bin") == g).alias(f"b{g}") for g in range(LENGTH // UNIT)]
    sums = [F.floor(F.col("n") / LENGTH).cast("long").alias("f"), (F.col("n") % UNIT).alias("t")]
    per_part = saved(
        written.select("part", "bin", *sums).groupBy("part").agg(*lanes, F.sum("f").alias("fulls"), F.sum("t").alias("tails")),
        "parts",
    )
    names = [f"b{g}" for g in range(LENGTH // UNIT)] + ["fulls", "tails"]
    total = per_part.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names]).first()
    plan = solved(np.array([total[c] for c in names[:-2]], np.int64), total["fulls"], total["tails"])
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = saved(
        per_part.select(
            F.col("part").alias("_part"),
            F.array(*[F.coalesce(F.sum(c).over(before), F.lit(0)) for c in names]).alias("_starts"),
        ),
        "starts",
    )
    at = written.join(starts, F.col("part") == F.col("_part")).select(
        "doc_id", "ids", "n", "bin",
        (F.col("rank") + F.get("_starts", F.col("bin"))).alias("rank"),
        (F.col("fulls") + F.get("_starts", F.lit(len(names) - 2))).alias("fulls"),
        (F.col("tails") + F.get("_starts", F.lit(len(names) - 1))).alias("tails"),
    )
    kind = at.schema["doc_id"].dataType.simpleString()
    return at.mapInArrow(_lay(plan, word_ids(path).kind), PIECES.format(id=kind))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096 ids."""
    return packed(table(spark, sf_dir, "documents"), tokenizer_path())
