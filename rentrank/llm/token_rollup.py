"""Token counts by source, language and tokenizer version, kept up by signed deltas.

A rollup is a folder. A committed batch is one sub-folder, named after the batch id, of additive
totals: what its changes add to (or take from) each group. A batch that is there already is not
added again, so it counts once however often it is delivered; a commit that broke off has no
success mark, is not read, and the next delivery overwrites it. Totals are the sum over all committed batches. ``compacted`` puts
the batches so far into one, and lists which ids that one holds.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rentrank.llm.store import table
from rentrank.session import work_dir

GROUP = ["source", "lang", "tokenizer"]
TOTALS = "source string, lang string, tokenizer string, documents long, tokens long"
INSERT, DELETE, REVISE = "insert", "delete", "revise"

#: Tokenizer versions and the separators between their tokens.
TOKENIZERS = {"space-1": "[\\x09-\\x0D\\x20]+", "alnum-1": "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"}


def token_count(text: Column, separator: str) -> Column:
    """Pieces between separators that are not empty; 0 for NULL."""
    pieces = F.split(F.coalesce(text, F.lit("")), separator)
    return F.size(F.array_remove(pieces, "")).cast("long")


def deltas(changes: DataFrame) -> DataFrame:
    """source, lang, tokenizer, documents, tokens: what ``changes`` add up to.

    ``changes``: change (insert, delete or revise), source, lang, tokenizer, tokens and, for a
    revision, old_tokens. An insert adds a document and its tokens, a delete takes them off, a
    revision adds the difference. Any other change is an error. NULL counts are 0; NULL sources
    and languages are groups of their own. Summed before anything is shuffled, so a source that
    holds a third of all rows is a few numbers per task.
    """
    new, old = F.coalesce("tokens", F.lit(0)), F.coalesce("old_tokens", F.lit(0))
    kind = F.col("change")
    unknown = F.raise_error(F.concat(F.lit("no such change: "), F.coalesce(kind, F.lit("NULL")))).cast("long")
    documents = F.when(kind == INSERT, 1).when(kind == DELETE, -1).when(kind == REVISE, 0).otherwise(unknown)
    tokens = F.when(kind == INSERT, new).when(kind == DELETE, -new).otherwise(new - old)
    return changes.groupBy(*GROUP).agg(
        F.sum(documents).cast("long").alias("documents"), F.sum(tokens).cast("long").alias("tokens")
    )


class Rollup:
    """The rollup in the folder ``path``, which all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self):
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        return root.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def _folder(self, batch: str) -> str:
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", batch):
            raise ValueError(f"batch id {batch!r}")
        return f"{self.path}/batch={batch}"

    def committed(self) -> list[str]:
        """Ids of the batches that are wholly there, sorted."""
        fs, path = self._fs()
        if not fs.exists(path(self.path)):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path(self.path))]
        done = [n for n in names if n.startswith("batch=") and fs.exists(path(f"{self.path}/{n}/_SUCCESS"))]
        return sorted(n.removeprefix("batch=") for n in done)

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add the batch ``batch``; False if it is there already, or in a compacted one."""
        done = self.committed()
        if batch in done or batch in self._held(done):
            return False
        deltas(changes).write.mode("overwrite").parquet(self._folder(batch))
        return True

    def _held(self, done: list[str]) -> set[str]:
        """Ids of batches that went into a compacted one."""
        fs, path = self._fs()
        held: set[str] = set()
        for batch in done:
            if fs.exists(path(f"{self._folder(batch)}/held")):
                rows = self.spark.read.text(f"{self._folder(batch)}/held").collect()
                held |= {r[0] for r in rows}
        return held

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, documents, tokens over all batches; groups at 0 are left out."""
        done = self.committed()
        held = self._held(done)
        folders = [self._folder(b) for b in done if b not in held]
        rows = self.spark.read.schema(TOTALS)
        rows = rows.option("pathGlobFilter", "*.parquet").parquet(*folders) if folders else self.spark.createDataFrame([], TOTALS)
        summed = rows.groupBy(*GROUP).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        return summed.filter("documents <> 0 OR tokens <> 0")

    def compacted(self, batch: str) -> None:
        """Put all batches so far into one of that id; the old folders are only passed over."""
        done = self.committed()
        if batch in done:
            return
        held = sorted(set(done) | self._held(done))
        if not held:
            return
        fs, path = self._fs()
        # The list comes after the totals: until it is whole the new folder must not be read.
        target = f"{self.path}/making={batch}"
        self.totals().write.mode("overwrite").parquet(target)
        self.spark.createDataFrame([(b,) for b in held], "value string").coalesce(1).write.mode("overwrite").text(f"{target}/held")
        fs.delete(path(self._folder(batch)), True)
        fs.rename(path(target), path(self._folder(batch)))


def _counted(docs: DataFrame, change: str, text: Column, old: Column | None = None) -> DataFrame:
    """A change per document and tokenizer version, and its doc_id: the text is left behind."""
    versions = [
        F.struct(
            F.lit(name).alias("tokenizer"), token_count(text, separator).alias("tokens"),
            (token_count(old, separator) if old is not None else F.lit(0).cast("long")).alias("old_tokens"),
        )
        for name, separator in TOKENIZERS.items()
    ]
    return docs.select("doc_id", F.lit(change).alias("change"), "source", "lang", F.inline(F.array(*versions)))


def op7_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after all documents came in, lost their digits, and the toxic ones were taken out.

    Three batches: all documents; revised counts of those whose text changes when digits are
    removed; deletion of those that labels call toxic, at the counts they have by then. Each is
    delivered twice.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    labels = table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id").distinct()
    clean = F.regexp_replace("text", "[0-9]+", "")
    rollup = Rollup(spark, work_dir(spark, "token-rollup"))
    batches = {
        "load": _counted(docs, INSERT, F.col("text")),
        "scrub": _counted(docs.filter(F.col("text").rlike("[0-9]")), REVISE, clean, F.col("text")),
        # An inner join with distinct ids: Spark would move a semi-join below the counting, to the texts.
        "toxic": _counted(docs, DELETE, clean).join(labels, "doc_id"),
    }
    for _ in range(2):
        for batch, changes in batches.items():
            rollup.commit(batch, changes)
    return rollup.totals()


ORACLE = r"""
WITH kept AS (
  SELECT source, lang, regexp_replace(text, '[0-9]+', '', 'g') AS text FROM documents
  WHERE doc_id IS NULL OR doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL)),
counted AS (
  SELECT source, lang, 'space-1' AS tokenizer,
    coalesce(len(regexp_extract_all(text, '[^\x09-\x0D\x20]+')), 0) AS tokens FROM kept
  UNION ALL
  SELECT source, lang, 'alnum-1',
    coalesce(len(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')), 0) FROM kept)
SELECT source, lang, tokenizer, count(*) AS documents, CAST(sum(tokens) AS BIGINT) AS tokens
FROM counted GROUP BY source, lang, tokenizer
"""
