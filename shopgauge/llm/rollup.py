"""Token counts kept as additive totals by source, language and tokenizer version.

Changes come in batches of signed counts. A batch is summed by group before it is stored, under its own name, in one commit of Spark's
writer; its `_SUCCESS` file marks it as committed. A batch that comes again changes nothing, one that was cut off is written anew.
Totals are the sum of all committed batches, or of the last compaction and the batches after it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgauge.llm.tokens import Encoder, piece_counts

GROUP = ["source", "lang", "version"]
_STORED = "source string, lang string, version string, n_docs long, n_tokens long"


def word_count(text: Column) -> Column:
    """Words between ASCII white space; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def encoded(documents: DataFrame, byte_vocabulary: str, piece_vocabulary: str) -> DataFrame:
    """doc_id, source, lang, byte_tokens, piece_tokens: how many ids two vocabulary files give the whole text; 0 for NULL or empty texts.

    Both are counted in one pass, so no text is shuffled. Further columns are not read, repeated rows are rows like any other.
    """
    names = ["doc_id", "source", "lang"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(byte_vocabulary)
        for batch in batches:
            text = batch.column(3)
            tokens = [pa.array([*map(len, encoder.encode(text))], pa.int64()), pa.array(piece_counts(text, piece_vocabulary))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *tokens], names=[*names, "byte_tokens", "piece_tokens"])
            del batch, text
            pa.default_memory_pool().release_unused()

    rows = documents.select(F.col("doc_id").cast("long"), *[F.col(c).cast("string") for c in ("source", "lang", "text")])
    return rows.mapInArrow(run, "doc_id long, source string, lang string, byte_tokens long, piece_tokens long")


def counted(documents: DataFrame, version: str, tokens: Column) -> DataFrame:
    """One count per document: doc_id, source, lang, version, tokens."""
    return documents.select("doc_id", "source", "lang", F.lit(version).alias("version"), tokens.cast("long").alias("tokens"))


def signed(counts: DataFrame, sign: int) -> DataFrame:
    """Counts as insertions (1) or deletions (-1)."""
    return counts.select(*GROUP, F.lit(sign).cast("long").alias("n_docs"), (F.lit(sign) * F.coalesce("tokens", F.lit(0))).cast("long").alias("n_tokens"))


def revised(old: DataFrame, new: DataFrame) -> DataFrame:
    """The change from old counts to new ones."""
    return signed(old, -1).unionByName(signed(new, 1))


def _summed(changes: DataFrame) -> DataFrame:
    return changes.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))


class TokenRollup:
    """Totals in a folder that all executors share. One writer commits at a time.

    NULL sources or languages are groups of their own, NULL token counts are 0, and groups whose totals are all 0 are not shown.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _names(self, kind: str) -> list[str]:
        """Committed folders of a kind, oldest name first."""
        top = self._path(kind)
        files = top.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(top):
            return []
        names = [s.getPath().getName() for s in files.listStatus(top)]
        return sorted(n for n in names if files.exists(self._path(f"{kind}/{n}/_SUCCESS")))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Store a batch of signed counts; False if a batch of this name is there already."""
        name = hashlib.sha256(batch.encode()).hexdigest()
        if name in self._names("batches"):
            return False
        _summed(changes).write.mode("overwrite").parquet(f"{self.folder}/batches/{name}")
        return True

    def _open(self) -> tuple[DataFrame, list[str]]:
        """Stored sums that make up the totals, and the names of all batches in them."""
        batches, bases = self._names("batches"), self._names("bases")
        inside: list[str] = []
        folders = []
        if bases:
            last = f"{self.folder}/bases/{bases[-1]}"
            inside = [r[0] for r in self.spark.read.schema("batch string").parquet(f"{self.folder}/based/{bases[-1]}").collect()]
            folders.append(last)
        folders += [f"{self.folder}/batches/{n}" for n in batches if n not in set(inside)]
        if not folders:
            return self.spark.createDataFrame([], _STORED), batches
        return self.spark.read.schema(_STORED).parquet(*folders), batches

    def totals(self) -> DataFrame:
        return _summed(self._open()[0]).where("n_docs <> 0 or n_tokens <> 0").select(*GROUP, "n_docs", "n_tokens")

    def compact(self) -> None:
        """Store the totals so far as one base. The list of its batches is written first; the base counts once it is committed."""
        rows, batches = self._open()
        name = f"{len(self._names('bases')):08d}"
        self.spark.createDataFrame([(b,) for b in batches], "batch string").coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/based/{name}")
        _summed(rows).write.mode("overwrite").parquet(f"{self.folder}/bases/{name}")
