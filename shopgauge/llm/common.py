"""What the operators of this subpackage share: shipping the code, writing intermediate tables, choosing columns."""

from __future__ import annotations

import ctypes
import functools
import gc
import io
import os
import tempfile
import time
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopgauge.sources.shared import pinned, work_folder

_PACKAGE = Path(__file__).resolve().parent.parent


#: Rows of whole texts that go to a Python worker at a time, unless the session sets a number of its own.
BATCH_ROWS = 2000


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors once per application, as `--py-files` would, and bound the batches of texts."""
    context = spark.sparkContext
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    if getattr(context, "_shopgauge_shipped", False):
        return spark
    body = io.BytesIO()
    with zipfile.ZipFile(body, "w") as z:
        for p in sorted(_PACKAGE.rglob("*.py")):
            z.write(p, p.relative_to(_PACKAGE.parent))
    name = os.path.join(tempfile.mkdtemp(prefix="shopgauge-"), "shopgauge.zip")
    Path(name).write_bytes(body.getvalue())
    context.addPyFile(name)
    context._shopgauge_shipped = True
    return spark


@functools.cache
def _allocator():
    """The C library of this process, if it can give memory back to the system."""
    try:
        library = ctypes.CDLL(None)
        return library if hasattr(library, "malloc_trim") else None
    except OSError:
        return None


def give_back() -> None:
    """Give memory that this worker has freed back to the system: a worker goes from stage to stage and would hold the most of each."""
    pa.default_memory_pool().release_unused()
    if _allocator():
        _allocator().malloc_trim(0)


def kept(df: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint folder, so that a lost executor cannot change or repeat them."""
    return pinned(df)


def written(df: DataFrame) -> DataFrame:
    """The rows written as Parquet to a new shared folder and read again: compressed, with columns that can be pruned."""
    folder = work_folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(folder)
    table = df.sparkSession.read.schema(df.schema).parquet(folder)
    table._written_folder = folder
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables made by `written` that no frame in use reads any more."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table._written_folder)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def append(df: DataFrame, text: str | Column, added: str, compute: Callable[[pa.Array], list[pa.Array]]) -> DataFrame:
    """All columns of df and, computed from a text column (or another expression) batch by batch, the columns of the DDL `added`.

    A column of df whose name is also added (whatever its case) is replaced.
    """
    new = T.StructType.fromDDL(added)
    taken = {f.name.lower() for f in new}
    rest = df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])
    names = [*rest.columns, *new.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.columns[:-1]
            yield pa.RecordBatch.from_arrays([*columns, *compute(batch.column(len(columns)))], names=names)
            del batch, columns
            give_back()

    value = F.col(f"`{text}`").cast("string") if isinstance(text, str) else text
    # Chosen together, since the text may have the name of a column that is replaced.
    source = df.select(*[F.col(f"`{c}`") for c in rest.columns], value.alias("_text_of_append"))
    return source.mapInArrow(run, T.StructType([*rest.schema.fields, *new.fields]))


def held_out(doc_id: str, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text falls in one part of `parts`. A NULL id is never held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(parts)) == part, F.lit(False))


def release(spark: SparkSession) -> None:
    """Let Spark delete shuffle files of finished steps now: it does so once the driver's collector finds their frames gone.

    The first collection only finds what still holds them; when that has been dropped, a moment later, a second one finds the frames.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    time.sleep(0.3)
    spark.sparkContext._jvm.System.gc()
