"""Tables that are kept from run to run: one that grows by named batches, one that is replaced version by version.

Both are plain Parquet folders. A folder counts once Spark has marked it as complete, so a run that is killed leaves the table as it
was, and the next run writes its folder anew. A batch or version has a name; what was done under a name is not done again.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from shopgauge.operators.slices import high_water_mark


class _Folder:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _at(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _complete(self, prefix: str) -> list[str]:
        """Names of the complete folders, in order."""
        files, path = self._at("")
        if not files.exists(path):
            return []
        names = [s.getPath().getName() for s in files.listStatus(path) if s.isDirectory()]
        return sorted(n for n in names if n.startswith(prefix) and files.exists(self._at(f"{n}/_SUCCESS")[1]))

    def _write(self, df: DataFrame, folder: str, by: Sequence[str] = ()) -> None:
        df.select(*self.schema.fieldNames()).write.mode("overwrite").partitionBy(*by).parquet(f"{self.path}/{folder}")

    def _read(self, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*[f"{self.path}/{f}" for f in folders])


class Batches(_Folder):
    """A table that grows by named batches. `by` are the columns its folders are laid out by, which a filter on them prunes."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, by: Sequence[str] = ()):
        super().__init__(spark, path, schema)
        self.by = by

    def has(self, name: str) -> bool:
        return f"batch={name}" in self._complete("batch=")

    def commit(self, df: DataFrame, name: str, partitions: int | None = None) -> bool:
        """Write a batch, if there is none of that name yet, into `partitions` files per folder if given. Says whether it did."""
        if self.has(name):
            return False
        self._write(df.repartition(partitions) if partitions else df, f"batch={name}", self.by)
        return True

    def read(self) -> DataFrame:
        return self._read(self._complete("batch=")).select(*self.schema.fieldNames())

    def mark(self, time: str, default: Column) -> Column:
        """The newest time in the table, as a scalar of a plan: it never comes to the driver."""
        return high_water_mark(self.read(), time, default).scalar()


class Versions(_Folder):
    """A table that is replaced as a whole. Readers see the newest complete version; the one before it is left for those still at it."""

    def names(self) -> list[str]:
        return [v.split("-", 1)[1] for v in self._complete("version=")]

    def read(self) -> DataFrame:
        return self._read(self._complete("version=")[-1:]).select(*self.schema.fieldNames())

    def write(self, df: DataFrame, name: str) -> bool:
        """Make `df` the newest version, if there is none of that name among those left. Says whether it did."""
        there = self._complete("version=")
        if name in [v.split("-", 1)[1] for v in there]:
            return False
        number = int(there[-1].split("=")[1].split("-")[0]) + 1 if there else 1
        self._write(df, f"version={number:08d}-{name}")
        for old in there[:-1]:
            files, path = self._at(old)
            files.delete(path, True)
        return True
