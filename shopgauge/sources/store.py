"""Writing results: append, upsert, update and delete by key on plain parquet tables.

A change never overwrites what it reads: it gives the new content as a frame, which is written to a
new folder. Writes are one job each and idempotent, because row ids come from the data.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shopgauge.functions.ids import row_id, with_row_ids
from shopgauge.operators.keyed import join_same, latest_per_key
from shopgauge.schema import KEY, LIMIT_COLUMNS

__all__ = ["append", "apply_recheck", "as_text", "delete_keys", "merge", "random_row_id", "row_id", "update_limits", "upsert", "with_row_ids", "write_new"]

UPSERT, UPDATE, DELETE = "upsert", "update", "delete"


def random_row_id() -> Column:
    return F.uuid()


def append(df: DataFrame, path: str, partitions: int | None = None, by: Sequence[str] = ()) -> None:
    """Add rows to a parquet table. File count is left to the plan unless `partitions` is given."""
    rows = df.repartition(partitions) if partitions else df
    rows.write.mode("append").partitionBy(*by).parquet(path)


def write_new(df: DataFrame, path: str) -> None:
    """Write the next state of a table to a folder that does not exist yet."""
    df.write.mode("errorifexists").parquet(path)


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str] = KEY, order: Sequence[str] = ("time",)) -> DataFrame:
    """The rows of `old` with those of `new` put in place by key; among new copies the latest wins."""
    # One union instead of a join and a union, so that `new` is computed once.
    tagged = old.withColumn("_new", F.lit(0)).unionByName(latest_per_key(new, keys, order).withColumn("_new", F.lit(1)))
    newest = F.max("_new").over(W.partitionBy(*keys))
    return tagged.withColumn("_newest", newest).where("_new = _newest").drop("_new", "_newest")


def _one_per_key(changes: DataFrame) -> DataFrame:
    """One change per key: the latest if they have a time, else the one with the largest limits, so that a table never grows by them."""
    return latest_per_key(changes, KEY, ["time"] if "time" in changes.columns else LIMIT_COLUMNS)


def update_limits(limits: DataFrame, changes: DataFrame) -> DataFrame:
    """Replace the six limit columns, and only them, for the keys in `changes`. Of several changes of a key the latest counts."""
    times = ["time"] if "time" in changes.columns else []
    chosen = _one_per_key(changes.select(*KEY, *LIMIT_COLUMNS, *times))
    renamed = chosen.select(*KEY, *[F.col(c).alias(f"_new_{c}") for c in LIMIT_COLUMNS], F.lit(True).alias("_hit"))
    joined = join_same(limits, renamed, KEY, "left")
    values = {c: F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in LIMIT_COLUMNS}
    return joined.withColumns(values).select(*limits.columns)


def merge(table: DataFrame, changes: DataFrame, keys: Sequence[str] = KEY, updated: Sequence[str] = LIMIT_COLUMNS, order: Sequence[str] = ("time",)) -> DataFrame:
    """The table after all `changes`, in one full join: rows of the table's columns and an `action`.

    An upsert puts the row in place of the key's or adds it, an update replaces the columns `updated` of a key that is there, a delete
    takes the key out. Of several changes of a key the last one by `order` (columns of the changes) counts. Keys are unique in the table.
    """
    others = [c for c in table.columns if c not in keys]
    chosen = latest_per_key(changes, keys, order)
    new = chosen.select(*[F.col(k).alias(f"_new_{k}") for k in keys], *[F.col(c).alias(f"_new_{c}") for c in others], F.col("action").alias("_action"))
    same = F.expr(" AND ".join(f"`{k}` <=> `_new_{k}`" for k in keys))
    joined = table.withColumn("_old", F.lit(True)).join(new, same, "full")
    action, old = F.col("_action"), F.coalesce("_old", F.lit(False))
    kept = joined.filter(F.when(action == DELETE, F.lit(False)).when(action == UPDATE, old).otherwise(True))

    def value(c: str) -> Column:
        if c in keys:
            return F.when(F.coalesce("_old", F.lit(False)), F.col(c)).otherwise(F.col(f"_new_{c}"))
        replaced = (action == UPSERT) | (action == UPDATE) if c in updated else action == UPSERT
        return F.when(replaced, F.col(f"_new_{c}")).otherwise(F.col(c))

    return kept.select(*[value(c).alias(c) for c in table.columns])


def delete_keys(table: DataFrame, gone: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    return join_same(table, gone.select(*keys), keys, "left_anti")


def apply_recheck(limits: DataFrame, decisions: DataFrame) -> DataFrame:
    """Limits after a re-check: one join carries both the updates and the deletions. Decisions are unique per key or made so."""
    chosen = _one_per_key(decisions.select(*KEY, "action", *LIMIT_COLUMNS)).select(*KEY, "action", *[F.col(c).alias(f"_new_{c}") for c in LIMIT_COLUMNS])
    joined = join_same(limits, chosen, KEY, "left").filter(F.coalesce(F.col("action") != "delete", F.lit(True)))
    values = {
        c: F.when(F.col("action") == "update", F.col(f"_new_{c}")).otherwise(F.col(c)) for c in LIMIT_COLUMNS
    }
    return joined.withColumns(values).select(*limits.columns)


def as_text(df: DataFrame) -> DataFrame:
    """All columns as text, the way result tables are exchanged: three decimals, seconds, empty for NULL."""
    formats = {
        "double": lambda c: F.format_string("%.3f", c),
        "timestamp_ntz": lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss"),
    }
    texts = []
    for name, kind in df.dtypes:
        made = formats.get(kind, lambda c: c.cast("string"))(F.col(name))
        texts.append(F.when(F.col(name).isNull(), F.lit("")).otherwise(made).alias(name))
    return df.select(*texts)
