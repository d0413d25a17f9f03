"""Even slots of rows in time order, worked out from counts by key and second.

A key with very many rows must not be one task's work, so its rows are cut into slots along time. Where the cuts lie follows from the
rows alone: counts of a key's seconds, summed up from its first one, cross a multiple of the wanted size. Nothing is sampled, so the
same rows are cut at the same places whenever a task runs again, and nothing has to be written down in between.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shopgauge.operators.nulls import join_same

SLOT, SPLIT = "_slot", "_split"
#: A key with fewer rows is one slot, unless a number of slots is asked for.
LEAST_ROWS = 1 << 16
_CHUNK = 64


def second_of(df: DataFrame, time: str) -> Column:
    """A whole number that rises with time: seconds of a timestamp, days of a date, a number's floor. Rows of one number stay together."""
    kind = dict(df.dtypes)[time]
    if kind == "timestamp_ntz":
        return F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{time}`)")
    if kind == "timestamp":
        return F.unix_seconds(time)
    if kind == "date":
        return F.unix_date(time).cast("long")
    if kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal"):
        return F.floor(time).cast("long")
    raise TypeError(f"{time} is a {kind}: slots need a time or a number")


def cut_points(df: DataFrame, keys: Sequence[str], time: str, slots: int | None = None) -> DataFrame:
    """One row for each key that has more rows than a slot should: where its slots begin and how many rows lie before and after them.

    The rows are dealt into about `slots` slots (the shuffle partitions, if not given). A slot holds the wanted number of rows and those
    of one more second. Fewer than `slots` keys can be that large, which bounds the result; it reads the key and time columns only, a
    second time for the large keys' seconds, which are summed by hour first so that no window holds a whole key's seconds.
    """
    least = 1 if slots else LEAST_ROWS
    slots = slots or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    seconds = df.select(*keys, second_of(df, time).alias("_at"))
    counts = seconds.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    wanted = F.greatest(F.lit(least), F.ceil(counts.agg(F.sum("_rows")).scalar() / slots))
    large = counts.select(*keys, "_rows", wanted.cast("long").alias("_wanted")).filter(F.col("_rows") > F.col("_wanted"))
    each = join_same(seconds, F.broadcast(large), keys).groupBy(*keys, "_at").agg(F.count(F.lit(1)).alias("_n"), F.max("_rows").alias("_rows"), F.max("_wanted").alias("_wanted"))
    each = each.withColumn("_hour", F.floor(F.col("_at") / 3600))

    def before(by: list[str], order: str, value: str) -> Column:
        window = W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
        return F.coalesce(F.sum(value).over(window), F.lit(0))

    inside = each.withColumn("_inside", before([*keys, "_hour"], "_at", "_n"))
    hours = each.groupBy(*keys, "_hour").agg(F.sum("_n").alias("_n")).withColumn("_earlier", before(list(keys), "_hour", "_n")).drop("_n")
    placed = join_same(inside, hours, [*keys, "_hour"]).withColumn("_before", F.col("_inside") + F.col("_earlier"))
    firsts = placed.groupBy(*keys, F.floor(F.col("_before") / F.col("_wanted")).alias("_number")).agg(
        F.min("_at").alias("at"), F.min("_before").alias("before"), F.max("_rows").alias("_rows")
    )
    listed = firsts.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("before", "at"))).alias("_cuts"), F.max("_rows").alias("_rows")
    )
    # The first slot begins with the first row; the others' beginnings are kept in chunks, so that finding one takes few comparisons.
    later = F.expr("transform(slice(_cuts, 2, greatest(size(_cuts) - 1, 0)), c -> c.at)")
    chunks = F.expr(f"transform(sequence(0, int((size(_later) - 1) / {_CHUNK})), i -> slice(_later, i * {_CHUNK} + 1, {_CHUNK}))")
    ends = F.expr("transform(_cuts, (c, i) -> named_struct('before', c.before, 'after', _rows - coalesce(get(_cuts, i + 1).before, _rows)))")
    return (
        listed.withColumns({"_later": later, "_sizes": ends})
        .filter(F.size("_later") > 0)
        .select(*keys, chunks.alias("_chunks"), "_sizes")
    )


def with_slots(df: DataFrame, keys: Sequence[str], time: str, cuts: DataFrame, sizes: bool = False) -> DataFrame:
    """The rows with their slot and whether their key is split; on request also how many rows of the key lie before and after the slot."""
    joined = join_same(df.withColumn("_second", second_of(df, time)), F.broadcast(cuts), keys, "left")
    heads = F.expr("size(filter(_chunks, c -> c[0] <= _second))")
    inside = F.expr("size(filter(get(_chunks, _head - 1), c -> c <= _second))")
    slot = F.when(F.col("_head") > 0, (F.col("_head") - 1) * _CHUNK + inside).otherwise(0)
    placed = joined.withColumn(SPLIT, F.col("_chunks").isNotNull()).withColumn("_head", heads).withColumn(SLOT, slot.cast("int"))
    if sizes:
        own = F.get("_sizes", F.col(SLOT))
        placed = placed.withColumns({"_before": F.coalesce(own["before"], F.lit(0)), "_after": F.coalesce(own["after"], F.lit(0))})
    return placed.drop("_second", "_chunks", "_sizes", "_head")
