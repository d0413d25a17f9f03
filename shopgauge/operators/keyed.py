"""Joins, picks and ranks by key that stay whole and balanced when one key is very large."""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from shopgauge.operators.nulls import join_same
from shopgauge.operators.slots import SLOT, SPLIT, cut_points, with_slots

__all__ = ["first_n", "join_same", "latest_per_key", "look_back", "ranked"]

_CONTEXT = "_context"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key. An aggregate, so copies of a hot key shrink before the shuffle."""
    others = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def first_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "num") -> DataFrame:
    """The first n rows of each key. The bound on row_number lets Spark cut to n rows per task before the shuffle."""
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def look_back(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    depth: int,
    add: Callable[[WindowSpec], dict[str, Column]],
    slots: int | None = None,
    cuts: DataFrame | None = None,
) -> DataFrame:
    """Add columns that look at most `depth` rows back within a key. `order` is a total order of its rows that begins with a time.

    Windows run slot by slot. Each slot of a split key also gets the `depth` rows before it, marked as
    context and left out of the result, so values at its start are the same as without slots. `cuts` are
    the slots to use, of these rows or of others of the same keys and times.
    """
    cuts = cut_points(df, keys, order[0], slots) if cuts is None else cuts
    rows = with_slots(df, keys, order[0], cuts)
    window = W.partitionBy(*keys, SLOT).orderBy(*order)
    # The last rows of each slot are enough to know what comes before the next ones.
    ends = first_n(rows.filter(F.col(SPLIT)), [*keys, SLOT], [F.desc(c) for c in order], depth, "_end")
    chain = W.partitionBy(*keys).orderBy(*order)
    following = F.array(*[F.lead(SLOT, i).over(chain) for i in range(1, depth + 1)])
    context = (
        ends.withColumn("_following", following)
        .withColumn("_target", F.explode(F.array_distinct("_following")))
        .filter(F.col("_target") > F.col(SLOT))
        .withColumn(SLOT, F.col("_target"))
        .drop("_end", "_following", "_target")
    )
    together = rows.withColumn(_CONTEXT, F.lit(False)).unionByName(context.withColumn(_CONTEXT, F.lit(True)))
    return together.withColumns(add(window)).filter(~F.col(_CONTEXT)).drop(SLOT, SPLIT, _CONTEXT)


def ranked(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "num",
    newest_first: bool = False,
    slots: int | None = None,
) -> DataFrame:
    """row_number of every row of a key, by `order` ascending or, with newest_first, descending. The order begins with a time.

    Rows are numbered within slots and moved up by the rows of the key that lie on the other side, which
    the cut points know.
    """
    rows = with_slots(df, keys, order[0], cut_points(df, keys, order[0], slots), sizes=True)
    way = F.desc if newest_first else F.asc
    number = F.row_number().over(W.partitionBy(*keys, SLOT).orderBy(*[way(c) for c in order])).cast("long")
    ahead = F.col("_after" if newest_first else "_before")
    return rows.withColumn(name, number + ahead).drop(SLOT, SPLIT, "_before", "_after")
