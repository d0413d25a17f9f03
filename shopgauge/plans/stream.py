"""Judging measurements batch by batch, from what earlier batches left behind instead of reading back days of points."""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shopgauge.operators.keyed import first_n
from shopgauge.operators.points import charted
from shopgauge.operators.rules import DEPTH, judge
from shopgauge.operators.slots import cut_points
from shopgauge.operators.subgroups import STATE, merge_states, sample_states, sheet_states, usable_sheets
from shopgauge.schema import KEY, POINTS, RESULTS, STREAM_STATE, SUBGROUP
from shopgauge.sources.kept import Batches, Versions
from shopgauge.sources.shared import pinned

_LONG_AGO = "1900-01-01 00:00:00"


class JudgedStream:
    """Results of measurements that come in batches.

    Kept between batches, under `folder`, is a small table of states: the samples of sheets that are still open, and of every process
    the last sheets that are done, as many as the rules look back and one more (`tail`). A batch reads its own measurements and that
    table, charts and judges the sheets that it closes, adds them to the results and replaces the table. A batch that was done before,
    by name, is not done again; one that was cut off is done anew from the same table.
    """

    def __init__(self, spark: SparkSession, folder: str, rules: Iterable[int] = (1, 4), **options):
        self.rules = sorted(rules)
        self.options = options
        self.tail = max(DEPTH[rule] for rule in self.rules) + 1
        self.state = Versions(spark, f"{folder}/state", STREAM_STATE)
        self.results = Batches(spark, f"{folder}/results", RESULTS)

    def run(self, batch: str, measurements: DataFrame, limits: DataFrame, close: Column | None = None) -> bool:
        """Take in the measurements of a batch and judge the sheets whose first row is not later than `close` (all, if not given).

        A batch brings all rows that are newer than those of the batch before. The rows of a sheet have to come in before it is closed;
        the time between `close` and the newest row is how long they may take. Says whether there was anything to do.
        """
        if batch in self.state.names():
            return False
        state = self.state.read()
        opened = state.filter(~F.col("closed")).drop("closed")
        samples = pinned(merge_states(opened.unionByName(sample_states(measurements).select(*opened.columns))))
        begun = F.min("begin_mdate").over(W.partitionBy(*KEY, "id_no"))
        ended = F.lit(True) if close is None else F.col("_begun") <= close
        marked = samples.withColumn("_begun", begun).withColumn("_ended", ended)
        before = state.filter("closed").select(*KEY, "id_no", "rcard", F.col("begin_mdate").alias("mdate"), "n", "total", "low", "high", "squares")
        closing = sheet_states(marked.filter("_ended").drop("_begun", "_ended")).filter(F.col("n") > 0)
        sheets = pinned(before.unionByName(closing.select(*before.columns)))
        # All sheets of earlier batches are older than all that close now.
        mark = state.filter("closed").agg(F.coalesce(F.max("begin_mdate"), F.lit(_LONG_AGO).cast("timestamp_ntz"))).scalar()
        # One set of slots for both looks back: the points' times are those of the sheets, and judging would chart them again to cut them.
        options = {"cuts": pinned(cut_points(usable_sheets(sheets), KEY, "mdate", self.options.get("slots"))), **self.options}
        points = charted(usable_sheets(sheets), options["cuts"]).select(*POINTS.fieldNames())
        self.results.commit(judge(points, limits, self.rules, mark=mark, **options), batch)
        last = first_n(sheets, KEY, [F.desc("mdate"), F.desc("id_no")], self.tail).withColumn("begin_mdate", F.col("mdate"))
        kept = [c for c in STATE if c in last.columns]
        tail = last.select(*KEY, *SUBGROUP, *[F.col(c) if c in kept else F.lit(None).alias(c) for c in STATE], F.lit(True).alias("closed"))
        still = marked.filter(~F.col("_ended")).drop("_begun", "_ended").withColumn("closed", F.lit(False))
        return self.state.write(still.unionByName(tail), batch)
