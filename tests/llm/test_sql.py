"""The queries that SQL can express against their SQL, and the SQL of the conversations on rows that the tables don't have."""

import random

import duckdb
import pytest
from compare import connect, differences

from shopgauge.llm import oracles, repair
from shopgauge.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(set(ORACLES) - {"rollup_words"}))
def test_query(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name]) == ""


def test_conversations_with_nulls_ties_and_repeats(spark, tmp_path):
    rng = random.Random(11)
    texts = ["Yes.", "no", "Why? \n", "", " \t", None, "é!", "same.", "One. Two"]
    rows = [
        (conv, rng.choice([None, *range(8), 30]), rng.choice(["user", "assistant", "system", "tool", "", None, "User"]), rng.choice(texts))
        for conv in [None, *range(120)] for _ in range(rng.randrange(1, 10))
    ]
    frame = spark.createDataFrame(rows + rows[:40], "conv_id long, turn long, role string, text string")
    frame.write.parquet(str(tmp_path / "c"))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/c/*.parquet'")
    assert differences(repair.audits(repair.repair(repair.damaged(frame))), duck, oracles.CONVERSATIONS) == ""
