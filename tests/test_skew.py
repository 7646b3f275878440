"""One key holding a third of all rows must not change results or load one task."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tagweave.operators.match import match_rules
from tagweave.sources.cells import read_cells
from tagweave.sources.store import upsert_frame


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_rowkey_in_cells_is_combined_map_side(spark):
    n = 30000
    base = spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), F.col("id").cast("string")))
        .alias("rowkey"),
        F.lit("d").alias("family"), F.lit("job").alias("qualifier"), F.col("id").cast("string").alias("value"),
        F.timestamp_seconds(F.col("id")).alias("ts"))
    out = read_cells(base.repartition(8), "d", ["job"], rowkey_as="id")
    plan = _plan(out)
    assert "partial_max_by" in plan  # pre-aggregated before the shuffle
    got = dict(rows(out.where(F.col("id") == "hot")))
    assert got == {"hot": str(n - 3 if (n - 1) % 3 else n - 1)}
    assert out.count() == 1 + (n - n // 3 - (1 if n % 3 else 0))


def test_hot_value_in_match_is_broadcast(spark):
    src = spark.range(0, 30000).select(F.col("id").cast("string").alias("id"),
                                       F.when(F.col("id") % 3 == 0, "3").otherwise(F.col("id") % 7).cast("string")
                                       .alias("job"))
    rules = spark.createDataFrame([(65 + i, str(i)) for i in range(7)], "id INT, rule STRING")
    out = match_rules(src, rules, "job")
    plan = _plan(out)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert out.count() == 30000
    assert out.where(F.col("tagIds") == 68).count() == 10000 + len([i for i in range(30000) if i % 3 and i % 7 == 3])


keys = st.sets(st.integers(0, 40), max_size=25)


@settings(max_examples=15, deadline=None)
@given(keys, keys)
def test_upsert_never_loses_a_key(spark, old_keys, new_keys):
    old = spark.createDataFrame([(str(k), "o") for k in old_keys], "userId STRING, tagIds STRING")
    new = spark.createDataFrame([(str(k), "n") for k in new_keys], "userId STRING, tagIds STRING")
    full = {r[0]: r[1] for r in upsert_frame(old, new).collect()}
    assert set(full) == {str(k) for k in old_keys | new_keys}
    assert all(v == ("n" if int(k) in new_keys else "o") for k, v in full.items())
    only = {r[0] for r in upsert_frame(old, new, insert_new=False).collect()}
    assert only == {str(k) for k in old_keys}
