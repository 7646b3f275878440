import pytest
from pyspark.sql import functions as F

from conftest import rows
from tagweave.operators.match import date_digits, match_ranges, match_rules, match_values
from tagweave.plans.models import AGE_RANGES, GENDER_VALUES, JOB_VALUES

RULES = [(65, "1"), (66, "2"), (67, "3"), (68, "4"), (69, "5"), (70, "6")]


def _rules(spark, data=RULES):
    return spark.createDataFrame(data, "id INT, rule STRING")


def test_job_match_golden(spark):
    src = spark.createDataFrame([("1", "3"), ("10", "5"), ("100", "3"), ("101", "1")], "id STRING, job STRING")
    out = match_rules(src, _rules(spark), "job")
    assert rows(out) == sorted([("1", 67), ("10", 69), ("100", 67), ("101", 65)])


def test_no_rule_gives_zero_or_null(spark):
    src = spark.createDataFrame([("7", "9"), ("8", None)], "id STRING, job STRING")
    assert rows(match_rules(src, _rules(spark), "job")) == [("7", 0), ("8", 0)]
    assert rows(match_rules(src, _rules(spark), "job", default=None)) == [("7", None), ("8", None)]


def test_duplicate_rules_highest_id_and_row_count(spark):
    src = spark.createDataFrame([("1", "3"), ("2", "3")], "id STRING, job STRING")
    out = match_rules(src, _rules(spark, RULES + [(80, "3"), (60, "3")]), "job")
    assert rows(out) == [("1", 80), ("2", 80)]


def test_rules_are_broadcast(spark):
    src = spark.createDataFrame([("1", "3")], "id STRING, job STRING")
    plan = match_rules(src, _rules(spark), "job")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_gender_case(spark):
    src = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "id STRING, gender STRING")
    assert rows(match_values(src, "gender", GENDER_VALUES)) == [("a", 257), ("b", 258), ("c", None)]


def test_job_case(spark):
    data = [(str(i), str(i)) for i in range(1, 9)]
    src = spark.createDataFrame(data, "id STRING, job STRING")
    got = dict(rows(match_values(src, "job", JOB_VALUES)))
    assert got == {"1": 260, "2": 261, "3": 262, "4": 263, "5": 264, "6": 265, "7": 267, "8": None}


AGE_CASES = [("1959-12-31", None), ("1960-01-01", 301), ("1969-12-31", 301), ("1990-12-31", 304),
             ("1991-01-01", None), ("2010-12-31", 305), ("2011-01-01", None), ("abc", None), (None, None)]


def test_age_ranges_case_and_join(spark):
    src = spark.createDataFrame([(str(i), b) for i, (b, _) in enumerate(AGE_CASES)], "id STRING, birthday STRING")
    expected = sorted((str(i), t) for i, (_, t) in enumerate(AGE_CASES))
    assert rows(match_ranges(src, date_digits("birthday"), AGE_RANGES)) == expected
    ranges = spark.createDataFrame([(lo, hi, t) for lo, hi, t in AGE_RANGES], "lo LONG, hi LONG, id INT")
    assert rows(match_ranges(src, date_digits("birthday"), ranges)) == expected


def test_overlapping_range_rules_rejected(spark):
    import pytest
    src = spark.createDataFrame([("1", "5")], "id STRING, v STRING")
    ranges = spark.createDataFrame([(1, 10, 1), (5, 20, 2)], "lo LONG, hi LONG, id INT")
    with pytest.raises(ValueError):
        match_ranges(src, F.col("v").cast("bigint"), ranges)


def test_broadcast_guard_bounds_rows_and_bytes(spark):
    from tagweave.operators.joins import bounded_broadcast
    small = spark.createDataFrame([(1, "x" * 10)] * 5, "id INT, rule STRING")

    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().analyzed().toString().lower()

    assert hinted(bounded_broadcast(small, max_rows=5))
    assert not hinted(bounded_broadcast(small, max_rows=4))
    assert not hinted(bounded_broadcast(small, max_rows=5, max_bytes=50))  # 5 * (8 + 10) = 90 bytes
    assert hinted(bounded_broadcast(small, max_rows=5, max_bytes=90))


def test_large_range_path_across_partitions(spark):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")  # keep many range partitions so the carry between them is used
    try:
        ranges = [(lo, lo + 6, 1000 + lo) for lo in range(0, 3000, 10)]  # gaps of 3 after each range
        src = spark.range(0, 3000).select(F.col("id").cast("string").alias("id"),
                                          (F.col("id") * 7 % 3003).alias("v"))
        rules = spark.createDataFrame(ranges, "lo LONG, hi LONG, id INT")
        big = match_ranges(src, F.col("v"), rules, max_broadcast_rows=10)
        want = {str(i): (1000 + (v // 10) * 10 if v % 10 <= 6 and v < 3000 else None)
                for i, v in ((i, i * 7 % 3003) for i in range(3000))}
        assert dict(rows(big)) == want
        import pytest
        overlapping = spark.createDataFrame(ranges + [(5, 12, 9)], "lo LONG, hi LONG, id INT")
        with pytest.raises(ValueError):
            match_ranges(src, F.col("v"), overlapping, max_broadcast_rows=10)
    finally:
        spark.conf.set(key, before)


EDGES = [(None, 3, 1), (5, 8, 2), (4, None, 3), (10, 10, 4), (20, 30, 5)]


@pytest.mark.parametrize("bound", [0, 10])
def test_range_rows_ignore_null_bounds_and_hit_edges(spark, bound):
    """The same answers from a broadcast and from a salted lookup."""
    src = spark.createDataFrame([(str(i), v) for i, v in enumerate([2, 4, 5, 8, 9, 10, 11, 20, 30, 31, None, None])], "id STRING, v LONG")
    rules = spark.createDataFrame(EDGES, "lo LONG, hi LONG, id INT")
    got = match_ranges(src, F.col("v"), rules, max_broadcast_rows=bound)
    assert "NestedLoop" not in got._jdf.queryExecution().toString()
    assert [r[1] for r in sorted(rows(got), key=lambda r: int(r[0]))] == [None, None, 2, 2, None, 4, None, 5, 5, None, None, None]


def test_fixed_maps_compare_numbers(spark):
    src = spark.createDataFrame([("a", "01"), ("b", " 1"), ("c", "x"), ("d", "2"), ("e", None), ("f", "1.5"), ("g", "m")], "id STRING, v STRING")
    out = match_values(src, "v", {"1": 257, "2": 258, "m": 9})
    assert rows(out) == [("a", 257), ("b", 257), ("c", None), ("d", 258), ("e", None), ("f", None), ("g", 9)]


def test_salted_rule_lookup_spreads_a_hot_value(spark):
    """Beyond the broadcast bound a value (and null) with most rows is dealt over many tasks."""
    src = spark.range(40_000).selectExpr("cast(id as string) id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL "
                                         "ELSE cast(id as string) END v")
    rules = spark.createDataFrame([(7, "hot"), (8, "5"), (9, "x")], "id INT, rule STRING")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = match_rules(src, rules, "v", max_broadcast_rows=0)
        sizes = [r[0] for r in out.groupBy(F.spark_partition_id()).count().select("count").collect()]
        tags = {r["tagIds"]: r["n"] for r in out.groupBy("tagIds").agg(F.count(F.lit(1)).alias("n")).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert tags == {7: 13334, 8: 1, 0: 26665}
    assert max(sizes) < 3 * sum(sizes) / len(sizes)


def test_range_index_needs_no_exchange(spark):
    """Ranges given as a table: a projection, and as many answers as the CASE and the sorted lookup give."""
    ranges = [(lo, lo + lo % 7, 10_000 + lo) for lo in range(-500, 4000, 9)] + [(9000, 8000, 1), (2**62, 2**63 - 1, 2)]
    src = spark.range(-600, 4200).select(F.col("id").cast("string").alias("id"), F.col("id").alias("v")).unionByName(
        spark.createDataFrame([("n", None), ("low", -2**63), ("high", 2**63 - 1), ("rev", 8500)], "id string, v long"))
    rules = spark.createDataFrame(ranges, "lo LONG, hi LONG, id INT")
    got = match_ranges(src, F.col("v"), rules)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert rows(got) == rows(match_ranges(src, F.col("v"), rules, max_broadcast_rows=5))
    assert rows(got) == rows(match_ranges(src, F.col("v"), ranges))
    assert dict(rows(got))["high"] == 2
    assert {r[1] for r in rows(match_ranges(src, F.col("v"), rules.limit(0)))} == {None}


def test_range_index_of_one_and_of_many(spark):
    src = spark.range(0, 20_000).select(F.col("id").cast("string").alias("id"), F.col("id").alias("v"))
    one = spark.createDataFrame([(3, 5, 7)], "lo LONG, hi LONG, id INT")
    assert match_ranges(src, F.col("v"), one).where("tagIds = 7").count() == 3
    many = spark.range(0, 9_999).selectExpr("id * 2 as lo", "id * 2 as hi", "cast(id as int) as id")
    got = match_ranges(src, F.col("v"), many)
    assert got.where("tagIds is not null").count() == 9_999
    assert got.where("tagIds * 2 <> cast(userId as long)").isEmpty()
