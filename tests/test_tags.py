from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagweave.functions.tags import is_blank, merge_tags, register_sql_functions

CASES = [
    # (first, second, blank, expected)
    ("34", "43", "blank", "34,43"),
    ("", "65", "empty", "65"),
    ("65", "", "empty", "65"),
    ("65,70", "67,65", "empty", "65,70,67"),
    ("  ", "65", "blank", "65"),
    ("260", "301,260", "blank", "260,301"),
    (None, "65", "empty", "65"),
    ("", "", "empty", ""),
    ("65,,70,", "70,71", "blank", "65,70,71"),
    ("65", None, "blank", "65"),
]


def test_golden_merges(spark):
    df = spark.createDataFrame([(a, b, k) for a, b, k, _ in CASES], "a STRING, b STRING, k STRING")
    out = df.select(
        F.when(F.col("k") == "empty", merge_tags("a", "b", "empty"))
        .otherwise(merge_tags("a", "b", "blank")).alias("m")).collect()
    assert [r["m"] for r in out] == [e for *_, e in CASES]


def test_blank(spark):
    df = spark.createDataFrame([(None,), ("",), ("  ",), ("\t",), (" a",)], "x STRING")
    assert [r[0] for r in df.select(is_blank("x")).collect()] == [True, True, True, True, False]


def test_sql_function(spark):
    register_sql_functions(spark)
    got = spark.sql("SELECT merge_tags('65,70', '67,65') AS a, merge_tags(' ', '65') AS b, "
                    "merge_tags('34', NULL) AS c").first()
    assert (got["a"], got["b"], got["c"]) == ("65,70,67", "65", "34")


# Stored tag lists are written by merges, so their items are distinct.
tags = st.lists(st.sampled_from(["1", "2", "3", "65", "70"]), max_size=5, unique=True).map(",".join)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(tags, tags), min_size=1, max_size=20))
def test_merge_idempotent_and_distinct(spark, pairs):
    df = spark.createDataFrame(pairs, "o STRING, n STRING")
    once = df.select("o", "n", merge_tags("o", "n").alias("m"))
    twice = once.select("m", merge_tags("m", "n").alias("m2")).collect()
    for r in twice:
        assert r["m"] == r["m2"]
        items = [x for x in (r["m"] or "").split(",") if x]
        assert len(items) == len(set(items))


def test_sql_form_of_merge(spark):
    from conftest import rows
    from tagweave.operators.merge import merge_with_history, merge_with_history_sql
    new = spark.createDataFrame([("1", 43), ("2", 65), ("3", None)], "userId STRING, tagIds INT")
    old = spark.createDataFrame([("1", "34"), ("2", " "), ("9", "1")], "userId STRING, tagIds STRING")
    sql = merge_with_history_sql(spark, new, old)
    api = merge_with_history(new, old, join="left", order="old_first", blank="blank")
    assert rows(sql) == rows(api) == [("1", "34,43"), ("2", "65"), ("3", None)]


def test_unicode_blanks_are_blank(spark):
    from tagweave.functions.tags import merge_tags, register_sql_functions
    register_sql_functions(spark)
    df = spark.createDataFrame([("\u3000", "65"), ("\t\u2003 ", "65"), ("\u001f", "65"), ("1", "\u3000")], "a STRING, b STRING")
    want = ["65", "65", "65", "1"]
    assert [r[0] for r in df.select(merge_tags("a", "b")).collect()] == want
    assert [r[0] for r in df.selectExpr("merge_tags(a, b)").collect()] == want
