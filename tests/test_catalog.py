import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from tagweave.operators import catalog_ops as C
from tagweave.operators.ids import with_sequential_id
from tagweave.schemas import MODEL_CATALOG, TAG_CATALOG

NOW = dt.datetime(2020, 1, 1)


def _catalog(spark, data):
    return spark.createDataFrame([(i, p, l, n, r, None, None) for i, p, l, n, r in data], TAG_CATALOG)


BASE = [(1, -1, 1, "people", None), (2, 1, 2, "shopping", None), (3, 2, 3, "profile", None),
        (64, 3, 4, "job", "inType=HBase##selectFields=id,job"), (65, 64, 5, "student", "1"),
        (66, 64, 5, "teacher", "2")]


def test_find_by_level_parent_name(spark):
    cat = _catalog(spark, BASE)
    assert [r["id"] for r in C.tags_by_level(cat, 5).collect()] == [65, 66]
    assert sorted(r["id"] for r in C.tags_by_parent(cat, 64).collect()) == [65, 66]
    assert [r["id"] for r in C.find_tags(cat, "job", 4, 3).collect()] == [64]
    assert C.find_tags(cat, "job", 4, None).count() == 0
    assert C.tags_by_level(cat, 1).columns == ["id", "pid", "level", "name", "rule"]


def test_level_one_pid_forced(spark):
    df = spark.createDataFrame([(9, 7, 1, "x", None)], "id LONG, pid LONG, level INT, name STRING, rule STRING")
    r = C.prepare_tags(df, NOW).first()
    assert r["pid"] == -1 and r["ctime"] == NOW and r["utime"] == NOW


def test_path_upsert_inserts_missing_levels_and_is_idempotent(spark):
    cat = _catalog(spark, BASE)
    paths = spark.createDataFrame(
        [("people", "shopping", "profile"), ("people", "shopping", "habits"), ("people", "travel", "trips"),
         ("places", None, None), ("people", "shopping", "habits")], "a STRING, b STRING, c STRING")
    after, inserted = C.upsert_paths(cat, paths, ["a", "b", "c"], now=NOW)
    got = rows(C.tag_view(inserted), "id", "pid", "level", "name")
    # level 1: 'places' (pid -1) -> 67; level 2: 'travel' under 1 -> 68;
    # level 3 ordered by (pid, name): 'habits' under 2 -> 69, 'trips' under 68 -> 70
    assert got == [(67, -1, 1, "places"), (68, 1, 2, "travel"), (69, 2, 3, "habits"), (70, 68, 3, "trips")]
    _, again = C.upsert_paths(after, paths, ["a", "b", "c"], now=NOW)
    assert again.count() == 0


def test_tag_without_model(spark):
    cat = _catalog(spark, BASE)
    models = spark.createDataFrame(
        [(1, 65, "m", "Main", "/p", "2,2019-09-24 06:15:00,2019-09-30 06:15:00", None, None, 3, "")], MODEL_CATALOG)
    out = {r["tag"]["id"]: r["model"] for r in C.tags_with_models(cat, models, 64).collect()}
    assert out[66] is None
    assert out[65]["schedule"]["frequency"] == 2 and out[65]["state"] == 3


def test_add_model_tags_and_state_changes(spark):
    cat = _catalog(spark, BASE)
    empty = spark.createDataFrame([], MODEL_CATALOG)
    req = spark.createDataFrame(
        [("b", 3, "r2", "mb", "B", "/b", "", 1, 2, dt.datetime(2019, 9, 24, 6, 15), dt.datetime(2019, 9, 30)),
         ("a", 3, "r1", "ma", "A", "/a", "", 1, 3, dt.datetime(2019, 9, 24, 6, 15), dt.datetime(2019, 9, 30))],
        "name STRING, pid LONG, rule STRING, model_name STRING, model_main STRING, model_path STRING, "
        "args STRING, state INT, frequency INT, start TIMESTAMP_NTZ, end TIMESTAMP_NTZ")
    tags, models = C.add_model_tags(cat, empty, req, ["name"], now=NOW)
    assert rows(tags, "id", "name", "level") == [(67, "a", 4), (68, "b", 4)]
    assert rows(models, "id", "tag_id", "sche_time") == [
        (1, 67, "3,2019-09-24 06:15:00,2019-09-30 00:00:00"), (2, 68, "2,2019-09-24 06:15:00,2019-09-30 00:00:00")]
    changes = spark.createDataFrame([(67, 3, dt.datetime(2020, 1, 1)), (67, 4, dt.datetime(2020, 1, 2)),
                                     (99, 3, dt.datetime(2020, 1, 3))], "tag_id LONG, state INT, changed_at TIMESTAMP")
    after = C.apply_state_changes(models, changes)
    assert rows(after, "tag_id", "state") == [(67, 4), (68, 1)]


def test_sequential_id_matches_row_number(spark):
    from pyspark.sql import Window
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k")).repartition(7)
    got = with_sequential_id(df, ["k"], 100)
    ref = df.select("k", (F.row_number().over(Window.orderBy("k")) + 99).alias("id"))
    assert rows(got, "k", "id") == rows(ref, "k", "id")


def test_value_tags(spark):
    cat = _catalog(spark, BASE)
    req = spark.createDataFrame([("nurse", 64, "3")], "name STRING, pid LONG, rule STRING")
    out = C.add_value_tags(cat, req, ["name"], now=NOW).first()
    assert (out["id"], out["level"], out["pid"], out["rule"]) == (67, 5, 64, "3")


def test_catalog_scans_from_parquet_conform(spark, tmp_path):
    from tagweave.sources.catalog import load_model_catalog, load_tag_catalog
    raw = spark.createDataFrame([(1, -1, 1, "a", None), (2, 1, 2, "b", "x=1")],
                                "id INT, pid INT, level LONG, name STRING, rule STRING")
    path = str(tmp_path / "tags")
    raw.write.parquet(path)
    tags = load_tag_catalog(spark, path)
    assert tags.schema == TAG_CATALOG
    assert rows(tags, "id", "level") == [(1, 1), (2, 2)]
    models = load_model_catalog(spark, spark.createDataFrame([(1, 2)], "id INT, tag_id INT"))
    assert models.schema == MODEL_CATALOG and models.first()["state"] is None


def test_duplicate_tag_id_is_an_error(spark):
    import pytest
    from tagweave.operators.lookup import source_spec_of
    cat = _catalog(spark, BASE + [(64, 3, 4, "job again", "inType=parquet")])
    with pytest.raises(LookupError):
        source_spec_of(cat, 64)
    assert source_spec_of(_catalog(spark, BASE), 64)["selectFields"] == "id,job"


def test_state_change_ties_are_repeatable(spark):
    models = spark.createDataFrame([(1, 67, "m", "M", "/p", None, None, None, 1, "")], MODEL_CATALOG)
    t = dt.datetime(2020, 1, 1)
    for order in ([(67, 2, t), (67, 4, t), (67, 3, t)], [(67, 4, t), (67, 3, t), (67, 2, t)]):
        changes = spark.createDataFrame(order, "tag_id LONG, state INT, changed_at TIMESTAMP").repartition(3)
        assert C.apply_state_changes(models, changes).first()["state"] == 4


def test_path_without_level_1_is_an_error(spark):
    import pytest

    from tagweave.operators.catalog_ops import upsert_paths
    from tagweave.schemas import TAG_CATALOG
    paths = spark.createDataFrame([("a", "b"), (None, "c")], "l1 STRING, l2 STRING")
    with pytest.raises(ValueError, match="no l1"):
        upsert_paths(spark.createDataFrame([], TAG_CATALOG), paths, ["l1", "l2"])[1].collect()
