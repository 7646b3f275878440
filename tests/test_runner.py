import datetime as dt
import tempfile

from conftest import SF_SMALL, rows
from tagweave.plans import models as M
from tagweave.plans import testbed as T
from tagweave.plans.runner import STORE_SCHEMA, plan, run
from tagweave.sources.store import TagStore

RULE = "inType=cells##hbaseTable=users##family=base##selectFields=id,job##rowKey=id"


def _setup(spark):
    from tagweave.schemas import TAG_CATALOG
    cat = spark.createDataFrame([(64, 3, 4, "job", RULE, None, None)] + [
        (64 + i, 64, 5, f"v{i}", str(i), None, None) for i in range(1, 7)], TAG_CATALOG)
    users = spark.createDataFrame([("1", "3"), ("10", "5"), ("100", "3"), ("101", "1"), ("7", "9")],
                                  "id STRING, job STRING")
    from pyspark.sql import functions as F
    from tagweave.sources.cells import to_cells
    import datetime as dt
    cells = to_cells(users, "id", "base", ts=F.lit(dt.datetime(2020, 1, 1)))
    return cat, {"users": cells}


def test_job_tag_inner_merge(spark):
    cat, tables = _setup(spark)
    store = TagStore(spark, tempfile.mkdtemp(prefix="tagweave-run-", dir="/tmp"))
    hist = spark.createDataFrame([("1", "34"), ("10", ""), ("100", "67,65"), ("555", "1")], STORE_SCHEMA)
    store.commit(hist, None)
    v = run(M.job_tag(), cat, store, tables)
    assert v == 2
    # inner: user 101 and 7 have no history -> not written; 555 kept
    assert rows(store.read()) == [("1", "34,67"), ("10", "69"), ("100", "67,65"), ("555", "1")]


def test_job_model_left_new_first(spark):
    cat, tables = _setup(spark)
    model = M.TagModel("m", 64, M.value_case("job", {"3": 262, "1": 260}), merge="left", order="new_first")
    hist = spark.createDataFrame([("1", "301,260"), ("101", "  ")], STORE_SCHEMA)
    out = plan(model, cat, hist, tables)
    assert rows(out) == [("1", "262,301,260"), ("10", None), ("100", "262"), ("101", "260"), ("7", None)]


def test_replace_keeps_old_when_no_tag(spark):
    cat, tables = _setup(spark)
    model = M.TagModel("g", 64, M.value_case("job", {"3": 257}), merge="replace")
    hist = spark.createDataFrame([("1", "258,9"), ("10", "258")], STORE_SCHEMA)
    out = plan(model, cat, hist, tables)
    assert rows(out) == [("1", "257"), ("10", "258"), ("100", "257"), ("101", None), ("7", None)]


def test_missing_tag_raises(spark):
    import pytest
    cat, tables = _setup(spark)
    with pytest.raises(LookupError):
        plan(M.TagModel("x", 999, M.rule_match("job")), cat, spark.createDataFrame([], STORE_SCHEMA), tables)


def test_user_count_kept(spark):
    cat = T.base_catalog(spark, SF_SMALL)
    users = T.users(spark, SF_SMALL)
    out = plan(M.age_model(), cat, T.history(spark, SF_SMALL), {T.USERS_TABLE: T.user_cells(spark, SF_SMALL)})
    ids = users.select("id").union(T.history(spark, SF_SMALL).select("userId")).distinct()
    assert users.count() < out.count() == ids.count()
    assert out.select("userId").distinct().count() == out.count()


def test_bucketed_store_runs_match_plain_store(spark):
    cat, tables = _setup(spark)
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hist = spark.createDataFrame([("1", "34"), ("10", ""), ("555", "1")], STORE_SCHEMA)
    results = []
    for buckets in (None, n_parts):
        store = TagStore(spark, tempfile.mkdtemp(prefix="tagweave-bk-", dir="/tmp"), buckets=buckets)
        store.commit(hist, None)
        run(M.TagModel("codes", 64, M.value_case("job", {"3": 262, "1": 260}), merge="left",
                       order="new_first"), cat, store, tables)
        run(M.TagModel("rules", 64, M.rule_match("job"), merge="inner", blank="empty"), cat, store, tables)
        results.append(rows(store.read()))
    assert results[0] == results[1]
    assert dict(results[0]) == {"1": "262,34,67", "10": "69", "100": "262,67", "101": "260,65",
                                "555": "1", "7": "0"}


def test_duplicate_user_ids_are_reported(spark):
    import pytest
    from tagweave.plans.runner import DuplicateKeyError
    cat, _ = _setup(spark)
    users = spark.createDataFrame([("1", "3"), ("1", "5"), ("2", "1")], "id STRING, job STRING")
    store = TagStore(spark, tempfile.mkdtemp(prefix="tagweave-dup-", dir="/tmp"))
    rule = "inType=table##hbaseTable=u##selectFields=id,job"
    cat2 = cat.where("id <> 64").unionByName(cat.where("id = 64").selectExpr(
        "id", "pid", "level", "name", f"'{rule}' AS rule", "ctime", "utime"))
    with pytest.raises(DuplicateKeyError):
        run(M.TagModel("j", 64, M.rule_match("job")), cat2, store, {"u": users}, check_unique=True)
    assert store.latest_version() is None


def test_bucketed_cells_and_store_run_without_big_shuffles(spark):
    """Cells bucketed by row key + store bucketed by user id: no large shuffle at all."""
    import uuid
    from pyspark.sql import functions as F
    from tagweave.sources.cells import to_cells
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        root = tempfile.mkdtemp(prefix="tagweave-cobucket-", dir="/tmp")
        users = spark.range(0, 2000).select(F.col("id").cast("string").alias("id"),
                                            (F.col("id") % 7).cast("string").alias("job"))
        name = "cells_" + uuid.uuid4().hex
        to_cells(users, "id", "base", ts=F.lit(dt.datetime(2020, 1, 1))).write.bucketBy(n, "rowkey") \
            .option("path", f"{root}/cells").saveAsTable(name)
        cat, _ = _setup(spark)
        store = TagStore(spark, f"{root}/store", buckets=n)
        store.commit(spark.createDataFrame([(str(i), "1") for i in range(0, 3000, 3)], STORE_SCHEMA), None)
        model = M.TagModel("j", 64, M.rule_match("job"), merge="left")
        snap = plan(model, cat, store.read(schema=STORE_SCHEMA), {"users": spark.table(name)})
        snap.write.format("noop").mode("overwrite").save()
        p = snap._jdf.queryExecution().executedPlan().toString()
        # the cells are scanned twice (values, row keys), the store once, all in place
        assert "SortMergeJoin" in p and p.count("Bucketed: true") == 3
        assert p.count("Exchange hashpartitioning") == 1  # only the tiny level-5 rule dedupe
        got = dict(rows(snap))
        assert len(got) == 2000 + len([i for i in range(2000, 3000) if i % 3 == 0])
        assert got["3"] == "1,67" and got["1"] == "65" and got["7"] == "0" and got["2997"] == "1"
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_run_redoes_the_merge_after_a_concurrent_publish(spark):
    from tagweave.sources.store import ConcurrentUpdateError
    cat, tables = _setup(spark)
    root = tempfile.mkdtemp(prefix="tagweave-retry-run-", dir="/tmp")

    class Racing(TagStore):
        """Another job publishes right before this job's first commit."""
        raced = False

        def commit(self, snapshot, base_version, sort_by_key=True):
            if not self.raced:
                self.raced = True
                TagStore(self.spark, self.path).commit(
                    self.spark.createDataFrame([("1", "999"), ("10", "34")], STORE_SCHEMA), base_version)
            return super().commit(snapshot, base_version, sort_by_key)

    store = Racing(spark, root)
    store.raced = True  # seed without a race
    store.commit(spark.createDataFrame([("1", "34")], STORE_SCHEMA), None)
    store.raced = False
    assert run(M.job_tag(), cat, store, tables) == 3  # version 2 was the other job's
    assert dict(rows(store.read())) == {"1": "999,67", "10": "34,69"}
    no_retry = Racing(spark, tempfile.mkdtemp(prefix="tagweave-retry-none-", dir="/tmp"))
    no_retry.raced = True
    no_retry.commit(spark.createDataFrame([("1", "34")], STORE_SCHEMA), None)
    no_retry.raced = False
    import pytest
    with pytest.raises(ConcurrentUpdateError):
        run(M.job_tag(), cat, no_retry, tables, retries=0)
