import datetime as dt
import tempfile

from conftest import rows
from tagweave.plans import models as M
from tagweave.plans.runner import STORE_SCHEMA, plan
from tagweave.schemas import CELLS, TAG_CATALOG
from tagweave.sources.store import TagStore
from tagweave.streaming import scheduled

RULE = "inType=cells##hbaseTable=users##family=base##selectFields=id,job##rowKey=id"


import pytest


@pytest.mark.parametrize("bucketed", [False, True])
def test_stream_batches_equal_full_run(spark, bucketed):
    root = tempfile.mkdtemp(prefix="tagweave-stream-", dir="/tmp")
    cells_path = f"{root}/cells"
    cat = spark.createDataFrame([(64, 3, 4, "job", RULE, None, None)] + [
        (64 + i, 64, 5, f"v{i}", str(i), None, None) for i in range(1, 7)], TAG_CATALOG)
    t1, t2 = dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2)
    first = spark.createDataFrame([("1", "base", "job", "3", t1), ("2", "base", "job", "5", t1),
                                   ("3", "base", "gender", "1", t1)], CELLS)
    second = spark.createDataFrame([("1", "base", "job", "1", t2), ("3", "base", "gender", "2", t2),
                                    ("4", "base", "job", "2", t2)], CELLS)
    model = M.TagModel("job", 64, M.rule_match("job"), merge="left", order="old_first")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions")) if bucketed else None
    store = TagStore(spark, f"{root}/store", buckets=buckets)
    store.commit(spark.createDataFrame([("2", "99"), ("9", "98")], STORE_SCHEMA), None)
    hist = store.read()

    table = None
    if bucketed:
        import uuid
        table = "stream_cells_" + uuid.uuid4().hex
        spark.sql(f"CREATE TABLE {table} (rowkey STRING, family STRING, qualifier STRING, value STRING, "
                  f"ts TIMESTAMP) USING parquet CLUSTERED BY (rowkey) INTO {buckets} BUCKETS "
                  f"LOCATION '{cells_path}'")
    def append(df):  # a bucketed cell table must be written bucketed, through the table
        if table:
            df.write.insertInto(table)
        else:
            df.write.mode("append").parquet(cells_path)

    append(first)
    q = scheduled.start(model, cat, cells_path, store, checkpoint_location=f"{root}/ckpt", cells_table=table)
    q.awaitTermination(120)
    append(second)
    q = scheduled.start(model, cat, cells_path, store, checkpoint_location=f"{root}/ckpt", cells_table=table)
    q.awaitTermination(120)

    # the same two scheduled runs done as full re-runs over the cells present each time
    after_first = spark.createDataFrame(rows(plan(model, cat, hist, {"users": first})), STORE_SCHEMA)
    full = plan(model, cat, after_first, {"users": first.unionByName(second)})
    got = dict(rows(store.read()))
    want = dict(rows(full))
    assert got == want and got["3"] == "0"
    assert got["1"] == "67,65" and got["2"] == "99,69" and got["4"] == "66" and got["9"] == "98"


def test_stream_needs_a_cells_source(spark):
    cat = spark.createDataFrame([(64, 3, 4, "job", "inType=parquet##hbaseTable=/x##selectFields=id,job", None, None)],
                                TAG_CATALOG)
    with pytest.raises(ValueError):
        scheduled.start(M.TagModel("job", 64, M.rule_match("job")), cat, "/tmp/none", TagStore(spark, "/tmp/none"),
                        checkpoint_location="/tmp/none-ckpt")
