"""Layered store: deltas of touched keys, merge on read, compaction, two writers, retention."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tagweave.operators.merge import merged_tag
from tagweave.sources.layers import LayeredStore
from tagweave.sources.manifest import ConcurrentUpdateError
from tagweave.sources.store import StoreSpec, TagStore, upsert_frame

MERGE = {"tagIds": lambda o, n: merged_tag(o, n, "old_first", "blank")}


def frame(spark, data, ddl="userId string, tagIds string"):
    return spark.createDataFrame(data, ddl)


@pytest.fixture
def store(spark, tmp_path):
    return LayeredStore(spark, f"file://{tmp_path}/layers")


def content(store):
    return rows(store.read())


def test_one_percent_writes_one_percent(spark, store):
    n = 20_000
    store.upsert(spark.range(n).select(F.col("id").cast("string").alias("userId"), F.lit("7").alias("tagIds")))
    part = spark.range(0, n, 100).select(F.col("id").cast("string").alias("userId"), F.lit("8").alias("tagIds"))
    store.upsert(part, combine=MERGE)
    base, delta = store.layers()
    assert (base["kind"], base["rows"], delta["kind"], delta["rows"]) == ("base", n, "delta", n // 100)
    assert delta["bytes"] < base["bytes"] / 20
    got = {r["userId"]: r["tagIds"] for r in store.read().collect()}
    assert len(got) == n and all(got[str(k)] == ("7,8" if k % 100 == 0 else "7") for k in range(n))


def test_reading_small_deltas_does_not_shuffle_the_base(spark, store):
    store.upsert(spark.range(1000).select(F.col("id").cast("string").alias("userId"), F.lit("7").alias("tagIds")))
    store.upsert(frame(spark, [("5", "8"), ("new", "9")]), combine=MERGE)
    plan = store.read()._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def random_rows(rng, n, keys):
    cell = lambda: rng.choice([None, "", " ", "1", "2,3", "3", "4,1"])
    return [(f"k{rng.randrange(keys)}", cell(), cell()) for _ in range(n)]


@pytest.mark.parametrize("seed", range(2))
def test_reads_equal_the_full_merge(spark, store, seed):
    """Any mix of upserts: layers read like the whole snapshots, before, between and after compactions."""
    rng = random.Random(seed)
    ddl = "userId string, tagIds string, note string"
    whole = None
    for step in range(5):
        new = frame(spark, random_rows(rng, 25, 30), ddl)
        fields = rng.choice([None, ["tagIds"], ["note"]])
        how = dict(fields=fields, combine=MERGE if rng.random() < .6 and fields != ["note"] else None,
                   insert_new=whole is None or rng.random() < .7)
        old = frame(spark, [], ddl) if whole is None else frame(spark, whole, ddl)
        want = upsert_frame(old, new, "userId", **how)
        store.upsert(new, **how)
        whole = [tuple(r) for r in want.select("userId", "tagIds", "note").collect()]
        names = [c for c in ("userId", "tagIds", "note") if c in store.read().columns]
        keep = [i for i, c in enumerate(("userId", "tagIds", "note")) if c in names]
        key = lambda t: tuple((x is not None, x or "") for x in t)
        expected = sorted([tuple(t[i] for i in keep) for t in whole], key=key)
        assert sorted(map(tuple, store.read().select(*names).collect()), key=key) == expected
        if step in (1, 3):
            store.compact(full=step == 3)
            assert sorted(map(tuple, store.read().select(*names).collect()), key=key) == expected


def test_nothing_changed_publishes_nothing(spark, store):
    new = frame(spark, [("a", "1"), ("b", "2")])
    assert store.upsert(new) == 1
    assert store.upsert(new) == 1 and store.upsert(new, combine=MERGE) == 1
    assert store.upsert(frame(spark, [("a", None)])) == 1
    assert store.upsert(frame(spark, [("z", "1")]), insert_new=False) == 1
    assert store.upsert(frame(spark, [("b", "3")]), combine=MERGE) == 2
    assert content(store) == [("a", "1"), ("b", "2,3")]


class _Other(LayeredStore):
    """Lets another writer publish just before this one does, once."""

    def __init__(self, *args, other=None, **kw):
        super().__init__(*args, **kw)
        self.other = other

    def _append(self, layer, base):
        if self.other:
            other, self.other = self.other, None
            other()
        return super()._append(layer, base)


def race(spark, store, mine, other):
    late = _Other(spark, store.path, other=other)
    deltas = []
    real = late._delta
    late._delta = lambda *a: deltas.append(1) or real(*a)
    late.upsert(mine, combine=MERGE)
    return len(deltas)


def test_two_writers_other_keys(spark, store):
    store.upsert(frame(spark, [("a", "1"), ("b", "1")]))
    other = lambda: store.upsert(frame(spark, [("b", "2")]), combine=MERGE)
    assert race(spark, store, frame(spark, [("a", "3"), ("c", "4")]), other) == 1  # published as computed
    assert content(store) == [("a", "1,3"), ("b", "1,2"), ("c", "4")]


def test_two_writers_same_key(spark, store):
    store.upsert(frame(spark, [("a", "1")]))
    other = lambda: store.upsert(frame(spark, [("a", "2"), ("n", "5")]), combine=MERGE)
    assert race(spark, store, frame(spark, [("a", "3"), ("n", "6")]), other) == 2  # computed again
    assert content(store) == [("a", "1,2,3"), ("n", "5,6")]


def test_two_first_writers(spark, store):
    other = lambda: store.upsert(frame(spark, [("a", "1")]))
    assert race(spark, store, frame(spark, [("a", "2"), ("b", "2")]), other) == 2
    assert content(store) == [("a", "1,2"), ("b", "2")]


def test_compaction_beside_a_writer(spark, store):
    store.upsert(frame(spark, [("a", "1"), ("b", "1")]))
    store.upsert(frame(spark, [("a", "2")]), combine=MERGE)
    assert race(spark, store, frame(spark, [("b", "3")]), store.compact) == 1  # only layers it had seen were folded
    assert content(store) == [("a", "1,2"), ("b", "1,3")]

    def later():
        store.upsert(frame(spark, [("b", "4")]), combine=MERGE)
        store.compact()
    assert race(spark, store, frame(spark, [("b", "5")]), later) == 2
    assert content(store) == [("a", "1,2"), ("b", "1,3,4,5")]


def test_writer_beside_a_compaction(spark, store, monkeypatch):
    store.upsert(frame(spark, [("a", "1")]))
    store.upsert(frame(spark, [("b", "2")]))
    slow = LayeredStore(spark, store.path)
    real = slow._write

    def write(f, kind):
        out = real(f, kind)
        store.upsert(frame(spark, [("a", "9")]), combine=MERGE)
        return out
    monkeypatch.setattr(slow, "_write", write)
    assert slow.compact() == 4
    assert [x["kind"] for x in store.layers()] == ["base", "delta"]
    assert content(store) == [("a", "1,9"), ("b", "2")]
    assert rows(store.read(2)) == [("a", "1"), ("b", "2")]


def test_maintain_and_expire(spark, store):
    store.upsert(frame(spark, [(f"k{i:02}", "1") for i in range(40)]))
    for i in range(4):
        store.upsert(frame(spark, [(f"k{i:02}", "2")]), combine=MERGE)
        assert store.maintain(max_deltas=3, share=0.5) == (None if i < 3 else 6)
    assert [x["rows"] for x in store.layers()] == [40, 4]
    before = content(store)
    gone = store.expire(keep=1)
    assert len(gone) == 4 and not any(store._exists(p) for p in gone)
    assert content(store) == before and store.latest_version() == 6
    with pytest.raises(LookupError):
        store.read(3)
    assert store.maintain(share=0.1) == 7 and content(store) == before
    assert store.upsert(frame(spark, [("k00", "3")]), combine=MERGE) == 8
    with pytest.raises(ValueError):
        store.expire(keep=0)


def test_new_columns_and_empty_store(spark, store):
    assert store.latest_version() is None and store.read().count() == 0 and store.compact() is None
    assert store.upsert(frame(spark, [("a", "1")]), insert_new=False) is None
    store.upsert(frame(spark, [("a", "1")]))
    store.upsert(frame(spark, [("a", 5), ("b", 6)], "userId string, score int"))
    store.upsert(frame(spark, [("b", 7)], "userId string, score int"))
    assert [tuple(r) for r in store.read().select("userId", "tagIds", "score").orderBy("userId").collect()] == \
        [("a", "1", 5), ("b", None, 7)]


def test_null_key_and_repeated_keys(spark, store):
    store.upsert(frame(spark, [("a", "1"), ("a", "2"), ("a", None)]))
    assert content(store) == [("a", "2")]
    with pytest.raises(Exception, match="null key"):
        store.upsert(frame(spark, [(None, "1")]))
    assert content(store) == [("a", "2")]


def test_spec_opens_layers(spark, tmp_path):
    spec = StoreSpec.from_options({"path": f"file://{tmp_path}/x", "rowKey": "userId", "selectFields": "tagIds", "layered": "true"})
    assert isinstance(spec.open(spark), LayeredStore)
    assert isinstance(StoreSpec(path=f"file://{tmp_path}/y").open(spark), TagStore)
    with pytest.raises(ValueError):
        StoreSpec.from_options({"path": "p", "layered": "true", "buckets": "4"})


def test_gives_up_after_retries(spark, store):
    store.upsert(frame(spark, [("a", "1")]))
    late = LayeredStore(spark, store.path)
    late._append = lambda layer, base: None
    with pytest.raises(ConcurrentUpdateError):
        late.upsert(frame(spark, [("a", "2")]), retries=1)
