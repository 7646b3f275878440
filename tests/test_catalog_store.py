"""The published catalog: both tables in one version, ids never given twice, concurrent ingests."""

import datetime as dt

import pytest

from conftest import rows
from tagweave.sources import catalog_store
from tagweave.sources.catalog_store import CatalogStore
from tagweave.sources.manifest import ConcurrentUpdateError
from test_catalog import BASE, NOW, _catalog

REQUEST = ("name STRING, pid LONG, rule STRING, model_name STRING, model_main STRING, model_path STRING, "
           "args STRING, state INT, frequency INT, start TIMESTAMP_NTZ, end TIMESTAMP_NTZ")


def asked(spark, *names):
    when = dt.datetime(2019, 9, 24, 6, 15)
    return spark.createDataFrame([(n, 3, "r", f"m-{n}", "Main", "/p", "", 1, 2, when, when) for n in names], REQUEST)


@pytest.fixture
def store(spark, tmp_path):
    s = CatalogStore(spark, f"file://{tmp_path}/catalog")
    s.start(_catalog(spark, BASE))
    return s


class _Beaten(CatalogStore):
    """Another ingest publishes after this one reserved its ids and before it publishes."""

    def __init__(self, spark, path, other):
        super().__init__(spark, path)
        self.other = other

    def _publish(self, row):
        if self.other:
            other, self.other = self.other, None
            other()
        super()._publish(row)


def test_two_ingests_at_once(spark, store):
    late = _Beaten(spark, store.path, lambda: store.add_model_tags(asked(spark, "b", "a"), ["name"], now=NOW))
    assert late.add_model_tags(asked(spark, "c", "d"), ["name"], now=NOW) == 3
    tags, models = store.read()
    added = rows(tags.where("id > 66"), "id", "name")
    assert [i for i, _ in added] == [67, 68, 69, 70]  # no id twice
    assert added == [(67, "c"), (68, "d"), (69, "a"), (70, "b")]
    assert rows(models, "id", "tag_id", "model_name") == [(1, 67, "m-c"), (2, 68, "m-d"), (3, 69, "m-a"), (4, 70, "m-b")]
    # every version holds a tag exactly if it holds its model
    for v in (1, 2, 3):
        tags, models = store.read(v)
        assert rows(tags.where("level = 4 and id > 66"), "id") == rows(models.selectExpr("tag_id as id"), "id")


def test_ids_after_a_failed_ingest(spark, store, monkeypatch):
    with monkeypatch.context() as m:
        m.setattr(store, "_append", lambda parts: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store.add_model_tags(asked(spark, "x"), ["name"], now=NOW)
    assert store.latest_version() == 1 and store.models().count() == 0
    store.add_model_tags(asked(spark, "y"), ["name"], now=NOW)
    assert rows(store.tags().where("id > 66"), "id", "name") == [(68, "y")]  # 67 stays unused


def test_path_requests_beside_an_ingest(spark, store):
    nodes = spark.createDataFrame([(1, 2, "travel", 1, None), (1, 3, "trips", None, None), (2, 3, "profile", 2, None)],
                                  "path_id long, level int, name string, pid long, rule string")
    late = _Beaten(spark, store.path, lambda: store.upsert_nodes(nodes, now=NOW))
    assert late.upsert_nodes(nodes, now=NOW) == 2  # found on top of the other's version: nothing to insert
    got = rows(store.tags().where("id > 66"), "id", "pid", "name")
    assert [(p, n) for _, p, n in got] == [(1, "travel"), (got[0][0], "trips")]
    assert store.upsert_nodes(nodes, now=NOW) == 2


def test_values_and_states(spark, store):
    store.add_model_tags(asked(spark, "a", "b"), ["name"], now=NOW)
    store.add_value_tags(spark.createDataFrame([("v", 67, "1"), ("u", 67, "0")], "name string, pid long, rule string"), ["name"], now=NOW)
    changes = spark.createDataFrame([(67, 3, 1), (67, 4, 2), (5, 9, 9)], "tag_id long, state int, changed_at int")
    late = _Beaten(spark, store.path, lambda: store.add_model_tags(asked(spark, "c"), ["name"], now=NOW))
    assert late.change_states(changes) == 5
    assert rows(store.models(), "tag_id", "state") == [(67, 4), (68, 1), (71, 1)]
    assert rows(store.tags().where("level = 5 and id > 66"), "id", "name") == [(69, "u"), (70, "v")]
    assert rows(store.models(2), "tag_id", "state") == [(67, 1), (68, 1)]


def test_many_parts_are_folded(spark, store, monkeypatch):
    monkeypatch.setattr(catalog_store, "MAX_PARTS", 2)
    for name in "abcd":
        store.add_model_tags(asked(spark, name), ["name"], now=NOW)
    assert len(store.published()["tags"]) <= 2
    assert rows(store.tags().where("id > 66"), "id", "name") == [(67, "a"), (68, "b"), (69, "c"), (70, "d")]
    assert store.models().count() == 4


def test_start_once_and_empty(spark, store, tmp_path):
    with pytest.raises(ConcurrentUpdateError):
        store.start(_catalog(spark, BASE))
    new = CatalogStore(spark, f"file://{tmp_path}/new")
    assert new.latest_version() is None and new.tags().count() == 0 and new.models().count() == 0
    assert new.change_states(spark.createDataFrame([(1, 1, 1)], "tag_id long, state int, changed_at int")) is None
    assert new.add_model_tags(asked(spark, "a"), ["name"], now=NOW) == 1
    assert rows(new.tags(), "id") == [(1,)] and new.tags(1).columns == store.tags().columns


def test_reservations_do_not_overlap(spark, store):
    firsts = [CatalogStore(spark, store.path).reserve("tags", n) for n in (3, 0, 2, 1)]
    assert firsts == [67, 70, 70, 72]
    assert store.reserve("models", 1) == 1
