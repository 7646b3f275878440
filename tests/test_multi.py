"""Several models in one pass leave the store as running them one after the other."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from tagweave.plans import models as M
from tagweave.plans.multi import plan_all, run_all
from tagweave.plans.runner import run
from tagweave.sources.cells import to_cells
from tagweave.sources.layers import LayeredStore
from tagweave.sources.store import TagStore
from test_catalog import _catalog

RULE = "inType=cells##hbaseTable=people##family=base##rowKey=id##selectFields="
CATALOG = [(64, 3, 4, "job", RULE + "id,job"), (65, 64, 5, "a", "1"), (66, 64, 5, "b", "2"),
           (256, 3, 4, "gender", RULE + "id,gender"), (274, 3, 4, "age", RULE + "id,birthday"),
           (61, 3, 4, "nation", "inType=parquet##hbaseTable=others##selectFields=id,nationality"), (70, 61, 5, "x", "7")]
MODELS = {"job": M.job_tag, "gender": M.gender_model, "age": M.age_model, "nation": M.nationality_tag,
          "any": lambda: M.TagModel("any", 61, M.rule_match("nationality", default=None), merge="left", order="new_first")}


def setup(spark):
    people = [(f"u{k}", str(k % 4) if k % 5 else None, str(k % 3), f"19{60 + k}-05-01" if k % 4 else None) for k in range(24)]
    cells = to_cells(spark.createDataFrame(people, "id string, job string, gender string, birthday string"), "id", "base",
                     ts=F.lit(dt.datetime(2020, 1, 1)))
    others = [(f"u{k}", "7" if k % 2 else "8") for k in range(12, 40)] + [("u13", "8"), ("u13", "7")]  # a repeated id
    tables = {"people": cells, "others": spark.createDataFrame(others, "id string, nationality string")}
    old = spark.createDataFrame([(f"u{k}", ["1,2", "", None, " ", "65"][k % 5]) for k in range(0, 50, 2)], "userId string, tagIds string")
    return _catalog(spark, CATALOG), tables, old


@pytest.mark.parametrize("names", [("nation",), ("age", "any", "nation", "job", "gender")])
def test_equals_one_after_the_other(spark, tmp_path, names):
    catalog, tables, old = setup(spark)
    models = [MODELS[n]() for n in names]
    single = TagStore(spark, f"file://{tmp_path}/single")
    single.upsert(old)
    for m in models:
        run(m, catalog, single, tables)
    want = sorted(map(tuple, single.read().collect()), key=str)
    assert sorted(map(tuple, plan_all(models, catalog, old, tables).collect()), key=str) == want
    for kind in (TagStore, LayeredStore):
        store = kind(spark, f"file://{tmp_path}/{kind.__name__}")
        store.upsert(old)
        assert run_all(models, catalog, store, tables) == 2
        assert sorted(map(tuple, store.read().collect()), key=str) == want


def test_into_an_empty_store(spark, tmp_path):
    catalog, tables, _ = setup(spark)
    models = [M.job_tag(), M.age_model(), M.gender_model()]
    found = []
    for kind, one in itertools.product((TagStore, LayeredStore), (True, False)):
        store = kind(spark, f"file://{tmp_path}/{kind.__name__}-{one}")
        if one:
            run_all(models, catalog, store, tables)
        else:
            for m in models:
                run(m, catalog, store, tables)
        found.append(sorted(map(tuple, store.read().select("userId", "tagIds").collect()), key=str))
    assert len(found[0]) == 24 and all(f == found[0] for f in found)


def test_one_scan_per_source(spark):
    catalog, tables, old = setup(spark)
    reads = []
    from tagweave.plans import multi
    real = multi.load_source
    multi.load_source = lambda s, spec, t: reads.append(spec["selectFields"]) or real(s, spec, t)
    try:
        plan_all([M.job_tag(), M.gender_model(), M.nationality_tag(), M.age_model()], catalog, old, tables)
    finally:
        multi.load_source = real
    assert reads == ["id,job,gender,birthday", "id,nationality"]


def test_the_plan_grows_with_the_models_not_as_their_power(spark):
    catalog, tables, old = setup(spark)
    models = [M.job_tag(), M.age_model(), MODELS["any"]()]
    size = [len(plan_all(models * n, catalog, old, tables)._jdf.queryExecution().optimizedPlan().toString()) for n in (1, 3)]
    assert size[1] < 6 * size[0]


def test_errors(spark, tmp_path):
    catalog, tables, old = setup(spark)
    with pytest.raises(ValueError):
        run_all([], catalog, TagStore(spark, f"file://{tmp_path}/x"))
    with pytest.raises(LookupError):
        plan_all([M.job_tag(), M.blacklist_tag()], catalog, old, tables)
    with pytest.raises(LookupError, match="not unique"):
        plan_all([M.job_tag()], catalog.unionByName(catalog), old, tables)
    tables["others"] = tables["others"].unionByName(spark.createDataFrame([(None, "7")], "id string, nationality string"))
    with pytest.raises(Exception, match="null key"):
        plan_all([MODELS["any"]()], catalog, old, tables).collect()
