"""Input columns named like an operator's helper columns are kept as they are."""

import pytest
from pyspark.sql import functions as F

from tagweave.llm import jaccard_join, mixing, sharding
from tagweave.llm.common import set_aside
from tests_llm_rows import doc_rows, docs, no_docs  # noqa: F401


def test_set_aside(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, _H int, _H_0 int")
    out, back = set_aside(df, ["_h", "_x"])
    assert out.columns == ["a", "_H_1", "_H_0"] and out.withColumnsRenamed(back).columns == df.columns


def extra(docs, names):
    return docs.withColumns({n: F.concat(F.lit("x"), F.coalesce("text", F.lit(""))) for n in names})


@pytest.mark.parametrize("names", [["_sh_1", "_sh_p"], ["_SH_CUTS", "_sh_in"]])
def test_sharding(docs, names):
    rows = sharding.shard(extra(docs, names)).collect()
    assert len(rows) == len(doc_rows()) and all(r[n] == "x" + (r["text"] or "") for r in rows for n in names)
    assert {(r["doc_id"], r["shard"]) for r in rows} == {(r["doc_id"], r["shard"]) for r in sharding.shard(docs).collect()}


def test_mixing(docs):
    names = ["_mix_hash", "_p_size", "_copy"]
    rows = extra(docs, names)
    mixed = mixing.mix(rows)
    assert all(r[n] == "x" + (r["text"] or "") for r in mixed.collect() for n in names)
    assert {(r["doc_id"], r["taken"]) for r in mixed.collect()} == {(r["doc_id"], r["taken"]) for r in mixing.mix(docs).collect()}
    whole = mixing.expand(mixed, rows.columns).collect()
    assert whole and all(r["_copy"] == "x" + r["text"] for r in whole)


def test_keep_one(docs):
    rows = jaccard_join.keep_one(extra(docs, ["_jj_row"])).collect()
    assert rows and all(r["_jj_row"] == "x" + (r["text"] or "") for r in rows)
