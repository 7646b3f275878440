import random

import pytest

import corpus_pipeline as C
from tagweave.llm import decontaminate, jaccard_join, mixing, quality_rules, token_output
from tests_llm_rows import doc_rows, prose

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(3)
    item = prose(rng, 30)
    rows = doc_rows(2, 80) + [(500, prose(rng, 90) + " " + item, "en", "s1", 0)]
    spark.createDataFrame(rows, COLUMNS).repartition(2).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_in_order(spark, folder):
    """Each stage's rows follow from what its predecessor kept."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [n for n, _ in C.STAGES]
    assert names == ["quality rules", "n-gram Jaccard join", "benchmark decontamination", "mixing sources", "token-ID output"]
    kept = [docs]
    for name, stage in C.STAGES[:-1]:
        kept.append(stage(spark, kept[-1], folder).cache())
        assert kept[-1].columns == docs.columns, name
    ids = [sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in k.collect()) for k in kept]
    judged = quality_rules.judge(docs, quality_rules.references(docs))
    assert ids[1] == sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in judged.where("kept").collect())
    classes = {r["doc_id"]: r["class_id"] for r in jaccard_join.jaccard_join(kept[1]).collect()}
    assert len(ids[2]) == len(set(classes.values())) and set(ids[2]) <= set(ids[1])
    leaks = {r["doc_id"] for r in decontaminate.leaks(kept[2], spark.read.parquet(f"{folder}/benchmark.parquet")).collect()}
    assert leaks == {500} and ids[3] == [i for i in ids[2] if i not in leaks]
    taken = {r["doc_id"]: r["copies"] for r in mixing.mix(kept[3]).collect()}
    assert ids[4] == sorted(i if i is not None else -1 for i, n in taken.items() for _ in range(n))
    last = C.STAGES[-1][1](spark, kept[4], folder).collect()
    assert sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in last) == ids[4]
    assert token_output.MAGIC == b"TWP1" and C.ORACLE_SQL is None


def test_run_and_empty(spark, folder, tmp_path):
    a, b = (sorted(map(tuple, C.run(spark, folder).collect()), key=str) for _ in range(2))
    assert a == b and a
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert C.run(spark, str(tmp_path)).collect() == []
