import itertools
import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from tagweave.llm import mixing
from tests_llm_rows import doc_rows, docs, no_docs, words  # noqa: F401


def test_fit_is_exact_on_small_sets():
    rng = random.Random(3)
    for _ in range(150):
        sizes = sorted(rng.sample(range(1, 40), rng.randrange(1, 6)))
        counts = [rng.randrange(1, 4) for _ in sizes]
        total = sum(s * c for s, c in zip(sizes, counts))
        budget = rng.randrange(total)
        got = mixing.fit(np.array(sizes), np.array(counts), budget)
        assert all(0 <= g <= c for g, c in zip(got, counts))
        sums = [sum(s * k for s, k in zip(sizes, pick)) for pick in itertools.product(*[range(c + 1) for c in counts])]
        reached = int(sum(s * g for s, g in zip(sizes, got)))
        # the proportional share comes first, so the nearest sum may be out of reach
        assert abs(reached - budget) - min(abs(s - budget) for s in sums) <= max(sizes)
        if all(c == 1 for c in counts):
            assert abs(reached - budget) == min(abs(s - budget) for s in sums)


def test_fit_large_budget_is_met():
    sizes = np.arange(1, 2001)
    counts = np.full(2000, 50)
    budget = 60_000_003
    assert int((mixing.fit(sizes, counts, budget) * sizes).sum()) == budget


def waterfill(sizes, weights=(5, 2, 1), cap=3):
    """Share, cap, reshare the excess among the rest, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, fixed = float(sum(sizes.values())), {}
    while True:
        rest = [s for s in names if s not in fixed]
        share = {s: left * w[s] / sum(w[x] for x in rest) for s in rest}
        over = [s for s in rest if share[s] > cap * sizes[s]]
        if not over:
            return fixed | share
        for s in over:
            fixed[s] = float(cap * sizes[s])
            left -= fixed[s]


def test_targets_match_resharing(spark):
    rng = random.Random(4)
    for _ in range(4):
        sizes = {f"s{i}": rng.choice([0, 1, 10, 100, 1000, 10000]) for i in range(rng.randrange(1, 9))} | {None: 77}
        got = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
        want = waterfill(sizes)
        for r in got.collect():
            assert abs(r["target"] - want[r["source"]]) < 1e-6 * max(1, want[r["source"]])


def test_mix(docs):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(doc_rows())
    by = defaultdict(list)
    for r in rows:
        assert r["size"] == len(words(r["text"])) and r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        by[r["source"]].append(r)
    want = waterfill({s: sum(r["size"] for r in x) for s, x in by.items()})
    for s, x in by.items():
        assert abs(x[0]["target"] - want[s]) < 1e-6 * want[s] and {r["target"] for r in x} == {x[0]["target"]}
        longest = max(r["size"] for r in x)
        assert abs(want[s] - sum(r["taken"] for r in x)) <= (150 if longest < 1000 else longest / 2)
    again = mixing.mix(docs.repartition(5)).collect()
    key = lambda r: (r["doc_id"] or -1, r["text"] or "", r["copies"])
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_join_beyond_the_broadcast_bound(docs, monkeypatch):
    want = sorted((r["doc_id"] or -1, r["taken"]) for r in mixing.mix(docs).collect())
    monkeypatch.setattr(mixing, "bounded_broadcast", lambda df: df)
    assert sorted((r["doc_id"] or -1, r["taken"]) for r in mixing.mix(docs).collect()) == want


def test_hot_length_is_split_by_hash(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"),
                                    F.when(F.col("id") < 2900, "x").otherwise("y").alias("source"))
    got = {r["source"]: r["t"] for r in mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("t")).collect()}
    # y stops at three times its size; x takes the rest
    assert got == {"y": 900, "x": 8100}


def test_expand_and_empty(docs, no_docs):
    mixed = mixing.mix(docs)
    assert mixing.expand(mixed, docs.columns).count() == mixed.agg(F.sum("copies")).first()[0]
    assert mixing.mix(no_docs).collect() == []


def test_source_of_empty_texts_only(spark):
    rows = [(1, "a b c", "x"), (2, "a b", "x"), (3, None, "y"), (4, "", "y"), (5, " \t\n", "y"), (6, None, None)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {r["doc_id"]: (r["source_size"], r["target"], r["copies"], r["taken"]) for r in got} == {
        1: (5, 5.0, 1, 3), 2: (5, 5.0, 1, 2), **{i: (0, 0.0, 0, 0) for i in (3, 4, 5, 6)}}
    empty = mixing.mix(spark.createDataFrame(rows[2:], "doc_id long, text string, source string")).collect()
    assert sorted((r["doc_id"], r["copies"], r["taken"]) for r in empty) == [(i, 0, 0) for i in (3, 4, 5, 6)]
