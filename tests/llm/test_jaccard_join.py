import random
from collections import Counter

import numpy as np

from tagweave.llm import jaccard_join as J
from tests_llm_rows import SCHEMA, doc_rows, docs, no_docs, prose, words  # noqa: F401


def brute(rows):
    """{row number: (class, links)} by comparing all pairs."""
    sets = []
    for r in rows:
        w = words(r[1])
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else None)
    root, links = list(range(len(rows))), Counter()

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                    links[a] += 1
                    links[b] += 1
                    root[top(a)] = top(b)
    name = {}
    for a, r in enumerate(rows):
        if r[0] is not None:
            name[top(a)] = min(name.get(top(a), r[0]), r[0])
    return sorted((r[0] if r[0] is not None else -1, name.get(top(a), -1), links[a]) for a, r in enumerate(rows))


def got(spark, rows):
    found = J.jaccard_join(spark.createDataFrame(rows, SCHEMA)).collect()
    none = lambda x: -1 if x is None else x
    return sorted((none(r["doc_id"]), none(r["class_id"]), r["n_links"]) for r in found)


def test_awkward_rows(spark):
    assert got(spark, doc_rows()) == brute(doc_rows())


def near_copies(n, seed=2):
    """A group of near copies at many distances, and copies of them."""
    rng = random.Random(seed)
    base = prose(rng, 120).split()
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randrange(5)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(1000)}"
        rows.append((i, " ".join(w), "en", "s", 0))
    return rows + [(n + i, rows[i][1], "en", "s", 0) for i in range(0, n, 3)]


def test_near_copies_lose_no_link(spark):
    assert got(spark, near_copies(60)) == brute(near_copies(60))


def test_large_leaves_are_split_and_blocked(spark, monkeypatch):
    monkeypatch.setattr(J, "LEAF", 8)
    monkeypatch.setattr(J, "BLOCK", 16)
    assert got(spark, near_copies(60, 4)) == brute(near_copies(60, 4))


def test_runs_reach_the_recall():
    assert J.runs(0.8) == 10 and (1 - 0.64) ** J.runs(0.8) < 1e-4


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (102, 103), (7, 200)]
    found = {r["node"]: r["component"] for r in J.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 200: 0, 100: 100, 101: 100, 102: 100, 103: 100}


def test_keep_one(spark, docs, no_docs):
    kept = J.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    want = set(range(60)) - {5, 7, 9, 14, 17, 18}
    assert {i for i in ids if i is not None} == want and len(ids) == len(set(ids))
    assert J.keep_one(no_docs).collect() == [] and J.jaccard_join(no_docs).collect() == []


def test_pairs_at_the_threshold_meet_at_the_last_level():
    n_runs = J.runs(J.THRESHOLD, depth=J.DEPTH)
    assert n_runs == 13 and (1 - 0.8 ** 3) ** n_runs < 1 - J.RECALL
    rng, n = np.random.default_rng(3), 20_000
    union = rng.integers(0, 1 << 63, (n, 50), np.uint64)  # 40 of 50 shared: exactly 0.8
    starts = np.arange(n) * 45
    a, b = (J.paths(J.signatures(x.ravel(), starts), n_runs)[:, :, -1] for x in (union[:, :45], np.delete(union, np.s_[40:45], 1)))
    missed = int((~(a == b).any(1)).sum())
    assert missed <= 8, missed  # 1.8 expected; 44 when runs share their min-hashes


def test_leaves_split_to_the_last_level_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(J, "LEAF", 1)
    rows = []
    for i in range(1500):  # pairs at exactly 0.8: 40 shared shingles of 50
        w = [f"{i}w{k}" for k in range(49)]
        rows += [(2 * i, " ".join(w), "en", "s", 0), (2 * i + 1, " ".join(w[:44] + [f"{i}v{k}" for k in range(5)]), "en", "s", 0)]
    found = J.jaccard_join(spark.createDataFrame(rows, SCHEMA))
    # 0.13 missed pairs expected, 3.3 when runs share their min-hashes
    assert found.where("n_links = 1 and class_id = doc_id - doc_id % 2").count() >= 2998
