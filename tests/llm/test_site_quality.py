import math
import random

import numpy as np
import pytest

from tagweave.llm import common
from tagweave.llm import site_quality as S
from tests_llm_rows import SCHEMA, doc_rows, docs, no_docs, prose  # noqa: F401

LABELS = "doc_id long, quality int, text string"


def corpus():
    rng = random.Random(4)
    rows = []
    for i in range(300):
        bad = i % 5 == 0
        text = prose(rng, 80)
        if bad:
            text = " ".join(w + "%%%" for w in text.split())
        rows.append((i, text, "en" if i % 3 else None, ["a", "b", "c", None][i % 4], 0, int(not bad)))
    return rows


def test_fit_separates():
    x = np.random.default_rng(1).normal(size=(400, len(S.FEATURES)))
    y = (x[:, 0] - 2 * x[:, 3] > 0).astype(float)
    model = S.fit(x, y)
    margin = model["weights"][0] + (x - model["mean"]) / model["scale"] @ model["weights"][1:]
    assert ((margin > 0) == (y > 0)).mean() > 0.97


def test_held_out_accuracy_and_shares(spark):
    rows = corpus()
    docs = spark.createDataFrame([r[:5] for r in rows], SCHEMA).repartition(3)
    labels = [(r[0], r[5], "clash") for r in rows[:150]] + [(None, 1, None), (3, None, None), (9999, 0, None)]
    labels = spark.createDataFrame(labels, LABELS)
    got = {r["doc_id"]: r for r in S.judge(docs, labels, S.train(docs, labels)).collect()}
    assert all(got[r[0]]["kept"] == bool(r[5]) for r in rows[150:])
    # the shares by their definition, from the evidence of all rows
    e = {r[0]: float(r[5]) if r[0] < 150 else got[r[0]]["text_score"] for r in rows}
    path = lambda r: (r[3], r[2])
    sums = {}
    for r in rows:
        for key in (("h", r[3]), ("p", path(r))):
            n, s = sums.get(key, (0, 0.0))
            sums[key] = n + 1, s + e[r[0]]
    share = sum(e.values()) / len(e)

    def strength(kind):
        groups = [v for k, v in sums.items() if k[0] == kind]
        n, s = sum(g[0] for g in groups), sum(g[1] for g in groups)
        nn, q = sum(g[0] ** 2 for g in groups), sum(g[1] ** 2 / g[0] for g in groups)
        return S._moments(len(groups), n, s, nn, q)

    hk, pk = strength("h"), strength("p")
    bound = lambda x: min(max(x, S.CLIP), 1 - S.CLIP)
    logit = lambda p: math.log(p / (1 - p))
    for r in rows:
        g, (hn, hs), (pn, ps) = got[r[0]], sums["h", r[3]], sums["p", path(r)]
        host = bound((hs - e[r[0]] + hk * share) / (hn - 1 + hk))
        site = bound((ps - e[r[0]] + pk * host) / (pn - 1 + pk))
        odds = logit(g["text_score"]) + logit(site) - logit(bound(share))
        assert abs(g["host_share"] - host) < 1e-9 and abs(g["path_share"] - site) < 1e-9
        assert abs(g["posterior"] - 1 / (1 + math.exp(-odds))) < 1e-9


def test_sparse_sites_fall_back():
    assert S._moments(1, 100, 50, 10000, 25) == 10.0  # one site says nothing about the spread
    tight = S._moments(10, 1000, 500, 100_000, 10 * 100 * 0.25)
    loose = S._moments(10, 1000, 500, 100_000, 5 * 100 * 0.81 + 5 * 100 * 0.01)
    assert tight > 1000 and loose < 2


def test_awkward_rows(spark, docs, no_docs):
    none = spark.createDataFrame([], LABELS)
    model = S.train(docs, none)
    got = S.judge(docs, none, model).collect()
    assert len(got) == len(doc_rows()) and all(r["text_score"] == pytest.approx(0.5) and r["kept"] is not None for r in got)
    assert S.judge(no_docs, none, S.train(no_docs, none)).collect() == []
    labels = spark.createDataFrame([(i, i % 2, "t") for i in range(40)], LABELS)
    assert S.judge(docs, labels, S.train(docs, labels)).count() == len(doc_rows())


def test_repeated_ids_whatever_the_order(spark):
    rows = [r[:5] for r in corpus()]
    rows += [(r[0], rows[-1 - k][1] + " %%%", *r[2:]) for k, r in enumerate(rows[:150])]  # every id has two texts
    labels = spark.createDataFrame([(i, int(i % 5 > 0), "t") for i in range(150)], LABELS)
    models = [S.train(spark.createDataFrame(r, SCHEMA), labels) for r in (rows, rows[::-1])]
    assert all(np.array_equal(models[0][k], models[1][k]) for k in models[0])


def test_sites_beyond_the_broadcast_bound(spark, monkeypatch):
    rows = corpus()
    docs = spark.createDataFrame([r[:5] for r in rows] + [(None, None, None, None, 0)], SCHEMA)
    labels = spark.createDataFrame([(r[0], r[5], "t") for r in rows[:150]], LABELS)
    model = S.train(docs, labels)
    near = sorted(S.judge(docs, labels, model).collect(), key=lambda r: r["doc_id"] if r["doc_id"] is not None else -1)
    monkeypatch.setattr(common, "bounded_broadcast", lambda df: df)
    far = sorted(S.judge(docs, labels, model).collect(), key=lambda r: r["doc_id"] if r["doc_id"] is not None else -1)
    assert len(near) == len(far) == len(rows) + 1
    for a, b in zip(near, far):
        assert (a["doc_id"], a["kept"]) == (b["doc_id"], b["kept"]) and abs(a["posterior"] - b["posterior"]) < 1e-9
