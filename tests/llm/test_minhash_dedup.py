import random

import numpy as np
import pyarrow as pa

from tagweave.llm import minhash_dedup as H
from tests_llm_rows import SCHEMA, doc_rows, docs, no_docs, prose, words  # noqa: F401


def shingle_set(text):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[k:k + 2]) for k in range(max(1, len(w) - 1))} if w else set()


def brute(rows):
    sets = [shingle_set(r[1]) for r in rows]
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    root[top(a)] = top(b)
    name = {}
    for a, r in enumerate(rows):
        if r[0] is not None:
            name[top(a)] = min(name.get(top(a), r[0]), r[0])
    out = [(r[0], len(sets[a]), name.get(top(a)), r[0] == name.get(top(a))) for a, r in enumerate(rows)]
    return sorted(out, key=str)


def got(spark, rows):
    out = H.dedup(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted(map(tuple, out.collect()), key=str)


def near_copies(n, seed=3, start=1000, edits=9):
    rng = random.Random(seed)
    base = prose(rng, 130).split()
    rows = []
    for k in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(1000)}"
        rows.append((start + k, " ".join(w), "en", "s", 0))
    return rows


def test_awkward_rows(spark):
    rows = doc_rows() + [(300, "Two Words", "en", "s", 0), (299, "two words", "en", "s", 0), (301, "WORD", "en", "s", 0),
                         (302, "word", "en", "s", 0), (303, "word word", "en", "s", 0), (304, "word word word", "en", "s", 0),
                         (None, "\t\n", "en", "s", 0), (None, "nobody's text", "en", "s", 0)]
    assert got(spark, rows) == brute(rows)


def test_links_at_the_threshold(spark):
    """Pairs of 80 and of 79 percent; the first is linked, the second isn't."""
    a = [f"a{k}" for k in range(10)]  # nine shingles: a text of eight of them has 8 / 9; seven 7 / 9
    rows = [(1, " ".join(a), "", "", 0), (2, " ".join(a[:9]), "", "", 0), (3, " ".join(a[:8]), "", "", 0)]
    b = [f"b{k}" for k in range(11)]  # ten shingles; eight of them: exactly 80
    rows += [(4, " ".join(b), "", "", 0), (5, " ".join(b[:9]), "", "", 0)]
    assert got(spark, rows) == brute(rows)
    by = {r[0]: r[2] for r in brute(rows)}
    assert by == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4}
    assert H.similar(np.arange(10), np.arange(8)) and not H.similar(np.arange(100), np.arange(79))
    assert not H.similar(np.arange(9), np.arange(7))


def test_groups_of_near_copies(spark, monkeypatch):
    """Small limits: every group becomes a hot node, met by pivots and then block by block; long sets count more."""
    for name, value in (("LEAF", 3), ("BLOCK", 7), ("LONG", 50)):
        monkeypatch.setattr(H, name, value)
    rows = near_copies(60) + near_copies(40, seed=4, start=2000, edits=30) + doc_rows(seed=5)
    assert got(spark, rows) == brute(rows)


def test_pivots_alone_do_not_decide(spark, monkeypatch):
    """A chain: neighbours are linked, the ends have little in common; one pivot sees only its own neighbours."""
    monkeypatch.setattr(H, "LEAF", 1)
    monkeypatch.setattr(H, "PIVOTS", 1)
    monkeypatch.setattr(H, "BLOCK", 4)
    rng = random.Random(6)
    w = [f"c{k}" for k in range(60)]
    rows = []
    for k in range(40):
        rows.append((k, " ".join(w), "", "", 0))
        w = list(w)
        w[rng.randrange(60)] = f"d{k}"
    assert got(spark, rows) == brute(rows)


def test_needed_texts_by_exchange(spark, monkeypatch):
    monkeypatch.setattr(H, "bounded_broadcast", lambda df: df)
    rows = near_copies(20, edits=4) + [(k, "same text of all rows", "", "", 0) for k in range(50, 90)]
    assert got(spark, rows) == brute(rows)


def test_recall_at_the_last_level():
    """Pairs just at the threshold stay together in some tree to the last level."""
    rng = np.random.default_rng(8)
    n = 4000
    value = rng.integers(0, 1 << 63, (n, 110)).astype(np.uint64)
    both = np.concatenate([np.concatenate([np.sort(v[:100]), np.sort(np.r_[v[:90], v[100:102]])]) for v in value])
    size = np.tile([100, 92], n)  # 90 of 102: 88 percent
    near = np.concatenate([np.concatenate([np.sort(v[:90]), np.sort(v[10:100])]) for v in value])  # 80 of 100
    for sets, sizes, most in ((both, size, 0), (near, np.full(2 * n, 90), 6)):
        starts = np.cumsum(sizes) - sizes
        paths = H.branches(H.minwise(sets, starts, H.trees() * H.DEPTH), H.trees())
        last = paths[:, H.DEPTH - 1::H.DEPTH]
        assert (~(last[::2] == last[1::2]).any(1)).sum() <= most
    assert H.trees() == 13


def test_clashing_names_and_empty(spark, no_docs, docs):
    odd = spark.createDataFrame(near_copies(8), SCHEMA).selectExpr(
        "*", "1 as id", "2 as t1", "3 as sid", "4 as n", "5 as name", "6 as label", "7 as node")
    assert sorted(map(tuple, H.dedup(odd).collect()), key=str) == brute(near_copies(8))
    assert H.dedup(no_docs).collect() == []
    ids = spark.createDataFrame([("b", "one text here"), ("a", "one text here")], "name string, body string")
    assert sorted(map(tuple, H.dedup(ids, "name", "body").collect())) == [("a", 2, "a", True), ("b", 2, "a", False)]


def test_sets_match_the_definition():
    texts = ["a", "a b", "A B a", "", None, " x\ty x y ", "é É"]
    value, size = H.text_sets(pa.array(texts))
    assert size.tolist() == [len(shingle_set(t)) for t in texts]
    assert value[1] in value[2:4]
