import zlib
from hashlib import sha256

import pytest

from tagweave.llm import merkle as M
from tests_llm_rows import SCHEMA, doc_rows, no_docs  # noqa: F401

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(r, text):
    fields = (r[0], r[3], r[2], r[4], text)
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields])


def first_null(v):
    return (v is not None, v if v is not None else 0)


def climb(nodes, at, hash_):
    """(top hash folded from ``hash_`` at place ``at``, siblings, top hash) of a list of digests."""
    siblings = []
    while len(nodes) > 1:
        lo = at // 8 * 8
        run = nodes[lo:lo + 8]
        siblings += [x for k, x in enumerate(run) if lo + k != at]
        run[at - lo] = hash_
        hash_ = h(*run)
        nodes = [h(*nodes[k:k + 8]) for k in range(0, len(nodes), 8)]
        at //= 8
    return hash_, siblings, nodes[0]


def brute(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: sorted([r for r in rows if r[2] == x], key=lambda r: (first_null(r[0]), leaf(r, r[1]))) for x in langs}
    leaves = {x: [leaf(r, r[1]) for r in trees[x]] for x in langs}
    subroots = [climb(leaves[x], 0, leaves[x][0])[2] for x in langs]
    root = climb(subroots, 0, subroots[0])[2]
    out = []
    for k, x in enumerate(langs):
        for at, r in enumerate(trees[x]):
            text = r[1]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and text is not None:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            folded, below, _ = climb(leaves[x], at, leaf(r, text))
            folded, above, _ = climb(subroots, k, folded)
            out.append((r[0], leaves[x][at], subroots[k], root, h(*below, *above), folded, folded == root))
    return sorted(out, key=str)


def got(df):
    out = M.verify(df)
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, out.collect()), key=str)


AWKWARD = [(200, "ÀB c", "fr", None, None), (None, "Null Id", "fr", "s", 1), (None, None, None, None, None),
           (201, "Lone", "zz", "s", 4), (202, "lone 東京 İ", "ßß", "s", 4), (-3, "Below Zero", "en", "s", 4)]


def test_whole_result(spark):
    rows = doc_rows() + AWKWARD
    found = got(spark.createDataFrame(rows, DOCS).repartition(5))
    assert found == brute(rows)
    assert {r[6] for r in found} == {True, False}


def test_several_levels_and_copies_of_high_nodes(spark, monkeypatch):
    monkeypatch.setattr(M, "SPREAD", 5)
    rows = [(k, f"Text {k % 40}" if k % 7 else f"text {k}", "en" if k < 600 else f"l{k % 70}", "s", k) for k in range(700)]
    found = got(spark.createDataFrame(rows, DOCS))
    assert found == brute(rows)
    assert any(r[6] for r in found if zlib.crc32(str(r[0]).encode()) % 3 == 0)  # nothing to lower-case


@pytest.mark.parametrize("n", [1, 9])
def test_small_trees(spark, n):
    rows = [(k, "A", "en", "s", 1) for k in range(n)]
    found = got(spark.createDataFrame(rows, DOCS))
    assert found == brute(rows)
    if n == 1:
        assert found[0][1] == found[0][2] == found[0][3] and found[0][4] == h()


def test_hot_repeated_row_empty_and_clashing(spark, no_docs):
    rows = [(7, "Same Row", "en", "s", 8)] * 100 + doc_rows(n=30)
    odd = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as g", "2 as grp", "3 as leaf", "4 as k", "5 as id", "6 as up")
    assert got(odd) == brute(rows)
    assert M.verify(no_docs.withColumnRenamed("size", "n_chars")).collect() == []


def test_recursion_limit_is_put_back(spark):
    name = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "12")
    try:
        rows = [(k, "A b", "en", "s", 1) for k in range(20)]
        assert got(spark.createDataFrame(rows, DOCS)) == brute(rows)
        assert spark.conf.get(name) == "12"
    finally:
        spark.conf.set(name, before)


def test_numbers_and_other_fields(spark):
    rows = [("b", "X", "g1"), ("a", "Y", "g1"), (None, "Z", None)]
    m = M.build(spark.createDataFrame(rows, "name string, body string, part string"), "name", "part", "body", ("name", "body"))
    one, two = h("1:a", "1:Y"), h("1:b", "1:X")
    assert m.root == h(h("-", "1:Z"), h(one, two))
    assert m.groups.count() == 2 and m.nodes.count() == 2
