import re
from collections import Counter

from tagweave.llm import divergence_audit as A
from tests_llm_rows import SCHEMA, doc_rows, no_docs  # noqa: F401


def terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute(rows, min_docs=3, top=200):
    """The whole result by the definition, with Python's unbounded whole numbers."""
    held = [(r[2] or "", r[3] or "", Counter(terms(r[1]))) for r in rows]
    out = []
    for lang in {h[0] for h in held}:
        mine = [h for h in held if h[0] == lang]
        df = Counter(t for h in mine for t in h[2])
        kept = sorted((t for t in df if df[t] >= min_docs), key=str.encode)
        group = {}
        for _, source, c in mine:
            group.setdefault(source, Counter()).update({t: n for t, n in c.items() if df[t] >= min_docs})

        def shares(c):
            total = sum(c.values()) + len(kept)
            return {t: 1 + 1000000000 * (c[t] + 1) // total for t in kept}

        whole = shares(sum(group.values(), Counter()))
        p = {s: shares(c) for s, c in group.items()}
        f = lambda x, y: (x - y) * (x - y) // y
        for s in group:
            pair = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in group if o != s]
            term = [(t, f(p[s][t], whole[t])) for t in kept if group[s][t] and p[s][t] > whole[t]]
            for part, found in (("pair", pair), ("term", term)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, k) for k, (item, v) in enumerate(found, 1) if part == "pair" or k <= top]
    return sorted(out)


def got(spark, rows, **kw):
    df = A.audit(spark.createDataFrame(rows, SCHEMA).repartition(3), **kw)
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, df.collect()))


AWKWARD = [(100, "alone ALONE", "xx", "only", 0), (101, None, "yy", "a", 0), (102, "", "yy", None, 0),
           (103, "Été ÉTÉ été Z_z 東京 a1b", "fr", "a", 0), (104, "été z 東京 a b", "fr", "b", 0),
           (105, "été Z z a b", "fr", "b", 0), (105, "été Z z a b", "fr", "b", 0), (106, "12 34", "fr", "c", 0)]


def test_whole_result(spark):
    rows = doc_rows() + AWKWARD
    assert got(spark, rows) == brute(rows)


def test_tasks_hand_over_early(spark, monkeypatch):
    monkeypatch.setattr(A, "HELD", 3)
    monkeypatch.setattr(A, "CHUNK", 40)
    rows = doc_rows(n=40) + AWKWARD
    assert A.term_counts("Ab aB ".encode() * 50) == {b"ab": 100}
    assert got(spark, rows, min_docs=2, top=5) == brute(rows, 2, 5)


def test_clashing_names_and_empty(spark, no_docs):
    rows = [(k, f"w{k % 3} common", "en", f"s{k % 2}", 0) for k in range(9)]
    plain = spark.createDataFrame(rows, SCHEMA)
    odd = plain.selectExpr("*", "1 as term", "2 as n", "3 as docs", "4 as v", "5 as total", "6 as _salt", "7 as p")
    assert sorted(map(tuple, A.audit(odd).collect())) == brute(rows)
    assert A.audit(no_docs).collect() == []


def test_share_is_exact(spark):
    rows = [(0, 1), (0, 7), (6, 7), (123456789, 987654321987), (9 * 10**14, 8 * 10**15), (7, 3 * 10**9)]
    found = spark.createDataFrame(rows, "c long, t long").select(A.share(A.F.col("c"), A.F.col("t"))).collect()
    assert [r[0] for r in found] == [1 + 10**9 * (c + 1) // t for c, t in rows]


def test_many_groups_take_the_salted_join(spark, monkeypatch):
    from tagweave.llm import common
    monkeypatch.setattr(common, "bounded_broadcast", lambda df: df)
    rows = doc_rows()
    assert got(spark, rows) == brute(rows)
