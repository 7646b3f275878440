"""Column expressions against plain-Python models of the documented semantics."""

from hypothesis import given, settings
from hypothesis import strategies as st

from tagweave.functions.rules import parse_rule
from tagweave.functions.tags import merge_tags


def _empty(x, blank):
    return x is None or (x.strip() == "" if blank == "blank" else x == "")


def merge_model(first, second, blank):
    if _empty(first, blank):
        return second
    if _empty(second, blank):
        return first
    out = []
    for item in first.split(",") + second.split(","):
        if item and item not in out:
            out.append(item)
    return ",".join(out)


def parse_model(rule):
    if rule is None:
        return None
    m = {}
    for item in rule.split("##"):
        if not item:
            continue
        parts = item.split("=")
        m.pop(parts[0], None)
        m[parts[0]] = parts[1] if len(parts) > 1 else None
    return m


tag_text = st.one_of(st.none(), st.lists(st.sampled_from(["", " ", "65", "70", "1", "65"]), max_size=4).map(",".join))


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(tag_text, tag_text), min_size=1, max_size=30))
def test_merge_matches_model(spark, pairs):
    df = spark.createDataFrame(pairs, "a STRING, b STRING")
    got = df.select(merge_tags("a", "b", "empty").alias("e"), merge_tags("a", "b", "blank").alias("k")).collect()
    for (a, b), r in zip(pairs, got):
        assert r["e"] == merge_model(a, b, "empty")
        assert r["k"] == merge_model(a, b, "blank")


item = st.one_of(
    st.tuples(st.sampled_from(["a", "b", "inType", "family"]), st.sampled_from(["", "x", "y=z", "1"]))
    .map(lambda kv: f"{kv[0]}={kv[1]}"),
    st.sampled_from(["", "flag"]))
rule_text = st.one_of(st.none(), st.lists(item, max_size=6).map("##".join))


@settings(max_examples=20, deadline=None)
@given(st.lists(rule_text, min_size=1, max_size=30))
def test_parse_matches_model(spark, rules):
    df = spark.createDataFrame([(r,) for r in rules], "rule STRING")
    got = [r["m"] for r in df.select(parse_rule("rule").alias("m")).collect()]
    for text, m in zip(rules, got):
        assert m == parse_model(text), text


def upsert_paths_model(catalog, paths, depth):
    """Level by level: find (name, level, pid) or insert; new ids by (pid, name)."""
    nodes = {(lvl, name, pid): i for i, pid, lvl, name in sorted(catalog, reverse=True)}  # oldest id wins
    next_id = max((c[0] for c in catalog), default=0) + 1
    inserted = []
    resolved = {(): -1}
    for level in range(1, depth + 1):
        wanted = set()
        for p in paths:
            prefix = tuple(p[:level])
            if None in prefix or prefix[:-1] not in resolved:
                continue
            wanted.add((prefix, resolved[prefix[:-1]]))
        new = sorted({(pid, prefix[-1]) for prefix, pid in wanted if (level, prefix[-1], pid) not in nodes})
        for pid, name in new:
            nodes[(level, name, pid)] = next_id
            inserted.append((next_id, pid, level, name))
            next_id += 1
        for prefix, pid in wanted:
            resolved[prefix] = nodes[(level, prefix[-1], pid)]
    return sorted(inserted)


names = st.sampled_from(["a", "b", "c"])
path = st.lists(st.one_of(names, st.none()), min_size=4, max_size=4) \
    .filter(lambda p: p[0] is not None or not any(p))  # a path without level 1 is an error
# a consistent tree: each node's parent is an earlier node (one level up) or the root
existing = st.lists(st.tuples(names, st.integers(0, 10)), max_size=6)


def _tree(rows_):
    catalog = []
    for name, pick in rows_:
        parents = [(-1, 0)] + [(i, lvl) for i, _, lvl, _ in catalog]
        pid, plevel = parents[pick % len(parents)]
        if plevel < 4:
            catalog.append((len(catalog) + 1, pid, plevel + 1, name))
    return catalog


@settings(max_examples=6, deadline=None)
@given(existing, st.lists(path, min_size=1, max_size=8))
def test_path_upsert_matches_model(spark, rows_, paths):
    import datetime as dt
    from tagweave.operators.catalog_ops import upsert_paths
    from tagweave.schemas import TAG_CATALOG
    catalog = _tree(rows_)
    cat = spark.createDataFrame([(i, p, lv, n, None, None, None) for i, p, lv, n in catalog], TAG_CATALOG)
    pdf = spark.createDataFrame(paths, "l1 STRING, l2 STRING, l3 STRING, l4 STRING")
    _, inserted = upsert_paths(cat, pdf, ["l1", "l2", "l3", "l4"], now=dt.datetime(2020, 1, 1))
    got = sorted((r["id"], r["pid"], r["level"], r["name"]) for r in inserted.collect())
    assert got == upsert_paths_model(catalog, paths, 4)


def _ranges_from(cuts):
    """Non-overlapping inclusive ranges from sorted distinct cut points (some gaps)."""
    pts = sorted(set(cuts))
    return [(pts[i], pts[i + 1] - 1 - (i % 3 == 2), 300 + i) for i in range(len(pts) - 1)
            if pts[i] <= pts[i + 1] - 1 - (i % 3 == 2)]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 200), min_size=2, max_size=30),
       st.lists(st.one_of(st.none(), st.integers(-5, 210)), min_size=1, max_size=60))
def test_large_range_path_matches_case_path(spark, cuts, values):
    from pyspark.sql import functions as F
    from tagweave.operators.match import match_ranges
    ranges = _ranges_from(cuts)
    if not ranges:
        return
    src = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "id STRING, v BIGINT")
    rules = spark.createDataFrame(ranges, "lo LONG, hi LONG, id INT")
    big = match_ranges(src, F.col("v"), rules, max_broadcast_rows=1)   # forces the sort-based path
    case = match_ranges(src, F.col("v"), ranges)
    assert sorted(big.collect()) == sorted(case.collect())
