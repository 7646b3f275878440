"""Path requests with and without given parents, against working them one tag after the other."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tagweave.operators import catalog_ops as C
from test_catalog import BASE, NOW, _catalog

DDL = "path_id long, level int, name string, pid long, rule string, position int"


def one_by_one(catalog, requests):
    """Rows ``[id, pid, level, name, rule]`` after every request in turn (ids in order of insertion)."""
    found = [list(r) for r in catalog]
    for path in sorted({r[0] for r in requests}):
        last = None
        mine = [r for r in requests if r[0] == path]
        for _, level, name, pid, rule, _ in sorted(mine, key=lambda r: (r[1], r[5], r[2] or "")):
            if level == 1:
                pid = -1
            elif pid is None:
                pid = last
            hits = [r for r in found if r[1:4] == [pid, level, name]]
            if hits:
                last = min(r[0] for r in hits)
            else:
                last = max([r[0] for r in found], default=0) + 1
                found.append([last, pid, level, name, rule])
    return found


def named(tags, known):
    """The new tags by what doesn't depend on the numbering: their way up to a known or absent id."""
    by = {r[0]: r for r in tags}

    def way(i):
        return i if i not in by or i in known else (way(by[i][1]), by[i][2], by[i][3])
    return sorted(((way(r[0]), r[4]) for r in tags if r[0] not in known), key=str)


def check(spark, catalog, requests):
    cat = _catalog(spark, catalog)
    nodes = spark.createDataFrame(requests, DDL).repartition(3)
    after, inserted = C.upsert_nodes(cat, nodes, now=NOW)
    got = [list(r) for r in C.tag_view(after).collect()]
    known = {r[0] for r in catalog}
    assert named(got, known) == named(one_by_one(catalog, requests), known)
    fresh = sorted(r[0] for r in got if r[0] not in known)
    start = max(known, default=0) + 1
    assert fresh == list(range(start, start + len(fresh)))  # gapless, no id twice
    levels = [lv for _, lv in rows(C.tag_view(inserted), "id", "level")]
    assert levels == sorted(levels)
    frozen = spark.createDataFrame([tuple(r) + (None, None) for r in got], cat.schema)
    assert C.upsert_nodes(frozen, nodes, now=NOW)[1].count() == 0
    return got


def test_given_parents_beside_paths(spark):
    got = check(spark, BASE, [
        (1, 1, "people", None, "r1", 0), (1, 2, "travel", None, "r1", 0), (1, 3, "trips", None, "r1", 0),  # from the top
        (2, 2, "shopping", 1, "r2", 0), (2, 3, "habits", None, "r2", 0),  # under a given id, found
        (3, 2, "travel", 1, "r3", 0), (3, 3, "trips", None, "r3", 0),  # the same tag as in request 1, by its parent's id
        (4, 3, "habits", 2, "r4", 0),  # the same as in request 2
        (5, 3, "lost", 999, "r5", 0), (5, 4, "below lost", None, "r5", 0),  # a parent that is not there
        (6, 4, "alone", None, "r6", 0), (6, 5, "below alone", None, "r6", 0),  # no parent at all
        (7, 1, "places", 77, "r7", 0), (7, 2, "sea", None, "r7", 0),  # level 1 has parent -1 whatever is given
        (8, 2, "sea", None, "r8", 0), (8, 3, None, None, "r8", 0), (8, 3, "second", 3, None, 0)])
    by = {(r[3], r[2]): r for r in got}
    assert by["habits", 3][1] == 2 and by["habits", 3][4] == "r2" and by["travel", 2][4] == "r1"
    assert by["lost", 3][1] == 999 and by["below lost", 4][1] == by["lost", 3][0]
    assert by["alone", 4][1] is None and by["places", 1][1] == -1
    assert len([r for r in got if r[3] == "sea"]) == 2


def test_tags_of_one_level_follow_each_other(spark):
    """Two tags of a level in one request: the second hangs under the first, as the loop does it."""
    got = check(spark, BASE, [(1, 2, "first", 1, None, 0), (1, 2, "second", None, None, 1), (1, 3, "third", None, None, 0)])
    by = {r[3]: r for r in got}
    assert by["second"][1] == by["first"][0] and by["third"][1] == by["second"][0]


def test_found_without_parent(spark):
    got = check(spark, BASE + [(70, None, 4, "alone", None), (71, None, 4, "alone", None)],
                [(1, 4, "alone", None, "x", 0), (1, 5, "new", None, "x", 0)])
    assert [r[1] for r in got if r[3] == "new"] == [70]


@pytest.mark.parametrize("seed", range(2))
def test_random_forests(spark, seed):
    rng = random.Random(seed)
    requests = []
    for path in range(40):
        for level in sorted(rng.sample(range(1, 6), rng.randrange(1, 5))):
            pid = rng.choice([None, None, None, 1, 2, 3, 64, 500])
            requests.append((path, level, rng.choice(["a", "b", "people", "job", None]), pid, f"r{path}", 0))
    check(spark, BASE, requests)


def test_hot_parent_and_empty(spark):
    many = [(k, lv, n, None, None, 0) for k in range(400) for lv, n in ((1, "people"), (2, "hot"), (3, f"c{k % 5}"))]
    assert len(check(spark, BASE, many)) == len(BASE) + 6
    cat = _catalog(spark, BASE)
    after, inserted = C.upsert_nodes(cat, spark.createDataFrame([], DDL), now=NOW)
    assert inserted.count() == 0 and after.count() == len(BASE)
    none = _catalog(spark, [])
    _, first = C.upsert_nodes(none, spark.createDataFrame([(1, 1, "top", None, None)], DDL.rsplit(",", 1)[0]), now=NOW)
    assert rows(first, "id", "pid", "name") == [(1, -1, "top")]


def test_level_is_needed(spark):
    nodes = spark.createDataFrame([(1, None, "x", None, None, 0)], DDL)
    with pytest.raises(Exception, match="without a level"):
        C.upsert_nodes(_catalog(spark, BASE), nodes)


def test_clashing_columns(spark):
    nodes = spark.createDataFrame([(1, 2, "n", 1, "r", 0)], DDL).withColumn("anchor", F.lit(1)).withColumn("chain", F.lit(2)) \
        .withColumn("_depth", F.lit(3)).withColumn("first", F.lit(4))
    assert C.upsert_nodes(_catalog(spark, BASE), nodes, now=NOW)[1].count() == 1
