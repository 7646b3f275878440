import random
import zlib
from collections import Counter

from tagweave.llm import sharding
from tests_llm_rows import doc_rows, docs, no_docs  # noqa: F401


def test_matrix_has_exact_margins():
    rows = [random.Random(i).randrange(200) for i in range(40)]
    m = sharding.matrix(rows, 16, seed=5)
    assert [sum(line) for line in m] == rows and all(x >= 0 for line in m for x in line)
    totals = [sum(line[s] for line in m) for s in range(16)]
    assert max(totals) - min(totals) <= 1 and sum(totals) == sum(rows)


def test_hypergeometric_law():
    rng = random.Random(1)
    got = Counter(sharding.hypergeometric(rng, 5, 7, 4) for _ in range(40_000))
    from math import comb
    for k in range(5):
        want = comb(5, k) * comb(7, 4 - k) / comb(12, 4)
        assert abs(got[k] / 40_000 - want) < 0.01
    big = [sharding.hypergeometric(rng, 10**9, 15 * 10**9, 10**6) for _ in range(200)]
    assert abs(sum(big) / 200 - 62_500) < 100


def test_shards(docs):
    rows = sharding.shard(docs).collect()
    assert len(rows) == len(doc_rows())
    counts = Counter(r["shard"] for r in rows)
    assert set(counts) == set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    for s, n in counts.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n))
    for r in rows:
        data = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 1, zlib.crc32(data), "rows", None)
    key = lambda r: (r["doc_id"] or -1, r["text"] or "", r["shard"], r["slot"])
    assert sorted(map(key, rows)) == sorted(map(key, sharding.shard(docs.repartition(7)).collect()))


def test_many_partitions_and_sub_buckets(spark):
    docs = spark.range(9000).selectExpr("id AS doc_id", "repeat('x', int(id % 7)) AS text")
    sharding_rows = sharding.ROWS_PER_PARTITION
    try:
        sharding.ROWS_PER_PARTITION = 50
        rows = sharding.shard(docs).select("doc_id", "shard", "slot").collect()
    finally:
        sharding.ROWS_PER_PARTITION = sharding_rows
    by = Counter(r["shard"] for r in rows)
    assert len(rows) == 9000 and set(by.values()) <= {562, 563}
    assert all(sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n)) for s, n in by.items())
    # shuffled: neighbours in id are not neighbours in slot
    place = {r["doc_id"]: (r["shard"], r["slot"]) for r in rows}
    assert sum(place[i][0] == place[i + 1][0] for i in range(8999)) < 800


def test_empty(no_docs):
    assert sharding.shard(no_docs).collect() == []
