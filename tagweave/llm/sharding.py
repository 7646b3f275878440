"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

Rows lie in logical partitions (by a hash of id and text).  The number of rows that each
partition sends to each shard is drawn from the multivariate hypergeometric law, so a
random permutation of all rows is cut into shards whose row counts differ by at most one.
Each partition permutes its rows and cuts them by its row of the matrix; the rows are
exchanged; each shard permutes again (in sub-buckets of a second hash, so that no shard
is sorted by one task) and numbers its rows: ``slot``.

The driver draws the matrix from one count per partition (``MAX_PARTITIONS`` at most); all
row work is DataFrame functions.  The law is ``rows``; ``grown_shard`` is null.

Cases: a null or empty text has size 1 and the crc32 of no bytes (0); null ids are hashed
like any value; repeated rows (same id and text) are interchangeable; an empty table gives
no rows; an input column named like an added one is replaced, one named like a helper
column (``HELPERS``) is kept.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagweave.frames import literal_frame
from tagweave.llm.common import set_aside, stored

SHARDS = 16
ROWS_PER_PARTITION = 1000
MAX_PARTITIONS = 1 << 14
ADDED = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
HELPERS = ["_sh_1", "_sh_2", "_sh_p", "_sh_cuts", "_sh_place", "_sh_sub", "_sh_before", "_sh_in"]


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` items, drawn without replacement, are among the ``good`` ones.

    Inversion that starts at the mode and walks both ways, so it takes about as many
    steps as the law's standard deviation.
    """
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    lg = math.lgamma
    k = min(max((draws + 1) * (good + 1) // (good + bad + 2), low), high)
    p = math.exp(lg(good + 1) - lg(k + 1) - lg(good - k + 1) + lg(bad + 1) - lg(draws - k + 1)
                 - lg(bad - draws + k + 1) - lg(good + bad + 1) + lg(draws + 1) + lg(good + bad - draws + 1))
    u = rng.random() - p
    up, down, p_up, p_down = k, k, p, p
    while u > 0 and (up < high or down > low):
        if up < high:
            p_up *= (good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1))
            up += 1
            u -= p_up
            if u <= 0:
                return up
        if down > low:
            p_down *= down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1))
            down -= 1
            u -= p_down
            if u <= 0:
                return down
    return k


def matrix(rows: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows from each partition to each shard; shard totals differ by at most one."""
    rng = random.Random(seed)
    total = sum(rows)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    out = []
    for n in rows:
        line, left = [], sum(room)
        for s in range(shards):
            left -= room[s]
            line.append(hypergeometric(rng, room[s], left, n))
            n -= line[-1]
        room = [r - x for r, x in zip(room, line)]
        out.append(line)
    return out


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``size text_crc32 law shard slot grown_shard``."""
    docs, back = set_aside(docs, HELPERS)
    text = F.col(text_col).cast("string")
    first = F.xxhash64(F.lit(seed), F.col(id_col), text)
    second = F.xxhash64(F.lit(seed + 1), F.col(id_col), text)
    narrow = stored(docs.select(first.alias("_sh_1"), second.alias("_sh_2")), "shard-keys")
    partitions = min(max(narrow.count() // ROWS_PER_PARTITION, shards), MAX_PARTITIONS)
    bits = max(0, (partitions // shards).bit_length() - 1)
    pid = F.pmod(F.xxhash64("_sh_1"), F.lit(partitions)).cast("int")
    counts = sorted(tuple(r) for r in narrow.groupBy(pid.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    cuts = []
    for (p, _), line in zip(counts, matrix([n for _, n in counts], shards, seed)):
        ends, at = [], 0
        for n in line:
            at += n
            ends.append(at)
        cuts.append((p, ends))
    # one row per logical partition: MAX_PARTITIONS at most
    plan = F.broadcast(literal_frame(docs.sparkSession, cuts, "_sh_p INT, _sh_cuts ARRAY<LONG>"))

    def dealt(rows: DataFrame) -> DataFrame:
        place = F.row_number().over(W.partitionBy("_sh_p").orderBy("_sh_1", "_sh_2"))
        sub = F.shiftrightunsigned("_sh_2", 64 - bits).cast("int") if bits else F.lit(0)
        return (rows.withColumn("_sh_p", pid).withColumn("_sh_place", place).join(plan, "_sh_p", "left")
                .withColumn("shard", F.size(F.filter("_sh_cuts", lambda c: c < F.col("_sh_place"))))
                .withColumn("_sh_sub", sub))

    before = W.partitionBy("shard").orderBy("_sh_sub").rowsBetween(W.unboundedPreceding, -1)
    # one row per shard and sub-bucket: no more than there are logical partitions
    offsets = (dealt(narrow).groupBy("shard", "_sh_sub").agg(F.count(F.lit(1)).alias("n"))
               .withColumn("_sh_before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"))
    rows = docs.drop(*ADDED).withColumns({"_sh_1": first, "_sh_2": second})
    inside = F.row_number().over(W.partitionBy("shard", "_sh_sub").orderBy("_sh_2", "_sh_1"))
    data = F.coalesce(text, F.lit(""))
    return (dealt(rows.withColumns({"size": (F.octet_length(data) + 1).cast("long"), "text_crc32": F.crc32(data)}))
            .withColumn("_sh_in", inside).join(F.broadcast(offsets), ["shard", "_sh_sub"])
            .withColumns({"slot": (F.col("_sh_before") + F.col("_sh_in") - 1).cast("long"), "law": F.lit("rows"),
                          "grown_shard": F.lit(None).cast("int")})
            .select(*[c for c in docs.columns if c not in ADDED], *ADDED).withColumnsRenamed(back))
