"""Mixing sources to target weights by subset-sum budget fitting.

``targets`` shares the total size of all documents among the sources by weight, no source
above ``MAX_REPEAT`` times its own size (the excess is reshared by weight).  ``mix`` meets
the targets with whole documents: every document of a source is taken ``target // size``
times, and the remaining budget is filled by once more some documents: documents are
counted by exact length, each length gets its proportional share, and a bounded-knapsack
dynamic program over the lengths closes what the rounding leaves.  Which documents of a
length are taken is decided by the order of a seeded hash of id and text, so reruns agree.

Cases: a null or empty text has size 0 and is never taken; null sources form one source,
ordered last; repeated rows (same id and text) are taken or left together; an empty table gives no rows; an input column named like an added one
(``size source_size target copies taken``) is replaced, one named like a helper column (``HELPERS``) is kept.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagweave.llm.common import WORD, set_aside, stored
from tagweave.operators.joins import bounded_broadcast

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
WINDOW = 1 << 16  # budget left for the dynamic program
BUCKET_BITS = 8
SALTS = 32

ADDED = ["size", "source_size", "target", "copies", "taken"]
HELPERS = ["_mix_source", "_mix_hash", "_mix_salt", "_p_source", "_p_size", "_p_whole", "_p_last", "_p_salt", "_copy"]


def _sums(sizes: np.ndarray, counts: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Bounded knapsack: which sums up to ``limit`` can be reached, by which item each was reached
    first, and the items ``(length's index, documents)`` (counts are split in powers of two)."""
    items: list[tuple[int, int]] = []
    how = np.full(limit + 1, -1, np.int64)
    reach = np.zeros(limit + 1, bool)
    reach[0] = True
    for k in sorted((k for k in range(len(sizes)) if 0 < sizes[k] <= limit), key=lambda k: -sizes[k]):
        more, part = min(int(counts[k]), limit // int(sizes[k])), 1
        while more > 0 and not reach[limit]:
            part = min(part, more)
            step = part * int(sizes[k])
            new = np.zeros(limit + 1, bool)
            new[step:] = reach[:limit + 1 - step]
            new &= ~reach
            how[new] = len(items)
            reach |= new
            items.append((k, part))
            more, part = more - part, part * 2
    return reach, how, items


def fit(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that the words come near ``budget`` (which
    is below ``sum(sizes * counts)``).

    The proportional share of every length is rounded down, then up where the rounded-off
    part is largest until about ``WINDOW`` words are left; the dynamic program fits those.
    """
    sizes, counts = sizes.astype(object), counts.astype(object)
    total = int((sizes * counts).sum())
    take = np.zeros(len(sizes), object)
    if total == 0 or budget <= 0:
        return take.astype(np.int64)
    take = counts * budget // total
    rounded_off = (counts * budget % total).astype(float)
    left = budget - int((take * sizes).sum())
    for k in sorted(range(len(sizes)), key=lambda k: (-rounded_off[k], sizes[k])):
        if 0 < sizes[k] <= left - WINDOW and take[k] < counts[k]:
            take[k] += 1
            left -= int(sizes[k])
    reach, how, items = _sums(sizes, counts - take, left)
    at = int(np.flatnonzero(reach)[-1])
    if at < left:  # is a sum above the budget nearer than the best one below it?
        reach, how, items = _sums(sizes, counts - take, 2 * left - at)
        sums = np.flatnonzero(reach)
        at = int(sums[np.argmin(np.abs(sums - left))])
    while at > 0:
        k, part = items[how[at]]
        take[k] += part
        at -= part * int(sizes[k])
    return take.astype(np.int64)


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS,
            max_repeat: float = MAX_REPEAT) -> DataFrame:
    """``sources(source, source_size)`` with ``target``.

    Weights repeat over the sources in code-point order, null last.  A source is at its cap
    when its share of what the sources with a smaller cap-to-weight ratio leave exceeds the
    cap.  The windows run over one row per source.
    """
    n = len(weights)
    rank = (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % n
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), rank + 1)
    s = sources.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * float(max_repeat))
    order = W.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    upto = order.rowsBetween(W.unboundedPreceding, -1)
    after = order.rowsBetween(0, W.unboundedFollowing)
    every = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    s = s.withColumn("_level", (F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(upto), F.lit(0.0)))
                     / F.sum("_w").over(after))
    s = s.withColumn("_open", F.col("_level") * F.col("_w") <= F.col("_cap"))
    place = F.when(F.col("_open"), F.row_number().over(order))
    level = F.min_by("_level", place).over(every)  # of the first source below its cap
    # least(): nulls are skipped, so a source at its cap keeps the cap
    return s.withColumn("target", F.least(F.col("_cap"), level * F.col("_w"))).select("source", "source_size", "target")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeat: float = MAX_REPEAT, seed: int = 1,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with ``size source_size target copies taken`` (``taken = size * copies``)."""
    docs, back = set_aside(docs, HELPERS)
    text = F.col(text_col).cast("string")
    base = docs.drop(*ADDED).withColumns({
        "size": F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long"),
        "_mix_source": F.col(source_col).cast("string"),
        "_mix_hash": F.xxhash64(F.lit(seed), F.col(id_col), text)})
    narrow = stored(base.select(F.col("_mix_source").alias("source"), "size", F.col("_mix_hash").alias("h")), "mix-sizes")
    lengths = narrow.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    per_source = targets(lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")),
                         weights, max_repeat)
    whole = F.floor(F.try_divide("target", "source_size"))  # null for a source of empty texts only
    per_source = per_source.withColumn("whole", F.coalesce(whole, F.lit(0)).cast("long")).withColumn(
        "budget", F.floor(F.col("target") - F.col("whole") * F.col("source_size")).cast("long"))
    plan = lengths.join(per_source.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size", ignore_index=True)
        return rows.assign(extra=fit(rows["size"].to_numpy(), rows["n"].to_numpy(), int(rows["budget"].iloc[0])))

    plan = stored(plan.groupBy("source").applyInPandas(
        choose, "source string, size long, n long, source_size long, target double, whole long, budget long, extra long"),
        "mix-plan")
    # the hash below which a length's documents are taken: first the bucket, then inside it
    bucket = F.shiftright("h", 64 - BUCKET_BITS)
    some = plan.where("extra > 0 and extra < n").select("source", "size", "extra")
    same = [F.col("source").eqNullSafe(F.col("s")), F.col("size") == F.col("z")]

    def of(right: DataFrame, left: DataFrame, *more: Column) -> DataFrame:
        renamed = right.withColumnRenamed("source", "s").withColumnRenamed("size", "z")
        return left.join(renamed, [*same, *more]).drop("s", "z")

    running = W.partitionBy("source", "size").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
    cut = (of(some, narrow.groupBy("source", "size", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("m")))
           .withColumn("upto", F.sum("m").over(running))
           .where("upto >= extra and upto - m < extra")
           .select("source", "size", "bucket", (F.col("extra") - F.col("upto") + F.col("m")).alias("inside")))
    hashes = narrow.groupBy("source", "size", "h").agg(F.count(F.lit(1)).alias("m")).withColumn("b", bucket)
    by_hash = W.partitionBy("source", "size").orderBy("h").rowsBetween(W.unboundedPreceding, 0)
    limit = (of(cut, hashes, F.col("b") == F.col("bucket"))
             .withColumn("upto", F.sum("m").over(by_hash))
             .groupBy("source", "size")
             .agg(F.max(F.when(F.col("upto") <= F.col("inside"), F.col("h"))).alias("last"),
                  F.min("h").alias("lowest")))
    # none of the bucket fits (repeated rows): everything below the bucket's first hash
    limit = limit.select("source", "size", F.coalesce("last", F.col("lowest") - 1).alias("last"))
    limit = limit.withColumnRenamed("source", "s").withColumnRenamed("size", "z")
    plan = plan.join(limit, same, "left").drop("s", "z").select(
        F.col("source").alias("_p_source"), F.col("size").alias("_p_size"), "source_size", "target",
        F.col("whole").alias("_p_whole"), "extra", "n", "last")
    plan = plan.withColumn("_p_last", F.when(F.col("extra") >= F.col("n"), F.lit((1 << 63) - 1))
                           .when(F.col("extra") > 0, F.col("last"))).drop("extra", "n", "last")
    plan = stored(plan, "mix-decisions")
    on = F.col("_mix_source").eqNullSafe(F.col("_p_source")) & (F.col("size") == F.col("_p_size"))
    # one row per source and length; beyond the bound hot lengths are dealt over SALTS tasks
    marked = bounded_broadcast(plan)
    if marked is plan:
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        out = base.withColumn("_mix_salt", F.pmod("_mix_hash", F.lit(SALTS)).cast("int")) \
            .join(plan.withColumn("_p_salt", salts), on & (F.col("_mix_salt") == F.col("_p_salt")))
    else:
        out = base.join(marked, on)
    copies = F.when(F.col("size") == 0, F.lit(0)).otherwise(
        F.col("_p_whole") + F.coalesce(F.col("_mix_hash") <= F.col("_p_last"), F.lit(False)).cast("long"))
    return out.withColumn("copies", copies.cast("long")).withColumn("taken", F.col("copies") * F.col("size")) \
        .select(*[c for c in docs.columns if c not in ADDED], *ADDED).withColumnsRenamed(back)


def expand(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: ``columns`` of each row, repeated ``copies`` times."""
    rows, back = set_aside(mixed.where("copies > 0"), HELPERS)
    rows = rows.withColumn("_copy", F.explode(F.expr("sequence(1, int(copies))"))).drop("_copy")
    return rows.withColumnsRenamed(back).select(*columns)
