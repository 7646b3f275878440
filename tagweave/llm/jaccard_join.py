"""N-gram Jaccard join by chosen paths.

Two documents are linked when the Jaccard similarity of their sets of ``N``-word shingles
(64-bit hashes; a text of 1 to N-1 words is one shingle) is ``THRESHOLD`` or more.
``jaccard_join`` returns one row per document: its class (the connected component of the
links, named by its smallest id), its copies (documents with an equal set) and its number
of links (other documents, copies included).

Method: documents with equal sets are one set.  Each run sends every set down a tree: every
run and level has a min-hash of its own, so sets go on together with a chance equal to
their similarity, independently of all other runs and levels.  A node splits while it holds more than ``LEAF`` sets, to ``DEPTH``
levels at most; what then shares a leaf is compared by brute force, in blocks of
``BLOCK`` sets where the leaf is larger, so no leaf is capped.  The runs are repeated until
a pair at the threshold is missed with a chance below ``1 - RECALL`` at the last level:
``runs(0.8, depth=3) = 13`` (8e-10 at depth 1, 2e-6 at depth 2, 9e-5 at depth 3).

A pair is compared only in its first common leaf: each set carries the leaves of all its
runs, so pairs need no deduplication and are never emitted.  A leaf first compares
sketches (``MINHASHES`` bytes) and passes on the sets with a partner five standard errors
or less below the threshold; those meet their whole shingle sets and are compared exactly.
A leaf emits counts per set and a spanning forest of its links.

Cases: a null or empty text has no shingles: no links, its own class; repeated rows are
copies of each other; null ids are never a class's name unless all its ids are null; an
empty table gives no rows; other input columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, IntegerType, LongType, StructField, StructType)

from tagweave.llm.common import Words, column, mix64, pieces, set_aside, shingles, stored

N = 5
THRESHOLD = 0.8
RECALL = 0.9999
MINHASHES = 64
DEPTH = 3
LEAF = 256
BLOCK = 512


def runs(threshold: float, recall: float = RECALL, depth: int = 2) -> int:
    """Runs after which a pair at the threshold is missed with a chance of at most 1 - recall at ``depth``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold ** depth)) if threshold < 1 else 1


def text_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingles, texts they belong to, set size per text): distinct, ordered by text and shingle."""
    words = Words(texts)
    value, text = shingles(words.hashes(), words.offsets, N)
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    value, text = value[new], text[new]
    return value, text, np.bincount(text, minlength=len(texts))


def signatures(value: np.ndarray, starts: np.ndarray, n: int = MINHASHES) -> np.ndarray:
    """(sets, n) min-hash values of the sets that begin at ``starts``."""
    out = np.empty((len(starts), n), np.uint64)
    for k in range(n):
        seed = mix64(np.array([k + 1], np.uint64))[0]
        v = (value ^ seed) * (seed | np.uint64(1))
        v ^= v >> np.uint64(31)
        v *= np.uint64(0x9FB21C651E98DF25)
        out[:, k] = np.minimum.reduceat(v, starts)
    return out


def paths(sig: np.ndarray, n_runs: int) -> np.ndarray:
    """(sets, runs, DEPTH) node names; every run and level reads its own column of ``sig``."""
    out = np.empty((len(sig), n_runs, DEPTH), np.uint64)
    for r in range(n_runs):
        name = np.full(len(sig), mix64(np.array([r + 1000], np.uint64))[0])
        for level in range(DEPTH):
            at = r * DEPTH + level
            name = mix64(name ^ mix64(sig[:, at] + np.uint64(at)))
            out[:, r, level] = name
    return out


_SETS = StructType([
    StructField("set", LongType()), StructField("n", IntegerType()), StructField("sketch", BinaryType()),
    StructField("paths", ArrayType(LongType()))])


def _sketches(rows: DataFrame, n_runs: int) -> DataFrame:
    """``rows(id, th, row, text)`` with the set's name, size, sketch and paths; null without shingles."""
    schema = StructType([rows.schema["id"], rows.schema["th"], rows.schema["row"], *_SETS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                value, _, size = text_sets(column(piece, "text"))
                some = np.flatnonzero(size)
                starts = (np.cumsum(size) - size)[some]
                if len(some):
                    sig = signatures(value, starts, max(MINHASHES, n_runs * DEPTH))
                    name = mix64(np.add.reduceat(mix64(value), starts) ^ mix64(size[some].astype(np.uint64)))
                    path = paths(sig, n_runs).reshape(len(some), -1).view(np.int64)
                    small = (mix64(sig[:, :MINHASHES]) & np.uint64(255)).astype(np.uint8)
                back = np.full(piece.num_rows, -1)
                back[some] = np.arange(len(some))
                yield pa.RecordBatch.from_arrays([
                    column(piece, "id"), column(piece, "th"), column(piece, "row"),
                    pa.array([name[k].view(np.int64) if k >= 0 else None for k in back], pa.int64()),
                    pa.array(size, pa.int32()),
                    pa.array([small[k].tobytes() if k >= 0 else None for k in back], pa.binary()),
                    pa.array([path[k] if k >= 0 else None for k in back], pa.list_(pa.int64()))],
                    names=schema.names)

    return rows.mapInArrow(run, schema)


def _leaves(sets: DataFrame, n_runs: int) -> DataFrame:
    """``(set, leaf, size)``: the leaves that hold more than one set, level by level."""
    rows = sets.select("set", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(n_runs - 1)),
        lambda r: F.slice("paths", r * DEPTH + 1, DEPTH))).alias("path"))
    found = None
    for level in range(DEPTH):
        rows = rows.withColumn("leaf", F.get("path", F.lit(level)))
        # written first, so the join below has two plain exchanges and a hot leaf can be split
        full = stored(rows.groupBy("leaf").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), f"join-full{level}")
        rows = stored(rows.join(full, "leaf").select("set", "path", "leaf", "size"), f"join-level{level}")
        last = level == DEPTH - 1
        done = rows.select("set", "leaf", "size") if last else rows.where(F.col("size") <= LEAF).select("set", "leaf", "size")
        found = done if found is None else found.unionByName(done)
        rows = rows.where(F.col("size") > LEAF).select("set", "path")
    return found


def _blocks(rows: DataFrame) -> DataFrame:
    """Each row once per pair of blocks it takes part in: ``(leaf, i, j)`` with its own block ``own``."""
    n = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("set", "leaf"), n).cast("int")
    return rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), n - 1))) \
        .withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("other")


class _Group:
    """The sets of one pair of blocks of one leaf."""

    def __init__(self, table: pa.Table):
        table = table.sort_by("set")
        self.table = table
        self.leaf = table["leaf"][0].as_py()
        self.sets = table["set"].to_numpy()
        self.own = table["own"].to_numpy()
        self.one_block = table["i"][0].as_py() == table["j"][0].as_py()
        m = len(self.sets)
        self.sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(m, -1)
        lists = table["leaves"].combine_chunks()
        # own leaves that come before this one in the order of their names
        self.earlier = [set(x for x in row if x < self.leaf) for row in lists.to_pylist()]

    def pairs(self) -> Iterator[tuple[int, np.ndarray]]:
        """(x, partners after x): sketches near enough, and no earlier common leaf."""
        m = len(self.sets)
        low = THRESHOLD - 5 * math.sqrt(THRESHOLD * (1 - THRESHOLD) / MINHASHES)
        for x in range(m - 1):
            rest = np.arange(x + 1, m)
            if not self.one_block:
                rest = rest[self.own[rest] != self.own[x]]
            near = rest[(self.sketch[rest] == self.sketch[x]).sum(1) >= low * MINHASHES]
            if len(near) and self.earlier[x]:
                near = near[[self.earlier[x].isdisjoint(self.earlier[y]) for y in near]]
            if len(near):
                yield x, near


def _candidates(table: pa.Table) -> pa.Table:
    group = _Group(table)
    keep = np.zeros(len(group.sets), bool)
    for x, near in group.pairs():
        keep[x] = True
        keep[near] = True
    return group.table.filter(pa.array(keep))


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """(m, m) sizes of the intersections, by a product of shingle incidence slabs."""
    m = len(sets)
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    _, which, times = np.unique(every, return_inverse=True, return_counts=True)
    shared = times > 1
    number = np.cumsum(shared) - 1
    keep = shared[which]
    col, row = number[which[keep]], owner[keep]
    order = np.argsort(col, kind="stable")
    col, row = col[order], row[order]
    out = np.zeros((m, m), np.float32)
    width = 2048
    for a in range(0, int(shared.sum()), width):
        lo, hi = np.searchsorted(col, [a, a + width])
        slab = np.zeros((m, width), np.float32)
        slab[row[lo:hi], col[lo:hi] - a] = 1
        out += slab @ slab.T
    return out


def _verify(table: pa.Table) -> pa.Table:
    """Per set of the group: links (documents) and the root of its tree of links here."""
    group = _Group(table)
    m = len(group.sets)
    sets = [text_sets(pa.array([t], pa.large_string()))[0] for t in group.table["text"].to_pylist()]
    size = np.array([len(s) for s in sets])
    copies = group.table["copies"].to_numpy()
    both = _overlaps(sets)
    links = np.zeros(m, np.int64)
    root = np.arange(m)

    def top(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for x, near in group.pairs():
        inside = both[x, near].astype(np.int64)
        # whole numbers on both sides: exact at the threshold (given in thousandths)
        hit = near[1000 * inside >= round(1000 * THRESHOLD) * (size[x] + size[near] - inside)]
        links[x] += copies[hit].sum()
        links[hit] += copies[x]
        for y in hit:
            a, b = top(x), top(y)
            root[max(a, b)] = min(a, b)
    ends = np.array([top(x) for x in range(m)])
    keep = links > 0
    return pa.table([pa.array(group.sets[keep]), pa.array(links[keep]), pa.array(group.sets[ends[keep]])],
                    names=["set", "links", "root"])


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of undirected ``edges(u, v)``; the component is its smallest node.

    Each round takes the smallest label among a node and its neighbours and then the
    label's label; the labels are written between rounds.
    """
    both = stored(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).where("u != v").distinct(),
                  "components-edges")
    labels = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("c")).select(F.col("u").alias("node"), "c")
    while True:
        labels = stored(labels, "components-labels")
        near = both.join(labels.withColumnRenamed("node", "v"), "v").groupBy("u").agg(F.min("c").alias("m"))
        step = labels.join(near.withColumnRenamed("u", "node"), "node").select("node", "c", F.least("c", "m").alias("m"))
        jump = labels.select(F.col("node").alias("m"), F.col("c").alias("mm"))
        nxt = stored(step.join(jump, "m", "left").select("node", "c", F.least("m", F.coalesce("mm", "m")).alias("new")),
                     "components-step")
        if nxt.where("new != c").isEmpty():
            return labels.withColumnRenamed("c", "component")
        labels = nxt.select("node", F.col("new").alias("c"))


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, class_id, copy_id, n_copies, n_links)``, one row per row of ``docs`` (see the module)."""
    classes = _classes(docs, id_col, text_col)
    return classes.select(F.col("id").alias(id_col), "class_id", "copy_id", "n_copies", "n_links")


def _classes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    n_runs = runs(THRESHOLD, depth=DEPTH)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"),
                       F.xxhash64(id_col, text).alias("row"), text.alias("text"))
    sketched = stored(_sketches(rows, n_runs), "join-sketches")
    members = sketched.select("id", "row", "set")
    sets = stored(sketched.where("set is not null").groupBy("set").agg(
        F.min("id").alias("copy_id"), F.count(F.lit(1)).alias("copies"), F.min("th").alias("th"),
        F.first("sketch").alias("sketch"), F.first("paths").alias("paths")), "join-sets")
    leaves = stored(_leaves(sets.select("set", "paths"), n_runs), "join-leaves")
    own = leaves.groupBy("set").agg(F.collect_list(F.struct("leaf", "size")).alias("at"))  # n_runs entries at most
    own = own.join(sets.select("set", "th", "copies", "sketch"), "set")
    rows = own.select("set", "th", "copies", "sketch", F.col("at.leaf").alias("leaves"), F.explode("at").alias("x")) \
        .select("set", "th", "copies", "sketch", "leaves", "x.leaf", "x.size")
    blocks = _blocks(rows).select("leaf", "i", "j", "own", "set", "th", "copies", "sketch", "leaves")
    # few bytes but much comparing: as many tasks as the session asks for, not coalesced by size
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group = ["leaf", "i", "j"]
    near = stored(blocks.repartition(tasks, *group).groupBy(*group).applyInArrow(_candidates, blocks.schema),
                  "join-candidates")
    # one text per set that has a candidate; copies are dropped before the exchange
    texts = docs.select(F.xxhash64(text).alias("th"), text.alias("text")).groupBy("th").agg(F.first("text").alias("text"))
    checked = near.join(texts, "th")
    links = stored(checked.repartition(tasks, *group).groupBy(*group).applyInArrow(_verify, "set long, links long, root long"), "join-links")
    parts = components(links.select(F.col("set").alias("u"), F.col("root").alias("v")))
    info = sets.select("set", "copy_id", "copies") \
        .join(links.groupBy("set").agg(F.sum("links").alias("links")), "set", "left") \
        .join(parts.withColumnRenamed("node", "set"), "set", "left") \
        .withColumn("component", F.coalesce("component", "set"))
    info = stored(info, "join-info")
    names = info.groupBy("component").agg(F.min("copy_id").alias("class_id"))
    info = info.join(names, "component").select("set", "copy_id", "class_id", "component", F.col("copies").alias("n_copies"),
                                                (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    linked = members.where("set is not null").join(info, "set")
    alone = members.where("set is null").select(
        "set", "id", "row", F.col("id").alias("copy_id"), F.col("id").alias("class_id"), F.lit(None).cast("long").alias("component"),
        F.lit(1).cast("long").alias("n_copies"), F.lit(0).cast("long").alias("n_links"))
    return linked.unionByName(alone)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are the first of their class (smallest id, then text hash).

    Rows without shingles stay; of repeated rows of one id and text one stays.
    """
    classes = stored(_classes(docs, id_col, text_col), "join-classes")
    key = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("row"))
    first = classes.where("component is not null").groupBy("component").agg(F.min(key).alias("k")) \
        .select(F.col("k.row").alias("_jj_row"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows, back = set_aside(docs, ["_jj_row"])  # an input column of that name is kept
    found = rows.withColumn("_jj_row", F.xxhash64(id_col, text)).join(first, "_jj_row", "left_semi")
    found = found.dropDuplicates(["_jj_row"]).drop("_jj_row").withColumnsRenamed(back).select(docs.columns)
    return found.unionByName(docs.where(~text.rlike(r"[^\x20\x09-\x0D]")))
