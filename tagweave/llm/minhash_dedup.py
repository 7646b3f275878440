"""MinHash near-dedup by a chosen-path set similarity join.

A text's set is its distinct ``N``-word shingles (A-Z lower-cased, as 64-bit hashes; a text of
one word is one shingle).  Texts are linked when ``100 * intersection >= SHARE * union`` of
their whole sets; ``dedup`` gives every row its component of the links and whether it is kept.

Method.  Texts with equal sets (equal 128-bit names) are one set.  Every tree sends each set
down a path: at a node the minwise token of the tree's next level picks the branch, until the
node's load is at most ``LEAF`` or ``DEPTH`` levels are used.  A pair at the threshold stays
together at a level with a chance of 0.8, independently in every tree and level, so
``trees()`` = 13 trees miss it with a chance of 9e-5 at the last level (8e-10 at the first).
Small nodes are compared exhaustively: sketches (``SKETCH`` bytes of minwise tokens) rule out
pairs five standard errors below the threshold, the others are confirmed on the full sets.

Hot nodes.  What is still above ``LEAF`` after the last level is mostly one large group of
near copies, whose pairs would grow with its square.  Since only components are asked for, a
pair within one component needs no comparison.  So the join has two rounds:

1. the small nodes of the first ``FIRST`` trees, exhaustively, and the hot nodes of all trees
   against ``PIVOTS`` of their sets (linear in the node); the confirmed links give labels;
2. every other node that still holds two labels or more: only pairs of different labels are
   compared.  A hot node's largest label is never compared with itself: the rest is dealt in
   blocks against it and against each other.

No pair is dropped by a cap: what the pivots don't join is compared in the second round.  A
set counts as ``1 + shingles / LONG`` towards a node's load, so blocks are bounded in bytes too.

Cases: null, empty and blank texts have no set: linked with nothing, their own component;
repeated rows are copies of each other; a null id names no component unless all its ids are
null (then ``component_id`` is null and the row counts as kept); of rows that repeat the
smallest id all are kept; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagweave.llm.common import Words, column, lookup, mix64, pieces, shingles, stored
from tagweave.llm.jaccard_join import components
from tagweave.operators.joins import bounded_broadcast

N = 2
SHARE = 80  # percent
RECALL = 0.9999
DEPTH = 3
LEAF = 256
BLOCK = 512
LONG = 4096  # shingles that count as one more set
FIRST = 4
PIVOTS = 8
SKETCH = 64
_ROUND_ROWS = "grp long, part int, side int, sid long, label long, n long, sketch binary, t1 long, t2 long"


def trees(recall: float = RECALL, depth: int = DEPTH) -> int:
    """Trees after which a pair at the threshold is missed with a chance of at most 1 - recall."""
    return math.ceil(math.log(1 - recall) / math.log(1 - (SHARE / 100) ** depth))


def text_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, set size per text): distinct, ordered by text and shingle."""
    words = Words(texts, lower=True)
    value, text = shingles(words.hashes(), words.offsets, N)
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    return value[new], np.bincount(text[new], minlength=len(texts))


def minwise(value: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """(sets, n): the smallest token of every set under n hash orders."""
    out = np.empty((len(starts), n), np.uint64)
    seeds = mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
    for k, seed in enumerate(seeds):
        order = (value ^ seed) * (seed | np.uint64(1))
        order ^= order >> np.uint64(32)
        order *= np.uint64(0xD6E8FEB86659FD93)
        out[:, k] = np.minimum.reduceat(order, starts)
    return out


def branches(tokens: np.ndarray, n_trees: int) -> np.ndarray:
    """(sets, n_trees * DEPTH) names of the nodes on every set's paths."""
    out = np.empty((len(tokens), n_trees * DEPTH), np.uint64)
    for tree in range(n_trees):
        node = np.full(len(tokens), mix64(np.array([7919 * (tree + 1)], np.uint64))[0])
        for at in range(tree * DEPTH, (tree + 1) * DEPTH):
            node = mix64(node + mix64(tokens[:, at]))
            out[:, at] = node
    return out


def _described(rows: DataFrame, n_trees: int) -> DataFrame:
    """``rows(id, t1, t2, text)`` with name, size, sketch and paths of the text's set (null without one)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                value, size = text_sets(column(piece, "text"))
                some = np.flatnonzero(size)
                at = pa.array(np.where(size > 0, np.cumsum(size > 0) - 1, 0), mask=size == 0)  # null: no set
                starts = (np.cumsum(size) - size)[some]
                if len(some):
                    tokens = minwise(value, starts, max(SKETCH, n_trees * DEPTH))
                    # two independent sums of the tokens name the set
                    name = np.stack([mix64(np.add.reduceat(mix64(value + np.uint64(salt)), starts)
                                           + size[some].astype(np.uint64)) for salt in (1, 2)], 1)
                    names = pa.array([r.tobytes() for r in name], pa.binary())
                    sketch = pa.array([r.tobytes() for r in (mix64(tokens[:, :SKETCH]) & np.uint64(255)).astype(np.uint8)],
                                      pa.binary())
                    paths = branches(tokens, n_trees).view(np.int64)
                    path = pa.ListArray.from_arrays(
                        pa.array(np.arange(len(some) + 1, dtype=np.int32) * paths.shape[1]), pa.array(paths.reshape(-1)))
                else:
                    names, sketch, path = pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [column(piece, "id"), column(piece, "t1"), column(piece, "t2"), pa.array(size, pa.int64()),
                     names.take(at), sketch.take(at), path.take(at)],
                    names=["id", "t1", "t2", "n", "name", "sketch", "paths"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, t1 long, t2 long, n long, name binary, sketch binary, paths array<long>")


def _nodes(sets: DataFrame, n_trees: int) -> DataFrame:
    """``(sid, tree, node, load, hot)``: the last node of every set's paths, where it holds another set too."""
    rows = sets.select("sid", "own", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: F.slice("paths", t * DEPTH + 1, DEPTH))).alias("tree", "path"))
    found = None
    for level in range(DEPTH):
        rows = rows.withColumn("node", F.get("path", F.lit(level)))
        # written first, so the join has two plain exchanges and a hot node can be split
        loads = stored(rows.groupBy("node").agg(F.count(F.lit(1)).alias("held"), F.sum("own").alias("load"))
                       .where("held > 1").select("node", "load"), f"dedup-loads{level}")
        rows = stored(rows.join(loads, "node").select("sid", "own", "tree", "path", "node", "load"), f"dedup-level{level}")
        hot = F.col("load") > LEAF
        done = rows.select("sid", "tree", "node", "load", hot.alias("hot"))
        done = done if level == DEPTH - 1 else done.where(~F.col("hot"))
        found = done if found is None else found.unionByName(done)
        rows = rows.where(hot).drop("node", "load")
    return found


def _whole_groups(batches: Iterator[pa.RecordBatch], payload: str, limit: int = 16 << 20) -> Iterator[pa.Table]:
    """Tables of whole groups from rows sorted by group, with about ``limit`` bytes in ``payload`` each (a larger group stands alone)."""
    held: pa.Table | None = None

    def starts(table: pa.Table) -> np.ndarray:
        grp, part = table["grp"].to_numpy(), table["part"].to_numpy()
        return np.flatnonzero(np.r_[True, (grp[1:] != grp[:-1]) | (part[1:] != part[:-1])])

    def parts(table: pa.Table) -> Iterator[pa.Table]:
        begin = np.append(starts(table), table.num_rows)
        size = np.concatenate([[0], np.cumsum(pc.binary_length(table[payload]).to_numpy())])[begin]
        at = 0
        while at < len(begin) - 1:
            end = max(int(np.searchsorted(size, size[at] + limit, side="right")) - 1, at + 1)
            yield table.slice(begin[at], begin[end] - begin[at])
            at = end

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]).combine_chunks() if held is not None and held.num_rows else table
        last = int(starts(table)[-1])
        if last:
            yield from parts(table.slice(0, last))
        held = table.slice(last)
    if held is not None and held.num_rows:
        yield from parts(held)


_LOW7, _HIGH = np.uint64(0x7F7F7F7F7F7F7F7F), np.uint64(0x8080808080808080)


def near_pairs(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(x, y, equal sketch bytes) of the rows that may be linked, all groups of the table at once.

    Rows are sorted by group and size.  Step d compares every row with the d-th after it, as long
    as that is in its group and in reach: linked sets differ in size by the threshold at most.
    """
    grp, part, n = (table[c].to_numpy() for c in ("grp", "part", "n"))
    label, side = table["label"].to_numpy(), table["side"].to_numpy()
    group = np.cumsum(np.r_[False, (grp[1:] != grp[:-1]) | (part[1:] != part[:-1])]).astype(np.float64)
    most = 100 * n // SHARE
    wide = float(most.max() + 1)
    end = np.searchsorted(group * wide + n, group * wide + most, side="right")
    sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint64).reshape(table.num_rows, -1).T.copy()
    share = SHARE / 100
    low = (share - 5 * math.sqrt(share * (1 - share) / SKETCH)) * SKETCH
    x, step = np.arange(table.num_rows), 1
    while len(x := x[x + step < end[x]]):
        y = x + step
        ok = (label[x] != label[y]) & ((side[x] == 2) | (side[x] != side[y]))
        a, b = x[ok], y[ok]
        differ = np.zeros(len(a), np.uint8)
        for word in sketch:
            v = word[a] ^ word[b]
            differ += np.bitwise_count((((v & _LOW7) + _LOW7) | v) & _HIGH)  # bytes that are not zero
        near = SKETCH - differ.astype(np.int64) >= low
        if near.any():
            yield a[near], b[near], SKETCH - differ[near].astype(np.int64)
        step += 1


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in _whole_groups(batches, "sketch", 4 << 20):
        keep = np.zeros(table.num_rows, bool)
        for x, y, _ in near_pairs(table):
            keep[x] = True
            keep[y] = True
        yield from table.filter(pa.array(keep)).to_batches()


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets (sorted, distinct) are linked."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    inside = int((both[1:] == both[:-1]).sum())
    return 100 * inside >= SHARE * (len(a) + len(b) - inside)


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (u, v) that join the sets of a group; pairs that are joined already are not compared."""
    for table in _whole_groups(batches, "text"):
        found = list(near_pairs(table))
        if not found:
            continue
        sets: list[np.ndarray] = []
        for batch in table.to_batches():
            for piece in pieces(batch, "text"):
                value, size = text_sets(column(piece, "text"))
                sets += np.split(value, np.cumsum(size)[:-1])
        sids = table["sid"].to_numpy()
        # sets of one label are joined in their group from the start
        names = np.stack([table[c].to_numpy() for c in ("grp", "part", "label")], 1)
        _, first, which = np.unique(names, axis=0, return_index=True, return_inverse=True)
        root = first[which.reshape(-1)]

        def top(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        left, right, same = (np.concatenate(c) for c in zip(*found))
        u, v = [], []
        # the likeliest first: they join most sets before the doubtful pairs are looked at
        for k in np.argsort(-same, kind="stable").tolist():
            x, y = int(left[k]), int(right[k])
            a, b = top(x), top(y)
            if a != b and similar(sets[x], sets[y]):
                root[max(a, b)] = min(a, b)
                u.append(sids[x])
                v.append(sids[y])
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def _in_groups(rows: DataFrame) -> DataFrame:
    """Rows dealt and sorted by group; few bytes but much comparing, so as many tasks as the session asks for."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, "grp", "part").sortWithinPartitions("grp", "part", "n", "sid")


def _links(groups: DataFrame, docs: DataFrame, name: str) -> DataFrame:
    """``(u, v)``: confirmed links of ``groups(grp, part, side, sid, label, sketch, t1, t2)``."""
    near = stored(_in_groups(groups).mapInArrow(_candidates, groups.schema), f"dedup-{name}-near")
    needed = stored(near.select("t1", "t2").distinct(), f"dedup-{name}-needed")
    marked = bounded_broadcast(needed)
    if marked is not needed:  # few: texts that aren't needed never leave their task
        texts = docs.join(marked, ["t1", "t2"]).groupBy("t1", "t2").agg(F.first("text").alias("text"))
    else:  # copies are combined before the exchange
        texts = docs.groupBy("t1", "t2").agg(F.first("text").alias("text")).join(needed, ["t1", "t2"])
    checked = _in_groups(near.join(texts, ["t1", "t2"]))
    return stored(checked.mapInArrow(_confirmed, "u long, v long"), f"dedup-{name}-links")


def _stars(hot: DataFrame, info: DataFrame) -> DataFrame:
    """The hot nodes' sets against pivots of the node, as groups; a pivot meets a set once, however many nodes both share."""
    order = Window.partitionBy("node").orderBy("sid")  # numbers of sets say nothing about their content
    pivots = hot.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= PIVOTS) \
        .select("node", F.col("sid").alias("grp"))
    pairs = lookup(hot.select("node", "sid"), pivots, ["node"], ["sid"]).where("sid <> grp").select("grp", "sid").distinct()
    members = pairs.join(info, "sid").withColumn("part", F.pmod(F.xxhash64("sid"), F.lit(1 << 30)))
    sizes = stored(pairs.groupBy("grp").agg(F.count(F.lit(1)).alias("held")), "dedup-stars").withColumn(
        "parts", F.ceil(F.col("held") / BLOCK).cast("int"))
    members = lookup(members, sizes.select("grp", "parts"), ["grp"], ["sid"]) \
        .withColumn("part", F.pmod(F.col("part"), F.col("parts")).cast("int")).withColumn("side", F.lit(1)).drop("parts")
    middle = sizes.join(info.withColumnRenamed("sid", "grp"), "grp").withColumn("sid", F.col("grp")) \
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("side", F.lit(0)) \
        .drop("held", "parts")
    return _as_groups(members.unionByName(middle))


def _gathered(links: DataFrame, name: str, rounds: int = 3) -> DataFrame:
    """The same components with fewer links: every set points to its smallest linked set, and so do the others it was linked with.

    A set of a hot group is linked with many pivots, all of which are linked among themselves
    many times over; after this it holds about one link per set.
    """
    pairs = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    for k in range(rounds):
        low = stored(pairs.withColumn("m", F.min("v").over(Window.partitionBy("u"))), f"dedup-{name}-gathered{k}")
        pairs = low.select("u", F.col("m").alias("v")).unionByName(low.select(F.col("v").alias("u"), F.col("m").alias("v"))) \
            .where("u <> v").distinct()
    return pairs


def _as_groups(rows: DataFrame) -> DataFrame:
    if "label" not in rows.columns:
        rows = rows.withColumn("label", F.col("sid"))
    return rows.selectExpr(*[f"cast({c} as {t}) as {c}" for c, t in (x.split() for x in _ROUND_ROWS.split(", "))])


def _blocks(hot: DataFrame) -> DataFrame:
    """``hot(node, sid, label, own)`` dealt in blocks: the node's largest label (side A) meets the
    rest (side B), block by block, and the blocks of the rest meet each other."""
    per_label = hot.groupBy("node", "label").agg(F.sum("own").alias("load"))
    per_node = per_label.groupBy("node").agg(F.max(F.struct("load", "label")).alias("most"), F.sum("load").alias("all"))
    shape = stored(per_node.select(
        "node", F.col("most.label").alias("main"), F.ceil(F.col("most.load") / BLOCK).cast("int").alias("a"),
        F.ceil((F.col("all") - F.col("most.load")) / BLOCK).cast("int").alias("b")).where("b > 0"), "dedup-shape")
    rows = lookup(hot, shape, ["node"], ["sid"])
    is_a = F.col("label") == F.col("main")
    own = F.pmod(F.xxhash64("sid", "node"), F.when(is_a, F.col("a")).otherwise(F.col("b"))).cast("int")
    rows = rows.withColumn("block", own).withColumn("is_a", is_a)
    # part: pair of blocks; (b, a) pairs first, then (i, j) pairs of B
    cross = F.transform(F.sequence(F.lit(0), F.col("b") - 1), lambda k: F.struct(
        (F.col("block") * F.col("b") + k).alias("part"), F.lit(1).alias("side")))
    with_a = F.transform(F.sequence(F.lit(0), F.col("a") - 1), lambda k: F.struct(
        (k * F.col("b") + F.col("block")).alias("part"), F.lit(0).alias("side")))
    within = F.transform(F.sequence(F.lit(0), F.col("b") - 1), lambda k: F.struct(
        (F.col("a") * F.col("b") + F.least(k, F.col("block")) * F.col("b") + F.greatest(k, F.col("block"))).alias("part"),
        F.when(k == F.col("block"), F.lit(2)).when(k > F.col("block"), F.lit(0)).otherwise(F.lit(1)).alias("side")))
    at = F.when(F.col("is_a"), cross).otherwise(F.concat(with_a, within))
    return rows.select(F.col("node").alias("grp"), "sid", "label", F.inline(at))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_shingles, component_id, kept)``, one row per row of ``docs`` (see the module)."""
    n_trees = trees()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"),
                       text.alias("text"))
    described = stored(_described(rows, n_trees), "dedup-rows")
    sets = described.where("name is not null").groupBy("name").agg(
        F.min("id").alias("first_id"), F.min(F.struct("t1", "t2")).alias("t"), F.first("n").alias("n"),
        F.first("sketch").alias("sketch"), F.first("paths").alias("paths"))  # equal sets have equal ones
    sets = stored(sets.select("name", "first_id", "t.t1", "t.t2", "n", (F.lit(1) + F.floor(F.col("n") / LONG)).alias("own"),
                              "sketch", "paths", F.monotonically_increasing_id().alias("sid")), "dedup-sets")
    info = sets.select("sid", "n", "sketch", "t1", "t2")
    texts = rows.drop("id")

    nodes = stored(_nodes(sets, n_trees), "dedup-nodes")
    small = nodes.where(~F.col("hot")).select(F.col("node").alias("grp"), F.lit(0).alias("part"), F.lit(2).alias("side"), "sid", "tree")
    hot = nodes.where("hot").select("node", "sid")
    first = _as_groups(small.where(F.col("tree") < FIRST).drop("tree").join(info, "sid"))
    links = _gathered(_links(first.unionByName(_stars(hot, info)), texts, "first"), "first")
    links = stored(links, "dedup-first-few")

    labels = stored(components(links).select(F.col("node").alias("sid"), F.col("component").alias("label")), "dedup-labels")
    labelled = sets.select("sid", "own").join(labels, "sid", "left").withColumn("label", F.coalesce("label", "sid"))
    labelled = stored(labelled, "dedup-labelled")
    rest = small.where(F.col("tree") >= FIRST).drop("tree").join(labelled.select("sid", "label"), "sid")
    open_ = rest.groupBy("grp").agg((F.min("label") != F.max("label")).alias("open")).where("open").select("grp")
    rest = rest.join(open_, "grp").join(info, "sid")
    left = _blocks(hot.join(labelled, "sid")).join(info, "sid")
    more = _links(_as_groups(rest).unionByName(_as_groups(left)), texts, "second")

    parts = components(_gathered(links.unionByName(more), "second"))
    named = sets.select("sid", "name", "first_id")
    joined = stored(named.join(parts.withColumnRenamed("node", "sid"), "sid", "left"), "dedup-named")
    together = joined.where("component is not null")
    smallest = stored(together.groupBy("component").agg(F.min("first_id").alias("component_id")), "dedup-smallest")
    named = lookup(together, smallest, ["component"], ["sid"]).select("name", "component_id").unionByName(
        joined.where("component is null").select("name", F.col("first_id").alias("component_id")))
    named = stored(named, "dedup-components")
    linked = described.where("name is not null").select("id", "n", "name").join(named, "name").select("id", "n", "component_id")
    alone = described.where("name is null").select("id", "n", F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                                            F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
