"""Merkle dataset manifest: every row a leaf, a tree per group, a root over the groups.

``build`` hashes the rows, numbers them in the order of the tree and writes one table of nodes
per level; a node row names its parent, its children's digests and the leaves below it.
``climb`` proves rows against the root: a Spark recursive query ascends from every leaf over
these tables, appending the siblings of each step and folding the (possibly tampered) leaf
hash with them.  ``verify`` returns leaf, subroot, root, proof and the folded root per row.

H is the lower-case hexadecimal sha256 of the inputs concatenated (digests as hexadecimal
text; stored as 32 bytes).  A leaf is H of the stated fields, each ``-`` when null, else its
UTF-8 byte count, ``:`` and the value.  Per group the leaves ascend by id; every ``FANOUT``
consecutive nodes become their H while there is more than one.  The groups' subroots, null
first and then by UTF-8 bytes, are joined to the root in the same way.

Scale: rows are numbered by a range-partitioned sort (one count per partition reaches the
driver), so a node is a range of numbers and its parent follows from arithmetic; a level is
one aggregate of eight rows at most.  The driver loops over levels only (log8 of the rows).
High nodes lie above millions of leaves: in the climb a node is repeated per ``SPREAD`` leaves
below it and a leaf only meets the copy of its own stretch, so no join key is ever hot.  The
rows of the climb carry one step's siblings, not the whole proof.

Cases: a null group is a group of its own; a null id comes first and is not tampered; rows
equal in group, id and leaf hash are leaves of their own (which of them comes first makes no
difference); a lone leaf is its subroot, a lone subroot the root, and a proof without
siblings is H of nothing; an empty table gives no rows and no root; columns that are not
stated are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.llm.common import lookup, scratch, stored
from tagweave.operators.ids import sequential_ids

FANOUT = 8
SPREAD = 4096  # leaves that share one copy of a node in the climb
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_EVERY = 3
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TOP = 32  # levels of the tree over the groups are numbered from here
_LEVEL = 1 << 54  # a node's key is level * _LEVEL + its first leaf (or group)


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(fields: Sequence[Column]) -> Column:
    """The leaf digest (32 bytes) of a row's fields."""
    return F.unhex(F.sha2(F.concat(*[_field(c) for c in fields]).cast("binary"), 256))


def _hexed(digests: Column) -> Column:
    """The hexadecimal texts of an array of digests, joined."""
    return F.array_join(F.transform(digests, lambda d: F.lower(F.hex(d))), "")


def _joined(digests: Column) -> Column:
    return F.unhex(F.sha2(_hexed(digests).cast("binary"), 256))


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b).cast("long"))


@dataclass(frozen=True)
class Manifest:
    """``leaves``: one row per row of the table, with its number ``g`` and its parent's key
    ``up`` and place ``at`` there; ``nodes``: the built levels, each row with its key ``node``,
    digest, children (``kids``), first and last leaf and its own ``up`` and ``at``;
    ``groups``: the subroots; ``root``: the root (None for an empty table)."""

    leaves: DataFrame
    nodes: DataFrame
    groups: DataFrame
    root: str | None


_NODES = "node long, hash binary, kids array<binary>, lo long, hi long, up long, at int"


def tampered_text(id_: Column, text: Column) -> Column:
    """``text`` with A-Z lower-cased in the rows that are tampered with."""
    hit = F.crc32(id_.cast("string").cast("binary")) % TAMPER_EVERY == 0
    return F.when(F.coalesce(hit, F.lit(False)), F.translate(text, _UPPER, _LOWER)).otherwise(text)


def build(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", text_col: str = "text",
          fields: Sequence[str] = FIELDS) -> Manifest:
    """The manifest of ``docs``: leaves numbered, levels written to the shared folder."""
    spark = docs.sparkSession
    changed = tampered_text(F.col(id_col), F.col(text_col))
    leaves = stored(docs.select(
        F.col(id_col).alias("id"), F.col(group_col).cast("string").alias("grp"),
        leaf_hash([F.col(c) for c in fields]).alias("leaf"),
        leaf_hash([changed if c == text_col else F.col(c) for c in fields]).alias("tampered"),
        # deals rows that are equal in everything above over many tasks; any order of them is right
        F.xxhash64(F.monotonically_increasing_id()).alias("tie")), "merkle-leaves")
    numbered, _ = sequential_ids(leaves, [F.col("grp").asc_nulls_first(), F.col("id").asc_nulls_first(), "leaf", "tie"], 0, "g")
    sizes = stored(numbered.groupBy("grp").agg(F.min("g").alias("first"), F.count(F.lit(1)).alias("size")), "merkle-sizes")
    groups, n_groups = sequential_ids(sizes, [F.col("grp").asc_nulls_first()], 0, "k")
    largest = sizes.agg(F.max("size")).first()[0] or 0
    # null has no equal in a join: the key is the name, empty for null, and whether it is null
    named = [F.coalesce("grp", F.lit("")).alias("name"), F.col("grp").isNull().alias("none")]
    marked = lookup(numbered.select("id", "leaf", "tampered", "g", *named),
                    groups.select(*named, "first", "size", "k"), ["name", "none"], ["g"])
    up, at = _parent(1, n_groups)
    marked = stored(marked.select("id", "leaf", "tampered", "g", "first", "size", "k", up.alias("up"), at.alias("at")),
                    "merkle-numbered")

    folder = scratch(spark, "merkle-nodes")
    level, span = 1, FANOUT
    below = marked.select(F.col("g").alias("lo"), F.col("leaf").alias("hash"), "first", "size", "k", "up")
    schema = f"{_NODES}, first long, size long, k long, level int"
    while span // FANOUT < largest:
        up, at = _parent(level + 1, n_groups)
        rows = below.where(F.col("size") > span // FANOUT).groupBy("up", "first", "size", "k") \
            .agg(F.sort_array(F.collect_list(F.struct("lo", "hash"))).alias("run")) \
            .select(F.col("up").alias("node"), F.col("run.hash").alias("kids"), F.col("run")[0]["lo"].alias("lo"),
                    "first", "size", "k")
        rows = rows.select("node", _joined(F.col("kids")).alias("hash"), "kids", F.col("lo").alias("g"), "lo",
                           (F.least(F.col("lo") + span, F.col("first") + F.col("size")) - 1).alias("hi"),
                           "first", "size", "k")
        rows.select("node", "hash", "kids", "lo", "hi", up.alias("up"), at.alias("at"), "first", "size", "k",
                    F.lit(level).alias("level")).write.parquet(f"{folder}/step={level}")
        below = spark.read.schema(schema).parquet(f"{folder}/step={level}").select("lo", "hash", "first", "size", "k", "up")
        level, span = level + 1, span * FANOUT

    built = _read(spark, folder, schema, level > 1)
    # a group's subroot is its one node above all its leaves (no level is built on it), or its lone leaf
    subroots = built.where(F.col("hi") - F.col("lo") + 1 == F.col("size")).select("k", F.col("hash").alias("subroot"))
    lone = marked.where("size = 1").select("k", F.col("leaf").alias("subroot"))
    groups = stored(groups.join(subroots.unionByName(lone), "k").select("k", "grp", "first", "size", "subroot"), "merkle-groups")

    top, width = 1, 1
    row = groups.select("k", F.col("subroot").alias("hash"), F.col("first").alias("lo"),
                        (F.col("first") + F.col("size") - 1).alias("hi"))
    while width < n_groups:
        last = width * FANOUT >= n_groups
        above = _TOP + top + 1
        run = row.withColumn("part", _div(F.col("k"), width * FANOUT)).groupBy("part") \
            .agg(F.sort_array(F.collect_list(F.struct("k", "hash"))).alias("run"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        parent = F.col("part") * (width * FANOUT)
        run.select(
            (F.lit((_TOP + top) * _LEVEL) + parent).alias("node"), _joined(F.col("run.hash")).alias("hash"),
            F.col("run.hash").alias("kids"), "lo", "hi",
            (F.lit(None).cast("long") if last else
             F.lit(above * _LEVEL) + _div(F.col("part"), FANOUT) * (width * FANOUT * FANOUT)).alias("up"),
            (F.lit(None) if last else F.col("part") % FANOUT).cast("int").alias("at"),
            F.lit(None).cast("long").alias("first"), F.lit(None).cast("long").alias("size"), parent.alias("k"),
            F.lit(_TOP + top).alias("level")).write.parquet(f"{folder}/step={_TOP + top}")
        row = spark.read.schema(schema).parquet(f"{folder}/step={_TOP + top}").select("k", "hash", "lo", "hi")
        top, width = top + 1, width * FANOUT
    found = row.select(F.lower(F.hex("hash")).alias("root")).first()
    nodes = _read(spark, folder, schema, level > 1 or top > 1)
    return Manifest(marked, nodes, groups, found["root"] if found else None)


def _read(spark: SparkSession, folder: str, schema: str, any_level: bool) -> DataFrame:
    rows = spark.read.schema(schema).parquet(folder) if any_level else spark.createDataFrame([], schema)
    return rows.drop("step")


def _parent(level: int, n_groups: int) -> tuple[Column, Column]:
    """Key of the node above, and the place below it, of the node at ``level - 1`` that begins at leaf ``g``."""
    span = FANOUT ** level
    inside = F.col("g") - F.col("first")
    own = F.lit(level * _LEVEL) + F.col("first") + _div(inside, span) * span
    above = F.lit((_TOP + 1) * _LEVEL) + _div(F.col("k"), FANOUT) * FANOUT if n_groups > 1 else F.lit(None).cast("long")
    below_group = F.col("size") > span // FANOUT  # more than one node at that level
    return (F.when(below_group, own).otherwise(above),
            F.when(below_group, _div(inside, span // FANOUT) % FANOUT).otherwise(F.col("k") % FANOUT).cast("int"))


_CLIMB = """
WITH RECURSIVE climb(g, stretch, up, at, hash, step, siblings) AS (
  SELECT g, stretch, up, at, tampered, 0, CAST(NULL AS BINARY) FROM {leaves}
  UNION ALL
  SELECT c.g, c.stretch, n.up, n.at,
    unhex(sha2(CAST(array_join(transform(n.kids, (d, i) -> lower(hex(IF(i = c.at, c.hash, d)))), '') AS BINARY), 256)),
    c.step + 1,
    unhex(array_join(transform(filter(n.kids, (d, i) -> i <> c.at), d -> hex(d)), ''))
  FROM climb c JOIN {nodes} n ON n.node = c.up AND n.stretch = c.stretch)
SELECT g, step, IF(up IS NULL, hash, NULL) AS folded, siblings FROM climb
"""


def climb(manifest: Manifest) -> DataFrame:
    """``(g, folded_root, proof_sha256)``: every leaf's way to the root, step by step, then its digest.

    Only a leaf's last step keeps the folded hash.  The recursion's row limit counts all rows of
    the climb, so it is lifted while the result is written to the shared folder.
    """
    spark = manifest.leaves.sparkSession
    leaves = manifest.leaves.select("g", _div(F.col("g"), SPREAD).alias("stretch"), "up", "at", "tampered")
    nodes = stored(manifest.nodes.select("node", "up", "at", "kids", F.explode(F.sequence(
        _div(F.col("lo"), SPREAD), _div(F.col("hi"), SPREAD))).alias("stretch")), "merkle-copies")
    ways = spark.sql(_CLIMB, leaves=leaves, nodes=nodes).groupBy("g").agg(
        F.max("folded").alias("folded"), F.sort_array(F.collect_list(F.struct("step", "siblings"))).alias("steps"))  # one per level
    siblings = F.array_join(F.transform("steps", lambda s: F.lower(F.hex(s["siblings"]))), "")
    ways = ways.select("g", F.lower(F.hex("folded")).alias("folded_root"), F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"))
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit, None)
    spark.conf.set(limit, "-1")
    try:
        return stored(ways, "merkle-climb")
    finally:
        if before is None:
            spark.conf.unset(limit)
        else:
            spark.conf.set(limit, before)


def verify(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", text_col: str = "text",
           fields: Sequence[str] = FIELDS) -> DataFrame:
    """``(id, leaf, subroot, root, proof_sha256, folded_root, verified)`` per row of ``docs``."""
    manifest = build(docs, id_col, group_col, text_col, fields)
    rows = lookup(manifest.leaves.select("g", "id", "leaf", "k"), manifest.groups.select("k", "subroot"), ["k"], ["g"])
    root = F.lit(manifest.root).cast("string")
    return rows.join(climb(manifest), "g").select(
        F.col("id").alias(id_col), F.lower(F.hex("leaf")).alias("leaf"), F.lower(F.hex("subroot")).alias("subroot"),
        root.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"))
