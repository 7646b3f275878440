"""Source divergence audit: which terms and which other sources set a source apart.

``audit`` counts the terms of every (lang, source) group, keeps the terms that ``MIN_DOCS``
documents of the language hold, gives every kept term a smoothed whole-number share in every
group and language, and returns per group the other sources by summed divergence (part
``pair``) and the terms used more than in the language (part ``term``, ``TOP`` ranks).

Method: ``bytes.translate`` lowers A-Z and blanks every other ASCII byte in one pass,
``bytes.split`` gives the terms and one ``Counter`` per document their frequencies; a task
adds these up per group and hands over sparse rows (lang, source, term, occurrences,
documents) whenever it holds ``HELD`` of them, so its memory is bounded.  One exchange by
(lang, term) brings a term's rows of all groups together: its sums, its document frequency
and its language total are taken there.

With p and q the shares of a term in two groups, most terms are missing in a group and have
that group's share of a zero count.  So a pair's sum over all V kept terms is V times the
value of two missing terms, plus a correction per distinct count of either group (many terms
share a count), plus one per term that both hold; no (term x group x group) table is built.

Cases: null text, lang and source are empty texts; a group without terms takes part with
zero counts; repeated rows are documents of their own; an empty table gives no rows; other
input columns are not read.  All sums are exact: ``1e9 * (count + 1) / (N + V)`` is taken by
long division in base 1000, so counts to 9e15 stay inside 64 bits (ANSI mode raises beyond).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagweave.llm.common import column, lookup, stored

MIN_DOCS = 3
TOP = 200
HELD = 200_000  # sparse rows a task holds before it hands them over
CHUNK = 1 << 20  # bytes of a long text that are split at once

TERMS = bytes(b if b >= 0x80 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 0x20 for b in range(256))


def term_counts(text: bytes) -> Counter:
    """The terms of one text and their frequencies."""
    plain = text.translate(TERMS)
    if len(plain) <= CHUNK:
        return Counter(plain.split())
    out: Counter = Counter()
    at = 0
    while at < len(plain):
        end = plain.find(b" ", at + CHUNK)
        end = len(plain) if end < 0 else end
        out.update(plain[at:end].split())
        at = end
    return out


def _tallies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def handed() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(n)), pa.array([source] * len(n)),
                     pa.array(list(n), pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64()),
                     pa.array([docs[t] for t in n], pa.int64())],
                    names=["lang", "source", "term", "n", "docs"])
        held.clear()

    rows = 0
    for batch in batches:
        for lang, source, text in zip(column(batch, "lang").to_pylist(), column(batch, "source").to_pylist(),
                                      column(batch, "text")):
            found = term_counts(text.as_py())
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            before = len(n)
            n.update(found)
            docs.update(found.keys())
            rows += len(n) - before
            if rows >= HELD:
                yield from handed()
                rows = 0
    yield from handed()


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def kept_terms(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
               min_docs: int = MIN_DOCS) -> DataFrame:
    """``(lang, source, term, n, lang_n, head)`` of the kept terms a group holds; ``head`` marks one row per (lang, term)."""
    rows = docs.select(_text(lang_col).alias("lang"), _text(source_col).alias("source"),
                       _text(text_col).cast("binary").alias("text"))
    tallies = rows.mapInArrow(_tallies, "lang string, source string, term string, n long, docs long")
    # dealt by (lang, term): the sums per group, the windows over a term and its filter need no further exchange
    per_group = tallies.repartition("lang", "term").groupBy("lang", "term", "source") \
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    return per_group.select("lang", "source", "term", "n", F.sum("docs").over(term).alias("lang_docs"),
                            F.sum("n").over(term).alias("lang_n"),
                            (F.row_number().over(term.orderBy("source")) == 1).alias("head")) \
        .where(F.col("lang_docs") >= min_docs).drop("lang_docs")


def share(count: Column, total: Column) -> Column:
    """``1 + floor(1000000000 * (count + 1) / total)`` without leaving 64 bits."""
    def div(a: Column, b: Column) -> Column:
        return F.call_function("div", a, b)

    top = count + 1
    whole, rest = div(top, total), top % total
    for _ in range(3):
        whole, rest = whole * 1000 + div(rest * 1000, total), (rest * 1000) % total
    return whole + 1


def divergence(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / q)`` of two shares."""
    return F.call_function("div", (p - q) * (p - q), q)


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` (see the module)."""
    terms = stored(kept_terms(docs, text_col, lang_col, source_col, min_docs), "audit-terms")
    langs = terms.groupBy("lang").agg(F.sum(F.col("head").cast("long")).alias("v"), F.sum("n").alias("lang_total"))
    sums = terms.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select(_text(lang_col).alias("lang"), _text(source_col).alias("source")).distinct() \
        .join(sums, ["lang", "source"], "left").join(langs, "lang", "left") \
        .select("lang", "source", F.coalesce("v", F.lit(0)).cast("long").alias("v"),
                (F.coalesce("total", F.lit(0)) + F.coalesce("v", F.lit(0))).alias("total"),
                (F.coalesce("lang_total", F.lit(0)) + F.coalesce("v", F.lit(0))).alias("lang_total"))
    groups = stored(groups.withColumn("p0", F.when(F.col("v") > 0, share(F.lit(0).cast("long"), F.col("total")))),
                    "audit-groups")
    shares = lookup(terms, groups.where("v > 0"), ["lang", "source"], ["term"]) \
        .withColumn("p", share(F.col("n"), F.col("total"))).withColumn("q", share(F.col("lang_n"), F.col("lang_total")))
    shares = stored(shares.select("lang", "source", "term", "n", "p", "p0", "q"), "audit-shares")

    distinctive = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                               divergence(F.col("p"), F.col("q")).alias("value"))
    return _ranked(distinctive).where(F.col("rank") <= top).unionByName(_ranked(_pairs(shares, groups)))


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def _pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """Part ``pair``, unranked: one row per ordered pair of sources of a language."""
    f, col = divergence, F.col
    own = groups.select("lang", "source", "v", "p0")
    other = groups.select("lang", col("source").alias("item"), col("p0").alias("q0"))
    # both terms missing, V times
    sums = own.join(other, "lang").where("source <> item").select(
        "lang", "source", "item", F.coalesce(col("v") * f(col("p0"), col("q0")), F.lit(0).cast("long")).alias("value"))
    # missing in one of the two: as many terms as have that count there
    counts = stored(shares.groupBy("lang", "source", "p", "p0").agg(F.count(F.lit(1)).alias("terms")), "audit-counts")
    missing = counts.join(other, "lang").where("source <> item")
    nothing = f(col("p0"), col("q0"))
    in_own = missing.select("lang", "source", "item", (col("terms") * (f(col("p"), col("q0")) - nothing)).alias("value"))
    # the same rows seen from the other side: the holder is the item
    back = f(col("q0"), col("p0"))
    in_other = missing.select("lang", col("item").alias("source"), col("source").alias("item"),
                              (col("terms") * (f(col("q0"), col("p")) - back)).alias("value"))
    # in both
    right = shares.select("lang", "term", col("source").alias("item"), col("p").alias("q"), col("p0").alias("q0"))
    both = shares.drop("q").join(right, ["lang", "term"]).where("source <> item") \
        .select("lang", "source", "item", (f(col("p"), col("q")) - f(col("p"), col("q0")) - f(col("p0"), col("q"))
                                           + f(col("p0"), col("q0"))).alias("value"))
    parts = [part.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")) for part in (in_own, in_other, both)]
    for part in parts:
        sums = sums.unionByName(part)
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")) \
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
