"""Quality classifier with hierarchical empirical Bayes over sites.

Three sources of evidence per document:

* the text: a logistic regression on shares of character classes, repeated words, repeated
  lines and word lengths, fitted on at most ``MAX_LABELLED`` labelled documents (those with
  the smallest seeded hash of their id);
* its host (``source``) and its path (``source`` and ``lang``): the good share among the
  site's other documents, counted with their labels where known and else the text model's
  probabilities.  A host is shrunk toward the global share, a path toward its host, by
  beta priors whose strengths are fitted to the spread between the sites (moments), so a
  sparse site falls back on the level above.

``posterior`` adds the log odds of the text and of the path over the global share; a
document is kept at ``MIN_POSTERIOR`` or more.

Cases: a null or empty text gives the text model zero shares; null sources and languages
are sites of their own; repeated rows count and are judged each; of an id's different texts the
model is fitted on the one with the smallest features; repeated labels of an id
count by their mean, labels of unknown ids and null labels not at all; without labels of
both kinds every text has probability 0.5; an empty table gives no rows; other input
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import Words, column, lookup, pieces, stored
from tagweave.llm.quality_rules import CLASSES, base_counts, class_counts

MAX_LABELLED = 20_000
STEPS = 40
L2 = 1e-3
MIN_POSTERIOR = 0.5
CLIP = 0.005  # text probabilities stay this far from 0 and 1
FEATURES = [*CLASSES, "repeated", "dup_lines", "word_length", "log_words", "short"]


def features(texts: pa.Array) -> np.ndarray:
    """(texts, FEATURES)."""
    words = Words(texts)
    counts = base_counts(words, words.hashes())
    classes = class_counts(words)
    n = np.maximum(counts["n_words"], 1)
    return np.column_stack([classes / np.maximum(classes.sum(1, keepdims=True), 1), counts["n_repeat_words"] / n,
                            counts["n_dup_lines"] / n, counts["word_chars"] / n / 10, np.log1p(counts["n_words"]) / 10,
                            counts["n_words"] < 20])


def fit(x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Logistic regression by Newton steps on standardised features (L2; the bias is free)."""
    mean, scale = (x.mean(0), x.std(0)) if len(x) else (np.zeros(len(FEATURES)), np.ones(len(FEATURES)))
    scale = np.where(scale > 1e-9, scale, 1.0)
    weights = np.zeros(len(FEATURES) + 1)
    if 0 < y.sum() < len(y):
        z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
        ridge = np.full(len(weights), L2 * len(x))
        ridge[0] = 0
        for _ in range(STEPS):
            p = 1 / (1 + np.exp(-np.clip(z @ weights, -30, 30)))
            step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge + 1e-9),
                                   z.T @ (p - y) + ridge * weights)
            weights = weights - step
            if np.abs(step).max() < 1e-9:
                break
    return {"mean": mean, "scale": scale, "weights": weights}


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> dict[str, np.ndarray]:
    """The text model, fitted on a bounded sample of labelled documents."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()) \
        .groupBy(F.col(id_col).alias("id")).agg(F.avg(F.col(label_col).cast("double")).alias("y"))
    sample = known.orderBy(F.xxhash64(F.lit(1), "id"), "id").limit(MAX_LABELLED)
    # at most MAX_LABELLED rows of two numbers
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")) \
        .join(F.broadcast(sample), "id").select("id", "y", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                found = features(column(piece, "text"))
                yield pa.RecordBatch.from_arrays(
                    [column(piece, "id"), column(piece, "y"), pa.array(list(found), pa.list_(pa.float64()))], names=["id", "y", "x"])

    id_type = docs.schema[id_col].dataType.simpleString()
    found = rows.mapInArrow(run, f"id {id_type}, y double, x array<double>").groupBy("id").agg(F.min(F.struct("y", "x")).alias("v")).orderBy("id").select("v.*").collect()
    x = np.array([r["x"] for r in found]).reshape(len(found), len(FEATURES))
    return fit(x, np.array([float(r["y"] >= 0.5) for r in found]))


def text_scores(docs: DataFrame, model: dict[str, np.ndarray], id_col: str, text_col: str, source_col: str,
                lang_col: str) -> DataFrame:
    """``(id, host, lang, p)`` with the text model's probability of good quality."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("host"),
                       F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                z = (features(column(piece, "text")) - model["mean"]) / model["scale"]
                margin = model["weights"][0] + z @ model["weights"][1:]
                p = np.clip(1 / (1 + np.exp(-np.clip(margin, -30, 30))), CLIP, 1 - CLIP)
                yield pa.RecordBatch.from_arrays([column(piece, "id"), column(piece, "host"), column(piece, "lang"),
                                                  pa.array(p)], names=["id", "host", "lang", "p"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"id {id_type}, host string, lang string, p double")


def strength(n: Column, s: Column) -> list[Column]:
    """Aggregates for :func:`_moments` over groups with ``n`` documents and ``s`` good ones."""
    share = s / n
    return [F.count(F.lit(1)).alias("k"), F.sum(n).alias("n"), F.sum(s).alias("s"),
            F.sum(n * n).alias("nn"), F.sum(n * share * share).alias("q")]


def _moments(k: float, n: float, s: float, nn: float, q: float) -> float:
    """Beta prior strength whose spread explains that of the groups (large if they don't differ)."""
    if not n or k < 2 or n <= k:
        return 10.0
    mean = s / n
    within = mean * (1 - mean)
    if within <= 0:
        return 10.0
    between = (q - n * mean * mean - (k - 1) * within) / (n - nn / n)
    return float(np.clip(within / between - 1 if between > 0 else 1e4, 1.0, 1e4))


def _logit(p: Column) -> Column:
    return F.log(p / (F.lit(1.0) - p))


def judge(docs: DataFrame, labels: DataFrame, model: dict[str, np.ndarray], id_col: str = "doc_id",
          text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
          label_col: str = "quality") -> DataFrame:
    """``(id, text_score, host_share, path_share, posterior, kept)`` of every row of ``docs``."""
    scored = text_scores(docs, model, id_col, text_col, source_col, lang_col)
    known = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("l_id")) \
        .agg(F.avg(F.col(label_col).cast("double")).alias("label"))
    rows = stored(scored.join(known, F.col("id") == F.col("l_id"), "left").drop("l_id")
                  .withColumn("e", F.coalesce("label", "p")), "site-scores")
    paths = rows.groupBy("host", "lang").agg(F.count(F.lit(1)).cast("double").alias("path_n"), F.sum("e").alias("path_s"))
    paths = stored(paths, "site-paths")
    hosts = paths.groupBy("host").agg(F.sum("path_n").alias("host_n"), F.sum("path_s").alias("host_s"))
    top = hosts.agg(*strength(F.col("host_n"), F.col("host_s"))).first()
    low = paths.agg(*strength(F.col("path_n"), F.col("path_s"))).first()
    share = min(max((top["s"] or 0.0) / (top["n"] or 1.0), CLIP), 1 - CLIP)
    host_strength, path_strength = _moments(*top), _moments(*low)
    sites = paths.join(hosts.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h"))).drop("h")
    # a hot site's documents are dealt over salts where the sites are too many to broadcast
    keys = {k: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("")) for k, c in (("k_host", "host"), ("k_lang", "lang"))}
    out = lookup(rows.withColumns(keys), sites.withColumns(keys).drop("host", "lang"), ["k_host", "k_lang"], ["id", "p"])
    # a document's own evidence is left out of its site's
    host_share = (F.col("host_s") - F.col("e") + host_strength * share) / (F.col("host_n") - 1 + host_strength)
    path_share = (F.col("path_s") - F.col("e") + path_strength * F.col("host_share")) / (F.col("path_n") - 1 + path_strength)
    bound = lambda c: F.least(F.greatest(c, F.lit(CLIP)), F.lit(1 - CLIP))
    out = out.withColumn("host_share", bound(host_share)).withColumn("path_share", bound(path_share))
    odds = _logit(F.col("p")) + _logit(F.col("path_share")) - _logit(F.lit(share))
    out = out.withColumn("posterior", F.lit(1.0) / (F.lit(1.0) + F.exp(-odds)))
    return out.select(F.col("id").alias(id_col), F.col("p").alias("text_score"), "host_share", "path_share", "posterior",
                      (F.col("posterior") >= MIN_POSTERIOR).alias("kept"))
