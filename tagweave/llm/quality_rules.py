"""Quality rules: base counts and the divergence of a text from its language.

``judge`` compares two histograms of every text with the reference of its language by the
Jensen-Shannon distance (base 2, 0 to 1): its characters by class, and its words over the
language's ``COMMON`` most frequent words (ties: by the word's bytes) and "other".  The
references are counted over all texts that pass the base rules.

Guards: the character test needs ``MIN_CHARS`` characters, the word test ``MIN_WORDS``
words, and a language ``MIN_REFERENCE`` reference words; a test whose guard isn't met
passes, so texts of a stated language without a reference pass both (distances 0).  A
text of a null language is held against the reference with the smallest sum of both
distances.

Cases: a null or empty text has zero counts and fails the base rules; an empty table gives
no rows; repeated rows are judged alike; input columns other than id, text and language
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from tagweave.llm.common import BYTE_VALUE, Words, column, mix64, pieces, powers, stored

COMMON = 100
MIN_CHARS = 500
MIN_WORDS = 100
MIN_REFERENCE = 1000
MAX_CLASS_DISTANCE = 0.25
MAX_WORD_DISTANCE = 0.43
MIN_N_WORDS = 50
MAX_REPEAT_PERCENT = 50

CLASSES = ["lower", "upper", "digit", "space", "sentence", "symbol", "other"]
SYMBOLS = b"#*$%&|<>"
_CLASS = np.full(256, 6, np.int64)
_CLASS[:128] = 5
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[[0x20, 9, 10, 11, 12, 13]] = 3
_CLASS[list(b".,;:!?'\"()-")] = 4
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _dup_lines(words: Words) -> np.ndarray:
    """Per text: lines with a word that equal an earlier line of the text."""
    buf, bounds = words.buf, words.bounds
    out = np.zeros(len(bounds) - 1, np.int64)
    if not len(words.starts):
        return out
    breaks = buf == 10
    edge = np.concatenate([bounds[:-1], np.flatnonzero(breaks) + 1])
    starts = np.unique(edge[edge < len(buf)])
    size = np.diff(np.concatenate([starts, [len(buf)]]))
    pos = np.arange(len(buf)) - np.repeat(starts, size)
    value = BYTE_VALUE[buf] * powers(int(size.max()))[pos]
    value[breaks] = 0
    body = size - breaks[starts + size - 1]
    text = np.searchsorted(bounds, starts, side="right") - 1
    key = mix64(np.add.reduceat(value, starts) ^ (body.astype(np.uint64) << np.uint64(40)))
    has_word = np.add.reduceat(words.word_bytes.astype(np.int64), starts) > 0
    key, text = mix64(key ^ mix64(text.astype(np.uint64) + np.uint64(1)))[has_word], text[has_word]
    _, first = np.unique(key, return_index=True)
    again = np.ones(len(key), bool)
    again[first] = False
    return np.bincount(text[again], minlength=len(out))


def _repeat_words(hashes: np.ndarray, offsets: np.ndarray, n: int = 3) -> np.ndarray:
    """Per text: words inside an ``n``-word window that occurs twice or more in the text."""
    count, m = np.diff(offsets), len(hashes)
    text = np.repeat(np.arange(len(count)), count)
    at = np.flatnonzero(np.repeat(offsets[1:], count) - np.arange(m) >= n)
    value = mix64(text[at].astype(np.uint64) + np.uint64(1))
    for k in range(n):
        value = mix64(value ^ hashes[at + k]) + np.uint64(k + 1)
    _, which, times = np.unique(value, return_inverse=True, return_counts=True)
    hit = at[times[which] > 1] if len(at) else at
    covered = np.zeros(m + n, bool)
    for k in range(n):
        covered[hit + k] = True
    return np.bincount(text[covered[:m]], minlength=len(count))


def base_counts(words: Words, hashes: np.ndarray) -> dict[str, np.ndarray]:
    """The contract's counts of every text of the slice."""
    code_point = (words.buf & 0xC0) != 0x80
    return {"n_words": np.diff(words.offsets),
            "word_chars": _per_text(code_point & words.word_bytes, words.bounds),
            "n_symbols": _per_text(_IS_SYMBOL[words.buf], words.bounds),
            "n_dup_lines": _dup_lines(words),
            "n_repeat_words": _repeat_words(hashes, words.offsets)}


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    return (counts["n_words"] < MIN_N_WORDS) | \
        (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"])


def class_counts(words: Words) -> np.ndarray:
    """(texts, classes): characters by class; a code point counts once."""
    lead = (words.buf & 0xC0) != 0x80
    text = np.repeat(np.arange(len(words.bounds) - 1), np.diff(words.bounds))[lead]
    n = len(CLASSES)
    return np.bincount(text * n + _CLASS[words.buf[lead]], minlength=(len(words.bounds) - 1) * n).reshape(-1, n)


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Row-wise Jensen-Shannon distance of histograms (rows of ``p``) to ``q``; 0 for empty rows."""
    total = p.sum(1, keepdims=True)
    p = p / np.maximum(total, 1)
    q = q / max(q.sum(), 1)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(1)
        right = np.where(q > 0, q * np.log2(q / m), 0).sum(1)
    return np.where(total[:, 0] > 0, np.sqrt(np.maximum((left + right) / 2, 0)), 0.0)


def _strings(words: Words, which: np.ndarray) -> pa.Array:
    size = words.ends[which] - words.starts[which]
    ends = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(ends[-1]) + np.repeat(words.starts[which] - ends[:-1], size)
    return pa.Array.from_buffers(pa.large_string(), len(which),
                                 [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(words.buf[at])]).cast(pa.string())


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, dict]:
    """Per language: class counts, word total and the most frequent words with their counts.

    Words are counted per task and then summed by Spark; the driver receives one row per
    language and common word.
    """
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")) \
        .where(F.col("lang").isNotNull())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                words = Words(column(piece, "text"))
                hashes = words.hashes()
                lang = np.array(column(piece, "lang").to_pylist(), object)
                good = ~base_failed(base_counts(words, hashes))
                classes = class_counts(words)
                owner = np.repeat(np.arange(len(lang)), np.diff(words.offsets))
                for name in sorted(set(lang[good])):
                    mine = good & (lang == name)
                    at = np.flatnonzero(mine[owner])
                    _, first, times = np.unique(hashes[at], return_index=True, return_counts=True)
                    sums = classes[mine].sum(0)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * (len(first) + len(sums))),
                         pa.array([False] * len(first) + [True] * len(sums)),
                         pa.concat_arrays([_strings(words, at[first]), pa.array(CLASSES)]),
                         pa.array(np.concatenate([times, sums]), pa.int64())],
                        names=["lang", "is_class", "item", "n"])

    counted = rows.mapInArrow(count, "lang string, is_class boolean, item string, n long") \
        .groupBy("lang", "is_class", "item").agg(F.sum("n").alias("n"))
    out: dict[str, dict] = {}
    for r in _common(stored(counted, "op6-words")).collect():
        ref = out.setdefault(r["lang"], {"classes": np.zeros(len(CLASSES)), "words": [], "total": 0})
        if r["is_class"]:
            ref["classes"][CLASSES.index(r["item"])] = r["n"]
        elif r["item"] is None:
            ref["total"] = r["n"]
        else:
            ref["words"].append((r["item"], r["n"]))
    for ref in out.values():
        ref["words"].sort(key=lambda x: (-x[1], x[0].encode()))
    return out


def _common(counted: DataFrame) -> DataFrame:
    """The common words, word total (null item) and class counts of each language with ``MIN_REFERENCE`` words."""
    order = W.partitionBy("lang").orderBy(F.desc("n"), "item")
    words = counted.where("not is_class")
    top = words.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= COMMON).drop("rank")
    total = words.groupBy("lang", "is_class").agg(F.lit(None).cast("string").alias("item"), F.sum("n").alias("n")) \
        .where(F.col("n") >= MIN_REFERENCE)
    known = total.select("lang")
    return top.unionByName(counted.where("is_class")).join(known, "lang", "left_semi").unionByName(total)


class Judge:
    """The references, ready to judge texts inside a task."""

    def __init__(self, refs: dict[str, dict]):
        self.names = sorted(refs)
        self.classes = [refs[k]["classes"] for k in self.names]
        self.words, self.lookup = [], []
        for k in self.names:
            listed = refs[k]["words"]
            rest = refs[k]["total"] - sum(n for _, n in listed)
            self.words.append(np.array([n for _, n in listed] + [rest], float))
            own = Words(pa.array([w for w, _ in listed], pa.string())).hashes()
            order = np.argsort(own)
            self.lookup.append((own[order], order))

    def word_counts(self, hashes: np.ndarray, owner: np.ndarray, texts: int, k: int) -> np.ndarray:
        """(texts, common words and other) counts for language ``k``."""
        keys, place = self.lookup[k]
        width = len(self.words[k])
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        item = np.where(keys[at] == hashes, place[at], width - 1) if len(keys) else np.zeros(len(hashes), int)
        return np.bincount(owner * width + item, minlength=texts * width).reshape(texts, width)

    def verdicts(self, texts: pa.Array, langs: list[str | None]) -> dict[str, np.ndarray]:
        """Base counts, ``base_failed``, both distances and ``kept`` of every text."""
        words = Words(texts)
        hashes = words.hashes()
        out = base_counts(words, hashes)
        classes, n = class_counts(words), len(langs)
        owner = np.repeat(np.arange(n), out["n_words"])
        # -1: no language stated, any reference may be the nearest; -2: stated, but without a reference
        own = np.array([-1 if x is None else self.names.index(x) if x in self.names else -2 for x in langs], int)
        best = np.full((n, 2), np.inf)
        for k in range(len(self.names)):
            mine = np.flatnonzero((own == k) | (own == -1))
            if not len(mine):
                continue
            back = np.full(n, -1)
            back[mine] = np.arange(len(mine))
            use = back[owner] >= 0
            counts = self.word_counts(hashes[use], back[owner[use]], len(mine), k)
            pair = np.stack([js_distance(classes[mine], self.classes[k]), js_distance(counts, self.words[k])], 1)
            nearer = pair.sum(1) < best[mine].sum(1)
            best[mine[nearer]] = pair[nearer]
        best[np.isinf(best)] = 0
        odd = (classes.sum(1) >= MIN_CHARS) & (best[:, 0] > MAX_CLASS_DISTANCE)
        odd |= (out["n_words"] >= MIN_WORDS) & (best[:, 1] > MAX_WORD_DISTANCE)
        failed = base_failed(out)
        return out | {"base_failed": failed, "class_distance": best[:, 0], "word_distance": best[:, 1],
                      "kept": ~failed & ~odd}


def judge(docs: DataFrame, refs: dict[str, dict], id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> DataFrame:
    """Per row: id, base counts, ``base_failed``, both distances and ``kept``."""
    judge_ = Judge(refs)
    schema = StructType([StructField("id", docs.schema[id_col].dataType), *[StructField(c, LongType()) for c in COUNTS],
                         StructField("base_failed", BooleanType()), StructField("class_distance", DoubleType()),
                         StructField("word_distance", DoubleType()), StructField("kept", BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                found = judge_.verdicts(column(piece, "text"), column(piece, "lang").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [column(piece, "id"), *[pa.array(found[c]).cast(pa.int64()) for c in COUNTS],
                     *[pa.array(found[c]) for c in schema.names[len(COUNTS) + 1:]]], names=schema.names)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang"))
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def keep(docs: DataFrame, refs: dict[str, dict], text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that are kept, unchanged."""
    judge_ = Judge(refs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text_col):
                langs = column(piece, lang_col).cast(pa.string()).to_pylist()
                yield piece.filter(pa.array(judge_.verdicts(column(piece, text_col), langs)["kept"]))

    return docs.mapInArrow(run, docs.schema)
