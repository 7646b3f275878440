"""Benchmark decontamination: BM25 over test items with block-max WAND, then overlap checks.

Words are runs of letters, digits and non-ASCII bytes, A-Z lower-cased.  Every document is
cut into overlapping passages twice as long as the longest item (so any passage copy of an
item lies whole in one of them), and every passage queries an inverted index of the items.
An item's score is divided by its score for its own text, and all items that reach
``MIN_SCORE`` are retrieved.  As in block-max WAND, upper bounds decide what is scored: a
passage whose terms' maxima don't reach the threshold is skipped, then blocks of items
whose block maxima don't reach it; only postings in the remaining blocks are added up.
The bounds are exact, so nothing above the threshold is lost.

A retrieved item is a leak if the passage holds ``MIN_QUESTION`` of the question's shingles
and ``MIN_ANSWER`` of the answer's.  Shingles have ``N`` words; parts of fewer than
``SHORT`` words have shorter ones (``SHORT_N``), so one changed word of a short part doesn't
take most of them.  The answer is the text after the last line break (of the item's trimmed
text), the question all before; a text of one line is all question.

Items are indexed in shards of at most ``SHARD_BYTES`` of text each.  Document frequencies,
the mean length and the longest item are those of all items, whatever the number of shards,
so scores and results don't depend on it.  One shard at a time is built and held against all
documents, and beyond the first its result is written before the next is built: the driver
and the tasks never hold more than one.

Cases: null or empty texts (of documents or items) have no words and match nothing; an
item of few words is one shingle; repeated documents are judged each, repeated items are
reported each; empty tables give no rows; other columns are not read by ``leaks`` and are
kept by ``clean``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DoubleType, StructField, StructType

from tagweave.llm.common import Words, column, pieces, shingles, stored

N = 5
SHORT_N = ((12, 2), (24, 3))  # (words below which, words of a shingle)
SHORT = SHORT_N[-1][0]
K1, B = 1.2, 0.75
BLOCK = 16
MIN_SCORE = 0.5
MIN_QUESTION = 0.7
MIN_ANSWER = 0.5
SHARD_BYTES = 16 << 20
LEAST_STRIDE = 64


def _ragged(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The ranges ``begin[i] .. begin[i] + size[i]`` one after the other."""
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begin - (ends - size), size)


def shingle_words(words: int) -> int:
    """Words of a shingle for a part of so many words."""
    return next((n for below, n in SHORT_N if words < below), N)


def question_answer(text: str) -> tuple[str, str]:
    question, _, answer = (text or "").strip().rpartition("\n")
    return (question, answer) if question else (answer, "")


@dataclass(frozen=True)
class Statistics:
    """Of all items: their number, mean and greatest length in words, and how many hold each of some terms (ascending)."""

    items: int
    mean: float
    longest: int
    terms: np.ndarray
    df: np.ndarray


class Index:
    """Postings of the items by term and block of ``BLOCK`` items, with block and term maxima.

    ``every`` gives the statistics of all items where these are only some.
    """

    def __init__(self, ids: list, texts: list[str], every: Statistics | None = None):
        self.ids = ids
        words = Words(pa.array(texts, pa.large_string()), plain=True)
        size = np.diff(words.offsets)
        item = np.repeat(np.arange(len(texts)), size)
        self.terms, term = np.unique(words.hashes(), return_inverse=True)
        pair, tf = np.unique(term * np.int64(max(len(texts), 1)) + item, return_counts=True)
        self.term, self.item = pair // max(len(texts), 1), pair % max(len(texts), 1)
        if every is None:
            every = Statistics(len(texts), float(size.mean()) if len(size) else 0.0, int(size.max(initial=0)), self.terms,
                               np.bincount(self.term, minlength=len(self.terms)))
        self.stride = max(LEAST_STRIDE, every.longest)
        df = every.df[np.searchsorted(every.terms, self.terms)]
        idf = np.log(1 + (every.items - df + 0.5) / (df + 0.5))
        length = K1 * (1 - B + B * size / max(every.mean, 1))
        weight = idf[self.term] * tf * (K1 + 1) / (tf + length[self.item])
        own = np.bincount(self.item, weights=weight, minlength=len(texts))
        self.weight = weight / own[self.item]
        # postings are ordered by term and item, so a block of a term is a run
        block = self.item // BLOCK
        new = np.ones(len(block), bool)
        new[1:] = (self.term[1:] != self.term[:-1]) | (block[1:] != block[:-1])
        self.run = np.flatnonzero(new)
        self.run_size = np.diff(np.append(self.run, len(block)))
        self.run_block = block[self.run]
        self.run_max = np.maximum.reduceat(self.weight, self.run) if len(self.run) else np.zeros(0)
        runs = np.bincount(self.term[self.run], minlength=len(self.terms))
        self.term_run, self.term_runs = np.cumsum(runs) - runs, runs
        self.term_max = np.maximum.reduceat(self.run_max, self.term_run) if len(self.terms) else np.zeros(0)
        self.blocks = -(-len(texts) // BLOCK)
        self.parts = [[self._part(x) for x in question_answer(t)] for t in texts]

    @staticmethod
    def _part(text: str) -> tuple[int, np.ndarray]:
        """(shingle length, shingles) of a question or an answer."""
        words = Words(pa.array([text], pa.large_string()), plain=True)
        n = min(shingle_words(len(words.starts)), max(len(words.starts), 1))
        return n, np.unique(shingles(words.hashes(), words.offsets, n)[0])

    def retrieve(self, passage: np.ndarray, term: np.ndarray, least: float) -> tuple[np.ndarray, ...]:
        """(passage, item, score) of all pairs that reach ``least``; (passage, term) are distinct and ordered."""
        bound = np.bincount(passage, weights=self.term_max[term]) if len(passage) else np.zeros(0)
        keep = (bound >= least)[passage]
        passage, term = passage[keep], term[keep]
        # block maxima
        many = self.term_runs[term]
        run = _ragged(self.term_run[term], many)
        at = np.repeat(passage, many)
        key, which = np.unique(at * np.int64(max(self.blocks, 1)) + self.run_block[run], return_inverse=True)
        bound = np.bincount(which, weights=self.run_max[run], minlength=len(key))
        keep = bound[which] >= least
        run, at = run[keep], at[keep]
        # postings
        size = self.run_size[run]
        posting = _ragged(self.run[run], size)
        n = np.int64(max(len(self.ids), 1))
        key, which = np.unique(np.repeat(at, size) * n + self.item[posting], return_inverse=True)
        score = np.bincount(which, weights=self.weight[posting], minlength=len(key))
        keep = score >= least
        return key[keep] // n, key[keep] % n, score[keep]

    def overlaps(self, words: np.ndarray, item: int) -> tuple[float, float]:
        """Shares of the item's question and answer shingles that a passage holds (1 for none)."""
        out = []
        for n, part in self.parts[item]:
            have = shingles(words, np.array([0, len(words)]), n)[0]
            out.append(float(np.isin(part, have).mean()) if len(part) else 1.0)
        return out[0], out[1]


def search(index: Index, texts: pa.Array) -> list[tuple[int, int, float, float, float]]:
    """(text, item, score, question overlap, answer overlap) of every leak, once per text and item."""
    words = Words(texts, plain=True)
    hashes = words.hashes()
    count, stride = np.diff(words.offsets), index.stride
    if not len(hashes) or not len(index.terms):
        return []
    # word k of a text lies in the passages that begin at strides k // stride and the one before
    text = np.repeat(np.arange(len(count)), count)
    k = np.arange(len(hashes)) - np.repeat(words.offsets[:-1], count)
    n_passages = np.maximum(1, -(-count // stride) - 1)
    first = np.cumsum(n_passages) - n_passages
    at = np.minimum(np.searchsorted(index.terms, hashes), len(index.terms) - 1)
    known = np.flatnonzero(index.terms[at] == hashes)
    later = np.minimum(k[known] // stride, n_passages[text[known]] - 1) + first[text[known]]
    earlier = np.maximum(k[known] // stride - 1, 0) + first[text[known]]
    key = np.concatenate([later, earlier[earlier != later]]) * np.int64(len(index.terms)) + \
        np.concatenate([at[known], at[known][earlier != later]])
    key = np.unique(key)
    passage, item, score = index.retrieve(key // len(index.terms), key % len(index.terms), MIN_SCORE)
    owner = np.repeat(np.arange(len(count)), n_passages)
    found: dict[tuple[int, int], tuple[float, float, float]] = {}
    for p, i, s in zip(passage.tolist(), item.tolist(), score.tolist()):
        t = int(owner[p])
        a = int(words.offsets[t] + (p - first[t]) * stride)
        b = min(a + 2 * stride, int(words.offsets[t + 1]))
        q, r = index.overlaps(hashes[a:b], i)
        if q >= MIN_QUESTION and r >= MIN_ANSWER:
            found[t, i] = max(found.get((t, i), (0.0, 0.0, 0.0)), (s, q, r))
    return [(t, i, *v) for (t, i), v in sorted(found.items())]


class Shards(Sequence):
    """The indexes of all items, in shards of about ``SHARD_BYTES`` of text (one longer item stands alone), each built when asked for."""

    def __init__(self, items: DataFrame, id_col: str, text_col: str):
        text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
        self.rows = items.select(F.col(id_col).alias("id"), text.alias("text"))
        total = self.rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
        self.n = -(-2 * total // SHARD_BYTES) if total > SHARD_BYTES else 1
        self.shard = F.pmod(F.xxhash64("id", "text"), F.lit(self.n))
        if self.n > 1:
            terms = stored(self._terms(), "leak-terms")  # (shard, term or null, items, words, longest)
            sums = terms.where("term is null").agg(F.sum("items"), F.sum("words"), F.max("longest")).first()
            self.sums = sums[0], sums[1] / sums[0], sums[2]
            self.df = stored(terms.where("term is not null").groupBy("term").agg(F.sum("items").alias("df")), "leak-df")
            self.own = terms.where("term is not null").select("shard", "term").distinct()

    def _terms(self) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in pieces(batch, "text"):
                    words = Words(column(piece, "text"), plain=True)
                    size = np.diff(words.offsets)
                    shard = np.asarray(column(piece, "shard"))
                    item = np.repeat(np.arange(len(size)), size)
                    pair = np.unique(np.stack([item.astype(np.uint64), words.hashes()], 1), axis=0)
                    held, times = np.unique(np.stack([shard[pair[:, 0].astype(np.int64)].astype(np.uint64), pair[:, 1]], 1),
                                            axis=0, return_counts=True)
                    none = len(held)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.append(held[:, 0].astype(np.int64), -1)),
                        pa.array(np.append(held[:, 1].view(np.int64), 0), mask=np.arange(none + 1) == none),
                        pa.array(np.append(times, len(size)), pa.int64()),
                        pa.array(np.append(np.zeros(none, np.int64), size.sum())),
                        pa.array(np.append(np.zeros(none, np.int64), size.max(initial=0)))],
                        names=["shard", "term", "items", "words", "longest"])

        return self.rows.select("text", self.shard.alias("shard")).mapInArrow(
            run, "shard long, term long, items long, words long, longest long")

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, s: int) -> Index:
        if not 0 <= s < self.n:
            raise IndexError(s)
        own = self.rows.where(self.shard == s).orderBy("id", "text").collect()
        ids, texts = [r["id"] for r in own], [r["text"] for r in own]
        if self.n == 1:
            return Index(ids, texts)
        held = self.own.where(F.col("shard") == s).join(self.df, "term").select("term", "df").collect()
        terms = np.array([r["term"] for r in held], np.int64).view(np.uint64)
        order = np.argsort(terms)
        return Index(ids, texts, Statistics(*self.sums, terms[order], np.array([r["df"] for r in held], np.int64)[order]))


def indexes(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Shards:
    return Shards(items, id_col, text_col)


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(id, item id, score, question_overlap, answer_overlap)``: one row per document and leaked item."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    item_type = items.schema[item_id_col].dataType
    item_arrow = to_arrow_type(item_type)
    schema = StructType([StructField(id_col, docs.schema[id_col].dataType), StructField(item_id_col, item_type),
                         *[StructField(c, DoubleType()) for c in ("score", "question_overlap", "answer_overlap")]])

    def held_against(index: Index) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in pieces(batch, "text"):
                    found = search(index, column(piece, "text"))
                    if found:
                        text, item, *values = (list(x) for x in zip(*found))
                        yield pa.RecordBatch.from_arrays(
                            [column(piece, "id").take(pa.array(text)), pa.array([index.ids[i] for i in item], item_arrow),
                             *[pa.array(v, pa.float64()) for v in values]], names=schema.names)
        return rows.mapInArrow(run, schema)

    shards = indexes(items, item_id_col, item_text_col)
    if len(shards) == 1:
        return held_against(shards[0])
    # written shard by shard, so only one index is held
    return reduce(DataFrame.unionByName, [stored(held_against(x), "leaks") for x in shards])


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
          item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a leak, unchanged; one pass per index shard, each written before the next, no exchange."""
    def without(rows: DataFrame, index: Index) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in pieces(batch, text_col):
                    bad = np.zeros(piece.num_rows, bool)
                    bad[[t for t, *_ in search(index, column(piece, text_col))]] = True
                    yield piece.filter(pa.array(~bad))
        return rows.mapInArrow(run, docs.schema)

    shards = indexes(items, item_id_col, item_text_col)
    for s in range(len(shards) - 1):
        docs = stored(without(docs, shards[s]), "leaks-clean")
    return without(docs, shards[len(shards) - 1])
