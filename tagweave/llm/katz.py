"""Language-model scores by Katz backoff over word bigrams.

Tokens of a text: its words with A-Z lower-cased, then one end.  The model is trained on
the rows that ``held_out`` leaves out:

* unigrams: ``p(w) = d(c) c / N``, the discounted mass going to one unknown type;
* bigrams: ``p(w|h) = d(c) c / c(h)`` if the pair was seen, else ``alpha(h) p(w)``, with
  ``alpha(h) = (1 - sum p(seen|h)) / (1 - sum p(seen))``, so every context's
  probabilities sum to exactly 1 over the training types and the unknown one.  The first
  token's context is a start mark; an unseen context has ``alpha = 1``.

``d`` is Katz's Good-Turing discount for counts up to ``K``.  Where the counts of counts
don't allow it (small tables) ``K`` is lowered, at last to ``d(r) = (r - 0.5) / r``.  A
distribution without any discounted count gets one more in its denominator, so that some
mass is always left.

How it runs: texts are packed once into chunks of about ``CHUNK_BYTES`` (a local
vocabulary and a token stream).  A chunk asks for each of its distinct words, and then for
each of its distinct bigrams, once: the requests are dealt to partitions by word, and by
context and (for frequent contexts) follower; a partition sums the training counts of all
chunks, stores its share of the count table and answers.  So a frequent word costs one
request per chunk and no task holds a whole context.  The count tables are Parquet tables
partitioned by ``kind`` under the model's folder: ``unigram`` (word hashes, ids, counts)
and ``bigram`` (id pairs, counts); the driver sees counts of counts only.

Cases: a null or empty text is just the end; a null id counts as the empty text for the
fold; repeated rows count and are scored each; without training rows every probability is
the unknown type's 1 (score 0); an empty table gives no rows; other input columns are not
read.  Words are told apart by a 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, DoubleType, IntegerType, LongType, StructField,
                               StructType)

from tagweave.llm.common import Words, column, mix64, pieces, scratch

K = 5
CHUNK_BYTES = 10 << 20
WORDS_PER_PARTITION = 1 << 20
TOKENS_PER_PARTITION = 3 << 19
LEAST_PARTITIONS = 16
END = np.uint64(0xE5D0F7E5D0F7E5D1)  # the end token's word hash
START_ID = np.uint64(0)
FIRST_ID = 1  # of the words


def put(values: np.ndarray) -> bytes:
    """Values from 0 as compressed byte planes: 4, or 8 if one needs more."""
    width = 8 if len(values) and int(values.max()) >> 32 else 4
    raw = np.ascontiguousarray(values, f"<u{width}").view(np.uint8).reshape(-1, width).T
    return len(values).to_bytes(4, "little") + bytes([width]) + \
        pa.compress(np.ascontiguousarray(raw).tobytes(), "zstd", asbytes=True)


def take(blob: bytes) -> np.ndarray:
    n, width = int.from_bytes(blob[:4], "little"), blob[4]
    raw = pa.decompress(blob[5:], width * n, "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, n).T).view(f"<u{width}").reshape(-1)


def distinct_pairs(id1: np.ndarray, id2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first ids, second ids, an index of each, place of every row) of the distinct pairs, ordered."""
    if not len(id1) or not int(max(id1.max(), id2.max())) >> 32:  # both fit into one key
        keys, one, which = np.unique((id1 << np.uint64(32)) | id2, return_index=True, return_inverse=True)
        return keys >> np.uint64(32), keys & np.uint64(0xFFFFFFFF), one, which
    order = np.lexsort((id2, id1))
    a, b = id1[order], id2[order]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    return a[new], b[new], order[new], which


def discounts(counts: list[int]) -> np.ndarray:
    """``d[r]`` for r = 0..len-1 from counts of counts ``n[1..K+1]`` (index 0 unused); d = 1 above."""
    for k in range(K, 0, -1):
        n = counts
        if any(n[r] == 0 for r in range(1, k + 2)):
            continue
        a = (k + 1) * n[k + 1] / n[1]
        if a >= 1:
            continue
        d = [((r + 1) * n[r + 1] / (r * n[r]) - a) / (1 - a) for r in range(1, k + 1)]
        if all(0 < x < 1 for x in d):
            return np.array([1.0, *d] + [1.0] * (K - k))
    return np.array([1.0] + [(r - 0.5) / r for r in range(1, K + 1)])


@dataclass
class Unigrams:
    """Global figures of the unigram table; ``p`` gives probabilities from counts."""
    total: int
    types: int
    d: np.ndarray
    denominator: float
    unknown: float

    @classmethod
    def of(cls, total: int, types: int, counts: list[int]) -> "Unigrams":
        d = discounts(counts)
        freed = sum((1 - d[r]) * r * counts[r] for r in range(1, K + 1))
        denominator = float(total if freed > 0 else total + 1)
        return cls(total, types, d, denominator, (denominator - total + freed) / denominator)

    def p(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, _discounted(self.d, c) / self.denominator, self.unknown)


def _discounted(d: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.where(c <= K, d[np.minimum(c, K)], 1.0) * c


class Chunk:
    """The token stream of one chunk and its bigrams, from the chunk's row."""

    def __init__(self, row: dict):
        self.held = np.array(row["held"], bool)
        size = np.array(row["sizes"], np.int64) + 1  # with the end
        rank = take(row["tokens"])
        self.words = take(row["order"])[rank]  # local word numbers, texts concatenated
        self.ends = np.cumsum(size)
        self.size = size

    def tokens(self, end_word: int) -> np.ndarray:
        """Local word number of every token, ends included."""
        out = np.full(int(self.ends[-1]), end_word, np.int64)
        keep = np.ones(len(out), bool)
        keep[self.ends - 1] = False
        out[keep] = self.words
        return out

    def per_text(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(np.repeat(np.arange(len(self.size)), self.size), weights=values, minlength=len(self.size))


def _spread(id1: np.ndarray, id2: np.ndarray, c1: np.ndarray, parts: int, heavy: float) -> tuple[np.ndarray, np.ndarray]:
    """(partition, number of partitions of the context) of bigrams: frequent contexts take several."""
    ways = np.minimum(1 + (c1 // heavy).astype(np.int64), parts)
    salt = (mix64(id2 + np.uint64(1)) % ways.astype(np.uint64)).astype(np.int64)
    return ((mix64(id1 + np.uint64(7)) % np.uint64(parts)).astype(np.int64) + salt) % parts, ways


class Requests:
    """A chunk's distinct bigrams in the order in which they are asked, by partition."""

    def __init__(self, chunk: Chunk, ids: np.ndarray, c: np.ndarray, starts: int, parts: int, heavy: float):
        tokens = chunk.tokens(len(ids) - 1)
        id2 = ids[tokens]
        first = np.zeros(len(tokens), bool)
        first[chunk.ends - chunk.size] = True
        id1 = np.concatenate([[START_ID], id2[:-1]])
        id1[first] = START_ID
        c1 = np.concatenate([[0], c[tokens][:-1]])
        c1[first] = starts
        self.tokens = tokens
        self.id1, self.id2, one, self.which = distinct_pairs(id1, id2)
        train = np.repeat(~chunk.held, chunk.size)
        self.n = np.bincount(self.which, weights=train, minlength=len(one)).astype(np.int64)
        self.c1, self.c2 = c1[one], c[tokens[one]]
        self.part, ways = _spread(self.id1, self.id2, self.c1, parts, heavy)
        wanted = np.unique(id1[np.repeat(chunk.held, chunk.size)])
        # contexts per partition; a frequent one is asked at each of its partitions
        change = np.flatnonzero(np.concatenate([[True], self.id1[1:] != self.id1[:-1]])) if len(one) else np.zeros(0, int)
        contexts, context_ways = self.id1[change], ways[change]
        base = (mix64(contexts + np.uint64(7)) % np.uint64(parts)).astype(np.int64)
        at = np.repeat(base, context_ways) + np.arange(int(context_ways.sum())) - \
            np.repeat(np.cumsum(context_ways) - context_ways, context_ways)
        who = np.repeat(contexts, context_ways)
        order = np.lexsort((who, at % parts))
        self.context, self.context_part = who[order], (at % parts)[order]
        self.wanted = np.isin(self.context, wanted)
        self.order = np.argsort(self.part, kind="stable")  # the pairs are ordered already


def _chunks(rows: DataFrame, path: str) -> DataFrame:
    id_type = rows.schema["id"].dataType
    schema = StructType([
        StructField("chunk", LongType()), StructField("doc_ids", ArrayType(id_type)),
        StructField("held", ArrayType(BooleanType())), StructField("sizes", ArrayType(LongType())),
        StructField("vocabulary", BinaryType()), StructField("counts", BinaryType()),
        StructField("order", BinaryType()), StructField("tokens", BinaryType()),
        StructField("n_vocabulary", LongType()), StructField("n_tokens", LongType())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 24
        held, sizes, hashes, ids, load = [], [], [], [], 0

        def flush():
            nonlocal number, held, sizes, hashes, ids, load
            out_held, size, words = np.concatenate(held), np.concatenate(sizes), np.concatenate(hashes)
            key = pa.concat_arrays(ids)
            train = np.repeat(~out_held, size)
            vocabulary, which, times = np.unique(words, return_inverse=True, return_counts=True)
            counts = np.bincount(which, weights=train, minlength=len(vocabulary)).astype(np.int64)
            frequent = np.argsort(-times, kind="stable")
            rank = np.empty(len(frequent), np.int64)
            rank[frequent] = np.arange(len(frequent))
            lists = pa.array([0, len(key)], pa.int32())
            out = pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()), pa.ListArray.from_arrays(lists, key),
                pa.ListArray.from_arrays(lists, pa.array(out_held)), pa.ListArray.from_arrays(lists, pa.array(size)),
                pa.array([vocabulary.tobytes()], pa.binary()), pa.array([put(counts)], pa.binary()),
                pa.array([put(frequent)], pa.binary()), pa.array([put(rank[which])], pa.binary()),
                pa.array([len(vocabulary)], pa.int64()), pa.array([int(size.sum() + len(size))], pa.int64())],
                names=schema.names)
            number, held, sizes, hashes, ids, load = number + 1, [], [], [], [], 0
            return out

        for batch in batches:
            for piece in pieces(batch, "text"):
                words = Words(column(piece, "text"), lower=True)
                hashes.append(words.hashes())
                sizes.append(np.diff(words.offsets).astype(np.int64))
                held.append(column(piece, "held").to_numpy(zero_copy_only=False).astype(bool))
                ids.append(column(piece, "id"))
                load += len(words.buf) + 64 * piece.num_rows
                if load >= CHUNK_BYTES:
                    yield flush()
        if ids:
            yield flush()

    rows.mapInArrow(pack, schema).write.parquet(path)
    return rows.sparkSession.read.schema(schema).parquet(path)


_ANSWER = StructType([
    StructField("kind", IntegerType()), StructField("chunk", LongType()), StructField("part", IntegerType()),
    StructField("a", BinaryType()), StructField("b", BinaryType()), StructField("c", BinaryType()),
    StructField("stats", ArrayType(LongType()))])
UNI, BI, UNI_TABLE, BI_TABLE = 0, 1, 2, 3  # answers and tables
_REQUEST = "part int, chunk long, a binary, b binary, c binary, d binary, e binary"


def _answers(rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(
        [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64())])],
        names=_ANSWER.names)


def _of_counts(c: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(c, K + 2), minlength=K + 3)[:K + 2].tolist()


def _unigrams(chunks: DataFrame, parts: int, path: str) -> DataFrame:
    bits = np.uint64(64 - (parts.bit_length() - 1))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words, counts = np.frombuffer(row["vocabulary"], np.uint64), take(row["counts"])
                cut = np.searchsorted(words >> bits, np.arange(parts + 1, dtype=np.uint64))
                # the end token goes to partition 0, once per chunk
                rows = [(q, row["chunk"], words[a:b].tobytes(), put(counts[a:b]))
                        for q, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if b > a or q == 0]
                ends = int((~np.array(row["held"], bool)).sum()).to_bytes(8, "little")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32()), *[pa.array([r[i] for r in rows], t) for i, t in
                     ((1, pa.int64()), (2, pa.binary()), (3, pa.binary()))],
                     pa.array([ends] * len(rows), pa.binary())], names=["part", "chunk", "a", "b", "c"])

    def answer(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
        words = [np.frombuffer(r["a"], np.uint64) for r in rows]
        every = np.concatenate(words)
        keys, which = np.unique(every, return_inverse=True)
        c = np.bincount(which, weights=np.concatenate([take(r["b"]) for r in rows]), minlength=len(keys)).astype(np.int64)
        part = rows[0]["part"]
        ends = sum(int.from_bytes(r["c"], "little") for r in rows) if part == 0 else 0
        out, at = [], 0
        for r, w in zip(rows, words):
            own = which[at:at + len(w)]
            at += len(w)
            out.append((UNI, r["chunk"], part, put(own), put(c[own]), None, [ends] if part == 0 else []))
        seen = c > 0
        both = np.concatenate([c[seen], [ends]]) if ends else c[seen]
        out.append((UNI_TABLE, None, part, keys[seen].tobytes(), put(np.flatnonzero(seen)), put(c[seen]),
                    [len(keys), int(both.sum()), len(both), ends, *_of_counts(both)]))
        return _answers(out)

    asked = chunks.select("chunk", "held", "vocabulary", "counts") \
        .mapInArrow(ask, "part int, chunk long, a binary, b binary, c binary")
    asked.groupBy("part").applyInArrow(answer, _ANSWER).write.partitionBy("kind").parquet(path)
    return chunks.sparkSession.read.schema(_ANSWER).parquet(path)


class _Local:
    """Ids and counts of a chunk's vocabulary (the end token last), from the unigram answers."""

    def __init__(self, answers: list[dict], offsets: dict[int, int], end_id: int):
        rows = sorted((r for r in answers if r["kind"] == UNI), key=lambda r: r["part"])
        ids = [take(r["a"]).astype(np.uint64) + np.uint64(offsets[r["part"]]) for r in rows]
        self.ends = next(r["stats"][0] for r in rows if r["part"] == 0)
        self.ids = np.concatenate([*ids, [np.uint64(end_id)]]).astype(np.uint64)
        self.c = np.concatenate([*[take(r["b"]).astype(np.int64) for r in rows], [self.ends]])


def _bigrams(chunks: DataFrame, unigram: DataFrame, uni: Unigrams, offsets: dict[int, int], end_id: int, parts: int,
             heavy: float, path: str) -> DataFrame:

    def ask(_key, left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        local = _Local(right.to_pylist(), offsets, end_id)
        req = Requests(Chunk(row), local.ids, local.c, local.ends, parts, heavy)
        part = req.part[req.order]
        cut = np.searchsorted(part, np.arange(parts + 1))
        ccut = np.searchsorted(req.context_part, np.arange(parts + 1))
        out: list[tuple] = []
        for p in range(parts):
            if ccut[p] == ccut[p + 1]:
                continue
            own, ctx = req.order[cut[p]:cut[p + 1]], slice(ccut[p], ccut[p + 1])
            # followers per asked context (a ping has none)
            many = np.searchsorted(req.id1[own], req.context[ctx], side="right") - \
                np.searchsorted(req.id1[own], req.context[ctx], side="left")
            step = np.diff(req.context[ctx], prepend=np.uint64(0))
            out.append((p, row["chunk"], put(step), put(many * 2 + req.wanted[ctx]), put(req.id2[own]),
                        put(req.n[own]), put(req.c2[own])))
        return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate(
            [pa.int32(), pa.int64()] + [pa.binary()] * 5)], names=["part", "chunk", "a", "b", "c", "d", "e"])

    def answer(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
        first, second, n, c2, contexts, wanted = [], [], [], [], [], []
        for r in rows:
            ctx, many = np.cumsum(take(r["a"]).astype(np.uint64)), take(r["b"])
            contexts.append(ctx)
            wanted.append((many & 1).astype(bool))
            first.append(np.repeat(ctx, (many >> 1).astype(np.int64)))
            second.append(take(r["c"]).astype(np.uint64))
            n.append(take(r["d"]))
            c2.append(take(r["e"]))
        size = [len(k) for k in first]
        id1, id2, one, which = distinct_pairs(np.concatenate(first), np.concatenate(second))
        c = np.bincount(which, weights=np.concatenate(n), minlength=len(one)).astype(np.int64)
        p2 = uni.p(np.concatenate(c2)[one].astype(np.int64))
        seen = c > 0
        # per context: the followers of each count up to K, and the unigram mass of the seen ones
        names, at = np.unique(np.concatenate([id1, *contexts]), return_inverse=True)
        owner = at[:len(id1)]
        low = seen & (c <= K)
        few = np.bincount(owner[low] * K + c[low] - 1, minlength=len(names) * K).reshape(-1, K)
        mass = np.bincount(owner[seen], weights=p2[seen], minlength=len(names))
        out, a, b = [], 0, len(id1)
        for r, k, ctx, want in zip(rows, size, contexts, wanted):
            own, who = which[a:a + k], at[b:b + len(ctx)]
            a, b = a + k, b + len(ctx)
            # which counts the context has; how often, and the mass, where they are wanted
            has = put(((few[who] > 0) << np.arange(K)).sum(1))
            out.append((BI, r["chunk"], r["part"], put(c[own]), has + put(few[who[want]].ravel()),
                        mass[who[want]].tobytes(), [len(has)]))
        out.append((BI_TABLE, None, rows[0]["part"], put(np.diff(id1[seen], prepend=np.uint64(0))),
                    put(id2[seen]), put(c[seen]), _of_counts(c[seen])))
        return _answers(out)

    answers = unigram.where(F.col("kind") == UNI)
    asked = chunks.select("chunk", "held", "sizes", "order", "tokens").groupBy("chunk") \
        .cogroup(answers.groupBy("chunk")).applyInArrow(ask, _REQUEST)
    asked.groupBy("part").applyInArrow(answer, _ANSWER).write.partitionBy("kind").parquet(path)
    return chunks.sparkSession.read.schema(_ANSWER).parquet(path)


def _scores(chunk: Chunk, local: _Local, answers: list[dict], uni: Unigrams, d: np.ndarray, parts: int,
            heavy: float) -> tuple[np.ndarray, ...]:
    """(n_known, base score, score) of every text of a chunk."""
    req = Requests(chunk, local.ids, local.c, local.ends, parts, heavy)
    c12 = np.zeros(len(req.id1), np.int64)
    has = np.zeros(len(req.context), np.int64)
    few = np.zeros((len(req.context), K))
    mass = np.zeros(len(req.context))
    cut = np.searchsorted(req.part[req.order], np.arange(parts + 1))
    ccut = np.searchsorted(req.context_part, np.arange(parts + 1))
    for r in answers:
        if r["kind"] != BI:
            continue
        p, split = r["part"], r["stats"][0]
        c12[req.order[cut[p]:cut[p + 1]]] = take(r["a"])
        ctx = np.arange(ccut[p], ccut[p + 1])
        has[ctx] = take(r["b"][:split])
        ctx = ctx[req.wanted[ctx]]
        few[ctx] = take(r["b"][split:]).reshape(-1, K)
        mass[ctx] = np.frombuffer(r["c"])
    # one entry per context: the sums of its partitions
    names, at = np.unique(req.context, return_inverse=True)
    cut_counts = (d[1:] < 1) << np.arange(K)
    some = np.bincount(at, weights=(has & cut_counts.sum()) > 0) > 0
    few = np.stack([np.bincount(at, weights=few[:, k]) for k in range(K)], 1) if len(at) else np.zeros((0, K))
    mass = np.bincount(at, weights=mass)
    who = np.searchsorted(names, req.id1)
    denominator = req.c1 + ~some[who]
    freed = (few * (1 - d[1:]) * np.arange(1, K + 1)).sum(1)[who] + ~some[who]
    p2 = uni.p(req.c2)
    with np.errstate(divide="ignore", invalid="ignore"):
        alpha = np.where(req.c1 > 0, freed / denominator / (1 - mass[who]), 1.0)
        p = np.where(c12 > 0, _discounted(d, c12) / denominator, alpha * p2)
        log_p = np.log10(p)
    base = np.log10((local.c + 0.1) / (uni.total + 0.1 * (uni.types + 1)))
    return (chunk.per_text(local.c[req.tokens] > 0), chunk.per_text(base[req.tokens]), chunk.per_text(log_p[req.which]))


def default_fold(id_col: Column) -> Column:
    """Held out: crc32 of the id as text leaves no remainder by 10."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: Column | None = None,
          path: str | None = None) -> DataFrame:
    """Train on the rows that aren't held out and score all rows.

    Returns ``(id, held_out, n_tokens, n_known, train_tokens, base_score, score)``, scores
    as log10; ``base_score`` is the add-0.1 unigram score.  ``path`` is the model's folder
    (a fresh one in the session's shared folder by default).
    """
    spark = docs.sparkSession
    path = path or scratch(spark, "katz")
    held = F.coalesce(default_fold(F.col(id_col)) if held_out is None else held_out, F.lit(False))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), held.alias("held"))
    chunks = _chunks(rows, f"{path}/chunks")
    words, tokens = chunks.agg(F.sum("n_vocabulary"), F.sum("n_tokens")).first()
    uni_parts = 1 << max((int(words or 0) // WORDS_PER_PARTITION).bit_length(), LEAST_PARTITIONS.bit_length() - 1)
    unigram = _unigrams(chunks, uni_parts, f"{path}/unigrams")
    stats = sorted((r["part"], r["stats"]) for r in
                   unigram.where(F.col("kind") == UNI_TABLE).select("part", "stats").collect())
    offsets, at = {}, FIRST_ID
    for part, s in stats:
        offsets[part], at = at, at + s[0]
    uni = Unigrams.of(sum(s[1] for _, s in stats), sum(s[2] for _, s in stats),
                      [sum(s[4 + r] for _, s in stats) for r in range(K + 2)])
    parts = max(LEAST_PARTITIONS, int(tokens or 0) // TOKENS_PER_PARTITION)
    heavy = max(uni.total / (4 * parts), 1.0)
    bigram = _bigrams(chunks, unigram, uni, offsets, at, parts, heavy, f"{path}/bigrams")
    found = bigram.where(F.col("kind") == BI_TABLE).select(*[F.sum(F.get("stats", F.lit(r))) for r in range(K + 2)]).first()
    d = discounts([int(x or 0) for x in found])
    schema = StructType([
        StructField(id_col, docs.schema[id_col].dataType), StructField("held_out", BooleanType()),
        StructField("n_tokens", LongType()), StructField("n_known", LongType()), StructField("train_tokens", LongType()),
        StructField("base_score", DoubleType()), StructField("score", DoubleType())])

    def evaluate(_key, left: pa.Table, right: pa.Table) -> pa.Table:
        row, answers = left.to_pylist()[0], right.to_pylist()
        chunk = Chunk(row)
        known, base, total = _scores(chunk, _Local(answers, offsets, at), answers, uni, d, parts, heavy)
        return pa.table([left["doc_ids"].chunk(0).flatten(), pa.array(chunk.held), pa.array(chunk.size),
                         pa.array(known.astype(np.int64)), pa.array(np.full(len(known), uni.total, np.int64)),
                         pa.array(base), pa.array(total)], names=schema.names)

    answers = unigram.where(F.col("kind") == UNI).unionByName(bigram.where(F.col("kind") == BI))
    return chunks.select("chunk", "doc_ids", "held", "sizes", "order", "tokens").groupBy("chunk") \
        .cogroup(answers.groupBy("chunk")).applyInArrow(evaluate, schema)
