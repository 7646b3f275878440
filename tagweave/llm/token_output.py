"""Token-ID output in patched frame-of-reference blocks.

``write_token_files`` encodes texts with a given tokenizer and writes one global stream
of ids in ascending document order; ``read_token_files`` reads the documents back.

A token folder holds two Parquet tables:

* ``segments``: one row per segment (a run of whole documents): its partition and place
  in the order, the document ids and lengths, and ``payload``, the packed ids.
* ``parts``: per partition the number of ids in all partitions before it.

Payload (little endian): magic ``TWP1``, u32 block count, u64 id count, then the block
index (u64 byte offset of every block from the payload's start), then the blocks.  A block
packs up to ``BLOCK`` ids: u32 minimum, u32 count, u16 width, u16 exception count, the low
``width`` bits of each id minus the minimum, exception positions (u16) and their whole
differences (u32).  The width is the bit length of the ``WIDTH_PERCENTILE`` of the
block's differences; larger ones are the exceptions.

Cases: a null or empty text has only the end id; rows with equal ids are ordered by the
text's hash (repeated rows are interchangeable); null ids come last; an empty table
gives an empty token folder; other input columns are not read.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import partial
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from tagweave.frames import literal_frame
from tagweave.llm.common import Words, column, pieces

MAGIC = b"TWP1"
BLOCK = 4096
WIDTH_PERCENTILE = 90
SEGMENT_IDS = 1 << 19
MAX_CACHED = 1_500_000
_ENCODERS: dict = {}
_HEAD = struct.Struct("<4sIQ")
_BLOCK = struct.Struct("<IIHH")


def pack(ids: np.ndarray) -> bytes:
    """One segment's payload."""
    ids = np.ascontiguousarray(ids, "<u4")
    count = -(-len(ids) // BLOCK)
    out, at = [], _HEAD.size + 8 * count
    offsets = []
    for k in range(count):
        block = ids[k * BLOCK:(k + 1) * BLOCK]
        low = block.min()
        diff = block - low
        width = int(np.percentile(diff, WIDTH_PERCENTILE, method="higher")).bit_length()
        over = np.flatnonzero(diff >> np.uint32(width)) if width < 32 else np.zeros(0, int)
        bits = np.unpackbits(diff.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
        raw = b"".join((_BLOCK.pack(int(low), len(block), width, len(over)),
                        np.packbits(bits.ravel(), bitorder="little").tobytes(),
                        over.astype("<u2").tobytes(), diff[over].astype("<u4").tobytes()))
        offsets.append(at)
        at += len(raw)
        out.append(raw)
    return _HEAD.pack(MAGIC, count, len(ids)) + np.array(offsets, "<u8").tobytes() + b"".join(out)


def _unpack_block(payload: memoryview, at: int) -> np.ndarray:
    low, n, width, exceptions = _BLOCK.unpack_from(payload, at)
    at += _BLOCK.size
    size = -(-n * width // 8)
    bits = np.unpackbits(np.frombuffer(payload, np.uint8, size, at), bitorder="little")[:n * width]
    wide = np.zeros((n, 32), np.uint8)
    wide[:, :width] = bits.reshape(n, width)
    diff = np.packbits(wide.ravel(), bitorder="little").view("<u4")
    at += size
    if exceptions:
        where = np.frombuffer(payload, "<u2", exceptions, at)
        diff[where] = np.frombuffer(payload, "<u4", exceptions, at + 2 * exceptions)
    return diff + np.uint32(low)


def unpack(payload: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids ``first`` to ``last`` of a payload; only the blocks they lie in are decoded."""
    magic, count, total = _HEAD.unpack_from(payload, 0)
    if magic != MAGIC:
        raise ValueError("not a token payload")
    last = total if last is None else min(last, total)
    if first >= last:
        return np.zeros(0, np.uint32)
    index = np.frombuffer(payload, "<u8", count, _HEAD.size)
    view = memoryview(payload)
    from_block, to_block = first // BLOCK, (last - 1) // BLOCK + 1
    ids = np.concatenate([_unpack_block(view, int(index[k])) for k in range(from_block, to_block)])
    return ids[first - from_block * BLOCK:last - from_block * BLOCK]


def _load(tokenizer: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer)


class WordCoder:
    """Ids of words, each distinct word encoded once by the tokenizer and then remembered.

    Holds at most ``MAX_CACHED`` words (a memory bound; it starts anew beyond).
    """

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.begin = self.size = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        return at, known

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids per text)."""
        words = Words(texts)
        keys, first, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > MAX_CACHED:
            self.clear()
        at, known = self._find(keys)
        if not known.all():
            coded = [e.ids for e in self.tokenizer.encode_batch_fast(
                [words.word(i).decode("utf-8") for i in first[~known]], add_special_tokens=False)]
            size = np.array([len(x) for x in coded], np.int64)
            ids = np.fromiter((i for x in coded for i in x), np.uint32, int(size.sum()))
            begin = np.cumsum(size) - size + len(self.flat)
            place = at[~known]
            self.keys = np.insert(self.keys, place, keys[~known])
            self.begin, self.size = np.insert(self.begin, place, begin), np.insert(self.size, place, size)
            self.flat = np.concatenate([self.flat, ids])
            at, _ = self._find(keys)
        if not len(which):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        entry = at[which]
        per_word = self.size[entry]
        ends = np.concatenate([[0], np.cumsum(per_word)])
        where = np.arange(int(ends[-1])) + np.repeat(self.begin[entry] - ends[:-1], per_word)
        return self.flat[where], np.diff(ends[words.offsets])


def _encode_texts(tokenizer, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    found = [e.ids for e in tokenizer.encode_batch_fast(texts.fill_null("").to_pylist(), add_special_tokens=False)]
    ids = [np.array(x, np.uint32) for x in found]
    return np.concatenate([np.zeros(0, np.uint32), *ids]), np.array([len(x) for x in found], np.int64)


def encoder(tokenizer: str):
    """A function from texts to (all ids, ids per text); kept per worker process, so words
    stay known between its tasks.

    Words are encoded alone where ``drops_space`` finds that this equals encoding whole texts.
    """
    if tokenizer not in _ENCODERS:
        loaded = _load(tokenizer)
        _ENCODERS[tokenizer] = WordCoder(loaded).encode if drops_space(tokenizer) else partial(_encode_texts, loaded)
    return _ENCODERS[tokenizer]


def drops_space(tokenizer_path: str) -> bool:
    """Whether the tokenizer splits at white space and drops it, so words can be encoded alone.

    Read from the file: the known form is a splitter that keeps only its matches, none of
    which can hold white space, and no added token that strips its surroundings.
    """
    import json
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = spec.get("pre_tokenizer") or {}
    steps = steps.get("pretokenizers", [steps])
    head = steps[0] if steps else {}
    pattern = (head.get("pattern") or {}).get("Regex", "")
    keeps_matches = head.get("type") == "Split" and head.get("behavior") == "Removed" and head.get("invert")
    spaceless = pattern.endswith(r"[^\s\p{L}\p{N}]+") and r"\s" not in pattern.replace(r"[^\s", "")
    added = any(" " in t["content"] or t.get("lstrip") or t.get("rstrip") or t.get("single_word")
                for t in spec.get("added_tokens") or [])
    return bool((head.get("type") == "WhitespaceSplit" or keeps_matches and spaceless and " " not in pattern)
                and not added)


def _with_end(ids: np.ndarray, sizes: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    out = np.full(len(ids) + len(sizes), end_id, np.uint32)
    keep = np.ones(len(out), bool)
    keep[np.cumsum(sizes + 1) - 1] = False
    out[keep] = ids
    return out, sizes + 1


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int,
                      id_col: str = "doc_id", text_col: str = "text",
                      segment_ids: int = SEGMENT_IDS) -> None:
    """Encode ``docs`` and write the token folder ``path`` (see the module docstring).

    The rows are range-partitioned by id and sorted, so each task writes a run of the
    order; only one count per partition reaches the driver.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType
    order = [F.col("id").asc_nulls_last(), F.xxhash64("text")]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order) \
        .withColumn("part", F.spark_partition_id())
    schema = StructType([
        StructField("part", IntegerType()), StructField("seg", IntegerType()),
        StructField("first", LongType()), StructField("n_ids", LongType()),
        StructField("doc_ids", ArrayType(id_type)), StructField("sizes", ArrayType(LongType())),
        StructField("payload", BinaryType())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        part, seg, first = 0, 0, 0
        ids, sizes, keys = [], [], []

        def flush():
            nonlocal seg, first, ids, sizes, keys
            all_ids, all_sizes = np.concatenate(ids), np.concatenate(sizes)
            key = pa.concat_arrays(keys)
            out = pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([seg], pa.int32()), pa.array([first], pa.int64()),
                pa.array([len(all_ids)], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(key)], pa.int32()), key),
                pa.array([all_sizes], pa.list_(pa.int64())), pa.array([pack(all_ids)], pa.binary())],
                names=[f.name for f in schema])
            seg, first, ids, sizes, keys = seg + 1, first + len(all_ids), [], [], []
            return out

        for batch in batches:
            for piece in pieces(batch, "text"):
                part = column(piece, "part")[0].as_py()
                got, size = _with_end(*encode(column(piece, "text")), end_id)
                ids.append(got)
                sizes.append(size)
                keys.append(column(piece, "id"))
                if sum(map(len, ids)) >= segment_ids:
                    yield flush()
        if ids:
            yield flush()

    rows.mapInArrow(write, schema).write.parquet(f"{path}/segments")
    segments = spark.read.schema(schema).parquet(f"{path}/segments")
    counts = sorted(tuple(r) for r in segments.groupBy("part").agg(F.sum("n_ids")).collect())
    before = [0, *accumulate(n for _, n in counts)]
    literal_frame(spark, [(p, b) for (p, _), b in zip(counts, before)], "part INT, before LONG") \
        .write.parquet(f"{path}/parts")


def _segments(spark: SparkSession, path: str) -> DataFrame:
    segments = spark.read.parquet(f"{path}/segments")
    parts = spark.read.schema("part INT, before LONG").parquet(f"{path}/parts")
    # one row per written partition: bounded by the partition count, not by the data
    return segments.join(F.broadcast(parts), "part").select(
        (F.col("before") + F.col("first")).alias("start"), "doc_ids", "sizes", "payload")


def read_token_files(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """Documents of a token folder: ``(doc_id, start, n_tokens, ids)``.

    ``start`` counts the ids of all documents before.  With ``digest`` the ids are
    replaced by ``ids_crc32``, the crc32 of the ids as little-endian u32.
    """
    segments = _segments(spark, path)
    id_type = segments.schema["doc_ids"].dataType.elementType
    last = StructField("ids_crc32", LongType()) if digest else StructField("ids", ArrayType(LongType()))
    schema = StructType([StructField("doc_id", id_type), StructField("start", LongType()),
                         StructField("n_tokens", LongType()), last])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                sizes = column(row, "sizes").flatten().to_numpy(zero_copy_only=False)
                ids = unpack(column(row, "payload")[0].as_buffer().to_pybytes())
                ends = np.cumsum(sizes)
                begin = ends - sizes
                if digest:
                    raw = memoryview(ids.astype("<u4").tobytes())
                    value = pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(begin, ends)], pa.int64())
                else:
                    value = pa.ListArray.from_arrays(
                        pa.array(np.concatenate([begin[:1], ends]), pa.int32()), pa.array(ids, pa.int64()))
                yield pa.RecordBatch.from_arrays([
                    column(row, "doc_ids").flatten(), pa.array(begin + column(row, "start")[0].as_py(), pa.int64()),
                    pa.array(sizes, pa.int64()), value], names=schema.names)

    return segments.mapInArrow(read, schema)
