"""Shared helpers: words of Arrow text columns as numpy arrays, hashes, scratch tables.

Words are the maximal runs ``[^\\x20\\x09-\\x0D]+`` of the UTF-8 bytes, so a null text has
none.  A word is identified by a 64-bit hash of its bytes (two different words share one
with a chance of 2^-64 per pair).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.operators.joins import bounded_broadcast
from tagweave.session import ensure_checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"
PIECEBYTE_VALUES = 4 << 20  # texts handled at once inside a task (one longer text stands alone)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PLAIN = _LOWER.copy()  # ASCII other than letters and digits becomes a space
_PLAIN[[b for b in range(128) if not chr(b).isalnum()]] = 0x20


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (the splitmix64 constants)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = np.uint64(0xD6E8FEB86659FD93)


def powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class Words:
    """The words of a slice of texts: spans in ``buf`` and ``offsets`` (words before text i)."""

    def __init__(self, texts: pa.Array, lower: bool = False, plain: bool = False):
        arr = texts.cast(pa.large_string()).fill_null("")
        off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
        data = arr.buffers()[2]
        buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.buf = buf[off[0]:off[-1]] if len(arr) else buf[:0]
        self.bounds = off - off[0]
        if lower or plain:  # A-Z lower-cased; plain: words are runs of letters, digits and non-ASCII
            self.buf = (_PLAIN if plain else _LOWER)[self.buf]
        n = len(self.buf)
        word = ~_SPACE[self.buf]
        edge = np.zeros(n + 1, bool)
        edge[self.bounds] = True
        edge[0] = edge[n] = True
        before = np.empty(n, bool)
        after = np.empty(n, bool)
        if n:
            before[0], before[1:] = False, word[:-1]
            after[-1], after[:-1] = False, word[1:]
        self.starts = np.flatnonzero(word & (edge[:-1] | ~before))
        self.ends = np.flatnonzero(word & (edge[1:] | ~after)) + 1
        self.word_bytes = word
        self.offsets = np.searchsorted(self.starts, self.bounds)

    def hashes(self) -> np.ndarray:
        """uint64 per word."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        size = self.ends - self.starts
        # position of each byte in its word
        kind = np.int32 if len(self.buf) < 1 << 31 else np.int64
        owner = np.zeros(len(self.buf), kind)
        owner[self.starts] = self.starts
        pos = np.arange(len(self.buf), dtype=kind) - np.maximum.accumulate(owner)
        pos[~self.word_bytes] = 0
        value = BYTE_VALUE[self.buf] * powers(int(size.max()))[pos]
        value[~self.word_bytes] = 0
        return mix64(np.add.reduceat(value, self.starts) ^ (size.astype(np.uint64) << np.uint64(40)))

    def word(self, i: int) -> bytes:
        return self.buf[self.starts[i]:self.ends[i]].tobytes()


def pieces(batch: pa.RecordBatch, text_col: str, limit: int = PIECEBYTE_VALUES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` whose texts hold about ``limit`` bytes (or one longer text)."""
    if not batch.num_rows:
        return
    arr = batch.column(batch.schema.get_field_index(text_col)).cast(pa.large_string()).fill_null("")
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
    at = 0
    while at < len(arr):
        end = int(np.searchsorted(off, off[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), len(arr))
        yield batch.slice(at, end - at)
        at = end


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def shingles(hashes: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes, owning text) of every ``n``-word window; a text of 1..n-1 words has one."""
    count = np.diff(offsets)
    m = len(hashes)
    padded = np.concatenate([hashes, np.zeros(n, np.uint64)])
    text = np.repeat(np.arange(len(count)), count)
    left = np.repeat(offsets[1:], count) - np.arange(m)  # words from here to the text's end
    value = np.zeros(m, np.uint64)
    for k in range(n):
        step = np.uint64(0x9E3779B97F4A7C15 * (2 * k + 1) % (1 << 64))
        part = mix64(padded[k:k + m] + step)
        value += np.where(left > k, part * np.uint64(2 * k + 3), np.uint64(0))
    first = np.arange(m) == np.repeat(offsets[:-1], count)
    keep = (left >= n) | (first & (np.repeat(count, count) < n))
    return mix64(value[keep]), text[keep]


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back (cuts lineage; survives lost executors)."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def set_aside(df: DataFrame, helpers: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """``df`` without columns named like ``helpers`` (they get free names), and the renames that undo it."""
    taken, back = {c.lower() for c in [*df.columns, *helpers]}, {}
    for c in df.columns:
        if c.lower() in {h.lower() for h in helpers}:
            free = next(f"{c}_{k}" for k in range(len(taken) + 1) if f"{c}_{k}".lower() not in taken)
            taken.add(free.lower())
            back[free] = c
    return df.withColumnsRenamed({c: free for free, c in back.items()}), back


def lookup(big: DataFrame, small: DataFrame, keys: list[str], spread: list[str], salts: int = 64) -> DataFrame:
    """``big`` joined with ``small`` (one row per ``keys``) however hot a key is.

    ``small`` is broadcast behind a proven bound; beyond it, it is repeated per salt and the
    rows of a key are dealt over the salts by the columns ``spread``.
    """
    marked = bounded_broadcast(small)
    if marked is not small:
        return big.join(marked, keys)
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return big.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")) \
        .join(copies, [*keys, "_salt"]).drop("_salt")
