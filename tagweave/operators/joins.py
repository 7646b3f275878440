"""Join helpers: broadcast only behind a proven size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Rules, lookup rows and similar catalog slices are broadcast only below these bounds.
DEFAULT_BROADCAST_ROWS = 200_000
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def _probe(df: DataFrame, max_rows: int) -> tuple[int, int]:
    """(rows, payload bytes) of at most ``max_rows + 1`` rows, in one small job.

    Bytes count the UTF-8 length of string columns and 8 per other value.
    """
    sizes = [F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) if isinstance(f.dataType, StringType)
             else F.lit(8) for f in df.schema.fields]
    width = sum(sizes[1:], sizes[0]) if sizes else F.lit(0)
    row = (df.limit(max_rows + 1)
           .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")).first())
    return int(row["n"]), int(row["b"])


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                      bound_by: DataFrame | None = None,
                      max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast when it has at most ``max_rows`` rows and ``max_bytes``.

    The bound is proven by counting (``limit(max_rows + 1)``, a small job that stops
    early), not guessed from file statistics.  ``bound_by`` may name a cheaper frame
    with at least as many rows and bytes (e.g. the input of a deduplication), so the
    check needs no shuffle.  Above a bound the side is returned unmarked and the join
    shuffles (AQE can still switch to a broadcast from the actual shuffle sizes).
    """
    n, size = _probe(bound_by if bound_by is not None else df, max_rows)
    return F.broadcast(df) if n <= max_rows and size <= max_bytes else df
