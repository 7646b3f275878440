"""Model schedules packed as ``frequency,start,end`` strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats of the packed schedule and of the scheduler's time parameter.
SCHEDULE_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
SCHEDULER_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm'+0800'"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def encode_schedule(frequency: Column | str, start: Column | str, end: Column | str) -> Column:
    """``f,yyyy-MM-dd HH:mm:ss,yyyy-MM-dd HH:mm:ss``; null when any part is null."""
    return F.concat(
        _col(frequency).cast("string"), F.lit(","),
        F.date_format(_col(start), SCHEDULE_TIME_FORMAT), F.lit(","),
        F.date_format(_col(end), SCHEDULE_TIME_FORMAT),
    )


def decode_schedule(packed: Column | str) -> Column:
    """Struct ``(frequency INT, start TIMESTAMP_NTZ, end TIMESTAMP_NTZ)``.

    A part that does not parse is left null, and the end time is only read when the
    start time parsed (a failed start stops the decode there).  Times are wall-clock.
    """
    parts = F.split(_col(packed), ",")
    start = F.try_to_timestamp(F.get(parts, 1), F.lit(SCHEDULE_TIME_FORMAT)).cast("timestamp_ntz")
    end = F.try_to_timestamp(F.get(parts, 2), F.lit(SCHEDULE_TIME_FORMAT)).cast("timestamp_ntz")
    return F.struct(
        F.get(parts, 0).try_cast("int").alias("frequency"),
        start.alias("start"),
        F.when(start.isNotNull(), end).alias("end"),
    )


def scheduler_time(ts: Column | str) -> Column:
    """``yyyy-MM-dd'T'HH:mm+0800``: the offset is literal text, no zone conversion."""
    return F.date_format(_col(ts), SCHEDULER_TIME_FORMAT)
