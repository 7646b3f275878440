"""Tag lists (comma-joined tag ids) and their merge, as column expressions.

The merges replace row-at-a-time UDFs: they stay in the JVM, inside whole-stage
codegen, and Catalyst can reason about them.  Order is first occurrence, with the
``first`` argument's items ahead of the ``second``'s.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


BLANK = r"^\p{javaWhitespace}*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_empty(c: Column | str) -> Column:
    """Null or the empty string."""
    c = _col(c)
    return c.isNull() | (c == F.lit(""))


def is_blank(c: Column | str) -> Column:
    """Null, empty, or white space only (Unicode blanks such as U+3000 included)."""
    c = _col(c)
    return c.isNull() | c.rlike(BLANK)


def tag_list(c: Column | str) -> Column:
    """``ARRAY<STRING>`` of the non-empty items of a comma-joined list."""
    return F.filter(F.split(_col(c).cast("string"), ","), lambda x: x != F.lit(""))


def merge_tags(first: Column | str, second: Column | str, blank: str = "blank") -> Column:
    """Merge two comma-joined tag lists.

    If ``first`` is empty (``blank="empty"``: null or ``''``; ``blank="blank"``: also
    whitespace) the result is ``second``; else if ``second`` is empty it is ``first``;
    else the distinct items of both, ``first``'s first.
    """
    empty = {"empty": is_empty, "blank": is_blank}[blank]
    a = _col(first).cast("string")
    b = _col(second).cast("string")
    both = F.array_join(F.array_distinct(F.concat(tag_list(a), tag_list(b))), ",")
    return F.when(empty(a), b).when(empty(b), a).otherwise(both)


_BLANK_SQL = BLANK.replace("\\", "\\\\")
MERGE_SQL_BODY = (
    f"CASE WHEN old IS NULL OR old RLIKE '{_BLANK_SQL}' THEN new "
    f"WHEN new IS NULL OR new RLIKE '{_BLANK_SQL}' THEN old "
    "ELSE array_join(array_distinct(concat(filter(split(old, ','), x -> x <> ''), "
    "filter(split(new, ','), x -> x <> ''))), ',') END"
)


def register_sql_functions(spark: SparkSession, name: str = "merge_tags") -> None:
    """Register ``merge_tags(old, new)`` (blank-aware, old first) for SQL users.

    It is a SQL-bodied temporary function, so it is inlined as an expression; no
    Python runs per row.
    """
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(old STRING, new STRING) "
        f"RETURNS STRING RETURN {MERGE_SQL_BODY}"
    )
