"""Rule strings of the tag catalog as column expressions.

A level-4 rule names where the source data is, as ``k=v##k=v``.  Parsing is a column
expression over the whole catalog, so it runs inside whole-stage codegen and never
needs the rows on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagweave.schemas import SOURCE_KEYS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rule_entries(rule: Column | str) -> Column:
    """``ARRAY<STRUCT<key, value>>`` of a ``k=v##k=v`` rule, in text order.

    Empty items (``a=1####b=2``, a trailing ``##``) are skipped.  The value is the text
    between the first and the second ``=``; an item without ``=`` gets a null value.
    """
    items = F.filter(F.split(_col(rule), "##"), lambda item: item != F.lit(""))
    return F.transform(
        items,
        lambda item: F.struct(
            F.split(item, "=").getItem(0).alias("key"),
            F.get(F.split(item, "="), 1).alias("value"),
        ),
    )


def parse_rule(rule: Column | str) -> Column:
    """``MAP<STRING,STRING>`` of a ``k=v##k=v`` rule; a repeated key keeps its last value.

    The last-wins rule is written into the expression (an entry is dropped when its key
    appears again later), so it does not depend on ``spark.sql.mapKeyDedupPolicy``.
    """
    entries = rule_entries(rule)
    keys = F.transform(entries, lambda e: e["key"])
    kept = F.filter(
        entries,
        lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys) + 1), e["key"]),
    )
    return F.map_from_entries(kept)


def source_spec(rule_map: Column | str, default: str | None = "") -> Column:
    """Struct of the seven source keys; a missing key becomes ``default``.

    ``default=""`` follows the legacy jobs, ``default=None`` the template models.
    """
    m = _col(rule_map)
    fill = F.lit(default).cast("string")
    return F.struct(*[F.coalesce(F.try_element_at(m, F.lit(k)), fill).alias(k)
                      for k in SOURCE_KEYS])


def format_rule(pairs: list[tuple[str, str]]) -> str:
    """Inverse of :func:`parse_rule` for building catalog rows in Python."""
    return "##".join(f"{k}={v}" for k, v in pairs)
