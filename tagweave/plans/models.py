"""Tag models: which tag a job computes, how, and how it is merged into the store.

A :class:`TagModel` is the template every job follows: load the catalog, read the
level-4 rule (where the data is) and the level-5 rules (which value earns which tag),
load the source, ``compute`` the new tags, merge them with the stored ones, save.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tagweave.operators.match import date_digits, match_ranges, match_rules, match_values

Compute = Callable[[DataFrame, DataFrame], DataFrame]
MERGES = ("inner", "left", "replace")


@dataclass(frozen=True)
class TagModel:
    """``compute(rules, source) -> (userId, tagIds)``; ``merge`` says how to store it.

    * ``merge="inner"``: only users already in the store are updated;
    * ``merge="left"``: every computed user is written, merged with history;
    * ``merge="replace"``: the new tag overwrites the stored one (no merge).

    ``order`` (``old_first``/``new_first``) and ``blank`` (``empty``/``blank``) select
    the merge variant; ``spec_default`` fills keys missing from the level-4 rule; ``key`` is
    the source column that ``compute`` hands on as the user id, row by row.
    """

    name: str
    tag_id: int
    compute: Compute
    merge: str = "left"
    order: str = "old_first"
    blank: str = "blank"
    spec_default: str | None = None
    key: str = "id"

    def __post_init__(self):
        if self.merge not in MERGES:
            raise ValueError(f"merge must be one of {MERGES}")


def rule_match(column: str, default: int | None = 0, key: str = "id") -> Compute:
    """Exact match of ``column`` against the level-5 rules; no match -> ``default``."""
    return lambda rules, source: match_rules(source, rules, column, key_col=key, default=default)


def value_case(column: str, mapping: Mapping[str, int], key: str = "id") -> Compute:
    """A fixed ``{value: tag}`` map on ``column`` (level-5 rows are not used)."""
    return lambda rules, source: match_values(source, column, mapping, key_col=key)


def date_ranges(column: str, ranges: Sequence[tuple[int, int, int]], key: str = "id") -> Compute:
    """``yyyy-MM-dd`` dates in ``column`` against ``(lo, hi, tag)`` ranges of yyyyMMdd."""
    return lambda rules, source: match_ranges(source, date_digits(column), ranges, key_col=key)


# Fixed values of the reference's models (tag ids, value maps, date bounds).
JOB_TAG_ID = 64
BLACKLIST_TAG_ID = 71
NATIONALITY_TAG_ID = 61
GENDER_TAG_ID = 256
GENDER_VALUES = {"1": 257, "2": 258}
JOB_MODEL_TAG_ID = 259
JOB_VALUES = {"1": 260, "2": 261, "3": 262, "4": 263, "5": 264, "6": 265, "7": 267}
AGE_TAG_ID = 274
AGE_RANGES = [
    (19600101, 19691231, 301),
    (19700101, 19791231, 302),
    (19800101, 19891231, 303),
    (19900101, 19901231, 304),
    (20000101, 20101231, 305),
]


def job_tag(column: str = "job") -> TagModel:
    return TagModel("job", JOB_TAG_ID, rule_match(column), merge="inner", order="old_first",
                    blank="empty", spec_default="")


def blacklist_tag(column: str = "is_blackList") -> TagModel:
    return TagModel("blacklist", BLACKLIST_TAG_ID, rule_match(column), merge="inner",
                    order="old_first", blank="empty", spec_default="")


def nationality_tag(column: str = "nationality") -> TagModel:
    return TagModel("nationality", NATIONALITY_TAG_ID, rule_match(column), merge="inner",
                    order="old_first", blank="empty", spec_default="")


def gender_model(column: str = "gender") -> TagModel:
    return TagModel("gender", GENDER_TAG_ID, value_case(column, GENDER_VALUES), merge="replace")


def job_model(column: str = "job") -> TagModel:
    return TagModel("job_model", JOB_MODEL_TAG_ID, value_case(column, JOB_VALUES), merge="left",
                    order="new_first", blank="blank")


def age_model(column: str = "birthday") -> TagModel:
    return TagModel("age", AGE_TAG_ID, date_ranges(column, AGE_RANGES), merge="left",
                    order="old_first", blank="blank")
