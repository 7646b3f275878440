"""Rows and fixtures of the tests in this folder (imported by name: a second conftest would hide the first).

Small frames with every awkward case: nulls, empty and long texts, ties, repeated rows, clashing names."""

import random
import re

import pytest

WORDS = "the of and to in that is for with was stone river lamp paper green cloud north window table seven".split()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + (rng.choice(["", "", ".", ","])) + str(rng.randrange(40)) for _ in range(n))


def doc_rows(seed=1, n=60):
    """(doc_id, text, lang, source, size): copies, near copies, empty, null, repeated and long rows."""
    rng = random.Random(seed)
    rows = [[i, prose(rng, rng.randrange(60, 140)), rng.choice(["en", "de"]), f"s{i % 4}", i] for i in range(n)]
    rows[5][1] = rows[4][1]  # exact copy
    rows[7][1] = rows[6][1] + " and"  # near copy
    near = rows[8][1].split()
    near[30] = "changed"
    rows[9][1] = " ".join(near)
    rows[10][1] = ""
    rows[11][1] = None
    rows[12][1] = " \t\n"
    rows[13][1] = "one two"
    rows[14][1] = "one two"
    rows[15][1] = prose(rng, 30_000)
    rows[16][2] = rows[16][3] = None
    rows[17][0] = None
    rows[18] = list(rows[19])  # the whole row twice
    rows[20][1] = "échelle ß 東京 " + prose(rng, 70)
    return [tuple(r) for r in rows]


SCHEMA = "doc_id long, text string, lang string, source string, size long"  # ``size`` clashes with an added name


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(doc_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
