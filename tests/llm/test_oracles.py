"""The SQL of the queries over awkward rows, among them a language too rare for a reference."""

import random

import duckdb

from tagweave.llm import oracles
from tagweave.llm import quality_rules as Q
from tests_llm_rows import doc_rows, prose


def table(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    return con


def test_quality_rules_with_a_rare_language(spark):
    rng = random.Random(21)
    rare = " ".join(f"{rng.choice('kaj la de en estas por kun tio sed ili'.split())} vorto{rng.randrange(200)}" for _ in range(150))
    # one language with a reference: the rare text is far from it, so the nearest would reject it
    rows = [(*r[:2], r[2] and "en", *r[3:]) for r in doc_rows() if len(r[1] or "") < 10_000] + [(300 + k, prose(rng, 120), "en", "s", 0) for k in range(40)]
    rows += [(400, rare, "eo", "s", 0), (401, rare, None, "s", 0), (402, rare, "en", "s", 0), (403, "§§§ " * 200, "eo", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    refs = Q.references(docs)
    assert set(refs) == {"en"}
    names = ["doc_id", *Q.COUNTS, "base_failed", "kept"]
    got = sorted((tuple(r[c] for c in names) for r in Q.judge(docs, refs).collect()), key=str)
    con = table(rows)
    want = con.execute(f"SELECT {', '.join(names)} FROM ({oracles.QUALITY})").fetchall()
    assert got == sorted(want, key=str)
    kept = {r[0]: r[-1] for r in got}
    assert kept[400] and not kept[401] and not kept[402]
