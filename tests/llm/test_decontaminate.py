import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from tagweave.llm import decontaminate as D
from tests_llm_rows import SCHEMA, doc_rows, docs, no_docs, prose  # noqa: F401

ITEMS = "item_id long, text string, doc_id long"


def plain(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return "".join(c if c.isalnum() or c >= "\x80" else " " for c in text).split()


def item_rows(seed=3, n=40):
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.randrange(12, 60)) + ("\n" + prose(rng, rng.randrange(1, 8)) if i % 2 else ""), i) for i in range(n)]
    return rows + [(100, None, 0), (101, "", 0), (102, "one", 0), (103, rows[3][1], 0), (None, prose(rng, 30), 0)]


def test_all_items_above_the_threshold_are_retrieved():
    """Block-max bounds lose nothing: the same pairs and scores as scoring everything."""
    items = [(i, t or "") for i, t, _ in item_rows(5, 120)]
    index = D.Index([i for i, _ in items], [t for _, t in items])
    own = [Counter(plain(t)) for _, t in items]
    n, mean = len(items), sum(sum(c.values()) for c in own) / len(items)
    df = Counter(w for c in own for w in c)

    def weight(w, k):
        idf = math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5))
        tf, size = own[k][w], sum(own[k].values())
        return idf * tf * (D.K1 + 1) / (tf + D.K1 * (1 - D.B + D.B * size / mean))

    total = [sum(weight(w, k) for w in own[k]) for k in range(n)]
    rng = random.Random(6)
    passages = [plain(items[rng.randrange(n)][1])[:rng.randrange(1, 40)] + plain(prose(rng, 30)) for _ in range(60)]
    rows = []
    for p, found in enumerate(passages):
        hashes = D.Words(pa.array([" ".join(found)])).hashes()
        rows += [(p, t) for t in {int(x) for x in D.np.searchsorted(index.terms, hashes)}
                 if t < len(index.terms) and index.terms[t] in hashes]
    rows.sort()
    for least in (0.1, 0.3, 0.5, 0.9):
        got = {(p, i): s for p, i, s in zip(*(x.tolist() for x in index.retrieve(
            D.np.array([r[0] for r in rows]), D.np.array([r[1] for r in rows]), least)))}
        want = {}
        for p, found in enumerate(passages):
            for k in range(n):
                s = sum(weight(w, k) for w in set(found) if w in own[k]) / total[k] if total[k] else 0
                if s >= least:
                    want[p, k] = s
        assert got.keys() == want.keys() and all(abs(got[x] - want[x]) < 1e-9 for x in got)


def planted(seed=8):
    rng = random.Random(seed)
    items, rows = item_rows(), doc_rows(seed)
    held = {}
    for k in (0, 1, 2, 21, 33):
        before, after = prose(rng, rng.randrange(300)), prose(rng, rng.randrange(300))
        rows.append((200 + k, f"{before} {items[k][1]} {after}", "en", "s", 0))
        held[200 + k] = items[k][0]
    w = items[5][1].split(" ")
    w[4] = "changed"
    rows.append((300, prose(rng, 90) + " " + " ".join(w), "en", "s", 0))
    held[300] = 5
    rows.append((301, items[1][1].rpartition("\n")[0][:60] + " " + prose(rng, 50), "en", "s", 0))  # half a question
    return items, rows, held


def brute(items, rows):
    grams = lambda w, n: {tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()
    out = set()
    for doc_id, text, *_ in rows:
        for item_id, item, _ in items:
            parts = [plain(x) for x in D.question_answer(item)]
            if not parts[0]:
                continue
            share = []
            for part in parts:
                n = min(D.shingle_words(len(part)), max(len(part), 1))
                have = grams(plain(text), n)
                share.append(len(grams(part, n) & have) / len(grams(part, n)) if part else 1)
            if share[0] >= D.MIN_QUESTION and share[1] >= D.MIN_ANSWER:
                out.add((doc_id, item_id))
    return out


def test_leaks_are_found_and_clean_rows_kept(spark):
    items, rows, held = planted()
    docs, bench = spark.createDataFrame(rows, SCHEMA).repartition(3), spark.createDataFrame(items, ITEMS)
    got = {(r["doc_id"], r["item_id"]) for r in D.leaks(docs, bench).collect()}
    assert got == brute(items, rows) and {(d, i) for d, i in held.items()} <= got
    bad = {d for d, _ in got}
    kept = D.clean(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == sorted(r[0] or -1 for r in rows if r[0] not in bad)


def test_shards_find_the_same(spark, monkeypatch):
    items, rows, _ = planted()
    monkeypatch.setattr(D, "SHARD_BYTES", 4000)
    docs, bench = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, ITEMS)
    assert len(D.indexes(bench)) > 1
    assert {(r["doc_id"], r["item_id"]) for r in D.leaks(docs, bench).collect()} == brute(items, rows)


def test_empty_tables(spark, docs, no_docs):
    none = spark.createDataFrame([], ITEMS)
    bench = spark.createDataFrame(item_rows(), ITEMS)
    assert D.leaks(docs, none).collect() == [] and D.leaks(no_docs, bench).collect() == []
    assert D.clean(docs, none).count() == docs.count()


@pytest.mark.parametrize("kind", ["int", "string", "decimal(10,2)", "date"])
def test_item_ids_of_any_type(spark, docs, kind):
    items, rows, held = planted()
    as_id = {"int": "cast(item_id as int)", "string": "concat('i', item_id)", "decimal(10,2)": "cast(item_id as decimal(10,2))",
             "date": "date_add(date'2020-01-01', cast(item_id as int))"}[kind]
    bench = spark.createDataFrame([r for r in items if r[0] is not None], ITEMS).selectExpr(f"{as_id} as item_id", "text")
    found = D.leaks(spark.createDataFrame(rows, SCHEMA), bench)
    assert found.schema["item_id"].dataType.simpleString() == kind
    assert len({(r["doc_id"], r["item_id"]) for r in found.collect()}) == len(brute([r for r in items if r[0] is not None], rows))


def test_scores_do_not_depend_on_the_number_of_shards(spark, monkeypatch):
    """Retrieval alone: the same pairs and scores from one index and from many."""
    items, rows, _ = planted()
    bench = spark.createDataFrame(items, ITEMS)
    for name in ("MIN_QUESTION", "MIN_ANSWER"):
        monkeypatch.setattr(D, name, 0.0)
    monkeypatch.setattr(D, "MIN_SCORE", 0.2)

    texts = pa.array([r[1] for r in rows])

    def scores():  # in this process, where the changed thresholds hold
        found = {(t, str(index.ids[i]), index.parts[i][0][1].tobytes(), round(s, 9))
                 for index in D.indexes(bench) for t, i, s, *_ in D.search(index, texts)}
        assert len(found) > 50
        return found

    whole = scores()
    monkeypatch.setattr(D, "SHARD_BYTES", 3000)
    assert len(D.indexes(bench)) > 3 and scores() == whole


def test_one_changed_word_of_short_parts(spark):
    rng = random.Random(12)
    lone = " ".join(f"w{k}" for k in range(15))  # one line of 15 words
    pair = " ".join(f"q{k}" for k in range(20)) + "\n" + " ".join(f"a{k}" for k in range(6))
    items = [(0, lone, 0), (1, pair, 1)] + [(10 + k, prose(rng, 40), 0) for k in range(20)]
    rows = []
    for k in range(1, 14):
        w = lone.split()
        w[k] = "changed"
        rows.append((k, prose(rng, 80) + " " + " ".join(w) + " " + prose(rng, 80), "en", "s", 0))
    for k in range(1, 5):
        q, a = (x.split() for x in pair.split("\n"))
        q[9], a[k] = "changed", "changed"
        rows.append((100 + k, prose(rng, 80) + " " + " ".join(q + a), "en", "s", 0))
    rows += [(200, " ".join(random.Random(1).sample(lone.split(), 15)), "en", "s", 0), (201, prose(rng, 200), "en", "s", 0)]
    docs, bench = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, ITEMS)
    got = {(r["doc_id"], r["item_id"]) for r in D.leaks(docs, bench).collect()}
    assert got == {(k, 0) for k in range(1, 14)} | {(100 + k, 1) for k in range(1, 5)}


def test_clean_by_shards(spark, monkeypatch):
    items, rows, _ = planted()
    monkeypatch.setattr(D, "SHARD_BYTES", 4000)
    docs, bench = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, ITEMS)
    bad = {d for d, _ in brute(items, rows)}
    assert sorted(r["doc_id"] or -1 for r in D.clean(docs, bench).collect()) == sorted(r[0] or -1 for r in rows if r[0] not in bad)
