import math
from collections import Counter

import pyarrow as pa
import pytest

from tagweave.llm import quality_rules as Q
from tests_llm_rows import doc_rows, docs, no_docs, words  # noqa: F401


def counts(text):
    w, text = words(text), text or ""
    grams = Counter(zip(w, w[1:], w[2:]))
    hit = {k + j for k in range(len(w) - 2) if grams[tuple(w[k:k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit)}


TEXTS = ["", None, " \n ", "a a a a a", "x\nx\n x\n\n\nx", "a b c d a b c", "ß% 東京 <b>\n東京", "\n\na b\na b\na b\n", "x\r\nx\r\n",
         "a b c a b c a", "end\n", "a|b # $ & *"]


def test_base_counts():
    got = Q.base_counts(w := Q.Words(pa.array(TEXTS)), w.hashes())
    for k, text in enumerate(TEXTS):
        assert {c: int(got[c][k]) for c in Q.COUNTS} == counts(text), text


def histogram(text):
    kind = lambda c: (0 if "a" <= c <= "z" else 1 if "A" <= c <= "Z" else 2 if "0" <= c <= "9" else
                      3 if c in " \t\n\v\f\r" else 4 if c in ".,;:!?'\"()-" else 5 if c < "\x80" else 6)
    return [Counter(map(kind, text or ""))[k] for k in range(7)]


def distance(p, q):
    p, q = [[x / (sum(v) or 1) for x in v] for v in (p, q)]
    if not sum(p):
        return 0.0
    kl = lambda a, b: sum(x * math.log2(x / ((x + y) / 2)) for x, y in zip(a, b) if x)
    return math.sqrt(max((kl(p, q) + kl(q, p)) / 2, 0))


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(Q, "MIN_REFERENCE", 100)
    monkeypatch.setattr(Q, "COMMON", 10)


def test_verdicts(docs, small):
    rows = doc_rows()
    passed = [r for r in rows if counts(r[1])["n_words"] >= 50 and
              100 * counts(r[1])["n_repeat_words"] <= 50 * counts(r[1])["n_words"]]
    refs = Q.references(docs)
    for lang in ("de", "en"):
        mine = [r[1] for r in passed if r[2] == lang]
        tally = Counter(w for t in mine for w in words(t))
        assert refs[lang]["words"] == sorted(tally.items(), key=lambda x: (-x[1], x[0].encode()))[:10]
        assert refs[lang]["total"] == sum(tally.values())
        assert refs[lang]["classes"].tolist() == [sum(x) for x in zip(*map(histogram, mine))]
    got = Q.judge(docs, refs).collect()
    assert len(got) == len(rows)
    by = {(r["doc_id"], r["n_words"]): r for r in got}
    for r in rows:
        g, want = by[r[0], counts(r[1])["n_words"]], counts(r[1])
        assert {c: g[c] for c in Q.COUNTS} == want
        failed = want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"]
        assert g["base_failed"] == failed
        pairs = []
        for lang in [r[2]] if r[2] else ["de", "en"]:
            ref = refs[lang]
            tally = Counter(words(r[1]))
            own = [tally[w] for w, _ in ref["words"]]
            own.append(sum(tally.values()) - sum(own))
            held = [n for _, n in ref["words"]]
            held.append(ref["total"] - sum(held))
            pairs.append((distance(histogram(r[1]), ref["classes"].tolist()), distance(own, held)))
        a, b = min(pairs, key=sum)
        assert abs(g["class_distance"] - a) < 1e-9 and abs(g["word_distance"] - b) < 1e-9
        odd = sum(histogram(r[1])) >= Q.MIN_CHARS and a > Q.MAX_CLASS_DISTANCE or \
            want["n_words"] >= Q.MIN_WORDS and b > Q.MAX_WORD_DISTANCE
        assert g["kept"] == (not failed and not odd)
    kept = Q.keep(docs, refs)
    assert kept.columns == docs.columns and kept.count() == sum(g["kept"] for g in got)


def test_junk_is_rejected_and_clean_kept(spark, small):
    from tests_llm_rows import prose
    import random
    rng = random.Random(9)
    rows = [(i, prose(rng, 120), "en", "s", 0) for i in range(40)]
    rows.append((100, " ".join(w + "%%%$$$&&&***" for w in rows[0][1].split()), "en", "s", 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, size long")
    kept = {r["doc_id"] for r in Q.keep(docs, Q.references(docs)).collect()}
    assert kept == set(range(40))


def test_no_reference_keeps(spark, docs, no_docs):
    got = Q.judge(docs, {}).collect()
    assert all(r["kept"] == (not r["base_failed"]) for r in got)
    assert Q.references(no_docs) == {} and Q.judge(no_docs, {}).collect() == []


def test_language_without_reference_is_kept(spark):
    import random
    from tests_llm_rows import prose
    rng = random.Random(11)
    rare = " ".join(f"{rng.choice('kaj la de en estas por kun tio sed ili'.split())} vorto{rng.randrange(200)}" for _ in range(150))
    rows = [(i, prose(rng, 120), "en") for i in range(40)] + [(100, rare, "eo"), (101, rare, None), (102, rare, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    refs = Q.references(docs)
    assert set(refs) == {"en"}
    got = {r["doc_id"]: r for r in Q.judge(docs, refs).collect()}
    # too few words for a reference: nothing to hold the text against, but a null language takes the nearest
    assert got[100]["kept"] and got[100]["word_distance"] == got[100]["class_distance"] == 0
    assert not got[101]["kept"] and not got[102]["kept"] and got[101]["word_distance"] > Q.MAX_WORD_DISTANCE
    assert {r["doc_id"] for r in Q.keep(docs, refs).collect()} == {*range(40), 100}
