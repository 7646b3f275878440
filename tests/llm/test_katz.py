import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagweave.llm import katz as Z
from tests_llm_rows import SCHEMA, doc_rows, docs, no_docs, prose  # noqa: F401


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + ["</s>"]


class Brute:
    """The model by its definition, over Python dictionaries."""

    def __init__(self, texts):
        self.c, self.pairs, self.h = Counter(), Counter(), Counter()
        for t in texts:
            before = "<s>"
            for w in tokens(t):
                self.c[w] += 1
                self.pairs[before, w] += 1
                self.h[before] += 1
                before = w
        self.n, self.v = sum(self.c.values()), len(self.c)
        of = lambda table: [0] + [Counter(table.values())[r] for r in range(1, Z.K + 2)]
        self.du, self.db = Z.discounts(of(self.c)), Z.discounts(of(self.pairs))
        kept = sum(self.cut(self.du, x) for x in self.c.values())
        self.denominator = self.n if kept < self.n - 1e-9 else self.n + 1
        self.unknown = (self.denominator - kept) / self.denominator
        followers = defaultdict(list)
        for (a, b), k in self.pairs.items():
            followers[a].append((b, k))
        self.back = {}
        for a, found in followers.items():
            some = any(k <= Z.K and self.db[k] < 1 for _, k in found)
            d = self.h[a] + (not some)
            left = 1 - sum(self.cut(self.db, k) for _, k in found) / d
            self.back[a] = left / (1 - sum(self.uni(b) for b, _ in found)), d

    @staticmethod
    def cut(d, k):
        return (d[k] if k <= Z.K else 1.0) * k

    def uni(self, w):
        return self.cut(self.du, self.c[w]) / self.denominator if self.c[w] else self.unknown

    def p(self, a, b):
        alpha, d = self.back.get(a, (1.0, 1))
        return self.cut(self.db, self.pairs[a, b]) / d if self.pairs[a, b] else alpha * self.uni(b)

    def score(self, text):
        t = tokens(text)
        return sum(math.log10(self.p(a, b)) for a, b in zip(["<s>", *t], t))

    def base(self, text):
        return sum(math.log10((self.c[w] + 0.1) / (self.n + 0.1 * (self.v + 1))) for w in tokens(text))


def fold(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def check(rows, got):
    model = Brute([r[1] for r in rows if not fold(r[0])])
    left = defaultdict(list)
    for g in got:
        left[g["doc_id"]].append(g)
    for r in rows:
        t = tokens(r[1])
        hit = [g for g in left[r[0]] if g["n_tokens"] == len(t) and abs(g["score"] - model.score(r[1])) < 1e-6 * (1 + abs(g["score"]))]
        assert hit, r[0]
        g = hit[0]
        left[r[0]].remove(g)
        assert abs(g["base_score"] - model.base(r[1])) < 1e-6 * (1 + abs(g["base_score"]))
        assert g["n_known"] == sum(model.c[w] > 0 for w in t)
        assert (g["held_out"], g["train_tokens"]) == (fold(r[0]), model.n)
    assert not any(left.values())
    return model


@pytest.mark.parametrize("chunk", [Z.CHUNK_BYTES, 4000])
def test_scores_match_the_definition(docs, chunk, monkeypatch):
    monkeypatch.setattr(Z, "CHUNK_BYTES", chunk)
    rows = doc_rows()
    model = check(rows, Z.score(docs).collect())
    for a in ["<s>", "one", *list(model.c)[:20]]:
        assert abs(sum(model.p(a, b) for b in [*model.c, "never seen"]) - 1) < 1e-9


def test_tables_are_stored_and_sum_up(spark, docs, tmp_path):
    Z.score(docs, path=str(tmp_path / "m")).count()
    table = spark.read.parquet(str(tmp_path / "m" / "bigrams")).where("kind = 3").collect()
    pairs = sum(int(Z.take(r["c"]).sum()) for r in table)
    assert pairs == sum(len(tokens(r[1])) for r in doc_rows() if not fold(r[0]))


def test_all_held_out_and_empty(docs, no_docs):
    got = Z.score(docs, held_out=F.lit(True)).collect()
    assert all(g["train_tokens"] == 0 and g["n_known"] == 0 and g["score"] == 0 for g in got)
    assert Z.score(no_docs).collect() == []


def test_tiny_corpora(spark):
    rows = [(1, "a", None, None, 0), (2, "a", None, None, 0), (3, "a b", None, None, 0), (5, None, None, None, 0), (35, "q a", None, None, 0)]
    check(rows, Z.score(spark.createDataFrame(rows, SCHEMA)).collect())


def test_held_out_texts_score_better_than_the_base(spark):
    import random
    rng = random.Random(5)
    lines = [prose(rng, 6) for _ in range(50)]
    rows = [(i, " ".join(rng.choice(lines) for _ in range(8)), "en", "s", 0) for i in range(200)]
    got = [g for g in Z.score(spark.createDataFrame(rows, SCHEMA)).collect() if g["held_out"]]
    assert got and sum(g["score"] for g in got) > sum(g["base_score"] for g in got)


def test_counts_above_32_bits():
    for values in ([0, 5_000_000_000, 1], [2 ** 32], [2 ** 40 + 3, 7], [2 ** 32 - 1, 0], []):
        assert Z.take(Z.put(np.array(values, np.int64))).tolist() == values


def test_ids_above_32_bits(docs, monkeypatch):
    monkeypatch.setattr(Z, "FIRST_ID", (1 << 32) - 20)  # ids on both sides of the border
    check(doc_rows(), Z.score(docs).collect())
