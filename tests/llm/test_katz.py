"""Katz scores against a recursion over dictionaries."""

import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from daytally.llm import katz
from daytally.llm.queries import op1_katz

from edge_cases import EDGES, SF

LARGEST, KEEP = katz.LARGEST, katz.KEEP_LARGE
BLANKS = "[\x20\x09-\x0d]+"


def tokens_of(text):
    text = (text or "").translate({i: i + 32 for i in range(65, 91)})
    return [w for w in re.split(BLANKS, text) if w] + ["end\n"]


def factors(numbers):
    n = [0, *numbers]
    out = [0] + [KEEP] * (LARGEST + 1)
    absolute = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    common = (LARGEST + 1) * n[LARGEST + 1] / n[1] if n[1] else 1.0
    for r in range(1, LARGEST + 1):
        d = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) if n[r] and common < 1 else -1
        out[r] = d if 0 < d < 1 else (r - absolute) / r
    return out


class Brute:
    def __init__(self, docs, order):
        self.docs, self.order = docs, order
        self.counts = {k: Counter() for k in range(1, order + 1)}
        for doc_id, text in docs:
            if self.held(doc_id):
                continue
            s = ["begin\n", *tokens_of(text)]
            for k in range(1, order + 1):
                for j in range(max(1, k - 1), len(s)):
                    self.counts[k][tuple(s[j - k + 1 : j + 1])] += 1
        self.n, self.v = sum(self.counts[1].values()), len(self.counts[1])
        self.factors = {
            k: factors([sum(c == r for c in self.counts[k].values()) for r in range(1, LARGEST + 2)]) for k in self.counts
        }
        self.after, self.total = defaultdict(list), Counter()
        for k in range(2, order + 1):
            for g, c in self.counts[k].items():
                self.after[g[:-1]].append((g[-1], c))
                self.total[g[:-1]] += c
        kept = sum(self.kept(1, c) for c in self.counts[1].values())
        self.unknown = max(1 - kept / self.n, 1e-12) if self.n else 1.0
        self.weights = {}

    @staticmethod
    def held(doc_id):
        return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 5 == 1

    def kept(self, k, c):
        return self.factors[k][min(c, LARGEST + 1)] * c

    def p(self, h, w):
        c = self.counts[len(h) + 1][(*h, w)]
        if not h:
            return self.kept(1, c) / self.n if c else self.unknown
        if c:
            return self.kept(len(h) + 1, c) / self.total[h]
        if h not in self.total:
            return self.p(h[1:], w)
        if h not in self.weights:
            left = 1 - sum(self.kept(len(h) + 1, c) for _, c in self.after[h]) / self.total[h]
            rest = 1 - sum(self.p(h[1:], x) for x, _ in self.after[h])
            self.weights[h] = max(left, 1e-15) / max(rest, 1e-15)
        return self.weights[h] * self.p(h[1:], w)

    def rows(self):
        for doc_id, text in self.docs:
            s = ["begin\n", *tokens_of(text)]
            known = [self.counts[1][(w,)] for w in s[1:]]
            base = sum(math.log10((c + 0.5) / (self.n + 0.5 * (self.v + 1))) for c in known)
            score = sum(math.log10(self.p(tuple(s[max(0, j - self.order + 1) : j]), s[j])) for j in range(1, len(s)))
            yield (doc_id, self.held(doc_id), len(s) - 1, sum(c > 0 for c in known), self.n, base, score)


def check(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:5], round(r[5], 6))
    got, want = sorted((tuple(r) for r in got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


@pytest.mark.parametrize(("order", "sizes"), [(2, {}), (3, {"batch": 2000, "bucket": 4000})])
def test_against_dictionaries(spark, order, sizes):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    brute = Brute([(r.doc_id, r.text) for r in docs.collect()], order)
    check(katz.score(docs, order=order, **sizes).collect(), brute.rows())


def test_the_query_goes_down_from_trigrams(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    brute = Brute([(r.doc_id, r.text) for r in docs.collect()], 3)
    check(op1_katz(spark, SF).collect(), brute.rows())


def test_each_context_adds_up_to_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    brute = Brute([(r.doc_id, r.text) for r in docs.collect()], 3)
    words = [g[0] for g in brute.counts[1]]
    for h in list(brute.total)[:40]:
        assert sum(brute.p(h, w) for w in words) + brute.p(h, "?\n") == pytest.approx(1, abs=1e-9)


def test_held_out_texts_score_better_than_by_unigrams(spark):
    rows = katz.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).filter("held_out").collect()
    assert sum(r.score for r in rows) > 0.9 * sum(r.base_score for r in rows)


def test_odd_rows(edges):
    brute = Brute([(r[0], r[1]) for r in EDGES], 2)
    check(katz.score(edges, batch=50).collect(), brute.rows())


def test_no_rows(no_docs):
    assert katz.score(no_docs).collect() == []


def test_nothing_to_learn_from(spark):
    held = [i for i in range(100) if Brute.held(i)][:3]
    docs = spark.createDataFrame([(i, "a b c") for i in held], "doc_id long, text string")
    assert [(r.train_tokens, r.n_known, r.score) for r in katz.score(docs).collect()] == [(0, 0, 0.0)] * 3


def test_arrays_survive_packing():
    import numpy as np

    for a in (np.array([1, 5, 9], np.uint64), np.zeros(0, np.int64), np.array([0.5, -2.0])):
        assert (katz.unpack(katz.pack(a))[0] == a).all()
