"""The Katz model against its definition."""

import random
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from featherline.llm import katz

BEGIN = b" begin"


def brute(rows, order):
    """Scores straight from the definition, by recursion; probability and its histories."""
    c, after = [Counter() for _ in range(order + 1)], defaultdict(set)
    for _, out, t in rows:
        if not out:
            own = [BEGIN] * (order - 1) + [*katz.tokens(t), katz.END]
            for i in range(order - 1, len(own)):
                for m in range(1, order + 1):
                    gram = tuple(own[i - m + 1 : i + 1])
                    c[m][gram] += 1
                    after[gram[:-1]].add(gram[-1])
    total = sum(c[1].values())
    uni = katz.Unigrams.of(total, len(c[1]), Counter(c[1].values()))
    d = [None, None, *(katz.discounts(Counter(c[m].values())) for m in range(2, order + 1))]

    @cache
    def of(h):
        m = len(h) + 1
        n = sum(c[m][*h, v] for v in after[h])
        left = sum(c[m][*h, v] * (1 - d[m][c[m][*h, v]]) for v in after[h] if c[m][*h, v] <= katz.K)
        return n, *(float(x[0]) for x in katz.weights(np.array([n]), np.array([left]), np.array([sum(p(h[1:], v) for v in after[h])])))

    @cache
    def p(h, w):
        if not h:
            return float(uni.p(np.array([c[1][w,]]))[0])
        n, scale, back = of(h)
        k = c[len(h) + 1][*h, w]
        if not n:
            return p(h[1:], w)
        return k * (d[len(h) + 1][k] if k <= katz.K else 1) * scale / n if k else back * p(h[1:], w)

    out = []
    for key, held, t in rows:
        own = [BEGIN] * (order - 1) + [*katz.tokens(t), katz.END]
        s = sum(np.log10(p(tuple(own[i - order + 1 : i]), own[i])) for i in range(order - 1, len(own)))
        own = own[order - 1 :]
        b = sum(np.log10((c[1][w,] + 0.1) / (total + 0.1 * (len(c[1]) + 1))) for w in own)
        out.append((key, held, len(own), sum(c[1][w,] > 0 for w in own), total, b, s))
    return out, c, p


def some_rows(odd):
    r = random.Random(4)
    zipf = [f"w{int(1 / (r.random() + 1e-3)) % 300}" for _ in range(9000)]
    rows = [(i, i % 10 == 0, " ".join(zipf[i * 90 : i * 90 + r.randrange(90)])) for i in range(100)]
    return [*rows, *rows[:3], *[(x.doc_id, (x.doc_id or 0) == 8, x.text) for x in odd.collect()]]


@pytest.mark.parametrize("order", [2, 3, 4])
def test_scores(spark, odd, none, order):
    rows = some_rows(odd)
    want, c, p = brute(rows, order)
    histories = [(BEGIN,), (b"w1",), (b"w2",), (b"never",)] if order == 2 else [(BEGIN, BEGIN), (BEGIN, b"w1"), (b"w1", b"w1"), (b"w2", b"w1"), (b"w299", b"never")]
    for h in histories:
        assert sum(p(h, w) for (w,) in c[1]) + p(h, b"unknown word") == pytest.approx(1)
    got = katz.score(spark.createDataFrame(rows, "doc_id long, held boolean, text string"), F.col("held"), order=order, most_tokens=500).collect()
    key = lambda r: (str(r[0]), r[2], round(r[6], 4))
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:])


def test_empty_tables_and_names(spark, odd, none):
    assert katz.score(none, F.lit(False)).count() == 0
    got = katz.score(odd.withColumns({"held": F.lit("x"), "bid": F.lit("y"), "told": F.lit(0), "part": F.lit(1)}), F.lit(True)).collect()
    assert len(got) == odd.count() and {r.train_tokens for r in got} == {0}


@pytest.mark.parametrize("order", [2, 3])
def test_large_histories_are_split(spark, monkeypatch, order):
    rows = [(i, i % 10 == 0, " ".join(f"the n{(i * 7 + j * j) % 50}" + " of the" * (j % 3) for j in range(30))) for i in range(60)]
    want, _, _ = brute(rows, order)
    monkeypatch.setattr(katz, "LARGE", 100)
    got = katz.score(spark.createDataFrame(rows, "doc_id long, held boolean, text string"), F.col("held"), order=order, most_tokens=300).collect()
    assert [r.score for r in sorted(got, key=lambda r: r.doc_id)] == pytest.approx([w[6] for w in want])


def test_discounts_stay_in_range():
    for n in ({}, {1: 5}, {1: 100, 2: 40, 3: 20, 4: 12, 5: 9, 6: 7}, {2: 5}, {1: 3, 2: 90, 3: 1}, {1: 10, 2: 10, 3: 10, 4: 10, 5: 10, 6: 10, 7: 10}):
        d = katz.discounts(n)
        assert ((d > 0) & (d <= 1)).all()


def test_discounts_are_good_turing():
    """Plain where the counts of counts are smooth; smoothed, never absolute, where copied texts make them jump."""
    n = {r: 10_000 / (r * (r + 1)) for r in range(1, 30)}
    a = 6 * n[6] / n[1]
    assert katz.discounts(n)[1:] == pytest.approx([((r + 1) * n[r + 1] / (r * n[r]) - a) / (1 - a) for r in range(1, 6)])
    jumpy = n | {4: n[4] * 0.5, 5: n[5] * 2}
    d = katz.discounts(jumpy)
    x, z = np.log(range(1, 25)), np.log([jumpy[r] for r in range(1, 25)])
    b = np.polyfit(x, z, 1)[0]
    s = [float(r) ** b for r in range(1, 7)]
    a = 6 * s[5] / s[0]
    assert d[1:] == pytest.approx([((r + 1) * s[r] / (r * s[r - 1]) - a) / (1 - a) for r in range(1, 6)]) and (np.diff(d[1:]) > 0).all()
