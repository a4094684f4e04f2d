import hashlib
import math
from collections import Counter

import pytest

from ledgermill.llm import mixing
from tests.llm.samples import awkward, empty, frame, row, sentence


def copies(mean, *parts, seed="mix"):
    total, pieces = 0, max(1, math.ceil(mean / mixing.MEAN_LIMIT))
    for part in range(1, pieces + 1):
        words = [seed, str(part), *("null" if p is None else str(p) for p in parts)]
        u = int(hashlib.md5("|".join(words).encode()).hexdigest()[:13], 16) / (1 << 52)
        k, p = 0, math.exp(-mean / pieces)
        reached = p
        while reached <= u:
            k += 1
            p *= mean / pieces / k
            reached += p
        total += k
    return total


@pytest.fixture(scope="module")
def rows():
    made = [row(100 + k, sentence(k, 20 + k % 5), source="big" if k % 3 else "small") for k in range(600)]
    return awkward() + made


def test_counts_are_poisson_inverses(spark, rows):
    docs = frame(spark, rows)
    rates = {r.source: r.rate for r in mixing.rates_by_power(docs, 0.5).collect()}
    size = Counter()
    for r in rows:
        size[r[3]] += len((r[1] or "").encode())
    weight = {s: b**0.5 for s, b in size.items()}
    for s, b in size.items():
        assert rates[s] == pytest.approx(sum(size.values()) * weight[s] / sum(weight.values()) / b)
    out = mixing.poisson_mix(docs, power=0.5)
    assert out.columns == [*docs.columns, "copy_"]
    got = Counter(r.doc_id for r in out.collect())
    assert got == Counter({r[0]: n for r in rows if (n := copies(rates[r[3]], r[0]))})


def test_shares_come_near_the_targets(spark):
    rows = [row(k, sentence(k % 50, 30), source="abc"[min(2, k % 10)]) for k in range(4000)]
    docs = frame(spark, rows)
    targets = spark.createDataFrame([("a", 0.5), ("b", 0.5)], "source string, weight double")
    out, name = mixing.replicate(docs, mixing.rates_by_weight(docs, targets))
    n = Counter(r.source for r in out.collect())
    assert set(n) == {"a", "b"} and abs(n["a"] / sum(n.values()) - 0.5) < 0.05
    assert abs(sum(n.values()) / len(rows) - 1) < 0.1


def test_large_means_are_sums_of_parts(spark):
    docs = frame(spark, [row(k, "one two") for k in range(3)])
    rates = spark.createDataFrame([("a", 1200.0)], "source string, rate double")
    got = Counter(r.doc_id for r in mixing.replicate(docs, rates)[0].select("doc_id").collect())
    assert got == {k: copies(1200.0, k) for k in range(3)} and all(1000 < n < 1400 for n in got.values())


def test_order_is_shuffled_and_repeatable(spark, rows):
    docs = frame(spark, rows)
    first = [(r.doc_id, r.copy_) for r in mixing.poisson_mix(docs).collect()]
    again = [(r.doc_id, r.copy_) for r in mixing.poisson_mix(docs.repartition(3)).collect()]
    assert sorted(first, key=str) == sorted(again, key=str) and first != sorted(first, key=str)


def test_empty_and_textless_tables(spark):
    assert mixing.poisson_mix(empty(spark)).collect() == []
    textless = mixing.rates_by_power(frame(spark, [row(1, None), row(2, "")]), 0.5).collect()
    assert [r.rate for r in textless] == [1.0]
