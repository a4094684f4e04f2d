import re
from collections import Counter, defaultdict

import numpy as np

from ledgermill.llm import jaccard
from tests.llm.samples import awkward, edited, empty, frame, row, sentence


def brute(rows, n=5, threshold=0.8):
    sets = {}
    for r in rows:
        found = [w for w in re.split(r"[\x20\x09-\x0d]+", (r[1] or "").lower()) if w]
        runs = [tuple(found[k : k + n]) for k in range(len(found) - n + 1)] if len(found) >= n else [tuple(found)]
        sets[r[0]] = frozenset(runs) if found else frozenset()
    label, links, pairs = {i: i for i in sets}, Counter(), set()

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                shared = len(sets[a] & sets[b])
                if shared >= threshold * (len(sets[a]) + len(sets[b]) - shared):
                    links[a] += 1
                    links[b] += 1
                    pairs.add((a, b))
                    low, high = sorted((top(a), top(b)))
                    label[high] = low
    return {i: (top(i), links[i]) for i in sets}, pairs, sets


def corpus():
    rows, passage = awkward(), sentence(9, 60)
    at = 20
    for group in range(12):
        base = sentence(100 + group, 60 + 20 * group)
        for k in range(6):
            rows.append(row(at, edited(base, at, k % 4), source="c"))
            at += 1
    for k in range(40):
        rows.append(row(at, sentence(500 + k, 30) + " " + passage + " " + sentence(900 + k, 120)))
        at += 1
    return rows


def test_classes_and_links_match_brute_force(spark):
    rows = corpus()
    want, pairs, sets = brute(rows)
    join = jaccard.JaccardJoin(frame(spark, rows))
    got = {r.doc_id: (r.class_id, r.n_links) for r in join.result().collect()}
    assert got == want
    least = {}
    for i in sorted(sets):
        if sets[i]:
            least.setdefault(sets[i], i)
    between = {(a, b) for a, b in pairs if least[sets[a]] == a and least[sets[b]] == b}
    assert {(r.a, r.b) for r in join.pairs().collect()} == between
    assert {r.doc_id: r.copy_class for r in join.membership().collect()} == {
        i: least[s] if s else i for i, s in sets.items()
    }


def test_large_group_of_near_copies_is_tiled(spark, monkeypatch):
    base = sentence(3, 200)
    rows = [row(i, edited(base, i, 3)) for i in range(700)]
    got = jaccard.jaccard_join(frame(spark, rows)).collect()
    want, _, _ = brute(rows)
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == want


def test_filter_keeps_one_of_each_group_and_all_columns(spark):
    rows = corpus()
    want, _, _ = brute(rows)
    docs = frame(spark, rows)
    kept = jaccard.first_of_classes(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (c, _) in want.items() if c == i)


def test_repeated_rows_and_empty_table(spark):
    text = sentence(4, 50)
    got = jaccard.jaccard_join(frame(spark, [row(1, text), row(1, text), row(2, text)])).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in got) == [(1, 1, 1), (1, 1, 1), (2, 1, 1)]
    assert jaccard.jaccard_join(empty(spark)).collect() == []


def test_null_keys_are_documents_like_others(spark):
    base = sentence(4, 60)
    near, other, third = edited(base, 1, 1), sentence(5, 60), sentence(6, 60)
    rows = [row(1, base), row(None, near), row(2, other), row(None, other), row(None, other), row(3, sentence(7, 60))]
    rows += [row(None, third), row(None, edited(third, 2, 1)), row(None, None)]
    join = jaccard.JaccardJoin(frame(spark, rows))
    none = (None, None, None, 0)
    linked = (None, None, None, 1)
    want = [(1, 1, 1, 1), (None, 1, None, 1), (2, 2, 2, 1), (None, 2, 2, 1), (None, 2, 2, 1), (3, 3, 3, 0), linked, linked, none]
    got = [(r.doc_id, r.class_id, r.copy_class, r.n_links) for r in join.result().collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sorted(((r.a, r.b) for r in join.pairs().collect()), key=str) == [(1, None), (None, None)]
    kept = jaccard.first_of_classes(frame(spark, rows)).collect()
    assert sorted((str(r.doc_id) for r in kept)) == ["1", "2", "3", "None", "None"]  # one of the pair, and the empty text


def test_one_key_with_different_texts(spark):
    base, other = sentence(4, 60), sentence(5, 60)
    rows = [row(1, base), row(1, other), row(2, edited(base, 1, 1)), row(3, other)]
    got = jaccard.jaccard_join(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in got) == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1)]
    kept = jaccard.first_of_classes(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted([(1, base), (1, other)])


def test_runs_reach_the_recall():
    runs = jaccard.runs_for(0.8, 0.999)
    assert 1 - (1 - jaccard.survival(0.8, jaccard.MAX_DEPTH)) ** runs >= 0.999
    shared = defaultdict(int)
    for run, _ in jaccard._root_children(runs, 0.8):
        shared[run] += 1
    assert set(shared) == set(range(runs)) and set(shared.values()) <= {1, 2}


def test_short_texts_differ_by_the_order_of_their_words(spark):
    texts = ["dog bites", "bites dog", "dog bites man", "man bites dog", "a b c d", "d c b a", "dog  Bites man", "dog", "dog dog"]
    rows = [row(i, text) for i, text in enumerate(texts)]
    want, _, _ = brute(rows)
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.jaccard_join(frame(spark, rows)).collect()}
    assert got == want and want[6] == (2, 1)
    kept = jaccard.first_of_classes(frame(spark, rows))
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 7, 8]


def test_runs_that_share_minhashes_reach_the_recall():
    runs, pairs = jaccard.runs_for(0.8, 0.999), 40_000
    random = np.random.default_rng(1)
    share = random.binomial(jaccard.HASHES, 0.8, pairs)[:, None] / jaccard.HASHES
    paths = np.ones((pairs, runs), np.int64)
    for _ in range(jaccard.MAX_DEPTH):
        paths = random.binomial(paths + random.binomial(paths, 0.25), share)
    assert (paths.sum(axis=1) == 0).mean() <= 0.0013


def test_pairs_at_the_threshold_survive_down_to_the_greatest_depth(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL_BUCKET", 1)  # so that every bucket is split as long as it can be
    monkeypatch.setattr(jaccard, "DENSE", 0)
    rows = []
    for k in range(2000):
        base = sentence(10_000 + 2 * k, 49).split(" ")
        rows.append(row(2 * k, " ".join(base)))
        rows.append(row(2 * k + 1, " ".join([*base[:20], f"other{k}", *base[21:]])))  # 40 of 50 runs are shared
    got = {r.doc_id: r.n_links for r in jaccard.jaccard_join(frame(spark, rows)).collect()}
    assert sum(got[2 * k] == 0 for k in range(2000)) <= 5
