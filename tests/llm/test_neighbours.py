import numpy as np
import pyarrow as pa
import pytest

from ledgermill.llm import neighbours

SCHEMA = "vec_id bigint, embedding array<float>, label int, list int, tile string"


def table(spark, vectors, first=0):
    return spark.createDataFrame(
        [(first + i, None if v is None else [None if c is None else float(c) for c in v], 0, 1, "x") for i, v in enumerate(vectors)],
        SCHEMA,
    )


def brute(vectors, query, k):
    x = np.array(vectors, np.float32).astype(float)
    scores = neighbours.exact_scores(x[query : query + 1], x)[0]
    order = sorted((i for i in range(len(x)) if i != query), key=lambda i: (-scores[i], i))
    return [(i, scores[i]) for i in order[:k]]


@pytest.mark.parametrize("scale", [False, True])
def test_recall_and_scores(spark, scale):
    random = np.random.default_rng(1)
    centres = random.normal(size=(20, 16))
    x = centres[random.integers(0, 20, 3000)] + 0.4 * random.normal(size=(3000, 16))
    x = x * random.uniform(0.5, 2, (3000, 1)) if scale else x / np.linalg.norm(x, axis=1, keepdims=True)
    rows = neighbours.nearest(table(spark, x), lambda i: i % 50 == 0, k=10).collect()
    found = {}
    for r in sorted(rows):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert sorted(found) == list(range(0, 3000, 50))
    hits = 0
    for q, got in found.items():
        want = brute(x, q, 10)
        true = dict(brute(x, q, 3000))
        assert len(got) == 10 and all(true[i] == s for i, s in got)
        assert got == sorted(got, key=lambda p: (-p[1], p[0]))
        hits += len({i for i, _ in got} & {i for i, _ in want})
    assert hits >= 0.9 * 10 * len(found)


def test_ties_copies_and_unusable_vectors(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "TILE_ROWS", 16)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 4)
    same = [[1.0, 2.0, 3.0]] * 60
    bad = [None, [0.0, 0.0, 0.0], [1.0, None, 2.0], [float("nan"), 1.0, 1.0], [float("inf"), 1.0, 1.0], [], [1.0, 2.0]]
    rows = neighbours.nearest(table(spark, same + bad), lambda i: i % 10 == 0, k=20).collect()
    found = {}
    for r in sorted(rows):
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert sorted(found) == [0, 10, 20, 30, 40, 50]
    for q, ids in found.items():
        assert ids == [i for i in range(60) if i != q][:20]


def test_few_and_no_vectors(spark):
    rows = neighbours.nearest(table(spark, [[1.0, 0.0], [0.0, 1.0], [1.0, 1.0]]), lambda i: i % 20 == 0, k=20).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in rows) == [(0, 1, 2), (0, 2, 1)]
    assert neighbours.nearest(table(spark, [[1.0, 0.0]]), lambda i: i == 0).collect() == []
    assert neighbours.nearest(table(spark, [None]), lambda i: i == 0).collect() == []
    assert neighbours.nearest(spark.createDataFrame([], SCHEMA), lambda i: i == 0).collect() == []


def test_short_answers_search_all_lists(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LIST_ROWS", 8)
    monkeypatch.setattr(neighbours, "REPLICAS", 1)
    random = np.random.default_rng(2)
    x = random.normal(size=(200, 8))
    rows = neighbours.nearest(table(spark, x), lambda i: i % 40 == 0, k=150, recall=0.05).collect()
    assert len(rows) == 5 * 150
    assert [(r.vec_id, r.score) for r in sorted(rows) if r.query_id == 40] == brute(x, 40, 150)


def test_repeated_ids_hide_no_others(spark):
    random = np.random.default_rng(4)
    x = np.concatenate([random.normal(size=(40, 6)) + 4, random.normal(size=(90, 6)) + 5])
    ids = [*range(40), *[500] * 30, *[501] * 30, *[2] * 30]  # ids of many different vectors
    rows = [(i, [float(c) for c in v], 0, 1, "x") for i, v in zip(ids, x)]
    rows += [(7, [50.0] * 6, 0, 1, "x")] * 60  # and one of equal rows, the best of all
    got = neighbours.nearest(spark.createDataFrame(rows, SCHEMA), lambda i: i % 10 == 0, k=12).collect()
    found = {}
    for r in sorted(got):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    at = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], np.float32).astype(float)
    assert sorted(found) == [0, 10, 20, 30, 500]
    for q in found:
        best = {}
        for i, s in zip(at, neighbours.exact_scores(x[at == q], x).max(axis=0)):
            if i != q:
                best[int(i)] = max(s, best.get(int(i), -np.inf))
        assert found[q] == sorted(best.items(), key=lambda p: (-p[1], p[0]))[:12]


def test_brute_force_keeps_different_ids():
    batch = pa.RecordBatch.from_pydict(
        {"id": [9] * 5 + [1, 2, 3], "vector": [[5.0 + i, 0.0] for i in range(5)] + [[1.0, 0.0], [2.0, 0.0], [3.0, 0.0]]}
    )

    class Sent:
        value = np.array([2]), np.array([[1.0, 0.0]])

    out = next(neighbours._brute(Sent, 3)(iter([batch]))).to_pydict()
    assert list(zip(out["vec_id"], out["score"])) == [(9, 9.0), (3, 3.0), (1, 1.0)]
