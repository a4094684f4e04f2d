"""Approximate nearest neighbours by largest inner product, over balanced posting lists.

Vectors get one more component that makes all norms equal to the largest, so that
the largest inner product is the least distance. Centroids are fitted on the
driver to a sample of at most `SAMPLE_ROWS` vectors (and `SAMPLE_BYTES`), by
k-means with a penalty on full lists; there are rows / `LIST_ROWS` of them, at
most `MOST_LISTS`. Every vector goes to the list of its nearest centroid and, as
a boundary vector, to up to `REPLICAS` - 1 more whose centroids are at most
`BOUNDARY` times as far.

A query walks a graph of the centroids (each linked both ways to its
nearest and to some far ones), held in memory by every task and bounded by `MOST_LISTS`, and takes
every list whose centroid is at most a ratio times as far as the nearest one, and
the `LEAST_PROBES` nearest in any case. The
ratio is measured: for `TRIALS` queries the true neighbours are found by brute
force over all rows, and the ratio is the least that reaches all but
1 - `RECALL` of them.

Lists of any length are dealt to tiles of at most about `LIST_ROWS` vectors and
`QUERY_ROWS` queries, so a vector that occurs in a third of the rows makes more
tiles and no large one; parts are told by id and vector, so an id of many different
vectors is spread too. A tile computes scores in double precision, summed in
component order, and returns the best different ids of each query. Queries with fewer
answers than there could be search all lists.

Vectors that are null, zero, or hold null or non-finite components take no part,
nor do those whose length is not the most frequent one, nor rows without an id.
Equal rows are one row. Rows that share the query's id are its own; another id counts
once with its best score. Ties go to the smaller id. Other columns are ignored; without vectors
the result is empty.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgermill.llm.arrays import grouped
from ledgermill.scale import stage

LIST_ROWS = 1024
MOST_LISTS = 8192
SAMPLE_ROWS = 65_536
SAMPLE_BYTES = 32 << 20
ROUNDS = 8
REPLICAS = 4
BOUNDARY = 1.3
TRIALS = 256
RECALL = 0.96
LEAST_PROBES = 4
LINKS = 16
FAR_LINKS = 4
QUERY_ROWS = 512
TILE_ROWS = 4096
MERGE_PARTS = 16
ERROR = 1e-12  # of matrix products relative to the norms, with much to spare


@dataclass
class Index:
    """Centroids of the lists, a graph over them, the norm that vectors are raised to, and
    the least squared distance that ratios are taken to, as a centroid may be a lone vector."""

    centroids: np.ndarray
    links: list[np.ndarray]
    norm: float
    floor: float = 0.0

    def raised(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0.0, self.norm**2 - (x * x).sum(axis=1)))
        return np.column_stack([x, rest])

    def lists_of(self, x: np.ndarray) -> list[list[int]]:
        """The lists that each vector is stored in, the nearest first."""
        x = self.raised(x)
        far = _distances(x, self.centroids)
        take = min(REPLICAS, len(self.centroids))
        near = np.argpartition(far, take - 1, axis=1)[:, :take]
        out = []
        for row, own in zip(far, near):
            own = own[np.argsort(row[own], kind="stable")]
            out.append(own[row[own] <= BOUNDARY**2 * row[own[0]]].tolist())
        return out

    def probes(self, query: np.ndarray, ratio: float) -> list[int]:
        """The lists to search: best-first search in the graph, pruned by the ratio to the least distance."""
        query = np.append(query, 0.0)
        least = float(((self.centroids[0] - query) ** 2).sum())
        seen, open_, found = {0}, [(least, 0)], [(least, 0)]
        steps = 0
        while open_:
            far, at = heapq.heappop(open_)
            if steps >= LINKS and far > ratio**2 * max(least, self.floor):
                break
            steps += 1
            new = [c for c in self.links[at].tolist() if c not in seen]
            if not new:
                continue
            seen.update(new)
            for d, c in zip(((self.centroids[new] - query) ** 2).sum(axis=1).tolist(), new):
                least = min(least, d)
                heapq.heappush(open_, (d, c))
                found.append((d, c))
        found.sort()
        return [c for k, (d, c) in enumerate(found) if k < LEAST_PROBES or d <= ratio**2 * max(least, self.floor)]


def _distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances."""
    return np.maximum(0.0, (x * x).sum(axis=1)[:, None] - 2 * (x @ centroids.T) + (centroids * centroids).sum(axis=1))


def fit(sample: np.ndarray, rows: int, norm: float) -> Index:
    """Balanced k-means of the sample, for a table of `rows` vectors."""
    index = Index(np.zeros((0, 0)), [], norm)
    x = index.raised(sample.astype(np.float64))
    random = np.random.default_rng(3)
    k = int(min(MOST_LISTS, max(1, rows // LIST_ROWS), len(x)))
    centroids = x[random.choice(len(x), k, replace=False)]
    for turn in range(ROUNDS):
        sizes = np.zeros(k)
        chosen = np.empty(len(x), np.int64)
        order = random.permutation(len(x))
        for at in range(0, len(x), 1024):
            part = order[at : at + 1024]
            far = _distances(x[part], centroids)
            full = sizes / max(1.0, at / k)  # lists beyond their share cost more
            chosen[part] = (far * (1 + 0.1 * np.maximum(0.0, full - 1))).argmin(axis=1)
            sizes += np.bincount(chosen[part], minlength=k)
        sums = np.zeros_like(centroids)
        np.add.at(sums, chosen, x)
        filled = sizes > 0
        centroids[filled] = sums[filled] / sizes[filled][:, None]
        if turn < ROUNDS - 1:  # a vector of its own would stand at no distance from its list
            centroids[~filled] = x[random.choice(len(x), int((~filled).sum()))]
    ends: list[set[int]] = [set() for _ in range(k)]
    for at in range(0, k, 1024):
        far = _distances(centroids[at : at + 1024], centroids)
        for own, near in enumerate(np.argsort(far, axis=1)[:, : LINKS + 1], at):
            for other in {*near.tolist(), *random.integers(0, k, FAR_LINKS).tolist()} - {own}:
                ends[own].add(other)
                ends[other].add(own)  # else a centroid far from all others could not be found
    links = [np.array(sorted(e), np.int64) for e in ends]
    near = np.concatenate([_distances(x[at : at + 1024], centroids).min(axis=1) for at in range(0, len(x), 1024)])
    return Index(centroids, links, norm, float(np.median(near)) / 2)


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 1))
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def _place(index, ratio: float | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x = _matrix(part.column("vector"))
                lists = index.value.lists_of(x) if ratio is None else [index.value.probes(q, ratio) for q in x]
                ends = np.concatenate([[0], np.cumsum([len(own) for own in lists])])
                flat = np.array([c for own in lists for c in own], np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("vector"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                    ["id", "vector", "lists"],
                )

    return run


def pair_scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """`exact_scores` of each row of `queries` with the same row of `vectors`."""
    out = np.zeros(len(queries))
    for k in range(queries.shape[1]):
        out += queries[:, k] * vectors[:, k]
    return out


def exact_scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed in component order, so equal vectors score equally."""
    out = np.zeros((len(queries), len(vectors)))
    for k in range(queries.shape[1]):
        out += queries[:, k, None] * vectors[:, k]
    return out


def _by_id(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted ids, where each different one begins and the number of each row's among them."""
    new = np.diff(ids, prepend=ids[:1]) != 0
    new[:1] = True
    return np.flatnonzero(new), np.cumsum(new) - 1


def _best_of_tiles(k: int):
    def work(table: pa.Table) -> pa.RecordBatch | None:
        tiles = table.column("tile").to_numpy()
        ids = table.column("id").to_numpy()
        asks = table.column("asks").to_numpy(zero_copy_only=False).astype(bool)
        x = _matrix(table.column("vector"))
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(tiles)) + 1, [len(tiles)]])
        queries, counts, found, scores, owners = [], [], [], [], []
        for low, high in zip(cuts[:-1], cuts[1:]):
            mine = asks[low:high]
            q, v = np.flatnonzero(mine) + low, np.flatnonzero(~mine) + low
            if not len(q) or not len(v):
                continue
            v = v[np.argsort(ids[v], kind="stable")]
            firsts, one_id = _by_id(ids[v])
            for at in range(0, len(q), 64):
                rows = q[at : at + 64]
                values = x[rows] @ x[v].T  # near enough to leave out all but the best
                values[ids[rows][:, None] == ids[v]] = -np.inf
                tops = np.maximum.reduceat(values, firsts, axis=1)
                n = len(firsts)
                least = np.partition(tops, n - k, axis=1)[:, n - k] if n > k else np.full(len(rows), -np.inf)
                slack = ERROR * np.sqrt((x[rows] ** 2).sum(axis=1).max() * (x[v] ** 2).sum(axis=1).max())
                wanted = np.maximum(tops, least[:, None])[:, one_id]  # of each id what may be its best
                at_q, at_v = np.nonzero((values >= wanted - slack) & (values > -np.inf))
                exact = pair_scores(x[rows][at_q], x[v][at_v])
                order = np.lexsort((at_v, -exact, at_q))  # ties stay in order of id
                at_q, at_v, exact = at_q[order], at_v[order], exact[order]
                once = np.sort(np.unique(at_q * n + one_id[at_v], return_index=True)[1])  # the best row of an id
                at_q, at_v, exact = at_q[once], at_v[once], exact[once]
                first = np.searchsorted(at_q, np.arange(len(rows)))
                kept = np.arange(len(at_q)) - first[at_q] < k
                queries.append(ids[rows])
                counts.append(np.bincount(at_q[kept], minlength=len(rows)))
                found.append(ids[v][at_v[kept]])
                scores.append(-exact[kept])
                owners.append(np.full(len(rows), tiles[low]))
        if not queries:
            return None
        ends = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
        best = pa.StructArray.from_arrays([pa.array(np.concatenate(c)) for c in (found, scores)], ["vec_id", "below"])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate(queries)),
                pa.array(np.concatenate(owners)),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), best),
            ],
            ["query_id", "tile", "best"],
        )

    return lambda batches: grouped(batches, "tile", work, 4 * TILE_ROWS)


def _usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    finite = F.forall(
        vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    ) & F.exists(vector, lambda v: v != 0)
    rows = vectors.filter(F.col(key).isNotNull() & F.col(vector).isNotNull()).filter(F.coalesce(finite, F.lit(False)))
    rows = rows.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    return rows.withColumn("norm", F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, v: a + v * v)))


def _search(lists: DataFrame, sizes: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Best of each tile for the queries sent to it: query_id, tile, best (ids with scores below zero)."""
    queries = asked.select("id", "vector", F.explode("lists").alias("list"))
    per_list = queries.groupBy("list").agg(F.count(F.lit(1)).alias("queries"))
    plan = stage(
        sizes.join(per_list, "list").select(
            "list",
            F.ceil(F.col("rows") / TILE_ROWS).cast("int").alias("parts"),
            F.ceil(F.col("queries") / QUERY_ROWS).cast("int").alias("blocks"),
        ),
        "tiles",
    )  # MOST_LISTS rows at most

    def dealt(rows: DataFrame, own: str, other: str, asks: bool) -> DataFrame:
        mine = F.pmod(F.xxhash64("id", "vector"), F.col(own)).cast("int")
        rows = rows.join(F.broadcast(plan), "list").withColumn("mine", mine).withColumn(
            "theirs", F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        )
        part, block = ("theirs", "mine") if asks else ("mine", "theirs")
        return rows.select(F.xxhash64("list", part, block).alias("tile"), "id", "vector", F.lit(asks).alias("asks"))

    both = dealt(lists, "parts", "blocks", False).union(dealt(queries, "blocks", "parts", True))
    return both.repartition("tile").sortWithinPartitions("tile").mapInArrow(
        _best_of_tiles(k), "query_id bigint, tile bigint, best array<struct<vec_id: bigint, below: double>>"
    )


def _brute(trials, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, queries = trials.value
        for batch in batches:
            for at in range(0, batch.num_rows, TILE_ROWS):
                part = batch.slice(at, TILE_ROWS)
                ids = part.column("id").to_numpy()
                by_id = np.argsort(ids, kind="stable")
                ids = ids[by_id]
                firsts, _ = _by_id(ids)
                values = np.maximum.reduceat(queries @ _matrix(part.column("vector"))[by_id].T, firsts, axis=1)
                ids = ids[firsts]
                values[own[:, None] == ids] = -np.inf
                best = np.argsort(-values, axis=1, kind="stable")[:, :k]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(own, best.shape[1])),
                        pa.array(ids[best].ravel()),
                        pa.array(np.take_along_axis(values, best, axis=1).ravel()),
                    ],
                    ["query_id", "vec_id", "score"],
                )

    return run


def _ratio(rows: DataFrame, queries: DataFrame, lists: DataFrame, index: Index, k: int, recall: float) -> float:
    """The least ratio of distances at which `recall` of the true neighbours of some queries are reached."""
    # One vector of each id, so that an id of many vectors does not make all trials.
    once = queries.groupBy("id").agg(F.min_by("vector", F.xxhash64("vector")).alias("vector"))
    trials = once.orderBy(F.xxhash64(F.lit("trial"), "id"), "id").limit(TRIALS).toArrow()
    if not trials.num_rows:
        return 1.0
    own, x = trials.column("id").to_numpy(), _matrix(trials.column("vector"))
    sent = rows.sparkSession.sparkContext.broadcast((own, x))
    true = _top(rows.mapInArrow(_brute(sent, k), "query_id bigint, vec_id bigint, score double"), k)
    held = true.filter(F.col("score") > float("-inf")).join(lists.select(F.col("id").alias("vec_id"), "list"), "vec_id")
    held = held.select("query_id", "vec_id", "list").distinct().toArrow()  # TRIALS * k times the lists of an id at most
    if not held.num_rows:
        return 1.0
    far = _distances(np.column_stack([x, np.zeros(len(x))]), index.centroids)
    shares = np.sqrt(far / np.maximum(far.min(axis=1), max(index.floor, 1e-300))[:, None])
    at = {q: i for i, q in enumerate(own.tolist())}
    needed: dict[tuple[int, int], float] = {}
    for q, v, c in zip(*(held.column(c).to_pylist() for c in ("query_id", "vec_id", "list"))):
        needed[q, v] = min(needed.get((q, v), np.inf), shares[at[q], c])
    return float(np.quantile(list(needed.values()), recall, method="higher")) * (1 + 1e-9)


def nearest(
    vectors: DataFrame, is_query: Callable[[Column], Column], k: int = 20, key: str = "vec_id", vector: str = "embedding",
    recall: float = RECALL,
) -> DataFrame:
    """query_id, rank, vec_id, score: the `k` nearest found for every row that `is_query` (of the key) selects."""
    spark = vectors.sparkSession
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    usable = _usable(vectors, key, vector)
    widths = usable.groupBy(F.size("vector").alias("width")).agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("norm"))
    widest = widths.orderBy(F.desc("n"), "width").first()
    if widest is None:
        return spark.createDataFrame([], schema)
    # Equal rows are one: repeats would only take up places among the best.
    rows = stage(usable.filter(F.size("vector") == widest.width).select("id", "vector").distinct(), "vectors")
    n_rows = rows.count()
    most = min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * widest.width))
    bucket = F.pmod(F.xxhash64(F.lit("sample"), "id", "vector"), F.lit(1_000_000))
    # The hash picks about nine tenths of `most`; the limit only makes the bound certain.
    sample = rows.filter(bucket < int(1e6 * min(1.0, 0.9 * most / n_rows)) + 1).select("vector").limit(most).toArrow()
    fitted = fit(_matrix(sample.column("vector")), n_rows, widest.norm)
    index = spark.sparkContext.broadcast(fitted)
    placed = "id bigint, vector array<double>, lists array<int>"
    lists = stage(
        rows.mapInArrow(_place(index, None), placed).select("id", "vector", F.explode("lists").alias("list")), "lists"
    )
    sizes = stage(lists.groupBy("list").agg(F.count(F.lit(1)).alias("rows")), "list-sizes")
    queries = rows.filter(is_query(F.col("id")))
    ratio = _ratio(rows, queries, lists, fitted, k, recall)
    asked = stage(queries.mapInArrow(_place(index, ratio), placed), "asked")
    found = stage(_best(_search(lists, sizes, asked, k), k), "found")
    others = rows.select("id").distinct().count() - 1
    counts = found.groupBy(F.col("query_id").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    short = asked.join(counts, "id", "left").filter(F.coalesce("n", F.lit(0)) < min(k, others)).select("id", "vector")
    if others > 0 and short.limit(1).count():
        every = F.sequence(F.lit(0), F.lit(len(fitted.centroids) - 1))
        again = _best(_search(lists, sizes, short.withColumn("lists", every), k), k)
        found = found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").union(again)
    return found.select("query_id", "rank", "vec_id", "score")


def _merged(groups: GroupedData, keys: list[str], k: int) -> DataFrame:
    """The `k` best of the lists of each group; an id counts once, with its best score."""
    rows = groups.agg(F.array_sort(F.flatten(F.collect_list("best"))).alias("by_id"))
    # A step of its own, so that the sorted list is not made again for every element.
    first = F.filter("by_id", lambda x, i: (i == 0) | (x["vec_id"] != F.get("by_id", i - 1)["vec_id"]))
    rows = rows.select(*keys, first.alias("once"))
    swapped = F.transform("once", lambda x: F.struct(x["below"].alias("below"), x["vec_id"].alias("vec_id")))
    best = F.transform(
        F.slice(F.array_sort(swapped), 1, k), lambda x: F.struct(x["vec_id"].alias("vec_id"), x["below"].alias("below"))
    )
    return rows.select(*keys, best.alias("best"))


def _best(found: DataFrame, k: int) -> DataFrame:
    """The `k` best over all tiles. Tiles are merged in two steps, as a list that holds
    many rows has many tiles."""
    part = F.pmod(F.xxhash64("tile"), F.lit(MERGE_PARTS)).alias("part")
    halfway = _merged(found.groupBy("query_id", part), ["query_id"], k)
    merged = _merged(halfway.groupBy("query_id"), ["query_id"], k)
    return merged.select("query_id", F.posexplode("best").alias("at", "best")).select(
        "query_id", (F.col("at") + 1).alias("rank"), "best.vec_id", (-F.col("best.below")).alias("score")
    )


def _top(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
