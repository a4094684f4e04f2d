"""N-gram Jaccard join by chosen paths.

A document is the set of hashes of its runs of `n` lower-cased words; a document
of 1 to n - 1 words has one run of all its words. Documents of equal sets form a
copy class, and only class representatives are joined.

Every representative carries `HASHES` minhashes. In each of several runs the
whole table is one bucket that is split recursively: a node samples one token
position (minhash), with probability 1 / threshold - 1 a second one, and its
documents go to the child of their token there. So a pair of similarity equal to
the threshold meets in one child on average, and a run keeps it with a
probability that `survival` gives; runs are repeated until the target recall.
A bucket is brute-forced when it is small, when it is dense (its sampled positions
hold few different tokens for its size, so a split would keep it together), or at
`MAX_DEPTH`. Large ones are brute-forced in tiles of bounded size,
so nothing is dropped and no task gets more than a tile.

Within a tile, pairs are screened by minhash agreement, well below the threshold,
and a pair counts only in the first bucket (in hash order) that both share. The
sets of documents that passed are then built again from their texts and compared
exactly. Only counts and the links of a spanning forest leave a tile, never all pairs.

Null and empty texts, and texts of white space alone, have no set: each is a
class of its own without links. A null key is a key like others, the greatest: it
is a class id only where a class has no other. Repeated rows of one key and text are
one document, and every row of it is returned; rows of one key with different
texts are joined as different documents, which count once as copies of each other.
Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.arrays import as_bytes, grouped, mixed, ragged, slices, small_batches, word_hashes
from ledgermill.llm.components import components
from ledgermill.scale import Scratch, stage

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.999
HASHES = 64
MAX_DEPTH = 8
SMALL_BUCKET = 32
DENSE = 0.4  # different tokens per document, below which a bucket is not split any more
TILE = 256
PAIRS_AT_ONCE = 1 << 17

_RANDOM = np.random.default_rng(5)
_FACTORS = _RANDOM.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def survival(threshold: float, depth: int, agreeing: float | None = None) -> float:
    """The probability that a pair still shares a bucket `depth` splits down, if it agrees in a share
    `agreeing` (`threshold` unless told otherwise) of the positions that are sampled for `threshold`."""
    share = threshold if agreeing is None else agreeing
    extra, lost = 1 / threshold - 1, 0.0
    for _ in range(depth):
        one = 1 - share + share * lost
        lost = (1 - extra) * one + extra * one * one
    return 1 - lost


def screen_for(threshold: float) -> int:
    """The agreeing minhashes below which a pair is not compared, four deviations under the threshold."""
    return math.floor(HASHES * max(0.0, threshold - 4 * math.sqrt(threshold * (1 - threshold) / HASHES)))


def lost_share(threshold: float, runs: int, depth: int = MAX_DEPTH) -> float:
    """The share of pairs of similarity `threshold` that no run keeps or that the screen leaves out.

    All runs sample the same minhashes, so they are independent only for a given number of agreeing ones.
    """
    lost, screen = 0.0, screen_for(threshold)
    for m in range(HASHES + 1):
        weight = math.comb(HASHES, m) * threshold**m * (1 - threshold) ** (HASHES - m)
        lost += weight * (1.0 if m < screen else (1 - survival(threshold, depth, m / HASHES)) ** runs)
    return lost


def runs_for(threshold: float, recall: float, depth: int = MAX_DEPTH) -> int:
    """The least number of runs that loses at most 1 - `recall` of the pairs at the threshold."""
    if lost_share(threshold, 1 << 20, depth) > 1 - recall:
        raise ValueError(f"{HASHES} minhashes cannot reach a recall of {recall}")
    runs = 1
    while lost_share(threshold, runs, depth) > 1 - recall:
        runs += 1
    return runs


def shingles(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """For each text its sorted distinct hashes of `n` words."""
    data, offsets = as_bytes(pc.utf8_lower(pc.fill_null(texts, "")))
    words, first = word_hashes(data, offsets)
    runs = np.zeros(len(words), np.uint64)
    for k in range(min(n, len(words))):
        runs[: len(words) - k] = runs[: len(words) - k] * np.uint64(0xD6E8FEB86659FD93) + words[k:]
    runs = mixed(runs)
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= n:
            yield np.unique(runs[a : b - n + 1])
        elif b > a:
            run = np.full(1, b - a, np.uint64)  # the count first, then the words in their order
            for k in range(a, b):
                run = run * np.uint64(0xD6E8FEB86659FD93) + words[k : k + 1]
            yield mixed(run)
        else:
            yield np.zeros(0, np.uint64)


def _minhash(tokens: np.ndarray) -> np.ndarray:
    """The least of each hash over the tokens, 32 bits each."""
    out = np.full(HASHES, 0xFFFFFFFF, np.uint64)
    for at in range(0, len(tokens), 4096):
        out = np.minimum(out, ((tokens[at : at + 4096, None] * _FACTORS) >> np.uint64(32)).min(axis=0))
    return out.astype(np.uint32).view(np.int32)


def _sketch(kept: list[str], text: str, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                sets = list(shingles(part.column(text), n))
                words = [s.tobytes() for s in sets]
                marks = [mixed(s).sum() for s in sets]
                marks2 = [mixed(s ^ np.uint64(0xA0761D6478BD642F)).sum() for s in sets]
                sketch = np.concatenate([_minhash(s) if len(s) else np.zeros(HASHES, np.int32) for s in sets])
                ends = np.arange(len(sets) + 1) * HASHES
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(name) for name in kept],
                        pa.array(np.array([len(w) // 8 for w in words], np.int64)),
                        pa.array(np.array(marks, np.uint64).view(np.int64)),
                        pa.array(np.array(marks2, np.uint64).view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(sketch)),
                    ],
                    [*kept, "size", "mark", "mark2", "sketch"],
                )

    return run


def _root_children(runs: int, threshold: float) -> list[tuple[int, int]]:
    """(run, minhash position) of every child of the root in every run; fixed, so that all tasks agree."""
    random = np.random.default_rng(11)
    out: list[tuple[int, int]] = []
    for run in range(runs):
        wanted = 1 + (random.random() < 1 / threshold - 1)
        out += [(run, int(p)) for p in random.choice(HASHES, wanted, replace=False)]
    return out


def _leaves(reps: DataFrame, runs: int, threshold: float, scratch: Scratch) -> DataFrame:
    """leaf, node, n (documents in the leaf): buckets of two documents and more that are brute-forced."""
    children = F.array(
        *[F.xxhash64(F.lit(run), F.lit(at), F.col("sketch")[at]) for run, at in _root_children(runs, threshold)]
    )
    level = reps.select("node", F.explode(children).alias("path"))
    found: list[DataFrame] = []
    for depth in range(1, MAX_DEPTH + 1):
        counts = level.groupBy("path").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        sized = scratch.stage(level.join(counts, "path"), "paths")
        small = F.lit(True) if depth == MAX_DEPTH else F.col("n") <= SMALL_BUCKET
        found.append(sized.filter(small).select(F.col("path").alias("leaf"), "node", "n"))
        rest = sized.filter(~small)
        if not rest.limit(1).count():
            break
        first = F.pmod(F.xxhash64("path", F.lit(1)), F.lit(HASHES)).cast("int")
        step = 1 + F.pmod(F.xxhash64("path", F.lit(2)), F.lit(HASHES - 1)).cast("int")
        second = F.pmod(first + step, F.lit(HASHES)).cast("int")
        sampled = scratch.stage(
            rest.join(reps.select("node", "sketch"), "node").select(
                "node", "path", "n", F.get("sketch", first).alias("one"), F.get("sketch", second).alias("two")
            ),
            "sampled",
        )
        kinds = sampled.groupBy("path").agg(
            (F.approx_count_distinct("one") + F.approx_count_distinct("two")).alias("kinds"), F.max("n").alias("n")
        )
        dense = scratch.stage(kinds.filter(F.col("kinds") <= 2 * DENSE * F.col("n")).select("path"), "dense")
        found.append(sampled.join(dense, "path", "left_semi").select(F.col("path").alias("leaf"), "node", "n"))
        extra = F.pmod(F.xxhash64("path", F.lit(3)), F.lit(1 << 20)) < int((1 / threshold - 1) * (1 << 20))
        one, two = F.xxhash64("path", F.lit(1), "one"), F.xxhash64("path", F.lit(2), "two")
        level = sampled.join(dense, "path", "left_anti").select(
            "node", F.explode(F.when(extra, F.array(one, two)).otherwise(F.array(one))).alias("path")
        )
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def _tiles(leaves: DataFrame) -> DataFrame:
    """`leaves` with a tile and the block within it: a leaf of many documents becomes pairs of blocks."""
    blocks = F.ceil(F.col("n") / TILE).cast("int")
    own = F.pmod(F.xxhash64("node", "leaf"), blocks).cast("int")
    return (
        leaves.withColumns({"_own": own, "_blocks": blocks})
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumn("tile", F.xxhash64("leaf", F.least("_own", "_other"), F.greatest("_own", "_other")))
        .withColumn("block", F.when(F.col("_own") == F.col("_other"), 0).when(F.col("_own") < F.col("_other"), 1).otherwise(2))
        .select("tile", "leaf", "block", "node")
    )


def _pairs(tiles: np.ndarray, blocks: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs to compare, for rows sorted by tile: within a block 0, else between blocks 1 and 2."""
    cuts = np.flatnonzero(np.diff(tiles)) + 1
    starts = np.concatenate([[0], cuts])
    sizes = np.diff(np.concatenate([starts, [len(tiles)]]))
    left = np.arange(len(tiles))
    ends = np.repeat(starts + sizes, sizes)
    lengths = ends - left - 1
    at = 0
    sums = np.cumsum(lengths)
    while at < len(left):
        base = sums[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(sums, base + PAIRS_AT_ONCE, "right")))
        a = np.repeat(left[at:stop], lengths[at:stop])
        b = ragged(left[at:stop] + 1, lengths[at:stop])
        fit = (blocks[a] == 0) & (blocks[b] == 0) | (blocks[a] + blocks[b] == 3)
        yield a[fit], b[fit]
        at = stop


def _first_shared(table: pa.Table, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the leaf of each pair's tile is the first that both rows share (leaves come sorted)."""
    lists = table.column("leaves").combine_chunks()
    ends = np.asarray(lists.offsets) - lists.offsets[0].as_py()
    values = np.asarray(lists.flatten())
    width = int(np.diff(ends).max())
    padded = np.full((len(ends) - 1, width), np.iinfo(np.int64).max)
    padded[np.arange(width) < np.diff(ends)[:, None]] = values
    leaf = table.column("leaf").to_numpy()
    out = np.ones(len(a), bool)
    for at in range(0, len(a), 4096):
        i, j = a[at : at + 4096], b[at : at + 4096]
        before = np.where(padded[i] < leaf[i][:, None], padded[i], np.iinfo(np.int64).max)
        shared = (before[:, :, None] == padded[j][:, None, :]) & (before < np.iinfo(np.int64).max)[:, :, None]
        out[at : at + 4096] = ~shared.any(axis=(1, 2))
    return out


def _candidates(table: pa.Table, screen: int) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs that agree in at least `screen` minhashes and count in their tile."""
    lists = table.column("sketch").combine_chunks()
    sketch = np.asarray(lists.flatten()).reshape(-1, HASHES).astype(np.uint8)  # the low bits tell enough
    tiles, blocks = table.column("tile").to_numpy(), table.column("block").to_numpy()
    lefts, rights = [], []
    for a, b in _pairs(tiles, blocks):
        near = (sketch[a] == sketch[b]).sum(axis=1) >= screen
        lefts.append(a[near])
        rights.append(b[near])
    a, b = np.concatenate(lefts), np.concatenate(rights)
    if len(a):
        own = _first_shared(table, a, b)
        a, b = a[own], b[own]
    return a, b


def _screened(screen: int):
    def work(table: pa.Table) -> pa.RecordBatch | None:
        a, b = _candidates(table, screen)
        if not len(a):
            return None
        rows = pa.array(np.unique(np.concatenate([a, b])))
        return table.select(["tile", "leaf", "block", "node", "leaves", "sketch"]).take(rows).combine_chunks().to_batches()[0]

    return lambda batches: grouped(batches, "tile", work)


def _verified(screen: int, threshold: float, n: int, pairs: bool):
    def work(table: pa.Table) -> pa.RecordBatch | None:
        a, b = _candidates(table, screen)
        if not len(a):
            return None
        tiles = table.column("tile").to_numpy()
        ids = table.column("node").to_numpy()
        copies = table.column("copies").to_numpy()
        texts = pa.RecordBatch.from_arrays([table.column("text").combine_chunks()], ["text"])
        sets = [found for part in slices(texts, "text") for found in shingles(part.column("text"), n)]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(tiles)) + 1, [len(tiles)]])
        order = np.argsort(a, kind="stable")
        a, b = a[order], b[order]
        at = np.searchsorted(a, cuts)
        outs: list[tuple[np.ndarray, np.ndarray]] = []
        for low, high, i, j in zip(cuts[:-1], cuts[1:], at[:-1], at[1:]):
            if i < j:
                shared = _overlaps(sets[low:high], a[i:j] - low, b[i:j] - low)
                sizes = np.array([len(s) for s in sets[low:high]])
                union = sizes[a[i:j] - low] + sizes[b[i:j] - low] - shared
                near = shared >= threshold * union - 1e-9
                outs.append((a[i:j][near], b[i:j][near]))
        a = np.concatenate([x for x, _ in outs]) if outs else np.zeros(0, np.int64)
        b = np.concatenate([x for _, x in outs]) if outs else np.zeros(0, np.int64)
        if not len(a):
            return None
        if pairs:
            lower, upper = np.minimum(ids[a], ids[b]), np.maximum(ids[a], ids[b])
            return pa.RecordBatch.from_arrays([pa.array(lower), pa.array(upper)], ["a", "b"])
        links = np.bincount(a, copies[b], len(ids)) + np.bincount(b, copies[a], len(ids))
        root = _roots(ids, a, b)
        rows = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[rows]), pa.array(ids[root[rows]]), pa.array(links[rows].astype(np.int64))], ["a", "b", "links"]
        )

    return lambda batches: grouped(batches, "tile", work, 2_000)


def _overlaps(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many tokens each pair of sets shares."""
    if len(a) <= 4 * len(sets):
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(a, b)])
    tokens, back, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    wanted = n[back] > 1
    column = np.cumsum(n > 1) - 1
    owner, back = owner[wanted], column[back[wanted]]
    counts = np.zeros((len(sets), len(sets)), np.float32)
    width = 2048
    order = np.argsort(back, kind="stable")
    owner, back = owner[order], back[order]
    for low in range(0, int((n > 1).sum()), width):
        i, j = np.searchsorted(back, [low, low + width])
        has = np.zeros((len(sets), width), np.float32)
        has[owner[i:j], back[i:j] - low] = 1
        counts += has @ has.T
    return counts[a, b].astype(np.int64)


def _roots(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each row the connected row of the least id, by least labels over the pairs."""
    order = np.argsort(ids, kind="stable")
    label = np.empty(len(ids), np.int64)
    label[order] = np.arange(len(ids))
    while True:
        before = label.copy()
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = np.minimum(label, label[order[label]])
        if (label == before).all():
            return order[label]


# What tells documents from each other: is the key null, the key, two hashes of the text. Least means least in
# this order, so a null key comes last.
DOCUMENT = ["unkeyed", "key", "text_id", "text_id2"]


def _document(key: Column, text: Column) -> dict[str, Column]:
    return {
        "unkeyed": key.isNull(),
        "key": F.coalesce(key.cast("bigint"), F.lit(0)),
        "text_id": F.xxhash64(text),
        "text_id2": F.xxhash64(F.lit(1), text),
    }


def _key_of(document: str) -> Column:
    return F.when(~F.col(f"{document}.unkeyed"), F.col(f"{document}.key"))


class JaccardJoin:
    """The join of one table of documents with itself; results share what was computed once."""

    def __init__(
        self, docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = WORDS,
        threshold: float = THRESHOLD, recall: float = RECALL,
    ):
        named = [column.alias(name) for name, column in _document(docs[key], docs[text]).items()]
        self.docs = docs.select(*named, docs[text].alias("text"))
        self.n, self.threshold = n, threshold
        small_batches(docs.sparkSession)
        sketched = self.docs.mapInArrow(
            _sketch(DOCUMENT, "text", n),
            "unkeyed boolean, key bigint, text_id bigint, text_id2 bigint, "
            "size bigint, mark bigint, mark2 bigint, sketch array<int>",
        )
        self.rows = stage(sketched, "sketches")
        full = self.rows.filter("size > 0")
        per_class = full.groupBy("mark", "mark2", "size").agg(
            F.min(F.struct(*DOCUMENT)).alias("first"),
            F.count_distinct("unkeyed", "key").alias("copies"),
            F.min("sketch").alias("sketch"),
        )
        self.classes = stage(per_class.withColumn("node", F.monotonically_increasing_id()), "copy-classes")
        runs = runs_for(threshold, recall)
        self.screen = screen_for(threshold)
        schema = "tile bigint, leaf bigint, block int, node bigint, leaves array<bigint>, sketch array<int>"
        with Scratch(docs.sparkSession) as scratch:
            leaves = scratch.stage(_leaves(self.classes, runs, threshold, scratch), "leaves")
            lists = leaves.groupBy("node").agg(F.sort_array(F.collect_set("leaf")).alias("leaves"))
            carried = lists.join(self.classes.select("node", "sketch"), "node")
            tiles = _tiles(leaves).join(carried, "node").select("tile", "leaf", "block", "node", "leaves", "sketch")
            self.near = stage(
                tiles.repartition("tile").sortWithinPartitions("tile").mapInArrow(_screened(self.screen), schema), "near"
            )

    def _verify(self, schema: str, pairs: bool) -> DataFrame:
        near = self.near.select("node").distinct()
        wanted = self.classes.join(near, "node", "left_semi").select("node", "copies", "first.*")
        texts = (
            self.docs.join(wanted, DOCUMENT, "left_semi").groupBy(*DOCUMENT).agg(F.min("text").alias("text"))
            .join(wanted, DOCUMENT).select("node", "copies", "text")
        )
        rows = self.near.join(texts, "node").select(
            "tile", "leaf", "block", "node", "leaves", "sketch", "copies", "text"
        )
        return rows.repartition("tile").sortWithinPartitions("tile").mapInArrow(
            _verified(self.screen, self.threshold, self.n, pairs), schema
        )

    def pairs(self) -> DataFrame:
        """a, b: all pairs of class representatives (least key of a copy class) that are near."""
        found = self._verify("a bigint, b bigint", True)
        for side in ("a", "b"):
            named = self.classes.select(F.col("node").alias(side), F.col("first").alias(f"first_{side}"))
            found = found.join(named, side)
        ends = found.select(
            F.least("first_a", "first_b").alias("low"), F.greatest("first_a", "first_b").alias("high")
        )
        return ends.select(_key_of("low").alias("a"), _key_of("high").alias("b"))

    def membership(self) -> DataFrame:
        """doc_id, copy_class: the least key with the same set of runs; the key itself where the set is empty."""
        named = self.classes.select("mark", "mark2", "size", "first")
        rows = self.rows.select(F.struct(*DOCUMENT).alias("own"), "mark", "mark2", "size")
        rows = rows.join(named, ["mark", "mark2", "size"], "left").withColumn("first", F.coalesce("first", "own"))
        return rows.select(_key_of("own").alias("doc_id"), _key_of("first").alias("copy_class"))

    def ranked(self) -> DataFrame:
        """own, first, top, n_links for every row: its document, the least one of its copy class and the least
        one of all that links connect with it. The first two are the row's own where it has no set."""
        found = stage(self._verify("a bigint, b bigint, links bigint", False), "links")
        linked = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
        linked = components(found.select("a", "b")).join(linked, "node", "left")
        linked = stage(linked.join(self.classes.select("node", "first"), "node"), "linked")
        tops = linked.groupBy("component").agg(F.min("first").alias("top"))
        linked = linked.join(tops, "component").select("node", "links", "top")
        facts = self.classes.select("mark", "mark2", "size", "node", "first", "copies").join(linked, "node", "left")
        rows = self.rows.select(F.struct(*DOCUMENT).alias("own"), "mark", "mark2", "size")
        return rows.join(facts, ["mark", "mark2", "size"], "left").select(
            "own",
            F.coalesce("first", "own").alias("first"),
            F.coalesce("top", "first", "own").alias("top"),
            (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links"),
        )

    def result(self) -> DataFrame:
        """doc_id, class_id, copy_class, n_links for every row.

        class_id is the least key among all documents connected by links, and
        n_links the number of other documents that are near, copies included.
        """
        return self.ranked().select(
            _key_of("own").alias("doc_id"), _key_of("top").alias("class_id"), _key_of("first").alias("copy_class"), "n_links"
        )


def jaccard_join(docs: DataFrame, **options) -> DataFrame:
    """doc_id, class_id, copy_class and n_links of every row of `docs`; options as for `JaccardJoin`."""
    return JaccardJoin(docs, **options).result()


def first_of_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of `docs` whose document is the least of its class, so that one document of each group stays.

    All rows that repeat this document, with equal key and text, stay with it.
    """
    ranked = JaccardJoin(docs, key=key, text=text, **options).ranked()
    gone = ranked.filter("own != top").select("own.*").distinct()
    own = _document(docs[key], docs[text])
    return docs.join(gone, [own[name] == gone[name] for name in DOCUMENT], "left_anti")
