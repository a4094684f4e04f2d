"""The trie of turn sequences of conversations, from their sorted order.

A node is a sequence of turns (role and text) with which at least one conversation
starts. Conversations are reduced to 128-bit hashes and word counts of their turns,
equal ones are counted once, and the different sequences are sorted. In sorted
order the members of a node are neighbours. A block of neighbours is one task:

1. The longest common prefixes (LCP) of neighbours go into a sparse table of range
   minima. A candidate prefix is a place in the order and a depth above the LCP
   before it, so each node has one candidate.
2. Every candidate finds where its members end, and where those of its parent begin,
   each by its own binary search over the table: no stack, no order among them.
3. Nodes in order of place and depth are in preorder, so what a subtree adds up to
   is a difference of prefix sums, and its least conversation a range minimum.

Only prefixes of a block's first and last sequence can have members outside it. For
each of these a block hands on one path with sums for every depth, of which the
next round makes far fewer blocks, until one is left; every other node is finished
where it is found. The paths of a round are two a block at most, whatever the data.

A role or text that is null counts as empty. Rows are ordered by turn, null first,
and rows of one turn by a hash, so that their order does not depend on the input's.
Rows without a conv_id belong to no conversation and are left out. Repeated rows are
turns of their own. Other columns are ignored. An empty table gives no node, not even
the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.arrays import powers, ragged
from ledgermill.scale import Scratch, attach, stage

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 50_000  # turns and sequences in a block
HEAD = 3

_TURN = "struct<a: bigint, b: bigint, words: bigint>"
_NONE = np.iinfo(np.int64).max
_SUMS = ("n", "kids", "leaves", "saved")
_PART = "struct<depth: bigint, n: bigint, low: bigint, kids: bigint, leaves: bigint, saved: bigint, ends: string>"
_NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
_KEYS = ("k1", "k2", "p1", "p2")
_OUT = ", ".join([*[f"{n} bigint" for n in (*_NODE, *_KEYS)], f"ends string, path array<{_TURN}>, parts array<{_PART}>"])


def paths(rows: DataFrame) -> DataFrame:
    """conv_id and path: the turns of each conversation in order, as hashes and word counts."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = rows.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.struct(
            "turn",
            F.xxhash64(role, text).alias("a"),
            F.xxhash64(F.lit(1), role, text).alias("b"),
            F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"),
        ).alias("t"),
    )
    ordered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return ordered.select("conv_id", F.transform("t", lambda t: F.struct(t["a"], t["b"], t["words"])).cast(f"array<{_TURN}>").alias("path"))


def with_shared_heads(convs: DataFrame, group: int = 20, head: int = HEAD) -> DataFrame:
    """Every conversation c rebuilt: the first h turns of conversation c - c % `group`, then its own
    after its first h, where h is the checksum of c modulo `head` + 1."""
    starts = convs.filter(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("start"), F.slice("path", 1, head).alias("head")
    )
    c = F.col("conv_id")
    h = (F.crc32(c.cast("string")) % (head + 1)).cast("int")
    taken = F.slice(F.coalesce("head", F.array().cast(f"array<{_TURN}>")), F.lit(1), h)
    own = F.slice("path", h + 1, F.greatest(F.size("path") - h, F.lit(0)))
    joined = convs.withColumn("start", c - c % group).join(starts, "start", "left")
    return joined.select("conv_id", F.concat(taken, own).alias("path"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbours of one sequence as one row: their least id, their number and the ids as text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        m1, m2, ids = (batch.column(c).to_numpy() for c in ("m1", "m2", "conv_id"))
        first = np.flatnonzero(np.append(True, (np.diff(m1) != 0) | (np.diff(m2) != 0)))
        ends = np.append(first[1:], len(ids))
        texts = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(first, ends)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(m1[first]), pa.array(m2[first]), pa.array(ids[first]), pa.array(ends - first), pa.array(texts)],
            ["m1", "m2", "low", "n", "ids"],
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each sequence: least id, number, and the SHA-256 of all ids, read as a stream."""
    now, low, n, digest = None, 0, 0, hashlib.sha256()
    names = ["m1", "m2", "low", "n", "ends"]
    types = [*[pa.int64()] * 4, pa.string()]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    for batch in batches:
        out = []
        for m1, m2, least, some, ids in zip(*[batch.column(c).to_pylist() for c in ("m1", "m2", "low", "n", "ids")]):
            if (m1, m2) != now:
                if now is not None:
                    out.append((*now, low, n, digest.hexdigest()))
                now, low, n, digest = (m1, m2), least, 0, hashlib.sha256()
            digest.update((b"," if n else b"") + ids.encode())
            n += some
        if out:
            yield made(out)
    if now is not None:
        yield made([(*now, low, n, digest.hexdigest())])


class RangeMinima:
    """Minima of all runs of a power of two; runs of equal or larger values are found by halving steps."""

    def __init__(self, values: np.ndarray):
        self.levels, width = [values], 1
        while 2 * width <= len(values):
            before = self.levels[-1]
            self.levels.append(np.minimum(before[:-width], before[width:]))
            width *= 2

    def right(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The first place from `at` on whose value is under `least`, or the number of values."""
        at = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            table = self.levels[k]
            fits = at < len(table)
            fits[fits] = table[at[fits]] >= least[fits]
            at[fits] += 1 << k
        return at

    def left(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The place after the last one before `at` whose value is under `least`, or 0."""
        at = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            before = at - (1 << k)
            fits = before >= 0
            fits[fits] = self.levels[k][before[fits]] >= least[fits]
            at[fits] = before[fits]
        return at

    def least(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The minimum of each run from `begin` to before `end`; none of them is empty."""
        out = np.empty(len(begin), self.levels[0].dtype)
        size = np.frexp((end - begin).astype(np.float64))[1] - 1
        for k, table in enumerate(self.levels):
            mine = size == k
            out[mine] = np.minimum(table[begin[mine]], table[end[mine] - (1 << k)])
        return out


def common_prefixes(starts: np.ndarray, lengths: np.ndarray, *lanes: np.ndarray) -> np.ndarray:
    """The LCP of each sequence and the next one; sequences lie end to end in the lanes."""
    shorter = np.minimum(lengths[:-1], lengths[1:])
    here, there = ragged(starts[:-1], shorter), ragged(starts[1:], shorter)
    differ = np.zeros(len(here), bool)
    for lane in lanes:
        differ |= lane[here] != lane[there]
    pair = np.repeat(np.arange(len(shorter)), shorter)
    lcp = shorter.copy()
    at = np.flatnonzero(differ)
    np.minimum.at(lcp, pair[at], at - (np.cumsum(shorter) - shorter)[pair[at]])
    return lcp


class Block:
    """The part of the trie that one run of sorted sequences shows."""

    def __init__(self, table: pa.Table):
        self.path = table.column("path").combine_chunks()
        self.parts = table.column("parts").combine_chunks()
        turns = self.path.flatten()
        lanes = [np.asarray(turns.field(c)).astype(np.int64) for c in ("a", "b")]
        words = np.asarray(turns.field("words")).astype(np.int64)
        offsets = np.asarray(self.path.offsets).astype(np.int64) - self.path.offsets[0].as_py()
        self.starts, self.lengths = offsets[:-1], np.diff(offsets)
        m = len(self.lengths)
        self.before = np.append(-1, common_prefixes(self.starts, self.lengths, *lanes))  # the LCP with the one before
        self.minima = RangeMinima(self.before)
        new = self.lengths - self.before
        self.first = np.append(0, np.cumsum(new))  # the first node of each place
        self.place = np.repeat(np.arange(m), new)
        self.depth = ragged(self.before + 1, new)
        # Members of a node: places up to the first whose LCP with the one before is less than its depth.
        self.end = self.first[self.minima.right(self.place + 1, self.depth)]
        self.parent = np.arange(len(self.depth)) - 1
        opens = self.depth == self.before[self.place] + 1
        opens[0] = False
        self.parent[opens] = self.node(self.place[opens], self.depth[opens] - 1)
        turn = self.starts[self.place] + self.depth - 1
        self.words = np.where(self.depth > 0, words[np.maximum(turn, 0)] if len(words) else 0, 0)
        self.keys = [self._key(lane, offsets) for lane in lanes]
        self._own()

    def node(self, place: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The node of the first `depth` turns of the sequence at `place`."""
        top = self.minima.left(place + 1, depth) - 1  # places after `top` share that many turns with the one before
        return self.first[top] + depth - self.before[top] - 1

    def _key(self, lane: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """A hash of the turns of each node in order."""
        within = np.arange(len(lane)) - np.repeat(self.starts, self.lengths)
        step = powers(int(self.lengths.max(initial=0)) + 1)[0]
        sums = np.zeros(len(lane) + 1, np.uint64)
        np.cumsum(lane.view(np.uint64) * step[within], out=sums[1:])
        return (sums[self.starts[self.place] + self.depth] - sums[self.starts[self.place]]).view(np.int64)

    def _own(self) -> None:
        """What the rows bring to the nodes on their paths."""
        parts = self.parts.flatten()
        each = np.diff(np.asarray(self.parts.offsets))
        place = np.repeat(np.arange(len(each)), each)
        depth = np.asarray(parts.field("depth")).astype(np.int64)
        to = self.node(place, depth)
        self.own = {}
        for name in _SUMS:
            self.own[name] = np.zeros(len(self.depth), np.int64)
            np.add.at(self.own[name], to, np.asarray(parts.field(name)).astype(np.int64))
        self.low = np.full(len(self.depth), _NONE)
        np.minimum.at(self.low, to, np.asarray(parts.field("low").fill_null(_NONE)).astype(np.int64))
        self.ends = np.full(len(self.depth), None, object)
        texts = np.asarray(parts.field("ends").to_pylist(), object)
        named = np.flatnonzero(texts != None)  # noqa: E711 - elementwise
        self.ends[to[named]] = texts[named]

    def _below(self, values: np.ndarray) -> np.ndarray:
        """Sums over the subtree of each node, itself included."""
        sums = np.append(0, np.cumsum(values))
        return sums[self.end] - sums[: len(values)]

    def figures(self) -> dict[str, np.ndarray]:
        convs = self._below(self.own["n"])
        children = self.own["kids"] + np.bincount(self.parent[1:], minlength=len(self.parent))
        return {
            "n": convs,
            "kids": children,
            "leaves": self._below(self.own["leaves"] + (children == 0)),
            "saved": self._below(self.own["saved"] + (convs - 1) * self.words),
            "low": RangeMinima(self.low).least(np.arange(len(self.low)), self.end),
        }

    def open_nodes(self) -> np.ndarray:
        """Prefixes of the first and of the last sequence: those that may go on beside the block."""
        last = len(self.lengths) - 1
        found = np.zeros(len(self.depth), bool)
        found[: self.first[1]] = True
        depths = np.arange(self.lengths[last] + 1)
        found[self.node(np.full(len(depths), last), depths)] = True
        return found

    def handed_on(self, open_nodes: np.ndarray, figures: dict[str, np.ndarray]) -> list[list[dict]]:
        """The sums of the open nodes, without what is below other open nodes: those of the first path and of the last."""
        own = {name: values.copy() for name, values in self.own.items()}
        low = self.low.copy()
        done = np.flatnonzero(~open_nodes)
        done = done[open_nodes[self.parent[done]]]
        up = self.parent[done]
        for name, values in (("n", figures["n"]), ("leaves", figures["leaves"]), ("saved", figures["saved"])):
            np.add.at(own[name], up, values[done])
        np.add.at(own["kids"], up, 1)
        np.minimum.at(low, up, figures["low"][done])
        out: list[list[dict]] = [[], []]
        for x in np.flatnonzero(open_nodes).tolist():
            out[int(x >= self.first[1])].append(
                {"depth": int(self.depth[x]), "low": None if low[x] == _NONE else int(low[x]), "ends": self.ends[x]}
                | {name: int(own[name][x]) for name in _SUMS}
            )
        return out


def _block(whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        block = Block(table)
        figures = block.figures()
        open_nodes = np.zeros(len(block.depth), bool) if whole else block.open_nodes()
        done = np.flatnonzero(~open_nodes)
        up = block.parent[done]
        known = (up >= 0) & ~open_nodes[up]
        above = [np.where(up >= 0, key[up], 0) for key in block.keys]
        columns = [
            pa.array(figures["low"][done]),
            pa.array(block.depth[done]),
            pa.array(figures["low"][up], mask=~known),
            *[pa.array(figures[name][done]) for name in ("n", "kids", "leaves", "saved")],
            *[pa.array(key[done]) for key in block.keys],
            *[pa.array(key, mask=known | (up < 0)) for key in above],
            pa.array(block.ends[done].tolist(), pa.string()),
        ]
        kinds = table.schema.field("path").type, table.schema.field("parts").type
        nothing = [pa.nulls(len(done), kind) for kind in kinds]
        names = [*_NODE, *_KEYS, "ends", "path", "parts"]
        yield pa.RecordBatch.from_arrays([*columns, *nothing], names)
        if whole:
            return
        parts = block.handed_on(open_nodes, figures)
        rows = [0, len(block.lengths) - 1] if parts[1] else [0]
        types = [c.type for c in columns]
        yield pa.RecordBatch.from_arrays(
            [
                *[pa.nulls(len(rows), t) for t in types],
                block.path.take(pa.array(rows)),
                pa.array(parts[: len(rows)], kinds[1]),
            ],
            names,
        )

    return run


def sequences(convs: DataFrame, scratch: Scratch) -> DataFrame:
    """path and parts: every different sequence once, with its conversations counted and digested."""
    marked = scratch.stage(
        convs.select("conv_id", "path", F.xxhash64("path").alias("m1"), F.xxhash64(F.lit(1), "path").alias("m2")), "marked"
    )
    order = ["m1", "m2", "conv_id"]
    parts = int(convs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = marked.select(*order).repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(
        _runs, "m1 bigint, m2 bigint, low bigint, n bigint, ids string"
    )
    ends = runs.repartition("m1", "m2").sortWithinPartitions("m1", "m2", "low").mapInArrow(
        _digests, "m1 bigint, m2 bigint, low bigint, n bigint, ends string"
    )
    zero = F.lit(0).cast("bigint")
    part = F.struct(
        F.size("path").cast("bigint").alias("depth"), "n", "low", zero.alias("kids"), zero.alias("leaves"), zero.alias("saved"), "ends"
    )
    first = marked.select(F.col("conv_id").alias("low"), "path").join(ends.select("low", "n", "ends"), "low")
    return first.select("path", F.array(part).cast(f"array<{_PART}>").alias("parts"))


def prefix_nodes(convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The nodes of the trie of `convs` (conv_id, path as `paths` gives it; a conv_id is one row).

    conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens
    and ends, the SHA-256 of the conversations that end there, or null."""
    spark = convs.sparkSession
    with Scratch(spark) as scratch:
        level = scratch.stage(sequences(convs, scratch), "sequences")
        rounds: list[DataFrame] = []
        while True:
            size = level.agg(F.coalesce(F.sum(F.size("path") + 1), F.lit(0)).alias("size")).first()["size"]
            whole = size <= block
            dealt = level.repartition(1) if whole else level.repartitionByRange(-(-size // block), "path")
            out = scratch.stage(dealt.sortWithinPartitions("path").mapInArrow(_block(whole), _OUT), "trie")
            rounds.append(out.filter("depth IS NOT NULL"))
            if whole:
                break
            level = out.filter("depth IS NULL").select("path", "parts")
            block *= 2  # so that also very long sequences end in one block
        found = rounds[0]
        if len(rounds) > 1:
            later = rounds[1]
            for more in rounds[2:]:
                later = later.union(more)
            found = found.union(later)
            # Parents handed on by a block were finished later, a path a block and round.
            parents = later.select(
                F.col("k1").alias("p1"), F.col("k2").alias("p2"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("_up")
            )
            found = attach(found, parents, ["p1", "p2", "depth"], spread=["k1", "k2"])
            found = found.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_up"))
        return stage(found.select(*_NODE, "ends"), "trie-nodes")
