"""Removal of long repeated byte strings by longest-previous-factor arrays.

A window is a string of `length` bytes inside one text. A byte is removed if a
window that covers it also starts elsewhere in the table: anywhere else, or with
`keep_first` at an earlier place (least key, text hash and position first).

1. Every window is assigned to its anchor: the leftmost of its `GRAM`-byte
   strings of least hash. Equal windows have equal anchors at equal offsets, and
   the windows of one anchor are neighbours, so a text is cut into one stretch for
   every 150 bytes or so, and only a hash of each stretch is shuffled.
2. Stretches of equal bytes are one class. A class that occurs twice is repeated
   as a whole; one whose anchor occurs nowhere else is not repeated at all.
3. Only the first stretch of each class whose anchor other classes share is read
   from its text. Their windows are put in suffix order (prefix doubling to
   `length` bytes, equal prefixes by place). The previous smaller place in that
   order is the earlier match of a window, so its longest previous factor reaches
   `length` exactly if they are equal that far; the next larger place in the run is
   its later match. A class is marked from its first to its last repeated window.
   Anchors of more than `MANY_CLASSES` classes would make one task large: there
   each window is a row of its own, hashed to 128 bits and counted by Spark.
4. Marked intervals are gathered per text, merged, and cut out.

Texts are UTF-8 bytes; null counts as empty. Rows are told apart by key and text
hash, so repeated rows count as copies of each other, and a null key is allowed.
Texts shorter than `length` are never touched. Empty tables give empty results;
other columns stay as they are, and names used here give way to theirs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.arrays import as_bytes, grouped, mixed, powers, prefix_hash, ragged, slices, small_batches, span_hash
from ledgermill.scale import Scratch, stage

LENGTH = 400
GRAM = 100
MANY_CLASSES = 20_000
STRETCH_BYTES = 1 << 18  # texts are anchored in runs of this size, longer ones in overlapping parts
WORK_BYTES = 1 << 19

_PLACE_BITS = np.uint64(24)
_PLACES = np.uint64((1 << 24) - 1)
_SECOND_CODES = np.random.default_rng(21).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def stretches(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """Runs of windows with one anchor: text number, first and last window start, anchor place, anchor hash.

    `data` holds the texts end to end, each from `begins` to `ends`.
    """
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64))
    if len(data) < length:
        return none
    sums, width = prefix_hash(data), length - gram + 1
    hashes = mixed((sums[gram:] - sums[:-gram]) * powers(len(data))[1][: len(data) - gram + 1])
    keys = (hashes & ~_PLACES) | np.arange(len(hashes), dtype=np.uint64)
    padding = -len(keys) % width
    blocks = np.concatenate([keys, np.full(padding, ~np.uint64(0))]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(data) - length + 1
    place = (np.minimum(back[:n], ahead[width - 1 : width - 1 + n]) & _PLACES).astype(np.int64)
    text = np.searchsorted(begins, np.arange(n), "right") - 1
    inside = np.arange(n) + length <= ends[text]
    starts = np.flatnonzero(inside)
    if not len(starts):
        return none
    place, text = place[starts], text[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (np.diff(place) != 0) | (np.diff(text) != 0) | (np.diff(starts) != 1)
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(starts)]]) - 1
    return text[first], starts[first], starts[last], place[first], hashes[place[first]]


def _parts(batch: pa.RecordBatch, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.RecordBatch]]:
    """Bytes, where the texts in them begin and end, the place in its text of the first byte, and the rows."""
    for part in slices(batch, "text", STRETCH_BYTES):
        data, offsets = as_bytes(part.column("text"))
        if len(data) <= STRETCH_BYTES:
            yield data, offsets[:-1], offsets[1:], np.zeros(part.num_rows, np.int64), part
            continue
        for at in range(0, len(data) - length + 1, STRETCH_BYTES):
            piece = data[at : at + STRETCH_BYTES + length - 1]
            yield piece, np.zeros(1, np.int64), np.array([len(piece)]), np.array([at]), part


def _anchors(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, begins, ends, shift, rows in _parts(batch, length):
                text, low, high, place, anchor = stretches(data, begins, ends, length, gram)
                content = span_hash(prefix_hash(data), low, high + length)
                at = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor.view(np.int64)),
                        pa.array(content.view(np.int64)),
                        pa.array((place - low).astype(np.int32)),
                        pa.array((high - low).astype(np.int32)),
                        rows.column("doc").take(at),
                        rows.column("mark").take(at),
                        pa.array(low - begins[text] + shift[text]),
                    ],
                    ["anchor", "content", "lead", "more", "doc", "mark", "at"],
                )

    return run


def _read_stretches(length: int, windows: bool):
    """Bytes of each wanted stretch of a text, or the hashes of its windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", STRETCH_BYTES):
                data, offsets = as_bytes(part.column("text"))
                wanted = part.column("wanted")
                fields = wanted.flatten().flatten()
                named = dict(zip([f.name for f in wanted.type.value_type], fields))
                lists = np.diff(np.asarray(wanted.offsets))
                row = np.repeat(np.arange(part.num_rows), lists)
                at = named["at"].to_numpy()
                low = offsets[:-1][row] + at
                more = named["more"].to_numpy().astype(np.int64)
                owner = pa.array(row)
                columns = {k: named[k] for k in ("anchor", "content", "lead", "n", "at")}
                columns |= {"doc": part.column("doc").take(owner), "mark": part.column("mark").take(owner)}
                if windows:
                    counts = more + 1
                    stretch = np.repeat(np.arange(len(low)), counts)
                    offset = ragged(np.zeros(len(low), np.int64), counts)
                    starts = low[stretch] + offset
                    columns = {k: v.take(pa.array(stretch)) for k, v in columns.items()}
                    columns["offset"] = pa.array(offset.astype(np.int32))
                    for name, sums in (("h1", prefix_hash(data)), ("h2", prefix_hash(data, _SECOND_CODES))):
                        columns[name] = pa.array(span_hash(sums, starts, starts + length).view(np.int64))
                else:
                    lengths = more + length
                    ends = np.concatenate([[0], np.cumsum(lengths)])
                    body = data[ragged(low, lengths)]
                    columns["body"] = pa.LargeBinaryArray.from_buffers(
                        pa.large_binary(), len(low), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(body)]
                    ).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def _ranks(keys: np.ndarray) -> np.ndarray:
    """The rank of each key among the distinct ones. `np.unique` does the same in twice the memory."""
    order = np.argsort(keys)
    in_order = keys[order]
    new = np.zeros(len(keys), bool)
    np.not_equal(in_order[1:], in_order[:-1], out=new[1:])
    del in_order
    rank = np.empty(len(keys), np.int32)
    rank[order] = np.cumsum(new, dtype=np.int32)
    return rank


def suffix_ranks(data: np.ndarray, length: int) -> np.ndarray:
    """The rank of every suffix among all, by its first `length` bytes (at least 8): equal there, equal rank."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    keys = np.zeros(n, np.uint64)
    for k in range(8):
        keys <<= np.uint64(8)
        keys |= padded[k : k + n]
    rank = _ranks(keys)
    done = 8
    while done < length:
        step = min(done, length - done)
        keys = rank.astype(np.int64)
        keys *= n + 1
        keys[: max(0, n - step)] += rank[step:] + 1
        rank = _ranks(keys)
        done += step
    return rank


def previous_factors(rank: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether the longest previous, and the longest later, factor of each suffix reaches the ranked length.

    In suffix order, with equal prefixes by place, the previous smaller place of
    a suffix is its neighbour within the run of its rank, if there is one, and
    the next larger place its other neighbour.
    """
    order = np.lexsort((place, rank))
    same = rank[order][1:] == rank[order][:-1]
    earlier, later = np.zeros(len(rank), bool), np.zeros(len(rank), bool)
    earlier[order[1:]] = same
    later[order[:-1]] = same
    return earlier, later


def _resolve(length: int, keep_first: bool):
    def work(table: pa.Table) -> pa.RecordBatch | None:
        body = table.column("body").combine_chunks()
        data, offsets = as_bytes(body)
        counts = np.diff(offsets) - length + 1
        rank = suffix_ranks(data, length)
        starts = ragged(offsets[:-1], counts)
        stretch = np.repeat(np.arange(len(counts)), counts)
        # The place of a class is that of its first stretch: key, text hash, position.
        mark, at = table.column("mark").to_numpy(), table.column("at").to_numpy()
        doc = table.column("doc").to_numpy()
        by_place = np.lexsort((at, mark, doc))
        order = np.empty(len(at), np.int64)
        order[by_place] = np.arange(len(at))
        place = order[stretch] * (int(counts.max()) + 1) + (starts - offsets[:-1][stretch])
        earlier, later = previous_factors(rank[starts], place)
        again = table.column("n").to_numpy()[stretch] > 1
        hit = earlier if keep_first else earlier | later | again
        at = np.flatnonzero(hit)
        if not len(at):
            return None
        owner = stretch[at]
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        last = np.concatenate([first[1:], [len(at)]]) - 1
        rows = owner[first]
        low = starts[at[first]] - offsets[rows]
        high = starts[at[last]] - offsets[rows] + length
        found = table.select(["doc", "mark", "at"]).take(pa.array(rows)).combine_chunks()
        begin = found.column("at").to_numpy()
        return pa.RecordBatch.from_arrays(
            [*[found.column(c).combine_chunks() for c in ("doc", "mark")], pa.array(begin + low), pa.array(begin + high)],
            ["doc", "mark", "low", "high"],
        )

    return lambda batches: grouped(batches, "anchor", work, max(1, WORK_BYTES // length))


def _named(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(key).cast("bigint"), F.lit(-1)).alias("doc"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("mark"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )


def repeated_intervals(
    docs: DataFrame, key: str, text: str, scratch: Scratch, length: int = LENGTH, keep_first: bool = False,
    gram: int | None = None, many: int = MANY_CLASSES,
) -> DataFrame:
    """doc, mark, low, high: byte intervals to remove, for each text (by key and text hash); they may overlap.

    The result reads tables of `scratch`."""
    gram = gram or max(1, length // 4)
    named = _named(docs, key, text)
    anchors = scratch.stage(
        named.filter(F.octet_length("text") >= length).mapInArrow(
            _anchors(length, gram),
            "anchor bigint, content bigint, lead int, more int, doc bigint, mark bigint, at bigint",
        ),
        "anchors",
    )
    same = ["anchor", "content", "lead", "more"]
    place = F.struct("doc", "mark", "at")
    classes = anchors.groupBy(*same).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
    shared = scratch.stage(classes, "stretch-classes")
    kinds = shared.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    contested = scratch.stage(shared.join(kinds, "anchor").select(*same, "n", "kinds", "first.*"), "contested")
    # A class that occurs again is repeated as a whole, but for its first place under keep_first.
    twice = shared.filter("n > 1").select(*same, "first")
    whole = anchors.join(twice, same)
    if keep_first:
        whole = whole.filter(F.struct("doc", "mark", "at") != F.col("first"))
    found = whole.select("doc", "mark", F.col("at").alias("low"), (F.col("at") + F.col("more") + length).alias("high"))
    # The other marks are those of the first stretch of each class.
    open_classes = contested if keep_first else contested.filter("n = 1")
    asked = contested.filter(F.col("kinds") <= many)
    bodies = _wanted(named, asked).mapInArrow(
        _read_stretches(length, False),
        "anchor bigint, content bigint, lead int, n bigint, at bigint, doc bigint, mark bigint, body binary",
    )
    resolved = bodies.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(
        _resolve(length, keep_first), "doc bigint, mark bigint, low bigint, high bigint"
    )
    found = found.union(resolved)
    crowded = open_classes.filter(F.col("kinds") > many)
    if crowded.limit(1).count():
        windows = scratch.stage(
            _wanted(named, contested.filter(F.col("kinds") > many)).mapInArrow(
                _read_stretches(length, True),
                "anchor bigint, content bigint, lead int, n bigint, at bigint, doc bigint, mark bigint, "
                "offset int, h1 bigint, h2 bigint",
            ),
            "windows",
        )
        same_window = windows.groupBy("anchor", "h1", "h2").agg(
            F.sum("n").alias("times"), F.min(F.struct("doc", "mark", "at", "offset")).alias("least")
        ).filter("times > 1")
        hits = windows.join(same_window, ["anchor", "h1", "h2"])
        if keep_first:
            hits = hits.filter(F.struct("doc", "mark", "at", "offset") != F.col("least"))
        found = found.union(
            hits.groupBy("doc", "mark", "at").agg(F.min("offset").alias("lo"), F.max("offset").alias("hi")).select(
                "doc", "mark", (F.col("at") + F.col("lo")).alias("low"), (F.col("at") + F.col("hi") + length).alias("high")
            )
        )
    return found


def _wanted(named: DataFrame, classes: DataFrame) -> DataFrame:
    """Each text that holds the first stretch of a class, with those stretches."""
    asked = classes.groupBy("doc", "mark").agg(
        F.collect_list(F.struct("anchor", "content", "lead", "more", "n", "at")).alias("wanted")
    )
    return named.dropDuplicates(["doc", "mark"]).join(asked, ["doc", "mark"]).select("doc", "mark", "text", "wanted")


def _merged(lists: pa.Array, size: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each row its maximal intervals: starts and ends."""
    fields = dict(zip([f.name for f in lists.type.value_type], lists.flatten().flatten()))
    low, high = fields["low"].to_numpy(), fields["high"].to_numpy()
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    ends = np.cumsum(lengths)
    out = []
    for a, b in zip(ends - lengths, ends):
        if a == b:
            out.append((np.zeros(0, np.int64), np.zeros(0, np.int64)))
            continue
        order = np.argsort(low[a:b], kind="stable")
        starts, reach = low[a:b][order], np.maximum.accumulate(high[a:b][order])
        new = np.ones(b - a, bool)
        new[1:] = starts[1:] > reach[:-1]
        first = np.flatnonzero(new)
        out.append((starts[first], reach[np.concatenate([first[1:], [b - a]]) - 1]))
    return out


def _cut(kept: list[tuple[str, str]], digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "_body")):
            rows = []
            texts = pc.fill_null(batch.column("_body"), "").cast(pa.binary())
            for text, (low, high) in zip(texts, _merged(batch.column("_cuts"), batch.num_rows)):
                body = text.as_py()
                rest = body
                if len(low):
                    edges = [0, *np.ravel(np.column_stack([low, high])).tolist(), len(body)]
                    rest = b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2]))
                rows.append((len(body), len(body) - len(rest), len(low), rest))
            sizes = [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)]
            rest = pa.array([r[3].decode("utf-8", "ignore") for r in rows], pa.string())
            digests = pa.array([hashlib.sha256(r[3]).hexdigest() if digest else None for r in rows], pa.string())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n, _ in kept], *sizes, digests, rest],
                [*[n for n, _ in kept], "_n_bytes", "_n_removed", "_n_spans", "_sha256", "_rest"],
            )

    return run


def _removed(docs: DataFrame, key: str, text: str, keep: list[str], digest: bool, **options) -> DataFrame:
    small_batches(docs.sparkSession)
    with Scratch(docs.sparkSession) as scratch:
        found = repeated_intervals(docs, key, text, scratch, **options)
        per_text = found.groupBy(F.col("doc").alias("_doc"), F.col("mark").alias("_mark"))
        cuts = stage(per_text.agg(F.collect_list(F.struct("low", "high")).alias("_cuts")), "cuts")
    plain = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        *[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)],
        plain.alias("_body"),
        F.coalesce(F.col(key).cast("bigint"), F.lit(-1)).alias("_doc"),
        F.xxhash64(plain).alias("_mark"),
    ).join(cuts, ["_doc", "_mark"], "left")
    kept = [(f"c{i}", dict(docs.dtypes)[c]) for i, c in enumerate(keep)]
    schema = ", ".join([*[f"{n} {t}" for n, t in kept], "_n_bytes bigint, _n_removed bigint, _n_spans bigint, _sha256 string, _rest string"])
    return rows.select(*[n for n, _ in kept], "_body", "_cuts").mapInArrow(_cut(kept, digest), schema)


def repeat_digests(
    docs: DataFrame, key: str = "doc_id", text: str = "text", with_text: bool = False, **options
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and the SHA-256 of the bytes that stay; `with_text`
    adds their text without characters of which only a part stays."""
    out = _removed(docs, key, text, [key], True, **options)
    return out.select(
        F.col("c0").alias("doc_id"), F.col("_n_bytes").alias("n_bytes"), F.col("_n_removed").alias("n_removed"),
        F.col("_n_spans").alias("n_spans"), F.col("_sha256").alias("kept_sha256"),
        *([F.col("_rest").alias("text")] if with_text else []),
    )


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: str | None = None, keep_first: bool = True, **options
) -> DataFrame:
    """`docs` with repeated strings cut out of their texts; rows of which nothing stays go.

    `size` names a column with the number of characters, which is brought up to
    date. Characters of which only some bytes are repeated go too.
    """
    out = _removed(docs, key, text, docs.columns, False, keep_first=keep_first, **options)
    touched = F.col("_n_removed") > 0
    columns = []
    for i, c in enumerate(docs.columns):
        value = F.col(f"c{i}")
        if c == text:
            value = F.when(touched, F.col("_rest")).otherwise(value)
        elif c == size:
            value = F.when(touched, F.length("_rest")).otherwise(value).cast(docs.schema[c].dataType)
        columns.append(value.alias(c))
    return out.filter(~touched | (F.col("_rest") != "")).select(*columns)
