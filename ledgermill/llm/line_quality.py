"""Quality rules with the frequency of lines across the documents of a host.

Base figures come from each text alone: code points in words, symbols, lines
equal to an earlier line of the text, and words inside a run of three words that
the text holds twice or more.

The method then hashes every normalised line (lower case, words joined by one
space, digits as one sign) and counts in how many different texts of a host it
stands; copies of a text count once. A line in more than `LINE_DOCS` texts and
more than `LINE_SHARE` of its host's texts is common and is removed with its line feed (at the
end of a text with the one before), from the spans kept beside the hashes. A document
is depleted, and rejected, if less than `LEFT_SHARE` of its word characters stay.
`without_common_lines` returns the texts, `line_quality` the figures alone.

Counts are grouped sums over all rows; a batch sends each line once per host, so a
host with a third of all rows sends partial counts. The common lines of a host
are fewer than 1 / `LINE_SHARE` times its mean lines per text; they are broadcast
while small (measured) and else joined with salted hot hosts.

Words are maximal runs without ASCII white space, lines are split at line feeds.
Null and empty texts have no word, fail the base rule and are not kept. A null
host is a host of its own. Rows are told apart by key and text hash: repeated
rows get equal results. Other columns are ignored; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.arrays import SPACES, as_bytes, mixed, prefix_hash, slices, small_batches, span_hash, word_spans
from ledgermill.scale import attach, stage

LEAST_WORDS = 50
REPEAT_PERCENT = 50
LINE_DOCS = 20
LINE_SHARE = 0.02
LEFT_SHARE = 0.3

# The symbols that are counted.
SYMBOLS = b"#*$%&|<>"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_CONTINUES = np.zeros(256, bool)
_CONTINUES[0x80:0xC0] = True
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[ord("A") : ord("Z") + 1] += 32
_FOLDED[ord("0") : ord("9") + 1] = ord("0")


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _again(groups: np.ndarray, values: np.ndarray, later_only: bool) -> np.ndarray:
    """Whether a value occurs twice or more within its group; with `later_only` the first one does not count."""
    order = np.lexsort((values, groups))
    same = (values[order][1:] == values[order][:-1]) & (groups[order][1:] == groups[order][:-1])
    out = np.zeros(len(values), bool)
    out[order[1:]] = same
    if not later_only:
        out[order[:-1]] |= same
    return out


class TextFigures:
    """Base figures and line hashes of a run of texts, vectorised over all of them."""

    def __init__(self, texts: pa.Array):
        data, offsets = as_bytes(texts)
        n = len(offsets) - 1
        starts, ends, first = word_spans(data, offsets)
        self.n_words = np.diff(first)
        points = ~_CONTINUES[data]
        self.word_chars = _per_text(points & ~SPACES[data], offsets)
        self.n_symbols = _per_text(_SYMBOL[data], offsets)
        words = span_hash(prefix_hash(data), starts, ends)
        owner = np.repeat(np.arange(n), self.n_words)
        # Words inside a window of three that occurs again.
        in_again = np.zeros(len(words), bool)
        if len(words) >= 3:
            threes = mixed(words[:-2] * np.uint64(0x9E3779B97F4A7C15) + words[1:-1]) * np.uint64(0xD6E8FEB86659FD93) + words[2:]
            fit = np.flatnonzero(owner[:-2] == owner[2:])
            again = fit[_again(owner[fit], threes[fit], False)]
            for k in range(3):
                in_again[again + k] = True
        self.n_repeat_words = np.bincount(owner, in_again, n).astype(np.int64)
        # Lines with a word: from a text's start or a line feed to the next.
        feed = data == 10
        begins = np.zeros(len(data), bool)
        begins[offsets[:-1][offsets[:-1] < len(data)]] = True
        begins[1:] |= feed[:-1]
        line_starts = np.flatnonzero(begins)
        line_of = np.searchsorted(line_starts, starts, "right") - 1
        first_word = np.flatnonzero(np.diff(line_of, prepend=-1))
        lines = line_of[first_word]
        line_owner = owner[first_word]
        stops = np.append(line_starts[1:], len(data))[lines]
        self.line_start = line_starts[lines] - offsets[:-1][line_owner]  # bytes of the text, with the feed
        self.line_stop = stops - offsets[:-1][line_owner]
        stops = stops - ((stops > 0) & feed[np.maximum(stops - 1, 0)])
        raw = span_hash(prefix_hash(data), line_starts[lines], stops)
        self.n_dup_lines = np.bincount(line_owner, _again(line_owner, raw, True), n).astype(np.int64)
        # Normalised lines: a hash of the folded words in order, and the characters in them.
        folded = span_hash(prefix_hash(_FOLDED[data]), starts, ends)
        last_word = np.append(first_word[1:], len(words))
        within = np.arange(len(words)) - np.repeat(first_word, last_word - first_word)
        spread = mixed(folded + within.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(spread, out=sums[1:])
        self.line_hash = (sums[last_word] - sums[first_word]).view(np.int64)
        self.line_owner = line_owner


def _figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            f = TextFigures(part.column("text"))
            lines = np.searchsorted(f.line_owner, np.arange(part.num_rows + 1))
            structs = pa.StructArray.from_arrays(
                [pa.array(f.line_hash), pa.array(f.line_start, pa.int64()), pa.array(f.line_stop, pa.int64())], ["line", "start", "stop"]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), part.column("mark"), part.column("host"), part.column("text"),
                    *[pa.array(x) for x in (f.n_words, f.word_chars, f.n_symbols, f.n_dup_lines, f.n_repeat_words)],
                    pa.ListArray.from_arrays(pa.array(lines, pa.int32()), structs),
                ],
                ["doc_id", "mark", "host", "text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines"],
            )


def cut_lines(texts: pa.Array, spans: pa.ListArray) -> pa.Array:
    """Each text without its spans (start and stop in bytes, lines with their feeds)."""
    data, offsets = as_bytes(texts)
    n = np.asarray(pc.fill_null(pc.list_value_length(spans), 0)).astype(np.int64)
    flat = spans.flatten()
    owner = np.repeat(np.arange(len(n)), n)
    starts = np.asarray(flat.field("start"), np.int64) + offsets[owner]
    stops = np.asarray(flat.field("stop"), np.int64) + offsets[owner]
    steps = np.zeros(len(data) + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, stops, -1)
    stays = np.cumsum(steps[:-1]) == 0
    # A last line has no feed of its own; the one before the first line that goes with it ends the text no more.
    ends = np.unique(owner[(stops == offsets[owner + 1]) & (data[stops - 1] != 10)])
    left = np.concatenate([[0], np.cumsum(stays)])
    ends = ends[left[offsets[ends + 1]] > left[offsets[ends]]]
    stays[np.searchsorted(left, left[offsets[ends + 1]], "left") - 1] = False
    cuts = np.concatenate([[0], np.cumsum(stays)])[offsets]
    return pa.LargeStringArray.from_buffers(len(n), pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data[stays])).cast(pa.string())


def _cut(keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = cut_lines(part.column("text"), part.column("gone"))
                data, offsets = as_bytes(texts)
                left = _per_text(~_CONTINUES[data] & ~SPACES[data], offsets)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in keep], texts, pa.array(left, pa.int64())], [*keep, "text", "left_chars"]
                )

    return run


def without_common_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source",
    line_docs: int = LINE_DOCS, line_share: float = LINE_SHARE, left_share: float = LEFT_SHARE,
) -> DataFrame:
    """The text of every row without the common lines of its host, and what `line_quality` returns."""
    small_batches(docs.sparkSession)
    named = docs.select(
        F.col(key).alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit("")).alias("host"),
    ).withColumn("mark", F.xxhash64("text"))
    kind = dict(docs.dtypes)[key]
    figures = stage(
        named.mapInArrow(
            _figures,
            f"doc_id {kind}, mark bigint, host string, text string, n_words bigint, word_chars bigint, n_symbols bigint, "
            "n_dup_lines bigint, n_repeat_words bigint, lines array<struct<line: bigint, start: bigint, stop: bigint>>",
        ),
        "line-figures",
    )
    # One row of each different text of a host stands for its copies.
    texts = figures.select("host", "mark").distinct()
    sizes = texts.groupBy("host").agg(F.count(F.lit(1)).alias("texts"))
    once = figures.dropDuplicates(["host", "mark"]).select("host", F.explode(F.array_distinct("lines.line")).alias("line"))
    counted = once.groupBy("host", "line").agg(F.count(F.lit(1)).alias("docs")).filter(F.col("docs") > line_docs)
    common = counted.join(sizes, "host").filter(F.col("docs") > F.col("texts") * line_share)
    per_host = stage(
        common.groupBy("host").agg(F.collect_set("line").alias("common")), "common-lines"
    )  # at most mean lines per text / line_share for each host
    rows = attach(figures, per_host, ["host"], spread=[F.col("doc_id"), F.col("mark")])
    gone = F.filter("lines", lambda x: F.array_contains(F.col("common"), x["line"]))
    spans = F.transform(gone, lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop")))
    kept = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    cut = rows.select(*kept, "text", F.coalesce(spans, F.array().cast("array<struct<start: bigint, stop: bigint>>")).alias("gone"))
    cut = cut.mapInArrow(
        _cut(kept),
        f"doc_id {kind}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint, text string, left_chars bigint",
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT)
    return cut.select(
        *kept, "text", failed.alias("base_failed"), "left_chars",
        (~failed & (F.col("left_chars") >= F.col("word_chars") * left_share)).alias("kept"),
    )


def line_quality(docs: DataFrame, **options) -> DataFrame:
    """The base figures of every row, base_failed, the word characters outside common lines, and kept;
    options as for `without_common_lines`."""
    return without_common_lines(docs, **options).drop("text")
