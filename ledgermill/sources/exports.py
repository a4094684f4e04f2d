"""Distributed reading of semicolon-separated transaction exports.

An export has a free-form preamble (one line of which declares the number of
transactions), a header line, data rows and a footer. Files are read by line and
split like any text input, so one very large file spreads over many tasks. A
line is identified by (path, block, seq): the byte its split starts at and its
order within the split. The lines are written once, which fixes these positions
for every later step.
"""

from __future__ import annotations

import codecs
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgermill.functions.text import SPACE
from ledgermill.operators.vocabulary import examples
from ledgermill.scale import attach, stage

DELIMITER = ";"
FALLBACK_CHARSET = "cp1250"
HASH_LINES = 10_000

# Marker texts of the header line and of the declared row count.
HEADER_MARKER = "data transakcji"
COUNT_MARKER = "liczba transakcji"

# Export header to column name. The repeated currency header is
# told apart by the suffix header normalisation gives it.
COLUMN_OF_HEADER = {
    "Data transakcji": "transaction_date",
    "Data księgowania": "posting_date",
    "Dane kontrahenta": "counterparty_details",
    "Tytuł": "description",
    "Nr rachunku": "account_number",
    "Nazwa banku": "bank_name",
    "Szczegóły": "details",
    "Nr transakcji": "transaction_id",
    "Kwota transakcji (waluta rachunku)": "transaction_amount",
    "Waluta": "transaction_currency",
    "Kwota blokady/zwolnienie blokady": "blocked_amount",
    "Waluta_1": "blocked_currency",
    "Kwota płatności w walucie": "foreign_payment_amount",
    "Waluta_2": "foreign_payment_currency",
    "Konto": "account",
    "Saldo po transakcji": "balance_after_transaction",
    "Waluta_3": "balance_currency",
}
OPTIONAL_COLUMNS = ["balance_after_transaction", "balance_currency"]
BUSINESS_COLUMNS = list(COLUMN_OF_HEADER.values())
PROVENANCE_COLUMNS = ["_source_file", "_ingested_at", "_hash"]
POSITION_COLUMNS = ["_line_block", "_line_seq"]


class IngestError(ValueError):
    pass


@dataclass(frozen=True)
class Export:
    """`rows`: all-text rows of the accepted files. `files`: one row per file
    (path, source_file, declared, charset, accepted, reason)."""

    rows: DataFrame
    files: DataFrame

    def quarantine(self) -> DataFrame:
        return self.files.filter(~F.col("accepted")).select("source_file", "reason")

    def declared_total(self) -> DataFrame:
        return self.files.filter("accepted").agg(F.sum("declared").alias("declared"))


def scan_lines(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """Every line of the matching files, as `stage_lines` writes them."""
    staged = _staged_scan(spark.read.option("pathGlobFilter", pattern).text(folder))
    if staged.isEmpty():
        raise IngestError(f"no lines in {pattern} under {folder}")
    return staged


def lines_of(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Every line of the named files, as `stage_lines` writes them."""
    return _staged_scan(spark.read.text(list(paths)))


def _staged_scan(scanned: DataFrame) -> DataFrame:
    lines = scanned.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("value").cast("binary").alias("raw"),
    )
    return stage_lines(lines)


def stage_lines(lines: DataFrame) -> DataFrame:
    """The lines written once, with what later steps need to know of each: whether
    it is UTF-8, holds a marker, leaves a quoted cell open (if none was open before,
    and if one was), and its number of cells (0 for an empty line). All of it is ASCII, so the charset does not matter yet,
    and later steps read these few columns instead of the lines."""
    text = _latin(F.col("raw"))
    plain = F.translate(F.lower(text), '":', "")
    return stage(
        lines.select(
            *("path", "source_file", "block", "seq", "raw"),
            F.is_valid_utf8("raw").alias("utf8"),
            F.contains(plain, F.lit(HEADER_MARKER)).alias("is_header"),
            F.contains(plain, F.lit(COUNT_MARKER)).alias("is_count"),
            _opens(text).alias("opens"),
            _stays_open(text).alias("stays"),
            F.when(F.length("raw") == 0, F.lit(0)).otherwise(_width(text)).alias("width"),
        ),
        "lines",
    )


def file_hashes(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """(path, hash): SHA-256 over the SHA-256s of the file's groups of `HASH_LINES` lines.

    A group's hash is taken over the hashes of its lines, in order. Lines end at
    line feeds, so a carriage return counts as content; only a line feed at the
    very end does not. The definition is the same for every size and every split
    setting, and no file has to pass through one task.
    """
    return _hashes(spark.read.option("pathGlobFilter", pattern).option("lineSep", "\n").text(folder))


def hashes_of(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """`file_hashes` of the named files."""
    return _hashes(spark.read.option("lineSep", "\n").text(list(paths)))


def _hashes(scanned: DataFrame) -> DataFrame:
    lines = stage(
        scanned.select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("seq"),
            F.sha2(F.col("value").cast("binary"), 256).alias("digest"),
        ),
        "line-digests",
    )
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy("path", "block").agg(F.count(F.lit(1)).alias("n"))
    splits = splits.select("path", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("path", "block").orderBy("seq"))
    numbered = lines.withColumn("at", within - 1).join(splits, ["path", "block"])
    number = F.col("before") + F.col("at")

    def in_order(at: Column, digest: str) -> Column:
        listed = F.array_sort(F.collect_list(F.struct(at.alias("at"), F.col(digest).alias("digest"))))
        return F.sha2(F.array_join(listed["digest"], ""), 256)

    groups = numbered.groupBy("path", F.floor(number / HASH_LINES).alias("group")).agg(
        in_order(number, "digest").alias("digest")
    )
    return groups.groupBy("path").agg(in_order(F.col("group"), "digest").alias("hash"))


def _latin(raw: Column) -> Column:
    return F.decode(raw, "ISO-8859-1")


def decode(raw: Column, charset: Column, fallback: str = FALLBACK_CHARSET) -> Column:
    """Text of a line: UTF-8 where its file is UTF-8, else the one-byte `fallback`."""
    high = bytes(range(0x80, 0x100))
    table = codecs.decode(high, fallback, errors="replace")
    if len(table) != len(high):
        raise ValueError(f"{fallback} is not a one-byte character set")
    one_byte = F.translate(_latin(raw), high.decode("latin-1"), table)
    utf8 = F.regexp_replace(raw.cast("string"), "^\ufeff", "")
    return F.when(charset == "utf-8", utf8).otherwise(one_byte)


def _label(cell: Column) -> Column:
    """Header text of a cell: outer blanks, quotes and colons removed."""
    return F.translate(F.regexp_replace(cell, f"^{SPACE}+|{SPACE}+$", ""), '":', "")


def header_names(header: Column) -> Column:
    """Unique column names of a header line.

    Empty cells become column_1, column_2, ...; a repeated name takes the next
    free suffix: name, name_1, name_2, ...
    """
    cells = F.transform(F.split(header, DELIMITER), _label)

    def name(taken: Column, blanks: Column, cell: Column) -> Column:
        suffixed = F.transform(
            F.sequence(F.lit(1), F.size(taken) + 1),
            lambda k: F.concat(cell, F.lit("_"), k.cast("string")),
        )
        free = F.element_at(F.array_except(suffixed, taken), 1)
        return (
            F.when(cell == "", F.concat(F.lit("column_"), (blanks + 1).cast("string")))
            .when(~F.array_contains(taken, cell), cell)
            .otherwise(free)
        )

    start = F.struct(F.array().cast("array<string>").alias("names"), F.lit(0).alias("blanks"))
    return F.aggregate(
        cells,
        start,
        lambda acc, cell: F.struct(
            F.array_append(acc["names"], name(acc["names"], acc["blanks"], cell)).alias("names"),
            (acc["blanks"] + (cell == "").cast("int")).alias("blanks"),
        ),
        lambda acc: acc["names"],
    )


def profile_files(lines: DataFrame, fallback: str = FALLBACK_CHARSET) -> DataFrame:
    """One row per file: charset, header position and names, declared row count."""
    files = lines.groupBy("path", "source_file").agg(F.bool_and("utf8").alias("utf8"))
    cells = F.split(_latin(F.col("raw")), DELIMITER)
    labels = F.transform(cells, lambda c: F.contains(F.lower(_label(c)), F.lit(COUNT_MARKER)))
    declared = F.try_element_at(cells, F.array_position(labels, True).cast("int") + 1)
    marked = lines.filter("is_header or is_count").select(
        "path",
        "raw",
        F.when(F.col("is_header"), F.struct("block", "seq")).alias("header_at"),
        F.when(F.col("is_count") & (declared != ""), F.struct("block", "seq")).alias("count_at"),
        F.when(F.col("is_count"), declared).alias("declared"),
    )
    found = marked.groupBy("path").agg(
        F.min("header_at").alias("header_at"),
        F.min_by("raw", "header_at").alias("header_raw"),
        F.min_by("declared", "count_at").alias("declared_text"),
    )
    found = files.join(found, "path", "left")
    charset = F.when(F.col("utf8"), F.lit("utf-8")).otherwise(F.lit(fallback))
    named = found.withColumn("charset", charset).withColumn(
        "names", header_names(decode(F.col("header_raw"), F.col("charset"), fallback))
    )
    positions = F.array(
        *[F.coalesce(F.array_position("names", F.lit(h)), F.lit(0)).cast("int") for h in COLUMN_OF_HEADER]
    )
    required = [h for h, c in COLUMN_OF_HEADER.items() if c not in OPTIONAL_COLUMNS]
    optional = [h for h, c in COLUMN_OF_HEADER.items() if c in OPTIONAL_COLUMNS]
    return named.select(
        "path",
        "source_file",
        "charset",
        "header_at",
        "names",
        positions.alias("positions"),
        F.array_except(F.array(*map(F.lit, required)), "names").alias("missing"),
        F.array_except(F.array(*map(F.lit, optional)), "names").alias("absent"),
        "declared_text",
        F.trim("declared_text").try_cast("bigint").alias("declared"),
    )


_TO_CLOSING = f'(?:[^"]|"")*+"(?=[ \\t\\r]*(?:{DELIMITER}|$))'


def _bare(text: Column) -> Column:
    """The text without its complete quoted cells. A quote opens a cell only as its first
    character and closes it only as its last; two quotes within it stand for one. A
    cell with a lone quote inside never closes, so its file is rejected, not guessed at."""
    return F.regexp_replace(text, f'(?<![^{DELIMITER}])"{_TO_CLOSING}', "")


def _opens(text: Column) -> Column:
    """Whether a line that begins outside quotes ends inside a quoted cell."""
    return _bare(text).rlike(f'(?<![^{DELIMITER}])"')


def _stays_open(text: Column) -> Column:
    """Whether a line that begins inside a quoted cell ends inside one."""
    rest = F.regexp_replace(text, f"^{_TO_CLOSING}", "x")  # what follows the closing quote is no start of a cell
    return F.when(text.rlike(f"^{_TO_CLOSING}"), _opens(rest)).otherwise(F.lit(True))


def _width(text: Column) -> Column:
    """Number of cells, not counting delimiters inside quoted cells."""
    return F.regexp_count(_bare(text), F.lit(DELIMITER)) + 1


def body_lines(lines: DataFrame, heads: DataFrame) -> DataFrame:
    """The non-empty lines after the header of the files in `heads`, which has (path,
    header_at) and whatever else the lines should carry."""
    joined = attach(lines.drop("source_file"), heads, ["path"], "inner", spread=["block", "seq"])
    return joined.filter((F.struct("block", "seq") > F.col("header_at")) & (F.col("width") > 0)).drop("header_at")


def _inside_before(rows: DataFrame, within: list[str], order: str) -> DataFrame:
    """`rows` with `fixed`, whether a quote is open before each row if an earlier row of
    its group settles that (else NULL), and `flips`, how often the state turned since.

    Each row has `opens` and `stays`: the state after it from either state before.
    Rows where both agree settle the state, rows where they contradict turn it.
    """
    settles, turns = F.col("opens") == F.col("stays"), F.col("opens") & ~F.col("stays")
    so_far = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    counted = rows.withColumn("_turns", F.sum(turns.cast("long")).over(so_far))
    last = F.last(F.when(settles, F.struct("opens", "_turns")), ignorenulls=True).over(earlier)
    before = F.coalesce(F.max("_turns").over(earlier), F.lit(0))
    return counted.select(
        *rows.columns,
        last["opens"].alias("fixed"),
        (before - F.coalesce(last["_turns"], F.lit(0))).alias("flips"),
    )


def _turned(state: Column, flips: Column) -> Column:
    return state != (flips % 2 == 1)


def quote_states(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lines with `inside`, whether a quoted cell is open before them, and (path,
    closed) of the files: whether none is open at their end.

    The state is found within each split, then over the splits of a file, so no
    file has to pass through one task.
    """
    known = _inside_before(lines, ["path", "block"], "seq")
    after = F.when(F.col("opens") == F.col("stays"), F.col("opens"))
    turns = (F.col("opens") & ~F.col("stays")).cast("long")
    ends = known.groupBy("path", "block").agg(
        F.max_by(F.struct(F.coalesce(after, _turned(F.col("fixed"), F.col("flips") + turns)).alias("state")), "seq")["state"].alias("settled"),
        F.max_by(F.col("flips") + turns, "seq").alias("turned"),
    )
    # A split is a line writ large: the state after it from either state before.
    odd = F.col("turned") % 2 == 1
    splits = ends.select(
        "path", "block", F.coalesce("settled", odd).alias("opens"), F.coalesce("settled", ~odd).alias("stays")
    )
    splits = _inside_before(splits, ["path"], "block")
    splits = splits.withColumn("begins", _turned(F.coalesce("fixed", F.lit(False)), F.col("flips")))
    ended = F.when(F.col("begins"), F.col("stays")).otherwise(F.col("opens"))
    files = splits.groupBy("path").agg((~F.max_by(ended, "block")).alias("closed"))
    begins = splits.select("path", "block", "begins")
    inside = _turned(F.coalesce("fixed", "begins"), F.col("flips"))
    return known.join(begins, ["path", "block"]).withColumn("inside", inside).drop("fixed", "flips", "begins"), files


def join_broken_records(lines: DataFrame) -> DataFrame:
    """(path, block, seq, line): the records of lines that carry `inside`, where quoted
    cells may span lines. Only lines of one record meet."""
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    in_split = Window.partitionBy("path", "block").orderBy("seq")
    start_at = F.when(~F.col("inside"), F.struct("block", "seq"))
    opened = lines.withColumn("start", F.max(start_at).over(in_split))
    # A record may begin in an earlier split than the one its line is in.
    last_start = opened.groupBy("path", "block").agg(F.max("start").alias("last"))
    carried = last_start.select("path", "block", F.max("last").over(earlier).alias("carried"))
    opened = opened.join(carried, ["path", "block"]).withColumn("start", F.coalesce("start", "carried"))
    records = opened.groupBy("path", "start")
    return records.agg(F.array_sort(F.collect_list(F.struct("block", "seq", "line"))).alias("parts")).select(
        "path", "start.block", "start.seq", F.array_join(F.col("parts.line"), "\n").alias("line")
    )


def shaped_files(lines: DataFrame) -> DataFrame:
    """(path, width, broken) of the body lines: the most cells in a line, and
    whether any line leaves a quoted cell open, so that a cell spans lines."""
    return lines.groupBy("path").agg(F.max("width").alias("width"), F.bool_or("opens").alias("broken"))


def repaired_records(lines: DataFrame, fallback: str = FALLBACK_CHARSET) -> tuple[DataFrame, DataFrame]:
    """(path, block, seq, line, width) of the body lines of broken files, and (path) of
    those that end inside a quoted cell, the sign of a stray quote. Of these no record
    is put together, as the last one could be most of the file."""
    known, files = quote_states(lines.select("path", "block", "seq", "opens", "stays", "raw", "charset"))
    known, files = stage(known, "quote-states"), stage(files, "quoted-files")
    whole = attach(known, files.filter("closed").select("path"), ["path"], "inner", spread=["block", "seq"])
    line = decode(F.col("raw"), F.col("charset"), fallback).alias("line")
    joined = join_broken_records(whole.select("path", "block", "seq", "inside", line))
    return joined.withColumn("width", _width(F.col("line"))), files.filter("not closed").select("path")


def judge_files(profile: DataFrame, shapes: DataFrame) -> DataFrame:
    """The profile with `accepted` and the `reason` for rejection; `shapes` has
    (path, width, whole)."""
    judged = profile.join(shapes, "path", "left")
    reason = (
        F.when(F.col("declared_text").isNotNull() & F.col("declared").isNull(), "row count is not a number")
        .when(F.col("header_at").isNull() | F.col("declared").isNull(), "header or row count not found")
        .when(
            F.size("missing") > 0,
            F.concat(F.lit("missing mandatory columns: "), F.array_join("missing", ", ")),
        )
        .when(~F.col("whole"), "unbalanced quotes")
        .when(F.col("width") > F.size("names"), "a row is wider than the header")
    )
    return judged.withColumn("reason", reason).withColumn("accepted", F.col("reason").isNull())


def parse_cells(lines: DataFrame, widest: int) -> DataFrame:
    """All-text rows from lines that carry their file's `positions`, `source_file` and
    `hash`. Cells are placed by each file's own header, so column order may differ
    between files; absent optional columns are NULL and unknown ones ignored."""
    schema = ", ".join(f"c{i} string" for i in range(widest))
    # A null marker no export contains keeps a quoted empty cell apart from a missing one.
    options = {"sep": DELIMITER, "quote": '"', "escape": '"', "nullValue": "\x00", "mode": "PERMISSIVE"}
    # A generator of one row parses each line once: an expression would be parsed again for every
    # cell that a later filter on a column mentions, as filters are pushed below projections.
    parsed = lines.select(*lines.drop("line").columns, F.inline(F.array(F.from_csv("line", schema, options))))
    placed = parsed.withColumn("cells", F.array(*[F.col(f"c{i}") for i in range(widest)]))
    columns = [
        F.when(F.col("positions")[i] > 0, F.try_element_at("cells", F.col("positions")[i])).alias(name)
        for i, name in enumerate(BUSINESS_COLUMNS)
    ]
    return placed.select(
        *columns,
        F.col("source_file").alias("_source_file"),
        F.lit(datetime.now(UTC)).alias("_ingested_at"),
        F.col("hash").alias("_hash"),
        F.col("block").alias("_line_block"),
        F.col("seq").alias("_line_seq"),
    )


def parse_lines(
    lines: DataFrame, hashes: DataFrame | None = None, fallback: str = FALLBACK_CHARSET
) -> Export:
    """Rows and per-file verdicts from staged lines.

    Files are judged from the marks of their lines alone; the lines themselves
    are read once more, to parse those of accepted files.
    """
    profile = stage(profile_files(lines, fallback), "profile")
    heads = profile.filter("header_at is not null").select("path", "charset", "header_at")
    body = body_lines(lines, heads)
    shapes = stage(shaped_files(body), "shapes")
    broken = shapes.filter("broken").select("path", "broken")
    sound = shapes.filter("not broken").select("path", "width", F.lit(True).alias("whole"))
    repaired = None
    if not broken.isEmpty():
        tagged = attach(body, broken, ["path"], "inner", spread=["block", "seq"])
        repaired, unclosed = repaired_records(tagged, fallback)
        repaired = stage(repaired, "repaired-records")
        sound = sound.unionByName(
            repaired.groupBy("path").agg(F.max("width").alias("width"), F.lit(True).alias("whole"))
        ).unionByName(unclosed.select("path", F.lit(None).cast("int").alias("width"), F.lit(False).alias("whole")))
    files = stage(judge_files(profile, sound), "files")
    accepted = files.filter("accepted")
    if accepted.isEmpty():
        named = files.select(F.concat_ws(": ", "source_file", "reason").alias("reason"))
        raise IngestError(f"every file was rejected: {examples(named, named.count())}")

    hashes = accepted.select("path", F.lit(None).cast("string").alias("hash")) if hashes is None else hashes
    layout = accepted.join(hashes, "path", "left").select(
        "path", "source_file", "charset", "header_at", "positions", "hash"
    )
    widest = accepted.agg(F.max(F.size("names"))).first()[0]  # one number
    kept = ["source_file", "positions", "hash", "block", "seq", "line"]
    whole_lines = body_lines(lines, layout.join(broken, "path", "left_anti"))
    records = whole_lines.withColumn("line", decode(F.col("raw"), F.col("charset"), fallback)).select(*kept)
    if repaired is not None:
        joined = attach(repaired, layout, ["path"], "inner", spread=["block", "seq"])
        records = records.unionByName(joined.select(*kept))
    return Export(parse_cells(records, widest), files)


def read_exports(
    spark: SparkSession, folder: str, pattern: str = "*.csv", fallback: str = FALLBACK_CHARSET
) -> Export:
    """Read every matching file directly under `folder`.

    A file that cannot be used is left out and listed with the reason; the
    others go on. No matching file, or none usable, is an `IngestError`. A file
    without a single line has nothing to list and is passed over.
    """
    lines = scan_lines(spark, folder, pattern)
    hashes = file_hashes(spark, folder, pattern)
    return parse_lines(lines, hashes, fallback)
