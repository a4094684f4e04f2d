"""Removal of lines that many documents share.

Texts are exploded into lines at line feeds. The key of a line is the line without
ASCII white space at both ends and with A-Z in lower case, kept as a 128-bit hash.
A key of at least `least_chars` code points that stands in at least `least_docs`
different documents is common: its lines go from every document but the largest
one that holds it, which keeps all of its own. The other lines are put together
again by their position.

Only hashes and positions of lines are shuffled. Keys that hold more than
1/`HOT_SHARE` of all lines are fewer than `HOT_SHARE`, so these are broadcast and
their lines stay where they are; lines of the other keys meet by shuffle. What a
document loses is one list of positions, bounded by the document.

Null and empty texts are one empty line. A document is a value of the key column;
rows of one value are one document, and null is a value, the smallest. Repeated
rows get equal results. Other columns are ignored; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.scale import Scratch, stage

LEAST_CHARS = 20
LEAST_DOCS = 3
HOT_SHARE = 4096

_SPACE = "\t\n\x0b\f\r "
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(_SPACE)), _UPPER, _LOWER)


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc, lines and two hashes that tell rows apart by document and text."""
    plain = F.coalesce(F.col(text), F.lit(""))
    same = (F.col(key).isNull(), F.col(key), plain)
    return docs.select(
        F.col(key).alias("doc"),
        F.xxhash64(*same).alias("row1"),
        F.xxhash64(F.lit(1), *same).alias("row2"),
        F.split(plain, "\n", -1).alias("lines"),
    )


def _lost(lines: DataFrame, scratch: Scratch, least_docs: int) -> DataFrame:
    """The lines that go: row1, row2, pos. `lines` is a written table of doc, row1, row2, pos, h1, h2."""
    total = lines.count()
    counted = lines.groupBy("h1", "h2").agg(
        F.count_distinct("doc").alias("docs"),
        F.max(F.col("doc").isNull()).alias("unnamed"),
        F.max("doc").alias("last"),
        F.count(F.lit(1)).alias("n"),
    )
    common = scratch.stage(
        counted.filter(F.col("docs") + F.col("unnamed").cast("int") >= least_docs).select("h1", "h2", "last", "n"), "common"
    )
    is_hot = F.col("n") * HOT_SHARE > total
    hot = F.broadcast(common.filter(is_hot).select("h1", "h2", "last"))  # fewer than HOT_SHARE rows
    other = common.filter(~is_hot).select("h1", "h2", "last")
    earlier = F.col("doc").isNull() | (F.col("doc") < F.col("last"))
    here = lines.join(hot, ["h1", "h2"]).filter(earlier)
    there = lines.join(hot, ["h1", "h2"], "left_anti").join(other, ["h1", "h2"]).filter(earlier)
    return here.union(there).select("row1", "row2", "pos")


def without_repeated_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS
) -> DataFrame:
    """doc_id, n_lines (before), n_dropped and the text that stays, for every row of `docs`."""
    rows = _rows(docs, key, text)
    with Scratch(docs.sparkSession) as scratch:
        each = rows.select("doc", "row1", "row2", F.posexplode("lines").alias("pos", "line"))
        keyed = each.withColumn("line", line_key("line")).filter(F.length("line") >= least_chars)
        lines = scratch.stage(
            keyed.select(
                "doc", "row1", "row2", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")
            ),
            "lines",
        )
        lost = _lost(lines, scratch, least_docs)
        per_row = stage(lost.groupBy("row1", "row2").agg(F.collect_set("pos").alias("gone")), "lost-lines")
    joined = rows.join(per_row, ["row1", "row2"], "left")
    n_lines = F.size("lines")
    stays = F.array_except(F.sequence(F.lit(0), n_lines - 1), F.coalesce("gone", F.array().cast("array<int>")))
    kept = F.transform(stays, lambda at: F.get("lines", at))
    return joined.select(
        F.col("doc").alias("doc_id"),
        n_lines.cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.array_join(F.when(F.col("gone").isNull(), F.col("lines")).otherwise(kept), "\n").alias("text"),
    )
