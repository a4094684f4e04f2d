"""Indel similarity (0-100) of two strings as native Columns.

The longest common subsequence is computed with the published bit-vector
recurrence: one 64-bit word per pattern, one step per character of the text.
Arguments are SQL expressions, normally column names.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_BITS = 61  # keeps the recurrence's sum inside a signed 64-bit integer


def char_masks(pattern: str) -> Column:
    """map<char, bigint>: bit i set where the pattern has the char at i. NULL for
    patterns longer than one machine word."""
    chars = f"split({pattern}, '')"
    bits = f"transform({chars}, (d, i) -> if(c = d, shiftleft(1L, i), 0L))"
    mask = f"aggregate({bits}, 0L, (acc, bit) -> acc | bit)"
    entries = f"transform(array_distinct({chars}), c -> struct(c, {mask}))"
    return F.expr(f"if(length({pattern}) <= {WORD_BITS}, map_from_entries({entries}), NULL)")


def _lcs_bits(text: str, pattern: str, masks: str) -> str:
    full = f"(shiftleft(1L, length({pattern})) - 1L)"
    steps = f"transform(split({text}, ''), c -> coalesce(try_element_at({masks}, c), 0L))"
    state = f"aggregate({steps}, {full}, (s, m) -> ((s + (s & m)) | (s - (s & m))) & {full})"
    return f"length({pattern}) - bit_count({state})"


def _lcs_rows(text: str, pattern: str) -> str:
    """Row-by-row recurrence for patterns beyond one machine word."""
    cell = (
        f"if(element_at(split({pattern}, ''), j) = c, element_at(row, j) + 1, "
        "greatest(element_at(row, j + 1), element_at(new, -1)))"
    )
    next_row = (
        f"aggregate(sequence(1, length({pattern})), array(0), (new, j) -> array_append(new, {cell}))"
    )
    first = f"array_repeat(0, length({pattern}) + 1)"
    return f"element_at(aggregate(split({text}, ''), {first}, (row, c) -> {next_row}), -1)"


def lcs_length(text: str, pattern: str, masks: str) -> Column:
    """Length of the longest common subsequence; `masks` holds `char_masks(pattern)`."""
    return F.expr(
        f"CASE WHEN length({text}) = 0 OR length({pattern}) = 0 THEN 0 "
        f"WHEN length({pattern}) <= {WORD_BITS} THEN {_lcs_bits(text, pattern, masks)} "
        f"ELSE {_lcs_rows(text, pattern)} END"
    )


def percent(distance: Column, total: Column) -> Column:
    """100 for distance 0, falling to 0 at `total`; 100 when both are empty."""
    return F.when(total == 0, F.lit(100.0)).otherwise(F.lit(100.0) - F.lit(100.0) * distance / total)


def indel_ratio(text: str, pattern: str, masks: str) -> Column:
    total = F.length(F.col(text)) + F.length(F.col(pattern))
    return percent(total - 2 * lcs_length(text, pattern, masks), total)
