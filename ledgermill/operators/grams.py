"""Candidates for similar strings from combinations of rare character pairs.

A string is taken as the bag of the two-character grams of itself between two
blanks, repeats numbered. Every inserted or deleted character costs at most three
grams of the two bags together, so strings of `m` and `n` characters whose indel
ratio reaches the cutoff share `least_shared` grams or more. Grams have one global
order, those that few keywords hold first. Two bags that share `t` grams share `k`
among the first `size - t + k` of each (`k` up to `t`); every combination of `k` of
those is a key, so similar strings always meet in a key, and strings that share a
frequent ending or syllable only do not. Strings up to `SHORT` characters and all
that can be similar to them use `k = 3` where they must share that many, longer
ones, and those that need not, `k = 2`; in between both.

No gram of a text of words separated by single blanks spans two words, so the bag
does not depend on the order of the words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHORT = 10
_ASCII = 128


def _let(value: Column, body) -> Column:
    """`body` of `value`, which is computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _grams(string: Column) -> Column:
    padded = F.concat(F.lit(" "), string, F.lit(" "))
    return _let(padded, lambda p: F.transform(F.sequence(F.lit(1), F.length(p) - 1), lambda at: F.substr(p, at, F.lit(2))))


def _code(gram: Column) -> Column:
    """A number of a gram of two ASCII characters, else null."""
    first, second = F.ascii(gram), F.ascii(F.substr(gram, F.lit(2)))
    return F.when((first < _ASCII) & (second < _ASCII), first * _ASCII + second)


def gram_counts(keywords: DataFrame) -> list[int]:
    """How many keywords hold each gram of two ASCII characters, by its number.

    At most 128 * 128 numbers, whatever the vocabulary; other grams count as rarest."""
    held = keywords.select(F.explode(F.array_distinct(F.transform(_grams(F.col("keyword")), _code))).alias("code"))
    counts = [0] * _ASCII**2
    for code, n in held.filter("code IS NOT NULL").groupBy("code").count().collect():
        counts[code] = n
    return counts


def least_shared(length: Column, cutoff: int) -> Column:
    """Grams that a string of this length shares at least with any whose ratio reaches the cutoff."""
    shortest = F.ceil(length * cutoff / (200 - cutoff))
    return F.greatest(F.lit(2), 1 + F.ceil((length + shortest) * (3 * cutoff - 200) / 200.0 - 1e-9)).cast("int")


def gram_keys(string: Column, counts: list[int], cutoff: int) -> Column:
    """The keys of a string, in an array."""
    by_code = F.split(F.lit(",".join(map(str, counts))), ",").cast("array<int>")  # folded to one literal

    def numbered(grams: Column) -> Column:
        def one(gram: Column, at: Column) -> Column:
            again = F.size(F.filter(F.slice(grams, F.lit(1), at + 1), lambda x: x == gram))
            held = F.coalesce(F.get(by_code, _code(gram)), F.lit(0))
            return F.struct(held.alias("held"), F.concat(gram, again.cast("string")).alias("gram"))

        return F.array_sort(F.transform(grams, one))

    def combined(first: Column, k: int, head: Column | None = None) -> Column:
        """All combinations of `k` grams in their order, each after `head`."""

        def with_next(x: Column, at: Column) -> Column:
            text = x["gram"] if head is None else F.concat(head, x["gram"])
            return F.array(text) if k == 1 else combined(F.slice(first, at + 2, F.size(first)), k - 1, text)

        return F.flatten(F.transform(first, with_next))

    n = F.length(string)
    shared = least_shared(n, cutoff)
    threes = F.when(n * cutoff <= SHORT * (200 - cutoff), n + 1 - F.greatest(shared, F.lit(3)) + 3).otherwise(0)
    twos = F.when((n > SHORT) | (shared == 2), n + 1 - shared + 2).otherwise(0)

    def keys(ordered: Column, size: Column, k: int) -> Column:
        return _let(F.slice(ordered, F.lit(1), F.greatest(size, F.lit(0))), lambda first: combined(first, k))

    return _let(_let(_grams(string), numbered), lambda ordered: F.concat(keys(ordered, threes, 3), keys(ordered, twos, 2)))


def char_signature(string: str) -> Column:
    """How often a string holds each of 21 classes of characters, up to three times, a bit each.

    An inserted or deleted character changes one bit at most, so the bits in which two
    signatures differ are no more than the indel distance, in whatever order words stand."""
    at = "pmod(ascii(c), 21) * 3"
    once_more = f"((shiftright(held, {at}) & 7) * 2 | 1) & 7"
    return F.expr(f"aggregate(split({string}, ''), 0L, (held, c) -> held | shiftleft({once_more}, {at}))")


def lengths_fit(n: str, m: str, cutoff: int) -> Column:
    """Whether strings of these lengths can reach the cutoff at all."""
    return F.expr(f"abs({n} - {m}) * 100 <= ({n} + {m}) * {100 - cutoff}")
