"""Party-name cleaning and tokenising as native Columns.

Character classes are spelled out because the JVM's `\\w`, `\\s` and `\\b` differ
from the Unicode-aware meaning the patterns need.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]"
BLANKS = r"\t-\r\x1c-\x1f\x85\p{Z}"
SPACE = f"[{BLANKS}]"
NON_SPACE = f"[^{BLANKS}]"
START = f"(?<!{WORD})"  # a word boundary before what must be a word character
EDGE = rf"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"

# What counts as noise in a party name.
URL_ENDINGS = ["eu", "pl", "com", "de"]
STREET_MARKERS = [r"ul\.", r"al\.?", "street", r"str\.", "via"]
LEGAL_FORMS = [
    "spółka z ograniczoną odpowiedzialnością",
    rf"sp\.?{SPACE}*z{SPACE}*o\.?{SPACE}*o\.?",
    r"s\.?a\.?",
    rf"sp\.?{SPACE}*[jk]\.?",
    "a/s",
    "gmbh",
    "ltd",
    "inc",
    "llc",
]
CITIES = [
    "krak[oó]w[a]?",
    "warsaw",
    "warszawa",
    "katowice",
    "sopot",
    "balice",
    "pozna[ńn]",
    "frankfurt am main",
    "copenhagen",
    "amsterdam",
    "issy-les-moul",
    "issy-les-",
]
COUNTRY_CODES = ["pol", "pl", "po", "fra", "usa", "de", "n"]
TRIMMED = " ,.-"


def _any(options: list[str]) -> str:
    return "(?:" + "|".join(options) + ")"


# Ordered: each pattern sees the text the previous one left. Every pattern opens
# with a plain check of one character, so that most positions fail at once. The
# URL pattern is anchored to the start of its run of non-blanks and the country
# pattern takes its blanks possessively, so both stay linear on very long runs.
# `(?d)`: only a line feed ends a line.
NOISE = [
    rf"(?<!{NON_SPACE}){NON_SPACE}+\.{_any(URL_ENDINGS)}{NON_SPACE}*",
    rf"[+\p{{Nd}}][\p{{Nd}}{BLANKS}]{{6,}}",
    rf"(?d)(?=[uasv]){START}{_any(STREET_MARKERS)}{SPACE}+.*$",
    rf"(?=[sagli]){START}{_any(LEGAL_FORMS)}{EDGE}",
    rf"(?=\p{{Nd}}){START}\p{{Nd}}{{2}}(?:-\p{{Nd}}{{3}}|\p{{Nd}}{{3}}){EDGE}",
    rf"(?=[kwsbpfcai]){START}{_any(CITIES)}{EDGE}",
    rf"(?d)(?<!{SPACE}){SPACE}++{_any(COUNTRY_CODES)}{EDGE}{SPACE}*$",
]

HANGUL = range(0xAC00, 0xD7A4)
SURROGATES = range(0xD800, 0xE000)
LATIN_END = 0x24F


@cache
def _foldings() -> tuple[dict[str, str], dict[str, str]]:
    """Base letters per character, from the Unicode compatibility decomposition:
    (characters folding to at most one character, characters folding to several)."""
    short, long = {"ł": "l", "Ł": "L"}, {}
    for code in range(0x80, 0x30000):
        if code in HANGUL or code in SURROGATES:
            continue
        char = chr(code)
        base = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        if base == char:
            continue
        (short if len(base) <= 1 else long)[char] = base
    return short, long


def _hangul_parts(char: Column) -> Column:
    """Leading consonant, vowel and optional final of one syllable block."""
    index = F.ascii(char) - HANGUL.start
    parts = [
        ("".join(map(chr, range(0x1100, 0x1113))), F.floor(index / 588)),
        ("".join(map(chr, range(0x1161, 0x1176))), F.floor(index % 588 / 28)),
        (" " + "".join(map(chr, range(0x11A8, 0x11C3))), index % 28),
    ]
    letters = [F.substring(F.lit(table), at.cast("int") + 1, F.lit(1)) for table, at in parts]
    return F.concat(letters[0], letters[1], F.trim(letters[2]))


def _spread(char: Column, long: dict[str, str]) -> Column:
    """The several characters one character folds to, or the character itself."""
    letters = []
    for at in range(max(map(len, long.values()))):
        kept = [c for c, base in long.items() if len(base) > at]
        ended = [c for c, base in long.items() if len(base) <= at]
        letters.append(F.translate(char, "".join(kept + ended), "".join(long[c][at] for c in kept)))
    return F.when(F.translate(char, "".join(long), "") == "", F.concat(*letters)).otherwise(char)


def strip_diacritics(value: Column) -> Column:
    """Compatibility-decomposed text without its combining marks, and ł as l."""
    # The one-element array makes Spark evaluate `value` once, not per reference.
    return F.transform(F.array(value), _without_marks)[0]


def _without_marks(value: Column) -> Column:
    short, long = _foldings()
    kept = [c for c, base in short.items() if base]
    dropped = [c for c, base in short.items() if not base]
    latin = "".join(c for c in long if ord(c) <= LATIN_END)
    # Runs of ASCII stay, runs of other Latin letters fold letter by letter, the rest is taken apart by characters.
    runs = rf"(?s)([\x00-\x7f]+|[\x80-\x{{{LATIN_END:x}}}&&[^{latin}]]+|.)"

    def base(letters: Column, last: int) -> Column:
        of, gone = [c for c in kept if ord(c) <= last], [c for c in dropped if ord(c) <= last]
        return F.translate(letters, "".join(of + gone), "".join(short[c] for c in of))

    def folded(run: Column) -> Column:
        parts = F.when(run.between(chr(HANGUL.start), chr(HANGUL.stop - 1)), _hangul_parts(run))
        several = parts.otherwise(_spread(run, long))
        letters = F.when((run < chr(LATIN_END + 1)) & ~F.contains(F.lit(latin), run), base(run, LATIN_END))
        return F.when(run < "\x80", run).otherwise(letters.otherwise(base(several, sys.maxunicode)))

    pieces = F.transform(F.regexp_extract_all(value, F.lit(runs), F.lit(1)), folded)
    return F.when(value.rlike(r"[^\x00-\x7f]"), F.array_join(pieces, "")).otherwise(value)


def clean_name(value: Column | str) -> Column:
    """Lowercased name without URLs, phones, addresses, legal forms, postal codes,
    cities, country tails and diacritics; NULL becomes the empty string."""
    text = F.lower(F.coalesce(F.col(value) if isinstance(value, str) else value, F.lit("")))
    text = F.replace(text, F.lit("ſ"), F.lit("s"))  # the one lowercase letter that also reads as another
    for pattern in NOISE:
        text = F.regexp_replace(text, pattern, " ")
    return F.btrim(F.regexp_replace(strip_diacritics(text), f"{SPACE}+", " "), F.lit(TRIMMED))


def blank_tokens(text: Column) -> Column:
    """Distinct blank-separated tokens."""
    return F.array_distinct(F.filter(F.split(text, f"{SPACE}+"), lambda t: t != ""))


def word_tokens(text: Column) -> Column:
    """Runs of letters, digits and underscores of the lowercased text, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD}+)"), F.lit(1))
