import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from ledgermill.functions import keys, parsing, text
from tests import plain


def column(spark, values, build):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r.o for r in df.select("i", build(F.col("v")).alias("o")).orderBy("i").collect()]


def test_dates(spark):
    values = ["2025-04-25", " 2025-04-25 ", "2025-13-01", "2025-4-5", "aaaa-bb-cc", None, "", "25-04-2025", "2025/04/25", "2025-02-30", "12025-01-01"]
    day = datetime.date(2025, 4, 25)
    assert column(spark, values, parsing.lenient_date) == [day, day] + [None] * 9
    assert column(spark, values, parsing.exact_date) == [day] + [None] * 10
    real = column(spark, values, parsing.is_real_date)
    assert real == [True, True, False, True] + [False] * 7


def test_numbers(spark):
    values = ["-1 234 567,895", "1 000,5", "", " ", None, "abc", "12.5", "99999999999999999,00"]
    amounts = column(spark, values, parsing.locale_decimal)
    assert [None if a is None else str(a) for a in amounts] == [
        "-1234567.90", "1000.50", None, None, None, None, "12.50", None,
    ]
    assert column(spark, ["-1 234,5", "x"], parsing.locale_double) == [-1234.5, None]
    assert column(spark, ["'PL00 11'", None], parsing.clean_identifier) == ["PL0011", None]
    assert column(spark, [" AbĆ  "], parsing.tidy_lower) == ["abć"]


@pytest.mark.parametrize(
    "raw, cleaned",
    [
        ("Acme sp. z o.o.", "acme"),
        ("Foo GmbH", "foo"),
        ("Acme 30-000 Krakow", "acme"),
        ("Acme Krakow POL", "acme"),
        ("Foo Warszawa", "foo"),
        ("a    b", "a b"),
        ("kraków x", "x"),
        ("Łódź", "lodz"),
        ("sklep www.abc.pl/x y", "sklep y"),
        ("tel +48 600 700 800 sklep", "tel sklep"),
        ("sklep ul. Długa 5 Gdynia", "sklep"),
        ("éal x", "eal x"),
        ("", ""),
        (None, ""),
    ],
)
def test_clean_name(spark, raw, cleaned):
    assert column(spark, [raw], text.clean_name) == [cleaned]


def test_cleaning_agrees_with_unicode_aware_patterns(spark):
    """The same patterns under Python's own `re`, whose classes are Unicode-aware."""
    rng = random.Random(5)
    parts = [
        "acme", "sp. z o.o.", "s.a.", "SP J", "a/s", "GmbH", "ltd", "inc.", "30-001", "12345", "123456", "kraków",
        "Krakowa", "POZNAŃ", "issy-les-moul", "frankfurt am main", "ul.", "al", "al.", "street", "via", "éal", "viaé",
        "+48 123 456 789", "1234567", "12 34", "a.pl", "x.com/y", ".com", "é.de", "pol", "PL", "n", "de", "fra", "usa",
        "żółw", "ß", "²", "ﬁn", "x\ny", " ", " ", "  ", "-", ",", ".", "ул", "한글", "ſ.a.", "inc",
    ]
    samples = [rng.choice(["", " ", "x"]).join(rng.choices(parts, k=rng.randint(1, 7))) for _ in range(400)]
    samples += [" ".join(rng.choices(parts, k=rng.randint(1, 9))) for _ in range(1200)]
    space = r"\s"
    legal, cities, codes = ("|".join(v).replace(text.SPACE, space) for v in (text.LEGAL_FORMS, text.CITIES, text.COUNTRY_CODES))
    patterns = [
        rf"\S+\.({'|'.join(text.URL_ENDINGS)})\S*",
        r"[+\d][\d\s]{6,}",
        rf"\b({'|'.join(text.STREET_MARKERS)})\s+.*$",
        rf"\b({legal})\b",
        r"\b\d{2}-\d{3}\b|\b\d{5}\b",
        rf"\b({cities})\b",
        rf"\s+\b({codes})\b\s*$",
    ]
    compiled = [re.compile(p, re.IGNORECASE) for p in patterns]

    def clean(value):
        value = value.lower()
        for p in compiled:
            value = p.sub(" ", value)
        return re.sub(r"\s+", " ", plain.strip_marks(value)).strip(" ,.-")

    assert column(spark, samples, text.clean_name) == [clean(s) for s in samples]


def test_strip_diacritics_is_the_compatibility_decomposition(spark):
    rng = random.Random(1)
    pool = [chr(c) for c in range(0x20, 0x3100)] + [chr(c) for c in range(0xAC00, 0xD7A4, 7)]
    pool += [chr(c) for c in range(0xF900, 0xFFFE)] + [chr(c) for c in range(0x1D400, 0x1D7FF)]
    samples = ["".join(rng.choices(pool, k=rng.randint(0, 30))) for _ in range(1500)]
    samples += ["".join(rng.choices("aąćęłńóśźż éß½ĳŁ ", k=20)) for _ in range(300)]
    assert column(spark, samples, text.strip_diacritics) == [plain.strip_marks(s) for s in samples]


def test_tokens(spark):
    values = ["ikea,  Spłata x_1 ²", "a a b"]
    assert column(spark, values, text.word_tokens) == [re.findall(r"\w+", v.lower()) for v in values]
    assert [set(t) for t in column(spark, values, text.blank_tokens)] == [set(v.split()) for v in values]


def test_keys(spark):
    assert column(spark, ["2025-01-09"], lambda c: keys.date_key(c.cast("date"))) == [20250109]
    names = column(spark, ["ikea", "ikea", "lidl", ""], keys.name_key)
    assert names[0] == names[1] != names[2] and len(names[0]) == 16 and names[3] == "unknown"
    pairs = [
        ("Food", "Groceries", "food_groceries"),
        ("Food", "Food Misc", "food_misc"),
        ("Transport", "Taxi/Rideshare", "transport_taxi_rideshare"),
        ("Health", "Dental/Vision", "health_dental_vision"),
        ("X", "Foo Bar", "x_foo_bar"),
        ("X", "Foo/Bar", "x_foo_bar"),
    ]
    df = spark.createDataFrame(pairs, "c string, s string, k string")
    assert df.filter(keys.category_key(F.col("c"), F.col("s")) != F.col("k")).count() == 0


def test_blanks_are_removed_without_patterns(spark):
    odd = [" 1\xa0234,5\t", "'a b\x0b'", "\x85\u2003x", "\n\f\r", "", "a,b,c", None]
    df = spark.createDataFrame([(t,) for t in odd], "t string")
    plan = df.select(
        parsing.clean_identifier("t").alias("a"), parsing.without_blanks("t").alias("b"), parsing.locale_double("t").alias("c")
    )
    assert "regexp_replace" not in plan._jdf.queryExecution().optimizedPlan().toString()
    old = df.select(F.regexp_replace("t", r"['\s]", ""), F.regexp_replace("t", r"[\s\xa0]", ""))
    assert [(r.a, r.b) for r in plan.collect()] == [tuple(r) for r in old.collect()]
    assert [r.c for r in plan.collect()] == [1234.5] + [None] * 6


def test_plain_runs_are_not_taken_apart(spark):
    df = spark.createDataFrame([("plain words, then żółć \u2019 and \ufb01n " * 3,)], "t string")
    plan = df.select(text.strip_diacritics(F.col("t")).alias("o"))
    shown = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" in shown and "split(" not in shown
    assert plan.first().o == "plain words, then zolc \u2019 and fin " * 3
