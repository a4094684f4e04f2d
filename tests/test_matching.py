import random

import pytest
from pyspark.sql import functions as F

from ledgermill.functions import similarity
from ledgermill.operators import matching, naming
from ledgermill.operators.vocabulary import (
    VocabularyError,
    keyword_labels,
    name_candidates,
    repeated_keywords,
    require_known_subcategories,
    taxonomy_frame,
    training_frame,
)
from tests import plain
from tests.samples import CATEGORIES, TRAINING

KEYWORDS = [
    "ikea", "biedronka", "costa coffee", "bp", "a", "t-mobile", "Burrhus Skinner", "ing bank",
    "ing bank śląski", "booking.com", "notino", "cursor", "bolt", "uber", "tk maxx", "circle k",
    "medical centre", "dzien dobry urząd skarbowy, daj nam swoje pieniądze", "coffee costa",
    "dzien dobry urzad skarbowy oraz ministerstwo, daj nam prosze swoje wszystkie pieniadze",
    "shell", "shelly", "apteka dr. max", "project invictus",
]


def noisy(rng, word):
    chars = list(word)
    for _ in range(rng.randint(0, 3)):
        at = rng.randint(0, len(chars))
        if rng.random() < 0.5 and chars:
            chars.pop(at - 1)
        else:
            chars.insert(at, rng.choice("abeiklmnorst ś.2"))
    return "".join(chars)


def texts():
    rng = random.Random(7)
    parts = [w for k in KEYWORDS for w in k.split()] + ["krakow", "pol", "sklep", "nr", "123", "xyz", "ul."]
    out = set(KEYWORDS) | {k.lower() for k in KEYWORDS} | {
        "ikea krakow pol", "xyz123nothing", "9999999999999999", "zzz qqq vvv", " ", "...",
        "cursor, ai powered ide cursor.co", "ikea  ikea\tikea", "bank ing xyz", "costa coffee",
    }
    for _ in range(700):
        words = [noisy(rng, rng.choice(parts)) for _ in range(rng.choice([1, 1, 2, 2, 3, 4, 6, 10]))]
        out.add(" ".join(words))
    for k in KEYWORDS:
        for _ in range(6):
            out.add(noisy(rng, k))
    return sorted(t for t in out if t)


def frames(spark):
    sample = texts()
    table = spark.createDataFrame([(t,) for t in sample], "text string").select(
        matching.text_key(F.col("text")).alias("text_id"), "text"
    )
    vocabulary = spark.createDataFrame(list(enumerate(KEYWORDS)), "pos bigint, keyword string")
    return sample, table, vocabulary


def test_lcs_matches_the_plain_recurrence(spark):
    rng = random.Random(3)
    pairs = [
        ("".join(rng.choices("abcd", k=rng.randint(0, 14))), "".join(rng.choices("abcd", k=rng.randint(0, 14))))
        for _ in range(300)
    ]
    pairs += [("".join(rng.choices("abcd", k=70)), "".join(rng.choices("abcd", k=k))) for k in (60, 61, 62, 80)]
    df = spark.createDataFrame(pairs, "a string, b string")
    masked = df.select("*", similarity.char_masks("b").alias("m"))
    got = masked.select("a", "b", similarity.lcs_length("a", "b", "m").alias("n")).collect()
    assert all(r.n == plain.lcs(r.a, r.b) for r in got)
    example = spark.createDataFrame([("xyz123nothing", "notino")], "a string, b string")
    example = example.select("*", similarity.char_masks("b").alias("m"))
    value = example.select(similarity.indel_ratio("a", "b", "m")).first()[0]
    assert round(value, 2) == 52.63


@pytest.mark.parametrize("cutoff", [75, 80, 90, 100])
def test_ratio_join_finds_every_pair(spark, cutoff):
    sample, table, vocabulary = frames(spark)
    found = matching.ratio_join(table.select(F.col("text").alias("string")), vocabulary, cutoff).distinct()
    got = {(r.string, r.pos): r.score for r in found.collect()}
    want = {}
    for t in sample:
        for pos, k in enumerate(KEYWORDS):
            score = plain.ratio(t, k)
            if score >= cutoff:
                want[t, pos] = score
    assert got == want


def test_token_set_join_finds_every_pair(spark):
    sample, table, vocabulary = frames(spark)
    found = matching.token_set_join(matching.tokenise(table), vocabulary).join(table, "text_id").distinct()
    rows = found.select("text", "pos", "score").distinct().collect()
    got = {}
    for r in rows:
        got[r.text, r.pos] = max(r.score, got.get((r.text, r.pos), 0))
    want = {}
    for t in sample:
        for pos, k in enumerate(KEYWORDS):
            score = plain.token_set(t, k)
            if score >= 80:
                want[t, pos] = score
    assert got == pytest.approx(want) and got.keys() == want.keys()


def test_best_keyword_and_best_name_agree_with_brute_force(spark):
    sample, table, vocabulary = frames(spark)
    hits = {r.text: (r.keyword, r.score) for r in matching.best_keywords(matching.tokenise(table), vocabulary).join(table, "text_id").collect()}
    assert hits == {t: b for t in sample if (b := plain.best_keyword(t, KEYWORDS))}
    names = {r.text: (r.keyword, r.score) for r in matching.best_names(matching.tokenise(table), vocabulary).join(table, "text_id").collect()}
    assert names == {t: b for t in sample if (b := plain.best_name(t, KEYWORDS))}
    assert hits["ikea krakow pol"] == ("ikea", 100.0)
    assert not {"xyz123nothing", "9999999999999999", "zzz qqq vvv"} & set(hits)


def test_joins_agree_without_broadcast(spark, monkeypatch):
    sample, table, vocabulary = frames(spark)
    words = lambda: sorted(map(tuple, matching.token_hits(matching.tokenise(table), vocabulary).collect()))
    few = words()
    monkeypatch.setattr(matching, "VOCABULARY_ROWS", 0)
    monkeypatch.setattr(matching.attach, "__defaults__", ("left", (), 0, None))
    assert words() == few and len({(r[0], r[2]) for r in few}) <= len(few)
    hits = {r.text: r.keyword for r in matching.best_keywords(matching.tokenise(table), vocabulary).join(table, "text_id").collect()}
    assert hits == {t: b[0] for t in sample if (b := plain.best_keyword(t, KEYWORDS))}


def test_labels_take_the_last_listing_and_the_first_position(spark):
    taxonomy = taxonomy_frame(spark, {"A": ["x", "y"], "B": ["y", "z"]})
    training = training_frame(spark, {"x": ["one", "two", ""], "y": ["one"], "z": ["three"]})
    rows = keyword_labels(taxonomy, training).orderBy("pos").collect()
    assert [(r.keyword, r.subcategory, r.category) for r in rows] == [
        ("one", "y", "B"),
        ("two", "x", "A"),
        ("three", "z", "B"),
    ]
    assert [tuple(r) for r in repeated_keywords(training).collect()] == [("one", 2, "y")]
    with pytest.raises(VocabularyError, match="other"):
        require_known_subcategories(taxonomy, training_frame(spark, {"other": ["w"]}))


def test_category_takes_the_better_field(spark):
    labels = keyword_labels(taxonomy_frame(spark, CATEGORIES), training_frame(spark, TRAINING))
    rows = spark.createDataFrame(
        [
            (1, "noise", "ikea"),
            (2, "ikeaa", "orlen"),
            (3, "shell", "uber"),
            (4, "zzzzzz random gibberish 9999", ""),
            (5, None, "costa cofee"),
            (6, None, None),
        ],
        "id int, party string, title string",
    )
    out = naming.add_category(rows, "party", "title", labels, ["id"])
    assert {r.id: (r.category, r.subcategory) for r in out.collect()} == {
        1: ("Shopping", "Furniture"),
        2: ("Transport", "Fuel"),
        3: ("Transport", "Fuel"),
        4: ("Unclassified", "Unclassified"),
        5: ("Food", "Restaurant"),
        6: ("Unclassified", "Unclassified"),
    }


def test_canonical_names(spark):
    labels = keyword_labels(taxonomy_frame(spark, CATEGORIES), training_frame(spark, TRAINING))
    candidates = name_candidates(spark, ["ing bank śląski"], labels)
    values = ["ikea kraków pol", "ing bank śląski s.a.", "Żabka Łódź", "", None, "foo gmbh 30-000 krakow pol"]
    rows = spark.createDataFrame(list(enumerate(values)), "id int, party string")
    out = naming.add_canonical(rows, "party", candidates, "name", ["id"])
    assert {r.id: r.name for r in out.collect()} == {
        0: "ikea", 1: "ing bank slaski", 2: "zabka lodz", 3: "", 4: "", 5: "foo",
    }
