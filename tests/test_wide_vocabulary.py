"""Matching against many keywords, and against keywords that share a frequent token."""

import random

import pytest
from pyspark.sql import functions as F

from ledgermill.operators import grams, matching
from tests import plain


def word(rng, low=3, high=10):
    return "".join(rng.choice("aeioubcdklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(low, high) // 2 + 1))[: rng.randint(low, high)]


def noisy(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        at = rng.randint(0, len(chars))
        if rng.random() < 0.5 and len(chars) > 1:
            chars.pop(at - 1)
        else:
            chars.insert(at, rng.choice("aeimnrstś"))
    return "".join(chars)


def frames(spark, texts, keywords):
    table = spark.createDataFrame([(t,) for t in texts], "text string").select(matching.text_key(F.col("text")).alias("text_id"), "text")
    return table, spark.createDataFrame(list(enumerate(keywords)), "pos bigint, keyword string")


@pytest.mark.parametrize("cutoff", [75, 80, 90, 100])
def test_gram_candidates_lose_no_similar_word(spark, monkeypatch, cutoff):
    rng = random.Random(cutoff)
    keywords = sorted({word(rng, 1, 12) for _ in range(150)} | {"aaaaaa", "ababab", "ananas", "łódź", "żółć", "x"})
    texts = sorted({noisy(rng, rng.choice(keywords), rng.randint(0, 4)) for _ in range(500)} | {"aaaaa", "bababa", "lodz", "y"})
    table, vocabulary = frames(spark, texts, keywords)
    monkeypatch.setattr(matching, "GRAM_VOCABULARY", 10)
    found = matching.ratio_join(table.select(F.col("text").alias("string")), vocabulary, cutoff).distinct()
    want = {(t, k): s for t in texts for k, w in enumerate(keywords) if (s := plain.ratio(t, w)) >= cutoff}
    assert {(r.string, r.pos): r.score for r in found.collect()} == want and want


def candidates_per_word(spark, size):
    """Mean pairs per word before characters are compared, for a vocabulary of `size` different keywords."""
    rng = random.Random(5)
    letters = "eeeeeeeeeeeettttttttaaaaaaaooooooooiiiiiiinnnnnnsssssshhhhhrrrrrddddlllluuucccmmmffwwyyppggvbkjqxz"
    keywords: dict[str, None] = {}
    while len(keywords) < size:
        keywords["".join(rng.choices(letters, k=rng.randint(4, 10))) + rng.choice(["", "", "ing", "tion"])] = None
    texts = [noisy(rng, rng.choice(list(keywords)), 1) for _ in range(400)]
    table, vocabulary = frames(spark, texts, list(keywords))
    counts = grams.gram_counts(vocabulary)
    keys = lambda c: F.explode(grams.gram_keys(F.col(c), counts, 80)).alias("key")
    pairs = table.select("text", keys("text")).join(vocabulary.select("keyword", keys("keyword")), "key")
    return pairs.filter(grams.lengths_fit("length(text)", "length(keyword)", 80)).select("text", "keyword").distinct().count() / len(texts)


def test_candidates_stay_few_among_ten_thousand_keywords(spark):
    few, many = candidates_per_word(spark, 1000), candidates_per_word(spark, 10_000)
    print("candidates per word", few, many)
    assert many < 10_000 * 0.02


def common_case(shared, n):
    """Keywords that all hold a token, of which every text has it too."""
    rng = random.Random(11)
    keywords = sorted({f"{shared} {word(rng, 8, 12)} {word(rng, 3, 6)}" for _ in range(n)})
    keywords += [shared, f"{shared} ab", word(rng), f"{word(rng)} {word(rng)}"]
    texts = {f"{shared} {word(rng, 6, 12)} {word(rng, 6, 12)} {k}" for k in range(100)}
    texts |= {noisy(rng, rng.choice(keywords), rng.randint(0, 5)) for _ in range(250)}
    texts |= {" ".join(rng.sample(k.split(), len(k.split()))) for k in rng.sample(keywords, 20)}
    texts |= {shared, f"{shared} x", f"{shared} {shared}", f"y {shared} z", noisy(rng, shared, 1)}
    return sorted(t for t in texts if t.strip()), keywords


@pytest.mark.parametrize("shared", ["sp", "company", "international"])
def test_common_tokens_lose_no_pair(spark, shared):
    texts, keywords = common_case(shared, 120)
    table, vocabulary = frames(spark, texts, keywords)
    found = matching.token_set_join(matching.tokenise(table), vocabulary).join(table, "text_id").select("text", "pos", "score")
    got = {(r.text, r.pos): r.score for r in found.groupBy("text", "pos").agg(F.max("score").alias("score")).collect()}
    want = {(t, k): s for t in texts for k, w in enumerate(keywords) if (s := plain.token_set(t, w)) >= 80}
    assert got == pytest.approx(want) and got.keys() == want.keys() and len(want) > len(texts)


def test_one_token_in_all_texts_and_a_thousand_keywords_makes_few_pairs(spark):
    rng = random.Random(12)
    keywords = sorted({f"sp {word(rng, 8, 12)}{word(rng, 8, 12)}" for _ in range(1100)})[:1000]
    texts = [f"sp {word(rng, 6, 12)} {word(rng, 6, 12)} {k}" for k in range(300)]
    texts += [f"{k} gdynia" for k in keywords[:50]]
    table, vocabulary = frames(spark, texts, keywords)
    known = matching.Keywords.of(vocabulary)
    words = known.frame.select("keyword", "pos", F.split("keyword", " ").alias("kw_tokens")).select(
        "*", *matching._sizes("kw_tokens", "kw_count", "kw_chars")
    )
    common = matching.common_tokens(words)
    assert [r.token for r in common.collect()] == ["sp"]
    pairs = matching.token_candidates(matching.tokenise(table), words, common, known, 80)
    n = pairs.count()
    assert 50 <= n < 0.05 * len(texts) * len(keywords)
    found = matching.token_set_join(matching.tokenise(table), vocabulary).join(table, "text_id").select("text", "keyword").distinct()
    got = {(r.text, r.keyword) for r in found.collect()}
    assert {(f"{k} gdynia", k) for k in keywords[:50]} <= got
    sample = rng.sample(texts, 40)
    assert {(t, k) for t, k in got if t in set(sample)} == {(t, k) for t in sample for k in keywords if plain.token_set(t, k) >= 80}
