"""Small tables with the awkward rows every operator must take."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, copy int, language string, mark string, path string"


def words(seed, n, vocabulary=400):
    rng = random.Random(seed)
    names = ["".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(2, 8))) for _ in range(vocabulary)]
    rng = random.Random(seed + 1)
    return [rng.choice(names) for _ in range(n)]


def sentence(seed, n):
    return " ".join(words(seed, n))


def edited(text, seed, edits):
    rng, out = random.Random(seed), text.split(" ")
    for at in rng.sample(range(len(out)), edits):
        out[at] = f"changed{seed}x{at}"
    return " ".join(out)


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), 7, "x", "y", "z")


def awkward():
    long = sentence(50, 3000)
    return [
        row(0, None),
        row(1, ""),
        row(2, " \n\t "),
        row(3, "one two"),
        row(4, "one two"),
        row(5, long, None, None),
        row(6, "été 日本語 😀 été " * 40, "fr", "b"),
        row(7, "x" * 5000, "fr", "b"),
        row(8, "#$%&|<> 123 !!!", "de", "b"),
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
