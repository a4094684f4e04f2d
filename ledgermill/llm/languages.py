"""Language identification by Bayesian fusion of four kinds of evidence.

1. Text: a naive Bayes model over hashed byte trigrams of letters, fitted on a
   bounded sample of rows with a declared language (`SAMPLE_DOCS` per language,
   chosen by a hash of the key). Its log-likelihoods are means per trigram times
   at most `TEXT_WEIGHT` trigrams, because neighbouring trigrams are not
   independent. One more hypothesis, no known language, spreads its trigrams evenly.
2. Declared language (an html `lang` attribute or a column): how often each true
   language goes with the declaration, from the text posteriors of all rows.
3. Address suffix (the last label of the host name): the same, smoothed to the
   shares of the whole table.
4. Host: shares of its rows, smoothed to those of its suffix; the row itself is
   left out of its host's counts.

All counts are grouped sums over every row. The tables of declarations and hosts
are broadcast while small (measured) and else joined with salted hot keys.

A row is rejected if its best hypothesis is no known language, if the best
language has a posterior under `floor`, or if its text has no letter: then the
language is null, as it is for null and empty texts. But the text model knows only
declared languages of `LEAST_DOCS` rows and more, at most the `MOST_LANGUAGES` most
frequent; a row with letters that declares another one is not rejected for its text: where
it would be, it keeps its declaration, with a null posterior. Null declarations and hosts
are values of their own; an address without a suffix has the empty one. Rows are
judged one by one, so repeated rows get equal results. Added columns get
underscores until their names are free. Without any language to learn nothing can be
fitted, and every row without a declaration is rejected; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.llm.arrays import as_bytes, slices, small_batches
from ledgermill.llm.mixing import free_name
from ledgermill.scale import attach, stage

SAMPLE_DOCS = 400  # documents per language that the text model is fitted on, at most about
LEAST_DOCS = 5  # a language with fewer declared documents is not learned
MOST_LANGUAGES = 200  # the most frequent declared languages are learned
FEATURE_BITS = 15
TEXT_WEIGHT = 40.0
SMOOTHING = 0.5
HOST_WEIGHT = 20.0  # rows that the suffix's shares count for in a host's
UNKNOWN_PRIOR = 1e-4

_LETTERS = np.zeros(256, np.uint8)
_LETTERS[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTERS[0x80:] = np.arange(0x80, 0x100)


@dataclass(frozen=True)
class TextModel:
    languages: list[str]
    log_likelihood: np.ndarray  # feature, language; the last language is none that is known

    def score(self, texts: pa.Array) -> np.ndarray:
        """Weighed log-likelihoods (text, language); NaN for texts without a letter."""
        features, first = trigrams(texts)
        n = np.diff(first)
        out = np.full((len(n), self.log_likelihood.shape[1]), np.nan)
        full = np.flatnonzero(n)
        if len(full):
            for k in range(out.shape[1]):
                out[full, k] = np.add.reduceat(self.log_likelihood[features, k], first[full])
            out[full] *= (np.minimum(n[full], TEXT_WEIGHT) / n[full])[:, None]
        return out


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of letters (other ASCII counts as one kind of blank), and where each text begins."""
    data, offsets = as_bytes(pc.utf8_lower(pc.fill_null(texts, "")))
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    codes = _LETTERS[data].astype(np.uint32)
    mixed = codes[:-2] * np.uint32(0x9E3779B1) + codes[1:-1] * np.uint32(0x85EBCA77) + codes[2:] * np.uint32(0xC2B2AE3D)
    mixed ^= mixed >> np.uint32(15)
    features = (mixed * np.uint32(0x27D4EB2F)) >> np.uint32(32 - FEATURE_BITS)
    lettered = (codes[:-2] > 0) & (codes[1:-1] > 0) | (codes[1:-1] > 0) & (codes[2:] > 0)
    for back in (1, 2):  # trigrams do not reach into the next text
        cut = offsets[1:-1] - back
        lettered[cut[(cut >= 0) & (cut < len(lettered))]] = False
    at = np.flatnonzero(lettered)
    return features[at].astype(np.int64), np.searchsorted(at, offsets)


def _sample_features(text: str, declared: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                features, first = trigrams(part.column(text))
                coded = pc.dictionary_encode(part.column(declared))
                groups = np.repeat(coded.indices.to_numpy().astype(np.int64), np.diff(first))
                keys, n = np.unique((groups << FEATURE_BITS) | features, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [coded.dictionary.take(pa.array(keys >> FEATURE_BITS)), pa.array(keys & ((1 << FEATURE_BITS) - 1)), pa.array(n)],
                    ["language", "feature", "n"],
                )

    return run


def fit_text_model(docs: DataFrame, text: str, declared: str, key: str, sample: int = SAMPLE_DOCS) -> TextModel | None:
    """The naive Bayes model of the declared languages, from a sample bounded by `sample` per language."""
    counts = (
        docs.filter(F.col(declared).isNotNull()).groupBy(F.col(declared).alias("language")).count()
        .filter(F.col("count") >= LEAST_DOCS).orderBy(F.desc("count"), "language").limit(MOST_LANGUAGES).collect()
    )
    if not counts:
        return None
    counts = sorted(counts, key=lambda r: r.language)
    languages = [r.language for r in counts]
    bucket = F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1_000_000))
    chosen = F.lit(False)
    for r in counts:
        chosen = chosen | ((F.col(declared) == r.language) & (bucket <= int(1e6 * min(1.0, sample / r["count"]))))
    table = (
        docs.filter(chosen).select(F.col(text).alias("text"), F.col(declared).alias("declared"))
        .mapInArrow(_sample_features("text", "declared"), "language string, feature bigint, n bigint")
        .groupBy("language", "feature").agg(F.sum("n").alias("n")).toPandas()
    )  # languages times 2**FEATURE_BITS rows at most
    seen = np.full((1 << FEATURE_BITS, len(languages)), SMOOTHING)
    column = table["language"].map({name: k for k, name in enumerate(languages)}).to_numpy(int)
    seen[table["feature"].to_numpy(int), column] += table["n"].to_numpy(float)
    even = np.full((1 << FEATURE_BITS, 1), 1.0 / (1 << FEATURE_BITS))
    return TextModel(languages, np.log(np.hstack([seen / seen.sum(axis=0), even])).astype(np.float32))


def _scorer(model):
    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = []
            for part in slices(pa.RecordBatch.from_arrays([texts], ["text"]), "text"):
                values = model.value.score(part.column("text"))
                none = np.isnan(values[:, 0])
                offsets = np.arange(len(values) + 1) * values.shape[1]
                rows = pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()), pa.array(values.ravel()), mask=pa.array(none)
                )
                parts.append(rows)
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.float64()))

    return score


def _fuser(model, natural: list[float], host_weight: float):
    """Best hypothesis (from 1) and its posterior from text, declaration and host; null for texts without a letter."""

    @F.arrow_udf("struct<best: int, confidence: double>")
    def fuse(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for columns in batches:
            names = ["text", "declared", "sums", "prior"]
            best, confidence, none = [], [], []
            for part in slices(pa.RecordBatch.from_arrays(list(columns), names), "text"):
                text = model.value.score(part.column("text"))
                declared, sums, prior = (
                    np.asarray(part.column(c).flatten(), float).reshape(len(text), -1) for c in names[1:]
                )
                rest = np.maximum(0.0, sums - _softmax(text + natural))  # the row itself left out
                shares = (rest + host_weight * prior) / (rest.sum(axis=1) + host_weight)[:, None]
                posterior = _softmax(text + declared + np.log(shares))
                missing = np.isnan(text[:, 0])
                best.append(np.where(missing, 0, np.nan_to_num(posterior).argmax(axis=1)) + 1)
                confidence.append(np.nan_to_num(posterior).max(axis=1))
                none.append(missing)
            if not best:
                yield pa.array([], pa.struct([("best", pa.int32()), ("confidence", pa.float64())]))
                continue
            yield pa.StructArray.from_arrays(
                [pa.array(np.concatenate(best).astype(np.int32)), pa.array(np.concatenate(confidence))],
                ["best", "confidence"],
                mask=pa.array(np.concatenate(none)),
            )

    return fuse


def _softmax(scores: np.ndarray) -> np.ndarray:
    weights = np.exp(scores - scores.max(axis=1, keepdims=True))
    return weights / weights.sum(axis=1, keepdims=True)


def declared_in(html: Column) -> Column:
    """The primary language subtag in the lang attribute of the html element, lower case; null if none."""
    found = F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-z]{2,3})", 1)
    return F.lower(F.nullif(found, F.lit("")))


def host_of(address: Column) -> Column:
    return F.lower(F.regexp_extract(address, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#]*)", 1))


def suffix_of(host: Column) -> Column:
    """The last label of a host name with a dot in it, else the empty text."""
    return F.regexp_extract(F.lower(host), r"\.([a-z]+)\.?$", 1)


def _posterior(scores: Column) -> Column:
    top = F.array_max(scores)
    weights = F.transform(scores, lambda s: F.exp(s - top))
    total = F.aggregate(weights, F.lit(0.0), lambda a, w: a + w)
    return F.transform(weights, lambda w: w / total)


def _sums(posterior: str, n: int) -> Column:
    return F.array(*[F.coalesce(F.sum(F.col(posterior)[k]), F.lit(0.0)) for k in range(n)])


def _shares(counts: Column, prior: Column, weight: float) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda a, c: a + c)
    return F.zip_with(counts, prior, lambda c, p: (c + weight * p) / (total + weight))


def identify_languages(
    docs: DataFrame,
    text: Column | str = "text",
    declared: Column | str = "lang",
    host: Column | str = "source",
    key: str = "doc_id",
    floor: float = 0.5,
    names: tuple[str, str, str] = ("language", "confidence", "rejected"),
) -> DataFrame:
    """`docs` with the best language, its posterior and whether the row is rejected."""
    small_batches(docs.sparkSession)
    text, declared, host = (F.col(c) if isinstance(c, str) else c for c in (text, declared, host))
    names = tuple(free_name(n, docs.columns) for n in names)
    language, confidence, rejected = names
    t, d, h, s, ll, post, dec, hst = (
        free_name(n, docs.columns)
        for n in ("_text", "_declared", "_host", "_suffix", "_ll", "_post", "_dec", "_hst")
    )
    evidence = {d: F.coalesce(F.concat(F.lit("="), declared), F.lit("")), h: F.coalesce(F.concat(F.lit("="), host), F.lit(""))}
    model = fit_text_model(docs.select(F.col(key), text.alias(t), declared.alias(d)), t, d, key)
    if model is None:
        lettered = (F.octet_length(text) >= 3) & text.rlike(r"[A-Za-z]{2}|[^\x00-\x7F]")
        said = F.when(lettered & (declared != ""), declared)
        return docs.withColumns({language: said, confidence: F.lit(None).cast("double"), rejected: said.isNull()}).select(
            *docs.columns, *names
        )
    kinds = len(model.languages) + 1  # the last is none that is known
    sent = docs.sparkSession.sparkContext.broadcast(model)
    score = _scorer(sent)
    natural_logs = [float(np.log((1 - UNKNOWN_PRIOR) / (kinds - 1)))] * (kinds - 1) + [float(np.log(UNKNOWN_PRIOR))]
    natural = F.array(*map(F.lit, natural_logs))
    scored = (
        docs.select(text.alias(t), *[c.alias(n) for n, c in evidence.items()])
        .withColumn(ll, score(F.col(t)))
        .select(d, h, _posterior(F.zip_with(ll, natural, lambda a, b: a + b)).alias(post))
    )
    grouped = stage(
        scored.groupBy(d, h).agg(_sums(post, kinds).alias("sums")), "language-counts"
    )  # declarations times hosts, summed before anything else is derived
    by_declared = grouped.groupBy(d).agg(_sums("sums", kinds).alias("sums"))
    whole = stage(grouped.agg(_sums("sums", kinds).alias("sums")), "language-shares").first()["sums"]
    total = sum(whole) + kinds * SMOOTHING
    shares = [(w + SMOOTHING) / total for w in whole]
    every = F.array(*map(F.lit, shares))
    per_language = F.array(*[F.lit(w + SMOOTHING) for w in whole])
    # How much likelier a declaration is with each language than on the whole.
    declared_table = by_declared.select(
        d, F.transform(F.zip_with(_shares(F.col("sums"), every, 1.0), every, lambda a, b: a / b), lambda x: F.log(x)).alias(dec)
    )
    by_host = grouped.groupBy(h).agg(_sums("sums", kinds).alias("sums")).withColumn(s, suffix_of(F.col(h)))
    by_suffix = by_host.groupBy(s).agg(_sums("sums", kinds).alias("suffix_sums"))
    hosts = by_host.join(by_suffix, s).select(
        h, F.struct(F.col("sums").alias("sums"), _shares(F.col("suffix_sums"), every, HOST_WEIGHT).alias("prior")).alias(hst)
    )
    rows = docs.withColumns(evidence)
    rows = attach(rows, stage(declared_table, "language-declared"), [d], spread=[F.col(key)])
    rows = attach(rows, stage(hosts, "language-hosts"), [h], spread=[F.col(key)])
    # One function for all evidence, so that a filter on its result does not repeat its parts.
    fuse = _fuser(sent, natural_logs, HOST_WEIGHT)
    rows = rows.withColumn(post, fuse(text, F.col(dec), F.col(hst)["sums"], F.col(hst)["prior"]))
    known = F.get(F.array(*[F.lit(x) for x in [*model.languages, None]]), F.col(post)["best"] - 1)
    rows = rows.withColumns({language: known, confidence: F.col(post)["confidence"]})
    refused = F.col(language).isNull() | (F.col(confidence) < floor)
    # The text tells nothing about a language that was not learned.
    unlearned = F.coalesce((declared != "") & ~declared.isin(model.languages), F.lit(False)) & F.col(post).isNotNull()
    said = refused & unlearned
    return rows.withColumns(
        {
            language: F.when(said, declared).when(~refused, F.col(language)),
            confidence: F.when(~said, F.col(confidence)),
            rejected: refused & ~unlearned,
        }
    ).select(*docs.columns, *names)


def kept_languages(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that are not rejected, with their own columns."""
    names = tuple(free_name(n, docs.columns) for n in ("_language", "_confidence", "_rejected"))
    found = identify_languages(docs, names=names, **options)
    return found.filter(~F.col(names[2])).select(*docs.columns)
