"""Fuzzy keyword matching of distinct texts against a small vocabulary.

Two similarities are used, both in 0-100 and both exact:

* token-set similarity of the whole text: 100 when one token set contains the
  other, else the best of three ratios over shared and remaining tokens;
* indel ratio of every word of the text.

No text is compared with the whole vocabulary. Pairs that can reach the cutoff
are found by equi-joins: on shared tokens, or on a piece of the keyword that
must survive unchanged when at most `d` characters are inserted or deleted
(cut into `d + 1` pieces, at least one is untouched). Pieces are short, so
vocabularies beyond `GRAM_VOCABULARY` keywords are searched by pairs of rare
grams instead (see `grams`). A token that more than `COMMON` keywords hold joins
only texts and keywords of which it can be the decisive part, see `_candidates`.
Which way is taken changes no result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.functions.similarity import char_masks, indel_ratio, lcs_length, percent
from ledgermill.functions.text import blank_tokens, word_tokens
from ledgermill.operators.grams import char_signature, gram_counts, gram_keys, least_shared, lengths_fit
from ledgermill.scale import BROADCAST_BYTES, attach, bounded_arrow, small_copy, spread_join, stage

CUTOFF = 80
VOCABULARY_ROWS = 10_000
PIECE_ROWS = 50_000
GRAM_VOCABULARY = 500
COMMON = 32


@dataclass(frozen=True)
class Keywords:
    """A vocabulary (keyword, pos), its longest keyword and how to join it.

    Up to `VOCABULARY_ROWS` rows, and while what is made from it stays within
    `BROADCAST_BYTES`, it is held as a literal table and broadcast; beyond that
    it is joined by shuffle, with every key spread.
    """

    frame: DataFrame
    small: bool
    longest: int
    rows: int

    @classmethod
    def of(cls, vocabulary: DataFrame | Keywords) -> Keywords:
        if isinstance(vocabulary, Keywords):
            return vocabulary
        listed = vocabulary.select("keyword", F.col("pos").cast("bigint").alias("pos"))
        table = bounded_arrow(listed, VOCABULARY_ROWS)
        if table is not None:
            lengths = [len(k) for k in table["keyword"].to_pylist()]
            # Tables made from it repeat a keyword's tokens or pieces for each of its characters at most.
            small = 8 * sum(n * n for n in lengths) <= BROADCAST_BYTES
            frame = listed.sparkSession.createDataFrame(table, listed.schema)
            return cls(frame, small, max(lengths, default=0), len(lengths))
        listed = stage(listed, "vocabulary")
        size = listed.agg(F.max(F.length("keyword")).alias("m"), F.count(F.lit(1)).alias("n")).first()
        return cls(listed, False, size.m, size.n)

    def find(self, rows: DataFrame, table: DataFrame, on: Sequence[str], spread: Sequence[str]) -> DataFrame:
        """Inner join of many rows with a table made from the vocabulary."""
        if self.small:
            return rows.join(F.broadcast(table), list(on))
        return spread_join(rows, table, on, spread)


def text_key(text: Column) -> Column:
    """Compact join key of a text of any length."""
    return F.sha2(text, 256).substr(1, 32)


def distinct_texts(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(text_id, text): every distinct non-empty text of the columns."""
    return counted_texts(rows, columns).drop("n")


def counted_texts(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`distinct_texts` with `n`, in how many cells of the columns each stands."""
    texts = rows.select(F.explode(F.array(*columns)).alias("text")).filter(F.col("text") != "")
    counted = texts.groupBy("text").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(text_key(F.col("text")).alias("text_id"), "text", "n")


def tokenise(texts: DataFrame) -> DataFrame:
    """(text_id, tokens, count, chars, words), written once: the distinct
    blank-separated tokens with their number and total length, and all words in order.

    Reading tokens back keeps Spark from splitting each text again for every
    expression that mentions them.
    """
    tokens = texts.select("text_id", blank_tokens(F.col("text")).alias("tokens"), word_tokens(F.col("text")).alias("words"))
    return stage(tokens.select("text_id", "tokens", *_sizes("tokens", "count", "chars"), "words"), "tokens")


def _sizes(tokens: str, count: str, chars: str) -> list[Column]:
    total = F.expr(f"aggregate({tokens}, 0, (acc, t) -> acc + length(t))")
    return [F.size(tokens).alias(count), total.alias(chars)]


def _pieces(keywords: DataFrame, cutoff: int) -> DataFrame:
    """Per keyword and admissible text length, the pieces one of which must occur.

    `slack` is the largest indel distance reaching the cutoff at these lengths;
    of it at most `fewer` characters are missing and `more` are added, which
    also bounds how far a surviving piece can have moved.
    """
    shortest = f"cast(ceil(m * {cutoff} / {200 - cutoff}) as int)"
    longest = f"cast(floor(m * {200 - cutoff} / {cutoff}) as int)"
    budget = f"cast((m + n) * {100 - cutoff} div 100 as int)"
    sized = keywords.selectExpr("*", "length(keyword) as m").filter("m > 0")
    paired = sized.selectExpr("*", f"explode(sequence({shortest}, {longest})) as n")
    slack = paired.selectExpr("*", f"{budget} - pmod(m + n - {budget}, 2) as slack").filter("slack >= 0")
    cuts = slack.selectExpr("*", "explode(sequence(0, slack)) as i")
    bounds = cuts.selectExpr(
        "*", "cast(i * m div (slack + 1) as int) as piece_at", "cast((i + 1) * m div (slack + 1) as int) as piece_end"
    )
    return bounds.selectExpr(
        "n",
        "piece_end - piece_at as piece_size",
        "substring(keyword, piece_at + 1, piece_end - piece_at) as piece",
        "piece_at",
        "slack",
        "cast((slack - n + m) div 2 as int) as fewer",
        "cast((slack + n - m) div 2 as int) as more",
        "pos",
        "keyword",
        "masks",
    )


def _local_pieces(pieces: DataFrame, known: Keywords) -> tuple[DataFrame, DataFrame, Keywords]:
    """The pieces, the piece sizes (n, sizes) to look for per text length, and how to
    join: as literal tables while there are few pieces, else as a written table."""
    spark = pieces.sparkSession
    table = bounded_arrow(pieces, PIECE_ROWS) if known.small else None
    if table is None:
        pieces = stage(pieces, "pieces")
        sizes = pieces.groupBy("n").agg(F.collect_set("piece_size").alias("sizes"))
        return pieces, sizes, replace(known, small=False)
    found: dict[int, set[int]] = {}
    for n, size in zip(table["n"].to_pylist(), table["piece_size"].to_pylist(), strict=True):
        found.setdefault(n, set()).add(size)
    listed = pa.table(
        {
            "n": pa.array(list(found), pa.int32()),
            "sizes": pa.array([sorted(s) for s in found.values()], pa.list_(pa.int32())),
        }
    )
    return spark.createDataFrame(table, pieces.schema), spark.createDataFrame(listed), known


def ratio_join(strings: DataFrame, vocabulary: DataFrame | Keywords, cutoff: int = CUTOFF) -> DataFrame:
    """Pairs of `strings` (with a `string` column) and keywords whose indel ratio
    is at least `cutoff`; adds `keyword`, `pos` and `score`.

    A pair appears once per surviving piece; reduce with a maximum or `distinct`.
    """
    if not 75 <= cutoff <= 100:
        raise ValueError("the cutoff must lie between 75 and 100")
    known = Keywords.of(vocabulary)
    if known.rows > GRAM_VOCABULARY:
        candidates = gram_candidates(strings, known, cutoff)
        return _scored_strings(_once(candidates, masks=char_masks("keyword")), strings.columns, cutoff)
    masked = known.frame.select("keyword", "pos", char_masks("keyword").alias("masks"))
    pieces, sizes, known = _local_pieces(_pieces(masked, cutoff), known)
    probes = (
        strings.withColumn("n", F.length("string"))
        .join(F.broadcast(sizes), "n")  # at most one row per admissible length
        .selectExpr(*strings.columns, "n", "explode(sizes) as piece_size")
        .selectExpr("*", "explode(sequence(0, n - piece_size)) as at")
        .selectExpr("*", "substring(string, at + 1, piece_size) as piece")
    )
    candidates = (
        known.find(probes, pieces, ["n", "piece_size", "piece"], [*strings.columns, "at"])
        .filter("at - piece_at between -fewer and more")
        .filter("levenshtein(string, keyword, slack) >= 0")
    )
    return _scored_strings(candidates, strings.columns, cutoff)


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """`df` with more columns, worked out once for each row: a generator of one row, unlike a
    projection, is not merged into the expressions that mention its columns."""
    made = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(made)))


def _scored_strings(candidates: DataFrame, columns: Sequence[str], cutoff: int) -> DataFrame:
    return candidates.select(
        *columns, "keyword", "pos", indel_ratio("string", "keyword", "masks").alias("score")
    ).filter(F.col("score") >= cutoff)


def gram_candidates(strings: DataFrame, known: Keywords, cutoff: int) -> DataFrame:
    """`strings` with the keywords (and pos) that share a key of `gram_keys` and are near
    enough in length and edits; a pair appears once per shared key."""
    counts = gram_counts(known.frame)
    keyed = stage(
        known.frame.filter("keyword != ''").select(
            "keyword",
            "pos",
            char_signature("keyword").alias("kw_signature"),
            F.explode(gram_keys(F.col("keyword"), counts, cutoff)).alias("gram_key"),
        ),
        "gram-keys",
    )
    probes = strings.filter("string != ''").select(
        *strings.columns,
        char_signature("string").alias("signature"),
        F.explode(gram_keys(F.col("string"), counts, cutoff)).alias("gram_key"),
    )
    most = f"cast((length(string) + length(keyword)) * {100 - cutoff} div 100 as int)"
    return (
        replace(known, small=False).find(probes, keyed, ["gram_key"], [*strings.columns])
        .filter(lengths_fit("length(string)", "length(keyword)", cutoff))
        .filter(f"bit_count(signature ^ kw_signature) <= {most}")
        .filter(f"levenshtein(string, keyword, {most}) >= 0")
        .drop("gram_key", "signature", "kw_signature")
    )


def _joined(tokens: Column) -> Column:
    return F.array_join(F.array_sort(tokens), " ")


def _rest(chars: str, count: str) -> Column:
    """Length of the space-joined tokens that are not shared."""
    return F.expr(f"{chars} - shared_chars + greatest({count} - shared - 1, 0)")


def _shared_tokens(tokens: DataFrame, words: DataFrame, known: Keywords, reachable: Column) -> DataFrame:
    """Every pair that shares a token, with the number and length of its shared tokens."""
    short_tokens = F.when(reachable, F.col("tokens")).alias("short_tokens")
    text_tokens = tokens.select("text_id", "count", "chars", short_tokens, F.explode("tokens").alias("token"))
    keyword_tokens = words.select("*", F.explode("kw_tokens").alias("token"))
    return (
        known.find(text_tokens, keyword_tokens, ["token"], ["text_id"])
        .groupBy("text_id", "count", "chars", "short_tokens", *words.columns)
        .agg(F.count(F.lit(1)).alias("shared"), F.sum(F.length("token")).alias("shared_chars"))
    )


def common_tokens(words: DataFrame) -> DataFrame:
    """(token, held): tokens that more than `COMMON` keywords hold."""
    held = words.select(F.explode("kw_tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("held"))
    return held.filter(F.col("held") > COMMON)


def _most_missing(weight: str, cutoff: int) -> Column:
    """What the tokens of one side that are not shared may weigh, a token its length and one,
    if shared tokens alone are to reach the cutoff against that side."""
    spare = 100 - cutoff
    return F.expr(f"({weight} - 1) * {2 * spare} / {100 + spare}")


def token_candidates(tokens: DataFrame, words: DataFrame, common: DataFrame, known: Keywords, cutoff: int) -> DataFrame:
    """(text_id, pos), each once: pairs that share a token and may reach the cutoff.

    `common` holds the tokens of many keywords. A pair that shares any other token is
    a candidate, which costs at most `COMMON` rows per token of a text. A keyword is
    dominated if its common tokens weigh about as much as the grams that similar
    texts must share; it is a candidate for every token. What is left shares common
    tokens only, with a keyword that is not dominated:

    * the shared tokens are nearly all of the keyword: then they hold another token;
    * they are nearly all of the text: its common tokens, those of few keywords first,
      are used until the others could not carry it (positions beyond that prefix are
      not joined);
    * the remaining tokens are similar in their characters: then lengths and signatures
      of the whole texts are near. This is a condition of the join itself, so pairs that
      fail it are neither made nor shuffled.
    """
    share = F.col("chars") + F.col("count")
    reachable = share <= known.longest * 3 + 4
    tagged = words.select("pos", "keyword", "kw_count", "kw_chars", F.explode("kw_tokens").alias("token")).join(
        common, "token", "left"
    )
    heavy = F.coalesce(F.sum(F.when(F.col("held").isNotNull(), F.length("token") + 1)), F.lit(0)).alias("heavy")
    sizes = tagged.groupBy("pos", "keyword", "kw_count", "kw_chars").agg(heavy)
    length = F.col("kw_chars") + F.col("kw_count") - 1
    dominated = F.col("heavy") > least_shared(length, cutoff) - 2
    kinds = sizes.select("pos", "heavy", dominated.alias("dominated"))
    tagged = stage(tagged.select("pos", "token", "held").join(kinds, "pos"), "keyword-tokens")
    text_tokens = tokens.select("text_id", "count", "chars", F.explode("tokens").alias("token"))
    direct = known.find(
        text_tokens.select("text_id", "token"), tagged.filter("held IS NULL OR dominated").select("token", "pos"), ["token"], ["text_id"]
    )
    # Short texts by their common tokens: reachable ones only.
    shared = known.find(text_tokens.filter(reachable), common, ["token"], ["text_id"])
    per_text = Window.partitionBy("text_id")
    before = per_text.orderBy("held", "token").rowsBetween(Window.unboundedPreceding, -1)
    weight = F.length("token") + 1
    weighed = shared.select(
        "text_id",
        "token",
        share.alias("weight"),
        F.sum(weight).over(per_text).alias("common"),
        F.coalesce(F.sum(weight).over(before), F.lit(0)).alias("before"),
    )
    decisive = weighed.filter(F.col("weight") - F.col("common") + F.col("before") <= _most_missing("weight", cutoff))
    plain = tagged.filter("held IS NOT NULL AND NOT dominated")
    contained = known.find(decisive.select("text_id", "token"), plain.select("token", "pos"), ["token"], ["text_id"])
    # Similar rests: both sides hold a common token.
    signed = words.select("pos", _joined(F.col("kw_tokens")).alias("keyword")).select(
        "pos", F.length("keyword").alias("m"), char_signature("keyword").alias("kw_signature")
    )
    held = plain.select("token", "pos").join(signed, "pos")
    texts = tokens.filter(reachable).select("text_id", _joined(F.col("tokens")).alias("string")).select(
        "text_id", F.length("string").alias("n"), char_signature("string").alias("signature")
    )
    holders = shared.select("text_id", "token").join(texts, "text_id")
    apart = "bit_count(signature ^ kw_signature)"
    near = lengths_fit("n", "m", cutoff) & F.expr(f"{apart} * 100 <= (n + m) * {100 - cutoff}")
    similar = known.find(holders, held, ["token"], ["text_id"]).filter(near)
    found = direct.select("text_id", "pos").union(contained.select("text_id", "pos")).union(similar.select("text_id", "pos"))
    return found.distinct()


def _decided_tokens(tokens: DataFrame, words: DataFrame, common: DataFrame, known: Keywords, cutoff: int, reachable: Column) -> DataFrame:
    """The pairs of `token_candidates` with the number and length of their shared tokens."""
    pairs = token_candidates(tokens, words, common, known, cutoff)
    short_tokens = F.when(reachable, F.col("tokens")).alias("short_tokens")
    texts = tokens.select("text_id", "count", "chars", "tokens", short_tokens)
    both = known.find(pairs, words, ["pos"], ["text_id"]).join(texts, "text_id")
    both = both.withColumn("both", F.array_intersect("tokens", "kw_tokens")).drop("tokens")
    # Written, so that the scores below do not work the shared tokens out again wherever they mention them.
    shared = stage(both, "token-pairs").filter("size(both) > 0")
    return shared.withColumns(
        {"shared": F.size("both"), "shared_chars": F.expr("aggregate(both, 0, (acc, t) -> acc + length(t))")}
    )


def token_set_join(tokens: DataFrame, vocabulary: DataFrame | Keywords, cutoff: int = CUTOFF) -> DataFrame:
    """(text_id, keyword, pos, score): pairs of a `tokenise`d text and a keyword whose
    token-set similarity is at least `cutoff`.

    Pairs sharing a token are scored from counts and lengths alone; characters
    are compared only where the lengths leave the cutoff within reach.
    """
    known = Keywords.of(vocabulary)
    words = (
        known.frame.select("keyword", "pos", blank_tokens(F.col("keyword")).alias("kw_tokens"))
        .filter("size(kw_tokens) > 0")
        .select("*", *_sizes("kw_tokens", "kw_count", "kw_chars"))
    )
    # Beyond this length the remaining tokens alone put the score under the cutoff.
    reachable = F.col("chars") + F.col("count") <= known.longest * 3 + 4
    common = small_copy(common_tokens(words)) if known.rows > COMMON else None
    if common is None or not common.head(1):
        sharing = _shared_tokens(tokens, words, known, reachable)
    else:
        sharing = _decided_tokens(tokens, words, common, known, cutoff, reachable)
    pairs = sharing.select(
        *("text_id", "keyword", "pos", "short_tokens", "kw_tokens"),
        (F.col("shared_chars") + F.col("shared") - 1).alias("sect"),
        _rest("chars", "count").alias("a"),
        _rest("kw_chars", "kw_count").alias("b"),
    )
    # Shared tokens against shared plus remaining ones: best on the side with less remaining.
    by_length = F.expr("if(least(a, b) = 0, 100.0D, 100.0D - 100.0D * (1 + least(a, b)) / (2 * sect + 1 + least(a, b)))")
    total = F.expr("2 * sect + 2 + a + b")
    at_best = F.expr("100.0D - 100.0D * abs(a - b) / (2 * sect + 2 + a + b)")
    pairs = pairs.select("*", total.alias("total"), by_length.alias("by_length"), at_best.alias("at_best"))
    undecided = (F.col("at_best") >= cutoff) & (F.col("at_best") > F.col("by_length"))
    left, right = F.array_except("short_tokens", "kw_tokens"), F.array_except("kw_tokens", "short_tokens")
    pairs = _once(
        pairs.filter((F.col("by_length") >= cutoff) | undecided),
        left=F.when(undecided, _joined(left)),
        right=F.when(undecided, _joined(right)),
    )
    pairs = _once(pairs, masks=char_masks("right"))
    by_chars = percent(F.col("a") + F.col("b") - 2 * lcs_length("left", "right", "masks"), F.col("total"))
    score = F.when(F.col("left").isNull(), F.col("by_length")).otherwise(F.greatest("by_length", by_chars))
    sharing = pairs.select("text_id", "keyword", "pos", score.alias("score")).filter(F.col("score") >= cutoff)

    brief = tokens.filter(reachable).select("text_id", _joined(F.col("tokens")).alias("string"))
    joined = words.select(_joined(F.col("kw_tokens")).alias("keyword"), "pos")
    disjoint = ~F.arrays_overlap(F.split("string", " "), F.split("keyword", " "))
    apart = ratio_join(brief, replace(known, frame=joined), cutoff).filter(disjoint)
    named = known.find(apart.drop("keyword"), known.frame, ["pos"], ["text_id"])
    return sharing.unionByName(named.select(*sharing.columns))


def token_hits(tokens: DataFrame, vocabulary: DataFrame | Keywords, cutoff: int = CUTOFF) -> DataFrame:
    """(text_id, token_at, keyword, pos, score): per distinct word of each `tokenise`d text,
    at its first place, its closest keyword.

    Every distinct word is scored once and the few that match are joined back.
    """
    words = tokens.select("text_id", F.posexplode("words").alias("token_at", "string"))
    scored = ratio_join(words.select("string").distinct(), vocabulary, cutoff)
    closest = scored.groupBy("string").agg(F.max_by(F.struct("keyword", "pos", "score"), _rank(())).alias("best"))
    closest = stage(closest.select("string", "best.*"), "matching-words")
    # One copy of a word per text is enough, and its first place decides ties.
    firsts = words.groupBy("text_id", "string").agg(F.min("token_at").alias("token_at"))
    return attach(firsts, closest, ["string"], "inner", spread=["text_id"]).drop("string")


def _rank(between: Sequence[Column]) -> Column:
    """Orders by score, then `between`, then the keyword listed first."""
    return F.struct(F.col("score"), *between, (-F.col("pos")).alias("listed_first"))


def _best(scored: DataFrame, rank: Column) -> DataFrame:
    best = scored.groupBy("text_id").agg(F.max_by(F.struct("keyword", "score"), rank).alias("best"))
    return best.select("text_id", "best.*")


def best_keywords(
    tokens: DataFrame,
    vocabulary: DataFrame | Keywords,
    cutoff: int = CUTOFF,
    whole: DataFrame | None = None,
) -> DataFrame:
    """(text_id, keyword, score): the best keyword of each `tokenise`d text, texts
    without one left out.

    The whole text is preferred to its words, an earlier word to a later one and
    an earlier keyword to a later one; each only among equal scores. `whole` may
    bring the `token_set_join` of the same keywords if it is already at hand.
    """
    known = Keywords.of(vocabulary)
    if whole is None:
        whole = token_set_join(tokens, known, cutoff)
    words = token_hits(tokens, known, cutoff)
    both = whole.withColumn("token_at", F.lit(-1)).unionByName(words)
    return _best(both, _rank([(-F.col("token_at")).alias("earliest")]))


def best_names(
    tokens: DataFrame,
    candidates: DataFrame | Keywords,
    cutoff: int = CUTOFF,
    whole: DataFrame | None = None,
) -> DataFrame:
    """(text_id, keyword, score) of `tokenise`d texts by whole-text similarity; among
    equal scores the longer keyword, then the earlier one."""
    if whole is None:
        whole = token_set_join(tokens, candidates, cutoff)
    return _best(whole, _rank([F.length("keyword")]))
