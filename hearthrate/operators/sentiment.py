"""Lexicon sentiment of short texts (after Hutto and Gilbert, 2014) as joins and aggregates.

The lexicon is a table (word, valence) the caller supplies. Rules kept: negation
and degree words among the three words before, phrases of them ("never so",
"without doubt", "least", "kind of"), emphasis by capitals and by ! and ?, and
the turn at "but". Idioms and emoticon spellings are not covered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from hearthrate.operators.skew import lookup_join

# Fixed values of the published method.
DEGREE_STEP = 0.293
CAPITALS_STEP = 0.733
NEGATION_FACTOR = -0.74
DISTANCE_DAMPING = (1.0, 0.95, 0.9)
BEFORE_BUT, AFTER_BUT = 0.5, 1.5
EXCLAMATION_STEP, EXCLAMATION_MOST = 0.292, 4
QUESTION_STEP, QUESTION_MOST, QUESTION_LIMIT = 0.18, 3, 0.96
NORMALISER = 15.0
POSITIVE_ABOVE, NEGATIVE_BELOW = 0.05, -0.05

# Words that strengthen, weaken or negate what follows.
STRENGTHENERS = (
    "absolutely", "amazingly", "awfully", "completely", "considerably", "decidedly", "deeply", "enormously",
    "entirely", "especially", "exceptionally", "extremely", "fabulously", "fully", "greatly", "highly", "hugely",
    "incredibly", "intensely", "majorly", "more", "most", "particularly", "purely", "quite", "really",
    "remarkably", "so", "substantially", "thoroughly", "totally", "tremendously", "unbelievably", "unusually",
    "utterly", "very",
)
WEAKENERS = (
    "almost", "barely", "hardly", "kinda", "less", "little", "marginally", "occasionally", "partly", "scarcely",
    "slightly", "somewhat", "sorta",
)
NEGATORS = (
    "aint", "arent", "cannot", "cant", "couldnt", "darent", "didnt", "doesnt", "ain't", "aren't", "can't",
    "couldn't", "daren't", "didn't", "doesn't", "dont", "hadnt", "hasnt", "havent", "isnt", "mightnt", "mustnt",
    "neither", "don't", "hadn't", "hasn't", "haven't", "isn't", "mightn't", "mustn't", "neednt", "needn't",
    "never", "none", "nope", "nor", "not", "nothing", "nowhere", "oughtnt", "shant", "shouldnt", "wasnt",
    "werent", "oughtn't", "shan't", "shouldn't", "wasn't", "weren't", "without", "wont", "wouldnt", "won't",
    "wouldn't", "rarely", "seldom", "despite",
)
# Phrases. "never so" and "never this" strengthen; two words that weaken whatever their sign.
NEVER_SO, NEVER_SO_FACTOR = ("so", "this"), 1.25
WEAKENING_PAIRS = ("kind of", "sort of", "just enough")
NOT_LEAST_AFTER = ("at", "very")
# A lexicon of up to this many words, a few megabytes, is broadcast.
LEXICON_ROWS = 100_000
# Marks at the start or end of a word.
EDGE_MARKS = r"(?<!\S)\p{Punct}+|\p{Punct}+(?!\S)"


def _words(text: Column) -> Column:
    """Words without marks at their ends; single letters are dropped."""
    return F.filter(F.split(F.regexp_replace(text, EDGE_MARKS, ""), r"\s+"), lambda word: F.length(word) > 1)


def _shouted(word: Column) -> Column:
    return (F.upper(word) == word) & (F.lower(word) != word)


def _emphasis(text: Column) -> Column:
    bangs = F.length(text) - F.length(F.replace(text, F.lit("!"), F.lit("")))
    asks = F.length(text) - F.length(F.replace(text, F.lit("?"), F.lit("")))
    from_bangs = F.least(bangs, F.lit(EXCLAMATION_MOST)) * F.lit(EXCLAMATION_STEP)
    from_asks = (
        F.when(asks <= 1, 0.0).when(asks <= QUESTION_MOST, asks * F.lit(QUESTION_STEP)).otherwise(QUESTION_LIMIT)
    )
    return from_bangs + from_asks


def score_sentiment(texts: DataFrame, keys: Sequence[str], text: str, lexicon: DataFrame) -> DataFrame:
    """(keys, compound): one score in [-1, 1] per text; 0 for empty text or no lexicon word.

    ``keys`` must identify a text. Each word is exploded together with its three
    predecessors, so no ordering shuffle is needed; the words of a text stay in
    one partition and are summed there before the one shuffle by ``keys``.
    """
    lexicon = lexicon.select(F.lower("word").alias("_low"), F.col("valence").cast("double").alias("_valence"))
    rule_words = (*STRENGTHENERS, *WEAKENERS, *NEGATORS, "least")
    # A word the lexicon scores does not also modify others; at most one row per rule word.
    scored_rules = {row["_low"] for row in lexicon.where(F.col("_low").isin(*rule_words)).distinct().collect()}

    def usable(words: Sequence[str]) -> list[str]:
        return [w for w in words if w not in scored_rules]

    body = F.coalesce(F.col(text), F.lit(""))
    prepared = texts.select(*keys, _words(body).alias("_words"), _emphasis(body).alias("_emphasis"))
    prepared = prepared.withColumns({
        "_mixed": F.exists("_words", _shouted) & ~F.forall("_words", _shouted),
        "_but": F.array_position(F.transform("_words", F.lower), "but"),
    })
    # Shifted copies put the words before next to each word. They are longer than
    # the word list, so every text also yields a row without a word.
    gap = F.lit(None).cast("string")
    shifted = [F.concat(F.array(*[gap] * back), F.col("_words")).alias(f"_raw{back}") for back in (1, 2, 3)]
    after = F.slice("_words", F.lit(2), F.greatest(F.size("_words"), F.lit(1))).alias("_after")
    zipped = prepared.select(*keys, "_emphasis", "_mixed", "_but", "_words", *shifted, after).select(
        *keys, "_emphasis", "_mixed", "_but",
        F.posexplode(F.arrays_zip("_words", "_raw1", "_raw2", "_raw3", "_after")).alias("_at", "_w"),
    )
    near = zipped.select(
        *keys, "_emphasis", "_mixed", "_but", (F.col("_at") + 1).alias("_index"),
        F.col("_w._words").alias("_word"), F.lower("_w._words").alias("_low"),
        "_w._raw1", "_w._raw2", "_w._raw3", F.lower("_w._raw3").alias("_third"),
        (F.lower("_w._words").eqNullSafe("kind") & F.lower("_w._after").eqNullSafe("of")).alias("_kind_of"),
    )
    words = lexicon.dropDuplicates(["_low"])
    matched = lookup_join(near, words, ["_low"], max_rows=LEXICON_ROWS).where(
        (F.col("_valence").isNotNull() & ~F.col("_kind_of")) | F.col("_word").isNull()
    )
    # The phrases of three words look at a third word that has no score of its own.
    third = words.select(F.col("_low").alias("_third"), F.lit(False).alias("_unscored"))
    matched = lookup_join(matched, third, ["_third"], max_rows=LEXICON_ROWS)
    plain_third = F.col("_third").isNotNull() & F.coalesce("_unscored", F.lit(True))
    one, two, three = (F.coalesce(F.lower(f"_raw{back}"), F.lit("")) for back in (1, 2, 3))
    strengthened = {
        2: (two.isin(usable(["never"]))) & one.isin(*NEVER_SO),
        # As published, "so" or "this" right before the word is enough here.
        3: plain_third & (((three == "never") & two.isin(*NEVER_SO)) | one.isin(*NEVER_SO)),
    }
    certain = {2: (two == "without") & (one == "doubt"), 3: (three == "without") & ((two == "doubt") | (one == "doubt"))}

    sign = F.when(F.col("_valence") > 0, 1.0).otherwise(-1.0)
    loud = F.col("_mixed") & _shouted(F.col("_word"))
    scored = matched.withColumn("_score", F.col("_valence") + F.when(loud, sign * CAPITALS_STEP).otherwise(0.0))
    for back, damping in zip((1, 2, 3), DISTANCE_DAMPING):
        raw, score = F.col(f"_raw{back}"), F.col("_score")
        before = F.lower(raw)
        direction = F.when(score < 0, -1.0).otherwise(1.0)
        step = (
            F.when(before.isin(usable(STRENGTHENERS)), DEGREE_STEP)
            .when(before.isin(usable(WEAKENERS)), -DEGREE_STEP)
        )
        shout = F.when(F.col("_mixed") & _shouted(raw), F.when(score > 0, CAPITALS_STEP).otherwise(-CAPITALS_STEP))
        degree = F.coalesce((step * direction + F.coalesce(shout, F.lit(0.0))) * F.lit(damping), F.lit(0.0))
        negated = F.coalesce(before.isin(usable(NEGATORS)) | before.contains("n't"), F.lit(False))
        turn = F.when(negated, NEGATION_FACTOR).otherwise(1.0)
        if back in strengthened:
            turn = F.when(strengthened[back], NEVER_SO_FACTOR).when(certain[back], 1.0).otherwise(turn)
        scored = scored.withColumn("_score", (score + degree) * turn)
    pairs = (F.concat_ws(" ", three, two), F.concat_ws(" ", two, one))
    weakened = sum((F.when(plain_third & p.isin(*WEAKENING_PAIRS), -DEGREE_STEP).otherwise(0.0) for p in pairs), F.lit(0.0))
    least = (one == "least") & ~two.isin(*NOT_LEAST_AFTER) if "least" not in scored_rules else F.lit(False)
    scored = scored.withColumn("_score", (F.col("_score") + weakened) * F.when(least, NEGATION_FACTOR).otherwise(1.0))
    but = (
        F.when((F.col("_but") > 0) & (F.col("_index") < F.col("_but")), BEFORE_BUT)
        .when((F.col("_but") > 0) & (F.col("_index") > F.col("_but")), AFTER_BUT)
        .otherwise(1.0)
    )
    sums = scored.groupBy(*keys).agg(F.sum(F.col("_score") * but).alias("_sum"), F.max("_emphasis").alias("_emphasis"))
    total = F.coalesce(F.col("_sum"), F.lit(0.0))
    loudened = total + F.when(total > 0, F.col("_emphasis")).when(total < 0, -F.col("_emphasis")).otherwise(0.0)
    compound = loudened / F.sqrt(loudened * loudened + NORMALISER)
    return sums.select(*keys, F.round(compound, 4).alias("compound"))
