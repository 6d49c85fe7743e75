"""Word suggestions: prefix, fuzzy and next-word look-up, scoring and merging, for a table of inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamarin.functions.text import FOLD_FROM, casing_pattern, fold

#: Suggestions shown, prefix matches looked at, edits allowed.
SHOWN, PREFIX_MATCHES, EDITS = 5, 10, 2
#: Boosts by language, and slots of each.
PRIMARY, SECONDARY, PRIMARY_SLOTS, SECONDARY_SLOTS = 1.5, 0.8, 3, 2


def dictionary(words: DataFrame, word: str, freq: str | None = None) -> DataFrame:
    """``word, freq, folded``: lower-cased, one row per word."""
    f = F.sum(F.coalesce(F.col(freq), F.lit(1))) if freq else F.count("*")
    return words.where(F.col(word).isNotNull()).groupBy(F.lower(F.col(word)).alias("word")).agg(f.cast("long").alias("freq")).withColumn("folded", fold(F.col("word")))


def prefix_matches(inputs: DataFrame, words: DataFrame, most: int = PREFIX_MATCHES) -> DataFrame:
    """``input, word, freq, distance, rank``: the most frequent words that begin with the input, accents ignored. Inputs are joined
    to exploded prefixes, an equi-join; each prefix keeps its ``most`` best words beforehand."""
    asked = inputs.select("input").where(F.length("input") >= 2).distinct().withColumn("prefix", fold(F.col("input")))
    longest = asked.agg(F.max(F.length("prefix"))).first()[0] or 0  # one number
    parts = words.select("word", "freq", "folded", F.explode(F.sequence(F.lit(0), F.least(F.length("folded"), F.lit(longest)))).alias("n")).withColumn("prefix", F.substring(F.col("folded"), F.lit(1), F.col("n")))
    wanted = parts.join(asked.select("prefix").distinct(), "prefix", "left_semi")
    best = wanted.withColumn("rank", F.row_number().over(Window.partitionBy("prefix").orderBy(F.desc("freq"), "word"))).where(F.col("rank") <= most)
    return asked.join(best, "prefix").select("input", "word", "freq", F.lit(0).alias("distance"), "rank")


def deletions(word: Column, edits: int = EDITS) -> Column:
    """The word and all that is left of it after up to ``edits`` deletions. Two words within so many edits have one in common."""
    one = lambda w: F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w))))
    some = lambda w: F.when(F.length(w) > 0, one(w)).otherwise(F.array().cast("array<string>"))
    out = level = F.array(word)
    for _ in range(edits):
        level = F.array_distinct(F.flatten(F.transform(level, some)))
        out = F.array_union(out, level)
    return out


def fuzzy_matches(inputs: DataFrame, words: DataFrame, most: int = SHOWN, folded: bool = True) -> DataFrame:
    """``input, word, freq, distance, rank``: words within EDITS edits, nearest and then most frequent first. Both sides are joined
    by what is left of them after up to EDITS deletions, so the keys are as many as the words and no length gathers in one task."""
    text = fold(F.col("input")) if folded else F.lower("input")
    asked = inputs.select("input").where(F.length("input") >= 3).distinct().withColumn("a", text).withColumn("part", F.explode(deletions(F.col("a"))))
    held = words.withColumn("b", F.col("folded") if folded else F.col("word")).withColumn("part", F.explode(deletions(F.col("b"))))
    near = asked.join(held, "part").select("input", "a", "word", "freq", "b").distinct().withColumn("distance", F.levenshtein("a", "b", EDITS)).where("distance >= 0")
    return near.withColumn("rank", F.row_number().over(Window.partitionBy("input").orderBy("distance", F.desc("freq"), "word"))).where(F.col("rank") <= most).select("input", "word", "freq", "distance", "rank")


def dictionary_score(word: Column, text: Column, freq: Column, distance: Column) -> Column:
    d = F.coalesce(distance, F.lit(0))
    return (
        freq + F.when(d > 0, (3 - d) * 100_000).otherwise(0) + F.when(F.startswith(fold(word), fold(text)), 50).otherwise(0) + F.when(F.length(word) <= 6, 10).otherwise(0)
        - F.when(F.length(word) > 12, 10).otherwise(0) + F.when(F.rlike(F.lower(word), F.lit(f"[{FOLD_FROM}]")), 5).otherwise(0)
    )


def _ranked(scored: DataFrame, most: int) -> DataFrame:
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy("input").orderBy(F.desc("score"), "word"))).where(F.col("rank") <= most)


def primary_suggestions(inputs: DataFrame, words: DataFrame, followers: DataFrame | None = None) -> DataFrame:
    """``input, word, score, rank``: prefix matches, or fuzzy ones where there are none; likely followers of ``inputs.previous``
    gain 50 if they begin with the input."""
    by_prefix = prefix_matches(inputs, words)
    missing = inputs.join(by_prefix.select("input").distinct(), "input", "left_anti")
    close = fuzzy_matches(missing, words)
    raw = fuzzy_matches(missing.join(close.select("input").distinct(), "input", "left_anti"), words, folded=False)
    found = by_prefix.unionByName(close).unionByName(raw)
    scored = found.select("input", "word", dictionary_score(F.col("word"), F.col("input"), F.col("freq"), F.col("distance")).alias("score"))
    if followers is not None:
        nxt = inputs.select("input", F.lower("previous").alias("prev")).join(followers.where(F.col("rank") <= SHOWN), "prev").where(F.startswith(F.lower("next"), F.lower("input")))
        scored = scored.unionByName(nxt.select("input", F.col("next").alias("word"), F.lit(50).cast("long").alias("score"))).groupBy("input", "word").agg(F.sum("score").alias("score"))
    return _ranked(scored.withColumn("score", F.col("score") * PRIMARY), PRIMARY_SLOTS)


def secondary_suggestions(inputs: DataFrame, words: DataFrame) -> DataFrame:
    """``input, word, score, rank`` from a second dictionary, by exact lower-case prefix; inputs of three letters or more."""
    exact = words.withColumn("folded", F.lower("word"))
    found = prefix_matches(inputs.where(F.length("input") >= 3), exact, SECONDARY_SLOTS)
    return _ranked(found.select("input", "word", (dictionary_score(F.col("word"), F.col("input"), F.col("freq"), F.lit(0)) * SECONDARY).alias("score")), SECONDARY_SLOTS)


def merged(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """``input, slot, word``: primary suggestions first, then secondary ones, no word twice, at most SHOWN; in the input's case."""
    both = primary.select("input", "word", F.lit(0).alias("side"), "rank").unionByName(secondary.select("input", "word", F.lit(1).alias("side"), "rank"))
    once = both.groupBy("input", F.lower("word").alias("low")).agg(F.min(F.struct("side", "rank", "word")).alias("x"))
    slot = once.withColumn("slot", F.row_number().over(Window.partitionBy("input").orderBy("x.side", "x.rank"))).where(F.col("slot") <= SHOWN)
    return slot.select("input", "slot", casing_pattern(F.col("input"), F.col("x.word")).alias("word"))
