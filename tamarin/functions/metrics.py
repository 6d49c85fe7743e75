"""Edit distances and error rates, in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamarin.functions.text import bind, normalize_surface, plain_text, tokens


#: Distinct tokens of a pair that fit the plain characters; beyond, the supplementary ones follow, a million of them.
PLAIN_CODES = 35_000


def token_distance(a: Column, b: Column) -> Column:
    """Edit distance of two token arrays: each distinct token of the pair becomes one character, so the built-in distance counts
    tokens. A pair of more than a million distinct tokens raises an error."""

    def distance(x: Column) -> Column:
        def code(t: Column, wide: bool) -> Column:
            at = lambda w: F.array_position(x.known, w)
            if not wide:
                return F.array_join(F.transform(t, lambda w: F.decode(F.unhex(F.hex(F.lit(0x4E00 - 1) + at(w))), "UTF-16BE")), "")
            point = lambda w: F.when(at(w) <= PLAIN_CODES, F.lit(0x4E00 - 1) + at(w)).otherwise(F.lit(0x10000 - PLAIN_CODES) + at(w))
            return F.array_join(F.transform(t, lambda w: F.decode(F.unhex(F.lpad(F.hex(point(w)), 8, "0")), "UTF-32")), "")

        few = F.size(x.known) <= PLAIN_CODES
        most = F.when(F.size(x.known) > 1_000_000, F.raise_error(F.lit("more than a million distinct tokens")).cast("int"))
        return F.when(few, F.levenshtein(code(x.a, False), code(x.b, False))).otherwise(F.coalesce(most, F.levenshtein(code(x.a, True), code(x.b, True))))

    both = bind(F.struct(a.alias("a"), b.alias("b")), lambda x: F.struct(x.a.alias("a"), x.b.alias("b"), F.array_distinct(F.concat(x.a, x.b)).alias("known")))
    return bind(both, distance)


def _lower_tokens(c: Column) -> Column:
    # the surface is normalised twice, as error rates define it: once for the pair, once by the tokeniser
    return tokens(normalize_surface(normalize_surface(c, lower=True), compose=False))


def word_errors(ref: Column, hyp: Column) -> Column:
    """``struct<errors, length>`` over tokens, case ignored."""
    both = F.struct(_lower_tokens(ref).alias("r"), _lower_tokens(hyp).alias("h"))
    return bind(both, lambda x: F.struct(token_distance(x.r, x.h).alias("errors"), F.size(x.r).alias("length")))


def char_errors(ref: Column, hyp: Column) -> Column:
    """``struct<errors, length>`` over characters, case ignored."""
    both = F.struct(normalize_surface(ref, lower=True).alias("r"), normalize_surface(hyp, lower=True).alias("h"))
    return bind(both, lambda x: F.struct(F.levenshtein(x.r, x.h).alias("errors"), F.length(x.r).alias("length")))


def rate(e: Column) -> Column:
    """Errors per length; for an empty reference 0 without errors, else 1. May exceed 1."""
    return bind(e, lambda x: F.when(x.length == 0, F.when(x.errors == 0, 0.0).otherwise(1.0)).otherwise(x.errors / x.length))


def wer(ref: Column, hyp: Column) -> Column:
    return rate(word_errors(ref, hyp))


def cer(ref: Column, hyp: Column) -> Column:
    return rate(char_errors(ref, hyp))


def corpus_rate(errors: Column, length: Column) -> Column:
    """Aggregate: summed errors over summed length, not the mean of rates."""
    return F.sum(errors) / F.greatest(F.sum(length), F.lit(1))


def capped_cer(ref: Column, hyp: Column) -> Column:
    """Character error rate of plain texts, at most 1."""
    both = F.struct(plain_text(ref).alias("r"), plain_text(hyp).alias("h"))
    return bind(both, lambda x: F.when(F.length(x.r) == 0, F.when(F.length(x.h) == 0, 0.0).otherwise(1.0)).otherwise(F.least(F.lit(1.0), F.levenshtein(x.r, x.h) / F.length(x.r))))
