"""Composite scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Limits of the segment filter and of the confidence score.
MIN_LOGPROB, MAX_COMPRESSION, MAX_NO_SPEECH, MIN_TOKENS, MAX_PERPLEXITY = -1.0, 2.0, 0.6, 2, 100.0


def sigmoid(x: Column, mid: float | Column, scale: float) -> Column:
    return 1 / (1 + F.exp(-(x - mid) / scale))


def finite(c: Column) -> Column:
    """Null for infinite and NaN values."""
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def first_present(columns: list[str], wanted: list[str]) -> Column:
    """The first non-null of the wanted columns that exist."""
    have = [F.col(c).cast("double") for c in wanted if c in columns]
    return F.coalesce(*have) if have else F.lit(None).cast("double")


def confidence(logprob: Column, compression: Column, ppl_after: Column, ppl_before: Column, edit_rate: Column, violations: Column, threshold: float = MAX_PERPLEXITY) -> Column:
    """Weighted mean of acoustic, degeneration, language and stability parts, over the weights of the parts that exist; letters
    outside the alphabet add a part of 0. Rounded to 4 places."""
    ppl = F.coalesce(F.when(ppl_after != 0, ppl_after), F.when(ppl_before != 0, ppl_before))
    parts = (
        (F.lit(0.30), sigmoid(logprob, MIN_LOGPROB, 0.25), logprob.isNotNull()),
        (F.lit(0.15), 1 - sigmoid(compression, MAX_COMPRESSION, 0.20), F.lit(True)),
        (F.lit(0.35), 1 - sigmoid(F.log(F.greatest(ppl, F.lit(1.01))), F.log(F.lit(max(threshold, 1.01))), 0.35), ppl.isNotNull()),
        (F.lit(0.20), 1 - sigmoid(F.coalesce(edit_rate, F.lit(0.0)), 0.45, 0.12), F.lit(True)),
        (F.lit(0.10), F.lit(0.0), F.coalesce(F.size(violations) > 0, F.lit(False))),
    )
    top = sum((F.when(on, w * x).otherwise(0.0) for w, x, on in parts), F.lit(0.0))
    return F.round(top / sum((F.when(on, w).otherwise(0.0) for w, _, on in parts), F.lit(0.0)), 4)


def bucket(conf: Column) -> Column:
    """The 0.1-wide bucket of a confidence, as text."""
    return F.format_string("%.1f", (F.floor(conf * 10) / 10).cast("double"))


def fused_score(logprob: Column, lm_logprob: Column, words: Column, weight: float = 0.5) -> Column:
    return logprob + weight * lm_logprob / F.greatest(words, F.lit(1))
