"""Evaluation of corrections: error rates before and after, mismatches, quantiles, and estimates against audited truth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarin.functions.metrics import char_errors, corpus_rate, wer, word_errors
from tamarin.functions.text import normalize_surface
from tamarin.operators.ranks import value_ranks


def evaluate(df: DataFrame, source: str, predicted: str, reference: str) -> DataFrame:
    """One row: ``n, wer_before, wer_after, cer_before, cer_after, wer_reduction, exact_matches``. Rates are summed errors over summed
    lengths; the reduction is relative, 0 where there was no error before. An empty table gives n = 0 and null rates."""
    ref, src, hyp = F.col(reference), F.col(source), F.col(predicted)
    same = normalize_surface(hyp, lower=True) == normalize_surface(ref, lower=True)
    e = df.select(word_errors(ref, src).alias("ws"), word_errors(ref, hyp).alias("wh"), char_errors(ref, src).alias("cs"), char_errors(ref, hyp).alias("ch"), same.alias("same"))
    rate = lambda c: corpus_rate(F.col(f"{c}.errors"), F.col(f"{c}.length"))
    r = e.agg(F.count("*").alias("n"), rate("ws").alias("wer_before"), rate("wh").alias("wer_after"), rate("cs").alias("cer_before"), rate("ch").alias("cer_after"), F.count_if("same").alias("exact_matches"))
    cut = F.when(F.col("wer_before") == 0, 0.0).otherwise((F.col("wer_before") - F.col("wer_after")) / F.col("wer_before"))
    return r.select("n", "wer_before", "wer_after", "cer_before", "cer_after", cut.alias("wer_reduction"), "exact_matches")


def mismatches(df: DataFrame, key: str, predicted: str, reference: str, most: int = 20) -> DataFrame:
    """The first ``most`` rows by key whose prediction differs from the reference, case ignored."""
    same = normalize_surface(F.col(predicted), lower=True) == normalize_surface(F.col(reference), lower=True)
    return df.where(~same).orderBy(key).limit(most)


def quantiles(df: DataFrame, value: str, at: tuple[float, ...] = (0.1, 0.25, 0.5, 0.75, 0.9)) -> DataFrame:
    """``q, value``: exact quantiles, linear between neighbours, over non-null values; no row without any."""
    r = value_ranks(df.select(F.lit("v").alias("name"), F.col(value).cast("double").alias("v")).where("v is not null and not isnan(v)"))
    cells = r.withColumn("q", F.explode(F.array(*map(F.lit, at)))).withColumn("p", F.col("q") * (F.col("total") - 1))
    holds = lambda p: (F.col("less") <= p) & (p < F.col("less") + F.col("n"))
    low, high = F.floor("p"), F.ceil("p")
    x = cells.groupBy("q", "p").agg(F.max(F.when(holds(low), F.col("v"))).alias("a"), F.max(F.when(holds(high), F.col("v"))).alias("b"))
    return x.select("q", (F.col("a") + (F.col("b") - F.col("a")) * (F.col("p") - F.floor("p"))).alias("value"))


def audited(df: DataFrame, predicted: str, truth: str, estimate: str) -> DataFrame:
    """``n, wer_real, wer_estime``: mean error rates of audited rows, those with a truth, and what was estimated for them."""
    rows = df.where(F.col(truth).isNotNull() & (F.trim(F.col(truth)) != "")).select(wer(F.col(truth), F.col(predicted)).alias("r"), F.col(estimate).alias("e"))
    return rows.agg(F.count("*").alias("n"), F.avg("r").alias("wer_real"), F.avg("e").alias("wer_estime"))
