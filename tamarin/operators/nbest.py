"""Several hypotheses per recording: ranking, agreement, and mixing of pseudo-labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamarin.functions.metrics import token_distance
from tamarin.functions.scores import fused_score
from tamarin.functions.text import normalize_surface, tokens


def dedup(h: DataFrame) -> DataFrame:
    """One row per recording and lower-cased text: the lowest temperature."""
    own = Window.partitionBy("audio", F.lower("text")).orderBy("temperature", "text")
    return h.withColumn("_rn", F.row_number().over(own)).where("_rn = 1").drop("_rn")


def rank(h: DataFrame, weight: float = 0.5) -> DataFrame:
    """Hypotheses with ``score_fusion`` and ``rank``, best first; nulls last, ties by temperature."""
    words = F.size(F.filter(F.split("text", r"\s+"), lambda w: w != ""))
    scored = h.withColumn("score_fusion", fused_score(F.col("avg_logprob"), F.col("lm_logprob"), words, weight))
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy("audio").orderBy(F.desc_nulls_last("score_fusion"), "temperature", "text")))


def agreement(ranked: DataFrame, least: float = 0.85) -> DataFrame:
    """``audio, source, target, accord, n_hypotheses, kept``: 1 less the mean word error rate of the best hypothesis against the
    others, at least 0. Recordings with one hypothesis are not kept and have accord 0."""
    best = ranked.where("rank = 1").select("audio", F.col("text").alias("source"), normalize_surface(F.col("corrected")).alias("target"))
    rest = ranked.where("rank > 1").select("audio", normalize_surface(F.col("corrected")).alias("other"))
    low = lambda c: tokens(normalize_surface(normalize_surface(F.col(c), lower=True), compose=False))
    pair = best.join(rest, "audio").withColumn("r", low("target")).withColumn("h", low("other"))
    n = F.size("r")
    wer = F.when(n == 0, F.when(F.size("h") == 0, 0.0).otherwise(1.0)).otherwise(token_distance(F.col("r"), F.col("h")) / n)
    mean = pair.groupBy("audio").agg(F.avg(wer).alias("w"), F.count("*").alias("others"))
    out = best.join(mean, "audio", "left").withColumn("accord", F.coalesce(F.greatest(F.lit(0.0), 1 - F.col("w")), F.lit(0.0)))
    return out.select("audio", "source", "target", F.round("accord", 4).alias("accord"), (F.coalesce("others", F.lit(0)) + 1).cast("int").alias("n_hypotheses"), ((F.coalesce("others", F.lit(0)) > 0) & (F.col("accord") >= least)).alias("kept"))


def pseudo_statistics(agreed: DataFrame) -> DataFrame:
    """One row of figures of ``agreement``'s rows: recordings, those with several hypotheses, kept ones, mean agreement of both."""
    several = F.col("n_hypotheses") > 1
    return agreed.agg(
        F.count("*").alias("recordings"), F.count_if(several).alias("several"), F.count_if("kept").alias("kept"), F.round(F.avg(F.when(several, F.col("accord"))), 4).alias("mean_agreement"),
        F.round(F.avg(F.when(F.col("kept"), F.col("accord"))), 4).alias("mean_agreement_kept"),
    )


def collect_hypotheses(ranked: DataFrame) -> DataFrame:
    """``audio, hypotheses ARRAY<STRUCT>`` in rank order; a recording has a bounded number of them."""
    one = F.struct("rank", "text", "temperature", "avg_logprob", "lm_logprob", "score_fusion")
    return ranked.groupBy("audio").agg(F.array_sort(F.collect_list(one)).alias("hypotheses"))


def mix(pseudo: DataFrame, synthetic: DataFrame, ratio: float = 1.0, seed: str = "mix") -> DataFrame:
    """Pseudo-pairs and at most ``ratio`` times as many synthetic ones, those of the lowest hash, in hash order."""
    most = int(pseudo.count() * ratio)
    draw = F.md5(F.concat_ws("|", F.lit(seed), "source", "target").cast("binary"))
    both = pseudo.select("source", "target", F.lit("pseudo").alias("origin")).unionByName(synthetic.select("source", "target", F.lit("synthetic").alias("origin")).orderBy(draw, "source", "target").limit(most))
    return both.orderBy(draw, "source", "target")
