"""The correction pass: filter, correct, score, estimate, as one lineage; the corrector is a plug-in."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarin.functions import scores
from tamarin.functions.metrics import wer
from tamarin.functions.text import compression_ratio, enforce_alphabet, normalize_surface, tokenize, violations
from tamarin.operators import charlm, gate, ingest
from tamarin.plans.durable import durable

#: A corrector takes (df, key, text, into) and returns df with the corrected text.
Corrector = Callable[[DataFrame, str, str, str], DataFrame]


def batch_corrector(correct_texts: Callable[[list[str]], list[str]], size: int = 32) -> Corrector:
    """A corrector from a function over lists of texts, such as a model's. It gets ``size`` texts at a time; where a call fails, its
    texts are tried one by one, and one that fails alone comes out empty with the error in ``correction_error``."""

    def corrector(df: DataFrame, key: str, text: str, into: str) -> DataFrame:
        def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            def one(t: str) -> tuple[str, str | None]:
                try:
                    return correct_texts([t])[0], None
                except Exception as e:  # noqa: BLE001 - isolated per record
                    return "", f"{type(e).__name__}: {e}"

            for part in parts:
                texts, out = [t or "" for t in part[text]], []
                for a in range(0, len(texts), size):
                    few = texts[a : a + size]
                    try:
                        got = correct_texts(few)
                        out += [(g, None) for g in got] if len(got) == len(few) else [one(t) for t in few]
                    except Exception:  # noqa: BLE001
                        out += [one(t) for t in few]
                yield part.assign(**{into: [o[0] for o in out], "correction_error": [o[1] for o in out]})

        schema = ", ".join(f"`{c}` {k}" for c, k in df.select(key, text).dtypes) + f", `{into}` string, correction_error string"
        done = df.select(key, text).dropDuplicates([key]).mapInPandas(run, schema).drop(text)
        return df.join(done, key, "left")

    return corrector


def score_segments(df: DataFrame, text: str, model: DataFrame, key: str, order: int = 5) -> DataFrame:
    """Missing compression ratios, token counts and language-model perplexities."""
    ppl = charlm.perplexity(df.select(key, text).dropDuplicates([key]), key, text, model, order).select(key, scores.finite(F.col("perplexity")).alias("perplexite_lm"))
    out = df.drop("perplexite_lm", "n_tokens").join(ppl, key, "left")
    ratio = F.coalesce("compression_ratio", compression_ratio(F.col(text))) if "compression_ratio" in df.columns else compression_ratio(F.col(text))
    return out.withColumn("compression_ratio", ratio).withColumn("n_tokens", F.size(tokenize(F.col(text))))


def filtered(df: DataFrame, ppl_threshold: float = scores.MAX_PERPLEXITY) -> DataFrame:
    why = gate.reasons(F.col("avg_logprob"), F.col("compression_ratio"), F.col("perplexite_lm"), F.col("no_speech_prob"), F.col("n_tokens"), ppl_threshold)
    return df.withColumn("motifs_rejet", why).withColumn("filtre_passe", F.size("motifs_rejet") == 0)


def correct(df: DataFrame, key: str, text: str, corrector: Corrector, model: DataFrame, calibration: DataFrame, order: int = 5, ppl_threshold: float = scores.MAX_PERPLEXITY) -> DataFrame:
    """All rows; those that pass the filter with their correction, its scores, confidence and estimated error rate, the rest with
    nulls there. Rejected rows never reach the corrector."""
    every = durable(filtered(score_segments(df, text, model, key, order), ppl_threshold), "scored")
    kept = corrector(every.where("filtre_passe"), key, text, "gcf_corrige")
    kept = durable(kept.withColumn("gcf_corrige", enforce_alphabet(normalize_surface(F.col("gcf_corrige")))), "corrected")
    after = charlm.perplexity(kept.select(key, "gcf_corrige").dropDuplicates([key]), key, "gcf_corrige", model, order).select(key, scores.finite(F.col("perplexity")).alias("perplexite_corrigee"))
    kept = kept.join(after, key, "left").withColumn("taux_edition", F.round(wer(F.col(text), F.col("gcf_corrige")), 4)).withColumn("violations_gerec2", violations(F.col("gcf_corrige")))
    kept = kept.withColumn("gain_perplexite", F.col("perplexite_lm") - F.col("perplexite_corrigee"))
    kept = kept.withColumn("confiance", scores.confidence(F.col("avg_logprob"), F.col("compression_ratio"), F.col("perplexite_corrigee"), F.col("perplexite_lm"), F.col("taux_edition"), F.col("violations_gerec2"), ppl_threshold))
    return ingest.estimate_wer(kept, "confiance", calibration).unionByName(every.where("not filtre_passe"), allowMissingColumns=True)


def high_confidence(df: DataFrame, least: float = 0.80, most_wer: float = 0.05) -> DataFrame:
    return df.where((F.col("confiance") >= least) & (F.col("wer_estime") <= most_wer))


def statistics(df: DataFrame, least: float = 0.80, most_wer: float = 0.05) -> DataFrame:
    """One row: segments, kept, retention, mean estimated error rate, high-confidence rows and their hours."""
    high = (F.col("confiance") >= least) & (F.col("wer_estime") <= most_wer)
    return df.agg(
        F.count("*").alias("segments"), F.count_if("filtre_passe").alias("kept"), F.round(F.avg(F.col("filtre_passe").cast("int")), 4).alias("retention"), F.round(F.avg("wer_estime"), 4).alias("wer_estime"),
        F.count_if(high).alias("high"), F.round(F.sum(F.when(high, F.col("duration")).otherwise(0.0)) / 3600, 4).alias("hours_high"),
    )
