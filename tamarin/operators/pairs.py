"""Training pairs: sentences, first-seen dedup, leak-free splits, noise."""

from __future__ import annotations

import random
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamarin.functions.text import canonical, fingerprint, normalize_surface, sentences, split_of, strip_accents, tokenize, tokens

#: Hesitations that noise inserts.
FILLERS = ("euh", "hm", "ah", "eh", "bon")


def clean_sentences(df: DataFrame, key: str, text: str, shortest: int = 12, longest: int = 300, least_tokens: int = 3, native: bool = True) -> DataFrame:
    """``<key>, pos, sentence, fp``: normalised sentences of a fit length, the first seen of each fingerprint by (key, pos).

    Null and blank texts have none. Fingerprints are reduced with ``min`` of (key, pos, sentence) before they meet, so a sentence
    that fills a third of all rows never gathers in one task.
    """
    s = df.select(F.col(key).alias("key"), F.posexplode(sentences(F.col(text))).alias("pos", "raw")).withColumn("sentence", normalize_surface(F.col("raw")))
    fit = s.where(F.length("sentence").between(shortest, longest) & (F.size(tokenize(F.col("sentence"), compose=False)) >= least_tokens))
    first = fit.withColumn("fp", fingerprint(F.col("sentence"), native)).groupBy("fp").agg(F.min(F.struct("key", "pos", "sentence")).alias("x"))
    return first.select(F.col("x.key").alias(key), "x.pos", "x.sentence", "fp")


def with_split(df: DataFrame, train: float = 0.8, val: float = 0.1) -> DataFrame:
    return df.withColumn("split", split_of(F.col("fp"), train, val))


def split_statistics(df: DataFrame, text: str) -> DataFrame:
    """Per split: ``pairs, tokens, characters`` of ``text``."""
    rows = df.select("split", F.size(tokenize(F.col(text))).alias("w"), F.length(text).alias("n"))
    return rows.groupBy("split").agg(F.count("*").alias("pairs"), F.sum("w").cast("long").alias("tokens"), F.sum("n").cast("long").alias("characters"))


def leaked_fingerprints(train: DataFrame, other: DataFrame, text: str) -> DataFrame:
    """Distinct fingerprints found on both sides; those of texts without words do not count."""
    fp = lambda df: df.where(F.length(canonical(F.col(text))) > 0).select(fingerprint(F.col(text)).alias("fp")).distinct()
    return fp(train).join(fp(other), "fp", "left_semi")


def _noisy(toks: list[str], p: float, rng: random.Random, bare: dict[str, str]) -> str:
    out = []
    for tok in toks:
        draw, word = rng.random() / p, tok
        if draw < 0.35:
            word = bare.get(tok, tok)
        elif draw < 0.62 and len(tok) > 3:
            at = rng.randrange(1, len(tok) - 1)
            word = tok[:at] + (tok[at + 1 :] if draw < 0.50 else tok[at] + tok[at:])
        elif draw < 0.72:
            word = tok.translate(str.maketrans("èò", "eo"))
        out.append(word)
        if rng.random() < 0.06 * p:
            out.append(rng.choice(FILLERS))
    if len(out) > 3 and rng.random() < 0.25 * p:
        at = rng.randrange(len(out) - 1)
        out[at : at + 2] = ["".join(out[at : at + 2])]
    if out and rng.random() < 0.20 * p:
        at = rng.randrange(len(out))
        if len(out[at]) > 4:
            cut = rng.randrange(2, len(out[at]) - 1)
            out[at : at + 1] = [out[at][:cut], out[at][cut:]]
    text = " ".join(out)
    if rng.random() < 0.4 * p:
        text = text.translate(str.maketrans("", "", ",;:"))
    return text.lower() if rng.random() < 0.3 * p else text


def add_noise(df: DataFrame, key: str, text: str, p: float, seed: int = 13, variants: int = 1) -> DataFrame:
    """``<key>, variant, <text>, noisy``: recogniser-like noise, seeded per (seed, key, variant) and so the same in every run and
    partitioning. ``p`` <= 0 leaves the text as it is; null texts stay null."""
    base = df.select(key, text).withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(variants - 1))))
    if p <= 0:
        return base.withColumn("noisy", F.col(text)).select(key, "variant", text, "noisy")
    kind = dict(df.dtypes)
    ready = base.withColumn("_toks", tokenize(F.col(text))).withColumn("_bare", F.split(strip_accents(F.array_join("_toks", " ")), " "))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for one in parts:
            noisy = [
                None if t is None else _noisy(list(toks), p, random.Random(f"{seed}|{k}|{v}"), dict(zip(toks, bare)))
                for k, v, t, toks, bare in zip(one[key], one["variant"], one[text], one["_toks"], one["_bare"])
            ]
            yield one[[key, "variant", text]].assign(noisy=noisy)

    out = ready.mapInPandas(run, f"`{key}` {kind[key]}, variant int, `{text}` string, noisy string")
    return out.withColumn("noisy", F.when(F.col("noisy").isNotNull(), normalize_surface(F.col("noisy"))))


def until_enough(df: DataFrame, order: str, amount: str, n: int) -> DataFrame:
    """Rows in ``order`` whose predecessors' ``amount`` sums to less than ``n``. Sums per range of the order are found first, so only
    the range in which the limit falls is sorted as a whole."""
    cuts = df.select(F.percentile_approx(order, [i / 64 for i in range(1, 64)], 10_000).alias("c")).first()["c"] or []
    edges = F.array(*map(F.lit, sorted(set(cuts)))) if cuts else F.array().cast("array<double>")
    placed = df.withColumn("_b", F.size(F.filter(edges, lambda e: e < F.col(order))))
    before, sums = {}, 0
    for r in placed.groupBy("_b").agg(F.sum(amount).alias("s")).orderBy("_b").collect():  # at most 64 rows
        before[r["_b"]] = sums
        sums += r["s"] or 0
    if not before:
        return df
    offset = F.create_map(*(F.lit(x) for kv in before.items() for x in kv))
    run = F.sum(amount).over(Window.partitionBy("_b").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)) - F.col(amount)
    return placed.where(offset[F.col("_b")] < n).withColumn("_p", run + offset[F.col("_b")]).where(F.col("_p") < n).drop("_p", "_b")


def drop_identities(df: DataFrame, source: str, target: str, key: str, keep: float = 0.05) -> DataFrame:
    """Keep changed pairs, and of unchanged ones those whose hash falls under ``keep``."""
    same = normalize_surface(F.col(source), lower=True) == normalize_surface(F.col(target), lower=True)
    u = F.conv(F.substring(F.md5(F.concat(F.lit("identity:"), F.col(key).cast("string")).cast("binary")), 1, 8), 16, 10).cast("double") / 4294967295.0
    return df.where(~same | (u < keep))


def token_count(text: str):
    return F.size(tokens(normalize_surface(F.col(text))))
