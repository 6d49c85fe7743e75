"""Character n-gram language model with stupid back-off, as tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tamarin.functions.text import normalize_surface


def _framed(text: Column) -> Column:
    return F.concat(F.lit("^"), normalize_surface(text, lower=True), F.lit("$"))


def _gram_at(n: int):
    return lambda i: F.substring(F.col("s"), i, F.lit(n))


def fit(df: DataFrame, text: str, order: int = 5) -> DataFrame:
    """``n INT, gram STRING, cnt LONG`` for n = 1..order; null texts count as empty ones. The model is this table: keep it as
    parquet."""
    s = df.select(_framed(F.col(text)).alias("s"))
    grams = [s.where(F.length("s") >= n).select(F.lit(n).alias("n"), F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.length("s") - (n - 1), F.lit(1))), _gram_at(n))).alias("gram")) for n in range(1, order + 1)]
    return reduce(DataFrame.unionByName, grams).groupBy("n", "gram").agg(F.count("*").alias("cnt"))


def load(spark: SparkSession, *paths: str) -> tuple[DataFrame, str]:
    """The model of the first path that exists, and that path; FileNotFoundError where there is none. Paths stand in the order of
    preference, such as a larger model's before a smaller one's."""
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
            return spark.read.schema("n int, gram string, cnt long").parquet(path), path
    raise FileNotFoundError(f"no model at {', '.join(paths)}")


def vocabulary_size(model: DataFrame) -> DataFrame:
    return model.where("n = 1").agg(F.count("*").alias("vocabulary"), F.sum("cnt").alias("characters"))


def perplexity(df: DataFrame, key: str, text: str, model: DataFrame, order: int = 5, alpha: float = 0.4) -> DataFrame:
    """``<key>, log10_prob, perplexity``, one row per row of ``df`` with a distinct key.

    The probability of each distinct (context, character) is looked up once, longest context with counts first, then joined back to
    the positions; texts are never held whole in one task, and a hot n-gram's rows are pre-counted per text.
    """
    total = model.where("n = 1").agg(F.sum("cnt")).first()[0] or 0  # one number
    s = df.select(F.col(key).alias("key"), _framed(F.col(text)).alias("s"))
    spots = s.select("key", F.explode(F.transform(F.sequence(F.lit(2), F.length("s")), lambda i: F.substring(F.col("s"), F.greatest(i - (order - 1), F.lit(1)), i - F.greatest(i - (order - 1), F.lit(1)) + 1))).alias("gram"))
    spots = spots.groupBy("key", "gram").agg(F.count("*").alias("times"))
    grams = spots.select("gram").distinct()
    tries = grams.select("gram", F.explode(F.sequence(F.lit(0), F.length("gram") - 1)).alias("k")).withColumn("sub", F.substring(F.col("gram"), F.length("gram") - F.col("k"), F.col("k") + 1)).withColumn("ctx", F.substring(F.col("sub"), F.lit(1), F.col("k")))
    num = model.select(F.col("gram").alias("sub"), F.col("cnt").alias("num"))
    den = model.select(F.col("gram").alias("ctx"), F.col("cnt").alias("den"))
    found = tries.join(num, "sub").join(den, "ctx", "left").withColumn("den", F.when(F.col("k") == 0, F.lit(total)).otherwise(F.col("den"))).where("den is not null")
    p = F.pow(F.lit(alpha), F.length("gram") - 1 - F.col("k")) * F.col("num") / F.col("den")
    best = found.groupBy("gram").agg(F.max_by(p, "k").alias("p"))
    floor = F.lit(1.0 / max(total, 1))
    scored = spots.join(best, "gram", "left").groupBy("key").agg(F.sum(F.col("times") * F.log10(F.greatest(F.coalesce("p", floor), F.lit(1e-12)))).alias("log10_prob"))
    size = s.select("key", (F.length("s") - 1).alias("n"))
    return size.join(scored, "key").select(F.col("key").alias(key), "log10_prob", F.pow(F.lit(10.0), -F.col("log10_prob") / F.col("n")).alias("perplexity"))


def quantile_by_index(df: DataFrame, value: str, q: float = 0.95) -> DataFrame:
    """One row ``threshold``: the finite value at index min(floor(q n), n - 1) in ascending order; null without values."""
    from tamarin.operators.ranks import value_ranks

    v = df.select(F.lit("v").alias("name"), F.col(value).cast("double").alias("v")).where("v is not null and not isnan(v) and abs(v) < double('infinity')")
    r = value_ranks(v)
    at = F.least(F.floor(F.col("total") * q), F.col("total") - 1)
    return r.where((F.col("less") <= at) & (at < F.col("less") + F.col("n"))).agg(F.max("v").alias("threshold"))


def next_words(df: DataFrame, tokens: str, most: int = 5) -> DataFrame:
    """Word bigram model: ``prev, next, prob, rank`` of the most likely followers of each word."""
    low = F.transform(F.col(tokens), F.lower)
    pairs = df.select(F.explode(F.zip_with(F.slice(low, 1, F.greatest(F.size(low) - 1, F.lit(0))), F.slice(low, 2, F.greatest(F.size(low) - 1, F.lit(0))), lambda a, b: F.struct(a.alias("prev"), b.alias("next")))).alias("x")).select("x.*")
    n = pairs.groupBy("prev", "next").agg(F.count("*").alias("n"))
    total = n.groupBy("prev").agg(F.sum("n").alias("total"))
    ranked = n.join(total, "prev").withColumn("prob", F.col("n") / F.col("total")).withColumn("rank", F.row_number().over(Window.partitionBy("prev").orderBy(F.desc("prob"), "next")))
    return ranked.where(F.col("rank") <= most).select("prev", "next", "prob", "rank")
