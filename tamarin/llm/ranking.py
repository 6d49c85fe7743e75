"""Problem 2: one ranking from several scores of different scales, by robust rank aggregation.

Each score is replaced by its normalised rank among all rows that have it, so range, tail and unit do not count. An item's sorted
ranks are compared with uniform order statistics: P(Beta(k, m-k+1) <= r_(k)) for each k of its m scores. The smallest of these,
corrected for the m that were tried and cut at 1, is the significance that the items are ranked by. Items that are not significantly
good at all (significance 1) follow, ordered by how significantly bad they are, by the same test on the reversed ranks: a tie-break,
stated here because the method leaves it open.

No window spans the table: ranks come from value counts (``tamarin.operators.ranks``). Values held by many rows reach their rows by
a bounded broadcast, all others by a shuffled join.
"""

from __future__ import annotations

from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarin.operators.ranks import value_ranks, with_ranks
from tamarin.plans.durable import durable


def _tail(r: Column, k: Column, m: Column, most: int) -> Column:
    """P(at least k of m uniform values are <= r), for m up to ``most``."""
    choose = F.array(*(F.array(*(F.lit(float(comb(i, j))) for j in range(most + 1))) for i in range(most + 1)))
    return F.aggregate(F.sequence(k, m), F.lit(0.0), lambda s, j: s + F.element_at(F.element_at(choose, m + 1), j + 1) * F.pow(r, j) * F.pow(1 - r, m - j))


def significance(ranks: Column, most: int, agree: int = 1) -> Column:
    """The corrected minimum of the order-statistic probabilities of an array of normalised ranks, at most 1; null for an empty one.
    Order statistics below ``agree`` are left out."""
    r, m = F.array_sort(ranks), F.size(ranks)
    first = F.least(F.lit(agree), m)
    tails = F.transform(F.sequence(first, m), lambda k: _tail(F.element_at(r, k), k, m, most))
    return F.when(m > 0, F.least(F.lit(1.0), F.array_min(tails) * (m - first + 1)))


def aggregate_ranks(df: DataFrame, key: str, scores: dict[str, bool], agree: int = 1) -> DataFrame:
    """One row per distinct key and scores: ``<key>, n_scores, rho, place``.

    ``scores`` maps each column to whether more is better. Null and NaN scores are absent: the item is judged by those it has.
    Infinite ones are extreme values. Ties share the mean rank, and items of one significance one place (1 is best). Items without
    any score come out with null ``rho`` and ``place``; whole rows given twice count once; other columns are left out. With
    ``agree`` = k an item is good only if k of its scores are: order statistics below k are left out.
    """
    names = list(scores)
    clean = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in names}
    rows = df.select(F.col(key).alias("key"), *(clean[c].alias(f"s{i}") for i, c in enumerate(names))).distinct()
    own = ["key", *(f"s{i}" for i in range(len(names)))]
    signed = F.array(*(F.struct(F.lit(c).alias("name"), (-F.col(f"s{i}") if scores[c] else F.col(f"s{i}")).alias("v")) for i, c in enumerate(names)))
    long = rows.select(*own, F.explode(F.filter(signed, lambda x: x.v.isNotNull())).alias("x")).select(*own, "x.name", (F.col("x.v") + 0.0).alias("v"))
    ranked = with_ranks(long, durable(value_ranks(long.select("name", "v"), len(names)), "score-ranks"))
    share = (F.col("less") + (F.col("n") + 1) / 2) / F.col("total")
    back = (F.col("total") - F.col("less") - F.col("n") + (F.col("n") + 1) / 2) / F.col("total")
    items = ranked.groupBy(*own).agg(F.collect_list(share).alias("good"), F.collect_list(back).alias("bad"))
    rho = items.select(*own, F.size("good").alias("n_scores"), significance(F.col("good"), len(names), agree).alias("rho"), significance(F.col("bad"), len(names), agree).alias("rho_bad"))
    # below 0 for the good ones, from 0 on for the others
    order = F.when(F.col("rho") < 1, F.log("rho")).otherwise(-F.log("rho_bad"))
    rho = rho.withColumn("v", F.round(order, 9) + 0.0).withColumn("name", F.lit("place"))
    rho = durable(rho, "significance")
    placed = with_ranks(rho, durable(value_ranks(rho.select("name", "v"), 1), "places")).select("key", "n_scores", "rho", (F.col("less") + 1).alias("place"))
    none = rows.where(" and ".join(f"s{i} is null" for i in range(len(names)))).select("key", F.lit(0).alias("n_scores"), F.lit(None).cast("double").alias("rho"), F.lit(None).cast("long").alias("place"))
    return placed.unionByName(none).withColumnRenamed("key", key)
