"""Distributed ranks and medians: no window spans a table, no task holds a hot value."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamarin.plans.durable import durable

#: Cut points between buckets of one name.
CUTS = 255
#: A value is hot that holds at least one in HOT of a name's rows; there are at most HOT a name.
HOT = 200


#: Names of which the cuts and offsets are broadcast at most: at most 256 numbers each.
FEW = 64


def value_ranks(values: DataFrame, names: int | None = None) -> DataFrame:
    """``values(name, v)`` without nulls to one row per distinct value: ``name, v, n, less, total``, where ``less`` counts the rows
    of the name with a smaller value and ``n`` those with this one. ``names`` says how many names there are, if that is known.

    Equal values are counted before anything is sorted, values fall into buckets between approximate quantiles, and a rank is a
    running count inside the bucket plus the bucket's offset.
    """
    freq = durable(values.groupBy("name", "v").agg(F.count("*").alias("n")), "value-counts")
    small = F.broadcast if names is not None and names <= FEW else lambda df: df
    cuts = small(durable(freq.groupBy("name").agg(F.percentile_approx("v", [(i + 1) / (CUTS + 1) for i in range(CUTS)], 10_000).alias("cuts")), "cuts"))
    placed = freq.join(cuts, "name").withColumn("bucket", F.size(F.filter("cuts", lambda c: c < F.col("v")))).drop("cuts")
    sums = placed.groupBy("name", "bucket").agg(F.sum("n").alias("m"))  # at most CUTS + 1 rows a name
    by = Window.partitionBy("name").orderBy("bucket")
    offsets = sums.select("name", "bucket", (F.sum("m").over(by) - F.col("m")).alias("before"), F.sum("m").over(Window.partitionBy("name")).alias("total"))
    run = F.sum("n").over(Window.partitionBy("name", "bucket").orderBy("v"))
    return placed.withColumn("run", run).join(small(offsets), ["name", "bucket"]).select("name", "v", "n", (F.col("before") + F.col("run") - F.col("n")).alias("less"), "total")


def with_ranks(rows: DataFrame, ranks: DataFrame) -> DataFrame:
    """``rows`` (with ``name, v``) joined to ``ranks``; for few names. Hot values come by a broadcast of at most HOT a name, all
    others by their hash."""
    hot = ranks.where(F.col("n") * HOT >= F.col("total")).select("name", "v", F.struct("n", "less", "total").alias("hot"))
    near = rows.join(F.broadcast(hot), ["name", "v"], "left")
    cold = near.where("hot is null").drop("hot").join(ranks, ["name", "v"])
    return near.where("hot is not null").select(*rows.columns, "hot.n", "hot.less", "hot.total").unionByName(cold)


def medians(values: DataFrame) -> DataFrame:
    """``values(name, v)`` to ``name, median, n``; nulls do not count; the middle two of an even number are averaged."""
    r = value_ranks(values.where("v is not null").select("name", F.col("v").cast("double").alias("v")))
    low, high = F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2)
    holds = lambda p: (F.col("less") <= p) & (p < F.col("less") + F.col("n"))
    return r.groupBy("name").agg(
        ((F.max(F.when(holds(low), F.col("v"))) + F.max(F.when(holds(high), F.col("v")))) / 2).alias("median"), F.max("total").alias("n")
    )
